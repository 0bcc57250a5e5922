import random
from collections import Counter, defaultdict

from conftest import rows

import tidewell.llm.frequent as frequent
from tidewell.llm.frequent import frequent_share, top_values

SCHEMA = "g string, v string, n bigint, total int, place int"


def table(seed):
    r = random.Random(seed)
    t = [(r.choice("ab"), r.choice(["hot"] * 5 + ["warm"] * 2 + [f"v{r.randrange(200)}"] * 3 + [None, ""]), 1, 1, 1) for _ in range(1500)]
    return t + [("tie", v, 1, 1, 1) for v in "xyzxyz"] + [("nulls", None, 1, 1, 1), (None, "x", 1, 1, 1)]


def groups(t):
    out = defaultdict(Counter)
    for g, v, *_ in t:
        if g is not None and v is not None:
            out[g][v] += 1
    return out


def test_share(spark, monkeypatch):
    t = table(1)
    df = spark.createDataFrame(t, SCHEMA).repartition(3)
    for share in (0.02, 1 / 3, 1.0):
        want = sorted(((g, v, n, sum(c.values())) for g, c in groups(t).items() for v, n in c.items() if n >= share * sum(c.values()) - 1e-9), key=repr)
        assert rows(frequent_share(df, ["g"], "v", share)) == want
        assert rows(frequent_share(df, ["g"], "v", share, bits=(1, 2, 3))) == want
    monkeypatch.setattr(frequent, "BROADCAST_ROWS", 1)
    assert rows(frequent_share(df, ["g"], "v", 1.0)) == want
    assert frequent_share(df.limit(0), ["g"], "v", 0.1).count() == 0
    whole = Counter(v for _, v, *_ in t if v is not None)
    assert rows(frequent_share(df, [], "v", 0.3), "v", "n") == sorted((v, n) for v, n in whole.items() if n >= 0.3 * sum(whole.values()))


def test_top(spark):
    t = table(2)
    df = spark.createDataFrame(t, SCHEMA).repartition(3)
    for k, bits in ((1, (12, 24)), (5, (2, 4)), (400, (12, 24))):
        want = [(g, v, n, i + 1) for g, c in groups(t).items() for i, (v, n) in enumerate(sorted(c.items(), key=lambda x: (-x[1], x[0]))[:k])]
        assert rows(top_values(df, ["g"], "v", k, bits=bits)) == sorted(want, key=repr)
    assert top_values(df.limit(0), ["g"], "v", 3).count() == 0


def test_many_groups_keep_their_pruning(spark, monkeypatch):
    """Above the bound of a broadcast prefixes go in slices, and no pass counts values outside of kept prefixes."""
    t = [(f"day{d}", v, 1, 1, 1) for d in range(40) for v in [*["hot"] * 30, *(f"{d}-{k}" for k in range(60))]]
    df = spark.createDataFrame(t, SCHEMA).repartition(3)
    counted = []
    real = frequent._among
    monkeypatch.setattr(frequent, "_among", lambda *a: counted.append(real(*a)) or counted[-1])
    for bound in (10**6, 15):
        monkeypatch.setattr(frequent, "BROADCAST_ROWS", bound)
        counted.clear()
        assert rows(frequent_share(df, ["g"], "v", 1 / 5)) == sorted((f"day{d}", "hot", 30, 90) for d in range(40))
        assert [x.count() for x in counted[-1:]][0] < 60  # full values within the kept prefixes, of 2,440
        assert ("Union" in counted[-1]._jdf.queryExecution().executedPlan().toString()) == (bound == 15)
