import random
from collections import Counter, defaultdict

from conftest import rows

import tidewell.operators.skewed as skewed
from tidewell.operators.skewed import join_hot, key_profile, middle_ids, percentiles

SCHEMA = "k string, day int, v bigint, id string, n int, middle string"


def brute(table, least):
    ids = defaultdict(dict)
    for k, day, v, i, *_ in table:
        if None not in (k, day, v, i):
            ids[k][i] = min(ids[k].get(i, (v, day)), (v, day))
    slots = defaultdict(list)
    for k, own in ids.items():
        for i, (v, day) in own.items():
            slots[k, day].append((v, i))
    return sorted(((k, d, len(x), sorted(x)[(len(x) + 1) // 2 - 1][1]) for (k, d), x in slots.items() if len(x) >= least), key=repr)


def table(seed, values):
    r = random.Random(seed)
    t = []
    for j in range(900):
        day = r.randrange(3)
        t.append((r.choice(["hot"] * 6 + ["a", "b", ""]), day, 1000 * day + r.randrange(values), f"i{j}", None, "clash"))
    return t + t[:50] + [(None, 1, 1, "x", 1, ""), ("a", None, 1, "x", 1, ""), ("a", 1, None, "x", 1, ""), ("a", 1, 1, None, 1, "")]


def test_middle_ids(spark, monkeypatch):
    for values in (1, 3, 900):  # all ids share a value; many do; few do
        t = table(values, values)
        df = spark.createDataFrame(t, SCHEMA).repartition(3)
        want = brute(t, 20)
        assert rows(middle_ids(df, ["k"], "day", "v", "id", least=20)) == want
    for values in (1, 3):  # windows of five ids at most
        t = table(values, values)
        assert rows(middle_ids(spark.createDataFrame(t, SCHEMA).repartition(3), ["k"], "day", "v", "id", least=20, window_ids=5)) == brute(t, 20)
    monkeypatch.setattr(skewed, "BROADCAST_ROWS", 0)
    t = table(3, 3)
    assert rows(middle_ids(spark.createDataFrame(t, SCHEMA), ["k"], "day", "v", "id", least=1)) == brute(t, 1)
    assert middle_ids(spark.createDataFrame([], SCHEMA), ["k"], "day", "v", "id").count() == 0


def test_key_profile(spark):
    t = [*table(5, 4), ("nulls", 1, None, "a", 1, ""), ("nulls", 1, None, "b", 1, "")]
    want = []
    for k in {r[0] for r in t}:
        vs = [r[2] for r in t if r[0] == k]
        c = Counter(v for v in vs if v is not None)
        top = min(c, key=lambda v: (-c[v], v)) if c else None
        want.append((k, len(vs), len(c), top, c.get(top)))
    assert rows(key_profile(spark.createDataFrame(t, SCHEMA), ["k"], "v")) == sorted(want, key=repr)
    assert key_profile(spark.createDataFrame([], SCHEMA), ["k"], "v").count() == 0


def test_join_hot(spark, monkeypatch):
    """As a plain join, whichever way the hot keys (null among them) take."""
    left = spark.createDataFrame([(None if k % 3 == 0 else "hot" if k % 3 == 1 else f"k{k}", k) for k in range(600)], "k string, a int")
    right = spark.createDataFrame([("hot", 1), ("hot", 2), ("k2", 3), ("k5", 4), (None, 5), ("other", 6)], "k string, b int")
    for how in ("inner", "left"):
        want = rows(left.join(right, ["k"], how), "k", "a", "b")
        assert rows(join_hot(left, right, ["k"], how), "k", "a", "b") == want
        assert rows(join_hot(left, right, ["k"], how, hot_least=1), "k", "a", "b") == want
        monkeypatch.setattr(skewed, "BROADCAST_ROWS", 0)
        assert rows(join_hot(left, right, ["k"], how, hot_least=1), "k", "a", "b") == want
        monkeypatch.undo()
    assert join_hot(left.limit(0), right, ["k"]).count() == 0


def test_percentiles(spark):
    t = [*table(5, 40), ("nulls", 1, None, "a", 1, ""), ("one", 1, 7, "a", 1, "")]
    want = []
    for k in {r[0] for r in t}:
        v = sorted(r[2] for r in t if r[0] == k and r[2] is not None)
        if v:
            want.append((k, len(v), *(v[max(1, -(-len(v) * p // 100)) - 1] for p in (0, 25, 50, 99, 100))))
    got = percentiles(spark.createDataFrame(t, SCHEMA).repartition(3), ["k"], "v", [0, 25, 50, 99, 100])
    assert rows(got, "k", "n", "p0", "p25", "p50", "p99", "p100") == sorted(want, key=repr)
    assert percentiles(spark.createDataFrame([], SCHEMA), ["k"], "v", [50]).count() == 0
