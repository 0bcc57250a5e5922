from datetime import UTC, datetime

import pytest
from conftest import rows
from pyspark.sql import functions as F

from tidewell.llm.bitmaps import estimate, merge, sketch
from tidewell.llm import queries
from tidewell.llm.queries import p7_estimates, p7_found


def test_error_is_as_stated(spark):
    """Of 120 groups of each size, nearly all estimates lie within three standard errors, and the mean is right."""
    for n in (1, 30, 500, 5_000, 40_000):
        groups = 120 if n < 40_000 else 30
        df = spark.range(n * groups).select((F.col("id") % groups).alias("g"), F.concat(F.lit(f"{n}/"), "id").alias("item"))
        got = estimate(sketch(df, ["g"], "item"), ["g"]).collect()
        assert len(got) == groups
        far = sum(abs(r.estimate - n) > 3 * r.std_error + 0.5 for r in got)
        assert far <= groups * 0.03 + 1
        assert abs(sum(r.estimate for r in got) / groups / n - 1) < 0.02
        assert max(r.std_error for r in got) < 0.05 * n + 0.5


def test_merge_is_union(spark):
    df = spark.range(3000).select((F.col("id") % 5).alias("day"), (F.col("id") % 3).alias("g"), (F.col("id") % 700).alias("item"), F.lit(1).alias("level"), F.lit("x").alias("bits"))
    a, b = df.filter("item < 400"), df.filter("item >= 300")
    parts = merge(sketch(a, ["day", "g"], "item").unionByName(sketch(b, ["day", "g"], "item")), ["day"])
    assert rows(parts) == rows(sketch(a.union(b), ["day"], "item"))
    assert rows(sketch(df.union(df), [], "item")) == rows(merge(sketch(df, ["day"], "item"), []))


def test_nulls_and_empty(spark):
    df = spark.createDataFrame([("a", None), (None, "x"), (None, "x"), ("b", "")], "g string, item string")
    assert [(r.g, round(r.estimate)) for r in estimate(sketch(df, ["g"], "item"), ["g"]).orderBy("g").collect()] == [(None, 1), ("b", 1)]
    assert sketch(df.limit(0), ["g"], "item").count() == 0
    with pytest.raises(ValueError):
        sketch(df, ["g"], "item", bits=100)


def test_both_families_of_estimates(spark, tmp_path):
    """Every combination of both families comes out, each estimate within its error of the exact number."""
    t0, n = 1_600_000_000, 3000
    table = [(f"a{i * i % 211}", f"s{i % 17}", f"c{i}", t0 + i * 97) for i in range(n)] + [("big", f"s{i}", f"b{i}", t0) for i in range(400)]
    table += [("[deleted]", "s1", "d1", t0), (None, "s1", "d2", t0), ("a1", None, "d3", t0), ("a1", "s1", "d4", None)]
    spark.createDataFrame(table, "author string, subreddit string, id string, created_utc bigint").write.parquet(f"{tmp_path}/master_schema_rc.parquet")
    exact = {}
    for author, subreddit, _, t in table[: n + 400]:
        day = datetime.fromtimestamp(t, UTC).strftime("%Y-%m-%d")
        for counted, item, key in (("author", author, (subreddit, None)), ("subreddit", subreddit, (None, author))):
            for k in ((day, *key), (day, None, None), (None, *key), (None, None, None)):
                exact.setdefault((counted, *k), set()).add(item)
    got = p7_estimates(spark, str(tmp_path)).collect()
    assert len(got) == len(exact)
    of = {(r.counted, r.utc_day, r.subreddit, r.author): r for r in got}
    assert set(of) == set(exact)
    assert all(abs(of[k].estimate - len(v)) <= 4 * of[k].std_error + 1 for k, v in exact.items())
    assert of["subreddit", "2020-09-13", None, "big"].std_error > 0


def test_found_near_and_far_from_the_limits(spark, tmp_path, monkeypatch):
    """Keys just above and below every limit and far from it, with the exact count by broadcast and by shuffle."""
    t0 = 1_600_000_000
    table, want = [], set()
    for n in (*range(25, 60), 200, 400):  # ids of a subreddit by one author, and by just too many
        for authors in (1, n // 5, n // 5 + 1):
            s = f"s{n}-{authors}"
            table += [(f"{s}a{i % authors}", s, f"{s}i{i}", t0) for i in range(n)]
            if n >= 40 and 5 * authors < n:
                want.add(("subreddit", s, "2020-09-13"))
        table += [(f"w{n}", f"w{n}s{i}", f"w{n}i{i}", t0) for i in range(n)]
        if n >= 30:
            want.add(("author", f"w{n}", "2020-09-13"))
    spark.createDataFrame(table, "author string, subreddit string, id string, created_utc bigint").write.parquet(f"{tmp_path}/master_schema_rc.parquet")
    counted = []
    real = queries.cut
    monkeypatch.setattr(queries, "cut", lambda df: counted.append(real(df)) or counted[-1])
    for bound in (50_000, 0):
        monkeypatch.setattr(queries, "BROADCAST_ROWS", bound)
        assert set(rows(p7_found(spark, str(tmp_path)), "grain", "key_value", "utc_day")) == want
    assert counted[0].filter("clear").count() > 5 and counted[0].filter("NOT clear").count() > 5
