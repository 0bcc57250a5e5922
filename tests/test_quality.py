import math
from collections import Counter

from conftest import rows

from tidewell.operators.quality import CountStore, load_changes, merge_counts, numeric_columns, profile, profile_history, shift, stated_deltas, value_counts

T1 = [("a", 1, [1]), ("a", None, None), ("", 3, [1]), (None, None, [])]
T2 = [("a", 1, [1]), ("b", 7, None)]
SCHEMA = "s string, n int, l array<int>"


def test_counts_deltas_and_profile(spark, tmp_path):
    a, b = spark.createDataFrame(T1, SCHEMA), spark.createDataFrame(T2, SCHEMA)
    whole = rows(value_counts(a.union(b)), "column_name", "value", "n")
    assert rows(merge_counts(value_counts(a), value_counts(b)), "column_name", "value", "n") == whole
    assert rows(merge_counts(value_counts(a.union(b)), value_counts(b, sign=-1)), "column_name", "value", "n") == rows(value_counts(a), "column_name", "value", "n")
    store = CountStore(spark, str(tmp_path / "counts"))
    store.apply("one", value_counts(a))
    store.apply("two", value_counts(b))
    store.apply("two", value_counts(b))  # a retry
    assert rows(store.state(), "column_name", "value", "n") == whole
    store.compact()
    assert rows(store.state(), "column_name", "value", "n") == whole and store.loads().select("load").distinct().count() == 1
    p = {r.column_name: r for r in profile(store.state(), {"s": "^[ab]$", "n": "^[0-9]$"}).collect()}
    s = Counter(r[0] for r in T1 + T2)
    given = {k: v for k, v in s.items() if k is not None}
    n = sum(given.values())
    entropy = -sum(v / n * math.log(v / n) for v in given.values())
    assert (p["s"].n_rows, p["s"].n_null, p["s"].n_distinct, p["s"].least, p["s"].top_value, p["s"].top_n, p["s"].n_violations) == (6, 1, 3, "", "a", 3, 1)
    assert abs(p["s"].entropy - entropy) < 1e-6 and (p["n"].least_number, p["n"].most_number) == (1, 7)
    d = {r.column_name: r.distance for r in shift(value_counts(a), value_counts(b)).collect()}
    assert abs(d["s"] - 0.5) < 1e-9 and shift(value_counts(a), value_counts(a)).filter("distance != 0").count() == 0
    assert value_counts(spark.createDataFrame([], SCHEMA)).count() == 0
    only = profile(value_counts(spark.createDataFrame([(None, None, None)], SCHEMA))).filter("column_name = 's'").first()
    assert (only.null_rate, only.entropy, only.least) == (1.0, 0.0, None)


def test_history(spark):
    loads = {"1": T1, "2": T2, "3": T1[:1]}
    deltas = None
    for k, t in loads.items():
        d = value_counts(spark.createDataFrame(t, SCHEMA)).selectExpr(f"'{k}' AS load", "column_name", "value", "n")
        deltas = d if deltas is None else deltas.unionByName(d)
    deltas = deltas.unionByName(value_counts(spark.createDataFrame(T2, SCHEMA), sign=-1).selectExpr("'4' AS load", "column_name", "value", "n"))
    got = {(r["load"], r.column_name): r for r in profile_history(deltas, "load").collect()}
    for k, t in (("1", T1), ("2", T1 + T2), ("3", T1 + T2 + T1[:1]), ("4", T1 + T1[:1])):
        want = {r.column_name: r for r in profile(value_counts(spark.createDataFrame(t, SCHEMA))).collect()}
        for c in ("s", "n", "l"):
            assert all(got[k, c][x] == want[c][x] for x in ("n_rows", "n_null", "null_rate", "n_distinct")) and abs(got[k, c].entropy - want[c].entropy) < 2e-6


def test_history_range_after_removals(spark):
    """Values come, go and come back, also within one load: the range is that of the values then there."""
    deltas = [("1", "m", 2), ("1", "p", 1), ("2", "a", 1), ("2", "z", 1), ("3", "a", -1), ("3", "q", 1), ("3", "q", -1), ("4", "z", -1), ("4", "a", 1), ("5", "a", -1), ("5", "m", -1), ("5", None, 1), ("6", "m", -1), ("6", "p", -1)]
    got = {r["load"]: (r.least, r.most, r.n_distinct) for r in profile_history(spark.createDataFrame([(k, "c", v, n) for k, v, n in deltas], "load string, column_name string, value string, n bigint"), "load").collect()}
    want = {}
    for k in "123456":
        now = {v for _, v, _ in deltas if v is not None and sum(n for j, w, n in deltas if w == v and j <= k) > 0}
        want[k] = (min(now, default=None), max(now, default=None), len(now))
    assert got == want


def test_history_numbers_and_shift(spark):
    """Ranges of numbers go by number, also after a removal; shift is the distance between the states of two loads."""
    t = [("1", "9", 1), ("1", "80", 2), ("1", "x", 1), ("2", "100", 3), ("3", "100", -3), ("3", "9", -1), ("4", None, 2), ("5", "80", -2), ("5", "x", -1), ("5", None, -2), ("6", "7", 1)]
    deltas = spark.createDataFrame([(k, "c", v, n) for k, v, n in t], "load string, column_name string, value string, n bigint")
    got = {r["load"]: r for r in profile_history(deltas, "load", numeric=["c"]).collect()}
    state, before = Counter(), None
    for k in "123456":
        for j, v, n in t:
            if j == k:
                state[v] += n
        held = {v: n for v, n in state.items() if n}
        numbers = sorted((float(v), v) for v in held if v and v.isdigit())
        assert (got[k].least if numbers else None, got[k].most if numbers else None) == ((held.get("x") and "x" or numbers[0][1]) if numbers else None, numbers[-1][1] if numbers else None)
        if before is not None:
            na, nb = sum(held.values()), sum(before.values())
            want = sum(abs(held.get(v, 0) / na - before.get(v, 0) / nb) for v in {*held, *before}) / 2 if na and nb else float((na == 0) != (nb == 0))
            assert abs(got[k]["shift"] - want) < 1e-4, k
        else:
            assert got[k]["shift"] is None
        before = held
    assert numeric_columns(spark.createDataFrame([], "a int, b string, c decimal(3,1), d boolean")) == ["a", "c"]


def test_store_of_several_tables(spark, tmp_path):
    store = CountStore(spark, str(tmp_path / "s"), "t string", "note int")
    schema = "load string, t string, column_name string, value string, n bigint, note int"
    store.apply_all(spark.createDataFrame([("a/1", "x", "c", "v", 2, 1), ("b", "x", "c", "v", -1, 2), ("b", "y", "c", None, 1, 3)], schema))
    store.apply_all(spark.createDataFrame([("b", "y", "c", None, 4, 3)], schema))  # b anew; a/1 stays
    assert rows(store.loads(), "load", "t", "value", "n", "note") == sorted([("a/1", "x", "v", 2, 1), ("b", "y", None, 4, 3)], key=repr)
    assert rows(store.state(), "t", "value", "n") == sorted([("x", "v", 2), ("y", None, 4)], key=repr)


LOADS = "series string, load string, row_count bigint, column_stats map<string,struct<count:bigint,usage_ratio:double>>, issue int"


def test_load_changes(spark, tmp_path):
    t = [
        ("f", "1", 100, {"ok": (50, 0.5), "gone": (100, 1.0), "shift": (10, 0.1), "bad_before": (101, 1.0), "*": (1, 0.01)}, 0),
        ("f", "2", 201, {"ok": (101, 0.5025), "shift": (80, 0.398), "bad_before": (201, 1.0), "neg": (-1, 0.0), "null": (None, 0.5), "ratio": (100, None), "off": (100, 0.49), "above": (202, 1.0), "*": (2, 0.01)}, 0),
        ("f", "3", None, {"ok": (1, 0.5), "*": (2, 0.01)}, 0),
        ("f", "4", 10, {"ok": (11, 0.5), "back": (5, 0.5), "*": (0, 0.0)}, 0),
        ("f", "5", 10, {"ok": (9, 0.9), "back": (5, 0.5), "*": (3, 0.3)}, 0),
        ("z", "1", 0, {"a": (0, 0.0)}, 0),
        ("z", "2", 10, {"a": (10, 1.0)}, 0),
        ("e", "1", 5, {}, 0),
        ("n", "1", 5, None, 0),
    ]

    def changes(data, name):
        store = CountStore(spark, str(tmp_path / name), "series string", "usage_ratio double")
        store.apply_all(stated_deltas(spark.createDataFrame(data, LOADS), "series", "load"))
        return load_changes(store), store

    got, store = changes(t, "a")
    assert rows(got) == sorted([
        ("f", "1", "bad_before", "count_range"), ("f", "2", "gone", "column_gone"), ("f", "2", "shift", "share_shift"), ("f", "2", "neg", "count_range"), ("f", "2", "null", "count_range"), ("f", "2", "ratio", "ratio_off"), ("f", "2", "off", "ratio_off"), ("f", "2", "above", "count_range"), ("f", "2", "*", "rows_jump"),
        *(("f", "3", c, "column_gone") for c in ("shift", "bad_before", "neg", "null", "ratio", "off", "above")), ("f", "4", "ok", "count_range"), ("f", "5", "*", "share_shift"), ("z", "2", "a", "share_shift"), ("z", "2", "*", "rows_jump"),
    ], key=repr)
    # What the store holds in the end is the last load of each series.
    assert rows(store.state().filter("series = 'f' AND column_name = 'ok'"), "value", "n") == sorted([("given", 9), (None, 1), ("stated", 1)], key=repr)
    # A store without the deltas finds nothing: the rows come from the maintained counts.
    assert changes([], "b")[0].count() == 0
