"""Column-level quality profiles from maintained value counts.

The state of a table is one row (column_name, value, n) for each distinct value of each column. A load changes it by
signed counts: +n for values it adds, -n for values it takes away. Profiles are derived from the counts alone, so a load
costs what it brings, not what is there already.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewell.session import cut

COUNTS = "column_name string, value string, n bigint"


def value_counts(df: DataFrame, columns: list[str] | None = None, by: list[str] | None = None, sign: int = 1, weight: str | None = None) -> DataFrame:
    """(by..., column_name, value, n): counts of the values, as text, of each column; null is a value. ``sign`` -1: a removal.

    ``weight`` names a column that says how often a row counts, and with which sign; it isn't counted itself. Nested
    columns count by their JSON text. An empty table has no values. Partial aggregation shrinks hot values before the
    shuffle, and the shuffle spreads a column by its values.
    """
    by = by or []
    names = columns if columns is not None else [c for c in df.columns if c not in by and c != weight]
    kinds = dict(df.dtypes)
    text = [F.to_json(c) if kinds[c].startswith(("struct", "array", "map")) else F.col(f"`{c}`").cast("string") for c in names]
    pairs = F.explode(F.array(*[F.struct(F.lit(c).alias("column_name"), t.alias("value")) for c, t in zip(names, text, strict=True)]))
    if not names:
        return df.sparkSession.createDataFrame([], COUNTS)
    times = F.col(weight).cast("bigint") if weight else F.lit(1).cast("bigint")
    rows = df.select(*by, (times * sign).alias("_w"), pairs.alias("_p")).select(*by, "_w", "_p.column_name", "_p.value")
    return rows.groupBy(*by, "column_name", "value").agg(F.sum("_w").alias("n"))


def numeric_columns(df: DataFrame) -> list[str]:
    """The columns whose values are ordered as numbers."""
    return [f.name for f in df.schema if isinstance(f.dataType, T.NumericType)]


def merge_counts(*states: DataFrame) -> DataFrame:
    """The sum of value counts and signed deltas; values that are gone (n 0) leave no row."""
    both = states[0]
    for s in states[1:]:
        both = both.unionByName(s)
    keys = [c for c in both.columns if c != "n"]
    return both.groupBy(*keys).agg(F.sum("n").alias("n")).filter("n != 0")


class CountStore:
    """Value counts kept as Parquet in a shared folder, one folder per load within a generation.

    ``keys`` are columns, as DDL, that tell apart tables kept in one store; ``notes`` are stored with a delta and play no
    part in the counts. Applying a load again replaces its folder, so a retry after a lost executor or driver changes
    nothing. Compaction writes the next generation whole before it counts, so a reader never sees a load twice or not at
    all; it drops the notes.
    """

    def __init__(self, spark: SparkSession, path: str, keys: str = "", notes: str = ""):
        self.spark, self.path = spark, path
        self.schema = ", ".join(x for x in (keys, COUNTS, notes) if x)
        self.notes = T.StructType.fromDDL(notes).names if notes else []
        self._jpath = spark._jvm.org.apache.hadoop.fs.Path
        self._fs = self._jpath(path).getFileSystem(spark._jsc.hadoopConfiguration())

    def _generations(self) -> list[int]:
        if not self._fs.exists(self._jpath(self.path)):
            return [0]
        found = [int(s.getPath().getName().removeprefix("gen=")) for s in self._fs.listStatus(self._jpath(self.path))]
        return sorted({0, *(g for g in found if self._fs.exists(self._jpath(f"{self.path}/gen={g}/load=base/_SUCCESS")))})

    def apply(self, load: str, delta: DataFrame) -> None:
        """Adds the signed counts of one load, or replaces them."""
        self.apply_all(delta.withColumn("load", F.lit(load)))

    def apply_all(self, deltas: DataFrame) -> None:
        """The same for several loads at once, told apart by the column ``load``; other loads stay as they are."""
        columns = T.StructType.fromDDL(self.schema).names
        deltas.select(*columns, "load").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("compression", "zstd").partitionBy("load").parquet(f"{self.path}/gen={self._generations()[-1]}")

    def loads(self) -> DataFrame:
        """The deltas of every load kept apart: the counts' columns and load."""
        now = f"{self.path}/gen={self._generations()[-1]}"
        return self.spark.read.schema(self.schema + ", load string").option("basePath", now).parquet(now)

    def state(self) -> DataFrame:
        return merge_counts(self.loads().drop("load", *self.notes))

    def compact(self) -> None:
        """Sums all loads to one, ``base``, in a new generation, and removes the old ones."""
        now = self._generations()[-1]
        self.state().write.mode("overwrite").parquet(f"{self.path}/gen={now + 1}/load=base")
        for g in range(now + 1):
            self._fs.delete(self._jpath(f"{self.path}/gen={g}"), True)


def profile(counts: DataFrame, patterns: Mapping[str, str] | None = None, by: list[str] | None = None) -> DataFrame:
    """One row per column: n_rows, n_null, null_rate, n_distinct, least, most, least_number, most_number, entropy (nats, of the
    non-null values), top_value, top_n and n_violations, the rows whose value doesn't match the column's pattern.

    Of values equally frequent the least is on top. A column of nulls only has no range and entropy 0.
    """
    by = by or []
    ok: Column = F.lit(True)
    for name, pattern in (patterns or {}).items():
        ok = F.when(F.col("column_name") == name, F.col("value").rlike(pattern)).otherwise(ok)
    there = F.col("value").isNotNull()
    number = F.expr("try_cast(value AS double)")
    given = F.sum(F.when(there, F.col("n")).otherwise(0))
    agg = counts.groupBy(*by, "column_name").agg(
        F.sum("n").alias("n_rows"), F.sum(F.when(~there, F.col("n")).otherwise(0)).alias("n_null"), F.count("value").alias("n_distinct"), F.min("value").alias("least"), F.max("value").alias("most"), F.min(number).alias("least_number"), F.max(number).alias("most_number"),
        F.sum(F.when(there, F.col("n") * F.log(F.col("n").cast("double")))).alias("_nlogn"), given.alias("_given"), F.min(F.when(there, F.struct((-F.col("n")).alias("n"), F.col("value").alias("v")))).alias("_top"), F.sum(F.when(there & ~ok, F.col("n")).otherwise(0)).alias("n_violations"),
    )
    entropy = F.when(F.col("_given") > 0, F.greatest(F.lit(0.0), F.log(F.col("_given").cast("double")) - F.col("_nlogn") / F.col("_given"))).otherwise(0.0)
    return agg.select(*by, "column_name", "n_rows", "n_null", F.round(F.col("n_null") / F.col("n_rows"), 6).alias("null_rate"), "n_distinct", "least", "most", "least_number", "most_number", F.round(F.abs(entropy), 6).alias("entropy"), F.col("_top.v").alias("top_value"), (-F.col("_top.n")).alias("top_n"), "n_violations")


def profile_history(deltas: DataFrame, load: str, patterns: Mapping[str, str] | None = None, numeric: list[str] | None = None) -> DataFrame:
    """The profile of each column after each load, in order of ``load``, from the signed counts (load, column_name, value, n).

    Each delta turns one maintained count into another, and with it the sums that the metrics are made of: rows, nulls,
    distinct values, n ln n and violations. Summed by load and column these changes run on over the loads, so the cost
    is that of the deltas. The windows hold a value's loads and a column's loads, never its values. least and most are
    of the values whose count is above 0 then, by number for the ``numeric`` columns (what is no number comes first) and by text for others: running ones
    of those that stay, and of those removed later, reduced to one row for each pair of loads between which some were
    there, by a join on the loads. shift is the distance (see :func:`shift`) from the load before, null for a column's
    first: values that a load leaves as they are count together, by what is left of the rows. Columns: load, column_name,
    n_rows, n_null, null_rate, n_distinct, least, most, entropy, n_violations, shift.
    """
    ok: Column = F.lit(True)
    for name, pattern in (patterns or {}).items():
        ok = F.when(F.col("column_name") == name, F.col("value").rlike(pattern)).otherwise(ok)
    there = F.col("value").isNotNull()
    one = Window.partitionBy("column_name", "value").orderBy(load).rowsBetween(Window.unboundedPreceding, 0)
    now = F.col("_now")
    before = now - F.col("n")
    nlogn = lambda x: F.when(x > 0, x * F.log(x.cast("double"))).otherwise(0.0)
    number = F.when(F.col("column_name").isin(numeric or []), F.expr("try_cast(value AS double)"))
    ranked = F.struct(number.alias("number"), F.col("value").alias("value"))
    each = deltas.withColumn("_now", F.sum("n").over(one)).withColumn("_end", F.min(F.when(now <= 0, F.col(load))).over(one.rowsBetween(1, Window.unboundedFollowing)))
    each = cut(each)
    starts, stays = there & (now > 0) & (before <= 0), F.col("_end").isNull()
    step = each.groupBy(load, "column_name").agg(
        F.sum("n").alias("n_rows"), F.sum(F.when(there, 0).otherwise(F.col("n"))).alias("n_null"), F.sum(F.when(there, (now > 0).cast("int") - (before > 0).cast("int")).otherwise(0)).alias("n_distinct"),
        F.sum(F.when(there, nlogn(now) - nlogn(before)).otherwise(0.0)).alias("_nlogn"), F.sum(F.when(there & ~ok, F.col("n")).otherwise(0)).alias("n_violations"), F.min(F.when(starts & stays, ranked)).alias("least"), F.max(F.when(starts & stays, ranked)).alias("most"),
    )
    passing = each.filter(starts & ~stays).groupBy(F.col("column_name").alias("_c"), F.col(load).alias("_from"), "_end").agg(F.min(ranked).alias("_least"), F.max(ranked).alias("_most"))
    during = (F.col("column_name") == F.col("_c")) & (F.col(load) >= F.col("_from")) & (F.col(load) < F.col("_end"))
    passing = each.select(load, "column_name").distinct().join(passing, during).groupBy(load, "column_name").agg(F.min("_least").alias("_least"), F.max("_most").alias("_most"))
    column = Window.partitionBy("column_name").orderBy(load)
    upto = column.rowsBetween(Window.unboundedPreceding, 0)
    run = step.select(load, "column_name", F.row_number().over(column).alias("_k"), F.col("n_rows").alias("_more"), *[F.sum(c).over(upto).alias(c) for c in ("n_rows", "n_null", "n_distinct", "_nlogn", "n_violations")], F.min("least").over(upto).alias("least"), F.max("most").over(upto).alias("most"))
    run = cut(run.join(passing, [load, "column_name"], "left").withColumns({"least": F.least("least", "_least"), "most": F.greatest("most", "_most")}))
    # The distance in whole numbers, over twice the product of the rows of both loads: of the values that a load changes one
    # by one, of the others, n in all, n times the difference of the rows.
    whole = lambda x: x.cast("decimal(19,0)")
    sizes = run.select(load, "column_name", whole(F.col("n_rows")).alias("_na"), whole(F.col("n_rows") - F.col("_more")).alias("_nb")).filter("_na > 0 AND _nb > 0")
    moved = each.join(sizes, [load, "column_name"]).groupBy(load, "column_name", "_na", "_nb").agg(F.sum(F.abs(whole(now) * F.col("_nb") - whole(before) * F.col("_na"))).alias("_d"), whole(F.sum(before)).alias("_b"))
    moved = moved.select(load, "column_name", F.round((F.col("_d") + (F.col("_nb") - F.col("_b")) * F.abs(F.col("_nb") - F.col("_na"))).cast("double") / (F.col("_na") * F.col("_nb") * 2).cast("double"), 4).alias("shift"))
    run = run.join(moved, [load, "column_name"], "left")
    given = F.col("n_rows") - F.col("n_null")
    entropy = F.when(given > 0, F.greatest(F.lit(0.0), F.log(given.cast("double")) - F.col("_nlogn") / given)).otherwise(0.0)
    return run.select(load, "column_name", "n_rows", "n_null", F.round(F.try_divide("n_null", "n_rows"), 6).alias("null_rate"), "n_distinct", F.col("least.value").alias("least"), F.col("most.value").alias("most"), F.round(F.abs(entropy), 6).alias("entropy"), "n_violations", F.when(F.col("_k") > 1, F.coalesce("shift", F.when((F.col("n_rows") == 0) != (F.col("n_rows") == F.col("_more")), 1.0).otherwise(0.0))).alias("shift"))


def shift(before: DataFrame, after: DataFrame) -> DataFrame:
    """column_name and distance: half the sum of the differences of the values' shares, from 0 (same) to 1 (nothing in common).

    A column that only one of them has is at distance 1.
    """
    signed = before.select("column_name", "value", F.col("n").alias("b"), F.lit(0).cast("bigint").alias("a")).unionByName(after.select("column_name", "value", F.lit(0).cast("bigint").alias("b"), F.col("n").alias("a")))
    each = signed.groupBy("column_name", "value").agg(F.sum("b").alias("b"), F.sum("a").alias("a"))
    total = each.groupBy("column_name").agg(F.sum("b").alias("nb"), F.sum("a").alias("na"))
    share = lambda x, n: F.when(F.col(n) > 0, F.col(x) / F.col(n)).otherwise(0.0)
    gap = each.join(total, "column_name").groupBy("column_name").agg(F.sum(F.abs(share("a", "na") - share("b", "nb"))).alias("d"), F.first("nb").alias("nb"), F.first("na").alias("na"))
    return gap.select("column_name", F.when((F.col("nb") == 0) | (F.col("na") == 0), 1.0).otherwise(F.round(F.col("d") / 2, 6)).alias("distance"))


#: Values that stated loads are counted by, besides null: rows in which a column is given, loads that state it, loads whose
#: statement lacks the count, and loads without a row_count.
GIVEN, STATED, UNCOUNTED, UNBOUNDED = "given", "stated", "uncounted", "unbounded"


def stated_deltas(loads: DataFrame, series: str, load: str) -> DataFrame:
    """The signed value counts (series, load, column_name, value, n, usage_ratio) by which each load of a series changes them.

    ``loads`` has series, load, row_count and column_stats, one row per load; the statement of a load takes the place of
    the one before in its series. A column's values are known as ``given`` or null, so its counts are those two, beside
    what says whether and how it is stated; the load as a whole is the null column_name, with its rows as given. A column
    that a load states has a row for ``given`` even where the count stays. usage_ratio is the load's own, as stated.
    """
    following = F.lead(load).over(Window.partitionBy(series).orderBy(load))
    move = lambda at, sign: F.struct(F.col(at).alias("load"), F.lit(sign).cast("bigint").alias("sign"))
    moves = F.filter(F.array(move("load", 1), move("following", -1)), lambda m: m["load"].isNotNull())
    whole = F.struct(F.lit(None).cast("string").alias("column_name"), F.col("row_count").alias("count"), F.lit(None).cast("double").alias("usage_ratio"))
    stats = F.transform(F.map_entries("column_stats"), lambda e: F.struct(e["key"].alias("column_name"), e["value"]["count"].alias("count"), e["value"]["usage_ratio"].alias("usage_ratio")))
    cells = F.concat(F.array(whole), F.coalesce(stats, F.array().cast("array<struct<column_name:string,count:bigint,usage_ratio:double>>")))
    # A statement counts at its own load and against it at the following one. All of a series is in one partition by now,
    # so the sums need no shuffle. Neither array is ever empty, and the outer form spares a filter that makes them twice.
    each = loads.select(F.col(series).alias("series"), F.col(load).alias("load"), "row_count", "column_stats", following.alias("following")).select("series", "row_count", cells.alias("cells"), F.explode_outer(moves).alias("m"))
    each = each.select("series", "m.load", "m.sign", "row_count", F.explode_outer("cells").alias("c")).select("series", "load", "sign", "row_count", "c.*")
    column, counted, bounded = F.col("column_name").isNotNull(), F.col("count").isNotNull(), F.col("row_count").isNotNull()
    total = lambda c: F.sum(c * F.col("sign"))
    flag = lambda c: F.when(c, 1).otherwise(0)
    sums = each.groupBy("series", "load", "column_name").agg(
        total(F.coalesce("count", F.lit(0))).alias(GIVEN), total(F.when(column & counted & bounded, F.col("row_count") - F.col("count")).otherwise(0)).alias("rest"), total(F.lit(1)).alias(STATED), total(flag(column & ~counted)).alias(UNCOUNTED), total(flag(~bounded)).alias(UNBOUNDED),
        F.max(F.when(F.col("sign") == 1, F.col("usage_ratio"))).alias("usage_ratio"),
    )
    value = lambda v, c, always=False: F.when(F.lit(always) | (F.col(c) != 0), F.struct(F.lit(v).cast("string").alias("value"), F.col(c).alias("n")))
    values = F.array_compact(F.array(value(GIVEN, GIVEN, True), value(None, "rest"), *[value(v, v) for v in (STATED, UNCOUNTED, UNBOUNDED)]))
    return sums.select("series", "load", "column_name", "usage_ratio", F.explode(values).alias("v")).select("series", "load", "column_name", "v.value", "v.n", "usage_ratio")


def load_changes(store: CountStore) -> DataFrame:
    """Wrong figures and changes of stated loads: (series, load, column_name, issue), from the store of :func:`stated_deltas`.

    The counts after each load are the running sums of the deltas of its series and column, which the window holds: a
    column's loads. A count is out of range if it is missing or makes a value's count negative. A load without a
    row_count bounds no count and gives no share; of zero rows every share is 0. Null or empty column_stats state no
    column. column_name is ``*`` for the load as a whole.
    """
    own = Window.partitionBy("series", "column_name").orderBy("load")
    total = lambda v: F.sum(F.when(F.col("value").eqNullSafe(F.lit(v)), F.col("n")).otherwise(0)).over(own.rangeBetween(Window.unboundedPreceding, 0))
    after = store.loads().withColumns({"given": total(GIVEN), "rest": total(None), "is_stated": total(STATED) > 0, "uncounted": total(UNCOUNTED), "unbounded": total(UNBOUNDED)}).filter(F.col("value") == GIVEN)
    bad = (F.col("uncounted") > 0) | (F.col("given") < 0) | (F.col("rest") < 0)
    n = F.col("given") + F.col("rest")
    share = F.when(F.col("unbounded") > 0, None).when(n == 0, 0.0).otherwise(F.try_divide(F.col("given"), n))
    state = after.select("series", "load", "column_name", "usage_ratio", "is_stated", "given", "unbounded", F.when(~bad, share).alias("share"), bad.alias("bad"))
    was = lambda c: F.lag(c).over(own)
    both = state.withColumns({"stated_before": F.coalesce(was("is_stated"), F.lit(False)), "share_before": was("share"), "rows_before": F.when(was("unbounded") == 0, was("given")), "rows": F.when(F.col("unbounded") == 0, F.col("given"))})
    column, there, before = F.col("column_name").isNotNull(), F.col("is_stated"), F.col("stated_before")
    fine = column & there & ~F.col("bad")
    issues = F.array_compact(
        F.array(
            F.when(column & there & F.col("bad"), "count_range"),
            F.when(fine & F.coalesce(F.abs(F.col("usage_ratio") - F.col("share")) > 0.0005, F.col("usage_ratio").isNull()), "ratio_off"),
            F.when(fine & before & (F.abs(F.col("share") - F.col("share_before")) > 0.2), "share_shift"),
            F.when(column & ~there & before, "column_gone"),
            F.when(~column & there & before & ((F.col("rows") > 2 * F.col("rows_before")) | (2 * F.col("rows") < F.col("rows_before"))), "rows_jump"),
        )
    )
    return both.select("series", "load", F.coalesce("column_name", F.lit("*")).alias("column_name"), F.explode(issues).alias("issue"))
