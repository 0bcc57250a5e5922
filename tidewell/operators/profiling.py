"""Counts over columns and tables: usage profiles, schema drift, reconciliation."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidewell.operators.layout import rank_global


def column_profile(df: DataFrame) -> DataFrame:
    """column_name, non_null, n_rows, usage_ratio (4 decimals; 0 for an empty table) of every column, in one pass."""
    if not df.columns:
        return df.sparkSession.createDataFrame([], "column_name string, non_null bigint, n_rows bigint, usage_ratio double")
    one = df.agg(F.count(F.lit(1)).alias("_n"), *[F.count(F.col(f"`{c}`")).alias(f"_{i}") for i, c in enumerate(df.columns)])
    each = F.explode(F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(f"_{i}").alias("non_null")) for i, c in enumerate(df.columns)]))
    rows = one.select(each.alias("p"), F.col("_n").alias("n_rows")).select("p.column_name", "p.non_null", "n_rows")
    return rows.withColumn("usage_ratio", F.when(F.col("n_rows") > 0, F.round(F.col("non_null") / F.col("n_rows"), 4)).otherwise(0.0))


def schema_drift(columns: DataFrame) -> DataFrame:
    """Of rows (source, column_name, type) each column and type: n_sources, n_types of the column and the sorted sources.

    A source that repeats a column counts once. Sources are files, so a list is bounded by their number.
    """
    each = columns.groupBy("column_name", "type").agg(F.sort_array(F.collect_set("source")).alias("sources"))
    types = columns.groupBy("column_name").agg(F.count_distinct("type").alias("n_types"))
    return each.withColumn("n_sources", F.size("sources").cast("bigint")).join(types, "column_name")


def histogram(df: DataFrame, column: str) -> DataFrame:
    """How often each value (an error message, say) occurs; null is a value."""
    return df.groupBy(column).agg(F.count("*").alias("n"))


def reconcile(source: DataFrame, output: DataFrame, keys: list[str]) -> DataFrame:
    """keys, source_n, output_n, status: ``ok``, ``short`` (rows were dropped) or ``over`` (more came out than went in)."""
    a = source.groupBy(*keys).agg(F.count("*").alias("a"))
    b = output.groupBy(*keys).agg(F.count("*").alias("b"))
    both = a.select(*keys, "a", F.lit(0).cast("bigint").alias("b")).unionByName(b.select(*keys, F.lit(0).cast("bigint").alias("a"), "b")).groupBy(*keys).agg(F.sum("a").alias("source_n"), F.sum("b").alias("output_n"))
    return both.withColumn("status", F.when(F.col("output_n") > F.col("source_n"), "over").when(F.col("output_n") < F.col("source_n"), "short").otherwise("ok"))


def weighted_usage(stats: DataFrame, by: list[str]) -> DataFrame:
    """by, usage: the mean usage weighted by size, of rows (by..., size, usage); 0 where the sizes sum to 0."""
    s = F.sum("size")
    return stats.groupBy(*by).agg(F.when(s > 0, F.round(F.sum(F.col("size") * F.col("usage")) / s, 6)).otherwise(0.0).alias("usage"))


def contiguity(df: DataFrame, group: str, number: str) -> DataFrame:
    """group, greatest, n_distinct, contiguous and the missing numbers of 1 .. greatest as text."""
    g = df.groupBy(group).agg(F.max(number).cast("bigint").alias("greatest"), F.count_distinct(number).alias("n_distinct"), F.sort_array(F.collect_set(F.col(number).cast("bigint"))).alias("_have"))
    missing = F.array_except(F.when(F.col("greatest") >= 1, F.sequence(F.lit(1).cast("bigint"), F.col("greatest"))).otherwise(F.array().cast("array<bigint>")), F.col("_have"))
    return g.select(group, "greatest", "n_distinct", (F.size(missing) == 0).alias("contiguous"), F.array_join(missing.cast("array<string>"), ",").alias("missing"))


def preview(df: DataFrame, group: str, name: str, first: int = 10) -> DataFrame:
    """group, n and preview: the first names in order, and how many more there are. A null name doesn't count.

    Each partition gives on its first names only, so a group's window never holds more than so many of each.
    """
    named = df.filter(F.col(name).isNotNull()).select(F.col(group).alias("_g"), F.col(name).cast("string").alias("_name"))
    top = named.withColumn("_k", F.row_number().over(Window.partitionBy("_g").orderBy("_name"))).filter(F.col("_k") <= first)
    names = top.groupBy("_g").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("_k", "_name"))), lambda x: x._name), ", ").alias("_names"))
    both = named.groupBy("_g").agg(F.count("*").alias("n")).join(names.withColumnRenamed("_g", "_h"), F.col("_g").eqNullSafe(F.col("_h")))
    more = F.when(F.col("n") > first, F.concat(F.lit(", ...and "), (F.col("n") - first).cast("string"), F.lit(" more"))).otherwise("")
    return both.select(F.col("_g").alias(group), "n", F.concat("_names", more).alias("preview"))


def by_frequency(df: DataFrame, n: str, ties: list[str]) -> DataFrame:
    """Adds place: 1 for the rarest, equals in order of ``ties``, ranked across range partitions."""
    return rank_global(df, [n, *ties])
