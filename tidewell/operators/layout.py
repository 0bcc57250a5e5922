"""Order, layout and merging of the wide tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidewell.operators.normalize import pad
from tidewell.schema import SORT_KEYS, master_schema
from tidewell.session import cut
from tidewell.sources.archives import catalog, footers

ROW_GROUP = 100_000


def order(keys: list[str] | None = None) -> list[Column]:
    """The sort keys ascending, nulls last."""
    return [F.col(k).asc_nulls_last() for k in keys or SORT_KEYS]


def sort_global(df: DataFrame, keys: list[str] | None = None, partitions: int | None = None) -> DataFrame:
    """The rows in order within partitions and from partition to partition.

    Range partitioning over all keys splits the rows of a hot leading key by the keys that follow it.
    """
    o = order(keys)
    ranged = df.repartitionByRange(partitions, *o) if partitions else df.repartitionByRange(*o)
    return ranged.sortWithinPartitions(*o)


def rank_global(df: DataFrame, keys: list[str], name: str = "place") -> DataFrame:
    """Adds each row's place, from 1, in the global order, without a task that holds all rows.

    Rows are placed within their range partition and moved on by the rows of the partitions before it; the table of
    partition sizes has a row for each partition. Rows equal in all keys are placed in any order.
    """
    o = order(keys)
    parted = cut(sort_global(df, keys).withColumn("_part", F.spark_partition_id()))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    sizes = parted.groupBy("_part").agg(F.count("*").alias("_n")).withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0))).drop("_n")
    own = parted.withColumn("_own", F.row_number().over(Window.partitionBy("_part").orderBy(*o)))
    return own.join(F.broadcast(sizes), "_part").withColumn(name, F.col("_before") + F.col("_own")).drop("_part", "_own", "_before")


def write_table(df: DataFrame, path: str, *, partition_by: list[str] | None = None, mode: str = "error") -> None:
    """zstd Parquet with bounded row groups; the order of df's partitions is the order of the files."""
    w = df.write.mode(mode).option("compression", "zstd").option("parquet.block.row.count.limit", str(ROW_GROUP))
    (w.partitionBy(*partition_by) if partition_by else w).parquet(path)


def union_by_name(frames: list[DataFrame]) -> DataFrame:
    """All rows of all frames; columns match by name and missing ones are null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def read_union(spark: SparkSession, paths: list[str], kind: str | None = None) -> DataFrame:
    """Parquet files of different columns as one table; with a kind, each is first brought to its schema, types included.

    Files of the same columns are read together, so the plan grows with the different schemas and not with the files.
    """
    if kind is None:
        return spark.read.option("mergeSchema", "true").parquet(*paths)
    alike: dict[str, list[str]] = {}
    files = [r["path"] for r in catalog(spark, paths, "*.parquet").select("path").collect()]
    rows = footers(spark.createDataFrame([(p,) for p in files], "path string")).filter("error IS NULL")
    for r in rows.groupBy("path").agg(F.to_json(F.sort_array(F.collect_list(F.struct("position", "column_name", "type")))).alias("s")).collect():
        alike.setdefault(r["s"], []).append(r["path"])
    return union_by_name([pad(spark.read.parquet(*p), master_schema(kind)) for p in alike.values()])


def merge(spark: SparkSession, paths: list[str], kind: str, out: str) -> dict[str, int]:
    """Merges sorted or unsorted tables of one kind to one sorted table, and compares the row counts of both sides."""
    rows_in = sum(spark.read.parquet(p).count() for p in paths)
    write_table(sort_global(read_union(spark, paths, kind)), out)
    rows_out = spark.read.parquet(out).count()
    if rows_in != rows_out:
        raise ValueError(f"{rows_in} rows were merged to {rows_out}")
    return {"rows_in": rows_in, "rows_out": rows_out}


def look_up(df: DataFrame, key: str, value) -> DataFrame:
    """The rows of one key; on a sorted table the footers' ranges leave few row groups to read."""
    return df.filter(F.col(key) == F.lit(value))
