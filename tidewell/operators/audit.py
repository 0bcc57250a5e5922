"""Audits of tables against the master columns and their manifests."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewell.functions.formats import record_kind
from tidewell.operators.profiling import column_profile
from tidewell.schema import EXTRA, MASTER


def _names(values: list[str]) -> Column:
    return F.array(*[F.lit(v) for v in values])


def master_columns(kind: Column) -> Column:
    return F.when(kind == "rc", _names(MASTER["rc"])).when(kind == "rs", _names(MASTER["rs"]))


def column_gaps(columns: Column, master: Column) -> tuple[Column, Column, Column]:
    """(missing, extra, has overflow) of an array of columns against a master array; the first two are sorted."""
    return F.array_sort(F.array_except(master, columns)), F.array_sort(F.array_except(columns, F.concat(master, F.array(F.lit(EXTRA))))), F.array_contains(columns, EXTRA)


def type_mismatches(stated: DataFrame, real: DataFrame) -> DataFrame:
    """filename, column_name, stated_type, real_type where both sides know a column and differ in its type."""
    a = stated.select("filename", "column_name", F.col("type").alias("stated_type"))
    return a.join(real.select("filename", "column_name", F.col("type").alias("real_type")), ["filename", "column_name"]).filter("stated_type != '' AND real_type != '' AND stated_type != real_type")


def _missing(which: Column, label: str) -> Column:
    return F.when(F.size(which) > 0, F.concat(F.lit(label + ": "), F.array_join(which, ", ")))


def verify(tables: DataFrame, manifests: DataFrame) -> DataFrame:
    """filename, status (ok, failed or skipped) and errors of each table.

    ``tables`` has filename and types, a map of column to type from its footer, or null where that couldn't be read;
    ``manifests`` has filename and types as stated, of types null where a manifest knows only names. Tables of no known
    kind are skipped. A table without a manifest fails, and one with neither footer nor manifest as well. conflicts and
    partial (see :func:`table_types`), where ``tables`` has them, are errors.
    """
    for c in ("conflicts", "partial"):
        tables = tables if c in tables.columns else tables.withColumn(c, F.array().cast("array<string>"))
    m = manifests.select("filename", F.col("types").alias("stated"), F.lit(True).alias("has"))
    t = tables.join(m, "filename", "left").withColumn("kind", record_kind(F.col("filename")))
    columns, stated, master = F.map_keys("types"), F.map_keys("stated"), master_columns(F.col("kind"))
    known = F.coalesce(columns, stated)
    missing, extra, has_extra = column_gaps(known, master)
    both = F.array_sort(F.array_intersect(columns, stated))
    differing = F.filter(both, lambda c: (F.col("stated")[c] != F.col("types")[c]) & (F.col("stated")[c] != "") & (F.col("types")[c] != ""))
    footer = F.col("types").isNotNull()
    errors = F.array_compact(
        F.array(
            F.when(known.isNull(), "no footer and no manifest"),
            _missing(missing, "missing columns"),
            _missing(extra, "unexpected columns"),
            F.when(~has_extra, f"no {EXTRA} column"),
            F.when(footer & F.col("has").isNull(), "no manifest"),
            F.when(footer, _missing(F.array_sort(F.array_except(columns, stated)), "not in the manifest")),
            F.when(footer, _missing(F.array_sort(F.array_except(stated, columns)), "only in the manifest")),
            F.when(footer, _missing(differing, "other types in the manifest")),
            F.when(footer, _missing(F.col("conflicts"), "several types")),
            F.when(footer, _missing(F.col("partial"), "not in all files")),
            F.when(footer & (F.col("types")["edited"] != "int64"), F.concat(F.lit("edited must be int64, is "), F.col("types")["edited"])),
        )
    )
    failed = F.size(errors) > 0
    out = t.withColumn("errors", F.when(F.col("kind").isNull(), F.array().cast("array<string>")).otherwise(errors))
    return out.select("filename", F.when(F.col("kind").isNull(), "skipped").when(failed, "failed").otherwise("ok").alias("status"), "errors")


def tally(verified: DataFrame) -> DataFrame:
    """status and n, and the total."""
    return verified.groupBy("status").agg(F.count("*").alias("n")).unionByName(verified.agg(F.lit("total").alias("status"), F.count("*").alias("n")))


def table_types(footers: DataFrame, by: str = "path") -> DataFrame:
    """filename, types (null if a footer couldn't be read), conflicts and partial from rows of footers.

    A table is one file or, with ``by``, all files of one name in that column. conflicts are the columns that have several
    types in its files, of which types gives all; partial those that some of its files lack.
    """
    each = footers.groupBy(by, "column_name").agg(F.array_sort(F.collect_set("type")).alias("kinds"), F.count_distinct("path").alias("n"), F.max("error").alias("e"))
    files = footers.groupBy(by).agg(F.count_distinct("path").alias("n_files"))
    there = F.col("column_name").isNotNull()
    names = lambda c: F.array_sort(F.collect_list(F.when(there & c, F.col("column_name"))))
    pairs = F.collect_list(F.when(there, F.struct("column_name", F.array_join("kinds", " and ").alias("type"))))
    one = each.join(files, by).groupBy(by).agg(pairs.alias("p"), F.max("e").alias("e"), names(F.size("kinds") > 1).alias("conflicts"), names(F.col("n") < F.col("n_files")).alias("partial"))
    return one.select(F.element_at(F.split(by, "/"), -1).alias("filename"), F.when(F.col("e").isNull(), F.map_from_entries("p")).alias("types"), "conflicts", "partial")


def build_manifests(footers: DataFrame, sizes: DataFrame) -> DataFrame:
    """Manifests from footers alone: path, filename, file_size, row_count, conversion_method, columns in order, schema.

    ``sizes`` has path, size and modified; unreadable files get no manifest.
    """
    ok = footers.filter("error IS NULL")
    pairs = F.sort_array(F.collect_list(F.when(F.col("column_name").isNotNull(), F.struct("position", "column_name", "type"))))
    each = ok.groupBy("path").agg(F.max("n_rows").alias("row_count"), pairs.alias("p")).join(sizes.select("path", "size", "modified"), "path")
    return each.select(
        "path", F.element_at(F.split("path", "/"), -1).alias("filename"), F.col("size").alias("file_size"), F.date_format("modified", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("last_modified"), "row_count", F.lit("regenerated").alias("conversion_method"),
        F.transform("p", lambda x: x.column_name).alias("columns"), F.map_from_entries(F.transform("p", lambda x: F.struct(x.column_name, x.type))).alias("schema"),
    )


def full_manifest(df: DataFrame) -> DataFrame:
    """column_stats of one table, as a manifest states them: a map of column to count and usage_ratio."""
    return column_profile(df).agg(F.max("n_rows").alias("row_count"), F.map_from_entries(F.collect_list(F.struct("column_name", F.struct(F.col("non_null").alias("count"), "usage_ratio")))).alias("column_stats"))
