"""Progress and throughput from processing metadata."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewell.functions.formats import archive_name, archive_part, stamp

#: MB per minute where nothing was observed, and the factor of the cautious estimate.
STATIC_MB_PER_MIN, CAUTION = 1.5 * 1024, 1.25
GIB, MIB = float(2**30), float(2**20)


def status(archives: DataFrame, done: DataFrame) -> DataFrame:
    """One row: total_bytes, done_bytes, pending_bytes, done_share (percent, 1 decimal), total_files, done_files, file_share.

    ``archives`` has name and size, ``done`` the names that have a manifest. Shares of nothing are null.
    """
    marked = archives.join(done.select("name").distinct().withColumn("done", F.lit(True)), "name", "left")
    is_done = F.col("done").eqNullSafe(F.lit(True))
    s = marked.agg(F.coalesce(F.sum("size"), F.lit(0)).alias("total_bytes"), F.coalesce(F.sum(F.when(is_done, F.col("size"))), F.lit(0)).alias("done_bytes"), F.count("*").alias("total_files"), F.count(F.when(is_done, 1)).alias("done_files"))
    share = lambda a, b: F.round(F.try_divide(F.col(a) * 100.0, F.col(b)), 1)
    return s.select("total_bytes", "done_bytes", (F.col("total_bytes") - F.col("done_bytes")).alias("pending_bytes"), share("done_bytes", "total_bytes").alias("done_share"), "total_files", "done_files", share("done_files", "total_files").alias("file_share"))


def timeline(months: DataFrame) -> DataFrame:
    """kind, year, months: twelve marks, X done, . there, - absent, of rows (kind, year, month, done)."""
    mark = [F.coalesce(F.max(F.when(F.col("month") == m, F.when(F.col("done"), "X").otherwise("."))), F.lit("-")) for m in range(1, 13)]
    return months.groupBy("kind", "year").agg(F.concat_ws(" ", *mark).alias("months"))


def archive_months(archives: DataFrame, done: DataFrame) -> DataFrame:
    """Rows for :func:`timeline` from archive names; other names are left out."""
    a = archives.join(done.select("name").distinct().withColumn("done", F.lit(True)), "name", "left")
    n = F.col("name")
    return a.select(archive_part(n, 1).alias("kind"), archive_part(n, 2).cast("int").alias("year"), archive_part(n, 3).cast("int").alias("month"), F.coalesce("done", F.lit(False)).alias("done")).filter("kind IS NOT NULL")


def runs(manifests: DataFrame, archives: DataFrame) -> DataFrame:
    """machine, ip, dl_s, conv_s, up_s, archive_bytes, table_bytes of each manifest that has a history; absent figures are 0."""
    stage = lambda s: F.coalesce(F.col("conversion_history.stages")[s]["duration_sec"], F.lit(0.0))
    h = manifests.filter("conversion_history IS NOT NULL").select(
        F.coalesce("conversion_history.machine.machine", F.lit("Unknown")).alias("machine"), F.coalesce("conversion_history.machine.ip", F.lit("Unknown")).alias("ip"), stage("download").alias("dl_s"), stage("conversion").alias("conv_s"), stage("upload").alias("up_s"),
        archive_name(F.col("filename")).alias("name"), F.coalesce("file_size", F.lit(0)).alias("table_bytes"),
    )
    return h.join(archives.select("name", F.col("size").alias("archive_bytes")), "name", "left").withColumn("archive_bytes", F.coalesce("archive_bytes", F.lit(0))).drop("name")


def machine_stats(rows: DataFrame) -> DataFrame:
    """Sums and rates of each machine, of rows as :func:`runs` gives them. Rates over nothing are 0."""
    pos = lambda c, v: F.sum(F.when(F.col(c) > 0, F.col(v)).otherwise(0))
    conv = (F.col("conv_s") != 0) & (F.col("archive_bytes") > 0)
    s = rows.groupBy("machine").agg(
        F.count("*").alias("n"), pos("dl_s", "dl_s").alias("dl_s"), pos("dl_s", "archive_bytes").alias("dl_bytes"), pos("up_s", "up_s").alias("up_s"), pos("up_s", "table_bytes").alias("up_bytes"),
        F.sum(F.when(conv, F.col("conv_s")).otherwise(0)).alias("conv_s"), F.sum(F.when(conv, F.col("archive_bytes")).otherwise(0)).alias("conv_bytes"), F.sum(F.col("dl_s") + F.col("conv_s") + F.col("up_s")).alias("total_s"),
    )
    for p in ("dl", "conv", "up"):
        s = s.withColumns(rates(p, F.col(f"{p}_s"), F.col(f"{p}_bytes")))
    cycle = F.when((F.col("conv_bytes") > 0) & (F.col("total_s") > 0), F.col("total_s") / (F.col("conv_bytes") / GIB)).otherwise(0.0)
    return s.withColumn("cycle_s_per_gib", F.round(cycle, 4)).withColumn("cycle_gib_per_min", F.round(F.when(cycle > 0, 60 / cycle).otherwise(0.0), 4))


def rates(prefix: str, sec: Column, n: Column) -> dict[str, Column]:
    """Seconds per GiB and MiB per second."""
    ok = (sec > 0) & (n > 0)
    return {f"{prefix}_s_per_gib": F.round(F.when(ok, sec / (n / GIB)).otherwise(0.0), 4), f"{prefix}_mib_per_s": F.round(F.when(ok, n / MIB / sec).otherwise(0.0), 4)}


def repaired_machines(claims: DataFrame, histories: DataFrame) -> DataFrame:
    """Claims (machine, ip, ...) whose garbled machine name is replaced by the greatest name known for its address."""
    names = histories.filter("machine != 'Unknown' AND ip != 'Unknown'").groupBy("ip").agg(F.max("machine").alias("known"))
    bad = F.col("machine").contains("�") | F.col("machine").contains("ï¿½")
    return claims.join(names, "ip", "left").withColumn("machine", F.when(bad, F.coalesce("known", "machine")).otherwise(F.col("machine"))).drop("known")


def claim_ages(claims: DataFrame, now: dt.datetime, stale_after: str = "4 hours") -> DataFrame:
    """Adds at (the last sign of life; null if unreadable) and stale. ``now`` is given, so a result can be repeated."""
    at = F.coalesce(stamp(F.col("updated_at")), F.when(F.col("updated_at").isNull(), stamp(F.col("started_at"))))
    return claims.withColumn("at", at).withColumn("stale", F.coalesce(F.lit(now).cast("timestamp") - F.expr(f"INTERVAL {stale_after}") > F.col("at"), F.lit(False)))


def expired(claims: DataFrame, now: dt.datetime, after: str = "24 hours") -> DataFrame:
    """Adds expired: the claim began longer ago than that, or its start can't be read. A claim without a start is not expired."""
    given = F.col("started_at").isNotNull() & (F.col("started_at") != "")
    old = F.lit(now).cast("timestamp") - F.expr(f"INTERVAL {after}") > stamp(F.col("started_at"))
    return claims.withColumn("expired", F.coalesce(given & F.coalesce(old, F.lit(True)), F.lit(False)))


def own_claims(claims: DataFrame, machine: str | None, ip: str | None) -> DataFrame:
    """Adds own: both machine and ip are these; a null is equal to a null."""
    return claims.withColumn("own", F.col("machine").eqNullSafe(F.lit(machine)) & F.col("ip").eqNullSafe(F.lit(ip)))


def with_unlogged(log: DataFrame, listing: DataFrame) -> DataFrame:
    """The log (filename, status, last_update, error) with a pending row for each file of the listing (name) that it lacks."""
    new = listing.select(F.col("name").alias("filename")).distinct().join(log.select("filename"), "filename", "left_anti")
    return log.select("filename", "status", "last_update", "error").unionByName(new.withColumns({"status": F.lit("pending"), "last_update": F.lit(None).cast("string"), "error": F.lit(None).cast("string")}))


def work_table(log: DataFrame, listing: DataFrame, claims: DataFrame) -> DataFrame:
    """Each logged file with what is known of it: filename, status, size and listed (is it in the listing), machine, ip, at.

    ``listing`` has name and size; ``claims`` zst_filename, machine, ip and at, of which a file's latest counts (null times
    come last, then the least machine and ip). These are lists of files; Spark broadcasts what is small by its own measure.
    """
    names = listing.groupBy(F.col("name").alias("filename")).agg(F.max("size").alias("size")).withColumn("listed", F.lit(True))
    order = Window.partitionBy("zst_filename").orderBy(F.col("at").desc_nulls_last(), F.asc_nulls_last("machine"), F.asc_nulls_last("ip"))
    latest = claims.withColumn("_k", F.row_number().over(order)).filter("_k = 1").select(F.col("zst_filename").alias("filename"), "machine", "ip", "at")
    joined = log.select("filename", "status").join(names, "filename", "left").join(latest, "filename", "left")
    return joined.select("filename", "status", "size", F.coalesce("listed", F.lit(False)).alias("listed"), "machine", "ip", "at")


def orphan_folders(folders: DataFrame, log: DataFrame, now: dt.datetime, *, suffix: str = "_parquet_tmp", after: str = "24 hours") -> DataFrame:
    """The folders (name, modified) of temporary work that no running job owns, with the status of their file.

    They end in ``suffix``, and their file is neither downloading nor converting, or they are older than that.
    """
    own = folders.filter(F.col("name").endswith(suffix)).withColumn("filename", F.expr(f"substring(name, 1, length(name) - {len(suffix)})"))
    known = own.join(log.groupBy("filename").agg(F.max_by("status", "last_update").alias("status")), "filename", "left")
    old = F.coalesce(F.lit(now).cast("timestamp") - F.expr(f"INTERVAL {after}") > F.col("modified"), F.lit(False))
    return known.filter(old | ~F.coalesce(F.col("status").isin("downloading", "converting"), F.lit(False))).select("name", "status", "modified")


def latest_per_key(df: DataFrame, key: str, at: str, tie: str) -> DataFrame:
    """Adds place: 1 for the row with the latest time of its key, which stays; the others are ghosts. Null times come last."""
    return df.withColumn("place", F.row_number().over(Window.partitionBy(key).orderBy(F.col(at).desc_nulls_last(), F.col(tie))))


def completion(pending_bytes: int, speeds: DataFrame) -> DataFrame:
    """One row: mb_per_min, source (observed or static), raw_minutes and cautious_minutes, of machines (conv_bytes, total_s)."""
    per_s = F.sum(F.when(F.col("total_s") > 0, F.col("conv_bytes") / MIB / F.col("total_s")).otherwise(0.0))
    s = speeds.agg(F.coalesce(per_s, F.lit(0.0)).alias("v")).select(F.when(F.col("v") > 0, F.col("v") * 60).otherwise(STATIC_MB_PER_MIN).alias("mb_per_min"), F.when(F.col("v") > 0, "observed").otherwise("static").alias("source"))
    raw = F.lit(pending_bytes) / MIB / F.col("mb_per_min")
    return s.select(F.round("mb_per_min", 4).alias("mb_per_min"), "source", F.round(raw, 4).alias("raw_minutes"), F.round(raw * CAUTION, 4).alias("cautious_minutes"))


def running_progress(df: DataFrame, order: str, size: str, ratio: int = 16) -> DataFrame:
    """Adds position, of_n, running_bytes and percent (capped at 100) of the size expected: ``ratio`` times the compressed bytes.

    For lists of files: the window holds them all.
    """
    over = Window.orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    whole = Window.partitionBy()
    return df.withColumn("position", F.row_number().over(Window.orderBy(order)).cast("bigint")).withColumn("of_n", F.count("*").over(whole)).withColumn("running_bytes", F.sum(size).over(over)).withColumn("percent", F.least(F.lit(100.0), F.round(F.col("running_bytes") * 100.0 / F.col("expected"), 2)) if "expected" in df.columns else F.lit(None).cast("double"))
