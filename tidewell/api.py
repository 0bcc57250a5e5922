"""Whole tasks over folders of archives and tables; each returns DataFrames or small summaries and deletes nothing."""

from __future__ import annotations

import datetime as dt
import json
import tomllib
import uuid
from concurrent.futures import ThreadPoolExecutor
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewell.functions import formats as fm
from tidewell.operators import audit, fleet, layout, profiling, quality
from tidewell.operators.normalize import BAD, split
from tidewell.schema import master_schema
from tidewell.session import cut, tune
from tidewell.sources import store
from tidewell.sources.archives import CLAIM, MANIFEST, catalog, footers, read_json_files, read_lines, read_zstd, spread


def convert(spark: SparkSession, source: str, out: str, *, only: str | None = None, force: bool = False, partitions: int | None = None, first_lines: int | None = None) -> list[dict]:
    """Brings every archive of a folder to a sorted wide table with a manifest; returns a summary of each.

    Archives that have a manifest are left out unless ``force``, which needs ``only``, the name of one archive. Lines that
    hold no JSON object go to ``<table>.bad``, where there are any; good and bad ones together must be the archive's lines
    that aren't blank. ``first_lines`` makes a test run of the first lines of each archive. All archives of a kind are
    decoded and parsed at once and once, into a stored table from which the sorted tables, the bad lines and the column
    counts are made; what reaches the driver are names and counts, a row for each archive. Plain and gzip text works too.
    """
    if force and not only:
        raise ValueError("force needs the name of one archive")
    tune(spark)
    done = {r["name"] for r in catalog(spark, out).filter("group = 'manifest'").collect()} if store.exists(spark, out) else set()
    files = catalog(spark, source).filter("kind IS NOT NULL AND (group = 'archive' OR name RLIKE '[.](json|jsonl|txt)([.]gz)?$')").orderBy("size", "name").collect()
    todo = [f.asDict() | {"table": f"new-{f['name'].split('.')[0]}.parquet"} for f in files]
    todo = [f for f in todo if (not only or f["name"] == only) and (force or f"{f['table']}.manifest.json" not in done)]
    twice = {f["table"] for f in todo if sum(g["table"] == f["table"] for g in todo) > 1}
    if twice:
        raise ValueError(f"several archives would become {', '.join(sorted(twice))}")
    with ThreadPoolExecutor(2) as pool:  # both kinds at once: the executors needn't wait for one's last task
        made = pool.map(lambda kind: _convert_kind(spark, [f for f in todo if f["kind"] == kind], kind, out.rstrip("/"), partitions, first_lines), ("rc", "rs"))
        return [s for summaries in made for s in summaries]


def _convert_kind(spark: SparkSession, files: list[dict], kind: str, out: str, partitions: int | None, first_lines: int | None) -> list[dict]:
    if not files:
        return []
    zstd, plain = ([f for f in files if (f["group"] == "archive") == z] for z in (True, False))
    names = spark.createDataFrame([(f["path"], f["table"]) for f in files], "path string, _table string")
    lines = read_zstd(names.filter(F.col("path").isin([f["path"] for f in zstd])), first_lines=first_lines) if zstd else None
    for f in plain:
        text = read_lines(spark, f["path"]).select(F.lit(f["path"]).alias("path"), "value")
        text = text if first_lines is None else text.limit(first_lines)
        lines = text if lines is None else lines.unionByName(text)
    lines = (lines.repartition(partitions) if partitions else spread(lines)).join(F.broadcast(names), "path")
    staged = cut(split(lines, kind, ["_table"]))
    good, schema = staged.filter(f"{BAD} IS NULL").drop(BAD), master_schema(kind)
    counts = staged.groupBy("_table").agg(F.count("*").alias("n_lines"), F.count(BAD).alias("n_bad"), *[F.count(c).alias(f"_{i}") for i, c in enumerate(schema.names)])
    counts = {r["_table"]: r for r in counts.collect()}
    part = f"{out}/.part-{uuid.uuid4().hex}"
    order = [F.col("_table"), *layout.order()]
    layout.write_table(good.repartitionByRange(*order).sortWithinPartitions(*order), f"{part}/rows", partition_by=["_table"])
    staged.filter(f"{BAD} IS NOT NULL").select(F.col(BAD).alias("value"), "_table").write.partitionBy("_table").text(f"{part}/bad")
    summaries = []
    for f in files:
        table, c = f["table"], counts.get(f["table"])
        path = store.contained(out, table)
        for was, now in ((f"{part}/rows/_table={table}", path), (f"{part}/bad/_table={table}", f"{path}.bad")):
            if store.exists(spark, was):
                store.move_folder(spark, was, now)
        if c is None or c["n_lines"] == c["n_bad"]:
            layout.write_table(spark.createDataFrame([], schema), path, mode="overwrite")
        summaries.append({"archive": f["name"], "table": table, "path": path, "counts": c})
    fs, where = store.file_system(spark, part)
    fs.delete(where, True)
    have = catalog(spark, [s["path"] for s in summaries], "*.parquet")
    read = footers(have).join(have.select("path", "size"), "path").select("path", "n_rows", "size").distinct().withColumn("_table", F.regexp_extract("path", r"/(new-[^/]*\.parquet)/", 1))
    read = {r["_table"]: r for r in read.groupBy("_table").agg(F.sum("n_rows").alias("n"), F.sum("size").alias("size")).collect()}
    rows = []
    for s in summaries:
        c, r = s.pop("counts"), read[s["table"]]
        n, bad = (c["n_lines"], c["n_bad"]) if c else (0, 0)
        if r["n"] + bad != n:
            raise ValueError(f"{s['archive']}: {n} lines gave {r['n']} rows and {bad} bad lines")
        stats = {x: {"count": c[f"_{i}"] if c else 0, "usage_ratio": round(c[f"_{i}"] / r["n"], 4) if r["n"] else 0.0} for i, x in enumerate(schema.names)}
        manifest = {
            "filename": s["table"], "file_size": r["size"], "last_modified": dt.datetime.now(dt.UTC).strftime("%Y-%m-%dT%H:%M:%SZ"), "row_count": r["n"], "conversion_method": "spark",
            "schema": {x.name: x.dataType.simpleString() for x in schema}, "column_stats": stats,
        }
        store.write_text(spark, f"{s.pop('path')}.manifest.json", json.dumps(manifest))
        rows.append(s | {"rows": r["n"], "bad": bad})
    return rows


def _table_files(spark: SparkSession, folder: str) -> DataFrame:
    """The data files of tables; a table may be one file or a folder of them."""
    files = catalog(spark, folder, "*.parquet")
    top = F.regexp_extract("path", r"/(new-[^/]*\.parquet)(/|$)", 1)
    return files.withColumn("table", top).filter("table != ''")


def verify(spark: SparkSession, folder: str, *, offset: int = 0, limit: int | None = None) -> DataFrame:
    """filename, status and errors of each table of a folder, by its footers and its manifest; a page of them in order of name."""
    if offset < 0 or limit is not None and limit < 0:
        raise ValueError("offset and limit must not be negative")
    tune(spark)
    files = _table_files(spark, folder)
    page = files.select("table").distinct().orderBy("table").offset(offset)
    page = page if limit is None else page.limit(limit)
    chosen = files.join(page, "table")
    types = audit.table_types(footers(chosen).join(chosen.select("path", "table"), "path"), "table")
    m = read_json_files(spark, f"{folder.rstrip('/')}/*.manifest.json", MANIFEST)
    named = F.coalesce("schema", F.map_from_arrays("columns", F.transform("columns", lambda _: F.lit(""))), F.transform_values("column_stats", lambda _k, _v: F.lit("")))
    arrow = F.transform_values(named, lambda _k, t: F.when(t == "bigint", "int64").when(t == "boolean", "bool").otherwise(t))
    return audit.verify(types, m.select("filename", arrow.alias("types")))


def manifests(spark: SparkSession, folder: str, *, full: bool = False) -> DataFrame:
    """Manifests of the Parquet files of a folder from their footers; ``full`` adds column_stats.

    Footers state the nulls of flat columns, so nothing else is read for those. Only files with other columns are read
    themselves, all files of the same columns at once.
    """
    tune(spark)
    files = catalog(spark, folder, "*.parquet")
    read = cut(footers(files))
    made = audit.build_manifests(read, files)
    if not full:
        return made.drop("path")
    stat = lambda given: F.struct(given.alias("count"), F.when(F.col("n_rows") > 0, F.round(given / F.col("n_rows"), 4)).otherwise(0.0).alias("usage_ratio"))
    named = read.filter("column_name IS NOT NULL")
    unknown = named.filter("n_null IS NULL").select("path").distinct()
    stated = named.join(unknown, "path", "left_anti").select("path", "column_name", stat(F.col("n_rows") - F.col("n_null")).alias("s"))
    for paths in _same_columns(named.join(unknown, "path", "left_semi")):
        t = spark.read.parquet(*paths)
        counts = t.groupBy(F.input_file_name().alias("path")).agg(F.count("*").alias("n_rows"), *[F.count(F.col(f"`{c}`")).alias(f"_{i}") for i, c in enumerate(t.columns)])
        each = F.explode(F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(f"_{i}").alias("n")) for i, c in enumerate(t.columns)]))
        counted = counts.select("path", "n_rows", each.alias("c"))
        stated = stated.unionByName(counted.select(F.url_decode("path").alias("path"), "c.column_name", stat(F.col("c.n")).alias("s")))
    place = F.regexp_replace("path", "^file:/+", "/")
    stats = stated.groupBy(place.alias("_place")).agg(F.map_from_entries(F.collect_list(F.struct("column_name", "s"))).alias("column_stats"))
    return made.withColumn("_place", place).join(stats, "_place", "left").drop("_place", "path")


def _same_columns(rows: DataFrame) -> list[list[str]]:
    """The files of rows of footers, grouped by their columns and types: as many groups as there are different ones."""
    signature = rows.groupBy("path").agg(F.sort_array(F.collect_list(F.struct("position", "column_name", "type"))).alias("s"))
    return [r["paths"] for r in signature.groupBy(F.xxhash64("s")).agg(F.collect_list("path").alias("paths")).select("paths").collect()]


def profile_load(spark: SparkSession, folder: str, load: str, new: DataFrame, old: DataFrame | None = None, *, columns: list[str] | None = None, patterns: dict[str, str] | None = None) -> DataFrame:
    """Adds a load to the value counts kept in ``folder`` and gives the profile of each column after each load.

    ``new`` are the rows that the load brings, ``old`` those that it replaces or removes. Loads are in order of name; a
    load applied again takes its own place.
    """
    names = columns or new.columns
    delta = quality.value_counts(new, names)
    if old is not None:
        delta = quality.merge_counts(delta, quality.value_counts(old, names, sign=-1))
    kept = quality.CountStore(spark, folder)
    kept.apply(load, delta)
    return quality.profile_history(kept.loads(), "load", patterns, quality.numeric_columns(new))


def report(spark: SparkSession, folder: str, now: dt.datetime) -> dict[str, DataFrame]:
    """status, timeline, machines, claims (with stale ones and ghosts marked) and estimate of a folder of archives and metadata."""
    tune(spark)
    files = catalog(spark, folder)
    archives = files.filter("group = 'archive'").select("name", "size")
    done = files.filter("group = 'manifest'").select(fm.archive_name(F.col("name")).alias("name"))
    history = fleet.runs(read_json_files(spark, f"{folder.rstrip('/')}/*.manifest.json", MANIFEST), archives)
    machines = fleet.machine_stats(history)
    claims = read_json_files(spark, f"{folder.rstrip('/')}/*.claim.json", CLAIM).select("zst_filename", F.coalesce("machine_meta.machine", F.lit("Unknown")).alias("machine"), F.coalesce("machine_meta.ip", F.lit("Unknown")).alias("ip"), "stage", "started_at", "updated_at")
    aged = fleet.claim_ages(fleet.repaired_machines(claims, history), now)
    placed = fleet.latest_per_key(aged.filter("NOT stale"), "machine", "at", "zst_filename").withColumn("ghost", F.col("place") > 1).drop("place").unionByName(aged.filter("stale").withColumn("ghost", F.lit(False)))
    status = fleet.status(archives, done)
    active = machines.join(placed.filter("NOT stale AND NOT ghost").select("machine").distinct(), "machine")
    return {"status": status, "timeline": fleet.timeline(fleet.archive_months(archives, done)), "machines": machines, "claims": placed, "estimate": fleet.completion(status.first()["pending_bytes"], active)}


def drift(spark: SparkSession, paths: list[str], *, out: str | None = None) -> DataFrame:
    """Columns and types over Parquet files: in how many and in which. ``out``: also a JSON file, the rarest first.

    The JSON has the number of files, of unreadable ones, and each column and type with its number of files.
    """
    read = footers(catalog(spark, paths, "*.parquet"))
    found = profiling.schema_drift(read.filter("column_name IS NOT NULL").select(F.col("path").alias("source"), "column_name", "type"))
    if out:
        n = read.agg(F.count_distinct("path").alias("files"), F.count_distinct(F.when(F.col("error").isNotNull(), F.col("path"))).alias("errors")).first()
        rarest = found.select("column_name", "type", "n_sources").orderBy("n_sources", "column_name", "type").collect()
        store.write_text(spark, out, json.dumps({"files": n["files"], "errors": n["errors"], "column_frequencies": {f"{r['column_name']} ({r['type']})": r["n_sources"] for r in rarest}}, indent=1))
    return found


def settings(*paths: str) -> dict[str, dict]:
    """TOML settings of several files, section by section; later files win and missing ones are left out."""
    out: dict[str, dict] = {}
    for p in paths:
        if Path(p).exists():
            for section, values in tomllib.loads(Path(p).read_text()).items():
                out.setdefault(section, {}).update(values)
    return out


def problems_of(found: dict[str, dict]) -> list[str]:
    """What is wrong with settings for a session: a missing folder for shared tables, values that aren't of their kind."""
    spark = found.get("spark", {})
    out = [] if spark.get("checkpoint_dir") or str(spark.get("master", "local")).startswith("local") else ["spark.checkpoint_dir is missing: a cluster needs a folder that all executors share"]
    out += [f"spark.{k} must be a positive whole number" for k in ("shuffle_partitions", "cores") if k in spark and not (isinstance(spark[k], int) and not isinstance(spark[k], bool) and spark[k] > 0)]
    out += [f"paths.{k} must be a text" for k, v in found.get("paths", {}).items() if not isinstance(v, str) or not v]
    return out


def shown(spark: SparkSession, found: dict[str, dict]) -> DataFrame:
    """section, key and value of settings, secrets hidden."""
    rows = [(s, k, str(v)) for s, values in found.items() for k, v in values.items()]
    return spark.createDataFrame(rows, "section string, key string, value string").withColumn("value", fm.redact(F.col("key"), F.col("value")))
