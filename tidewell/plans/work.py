"""Queries for conversion from archives on disk, audits of what was written, and joins of logs, listings and claims; with SQL."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewell import api
from tidewell.functions import formats as fm
from tidewell.functions.coerce import edited_text
from tidewell.functions.reading import seconds
from tidewell.operators import audit, fleet, profiling
from tidewell.operators.normalize import parse, promote
from tidewell.plans.catalogue import ARCHIVED, NOW, STAMP, _profile_sql, archives, claims, table
from tidewell.schema import RC, RS, column_type, sql_name
from tidewell.session import scratch, tune
from tidewell.sources.archives import MANIFEST, catalog, footers, read_json_files, write_zstd

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql is not None:
            SQL[f.__name__] = sql
        return f

    return add


# Conversion. The archives are made of the tables: one zstd file of JSON lines for each month and kind, with two bad lines each.


def _converted(spark: SparkSession, sf_dir: str) -> str:
    """The folder of the tables converted from archives of the comments and submissions."""
    base, lines = scratch(spark), None
    for kind, names in (("RC", RC), ("RS", RS)):
        t = table(spark, sf_dir, f"master_schema_{kind.lower()}")
        month = F.coalesce(F.date_format(F.timestamp_seconds(seconds("created_utc")), "yyyy-MM"), F.lit("1970-01"))
        own = t.select(F.concat(F.lit(f"{kind}_"), month, F.lit(".zst")).alias("name"), F.to_json(F.struct(*[F.col(c.lower()).alias(c) for c in names])).alias("value"))
        bad = own.select("name").distinct().select("name", F.explode(F.array(F.lit("{cut off"), F.lit("[1]"))).alias("value"))
        both = own.unionByName(bad)
        lines = both if lines is None else lines.unionByName(both)
    write_zstd(lines, f"{base}/archives")
    api.convert(spark, f"{base}/archives", f"{base}/tables")
    return f"{base}/tables"


SEC = "CASE WHEN created_utc > 100000000000 THEN created_utc // 1000 ELSE created_utc END"
MONTH = f"coalesce(strftime(to_timestamp({SEC}) AT TIME ZONE 'UTC', '%Y-%m'), '1970-01')"
TABLES = f"SELECT 'new-RC_' || {MONTH} || '.parquet' AS filename, count(*) AS n FROM master_schema_rc GROUP BY ALL UNION ALL SELECT 'new-RS_' || {MONTH} || '.parquet', count(*) FROM master_schema_rs GROUP BY ALL"


@query(f"SELECT {', '.join(RC)}, CAST(NULL AS VARCHAR) AS extra_json FROM master_schema_rc")
def converted_rc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Comments written as zstd archives, converted, and read back from the sorted tables."""
    return spark.read.parquet(f"{_converted(spark, sf_dir)}/new-RC_*.parquet")


@query(f"SELECT filename, n AS row_count, 'spark' AS conversion_method, {len(RC) + 1} AS n_columns, 2 AS n_bad FROM ({TABLES}) WHERE filename LIKE 'new-RC%' UNION ALL SELECT filename, n, 'spark', {len(RS) + 1}, 2 FROM ({TABLES}) WHERE filename LIKE 'new-RS%'")
def converted_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The manifests of converted tables, and the bad lines put aside."""
    out = _converted(spark, sf_dir)
    m = read_json_files(spark, f"{out}/*.manifest.json", MANIFEST).select("filename", "row_count", "conversion_method", F.size("column_stats").alias("n_columns"))
    bad = spark.read.text(f"{out}/*.bad").groupBy(F.regexp_extract(F.input_file_name(), r"/(new-[^/]*\.parquet)\.bad/", 1).alias("filename")).agg(F.count("*").cast("int").alias("n_bad"))
    return m.join(bad, "filename", "left")


@query("SELECT * FROM (" + " UNION ALL ".join(f"SELECT 'new-RC_' || {MONTH} || '.parquet' AS filename, '{c}' AS column_name, count({c}) AS non_null, round(count({c}) / count(*), 4) AS usage_ratio FROM master_schema_rc GROUP BY ALL" for c in RC) + f" UNION ALL SELECT filename, 'extra_json', 0, 0.0 FROM ({TABLES}) WHERE filename LIKE 'new-RC%')")
def converted_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The column_stats of the converted comments, as counted while they were written."""
    m = read_json_files(spark, f"{_converted(spark, sf_dir)}/new-RC_*.manifest.json", MANIFEST)
    return m.select("filename", F.explode("column_stats").alias("column_name", "s")).select("filename", "column_name", F.col("s.count").alias("non_null"), "s.usage_ratio")


@query(f"SELECT filename, 'ok' AS status, '' AS errors FROM ({TABLES})")
def verified_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Converted tables verified by their footers, their manifests and the master columns."""
    return api.verify(spark, _converted(spark, sf_dir)).withColumn("errors", F.array_join("errors", "; "))


@query(f"WITH t AS ({TABLES}) SELECT 'failed' AS status, count(*) AS n FROM t UNION ALL SELECT 'total', count(*) FROM t")
def verification_tally(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The tally where the manifests are of the other kind's columns: all tables fail."""
    out = _converted(spark, sf_dir)
    types = audit.table_types(footers(catalog(spark, out, "*.parquet")).withColumn("table", F.regexp_extract("path", r"(/new-[^/]*\.parquet)/", 1)), "table")
    m = read_json_files(spark, f"{out}/*.manifest.json", MANIFEST).select("filename", F.map_filter(F.transform_values("schema", lambda k, v: F.lit("")), lambda k, v: k != "id").alias("types"))
    return audit.tally(audit.verify(types, m))


# Footers of the test tables. SQL sees the same files as views.

NAMES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings", "master_schema_rc", "master_schema_rs", "manifest", "claims", "job_log", "heldout_items"]
COUNTS = " UNION ALL ".join(f"SELECT '{n}' AS t, count(*) AS n_rows FROM {n}" for n in NAMES)
COLUMNS = f"""SELECT DISTINCT table_name || '.parquet' AS file, n_rows, CAST(column_index - 1 AS INTEGER) AS position, column_name, CASE WHEN data_type IN ('BIGINT', 'INTEGER') THEN 'BIGINT' WHEN data_type IN ('DOUBLE', 'FLOAT') THEN 'DOUBLE' WHEN data_type = 'BOOLEAN' THEN 'BOOLEAN'
 WHEN data_type LIKE 'STRUCT%' OR data_type LIKE 'MAP%' OR data_type LIKE '%[]' THEN 'JSON' ELSE 'VARCHAR' END AS type FROM duckdb_columns() JOIN ({COUNTS}) c ON c.t = table_name WHERE NOT internal"""


@query(COLUMNS)
def footer_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every Parquet file of the folder: rows and columns from its footer alone, types by their SQL names."""
    tune(spark)
    f = footers(catalog(spark, sf_dir, "*.parquet"))
    return f.select(F.element_at(F.split("path", "/"), -1).alias("file"), "n_rows", "position", "column_name", sql_name(F.col("type")).alias("type"))


@query(f"WITH c AS ({COLUMNS}) SELECT file AS filename, n_rows AS row_count, 'regenerated' AS conversion_method, string_agg(column_name, ',' ORDER BY position) AS columns, string_agg(column_name || ' ' || type, ',' ORDER BY column_name) AS types FROM c GROUP BY ALL")
def regenerated_manifests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Manifests made from footers; sizes and times are of the files and left out."""
    tune(spark)
    files = catalog(spark, sf_dir, "*.parquet")
    types = F.array_join(F.array_sort(F.transform(F.map_entries("schema"), lambda e: F.concat(e.key, F.lit(" "), sql_name(e.value)))), ",")
    return audit.build_manifests(footers(files), files).select("filename", "row_count", "conversion_method", F.array_join("columns", ",").alias("columns"), types.alias("types"))


@query("SELECT name || '.parquet' AS name, 'table' AS \"group\", NULL AS kind FROM (VALUES " + ", ".join(f"('{n}')" for n in NAMES) + ") v(name)")
def listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The files of the folder by group and kind, from their names."""
    tune(spark)
    return catalog(spark, sf_dir, "*.parquet").select("name", "group", "kind")


_MASTER = " UNION ALL ".join(f"SELECT '{k}' AS kind, {i} AS position, '{c}' AS column_name, '{'BIGINT' if isinstance(column_type(c), T.LongType) else 'BOOLEAN' if isinstance(column_type(c), T.BooleanType) else 'VARCHAR'}' AS type" for k, names in (("rc", RC), ("rs", RS)) for i, c in enumerate(names))


@query(f"WITH m AS ({_MASTER}) SELECT m.kind, m.position, m.column_name, m.type, f.type AS found FROM m LEFT JOIN ({COLUMNS}) f ON f.file = 'master_schema_' || m.kind || '.parquet' AND lower(f.column_name) = lower(m.column_name)")
def master_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The master columns and their types beside those of the archive tables on disk."""
    tune(spark)
    rows = [(k, i, c, column_type(c).simpleString()) for k, names in (("rc", RC), ("rs", RS)) for i, c in enumerate(names)]
    m = spark.createDataFrame(rows, "kind string, position int, column_name string, type string").withColumn("type", sql_name(F.col("type")))
    f = footer_audit(spark, sf_dir).select(F.regexp_extract("file", r"^master_schema_(r[cs])\.parquet$", 1).alias("k"), F.lower("column_name").alias("c"), F.col("type").alias("found"))
    return m.join(f, (F.col("k") == F.col("kind")) & (F.col("c") == F.lower("column_name")), "left").select("kind", "position", "column_name", "type", "found")


# Logs, listings and claims

CLAIMS = f"SELECT zst_filename, machine_meta.machine AS machine, machine_meta.ip AS ip, started_at, coalesce({STAMP.format('updated_at')}, CASE WHEN updated_at IS NULL THEN {STAMP.format('started_at')} END) AS at_ FROM claims"
SIZES = f"SELECT {ARCHIVED} AS name, max(file_size) AS size FROM manifest GROUP BY ALL"


@query(f"SELECT zst_filename, coalesce(started_at <> '' AND coalesce({STAMP.format('started_at')} < TIMESTAMP '2016-01-01' - INTERVAL 24 HOUR, TRUE), FALSE) AS expired FROM claims")
def expired_claims(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fleet.expired(claims(spark, sf_dir), NOW).select("zst_filename", "expired")


@query(f"WITH c AS ({CLAIMS}), o AS (SELECT machine, ip FROM c WHERE machine IS NOT NULL ORDER BY machine, ip NULLS FIRST LIMIT 1) SELECT zst_filename, c.machine IS NOT DISTINCT FROM o.machine AND c.ip IS NOT DISTINCT FROM o.ip AS own FROM c, o")
def own_claims(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which claims are those of the first machine by name."""
    c = claims(spark, sf_dir)
    me = c.filter("machine IS NOT NULL").orderBy("machine", F.asc_nulls_first("ip")).first()
    return fleet.own_claims(c, me and me["machine"], me and me["ip"]).select("zst_filename", "own")


@query(f"WITH c AS (SELECT *, row_number() OVER (PARTITION BY zst_filename ORDER BY at_ DESC NULLS LAST, machine NULLS LAST, ip NULLS LAST) AS k FROM ({CLAIMS})) SELECT j.filename, j.status, s.size, s.name IS NOT NULL AS listed, c.machine, c.ip, strftime(c.at_, '%Y-%m-%d %H:%M:%S') AS seen FROM job_log j LEFT JOIN ({SIZES}) s ON s.name = j.filename LEFT JOIN c ON c.zst_filename = j.filename AND c.k = 1")
def work_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = fleet.claim_ages(claims(spark, sf_dir), NOW)
    w = fleet.work_table(table(spark, sf_dir, "job_log"), archives(spark, sf_dir), c)
    return w.select("filename", "status", "size", "listed", "machine", "ip", F.date_format("at", "yyyy-MM-dd HH:mm:ss").alias("seen"))


@query("SELECT filename, status, last_update, error FROM job_log UNION ALL SELECT zst_filename, 'pending', NULL, NULL FROM (SELECT DISTINCT zst_filename FROM claims) WHERE zst_filename NOT IN (SELECT filename FROM job_log)")
def logged_and_pending(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The log, with the claimed archives that it lacks as pending."""
    return fleet.with_unlogged(table(spark, sf_dir, "job_log"), table(spark, sf_dir, "claims").select(F.col("zst_filename").alias("name")))


@query(f"WITH f AS (SELECT zst_filename, coalesce({STAMP.format('updated_at')}, {STAMP.format('started_at')}) AS modified, CASE stage WHEN 'converting' THEN 'converting' WHEN 'downloading' THEN 'downloading' ELSE 'done' END AS status FROM claims) SELECT zst_filename || '_parquet_tmp' AS name, status FROM f WHERE status = 'done' OR coalesce(modified < TIMESTAMP '2015-07-01' - INTERVAL 24 HOUR, FALSE)")
def orphan_folders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Temporary folders of claimed archives (one each, last touched when the claim was) that no running job owns."""
    c = table(spark, sf_dir, "claims")
    folders = c.select(F.concat("zst_filename", F.lit("_parquet_tmp")).alias("name"), F.coalesce(fm.stamp(F.col("updated_at")), fm.stamp(F.col("started_at"))).alias("modified"))
    log = c.select(F.col("zst_filename").alias("filename"), F.when(F.col("stage").isin("converting", "downloading"), F.col("stage")).otherwise("done").alias("status"), F.lit("").alias("last_update"))
    return fleet.orphan_folders(folders, log, dt.datetime(2015, 7, 1)).select("name", "status")


@query("WITH g AS (SELECT status, count(*) AS n, list_sort(list(filename)) AS l FROM job_log GROUP BY ALL) SELECT status, n, array_to_string(l[1:10], ', ') || CASE WHEN n > 10 THEN ', ...and ' || (n - 10) || ' more' ELSE '' END AS preview FROM g")
def status_preview(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profiling.preview(table(spark, sf_dir, "job_log"), "status", "filename")


@query("WITH e AS (SELECT DISTINCT filename, unnest(map_entries(schema_types)) AS e FROM manifest), c AS (SELECT e.key AS column_name, e.value AS type, count(*) AS n_sources FROM e GROUP BY ALL) SELECT *, row_number() OVER (ORDER BY n_sources, column_name, type) AS place FROM c")
def columns_by_frequency(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Columns and types of the manifests, the rarest first."""
    e = table(spark, sf_dir, "manifest").select("filename", F.explode("schema_types").alias("column_name", "type")).distinct()
    return profiling.by_frequency(e.groupBy("column_name", "type").agg(F.count("*").alias("n_sources")), "n_sources", ["column_name", "type"])


# Names and labels

ONE = "regexp_replace(regexp_replace(filename, '^new-', ''), '_\\d+\\.parquet$', '.zst')"
SERIES = "regexp_extract(filename, '_(\\d+)\\.parquet$', 1)"


@query(f"SELECT filename, lower(regexp_extract({ONE}, '^(R[CS])_', 1)) AS kind, CAST(regexp_extract({ONE}, '_(\\d+)-', 1) AS INTEGER) AS year, CAST(regexp_extract({ONE}, '-(\\d+)\\.', 1) AS INTEGER) AS month, CAST({SERIES} AS INTEGER) AS chunk, replace({ONE}, '.zst', '.claim.json') AS claim FROM manifest")
def name_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Kind, year and month of archive names, and the number of chunk names made of the series."""
    name = F.regexp_replace(fm.archive_name(F.col("filename")), r"_\d+\.zst$", ".zst")
    chunk = F.concat(F.lit("chunk_"), F.regexp_extract("filename", r"_(\d+)\.parquet$", 1), F.lit(".parquet"))
    return table(spark, sf_dir, "manifest").select("filename", F.lower(fm.archive_part(name, 1)).alias("kind"), fm.archive_part(name, 2).cast("int").alias("year"), fm.archive_part(name, 3).cast("int").alias("month"), fm.chunk_number(chunk).alias("chunk"), fm.claim_name(name).alias("claim"))


_LONG = "CASE " + " ".join(f"WHEN file_size < {1024.0 ** (k + 1):.0f} THEN printf('%.2f {u}', file_size / {1024**k}.0)" for k, u in enumerate(fm.LONG_UNITS[:4])) + " END"


@query(f"SELECT filename, {_LONG} AS size, CASE WHEN row_count % 7200 >= 60 THEN (row_count % 7200) // 60 || 'm ' || (row_count % 7200) % 60 || 's' ELSE row_count % 7200 || 's' END AS elapsed, CASE WHEN row_count % 7 = 0 THEN 0.0 ELSE round(file_size / 1048576.0 / (row_count % 7), 2) END AS mb_per_s, CASE WHEN conversion_method LIKE '%key%' OR conversion_method LIKE '%token%' THEN '<redacted>' ELSE filename END AS shown FROM manifest WHERE file_size > 0 AND row_count >= 0")
def size_and_time_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = table(spark, sf_dir, "manifest").filter("file_size > 0 AND row_count >= 0")
    sec = F.col("row_count") % 7
    return m.select("filename", fm.format_size_long(F.col("file_size")).alias("size"), fm.elapsed(F.col("row_count") % 7200).alias("elapsed"), fm.mb_per_s(F.col("file_size"), sec).alias("mb_per_s"), fm.redact(F.col("conversion_method"), F.col("filename")).alias("shown"))


@query("""SELECT zst_filename, coalesce(CASE WHEN machine <> '' AND NOT regexp_matches(machine, '[^\\x00-\\x7F]') THEN machine WHEN ip <> '' THEN ip WHEN machine <> '' AND NOT contains(machine, chr(65533)) THEN machine WHEN machine <> '' THEN regexp_replace(machine, '[^\\x00-\\x7F]', '', 'g') END, 'unknown-node') AS host
FROM (SELECT zst_filename, machine_meta.machine AS machine, machine_meta.ip AS ip FROM claims)""")
def host_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The better of a claim's machine name and address."""
    return claims(spark, sf_dir).select("zst_filename", fm.host_name(F.array("machine", "ip")).alias("host"))


STAGES = ["download", "conversion", "upload"]


@query("""WITH s AS (SELECT filename, unnest(map_entries(conversion_history.stages)) AS e, conversion_history.machine.machine AS machine FROM (SELECT DISTINCT * FROM manifest) WHERE conversion_history IS NOT NULL),
r AS (SELECT DISTINCT coalesce(machine, '') AS a, upper(e.key[1]) || e.key[2:] AS b, coalesce(printf('%.2fs', e.value.duration_sec), 'N/A') AS c, coalesce(printf('%.2f MB/s', e.value.speed_mb_s), '-') AS d FROM s),
w AS (SELECT greatest(7, max(length(a))) AS a, greatest(5, max(length(b))) AS b, greatest(8, max(length(c))) AS c, greatest(10, max(length(d))) AS d FROM r),
l AS (SELECT '| ' || rpad(r.a, w.a::INT, ' ') || ' | ' || rpad(r.b, w.b::INT, ' ') || ' | ' || rpad(r.c, w.c::INT, ' ') || ' | ' || rpad(r.d, w.d::INT, ' ') || ' |' AS line FROM r, w
 UNION ALL SELECT '| ' || rpad('Machine', w.a::INT, ' ') || ' | ' || rpad('Stage', w.b::INT, ' ') || ' | ' || rpad('Duration', w.c::INT, ' ') || ' | ' || rpad('Throughput', w.d::INT, ' ') || ' |' FROM w
 UNION ALL SELECT '+-' || repeat('-', w.a) || '-+-' || repeat('-', w.b) || '-+-' || repeat('-', w.c) || '-+-' || repeat('-', w.d) || '-+' FROM w, range(3))
SELECT line FROM l""")
def stage_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stages of all conversions with duration and throughput, as the lines of a text table."""
    m = table(spark, sf_dir, "manifest").filter("conversion_history IS NOT NULL").select(F.col("conversion_history.machine.machine").alias("Machine"), F.explode("conversion_history.stages").alias("stage", "v"))
    cells = m.select("Machine", F.initcap("stage").alias("Stage"), fm.format_seconds(F.col("v.duration_sec").cast("string")).alias("Duration"), fm.format_mb_s(F.col("v.speed_mb_s").cast("string"), F.col("v.speed_mb_s").isNotNull()).alias("Throughput")).distinct()
    return fm.text_table(cells.withColumn("place", F.lit(1)), ["Machine", "Stage", "Duration", "Throughput"]).select("line")


EDIT = "CASE o_orderkey % 6 WHEN 0 THEN 'true' WHEN 1 THEN 'f' WHEN 2 THEN CAST(1600000000 + o_orderkey AS {s}) WHEN 3 THEN '1' WHEN 4 THEN o_orderstatus ELSE NULL END"


@query("WITH t AS (SELECT o_orderkey, " + EDIT.format(s="VARCHAR") + " AS x FROM orders) SELECT o_orderkey, CAST(CASE WHEN TRY_CAST(x AS BOOLEAN) IS TRUE THEN 1 WHEN TRY_CAST(x AS BOOLEAN) IS FALSE THEN 0 ELSE TRY_CAST(x AS BIGINT) END AS BIGINT) AS edited FROM t")
def edited_by_sql_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The edit mark read as SQL would: every text that is a flag counts as one."""
    return table(spark, sf_dir, "orders").select("o_orderkey", edited_text(F.expr(EDIT.format(s="STRING")), "sql").alias("edited"))


DECLARED = T.StructType([T.StructField("o_orderkey", T.LongType()), T.StructField("parts", T.ArrayType(T.StructType([T.StructField("n", T.LongType()), T.StructField("flag", T.BooleanType())]))), T.StructField("who", T.StructType([T.StructField("id", T.LongType()), T.StructField("name", T.StringType())])), T.StructField("ratio", T.DoubleType())])


@query("SELECT o_orderkey, 2 AS n_parts, o_custkey AS n, o_custkey % 2 = 1 AS flag, o_custkey AS id, '[1,\"x\"]' AS name, o_totalprice AS ratio FROM orders")
def declared_nested_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of nested values brought to declared lists and structs, with numbers as texts and values of other kinds."""
    o = table(spark, sf_dir, "orders")
    line = F.concat(F.lit('{"o_orderkey":"'), "o_orderkey", F.lit('","parts":[{"n":"'), "o_custkey", F.lit('","flag":'), F.col("o_custkey") % 2, F.lit('},5],"who":{"id":'), "o_custkey", F.lit('.0,"name":[1,"x"],"more":1},"ratio":"'), F.col("o_totalprice").cast("string"), F.lit('"}'))
    p = promote(parse(o.select(line.alias("value")), DECLARED), DECLARED)
    return p.select("o_orderkey", F.size("parts").alias("n_parts"), F.col("parts")[0].n.alias("n"), F.col("parts")[0].flag.alias("flag"), "who.id", "who.name", "ratio")
