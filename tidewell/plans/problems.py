"""Queries p1 to p5 over the archive tables, and their SQL where it can be written."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidewell.functions.reading import known_author, seconds, utc_day
from tidewell.operators.hierarchy import descendants, hierarchy
from tidewell.operators.quality import CountStore, load_changes, numeric_columns, profile_history, stated_deltas, value_counts
from tidewell.operators.sessions import sessions
from tidewell.operators.shredding import assemble, element_objects, object_rows, related_tables, shred
from tidewell.operators.skewed import key_profile, middle_ids, percentiles
from tidewell.session import scratch, tune


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    tune(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    nodes = hierarchy(table(spark, sf_dir, "master_schema_rc"), with_path=False)
    return nodes.filter("state IS NOT NULL").select("id", "state")


def p1_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    nodes = hierarchy(table(spark, sf_dir, "master_schema_rc"))
    return nodes.select("id", "state", "root", "depth", "back_edge", F.array_join("path", "/").alias("path"), "n_descendants")


def p1_descendants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return descendants(hierarchy(table(spark, sf_dir, "master_schema_rc")))


def _comment_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    rc = table(spark, sf_dir, "master_schema_rc").filter(known_author("author"))
    return sessions(rc, F.col("author"), seconds("created_utc"), F.col("id"), gap=1800).withColumnsRenamed({"entity": "author", "n_events": "n_comments"})


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _comment_sessions(spark, sf_dir).filter("n_comments >= 5").select("author", "session_start", "session_end", "n_comments")


def p2_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _comment_sessions(spark, sf_dir)


def _keyed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """field, key_value, day, second, id of every comment with a time, for both fields."""
    rc = table(spark, sf_dir, "master_schema_rc").filter("created_utc IS NOT NULL")
    both = F.explode(F.array(*[F.struct(F.lit(f).alias("field"), F.col(f).alias("key_value")) for f in ("author", "subreddit")]))
    rows = rc.select(both.alias("k"), seconds("created_utc").alias("second"), "id").select("k.*", "second", "id").filter("key_value IS NOT NULL")
    return rows.withColumn("day", F.floor(F.col("second") / 86400).cast("int"))


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = middle_ids(_keyed(spark, sf_dir), ["field", "key_value"], "day", "second", "id", least=20)
    return got.select("field", "key_value", utc_day(F.col("day") * F.lit(86400).cast("bigint")).alias("utc_day"), F.col("middle").alias("mid_id"))


def p3_profiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """For each author and each subreddit: comments, distinct values of the other field and the most frequent of them."""
    rc = table(spark, sf_dir, "master_schema_rc").filter("created_utc IS NOT NULL")
    pair = lambda a, b: F.struct(F.lit(a).alias("field"), F.col(a).alias("key_value"), F.col(b).alias("other"))
    rows = rc.select(F.explode(F.array(pair("author", "subreddit"), pair("subreddit", "author"))).alias("k"), "id").select("k.*", "id").filter("key_value IS NOT NULL")
    return key_profile(rows.distinct().drop("id"), ["field", "key_value"], "other")


def p3_percentiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """For each author and each subreddit: quartiles and the 99th percentile of the scores of its comment rows."""
    rc = table(spark, sf_dir, "master_schema_rc").filter("created_utc IS NOT NULL")
    both = F.explode(F.array(*[F.struct(F.lit(f).alias("field"), F.col(f).alias("key_value")) for f in ("author", "subreddit")]))
    rows = rc.select(both.alias("k"), "score").select("k.*", "score").filter("key_value IS NOT NULL")
    return percentiles(rows, ["field", "key_value"], "score", [25, 50, 75, 99])


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return element_objects(shred(table(spark, sf_dir, "master_schema_rs"), "id", "extra_json")).distinct()


def p4_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    return assemble(shred(table(spark, sf_dir, "master_schema_rs"), "id", "extra_json")).distinct()


def p4_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per object of each related table, with its own fields in order as one text."""
    rows = object_rows(p4_tables(spark, sf_dir))
    text = F.array_join(F.transform(F.map_entries("fields"), lambda e: F.concat(e.key, F.lit("="), F.coalesce(e.value, F.lit("null")))), "; ")
    return rows.select("id", "field_path", "node_path", "parent_path", text.alias("fields"))


def p4_schemas(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The related tables with their numbers of rows and columns."""
    return related_tables(p4_tables(spark, sf_dir)).select("field_path", "n_rows", F.size("columns").alias("n_columns"))


MONTH = r"^new-(R[CS])_(\d{4}-\d{2})_(\d+)\.parquet$"


def _stamp() -> Column:
    """last_modified, UTC in several notations; an unreadable one counts as the earliest."""
    return F.coalesce(F.expr("try_cast(last_modified AS timestamp)"), F.timestamp_seconds(F.lit(0)))


def stated_loads(manifest: DataFrame) -> DataFrame:
    """series, load (its month), row_count, column_stats of the latest stated version of each load.

    Names that aren't those of a load are left out. A series has a load a month at most, which bounds its window.
    """
    named = manifest.filter(F.col("column_stats").isNotNull() & F.col("filename").rlike(MONTH))
    latest = named.groupBy("filename").agg(F.max_by(F.struct("row_count", "column_stats"), _stamp()).alias("v"))
    part = lambda i: F.regexp_extract("filename", MONTH, i)
    return latest.select(F.concat(part(1), F.lit("_"), part(3)).alias("series"), part(2).alias("load"), "v.row_count", "v.column_stats")


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    store = CountStore(spark, scratch(spark), "series string", "usage_ratio double")
    store.apply_all(stated_deltas(stated_loads(table(spark, sf_dir, "manifest")), "series", "load"))
    kind, number = F.substring_index("series", "_", 1), F.substring_index("series", "_", -1)
    filename = F.concat(F.lit("new-"), kind, F.lit("_"), "load", F.lit("_"), number, F.lit(".parquet"))
    return load_changes(store).select(filename.alias("filename"), "column_name", "issue")


PROFILED = ["filename", "file_size", "last_modified", "row_count", "conversion_method", "schema_types", "column_stats", "conversion_history"]
PATTERNS = {"filename": MONTH, "last_modified": r"^\d{4}-\d{2}-\d{2}[T ]\d{2}:\d{2}:\d{2}(Z|\+00:00)?$", "row_count": r"^\d+$"}


def p5_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Profile of the manifest's columns after each month of conversions, from a store of value counts.

    A version of a file adds its values in the month of its last_modified and takes away those of the version before
    (the one of an earlier time; at the same time by size, rows and method), so that reruns and copies replace. Of nested
    columns the range is left out: it would be one of JSON texts.
    """
    m = table(spark, sf_dir, "manifest").withColumns({"_stamp": _stamp()}).withColumn("load", F.date_format("_stamp", "yyyy-MM"))
    order = Window.partitionBy("filename").orderBy("_stamp", F.asc_nulls_first("file_size"), F.asc_nulls_first("row_count"), F.asc_nulls_first("conversion_method"))
    move = lambda at, sign: F.struct(F.col(at).alias("load"), F.lit(sign).alias("weight"))
    moves = F.filter(F.array(move("load", 1), move("until", -1)), lambda x: x.load.isNotNull())
    signed = m.withColumn("until", F.lead("load").over(order)).select(F.explode(moves).alias("_m"), *PROFILED).select("_m.*", *PROFILED)
    store = CountStore(spark, scratch(spark))
    store.apply_all(value_counts(signed, PROFILED, ["load"], weight="weight"))
    nested = [c for c, t in signed.dtypes if t.startswith(("map", "struct"))]
    p = profile_history(store.loads(), "load", PATTERNS, numeric_columns(signed)).withColumnRenamed("load", "month")
    bare = lambda c: F.when(~F.col("column_name").isin(nested), F.col(c)).alias(c)
    return p.withColumns({c: bare(c) for c in ("least", "most")})


QUERIES = {f.__name__: f for f in (p1_found, p1_paths, p1_descendants, p2_found, p2_sessions, p3_found, p3_profiles, p3_percentiles, p4_found, p4_tables, p4_rows, p4_schemas, p5_found, p5_profile)}

SEC = "CASE WHEN created_utc > 100000000000 THEN created_utc // 1000 ELSE created_utc END"
DAY = "strftime(DATE '1970-01-01' + CAST(t // 86400 AS INTEGER), '%Y-%m-%d')"
REF = "lower(trim({}, ' ' || chr(9) || chr(10) || chr(13)))"
SESSIONS = f"""
WITH e AS (SELECT author, id, min({SEC}) AS t FROM master_schema_rc
           WHERE author IS NOT NULL AND author NOT IN ('', '[deleted]') AND created_utc IS NOT NULL AND id IS NOT NULL GROUP BY author, id),
g AS (SELECT *, CASE WHEN t - lag(t) OVER (PARTITION BY author ORDER BY t) <= 1800 THEN 0 ELSE 1 END AS fresh FROM e),
s AS (SELECT *, sum(fresh) OVER (PARTITION BY author ORDER BY t ROWS UNBOUNDED PRECEDING) AS k FROM g)
SELECT author, min(t) AS session_start, max(t) AS session_end, {{}} CAST(count(*) AS BIGINT) AS n_comments FROM s GROUP BY author, k"""

LINKS = f"""n AS (SELECT id, min({REF.format("parent_id")}) AS p, min({REF.format("link_id")}) AS link FROM master_schema_rc WHERE id IS NOT NULL GROUP BY id),
e AS (SELECT n.id, CASE WHEN n.p LIKE 't3\\_%' ESCAPE '\\' THEN NULL WHEN n.p LIKE 't1\\_%' ESCAPE '\\' THEN substr(n.p, 4) ELSE n.p END AS up, CASE WHEN n.p LIKE 't3\\_%' ESCAPE '\\' THEN n.p END AS top, n.link FROM n),
x AS (SELECT e.id, m.id AS up, e.top, e.link FROM e LEFT JOIN n m ON m.id = e.up)"""
STATES = """ring AS (SELECT src AS id FROM w WHERE src = dst),
ends AS (SELECT w.src AS id, x.top FROM w JOIN x ON x.id = w.dst WHERE x.up IS NULL UNION ALL SELECT id, top FROM x WHERE up IS NULL),
states AS (SELECT x.id, CASE WHEN x.id IN (SELECT id FROM ring) THEN 'cycle' WHEN e.id IS NULL THEN 'to_cycle' WHEN e.top IS NULL THEN 'lost' WHEN e.top IS DISTINCT FROM x.link THEN 'wrong_root' END AS state FROM x LEFT JOIN ends e ON e.id = x.id)"""

# Children of objects and arrays, level by level. own is the innermost object around that is an array element (own_fp its
# field path, above the one around it), rel the path from there, el whether the value is such an object itself.
NODES = """t AS (SELECT DISTINCT id, CASE WHEN json_type(extra_json) = 'VARCHAR' THEN json_extract_string(extra_json, '$') ELSE extra_json END AS x FROM master_schema_rs WHERE extra_json IS NOT NULL AND json_valid(extra_json)),
n AS (SELECT id, CAST(x AS JSON) AS j, '' AS fp, '' AS np, '' AS own_fp, '' AS own, '' AS above, '' AS rel, FALSE AS el, 0 AS depth FROM t WHERE json_valid(x)
 UNION ALL SELECT id, value, nfp, nnp, CASE WHEN isel THEN nfp ELSE own_fp END, CASE WHEN isel THEN nnp ELSE own END, CASE WHEN isel THEN own ELSE above END, CASE WHEN isel THEN '' ELSE nrel END, isel, depth + 1 FROM (
  SELECT n.*, e.value, arr AND e.type = 'OBJECT' AS isel, CASE WHEN arr THEN fp WHEN fp = '' THEN e.key ELSE fp || '.' || e.key END AS nfp,
   CASE WHEN arr THEN np || '[' || e.key || ']' WHEN np = '' THEN e.key ELSE np || '.' || e.key END AS nnp, CASE WHEN arr THEN rel || '[' || e.key || ']' WHEN rel = '' THEN e.key ELSE rel || '.' || e.key END AS nrel
  FROM (SELECT *, json_type(j) = 'ARRAY' AS arr FROM n WHERE json_type(j) IN ('OBJECT', 'ARRAY')) n, json_each(n.j) e)),
long AS (SELECT DISTINCT id, own_fp AS field_path, own AS node_path, above AS parent_path, CASE WHEN NOT el THEN rel END AS field,
  CASE json_type(j) WHEN 'OBJECT' THEN 'object' WHEN 'ARRAY' THEN 'array' WHEN 'VARCHAR' THEN 'string' WHEN 'BOOLEAN' THEN 'boolean' WHEN 'NULL' THEN 'null' ELSE 'number' END AS kind,
  CASE WHEN json_type(j) NOT IN ('OBJECT', 'ARRAY', 'NULL') THEN json_extract_string(j, '$') END AS value
 FROM n WHERE el OR depth > 0 AND (json_type(j) NOT IN ('OBJECT', 'ARRAY') OR CAST(j AS VARCHAR) IN ('{}', '[]')))"""

SQL = {
    "p1_found": f"""
WITH RECURSIVE {LINKS},
w AS (SELECT id AS src, up AS dst FROM x WHERE up IS NOT NULL UNION SELECT w.src, x.up FROM w JOIN x ON x.id = w.dst WHERE x.up IS NOT NULL),
{STATES} SELECT id, state FROM states WHERE state IS NOT NULL""",
    "p1_paths": f"""
WITH RECURSIVE {LINKS},
w AS (SELECT id AS src, up AS dst FROM x WHERE up IS NOT NULL UNION SELECT w.src, x.up FROM w JOIN x ON x.id = w.dst WHERE x.up IS NOT NULL),
{STATES},
p AS (SELECT x.id, coalesce(top, x.id) AS root, CASE WHEN top IS NULL THEN 0 ELSE 1 END AS depth, concat_ws('/', top, x.id) AS path FROM x WHERE up IS NULL
 UNION ALL SELECT id, NULL, NULL, id FROM ring
 UNION ALL SELECT x.id, p.root, p.depth + 1, p.path || '/' || x.id FROM p JOIN x ON x.up = p.id AND x.id NOT IN (SELECT id FROM ring)),
b AS (SELECT src AS id, src = min(dst) AS back FROM w WHERE src IN (SELECT id FROM ring) GROUP BY src),
below AS (SELECT dst AS id, count(*) AS n FROM w GROUP BY dst)
SELECT p.id, s.state, p.root, CAST(p.depth AS INTEGER) AS depth, coalesce(b.back, FALSE) AS back_edge, p.path, coalesce(below.n, 0) AS n_descendants
FROM p JOIN states s ON s.id = p.id LEFT JOIN b ON b.id = p.id LEFT JOIN below ON below.id = p.id""",
    "p1_descendants": f"""
WITH RECURSIVE {LINKS},
w AS (SELECT id AS src, up AS dst, 1 AS d, [up] AS seen FROM x WHERE up IS NOT NULL UNION ALL SELECT w.src, x.up, w.d + 1, list_append(w.seen, x.up) FROM w JOIN x ON x.id = w.dst WHERE x.up IS NOT NULL AND NOT list_contains(w.seen, x.up))
SELECT dst AS ancestor, src AS descendant, CAST(d AS INTEGER) AS distance FROM w
UNION ALL SELECT x.top, w.src, CAST(w.d + 1 AS INTEGER) FROM w JOIN x ON x.id = w.dst WHERE x.up IS NULL AND x.top IS NOT NULL
UNION ALL SELECT top, id, 1 FROM x WHERE up IS NULL AND top IS NOT NULL""",
    "p2_found": SESSIONS.format("") + " HAVING count(*) >= 5",
    "p2_sessions": SESSIONS.format("max(t) - min(t) AS duration,"),
    "p3_found": f"""
WITH k AS (SELECT 'author' AS field, author AS key_value, id, min({SEC}) AS t FROM master_schema_rc WHERE author IS NOT NULL AND created_utc IS NOT NULL AND id IS NOT NULL GROUP BY ALL
 UNION ALL SELECT 'subreddit', subreddit, id, min({SEC}) FROM master_schema_rc WHERE subreddit IS NOT NULL AND created_utc IS NOT NULL AND id IS NOT NULL GROUP BY ALL),
r AS (SELECT *, {DAY} AS utc_day, row_number() OVER (PARTITION BY field, key_value, t // 86400 ORDER BY t, id) AS place, count(*) OVER (PARTITION BY field, key_value, t // 86400) AS n FROM k)
SELECT field, key_value, utc_day, id AS mid_id FROM r WHERE n >= 20 AND place = (n + 1) // 2""",
    "p3_profiles": """
WITH r AS (SELECT DISTINCT 'author' AS field, author AS key_value, subreddit AS other, id FROM master_schema_rc WHERE author IS NOT NULL AND created_utc IS NOT NULL
 UNION ALL SELECT DISTINCT 'subreddit', subreddit, author, id FROM master_schema_rc WHERE subreddit IS NOT NULL AND created_utc IS NOT NULL),
v AS (SELECT field, key_value, other, count(*) AS n FROM r GROUP BY ALL),
o AS (SELECT *, row_number() OVER (PARTITION BY field, key_value ORDER BY (other IS NULL), n DESC, other) AS k FROM v)
SELECT field, key_value, CAST(sum(n) AS BIGINT) AS n_rows, count(other) AS n_values, max(CASE WHEN k = 1 THEN other END) AS top_value, max(CASE WHEN k = 1 AND other IS NOT NULL THEN n END) AS top_n FROM o GROUP BY ALL""",
    "p3_percentiles": """
WITH r AS (SELECT 'author' AS field, author AS key_value, score FROM master_schema_rc WHERE author IS NOT NULL AND created_utc IS NOT NULL AND score IS NOT NULL
 UNION ALL SELECT 'subreddit', subreddit, score FROM master_schema_rc WHERE subreddit IS NOT NULL AND created_utc IS NOT NULL AND score IS NOT NULL),
o AS (SELECT *, row_number() OVER (PARTITION BY field, key_value ORDER BY score) AS k, count(*) OVER (PARTITION BY field, key_value) AS n FROM r)
SELECT field, key_value, any_value(n) AS n, """ + ", ".join(f"max(CASE WHEN k = (n * {p} + 99) // 100 THEN score END) AS p{p}" for p in (25, 50, 75, 99)) + " FROM o GROUP BY field, key_value",
    "p4_found": f"WITH RECURSIVE {NODES} SELECT DISTINCT id, field_path, node_path, parent_path FROM long WHERE field IS NULL",
    "p4_tables": f"WITH RECURSIVE {NODES} SELECT * FROM long",
    "p4_rows": f"WITH RECURSIVE {NODES} SELECT id, field_path, node_path, parent_path, coalesce(string_agg(field || '=' || coalesce(value, 'null'), '; ' ORDER BY field) FILTER (field IS NOT NULL), '') AS fields FROM long GROUP BY ALL",
    "p4_schemas": f"WITH RECURSIVE {NODES} SELECT field_path, count(DISTINCT struct_pack(id, node_path)) FILTER (field IS NULL OR field_path = '') AS n_rows, CAST(count(DISTINCT field) AS INTEGER) AS n_columns FROM long GROUP BY field_path",
    "p5_found": r"""
WITH l AS (SELECT filename, row_count, column_stats, row_number() OVER (PARTITION BY filename ORDER BY TRY_CAST(replace(replace(replace(last_modified, 'T', ' '), 'Z', ''), '+00:00', '') AS TIMESTAMP) DESC NULLS LAST) AS k FROM manifest WHERE column_stats IS NOT NULL),
s AS (SELECT filename, row_count, column_stats, regexp_extract(filename, '^new-(R[CS])_(\d{4}-\d{2})_(\d+)', 1) || regexp_extract(filename, '^new-(R[CS])_(\d{4}-\d{2})_(\d+)', 3) AS series, regexp_extract(filename, '^new-(R[CS])_(\d{4}-\d{2})_(\d+)', 2) AS month FROM l WHERE k = 1),
b AS (SELECT *, lag(filename) OVER (PARTITION BY series ORDER BY month) AS before, lag(row_count) OVER (PARTITION BY series ORDER BY month) AS rows_before FROM s),
c AS (SELECT filename, row_count, unnest(map_entries(column_stats)) AS e FROM b),
d AS (SELECT filename, row_count AS n, e.key AS column_name, e.value.count AS c, e.value.usage_ratio AS r, e.value.count IS NULL OR e.value.count < 0 OR e.value.count > row_count AS bad FROM c),
j AS (SELECT d.*, p.c AS pc, p.n AS pn, p.bad AS pbad FROM d JOIN b USING (filename) LEFT JOIN d p ON p.filename = b.before AND p.column_name = d.column_name)
SELECT filename, column_name, 'count_range' AS issue FROM d WHERE bad
UNION ALL SELECT filename, column_name, 'ratio_off' FROM d WHERE NOT bad AND (r IS NULL OR abs(r - c / n) > 0.0005)
UNION ALL SELECT filename, column_name, 'share_shift' FROM j WHERE NOT bad AND NOT pbad AND abs(c / n - pc / pn) > 0.2
UNION ALL SELECT b.filename, p.column_name, 'column_gone' FROM b JOIN d p ON p.filename = b.before WHERE NOT EXISTS (SELECT 1 FROM d WHERE d.filename = b.filename AND d.column_name = p.column_name)
UNION ALL SELECT filename, '*', 'rows_jump' FROM b WHERE row_count > 2 * rows_before OR 2 * row_count < rows_before""",
    "p5_profile": r"""
WITH t AS (SELECT *, coalesce(TRY_CAST(replace(replace(replace(last_modified, 'T', ' '), 'Z', ''), '+00:00', '') AS TIMESTAMP), TIMESTAMP '1970-01-01') AS stamp FROM manifest),
m AS (SELECT *, strftime(stamp, '%Y-%m') AS month, row_number() OVER (PARTITION BY filename ORDER BY stamp, file_size NULLS FIRST, row_count NULLS FIRST, conversion_method NULLS FIRST) AS k FROM t),
l AS (SELECT month, row_number() OVER (ORDER BY month) AS seq FROM (SELECT DISTINCT month FROM m)),
s AS (SELECT l.month AS load, l.seq, m.* FROM l JOIN m ON m.month <= l.month QUALIFY row_number() OVER (PARTITION BY l.month, filename ORDER BY k DESC) = 1),
v AS (SELECT load, seq, 'filename' AS column_name, filename AS value, NULL AS number FROM s UNION ALL SELECT load, seq, 'file_size', CAST(file_size AS VARCHAR), file_size FROM s UNION ALL SELECT load, seq, 'last_modified', last_modified, NULL FROM s
 UNION ALL SELECT load, seq, 'row_count', CAST(row_count AS VARCHAR), row_count FROM s UNION ALL SELECT load, seq, 'conversion_method', conversion_method, NULL FROM s UNION ALL SELECT load, seq, 'schema_types', CAST(schema_types AS VARCHAR), NULL FROM s
 UNION ALL SELECT load, seq, 'column_stats', CAST(column_stats AS VARCHAR), NULL FROM s UNION ALL SELECT load, seq, 'conversion_history', CAST(conversion_history AS VARCHAR), NULL FROM s),
a AS (SELECT load, seq, column_name, value, any_value(number) AS number, count(*) AS n FROM v GROUP BY ALL),
x AS (SELECT *, sum(n) FILTER (value IS NOT NULL) OVER w AS g, sum(n) OVER w AS total FROM a WINDOW w AS (PARTITION BY load, column_name)),
z AS (SELECT DISTINCT seq, column_name, total FROM x),
d AS (SELECT coalesce(p.seq + 1, q.seq) AS seq, coalesce(p.column_name, q.column_name) AS column_name, sum(abs(coalesce(q.n, 0) * a.total - coalesce(p.n, 0) * b.total)) / any_value(a.total * b.total * 2) AS shift FROM x p FULL JOIN x q ON q.seq = p.seq + 1 AND q.column_name = p.column_name AND q.value IS NOT DISTINCT FROM p.value
 JOIN z a ON a.seq = coalesce(p.seq, q.seq - 1) AND a.column_name = coalesce(p.column_name, q.column_name) JOIN z b ON b.seq = a.seq + 1 AND b.column_name = a.column_name GROUP BY ALL)
SELECT load AS month, x.column_name, CAST(sum(n) AS BIGINT) AS n_rows, CAST(coalesce(sum(n) FILTER (value IS NULL), 0) AS BIGINT) AS n_null, round(coalesce(sum(n) FILTER (value IS NULL), 0) / sum(n), 6) AS null_rate, count(value) AS n_distinct,
 CASE WHEN x.column_name IN ('file_size', 'row_count') THEN CAST(min(number) AS VARCHAR) WHEN x.column_name IN ('filename', 'last_modified', 'conversion_method') THEN min(value) END AS least,
 CASE WHEN x.column_name IN ('file_size', 'row_count') THEN CAST(max(number) AS VARCHAR) WHEN x.column_name IN ('filename', 'last_modified', 'conversion_method') THEN max(value) END AS most,
 round(abs(coalesce(sum(CASE WHEN value IS NOT NULL THEN n / g * ln(n / g) END), 0)), 6) AS entropy,
 CAST(coalesce(sum(n) FILTER (x.column_name = 'filename' AND NOT regexp_matches(value, '^new-(R[CS])_(\d{4}-\d{2})_(\d+)\.parquet$') OR x.column_name = 'last_modified' AND NOT regexp_matches(value, '^\d{4}-\d{2}-\d{2}[T ]\d{2}:\d{2}:\d{2}(Z|\+00:00)?$') OR x.column_name = 'row_count' AND NOT regexp_matches(value, '^\d+$')), 0) AS BIGINT) AS n_violations,
 CASE WHEN x.seq > 1 THEN round(any_value(d.shift), 4) END AS shift
FROM x LEFT JOIN d ON d.seq = x.seq AND d.column_name = x.column_name GROUP BY load, x.seq, x.column_name""",
}
