"""Queries p6 to p10 and their SQL where it can be written."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewell.functions.reading import known_author, seconds, utc_day
from tidewell.llm.bitmaps import estimate, merge, sketch
from tidewell.llm.frequent import frequent_share, top_values
from tidewell.llm.leaks import leaks
from tidewell.llm.packing import count_tokens, pack
from tidewell.llm.spans import maximal_repeats, shared_spans
from tidewell.session import cut, tune

#: Keys of p7_found to be counted again that are sent to every executor at most; more are joined by a salted shuffle.
BROADCAST_ROWS = 50_000
#: Standard errors around an estimate, and a count more for tiny sketches, within which a condition isn't decided by it.
SIGMAS, SPARE = 6, 2
CAPACITY = 2048


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    tune(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """field, item, day of every comment row with a time."""
    rc = table(spark, sf_dir, "master_schema_rc").filter("created_utc IS NOT NULL")
    both = F.explode(F.array(*[F.struct(F.lit(f).alias("field"), F.col(f).alias("item")) for f in ("author", "subreddit")]))
    return rc.select(both.alias("k"), F.floor(seconds("created_utc") / 86400).cast("int").alias("day")).select("k.field", "day", "k.item")


def _day(df: DataFrame) -> DataFrame:
    return df.withColumn("utc_day", utc_day(F.col("day") * F.lit(86400).cast("bigint"))).drop("day")


def p6_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _day(frequent_share(_items(spark, sf_dir), ["field", "day"], "item", 1 / 50)).select("field", "item", "utc_day")


def p6_top(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 10 most frequent authors and subreddits of each day, with counts."""
    return _day(top_values(_items(spark, sf_dir), ["field", "day"], "item", 10)).select("field", "item", "utc_day", "n", "place")


def _known(spark: SparkSession, sf_dir: str) -> DataFrame:
    rc = table(spark, sf_dir, "master_schema_rc").filter(known_author("author") & F.col("subreddit").isNotNull() & F.col("created_utc").isNotNull())
    return rc.select("author", "subreddit", "id", F.floor(seconds("created_utc") / 86400).cast("int").alias("day"))


def _grains(known: DataFrame) -> DataFrame:
    """grain, key_value, day, what, item: the identifiers to count for each grain."""
    g = lambda grain, key, what, item: F.struct(F.lit(grain).alias("grain"), F.col(key).alias("key_value"), F.lit(what).alias("what"), F.col(item).alias("item"))
    each = F.explode(F.array(g("subreddit", "subreddit", "ids", "id"), g("subreddit", "subreddit", "authors", "author"), g("author", "author", "subreddits", "subreddit")))
    return known.select("day", each.alias("g")).select("g.*", "day")


def p7_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bitmaps give every key's estimates and decide all keys whose conditions are clear of the estimates' errors.

    The others, with a condition within 6 standard errors (and 2) of its limit, are counted exactly. An estimate is farther
    off than that for one key in 10^9 or so.
    """
    rows = _grains(_known(spark, sf_dir))
    keys = ["grain", "key_value", "day"]
    est = estimate(sketch(rows, [*keys, "what"], "item"), [*keys, "what"])
    off = SIGMAS * F.col("std_error") + SPARE
    of = lambda what: F.max(F.when(F.col("what") == what, F.struct(F.greatest(F.col("estimate") - off, F.lit(0.0)).alias("low"), (F.col("estimate") + off).alias("high"))))
    both = est.groupBy(*keys).agg(*[of(w).alias(w) for w in ("ids", "authors", "subreddits")])
    maybe = F.expr("(grain = 'subreddit' AND ids.high >= 40 AND 5 * authors.low < ids.high) OR (grain = 'author' AND subreddits.high >= 30)")
    clear = F.expr("(grain = 'subreddit' AND ids.low >= 40 AND 5 * authors.high < ids.low) OR (grain = 'author' AND subreddits.low >= 30)")
    decided = cut(both.filter(maybe).select(*keys, clear.alias("clear")))
    band = decided.filter("NOT clear").drop("clear")
    n = band.count()
    if n <= BROADCAST_ROWS:
        among = rows.join(F.broadcast(band), keys)
    else:
        salts = 16
        salted = band.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
        among = rows.withColumn("salt", F.pmod(F.xxhash64("item"), F.lit(salts)).cast("int")).join(salted, [*keys, "salt"])
    exact = among.groupBy(*keys, "what", "item").agg(F.lit(1).alias("one")).groupBy(*keys).agg(*[F.sum(F.when(F.col("what") == w, 1).otherwise(0)).alias(w) for w in ("ids", "authors", "subreddits")])
    true = exact.filter("(grain = 'subreddit' AND ids >= 40 AND 5 * authors < ids) OR (grain = 'author' AND subreddits >= 30)").select(*keys)
    return _day(decided.filter("clear").drop("clear").unionByName(true)).select("grain", "key_value", "utc_day")


#: What p7_estimates counts, and the combinations it counts it for; the first is sketched, the others are merged from it.
COUNTED = {
    "author": (["day", "subreddit"], ["day"], ["subreddit"], []),
    "subreddit": (["day", "author"], ["day"], ["author"], []),
}


def p7_estimates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct authors per day and subreddit and distinct subreddits per day and author, each also per day, per key and in all.

    ``counted`` names what is counted; a key that a combination doesn't have is null. Only finest sketches read the rows.
    """
    out = None
    for counted, combinations in COUNTED.items():
        finest = combinations[0]
        fine = cut(sketch(_known(spark, sf_dir), finest, counted))
        for groups in combinations:
            e = estimate(fine if groups == finest else merge(fine, groups), groups)
            key = lambda c, t: (F.col(c) if c in groups else F.lit(None)).cast(t).alias(c)  # noqa: B023, E731
            e = e.select(F.lit(counted).alias("counted"), key("day", "int"), key("subreddit", "string"), key("author", "string"), F.round("estimate").cast("bigint").alias("estimate"), "std_error")
            out = e if out is None else out.unionByName(e)
    return _day(out)


def p7_checked(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The exact number for each of p7_estimates, and whether the estimate lies within 6 standard errors (and 2) of it."""
    pairs = cut(_known(spark, sf_dir).select("day", "subreddit", "author").distinct())
    exact = None
    for counted, combinations in COUNTED.items():
        for groups in combinations:
            distinct = pairs.select(*groups, counted).distinct().groupBy(*groups).agg(F.count("*").alias("exact"))
            key = lambda c, t: (F.col(c) if c in groups else F.lit(None)).cast(t).alias(c)  # noqa: B023, E731
            one = distinct.filter("exact > 0").select(F.lit(counted).alias("counted"), key("day", "int"), key("subreddit", "string"), key("author", "string"), "exact")
            exact = one if exact is None else exact.unionByName(one)
    keys = ["counted", "utc_day", "subreddit", "author"]
    e, x = p7_estimates(spark, sf_dir).alias("e"), _day(exact).alias("x")
    same = [F.col(f"e.{k}").eqNullSafe(F.col(f"x.{k}")) for k in keys]
    within = F.abs(F.col("estimate") - F.col("exact")) <= SIGMAS * F.col("std_error") + SPARE
    return x.join(e, same, "left").select(*[f"x.{k}" for k in keys], "exact", F.coalesce(within, F.lit(False)).alias("within"))


def _packed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(count_tokens(table(spark, sf_dir, "documents"), "doc_id", "text"), "doc_id", F.col("n_tokens"), CAPACITY)


def p8_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _packed(spark, sf_dir).filter("n_pieces > 1").select(F.col("item_id").alias("doc_id")).distinct()


def p8_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every piece of every document with its container."""
    return _packed(spark, sf_dir).withColumnRenamed("item_id", "doc_id")


def p8_checked(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of each document what its pieces make up, whether they and all beside them fit their containers, and whether the
    containers are at most 1 % more than the tokens need, and one for each block."""
    packed = cut(_packed(spark, sf_dir))
    fill = packed.groupBy("container").agg(F.sum("size").alias("fill"))
    total = fill.agg(F.count("*"), F.coalesce(F.sum("fill"), F.lit(0))).first()
    least = -(-total[1] // CAPACITY)
    close = total[0] <= least * 1.01 + 1 + packed.count() // 4096
    each = packed.join(fill, "container").groupBy(F.col("item_id").alias("doc_id"))
    return each.agg(F.sum("size").cast("bigint").alias("n_tokens"), F.count("*").alias("n_pieces"), F.count_distinct("piece").alias("n_numbers"), F.count(F.when(F.col("size") < CAPACITY, 1)).alias("n_rests"), (F.max("fill") <= CAPACITY).alias("fits"), F.lit(close).alias("close"))


def _leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "heldout_items"), window=16, budget=1)


def p9_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _leaks(spark, sf_dir).filter("distance = 0").select("doc_id", "item_id")


def p9_leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Also passages with one word inserted, lost or changed."""
    return _leaks(spark, sf_dir).select("doc_id", "item_id", "distance")


def _spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shared_spans(table(spark, sf_dir, "documents"), "doc_id", "text", length=200)


def p10_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _spans(spark, sf_dir).select("doc_id", F.when(2 * F.col("shared_chars") >= F.col("n_chars"), "most").otherwise("some").alias("extent"))


def p10_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What of each document stands elsewhere, as the union of all shared stretches."""
    return _spans(spark, sf_dir).select("doc_id", "n_chars", "shared_chars", F.explode("spans").alias("s")).select("doc_id", "n_chars", "shared_chars", F.col("s.start").alias("span_start"), F.col("s.end").alias("span_end"))


def p10_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The maximal repeats of each document, each with a document that has it whole, and where."""
    return maximal_repeats(table(spark, sf_dir, "documents"), "doc_id", "text", length=200)


def p10_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The maximal repeats alone."""
    return p10_repeats(spark, sf_dir).select("doc_id", "span_start", "span_end")


QUERIES = {f.__name__: f for f in (p6_found, p6_top, p7_found, p7_estimates, p7_checked, p8_found, p8_pack, p8_checked, p9_found, p9_leaks, p10_found, p10_coverage, p10_repeats, p10_spans)}

SEC = "CASE WHEN created_utc > 100000000000 THEN created_utc // 1000 ELSE created_utc END"
DAY = f"strftime(DATE '1970-01-01' + CAST(({SEC}) // 86400 AS INTEGER), '%Y-%m-%d')"
ITEMS = f"r AS (SELECT 'author' AS field, author AS item, {DAY} AS utc_day FROM master_schema_rc WHERE author IS NOT NULL AND created_utc IS NOT NULL UNION ALL SELECT 'subreddit', subreddit, {DAY} FROM master_schema_rc WHERE subreddit IS NOT NULL AND created_utc IS NOT NULL)"
WORDS = "string_split(trim(regexp_replace(lower(text), '[^\\p{L}\\p{N}]+', ' ', 'g')), ' ')"

SQL = {
    "p6_found": f"WITH {ITEMS}, c AS (SELECT field, item, utc_day, count(*) AS n FROM r GROUP BY ALL), t AS (SELECT *, sum(n) OVER (PARTITION BY field, utc_day) AS total FROM c) SELECT field, item, utc_day FROM t WHERE n * 50 >= total",
    "p6_top": f"WITH {ITEMS}, c AS (SELECT field, item, utc_day, count(*) AS n FROM r GROUP BY ALL), t AS (SELECT *, row_number() OVER (PARTITION BY field, utc_day ORDER BY n DESC, item) AS place FROM c) SELECT * FROM t WHERE place <= 10",
    "p7_found": f"""
WITH k AS (SELECT author, subreddit, id, {DAY} AS utc_day FROM master_schema_rc WHERE author IS NOT NULL AND author NOT IN ('', '[deleted]') AND subreddit IS NOT NULL AND created_utc IS NOT NULL)
SELECT 'subreddit' AS grain, subreddit AS key_value, utc_day FROM k GROUP BY ALL HAVING count(DISTINCT id) >= 40 AND 5 * count(DISTINCT author) < count(DISTINCT id)
UNION ALL SELECT 'author', author, utc_day FROM k GROUP BY ALL HAVING count(DISTINCT subreddit) >= 30""",
    "p7_checked": f"""
WITH k AS (SELECT DISTINCT author, subreddit, {DAY} AS utc_day FROM master_schema_rc WHERE author IS NOT NULL AND author NOT IN ('', '[deleted]') AND subreddit IS NOT NULL AND created_utc IS NOT NULL)
SELECT 'author' AS counted, utc_day, subreddit, NULL AS author, count(DISTINCT author) AS exact, TRUE AS within FROM k GROUP BY GROUPING SETS ((utc_day, subreddit), (utc_day), (subreddit), ()) HAVING count(*) > 0
UNION ALL SELECT 'subreddit', utc_day, NULL, author, count(DISTINCT subreddit), TRUE FROM k GROUP BY GROUPING SETS ((utc_day, author), (utc_day), (author), ()) HAVING count(*) > 0""",
    "p8_checked": r"""
WITH t AS (SELECT doc_id, max(len(regexp_extract_all(text, '[A-Za-z0-9_]+|[^A-Za-z0-9_ \t\r\n]+'))) AS n FROM documents GROUP BY doc_id)
SELECT doc_id, n AS n_tokens, (n + 2047) // 2048 AS n_pieces, (n + 2047) // 2048 AS n_numbers, CASE WHEN n % 2048 = 0 THEN 0 ELSE 1 END AS n_rests, TRUE AS fits, TRUE AS "close" FROM t WHERE n > 0""",
    "p8_found": r"SELECT doc_id FROM documents WHERE len(regexp_extract_all(text, '[A-Za-z0-9_]+|[^A-Za-z0-9_ \t\r\n]+')) > 2048",
    "p9_found": f"""
WITH i AS (SELECT item_id, {WORDS} AS w FROM heldout_items), d AS (SELECT doc_id, {WORDS} AS w FROM documents WHERE text IS NOT NULL),
gi AS (SELECT DISTINCT item_id, array_to_string(w[k:k + 15], ' ') AS g FROM (SELECT item_id, w, unnest(range(1, len(w) - 14)) AS k FROM i)),
gd AS (SELECT DISTINCT doc_id, array_to_string(w[k:k + 15], ' ') AS g FROM (SELECT doc_id, w, unnest(range(1, len(w) - 14)) AS k FROM d))
SELECT DISTINCT doc_id, item_id FROM gd JOIN gi USING (g)""",
    # An item's 16 words as they are, with a word left out, or with one of the words left out on both sides; a document's 17 with an inner one left out.
    "p9_leaks": f"""
WITH i AS (SELECT item_id, {WORDS} AS w FROM heldout_items WHERE text IS NOT NULL), d AS (SELECT doc_id, {WORDS} AS w FROM documents WHERE text IS NOT NULL),
wi AS (SELECT DISTINCT item_id, w[k:k + 15] AS g FROM (SELECT item_id, w, unnest(range(1, len(w) - 14)) AS k FROM i)),
wd AS (SELECT doc_id, len(w) AS n, k, w FROM (SELECT doc_id, w, unnest(range(1, len(w) - 13)) AS k FROM d)),
m AS (SELECT item_id, array_to_string(g, ' ') AS whole, p, array_to_string(g[1:p - 1] || g[p + 1:16], ' ') AS less FROM wi, range(1, 17) r(p)),
x AS (SELECT DISTINCT doc_id, item_id, 0 AS distance FROM wd JOIN (SELECT DISTINCT item_id, whole FROM m) q ON array_to_string(wd.w[k:k + 15], ' ') = q.whole WHERE k + 15 <= n
 UNION ALL SELECT DISTINCT doc_id, item_id, 1 FROM wd JOIN m ON array_to_string(wd.w[k:k + 14], ' ') = m.less
 UNION ALL SELECT DISTINCT doc_id, item_id, 1 FROM (SELECT doc_id, r.p, array_to_string(w[k:k + r.p - 2] || w[k + r.p:k + 15], ' ') AS less FROM wd, range(1, 17) r(p) WHERE k + 15 <= n) q JOIN m ON m.p = q.p AND m.less = q.less
 UNION ALL SELECT DISTINCT doc_id, item_id, 1 FROM (SELECT doc_id, array_to_string(w[k:k + r.p - 2] || w[k + r.p:k + 16], ' ') AS whole FROM wd, range(2, 17) r(p) WHERE k + 16 <= n) q JOIN (SELECT DISTINCT item_id, whole FROM m) h ON h.whole = q.whole)
SELECT doc_id, item_id, CAST(min(distance) AS INTEGER) AS distance FROM x GROUP BY ALL""",
    "p10_coverage": """
WITH d AS (SELECT doc_id, text, length(text) AS n FROM documents WHERE length(text) >= 200),
g AS (SELECT doc_id, n, k, hash(substring(text, k, 200)) AS h FROM (SELECT doc_id, text, n, unnest(range(1, n - 198)) AS k FROM d)),
b AS (SELECT h FROM g GROUP BY h HAVING min(doc_id) <> max(doc_id)),
s AS (SELECT doc_id, n, k, CASE WHEN k - lag(k) OVER (PARTITION BY doc_id ORDER BY k) <= 200 THEN 0 ELSE 1 END AS fresh FROM g SEMI JOIN b USING (h)),
i AS (SELECT *, sum(fresh) OVER (PARTITION BY doc_id ORDER BY k ROWS UNBOUNDED PRECEDING) AS span FROM s),
u AS (SELECT doc_id, n, min(k) - 1 AS a, max(k) + 199 AS b FROM i GROUP BY doc_id, n, span)
SELECT doc_id, CAST(n AS INTEGER) AS n_chars, CAST(sum(b - a) OVER (PARTITION BY doc_id) AS INTEGER) AS shared_chars, CAST(a AS INTEGER) AS span_start, CAST(b AS INTEGER) AS span_end FROM u""",
    "p10_spans": """
WITH d AS (SELECT doc_id, text, length(text) AS n FROM documents WHERE length(text) >= 200),
g AS (SELECT doc_id, k, hash(substring(text, k, 200)) AS h FROM (SELECT doc_id, text, unnest(range(1, n - 198)) AS k FROM d)),
b AS (SELECT h FROM g GROUP BY h HAVING min(doc_id) <> max(doc_id)), c AS (SELECT * FROM g SEMI JOIN b USING (h)),
p AS (SELECT x.doc_id, y.doc_id AS other, y.k - x.k AS shift, x.k FROM c x JOIN c y ON x.h = y.h AND x.doc_id <> y.doc_id),
i AS (SELECT *, k - row_number() OVER (PARTITION BY doc_id, other, shift ORDER BY k) AS island FROM p),
r AS (SELECT DISTINCT doc_id, a, b FROM (SELECT doc_id, min(k) - 1 AS a, max(k) + 199 AS b FROM i GROUP BY doc_id, other, shift, island)),
m AS (SELECT *, max(b) OVER (PARTITION BY doc_id ORDER BY a, b DESC ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reached FROM r)
SELECT doc_id, CAST(a AS INTEGER) AS span_start, CAST(b AS INTEGER) AS span_end FROM m WHERE reached IS NULL OR b > reached""",
    "p10_found": """
WITH d AS (SELECT doc_id, text, length(text) AS n FROM documents WHERE length(text) >= 200),
g AS (SELECT doc_id, n, k, hash(substring(text, k, 200)) AS h FROM (SELECT doc_id, text, n, unnest(range(1, n - 198)) AS k FROM d)),
b AS (SELECT h FROM g GROUP BY h HAVING min(doc_id) <> max(doc_id)),
s AS (SELECT doc_id, n, k, k - lag(k) OVER (PARTITION BY doc_id ORDER BY k) AS step FROM g SEMI JOIN b USING (h))
SELECT doc_id, CASE WHEN 2 * sum(CASE WHEN step IS NULL THEN 200 ELSE least(step, 200) END) >= any_value(n) THEN 'most' ELSE 'some' END AS extent FROM s GROUP BY doc_id""",
}
