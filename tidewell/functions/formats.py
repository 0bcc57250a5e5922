"""Names, sizes, speeds and times as text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The forms of archive, table and metadata names.
ARCHIVE = r"^(RC|RS)_(\d{4})-(\d{2})\.zst$"
TABLE_PREFIX, TABLE_SUFFIX, MANIFEST_SUFFIX, CLAIM_SUFFIX = "new-", ".parquet", ".manifest.json", ".claim.json"
CHUNK = r"chunk_(\d+)\.parquet$"
UNITS = ["B", "KB", "MB", "GB"]
LONG_UNITS = ["B", "KB", "MB", "GB", "TB", "PB", "EB", "ZB", "YB"]


def _one(x: Column, unit: str) -> Column:
    """One decimal, by the exact value of the double: only what is a half exactly goes to even."""
    x = x.cast("double")
    r = x * 10.0
    # Split x in two so that ten times each part is exact, and what r was rounded by is known.
    c = x * 134217729.0
    high = c - (c - x)
    off = (high * 10.0 - r) + (x - high) * 10.0
    tenths = F.when((r - F.floor(r) == 0.5) & (off != 0), F.floor(r).cast("double") + F.when(off > 0, 1.0).otherwise(0.0)).otherwise(F.rint(r))
    return F.format_string(f"%.1f {unit}", tenths / 10.0)


def format_size(n: Column) -> Column:
    """Bytes with a unit, from 1024 on with one decimal; N/A for null."""
    out = _one(n / 2.0**30, "GB")
    for k in (2, 1):
        out = F.when(n < 1024 ** (k + 1), _one(n / 1024.0**k, UNITS[k])).otherwise(out)
    return F.when(n.isNull(), "N/A").when(n < 1024, F.format_string("%d B", n.cast("bigint"))).otherwise(out)


def format_size_long(n: Column) -> Column:
    """Bytes with two decimals in the largest fitting of nine units; 0B for zero."""
    x = n.cast("double")
    k = F.greatest(F.lit(0), F.least(F.lit(len(LONG_UNITS) - 1), F.floor(F.log2(x) / 10 + 1e-12))).cast("int")
    unit = F.element_at(F.array(*[F.lit(u) for u in LONG_UNITS]), k + 1)
    value = F.round(x / F.pow(F.lit(1024.0), k), 2)
    return F.when(n == 0, "0B").when(n.isNotNull(), F.concat(F.format_string("%.2f", value), F.lit(" "), unit)).otherwise("N/A")


def format_speed(n: Column, sec: Column) -> Column:
    """Bytes per second with a unit; N/A unless the time is positive."""
    s = n / sec
    out = _one(s / 2.0**30, "GB/s")
    for k in (2, 1, 0):
        out = F.when(s < 1024.0 ** (k + 1), _one(s / 1024.0**k, f"{UNITS[k]}/s")).otherwise(out)
    return F.when((sec <= 0) | sec.isNull() | n.isNull(), "N/A").otherwise(out)


def format_seconds(text: Column) -> Column:
    x = text.try_cast("double")
    return F.when(x.isNull(), "N/A").otherwise(F.format_string("%.2fs", x))


def format_mb_s(text: Column, given: Column) -> Column:
    """A speed in MB/s; - where none is given, N/A where it isn't a number."""
    x = text.try_cast("double")
    return F.when(~given, "-").when(x.isNull(), "N/A").otherwise(F.format_string("%.2f MB/s", x))


def elapsed(sec: Column) -> Column:
    """Seconds, from a minute on as minutes and seconds."""
    s = F.floor(sec).cast("bigint")
    return F.when(s >= 60, F.format_string("%dm %ds", F.floor(s / 60).cast("bigint"), s % 60)).otherwise(F.format_string("%ds", s))


def mb_per_s(n: Column, sec: Column) -> Column:
    return F.when(sec > 0, F.round(n / 1048576.0 / sec, 2)).otherwise(0.0)


def record_kind(name: Column) -> Column:
    """rc, rs or null, by what the name contains."""
    return F.when(name.contains("RC_"), "rc").when(name.contains("RS_"), "rs")


def archive_part(name: Column, i: int) -> Column:
    """Kind (1), year (2) or month (3) of an archive's name; null for other names."""
    x = F.regexp_extract(name, ARCHIVE, i)
    return F.when(x != "", x)


def stem(name: Column) -> Column:
    """The name without its last suffix."""
    return F.regexp_replace(name, r"(?<=.)\.[^.]*$", "")


def table_name(archive: Column) -> Column:
    return F.concat(F.lit(TABLE_PREFIX), stem(archive), F.lit(TABLE_SUFFIX))


def manifest_name(archive: Column) -> Column:
    return F.concat(table_name(archive), F.lit(MANIFEST_SUFFIX))


def claim_name(archive: Column) -> Column:
    return F.concat(stem(archive), F.lit(CLAIM_SUFFIX))


def archive_name(table: Column) -> Column:
    """The archive that a table or manifest comes from."""
    bare = F.regexp_replace(F.regexp_replace(table, r"\.manifest\.json$", ""), r"\.parquet$", ".zst")
    return F.replace(bare, F.lit(TABLE_PREFIX), F.lit(""))


def chunk_number(name: Column) -> Column:
    return F.regexp_extract(name, CHUNK, 1).try_cast("int")


def iso_utc(sec: Column) -> Column:
    """Epoch seconds as ISO text in UTC."""
    return F.date_format(F.timestamp_seconds(sec), "yyyy-MM-dd'T'HH:mm:ss'Z'")


def stamp(text: Column) -> Column:
    """A stamp in any of the ISO notations as a timestamp; unreadable ones are null."""
    return text.try_cast("timestamp")


def redact(key: Column, value: Column) -> Column:
    """Hides non-empty values of keys that name secrets."""
    return F.when(F.lower(key).rlike("password|token|secret|key") & value.isNotNull() & (value != ""), "<redacted>").otherwise(value)


def host_name(candidates: Column) -> Column:
    """The best of an array of host names: those that are whole come first, then those with other characters than ASCII, then
    those with replacement characters, which are cut to ASCII; of equals the first. Without any it is unknown-node."""
    names = F.filter(candidates, lambda c: c.isNotNull() & (c != ""))
    plain = lambda c: ~c.rlike(r"[^\x00-\x7F]")
    broken = lambda c: c.contains("\ufffd")
    first = lambda ok: F.get(F.filter(names, ok), 0)
    best = F.coalesce(first(plain), first(lambda c: ~broken(c)), F.regexp_replace(first(broken), r"[^\x00-\x7F]", ""))
    return F.coalesce(best, F.lit("unknown-node"))


def text_table(df: DataFrame, columns: list[str]) -> DataFrame:
    """A table of text as lines: place and line, in the order of df's column ``place``; one row of widths is collected.

    Cells are padded to the longest of their column, the header's included; a null cell is empty. For reports.
    """
    cell = lambda c: F.coalesce(F.col(f"`{c}`").cast("string"), F.lit(""))
    widths = df.agg(*[F.coalesce(F.max(F.length(cell(c))), F.lit(0)) for c in columns]).first()
    widths = [max(len(c), w) for c, w in zip(columns, widths, strict=True)]
    line = lambda cells: F.concat(F.lit("| "), F.concat_ws(" | ", *cells), F.lit(" |"))
    border = F.lit("+" + "+".join("-" * (w + 2) for w in widths) + "+")
    head = line([F.lit(c.ljust(w)) for c, w in zip(columns, widths, strict=True)])
    frame = df.sparkSession.range(1).select(F.explode(F.array(F.struct(F.lit(-2).cast("bigint").alias("place"), border.alias("line")), F.struct(F.lit(-1).cast("bigint").alias("place"), head.alias("line")), F.struct(F.lit(0).cast("bigint").alias("place"), border.alias("line")), F.struct(F.lit(2**62).alias("place"), border.alias("line")))).alias("x")).select("x.*")
    return frame.unionByName(df.select(F.col("place").cast("bigint").alias("place"), line([F.rpad(cell(c), w, " ") for c, w in zip(columns, widths, strict=True)]).alias("line")))
