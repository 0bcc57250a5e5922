"""From JSON lines to one fixed wide schema without losing a field.

Known fields are promoted and cast, missing ones are null, all others stay in one JSON column. A line is parsed once for
all known fields; fields with a type of their own come as variants, which tell a text from a number. Unknown fields are
parsed only where a line has some. JSON text is canonical: no blanks between tokens, 1.50 as 1.5.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewell.functions.coerce import coerce, edited
from tidewell.schema import EXTRA, master_schema


BAD = "_bad"


def _read_as(f: T.StructField) -> T.DataType:
    """Flat columns are read as text, of which nearly all need no more; others as variants."""
    return T.StringType() if f.name != "edited" and isinstance(f.dataType, (T.StringType, T.LongType, T.BooleanType)) else T.VariantType()


def parse(lines: DataFrame, schema: T.StructType, text: str = "value", keep: list[str] | None = None) -> DataFrame:
    """text, record and rest of lines, for tables of the given schema, after the columns to ``keep``.

    record has the schema's fields as they are read and is null for lines that hold no JSON object; rest names the fields
    that the schema doesn't have. Blank and null lines are skipped. Of repeated keys the last holds.
    """
    fields = [T.StructField(f.name, _read_as(f)) for f in schema if f.name != EXTRA]
    known = F.array(*[F.lit(f.name) for f in fields]) if fields else F.array().cast("array<string>")
    raw = F.from_json(text, T.StructType([*fields, T.StructField(BAD, T.StringType())]), {"columnNameOfCorruptRecord": BAD})
    # A filter on the outcome would be pushed below the parse and repeat it; a generator keeps it in one place.
    once = F.explode(F.array(F.struct(raw.alias("r"), F.array_except(F.json_object_keys(text), known).alias("rest")))).alias("p")
    rows = lines.filter(F.trim(F.col(text)) != "").select(*(keep or []), F.col(text).alias("text"), once)
    good = F.col("p.rest").isNotNull() & F.col(f"p.r.{BAD}").isNull()
    return rows.select(*(keep or []), "text", F.when(good, F.col("p.r")).alias("record"), F.col("p.rest").alias("rest"))


def quarantine(parsed: DataFrame) -> DataFrame:
    """The lines that are no JSON object, for a table of their own."""
    return parsed.filter("record IS NULL").select(F.col("text").alias("value"))


def overflow(text: Column, rest: Column) -> Column:
    """JSON text of the named fields, explicit nulls included; null if there is none.

    Only lines that have such fields are parsed again for them.
    """
    kept = F.map_filter(F.from_json(text, "map<string,variant>"), lambda k, _: F.array_contains(rest, k))
    return F.when(F.size(rest) > 0, F.to_json(kept, {"ignoreNullFields": "false"}))


def _flat(s: Column, f: T.StructField) -> Column:
    """A flat column from its text. What isn't plainly of its type is read again as a variant, to tell texts from numbers."""
    if isinstance(f.dataType, T.StringType):
        return s
    again = coerce(F.try_variant_get(F.try_parse_json("text"), f"$['{f.name}']", "variant"), f.dataType)
    if isinstance(f.dataType, T.BooleanType):
        return F.when(s.isNull(), None).when(s.isin("true", "1"), True).when(s.isin("false", "0"), False).otherwise(again)
    return F.when(s.isNull(), None).otherwise(F.coalesce(s.try_cast("bigint"), again))


def promoted(schema: T.StructType, edited_mode: str = "record") -> list[Column]:
    """The columns of the schema from those of :func:`parse`; all null for a line that is no object."""
    columns = []
    for f in schema:
        v = F.col(f"record.`{f.name}`")
        if f.name == EXTRA:
            c = overflow(F.col("text"), F.col("rest"))
        elif isinstance(_read_as(f), T.StringType):
            c = _flat(v, f)
        else:
            c = F.when(v.isNotNull(), edited(v, edited_mode) if f.name == "edited" else coerce(v, f.dataType))
        columns.append(c.alias(f.name))
    return columns


def promote(parsed: DataFrame, schema: T.StructType, *, edited_mode: str = "record", keep: list[str] | None = None) -> DataFrame:
    """The columns of the schema, in its order, from parsed lines, after the columns to ``keep``; its last may be the overflow column.

    Absent fields and JSON nulls are null. Lines that are no object give no row (see :func:`quarantine`).
    """
    return parsed.filter("record IS NOT NULL").select(*(keep or []), *promoted(schema, edited_mode))


def split(lines: DataFrame, kind: str, keep: list[str] | None = None, text: str = "value") -> DataFrame:
    """Every line that isn't blank as one row, in one parse: the columns to keep, _bad and the wide columns.

    _bad is the line itself where it is no JSON object, and the wide columns are null there; else it is null.
    """
    schema = master_schema(kind)
    parsed = parse(lines, schema, text, keep)
    return parsed.select(*(keep or []), F.when(F.col("record").isNull(), F.col("text")).alias(BAD), *promoted(schema))


def normalize(lines: DataFrame, kind: str, text: str = "value", *, edited_mode: str = "record") -> DataFrame:
    """JSON lines of a record kind (rc or rs) as its wide table."""
    schema = master_schema(kind)
    return promote(parse(lines, schema, text), schema, edited_mode=edited_mode)


def pad(df: DataFrame, schema: T.StructType) -> DataFrame:
    """A table with the schema's columns in its order: missing ones are null, others are bundled into the overflow column."""
    have = {f.name: f.dataType for f in df.schema}
    names = {f.name for f in schema}
    rest = [c for c in have if c not in names]
    columns = []
    for f in schema:
        if f.name in have:
            columns.append(F.col(f"`{f.name}`").try_cast(f.dataType).alias(f.name))
        elif f.name == EXTRA and rest:
            columns.append(F.to_json(F.struct(*[F.col(f"`{c}`") for c in rest]), {"ignoreNullFields": "false"}).alias(EXTRA))
        else:
            columns.append(F.lit(None).cast(f.dataType).alias(f.name))
    return df.select(*columns)


def rebuild(df: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """Adds ``record_json``: the promoted fields that aren't null and the overflow, as one JSON object, without the columns in ``keep``."""
    known = [c for c in df.columns if c not in (EXTRA, *(keep or []))]
    own = F.col("_own")  # a column, so that it is made once
    inner = lambda s: F.substring(s, F.lit(2), F.length(s) - 2)
    more = F.coalesce(F.col(EXTRA), F.lit("{}"))
    joined = F.concat_ws(",", F.when(own != "{}", inner(own)), F.when(more != "{}", inner(more)))
    told = df.withColumn("_own", F.to_json(F.struct(*[F.col(f"`{c}`") for c in known])))
    return told.withColumn("record_json", F.concat(F.lit("{"), joined, F.lit("}"))).drop("_own")
