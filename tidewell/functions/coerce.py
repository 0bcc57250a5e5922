"""Casts of JSON values, by fixed rules and without errors: what can't be read is null.

Values come as variants, so that a text "2.5" and a number 2.5 can follow different rules. Everything is a Column
expression and stays in the JVM.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def kind(v: Column) -> Column:
    """STRING, BOOLEAN, BIGINT, DECIMAL(..), DOUBLE, OBJECT<..>, ARRAY<..> or VOID; null for a null variant."""
    return F.schema_of_variant(v)


def text_to_bigint(s: Column) -> Column:
    """A text as an integer; fractions round half away from zero, exponents are read, blanks around don't matter."""
    return F.coalesce(s.try_cast("bigint"), F.round(s.try_cast("decimal(38,6)")).try_cast("bigint"))


def to_bigint(v: Column) -> Column:
    """Integers stay exact, other numbers round half to even, texts by :func:`text_to_bigint`, booleans are 0 or 1."""
    number = F.rint(F.try_variant_get(v, "$", "double"))
    k = kind(v)
    return (
        F.when(k == "BIGINT", F.try_variant_get(v, "$", "bigint"))
        .when(k == "STRING", text_to_bigint(F.try_variant_get(v, "$", "string")))
        .when(k == "BOOLEAN", F.try_variant_get(v, "$", "boolean").cast("int").cast("bigint"))
        .when(F.abs(number) < 2.0**63, number.try_cast("bigint"))
    )


def text_to_boolean(s: Column) -> Column:
    """true, t, yes, y, 1 and their opposites in any case; anything else is null."""
    return s.try_cast("boolean")


def to_boolean(v: Column) -> Column:
    """Numbers are true unless 0."""
    k = kind(v)
    return F.when(k == "BOOLEAN", F.try_variant_get(v, "$", "boolean")).when(k == "STRING", text_to_boolean(F.try_variant_get(v, "$", "string"))).otherwise(F.try_variant_get(v, "$", "double") != 0)


def to_double(v: Column) -> Column:
    k = kind(v)
    return F.when(k == "STRING", F.try_variant_get(v, "$", "string").try_cast("double")).when(k == "BOOLEAN", F.try_variant_get(v, "$", "boolean").cast("int").cast("double")).otherwise(F.try_variant_get(v, "$", "double"))


def to_text(v: Column) -> Column:
    """Texts without quotes, everything else as JSON text."""
    return F.try_variant_get(v, "$", "string")


def edited(v: Column, mode: str = "record") -> Column:
    """The edit mark: a flag becomes 0 or 1 and an epoch stays. ``mode`` "sql": every non-zero number is a flag as well."""
    k, s = kind(v), F.try_variant_get(v, "$", "string")
    if mode == "sql":
        flag = to_boolean(v)
        return F.when(flag, 1).when(~flag, 0).otherwise(text_to_bigint(s)).cast("bigint")
    return F.when(k == "BOOLEAN", F.try_variant_get(v, "$", "boolean").cast("int").cast("bigint")).when(k == "STRING", text_to_bigint(s)).otherwise(to_bigint(v))


def edited_text(s: Column, mode: str = "record") -> Column:
    """The same for a column of text: true and false in words are flags; in mode "sql" so are 0 and 1."""
    low = F.lower(F.trim(s))
    flag = F.when(low.isin("true", "false") | F.lit(mode == "sql"), text_to_boolean(low))
    return F.when(flag, 1).when(~flag, 0).otherwise(text_to_bigint(s)).cast("bigint")


def coerce(v: Column, to: T.DataType) -> Column:
    """A variant as the given type, recursively: structs keep known fields, a single value becomes a list of one.

    A struct of something that is no object is null; so is a list of an object, and null stays null.
    """
    if isinstance(to, T.StructType):
        fields = [coerce(F.try_variant_get(v, f"$['{f.name}']", "variant"), f.dataType).alias(f.name) for f in to]
        return F.when(kind(v).startswith("OBJECT"), F.struct(*fields))
    if isinstance(to, T.ArrayType):
        many = F.transform(F.try_variant_get(v, "$", "array<variant>"), lambda x: coerce(x, to.elementType))
        k = kind(v)
        return F.when(k.startswith("ARRAY"), many).when(~k.startswith("OBJECT") & (k != "VOID"), F.array(coerce(v, to.elementType)))
    if isinstance(to, T.LongType):
        return to_bigint(v)
    if isinstance(to, T.BooleanType):
        return to_boolean(v)
    if isinstance(to, T.DoubleType):
        return to_double(v)
    return to_text(v)
