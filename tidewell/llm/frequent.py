"""Most frequent values by exact prefix refinement.

Values are hashed to 64 bits. Rows are counted by the first bits of the hash; a prefix's count bounds the count of every
value in it, so prefixes that can't hold a value frequent enough are dropped, and the rest are counted again with longer
prefixes, until full values remain. Each pass keeps no more than the prefixes that can still win, whatever the number of
distinct values, and the counts that come out are exact.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidewell.session import cut

#: Prefix lengths in bits; the last pass counts full values.
BITS = (12, 24)
#: Prefixes sent to every executor at a time, as one 64-bit hash each (some 32 MB in a hash table). More make more passes.
BROADCAST_ROWS = 1_000_000


def _prefix(bits: int):
    return F.shiftrightunsigned("_h", 64 - bits)


def _among(rows: DataFrame, kept: DataFrame, groups: list[str], bits: int, finer: list) -> DataFrame:
    """Counts of ``finer`` within the kept prefixes: rows of others are dropped before anything is grouped.

    Prefixes are told apart by a hash of group and prefix: a collision lets a few rows more be counted and changes no
    count. Beyond BROADCAST_ROWS the prefixes are dealt to slices, with a pass over the rows for each.
    """
    key = lambda prefix: F.xxhash64(*groups, prefix)
    slices = -(-kept.count() // max(1, BROADCAST_ROWS)) or 1
    out = None
    for i in range(slices):
        keys, own = kept.select(key("_p").alias("_k")), rows.withColumn("_k", key(_prefix(bits)))
        if slices > 1:
            keys, own = (x.filter(F.pmod(F.xxhash64("_k"), F.lit(slices)) == i) for x in (keys, own))
        one = own.join(F.broadcast(keys), "_k", "left_semi").groupBy(*groups, *finer).agg(F.count("*").alias("n"))
        out = one if out is None else out.unionByName(one)
    return out


def _hashed(df: DataFrame, groups: list[str], value: str) -> DataFrame:
    return df.filter(F.col(value).isNotNull()).select(*groups, F.col(value).alias("_v"), F.xxhash64(value).alias("_h")).dropna(subset=groups)


def _refine(rows: DataFrame, groups: list[str], first: DataFrame, bound: DataFrame, value: str, bits: tuple[int, ...]) -> DataFrame:
    """(groups, value, n) of all values that reach the group's bound; ``first`` has the counts of the shortest prefixes, with _least."""
    kept = cut(first.filter(F.col("n") >= F.col("_least")).select(*groups, "_p", "_least"))
    for short, long in zip(bits, bits[1:], strict=False):
        counted = _among(rows, kept, groups, short, [_prefix(long).alias("_q")])
        kept = cut(counted.join(bound, groups).filter(F.col("n") >= F.col("_least")).select(*groups, F.col("_q").alias("_p"), "_least"))
    full = _among(rows, kept, groups, bits[-1], ["_v"]).join(bound, groups)
    return full.filter(F.col("n") >= F.col("_least")).select(*groups, F.col("_v").alias(value), "n")


def frequent_share(df: DataFrame, groups: list[str], value: str, share: float, *, bits: tuple[int, ...] = BITS) -> DataFrame:
    """groups, value, n, total: values with at least ``share`` of their group's rows in which the value isn't null.

    A group keeps at most 1 / share prefixes in each pass, which is all the memory it takes, however many groups there are. Counts are exact. Nulls are
    no values and rows with a null group are left out; ties all come out; an empty table gives an empty result.
    """
    if not groups:  # all rows are one group
        return frequent_share(df.withColumn("_all", F.lit(0)), ["_all"], value, share, bits=bits).drop("_all")
    rows = _hashed(df, groups, value)
    first = cut(rows.groupBy(*groups, _prefix(bits[0]).alias("_p")).agg(F.count("*").alias("n")))
    total = first.groupBy(*groups).agg(F.sum("n").alias("total"))
    bound = cut(total.withColumn("_least", F.ceil(F.col("total") * F.lit(share) - 1e-9)))
    found = _refine(rows, groups, first.join(bound, groups), bound.select(*groups, "_least"), value, bits)
    return found.join(bound.drop("_least"), groups)


def top_values(df: DataFrame, groups: list[str], value: str, k: int, *, bits: tuple[int, ...] = BITS) -> DataFrame:
    """groups, value, n, place: the k most frequent values of each group, with exact counts; of equals the least come first.

    The values in a group's k fullest prefixes are counted first. The k-th of these counts is a lower bound for the true
    k-th, and prefixes below it are dropped; where they hold fewer than k values, nothing is. Groups with fewer than k
    values give all. Nulls are no values; an empty table gives an empty result.
    """
    if not groups:
        return top_values(df.withColumn("_all", F.lit(0)), ["_all"], value, k, bits=bits).drop("_all")
    rows = _hashed(df, groups, value)
    first = cut(rows.groupBy(*groups, _prefix(bits[0]).alias("_p")).agg(F.count("*").alias("n")))
    fullest = Window.partitionBy(*groups).orderBy(F.desc("n"), "_p")
    seeds = cut(first.withColumn("_r", F.row_number().over(fullest)).filter(F.col("_r") <= k).select(*groups, "_p"))
    seen = _among(rows, seeds, groups, bits[0], ["_v"])
    kth = seen.withColumn("_r", F.row_number().over(Window.partitionBy(*groups).orderBy(F.desc("n"), "_v"))).filter(F.col("_r") <= k).groupBy(*groups).agg(F.count("*").alias("_k"), F.min("n").alias("_n"))
    bound = cut(kth.select(*groups, F.when(F.col("_k") == k, F.col("_n")).otherwise(1).alias("_least")))
    found = _refine(rows, groups, first.join(bound, groups), bound, value, bits)
    order = Window.partitionBy(*groups).orderBy(F.desc("n"), value)
    return found.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= k)
