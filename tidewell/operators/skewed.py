"""Exact results per key where a few keys hold most rows: value-frequency compression.

Rows are grouped by key and value before they are grouped by key. Partial aggregation compresses a hot key before the
first shuffle, the shuffle spreads its values over all tasks, and what is left for the key itself are weighted values.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidewell.session import cut

#: Rows of a table that is sent to every executor; larger ones are joined by a shuffle.
BROADCAST_ROWS = 20_000


#: Rows of the left side of a join from which one key with more than a hundredth of them is joined apart, and the salts
#: over which such keys are spread where the right side has too many rows for a broadcast.
HOT_LEAST, SALTS = 100_000, 32


def join_hot(left: DataFrame, right: DataFrame, on: list[str], how: str = "inner", *, hot_least: int | None = None, seen: DataFrame | None = None) -> DataFrame:
    """left.join(right, on, how) for how inner or left, where a few keys (null is one) may hold most rows of the left side.

    Keys with more than a hundredth of the left rows, 100 at most, are found by one sketch over the keys. Their right rows
    are broadcast if they are few, else repeated for each of a number of salts that spread the left rows. All others join by
    a shuffle. ``left`` is read twice: it should be a stored table, or ``seen`` one whose rows show which keys are hot.
    Keys must not hold floating-point numbers.
    """
    least = HOT_LEAST if hot_least is None else hot_least
    key = F.xxhash64(*on)
    top = (left if seen is None else seen).select(key.alias("_k")).agg(F.expr("approx_top_k(_k, 100, 10000)").alias("items"), F.count("*").alias("n")).first()
    hot = [x["item"] for x in top["items"] if x["count"] * 100 > top["n"]] if top["n"] >= least else []
    if not hot:
        return left.join(right, on, how)
    is_hot = key.isin(hot)
    few = cut(right.filter(is_hot))
    rest = left.filter(~is_hot).join(right.filter(~is_hot), on, how)
    if few.count() <= BROADCAST_ROWS:
        return rest.unionByName(left.filter(is_hot).join(F.broadcast(few), on, how))
    salted = few.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    spread = left.filter(is_hot).withColumn("_salt", F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in left.columns]), F.lit(SALTS)).cast("int"))
    return rest.unionByName(spread.join(salted, [*on, "_salt"], how).drop("_salt"))


def key_values(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    """keys, value and n: how often each value occurs with each key. Nulls are values and keys like others."""
    return df.groupBy(*keys, value).agg(F.count("*").alias("n"))


def key_profile(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    """keys, n_rows, n_values, top_value, top_n: rows, distinct non-null values and the most frequent value of each key.

    Of values equally frequent the least is the mode. Keys whose values are all null have n_values 0 and a null mode. An
    empty table gives an empty result.
    """
    rank = F.struct((-F.col("n")).alias("n"), F.col(value).alias("v"))
    best = F.min(F.when(F.col(value).isNotNull(), rank))
    out = key_values(df, keys, value).groupBy(*keys).agg(F.sum("n").alias("n_rows"), F.count(value).alias("n_values"), best.alias("best"))
    return out.select(*keys, "n_rows", "n_values", F.col("best.v").alias("top_value"), (-F.col("best.n")).alias("top_n"))


def percentiles(df: DataFrame, keys: list[str], value: str, percents: list[int]) -> DataFrame:
    """keys, n and p<percent>: of a key's n non-null values in order that at place n * percent / 100, rounded up, 1 at least.

    A key's window holds its distinct values with their weights, however many rows they stand for, and spills. Keys whose
    values are all null give no row; null is a key like others; an empty table gives an empty result.
    """
    weights = key_values(df.filter(F.col(value).isNotNull()), keys, value)
    own = Window.partitionBy(*keys)
    summed = weights.withColumn("_sum", F.sum("n").over(own.orderBy(value).rowsBetween(Window.unboundedPreceding, 0))).withColumn("_all", F.sum("n").over(own))
    at = lambda p: F.greatest(F.lit(1), F.floor((F.col("_all") * p + 99) / 100))
    return summed.groupBy(*keys).agg(F.max("_all").alias("n"), *[F.min(F.when(F.col("_sum") >= at(p), F.col(value))).alias(f"p{p}") for p in percents])


def middle_ids(df: DataFrame, keys: list[str], slot: str, value: str, id_col: str, *, least: int = 20, window_ids: int = 100_000) -> DataFrame:
    """keys, slot, n, middle: the id at place (n + 1) / 2, rounded down, among a slot's n distinct ids by value, then id.

    ``value`` decides ``slot`` (a day of seconds, say), so a key and slot have no more weighted values than the slot has
    room for, however many rows they hold: the window that sums the weights is bounded. Slots with fewer than ``least``
    ids give no row. Ids that share a value are ranked in one window up to ``window_ids``, and across range partitions
    beyond. An id counts once per key, at its least value. Rows with a null key, value or id don't count. An
    empty table gives an empty result; other columns are ignored.
    """
    own = [*keys, slot]
    rows = df.select(*keys, F.col(slot).alias("_slot"), F.col(value).alias("_value"), F.col(id_col).alias("_id")).dropna()
    rows = rows.groupBy(*keys, "_id").agg(F.min(F.struct("_value", "_slot")).alias("_at")).select(*keys, "_id", F.col("_at._value").alias("_value"), F.col("_at._slot").alias("_slot"))
    weights = rows.groupBy(*keys, "_slot", "_value").agg(F.count("*").alias("_w"), F.min("_id").alias("_first"), F.max("_id").alias("_last"))
    whole = Window.partitionBy(*keys, "_slot")
    upto = whole.orderBy("_value").rowsBetween(Window.unboundedPreceding, 0)
    place = F.floor((F.col("n") + 1) / 2).cast("bigint")
    picked = weights.withColumn("n", F.sum("_w").over(whole)).filter(F.col("n") >= least).withColumn("_sum", F.sum("_w").over(upto)).withColumn("_rank", place - (F.col("_sum") - F.col("_w"))).filter("_rank BETWEEN 1 AND _w")
    picked = cut(picked.withColumn("middle", F.when(F.col("_rank") == 1, F.col("_first")).when(F.col("_rank") == F.col("_w"), F.col("_last"))))
    done = picked.filter("middle IS NOT NULL").select(*keys, F.col("_slot").alias(slot), "n", "middle")
    todo = picked.filter("middle IS NULL").select(*keys, "_value", "_slot", "n", "_rank", "_w")
    n_todo = todo.count()
    if not n_todo:
        return done
    # Ids that share a value with others and are neither its first nor its last: only these values' ids are ranked.
    among = rows.drop("_slot").join(F.broadcast(todo) if n_todo <= BROADCAST_ROWS else todo, [*keys, "_value"])
    own_value = [*keys, "_value"]
    if todo.agg(F.max("_w")).first()[0] <= window_ids:
        ranked = among.withColumn("_r", F.row_number().over(Window.partitionBy(*own_value).orderBy("_id"))).filter("_r = _rank")
    else:
        # A value with more ids than a window should hold: range partitions split it, and ranks within a partition are
        # moved on by the ids of the partitions before, of which there is one row for each partition and value.
        order = [*own_value, "_id"]
        parted = cut(among.repartitionByRange(*order).withColumn("_part", F.spark_partition_id()))
        sizes = parted.groupBy(*own_value, "_part").agg(F.count("*").alias("_n"))
        before = Window.partitionBy(*own_value).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
        sizes = sizes.withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0))).filter("_n > 0")
        placed = parted.withColumn("_r", F.row_number().over(Window.partitionBy("_part", *own_value).orderBy("_id")))
        ranked = placed.join(sizes.drop("_n"), [*own_value, "_part"]).filter("_r + _before = _rank").drop("_part", "_before")
    return done.unionByName(ranked.select(*keys, F.col("_slot").alias(slot), "n", F.col("_id").alias("middle"))).select(*own, "n", "middle")
