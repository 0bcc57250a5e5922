"""Sessions of activity by occupancy bitmaps.

The time line of an entity is cut into blocks, so the events of a hot entity spread over many tasks. Events of one second
count once in the bitmap and keep their number as a weight. Within a block a bitmap has one bit for each second between
the block's first and last event; dilation by the gap, in doubling shifts, joins events that are near enough. Runs of set
bits are sessions: trimming their ends by the gap less one completes the closing, and prefix sums of the weights
give their counts. Runs within reach of a block's border, at most two a block, are stitched in a window over the entity.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Bits that one pass of the closing holds; bounds memory, not results.
PASS_BITS = 8_000_000


def shift_up(x: np.ndarray, s: int) -> np.ndarray:
    """Moves every bit of the little-endian bitmap up by s places."""
    q, r = divmod(s, 64)
    y = np.zeros_like(x)
    if q < len(x):
        y[q:] = x[: len(x) - q] << np.uint64(r)
        if r and q + 1 < len(x):
            y[q + 1 :] |= x[: len(x) - q - 1] >> np.uint64(64 - r)
    return y


def dilate(x: np.ndarray, length: int) -> np.ndarray:
    """ORs the bitmap with its shifts by 0 .. length - 1."""
    have = 1
    while have < length:
        step = min(have, length - have)
        x = x | shift_up(x, step)
        have += step
    return x


def bit_places(x: np.ndarray) -> np.ndarray:
    """The places of the set bits, unpacking only words that have some."""
    words = np.flatnonzero(x)
    bits = np.unpackbits(x[words].view(np.uint8), bitorder="little").reshape(-1, 64)
    w, b = np.nonzero(bits)
    return words[w] * 64 + b


def runs(place: np.ndarray, total: int, gap: int) -> tuple[np.ndarray, np.ndarray]:
    """First and last event place of each run of events at most ``gap`` apart; places ascend within ``total`` bits."""
    word = place >> 6
    first = np.flatnonzero(np.r_[True, word[1:] != word[:-1]])
    x = np.zeros((total >> 6) + 1, dtype=np.uint64)
    x[word[first]] = np.bitwise_or.reduceat(np.uint64(1) << (place & 63).astype(np.uint64), first)
    x = dilate(x, gap)
    down = x >> np.uint64(1)
    down[:-1] |= x[1:] << np.uint64(63)
    return bit_places(x & ~shift_up(x, 1)), bit_places(x & ~down) - (gap - 1)


def _close(entity: pa.Array, t: np.ndarray, n: np.ndarray, gap: int, block: int) -> Iterator[pa.RecordBatch]:
    """Runs of whole (entity, block) groups; rows are sorted by entity and time."""
    code = entity.dictionary_encode().indices.to_numpy()
    slot = t // block
    head = np.flatnonzero(np.r_[True, (code[1:] != code[:-1]) | (slot[1:] != slot[:-1])])
    tail = np.r_[head[1:], len(t)]
    width = t[tail - 1] - t[head] + 1 + gap
    at = np.r_[0, np.cumsum(width)]
    g = 0
    while g < len(head):
        h = max(g + 1, int(np.searchsorted(at, at[g] + PASS_BITS, side="right")) - 1)
        lo, hi = head[g], tail[h - 1]
        size = tail[g:h] - head[g:h]
        place = t[lo:hi] - np.repeat(t[head[g:h]], size) + np.repeat(at[g:h] - at[g], size)
        start, end = runs(place, int(at[h] - at[g]), gap)
        a, b = np.searchsorted(place, start), np.searchsorted(place, end, side="right")
        total = np.r_[0, np.cumsum(n[lo:hi])]
        begin, stop = t[lo + a], t[lo + b - 1]
        edge = (begin % block < gap) | (block - stop % block <= gap)
        yield pa.RecordBatch.from_pydict({"entity": entity.take(pa.array(lo + a)), "session_start": begin, "session_end": stop, "n_events": total[b] - total[a], "edge": edge})
        g = h


def _closer(gap: int, block: int):
    def close(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest: pa.RecordBatch | None = None
        for batch in batches:
            if not batch.num_rows:
                continue
            both = pa.Table.from_batches([rest, batch] if rest is not None else [batch]).combine_chunks().to_batches()[0]
            t = both["t"].to_numpy()
            same = (t // block == t[-1] // block) & np.asarray(pa.compute.equal(both["entity"], both["entity"][-1]))
            cutoff = int(np.flatnonzero(~same)[-1]) + 1 if not same.all() else 0
            rest = both.slice(cutoff)
            if cutoff:
                done = both.slice(0, cutoff)
                yield from _close(done["entity"], done["t"].to_numpy(), done["n"].to_numpy(), gap, block)
        if rest is not None:
            yield from _close(rest["entity"], rest["t"].to_numpy(), rest["n"].to_numpy(), gap, block)

    return close


def sessions(df: DataFrame, entity: Column, second: Column, event_id: Column, *, gap: int = 1800, block: int = 14_400) -> DataFrame:
    """One row per session: entity, session_start, session_end, duration (seconds) and n_events.

    A session ends where the entity's next event is more than ``gap`` seconds later; events exactly ``gap`` apart stay
    together. Events are distinct (entity, event_id), at the least second given. Rows with a null entity, second or id
    belong to no session; times may be negative. An empty table gives an empty result; other columns are ignored.
    ``block`` (at least ``gap``) bounds the seconds, hence the memory, of one bitmap.
    """
    if gap < 1 or block < gap:
        raise ValueError("gap must be positive and block at least gap")
    ev = df.select(entity.alias("entity"), second.cast("bigint").alias("t"), event_id.alias("event")).dropna()
    ev = ev.groupBy("entity", "event").agg(F.min("t").alias("t"))
    seconds = ev.groupBy("entity", "t").agg(F.count("*").alias("n"))
    slot = F.floor(F.col("t") / F.lit(block))
    sorted_ = seconds.withColumn("slot", slot).repartition("entity", "slot").sortWithinPartitions("entity", "t").select(F.col("entity").cast("string").alias("entity"), "t", "n")
    found = sorted_.mapInArrow(_closer(gap, block), "entity string, session_start bigint, session_end bigint, n_events bigint, edge boolean")
    # Only runs near a border can continue in the next block; each other run is a partition of its own.
    over = Window.partitionBy("entity", F.when(~F.col("edge"), F.col("session_start"))).orderBy("session_start")
    fresh = F.coalesce(F.col("session_start") - F.lag("session_end").over(over) > gap, F.lit(True))
    keyed = found.withColumn("fresh", fresh).withColumn("number", F.sum(F.col("fresh").cast("int")).over(over))
    part = F.when(~F.col("edge"), F.col("session_start"))
    out = keyed.withColumn("part", part).groupBy("entity", "part", "number").agg(F.min("session_start").alias("session_start"), F.max("session_end").alias("session_end"), F.sum("n_events").alias("n_events"))
    return out.select("entity", "session_start", "session_end", (F.col("session_end") - F.col("session_start")).alias("duration"), "n_events")
