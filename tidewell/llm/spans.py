"""Long exact spans shared between records: seed and extend.

1. Seeds. Winnowing keeps in every stretch of ``length`` characters at least one anchor, a gram with the least hash of its
   window, chosen by the characters there alone, so equal stretches have equal anchors at equal places.
2. Anchors are joined by their gram. Occurrences with the same surroundings, all that a stretch of ``length`` with the
   anchor can reach, are one class; copies, however many, are compressed to it before they are shuffled. A class with
   several records is shared as a whole.
3. Extension. What a class of one record shares with others of the same anchor is found both ways from the anchor:
   for every place where a stretch of ``length`` with the anchor can begin, whether that stretch stands in another record.
   It takes time in proportion to the occurrences, not to their pairs.
4. Coverage: adjacent and overlapping stretches join to what of a record is shared.
5. Maximal repeats: each stretch keeps the first and the last record that has it, and where. Stretches on one diagonal of
   two records join, and are extended both ways in the two texts themselves, character by character; those that lie
   within others are left out. A repeat that is still missing reaches over the gap between two neighbouring ones: what
   stands there, from before the second to after the first, is looked up by its anchor until nothing new is found.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidewell.operators.skewed import join_hot
from tidewell.session import cut

#: Characters hashed at a time; bounds memory, not results. A longer text is one pass of its own.
PASS_CHARS = 400_000
#: Rows of (anchor, place) that may be sent to every executor, some 150 bytes each; more are joined by a shuffle.
BROADCAST_ROWS = 100_000
#: Classes of one anchor that are compared within one task; those of a more frequent anchor are compared by a shuffle.
TASK_CLASSES = 20_000
#: Classes, of some 3 KB each while compared, that a task compares at a time.
PASS_CLASSES = 3_000
BASE = np.uint64(0x9E3779B97F4A7C15)
#: The first and the last occurrence of something: record and place of the anchor.
OCCURRENCES = ("low_doc", "low_place", "high_doc", "high_place")
OCCURRENCES_DDL = "low_doc bigint, low_place int, high_doc bigint, high_place int"
INVERSE = np.uint64(pow(int(BASE), -1, 2**64))


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(base: np.uint64, n: int) -> np.ndarray:
    p = np.full(n, base, dtype=np.uint64)
    if n:
        p[0] = 1
    return np.multiply.accumulate(p)


class _Powers:
    """Powers of the base and its inverse, grown on demand."""

    def __init__(self):
        self.up = self.down = np.zeros(0, np.uint64)

    def get(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            n = max(n, PASS_CHARS * 2)
            self.up, self.down = _powers(BASE, n), _powers(INVERSE, n)
        return self.up, self.down


_powers_of = _Powers()


def _slide(x: np.ndarray, w: int, f) -> np.ndarray:
    """f over each window of w, by doubling."""
    have = 1
    while have < w:
        step = min(have, w - have)
        x = f(x[: len(x) - step], x[step:])
        have += step
    return x


def anchors(texts: list[str], length: int, gram: int) -> tuple[np.ndarray, ...]:
    """(text number, place, characters, anchor hash, surroundings hash) of every anchor of the texts, together."""
    reach = length - gram
    n = np.array([len(t) for t in texts], dtype=np.int64)
    start = np.r_[0, np.cumsum(n)]
    total = int(start[-1])
    none = np.zeros(0, np.int64)
    if total < length:
        return none, none, none, none, none
    code = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    up, down = _powers_of.get(total + 1)
    sums = np.zeros(total + 1, dtype=np.uint64)
    np.cumsum(_mix(code.astype(np.uint64) + np.uint64(1)) * up[:total], out=sums[1:])
    h = _mix((sums[gram:] - sums[:-gram]) * down[: total - gram + 1])
    least = _slide(h, reach + 1, np.minimum)  # least[i]: over the grams of the stretch of ``length`` from i
    owner = np.repeat(np.arange(len(texts)), n)
    inside = owner[: len(least)] == owner[length - 1 : length - 1 + len(least)]
    least[~inside] = 0
    padded = np.r_[np.zeros(reach, np.uint64), least, np.zeros(reach, np.uint64)]
    most = _slide(padded, reach + 1, np.maximum)  # over the stretches that hold gram j
    # A gram is an anchor if it is the least of some stretch that holds it; all equal ones are.
    at = np.flatnonzero(most[: len(h)] == h)
    at = at[(owner[at] == owner[at + gram - 1]) & (n[owner[at]] >= length)]
    doc = owner[at]
    place = at - start[doc]
    left = np.minimum(place, reach)
    lo, hi = at - left, np.minimum(at + length, start[doc] + n[doc])
    around = _mix((sums[hi] - sums[lo]) * down[lo] + left.astype(np.uint64) * np.uint64(0x632BE59BD9B4E019) + (hi - lo).astype(np.uint64))
    return doc, place, n[doc], h[at].view(np.int64), around.view(np.int64)


def _seeder(length: int, gram: int):
    def emit(ids: list, texts: list[str]) -> Iterator[pa.RecordBatch]:
        doc, place, n, h, around = anchors(texts, length, gram)
        if len(doc):
            yield pa.RecordBatch.from_pydict({"h": h, "around": around, "doc": pa.array(np.array(ids, dtype=np.int64)[doc]), "place": pa.array(place.astype(np.int32)), "n": pa.array(n.astype(np.int32))})

    def seed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, texts, size = [], [], 0
            for i, t in zip(batch["doc"].to_pylist(), batch["text"].to_pylist(), strict=True):
                if len(t) < length:
                    continue
                if texts and size + len(t) > PASS_CHARS:
                    yield from emit(ids, texts)
                    ids, texts, size = [], [], 0
                ids.append(i)
                texts.append(t)
                size += len(t)
            if texts:
                yield from emit(ids, texts)

    return seed


def _cutter(length: int, gram: int):
    reach = length - gram

    def surroundings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cols: dict[str, list] = {k: [] for k in ("h", "around", *OCCURRENCES, "left", "part")}
            for text, own in zip(batch["text"].to_pylist(), batch["own"].to_pylist(), strict=True):
                for o in own:
                    place = o["low_place"]
                    left = min(place, reach)
                    for k in ("h", "around", *OCCURRENCES):
                        cols[k].append(o[k])
                    cols["left"].append(left)
                    cols["part"].append(text[place - left : place + length])
            kinds = {"left": pa.int32(), "low_place": pa.int32(), "high_place": pa.int32(), "part": pa.string()}
            out = pa.table({k: pa.array(v, kinds.get(k, pa.int64())) for k, v in cols.items()})
            yield from out.to_batches(max_chunksize=10_000)

    return surroundings


def stretch_hashes(parts: list[str], left: np.ndarray, length: int, reach: int) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, there): of each class the stretches beginning reach - o before the anchor, o = 0 .. reach, and which exist."""
    width = reach + length
    n = np.array([len(p) for p in parts], dtype=np.int64)
    code = np.frombuffer("".join(parts).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    row = np.repeat(np.arange(len(parts)), n)
    col = np.arange(len(code)) - np.repeat(np.cumsum(n) - n, n) + np.repeat(reach - left, n)
    grid = np.zeros((len(parts), width), dtype=np.uint64)
    up, down = _powers_of.get(width + 1)
    grid[row, col] = _mix(code.astype(np.uint64) + np.uint64(1)) * up[col]
    sums = np.zeros((len(parts), width + 1), dtype=np.uint64)
    np.cumsum(grid, axis=1, out=sums[:, 1:])
    o = np.arange(reach + 1)
    h = (sums[:, length : length + reach + 1] - sums[:, : reach + 1]) * down[: reach + 1]
    first = (reach - left)[:, None]
    return h, (o[None, :] >= first) & (o[None, :] + length <= first + n[:, None])


def _ranges(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, first, last) of the runs of equal cells of a table, those of 0 left out."""
    there = codes != 0
    change = codes[:, 1:] != codes[:, :-1]
    begins, ends = there.copy(), there.copy()
    begins[:, 1:] &= change
    ends[:, :-1] &= change
    r, a = np.nonzero(begins)
    _, b = np.nonzero(ends)
    return r, a, b


def _shared(t: pa.Table, length: int, reach: int, partners: bool) -> pa.RecordBatch:
    """Of whole anchors: the ranges of places where stretches begin that stand in more than one record.

    With ``partners`` a range has the same first and last record with the stretch, and the place of the anchor there, all
    along; else these columns are of the class itself.
    """
    left = t["left"].to_numpy().astype(np.int64)
    h, there = stretch_hashes(t["part"].to_pylist(), left, length, reach)
    seed = t["h"].to_numpy().view(np.uint64)
    key = _mix(h ^ _mix(seed)[:, None]) ^ _mix(np.arange(reach + 1, dtype=np.uint64))[None, :]
    row, o = np.nonzero(there)
    key = key[row, o]
    low, high = t["low_doc"].to_numpy(), t["high_doc"].to_numpy()
    order = np.lexsort((low[row], key)) if partners else np.argsort(key, kind="stable")
    k = key[order]
    first = np.flatnonzero(np.r_[True, k[1:] != k[:-1]]) if len(k) else np.zeros(0, np.int64)
    codes = np.zeros(there.shape, dtype=np.int64)
    if len(k):
        many = np.diff(np.r_[first, len(k)])
        least, most = np.minimum.reduceat(low[row[order]], first), np.maximum.reduceat(high[row[order]], first)
        several = np.repeat(least != most, many)
        if partners:
            from_high = np.lexsort((high[row], key))
            pair = row[order][first] * len(low) + row[from_high][np.r_[first[1:], len(k)] - 1] + 1
            codes[row[order][several], o[order][several]] = np.repeat(pair, many)[several]
        else:
            codes[row[order][several], o[order][several]] = 1
    r, a, b = _ranges(codes)
    lows, highs = ((codes[r, a] - 1) // max(1, len(low)), (codes[r, a] - 1) % max(1, len(low))) if partners else (r, r)
    out = {"h": t["h"].to_numpy()[r], "around": t["around"].to_numpy()[r], "a": pa.array((a - reach).astype(np.int32)), "b": pa.array((b - reach).astype(np.int32))}
    return pa.RecordBatch.from_pydict(out | {c: t[c].to_numpy()[x] for c, x in zip(OCCURRENCES, (lows, lows, highs, highs), strict=True)})


def _extender(length: int, gram: int, partners: bool):
    reach = length - gram

    def extend(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest: list[pa.RecordBatch] = []
        held = 0
        for batch in batches:
            if not batch.num_rows:
                continue
            rest.append(batch)
            held += batch.num_rows
            if held < PASS_CLASSES:
                continue
            t = pa.Table.from_batches(rest).combine_chunks()
            h = t["h"].to_numpy()
            change = np.flatnonzero(h[1:] != h[:-1]) + 1
            done = 0
            while len(change) and len(h) - done >= PASS_CLASSES:
                upto = change[change <= done + PASS_CLASSES]
                upto = int(upto[-1]) if len(upto) and upto[-1] > done else int(change[np.searchsorted(change, done, side="right")]) if change[-1] > done else done
                if upto <= done:
                    break
                yield _shared(t.slice(done, upto - done).combine_chunks(), length, reach, partners)
                done = upto
            rest = t.slice(done).combine_chunks().to_batches()
            held = len(h) - done
        if held:
            yield _shared(pa.Table.from_batches(rest).combine_chunks(), length, reach, partners)

    return extend


def _exploder(length: int, gram: int):
    reach = length - gram

    def explode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                t = pa.Table.from_batches([batch.slice(at, 500)])
                h, there = stretch_hashes(t["part"].to_pylist(), t["left"].to_numpy().astype(np.int64), length, reach)
                row, o = np.nonzero(there)
                yield pa.RecordBatch.from_pydict({"h": t["h"].to_numpy()[row], "around": t["around"].to_numpy()[row], **{c: t[c].to_numpy()[row] for c in OCCURRENCES}, "o": pa.array((o - reach).astype(np.int32)), "g": _mix(h[row, o]).view(np.int64)})

    return explode


def _hits(docs: DataFrame, length: int, gram: int, task_classes: int, partners: bool) -> tuple[DataFrame, DataFrame]:
    """(hits, seeds); hits has doc, n, place, a, b and OCCURRENCES: stretches of ``length`` begin at place + a .. place + b that others have too.

    OCCURRENCES are the first and the last record with each of these stretches, one of which may be the record itself, and
    the place there of the anchor that the record has at ``place``; only with ``partners`` are they of any use.
    """
    reach = length - gram
    seeds = cut(docs.mapInArrow(_seeder(length, gram), "h bigint, around bigint, doc bigint, place int, n int"))
    at = F.struct("doc", "place")
    classes = seeds.groupBy("h", "around").agg(F.min(at).alias("low"), F.max(at).alias("high")).select("h", "around", F.col("low.doc").alias("low_doc"), F.col("low.place").alias("low_place"), F.col("high.doc").alias("high_doc"), F.col("high.place").alias("high_place"))
    # Anchors in more than one record; of those all of whose classes are shared as a whole there is nothing to extend.
    stats = classes.groupBy("h").agg(F.count("*").alias("n_classes"), F.min("low_doc").alias("l"), F.max("high_doc").alias("u"), F.max(F.col("low_doc") == F.col("high_doc")).alias("single")).filter("l != u").select("h", "n_classes", "single")
    known = cut(join_hot(classes, stats, ["h"], seen=seeds))
    ranges = known.filter("low_doc != high_doc").select("h", "around", F.lit(-reach).alias("a"), F.lit(0).alias("b"), *OCCURRENCES)
    open_ = known.filter("single")
    needed = open_.select(F.col("low_doc").alias("doc"), F.struct("h", "around", *OCCURRENCES).alias("o")).groupBy("doc").agg(F.collect_list("o").alias("own"))
    n_open = open_.count()
    if n_open <= BROADCAST_ROWS:
        needed = F.broadcast(needed)
    parts = docs.join(needed, "doc").select("text", "own").mapInArrow(_cutter(length, gram), f"h bigint, around bigint, {OCCURRENCES_DDL}, left int, part string")
    hot = known.filter(F.col("n_classes") > task_classes).select("h").distinct()
    found = []
    n_hot = known.filter(F.col("n_classes") > task_classes).count()
    if n_hot:  # hot anchors number at most n_classes / task_classes
        parts = cut(parts)
        found.append(_by_shuffle(join_hot(parts, hot, ["h"]), length, gram))
        parts = parts.join(hot, "h", "left_anti")
    found.append(parts.repartition("h").sortWithinPartitions("h").mapInArrow(_extender(length, gram, partners), f"h bigint, around bigint, a int, b int, {OCCURRENCES_DDL}"))
    single = known.filter("single AND low_doc = high_doc").select("h", "around")
    for f in found:
        ranges = ranges.unionByName(f.join(single, ["h", "around"], "left_semi"))
    if not partners:
        ranges = ranges.drop(*OCCURRENCES)
    return join_hot(seeds, ranges, ["h", "around"]), seeds


def _documents(df: DataFrame, id_col: str, text_col: str, length: int, gram: int) -> DataFrame:
    if gram < 1 or length - gram < 1:
        raise ValueError("gram must be shorter than length")
    return df.select(F.col(id_col).cast("bigint").alias("doc"), F.col(text_col).alias("text")).filter("doc IS NOT NULL AND text IS NOT NULL")


def _joined(pieces: DataFrame, by: list[str]) -> DataFrame:
    """Of rows (by..., start, end) those that overlap or touch, joined to one."""
    over = Window.partitionBy(*by).orderBy("start", "end")
    reached = F.max("end").over(over.rowsBetween(Window.unboundedPreceding, -1))
    marked = pieces.withColumn("fresh", F.coalesce((F.col("start") > reached).cast("int"), F.lit(1)))
    numbered = marked.withColumn("span", F.sum("fresh").over(over.rowsBetween(Window.unboundedPreceding, 0)))
    return numbered.groupBy(*by, "span").agg(F.min("start").alias("start"), F.max("end").alias("end"), *([F.max("n").alias("n")] if "n" in pieces.columns else [])).drop("span")


def _placed(length: int) -> list:
    return [F.greatest(F.col("place") + F.col("a"), F.lit(0)).alias("start"), (F.least(F.col("place") + F.col("b"), F.col("n") - length) + length).alias("end")]


def shared_spans(df: DataFrame, id_col: str, text_col: str, *, length: int = 200, gram: int = 50, task_classes: int = TASK_CLASSES) -> DataFrame:
    """doc_id, n_chars, shared_chars, spans: what of each record stands in others too, as stretches [start, end).

    A span is the union of overlapping stretches of ``length`` consecutive characters (code points) that stand verbatim in
    another record, not all in the same (see :func:`maximal_repeats` for that); shared_chars counts the characters in them,
    each once. Ids are unique. A record that repeats itself only shares nothing. Null and shorter texts share nothing and
    have no row; an empty table gives an empty result; other columns are ignored. ``gram`` is the length of an anchor. A
    text is hashed as a whole in one task. Comparisons are by 64-bit hashes of a stretch under a 64-bit hash of its anchor.
    """
    docs = _documents(df, id_col, text_col, length, gram)
    hits = _hits(docs, length, gram, task_classes, False)[0].select("doc", "n", *_placed(length))
    return _joined(hits, ["doc"]).groupBy(F.col("doc").alias("doc_id")).agg(F.max("n").alias("n_chars"), F.sum(F.col("end") - F.col("start")).cast("int").alias("shared_chars"), F.sort_array(F.collect_list(F.struct("start", "end"))).alias("spans"))


def grow(a: str, b: str, i: int, j: int) -> int:
    """How many characters of a from i on and of b from j on are the same."""
    n, most, step = 0, min(len(a) - i, len(b) - j), 64
    while n < most:
        step = min(step, most - n)
        if a[i + n : i + n + step] == b[j + n : j + n + step]:
            n += step
            step *= 2
        elif step == 1:
            break
        else:
            step //= 2
            most = min(most, n + 2 * step)
    return n


def _repeats(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each piece extended both ways in the two texts; one whose texts differ after all (equal hashes) is left out."""
    for batch in batches:
        out: dict[str, list] = {k: [] for k in ("doc", "other", "start", "end", "other_start")}
        seen: set = set()
        for text, other_text, doc, other, pieces in zip(*(batch[c].to_pylist() for c in ("text", "other_text", "doc", "other", "pieces")), strict=True):
            back, other_back = text[::-1], other_text[::-1]
            for p in pieces:
                start, end, shift = p["start"], p["end"], p["shift"]
                if text[start:end] != other_text[start + shift : end + shift]:
                    continue
                start -= grow(back, other_back, len(text) - start, len(other_text) - start - shift)
                end += grow(text, other_text, end, end + shift)
                if (doc, other, start, end, shift) not in seen:
                    seen.add((doc, other, start, end, shift))
                    for k, v in zip(out, (doc, other, start, end, start + shift), strict=True):
                        out[k].append(v)
        kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32())
        yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(out.values(), kinds, strict=True)], names=list(out))


def maximal_repeats(df: DataFrame, id_col: str, text_col: str, *, length: int = 200, gram: int = 50, task_classes: int = TASK_CLASSES) -> DataFrame:
    """doc_id, span_start, span_end, other_id, other_start: repeats of ``length`` characters at least, each whole in another record.

    Each span [span_start, span_end) of a record stands verbatim in record other_id from other_start on and can't be
    extended there on either side. No span lies within another of the same record, and together the spans of a record are
    just what :func:`shared_spans` counts: every stretch of a record that stands in another lies within one of its spans.
    Each stretch of ``length`` characters is followed into the first and the last record that has it, and each gap into
    the first and the last record that has it, so the pieces to extend grow with the stretches and not with the pairs of
    records. Of several records found for a span the least is given. Cases as with :func:`shared_spans`; characters are
    compared themselves here. The texts of a record and of the other are held by one task.
    """
    docs = _documents(df, id_col, text_col, length, gram)
    side = lambda s: F.struct(F.col(f"{s}_doc").alias("other"), (F.col(f"{s}_place") - F.col("place")).alias("shift"))
    hits, seeds = _hits(docs, length, gram, task_classes, True)
    hits = hits.select("doc", *_placed(length), F.explode(F.array(side("low"), side("high"))).alias("o"))
    pieces = _joined(hits.select("doc", "o.*", "start", "end").filter("other != doc").distinct(), ["doc", "other", "shift"])
    best = cut(_outermost(_extended(pieces, docs)))
    tested = None
    while True:
        over = Window.partitionBy("doc").orderBy("start")
        gaps = best.select("doc", (F.col("start") - 1).alias("x"), (F.lag("end").over(over) + 1).alias("y")).filter(F.col("y") - F.col("x") >= length)
        gaps = cut(gaps if tested is None else gaps.join(tested, ["doc", "x", "y"], "left_anti"))
        if gaps.isEmpty():
            break
        tested = gaps if tested is None else tested.unionByName(gaps)
        new = cut(_extended(_across(gaps, seeds, docs, length, gram), docs))
        if new.isEmpty():
            break
        best = cut(_outermost(best.select("doc", "start", "end", "o.*").unionByName(new)))
    return best.select(F.col("doc").alias("doc_id"), F.col("start").alias("span_start"), F.col("end").alias("span_end"), F.col("o.other").alias("other_id"), F.col("o.other_start").alias("other_start"))


def _extended(pieces: DataFrame, docs: DataFrame) -> DataFrame:
    """doc, other, start, end, other_start: pieces (doc, other, shift, start, end) as far as the two texts agree."""
    pairs = cut(pieces.groupBy("doc", "other").agg(F.collect_list(F.struct("start", "end", "shift")).alias("pieces")))
    texts = join_hot(pairs, docs.select(F.col("doc").alias("other"), F.col("text").alias("other_text")), ["other"]).join(docs, "doc")
    return texts.mapInArrow(_repeats, "doc bigint, other bigint, start int, end int, other_start int")


def _outermost(repeats: DataFrame) -> DataFrame:
    """doc, start, end and o (other, other_start) of the repeats that lie within no other of their record."""
    best = repeats.groupBy("doc", "start", "end").agg(F.min(F.struct("other", "other_start")).alias("o"))
    before = Window.partitionBy("doc").orderBy("start", F.desc("end")).rowsBetween(Window.unboundedPreceding, -1)
    return best.withColumn("inside", F.coalesce(F.max("end").over(before) >= F.col("end"), F.lit(False))).filter("NOT inside").drop("inside")


def _contents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out: dict[str, list] = {k: [] for k in ("doc", "h", "place", "left", "right", "g")}
        for doc, text, own in zip(batch["doc"].to_pylist(), batch["text"].to_pylist(), batch["own"].to_pylist(), strict=True):
            for o in own:
                part = text[o["place"] - o["left"] : o["place"] + o["right"]].encode("utf-8", "surrogatepass")
                for k, v in zip(out, (doc, o["h"], o["place"], o["left"], o["right"], xxhash.xxh128_digest(part)), strict=True):
                    out[k].append(v)
        kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.binary())
        yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(out.values(), kinds, strict=True)], names=list(out))


def _across(gaps: DataFrame, seeds: DataFrame, docs: DataFrame, length: int, gram: int) -> DataFrame:
    """Pieces (doc, other, shift, start, end) for the gaps (doc, x, y) that stand in other records.

    The least anchor of a gap's first stretch is one in every record that has the stretch. At each occurrence of such an
    anchor the content is taken in the shapes (left and right of the anchor) that its gaps have, and grouped.
    """
    unsigned = F.expr("h ^ CAST(-9223372036854775808 AS BIGINT)")
    inside = (F.col("place") >= F.col("x")) & (F.col("place") <= F.col("x") + length - gram)
    least = seeds.select("doc", "h", "place").join(gaps, "doc").filter(inside).groupBy("doc", "x", "y").agg(F.min(F.struct(unsigned.alias("u"), "h", "place")).alias("s"))
    wanted = cut(least.select("doc", "s.h", "s.place", (F.col("s.place") - F.col("x")).alias("left"), (F.col("y") - F.col("s.place")).alias("right")))
    shapes = wanted.select("h", "left", "right").distinct()
    occurrences = join_hot(seeds.select("doc", "h", "place", "n"), shapes, ["h"]).filter("place >= left AND place + right <= n")
    texts = occurrences.groupBy("doc").agg(F.collect_list(F.struct("h", "place", "left", "right")).alias("own")).join(docs, "doc")
    content = cut(texts.select("doc", "text", "own").mapInArrow(_contents, "doc bigint, h bigint, place int, left int, right int, g binary"))
    at = F.struct("doc", "place")
    several = content.groupBy("h", "left", "right", "g").agg(F.min(at).alias("low"), F.max(at).alias("high")).filter("low.doc != high.doc")
    mine = content.join(wanted, ["doc", "h", "place", "left", "right"]).join(several, ["h", "left", "right", "g"])
    return mine.select("doc", (F.col("place") - F.col("left")).alias("start"), (F.col("place") + F.col("right")).alias("end"), F.col("place"), F.explode(F.array("low", "high")).alias("o")).filter("o.doc != doc").select("doc", F.col("o.doc").alias("other"), (F.col("o.place") - F.col("place")).alias("shift"), "start", "end")


def _by_shuffle(parts: DataFrame, length: int, gram: int) -> DataFrame:
    """The extension of anchors with more classes than a task compares: one row per stretch, grouped by a shuffle."""
    each = cut(parts.mapInArrow(_exploder(length, gram), f"h bigint, around bigint, {OCCURRENCES_DDL}, o int, g bigint"))
    keys = ["h", "o", "g"]
    several = each.groupBy(*keys).agg(F.min(F.struct("low_doc", "low_place")).alias("l"), F.max(F.struct("high_doc", "high_place")).alias("u")).filter("l.low_doc != u.high_doc")
    return join_hot(each.drop(*OCCURRENCES), several, keys).select("h", "around", F.col("o").alias("a"), F.col("o").alias("b"), "l.*", "u.*")
