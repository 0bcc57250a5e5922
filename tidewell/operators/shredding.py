"""Columnar shredding of irregular JSON, and flat tables rebuilt from it.

A row group of records becomes one column chunk per leaf path, ``[]`` standing for an array's elements. A chunk has the ids
of the records that have the leaf; its entries carry a
repetition level (at which array of the path a new element begins; 0: the record begins), a definition level (how many
steps of the path are there), a run length, a kind and a value. Elements that lack the leaf are entries of kind
``absent``; a run of them is one entry, so a chunk is no longer than what is present. An object that is an array element
has an entry in the chunk of its own path, ending in ``[]``, beside the chunks of what it holds. Positions are not stored: they follow from the
level sequence of the chunk alone, and objects that are array elements form one flat table per path.
"""

from __future__ import annotations

import itertools
import json
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ELEMENT = "[]"
#: Records and entries of a row group: what a task holds before it gives out chunks.
GROUP_RECORDS, GROUP_ENTRIES = 2_000, 50_000
CHUNK = pa.struct([("path", pa.list_(pa.string())), ("rep", pa.list_(pa.int32())), ("def", pa.list_(pa.int32())), ("run", pa.list_(pa.int32())), ("kind", pa.list_(pa.string())), ("value", pa.list_(pa.string()))])
CHUNK_DDL = "path array<string>, rep array<int>, def array<int>, run array<int>, kind array<string>, value array<string>"
_TOKEN = re.compile(r'[ \t\r\n]*(?:([\[\]{},:])|("(?:[^"\\\x00-\x1f]|\\.)*")|(-?(?:0|[1-9][0-9]*)(?:\.[0-9]+)?(?:[eE][-+]?[0-9]+)?|true|false|null))')


class Number(str):
    """A JSON number as it was written."""


def _refuse(name: str):
    raise ValueError(name)


_load = json.JSONDecoder(parse_int=Number, parse_float=Number, parse_constant=_refuse).decode
_WORDS = {"true": True, "false": False, "null": None}


def _parse_deep(text: str):
    """The same for texts too deep for the recursive parser."""
    stack: list = []  # (container, key)
    at, end = 0, len(text)
    state, out, key = "value", None, None
    while True:
        m = _TOKEN.match(text, at)
        if m is None:
            if state == "over" and not text[at:].strip(" \t\r\n"):
                return out
            raise ValueError("token")
        at = m.end()
        sign, string, word = m.groups()
        if state == "over" or at > end:
            raise ValueError("more")
        value = done = None
        if sign in ("{", "[") and state in ("value", "first"):
            stack.append(({} if sign == "{" else [], key))
            state = "key1" if sign == "{" else "first"
            continue
        if sign == "]" and state in ("first", "next") and isinstance(stack[-1][0], list) or sign == "}" and state in ("key1", "next") and stack and isinstance(stack[-1][0], dict):
            value, key = stack.pop()
            done = True
        elif sign == "," and state == "next":
            state = "key" if isinstance(stack[-1][0], dict) else "value"
            continue
        elif sign == ":" and state == "colon":
            state = "value"
            continue
        elif string is not None and state in ("key", "key1"):
            key, state = json.loads(string), "colon"
            continue
        elif state in ("value", "first") and (string is not None or word is not None):
            value = json.loads(string) if string is not None else _WORDS[word] if word in _WORDS else Number(word)
            done = True
        if not done:
            raise ValueError("order")
        if not stack:
            out, state = value, "over"
        else:
            if isinstance(stack[-1][0], dict):
                stack[-1][0][key] = value
            else:
                stack[-1][0].append(value)
            state = "next"


def parse(text: str | None):
    """(True, value) of a JSON text; a top-level string is read as JSON in turn. (False, None) if it isn't valid as a whole."""
    try:
        while True:
            if text is None:
                return False, None
            try:
                value = _load(text)
            except RecursionError:
                value = _parse_deep(text)
            if type(value) is not str:
                return True, value
            text = value
    except ValueError:
        return False, None


def kind_of(x) -> str:
    if isinstance(x, dict):
        return "object"
    if isinstance(x, list):
        return "array"
    if x is None:
        return "null"
    return "boolean" if isinstance(x, bool) else "number" if isinstance(x, Number) else "string"


class _Chunk:
    """One leaf path of one record; ``steps[j]`` is the number of steps up to its j-th array."""

    __slots__ = ("path", "steps", "rep", "def_", "run", "kind", "value", "last")

    def __init__(self, path: tuple):
        self.path = path
        self.steps = [i + 1 for i, s in enumerate(path) if s is _EL]
        self.rep, self.def_, self.run, self.kind, self.value, self.last = [], [], [], [], [], None

    def _put(self, r: int, d: int, run: int, kind: str, value) -> None:
        self.rep.append(r)
        self.def_.append(d)
        self.run.append(run)
        self.kind.append(kind)
        self.value.append(value)

    def add(self, pos: tuple, kind: str, value) -> None:
        """An entry at array positions ``pos``; first the elements passed over since the last one."""
        r, level = 0, 0
        old = self.last
        if old is not None:
            while pos[level] == old[level]:
                level += 1
            r = level + 1
        for j in range(level, len(pos)):
            skipped = pos[j] - (old[j] + 1 if old is not None and j == level else 0)
            if skipped and r == j + 1:
                self._put(r, self.steps[j], skipped, "absent", None)
            elif skipped:
                self._put(r, self.steps[j], 1, "absent", None)
                if skipped > 1:
                    self._put(j + 1, self.steps[j], skipped - 1, "absent", None)
                r = j + 1
        self._put(r, len(self.path), 1, kind, value)
        self.last = pos


class _Element:
    """The step into an array; no key equals it."""


_EL = _Element()


def shred_value(root) -> list[_Chunk]:
    """The column chunks of one parsed record."""
    chunks: dict[tuple, _Chunk] = {}
    todo: list = [(root, (), ())]
    while todo:
        x, path, pos = todo.pop()
        kind = kind_of(x)
        # A filled array says no more than the chunks of what is in it.
        if path and (kind == "object" and path[-1] is _EL or kind not in ("object", "array") or not x):
            at = chunks.get(path)
            if at is None:
                at = chunks[path] = _Chunk(path)
            at.add(pos, kind, None if kind in ("object", "array", "null") else ("true" if x else "false") if kind == "boolean" else str(x))
        if kind == "object":
            todo.extend((x[k], (*path, k), pos) for k in reversed(x))
        elif kind == "array":
            inner = (*path, _EL)
            todo.extend((x[i], inner, (*pos, i)) for i in range(len(x) - 1, -1, -1))
    return list(chunks.values())


def positions(rep: list[int], run: list[int], kind: list[str], levels: int) -> Iterator[tuple[int, tuple]]:
    """(entry, positions) of the entries that are there, from the level sequence of a chunk with so many array levels."""
    at = [0] * levels
    for i, r in enumerate(rep):
        if r:
            at[r - 1] += run[i]
            at[r:] = [0] * (levels - r)
        else:
            at = [0] * levels
        if kind[i] != "absent":
            yield i, tuple(at)


def _clean(s: str | None) -> str | None:
    """Text that UTF-8 can hold: lone surrogates become the replacement character."""
    if s is None or s.isascii():
        return s
    return s.encode("utf-16", "surrogatepass").decode("utf-16", "replace")


def _shred(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    group: dict[tuple, tuple[list, list[_Chunk]]] = {}
    records = entries = 0

    def out(kind: pa.DataType) -> pa.RecordBatch:
        cols: dict[str, list] = {f.name: [] for f in CHUNK}
        for path, (_, chunks) in group.items():
            # A step into an array is null in the stored path: an object's key may read "[]".
            cols["path"].append([None if s is _EL else _clean(s) for s in path])
            for name, own in (("rep", "rep"), ("def", "def_"), ("run", "run"), ("kind", "kind")):
                cols[name].append([x for c in chunks for x in getattr(c, own)])
            cols["value"].append([_clean(v) for c in chunks for v in c.value])
        ids = pa.array([own for own, _ in group.values()], pa.list_(kind))
        return pa.RecordBatch.from_pydict({"ids": ids} | {f.name: pa.array(cols[f.name], f.type) for f in CHUNK})

    kind = None
    for batch in batches:
        kind = batch["id"].type
        for rid, text in zip(batch["id"].to_pylist(), batch["text"].to_pylist(), strict=True):
            ok, value = parse(text)
            if not ok:
                continue
            records += 1
            for c in shred_value(value):
                ids, chunks = group.setdefault(c.path, ([], []))
                ids.append(rid)
                chunks.append(c)
                entries += len(c.rep)
            if records >= GROUP_RECORDS or entries >= GROUP_ENTRIES:
                yield out(kind)
                group.clear()
                records = entries = 0
    if group:
        yield out(kind)


def shred(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """One row per row group and leaf path: ids, path (null: a step into an array), rep, def, run, kind, value (arrays).

    ids are those of the records with the leaf, in order: each repetition level 0 begins the next one. Repeated rows of an id and text count once. Null, empty and invalid texts give nothing; a text whose top level is a
    string is read as the JSON in that string. Of keys repeated in an object the last holds. Numbers keep their writing;
    kinds are object, array, null, boolean, number and string, and the first two have no value. An empty object or
    array is a leaf. Other columns of df are ignored.
    """
    id_type = df.schema[id_col].dataType.simpleString()
    rows = df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).filter("text IS NOT NULL").distinct()
    return rows.mapInArrow(_shred, f"ids array<{id_type}>, {CHUNK_DDL}")


def _spell(path: list, pos: tuple) -> str:
    out, j = "", 0
    for s in path:
        if s is None:
            out += f"[{pos[j]}]"
            j += 1
        else:
            out += f".{s}" if out else s
    return out


def _assemble(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out: dict[str, list] = {k: [] for k in ("id", "field_path", "node_path", "parent_path", "field", "kind", "value")}
        for row in batch.to_pylist():
            path, rep, run, kind, value = (row[k] for k in ("path", "rep", "run", "kind", "value"))
            record = list(itertools.accumulate(int(r == 0) for r in rep))  # of which record, from 1, an entry is
            arrays = [i for i, s in enumerate(path) if s is None]
            # An element whose next step is a key is an object; one whose next step is an element is an array.
            owners = [i for i in arrays if i + 1 < len(path) and path[i + 1] is not None]
            own = bool(path) and path[-1] is None  # the chunk of the elements themselves
            for e, pos in positions(rep, run, kind, len(arrays)):
                if own and kind[e] == "object":
                    cut_at, field = len(path), None
                else:
                    cut_at = owners[-1] + 1 if owners else 0
                    field = _spell(path[cut_at:], pos[sum(i < cut_at for i in arrays) :])
                above = [i for i in owners if i + 1 < cut_at]
                up = above[-1] + 1 if above else 0
                out["id"].append(row["ids"][record[e] - 1])
                out["field_path"].append(".".join(s for s in path[:cut_at] if s is not None))
                out["node_path"].append(_spell(path[:cut_at], pos))
                out["parent_path"].append(_spell(path[:up], pos))
                out["field"].append(field)
                out["kind"].append(kind[e])
                out["value"].append(value[e])
        yield pa.RecordBatch.from_pydict({"id": pa.array(out["id"], batch["ids"].type.value_type)} | {k: pa.array(v, pa.string()) for k, v in out.items() if k != "id"})


def assemble(chunks: DataFrame) -> DataFrame:
    """The related tables in long form: id, field_path (the table), node_path (the row), parent_path, field, kind, value.

    A row with a null field is an object that is an array element, the record of its table; the others are values that
    belong to the innermost such object around them, or to the submission's own table (empty paths). Everything follows
    from the level sequences, chunk by chunk, without a shuffle.
    """
    id_type = chunks.schema["ids"].dataType.elementType.simpleString()
    return chunks.mapInArrow(_assemble, f"id {id_type}, field_path string, node_path string, parent_path string, field string, kind string, value string")


def element_objects(chunks: DataFrame) -> DataFrame:
    """id, field_path, node_path, parent_path of all objects that are array elements; only their own chunks are read."""
    own = chunks.filter("size(path) > 0 AND element_at(path, -1) IS NULL")
    return assemble(own).filter("field IS NULL").select("id", "field_path", "node_path", "parent_path")


def flat_table(long: DataFrame, field_path: str, fields: list[str]) -> DataFrame:
    """One wide table: the objects at ``field_path`` with the given fields as text columns, null where absent."""
    rows = long.filter(F.col("field_path") == field_path)
    return rows.groupBy("id", "node_path", "parent_path").agg(*[F.max(F.when(F.col("field") == f, F.col("value"))).alias(f) for f in fields])


def object_rows(long: DataFrame) -> DataFrame:
    """One row per object that is an array element, and per record with fields of its own: id, field_path, node_path, parent_path, fields.

    fields maps each field to its value as text (null for a null, an empty object or array). A record is a row of the table
    with an empty path. Of fields that are spelled the same (a key ``a.b``, and b in a) the one with the least value
    counts. The fields of one object are all that a group holds.
    """
    own = F.array_sort(F.collect_list(F.when(F.col("field").isNotNull(), F.struct("field", "value"))))
    grouped = long.groupBy("id", "field_path", "node_path", "parent_path").agg(own.alias("own"))
    once = F.filter("own", lambda x, i: ~x.field.eqNullSafe(F.get(F.col("own"), i - 1)["field"]))
    return grouped.select("id", "field_path", "node_path", "parent_path", F.map_from_entries(once).alias("fields"))


def related_tables(long: DataFrame) -> DataFrame:
    """The tables there are: field_path, n_rows and columns, the fields of their objects in order."""
    fields = long.groupBy("field_path").agg(F.array_sort(F.collect_set("field")).alias("columns"))
    rows = long.filter("field IS NULL OR field_path = ''").groupBy("field_path").agg(F.count_distinct("id", "node_path").alias("n_rows"))
    return fields.join(rows, "field_path", "left").select("field_path", F.coalesce("n_rows", F.lit(0)).alias("n_rows"), "columns")


def write_tables(long: DataFrame, folder: str) -> dict[str, str]:
    """Writes each related table as wide Parquet, one text column per field; gives the folder of each field_path.

    The list of tables and their columns, which follows the shape of the records and not their number, is collected. A
    table's columns are id, node_path, parent_path and its fields; a field with such a name gets an underscore before it.
    Other field names than letters, digits and ``_`` are kept as they are: Parquet takes any. ``long`` is read once per table.
    """
    out = {}
    for k, t in enumerate(related_tables(long).orderBy("field_path").collect()):
        path = f"{folder.rstrip('/')}/table={k:04d}"
        rows = object_rows(long.filter(F.col("field_path") == t["field_path"]))
        seen, columns = {"id", "node_path", "parent_path"}, []
        for f in t["columns"]:
            name = f
            while name.lower() in seen:
                name = "_" + name
            seen.add(name.lower())
            columns.append(F.try_element_at("fields", F.lit(f)).alias(name))
        rows.select("id", "node_path", "parent_path", *columns).write.mode("overwrite").option("compression", "zstd").parquet(path)
        out[t["field_path"]] = path
    return out
