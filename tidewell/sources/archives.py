"""Archives, metadata files and Parquet footers as DataFrames."""

from __future__ import annotations

import io
import itertools
from collections.abc import Iterator
from urllib.parse import unquote

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewell.functions.formats import MANIFEST_SUFFIX, archive_part, record_kind
from tidewell.session import cut

#: Windows up to 2 GiB, as long-distance matching makes them; Spark's own codec refuses them.
MAX_WINDOW = 2**31

MANIFEST = (
    "filename string, file_size bigint, last_modified string, row_count bigint, conversion_method string, schema map<string,string>, columns array<string>, "
    "column_stats map<string,struct<count:bigint,usage_ratio:double>>, conversion_history struct<machine:struct<machine:string,ip:string>,started_at:string,finished_at:string,stages:map<string,struct<duration_sec:double,speed_mb_s:double>>>"
)
CLAIM = "zst_filename string, machine_meta struct<machine:string,ip:string>, started_at string, stage string, updated_at string"
JOB_LOG = "filename string, status string, last_update string, error string"


def catalog(spark: SparkSession, paths: str | list[str], glob: str = "*") -> DataFrame:
    """path, name, group (archive, table, manifest, claim or other), kind, year, month, size and modified of each file.

    Paths may be patterns; a file that several of them name comes once. No content is read.
    """
    files = spark.read.format("binaryFile").option("pathGlobFilter", glob).option("recursiveFileLookup", "true").load(paths).select("path", F.col("length").alias("size"), F.col("modificationTime").alias("modified")).dropDuplicates(["path"])
    name = F.element_at(F.split("path", "/"), -1)
    group = F.when(F.col("name").endswith(".zst"), "archive").when(F.col("name").endswith(".parquet"), "table").when(F.col("name").endswith(MANIFEST_SUFFIX), "manifest").when(F.col("name").endswith(".claim.json"), "claim").otherwise("other")
    return files.withColumn("name", name).select("path", "name", group.alias("group"), record_kind(F.col("name")).alias("kind"), archive_part(F.col("name"), 2).cast("int").alias("year"), archive_part(F.col("name"), 3).cast("int").alias("month"), "size", "modified")


def read_lines(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """The lines of text files, compressed or not, with Spark's own codecs: one column, value."""
    return spark.read.text(paths)


def spread(lines: DataFrame) -> DataFrame:
    """Lines of a few files that can't be split, over all cores: parsing costs more than moving them. Others stay as they are."""
    n = lines.sparkSession.sparkContext.defaultParallelism
    return lines.repartition(n) if lines.rdd.getNumPartitions() < n else lines


def _place(path: str):
    """(file system, path there) of a path as Spark spells it: file:/x, file:///x, /x or another system's URI."""
    from pyarrow import fs

    local = path.removeprefix("file:") if path.startswith("file:") else path
    return (fs.LocalFileSystem(), "/" + unquote(local).lstrip("/")) if "://" not in local else fs.FileSystem.from_uri(path)


def _decoder(first_lines: int | None):
    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        for batch in batches:
            for path in batch["path"].to_pylist():
                system, where = _place(path)
                with system.open_input_stream(where, compression=None) as raw, zstandard.ZstdDecompressor(max_window_size=MAX_WINDOW).stream_reader(raw, read_across_frames=True) as plain:
                    lines, size = [], 0
                    text = io.TextIOWrapper(io.BufferedReader(plain, 1 << 20), encoding="utf-8", errors="replace", newline="\n")
                    for line in itertools.islice(text, first_lines):
                        lines.append(line.rstrip("\r\n"))
                        size += len(line)
                        if size > 4_000_000:
                            yield pa.RecordBatch.from_pydict({"path": [path] * len(lines), "value": lines})
                            lines, size = [], 0
                    if lines:
                        yield pa.RecordBatch.from_pydict({"path": [path] * len(lines), "value": lines})

    return decode


def read_zstd(files: DataFrame, *, first_lines: int | None = None) -> DataFrame:
    """path and value: the lines of the zstd files of a catalog, long windows included; invalid UTF-8 becomes U+FFFD.

    A file is one task, since a frame can't be split: repartition the lines before they are parsed. A damaged or cut-off
    file is an error, never a short result. With ``first_lines`` a test run reads no more of each file.
    """
    n = max(1, files.count())
    return files.select("path").repartition(n).mapInArrow(_decoder(first_lines), "path string, value string")


def write_zstd(lines: DataFrame, folder: str) -> DataFrame:
    """Writes rows (name, value) as one zstd file of lines for each name; gives name and n_lines of what was written.

    The lines of a name stream through one task into its file, in any order; no more than a buffer is held. A file
    appears under its name when it is whole, so a repeated task replaces it. The result is a stored table.
    """

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import uuid

        import zstandard

        system, base = _place(folder)
        system.create_dir(base, recursive=True)
        name, out, n, part = None, None, 0, ""

        def close() -> pa.RecordBatch:
            out.close()
            system.move(part, f"{base}/{name}")
            return pa.RecordBatch.from_pydict({"name": [name], "n_lines": [n]})

        for batch in batches:
            for own, line in zip(batch["name"].to_pylist(), batch["value"].to_pylist(), strict=True):
                if own != name:
                    if out is not None:
                        yield close()
                    name, n, part = own, 0, f"{base}/.{own}.{uuid.uuid4().hex}"
                    out = zstandard.ZstdCompressor().stream_writer(system.open_output_stream(part))
                out.write(line.encode() + b"\n")
                n += 1
        if out is not None:
            yield close()

    names = max(1, lines.select("name").distinct().count())
    return cut(lines.select("name", "value").repartition(names, "name").sortWithinPartitions("name").mapInArrow(write, "name string, n_lines bigint"))


def _footers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    import pyarrow.parquet as pq

    for batch in batches:
        rows: list[tuple] = []
        for path in batch["path"].to_pylist():
            system, where = _place(path)
            try:
                with system.open_input_file(where) as f:
                    meta = pq.read_metadata(f)
                    schema = meta.schema.to_arrow_schema()
                nulls = _nulls(meta)
                rows += [(path, meta.num_rows, meta.num_row_groups, i, c.name, str(c.type), nulls.get(c.name), None) for i, c in enumerate(schema)] or [(path, meta.num_rows, meta.num_row_groups, None, None, None, None, None)]
            except (OSError, pa.ArrowInvalid) as x:
                rows.append((path, None, None, None, None, None, None, str(x)[:200]))
        cols = list(zip(*rows, strict=True)) if rows else [()] * 8
        kinds = (pa.string(), pa.int64(), pa.int32(), pa.int32(), pa.string(), pa.string(), pa.int64(), pa.string())
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], names=["path", "n_rows", "n_row_groups", "position", "column_name", "type", "n_null", "error"])


def _nulls(meta) -> dict[str, int]:
    """The nulls of each flat column of which every row group states them."""
    out: dict[str, int] = {}
    for j in range(meta.num_columns):
        column = meta.schema.column(j)
        if column.max_repetition_level or column.path != column.name:
            continue
        stated = [(s.null_count if s is not None and s.has_null_count else None) for s in (meta.row_group(g).column(j).statistics for g in range(meta.num_row_groups))]
        if None not in stated:
            out[column.name] = sum(stated)
    return out


def footers(files: DataFrame, *, files_per_task: int = 200) -> DataFrame:
    """One row per file and column: path, n_rows, n_row_groups, position, column_name, type, n_null and error, from footers alone.

    n_null is null where the footer doesn't state it: for nested columns, and for files without statistics. A file that is no Parquet gives one row with an error.
    """
    n = files.count()
    return files.select("path").repartition(max(1, min(n, -(-n // files_per_task) if n > 1000 else n))).mapInArrow(_footers, "path string, n_rows bigint, n_row_groups int, position int, column_name string, type string, n_null bigint, error string")


def read_json_files(spark: SparkSession, paths: str | list[str], schema: str) -> DataFrame:
    """One record per file (manifests, claims); unreadable files are left out."""
    return spark.read.option("multiLine", "true").option("mode", "PERMISSIVE").schema(f"{schema}, _corrupt_record string").json(paths).filter("_corrupt_record IS NULL").drop("_corrupt_record")


def usage_statistics(spark: SparkSession, path: str) -> DataFrame:
    """field, rank, type, usage of a usage-statistics file: of the first element, each field's types in their order."""
    raw = spark.read.option("wholetext", "true").text(path)
    doc = raw.select(F.from_json("value", "array<struct<schema:map<string,array<struct<type:string,usage:string>>>>>").alias("d"))
    fields = doc.select(F.explode(F.col("d")[0]["schema"]).alias("field", "types"))
    return fields.select("field", F.posexplode("types").alias("rank", "t")).select("field", "rank", "t.type", "t.usage")


def described_types(spark: SparkSession, path: str) -> DataFrame:
    """path and type of every place that a usage-statistics file describes, level by level; of several types the first."""
    raw = spark.read.option("wholetext", "true").text(path)
    first = "array<struct<type:string,schema:variant>>"
    level = raw.select(F.from_json("value", f"array<struct<schema:map<string,{first}>>>").alias("d")).select(F.explode(F.col("d")[0]["schema"]).alias("field", "t")).select(F.array("field").alias("path"), F.col("t")[0].alias("t"))
    out = None
    while True:
        level = cut(level.filter("t IS NOT NULL").select("path", "t.type", F.to_json("t.schema").alias("inner")))
        own = level.select("path", "type")
        out = own if out is None else out.unionByName(own)
        if level.filter("inner IS NOT NULL").isEmpty():
            return out
        keyed = level.filter("type = 'object'").select("path", F.explode(F.from_json("inner", f"map<string,{first}>")).alias("key", "t")).select(F.concat("path", F.array("key")).alias("path"), F.col("t")[0].alias("t"))
        listed = level.filter("type = 'array'").select(F.concat("path", F.array(F.lit("[]"))).alias("path"), F.from_json("inner", first)[0].alias("t"))
        level = keyed.unionByName(listed)
