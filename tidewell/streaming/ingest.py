"""Normalising new archives as they arrive."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from tidewell.operators.layout import sort_global, write_table
from tidewell.operators.normalize import BAD, split
from tidewell.session import cut


def ingest(spark: SparkSession, source: str, kind: str, out: str, state: str, *, bad: str | None = None, glob: str = "*") -> StreamingQuery:
    """Starts a query that brings every file of ``source`` not seen before into the wide table at ``out``, and ends.

    ``state`` is the folder that remembers what was seen. Each micro-batch is a sorted part of its own, and writing it
    again replaces it, so a batch repeated after a failure doesn't repeat its rows. Lines that are no record go to ``bad``.
    """

    def write(batch: DataFrame, number: int) -> None:
        rows = cut(split(batch, kind))  # parsed once
        write_table(sort_global(rows.filter(f"{BAD} IS NULL").drop(BAD)), f"{out}/batch={number}", mode="overwrite")
        if bad:
            rows.filter(f"{BAD} IS NOT NULL").select(BAD).write.mode("overwrite").text(f"{bad}/batch={number}")

    lines = spark.readStream.option("pathGlobFilter", glob).text(source)
    return lines.writeStream.foreachBatch(write).option("checkpointLocation", state).trigger(availableNow=True).start()
