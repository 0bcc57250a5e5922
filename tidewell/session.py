"""Session settings and shared scratch space."""

from __future__ import annotations

import atexit
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

#: Settings the engine relies on. The wide tables have up to 151 columns, beyond the default limit for whole-stage codegen.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.codegen.maxFields": "200",
    "spark.sql.variant.allowDuplicateKeys": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build(master: str = "local[8]", shuffle_partitions: int = 8, **more: str) -> SparkSession:
    """A session with the engine's settings, for tests and the bench; a cluster brings its own."""
    builder = SparkSession.builder.master(master).appName("tidewell")
    for key, value in (SETTINGS | {"spark.sql.shuffle.partitions": str(shuffle_partitions), "spark.ui.enabled": "false", "spark.driver.memory": "8g"} | more).items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def tune(spark: SparkSession) -> None:
    """Sets, on a session that others made, the SQL settings that results depend on."""
    for key in ("spark.sql.session.timeZone", "spark.sql.codegen.maxFields", "spark.sql.variant.allowDuplicateKeys"):
        if spark.conf.get(key, None) != SETTINGS[key]:
            spark.conf.set(key, SETTINGS[key])


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: spark.checkpoint.dir, or a folder of our own where that is unset (one machine)."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        named = "file://" + tempfile.mkdtemp(prefix="tidewell-")
        spark.conf.set("spark.checkpoint.dir", named)
    return named.rstrip("/")


_written: list[tuple[SparkSession, str]] = []


def scratch(spark: SparkSession) -> str:
    """A new path in the shared folder, for what lives until drop_scratch()."""
    path = f"{shared_dir(spark)}/tidewell-{uuid.uuid4().hex}"
    _written.append((spark, path))
    return path


def cut(df: DataFrame) -> DataFrame:
    """Writes df as a table in the shared folder and returns the table as read: lineage ends here, and a lost executor costs nothing already written.

    The table lives until drop_scratch(); store what was made of it before that.
    """
    path = scratch(df.sparkSession)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def drop_scratch() -> None:
    """Deletes every table that cut() wrote; results that read them must be stored first."""
    while _written:
        spark, path = _written.pop()
        try:
            where = spark._jvm.org.apache.hadoop.fs.Path(path)
            where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)
        except Exception:  # the session has ended
            return


atexit.register(drop_scratch)


def parts(n_rows: int, per_part: int) -> int:
    """Partitions needed for n_rows at per_part rows each."""
    return max(1, -(-n_rows // per_part))
