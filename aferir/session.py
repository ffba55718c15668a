"""Session helpers shared by tests, bench and library code."""

from __future__ import annotations

import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Limits of a table that may be broadcast, both checked.
BROADCAST_ROWS = 50_000
BROADCAST_BYTES = 64 << 20


def local_session(cpus: int | str = 8, app: str = "aferir", driver_memory: str = "12g") -> SparkSession:
    """A local session for tests and the bench; on a cluster use the session you are given."""
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(cpus))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", driver_memory)
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Use the folder in ``spark.checkpoint.dir``; a local session without one uses the warehouse."""
    sc = spark.sparkContext
    if not sc.getCheckpointDir():
        folder = spark.conf.get("spark.checkpoint.dir", "")
        if not folder and not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        sc.setCheckpointDir(folder or f"{spark.conf.get('spark.sql.warehouse.dir')}/_checkpoints")


def materialise(df: DataFrame) -> DataFrame:
    """Cut lineage with a reliable checkpoint, so several consumers share one computation."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint()


@contextmanager
def staged(df: DataFrame, by: Sequence[str] = ()) -> Iterator[DataFrame]:
    """The rows written once as Parquet in the checkpoint folder, so that several readers take only the
    columns they need; removed at the end."""
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    path = f"{spark.sparkContext.getCheckpointDir()}/staged-{uuid.uuid4().hex}"
    df.write.partitionBy(*by).parquet(path)
    try:
        yield spark.read.schema(df.schema).parquet(path).select(*df.columns)
    finally:
        place = spark._jvm.org.apache.hadoop.fs.Path(path)
        place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def is_small(df: DataFrame, rows: int = BROADCAST_ROWS, size: int = BROADCAST_BYTES) -> bool:
    """Whether a materialised table has at most ``rows`` rows of ``size`` bytes in all (as JSON text)."""
    width = F.octet_length(F.to_json(F.struct("*")))
    found = df.limit(rows + 1).select(width.alias("w")).agg(F.count("*"), F.sum("w")).first()
    return found[0] <= rows and (found[1] or 0) <= size


def broadcast_if_small(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """Hint a broadcast only after measuring a materialised side; larger sides stay shuffled."""
    return F.broadcast(df) if is_small(df, rows) else df
