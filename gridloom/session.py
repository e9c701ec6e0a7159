"""Session defaults, table loading, reliable checkpoints and size-checked broadcasts."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Largest side in rows that ``bounded_broadcast`` ships to every executor.
BROADCAST_ROWS = 200_000
#: Largest side in bytes, about.
BROADCAST_BYTES = 32_000_000


def local_session(cpus: int = 8, app: str = "gridloom", **conf: str) -> SparkSession:
    """A local session for tests and benchmarks; a cluster brings its own."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(cpus))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.host", "127.0.0.1")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def load(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    """One table of a data folder: a parquet file or a folder of part files."""
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Uses the shared folder of ``spark.checkpoint.dir``; only a local session may go without one and gets a folder of this machine."""
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        shared = spark.conf.get("spark.checkpoint.dir", None) or context.getConf().get("spark.checkpoint.dir")
        if not shared and not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        context.setCheckpointDir(shared or os.path.join(tempfile.gettempdir(), "gridloom-checkpoints"))


#: Setting under which Spark deletes a query's shuffle files when it ends; it counts where the query is made.
_DELETE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def cut_lineage(df: DataFrame) -> DataFrame:
    """Writes ``df`` to the shared checkpoint folder and goes on from the files, which outlive any executor.

    The shuffle files that led to them are deleted at once, not when the driver happens to collect its garbage.
    """
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    before = spark.conf.get(_DELETE_SHUFFLES, None)
    spark.conf.set(_DELETE_SHUFFLES, "true")
    try:
        return df.select("*").checkpoint(eager=True)
    finally:
        if before is None:
            spark.conf.unset(_DELETE_SHUFFLES)
        else:
            spark.conf.set(_DELETE_SHUFFLES, before)


def row_bytes(df: DataFrame) -> Column:
    """About the bytes of a row: the letters of its text form and eight per column."""
    return F.lit(8 * len(df.columns)) + F.coalesce(F.length(F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns]))), F.lit(0))


def bounded_broadcast(df: DataFrame, max_rows: int = BROADCAST_ROWS, max_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Materialises a small side once, measures it, and marks it for broadcast only within both bounds.

    Beyond them the same rows come back unmarked, so that a shuffle join is planned.
    """
    kept = cut_lineage(df)
    size = kept.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(row_bytes(kept)), F.lit(0)).alias("bytes")).first()
    return F.broadcast(kept) if size["n"] <= max_rows and size["bytes"] <= max_bytes else kept
