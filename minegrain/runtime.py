"""Session settings, lineage cuts and shared scratch folders."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Largest model state (cells of a weight or centroid matrix) that may live on the driver.
MAX_DRIVER_CELLS = 20_000_000
# Most bytes of a table that are sent to every executor.
BROADCAST_BYTES = 32_000_000


def local_session(cores: str = "8", app: str = "minegrain", **conf: str) -> SparkSession:
    """A session for tests and benchmarks; clusters bring their own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", cores if cores.isdigit() else "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach: `spark.checkpoint.dir`, or a temp folder in local mode."""
    sc = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if folder is None:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
        folder = tempfile.mkdtemp(prefix="minegrain-")
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(folder)
    return folder


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """Materialise `df` in the shared folder, so that later steps plan from there and lost executors cost nothing."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def stored(df: DataFrame, label: str) -> DataFrame:
    """`df` as Parquet files of the shared folder, for loops whose steps join their own results.

    A checkpoint keeps the estimated size of its plan, and a join multiplies both sides' sizes: after some twenty steps such
    an estimate has millions of digits. Here later steps estimate from the files.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def broadcast_if_small(df: DataFrame, limit: int = BROADCAST_BYTES) -> DataFrame:
    """`df` materialised and measured: marked for broadcast up to `limit` bytes, else left to a shuffle join.

    Numbers count 8 bytes each and strings and binaries their length. Beyond the limit, adaptive skew handling splits hot
    keys.
    """
    stored = cut_lineage(df)
    texts = [c for c, kind in stored.dtypes if kind in ("string", "binary")]
    width = F.lit(8 * len(stored.columns) + 8)
    for c in texts:
        width = width + F.coalesce(F.octet_length(c), F.lit(0))
    size = stored.agg(F.sum(width.cast("long"))).first()[0] or 0
    return F.broadcast(stored) if size <= limit else stored


def check_driver_cells(cells: int, what: str) -> None:
    if cells > MAX_DRIVER_CELLS:
        raise ValueError(f"{what} has {cells} cells, more than the driver limit of {MAX_DRIVER_CELLS}")
