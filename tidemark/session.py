"""Session settings and shared scratch space."""

from __future__ import annotations

import tempfile
import uuid
from contextlib import contextmanager

import pyarrow as pa
from pyspark import SparkConf
from pyspark.sql import DataFrame, SparkSession

# Runtime settings every plan here relies on. All can be changed on a running session.
RUNTIME_SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a hot join key even when that costs one more shuffle downstream.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # HotSpot never compiles methods above 8000 bytes of bytecode. One pass over many rules can generate such a
    # method; with this limit Spark evaluates that stage through smaller methods instead.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    # Timestamps are UTC instants; source zones are always written out when parsing.
    "spark.sql.session.timeZone": "UTC",
}

# Upper bound for rows of metadata (rules, column models) that may become driver-side plan input.
METADATA_ROW_LIMIT = 20_000


def tune(spark: SparkSession) -> SparkSession:
    for key, value in RUNTIME_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def local_session(name: str, cpus: int | str = 8, memory: str = "16g") -> SparkSession:
    """Session for tests and the benchmark. A cluster brings its own session and only calls `tune`.

    Where no shared folder is configured, the builder sets one: a local session's executors share its machine.
    """
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(name)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(cpus))
    )
    if not SparkConf().get("spark.checkpoint.dir", None):
        builder = builder.config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="spark-"))
    spark = tune(builder.getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    return spark


@contextmanager
def setting(spark: SparkSession, key: str, value: str):
    """A session setting for some statements; what was set before comes back."""
    before = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


def compact(spark: SparkSession):
    """Tables and scratch written inside take less disk for somewhat more time: for runs that write rows or hashes several times."""
    return setting(spark, "spark.sql.parquet.compression.codec", "zstd")


def scratch_dir(spark: SparkSession) -> str:
    """A new folder name below the shared checkpoint folder of the session."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    return f"{root.rstrip('/')}/tidemark/{uuid.uuid4().hex}"


def materialize(df: DataFrame) -> DataFrame:
    """Write a frame to shared scratch and read it back.

    The written table survives lost executors, cuts the lineage, and gives the planner real sizes.
    """
    path = scratch_dir(df.sparkSession)
    df.write.mode("error").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def metadata_frame(spark: SparkSession, rows: list[dict], columns: list[str] | None = None) -> DataFrame:
    """All-string frame of a few metadata rows, as a local relation whose exact size the planner knows."""
    columns = columns or list(rows[0])
    arrays = [pa.array([None if r.get(c) is None else str(r[c]) for r in rows], pa.string()) for c in columns]
    return spark.createDataFrame(pa.table(arrays, names=columns))


def metadata_rows(df: DataFrame, limit: int = METADATA_ROW_LIMIT) -> list[dict]:
    """Bring metadata to the driver for plan building; refuses anything that is data-sized."""
    rows = [r.asDict() for r in df.limit(limit + 1).collect()]
    if len(rows) > limit:
        raise ValueError(f"more than {limit} metadata rows: join this table instead of collecting it")
    return rows
