"""Sessions, and the folder that the driver and all executors share."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

#: Used only where a session on one machine names no ``spark.checkpoint.dir``.
FALLBACK_DIR = "/tmp/checkpoints"
#: Rows of a few columns that a task of a small step has at least, where there are as many.
TASK_ROWS = 20_000


def build_session(master: str | None = None, **conf: str) -> SparkSession:
    """A session in UTC with adaptive execution and room for long revision chains."""
    builder = SparkSession.builder.appName("curatrix")
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.cteRecursionLevelLimit": "10000",
    } | {k.replace("__", "."): v for k, v in conf.items()}
    return builder.config(map=settings).getOrCreate()


def shared_root(spark: SparkSession) -> str:
    """The shared folder that the session names. Without one a session on one machine has its own; on a cluster it raises, as
    executors do not see each other's folders."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named and not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
        raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
    return (named or FALLBACK_DIR).rstrip("/")


def shared_path(spark: SparkSession, name: str) -> str:
    """A new path for a table that is written once and read again."""
    return f"{shared_root(spark)}/{name}-{uuid.uuid4().hex}"


def checkpointed(df: DataFrame) -> DataFrame:
    """``df`` with its lineage cut by files in the shared folder, so that lost executors lose nothing."""
    spark = df.sparkSession
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(shared_root(spark))
    return df.checkpoint()


@contextmanager
def _set(spark: SparkSession, **conf: str) -> Iterator[None]:
    """Settings, with ``__`` for a dot, that are put back."""
    named = {name.replace("__", "."): value for name, value in conf.items()}
    before = {name: spark.conf.get(name, None) for name in named}
    for name, value in named.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            if value is None:
                spark.conf.unset(name)
            else:
                spark.conf.set(name, value)


@contextmanager
def measured_joins(spark: SparkSession) -> Iterator[None]:
    """Joins that are planned and run inside broadcast what a shuffle has measured as small, or a hint names, and nothing that
    is only estimated to be so: a table made by Python, ``from_json`` or ``explode`` is estimated by the columns it came from."""
    planned, measured = "spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"
    with _set(spark, **{measured: spark.conf.get(measured, None) or spark.conf.get(planned), planned: "-1"}):
        yield


@contextmanager
def tidied(spark: SparkSession) -> Iterator[None]:
    """What is run inside leaves no shuffle files: they go when it ends, not when the driver happens to collect its garbage. For
    results that are read from files after it."""
    with _set(spark, spark__sql__classic__shuffleDependency__fileCleanup__enabled="true"):
        yield


def settled(df: DataFrame) -> DataFrame:
    """``checkpointed``, with ``measured_joins`` and ``tidied``: for tables of documents, whose sizes cannot be estimated."""
    with measured_joins(df.sparkSession), tidied(df.sparkSession):
        # planned inside, as a plan keeps the settings that it was made with
        return checkpointed(df.select("*"))


def shuffled(df: DataFrame) -> DataFrame:
    """``df``, joined by shuffles also where Spark takes it for small. Texts made of a few columns, and what Python reads from
    them, are estimated by the size of those columns; a broadcast of them would be held by the driver and every executor."""
    return df.hint("merge")


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """``df`` dealt out by its keys to as many tasks as there are shuffle partitions. A number that is given is not made smaller:
    rows of a few bytes that stand for long work would otherwise be put into one task."""
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *keys)


def counted(df: DataFrame) -> tuple[DataFrame, int]:
    """``checkpointed``, and how many rows that wrote: no job of its own counts them."""
    rows = Observation()
    held = checkpointed(df.observe(rows, F.count(F.lit(1)).alias("n")))
    return held, rows.get["n"]


def fitted(df: DataFrame, rows: int, task_rows: int = TASK_ROWS) -> DataFrame:
    """``df`` in no more partitions than so many rows need. Steps that repeat on small tables otherwise write a file a task
    and shuffle, and these outgrow the rows."""
    return df.coalesce(max(1, -(-rows // task_rows)))


def compact(df: DataFrame) -> DataFrame:
    """``checkpointed``, in partitions that fit its rows."""
    return fitted(*counted(df))


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet into the shared folder and read again, for column-pruned reuse."""
    path = shared_path(df.sparkSession, name)
    with tidied(df.sparkSession):
        df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
