"""Tables written once to the cluster's shared folder so later steps read the same rows.

A spool cuts lineage: a lost executor re-reads files instead of re-running the chain, and range
boundaries that Spark sampled are settled before anything depends on them.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F


_scopes: ContextVar[tuple[list[str], ...]] = ContextVar("spool_scopes", default=())


@contextmanager
def spool_scope(spark: SparkSession) -> Iterator[None]:
    """Empty the spools written inside the block when it ends; for jobs that store their results.

    Spools that ``outlast`` the block are left to the block around it.
    """
    paths: list[str] = []
    token = _scopes.set((*_scopes.get(), paths))
    try:
        yield
    finally:
        _scopes.reset(token)
        for path in paths:
            spark.range(0).write.mode("overwrite").parquet(path)


def shared_folder(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``; a temporary one only for local masters."""
    context = spark.sparkContext
    folder = context.getConf().get("spark.checkpoint.dir") or context.getCheckpointDir()
    if folder:
        return folder.rstrip("/")
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that every executor can reach")
    folder = tempfile.mkdtemp(prefix="seqprep-spool-")
    context.setCheckpointDir(folder)
    return folder


def spool(df: DataFrame, name: str, outlasts: bool = False) -> DataFrame:
    """Write ``df`` as Parquet under the shared folder and return the stored table."""
    spark = df.sparkSession
    application = spark.sparkContext.applicationId
    path = f"{shared_folder(spark)}/seqprep-{application}/{name}-{uuid.uuid4().hex}"
    scopes = _scopes.get()[:-1] if outlasts else _scopes.get()
    if scopes:
        scopes[-1].append(path)
    df.write.mode("errorifexists").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def spool_counted(df: DataFrame, name: str) -> tuple[DataFrame, int]:
    """``spool``, with the row count taken while writing.

    A repeated task may be counted twice: use the number as an upper limit for choosing a plan.
    """
    seen = Observation()
    stored = spool(df.observe(seen, F.count(F.lit(1)).alias("rows")), name)
    return stored, seen.get.get("rows") or 0
