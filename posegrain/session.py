"""Session helpers: reading tables and cutting lineage where every executor can read it."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid
import zipfile
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The parquet table ``name`` of the data set in ``sf_dir``."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Take the shared folder from ``spark.checkpoint.dir``; only where none is set, as in tests, a local one."""
    sc = spark.sparkContext
    if sc._jsc.sc().getCheckpointDir().isDefined():
        return
    shared = sc.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        shared = tempfile.mkdtemp(prefix="posegrain-checkpoints-")
        atexit.register(shutil.rmtree, shared, ignore_errors=True)
    sc.setCheckpointDir(shared)


def _checkpoint(df: DataFrame, settings: dict[str, str]) -> DataFrame:
    """A checkpoint of ``df``, planned under ``settings``."""
    ensure_checkpoint_dir(df.sparkSession)
    conf = df.sparkSession.conf
    before = {k: conf.get(k) for k in settings}
    try:
        for k, v in settings.items():
            conf.set(k, v)
        return df.checkpoint()
    finally:
        for k, v in before.items():
            conf.set(k, v)


# What is known of a plan's rows goes with its checkpoint and grows with every one that follows, until planning takes
# minutes; these conditions only add filters for NULLs.
PLAIN = {"spark.sql.constraintPropagation.enabled": "false"}


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write ``df`` to the checkpoint folder and go on from there, so a lost executor costs no recomputation."""
    return _checkpoint(df, PLAIN)


def cut_lineage_in_place(df: DataFrame) -> DataFrame:
    """``cut_lineage`` that keeps how ``df`` is partitioned and sorted, so that what comes next needs no shuffle.

    An adaptive plan does not tell its layout, so this one step is planned without; its partitions are those the caller asked for.
    """
    return _checkpoint(df, {**PLAIN, "spark.sql.adaptive.enabled": "false"})


def written(df: DataFrame) -> DataFrame:
    """``df`` as a table in the checkpoint folder, deleted with the session: for loops.

    A checkpoint keeps its plan's estimated size, which each join multiplies, until in a loop the estimates alone take minutes; a table
    has the size of its files.
    """
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    sc = spark.sparkContext
    path = sc._jvm.org.apache.hadoop.fs.Path(f"{sc._jsc.sc().getCheckpointDir().get()}/table-{uuid.uuid4().hex}")
    path.getFileSystem(sc._jsc.hadoopConfiguration()).deleteOnExit(path)
    df.write.parquet(path.toString())
    return spark.read.schema(df.schema).parquet(path.toString())


def ship_package(spark: SparkSession) -> None:
    """Give the executors' Python workers this package, once per application."""
    sc = spark.sparkContext
    if getattr(sc, "_posegrain_shipped", False):
        return
    root = Path(__file__).resolve().parent
    archive = os.path.join(tempfile.mkdtemp(prefix="posegrain-"), f"{root.name}.zip")
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as out:
        for path in sorted(root.rglob("*.py")):
            out.write(path, path.relative_to(root.parent))
    sc.addPyFile(archive)
    sc._posegrain_shipped = True


def map_rows(df: DataFrame, function: Callable, schema: str) -> DataFrame:
    """``mapInArrow`` with this package at hand in the workers."""
    ship_package(df.sparkSession)
    return df.mapInArrow(function, schema)
