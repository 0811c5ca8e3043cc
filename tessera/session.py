"""SparkSession defaults and small session-level helpers.

Everything the library does goes through a plain ``SparkSession``; this module
only pins the settings the semantics depend on (UTC, ANSI, AQE) and resolves
the shared checkpoint folder.
"""

from __future__ import annotations

import atexit
import os
import re
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings every plan in the library assumes.
_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # rows with long texts would make batches of tens of megabytes in every Python worker
    "spark.sql.execution.arrow.maxBytesPerBatch": "8m",
}


def get_session(master: str | None = None, app: str = "tessera", shuffle_partitions: int | None = None,
                extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with the library defaults.

    On a cluster ``master`` stays ``None`` so the launcher decides; tests pass
    ``local[*]``.
    """
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    for k, v in _DEFAULTS.items():
        b = b.config(k, v)
    b = b.config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
    if master and master.startswith("local"):
        # local mode runs everything in the driver JVM
        b = b.config("spark.driver.memory", os.environ.get("TESSERA_DRIVER_MEMORY", "16g"))
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def apply_defaults(spark: SparkSession) -> SparkSession:
    """Pin the runtime-settable defaults on a session we did not build."""
    for k, v in _DEFAULTS.items():
        try:
            spark.conf.set(k, v)
        except Exception:  # static conf on some deployments
            pass
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """Shared folder for checkpoints and written intermediate tables.

    Reads ``spark.checkpoint.dir`` from the session. Where it is unset, a local
    session (one process) gets a scratch folder that goes with the process; on a
    cluster a folder of the driver's machine would be lost data, so that is an error.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        root = tempfile.mkdtemp(prefix="tessera-ckpt-")
        atexit.register(shutil.rmtree, root, ignore_errors=True)
        spark.conf.set("spark.checkpoint.dir", root)
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(root)
    return root.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared checkpoint folder."""
    return f"{checkpoint_root(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def cut_lineage(df: DataFrame, eager: bool = True) -> DataFrame:
    """Reliable checkpoint (never ``localCheckpoint``): survives executor loss."""
    checkpoint_root(df.sparkSession)
    return df.checkpoint(eager=eager)
