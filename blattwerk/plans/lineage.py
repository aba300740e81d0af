"""Cutting lineage and choosing join sides by measured size."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Rows up to which a side of fixed-width columns is broadcast (about 32 MB at 16 bytes a row).
BROADCAST_ROWS = 2_000_000


def cut(df: DataFrame) -> DataFrame:
    """``df`` written to the shared checkpoint folder and read again.

    The folder is the session's ``spark.checkpoint.dir``. Only a local session
    without that setting (as in tests) gets a folder of its own. The files go when
    nothing refers to the frame any more, so a long session does not fill the disk.
    """
    spark = df.sparkSession
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if not folder:
            if not sc.master.startswith("local"):
                raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
            folder = tempfile.mkdtemp(prefix="blattwerk-")
        sc.setCheckpointDir(folder)
    sc._jsc.sc().conf().set("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
    return df.checkpoint(eager=True)


def spread(df: DataFrame) -> DataFrame:
    """``df``, a scan, over as many partitions as there are cores if it has fewer (a single small file).

    Large inputs have more splits than cores and stay as they are, without a shuffle.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= cores else df.repartition(cores)


def broadcast_if_small(df: DataFrame, max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """``df`` with a broadcast hint if it has at most ``max_rows`` rows, else as it is.

    Give it a frame that is cheap to count (one that went through :func:`cut`);
    beyond the bound Spark joins by shuffle.
    """
    return F.broadcast(df) if df.count() <= max_rows else df
