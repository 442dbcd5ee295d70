"""Cutting long plans at a written copy."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame


def cut(df: DataFrame) -> DataFrame:
    """The table as written to the checkpoint folder of the session: computed once, and safe from lost executors.

    The cluster names the folder in `spark.checkpoint.dir`. Only where neither that nor a folder of the running
    context is set is a temporary one taken, and only by a local master.
    """
    spark = df.sparkSession
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        named = spark.conf.get("spark.checkpoint.dir", None)
        if not named and (not context.master.startswith("local") or context.master.startswith("local-cluster")):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        context.setCheckpointDir(named or tempfile.mkdtemp(prefix="checkpoints-"))
    return df.checkpoint(eager=True)
