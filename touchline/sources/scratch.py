"""Shared scratch folders."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def scratch(spark: SparkSession) -> str:
    """A new path in the shared folder of the cluster (spark.checkpoint.dir);
    where that is unset, as in tests on one machine, in a temporary folder.  A
    cluster has no such folder that all its machines see: it must be set there."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if spark.sparkContext.master.split("[")[0] != "local":
            raise ValueError("spark.checkpoint.dir is not set: name a folder that all executors share")
        root = tempfile.mkdtemp(prefix="touchline-")
        spark.conf.set("spark.checkpoint.dir", root)
    return f"{root.rstrip('/')}/touchline-{uuid.uuid4().hex}"
