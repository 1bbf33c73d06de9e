"""A new folder that driver and executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def scratch(spark: SparkSession) -> str:
    """Below spark.checkpoint.dir of the session, or below a temporary folder where none is set and the session runs on one machine."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named and not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
    return f"{named or tempfile.gettempdir()}/noisefield-{uuid.uuid4().hex}"
