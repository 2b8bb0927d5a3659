"""Where jobs keep checkpoints and tables in between."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def new_workspace(spark: SparkSession) -> str:
    """A new folder below the shared one that `spark.checkpoint.dir` names.

    Without that setting, a temporary folder in local mode and an error elsewhere:
    on a cluster no machine's own folder will do.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root is None:
        if not spark.conf.get("spark.master", "").startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all machines share")
        root = tempfile.gettempdir()
    return f"{root.rstrip('/')}/ordertally-{uuid.uuid4().hex}"
