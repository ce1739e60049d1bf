"""The folder that driver and executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


#: Bytes of a method beyond which HotSpot does not compile it.
LARGEST_METHOD = 8000


def compilable(spark: SparkSession) -> None:
    """Stages whose generated method HotSpot would only interpret are run operator by operator, in methods that it compiles."""
    key = "spark.sql.codegen.hugeMethodLimit"
    if int(spark.conf.get(key)) > LARGEST_METHOD:
        spark.conf.set(key, str(LARGEST_METHOD))


def new_path(spark: SparkSession, name: str) -> str:
    """A new path under spark.checkpoint.dir; under a temporary folder only where the session names none and all runs in one process (tests)."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        folder = "file://" + tempfile.mkdtemp(prefix="spark-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return f"{folder.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def written(df, name: str):
    """df, written to the shared folder and read back: computed once, whatever reads it, and cheap to recover."""
    compilable(df.sparkSession)
    path = new_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
