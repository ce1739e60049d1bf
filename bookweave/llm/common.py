"""What the corpus operators share: the tables, the shared folder and written intermediate tables."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share; one of our own only where the session names none and all runs in one process (tests)."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        folder = "file://" + tempfile.mkdtemp(prefix="spark-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder.rstrip("/")


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write df to the shared folder and read it back: lineage is cut and a lost executor costs nothing."""
    path = new_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def discard(df: DataFrame) -> None:
    """Delete the files of a stored table that nothing will read again."""
    spark = df.sparkSession
    for file in df.inputFiles()[:1]:
        path = spark._jvm.org.apache.hadoop.fs.Path(file).getParent()
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def small_batches(spark: SparkSession, mb: int = 8) -> None:
    """Whole documents go to Python in batches of at most so many megabytes, which bounds a worker's memory."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    number, unit = re.fullmatch(r"(-?[0-9]+)\s*([kmgt]?)b?", spark.conf.get(key).strip().lower()).groups()
    if int(number) << 10 * " kmgt".index(unit or " ") > mb << 20 or int(number) <= 0:
        spark.conf.set(key, str(mb << 20))


#: What a worker process keeps between tasks, by name: one thing at a time.
_KEPT: dict = {}


def kept(name, make):
    """What make() gives, made once in each worker and kept there until something else is, or until drop_kept."""
    if name not in _KEPT:
        _KEPT.clear()
        _KEPT[name] = make()
    return _KEPT[name]


def drop_kept() -> None:
    """Frees what an earlier step kept in this worker, which lives on and would hold it through all that follows."""
    _KEPT.clear()


def text_of(column: str = "text"):
    return F.coalesce(F.col(column), F.lit(""))
