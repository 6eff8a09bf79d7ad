"""Which landed files have been loaded, so that a run opens only new ones.

A file is known by pipeline, path, length and time of change; one that was landed anew under its old
name is read again. The listing is joined with the ledger before any file is opened. Files are
recorded after their rows are loaded: a run that stops in between reads them once more, which upserts bear.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martloom.session import checkpointed
from martloom.sinks.tables import save

FILE = ["path", "length", "modified"]


def landed_files(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """path, length and modified of the files a path or glob names; their content is not read."""
    files = spark.read.format("binaryFile").load(path)
    return files.select("path", "length", F.col("modificationTime").alias("modified"))


def unread(files: DataFrame, ledger: str, pipeline: str) -> DataFrame:
    """The files that ``pipeline`` has not recorded in the table ``ledger``."""
    spark = files.sparkSession
    if not spark.catalog.tableExists(ledger):
        return checkpointed(files)
    known = spark.table(ledger).where(F.col("pipeline") == pipeline).select(*FILE)
    return checkpointed(files.join(known, FILE, "left_anti"))  # listed once, as files may land meanwhile


def record(files: DataFrame, ledger: str, pipeline: str, batch_id: str) -> None:
    """Note that ``pipeline`` has loaded the files."""
    rows = files.select(F.lit(pipeline).alias("pipeline"), *FILE, F.lit(batch_id).alias("batch_id"))
    save(rows.coalesce(1), ledger, "append", partition_by="pipeline")


def paths_of(files: DataFrame) -> list[str]:
    """Paths to hand to a reader. Spark's listing has all paths on the driver too."""
    return [r.path for r in files.select("path").collect()]
