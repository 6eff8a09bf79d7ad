"""Session defaults, and the shared folder operators store steps in.

Operators take DataFrames and never build a session themselves.
"""

from __future__ import annotations

import gc
import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def get_session(app_name: str = "martloom", **conf) -> SparkSession:
    """A session with the settings the library is tested with.

    Keyword names use ``__`` for dots: ``get_session(spark__sql__shuffle__partitions=8)``.
    """
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    }
    settings.update({k.replace("__", "."): str(v) for k, v in conf.items()})
    builder = SparkSession.builder.appName(app_name)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The cluster's shared checkpoint folder, named by ``spark.checkpoint.dir``.

    Only a local session without that setting gets a temporary folder of its own.
    """
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        shared = spark.conf.get("spark.checkpoint.dir", None)
        if shared is None:
            if not re.fullmatch(r"local(\[[^\]]*\])?", sc.master):
                raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
            shared = tempfile.mkdtemp(prefix="martloom-checkpoint-")
        sc.setCheckpointDir(shared)
    return sc.getCheckpointDir()


def checkpointed(df: DataFrame) -> DataFrame:
    """Cut the lineage through the shared folder."""
    shared_folder(df.sparkSession)
    return df.checkpoint()


def stored(df: DataFrame, partition_by: list[str] = ()) -> DataFrame:
    """Like ``checkpointed``, but as parquet: reads take only their columns, and only the partitions they ask for.

    The files go when the application ends, or with ``release``.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/stored-{uuid.uuid4().hex}"
    df.write.partitionBy(*partition_by).option("compression", "zstd").parquet(path)
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(folder)
    return spark.read.schema(df.schema).parquet(path)


def kept(df: DataFrame) -> DataFrame:
    """``stored``, or ``checkpointed`` where parquet cannot hold a column. A checkpoint is neither compressed nor in columns."""
    kinds, names = df.schema.simpleString(), [c.lower() for c in df.columns]
    plain = "void" not in kinds and "interval" not in kinds and len(set(names)) == len(names)
    return stored(df) if plain else checkpointed(df)


def release(*frames: DataFrame) -> None:
    """Delete what ``stored`` wrote for the frames, none of which is read again; and ``drop_shuffles``.

    Frames derived from a stored one stand for it, as they read its files.
    """
    spark = frames[0].sparkSession
    folders = {m[1] for df in frames for f in df.inputFiles() if (m := re.match(r"(.*/stored-[0-9a-f]{32})/", f))}
    for name in folders:
        folder = spark._jvm.org.apache.hadoop.fs.Path(name)
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
    drop_shuffles(spark)


def drop_shuffles(spark: SparkSession) -> None:
    """Have Spark remove shuffle files of frames that are gone, which else stay until the driver happens to collect its garbage."""
    gc.collect()
    spark._jvm.System.gc()
