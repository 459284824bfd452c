"""Materialised intermediate tables in the cluster's shared folder.

A long plan that is read by several branches (the feature table feeds
price statistics, demand fits and splits) is written once as Parquet under
``spark.checkpoint.dir`` and read back: lineage is cut, recomputation after
an executor loss restarts from the written files, and later scans get
column pruning and filter pushdown.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame

from tillsense.session import checkpoint_dir


_CACHES: list[dict] = []


def session_cache() -> dict:
    """A dict of stored tables keyed by ``(applicationId, ...)``; its entries
    for an application are dropped together with that application's tables."""
    d: dict = {}
    _CACHES.append(d)
    return d


def cache_key(spark, folder: str) -> tuple:
    """Key of what is stored for an input folder: it changes with the folder's
    number of files, their total size or its modification time."""
    sc = spark.sparkContext
    path = sc._jvm.org.apache.hadoop.fs.Path(folder)
    fs = path.getFileSystem(sc._jsc.hadoopConfiguration())
    total = fs.getContentSummary(path)
    return sc.applicationId, folder, total.getFileCount(), total.getLength(), fs.getFileStatus(path).getModificationTime()


def session_tables_root(spark) -> str:
    """All tables one application stores live under one folder, so they can
    be removed together."""
    base = checkpoint_dir(spark).rstrip("/")
    return f"{base}/tables/{spark.sparkContext.applicationId}"


def table_path(df: DataFrame, name: str) -> str:
    return f"{session_tables_root(df.sparkSession)}/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str, partition_cols: list[str] | None = None) -> DataFrame:
    path = table_path(df, name)
    w = df.write.mode("overwrite").option("compression", "zstd")
    if partition_cols:
        w = w.partitionBy(*partition_cols)
    w.parquet(path)
    return df.sparkSession.read.parquet(path)


def drop_session_tables(spark) -> bool:
    """Delete every intermediate table this application stored and forget
    the cached handles to them. Call it when the job's results are written:
    DataFrames returned earlier that read these tables must not be used
    afterwards. Goes through the Hadoop FileSystem of the folder, so it
    works for HDFS, S3 or ABFS as well as a local path."""
    app = spark.sparkContext.applicationId
    for d in _CACHES:
        for k in [k for k in d if isinstance(k, tuple) and k and k[0] == app]:
            del d[k]
    sc = spark.sparkContext
    path = sc._jvm.org.apache.hadoop.fs.Path(session_tables_root(spark))
    fs = path.getFileSystem(sc._jsc.hadoopConfiguration())
    return bool(fs.delete(path, True))
