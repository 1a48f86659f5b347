"""Write-once intermediate tables in the shared folder.

The OLAP table is the hand-off between the ETL and every analysis (the
source pipeline writes it once and reuses it).  Here it is written as
Parquet under the session's shared checkpoint folder, keyed by a
fingerprint of the inputs and the ETL version, and read back by every later
query: lineage is cut, and a lost executor re-reads files instead of
recomputing the joins.
"""

from __future__ import annotations

import hashlib
import uuid

from pyspark.sql import DataFrame, SparkSession

from ledgerflow.session import checkpoint_dir

ETL_VERSION = "etl-5"
CACHE_CONF = "spark.ledgerflow.cache.dir"


def _fs(spark: SparkSession, path: str):
    """The Hadoop file system of a path (of any scheme, or of the default one) and the path on it."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def _fs_exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return fs.exists(p)


def list_names(spark: SparkSession, folder: str) -> list[str]:
    """Entry names in a folder on any Hadoop-supported file system."""
    fs, p = _fs(spark, folder)
    return sorted(st.getPath().getName() for st in fs.listStatus(p)) if fs.exists(p) else []


def _files(spark: SparkSession, folder: str) -> list[str]:
    """Every file below a folder with its size and time of change."""
    fs, p = _fs(spark, folder)
    if not fs.exists(p):
        return []
    found, it = [], fs.listFiles(p, True)
    while it.hasNext():
        st = it.next()
        found.append(f"{st.getPath().toString()}:{st.getLen()}:{st.getModificationTime()}")
    return sorted(found)


def fingerprint(*parts: str, inputs: str | None = None, spark: SparkSession | None = None) -> str:
    """A key of the ETL version, ``parts`` and the state of all files below ``inputs``."""
    h = hashlib.sha1(ETL_VERSION.encode())
    for p in parts:
        h.update(str(p).encode())
    if inputs:
        for f in _files(spark or SparkSession.getActiveSession(), inputs):
            h.update(f.encode())
    return h.hexdigest()[:16]


def cache_root(spark: SparkSession) -> str:
    """``spark.ledgerflow.cache.dir``, else a folder in the one that ``spark.checkpoint.dir`` names: both
    outlive the application, so a later run finds the tables.  A session without either (tests) uses
    its own checkpoint folder."""
    root = spark.conf.get(CACHE_CONF, None)
    base = spark.conf.get("spark.checkpoint.dir", None) or checkpoint_dir(spark)
    return root or f"{base.rstrip('/')}/ledgerflow-tables"


def materialized(spark: SparkSession, name: str, build, key: str) -> DataFrame:
    """Read ``name`` for ``key`` if a complete copy exists, else build, write, read."""
    path = f"{cache_root(spark).rstrip('/')}/{name}-{key}"
    if not _fs_exists(spark, f"{path}/_SUCCESS"):
        tmp = f"{path}.tmp-{uuid.uuid4().hex[:8]}"
        build().write.mode("overwrite").option("compression", "zstd").parquet(tmp)
        if _fs_exists(spark, f"{path}/_SUCCESS") or not _rename(spark, tmp, path):
            path = tmp   # another writer finished first; use our own complete copy
    return spark.read.parquet(path)


def _rename(spark: SparkSession, src: str, dst: str) -> bool:
    """Whether ``src`` is now ``dst``; not if ``dst`` was there already."""
    fs, s = _fs(spark, src)
    d = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(dst)
    return not fs.exists(d) and bool(fs.rename(s, d))
