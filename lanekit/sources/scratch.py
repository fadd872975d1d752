"""Shared scratch locations.

Intermediate tables and round-trip exports go below the directory the cluster
names in ``spark.checkpoint.dir`` (shared storage every executor can reach).
A machine-local folder is only created when nothing is configured and the
master is local (unit tests); on a cluster the setting is required.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


_MATERIALIZED: dict[str, list[str]] = {}
_KEPT: dict[str, dict[str, str]] = {}
_DATABASES: dict[str, list[str]] = {}


def shared_root(spark: SparkSession) -> str:
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        configured = tempfile.mkdtemp(prefix="lanekit-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path below the shared root, remembered for
    :func:`release_all`."""
    path = f"{shared_root(spark)}/lanekit/{name}-{uuid.uuid4().hex[:12]}"
    _MATERIALIZED.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


def remember_database(spark: SparkSession, name: str) -> None:
    _DATABASES.setdefault(spark.sparkContext.applicationId, []).append(name)


def unique_name(prefix: str) -> str:
    return f"{prefix}_{uuid.uuid4().hex[:10]}"


def materialize(df, name: str = "stage"):
    """Write ``df`` once as parquet below the shared root and return a scan
    of it: the result is computed a single time however often it is used
    later, and its lineage is cut (a lost executor re-reads files instead of
    recomputing the upstream joins). Unlike an uncached ``checkpoint()``,
    the upstream plan runs once."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def kept(spark: SparkSession, name: str, make):
    """``make()`` written once per application under ``name`` and scanned
    back from then on, also after :func:`release_all` (unless that is told to
    take everything). For inputs that many queries derive alike."""
    paths = _KEPT.setdefault(spark.sparkContext.applicationId, {})
    if name not in paths:
        path = f"{shared_root(spark)}/lanekit/kept-{uuid.uuid4().hex[:12]}"
        make().write.mode("overwrite").parquet(path)
        paths[name] = path                     # only once it is whole
    return spark.read.parquet(paths[name])


def is_kept(spark: SparkSession, names) -> bool:
    return set(names) <= set(_KEPT.get(spark.sparkContext.applicationId, {}))


def release_all(spark: SparkSession, everything: bool = False) -> int:
    """Delete every scratch folder of this application and the databases in
    it (call it once the results that read them are written), with
    ``everything`` also those of :func:`kept`. Returns how many folders were
    removed."""
    paths = _MATERIALIZED.pop(spark.sparkContext.applicationId, [])
    if everything:
        paths += _KEPT.pop(spark.sparkContext.applicationId, {}).values()
    for name in _DATABASES.pop(spark.sparkContext.applicationId, []):
        spark.sql(f"DROP DATABASE IF EXISTS {name} CASCADE")
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    for p in paths:
        hp = jvm.org.apache.hadoop.fs.Path(p)
        hp.getFileSystem(conf).delete(hp, True)
    return len(paths)
