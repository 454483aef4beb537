"""Session construction and the shared work folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def build_session(master: str = "local[*]", shuffle_partitions: int = 8,
                  app: str = "pumpline", extra: dict | None = None) -> SparkSession:
    """Session for tests and the bench.  On a cluster use the cluster's session."""
    b = (SparkSession.builder.master(master).appName(app)
         .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
         .config("spark.sql.adaptive.enabled", "true")
         .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
         .config("spark.sql.adaptive.skewJoin.enabled", "true")
         .config("spark.sql.session.timeZone", "UTC")
         .config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false")
         .config("spark.driver.memory", "8g")
         .config("spark.sql.execution.arrow.pyspark.enabled", "true"))
    for k, v in (extra or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_root(spark: SparkSession) -> str:
    """Folder every executor can see: the session's checkpoint directory.

    The cluster names it in ``spark.checkpoint.dir``.  Only when it is unset
    (local tests) do we create one, and never on a non-local master.
    """
    sc = spark.sparkContext
    d = sc.getCheckpointDir()
    if d:
        return d
    conf = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not conf:
        if not sc.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
        conf = tempfile.mkdtemp(prefix="pumpline-ckpt-")
    sc.setCheckpointDir(conf)
    return sc.getCheckpointDir()


def work_path(spark: SparkSession, name: str) -> str:
    """A fresh sub-folder of the shared root for one run of one job."""
    return f"{shared_root(spark).rstrip('/')}/pumpline/{name}-{uuid.uuid4().hex[:12]}"


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``pumpline`` importable in the executors' Python workers (the
    programmatic form of ``--py-files``), once per application.

    Needed where Python runs in tasks (``applyInPandasWithState`` state
    functions); everything else runs in the JVM.
    """
    import os
    import shutil

    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    pkg = os.path.dirname(os.path.abspath(__file__))
    out = tempfile.mkdtemp(prefix="pumpline-pyfiles-")
    archive = shutil.make_archive(os.path.join(out, "pumpline"), "zip", os.path.dirname(pkg), "pumpline")
    sc.addPyFile(archive)
    _SHIPPED.add(sc.applicationId)
