"""Session construction and the shared work folder.

Jobs that must cut lineage or stage files (landing folders, versioned
datasets, stream checkpoints) write below the folder the cluster names in
``spark.checkpoint.dir``.  A value of our own is only set when the session
has none (local tests, the bench).
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

_DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str = "local[8]", shuffle_partitions: int = 8,
                  app_name: str = "tessera", extra: dict | None = None) -> SparkSession:
    """Local session used by tests and the bench (clusters bring their own)."""
    builder = SparkSession.builder.master(master).appName(app_name)
    conf = dict(_DEFAULT_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.setdefault("spark.driver.memory", "16g")
    # local runs keep catalog folders out of the working directory
    conf.setdefault("spark.sql.warehouse.dir", os.path.join(os.environ.get("TESSERA_TMP", "/tmp"),
                                                            "tessera-warehouse"))
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    ship_package(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, creating a local one only if unset."""
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        d = spark.sparkContext.getCheckpointDir()
    if not d:
        if not spark.sparkContext.master.startswith("local"):
            # executors cannot share a driver-local folder: insist on a shared one
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
        d = tempfile.mkdtemp(prefix="tessera-ckpt-", dir=os.environ.get("TESSERA_TMP", "/tmp"))
        spark.conf.set("spark.checkpoint.dir", d)
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(d)
    return d.rstrip("/")


def work_path(spark: SparkSession, *parts: str, unique: bool = True) -> str:
    """A fresh path below the shared folder (one per run, never reused)."""
    base = ensure_checkpoint_dir(spark)
    leaf = "/".join(p.strip("/") for p in parts)
    if unique:
        leaf = f"{leaf}-{uuid.uuid4().hex[:12]}" if leaf else uuid.uuid4().hex[:12]
    return f"{base}/tessera/{leaf}"


_SHIPPED: set = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``tessera`` importable in every Python worker (``addPyFile``).

    Spark's Python workers run this package's code for the few Python
    operators (header reader, alert state processor, model hook).  The
    package is zipped in memory, written into the shared checkpoint folder
    through the Hadoop filesystem API and registered once per application.
    """
    import io
    import zipfile

    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    pkg = os.path.dirname(os.path.abspath(__file__))
    root = os.path.dirname(pkg)
    buf = io.BytesIO()
    with zipfile.ZipFile(buf, "w", zipfile.ZIP_DEFLATED) as z:
        for base, _dirs, files in os.walk(pkg):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(base, f)
                    z.write(full, os.path.relpath(full, root))
    target = work_path(spark, "pyfiles") + "/tessera.zip"
    jvm = sc._jvm
    p = jvm.org.apache.hadoop.fs.Path(target)
    out = p.getFileSystem(sc._jsc.hadoopConfiguration()).create(p, True)
    out.write(bytearray(buf.getvalue()))
    out.close()
    sc.addPyFile(target)
    # Python processes started on the driver (e.g. the state processor's pre-init
    # runner) take their environment from here rather than from the pyFiles list.
    cur = sc.environment.get("PYTHONPATH", "")
    if root not in cur.split(os.pathsep):
        sc.environment["PYTHONPATH"] = os.pathsep.join(p for p in (root, cur) if p)
    _SHIPPED.add(sc.applicationId)
