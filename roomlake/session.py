"""Spark session helpers.

The library never creates machine-local scratch space on a cluster: lineage
cuts go to the shared folder named by ``spark.checkpoint.dir``. Only when
that setting is absent *and* the master is local (tests, the bench) is a
temporary folder created.
"""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

UTC_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # detector checkpoints are removed once their DataFrame is garbage collected
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "roomlake", extra: dict | None = None) -> SparkSession:
    """Session for tests and the bench: local master, UTC, AQE on, UI off."""
    b = (SparkSession.builder.master(f"local[{cores}]").appName(app)
         .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
         .config("spark.driver.memory", "16g"))
    for k, v in {**UTC_CONF, **(extra or {})}.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    ship_package(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the session's checkpoint folder, setting one only for local masters."""
    try:
        sc = spark.sparkContext
    except Exception:  # Spark Connect: the server's spark.checkpoint.dir applies
        return spark.conf.get("spark.checkpoint.dir", "")
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = spark.conf.get("spark.checkpoint.dir", None)
    if conf_dir:
        sc.setCheckpointDir(conf_dir)
        return sc.getCheckpointDir()
    if not sc.master.startswith("local"):
        raise RuntimeError(
            "spark.checkpoint.dir is not set; point it at a shared folder "
            "(HDFS/S3/ABFS) so lineage cuts survive executor loss")
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="roomlake-ckpt-"))
    return sc.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh sub-folder of the checkpoint folder for intermediate tables."""
    import uuid

    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/{name}-{uuid.uuid4().hex[:12]}"


def ship_package(spark: SparkSession) -> None:
    """Make ``roomlake`` importable in local-mode Python workers.

    Zips the package once per SparkContext and registers it with
    ``addPyFile`` -- for local masters only (tests, the bench, the driver's
    checks), whose workers may start in another directory.  On a cluster the
    package is deployed like any PySpark code (``--py-files roomlake.zip`` or
    installed on the executors); nothing is written to machine-local folders.
    """
    import os
    import zipfile

    try:
        sc = spark.sparkContext
    except Exception:
        return
    if getattr(sc, "_roomlake_shipped", False) or not sc.master.startswith("local"):
        return
    pkg = os.path.dirname(os.path.abspath(__file__))
    out = os.path.join(tempfile.mkdtemp(prefix="roomlake-pyfiles-"), "roomlake.zip")
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        for root, _dirs, files in os.walk(pkg):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(root, f)
                    z.write(full, os.path.relpath(full, os.path.dirname(pkg)))
    sc.addPyFile(out)
    sc._roomlake_shipped = True
