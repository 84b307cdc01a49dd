"""Session helpers: local sessions for tests/bench, and the shared checkpoint folder."""

from __future__ import annotations

import io
import os
import tempfile
import zipfile

from pyspark.sql import DataFrame, SparkSession

_SHIPPED: set[str] = set()


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "quillsync") -> SparkSession:
    """A local session configured like the cluster one (AQE on, UI off, UTC)."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        # chunking and embedding cost CPU per row, not bytes: on few cores keep
        # AQE from coalescing a post-join stage into fewer tasks than cores
        .config("spark.sql.adaptive.coalescePartitions.minPartitionSize", "256k")
        # after a join turns broadcast at runtime, keep reducer-side (hash by
        # key) partitions rather than the mappers' layout: the chunking and
        # embedding that follow joins cost CPU per row and need balance
        .config("spark.sql.adaptive.localShuffleReader.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", "16g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    ship_package(spark)
    return spark


def ship_package(spark: SparkSession) -> None:
    """Make ``quillsync`` importable in the Python workers (once per application).

    Operators that run Python in tasks (mapInPandas, cogroup, pandas UDFs)
    pickle functions of this package by reference; the workers import it.
    The package is zipped on the driver and added with ``addPyFile``, the
    same as ``--py-files`` at submit time.  A cluster whose image already
    has the package installed needs nothing of this.
    """
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    pkg = os.path.dirname(os.path.abspath(__file__))
    root = os.path.dirname(pkg)
    buf = io.BytesIO()
    with zipfile.ZipFile(buf, "w", zipfile.ZIP_DEFLATED) as z:
        for dirpath, _dirs, files in os.walk(pkg):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(dirpath, f)
                    z.write(full, os.path.relpath(full, root))
    staging = tempfile.mkdtemp(prefix="quillsync-pyfiles-")
    path = os.path.join(staging, "quillsync.zip")
    with open(path, "wb") as f:
        f.write(buf.getvalue())
    sc.addPyFile(path)
    _SHIPPED.add(sc.applicationId)


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the cluster's ``spark.checkpoint.dir``; set a scratch one only when unset.

    On a cluster the setting names a shared folder every executor can reach;
    a scratch folder is only made in local mode (tests); on a cluster without the
    setting this raises.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    current = spark.sparkContext.getCheckpointDir()
    if configured:
        if not current:
            spark.sparkContext.setCheckpointDir(configured)
        return configured
    if current:
        return current
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    scratch = tempfile.mkdtemp(prefix="quillsync-ckpt-")
    spark.conf.set("spark.checkpoint.dir", scratch)
    spark.sparkContext.setCheckpointDir(scratch)
    return scratch


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint into the shared checkpoint folder (survives executor loss)."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A sub-folder of the shared checkpoint folder for written intermediate tables."""
    base = ensure_checkpoint_dir(spark)
    return os.path.join(base, name)


def clean_up(spark: SparkSession) -> None:
    """Has the driver collect its garbage.  Spark removes the shuffles and broadcasts of finished
    jobs when the driver's JVM collects what refers to them; between the steps of a loop of many small jobs
    this is done at once, so that neither they nor the driver's heap pile up."""
    spark.sparkContext._jvm.System.gc()
