"""Session helpers.

The library never creates a cluster session itself; ``local_session`` is
for tests and the bench.  ``checkpoint_dir`` reads the shared folder the
cluster names in ``spark.checkpoint.dir`` and only falls back to a fresh
scratch folder in local mode (tests).
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int = 8, shuffle_partitions: int | None = None,
                  app: str = "quarry") -> SparkSession:
    scratch = tempfile.mkdtemp(prefix="quarry-ckpt-")
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions or cores))
        .config("spark.default.parallelism", str(cores))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("QUARRY_DRIVER_MEMORY", "16g"))
        .config("spark.checkpoint.dir", scratch)
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ship_package(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared checkpoint folder; set one only when the session has none."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf = spark.conf.get("spark.checkpoint.dir", None)
    if not conf:
        master = sc.master or ""
        if not master.startswith("local"):
            raise RuntimeError(
                "spark.checkpoint.dir is not set; point it at a shared folder "
                "(HDFS/S3/ABFS) before running iterative operators")
        conf = tempfile.mkdtemp(prefix="quarry-ckpt-")
    sc.setCheckpointDir(conf)
    return sc.getCheckpointDir() or conf


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint (survives executor loss) to cut long lineages."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint location (never a
    machine-local temp folder on a cluster)."""
    import uuid
    base = checkpoint_dir(spark).rstrip("/")
    return f"{base}/scratch/{name}-{uuid.uuid4().hex[:12]}"


_SHIPPED: set = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``quarry`` importable in every Python worker (pandas UDFs,
    mapInPandas and co-grouped functions are pickled by module reference):
    zip the package once per SparkContext and ``addPyFile`` it, which Spark
    distributes to the executors."""
    import os
    import zipfile
    sc = spark.sparkContext
    key = sc.applicationId
    if key in _SHIPPED:
        return
    import quarry
    root = os.path.dirname(os.path.abspath(quarry.__file__))
    path = os.path.join(tempfile.mkdtemp(prefix="quarry-pkg-"), "quarry.zip")
    with zipfile.ZipFile(path, "w") as z:
        for dp, _, files in os.walk(root):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(dp, f)
                    z.write(full, os.path.relpath(full, os.path.dirname(root)))
    sc.addPyFile(path)
    _SHIPPED.add(key)
