"""Session helpers: configuration for tests, and where shared intermediate files go."""

from __future__ import annotations

import atexit
import io
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

#: Settings of a local session; on a cluster the submitter's settings hold.
LOCAL_CONF = {
    "spark.sql.shuffle.partitions": "8",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.driver.host": "127.0.0.1",
}


def local_session(cores: int | str = 8, memory: str = "8g", **conf: str) -> SparkSession:
    """A session on this machine, for tests and benches."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName("lodestream")
    builder = builder.config("spark.driver.memory", memory)
    for key, value in (LOCAL_CONF | conf).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share, from ``spark.checkpoint.dir``; only a session
    without that setting (a test) gets a folder of its own."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if found:
        return found
    if not spark.sparkContext.master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    made = getattr(spark, "_lodestream_dir", None)
    if made is None:
        made = "file://" + tempfile.mkdtemp(prefix="lodestream-")
        spark._lodestream_dir = made
    return made


def cut(df: DataFrame) -> DataFrame:
    """The rows of df with their lineage cut: written once as Parquet to the shared folder.

    Unlike a cache it survives the loss of executors, and unlike a recomputation
    it costs one pass however often it is read.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/cut-{uuid.uuid4().hex}"
    if not hasattr(spark, "_lodestream_cuts"):
        spark._lodestream_cuts = []
        atexit.register(clean, spark)
    spark._lodestream_cuts.append(path)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def clean(spark: SparkSession) -> int:
    """Delete the tables that cut() wrote in this session, and say how many. Results that still
    depend on them can't be read any more; at the end of the application it runs by itself."""
    paths = getattr(spark, "_lodestream_cuts", [])
    done = 0
    while paths:
        path = paths.pop()
        try:
            at = spark._jvm.org.apache.hadoop.fs.Path(path)
            done += bool(at.getFileSystem(spark._jsc.hadoopConfiguration() if hasattr(spark, "_jsc") else spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True))
        except Exception:  # noqa: BLE001  the JVM may be gone
            break
    return done


def ship(spark: SparkSession) -> None:
    """Make this package importable in the executors of a cluster, once per context: it is
    written as a zip to the shared folder and added to the session's Python files. Without
    a shared folder the submitter has to take care of it."""
    context = spark.sparkContext
    known = getattr(context, "_lodestream_shipped", False)
    if known or context.master.startswith("local[") or not spark.conf.get("spark.checkpoint.dir", None):
        return
    root = Path(__file__).resolve().parent
    packed = io.BytesIO()
    with zipfile.ZipFile(packed, "w", zipfile.ZIP_DEFLATED) as z:
        for p in sorted(root.rglob("*.py")):
            z.write(p, f"{root.name}/{p.relative_to(root)}")
    path = f"{shared_dir(spark)}/{root.name}-{uuid.uuid4().hex}/{root.name}.zip"
    jvm = context._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    out = at.getFileSystem(context._jsc.hadoopConfiguration()).create(at, True)
    out.write(bytearray(packed.getvalue()))
    out.close()
    context.addPyFile(path)
    context._lodestream_shipped = True
