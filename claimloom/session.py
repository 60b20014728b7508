"""Session set-up and durable cuts of lineage.

``materialize`` is the one way in which the library cuts lineage: it writes a Parquet table into the
shared folder that the cluster names in ``spark.checkpoint.dir`` and reads it back.  Nothing is kept only
in an executor's memory or on its local disk, so lost executors cost recomputation of running tasks only.
"""

from __future__ import annotations

import atexit
import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_own_dirs: list[tuple[SparkSession, str]] = []


def get_session(app: str = "claimloom", cores: str = "*", **conf: str) -> SparkSession:
    """A local session with the settings that the engine expects; a cluster brings its own."""
    b = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.shuffle.partitions", conf.pop("shuffle_partitions", "8"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", conf.pop("driver_memory", "8g"))
        .config("spark.driver.host", "127.0.0.1")
    )
    for k, v in conf.items():
        b = b.config(k, v)
    return b.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The shared folder for intermediate tables: ``spark.checkpoint.dir``, or one of our own where it is unset.

    The fallback is machine-local and therefore only taken for a ``local`` master; on a cluster without the
    setting this raises instead of writing where other executors cannot read.
    """
    d = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if d:
        return d.rstrip("/")
    master = spark.sparkContext.master
    if not (master == "local" or master.startswith("local[")):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    d = tempfile.mkdtemp(prefix="claimloom-")
    spark.conf.set("spark.checkpoint.dir", "file://" + d)
    return "file://" + d


def new_path(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared folder, deleted when the application ends."""
    path = f"{shared_dir(spark)}/claimloom-{name}-{uuid.uuid4().hex[:12]}"
    _own_dirs.append((spark, path))
    return path


def delete_path(spark: SparkSession, path: str) -> None:
    """Delete an intermediate table; a missing one is no error."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def materialize(df: DataFrame, name: str = "cut") -> DataFrame:
    """Write ``df`` to the shared folder and return the written table (durable cut of lineage)."""
    spark = df.sparkSession
    path = new_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


class Scratch:
    """A folder for the written tables of one step, deleted when the ``with`` block ends.

    What the step returns must be written elsewhere (``materialize``) before the block ends.
    """

    def __init__(self, spark: SparkSession, name: str = "scratch"):
        self.spark, self.path, self.n = spark, new_path(spark, name), 0

    def __enter__(self) -> Scratch:
        return self

    def __exit__(self, *error) -> None:
        delete_path(self.spark, self.path)

    def cut(self, df: DataFrame) -> DataFrame:
        """``df`` as a written table of this folder."""
        self.n += 1
        df.write.parquet(f"{self.path}/{self.n}")
        return self.spark.read.schema(df.schema).parquet(f"{self.path}/{self.n}")


@atexit.register
def _clean() -> None:
    for spark, path in _own_dirs:
        try:
            if path.startswith("file://"):
                import shutil

                shutil.rmtree(path[7:], ignore_errors=True)
            elif os.sep == "/":
                delete_path(spark, path)
        except Exception:  # the gateway may be gone already
            pass
