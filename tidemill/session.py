"""Session settings and the folder that all executors share."""

from __future__ import annotations

import atexit
import re
import shutil
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

SHARED_DIR_KEY = "spark.checkpoint.dir"


def local_session(app: str = "tidemill", cores: int | str = "*", **conf: str) -> SparkSession:
    """A session for tests and the bench; a cluster brings its own."""
    settings = {
        "spark.sql.shuffle.partitions": "8",
        "spark.sql.session.timeZone": "UTC",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.driver.memory": "8g",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
    }
    settings |= {k.replace("__", "."): v for k, v in conf.items()}
    b = SparkSession.builder.master(f"local[{cores}]").appName(app)
    for k, v in settings.items():
        b = b.config(k, v)
    return b.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``. Where it is unset a local session gets a
    temporary one; a cluster session without it is refused, since a machine's own folder
    is not seen by the other machines."""
    d = spark.conf.get(SHARED_DIR_KEY, None) or spark.sparkContext.getConf().get(SHARED_DIR_KEY)
    if not d:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise ValueError(f"set {SHARED_DIR_KEY} to a folder that all executors share")
        own = tempfile.mkdtemp(prefix="tidemill-")
        atexit.register(shutil.rmtree, own, ignore_errors=True)
        d = "file://" + own
        spark.conf.set(SHARED_DIR_KEY, d)
    return d.rstrip("/")


def ship(spark: SparkSession) -> SparkSession:
    """Send this package to the executors once per context, so that Python functions find it there
    wherever the session was started."""
    sc, root = spark.sparkContext, Path(__file__).resolve().parent
    if not getattr(sc, "_tidemill_shipped", False) and root.is_dir():
        path = Path(tempfile.mkdtemp(prefix="tidemill-")) / "tidemill.zip"
        with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
            for f in sorted(root.rglob("*.py")):
                z.write(f, f"{root.name}/{f.relative_to(root).as_posix()}")
        sc.addPyFile(str(path))
        sc._tidemill_shipped = True
    return spark


_made: list[str] = []


def fresh_dir(spark: SparkSession, label: str) -> str:
    """A new path under the shared folder, until ``release``."""
    path = f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex[:12]}"
    _made.append(path)
    return path


def release(spark: SparkSession) -> int:
    """Delete what this process wrote under the shared folder, once no frame that was made of it is needed; how many paths.
    A temporary folder of a local session goes at the end of the process."""
    jvm, n = spark.sparkContext._jvm, 0
    while _made:
        p = jvm.org.apache.hadoop.fs.Path(_made.pop())
        n += p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)
    return n


def written(df, label: str):
    """df, written to the shared folder and read again: cuts lineage, survives executor loss."""
    spark = df.sparkSession
    path = fresh_dir(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
