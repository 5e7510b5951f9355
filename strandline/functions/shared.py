"""The folder that driver and executors share, and tables written there to cut lineage."""

from __future__ import annotations

import os
import tempfile
import threading
import uuid
import zipfile
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """spark.checkpoint.dir of the session; one of our own only where that is unset and driver and tasks are one process."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        base = "file://" + tempfile.mkdtemp(prefix="strandline-")
        spark.conf.set("spark.checkpoint.dir", base)
    return base.rstrip("/")


def written(df: DataFrame, name: str) -> DataFrame:
    """df as a Parquet table in the shared folder, read back."""
    path = f"{shared_dir(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._strandline_path = path  # type: ignore[attr-defined]
    for held in getattr(_scratch, "stack", []):
        held.append(out)
    return out


_scratch = threading.local()


@contextmanager
def scratch() -> Iterator[None]:
    """What this thread writes with written() inside is deleted at the end, for a caller whose results do not read it any more."""
    _scratch.stack = [*getattr(_scratch, "stack", []), []]
    try:
        yield
    finally:
        *_scratch.stack, mine = _scratch.stack
        for df in mine:
            discard(df)


def discard(df: DataFrame) -> None:
    """Delete what written() wrote for df, once nothing reads it any more."""
    path = getattr(df, "_strandline_path", None)
    if path:
        p = df.sparkSession._jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(p, True)


def with_package(spark: SparkSession) -> SparkSession:
    """The session, whose Python workers can import this package: Spark sends it to them as a zip file, once a context."""
    context = spark.sparkContext
    if not getattr(context, "_strandline_sent", False):
        top = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
        path = os.path.join(tempfile.mkdtemp(prefix="strandline-code-"), "strandline.zip")
        with zipfile.ZipFile(path, "w") as z:
            for folder, _, names in os.walk(top):
                for name in sorted(names):
                    if name.endswith(".py"):
                        full = os.path.join(folder, name)
                        z.write(full, os.path.relpath(full, os.path.dirname(top)))
        context.addPyFile(path)
        context._strandline_sent = True
    return spark
