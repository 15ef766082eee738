"""Shared folder for tables a job writes on its way."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession

_SETTING = "spark.checkpoint.dir"
_WAREHOUSE = "spark.sql.warehouse.dir"


def shared_root(spark: SparkSession) -> str:
    """The folder named in ``spark.checkpoint.dir``, else one in the warehouse; the same rule for every master."""
    root = spark.conf.get(_SETTING, None) or spark.sparkContext.getConf().get(_SETTING)
    if root:
        return root.rstrip("/")
    return f"{spark.conf.get(_WAREHOUSE).rstrip('/')}/_shared"


def fresh_dir(spark: SparkSession, name: str) -> str:
    """A new, not yet existing folder in the shared folder."""
    return f"{shared_root(spark)}/noticelake/{name}-{uuid.uuid4().hex[:12]}"


@contextmanager
def scratch(spark: SparkSession, name: str) -> Iterator[str]:
    """A folder for a job's own use, removed when the block ends: nothing lazy may read it afterwards."""
    path = fresh_dir(spark, name)
    try:
        yield path
    finally:
        drop_path(spark, path)


def path_exists(spark: SparkSession, path: str) -> bool:
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hadoop_path)


def child_names(spark: SparkSession, path: str) -> list[str]:
    """Names of what lies in a folder; none if there is no such folder."""
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration())
    return [f.getPath().getName() for f in system.listStatus(hadoop_path)] if system.exists(hadoop_path) else []


def read_text(spark: SparkSession, path: str) -> str:
    """A small file, whole."""
    return spark.read.text(path, wholetext=True).first()[0]


def create_exclusively(spark: SparkSession, path: str, text: str) -> bool:
    """Write a small file that nobody else has; False if it is there already. It appears whole: it is written under
    another name and renamed, which does not replace a file."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    target, draft = (jvm.org.apache.hadoop.fs.Path(p) for p in (path, f"{path}.{uuid.uuid4().hex}"))
    system = target.getFileSystem(conf)
    out = system.create(draft, False)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()
    plain = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0)
    try:
        jvm.org.apache.hadoop.fs.FileContext.getFileContext(system.getUri(), conf).rename(draft, target, plain)
    except Py4JJavaError as failure:
        system.delete(draft, False)
        if failure.java_exception.getClass().getSimpleName() == "FileAlreadyExistsException":
            return False
        raise
    return True


def move_path(spark: SparkSession, source: str, target: str) -> None:
    """Put a folder in the place of another one (or of none); both are in the same store."""
    source_path, target_path = (spark._jvm.org.apache.hadoop.fs.Path(p) for p in (source, target))
    system = target_path.getFileSystem(spark._jsc.hadoopConfiguration())
    system.delete(target_path, True)
    if not (system.mkdirs(target_path.getParent()) and system.rename(source_path, target_path)):
        raise OSError(f"{source} could not be moved to {target}")


def drop_path(spark: SparkSession, path: str) -> None:
    """Remove a folder a job has written for itself."""
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(hadoop_path, True)
