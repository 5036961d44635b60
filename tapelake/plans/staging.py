"""Cutting lineage: intermediate tables in the shared checkpoint folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

_test_folder: dict[str, str] = {}


def shared_folder(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``.

    A session without that setting gets a temporary folder, but only in local mode, where the driver's disk is the shared
    disk. On a cluster a machine-local folder would lose data with its machine, so the setting is required there.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
    app = spark.sparkContext.applicationId
    if app not in _test_folder:
        _test_folder[app] = tempfile.mkdtemp(prefix="tapelake-")
    return _test_folder[app]


def new_folder(spark: SparkSession, label: str) -> str:
    """A path below the shared folder that nothing else uses."""
    return f"{shared_folder(spark)}/tapelake/{label}-{uuid.uuid4().hex}"


def stage(df: DataFrame, label: str = "stage") -> DataFrame:
    """Write ``df`` as Parquet to the shared folder and read it back.

    The result survives lost executors, is computed once however often it is used, and can be read column by column.
    """
    spark = df.sparkSession
    path = new_folder(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def path_exists(spark: SparkSession, path: str) -> bool:
    """Is there a file or folder at ``path`` (which may hold wildcards), on whatever file system it names?"""
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    file_system = hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration())
    found = file_system.globStatus(hadoop_path)
    return found is not None and len(found) > 0


def existing_paths(spark: SparkSession, pattern: str) -> list[str]:
    """The files or folders that match a pattern."""
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(pattern)
    file_system = hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration())
    return sorted(status.getPath().toString() for status in file_system.globStatus(hadoop_path) or [])


def child_names(spark: SparkSession, path: str) -> list[str]:
    """Names of the entries right below ``path``; none if there is no such folder."""
    if not path_exists(spark, path):
        return []
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    file_system = hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration())
    return sorted(status.getPath().getName() for status in file_system.listStatus(hadoop_path))


def delete_folder(spark: SparkSession, path: str) -> None:
    """Remove a folder with all it holds, on whatever file system it is."""
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(hadoop_path, True)


def _file_system(spark: SparkSession, path: str):
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop_path


def file_lengths(spark: SparkSession, path: str) -> dict[str, int]:
    """The data files below a folder, by their path below it, with their lengths; hidden ones are left out."""
    if not path_exists(spark, path):
        return {}
    file_system, root = _file_system(spark, path)
    prefix = file_system.makeQualified(root).toString().rstrip("/") + "/"
    found, files = {}, file_system.listFiles(root, True)
    while files.hasNext():
        status = files.next()
        name = status.getPath().toString().removeprefix(prefix)
        if not any(part[0] in "_." for part in name.split("/")):
            found[name] = status.getLen()
    return found


def move_file(spark: SparkSession, source: str, target: str) -> None:
    """Rename a file; its folder must be there. A file that can't be moved is an error."""
    file_system, path = _file_system(spark, source)
    if not file_system.rename(path, spark._jvm.org.apache.hadoop.fs.Path(target)):
        raise OSError(f"{source} could not be moved to {target}")


def make_folder(spark: SparkSession, path: str) -> None:
    """Make a folder, and those above it, if it isn't there."""
    file_system, hadoop_path = _file_system(spark, path)
    if not file_system.mkdirs(hadoop_path):
        raise OSError(f"{path} could not be made")


def remove_file(spark: SparkSession, path: str) -> None:
    """Remove a file, if it is there."""
    file_system, hadoop_path = _file_system(spark, path)
    file_system.delete(hadoop_path, False)


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Write a small file that appears under its name only when it is whole."""
    file_system, hadoop_path = _file_system(spark, path)
    draft = spark._jvm.org.apache.hadoop.fs.Path(f"{path}.{uuid.uuid4().hex}.draft")
    out = file_system.create(draft)
    out.write(bytearray(text.encode()))
    out.close()
    file_system.delete(hadoop_path, False)
    if not file_system.rename(draft, hadoop_path):
        raise OSError(f"{path} could not be written")


def read_text(spark: SparkSession, path: str) -> str:
    """A small file as a text."""
    file_system, hadoop_path = _file_system(spark, path)
    stream = file_system.open(hadoop_path)
    try:
        return bytes(spark._jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode()
    finally:
        stream.close()


def read_or_empty(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A Parquet table, or no rows if nothing has been written there yet."""
    if path_exists(spark, path):
        return spark.read.schema(schema).parquet(path)
    return spark.createDataFrame([], schema)
