"""Files and directories in whatever store Spark reaches, by Hadoop's file system interface."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _at(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _at(spark, path)
    return fs.exists(p)


def delete(spark: SparkSession, path: str) -> None:
    """Delete a file or a whole directory."""
    fs, p = _at(spark, path)
    fs.delete(p, True)


def glob(spark: SparkSession, pattern: str) -> list[str]:
    """Full paths that match, in order; none where the parent is missing."""
    fs, p = _at(spark, pattern)
    return sorted(s.getPath().toString() for s in (fs.globStatus(p) or []))


def move(spark: SparkSession, path: str, to: str) -> None:
    """Rename a file within its store; parents of ``to`` are made."""
    fs, p = _at(spark, path)
    target = _at(spark, to)[1]
    fs.mkdirs(target.getParent())
    if not fs.rename(p, target):
        raise OSError(f"cannot move {path} to {to}")


def touch(spark: SparkSession, path: str) -> None:
    """An empty file at ``path``, with its parents."""
    fs, p = _at(spark, path)
    fs.create(p, True).close()


def of_uri(spark: SparkSession, uri: str) -> str:
    """The path that ``_metadata.file_path`` names, which is a URI with escapes."""
    jvm = spark.sparkContext._jvm
    return jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(uri)).toString()


def has_data(spark: SparkSession, path: str) -> bool:
    """Whether the directory holds anything that readers of it see."""
    return any(not f.rsplit("/", 1)[1].startswith(("_", ".")) for f in glob(spark, f"{path}/*"))
