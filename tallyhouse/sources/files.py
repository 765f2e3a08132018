"""File-system facts through Spark's Hadoop client: any URI that Spark reads.

Metadata calls only (no job, no file contents); results are as many as the
paths or children asked for.
"""

from __future__ import annotations

from pyspark.sql import SparkSession


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def qualified(spark: SparkSession, path: str) -> str:
    """The path as a full URI, as readers report it."""
    fs, p = _fs(spark, path)
    return fs.makeQualified(p).toString()


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return fs.exists(p)


def has_data(spark: SparkSession, path: str) -> bool:
    """A file, or a folder with at least one data file (hidden names and commit
    markers do not count)."""
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return False
    if fs.getFileStatus(p).isFile():
        return True
    return any(s.isFile() and not s.getPath().getName().startswith(("_", ".")) for s in fs.listStatus(p))


def put_text(spark: SparkSession, path: str, text: str) -> None:
    """Create a small file, or replace it; it appears complete (by a rename)."""
    fs, p = _fs(spark, path)
    fs.mkdirs(p.getParent())
    jvm = spark.sparkContext._jvm
    draft = jvm.org.apache.hadoop.fs.Path(p.getParent(), f"_{p.getName()}.part")
    out = fs.create(draft, True)
    out.writeBytes(text)
    out.close()
    if fs.exists(p):
        fs.delete(p, False)
    if not fs.rename(draft, p):
        raise OSError(f"cannot rename {draft} to {p}")


def empty_files(spark: SparkSession, folder: str, suffix: str) -> list[str]:
    """Files of no bytes right under a folder; Spark's readers pass over these."""
    fs, p = _fs(spark, folder)
    if not fs.exists(p):
        return []
    return sorted(s.getPath().toString() for s in fs.listStatus(p)
                  if s.isFile() and s.getLen() == 0 and s.getPath().getName().endswith(suffix)
                  and not s.getPath().getName().startswith(("_", ".")))


def create_new(spark: SparkSession, path: str, text: str) -> bool:
    """Create a small file unless one of that name is there; of several callers
    one alone gets True.  On a local disk the file appears with its text (a hard
    link); elsewhere by the store's own create-if-absent."""
    from py4j.protocol import Py4JJavaError
    fs, p = _fs(spark, path)
    fs.mkdirs(p.getParent())
    jvm = spark.sparkContext._jvm
    try:
        if fs.getUri().getScheme() == "file":
            nio = jvm.java.nio.file
            final = nio.Paths.get(fs.makeQualified(p).toUri())
            draft = nio.Files.createTempFile(final.getParent(), "_draft", ".part",
                                             spark.sparkContext._gateway.new_array(nio.attribute.FileAttribute, 0))
            try:
                nio.Files.write(draft, text.encode(), spark.sparkContext._gateway.new_array(nio.OpenOption, 0))
                nio.Files.createLink(final, draft)
            finally:
                nio.Files.deleteIfExists(draft)
        else:
            out = fs.create(p, False)
            out.write(bytearray(text.encode()))
            out.close()
        return True
    except Py4JJavaError as e:
        if "AlreadyExists" in e.java_exception.getClass().getName():
            return False
        raise


def read_text(spark: SparkSession, path: str) -> str | None:
    """The text of a small file; None if there is none."""
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return None
    stream = fs.open(p)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def children(spark: SparkSession, folder: str) -> list[str]:
    """Names right under a folder, in order; none if there is no folder."""
    fs, p = _fs(spark, folder)
    return sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else []


def rename(spark: SparkSession, src: str, dst: str) -> None:
    """Rename a file or folder; ``dst`` must not be there, its parent is made."""
    fs, a = _fs(spark, src)
    _, b = _fs(spark, dst)
    fs.mkdirs(b.getParent())
    if fs.exists(b) or not fs.rename(a, b):
        raise OSError(f"cannot rename {src} to {dst}")


def delete(spark: SparkSession, path: str) -> None:
    fs, p = _fs(spark, path)
    fs.delete(p, True)


def newest(spark: SparkSession, folder: str) -> int:
    """Latest modification time (ms) of the data files right under a folder; 0 without any."""
    fs, p = _fs(spark, folder)
    if not fs.exists(p):
        return 0
    return max((s.getModificationTime() for s in fs.listStatus(p)
                if s.isFile() and not s.getPath().getName().startswith(("_", "."))), default=0)


def partitions(spark: SparkSession, base: str, columns: list[str]) -> list[dict]:
    """Partition folders ``column=value/...`` under ``base``, from their names alone."""
    if not columns:
        return [{}]
    found = [n.split("=", 1)[1] for n in children(spark, base) if n.startswith(f"{columns[0]}=")]
    return [{columns[0]: v} | rest for v in found
            for rest in partitions(spark, f"{base.rstrip('/')}/{columns[0]}={v}", columns[1:])]
