"""File-system helpers through Hadoop's FileSystem API (works for local,
HDFS and object-store paths alike). Metadata operations only: listing,
existence, rename; data always moves through Spark readers and writers."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    return p.getFileSystem(conf), p, jvm


def exists(spark: SparkSession, path: str) -> bool:
    fs, p, _ = _fs(spark, path)
    return bool(fs.exists(p))


def list_files(spark: SparkSession, folder: str, recursive: bool = True) -> list[str]:
    """Paths of data files below ``folder`` (hidden and underscore files skipped)."""
    fs, p, _ = _fs(spark, folder)
    if not fs.exists(p):
        return []
    out = []
    it = fs.listFiles(p, recursive)
    while it.hasNext():
        st = it.next()
        name = st.getPath().getName()
        if not name.startswith((".", "_")):
            out.append(st.getPath().toString())
    return sorted(out)


def list_dirs(spark: SparkSession, folder: str) -> list[str]:
    fs, p, _ = _fs(spark, folder)
    if not fs.exists(p):
        return []
    return sorted(st.getPath().getName() for st in fs.listStatus(p) if st.isDirectory())


def qualify(spark: SparkSession, path: str) -> str:
    """The full path with its file system, as scans report paths."""
    fs, p, _ = _fs(spark, path)
    return fs.makeQualified(p).toString().rstrip("/")


def delete(spark: SparkSession, path: str) -> bool:
    """Remove a file or folder; whether there was one."""
    fs, p, _ = _fs(spark, path)
    return bool(fs.delete(p, True))


def first_line(spark: SparkSession, path: str, limit: int = 1 << 16) -> str:
    """The first line of a text file (at most ``limit`` bytes are read)."""
    fs, p, jvm = _fs(spark, path)
    stream = fs.open(p)
    try:
        reader = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(
            jvm.org.apache.commons.io.input.BoundedInputStream(stream, limit), "UTF-8"))
        return reader.readLine() or ""
    finally:
        stream.close()


def rename(spark: SparkSession, src: str, dst: str) -> None:
    fs, s, jvm = _fs(spark, src)
    d = jvm.org.apache.hadoop.fs.Path(dst)
    fs.mkdirs(d.getParent())
    if not fs.rename(s, d):
        raise OSError(f"rename failed: {src} -> {dst}")


def write_text(spark: SparkSession, path: str, text: str) -> None:
    fs, p, _ = _fs(spark, path)
    out = fs.create(p, True)
    try:
        out.write(bytearray(text.encode("utf-8")))
    finally:
        out.close()


def read_text(spark: SparkSession, path: str) -> str | None:
    fs, p, jvm = _fs(spark, path)
    if not fs.exists(p):
        return None
    stream = fs.open(p)
    try:
        return jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()
