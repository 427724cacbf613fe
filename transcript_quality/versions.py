"""Tables and models that are replaced as a whole: immutable version folders and a pointer that names the current one.

``root/versions/<name>`` holds a version and is never written again; ``root/pointers/<number>`` names a target.  A new pointer is
written under another name and appears in one rename that fails if its number is taken, so readers see the old target or the new
one, never a half-written table: a write that is stopped half-way leaves a folder that nothing names, and of two
writers at once only one gets a number.  A reader that resolved the pointer before keeps its folder until :func:`drop_old`.

Defined results: a root without pointers resolves to None, and the readers then read the root itself (a table written by other
means)."""

from __future__ import annotations

import time
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession


class Conflict(RuntimeError):
    """The root was replaced by another writer in the meantime."""


def _hadoop(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return jvm, p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def _numbers(spark: SparkSession, root: str) -> list[int]:
    """Numbers of the pointers, ascending."""
    _, p, fs = _hadoop(spark, f"{root.rstrip('/')}/pointers")
    if not fs.exists(p):
        return []
    names = (st.getPath().getName() for st in fs.listStatus(p))
    return sorted(int(n) for n in names if n.isdigit())


def _target(spark: SparkSession, root: str, number: int) -> str:
    _, p, fs = _hadoop(spark, f"{root.rstrip('/')}/pointers/{number:012d}")
    with_lines = fs.open(p)
    try:
        name = bytes(with_lines.readAllBytes()).decode()
    finally:
        with_lines.close()
    return name if "/" in name else f"{root.rstrip('/')}/versions/{name}"


def current_number(spark: SparkSession, root: str) -> int:
    """The number of the current pointer, 0 if there is none."""
    return max(_numbers(spark, root), default=0)


def resolve(spark: SparkSession, root: str, back: int = 0) -> str | None:
    """The folder that the newest pointer names, or the one ``back`` pointers before it; None if there is none."""
    found = _numbers(spark, root)
    return _target(spark, root, found[-1 - back]) if len(found) > back else None


def point(spark: SparkSession, root: str, target: str, based_on: int | None = None) -> int:
    """Make ``target`` (a version's name, or any folder) current and return the pointer's number.  With ``based_on`` the pointer must follow
    that number, else :class:`Conflict`; without it the last writer wins."""
    root = root.rstrip("/")
    jvm, folder, fs = _hadoop(spark, f"{root}/pointers")
    fs.mkdirs(folder)
    side = jvm.org.apache.hadoop.fs.Path(folder, f"_{uuid.uuid4().hex}")
    out = fs.create(side, True)
    out.write(bytearray(target.encode()))
    out.close()
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.makeQualified(folder).toUri(), spark.sparkContext._jsc.hadoopConfiguration())
    plain = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
    plain[0] = jvm.org.apache.hadoop.fs.Options.Rename.NONE
    while True:
        number = (current_number(spark, root) if based_on is None else based_on) + 1
        try:
            if based_on is not None and current_number(spark, root) != based_on:
                raise Conflict(f"{root} was replaced after version {based_on}")
            context.rename(side, jvm.org.apache.hadoop.fs.Path(folder, f"{number:012d}"), plain)
            return number
        except Py4JJavaError as e:
            if "FileAlreadyExists" not in str(e.java_exception.getClass().getName()):
                raise
            if based_on is not None:
                raise Conflict(f"{root} was replaced after version {based_on}") from e
        finally:
            if based_on is not None and fs.exists(side):
                fs.delete(side, False)


def publish(df: DataFrame, root: str, fmt: str = "parquet", based_on: int | None = None, partition_by: str | None = None, **options) -> str:
    """Write ``df`` as a new version of ``root`` and make it current; returns its folder.  ``df`` may be read from an older version."""
    spark, name = df.sparkSession, f"v{uuid.uuid4().hex}"
    writer = df.write.format(fmt).options(**options)
    folder = f"{root.rstrip('/')}/versions/{name}"
    (writer.partitionBy(partition_by) if partition_by else writer).save(folder)
    point(spark, root, name, based_on)
    return folder


def drop_old(spark: SparkSession, root: str, keep: int = 2, older_than: float = 86_400.0) -> int:
    """Remove all pointers but the newest ``keep``, then the version folders no pointer names that are older than ``older_than`` seconds (younger
    ones may be in the writing, or in a reader's hands).  Returns the number of folders removed."""
    root = root.rstrip("/")
    found = _numbers(spark, root)
    for number in found[:-keep] if keep else found:
        _, p, fs = _hadoop(spark, f"{root}/pointers/{number:012d}")
        fs.delete(p, False)
    named = {_target(spark, root, n).rsplit("/", 1)[-1] for n in _numbers(spark, root)}
    _, p, fs = _hadoop(spark, f"{root}/versions")
    gone = 0
    for st in fs.listStatus(p) if fs.exists(p) else []:
        if st.getPath().getName() not in named and time.time() - st.getModificationTime() / 1000 >= older_than:
            fs.delete(st.getPath(), True)
            gone += 1
    return gone
