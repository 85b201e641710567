"""What the operators of this subpackage share: words, shared folders, groups of documents."""

from __future__ import annotations

import atexit
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A word: a longest run without the six ASCII white-space characters.
WORD = r"[^\x20\x09-\x0D]+"

_LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")


def utf8(text: str | None) -> bytes:
    """The UTF-8 bytes of a text; none for null."""
    return b"" if text is None else text.encode("utf-8", "surrogatepass")


def words(text: str | None) -> list[bytes]:
    """All words of a text, as UTF-8 bytes.

    ``bytes.split`` parts at exactly the six characters that WORD leaves out, and no byte of a longer UTF-8
    sequence is among them.
    """
    return utf8(text).split()


def lower_words(text: str | None) -> list[bytes]:
    """Like ``words``, with A-Z (only) in lower case."""
    return utf8(text).translate(_LOWER).split()


def whole_text(text: str | Column = "text") -> Column:
    return F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))


def n_words(text: str | Column = "text") -> Column:
    """The number of words of a text, inside the JVM; 0 for null."""
    return F.regexp_count(whole_text(text), F.lit(WORD)).cast("long")


def shared_dir(spark: SparkSession) -> str:
    """The folder that the driver and all executors share: spark.checkpoint.dir.

    Only where it is unset and Spark runs in one local process, a temporary folder takes its place.
    """
    sc = spark.sparkContext
    base = sc.getConf().get("spark.checkpoint.dir") or sc.getCheckpointDir()
    if not base:
        if not sc.master.startswith("local[") and sc.master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = tempfile.mkdtemp(prefix="marlstone-")
        sc.setCheckpointDir(base)
    return base.rstrip("/")


#: Folders of this process that are still there.
_live: dict[str, None] = {}


def scratch(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder; it goes with released() around it, or when the session's process ends."""
    path = f"{shared_dir(spark)}/scratch-{uuid.uuid4().hex}/{name}"
    _live[path.rpartition("/")[0]] = None
    atexit.register(_remove, spark, path.rpartition("/")[0])
    return path


@contextmanager
def released(spark: SparkSession) -> Iterator[None]:
    """At the end, all that was put into new scratch folders meanwhile is deleted: for work whose result is written elsewhere."""
    before = set(_live)
    try:
        yield
    finally:
        for path in [p for p in _live if p not in before]:
            release(spark, path)


def release(spark: SparkSession, path: str) -> None:
    """Delete a scratch folder, or the folder of a scratch path."""
    folder = path if path in _live else path.rpartition("/")[0]
    if _live.pop(folder, 0) is None:
        _remove(spark, folder)


def _remove(spark: SparkSession, path: str) -> None:
    try:
        fs, p = hadoop(spark, path)
        fs.delete(p, True)
    except Exception:  # noqa: BLE001  the JVM may have ended before
        pass


def hadoop(spark: SparkSession, path: str):
    """The file system of a path, and the path, as Hadoop's objects."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def stored(df: DataFrame, name: str, path: str | None = None) -> DataFrame:
    """Write a DataFrame to the shared folder and read it back: lineage ends here, lost executors don't matter."""
    spark = df.sparkSession
    path = path or scratch(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def fresh(name: str, taken: list[str]) -> str:
    """A column name that clashes with none of those taken, letter case aside."""
    low = {x.lower() for x in taken}
    while name.lower() in low:
        name = f"_{name}"
    return name


def rows_of(batches: Iterator, *names: str) -> Iterator[tuple]:
    """The rows of Arrow batches as tuples of the named columns."""
    for batch in batches:
        yield from zip(*(batch.column(n).to_pylist() for n in names), strict=True)
