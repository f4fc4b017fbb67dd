"""What the operators share: words, text columns, cut points in the shared folder."""

from __future__ import annotations

import contextlib
import contextvars
import pathlib
import tempfile
import uuid
import zipfile
from collections.abc import Iterable, Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A word is a run of characters other than the six ASCII white-space characters.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def text_of(column: str | Column = "text") -> Column:
    """The text; null is empty."""
    return F.coalesce(F.col(column) if isinstance(column, str) else column, F.lit(""))


def words_of(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(WORD), F.lit(0))


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors share: ``spark.checkpoint.dir``. A local session
    without that setting gets a folder of its own; a cluster must name one."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder.rstrip("/")
    if spark.sparkContext.master.split("[")[0] != "local":
        raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="spark-", dir="/tmp"))
    return spark.sparkContext.getCheckpointDir().rstrip("/")


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


#: Folders of the tables that ``cut`` writes inside the innermost ``tables_made``.
_MADE: contextvars.ContextVar[list[str] | None] = contextvars.ContextVar("made", default=None)


@contextlib.contextmanager
def tables_made() -> Iterator[list[str]]:
    """Collect the folders of all tables that ``cut`` writes inside."""
    made: list[str] = []
    token = _MADE.set(made)
    try:
        yield made
    finally:
        _MADE.reset(token)


def cut(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as a table in the shared folder and read that instead: a lost
    executor then costs a read, and what is read twice is the same twice."""
    spark = df.sparkSession
    path = new_path(spark, name)
    df.write.parquet(path)
    if (made := _MADE.get()) is not None:
        made.append(path)
    return spark.read.schema(df.schema).parquet(path)


def carried(kept: Iterable[str]) -> list[Column]:
    """The caller's columns under names that no operator uses; ``given_back`` undoes it."""
    return [F.col(f"`{c}`").alias(f"__kept_{i}") for i, c in enumerate(kept)]


def given_back(kept: Iterable[str]) -> list[Column]:
    return [F.col(f"__kept_{i}").alias(c) for i, c in enumerate(kept)]


def drop_tables(spark: SparkSession, frames: Iterable[DataFrame]) -> None:
    """Delete tables made by ``cut`` that nothing reads any more."""
    drop_folders(spark, {f.rsplit("/", 1)[0] for frame in frames for f in frame.inputFiles()})


def drop_folders(spark: SparkSession, folders: Iterable[str]) -> None:
    for folder in folders:
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Give Python workers this package, once an application, whatever their path is."""
    context = spark.sparkContext
    if context.applicationId in _SHIPPED:
        return
    package = pathlib.Path(__file__).resolve().parent.parent
    archive = pathlib.Path(tempfile.mkdtemp(prefix="spark-", dir="/tmp")) / f"{package.name}.zip"
    with zipfile.ZipFile(archive, "w") as file:
        for source in sorted(package.rglob("*.py")):
            file.write(source, source.relative_to(package.parent))
    context.addPyFile(str(archive))
    _SHIPPED.add(context.applicationId)


def let(value: Column, body) -> Column:
    """Evaluate ``value`` once and use it several times inside ``body``."""
    return F.transform(F.array(value), body)[0]
