"""Helpers shared by the operators: table reading, shared scratch folders, expression binding."""

from __future__ import annotations

import os
import shutil
import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager, nullcontext

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: `[^\x20\x09-\x0D]+` is a word in every operator: these five become the sixth, a space.
WHITE = "\t\n\x0b\x0c\r"


ROW_GROUP = 32 << 20  # bytes that a writer holds
TEXT_ROWS = 512  # whole texts that a task holds at once, in the file reader and on the way to Python
BATCHES = ("spark.sql.execution.arrow.maxRecordsPerBatch", "spark.sql.parquet.columnarReaderBatchSize")

_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Hand the package to the executors, once a session, in case it isn't installed there."""
    app = spark.sparkContext.applicationId
    if app not in _SHIPPED:
        _SHIPPED.add(app)
        package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
        made = shutil.make_archive(os.path.join(tempfile.mkdtemp(prefix="ship-"), os.path.basename(package)), "zip",
                                   os.path.dirname(package), os.path.basename(package))
        spark.sparkContext.addPyFile(made)  # served by the driver


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """`body(value)` with `value` computed once, inside one expression."""
    return F.element_at(F.transform(F.array(value), body), 1)


def whole(text: Column) -> Column:
    """The text, null as empty."""
    return F.coalesce(text.cast("string"), F.lit(""))


def words(text: Column) -> Column:
    return F.array_remove(F.split(F.translate(text, WHITE, " " * len(WHITE)), " "), "")


def shared_dir(spark: SparkSession, label: str) -> str:
    """A new folder under spark.checkpoint.dir, which driver and executors share.

    Only a local master, where one machine is all there is, may go without that setting.
    """
    root = spark.sparkContext.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="llm-ckpt-")
        spark.sparkContext.setCheckpointDir(root)
    return f"{root.rstrip('/')}/{label}-{uuid.uuid4().hex}"


@contextmanager
def small_batches(spark: SparkSession, rows: int) -> Iterator[None]:
    """What runs inside moves batches of `rows` rows at most; the session's own settings hold again afterwards."""
    before = {k: spark.conf.get(k) for k in BATCHES}
    try:
        for k, v in before.items():
            spark.conf.set(k, min(rows, int(v)) if int(v) > 0 else rows)
        yield
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def stored(df: DataFrame, label: str, rows: int | None = None) -> DataFrame:
    """`df` written to the shared folder and read again: lineage ends there and survives lost executors.

    With `rows`, in batches of so many rows, for plans that hand whole texts on: a batch of Spark's
    10 000 texts is held by the reader, by the JVM's Arrow buffers and by the Python worker.
    """
    spark = df.sparkSession
    path = shared_dir(spark, label)
    with small_batches(spark, rows) if rows else nullcontext():
        df.write.option("parquet.block.size", ROW_GROUP).option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def drop_stored(spark: SparkSession, *frames: DataFrame) -> None:
    """Delete folders made by `stored`, once nothing reads them any more."""
    for df in frames:
        for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
            path = spark._jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
