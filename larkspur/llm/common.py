"""What the operators share: the shared folder, written tables, Arrow helpers."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from collections.abc import Callable, Iterable, Iterator
from urllib.parse import unquote, urlparse

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Text of a sub-batch in Python, in bytes.  Bounds the memory of a worker whatever
#: the size of an Arrow batch; a longer text is a sub-batch of its own.
SUB_BATCH_BYTES = 2_000_000


def shared_dir(spark: SparkSession) -> str:
    """The folder that the driver and all executors share: ``spark.checkpoint.dir``.

    Where the setting is absent a temporary folder is set in local mode (tests); on a
    cluster, whose machines wouldn't share it, that is an error.
    """
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all machines share")
        own = tempfile.mkdtemp(prefix="larkspur-")
        atexit.register(shutil.rmtree, own, ignore_errors=True)
        spark.sparkContext.setCheckpointDir(f"file://{own}")
        found = spark.sparkContext.getCheckpointDir()
    return found.rstrip("/")


def new_path(spark: SparkSession, name: str) -> str:
    """A fresh place below the shared folder."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str, partition_by: list[str] | None = None) -> DataFrame:
    """``df`` written as Parquet to the shared folder and read back: cuts the lineage."""
    path = new_path(df.sparkSession, name)
    out = df.write.option("compression", "zstd")
    (out.partitionBy(*partition_by) if partition_by else out).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def local_path(uri: str) -> str | None:
    """The path behind a ``file:`` URI or a plain path, else None."""
    u = urlparse(uri)
    return unquote(u.path) if u.scheme in ("", "file") else None


#: Ids that may be broadcast (8 bytes each, about 30 in the executors' hash map).
BROADCAST_IDS = 300_000


def without(df: DataFrame, ids: DataFrame, key: str) -> DataFrame:
    """``df`` without the rows whose ``key`` is among ``ids``; rows with a null key stay.

    The ids are written and counted; few are broadcast, so ``df`` stays where it is, and
    more are joined by shuffle.
    """
    ids = written(ids.where(F.col(key).isNotNull()).distinct(), "ids")
    return df.join(F.broadcast(ids) if ids.count() <= BROADCAST_IDS else ids, key, "left_anti").select(*df.columns)


#: Copies of the smaller side of a salted join, and so parts into which a hot key falls.
SALTS = 16


def salted_join(large: DataFrame, small: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """Join in which the rows of a key in ``large`` fall into ``SALTS`` parts."""
    salt = F.pmod(F.xxhash64(*(F.col(c) for c in large.columns)), F.lit(SALTS)).cast("int")
    copies = small.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return large.withColumn("_salt", salt).join(copies, [*keys, "_salt"], how).drop("_salt")


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def unused(name: str, columns: Iterable[str]) -> str:
    """``name``, with underscores before it until no column has it in either case."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def text_or_empty(column: str) -> Column:
    return F.coalesce(F.col(column), F.lit(""))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def sub_batches(batch: pa.RecordBatch, text: str, limit: int = SUB_BATCH_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of ``batch`` with about ``limit`` bytes of the text column each."""
    column = batch.column(text)
    lengths = pc.fill_null(pc.binary_length(column), 0).to_pylist()
    start, size = 0, 0
    for i, n in enumerate(lengths):
        if size and size + n > limit:
            yield batch.slice(start, i - start)
            start, size = i, 0
        size += n
    if start < batch.num_rows:
        yield batch.slice(start)


def per_text(function: Callable[[pa.RecordBatch], pa.RecordBatch], text: str) -> Callable:
    """A ``mapInArrow`` function that applies ``function`` to sub-batches."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in sub_batches(batch, text):
                yield function(part)

    return run
