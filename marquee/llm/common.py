"""Helpers shared by the operators: shared scratch tables, text splitting and
Arrow plumbing."""

from __future__ import annotations

import contextlib
import contextvars
import gc
import tempfile
import uuid
import zipfile
from collections.abc import Callable, Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Byte table for bag-of-words features: ASCII letters and digits and all bytes
#: of other characters stay, ASCII punctuation becomes a blank.
WORD_BYTES = bytes(c if c >= 128 or chr(c).isalnum() else 32 for c in range(256))


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share, from ``spark.checkpoint.dir``.

    Only where the session names none (tests on one machine) a new temporary
    folder is set as the session's checkpoint folder."""
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        sc = spark.sparkContext
        if sc.getCheckpointDir() is None:
            sc.setCheckpointDir(tempfile.mkdtemp(prefix="marquee-llm-"))
        path = sc.getCheckpointDir()
    return path.rstrip("/")


def ship_code(spark: SparkSession) -> SparkSession:
    """Send this package to the executors, once per Spark context, as
    ``--py-files`` would: their Python workers import the operators from it."""
    sc = spark.sparkContext
    if not getattr(sc, "_marquee_shipped", False):
        package = Path(__file__).resolve().parent.parent
        archive = Path(tempfile.mkdtemp(prefix="marquee-code-")) / "marquee.zip"
        with zipfile.ZipFile(archive, "w") as z:
            for f in sorted(package.rglob("*.py")):
                z.write(f, str(Path(package.name) / f.relative_to(package)))
        sc.addPyFile(str(archive))
        sc._marquee_shipped = True
    return spark


#: Paths given out within the innermost ``scratch`` of this thread.
_scratch: contextvars.ContextVar[list[str] | None] = contextvars.ContextVar("scratch", default=None)


def fresh_path(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that no other run uses."""
    path = f"{shared_dir(spark)}/marquee-llm/{name}-{uuid.uuid4().hex}"
    made = _scratch.get()
    if made is not None:
        made.append(path)
    return path


def delete(spark: SparkSession, path: str) -> None:
    """Delete a folder of the store that its path names, if it is there."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


@contextlib.contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Deletes at its end the tables that were stored within it, for work whose
    result has been written elsewhere by then."""
    made: list[str] = []
    token = _scratch.set(made)
    try:
        yield
    finally:
        _scratch.reset(token)
        for path in made:
            delete(spark, path)


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared folder and return the written table.

    Cuts the lineage at a place that outlives lost executors; later reads prune
    columns, which a checkpoint would not."""
    path = fresh_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def spread(df: DataFrame) -> DataFrame:
    """Deal the rows of a small but costly table evenly to as many tasks as a
    shuffle has, as Spark reads small files in few."""
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))


@contextlib.contextmanager
def uncollected() -> Iterator[None]:
    """Without Python's cycle collector, which would walk through a worker's
    tables again and again while loops that make no cycles fill lists."""
    gc.disable()
    try:
        yield
    finally:
        gc.enable()


def over_batches(df: DataFrame, fn: Callable[[pa.RecordBatch], pa.RecordBatch], schema: str) -> DataFrame:
    """``fn`` on each Arrow batch of ``df``; one batch in memory at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with uncollected():
            for b in batches:
                if b.num_rows:
                    yield fn(b)

    return df.mapInArrow(run, schema)


def held_out(doc_id: Column | str) -> Column:
    """True for the rows kept from training: crc32 of the id as text, modulo 4,
    is 2. A null id counts as not held out."""
    c = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.coalesce(F.crc32(c.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def unit_hash(*cols: Column | str) -> Column:
    """A number in [0, 1) from the columns' values, the same in every run."""
    return (F.xxhash64(*cols).bitwiseAND(F.lit((1 << 52) - 1)).cast("double")) / float(1 << 52)


def bag_of_words(text: str | None) -> list[bytes]:
    """Lower-cased words without ASCII punctuation, as UTF-8."""
    return text.lower().encode("utf-8", "surrogatepass").translate(WORD_BYTES).split() if text else []


def utf8(text: str | None) -> bytes:
    return text.encode("utf-8", "surrogatepass") if text else b""
