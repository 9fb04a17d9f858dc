"""Small helpers shared by the operators of this folder."""

from __future__ import annotations

import ctypes
import gc
import sys
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import StructType

from tessera.session import shared_path

#: Texts that a Python task holds at once, in UTF-8 bytes (one longer text is held alone).
SLICE_BYTES = 4 << 20
#: The Arrow batches that tasks send to Python and back, in bytes (a longer row goes alone).
BATCH_BYTES = 8 << 20
#: The keys that are broadcast as hot, at most.
HOT_KEYS = 10_000


def small_batches(spark: SparkSession) -> None:
    """Bound Arrow batches by ``BATCH_BYTES``: Spark's default is eight times as much for each of several copies."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scratch(spark: SparkSession, tag: str) -> str:
    """A new path in the cluster's shared folder."""
    return shared_path(spark, "llm", f"{tag}-{uuid.uuid4().hex}")


def written(df: DataFrame, tag: str) -> DataFrame:
    """``df`` written to the shared folder and read again: lineage ends here, and what an
    executor computed survives its loss."""
    path = scratch(df.sparkSession, tag)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def joined_back(rows: DataFrame, per_key: DataFrame, key: list[str], count: F.Column, total: int) -> DataFrame:
    """``rows`` joined with ``per_key``, which has a row for each of their keys. ``count``: its column with a key's number of rows;
    ``total``: at least the number of all rows. Spark can't split a hot key of a join with an aggregate, so the keys with more than
    a 10,000th of all rows, which are 10,000 at most, are broadcast, and their rows stay where they are."""
    much = max(1, total // HOT_KEYS)
    hot = per_key.where(count > much)
    rest = rows.join(F.broadcast(hot.select(*key)), key, "left_anti")
    return rows.join(F.broadcast(hot), key).unionByName(rest.join(per_key.where(count <= much), key))


def set_aside(docs: DataFrame, *own: str) -> tuple[DataFrame, dict[str, str]]:
    """``docs`` with all columns but ``own`` under reserved names, so that none is called like one that an operator
    adds, and the new name of each column."""
    known = {c.lower() for c in own}
    names = {c: c if c.lower() in known else f"__own_{i}" for i, c in enumerate(docs.columns)}
    return docs.toDF(*names.values()), names


def crc_of_id(column: str = "doc_id") -> F.Column:
    return F.crc32(F.col(column).cast("string").cast("binary"))


def give_back() -> None:
    """Return what earlier tasks of this Python worker freed: workers are used again, and share an executor's memory."""
    pa.set_memory_pool(pa.system_memory_pool())
    gc.collect()
    if sys.platform == "linux" and hasattr(libc := ctypes.CDLL(None), "malloc_trim"):
        libc.malloc_trim(0)


def tidy(run: Callable) -> Callable:
    """``run``, a function of batches for ``mapInArrow``, that gives memory back before it begins and once its own is free: a
    worker that waits for the next task keeps what it holds beside those that run."""

    def tidied(batches):
        give_back()
        try:
            yield from run(batches)
        finally:
            give_back()

    return tidied


def slices(batches: Iterator[pa.RecordBatch], column: str = "text") -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    """Cut Arrow batches so that each slice holds at most ``SLICE_BYTES`` of text (or one row);
    yields the slice and its texts as UTF-8 bytes (null: empty)."""
    for batch in batches:
        col = batch.column(batch.schema.get_field_index(column))
        sizes = np.asarray([0 if not v.is_valid else v.as_buffer().size for v in col], np.int64)
        lo = 0
        while lo < len(sizes):
            ends = np.cumsum(sizes[lo:])
            hi = lo + max(1, int(np.searchsorted(ends, SLICE_BYTES, side="right")))
            part = batch.slice(lo, hi - lo)
            yield part, [b"" if v is None else v for v in col.slice(lo, hi - lo).cast(pa.binary()).to_pylist()]
            lo = hi


def map_texts(df: DataFrame, fn: Callable[[list[bytes]], dict[str, list]], schema: str, text: str = "text") -> DataFrame:
    """Add to every row of ``df`` the columns that ``fn`` derives from the rows' texts.

    The text column itself is dropped. ``schema`` is the DDL of the added columns. Columns that
    are already called so are replaced."""
    added = StructType.fromDDL(schema)
    kinds = [(f.name, to_arrow_type(f.dataType)) for f in added]
    names = added.fieldNames()
    kept = [c for c in df.columns if c != text and c not in names]
    src = df.select(*[F.col(f"`{c}`") for c in kept], F.col(f"`{text}`").cast("string").alias("__text"))
    out = src.select(*[F.col(f"`{c}`") for c in kept]).schema
    for f in added:
        out = out.add(f)

    def run(batches):
        for part, texts in slices(batches, "__text"):
            got = fn(texts)
            cols = [part.column(i) for i in range(len(kept))]
            yield pa.RecordBatch.from_arrays(cols + [pa.array(got[n], type=t) for n, t in kinds], names=kept + names)

    return src.mapInArrow(tidy(run), out)


def keep_texts(df: DataFrame, fn: Callable[[list[bytes]], np.ndarray], text: str = "text") -> DataFrame:
    """The rows for whose texts ``fn`` says true, with all their columns."""

    def run(batches):
        for part, texts in slices(batches, text):
            yield part.filter(pa.array(np.asarray(fn(texts), bool)))

    return df.mapInArrow(tidy(run), df.schema)
