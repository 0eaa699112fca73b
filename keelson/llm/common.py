"""Helpers the training-data operators share."""

from __future__ import annotations

import ctypes
import gc
import sys
import time
import types
import uuid
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from keelson.session import checkpoint_dir

#: Words are maximal runs outside ASCII white space: what bytes.split() yields on UTF-8.
WORD_PATTERN = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def staged(df: DataFrame, tag: str) -> DataFrame:
    """Write df once below the shared folder and read it back: cuts lineage, survives lost executors."""
    path = f"{checkpoint_dir(df.sparkSession)}/keelson-{tag}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def unused(columns: list[str], name: str) -> str:
    """A column name that differs, in any case, from those given."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name += "_"
    return name


def expect_long_texts(spark: SparkSession) -> None:
    """Hand Python 1,000 rows at a time rather than 10,000, unless the session says otherwise.

    A batch is held by the JVM and by Python at once, so for texts of some KB the default takes most of the memory
    a small executor leaves for both.
    """
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if spark.conf.get(key) == "10000":
        spark.conf.set(key, "1000")


def release(spark: SparkSession) -> None:
    """Let the driver notice frames no longer referenced, so Spark deletes the shuffle files of finished jobs.

    Python hands its dropped references to the JVM in the background, and the JVM those of shuffles to Spark's
    cleaner; hence two rounds with a short wait each.
    """
    for _ in range(2):
        gc.collect()
        time.sleep(0.5)
        spark.sparkContext._jvm.System.gc()
        time.sleep(0.5)


def ids_tell_rows_apart(docs: DataFrame, id_col: str) -> bool:
    ids = docs.select(F.col(id_col).alias("id"))
    return ids.groupBy("id").count().filter((F.col("count") > 1) | F.col("id").isNull()).isEmpty()


def row_key(docs: DataFrame, id_col: str, text_col: str) -> Column:
    """A column that tells rows apart: the id where ids are unique, else a hash of id and text.

    Rows equal in both columns share a key; whatever is computed for the key holds for each of them.
    """
    if ids_tell_rows_apart(docs, id_col):
        return F.col(id_col).cast("long")
    return F.xxhash64(F.col(id_col), F.col(text_col))


def worker_cache(owner: str) -> dict:
    """A dict that lives as long as the Python process, which Spark reuses between tasks.

    It holds what one operator keeps between its tasks: another owner finds it empty, so nothing of a finished
    stage stays in memory.
    """
    module = sys.modules.setdefault("_keelson_worker_cache", types.ModuleType("_keelson_worker_cache"))
    if module.__dict__.get("owner") != owner:
        module.__dict__.update(owner=owner, entries={})
        gc.collect()
        pa.default_memory_pool().release_unused()
    return module.__dict__["entries"]


def give_back() -> None:
    """Return what this Python process has freed to the system."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc only; others keep less
    if trim:
        trim(0)


def tidy(run: Callable[[Iterable], Iterator]) -> Callable[[Iterable], Iterator]:
    """run, giving memory back after each task.

    Spark keeps more Python processes than tasks run at once and uses them in turn; without this each holds on to the
    most that any task of any stage took in it.
    """

    def to_the_end(batches: Iterable) -> Iterator:
        try:
            yield from run(batches)
        finally:
            give_back()

    return to_the_end


def text_chunks(
    batches: Iterable[pa.RecordBatch], columns: list[str], text: str, most_bytes: int
) -> Iterator[tuple[list, list[bytes]]]:
    """Rows in chunks of about most_bytes of text: ([values of columns per row], [UTF-8 text per row]); null: empty."""
    rows: list[tuple] = []
    texts: list[bytes] = []
    held = 0
    for batch in batches:
        others = [batch.column(batch.schema.get_field_index(c)).to_pylist() for c in columns]
        binary = batch.column(batch.schema.get_field_index(text)).cast(pa.binary())
        keys = zip(*others, strict=True) if others else [()] * batch.num_rows
        for key, cell in zip(keys, binary, strict=True):
            body = cell.as_py() or b""
            rows.append(key)
            texts.append(body)
            held += len(body)
            if held >= most_bytes:
                yield rows, texts
                rows, texts, held = [], [], 0
    if rows:
        yield rows, texts


def arrow_rows(columns: dict[str, list], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(columns[f.name], type=f.type) for f in schema], schema=schema)
