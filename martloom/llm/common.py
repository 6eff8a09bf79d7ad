"""Helpers the corpus operators share: splits by id, staged tables, words as numpy arrays."""

from __future__ import annotations

import ctypes
import re
import sys
import tempfile
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.column import Column

# Texts handed to numpy at once; a single longer text makes a slice of its own.
SLICE_BYTES = 8 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def crc_mod(column: str | Column, parts: int) -> Column:
    """Remainder of crc32 over an id written as text; NULL ids count as remainder of the empty text."""
    col = F.col(column) if isinstance(column, str) else column
    return F.crc32(F.coalesce(col.cast("string"), F.lit(""))) % parts


def shared_folder(spark: SparkSession) -> str:
    """The folder ``spark.checkpoint.dir`` names; one of our own only in plain local mode."""
    sc = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if folder is None:
        if not re.fullmatch(r"local(\[[^\]]*\])?", sc.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        folder = tempfile.mkdtemp(prefix="martloom-shared-")
        sc.setCheckpointDir(folder)
    return folder


def staged(df: DataFrame, by: str | None = None, **options: str) -> DataFrame:
    """Write ``df`` as parquet to the shared folder, in a folder per value of ``by``, and read it back.

    Cuts the lineage like a checkpoint, but compressed and with column
    pruning on reading. The files go when the application ends.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/stage-{uuid.uuid4().hex}"
    (df.write if by is None else df.write.partitionBy(by)).options(**options).parquet(path)
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    jvm_path.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(jvm_path)
    return spark.read.schema(df.schema).parquet(path)


def release_memory() -> None:
    """Hand memory that is free back to the system; a worker lives on and would keep it beside the next stage's workers."""
    pa.default_memory_pool().release_unused()
    if sys.platform == "linux":
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # not in every C library
        if trim is not None:
            trim(0)


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string array and the offset of each text in them; NULL is empty."""
    texts = pc.fill_null(texts, "") if texts.null_count else texts
    if pa.types.is_large_string(texts.type) or pa.types.is_large_binary(texts.type):
        kind = np.int64
    else:
        kind = np.int32
    offsets = np.frombuffer(texts.buffers()[1], kind)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    data = texts.buffers()[2]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[offsets[0] : offsets[-1]], offsets - offsets[0]


def slices(batch: pa.RecordBatch, column: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batch in runs of rows whose texts add up to about ``limit`` bytes."""
    if not batch.num_rows:
        return
    _, offsets = text_bytes(batch.column(column))
    start = 0
    while start < batch.num_rows:
        end = int(np.searchsorted(offsets, offsets[start] + limit, side="right")) - 1
        end = min(max(end, start + 1), batch.num_rows)
        yield batch.slice(start, end - start)
        start = end


def map_texts(
    df: DataFrame, column: str, fn: Callable[[pa.RecordBatch], pa.RecordBatch], schema: str, limit: int = SLICE_BYTES
) -> DataFrame:
    """``fn`` over slices of the frame's Arrow batches; no shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, column, limit):
                yield fn(part)
        release_memory()

    return df.mapInArrow(run, schema)


def words_of(texts: pa.Array, lower: bool = True) -> tuple[np.ndarray, pa.Array]:
    """Words between ASCII white space, A-Z lower-cased, and each text's offset in them; NULL has none."""
    texts = pc.fill_null(texts, "") if texts.null_count else texts
    lists = pc.ascii_split_whitespace(pc.ascii_lower(texts) if lower else texts)
    offsets = lists.offsets.to_numpy().astype(np.int64)
    words = lists.values.slice(offsets[0], offsets[-1] - offsets[0])
    offsets = offsets - offsets[0]
    full = pc.greater(pc.binary_length(words), 0)
    if not pc.all(full).as_py() and len(words):
        mask = full.to_numpy(zero_copy_only=False)
        before = np.concatenate([[0], np.cumsum(mask)])
        words, offsets = words.filter(full), before[offsets]
    return offsets, words


def coded(words: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """Each word's place in the array of distinct words, and that array."""
    encoded = words.dictionary_encode()
    return encoded.indices.to_numpy(zero_copy_only=False).astype(np.int64), encoded.dictionary


def rows_of(offsets: np.ndarray) -> np.ndarray:
    """The row each element belongs to."""
    return np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))


def counts_by_row(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Sum of ``flags`` in each row."""
    total = np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])
    return total[offsets[1:]] - total[offsets[:-1]]


# A-Z lower-cased; everything but digits, letters and bytes beyond ASCII becomes a blank.
_PLAIN = np.array(
    [c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256)], np.uint8
)


def plain_words_of(texts: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """Like ``words_of``, for runs of letters, digits and characters beyond ASCII."""
    raw, offsets = text_bytes(texts)
    plain = pa.LargeStringArray.from_buffers(len(texts), pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(_PLAIN[raw]))
    return words_of(plain, lower=False)
