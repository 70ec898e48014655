"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from tidemark.session import ensure_checkpoint_dir

#: Rows with this remainder of crc32(doc_id) are never learned from.
HELD_OUT_REMAINDER = 2


def table(spark: SparkSession, sf_dir: str, name: str, *cols: str) -> DataFrame:
    """Columns ``cols`` of one table."""
    ensure_checkpoint_dir(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet").select(*cols)


def held_out(doc_id: Column) -> Column:
    """Whether a row is held out: crc32 of the id as text leaves 2 when divided by 4; a null id is held out."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 4 == HELD_OUT_REMAINDER, F.lit(True))


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, limit: int) -> DataFrame:
    """(doc_id, text, y): at most ``limit`` labelled rows that are not held out, in hash order of the id.

    Only this fit is sampled, and ``limit`` bounds it; the sample's ids
    (16 bytes a row) are broadcast to the scan of the texts.
    """
    chosen = (labels.where(F.col(label).isNotNull() & ~held_out(F.col("doc_id")))
              .select(F.col("doc_id").alias("_id"), F.col(label).cast("int").alias("y"))
              .orderBy(F.xxhash64("_id"), "_id").limit(limit))
    return (docs.select("doc_id", "text").join(F.broadcast(chosen), F.col("doc_id") == F.col("_id"))
            .select("doc_id", F.coalesce("text", F.lit("")).alias("text"), "y"))


def words_of(text: str | None, lower: bool = True) -> list[bytes]:
    """Words ``[^\\x20\\x09-\\x0D]+`` as UTF-8; A-Z lower-cased on request. Null has none."""
    raw = (text or "").encode("utf-8", "surrogatepass")
    return (raw.lower() if lower else raw).split()


class WordHashes(dict):
    """64-bit hash of a word, kept for words seen before; emptied at ``limit`` entries."""

    def __init__(self, limit: int = 200_000):
        super().__init__()
        self.limit = limit

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.limit:
            self.clear()
        got = self[word] = xxhash.xxh3_64_intdigest(word)
        return got

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), dtype=np.uint64, count=len(words))


def mix(x: np.ndarray, seed: int) -> np.ndarray:
    """A bijective scramble of 64-bit values."""
    with np.errstate(over="ignore"):
        x = (x + np.uint64(seed)) * np.uint64(0x9E3779B97F4A7C15)
        x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
        return x ^ (x >> np.uint64(32))


def windows(hashes: np.ndarray, n: int) -> np.ndarray:
    """Hash of every ``n``-word window; with fewer words, of the whole sequence; none for no words."""
    if len(hashes) == 0:
        return np.empty(0, dtype=np.uint64)
    n = min(n, len(hashes))
    last = len(hashes) - n + 1
    out = np.full(last, np.uint64(n))
    with np.errstate(over="ignore"):
        for i in range(n):
            out *= np.uint64(0x9FB21C651E98DF25)
            out += hashes[i:last + i]
    return mix(out, 77)


#: Rows of an Arrow batch that are worked on together, which bounds what a task holds in Python.
ROWS = 512


def parts(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[pa.RecordBatch]:
    """The batches in slices of at most ``rows`` rows."""
    for b in batches:
        for at in range(0, b.num_rows, rows):
            yield b.slice(at, rows)


def add_columns(df: DataFrame, keep: list[str], start: Callable[[], Callable[[list[str]], dict]], added: str, rows: int = ROWS) -> DataFrame:
    """``keep`` columns of ``df`` as they are, and columns made from its texts in Arrow batches.

    ``start()`` runs once a task and returns a function from a list of texts
    (null: empty) to the new columns; ``added`` is their schema as DDL.
    """
    schema = T.StructType([df.schema[c] for c in keep] + T._parse_datatype_string(added).fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fn, types = start(), to_arrow_schema(schema)
        for b in parts(batches, rows):
            new = fn([x or "" for x in b.column("_text").to_pylist()])
            cols = [b.column(c) for c in keep] + [pa.array(new[f.name], type=f.type) for f in list(types)[len(keep):]]
            yield pa.RecordBatch.from_arrays(cols, names=schema.names)

    return df.select(*keep, F.col("text").alias("_text")).mapInArrow(run, schema)


def keep_rows(df: DataFrame, start: Callable[[], Callable[[list[str]], list]]) -> DataFrame:
    """Whole rows of ``df`` for whose text the function that ``start()`` makes in each task is true."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fn = start()
        for b in parts(batches, ROWS):
            yield b.filter(pa.array([bool(x) for x in fn([x or "" for x in b.column("text").to_pylist()])], type=pa.bool_()))

    return df.mapInArrow(run, df.schema)
