"""Small helpers the training-data operators share."""

from __future__ import annotations

import sys
import time
import types
import uuid
from collections.abc import Iterator
from hashlib import blake2b
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starsift.session import bounded_batches, shared_folder

#: Characters that separate words, as a regular expression class body.
BLANKS = r"\x20\x09-\x0D"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def id_and_text(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Only the two columns an operator reads, under fixed names; other columns cannot clash."""
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))


def id_and_bytes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """As id_and_text, with the text as UTF-8 bytes for tasks in Python; null stays null."""
    bounded_batches(docs.sparkSession)
    return id_and_text(docs, id_col, text_col).select("doc_id", F.col("text").cast("binary").alias("text"))


def worker_memo(key: tuple, build):
    """What build() made for `key` in this Python worker: Spark reuses workers, so vocabularies and memos outlive a task.

    A worker keeps one at a time, so that the operators of a pipeline do not add up.
    """
    store = sys.modules.setdefault("starsift_worker_store", types.ModuleType("starsift_worker_store")).__dict__
    if store.get("key") != key:
        store.pop("memo", None)
        pa.default_memory_pool().release_unused()  # else freed batches of the earlier operator stay with the worker
        store["memo"] = build()
        store["key"] = key
    return store["memo"]


#: Rows of a batch that are turned into Python objects at once; a batch may hold long texts.
SLICE_ROWS = 64


def text_chunks(batches: Iterator[pa.RecordBatch], max_rows: int, max_bytes: int) -> Iterator[tuple[list, list]]:
    """(ids, byte texts) of a task in pieces of bounded rows and bytes; one longer text makes a piece of its own."""
    ids: list = []
    texts: list = []
    held = 0
    for batch in batches:
        for at in range(0, batch.num_rows, SLICE_ROWS):
            part = batch.slice(at, SLICE_ROWS)
            for doc_id, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True):
                size = len(text) if text else 0
                if ids and (len(ids) >= max_rows or held + size > max_bytes):
                    yield ids, texts
                    ids, texts, held = [], [], 0
                ids.append(doc_id)
                texts.append(text)
                held += size
    if ids:
        yield ids, texts


#: Ids that may be sent to every executor: about 8 MB.
BROADCAST_IDS = 1_000_000


def new_folder(spark: SparkSession) -> str:
    """An unused path in the folder that all executors share."""
    return f"{shared_folder(spark).rstrip('/')}/starsift-{uuid.uuid4().hex}"


#: Folders written in this process that nothing has released, and when shuffles were last let go.
_WRITTEN: list[str] = []
_LET_GO = [0.0]
#: Seconds between two times that shuffles are let go.
LET_GO_EVERY = 4.0


def stored(df: DataFrame) -> DataFrame:
    """The rows as written to Parquet in the shared folder: computed once, read by several later steps."""
    spark = df.sparkSession
    folder = new_folder(spark)
    df.write.parquet(folder)
    _WRITTEN.append(folder)
    if time.monotonic() - _LET_GO[0] > LET_GO_EVERY:
        # Spark deletes a shuffle's files once the driver's collector has found its plan unused, which may take very long
        spark.sparkContext._jvm.System.gc()
        _LET_GO[0] = time.monotonic()
    return spark.read.schema(df.schema).parquet(folder)


def release(spark: SparkSession, since: int, *results: DataFrame) -> None:
    """Deletes the folders written since `written()` gave that number, but for those that `results` read."""
    read = {f.rsplit("/", 2)[-2] for result in results for f in result.inputFiles()}
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    for folder in _WRITTEN[since:]:
        if folder.rsplit("/", 1)[-1] not in read:
            path = jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(conf).delete(path, True)
            _WRITTEN.remove(folder)


def written() -> int:
    return len(_WRITTEN)


def with_ids(rows: DataFrame, ids: DataFrame, key: str = "doc_id", how: str = "left_semi") -> DataFrame:
    """Rows whose key is among `ids` (or, with left_anti, is not); few ids go to the rows, many are joined by a shuffle."""
    few = ids.count() <= BROADCAST_IDS
    return rows.join(F.broadcast(ids) if few else ids, key, how)


def word_hash(word: bytes) -> int:
    return int.from_bytes(blake2b(word, digest_size=8).digest(), "little")


class WordHashes(dict):
    """Memo of 64-bit word hashes; a full memo is emptied, which costs time only."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= 250_000:
            self.clear()
        self[word] = h = word_hash(word)
        return h


def mixed(x: np.ndarray) -> np.ndarray:
    """Spreads every bit of 64-bit numbers over the others."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def hashed_words(lists: list[list[bytes]], memo: WordHashes) -> tuple[np.ndarray, np.ndarray]:
    """Word hashes of all lists in one array, and where each list begins (with the end of the last)."""
    begins = np.cumsum([0, *map(len, lists)])
    flat = np.fromiter(map(memo.__getitem__, chain.from_iterable(lists)), np.uint64, int(begins[-1]))
    return flat, begins
