"""Token ids in blocks: one concatenated id array with Elias-Fano document boundaries."""

from __future__ import annotations

import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from starsift.llm.bpe import Vocabulary, run_words
from starsift.llm.common import id_and_bytes, text_chunks, worker_memo

#: Ids in a block; a longer document makes a block of its own.
BLOCK_IDS = 1 << 20
#: Every so many ones the select index has a sample.
SELECT_STEP = 64
#: Place of the k-th one in each byte.
PLACES = np.array([([b for b in range(8) if v >> b & 1] + [0] * 8)[:8] for v in range(256)], np.uint8)
#: Documents whose boundaries are selected at once.
SELECTED = 4096
#: Remembered strings in a worker; a full memo is emptied, which costs time only.
MEMO = 600_000

BLOCK_SCHEMA = (
    "part int, seq int, n_docs int, n_null int, first_id long, n_ids long, start_in_part long, "
    "ids binary, ends binary, doc_ids binary"
)


class EliasFano:
    """A non-decreasing list of numbers from 0 in about 2 + log2(universe / n) bits each.

    Low bits are packed; high parts are a bit vector with a one for each number, found by select samples.
    """

    def __init__(self, n: int, low_bits: int, low: np.ndarray, high: np.ndarray, samples: np.ndarray):
        self.n, self.low_bits, self.low, self.high, self.samples = n, low_bits, low, high, samples

    @staticmethod
    def encode(values: np.ndarray) -> EliasFano:
        values = np.asarray(values, np.uint64)
        n = len(values)
        top = int(values[-1]) if n else 0
        low_bits = max(0, (top // n).bit_length() - 1) if n else 0
        highs = (values >> np.uint64(low_bits)).astype(np.int64)
        ones = highs + np.arange(n)
        bits = np.zeros(int(ones[-1]) + 1 if n else 0, np.uint8)
        bits[ones] = 1
        lows = ((values[:, None] >> np.arange(low_bits, dtype=np.uint64)) & np.uint64(1)).astype(np.uint8)
        return EliasFano(
            n, low_bits, np.packbits(lows.ravel(), bitorder="little"), np.packbits(bits, bitorder="little"),
            ones[::SELECT_STEP].astype(np.uint32),
        )

    def to_bytes(self) -> bytes:
        sizes = np.array([self.n, self.low_bits, len(self.low), len(self.high), len(self.samples)], np.uint32)
        return sizes.tobytes() + self.samples.tobytes() + self.low.tobytes() + self.high.tobytes()

    @staticmethod
    def from_bytes(content: bytes) -> EliasFano:
        n, low_bits, low, high, samples = np.frombuffer(content, np.uint32, 5).tolist()
        at = 20 + 4 * samples
        return EliasFano(
            n, low_bits, np.frombuffer(content, np.uint8, low, at), np.frombuffer(content, np.uint8, high, at + low),
            np.frombuffer(content, np.uint32, samples, 20),
        )

    def select(self, i: int) -> int:
        """The i-th number: from the nearest sample on, count ones byte by byte."""
        at = int(self.samples[i // SELECT_STEP])
        wanted = i % SELECT_STEP
        byte = at >> 3
        ones = np.unpackbits(self.high[byte : byte + 1], bitorder="little")
        ones[: at & 7] = 0
        while (have := int(ones.sum())) <= wanted:
            wanted -= have
            byte += 1
            ones = np.unpackbits(self.high[byte : byte + 1], bitorder="little")
        high = (byte << 3) + int(np.flatnonzero(ones)[wanted]) - i
        low = 0
        for b in range(self.low_bits):
            bit = i * self.low_bits + b
            low |= int(self.low[bit >> 3] >> (bit & 7) & 1) << b
        return high << self.low_bits | low

    def select_many(self, i: np.ndarray) -> np.ndarray:
        """As select, for many places at once; a place moves on byte by byte until its one is reached."""
        i = np.asarray(i, np.int64)
        at = self.samples[i // SELECT_STEP].astype(np.int64)
        wanted, byte = i % SELECT_STEP, at >> 3
        value = self.high[byte] & (0xFF << (at & 7)).astype(np.uint8)
        have = np.bitwise_count(value).astype(np.int64)
        behind = np.flatnonzero(have <= wanted)
        while len(behind):
            wanted[behind] -= have[behind]
            byte[behind] += 1
            value[behind] = self.high[byte[behind]]
            have[behind] = np.bitwise_count(value[behind])
            behind = behind[have[behind] <= wanted[behind]]
        out = ((byte << 3) + PLACES[value, wanted] - i).astype(np.uint64) << np.uint64(self.low_bits)
        first = i * self.low_bits
        for b in range(self.low_bits):
            bit = first + b
            out |= ((self.low[bit >> 3] >> (bit & 7).astype(np.uint8)) & np.uint8(1)).astype(np.uint64) << np.uint64(b)
        return out

    def decode(self) -> np.ndarray:
        """All numbers at once."""
        ones = np.flatnonzero(np.unpackbits(self.high, bitorder="little"))[: self.n]
        values = (ones - np.arange(self.n)).astype(np.uint64) << np.uint64(self.low_bits)
        if self.low_bits:
            bits = np.unpackbits(self.low, bitorder="little")[: self.n * self.low_bits].reshape(self.n, self.low_bits)
            values += (bits.astype(np.uint64) << np.arange(self.low_bits, dtype=np.uint64)).sum(axis=1, dtype=np.uint64)
        return values


class LibraryRuns(dict):
    """Memo from a run without blanks to its ids as bytes; the library's model merges words new to the worker."""

    def __init__(self, tokenizer_path: str, width: str):
        from tokenizers import Tokenizer

        super().__init__()
        self.library = Tokenizer.from_file(tokenizer_path)
        self.vocabulary = Vocabulary(tokenizer_path)
        self.width = width
        self.code = "H" if width == "<u2" else "I"
        self.words: dict[str, bytes] = {}

    def word(self, word: str) -> bytes:
        out = self.words.get(word)
        if out is None:
            alphabet = self.vocabulary.alphabet
            spelled = "".join([alphabet[b] for b in word.encode()])
            out = array(self.code, [t.id for t in self.library.model.tokenize(spelled)]).tobytes()
            if len(self.words) >= MEMO:
                self.words.clear()
            self.words[word] = out
        return out

    def __missing__(self, run: bytes):
        out = b"".join([self.word(w) for w in run_words(run)])
        if len(self) >= MEMO:
            self.clear()
        self[run] = out
        return out

    def text(self, text: bytes, specials: tuple[bytes, ...]) -> bytes:
        if any(s in text for s in specials):
            ids = self.library.encode(text.decode(), add_special_tokens=False).ids
            return np.array(ids, self.width).tobytes()
        return b"".join(map(self.__getitem__, text.split()))


def id_width(tokenizer_path: str) -> str:
    """Two bytes for an id where every id fits, else four."""
    vocabulary = Vocabulary(tokenizer_path)
    return "<u2" if max(*vocabulary.ids.values(), *vocabulary.special.values()) < 1 << 16 else "<u4"


def token_blocks(
    docs: DataFrame, tokenizer_path: str, end_id: int, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Blocks of consecutive documents in ascending doc_id order, nulls first, then by text.

    Rows are range-partitioned and sorted by Spark; a task writes its documents into blocks of about BLOCK_IDS ids, so
    it holds one block. `part` counts the ranges, `seq` the blocks of a range; `ends` and `doc_ids` are Elias-Fano lists.
    Null and empty texts hold the end id only.
    """
    width = id_width(tokenizer_path)
    sized = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = id_and_bytes(docs, id_col, text_col).repartitionByRange(sized, "doc_id").sortWithinPartitions("doc_id", "text")

    def run(batches: Iterator[pa.RecordBatch]):
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        runs = worker_memo(("library runs", tokenizer_path), lambda: LibraryRuns(tokenizer_path, width))
        specials = tuple(s.encode() for s in runs.vocabulary.special)
        end = np.array([end_id], width).tobytes()
        size = len(end)
        seq, before = 0, 0
        held_ids: list = []
        held: list[bytes] = []
        filled = 0

        def block():
            lengths = np.array([len(h) // size for h in held], np.int64)
            known = np.array([i for i in held_ids if i is not None], np.int64)
            first = int(known[0]) if len(known) else 0
            columns = (
                part, seq, len(held), len(held) - len(known), first, int(lengths.sum()), before, b"".join(held),
                EliasFano.encode(np.cumsum(lengths)).to_bytes(),
                EliasFano.encode((known.view(np.uint64) - np.int64(first).view(np.uint64))).to_bytes(),
            )
            kinds = [pa.int32()] * 4 + [pa.int64()] * 3 + [pa.binary()] * 3
            names = [c.split()[0] for c in BLOCK_SCHEMA.split(", ")]
            return pa.RecordBatch.from_arrays([pa.array([c], k) for c, k in zip(columns, kinds, strict=True)], names=names)

        for ids, texts in text_chunks(batches, 2_000, 16 << 20):
            for doc_id, text in zip(ids, texts, strict=True):
                coded = (runs.text(text, specials) if text else b"") + end
                if held and filled + len(coded) > BLOCK_IDS * size:
                    yield block()
                    before += filled // size
                    seq, held_ids, held, filled = seq + 1, [], [], 0
                held_ids.append(doc_id)
                held.append(coded)
                filled += len(coded)
        if held:
            yield block()

    return rows.mapInArrow(run, BLOCK_SCHEMA)


def write_blocks(blocks: DataFrame, folder: str) -> None:
    """Parquet rows hold the blocks, so Spark's commit protects them and any store will do."""
    blocks.write.mode("overwrite").parquet(folder)


def documents_of(row: dict, width: str):
    """Documents of a block, in slices whose boundaries and ids are selected; neither list is expanded whole."""
    ends_of, known_of = EliasFano.from_bytes(row["ends"]), EliasFano.from_bytes(row["doc_ids"])
    ids = np.frombuffer(row["ids"], width)
    before, nameless = 0, row["n_null"]
    for at in range(0, ends_of.n, SELECTED):
        place = np.arange(at, min(at + SELECTED, ends_of.n))
        ends = ends_of.select_many(place).astype(np.int64)
        starts = np.concatenate([[before], ends[:-1]])
        before = int(ends[-1])
        known = known_of.select_many(place[place >= nameless] - nameless).view(np.int64) + row["first_id"]
        crc = [zlib.crc32(ids[a:b].astype("<u4").tobytes()) for a, b in zip(starts, ends, strict=True)]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([None] * int((place < nameless).sum()) + known.tolist(), pa.int64()),
                pa.array(starts + row["part_start"] + row["start_in_part"], pa.int64()),
                pa.array(ends - starts, pa.int64()),
                pa.array(crc, pa.int64()),
            ],
            names=["doc_id", "start", "n_tokens", "ids_crc32"],
        )


def read_documents(blocks: DataFrame, width: str) -> DataFrame:
    """doc_id, start (ids of all documents before it), n_tokens and ids_crc32 from written blocks.

    Ranges hold at most one row each in the running total; within a range the writer has counted.
    """
    totals = blocks.groupBy("part").agg(F.sum("n_ids").alias("n"))
    in_order = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = totals.select("part", F.coalesce(F.sum("n").over(in_order), F.lit(0).cast("long")).alias("part_start"))
    placed = blocks.join(F.broadcast(starts), "part")

    def run(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                yield from documents_of(batch.slice(i, 1).to_pylist()[0], width)

    return placed.mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long")


def store_tokens(
    docs: DataFrame, tokenizer_path: str, end_id: int, folder: str, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Writes `docs` as blocks to `folder` and returns what is read back from them.

    Null ids come first, repeated ids keep one entry per row, ordered by text; an empty table gives no blocks and no
    rows; other columns are not read.
    """
    write_blocks(token_blocks(docs, tokenizer_path, end_id, id_col, text_col), folder)
    return read_documents(docs.sparkSession.read.schema(BLOCK_SCHEMA).parquet(folder), id_width(tokenizer_path))
