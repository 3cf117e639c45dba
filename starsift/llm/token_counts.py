"""Token counts by byte-pair merging, without identifiers."""

from __future__ import annotations

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starsift.llm.bpe import BYTE_LEVEL_PATTERN, Vocabulary, merge_pairs
from starsift.llm.common import id_and_bytes, text_chunks, worker_memo

#: Remembered strings in a worker; a full memo is emptied, which costs time only.
MEMO = 800_000


class PairCounter(dict):
    """Memo of token counts for runs of text between single spaces; `spaced` runs have the space before them.

    A run that is empty or has white space at an end counts as None: there the split of the whole text
    depends on the neighbours.
    """

    def __init__(self, vocabulary: Vocabulary, spaced: bool):
        super().__init__()
        self.vocabulary = vocabulary
        self.spaced = spaced
        self.pattern = regex.compile(BYTE_LEVEL_PATTERN)
        self.pieces: dict[str, int] = {}

    def count_piece(self, piece: str) -> int:
        """Initial symbols minus merges of one piece."""
        n = self.pieces.get(piece)
        if n is None:
            n = len(merge_pairs(self.vocabulary.symbols(piece), self.vocabulary.ranks))
            if len(self.pieces) >= MEMO:
                self.pieces.clear()
            self.pieces[piece] = n
        return n

    def count_pieces(self, text: str) -> int:
        return sum(map(self.count_piece, self.pattern.findall(text)))

    def __missing__(self, run: str):
        space = " " if self.spaced else ""
        if not run or run[0].isspace() or run[-1].isspace():
            n = None
        elif run.isascii() and run.isalpha():  # plain letters, with or without a stop, need no pattern
            n = self.count_piece(space + run)
        elif run[-1] in ".," and run.isascii() and run[:-1].isalpha():
            n = self.count_piece(space + run[:-1]) + 1
        else:
            n = self.count_pieces(space + run)
        if len(self) >= MEMO:
            self.clear()
        self[run] = n
        return n


def count_text(text: str, first: PairCounter, rest: PairCounter) -> int:
    """Tokens of one text; a special string of the vocabulary inside it is one token."""
    total = 0
    for segment, special in first.vocabulary.segments(text):
        if special is not None:
            total += 1
        elif segment:
            head, *tail = segment.split(" ")
            try:
                total += first[head] + sum(map(rest.__getitem__, tail))
            except TypeError:  # white space in a row or at an end
                total += first.count_pieces(segment)
    return total


def count_tokens(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_bytes and n_tokens of every row, by the byte-level vocabulary at `tokenizer_path`.

    One pass without a shuffle. Every occurrence of a word costs a memo look-up; a word new to the worker is merged
    with a heap over a linked list. Null and empty texts have 0 bytes and 0 tokens, repeated rows stay repeated, a
    text of any length is counted whole, a null id stays null, other columns are not read.
    """

    def run(batches):
        def build():
            vocabulary = Vocabulary(tokenizer_path)
            return PairCounter(vocabulary, False), PairCounter(vocabulary, True)

        first, rest = worker_memo(("pair counters", tokenizer_path), build)
        for ids, texts in text_chunks(batches, 5_000, 32 << 20):
            counts = [count_text(t.decode(), first, rest) if t else 0 for t in texts]
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array([len(t or b"") for t in texts], pa.int64()), pa.array(counts, pa.int64())],
                names=["doc_id", "n_bytes", "n_tokens"],
            )

    return id_and_bytes(docs, id_col, text_col).mapInArrow(run, "doc_id long, n_bytes long, n_tokens long")


def with_limit(counts: DataFrame, limit: int = 512) -> DataFrame:
    """Adds over_limit: more than `limit` tokens."""
    return counts.withColumn("over_limit", F.col("n_tokens") > limit)
