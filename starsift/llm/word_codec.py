"""Encoding and decoding with a word-end vocabulary: frequent words from a minimal acyclic transducer, others merged."""

from __future__ import annotations

import mmap
import tempfile
import unicodedata
from array import array
from collections import Counter
from dataclasses import dataclass
from hashlib import sha256

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starsift.llm.bpe import SHORT, Vocabulary, merged, normalised_words
from starsift.llm.common import id_and_bytes, text_chunks, worker_memo

#: Words in the transducer; the rest are merged when met.
LEXICON_WORDS = 65_536
#: Runs and words beside them that a worker remembers; a full memo is emptied, which costs time only.
MEMO, OTHERS = 150_000, 50_000
#: Runs a worker counts at once.
COUNTED = 200_000


@dataclass
class Lexicon:
    """A minimal acyclic transducer over UTF-8 words.

    States are numbered; state s owns the arcs first_arc[s] to first_arc[s + 1], sorted by label. An arc adds `output`,
    the sum along an accepted word is the word's number, and its ids are flat_ids[first_id[n] : first_id[n + 1]].
    """

    labels: bytes
    target: np.ndarray
    output: np.ndarray
    first_arc: np.ndarray
    final: np.ndarray
    root: int
    first_id: np.ndarray
    flat_ids: np.ndarray

    @staticmethod
    def build(entries: dict[bytes, list[int]]) -> Lexicon:
        """Words are added in order; the part of the last word that no later word can share is merged with an equal one."""
        words = sorted(entries)
        register: dict[tuple, int] = {}
        stored: list[tuple] = []  # (final, words below, arcs)

        def frozen(node: list) -> int:
            """The number of the only state with this node's right side."""
            key = (node[0], tuple(node[1]))
            if key not in register:
                register[key] = len(stored)
                stored.append((node[0], node[0] + sum(stored[t][1] for _, t in node[1]), node[1]))
            return register[key]

        path: list[list] = [[False, []]]  # open nodes of the last word: final, closed arcs
        last = b""
        for word in words:
            shared = 0
            while shared < min(len(word), len(last)) and word[shared] == last[shared]:
                shared += 1
            while len(path) > shared + 1:
                node = path.pop()
                path[-1][1].append((last[len(path) - 1], frozen(node)))
            path += [[False, []] for _ in word[shared:]]
            path[-1][0] = True
            last = word
        while len(path) > 1:
            node = path.pop()
            path[-1][1].append((last[len(path) - 1], frozen(node)))
        root = frozen(path[0])

        labels, target, output, first_arc = bytearray(), [], [], [0]
        for final, _, arcs in stored:
            before = int(final)
            for label, to in arcs:
                labels.append(label)
                target.append(to)
                output.append(before)
                before += stored[to][1]
            first_arc.append(len(labels))
        lengths = [len(entries[w]) for w in words]
        return Lexicon(
            bytes(labels),
            np.array(target, np.uint32),
            np.array(output, np.uint32),
            np.array(first_arc, np.uint32),
            np.array([s[0] for s in stored], np.uint8),
            root,
            np.cumsum([0, *lengths]).astype(np.uint32),
            np.array([i for w in words for i in entries[w]], np.uint32),
        )

    def to_bytes(self) -> bytes:
        """Six 64-bit sizes (states, arcs, root, words, ids, 0), then the arrays."""
        sizes = [len(self.final), len(self.labels), self.root, len(self.first_id) - 1, len(self.flat_ids), 0]
        arrays = (self.target, self.output, self.first_arc, self.first_id, self.flat_ids, self.final)
        return np.array(sizes, np.uint64).tobytes() + b"".join(a.tobytes() for a in arrays) + self.labels


class MappedLexicon:
    """Look-ups in a memory-mapped lexicon file."""

    def __init__(self, content: bytes):
        with tempfile.TemporaryFile() as f:  # no name: gone when the worker ends
            f.write(content)
            f.flush()
            self.map = mmap.mmap(f.fileno(), 0, access=mmap.ACCESS_READ)
        states, arcs, self.root, words, ids, _ = np.frombuffer(self.map, np.uint64, 6).astype(int).tolist()
        at = 48

        def take(kind, n):
            nonlocal at
            out = np.frombuffer(self.map, kind, n, at)
            at += out.nbytes
            return memoryview(out)

        self.target, self.output = take(np.uint32, arcs), take(np.uint32, arcs)
        self.first_arc = take(np.uint32, states + 1)
        self.first_id, self.flat_ids = take(np.uint32, words + 1), take(np.uint32, ids)
        self.final = take(np.uint8, states)
        self.labels_at = at

    def ids(self, word: bytes) -> list[int] | None:
        """The word's ids, or None for a word outside."""
        state, number, base, find = self.root, 0, self.labels_at, self.map.find
        for i in range(len(word)):
            lo, hi = self.first_arc[state], self.first_arc[state + 1]
            arc = find(word[i : i + 1], base + lo, base + hi) - base
            if arc < 0:
                return None
            number += self.output[arc]
            state = self.target[arc]
        if not self.final[state]:
            return None
        return list(self.flat_ids[self.first_id[number] : self.first_id[number + 1]])


    def words(self):
        """(word, ids as 32-bit integers) of all words, by a walk over the states."""
        todo = [(self.root, 0, b"")]
        while todo:
            state, number, word = todo.pop()
            if self.final[state]:
                yield word, array("i", self.flat_ids[self.first_id[number] : self.first_id[number + 1]]).tobytes()
            for arc in range(self.first_arc[state], self.first_arc[state + 1]):
                label = self.map[self.labels_at + arc : self.labels_at + arc + 1]
                todo.append((self.target[arc], number + self.output[arc], word + label))


def words_of_run(run: bytes) -> list[bytes]:
    """Words of a run without blanks; plain letters, with or without a full stop or comma, need no pattern."""
    if run.isascii():
        if run.isalpha():
            return [run.lower()]
        if run[-1:] in (b".", b",") and run[:-1].isalpha():
            return [run[:-1].lower(), run[-1:]]
        return [w.encode() for w in normalised_words(run.decode())]
    text = unicodedata.normalize("NFC", run.decode()).replace("Σ", "σ").lower()
    if text.isalpha():
        return [text.encode()]
    if text[-1] in ".," and text[:-1].isalpha():
        return [text[:-1].encode(), text[-1].encode()]
    return [w.encode() for w in normalised_words(run.decode())]


class Merges:
    """The merge list in numbers: a pair of ids leads to its rank and the id of what it makes."""

    def __init__(self, vocabulary: Vocabulary):
        ids, self.shift = vocabulary.ids, max(vocabulary.ids.values()).bit_length()
        self.vocabulary = vocabulary
        self.mask = (1 << self.shift) - 1
        self.pairs = {ids[a] << self.shift | ids[b]: rank << self.shift | ids[a + b] for (a, b), rank in vocabulary.ranks.items()}
        self.none = len(self.pairs) << self.shift
        self.inner = [ids[c] for c in vocabulary.alphabet]
        self.last = [ids[c + vocabulary.suffix] for c in vocabulary.alphabet]

    def ids(self, word: bytes) -> list[int]:
        """Ids of a word by merging the adjacent pair of lowest rank, leftmost first; long words go through the heap."""
        if len(word) > SHORT:
            return word_ids(word.decode(), self.vocabulary)
        parts = list(map(self.inner.__getitem__, word))
        parts[-1] = self.last[word[-1]]
        get, none, shift = self.pairs.get, self.none, self.shift
        ranks = [get(a << shift | b, none) for a, b in zip(parts, parts[1:], strict=False)]
        while ranks:
            least = min(ranks)
            if least == none:
                break
            i = ranks.index(least)
            parts[i : i + 2] = [least & self.mask]
            del ranks[i]
            if i < len(ranks):
                ranks[i] = get(parts[i] << shift | parts[i + 1], none)
            if i:
                ranks[i - 1] = get(parts[i - 1] << shift | parts[i], none)
        return parts


class Codec(dict):
    """A memo from a run of text without blanks to its ids as 32-bit integers.

    The mapped transducer is read out once per worker into the words that are known from the start; other words are
    merged and remembered for a while, by their run if it has no other word.
    """

    def __init__(self, tokenizer_path: str, lexicon: bytes):
        super().__init__()
        self.vocabulary = Vocabulary(tokenizer_path)
        self.merges = Merges(self.vocabulary)
        self.frequent = dict(MappedLexicon(lexicon).words())
        self.others: dict[bytes, bytes] = {}
        named = self.vocabulary.ids | self.vocabulary.special
        tokens = {i: t for t, i in named.items()}
        self.tokens = pa.array([tokens.get(i) for i in range(max(tokens) + 1)], pa.string())
        self.special_bytes = [s.encode() for s in self.vocabulary.special]

    def word_ids(self, word: bytes) -> bytes:
        packed = self.frequent.get(word) or self.others.get(word)
        if packed is None and word.isalpha():  # of bytes: ASCII letters, in lower case, so the word is a run as well
            packed = self.get(word)
        if packed is None:
            if len(self.others) >= OTHERS:
                self.others.clear()
            self.others[word] = packed = array("i", self.merges.ids(word)).tobytes()
        return packed

    def __missing__(self, run: bytes) -> bytes:
        words = words_of_run(run)
        if len(words) == 1:
            ids = self.frequent.get(words[0]) or self.others.get(words[0]) or array("i", self.merges.ids(words[0])).tobytes()
        else:
            ids = b"".join(map(self.word_ids, words))
        if len(self) >= MEMO:
            self.clear()
        self[run] = ids
        return ids

    def encode(self, text: bytes) -> bytes:
        """Of a whole text; runs between ASCII blanks are independent, special strings cut the text first."""
        if any(s in text for s in self.special_bytes):
            return b"".join([
                array("i", [special]).tobytes() if special is not None else b"".join(map(self.__getitem__, segment.encode().split()))
                for segment, special in self.vocabulary.segments(text.decode())
            ])
        return b"".join(map(self.__getitem__, text.split()))

    def decoded(self, ids: pa.ListArray) -> pa.Array:
        """The tokens of every list, joined by a space."""
        return pc.binary_join(pa.ListArray.from_arrays(ids.offsets, self.tokens.take(ids.values)), " ")


def word_ids(word: str, vocabulary: Vocabulary) -> list[int]:
    """Ids of one word by merging its symbols."""
    return [vocabulary.ids[p] for p in merged(vocabulary.symbols(word), vocabulary.ranks)]


def frequent_words(
    docs: DataFrame, limit: int = LEXICON_WORDS, id_col: str = "doc_id", text_col: str = "text"
) -> list[str]:
    """At most `limit` words: the most frequent ones in the whole texts of all rows, equal counts by word."""

    def run(batches):
        def flush(runs):
            words: Counter = Counter()
            while runs:  # each run goes as its words come, so the two counters do not add up
                r, n = runs.popitem()
                for w in words_of_run(r):
                    words[w] += n
            names = list(words)
            for at in range(0, len(names), 50_000):
                part = names[at : at + 50_000]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(part, pa.binary()).cast(pa.string()), pa.array([words[w] for w in part], pa.int64())], names=["word", "n"]
                )

        worker_memo(("counted words",), dict)  # lets go of what an earlier operator left in this worker
        runs: Counter = Counter()
        for _, texts in text_chunks(batches, 2_000, 4 << 20):
            for t in texts:
                if t:
                    runs.update(t.split())
            if len(runs) >= COUNTED:
                yield from flush(runs)
                runs = Counter()  # an emptied one keeps its table
        yield from flush(runs)

    totals = id_and_bytes(docs, id_col, text_col).mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    return [r.word for r in totals.orderBy(F.desc("n"), "word").limit(limit).collect()]


def build_lexicon(words: list[str], tokenizer_path: str) -> bytes:
    """Lexicon file of the words with their ids; its size is bounded by the number of words."""
    vocabulary = Vocabulary(tokenizer_path)
    return Lexicon.build({w.encode(): word_ids(w, vocabulary) for w in words}).to_bytes()


def encode_decode(
    docs: DataFrame, tokenizer_path: str, words: list[str] | None = None, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """doc_id, ids array<int> and decoded string of every row, equal to the tokenizer library's for a word-end file.

    `words` fills the transducer (by default the most frequent words of all of `docs`); it changes speed,
    never results. The file is at most a few MB (LEXICON_WORDS), sent to the executors and memory-mapped there. Decoding
    joins tokens with a space, special tokens kept, as the library does without a decoder. Null and empty texts give an
    empty list and an empty string; repeated rows stay repeated, long texts are encoded whole, a null id stays null and
    other columns are not read.
    """
    if words is None:
        words = frequent_words(docs, LEXICON_WORDS, id_col, text_col)
    content = build_lexicon(words, tokenizer_path)
    name = sha256(content).hexdigest()
    lexicon = docs.sparkSession.sparkContext.broadcast(content)

    def run(batches):
        codec = worker_memo(("codec", tokenizer_path, name), lambda: Codec(tokenizer_path, lexicon.value))
        for ids, texts in text_chunks(batches, 1_000, 2 << 20):
            done = [codec.encode(t) if t else b"" for t in texts]
            flat = pa.array(np.frombuffer(b"".join(done), np.int32), pa.int32())
            lists = pa.ListArray.from_arrays(pa.array(np.cumsum([0, *[len(d) // 4 for d in done]]), pa.int32()), flat)
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), lists, codec.decoded(lists)], names=["doc_id", "ids", "decoded"])

    return id_and_bytes(docs, id_col, text_col).mapInArrow(run, "doc_id long, ids array<int>, decoded string")


def digests(coded: DataFrame, *more: str) -> DataFrame:
    """doc_id, n_tokens, SHA-256 of the ids joined by a space and of the decoded text, and more columns by name."""
    return coded.select(
        "doc_id",
        *more,
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " ").cast("binary"), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )
