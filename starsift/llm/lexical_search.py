"""Ranked lexical search by norm buckets: impact vectors in order of length, bounds that prune, exact integer scores."""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from starsift.llm.common import stored, text_chunks

#: Bytes of item text whose terms are searched together; more items go in further blocks.
ITEM_BYTES = 16 << 20
#: Documents a task orders by length at once, matched terms they hold together at most, and documents of a norm bucket.
CHUNK_ROWS, CHUNK_TERMS, BUCKET_ROWS = 16_384, 4_000_000, 512
#: Share of the documents, the longest vectors, that set the first thresholds.
HEAD_SHARE = 1 / 64
#: Rounding allowed for in bounds taken in floating point.
SLACK = 1 + 1e-9

#: Bytes that belong to a term: digits, letters and all of a character beyond ASCII; capitals become small.
TERM_BYTES = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)


def terms_of(text: bytes | None) -> list[bytes]:
    """Terms of a whole text in order; UTF-8 bytes of characters beyond ASCII all count as letters."""
    return text.translate(TERM_BYTES).split() if text else []


@dataclass
class Items:
    """Items of one block: the terms of item k are terms[begins[k] : begins[k + 1]] as places in the sorted vocabulary."""

    ids: list
    vocabulary: list[bytes]
    terms: np.ndarray
    begins: np.ndarray


@dataclass
class Corpus:
    """Counts over all documents: with a term, their terms, documents that hold each vocabulary term, and its weight."""

    n: int
    length: int
    weights: np.ndarray


def item_blocks(items: DataFrame, id_col: str, text_col: str, item_bytes: int):
    """Items in blocks of about `item_bytes` of text; rows that share an id are one item."""
    given = items.select(F.col(id_col).cast("long").alias("item_id"), F.col(text_col).cast("string").alias("text"))
    total = given.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = max(1, math.ceil(total / item_bytes))
    dealt = given.withColumn("part", F.pmod(F.xxhash64("item_id"), F.lit(parts)))
    for part in range(parts):
        held: dict = {}
        # one block at a time reaches the driver, as distinct terms
        rows = dealt.filter(F.col("part") == part).select("item_id", F.col("text").cast("binary").alias("text"))
        for row in rows.toLocalIterator():
            held.setdefault(row.item_id, set()).update(terms_of(row.text))
        vocabulary = sorted(set().union(*held.values())) if held else []
        place = {t: i for i, t in enumerate(vocabulary)}
        lists = [np.array(sorted(place[t] for t in terms), np.int32) for terms in held.values()]
        begins = np.concatenate([[0], np.cumsum([len(x) for x in lists])]).astype(np.int64) if lists else np.zeros(1, np.int64)
        yield Items(list(held), vocabulary, np.concatenate([*lists, np.zeros(0, np.int32)]).astype(np.int32), begins)


def matched_terms(docs: DataFrame, vocabulary, id_col: str, text_col: str) -> DataFrame:
    """doc_id, n (all terms with repeats), and the places and numbers of the vocabulary's terms of every document with a term."""

    def count(batches):
        place = {t: i for i, t in enumerate(vocabulary.value)}
        for ids, texts in text_chunks(batches, 1024, 16 << 20):
            out: tuple[list, ...] = ([], [], [], [])
            for doc_id, text in zip(ids, texts, strict=True):
                words = terms_of(text)
                if not words:
                    continue
                found = np.fromiter((p for p in map(place.get, words) if p is not None), np.int32)
                at, times = np.unique(found, return_counts=True)
                for column, value in zip(out, (doc_id, len(words), at, times), strict=True):
                    column.append(value)
            kinds = (pa.int64(), pa.int64(), pa.list_(pa.int32()), pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, kinds, strict=True)], names=["doc_id", "n", "at", "times"])

    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").cast("binary").alias("text"))
    return source.mapInArrow(count, "doc_id long, n long, at array<int>, times array<int>")


def corpus_counts(counted: DataFrame, size: int) -> Corpus:
    """Counts and weights over all documents; what comes to the driver is one number per vocabulary term."""
    whole = counted.agg(F.count(F.lit(1)).alias("n"), F.sum("n").alias("terms")).first()

    def holders(batches):
        df = np.zeros(size, np.int64)
        for batch in batches:
            df += np.bincount(np.asarray(batch.column("at").flatten()), minlength=size)
        at = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(df[at])], names=["at", "df"])

    df = np.zeros(size, np.int64)
    for row in counted.select("at").mapInArrow(holders, "at int, df long").groupBy("at").agg(F.sum("df").alias("df")).collect():
        df[row["at"]] = row["df"]
    weights = [math.floor(1000 * math.log((2 * whole.n + 2) / (2 * int(d) + 1))) for d in df]
    return Corpus(whole.n, whole.terms or 0, np.array(weights, np.int64))


@dataclass
class Vectors:
    """Impact vectors of some documents, longest first: document k holds places at[begins[k] : begins[k + 1]]."""

    ids: np.ndarray
    nameless: np.ndarray
    begins: np.ndarray
    at: np.ndarray
    impact: np.ndarray
    length: np.ndarray


def impact_vectors(ids, nameless, n, sizes, at, times, corpus: Corpus) -> Vectors:
    """Weight times damped term frequency in integers, documents ordered by the length of their vector."""
    m = 10 + (90 * n * corpus.n) // max(corpus.length, 1)
    impact = corpus.weights[at] * ((1_000_000_000 * times) // (1000 * times + 8 * np.repeat(m, sizes)))
    of = np.repeat(np.arange(len(n)), sizes)
    length = np.sqrt(np.bincount(of, impact.astype(np.float64) ** 2, len(n)))
    order = np.argsort(-length, kind="stable")
    rank = np.empty(len(n), np.int64)
    rank[order] = np.arange(len(n))
    rows = np.argsort(rank[of], kind="stable")
    begins = np.concatenate([[0], np.cumsum(sizes[order])])
    return Vectors(ids[order], nameless[order], begins, at[rows], impact[rows], length[order])


class Best:
    """The `k` best documents of each item so far, and from when on a document can still be among them."""

    def __init__(self, items: Items, k: int, least: np.ndarray):
        self.k, self.least = k, least.copy()
        self.held = [(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool)) for _ in items.ids]

    def add(self, item: int, score: np.ndarray, ids: np.ndarray, nameless: np.ndarray) -> None:
        score, ids, nameless = (np.concatenate(x) for x in zip(self.held[item], (score, ids, nameless), strict=True))
        order = np.lexsort((ids, nameless, -score))[: self.k]
        self.held[item] = score[order], ids[order], nameless[order]
        if len(order) == self.k:
            self.least[item] = max(self.least[item], score[order[-1]])


def search(vectors: Vectors, items: Items, best: Best) -> None:
    """All documents against all items, bucket by bucket from the longest vectors on; `best` takes what is found.

    An item skips a bucket when its own length times the longest vector's, or the sum of the bucket's largest impacts on
    its terms, stays below its threshold. Inside, the half of its terms that can weigh most is added up for the bucket;
    what the others can add is bounded by their largest impacts and by the rest of the vector's length. Documents that
    may reach the threshold are scored anew over all terms, in integers.
    """
    size = len(items.vocabulary)
    terms_in = np.diff(items.begins)
    asking = np.flatnonzero(terms_in)
    if not len(asking):
        return
    own_length = np.sqrt(terms_in[asking])
    wanted = np.zeros(size, bool)
    for low in range(0, len(vectors.ids), BUCKET_ROWS):
        high = min(low + BUCKET_ROWS, len(vectors.ids))
        begin, end = vectors.begins[low], vectors.begins[high]
        if begin == end:
            break  # vectors are in order of length: none of the rest holds a term
        at, impact = vectors.at[begin:end], vectors.impact[begin:end]
        row = np.repeat(np.arange(high - low), np.diff(vectors.begins[low : high + 1]))
        order = np.argsort(at, kind="stable")
        by_term, term_begins = at[order], np.searchsorted(at[order], np.arange(size + 1))
        term_rows, term_impact = row[order], impact[order]
        most = np.zeros(size, np.int64)
        present, first = np.unique(by_term, return_index=True)
        most[present] = np.maximum.reduceat(term_impact, first)
        sums = np.add.reduceat(most[items.terms], items.begins[asking])
        reach = np.minimum(own_length * vectors.length[low] * SLACK, sums.astype(np.float64))
        squares = vectors.length[low:high] ** 2
        for item in asking[(reach >= best.least[asking]) & (sums > 0)]:
            own = items.terms[items.begins[item] : items.begins[item + 1]]
            own = own[most[own] > 0]
            own = own[np.argsort(-most[own], kind="stable")]
            focus, rest = own[: (len(own) + 1) // 2], own[(len(own) + 1) // 2 :]
            cut = np.concatenate([np.arange(term_begins[t], term_begins[t + 1]) for t in focus])
            part = np.bincount(term_rows[cut], term_impact[cut], high - low)
            spent = np.bincount(term_rows[cut], term_impact[cut].astype(np.float64) ** 2, high - low)
            left = np.sqrt(len(rest) * np.maximum(squares * SLACK - spent, 0)) * SLACK
            bound = part * SLACK + np.minimum(left, most[rest].sum())
            chosen = np.flatnonzero((bound >= best.least[item]) & (bound > 0))
            if not len(chosen):
                continue
            wanted[own] = True
            score = _exact(vectors, low + chosen, wanted)
            wanted[own] = False
            good = (score > 0) & (score >= best.least[item])
            if good.any():
                best.add(item, score[good], vectors.ids[low + chosen[good]], vectors.nameless[low + chosen[good]])


def _exact(vectors: Vectors, rows: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Integer scores of some documents: the sum of their impacts on the wanted terms."""
    sizes = vectors.begins[rows + 1] - vectors.begins[rows]
    ends = np.cumsum(sizes)
    place = np.arange(ends[-1]) - np.repeat(ends - sizes, sizes) + np.repeat(vectors.begins[rows], sizes)
    sums = np.concatenate([[0], np.cumsum(np.where(wanted[vectors.at[place]], vectors.impact[place], 0))])
    return sums[ends] - sums[ends - sizes]


def _chunks(batches, corpus: Corpus):
    """Impact vectors of a task's documents in chunks of bounded size, each in order of length."""
    held: list = []
    rows = terms = 0
    for batch in batches:
        for begin in range(0, batch.num_rows, 2048):
            part = batch.slice(begin, 2048)
            ids = part.column("doc_id")
            at, times = part.column("at"), part.column("times")
            held.append((
                np.asarray(ids.fill_null(0)), np.asarray(ids.is_null()), np.asarray(part.column("n")), np.asarray(at.value_lengths()),
                np.asarray(at.flatten()), np.asarray(times.flatten(), np.int64),
            ))
            rows += part.num_rows
            terms += len(held[-1][4])
            if rows >= CHUNK_ROWS or terms >= CHUNK_TERMS:
                yield impact_vectors(*map(np.concatenate, zip(*held, strict=True)), corpus)
                held, rows, terms = [], 0, 0
    if held:
        yield impact_vectors(*map(np.concatenate, zip(*held, strict=True)), corpus)


def ranked_documents(
    docs: DataFrame, items: DataFrame, k: int = 10, doc_id: str = "doc_id", doc_text: str = "text", item_id: str = "item_id",
    item_text: str = "text", item_bytes: int = ITEM_BYTES, head_share: float = HEAD_SHARE,
) -> DataFrame:
    """item_id, rank (from 1), doc_id and score of each item's `k` highest-scoring documents with a score above 0.

    Equal scores go by ascending doc_id, null ids last. A term counts once in an item; rows that share an item id are
    one item, a null id too. Every document row stands for itself, repeated rows too; null and empty texts hold no term
    and are no documents in the counts. Items without terms, and empty tables, give no rows; other columns are not read.

    One pass over the texts counts the items' terms. Documents are vectors of integer impacts over those terms. The
    longest vectors (`head_share` of all documents) are searched first: their k-th scores are thresholds that all
    further tasks begin with. Every task orders its vectors by length into buckets, see `search`; nothing but the best
    `k` of each item and task is shuffled. Items go in blocks of about `item_bytes` of text, so what is sent to
    executors has that bound.
    """
    spark = docs.sparkSession
    out = spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    for block in item_blocks(items, item_id, item_text, item_bytes):
        if block.vocabulary:
            out = out.union(_ranked(spark, docs, block, k, doc_id, doc_text, head_share))
    return out


def _ranked(spark: SparkSession, docs: DataFrame, items: Items, k: int, id_col: str, text_col: str, head_share: float) -> DataFrame:
    vocabulary = spark.sparkContext.broadcast(items.vocabulary)  # bounded by ITEM_BYTES
    counted = stored(matched_terms(docs, vocabulary, id_col, text_col))
    corpus = corpus_counts(counted, len(items.vocabulary))
    items = Items(items.ids, [b""] * len(items.vocabulary), items.terms, items.begins)
    sent = spark.sparkContext.broadcast((items, corpus))

    def lengths(batches):
        for chunk in _chunks(batches, sent.value[1]):
            yield pa.RecordBatch.from_arrays([pa.array(chunk.length)], names=["length"])

    cut = counted.mapInArrow(lengths, "length double").agg(F.percentile_approx("length", 1 - head_share, 10_000)).first()[0] or 0.0

    def searched(least: np.ndarray, longest: bool):
        def task(batches):
            items, corpus = sent.value
            best = Best(items, k, least)
            for chunk in _chunks(batches, corpus):
                if longest:
                    chunk = _first(chunk, int(np.searchsorted(-chunk.length, -cut, side="right")))
                search(chunk, items, best)
            for item, (score, ids, nameless) in enumerate(best.held):
                if len(score):
                    columns = [pa.array([item] * len(score), pa.int32()), pa.array(ids, mask=nameless), pa.array(score)]
                    yield pa.RecordBatch.from_arrays(columns, names=["item", "doc_id", "score"])

        return counted.mapInArrow(task, "item int, doc_id long, score long")

    of_item = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    nothing = np.ones(len(items.ids), np.int64)
    head = searched(nothing, True).withColumn("rank", F.row_number().over(of_item)).filter(F.col("rank") == k)
    least = nothing.copy()
    for row in head.select("item", "score").collect():  # one row per item of the block
        least[row["item"]] = row["score"]
    ranked = searched(least, False).withColumn("rank", F.row_number().over(of_item)).filter(F.col("rank") <= k)
    names = spark.createDataFrame(list(enumerate(items.ids)), "item int, item_id long")
    return ranked.join(F.broadcast(names), "item").select("item_id", "rank", "doc_id", "score")


def _first(v: Vectors, n: int) -> Vectors:
    end = v.begins[n]
    return Vectors(v.ids[:n], v.nameless[:n], v.begins[: n + 1], v.at[:end], v.impact[:end], v.length[:n])
