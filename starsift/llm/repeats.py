"""Passages that repeat an earlier document: fixed blocks as anchors, probed by every rolling window, then extended."""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from starsift.llm.common import (
    BLANKS, WordHashes, hashed_words, id_and_bytes, id_and_text, mixed, stored, text_chunks, with_ids, worker_memo,
)

#: Rows and bytes of text a task compares with itself before anything is shuffled.
PIECE_ROWS, PIECE_BYTES = 4_000, 5 << 20
#: Bits of an anchor's hash that travel, with one more for "stands at a block".
ANCHOR_BITS = 39
#: Parts of the anchor index for each shuffle partition.
PARTS = 4
BASE = 0x9E3779B97F4A7C15


#: Powers by their number, kept for a task; a plain dict travels with the job where a cached function would not.
_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd base and of its inverse, modulo 2**64."""
    if n in _POWERS:
        return _POWERS[n]
    inverse = pow(BASE, -1, 1 << 64)
    ones = np.ones(n, np.uint64)
    up, down = ones.copy(), ones.copy()
    up[1:], down[1:] = BASE, inverse
    _POWERS[n] = np.multiply.accumulate(up), np.multiply.accumulate(down)
    return _POWERS[n]


def rolling(flat: np.ndarray, width: int) -> np.ndarray:
    """Hash of the `width` words from each place on, by running sums."""
    n = len(flat) - width + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    size = 1 << max(10, int(len(flat)).bit_length())
    up, down = _powers(size)
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(flat * up[: len(flat)], dtype=np.uint64)])
    return mixed((total[width:] - total[:-width]) * down[:n])


def places(begins: np.ndarray, width: int, least: int) -> tuple[np.ndarray, np.ndarray]:
    """(list number, place) of every run of `width` words inside a list of at least `least` words."""
    sizes = np.diff(begins)
    n = np.where(sizes >= least, np.maximum(sizes - width + 1, 0), 0)
    owner = np.repeat(np.arange(len(sizes)), n)
    at = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n) + begins[:-1][owner]
    return owner, at


def _memo() -> WordHashes:
    return worker_memo(("word hashes",), WordHashes)


def _words(texts: list[bytes | None]) -> list[list[bytes]]:
    return [t.split() if t else [] for t in texts]


def _leaders(key: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sorted order of (key, owner), where each key begins, and for each place in the order its key's number."""
    order = np.lexsort((owner, key))
    key = key[order]
    first = np.ones(len(key), bool)
    first[1:] = key[1:] != key[:-1]
    return order, first, np.cumsum(first) - 1


def _pack(doc: np.ndarray, anchor: np.ndarray) -> bytes:
    """Anchors by document: their count, sizes, ids and sizes of groups squeezed, five bytes for each anchor."""
    ids, counts = np.unique(doc, return_counts=True)
    table = zlib.compress(np.diff(ids, prepend=0).astype("<i8").tobytes() + counts.astype("<u4").tobytes(), 1)
    order = np.argsort(doc, kind="stable")
    five = np.ascontiguousarray(anchor[order].astype("<u8").view(np.uint8).reshape(-1, 8)[:, :5])
    return np.array([len(ids), len(table)], "<u4").tobytes() + table + five.tobytes()


def _unpack(content: bytes) -> tuple[np.ndarray, np.ndarray]:
    n, size = np.frombuffer(content, "<u4", 2).tolist()
    table = zlib.decompress(content[8 : 8 + size])
    ids = np.cumsum(np.frombuffer(table, "<i8", n))
    doc = np.repeat(ids, np.frombuffer(table, "<u4", n, 8 * n).astype(np.int64))
    five = np.frombuffer(content, np.uint8, offset=8 + size).reshape(-1, 5)
    eight = np.zeros((len(five), 8), np.uint8)
    eight[:, :5] = five
    return doc, eight.view("<u8").ravel()


def _anchors(rows: DataFrame, window: int, block: int, parts: int) -> DataFrame:
    """(part, doc, content): packed anchors of a piece for one part of the index, or, with a doc, its certain hits.

    Every place of a document of at least `window` words is probed; places at multiples of `block` are indexed, which
    one bit of the anchor says. An anchor that several documents of the piece hold is a hit for each of them and goes
    on once, so one that very many documents hold leaves a task once per piece.
    """

    def run(batches):
        names = ["part", "doc", "content"]
        for ids, texts in text_chunks(batches, PIECE_ROWS, PIECE_BYTES):
            flat, begins = hashed_words(_words(texts), _memo())
            known = np.array([i is not None for i in ids], bool)
            doc = np.array([i if i is not None else 0 for i in ids], np.int64)
            owner, at = places(begins, block, window)
            keep = known[owner]
            owner, at = owner[keep], at[keep]
            if not len(owner):
                continue
            h = rolling(flat, block)[at]
            part = ((h >> np.uint64(40)) * np.uint64(parts)) >> np.uint64(24)
            cut = h & np.uint64((1 << ANCHOR_BITS) - 1)
            aligned = (at - begins[owner]) % block == 0
            key = (part << np.uint64(ANCHOR_BITS)) | cut
            order, first, number = _leaders(key, doc[owner])
            owners = doc[owner][order]
            n = int(first.sum())
            any_aligned = np.zeros(n, bool)
            any_aligned[number[aligned[order]]] = True
            leader = owners[first]
            last = owners[np.append(np.flatnonzero(first)[1:] - 1, len(owners) - 1)]
            many = last != leader
            # hits inside the piece
            hit = many[number]
            hit_doc, hit_key = owners[hit], key[order][hit]
            by_doc = np.lexsort((hit_key, hit_doc))
            hit_doc, hit_key = hit_doc[by_doc], hit_key[by_doc]
            starts = np.flatnonzero(np.append(True, hit_doc[1:] != hit_doc[:-1])) if len(hit_doc) else np.zeros(0, int)
            for a, b in zip(starts, [*starts[1:], len(hit_doc)] if len(starts) else [], strict=True):
                d = int(hit_doc[a])
                yield pa.RecordBatch.from_arrays(
                    [pa.array([d % parts], pa.int32()), pa.array([d], pa.int64()), pa.array([hit_key[a:b].tobytes()], pa.binary())],
                    names=names,
                )
            # anchors for the index
            unique = key[order][first]
            anchor = (unique & np.uint64((1 << ANCHOR_BITS) - 1)) | (any_aligned.astype(np.uint64) << np.uint64(ANCHOR_BITS))
            part_of = (unique >> np.uint64(ANCHOR_BITS)).astype(np.int64)
            bounds = np.searchsorted(part_of, np.arange(parts + 1))
            for p in range(parts):
                a, b = bounds[p], bounds[p + 1]
                if a < b:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([p], pa.int32()), pa.array([None], pa.int64()), pa.array([_pack(leader[a:b], anchor[a:b])], pa.binary())],
                        names=names,
                    )

    return rows.mapInArrow(run, "part int, doc long, content binary")


def _hits(anchors: DataFrame, parts: int) -> DataFrame:
    """(doc, anchors as 64-bit numbers): those that several documents hold, one of them at a block."""
    shuffled = anchors.repartition(parts, "part").sortWithinPartitions("part")

    def run(batches):
        def met(part, packed):
            loaded = [_unpack(c) for c in packed]
            doc = np.concatenate([x[0] for x in loaded])
            anchor = np.concatenate([x[1] for x in loaded])
            cut = anchor & np.uint64((1 << ANCHOR_BITS) - 1)
            order, first, number = _leaders(cut, doc)
            n = int(first.sum())
            aligned = np.zeros(n, bool)
            aligned[number[(anchor[order] >> np.uint64(ANCHOR_BITS)) > 0]] = True
            owners = doc[order]
            last = owners[np.append(np.flatnonzero(first)[1:] - 1, len(owners) - 1)]
            hit = (aligned & (last != owners[first]))[number]
            keys = (np.uint64(part) << np.uint64(ANCHOR_BITS)) | cut[order][hit]
            by_doc = np.argsort(owners[hit], kind="stable")
            return owners[hit][by_doc], keys[by_doc]

        def rows(doc, keys):
            if not len(doc):
                return
            starts = np.flatnonzero(np.append(True, doc[1:] != doc[:-1]))
            ends = np.append(starts[1:], len(doc))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(doc[starts], pa.int64()),
                    pa.array([keys[a:b].tobytes() for a, b in zip(starts, ends, strict=True)], pa.binary()),
                ],
                names=["doc", "anchors"],
            )

        now, packed = None, []
        for batch in batches:
            for part, doc, content in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                if doc is not None:
                    yield pa.RecordBatch.from_arrays([pa.array([doc], pa.int64()), pa.array([content], pa.binary())], names=["doc", "anchors"])
                    continue
                if part != now and packed:
                    yield from rows(*met(now, packed))
                    packed = []
                now = part
                packed.append(content)
        if packed:
            yield from rows(*met(now, packed))

    return shuffled.mapInArrow(run, "doc long, anchors binary")


def _windows(found: DataFrame, window: int, block: int, parts: int) -> DataFrame:
    """(h, doc, place, sure) of every window over a hit; sure where a smaller document of the piece has it.

    Of the documents of a piece that share a window only the smallest goes on unsure.
    """

    def run(batches):
        def pieces():
            ids, texts, anchors, held = [], [], [], 0
            for batch in batches:
                for doc_id, text, hits in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                    if ids and (len(ids) >= PIECE_ROWS or held + len(text) > PIECE_BYTES):
                        yield ids, texts, anchors
                        ids, texts, anchors, held = [], [], [], 0
                    ids.append(doc_id)
                    texts.append(text)
                    anchors.append(hits)
                    held += len(text)
            if ids:
                yield ids, texts, anchors

        for ids, texts, anchors in pieces():
            doc = np.array(ids, np.int64)
            flat, begins = hashed_words(_words(texts), _memo())
            small, large = rolling(flat, block), rolling(flat, window)
            part = ((small >> np.uint64(40)) * np.uint64(parts)) >> np.uint64(24)
            key = (part << np.uint64(ANCHOR_BITS)) | (small & np.uint64((1 << ANCHOR_BITS) - 1))
            owners, at = [], []
            for i, hits in enumerate(anchors):
                a, b = int(begins[i]), int(begins[i + 1])
                if b - a < window:
                    continue
                own = np.frombuffer(b"".join(hits), np.uint64)
                marked = np.flatnonzero(np.isin(key[a : b - block + 1], own))
                # windows from place - (window - block) to place hold the anchor
                cover = np.zeros(b - a + 2, np.int64)
                np.add.at(cover, np.maximum(marked - (window - block), 0), 1)
                np.add.at(cover, np.minimum(marked, b - a - window) + 1, -1)
                chosen = np.flatnonzero(np.cumsum(cover)[: b - a - window + 1] > 0)
                owners.append(np.full(len(chosen), i))
                at.append(chosen + a)
            if not owners:
                continue
            owner, at = np.concatenate(owners), np.concatenate(at)
            h = large[at]
            order, first, number = _leaders(h, doc[owner])
            owner, at, h = owner[order], at[order], h[order]
            sure = doc[owner] > doc[owner][first][number]
            place = at - begins[owner]
            for a in range(0, len(h), 100_000):
                cut = slice(a, a + 100_000)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(h[cut].view(np.int64)), pa.array(doc[owner[cut]]), pa.array(place[cut], pa.int32()), pa.array(sure[cut])],
                    names=["h", "doc", "place", "sure"],
                )

    return found.mapInArrow(run, "h long, doc long, place int, sure boolean")


def repeated_windows(
    docs: DataFrame, window: int = 50, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(doc_id, starts array<int>): the places in words at which a window also stands in a document of smaller id.

    Places in a row are a maximal repeat. A window of `window` words holds a whole block of (window + 1) // 2 words
    that stands at a multiple of that length in the earlier document, so probing every place of every document for the
    blocks finds every repeat; a hit is extended by hashing the windows over it and comparing them over all documents.
    Anchors are shuffled by parts of their hash, packed, once each per piece of a task.
    """
    block = (window + 1) // 2
    rows = id_and_bytes(docs, id_col, text_col)
    parts = PARTS * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    hits = stored(_hits(_anchors(rows, window, block, parts), parts))
    by_doc = hits.groupBy("doc").agg(F.collect_list("anchors").alias("anchors")).withColumnRenamed("doc", "doc_id")
    ids = hits.select(F.col("doc").alias("doc_id")).distinct()
    found = with_ids(rows.filter("text is not null"), ids).join(by_doc, "doc_id").select("doc_id", "text", "anchors")
    met = _windows(found, window, block, parts)
    met = met.withColumn("slot", F.when(F.col("sure"), F.xxhash64("h", "doc", "place")).otherwise(F.col("h")))
    least = F.min("doc").over(Window.partitionBy("slot", "sure"))
    later = met.select("doc", "place", "sure", least.alias("least")).filter("sure or least < doc")
    return stored(
        later.select(F.col("doc").alias("doc_id"), "place").groupBy("doc_id").agg(F.collect_set("place").alias("starts"))
    )


def without_repeats(docs: DataFrame, window: int = 50, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_words, n_removed and kept: the words, joined by one space, that no repeated window covers.

    Words are runs without ASCII blanks, unchanged; the first document by id keeps a passage, and windows are judged on
    the input. Null and empty texts have no words and an empty result; documents shorter than a window stay whole;
    repeated rows and rows that share an id are one document to each other, so they remove nothing from one another;
    a null id removes nothing and loses nothing; texts count whole; an empty table gives no rows; other columns are not
    read.
    """
    starts = repeated_windows(docs, window, id_col, text_col)
    rows = id_and_text(docs, id_col, text_col)
    ids = starts.select("doc_id")
    same = with_ids(rows, ids, how="left_anti").select(
        "doc_id",
        F.coalesce(F.regexp_count("text", F.lit(f"[^{BLANKS}]+")), F.lit(0)).cast("long").alias("n_words"),
        F.lit(0).cast("long").alias("n_removed"),
        F.trim(F.regexp_replace(F.coalesce("text", F.lit("")), f"[{BLANKS}]+", " ")).alias("kept"),
    )

    def run(batches):
        for batch in batches:
            rows = []
            for doc_id, text, at in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                words = text.split() if text else []
                cover = np.zeros(len(words) + 1, np.int64)
                at = np.array([p for p in at if p + window <= len(words)], np.int64)
                cover[at] += 1
                cover[at + window] -= 1
                stays = np.cumsum(cover)[:-1] == 0
                kept = b" ".join([w for w, s in zip(words, stays.tolist(), strict=True) if s])
                rows.append((doc_id, len(words), len(words) - int(stays.sum()), kept.decode()))
            yield pa.RecordBatch.from_pylist(
                [dict(zip(("doc_id", "n_words", "n_removed", "kept"), r, strict=True)) for r in rows],
                schema=pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept", pa.string())]),
            )

    changed = with_ids(id_and_bytes(docs, id_col, text_col), ids).join(starts, "doc_id").select("doc_id", "text", "starts")
    return same.unionByName(changed.mapInArrow(run, "doc_id long, n_words long, n_removed long, kept string"))
