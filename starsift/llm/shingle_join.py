"""Documents whose sets of word n-grams are alike: size-banded tiles, bitmap bounds, exact intersection.

Two sets link when 100 * intersection >= percent * union. Sizes of linked sets differ by little, so sets fall in
bands of size and only a band and the next one meet, in a tile. Linked sets of a tile differ in at most H shingles.
The space of shingle hashes is cut into more than H equal parts, so some parts of two linked sets are the same; sets
meet where a part is the same. Nothing is lost, and frequent shingles alone bring nothing together.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from starsift.llm.common import id_and_bytes, mixed, release, stored, text_chunks, with_ids, word_hash, worker_memo, written
from starsift.llm.components import components

#: Rows and bytes of text a task compares with itself before anything is shuffled.
PIECE_ROWS, PIECE_BYTES = 4_000, 3 << 20
#: Rows and bytes of text whose sets are made at once where nothing is compared.
SET_ROWS, SET_BYTES = 1_000, 1 << 20
#: Bytes that separate words, and the bytes of an eight-byte number that belong to a word of 0 to 8 bytes.
BLANK = np.isin(np.arange(256), [0x20, *range(0x09, 0x0E)])
INSIDE = np.array([(1 << 8 * n) - 1 for n in range(9)], np.uint64)
#: Longest word that is hashed eight bytes at a time with all others.
LONG_WORD = 64
#: Sets in a block of a tile.
BLOCK = 128
#: Times that sets are verified against a drawn set of each open key before all its blocks meet.
ROUNDS = 2
#: Smallest open keys that go with a set, so that a pair is not given again for each key it shares.
FIRST_KEYS = 16
#: Shingles of the sets in a block, about, and columns of a matrix product, where links are counted.
BLOCK_SHINGLES, COLUMNS = 1 << 18, 4096
#: Parts beyond the least number, as a share of H: they let parts of few shingles go unused.
SPARE = 0.18


@dataclass(frozen=True)
class Likeness:
    """Shingles of `words` words; linked from `percent` of the union on."""

    words: int = 5
    percent: int = 80

    @cached_property
    def edges(self) -> list[int]:
        """Least sizes of the bands."""
        out = [1]
        while out[-1] < 1 << 40:
            out.append(100 * out[-1] // self.percent + 1)
        return out

    @cached_property
    def tiles(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """For the tile of each band: parts, H, and the least size of a part worth a key."""
        parts, most, least = [], [], []
        for low, high in zip(self.edges, self.edges[1:], strict=False):
            h = (high - 1) * (100 - self.percent) // self.percent
            k = h + 1 + (math.ceil(SPARE * h) if h > 3 else 0)
            mean, m, term, below = low / k, 1, math.exp(-min(low / k, 700.0)), 0.0
            while (below := below + term) <= 0.5 * (k - h - 1) / k:
                term *= mean / m
                m += 1
            parts.append(k)
            most.append(h)
            least.append(m - 1)
        return np.array(parts), np.array(most), np.array(least)

    def linked(self, common: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether sets of sizes a and b with so many common shingles link."""
        return 100 * common >= self.percent * (a + b - common)


def word_hashes(texts: list[bytes | None]) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of the words of all texts, A-Z in lower case, and where each text begins (with the end of the last).

    Words are taken eight bytes at a time, all at once, so new words cost no more than known ones.
    """
    texts = [t or b"" for t in texts]
    joined = b" ".join([*texts, b" " * 8]).lower()
    blank = BLANK[np.frombuffer(joined, np.uint8)]
    edges = np.flatnonzero(blank[1:] != blank[:-1]) + 1
    if not blank[0]:
        edges = np.append(0, edges)
    starts, size = edges[::2], edges[1::2] - edges[::2]
    begins = np.searchsorted(starts, np.cumsum([0, *(len(t) + 1 for t in texts)]))
    eight = np.ndarray(len(joined) - 7, "<u8", joined, 0, 1)
    flat = mixed(eight[starts] & INSIDE[np.minimum(size, 8)] ^ mixed(size.astype(np.uint64)))
    longer = np.flatnonzero((size > 8) & (size <= LONG_WORD))
    for at in range(8, LONG_WORD, 8):
        more = eight[starts[longer] + at] & INSIDE[np.minimum(size[longer] - at, 8)]
        flat[longer] = mixed(flat[longer] * np.uint64(0xC2B2AE3D27D4EB4F) + more)
        longer = longer[size[longer] > at + 8]
    for i in np.flatnonzero(size > LONG_WORD):
        flat[i] = word_hash(joined[starts[i] : starts[i] + size[i]])
    return flat, begins


def shingle_sets(texts: list[bytes | None], how: Likeness) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text; a text of fewer words is one shingle, one without words is empty."""
    flat, begins = word_hashes(texts)
    n = how.words
    rolled = np.zeros(max(0, len(flat) - n + 1), np.uint64)
    for i in range(n):
        rolled = mixed(rolled * np.uint64(0x9E3779B97F4A7C15) + flat[i : i + len(rolled)])
    out = []
    for a, b in zip(begins[:-1].tolist(), begins[1:].tolist(), strict=True):
        if b - a >= n:
            items = np.sort(rolled[a : b - n + 1])
            out.append(items[np.append(True, items[1:] != items[:-1])])
        elif b > a:
            short = np.uint64(b - a)
            for w in flat[a:b]:
                short = mixed(np.array([short], np.uint64) * np.uint64(0xD6E8FEB86659FD93) + w)[0]
            out.append(np.array([short], np.uint64))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def set_digests(sets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit digests of each set."""
    sizes = np.array([len(s) for s in sets], np.int64)
    some = np.flatnonzero(sizes)
    out = np.zeros((2, len(sets)), np.uint64)
    if len(some):
        flat = np.concatenate(sets)
        begins = (np.cumsum(sizes) - sizes)[some]
        for digest, salt in zip(out, (0x243F6A8885A308D3, 0x13198A2E03707344), strict=True):
            digest[some] = np.add.reduceat(mixed(flat ^ np.uint64(salt)), begins)
    return out[0].view(np.int64), out[1].view(np.int64)


def part_keys(sets: list[np.ndarray], how: Likeness) -> tuple[np.ndarray, np.ndarray]:
    """(set number, key) of the parts of every set in its two tiles.

    The part follows from the upper bits of a shingle's hash, so the parts of a sorted set are slices. Where fewer
    parts than k - H are smaller than the tile's least size, some same part is not among them and they get no key.
    """
    sizes = np.array([len(s) for s in sets], np.int64)
    parts, most, least = how.tiles
    band = np.searchsorted(np.array(how.edges), sizes, side="right") - 1
    flat = np.concatenate(sets) if sets else np.zeros(0, np.uint64)
    owner = np.repeat(np.arange(len(sets)), sizes)
    spread = mixed(flat)
    upper = flat >> np.uint64(32)
    owners, keys = [], []
    for step in (0, 1):
        tile = band - step
        use = (sizes > 0) & (tile >= 0)
        at = use[owner]
        if not at.any():
            continue
        who = owner[at]
        tile_of = tile[who]
        part = (upper[at] * parts[tile_of].astype(np.uint64)) >> np.uint64(32)
        new = np.ones(len(who), bool)
        new[1:] = (who[1:] != who[:-1]) | (part[1:] != part[:-1])
        begins = np.flatnonzero(new)
        count = np.diff(np.append(begins, len(who)))
        total = np.add.reduceat(spread[at], begins)
        who, part, tile_of = who[begins], part[begins], tile_of[begins]
        small = count < least[tile_of]
        filled = np.bincount(who, minlength=len(sets))
        not_small = np.bincount(who[~small], minlength=len(sets))
        k = np.where(use, parts[np.maximum(tile, 0)], 0)
        spared = k - not_small <= k - np.where(use, most[np.maximum(tile, 0)], 0) - 1
        keep = ~(small & spared[who])
        salt = tile_of.astype(np.uint64) << np.uint64(40)
        key = mixed(total ^ mixed(salt + part + np.uint64(1)))
        owners.append(who[keep])
        keys.append(key[keep])
        # sets that keep everything have a key for every empty part as well
        for i in np.flatnonzero(use & ~spared & (filled < k)):
            absent = np.setdiff1d(np.arange(k[i], dtype=np.uint64), part[who == i])
            owners.append(np.full(len(absent), i))
            keys.append(mixed(mixed((np.uint64(tile[i]) << np.uint64(40)) + absent + np.uint64(1))))
    if not owners:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate(owners), np.concatenate(keys).view(np.int64)


def bitmap(items: np.ndarray, size: int | None = None) -> np.ndarray:
    """A bit for each shingle at its hash, in a power of two of two to four bits a shingle (64 at least)."""
    n = len(items) if size is None else size
    width = max(64, 1 << (4 * max(n, 1)).bit_length() - 1)
    bits = np.zeros(width, np.uint8)
    bits[(mixed(items) & np.uint64(width - 1)).astype(np.int64)] = 1
    return np.packbits(bits, bitorder="little").view(np.uint64)


def folded(bits: np.ndarray, words: int) -> np.ndarray:
    """A wide bitmap as a narrower one would have been."""
    while len(bits) > words:
        half = len(bits) // 2
        bits = bits[:half] | bits[half:]
    return bits


def most_common(a: np.ndarray, b: np.ndarray, size_a: int, size_b: int) -> int:
    """No more shingles than this can be common: each bit on one side only is at least one shingle of that side only."""
    words = min(len(a), len(b))
    a, b = folded(a, words), folded(b, words)
    only_a = int(np.bitwise_count(a & ~b).sum())
    only_b = int(np.bitwise_count(b & ~a).sum())
    return min(size_a - only_a, size_b - only_b)


def _set_chunks(batches, how: Likeness, max_rows: int = SET_ROWS, max_bytes: int = SET_BYTES):
    """(ids, sets) of the texts of a task in pieces of bounded rows and bytes."""
    worker_memo(("shingles",), dict)  # lets go of what an earlier operator left in this worker
    for ids, texts in text_chunks(batches, max_rows, max_bytes):
        yield ids, shingle_sets(texts, how)


def _set_table(rows: DataFrame, how: Likeness) -> DataFrame:
    """doc_id, n_shingles and the digests of the set."""

    def run(batches):
        for ids, sets in _set_chunks(batches, how):
            d1, d2 = set_digests(sets)
            sizes = np.array([len(s) for s in sets], np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(sizes), pa.array(d1), pa.array(d2)], names=["doc_id", "n_shingles", "d1", "d2"]
            )

    return rows.mapInArrow(run, "doc_id long, n_shingles long, d1 long, d2 long")


def _meetings(rows: DataFrame, how: Likeness) -> DataFrame:
    """(key, doc, near): near is null, or a document of the same piece with the same key that stands for this one there.

    A key that very many sets share leaves a task once per piece; the sets behind it are already beside their `near`.
    Sets equal to one before them in the piece get no keys.
    """

    def run(batches):
        for ids, sets in _set_chunks(batches, how, PIECE_ROWS, PIECE_BYTES):
            known = np.array([i for i, d in enumerate(ids) if d is not None], np.int64)
            doc = np.array([ids[i] for i in known], np.int64)
            order = np.argsort(doc, kind="stable")
            doc, sets = doc[order], [sets[i] for i in known[order]]
            d1, d2 = set_digests(sets)
            seen: set = set()
            fresh = []
            for i, pair in enumerate(zip(d1.tolist(), d2.tolist(), strict=True)):
                if pair not in seen:
                    seen.add(pair)
                    fresh.append(i)
            doc = doc[fresh]
            owner, key = part_keys([sets[i] for i in fresh], how)
            by_key = np.lexsort((owner, key))
            key, who = key[by_key], doc[owner[by_key]]
            first = np.ones(len(key), bool)
            first[1:] = key[1:] != key[:-1]
            leader = who[np.flatnonzero(first)][np.cumsum(first) - 1] if len(key) else who
            once = first | (who != leader)
            key, who, leader, first = key[once], who[once], leader[once], first[once]
            for at in range(0, len(key), 100_000):
                cut = slice(at, at + 100_000)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(key[cut]), pa.array(who[cut]), pa.array(leader[cut], mask=first[cut])], names=["key", "doc", "near"]
                )

    return rows.mapInArrow(run, "key long, doc long, near long")


def _per_set(rows: DataFrame, ids: DataFrame, how: Likeness, column: str) -> DataFrame:
    """(doc, n, bits or items) of the documents `ids`, from their texts."""
    form = {"bits": bitmap, "items": lambda s: s}[column]

    def run(batches):
        for doc_ids, sets in _set_chunks(batches, how):
            yield pa.RecordBatch.from_arrays(
                [pa.array(doc_ids, pa.int64()), pa.array([len(s) for s in sets], pa.int64()), pa.array([form(s).tobytes() for s in sets], pa.binary())],
                names=["doc", "n", column],
            )

    return stored(with_ids(rows, ids).mapInArrow(run, f"doc long, n long, {column} binary").distinct())


def _with_both(pairs: DataFrame, sets: DataFrame, column: str) -> DataFrame:
    for side in ("b", "a"):
        other = sets.select(F.col("doc").alias(side), F.col("n").alias(f"n_{side}"), F.col(column).alias(f"of_{side}"))
        pairs = pairs.join(other, side)
    return pairs.select("a", "b", "n_a", "n_b", "of_a", "of_b")


def _picked(both: DataFrame, keeps) -> DataFrame:
    """Pairs for which keeps(array of a, array of b, n_a, n_b)."""

    def run(batches):
        for batch in batches:
            left, right, n_a, n_b = (batch.column(c) for c in ("of_a", "of_b", "n_a", "n_b"))
            keep = [
                keeps(np.frombuffer(left[i].as_buffer(), np.uint64), np.frombuffer(right[i].as_buffer(), np.uint64), n_a[i].as_py(), n_b[i].as_py())
                for i in range(batch.num_rows)
            ]
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return both.mapInArrow(run, "a long, b long")


def _verified(pairs: DataFrame, rows: DataFrame, bits: DataFrame, how: Likeness) -> DataFrame:
    """The pairs (a, b) that link: bit counts of all, then the intersection of the sorted arrays of those they allow."""

    def allowed(a, b, n_a, n_b):
        return how.linked(most_common(a, b, n_a, n_b), n_a, n_b)

    def exact(a, b, n_a, n_b):
        return how.linked(len(np.intersect1d(a, b, assume_unique=True)), n_a, n_b)

    left = stored(_picked(_with_both(pairs, bits, "bits"), allowed))
    ids = left.select(F.col("a").alias("doc_id")).union(left.select("b")).distinct()
    return _picked(_with_both(left, _per_set(rows, ids, how, "items"), "items"), exact)


def _open_members(members: DataFrame, found: DataFrame, copies: DataFrame) -> DataFrame:
    """(key, doc, label) of the keys that hold several components; a set without any link is its own.

    Of equal sets only the smallest id is left; it has the same keys.
    """
    marks = found.select(F.col("node").alias("doc"), F.col("component").alias("label"), F.lit(False).alias("copy")).union(
        copies.select("doc", "rep", F.lit(True))
    )
    named = members.join(marks, "doc", "left").filter("copy is null or not copy")
    named = stored(named.select("key", "doc", F.coalesce("label", "doc").alias("label")))
    several = named.groupBy("key").agg(F.min("label").alias("low"), F.max("label").alias("high")).filter("low <> high")
    return stored(named.join(stored(several.select("key")), "key", "left_semi").distinct())


def _met_pairs(members: DataFrame, bits: DataFrame, how: Likeness) -> DataFrame:
    """Pairs of sets of one key in different components whose bitmaps allow a link; few come more than once.

    Rows (key, doc, label), and (doc, n, bits) of the sets. Sets of a key that fit one block meet in it; those of other
    keys are dealt into blocks, and an equal join on the key brings every two blocks together once. Alike sets share
    many keys. Each set brings its smallest ones, and a pair that shares a smaller key among those is left to that key:
    the smallest key two sets share always gives them, so none is lost.
    """
    first = members.groupBy("doc").agg(F.slice(F.sort_array(F.collect_list("key")), 1, FIRST_KEYS).alias("first"))
    bits = stored(bits.join(first, "doc"))
    counts = members.groupBy("key").agg(F.count(F.lit(1)).alias("members"))
    hot = stored(counts.filter(F.col("members") > BLOCK))
    sets = F.collect_list(F.struct("doc", "label", "n", "bits", "first")).alias("sets")
    small = members.join(hot, "key", "left_anti").join(bits, "doc").groupBy("key").agg(sets)
    block = F.pmod(F.xxhash64("doc"), F.ceil(F.col("members") / BLOCK))
    dealt = members.join(hot, "key").join(bits, "doc").groupBy("key", block.alias("block"))
    blocks = stored(dealt.agg(sets, F.min("label").alias("low"), F.max("label").alias("high")))
    other = blocks.select("key", *[F.col(c).alias(f"{c}_2") for c in ("block", "sets", "low", "high")])
    mixed_labels = ~((F.col("low") == F.col("high")) & (F.col("low_2") == F.col("high_2")) & (F.col("low") == F.col("low_2")))
    pairs = blocks.join(other, "key").filter((F.col("block") <= F.col("block_2")) & mixed_labels)

    def run(batches):
        for batch in batches:
            found_a, found_b = [], []
            for at in range(0, batch.num_rows, 8):
                for row in batch.slice(at, 8).to_pylist():
                    for a, b in alike(row["key"], row["sets"], row["sets_2"] or row["sets"], row["same"]):
                        found_a.append(min(a, b))
                        found_b.append(max(a, b))
            yield pa.RecordBatch.from_arrays([pa.array(found_a, pa.int64()), pa.array(found_b, pa.int64())], names=["a", "b"])

    def alike(key: int, one: list[dict], two: list[dict], same: bool):
        words = min(len(s["bits"]) for s in one + two) // 8
        matrix = [np.array([folded(np.frombuffer(s["bits"], np.uint64), words) for s in part]) for part in (one, two)]
        n, label, doc = (([np.array([s[c] for s in part]) for part in (one, two)]) for c in ("n", "label", "doc"))
        # the group's own key is none of the smaller ones, so it fills up short lists
        first = np.array([(s["first"] + [key] * FIRST_KEYS)[:FIRST_KEYS] for s in two], np.int64)
        for i in range(len(one)):
            ahead = (label[1] != label[0][i]) & (doc[1] > doc[0][i] if same else doc[1] != doc[0][i])
            only_a = np.bitwise_count(matrix[0][i] & ~matrix[1]).sum(axis=1).astype(np.int64)
            only_b = np.bitwise_count(matrix[1] & ~matrix[0][i]).sum(axis=1).astype(np.int64)
            common = np.minimum(n[0][i] - only_a, n[1] - only_b)
            found = np.flatnonzero(ahead & how.linked(common, n[0][i], n[1]))
            for j in found[~np.isin(first[found], [k for k in one[i]["first"] if k < key]).any(axis=1)]:
                yield int(doc[0][i]), int(doc[1][j])

    same = (F.col("block") == F.col("block_2")).alias("same")
    alone = small.select("key", "sets", F.lit(None).cast(dict(small.dtypes)["sets"]).alias("sets_2"), F.lit(True).alias("same"))
    return alone.mapInArrow(run, "a long, b long").union(pairs.select("key", "sets", "sets_2", same).mapInArrow(run, "a long, b long"))


def common_counts(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """Common shingles of every set on the left with every set on the right, as products of 0/1 matrices."""
    flat = [np.concatenate(side) for side in (left, right)]
    owner = [np.repeat(np.arange(len(side)), [len(s) for s in side]) for side in (left, right)]
    both = np.intersect1d(np.unique(flat[0]), np.unique(flat[1]), assume_unique=True)
    out = np.zeros((len(left), len(right)), np.int64)
    for at in range(0, len(both), COLUMNS):
        cut = both[at : at + COLUMNS]
        ones = []
        for items, who, n in zip(flat, owner, out.shape, strict=True):
            column = np.minimum(np.searchsorted(cut, items), len(cut) - 1)
            there = cut[column] == items
            ones.append(np.zeros((n, len(cut)), np.float32))
            ones[-1][who[there], column[there]] = 1
        out += (ones[0] @ ones[1].T).astype(np.int64)
    return out


def _link_counts(rows: DataFrame, classes: DataFrame, found: DataFrame, how: Likeness) -> DataFrame:
    """(doc, links): documents outside the class of `doc` whose sets link with its set, for the classes of components.

    Linked sets are in one component and in the same band of sizes or the next. The classes of a component and band are
    dealt into blocks; each two blocks that can hold links meet once, in a group of their own, and every pair of their
    classes is intersected there. A class counts with the ids it holds, so neither copies nor pairs become rows.
    """
    edges = F.array(*[F.lit(e).cast("long") for e in how.edges])
    plan = classes.select(F.col("rep").alias("doc"), F.col("n_shingles").alias("n"), "ids").join(
        found.select(F.col("node").alias("doc"), "component"), "doc"
    )
    plan = stored(plan.withColumn("band", F.size(F.filter(edges, lambda e: e <= F.col("n")))))
    blocks = F.ceil(F.greatest(F.count(F.lit(1)) / BLOCK, F.sum("n") / BLOCK_SHINGLES)).cast("int")
    bands = stored(plan.groupBy("component", "band").agg(F.count(F.lit(1)).alias("members"), blocks.alias("blocks")))
    around = bands
    for step, name in ((1, "above"), (-1, "below")):
        other = bands.select("component", (F.col("band") - step).alias("band"), F.col("blocks").alias(name))
        around = around.join(other, ["component", "band"], "left")
    plan = plan.join(around, ["component", "band"]).withColumn("block", F.pmod(F.xxhash64("doc"), F.col("blocks")).cast("int"))
    # groups (low band, block in it, step to the other band, block there), and the side of the class in it
    meets = """concat(
        if(members > 1, transform(sequence(0, blocks - 1), j -> named_struct('low', band, 'i', least(block, j), 'step', 0,
            'j', greatest(block, j), 'side', if(block <= j, 0, 1))), array()),
        if(above is not null, transform(sequence(0, above - 1), j -> named_struct('low', band, 'i', block, 'step', 1, 'j', j, 'side', 0)), array()),
        if(below is not null, transform(sequence(0, below - 1), j -> named_struct('low', band - 1, 'i', j, 'step', 1, 'j', block, 'side', 1)), array()))"""
    plan = stored(plan.select("doc", "ids", "component", F.expr(meets).alias("meets")).filter("size(meets) > 0"))

    def sets(batches):
        for doc_ids, made in _set_chunks(batches, how):
            items = [s.tobytes() for s in made]
            for at in range(0, len(items), BLOCK):
                cut = slice(at, at + BLOCK)
                yield pa.RecordBatch.from_arrays([pa.array(doc_ids[cut], pa.int64()), pa.array(items[cut], pa.binary())], names=["doc", "items"])

    def run(table: pa.Table) -> pa.Table:
        doc, ids, side = (table.column(c).to_numpy() for c in ("doc", "ids", "side"))
        items = [np.frombuffer(b, np.uint64) for b in table.column("items").to_pylist()]
        own = table.column("step")[0].as_py() == 0 and table.column("i")[0].as_py() == table.column("j")[0].as_py()
        one = np.flatnonzero(side == 0)
        two = one if own else np.flatnonzero(side == 1)
        links = np.zeros(len(doc), np.int64)
        if len(one) and len(two):
            n = np.array([len(s) for s in items], np.int64)
            common = common_counts([items[i] for i in one], [items[i] for i in two])
            linked = (common > 0) & how.linked(common, n[one][:, None], n[two][None, :])
            if own:
                np.fill_diagonal(linked, False)
            else:
                links[two] = ids[one] @ linked
            links[one] = linked @ ids[two]
        some = links > 0
        return pa.table({"doc": pa.array(doc[some]), "links": pa.array(links[some])})

    wanted = plan.select(F.col("doc").alias("doc_id")).distinct()
    texts = with_ids(rows, wanted)
    if not rows.filter("doc_id is not null").groupBy("doc_id").count().filter("count > 1").isEmpty():
        texts = texts.dropDuplicates(["doc_id"])
    met = texts.mapInArrow(sets, "doc long, items binary").join(plan, "doc")
    met = met.select("doc", "ids", "component", "items", F.inline("meets"))
    counted = met.groupBy("component", "low", "i", "step", "j").applyInArrow(run, "doc long, links long")
    return counted.groupBy("doc").agg(F.sum("links").alias("links"))


def linked_groups(
    docs: DataFrame, how: Likeness = Likeness(), id_col: str = "doc_id", text_col: str = "text", count_links: bool = False
) -> DataFrame:
    """doc_id, n_shingles and component_id of every row: the smallest id reachable over links, its own included.

    Words are runs without ASCII blanks, A-Z in lower case. A text of fewer words than a shingle is one shingle; null,
    empty and blank texts have none and link with nothing. Repeated rows stay and share a component; a null id
    has a null component and links with nothing; texts count whole; an empty table gives no rows; other columns are
    not read.

    Equal sets are one class at once. First every set is verified against one set of each key it shares (a star),
    and components are taken. Then only keys that still hold several components are left; there all blocks of sets
    meet, and pairs of different components that the bitmaps allow are verified. So all links that matter for
    the components are found, while a group of near copies costs about its size.

    With count_links there is also n_links: the number of other documents whose sets link with the row's. For that all
    classes of a component are compared, so a group costs the square of its different sets in work, not in rows.
    """
    before = written()
    rows = id_and_bytes(docs, id_col, text_col)
    table = stored(_set_table(rows, how))
    named = table.filter("doc_id is not null and n_shingles > 0")
    classes = named.groupBy("d1", "d2", "n_shingles").agg(F.min("doc_id").alias("rep"), F.count(F.lit(1)).alias("held"), F.count_distinct("doc_id").alias("ids"))
    classes = stored(classes) if count_links else classes.drop("ids")
    several = stored(classes.filter("held > 1").drop("held"))
    copies = stored(
        named.join(several.select("d1", "d2", "n_shingles", "rep"), ["d1", "d2", "n_shingles"]).filter("doc_id <> rep").select(F.col("doc_id").alias("doc"), "rep").distinct()
    )

    met = _meetings(rows, how)
    alone = F.col("near").isNull()
    met = met.withColumn("slot", F.when(alone, F.col("key")).otherwise(F.xxhash64("key", "doc"))).withColumn("alone", alone)
    slot = Window.partitionBy("slot", "alone")
    met = met.select("key", "doc", "near", "alone", F.min("doc").over(slot).alias("first"), F.count(F.lit(1)).over(slot).alias("n"))
    shared = stored(met.filter("n > 1 or not alone").select("key", "doc", F.coalesce("near", "first").alias("first")))

    def by_class(pairs: DataFrame, *columns: str) -> DataFrame:
        """Ids replaced by the smallest id with the same set."""
        for c in columns:
            other = copies.select(F.col("doc").alias(c), F.col("rep").alias("_rep"))
            pairs = pairs.join(other, c, "left").withColumn(c, F.coalesce("_rep", c)).drop("_rep")
        return pairs

    stars = by_class(shared.select(F.col("first").alias("a"), F.col("doc").alias("b")).filter("a <> b").distinct(), "a", "b")
    stars = stored(stars.filter("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())
    involved = stored(stars.select(F.col("a").alias("doc_id")).union(stars.select("b")).distinct())

    bits = _per_set(rows, involved, how, "bits")
    links = stored(_verified(stars, rows, bits, how))
    found = components(links)

    members = shared.select("key", "doc").union(shared.filter("first <> doc").select("key", F.col("first").alias("doc")))
    # again with other sets of each key that still holds several components, drawn by a hash
    left = _open_members(members, found, copies)
    for seed in range(ROUNDS):
        drawn = F.struct(F.xxhash64("doc", "key", F.lit(seed)).alias("h"), "doc", "label")
        pivots = stored(left.groupBy("key").agg(F.min(drawn).alias("pivot")))
        again = left.join(pivots, "key").filter("label <> pivot.label")
        again = again.select(F.least("doc", "pivot.doc").alias("a"), F.greatest("doc", "pivot.doc").alias("b")).distinct()
        links = stored(links.union(_verified(stored(again), rows, bits, how)))
        found = components(links)
        left = _open_members(left.select("key", "doc"), found, copies)
    # all pairs of different components in the keys that are left
    more = stored(_verified(stored(_met_pairs(left, bits, how).distinct()), rows, bits, how))
    if not more.isEmpty():
        found = components(links.union(more))

    columns = []
    if count_links:
        found = stored(found)
        counted = _link_counts(rows, classes, found, how)
        found = found.join(counted, F.col("node") == F.col("doc"), "left").drop("doc")
        links = F.coalesce("links", F.lit(0)) + F.coalesce("ids", F.lit(1)) - 1
        columns = [F.when(F.col("doc_id").isNotNull() & (F.col("n_shingles") > 0), links).otherwise(0).alias("n_links")]
    found = stored(found)
    out = table.join(several, ["d1", "d2", "n_shingles"], "left")
    own = F.when(F.col("n_shingles") > 0, F.coalesce("rep", "doc_id")).otherwise(F.col("doc_id"))
    linked = F.when(F.col("n_shingles") > 0, F.coalesce("component", "own")).otherwise(F.col("doc_id"))
    out = (
        out.withColumn("own", own)
        .join(found, F.col("own") == F.col("node"), "left")
        .select("doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), linked).alias("component_id"), *columns)
    )
    release(rows.sparkSession, before, out, docs)
    return out
