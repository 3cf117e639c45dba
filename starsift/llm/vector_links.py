"""Near copies among vectors: Euclidean p-stable hashing of unit vectors, then exact cosines."""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starsift.llm.common import mixed, stored
from starsift.llm.components import components

#: Chance that a pair exactly at the least cosine meets in no table; nearer pairs meet far more surely.
MISS = 1e-3
#: Vectors without likeness that a vector meets in a table, about.
STRANGERS = 64
#: Width of a hash bucket in distances of the least cosine.
WIDTH = 4.0
#: Rounds in which vectors of dense groups gather around a centre.
ROUNDS = 4
#: Coordinates of a sketch, one byte each.
SKETCH = 24
#: Rows of a bucket, and members of a ball, that one block holds.
BLOCK, MEMBERS = 2048, 512
#: Rounding allowed for in angles.
SLACK = 1e-6


def meeting(distance: float, width: float) -> float:
    """Chance that one quantised gaussian projection puts two points at this distance into one bucket."""
    r = width / distance
    below = math.erf(r / math.sqrt(2)) - 2 / (math.sqrt(2 * math.pi) * r) * (1 - math.exp(-r * r / 2))
    return min(max(below, 1e-9), 1 - 1e-9)


@dataclass(frozen=True)
class Hashing:
    """`tables` keys to a vector, each of `hashes` projections floor((a . u + b) / width) of the unit vector u."""

    tables: int
    hashes: int
    width: float
    seed: int

    @staticmethod
    def planned(least: float, rows: int, strangers: float, miss: float, seed: int) -> Hashing:
        """Hashes grow with the logarithm of the rows, so that buckets do not; tables follow from the chance to miss."""
        distance = math.sqrt(2 - 2 * least)
        width = WIDTH * distance
        near, far = meeting(distance, width), meeting(math.sqrt(2), width)
        hashes = max(1, math.ceil(math.log(max(rows / strangers, 1.0)) / -math.log(far)))
        tables = max(1, math.ceil(math.log(miss) / math.log1p(-(near**hashes))))
        return Hashing(tables, hashes, width, seed)

    def keys(self, unit: np.ndarray, labels: np.ndarray) -> np.ndarray:
        """One 64-bit key per row and table; rows of other labels or lengths have other keys."""
        rng = np.random.default_rng([self.seed, unit.shape[1]])
        lines = rng.standard_normal((unit.shape[1], self.tables * self.hashes))
        shift = rng.uniform(0, self.width, self.tables * self.hashes)
        odd = rng.integers(0, 2**63, (self.tables, self.hashes), np.uint64) * np.uint64(2) + np.uint64(1)
        start = rng.integers(0, 2**63, self.tables, np.uint64)
        out = np.empty((len(unit), self.tables), np.uint64)
        for at in range(0, len(unit), 1024):
            cells = np.floor((unit[at : at + 1024] @ lines + shift) / self.width).astype(np.int64).view(np.uint64)
            own = mixed(labels[at : at + 1024].view(np.uint64))[:, None]
            out[at : at + 1024] = mixed((cells.reshape(-1, self.tables, self.hashes) * odd).sum(axis=2) + start + own)
        return out.view(np.int64)


def by_length(column: pa.ListArray):
    """(row numbers, unit vectors) of the vectors of each length."""
    flat = np.asarray(column.flatten(), np.float64)
    sizes = np.asarray(column.value_lengths())
    begins = np.cumsum(sizes) - sizes
    for size in np.unique(sizes):
        at = np.flatnonzero(sizes == size)
        x = flat[begins[at][:, None] + np.arange(size)]
        yield at, x / np.linalg.norm(x, axis=1, keepdims=True)


def sketches(unit: np.ndarray, seed: int) -> np.ndarray:
    """Coordinates along orthonormal lines as signed bytes: their distance is at most the vectors', but for rounding."""
    lines = np.linalg.qr(np.random.default_rng([seed, unit.shape[1]]).standard_normal((unit.shape[1], unit.shape[1])))[0]
    out = np.zeros((len(unit), SKETCH), np.int8)
    coordinates = unit @ lines[:, :SKETCH]
    out[:, : coordinates.shape[1]] = np.rint(coordinates * 127)
    return out


def sketch_pairs(a: tuple, b: tuple, angle: float) -> tuple[np.ndarray, np.ndarray]:
    """Places in a and b of balls whose sketches allow a link: (ids, sketches, radii) against (ids, sketches, radii)."""
    x, y = a[1].astype(np.float32), b[1].astype(np.float32)
    apart = (x * x).sum(axis=1)[:, None] + (y * y).sum(axis=1)[None, :] - 2 * (x @ y.T)
    reach = np.minimum(angle + a[2][:, None] + b[2][None, :], math.pi)
    limit = 127 * 2 * np.sin(reach / 2) + math.sqrt(SKETCH) + SLACK
    return np.nonzero((apart <= limit * limit + 0.5) & (a[0][:, None] != b[0][None, :]))


def dot(a: Column, b: Column) -> Column:
    products = F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double"))
    return F.aggregate(products, F.lit(0.0), lambda s, x: s + x)


def cosine(a: str, b: str) -> Column:
    return dot(F.col(f"{a}.vector"), F.col(f"{b}.vector")) / (F.col(f"{a}.norm") * F.col(f"{b}.norm"))


def same_kind(a: str, b: str) -> Column:
    """Equal labels and equally long vectors."""
    return (F.col(f"{a}.label") == F.col(f"{b}.label")) & (F.size(f"{a}.vector") == F.size(f"{b}.vector"))


def angle_of(cos: Column) -> Column:
    return F.acos(F.least(F.lit(1.0), F.greatest(F.lit(-1.0), cos)))


def usable_vectors(named: DataFrame) -> DataFrame:
    """Rows that can link: a label and a vector that is neither zero nor holds null or non-finite parts.

    Parts are divided by the largest one where squares of doubles could leave their range.
    """
    v = F.col("vector")
    rows = named.filter("label is not null and vector is not null")
    rows = rows.filter(F.forall(v, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf"))))
    rows = rows.filter(F.exists(v, lambda c: c != 0))
    if dict(rows.dtypes)["vector"] == "array<double>":
        top = F.array_max(F.transform(v, lambda c: F.abs(c)))
        wild = (top > 1e100) | (top < 1e-100)
        rows = rows.withColumn("vector", F.when(wild, F.transform(v, lambda c: c / top)).otherwise(v))
    return rows


def gathered(classes: DataFrame, hashing: Hashing, half: float) -> DataFrame:
    """(id, ball, centre, off) of vectors that stand within `half` of the centre they gathered around, the centre left out.

    In each round the vectors still standing for themselves are hashed; those near the smallest id of their bucket go to
    it. A bucket's smallest row is found by partial aggregation, and the join with it is one row on one side, so a
    bucket with a third of the rows is split by adaptive execution.
    """
    kind = dict(classes.dtypes)["vector"]
    label = dict(classes.dtypes)["label"]
    centres = classes.select("id", "label", "vector", "norm")
    roots = None
    for turn in range(ROUNDS):
        table = Hashing(1, hashing.hashes, hashing.width, hashing.seed + 1 + turn)

        def to_bucket(batches, table=table):
            for batch in batches:
                key = np.zeros(batch.num_rows, np.int64)
                hashed = np.asarray(batch.column("kind"))
                for at, unit in by_length(batch.column("vector")):
                    key[at] = table.keys(unit, hashed[at])[:, 0]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(key), *[batch.column(c) for c in ("id", "label", "vector", "norm")]], names=["key", "id", "label", "vector", "norm"]
                )

        schema = f"key long, id long, label {label}, vector {kind}, norm double"
        keyed = centres.withColumn("kind", F.xxhash64("label")).mapInArrow(to_bucket, schema)
        first = F.min_by(F.struct("id", "label", "vector", "norm"), "id")
        pivots = keyed.groupBy("key").agg(first.alias("p"), F.count(F.lit(1)).alias("n")).filter("n > 1").select("key", "p")
        close = angle_of(cosine("v", "p")) <= half - SLACK
        moves = stored(
            keyed.select("key", F.struct("id", "label", "vector", "norm").alias("v"))
            .join(pivots, "key")
            .filter("v.id <> p.id")
            .filter(same_kind("v", "p") & close)
            .select(F.col("v.id").alias("id"), F.col("p.id").alias("parent"))
        )
        if moves.isEmpty():
            continue
        centres = centres.join(moves, "id", "left_anti")
        step = moves.select(F.col("id").alias("root"), F.col("parent").alias("next"))
        if roots is None:
            roots = moves.select("id", F.col("parent").alias("root"))
        else:
            roots = roots.join(step, "root", "left").select("id", F.coalesce("next", "root").alias("root"))
            new = moves.select("id", F.col("parent").alias("root")).join(roots.select("id"), "id", "left_anti")
            roots = roots.union(new)
    empty = f"id long, ball long, centre {kind}, off double"
    if roots is None:
        return classes.sparkSession.createDataFrame([], empty)
    row = F.struct("id", "label", "vector", "norm")
    both = (
        classes.select(F.col("id"), row.alias("v")).join(roots, "id").join(classes.select(F.col("id").alias("root"), row.alias("p")), "root")
    )
    off = angle_of(cosine("v", "p"))
    near = both.filter(same_kind("v", "p")).withColumn("off", off).filter(F.col("off") <= half - SLACK)
    return stored(near.select("id", F.col("root").alias("ball"), F.col("p.vector").alias("centre"), "off"))


def near_vectors(
    rows: DataFrame, least: float = 0.93, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", miss: float = MISS,
    seed: int = 11,
) -> DataFrame:
    """vec_id, n_links (other vectors linked directly), component_id (smallest id reachable by links) and kept of every id.

    Two vectors link when their labels are equal and not null, they are equally long and their cosine (of the given
    numbers, in double precision) is at least `least`. Null and zero vectors and those with null or non-finite parts
    link with nothing. Of rows that share an id the one of largest label, then largest vector stands. Rows without an
    id link with nothing and come back with null ids; an empty table gives no rows; other columns are not read.

    Equal vectors are one class with a weight. Vectors of dense groups gather around centres: members within half the
    linking angle of a centre all link with each other, so such a ball is counted, never paired. Every vector is hashed
    in all tables, with `miss` as the chance that a pair exactly at `least` meets in none; a bucket holds each ball once,
    with a sketch whose distance bounds the vectors' from below. Blocks of a bucket are compared by sketch, hot buckets
    tile by tile. Balls that sketches leave are compared by exact cosines: the angle of centres decides for all members,
    or else members are compared in blocks and only counted.
    """
    theta = math.acos(least)
    kind = "array<float>" if dict(rows.dtypes)[vector_col] == "array<float>" else "array<double>"
    given = rows.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast(kind).alias("vector"), F.col(label_col).alias("label"))
    nameless = given.filter("vec_id is null")
    named = given.filter("vec_id is not null").groupBy("vec_id").agg(F.max(F.struct("label", "vector")).alias("r")).select("vec_id", "r.*")
    usable = usable_vectors(named)
    classes = stored(
        usable.groupBy("label", "vector")
        .agg(F.min("vec_id").alias("id"), F.count(F.lit(1)).alias("weight"))
        .select("id", "label", "vector", F.sqrt(dot(F.col("vector"), F.col("vector"))).alias("norm"), "weight")
    )
    copies = usable.join(classes.filter("weight > 1").select("label", "vector", "id"), ["label", "vector"]).filter("vec_id <> id")
    copies = copies.select("vec_id", F.col("id").alias("rep"))
    largest = classes.groupBy("label").agg(F.count(F.lit(1)).alias("n")).agg(F.max("n").alias("n")).first().n or 0
    hashing = Hashing.planned(least, largest, STRANGERS, miss, seed)
    tight = Hashing.planned(least, largest, 1, miss, seed)

    moved = gathered(classes, tight, theta / 2)
    centre_weight = classes.select(F.col("id").alias("ball"), F.col("weight").alias("own"))
    dense = (
        moved.join(classes.select("id", "weight"), "id")
        .groupBy("ball")
        .agg(F.max("off").alias("radius"), F.count(F.lit(1)).alias("n"), F.sum("weight").alias("w"))
        .join(centre_weight, "ball")
        .select("ball", "radius", (F.col("n") + 1).alias("members"), (F.col("w") + F.col("own")).alias("heavy"))
    )
    dense = stored(dense)
    placed = classes.join(moved, "id", "left").withColumn("ball", F.coalesce("ball", "id"))
    placed = placed.join(dense, "ball", "left").select(
        "id", "label", "vector", "norm", "weight", "ball", "centre", F.coalesce("radius", F.lit(0.0)).alias("radius"),
        F.coalesce("members", F.lit(1)).alias("members"), F.coalesce("heavy", "weight").alias("heavy"),
    )
    placed = stored(placed)
    pairs = stored(_candidates(placed, hashing, theta))

    centres = placed.filter("id = ball").select("ball", F.struct("ball", "label", "vector", "norm", "radius", "members", "heavy").alias("c"))
    decided = (
        pairs.join(centres.select(F.col("ball").alias("a"), F.col("c").alias("x")), "a")
        .join(centres.select(F.col("ball").alias("b"), F.col("c").alias("y")), "b")
        .filter(same_kind("x", "y"))
        .withColumn("cos", cosine("x", "y"))
    )
    reach = F.col("x.radius") + F.col("y.radius")
    single = (F.col("x.members") == 1) & (F.col("y.members") == 1)
    sure = F.when(single, F.col("cos") >= least).otherwise(angle_of(F.col("cos")) + reach <= theta - SLACK)
    open_ = ~single & ~sure & (angle_of(F.col("cos")) <= theta + reach + SLACK)
    decided = stored(
        decided.select(
            "a", "b", sure.alias("sure"), open_.alias("open"), F.col("x.heavy").alias("wa"), F.col("y.heavy").alias("wb"),
            F.col("x.members").alias("ma"), F.col("y.members").alias("mb"),
        ).filter("sure or open")
    )
    certain = decided.filter("sure")
    partial = stored(_member_links(decided.filter("open and not sure"), placed, least))
    edges = certain.select("a", "b").union(partial.filter("a is not null").select("a", "b"))

    found = components(edges)
    by_ball = certain.select(F.col("a").alias("ball"), F.col("wb").alias("n")).union(certain.select("b", "wa"))
    by_ball = by_ball.groupBy("ball").agg(F.sum("n").alias("outer"))
    by_id = partial.filter("id is not null").groupBy("id").agg(F.sum("n").alias("inner"))
    linked = (
        placed.select("id", "ball", "heavy")
        .join(by_ball, "ball", "left")
        .join(found.select(F.col("node").alias("ball"), "component"), "ball", "left")
        .join(by_id, "id", "left")
        .select(
            F.col("id").alias("rep"),
            (F.col("heavy") - 1 + F.coalesce("outer", F.lit(0)) + F.coalesce("inner", F.lit(0))).alias("n"),
            F.coalesce("component", "ball").alias("component"),
        )
        .filter("n > 0")
    )
    out = named.select("vec_id").union(nameless.select("vec_id")).join(copies, "vec_id", "left")
    out = out.withColumn("rep", F.coalesce("rep", "vec_id")).join(linked, "rep", "left")
    component = F.coalesce("component", "vec_id")
    return out.select(
        "vec_id", F.coalesce("n", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"),
        (F.col("vec_id") == component).alias("kept"),
    )


def _candidates(placed: DataFrame, hashing: Hashing, theta: float) -> DataFrame:
    """Pairs of balls (a < b) that share a bucket and whose sketches allow a link."""
    seed = hashing.seed

    def to_buckets(batches):
        for batch in batches:
            hashed, balls = np.asarray(batch.column("kind")), np.asarray(batch.column("ball"))
            radii = np.asarray(batch.column("radius"))
            sketch = np.zeros((batch.num_rows, SKETCH), np.int8)
            keys = np.zeros((batch.num_rows, hashing.tables), np.int64)
            for at, unit in by_length(batch.column("vector")):
                keys[at] = hashing.keys(unit, hashed[at])
            for at, unit in by_length(batch.column("seen")):
                sketch[at] = sketches(unit, seed)
            for t in range(hashing.tables):
                order = np.lexsort((balls, keys[:, t]))
                k, b = keys[order, t], balls[order]
                new = np.ones(len(k), bool)
                new[1:] = (k[1:] != k[:-1]) | (b[1:] != b[:-1])
                at = order[new]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(k[new]), pa.array(b[new]), pa.array([s.tobytes() for s in sketch[at]], pa.binary()), pa.array(radii[at].astype(np.float32))],
                    names=["key", "ball", "sketch", "radius"],
                )

    source = placed.select("ball", "radius", "vector", F.coalesce("centre", "vector").alias("seen"), F.xxhash64("label").alias("kind"))
    hashed = stored(source.mapInArrow(to_buckets, "key long, ball long, sketch binary, radius float"))
    hot = hashed.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > BLOCK)
    hot = stored(hot.select("key", F.ceil(F.col("n") / BLOCK).alias("parts")))
    dealt = hashed.join(hot, "key", "left").withColumn("parts", F.coalesce("parts", F.lit(1)))
    dealt = dealt.withColumn("part", F.pmod(F.xxhash64("ball"), F.col("parts")))
    blocks = dealt.groupBy("key", "part", "parts").agg(F.collect_list(F.struct("ball", "sketch", "radius")).alias("rows"))

    def block_of(rows) -> tuple:
        ids = np.asarray(rows.field("ball"))
        ids, first = np.unique(ids, return_index=True)
        flat = np.frombuffer(b"".join(rows.field("sketch").to_pylist()), np.int8).reshape(-1, SKETCH)
        return ids, flat[first], np.asarray(rows.field("radius"), np.float64)[first] + SLACK

    def paired(found):
        a, b = np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found])
        both = np.unique(np.stack([np.minimum(a, b), np.maximum(a, b)]), axis=1)
        return pa.RecordBatch.from_arrays([pa.array(both[0]), pa.array(both[1])], names=["a", "b"])

    def within(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                own = block_of(batch.column("rows")[i].values)
                p, q = sketch_pairs(own, own, theta)
                if len(p):
                    yield paired([(own[0][p], own[0][q])])

    def across(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                both = batch.column("blocks")[i].values
                x, y = (block_of(both.field("rows")[j].values) for j in (0, 1))
                p, q = sketch_pairs(x, y, theta)
                if len(p):
                    yield paired([(x[0][p], y[0][q])])

    # a bucket of one row pairs with nothing; hot buckets go as blocks to each of their tiles
    alone = blocks.filter("size(rows) > 1").select("rows").mapInArrow(within, "a long, b long")
    other = F.explode(F.sequence(F.lit(0), F.col("parts") - 1))
    tiles = blocks.filter("parts > 1").select("key", "part", "rows", other.alias("other")).filter("part <> other")
    tiles = tiles.groupBy("key", F.least("part", "other").alias("lo"), F.greatest("part", "other").alias("hi"))
    tiles = tiles.agg(F.collect_list(F.struct("rows")).alias("blocks")).filter("size(blocks) = 2")
    return alone.union(tiles.select("blocks").mapInArrow(across, "a long, b long")).distinct()


def _member_links(open_pairs: DataFrame, placed: DataFrame, least: float) -> DataFrame:
    """Links between members of two balls: (id, n) of members with links, and (a, b) of balls with one."""
    sides = open_pairs.select(F.col("a").alias("ball")).union(open_pairs.select("b")).distinct()
    parts = F.ceil(F.col("members") / MEMBERS)
    members = placed.join(sides, "ball").withColumn("part", F.pmod(F.xxhash64("id"), parts))
    blocks = members.groupBy("ball", "part").agg(F.collect_list(F.struct("id", "vector", "norm", "weight")).alias("rows"))
    blocks = stored(blocks)

    def dealt(side: str, count: str) -> Column:
        return F.explode(F.sequence(F.lit(0).cast("long"), F.ceil(F.col(count) / MEMBERS) - 1)).alias(f"p{side}")

    tiles = open_pairs.select("a", "b", "mb", dealt("a", "ma")).select("a", "b", "pa", dealt("b", "mb"))
    tiles = tiles.join(blocks.select(F.col("ball").alias("a"), F.col("part").alias("pa"), F.col("rows").alias("x")), ["a", "pa"])
    tiles = tiles.join(blocks.select(F.col("ball").alias("b"), F.col("part").alias("pb"), F.col("rows").alias("y")), ["b", "pb"])

    def side(rows):
        ids = np.asarray(rows.field("id"))
        x = np.asarray(rows.field("vector").flatten(), np.float64).reshape(len(ids), -1)
        return ids, x, np.asarray(rows.field("norm")), np.asarray(rows.field("weight"))

    def compare(batches):
        for batch in batches:
            ids, counts, a, b = [], [], [], []
            for i in range(batch.num_rows):
                x, y = side(batch.column("x")[i].values), side(batch.column("y")[i].values)
                linked = (x[1] @ y[1].T) / (x[2][:, None] * y[2][None, :]) >= least
                for own, n in ((x[0], linked @ y[3]), (y[0], x[3] @ linked)):
                    ids += own[n > 0].tolist()
                    counts += n[n > 0].tolist()
                if linked.any():
                    a.append(batch.column("a")[i].as_py())
                    b.append(batch.column("b")[i].as_py())
            nothing, none = [None] * len(a), [None] * len(ids)
            columns = [ids + nothing, counts + nothing, none + a, none + b]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["id", "n", "a", "b"])

    return tiles.select("a", "b", "x", "y").mapInArrow(compare, "id long, n long, a long, b long")
