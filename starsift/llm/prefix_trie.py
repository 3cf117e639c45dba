"""The trie of conversation prefixes: a skeleton of splitter paths, local sorted shards for all other nodes."""

from __future__ import annotations

import hashlib
from bisect import bisect_right
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starsift.llm.common import stored

#: Characters of a turn in a path: 128 bits of SHA-256 of role and text.
KEY = 32
#: Sampled paths for each shard.
SAMPLES = 32
#: Conversation ids whose high bits agree share a row of the list of endings.
ID_BLOCK = 12
#: Turns a conversation may share with the first of its five.
MOST_SHARED = 8


def turn_rows(conversations: DataFrame, id_col="conv_id", turn_col="turn", role_col="role", text_col="text") -> DataFrame:
    """conv_id and its turns in order as array<struct<turn, role, key, size>>; text stays behind as a key and its bytes."""
    role, text = F.coalesce(F.col(role_col).cast("string"), F.lit("")), F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    whole = F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)
    turn = F.struct(
        F.col(turn_col).cast("long").alias("turn"), role.alias("role"), F.substring(F.sha2(whole, 256), 1, KEY).alias("key"),
        F.octet_length(text).cast("long").alias("size"),
    )
    rows = conversations.select(F.col(id_col).cast("long").alias("conv_id"), turn.alias("t")).filter("conv_id is not null")
    return rows.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("turns"))


def rebuilt(turns: DataFrame) -> DataFrame:
    """conv_id, path and sizes: the first h turns of the first of five conversations, then the own ones after the first h."""
    h = F.pmod(F.crc32(F.col("conv_id").cast("string").cast("binary")), F.lit(MOST_SHARED + 1)).cast("int")
    own = turns.select("conv_id", "turns", h.alias("h"), (F.col("conv_id") - F.col("conv_id") % 5).alias("base"))
    first = turns.select(F.col("conv_id").alias("base"), F.slice("turns", 1, MOST_SHARED).alias("given"))
    none = F.slice("turns", 1, 0)
    given = F.slice(F.coalesce("given", none), F.lit(1), F.col("h"))
    after = F.slice("turns", F.col("h") + 1, F.greatest(F.size("turns") - F.col("h"), F.lit(0)))
    whole = own.join(first, "base", "left").select("conv_id", F.concat(given, after).alias("all"))
    return whole.select("conv_id", F.array_join("all.key", "").alias("path"), F.col("all.size").alias("sizes"))


def endings(paths: DataFrame) -> DataFrame:
    """path id and the digest of the ascending ids that end there, fed block by block, so no list is held whole."""
    blocks = paths.groupBy("pid", F.shiftright("conv_id", ID_BLOCK).alias("block"))
    blocks = blocks.agg(F.array_join(F.sort_array(F.collect_list("conv_id")).cast("array<string>"), ",").alias("ids"))

    def digest(batches):
        now, state = None, None
        for batch in batches:
            done: list = []
            for pid, ids in zip(batch.column("pid").to_pylist(), batch.column("ids").to_pylist(), strict=True):
                if pid != now:
                    if state is not None:
                        done.append((now, state.hexdigest()))
                    now, state = pid, hashlib.sha256(ids.encode())
                else:
                    state.update(b"," + ids.encode())
            yield pa.RecordBatch.from_arrays([pa.array([d[i] for d in done], pa.string()) for i in (0, 1)], names=["pid", "ends"])
        if state is not None:
            yield pa.RecordBatch.from_arrays([pa.array([now]), pa.array([state.hexdigest()])], names=["pid", "ends"])

    return blocks.repartition("pid").sortWithinPartitions("pid", "block").select("pid", "ids").mapInArrow(digest, "pid string, ends string")


def shared_turns(a: str, b: str) -> int:
    """Turns two paths have in common from the root on."""
    most = min(len(a), len(b)) // KEY
    if a[: most * KEY] == b[: most * KEY]:
        return most
    low, high = 0, most - 1
    while low < high:
        middle = (low + high + 1) // 2
        if a[: middle * KEY] == b[: middle * KEY]:
            low = middle
        else:
            high = middle - 1
    return low


@dataclass
class Skeleton:
    """The trie of the splitters: node k hangs on parent[k] by a turn; the root is node 0."""

    splitters: list[str]
    child: dict = field(default_factory=dict)
    parent: list[int] = field(default_factory=lambda: [-1])

    def __post_init__(self):
        for path in self.splitters:
            node = 0
            for at in range(0, len(path), KEY):
                key = (node, path[at : at + KEY])
                if key not in self.child:
                    self.child[key] = len(self.parent)
                    self.parent.append(node)
                node = self.child[key]

    def shard(self, path: str) -> int:
        return bisect_right(self.splitters, path)


def splitters_of(sample: list[str], shards: int) -> list[str]:
    """Paths that part the sample evenly, each cut after the turn that tells it from the sampled path before it."""
    sample = sorted(set(sample))
    out = []
    for i in range(1, shards):
        at = i * len(sample) // shards
        if at:
            out.append(sample[at][: (shared_turns(sample[at - 1], sample[at]) + 1) * KEY])
    return sorted(set(out))


class _Open:
    """A node on the path that is being read; what hangs below it is added as it closes."""

    __slots__ = ("children", "ends", "first", "leaves", "n", "node", "saved", "size", "waiting")

    def __init__(self, size: int, node: int | None):
        self.size, self.node = size, node
        self.n = self.children = self.leaves = self.saved = 0
        self.first, self.ends, self.waiting = None, None, []


NODE = "node int, above int, conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved long, size long, ends string"
NAMES = [f.split()[0] for f in NODE.split(", ")]


def shard_nodes(rows, skeleton: Skeleton):
    """Nodes of a task's shards, whose paths come in order.

    Other nodes than the skeleton's come finished: no splitter begins with their path, so all their members are in one
    shard. They name their parent's smallest member (known once the parent closes) or, in `above`, a skeleton node.
    Skeleton nodes come once per shard with what the shard knows of them; leaves and savings of finished nodes under
    them are theirs, those of skeleton nodes below are not added yet.
    """
    stack: list[_Open] = []
    last, shard = "", None

    def close():
        top = stack.pop()
        over = stack[-1] if stack else None
        depth = len(stack)
        if top.node is not None:
            yield (top.node, None, top.first, depth, None, top.n, top.children, top.leaves, top.saved, top.size, top.ends)
        else:
            if not top.children:
                top.leaves = 1
            top.saved += (top.n - 1) * top.size
            for row in top.waiting:
                yield (*row[:4], top.first, *row[5:])
            row = (None, over.node, top.first, depth, None, top.n, top.children, top.leaves, top.saved, top.size, top.ends)
            if over.node is None:
                over.waiting.append(row)
            else:
                yield row
            over.children += 1
            over.leaves += top.leaves
            over.saved += top.saved
        if over is not None:
            over.n += top.n
            over.first = top.first if over.first is None else min(over.first, top.first)

    for own, path, sizes, n, first, ends in rows:
        keep = shared_turns(last, path) + 1 if own == shard else 0
        while len(stack) > keep:
            yield from close()
        if own != shard:
            around = skeleton.splitters[max(own - 1, 0) : own + 1]
            shard = own
        known = max((shared_turns(s, path) for s in around), default=0)
        if not stack:
            stack.append(_Open(0, 0))
        node = stack[-1].node
        for depth in range(len(stack), len(path) // KEY + 1):
            node = skeleton.child[node, path[(depth - 1) * KEY : depth * KEY]] if depth <= known else None
            stack.append(_Open(sizes[depth - 1], node))
        top = stack[-1]
        top.n += n
        top.first = first if top.first is None else min(top.first, first)
        top.ends = ends
        last = path
    while stack:
        yield from close()


def prefix_trie(
    conversations: DataFrame, id_col="conv_id", turn_col="turn", role_col="role", text_col="text", shards: int | None = None
) -> DataFrame:
    """One row per node of the trie of rebuilt conversations: conv_id (its smallest member), depth, parent_conv_id, n_convs,
    n_children, n_leaves, saved_tokens and ends_sha256.

    Conversations are rebuilt by `rebuilt`. Turns go by turn, null first, then role, then the digest of role and text;
    null role or text counts as empty; repeated rows are repeated turns. Rows without a conversation id are left out; a
    table without ids has no members, so no root and no rows; other columns are not read. A conversation is one row, as
    a document is. Turns are equal when 128 bits of their SHA-256 are.

    Equal conversations are one path with their number, so copies do not meet in a shard. Paths are range-partitioned by
    splitters from a sample bounded by `SAMPLES` for each shard; the trie of the splitters is broadcast. Sorted shards
    finish all other nodes in one pass; partial aggregates of skeleton nodes are reduced over shards, then up the skeleton.
    """
    spark = conversations.sparkSession
    turns = stored(turn_rows(conversations, id_col, turn_col, role_col, text_col))
    whole = stored(rebuilt(turns).withColumn("pid", F.sha2("path", 256)))
    distinct = whole.groupBy("pid").agg(
        F.first("path").alias("path"), F.first("sizes").alias("sizes"), F.count(F.lit(1)).alias("n"), F.min("conv_id").alias("first")
    )
    paths = stored(distinct.join(endings(whole.select("pid", "conv_id")), "pid"))
    shards = shards or int(spark.conf.get("spark.sql.shuffle.partitions"))
    drawn = paths.select("path", "pid").orderBy(F.xxhash64("pid"), "pid").limit(SAMPLES * shards).select("path")
    skeleton = Skeleton(splitters_of([r.path for r in drawn.collect()], shards))
    sent = spark.sparkContext.broadcast(skeleton)  # bounded by the sampled paths

    def to_shards(batches):
        for batch in batches:
            own = [sent.value.shard(p) for p in batch.column("path").to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(own, pa.int32()), *batch.columns], names=["shard", *batch.schema.names])

    def local(batches):
        def rows():
            for batch in batches:
                for at in range(0, batch.num_rows, 256):
                    yield from zip(*[c.to_pylist() for c in batch.slice(at, 256).columns], strict=True)

        kinds = [pa.int32(), pa.int32(), *[pa.int64()] * 8, pa.string()]
        held = []

        def packed():
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*held, strict=True), kinds, strict=True)], names=NAMES)

        for row in shard_nodes(rows(), sent.value):
            held.append(row)
            if len(held) == 4096:
                yield packed()
                held = []
        if held:
            yield packed()

    parts = ["path", "sizes", "n", "first", "ends"]
    kinds = "shard int, path string, sizes array<long>, n long, first long, ends string"
    dealt = paths.select(*parts).mapInArrow(to_shards, kinds).repartition(shards, "shard").sortWithinPartitions("shard", "path")
    nodes = stored(dealt.mapInArrow(local, NODE))
    return finished(nodes, skeleton)


def finished(nodes: DataFrame, skeleton: Skeleton) -> DataFrame:
    """The rows of all nodes; partial aggregates of skeleton nodes are reduced over shards, then up the skeleton.

    One row per skeleton node reaches the driver, which made the skeleton: bounded by the sampled paths.
    """
    partial = nodes.filter("node is not null").groupBy("node")
    reduced = partial.agg(
        F.min("conv_id").alias("first"), F.first("depth").alias("depth"), F.sum("n_convs").alias("n"), F.sum("n_children").alias("children"),
        F.sum("n_leaves").alias("leaves"), F.sum("saved").alias("saved"), F.max("size").alias("size"), F.max("ends").alias("ends"),
    )
    held = {r.node: r.asDict() for r in reduced.collect()}
    # every skeleton node is a prefix of a sampled path, so it has members; children come after their parents
    for k in sorted(held, reverse=True):
        own = held[k]
        own["leaves"] += not own["children"]
        own["saved"] += (own["n"] - 1) * own["size"]
        if over := held.get(skeleton.parent[k]):
            own["over"] = over["first"]
            for name, more in (("children", 1), ("leaves", own["leaves"]), ("saved", own["saved"])):
                over[name] += more
    columns = ("first", "depth", "over", "n", "children", "leaves", "saved", "ends")
    names = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends")
    schema = "node int, " + ", ".join(f"{n} {'string' if n == 'ends' else 'long'}" for n in names)
    skeletal = nodes.sparkSession.createDataFrame([(k, *[own.get(c) for c in columns]) for k, own in held.items()], schema)
    over = F.broadcast(skeletal.select(F.col("node").alias("above"), F.col("conv_id").alias("over")))
    local = nodes.filter("node is null").join(over, "above", "left")
    local = local.withColumn("parent_conv_id", F.coalesce("parent_conv_id", "over")).withColumn("saved_tokens", F.col("saved"))
    ends = F.coalesce("ends", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256")
    return local.select(*names[:-1], ends).union(skeletal.select(*names[:-1], ends))
