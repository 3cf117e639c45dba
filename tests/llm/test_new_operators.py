"""Prefix trie, lexical search and vector links against plain versions, on real rows and on tables of odd rows."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import duckdb
import numpy as np
import pytest
from brute import components, lower
from compare import compare, connect

from starsift.llm import queries as Q
from starsift.llm.lexical_search import ranked_documents, terms_of
from starsift.llm.prefix_trie import KEY, Skeleton, prefix_trie, shared_turns, splitters_of
from starsift.llm.vector_links import Hashing, meeting, near_vectors

TURNS = "conv_id long, turn long, role string, text string, key string, node int, path string, n int, first long"
TEXTS = "doc_id long, text string, n long, at array<int>, score int, item_id string"
ITEMS = "item_id long, text string, doc_id string, rank int"
VECTORS = "vec_id long, embedding array<float>, label string, ball long, key int, id long, weight int"


@pytest.mark.parametrize("name", ["op11_prefix_trie", "op12_lexical_search"])
def test_same_rows_as_sql(spark, sf_dir, name):
    assert compare(spark, connect(sf_dir), name, Q.QUERIES[name], Q.ORACLE[name], sf_dir) == []


# -- prefix trie


def plain_trie(rows):
    convs = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            key = hashlib.sha256(f"{len((role or '').encode())}:{role or ''}{text or ''}".encode()).hexdigest()
            convs.setdefault(conv, []).append(((turn is not None, turn or 0), role or "", key, text or ""))
    convs = {c: [(r, t) for _, r, _, t in sorted(v)] for c, v in convs.items()}
    new = {}
    for c, own in convs.items():
        h = zlib.crc32(str(c).encode()) % 9
        new[c] = convs.get(c - c % 5, [])[:h] + own[h:]
    members = {}
    for c, path in new.items():
        for d in range(len(path) + 1):
            members.setdefault(tuple(path[:d]), []).append(c)
    out = []
    for node, held in members.items():
        below = [m for m in members if m[: len(node)] == node]
        leaves = [m for m in below if not any(x[:-1] == m for x in members if x)]
        saved = sum((len(members[m]) - 1) * len(m[-1][1].encode()) for m in below if m)
        ends = ",".join(str(c) for c in sorted(held) if len(new[c]) == len(node))
        out.append((
            min(held), len(node), min(members[node[:-1]]) if node else None, len(held), sum(1 for m in below if len(m) == len(node) + 1),
            len(leaves), saved, hashlib.sha256(ends.encode()).hexdigest(),
        ))
    return sorted(out, key=repr)


def odd_turns():
    rng = random.Random(4)
    rows = []
    for conv in range(60):
        for turn in range(rng.choice([1, 2, 3, 9, 12])):
            rows.append((conv, turn, "user" if turn % 2 else None, rng.choice(["a", "b", "é" * 3])))
    for conv in range(100, 140):  # equal conversations
        rows += [(conv, k, "user", f"same {k}") for k in range(4)]
    rows += [(200, None, "x", "first"), (200, 1, "x", None), (200, 1, "x", None), (200, 0, "", ""), (201, 5, None, None)]
    rows += [(None, 0, "user", "no id"), (None, None, None, None)]
    rows += [(300, k, "user", "w " * 5000) for k in range(60)] + [(305, k, "user", "w " * 5000) for k in range(50)]
    return rows


def trie_rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.mark.parametrize("shards", [1, 7, 64])
def test_trie_of_odd_turns(spark, shards):
    rows = odd_turns()
    table = spark.createDataFrame([(*r, "k", 1, "p", 2, 3) for r in rows], TURNS).repartition(5)
    found = prefix_trie(table, shards=shards)
    assert found.columns == ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    assert trie_rows(found) == plain_trie(rows)


def test_trie_of_nothing(spark):
    none = spark.createDataFrame([], TURNS)
    assert trie_rows(prefix_trie(none)) == []
    nameless = spark.createDataFrame([(None, 1, "a", "b", "k", 1, "p", 2, 3)], TURNS)
    assert trie_rows(prefix_trie(nameless)) == []


def test_skeleton_holds_every_node_of_two_shards():
    rng = random.Random(2)
    paths = sorted({"".join(rng.choice("ab") * KEY for _ in range(rng.randrange(9))) for _ in range(300)})
    skeleton = Skeleton(splitters_of(paths, 9))
    shards = {}
    for p in paths:
        for d in range(len(p) // KEY + 1):
            shards.setdefault(p[: d * KEY], set()).add(skeleton.shard(p))
    prefixes = {s[: d * KEY] for s in skeleton.splitters for d in range(len(s) // KEY + 1)} | {""}
    assert all(p in prefixes for p, held in shards.items() if len(held) > 1)
    assert len(skeleton.parent) == len(prefixes) and shared_turns("a" * KEY, "a" * (KEY - 1) + "b") == 0


# -- lexical search


def plain_ranks(docs, items, k=10):
    term = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
    counted = [(i, Counter(re.findall(term, lower(t)))) for i, t in docs]
    counted = [(i, c) for i, c in counted if c]
    n, length = len(counted), sum(sum(c.values()) for _, c in counted)
    df = Counter(t for _, c in counted for t in c)
    asked = {}
    for i, t in items:
        asked.setdefault(i, set()).update(re.findall(term, lower(t)))
    out = []
    for item, terms in asked.items():
        scores = []
        for i, c in counted:
            m = 10 + (90 * sum(c.values()) * n) // length
            s = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * ((10**9 * c[t]) // (1000 * c[t] + 8 * m)) for t in terms if c[t])
            if s > 0:
                scores.append((-s, i is None, i or 0, i))
        out += [(item, r, s[3], -s[0]) for r, s in enumerate(sorted(scores, key=lambda x: x[:3])[:k], 1)]
    return sorted(out, key=repr)


def odd_corpus():
    rng = random.Random(8)
    words = [f"w{i}é" if i % 7 == 0 else f"Word{i}" for i in range(120)]
    docs = [(i, " ".join(rng.choice(words[: rng.choice([10, 60, 120])]) for _ in range(rng.randrange(1, 80)))) for i in range(400)]
    docs += [(1000, None), (1001, ""), (1002, " .,\n"), (1003, " ".join(rng.choice(words) for _ in range(40_000)))]
    docs += docs[:5] + [(None, docs[0][1]), (None, "word1 word2")]
    items = [(k, " ".join(rng.choice(words) for _ in range(rng.randrange(1, 30)))) for k in range(40)]
    items += [(100, None), (101, "..."), (102, "absent"), (103, "word1"), (103, "word2 WORD1"), (None, "word3"), items[0], (104, docs[-3][1])]
    return docs, items


@pytest.mark.parametrize("settings", [{}, {"k": 3, "item_bytes": 500}, {"head_share": 0.5}])
def test_ranks_of_odd_texts(spark, settings):
    docs, items = odd_corpus()
    table = spark.createDataFrame([(i, t, 1, [1], 2, "x") for i, t in docs], TEXTS).repartition(3)
    asked = spark.createDataFrame([(i, t, "x", 1) for i, t in items], ITEMS)
    found = ranked_documents(table, asked, **settings)
    assert found.columns == ["item_id", "rank", "doc_id", "score"]
    assert sorted((tuple(r) for r in found.collect()), key=repr) == plain_ranks(docs, items, settings.get("k", 10))


def test_ranks_of_nothing(spark):
    docs, items = spark.createDataFrame([], TEXTS), spark.createDataFrame([], ITEMS)
    some = spark.createDataFrame([(1, "word", "x", 1)], ITEMS)
    assert ranked_documents(docs, some).count() == 0 and ranked_documents(docs, items).count() == 0


def test_terms():
    text = "A-b_C9 é x\x00y ÀÉ 中文,z"
    assert [t.decode() for t in terms_of(text.encode())] == re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", lower(text))


# -- vector links


def plain_links(rows, least=0.93):
    """Links of rows (id, vector, label); of rows that share an id the largest stands."""
    best = {}
    for i, v, label in rows:
        if i is not None:
            best[i] = max(best.get(i, ((False, ""), (False, []))), ((label is not None, label or ""), (v is not None, v or [])))
    usable = {}
    for i, (label, v) in best.items():
        x = np.array([math.nan if c is None else c for c in v[1]], np.float32).astype(float)
        if label[0] and len(x) and np.isfinite(x).all() and x.any():
            usable[i] = (label[1], x / np.linalg.norm(x))
    links = [
        (a, b) for a in usable for b in usable
        if a < b and usable[a][0] == usable[b][0] and len(usable[a][1]) == len(usable[b][1]) and usable[a][1] @ usable[b][1] >= least
    ]
    n = Counter(x for link in links for x in link)
    return {i: (n[i], c, i == c) for i, c in components(list(best), links).items()}


def linked_rows(df):
    assert df.columns == ["vec_id", "n_links", "component_id", "kept"]
    return {r.vec_id: (r.n_links, r.component_id, r.kept) for r in df.collect()}


def odd_vectors():
    rng = np.random.default_rng(5)
    centres = rng.standard_normal((12, 16))
    rows = []
    for i in range(500):
        noise = rng.choice([0.02, 0.1, 0.15]) * rng.standard_normal(16)
        rows.append((1000 - i, [float(np.float32(c)) for c in centres[i % 12] + noise], ["a", "b", None][i % 3 if i % 5 else 0]))
    rows += [(2000 + i, rows[0][1], "a") for i in range(30)]  # equal vectors
    rows += [(3000, None, "a"), (3001, [0.0] * 16, "a"), (3002, [None, *rows[0][1][1:]], "a"), (3003, [math.nan] * 16, "a"), (3004, [math.inf] * 16, "a")]
    rows += [(3005, [], "a"), (3006, [1.0, 2.0], "a"), (3007, [2.0, 4.0], "a"), (3008, [1e-30] * 16, "c"), (3009, [3e30] * 16, "c")]
    rows += [rows[0], (1000, rows[40][1], "a"), (3010, rows[0][1], "zz"), (None, rows[0][1], "a"), (None, None, None)]
    return rows


def test_links_of_odd_vectors(spark):
    rows = odd_vectors()
    table = spark.createDataFrame([(*r, 1, 2, 3, 4) for r in rows], VECTORS).repartition(4)
    found = near_vectors(table)
    nameless = [tuple(r) for r in found.filter("vec_id is null").collect()]
    assert nameless == [(None, 0, None, None)] * 2
    assert linked_rows(found.filter("vec_id is not null")) == plain_links(rows)


def test_links_of_blocks(spark, monkeypatch):
    """Buckets and balls that do not fit one block are compared tile by tile."""
    from starsift.llm import vector_links

    monkeypatch.setattr(vector_links, "BLOCK", 20)
    monkeypatch.setattr(vector_links, "MEMBERS", 8)
    rows = odd_vectors()
    table = spark.createDataFrame([(*r, 1, 2, 3, 4) for r in rows if r[0] is not None], VECTORS)
    assert linked_rows(near_vectors(table, miss=1e-6)) == plain_links(rows)


def test_links_of_nothing(spark):
    assert near_vectors(spark.createDataFrame([], VECTORS)).count() == 0


def test_links_of_real_vectors(spark, sf_dir):
    rows = duckdb.execute(f"SELECT vec_id, embedding, label FROM '{sf_dir}/embeddings.parquet'").fetchall()
    assert linked_rows(Q.QUERIES["op13_vector_links"](spark, sf_dir)) == plain_links([(i, v, str(k)) for i, v, k in rows])


def test_double_vectors(spark):
    rows = [(1, [1e200, 1e200], "a"), (2, [3e200, 3e200], "a"), (3, [1e-200, 1e-200], "a"), (4, [1.0, -1.0], "a"), (5, [1.0, 1.01], "a")]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label string")
    assert linked_rows(near_vectors(table)) == {1: (3, 1, True), 2: (3, 1, False), 3: (3, 1, False), 4: (0, 4, True), 5: (3, 1, False)}


def test_chance_to_meet():
    rng = np.random.default_rng(1)
    shift = rng.uniform(0, 1.5, 200_000)
    step = 0.374 * rng.standard_normal(200_000)
    assert abs(np.mean(np.floor(shift / 1.5) == np.floor((shift + step) / 1.5)) - meeting(0.374, 1.5)) < 5e-3
    small, large = (Hashing.planned(0.93, n, 64, 1e-3, 1) for n in (5_000, 50_000_000))
    assert small.hashes < large.hashes and small.tables < large.tables
