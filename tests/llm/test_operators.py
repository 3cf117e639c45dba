"""Operators against plain versions, on real rows and on a table of odd rows."""

import hashlib
import random
import re
import zlib

import duckdb
import numpy as np
import public_tokenizers
import pytest
from brute import detections, licences, linked, repeats, shingles
from compare import compare, connect
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from starsift.llm import common, shingle_join
from starsift.llm import queries as Q
from starsift.llm.bpe import Vocabulary, merge_pairs, merge_short
from starsift.llm.components import components
from starsift.llm.content_sort import exact_groups, first_of_groups, range_of, splitters_of
from starsift.llm.curriculum import copies, mix_plan
from starsift.llm.licence_rules import rules
from starsift.llm.licences import BASE, GATE, scan_licences, summary
from starsift.llm.repeats import without_repeats
from starsift.llm.severity import chance_of, fit_ordinal, fit_severity, held_features, least_toxic, score_severity, without_toxic
from starsift.llm.shingle_join import Likeness, bitmap, linked_groups, most_common, part_keys
from starsift.llm.token_counts import count_tokens, with_limit
from starsift.llm.token_store import EliasFano, read_documents, store_tokens
from starsift.llm.tree_search import nearest
from starsift.llm.word_codec import Codec, Lexicon, MappedLexicon, build_lexicon, digests, encode_decode, frequent_words

BYTE, WORD = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("word_bpe_49k.json")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, key string, n int, doc long, place int"


def odd_texts():
    rng = random.Random(7)
    words = [f"w{i}é" if i % 9 == 0 else f"Word{i}" for i in range(400)]
    base = [rng.choice(words) for _ in range(230)]
    near = base[:100] + ["Changed"] + base[101:]
    far = base[:60] + [rng.choice(words) for _ in range(120)] + base[170:230]
    long = [rng.choice(words) for _ in range(30_000)]
    texts = [
        " ".join(base), " ".join(near), " ".join(far), "  ".join(base) + "\n", " ".join(base), None, "", " \t\n", "one", "One two",
        " ".join(long), " ".join(long[:29_990]), "the MIT License. Licensed under the Apache License, Version 2.0.", "a b \x1c c",
        "x<|endoftext|>y <|startoftext|> Σς ΑΣ don't ǅ 12½", "mit license mit  LICENSE general public license", "word " * 300,
        "word " * 299, "٣ 한글 \U0001f642​", "é É café", " ".join(base[:70]), "tail " + " ".join(base[20:75]) + " end",
        "SPDX-License-Identifier: GPL-2.0-only",
    ]
    return dict(enumerate(texts))


@pytest.fixture(scope="module")
def texts():
    return odd_texts()


@pytest.fixture(scope="module")
def docs(spark, texts):
    sources = ["a", None, "b", "a", "é"]
    rows = [(i, t, None, sources[i % 5], None, "k", 1, 2, 3) for i, t in texts.items()]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def doubled(docs):
    """Every row twice, and rows without an id."""
    nameless = docs.filter("doc_id in (0, 5, 9)").withColumn("doc_id", F.lit(None).cast("long"))
    return docs.unionByName(docs).unionByName(nameless)


def rows_of(df):
    return {r["doc_id"]: r for r in df.collect()}


def real(sf_dir):
    return dict(duckdb.execute(f"SELECT doc_id, text FROM '{sf_dir}/documents.parquet'").fetchall())


def test_tree_search_recall_and_scores(spark, sf_dir):
    got = Q.tree_search(spark, sf_dir).collect()
    table = duckdb.execute(f"SELECT vec_id, embedding FROM '{sf_dir}/embeddings.parquet'").fetchall()
    ids = np.array([r[0] for r in table])
    x = np.array([r[1] for r in table], float)
    found, at = {}, {i: k for k, i in enumerate(ids)}
    for r in got:
        found.setdefault(r.query_id, []).append(r)
    assert set(found) == {i for i in ids if i % 20 == 0}
    hits = 0
    for q, rows in found.items():
        rows.sort(key=lambda r: r["rank"])
        assert [r["rank"] for r in rows] == list(range(1, 21))
        assert all((-a.score, a.vec_id) < (-b.score, b.vec_id) for a, b in zip(rows, rows[1:]))
        scores = x @ x[at[q]]
        assert all(abs(scores[at[r.vec_id]] - r.score) < 1e-12 and r.vec_id != q for r in rows)
        scores[at[q]] = -np.inf
        hits += len({ids[i] for i in np.lexsort((ids, -scores))[:20]} & {r.vec_id for r in rows})
    assert hits >= 0.9 * 20 * len(found)


def test_tree_search_odd_vectors(spark):
    rows = [(i, [1.0, 0.5]) for i in range(60)] + [
        (60, None), (61, [0.0, 0.0]), (62, [float("nan"), 1.0]), (63, [None, 1.0]), (64, [1.0]), (None, [1.0, 1.0]), (66, [float("inf"), 1.0]),
        (67, [2.0, 2.0]), (67, [2.0, 2.0]), (68, [-1.0, 0.0]),
    ]
    frame = spark.createDataFrame([(i, v, 0, 0.0) for i, v in rows], "vec_id long, embedding array<double>, leaf int, score double")
    got = nearest(frame, F.col("vec_id") % 20 == 0, 5).orderBy("query_id", "rank").collect()
    by = {q: [(r.vec_id, r.score) for r in got if r.query_id == q] for q in (0, 20, 40)}
    assert by[0] == [(67, 3.0), (1, 1.25), (2, 1.25), (3, 1.25), (4, 1.25)]
    assert by[20] == by[40] == [(67, 3.0), (0, 1.25), (1, 1.25), (2, 1.25), (3, 1.25)]
    assert {r.query_id for r in got} == {0, 20, 40}
    assert nearest(frame.limit(0), F.lit(True), 5).count() == 0
    assert nearest(frame.filter("vec_id = 68"), F.lit(True), 5).count() == 0


@pytest.mark.parametrize("n,percent", [(3, 90), (5, 80)])
def test_shingle_join(spark, sf_dir, docs, texts, empty, n, percent):
    for frame, given in ((docs, texts), (spark.read.parquet(f"{sf_dir}/documents.parquet"), real(sf_dir))):
        sizes, groups = linked(given, n, percent)
        got = rows_of(linked_groups(frame, Likeness(n, percent)))
        assert {i: (r.n_shingles, r.component_id) for i, r in got.items()} == {i: (sizes[i], groups[i]) for i in given}
    assert linked_groups(empty, Likeness(n, percent)).count() == 0


def test_shingle_join_family_of_near_copies(spark):
    rng = random.Random(3)
    base = [f"w{i}" for i in range(90)]
    given = {}
    for i in range(150):
        words = list(base)
        for _ in range(rng.randrange(4)):
            words[rng.randrange(90)] = f"x{rng.randrange(10**6)}"
        given[i] = " ".join(words)
    frame = spark.createDataFrame(list(given.items()), "doc_id long, text string").repartition(5)
    for n, percent in ((3, 90), (5, 80)):
        sizes, groups = linked(given, n, percent)
        got = rows_of(linked_groups(frame, Likeness(n, percent)))
        assert {i: r.component_id for i, r in got.items()} == groups


def test_shingle_join_repeated_rows_and_null_ids(doubled, docs):
    once = rows_of(linked_groups(docs, Likeness()))
    got = linked_groups(doubled, Likeness()).collect()
    assert len(got) == doubled.count()
    assert all(r.component_id == (once[r.doc_id].component_id if r.doc_id is not None else None) for r in got)


def test_shingle_join_gives_a_pair_at_one_key(spark, monkeypatch):
    """Alike sets share many keys; their pair is given at the smallest, however the blocks of a key meet."""
    monkeypatch.setattr(shingle_join, "BLOCK", 8)
    keys = {d: {k for k in range(-20, 20) if (d * 7 + k) % 3} | ({100} if d % 2 else set()) for d in range(40)}
    keys[40] = {100}
    label = {d: d // 2 for d in keys}
    members = spark.createDataFrame([(k, d, label[d]) for d, ks in keys.items() for k in ks], "key long, doc long, label long")
    one = bitmap(np.arange(30, dtype=np.uint64)).tobytes()
    bits = spark.createDataFrame([(d, 30, bytearray(one)) for d in keys], "doc long, n long, bits binary")
    met = [(r.a, r.b) for r in shingle_join._met_pairs(members, bits, Likeness()).collect()]
    assert set(met) == {(a, b) for a in keys for b in keys if a < b and label[a] != label[b] and keys[a] & keys[b]}
    assert len(met) == len(set(met))
    # with fewer keys beside a set, pairs may come again but none is lost
    monkeypatch.setattr(shingle_join, "FIRST_KEYS", 2)
    again = [(r.a, r.b) for r in shingle_join._met_pairs(members, bits, Likeness()).collect()]
    assert set(again) == set(met)


def test_shingle_join_counts_every_link(spark, monkeypatch):
    rng = random.Random(5)
    base = [f"w{i}" for i in range(90)]
    given = {}
    for i in range(160):
        words = base[: rng.choice((60, 75, 90))]
        for _ in range(rng.randrange(4)):
            words[rng.randrange(len(words))] = f"x{rng.randrange(10**6)}"
        given[i] = " ".join(words)
    given |= {200: given[3], 201: given[3], 202: "alone here", 203: None, 204: "", 205: "short", 206: "short"}
    frame = spark.createDataFrame(list(given.items()), "doc_id long, text string").repartition(5)
    monkeypatch.setattr(shingle_join, "BLOCK", 16)
    sets = {i: shingles(t, 3) for i, t in given.items()}
    links = {i: 0 for i in given}
    for i, a in sets.items():
        for j, b in sets.items():
            links[i] += i != j and bool(a & b) and 10 * len(a & b) >= 9 * len(a | b)
    got = linked_groups(frame.union(frame), Likeness(3, 90), count_links=True).collect()
    assert len(got) == 2 * len(given) and max(links.values()) > 16
    groups = linked(given, 3, 90)[1]
    assert all((r.n_links, r.component_id) == (links[r.doc_id], groups[r.doc_id]) for r in got)


def test_parts_lose_no_link():
    rng = np.random.default_rng(1)
    for percent in (80, 90):
        how = Likeness(5, percent)
        for _ in range(300):
            size = int(rng.integers(1, 400))
            a = np.unique(rng.integers(0, 1 << 63, size).astype(np.uint64))
            b = a[rng.permutation(len(a))[: max(1, len(a) - int(rng.integers(0, len(a) // 6 + 1)))]]
            b = np.unique(np.concatenate([b, rng.integers(0, 1 << 63, int(rng.integers(0, len(a) // 9 + 1))).astype(np.uint64)]))
            common = len(np.intersect1d(a, b))
            assert most_common(bitmap(a), bitmap(b), len(a), len(b)) >= common
            if how.linked(common, len(a), len(b)):
                owner, key = part_keys([a, b], how)
                assert set(key[owner == 0]) & set(key[owner == 1])


def test_shingle_words_are_hashed_together(monkeypatch):
    """New words cost no call each; equal words, and only those, have equal hashes, wherever they stand."""
    rng = random.Random(7)
    calls = []
    for module in (shingle_join, common):
        plain = common.word_hash
        monkeypatch.setattr(module, "word_hash", lambda word: calls.append(word) or plain(word))
    letters = [bytes([c]) for c in range(256) if c not in b" \t\n\x0b\x0c\r"]
    words = [b"".join(rng.choices(letters, k=k)) for k in range(1, 65) for _ in range(40)]
    words += [b"a" * k for k in range(1, 65)] + [b"a" * k + b"\0" for k in range(64)] + [b"\0" * k for k in range(1, 65)]
    texts = [b"", None, b" \t\n\x0b\x0c\r ", b"one", b" Two\tWORDS\n", *(b" ".join(rng.choices(words, k=200)) for _ in range(60)), b" ".join(words), b"end "]
    one = shingle_join.shingle_sets(texts, Likeness(1, 90))
    assert not calls
    lists = [(t or b"").lower().split() for t in texts]
    flat, begins = shingle_join.word_hashes(texts)
    assert begins.tolist() == np.cumsum([0, *map(len, lists)]).tolist()
    hashes = dict(zip([w for ws in lists for w in ws], flat.tolist(), strict=True))
    assert flat.tolist() == [hashes[w] for ws in lists for w in ws] and len(set(hashes.values())) == len(hashes)
    assert [len(s) for s in one] == [len(set(ws)) for ws in lists] and all((s[1:] > s[:-1]).all() for s in one)
    # longer words, alone and beside others
    long = [b"b" * k for k in range(60, 200)]
    alone = [shingle_join.word_hashes([w])[0].tolist() for w in long]
    assert alone == [[h] for h in shingle_join.word_hashes([b" ".join(long)])[0].tolist()] and len({h for h, in alone}) == len(long)
    assert [len(a) for a in shingle_join.word_hashes([])] == [0, 1]


def test_set_digests_follow_the_set():
    sets = [np.array(s, np.uint64) for s in ([], [1, 5, 9], [7], [], [1, 5, 9], [1, 5], [])]
    first, second = (d.tolist() for d in shingle_join.set_digests(sets))
    for d in (first, second):
        assert d[0] == d[3] == d[6] == 0 and d[1] == d[4] and len(set(d)) == 4
    alone = [shingle_join.set_digests([s]) for s in sets]
    assert [int(a[0]) for a, _ in alone] == first and [int(b[0]) for _, b in alone] == second


def test_components_of_a_path(spark):
    n = 40
    edges = spark.createDataFrame([(i, i + 1) for i in range(n)] + [(100, 101), (7, 7)], "a long, b long")
    got = {r.node: r.component for r in components(edges).collect()}
    assert got == {**{i: 0 for i in range(n + 1)}, 100: 100, 101: 100}
    assert components(edges.limit(0)).count() == 0


def test_token_counts(spark, sf_dir, docs, texts, empty, doubled):
    library = Tokenizer.from_file(BYTE)
    for frame, given in ((docs, texts), (spark.read.parquet(f"{sf_dir}/documents.parquet"), real(sf_dir))):
        got = rows_of(with_limit(count_tokens(frame, BYTE)))
        for i, t in given.items():
            n = len(library.encode(t or "", add_special_tokens=False).ids)
            assert (got[i].n_bytes, got[i].n_tokens, got[i].over_limit) == (len((t or "").encode()), n, n > 512)
    assert count_tokens(empty, BYTE).count() == 0
    assert count_tokens(doubled, BYTE).count() == doubled.count()


def test_merging_forms_agree():
    vocabulary = Vocabulary(BYTE)
    rng = random.Random(2)
    for _ in range(300):
        symbols = vocabulary.symbols("".join(rng.choice("theinatréa ") for _ in range(rng.randrange(40))))
        assert merge_pairs(symbols, vocabulary.ranks) == merge_short(symbols, vocabulary.ranks)
    assert len(merge_pairs(vocabulary.symbols("a" * 50_000), vocabulary.ranks)) < 50_000


def test_licences(spark, sf_dir, docs, texts, empty, doubled):
    table = rules()
    assert 200 <= len(table)
    for frame, given in ((docs, texts), (spark.read.parquet(f"{sf_dir}/documents.parquet"), real(sf_dir))):
        scans = scan_licences(frame)
        got = rows_of(summary(scans))
        for i, t in given.items():
            r = got[i]
            n_words, n_base, first, last, labels = licences(t, BASE)
            assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == (n_words, n_base, first, last, labels)
            assert set(filter(None, r.labels.split(","))) == detections(t, table) | set(filter(None, labels.split(",")))
            assert 0 <= r.score <= 1 and (r.score > 0) == bool(r.labels)
    assert summary(scan_licences(empty)).count() == 0
    assert summary(scan_licences(doubled)).count() == doubled.count()


def test_licence_gate_lets_every_rule_through():
    assert all(re.search(GATE, pattern.replace("[cs]", "c")) for _, _, pattern, _ in rules())


def test_licence_gate_takes_underscores_for_blanks(spark):
    texts = ["photo by Ann, cc_by_sa_4.0", "CC_BY 4.0", "img_cc-by-sa_4.0.png", "_CC_", "photo by Ann, cc by sa 4.0", "accept cc1 xcc", "écc_by 4.0"]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = rows_of(summary(scan_licences(frame)))
    for i, t in enumerate(texts):
        assert set(filter(None, got[i].labels.split(","))) == detections(t, rules()), t
    assert (got[0].labels, got[0].score) == (got[4].labels, got[4].score) and got[0].score == 0.9


def test_long_licence_text_in_time_of_its_length(spark):
    frame = spark.createDataFrame([(1, "released under the MIT license. " * 20_000)], "doc_id long, text string")
    r = summary(scan_licences(frame)).first()
    assert (r.n_base, r.first_word, r.last_word, r.labels) == (20_000, 3, 99_998, "mit")


def test_repeats(spark, sf_dir, docs, texts, empty, doubled):
    for frame, given in ((docs, texts), (spark.read.parquet(f"{sf_dir}/documents.parquet"), real(sf_dir))):
        expected = repeats(given, 50)
        got = without_repeats(frame, 50).select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("sha")).collect()
        assert {r.doc_id: tuple(r)[1:] for r in got} == expected
    assert without_repeats(empty, 50).count() == 0
    got = without_repeats(doubled, 50).collect()
    expected = repeats(texts, 50)
    assert len(got) == doubled.count()
    assert all(r.n_removed == (expected[r.doc_id][1] if r.doc_id is not None else 0) for r in got)


def test_content_sort(spark, docs, texts, empty, doubled):
    got = rows_of(exact_groups(docs))
    whole = {i: re.sub(r"[\x20\x09-\x0D]", "", t or "") for i, t in texts.items()}
    for i, t in texts.items():
        same = [j for j in texts if whole[j] == whole[i]]
        keep = min(same, key=lambda j: (-len(texts[j] or ""), j))
        digest = hashlib.sha256(whole[i].encode()).hexdigest()
        assert tuple(got[i][c] for c in ("keep_id", "group_size", "kept", "text_sha256")) == (keep, len(same), keep == i, digest)
    assert exact_groups(empty).count() == 0
    twice = exact_groups(doubled).collect()
    assert len(twice) == doubled.count()
    assert sum(r.kept for r in twice) == len(set(whole.values()))
    assert first_of_groups(doubled).count() == len(set(whole.values()))
    assert first_of_groups(doubled).columns == doubled.columns
    assert {r.doc_id for r in first_of_groups(docs).collect()} == {r.keep_id for r in got.values()}


def test_content_sort_with_a_hot_text(spark):
    frame = spark.range(4000).select(
        F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, "same text").otherwise(F.concat(F.lit("t"), "id")).alias("text")
    )
    got = exact_groups(frame)
    assert got.filter("kept").count() == 4000 - 1334 + 1
    assert got.filter("doc_id % 3 = 0").select("keep_id", "group_size").distinct().collect() == [(0, 1334)]


def test_splitters(spark):
    splitters, heavy = splitters_of(["a"] * 6 + ["b", "c", "d", "e"], 5)
    assert heavy == {"a": 2} and splitters == sorted(splitters)
    keys = ["", "a", "aa", "b", "c", "cc", "z"]
    frame = spark.createDataFrame([(k,) for k in keys], "k string")
    for cut in ([], ["b"], ["a", "b", "c", "d", "e", "f", "g"]):
        got = {r.k: r.n for r in frame.select("k", range_of(F.col("k"), cut).alias("n")).collect()}
        assert got == {k: sum(s <= k for s in cut) for k in keys}


@pytest.mark.parametrize("name", sorted(Q.ORACLE))
def test_same_rows_as_sql(spark, sf_dir, name):
    assert compare(spark, connect(sf_dir), name, Q.QUERIES[name], Q.ORACLE[name], sf_dir) == []


def test_elias_fano():
    rng = np.random.default_rng(4)
    for values in ([], [0], [5], [0, 0, 0], list(range(200)), np.sort(rng.integers(0, 10**6, 500)), [0, 1 << 40], [3] * 70 + [10**9] * 70):
        again = EliasFano.from_bytes(EliasFano.encode(np.array(values, np.int64)).to_bytes())
        assert again.decode().tolist() == list(values)
        assert [again.select(i) for i in range(len(values))] == list(values)
        mixed_up = rng.permutation(len(values))
        assert again.select_many(mixed_up).tolist() == [values[i] for i in mixed_up]
    lengths = rng.integers(1, 1200, 10_000)
    assert len(EliasFano.encode(np.cumsum(lengths)).to_bytes()) < 10_000 * 2


def test_token_store(spark, docs, texts, empty, doubled, tmp_path):
    library = Tokenizer.from_file(WORD)
    got = rows_of(store_tokens(docs, WORD, 2, f"{tmp_path}/a"))
    start = 0
    for i, t in texts.items():
        ids = np.array([*library.encode(t or "", add_special_tokens=False).ids, 2], "<u4")
        assert tuple(got[i])[1:] == (start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)
    assert store_tokens(empty, WORD, 2, f"{tmp_path}/b").count() == 0
    again = store_tokens(doubled, WORD, 2, f"{tmp_path}/c").orderBy("start").collect()
    assert [r.doc_id for r in again] == [None] * 3 + sorted([*texts, *texts])
    assert all(a.start + a.n_tokens == b.start for a, b in zip(again, again[1:]))
    assert read_documents(spark.read.parquet(f"{tmp_path}/a"), "<u2").count() == len(texts)


def test_token_store_of_real_texts(spark, sf_dir, tmp_path, monkeypatch):
    from starsift.llm import token_store

    monkeypatch.setattr(token_store, "SELECTED", 7)
    library = Tokenizer.from_file(WORD)
    got = rows_of(store_tokens(spark.read.parquet(f"{sf_dir}/documents.parquet"), WORD, 2, f"{tmp_path}/real"))
    start = 0
    for i, t in sorted(real(sf_dir).items()):
        ids = np.array([*library.encode(t or "", add_special_tokens=False).ids, 2], "<u4")
        assert tuple(got[i])[1:] == (start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)


def test_word_codec(spark, sf_dir, docs, texts, empty, doubled):
    library = Tokenizer.from_file(WORD)
    for frame, given in ((docs, texts), (spark.read.parquet(f"{sf_dir}/documents.parquet"), real(sf_dir))):
        got = rows_of(encode_decode(frame, WORD))
        short = rows_of(digests(encode_decode(frame, WORD, ["word"])))
        for i, t in given.items():
            ids = library.encode(t or "", add_special_tokens=False).ids
            text = library.decode(ids, skip_special_tokens=False)
            assert got[i].ids == ids and got[i].decoded == text
            assert short[i].ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
            assert short[i].decoded_sha256 == hashlib.sha256(text.encode()).hexdigest() and short[i].n_tokens == len(ids)
    assert encode_decode(empty, WORD).count() == 0
    assert encode_decode(doubled, WORD).count() == doubled.count()


def test_frequent_words_are_counted_in_all_rows(spark):
    letters = F.translate(F.lpad(F.col("id").cast("string"), 5, "0"), "0123456789", "abcdefghij")
    rows = spark.range(30_000).select(F.col("id").alias("doc_id"), F.concat(letters, F.when(F.col("id") % 2 == 0, " even").otherwise(" Odd odd")).alias("text"))
    words = frequent_words(rows, 40_000)
    assert len(words) == 30_002 and words[:3] == ["odd", "even", "aaaaa"]
    assert frequent_words(rows, 2) == ["odd", "even"]


def test_codec_holds_a_word_once(monkeypatch):
    from starsift.llm import word_codec

    library = Tokenizer.from_file(WORD)
    words = [f"{a}{b}{c}ñ" for a in "abcdefgh" for b in "ijklmnop" for c in ("qu", "Ré")]
    text = " ".join([*words, *[w[:-1] for w in words], *[f"({w}," for w in words[:9]], "Odd,ñ", "odd", "ÉTÉ,", "été"])
    ids = library.encode(text, add_special_tokens=False).ids
    codec = Codec(WORD, build_lexicon(["odd"], WORD))
    assert np.frombuffer(codec.encode(text.encode()), np.int32).tolist() == ids
    held = {w for run in codec for w in word_codec.words_of_run(run)}
    assert len(codec.others) <= 9 * 3 + 5 < len(held)
    monkeypatch.setattr(word_codec, "MEMO", 5)
    monkeypatch.setattr(word_codec, "OTHERS", 3, raising=False)
    codec = Codec(WORD, build_lexicon(["odd"], WORD))
    assert np.frombuffer(codec.encode(text.encode()), np.int32).tolist() == ids
    assert len(codec) <= 5 and len(codec.others) <= 3


def test_lexicon_is_minimal_and_exact():
    words = {w.encode(): [k, k + 1] for k, w in enumerate(["tap", "taps", "top", "tops", "é", "", "stop", "stops"])}
    lexicon = Lexicon.build(words)
    rights = set()
    arcs = list(zip(lexicon.labels, lexicon.target))
    for s in range(len(lexicon.final)):
        rights.add((int(lexicon.final[s]), tuple((a, int(b)) for a, b in arcs[lexicon.first_arc[s] : lexicon.first_arc[s + 1]])))
    assert len(rights) == len(lexicon.final)
    mapped = MappedLexicon(lexicon.to_bytes())
    assert all(mapped.ids(w) == i for w, i in words.items())
    assert all(mapped.ids(w.encode()) is None for w in ("ta", "topss", "x", "sto"))
    assert MappedLexicon(Lexicon.build({}).to_bytes()).ids(b"a") is None


def test_severity_on_held_out_rows(spark, sf_dir):
    folder = sf_dir.replace("sf0.001", "sf0.1")
    docs, labels = spark.read.parquet(f"{folder}/documents.parquet"), spark.read.parquet(f"{folder}/labels.parquet")
    marked = labels.withColumn("h", F.pmod(F.xxhash64("doc_id", F.lit(3)), 4))
    model = fit_severity(docs, marked.filter("h > 0"))
    assert all(a < b for a, b in zip(model.thresholds, model.thresholds[1:]))
    judged = score_severity(docs, model).withColumnRenamed("toxic", "called").join(marked.filter("h = 0"), "doc_id")
    n = {(r.called, r.toxic): r["count"] for r in judged.groupBy("called", "toxic").count().collect()}
    assert n[(True, 1)] >= 0.9 * (n[(True, 1)] + n.get((False, 1), 0))
    assert n.get((True, 0), 0) <= 0.02 * n[(False, 0)]
    spread = judged.groupBy("toxic").agg(F.avg("severity").alias("s")).orderBy("toxic").collect()
    assert spread[0].s < 0.2 < 1.0 < spread[1].s


def test_severity_odd_rows(spark, docs, empty, doubled):
    labels = spark.createDataFrame([(0, 1), (1, 0), (None, 1), (2, None), (0, 0)], "doc_id long, toxic int")
    for frame in (docs, doubled):
        for marks in (labels, labels.limit(0)):
            model = fit_severity(frame, marks)
            got = score_severity(frame, model).collect()
            assert len(got) == frame.count()
            assert all(0 <= r.severity <= 3 and not (r.toxic and r.doc_id in (5, 6)) for r in got)
    assert without_toxic(docs, fit_severity(docs, labels.limit(0))).count() == docs.count()
    assert without_toxic(docs, fit_severity(docs, labels)).columns == docs.columns
    assert score_severity(empty, fit_severity(empty, labels)).count() == 0


def test_severity_against_plain_scores(spark, sf_dir):
    docs, labels = spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = fit_severity(docs, labels)
    weight = dict(zip(model.words, model.weights, strict=True))
    texts = real(sf_dir)
    for i, r in rows_of(score_severity(docs, model)).items():
        text = (texts[i] or "").encode()
        score = sum(weight[f] for f in held_features(text) if f in weight)
        above = [1 / (1 + np.exp(t - score)) for t in model.thresholds]
        each = [1 - above[0], *[a - b for a, b in zip(above, [*above[1:], 0.0], strict=True)]]
        assert abs(r.severity - sum(above)) < 1e-9 and abs(r.p_toxic - above[0]) < 1e-9
        assert each[r.grade] >= max(each) - 1e-9 and r.toxic == (bool(text) and above[0] >= model.cut)


def test_evidence_by_chance():
    ln = np.concatenate([[0.0], np.cumsum(np.log(np.arange(1, 88)))])
    assert abs(chance_of(4, 4, 11, 87, ln) - 330 / 2_225_895) < 1e-9 and abs(chance_of(0, 4, 11, 87, ln) - 1) < 1e-9
    assert least_toxic(5, 1, 11, 87, ln) <= least_toxic(5, 100, 11, 87, ln) <= 6


def test_ordinal_fit_recovers_order():
    rng = np.random.default_rng(0)
    x = (rng.random((2000, 3)) < 0.5).astype(float)
    y = np.digitize(x @ [2.0, -2.0, 0.0] + rng.logistic(size=2000), [-1.0, 1.0, 2.5])
    w, theta = fit_ordinal(x, y, 3)
    assert w[0] > 1.5 and w[1] < -1.5 and abs(w[2]) < 0.3 and np.all(np.diff(theta) > 0)
    assert np.allclose(theta, [-1.0, 1.0, 2.5], atol=0.4)


def test_mixture(docs, texts, empty, doubled):
    plan = mix_plan(docs).collect()
    assert len(plan) == len(texts)
    by = {}
    for r in plan:
        by.setdefault(r.source, []).append(r)
        assert r.size == len(re.findall(r"[^\x20\x09-\x0D]+", texts[r.doc_id] or "")) and 0 <= r.taken <= 2 * r.size
    total = sum(r.size for r in plan)
    assert abs(sum(rows[0].target for rows in by.values()) - 1.5 * total) < 1e-6
    for rows in by.values():
        assert rows[0].source_size == sum(r.size for r in rows) and rows[0].target <= 2 * rows[0].source_size
        assert abs(sum(r.taken for r in rows) - rows[0].target) <= 0.5
    free = [rows[0].target / {"a": 5, "b": 2, "é": 1, None: 5}[s] for s, rows in by.items() if rows[0].target < 2 * rows[0].source_size]
    assert max(free) - min(free) < 1e-6
    taken = {}
    for c in copies(mix_plan(docs)).collect():
        taken[c.doc_id] = taken.get(c.doc_id, 0) + c.words
        assert 0 <= c.position <= 1
    assert taken == {r.doc_id: r.taken for r in plan if r.taken}
    assert sorted(map(tuple, plan), key=repr) == sorted(map(tuple, mix_plan(docs.repartition(7)).collect()), key=repr)
    assert mix_plan(empty).count() == 0
    assert mix_plan(doubled).count() == doubled.count()


def test_curriculum_follows_the_schedule(spark):
    frame = spark.range(3000).select(
        F.col("id").alias("doc_id"), F.lit("w w w").alias("text"), F.concat(F.lit("s"), F.col("id") % 3).alias("source")
    )

    plan = mix_plan(frame)
    got = {r.source: r.p for r in plan.filter("taken > 0").groupBy("source").agg(F.avg("position").alias("p")).collect()}
    assert got["s0"] < got["s2"]
    each = copies(plan).select("doc_id", "position").join(frame.select("doc_id", "source"), "doc_id")
    early = each.filter("position < 0.5").groupBy("source").count().collect()
    n = {r.source: r["count"] for r in early}
    all_of = {r.source: r["count"] for r in each.groupBy("source").count().collect()}
    assert n["s0"] / all_of["s0"] == pytest.approx(0.625, abs=0.01)
    assert n["s1"] / all_of["s1"] == pytest.approx(0.5, abs=0.01)
    assert n["s2"] / all_of["s2"] == pytest.approx(0.375, abs=0.01)
