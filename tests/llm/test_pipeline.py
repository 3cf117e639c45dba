"""Stages of the pipeline against plain versions."""

import re

import corpus_pipeline as P
import duckdb
from brute import linked


def test_stages(spark, sf_dir, tmp_path):
    columns = ["doc_id", "text", "lang", "source", "n_chars"]
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    before = {r.doc_id: r.text for r in docs.collect()}
    seen = {}
    for k, (name, stage) in enumerate(P.STAGES):
        out = stage(spark, docs, sf_dir)
        out.write.parquet(f"{tmp_path}/{k}")
        docs = spark.read.parquet(f"{tmp_path}/{k}")
        if name != "bpe":
            assert docs.columns == columns
            seen[name] = [(r.doc_id, r.text) for r in docs.collect()]
            assert all(before[i] == t for i, t in seen[name])
    assert list(dict(P.STAGES)) == ["toxicity", "exact_dedup", "near_duplicates", "mixing", "bpe"]
    toxic = {i for (i,) in duckdb.execute(f"SELECT doc_id FROM '{sf_dir}/labels.parquet' WHERE toxic = 1").fetchall()}
    clean = {i for (i,) in duckdb.execute(f"SELECT doc_id FROM '{sf_dir}/labels.parquet' WHERE toxic = 0").fetchall()}
    kept = {i for i, _ in seen["toxicity"]}
    assert len(clean & kept) >= 0.95 * len(clean) and len(toxic & kept) <= 0.2 * len(toxic)

    best = {}
    for i, t in seen["toxicity"]:
        key = re.sub(r"[\x20\x09-\x0D]", "", t or "")
        best[key] = min(best.get(key, (0, 10**18)), (-len(t or ""), i))
    assert {i for i, _ in seen["exact_dedup"]} == {i for _, i in best.values()}

    _, groups = linked(dict(seen["exact_dedup"]), 5, 80)
    assert {i for i, _ in seen["near_duplicates"]} == {i for i in groups if groups[i] == i}
    assert docs.count() == len(seen["mixing"])
    words = sum(len(re.findall(r"[^\x20\x09-\x0D]+", t or "")) for _, t in seen["near_duplicates"])
    mixed = sum(len(re.findall(r"[^\x20\x09-\x0D]+", t or "")) for _, t in seen["mixing"])
    assert abs(mixed - 1.5 * words) <= 0.2 * words


def test_stages_on_odd_rows(spark, sf_dir, tmp_path):
    from test_operators import odd_texts

    rows = [(i, t, None, None if i % 2 else "a", None) for i, t in odd_texts().items()]
    rows += [rows[0], rows[5], (None, "no id", None, None, None), (None, None, None, None, None)]
    odd = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    for start, frame in (("odd", odd), ("none", odd.limit(0))):
        docs = frame
        for k, (name, stage) in enumerate(P.STAGES):
            stage(spark, docs, sf_dir).write.parquet(f"{tmp_path}/{start}{k}")
            docs = spark.read.parquet(f"{tmp_path}/{start}{k}")
        assert (docs.count() > 0) == (start == "odd")


def test_registered():
    import __spark_entry__ as entry

    names = set(entry.queries())
    assert "pipeline" in names and {f"op{k}" for k in range(1, 14)} == {n.split("_")[0] for n in names if n.startswith("op")}
