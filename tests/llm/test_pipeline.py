"""The pipeline beside a plain version of its stages that follows toxicity, whose scores are held-out tested apart."""

import random
from pathlib import Path

import pyarrow.parquet as pq
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from tidemark.llm import queries, storage, toxicity

from .test_decontaminate import edits
from .test_minhash_join import brute as near
from .test_substring_dedup import brute as passages


@pytest.fixture
def folder(spark, tmp_path):
    draw = random.Random(5)
    word = lambda: "".join(draw.choice(["ta", "re", "no", "li", "su", "ok"]) for _ in range(draw.choice([2, 3, 4])))
    prose = lambda n: [word() for _ in range(n)]
    items = [" ".join(prose(25)) for _ in range(3)]
    common = prose(60)
    rows, labels = [], []
    for i in range(160):
        words = prose(draw.choice([3, 40, 150]))
        kind = draw.choice(["clean", "clean", "toxic", "leak", "shared", "copy", "near"])
        if kind == "toxic":
            for _ in range(4):
                words.insert(draw.randrange(len(words)), draw.choice(["stupid", "idiotic", "worthless"]))
        text = " ".join(words)
        if kind == "leak":
            text += f"\n{draw.choice(items)} " + word()
        if kind == "shared":
            text += " " + " ".join(common[draw.randrange(5) :])
        if kind in ("copy", "near") and rows:
            text = draw.choice(rows)[1] or ""
            if kind == "near":
                text += " " + word()
        rows.append((i, draw.choice([text] * 20 + [None, ""]), "en", f"s{i % 3}", len(text)))
        labels.append((i, int("stupid" in text or "idiotic" in text or "worthless" in text)))
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame(list(enumerate(items)), "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    return str(tmp_path), rows, items


def test_equals_the_plain_version(spark, folder):
    path, rows, items = folder
    docs = queries.table(spark, path, "documents")
    scores = toxicity.scored(docs, queries.table(spark, path, "labels")).collect()
    kept = {r.doc_id for r in scores if not r.predicted}
    assert 0 < len(kept) < len(rows)
    left = [(i, t) for i, t, *_ in rows if i in kept]
    components = near(left, 5, 80)
    left = [(i, t) for i, t in left if components[i][2]]
    cut = {i: (gone, text) for i, _, gone, text in passages(left, 50)}
    left = [(i, cut[i][1] if cut[i][0] else t) for i, t in left]
    assert any(gone for gone, _ in cut.values())
    clean = [(i, t) for i, t in left if not any(edits(x, t or "", anywhere=True) <= len(x) // 10 for x in items)]
    assert len(clean) < len(left)
    library = Tokenizer.from_file(queries.word_vocabulary())
    want = {i: library.encode(t or "", add_special_tokens=False).ids for i, t in clean}
    got = corpus_pipeline.run(spark, path)
    assert {r.doc_id: r.ids for r in got.collect()} == want


def test_stages_keep_the_columns(spark, folder):
    path, rows, _ = folder
    docs = queries.table(spark, path, "documents")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        result = stage(spark, docs, path)
        assert result.dtypes == docs.dtypes, name
    empty = docs.limit(0)
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, path).collect() == [], name


def test_results_of_stages_are_stored_in_small_row_groups(spark, documents, monkeypatch):
    monkeypatch.setattr(storage, "GROUP", 1 << 20, raising=False)
    draw = random.Random(3)
    docs = documents([draw.randbytes(4000).hex() for _ in range(1200)]).coalesce(1)
    monkeypatch.setattr(queries, "table", lambda *_: docs)
    monkeypatch.setattr(corpus_pipeline, "STAGES", [("as_it_is", lambda spark, docs, sf_dir: docs)])
    out = corpus_pipeline.run(spark, "")
    assert out.count() == 1200
    found = [pq.ParquetFile(Path(f.removeprefix("file://"))).metadata for f in out.inputFiles()]
    groups = [m.row_group(i).total_byte_size for m in found for i in range(m.num_row_groups)]
    assert sum(groups) > 8 * storage.GROUP
    assert max(groups) <= 2 * storage.GROUP
