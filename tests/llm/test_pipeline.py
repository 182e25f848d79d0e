"""The pipeline: stages in order, columns kept, planted documents caught, clean ones kept."""

import random

import corpus_pipeline as cp
import pytest
from odd_rows import SCHEMA, clashing, documents, sentence


def test_stages_are_named_and_ordered():
    assert [n for n, _ in cp.STAGES] == ["quality", "near-duplicates", "decontamination", "mixing", "sharding"]


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    rng = random.Random(21)
    items = [(i, sentence(rng, 40)) for i in range(5)]
    rows = [(i, sentence(rng, 120), "en", f"s{i % 3}", 1) for i in range(150)]
    rows += [(200 + i, rows[i][1].replace(" ", "  ", 3), "en", "s0", 1) for i in range(10)]                # copies
    rows += [(300 + i, f"{sentence(rng, 50)} {items[i][1]} {sentence(rng, 50)}", "en", "s1", 1) for i in range(5)]
    rows += [(400 + i, " ".join(w + "***" for w in sentence(rng, 90).split()), "en", "s2", 1) for i in range(10)]
    path = str(tmp_path_factory.mktemp("pipeline"))
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return path


def test_decisions_take_effect(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns, left = docs.columns, {}
    for name, stage in cp.STAGES:
        docs = stage(spark, docs, folder).cache()
        left[name] = {r["doc_id"] for r in docs.collect()}
        assert docs.columns[:5] == columns
    clean = set(range(150))
    assert left["quality"] == clean | set(range(200, 210)) | set(range(300, 305))
    assert left["near-duplicates"] == clean | set(range(300, 305))
    assert left["decontamination"] == clean
    assert left["mixing"] < clean and left["sharding"] == left["mixing"]
    assert docs.columns[5:] == ["shard", "slot"]


def test_run_writes_and_rereads_every_stage(spark, folder, monkeypatch):
    """With two of the stages; their decisions are tested above."""
    seen = []

    def watched(stage):
        return lambda spark, docs, sf_dir: seen.append(len(docs.inputFiles())) or stage(spark, docs, sf_dir)
    monkeypatch.setattr(cp, "STAGES", [(n, watched(f)) for n, f in cp.STAGES if n in ("decontamination", "sharding")])
    out = cp.run(spark, folder)
    assert out.count() == 170 and out.columns[-2:] == ["shard", "slot"]
    assert len(seen) == 2 and all(seen) and out.inputFiles()


def test_odd_documents_and_clashing_columns(spark, folder, odd_docs):
    docs = clashing(odd_docs, "row", "kept", "probability", "shard_id", "text_hash")
    for _, stage in cp.STAGES:
        docs = stage(spark, docs, folder)
    assert docs.count() <= len(documents())


def test_empty_documents(spark, folder, no_docs):
    docs = no_docs
    for _, stage in cp.STAGES:
        docs = stage(spark, docs, folder)
    assert docs.count() == 0
