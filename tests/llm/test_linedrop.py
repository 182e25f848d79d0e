"""Line dedup against brute force; cuckoo filters; insertions and deletions."""

import hashlib
import re

import numpy as np
import pytest
from odd_rows import clashing, documents, low
from pyspark.sql import functions as F
from tessera.llm import linedrop as ld

STRIP = re.compile(r"^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+\Z")


def key(line):
    return low(STRIP.sub("", line))


def brute(texts, limit=10):
    count = {}
    for t in texts:
        for k in {key(x) for x in (t or "").split("\n")}:
            count[k] = count.get(k, 0) + 1
    out = []
    for t in texts:
        lines = (t or "").split("\n")
        keep = [x for x in lines if not key(x) or count[key(x)] < limit]
        out.append(("\n".join(keep), len(lines), len(lines) - len(keep)))
    return out


def result(docs, index):
    return sorted((r["kept_text"], r["n_lines"], r["n_dropped"]) for r in ld.drop_lines(docs, index).collect())


@pytest.mark.parametrize("filter_bytes", [ld.FILTER_BYTES, 0])
def test_same_as_brute_force(spark, odd_docs, monkeypatch, filter_bytes):
    monkeypatch.setattr(ld, "FILTER_BYTES", filter_bytes)
    index = ld.LineIndex(spark)
    index.add(odd_docs)
    assert result(odd_docs, index) == sorted(brute([d[1] for d in documents()]))


def test_shards_double_and_stay_right_beyond_the_broadcast(spark, odd_docs, monkeypatch):
    monkeypatch.setattr(ld, "FILTER_BYTES", 0)
    index = ld.LineIndex(spark, shard_keys=16)
    seen = []
    for part in ("doc_id < 3", "doc_id >= 3 and doc_id < 60", "doc_id >= 60 or doc_id is null"):
        index.add(odd_docs.where(part))
        seen.append(index.shards)
        assert index.counts.count() <= index.shards * 16
    assert seen == sorted(seen) and seen[0] < seen[1] <= seen[2]
    assert result(odd_docs, index) == sorted(brute([d[1] for d in documents()]))
    # the filters decide what meets the exact counts: all frequent lines, few others
    lines = odd_docs.select(F.col("doc_id").alias("doc"), ld.line_keys(F.col("text")).alias("line_keys"))
    every = lines.select(F.explode("line_keys").alias("key")).where("key is not null")
    frequent = every.join(index.frequent(), "key", "left_semi").count()
    assert frequent <= index._probe_by_shard(lines).count() <= frequent + every.count() // 50
    assert index._probe_by_shard(lines).join(index.frequent(), "key").count() == frequent


def test_deletion_brings_lines_back(spark, odd_docs):
    texts = [d[1] for d in documents()]
    index = ld.LineIndex(spark, shard_keys=8)                  # many shards
    first, second = odd_docs.where("doc_id < 65"), odd_docs.where("doc_id >= 65 or doc_id is null")
    index.add(first)
    assert index.shards > 1
    index.add(second)
    assert result(odd_docs, index) == sorted(brute(texts))
    some = odd_docs.where("doc_id in (60, 61, 62)")
    index.delete(some)
    rest = odd_docs.where("doc_id is null or doc_id not in (60, 61, 62)")
    left = [d[1] for d in documents() if d[0] not in (60, 61, 62)]
    assert result(rest, index) == sorted(brute(left))
    index.add(some)
    assert result(odd_docs, index) == sorted(brute(texts))


def test_cuckoo_filter_adds_finds_and_removes():
    rng = np.random.default_rng(2)
    h, other = (rng.integers(0, 1 << 63, 3000).astype(np.uint64) * np.uint64(2) for _ in range(2))
    f = ld.updated(None, h, h[:0], h)
    assert f.has(h).all() and f.has(other).mean() < 0.01
    f = ld.CuckooFilter.from_bytes(f.to_bytes())
    f.remove(h[:1000])
    assert f.has(h[1000:]).all() and f.has(h[:1000]).mean() < 0.01


def test_full_filter_grows():
    rng = np.random.default_rng(3)
    h = rng.integers(0, 1 << 63, 4000).astype(np.uint64)
    small = ld.updated(None, h[:10], h[:0], h[:10])
    grown = ld.updated(small.to_bytes(), h, h[:0], h[10:])
    assert grown.has(h).all() and len(grown.table) > len(small.table)


def test_empty_table_and_clashing_columns(spark, no_docs, odd_docs):
    index = ld.LineIndex(spark)
    index.add(no_docs)
    assert ld.drop_lines(no_docs, index).count() == 0
    index.add(odd_docs)
    docs = clashing(odd_docs, "doc", "drop", "key", "line", "kept_text", "row", "text_hash", "documents").withColumn("tags", F.array("doc_id"))
    out = ld.drop_lines(docs, index)
    assert out.columns[-3:] == ["kept_text", "n_lines", "n_dropped"] and out.count() == len(documents())
    assert {r["drop"] for r in out.collect()} == {"own drop"}


def test_query(spark, docs_dir):
    got = sorted((r["n_lines"], r["n_dropped"], r["kept_sha256"]) for r in ld.op7_cuckoo_lines(spark, docs_dir).collect())
    assert got == sorted((n, g, hashlib.sha256(t.encode()).hexdigest()) for t, n, g in brute([d[1] for d in documents()]))
