"""Wu-Manber search against a brute-force scan of all windows."""

import hashlib
import random
import re

import pyarrow as pa
import pytest
from odd_rows import clashing, documents, low, sentence
from tessera.llm import wumanber as wm
from tessera.llm.tokens import ALNUM_WORD, find_words

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
ITEMS = [(1, " ".join((documents()[3][1]).split()[10:40])), (2, documents()[4][1].upper()), (3, "two words"), (4, None), (5, ""),
         (6, "one"), (2, documents()[4][1]), (None, "ab cd ab"), (10, "É È ünïcödé"), (7, "la la la la la la la la la la la la la la")]


def words(text):
    return WORD.findall(low(text or ""))


def brute(text, items, size=13):
    w, hit, found = words(text), set(), set()
    for item, t in items:
        p = words(t)
        k = min(size, len(p))
        windows = {tuple(p[i:i + k]) for i in range(len(p) - k + 1)} if k else set()
        for i in range(len(w) - k + 1):
            if tuple(w[i:i + k]) in windows:
                hit |= set(range(i, i + k))
                found.add("" if item is None else str(item))
    return len(w), len(hit), sorted(found)


@pytest.fixture(scope="module")
def bench(spark):
    return spark.createDataFrame(ITEMS, "item_id long, text string")


@pytest.mark.parametrize("block_bytes", [wm.BLOCK_BYTES, 300])
def test_same_as_brute_force(spark, odd_docs, bench, block_bytes):
    got = wm.find_benchmark(odd_docs, bench, block_bytes=block_bytes).collect()
    assert len(got) == len(documents())
    for r in got:
        n, hit, items = brute(r["text"], ITEMS)
        assert (r["bench_words"], sum(s["end"] - s["start"] for s in r["bench_spans"]), r["bench_items"]) == (n, hit, items)


def test_random_patterns_of_every_length():
    rng = random.Random(3)
    text = " ".join(rng.choice("abcde") for _ in range(4000))
    w = text.split()
    items = [(str(k), " ".join(w[k * 7:k * 7 + k])) for k in range(1, 30)]
    patterns = wm.Patterns(items)
    batch = pa.RecordBatch.from_arrays([pa.array([text, None, "", text[:50]])], names=["text"])
    counts, spans, found = wm._scan(batch, "text", patterns)
    for i, t in enumerate([text, None, "", text[:50]]):
        n, hit, names = brute(t, items)
        assert (counts[i], sum(b - a for a, b in wm.merged(spans[i])), sorted(found[i])) == (n, hit, names)


def test_shift_never_jumps_over_a_pattern_end():
    found = find_words(pa.array(["a b c d e f g h i j k l m n o p"]), ALNUM_WORD)
    p = wm.Patterns([("x", "d e f g"), ("y", "f g h i")])
    assert {s.m for s in p.searchers()} == {4} and len(found) == 16


def test_decontaminate_keeps_clean_rows_and_columns(spark, odd_docs, bench):
    docs = clashing(odd_docs, "bench_words", "bench_items", "spans", "items")
    kept = wm.decontaminate(docs, bench)
    assert kept.columns == docs.columns

    def dirty(text):
        n, hit, _ = brute(text, ITEMS)
        return hit > 0 and 20 * hit >= n
    assert sorted(str(r["doc_id"]) for r in kept.collect()) == sorted(str(d[0]) for d in documents() if not dirty(d[1]))


def test_empty_tables(spark, no_docs, odd_docs, bench):
    assert wm.find_benchmark(no_docs, bench).count() == 0
    none = spark.createDataFrame([], "item_id long, text string")
    assert wm.decontaminate(odd_docs, none).count() == len(documents())


def test_query_digests(spark, docs_dir, bench):
    bench.write.mode("overwrite").parquet(f"{docs_dir}/benchmark.parquet")
    for r in wm.op2_wu_manber(spark, docs_dir).where("doc_id is not null").dropDuplicates(["doc_id"]).collect():
        text = next(d[1] for d in documents() if d[0] == r["doc_id"])
        n, hit, items = brute(text, ITEMS)
        digest = hashlib.sha256(",".join(items).encode()).hexdigest()
        assert tuple(r)[1:] == (n, hit, len(items), digest, hit > 0 and 20 * hit >= n)


def test_long_text(spark, bench):
    text = sentence(random.Random(1), 150_000) + " " + documents()[4][1]
    (r,) = wm.find_benchmark(spark.createDataFrame([(1, text)], "doc_id long, text string"), bench).collect()
    assert r["bench_words"] == 150_120 and r["bench_items"] == ["2"]
