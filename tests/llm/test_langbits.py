"""Language identification: held-out accuracy, filters against plain sets, odd texts."""

import random
import zlib

import numpy as np
import pytest
from odd_rows import clashing
from pyspark.sql import functions as F
from tessera.llm import langbits as lb

SCHEMA = "doc_id long, text string, lang string, source string"
SYLLABLES = {"aa": "the ing wh on re th ed an".split(), "bb": "der ich sch ein ung üb ä ver".split(),
             "cc": "que ción ñ os as mente lla".split(), "zh": "漢 字 文 書 日 本".split()}


def text(lang, n, rng):
    return " ".join("".join(rng.choice(SYLLABLES[lang]) for _ in range(rng.randint(1, 3))) for _ in range(n)).capitalize()


def labelled():
    rng = random.Random(3)
    return [(i, text(lang, rng.choice([3, 20, 200]), rng), lang, "s") for i in range(240) for lang in [rng.choice(list(SYLLABLES))]]


def judged(spark, docs, rows=None):
    df = spark.createDataFrame(docs, SCHEMA).repartition(3)
    found = lb.identify(spark.createDataFrame(rows or docs, SCHEMA), lb.learn(df))
    return {r["doc_id"]: (r["lang_pred"], r["lang_score"]) for r in found.collect()}


def test_held_out_documents(spark):
    docs = labelled()
    found = judged(spark, docs)
    out = [d for d in docs if zlib.crc32(str(d[0]).encode()) % 3 == 1]
    assert len(out) > 50
    assert sum(found[d[0]][0] == d[2] for d in out) / len(out) > 0.97
    assert all(0 <= s <= 1 for _, s in found.values())


def test_held_out_labels_are_not_learned(spark):
    docs = labelled()
    swapped = [(i, t, "xx" if zlib.crc32(str(i).encode()) % 3 == 1 else lang, s) for i, t, lang, s in docs]
    assert judged(spark, swapped) == judged(spark, docs)


def test_only_the_text_decides(spark):
    docs = labelled()
    found = judged(spark, docs)
    other = [(i + 1000, t, None, None) for i, t, _, _ in docs]
    assert {i - 1000: v for i, v in judged(spark, docs, other).items()} == found


def test_filters_hold_what_sets_hold(spark):
    """Every language that has an n-gram is in its mask; few others are."""
    rng, letters = random.Random(9), lb.Letters()
    sets = [np.unique(np.concatenate(list(lb.gram_pieces(letters.of(text(k, 300, rng)))))) for k in SYLLABLES] * 20   # 80 languages: two words
    blooms = np.zeros((len(sets), 1 << 14), np.uint8)
    for bloom, grams in zip(blooms, sets):
        for p in lb.places(grams, 1 << 17):
            np.bitwise_or.at(bloom, p >> 3, (1 << (p & 7)).astype(np.uint8))
    filters = lb.Filters.of([str(i) for i in range(len(sets))], blooms)
    assert filters.rows.shape == (1 << 17, 2)
    every = np.unique(np.concatenate(sets))
    bits = np.unpackbits(filters.masks(every).view(np.uint8).reshape(len(every), -1), axis=1, bitorder="little", count=len(sets))
    for i, grams in enumerate(sets):
        has = np.isin(every, grams)
        assert bits[has, i].all() and bits[~has, i].mean() < 0.01


def test_false_hits_are_taken_off():
    """With full filters of random bits, counts of unknown n-grams come out near nothing."""
    rng = np.random.default_rng(1)
    density = (0.9, 0.5)
    blooms = np.array([np.packbits(rng.random(1 << 12) < d, bitorder="little") for d in density])
    filters = lb.Filters.of(["full", "half"], blooms)
    assert filters.false == pytest.approx([0.729, 0.125], abs=0.05)
    points = lb.Letters().of(" ".join("".join(chr(rng.integers(0x4E00, 0x9000)) for _ in range(5)) for _ in range(3000)))
    found, n = filters.hits(points)
    assert found / n == pytest.approx([0.729, 0.125], abs=0.06)
    true = (found - n * filters.false) / (1 - filters.false)
    assert (abs(true) / n < 0.05).all()


def test_pieces_of_long_texts():
    points = lb.Letters().of("Abc d éf1gh " * 5000)
    whole = next(lb.gram_pieces(points, len(points)))
    for step in (7, 256, 10_000):
        parts = np.concatenate(list(lb.gram_pieces(points, step)))
        assert np.array_equal(np.sort(parts), np.sort(whole))


def test_odd_texts(spark):
    docs = labelled()
    odd = [(None, None, None, None), (1, "", "aa", "s"), (2, " 12 -- \n", "aa", "s"), (3, "ы", None, None), (4, "the", "aa", None),
           (4, "the", "aa", None), (5, text("bb", 40_000, random.Random(1)), None, None)]
    df = clashing(spark.createDataFrame(docs + odd, SCHEMA), "h", "n", "text_read", "Lang_Pred")
    found = lb.identify(df.where("doc_id < 6 or doc_id is null"), lb.learn(df))
    assert found.columns == ["doc_id", "text", "lang", "source", "h", "n", "text_read", "lang_pred", "lang_score"]
    got = [(r["text"], r["lang_pred"], r["lang_score"]) for r in found.collect()]
    by = {t: p for t, p, _ in got}
    assert [by[t] for t in (None, "", " 12 -- \n")] == ["und"] * 3
    assert by["ы"] in SYLLABLES and by["the"] == "aa" and by[odd[-1][1]] == "bb"
    assert sum(t == "the" for t, _, _ in got) == 2 and all(s == 0 for t, p, s in got if p == "und")


def test_nothing_to_learn_from(spark, no_docs):
    docs = [(1, "some words", None, None)]
    assert judged(spark, docs) == {1: ("und", 0.0)}
    assert lb.identify(no_docs, lb.learn(no_docs)).collect() == []


def test_sample_is_bounded(spark):
    docs = spark.range(3000).select(F.col("id").alias("doc_id"), F.lit("same words in all").alias("text"), F.lit("aa").alias("lang"))
    filters = lb.learn(docs, sample=50)
    assert filters.languages == ["aa"] and filters.judge("same words", lb.Letters()) == ("aa", 1.0)


def test_too_many_labels(spark, monkeypatch):
    monkeypatch.setattr(lb, "MOST_LANGUAGES", 3)
    with pytest.raises(ValueError):
        lb.learn(spark.createDataFrame(labelled(), SCHEMA))
