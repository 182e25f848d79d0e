"""Base statistics against brute force; the robust estimates against numpy; verdicts on planted junk."""

import random
import re

import numpy as np
from odd_rows import clashing, documents, sentence
from tessera.llm import mcd

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    t = text or ""
    w = WORD.findall(t)
    lines = [x for x in t.split("\n") if WORD.search(x)]
    windows = {}
    for i in range(len(w) - 7):
        windows.setdefault(tuple(w[i:i + 8]), []).append(i)
    again = {j for at in windows.values() if len(at) > 1 for i in at for j in range(i, i + 8)}
    return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), len(again),
            len(w) < 20 or 100 * len(again) > 30 * len(w))


def test_base_statistics(spark, odd_docs):
    rows = mcd.text_statistics(odd_docs).collect()
    got = sorted(tuple(r[c] for c in (*mcd.BASE, "base_failed")) for r in rows)
    assert got == sorted(brute(d[1]) for d in documents())


def corpus():
    rng = random.Random(11)
    rows = []
    for i in range(400):
        text = sentence(rng, rng.randint(40, 200))
        if i % 10 == 3:                                                  # junk: symbols behind every word
            text = " ".join(w + rng.choice(["***", "%%%", "&&&"]) for w in text.split())
        lang, source = ("en", "big") if i % 2 else ("de", f"small{i % 40}")
        rows.append((i, text, lang, source, i % 10 == 3))
    return rows


def test_junk_goes_and_clean_documents_stay(spark):
    df = spark.createDataFrame(corpus(), "doc_id long, text string, lang string, source string, junk boolean")
    kept = {r["doc_id"] for r in mcd.keep_quality(df).collect()}
    assert kept == {r[0] for r in corpus() if not r[4]}


def test_estimates_are_a_small_determinant_of_a_half(spark):
    df = spark.createDataFrame(corpus(), "doc_id long, text string, lang string, source string, junk boolean")
    stats = mcd.text_statistics(df).drop("text").cache()
    model = mcd.fit(stats)
    est = {r["g"]: r for r in model.estimates.collect()}
    group = {(r["k1"], r["k2"]): r["g"] for r in model.groups.collect()}
    assert group["=en", "=big"].startswith("pair") and group["=de", "=small2"].startswith("lang")
    floors = np.array(list(mcd.FLOORS.values()))
    x = np.array([[r[f] for f in mcd.FLOORS] for r in stats.where("lang = 'en' and not base_failed").collect()])
    e = est[group["=en", "=big"]]
    low = np.array([[e[f"l{i}{j}"] if j <= i else 0.0 for j in range(4)] for i in range(4)])
    m = np.array([e[f"m{i}"] for i in range(4)])
    d = (np.linalg.solve(low, (x - m).T) ** 2).sum(0)
    half = x[d <= np.quantile(d, 0.5)]
    again = np.cov(half.T) + np.diag(floors ** 2)
    # another concentration step hardly lowers the determinant, and random halves have a larger one
    assert np.linalg.det(again) > 0.8 * np.linalg.det(low @ low.T)
    rng = np.random.default_rng(0)
    for _ in range(20):
        h = x[rng.choice(len(x), len(x) // 2, replace=False)]
        assert np.linalg.det(np.cov(h.T) + np.diag(floors ** 2)) > np.linalg.det(low @ low.T)
    judged = mcd.judge(stats, model)
    out = np.array(sorted(r["outlyingness"] for r in judged.where("lang = 'en' and not base_failed").collect()))
    assert np.allclose(out, np.sort(d / max(1.0, float(e["scale"]))), rtol=1e-6)


def test_few_documents_are_judged_by_the_base_rule_alone(spark, odd_docs):
    kept = mcd.keep_quality(odd_docs)
    assert kept.columns == odd_docs.columns
    assert sorted(str(r["doc_id"]) for r in kept.collect()) == sorted(str(d[0]) for d in documents() if not brute(d[1])[-1])


def test_empty_table_and_clashing_columns(spark, no_docs, odd_docs):
    assert mcd.keep_quality(no_docs).count() == 0
    docs = clashing(odd_docs, "n_words", "kept", "base_failed", "row", "g", "k1", "document", "m0", "mcd_words", "outlyingness")
    out = mcd.keep_quality(docs)
    assert out.columns == docs.columns and {r["kept"] for r in out.collect()} == {"own kept"}


def test_verdict_does_not_depend_on_partitions(spark):
    df = spark.createDataFrame(corpus(), "doc_id long, text string, lang string, source string, junk boolean")
    one, many = (sorted(r["doc_id"] for r in mcd.keep_quality(df.repartition(k)).collect()) for k in (1, 6))
    assert one == many


def test_query(spark, docs_dir):
    rows = mcd.op4_mcd_outliers(spark, docs_dir).collect()
    assert len(rows) == len(documents()) and not any(r["kept"] and r["base_failed"] for r in rows)
