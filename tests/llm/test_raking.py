"""Raking: margins meet their targets, probabilities are bounded, draws are fixed."""

import math

import pytest
from odd_rows import clashing, documents
from pyspark.sql import functions as F
from tessera.llm import raking


def rows(spark, cells):
    """measured rows from {(source, lang, topic): tokens}."""
    return spark.createDataFrame([(f"={s}", f"={a}", t, n) for (s, a, t), n in cells.items()],
                                 "mix_source string, mix_lang string, mix_topic string, mix_tokens long")


CELLS = {("a", "en", "x"): 6000, ("a", "de", "x"): 1000, ("a", "en", "y"): 2000, ("b", "en", "x"): 1500, ("b", "de", "y"): 2500,
         ("c", "de", "x"): 800, ("c", "en", "y"): 1200, ("c", "de", "y"): 700}


def margin(out, key):
    got = {}
    for r in out:
        got[r[key]] = got.get(r[key], 0) + r["probability"] * r["tokens"]
    return got


def test_given_shares_are_met(spark):
    shares = {"source": {"a": 0.4, "b": 0.35, "c": 0.25}, "lang": {"en": 0.6, "de": 0.4}}
    out = raking.rake(rows(spark, CELLS), rate=0.3, rounds=30, shares=shares, power={"topic": 1.0}).collect()
    total = sum(CELLS.values())
    for key, want in (("mix_source", shares["source"]), ("mix_lang", shares["lang"])):
        for value, tokens in margin(out, key).items():
            assert tokens == pytest.approx(want[value[1:]] * 0.3 * total, rel=1e-3)
    assert all(0 < r["probability"] <= 1 for r in out)


def test_a_scarce_value_gives_all_it_has(spark):
    out = raking.rake(rows(spark, CELLS), rate=0.9, shares={"source": {"a": 0.1, "b": 0.1, "c": 0.8}}, power={}).collect()
    assert max(r["probability"] for r in out if r["mix_source"] == "=c") == 1.0


def test_value_without_share_gets_nothing(spark):
    out = raking.rake(rows(spark, CELLS), shares={"source": {"a": 0.5, "b": 0.5}}).collect()
    assert all(r["probability"] == 0 for r in out if r["mix_source"] == "=c")


def test_margins_are_met_with_the_production_parameters(spark):
    """Targets above their tokens (z, and c of a hot margin's partners) go to the other values; all margins meet theirs."""
    cells = CELLS | {("a", "en", "z"): 60, ("b", "de", "z"): 40, ("hot", "en", "x"): 30000, ("hot", "de", "y"): 6000,
                     ("hot", "en", "y"): 3000, ("hot", "de", "x"): 3000}
    out = raking.rake(rows(spark, cells))
    want = raking.RATE * sum(cells.values())
    left = raking.residuals(out).collect()
    assert max(abs(r["expected"] - r["target"]) for r in left) <= raking.TOLERANCE * want
    for d in raking.DIMENSIONS:
        assert sum(r["expected"] for r in left if r["dimension"] == d) == pytest.approx(want, rel=1e-5)
    z = [r["probability"] for r in out.collect() if r["mix_topic"] == "z"]
    assert z == pytest.approx([1.0] * 2, abs=1e-3)


def test_few_cells_are_raked_without_an_exchange(spark, monkeypatch):
    """The rounds of a small table of cells have no shuffle; a larger table is shuffled and comes to the same."""
    def raked():
        plans, write = {}, raking.Scratch.write
        with monkeypatch.context() as m:
            m.setattr(raking.Scratch, "write", lambda self, df, name: plans.update(
                {name: df._jdf.queryExecution().executedPlan().toString()}) or write(self, df, name))
            out = raking.rake(rows(spark, CELLS), rounds=8, tolerance=0).collect()
        return [p for n, p in plans.items() if n in ("round4", "round8")], {tuple(r)[:3]: r["probability"] for r in out}

    plans, few = raked()
    assert len(plans) == 2 and not any("Exchange" in p for p in plans)
    monkeypatch.setattr(raking, "CELLS_AT_ONCE", 0)
    plans, many = raked()
    assert all("Exchange" in p for p in plans)
    assert many == pytest.approx(few, rel=1e-9)


def test_default_lowers_the_hot_source(spark):
    out = raking.rake(rows(spark, {("hot", "en", "x"): 9000} | {(f"s{i}", "en", "x"): 500 for i in range(6)})).collect()
    p = {r["mix_source"]: r["probability"] for r in out}
    assert p["=hot"] < p["=s0"] == pytest.approx(p["=s5"])


def test_draws_are_uniform_and_fixed(spark):
    df = spark.range(4000).select(F.col("id").alias("doc_id"), F.lit("t").alias("text"))
    draws = [r[0] for r in df.select(raking.draw("doc_id", "text")).collect()]
    assert 0 <= min(draws) and max(draws) < 1 and abs(sum(draws) / 4000 - 0.5) < 0.02
    assert draws == [r[0] for r in df.repartition(1).sort("doc_id").select(raking.draw("doc_id", "text")).collect()]
    assert draws != [r[0] for r in df.select(raking.draw("doc_id", "text", 9)).collect()]


def test_sample_meets_expected_tokens(spark):
    docs = spark.range(3000).select(
        F.col("id").alias("doc_id"), F.repeat(F.lit("word "), (F.col("id") % 50 + 10).cast("int")).alias("text"),
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("s"), F.col("id") % 5)).alias("source"),
        F.when(F.col("id") % 4 == 0, "de").otherwise("en").alias("lang"))
    measured = raking.measured(docs)
    cells = raking.rake(measured)
    s = raking.sampled(measured, cells).groupBy("mix_source").agg(
        F.sum(F.col("probability") * F.col("mix_tokens")).alias("want"), F.sum(F.when(F.col("sampled"), F.col("mix_tokens"))).alias("got"))
    for r in s.collect():
        assert abs(r["got"] - r["want"]) < 6 * math.sqrt(r["want"] * 60)


def test_odd_documents(spark, no_docs, odd_docs):
    docs = clashing(odd_docs, "probability", "sampled", "tokens", "mix_tokens", "mix_source", "row", "topic", "target_source")
    out = raking.mix(docs, rate=0.2)
    assert out.columns == docs.columns
    kept = [(r["doc_id"], r["text"]) for r in out.collect()]
    whole = [(d[0], d[1]) for d in documents()]
    assert 0 < len(kept) < len(whole) and all(k in whole for k in kept)
    assert all(kept.count(k) == whole.count(k) for k in kept)               # repeated rows stay together
    assert raking.mix(no_docs).count() == 0
    assert raking.mix(odd_docs.where("text is null or trim(text) = ''"), rounds=2).count() >= 0


def test_the_registered_query_meets_every_margin(spark):
    """With its parameters, on given documents: source, language and topic within 1e-5 of the expected tokens."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    cells = raking.rake(raking.measured(docs), rounds=raking.ROUNDS, tolerance=0)
    left = raking.residuals(cells).collect()
    total = cells.agg(F.sum("tokens")).first()[0]
    assert {r["dimension"] for r in left} == set(raking.DIMENSIONS)
    assert max(abs(r["expected"] - r["target"]) for r in left) <= 1e-5 * raking.RATE * total
    for d in raking.DIMENSIONS:
        assert sum(r["expected"] for r in left if r["dimension"] == d) == pytest.approx(raking.RATE * total, rel=1e-5)


def test_query_has_every_document(spark, docs_dir):
    got = raking.op8_raking(spark, docs_dir).collect()
    assert len(got) == len(documents()) and all(0 < r["probability"] <= 1 for r in got)
