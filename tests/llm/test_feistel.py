"""Feistel sharding: a bijection, reproducible, whole on odd input."""

import zlib

import pytest
from odd_rows import clashing, documents
from pyspark.sql import functions as F
from tessera.llm import feistel


@pytest.mark.parametrize("n", [1, 2, 3, 5, 24, 97, 100, 1001])
def test_permutation_of_row_numbers(spark, n):
    got = [r[0] for r in spark.range(n).select(feistel.permute(F.col("id"), n).alias("p")).collect()]
    assert sorted(got) == list(range(n))


def test_domain_is_near_square_and_large_enough():
    for n in (0, 1, 2, 10, 99, 10**9 + 7):
        a, b = feistel.domain(n)
        assert a * b >= n and a * b - n < max(a, 1) + 1


def test_seed_changes_and_fixes_the_order(spark):
    def order(seed):
        return [r[0] for r in spark.range(50).select(feistel.permute(F.col("id"), 50, seed).alias("p")).collect()]
    assert order(1) == order(1) != order(2)


def test_rows_law_and_gapless_slots(spark, odd_docs):
    out = feistel.shuffle_shards(odd_docs, ["doc_id", "text"], shards=7).collect()
    assert len(out) == len(documents())
    counts = [sorted(r["slot"] for r in out if r["shard"] == s) for s in range(7)]
    assert max(map(len, counts)) - min(map(len, counts)) <= 1
    assert all(c == list(range(len(c))) for c in counts)


def test_places_do_not_depend_on_partitions(spark, odd_docs):
    def places(df):
        return sorted(((r["doc_id"], r["text"]), r["shard"], r["slot"]) for r in
                      feistel.shuffle_shards(df.where("doc_id is not null and text is not null"), ["doc_id", "text"]).collect())
    assert places(odd_docs.repartition(1)) == places(odd_docs.repartition(5))


def test_empty_table_and_clashing_columns(spark, no_docs, odd_docs):
    assert feistel.shuffle_shards(no_docs, ["doc_id"]).columns[-2:] == ["shard", "slot"]
    assert feistel.shuffle_shards(no_docs, ["doc_id"]).count() == 0
    out = feistel.shuffle_shards(clashing(odd_docs, "tie", "part", "place", "offset", "row_number", "Shard"), ["doc_id"])
    assert out.columns[-7:] == ["tie", "part", "place", "offset", "row_number", "shard", "slot"]
    assert {r["tie"] for r in out.collect()} == {"own tie"}


def test_written_shards_read_back_in_slot_order(spark, odd_docs, tmp_path):
    out = feistel.shuffle_shards(odd_docs.select("doc_id"), ["doc_id"], shards=3)
    feistel.write_shards(out, str(tmp_path / "s"))
    back = spark.read.parquet(str(tmp_path / "s"))
    assert sorted(map(str, back.select("doc_id", "shard", "slot").collect())) == sorted(map(str, out.select("doc_id", "shard", "slot").collect()))


def test_query_columns(spark, docs_dir):
    rows = feistel.op10_feistel_shards(spark, docs_dir).collect()
    texts = sorted(((d[1] or "").encode() for d in documents()), key=lambda t: (len(t), zlib.crc32(t)))
    assert [(len(t) + 8, zlib.crc32(t)) for t in texts] == sorted((r["size"], r["text_crc32"]) for r in rows)
    assert {r["law"] for r in rows} == {"rows"} and {r["grown_shard"] for r in rows} == {None}
