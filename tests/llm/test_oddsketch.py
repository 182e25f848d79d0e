"""Near-duplicate groups against all pairs; accuracy of odd sketches."""

import random
import re

import numpy as np
import pyarrow as pa
import pytest
from odd_rows import clashing, documents, low, sentence
from tessera.llm import oddsketch as od

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shingle_set(text):
    w = WORD.findall(low(text or ""))
    return {tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def brute(rows):
    """Sorted (id, shingles, component) by all pairs."""
    sets = [shingle_set(t) for _, t in rows]
    group = list(range(len(rows)))

    def find(i):
        while group[i] != i:
            i = group[i]
        return i
    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if sets[i] and sets[j] and 100 * both >= 75 * len(sets[i] | sets[j]):
                group[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[find(i)] = min(least.get(find(i), d), d)
    return sorted((d, len(sets[i]), least[find(i)]) for i, (d, _) in enumerate(rows) if d is not None)


def got(df):
    rows = od.near_duplicates(df).collect()
    assert all(r["kept"] == (r["doc_id"] is None or r["doc_id"] == r["component_id"]) for r in rows)
    assert all(r["component_id"] is None for r in rows if r["doc_id"] is None)
    return sorted((r["doc_id"], r["n_shingles"], r["component_id"]) for r in rows if r["doc_id"] is not None)


def test_same_as_all_pairs(spark, odd_docs):
    assert got(odd_docs) == brute([(d[0], d[1]) for d in documents()])


def chains():
    """Texts that drift a little in every step: links join far ends that are not similar."""
    rng = random.Random(5)
    rows = []
    for c in range(4):
        w = sentence(rng, 60 + 20 * c).split()
        for k in range(25):
            rows.append((1000 * c + (k * 7) % 25, " ".join(w)))
            w[rng.randrange(len(w))] = f"new{c}x{k}"
    return rows


def test_chains_are_one_component(spark):
    rows = chains()
    want = brute(rows)
    assert len({c for _, _, c in want}) < 30
    assert got(spark.createDataFrame(rows, "doc_id long, text string").repartition(4)) == want


def test_null_ids_link_their_neighbours(spark):
    """A chain whose every second text, some of them in copies, has no id."""
    rng = random.Random(11)
    w = sentence(rng, 60).split()
    rows = []
    for k in range(9):
        named = k % 2 == 0
        rows += [(k if named else None, " ".join(w))] * (1 if named else 3)
        w[6 * k + 4] = f"changed{k}"
    rows += [(None, "alone here and without any id at all"), (None, None), (None, "")]
    want = brute(rows)
    assert {c for _, _, c in want} == {0} and len(brute([r for r in rows if r[0] is not None])) == 5
    assert len({c for _, _, c in brute([r for r in rows if r[0] is not None])}) == 5
    assert got(spark.createDataFrame(rows, "doc_id long, text string")) == want


def test_sketch_estimates_high_similarities():
    rng = np.random.default_rng(1)
    for j in (0.95, 0.85, 0.75, 0.5):
        errors, over = [], 0
        for _ in range(40):
            n = 600
            same = int(round(2 * n * j / (1 + j)))
            a = rng.integers(0, 1 << 63, n).astype(np.uint64)
            b = np.concatenate([a[:same], rng.integers(0, 1 << 63, n - same).astype(np.uint64)])
            s = od.odd_sketch(od.minhash([np.unique(a), np.unique(b)]))
            z = int(np.unpackbits((s[0] ^ s[1]).view(np.uint8)).sum())
            errors.append(od.estimate(z) - j)
            over += z > od.sketch_limit()
        assert abs(np.mean(errors)) < 0.03 and (over == 0 if j >= 0.75 else True)


def test_keep_one(spark, odd_docs):
    docs = clashing(odd_docs, "id", "text_hash", "component_id", "row", "digest")
    out = od.keep_one(docs)
    assert out.columns == docs.columns
    want = sorted({d for d, _, c in brute([(d[0], d[1]) for d in documents()]) if d == c})
    ids = [r["doc_id"] for r in out.collect()]
    assert sorted(i for i in ids if i is not None) == want and ids.count(None) == 3


def test_empty_tables(spark, no_docs):
    assert od.near_duplicates(no_docs).count() == 0 and od.keep_one(no_docs).count() == 0


def test_components_of_a_long_path(spark):
    from tessera.llm.common import Scratch
    links = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 101)], "a long, b long")
    out = {r["node"]: r["component"] for r in od.components(links, Scratch(spark, "t"), "x").collect()}
    assert out == {i: 0 for i in range(41)} | {100: 100, 101: 100}


@pytest.mark.parametrize("text", [None, "", " \n", "a b", "a b c d e", "a b c d e f"])
def test_shingles_of_short_texts(text):
    h, first = od.shingles(pa.array([text], pa.string()))
    assert len(np.unique(h)) == len(shingle_set(text)) == first[-1]
