"""Source divergence against plain Python integers."""

import random
import re

import numpy as np
import pyarrow as pa
import pytest
from odd_rows import clashing, documents, low
from tessera.llm import divergence as dv

SCHEMA = "doc_id long, text string, lang string, source string"
TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")


def brute(docs, least):
    rows = [(lang or "", source or "", TERM.findall(low(text or ""))) for text, lang, source in docs]
    out = []
    for lang in {r[0] for r in rows}:
        mine = [r for r in rows if r[0] == lang]
        seen, counts = {}, {}
        for _, source, words in mine:
            for w in set(words):
                seen[w] = seen.get(w, 0) + 1
            for w in words:
                counts.setdefault(source, {}).setdefault(w, 0)
                counts[source][w] += 1
        kept = [w for w, n in seen.items() if n >= least]
        v, sources = len(kept), {r[1] for r in mine}
        count = {s: {w: counts.get(s, {}).get(w, 0) for w in kept} for s in sources}
        whole = {w: sum(count[s][w] for s in sources) for w in kept}

        def share(c):
            total = sum(c.values())
            return {w: 1 + 10 ** 9 * (c[w] + 5) // (total + 5 * v) for w in kept}

        p, q = {s: share(count[s]) for s in sources}, share(whole)
        for s in sources:
            pairs = [("pair", o, sum(abs(p[s][w] - p[o][w]) for w in kept)) for o in sources if o != s]
            terms = [("term", w, p[s][w] - q[w]) for w in kept if count[s][w] and p[s][w] > q[w]]
            for part in (pairs, sorted(terms, key=lambda x: (-x[2], x[1].encode()))[:50]):
                for rank, (kind, item, value) in enumerate(sorted(part, key=lambda x: (-x[2], x[1].encode())), 1):
                    out.append((lang, s, kind, item, value, rank))
    return sorted(out)


def corpus(n=400, seed=2):
    rng = random.Random(seed)
    words = [f"{a}{b}" for a in "abcdéz漢" for b in ("", "x", "Y", "ö", "xy", "zz")]
    out = []
    for i in range(n):
        lang, source = rng.choice(["en", "en", "de", None]), rng.choice(["s1", "s1", "s2", "S2", "é", None])
        mine = words[rng.randint(0, 9):][:rng.randint(1, 20)]
        out.append((i, " ".join(rng.choice(mine) for _ in range(rng.randint(0, 40))) + rng.choice(["", ".1,2_", "\n[x]"]), lang, source))
    return out + [(None, None, "en", "s9"), (1, "", "xx", "s1"), (2, "only here", "yy", "one"), (3, None, None, None), (3, None, None, None)]


@pytest.mark.parametrize("options", [{}, {"shard_rows": 7}])
def test_same_as_brute_force(spark, options, monkeypatch):
    rows = corpus()
    if options:
        monkeypatch.setattr(dv, "CELLS", 12)                # blocks of sources and of terms
        monkeypatch.setattr(dv, "HELD_ROWS", 20)            # several partial counts per task
    docs = clashing(spark.createDataFrame(rows, SCHEMA).repartition(4), "term", "n", "shard", "part")
    got = sorted(tuple(r) for r in dv.audit(docs, min_documents=10, **options).collect())
    assert got == brute([r[1:] for r in rows], 10)


def test_odd_documents(spark, odd_docs):
    got = sorted(tuple(r) for r in dv.audit(odd_docs, min_documents=2).collect())
    assert got == brute([(d[1], d[2], d[3]) for d in documents()], 2)
    none = sorted(tuple(r) for r in dv.audit(odd_docs, min_documents=10 ** 6).collect())
    assert none and all(r[2] == "pair" and r[4] == 0 for r in none)                # V = 0


def test_more_terms_than_ranks(spark):
    """Ties at the last rank go by item, whatever the shard."""
    terms = [f"t{chr(97 + i // 26)}{chr(97 + i % 26)}" for i in range(200)]
    rows = [(i, " ".join(terms), "en", "a") for i in range(3)] + [(9, "other", "en", "b")] * 3
    for shard_rows in (dv.SHARD_ROWS, 30):
        got = sorted(tuple(r) for r in dv.audit(spark.createDataFrame(rows, SCHEMA), min_documents=3, shard_rows=shard_rows).collect())
        assert got == brute([r[1:] for r in rows], 3)


def test_empty_table(spark, no_docs):
    assert dv.audit(no_docs).collect() == []


def test_counts_of_a_batch():
    t = pa.table({"lang": ["en", "en"], "source": ["a", "a"], "text": ["Éa BB bb-1ÀB", ""]})
    got = {(r["term"], r["n"], r["docs"]) for r in dv.term_counts(t).to_pylist()}
    assert got == {("Éa", 1, 1), ("bb", 2, 1), ("Àb", 1, 1)}


def test_shares_beyond_64_bits():
    rng = random.Random(4)
    for _ in range(200):
        n, v = rng.randint(0, 8 * 10 ** 15), rng.randint(1, 10 ** 8)
        c = rng.randint(0, n)
        assert dv.shares(np.array([c]), np.array([n]), v)[0] == 1 + 10 ** 9 * (c + 5) // (n + 5 * v)
