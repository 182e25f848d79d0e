"""Odd documents, and brute-force versions of the contracts, for the training-data operators."""

from __future__ import annotations

import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def sentence(rng: random.Random, n: int) -> str:
    return " ".join("".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 7))) for _ in range(n))


def documents() -> list[tuple]:
    """Nulls, empty and very long texts, repeated rows, copies, near copies and shared passages."""
    rng = random.Random(7)
    base = [sentence(rng, 120) for _ in range(6)]
    passage = sentence(rng, 60)
    rows = [(i, b, "en", "s0", len(b)) for i, b in enumerate(base)]
    rows += [(10, base[0], "en", "s1", 1), (11, base[0], None, None, None), (11, base[0], None, None, None)]       # copies, a repeated row
    near = base[1].split()
    near[60] = "changed"
    rows += [(12, " ".join(near), "de", "s0", 5), (13, base[1].upper(), "de", "s0", 5), (14, base[1].replace(" ", "\n"), "de", "s0", 5)]
    rows += [(20 + i, f"{sentence(rng, 30)} {passage} {sentence(rng, 25)}", "fr", "s2", 9) for i in range(4)]
    rows += [(30, f"{passage} {passage}", "fr", "s2", 9), (31, "la " * 100, "fr", "s2", 9), (32, "ab cd " * 60, "fr", "s2", 9)]
    rows += [(40, None, "en", "s0", None), (41, "", "en", "s0", 0), (42, " \t\n ", "en", "s0", 4), (43, "one two", "en", "s0", 7),
             (44, "two words", None, "s0", 9), (45, "One  TWO", "en", None, 8), (46, "\n\n \nx\n", "en", "s0", 6)]
    rows += [(None, base[2], "en", "s0", 1), (None, None, None, None, None), (None, "no id here", "en", "s0", 1)]
    rows += [(50, sentence(rng, 20000), "en", "s0", 1), (51, "É È ünïcödé 漢字 " + sentence(rng, 40) + "\r\n\u000bend", "en", "s0", 1)]
    rows += [(60 + i, f"shared header\n{sentence(rng, 30)}\n  SHARED Footer \n", "es", "s3", 1) for i in range(12)]
    return rows


def low(s: str) -> str:
    """A-Z lower-cased."""
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in s)


def clashing(docs, *names):
    """The documents with more columns of the names that an operator uses."""
    from pyspark.sql import functions as F
    return docs.withColumns({n: F.lit(f"own {n}") for n in names})
