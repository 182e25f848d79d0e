"""Source divergence audit: how far the term shares of the sources of a language lie apart.

1. Counting, inside ``mapInArrow``, by Arrow compute kernels only: ``ascii_lower``, ``split_pattern_regex`` at
   everything that is no term, ``dictionary_encode`` of terms and groups, and two hash ``group_by``: by row
   and term (each document counts once), then by language, source and term.  A task sends partial counts.
2. Spark sums the partial counts per (language, source, term) and keeps the terms that are in at least
   ``MIN_DOCUMENTS`` documents of their language.
3. Kept counts are dealt by hash of the term into shards of about ``SHARD_ROWS`` counts, as many per
   language as its counts need, so a language with a third of all rows is spread over as many tasks.
   A shard is a columnar table of all its terms' counts with the sizes of all sources of the
   language beside it (cogroup).  It sums |p - q| for each pair of sources and finds its own ``TOP`` terms per source;
   sums over the shards, and the best of the shards' best, are the result.

Shares are ``p = 1 + floor(1e9 * (count + 5) / (N + 5 * V))`` with V kept terms of the language and N their count in
the group; a group is a (language, source) that occurs, or the whole language.  All arithmetic is on
integers: the product with 1e9 is taken in three steps, so counts up to 9e15 stay exact.

A shard works on ``CELLS`` cells of terms x sources, and on as many pairs, at a time.  The pairs themselves are S x S
rows for S sources, as the result has them.

Null text, language and source read as empty strings.  Repeated rows are documents of their own.
Groups without terms, and languages without kept terms (V = 0), still have their pairs, with value 0
where V is 0.  A language with one source has no pairs.  Ties: by item, as UTF-8.  An empty table gives no
rows.  Other columns play no part, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import Scratch, named, table
from tessera.llm.tokens import slices

BETWEEN = r"[\x00-\x40\x5B-\x60\x7B-\x7F]+"             # what separates terms
MIN_DOCUMENTS, SMOOTH, UNIT, TOP = 30, 5, 10 ** 9, 50
SLICE_BYTES = 4 << 20               # text counted at once in a task
HELD_ROWS = 1 << 18                 # partial counts that a task merges before it sends them
SHARD_ROWS = 1 << 17
CELLS = 1 << 21                     # terms x sources worked on at once in a shard
RESULT = "lang string, source string, part string, item string, value long, rank int"


def term_counts(rows: pa.Table) -> pa.Table:
    """lang, source, term, n, docs of a table with lang, source and text (no nulls)."""
    lists = pc.split_pattern_regex(pc.ascii_lower(rows["text"].combine_chunks()), pattern=BETWEEN)
    if isinstance(lists, pa.ChunkedArray):
        lists = lists.combine_chunks()
    parent, term = pc.list_parent_indices(lists), pc.list_flatten(lists)
    real = pc.not_equal(term, "")
    found = pa.table({"row": parent.filter(real), "term": term.filter(real).dictionary_encode()})
    by_row = found.group_by(["row", "term"], use_threads=False).aggregate([([], "count_all")])
    group = pa.table({k: rows[k].take(by_row["row"]) for k in ("lang", "source")} | {"term": by_row["term"], "n": by_row["count_all"]})
    out = group.group_by(["lang", "source", "term"], use_threads=False).aggregate([("n", "sum"), ([], "count_all")])
    return pa.table({"lang": out["lang"], "source": out["source"], "term": out["term"].cast(pa.string()),
                     "n": out["n_sum"].cast(pa.int64()), "docs": out["count_all"].cast(pa.int64())})


def _merged(parts: list[pa.Table]) -> pa.Table:
    out = pa.concat_tables(parts).group_by(["lang", "source", "term"], use_threads=False).aggregate([("n", "sum"), ("docs", "sum")])
    return out.rename_columns(["lang", "source", "term", "n", "docs"])


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Partial counts of a task; every group that occurs gives one row with a null term."""
    held: list[pa.Table] = []
    for rows in slices(batches, "text", SLICE_BYTES):
        t = pa.Table.from_batches([rows])
        groups = t.group_by(["lang", "source"], use_threads=False).aggregate([([], "count_all")])
        seen = pa.table({"lang": groups["lang"], "source": groups["source"], "term": pa.nulls(len(groups), pa.string()),
                         "n": pa.array(np.zeros(len(groups), np.int64)), "docs": groups["count_all"].cast(pa.int64())})
        held += [seen, term_counts(t)]
        if sum(map(len, held)) > HELD_ROWS:
            held = [_merged(held)]
            if len(held[0]) > HELD_ROWS // 2:
                yield from held.pop().to_batches()
    if held:
        yield from _merged(held).to_batches()


def shares(count: np.ndarray, n: np.ndarray | int, v: int) -> np.ndarray:
    """1 + floor(1e9 * (count + 5) / (n + 5 v)) without overflow: the quotient digit by digit in base 1000."""
    top, bottom = count + SMOOTH, n + SMOOTH * v
    whole, rest = np.divmod(top, bottom)
    for _ in range(3):
        digit, rest = np.divmod(rest * 1000, bottom)
        whole = whole * 1000 + digit
    return 1 + whole


def _shard(counts: pa.Table, groups: pa.Table) -> pa.Table:
    """Partial pair sums and the best terms of one shard of a language (see the module)."""
    lang, sources, sizes = groups["lang"][0].as_py(), groups["source"].combine_chunks(), groups["total"].to_numpy()
    out: list[pa.Table] = []

    def put(source: pa.Array, part: str, item: pa.Array, value: np.ndarray) -> None:
        same = {"lang": pa.repeat(lang, len(value)), "part": pa.repeat(part, len(value))}
        out.append(pa.table({"lang": same["lang"], "source": source, "part": same["part"], "item": item, "value": value}))

    terms = counts["term"].combine_chunks().dictionary_encode()
    term, words = terms.indices.to_numpy(), terms.dictionary
    source = pc.index_in(counts["source"], value_set=sources).to_numpy()
    n, v, total = counts["n"].to_numpy(), groups["v"][0].as_py(), int(sizes.sum())
    by_term, ends, s = np.argsort(term, kind="stable"), np.bincount(term, minlength=len(words)).cumsum(), len(sources)
    step = max(1, CELLS // s)
    for first in range(0, s, step):                         # a block of sources
        block = np.arange(first, min(s, first + step))
        pairs = np.zeros((len(block), s), np.int64)
        for at in range(0, len(words), step):               # against a block of terms
            to = min(len(words), at + step)
            rows = by_term[(ends[at - 1] if at else 0):ends[to - 1]]
            cell = np.zeros((to - at, s), np.int64)
            cell[term[rows] - at, source[rows]] = n[rows]
            p = shares(cell, sizes, v)
            for i, one in enumerate(block):
                pairs[i] += np.abs(p - p[:, one:one + 1]).sum(0)
            if first == 0:
                q = shares(cell.sum(1), total, v)
                above = np.where((cell > 0) & (p > q[:, None]), p - q[:, None], 0)
                if to - at > TOP:                           # all that reach the value of the TOP-th stay: ties go by item later
                    above[above < np.partition(above, -TOP, axis=0)[-TOP]] = 0
                word, one = np.nonzero(above)
                put(sources.take(one), "term", words.take(word + at), above[word, one])
        one, other = (x.ravel() for x in np.meshgrid(block, np.arange(s), indexing="ij"))
        real = one != other
        put(sources.take(one[real]), "pair", sources.take(other[real]), pairs.ravel()[real])
    return pa.concat_tables(out) if out else pa.table({k: [] for k in ("lang", "source", "part", "item", "value")})


def audit(docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source",
          min_documents: int = MIN_DOCUMENTS, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """Pairs of sources by summed difference of shares, and the terms that stand out in each source."""
    scratch = Scratch(docs.sparkSession, "divergence")
    clean = docs.select(*(F.coalesce(named(c).cast("string"), F.lit("")).alias(k) for k, c in (("lang", lang), ("source", source), ("text", text))))
    counts = scratch.write(
        clean.mapInArrow(_count, "lang string, source string, term string, n long, docs long")
        .groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs")), "counts")
    terms = counts.where("term is not null")
    often = terms.groupBy("lang", "term").agg(F.sum("docs").alias("d")).where(F.col("d") >= min_documents).select("lang", "term")
    kept = scratch.write(terms.join(often, ["lang", "term"]).select("lang", "source", "term", "n"), "kept")
    sizes = kept.groupBy("lang").agg(F.count_distinct("term").alias("v"), F.ceil(F.count("*") / shard_rows).alias("shards"))
    totals = kept.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    groups = counts.where("term is null").select("lang", "source").join(totals, ["lang", "source"], "left") \
        .join(sizes, "lang", "left").select("lang", "source", F.coalesce("total", F.lit(0).cast("long")).alias("total"),
                                            F.coalesce("v", F.lit(0).cast("long")).alias("v"), F.coalesce("shards", F.lit(1).cast("long")).alias("shards"))
    groups = scratch.write(groups, "groups")
    dealt = kept.join(groups.select("lang", "source", "shards"), ["lang", "source"]) \
        .select("lang", F.pmod(F.xxhash64("term"), "shards").alias("shard"), "source", "term", "n")
    beside = groups.select("lang", "source", "total", "v", F.explode(F.sequence(F.lit(0).cast("long"), F.col("shards") - 1)).alias("shard"))
    parts = dealt.groupBy("lang", "shard").cogroup(beside.groupBy("lang", "shard")) \
        .applyInArrow(_shard, "lang string, source string, part string, item string, value long")
    parts = scratch.write(parts, "parts")
    of_source = Window.partitionBy("lang", "source")
    in_order = of_source.orderBy(F.desc("value"), "item")
    pairs = parts.where("part = 'pair'").groupBy("lang", "source", "part", "item").agg(F.sum("value").alias("value")) \
        .withColumn("rank", F.row_number().over(in_order))
    best = parts.where("part = 'term'").withColumn("rank", F.row_number().over(in_order)).where(F.col("rank") <= TOP)
    return pairs.unionByName(best).select("lang", "source", "part", "item", "value", "rank")


def op13_divergence_audit(spark, sf_dir: str) -> DataFrame:
    """Pairs of sources and outstanding terms of every language of the documents."""
    return audit(table(spark, sf_dir, "documents"))


def oracle_sql() -> str:
    """Counts, shares and differences by joins over all pairs and terms."""
    return f"""
WITH doc AS (SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
                    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                       '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+') AS w FROM documents),
one AS (SELECT r, lang, source, unnest(w) AS term FROM doc),
kept AS (SELECT lang, term FROM one GROUP BY lang, term HAVING count(DISTINCT r) >= {MIN_DOCUMENTS}),
v AS (SELECT lang, count(term) AS v FROM (SELECT DISTINCT lang FROM doc) LEFT JOIN kept USING (lang) GROUP BY lang),
tally AS (SELECT lang, source, term, count(*) AS n FROM one SEMI JOIN kept USING (lang, term) GROUP BY ALL),
grp AS (SELECT lang, source, coalesce(sum(n), 0) AS total FROM (SELECT DISTINCT lang, source FROM doc) LEFT JOIN tally USING (lang, source) GROUP BY ALL),
cell AS (SELECT k.lang, g.source, k.term, coalesce(t.n, 0) AS n, (1 + ({UNIT}::HUGEINT * (coalesce(t.n, 0) + {SMOOTH})) // (g.total + {SMOOTH} * v.v))::BIGINT AS p
         FROM kept k JOIN grp g USING (lang) JOIN v USING (lang) LEFT JOIN tally t ON t.lang = k.lang AND t.source = g.source AND t.term = k.term),
whole AS (SELECT k.lang, k.term, (1 + ({UNIT}::HUGEINT * (sum(c.n) + {SMOOTH})) // (any_value(a.total) + {SMOOTH} * any_value(v.v)))::BIGINT AS q
          FROM kept k JOIN cell c USING (lang, term) JOIN v USING (lang) JOIN (SELECT lang, sum(total) AS total FROM grp GROUP BY lang) a USING (lang) GROUP BY ALL),
pair AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(s.value, 0)::BIGINT AS value
         FROM grp a JOIN grp b ON a.lang = b.lang AND a.source <> b.source
         LEFT JOIN (SELECT x.lang, x.source, y.source AS other, sum(abs(x.p - y.p)) AS value FROM cell x JOIN cell y USING (lang, term)
                    GROUP BY ALL) s ON s.lang = a.lang AND s.source = a.source AND s.other = b.source),
term AS (SELECT lang, source, 'term' AS part, term AS item, (p - q)::BIGINT AS value FROM cell JOIN whole USING (lang, term) WHERE n > 0 AND p > q)
SELECT lang, source, part, item, value, rank::INT AS rank FROM
  (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, encode(item)) AS rank FROM (FROM pair UNION ALL FROM term))
WHERE part = 'pair' OR rank <= {TOP}"""
