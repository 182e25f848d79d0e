"""URL filter: explicit host and path rules, then a path-template tree per host.

The longest rule that fits a url decides it. The others are judged by templates:

1. Wildcards. Digits in a segment become ``#``. Then, from the top of each host's tree, a node
   with many children (over ``MAX_KIDS``) keeps those that hold a share of its pages, and
   generalises the others into one ``*``. The tree is as deep as the longest path.
2. Merging. A branch's labelled pages are tested against all of its parent's (two-sided
   binomial test, normal approximation). A branch that does not differ is merged into its
   parent, so each template stands for the largest part of the tree around it that looks alike.
3. Purity. A template's share of bad pages is smoothed towards the corpus's share with
   ``PRIOR`` pages; a template with a share above ``REJECT`` is rejected.

The levels are done one after another: wildcards, sums and the test of one level are one small job on the
paths that reach it, and its result is written, so no plan grows with the depth of the paths.

All steps work on counts by (host, path template), summed map-side: a host with a third of all
pages is as many rows as it has distinct templates, and pages are joined once with the verdict
of their path (Spark ships that table while it is small, and splits skewed keys beyond).

A null url, or one without ``://``, has an empty host and path. Pages without a label count as
pages only. Repeated pages count as often as they are there. Without any label nothing is rejected.

Native: DataFrame functions only.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import Scratch, lower_az, others, packed, table

SQL_DEPTH = 8                   # levels that the registered SQL spells out
MAX_KIDS = 20
KEEP_SHARE = 0.01               # of the parent's pages, for a child of a node with many
KEEP_PAGES = 5
Z = 2.576                       # the 1 % two-sided test
MIN_LABELLED = 5
PRIOR = 10.0
REJECT = 0.5
#: The contract's rules: host, path, verdict.
RULES = (("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow"))


def host_of(url: Column) -> Column:
    return lower_az(F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1))


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def matching_rule(host: Column, path: Column, rules: Sequence[tuple[str, str, str]] = RULES) -> Column:
    """struct(rule, verdict) of the longest rule that fits, or null. Rules are a short list, a parameter."""
    fits = [F.when(((host == h) | host.endswith(f".{h}")) & path.startswith(p),
                   F.struct(F.lit(h + p).alias("rule"), F.lit(v).alias("verdict")))
            for h, p, v in sorted(rules, key=lambda r: (-len(r[0] + r[1]), r))]
    return F.coalesce(*fits) if fits else F.lit(None).cast("struct<rule:string,verdict:string>")


def _segments(path: Column) -> Column:
    """Segments of a path: digits as #, empty ones left out."""
    return F.filter(F.split(F.regexp_replace(path, "[0-9]+", "#"), "/"), lambda x: x != "")


def _one_down(rows: DataFrame, level: int) -> DataFrame:
    """``rows`` with ``t`` one segment longer (unchanged where the path has ended) and ``up``, what it was."""
    rows = rows.withColumns({"seg": F.get("shape", F.lit(level)), "up": F.col("t")})
    kids = rows.where("seg IS NOT NULL").groupBy("host", "up", "seg").agg(F.sum("pages").alias("kid_pages"))
    node = Window.partitionBy("host", "up")
    wild = (F.col("kids") > MAX_KIDS) & ((F.col("kid_pages") < KEEP_PAGES) | (F.col("kid_pages") < F.col("every") * KEEP_SHARE))
    few = kids.withColumns({"kids": F.count(F.lit(1)).over(node), "every": F.sum("kid_pages").over(node)}) \
        .where(wild).select("host", "up", "seg", F.lit("*").alias("wild"))
    return rows.join(few, ["host", "up", "seg"], "left") \
        .withColumn("t", F.when(F.col("seg").isNull(), F.col("up"))
                    .otherwise(F.concat(F.col("up"), F.lit("/"), F.coalesce("wild", "seg")))).drop("wild")


def judged_templates(counts: DataFrame, scratch: Scratch) -> DataFrame:
    """host, shape, ``template`` (the branch that stands for it after merging) and ``bad_share`` (smoothed) of
    ``counts``: host, shape, pages, labelled, bad.

    From the root down, each level's branches are summed and tested against their parents.  A path that
    ends at a node is a branch of its own there, and done."""
    whole = counts.agg(F.sum("bad").alias("b"), F.sum("labelled").alias("n"), F.max(F.size("shape")).alias("depth")).first()
    base = F.lit(((whole["b"] or 0) + 1.0) / ((whole["n"] or 0) + 2.0))
    roots = counts.groupBy("host").agg(F.sum("labelled").alias("n"), F.sum("bad").alias("b"))
    state = counts.join(roots, "host").withColumn("t", F.lit("")) \
        .withColumn("chosen", F.struct(F.col("t").alias("template"), "n", "b"))
    state, done = scratch.write(state, "root"), []
    for level in range((whole["depth"] or 0) + 1):
        rows = _one_down(state.withColumnsRenamed({"n": "pn", "b": "pb"}), level)
        sums = rows.groupBy("host", "t").agg(F.sum("labelled").alias("n"), F.sum("bad").alias("b"))
        rows = rows.join(sums, ["host", "t"])
        n, b, p = F.col("n"), F.col("b"), (F.col("pb") + base) / (F.col("pn") + 1.0)
        differs = (n >= MIN_LABELLED) & (F.abs(b - n * p) > Z * F.sqrt(n * p * (1.0 - p)))
        rows = rows.withColumn("chosen", F.when(differs, F.struct(F.col("t").alias("template"), "n", "b")).otherwise(F.col("chosen")))
        rows = scratch.write(rows.withColumn("ended", F.col("seg").isNull()).drop("up", "seg", "pn", "pb"), f"level{level}")
        done.append(f"level{level}")
        state = rows.where(~F.col("ended")).drop("ended")
    scratch.drop("root")
    if not done:
        return counts.select("host", "shape", F.lit("").alias("template"), F.lit(0.0).alias("bad_share"))
    ended = counts.sparkSession.read.schema(rows.schema).parquet(*(f"{scratch.base}/{d}" for d in done)).where("ended")
    share = (F.col("chosen.b") + base * PRIOR) / (F.col("chosen.n") + PRIOR)
    return ended.select("host", "shape", F.col("chosen.template").alias("template"), share.alias("bad_share"))


def judge_urls(pages: DataFrame, labels: DataFrame, *, url: str = "url", label_id: str | None = None,
               rules: Sequence[tuple[str, str, str]] = RULES) -> DataFrame:
    """``pages`` with ``host``, ``path``, ``rule``, ``verdict``, ``template`` and ``bad_share`` (old columns of these names go).

    ``labels`` has ``label_id`` and ``bad`` (0 or 1), one row for an id; a page's id is in its column
    ``label_id``, by default it is the last number of its path."""
    new = ("host", "path", "rule", "verdict", "template", "bad_share")
    scratch = Scratch(pages.sparkSession, "urltree")
    known = packed(pages, others(pages, new), url=url, **({"label": label_id} if label_id else {}))
    known = known.withColumns({"host": host_of(F.col("url")), "path": path_of(F.col("url"))}) \
        .withColumn("shape", _segments(F.col("path")))
    number = F.expr("try_cast(regexp_extract(path, '([0-9]+)[^0-9]*$', 1) as bigint)") if label_id is None else F.col("label")
    slim = known.select("host", "shape", number.alias("label_id"))
    counted = slim.groupBy("host", "shape").agg(F.count(F.lit(1)).alias("pages"))
    marked = slim.where("label_id is not null").join(labels.select("label_id", "bad"), "label_id") \
        .groupBy("host", "shape").agg(F.count(F.lit(1)).alias("labelled"), F.sum("bad").alias("bad"))
    counts = counted.join(marked, ["host", "shape"], "left").na.fill(0, ["labelled", "bad"])
    judged = judged_templates(scratch.write(counts, "counts"), scratch)
    fit = matching_rule(F.col("host"), F.col("path"), rules)
    by_template = F.when(F.col("bad_share") > REJECT, "block").otherwise("allow")
    return known.withColumn("fit", fit).join(judged, ["host", "shape"], "left").select(
        "row", "host", "path", F.col("fit.rule").alias("rule"),
        F.coalesce(F.col("fit.verdict"), by_template).alias("verdict"), "template", "bad_share").select("row.*", *new)


def document_labels(labels: DataFrame) -> DataFrame:
    """label_id and bad of labelled documents: of low quality, or toxic; the worst of repeated labels."""
    bad = F.max(F.when((F.col("quality") == 0) | (F.col("toxic") == 1), 1).otherwise(0))
    return labels.where("doc_id is not null").groupBy(F.col("doc_id").alias("label_id")).agg(bad.cast("long").alias("bad"))


def op9_path_templates(spark, sf_dir: str) -> DataFrame:
    """Host, path, rule and verdict of every page; a page's path ends in its document's number."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return judge_urls(pages, document_labels(table(spark, sf_dir, "labels"))).select(
        "page_id", "host", "path", "rule", "verdict", "template")


def oracle_sql() -> str:
    """The same in DuckDB."""
    rule = ["CASE"]
    verdict = ["CASE"]
    for h, p, v in sorted(RULES, key=lambda r: (-len(r[0] + r[1]), r)):
        when = f"WHEN (k.host = '{h}' OR ends_with(k.host, '.{h}')) AND starts_with(path, '{p}') THEN"
        rule.append(f"{when} '{h}{p}'")
        verdict.append(f"{when} '{v}'")
    rule.append("END")
    verdict.append("END")
    ctes, last = [], "counts"
    for level in range(SQL_DEPTH + 1):
        t, up = f"t{level}", f"l{level}"
        ctes.append(f"k{level} AS (SELECT host, {t}, shape[{level + 1}] AS seg, sum(pages) AS n FROM {last} "
                    f"WHERE len(shape) > {level} GROUP BY ALL)")
        ctes.append(f"w{level} AS (SELECT * FROM (SELECT *, count(*) OVER w AS kids, sum(n) OVER w AS every FROM k{level} "
                    f"WINDOW w AS (PARTITION BY host, {t})) WHERE kids > {MAX_KIDS} AND (n < {KEEP_PAGES} OR n < every * {KEEP_SHARE}::DOUBLE))")
        ctes.append(f"{up} AS (SELECT c.*, CASE WHEN len(shape) <= {level} THEN c.{t} ELSE c.{t} || '/' || "
                    f"CASE WHEN w.seg IS NULL THEN shape[{level + 1}] ELSE '*' END END AS t{level + 1} "
                    f"FROM {last} c LEFT JOIN w{level} w ON c.host = w.host AND c.{t} = w.{t} AND shape[{level + 1}] = w.seg)")
        last = up
    sums = ", ".join(f"sum(labelled::DOUBLE) OVER (PARTITION BY host, t{i}) AS n{i}, "
                     f"sum(bad::DOUBLE) OVER (PARTITION BY host, t{i}) AS b{i}" for i in range(SQL_DEPTH + 2))
    pick = "struct_pack(template := t0, n := n0, b := b0)"
    for i in range(1, SQL_DEPTH + 2):
        p = f"((b{i - 1} + base) / (n{i - 1} + 1.0::DOUBLE))"
        pick = (f"CASE WHEN n{i} >= {MIN_LABELLED} AND abs(b{i} - n{i} * {p}) > {Z}::DOUBLE * sqrt(n{i} * {p} * (1.0::DOUBLE - {p})) "
                f"THEN struct_pack(template := t{i}, n := n{i}, b := b{i}) ELSE {pick} END")
    return f"""
WITH u AS (
  SELECT page_id, translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)', 1),
                            'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path FROM pages),
s AS (
  SELECT *, list_filter(string_split(regexp_replace(path, '[0-9]+', '#', 'g'), '/'), lambda x: x <> '') AS segs,
         try_cast(nullif(regexp_extract(path, '([0-9]+)[^0-9]*$', 1), '') AS BIGINT) AS label_id FROM u),
known AS (
  SELECT *, segs AS shape FROM s),
marks AS (SELECT doc_id, max(CASE WHEN quality = 0 OR toxic = 1 THEN 1 ELSE 0 END) AS bad FROM labels
          WHERE doc_id IS NOT NULL GROUP BY doc_id),
counts AS (SELECT host, shape, '' AS t0, count(*) AS pages, count(bad) AS labelled, coalesce(sum(bad), 0) AS bad
           FROM known LEFT JOIN marks ON label_id = doc_id GROUP BY host, shape),
{", ".join(ctes)},
summed AS (SELECT *, {sums}, ((sum(bad::DOUBLE) OVER ()) + 1.0::DOUBLE) / ((sum(labelled::DOUBLE) OVER ()) + 2.0::DOUBLE) AS base FROM {last}),
judged AS (SELECT host, shape, c.template, (c.b + base * {PRIOR}::DOUBLE) / (c.n + {PRIOR}::DOUBLE) AS bad_share
           FROM (SELECT host, shape, base, {pick} AS c FROM summed))
SELECT page_id, k.host, path, {" ".join(rule)} AS rule,
       coalesce({" ".join(verdict)}, CASE WHEN bad_share > {REJECT} THEN 'block' ELSE 'allow' END) AS verdict, template
FROM known k LEFT JOIN judged j ON k.host = j.host AND k.shape = j.shape"""
