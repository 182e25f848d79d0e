"""Mixing by iterative proportional fitting: rake token weights to marginals, then sample.

Documents fall into cells of source x language x topic. The raking starts from one common
probability and in turn scales all cells of each source, each language and each topic so that
the tokens expected in the sample meet that margin's target; a probability never exceeds 1.
Each document is sampled with its cell's probability against a fixed pseudo-random number
of its id and text.

A value whose target is above its tokens gives all it has, and the other values of its dimension
share the rest in proportion to their shares, so that all three margins have the same sum. Weights are
kept beyond 1 between the steps, and a factor counts only what is not at 1 already, until no margin
is off by more than ``TOLERANCE`` of the expected tokens. Margins that no sample can meet together
end with a warning once the rounds gain nothing (``STILL``), or after ``MOST_ROUNDS``; ``residuals`` gives each value's target and expected tokens.
The registered query runs ``ROUNDS`` rounds, after which every margin is met as well, so that SQL can state them.

Targets are absolute expected tokens: a share for each value, times ``RATE`` of all tokens.
Shares may be given; otherwise they are the corpus's own, raised to ``POWER`` and
normalised, which lowers large values and lifts small ones without listing them.

Cells are map-side sums, so a source that holds a third of all rows is one row a task. The
raking works on the table of cells alone, cut from its lineage every ``ROUNDS_AT_ONCE`` rounds. Up to
``CELLS_AT_ONCE`` cells it needs no exchange: a window over fewer rows than partitions have would spread them over
all of these three times a round. More cells are shuffled by the value that is scaled.

Null source or language is a value of its own. Null or empty texts have no tokens: they move
no margin and are sampled with their cell. Repeated rows draw the same number and stay or go
together. Values without a given share get no tokens.

Native: DataFrame functions only.
"""

from __future__ import annotations

import warnings
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import Scratch, packed, table

RATE = 0.6
POWER = {"source": 0.5, "lang": 0.7, "topic": 0.5}
ROUNDS = 24                     # of the registered query, so that SQL can state them
MOST_ROUNDS = 200
ROUNDS_AT_ONCE = 4              # rounds of one Spark job, between looks at the margins
CELLS_AT_ONCE = 20_000          # cells that are raked without an exchange
STILL = 16                      # rounds without a gain of a hundredth, to end without meeting the margins
TOLERANCE = 1e-6                # of the expected tokens
SEED = 8
DIMENSIONS = ("source", "lang", "topic")


def n_tokens(text: str) -> Column:
    return F.regexp_count(F.coalesce(F.col(text), F.lit("")), F.lit(r"[^\x20\x09-\x0D]+")).cast("long")


def topic_of(text: str, tokens: Column) -> Column:
    """Topic by wording and form: license texts, symbol-laden texts, numbers, long and short prose."""
    t = F.coalesce(F.col(text), F.lit(""))
    return F.when(F.regexp_like(t, F.lit("(?i)licensed? under|all rights reserved|under the [a-z]+ license")), "legal") \
        .when(F.regexp_count(t, F.lit(r"[#*$%&|<>]")) * 5 >= F.greatest(tokens, F.lit(1)), "markup") \
        .when(F.regexp_count(t, F.lit("[0-9]")) * 2 >= F.greatest(tokens, F.lit(1)), "numbers") \
        .when(tokens >= 1000, "long prose").otherwise("short prose")


def draw(doc_id: str, text: str, seed: int = SEED) -> Column:
    """A number in [0, 1) fixed by id, text and seed: 52 bits of an md5 digest."""
    key = F.concat_ws(":", F.lit(str(seed)), F.coalesce(F.col(doc_id).cast("string"), F.lit("")),
                      F.md5(F.coalesce(F.col(text), F.lit("")).cast("binary")))
    return F.conv(F.substring(F.md5(key.cast("binary")), 1, 13), 16, 10).cast("long") / F.lit(float(1 << 52))


def _key(c: str) -> Column:
    return F.coalesce(F.concat(F.lit("="), F.col(c).cast("string")), F.lit(""))


def measured(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source", lang: str = "lang",
             topic: str | None = None) -> DataFrame:
    """``docs`` with ``mix_source``, ``mix_lang``, ``mix_topic`` (null-safe keys), ``mix_tokens`` and ``mix_draw``."""
    out = docs.withColumns({"mix_source": _key(source), "mix_lang": _key(lang), "mix_tokens": n_tokens(text),
                            "mix_draw": draw(doc_id, text)})
    return out.withColumn("mix_topic", _key(topic) if topic else topic_of(text, F.col("mix_tokens")))


def targets(cells: DataFrame, dimension: str, total: int, rate: float, power: float,
            shares: Mapping[str | None, float] | None) -> DataFrame:
    """mix_{dimension}, target: expected tokens of each value."""
    key = f"mix_{dimension}"
    own = cells.groupBy(key).agg(F.sum("tokens").alias("own"))
    if shares is None:
        raised = own.withColumn("part", F.pow(F.col("own") / F.lit(float(max(total, 1))), F.lit(power)))
    else:
        given = F.create_map(*(F.lit(x) for v, s in shares.items() for x in ("" if v is None else f"={v}", float(s))))
        raised = own.withColumn("part", F.coalesce(F.try_element_at(given, F.col(key)), F.lit(0.0)))
    whole = raised.agg(F.sum("part").alias("whole"))
    return raised.join(F.broadcast(whole)) \
        .select(key, (F.col("part") / F.col("whole") * F.lit(rate * total)).alias(f"target_{dimension}")) \
        if total else raised.select(key, F.lit(0.0).alias(f"target_{dimension}"))


def _capped(values: DataFrame, key: str, want: float) -> DataFrame:
    """``key``, target: ``want`` tokens dealt by ``part``, to no value more than its ``own``, all of what is over to the others."""
    before = -1
    capped, part = F.lit(False), F.col("part")
    while True:
        taken, rest, n = values.agg(F.coalesce(F.sum(F.when(capped, F.col("own"))), F.lit(0.0)),
                                    F.coalesce(F.sum(F.when(~capped, part)), F.lit(0.0)),
                                    F.count(F.when(capped, 1))).first()
        level = F.lit(max(want - taken, 0.0) / rest if rest > 0 else float("inf"))
        if n == before or rest <= 0:
            break
        before, capped = n, (part > 0) & (F.col("own") <= level * part)
    return values.select(key, F.when(part > 0, F.least(F.col("own"), level * part)).otherwise(0.0).alias(f"target_{key[4:]}"))


def _feasible(cells: DataFrame, total: int, rate: float, power: Mapping[str, float],
              shares: Mapping[str, Mapping[str | None, float]], scratch: Scratch) -> DataFrame:
    """``cells`` with targets that each value can give, of one sum for all dimensions, and ``usable``: no value without target."""
    keys = [f"mix_{d}" for d in DIMENSIONS]
    marked = cells
    for d in DIMENSIONS:
        given = targets(cells, d, total, rate, power.get(d, 1.0), shares.get(d))
        marked = marked.join(given.withColumnRenamed(f"target_{d}", f"part_{d}"), f"mix_{d}")
    usable = F.lit(True)
    for d in DIMENSIONS:                                    # a value whose texts are all empty wants nothing and loses nothing
        usable &= (F.col(f"part_{d}") > 0) | (F.col("tokens") == 0)
    marked = scratch.write(marked.withColumn("usable", usable), "marked")
    own = F.sum(F.when(F.col("usable"), F.col("tokens")).otherwise(0)).cast("double")
    want = min(rate * total, marked.agg(own).first()[0] or 0.0)
    out = marked.select(*keys, "tokens", "usable")
    for d in DIMENSIONS:
        values = marked.groupBy(f"mix_{d}").agg(own.alias("own"), F.first(f"part_{d}").alias("part")) \
            .withColumn("part", F.when(F.col("own") > 0, F.col("part")).otherwise(0.0))
        out = out.join(_capped(values, f"mix_{d}", want), f"mix_{d}")
    return out


def residuals(cells: DataFrame) -> DataFrame:
    """dimension, value, target, expected of every value in the cells that ``rake`` gives."""
    parts = [cells.groupBy(F.lit(d).alias("dimension"), F.col(f"mix_{d}").alias("value")).agg(
        F.first(f"target_{d}").alias("target"), F.sum(F.col("probability") * F.col("tokens")).alias("expected")) for d in DIMENSIONS]
    return parts[0].union(parts[1]).union(parts[2])


def rake(rows: DataFrame, *, rate: float = RATE, rounds: int = MOST_ROUNDS, power: Mapping[str, float] = POWER,
         shares: Mapping[str, Mapping[str | None, float]] | None = None, scratch: Scratch | None = None,
         tolerance: float = TOLERANCE) -> DataFrame:
    """mix_source, mix_lang, mix_topic, tokens, probability and the three targets of every cell of ``measured`` rows.

    The rounds end when every margin is within ``tolerance`` of the expected tokens, or at ``rounds``.  A job runs
    ``ROUNDS_AT_ONCE`` of them, sums over windows of the cells; ``residuals`` of the result tells how far each margin is off."""
    scratch = scratch or Scratch(rows.sparkSession, "raking")
    keys, wanted = [f"mix_{d}" for d in DIMENSIONS], [f"target_{d}" for d in DIMENSIONS]
    cells = scratch.write(rows.groupBy(*keys).agg(F.sum("mix_tokens").alias("tokens")), "cells")
    total = cells.agg(F.coalesce(F.sum("tokens"), F.lit(0))).first()[0]
    if not total:                                           # nothing to weigh: every document has the rate
        return cells.select(*keys, "tokens", F.lit(rate).alias("probability"), *(F.lit(0.0).alias(c) for c in wanted))
    small = cells.count() <= CELLS_AT_ONCE
    state = _feasible(cells, total, rate, power, shares or {}, scratch)
    state = scratch.write(state.withColumn("probability", F.when(F.col("usable"), F.lit(rate)).otherwise(0.0)), "round0")
    done, offs = 0, []
    while done < rounds:
        before, step = done, min(ROUNDS_AT_ONCE, rounds - done)
        state = state.coalesce(1) if small else state
        for _ in range(step):
            for d in DIMENSIONS:
                state = _step(state, d)
        done += step
        state = scratch.write(state, f"round{done}")
        scratch.drop(f"round{before}")
        if tolerance <= 0:
            continue
        bounded = state.withColumn("probability", F.least(F.lit(1.0), "probability"))
        off = residuals(bounded).agg(F.max(F.abs(F.col("expected") - F.col("target")))).first()[0]
        offs.append(off)
        if off <= tolerance * rate * total:
            break
        if done >= rounds or (len(offs) * ROUNDS_AT_ONCE > STILL and off > 0.99 * offs[-1 - STILL // ROUNDS_AT_ONCE]):
            warnings.warn(f"raking: margins can't be met together, off by up to {off:.0f} of {rate * total:.0f} tokens", stacklevel=2)
            break
    scratch.drop("cells", "marked")
    return state.select(*keys, "tokens", F.least(F.lit(1.0), "probability").alias("probability"), *wanted)


def _step(state: DataFrame, d: str) -> DataFrame:
    """Scale what is below 1 so that a value's tokens meet its target; weights at 1 or more are cut back only if they alone exceed it."""
    p, tokens, target = F.col("probability"), F.col("tokens"), F.col(f"target_{d}")
    value = Window.partitionBy(f"mix_{d}")
    state = state.withColumns({"full": F.sum(F.when(p >= 1, tokens).otherwise(0)).over(value),
                               "part": F.sum(F.when(p < 1, p * tokens).otherwise(0.0)).over(value)})
    scaled = F.when((target > F.col("full")) & (F.col("part") > 0), p * (target - F.col("full")) / F.col("part")) \
        .when((target <= F.col("full")) & (F.col("full") + F.col("part") > 0),
              F.least(F.lit(1.0), p) * target / (F.col("full") + F.col("part"))).otherwise(p)
    return state.withColumn("probability", scaled).drop("full", "part")


def sampled(rows: DataFrame, cells: DataFrame) -> DataFrame:
    """``measured`` rows with their ``probability`` and whether they are ``sampled``."""
    keys = [f"mix_{d}" for d in DIMENSIONS]
    return rows.join(cells.select(*keys, "probability"), keys) \
        .withColumn("sampled", F.col("mix_draw") < F.col("probability"))


def mix(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", source: str = "source", lang: str = "lang",
        topic: str | None = None, **options) -> DataFrame:
    """The sampled documents, columns unchanged."""
    columns = {"doc_id": doc_id, "text": text, "source": source, "lang": lang} | ({"topic": topic} if topic else {})
    rows = measured(packed(docs, **columns), topic=topic and "topic").drop(*columns)
    cells = rake(rows.drop("row"), **options)
    return sampled(rows, cells).where("sampled").select("row.*")


def op8_raking(spark, sf_dir: str) -> DataFrame:
    """Every document with its cell's calibrated probability and whether it is sampled."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source", "lang")
    scratch = Scratch(spark, "raking")
    rows = scratch.write(measured(docs).drop("text"), "rows")
    cells = rake(rows, scratch=scratch, rounds=ROUNDS, tolerance=0)
    return sampled(rows, cells).select("doc_id", "source", "lang", F.col("mix_topic").alias("topic"),
                                       F.col("mix_tokens").alias("n_tokens"),
                                       F.round("probability", 6).alias("probability"), "sampled")


def oracle_sql(documents: str = "documents") -> str:
    """The same in DuckDB: the raking steps as a chain of windows over the cells."""
    steps, last = [], "start"
    for k in range(ROUNDS):
        for d in DIMENSIONS:
            name = f"r{k}_{d}"
            full = f"(sum(CASE WHEN p >= 1 THEN tokens ELSE 0 END) OVER (PARTITION BY {d}_key))"
            part = f"(sum(CASE WHEN p < 1 THEN p * tokens ELSE 0 END) OVER (PARTITION BY {d}_key))"
            steps.append(f"{name} AS MATERIALIZED (SELECT * REPLACE (CASE WHEN target_{d} > {full} AND {part} > 0 THEN p * (target_{d} - {full}) / {part} "
                         f"WHEN target_{d} <= {full} AND {full} + {part} > 0 THEN least(1.0::DOUBLE, p) * target_{d} / ({full} + {part}) "
                         f"ELSE p END AS p) FROM {last})")
            last = name
    # values that would get more than they have give all; the level of the others follows from how many those are
    target = ",\n".join(
        f"v_{d} AS (SELECT {d}_key, sum(tokens) AS own, pow(sum(tokens) / max(total), {POWER[d]}) AS part, {RATE} * max(total) AS want "
        f"FROM cells, (SELECT greatest(sum(tokens), 1)::DOUBLE AS total FROM cells) GROUP BY {d}_key),\n"
        f"level_{d} AS (SELECT coalesce(min_by(level, k) FILTER (WHERE own / part > level), 'infinity'::DOUBLE) AS level FROM "
        f"(SELECT row_number() OVER w AS k, own, part, "
        f"greatest(want - coalesce(sum(own) OVER before, 0), 0) / sum(part) OVER since AS level FROM v_{d} WHERE part > 0 "
        f"WINDOW w AS (ORDER BY own / part), before AS (ORDER BY own / part ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), "
        f"since AS (ORDER BY own / part ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))),\n"
        f"t_{d} AS (SELECT {d}_key, CASE WHEN part > 0 THEN least(own, level * part) ELSE 0 END AS target_{d} FROM v_{d}, level_{d})"
        for d in DIMENSIONS)
    return f"""
WITH base AS (
  SELECT doc_id, source, lang, coalesce(text, '') AS t,
         len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS n_tokens FROM {documents}),
rows AS (
  SELECT doc_id, source, lang, n_tokens::BIGINT AS n_tokens,
         coalesce('=' || source, '') AS source_key, coalesce('=' || lang, '') AS lang_key,
         CASE WHEN regexp_matches(t, '(?i)licensed? under|all rights reserved|under the [a-z]+ license') THEN 'legal'
              WHEN len(regexp_extract_all(t, '[#*$%&|<>]')) * 5 >= greatest(n_tokens, 1) THEN 'markup'
              WHEN len(regexp_extract_all(t, '[0-9]')) * 2 >= greatest(n_tokens, 1) THEN 'numbers'
              WHEN n_tokens >= 1000 THEN 'long prose' ELSE 'short prose' END AS topic_key,
         ('0x' || substr(md5('{SEED}:' || coalesce(doc_id::VARCHAR, '') || ':' || md5(t)), 1, 13))::BIGINT
           / {float(1 << 52)!r}::DOUBLE AS u FROM base),
cells AS (SELECT source_key, lang_key, topic_key, sum(n_tokens)::DOUBLE AS tokens FROM rows GROUP BY ALL),
{target},
start AS (SELECT c.*, target_source, target_lang, target_topic, {RATE}::DOUBLE AS p
          FROM cells c JOIN t_source USING (source_key) JOIN t_lang USING (lang_key) JOIN t_topic USING (topic_key)),
{", ".join(steps)}
SELECT doc_id, source, lang, topic_key AS topic, n_tokens, round(least(1.0::DOUBLE, p), 6) AS probability, u < p AS sampled
FROM rows JOIN {last} USING (source_key, lang_key, topic_key)"""
