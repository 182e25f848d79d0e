"""Data quality: rule tagging, clean/quarantine routes, counts per rule, fail rules."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.functions.hashing import packed_hash, row_hash, shown_hash
from tessera.operators.changes import cdc_filter, crud_code
from tessera.operators.entity import DROP, FAIL, WARN, Entity, Rule
from tessera.session import materialize_observed

ADMIN = ("WA_CRUDDTS", "WA_CRUD", "WA_SRC", "WA_RUNID", "WA_HASH")


def failed_rules(rules: Sequence[Rule]) -> Column:
    """Names of the broken rules, NULLs compacted away: ``array_compact(array(CASE ...))``."""
    if not rules:
        return F.array().cast("array<string>")
    return F.array_compact(F.array(*[F.when(F.expr(r.violation), F.lit(r.name)) for r in rules]))


def failed_rules_except(rules: Sequence[Rule]) -> Column:
    """The same tag built with ``array_except``: every name minus the names that pass.
    Equal to :func:`failed_rules` for distinct rule names."""
    names = F.array(*[F.lit(r.name) for r in rules])
    passing = F.array(*[F.when(~F.coalesce(F.expr(r.violation), F.lit(False)), F.lit(r.name)) for r in rules])
    return F.array_except(names, passing)


def tag(feed: DataFrame, e: Entity) -> DataFrame:
    """Tagged source: typed columns, ``WA_`` admin columns, row hash, broken drop rules.

    One projection over the change feed (pre-images removed first), so Catalyst
    prunes the scan to the columns used and keeps it in one codegen stage.
    """
    rows = cdc_filter(feed)
    return rows.select(
        *[F.expr(expr).alias(name) for name, expr in e.columns],
        F.col("SA_CRUDDTS").alias("WA_CRUDDTS"),
        crud_code(F.col("_change_type")).alias("WA_CRUD"),
        F.col("SA_SRC").alias("WA_SRC"),
        F.col("SA_RUNID").alias("WA_RUNID"),
        row_hash(list(e.hash_columns)).alias("WA_HASH"),
        failed_rules(e.rules_of(DROP)).alias("failed_rules"),
        F.col(e.sequence),
        F.col("_change_type"),
    )


def _derived_hash(e: Entity) -> Column | None:
    """The row hash as the typed columns give it; None where a hash column has no typed one."""
    back = dict(e.staged)
    if not set(e.hash_columns) <= {*e.column_names, *back}:
        return None
    return row_hash([F.expr(back[c]) if c in back else F.col(c) for c in e.hash_columns])


def spare_hash(e: Entity) -> Column:
    """``WA_HASH`` as shuffles and tables carry it: NULL where the row's typed columns give the same hash."""
    derived, h = _derived_hash(e), F.col("WA_HASH")
    return h if derived is None else F.when(derived != h, h)


def whole_hash(e: Entity, kept: Column | None = None) -> Column:
    """The row hash back from what :func:`spare_hash` kept (``WA_HASH`` by default): computed only by those who read it."""
    derived, h = _derived_hash(e), F.col("WA_HASH") if kept is None else kept
    return h if derived is None else F.coalesce(h, derived)


def clean(tagged: DataFrame) -> DataFrame:
    """Rows that break no drop rule, without the tag columns (``* EXCEPT``)."""
    return tagged.where(F.size("failed_rules") == 0).drop("failed_rules", "_change_type")


def quarantine(tagged: DataFrame, e: Entity) -> DataFrame:
    """Rows that break at least one drop rule, with full context, for an append-only sink."""
    cols = e.column_names + list(ADMIN) + ["failed_rules", "_change_type"]
    return tagged.where(F.size("failed_rules") > 0).select(*cols)


def rule_counts(tagged: DataFrame, e: Entity) -> DataFrame:
    """Violations per drop rule, every rule listed (zero included), in one pass."""
    rules = e.rules_of(DROP)
    agg = tagged.agg(*[F.count_if(F.array_contains("failed_rules", r.name)).alias(f"r{i}")
                       for i, r in enumerate(rules)])
    stack = ", ".join(f"'{r.name}', r{i}" for i, r in enumerate(rules))
    return agg.select(F.expr(f"stack({len(rules)}, {stack}) AS (rule, violations)")) \
        .select("rule", F.col("violations").cast("bigint").alias("violations"))


def warn_counts(tagged: DataFrame, e: Entity) -> DataFrame:
    """Warn rules: the rows stay; the violations of each rule are counted (one pass)."""
    rules = e.rules_of(WARN)
    agg = tagged.agg(*[F.count_if(F.coalesce(F.expr(r.violation), F.lit(False))).alias(f"w{i}")
                       for i, r in enumerate(rules)])
    stack = ", ".join(f"'{r.name}', w{i}" for i, r in enumerate(rules))
    return agg.select(F.expr(f"stack({len(rules)}, {stack}) AS (rule, violations)")) \
        .select("rule", F.col("violations").cast("bigint").alias("violations"))


COUNT_SCHEMA = "entity string, rule string, severity string, input_rows long, violations long"


def store_tagged(tagged: DataFrame, e: Entity, name: str) -> tuple[DataFrame, DataFrame]:
    """The tagged rows written once, and the violations of every rule, of any severity, as one row per rule.

    The counts are observed on the write that stores the rows, so no run reads its rows again to be told what
    it rejected.  The row hash is stored, as its 32 bytes, only where the typed columns don't give it back.  Rules of severity drop are counted by the tag, the others by their own condition."""
    def broken(r: Rule) -> Column:
        return F.array_contains("failed_rules", r.name) if r.severity == DROP else F.coalesce(F.expr(r.violation), F.lit(False))

    metrics = [F.count(F.lit(1)).alias("n"), *(F.count_if(broken(r)).alias(f"r{i}") for i, r in enumerate(e.rules))]
    table, seen = materialize_observed(tagged.withColumn("WA_HASH", packed_hash(spare_hash(e))), name, metrics)
    table = table.withColumn("WA_HASH", whole_hash(e, shown_hash("WA_HASH")))
    counts = [(e.name, r.name, r.severity, seen["n"], seen[f"r{i}"]) for i, r in enumerate(e.rules)]
    return table, tagged.sparkSession.createDataFrame(counts, COUNT_SCHEMA)


def require(df: DataFrame, condition: str | Column, message: str) -> DataFrame:
    """Fail rule: stop the run when a row breaks ``condition``.

    ``assert_true`` sits in a filter so it cannot be pruned away with a column.
    """
    cond = F.expr(condition) if isinstance(condition, str) else condition
    return df.where(F.assert_true(F.coalesce(cond, F.lit(False)), F.lit(message)).isNull())


def enforce_fail_rules(df: DataFrame, e: Entity) -> DataFrame:
    for r in e.rules_of(FAIL):
        df = require(df, f"NOT ({r.violation})", f"fail rule {r.name} broken in {e.name}")
    return df


def triage(quarantined: DataFrame, rule: str) -> DataFrame:
    """Quarantined rows that broke ``rule``."""
    return quarantined.where(F.array_contains("failed_rules", rule))
