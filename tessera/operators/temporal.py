"""Temporal joins against SCD2 history (half-open validity intervals)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.operators.keyed import CHUNK_ROWS, HOT_KEY_ROWS, SAMPLE_FRACTION, keyed_carry
from tessera.operators.narrow import packed_columns

# types of which equal values are the same value
EXACT = ("byte", "short", "integer", "long", "date", "timestamp", "timestamp_ntz")


def _pairs(keys: Sequence[str] | dict[str, str]) -> list[tuple[str, str]]:
    return list(keys.items()) if isinstance(keys, dict) else [(k, k) for k in keys]


def as_of_join(left: DataFrame, history: DataFrame, keys: Sequence[str] | dict[str, str], at: str,
               how: str = "inner", frm: str = "WA_FROMDATE", until: str = "WA_UNTODATE",
               names: tuple[str, str] = ("l", "r"), hot_rows: int = HOT_KEY_ROWS, chunk_rows: int = CHUNK_ROWS,
               fraction: float = SAMPLE_FRACTION) -> DataFrame:
    """Rows of ``left`` with the history version valid at ``left[at]``: equal keys
    and ``from <= at < until``.  ``how`` is ``inner`` or ``left``.

    The result has two struct columns named by ``names`` (left row, history
    row), so ``select("l.*")`` or ``col("r.name")`` pick columns without name
    clashes.  ``keys`` maps left key names to history key names when they differ.

    Batch form: left rows and versions are unioned, shuffled once on the key
    (hot keys split into ordered chunks), and each left row takes the
    latest version starting at or before it (a carried-forward ``last``); the
    version matches when ``at < until``.  Versions of a key do not overlap, so
    this equals the interval join, but no key ever pairs all its rows with all
    its versions.  A stream takes it per micro-batch
    (:func:`~tessera.streaming.pipelines.run_stream_static_asof`).

    Rows are shuffled narrow (:mod:`~tessera.operators.narrow`), without the key and time that they are shuffled by.
    """
    if how not in ("inner", "left"):
        raise ValueError(f"as-of join supports inner and left, not {how!r}")
    pairs = _pairs(keys)
    ln, rn = names
    kcols = [f"_k{i}" for i in range(len(pairs))]
    lcols, lwhole = packed_columns(left, at, apart=[lk for lk, _ in pairs])
    hcols, hwhole = packed_columns(history, frm, [until], apart=[hk for _, hk in pairs])
    same = {k: p for k, p in zip(kcols, pairs) if _exact(left, p[0], history, p[1])}
    lfrom = {lk: k for k, (lk, _) in same.items()} | ({at: "_t"} if _exact(left, at, history, frm) else {})
    hfrom = {hk: k for k, (_, hk) in same.items() if hk not in (frm, until)}
    lfrom = lfrom if len(lfrom) < len(lcols) else {}
    lrow = F.struct(*[c for n, c in lcols.items() if n not in lfrom])
    hrow = F.struct(*[c for n, c in hcols.items() if n not in hfrom])
    ltype = left.select(lrow.alias("x")).schema["x"].dataType
    htype = history.select(hrow.alias("x")).schema["x"].dataType
    lside = left.select(*[F.col(lk).alias(k) for (lk, _), k in zip(pairs, kcols)],
                        F.col(at).alias("_t"), F.lit(1).alias("_side"),
                        lrow.alias("_l"), F.lit(None).cast(htype).alias("_h"))
    # a version with a NULL key can match nothing (equality on NULL is unknown)
    has_key = [F.col(hk).isNotNull() for _, hk in pairs]
    hside = history.where(_all(has_key)).select(
        *[F.col(hk).alias(k) for (_, hk), k in zip(pairs, kcols)],
        F.col(frm).alias("_t"), F.lit(0).alias("_side"),
        F.lit(None).cast(ltype).alias("_l"), hrow.alias("_h"))
    both = hside.unionByName(lside)
    # versions sort before left rows of the same instant: ``from <= at`` is inclusive
    carried = keyed_carry(both, kcols, ["_t", "_side"], "_h", "_m", hot_rows, chunk_rows, fraction)
    rows = carried.where(F.col("_side") == 1)
    ok = _all([F.col(k).isNotNull() for k in kcols] + [F.col("_t").isNotNull(), F.col("_m").isNotNull(),
                                                       F.col("_t") < F.col(f"_m.{until}")])
    lout = F.struct(*lwhole(lambda c: _back("_l", c, lfrom)))
    rout = F.struct(*hwhole(lambda c: _back("_m", c, hfrom)))
    if how == "inner":
        return rows.where(ok).select(lout.alias(ln), rout.alias(rn))
    return rows.select(lout.alias(ln), F.when(ok, rout).alias(rn))


def _exact(left: DataFrame, a: str, right: DataFrame, b: str) -> bool:
    kind = left.schema[a].dataType
    return kind == right.schema[b].dataType and kind.typeName() in EXACT


def _back(row: str, name: str, shuffled_as: dict[str, str]) -> Column:
    """A row's column, from what it was shuffled by where that holds it."""
    return F.col(shuffled_as[name]).alias(name) if name in shuffled_as else F.col(row).getField(name).alias(name)


def _all(conds):
    out = F.lit(True)
    for c in conds:
        out = out & c
    return out


__all__ = ["as_of_join"]
