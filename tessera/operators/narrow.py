"""Rows made narrow for a shuffle, and every value given back behind it.

* A decimal of more than 18 digits takes 24 bytes in a row, one of 18 takes 8: it travels as the latter where it fits.  A
  row with a value that doesn't fit carries its wide decimals beside them.
* Times that repeat another time of their row (load, commit and start times often do) travel only where they differ.
* Every number takes 8 bytes in a row, however small.  For inputs from ``PACK_BYTES`` on, integers and short decimals share
  longs, each with the bits that a sample's range asks for; a row with a number outside carries its numbers beside them.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.session import input_bytes

SHORT_DIGITS = 18
PACK_BYTES = 32 << 20   # stored bytes of an input from which its numbers are packed: a small one isn't worth the sample
PACK_SAMPLE = 0.01      # share of rows sampled for the ranges
PACK_COLUMNS = 20       # wider rows aren't packed: with what they derive, the generated method was too long to be compiled
WORD_BITS, MOST_BITS = 63, 48
LOOSE = "_loose"        # the numbers of a row in which one is outside its range
WIDE = "_wide"          # the wide decimals of a row in which one doesn't fit

Getter = Callable[[str], Column]


def _col(name: str) -> Column:
    return F.col(f"`{name}`")


def narrow_columns(df: DataFrame, like: str | None = None, skip: Sequence[str] = ()
                   ) -> tuple[dict[str, Column], Callable[[Getter], list[Column]]]:
    """The narrow columns of ``df`` by name, and what makes its columns, in their order, out of those.

    Times of the type of ``like`` are kept where they differ from it; columns in ``skip`` stay as they are."""
    fields = [f for f in df.schema if f.name != like and f.name not in skip]
    wide = {f.name: T.DecimalType(SHORT_DIGITS, f.dataType.scale) for f in fields if isinstance(f.dataType, T.DecimalType)
            and f.dataType.precision > SHORT_DIGITS >= f.dataType.scale}
    kind = df.schema[like].dataType if like else None
    times = {f.name for f in fields if isinstance(kind, (T.TimestampType, T.TimestampNTZType)) and f.dataType == kind}
    out: dict[str, Column] = {}
    for c in df.columns:
        if c in wide:
            out[c] = _col(c).try_cast(wide[c]).alias(c)
        elif c in times:
            out[c] = F.when(~_col(c).eqNullSafe(_col(like)), F.struct(_col(c).alias("t"))).alias(c)
        else:
            out[c] = _col(c)
    if wide:
        misfit = F.lit(False)
        for c, short in wide.items():
            misfit = misfit | (_col(c).isNotNull() & _col(c).try_cast(short).isNull())
        out[WIDE] = F.when(misfit, F.struct(*[_col(c) for c in wide])).alias(WIDE)

    def whole(get: Getter) -> list[Column]:
        back = []
        for f in df.schema:
            c, v = f.name, get(f.name)
            if c in wide:
                v = F.when(get(WIDE).isNotNull(), get(WIDE).getField(c)).otherwise(v.cast(f.dataType)).alias(c)
            elif c in times:
                v = F.when(v.isNotNull(), v.getField("t")).otherwise(get(like)).alias(c)
            back.append(v)
        return back

    return out, whole


def _whole_number(c: Column, kind: T.DataType) -> Column:
    return (c * F.lit(10 ** kind.scale)).cast("long") if isinstance(kind, T.DecimalType) and kind.scale else c.cast("long")


def _from_whole(n: Column, kind: T.DataType) -> Column:
    if isinstance(kind, T.DecimalType) and kind.scale:
        n = n.cast("decimal(19,0)") * F.lit(f"1e-{kind.scale}").cast(T.DecimalType(kind.scale, kind.scale))
    return n.cast(kind)


def _ranges(thin: DataFrame, numbers: dict[str, T.DataType], fraction: float) -> dict[str, tuple[int, int]]:
    """Lowest number and bits of each column, twice as wide as a sample shows; of no use for more than ``MOST_BITS``."""
    rows = thin if fraction >= 1 else thin.sample(fraction=fraction, seed=17)
    seen = rows.agg(F.count(F.lit(1)).alias("n"), *(f(_whole_number(_col(c), kind)).alias(f"{name}{i}") for i, (c, kind) in enumerate(numbers.items())
                                                    for name, f in (("lo", F.min), ("hi", F.max)))).first()
    out = {}
    for i, c in enumerate(numbers if seen["n"] else ()):
        lo, hi = seen[f"lo{i}"] or 0, seen[f"hi{i}"] or 0
        low, bits = max(lo - (hi - lo) // 2, -(1 << 62)), (2 * (hi - lo) + 2).bit_length()
        if bits <= MOST_BITS:
            out[c] = (low, bits)
    return out


def packed_columns(df: DataFrame, like: str | None = None, skip: Sequence[str] = (), apart: Sequence[str] = (), fraction: float = PACK_SAMPLE
                   ) -> tuple[dict[str, Column], Callable[[Getter], list[Column]]]:
    """:func:`narrow_columns` with the numbers of large inputs packed, but those in ``skip`` and ``apart``.

    A column's code is 0 for NULL, else its distance from the column's lowest number, from 1; the sample decides on how
    many bytes are saved, not on the rows."""
    columns, whole = narrow_columns(df, like, skip)
    if len(columns) > PACK_COLUMNS or input_bytes(df) < PACK_BYTES:
        return columns, whole
    thin = df.select(*columns.values())
    numbers = {f.name: f.dataType for f in thin.schema if f.name not in (like, *skip, *apart) and (
        isinstance(f.dataType, (T.ByteType, T.ShortType, T.IntegerType, T.LongType))
        or isinstance(f.dataType, T.DecimalType) and 0 <= f.dataType.scale <= f.dataType.precision <= SHORT_DIGITS)}
    ranges = _ranges(thin, numbers, fraction) if len(numbers) > 1 else {}
    if len(ranges) < 2:
        return columns, whole
    places: dict[str, tuple[int, int]] = {}
    used: list[int] = []
    for c in sorted(ranges, key=lambda c: -ranges[c][1]):
        word = next((w for w, n in enumerate(used) if n + ranges[c][1] <= WORD_BITS), len(used))
        used += [0] if word == len(used) else []
        places[c], used[word] = (word, used[word]), used[word] + ranges[c][1]
    fits, words = F.lit(True), [F.lit(0).cast("long")] * len(used)
    for c, (word, at) in places.items():
        low, bits = ranges[c]
        n = _whole_number(columns[c], numbers[c])
        fits = fits & (n.isNull() | n.between(F.lit(low), F.lit(min(low + (1 << bits) - 2, (1 << 63) - 1))))
        words[word] = words[word].bitwiseOR(F.shiftleft(F.coalesce(n - F.lit(low) + F.lit(1).cast("long"), F.lit(0).cast("long")), at))
    out = {c: v for c, v in columns.items() if c not in places}
    out |= {f"_word{w}": F.when(fits, v).alias(f"_word{w}") for w, v in enumerate(words)}
    out[LOOSE] = F.when(~fits, F.struct(*[columns[c] for c in places])).alias(LOOSE)

    def unpacked(get: Getter) -> Getter:
        def one(c: str) -> Column:
            if c not in places:
                return get(c)
            (word, at), (low, bits) = places[c], ranges[c]
            code = F.shiftright(get(f"_word{word}"), at).bitwiseAND(F.lit((1 << bits) - 1).cast("long"))
            inside = F.when(code != 0, _from_whole(code + F.lit(low - 1).cast("long"), numbers[c]))
            return F.when(get(LOOSE).isNotNull(), get(LOOSE).getField(c)).otherwise(inside).alias(c)
        return one

    return out, lambda get: whole(unpacked(get))


def exchanged(df: DataFrame, exchange: Callable[[DataFrame], DataFrame], like: str | None = None, skip: Sequence[str] = ()) -> DataFrame:
    """``exchange(df)`` with narrow rows; the columns that it goes by are in ``skip``."""
    columns, whole = packed_columns(df, like, skip)
    return exchange(df.select(*columns.values())).select(*whole(_col))


__all__ = ["exchanged", "narrow_columns", "packed_columns"]
