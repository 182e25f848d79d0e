"""Row signatures and reference-key hashes (SHA2-256 over text)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

SEPARATOR = "||"


def _text(c: str | Column) -> Column:
    col = F.col(c) if isinstance(c, str) else c
    return F.coalesce(col.cast("string"), F.lit(""))


def row_hash(columns: Sequence[str | Column]) -> Column:
    """SHA2-256 of the columns cast to text, NULL as empty, joined by ``||``.

    NULL and the empty string hash alike, by design of the signature.
    """
    return F.sha2(F.concat_ws(SEPARATOR, *[_text(c) for c in columns]), 256)


def key_hash(columns: Sequence[str | Column]) -> Column:
    """Hash of a (referenced) business key, for ``WK_REF_HASH_`` style columns."""
    return row_hash(columns)


def packed_hash(c: str | Column) -> Column:
    """The 32 bytes of a :func:`row_hash`: half of its text, in shuffles and tables."""
    return F.unhex(F.col(c) if isinstance(c, str) else c)


def shown_hash(c: str | Column) -> Column:
    """The text of a :func:`packed_hash`."""
    return F.lower(F.hex(F.col(c) if isinstance(c, str) else c))
