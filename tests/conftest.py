"""Shared local session for the tests (8 shuffle partitions, UTC, no UI)."""

from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tessera.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = build_session(master="local[4]", app="tessera-tests", shuffle_partitions=8)
    s.sparkContext.setLogLevel("OFF")
    yield s


def rows(df, *order):
    """Collected rows as plain tuples, sorted by ``order`` (or fully)."""
    out = [tuple(r) for r in (df.orderBy(*order) if order else df).collect()]
    return out if order else sorted(out, key=repr)
