"""Keyed pseudo-random draws.

A draw is a pure function of a row's key text: the first 60 bits of its MD5
digest. It does not depend on partitioning, task order or retries, so a
re-executed task reproduces the same rows, and the same draw can be
recomputed by any SQL engine with MD5 (the oracle does).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def key_text(*parts: Column) -> Column:
    """``|``-joined key; each part is rendered as text, null as ``null``."""
    return F.concat_ws("|", *[F.coalesce(p.cast("string"), F.lit("null")) for p in parts])


def hash60(text: Column) -> Column:
    """Non-negative 60-bit integer from the MD5 of ``text``."""
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("bigint")


def uniform_index(text: Column, n: Column) -> Column:
    """An index in ``[0, n)`` drawn from ``text``."""
    return F.pmod(hash60(text), n)
