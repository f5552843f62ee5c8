"""Hashed keys."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def _col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def surrogate_key(*parts: Column | str) -> Column:
    """SHA-256 over the parts as text, joined by ``|``. Any NULL part gives NULL."""
    pieces: list[Column] = []
    for part in parts:
        if pieces:
            pieces.append(F.lit("|"))
        pieces.append(_col(part).cast("string"))
    return F.sha2(F.concat(*pieces), 256)


def hash_key(part: Column | str) -> Column:
    """SHA-256 of one natural key."""
    return F.sha2(_col(part).cast("string"), 256)
