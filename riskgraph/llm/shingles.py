"""Token hashes of texts as columns, for the operators that stay in DataFrame functions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def token_hashes(text: str) -> Column:
    """array<bigint>: a hash for each run of letters and digits of the lower-case text, in order.

    A null or empty text, or one without letters and digits, gives an empty array.
    """
    tokens = F.split(F.lower(F.coalesce(F.col(text), F.lit(""))), r"[^\p{L}\p{N}]+")
    return F.transform(F.filter(tokens, lambda t: t != ""), lambda t: F.xxhash64(t))
