"""Digests of rows and keys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def row_digest(columns: Sequence[str]) -> tuple[Column, Column]:
    """128 bits of the columns, in two halves. NULL differs from every value and from NULL elsewhere."""
    cells = [F.col(f"`{c}`") for c in columns]
    # The hash passes over NULL, so which columns are NULL is hashed as well.
    known = F.concat(*[F.when(c.isNull(), "0").otherwise("1") for c in cells])
    return F.xxhash64(*cells, known), F.xxhash64(F.lit(1), known, *cells)
