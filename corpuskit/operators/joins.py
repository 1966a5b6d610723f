"""Joins that pick their strategy by a measured size: broadcast only what was measured to be small."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Most bytes of the keys that are broadcast, texts counted as they are.
BROADCAST_BYTES = 8 << 20
_ROW = 16  # bytes of a row, and of each text in it, besides its own


def _small(keys: DataFrame, max_bytes: int) -> bool:
    """Whether ``keys`` has at most ``max_bytes``; no more rows are looked at than could be that small."""
    texts = [c for c, kind in keys.dtypes if kind in ("string", "binary")]
    fixed = _ROW + 8 * (len(keys.columns) - len(texts)) + _ROW * len(texts)
    width = F.lit(fixed)
    for c in texts:
        width = width + F.coalesce(F.octet_length(c), F.lit(0))
    total = keys.limit(max_bytes // fixed + 1).agg(F.sum(width)).first()[0] or 0
    return total <= max_bytes


def semi_join(df: DataFrame, keys: DataFrame, on: list[str], max_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Rows of ``df`` whose key stands in ``keys``. Few keys are broadcast and ``df`` is not shuffled; else both are.

    ``keys`` should be materialised (a checkpoint or table), as it is measured first. Null keys match nothing.
    """
    keys = keys.select(*on).distinct()
    return df.join(F.broadcast(keys) if _small(keys, max_bytes) else keys, on, "left_semi")


def anti_join(df: DataFrame, keys: DataFrame, on: list[str], max_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Rows of ``df`` whose key does not stand in ``keys``; rows with null keys stay."""
    keys = keys.select(*on).distinct()
    return df.join(F.broadcast(keys) if _small(keys, max_bytes) else keys, on, "left_anti")
