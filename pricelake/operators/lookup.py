"""Left joins to dimension tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

BROADCAST_LIMIT_BYTES = 64 * 1024 * 1024
BROADCAST_LIMIT_ROWS = 500_000


def measured(dim: DataFrame) -> tuple[int, int]:
    """Rows and bytes of a dimension by one distributed aggregate: its texts and 8 bytes per other column."""
    texts = [f.name for f in dim.schema.fields if isinstance(f.dataType, T.StringType)]
    width = sum((F.coalesce(F.octet_length(c), F.lit(0)) for c in texts), F.lit(8 * (len(dim.columns) - len(texts))))
    found = dim.agg(F.count("*").alias("rows"), F.sum(width.cast("bigint")).alias("bytes")).first()
    return found.rows, found.bytes or 0


def _is_small(size: tuple[int, int], parts: int = 1, max_rows: int = BROADCAST_LIMIT_ROWS, max_bytes: int = BROADCAST_LIMIT_BYTES) -> bool:
    rows, width = size
    return rows <= max_rows * parts and width <= max_bytes * parts


def fits_broadcast(dim: DataFrame, max_rows: int = BROADCAST_LIMIT_ROWS, max_bytes: int = BROADCAST_LIMIT_BYTES) -> bool:
    return _is_small(measured(dim), 1, max_rows, max_bytes)


_SPREAD = "_spread"


def spread_nulls(fact: DataFrame, on: Sequence[str]) -> DataFrame:
    """Add a second join key: 0, or a hash of the row where a key is NULL, so that these rows do not all meet in one partition."""
    atomic = [f.name for f in fact.schema.fields if not isinstance(f.dataType, (T.MapType, T.VariantType))]
    no_key = F.expr(" OR ".join(f"`{k}` IS NULL" for k in on))
    return fact.withColumn(_SPREAD, F.when(no_key, F.xxhash64(*[F.col(f"`{c}`") for c in atomic])).otherwise(F.lit(0)))


def lookup_join(
    fact: DataFrame,
    dim: DataFrame,
    on: Sequence[str],
    how: str = "left",
    stored: bool = True,
) -> DataFrame:
    """Join a fact table to a dimension on equal keys, keeping every fact row (``left``) or the
    matching ones (``inner``, ``left_semi``, ``left_anti``).

    A stored dimension that measures small is broadcast. A larger one is shuffled on the keys, where adaptive
    execution splits a fact partition that one key made too large (all these join types allow
    splitting the fact side); its share of a partition is hashed while that is small, so the wide fact rows are not sorted.
    One that is an aggregate (``stored=False``) is never run just to be measured: adaptive
    execution knows its size when it has run. NULL keys match nothing, and a left join spreads their rows.
    """
    dim = dim.where(" AND ".join(f"`{k}` IS NOT NULL" for k in on))
    size = measured(dim) if stored else None
    if size and _is_small(size):
        return fact.join(F.broadcast(dim), list(on), how)
    if size and _is_small(size, int(fact.sparkSession.conf.get("spark.sql.shuffle.partitions"))):
        dim = dim.hint("shuffle_hash")
    if how != "left":
        return fact.join(dim, list(on), how)
    # Always 0, but no literal: the optimizer would turn that into a filter and shuffle on the other keys alone.
    zero = F.pmod(F.hash(*on), F.lit(1)).cast("bigint")
    return spread_nulls(fact, on).join(dim.withColumn(_SPREAD, zero), [*on, _SPREAD], how).drop(_SPREAD)


def duplicate_keys(dim: DataFrame, on: Sequence[str]) -> DataFrame:
    """Keys held by more than one dimension row; a left join would fan out on them."""
    return dim.groupBy(*on).count().where("count > 1")
