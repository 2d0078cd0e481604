"""Join helpers with an explicit, checked strategy.

A side is broadcast only after its row count is checked against a bound.
Past the bound the join is a shuffle join; when the large side has hot keys
(one key may hold a third of all rows) it is salted: the large side gets a
salt from a hash of its own columns, the small side is replicated once per
salt value, so a hot key is spread over ``salt_buckets`` tasks.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

DEFAULT_BROADCAST_ROWS = 2_000_000


def skew_safe_join(big: DataFrame, small: DataFrame, on: Sequence[str],
                   how: str = "inner", small_rows: int | None = None,
                   max_broadcast_rows: int = DEFAULT_BROADCAST_ROWS,
                   salt_buckets: int = 0, salt_cols: Sequence[str] | None = None) -> DataFrame:
    """Join a large table with hot keys to a smaller one; ``how`` is "inner"
    or "left" (rows of ``big`` kept).

    * ``small_rows`` known (a model size, a checkpointed table's count) and
      within ``max_broadcast_rows``: broadcast ``small``.
    * ``salt_buckets > 0``: salted shuffle join -- ``big`` gets a salt from a
      hash of its own columns, ``small`` is replicated once per salt.
    * otherwise: a plain shuffle join; AQE measures both sides at runtime,
      broadcasts a side under its threshold, and splits skewed partitions
      (``spark.sql.adaptive.skewJoin.enabled``)."""
    if how not in ("inner", "left"):
        raise ValueError("how must be 'inner' or 'left'")
    if small_rows is not None and small_rows <= max_broadcast_rows:
        return big.join(F.broadcast(small), list(on), how)
    if salt_buckets > 0:
        cols = list(salt_cols) if salt_cols else big.columns
        salted_big = big.withColumn("_salt", F.pmod(F.xxhash64(*cols), F.lit(salt_buckets)))
        salted_small = small.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salt_buckets - 1))))
        return salted_big.join(salted_small, list(on) + ["_salt"], how).drop("_salt")
    return big.join(small, list(on), how)
