"""dedup_by_completeness: keep, per business key, the most complete row.

The reference writes ``ROW_NUMBER() OVER (PARTITION BY key ORDER BY score
DESC) = 1``.  A window sorts every row of a key in one task, so a key holding a
large share of the rows would land on a single executor.  Here the choice is an
aggregate instead: the minimum of a *total* order

    (-score, extra tie-breaks..., then every output column ascending, NULLs last)

is computed partially on each map partition and merged after the shuffle, so
each partition sends at most one candidate row per key.  The total order also
makes the result deterministic where the reference's is not (equal scores).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def asc_nulls_last(c: Column) -> Column:
    return F.struct(c.isNull().alias("missing"), c.alias("value"))


def desc_nulls_last(c: Column) -> Column:
    """For numeric columns: descending, NULLs last."""
    return F.struct(c.isNull(), -c)


def dedup_by_completeness(df: DataFrame, key: list[Column], score: Column, outputs: list[Column],
                          tiebreak: list[Column] | None = None, where: Column | None = None) -> DataFrame:
    """Rows of `df` (optionally filtered) reduced to one per `key`.

    `outputs` are aliased output expressions; `score` and `tiebreak` see the
    raw input columns (as in the reference, the window's ORDER BY binds to the
    FROM columns, not to the cleaned ones).  `tiebreak` terms must already be
    orderable keys (see asc_nulls_last / desc_nulls_last).
    """
    src = df.where(where) if where is not None else df
    keys = [f"_key{i}" for i in range(len(key))]
    staged = src.select(
        *[k.alias(n) for k, n in zip(key, keys)],
        (-score).alias("_neg_score"),
        *[t.alias(f"_tb{i}") for i, t in enumerate(tiebreak or [])],
        *outputs,
    )
    out_cols = staged.columns[len(key) + 1 + len(tiebreak or []):]
    if len(out_cols) != len(outputs):
        raise ValueError("outputs must be distinct aliased columns")
    # per output column: is it missing, then its value (NULLs last), side by side in one flat struct
    ranked = [x for i, c in enumerate(out_cols) for x in (F.col(c).isNull().alias(f"_m{i}"), F.col(c).alias(f"_o{i}"))]
    order = F.struct(F.col("_neg_score"), *[F.col(f"_tb{i}") for i in range(len(tiebreak or []))], *ranked)
    # The aggregate sorts by its keys; a hash in front of them tells most rows apart by one number.
    # The order holds every output column once; the winner's values are read back from it.
    best = staged.groupBy(F.xxhash64(*keys).alias("_hash"), *keys).agg(F.min(order).alias("_best"))
    return best.select(*[F.col(f"_best._o{i}").alias(c) for i, c in enumerate(out_cols)])
