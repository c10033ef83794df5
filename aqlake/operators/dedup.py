"""Keep the newest delivery of every key."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aqlake.session import materialize


def latest_per_key(
    df: DataFrame,
    keys: Sequence[str],
    order_by: str,
    ties: str = "keep",
    tie_break: Sequence[str] = (),
) -> DataFrame:
    """Rows whose ``order_by`` is the highest of their key, as ``rank() = 1`` gives.

    NULL counts as highest and NULL keys form one group, as in a descending
    window. ``ties="keep"`` returns all rows that share the highest value;
    ``ties="one"`` keeps the one with the highest ``tie_break`` values, which
    must tell the rows of a key apart.

    No window is used: a window would sort all rows of a key in one task. The
    highest value per key is aggregated (combined map-side, key columns only)
    and written once; the rows then meet that small table in an equi-join.
    Spark broadcasts it if its written size allows, and otherwise AQE can split
    a hot key's rows over several tasks.

    ``df`` is evaluated twice and should be a stored table. The comparison is
    "not below the highest" rather than "equal", so rows that are stamped with
    the current time on each evaluation are still kept.
    """
    if ties not in ("keep", "one"):
        raise ValueError(f"ties must be 'keep' or 'one', not {ties!r}")
    if ties == "one" and not tie_break:
        raise ValueError("ties='one' needs tie_break columns")

    key_names = [f"_key_{i}" for i in range(len(keys))]
    grouped = df.groupBy(*[F.col(k).alias(n) for k, n in zip(keys, key_names)])
    if ties == "keep":
        newest = grouped.agg(
            F.max(F.col(order_by).isNull()).alias("_has_null"),
            F.max(order_by).alias("_newest"),
        )
        is_newest = F.when(F.col("_has_null"), F.col(order_by).isNull()).otherwise(F.col(order_by) >= F.col("_newest"))
    else:
        rank = F.struct(F.col(order_by).isNull().alias("n"), order_by, *tie_break)
        newest = grouped.agg(F.max(rank).alias("_newest"))
        is_newest = rank >= F.col("_newest")

    newest = materialize(newest, "newest")
    same_key = [F.col(k).eqNullSafe(F.col(n)) for k, n in zip(keys, key_names)]
    return df.join(newest, reduce(lambda a, b: a & b, [*same_key, is_newest]), "left_semi")
