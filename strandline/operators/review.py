"""Edits of a reviewed table carried on to a new proposal: a three-way merge by row key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def merge_edits(base: DataFrame, edited: DataFrame, proposed: DataFrame, keys: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """(merged, conflicts) of a table as it was proposed, as it was edited, and as it is proposed now.

    A row that was not edited is as it is proposed now, or gone.  One that was edited, added or deleted stays so if it is proposed as before.  Where both
    changed and not to the same, the edit stands in merged, and the row in conflicts (keys, base, edited, proposed; null where there is none).
    Columns are those proposed now; keys must be unique and not null in each table.
    """
    columns = [c for c in proposed.columns if c not in keys]

    def side(df: DataFrame, name: str) -> DataFrame:
        have = [F.col(c) if c in df.columns else F.lit(None).cast(proposed.schema[c].dataType).alias(c) for c in columns]
        return df.select(*keys, F.struct(F.lit(True).alias("__there"), *[c.cast(proposed.schema[n].dataType).alias(n) for c, n in zip(have, columns, strict=True)]).alias(name))

    # one shuffle each, by key
    rows = side(base, "base").join(side(edited, "edited"), list(keys), "full").join(side(proposed, "proposed"), list(keys), "full")
    same = lambda a, b: F.col(a).eqNullSafe(F.col(b))
    by_hand: Column = ~same("base", "edited")
    take = F.when(by_hand, F.col("edited")).otherwise(F.col("proposed"))
    merged = rows.select(*keys, take.alias("r")).where("r is not null").select(*[F.col(c) if c in keys else F.col(f"r.{c}") for c in proposed.columns])
    clash = rows.where(by_hand & ~same("base", "proposed") & ~same("edited", "proposed"))
    return merged, clash.select(*keys, *[F.when(F.col(x).isNotNull(), F.col(x).dropFields("__there")).alias(x) if columns else F.col(x).isNotNull().alias(x) for x in ("base", "edited", "proposed")])
