"""Key de-duplication with a deterministic survivor.

``dropDuplicates([key])`` keeps an arbitrary row per key.  Here the survivor is
the smallest (``keep="first"``) or largest (``keep="last"``) row by the given
order columns, then by the remaining columns, so reruns give identical output.

It is a grouped ``min``/``max`` over a struct, not a ranking window: Spark runs
it as a partial (map-side) aggregate followed by a merge, so a key holding a
large share of the rows is collapsed inside each map task before the shuffle
instead of being sorted by a single task.  (``dropDuplicates`` compiles to
the same partial/final sort-based aggregate, with ``first`` per column, so the
deterministic survivor costs nothing extra.)
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def dedupe_by_key(df: DataFrame, keys: str | Sequence[str],
                  order_by: Sequence[str] = (), keep: str = "first") -> DataFrame:
    keys = [keys] if isinstance(keys, str) else list(keys)
    columns = df.columns
    order = [c for c in order_by if c not in keys]
    rest = [c for c in columns if c not in keys and c not in order]
    if not order and not rest:
        return df.select(*keys).distinct()
    packed = "struct(" + ", ".join(f"`{c}`" for c in order + rest) + ")"
    pick = F.expr(f"{'min' if keep == 'first' else 'max'}({packed})").alias("_row")
    out = df.groupBy(*keys).agg(pick).selectExpr(*[f"`{k}`" for k in keys], "_row.*")
    return out.selectExpr(*[f"`{c}`" for c in columns])


def latest_by_key(df: DataFrame, keys: str | Sequence[str], order_by: Sequence[str]) -> DataFrame:
    """Last-write-wins view: one row per key, the greatest by ``order_by``."""
    return dedupe_by_key(df, keys, order_by, keep="last")
