"""Small DataFrame helpers shared by the operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def merge_single_rows(*frames: DataFrame) -> DataFrame:
    """Put the columns of several one-row aggregates side by side.

    Each frame contributes its own columns and NULL for the others; the
    ``UNION ALL`` is folded with ``max`` (NULLs ignored).  No join, and all
    inputs stay in one plan tree, so a table they share (the frequency table
    of a stream report, say) is scanned and shuffled once - Spark reuses the
    identical exchange.  Written as one SQL statement, analysed once."""
    spark = frames[0].sparkSession
    names = {f"f{i}": fr for i, fr in enumerate(frames)}
    cols = [(f.name, f.dataType.simpleString()) for fr in frames for f in fr.schema.fields]
    branches = []
    for i, fr in enumerate(frames):
        own = set(fr.columns)
        sel = ", ".join(f"`{c}`" if c in own else f"CAST(NULL AS {t}) AS `{c}`" for c, t in cols)
        branches.append(f"SELECT {sel} FROM {{f{i}}}")
    folded = ", ".join(f"max(`{c}`) AS `{c}`" for c, _ in cols)
    return spark.sql(f"SELECT {folded} FROM ({' UNION ALL '.join(branches)})", **names)


def replicate(params: list[dict]) -> Column:
    """``explode`` of a literal array of parameter structs.

    Copies each row once per parameter set (``R`` runs, ``D`` sketch rows, a
    sweep grid) inside the same stage - no join, no shuffle; the array's size
    is the number of parameter sets, fixed by the caller.  Built as one SQL
    expression (integer parameters only)."""
    def one(p):
        return "named_struct(" + ", ".join(f"'{k}', {int(v)}" for k, v in p.items()) + ")"
    return F.expr("explode(array(" + ", ".join(one(p) for p in params) + "))")


def ratio(num: Column, den: Column, places: int = 9) -> Column:
    """``num / den`` as DOUBLE rounded to ``places``; NULL when ``den`` is 0."""
    return F.round(F.try_divide(num.cast("double"), den.cast("double")), places)
