"""Helpers for expensive columns."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def compute_once(rows: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """Rows with ``columns`` set, each evaluated exactly once per row.

    Filters on a projected column are pushed below the projection and repeat its expression
    there. They cannot move below a generator, so the values go through a one-row ``inline``.
    """
    made = F.inline(F.array(F.struct(*[c.alias(name) for name, c in columns.items()])))
    kept = [c for c in rows.columns if c not in columns]
    order = [*rows.columns, *[c for c in columns if c not in rows.columns]]
    return rows.select(*kept, made).select(*order)
