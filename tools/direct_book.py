"""The book by one conditional aggregate per feature: the cross-check of ``feature_book``."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakebook.operators import BookSpec
from lakebook.operators.book import conditional


def feature_book_direct(df: DataFrame, spec: BookSpec) -> DataFrame:
    """As ``feature_book``, by one aggregate with a conditional per feature.

    Plain and fine for a few features; for hundreds it evaluates every condition on every
    row, without generated code.
    """
    exprs = []
    for family, name, measure, window in spec.cells():
        inside = F.col(family.column) == name
        if window is not None:
            inside = inside & (F.col(window) == 1)
        value = F.when(inside, F.col(measure))
        for aggregate in spec.aggregates:
            exprs.append(conditional(aggregate, value))
    named = [e.alias(n) for e, n in zip(exprs, spec.feature_names())]
    return df.groupBy(*spec.keys).agg(*named)
