"""Exact distinct counts that can be stored and merged.

Values fall into buckets of 32,768 neighbouring whole numbers, and a bucket's bitmap says
which of them occurred. Bitmaps of the same key and bucket are merged by "or", so partial
results of different loads, days or tasks add up to the exact count, without the values.
A bitmap has a fixed size: this pays for dense ids, not for values scattered over 64 bits.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BUCKET, BITMAP = "bucket", "bitmap"


def distinct_bitmaps(df: DataFrame, keys: Sequence[str], value: Column) -> DataFrame:
    """``keys, bucket, bitmap`` of the whole numbers ``value``; NULLs count for nothing.

    A key with no value at all keeps a row of its own (no bucket, empty bitmap).
    """
    number = value.cast("bigint")
    return df.groupBy(*keys, F.bitmap_bucket_number(number).alias(BUCKET)).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(number)).alias(BITMAP)
    )


def merge_bitmaps(parts: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One bitmap for each key and bucket."""
    return parts.groupBy(*keys, BUCKET).agg(F.bitmap_or_agg(BITMAP).alias(BITMAP))


def bitmap_counts(parts: DataFrame, keys: Sequence[str], name: str) -> DataFrame:
    """``keys`` and the number of distinct values over all of ``parts``."""
    merged = merge_bitmaps(parts, keys)
    return merged.groupBy(*keys).agg(F.sum(F.bitmap_count(BITMAP)).alias(name))
