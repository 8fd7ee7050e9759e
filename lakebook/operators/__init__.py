"""DataFrame -> DataFrame building blocks."""

from .anchors import anchor_measure, numbered_rows
from .book import (
    BookSpec,
    Family,
    book_of_partials,
    day_partials,
    feature_book,
    merge_partials,
)
from .dedup import duplicate_report, latest_version, top_duplicates
from .distinct import bitmap_counts, distinct_bitmaps, merge_bitmaps
from .identity import collisions
from .incremental import filter_new, next_hwm
from .joins import attach_events, enrich
from .lookback import with_lookback
from .nearest import assign_nearest, nearest_sensor, segment_table, segments

__all__ = [
    "BookSpec", "Family", "anchor_measure", "assign_nearest", "attach_events", "bitmap_counts",
    "book_of_partials", "collisions", "day_partials", "distinct_bitmaps", "duplicate_report",
    "enrich", "feature_book", "filter_new", "latest_version",
    "merge_bitmaps", "merge_partials", "nearest_sensor", "next_hwm", "numbered_rows",
    "segment_table", "segments", "top_duplicates", "with_lookback",
]
