"""Exact distinct counts that can be put together: bitmaps of dense value ids.

The distinct counts of hours do not add up to those of a day, and the rows
would have to be read again. Here each value gets a dense integer, an hour keeps one bitmap
for each 32,768 integers of which it has some, and the bitmaps of any hours are
merged by ``bitmap_or_agg``. All of it is Spark's own aggregates.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from editflow.functions.time import hour_bucket

GROUP = ("wiki_language", "is_bot_edit")


def value_ids(df: DataFrame, column: str) -> DataFrame:
    """(value, value_id): an integer for each distinct non-null value of ``column``.

    The integers of a partition are consecutive, so bitmaps of them are dense.
    They depend on the partitions: store the table before it is used. A new
    table gives other integers; bitmaps of two tables do not go together.
    """
    values = df.where(F.col(column).isNotNull()).select(F.col(column).alias("value")).distinct()
    return values.withColumn("value_id", F.monotonically_increasing_id() + 1)


def hourly_bitmaps(clean: DataFrame, column: str, ids: DataFrame) -> DataFrame:
    """(hour, wiki_language, is_bot_edit, bucket, bitmap) of the values of ``column``; ``ids`` are their stored integers.

    A value meets its integer once for each group that has it, however many
    rows hold it. Groups with null values only have no bitmap.
    """
    hour = hour_bucket("event_timestamp").alias("hour")
    pairs = clean.where(F.col(column).isNotNull()).select(hour, *GROUP, F.col(column).alias("value")).distinct()
    bucket = F.bitmap_bucket_number("value_id").alias("bucket")
    bits = F.bitmap_construct_agg(F.bitmap_bit_position("value_id"))
    return pairs.join(ids, "value").groupBy("hour", *GROUP, bucket).agg(bits.alias("bitmap"))


def merged_counts(bitmaps: DataFrame, name: str, unit: str = "day") -> DataFrame:
    """(``unit``, wiki_language, is_bot_edit, ``name``): exact distinct counts of whole days, weeks, months ... of hours."""
    period = F.date_trunc(unit, "hour").alias(unit)
    merged = bitmaps.groupBy(period, *GROUP, "bucket").agg(F.bitmap_or_agg("bitmap").alias("bitmap"))
    return merged.groupBy(unit, *GROUP).agg(F.sum(F.bitmap_count("bitmap")).alias(name))
