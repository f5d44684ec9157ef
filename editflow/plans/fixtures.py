"""Inputs the file-based queries write before reading them back.

All of them are derived by Spark from the ``events`` table (through the
edit adapter), so their size grows with the input.  They are written under
the session's shared checkpoint folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from editflow.sources.feed_capture import DATA_PREFIX

# Every CORRUPT_EVERY-th event (by meta.offset) is preceded by a truncated,
# non-JSON data line that the capture job has to set aside.
CORRUPT_EVERY = 50


def render_feed_capture(raw: DataFrame) -> DataFrame:
    """Server-sent-event lines of the events, ordered by ``(event_key, pos)``.

    Per event: ``event: message``, an ``id:`` line, the ``data:`` line with
    the event as JSON and a blank separator; some events get a corrupt data
    line first.
    """
    key = F.col("meta.offset")
    event_json = F.to_json(F.struct(*[F.col(c) for c in raw.columns]))
    id_line = F.concat(
        F.lit('id: [{"topic":"'), F.col("meta.topic"), F.lit('","partition":'),
        F.col("meta.partition").cast("string"), F.lit(',"offset":'), key.cast("string"), F.lit("}]"),
    )
    corrupt = F.when(
        key % CORRUPT_EVERY == 0,
        F.concat(F.lit(DATA_PREFIX + '{"broken": '), key.cast("string")),
    )
    lines = F.array(
        corrupt,
        F.lit("event: message"),
        id_line,
        F.concat(F.lit(DATA_PREFIX), event_json),
        F.lit(""),
    )
    return (
        raw.select(key.alias("event_key"), F.posexplode(lines).alias("pos", "value"))
        .where(F.col("value").isNotNull())
    )


def write_feed_capture(lines: DataFrame, directory: str) -> str:
    """Write capture text so that file order, then line order, is capture order."""
    (
        lines.repartitionByRange("event_key", "pos")
        .sortWithinPartitions("event_key", "pos")
        .select("value")
        .write.mode("overwrite")
        .text(directory)
    )
    return directory
