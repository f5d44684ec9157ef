"""Map the generic ``events`` table onto landed edit events.

The test tables carry no wiki edits, so every query derives its edits from
``events(event_id, ts, user_id, event_type, value, props)`` with this
deterministic, row-local mapping (a single narrow projection: no shuffle,
and only the six source columns are read).  NULLs are injected on purpose so
that each data-quality rule has something to catch.  The same mapping is
written in SQL for the DuckDB oracle (``editflow.plans.oracle``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# Fixed values of the mapping (mirrored in the oracle SQL).
# id NULL when event_id % 103 = 0; title NULL when % 97 = 0; timestamp NULL
# when % 101 = 0; user NULL when % 89 = 0; bot NULL when % 13 = 0.
# wiki by w = (user_id + event_id % 2) % 10: w < 6 enwiki, w < 8 dewiki,
# w = 8 frwiki, w = 9 NULL.  type: signup -> new, error -> log, else edit.
# ---------------------------------------------------------------------------
NULL_EVERY = {"id": 103, "title": 97, "timestamp": 101, "user": 89, "bot": 13}
WIKI_BANDS = ((6, "enwiki"), (8, "dewiki"), (9, "frwiki"))
TYPE_OF_EVENT = {"signup": "new", "error": "log"}
DEFAULT_TYPE = "edit"
EXAMPLE_HOST = "example.org"


def _null_every(column: Column, event_id: Column, every: int) -> Column:
    return F.when(event_id % every == 0, F.lit(None)).otherwise(column)


def _text(c: Column) -> Column:
    return c.cast("string")


def edits_from_events(events: DataFrame) -> DataFrame:
    """One landed edit event (the landing schema, nested) per ``events`` row."""
    eid = F.col("event_id")
    etype = F.col("event_type")
    k = F.get_json_object("props", "$.k").cast("long")
    w = (F.col("user_id") + eid % 2) % 10
    wiki = F.when(w < WIKI_BANDS[0][0], WIKI_BANDS[0][1])
    for limit, name in WIKI_BANDS[1:]:
        wiki = wiki.when(w < limit, name)
    wiki_domain = F.concat(wiki, F.lit(f".{EXAMPLE_HOST}"))
    kind = F.lit(DEFAULT_TYPE)
    for source, target in reversed(TYPE_OF_EVENT.items()):
        kind = F.when(etype == source, target).otherwise(kind)
    # ``ts`` has no zone; it is read as UTC (the session time zone editflow pins).
    epoch_ms = F.unix_millis(F.col("ts").cast("timestamp"))
    old_length = (eid * 37 % 5000).cast("int")
    new_length = (eid * 37 % 5000 + F.lit(8) * (F.floor("value") - 40)).cast("int")
    return events.select(
        _null_every(_text(eid), eid, NULL_EVERY["id"]).alias("id"),
        kind.alias("type"),
        (eid % 4).cast("int").alias("namespace"),
        _null_every(
            # k is referenced once: a repeated JSON lookup inside a CASE branch
            # is not shared by subexpression elimination.
            F.concat(F.lit("Page_"), _text(F.call_function("div", F.pow(k, 4).cast("long"), F.lit(1000000)))),
            eid,
            NULL_EVERY["title"],
        ).alias("title"),
        F.concat(F.lit(f"https://{EXAMPLE_HOST}/p/"), _text(eid % 50)).alias("title_url"),
        F.concat(etype, F.lit(" note")).alias("comment"),
        _null_every(epoch_ms, eid, NULL_EVERY["timestamp"]).alias("timestamp"),
        _null_every(F.concat(F.lit("User_"), _text(F.col("user_id"))), eid, NULL_EVERY["user"]).alias("user"),
        _null_every(etype == "error", eid, NULL_EVERY["bot"]).alias("bot"),
        (etype == "view").alias("minor"),
        (etype == "purchase").alias("patrolled"),
        F.when(etype == "error", F.lit(None))
        .otherwise(F.struct(old_length.alias("old"), new_length.alias("new")))
        .alias("length"),
        F.struct(eid.cast("int").alias("old"), (eid + 1).cast("int").alias("new")).alias("revision"),
        F.concat(F.lit("https://"), wiki_domain).alias("server_url"),
        wiki_domain.alias("server_name"),
        F.lit("/w").alias("server_script_path"),
        wiki.alias("wiki"),
        F.concat(F.lit("<i>"), etype, F.lit("</i>")).alias("parsedcomment"),
        F.struct(
            F.concat(F.lit(f"https://{EXAMPLE_HOST}/e/"), _text(eid)).alias("uri"),
            F.concat(F.lit("req-"), _text(eid % 1000)).alias("request_id"),
            F.concat(F.lit("ev-"), _text(eid)).alias("id"),
            F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("dt"),
            F.concat(etype, F.lit(f".{EXAMPLE_HOST}")).alias("domain"),
            F.lit("edits").alias("stream"),
            F.concat(F.lit("topic."), etype).alias("topic"),
            (eid % 8).cast("int").alias("partition"),
            eid.alias("offset"),
        ).alias("meta"),
    )


def read_events(spark, sf_dir: str) -> DataFrame:
    path = f"{sf_dir.rstrip('/')}/events.parquet"
    return spark.read.parquet(path)


def raw_edits(spark, sf_dir: str) -> DataFrame:
    """Landed edit events derived from ``<sf_dir>/events.parquet``."""
    return edits_from_events(read_events(spark, sf_dir))
