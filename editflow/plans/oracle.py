"""Independent DuckDB SQL for every registered query (the correctness oracle).

The SQL re-derives everything from the ``events`` view: the edit adapter,
the landing rules, the cleaning projection and each table.  Engine
differences handled here: DuckDB integer ``//`` truncates like Spark ``div``;
``sum`` of ints is widened to HUGEINT, so it is cast back to BIGINT; ``x / 0``
is infinity, so divisors go through ``NULLIF``; ``||`` is NULL-propagating
like Spark ``concat``.
"""

from __future__ import annotations

RAW = """
raw AS (
  SELECT
    CASE WHEN event_id % 103 = 0 THEN NULL ELSE CAST(event_id AS VARCHAR) END AS id,
    CASE WHEN event_type = 'signup' THEN 'new' WHEN event_type = 'error' THEN 'log' ELSE 'edit' END AS "type",
    CAST(event_id % 4 AS INTEGER) AS namespace,
    CASE WHEN event_id % 97 = 0 THEN NULL
         ELSE 'Page_' || CAST((k * k * k * k) // 1000000 AS VARCHAR) END AS title,
    'https://example.org/p/' || CAST(event_id % 50 AS VARCHAR) AS title_url,
    event_type || ' note' AS "comment",
    CASE WHEN event_id % 101 = 0 THEN NULL ELSE epoch_us(ts) // 1000 END AS "timestamp",
    CASE WHEN event_id % 89 = 0 THEN NULL ELSE 'User_' || CAST(user_id AS VARCHAR) END AS "user",
    CASE WHEN event_id % 13 = 0 THEN NULL ELSE event_type = 'error' END AS bot,
    event_type = 'view' AS minor,
    event_type = 'purchase' AS patrolled,
    CASE WHEN event_type = 'error' THEN NULL ELSE CAST(event_id * 37 % 5000 AS INTEGER) END AS length_old,
    CASE WHEN event_type = 'error' THEN NULL
         ELSE CAST(event_id * 37 % 5000 + 8 * (CAST(floor(value) AS BIGINT) - 40) AS INTEGER) END AS length_new,
    TRY_CAST(event_id AS INTEGER) AS revision_old,
    TRY_CAST(event_id + 1 AS INTEGER) AS revision_new,
    'https://' || wiki || '.example.org' AS server_url,
    wiki || '.example.org' AS server_name,
    '/w' AS server_script_path,
    wiki,
    '<i>' || event_type || '</i>' AS parsedcomment,
    'https://example.org/e/' || CAST(event_id AS VARCHAR) AS meta_uri,
    'req-' || CAST(event_id % 1000 AS VARCHAR) AS meta_request_id,
    'ev-' || CAST(event_id AS VARCHAR) AS meta_id,
    strftime(ts, '%Y-%m-%dT%H:%M:%SZ') AS meta_dt,
    event_type || '.example.org' AS meta_domain,
    'edits' AS meta_stream,
    'topic.' || event_type AS meta_topic,
    CAST(event_id % 8 AS INTEGER) AS meta_partition,
    event_id AS meta_offset
  FROM (
    SELECT *,
      CAST(json_extract_string(props, '$.k') AS BIGINT) AS k,
      CASE WHEN (user_id + event_id % 2) % 10 < 6 THEN 'enwiki'
           WHEN (user_id + event_id % 2) % 10 < 8 THEN 'dewiki'
           WHEN (user_id + event_id % 2) % 10 < 9 THEN 'frwiki' END AS wiki
    FROM events
  ) e
)"""

LANDED = """
landed AS (SELECT * FROM raw WHERE id IS NOT NULL AND "timestamp" IS NOT NULL)"""


def _clean_cte(name: str, source: str, checked: bool) -> str:
    where = (
        "\n  WHERE editor IS NOT NULL AND page_title IS NOT NULL AND event_timestamp IS NOT NULL"
        if checked
        else ""
    )
    return f"""
{name} AS (
  SELECT * FROM (
    SELECT id, "type", namespace, title AS page_title, "user" AS editor, "comment" AS edit_comment,
      strftime(make_timestamp(("timestamp" // 1000) * 1000000), '%Y-%m-%d %H:%M:%S') AS event_timestamp,
      bot AS is_bot_edit, minor AS is_minor_edit, length_old AS old_length, length_new AS new_length,
      TRY_CAST(CAST(length_new AS BIGINT) - length_old AS INTEGER) AS length_change,
      revision_old AS old_revision, revision_new AS new_revision, server_name AS wiki_domain,
      wiki AS wiki_language, parsedcomment AS parsed_comment, meta_uri, meta_request_id, meta_domain,
      meta_stream, meta_topic, meta_partition, meta_offset
    FROM {source}
  ) c{where}
)"""


CLEAN = _clean_cte("clean", "landed", True)
CLEAN_UNCHECKED = _clean_cte("clean_unchecked", "raw", False)
CLEAN_INPUT = _clean_cte("clean_input", "landed", False)

EDITOR_STATS_SELECT = """
  SELECT editor, wiki_language, COUNT(*) AS total_edits, COUNT(DISTINCT page_title) AS pages_edited,
    AVG(length_change) AS avg_length_change, MAX(event_timestamp) AS last_edit_time,
    MIN(event_timestamp) AS first_edit_time,
    COUNT(*) / NULLIF(COUNT(DISTINCT page_title), 0) AS edit_frequency
  FROM {source} WHERE editor IS NOT NULL GROUP BY editor, wiki_language"""

PAGE_STATS_SELECT = """
  SELECT page_title, wiki_language, COUNT(*) AS edit_count, COUNT(DISTINCT editor) AS unique_editors,
    AVG(length_change) AS avg_length_change, MAX(event_timestamp) AS last_edit_time,
    MIN(event_timestamp) AS first_edit_time,
    CAST(SUM(CASE WHEN is_bot_edit THEN 1 ELSE 0 END) AS BIGINT) AS bot_edits,
    CAST(SUM(CASE WHEN is_minor_edit THEN 1 ELSE 0 END) AS BIGINT) AS minor_edits,
    SUM(CASE WHEN is_bot_edit THEN 1 ELSE 0 END) / NULLIF(COUNT(*), 0) AS bot_edit_ratio,
    SUM(CASE WHEN is_minor_edit THEN 1 ELSE 0 END) / NULLIF(COUNT(*), 0) AS minor_edit_ratio,
    COUNT(*) / NULLIF(COUNT(DISTINCT editor), 0) AS edits_per_editor
  FROM {source} WHERE page_title IS NOT NULL GROUP BY page_title, wiki_language"""


def _top_editors_cte(name: str, source: str, checked: bool) -> str:
    where = (
        "\n  WHERE total_edits > 0 AND editor IS NOT NULL AND wiki_language IS NOT NULL"
        " AND last_edit_time IS NOT NULL"
        if checked
        else ""
    )
    return f"""
{name} AS (
  SELECT * FROM ({EDITOR_STATS_SELECT.format(source=source)}
    ORDER BY total_edits DESC, editor ASC NULLS FIRST, wiki_language ASC NULLS FIRST
    LIMIT 100
  ) t{where}
)"""


def _top_pages_cte(name: str, source: str, checked: bool) -> str:
    where = "\n  WHERE edit_count > 0" if checked else ""
    return f"""
{name} AS (
  SELECT * FROM ({PAGE_STATS_SELECT.format(source=source)}
    ORDER BY edit_count DESC, page_title ASC NULLS FIRST, wiki_language ASC NULLS FIRST
    LIMIT 100
  ) t{where}
)"""


TOP_EDITORS = _top_editors_cte("top_editors", "clean", True)
TOP_EDITORS_CUT = _top_editors_cte("top_editors_cut", "clean", False)
TOP_EDITORS_UNCHECKED = _top_editors_cte("top_editors_unchecked", "clean_unchecked", False)
TOP_PAGES = _top_pages_cte("top_pages", "clean", True)
TOP_PAGES_CUT = _top_pages_cte("top_pages_cut", "clean", False)

HOURLY = """
hourly AS (
  SELECT date_trunc('hour', CAST(event_timestamp AS TIMESTAMP)) AS "hour", wiki_language, is_bot_edit,
    COUNT(*) AS edit_count, AVG(length_change) AS avg_length_change,
    COUNT(DISTINCT editor) AS unique_editors, COUNT(DISTINCT page_title) AS unique_pages
  FROM clean GROUP BY 1, 2, 3
)"""

EDITOR_PROFILE = """
editor_profile AS (
  SELECT *,
    CASE WHEN activity_span_days > 0 THEN total_edits / activity_span_days
         ELSE CAST(total_edits AS DOUBLE) END AS edits_per_day,
    CASE WHEN avg_length_change > 100 THEN 'Heavy Editor'
         WHEN avg_length_change > 0 THEN 'Regular Editor' ELSE 'Minor Editor' END AS editor_type
  FROM (
    SELECT *, CAST(date_diff('day', CAST(CAST(first_edit_time AS TIMESTAMP) AS DATE),
                             CAST(CAST(last_edit_time AS TIMESTAMP) AS DATE)) AS INTEGER) AS activity_span_days
    FROM top_editors
  ) s
)"""

PAGE_PROFILE = """
page_profile AS (
  SELECT *,
    CASE WHEN edit_count > 1000 THEN 'High' WHEN edit_count > 100 THEN 'Medium' ELSE 'Low' END AS edit_intensity,
    CASE WHEN unique_editors > 50 THEN 'High' WHEN unique_editors > 10 THEN 'Medium' ELSE 'Low' END
      AS editor_diversity
  FROM top_pages
)"""

FLAT_COLUMNS = (
    'id, "type", namespace, title, title_url, "comment", "timestamp", "user", bot, minor, patrolled, '
    "length_old, length_new, revision_old, revision_new, server_url, server_name, server_script_path, "
    "wiki, parsedcomment, meta_uri, meta_request_id, meta_id, meta_dt, meta_domain, meta_stream, "
    "meta_topic, meta_partition, meta_offset"
)


def _with(*ctes: str) -> str:
    return "WITH" + ",".join(ctes) + "\n"


def _report(table: str, source: str, rules: list[tuple[str, str, str]]) -> str:
    """Rule report rows: (table_name, rule, action, n_rows, n_failed)."""
    parts = []
    for name, action, predicate in rules:
        parts.append(
            f"SELECT '{table}' AS table_name, '{name}' AS rule, '{action}' AS action, "
            f"CAST(COUNT(*) AS BIGINT) AS n_rows, "
            f"CAST(COUNT(*) FILTER (WHERE NOT coalesce({predicate}, false)) AS BIGINT) AS n_failed FROM {source}"
        )
    return "\nUNION ALL\n".join(parts)


LANDING_RULE_SQL = [("valid_id", "drop", "id IS NOT NULL"), ("valid_timestamp", "drop", '"timestamp" IS NOT NULL')]
CLEAN_RULE_SQL = [
    ("valid_editor", "drop", "editor IS NOT NULL"),
    ("valid_page_title", "drop", "page_title IS NOT NULL"),
    ("valid_event_timestamp", "drop", "event_timestamp IS NOT NULL"),
]
EDITOR_RANKING_RULE_SQL = [
    ("valid_total_edits", "drop", "total_edits > 0"),
    ("valid_editor", "drop", "editor IS NOT NULL"),
    ("valid_wiki_language", "drop", "wiki_language IS NOT NULL"),
    ("valid_last_edit_time", "drop", "last_edit_time IS NOT NULL"),
]
PAGE_RANKING_RULE_SQL = [("valid_edit_count", "drop", "edit_count > 0")]


def _sql() -> dict[str, str]:
    base = _with(RAW, LANDED, CLEAN)
    flat_landed = _with(RAW, LANDED) + f"SELECT {FLAT_COLUMNS} FROM landed"
    flat_raw = _with(RAW) + f"SELECT {FLAT_COLUMNS} FROM raw"
    q: dict[str, str] = {}
    q["landed_edits"] = flat_landed
    q["landed_stream"] = flat_landed
    q["json_lines_roundtrip"] = flat_landed
    q["feed_capture_events"] = flat_raw
    q["feed_capture_limit"] = _with(RAW) + f"SELECT {FLAT_COLUMNS} FROM raw ORDER BY meta_offset LIMIT 15"
    q["feed_capture_rejects"] = (
        "SELECT 'data: {\"broken\": ' || CAST(event_id AS VARCHAR) AS line FROM events WHERE event_id % 50 = 0"
    )
    q["edits_clean"] = base + "SELECT * FROM clean"
    q["edits_clean_unchecked"] = _with(RAW, CLEAN_UNCHECKED) + "SELECT * FROM clean_unchecked"
    q["edit_size_change"] = base + "SELECT id, old_length, new_length, length_change FROM clean"
    q["edit_metadata"] = base + (
        "SELECT id, meta_uri, meta_request_id, meta_domain, meta_stream, meta_topic, meta_partition, "
        "meta_offset FROM clean"
    )
    q["hourly_activity"] = _with(RAW, LANDED, CLEAN, HOURLY) + "SELECT * FROM hourly"
    q["daily_unique_editors"] = _with(RAW, LANDED, CLEAN) + (
        "SELECT date_trunc('day', CAST(event_timestamp AS TIMESTAMP)) AS \"day\", wiki_language, is_bot_edit, "
        "COUNT(DISTINCT editor) AS unique_editors FROM clean GROUP BY 1, 2, 3 HAVING COUNT(editor) > 0"
    )
    q["hourly_activity_ordered"] = (
        _with(RAW, LANDED, CLEAN, HOURLY)
        + 'SELECT * FROM hourly ORDER BY "hour", wiki_language NULLS FIRST, is_bot_edit NULLS FIRST'
    )
    q["editor_ranking"] = _with(RAW, LANDED, CLEAN, TOP_EDITORS) + "SELECT * FROM top_editors"
    q["editor_ranking_unchecked"] = (
        _with(RAW, CLEAN_UNCHECKED, TOP_EDITORS_UNCHECKED) + "SELECT * FROM top_editors_unchecked"
    )
    q["page_ranking"] = _with(RAW, LANDED, CLEAN, TOP_PAGES) + "SELECT * FROM top_pages"
    q["editor_profile"] = _with(RAW, LANDED, CLEAN, TOP_EDITORS, EDITOR_PROFILE) + "SELECT * FROM editor_profile"
    q["page_profile"] = _with(RAW, LANDED, CLEAN, TOP_PAGES, PAGE_PROFILE) + "SELECT * FROM page_profile"
    q["editor_type_mix"] = _with(RAW, LANDED, CLEAN, TOP_EDITORS, EDITOR_PROFILE) + (
        "SELECT editor_type, COUNT(*) AS n_rows FROM editor_profile GROUP BY editor_type"
    )
    stats_editors = base + EDITOR_STATS_SELECT.format(source="clean")
    stats_pages = base + PAGE_STATS_SELECT.format(source="clean")
    q["agg_row_count"] = f"SELECT editor, wiki_language, total_edits FROM ({stats_editors}) s"
    q["agg_mean_change"] = f"SELECT editor, wiki_language, avg_length_change FROM ({stats_editors}) s"
    q["agg_distinct_pages"] = f"SELECT editor, wiki_language, pages_edited FROM ({stats_editors}) s"
    q["agg_time_bounds"] = (
        f"SELECT page_title, wiki_language, first_edit_time, last_edit_time FROM ({stats_pages}) s"
    )
    q["agg_conditional_counts"] = f"SELECT page_title, wiki_language, bot_edits, minor_edits FROM ({stats_pages}) s"
    q["rule_drop_report"] = _with(RAW, LANDED, CLEAN_INPUT, CLEAN, TOP_EDITORS_CUT, TOP_PAGES_CUT) + "\nUNION ALL\n".join(
        [
            _report("edits_raw", "raw", LANDING_RULE_SQL),
            _report("edits_clean", "clean_input", CLEAN_RULE_SQL),
            _report("editor_ranking", "top_editors_cut", EDITOR_RANKING_RULE_SQL),
            _report("page_ranking", "top_pages_cut", PAGE_RANKING_RULE_SQL),
        ]
    )
    q["rule_warn_report"] = _with(
        RAW, LANDED, CLEAN, HOURLY, TOP_EDITORS, TOP_PAGES, EDITOR_PROFILE, PAGE_PROFILE
    ) + "\nUNION ALL\n".join(
        [
            _report("hourly_activity", "hourly", [("positive_edit_count", "warn", "edit_count > 0")]),
            _report(
                "editor_profile", "editor_profile", [("non_negative_activity_span", "warn", "activity_span_days >= 0")]
            ),
            _report("page_profile", "page_profile", [("positive_unique_editors", "warn", "unique_editors > 0")]),
        ]
    )
    q["rule_config_report"] = _with(RAW) + _report(
        "edits_raw",
        "raw",
        [
            ("wikipedia_edits_not_null", "warn", "id IS NOT NULL"),
            ("wikipedia_edits_timestamp_valid", "warn", '"timestamp" BETWEEN 0 AND 9999999999999'),
        ],
    )
    q["layer_table_counts"] = _with(
        RAW, LANDED, CLEAN, HOURLY, TOP_EDITORS, TOP_PAGES, EDITOR_PROFILE, PAGE_PROFILE
    ) + "\nUNION ALL\n".join(
        f"SELECT '{name}' AS table_name, CAST(COUNT(*) AS BIGINT) AS n_rows FROM {cte}"
        for name, cte in [
            ("edits_raw", "landed"),
            ("edits_clean", "clean"),
            ("hourly_activity", "hourly"),
            ("editor_ranking", "top_editors"),
            ("page_ranking", "top_pages"),
            ("editor_profile", "editor_profile"),
            ("page_profile", "page_profile"),
        ]
    )
    # built in two arrival waves; the final tables equal a single run's
    q["layer_incremental_counts"] = q["layer_table_counts"]
    q["layer_incremental_hourly"] = q["hourly_activity"]
    q["layer_incremental_editor_profile"] = q["editor_profile"]
    q["layer_incremental_page_profile"] = q["page_profile"]
    # the first run sees the even events; in the second the others land, and every other table is made of all
    reports = [
        ("edits_clean", "clean_input", CLEAN_RULE_SQL),
        ("hourly_activity", "hourly", [("positive_edit_count", "warn", "edit_count > 0")]),
        ("editor_ranking", "top_editors_cut", EDITOR_RANKING_RULE_SQL),
        ("page_ranking", "top_pages_cut", PAGE_RANKING_RULE_SQL),
        ("editor_profile", "editor_profile", [("non_negative_activity_span", "warn", "activity_span_days >= 0")]),
        ("page_profile", "page_profile", [("positive_unique_editors", "warn", "unique_editors > 0")]),
    ]
    chain = (LANDED, CLEAN_INPUT, CLEAN, HOURLY, TOP_EDITORS_CUT, TOP_PAGES_CUT, TOP_EDITORS, TOP_PAGES, EDITOR_PROFILE, PAGE_PROFILE)
    every = RAW.replace("raw AS (", "every AS (", 1)
    runs = []
    for run, (seen, new) in enumerate([("meta_offset % 2 = 0", "TRUE"), ("TRUE", "meta_offset % 2 = 1")], 1):
        waves = f"\nraw AS (SELECT * FROM every WHERE {seen}),\nfresh AS (SELECT * FROM raw WHERE {new})"
        tables = "\nUNION ALL\n".join(_report(*r) for r in [("edits_raw", "fresh", LANDING_RULE_SQL), *reports])
        runs.append(f"SELECT CAST({run} AS BIGINT) AS run, r.* FROM (\n{_with(every, waves, *chain)}{tables}\n) r")
    q["rule_history"] = "\nUNION ALL\n".join(runs)
    return q


ORACLE_SQL: dict[str, str] = _sql()
