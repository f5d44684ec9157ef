"""Layer tables: where each table lives, how it is written and read back.

Tables are stored by path, ``<base>/<layer>/<name><suffix>``, in a columnar
format (Parquet unless told otherwise), so every read prunes columns and
pushes filters into the scan.  A table is replaced as a whole: the new rows go
to a folder of their own and are switched in when they are finished (see
:mod:`editflow.sources.builds`).  ``register=True`` additionally records the
table and its comment in the session catalog under a database per layer.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from editflow.operators import rules as R
from editflow.sources import builds


@dataclass(frozen=True)
class TableSpec:
    name: str
    layer: str
    comment: str
    rules: tuple


# Layer of each table, its description and its rules (in build order).
TABLES = (
    TableSpec("edits_raw", "landing", "Raw edit events as landed from JSON-lines files", R.LANDING_RULES),
    TableSpec("edits_clean", "bronze", "Flattened, renamed and typed edit events", R.CLEAN_RULES),
    TableSpec("hourly_activity", "bronze", "Edits per hour, wiki and bot flag", R.HOURLY_RULES),
    TableSpec("editor_ranking", "silver", "Editors with the most edits", R.EDITOR_RANKING_RULES),
    TableSpec("page_ranking", "silver", "Pages with the most edits", R.PAGE_RANKING_RULES),
    TableSpec("editor_profile", "gold", "Activity span, rate and class of the top editors", R.EDITOR_PROFILE_RULES),
    TableSpec("page_profile", "gold", "Intensity and editor diversity of the top pages", R.PAGE_PROFILE_RULES),
)
TABLE_BY_NAME = {spec.name: spec for spec in TABLES}
LAYERS = ("landing", "bronze", "silver", "gold")


def table_path(base_dir: str, name: str, suffix: str = "") -> str:
    spec = TABLE_BY_NAME[name]
    return f"{base_dir.rstrip('/')}/{spec.layer}/{spec.name}{suffix}"


def write_table(
    df: DataFrame,
    base_dir: str,
    name: str,
    suffix: str = "",
    fmt: str = "parquet",
    register: bool = False,
    namespace: str | None = None,
    upstream: dict[str, str] | None = None,
    rules: Callable[[], list[dict]] = list,
) -> str:
    """Replace the table's contents with ``df`` (a full recompute); returns the folder of the build.

    Readers see the old rows until all new ones are written, and then the new
    ones. ``rules`` is asked for the rule counters after the write; they and the
    builds of ``upstream`` are stored in the note that switches the table.
    """
    spark, root, build = df.sparkSession, table_path(base_dir, name, suffix), builds.new_build()
    path = builds.folder(root, build)
    df.write.format(fmt).save(path)
    counters = [{k: v for k, v in row.items() if k != "table_name"} for row in rules()]
    builds.publish(spark, root, build, table_name=name, upstream=upstream or {}, rules=counters)
    if register:
        register_table(spark, base_dir, name, suffix, fmt, path, namespace)
    builds.clean(spark, root)
    return path


def read_table(
    spark: SparkSession,
    base_dir: str,
    name: str,
    suffix: str = "",
    fmt: str = "parquet",
    schema: StructType | None = None,
) -> DataFrame:
    """The present build of the table, an error where there is none; with ``schema`` nothing is inferred."""
    reader = spark.read.format(fmt)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.load(builds.required(spark, table_path(base_dir, name, suffix)).path)


def register_table(
    spark: SparkSession,
    base_dir: str,
    name: str,
    suffix: str = "",
    fmt: str = "parquet",
    path: str | None = None,
    namespace: str | None = None,
    where: str | None = None,
) -> str:
    """Record the stored table in the catalog as ``<namespace or layer>.<name><suffix>`` with its comment.

    The entry is a view of the folder of the present build. When the table is
    registered again, the view is changed in place, so the name never
    disappears; partition folders give partition columns, and ``where`` is pushed to them.
    """
    spec = TABLE_BY_NAME[name]
    space, entry = namespace or spec.layer, f"{spec.name}{suffix}"
    qualified = f"`{space}`.`{entry}`"
    path = path or builds.required(spark, table_path(base_dir, name, suffix)).path
    query = f"SELECT * FROM {fmt}.`{path}`" + (f" WHERE {where}" if where else "")
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{space}`")
    if spark.catalog.tableExists(qualified):
        if spark.catalog.getTable(qualified).tableType == "VIEW":
            spark.sql(f"ALTER VIEW {qualified} AS {query}")
            return f"{space}.{entry}"
        spark.sql(f"DROP TABLE {qualified}")  # an entry of another kind, made by hand
    comment = spec.comment.replace("'", "''")
    spark.sql(f"CREATE VIEW {qualified} COMMENT '{comment}' AS {query}")
    return f"{space}.{entry}"


def rule_history(spark: SparkSession, base_dir: str, suffix: str = "") -> DataFrame:
    """Rule counters of every finished build of every table under ``base_dir``.

    (table_name, run, build, finished_at, rule, action, n_rows, n_failed);
    ``run`` numbers a table's builds (for the landed table: the runs that landed into it).
    """
    roots = [table_path(base_dir, spec.name, suffix) for spec in TABLES]
    return builds.history(spark, [roots[0] + "/*", *roots[1:]])
