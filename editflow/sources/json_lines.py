"""JSON-lines edit files: batch reader, streaming reader and writer.

Reader contract: explicit schema (no inference, an empty folder still has
a schema), one object per line (``multiLine=false`` keeps files splittable),
PERMISSIVE mode (a malformed line becomes an all-NULL row, which the landing
rules then drop) and a file-name glob so foreign files are ignored.
"""

from __future__ import annotations

import uuid
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession

from editflow.sources import files
from editflow.sources.schema import edit_event_schema

# Producer file naming and the landing glob that matches it.
FILE_STEM = "wiki_edits"
LANDING_GLOB = "wiki_edits_*.json"
STAMP_FORMAT = "%Y%m%d_%H%M%S"
# The file source forgets files older than this against the newest one: never, so late files still land.
MAX_FILE_AGE = "36500d"


def _options() -> dict[str, str]:
    return {"multiLine": "false", "mode": "PERMISSIVE"}


def _matching(path: str, glob: str | None) -> str:
    """Files of the folder that match, and the files in folders of a matching name."""
    return f"{path.rstrip('/')}/{glob}" if glob else path


def read_edit_files(
    spark: SparkSession, path: str, glob: str | None = LANDING_GLOB, wide_ids: bool = False
) -> DataFrame:
    """Batch read of landed JSON-lines files under ``path``.

    With the explicit schema an existing but empty folder reads as an empty
    table; only a missing folder needs the fallback.
    """
    schema = edit_event_schema(wide_ids)
    matching = _matching(path, glob)
    if not files.matches(spark, matching):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).options(**_options()).json(matching)


def stream_edit_files(
    spark: SparkSession,
    path: str,
    glob: str | None = LANDING_GLOB,
    wide_ids: bool = False,
    max_files_per_trigger: int | None = None,
    archive_dir: str | None = None,
) -> DataFrame:
    """Streaming read: each new matching file is processed exactly once."""
    reader = spark.readStream.schema(edit_event_schema(wide_ids)).options(**_options()).option("maxFileAge", MAX_FILE_AGE)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    if archive_dir:
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive_dir)
    return reader.json(_matching(path, glob))


def capture_stamp(when: datetime | None = None) -> str:
    return (when or datetime.now(timezone.utc)).strftime(STAMP_FORMAT)


def write_json_lines(
    df: DataFrame, directory: str, stem: str = FILE_STEM, stamp: str | None = None, run_id: str | None = None
) -> list[str]:
    """Write typed rows as JSON lines into files ``<directory>/<stem>_<stamp>_<run>-<part>.json``."""
    return _publish(df, "json", directory, stem, stamp, run_id)


def write_text_lines(
    df: DataFrame, directory: str, stem: str = FILE_STEM, stamp: str | None = None, run_id: str | None = None
) -> list[str]:
    """Write a one-string-column DataFrame line by line under the same naming."""
    return _publish(df, "text", directory, stem, stamp, run_id)


def _publish(df: DataFrame, fmt: str, directory: str, stem: str, stamp: str | None, run_id: str | None) -> list[str]:
    """Write a batch into a staging folder, decide it by one written list, and give its files their names.

    - Nothing of a staging folder matches the readers' glob, so a run that dies while it writes left nothing to read.
    - When all files are written, a list of them gets its name by one rename. From then on the batch is these files: a
      retry under the same stamp and ``run_id`` computes nothing, it names what is left to be named.
    - Each file is renamed on its own, so readers see whole files only, also in stores that rename by copying. A copy
      that was finished is not made again; one that was not is made again from the staged file.

    The list stays and says that the batch is published, so a later retry adds no rows either.
    """
    spark = df.sparkSession
    stamp, run_id = stamp or capture_stamp(), run_id or uuid.uuid4().hex[:12]
    directory = directory.rstrip("/")
    batch, staging = f"{stem}_{stamp}_{run_id}", f"{directory}/_staging_{stamp}_{run_id}"
    decided = f"{directory}/_batches/{batch}.list"
    if not files.exists(spark, decided):
        df.write.format(fmt).option("compression", "none").mode("overwrite").save(staging)
        parts = files.list_names(spark, staging, "part-")
        files.write_text(spark, f"{decided}-written", "\n".join(parts))
        files.rename(spark, f"{decided}-written", decided)
    parts = files.read_text(spark, decided).split("\n")
    named = [(part, f"{directory}/{batch}-{k:05d}.json") for k, part in enumerate(parts) if part]
    if files.exists(spark, staging):  # else all of them have their names
        for part, target in named:
            if files.exists(spark, f"{staging}/{part}"):
                files.replace(spark, f"{staging}/{part}", target)
        files.delete(spark, staging)
    return [target for _, target in named]
