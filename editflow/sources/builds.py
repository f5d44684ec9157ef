"""Builds of a table: each is written to a folder of its own, and one small file switches readers to it.

    <table>/build-<id>/...                  the rows of a build
    <table>/_builds/<number>-<id>.json      one line: the build, what it was made from, its rule counters
    <table>/_builds/past/...                notes beyond the last hundred

The folder is written first and the note last, under its final name by one
rename of one file. So a build without a note was never finished: nobody reads
it, whatever it holds, and the next run removes it. The note with the greatest
number is the table's present state. The builds of the last two notes stay, for readers
that began before the switch; the notes of all runs stay, as the table's history.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from editflow.sources import files

NOTES = "_builds"
FOLDER = "build-"
#: Builds of so many of the last notes are kept.
KEPT_NOTES = 2
#: Older notes move to a folder that only the history reads, so looking up the present build stays cheap.
RECENT_NOTES = 100
NOTE_SCHEMA = (
    "table_name string, build string, finished_at string, upstream map<string,string>, upto bigint, "
    "rules array<struct<rule:string,action:string,n_rows:bigint,n_failed:bigint>>"
)


class UnfinishedBuild(RuntimeError):
    """A table that was never finished, or tables that were not made from the same build."""


@dataclass(frozen=True)
class Build:
    root: str
    number: int
    build: str

    @property
    def path(self) -> str:
        return f"{self.root}/{FOLDER}{self.build}"

    @property
    def note_path(self) -> str:
        return f"{self.root}/{NOTES}/{self.number:08d}-{self.build}.json"

    def note(self, spark: SparkSession) -> dict:
        return json.loads(files.read_text(spark, self.note_path))


def new_build() -> str:
    """An id of a new build; ids sort by the time they were made."""
    return datetime.now(timezone.utc).strftime("%Y%m%dT%H%M%S%f") + "-" + uuid.uuid4().hex[:8]


def folder(root: str, build: str) -> str:
    return f"{root.rstrip('/')}/{FOLDER}{build}"


def finished(spark: SparkSession, root: str) -> list[Build]:
    """All finished builds of a table, in the order of their notes (the names alone say it)."""
    root = root.rstrip("/")
    names = [n for n in files.list_names(spark, f"{root}/{NOTES}") if n[:1].isdigit() and n.endswith(".json")]
    out = []
    for name in names:
        number, build = name.removesuffix(".json").split("-", 1)
        out.append(Build(root, int(number), build))
    return sorted(out, key=lambda b: b.number)


def current(spark: SparkSession, root: str) -> Build | None:
    done = finished(spark, root)
    return done[-1] if done else None


def required(spark: SparkSession, root: str) -> Build:
    """The present build; an error where the table was never finished."""
    build = current(spark, root)
    if build is None:
        raise UnfinishedBuild(f"{root} has no finished build: run the layer that makes it first")
    return build


def unfinished(spark: SparkSession, root: str) -> list[str]:
    """Ids of folders that no note names, the oldest first."""
    noted = {b.build for b in finished(spark, root)}
    return [i for i in (n.removeprefix(FOLDER) for n in files.list_names(spark, root, FOLDER)) if i not in noted]


def publish(spark: SparkSession, root: str, build: str, **note) -> Build:
    """Switch readers to a finished folder: write its note and give it its name."""
    root = root.rstrip("/")
    last = current(spark, root)
    made = Build(root, last.number + 1 if last else 1, build)
    stamp = datetime.now(timezone.utc).isoformat(timespec="seconds")
    staged = f"{root}/{NOTES}/_{build}"
    files.write_text(spark, staged, json.dumps({"build": build, "finished_at": stamp, **note}) + "\n")
    files.rename(spark, staged, made.note_path)
    return made


def clean(spark: SparkSession, root: str) -> None:
    """Remove folders that readers no longer need: older builds, and those that were never finished."""
    done = finished(spark, root)
    for old in done[:-RECENT_NOTES]:
        files.rename(spark, old.note_path, old.note_path.replace(f"/{NOTES}/", f"/{NOTES}/past/"))
    kept = {b.build for b in done[-KEPT_NOTES:]}
    for name in files.list_names(spark, root, FOLDER):
        if name.removeprefix(FOLDER) not in kept:
            files.delete(spark, f"{root.rstrip('/')}/{name}")


def history(spark: SparkSession, roots: list[str]) -> DataFrame:
    """One row for each finished build and rule of the tables: number of the build, counters, when and from what it was made."""
    patterns = [f"{root.rstrip('/')}/{NOTES}/{past}[0-9]*.json" for root in roots for past in ("", "past/")]
    notes = [pattern for pattern in patterns if files.matches(spark, pattern)]
    if not notes:
        empty = "table_name string, run bigint, build string, finished_at string, rule string, action string, n_rows bigint, n_failed bigint"
        return spark.createDataFrame([], empty)
    rows = spark.read.schema(NOTE_SCHEMA).json(notes)
    number = F.regexp_extract(F.col("_metadata.file_name"), "^([0-9]+)-", 1).cast("bigint")
    rows = rows.select("table_name", number.alias("run"), "build", "finished_at", F.explode("rules").alias("r"))
    return rows.select("table_name", "run", "build", "finished_at", "r.rule", "r.action", "r.n_rows", "r.n_failed")
