from __future__ import annotations

import json
import os
import re
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from editflow.session import SESSION_DEFAULTS, ensure_checkpoint_dir, scratch_dir  # noqa: E402

SF0001 = "/root/testdata/sf0.001"
SF001 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    import tempfile

    builder = (
        SparkSession.builder.master("local[*]")
        .config("spark.sql.shuffle.partitions", "8")
        # catalog tables of the tests live outside the repository
        .config("spark.sql.warehouse.dir", tempfile.mkdtemp(prefix="editflow-warehouse-"))
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="editflow-checkpoint-"))
    )
    for key, value in SESSION_DEFAULTS.items():
        builder = builder.config(key, value)
    session = builder.getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(session)
    yield session
    session.stop()


@pytest.fixture
def workdir(spark, request):
    """A fresh folder under the session's checkpoint directory."""
    path = scratch_dir(spark, "test-" + re.sub(r"\W", "_", request.node.name[:40]))
    local = path[len("file:"):] if path.startswith("file:") else path
    os.makedirs(local, exist_ok=True)
    return local


def write_lines(directory: str, name: str, lines: list) -> str:
    """Write raw text lines (dicts are dumped as JSON) into ``directory/name``."""
    os.makedirs(directory, exist_ok=True)
    path = os.path.join(directory, name)
    with open(path, "w", encoding="utf-8") as fh:
        for line in lines:
            fh.write((json.dumps(line) if isinstance(line, dict) else line) + "\n")
    return path


def edit(id_="1", ts=1704067207999, user="User_1", title="Page_1", wiki="enwiki", old=10, new=20, **extra):
    """A landing event as a JSON-able dict."""
    event = {
        "id": id_,
        "type": "edit",
        "namespace": 0,
        "title": title,
        "timestamp": ts,
        "user": user,
        "bot": False,
        "minor": False,
        "wiki": wiki,
        "server_name": f"{wiki}.example.org" if wiki else None,
        "meta": {"uri": "u", "request_id": "r", "domain": "d", "stream": "s", "topic": "t", "partition": 1, "offset": 5},
    }
    if old is not None or new is not None:
        event["length"] = {"old": old, "new": new}
    event["revision"] = {"old": 1, "new": 2}
    event.update(extra)
    return {k: v for k, v in event.items() if v is not None}
