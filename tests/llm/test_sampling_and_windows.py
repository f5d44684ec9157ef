"""Importance resampling, benchmark decontamination and periodic runs: brute force, SQL and odd input."""

from __future__ import annotations

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from editflow.llm import decontamination, periodic, resampling
from editflow.llm.common import stored
from editflow.llm.queries import ORACLE_SQL, QUERIES, repeated_words
from tests.conftest import SF0001
from tests.llm.test_operators import DOCS, odd_rows, prose

ITEMS = "item_id long, text string, items string"


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


@pytest.mark.parametrize("name", ["op1_suffix_dedup", "op11_importance_resampling", "op12_decontamination", "op13_periodic_runs"])
def test_query_matches_sql(spark, name):
    con = duckdb.connect()
    for table in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{SF0001}/{table}.parquet')")
    got = QUERIES[name](spark, SF0001)
    res = con.execute(ORACLE_SQL[name])
    columns = [d[0] for d in res.description]
    assert sorted(columns) == sorted(got.columns)
    assert sorted(map(repr, map(tuple, got.select(*columns).collect()))) == sorted(map(repr, res.fetchall()))


# -- 11: importance resampling -------------------------------------------------

def test_joined_checksums():
    sums, rng = resampling.Checksums(), random.Random(3)
    pairs = [(rng.randbytes(rng.randint(0, 9)), rng.randbytes(n)) for n in [0, 1, 7, 63, 64, 65, 127, 128, 1000, 70_001]]
    left, right = (np.array([zlib.crc32(p[i]) for p in pairs], np.uint32) for i in (0, 1))
    assert sums.join(left, right, np.array([len(b) for _, b in pairs])).tolist() == [zlib.crc32(a + b) for a, b in pairs]


def brute_resample(rows, target, percent=5, least=20):
    def features(text):
        w = words(text)
        return [zlib.crc32(" ".join(w[i : i + n]).encode()) % 10000 for n in (1, 2, 3) for i in range(len(w) - n + 1)]

    s, t = Counter(b for _, x in rows for b in features(x)), Counter(b for x in target for b in features(x))
    ss, tt = sum(s.values()), sum(t.values())
    out = []
    for at, (i, text) in enumerate(rows):
        found = features(text)
        weight = sum(math.floor(1000 * math.log((t[b] + 1) * (ss + 10000) / ((s[b] + 1) * (tt + 10000)))) for b in found)
        h = int(hashlib.sha256(f"42:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        out.append([i, len(found), weight, score, None, len(words(text)) >= least])
    able = sorted((r for r in out if r[5]), key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    for rank, r in enumerate(able[: percent * len(able) // 100], 1):
        r[4] = rank
    return sorted((tuple(r[:5]) for r in out), key=repr)


@pytest.mark.parametrize("percent", [0, 5, 60, 100])
def test_resampling_matches_brute_force(spark, percent):
    rng = random.Random(percent)
    rows = [(i, prose(rng.randint(0, 60), i)) for i in range(180)]
    rows += [(None, prose(40, 999)), (500, None), (501, ""), (502, "ÉCOLE École " * 30), (503, "x" * 300 + " y " + prose(30, 9))]
    rows += [rows[170]] * 40 + [(None, prose(25, 4))] * 40  # repeated rows, and rows without an id
    target = [prose(50, 10), "", None]
    docs = spark.createDataFrame([(*r, 1, 1) for r in rows], "doc_id long, text string, score long, uid long").repartition(7)
    got = resampling.resample(docs, spark.createDataFrame([(x,) for x in target], "text string"), percent)
    assert got.columns == ["doc_id", "n_features", "weight", "score", "rank"]
    assert sorted(map(tuple, got.collect()), key=repr) == brute_resample(rows, target, percent)


def test_resampling_prefers_the_target(spark):
    """Of documents of two kinds, those like the target are drawn."""
    docs = spark.range(400).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 10 == 0, "alpha beta gamma " * 10).otherwise("one two three " * 10).alias("text"))
    got = resampling.resample(docs, spark.createDataFrame([("alpha beta gamma",)], "text string")).where("rank is not null")
    assert got.count() == 20 and got.where("doc_id % 10 <> 0").count() == 0


def test_last_key_by_rounds(spark):
    rng = random.Random(1)
    keys = [(rng.randint(-3, 3), rng.randint(0, 4), i) for i in range(900)]
    table = stored(spark.createDataFrame(keys, "a long, b long, c long").repartition(9), "keys")
    for most in (1, 2, 450, 899, 900):
        assert resampling.last_key(table, most) == sorted(keys)[most - 1]
    assert resampling.last_key(table, 0) is None


def test_resampling_on_odd_rows(spark):
    odd, empty = spark.createDataFrame(odd_rows(), DOCS), spark.createDataFrame([], DOCS)
    target = spark.createDataFrame([(1, "one", "x")], ITEMS)
    rows = [(r[0], r[1]) for r in odd_rows()]
    assert sorted(map(tuple, resampling.resample(odd, target, 50).collect()), key=repr) == brute_resample(rows, ["one"], 50)
    assert resampling.resample(empty, target).collect() == [] and resampling.resample(odd, empty).count() == len(rows)


# -- 12: decontamination -------------------------------------------------------

def brute_hits(text, items, size=10):
    w, hit, found = words(text), set(), set()
    for item, t in items:
        iw = words(t)
        n = min(len(iw), size)
        grams = {tuple(iw[i : i + n]) for i in range(len(iw) - n + 1)} if n else set()
        for i in range(len(w) - n + 1):
            if tuple(w[i : i + n]) in grams:
                hit |= set(range(i, i + n))
                found.add(item)
    return len(w), len(hit), sorted(str(i) for i in found if i is not None)


def some_items():
    """Items of every length from 0 to 12 words, two with the same windows, one without an id, one repeated."""
    items = [(i, prose(i, 100 + i)) for i in range(13)]
    items += [(20, prose(40, 50)), (21, "Lead, " + prose(40, 50)), (None, prose(30, 51)), (22, "É É Ü"), (23, None), (20, prose(40, 50)), (9, "1-2!")]
    return items


@pytest.mark.parametrize("broadcast_bytes", [decontamination.BROADCAST_BYTES, 2000])
def test_hits_match_brute_force(spark, broadcast_bytes):
    items, rng = some_items(), random.Random(5)
    rows = []
    for i in range(60):
        parts = [prose(rng.randint(0, 30), 1000 + i)]
        for _ in range(rng.randint(0, 4)):
            source = words(rng.choice(items)[1])
            a = rng.randint(0, max(len(source) - 5, 0))
            parts += [" ".join(source[a : a + rng.randint(1, 25)]).upper(), prose(rng.randint(0, 4), rng.random())]
        rows.append((i, ".\n".join(parts)))
    rows += [(70, None), (71, ""), (72, "É é Ü ü É É Ü"), (None, prose(40, 50)), (None, prose(40, 50)), (3, prose(30, 51) + " " + prose(30, 51))]
    docs = spark.createDataFrame([(*r, 0, 0) for r in rows], "doc_id long, text string, h long, uid long").repartition(5)
    bench = spark.createDataFrame([(*x, "z") for x in items], ITEMS)
    got = decontamination.find(docs, bench, broadcast_bytes=broadcast_bytes)
    assert got.columns == ["doc_id", "n_words", "n_hit", "spans", "items"]
    mine = sorted(((r["doc_id"], r["n_words"], r["n_hit"], r["items"]) for r in got.collect()), key=repr)
    assert mine == sorted(((i, *brute_hits(t, items)) for i, t in rows), key=repr)
    assert all(sum(s["end"] - s["start"] for s in r["spans"]) == r["n_hit"] for r in got.collect())


def test_equal_hashes_hit_nothing(spark, monkeypatch):
    """Every word and window has the same hash here: the words themselves decide."""
    monkeypatch.setattr(decontamination.F, "xxhash64", lambda *c: F.length(F.concat_ws("", *[x.cast("string") if not isinstance(x, str) else x for x in c])) * 0)
    items = [(1, prose(12, 1)), (2, prose(3, 2))]
    rows = [(1, prose(12, 1) + " " + prose(20, 8)), (2, prose(20, 9))]
    got = decontamination.find(spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"))
    assert sorted((r["doc_id"], r["n_words"], r["n_hit"], r["items"]) for r in got.collect()) == [(i, *brute_hits(t, items)) for i, t in rows]


def test_removal_of_spans_and_documents(spark):
    passage = prose(14, 77)
    rows = [(1, f"Before it, {passage.upper()}!  And after.\n"), (2, "clean Text, here"), (3, None), (1, "clean too"), (None, passage)]
    docs = spark.createDataFrame([(*r, 5) for r in rows], "doc_id long, text string, digest long")
    bench = spark.createDataFrame([(1, passage)], "item_id long, text string")
    left = decontamination.remove(docs, bench)
    assert left.columns == docs.columns
    assert sorted(map(repr, map(tuple, left.collect()))) == sorted(
        map(repr, [(1, "Before it, And after.\n", 5), (2, "clean Text, here", 5), (3, None, 5), (1, "clean too", 5), (None, "", 5)])
    )
    assert sorted(map(repr, map(tuple, decontamination.remove(docs, bench, whole=True).collect()))) == sorted(
        map(repr, [(2, "clean Text, here", 5), (3, None, 5), (1, "clean too", 5)])
    )


def test_decontamination_on_odd_rows(spark):
    odd, empty = spark.createDataFrame(odd_rows(), DOCS), spark.createDataFrame([], DOCS)
    bench = spark.createDataFrame([(1, prose(90, 2), "x"), (2, "漢字 é", "x"), (3, "x", "x")], ITEMS)
    got = sorted(((r["doc_id"], r["n_words"], r["n_hit"], r["items"]) for r in decontamination.find(odd, bench).collect()), key=repr)
    items = [(1, prose(90, 2)), (2, "漢字 é"), (3, "x")]
    assert got == sorted(((r[0], *brute_hits(r[1], items)) for r in odd_rows()), key=repr)
    assert decontamination.find(empty, bench).collect() == []
    assert decontamination.find(odd, spark.createDataFrame([], ITEMS)).where("n_hit > 0").count() == 0


def test_no_python_on_the_main_path(spark):
    docs, bench = (spark.read.parquet(f"{SF0001}/{t}.parquet") for t in ("documents", "benchmark"))
    plan = decontamination.find(docs, bench)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "InPandas" not in plan


# -- 13: periodic runs ---------------------------------------------------------

def brute_runs(ids):
    found = {}
    for q in range(1, len(ids) // 3 + 1):
        i = 0
        while i + q < len(ids):
            j = i
            while j + q < len(ids) and ids[j] == ids[j + q]:
                j += 1
            if j > i and j - i + q >= max(24, 3 * q):
                found.setdefault((i, j - i + q), q)
            i = max(j, i + 1)
    return sorted((s, n, q) for (s, n), q in found.items())


def test_runs_match_brute_force():
    rng, seen = random.Random(6), 0
    for _ in range(120):
        texts = []
        for _ in range(rng.randint(0, 6)):
            ids = []
            for _ in range(rng.randint(0, 5)):
                k, period = rng.choice([1, 2, 3, 30]), rng.choice([rng.randint(1, 15), rng.randint(10, 90)])
                block = [rng.randrange(k) for _ in range(period)]
                ids += (block * 8)[: int(period * rng.uniform(1, 7))]
            texts.append(ids)
        got = periodic.runs_of(texts)
        assert [sorted(r, key=lambda r: (r[0], r[1])) for r in got] == [brute_runs(t) for t in texts]
        assert all(r == sorted(r, key=lambda r: (r[0], r[2])) for r in got)
        seen += sum(map(len, got))
    assert seen > 300


def test_long_period_and_long_run():
    rng = random.Random(2)
    block = [rng.randrange(50) for _ in range(7001)]
    head = [60 + rng.randrange(9) for _ in range(333)]
    assert periodic.runs_of([head + block * 3 + block[:5] + [99], [1] * 100_000, []]) == [[(333, 21008, 7001)], [(0, 100_000, 1)], []]


def test_periodic_on_odd_rows(spark):
    odd, empty = spark.createDataFrame(odd_rows(), DOCS), spark.createDataFrame([], DOCS)
    got = sorted(map(repr, ((r["doc_id"], r["n_words"], len(r["runs"]), r["collapsed"]) for r in periodic.find(odd).collect())))
    expected = []
    for r in odd_rows():
        w = [x.decode() for x in (r[1] or "").encode().split()]
        runs = brute_runs(w) if len(w) < 1000 else []
        gone = {i for s, n, q in runs for i in range(s + q, s + n)}
        expected.append(repr((r[0], len(w), len(runs), " ".join(x for i, x in enumerate(w) if i not in gone))))
    assert got == sorted(expected) and any("2, 1, " in e or ", 1, '" in e for e in expected)
    assert periodic.find(empty).collect() == [] and "lang" in periodic.find(odd, also=("lang",)).columns
    texts = spark.createDataFrame([(None, None), (None, "a b"), (1, None), (2, " ")], "doc_id long, text string")
    assert [tuple(r) for r in repeated_words(texts).collect()] == [(None, None), (None, "a b"), (1, None), (2, " ")]


def test_greatest_run_is_exact(spark):
    """71 / 23 is more than 105 / 35, and of equal fractions the first run counts."""
    rng = random.Random(8)
    block = lambda n, of: [f"{of}{rng.randrange(9)}{i}" for i in range(n)]
    a, b, c = block(35, "a"), block(23, "b"), block(23, "c")
    text = " ".join([*a * 3, "x", *b * 3, *b[:2], "y", *c * 3, *c[:2], "z"])
    best = periodic.find(spark.createDataFrame([(1, text)], "doc_id long, text string")).first()["best"]
    assert tuple(best) == (106, 71, 23)
