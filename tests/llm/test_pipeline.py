"""The pipeline's stages one after another, against what each must keep and change."""

from __future__ import annotations

from pyspark.sql import functions as F

import corpus_pipeline
from editflow.llm import pieces
from editflow.llm.common import stored
from tests.conftest import SF0001
from tests.llm.test_operators import DOCS, brute_pii, odd_rows, shingles


def test_stages_on_documents(spark):
    docs = spark.read.parquet(f"{SF0001}/documents.parquet")
    columns, at = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES:
        docs = stored(stage(spark, docs, SF0001), name)
        at[name] = docs
        assert name == "encoding" or docs.columns == columns
    given = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF0001}/documents.parquet").collect()}
    known = {r["doc_id"] for r in at["language"].collect()}
    assert known == {i for i, t in given.items() if any(c.isalpha() for c in t or "")}
    # one of each group of near duplicates, that of the smallest id
    sets = {i: shingles(given[i]) for i in known}
    root = {i: i for i in known}
    near = {i: [j for j in known if j != i and len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j])] for i in known}
    for _ in range(20):
        root = {i: min([root[i], *(root[j] for j in near[i])]) for i in known}
    assert {r["doc_id"] for r in at["near_duplicates"].collect()} == set(root.values())
    # no base pattern matches any more, and texts without personal data are as they were
    for r in at["personal_data"].collect():
        assert not brute_pii(r["text"]) and r["n_chars"] == len(r["text"])
        if not brute_pii(given[r["doc_id"]]) and "[CONTEXT]" not in r["text"]:
            assert r["text"] == given[r["doc_id"]]
    assert {r["doc_id"] for r in at["mixture"].collect()} <= set(root.values())
    texts = sorted(r["text"] for r in at["mixture"].collect())
    assert sorted(r["text"] for r in pieces.decode(at["encoding"]).collect()) == texts


def test_stages_on_odd_rows(spark):
    docs = spark.createDataFrame(odd_rows(), DOCS.replace("id long, u long", "n_chars long, u long").replace("doc_n_chars", "doc_id"))
    docs = docs.select("doc_id", "text", "lang", "source", "n_chars")
    for some in (docs, docs.limit(0)):
        for name, stage in corpus_pipeline.STAGES:
            some = stored(stage(spark, some, SF0001), name)
            some.count()


def test_stages_carry_other_columns(spark):
    docs = spark.read.parquet(f"{SF0001}/documents.parquet")
    extra = ["lang_pred", "score", "id", "kept", "found", "added", "tokens", "h", "block", "c0", "carried0", "a b"]
    docs = docs.select(*docs.columns, *(F.concat(F.col("doc_id").cast("string"), F.lit(c)).alias(c) for c in extra))
    columns, n = docs.columns, docs.count()
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stored(stage(spark, docs, SF0001), name)
        assert docs.columns == columns
        same = [F.col(f"`{c}`") == F.concat(F.col("doc_id").cast("string"), F.lit(c)) for c in extra]
        assert docs.where(~F.array_min(F.array(*same))).count() == 0
        assert n / 2 < docs.count() < 2 * n
    assert corpus_pipeline.STAGES[-1][1](spark, docs, SF0001).count() == docs.count()


def test_run(spark):
    assert corpus_pipeline.run(spark, SF0001).columns == ["doc_id", "ids"]


def test_near_duplicates_of_repeated_ids(spark):
    """Of rows that share an id the one of the smallest text stays; rows without an id all stay."""
    from tests.llm.test_operators import prose

    a, b, c = prose(40, 1), prose(40, 2), prose(40, 3)
    rows = [(1, b, "en", "s", 1), (1, a, "en", "s", 2), (1, a, "de", "s", 2), (2, max(a, b), "en", "s", 3), (3, c, "en", "s", 4), (3, c, "en", "s", 4)]
    rows += [(4, None, "en", "s", 0), (4, "", "en", "s", 0), (None, a, "en", "s", 5), (None, a, "en", "s", 5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    got = sorted(map(repr, map(tuple, corpus_pipeline.near_duplicates(spark, docs, SF0001).collect())))
    kept = [(1, min(a, b), "de" if a < b else "en", "s", 2 if a < b else 1), (2, max(a, b), "en", "s", 3), (3, c, "en", "s", 4), (4, None, "en", "s", 0)]
    assert got == sorted(map(repr, [*kept, (None, a, "en", "s", 5), (None, a, "en", "s", 5)]))
