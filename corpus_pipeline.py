"""The corpus pipeline: language, near duplicates, personal data, mixture, encoding.

Each stage takes (spark, docs, sf_dir) and works on all that the one before
kept; all but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from editflow.llm import jaccard, langid, mixing, pieces, pii
from editflow.llm.common import pick, stored


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that was learned; those without a letter (``und``) go.

    That is null and empty texts, and texts without a letter. Repeated rows are each
    judged, alike; rows without an id are judged as others and teach nothing. Where no document has a
    language to learn, all go; an empty table stays empty.
    """
    names = {c: f"c{i}" for i, c in enumerate(docs.columns)}  # they may be named like the operator's own
    rest = [new for c, new in names.items() if c != "doc_id"]
    found = langid.identify(
        pick(docs, **{new: c for c, new in names.items()}), langid.learn(docs.where(~langid.held_out())), names["text"], names["doc_id"], rest
    )
    found = found.where(F.col("lang_pred") != langid.UNKNOWN)
    return found.select(*(F.col(new).alias(c) for c, new in names.items()))


def one_text_each(docs: DataFrame) -> DataFrame:
    """One row for each id: of several, that of the smallest text (null first), then of the smallest other columns.

    Rows without an id all stay. Only ids are looked at where none is repeated; else the smallest row is found
    before rows meet, so a frequent id is one row a task.
    """
    if docs.where(F.col("doc_id").isNotNull()).groupBy("doc_id").count().where(F.col("count") > 1).isEmpty():
        return docs
    rest = [c for c in docs.columns if c not in ("doc_id", "text")]
    row = F.struct(F.col("text").alias("c0"), *(F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(rest, 1)))
    least = docs.where(F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.min(row).alias("row"))
    back = {"doc_id": "doc_id", "text": "row.c0", **{c: f"row.c{i}" for i, c in enumerate(rest, 1)}}
    named = least.select(*(F.col(back[c]).alias(c) for c in docs.columns))
    return stored(named.unionByName(docs.where(F.col("doc_id").isNull())), "one_text_each")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates, that of the smallest id.

    An id names one document: of rows that share one, ``one_text_each`` keeps a single one first, so repeated
    rows leave one. Rows without an id all stay, and so do null texts and texts without a word, which are like no other. An
    empty table stays empty.
    """
    docs = one_text_each(docs)
    gone = jaccard.jaccard_join(docs).where(~F.col("kept")).select("doc_id")
    named = docs.where(F.col("doc_id").isNotNull()).join(gone, "doc_id", "left_anti")
    return named.select(*(F.col(f"`{c}`") for c in docs.columns)).unionByName(docs.where(F.col("doc_id").isNull()))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, with its personal data masked and ``n_chars`` counted anew.

    Null texts stay null (and have null characters), empty ones empty; repeated rows stay, masked alike. Rows
    without an id get the base patterns only. An empty table stays empty.
    """
    return pii.mask(docs).withColumn("n_chars", F.length("text").cast("long"))


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents as often as the mixture of their sources takes them, in blocks.

    A null source is a source; null and empty texts have no token and come as often as their source's others, in whole passes
    and one more. Equal rows are taken alike and spread over the blocks. An empty table stays empty.
    """
    return mixing.mix(docs)


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, ids) of every row: each copy of a document that the mixture took.

    Null and empty texts have no ids; rows without an id keep a null one; repeated rows are each encoded. An empty table gives no rows.
    """
    return pieces.encode(docs)


STAGES = [
    ("language", language),
    ("near_duplicates", near_duplicates),
    ("personal_data", personal_data),
    ("mixture", mixture),
    ("encoding", encoding),
]

#: SQL can express neither the trained models nor the bootstrapped patterns; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written as Parquet and read again by the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
