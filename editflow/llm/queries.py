"""The registered queries of the training-data operators, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import decontamination, jaccard, langid, mixing, periodic, pieces, pii, resampling, secret_scan, suffix_dedup, topk, urls, vectors


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def joined_spans(found: Column, kinds: tuple[str, ...] | None = None) -> Column:
    """``kind:start:end`` of each span, comma-joined."""
    some = F.filter(found, lambda s: s["kind"].isin(*kinds)) if kinds else found
    return F.array_join(F.transform(some, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def _of_kind(kind: str) -> Column:
    return F.filter("found", lambda s: s["kind"] == kind)


def span_digest(df: DataFrame, kinds: tuple[str, ...]) -> DataFrame:
    """Counts of the base kinds, the digest of their spans, and all spans."""
    counts = [F.size(_of_kind(k)).cast("long").alias(f"n_{k}") for k in kinds]
    base = F.sha2(joined_spans(F.col("found"), kinds).cast("binary"), 256)
    return df.select("doc_id", *counts, base.alias("base_sha256"), joined_spans(F.col("found")).alias("spans"))


def op1_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = suffix_dedup.remove_repeats(_table(spark, sf_dir, "documents"))
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return done.select(
        "doc_id", "n_bytes", removed.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256")
    )


def op2_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectors.near_duplicates(_table(spark, sf_dir, "embeddings"))


def op3_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return span_digest(pii.find(_table(spark, sf_dir, "documents")), ("email", "ip", "card", "phone"))


def op4_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every copy of a document that the mixture takes, with its block and its position there."""
    return mixing.deal(_table(spark, sf_dir, "documents"))


def op5_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(_table(spark, sf_dir, "embeddings"), F.col("id") % 20 == 0)


def op6_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return span_digest(secret_scan.scan(docs, secret_scan.train(docs)), ("assign", "access", "hex"))


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    samples = langid.learn(docs.where(~langid.held_out()))
    found = langid.identify(docs, samples)
    return found.select("doc_id", langid.held_out().alias("held_out"), "lang_pred", "score")


def op8_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.jaccard_join(_table(spark, sf_dir, "documents"))


def op9_piece_encoding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every document, digested, and the digest of the text that they decode to."""
    back = pieces.decode(pieces.encode(_table(spark, sf_dir, "documents")))
    return back.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_ids"),
        F.sha2(F.array_join("ids", ",").cast("binary"), 256).alias("ids_sha256"),
        F.length("text").cast("long").alias("n_chars"),
        F.sha2(F.col("text").cast("binary"), 256).alias("text_sha256"),
    )


def op10_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.filter_urls(_table(spark, sf_dir, "pages"))


def op11_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resampling.resample(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op12_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontamination.find(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    digest = F.sha2(F.array_join("items", ",").cast("binary"), 256)
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), digest.alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def repeated_words(docs: DataFrame) -> DataFrame:
    """The documents, those of a tenth of the ids (by hash) with a part of their words repeated to the end; null ids stay as they are."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    words = F.filter(F.split("text", "[\\x20\\x09-\\x0D]+"), lambda w: w != "")
    docs = docs.select("doc_id", "text", F.floor(h / 10).alias("g"), F.when(h % 10 == 0, words).alias("words"))
    docs = docs.withColumn("n", F.size("words")).withColumn("a", F.when(F.col("n") > 0, F.col("g") % F.col("n")))
    docs = docs.withColumn("p", 1 + F.floor((F.col("n") - F.col("a")) / (3 + F.col("g") % 8)))
    place = lambda i: F.when(i < F.col("a"), i).otherwise(F.col("a") + (i - F.col("a")) % F.col("p")).cast("int")
    repeated = F.array_join(F.transform(F.sequence(F.lit(0), F.col("n") - 1), lambda i: F.get("words", place(i))), " ")
    return docs.select("doc_id", F.when(F.col("n") > 0, repeated).otherwise(F.col("text")).alias("text"))


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic.find(repeated_words(_table(spark, sf_dir, "documents")))
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    return found.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length", "best.period",
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(F.array_join(lines, "").cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_suffix_dedup": op1_suffix_dedup,
    "op2_embedding_near_dedup": op2_embedding_near_dedup,
    "op3_pii": op3_pii,
    "op4_source_mixing": op4_source_mixing,
    "op5_exact_topk": op5_exact_topk,
    "op6_secret_scan": op6_secret_scan,
    "op7_language_id": op7_language_id,
    "op8_jaccard_join": op8_jaccard_join,
    "op9_piece_encoding": op9_piece_encoding,
    "op10_url_filter": op10_url_filter,
    "op11_importance_resampling": op11_importance_resampling,
    "op12_decontamination": op12_decontamination,
    "op13_periodic_runs": op13_periodic_runs,
}

# The checksum of each half byte (polynomial 0xEDB88320).
_HALF_BYTES = (
    0x00000000, 0x1DB71064, 0x3B6E20C8, 0x26D930AC, 0x76DC4190, 0x6B6B51F4, 0x4DB26158, 0x5005713C,
    0xEDB88320, 0xF00F9344, 0xD6D6A3E8, 0xCB61B38C, 0x9B64C2B0, 0x86D3D2D4, 0xA00AE278, 0xBDBDF21C,
)


def _crc32(text: str) -> str:
    """DuckDB has no crc32: the half bytes of the UTF-8 text, the lower ones first, through the table."""
    hexed = f"hex(encode({text}))"
    halves = f"list_transform(range(1, length({hexed}) + 1), lambda i: instr('0123456789ABCDEF', substr({hexed}, xor(i - 1, 1) + 1, 1)) - 1)"
    step = f"xor(c >> 4, ({list(_HALF_BYTES)}::BIGINT[])[(xor(c, x) & 15) + 1])"
    return f"xor(list_reduce(list_prepend(4294967295::BIGINT, {halves}::BIGINT[]), lambda c, x: {step}), 4294967295)"


def _words(table: str, key: str) -> str:
    folded = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    parts = f"regexp_split_to_array({folded}, '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"
    return f"SELECT {key}, list_filter({parts}, lambda x: x <> '') AS w FROM {table}"


def _features(words: str, key: str) -> str:
    runs = [f"list_transform(range(1, len(w) - {n - 2}), lambda i: array_to_string(w[i:i+{n - 1}], ' '))" for n in (2, 3)]
    return f"SELECT {key}, unnest(list_concat(w, {runs[0]}, {runs[1]})) AS f FROM {words}"


ORACLE_SQL: dict[str, str] = {
    "op1_suffix_dedup": """
WITH bytes AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
chunks AS (SELECT doc_id, 256 * k AS base, substr(h, 512 * k + 1, 710) AS part FROM bytes, unnest(range(0, (length(h) // 2 + 255) // 256)) t(k)),
places AS (SELECT doc_id, base, part, unnest(range(0, least(256, length(part) // 2 - 99))) AS j FROM chunks),
windows AS (
  SELECT doc_id, base + j AS p, row_number() OVER (PARTITION BY hash(substr(part, 2 * j + 1, 200)) ORDER BY doc_id, base + j) AS k FROM places
),
later AS (
  SELECT doc_id, p, CASE WHEN p - lag(p) OVER (PARTITION BY doc_id ORDER BY p) <= 100 THEN 0 ELSE 1 END AS fresh
  FROM windows WHERE k > 1
), runs AS (SELECT doc_id, p, sum(fresh) OVER (PARTITION BY doc_id ORDER BY p) AS run FROM later),
spans AS (SELECT doc_id, min(p) AS a, max(p) + 100 AS e FROM runs GROUP BY doc_id, run),
between_spans AS (SELECT doc_id, a, e, lag(e, 1, 0) OVER (PARTITION BY doc_id ORDER BY a) AS b FROM spans),
cut AS (
  SELECT x.doc_id, sum(e - a) AS n_removed, count(*) AS n_spans,
    string_agg(substr(h, 2 * b + 1, 2 * (a - b)), '' ORDER BY a) || substr(any_value(h), 2 * max(e) + 1) AS kept
  FROM between_spans x JOIN bytes USING (doc_id) GROUP BY x.doc_id
)
SELECT doc_id, length(h) // 2 AS n_bytes, coalesce(n_removed, 0)::BIGINT AS n_removed, coalesce(n_spans, 0) AS n_spans,
  sha256(unhex(coalesce(kept, h))) AS kept_sha256
FROM bytes LEFT JOIN cut USING (doc_id)
""",
    "op8_jaccard_join": """
WITH RECURSIVE words AS (
  SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '\\s+'), lambda x: x <> '') AS w FROM documents
), shingles AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i+4], ' ')) END) AS s FROM words
), sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
common AS (
  SELECT a.doc_id AS u, b.doc_id AS v, count(*) AS c FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id <> b.doc_id
  GROUP BY a.doc_id, b.doc_id
), links AS (
  SELECT u, v FROM common JOIN sizes x ON x.doc_id = u JOIN sizes y ON y.doc_id = v WHERE 5 * c >= 4 * (x.n + y.n - c)
), reach AS (
  SELECT doc_id AS id, doc_id AS root FROM documents
  UNION
  SELECT links.v, reach.root FROM reach JOIN links ON reach.id = links.u
), roots AS (SELECT id, min(root) AS root FROM reach GROUP BY id),
counts AS (SELECT u, count(*) AS n FROM links GROUP BY u)
SELECT d.doc_id, r.root AS class_id, coalesce(c.n, 0) AS n_links, d.doc_id = r.root AS kept
FROM documents d JOIN roots r ON r.id = d.doc_id LEFT JOIN counts c ON c.u = d.doc_id
""",
    "op2_embedding_near_dedup": """
WITH RECURSIVE sound AS (
  SELECT vec_id, list_transform(embedding, lambda x: x::DOUBLE) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), links AS (
  SELECT a.vec_id AS u, b.vec_id AS v FROM sound a JOIN sound b
    ON a.vec_id <> b.vec_id AND len(a.v) = len(b.v) AND list_cosine_similarity(a.v, b.v) >= 0.95
), reach AS (
  SELECT vec_id AS id, vec_id AS root FROM embeddings
  UNION
  SELECT links.v, reach.root FROM reach JOIN links ON reach.id = links.u
), roots AS (SELECT id, min(root) AS root FROM reach GROUP BY id),
counts AS (SELECT u, count(*) AS n FROM links GROUP BY u)
SELECT e.vec_id, coalesce(c.n, 0) AS n_links, r.root AS component_id, e.vec_id = r.root AS kept
FROM embeddings e JOIN roots r ON r.id = e.vec_id LEFT JOIN counts c ON c.u = e.vec_id
""",
    "op5_exact_topk": """
WITH sound AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.v, c.v)::BIGINT AS score
  FROM sound q JOIN sound c ON q.vec_id % 20 = 0 AND q.vec_id <> c.vec_id AND len(q.v) = len(c.v)
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank FROM scored
)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 20
""",
    "op11_importance_resampling": f"""
WITH dw AS ({_words("documents", "doc_id")}), bw AS ({_words("benchmark", "item_id")}),
df AS ({_features("dw", "doc_id")}), bf AS ({_features("bw", "item_id")}),
per_doc AS (SELECT doc_id, f, count(*) AS n FROM df GROUP BY doc_id, f),
names AS (SELECT f FROM df UNION SELECT f FROM bf),
buckets AS (SELECT f, {_crc32("f")} % 10000 AS b FROM names),
source AS (SELECT b, sum(n)::BIGINT AS s FROM per_doc JOIN buckets USING (f) GROUP BY b),
target AS (SELECT b, count(*) AS t FROM bf JOIN buckets USING (f) GROUP BY b),
totals AS (SELECT (SELECT coalesce(sum(s), 0) FROM source)::DOUBLE AS ss, (SELECT coalesce(sum(t), 0) FROM target)::DOUBLE AS tt),
gains AS (
  SELECT source.b, floor(1000 * ln((coalesce(t, 0) + 1)::DOUBLE * (ss + 10000) / ((s + 1)::DOUBLE * (tt + 10000))))::BIGINT AS gain
  FROM source LEFT JOIN target ON source.b = target.b CROSS JOIN totals
), weights AS (
  SELECT doc_id, sum(n)::BIGINT AS n_features, sum(n * gain)::BIGINT AS weight
  FROM per_doc JOIN buckets USING (f) JOIN gains USING (b) GROUP BY doc_id
), hashed AS (
  SELECT doc_id, len(w) AS n_words, list_reduce(list_prepend(0::BIGINT, list_transform(range(1, 9),
    lambda i: instr('0123456789abcdef', substr(sha256('42:' || doc_id), i, 1)) - 1)::BIGINT[]), lambda c, x: c * 16 + x) AS h FROM dw
), scored AS (
  SELECT doc_id, n_words, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight,
    coalesce(weight, 0) + floor(-1000 * ln(-ln((h + 0.5::DOUBLE) / 4294967296)))::BIGINT AS score
  FROM hashed LEFT JOIN weights USING (doc_id)
), ranked AS (
  SELECT *, n_words >= 20 AS eligible,
    row_number() OVER (PARTITION BY n_words >= 20 ORDER BY score DESC, doc_id) AS place,
    count(*) OVER (PARTITION BY n_words >= 20) AS n FROM scored
)
SELECT doc_id, n_features, weight, score, CASE WHEN eligible AND place <= 5 * n // 100 THEN place END AS rank FROM ranked
""",
    "op12_decontamination": f"""
WITH dw AS ({_words("documents", "doc_id")}), bw AS ({_words("benchmark", "item_id")}),
grams AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS n, array_to_string(w[i:i + least(len(w), 10) - 1], ' ') AS g
  FROM bw, unnest(range(1, len(w) - least(len(w), 10) + 2)) t(i) WHERE len(w) > 0
), sizes AS (SELECT DISTINCT n FROM grams),
hits AS (
  SELECT doc_id, i, n, array_to_string(w[i:i + n - 1], ' ') AS g FROM dw, sizes, unnest(range(1, len(w) - n + 2)) t(i)
  WHERE g IN (SELECT g FROM grams)
), covered AS (SELECT doc_id, count(DISTINCT i + k) AS n_hit FROM hits, unnest(range(0, n)) t(k) GROUP BY doc_id),
found AS (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM hits JOIN grams USING (n, g)),
items AS (SELECT doc_id, count(item) AS n_items, string_agg(item, ',' ORDER BY item) AS joined FROM found GROUP BY doc_id)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(joined, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM dw LEFT JOIN covered USING (doc_id) LEFT JOIN items USING (doc_id)
""",
    "op13_periodic_runs": f"""
WITH plain AS (
  SELECT doc_id, {_crc32("doc_id::VARCHAR")} AS h,
    list_filter(regexp_split_to_array(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w FROM documents
), parts AS (SELECT doc_id, h, w, len(w) AS n, h // 10 AS g FROM plain),
shapes AS (SELECT *, g % greatest(n, 1) AS a, 1 + (n - g % greatest(n, 1)) // (3 + g % 8) AS p FROM parts),
docs AS (
  SELECT doc_id, CASE WHEN h % 10 = 0 AND n > 0
    THEN list_transform(range(0, n), lambda i: CASE WHEN i < a THEN w[i + 1] ELSE w[a + (i - a) % p + 1] END) ELSE w END AS w FROM shapes
), words AS (SELECT doc_id, unnest(w) AS x, unnest(range(0, len(w))) AS i FROM docs),
-- a run of period q agrees with itself q words on over 16 words at least, so eights of words find all its places
eights AS (SELECT doc_id, i, hash(x, w1, w2, w3, w4, w5, w6, w7) AS e FROM (
  SELECT doc_id, i, x, lead(x, 1) OVER o AS w1, lead(x, 2) OVER o AS w2, lead(x, 3) OVER o AS w3, lead(x, 4) OVER o AS w4,
    lead(x, 5) OVER o AS w5, lead(x, 6) OVER o AS w6, lead(x, 7) OVER o AS w7 FROM words WINDOW o AS (PARTITION BY doc_id ORDER BY i)
) WHERE w7 IS NOT NULL),
pairs AS (SELECT a.doc_id, b.i - a.i AS q, a.i FROM eights a JOIN eights b ON a.doc_id = b.doc_id AND a.e = b.e AND a.i < b.i),
stretches AS (
  SELECT doc_id, q, min(i) AS start, count(*) + 7 + q AS length
  FROM (SELECT doc_id, q, i, i - row_number() OVER (PARTITION BY doc_id, q ORDER BY i) AS island FROM pairs) GROUP BY doc_id, q, island
), runs AS (
  SELECT doc_id, start, length, min(q) AS period FROM stretches WHERE length >= greatest(24, 3 * q) GROUP BY doc_id, start, length
), dropped AS (SELECT DISTINCT doc_id, unnest(range(start + period, start + length)) AS i FROM runs),
kept AS (SELECT doc_id, string_agg(x, ' ' ORDER BY i) AS joined FROM words ANTI JOIN dropped USING (doc_id, i) GROUP BY doc_id),
-- different fractions of such small numbers differ as doubles, equal ones do not
best AS (
  SELECT doc_id, count(*) AS n_runs, string_agg(start || ',' || length || ',' || period || chr(10), '' ORDER BY start, period) AS joined,
    first([start, length, period] ORDER BY length / period DESC, start, period) AS top FROM runs GROUP BY doc_id
)
SELECT doc_id, coalesce(n_runs, 0) AS n_runs, top[1] AS start, top[2] AS length, top[3] AS period,
  1000 * top[2] // top[3] AS exponent_milli, sha256(coalesce(best.joined, '')) AS runs_sha256, sha256(coalesce(kept.joined, '')) AS collapsed_sha256
FROM docs LEFT JOIN best USING (doc_id) LEFT JOIN kept USING (doc_id)
""",
}
