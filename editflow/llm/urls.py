"""URL filter: rules, host word segmentation and multinomial naive Bayes.

Concatenated host names are split into words by a unigram Viterbi; the words
of the host and the tokens of the path are scored by a multinomial naive Bayes
model that is trained on the URLs which a rule decides.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import pick, stored

#: (verdict, host, path) of the production rules.
RULES = (
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
)
#: Labelled block words that join the training URLs (a parameter of ``train``).
SEED_WORDS = ("adult", "bets", "casino", "farm", "free", "gamble", "porn", "spam", "viagra", "win", "xxx")
CACHED_LABELS = 200_000
#: What each seed word has of all words, besides its own count.
SEED_SHARE = 5e-4
#: Added to the number of all words for those that are not among them.
UNSEEN = 10
#: The longest label of a host name: up to this, all parts of a run of letters are looked up.
LABEL = 63


def host_of(url: Column) -> Column:
    """Between the first ``://`` and ``/``, ``?``, ``#`` or the end, A-Z lower-cased; empty without ``://``."""
    host = F.regexp_extract(_rest(url), r"^[^/?#]*", 0)
    return F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or the end; empty without ``://``."""
    return F.regexp_extract(_rest(url), r"^[^/?#]*([^?#]*)", 1)


def _rest(url: Column) -> Column:
    at = F.locate("://", url)
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))


def rule_for(host: Column, path: Column, rules: Sequence[tuple[str, str, str]] = RULES) -> Column:
    """Struct (rule, verdict) of the longest rule that fits, null where none does."""
    out = F.lit(None).cast("struct<rule:string,verdict:string>")
    for verdict, rule_host, rule_path in sorted(rules, key=lambda r: (len(r[1] + r[2]), r)):
        fits = ((host == rule_host) | host.endswith("." + rule_host)) & path.startswith(rule_path)
        found = F.struct(F.lit(rule_host + rule_path).alias("rule"), F.lit(verdict).alias("verdict"))
        out = F.when(fits, found).otherwise(out)
    return out


def word_counts(pages: DataFrame, html_col: str = "html") -> DataFrame:
    """(w, n): how often each word is in all pages' text."""
    text = F.lower(F.regexp_replace(F.col("html"), r"<[^>]*>", " "))
    words = pick(pages, html=html_col).select(F.explode(F.regexp_extract_all(text, F.lit("[a-z]{2,}"), 0)).alias("w"))
    return words.groupBy("w").agg(F.count("*").alias("n"))


class Segmenter:
    """Unigram Viterbi over concatenated words of any length; an unknown word of length k costs log(total * 10^k)."""

    def __init__(self, counts: dict[str, float], total: float | None = None):
        self.total = sum(counts.values()) + UNSEEN if total is None else total
        self.logs = {w: math.log(n / self.total) for w, n in counts.items()}
        self.sizes = sorted({len(w) for w in counts})
        self.cache: dict[str, list[str]] = {}

    def split(self, label: str) -> list[str]:
        found = self.cache.get(label)
        if found is None:
            if len(self.cache) >= CACHED_LABELS:
                self.cache.clear()
            found = self.cache[label] = self._viterbi(label)
        return found

    def _viterbi(self, label: str) -> list[str]:
        best, back = [0.0], [0]
        letter, unseen = math.log(10), math.log(self.total)
        # the best place for an unknown word to begin: its letters cost the same each, so one place is the best for all ends
        lead, place = 0.0, 0
        for end in range(1, len(label) + 1):
            score, begin = lead - unseen - end * letter, place
            for size in self.sizes:
                if size > end:
                    break
                known = self.logs.get(label[end - size : end])
                if known is not None and (best[end - size] + known, size) > (score, end - begin):
                    score, begin = best[end - size] + known, end - size
            best.append(score)
            back.append(begin)
            if score + end * letter > lead:
                lead, place = score + end * letter, end
        words, end = [], len(label)
        while end:
            words.append(label[back[end] : end])
            end = back[end]
        return words[::-1]


def host_runs(host: Column) -> Column:
    """The runs of letters in the host's labels but the last one."""
    labels = F.regexp_replace(F.regexp_extract(host, r"^[^:]*", 0), r"\.[^.]*\z", "")
    return F.regexp_extract_all(labels, F.lit("[a-z]+"), 0)


def segmented(hosts: DataFrame, counts: DataFrame, seed_words: Sequence[str] = SEED_WORDS, seed_share: float = SEED_SHARE) -> DataFrame:
    """Rows (host, words), one for each different host: its runs, split by the counts (w, n) of all words.

    Each run meets the words that are a part of it by a join, so no lexicon of
    the corpus is held anywhere. Runs beyond :data:`LABEL` letters, which no real
    host has, also meet the words of each greater length that there is. A seed word has ``seed_share`` of all words besides.
    """
    counts = stored(counts, "words")
    corpus = counts.agg(F.sum("n")).first()[0] or 0
    seeds = {w: seed_share * (corpus + UNSEEN) for w in seed_words}
    total = corpus + sum(seeds.values()) + UNSEEN
    hosts = stored(hosts.select("host").distinct().withColumn("runs", host_runs(F.col("host"))), "hosts")
    runs = hosts.select(F.explode("runs").alias("run")).distinct()
    runs = stored(runs.withColumn("key", F.monotonically_increasing_id()), "runs")
    parts = runs.select("key", "run", F.explode(F.sequence(F.lit(1), F.length("run"))).alias("at"))
    left = F.length("run") - F.col("at") + 1
    long = counts.where(F.length("w") > LABEL).select(F.length("w").alias("k")).distinct().collect()  # one row a length
    sizes = F.sequence(F.lit(2), F.least(left, F.lit(LABEL)))
    if long:
        every = F.array(*(F.lit(r["k"]) for r in long))
        sizes = F.when(left > LABEL, F.concat(sizes, F.filter(every, lambda k: k <= F.length("run") - F.col("at") + 1))).otherwise(sizes)
    parts = parts.where(left > 1).withColumn("k", F.explode(sizes))
    parts = parts.select("key", F.substring("run", F.col("at"), F.col("k")).alias("w")).distinct()
    known = parts.join(counts, "w").groupBy("key").agg(F.collect_list("w").alias("w"), F.collect_list("n").alias("n"))

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for run, words, n in zip(*(c.to_pylist() for c in batch.columns)):
                about = Counter(dict(zip(words or [], n or [])))
                about.update({w: c for w, c in seeds.items() if w in run})
                out.append(Segmenter(about, total).split(run))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.list_(pa.string()))], names=["run", "words"])

    words = runs.join(known, "key", "left").select("run", "w", "n").mapInArrow(split, "run string, words array<string>")
    each = hosts.select("host", F.posexplode("runs").alias("pos", "run")).join(words, "run")
    each = each.groupBy("host").agg(F.array_sort(F.collect_list(F.struct("pos", "words"))).alias("all"))
    out = hosts.select("host").join(each, "host", "left")
    found = F.flatten(F.transform("all", lambda x: x["words"]))
    return stored(out.select("host", F.coalesce(found, F.array().cast("array<string>")).alias("words")), "segmented")


def features(words: Sequence[str], path: str) -> list[str]:
    """Segmented words of the host without its last label, and the path's tokens of three or more characters.

    Shorter path tokens name a locale or section, which is what rules are for.
    """
    out = ["h:" + w for w in words]
    return out + ["p:" + t for t in re.findall("[^/._+&=~,;:%-]+", path.lower()) if len(t) > 2 and not t.isdigit()]


class NaiveBayes:
    """Multinomial naive Bayes of two classes with add-one smoothing and a given share of blocked URLs.

    The share is a parameter: how many training URLs a rule blocks says little about the others.
    """

    def __init__(self, rows: Iterable[tuple[str, list[str], float]], blocked_share: float = 0.2):
        self.words = {"allow": Counter(), "block": Counter()}
        self.prior = math.log(blocked_share / (1 - blocked_share))
        for label, tokens, weight in rows:
            for t in tokens:
                self.words[label][t] += weight
        size = len(set().union(*self.words.values())) + 1
        self.sums = {label: sum(c.values()) + size for label, c in self.words.items()}

    def verdict(self, tokens: list[str]) -> str:
        """The likelier class; a tie is allowed."""
        margin = self.prior
        for t in tokens:
            margin += math.log((self.words["block"][t] + 1) / self.sums["block"])
            margin -= math.log((self.words["allow"][t] + 1) / self.sums["allow"])
        return "block" if margin > 0 else "allow"


def parsed(pages: DataFrame, url_col: str, id_col: str, rules: Sequence[tuple[str, str, str]]) -> DataFrame:
    rows = pick(pages, id=id_col, url=url_col).select("id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    rows = rows.withColumns({"host": F.coalesce("host", F.lit("")), "path": F.coalesce("path", F.lit(""))})
    return rows.withColumn("r", rule_for(F.col("host"), F.col("path"), rules)).select("id", "host", "path", "r.rule", "r.verdict")


def train(rows: DataFrame, sample: int = 20_000, seed_words: Sequence[str] = SEED_WORDS, seed_part: float = 0.02) -> NaiveBayes:
    """Fit on at most ``sample`` different URLs that a rule decides, in order of a hash of their smallest id, and the seed words.

    Copies of a URL are one row of weight 1 + log2 of their number, so none fills the
    sample. The seed words together weigh as blocked rows what ``seed_part`` of the sample does, and each as three rows at least.
    """
    decided = rows.where(F.col("verdict").isNotNull()).groupBy("host", "path", "verdict")
    decided = decided.agg(F.count(F.lit(1)).alias("n"), F.min("id").alias("id"), F.first("words").alias("words"))
    some = decided.orderBy(F.xxhash64("id"), "host", "path", "verdict").limit(sample).collect()
    labelled = [(r["verdict"], features(r["words"], r["path"]), 1 + math.log2(r["n"])) for r in some]
    seeds = max(3.0, seed_part * sum(n for _, _, n in labelled) / max(1, len(seed_words)))
    return NaiveBayes(labelled + [("block", ["h:" + w], seeds) for w in seed_words])


def filter_urls(
    pages: DataFrame,
    url_col: str = "url",
    html_col: str = "html",
    id_col: str = "page_id",
    rules: Sequence[tuple[str, str, str]] = RULES,
    sample: int = 20_000,
    seed_words: Sequence[str] = SEED_WORDS,
) -> DataFrame:
    """Rows (``id_col``, host, path, rule, verdict), one for each row of ``pages``.

    The longest rule that fits decides (null rule where none does), else the
    model. A null url, or one without ``://``, has an empty host and path and
    is judged by the model's prior. The counts of all words of the html split
    the hosts. Null html adds no words; repeated rows are each judged; an empty
    table gives no rows; other columns are not read.
    """
    rows = parsed(pages, url_col, id_col, rules)
    rows = rows.join(segmented(rows, word_counts(pages, html_col), seed_words), "host").select(*rows.columns, "words")
    model = train(rows, sample, seed_words)
    shared = pages.sparkSession.sparkContext.broadcast(model)  # bounded by sample
    kind = rows.schema["id"].dataType

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            path, verdict, words = (batch.column(i).to_pylist() for i in (2, 4, 5))
            said = [v or model.verdict(features(w, p)) for p, v, w in zip(path, verdict, words)]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:4], pa.array(said, pa.string())], names=["id", "host", "path", "rule", "verdict"]
            )

    text = T.StringType()
    schema = T.StructType([T.StructField("id", kind), *(T.StructField(c, text) for c in ("host", "path", "rule", "verdict"))])
    return rows.mapInArrow(judge, schema).withColumnRenamed("id", id_col)
