"""Importance resampling: documents drawn towards the distribution of a target collection.

Every run of one to three consecutive words is a feature, hashed into one of
a fixed number of buckets. Two histograms of the buckets (all documents, all
target texts) give one gain for each bucket; the gains are an array of fixed
size that every task holds, and a document's weight is the sum of the gains of
its features. A Gumbel term from a hash of the id turns the weights into a draw
without replacement: the highest scores win.

The winners are not found by a sort of all scores. The keys (score, id, number
of the row) stay stored, and rounds of weighted median-of-medians narrow them:
each partition reports how many keys remain to it and their median, the median
of these medians, weighted by the counts, splits the rest, and the side that
cannot hold the last winner goes, at least a quarter of the keys a round. That
ends at the exact last key; only the winners are sorted, and their ranks are
counted by partition.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut, pick, slices, stored

BUCKETS = 10_000
LONGEST = 3
#: The rounds of the selection read the stored keys in at most so many tasks, and the driver gets one row of each.
MOST_PARTITIONS = 4096
#: Shifts of a checksum by fewer zero bytes than this are one table each; longer ones are put together of powers of two.
NEAR = 64

#: A-Z become a-z, and what is neither 0-9, a-z nor beyond ASCII becomes a space.
_FOLD = bytes(b if b >= 0x80 or chr(b).isalnum() else 0x20 for b in bytes(range(256)).lower())


def words_of(text: str) -> list[bytes]:
    """The words of a text, as UTF-8."""
    return text.encode().translate(_FOLD).split()


def _byte_table() -> np.ndarray:
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, (table >> 1) ^ np.uint32(0xEDB88320), table >> 1)
    return table


def _through(table: np.ndarray, values: np.ndarray) -> np.ndarray:
    """A linear map of 32 bits, given as its images of each byte at each of the four places."""
    out = table[0][values & 255]
    for place in (1, 2, 3):
        out = out ^ table[place][(values >> np.uint32(8 * place)) & 255]
    return out


class Checksums:
    """crc32 of joined strings from the crc32 of their parts, for whole arrays at once.

    ``crc32(a + b)`` is ``crc32(a)`` moved on by as many zero bytes as b has,
    xor ``crc32(b)``; the move is linear, so a table for each length does it.
    """

    def __init__(self) -> None:
        byte = _byte_table()
        identity = np.stack([np.arange(256, dtype=np.uint32) << np.uint32(8 * place) for place in range(4)])
        near = [identity]
        for _ in range(NEAR):
            near.append((near[-1] >> 8) ^ byte[near[-1] & 255])
        self.near = np.stack(near[:NEAR])
        self.powers = [near[NEAR]]  # NEAR, 2 * NEAR, 4 * NEAR ... zero bytes

    def join(self, left: np.ndarray, right: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """Checksums of ``left + right``, where the right parts are ``lengths`` bytes long."""
        near = lengths % NEAR
        moved = self.near[near, 0, left & 255]
        for place in (1, 2, 3):
            moved = moved ^ self.near[near, place, (left >> np.uint32(8 * place)) & 255]
        far, power = lengths // NEAR, 0
        while far.any():
            if power == len(self.powers):
                self.powers.append(_through(self.powers[-1], self.powers[-1]))
            some = np.flatnonzero(far & 1)
            moved[some] = _through(self.powers[power], moved[some])
            far, power = far >> 1, power + 1
        return moved ^ right


def features(texts: list[str], sums: Checksums, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(number of the text, bucket) of every feature, and the words of each text."""
    known: dict[bytes, int] = {}
    ids, counts = [], np.zeros(len(texts), np.int64)
    for i, text in enumerate(texts):
        words = words_of(text)
        counts[i] = len(words)
        ids.extend([known.setdefault(w, len(known)) for w in words])
    ids = np.array(ids, np.int64)
    owner = np.repeat(np.arange(len(texts)), counts)
    alone = np.fromiter((zlib.crc32(w) for w in known), np.uint32, len(known))
    spaced = np.fromiter((zlib.crc32(b" " + w) for w in known), np.uint32, len(known))
    lengths = np.fromiter((len(w) + 1 for w in known), np.int64, len(known))
    run = alone[ids]
    owners, found = [owner], [run]
    for n in range(2, LONGEST + 1):
        last = ids[n - 1:]
        run = sums.join(run[: len(last)], spaced[last], lengths[last])
        inside = owner[: len(last)] == owner[n - 1:]
        owners.append(owner[: len(last)][inside])
        found.append(run[inside])
    return np.concatenate(owners), np.concatenate(found).astype(np.int64) % buckets, counts


def histogram(df: DataFrame, text: str = "text", buckets: int = BUCKETS) -> list[int]:
    """How many features of all texts fall into each bucket (one row a bucket and task is shuffled)."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, total = Checksums(), np.zeros(buckets, np.int64)
        for batch in batches:
            for _, texts in slices(batch, "text"):
                total += np.bincount(features(texts, sums, buckets)[1], minlength=buckets)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], names=["bucket", "n"])

    parts = pick(df, text=text).mapInArrow(count, "bucket long, n long")
    out = [0] * buckets
    for row in parts.groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        out[row.bucket] = row.n
    return out


def gains(source: list[int], target: list[int]) -> list[int]:
    """floor(1000 * log ratio) of each bucket's smoothed shares in the target and in the source."""
    buckets = len(source)
    more, less = float(sum(source) + buckets), float(sum(target) + buckets)
    return [math.floor(1000 * math.log((t + 1.0) * more / ((s + 1.0) * less))) for s, t in zip(source, target)]


def weigh(docs: DataFrame, gain: list[int], text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """(id, n_words, n_features, weight) of every row."""
    table = pick(docs, id=doc_id, text=text)
    buckets = len(gain)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, values = Checksums(), np.array(gain, np.int64)
        for batch in batches:
            for part, texts in slices(batch, "text"):
                owner, bucket, words = features(texts, sums, buckets)
                n = np.bincount(owner, minlength=len(texts))
                # sums of whole numbers: exact in doubles up to 2 ** 53
                weight = np.bincount(owner, weights=values[bucket], minlength=len(texts)).astype(np.int64)
                columns = [part.column(part.schema.get_field_index("id")), pa.array(words), pa.array(n), pa.array(weight)]
                yield pa.RecordBatch.from_arrays(columns, names=["id", "n_words", "n_features", "weight"])

    kind = table.schema["id"].dataType.simpleString()
    return table.mapInArrow(score, f"id {kind}, n_words long, n_features long, weight long")


def gumbel(doc_id: str, seed: int) -> Column:
    """floor(-1000 * ln(-ln(u))) of a uniform number u that only the seed and the id decide."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(doc_id).cast("string"), F.lit(""))), 256)
    u = (F.conv(F.substring(digest, 1, 8), 16, 10).cast("double") + 0.5) / 4294967296.0
    return F.floor(-1000.0 * F.log(-F.log(u))).cast("long")


Key = tuple[int, int, int]


def _split(keys: DataFrame, low: Key | None, high: Key | None, pivot: Key | None) -> list[tuple[bool, int, Key]]:
    """(beyond the pivot, number of keys, their lower median) of each partition's keys in (low, high]."""
    if low:
        keys = keys.where(F.col("a") >= low[0])
    if high:
        keys = keys.where(F.col("a") <= high[0])

    def upto(parts: list[np.ndarray], bound: Key) -> np.ndarray:
        a, b, c = parts
        return (a < bound[0]) | ((a == bound[0]) & ((b < bound[1]) | ((b == bound[1]) & (c <= bound[2]))))

    def report(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [[], [], []]
        for batch in batches:
            parts = [batch.column(i).to_numpy() for i in range(3)]
            inside = np.ones(batch.num_rows, bool)
            if low:
                inside &= ~upto(parts, low)
            if high:
                inside &= upto(parts, high)
            for into, values in zip(held, parts):
                into.append(values[inside])
        rows = []
        if held[0]:
            parts = [np.concatenate(h) for h in held]
            order = np.lexsort(parts[::-1])
            near = int(upto(parts, pivot).sum()) if pivot else len(order)
            for beyond, begin, end in ((False, 0, near), (True, near, len(order))):
                if end > begin:
                    at = order[(begin + end - 1) // 2]
                    rows.append((beyond, end - begin, *(int(p[at]) for p in parts)))
        columns = [pa.array(list(c), t) for c, t in zip(zip(*rows), (pa.bool_(), *[pa.int64()] * 4))] if rows else []
        if rows:
            yield pa.RecordBatch.from_arrays(columns, names=["beyond", "n", "a", "b", "c"])

    found = keys.mapInArrow(report, "beyond boolean, n long, a long, b long, c long").collect()
    return [(r.beyond, r.n, (r.a, r.b, r.c)) for r in found]


def last_key(keys: DataFrame, most: int) -> Key | None:
    """The ``most``-th smallest of different keys (a, b, c), in rounds; none where ``most`` is 0.

    ``keys`` is a stored table of three long columns; where its files are sorted
    by ``a``, later rounds read only the row groups that still count. The driver sees one count and one median of each partition and side, of at most
    :data:`MOST_PARTITIONS` partitions.
    """
    if most <= 0:
        return None
    keys = keys.coalesce(MOST_PARTITIONS)
    low = high = None
    parts = [(n, median) for _, n, median in _split(keys, None, None, None)]
    while True:
        total, seen = sum(n for n, _ in parts), 0
        if most > total:
            raise ValueError("fewer keys than winners")
        for n, pivot in sorted(parts, key=lambda p: p[1]):
            seen += n
            if 2 * seen >= total:
                break
        found = _split(keys, low, high, pivot)
        near = sum(n for beyond, n, _ in found if not beyond)
        if near == most:
            return pivot
        beyond = near < most  # the side of the last winner
        if beyond:
            low, most = pivot, most - near
        else:
            high = pivot
        parts = [(n, median) for side, n, median in found if side == beyond]


def resample(
    docs: DataFrame, target: DataFrame, percent: int = 5, min_words: int = 20, seed: int = 42, buckets: int = BUCKETS,
    text: str = "text", doc_id: str = "doc_id", target_text: str = "text",
) -> DataFrame:
    """(doc_id, n_features, weight, score, rank) of every row; ``rank`` is null where it is not drawn.

    Of the N rows with at least ``min_words`` words, the ``floor(percent * N /
    100)`` highest scores are drawn, ties to the smaller id (an integer; rows
    without an id come last and share one hash). Null and empty texts have no
    feature and weight 0. Repeated rows count, and are drawn, as often as they
    occur; rows that agree in score and id are taken in the order of the table.
    An empty table, and an empty target, are no special cases. Other columns are not looked at, whatever their names.
    """
    gain = gains(histogram(docs, text, buckets), histogram(target, target_text, buckets))
    scored = weigh(docs, gain, text, doc_id).withColumn("score", F.col("weight") + gumbel("id", seed))
    scored = scored.withColumn("uid", F.monotonically_increasing_id())
    first = (-F.col("score")).alias("a")
    second = F.coalesce(F.col("id").cast("long"), F.lit(2**63 - 1)).alias("b")
    scored = stored(scored.select("*", first, second).sortWithinPartitions("a"), "resampling")
    keys = scored.where(F.col("n_words") >= min_words).select("a", "b", F.col("uid").alias("c"))
    last = last_key(keys, keys.count() * percent // 100)
    out = ("id", "n_features", "weight", "score")
    if last is None:
        ranked = scored.select(*out, F.lit(None).cast("long").alias("rank"))
    else:
        a, b, c = (F.lit(x).cast("long") for x in last)
        won = (F.col("a") < a) | ((F.col("a") == a) & ((F.col("b") < b) | ((F.col("b") == b) & (F.col("uid") <= c))))
        won = won & (F.col("n_words") >= min_words)
        lost = scored.where(~won).select(*out, F.lit(None).cast("long").alias("rank"))
        ranked = lost.unionByName(_ranked(scored.where(won)).select(*out, "rank"))
    return ranked.withColumnRenamed("id", doc_id)


def _ranked(winners: DataFrame) -> DataFrame:
    """The winners with their rank: sorted by range, and numbered by partition from the counts of those before it."""
    ordered = winners.orderBy("a", "b", "uid").select(
        "*", F.spark_partition_id().alias("part"), (F.monotonically_increasing_id() % 2**33).alias("at")
    )
    ordered = cut(ordered)
    before, rows = 0, []
    for row in ordered.groupBy("part").agg(F.count(F.lit(1)).alias("n")).orderBy("part").collect():
        rows.append((row.part, before))
        before += row.n
    starts = ordered.sparkSession.createDataFrame(rows, "part int, before long")
    return ordered.join(F.broadcast(starts), "part").withColumn("rank", F.col("before") + F.col("at") + 1)
