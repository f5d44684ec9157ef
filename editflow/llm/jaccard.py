"""N-gram Jaccard join with Bayesian candidate pruning.

Documents are sets of word shingles. MinHash bands deal the distinct sets into
buckets; inside a bucket the MinHash values of two sets are compared a few at a
time, and a pair is dropped as soon as the posterior probability that its
similarity reaches the threshold falls below a tolerance. The pairs left over
span families, and within a family similarities are computed exactly.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import cut, give_back, pick, slices, stored
from .families import block_pairs, components, local_roots, map_groups

HASHES, BAND, STEP = 128, 4, 16
BUCKET_ROWS, FAMILY_ROWS = 512, 256
_GOLDEN = np.uint64(0x9E3779B97F4A7C15)
_WORDS: dict[str, int] = {}


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def shingle_sets(texts: list[str], width: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct 64-bit shingle hashes of every text, one after another, and how many each has.

    Words are separated by white space. A text of fewer than ``width`` words,
    but one at least, has one shingle of all its words; no word, no shingle.
    """
    words = [t.split() for t in texts]
    if len(_WORDS) > 300_000:
        _WORDS.clear()
    for w in set().union(*words) - _WORDS.keys():
        _WORDS[w] = xxhash.xxh64_intdigest(w) | 1
    n = np.fromiter(map(len, words), np.int64, len(words))
    size = np.where(n > 0, np.maximum(n, width), 0)  # short texts are padded with zeros
    flat = np.zeros(int(size.sum()), dtype=np.uint64)
    owner_words = np.repeat(np.cumsum(size) - size, n) + np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
    flat[owner_words] = np.fromiter((_WORDS[w] for ws in words for w in ws), np.uint64, int(n.sum()))
    rolled = np.zeros(len(flat), dtype=np.uint64)
    for j in range(width):
        rolled = rolled * _GOLDEN
        rolled[: len(flat) - j] += flat[j:] if j else flat
    per = np.maximum(size - width + 1, 0)
    at = np.repeat(np.cumsum(size) - size, per) + np.arange(int(per.sum())) - np.repeat(np.cumsum(per) - per, per)
    owner = np.repeat(np.arange(len(texts)), per)
    hashes = _mix(rolled[at])
    order = np.lexsort((hashes, owner))
    hashes, owner = hashes[order], owner[order]
    first = np.ones(len(hashes), dtype=bool)
    first[1:] = (hashes[1:] != hashes[:-1]) | (owner[1:] != owner[:-1])
    return hashes[first], np.bincount(owner[first], minlength=len(texts))


def min_hashes(hashes: np.ndarray, sizes: np.ndarray, seed: int = 1) -> np.ndarray:
    """Row = nonempty set, column = MinHash value (16 bits of it)."""
    rng = np.random.default_rng(seed)
    a = rng.integers(1, 2**63, HASHES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    b = rng.integers(0, 2**63, HASHES, dtype=np.uint64)
    some = sizes > 0
    out = np.empty((int(some.sum()), HASHES), dtype=np.uint16)
    if len(out):
        begin = (np.cumsum(sizes) - sizes)[some]
        for j in range(HASHES):
            out[:, j] = np.minimum.reduceat((hashes * a[j] + b[j]) >> np.uint64(32), begin) & np.uint64(0xFFFF)
    return out


def least_matches(threshold: float, tolerance: float) -> list[int]:
    """For 16, 32, ... compared values: fewer matches make the threshold too improbable.

    With a uniform prior, P(J >= t | m of n match) = P(Binomial(n + 1, t) <= m).
    """
    out = []
    for n in range(STEP, HASHES + 1, STEP):
        total, m = 0.0, -1
        while total < tolerance:
            m += 1
            total += math.comb(n + 1, m) * threshold**m * (1 - threshold) ** (n + 1 - m)
        out.append(m)
    return out


def not_pruned(sig: np.ndarray, once: np.ndarray, least: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of rows that survive the incremental comparison of their MinHash values."""
    alive, matches, k = once, np.zeros(once.shape, dtype=np.uint8), 0
    for k, m in enumerate(least):
        if alive.size < 4096 or alive.mean() < 0.1:  # few pairs are compared one by one
            break
        for j in range(k * STEP, (k + 1) * STEP):
            matches += sig[:, j][:, None] == sig[:, j][None, :]
        alive = alive & (matches >= m)
    else:
        k = len(least)
    left, right = np.nonzero(alive)
    count = matches[left, right].astype(np.int64)
    for k in range(k, len(least)):
        at = slice(k * STEP, (k + 1) * STEP)
        for a in range(0, len(left), 1 << 18):
            part = slice(a, a + (1 << 18))
            count[part] += (sig[left[part], at] == sig[right[part], at]).sum(axis=1)
        keep = count >= least[k]
        left, right, count = left[keep], right[keep], count[keep]
    return left, right


def intersections(hashes: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Sizes of the pairwise intersections of sets, by products of 0/1 matrices over slices of the shared hashes."""
    owner = np.repeat(np.arange(len(sizes)), sizes)
    _, column, count = np.unique(hashes, return_inverse=True, return_counts=True)
    shared = count > 1
    place = np.cumsum(shared) - 1
    owner, column = owner[shared[column]], place[column[shared[column]]]
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    out = np.zeros((len(sizes), len(sizes)))
    width = 4096
    for a in range(0, int(shared.sum()), width):
        lo, hi = np.searchsorted(column, (a, a + width))
        one = np.zeros((len(sizes), width), dtype=np.float32)
        one[owner[lo:hi], column[lo:hi] - a] = 1
        out += one @ one.T
    return out


def _once(own: np.ndarray) -> np.ndarray:
    n = len(own)
    across = own[:, None] != own[None, :] if own.min() != own.max() else np.ones((n, n), dtype=bool)
    return np.triu(across, 1)


def jaccard_join(
    df: DataFrame,
    text_col: str = "text",
    id_col: str = "doc_id",
    threshold: float = 0.8,
    width: int = 5,
    tolerance: float = 1e-8,
) -> DataFrame:
    """Rows (``id_col``, class_id, n_links, kept), one for each row of ``df``.

    Two documents are linked if the Jaccard similarity of their sets of
    ``width``-word shingles is at least ``threshold``; ``class_id`` is the
    smallest id reachable by links, ``n_links`` the number of other rows linked
    directly, and ``kept`` whether the class id is the row's own. Equal sets
    are compared once, whatever the number of their copies; no group is capped.
    A pair at the threshold shares no band with probability 5e-8, and is
    pruned wrongly with about ``tolerance``. Null texts, texts without a word
    and rows without an id link with nothing; repeated rows count as other
    rows; an empty table gives no rows; other columns are not read. Ids are
    integers, and an id names one text. Shingles are told apart by 64-bit hashes.
    """
    rows = pick(df, id=id_col, text=text_col)
    kind = rows.schema["id"].dataType
    least = least_matches(threshold, tolerance)
    docs = rows.select(F.col("id").cast("bigint").alias("id"), "text")
    n_bands = HASHES // BAND

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in slices(batch, "text"):
                hashes, sizes = shingle_sets(texts, width)
                some = sizes > 0
                sig = min_hashes(hashes, sizes)
                begin = (np.cumsum(sizes) - sizes)[some]
                sums = [np.add.reduceat(_mix(hashes ^ np.uint64(x)), begin) if len(begin) else np.zeros(0, np.uint64) for x in (1, 2)]
                key = np.stack([*sums, sizes[some].astype(np.uint64)], axis=1)
                same, sigs = np.full((2, len(texts)), None, dtype=object)
                same[some], sigs[some] = [k.tobytes() for k in key], [r.tobytes() for r in sig]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(same, pa.binary()), pa.array(sigs, pa.binary())], names=["id", "same", "sig"]
                )
        _WORDS.clear()
        give_back()

    sketched = stored(docs.mapInArrow(sketch, T.StructType.fromDDL("id bigint, same binary, sig binary")), "sketches")
    sound = sketched.where(F.col("id").isNotNull() & F.col("same").isNotNull())
    # Equal sets become one: the smallest id stands for them.
    rep = F.min(F.struct("id", "sig"))
    distinct = sound.groupBy("same").agg(rep.alias("r"), F.count("*").alias("w"))
    distinct = cut(distinct.select("same", "r.id", "r.sig", "w"))

    def bands(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            key = np.frombuffer(b"".join(batch.column(1).to_pylist()), dtype=np.int64)  # BAND values are one key
            offsets = pa.array(np.arange(0, len(key) + 1, n_bands, dtype=np.int32))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.ListArray.from_arrays(offsets, pa.array(key))], names=["id", "keys"])

    keyed = distinct.select("id", "sig").mapInArrow(bands, T.StructType.fromDDL("id bigint, keys array<bigint>"))
    entries = keyed.select("id", F.posexplode("keys").alias("band", "key"))
    dealt = block_pairs(entries, BUCKET_ROWS, "band", "key").join(distinct.select("id", "sig"), "id")

    def candidates(groups) -> Iterator[pa.RecordBatch]:
        for _, part in groups:
            own = part.column("b").to_numpy()
            sig = np.frombuffer(b"".join(part.column("sig").to_pylist()), dtype=np.uint16).reshape(len(own), HASHES)
            yield from _star(part.column("id").to_numpy(), *not_pruned(sig, _once(own), least))

    family = components(
        map_groups(dealt, ["band", "key", "b1", "b2"], candidates, T.StructType.fromDDL("u bigint, v bigint"))
    )

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in slices(batch, "text"):
                hashes, sizes = shingle_sets(texts, width)
                offsets = pa.array(np.concatenate(([0], np.cumsum(sizes))), pa.int32())
                lists = pa.ListArray.from_arrays(offsets, pa.array(hashes.view(np.int64)))
                yield pa.RecordBatch.from_arrays([part.column(0), lists], names=["id", "set"])
        _WORDS.clear()
        give_back()

    # Repeated rows of an id are one text here; the aggregation needs no shuffle of its own.
    texts = docs.join(family.select("id"), "id", "left_semi").groupBy("id").agg(F.min("text").alias("text"))
    full = texts.mapInArrow(sets, T.StructType.fromDDL("id bigint, set array<bigint>"))
    members = block_pairs(family, FAMILY_ROWS, "root").join(full, "id").join(distinct.select("id", "w"), "id")

    def exact(groups) -> Iterator[pa.RecordBatch]:
        for _, part in groups:
            ids, own, w = (part.column(c).to_numpy() for c in ("id", "b", "w"))
            lists = part.column("set").combine_chunks()
            sizes = np.diff(lists.offsets.to_numpy())
            both = intersections(lists.flatten().to_numpy(), sizes)
            union = sizes[:, None] + sizes[None, :] - both
            left, right = np.nonzero((both >= (threshold - 1e-12) * union) & _once(own))
            count = np.bincount(left, w[right], len(ids)) + np.bincount(right, w[left], len(ids))
            for star in _star(ids, left, right):
                yield pa.RecordBatch.from_arrays([*star.columns, pa.array(np.zeros(star.num_rows, np.int64))], names=["u", "v", "n"])
            some = np.flatnonzero(count)
            linked = pa.array(ids[some])
            yield pa.RecordBatch.from_arrays([linked, linked, pa.array(count[some].astype(np.int64))], names=["u", "v", "n"])

    found = cut(map_groups(members, ["root", "b1", "b2"], exact, T.StructType.fromDDL("u bigint, v bigint, n bigint")))
    counts = found.groupBy(F.col("u").alias("id")).agg(F.sum("n").alias("n"))
    about = (
        distinct.join(counts, "id", "left")
        .join(components(found.select("u", "v")), "id", "left")
        .select("same", (F.coalesce("n", F.lit(0)) + F.col("w") - 1).alias("n_links"), F.coalesce("root", "id").alias("class_id"))
    )
    classed = sound.select("id", "same").join(about, "same").select("id", "n_links", "class_id")
    alone = sketched.where(F.col("id").isNull() | F.col("same").isNull())
    out = classed.unionByName(alone.select("id", F.lit(0).cast("bigint").alias("n_links"), F.col("id").alias("class_id")))
    return out.select(
        F.col("id").cast(kind).alias(id_col),
        F.col("class_id").cast(kind).alias("class_id"),
        F.col("n_links").cast("long").alias("n_links"),
        F.col("id").eqNullSafe(F.col("class_id")).alias("kept"),
    )


def _star(ids: np.ndarray, left: np.ndarray, right: np.ndarray) -> Iterator[pa.RecordBatch]:
    if len(left):
        root = local_roots(len(ids), left, right, ids)
        some = root != ids
        yield pa.RecordBatch.from_arrays([pa.array(ids[some]), pa.array(root[some])], names=["u", "v"])
