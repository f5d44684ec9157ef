"""Embedding near-duplicates with randomised-rotation binary codes.

Each distinct vector is normalised and turned by seeded random rotations. The
signs are its binary code; the inner product of the code with the turned vector
is its correction factor. Both are computed and stored once for each vector.

Code bands deal the vectors into buckets, whose entries carry an id and the
stored code only. Two codes differ in ``angle / pi`` of their bits on average,
so pairs with more differing bits than a pair at the threshold has, but for a
tolerance, are apart; the others join their vectors to one family. Within a
family, where every pair meets once, ``<code, q> / factor`` estimates an inner
product without bias, and only the pairs whose estimate plus confidence bound
reaches the threshold are recomputed exactly in double precision.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import cut, pick, stored
from .families import block_pairs, components, local_roots, map_groups

#: Bits that a stored code has at least, whatever the dimension.
CODE_BITS = 256
#: Strangers that a bucket holds on average; a bucket or family beyond so many rows is dealt into blocks.
STRANGERS, BUCKET_ROWS, FAMILY_ROWS = 128, 8192, 4096
#: Components that one side of a pair of family blocks holds at most, where the dimension is high.
FAMILY_VALUES = 1 << 20
#: Rows of a side of a product of matrices, and pairs of codes that are compared in one step.
TILE, STEP = 512, 1 << 18
_ROTATIONS: dict[tuple[int, int, int], np.ndarray] = {}


def rotation(dim: int, seed: int, n: int = 1) -> np.ndarray:
    """The ``n``-th seeded random rotation of a dimension."""
    key = (dim, seed, n)
    if key not in _ROTATIONS:
        q, r = np.linalg.qr(np.random.default_rng([seed, n, dim]).standard_normal((dim, dim)))
        _ROTATIONS[key] = q * np.sign(np.diag(r))
    return _ROTATIONS[key]


def matrix(column: pa.ChunkedArray | pa.Array, dim: int) -> np.ndarray:
    """Unit rows of list vectors of one dimension, in double precision."""
    flat = pa.concat_arrays(column.chunks) if isinstance(column, pa.ChunkedArray) else column
    x = flat.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dim)
    x = x / np.abs(x).max(axis=1, keepdims=True)  # neither squares nor sums overflow
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def turns(dim: int) -> int:
    """Rotations of a dimension whose signs make up a code."""
    return -(-CODE_BITS // dim)


def turned(x: np.ndarray, seed: int) -> np.ndarray:
    """Rows of unit length in all the rotations of the code, side by side."""
    n = turns(x.shape[1])
    return np.hstack([x @ rotation(x.shape[1], seed, t) for t in range(n)]) / math.sqrt(n)


def encode(x: np.ndarray, seed: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Codes (packed in whole 64-bit words), correction factors, and the deviation of an estimate made with them.

    In each rotation the code is the vector times that rotation's factor, and
    the rest of it points anywhere at right angles to the vector.
    """
    dim = x.shape[1]
    y = turned(x, seed)
    code = np.packbits(y >= 0, axis=1)
    code = np.pad(code, ((0, 0), (0, -code.shape[1] % 8)))
    each = np.abs(y).reshape(len(x), -1, dim).sum(axis=2) / math.sqrt(dim)  # times sqrt(turns): the factor of one rotation
    factor = each.sum(axis=1) / math.sqrt(turns(dim))
    rest = np.maximum(1 - turns(dim) * each**2, 0).sum(axis=1)
    return code, factor, np.sqrt(rest) / (turns(dim) * factor) / math.sqrt(max(dim - 1, 1))


def signs(code: np.ndarray, dim: int) -> np.ndarray:
    """Stored codes as rows of unit length."""
    bits = np.unpackbits(code, axis=1, count=turns(dim) * dim)
    return (bits * 2.0 - 1.0) / math.sqrt(bits.shape[1])


def may_reach(y: np.ndarray, code: np.ndarray, factor: np.ndarray, spread: np.ndarray, threshold: float, sigmas: float) -> np.ndarray:
    """Which pairs of a turned row and a stored code have an estimated cosine whose confidence bound reaches the threshold."""
    return (y @ code.T) / factor + sigmas * spread >= threshold


def most_apart(bits: int, threshold: float, miss: float) -> int:
    """Differing bits that two codes of a pair at the threshold exceed with probability ``miss`` at most."""
    p = math.acos(threshold) / math.pi
    tail, h = 0.0, bits
    while h > 0 and tail + (term := math.comb(bits, h) * p**h * (1 - p) ** (bits - h)) <= miss:
        tail, h = tail + term, h - 1
    return h


def band_plan(n: int, threshold: float, miss: float) -> tuple[int, int]:
    """Bits a band and number of bands: buckets hold about ``STRANGERS``, and a pair at the threshold misses all with ``miss``."""
    agree = 1 - math.acos(threshold) / math.pi
    bits = min(62, max(4, math.ceil(math.log2(max(n, 2) / STRANGERS))))
    return bits, math.ceil(math.log(miss) / math.log1p(-(agree**bits)))


def near_duplicates(
    df: DataFrame,
    vector_col: str = "embedding",
    id_col: str = "vec_id",
    threshold: float = 0.95,
    miss: float = 1e-5,
    sigmas: float = 6.0,
    seed: int = 5,
) -> DataFrame:
    """Rows (``id_col``, n_links, component_id, kept), one for each row of ``df``.

    Two vectors are linked if their cosine in double precision is at least
    ``threshold``; ``n_links`` counts the other rows linked directly,
    ``component_id`` is the smallest id reachable by links and ``kept`` says
    whether it is the row's own. A pair at the threshold escapes all bands, or
    has codes too far apart, with probability ``miss`` each; more similar ones
    with far less, and pairs that others of their family connect are not lost. Vectors that
    are null, empty or zero, or hold a null or non-finite component, link with
    nothing, as do vectors of different dimensions and rows without an id.
    Equal vectors are compared once and counted as many times as they occur;
    repeated ids count as other rows. Other columns are not read.
    """
    rows = pick(df, id=id_col, v=vector_col)
    ok = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("v", lambda x: x != 0)
    sound = rows.where(F.col("id").isNotNull() & F.coalesce(ok, F.lit(False)))
    # Equal vectors become one: the smallest id stands for them.
    distinct = sound.groupBy("v").agg(F.min("id").cast("bigint").alias("id"), F.count("*").alias("w"))
    distinct = distinct.select("id", "w", F.size("v").alias("dim"), "v")

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for dim, part in _by_dim(batches):
            made, factor, spread = encode(matrix(part.column("v"), dim), seed)
            columns = [*part.columns, pa.array([c.tobytes() for c in made], pa.binary()), pa.array(factor), pa.array(spread)]
            yield pa.RecordBatch.from_arrays(columns, names=[*part.schema.names, "code", "factor", "spread"])

    more = T.StructType.fromDDL("code binary, factor double, spread double").fields
    coded = stored(distinct.mapInArrow(code, T.StructType([*distinct.schema.fields, *more])), "codes")
    bits, bands = band_plan(coded.count(), threshold, miss)

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights = 1 << np.arange(bits, dtype=np.int64)
        for dim, part in _by_dim(batches):
            x = matrix(part.column("v"), dim)
            # Other rotations than the code's.
            side = [x @ rotation(dim, seed, turns(dim) + t) for t in range(-(-bands * bits // dim))]
            key = (np.hstack(side)[:, : bands * bits] >= 0).reshape(len(x), bands, bits) @ weights
            rest = [part.column(c) for c in part.schema.names if c not in ("dim", "v")]
            for band in range(bands):
                at = [part.column("dim"), pa.array(np.full(len(x), band, dtype=np.int32)), pa.array(key[:, band])]
                yield pa.RecordBatch.from_arrays([*at, *rest], names=[*bucket, *(c for c in part.schema.names if c not in ("dim", "v"))])

    bucket = ["dim", "band", "key"]
    places = "dim int, band int, key bigint"
    sizes = coded.select("dim", "v").mapInArrow(keys, places).groupBy(*bucket).agg(F.count("*").alias("n"))
    g = F.ceil(F.col("n") / BUCKET_ROWS).cast("int")
    large = stored(sizes.where(F.col("n") > BUCKET_ROWS).select(*bucket, g.alias("g")), "large")  # bands * rows / BUCKET_ROWS at most
    entries = coded.select("dim", "v", "id", "code").mapInArrow(keys, places + ", id bigint, code binary").join(large, bucket, "left")
    # A large bucket is dealt to blocks, each pair of which is one group.
    b = F.pmod(F.xxhash64("id", F.lit(17)), F.col("g")).cast("int")
    other = F.filter(F.sequence(F.lit(0), F.col("g") - 1), lambda o: o != b)
    entries = entries.withColumn("b", F.coalesce(b, F.lit(0))).withColumn("o", F.explode(F.coalesce(other, F.array(F.lit(0)))))
    dealt = entries.select(*bucket, F.least("b", "o").alias("b1"), F.greatest("b", "o").alias("b2"), "id", "code")
    apart = {d: most_apart(turns(d) * d, threshold, miss) for d in (r["dim"] for r in coded.select("dim").distinct().collect())}

    def stars(groups) -> Iterator[pa.RecordBatch]:
        for many in _together(groups):
            yield from _near_codes(many, apart)

    near = map_groups(dealt, [*bucket, "b1", "b2"], stars, T.StructType.fromDDL("u bigint, v bigint"))
    family = components(near).join(coded.select("id", "dim"), "id")
    per = F.greatest(F.lit(64), F.least(F.lit(FAMILY_ROWS), F.lit(FAMILY_VALUES) / F.col("dim")))
    members = block_pairs(family, per, "dim", "root").join(coded.drop("dim"), "id")

    def exact(groups) -> Iterator[pa.RecordBatch]:
        for (dim, _, b1, b2), part in groups:
            own = part.column("b").to_numpy()
            if b1 != b2 and (own == own[0]).all():
                continue
            ids, w = part.column("id").to_numpy(), part.column("w").to_numpy()
            left, right = _links(part, dim, own, b1, b2, threshold, seed, sigmas)
            for star in _star(ids, left, right):
                yield pa.RecordBatch.from_arrays([*star.columns, pa.array(np.zeros(star.num_rows, np.int64))], names=["u", "v", "n"])
            count = np.bincount(left, w[right], len(ids)) + np.bincount(right, w[left], len(ids))
            some = np.flatnonzero(count)
            linked = pa.array(ids[some])
            yield pa.RecordBatch.from_arrays([linked, linked, pa.array(count[some].astype(np.int64))], names=["u", "v", "n"])

    found = cut(map_groups(members, ["dim", "root", "b1", "b2"], exact, T.StructType.fromDDL("u bigint, v bigint, n bigint")))
    counts = found.groupBy(F.col("u").alias("id")).agg(F.sum("n").alias("n"))
    about = (
        coded.select("id", "v", "w")
        .join(counts, "id", "left")
        .join(components(found.select("u", "v")), "id", "left")
        .select("v", (F.coalesce("n", F.lit(0)) + F.col("w") - 1).alias("n_links"), F.coalesce("root", "id").alias("component_id"))
    )
    kind = rows.schema["id"].dataType
    usable = F.when(F.col("id").isNotNull() & F.coalesce(ok, F.lit(False)), F.col("v"))
    out = rows.select("id", usable.alias("v")).join(about, "v", "left")
    component = F.coalesce(F.col("component_id").cast(kind), F.col("id"))
    return out.select(
        F.col("id").alias(id_col),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        component.eqNullSafe(F.col("id")).alias("kept"),
    )


def _by_dim(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, pa.RecordBatch]]:
    """The rows of each dimension in a batch."""
    for batch in batches:
        dims = batch.column("dim").to_numpy()
        for dim in np.unique(dims).tolist():
            yield dim, batch.filter(pa.array(dims == dim))


def _together(groups) -> Iterator[list[tuple[int, pa.Table]]]:
    """Groups of one dimension, in lists of about ``BUCKET_ROWS`` rows, so that small ones are compared in one step."""
    held: list[tuple[int, pa.Table]] = []
    n = 0
    for key, part in groups:
        if held and (n + part.num_rows > BUCKET_ROWS or key[0] != held[0][0]):
            yield held
            held, n = [], 0
        held.append((key[0], part))
        n += part.num_rows
    if held:
        yield held


def _near_codes(many: list[tuple[int, pa.Table]], apart: dict[int, int]) -> Iterator[pa.RecordBatch]:
    """Links (u, v) that join all rows of a group whose codes are near, directly or by others of the group.

    Rows near the most central one of their group are linked to it and not
    compared with each other, so that a group of near copies costs one
    comparison a row; and no step gives more links than it has rows.
    """
    dim = many[0][0]
    part = pa.concat_tables(t for _, t in many).combine_chunks()
    size = np.array([t.num_rows for _, t in many])
    group, begin = np.repeat(np.arange(len(size)), size), np.cumsum(size) - size
    ids = part.column("id").to_numpy()
    words = np.frombuffer(b"".join(part.column("code").to_pylist()), dtype=np.uint64).reshape(len(ids), -1)

    def differ(i, j) -> np.ndarray:
        return np.bitwise_count(words[i] ^ words[j]).sum(axis=1, dtype=np.int32)

    # The row that differs least from the majority of each bit.
    ones = np.add.reduceat(np.unpackbits(words.view(np.uint8), axis=1), begin, axis=0, dtype=np.int32)
    most = np.packbits(ones * 2 > size[:, None], axis=1).view(np.uint64)
    away = np.bitwise_count(words ^ most[group]).sum(axis=1, dtype=np.int32)
    center = np.lexsort((away, group))[begin][group]
    near = differ(np.arange(len(ids)), center) <= apart[dim]
    linked = near & (center != np.arange(len(ids)))
    yield pa.RecordBatch.from_arrays([pa.array(ids[linked]), pa.array(ids[center[linked]])], names=["u", "v"])
    # The others come first in their group, and each is compared with all that follow it.
    order, end = np.lexsort((near, group)), np.repeat(np.cumsum(size), size)
    left = np.flatnonzero(~near[order])
    follow = end[left] - left - 1
    total = np.cumsum(follow)
    for a in range(0, int(total[-1]) if len(total) else 0, STEP):
        at = np.arange(a, min(a + STEP, int(total[-1])))
        k = np.searchsorted(total, at, side="right")
        i, j = order[left[k]], order[left[k] + 1 + at - (total[k] - follow[k])]
        same = differ(i, j) <= apart[dim]
        yield from _star(ids, i[same], j[same])


def _links(part: pa.Table, dim: int, own: np.ndarray, b1: int, b2: int, threshold: float, seed: int, sigmas: float) -> tuple[np.ndarray, np.ndarray]:
    """Positions of the linked pairs of a family block (b1 = b2), or between its two blocks, each pair once."""
    x = matrix(part.column("v"), dim)
    y = turned(x, seed)
    code = np.frombuffer(b"".join(part.column("code").to_pylist()), dtype=np.uint8).reshape(len(x), -1)
    c, factor, spread = signs(code, dim), part.column("factor").to_numpy(), part.column("spread").to_numpy()
    one, two = np.flatnonzero(own == b1), np.flatnonzero(own == b2)
    lefts, rights = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for i in range(0, len(one), TILE):
        for j in range(i if b1 == b2 else 0, len(two), TILE):
            p, q = one[i : i + TILE], two[j : j + TILE]
            maybe = may_reach(y[p], c[q], factor[q], spread[q], threshold, sigmas)
            if b1 == b2 and i == j:
                maybe = np.triu(maybe, 1)
            left, right = np.nonzero(maybe)
            if len(left) * 16 > maybe.size:
                cosine = (x[p] @ x[q].T)[left, right]
            else:
                cosine = np.einsum("ij,ij->i", x[p[left]], x[q[right]])
            lefts.append(p[left[cosine >= threshold]])
            rights.append(q[right[cosine >= threshold]])
    return np.concatenate(lefts), np.concatenate(rights)


def _star(ids: np.ndarray, left: np.ndarray, right: np.ndarray) -> Iterator[pa.RecordBatch]:
    if len(left):
        root = local_roots(len(ids), left, right, ids)
        some = root != ids
        yield pa.RecordBatch.from_arrays([pa.array(ids[some]), pa.array(root[some])], names=["u", "v"])
