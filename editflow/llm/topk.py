"""Exact top-k inner products by a dual-tree search over a cover tree.

Queries and data share one tree: a cover tree is fitted on a bounded sample of
all vectors, every vector is routed to a leaf of it, and covering radii and
largest norms of the nodes are computed over all rows, apart for queries and
data. Pairs of a query node and a data node descend from the root; a pair is
pruned when the largest inner product that the covering radii allow is below
the worst kth score of the query node's queries so far. The leaf pairs that are
left are narrowed for each block of queries and scored exactly, in blocks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import cut, pick

#: Rows of a block of queries or data; query blocks that one task scores for a data block.
QUERY_ROWS, DATA_ROWS, RUN = 1024, 1024, 32


class CoverTree:
    """A cover tree over a bounded sample: each level's radius is a fraction of the one above.

    Every node but a leaf has a self-child, of its own center, and children of
    other centers that cover at least ``least`` sample vectors within the
    level's radius; vectors that no such child covers stay with the self-child.
    ``parents[i]`` is the parent of node ``i``.
    """

    def __init__(self, sample: np.ndarray, levels: int = 12, shrink: float = 0.8, least: int = 8):
        self.parents, self.children, self.radii = [-1], [[]], [0.0]
        centers = [sample.mean(axis=0) if len(sample) else np.zeros(1)]
        radius = float(np.linalg.norm(sample - centers[0], axis=1).max()) if len(sample) else 0.0
        open_ = [(0, np.arange(len(sample)))]
        for _ in range(levels):
            radius *= shrink
            below = []
            for node, mine in open_:
                x = sample[mine]
                square = (x * x).sum(axis=1)
                close = square[:, None] + square[None, :] - 2 * x @ x.T <= radius**2
                free, kids = np.ones(len(mine), dtype=bool), []
                for at in np.flatnonzero(close.sum(axis=1) >= least):
                    near = close[at] & free
                    if free[at] and least <= near.sum() < len(mine):
                        kids.append((x[at], mine[near]))
                        free &= ~near
                rest = mine[free]
                if kids:
                    for center, own in [(centers[node], rest), *kids]:
                        centers.append(center)
                        self.parents.append(node)
                        self.children.append([])
                        self.radii.append(radius)
                        self.children[node].append(len(centers) - 1)
                        below.append((len(centers) - 1, own))
                else:
                    below.append((node, mine))
            open_ = below
        self.centers = np.array(centers)

    def route(self, x: np.ndarray) -> np.ndarray:
        """The leaf of each row: level by level the nearest child that covers it, else the self-child."""
        at = np.zeros(len(x), dtype=np.int64)
        for node, kids in enumerate(self.children):
            mine = np.flatnonzero(at == node)
            if kids and len(mine):
                best, away = np.full(len(mine), kids[0]), np.full(len(mine), np.inf)
                for kid in kids[1:]:
                    far = np.linalg.norm(x[mine] - self.centers[kid], axis=1)
                    near = (far <= self.radii[kid]) & (far < away)
                    best[near], away[near] = kid, far[near]
                at[mine] = best
        return at

    def path(self, leaf: int) -> list[int]:
        """The leaf and its ancestors."""
        out = [leaf]
        while self.parents[out[-1]] >= 0:
            out.append(self.parents[out[-1]])
        return out


def quantised(vector: Column, scale: int = 64) -> Column:
    """floor(scale * x) of every component, in double precision; null for an unsound vector."""
    ok = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    whole = F.transform(vector, lambda x: F.floor(x.cast("double") * scale).cast("double"))
    return F.when(F.coalesce(ok, F.lit(False)) & (F.size(vector) > 0), whole)


def top_k(
    df: DataFrame,
    is_query: Column,
    k: int = 20,
    vector_col: str = "embedding",
    id_col: str = "vec_id",
    scale: int = 64,
    sample: int = 1024,
    seed: int = 3,
) -> DataFrame:
    """Rows (query_id, rank, ``id_col``, score): each query's ``k`` highest scores, ties to the smaller id.

    ``is_query`` is a condition on the columns ``id`` of the prepared rows.
    Vectors are quantised to floor(scale * x); the score is the integer inner
    product, the candidates every row of the same dimension but the query's
    own. Vectors that are null or empty, or hold null or non-finite
    components, and rows without an id take no part; a query with fewer
    candidates has as many rows as those. Repeated rows of an id count once:
    those with the smallest vector. Components are exact up to 2^53 in sums.
    The tree is fitted on a hash sample of at most about ``sample`` vectors.
    """
    spark = df.sparkSession
    rows = pick(df, id=id_col, v=vector_col).select("id", quantised(F.col("v"), scale).alias("v"))
    rows = rows.where(F.col("id").isNotNull() & F.col("v").isNotNull()).groupBy("id").agg(F.min("v").alias("v"))
    rows = cut(rows.withColumn("dim", F.size("v")))
    n = rows.count()
    u = F.pmod(F.xxhash64("id", F.lit(seed)), F.lit(1 << 40))
    some = rows.where(u < F.lit(sample / max(n, 1) * 2.0**40)).orderBy(u).limit(2 * sample).select("dim", "v").collect()
    trees = {
        dim: CoverTree(np.array([r["v"] for r in some if r["dim"] == dim])) for dim in sorted({r["dim"] for r in some})
    }
    shared = spark.sparkContext.broadcast(trees)  # at most 2 * sample vectors and their levels

    def routed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims = batch.column(2).to_numpy()
            leaf, gap = np.zeros(len(dims), dtype=np.int64), np.zeros((len(dims), 0)).tolist()
            norm = np.zeros(len(dims))
            for dim in np.unique(dims).tolist():
                mine = np.flatnonzero(dims == dim)
                x = _rows(batch.column(1).take(pa.array(mine)), dim)
                norm[mine] = np.linalg.norm(x, axis=1)
                tree = shared.value.get(dim)
                if tree is None:
                    leaf[mine] = -1
                    continue
                leaf[mine] = tree.route(x)
                for i, row in zip(mine, x):
                    on = tree.path(int(leaf[i]))
                    gap[i] = np.linalg.norm(tree.centers[on] - row, axis=1).tolist()
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(leaf), pa.array(norm), pa.array(gap, pa.list_(pa.float64()))],
                names=["id", "v", "dim", "leaf", "norm", "gap"],
            )

    leafed = T.StructType([*rows.schema.fields, *T.StructType.fromDDL("leaf bigint, norm double, gap array<double>").fields])
    placed = cut(rows.mapInArrow(routed, leafed))
    # Exact covering radii over all rows: of a leaf's vectors around the leaf's center and around each ancestor.
    sizes = placed.groupBy("dim", "leaf").agg(F.count("*").alias("n"), F.count_if(is_query).alias("nq"))
    around = placed.select("dim", "leaf", "norm", is_query.alias("asks"), F.posexplode("gap").alias("up", "gap"))
    wide = [F.max("gap").alias("gap"), F.max("norm").alias("norm")]
    wide += [F.max(F.when(F.col("asks"), F.col(c))).alias(f"q{c}") for c in ("gap", "norm")]
    reach = around.groupBy("dim", "leaf", "up").agg(*wide).collect()  # bounded by the nodes of the fitted trees
    radii = {dim: {side: np.full((2, len(t.parents)), -1.0) for side in ("data", "queries")} for dim, t in trees.items()}
    for r in reach:
        node = trees[r["dim"]].path(r["leaf"])[r["up"]]
        for side, pair in (("data", (r["gap"], r["norm"])), ("queries", (r["qgap"], r["qnorm"]))):
            if pair[0] is not None:
                radii[r["dim"]][side][:, node] = np.maximum(radii[r["dim"]][side][:, node], pair)

    def blocks(part: DataFrame, per: int, count: str) -> DataFrame:
        n_blocks = F.ceil(F.col(count) / per).cast("int")
        salted = part.join(F.broadcast(sizes), ["dim", "leaf"])  # as many rows as the trees have leaves
        salted = salted.withColumn("block", F.pmod(F.xxhash64("id", F.lit(29)), n_blocks).cast("bigint"))
        together = salted.groupBy("dim", "leaf", "block").agg(F.collect_list(F.struct("id", "v")).alias("rows"))
        return together.select("dim", "leaf", "block", F.col("rows.id").alias("ids"), F.flatten("rows.v").alias("flat"))

    data = cut(blocks(placed, DATA_ROWS, "n"))
    asked = cut(blocks(placed.where(is_query), QUERY_ROWS, "nq").withColumnsRenamed({"leaf": "qleaf", "block": "qblock"}))

    # First pass: each query block against its own leaf's first block of data gives each query a first kth score.
    home = asked.select("dim", "qleaf", "qblock", "ids", "flat").join(
        data.where("block = 0").select("dim", F.col("leaf").alias("qleaf"), F.col("ids").alias("ids2"), F.col("flat").alias("flat2")),
        ["dim", "qleaf"],
    )

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                ids, q = _block(batch, i, "ids", "flat")
                score = _scores(ids, q, *_block(batch, i, "ids2", "flat2"))
                floor = np.partition(score, -k, axis=1)[:, -k] if score.shape[1] >= k else np.full(len(ids), -np.inf)
                lists = pa.array([floor], pa.list_(pa.float64()))
                yield pa.RecordBatch.from_arrays([*batch.slice(i, 1).columns[:3], lists], names=["dim", "qleaf", "qblock", "floors"])

    floors = home.mapInArrow(first, T.StructType.fromDDL("dim int, qleaf bigint, qblock bigint, floors array<double>"))
    none = F.transform("ids", lambda _: F.lit(float("-inf")))
    groups = asked.join(floors, ["dim", "qleaf", "qblock"], "left").withColumn("floors", F.coalesce("floors", none))
    groups = cut(groups.withColumn("worst", F.array_min("floors")))

    # Node pairs: the trees' nodes, which the sample bounds, descend against each other.
    worst = {}
    for r in groups.groupBy("dim", "qleaf").agg(F.min("worst").alias("worst")).collect():
        worst.setdefault(r["dim"], {})[r["qleaf"]] = r["worst"]
    meets = {dim: node_pairs(tree, radii[dim]["queries"], radii[dim]["data"], worst.get(dim, {})) for dim, tree in trees.items()}
    reached = spark.sparkContext.broadcast((meets, {dim: r["data"] for dim, r in radii.items()}))

    def descend(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Of the data leaves that a query block's leaf meets, those that the block's own center and radius leave."""
        pairs, data_radii = reached.value
        for batch in batches:
            for i in range(batch.num_rows):
                dim, qleaf, least = (batch.column(c)[i].as_py() for c in ("dim", "qleaf", "worst"))
                _, q = _block(batch, i, "ids", "flat")
                leaves = np.array([-1])
                if dim in pairs:
                    leaves = pairs[dim].get(qleaf, np.zeros(0, dtype=np.int64))
                    center = q.mean(axis=0)
                    radius = np.linalg.norm(q - center, axis=1).max()
                    c, (gap, norm) = shared.value[dim].centers[leaves], data_radii[dim][:, leaves]
                    high = np.linalg.norm(q, axis=1).max()
                    size = np.linalg.norm(c, axis=1)
                    leaves = leaves[_bound(c @ center, np.linalg.norm(center), radius, high, size, gap, norm) >= least]
                lists = pa.array([leaves], pa.list_(pa.int64()))
                yield pa.RecordBatch.from_arrays([*batch.slice(i, 1).columns[:3], lists], names=["dim", "qleaf", "qblock", "leaves"])

    left = groups.select("dim", "qleaf", "qblock", "ids", "flat", "worst").mapInArrow(
        descend, T.StructType.fromDDL("dim int, qleaf bigint, qblock bigint, leaves array<bigint>")
    )
    pairs = left.select("dim", "qleaf", "qblock", F.explode("leaves").alias("leaf")).join(data.select("dim", "leaf", "block"), ["dim", "leaf"])
    pairs = cut(pairs)
    # A data block is scored in one task against runs of at most about RUN query blocks: queries are the smaller side to move.
    per = pairs.groupBy("dim", "leaf", "block").agg(F.count("*").alias("n_pairs"))
    run = F.pmod(F.xxhash64("qleaf", "qblock", F.lit(31)), F.ceil(F.col("n_pairs") / RUN).cast("int"))
    pairs = pairs.join(per, ["dim", "leaf", "block"]).withColumn("run", run).drop("n_pairs")
    key = ["dim", "leaf", "block", "run"]
    sides = pairs.join(groups, ["dim", "qleaf", "qblock"]).select(*key, F.lit(1).alias("side"), "ids", "flat", "floors")
    heads = pairs.select(*key).distinct().join(data, ["dim", "leaf", "block"])
    heads = heads.select(*key, F.lit(0).alias("side"), "ids", "flat", F.lit(None).cast("array<double>").alias("floors"))
    together = sides.unionByName(heads).repartition(*key).sortWithinPartitions(*key, "side")

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            side = batch.column("side").to_numpy()
            for i in range(batch.num_rows):
                ids, v = _block(batch, i, "ids", "flat")
                if not side[i]:
                    held = ids.copy(), v.copy()
                else:
                    yield _best(ids, v, batch.column("floors")[i].values.to_numpy(), *held, k)

    scored = together.mapInArrow(score, T.StructType.fromDDL("query_id bigint, id bigint, score bigint"))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "id")
    out = scored.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return out.select("query_id", F.col("rank").cast("int").alias("rank"), F.col("id").alias(id_col), "score")


def node_pairs(tree: CoverTree, queries: np.ndarray, data: np.ndarray, worst: dict[int, float]) -> dict[int, np.ndarray]:
    """Dual-tree descent: the data leaves that each query leaf has to meet.

    ``queries`` and ``data`` hold the covering radius (row 0) and the largest
    norm (row 1) of every node, minus one where none lies; ``worst`` is the
    smallest kth score of the queries of a leaf, and a node's is the smallest
    of its leaves'. Of a pair that its bound leaves, the wider node is split.
    """
    n = len(tree.parents)
    least = np.full(n, np.inf)
    for leaf, score in worst.items():
        on = tree.path(leaf)
        least[on] = np.minimum(least[on], score)
    size, gram = np.linalg.norm(tree.centers, axis=1), tree.centers @ tree.centers.T
    n_kids = np.array([len(kids) for kids in tree.children])
    begin = np.cumsum(n_kids) - n_kids
    kid = np.array([c for kids in tree.children for c in kids], dtype=np.int64)

    def split(node: np.ndarray, other: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        many = n_kids[node]
        within = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
        return kid[np.repeat(begin[node], many) + within], np.repeat(other, many)

    q, d, ends = np.zeros(1, dtype=np.int64), np.zeros(1, dtype=np.int64), []
    while len(q):
        bound = _bound(gram[q, d], size[q], queries[0, q], queries[1, q], size[d], data[0, d], data[1, d])
        alive = (queries[0, q] >= 0) & (data[0, d] >= 0) & (bound >= least[q])
        q, d = q[alive], d[alive]
        done = (n_kids[q] == 0) & (n_kids[d] == 0)
        ends.append((q[done], d[done]))
        q, d = q[~done], d[~done]
        by_query = (n_kids[q] > 0) & ((n_kids[d] == 0) | (queries[0, q] > data[0, d]))
        q1, d1 = split(q[by_query], d[by_query])
        d2, q2 = split(d[~by_query], q[~by_query])
        q, d = np.concatenate([q1, q2]), np.concatenate([d1, d2])
    q, d = (np.concatenate(side) for side in zip(*ends))
    return {int(leaf): d[q == leaf] for leaf in np.unique(q)}


def _bound(inner, q_size, q_radius, q_norm, d_size, d_radius, d_norm):
    """No less than the largest inner product of two vectors within the radii of two centers, rounding included."""
    bound = np.minimum(inner + q_radius * d_size + (q_size + q_radius) * d_radius, q_norm * d_norm)
    return bound + 1e-9 * (q_size + q_radius) * (d_size + d_radius) + 1e-6  # sums whose terms may cancel


def _rows(column: pa.Array, dim: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)


def _block(batch: pa.RecordBatch, i: int, ids: str, flat: str) -> tuple[np.ndarray, np.ndarray]:
    """Ids and vectors of row ``i``, a block; views into the batch."""
    out = batch.column(ids)[i].values.to_numpy(zero_copy_only=False)
    return out, batch.column(flat)[i].values.to_numpy(zero_copy_only=False).reshape(len(out), -1)


def _scores(ids: np.ndarray, queries: np.ndarray, others: np.ndarray, data: np.ndarray) -> np.ndarray:
    """Inner products; minus infinity for a query and itself."""
    out = queries @ data.T
    _, row, at = np.intersect1d(ids, others, assume_unique=True, return_indices=True)
    out[row, at] = -np.inf
    return out


def _best(ids: np.ndarray, queries: np.ndarray, floors: np.ndarray, others: np.ndarray, data: np.ndarray, k: int) -> pa.RecordBatch:
    """Of each query the ``k`` best of a block that reach the query's floor, ties to the smaller id."""
    score = _scores(ids, queries, others, data)
    if score.shape[1] > k:
        floors = np.maximum(floors, np.partition(score, -k, axis=1)[:, -k])
    row, at = np.nonzero((score >= floors[:, None]) & (score > -np.inf))
    order = np.lexsort((others[at], -score[row, at], row))
    row, at = row[order], at[order]
    best = np.arange(len(row)) - np.searchsorted(row, row) < k
    row, at = row[best], at[best]
    return pa.RecordBatch.from_arrays(
        [pa.array(ids[row]), pa.array(others[at]), pa.array(score[row, at].astype(np.int64))],
        names=["query_id", "id", "score"],
    )
