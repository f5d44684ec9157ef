"""Grouping helpers of the near-duplicate operators: bucket blocks and connected components.

A bucket or family may hold a large share of all rows, so it is never collected
whole: its members are dealt into sub-blocks by a hash, every pair of
sub-blocks is one small group, and a task streams over such groups. Tasks emit
links to one member of each block's group (a star), not pairs.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import cut


def block_pairs(members: DataFrame, size: int, *key: str) -> DataFrame:
    """Members (with ``key`` columns and ``id``) dealt to pairs of sub-blocks of about ``size`` rows.

    Adds ``b1 <= b2``, the pair of sub-blocks, and ``b``, the row's own. Groups
    of a single member have nothing to compare and go. Two rows of a key meet
    in at least one pair; two of one sub-block meet in (b, b) only, if
    comparisons within other pairs are restricted to rows of different ``b``.
    """
    sizes = members.groupBy(*key).agg(F.count("*").alias("n")).where(F.col("n") > 1)
    g = F.ceil(F.col("n") / size).cast("int")
    b = F.pmod(F.xxhash64("id", F.lit(17)), F.col("g")).cast("int")
    dealt = members.join(sizes, [*key]).withColumn("g", g).withColumn("b", b)
    other = F.explode(F.sequence(F.lit(0), F.col("g") - 1))
    dealt = dealt.withColumn("o", other).withColumn("b1", F.least("b", "o")).withColumn("b2", F.greatest("b", "o"))
    return dealt.drop("n", "g", "o")


def grouped(batches: Iterator[pa.RecordBatch], n_keys: int) -> Iterator[tuple[tuple, pa.Table]]:
    """Runs of equal values in the first ``n_keys`` columns (integers) of sorted batches, as (key, rows)."""
    held: list[pa.RecordBatch] = []
    held_key: tuple | None = None
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = np.stack([batch.column(i).to_numpy(zero_copy_only=False) for i in range(n_keys)])
        edges = np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(axis=0)) + 1
        begin = 0
        for end in [*edges.tolist(), batch.num_rows]:
            key = tuple(keys[:, begin].tolist())
            if held and key != held_key:
                yield held_key, pa.Table.from_batches(held)
                held = []
            held, held_key = [*held, batch.slice(begin, end - begin)], key
            begin = end
    if held:
        yield held_key, pa.Table.from_batches(held)


def local_roots(n: int, left: np.ndarray, right: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """For each of ``n`` nodes the smallest id of its component under the given edges (by position)."""
    label = ids.copy()
    while True:
        before = label.copy()
        low = np.minimum(label[left], label[right])
        np.minimum.at(label, left, low)
        np.minimum.at(label, right, low)
        if (label == before).all():
            return label


def map_groups(df: DataFrame, keys: list[str], run: Callable, schema: T.StructType) -> DataFrame:
    """Stream over the rows of each combination of ``keys`` together: ``run`` gets (key, rows) one after another."""
    rows = df.select(*keys, *(c for c in df.columns if c not in keys)).repartition(*keys).sortWithinPartitions(*keys)
    return rows.mapInArrow(lambda batches: run(grouped(batches, len(keys))), schema)


def components(links: DataFrame) -> DataFrame:
    """(id, root): the smallest id reachable from each id that the links (u, v) name.

    Every node keeps links to smaller nodes only. While a node has more than
    one, all of them are linked to its smallest (which joins their trees), and
    then paths are shortened by pointer jumping. Rounds of aggregations and
    joins over stored tables; no node's links meet in one row.
    """
    edge = links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where(F.col("u") != F.col("v"))
    edge = cut(edge.distinct())
    n_edges = edge.count()
    while n_edges:
        low = edge.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("n"))
        if not low.where(F.col("n") > 1).limit(1).count():
            break
        # u -> m, and each other smaller neighbour v -> m
        to = edge.join(low, "u")
        moved = to.where(F.col("v") != F.col("m")).select(F.col("v").alias("u"), F.col("m").alias("v"))
        edge = cut(low.select("u", F.col("m").alias("v")).union(moved).distinct())
        n_edges = edge.count()
    tree = edge.select(F.col("u").alias("id"), F.col("v").alias("root"))
    while n_edges:
        up = tree.select(F.col("id").alias("root"), F.col("root").alias("up"))
        tree = cut(tree.join(up, "root", "left").select("id", F.coalesce("up", "root").alias("root"), F.col("up").isNotNull().alias("moved")))
        again = tree.where("moved").limit(1).count()
        tree = tree.select("id", "root")
        if not again:
            break
    roots = tree.select(F.col("root").alias("id")).distinct().withColumn("root", F.col("id"))
    return tree.unionByName(roots)
