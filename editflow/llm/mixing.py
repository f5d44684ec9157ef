"""Temperature mixing of sources, realised as budgeted block permutations, in DataFrame functions only.

Source token shares p become weights p^a / sum(p^a). The exponent a is found
by bisection so that the weights meet a target entropy or a repetition limit.
The weights are realised within a token budget: every document of a source is
taken as often as whole passes fit, and a last part of a pass takes the
documents that come first in a pseudo-random permutation. Every copy gets a
block and a place in it by other hashes, which know nothing of that cut, such
that each block holds the target mixture up to chance.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import cut, pick, stored

#: Bits of the permutation hash that one level of the search for a source's cut resolves, and the levels.
LEVEL_BITS, LEVELS = 10, 3
#: What is known about so many sources, a few numbers each, is broadcast; beyond that it is joined by shuffles.
SMALL_SOURCES = 50_000


def word_count(text: Column) -> Column:
    """Number of runs without white space; 0 for a null text."""
    return F.coalesce(F.size(F.split(F.trim(F.regexp_replace(text, r"\s+", " ")), " ")).cast("bigint"), F.lit(0)) * (
        F.coalesce(text.rlike(r"\S"), F.lit(False)).cast("bigint")
    )


def solve_exponent(tokens: Column, budget: Column, max_repeats: float | None, entropy: float | None, steps: int = 60) -> Column:
    """The exponent in [0, 1] for an array of source token counts, by bisection.

    Smaller exponents flatten the weights: entropy and repetition both fall as
    the exponent grows. With a target ``entropy`` (nats) the largest exponent
    that still has it, 0 where none has; with ``max_repeats`` the smallest
    exponent under which no source is repeated more often, 1 where none is.
    """
    total = F.aggregate(tokens, F.lit(0.0), lambda a, t: a + t)
    shares = F.transform(tokens, lambda t: t / total)

    def meets(a: Column) -> Column:
        powers = F.transform(shares, lambda p: F.pow(p, a))
        z = F.aggregate(powers, F.lit(0.0), lambda s, x: s + x)
        if entropy is not None:
            h = F.aggregate(powers, F.lit(0.0), lambda s, x: s - x / z * F.log(x / z))
            return h < entropy
        repeats = F.transform(shares, lambda p: F.pow(p, a - 1) / z * budget / total)
        return F.array_max(repeats) <= F.lit(float(max_repeats))

    def halve(acc: Column, _: Column) -> Column:
        mid = (acc["lo"] + acc["hi"]) / 2
        below = meets(mid)
        return F.struct(F.when(below, acc["lo"]).otherwise(mid).alias("lo"), F.when(below, mid).otherwise(acc["hi"]).alias("hi"))

    start = F.struct(F.lit(0.0).alias("lo"), F.lit(1.0).alias("hi"))
    found = F.aggregate(F.sequence(F.lit(1), F.lit(steps)), start, halve)["hi"]
    return F.when(meets(F.lit(0.0)), F.lit(0.0)).otherwise(found)


def source_targets(
    slim: DataFrame, budget_ratio: float, max_repeats: float | None, entropy: float | None
) -> DataFrame:
    """(source, tokens, exponent, weight, target): one row for each source that has tokens.

    The sources' counts meet in one row as an array, so the number of sources
    (not of documents) must fit there.
    """
    totals = cut(slim.groupBy("source").agg(F.sum("tokens").alias("tokens")).where(F.col("tokens") > 0))
    row = totals.agg(F.collect_list(F.col("tokens").cast("double")).alias("all"))
    row = row.select(F.array_sort("all").alias("all"))
    total = F.aggregate("all", F.lit(0.0), lambda a, t: a + t)
    row = row.select("all", total.alias("total"), (total * budget_ratio).alias("budget"))
    row = row.withColumn("exponent", solve_exponent(F.col("all"), F.col("budget"), max_repeats, entropy))
    z = F.aggregate(F.transform("all", lambda t: F.pow(t / F.col("total"), F.col("exponent"))), F.lit(0.0), lambda a, x: a + x)
    row = cut(row.select("total", "budget", "exponent", z.alias("z")))
    weight = F.pow(F.col("tokens") / F.col("total"), F.col("exponent")) / F.col("z")
    out = totals.join(F.broadcast(row), F.lit(True))  # the one row of totals
    out = out.select("source", "tokens", "exponent", weight.alias("weight"), (weight * F.col("budget")).alias("target"))
    passes = F.floor(F.col("target") / F.col("tokens") + 1e-9)
    return cut(out.withColumns({"passes": passes, "rest": F.greatest(F.col("target") - passes * F.col("tokens"), F.lit(0.0))}))


def mix_plan(
    df: DataFrame,
    text_col: str = "text",
    source_col: str = "source",
    id_col: str = "doc_id",
    budget_ratio: float = 1.0,
    max_repeats: float | None = 1.25,
    entropy: float | None = None,
    seed: int = 13,
) -> DataFrame:
    """Rows (``id_col``, source, tokens, weight, copies, place), one for each row of ``df``.

    The token budget is ``budget_ratio`` times all tokens (words). ``weight``
    is the source's, ``copies`` how often the document is taken, 0 included,
    and ``place`` in [0, 1) its place in the permutation of its source. A
    source's copies have at most its target's tokens, and less by no more than
    one document. Documents of equal hash come by id. A null source is a source
    of its own; documents without a word, and sources without any, have weight
    or copies as any other (0 tokens fit: one copy more than whole passes). An
    empty table gives no rows; repeated rows are each placed; other columns
    are not read.
    """
    slim = _slim(df, text_col, source_col, id_col, seed)
    ends, small = _source_ends(slim, budget_ratio, max_repeats, entropy)
    joined = _beside(slim, ends, small, "left")
    return joined.select(
        F.col("id").alias(id_col), "source", "tokens", F.coalesce("weight", F.lit(0.0)).alias("weight"),
        _copies().alias("copies"), _place().alias("place"),
    )


def _hash(seed: int, id_: Column, source: Column) -> Column:
    return F.shiftrightunsigned(F.xxhash64(F.lit(seed), id_, source), 1)


def _slim(df: DataFrame, text_col: str, source_col: str, id_col: str, seed: int) -> DataFrame:
    """(id, source, tokens, h, spot) of each row, stored."""
    rows = pick(df, id=id_col, text=text_col, source=source_col)
    tokens, h = word_count(F.col("text")), _hash(seed, F.col("id"), F.col("source"))
    spot = _spot(seed, F.col("id"), F.col("source"), F.col("text"))
    return stored(rows.select("id", "source", tokens.alias("tokens"), h.alias("h"), spot.alias("spot")), "mix")


def _spot(seed: int, id_: Column, source: Column, text: Column) -> Column:
    """A hash that is independent of the permutation's; of the text as well, which tells rows without an id apart."""
    return F.xxhash64(F.lit("block"), F.lit(seed), id_, source, text)


def _dealt(taken: DataFrame, n_blocks: int) -> DataFrame:
    """Each row of (id, source, spot, n, twin, copies, ...) as often as it is taken, with its epoch, block and ``turn`` in the block.

    Copies of a row, and of the ``n`` rows that are equal to it, go to equal parts of the blocks, one each, and to the same
    spot in them. All rows are spread alike, however often they are taken or occur.
    """
    taken = taken.where(F.col("copies") > 0)
    taken = taken.withColumn("epoch", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("copies") - 1)))
    spot = F.least(F.shiftrightunsigned("spot", 1) / F.lit(2.0**63), F.lit(1 - 2.0**-53))
    turn = F.col("twin") * F.col("copies") + F.col("epoch")
    block = F.least(F.floor((turn + spot) / (F.col("n") * F.col("copies")) * n_blocks), F.lit(n_blocks - 1)).cast("int")
    return taken.withColumns({"block": block, "turn": F.xxhash64(F.lit("turn"), "spot", turn)})


def _repeated(slim: DataFrame) -> DataFrame:
    """(spot, n) of the rows that occur more than once."""
    return cut(slim.groupBy("spot").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1))


def _twins(rows: DataFrame, repeated: DataFrame) -> DataFrame:
    """The rows with ``n``, how many are equal to each (itself included), and ``twin``, its number among them.

    Rows that occur once are not moved. The others are stored with the partition
    that they stand in, and numbered in it; the counts of the partitions before it are added. So
    no task holds all rows that are equal.
    """
    one = {"n": F.lit(1).cast("bigint"), "twin": F.lit(0).cast("bigint")}
    if repeated.isEmpty():
        return rows.withColumns(one)
    beside = F.broadcast(repeated) if repeated.count() <= SMALL_SOURCES else repeated
    single = rows.join(beside, "spot", "left_anti").withColumns(one)
    more = stored(rows.join(beside, "spot").withColumns({"_part": F.spark_partition_id(), "_at": F.monotonically_increasing_id()}), "twins")
    counts = more.groupBy("spot", "_part").agg(F.count(F.lit(1)).alias("_held"))
    before = F.sum("_held").over(Window.partitionBy("spot").orderBy("_part")) - F.col("_held")
    counts = counts.select("spot", "_part", before.alias("_before"))
    number = F.row_number().over(Window.partitionBy("spot", "_part").orderBy("_at")) - 1
    more = more.join(counts, ["spot", "_part"]).withColumn("twin", F.col("_before") + number).drop("_part", "_at", "_before")
    return single.unionByName(more)


def _blocks(slim: DataFrame, rows_per_block: int) -> int:
    return max(1, math.ceil(slim.count() / rows_per_block))


#: The order within a block.
_ORDER = ("turn", "id", "source", "twin", "epoch")


def _copies() -> Column:
    """How often a row is taken, from its hash and what is known about its source."""
    bin_ = F.shiftright("h", 63 - LEVEL_BITS * LEVELS)
    part = (bin_ < F.col("prefix")) | ((bin_ == F.col("prefix")) & (F.struct("h", "id") <= F.col("last")))
    return (F.coalesce("passes", F.lit(0)) + F.coalesce(part, F.col("prefix").isNull()).cast("bigint")).cast("bigint")


def _place() -> Column:
    return F.least(F.col("h") / F.lit(2.0**63), F.lit(1 - 2.0**-53))


def _source_ends(slim: DataFrame, budget_ratio: float, max_repeats: float | None, entropy: float | None) -> tuple[DataFrame, bool]:
    """(source, weight, passes, prefix, last): where each source's last part of a pass ends; whether there are few sources."""
    targets = source_targets(slim, budget_ratio, max_repeats, entropy)
    small = targets.count() <= SMALL_SOURCES
    # The place where each source's last part of a pass ends: token histograms over ever smaller ranges of the hash.
    open_ = targets.select("source", F.col("rest").alias("left"), F.lit(0).cast("bigint").alias("prefix"))
    for level in range(LEVELS):
        shift = 63 - LEVEL_BITS * (level + 1)
        inside = _beside(slim, open_, small).where(F.shiftright("h", shift + LEVEL_BITS) == F.col("prefix"))
        bins = inside.groupBy("source", F.shiftright("h", shift).alias("bin")).agg(F.sum("tokens").alias("n"), F.first("left").alias("left"), F.first("prefix").alias("prefix"))
        upto = F.sum("n").over(Window.partitionBy("source").orderBy("bin"))
        fits = bins.withColumn("upto", upto).withColumn("fits", F.col("upto") <= F.col("left"))
        # the first range that no longer fits whole, or the one after the last
        nxt = fits.groupBy("source").agg(
            F.first("left").alias("left"),
            F.first("prefix").alias("prefix"),
            F.max(F.when(F.col("fits"), F.col("upto"))).alias("taken"),
            F.min(F.when(~F.col("fits"), F.col("bin"))).alias("bin"),
        )
        after = F.shiftleft(F.col("prefix") + 1, LEVEL_BITS)
        open_ = cut(nxt.select("source", (F.col("left") - F.coalesce("taken", F.lit(0))).alias("left"), F.coalesce("bin", after).alias("prefix")))
    # Within the last range, about one document in 2^30 of a source, the ids count one by one.
    shift = 63 - LEVEL_BITS * LEVELS
    edge = _beside(slim, open_, small).where(F.shiftright("h", shift) == F.col("prefix"))
    order = Window.partitionBy("source").orderBy("h", "id")
    edge = edge.groupBy("source", "h", "id").agg(F.sum("tokens").alias("tokens"), F.first("left").alias("left"))  # repeated rows
    edge = edge.withColumn("upto", F.sum("tokens").over(order)).where(F.col("upto") <= F.col("left"))
    last = edge.groupBy("source").agg(F.max(F.struct("h", "id")).alias("last"))
    ends = targets.join(open_, targets["source"].eqNullSafe(open_["source"]), "left").select(targets["*"], "prefix")
    ends = ends.join(last, ends["source"].eqNullSafe(last["source"]), "left").select(ends["*"], "last")
    ends = cut(ends.select("source", "weight", "passes", "prefix", "last"))
    return ends, small


def deal(
    df: DataFrame,
    text_col: str = "text",
    source_col: str = "source",
    id_col: str = "doc_id",
    rows_per_block: int = 4096,
    budget_ratio: float = 1.0,
    max_repeats: float | None = 1.25,
    entropy: float | None = None,
    seed: int = 13,
) -> DataFrame:
    """Rows (``id_col``, source, tokens, weight, copies, epoch, block, position), one for each copy that ``mix`` makes.

    ``epoch`` counts a document's copies from 0, ``block`` the blocks and
    ``position`` the rows of a block, in the order of ``mix``; documents that
    are not taken have no row. Rows that are equal in id, source and text are dealt to
    blocks as the copies of one row are, evenly. What ``mix_plan`` says of null sources, texts
    without a word and repeated rows holds here.
    """
    slim = _slim(df, text_col, source_col, id_col, seed)
    ends, small = _source_ends(slim, budget_ratio, max_repeats, entropy)
    # only numbers of rows are needed here: equal ones are counted and dealt by their count
    equal = slim.groupBy("spot", "id", "source", "h").agg(F.count(F.lit(1)).alias("n"), F.first("tokens").alias("tokens"))
    taken = _beside(equal, ends, small, "left").withColumn("copies", _copies())
    taken = taken.withColumn("twin", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("n") - 1)))
    taken = _dealt(taken, _blocks(slim, rows_per_block))
    order = Window.partitionBy("block").orderBy(*_ORDER)  # a block holds about rows_per_block rows, whatever the input
    return taken.select(
        F.col("id").alias(id_col), "source", "tokens", F.coalesce("weight", F.lit(0.0)).alias("weight"), "copies", "epoch", "block",
        (F.row_number().over(order) - 1).alias("position"),
    )


def mix(
    df: DataFrame,
    text_col: str = "text",
    source_col: str = "source",
    id_col: str = "doc_id",
    rows_per_block: int = 4096,
    budget_ratio: float = 1.0,
    max_repeats: float | None = 1.25,
    entropy: float | None = None,
    seed: int = 13,
) -> DataFrame:
    """The rows of ``df``, each as often as ``mix_plan`` says, dealt to blocks in order, as ``deal`` lists them.

    Every copy goes to one of as many blocks as make about ``rows_per_block``
    rows each, all in the target proportions up to chance; a partition holds
    whole blocks, each in the order of a pseudo-random permutation. The columns
    are those of ``df``.
    """
    slim = _slim(df, text_col, source_col, id_col, seed)
    ends, small = _source_ends(slim, budget_ratio, max_repeats, entropy)
    names = {c: f"c{i}" for i, c in enumerate(df.columns)}
    rows = pick(df, **{new: c for c, new in names.items()})
    id_, source = F.col(names[id_col]), F.col(names[source_col])
    spot = _spot(seed, id_, source, F.col(names[text_col]))
    rows = rows.withColumns({"id": id_, "source": source, "h": _hash(seed, id_, source), "spot": spot})
    rows = _twins(rows, _repeated(slim))
    taken = _dealt(_beside(rows, ends, small, "left").withColumn("copies", _copies()), _blocks(slim, rows_per_block))
    taken = taken.repartition("block").sortWithinPartitions("block", *_ORDER)
    return taken.select(*(F.col(new).alias(c) for c, new in names.items()))


def _beside(slim: DataFrame, about: DataFrame, small: bool, how: str = "inner") -> DataFrame:
    """The rows of ``slim`` with what is known about their source (null is a source), which is broadcast if small."""
    about = about.withColumnRenamed("source", "key")
    about = F.broadcast(about) if small else about
    return slim.join(about, F.col("source").eqNullSafe(F.col("key")), how).drop("key")
