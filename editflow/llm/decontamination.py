"""Benchmark decontamination, native: windows of test words looked up in the training texts.

Both sides are brought to the same form (A-Z lower-cased, runs of 0-9, a-z and
characters beyond ASCII are words). An item gives its windows of ``size``
consecutive words, or one window of all its words where it has fewer. The
distinct windows and their hashes are the set that is looked for.

A text's windows are never built: every word is hashed once, and the hashes of
2, 4 and 8 words are put together of two shifted arrays each, so a window's
hash takes a few lookups, whatever its size. A scan explodes the hashes and
probes the set, which is broadcast. Its size is measured first: a set beyond the
bound is cut into as many parts as it takes, each with a scan of its own, so no
window is ever shuffled but those found. The words of a text are only put
together where a hash was found, and are compared with the item's own words in
the same join, so a hash that collides hits nothing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import pick, stored

WINDOW = 10
#: Bytes of one broadcast part of the set of windows, and what a window takes there besides its words.
BROADCAST_BYTES = 64_000_000
ROW_BYTES = 120
#: Regular expression of what lies between two words, before letters are lower-cased.
BETWEEN = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def folded(word: Column) -> Column:
    """A-Z lower-cased, and nothing else: ``lower`` does that only where all is ASCII."""
    return F.when(F.octet_length(word) == F.length(word), F.lower(word)).otherwise(F.translate(word, _UPPER, _LOWER))


def words_of(text: str) -> Column:
    """The words of a text column, lower-cased; none where it is null."""
    parts = F.split(F.coalesce(F.col(text), F.lit("")), BETWEEN)
    return F.transform(F.filter(parts, lambda w: w != ""), folded)


def _hashes(words: str, sizes: list[int]) -> tuple[list[dict[str, Column]], Column]:
    """Columns to add, step by step, and the array of the hashes of all windows of the given sizes, one size after another."""
    steps: list[dict[str, Column]] = [{"n_words": F.size(words).cast("long"), "_h1": F.transform(words, lambda w: F.xxhash64(w))}]

    def joined(left: str, right: str, shift: int) -> Column:
        rest = F.slice(right, F.lit(shift + 1), F.greatest(F.size(right) - shift, F.lit(0)))
        return F.zip_with(left, rest, lambda a, b: F.xxhash64(a, b))

    have = 1
    while 2 * have <= max(sizes, default=1):
        steps.append({f"_h{2 * have}": joined(f"_h{have}", f"_h{have}", have)})
        have *= 2
    windows = []
    for size in sizes:
        name, covered = None, 0
        for power in (2**k for k in range(size.bit_length() - 1, -1, -1) if size & 2**k):
            if name is None:
                name = f"_h{power}"
            else:
                steps.append({f"_w{size}_{covered + power}": joined(name, f"_h{power}", covered)})
                name = f"_w{size}_{covered + power}"
            covered += power
        # shifted arrays are shorter: the hashes past the last window are of part of it only
        windows.append(F.slice(name, F.lit(1), _count(size)))
    return steps, F.concat(*windows) if windows else F.array().cast("array<long>")


def _count(size: int) -> Column:
    """How many windows of ``size`` words a text has."""
    return F.greatest(F.col("n_words") - (size - 1), F.lit(0)).cast("int")


def _exploded(df: DataFrame, sizes: list[int], mark: bool) -> DataFrame:
    """A row (``start``, ``size``, ``h``) for each window, beside the other columns.

    With ``mark`` each text also gives one row of size 0 without a hash, which stands for the text itself.
    """
    steps, hashes = _hashes("words", sizes)
    for step in steps:
        df = df.withColumns(step)
    if mark:
        hashes = F.concat(hashes, F.array(F.lit(None).cast("long")))
    kept = [c for c in df.columns if not c.startswith(("_h", "_w"))]
    flat = df.select(*kept, F.posexplode(hashes).alias("_at", "h"))
    start, size, before = F.lit(None).cast("int"), F.lit(0), F.lit(0)
    for number in sizes:
        inside = (F.col("_at") >= before) & (F.col("_at") < before + _count(number))
        start = F.when(inside, F.col("_at") - before).otherwise(start)
        size = F.when(inside, F.lit(number)).otherwise(size)
        before = before + _count(number)
    return flat.select(*kept, start.alias("start"), size.alias("size"), "h")


def _window(words: str, start: str, size: str) -> Column:
    return F.array_join(F.slice(words, F.col(start) + 1, F.col(size)), " ")


def windows(items: DataFrame, size: int = WINDOW) -> DataFrame:
    """(size, h, gram, items) of each distinct window: the words, their hash, and the sorted ids of the items that have it.

    ``items`` has the columns ``item`` (string) and ``text``.
    """
    worded = items.select("item", words_of("text").alias("words")).withColumn("n", F.size("words"))
    found = None
    for number in range(1, size + 1):
        some = worded.where(F.col("n") == number if number < size else F.col("n") >= size).drop("n")
        some = _exploded(some, [number], mark=False).select("item", "size", "h", _window("words", "start", "size").alias("gram"))
        found = some if found is None else found.unionByName(some)
    return found.groupBy("size", "h", "gram").agg(F.sort_array(F.collect_set("item")).alias("items"))


def find(
    docs: DataFrame, benchmark: DataFrame, size: int = WINDOW, text: str = "text", doc_id: str = "doc_id",
    item_text: str = "text", item_id: str = "item_id", broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """(doc_id, n_words, n_hit, spans, items) of every row.

    ``spans`` are the maximal runs of hit words as (start, end), counted in
    words, and ``items`` the sorted ids, as strings, of the items of which a
    window occurs. Null and empty texts have no words; items without words have no window
    and hit nothing; items without an id hit words but are in no list. Repeated
    rows, and rows without an id, are told apart and each give a row. Empty
    tables are no special cases. Other columns are not looked at, whatever their names.

    One scan of the texts, in which only found windows and one row a text are
    shuffled. Windows with the same items are one class, and the list of items is put together once
    for each distinct set of classes, however many texts share it.
    """
    wanted = pick(benchmark, item=item_id, text=item_text).select(F.col("item").cast("string"), "text")
    grams = stored(windows(wanted, size), "test_windows")
    classes = stored(grams.select("items").distinct().withColumn("class", F.monotonically_increasing_id()), "test_classes")
    grams = stored(grams.join(classes, "items").select("size", "h", "gram", "class"), "test_grams")
    # at most ``size`` rows
    held = grams.groupBy("size").agg(F.sum(F.octet_length("gram") + ROW_BYTES).alias("bytes")).collect()
    parts = max(1, -(-sum(r["bytes"] for r in held) // broadcast_bytes))
    texts = pick(docs, id=doc_id, text=text).select("id", F.monotonically_increasing_id().alias("uid"), words_of("text").alias("words"))
    probes = _exploded(texts, sorted(r["size"] for r in held), mark=True)
    found = grams.select(F.col("h").alias("g_h"), "gram", "class")
    window = _window("words", "start", "size")
    # two strings that begin with each other are equal; an equation would be taken for a key and computed for every window
    same = (F.col("h") == F.col("g_h")) & F.startswith("gram", window) & F.startswith(window, "gram")
    hits = None
    for part in range(parts):
        mine = F.pmod(F.col("h"), F.lit(parts)) == part
        some = probes if parts == 1 else probes.where(mine | F.col("h").isNull() if part == 0 else mine)
        own = found if parts == 1 else found.where(F.pmod(F.col("g_h"), F.lit(parts)) == part)
        some = some.join(F.broadcast(own), same, "left").where((F.col("size") == 0) | F.col("class").isNotNull())
        some = some.select("uid", "id", "n_words", "start", (F.col("start") + F.col("size")).alias("end"), "class")
        hits = some if hits is None else hits.unionByName(some)
    per_doc = stored(_by_text(hits), "contaminated")

    clean = per_doc.where(F.size("classes") == 0).select("id", "n_words", "n_hit", "spans", F.array().cast("array<string>").alias("items"))
    dirty = per_doc.where(F.size("classes") > 0)
    sets = dirty.select("classes").distinct().select("classes", F.explode("classes").alias("class"))
    sets = sets.join(classes, "class").select("classes", F.explode_outer("items").alias("item"))
    sets = sets.groupBy("classes").agg(F.sort_array(F.collect_set("item")).alias("items"))
    dirty = dirty.join(sets, "classes").select("id", "n_words", "n_hit", "spans", "items")
    return clean.unionByName(dirty).withColumnRenamed("id", doc_id)


def _by_text(hits: DataFrame) -> DataFrame:
    """Maximal spans, hit words and classes of each text, from its hits and the row without a hit that stands for it."""
    text = Window.partitionBy("uid").orderBy("start", "end")
    reached = F.max("end").over(text.rowsBetween(Window.unboundedPreceding, -1))
    fresh = F.col("start").isNotNull() & (F.col("reached").isNull() | (F.col("start") > F.col("reached")))
    runs = hits.withColumn("reached", reached).withColumn("run", F.sum(fresh.cast("int")).over(text))
    runs = runs.groupBy("uid", "id", "n_words", "run").agg(
        F.min("start").alias("start"), F.max("end").alias("end"), F.collect_set("class").alias("classes")
    )
    span = F.when(F.col("start").isNotNull(), F.struct("start", "end"))
    found = runs.groupBy("uid", "id", "n_words").agg(
        F.sort_array(F.collect_list(span)).alias("spans"),
        F.sum(F.coalesce(F.col("end") - F.col("start"), F.lit(0)).cast("long")).alias("n_hit"),
        F.sort_array(F.array_distinct(F.flatten(F.collect_list("classes")))).alias("classes"),
    )
    return found


def remove(
    docs: DataFrame, benchmark: DataFrame, whole: bool = False, size: int = WINDOW, text: str = "text",
    item_text: str = "text", item_id: str = "item_id", broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """``docs`` without what it shares with the benchmark, in its own columns.

    With ``whole`` the documents with a hit go; else their hit words go, each with what
    stands between it and the next word, and the rest of the text stays as it
    is. Rows are matched by their text (a digest of it), so ids may be missing or
    repeated. Rows without a hit, null and empty texts come back unchanged, repeated rows as often as they occur.
    """
    names = docs.columns
    inner = docs.select(*(F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(names)))
    body = f"c{names.index(text)}"
    inner = inner.withColumn("digest", F.sha2(body, 256))
    found = find(inner.select(F.col("digest"), F.col(body).alias("text")), benchmark, size, "text", "digest", item_text, item_id, broadcast_bytes)
    hit = found.where(F.col("n_hit") > 0).select("digest", "spans").dropDuplicates(["digest"])
    back = [F.col(f"c{i}").alias(c) for i, c in enumerate(names)]
    if whole:
        return inner.join(hit, "digest", "left_anti").select(*back)
    between, word = BETWEEN[:-1], f"[^{BETWEEN[1:-1]}"
    lead = F.regexp_extract(body, f"^{between}*", 0)
    pieces = F.regexp_extract_all(F.col(body), F.lit(f"({word}+{between}*)"), F.lit(1))
    kept = F.filter("pieces", lambda p, i: ~F.exists("spans", lambda s: (s["start"] <= i) & (i < s["end"])))
    done = inner.join(hit, "digest", "left").withColumn("pieces", F.when(F.col("spans").isNotNull(), pieces))
    done = done.withColumn(body, F.when(F.col("spans").isNull(), F.col(body)).otherwise(F.concat(lead, F.array_join(kept, ""))))
    return done.select(*back)
