"""Removal of repeated substrings by a column-wise suffix array of many fragments.

A byte goes if a string of ``length`` bytes that covers it also starts earlier.
Equal strings have equal minimizers (the least hash of their grams), so texts
are cut into fragments of consecutive windows with one minimizer. Only
minimizers that occur twice matter. Equal fragments are pre-aggregated to
their first occurrence; where different fragments share a minimizer, the
Burrows-Wheeler transform of the fragments is built column-wise, one symbol of
each fragment a round, their common prefixes follow from it in rounds, and
suffixes with a common prefix of ``length`` are the repeated strings.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import pick, slices, stored

GRAM = 24
#: Symbols of the fragments whose transform is built together; different fragments of one minimizer that may meet there.
BATCH_SYMBOLS, HOT_CLASSES = 1 << 20, 2048
#: How often the fragments of such a minimizer are cut again: by another one, and the last time into single windows.
LEVELS = 8
_TABLE = np.random.default_rng(20).integers(0, 2**64, 256, dtype=np.uint64)
_POWER = np.uint64(0x9E3779B97F4A7C15)


def _power(n: int) -> np.uint64:
    return np.uint64(pow(int(_POWER), n, 1 << 64))


def gram_hashes(buf: np.ndarray) -> np.ndarray:
    """Hash of the ``GRAM`` bytes from each position on, from hashes of 1, 2, 4, 8 and 16 bytes."""
    h, eight = _TABLE[buf], None
    for n in (1, 2, 4, 8):
        h = h[:-n] * _power(n) + h[n:]
        eight = h if n == 4 else eight
    h = h[: len(buf) - GRAM + 1] * _power(8) + eight[16 : 16 + len(buf) - GRAM + 1]
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(29))


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first ``n`` powers of the base and of its inverse, modulo 2^64."""
    have = _POWERS.get("n", 0)
    if have < n:
        size = max(n, 1 << 19)
        inverse = np.uint64(pow(int(_POWER), -1, 1 << 64))
        both = []
        for base in (_POWER, inverse):
            column = np.full(size, base, dtype=np.uint64)
            column[0] = 1
            both.append(np.cumprod(column))
        _POWERS.update(n=size, up=both[0], down=both[1])
    return _POWERS["up"], _POWERS["down"]


_POWERS: dict = {}


def range_hashes(buf: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """Hash of the bytes of each range, from one running sum."""
    up, down = _powers(len(buf))
    sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(_TABLE[buf] * up[: len(buf)])))
    h = (sums[hi] - sums[lo]) * down[lo] + (hi - lo).astype(np.uint64)
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(29))


def sliding_min(h: np.ndarray, width: int) -> np.ndarray:
    n = 1
    while 2 * n <= width:
        h = np.minimum(h[:-n], h[n:])
        n *= 2
    return np.minimum(h[: len(h) - (width - n)], h[width - n :]) if width > n else h


def _no_fragments() -> tuple[np.ndarray, ...]:
    return tuple(np.zeros(0, dtype=t) for t in (np.int64, np.int64, np.int64, np.uint64, np.uint64, bool))


def _window_starts(sizes: np.ndarray, length: int) -> np.ndarray:
    """Where the windows begin that lie in one of the texts, which stand one after another."""
    ends = np.cumsum(sizes)
    # windows that would reach into the next text
    edge = np.zeros(int(ends[-1]) + 1, dtype=np.int32)
    np.add.at(edge, np.maximum(ends - sizes, ends - length + 1), 1)
    np.add.at(edge, ends, -1)
    return np.flatnonzero(np.cumsum(edge)[: int(ends[-1]) - length + 1] == 0)


def windows(texts: list[bytes], length: int) -> tuple[np.ndarray, ...]:
    """Every window as a fragment of its own, in the columns of ``fragments``; two hashes tell the windows apart."""
    buf = np.frombuffer(b"".join(texts), dtype=np.uint8)
    if len(buf) < length:
        return _no_fragments()
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    starts, h = _window_starts(sizes, length), gram_hashes(buf)
    value = np.zeros(len(starts), dtype=np.uint64)
    for k in (*range(0, length - GRAM, GRAM), length - GRAM):  # grams that cover the window
        value = value * _POWER + h[starts + k]
    ends = np.cumsum(sizes)
    text = np.searchsorted(ends, starts, side="right")
    same = range_hashes(buf, starts, starts + length)
    return text, starts - (ends - sizes)[text], np.full(len(starts), length), value, same, np.zeros(len(starts), dtype=bool)


def fragments(texts: list[bytes], length: int, level: int = 0) -> tuple[np.ndarray, ...]:
    """(text number, start, size, minimizer, hash, whether a window may repeat inside) of all fragments."""
    buf = np.frombuffer(b"".join(texts), dtype=np.uint8)
    if len(buf) < length:
        return _no_fragments()
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    ends = np.cumsum(sizes)
    h = gram_hashes(buf)
    if level:  # another order of the grams
        h = (h ^ np.uint64(level)) * np.uint64(0x94D049BB133111EB)
        h ^= h >> np.uint64(32)
    width = length - GRAM + 1
    least = sliding_min(h, width)
    starts = _window_starts(sizes, length)
    if not len(starts):
        return _no_fragments()
    value = least[starts]
    new = np.ones(len(starts), dtype=bool)
    new[1:] = (value[1:] != value[:-1]) | (starts[1:] != starts[:-1] + 1)
    first = np.flatnonzero(new)
    # A long run of one minimizer (periodic text) is cut into several fragments.
    run = np.diff(np.append(first, len(starts)))
    pieces = -(-run // width)
    k = np.arange(int(pieces.sum())) - np.repeat(np.cumsum(pieces) - pieces, pieces)
    first = np.repeat(first, pieces) + k * width
    last = np.append(first[1:], len(starts))
    # The minimizer occurs outside of a window that still has it as its minimizer: it occurs twice in the fragment.
    again = np.zeros(len(starts), dtype=bool)
    again[:-1] = ~new[1:] & (h[starts[:-1]] == value[1:])
    reach = starts[:-1] + width
    again[:-1] |= ~new[1:] & (reach < len(h)) & (h[np.minimum(reach, len(h) - 1)] == value[:-1])
    some = np.concatenate(([0], np.cumsum(again)))
    begin = starts[first]
    text = np.searchsorted(ends, begin, side="right")
    size = last - first + length - 1
    same = range_hashes(buf, begin, begin + size)
    return text, begin - (ends - sizes)[text], size, value[first], same, some[last] > some[first]


def collection_bwt(symbol: np.ndarray, begin: np.ndarray, step: int, count: np.ndarray, end: int) -> np.ndarray:
    """The Burrows-Wheeler transform of a collection of documents.

    Document d has ``count[d]`` symbols ``symbol[begin[d] + step * t]``. Round j
    inserts the suffix of length j of every document that has one: the order of
    the symbols in the transform so far gives the places. Rows 0, 1, ... are the
    empty suffixes, in the order of the documents; ``end``, larger than all
    symbols, stands before a document's first symbol.
    """
    m, most = len(begin), int(count.max(initial=0))
    row = np.arange(m)
    bwt = symbol[begin + step * np.maximum(count - 1, 0)]
    bwt[count == 0] = end
    for j in range(1, most + 1):
        active = np.flatnonzero(count >= j)
        at = _places(bwt, m, end)[1][row[active]]
        fresh = np.zeros(len(bwt) + len(active), dtype=bool)
        fresh[at] = True
        grown = np.empty(len(fresh), dtype=bwt.dtype)
        grown[~fresh] = bwt
        before = count[active] - j - 1
        grown[at] = np.where(before >= 0, symbol[begin[active] + step * np.maximum(before, 0)], end)
        row[active], bwt = at, grown
    return bwt


def _places(bwt: np.ndarray, m: int, end: int) -> tuple[np.ndarray, np.ndarray]:
    """The rows in the order of their symbols, and for each row that of the suffix that its symbol begins."""
    order = np.argsort(bwt, kind="stable")
    order = order[: len(order) - np.count_nonzero(bwt == end)]
    place = np.empty(len(bwt), dtype=np.int64)
    place[order] = m + np.arange(len(order))
    return order, place


def common_prefix_groups(bwt: np.ndarray, order: np.ndarray, m: int, length: int) -> np.ndarray:
    """For each row the number of the group of neighbours whose common prefix has ``length`` symbols.

    Round h knows where the common prefix of a row and the one before is
    shorter than h: where their first symbols differ, or it was shorter than
    h - 1 somewhere between the rows of their tails.
    """
    differ = bwt[order[1:]] != bwt[order[:-1]]
    shorter = np.ones(len(bwt), dtype=bool)
    shorter[m + 1 :] = differ
    for _ in range(length - 1):
        upto = np.cumsum(shorter, dtype=np.int32)[order]
        shorter[m + 1 :] = differ | (upto[1:] != upto[:-1])
    return np.cumsum(shorter)


def repeated(texts: list[bytes], ids: np.ndarray, starts: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """(text number, offset) of the windows of ``length`` bytes that also start earlier, by (id, position).

    Symbols are units of up to 4 bytes, and a text is one document for each
    offset of its first unit: fewer rounds, and every window still is a suffix.
    """
    unit = next(u for u in (4, 2, 1) if length % u == 0)
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    base = np.cumsum(sizes) - sizes
    buf = np.frombuffer(b"".join(texts) + bytes(unit), dtype=np.uint8)
    code = np.zeros(len(buf) - unit, dtype=np.uint32)
    for u in range(unit):
        code = code * np.uint32(256) + buf[u : len(buf) - unit + u]
    known, symbol = np.unique(code, return_inverse=True)
    end = len(known)
    symbol = symbol.astype(np.uint16 if end < 1 << 16 else np.uint32)
    text, shift = (x.ravel() for x in np.meshgrid(np.arange(len(texts)), np.arange(unit), indexing="ij"))
    some = sizes[text] - shift >= length
    text, shift = text[some], shift[some]
    count, begin, m = (sizes[text] - shift) // unit, base[text] + shift, len(text)
    bwt = collection_bwt(symbol, begin, unit, count, end)
    order, place = _places(bwt, m, end)
    group = common_prefix_groups(bwt, order, m, length // unit)
    row, who, found = np.arange(m), [], []
    for j in range(1, int(count.max(initial=0)) + 1):  # the row of every suffix, from the shortest on
        active = np.flatnonzero(count >= j)
        row[active] = place[row[active]]
        if j >= length // unit:
            who.append(np.stack([text[active], shift[active] + unit * (count[active] - j)]))
            found.append(group[row[active]])
    if not who:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    (text, offset), group = np.concatenate(who, axis=1), np.concatenate(found)
    rank = np.unique(ids, return_inverse=True)[1]
    place_of = (rank[text] << 32) + starts[text] + offset
    earliest = np.full(int(group.max()) + 1, np.iinfo(np.int64).max)
    np.minimum.at(earliest, group, place_of)
    later = place_of != earliest[group]
    return text[later], offset[later]


def _removed(texts: list[bytes], ids: np.ndarray, starts: np.ndarray, length: int) -> pa.RecordBatch:
    """Ranges of bytes (id, start, end) that the repeated windows of some fragments cover."""
    text, offset = repeated(texts, ids, starts, length)
    order = np.lexsort((offset, text))
    text, offset = text[order], offset[order]
    new = np.ones(len(text), dtype=bool)
    new[1:] = (text[1:] != text[:-1]) | (offset[1:] != offset[:-1] + 1)
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(text))[: len(first)] - 1
    who, begin = text[first], starts[text[first]]
    return pa.RecordBatch.from_arrays(
        [pa.array(ids[who]), pa.array(begin + offset[first]), pa.array(begin + offset[last] + length)], names=["id", "start", "end"]
    )


def remove_repeats(df: DataFrame, text_col: str = "text", id_col: str = "doc_id", length: int = 100) -> DataFrame:
    """Rows (``id_col``, n_bytes, spans, kept), one for each row of ``df``.

    ``spans`` lists the maximal removed ranges (start, end) of the text's UTF-8
    bytes, and ``kept`` is what is left. A byte is removed if a string of
    ``length`` bytes covering it also starts earlier: in a row of smaller id,
    or before in the same text; strings are judged on the input and never
    cross rows. Null texts are empty; texts shorter than ``length`` stay
    whole; an id names one text, so repeated rows get one answer each, the
    same; rows without an id are kept whole and remove nothing. An empty table
    gives no rows; other columns are not read. Ids are integers.
    """
    if length <= GRAM or length > 127:
        raise ValueError(f"length must be in {GRAM + 1}..127")
    rows = pick(df, id=id_col, text=text_col)
    kind = rows.schema["id"].dataType
    docs = rows.where(F.col("id").isNotNull()).select(F.col("id").cast("bigint").alias("id"), "text")

    def cut_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ("value", "same", "id", "start", "size", "rep")
        for batch in batches:
            for part, texts in slices(batch, "text", 400_000):
                text, start, size, value, same, rep = fragments([t.encode() for t in texts], length)
                numbers = (pa.array(start.astype(np.int32)), pa.array(size.astype(np.int32)), pa.array(rep))
                ids = part.column(0).take(pa.array(text))
                yield pa.RecordBatch.from_arrays([*(pa.array(h.view(np.int64)) for h in (value, same)), ids, *numbers], names=names)

    places = docs.mapInArrow(cut_up, T.StructType.fromDDL("value bigint, same bigint, id bigint, start int, size int, rep boolean"))
    seen = places.groupBy("value").agg(F.count("*").alias("n"), F.max("rep").alias("any")).where((F.col("n") > 1) | F.col("any"))
    wanted = stored(places.join(seen.select("value"), "value", "left_semi"), "fragments")
    gone, firsts = _classes(wanted)
    # A text's fragments are no more than its bytes.
    firsts = firsts.groupBy("id").agg(F.collect_set(F.struct("value", "start", "size", "size_of")).alias("frags"))

    def cut_out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ("value", "id", "start", "frag", "size_of")
        for batch in batches:
            for part, texts in slices(batch, "text", 400_000):
                lists = part.column(2)
                owner = np.repeat(np.arange(part.num_rows), np.diff(lists.offsets.to_numpy()))
                raw = [t.encode() for t in texts]
                value, start, size, size_of = (lists.flatten().field(i) for i in range(4))
                frag = [raw[d][a : a + n] for d, a, n in zip(owner.tolist(), start.to_pylist(), size.to_pylist())]
                ids = part.column(0).take(pa.array(owner))
                yield pa.RecordBatch.from_arrays([value, ids, start, pa.array(frag, pa.binary()), size_of], names=names)

    cut_type = T.StructType.fromDDL("value bigint, id bigint, start int, frag binary, size_of bigint")
    mixed = stored(docs.join(firsts, "id").select("id", "text", "frags").mapInArrow(cut_out, cut_type), "mixed")

    def cut_again(level: int):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            names = ("value", "same", "id", "start", "size", "rep", "frag")
            for batch in (b.slice(at, 1000) for b in batches for at in range(0, b.num_rows, 1000)):
                raw = batch.column(3).to_pylist()
                text, start, size, value, same, rep = fragments(raw, length, level) if level < LEVELS else windows(raw, length)
                old = batch.column(0).to_numpy().view(np.uint64)[text]
                value = (value + old * _POWER) ^ (old >> np.uint64(31))
                own = batch.column(2).to_numpy()[text] + start
                frag = [raw[d][a : a + n] for d, a, n in zip(text.tolist(), start.tolist(), size.tolist())]
                ids, numbers = batch.column(1).take(pa.array(text)), (pa.array(x.astype(np.int32)) for x in (own, size))
                hashes = (pa.array(h.view(np.int64)) for h in (value, same))
                yield pa.RecordBatch.from_arrays([*hashes, ids, *numbers, pa.array(rep), pa.array(frag, pa.binary())], names=names)

        return run

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Whole groups of a minimizer, as many as make up a batch; equal windows of two groups cannot be."""
        held: list[pa.RecordBatch] = []
        symbols = 0

        def done() -> pa.RecordBatch:
            table = pa.Table.from_batches(held)
            return _removed(table["frag"].to_pylist(), table["id"].to_numpy(), table["start"].to_numpy().astype(np.int64), length)

        last = None
        for batch in batches:
            value = batch.column(0).to_numpy()
            edges = np.flatnonzero(value[1:] != value[:-1]) + 1
            begin = 0
            for end in [*edges.tolist(), len(value)] if len(value) else []:
                if symbols >= BATCH_SYMBOLS and value[begin] != last:
                    yield done()
                    held, symbols = [], 0
                held.append(batch.slice(begin, end - begin))
                symbols += (end - begin) * (2 * length - GRAM)
                last, begin = value[begin], end
        if held:
            yield done()

    ranges = T.StructType.fromDDL("id bigint, start bigint, `end` bigint")
    again_type = T.StructType.fromDDL("value bigint, same bigint, id bigint, start int, size int, rep boolean, frag binary")
    level = 0
    while mixed is not None:
        # Groups of very many different fragments are cut again; what is equal is aggregated anew. Single windows,
        # the last cut, are equal or different as a whole: hardly any group is left to compare after them.
        most = HOT_CLASSES if level < LEVELS else 1 << 62
        hot = mixed.where(F.col("size_of") > most)
        near = mixed.where(F.col("size_of") <= most).drop("size_of")
        gone = gone.unionByName(near.repartition("value").sortWithinPartitions("value").mapInArrow(compare, ranges))
        mixed = None
        if hot.limit(1).count():
            level += 1
            again = stored(hot.drop("size_of").mapInArrow(cut_again(level), again_type), "again")
            whole, firsts = _classes(again.drop("frag"))
            gone = gone.unionByName(whole)
            mixed = again.select("value", "id", "start", "frag").join(firsts.drop("size"), ["value", "id", "start"])
            mixed = stored(mixed.select(cut_type.names), "mixed")
    gone = gone.groupBy("id").agg(F.collect_set(F.struct("start", "end")).alias("gone"))

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ("id", "n_bytes", "spans", "kept")
        for batch in batches:
            for part, texts in slices(batch, "text"):
                spans, kept, n = [], [], []
                for text, gone in zip(texts, part.column(2).to_pylist()):
                    raw = text.encode()
                    n.append(len(raw))
                    spans.append(_merged(gone or []))
                    edges = [0, *(x for s in spans[-1] for x in (s["start"], s["end"])), len(raw)]
                    kept.append(b"".join(raw[a:b] for a, b in zip(edges[::2], edges[1::2])) if gone else raw)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(n, pa.int64()), pa.array(spans, spans_type), pa.array(kept, pa.binary())], names=names
                )

    spans_type = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
    out = T.StructType.fromDDL("id bigint, n_bytes bigint, spans array<struct<start:bigint,`end`:bigint>>, kept binary")
    ended = docs.join(gone, "id", "left").select("id", "text", "gone")
    bare = rows.where(F.col("id").isNull()).select(F.col("id").cast("bigint").alias("id"), "text")
    result = ended.unionByName(bare.withColumn("gone", F.lit(None).cast(gone.schema["gone"].dataType))).mapInArrow(keep, out)
    return result.select(F.col("id").cast(kind).alias(id_col), "n_bytes", "spans", "kept")


def _classes(frags: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Of fragments (value, same, id, start, size, rep): ranges that are repeats as a whole, and firsts to compare.

    Equal fragments (their minimizer and hash make 128 bits) are one class: all
    but its first occurrence are repeats as a whole. First occurrences (value,
    id, start, size, size_of) are to be compared where a minimizer has several
    classes, ``size_of``, or a window may repeat inside.
    """
    first = F.min(F.struct("id", "start", "size")).alias("first")
    classes = stored(frags.groupBy("value", "same").agg(first, F.max("rep").alias("rep"), F.count("*").alias("n")), "classes")
    several = classes.where("n > 1").select("value", "same", "first")
    whole = frags.join(several, ["value", "same"]).where(F.struct("id", "start", "size") > F.col("first"))
    whole = whole.select("id", F.col("start").cast("bigint").alias("start"), (F.col("start") + F.col("size")).cast("bigint").alias("end"))
    groups = classes.groupBy("value").agg(F.count("*").alias("size_of"), F.max("rep").alias("any"))
    groups = groups.where((F.col("size_of") > 1) | F.col("any")).drop("any")
    firsts = classes.join(groups, "value").select("value", "first.*", "size_of")
    return whole, firsts


def _merged(ranges: list[dict]) -> list[dict]:
    """Maximal ranges of the union."""
    out: list[dict] = []
    for r in sorted(ranges, key=lambda r: (r["start"], r["end"])):
        if out and r["start"] <= out[-1]["end"]:
            out[-1]["end"] = max(out[-1]["end"], r["end"])
        else:
            out.append(dict(r))
    return out
