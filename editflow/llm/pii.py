"""Personal data: base patterns and bootstrapped contextual extraction, in DataFrame functions only.

Entities that the base patterns find are the seeds. The words beside them are
lexical patterns: one word with a coarse class of what it stands beside, or
two words whatever that is. Patterns and the identifier-like tokens they stand
beside form a graph, which is scored in rounds: a pattern by the share of its
instances that are known, an instance by its patterns. Identifiers beside
high-confidence patterns that no base pattern finds are added, whatever their
length and format.

Most words beside an identifier say nothing: a number follows "of" now and then.
So a pattern also has to earn its place against all of the corpus: of all places where its words
stand, whatever is beside them, at least half must hold a known identifier.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut, pick, stored

KINDS = ("email", "ip", "card", "phone", "context")
#: A private character marks the matches; where a text holds it, another one that no pattern knows takes its place.
_MARK, _OTHER = "\ue000", "\ue001"
# The base patterns in forms that do not backtrack. A match of the email
# pattern starts where a run of its characters starts or the last match ended;
# an ip starts a run of digits; a card is a whole chain of 12 to 19 digits.
_EMAIL = r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
_IP = r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}"
_CARD = r"(?<![0-9])(?<![0-9][ -])[0-9](?:[ -]?[0-9]){11,18}+(?![ -]?[0-9])"
_PHONE = r"\+[0-9][ ().0-9-]+[0-9]"
#: Digits that make a token without an @ identifier-like.
_DIGITS = 5
#: An identifier-like token: up to four short numbers and the one that they lead to, each after one space; or a run
#: without white space that holds an @ or enough digits. Numbers with fewer digits in all are left out later.
_LEAD = r"[+(]*+[0-9]{1,4}+\)?+[ \xa0](?=[+(]*+[0-9])"
_TOKEN = rf"(?<!\S)(?:(?:{_LEAD}){{0,4}}+[+(]*+[0-9]\S*+|(?=[^\s@]*+@|(?:[^\s0-9]*+[0-9]){{{_DIGITS}}})\S++)"
_HAS_TOKEN = rf"@|(?:[0-9][^\s0-9]*+[ \xa0]?+[^\s0-9]*+){{{_DIGITS}}}"
#: The words of a pattern are runs of letters and digits within so many characters of the slot.
_WORD, _NEAR = r"[\p{L}\p{N}]+", 128
#: Slots that are counted in one scan of the texts: so many hashes are broadcast at a time.
SLOTS = 1_000_000
_EMPTY = "array<struct<start:bigint,kind:int,end:bigint,value:string>>"


def marked_spans(text: Column, pattern: str, kind: int) -> Column:
    """(start, kind, end, value) of all matches, in code points; ``text`` must not hold the mark."""
    parts = F.split(F.regexp_replace(text, pattern, _MARK + "$0" + _MARK), _MARK, -1)

    def step(acc: Column, part: Column) -> Column:
        end = acc["at"] + F.length(part)
        span = F.struct(acc["at"].alias("start"), F.lit(kind).alias("kind"), end.alias("end"), part.alias("value"))
        found = F.when(acc["inside"], F.concat(acc["found"], F.array(span))).otherwise(acc["found"])
        return F.struct(end.alias("at"), (~acc["inside"]).alias("inside"), found.alias("found"))

    start = F.struct(
        F.lit(0).cast("bigint").alias("at"), F.lit(False).alias("inside"), F.array().cast(_EMPTY).alias("found")
    )
    return F.aggregate(parts, start, step)["found"]


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _luhn(value: Column) -> Column:
    digits = _digits(value)

    def add(total: Column, i: Column) -> Column:
        d = F.substr(digits, -i, F.lit(1)).cast("int") * F.when(i % 2 == 0, 2).otherwise(1)
        return total + F.when(d > 9, d - 9).otherwise(d)

    return F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0), add) % 10 == 0


def base_spans(text: Column) -> Column:
    """Sorted (start, kind, end, value) of the base patterns in a text without the mark."""
    none = F.array().cast(_EMPTY)
    email = F.when(text.contains("@"), marked_spans(text, _EMAIL, 0)).otherwise(none)
    octets = r"^(?:0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]?[0-9])(?:\.|$)){4}$"
    ip = F.when(text.rlike(r"[0-9]\.[0-9]"), F.filter(marked_spans(text, _IP, 1), lambda s: s["value"].rlike(octets))).otherwise(none)
    card = F.when(text.rlike(r"[0-9](?:[ -]?[0-9]){11}"), F.filter(marked_spans(text, _CARD, 2), lambda s: _luhn(s["value"]))).otherwise(none)
    count = lambda s: F.length(_digits(s["value"])).between(9, 15)
    phone = F.when(text.rlike(r"\+[0-9]"), F.filter(marked_spans(text, _PHONE, 3), count)).otherwise(none)
    return F.array_sort(F.concat(email, ip, card, phone))


def _occurrences(text: Column, base: Column) -> Column:
    """Base spans, and identifier-like tokens that none overlaps, with their coarse class and the two words on either side."""

    def place(s: Column) -> Column:
        core = F.regexp_extract(s["value"], r"^[^\w+@]*+(.*?)[^\w]*$", 1)
        start = s["start"] + F.length(F.regexp_extract(s["value"], r"^[^\w+@]*+", 0))
        return F.struct(start.alias("start"), (start + F.length(core)).alias("end"), core.alias("value"), F.lit(False).alias("known"))

    def free(s: Column) -> Column:
        like = s["value"].contains("@") | (F.length(_digits(s["value"])) >= _DIGITS)
        return like & ~F.exists(base, lambda b: (b["start"] < s["end"]) & (s["start"] < b["end"]))

    def about(s: Column) -> Column:
        before = F.substr(text, F.greatest(s["start"] - (_NEAR - 1), F.lit(1)), F.least(s["start"], F.lit(_NEAR)))
        after = F.substr(text, s["end"] + 1, F.lit(_NEAR))
        words = lambda c: F.regexp_extract_all(F.lower(c), F.lit(_WORD), 0)
        kind = F.when(s["value"].contains("@"), "address").when(s["value"].rlike(r"\p{L}"), "code").otherwise("number")
        return F.struct(
            s["start"].alias("start"),
            s["end"].alias("end"),
            F.lower(s["value"]).alias("instance"),
            kind.alias("class"),
            F.slice(F.reverse(words(before)), 1, 2).alias("left"),
            F.slice(words(after), 1, 2).alias("right"),
            s["known"].alias("known"),
        )

    tokens = F.when(text.rlike(_HAS_TOKEN), marked_spans(text, _TOKEN, 4)).otherwise(F.array().cast(_EMPTY))
    seeds = F.transform(base, lambda s: F.struct(s["start"], s["end"], s["value"], F.lit(True).alias("known")))
    return F.transform(F.concat(seeds, F.filter(F.transform(tokens, place), free)), about)


#: Kinds of slots: a word; two words in a row; two words with one between them.
_ALONE, _ROW, _AROUND = 1, 2, 3


def _slot(kind: int, *words: Column) -> Column:
    return F.xxhash64(F.lit(kind), *words)


def _patterns() -> Column:
    """The patterns that an occurrence stands beside, each with the hash of the words that make its slot.

    A word and the class, two words of a side, a word of either side.
    """
    first, second = (lambda c: F.get(F.col(c), F.lit(0))), (lambda c: F.get(F.col(c), F.lit(1)))
    one = [(F.concat(F.lit(f"{c} "), first(c), F.lit(" "), F.col("class")), _slot(_ALONE, first(c))) for c in ("left", "right")]
    two = [
        (F.concat(F.lit("two left "), first("left"), F.lit(" "), second("left")), _slot(_ROW, second("left"), first("left"))),
        (F.concat(F.lit("two right "), first("right"), F.lit(" "), second("right")), _slot(_ROW, first("right"), second("right"))),
    ]
    around = (F.concat(F.lit("between "), first("left"), F.lit(" "), first("right")), _slot(_AROUND, first("left"), first("right")))
    every = [F.struct(name.alias("pattern"), slot.alias("slot")) for name, slot in (*one, *two, around)]
    return F.filter(F.array(*every), lambda p: p["pattern"].isNotNull())


def slot_counts(texts: DataFrame, slots: DataFrame) -> DataFrame:
    """(slot, places): how often the words of each of ``slots`` stand in all texts, whatever is beside them.

    The hashes that are asked for are broadcast, :data:`SLOTS` at a time; each
    such part is one scan, and only counts are shuffled.
    """
    slots = cut(slots.distinct())
    parts = max(1, -(-slots.count() // SLOTS))
    words = texts.select(F.split(F.lower("text"), r"[^\p{L}\p{N}]+").alias("w"))
    after = lambda n: F.slice("w", F.lit(n + 1), F.greatest(F.size("w") - n, F.lit(0)))
    alone = F.transform("w", lambda a: _slot(_ALONE, a))
    rows = F.zip_with("w", after(1), lambda a, b: _slot(_ROW, a, b))
    around = F.zip_with("w", after(2), lambda a, b: _slot(_AROUND, a, b))
    places = words.select(F.explode(F.concat(alone, rows, around)).alias("slot"))
    out = None
    for part in range(parts):
        mine = F.pmod("slot", F.lit(parts)) == part
        wanted, some = (slots, places) if parts == 1 else (slots.where(mine), places.where(mine))
        counts = some.join(F.broadcast(wanted), "slot", "left_semi").groupBy("slot").agg(F.count(F.lit(1)).alias("places"))
        out = counts if out is None else out.unionByName(counts)
    return cut(out)


def learn_patterns(
    occurrences: DataFrame, texts: DataFrame, rounds: int = 3, support: int = 3, confidence: float = 0.8, accept: float = 0.9,
    share: float = 0.5,
) -> DataFrame:
    """High-confidence patterns of occurrences (instance, pattern, slot, known) in ``texts`` (text), as a table (pattern, score).

    In each round a pattern's confidence is the share of its distinct instances
    that are known, if at least ``support`` are and they stand in at least ``share`` of
    all places of its words; other patterns count for nothing. An instance that is not known
    becomes so when 1 - prod(1 - confidence) over its patterns reaches ``accept``.
    ``score`` is log2(known instances) times their share of all places, of the last round.
    """
    edges = cut(
        occurrences.groupBy("pattern", "slot", "instance").agg(F.max("known").alias("known"), F.count(F.lit(1)).alias("m"))
    )
    counted = patterns = None
    for _ in range(max(1, rounds)):
        scores = edges.groupBy("pattern", "slot").agg(
            F.count(F.lit(1)).alias("n"), F.count_if("known").alias("k"), F.sum(F.when(F.col("known"), F.col("m"))).alias("held")
        )
        scores = cut(scores.where(F.col("k") >= support))
        fresh = scores.select("slot") if counted is None else scores.select("slot").join(counted, "slot", "left_anti")
        if counted is None or not fresh.isEmpty():
            more = slot_counts(texts, fresh)
            counted = more if counted is None else cut(counted.unionByName(more))
        of_all = F.col("held") / F.greatest(F.col("places"), F.col("held"))
        patterns = scores.join(counted, "slot").where(of_all >= share)
        patterns = patterns.select("pattern", (F.col("k") / F.col("n")).alias("sure"), (F.log2("k") * of_all).alias("score"))
        doubt = F.sum(F.log1p(-F.least(F.coalesce("sure", F.lit(0.0)), F.lit(0.999))))
        instances = edges.join(patterns, "pattern", "left").groupBy("instance").agg(
            (F.max("known") | (1 - F.exp(doubt) >= accept)).alias("now")
        )
        edges = cut(edges.join(instances, "instance").select("pattern", "slot", "instance", F.col("now").alias("known"), "m"))
    return cut(patterns.where(F.col("sure") >= confidence).select("pattern", "score"))


def find(
    df: DataFrame,
    text_col: str = "text",
    id_col: str = "doc_id",
    rounds: int = 3,
    support: int = 3,
    confidence: float = 0.8,
    accept: float = 0.9,
) -> DataFrame:
    """Rows (``id_col``, found), one for each row of ``df``.

    ``found`` lists (kind, start, end) in code points, end exclusive, by start
    and then by kind as in ``KINDS``: the base patterns' spans, and ``context``
    spans that the bootstrapped patterns add where no base span overlaps. Null
    and empty texts have none; repeated rows are each answered (an id names one
    text); rows without an id get base spans only; an empty table gives no
    rows; other columns are not read.
    """
    scanned = _scanned(df, text_col, id_col)
    added = _context_spans(scanned, _texts(df, text_col), rounds, support, confidence, accept)
    joined = scanned.select("own", "base").join(added, F.col("own") == F.col("id"), "left")
    return joined.select(F.col("own").alias(id_col), _named(F.col("base"), F.col("added")).alias("found"))


def _clean(text: Column) -> Column:
    return F.translate(F.coalesce(text, F.lit("")), _MARK, _OTHER)


def _scanned(df: DataFrame, text_col: str, id_col: str) -> DataFrame:
    """(own, base, tokens) of each row: base spans, and them and identifier-like tokens with their words, stored."""
    base = pick(df, own=id_col, text=text_col).withColumn("text", _clean(F.col("text")))
    base = base.withColumn("base", base_spans(F.col("text")))
    return stored(base.select("own", "base", _occurrences(F.col("text"), F.col("base")).alias("tokens")), "pii")


def _texts(df: DataFrame, text_col: str) -> DataFrame:
    return pick(df, text=text_col).where(F.col("text").isNotNull())


def _occurring(scanned: DataFrame) -> DataFrame:
    """A row for each identifier-like token and pattern that it stands beside."""
    tokens = scanned.where(F.size("tokens") > 0).select(F.col("own").alias("id"), F.explode("tokens").alias("t")).select("id", "t.*")
    return tokens.select("id", "start", "end", "instance", "known", F.explode(_patterns()).alias("p")).select("*", "p.pattern", "p.slot")


def _context_spans(scanned: DataFrame, texts: DataFrame, rounds: int, support: int, confidence: float, accept: float) -> DataFrame:
    """(id, added): the spans that high-confidence patterns add to each id's text."""
    graph = _occurring(scanned)
    patterns = learn_patterns(graph.select("pattern", "slot", "instance", "known"), texts, rounds, support, confidence, accept)
    added = graph.where(~F.col("known") & F.col("id").isNotNull()).join(patterns, "pattern", "left_semi")
    return added.groupBy("id").agg(F.collect_set(F.struct("start", F.lit(4).alias("kind"), "end")).alias("added"))


def _named(base: Column, added: Column) -> Column:
    """(kind, start, end) of both kinds of spans, by start and kind."""
    plain = F.transform(base, lambda s: F.struct(s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end")))
    none = F.array().cast("array<struct<start:bigint,kind:int,end:bigint>>")
    names = F.array(*(F.lit(k) for k in KINDS))
    name = lambda s: F.struct(F.get(names, s["kind"]).alias("kind"), s["start"].alias("start"), s["end"].alias("end"))
    return F.transform(F.array_sort(F.concat(plain, F.coalesce(added, none))), name)


def mask(
    df: DataFrame,
    text_col: str = "text",
    id_col: str = "doc_id",
    rounds: int = 3,
    support: int = 3,
    confidence: float = 0.8,
    accept: float = 0.9,
) -> DataFrame:
    """The rows of ``df`` with every span that ``find`` names replaced by its kind in brackets.

    Null texts stay null. Only the few spans that patterns add are joined; the
    base spans are found again in the row. Rows without an id get base spans only.
    """
    added = _context_spans(_scanned(df, text_col, id_col), _texts(df, text_col), rounds, support, confidence, accept)
    names = {c: f"c{i}" for i, c in enumerate(df.columns)}  # the columns of df may be named like those of this function
    rows, text = pick(df, **{new: c for c, new in names.items()}), F.col(names[text_col])
    joined = rows.join(added, F.col(names[id_col]) == F.col("id"), "left")
    joined = joined.withColumn("found", _named(base_spans(_clean(text)), F.col("added")))
    joined = joined.withColumn(names[text_col], masked(text, F.col("found")))
    return joined.select(*(F.col(new).alias(c) for c, new in names.items()))


def masked(text: Column, found: Column) -> Column:
    """The text with each span replaced by its kind in brackets; overlapping spans are replaced once."""

    def step(acc: Column, s: Column) -> Column:
        new = s["start"] >= acc["at"]
        upto = F.substr(text, (acc["at"] + 1).cast("int"), (s["start"] - acc["at"]).cast("int"))
        out = F.when(new, F.concat(acc["out"], upto, F.lit("["), F.upper(s["kind"]), F.lit("]"))).otherwise(acc["out"])
        return F.struct(F.greatest(acc["at"], s["end"]).alias("at"), out.alias("out"))

    start = F.struct(F.lit(0).cast("bigint").alias("at"), F.lit("").alias("out"))
    done = F.aggregate(found, start, step)
    rest = F.concat(done["out"], F.substr(text, (done["at"] + 1).cast("int"), F.length(text)))
    return F.when(F.size(found) > 0, rest).otherwise(text)
