"""Language identification by cross-parsing entropy.

For each language a suffix automaton of a bounded sample of labelled text
accepts exactly the substrings of that sample. A text is parsed greedily into
the longest phrases each automaton accepts; a language's entropy estimate is
``phrases * log2(sample length) / text length``, and the language that needs
the fewest normalised phrases wins.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import give_back, pick, slices

UNKNOWN = "und"
#: Greedy parsing starts anew after so many code points, so that the blocks of all texts are parsed side by side.
BLOCK = 512


def suffix_automaton(codes: list[int]) -> tuple[int, np.ndarray]:
    """Number of states of the suffix automaton of ``codes`` (0 is the root), and its transitions (state, code, next state).

    There are fewer than twice as many states and three times as many
    transitions as codes, whatever the alphabet.
    """
    moves, link, length, last = [{}], [-1], [0], 0
    for c in codes:
        state = len(moves)
        moves.append({})
        link.append(0)
        length.append(length[last] + 1)
        p = last
        while p >= 0 and c not in moves[p]:
            moves[p][c] = state
            p = link[p]
        if p >= 0:
            q = moves[p][c]
            if length[q] == length[p] + 1:
                link[state] = q
            else:
                copy = len(moves)
                moves.append(dict(moves[q]))
                link.append(link[q])
                length.append(length[p] + 1)
                link[q] = link[state] = copy
                while p >= 0 and moves[p].get(c) == q:
                    moves[p][c] = copy
                    p = link[p]
        last = state
    edges = [(state, c, to) for state, out in enumerate(moves) for c, to in out.items()]
    return len(moves), np.array(edges, dtype=np.int64).reshape(-1, 3)


class Transitions:
    """Next states by key (state and code in one integer), in a hash table with at most a quarter of its places taken."""

    def __init__(self, keys: np.ndarray, to: np.ndarray):
        bits = max(4, math.ceil(math.log2(4 * len(keys) + 1)))
        self.shift, self.mask = np.uint64(64 - bits), (1 << bits) - 1
        self.keys = np.full(1 << bits, -1, dtype=np.int64)
        self.to = np.full(1 << bits, -1, dtype=np.int32)
        at, left = self._place(keys), np.arange(len(keys))
        while len(left):
            free = left[self.keys[at[left]] < 0]
            self.keys[at[free]] = keys[free]  # of several, the last one has the place
            self.to[at[free]] = to[free]
            left = left[self.keys[at[left]] != keys[left]]
            at[left] = (at[left] + 1) & self.mask

    def _place(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).astype(np.int64)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """The next state of each key, -1 = none."""
        keys, shape = keys.ravel(), keys.shape
        at = self._place(keys)
        held = self.keys[at]
        out = self.to[at]  # of an empty place: none
        left = np.flatnonzero((held != keys) & (held >= 0))
        while len(left):
            at[left] = (at[left] + 1) & self.mask
            held = self.keys[at[left]]
            out[left] = self.to[at[left]]
            left = left[(held != keys[left]) & (held >= 0)]
        return out.reshape(shape)


class CrossParser:
    """Phrase counts of texts under the suffix automata of several languages' samples."""

    def __init__(self, samples: dict[str, str]):
        self.langs = sorted(samples)
        folded = {lang: _fold(samples[lang]) for lang in self.langs}
        letters = sorted({ch for s in folded.values() for ch in s if ch.isalpha()})
        # Class 0: everything that is no letter; 1: a letter of no sample; then one class a letter.
        self.width = len(letters) + 2
        self.classes = np.zeros(0x110000, dtype=np.uint32)
        for code in range(0x110000):
            if not 0xD800 <= code < 0xE000 and chr(code).isalpha():
                self.classes[code] = 1
        for i, ch in enumerate(letters):
            self.classes[ord(ch)] = i + 2
        keys, to, base = [np.zeros(0, dtype=np.int64)], [np.zeros(0, dtype=np.int64)], 0
        self.roots = np.zeros(len(self.langs), dtype=np.int64)
        self.bits = np.zeros(len(self.langs))
        for i, lang in enumerate(self.langs):
            n_states, edges = suffix_automaton(self.encode(folded[lang]).tolist())
            keys.append((edges[:, 0] + base) * self.width + edges[:, 1])
            to.append(edges[:, 2] + base)
            self.roots[i], base = base, base + n_states
            self.bits[i] = math.log2(len(folded[lang]) + 2)
        self.moves = Transitions(np.concatenate(keys), np.concatenate(to))
        first = self.moves.find(self.roots[:, None] * self.width + np.arange(self.width))
        self.restart = np.where(first < 0, self.roots[:, None], first).astype(np.int32)
        self.unseen = (first < 0).astype(np.int32)

    def encode(self, text: str) -> np.ndarray:
        return self.classes[np.frombuffer(text.encode("utf-32-le", "replace"), dtype="<u4")]

    def entropies(self, texts: list[str]) -> np.ndarray:
        """Row = text, column = language of ``langs``: phrases * log2(sample length) per code point."""
        coded = [self.encode(_fold(t)) for t in texts]
        sizes = np.array([len(c) for c in coded], dtype=np.int64)
        codes = np.concatenate([*coded, np.zeros(0, dtype=np.uint32)])
        per = -(-sizes // BLOCK)
        owner = np.repeat(np.arange(len(texts)), per)
        k = np.arange(len(owner)) - np.repeat(np.cumsum(per) - per, per)
        begin = np.repeat(np.cumsum(sizes) - sizes, per) + k * BLOCK
        length = np.minimum(BLOCK, sizes[owner] - k * BLOCK)
        order = np.argsort(-length, kind="stable")
        owner, begin, length = owner[order], begin[order], length[order]
        active = len(length) - np.searchsorted(length[::-1], np.arange(BLOCK), side="right")
        state = np.repeat(self.roots[:, None], len(owner), axis=1)  # 64 bits, as keys are
        phrases = np.ones((len(self.langs), len(owner)), dtype=np.int32)
        for j in range(BLOCK):
            n = active[j]
            if not n:
                break
            c = codes[begin[:n] + j]
            to = self.moves.find(state[:, :n] * self.width + c)
            ends = to < 0
            phrases[:, :n] += ends
            phrases[:, :n] += ends & (self.unseen[:, c] > 0)
            state[:, :n] = np.where(ends, self.restart[:, c], to)
        total = np.zeros((len(texts), len(self.langs)))
        for i in range(len(self.langs)):
            total[:, i] = np.bincount(owner, weights=phrases[i], minlength=len(texts))
        return total * self.bits / np.maximum(sizes, 1)[:, None]


def _fold(text: str) -> str:
    return text.lower()


def learn(
    df: DataFrame,
    text_col: str = "text",
    lang_col: str = "lang",
    id_col: str = "doc_id",
    docs_per_lang: int = 40,
    chars_per_lang: int = 16_000,
    seed: int = 7,
) -> dict[str, str]:
    """A bounded sample of labelled text for each language.

    At most about ``docs_per_lang`` documents a language, chosen by a hash of
    the id, and ``chars_per_lang`` code points of them, teach it: of each an
    equal part from a hashed offset on, and more in further equal parts, to the
    end and then from the beginning, only where that falls short. Rows without a
    label, a text or a letter teach nothing; no rows give no language.
    """
    part = max(1, chars_per_lang // docs_per_lang)
    rows = pick(df, id=id_col, text=text_col, lang=lang_col).where(F.col("lang").isNotNull())
    counts = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    if not counts:
        return {}
    u = F.pmod(F.xxhash64(F.lit(seed), F.col("id").cast("string")), F.lit(1 << 40))
    share: Column = F.lit(-1.0)
    for lang, n in sorted(counts.items()):
        share = F.when(F.col("lang") == lang, F.lit(docs_per_lang / n * 2.0**40)).otherwise(share)
    wanted = F.row_number().over(Window.partitionBy("lang").orderBy("u", F.col("id").cast("string"), "text"))
    at = F.pmod(F.xxhash64(F.lit(seed), F.lit("offset"), F.col("id").cast("string")), F.greatest(F.length("text") - part + 1, F.lit(1)))
    at = at.cast("int")
    turned = F.when(at > 0, F.concat(F.substr("text", at + 1), F.lit("\n"), F.substr(F.col("text"), F.lit(1), at))).otherwise(F.col("text"))
    some = (
        rows.where((u < share) & F.col("text").rlike(r"\p{L}"))
        .select("lang", F.substring(turned, 1, chars_per_lang).alias("text"), u.alias("u"), "id")
        .withColumn("rank", wanted)
        .where(F.col("rank") <= 2 * docs_per_lang)
        .orderBy("lang", "rank")
    )
    texts: dict[str, list[str]] = {}
    for r in some.collect():
        texts.setdefault(r["lang"], []).append("\n" + r["text"])
    return {lang: "".join(_shares(of, part, chars_per_lang)) for lang, of in texts.items()}


def _shares(texts: list[str], part: int, most: int) -> list[str]:
    """The beginning of each text, in rounds of at most ``part`` more code points each until there are ``most`` in all."""
    took, left, more = [0] * len(texts), most, True
    while left and more:
        more = False
        for i, text in enumerate(texts):
            n = min(part, len(text) - took[i], left)
            took[i], left, more = took[i] + n, left - n, more or n > 0
    return [text[:n] for text, n in zip(texts, took)]


_PARSERS: dict[int, CrossParser] = {}


def identify(
    df: DataFrame, samples: dict[str, str], text_col: str = "text", id_col: str = "doc_id", carry: Sequence[str] = ()
) -> DataFrame:
    """Rows (``id_col``, lang_pred, score), one for each row of ``df``, with the columns to ``carry`` along.

    ``lang_pred`` is the language of ``samples`` whose automaton needs the
    fewest normalised phrases (ties: the first by name), and ``und`` where the
    text is null or has no letter or nothing was learned. ``score`` is 0 for
    ``und``, else one less the ratio of the best to the second-best entropy
    (1 where only one language was learned). Whole texts are parsed; repeated
    rows are each answered; an empty table gives no rows; other columns of
    ``df`` are not read.
    """
    spark = df.sparkSession
    along = {f"carried{i}": c for i, c in enumerate(carry)}
    rows = pick(df, id=id_col, text=text_col, **along).withColumn(
        "has", F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False))
    )
    kept = [f for f in rows.schema.fields if f.name not in ("text", "has")]
    places = [rows.columns.index(f.name) for f in kept]
    shared = spark.sparkContext.broadcast(samples)  # at most chars_per_lang code points a language

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key = hash(tuple(sorted(shared.value.items())))
        if key not in _PARSERS:
            _PARSERS.clear()
            _PARSERS[key] = CrossParser(shared.value)
        parser = _PARSERS[key]
        for batch in batches:
            for part, texts in slices(batch, "text"):
                has = np.array(part.column(part.num_columns - 1).to_pylist(), dtype=bool) & bool(parser.langs)
                pred, score = np.full(len(texts), UNKNOWN, dtype=object), np.zeros(len(texts))
                if has.any():
                    seen = np.flatnonzero(has)
                    e = parser.entropies([texts[i] for i in seen])
                    best = e.argmin(axis=1)
                    pred[seen] = np.array(parser.langs, dtype=object)[best]
                    if e.shape[1] > 1:
                        low = np.sort(e, axis=1)
                        score[seen] = np.clip(1 - low[:, 0] / np.maximum(low[:, 1], 1e-12), 0, 1)
                    else:
                        score[seen] = 1.0
                columns = [*(part.column(i) for i in places), pa.array(pred, pa.string()), pa.array(score)]
                yield pa.RecordBatch.from_arrays(columns, names=schema.names)
        give_back()

    schema = T.StructType(
        [*kept, T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())]
    )
    return rows.mapInArrow(judge, schema).withColumnsRenamed({"id": id_col, **along})


def held_out(id_col: str = "doc_id") -> Column:
    """Whether a document is kept from the learning: crc32 of the id as text, modulo 3, is 1."""
    return F.coalesce(F.crc32(F.col(f"`{id_col}`").cast("string").cast("binary")) % 3 == 1, F.lit(False))
