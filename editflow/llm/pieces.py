"""SentencePiece encoding and decoding by a shared-prefix Viterbi.

The distinct marked words of a chunk of texts are sorted, which is a
depth-first walk over their trie: the forward states of the prefix that a word
shares with the one before it are kept, and only the rest is computed. For a
byte-pair model all words go down their trie together, and the states of a
depth are computed at once; few long words are walked one by one. Words are
then replaced by their ids.

For a unigram model a state is the best sum of piece scores up to a place. The
sums do not give a byte-pair model's ids. There the state is the last piece of
the prefix's own encoding: it is the one piece that may stand after the
encoding of what comes before it, because two pieces stand side by side only
if merging their characters by score leads back to them.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Iterator
from dataclasses import dataclass, field
from math import inf

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import give_back, pick, slices

SPACE = "▁"
#: No piece goes on from a letter into a marked space, or holds a line end (``load`` sees to both), so a text's best
#: segmentation is that of its marked words.
_WORDS = re.compile(f"{SPACE}+[^{SPACE}\n]*|\n|[^{SPACE}\n]+")
CACHED_WORDS, CACHED_PAIRS = 200_000, 150_000
#: Words that go down together keep whether a piece may follow another in 2 ** PAIR_BITS places, the newer one where two meet.
PAIR_BITS = 19
#: Words go down their trie together while at least so many are as long, and up to so many code points of words at once.
TOGETHER, TRIE_CHARS = 32, 500_000
#: Code points of text that are encoded together: the more, the fewer words are looked up again.
ENCODED_CHARS = 1_000_000
MODEL = "/opt/tokenizers/piece_bpe_32k.model"
MODEL_LIMIT = 64 << 20


def marked_words(text: str) -> str:
    """The words of a text with its spaces marked, a line end being one, joined by spaces; some may be empty."""
    if not text:
        return ""
    if "  " in text or text[0] == " " or SPACE in text:
        return " ".join(_WORDS.findall(SPACE + text.replace(" ", SPACE)))
    return SPACE + text.replace(" ", " " + SPACE).replace("\n", " \n ")


@dataclass
class Merging:
    """How a byte-pair model's pieces come about: which symbols (pieces, and characters that are none) merge, and each piece's own merges.

    ``begin`` has the first step of a piece by its id; a step has the ``first`` and ``last`` symbol
    and the score of the ``next`` merge, none (-inf) at the end, where a piece ``stands`` if it is one symbol.
    """

    pairs: np.ndarray  # first << 31 | second, sorted
    score: np.ndarray
    begin: np.ndarray
    first: np.ndarray
    last: np.ndarray
    next: np.ndarray
    stands: np.ndarray


@dataclass
class Pieces:
    """The pieces of a model file: (id, score) of each text piece, ids of the byte pieces, bytes of every id."""

    scores: dict[str, tuple[int, float]]
    byte_ids: list[int]
    bytes_of: list[bytes]
    unk_id: int
    unk_score: float
    longest: int
    merges: bool
    known: dict[str, int] = field(default_factory=dict)
    # Pairs of pieces, the second of which may or may not follow the first.
    beside: dict[int, bool] = field(default_factory=dict)
    # The trie of the reversed pieces: sorted (place << 21 | character) and the place each leads to; the piece that ends at a place, or -1.
    steps: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))
    leads: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int32))
    piece_at: np.ndarray = field(default_factory=lambda: np.full(1, -1, np.int32))
    merging: Merging | None = None
    # Pairs that words which go down together asked for: twice the pair's key, and one more if the second may follow; -1 where there is none.
    pairs: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))
    # The words seen: their number, and where each one's ids begin and how many they are.
    number: dict[str, int] = field(default_factory=dict)
    ids: array = field(default_factory=lambda: array("i"))
    begin: array = field(default_factory=lambda: array("q"))
    size: array = field(default_factory=lambda: array("q"))

    def prepared(self) -> Pieces:
        """These, with what words that go down their trie together need, if the model merges."""
        if not self.merges or not self.known or self.merging:
            return self
        steps, piece_at = {}, [-1]
        for piece, i in self.known.items():
            place = 0
            for char in reversed(piece):
                place = steps.setdefault(place << 21 | ord(char), len(piece_at))
                if place == len(piece_at):
                    piece_at.append(-1)
            piece_at[place] = i
        self.steps = np.array(sorted(steps), np.int64)
        self.leads = np.array([steps[k] for k in self.steps.tolist()], np.int32)
        self.piece_at = np.array(piece_at, np.int32)
        symbol = dict(self.known)
        for piece in self.known:
            for char in piece:
                symbol.setdefault(char, len(self.bytes_of) + len(symbol))
        pairs = {}
        begin, stands = np.zeros(len(self.bytes_of), np.int64), np.zeros(len(self.bytes_of), bool)
        first, last, after = array("q"), array("q"), array("d")
        for piece, i in self.known.items():
            for k in range(1, len(piece)):
                if (x := symbol.get(piece[:k])) is not None and (y := symbol.get(piece[k:])) is not None:
                    pairs[x << 31 | y] = self.scores[piece][1]
            begin[i], symbols = len(first), list(piece)
            for score, symbols in self._merges(symbols):
                first.append(symbol[symbols[0]])
                last.append(symbol[symbols[-1]])
                after.append(score)
            stands[i] = len(symbols) == 1
        keys = np.array(sorted(pairs) or [-1], np.int64)
        scores = np.array([pairs.get(k, -inf) for k in keys.tolist()])
        self.merging = Merging(keys, scores, begin, np.array(first), np.array(last), np.array(after), stands)
        return self

    def learn(self, words: set[str]) -> None:
        """Encode some new words; forward states are shared along common prefixes of the sorted words."""
        ordered = sorted(words)
        if len(ordered) < TOGETHER or not self.merges or not self.prepared().merging:
            return self._learn_singly(ordered)
        length = np.fromiter(map(len, ordered), np.int64, len(ordered))
        most = min(int(np.partition(length, -TOGETHER)[-TOGETHER]), TRIE_CHARS)
        if int(length.max()) > most:
            self._learn_singly([w for w in ordered if len(w) > most])
            ordered = [w for w in ordered if len(w) <= most]
            length = length[length <= most]
        block = np.cumsum(length) // TRIE_CHARS
        edges = [0, *(np.flatnonzero(block[1:] != block[:-1]) + 1).tolist(), len(ordered)]
        for begin, end in zip(edges[:-1], edges[1:]):
            self._learn_together(ordered[begin:end], length[begin:end])

    def _learn_singly(self, ordered: list[str]) -> None:
        """Sorted words one after another."""
        best, back, last, before = [0.0], [0], [-2], ""
        extend = self._by_merges if self.merges else self._by_scores
        for word in ordered:
            shared, n = 0, len(word)
            for x, y in zip(before, word):
                if x != y:
                    break
                shared += 1
            del best[shared + 1 :], back[shared + 1 :], last[shared + 1 :]
            extend(word, shared + 1, best, back, last)
            ids, end = [], n
            while end:
                begin = back[end]
                ids += [last[end]] if last[end] >= 0 else self._fallback(word[begin:end])
                end = begin
            ids.reverse()
            self.number[word] = len(self.begin)
            self.begin.append(len(self.ids))
            self.size.append(len(ids))
            self.ids.extend(ids)
            before = word

    def _learn_together(self, ordered: list[str], length: np.ndarray) -> None:
        """Sorted words, one depth of their trie after another; its root is place 0, and a prefix comes after those it begins with."""
        chars = np.frombuffer("".join(ordered).encode("utf-32-le"), np.int32)
        start, at, alive = np.cumsum(length) - length, np.zeros(len(ordered), np.int32), np.arange(len(ordered))
        parent, char, back, last, width, total = (np.zeros(len(chars) + 1, np.int32) for _ in range(6))
        last[0], end = -2, 1
        for depth in range(int(length.max())):
            alive = alive[length[alive] > depth]
            before, c = at[alive], chars[start[alive] + depth]
            new = np.ones(len(alive), bool)
            new[1:] = (before[1:] != before[:-1]) | (c[1:] != c[:-1])
            at[alive] = end + np.cumsum(new) - 1
            first, end = end, end + int(np.count_nonzero(new))
            parent[first:end], char[first:end] = before[new], c[new]
            self._by_merges_together(first, end, parent, char, back, last)
            wide = char[first:end] if self.byte_ids else np.zeros(end - first, np.int32)
            wide = np.where(last[first:end] < 0, wide, 0)
            width[first:end] = 1 + (wide > 0x7F) + (wide > 0x7FF) + (wide > 0xFFFF)
            total[first:end] = total[back[first:end]] + width[first:end]
        size = total[at].astype(np.int64)
        put = np.cumsum(size)
        ids, begin, odd, odd_at = np.empty(int(put[-1]), np.int32), put - size, [], []
        while True:  # from the last pieces to the first
            put, at = put[at > 0], at[at > 0]
            if not len(at):
                break
            put = put - width[at]
            ids[put] = last[at]
            odd.append(char[at[last[at] < 0]])
            odd_at.append(put[last[at] < 0])
            at = back[at]
        if odd and len(found := np.concatenate(odd)):
            distinct, which = np.unique(found, return_inverse=True)
            codes = [self._fallback(chr(c))[::-1] for c in distinct.tolist()]
            place, n = np.concatenate(odd_at), np.array([len(x) for x in codes])[which]
            for k in range(max(map(len, codes))):
                ids[place[n > k] + k] = np.array([x[k] if len(x) > k else 0 for x in codes], np.int32)[which[n > k]]
        self.number.update(zip(ordered, range(len(self.begin), len(self.begin) + len(ordered))))
        self.begin.frombytes((begin + len(self.ids)).tobytes())
        self.size.frombytes(size.tobytes())
        self.ids.frombytes(ids.tobytes())

    def _by_merges_together(self, first: int, end: int, parent: np.ndarray, char: np.ndarray, back: np.ndarray, last: np.ndarray) -> None:
        """What ``_by_merges`` finds for the places from ``first`` on: where the last piece begins, and that piece."""
        back[first:end], last[first:end] = parent[first:end], -1
        place = begin = np.arange(first, end)
        suffix = np.zeros(end - first, np.int64)  # how far the reversed text is a reversed piece's beginning
        while len(place):
            step = suffix << 21 | char[begin]
            found = np.minimum(np.searchsorted(self.steps, step), len(self.steps) - 1)
            goes = self.steps[found] == step
            place, begin, suffix = place[goes], parent[begin[goes]], self.leads[found[goes]].astype(np.int64)
            piece = self.piece_at[suffix]
            some = np.flatnonzero(piece >= 0)
            some = some[self._follow(last[begin[some]], piece[some])]
            back[place[some]], last[place[some]] = begin[some], piece[some]
            goes = begin > 0
            goes[some] = False
            place, begin, suffix = place[goes], begin[goes], suffix[goes]

    def _follow(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """``_may_follow`` of pairs of ids, those known from ``pairs``; below 0 on the left is no piece."""
        if not len(self.pairs):
            self.pairs = np.full(1 << PAIR_BITS, -1, np.int64)
        key = np.maximum(left, -1).astype(np.int64) + 1 << 31 | right
        slot = (key.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(64 - PAIR_BITS)).astype(np.int64)
        held = self.pairs[slot]
        miss = np.flatnonzero(held >> 1 != key)
        if len(miss):
            held[miss] = key[miss] << 1 | self._may_follow_together(left[miss], right[miss])
            self.pairs[slot[miss]] = held[miss]
        return (held & 1).astype(bool)

    def _may_follow_together(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """``_may_follow`` of pairs of ids: the merges inside of each, the higher score first, unless one across comes before."""
        merging = self.merging
        fits = merging.stands[right] & ((left < 0) | merging.stands[left])
        pair = np.flatnonzero(fits & (left >= 0))
        x, y = merging.begin[left[pair]], merging.begin[right[pair]]
        while len(pair):
            key = merging.last[x] << 31 | merging.first[y]
            found = np.minimum(np.searchsorted(merging.pairs, key), len(merging.pairs) - 1)
            across = np.where(merging.pairs[found] == key, merging.score[found], -np.inf)
            of_x, of_y = merging.next[x], merging.next[y]
            bad = (across > of_x) & (across >= of_y)  # of equal scores the first place comes first
            fits[pair[bad]] = False
            on = ~bad & (np.maximum(of_x, of_y) > -np.inf)
            in_x = of_x >= of_y
            pair, x, y = pair[on], (x + in_x)[on], (y + ~in_x)[on]
        return fits

    def _by_scores(self, word: str, first: int, best: list, back: list, last: list) -> None:
        """States from ``first`` on: the best sum of scores of the pieces so far; a tie goes to the longer last piece."""
        for end in range(first, len(word) + 1):
            top, at, piece = best[end - 1] + self.unk_score, end - 1, -1
            for begin in range(end - 1, max(-1, end - self.longest - 1), -1):
                found = self.scores.get(word[begin:end])
                if found and best[begin] + found[1] >= top:
                    top, at, piece = best[begin] + found[1], begin, found[0]
            best.append(top)
            back.append(at)
            last.append(piece)

    def _by_merges(self, word: str, first: int, best: list, back: list, last: list) -> None:
        """States from ``first`` on: the last piece of the prefix's encoding, the one that may follow that of what is before it."""
        get, beside, longest = self.known.get, self.beside, self.longest
        fits_of = beside.get
        for end in range(first, len(word) + 1):
            at, piece, begin, low = end - 1, -1, end, max(0, end - longest)
            while begin > low:
                begin -= 1
                found = get(word[begin:end])
                if found is not None:
                    key = (last[begin] + 2) << 32 | found
                    fits = fits_of(key)
                    if fits is None:
                        fits = self._may_follow(word[back[begin] : begin] if last[begin] >= 0 else "", word[begin:end])
                        if len(beside) > CACHED_PAIRS:
                            beside.clear()
                        beside[key] = fits
                    if fits:
                        at, piece = begin, found
                        break
            back.append(at)
            last.append(piece)

    def _may_follow(self, left: str, right: str) -> bool:
        """Whether merging the characters of both, the highest score first, ends in just these two pieces."""
        for _, symbols in self._merges(list(left + right)):
            pass
        return symbols == ([left, right] if left else [right])

    def _merges(self, symbols: list[str]) -> Iterator[tuple[float, list[str]]]:
        """The symbols before each merge, the highest score first, and its score; at the end -inf and what is left."""
        while True:
            pairs = [(self.scores[symbols[i] + symbols[i + 1]][1], -i) for i in range(len(symbols) - 1) if symbols[i] + symbols[i + 1] in self.scores]
            if not pairs:
                yield -inf, symbols
                return
            score, i = max(pairs)
            yield score, symbols
            symbols[-i : 2 - i] = [symbols[-i] + symbols[1 - i]]

    def _fallback(self, char: str) -> list[int]:
        """Ids of an unknown character's bytes, last first."""
        return [self.byte_ids[b] for b in reversed(char.encode())] if self.byte_ids else [self.unk_id]

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one after another, and the number of ids of each."""
        marked = pc.split_pattern(pa.array([marked_words(t) for t in texts], pa.large_string()), " ")
        coded = marked.flatten().dictionary_encode()
        distinct = coded.dictionary.to_pylist()
        if len(self.number) + len(distinct) > CACHED_WORDS:
            self.number.clear()
            self.ids, self.begin, self.size = array("i"), array("q"), array("q")
        self.learn(set(distinct) - self.number.keys())
        number = np.fromiter(map(self.number.__getitem__, distinct), np.int64, len(distinct))
        at = number[coded.indices.to_numpy()]
        flat, begin, size = (np.array(x) for x in (self.ids, self.begin, self.size))
        sizes = size[at]
        ends = np.cumsum(sizes)
        ids = flat[np.repeat(begin[at] - (ends - sizes), sizes) + np.arange(int(sizes.sum()))]
        bounds = np.concatenate(([0], ends))[marked.offsets.to_numpy()]
        return ids.astype(np.int32), np.diff(bounds)

    def decode(self, ids: np.ndarray, sizes: np.ndarray) -> list[str]:
        """Texts of ids one after another: invalid bytes become U+FFFD, ids out of range and control pieces nothing."""
        space = SPACE.encode()
        pool = [b.replace(space, b" ") for b in self.bytes_of] + [b""]
        length = np.fromiter(map(len, pool), np.int64, len(pool))
        begin = np.cumsum(length) - length
        marks = np.array([b.startswith(space) for b in self.bytes_of] + [False])
        ids = np.where((ids >= 0) & (ids < len(self.bytes_of)), ids, len(self.bytes_of))
        n = length[ids]
        ends = np.cumsum(n)
        raw = np.frombuffer(b"".join(pool), dtype=np.uint8)[np.repeat(begin[ids] - (ends - n), n) + np.arange(int(n.sum()))]
        edges = np.cumsum(sizes)
        first = np.minimum(edges - sizes, max(len(ids) - 1, 0))
        lead = (sizes > 0) & (marks[ids[first]] if len(ids) else False)  # the space before the first word was added
        bounds = np.concatenate(([0], ends))
        spans = zip((bounds[edges - sizes] + lead).tolist(), bounds[edges].tolist())
        return [raw[a:b].tobytes().decode("utf-8", "replace") for a, b in spans]


def load(path: str = MODEL) -> Pieces:
    """Read the pieces of a SentencePiece model file (read on the driver; at most ``MODEL_LIMIT`` bytes)."""
    from sentencepiece import sentencepiece_model_pb2 as model_pb2

    with open(path, "rb") as file:
        raw = file.read(MODEL_LIMIT + 1)
    if len(raw) > MODEL_LIMIT:
        raise ValueError(f"{path} is larger than {MODEL_LIMIT} bytes")
    model = model_pb2.ModelProto.FromString(raw)
    norm = model.normalizer_spec
    if norm.precompiled_charsmap or norm.remove_extra_whitespaces or not norm.add_dummy_prefix or not norm.escape_whitespaces:
        raise ValueError("only models with identity normalisation and a dummy prefix are supported")
    kind = model_pb2.ModelProto.SentencePiece
    scores, byte_ids, bytes_of, unk = {}, {}, [], 0
    for i, p in enumerate(model.pieces):
        bytes_of.append(b"")
        if p.type in (kind.NORMAL, kind.USER_DEFINED):
            scores[p.piece] = (i, float(p.score))
            bytes_of[i] = p.piece.encode()
            if re.search(f"[^{SPACE}]{SPACE}|\n", p.piece):
                raise ValueError(f"piece {p.piece!r} spans words")
        elif p.type == kind.BYTE:
            byte_ids[int(p.piece[3:5], 16)] = i
            bytes_of[i] = bytes([int(p.piece[3:5], 16)])
        elif p.type == kind.UNKNOWN:
            unk, bytes_of[i] = i, " ⁇ ".encode()
    worst = min([0.0, *(s for _, s in scores.values())])
    all_bytes = [byte_ids[b] for b in range(256)] if len(byte_ids) == 256 else []
    merges = model.trainer_spec.model_type == model_pb2.TrainerSpec.BPE
    known = {piece: i for piece, (i, _) in scores.items()}
    return Pieces(scores, all_bytes, bytes_of, unk, worst - 10, max([1, *map(len, scores)]), merges, known)


def encode(df: DataFrame, text_col: str = "text", id_col: str = "doc_id", model: str = MODEL) -> DataFrame:
    """Rows (``id_col``, ids), one for each row of ``df``; a null or empty text has no ids.

    Whole texts of any length are encoded; repeated rows are each encoded; an
    empty table gives no rows; other columns are not read.
    """
    rows = pick(df, id=id_col, text=text_col)
    shared = df.sparkSession.sparkContext.broadcast(load(model).prepared())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = shared.value
        for batch in batches:
            for part, texts in slices(batch, "text", ENCODED_CHARS):
                ids, sizes = pieces.encode(texts)
                offsets = pa.array(np.concatenate(([0], np.cumsum(sizes))), pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.ListArray.from_arrays(offsets, pa.array(ids, pa.int32()))], names=["id", "ids"]
                )
        give_back()

    schema = T.StructType([T.StructField("id", rows.schema["id"].dataType), T.StructField("ids", T.ArrayType(T.IntegerType()))])
    return rows.mapInArrow(run, schema).withColumnRenamed("id", id_col)


def decode(df: DataFrame, ids_col: str = "ids", id_col: str = "doc_id", model: str = MODEL) -> DataFrame:
    """Rows (``id_col``, ids, text), one for each row of ``df``; null ids give an empty text."""
    rows = pick(df, id=id_col, ids=ids_col)
    shared = df.sparkSession.sparkContext.broadcast(load(model))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = shared.value
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                lists = part.column(1)
                sizes = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False).astype(np.int64)
                ids = pc.fill_null(lists.flatten(), -1).to_numpy(zero_copy_only=False).astype(np.int64)
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(pieces.decode(ids, sizes), pa.string())], names=["id", "ids", "text"])

    schema = T.StructType([*rows.schema.fields, T.StructField("text", T.StringType())])
    return rows.mapInArrow(run, schema).withColumnsRenamed({"id": id_col, "ids": ids_col})


def normalised(text: Column) -> Column:
    """What decoding gives back: the text with U+2581 read as a space; null is empty."""
    return F.coalesce(F.translate(text, SPACE, " "), F.lit(""))
