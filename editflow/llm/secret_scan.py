"""Secret scan: base patterns, and character Markov models of random strings against ordinary identifiers.

Two character bigram models, one trained on labelled random strings and one on
labelled ordinary identifiers, are compared by log-likelihood ratio on every
token of six or more characters; tokens that are likelier random by enough add
spans of kind ``markov``. A short token needs a higher mean ratio than a long one.
"""

from __future__ import annotations

import random
import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import pick, slices

KINDS = ("assign", "access", "hex", "markov")
_ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?((?-i:[A-Za-z0-9+/_.=-]+))""", re.IGNORECASE | re.ASCII
)
_ACCESS = re.compile("AKIA[A-Z0-9]+")
# The runs of [0-9a-f]+ that are long enough: a match of that pattern is always a whole run.
_HEX = re.compile("(?<![0-9a-f])[0-9a-f]{24,}")
_IDENTIFIER = re.compile("(?<![A-Za-z0-9+/_=-])(?:[A-Za-z][A-Za-z_-]{3,}|[0-9][0-9_-]{3,})(?![A-Za-z0-9+/_=-])")
_ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
_CODE = np.zeros(128, dtype=np.int64)
_CODE[[ord(c) for c in _ALPHABET]] = np.arange(1, len(_ALPHABET) + 1)  # 0 stands before the first character
#: Characters of a scored token, and what its summed ratio must exceed beyond the threshold's share of each character.
TOKEN, EVIDENCE, DIGITS_EVIDENCE = 6, 10.0, 40.0


def base_spans(text: str) -> list[tuple[int, int, int, str]]:
    """(start, index of the kind, end, secret) of the base patterns' matches."""
    out = [(m.start(), 0, m.end(), m[2]) for m in _ASSIGN.finditer(text) if len(m[2]) >= 6]
    if "AKIA" in text:
        out += [(m.start(), 1, m.end(), m[0]) for m in _ACCESS.finditer(text) if len(m[0]) >= 20]
    out += [(m.start(), 2, m.end(), m[0]) for m in _HEX.finditer(text)]
    return out


def _codes(s: str) -> np.ndarray:
    return np.concatenate(([0], _CODE[np.frombuffer(s.encode("ascii"), dtype=np.uint8)]))


class MarkovRatio:
    """Log-likelihood ratio of two character bigram models, each interpolated with its character frequencies."""

    def __init__(self, secrets: Iterable[str], ordinary: Iterable[str], weight: float = 5.0):
        logs = []
        for strings in (secrets, ordinary):
            counts = np.zeros((len(_ALPHABET) + 1,) * 2)
            for s in strings:
                c = _codes(s)
                np.add.at(counts, (c[:-1], c[1:]), 1)
            single = counts.sum(axis=0) + 0.5
            single /= single.sum()
            logs.append(np.log((counts + weight * single) / (counts.sum(axis=1, keepdims=True) + weight)))
        self.ratio = logs[0] - logs[1]

    def score(self, s: str) -> float:
        """Mean log-likelihood ratio a character: above 0, the string is likelier random."""
        c = _codes(s)
        return float(self.ratio[c[:-1], c[1:]].mean())

    def spans(self, texts: list[str], threshold: float) -> list[list[tuple[int, int]]]:
        """(start, end) of the tokens of each text that are random by enough, all characters in one step.

        A token is a longest run of letters, digits and ``+/_=-``. Its summed ratio must exceed ``threshold`` a character
        and ``EVIDENCE``, or ``DIGITS_EVIDENCE`` where it has no letter: numbers are as random as digits can be. Letters
        of one written in capitals count as lower case, as capitals by themselves say nothing.
        """
        points = np.frombuffer("\n".join([*texts, ""]).encode("utf-32-le", "replace"), dtype="<u4")
        code = _CODE[np.where(points < 128, points, 10)]
        inside = np.concatenate(([False], code > 0, [False]))
        edges = np.flatnonzero(inside[1:] != inside[:-1])
        start, end = edges[::2], edges[1::2]
        long = end - start >= TOKEN
        start, end = start[long], end[long]
        capital, small = (code > 0) & (code <= 26), (code > 26) & (code <= 52)
        digit = (code > 52) & (code <= 62)
        n_capital, n_small, n_digit = (_counts(x, start, end) for x in (capital, small, digit))
        shout = np.zeros(len(code) + 1, dtype=np.int8)
        shouted = (n_capital > 0) & (n_small == 0) & (n_digit == 0)
        shout[start[shouted]], shout[end[shouted]] = 1, -1
        code = code + 26 * (capital & (np.cumsum(shout[:-1]) > 0))
        before = np.concatenate(([0], code[:-1]))
        each = np.where(code > 0, self.ratio[before, code], 0.0)
        total = np.add.reduceat(each, np.stack([start, end], axis=1).ravel())[::2] if len(start) else np.zeros(0)
        strict = np.where(n_capital + n_small > 0, EVIDENCE, DIGITS_EVIDENCE)
        found = total > threshold * (end - start) + strict
        begin = np.concatenate(([0], np.cumsum([len(t) + 1 for t in texts], dtype=np.int64)))
        owner = np.searchsorted(begin, start[found], side="right") - 1
        out: list[list[tuple[int, int]]] = [[] for _ in texts]
        for i, a, b in zip(owner.tolist(), start[found].tolist(), end[found].tolist()):
            out[i].append((a - int(begin[i]), b - int(begin[i])))
        return out


def _counts(flags: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    total = np.concatenate(([0], np.cumsum(flags)))
    return total[end] - total[start]


def synthetic_secrets(n: int = 400, seed: int = 11) -> list[str]:
    """Labelled random strings over the alphabets in which secrets are written."""
    rng = random.Random(seed)
    alphabets = ("0123456789abcdef", _ALPHABET[:62], _ALPHABET[:64], _ALPHABET[:26] + "0123456789")
    return ["".join(rng.choices(alphabets[i % 4], k=rng.randint(16, 64))) for i in range(n)]


def train(df: DataFrame, text_col: str = "text", id_col: str = "doc_id", sample: int = 500, chars: int = 20_000) -> MarkovRatio:
    """Fit on the first ``chars`` code points of about ``sample`` documents, taken by a hash of the id.

    The base patterns label the secrets of the sample, and its words and numbers
    outside of all matches are the ordinary identifiers; generated random strings join the secrets.
    """
    rows = pick(df, id=id_col, text=text_col)
    n = rows.count()
    u = F.pmod(F.xxhash64(F.lit(3), F.col("id").cast("string")), F.lit(1 << 40))
    some = rows.where(F.col("text").isNotNull() & (u < F.lit(sample / max(n, 1) * 2.0**40)))
    texts = [r[0] for r in some.orderBy(u, F.col("id")).select(F.substring("text", 1, chars)).limit(2 * sample).collect()]
    secrets, ordinary = synthetic_secrets(), []
    for t in texts:
        found = base_spans(t)
        secrets += [s for _, _, _, s in found if re.fullmatch("[A-Za-z0-9+/_=-]{16,}", s)]
        ordinary += [m[0] for m in _IDENTIFIER.finditer(t) if not any(m.start() < b and a < m.end() for a, _, b, _ in found)]
    return MarkovRatio(secrets, ordinary or ["identifier", "password", "description"])


def scan(
    df: DataFrame, model: MarkovRatio, text_col: str = "text", id_col: str = "doc_id", threshold: float = 0.4
) -> DataFrame:
    """Rows (``id_col``, found), one for each row of ``df``.

    ``found`` lists (kind, start, end) in code points, end exclusive, by start
    and then by kind as in ``KINDS``. A token of ``TOKEN`` or more characters
    whose summed ratio exceeds ``threshold`` a character by the evidence that
    ``MarkovRatio.spans`` asks for adds a ``markov`` span. Null and empty texts
    have no spans; repeated rows are each scanned; other columns are not read.
    """
    rows = pick(df, id=id_col, text=text_col)
    shared = df.sparkSession.sparkContext.broadcast(model)  # two tables of 69 x 69 numbers

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            for part, texts in slices(batch, "text"):
                found = []
                for t, random_ in zip(texts, model.spans(texts, threshold)):
                    spans = [(start, kind, end) for start, kind, end, _ in base_spans(t)]
                    spans += [(start, 3, end) for start, end in random_]
                    found.append([{"kind": KINDS[k], "start": a, "end": b} for a, k, b in sorted(spans)])
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(found, spans_type)], names=["id", "found"])

    spans_type = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
    spans = T.ArrayType(T.StructType.fromDDL("kind string, start bigint, `end` bigint"))
    schema = T.StructType([T.StructField("id", rows.schema["id"].dataType), T.StructField("found", spans)])
    return rows.mapInArrow(run, schema).withColumnRenamed("id", id_col)
