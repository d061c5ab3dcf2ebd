"""Toxicity by noisy-channel deobfuscation.

What writers do to hide a word - digits and signs for letters, separators between letters,
repeated letters - is a channel. A token that may have gone through it becomes a lattice of
letters, and a Viterbi search restores the likeliest word under a character trigram model,
whose counts are gathered over all documents. The restored words are then scored by terms,
words and stems that labelled toxic texts hold far more often than others.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Signs that stand for letters.
LEET = {"0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "gb", "7": "t", "8": "b", "9": "g", "@": "a", "$": "s", "!": "i", "|": "li", "+": "t", "(": "c", "€": "e", "£": "l"}
#: Costs of the channel, in nats.
SUBSTITUTED, DROPPED, DOUBLED = 1.0, 1.0, 1.0
N = 28  # boundary, a to z, any other letter
_SPACED = re.compile(r"(?<!\S)(?:[^\W_][ ._*\-]{1,2}){2,}[^\W_](?![^\s.,;:!?])")
_TRIPLE = re.compile(r"(.)\1\1", re.S)
_SIGN_INSIDE = re.compile(r"[^\W\d_][^\w\s]+[^\W\d_]|_")
_LEADING = "@$!|+(€£"


def core(token: str) -> str:
    """A token without the signs around it; one that may stand for a first letter stays."""
    i, j = 0, len(token)
    while i < j and not token[j - 1].isalnum():
        j -= 1
    while i < j and not token[i].isalnum() and token[i] not in _LEADING:
        i += 1
    return token[i:j]


def suspicious(token: str) -> bool:
    """Whether a token may have gone through the channel: letters with digits or signs, or three of a kind."""
    if _TRIPLE.search(token):
        return True
    if token.isalpha():
        return False
    letters, digits = any(map(str.isalpha, token)), any(map(str.isdigit, token))
    return letters and (digits or token[:1] in _LEADING or bool(_SIGN_INSIDE.search(token)))


def symbol(c: str) -> int:
    return ord(c) - 96 if "a" <= c <= "z" else N - 1 if c.isalpha() else 0


def _symbols(text: str) -> np.ndarray:
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    out = np.where((codes >= 97) & (codes <= 122), codes - 96, 0).astype(np.int64)
    high = np.flatnonzero(codes >= 170)
    if len(high):
        kinds, back = np.unique(codes[high], return_inverse=True)
        out[high] = np.array([N - 1 if chr(c).isalpha() else 0 for c in kinds])[back]
    return out


def language_model(docs: DataFrame, text: str = "text") -> np.ndarray:
    """Log probabilities of a symbol after two others, from the trigrams of all texts.

    At most 28 ** 3 counts, whatever the number of texts.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(N**3, np.int64)
        for batch in batches:
            for t in batch.column(0).to_pylist():
                s = np.concatenate([[0, 0], _symbols(t.lower()), [0]])
                total += np.bincount((s[:-2] * N + s[1:-1]) * N + s[2:], minlength=N**3)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], names=["gram", "n"])

    rows = docs.filter(F.col(text).isNotNull()).select(F.col(text)).mapInArrow(count, "gram long, n long")
    counts = np.zeros(N**3)
    for r in rows.groupBy("gram").agg(F.sum("n").alias("n")).collect():
        counts[r["gram"]] = r["n"]
    counts = counts.reshape(N, N, N)
    one = counts.sum((0, 1)) + 1.0
    two = counts.sum(0) + 5.0 * one / one.sum()
    three = counts + 5.0 * (two / two.sum(1, keepdims=True))[None]
    return np.log(three / three.sum(2, keepdims=True))


class Restorer:
    """Restores words; ``model`` is that of language_model()."""

    def __init__(self, model: np.ndarray):
        self.model = model.tolist()

    def options(self, token: str) -> list[list[tuple[str, float]]]:
        """The lattice: for each run of one character, what it may stand for and at what cost."""
        out = []
        for m in re.finditer(r"(.)\1*", token, re.S):
            c, n = m[1], len(m[0])
            if c.isalpha():
                found = [(c, 0.0), (c * 2, DOUBLED)] if n > 2 else [(c * n, 0.0)] + [(c, DOUBLED)] * (n == 2)
            elif c in LEET:
                found = [(x * k, SUBSTITUTED) for x in LEET[c] for k in range(1, min(n, 2) + 1)]
                found += [] if c.isdigit() else [("", DROPPED + 1)]
            else:
                found = [("", DROPPED if not c.isdigit() else 8.0)]
            out.append(found)
        return out

    def decode(self, token: str) -> str:
        # of each pair of last symbols the cheapest way there, as a chain of letters
        states: dict[tuple[int, int], tuple[float, tuple | None]] = {(0, 0): (0.0, None)}
        for found in self.options(token):
            after: dict[tuple[int, int], tuple[float, tuple | None]] = {}
            for (p, q), (cost, chain) in states.items():
                for letters, price in found:
                    a, b, c = p, q, cost + price
                    for x in letters:
                        s = symbol(x)
                        c -= self.model[a][b][s]
                        a, b = b, s
                    if (a, b) not in after or c < after[a, b][0]:
                        after[a, b] = (c, (chain, letters))
            states = after
        end = min(states, key=lambda s: (states[s][0] - self.model[s[0]][s[1]][0], s))
        out, chain = [], states[end][1]
        while chain is not None:
            chain, letters = chain
            out.append(letters)
        return "".join(reversed(out))

    def word(self, token: str) -> str:
        """A token of a text in lower case, restored."""
        token = core(token)
        return self.decode(token) if suspicious(token) else token

    def tokens(self, text: str | None) -> set[str]:
        """The distinct tokens of a text in lower case, spaced words joined; these need not be words yet."""
        low = (text or "").lower()
        found = set(low.split())
        for m in _SPACED.finditer(low):
            found.add(re.sub(r"[ ._*\-]+", "", m[0]))
        return found


def terms(word: str) -> list[str]:
    """A word and its stems of four letters and more, marked by a star."""
    return [word, *[word[:n] + "*" for n in range(4, min(9, len(word)))]] if word else []


@dataclass(frozen=True)
class Model:
    language: np.ndarray
    weights: dict[str, float]
    fit: tuple[float, ...]  # bias, of the three heaviest words

    def scorer(self):
        restorer, cache = Restorer(self.language), {}

        def weight(token: str) -> tuple[float, str]:
            found = cache.get(token)
            if found is None:
                if len(cache) > 500_000:
                    cache.clear()
                word = restorer.word(token)
                found = cache[token] = (max((self.weights.get(t, 0.0) for t in terms(word)), default=0.0), word)
            return found

        def stats(text: str | None) -> tuple[float, float, float]:
            hits = {w: x for x, w in map(weight, restorer.tokens(text)) if x > 0}
            return (*sorted(hits.values(), reverse=True)[:3], 0.0, 0.0, 0.0)[:3]

        return stats

    def probability(self, stats: tuple[float, ...]) -> float:
        z = self.fit[0] + sum(w * x for w, x in zip(self.fit[1:], stats, strict=True))
        return 1 / (1 + math.exp(-max(-40.0, min(40.0, z))))


def held_out(key: Column) -> Column:
    return F.crc32(key.cast("string")) % 3 == 1


def _logistic(x: np.ndarray, y: np.ndarray, times: np.ndarray, penalty: float = 0.1) -> tuple[float, ...]:
    """Bias and slopes of a logistic regression on rows that count ``times``, by Newton's method."""
    x = np.column_stack([np.ones(len(x)), x])
    w = np.zeros(x.shape[1])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -40, 40)))
        slope = x.T @ (times * (y - p)) - penalty * w
        curve = (x * (times * p * (1 - p))[:, None]).T @ x + penalty * np.eye(len(w))
        w = w + np.linalg.solve(curve, slope)
    return tuple(map(float, w))


def learn(
    docs: DataFrame, labels: DataFrame, sample: int = 20_000, least_docs: int = 5, least_purity: float = 0.8,
    key: str = "doc_id", text: str = "text", label: str = "toxic",
) -> Model:
    """The model: language counts over all ``docs``, terms from the texts of at most ``sample`` labelled keys that are not held out.

    A term is any word or stem that ``least_docs`` of the sample's toxic texts hold and that is
    toxic by ``least_purity``; there is no limit to their number. A text is judged by the weights of
    its three heaviest words. Where a key is labelled more than once the higher label counts; where
    it has several rows each counts. Without labels of both classes no text is toxic.
    """
    language = language_model(docs, text)
    chosen = labels.filter(F.col(key).isNotNull() & F.col(label).isNotNull() & ~held_out(F.col(key)))
    chosen = chosen.groupBy(F.col(key).alias("_k")).agg(F.max(label).cast("int").alias("_y"))
    chosen = chosen.orderBy(F.xxhash64("_k"), "_k").limit(sample)
    # of at most ``sample`` keys, so it may be broadcast
    rows = docs.select(key, text).join(F.broadcast(chosen), F.col(key) == F.col("_k")).select(F.col("_y").alias("y"), F.col(text).alias("t"))

    def found(of: int, among: frozenset[str] | None):
        def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            restorer, cache = Restorer(language), {}
            for batch in batches:
                out: list[str] = []
                for t in batch.column(0).to_pylist():
                    own: set[str] = set()
                    for token in restorer.tokens(t):
                        got = cache.get(token)
                        if got is None:
                            if len(cache) > 200_000:
                                cache.clear()
                            got = cache[token] = [x for x in terms(restorer.word(token)) if among is None or x in among]
                        own.update(got)
                    out += own
                yield pa.RecordBatch.from_arrays([pa.array(out, pa.string())], names=["term"])

        return rows.filter(F.col("y") == of).select("t").mapInArrow(emit, "term string").groupBy("term").agg(F.count("*").alias("n"))

    size = {r["y"]: r["n"] for r in rows.groupBy("y").agg(F.count("*").alias("n")).collect()}
    none = Model(language, {}, (-4.0, 0.0, 0.0, 0.0))
    if not size.get(0) or not size.get(1):
        return none
    # terms of the sample's toxic texts only
    toxic = {r["term"]: r["n"] for r in found(1, None).filter(F.col("n") >= least_docs).collect()}
    clean = {r["term"]: r["n"] for r in found(0, frozenset(toxic)).collect()}
    scored = {}
    for t, p in toxic.items():
        p, n = (p + 0.5) / (size[1] + 1), (clean.get(t, 0) + 0.5) / (size[0] + 1)
        prior = size[1] / (size[0] + size[1])
        purity = p * prior / (p * prior + n * (1 - prior))
        if purity >= least_purity:
            scored[t] = math.log(p / n)
    if not scored:
        return none
    draft = Model(language, scored, ())

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        stats = draft.scorer()
        for batch in batches:
            got = [stats(t) for t in batch.column(1).to_pylist()]
            columns = [batch.column(0), *(pa.array([g[i] for g in got], pa.float64()) for i in range(3))]
            yield pa.RecordBatch.from_arrays(columns, names=["y", "a", "b", "c"])

    # one row for each combination of weights, however many rows the keys of the sample have
    seen = rows.mapInArrow(measure, "y int, a double, b double, c double").groupBy("y", "a", "b", "c").agg(F.count("*").alias("n"))
    seen = np.array(sorted(map(tuple, seen.collect())), np.float64)
    return Model(language, draft.weights, _logistic(seen[:, 1:4], seen[:, 0], seen[:, 4]))


def scored(docs: DataFrame, model: Model, text: str = "text", name: str = "score") -> DataFrame:
    """``docs`` with the probability that a text is toxic, rounded to 9 digits; null and empty texts have one too. A column ``name`` is replaced."""
    kept = [c for c in docs.columns if c.lower() != name.lower()]
    source = docs.select(*kept)
    at = kept.index(text)
    schema = source.withColumn(name, F.lit(0.0)).schema

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        stats = model.scorer()
        for batch in batches:
            got = [round(model.probability(stats(t)), 9) for t in batch.column(at).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(got, pa.float64())], names=[*kept, name])

    return source.mapInArrow(score, schema)

