"""Toxicity by a subsequence string kernel with Nyström landmarks.

The kernel compares two strings by the character triples they share, in order but with gaps, each gap
weighing ``DECAY`` per character (order 3). An inserted character therefore lowers the similarity a
little instead of breaking it; punctuation inside words is dropped and letters spelt apart are joined
before the comparison. Words longer than a piece are compared window by window.

The similarities to the landmarks, whitened by the landmarks' own kernel (Nyström), go to a linear
support vector machine. Its weights, the whitening and the landmarks multiply into one weight per
subsequence, so that a piece is scored without comparing it with each landmark. A sentence is as toxic
as its worst word and a text as its worst sentence, put on a 0-to-1 scale by logistic calibration.

Labels are known per document only. Landmarks are the word beginnings that set toxic training documents
apart, chosen greedily until they cover these, and the harmless pieces most like them. A sentence of a
toxic document is labelled toxic by the words with such a beginning, and teaches nothing without one;
all sentences of other documents are harmless, and each round of training adds the harmless pieces that
the last one found worst. Training sees at most ``PER_CLASS`` labelled rows of each class of at most
``MAX_CHARS`` characters; scoring reads every word of every text.

Defined cases: a null or empty text has no word and gets the score of a text that resembles no
landmark; without labelled rows of both classes every score is 0.5; an empty table gives an empty table.
"""

from __future__ import annotations

import itertools
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field, replace

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.llm.common import balanced_sample, shipped, small_batches

DECAY = 0.4
PIECE = 9  # letters compared at a time, the marks of a word's ends included
POSITIVE, NEAR, GROWTH = 80, 3, 30  # toxic landmarks, harmless ones near each, harmless ones added per round
PER_CLASS, MAX_CHARS = 1500, 10_000
ROUNDS, HARD = 4, 1500  # rounds of training, and the harmless pieces that each one adds
LETTERS = 32  # codes of characters
EPOCHS, COST = 15, 3.0
KNOWN = 400_000  # words whose margins a worker remembers

SENTENCE = re.compile(r"[.!?]+(?=\s|$)|\n")
INNER = re.compile(r"[^\w\s]|_")
APART = re.compile(r"(?<!\w)(?:\w\s+){2,}\w(?!\w)")


def words_of(text: str) -> set[str]:
    """Different words of a lower-case text, without punctuation, spelt-out words joined."""
    clean = INNER.sub("", text)
    found = set(clean.split())
    if any(len(w) == 1 for w in found):
        found.update("".join(m.split()) for m in APART.findall(clean))
    return found


def pieces(word: str) -> list[str]:
    """The word between marks of its ends, or the overlapping windows of that if it is longer than a piece."""
    marked = f"^{word}$"
    return [marked[i : i + PIECE] for i in range(max(len(marked) - PIECE, 0) + 1)]


def _codes(words: list[str], length: int) -> np.ndarray:
    """Character codes of words of one length: a-z, the marks, then everything else folded onto what is left."""
    points = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32).reshape(len(words), length)
    codes = np.where((points >= 97) & (points <= 122), points - 97, 28 + points % (LETTERS - 28))
    return np.where(points == 94, 26, np.where(points == 36, 27, codes)).astype(np.int32)


_SPANS: dict[int, tuple[np.ndarray, np.ndarray]] = {}
_WEIGHTS = DECAY ** np.arange(PIECE, dtype=np.float32)  # by the letters that a triple leaves out


def _triples(length: int) -> tuple[np.ndarray, np.ndarray]:
    """All ordered position triples of a string, and how many letters each leaves out."""
    if length not in _SPANS:
        at = np.array(list(itertools.combinations(range(length), 3)), np.int64).reshape(-1, 3)
        _SPANS[length] = at, (at[:, 2] - at[:, 0] - 2).astype(np.int32)
    return _SPANS[length]


def subsequences(words: list[str], length: int) -> tuple[np.ndarray, np.ndarray]:
    """Codes of all subsequences of each word and their weights, for words of one length, at unit norm."""
    c = _codes(words, length)
    at, gaps = _triples(length)
    code = (c[:, at[:, 0]] * LETTERS + c[:, at[:, 1]]) * LETTERS + c[:, at[:, 2]]
    # The weights of equal codes add up before they are squared: sorted, equal codes are neighbours.
    packed = np.sort(code * 16 + gaps, axis=1)
    same, w = packed >> 4, _WEIGHTS[packed & 15]
    total = (w * w).sum(axis=1)
    left = np.arange(len(words))
    for d in range(1, code.shape[1]):
        equal = same[left, d:] == same[left, :-d]
        some = equal.any(axis=1)
        left, equal = left[some], equal[some]
        if not len(left):
            break
        total[left] += 2 * (w[left, d:] * w[left, :-d] * equal).sum(axis=1)
    return code, _WEIGHTS[gaps][None, :] / np.sqrt(total)[:, None]


def apply(words: list[str], table: np.ndarray) -> np.ndarray:
    """For each piece the weighted sum of the table's rows at its subsequences."""
    out = np.zeros((len(words), *table.shape[1:]), np.float32)
    by_length: dict[int, list[int]] = {}
    for i, w in enumerate(words):
        by_length.setdefault(len(w), []).append(i)
    for length, at in by_length.items():
        if length < 3:
            continue
        for block in np.array_split(np.array(at), -(-len(at) // 4096)):
            code, weight = subsequences([words[i] for i in block], length)
            if table.ndim == 1:
                out[block] = (table.take(code) * weight).sum(axis=1)
            else:
                for t in range(code.shape[1]):
                    out[block] += table.take(code[:, t], axis=0) * weight[:, t, None]
    return out


def landmark_table(landmarks: list[str]) -> np.ndarray:
    """Weight of every subsequence code in every landmark."""
    table = np.zeros((LETTERS**3, len(landmarks)), np.float32)
    for j, word in enumerate(landmarks):
        code, weight = subsequences([word], len(word))
        table[:, j] = np.bincount(code[0], weight[0], LETTERS**3)
    return table


@dataclass
class Model:
    """The support vector machine, written out as one weight per subsequence code."""

    landmarks: list[str]
    table: np.ndarray
    bias: float
    slope: float = 1.0  # logistic calibration of the worst word
    offset: float = 0.0
    known: dict[str, float] = field(default_factory=dict, repr=False)

    def learn(self, words: set[str]) -> None:
        """Remember the margin of each word: that of its worst piece."""
        if len(self.known) > KNOWN:
            self.known.clear()
        fresh = [w for w in words if w not in self.known]
        if fresh:
            parts = [pieces(w) for w in fresh]
            m = apply([p for ps in parts for p in ps], self.table)
            starts = np.concatenate([[0], np.cumsum([len(p) for p in parts])[:-1]]).astype(np.int64)
            self.known.update(zip(fresh, np.maximum.reduceat(m, starts).tolist(), strict=True))

    def margins(self, texts: list[str | None]) -> np.ndarray:
        """Margin of the worst word of each text; that of a word like no landmark if there is none."""
        split = [words_of((t or "").lower()) for t in texts]
        out = []
        for at in range(0, len(split), 64):
            part = split[at : at + 64]
            self.learn(set().union(*part))
            # A very full memory may have been cleared between the texts, never within this part.
            out += [max(map(self.known.__getitem__, words), default=0.0) for words in part]
        return np.maximum(np.array(out, np.float64), 0.0) + self.bias

    def scores(self, texts: list[str | None]) -> np.ndarray:
        if not self.landmarks:
            return np.full(len(texts), 0.5)
        return 1 / (1 + np.exp(-np.clip(self.slope * self.margins(texts) + self.offset, -30, 30)))


def beginnings(word: str) -> set[str]:
    """The marked word's beginnings of at least four letters, up to a piece."""
    marked = f"^{word}$"
    return {marked[:n] for n in range(5, min(len(marked), PIECE) + 1)}


def choose_landmarks(toxic: list[set[str]], clean: list[set[str]]) -> list[str]:
    """Word beginnings that set the toxic documents apart, until each of these holds two, if it can."""
    bad, good = Counter(), Counter()
    for counts, docs in ((bad, toxic), (good, clean)):
        for words in docs:
            counts.update(set().union(*map(beginnings, words)) if words else ())
    scale = len(clean) / len(toxic)
    clear = {p for p, n in bad.items() if n >= 2 and n * scale >= 10 * good[p] and n >= 4 * good[p]}
    holders: dict[str, set[int]] = {}
    for i, words in enumerate(toxic):
        for p in set().union(*map(beginnings, words)) & clear if words else ():
            holders.setdefault(p, set()).add(i)
    chosen: list[str] = []
    left = [2] * len(toxic)
    while holders and len(chosen) < POSITIVE:
        value = {p: sum(left[i] > 0 for i in d) for p, d in holders.items()}
        best = max(holders, key=lambda p: (value[p], len(holders[p]), len(p), p))
        if value[best] < 2:
            break
        chosen.append(best)
        for i in holders.pop(best):
            left[i] -= 1
        # Longer and shorter forms of a chosen beginning add nothing of their own.
        for p in [p for p in holders if p.startswith(best) or best.startswith(p)]:
            del holders[p]
    return chosen


def _nearest(harmless: list[str], chosen: list[str]) -> list[str]:
    """The ``NEAR`` harmless pieces most like each chosen one; some thousands are compared at a time."""
    table = landmark_table(chosen)
    best: list[list[tuple[float, int]]] = [[] for _ in chosen]
    for at in range(0, len(harmless), 8192):
        likeness = apply(harmless[at : at + 8192], table)
        top = np.argsort(-likeness, axis=0, kind="stable")[:NEAR]
        for j, held in enumerate(best):
            held += [(-float(likeness[i, j]), at + int(i)) for i in top[:, j]]
            held[:] = sorted(held)[:NEAR]
    near = [harmless[held[r][1]] for r in range(NEAR) for held in best if r < len(held)]
    return [p for p in dict.fromkeys(near) if p not in chosen]


def _disguised(piece: str, rng) -> str:
    """The piece with one letter put in between."""
    at = int(rng.integers(2, max(len(piece) - 1, 3)))
    return (piece[:at] + "abcdefghijklmnopqrstuvwxyz"[int(rng.integers(26))] + piece[at:])[:PIECE]


def fit(texts: list[str], labels: list[int], seed: int = 5) -> Model:
    """Train on documents; their labels pass to the sentences that hold a chosen beginning, or to all if harmless."""
    pool: dict[str, str] = {}  # one object per different word, whatever the number of its texts
    shared = lambda words: {pool.setdefault(w, w) for w in words}
    split = [[shared(words_of(s)) for s in SENTENCE.split(t.lower())] if y else None for t, y in zip(texts, labels, strict=True)]
    whole = [shared(words_of(t.lower())) if doc is None else set().union(*doc) for t, doc in zip(texts, split, strict=True)]
    toxic, clean = ([w for w, y in zip(whole, labels, strict=True) if bool(y) == kind] for kind in (True, False))
    chosen = choose_landmarks(toxic, clean) if toxic and clean else []
    if not chosen:
        return Model([], np.zeros(LETTERS**3, np.float32), 0.0)
    rng = np.random.default_rng(seed)
    begin = tuple(chosen)
    witness = Counter()
    for doc in split:
        for sentence in doc or ():
            witness.update(f"^{w}$"[:PIECE] for w in sentence if f"^{w}$".startswith(begin))
    # A piece counts once, with a weight that grows with the square root of its number.
    weights = {p: float(np.sqrt(n)) for p, n in sorted(witness.items())}
    weights.update({_disguised(p, rng): n / 3 for p, n in list(weights.items()) if p.endswith("$")})
    seen = Counter(p for words in clean for w in words for p in pieces(w))
    harmless = sorted(seen)
    positive = list(weights)
    draw = rng.permutation(len(harmless))[: 2 * HARD]
    negative = [harmless[i] for i in draw]
    # Harmless landmarks: for each toxic one the harmless pieces most like it, later the worst of each round.
    landmarks = [*chosen, *_nearest(harmless, chosen)]
    negative = sorted(set(negative) | set(landmarks[len(chosen) :]))
    for _ in range(ROUNDS):
        rows = landmark_table(landmarks)
        own = rows.astype(np.float64).T @ rows.astype(np.float64)
        values, vectors = np.linalg.eigh(own)
        whiten = vectors @ np.diag(1 / np.sqrt(np.maximum(values, 1e-2))) @ vectors.T
        x1, x0 = (apply(x, rows).astype(np.float64) @ whiten for x in (positive, negative))
        cost = COST * np.array([weights[p] for p in positive] + [np.sqrt(seen[p]) for p in negative])
        w, b = _svm(np.concatenate([x1, x0]), np.concatenate([np.ones(len(x1)), -np.ones(len(x0))]), cost, rng)
        model = Model(landmarks, (rows @ (whiten @ w)).astype(np.float32), float(b))
        hardest = [harmless[i] for i in np.argsort(-apply(harmless, model.table), kind="stable")[:HARD]]
        negative = sorted(set(negative) | set(hardest))
        landmarks = [*landmarks, *[p for p in hardest[:GROWTH] if p not in landmarks]]
    model.slope, model.offset = _calibrate(model.margins(texts), np.array(labels, np.float64))
    return model


def _svm(x: np.ndarray, y: np.ndarray, cost: np.ndarray, rng) -> tuple[np.ndarray, float]:
    """Linear support vector machine by dual coordinate descent; ``cost`` bounds each row's multiplier."""
    z = np.concatenate([x, np.ones((len(x), 1))], axis=1) * y[:, None]
    length = (z * z).sum(axis=1)
    alpha, w = np.zeros(len(y)), np.zeros(z.shape[1])
    for _ in range(EPOCHS):
        for i in rng.permutation(len(y)):
            new = min(max(alpha[i] + (1 - z[i] @ w) / length[i], 0.0), cost[i])
            if new != alpha[i]:
                w += (new - alpha[i]) * z[i]
                alpha[i] = new
    return w[:-1], float(w[-1])


def _calibrate(z: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Logistic curve through the margins, by Newton steps on targets kept off 0 and 1."""
    n1, n0 = y.sum(), len(y) - y.sum()
    target = np.where(y == 1, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    theta, x = np.zeros(2), np.stack([z, np.ones_like(z)], axis=1)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ theta, -30, 30)))
        grad = x.T @ (p - target) + np.array([1e-3, 0]) * theta
        hess = (x * (p * (1 - p))[:, None]).T @ x + 1e-3 * np.eye(2)
        theta = theta - np.clip(np.linalg.solve(hess, grad), -2, 2)
    return float(theta[0]), float(theta[1])


def train(docs: DataFrame, labels: DataFrame, text: str = "text", label: str = "toxic") -> Model:
    """A model from a bounded sample of the rows of ``labels`` whose documents are in ``docs``."""
    small_batches(docs.sparkSession)
    # At most 2 * PER_CLASS rows, so the documents need no shuffle.
    sample = F.broadcast(balanced_sample(labels.select("doc_id", F.col(label).alias("label")), "label", PER_CLASS, "toxicity"))
    rows = (
        docs.select("doc_id", F.col(text).alias("text")).join(sample, "doc_id")
        .where(F.length("text") <= MAX_CHARS).select("doc_id", "label", "text").collect()
    )
    rows.sort(key=lambda r: (r.doc_id, r.label, r.text))
    return fit([r.text for r in rows], [int(r.label) for r in rows])


def score(docs: DataFrame, model: Model, text: str = "text", out: str = "toxicity") -> DataFrame:
    """``docs`` with the toxicity in a double column; a column of that name is replaced."""
    spark = docs.sparkSession
    small_batches(spark)
    load = shipped(spark, replace(model, known={}))

    @F.pandas_udf("double")
    def of(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        own = load()
        for batch in texts:
            yield pd.Series(own.scores(list(batch)), dtype="float64")

    return docs.withColumn(out, of(F.col(text)))
