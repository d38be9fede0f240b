"""Language identification by averaged subword embeddings.

Subwords are the byte 2- to 4-grams of the letters of a text, each hashed into a table of embeddings.
Their average goes through a linear softmax. Table and layer are trained by stochastic gradient
descent; a temperature, fitted on rows set aside, calibrates the probabilities, and the least
probability that is right often enough on those rows is the bar below which a prediction counts as
rejected.

Training sees a bounded sample of rows (``PER_CLASS`` of each language, ``SUBWORDS`` drawn evenly from
each whole text); prediction uses every subword of every text. Since the layer is linear, table and
layer multiply into one table of logits, which is all that executors get.

Defined cases: a text that is null or has no letter is ``und`` with score 0 and rejected; rows with a
null language teach nothing; without any row to learn from, every text is ``und``; an empty table gives
an empty table.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.llm.common import balanced_sample, shipped, small_batches

BUCKETS = 1 << 15
DIM = 16
SIZES = (2, 3, 4)  # bytes per subword
PER_CLASS = 800  # rows of each language that training may see
SUBWORDS = 256  # subwords drawn from each of them
EPOCHS, BATCH, RATE = 12, 32, 4.0
RIGHT = 0.99  # share of accepted predictions that should be right
UNDETERMINED = "und"
SLICE = 1 << 18  # bytes looked at together

NO_LETTERS = re.compile(r"[\W\d_]+")


def letters(text: str | None) -> str:
    """The words of a text in lower case, letters only, between single spaces; empty if there is none."""
    kept = NO_LETTERS.sub(" ", (text or "").lower()).strip()
    return f" {kept} " if any(c.isalpha() for c in kept) else ""


def subwords(cleaned: str) -> Iterator[np.ndarray]:
    """Buckets of all subwords, some at a time. A subword may start or end with a space, not hold one."""
    raw = np.frombuffer(cleaned.encode("utf-8", "surrogatepass"), np.uint8)
    for at in range(0, len(raw), SLICE):
        b = raw[at : at + SLICE + max(SIZES) - 1].astype(np.uint32)
        space = b == 32
        code, broken = b, np.zeros(len(b), bool)
        for n in range(2, max(SIZES) + 1):
            m = len(b) - n + 1
            if m <= 0:
                break
            code = code[:m] * np.uint32(0x01000193) + b[n - 1 :] + np.uint32(n)
            if n > 2:
                broken = broken[:m] | space[n - 2 : n - 2 + m]
            else:
                broken = broken[:m]
            if n in SIZES:
                # Only subwords that begin in this slice: the next slice has the others.
                own = min(m, SLICE)
                mixed = (code[:own] ^ (code[:own] >> np.uint32(15))) * np.uint32(0x2C1B3C6D)
                yield (mixed >> np.uint32(17))[~broken[:own]].astype(np.int32)


@dataclass
class Model:
    labels: list[str]
    logits: np.ndarray  # one row per bucket
    bias: np.ndarray
    temperature: float
    bar: float

    def predict(self, text: str | None) -> tuple[str, float, bool]:
        cleaned = letters(text)
        if not cleaned or not self.labels:
            return UNDETERMINED, 0.0, False
        total, n = np.zeros(len(self.labels)), 0
        for ids in subwords(cleaned):
            total += self.logits.take(ids, axis=0).sum(axis=0, dtype=np.float64)
            n += len(ids)
        p = _softmax((total / max(n, 1) + self.bias) / self.temperature)
        best = int(p.argmax())
        return self.labels[best], float(p[best]), bool(p[best] >= self.bar)


def _softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def fit(samples: list[np.ndarray], labels: list[str], seed: int = 7) -> Model:
    """Train on subword lists and their languages; every fifth row is set aside for calibration."""
    names = sorted(set(labels))
    if not names:
        return Model([], np.zeros((BUCKETS, 0), np.float32), np.zeros(0), 1.0, 1.0)
    rng = np.random.default_rng(seed)
    y = np.array([names.index(x) for x in labels])
    table = rng.normal(0, 0.05, (BUCKETS, DIM)).astype(np.float32)
    layer, bias = np.zeros((DIM, len(names)), np.float32), np.zeros(len(names), np.float32)
    layer += rng.normal(0, 0.5, layer.shape).astype(np.float32)
    rows = np.arange(len(y))
    held = rows[rows % 5 == 4]
    taught = rows[rows % 5 != 4] if len(rows) >= 5 else rows
    steps = EPOCHS * -(-len(taught) // BATCH)
    step = 0
    for _ in range(EPOCHS):
        for at in np.array_split(rng.permutation(taught), -(-len(taught) // BATCH)):
            # Half of the rows are seen through a few subwords only, as short texts are.
            lists = [s if rng.random() < 0.5 else s[rng.integers(0, len(s), 24)] for s in (samples[i] for i in at)]
            ids = np.concatenate(lists)
            sizes = np.array([len(s) for s in lists])
            starts = np.concatenate([[0], sizes.cumsum()[:-1]])
            mean = np.add.reduceat(table[ids], starts, axis=0) / sizes[:, None]
            p = _softmax(mean @ layer + bias)
            p[np.arange(len(at)), y[at]] -= 1
            rate = RATE * (1 - step / steps) / len(at)
            spread = (p @ layer.T) / sizes[:, None]
            layer -= rate * 0.5 * (mean.T @ p)
            bias -= rate * 0.05 * p.sum(axis=0)
            np.add.at(table, ids, -rate * 20 * np.repeat(spread, sizes, axis=0).astype(np.float32))
            step += 1
    logits = (table @ layer).astype(np.float32)
    check = held if len(held) else taught
    z = np.array([logits[samples[i]].mean(axis=0) + bias for i in check], np.float64)
    truth = y[check]
    # log of the probability of the truth, for each temperature of a grid
    grid = np.geomspace(0.1, 5, 40)
    fits = [-np.log(_softmax(z / t)[np.arange(len(truth)), truth] + 1e-12).mean() for t in grid]
    temperature = float(grid[int(np.argmin(fits))])
    p = _softmax(z / temperature)
    order = np.argsort(-p.max(axis=1), kind="stable")
    right = (p.argmax(axis=1) == truth)[order].cumsum() / np.arange(1, len(truth) + 1)
    enough = np.flatnonzero(right >= RIGHT)
    bar = float(p.max(axis=1)[order][enough[-1]]) if len(enough) else 1.0
    return Model(names, logits, bias.astype(np.float64), temperature, bar)


def train(docs: DataFrame, text: str = "text", lang: str = "lang") -> Model:
    """A model from a bounded sample of the rows of ``docs`` that have a language."""
    small_batches(docs.sparkSession)

    @F.pandas_udf("array<int>")
    def drawn(texts: pd.Series, ids: pd.Series) -> pd.Series:
        out = []
        for text, doc_id in zip(texts, ids, strict=True):
            found = list(subwords(letters(text)))
            all_ids = np.concatenate(found) if found else np.zeros(0, np.int32)
            rng = np.random.default_rng(abs(int(doc_id)))
            out.append(all_ids[rng.integers(0, len(all_ids), SUBWORDS)] if len(all_ids) else all_ids)
        return pd.Series(out)

    sample = balanced_sample(docs.select("doc_id", F.col(lang).alias("lang"), F.col(text).alias("text")), "lang", PER_CLASS, "language")
    rows = [r for r in sample.select("doc_id", "lang", drawn("text", "doc_id").alias("ids")).collect() if r.ids]
    rows.sort(key=lambda r: (r.doc_id, r.lang))
    return fit([np.array(r.ids, np.int32) for r in rows], [r.lang for r in rows])


def identify(docs: DataFrame, model: Model, text: str = "text", out: str = "language") -> DataFrame:
    """``docs`` with a struct column: lang, score, accepted. A column of that name is replaced."""
    spark = docs.sparkSession
    small_batches(spark)
    load = shipped(spark, model)

    @F.pandas_udf("lang string, score double, accepted boolean")
    def predict(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        own = load()
        for batch in texts:
            yield pd.DataFrame([own.predict(t) for t in batch], columns=["lang", "score", "accepted"])

    return docs.withColumn(out, predict(F.col(text)))
