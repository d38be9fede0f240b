"""Quality classifier: a byte-level convolutional network in numpy.

Bytes are embedded, filters of ``WIDTH`` bytes run over them, and the largest response of each filter
is kept per chunk. Chunks overlap and cover the whole text. Mean and maximum over the chunks go through
one logistic unit. Training (Adam) sees a bounded sample: ``PER_CLASS`` labelled rows of each class,
``CHUNKS`` evenly spread chunks of each. Scoring reads every byte of every text; embedding and filters
then are one table of responses per byte and offset, so a text costs ``WIDTH`` table look-ups a byte.

Defined cases: a null or empty text is one chunk of padding and gets the score that this has; without
labelled rows of both classes every score is 0.5; an empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.llm.common import balanced_sample, shipped, small_batches

WIDTH, FILTERS, DIM = 6, 16, 8
BLOCK = 64  # bytes; a chunk is CHUNK_BLOCKS blocks, and the next one starts STEP_BLOCKS later
CHUNK_BLOCKS, STEP_BLOCKS = 4, 3
PER_CLASS = 1500  # labelled rows of each class that training may see
CHUNKS = 6  # chunks of each of them
EPOCHS, BATCH, RATE = 8, 32, 0.01
SLICE = 512  # blocks scored together

CHUNK = BLOCK * CHUNK_BLOCKS
SEEN = CHUNK + WIDTH - 1  # bytes that a chunk's filters look at


def padded(text: str | None) -> np.ndarray:
    """Bytes of a text, zero-padded to whole blocks, at least one chunk, plus what the last filter sees."""
    raw = (text or "").encode("utf-8", "surrogatepass")
    blocks = max(-(-len(raw) // BLOCK), CHUNK_BLOCKS)
    over = (blocks - CHUNK_BLOCKS) % STEP_BLOCKS
    blocks += (STEP_BLOCKS - over) % STEP_BLOCKS
    out = np.zeros(blocks * BLOCK + WIDTH - 1, np.uint8)
    out[: len(raw)] = np.frombuffer(raw, np.uint8)
    return out


def chunk_starts(n: int) -> range:
    """First bytes of the chunks of a text padded to ``n`` bytes."""
    return range(0, n - SEEN + 1, STEP_BLOCKS * BLOCK)


@dataclass
class Model:
    tables: np.ndarray  # offset, byte, filter
    bias: np.ndarray
    out: np.ndarray  # mean part, then maximum part
    out_bias: float

    def chunks(self, text: str | None) -> np.ndarray:
        """One row per chunk: the largest response of each filter, at least 0."""
        raw = padded(text)
        n = len(raw) - WIDTH + 1
        tops = np.empty((n // BLOCK, FILTERS), np.float32)
        for at in range(0, n, SLICE * BLOCK):
            stop = min(n, at + SLICE * BLOCK)
            z = self.tables[0].take(raw[at:stop], axis=0)
            for k in range(1, WIDTH):
                z += self.tables[k].take(raw[at + k : stop + k], axis=0)
            tops[at // BLOCK : stop // BLOCK] = z.reshape(-1, BLOCK, FILTERS).max(axis=1)
        tops = np.maximum(tops + self.bias, 0)
        whole = np.maximum.reduce([tops[i : len(tops) - CHUNK_BLOCKS + 1 + i] for i in range(CHUNK_BLOCKS)])
        return whole[::STEP_BLOCKS]

    def score(self, text: str | None) -> float:
        c = self.chunks(text)
        z = float(np.concatenate([c.mean(axis=0), c.max(axis=0)]) @ self.out + self.out_bias)
        return float(1 / (1 + np.exp(-np.clip(z, -30, 30))))


def fit(chunks: list[np.ndarray], labels: list[int], odds: float = 1.0, seed: int = 11) -> Model:
    """Train on arrays of chunks (chunk, byte) and 0/1 labels, both classes weighing the same.

    ``odds`` are those of label 1 among all labelled rows. The decision moves half-way towards them: a
    rare class is still found, and the frequent one is not rejected on weak evidence.
    """
    rng = np.random.default_rng(seed)
    y = np.array(labels, np.float32)
    p = {
        "emb": rng.normal(0, 0.5, (256, DIM)), "filt": rng.normal(0, 1 / np.sqrt(WIDTH * DIM), (WIDTH * DIM, FILTERS)),
        "bias": np.zeros(FILTERS), "out": np.zeros(2 * FILTERS), "out_bias": np.zeros(1),
    }
    p = {k: v.astype(np.float32) for k, v in p.items()}
    p["out"] += rng.normal(0, 0.1, 2 * FILTERS).astype(np.float32)
    if len(set(labels)) == 2:
        first, second = ({k: np.zeros_like(v) for k, v in p.items()} for _ in range(2))
        weight = np.where(y == 1, len(y) / (2 * y.sum()), len(y) / (2 * (len(y) - y.sum()))).astype(np.float32)
        step, steps = 0, EPOCHS * -(-len(y) // BATCH)
        for _ in range(EPOCHS):
            for at in np.array_split(rng.permutation(len(y)), -(-len(y) // BATCH)):
                step += 1
                grads = _gradients(p, [chunks[i] for i in at], y[at], weight[at])
                rate = RATE * (1 - 0.9 * step / steps)
                for k, g in grads.items():
                    first[k] = 0.9 * first[k] + 0.1 * g
                    second[k] = 0.999 * second[k] + 0.001 * g * g
                    p[k] -= rate * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.999**step)) + 1e-8)
    else:
        p["out"][:] = 0
    tables = np.stack([p["emb"] @ p["filt"][k * DIM : (k + 1) * DIM] for k in range(WIDTH)]).astype(np.float32)
    return Model(tables, p["bias"], p["out"], float(p["out_bias"][0]) + 0.5 * float(np.log(odds)))


def _gradients(p: dict, docs: list[np.ndarray], y: np.ndarray, weight: np.ndarray) -> dict:
    sizes = np.array([len(d) for d in docs])
    starts = np.concatenate([[0], sizes.cumsum()[:-1]])
    x = np.concatenate(docs)  # chunk, byte
    n = len(x)
    tables = [p["emb"] @ p["filt"][k * DIM : (k + 1) * DIM] for k in range(WIDTH)]
    z = tables[0].take(x[:, :CHUNK], axis=0)
    for k in range(1, WIDTH):
        z += tables[k].take(x[:, k : k + CHUNK], axis=0)
    where = z.argmax(axis=1)  # chunk, filter
    top = np.take_along_axis(z, where[:, None, :], axis=1)[:, 0] + p["bias"]
    act = np.maximum(top, 0)
    owner = np.repeat(np.arange(len(docs)), sizes)
    mean = np.add.reduceat(act, starts, axis=0) / sizes[:, None]
    most = np.maximum.reduceat(act, starts, axis=0)
    h = np.concatenate([mean, most], axis=1)
    prob = 1 / (1 + np.exp(-np.clip(h @ p["out"] + p["out_bias"], -30, 30)))
    d = ((prob - y) * weight / len(docs)).astype(np.float32)
    dh = d[:, None] * p["out"]
    dact = (dh[:, :FILTERS] / sizes[:, None])[owner]
    dact = dact + dh[:, FILTERS:][owner] * (act == most[owner])
    dact *= top > 0
    # Only the winning positions of each filter carry a gradient.
    seen = x[np.arange(n)[:, None, None], where[:, :, None] + np.arange(WIDTH)]  # chunk, filter, offset
    emb = p["emb"][seen].reshape(n, FILTERS, WIDTH * DIM)
    dfilt = np.einsum("nfw,nf->wf", emb, dact)
    demb = np.zeros_like(p["emb"])
    spread = (dact[:, :, None] * p["filt"].T[None]).reshape(-1, DIM)
    np.add.at(demb, seen.reshape(-1), spread)
    return {
        "emb": demb, "filt": dfilt, "bias": dact.sum(axis=0), "out": h.T @ d + 1e-4 * p["out"],
        "out_bias": np.array([d.sum()], np.float32),
    }


def train(docs: DataFrame, labels: DataFrame, text: str = "text", label: str = "quality") -> Model:
    """A model from a bounded sample of the rows of ``labels`` whose documents are in ``docs``."""
    small_batches(docs.sparkSession)
    # At most 2 * PER_CLASS rows, so the documents need no shuffle.
    sample = F.broadcast(balanced_sample(labels.select("doc_id", F.col(label).alias("label")), "label", PER_CLASS, "quality"))

    @F.pandas_udf("binary")
    def drawn(texts: pd.Series) -> pd.Series:
        out = []
        for text in texts:
            raw = padded(text)
            starts = list(chunk_starts(len(raw)))
            chosen = sorted({starts[i * (len(starts) - 1) // max(CHUNKS - 1, 1)] for i in range(CHUNKS)})
            out.append(b"".join(raw[s : s + SEEN].tobytes() for s in chosen))
        return pd.Series(out)

    rows = docs.select("doc_id", F.col(text).alias("text")).join(sample, "doc_id").select("doc_id", "label", drawn("text").alias("raw")).collect()
    rows.sort(key=lambda r: (r.doc_id, r.label, r.raw))
    n = {r.label: r["count"] for r in labels.groupBy(F.col(label).alias("label")).count().collect()}
    odds = n[1] / n[0] if n.get(0) and n.get(1) else 1.0
    return fit([np.frombuffer(r.raw, np.uint8).reshape(-1, SEEN) for r in rows], [int(r.label) for r in rows], odds)


def score(docs: DataFrame, model: Model, text: str = "text", out: str = "quality_score") -> DataFrame:
    """``docs`` with the probability of label 1 in a double column; a column of that name is replaced."""
    spark = docs.sparkSession
    small_batches(spark)
    load = shipped(spark, model)

    @F.pandas_udf("double")
    def of(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        own = load()
        for batch in texts:
            yield pd.Series([own.score(t) for t in batch], dtype="float64")

    return docs.withColumn(out, of(F.col(text)))
