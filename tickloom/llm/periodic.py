"""Periodic runs of words by descending-LCP Kruskal.

A run is a stretch of words with smallest period q, of at least ``max(LEAST, 2 q)`` words, that no
neighbouring word extends. Suffixes of a text are classes of one position each. Going down the LCP
values of neighbouring suffixes, union-find unites the classes on both sides, smaller into larger; each
class holds its positions in text order. Two positions p < q that a union makes neighbours share exactly
LCP = l words; if q - p <= l and the words before them differ, p starts a run of period q - p and of
l + q - p words. Every run appears this way once: a position between p and q in one class with them
would give the run a smaller period, and a non-primitive distance d is never adjacent, since then the
positions one true period on were united with p at a higher LCP.

Positions whose next ``SEED`` words occur nowhere else in their text can start no pair of a run
(l >= max(LEAST - q, q) >= LEAST / 2), so they are set aside first by one sort of hashes; a hash
collision only keeps a position that is not needed. What remains of a whole Arrow batch is sorted at
once by prefix doubling in numpy. Memory is some 100 bytes per word of a batch plus 8 bytes times
log2(longest repeat) per remaining word. No shuffle, and nothing passes the driver.

Defined cases: null and empty texts have no words, no runs and an empty collapsed text; repeated rows
give repeated results; a column called like the result is replaced; an empty table gives an empty one.
"""

from __future__ import annotations

from bisect import bisect, insort
from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.llm.common import small_batches, words_of

LEAST = 12  # words of a run
SEED = LEAST // 2  # words that both positions of a pair share at least
CHUNK_WORDS = 1 << 21  # words sorted at once; one text is never cut
RUNS = "struct<n_words:long,runs:array<struct<start:long,length:long,period:long>>,collapsed:string>"


def _recurring(ids: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """Positions whose next SEED words occur again in the same text (and a few more by collision)."""
    n = len(ids) - SEED + 1
    if n <= 0:
        return np.zeros(0, np.int64)
    x = ids.astype(np.uint64) + np.uint64(1)
    x = (x ^ (x >> np.uint64(7))) * np.uint64(0x9E3779B97F4A7C15)
    x ^= x >> np.uint64(32)
    key = doc[:n].astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F)
    for k in range(SEED):
        key = key * np.uint64(0x100000001B3) + x[k : k + n]
    key ^= key >> np.uint64(29)
    inside = np.flatnonzero(doc[:n] == doc[SEED - 1 :])
    key = key[inside]
    ordered = np.sort(key)
    twice = ordered[1:][ordered[1:] == ordered[:-1]]
    if not len(twice):
        return np.zeros(0, np.int64)
    twice = np.unique(twice)
    return inside[twice[np.minimum(np.searchsorted(twice, key), len(twice) - 1)] == key]


def _dense(high: np.ndarray, low: np.ndarray) -> np.ndarray:
    """Ranks of pairs; equal pairs share a rank."""
    both = high.astype(np.int64) * (int(low.max()) + 1) + low
    return np.unique(both, return_inverse=True)[1].astype(np.int32)


def _neighbours(symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Suffix order of a sequence, and the LCP of each suffix with the one before it (0 for the first)."""
    n = len(symbols)
    ranks = [symbols.astype(np.int32)]
    while int(ranks[-1].max()) + 1 < n:
        step = 1 << (len(ranks) - 1)
        after = np.zeros(n, np.int32)  # past the end: below every rank
        after[: n - step] = ranks[-1][step:] + 1 if step < n else 0
        ranks.append(_dense(ranks[-1], after))
    order = np.empty(n, np.int64)
    order[ranks[-1]] = np.arange(n)
    a, b, lcp = order[:-1].copy(), order[1:].copy(), np.zeros(n, np.int64)
    for k in range(len(ranks) - 1, -1, -1):
        same = (a < n) & (b < n)
        same[same] = ranks[k][a[same]] == ranks[k][b[same]]
        a[same] += 1 << k
        b[same] += 1 << k
        lcp[1:][same] += 1 << k
    return order, lcp


def _pairs(order: np.ndarray, lcp: np.ndarray) -> list[tuple[int, int, int]]:
    """p, q, l of positions that a union made neighbours at distance within their LCP."""
    edges = np.flatnonzero(lcp >= SEED)
    edges = edges[np.argsort(-lcp[edges], kind="stable")]
    parent: dict[int, int] = {}
    members: dict[int, list[int]] = {}
    found = []

    def root(x: int) -> int:
        while (up := parent.get(x, x)) != x:
            parent[x] = parent.get(up, up)
            x = up
        return x

    for slot, left, right, length in zip(edges.tolist(), order[edges - 1].tolist(), order[edges].tolist(), lcp[edges].tolist(), strict=True):
        a, b = root(slot - 1), root(slot)
        large, small = members.pop(a, None) or [left], members.pop(b, None) or [right]
        if len(large) < len(small):
            a, b, large, small = b, a, small, large
        parent[b] = a
        for i, p in enumerate(small):
            at = bisect(large, p)
            # A neighbour counts if it is of the other class: no position of the own class lies between.
            if at and p - large[at - 1] <= length and (i == 0 or small[i - 1] < large[at - 1]):
                found.append((large[at - 1], p, length))
            if at < len(large) and large[at] - p <= length and (i + 1 == len(small) or small[i + 1] > large[at]):
                found.append((p, large[at], length))
        if 32 * len(small) > len(large):
            large += small
            large.sort()
        else:
            for p in small:
                insort(large, p)
        members[a] = large
    return found


def find_runs(texts: list[list[bytes]]) -> tuple[np.ndarray, np.ndarray]:
    """Runs of several texts: text number, and start, length, period by start, then period."""
    sizes = np.array([len(t) for t in texts], np.int64)
    number: defaultdict[bytes, int] = defaultdict()
    number.default_factory = number.__len__
    ids = np.fromiter((number[w] for t in texts for w in t), np.int64, int(sizes.sum()))
    doc = np.repeat(np.arange(len(texts)), sizes)
    kept = _recurring(ids, doc)
    none = np.zeros(0, np.int64), np.zeros((0, 3), np.int64)
    if not len(kept):
        return none
    # Words of recurring stretches side by side, a symbol of its own after each; words of different
    # texts are different symbols.
    covered = np.zeros(len(ids) + 1, np.int64)
    np.add.at(covered, kept, 1)
    np.add.at(covered, kept + SEED, -1)
    words = np.flatnonzero(covered.cumsum()[:-1] > 0)
    breaks = np.flatnonzero((np.diff(words) > 1) | (np.diff(doc[words]) > 0)) + 1
    place = np.insert(words, breaks, -1)
    real = place >= 0
    symbols = np.empty(len(place), np.int64)
    symbols[real] = np.unique(doc[words] * (len(number) + 1) + ids[words], return_inverse=True)[1]
    top = int(symbols[real].max()) + 1
    symbols[~real] = top + np.arange(int((~real).sum()))
    order, lcp = _neighbours(np.unique(symbols, return_inverse=True)[1])
    found = np.array(_pairs(order, lcp), np.int64).reshape(-1, 3)
    p, q, length = place[found[:, 0]], place[found[:, 1]], found[:, 2]
    first = np.concatenate([[0], sizes.cumsum()])[doc[p]]
    starts = (p == first) | (ids[p - 1] != ids[q - 1])
    rows = np.stack([p - first, length + q - p, q - p], axis=1)
    good = starts & (rows[:, 1] >= LEAST)
    rows, owner = rows[good], doc[p][good]
    by = np.lexsort((rows[:, 2], rows[:, 0], owner))
    return owner[by], rows[by]


def _chunks(texts: list[list[bytes]]):
    """Slices of ``texts`` of about CHUNK_WORDS words."""
    begin = total = 0
    for i, t in enumerate(texts):
        if total and total + len(t) > CHUNK_WORDS:
            yield begin, texts[begin:i]
            begin, total = i, 0
        total += len(t)
    if begin < len(texts):
        yield begin, texts[begin:]


def _collapsed(words: list[bytes], runs: np.ndarray) -> bytes:
    if not len(runs):
        return b" ".join(words)
    gone = np.zeros(len(words) + 1, np.int64)
    np.add.at(gone, runs[:, 0] + runs[:, 2], 1)
    np.add.at(gone, runs[:, 0] + runs[:, 1], -1)
    return b" ".join(words[i] for i in np.flatnonzero(gone.cumsum()[:-1] == 0).tolist())


def _of_batch(column: pa.Array) -> pa.Array:
    # bytes.split() splits at the white space of the contract.
    texts = [(t or b"").split() for t in column.cast(pa.binary()).to_pylist()]
    owners, rows = [np.zeros(0, np.int64)], [np.zeros((0, 3), np.int64)]
    for begin, part in _chunks(texts):
        owner, found = find_runs(part)
        owners.append(owner + begin)
        rows.append(found)
    owner, found = np.concatenate(owners), np.concatenate(rows)
    ends = np.searchsorted(owner, np.arange(len(texts) + 1))
    collapsed = [_collapsed(t, found[a:b]) for t, a, b in zip(texts, ends[:-1], ends[1:], strict=True)]
    runs = pa.StructArray.from_arrays([pa.array(found[:, k]) for k in range(3)], ["start", "length", "period"])
    return pa.StructArray.from_arrays(
        [
            pa.array(np.array([len(t) for t in texts], np.int64)),
            pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), runs),
            pa.array(collapsed, pa.binary()).cast(pa.string()),
        ],
        ["n_words", "runs", "collapsed"],
    )


def collapse(docs: DataFrame, text: str = "text", out: str = "periodic") -> DataFrame:
    """``docs`` with a struct column: n_words, runs (by start, then period), collapsed.

    ``collapsed`` is the text's words joined by one space, without what repeats the first period of a run.
    """
    small_batches(docs.sparkSession)
    return docs.withColumn(out, F.arrow_udf(_of_batch, RUNS)(F.col(text)))


def repeated_tails(docs: DataFrame) -> DataFrame:
    """doc_id, text: the contract's planted runs, a tenth of the documents repeat words from some word on.

    With h the crc32 of the id as decimal text and g = h div 10: if h is a multiple of 10, word i >= a
    is word a + (i - a) % p, where a = g % n and p = 1 + (n - a) div (3 + g % 8). Null ids stay as they are.
    """
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    g, n, words = F.col("g"), F.nullif(F.size("words"), F.lit(0)), F.col("words")
    shaped = docs.select("doc_id", "text", F.floor(h / 10).alias("g"), F.when(h % 10 == 0, words_of(F.col("text"))).alias("words"))
    placed = shaped.select("doc_id", "text", "words", (g % n).alias("a"), (3 + g % 8).alias("parts"))
    cut = placed.select("doc_id", "text", "words", "a", (1 + F.floor((n - F.col("a")) / F.col("parts"))).alias("p"))
    source = lambda i: (F.col("a") + (i - F.col("a")) % F.col("p")).cast("int")
    tail = F.transform(words, lambda w, i: F.when(i < F.col("a"), w).otherwise(F.get(words, source(i))))
    return cut.select("doc_id", F.when(n > 0, F.array_join(tail, " ")).otherwise(F.col("text")).alias("text"))


def digests(found: DataFrame, runs: str = "periodic") -> DataFrame:
    """The contract's columns from a collapsed table."""
    every = F.col(f"{runs}.runs")
    ranked = F.transform(every, lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period")))
    lines = F.transform(every, lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    listed = F.concat(F.array_join(lines, "\n"), F.when(F.size(every) > 0, "\n").otherwise(""))
    best = found.select(
        "doc_id", F.size(every).cast("long").alias("n_runs"), F.array_max(ranked).alias("best"),
        F.sha2(listed.cast("binary"), 256).alias("runs_sha256"), F.sha2(F.col(f"{runs}.collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )
    return best.select(
        "doc_id", "n_runs", (-F.col("best.start")).alias("start"), F.col("best.length").alias("length"), (-F.col("best.period")).alias("period"),
        F.expr("(1000 * best.length) div -best.period").alias("exponent_milli"), "runs_sha256", "collapsed_sha256",
    )
