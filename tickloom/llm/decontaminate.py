"""Benchmark decontamination by latent semantic retrieval.

1. Document frequencies of all hashed words, over the whole corpus, give the TF-IDF weights.
2. Items of more than ``PASSAGE`` words are cut into overlapping passages of that length, so that a window
   is never compared with an item many times its length. A randomised singular value decomposition of
   the benchmark's TF-IDF passages gives the latent space.
   Its passes over the passages run in Spark; the driver sees sums the size of the vocabulary only.
3. Every window of ``2 * BLOCK`` words of a text is projected, and items with a passage within ``NEAR`` of
   the cosine that the passage keeps with itself in the latent space are candidates, so that a space that
   keeps less of each item as the benchmark grows loses no item by it. Windows overlap by half, so one of
   them holds at least half a window of any passage. Words that the benchmark doesn't have count in no
   length, so that what a paraphrase puts in between does not hide it.
4. Around each run of candidates the longest common subsequence of words is taken, in regions a little
   longer than the item that start every ``BLOCK`` words. An item counts as found if it covers ``SAME``
   of the item, or ``ALIKE`` and the answer, the item's last sentence, is there as well; within ``CLOSE`` of
   that cosine ``LOOSE`` of the item is enough beside the answer.
5. A word search is the safety net: regions that share enough of an item's rarer words to pass the plain
   check are checked too, where the latent search has found nothing. ``latent`` tells by which of the two
   an item was found.

Texts never move: windows, candidates and checks happen where a text lies, against a block of at most
``ITEMS`` items that is sent to the executors; a larger benchmark takes one pass per block.

Defined cases: null and empty texts hold no item; items without a word are never found, and items of
less than ``SHORT`` words only word for word; repeated items are found each on its own; an empty corpus
or benchmark gives no hits.
"""

from __future__ import annotations

import itertools
import math
import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.llm.common import free_name, shipped, small_batches, stored

BUCKETS = 1 << 16  # hashed vocabulary
RANK, EXTRA, POWERS = 128, 16, 2  # of the decomposition
BLOCK = 16  # words
PASSAGE = 4 * BLOCK
NEAR = 0.4  # of the cosine that a passage would have with itself
CLOSE, LOOSE = 0.8, 0.4  # a paraphrase so near needs no more than this share of the item in order, and the answer
SAME, ALIKE, ANSWER = 0.7, 0.5, 0.6
SHORT = 8
ITEMS = 20_000  # items sent to the executors at a time
SLICE = 64  # blocks projected together; their vectors stay in the processor's cache
PIECE = 1 << 16  # words searched together for shared words
CHECKED = 50.0  # cost of a check in places of words; only steers which words are searched for

# Bytes that belong to words: digits, a-z, and everything beyond ASCII.
WORD_BYTE = np.array([48 <= b <= 57 or 97 <= b <= 122 or b >= 128 for b in range(256)])
_R = 0x9E3779B97F4A7C15
_R_INVERSE = pow(_R, -1, 1 << 64)
_POWERS: dict[str, np.ndarray] = {}
BYTES = 1 << 20  # hashed together
LAST_SENTENCE = re.compile(r"[.!?]\s+(?=[^.!?]*\w)")


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_POWERS.get("up", ())) < n:
        size = max(n, 1 << 16)
        for name, base in (("up", _R), ("down", _R_INVERSE)):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            _POWERS[name] = np.multiply.accumulate(steps)
    return _POWERS["up"][:n], _POWERS["down"][:n]


def word_hashes(text: str | None) -> np.ndarray:
    """64-bit hashes of the words of a text, in order; a polynomial over each word's bytes."""
    raw = np.frombuffer((text or "").lower().encode("utf-8", "surrogatepass"), np.uint8)
    out, at = [], 0
    while at < len(raw):
        stop = min(len(raw), at + BYTES)
        if stop < len(raw):
            # End the slice after a byte that is in no word; a longer word makes a longer slice.
            breaks = np.flatnonzero(~WORD_BYTE[raw[at:stop]])
            if len(breaks):
                stop = at + int(breaks[-1]) + 1
            else:
                later = np.flatnonzero(~WORD_BYTE[raw[stop:]])
                stop = stop + int(later[0]) + 1 if len(later) else len(raw)
        part = raw[at:stop]
        inside = WORD_BYTE[part]
        edges = np.flatnonzero(np.diff(np.concatenate([[False], inside, [False]]).astype(np.int8)))
        starts, ends = edges[::2], edges[1::2]
        up, down = _powers(len(part) + 1)
        total = np.zeros(len(part) + 1, np.uint64)
        np.cumsum((part.astype(np.uint64) + np.uint64(1)) * up[: len(part)], out=total[1:])
        h = (total[ends] - total[starts]) * down[starts]
        h ^= h >> np.uint64(29)
        h *= np.uint64(0xBF58476D1CE4E5B9)
        h ^= h >> np.uint64(32)
        out.append(h)
        at = stop
    return np.concatenate(out) if out else np.zeros(0, np.uint64)


def buckets(hashes: np.ndarray) -> np.ndarray:
    return (hashes & np.uint64(BUCKETS - 1)).astype(np.int64)


def document_frequencies(docs: DataFrame, text: str = "text") -> tuple[np.ndarray, int]:
    """Documents per bucket and documents in all. Each task counts its own; the sums are one row per bucket."""
    small_batches(docs.sparkSession)

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen, n = np.zeros(BUCKETS, np.int64), 0
        for batch in batches:
            for t in batch["text"]:
                seen[np.unique(buckets(word_hashes(t)))] += 1
                n += 1
        held = np.flatnonzero(seen)
        yield pd.DataFrame({"bucket": np.append(held, -1), "n": np.append(seen[held], n)})

    counted = docs.select(F.col(text).alias("text")).mapInPandas(count, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    found = {r.bucket: r.n for r in counted.collect()}  # at most BUCKETS + 1 rows
    total = found.pop(-1, 0)
    frequency = np.zeros(BUCKETS, np.int64)
    if found:
        frequency[list(found)] = list(found.values())
    return frequency, total


def cut(words: np.ndarray) -> list[np.ndarray]:
    """The passages of an item: they overlap by half or more, and the last one is whole; none without a word."""
    last = len(words) - PASSAGE
    if last <= 0:
        return [words] if len(words) else []
    return [words[at : at + PASSAGE] for at in [*range(0, last, PASSAGE // 2), last]]


def passages(benchmark: DataFrame, idf: np.ndarray, text: str = "text") -> DataFrame:
    """buckets, weights: the TF-IDF row of each passage of each item, at unit length."""
    load = shipped(benchmark.sparkSession, idf)

    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own = load()
        for batch in batches:
            out = []
            for t in batch["text"]:
                for passage in cut(buckets(word_hashes(t))):
                    b, n = np.unique(passage, return_counts=True)
                    w = n * own[b]
                    out.append((b.tolist(), (w / np.sqrt((w * w).sum())).tolist()))
            yield pd.DataFrame(out, columns=["buckets", "weights"])

    return benchmark.select(F.col(text).alias("text")).mapInPandas(rows, "buckets array<long>, weights array<double>")


def _sums(found: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Rows of (row, vector) summed by row: row numbers and matrix."""
    long = found.select("row", F.posexplode("vector").alias("column", "value")).groupBy("row", "column").agg(F.sum("value").alias("value"))
    wide = long.groupBy("row").agg(F.array_sort(F.collect_list(F.struct("column", "value"))).alias("v")).select("row", F.col("v.value").alias("v"))
    rows = sorted(wide.collect(), key=lambda r: r.row)
    return np.array([r.row for r in rows], np.int64), np.array([r.v for r in rows], np.float64)


def latent_space(rows: DataFrame, rank: int = RANK, seed: int = 3) -> tuple[np.ndarray, np.ndarray]:
    """(buckets, vectors): the leading right singular vectors of the passages, one row per bucket.

    Randomised range finder with power iterations: each pass multiplies the passages' rows with the
    current basis and back, partition by partition, and sums the products per bucket. ``rows`` should
    be a stored table.
    """
    spark = rows.sparkSession
    width = rank + EXTRA
    # One pass: A^T (A Q); the last pass gives the small Gram matrix (A Q)^T (A Q).
    used = sorted(r[0] for r in rows.select(F.explode("buckets")).distinct().collect())  # at most BUCKETS
    index = np.full(BUCKETS, -1)
    index[used] = np.arange(len(used))
    q = np.random.default_rng(seed).normal(size=(len(used), width)).astype(np.float32)
    for _ in range(POWERS + 1):
        held, z = _sums(rows.mapInPandas(_product(shipped(spark, (index, q)), gram=False), "row long, vector array<double>"))
        if not len(held):
            return held, np.zeros((0, rank), np.float32)
        orthogonal, _ = np.linalg.qr(z)
        index = np.full(BUCKETS, -1)
        index[held] = np.arange(len(held))
        q = orthogonal.astype(np.float32)
    _, gram = _sums(rows.mapInPandas(_product(shipped(spark, (index, q)), gram=True), "row long, vector array<double>"))
    values, vectors = np.linalg.eigh(gram)
    top = vectors[:, np.argsort(-values)[:rank]]
    return held, (q @ top).astype(np.float32)


def _product(load, gram: bool):
    """A task's share of A^T (A Q), or of (A Q)^T (A Q), as rows of a matrix."""

    def share(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        index, q = load()
        width = q.shape[1]
        total = np.zeros((width, width)) if gram else {}
        for batch in batches:
            for b, w in zip(batch["buckets"], batch["weights"], strict=True):
                b, w = np.asarray(b), np.asarray(w)
                y = w @ q[index[b]]
                if gram:
                    total += np.outer(y, y)
                else:
                    for i, x in zip(b.tolist(), w, strict=True):
                        total[i] = total.get(i, 0) + x * y
        rows = list(range(width)) if gram else sorted(total)
        for at in range(0, len(rows), 4096):
            part = rows[at : at + 4096]
            yield pd.DataFrame({"row": part, "vector": [np.asarray(total[i]).tolist() for i in part]})

    return share


@dataclass
class Words:
    """The words of a block of items that are searched for, and how many of them a region must hold.

    A region passes the check only if it holds ``ALIKE`` of the item's places (all of them below
    ``SHORT``). Leaving out an item's commonest words and as many places from that number misses none.
    """

    keys: np.ndarray  # hashes in order
    starts: np.ndarray  # of each word's entries in the next two
    items: np.ndarray
    places: np.ndarray  # of the word in the item
    needed: np.ndarray  # places per item
    blocks: np.ndarray  # per item, that a region touches
    known: np.ndarray  # last 20 bits of ``keys``

    @classmethod
    def of(cls, items: list[np.ndarray], frequency: np.ndarray, total: int) -> Words:
        share = np.minimum(frequency / max(total, 1), 0.999)
        rates = -np.log1p(-share) / max(float(share.sum()), 1.0)  # occurrences per word of text, roughly
        entries, needed = [], []
        for i, words in enumerate(items):
            n = len(words)
            held, places = np.unique(words, return_counts=True)
            rate = rates[buckets(held)] * span_of(n)
            order = np.argsort(-rate, kind="stable")
            need, expected = least_of(n), float((rate * places).sum())
            best = (math.inf, need, 0)
            for left_out, k in enumerate([-1, *order.tolist()]):
                if k >= 0:
                    need, expected = need - int(places[k]), expected - float(rate[k] * places[k])
                    if need < 1:
                        break
                likely = min(1.0, math.exp(need - expected - need * math.log(need / expected))) if 0 < expected < need else float(expected > 0)
                best = min(best, (expected / blocks_in(n) + CHECKED * likely, need, left_out))
            needed.append(best[1])
            entries += [(int(held[k]), i, int(places[k])) for k in order[best[2] :]]
        entries.sort()
        keys, starts = np.unique(np.array([e[0] for e in entries], np.uint64), return_index=True)
        known = np.zeros(1 << 20, bool)
        known[_last_bits(keys)] = True
        return cls(
            keys, np.append(starts, len(entries)), np.array([e[1] for e in entries], np.int64), np.array([e[2] for e in entries], np.int64),
            np.array(needed, np.int64), np.array([blocks_in(len(w)) for w in items], np.int64), known,
        )

    def search(self, texts: list[np.ndarray]) -> list[dict[int, list[tuple[int, int]]]]:
        """Per text: item -> (first, last) blocks where regions with enough of its words may start."""
        found: list[dict[int, list[tuple[int, int]]]] = [{} for _ in texts]
        if not len(self.keys):
            return found
        over = int(self.blocks.max()) * BLOCK
        pieces, size = [], 0
        for i, hashes in enumerate(texts):
            for at in range(0, len(hashes), PIECE):
                pieces.append((i, at // BLOCK, hashes[at : at + PIECE + over]))
                size += len(pieces[-1][2])
                if size >= PIECE:
                    self._search(pieces, found)
                    pieces, size = [], 0
        self._search(pieces, found)
        return found

    def _search(self, pieces: list[tuple[int, int, np.ndarray]], found: list[dict]) -> None:
        if not pieces:
            return
        hashes = np.concatenate([p[2] for p in pieces])
        at = np.flatnonzero(self.known[_last_bits(hashes)])
        word = np.minimum(np.searchsorted(self.keys, hashes[at]), len(self.keys) - 1)
        same = self.keys[word] == hashes[at]
        at, word = at[same], word[same]
        # Blocks are numbered on through all pieces, with a gap that no region crosses.
        sizes = np.array([len(p[2]) for p in pieces])
        begins = np.cumsum(sizes) - sizes
        lengths = -(-sizes // BLOCK) + int(self.blocks.max())
        base = np.cumsum(lengths) - lengths
        piece = np.searchsorted(begins, at, "right") - 1
        block = base[piece] + (at - begins[piece]) // BLOCK
        many = self.starts[word + 1] - self.starts[word]
        entry = np.arange(int(many.sum())) - np.repeat(np.cumsum(many) - many - self.starts[word], many)
        item = self.items[entry]
        key = item * int(lengths.sum()) + np.repeat(block, many)
        order = np.argsort(key, kind="stable")
        key, item = key[order], item[order]
        total = np.concatenate([[0], np.cumsum(self.places[entry[order]])])
        enough = np.flatnonzero(total[np.searchsorted(key, key + self.blocks[item])] - total[:-1] >= self.needed[item])
        block = np.unique(key[enough])
        item, block = block // int(lengths.sum()), block % int(lengths.sum())
        piece = np.searchsorted(base, block, "right") - 1
        for i, b, p in zip(item.tolist(), (block - base[piece]).tolist(), piece.tolist(), strict=True):
            text, first, _ = pieces[p]
            found[text].setdefault(i, []).append((max(first + b - int(self.blocks[i]) + 1, 0), first + b))


def span_of(n: int) -> int:
    """Words in a region for an item of ``n`` words."""
    return n + max(n // 2, BLOCK)


def blocks_in(n: int) -> int:
    return -(-span_of(n) // BLOCK)


def least_of(n: int) -> int:
    """Places of an item of ``n`` words without which no region passes the check."""
    return n if n < SHORT else math.ceil(ALIKE * n)


def _last_bits(hashes: np.ndarray) -> np.ndarray:
    return (hashes & np.uint64((1 << 20) - 1)).astype(np.int64)


@dataclass
class Items:
    """A block of the benchmark: ids, word hashes, where the answer starts, and latent vectors of passages."""

    ids: list
    words: list[np.ndarray]
    answers: list[int]
    vectors: np.ndarray
    owners: np.ndarray  # item of each vector
    index: np.ndarray  # bucket -> row of ``space``, whose last row is zero
    space: np.ndarray  # projection times inverse document frequency
    squares: np.ndarray  # squared inverse document frequency of the benchmark's buckets, 0 for others
    rare: Words
    kept: np.ndarray  # share of each passage's length that the latent space keeps
    least_kept: list[float]  # least of them per item
    masks: dict = field(default_factory=dict, repr=False)  # item -> word -> bits of its places; filled in tasks

    def windows(self, hashes: np.ndarray) -> list[tuple[int, int, float]]:
        """(item, window, cosine): every window near an item; window i starts at word i * BLOCK."""
        found = []
        blocks = max(-(-len(hashes) // BLOCK), 1)
        buffer = np.empty((min(blocks, SLICE + 1) * BLOCK, self.space.shape[1]), np.float32)
        for at in range(0, max(blocks - 1, 1), SLICE):
            part = buckets(hashes[at * BLOCK : (at + SLICE + 1) * BLOCK])
            if not len(part):
                break
            whole = -(-len(part) // BLOCK)
            np.take(self.space, self.index[part], axis=0, mode="clip", out=buffer[: len(part)])
            buffer[len(part) : whole * BLOCK] = 0
            sums = np.einsum("bwk->bk", buffer[: whole * BLOCK].reshape(whole, BLOCK, -1))
            length = np.add.reduceat(self.squares[part], np.arange(0, len(part), BLOCK))
            if whole > 1:
                sums, length = sums[:-1] + sums[1:], length[:-1] + length[1:]
            cosines = (sums / np.sqrt(np.maximum(length, 1e-9))[:, None]) @ self.vectors
            window, passage = np.nonzero(cosines >= NEAR * self.kept)
            found += zip(self.owners[passage].tolist(), (window + at).tolist(), cosines[window, passage].tolist(), strict=True)
        return found

    def cosine(self, item: int, hashes: np.ndarray) -> float:
        """Best cosine of the windows of a region with an item."""
        part, own = buckets(hashes), self.vectors[:, self.owners == item]
        best = -1.0
        for at in range(0, max(len(part) - BLOCK, 1), BLOCK):
            window = part[at : at + 2 * BLOCK]
            length = math.sqrt(max(float(self.squares[window].sum()), 1e-9))
            best = max(best, float((self.space[self.index[window]].sum(axis=0) @ own).max()) / length)
        return best

    def hits(self, texts: Iterable[str | None]) -> list[list[tuple]]:
        """Per text: (item_id, cosine, covered, answered, first_word) of every item found in it."""
        hashed = [word_hashes(t) for t in texts]
        if not self.ids:
            return [[] for _ in hashed]
        return [self.confirmed(hashes, shared) for hashes, shared in zip(hashed, self.rare.search(hashed), strict=True)]

    def confirmed(self, hashes: np.ndarray, shared: dict[int, list[tuple[int, int]]]) -> list[tuple]:
        near: dict[int, list[tuple[int, float]]] = {}
        for item, window, cosine in self.windows(hashes):
            near.setdefault(item, []).append((window, cosine))
        if not near and not shared:
            return []
        found, present = [], set(hashes.tolist())
        for item in sorted(near.keys() | shared.keys()):
            blocks = blocks_in(len(self.words[item]))
            places = [(max(w - blocks + 2, 0), w + 1) for w, _ in near.get(item, ())]
            # Places of the item whose words the text has at all bound every region's common subsequence.
            most = sum([bits.bit_count() for w, bits in self.places_of(item).items() if w in present])
            best = self.best_of(item, hashes, places, near.get(item, ()), most)
            latent = best is not None
            if best is None and item in shared:
                best = self.best_of(item, hashes, shared[item], (), most)
            if best:
                got, first, last = best
                known = [c for w, c in near.get(item, ()) if first <= w < last + blocks]
                cosine = max(known) if known else self.cosine(item, hashes[got[2] : got[2] + span_of(len(self.words[item]))])
                found.append((self.ids[item], cosine, *got, latent))
        return found

    def best_of(self, item: int, hashes: np.ndarray, places: Iterable, near: Iterable, most: int) -> tuple | None:
        """The best region that passes the check, with the stretch of candidates it lies in."""
        best, n, enough = None, len(self.words[item]), CLOSE * self.least_kept[item]
        for first, last in _runs(places):
            close = any(c >= enough for w, c in near if first <= w <= last)
            if most < self.least(n, close):
                continue
            got = self.check(item, hashes, first, last, close)
            if got and (best is None or got[0] > best[0][0]):
                best = (got, first, last)
        return best

    @staticmethod
    def least(n: int, close: bool) -> int:
        """Places of an item of ``n`` words without which no region passes the check."""
        return math.ceil(LOOSE * n) if close and n >= SHORT else least_of(n)

    def places_of(self, item: int) -> dict[int, int]:
        """Word -> bits of its places in the item."""
        masks = self.masks.get(item)
        if masks is None:
            masks = self.masks[item] = {}
            for i, w in enumerate(self.words[item].tolist()):
                masks[w] = masks.get(w, 0) | 1 << i
        return masks

    def check(self, item: int, hashes: np.ndarray, first: int, last: int, close: bool = False) -> tuple[float, bool, int] | None:
        """(covered, answered, first word) of the best region that starts in these blocks, if it passes."""
        n = len(self.words[item])
        masks = self.places_of(item)
        span = span_of(n)
        ending = -(-max(len(hashes) - span, 0) // BLOCK)  # the first region that reaches the end holds all later ones
        start, stop = min(first, ending) * BLOCK, min(last, ending) * BLOCK
        region_words = hashes[start : stop + span].tolist()
        # Places of the item whose words occur at all bound the common subsequence from above: first
        # over the whole stretch, which clears most candidates, then region by region.
        least = self.least(n, close)
        if sum([masks[w].bit_count() for w in masks.keys() & set(region_words)]) < least:
            return None
        best = None
        for at in range(start, stop + 1, BLOCK):
            region = region_words[at - start : at - start + span]
            if sum([masks[w].bit_count() for w in masks.keys() & set(region)]) < least:
                continue
            matched = common(masks, n, region)
            covered = matched.bit_count() / n
            if n < SHORT:
                ok, answered = _contains(region, self.words[item].tolist()), True
            else:
                tail = n - self.answers[item]
                answered = (matched >> self.answers[item]).bit_count() >= ANSWER * tail
                ok = covered >= SAME or answered and covered >= (LOOSE if close else ALIKE)
            if ok and (best is None or covered > best[0]):
                best = (covered, answered, at)
        return best


def _runs(places: list[tuple[int, int]]) -> Iterator[tuple[int, int]]:
    """Touching stretches as one: first and last block."""
    run = None
    for first, last in sorted(places):
        if run is not None and first > run[1] + 1:
            yield run
            run = None
        run = (first, last) if run is None else (run[0], max(run[1], last))
    if run is not None:
        yield run


def _contains(region: list[int], words: list[int]) -> bool:
    n = len(words)
    return any(region[i : i + n] == words for i in range(len(region) - n + 1))


def common(masks: dict[int, int], n: int, region: list[int]) -> int:
    """Bits of the item's words where a longest common subsequence with the region grows, bit-parallel.

    After all words, bit i is set where the subsequence length of the item's first i + 1 words exceeds
    that of its first i; the count of set bits is the length.
    """
    full = (1 << n) - 1
    v = full
    for w in region:
        m = masks.get(w)
        if m:
            u = v & m
            v = ((v + u) | (v - u)) & full
    return ~v & full


def inverse_frequencies(frequency: np.ndarray, total: int) -> np.ndarray:
    return np.log((total + 1) / (frequency + 1)) + 0.1


def _answer_start(text: str) -> int:
    """Number of words before the last sentence; 0 if there is one sentence only."""
    ends = [m.end() for m in LAST_SENTENCE.finditer(text)]
    return len(word_hashes(text[: ends[-1]])) if ends else 0


def blocks_of(benchmark: DataFrame, docs: DataFrame, text: str = "text", bench_text: str = "text", item: str = "item_id") -> Iterator[Items]:
    """The benchmark in blocks of about ``ITEMS`` items, ready to be sent to the executors."""
    items = benchmark.select(F.col(item).alias("item_id"), F.col(bench_text).alias("text"))
    number = items.count()
    if not number:
        return
    frequency, total = document_frequencies(docs, text)
    idf = inverse_frequencies(frequency, total)
    held, vectors = latent_space(stored(passages(items, idf), "passages"))
    index = np.full(BUCKETS, len(held), np.int64)
    index[held] = np.arange(len(held))
    space = np.ascontiguousarray(np.concatenate([vectors * idf[held, None], np.zeros((1, vectors.shape[1]))]), np.float32)
    count = math.ceil(number / ITEMS)
    for block in range(count):
        chosen = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(count)) == block).collect()
        chosen = sorted((r for r in chosen if r.text), key=lambda r: (r.item_id is None, str(r.item_id), r.text))
        words = [word_hashes(r.text) for r in chosen]
        chosen, words = [r for r, w in zip(chosen, words, strict=True) if len(w)], [w for w in words if len(w)]
        owned = [(i, passage) for i, w in enumerate(words) for passage in cut(buckets(w))]
        latent, kept = np.zeros((len(owned), space.shape[1]), np.float32), np.ones(len(owned), np.float32)
        for i, (_, passage) in enumerate(owned):
            v = space[index[passage]].sum(axis=0)
            length = max(float(np.sqrt((v * v).sum())), 1e-9)
            latent[i] = v / length
            # As windows are measured: by their words of the benchmark, each occurrence by itself.
            kept[i] = min(1.0, length / max(float(np.sqrt(idf[passage] @ idf[passage])), 1e-9))
        least = np.ones(len(words))
        np.minimum.at(least, [i for i, _ in owned], kept)
        yield Items(
            [r.item_id for r in chosen], words, [_answer_start(r.text) for r in chosen], np.ascontiguousarray(latent.T),
            np.array([i for i, _ in owned], np.int64), index, space, np.where(index < len(held), idf * idf, 0).astype(np.float32), Words.of(words, frequency, total), kept, least.tolist(),
        )


FIELDS = ("item_id", "cosine", "covered", "answered", "first_word", "latent")


def _hits_type(benchmark: DataFrame) -> str:
    own = dict(benchmark.dtypes)["item_id"]
    return f"array<struct<item_id:{own},cosine:double,covered:double,answered:boolean,first_word:long,latent:boolean>>"


def _finder(load, kind: str):
    @F.pandas_udf(kind)
    def hits(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        own = load()
        for batch in texts:
            yield pd.Series([[dict(zip(FIELDS, h, strict=True)) for h in found] for found in own.hits(batch)], dtype=object)

    # Else the filter that Spark infers below an explode would evaluate it a second time.
    return hits.asNondeterministic()


def mark(docs: DataFrame, benchmark: DataFrame, text: str = "text", out: str = "hits") -> DataFrame:
    """``docs`` with an array column of the items found in each text; a column of that name is replaced.

    A benchmark of several blocks takes one pass after the other, each with its own broadcast; the hits
    of a pass are a table by text, told apart by 96 bits of hashes and the length.
    """
    spark, kind = docs.sparkSession, _hits_type(benchmark)
    small_batches(spark)
    blocks = blocks_of(benchmark, docs, text)
    first, second = next(blocks, None), next(blocks, None)
    if first is None:
        return docs.withColumn(out, F.array().cast(kind))
    if second is None:
        return docs.withColumn(out, _finder(shipped(spark, first), kind)(F.col(text)))
    key, found = free_name(docs, "text_key"), []
    named = F.struct(F.xxhash64(text).alias("a"), F.hash(text).alias("b"), F.length(text).alias("n"))
    for items in itertools.chain([first, second], blocks):
        first = second = None
        hits = docs.select(named.alias(key), _finder(shipped(spark, items), kind)(F.col(text)).alias("h"))
        found.append(stored(hits.where(F.size("h") > 0).dropDuplicates([key]), "hits"))
    every = found[0]
    for more in found[1:]:
        every = every.unionByName(more)
    every = every.groupBy(key).agg(F.flatten(F.collect_list("h")).alias("h")).withColumnRenamed("h", free_name(docs, "found"))
    columns = docs.withColumn(out, F.lit(None)).columns
    joined = docs.drop(out).withColumn(key, named).join(every, key, "left")
    return joined.withColumn(out, F.coalesce(free_name(docs, "found"), F.array().cast(kind))).select(columns)


def contaminated(docs: DataFrame, benchmark: DataFrame, text: str = "text") -> DataFrame:
    """doc_id, item_id, cosine, covered, answered, first_word, latent: one row per document and item found in it."""
    marked = mark(docs.select("doc_id", F.col(text).alias("text")), benchmark, out="hits")
    return marked.select("doc_id", F.explode("hits").alias("h")).select("doc_id", "h.*")
