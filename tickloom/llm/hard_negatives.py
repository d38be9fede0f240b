"""Hard negatives by angular triangle filtering.

Every row stores its norm and its angles to a few reference directions. Angles obey the triangle
inequality, so a row at angle t to a direction and an anchor at angle a to it are between |a - t| and
min(a + t, 2 pi - a - t) apart, whatever the direction. Rows of like angles lie together in windows of
at most ``WINDOW`` rows, each with the least and greatest angle to every direction and the least and
greatest norm. For an anchor this gives an interval of cosines, times the norms an interval of scores,
widened so that no rounding can exclude a row. Only windows whose interval meets the scores still wanted
get exact integer scores. The directions, taken from a bounded sample, decide the cost and never the
result; every row is in a window.

Anchors go through the windows in blocks of about ``ANCHORS``: one pass finds each anchor's positives (the
highest scores of its own label), a second one the highest scores of other labels between ``low`` and
``high`` hundredths of each positive's score. A task keeps at most k rows for an anchor or positive, and
its k-th score narrows what later windows can add; the tasks' rows are ranked in Spark. What travels to
the driver and back is one block with at most k positives each. As every anchor is compared with all
windows, the work grows as anchors times windows; the blocks bound the memory.

Defined cases: rows without an id, a label or a vector take no part, nor do those with a null or
non-finite component; nor those whose scaled vector is 2**31 long or longer, since a score need not fit
a long. Vectors of different lengths are filled up with zeros; a zero vector scores 0. Rows with the
anchor's id are not its positives. Repeated rows each take a place; a repeated anchor is mined once.
An empty table gives an empty result; further columns are not read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickloom.llm.common import shipped, stored

DIRECTIONS = 32
SAMPLE = 4096  # rows that the directions may rest on
WINDOW = 256  # rows of a window
ANCHORS = 2048  # anchors of a block, about
PART_ROWS = 1 << 16  # rows of a partition of windows, about
SCALE = 256.0
LONGEST = 2.0**31
SLACK = 1e-6  # radians, far above the rounding of an angle
FOUND = "anchor long, anchor_no int, pair int, positive_id long, positive_score long, id long, score long"
ANGLES = "vec_id long, label long, anchor boolean, q binary, norm double, angles binary, near int, angle double"
WINDOWS = "ids binary, labels binary, dim int, q binary, least binary, greatest binary, least_norm double, greatest_norm double"


def prepared(rows: DataFrame, anchor: Column, vec_id: str = "vec_id", vector: str = "embedding", label: str = "label") -> DataFrame:
    """vec_id, label (hashed), anchor, vector of the rows that take part."""
    x = F.col(vector).cast("array<double>")
    odd = F.exists(x, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    return rows.where(F.col(vec_id).isNotNull() & F.col(label).isNotNull() & F.col(vector).isNotNull() & ~odd).select(
        F.col(vec_id).cast("long").alias("vec_id"), F.xxhash64(F.col(label)).alias("label"),
        F.coalesce(anchor, F.lit(False)).alias("anchor"), x.alias("vector"),
    )


def padded(vectors: list, dim: int) -> np.ndarray:
    out = np.zeros((len(vectors), dim))
    for i, v in enumerate(vectors):
        out[i, : min(len(v), dim)] = v[:dim]
    return out


def scaled(vector: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        return np.floor(SCALE * vector)


def norms_of(q: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        return np.sqrt((q * q).sum(axis=1))


def choose_directions(sample: np.ndarray, n: int = DIRECTIONS) -> np.ndarray:
    """Unit vectors, each as far as possible from those before it; equal ones only once."""
    norm = norms_of(sample)
    unit = sample[norm > 0] / norm[norm > 0, None]
    if not len(unit):
        return np.zeros((0, sample.shape[1]))
    chosen, nearest = [0], unit @ unit[0]
    while len(chosen) < min(n, len(unit)):
        i = int(np.argmin(nearest))
        if nearest[i] > 1 - 1e-9:
            break
        chosen.append(i)
        nearest = np.maximum(nearest, unit @ unit[i])
    return unit[chosen]


def angles_to(q: np.ndarray, norm: np.ndarray, directions: np.ndarray) -> np.ndarray:
    """Angle of every row to every direction; a right angle for zero vectors."""
    size = directions.shape[1]
    if q.shape[1] < size:
        q = np.pad(q, ((0, 0), (0, size - q.shape[1])))
    cosine = q[:, :size] @ directions.T / np.where(norm > 0, norm, 1)[:, None]
    return np.arccos(np.clip(cosine, -1, 1))


def _measure(directions: np.ndarray) -> Callable:
    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors = batch.column("vector")
            sizes = np.diff(vectors.offsets.to_numpy())
            values = np.zeros((len(sizes), int(sizes.max(initial=0))))
            values[np.arange(values.shape[1]) < sizes[:, None]] = vectors.flatten().to_numpy(zero_copy_only=False)
            q = scaled(values)
            norm = norms_of(q)
            angles = angles_to(np.where((norm < LONGEST)[:, None], q, 0), norm, directions)
            near = angles.argmin(axis=1) if angles.shape[1] else np.zeros(len(q), np.int64)
            angle = angles[np.arange(len(q)), near] if angles.shape[1] else np.zeros(len(q))
            fits = np.flatnonzero(norm < LONGEST)
            texts = [q[i, : sizes[i]].astype("<i4").tobytes() for i in fits]
            yield pa.RecordBatch.from_arrays(
                [
                    *(batch.column(c).take(pa.array(fits)) for c in ("vec_id", "label", "anchor")), pa.array(texts, pa.binary()),
                    pa.array(norm[fits]), pa.array([angles[i].tobytes() for i in fits], pa.binary()),
                    pa.array(near[fits].astype(np.int32)), pa.array(angle[fits]),
                ],
                ["vec_id", "label", "anchor", "q", "norm", "angles", "near", "angle"],
            )

    return of


def _group(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Windows of rows that follow one another."""
    for batch in batches:
        for at in range(0, batch.num_rows, WINDOW):
            rows = batch.slice(at, WINDOW)
            q = [np.frombuffer(v, "<i4") for v in rows.column("q").to_pylist()]
            dim = max(len(v) for v in q)
            angles = np.stack([np.frombuffer(v) for v in rows.column("angles").to_pylist()])
            norm = rows.column("norm").to_numpy()
            columns = [
                pa.array([rows.column("vec_id").to_numpy().tobytes()], pa.binary()), pa.array([rows.column("label").to_numpy().tobytes()], pa.binary()),
                pa.array([dim], pa.int32()), pa.array([padded(q, dim).astype("<i4").tobytes()], pa.binary()),
                pa.array([angles.min(axis=0).tobytes()], pa.binary()), pa.array([angles.max(axis=0).tobytes()], pa.binary()),
                pa.array([norm.min()]), pa.array([norm.max()]),
            ]
            yield pa.RecordBatch.from_arrays(columns, [c.split()[0] for c in WINDOWS.split(", ")])


@dataclass(frozen=True)
class RowWindow:
    ids: np.ndarray
    labels: np.ndarray
    q: np.ndarray
    least: np.ndarray
    greatest: np.ndarray
    least_norm: float
    greatest_norm: float

    @classmethod
    def of(cls, batches: Iterator[pa.RecordBatch]) -> Iterator[RowWindow]:
        for batch in batches:
            for r in batch.to_pylist():
                ids = np.frombuffer(r["ids"], np.int64)
                q = np.frombuffer(r["q"], "<i4").reshape(len(ids), r["dim"])
                yield cls(
                    ids, np.frombuffer(r["labels"], np.int64), q, np.frombuffer(r["least"]), np.frombuffer(r["greatest"]),
                    r["least_norm"], r["greatest_norm"],
                )


@dataclass(frozen=True)
class Block:
    """Anchors of one block; scores that are wanted of each, or of each of its positives."""

    ids: np.ndarray
    labels: np.ndarray
    q: np.ndarray
    norms: np.ndarray
    angles: np.ndarray

    def bounds(self, w: RowWindow) -> tuple[np.ndarray, np.ndarray]:
        """No row of the window scores lower or higher than this with each anchor."""
        a, low, high = self.angles, w.least, w.greatest
        apart = np.maximum(a - high, low - a).max(axis=1, initial=0.0)
        widest = np.where(a + high <= np.pi, a + high, np.where(a + low >= np.pi, 2 * np.pi - a - low, np.pi)).min(axis=1, initial=np.pi)
        top, bottom = np.cos(np.maximum(apart - SLACK, 0)), np.cos(np.minimum(widest + SLACK, np.pi))
        near, far = self.norms * w.least_norm, self.norms * w.greatest_norm
        least, most = np.minimum(near * bottom, far * bottom), np.maximum(near * top, far * top)
        room = 1 + 1e-9 * far
        return least - room, most + room

    def scores(self, of: np.ndarray, w: RowWindow) -> np.ndarray:
        """Exact scores of some anchors with the window's rows."""
        dim = min(self.q.shape[1], w.q.shape[1])
        a, x = self.q[of, :dim], w.q[:, :dim]
        if self.norms[of].max() * w.greatest_norm < 2.0**52:  # every partial sum is a whole double
            return (a.astype(np.float64) @ x.astype(np.float64).T).astype(np.int64)
        return a.astype(np.int64) @ x.astype(np.int64).T


class Best:
    """The k best rows of each group so far: highest score, then least id."""

    def __init__(self, floor: np.ndarray, k: int):
        self.floor, self.k = floor.astype(np.int64).copy(), k
        self.rows = np.zeros((3, 0), np.int64)  # group, score, id

    def add(self, group: np.ndarray, score: np.ndarray, ids: np.ndarray) -> None:
        if not len(group):
            return
        group, score, ids = np.concatenate([self.rows, np.stack([group, score, ids])], axis=1)
        by = np.lexsort((ids, -score, group))
        group, score, ids = group[by], score[by], ids[by]
        first = np.searchsorted(group, group)
        rank = np.arange(len(group)) - first
        self.rows = np.stack([group, score, ids])[:, rank < self.k]
        last = rank == self.k - 1
        self.floor[group[last]] = np.maximum(self.floor[group[last]], score[last])


LOWEST = -(1 << 63)


def _positives(load: Callable[[], Block], k: int) -> Callable:
    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = load()
        best = Best(np.full(len(block.ids), LOWEST), k)
        for w in RowWindow.of(batches):
            _, most = block.bounds(w)
            own = np.flatnonzero((most >= best.floor) & np.isin(block.labels, w.labels))
            if len(own):
                score = block.scores(own, w)
                good = (block.labels[own, None] == w.labels) & (block.ids[own, None] != w.ids) & (score >= best.floor[own, None])
                at, x = np.nonzero(good)
                best.add(own[at], score[at, x], w.ids[x])
        anchor, score, ids = best.rows
        none = np.zeros(len(anchor), np.int64)
        yield _found(block.ids[anchor], anchor, none, none, none, ids, score)

    return of


def _found(*columns: np.ndarray) -> pa.RecordBatch:
    names = [c.split() for c in FOUND.split(", ")]
    kinds = {"long": pa.int64(), "int": pa.int32()}
    return pa.RecordBatch.from_arrays([pa.array(x).cast(kinds[t]) for x, (_, t) in zip(columns, names, strict=True)], [n for n, _ in names])


@dataclass(frozen=True)
class Pairs:
    """Positives of a block's anchors and the least and greatest score of their negatives."""

    anchor: np.ndarray
    positive: np.ndarray
    score: np.ndarray
    low: np.ndarray
    high: np.ndarray


def _negatives(load: Callable[[], tuple[Block, Pairs]], k: int) -> Callable:
    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, pairs = load()
        best = Best(pairs.low, k)
        for w in RowWindow.of(batches):
            least, most = block.bounds(w)
            wanted = np.flatnonzero((most[pairs.anchor] >= best.floor) & (least[pairs.anchor] <= pairs.high))
            if len(wanted):
                own, back = np.unique(pairs.anchor[wanted], return_inverse=True)
                score = block.scores(own, w)
                other = block.labels[own, None] != w.labels
                good = other[back] & (score[back] >= best.floor[wanted, None]) & (score[back] <= pairs.high[wanted, None])
                at, x = np.nonzero(good)
                best.add(wanted[at], score[back[at], x], w.ids[x])
        pair, score, ids = best.rows
        anchor = pairs.anchor[pair]
        yield _found(block.ids[anchor], anchor, pair, pairs.positive[pair], pairs.score[pair], ids, score)

    return of


def index(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The stored angles of prepared rows, and their windows."""
    spark = rows.sparkSession
    drawn = rows.orderBy(F.xxhash64(F.lit("directions"), "vec_id")).limit(SAMPLE).select("vector").collect()
    values = [np.asarray(r.vector, np.float64) for r in drawn]
    q = scaled(padded(values, max((len(v) for v in values), default=0)))
    directions = choose_directions(q[norms_of(q) < LONGEST])
    angles = stored(rows.mapInArrow(_measure(directions), ANGLES), "angles")
    parts = max(-(-angles.count() // PART_ROWS), int(spark.conf.get("spark.sql.shuffle.partitions")))
    order = ["near", "angle", "vec_id", "place"]
    placed = angles.drop("anchor").withColumn("place", F.monotonically_increasing_id())  # so that repeated rows can part
    lain = placed.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    return angles, stored(lain.mapInArrow(_group, WINDOWS), "windows")


def _block(rows: pa.Table) -> Block:
    q = [np.frombuffer(v, "<i4") for v in rows.column("q").to_pylist()]
    angles = [np.frombuffer(v) for v in rows.column("angles").to_pylist()]
    return Block(
        rows.column("vec_id").to_numpy(), rows.column("label").to_numpy(), padded(q, max(len(v) for v in q)).astype(np.int32),
        rows.column("norm").to_numpy(), np.stack(angles),
    )


def _first(found: DataFrame, k: int, *group: str) -> DataFrame:
    ranked = Window.partitionBy(*group).orderBy(F.desc("score"), "id")
    return found.withColumn("rank", F.row_number().over(ranked)).where(F.col("rank") <= k)


def mine(
    rows: DataFrame, anchor: Column, positives: int = 5, negatives: int = 5, low: int = 80, high: int = 100,
    vec_id: str = "vec_id", vector: str = "embedding", label: str = "label",
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score."""
    spark = rows.sparkSession
    angles, windows = index(prepared(rows, anchor, vec_id, vector, label))
    asked = angles.where("anchor").dropDuplicates(["vec_id", "label", "q"]).select("vec_id", "label", "q", "norm", "angles")
    asked = stored(asked.withColumn("lot", F.xxhash64("vec_id", "label", "q")), "anchors")
    blocks = -(-asked.count() // ANCHORS)
    parts = []
    for i in range(blocks):
        table = asked.where(F.pmod("lot", F.lit(blocks)) == i).toArrow()
        if not table.num_rows:
            continue
        block = _block(table)
        near = _first(windows.mapInArrow(_positives(shipped(spark, block), positives), FOUND), positives, "anchor_no")
        found = sorted((r.anchor_no, r["rank"], r.id, r.score) for r in near.select("anchor_no", "rank", "id", "score").collect())
        # In exact integers: low * positive <= 100 * negative <= high * positive.
        limits = [(a, p, s, -(-low * s // 100), high * s // 100) for a, _, p, s in found]
        limits = [x for x in limits if x[3] <= x[4]]
        if limits:
            pairs = Pairs(*(np.array(x, np.int64) for x in zip(*limits, strict=True)))
            hard = windows.mapInArrow(_negatives(shipped(spark, (block, pairs)), negatives), FOUND)
            parts.append(stored(_first(hard, negatives, "pair"), "negatives"))
    none = spark.createDataFrame([], FOUND + ", rank int")
    total = parts[0] if parts else none
    for more in parts[1:]:
        total = total.unionByName(more)
    return total.select(
        F.col("anchor").alias("anchor_id"), "positive_id", "rank", F.col("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score")
    )
