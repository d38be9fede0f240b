"""Result tables that streaming batches update, safe against replays and lost executors.

A batch rewrites only the parts it touches, into a folder of its own; the folder counts once its
marker file is written. Replaying a batch starts again from the state before it, so every batch
may run any number of times. Reads take the newest committed copy of each part.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

MARKER = "_parts"


# Parts of tables that are kept by symbol: an update of one symbol rewrites one of them.
SYMBOL_PARTS = 64


def by_symbol() -> Column:
    return F.pmod(F.xxhash64("symbol"), F.lit(SYMBOL_PARTS))


class StateTable:
    """``part`` maps a row to the integer part that is rewritten as a unit."""

    def __init__(self, spark: SparkSession, base: str, schema: str, part: Column | None = None):
        self.spark, self.base, self.schema = spark, base.rstrip("/"), schema
        self.part = (part if part is not None else F.lit(0)).cast("bigint")

    # Driver-side file operations touch folder names and one small marker per batch only.

    def _fs(self, path: str):
        p = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(self.spark._jsc.hadoopConfiguration()), p

    def _committed(self, before: int | None) -> dict[int, list[int]]:
        """Batch id -> parts, newest first."""
        fs, base = self._fs(self.base)
        if not fs.exists(base):
            return {}
        found = {}
        for status in fs.listStatus(base):
            name = status.getPath().getName()
            if not name.startswith("batch="):
                continue
            batch = int(name[len("batch="):])
            _, marker = self._fs(f"{self.base}/{name}/{MARKER}")
            if (before is None or batch < before) and fs.exists(marker):
                stream = fs.open(marker)
                text = stream.readUTF()
                stream.close()
                found[batch] = [int(x) for x in text.split(",") if x]
        return dict(sorted(found.items(), reverse=True))

    def read(self, before: int | None = None, parts: Iterable[int] | None = None) -> DataFrame:
        """Rows committed by batches older than ``before``, optionally of some parts only."""
        wanted = None if parts is None else set(parts)
        seen: set[int] = set()
        paths = []
        for batch, touched in self._committed(before).items():
            for part in touched:
                if part in seen or (wanted is not None and part not in wanted):
                    continue
                seen.add(part)
                fs, p = self._fs(f"{self.base}/batch={batch}/part={part}")
                if fs.exists(p):
                    paths.append(p.toString())
        if not paths:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(*paths)

    def touched(self, df: DataFrame) -> list[int]:
        """Parts present in ``df``: as many as the batch has time buckets, not rows."""
        return sorted(r[0] for r in df.select(self.part.alias("p")).distinct().collect())

    def write(self, df: DataFrame, batch: int, parts: Iterable[int]) -> None:
        """Replace ``parts`` by ``df``, which holds all of their rows; a part may become empty."""
        folder = f"{self.base}/batch={batch}"
        # Rebalancing gives few files per part and splits a part that has very many rows.
        rows = df.withColumn("part", self.part).hint("rebalance", "part")
        rows.write.mode("overwrite").partitionBy("part").parquet(folder)
        fs, marker = self._fs(f"{folder}/{MARKER}")
        out = fs.create(marker, True)
        out.writeUTF(",".join(str(p) for p in sorted(parts)))
        out.close()

    def prune(self, batch: int, oldest_part: int | None = None) -> None:
        """Delete folders that neither ``batch`` nor a replay of it can need any more."""
        seen: set[int] = set()
        for older, touched in self._committed(batch).items():
            live = {p for p in touched if p not in seen and (oldest_part is None or p >= oldest_part)}
            seen |= live
            if not live:
                fs, path = self._fs(f"{self.base}/batch={older}")
                fs.delete(path, True)

    def merge(self, df: DataFrame, batch: int, fn: Callable[[DataFrame, DataFrame], DataFrame]) -> None:
        """Rewrite the touched parts as ``fn(stored rows, new rows)``."""
        parts = self.touched(df)
        self.write(fn(self.read(batch, parts), df), batch, parts)
