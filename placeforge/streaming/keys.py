"""Keys seen so far, for as long as the stream runs: stored by hash buckets in segments that merge like a log."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.shaping import first_by
from ..sources.tables import remove

#: Hash buckets, segments that are merged at once, and how many hashes of a batch are looked up by value.
BUCKETS, FAN, LOOKUPS = 64, 8, 1_000


@dataclass(frozen=True)
class KeyStore:
    """A table of keys under ``path``.

    Batch n adds the segment [n, n + 1); whenever FAN segments of a size are full they become one. Which segments count
    before batch n is what n is in base FAN, so no list of them is kept, and a batch that runs again finds and writes the
    same. There are at most FAN - 1 segments of a size, and a size for each power of FAN, so a key is rewritten a
    logarithmic number of times. A batch reads the buckets that its keys fall into. If it has few, their hashes go into
    the scan, where each file's own Bloom filter on the hash tells whether it need be read at all.
    """

    spark: SparkSession
    path: str
    keys: tuple[str, ...]
    buckets: int = BUCKETS
    fan: int = FAN

    def segment(self, start: int, end: int) -> str:
        return f"{self.path}/segment={start}-{end}"

    def segments(self, n: int) -> list[tuple[int, int]]:
        """The segments that hold the batches before n."""
        out, start, size = [], 0, 1
        while size * self.fan <= n:
            size *= self.fan
        while size:
            while start + size <= n:
                out.append((start, start + size))
                start += size
            size //= self.fan
        return out

    def hashed(self, rows: DataFrame) -> DataFrame:
        h = F.xxhash64(*[F.col(k) for k in self.keys])
        return rows.withColumns({"_hash": h, "_bucket": F.pmod(h, F.lit(self.buckets)).cast("int")})

    def read(self, parts: list[tuple[int, int]], schema) -> DataFrame:
        return self.spark.read.schema(schema).option("basePath", self.path).parquet(*[self.segment(*p) for p in parts])

    def write(self, keys: DataFrame, start: int, end: int) -> None:
        """A file a bucket, in the order of the hash."""
        writer = keys.repartition("_bucket").sortWithinPartitions("_bucket", "_hash").write.mode("overwrite").partitionBy("_bucket")
        writer.option("parquet.bloom.filter.enabled#_hash", "true").parquet(self.segment(start, end))

    def known(self, batch: DataFrame, n: int) -> DataFrame | None:
        """The stored keys that can be among the batch's, from its buckets alone; None if nothing is stored."""
        parts = self.segments(n)
        if not parts:
            return None
        stored = self.read(parts, batch.select(*self.keys, "_hash", "_bucket").schema)
        touched = [r[0] for r in batch.select("_bucket").distinct().collect()]  # at most one a bucket
        stored = stored.where(F.col("_bucket").isin(touched))
        few = [r[0] for r in batch.select("_hash").distinct().limit(LOOKUPS + 1).collect()]
        return stored.where(F.col("_hash").isin(few)) if len(few) <= LOOKUPS else stored

    def add(self, batch: DataFrame, n: int, order: list[str]) -> DataFrame:
        """Store the keys of batch n that no batch before has; returns them. ``order`` says which row of a key counts."""
        columns = [*self.keys, "_hash", "_bucket"]
        new = first_by(self.hashed(batch), list(self.keys), [F.col(c) for c in order]).select(*columns).persist()
        try:
            known = self.known(new, n)
            fresh = new
            if known is not None:
                same = [new[k].eqNullSafe(known[k]) for k in columns]  # null is a key as any other
                fresh = new.join(known, same, "left_anti")
            self.write(fresh, n, n + 1)
            self.merge(n + 1, fresh)
        finally:
            new.unpersist()
        return self.read([(n, n + 1)], fresh.schema).select(*self.keys)

    def full(self, n: int) -> list[tuple[tuple[int, int], list[tuple[int, int]]]]:
        """The segments that are complete with n batches, each with the smaller ones that it is made of."""
        out, size = [], self.fan
        while n and n % size == 0:
            out.append(((n - size, n), [(k, k + size // self.fan) for k in range(n - size, n, size // self.fan)]))
            size *= self.fan
        return out

    def merge(self, n: int, like: DataFrame) -> None:
        """Make the segments that n batches complete; what those of n - 1 batches were made of is asked for by nobody now."""
        for whole, parts in self.full(n):
            self.write(self.read(parts, like.schema), *whole)
        for _, parts in self.full(n - 1):
            for part in parts:
                remove(self.spark, self.segment(*part))

    def all(self, n: int, schema) -> DataFrame:
        """The keys of the first n batches."""
        return self.read(self.segments(n), schema).select(*self.keys)
