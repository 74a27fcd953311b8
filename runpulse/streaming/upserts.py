"""The newest row per key of a stream, as a log of segments that is merged as it grows.

Each batch is stored as a segment of level 0. When a level has `fan` segments, they are merged into one of the next level, newest
row per key, so a row is rewritten once per level and a reader meets fewer than `fan` segments per level however many
batches there were. A manifest per batch names the segments that count. A batch that runs again starts from the manifest before
it, whose segments are still there, and writes the same ones once more; segments that neither this nor the last manifest
names are deleted.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql import types as T


class Upserts:
    """Rows of `schema` below `path`, one per `keys`. In a batch the row with the largest `version` counts (then any order of its
    columns); a later batch replaces an earlier one. With `expire` = (column, days) rows whose column lies more than that before
    the newest one are left out by merges and readers. Keys can be null."""

    def __init__(
        self, path: str, schema: T.StructType, keys: list[str], version: list[str] | None = None, fan: int = 8,
        expire: tuple[str, int] | None = None,
    ):
        self.path, self.schema, self.keys, self.fan, self.expire = path, schema, keys, fan, expire
        self.version = version or []

    def _fs(self, spark: SparkSession, name: str):
        place = spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}")
        return place.getFileSystem(spark._jsc.hadoopConfiguration()), place

    def _manifests(self, spark: SparkSession) -> list[int]:
        """Numbers of the batches whose manifests are kept: two or three."""
        fs, place = self._fs(spark, "manifests")
        if not fs.exists(place):
            return []
        return sorted(int(f.getPath().getName()) for f in fs.listStatus(place) if f.getPath().getName().isdigit())

    def segments(self, spark: SparkSession, before: int | None = None) -> list[tuple[int, int]]:
        """(level, last batch) of the segments that count after the last batch, or the last one before `before`."""
        known = [n for n in self._manifests(spark) if before is None or n < before]
        if not known:
            return []
        line = spark.read.text(f"{self.path}/manifests/{known[-1]}").first()[0]
        return [tuple(s) for s in json.loads(line)]

    def _read(self, spark: SparkSession, segments: list[tuple[int, int]]) -> DataFrame:
        full = T.StructType([*self.schema.fields, T.StructField("_batch", T.LongType())])
        if not segments:
            return spark.createDataFrame([], full)
        return spark.read.schema(full).parquet(*[f"{self.path}/segments/{level}-{last}" for level, last in segments])

    def _newest(self, rows: DataFrame) -> DataFrame:
        """One row per key; long columns are added up before the shuffle."""
        rest = [c for c in self.schema.fieldNames() if c not in self.keys]
        row = F.struct("_batch", *[F.col(c).alias(f"_version_{i}") for i, c in enumerate(self.version)], *rest)
        newest = rows.groupBy(*self.keys).agg(F.max(row).alias("_row"))
        rows = newest.select(*[F.col(c) if c in self.keys else F.col(f"_row.{c}").alias(c) for c in self.schema.fieldNames()], "_row._batch")
        if self.expire is None:
            return rows
        column, days = self.expire
        last = rows.agg(F.max(column)).scalar()
        return rows.filter(F.col(column) >= last - F.make_dt_interval(days=F.lit(days)))

    def current(self, spark: SparkSession, before: int | None = None) -> DataFrame:
        """The newest row per key after the last batch, or after the last one before `before`."""
        return self._newest(self._read(spark, self.segments(spark, before))).drop("_batch")

    def store(self, batch: DataFrame, batch_id: int) -> None:
        """Store a batch; run again, it leaves the same."""
        spark = batch.sparkSession
        old = self.segments(spark, batch_id)
        rows = batch.select(*self.schema.fieldNames()).withColumn("_batch", F.lit(batch_id).cast("bigint"))
        self._newest(rows).write.mode("overwrite").parquet(f"{self.path}/segments/0-{batch_id}")
        now, level = [*old, (0, batch_id)], 0
        while len(full := [s for s in now if s[0] == level]) >= self.fan:
            merged = (level + 1, batch_id)
            self._newest(self._read(spark, full)).write.mode("overwrite").parquet(f"{self.path}/segments/{merged[0]}-{merged[1]}")
            now, level = [s for s in now if s[0] != level] + [merged], level + 1
        fs, place = self._fs(spark, f"manifests/{batch_id}")
        out = fs.create(place, True)
        out.write(bytearray(json.dumps(now), "ascii"))
        out.close()
        for number in self._manifests(spark):
            if number < batch_id and number != max((n for n in self._manifests(spark) if n < batch_id), default=None):
                fs.delete(self._fs(spark, f"manifests/{number}")[1], False)
        kept = {f"{level}-{last}" for level, last in [*old, *now]}
        _, folder = self._fs(spark, "segments")
        for found in fs.listStatus(folder):
            if found.getPath().getName() not in kept:
                fs.delete(found.getPath(), True)
