"""An online table in folders by hash of the key, so that a lookup opens its keys' folders only.

The table is a log: a push adds one folder of newest rows, with a folder for each
bucket in it.  Reads merge what a bucket's folders hold by the upsert rule; an
upsert or a compaction puts a bucket's rows together in a new folder and then
removes the ones it read.  Rows keep the time and name of their first write, so
merging a row twice changes nothing: if a writer is lost between the two steps,
or two writers work on one bucket at a time, the table still says the same.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.commits import Taken, put_once, remove
from tidemark.operators.joins import semi_requested
from tidemark.operators.windows import dedup_latest, extreme_per_key

SOURCE, BUCKET = "log_source", "log_bucket"
COMMITTED, WRITER = "log_committed", "log_writer"
BUCKETS = 256


class OnlineTable:
    """Newest row per key at ``path``; the number of buckets is fixed by the table's first user."""

    def __init__(
        self,
        spark: SparkSession,
        path: str,
        keys: Sequence[str],
        ts: str,
        created: str | None = None,
        buckets: int = BUCKETS,
    ):
        self.spark, self.path = spark, path.rstrip("/")
        self.keys, self.ts, self.created, self.buckets = list(keys), ts, created, buckets
        made = json.dumps({"keys": self.keys, "buckets": buckets})
        about = f"{self.path}/_about/table.json"
        try:
            put_once(spark, about, made)
        except Taken:
            stored = spark.read.option("wholetext", True).text(about).first()[0]
            if stored != made:
                raise ValueError(f"the table was made with {stored}, not with {made}") from None

    def bucket_of(self) -> Column:
        """The bucket of a key; equal texts, numbers and NULLs share one whatever the frame."""
        return F.pmod(F.xxhash64(*(F.col(k).cast("string") for k in self.keys)), F.lit(self.buckets)).cast("int")

    def append(self, df: DataFrame, push: str | None = None) -> None:
        """Add the newest rows of a push; a push of the same name replaces its folder."""
        name = push or f"push-{uuid.uuid4().hex}"
        newest = dedup_latest(df, self.keys, self.ts, self.created).withColumns(
            {COMMITTED: F.lit(time.time_ns() // 1000), WRITER: F.lit(name)}
        )
        self._write(newest, name)

    def _write(self, rows: DataFrame, source: str) -> None:
        placed = rows.withColumn(BUCKET, self.bucket_of()).hint("rebalance", BUCKET)
        placed.write.mode("overwrite").partitionBy(BUCKET).parquet(f"{self.path}/{SOURCE}={source}")

    def log(self, buckets: Sequence[int] | None = None) -> DataFrame | None:
        """Stored rows of all folders, or of some buckets' folders; None before the first write."""
        try:
            rows = self.spark.read.parquet(self.path)
        except AnalysisException as error:
            if error.getCondition() in ("UNABLE_TO_INFER_SCHEMA", "PATH_NOT_FOUND"):
                return None
            raise
        return rows if buckets is None else rows.filter(F.col(BUCKET).isin(list(buckets)))

    def _newest(self, rows: DataFrame) -> DataFrame:
        """One row per key: the newest event, at equal times the one written first."""
        kept = rows.withColumn(COMMITTED, -F.col(COMMITTED))
        kept = extreme_per_key(kept.drop(SOURCE, BUCKET), self.keys, [self.ts, COMMITTED, WRITER], newest=True)
        return kept.withColumn(COMMITTED, -F.col(COMMITTED))

    def read(self, buckets: Sequence[int] | None = None) -> DataFrame:
        """The whole table, or some buckets of it."""
        return self._newest(self._stored(buckets)).drop(COMMITTED, WRITER)

    def _stored(self, buckets: Sequence[int] | None = None) -> DataFrame:
        rows = self.log(buckets)
        if rows is None:
            raise ValueError(f"nothing was written to {self.path}")
        return rows

    def _touched(self, df: DataFrame) -> list[int]:
        """Buckets of the frame's keys: at most as many numbers as the table has buckets."""
        return sorted(r[0] for r in df.select(self.bucket_of().alias(BUCKET)).distinct().collect())

    def requested(self, requests: DataFrame) -> DataFrame:
        """The newest rows of the requested keys; only the folders of their buckets are opened."""
        asked = semi_requested(self._stored(self._touched(requests)), requests, self.keys)
        return self._newest(asked).drop(COMMITTED, WRITER)

    def lookup(self, requests: DataFrame) -> DataFrame:
        """Each request row with its key's stored row, NULL where there is none."""
        return requests.join(self.requested(requests), self.keys, "left")

    def upsert(self, df: DataFrame) -> list[int]:
        """Merge a push at once, rewriting the buckets of its keys; returns them.

        A reader that listed the replaced folders before has to read again.
        """
        name = f"push-{uuid.uuid4().hex}"
        newest = dedup_latest(df, self.keys, self.ts, self.created).withColumns(
            {COMMITTED: F.lit(time.time_ns() // 1000), WRITER: F.lit(name)}
        )
        buckets = self._touched(newest)
        self._rewrite(buckets, newest)
        return buckets

    def compact(self, folders: int = 2) -> list[int]:
        """Put together the rows of buckets that have ``folders`` folders or more; returns them."""
        rows = self._stored()
        counted = rows.groupBy(BUCKET).agg(F.count_distinct(SOURCE).alias("n")).where(F.col("n") >= folders)
        buckets = sorted(r[BUCKET] for r in counted.collect())
        self._rewrite(buckets, None)
        return buckets

    def _rewrite(self, buckets: Sequence[int], fresh: DataFrame | None) -> None:
        if not buckets:
            return
        stored, replaced = self.log(buckets), []
        if stored is not None:
            listed = stored.select(SOURCE, BUCKET).distinct().collect()  # folders, not rows
            replaced = [f"{self.path}/{SOURCE}={r[SOURCE]}/{BUCKET}={r[BUCKET]}" for r in listed]
            kept = stored.drop(SOURCE, BUCKET)
            stored = kept if fresh is None else kept.unionByName(fresh)
        self._write(self._newest(fresh if stored is None else stored), f"base-{uuid.uuid4().hex}")
        for folder in replaced:
            remove(self.spark, folder)
