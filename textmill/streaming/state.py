"""The newest row of every key, kept up to date step by step.

Keys fall into buckets by hash. A step adds its rows as a delta of the buckets
it touches; where a bucket's deltas would outgrow a part of its base, they make
a new base with it. So a row is written a number of times that grows
with the logarithm of its bucket, and a read resolves versions among the deltas
and the base rows of the same keys only: all other base rows pass as they are.

Every delta and base is a folder of its own epoch. A log names those that
count; a folder that it doesn't name, as an interrupted step leaves it, is
never read and is overwritten by the step's next attempt. Which row of a key
counts depends on the rows alone, so a step may come twice.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from textmill.operators.dedup import latest_by_key
from textmill.schemas import EPOCHS
from textmill.sinks.files import balanced

BUCKETS = 32
# Deltas of more than this part of their base's rows are compacted with it.
COMPACTED = 0.25

_BUCKET = "_bucket"


@dataclass(frozen=True)
class Newest:
    """The state in a folder: the row with the greatest `recency` for each of the `keys`."""

    spark: SparkSession
    path: str
    schema: T.StructType
    keys: Sequence[str]
    recency: Sequence[str]
    buckets: int = BUCKETS

    # --- what counts ------------------------------------------------------------------

    def epochs(self) -> DataFrame:
        """`epoch, bucket, base, rows` of all deltas and bases that were completed."""
        try:
            return self.spark.read.schema(EPOCHS).parquet(f"{self.path}/_epochs")
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], EPOCHS)

    def live(self) -> DataFrame:
        """`epoch, bucket, base, rows` of each bucket's newest base and the deltas after it."""
        epochs = self.epochs()
        bases = epochs.filter("base").groupBy("bucket").agg(F.max("epoch").alias("_base"))
        live = F.col("_base").isNull() | F.when(F.col("base"), F.col("epoch") == F.col("_base")).otherwise(
            F.col("epoch") > F.col("_base")
        )
        return epochs.join(bases, "bucket", "left").filter(live).select(*epochs.columns)

    def superseded(self) -> DataFrame:
        """`folder` of what is no longer read; nothing is deleted here."""
        gone = self.epochs().join(self.live(), ["epoch", "bucket", "base"], "left_anti")
        return gone.select(F.concat(F.lit(self.path), F.lit("/"), _folder()).alias("folder"))

    def _rows(self, live: list, base: bool) -> DataFrame | None:
        paths = [f"{self.path}/{_name(r['epoch'], r['bucket'], r['base'])}" for r in live if r["base"] == base]
        return self.spark.read.schema(self.schema).parquet(*paths) if paths else None

    # --- reading ----------------------------------------------------------------------

    def read(self) -> DataFrame:
        """The newest row of each key."""
        # At most one base a bucket and the deltas since.
        live = self.live().collect()
        base, deltas = self._rows(live, True), self._rows(live, False)
        if deltas is None:
            return base if base is not None else self.spark.createDataFrame([], self.schema)
        if base is None:
            return latest_by_key(deltas, self.keys, self.recency)
        touched = deltas.select(*[F.col(k).alias(f"_{k}") for k in self.keys]).distinct()
        same = reduce(lambda a, b: a & b, (F.col(k).eqNullSafe(F.col(f"_{k}")) for k in self.keys))
        contested = base.join(touched, same, "left_semi").union(deltas)
        return base.join(touched, same, "left_anti").union(latest_by_key(contested, self.keys, self.recency))

    # --- writing ----------------------------------------------------------------------

    def add(self, rows: DataFrame) -> None:
        """Take in a step's rows: as a delta, or at once with a new base where the deltas outgrow the old one.

        The rows are read twice, the first time for their keys alone.
        """
        rows = rows.select(*self.schema.names)
        coming = rows.groupBy(self._bucket().alias("bucket")).agg(F.count("*").alias("coming"))
        sizes = self.live().groupBy("bucket").agg(
            F.coalesce(F.sum(F.when(F.col("base"), F.col("rows"))), F.lit(0)).alias("old"),
            F.coalesce(F.sum(F.when(~F.col("base"), F.col("rows"))), F.lit(0)).alias("new"),
        )
        due = F.col("coming") + F.coalesce("new", F.lit(0)) > F.coalesce("old", F.lit(0)) * COMPACTED
        # At most `buckets` rows.
        touched = coming.join(sizes, "bucket", "left").select("bucket", due.alias("due")).collect()
        full = [r["bucket"] for r in touched if r["due"]]
        if len(full) < len(touched):
            some = rows.filter(~self._bucket().isin(*full)) if full else rows
            self._write(latest_by_key(some, self.keys, self.recency), base=False)
        if full:
            old, some = self._stored(full), rows.filter(self._bucket().isin(*full))
            both = some if old is None else old.union(some)
            self._write(latest_by_key(both, self.keys, self.recency), base=True)

    def _bucket(self) -> F.Column:
        return F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("int")

    def _stored(self, buckets: Sequence[int]) -> DataFrame | None:
        """All rows of some buckets, also those that are not the newest any more."""
        live = [r for r in self.live().collect() if r["bucket"] in buckets]
        found = [df for base in (True, False) if (df := self._rows(live, base)) is not None]
        return reduce(DataFrame.union, found) if found else None

    def _write(self, rows: DataFrame, base: bool) -> None:
        number = self.epochs().agg(F.coalesce(F.max("epoch"), F.lit(-1)) + 1).first()[0]
        folder = f"{self.path}/{_name(number, None, base)}"
        marked = rows.withColumn(_BUCKET, self._bucket())
        balanced(marked, _BUCKET).write.mode("overwrite").partitionBy(_BUCKET).parquet(folder)
        written = self.spark.read.schema(T.StructType([*self.schema.fields, T.StructField(_BUCKET, T.IntegerType())]))
        counts = written.parquet(folder).groupBy(F.col(_BUCKET).alias("bucket")).agg(F.count("*").alias("rows"))
        done = counts.select(F.lit(number).cast("bigint").alias("epoch"), "bucket", F.lit(base).alias("base"), "rows")
        done.coalesce(1).write.mode("append").parquet(f"{self.path}/_epochs")


def _name(epoch: int, bucket: int | None, base: bool) -> str:
    name = f"{'base' if base else 'delta'}-{epoch}"
    return name if bucket is None else f"{name}/{_BUCKET}={bucket}"


def _folder() -> F.Column:
    kind = F.when(F.col("base"), "base-").otherwise("delta-")
    return F.concat(kind, F.col("epoch").cast("string"), F.lit(f"/{_BUCKET}="), F.col("bucket").cast("string"))
