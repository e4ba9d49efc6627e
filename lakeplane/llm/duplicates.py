"""Records that are the same but for their formatting, counted by an incremental ledger.

A record's canonical key ignores field order and, in names and values, case, white space of any kind, control and
zero-width characters, punctuation and symbols; in number fields the decimal point and the minus sign stay. The ledger
holds per key the number of copies and the earliest representative (the smallest record id), in buckets by key. A batch
is aggregated by key before it is shuffled, and is joined by full outer join with the ledger's matching buckets
only; these are written anew, and the other buckets stay where they are. The ledger is a folder that outlives the run: each
version's list of buckets is written last, so that a batch counts wholly or not at all, and a batch that was taken in
before, by its name, is taken in once. Buckets are split as the ledger grows.

Rows that aren't a JSON object compare by their whole text in the same way. A null row is no record and is left out.
Accents count; composed and decomposed letters differ. Empty batches change nothing.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeplane import scratch
from lakeplane.scratch import cut, release

#: Buckets of a new ledger, and rows per bucket beyond which all are split in two. Numbers of buckets are powers of two.
BUCKETS, BUCKET_ROWS = 64, 4_000_000
#: Rows that one task writes.
TASK_ROWS = 1_000_000
_STRIP = r"\p{P}\p{S}\p{Z}\p{C}\s"


def _fold(text: Column, number: Column | None = None) -> Column:
    """Upper case first, so that letters with one upper case compare equal; sharp s is two letters in upper case."""
    plain = F.replace(F.lower(F.upper(F.regexp_replace(text, f"[{_STRIP}]", ""))), F.lit("ß"), F.lit("ss"))
    if number is None:
        return plain
    return F.when(number, F.regexp_replace(F.translate(text, "−", "-"), f"[{_STRIP}&&[^.\\-]]", "")).otherwise(plain)


def canonical_key(row_json: str, number_fields: Sequence[str] = ("amount",)) -> Column:
    """128 bits of a record's canonical form; null for a null record."""
    entries = F.map_entries(F.from_json(row_json, "map<string,string>"))

    def canonical(entry: Column) -> Column:
        name = _fold(entry["key"])
        value = _fold(entry["value"], name.isin([n.lower() for n in number_fields]))
        return F.concat(name, F.coalesce(F.concat(F.lit("="), value), F.lit("~")))  # marks are stripped from names and values

    fields = F.array_join(F.array_sort(F.transform(entries, canonical)), "|")
    text = F.coalesce(F.concat(F.lit("{"), fields), F.concat(F.lit("!"), _fold(F.col(row_json))))
    return F.substring(F.unhex(F.sha2(text, 256)), 1, 16)


def with_keys(records: DataFrame, record_id: str, row_json: str, number_fields: Sequence[str] = ("amount",), extra: Sequence[str] = ()) -> DataFrame:
    """key, record_id, *extra of each record."""
    return records.where(F.col(row_json).isNotNull()).select(canonical_key(row_json, number_fields).alias("key"), F.col(record_id).alias("record_id"), *extra)


def count_batch(keyed: DataFrame) -> DataFrame:
    """key, n_copies, first_record_id of one batch."""
    return keyed.groupBy("key").agg(F.count(F.lit(1)).alias("n_copies"), F.min("record_id").alias("first_record_id"))


class Ledger:
    """The counts of all canonical keys seen so far, in a folder that all executors share."""

    COLUMNS = "key binary, n_copies long, first_record_id long"

    def __init__(self, spark: SparkSession, path: str, buckets: int = BUCKETS, bucket_rows: int = BUCKET_ROWS):
        if buckets & (buckets - 1):
            raise ValueError("the number of buckets has to be a power of two")
        self.spark, self.path, self.bucket_rows = spark, path.rstrip("/"), bucket_rows
        self.version, self.buckets, self.where, self.batches = 0, buckets, {}, set()
        self.most = 0  # rows at most: keys of all batches, as if none had been there before
        versions = [n for n in scratch.children(spark, f"{self.path}/list") if scratch.exists(spark, f"{self.path}/list/{n}/_SUCCESS")]
        if versions:
            self.version = max(map(int, versions))
            # a row per bucket, and a name per batch
            for r in spark.read.schema("kind string, bucket int, version long, batch string").parquet(f"{self.path}/list/{self.version:09d}").collect():
                if r["kind"] == "bucket":
                    self.where[r["bucket"]] = r["version"]
                elif r["kind"] == "batch":
                    self.batches.add(r["batch"])
                else:
                    self.buckets, self.most = r["bucket"], r["version"]

    def read(self, only: Iterable[int] | None = None) -> DataFrame:
        """bucket, key, n_copies, first_record_id; of some buckets if wanted. Other buckets' files aren't listed or read."""
        wanted = sorted(self.where if only is None else set(only) & set(self.where))
        out = self.spark.createDataFrame([], f"bucket int, {self.COLUMNS}")
        by_version: dict[int, list[int]] = {}
        for b in wanted:
            by_version.setdefault(self.where[b], []).append(b)
        for version, held in by_version.items():
            base = f"{self.path}/data/{version:09d}"
            part = self.spark.read.schema(f"{self.COLUMNS}, bucket int").option("basePath", base).parquet(*[f"{base}/bucket={b}" for b in held])
            out = out.unionByName(part)
        return out

    def bucket(self) -> Column:
        return F.pmod(F.xxhash64("key"), F.lit(self.buckets)).cast("int")

    def _write(self, rows: DataFrame, n_rows: int) -> None:
        """Put the rows' buckets in the next version's folder."""
        # a bucket of many rows is written by several tasks
        tasks = max(1, -(-n_rows // TASK_ROWS))
        slices = max(1, -(-tasks // self.buckets))
        spread = rows.repartition(min(max(tasks, 8), self.buckets * slices), "bucket", F.pmod(F.xxhash64("key", F.lit(1)), F.lit(slices)))
        spread.write.mode("overwrite").partitionBy("bucket").option("compression", "zstd").parquet(f"{self.path}/data/{self.version + 1:09d}")

    def _commit(self, where: dict[int, int], batch: str | None) -> None:
        self.version, self.where = self.version + 1, where
        if batch is not None:
            self.batches.add(batch)
        rows = [("bucket", b, v, None) for b, v in sorted(where.items())] + [("batch", None, None, b) for b in sorted(self.batches)] + [("buckets", self.buckets, self.most, None)]
        self.spark.createDataFrame(rows, "kind string, bucket int, version long, batch string").coalesce(1).write.mode("overwrite").parquet(f"{self.path}/list/{self.version:09d}")

    def update(self, keyed: DataFrame, batch: str | None = None) -> list[int]:
        """Take in a batch of key, record_id; gives the buckets that it touched. A batch of a known name is taken for done."""
        if batch is not None and batch in self.batches:
            return []
        new = cut(count_batch(keyed).withColumn("bucket", self.bucket()))
        sizes = {r["bucket"]: r["count"] for r in new.groupBy("bucket").count().collect()}  # at most the number of buckets
        if sizes:
            old = self.read(sizes).select("bucket", "key", F.col("n_copies").alias("n0"), F.col("first_record_id").alias("first0"))
            merged = old.join(new, ["bucket", "key"], "full_outer").select("bucket", "key", (F.coalesce("n0", F.lit(0)) + F.coalesce("n_copies", F.lit(0))).alias("n_copies"), F.least("first0", "first_record_id").alias("first_record_id"))
            self.most += sum(sizes.values())
            self._write(merged, -(-self.most * len(sizes) // self.buckets))
        self._commit(self.where | dict.fromkeys(sizes, self.version + 1), batch)
        release(new)
        self._split()
        return sorted(sizes)

    def _split(self) -> None:
        """Halve the buckets while they hold too many rows on average."""
        if self.most <= self.bucket_rows * self.buckets:
            return
        total = self.most = self.read().count()
        while total > self.bucket_rows * self.buckets:
            self.buckets *= 2
            rows = self.read().withColumn("bucket", self.bucket())
            self._write(rows, total)
            held = [int(n.split("=")[1]) for n in scratch.children(self.spark, f"{self.path}/data/{self.version + 1:09d}") if n.startswith("bucket=")]
            self._commit(dict.fromkeys(held, self.version + 1), None)


def copies(keyed: DataFrame, ledger: DataFrame) -> DataFrame:
    """first_record_id, record_id of each record that isn't its group's first; a group of n copies gives n - 1 rows.

    The ledger has one row per key, so a group of any size is joined row by row; adaptive execution splits hot keys.
    """
    repeated = ledger.where(F.col("n_copies") > 1).select("key", "first_record_id")
    return keyed.join(repeated, "key").where(F.col("record_id") != F.col("first_record_id")).select("first_record_id", "record_id")
