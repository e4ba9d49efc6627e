"""What changed between full snapshots: invertible Bloom lookup tables (IBLTs), subtracted and peeled.

Every row of a snapshot adds (key hash, row hash) to ``HASHES`` cells of a table for its source, snapshot pair and hash
bucket; the earlier snapshot of a pair subtracts. Rows that are equal on both sides cancel, so what is shuffled after the
partial aggregation has the size of the tables, and what is left in them is the difference. A table's size follows an estimate of
its difference, made from a sixteenth of the key hashes. Tables are peeled: a cell that holds one entry gives it away, and its
removal lays others bare. Tables that cannot be emptied are enlarged and built again from their bucket's rows only; after
``TRIES`` of these the bucket's entries are summed one by one. Buckets hold a bounded number of rows whatever the size of a source.

Recovered entries are read back from the rows by key hash and row digest, every one has to be found, and the record keys are classified by
the sides on which they occur. Two keys that share a key hash differ in their rows, or end in the last way; none is lost.

Nulls: an object without usable key columns has no record keys and is left out; a null part of a key counts as ''; null
columns compare equal; rows with a null source or snapshot are ignored. Of rows with one key in a snapshot the latest by
``modified`` counts, of ties the one with the greatest hash.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakeplane.operators.bitmap_history import attribute_hash
from lakeplane.scratch import cut, release

HASHES = 3
#: Rows of a snapshot that one bucket is to hold.
BUCKET_ROWS = 4096
#: Least cells of a part of a table (there are ``HASHES`` parts); sizes are powers of ``GROW`` times this, and a failed table gets the next.
PART = 16
GROW = 4
#: How often a table is enlarged.
TRIES = 3
#: One of so many key hashes serves to estimate differences.
SAMPLE = 16
#: Buckets per group of tables that are peeled together.
GROUP_CELLS = 200_000
#: Lists of buckets beyond this number of rows are joined by shuffle.
BROADCAST_ROWS = 10_000


def key_columns(objects: DataFrame, source: str, json_column: str) -> DataFrame:
    """source, names: the key columns of each object, without case and underscores; objects without any are left out.

    The lists differ in layout, quotes and spelling; names are what stands between quotes.
    """
    names = F.transform(F.regexp_extract_all(json_column, F.lit("[\"']([^\"']+)[\"']"), 1), lambda x: F.regexp_replace(F.lower(x), "[^a-z0-9]", ""))
    return objects.select(F.col(source).alias("source"), names.alias("names")).where(F.size("names") > 0).groupBy("source").agg(F.max("names").alias("names"))


def snapshot_rows(rows: DataFrame, keys: DataFrame, source: str, snapshot: str, deleted: str | None, modified: str, columns: Sequence[str]) -> DataFrame:
    """source, at, before, record_key, kh, vh: one row per record of a snapshot, and one with a null key per snapshot.

    ``before`` is the snapshot that precedes; ``kh`` and ``vh`` are 64-bit hashes of the key and of the columns.
    """
    slim = rows.select(F.col(source).alias("source"), F.unix_micros(snapshot).alias("at"), *([F.coalesce(deleted, F.lit(False)).alias("gone")] if deleted else [F.lit(False).alias("gone")]), F.unix_micros(modified).alias("modified"), F.struct(*columns).alias("c")).where(F.col("source").isNotNull() & F.col("at").isNotNull())
    lookup = F.create_map(*[x for c in columns for x in (F.lit(c.replace("_", "").lower()), F.col(f"c.{c}").cast("string"))])
    keyed = slim.join(keys, "source")
    record_key = F.array_join(F.transform("names", lambda n: F.coalesce(F.try_element_at(lookup, n), F.lit(""))), "|")
    digest = F.xxhash64(attribute_hash([f"c.{c}" for c in columns]))
    named = keyed.where(~F.col("gone")).select("source", "at", record_key.alias("record_key"), F.struct("modified", digest.alias("vh")).alias("v"))
    single = named.groupBy("source", "at", "record_key").agg(F.max("v").alias("v")).select("source", "at", "record_key", F.xxhash64("record_key").alias("kh"), F.col("v.vh").alias("vh"))
    # a snapshot all of whose rows are deleted is still one
    times = slim.select("source", "at").distinct().withColumns({"before": F.lag("at").over(Window.partitionBy("source").orderBy("at")), "after": F.lead("at").over(Window.partitionBy("source").orderBy("at"))})
    return single.join(times, ["source", "at"])


def _mix(value: Column, seed: int) -> Column:
    return F.xxhash64(value, F.lit(seed))


def _estimates(signed: DataFrame) -> DataFrame:
    """source, at, bucket, part: cells per part of each bucket's table; buckets without a sampled difference are missing."""
    some = signed.where(F.pmod(F.xxhash64("kh", F.lit(77)), F.lit(SAMPLE)) == 0)
    entries = some.groupBy("source", "at", "bucket", "kh", "vh").agg(F.sum("sign").alias("n")).where(F.col("n") != 0)
    # 1.6 cells for each of the expected entries, a third of them in each part
    wanted = F.count(F.lit(1)) * SAMPLE * 1.6 / HASHES + PART
    return entries.groupBy("source", "at", "bucket").agg(wanted.alias("wanted")).select("source", "at", "bucket", (F.pow(F.lit(GROW), F.ceil(F.log(F.col("wanted") / PART) / F.log(F.lit(GROW)))) * PART).cast("int").alias("part"))


def _bounded(df: DataFrame) -> DataFrame:
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


def _cells(signed: DataFrame) -> DataFrame:
    """The subtracted tables: source, at, bucket, part, cell, n, keys, digests, checks; signed rows come with their table's part."""
    places = F.array(*[(F.pmod(F.xxhash64("kh", "vh", F.lit(i + 1)), F.col("part").cast("long")) + F.col("part") * i).cast("int") for i in range(HASHES)])
    each = signed.select("source", "at", "bucket", "part", "sign", "kh", "vh", F.xxhash64("kh", "vh", F.lit(99)).alias("check"), F.explode(places).alias("cell"))
    out = each.groupBy("source", "at", "bucket", "part", "cell").agg(F.sum("sign").alias("n"), F.bit_xor("kh").alias("keys"), F.bit_xor("vh").alias("digests"), F.bit_xor("check").alias("checks"))
    return out.where((F.col("n") != 0) | (F.col("keys") != 0) | (F.col("digests") != 0) | (F.col("checks") != 0))


def peel(first: np.ndarray, part: np.ndarray, n: np.ndarray, keys: np.ndarray, digests: np.ndarray, checks: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(table's first cell, key hash, row hash, sign) of all entries that come free; what is left stays in the arrays.

    The arrays hold the cells of many tables; ``first`` and ``part`` tell for each cell where its table begins and how large its
    parts are. A cell is pure if its count is 1 or -1 and its check belongs to its sums. Places depend on both hashes, else the two
    versions of a changed row would share all their cells and never come free. All pure cells are peeled at once.
    """
    from lakeplane.operators.xx64 import hash_longs

    out = []
    while True:
        i = np.flatnonzero(np.abs(n) == 1)
        i = i[hash_longs([keys[i], digests[i]], 99) == checks[i]]
        if not len(i):
            break
        # an entry may be alone in several of its cells
        _, once = np.unique(np.stack([first[i], keys[i], digests[i], n[i]]), axis=1, return_index=True)
        i = i[once]
        f, k, d, c, s = first[i], keys[i].copy(), digests[i].copy(), checks[i].copy(), n[i].copy()
        out.append((f, k, d, s))
        for h in range(HASHES):
            places = f + h * part[i] + hash_longs([k, d], h + 1) % part[i]
            np.subtract.at(n, places, s)
            np.bitwise_xor.at(keys, places, k)
            np.bitwise_xor.at(digests, places, d)
            np.bitwise_xor.at(checks, places, c)
    if not out:
        return tuple(np.zeros(0, np.int64) for _ in range(4))
    return tuple(np.concatenate(x) for x in zip(*out))


PEELED = "source string, at long, bucket long, part int, kh long, vh long, sign long"


def _peel_tables(pdf: pd.DataFrame) -> pd.DataFrame:
    """Entries of a group of tables; a table that can't be emptied gives one row with sign 0 instead."""
    names = ["source", "at", "bucket", "part"]
    table = pdf.groupby(names, sort=False).ngroup().to_numpy()
    tables = pdf[names].iloc[np.unique(table, return_index=True)[1]].reset_index(drop=True)
    size = tables["part"].to_numpy(np.int64) * HASHES
    start = np.cumsum(size) - size
    first, part = np.repeat(start, size), np.repeat(tables["part"].to_numpy(np.int64), size)
    arrays = [np.zeros(size.sum(), np.int64) for _ in range(4)]
    at = start[table] + pdf["cell"].to_numpy(np.int64)
    for array, name in zip(arrays, ("n", "keys", "digests", "checks")):
        array[at] = pdf[name].to_numpy(np.int64)
    f, k, d, s = peel(first, part, *arrays)
    dirty = np.zeros(len(size), bool)
    dirty[np.searchsorted(start, np.flatnonzero(arrays[0] | arrays[1] | arrays[2] | arrays[3]), "right") - 1] = True
    owner = np.searchsorted(start, f, "right") - 1
    clean = ~dirty[owner]
    found = tables.iloc[owner[clean]].assign(kh=k[clean], vh=d[clean], sign=s[clean])
    return pd.concat([found, tables[dirty].assign(kh=0, vh=0, sign=0)])[["source", "at", "bucket", "part", "kh", "vh", "sign"]]


def diff_snapshots(rows: DataFrame, bucket_rows: int = BUCKET_ROWS, tries: int = TRIES) -> DataFrame:
    """source, at, record_key, change of each record that differs from the snapshot before; ``at`` is the later one."""
    rows = cut(rows)
    # the bucket count of a source follows its largest snapshot
    sizes = rows.groupBy("source", "at").count().groupBy("source").agg(F.max("count").alias("rows"))
    sizes = sizes.select("source", F.greatest(F.lit(1), F.ceil(F.col("rows") / bucket_rows)).cast("long").alias("buckets"))
    sided = rows.join(sizes, "source").withColumn("bucket", F.pmod(_mix(F.col("kh"), 0), F.col("buckets")))
    sides = F.array(F.struct(F.when(F.col("before").isNotNull(), F.col("at")).alias("pair"), F.lit(1).alias("sign")), F.struct(F.col("after").alias("pair"), F.lit(-1).alias("sign")))
    signed = sided.select("source", "bucket", "kh", "vh", F.explode(sides).alias("p")).select("source", F.col("p.pair").alias("at"), "bucket", "kh", "vh", F.col("p.sign").alias("sign")).where(F.col("at").isNotNull())
    signed = cut(signed)
    names = ["source", "at", "bucket"]

    guess = cut(_estimates(signed))
    sized = signed.join(_bounded(guess), names, "left").withColumn("part", F.coalesce("part", F.lit(PART)))
    recovered, failed = [], None
    for attempt in range(tries + 1):
        if failed is not None:
            sized = signed.join(_bounded(failed.select(*names, (F.col("part") * GROW).alias("part"))), names)
        cells = cut(_cells(sized))
        groups = max(1, -(-cells.count() // GROUP_CELLS))
        peeled = cut(cells.groupBy(F.pmod(F.xxhash64(*names), F.lit(groups)).alias("g")).applyInPandas(_peel_tables, PEELED))
        release(cells)
        recovered.append(peeled.where(F.col("sign") != 0).drop("part"))
        failed = peeled.where(F.col("sign") == 0)
        if failed.isEmpty():
            break
    else:
        # what no table of this size gives up is summed entry by entry
        rest = signed.join(_bounded(failed.select(*names)), names, "left_semi")
        recovered.append(rest.groupBy(*names, "kh", "vh").agg(F.sum("sign").alias("sign")).where(F.col("sign") != 0))

    entries = recovered[0]
    for more in recovered[1:]:
        entries = entries.unionByName(more)
    new, old = entries.where(F.col("sign") > 0), entries.where(F.col("sign") < 0)
    with_keys = lambda side, at: side.join(rows.select("source", F.col(at).alias("at"), "kh", "vh", "record_key"), ["source", "at", "kh", "vh"], "left")
    read = cut(with_keys(new, "at").unionByName(with_keys(old, "after")).select("source", "at", "record_key", F.signum("sign").cast("int").alias("side")))
    if not read.where(F.col("record_key").isNull()).isEmpty():
        raise RuntimeError("a recovered entry belongs to no row")
    change = F.when(F.min("side") > 0, "added").when(F.max("side") < 0, "removed").otherwise("changed")
    return read.groupBy("source", "at", "record_key").agg(change.alias("change"))
