"""Filling containers of fixed capacity: bounded-space online packing.

Each partition streams its items past a fixed number of open windows per capacity. An item goes into the window that it
fills best; if it fits none, the fullest window is emitted and a new one opened. Memory depends on the number of
windows, not on the data. Windows left open at the end of a partition are merged as wholes in rounds, each task taking
the leftovers of at most ``FAN_IN`` partitions.

An item longer than the capacity is split into full containers and a rest, which is packed like any item; no other item
is split. Empty items take the room of one token, so that no container holds an unbounded number of them. Items with a
null size count as empty.
"""

from __future__ import annotations

import bisect
from collections.abc import Iterable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lakeplane.scratch import cut

WINDOWS = 64
FAN_IN = 32
#: Items that one partition packs.
PARTITION_ITEMS = 25_000


class Windows:
    """Open windows of one capacity. ``put`` and ``rest`` return closed windows, as lists of what was put in."""

    def __init__(self, capacity: int, most: int = WINDOWS):
        self.capacity, self.most = capacity, most
        self.free: list[tuple[int, int]] = []  # (room, number), sorted
        self.held: dict[int, list] = {}
        self.opened = 0

    def put(self, size: int, what: object) -> list[tuple[int, list]]:
        closed = []
        i = bisect.bisect_left(self.free, (size, -1))
        if i < len(self.free):
            room, number = self.free.pop(i)
        else:
            if len(self.free) >= self.most:
                room, number = self.free.pop(0)  # the fullest
                closed.append((self.capacity - room, self.held.pop(number)))
            self.opened += 1
            room, number = self.capacity, self.opened
            self.held[number] = []
        self.held[number].append(what)
        if room == size and size:
            closed.append((self.capacity, self.held.pop(number)))
        else:
            bisect.insort(self.free, (room - size, number))
        return closed

    def rest(self) -> list[tuple[int, list]]:
        out = [(self.capacity - room, self.held[number]) for room, number in self.free]
        self.free, self.held = [], {}
        return out


def pieces(size: int, capacity: int) -> Iterable[int]:
    """Sizes of an item's pieces; one unless it exceeds the capacity."""
    while size > capacity:
        yield capacity
        size -= capacity
    yield size


ITEMS = "pack_id string, window string, place int, doc_id long, piece int, n_tokens long, filled long, left boolean"


def _room(size: int) -> int:
    return max(1, size)


def _pack_items(capacities: list[tuple[str, int]], most: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        packs = {name: Windows(capacity, most) for name, capacity in capacities}
        count = dict.fromkeys(packs, 0)

        def rows(name: str, closed: list[tuple[int, list]], left: bool) -> Iterator[tuple]:
            for filled, items in closed:
                count[name] += 1
                for place, (doc_id, piece, size) in enumerate(items):
                    yield name, f"0-{part}-{count[name]}", place, doc_id, piece, size, filled, left

        columns = [c.split()[0] for c in ITEMS.split(", ")]
        for pdf in batches:
            out = []
            for doc_id, size in zip(pdf["doc_id"], pdf["n_tokens"]):
                for name, windows in packs.items():
                    for piece, n in enumerate(pieces(int(size), windows.capacity)):
                        out.extend(rows(name, windows.put(_room(n), (doc_id, piece, n)), False))
            yield pd.DataFrame(out, columns=columns)
        yield pd.DataFrame([x for name, windows in packs.items() for x in rows(name, windows.rest(), True)], columns=columns)

    return run


MERGED = "pack_id string, unit string, into string, filled long, left boolean"


def _merge_units(capacities: list[tuple[str, int]], most: int, level: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        packs = {name: Windows(capacity, most) for name, capacity in capacities}
        count = dict.fromkeys(packs, 0)

        def rows(name: str, closed: list[tuple[int, list]], left: bool) -> Iterator[tuple]:
            for filled, units in closed:
                count[name] += 1
                for unit in units:
                    yield name, unit, f"{level}-{part}-{count[name]}", filled, left

        columns = [c.split()[0] for c in MERGED.split(", ")]
        for pdf in batches:
            out = []
            for name, unit, filled in zip(pdf["pack_id"], pdf["unit"], pdf["filled"]):
                out.extend(rows(name, packs[name].put(int(filled), unit), False))
            yield pd.DataFrame(out, columns=columns)
        yield pd.DataFrame([x for name, windows in packs.items() for x in rows(name, windows.rest(), True)], columns=columns)

    return run


def pack(sizes: DataFrame, capacities: list[tuple[str, int]], most: int = WINDOWS, partition_items: int = PARTITION_ITEMS, fan_in: int = FAN_IN) -> DataFrame:
    """pack_id, container_id, place, doc_id, piece, n_tokens of every item (doc_id, n_tokens) for every capacity.

    ``capacities`` is a short configured list of (pack_id, capacity). Items are dealt to partitions by a hash of their id
    and stream in its order, so equal input gives equal containers.
    """
    sizes = sizes.select("doc_id", F.coalesce("n_tokens", F.lit(0)).cast("long").alias("n_tokens"))
    parts = max(1, -(-sizes.count() // partition_items))
    dealt = sizes.withColumn("h", F.xxhash64("doc_id", "n_tokens")).repartition(parts, "h").sortWithinPartitions("h", "doc_id").select("doc_id", "n_tokens")
    items = cut(dealt.mapInPandas(_pack_items(capacities, most), ITEMS))

    units = items.where("left").groupBy("pack_id", F.col("window").alias("unit")).agg(F.max("filled").alias("filled"))
    owner = units.select("pack_id", F.col("unit").alias("window"), F.col("unit").alias("container"))
    level = 0
    while True:
        level, parts = level + 1, -(-parts // fan_in)
        # a task gets the leftovers of about fan_in partitions, each a fixed number of windows; large ones first
        dealt = units.withColumn("h", F.xxhash64("pack_id", "unit")).repartition(parts, "h").sortWithinPartitions(F.desc("filled"), "h").select("pack_id", "unit", "filled")
        merged = cut(dealt.mapInPandas(_merge_units(capacities, most * fan_in, level), MERGED))
        owner = cut(owner.join(merged.select("pack_id", F.col("unit").alias("container"), "into"), ["pack_id", "container"], "left").select("pack_id", "window", F.coalesce("into", "container").alias("container")))
        if parts == 1:
            break
        units = merged.where("left").groupBy("pack_id", F.col("into").alias("unit")).agg(F.max("filled").alias("filled"))
    placed = items.join(owner, ["pack_id", "window"], "left").select("pack_id", F.coalesce("container", "window").alias("container_id"), "window", "place", "doc_id", "piece", "n_tokens")
    # a container holds at most as many items as its capacity, so this window is over a bounded group
    order = Window.partitionBy("pack_id", "container_id").orderBy("window", "place")
    return placed.select("pack_id", "container_id", (F.row_number().over(order) - 1).alias("place"), "doc_id", "piece", "n_tokens")


def fill_report(packed: DataFrame, capacities: DataFrame) -> DataFrame:
    """pack_id, capacity_tokens, n_containers, n_items, n_tokens, fill: how well each capacity's containers are filled."""
    totals = packed.groupBy("pack_id", "container_id").agg(F.count(F.lit(1)).alias("items"), F.sum("n_tokens").alias("tokens")).groupBy("pack_id").agg(F.count(F.lit(1)).alias("n_containers"), F.sum("items").alias("n_items"), F.sum("tokens").alias("n_tokens"))
    return totals.join(capacities.select("pack_id", "capacity_tokens"), "pack_id").withColumn("fill", F.round(F.col("n_tokens") / (F.col("n_containers") * F.col("capacity_tokens")), 4))
