"""Parent-child links to full hierarchies (nested sets over a graph with cycles and several parents).

Nodes with exactly one parent hang in trees below *heads*: nodes with no parent (roots) or with several (junctions).
Inside these trees

* subtree sizes are summed upward and sibling ranges are allocated downward by prefix sums of the siblings' sizes; both
  passes double their reach each round, so a chain of depth d takes log2(d) rounds instead of d;
* a node's range ``[lft, rgt]`` within its head's tree holds exactly its descendants there, and the number of ranges that a
  node lies in is its depth: one sweep over a tree's range ends gives all depths.

Trees are then entered from one another through the junctions' links. Where all links into a tree come from one other tree, it
hangs below that one at the longest way; such trees are joined, by doubling again, until each has several trees above it (a
ladder of diamonds, however long, ends as one tree). The rest are finished round by round, as soon as all trees above are. What
stays unprocessed is on a cycle or below one.

A cycle whose nodes all have one parent has no head. Where places are asked for these too, the least id of each such cycle
becomes a head and its link a way from tree to tree.

Nulls: a row with one side null still names a node. Repeated links count once. An empty table gives no rows.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeplane.operators.grouped import CHUNK_ROWS, hash_chunk, prefix_sums, time_chunks
from lakeplane.scratch import cut, release


def clean_links(df: DataFrame, parent: str, child: str) -> tuple[DataFrame, DataFrame]:
    """(distinct links parent, child; distinct nodes node) of rows with stray blanks and one-sided nulls."""
    blank = r"^\s+|\s+$"
    sides = df.select(F.regexp_replace(parent, blank, "").alias("parent"), F.regexp_replace(child, blank, "").alias("child"))
    links = sides.where(F.col("parent").isNotNull() & F.col("child").isNotNull()).distinct()
    nodes = sides.select(F.explode(F.array("parent", "child")).alias("node")).where(F.col("node").isNotNull()).distinct()
    return links, nodes


def _climb(state: DataFrame) -> tuple[DataFrame, int]:
    """Sizes upward, and each node's head. Returns the state and the number of nodes below no head."""
    active = -1
    while True:
        now = state.where(F.col("jump").isNotNull()).count()
        if now in (0, active):  # a round that places nobody leaves only cycles: of nodes at depth 2d some are at d..2d
            return state, now
        active = now
        climbing = state.where(F.col("jump").isNotNull())
        sums = climbing.groupBy(F.col("jump").alias("node")).agg(F.sum("size").alias("more"))
        there = state.select(F.col("node").alias("jump"), F.col("jump").alias("jump2"), F.col("head").alias("head2"))
        new = (
            state.join(sums, "node", "left").join(there, "jump", "left")
            .select(
                "node", "parent", "fan",
                F.col("jump2").alias("jump"),
                F.coalesce("head", "head2").alias("head"),
                (F.col("size") + F.coalesce("more", F.lit(0))).alias("size"),
            )
        )
        new = cut(new)
        release(state)
        state = new


def _descend(state: DataFrame, with_path: bool) -> DataFrame:
    """Ranges downward: ``lft`` is the sum of the steps on the way from the head."""
    while not state.where(F.col("jump").isNotNull()).isEmpty():
        there = state.select(F.col("node").alias("jump"), F.col("jump").alias("jump2"), F.col("lft").alias("lft2"), *([F.col("path").alias("path2")] if with_path else []))
        new = state.join(there, "jump", "left").select(
            "node", "head", "size", "fan", F.col("jump2").alias("jump"),
            (F.col("lft") + F.coalesce("lft2", F.lit(0))).alias("lft"),
            *([F.when(F.col("path2").isNull(), F.col("path")).otherwise(F.concat("path2", "path")).alias("path")] if with_path else []),
        )
        new = cut(new)
        release(state)
        state = new
    return state.drop("jump")


def _range_depths(state: DataFrame, chunk_rows: int) -> DataFrame:
    """Add each node's depth: the number of ranges that are open where its own begins."""
    ends = F.array(F.struct(F.col("lft").alias("at"), F.lit(1).alias("sign")), F.struct((F.col("lft") + F.col("size")).alias("at"), F.lit(-1).alias("sign")))
    kept = [c for c in state.columns if c not in ("head", "lft")]
    events = state.select("head", "lft", F.struct(*kept).alias("rest"), F.explode(ends).alias("e")).select("head", F.col("e.at").alias("at"), F.col("e.sign").alias("sign"), F.when(F.col("e.sign") > 0, F.col("rest")).alias("rest"), "lft")
    events, chunk = time_chunks(events, ["head"], "at", chunk_rows)
    # a range that ends before a place is closed there
    swept = prefix_sums(events, ["head"], ["at", "sign"], {"depth": "sign"}, chunk).where(F.col("sign") > 0)
    return swept.select("head", "lft", F.col("depth").cast("long").alias("depth"), "rest.*")


def _cycle_heads(parents: DataFrame) -> DataFrame:
    """node: the least id of each cycle. parents: node, parent; every node's way up ends on a cycle."""
    state = cut(parents.select("node", F.col("parent").alias("jump"), F.col("node").alias("least")))
    before = None
    while True:
        # doubled jumps end on cycles once their targets don't get fewer, and the least ids stop changing on them
        on_cycle = state.select(F.col("jump").alias("node")).distinct()
        now = tuple(state.join(on_cycle, "node", "left_semi").agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("node", "least"))).first())
        if now == before:
            out = cut(state.join(on_cycle, "node", "left_semi").select(F.col("least").alias("node")).distinct())
            release(state)
            return out
        before = now
        there = state.select(F.col("node").alias("jump"), F.col("jump").alias("jump2"), F.col("least").alias("least2"))
        new = cut(state.join(there, "jump").select("node", F.col("jump2").alias("jump"), F.least("least", "least2").alias("least")))
        release(state)
        state = new


def nested_sets(links: DataFrame, nodes: DataFrame, with_path: bool = False, chunk_rows: int = CHUNK_ROWS, break_cycles: bool = False) -> DataFrame:
    """node, head, depth, size, lft, fan [, path]: each node's place in the tree of its head.

    ``fan`` is the node's number of parents. ``head`` is null for nodes that no head reaches; ``path`` holds the ids from
    the head to the node. Ranges are ``[lft, lft + size - 1]``. With ``break_cycles`` every node has a head: of a cycle that
    none reaches, its least id.
    """
    above = links.groupBy(F.col("child").alias("node")).agg(F.count(F.lit(1)).alias("fan"), F.min("parent").alias("parent"))
    single = F.col("fan") == 1
    state = nodes.join(above, "node", "left").withColumn("fan", F.coalesce("fan", F.lit(0))).select(
        "node", F.when(single, F.col("parent")).alias("parent"), "fan", F.when(single, F.col("parent")).alias("jump"),
        F.when(~single, F.col("node")).alias("head"), F.lit(1).cast("long").alias("size"),
    )
    state, lost = _climb(cut(state))
    placed = state.where(F.col("head").isNotNull())
    below = placed.where(F.col("parent").isNotNull())
    widest = below.groupBy("parent").count().agg(F.max("count")).first()[0] or 0
    chunks = math.ceil(widest / chunk_rows)
    ranked = prefix_sums(below.withColumn("chunk", hash_chunk(["node"], chunks)), ["parent"], ["node"], {"before": "size"}, "chunk" if chunks > 1 else None)
    first = ranked.select("node", "head", "size", "fan", F.col("parent").alias("jump"), (F.col("before") + 1).alias("lft"))
    heads = placed.where(F.col("parent").isNull()).select("node", "head", "size", "fan", F.lit(None).cast("string").alias("jump"), F.lit(0).cast("long").alias("lft"))
    start = first.unionByName(heads)
    if with_path:
        start = start.withColumn("path", F.array("node"))
    out = _range_depths(_descend(cut(start), with_path), chunk_rows)
    if lost and break_cycles:
        parents = cut(state.where(F.col("head").isNull()).select("node", "parent"))
        kept = parents.join(_cycle_heads(parents), "node", "left_anti").select("parent", F.col("node").alias("child"))
        return out.unionByName(nested_sets(kept, parents.select("node"), with_path, chunk_rows).withColumn("fan", F.lit(1).cast("long")))
    if lost:
        rest = state.where(F.col("head").isNull()).select("node", "head", F.lit(None).cast("long").alias("depth"), F.lit(None).cast("long").alias("size"), "fan", F.lit(None).cast("long").alias("lft"))
        out = out.unionByName(rest, allowMissingColumns=True)
    return out


def _hang(links: DataFrame, with_path: bool) -> DataFrame | None:
    """head, top, down [, way]: the trees all of whose links come from one other tree, below the highest tree reached that way.

    ``links`` has head, source, down, each source of a head once. Doubling; trees in a circle of such links are left out. None if there
    is no such tree.
    """
    way = ["way"] if with_path else []
    lone = links.groupBy("head").agg(F.count(F.lit(1)).alias("n"), *[F.max(c).alias(c) for c in ("source", "down", *way)]).where(F.col("n") == 1)
    state = cut(lone.select("head", F.col("source").alias("top"), (F.col("down") + 1).alias("down"), *way, F.lit(False).alias("over")))
    active = -1
    while True:
        now = state.where(~F.col("over")).count()
        if now in (0, active):
            break
        active = now
        above = state.select(F.col("head").alias("top"), F.col("top").alias("top2"), F.col("down").alias("down2"), *([F.col("way").alias("way2")] if with_path else []), F.col("over").alias("over2"))
        higher = F.col("down2").isNotNull() & ~F.col("over")
        new = cut(state.join(above, "top", "left").select(
            "head", F.when(higher, F.col("top2")).otherwise(F.col("top")).alias("top"), F.when(higher, F.col("down") + F.col("down2")).otherwise(F.col("down")).alias("down"),
            *([F.when(higher, F.concat("way2", "way")).otherwise(F.col("way")).alias("way")] if with_path else []), (F.col("over") | F.coalesce("over2", F.lit(True))).alias("over"),
        ))
        release(state)
        state = new
    return None if state.where("over").isEmpty() else state.where("over").drop("over")


def enter_trees(links: DataFrame, places: DataFrame, with_path: bool = False) -> DataFrame:
    """head, root, depth [, path]: the roots from which each head is reached, by the longest way.

    Heads that wait for ever (a cycle is above them) are missing.
    """
    way = ["way"] if with_path else []
    junctions = places.where(F.col("fan") > 1).select(F.col("node").alias("child"))
    at = places.select(F.col("node").alias("parent"), F.col("head").alias("source"), F.col("depth").alias("down"), *([F.col("path").alias("way")] if with_path else []))
    entries = links.join(junctions, "child", "left_semi").join(at, "parent", "left").select(F.col("child").alias("head"), "source", "down", *way)

    def longest(ways: DataFrame) -> DataFrame:
        """Of several links from one tree the one by the longest way; a link from no tree (a cycle is above) stays."""
        best = ways.groupBy("head", "source").agg(F.max(F.struct("down", *way)).alias("w"))
        return cut(best.select("head", "source", "w.*"))

    waiting = longest(entries)
    hung = []
    while (below := _hang(waiting, with_path)) is not None:
        hung.append(below)
        top = below.select(F.col("head").alias("source"), "top", F.col("down").alias("more"), *([F.col("way").alias("before")] if with_path else []))
        rest = waiting.join(below.select("head"), "head", "left_anti").join(top, "source", "left")
        moved = F.col("top").isNotNull()
        rest = rest.select("head", F.coalesce("top", "source").alias("source"), (F.col("down") + F.coalesce("more", F.lit(0))).alias("down"), *([F.when(moved, F.concat("before", "way")).otherwise(F.col("way")).alias("way")] if with_path else []))
        old, waiting = waiting, longest(rest)
        release(old)

    roots = places.where(F.col("fan") == 0)
    fresh = cut(roots.select("head", F.col("head").alias("root"), F.lit(0).cast("long").alias("depth"), *([F.array().cast("array<string>").alias("path")] if with_path else [])))
    known, partial = fresh, None
    path = ["path"] if with_path else []
    while not waiting.isEmpty():
        # links whose source has just been finished turn into ways; a head with no other link left is finished
        ways = waiting.join(fresh.select(F.col("head").alias("source"), "root", "depth", *([F.col("path").alias("above")] if with_path else [])), "source")
        ways = ways.select("head", "root", (F.col("depth") + F.col("down") + 1).alias("depth"), *([F.concat("above", "way").alias("path")] if with_path else []))
        found = ways if partial is None else partial.unionByName(ways)
        found = found.groupBy("head", "root").agg(F.max(F.struct("depth", *path)).alias("w")).select("head", "root", "w.*")
        left = cut(waiting.join(fresh.select(F.col("head").alias("source")).distinct(), "source", "left_anti"))
        open_heads = left.select("head").distinct().withColumn("open", F.lit(True))
        marked = cut(found.join(open_heads, "head", "left"))
        fresh = marked.where(F.col("open").isNull()).drop("open")
        release(waiting)
        waiting, partial = left, marked.where(F.col("open").isNotNull()).drop("open")
        if fresh.isEmpty():
            break
        known = known.unionByName(fresh)
    for below in reversed(hung):
        tops = known.select(F.col("head").alias("top"), "root", "depth", *path)
        placed = below.join(tops, "top").select("head", "root", (F.col("depth") + F.col("down")).alias("depth"), *([F.concat("path", "way").alias("path")] if with_path else []))
        known = cut(known.unionByName(placed))
    return known


def hierarchy(links: DataFrame, nodes: DataFrame, with_path: bool = False, place_cycles: bool = False) -> DataFrame:
    """node, root, depth, head, lft, rgt [, path]: one row per node and root that it is reached from.

    ``depth`` counts the links of the longest way from the root, and ``path`` holds that way's ids. Nodes on a cycle or
    below one have one row with root '' and depth -1, and with a place only where ``place_cycles`` asks for it.
    """
    links = cut(links)
    places = cut(nested_sets(links, nodes, with_path, break_cycles=place_cycles))
    tops = enter_trees(links, places, with_path)
    tops = tops.select("head", "root", F.col("depth").alias("top"), *([F.col("path").alias("above")] if with_path else []))
    free = F.col("root").isNotNull()
    placed = free | F.lit(place_cycles)
    return places.join(tops, "head", "left").select(
        "node", F.coalesce("root", F.lit("")).alias("root"),
        F.when(free, F.col("top") + F.col("depth")).otherwise(F.lit(-1)).cast("long").alias("depth"),
        F.when(placed, F.col("head")).alias("head"), F.when(placed, F.col("lft")).alias("lft"), F.when(placed, F.col("lft") + F.col("size") - 1).alias("rgt"),
        *([F.when(free, F.concat("above", "path")).alias("path")] if with_path else []),
    )


def descendants(links: DataFrame, nodes: DataFrame) -> DataFrame:
    """node, head, lft, rgt: the ranges that together hold all of a node's descendants and the node itself.

    A node with place (head, lft) as given by ``hierarchy`` with ``place_cycles`` is a descendant if its head and lft fall
    into one of the ranges. They are the node's own and whole trees entered from below it; where its own tree is entered
    again, on a cycle, the whole tree takes the place of its own range. Ranges name descendants without listing every pair.
    """
    links = cut(links)
    places = cut(nested_sets(links, nodes, True, break_cycles=True))
    own = places.select("node", "head", "lft", (F.col("lft") + F.col("size") - 1).alias("rgt"))
    heads = places.where((F.col("node") == F.col("head")) & (F.col("fan") > 0)).select(F.col("node").alias("child"), F.col("size").alias("all"))
    ports = links.join(heads, "child").select("parent", "child", "all")
    # every node on the tree path above a port reaches the tree behind it
    reach = cut(places.select(F.col("node").alias("parent"), "path").join(ports, "parent").select(F.explode("path").alias("node"), F.col("child").alias("tree"), "all").distinct())
    known, fresh = reach, reach
    while True:
        through = fresh.select("node", F.col("tree").alias("via")).join(reach.withColumnRenamed("node", "via"), "via").select("node", "tree", "all").distinct()
        new = cut(through.join(known.select("node", "tree"), ["node", "tree"], "left_anti"))
        if new.isEmpty():
            break
        known, fresh = cut(known.unionByName(new)), new
    own = own.join(known.select("node", F.col("tree").alias("head")), ["node", "head"], "left_anti")
    return own.unionByName(known.select("node", F.col("tree").alias("head"), F.lit(0).cast("long").alias("lft"), (F.col("all") - 1).alias("rgt")))
