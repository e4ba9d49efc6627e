"""Mixing sources to target weights: raking, then calibrated systematic sampling.

Documents are counted in tokens per cell (source, language, topic). Iterative proportional fitting rakes the cells' token
weights to the wanted source shares and to the languages' and topics' natural shares; the sources come last in each
round and are met exactly. No cell gets more than its tokens times the most copies of its source. A cell's weight over
its tokens is the expected number of copies of each of its documents; documents are drawn by systematic sampling along
their sizes, so that each has its calibrated probability and a cell's tokens come out close to its weight.

The total is the largest one at which sources that together have ``met`` of the target can reach their share; a source
that is smaller gives all it may. With ``met`` 1 every source that is there reaches its share exactly, however small that makes
the total. Sources that are absent give nothing. Only cells reach the driver: a row for each combination of source, language and
topic that occurs. More than ``MAX_CELLS`` of them, which is no classification any more, are refused.

Null sources and sources without target aren't used; null languages and topics are values of their own; documents
without tokens are left out. A null or negative target or cap counts as 0.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakeplane.operators.grouped import hash_chunk, prefix_sums
from lakeplane.scratch import cut

MAX_CELLS = 1_000_000
#: Cells beyond this number are joined by shuffle.
BROADCAST_CELLS = 50_000
#: Raking ends when no weight moves by more than this share, or after so many rounds.
SETTLED, ROUNDS = 1e-9, 1000
PHASES = 16


@dataclass
class Cells:
    """Arrays over cells: index of source, language and topic, tokens, and the most copies."""

    source: np.ndarray
    lang: np.ndarray
    topic: np.ndarray
    tokens: np.ndarray
    cap: np.ndarray


def feasible_total(shares: np.ndarray, limits: np.ndarray, met: float) -> float:
    """Largest total at which sources holding ``met`` of the shares of all sources that are there are within their limits."""
    shares = np.where(limits > 0, shares, 0.0)
    order = np.argsort(np.divide(limits, shares, out=np.full(len(shares), np.inf), where=shares > 0))
    lost = 0.0
    for i in order:
        if shares[i] <= 0:
            continue
        lost += shares[i]
        if lost > (1 - met) * shares.sum() + 1e-12:
            return float(limits[i] / shares[i])
    return float((limits[shares > 0] / shares[shares > 0]).max(initial=0.0))


def _fit(x: np.ndarray, groups: np.ndarray, targets: np.ndarray, limit: np.ndarray | None = None, rounds: int = 1) -> np.ndarray:
    """Scale each group to its target; with a limit, what one cell can't take goes to the others of its group."""
    for _ in range(rounds):
        sums = np.bincount(groups, x, len(targets))
        factor = np.divide(targets, sums, out=np.zeros_like(sums), where=sums > 0)
        if limit is None:
            return x * factor[groups]
        full = x >= limit * (1 - 1e-12)
        taken = np.bincount(groups[full], limit[full], len(targets))
        free = np.bincount(groups[~full], x[~full], len(targets))
        grow = np.divide(np.maximum(targets - taken, 0), free, out=np.zeros_like(free), where=free > 0)
        over = sums > targets
        x = np.where(over[groups], x * factor[groups], np.where(full, limit, np.minimum(x * grow[groups], limit)))
    return x


def rake(cells: Cells, wanted: np.ndarray, total: float, rounds: int = ROUNDS) -> np.ndarray:
    """Token weights of the cells: sources at min(wanted * total, limit), languages and topics near their natural shares."""
    limit = cells.tokens * cells.cap
    limits = np.bincount(cells.source, limit, len(wanted))
    by_source = np.minimum(wanted * total, limits)
    natural = lambda g: np.bincount(g, cells.tokens) / max(cells.tokens.sum(), 1) * by_source.sum()
    langs, topics = natural(cells.lang), natural(cells.topic)
    x = cells.tokens.astype(float)
    for _ in range(rounds):
        before = x
        x = _fit(x, cells.lang, langs)
        x = _fit(x, cells.topic, topics)
        x = _fit(np.minimum(x, limit), cells.source, by_source, limit, rounds=30)
        if np.all(np.abs(x - before) <= SETTLED * np.maximum(before, 1.0)):
            break
    return x


def mix(sizes: DataFrame, targets: DataFrame, met: float = 0.95, total: float | None = None, chunk_rows: int = 200_000) -> DataFrame:
    """doc_id, source, n_tokens, copies of every chosen document.

    ``sizes`` has doc_id, source, lang, topic, n_tokens; ``targets`` is the configured list of source, target_share and
    max_repeats. ``total`` sets the number of tokens instead of the feasible one.
    """
    goals = [(r["source"], max(r["share"] or 0.0, 0.0), max(r["cap"] or 0, 0)) for r in targets.where(F.col("source").isNotNull()).groupBy("source").agg(F.max("target_share").alias("share"), F.max("max_repeats").alias("cap")).orderBy("source").collect()]
    names = [g[0] for g in goals]
    used = cut(sizes.where(F.col("source").isin(names) & (F.col("n_tokens") > 0)).select("doc_id", "source", "lang", "topic", "n_tokens"))
    named = used.select("doc_id", "source", *[F.coalesce(F.concat(F.lit("="), c), F.lit("(none)")).alias(c) for c in ("lang", "topic")], "n_tokens")
    cells_df = cut(named.groupBy("source", "lang", "topic").agg(F.sum("n_tokens").alias("tokens"), F.count(F.lit(1)).alias("docs")))
    if (n_cells := cells_df.count()) > MAX_CELLS:
        raise ValueError(f"{n_cells} combinations of source, language and topic: more than {MAX_CELLS} can't be raked as one table of marginals")
    few = F.broadcast if n_cells <= BROADCAST_CELLS else (lambda df: df)
    rows = sorted(cells_df.collect(), key=lambda r: (r["source"], r["lang"], r["topic"]))
    empty = "doc_id long, source string, n_tokens long, copies int"
    if not rows:
        return sizes.sparkSession.createDataFrame([], empty)
    index = lambda values: np.unique(values, return_inverse=True)[1]
    source = np.array([names.index(r["source"]) for r in rows])
    caps, shares = np.array([float(g[2]) for g in goals]), np.array([g[1] for g in goals])
    cells = Cells(source, index([r["lang"] for r in rows]), index([r["topic"] for r in rows]), np.array([float(r["tokens"]) for r in rows]), caps[source])
    limits = np.bincount(source, cells.tokens * cells.cap, len(goals))
    weights = rake(cells, shares, feasible_total(shares, limits, met) if total is None else total)
    expected = np.minimum(weights / cells.tokens, cells.cap)

    plan = named.sparkSession.createDataFrame([(r["source"], r["lang"], r["topic"], float(e)) for r, e in zip(rows, expected)], "source string, lang string, topic string, expected double")
    # a document's rank in its cell runs along the sizes, in chunks of size class and hash
    chunks = -(-max(r["docs"] for r in rows) // chunk_rows)
    size_class = F.floor(F.log2(F.col("n_tokens").cast("double")) * 8).cast("long")
    ordered = named.join(few(plan), ["source", "lang", "topic"]).withColumn("chunk", size_class * chunks + hash_chunk(["doc_id"], chunks)).withColumn("one", F.lit(1))
    ranked = cut(prefix_sums(ordered, ["source", "lang", "topic"], ["n_tokens", "doc_id"], {"rank": "one"}, "chunk"))

    def copies(phase: Column) -> Column:
        e = F.col("expected")
        return (F.floor(e * (F.col("rank") + 1) + phase) - F.floor(e * F.col("rank") + phase)).cast("int")

    # of some phases each cell takes the one that brings its source's running total closest to what is wanted
    drawn = ranked.groupBy("source", "lang", "topic").agg(*[F.sum(copies(F.lit(k / PHASES)) * F.col("n_tokens")).alias(f"t{k}") for k in range(PHASES)])
    by_cell = {(r["source"], r["lang"], r["topic"]): [r[f"t{k}"] for k in range(PHASES)] for r in drawn.collect()}
    owed, phases = dict.fromkeys(names, 0.0), []
    for i in sorted(range(len(rows)), key=lambda i: (-weights[i], i)):  # small cells last: they settle what large ones left
        r = rows[i]
        key = (r["source"], r["lang"], r["topic"])
        owed[key[0]] += weights[i]
        k = min(range(PHASES), key=lambda k: (abs(owed[key[0]] - by_cell[key][k]), k))
        owed[key[0]] -= by_cell[key][k]
        phases.append((*key, k / PHASES))
    phase = named.sparkSession.createDataFrame(phases, "source string, lang string, topic string, phase double")
    return ranked.join(few(phase), ["source", "lang", "topic"]).select("doc_id", "source", "n_tokens", copies(F.col("phase")).alias("copies")).where(F.col("copies") > 0)


def share_report(mixed: DataFrame, targets: DataFrame) -> DataFrame:
    """source, target_share, max_repeats, n_docs, n_tokens, actual_share, most_copies of every target.

    With ``met`` below 1 small sources miss their share, and all others have more than theirs by what is missing.
    """
    sums = mixed.groupBy("source").agg(F.count(F.lit(1)).alias("n_docs"), F.sum(F.col("n_tokens") * F.col("copies")).alias("n_tokens"), F.max("copies").alias("most_copies"))
    sums = sums.withColumn("total", F.sum("n_tokens").over(Window.partitionBy()))  # a row per configured source
    zero = F.lit(0)
    out = targets.join(sums, "source", "left")
    return out.select("source", "target_share", "max_repeats", F.coalesce("n_docs", zero).alias("n_docs"), F.coalesce("n_tokens", zero).alias("n_tokens"), F.round(F.coalesce(F.col("n_tokens") / F.col("total"), F.lit(0.0)), 5).alias("actual_share"), F.coalesce("most_copies", zero).alias("most_copies"))
