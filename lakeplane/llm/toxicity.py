"""Abusive, hateful or sexual content: a linear classifier over character n-grams, scaled by log-count ratios.

A document is scored passage by passage, whole. Passages are its sentences and lines and, of those with more than ``WORDS`` words,
all overlapping windows of ``WORDS`` words too, so that a remark isn't drowned by what surrounds it. The document's score is
that of its worst passage. Features are the hashed character n-grams of a passage, each scaled by its naive Bayes log-count
ratio between the classes; a logistic model is fitted on the scaled features with an L2 penalty. Training and scoring cut
passages alike and hold all of them to one threshold.

Training passages are templates in four languages (``seed_text``) and the passages of labelled documents. Labels belong to
documents and some are wrong, so they are taken up in rounds: passages of harmless documents are harmless unless the model is
sure of the contrary; of an abusive document only passages are abusive that a model which has seen the harmless documents holds for
it, and as the mark speaks for them, ``TAKE`` is less than the threshold. At most ``MAX_DOCS`` labelled documents and
``MAX_PASSAGES`` of their distinct passages train the model; every document is scored.

Words are looked for behind stars (``c****n``) and a sign (``mo_ron``) in the list of vulgar words; what isn't there stays as written.

As the model is linear, a window's score is a difference of running sums over its text, and no window is ever written out.
The model is one array of fixed size and is sent with the tasks. Null and empty texts, and passages without a letter or digit,
score 0. Documents with labels that contradict each other are left out of training; null labels say nothing.
"""

from __future__ import annotations

import hashlib
import re
import sys
import unicodedata
from collections import Counter
from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeplane import scratch
from lakeplane.llm import seed_text

BITS = 18
ORDERS = (2, 3, 4, 5)
MAX_DOCS = 3000
MAX_PASSAGES = 30_000
ROUNDS = 2
#: A harmless document's passage above this is taken for a wrong label, an abusive one's above ``TAKE`` as abusive.
DOUBT, TAKE = 0.8, 0.3
PENALTY, STEPS = 0.05, 40
#: Weight of the harmless templates against the abusive ones: what nothing is known of is harmless.
HARMLESS_WEIGHT = 4.0
#: Weight of an abusive passage found in labelled documents; a template's is about 1.
FOUND_WEIGHT = 4.0
THRESHOLD = 0.42
#: Labelled harmless passages weigh as much as all templates together, but none more than this many templates.
MOST_WEIGHT = 3.0
#: Words of a window, and how far the next one starts.
WORDS, STRIDE = 8, 4
#: Characters that are scored at once.
BATCH_CHARS = 1 << 20

# patterns start with what is rare, or take words without going back, as they run over every text
_SPLIT = re.compile(r"\s(?:(?<=[.!?…;]\s)\s*|(?<=[\r\n])[\r\n]*)")
_SPEAKER = re.compile(r"^[^\S\n]*(?:[-*#>•]+[^\S\n]*)?(?:user ?\d+:[^\S\n]*)?", re.M)
_HYPHENS = re.compile(r"(?<![^\W_])([^\W\d_])(?:[-.*_ ]([^\W\d_])){2,}(?![^\W_])")
_LEET = re.compile(r"[013457@$!](?=[a-zà-ÿ])(?:(?<=[a-zà-ÿ].)|(?<=[@$])(?<!\w.))")
_MASKED = re.compile(r"(?<!\w)[^\W\d_]++\*+(?:[^\W\d_]|\*)*")
_BROKEN = re.compile(r"(?<!\w)[^\W\d_]++[-._*][^\W\d_]++(?!\w)")
_LEET_TO = dict(zip("013457@$!", "oieastasi"))
_LETTER = re.compile(r"[^\W\d_]")
_OTHER = re.compile(r"[^\w'\n]+")
_DIGITS = re.compile(r"\b[^\W\d]*+\d\w*")
_VULGAR = dict.fromkeys(seed_text.vulgar())
#: Characters without a shape, such as zero-width joiners and soft hyphens.
_SHAPELESS = frozenset(c for c in map(chr, range(sys.maxunicode + 1)) if unicodedata.category(c) == "Cf")


def sentences(text: str) -> list[str]:
    return [p for p in _SPLIT.split(text) if p and not p.isspace()]


@lru_cache(10_000)
def _unmask(word: str) -> str:
    """A word with stars for letters, if a vulgar word fits; else as it is."""
    fits = re.compile(word.replace("*", r"\w")).fullmatch
    return next(filter(fits, _VULGAR), word)


def _mend(word: str) -> str:
    """A word broken by one sign, joined if it is a vulgar word."""
    joined = re.sub(r"[-._*]", "", word)
    return joined if joined in _VULGAR else word


def _codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le"), dtype=np.uint32)


def _once(text: str) -> str:
    """The text with each run of one letter as that letter."""
    codes = _codes(text)
    again = np.flatnonzero(codes[1:] == codes[:-1]) + 1
    letters = [c for c in np.unique(codes[again]) if _LETTER.match(chr(c))]
    return np.delete(codes, again[np.isin(codes[again], letters)]).tobytes().decode("utf-32-le")


def normalise_lines(lines: Sequence[str]) -> str:
    """The lines in lower case, without invisible characters, spelling games, digits and punctuation, with a blank around each.

    Lines are joined by line feeds and are treated at once; they mustn't hold any.
    """
    t = unicodedata.normalize("NFKC", "\n".join(lines)).casefold()
    for c in () if t.isascii() else _SHAPELESS.intersection(map(chr, np.unique(_codes(t)))):
        t = t.replace(c, "")
    t = _SPEAKER.sub("", t)
    t = _HYPHENS.sub(lambda m: re.sub(r"[-.*_ ]", "", m[0]), t)
    t = _LEET.sub(lambda m: _LEET_TO[m[0]], t)
    if "*" in t:
        t = "\n".join([_MASKED.sub(lambda m: _unmask(m[0]), x) if "*" in x else x for x in t.split("\n")])
    t = _BROKEN.sub(lambda m: _mend(m[0]), t)
    t = _OTHER.sub(" ", _DIGITS.sub("0", _once(t)).replace("_", " ")).strip(" ")
    return " " + t.replace(" \n", "\n").replace("\n ", "\n").replace("\n", " \n ") + " "


def normalise(passage: str) -> str:
    return normalise_lines([passage])


def _windows(blanks: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(line, start, end) of all passages of normalised lines: whole lines and their windows.

    ``blanks`` are the places of all blanks that stand before or after a word, ``first`` the index of each line's first one,
    with a last entry for the end. A window runs from the blank before its first word to the one after its last.
    """
    words = np.maximum(np.diff(first) - 1, 0)
    line = np.flatnonzero(words > 0)
    start, end = blanks[first[line]], blanks[first[line] + words[line]]
    long = np.flatnonzero(words > WORDS)
    per = -(-(words[long] - WORDS) // STRIDE) + 1
    owner = np.repeat(long, per)
    nth = np.arange(len(owner)) - np.repeat(np.cumsum(per) - per, per)
    begin = np.minimum(nth * STRIDE, words[owner] - WORDS) + first[owner]
    return np.concatenate([line, owner]), np.concatenate([start, blanks[begin]]), np.concatenate([end, blanks[begin + WORDS]])


def spans(text: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(line, start, end) of all passages of lines as ``normalise_lines`` gives them."""
    codes = _codes(text)
    blank, breaks = codes == 32, codes == 10
    # of a line without words, two blanks in a row, none counts
    alone = np.zeros(len(codes), bool)
    pair = blank[:-1] & blank[1:]
    alone[:-1] |= pair
    alone[1:] |= pair
    blanks = np.flatnonzero(blank & ~alone)
    lines = np.cumsum(breaks)[blanks]
    return _windows(blanks, np.searchsorted(lines, np.arange(int(breaks.sum()) + 2)))


def passages(text: str) -> list[str]:
    """A text's passages, normalised."""
    lines = sentences(text)
    if not lines:
        return []
    t = normalise_lines(lines)
    return [t[a : b + 1] for _, a, b in zip(*spans(t))]


def _hashes(codes: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """(order, feature of the n-gram that starts at each place)."""
    h = codes.astype(np.uint64)
    for n in range(2, max(ORDERS) + 1):
        h = h[:-1] * np.uint64(0x9E3779B97F4A7C15) + codes[n - 1 :]
        if n in ORDERS:
            mixed = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9 + 2 * n)
            yield n, (mixed >> np.uint64(64 - BITS)).astype(np.int32)


def grams(lines: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
    """(line index, feature) of every character n-gram of the lines; no n-gram crosses a line."""
    codes = np.frombuffer(("\n".join(lines) + "\n").encode("utf-32-le"), dtype=np.uint32).astype(np.uint64)
    breaks = np.cumsum(codes == 10)
    rows, features = [], []
    for n, f in _hashes(codes):
        keep = breaks[n - 1 :] == (breaks[: len(f)] - (codes[: len(f)] == 10))
        rows.append(breaks[: len(f)][keep].astype(np.int32))
        features.append(f[keep])
    return np.concatenate(rows), np.concatenate(features)


@dataclass
class Model:
    """Weights of the n-grams (scaled by their log-count ratios) and the bias."""

    weights: np.ndarray
    bias: float

    def spans(self, text: str, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Probability of each passage of a normalised text, from running sums of the weights over all places."""
        codes = np.frombuffer(text.encode("utf-32-le"), dtype=np.uint32).astype(np.uint64)
        size = end - start + 1
        sums, counts = np.zeros(len(start)), np.zeros(len(start))
        for n, f in _hashes(codes):
            running = np.concatenate([[0.0], np.cumsum(self.weights[f], dtype=np.float64)])
            have = np.maximum(size - n + 1, 0)
            sums += running[np.minimum(start + have, len(f))] - running[np.minimum(start, len(f))]
            counts += have
        return 1 / (1 + np.exp(-(sums / np.sqrt(np.maximum(counts, 1)) + self.bias)))

    def scores(self, lines: Sequence[str]) -> np.ndarray:
        """Probability of each normalised passage."""
        ends = np.cumsum([len(x) + 1 for x in lines], dtype=np.int64)
        return self.spans("\n".join(lines) + "\n", ends - np.array([len(x) + 1 for x in lines], dtype=np.int64), ends - 2) if len(lines) else np.zeros(0)

    def documents(self, texts: Sequence[str | None]) -> np.ndarray:
        """Score of each document."""
        out = np.zeros(len(texts))
        lines: list[str] = []
        owner: list[int] = []
        size = 0

        def settle() -> None:
            text = normalise_lines(lines)
            line, start, end = spans(text)
            if len(line):
                np.maximum.at(out, np.array(owner)[line], self.spans(text, start, end))

        for i, text in enumerate(texts):
            for p in sentences(text or ""):
                lines.append(p)
                owner.append(i)
                size += len(p)
            if size > BATCH_CHARS:
                settle()
                lines, owner, size = [], [], 0
        if lines:
            settle()
        return out


def _minimise(objective, size: int, steps: int, memory: int = 8) -> np.ndarray:
    """Minimum of a convex function (value, gradient) by limited-memory quasi-Newton steps with backtracking."""
    x = np.zeros(size)
    value, grad = objective(x)
    moves: list[tuple[np.ndarray, np.ndarray, float]] = []
    for _ in range(steps):
        q, used = grad.copy(), []
        for dx, dg, r in reversed(moves):
            a = r * dx.dot(q)
            used.append(a)
            q -= a * dg
        if moves:
            dx, dg, _ = moves[-1]
            q *= dx.dot(dg) / dg.dot(dg)
        else:
            q /= max(1.0, float(np.linalg.norm(q)))
        for (dx, dg, r), a in zip(moves, reversed(used)):
            q += (a - r * dg.dot(q)) * dx
        slope, step = -float(grad.dot(q)), 1.0
        while True:
            new, (new_value, new_grad) = x - step * q, objective(x - step * q)
            if new_value <= value + 1e-4 * step * slope or step < 1e-6:
                break
            step /= 2
        dx, dg = new - x, new_grad - grad
        if (c := float(dx.dot(dg))) > 1e-12:
            moves = [*moves[-memory + 1 :], (dx, dg, 1 / c)]
        done = value - new_value < 1e-7 * max(1e-3, abs(value))
        x, value, grad = new, new_value, new_grad
        if done:
            break
    return x


def fit(lines: Sequence[str], labels: np.ndarray, weights: np.ndarray, penalty: float = PENALTY, steps: int = STEPS) -> Model:
    """Logistic regression on log-count-ratio features with an L2 penalty."""
    rows, features = grams(lines)
    size = 1 << BITS
    # each n-gram of a passage once, as often as it is there, in both orders of the sparse matrix, so that sums by line and by feature are sums of runs
    pairs, times = np.unique(rows.astype(np.int64) << BITS | features, return_counts=True)
    rows, features = (pairs >> BITS).astype(np.int32), (pairs & (size - 1)).astype(np.int32)
    pos = np.bincount(features, (labels * weights)[rows], size) + 1
    neg = np.bincount(features, ((1 - labels) * weights)[rows], size) + 1
    ratio = (np.log(pos / pos.sum()) - np.log(neg / neg.sum())).astype(np.float32)
    scale = (1 / np.sqrt(np.maximum(np.bincount(rows, times, len(lines)), 1))).astype(np.float32)
    present, column = np.unique(features, return_inverse=True)
    column = column.astype(np.int32)
    value = ratio[features] * scale[rows] * times.astype(np.float32)
    by_feature = np.argsort(column, kind="stable")
    line_of, value_of = rows[by_feature], value[by_feature]
    line_starts, starts = np.flatnonzero(np.r_[True, np.diff(rows) > 0]), np.flatnonzero(np.r_[True, np.diff(column[by_feature]) > 0])
    filled, total, sign = rows[line_starts], weights.sum(), 2 * labels - 1

    def objective(x: np.ndarray) -> tuple[float, np.ndarray]:
        margin = np.full(len(lines), x[-1])
        margin[filled] += np.add.reduceat(x[:-1].astype(np.float32)[column] * value, line_starts)
        loss = float((np.logaddexp(0, -sign * margin) * weights).sum()) / total + penalty / 2 / len(lines) * float(x[:-1].dot(x[:-1]))
        error = (1 / (1 + np.exp(-margin)) - labels) * weights / total
        grad = np.add.reduceat(error.astype(np.float32)[line_of] * value_of, starts) + penalty / len(lines) * x[:-1]
        return loss, np.append(grad, error.sum())

    x = _minimise(objective, len(present) + 1, steps)
    full = np.zeros(size, np.float32)
    full[present] = x[:-1] * ratio[present]
    return Model(full, float(x[-1]))


def train(documents: Iterable[tuple[str, int]], rounds: int = ROUNDS, max_passages: int = MAX_PASSAGES, seeds: Iterable[tuple[str, int, str]] | None = None) -> Model:
    """A model from the templates and labelled documents (text, 1 if abusive)."""
    templates: dict[str, tuple[int, str]] = {}
    for p, label, lang in seed_text.passages() if seeds is None else seeds:
        templates[normalise(p)] = (label, lang)
        # all of a harmless passage is harmless, a part of an abusive one may be either
        for part in passages(p) if label == 0 else ():
            templates.setdefault(part, (label, lang))
    seen: dict[str, list[int]] = {}
    for text, label in documents:
        for line in set(passages(text)):
            seen.setdefault(line, [0, 0])[label] += 1
    if len(seen) > max_passages:
        # those that occur in several documents stand for more, the others are drawn by hash
        seen = {line: seen[line] for line in sorted(seen, key=lambda x: (-sum(seen[x]), xxhash.xxh64_intdigest(x)))[:max_passages]}
    seed_lines, seed_labels = list(templates), np.array([label for label, _ in templates.values()], dtype=float)
    # the classes' weights are the same in every language, else the language would tell the class
    groups = Counter(templates.values())
    even = np.array([len(templates) / (len(groups) * groups[g]) for g in templates.values()]) * np.where(seed_labels == 1, 1.0, HARMLESS_WEIGHT)
    model = fit(seed_lines, seed_labels, even)
    lines, counts = list(seen), np.array(list(seen.values()), dtype=float).reshape(-1, 2)
    often = counts.sum(1) ** 0.75
    for nth in range(rounds):
        if not lines:
            break
        scores = model.scores(lines)
        # a passage that occurs in abusive documents more often than in harmless ones, and looks abusive to a model that knows harmless documents
        abusive = (counts[:, 1] > counts[:, 0]) & (scores >= TAKE) & (nth > 0)
        harmless = (counts[:, 0] > 0) & ~abusive & ((scores < DOUBT) | (counts[:, 0] >= 3))
        take = abusive | harmless
        y = np.concatenate([seed_labels, abusive[take].astype(float)])
        part = np.concatenate([even, np.where(abusive[take], FOUND_WEIGHT, often[take] * min(MOST_WEIGHT, len(seed_labels) / max(1.0, often[harmless].sum())))])
        model = fit([*seed_lines, *[x for x, t in zip(lines, take) if t]], y, part)
    return model


def labelled(documents: DataFrame, labels: DataFrame, max_docs: int = MAX_DOCS) -> list[tuple[str, int]]:
    """A bounded sample of the labelled documents with one agreed label each."""
    agreed = labels.where(F.col("toxic").isNotNull()).groupBy("doc_id").agg(F.min("toxic").alias("low"), F.max("toxic").alias("toxic")).where(F.col("low") == F.col("toxic"))
    sample = agreed.orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_docs).select("doc_id", "toxic")
    rows = documents.where(F.col("text").isNotNull()).select("doc_id", "text").join(F.broadcast(sample), "doc_id").dropDuplicates(["doc_id"]).orderBy("doc_id").collect()
    return [(r["text"], int(r["toxic"])) for r in rows]


def _fingerprint(rows: Sequence[tuple[str, int]]) -> str:
    """Of all that a model comes from: the labelled texts, the templates and the parameters."""
    digest = hashlib.sha256(repr((BITS, ORDERS, MAX_PASSAGES, ROUNDS, DOUBT, TAKE, MOST_WEIGHT, HARMLESS_WEIGHT, FOUND_WEIGHT, PENALTY, STEPS, WORDS, STRIDE)).encode())
    for part in (*seed_text.passages(), *seed_text.vulgar()):
        digest.update(repr(part).encode())
    for text, label in rows:
        digest.update(f"{label}{len(text)}:".encode() + text.encode("utf-8", "surrogatepass"))
    return digest.hexdigest()


def model_for(spark: SparkSession, rows: Sequence[tuple[str, int]]) -> Model:
    """The model of these labelled texts: read from the shared folder if it was trained before, else trained and kept there."""
    path = f"{scratch.folder(spark)}/lakeplane/models/{_fingerprint(rows)}"
    if scratch.exists(spark, f"{path}/_SUCCESS"):
        kept = spark.read.parquet(path).first()
        return Model(np.frombuffer(bytes(kept["weights"]), dtype="<f4"), kept["bias"])
    model = train(rows)
    spark.createDataFrame([(bytearray(model.weights.astype("<f4").tobytes()), model.bias)], "weights binary, bias double").write.mode("overwrite").parquet(path)
    return model


def score(documents: DataFrame, model: Model) -> DataFrame:
    """All columns but text, and score: that of the document's worst passage."""
    keep = [c for c in documents.columns if c != "text"]
    shared = documents.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            pdf["score"] = np.round(shared.value.documents(pdf.pop("text").tolist()), 6)
            yield pdf

    schema = documents.select(*keep, F.lit(0.0).alias("score")).schema
    return documents.select(*keep, "text").mapInPandas(run, schema)


def rates(scored: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """source, n_docs, n_flagged, rate; null is a source of its own."""
    flagged = F.sum((F.col("score") >= threshold).cast("int"))
    return scored.groupBy("source").agg(F.count(F.lit(1)).alias("n_docs"), flagged.alias("n_flagged"), F.round(flagged / F.count(F.lit(1)), 6).alias("rate"))
