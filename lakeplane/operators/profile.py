"""Column profiles per load, with expressions induced by minimum description length.

All values of all columns of all given tables are counted per load in one pass (column, load, value), pre-aggregated on the
map side. Every value has forms of growing generality:

0. the value itself
1. runs of one character class with their lengths (``[A-Z]{2}-[0-9]{4}``)
2. either runs without lengths (``[A-Z]+-[0-9]+``) or letters and digits together with lengths (``[0-9a-f]{64}``), whichever
   describes the column better
3. letters, digits and underscores together without lengths (``[0-9a-z_]+``)
4. anything

Where classes are taken together, the class is the narrowest one that holds what the column's values have there. The forms
are a tree. A column's expression is the set of forms, at most one above each value, with the least sum of bits for

* the forms, sent once per ``block_rows`` rows (a form that isn't worth its bits in so many rows isn't part of the expression),
* telling which form a row has, and the rows given their forms,
* exceptions, which are spelled out row by row and don't conform.

It is found from the leaves up by one aggregation per level. Nulls are counted, not profiled. Values compare by their text,
and take part whole; where a form is long its hash stands for it as a key, while the expression that comes out is whole. Control
characters 1 to 5 and 26 count as one. An empty table gives no rows.
"""

from __future__ import annotations

import math
import re
import string
import unicodedata
from collections.abc import Iterator, Mapping, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakeplane.operators.grouped import previous_rows
from lakeplane.scratch import cut

#: One copy of the expression is paid for in so many rows.
BLOCK_ROWS = 100
#: Forms of more characters are keyed by their hash.
KEY_CHARS = 64
#: Forms beyond this number are joined by shuffle.
BROADCAST_FORMS = 50_000

UPPER, LOWER, DIGIT, JOINT, WORD = "\x01", "\x02", "\x03", "\x04", "\x05"
_SUBSTITUTE = "\x1a"
#: Character classes of a mask: bit, characters in a class, the class as text.
CLASSES = [(1, 10, "0-9"), (2, 6, "a-f"), (4, 20, "g-z"), (8, 6, "A-F"), (16, 20, "G-Z"), (32, 200, r"\p{L}\p{Nd}"), (64, 1, "_")]
#: Keys of the levels; the two of generality 2 are 2 and 3.
KEYS = ["value", "f1", "fa", "fb", "f3", "f4"]


def value_counts(df: DataFrame, load: Column, columns: Sequence[str], table: str = "") -> DataFrame:
    """table, column, load, value, n over all rows; value is null for nulls."""
    cells = F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"`{c}`").cast("string").alias("value")) for c in columns]))
    rows = df.select(load.cast("string").alias("load"), cells.alias("c"))
    return rows.groupBy("c.column", "load", "c.value").agg(F.count(F.lit(1)).alias("n")).select(F.lit(table).alias("table"), "column", "load", "value", "n")


def _key(form: Column) -> Column:
    return F.when(F.length(form) > KEY_CHARS, F.concat(F.lit("\x06"), F.md5(form))).otherwise(form)


def with_forms(counts: DataFrame) -> DataFrame:
    """counts with the keys of each value's forms and what their bits are counted from."""
    v = F.col("value")
    plain = F.translate(v, UPPER + LOWER + DIGIT + JOINT + WORD, _SUBSTITUTE * 5)
    ascii_ = F.translate(plain, string.ascii_uppercase + string.ascii_lowercase + string.digits, UPPER * 26 + LOWER * 26 + DIGIT * 10)
    wide = F.regexp_replace(F.regexp_replace(F.regexp_replace(ascii_, r"\p{Lu}", UPPER), r"[\p{L}&&[^\p{Lu}]]", LOWER), r"\p{Nd}", DIGIT)
    marked = counts.withColumn("beyond", v.rlike(r"[^\x00-\x7f]")).withColumn("f1", F.when(F.col("beyond"), wide).otherwise(ascii_))
    marked = marked.withColumn("fa", F.regexp_replace("f1", f"([{UPPER}{LOWER}{DIGIT}])\\1+", "$1")).withColumn("fb", F.translate("f1", UPPER + LOWER + DIGIT, JOINT * 3))
    marked = marked.withColumn("f3", F.regexp_replace("fb", f"[{JOINT}_]+", WORD))
    kept = lambda form, chars: F.length(form) - F.length(F.translate(form, chars, ""))
    letters, digits = kept("f1", UPPER + LOWER), kept("f1", DIGIT)
    beyond = F.col("beyond") & v.rlike(r"[\p{L}\p{Nd}&&[^\x00-\x7f]]")
    has = [digits > 0, v.rlike("[a-f]"), v.rlike("[g-z]"), v.rlike("[A-F]"), v.rlike("[G-Z]"), beyond, F.contains(v, F.lit("_"))]
    mask = sum((F.when(c, F.lit(bit)).otherwise(0) for c, (bit, _, _) in zip(has, CLASSES)), F.lit(0))
    tokens = kept(F.regexp_replace("fb", f"{JOINT}+", JOINT), JOINT)
    return marked.select(
        *counts.columns, _key(F.col("f1")).alias("f1"), _key(F.col("fa")).alias("fa"), _key(F.col("fb")).alias("fb"), _key(F.col("f3")).alias("f3"), mask.cast("int").alias("mask"),
        F.length(v).alias("chars"), letters.alias("letters"), digits.alias("digits"), kept("fa", UPPER + LOWER + DIGIT).alias("runs"), tokens.alias("tokens"), kept("f3", WORD).alias("words"), kept(v, "_").alias("scores"),
    )


def _class_bits(mask: Column, underscore: bool) -> Column:
    """Bits of a character of the class that a mask stands for."""
    used = CLASSES if underscore else CLASSES[:-1]
    return F.log2(F.greatest(F.lit(1), sum((F.when(mask.bitwiseAND(bit) > 0, F.lit(size)).otherwise(0) for bit, size, _ in used), F.lit(0))))


def _nodes(values: DataFrame, total: DataFrame, block_rows: int) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame, DataFrame]:
    """The tree: values and the nodes of level 1, of both kinds of level 2, of level 3, of level 4.

    Each node has ``stop``: its form costs no more than the best below it.
    """
    n, paid, n_all = F.col("n"), F.col("blocks"), F.col("total")
    named = lambda: n * F.log2(n_all / n)
    sent = lambda length: paid * (length * 8.0 + 8)
    spelled = F.col("chars") * 8.0 + 8
    escape = F.log2(F.least(n_all, F.lit(block_rows)))
    literal, exception = sent(F.col("chars")) + named(), n * (spelled + escape)
    values = values.join(F.broadcast(total), ["table", "column"]).withColumn("literal", literal < exception).withColumn("best", F.least(literal, exception))
    others = F.col("chars") - F.col("letters") - F.col("digits")
    # within a form of level 1 all values have equal counts of everything
    same = {c: F.max(c).alias(c) for c in ("chars", "letters", "digits", "runs", "tokens", "words", "scores", "total", "blocks")}
    ids = ["table", "column"]
    one = values.groupBy(*ids, "f3", "fa", "fb", "f1").agg(F.sum("n").alias("n"), F.sum("best").alias("below"), F.bit_or("mask").alias("mask"), F.min("value").alias("sample"), *same.values())
    tight = F.col("letters") * 4.7 + F.col("digits") * 3.33
    own = sent(F.col("runs") * 7 + others) + n * tight + named()
    one = cut(one.withColumn("stop", own <= F.col("below")).withColumn("best", F.least(own, "below")))

    up = [F.sum("n").alias("n"), F.sum("best").alias("below"), F.bit_or("mask").alias("mask"), F.min("sample").alias("sample"), F.sum(n * tight).alias("tight"), F.sum(n * (F.col("letters") + F.col("digits"))).alias("joint"), F.sum(n * F.col("chars")).alias("spelled"), F.sum(n * F.col("scores")).alias("underscored"), F.max(others).alias("others"), *[same[c] for c in ("runs", "tokens", "words", "scores", "total", "blocks")]]
    a = one.groupBy(*ids, "f3", "fa").agg(*up)
    own_a = sent(F.col("runs") * 6 + F.col("others")) + F.col("tight") + n * F.col("runs") * 3 + named()
    b = one.groupBy(*ids, "f3", "fb").agg(*up)
    own_b = sent(F.col("tokens") * 10 + F.col("others")) + F.col("joint") * _class_bits(F.col("mask"), False) + named()
    blank = F.lit(None).cast("string")
    a = a.select("*", own_a.alias("own"), blank.alias("fb"))
    b = b.select("*", own_b.alias("own"), blank.alias("fa"))
    two = a.unionByName(b).withColumn("runwise", F.col("fa").isNotNull()).withColumn("stop", F.col("own") <= F.col("below")).withColumn("best", F.least("own", "below"))
    two = cut(two.drop("own", "below"))

    # both kinds hold all rows, so sums come from one of them
    only = F.col("runwise")
    sums = [F.sum(F.when(only, F.col(c))).alias(c) for c in ("n", "joint", "spelled", "underscored")]
    three = two.groupBy(*ids, "f3").agg(*sums, F.sum(F.when(only, F.col("best"))).alias("below_a"), F.sum(F.when(~only, F.col("best"))).alias("below_b"), F.bit_or("mask").alias("mask"), F.min("sample").alias("sample"), F.max("words").alias("words"), F.max(F.col("others") - F.col("scores")).alias("others"), F.max("total").alias("total"), F.max("blocks").alias("blocks"))
    own_3 = sent(F.col("words") * 8 + F.greatest("others", F.lit(0))) + (F.col("joint") + F.col("underscored")) * _class_bits(F.col("mask"), True) + n * F.col("words") * 3 + named()
    three = three.withColumn("runwise", F.col("below_a") <= F.col("below_b")).withColumn("below", F.least("below_a", "below_b"))
    three = cut(three.withColumn("stop", own_3 <= F.col("below")).withColumn("best", F.least(own_3, "below")))
    four = three.groupBy(*ids).agg(F.sum("n").alias("n"), F.sum("best").alias("below"), F.sum("spelled").alias("spelled"), F.min("sample").alias("sample"), F.bit_or("mask").alias("mask"), F.max("blocks").alias("blocks"))
    four = four.withColumn("stop", sent(F.lit(2)) + F.col("spelled") * 8.0 + n * 8 <= F.col("below"))
    return values, one, two, three, four


def _chosen(values: DataFrame, one: DataFrame, two: DataFrame, three: DataFrame, four: DataFrame) -> DataFrame:
    """table, column, level, key, n, mask, sample of the forms of the best expressions, from the top down."""
    ids = ["table", "column"]
    pick = lambda nodes, level, key: nodes.where("stop").select(*ids, F.lit(level).alias("level"), key.alias("key"), "n", "mask", "sample")
    out = pick(four, 5, F.lit(".*"))
    three = three.join(four.where(~F.col("stop")), ids, "left_semi")
    out = out.unionByName(pick(three, 4, F.col("f3")))
    split = three.where(~F.col("stop")).select(*ids, "f3", "runwise")
    two = two.join(split, [*ids, "f3", "runwise"], "left_semi")
    out = out.unionByName(pick(two.where("runwise"), 2, F.col("fa"))).unionByName(pick(two.where(~F.col("runwise")), 3, F.col("fb")))
    left = two.where(~F.col("stop"))
    one = one.join(left.where("runwise").select(*ids, "fa"), [*ids, "fa"], "left_semi").unionByName(one.join(left.where(~F.col("runwise")).select(*ids, "fb"), [*ids, "fb"], "left_semi"), allowMissingColumns=True)
    out = out.unionByName(pick(one, 1, F.col("f1")))
    literals = values.where("literal").join(one.where(~F.col("stop")).select(*ids, "f1"), [*ids, "f1"], "left_semi")
    return out.unionByName(literals.select(*ids, F.lit(0).alias("level"), F.col("value").alias("key"), "n", "mask", F.col("value").alias("sample")))


def expression(sample: str, level: int, mask: int) -> str:
    """The regular expression of the form that a value has at a level, for whole values; Java and Python spell it alike but for ``\\p``."""
    if level == 5:
        return "(?s:.*)"
    beyond = bool(mask & 32)
    runs = {UPPER: r"\p{Lu}" if beyond else "[A-Z]", LOWER: r"[\p{L}&&[^\p{Lu}]]" if beyond else "[a-z]", DIGIT: r"\p{Nd}" if beyond else "[0-9]"}
    joint = "[" + "".join(text for bit, _, text in CLASSES if mask & bit and (level == 4 or bit < 64)).replace("a-fg-z", "a-z").replace("A-FG-Z", "A-Z") + "]"

    def kind(c: str) -> str:
        category = unicodedata.category(c)
        return UPPER if category == "Lu" else LOWER if category[0] == "L" else DIGIT if category == "Nd" else ""

    marks = [c if level == 0 else kind(c) or c for c in sample]
    if level >= 3:
        marks = [JOINT if len(k := kind(c)) else WORD if level == 4 and c == "_" else c for c in sample]
        marks = [JOINT if m == WORD else m for m in marks]
    out, i = [], 0
    while i < len(sample):
        m, j = marks[i], i + 1
        if level == 0 or m not in (UPPER, LOWER, DIGIT, JOINT) or not kind(sample[i]) and sample[i] != "_":
            c = sample[i]
            out.append("[\\x01-\\x05\\x1a]" if level and c in "\x01\x02\x03\x04\x05\x1a" else f"\\x{ord(c):02x}" if ord(c) < 32 else re.escape(c) if c.isascii() else c)
        else:
            while j < len(sample) and marks[j] == m:
                j += 1
            count = f"{{{j - i}}}" if j - i > 1 else ""
            out.append((joint if level >= 3 else runs[m]) + (count if level in (1, 3) else "+"))
        i = j
    return "".join(out)


def _spell(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        pdf["expression"] = [expression(s, level, mask) for s, level, mask in zip(pdf["sample"], pdf["level"], pdf["mask"])]
        yield pdf.drop(columns=["sample", "mask"])


def induce(typed: DataFrame, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """table, column, level, key, n, share, expression: the forms of each column's expression. ``typed`` comes from ``with_forms``.

    Levels here: 0 value, 1 runs with lengths, 2 runs, 3 joint classes with lengths, 4 joint classes, 5 anything.
    """
    filled = typed.where(F.col("value").isNotNull())
    values = cut(filled.groupBy("table", "column", "value", "f1", "fa", "fb", "f3", "mask", "chars", "letters", "digits", "runs", "tokens", "words", "scores").agg(F.sum("n").alias("n")))
    # columns are few: a row for each column of a configured table
    total = values.groupBy("table", "column").agg(F.sum("n").alias("total")).withColumn("blocks", F.greatest(F.lit(1.0), F.col("total") / block_rows))
    chosen = _chosen(*_nodes(values, total, block_rows))
    spelled = chosen.mapInPandas(_spell, "table string, column string, level int, key string, n long, expression string")
    return cut(spelled.join(F.broadcast(total), ["table", "column"]).withColumn("share", F.col("n") / F.col("total")).drop("total", "blocks"))


def match(typed: DataFrame, forms: DataFrame) -> DataFrame:
    """Rows from ``with_forms`` with the level and key of the form they conform to; both null for exceptions and null values.

    Above each value at most one form is chosen.
    """
    few = forms.count() <= BROADCAST_FORMS
    out = typed.withColumn("f4", F.lit(".*"))
    for level, name in enumerate(KEYS):
        side = forms.where(F.col("level") == level).select("table", "column", F.col("key").alias(name), F.lit(level).alias(f"hit{level}"))
        out = out.join(F.broadcast(side) if few else side, ["table", "column", name], "left")
    key = F.coalesce(*[F.when(F.col(f"hit{k}").isNotNull(), F.col(name)) for k, name in enumerate(KEYS)])
    kept = [c for c in typed.columns if c not in ("f1", "fa", "fb", "f3", "mask", "chars", "letters", "digits", "runs", "tokens", "words", "scores")]
    return out.select(*kept, F.coalesce(*[f"hit{k}" for k in range(len(KEYS))]).alias("level"), key.alias("key"))


def coverage_change(now: Column, before: Column) -> Column:
    """Struct of coverage_change and chance_change between two loads, each an array of (form, n) with every form once.

    ``coverage_change`` is half the sum of the changes of each form's share of the rows, from 0 (same) to 1 (nothing in
    common). ``chance_change`` is what two samples of these sizes from one distribution would show on average, so that loads
    of a few rows aren't taken for changed ones.
    """
    total = lambda load: F.aggregate(load, F.lit(0).cast("long"), lambda s, f: s + f["n"])
    held = lambda load, k: F.coalesce(F.try_element_at(F.map_from_entries(load), k), F.lit(0).cast("long"))
    n, n0 = total(now), total(before)
    both = F.transform(F.array_union(F.transform(now, lambda f: f["form"]), F.transform(before, lambda f: f["form"])), lambda k: F.struct(held(now, k).alias("a"), held(before, k).alias("b")))
    add = lambda parts: F.aggregate(parts, F.lit(0.0), lambda s, x: s + x)
    p = lambda f: (f["a"] + f["b"]) / (n + n0)
    moved = add(F.transform(both, lambda f: F.abs(f["a"] / n - f["b"] / n0))) / 2
    chance = add(F.transform(both, lambda f: F.sqrt(p(f) * (1 - p(f)) * (1 / n + 1 / n0)))) * (math.sqrt(2 / math.pi) / 2)
    return F.struct(moved.alias("coverage_change"), chance.alias("chance_change"))


def coverage_changes(counts: DataFrame, ids: Sequence[str], form: Column) -> DataFrame:
    """*ids, place, coverage_change, chance_change of weighted rows (*ids, place, the form, n), for places with one before.

    ``place`` numbers the loads of an entity from 0. A load has a row of its own here, with the forms of one expression.
    """
    loads = cut(counts.groupBy(*ids, "place").agg(F.collect_list(F.struct(form.alias("form"), "n")).alias("forms")))
    before = loads.select(*ids, (F.col("place") + 1).alias("place"), F.col("forms").alias("forms0"))
    return loads.join(before, [*ids, "place"]).select(*ids, "place", coverage_change(F.col("forms"), F.col("forms0")).alias("c")).select(*ids, "place", "c.*")


def _number_types(df: DataFrame, columns: Sequence[str]) -> list[str]:
    return [c for c, t in df.select(*[F.col(f"`{c}`") for c in columns]).dtypes if t in ("int", "bigint", "double", "float", "smallint", "tinyint") or t.startswith("decimal")]


def _typed_tables(tables: Mapping[str, tuple[DataFrame, Column, Sequence[str]]]) -> DataFrame:
    counts = None
    for name, (df, load, columns) in tables.items():
        part = value_counts(df, load, columns, name)
        counts = part if counts is None else counts.unionByName(part)
    return cut(with_forms(counts))


def standard(typed: DataFrame, numbers: Sequence[tuple[str, str]]) -> DataFrame:
    """table, column, load, n_rows, null_rate, n_distinct, min_value, max_value, min_number, max_number.

    Columns that hold numbers (``numbers``: table, column) have their bounds as numbers, all others as texts.
    """
    filled = F.col("value").isNotNull()
    is_number = F.concat_ws("\x00", "table", "column").isin([f"{t}\x00{c}" for t, c in numbers])
    number, text = F.when(is_number, F.col("value").try_cast("double")), F.when(~is_number, F.col("value"))
    return typed.groupBy("table", "column", "load").agg(
        F.sum("n").alias("n_rows"), F.round(F.sum(F.when(~filled, F.col("n")).otherwise(0)) / F.sum("n"), 6).alias("null_rate"), F.count(F.when(filled, 1)).alias("n_distinct"),
        F.min(text).alias("min_value"), F.max(text).alias("max_value"), F.min(number).alias("min_number"), F.max(number).alias("max_number"),
    )


def standard_tables(tables: Mapping[str, tuple[DataFrame, Column, Sequence[str]]]) -> DataFrame:
    """The standard aggregates of several tables, each given with its load and columns."""
    counts = None
    for name, (df, load, columns) in tables.items():
        part = value_counts(df, load, columns, name)
        counts = part if counts is None else counts.unionByName(part)
    return standard(counts, [(t, c) for t, (df, _, columns) in tables.items() for c in _number_types(df, columns)])


def expressions(tables: Mapping[str, tuple[DataFrame, Column, Sequence[str]]], block_rows: int = BLOCK_ROWS) -> DataFrame:
    """table, column, level, expression, n, share: the forms of every column's expression."""
    return induce(_typed_tables(tables), block_rows).select("table", "column", "level", "expression", "n", "share")


def profile_tables(tables: Mapping[str, tuple[DataFrame, Column, Sequence[str]]], block_rows: int = BLOCK_ROWS) -> DataFrame:
    """The standard aggregates with n_nonconforming, coverage_change and chance_change, for all tables in one plan.

    The coverage of a column's expression is compared with the load before (by name); both changes are null in a column's
    first load. Nulls count as a form of their own, and so do all exceptions together.
    """
    typed = _typed_tables(tables)
    rated = match(typed, induce(typed, block_rows))
    filled = F.col("value").isNotNull()
    level = F.when(filled, F.coalesce("level", F.lit(len(KEYS)))).otherwise(F.lit(-1)).alias("level")
    forms = cut(rated.groupBy("table", "column", "load", level, F.when(filled, F.coalesce("key", F.lit(""))).otherwise("").alias("key")).agg(F.sum("n").alias("n")))
    basic = cut(standard(typed, [(t, c) for t, (df, _, columns) in tables.items() for c in _number_types(df, columns)]))
    wrong = forms.where(F.col("level") == len(KEYS)).select("table", "column", "load", F.col("n").alias("n_nonconforming"))
    order = cut(_numbered(basic))
    ids = ["table", "column"]
    change = coverage_changes(forms.join(order, [*ids, "load"]), ids, F.concat_ws(":", F.col("level").cast("string"), "key"))
    change = order.join(change, [*ids, "place"]).select(*ids, "load", F.round("coverage_change", 6).alias("coverage_change"), F.round("chance_change", 6).alias("chance_change"))
    out = basic.join(wrong, [*ids, "load"], "left").join(change, [*ids, "load"], "left")
    return out.withColumn("n_nonconforming", F.coalesce("n_nonconforming", F.lit(0)))


def profile(df: DataFrame, load: Column, columns: Sequence[str], block_rows: int = BLOCK_ROWS) -> DataFrame:
    """One row per column and load of one table, as ``profile_tables``."""
    return profile_tables({"": (df, load, columns)}, block_rows).drop("table")


def _numbered(loads: DataFrame) -> DataFrame:
    """Loads of a table in order of name, numbered from 0; their number is that of the loads, not of the rows."""
    return loads.select("table", "column", "load", (F.row_number().over(Window.partitionBy("table", "column").orderBy("load")) - 1).alias("place"))


def nonconforming_rows(df: DataFrame, column: str, keys: Sequence[str], exact: Sequence[str] | None = None, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """keys, issue: rows whose value is null (``null``) or doesn't conform to the column's induced expression (``pattern``).

    With ``exact``, the list of values that are right by definition, every distinct value's verdict is held against
    it afterwards: in a table of a few rows an expression can't tell a rare right value from a wrong one.
    """
    typed = cut(with_forms(value_counts(df, F.lit(""), [column])))
    verdicts = match(typed, induce(typed, block_rows)).where(F.col("value").isNotNull()).withColumn("wrong", F.col("key").isNull())
    if exact is not None:
        verdicts = verdicts.withColumn("wrong", F.when(F.col("wrong"), ~F.col("value").isin(list(exact))).otherwise((F.col("level") > 0) | ~F.col("value").isin(list(exact))))
    wrong = verdicts.where("wrong").select(F.col("value").alias(column), F.lit("pattern").alias("issue"))
    slim = df.select(*keys, column)
    return slim.where(F.col(column).isNull()).select(*keys, F.lit("null").alias("issue")).unionByName(slim.join(wrong, column).select(*keys, "issue"))


def measure_issues(results: DataFrame, entity: str, run: str, at: str, failed: str, passed: str, shift: float = 0.2, volume: float = 2.0) -> DataFrame:
    """entity, run, issue of measurements: loads of which only the rows of two forms, failed and passed, are counted.

    Of rows with one entity and run the latest by ``at`` counts. ``null``: a count is null; ``range``: one is negative. A
    result is usable if both counts are set, none negative, not both 0; usable results are compared as loads with the entity's usable
    result before. ``shift``: the coverage changes by more than ``shift``; ``volume``: the sum is less than 1/``volume``
    or more than ``volume`` times that result's. Candidates come from the coverage comparison, and the shares are compared exactly.
    """
    f, p = F.col("f"), F.col("p")
    last = results.select(F.col(entity).alias("entity"), F.col(run).alias("run"), F.struct(F.unix_micros(at).alias("at"), F.col(failed).alias("f"), F.col(passed).alias("p")).alias("r"))
    last = cut(last.groupBy("entity", "run").agg(F.max("r").alias("r")).select("entity", "run", "r.*"))
    direct = last.select("entity", "run", F.explode(F.array_compact(F.array(F.when(f.isNull() | p.isNull(), "null"), F.when((f < 0) | (p < 0), "range")))).alias("issue"))
    usable = last.where(f.isNotNull() & p.isNotNull() & (f >= 0) & (p >= 0) & (f + p > 0)).select("entity", "run", F.coalesce("at", F.lit(-(1 << 62)).cast("long")).alias("at"), "f", "p")
    pairs = previous_rows(cut(usable), ["entity"], "at", ["f", "p"], ties=["run"]).where(F.col("prev").isNotNull())
    load = lambda f, p: F.array(F.struct(F.lit("failed").alias("form"), f.alias("n")), F.struct(F.lit("passed").alias("form"), p.alias("n")))
    f0, p0 = F.col("prev.f"), F.col("prev.p")
    size, size0 = f + p, f0 + p0
    changed = coverage_change(load(f, p), load(f0, p0))["coverage_change"] > shift - 1e-9
    moved = changed & (F.abs(f / size - f0 / size0) > shift)
    resized = (size * volume < size0) | (size > size0 * volume)
    compared = pairs.select("entity", "run", F.explode(F.array_compact(F.array(F.when(moved, "shift"), F.when(resized, "volume")))).alias("issue"))
    return direct.unionByName(compared).select(F.col("entity").alias(entity), F.col("run").alias(run), "issue")
