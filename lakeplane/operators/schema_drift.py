"""Schemas that drift between files: the changes, and one table for all files of an object.

Every column of a file gets a *mark*, an order-independent 128-bit fingerprint of its values over the records that it
shares with the neighbouring file. Marks are pre-aggregated, so no two columns are ever compared row by row. The trees of
two consecutive schemas, with marks at their leaves, give a minimum-cost edit script. The scripts of all snapshots
are compiled into one projection per file, which renames, fills and converts its values inside the JVM.

Only schemas (a row per snapshot with its columns) reach Python; rows never do. Repeated column and file rows count once.
For marks values are compared by their JSON text. A file without rows, or without records in common with its neighbour, gives no
evidence for renames. Null ids, names and times are ignored. Empty tables give no changes and no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakeplane.functions.tree_edit import build, edit_script
from lakeplane.operators.grouped import previous_rows
from lakeplane.operators.hierarchy import nested_sets
from lakeplane.scratch import cut

#: Numeric type names from narrow to wide.
WIDENING = ["int", "bigint", "decimal", "float"]
TEXT = ["char", "varchar", "nvarchar"]
TIMES = ["date", "datetime", "datetime2"]
_MAP = "map<string,string>"


def snapshots(columns: DataFrame) -> DataFrame:
    """object_id, at, before: the snapshots of each object with the one that precedes."""
    times = columns.select("object_id", F.unix_micros("discovered_at").alias("at")).where(F.col("object_id").isNotNull() & F.col("at").isNotNull()).distinct()
    return previous_rows(times, ["object_id"], "at", ["at"]).select("object_id", "at", F.col("prev.at").alias("before"))


def _schemas(columns: DataFrame) -> DataFrame:
    """object_id, at, name, kind of the active columns."""
    live = columns.where(F.col("is_active") & F.col("column_name").isNotNull() & F.col("object_id").isNotNull() & F.col("discovered_at").isNotNull())
    kind = F.lower(F.trim(F.col("source_data_type")))
    return live.groupBy("object_id", F.unix_micros("discovered_at").alias("at"), F.col("column_name").alias("name")).agg(F.min(kind).alias("kind"))


def _mark(key: Column, value: Column) -> list[Column]:
    text = F.coalesce(F.concat(F.lit("="), value), F.lit("null"))
    return [F.bit_xor(F.xxhash64(key, text)).alias("m1"), F.bit_xor(F.xxhash64(text, key, F.lit(7))).alias("m2"), F.count(value).alias("filled")]


def _scripts(batches: Iterator[pd.DataFrame], nested: bool) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        out = []
        for object_id, at, columns in zip(pdf["object_id"], pdf["at"], pdf["columns"]):
            sides: tuple[list, list] = ([], [])
            for c in columns:
                for k, (kind, mark) in enumerate(((c["old_kind"], c["old_mark"]), (c["new_kind"], c["new_mark"]))):
                    if kind is not None:
                        sides[k].append((c["name"], kind, mark))
            for kind, path, before in edit_script(build(sides[0], nested), build(sides[1], nested))[1]:
                out.append((object_id, at, kind, path, before))
        yield pd.DataFrame(out, columns=["object_id", "at", "drift_type", "column_name", "old_column_name"])


def changes(columns: DataFrame, files: DataFrame, nested: bool = False) -> DataFrame:
    """object_id, at, drift_type, column_name, old_column_name of every change between consecutive snapshots.

    With ``nested``, dots in column names separate the levels of structs, and moves between structs are found; else every
    name is one column.
    """
    times = cut(snapshots(columns))
    schemas = cut(_schemas(columns))
    after = times.where(F.col("before").isNotNull())
    unknown = F.coalesce("kind", F.lit("?"))
    new = schemas.join(after.select("object_id", "at"), ["object_id", "at"]).select("object_id", "at", "name", F.lit(None).cast("string").alias("old_kind"), unknown.alias("new_kind"))
    old = schemas.withColumnRenamed("at", "before").join(after, ["object_id", "before"]).select("object_id", "at", "name", unknown.alias("old_kind"), F.lit(None).cast("string").alias("new_kind"))
    both = new.unionByName(old).groupBy("object_id", "at", "name").agg(F.max("old_kind").alias("old_kind"), F.max("new_kind").alias("new_kind"))
    changed = cut(both.where(~F.col("old_kind").eqNullSafe(F.col("new_kind"))))

    # marks are needed where a name goes and another comes in one snapshot
    names = changed.groupBy("object_id", "at").agg(F.collect_set(F.when(F.col("new_kind").isNull(), F.col("name"))).alias("gone"), F.collect_set(F.when(F.col("old_kind").isNull(), F.col("name"))).alias("come"))
    asked = cut(names.where((F.size("gone") > 0) & (F.size("come") > 0)).join(after, ["object_id", "at"]))
    rows = files.select("object_id", F.unix_micros("landed_at").alias("landed"), "record_key", "row_json")
    blank = F.lit(None).cast("string")
    later = rows.join(asked.select("object_id", F.col("at").alias("landed")), ["object_id", "landed"]).select("object_id", F.col("landed").alias("at"), "record_key", blank.alias("old"), F.col("row_json").alias("new"))
    earlier = rows.join(asked.select("object_id", F.col("before").alias("landed"), "at"), ["object_id", "landed"]).select("object_id", "at", "record_key", F.col("row_json").alias("old"), blank.alias("new"))
    shared = later.unionByName(earlier).groupBy("object_id", "at", "record_key").agg(F.max("old").alias("old"), F.max("new").alias("new")).where(F.col("old").isNotNull() & F.col("new").isNotNull())

    def values(side: str, wanted: str) -> Column:
        return F.transform(F.col(wanted), lambda n: F.struct(F.lit(side).alias("side"), n.alias("name"), F.try_element_at(side, n).alias("value")))

    # parsed below the join, else each wanted column would parse its row again
    parsed = shared.select("object_id", "at", "record_key", F.from_json("old", _MAP).alias("old"), F.from_json("new", _MAP).alias("new"))
    cells = parsed.join(asked.drop("before"), ["object_id", "at"]).select("object_id", "at", "record_key", F.explode(F.concat(values("old", "gone"), values("new", "come"))).alias("c")).select("object_id", "at", "record_key", "c.*")
    marks = cells.groupBy("object_id", "at", "side", "name").agg(*_mark(F.col("record_key"), F.col("value"))).where(F.col("filled") > 0)
    text = F.concat_ws(":", "m1", "m2", "filled")
    marks = marks.groupBy("object_id", "at", "name").agg(F.max(F.when(F.col("side") == "old", text)).alias("old_mark"), F.max(F.when(F.col("side") == "new", text)).alias("new_mark"))
    trees = changed.join(marks, ["object_id", "at", "name"], "left").groupBy("object_id", "at").agg(F.collect_list(F.struct("name", "old_kind", "new_kind", "old_mark", "new_mark")).alias("columns"))
    return trees.mapInPandas(lambda batches: _scripts(batches, nested), "object_id string, at long, drift_type string, column_name string, old_column_name string")


def lineages(columns: DataFrame, found: DataFrame) -> DataFrame:
    """object_id, name, begin, end, target: the life of each column name and the column it ends up in.

    A name lives from the snapshot in which it comes to the one in which it goes. Renames link lives; the last life's
    name is the target. A name that comes back after it was gone is a column of its own, ``name_2`` and so on.
    """
    times = snapshots(columns)
    first = times.where(F.col("before").isNull()).select("object_id", "at")
    schemas = _schemas(columns)
    begins = schemas.join(first, ["object_id", "at"]).select("object_id", "name", "at").unionByName(found.where(F.col("drift_type").isin("COLUMN_ADDED", "COLUMN_RENAMED", "COLUMN_MOVED")).select("object_id", F.col("column_name").alias("name"), "at"))
    renamed = found.where(F.col("drift_type").isin("COLUMN_RENAMED", "COLUMN_MOVED"))
    ends = found.where(F.col("drift_type") == "COLUMN_REMOVED").select("object_id", F.col("column_name").alias("name"), "at").unionByName(renamed.select("object_id", F.col("old_column_name").alias("name"), "at"))
    nth = F.row_number().over(Window.partitionBy("object_id", "name").orderBy("at"))
    lives = begins.select("object_id", "name", F.col("at").alias("begin"), nth.alias("n")).join(ends.select("object_id", "name", F.col("at").alias("end"), nth.alias("n")), ["object_id", "name", "n"], "left")
    life = lambda name, n: F.to_json(F.struct("object_id", F.col(name).alias("name"), F.col(n).alias("n")))
    lives = cut(lives.withColumn("id", life("name", "n")))
    steps = renamed.select("object_id", "at", "column_name", "old_column_name")
    steps = steps.join(lives.select("object_id", F.col("name").alias("column_name"), F.col("begin").alias("at"), F.col("id").alias("parent")), ["object_id", "column_name", "at"])
    steps = steps.join(lives.select("object_id", F.col("name").alias("old_column_name"), F.col("end").alias("at"), F.col("id").alias("child")), ["object_id", "old_column_name", "at"])
    heads = nested_sets(cut(steps.select("parent", "child")), lives.select(F.col("id").alias("node"))).select(F.col("node").alias("id"), F.col("head"))
    placed = lives.join(heads, "id")
    last = placed.groupBy("object_id", "head").agg(F.min("begin").alias("since"), F.max_by("name", F.coalesce("end", F.lit(1 << 62).cast("long"))).alias("last"))
    again = F.row_number().over(Window.partitionBy("object_id", "last").orderBy("since", "head"))
    last = last.withColumn("again", again).select("object_id", "head", F.when(F.col("again") == 1, F.col("last")).otherwise(F.concat_ws("_", "last", F.col("again").cast("string"))).alias("target"))
    return cut(placed.join(last, ["object_id", "head"]).select("object_id", "name", "begin", "end", "target"))


def _snapshot_columns(columns: DataFrame, lives: DataFrame) -> DataFrame:
    inside = (F.col("at") >= F.col("begin")) & (F.col("end").isNull() | (F.col("at") < F.col("end")))
    return _schemas(columns).join(lives, ["object_id", "name"]).where(inside).select("object_id", "at", "name", "kind", "target")


def widest(kinds: Column) -> Column:
    """The narrowest type that holds all of the type names in an array."""
    only = lambda names: F.size(F.array_except(kinds, F.array(*[F.lit(n) for n in names]))) == 0
    wide = F.coalesce(*[F.when(F.array_contains(kinds, n), F.lit(n)) for n in reversed(WIDENING)])
    return F.when(F.size(kinds) == 1, kinds[0]).when(only(WIDENING), wide).when(only(TIMES), F.lit("datetime2")).otherwise(F.lit("nvarchar"))


def target_columns(columns: DataFrame, lives: DataFrame) -> DataFrame:
    """object_id, target, data_type, names: the columns of each object's one table."""
    at = _snapshot_columns(columns, lives)
    return at.groupBy("object_id", "target").agg(widest(F.array_sort(F.collect_set("kind"))).alias("data_type"), F.array_join(F.array_sort(F.collect_set("name")), ",").alias("names"))


def canonical(value: Column, kind: Column) -> Column:
    """The one text of a value in a type; null if the value isn't of that type.

    Numbers of any size keep all their digits. Times of day have to be whole microseconds without a zone, and a date has none.
    """
    sign, whole, part = (F.regexp_extract(value, r"^\s*([+-]?)0*(\d*)(?:\.(\d*?)0*)?\s*$", i) for i in (1, 2, 3))
    zero = (whole == "") & (part == "")
    plain = F.concat(F.when((sign == "-") & ~zero, F.lit("-")).otherwise(F.lit("")), F.when(whole == "", F.lit("0")).otherwise(whole), F.when(part == "", F.lit("")).otherwise(F.concat(F.lit("."), part)))
    # an exponent is written out where a decimal holds the very same number; doubles tell numbers of 15 digits apart
    wide = value.try_cast("decimal(38,18)")
    spelled = F.when(wide.cast("double") == value.try_cast("double"), F.regexp_replace(F.regexp_replace(wide.cast("string"), r"(\.\d*?)0+$", "$1"), r"\.$", ""))
    numeric = F.when(value.rlike(r"^\s*[+-]?(\d+\.?\d*|\.\d+)\s*$"), plain).when(value.rlike(r"^\s*[+-]?(?=[\d.]{1,15}[eE])(\d+\.?\d*|\.\d+)[eE][+-]?\d+\s*$"), spelled)
    moment = F.when(value.rlike(r"^\s*\d{4}-\d{1,2}-\d{1,2}([ T]\d{1,2}:\d{1,2}(:\d{1,2}(\.\d{1,6}0*)?)?)?\s*$"), F.trim(value).try_cast("timestamp_ntz"))
    # the text of a zoneless time doesn't depend on the session's zone
    day, clock = F.substring(moment.cast("string"), 1, 10), F.substring(moment.cast("string"), 12, 15)
    return (
        F.when(kind.isin("int", "bigint"), F.when(~F.contains(numeric, F.lit(".")), numeric))
        .when(kind.isin("decimal", "float"), numeric)
        .when(kind == "date", F.when(clock == "00:00:00", day))
        .when(kind.isin("datetime", "datetime2"), F.concat(day, F.lit("T"), clock))
        .otherwise(value)
    )


def unify(columns: DataFrame, files: DataFrame, lives: DataFrame) -> DataFrame:
    """object_id, file_name, landed_at, record_key, row_json, n_untyped: every distinct file row with the columns of its object's table.

    ``row_json`` has the target columns in order of name, each value as the one text it has in the target's type; a column
    that the file doesn't have is null. Values for a text column have the form of their own file's type. A value that isn't
    of the wanted type stays as it is and counts in ``n_untyped``.
    """
    at = cut(_snapshot_columns(columns, lives))
    kinds = at.groupBy("object_id", "target").agg(widest(F.array_sort(F.collect_set("kind"))).alias("wide"))
    at = at.join(kinds, ["object_id", "target"], "left").withColumn("form", F.when(F.col("wide").isin(*WIDENING, *TIMES), F.col("wide")).otherwise(F.coalesce("kind", F.lit(""))))
    projections = at.groupBy("object_id", "at").agg(F.map_from_entries(F.collect_list(F.struct("target", F.struct("name", "form")))).alias("names"))
    targets = at.groupBy("object_id").agg(F.array_sort(F.collect_set("target")).alias("targets"))
    compiled = cut(projections.join(targets, "object_id"))
    rows = files.select("object_id", "file_name", "landed_at", "record_key", F.from_json("row_json", _MAP).alias("row"), F.unix_micros("landed_at").alias("at")).join(compiled, ["object_id", "at"])
    keys = ["object_id", "file_name", "landed_at", "record_key"]
    source = lambda t: F.try_element_at("names", t)
    cells = F.transform("targets", lambda t: F.struct(t.alias("target"), F.try_element_at("row", source(t)["name"]).alias("value"), source(t)["form"].alias("form")))
    typed = lambda c: F.struct(c["target"].alias("target"), c["value"].alias("value"), canonical(c["value"], c["form"]).alias("typed"))
    out = rows.select(*keys, F.transform(cells, typed).alias("cells"))
    texts = F.transform("cells", lambda c: F.coalesce(c["typed"], c["value"]))
    untyped = F.size(F.filter("cells", lambda c: c["value"].isNotNull() & c["typed"].isNull()))
    return out.select(*keys, F.to_json(F.map_from_arrays("cells.target", texts), {"ignoreNullFields": "false"}).alias("row_json"), untyped.alias("n_untyped")).distinct()
