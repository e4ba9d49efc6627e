"""Projections, filters and reshaping of extracts."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, MapType, StructType

from lakeplane.functions.hashing import surrogate_key
from lakeplane.naming import quoted, sanitised

Spec = Sequence[object] | Mapping[str, object] | None
#: Fixed value: the form of answers that count as numbers.
NUMBER = r"^-?[0-9]+([.][0-9]+)?$"
#: Fixed value: answers longer than this are free text.
FREE_TEXT = 25


def apply_select(df: DataFrame, spec: Spec) -> DataFrame:
    """Columns, names and types to land.

    A list holds names, or items {source, name, type}; a mapping holds columns, rename and cast (by the new names).
    Columns that don't exist are left out. No spec, or a list of which nothing exists, lands everything. Values that can't be
    cast become null.
    """
    if not spec:
        return df
    if isinstance(spec, Mapping):
        names = [c for c in spec.get("columns") or df.columns if c in df.columns]
        out = df.select(*[quoted(c) for c in names]).withColumnsRenamed(spec.get("rename") or {})
        return out.withColumns({c: F.col(quoted(c)).try_cast(t) for c, t in (spec.get("cast") or {}).items() if c in out.columns})
    chosen = []
    for item in spec:
        item = {"source": item} if isinstance(item, str) else item
        source = item.get("source") or item.get("name")
        if source in df.columns:
            column = F.col(quoted(source))
            chosen.append((column.try_cast(item["type"]) if item.get("type") else column).alias(item.get("name") or source))
    return df.select(*chosen) if chosen else df


def ingest_filter(df: DataFrame, filters: Mapping[str, object] | None) -> DataFrame:
    """Rows whose trimmed text equals the wanted one in every named column that exists."""
    for column, value in (filters or {}).items():
        if column in df.columns:
            df = df.where(F.trim(F.col(quoted(column)).cast("string")) == F.lit(str(value)))
    return df


def newer_than(df: DataFrame, column: str, last: str | None, overlap: str | None = None) -> DataFrame:
    """Rows beyond the stored watermark, or all without one.

    The watermark has the column's type, so the filter reaches the scan. With ``overlap`` (an interval such as ``1 day``)
    rows at and shortly before it are read again; a keyed load takes them once.
    """
    if last is None:
        return df
    mark = F.lit(last).try_cast(df.schema[column].dataType)
    return df.where(F.col(column) >= mark - F.expr(f"interval {overlap}")) if overlap else df.where(F.col(column) > mark)


def stamp_bronze(df: DataFrame, run_id: str, system: str, table: str, at: datetime | Column) -> DataFrame:
    return df.withColumns({"_run_id": F.lit(run_id), "_source_system": F.lit(system), "_source_table": F.lit(table), "_bronze_ingest_ts": at if isinstance(at, Column) else F.lit(at)})


def flatten(df: DataFrame) -> DataFrame:
    """Structs to columns ``a_b``, arrays and maps to JSON text, names sanitised and unique."""

    def leaves(prefix: str, kind: DataType, column: Column) -> list[tuple[str, Column]]:
        if isinstance(kind, StructType):
            return [x for f in kind.fields for x in leaves(f"{prefix}.{f.name}" if prefix else f.name, f.dataType, column[f.name])]
        return [(prefix, F.to_json(column) if isinstance(kind, (ArrayType, MapType)) else column)]

    found = [x for f in df.schema.fields for x in leaves(f.name, f.dataType, F.col(quoted(f.name)))]
    return df.select(*[c.alias(n) for n, (_, c) in zip(sanitised(n for n, _ in found), found)])


def drop_empty_columns(df: DataFrame) -> DataFrame:
    """Without the columns that hold no value; one pass counts them all."""
    if not df.columns:
        return df
    counts = df.agg(*[F.count(quoted(c)).alias(f"c{i}") for i, c in enumerate(df.columns)]).first()
    return df.select(*[quoted(c) for i, c in enumerate(df.columns) if counts[i]])


def unpivot_answers(df: DataFrame, survey: object, respondent: str, meta: Sequence[str], headers: Mapping[str, str] | None = None) -> DataFrame:
    """A wide survey to one row per answer, with the keys and kinds a fact needs; null answers are dropped.

    Questions are the columns that are neither control columns nor ``meta``; ``headers`` restores their original names.
    """
    questions = [c for c in df.columns if not c.startswith("_") and c not in meta and c != respondent]
    code = {c: (headers or {}).get(c, c) for c in questions}
    wide = df.select(F.col(quoted(respondent)).cast("string").alias("_respondent"), *[F.col(quoted(c)).cast("string").alias(code[c]) for c in questions])
    long = wide.unpivot(["_respondent"], [quoted(code[c]) for c in questions], "question_code", "answer_text").where(F.col("answer_text").isNotNull())
    keyed = long.withColumn("survey_key", F.lit(survey)).withColumn("response_key", surrogate_key(F.col("survey_key"), F.col("_respondent")))
    return keyed.select(
        surrogate_key(F.col("response_key"), F.col("question_code")).alias("answer_key"), "response_key", "survey_key", "question_code",
        surrogate_key(F.col("survey_key"), F.col("question_code")).alias("question_key"), "answer_text",
        F.when(F.col("answer_text").rlike(NUMBER), F.col("answer_text").try_cast("double")).alias("answer_numeric"), (F.length("answer_text") > FREE_TEXT).alias("is_freetext"),
    )


def codebook(answers: DataFrame) -> DataFrame:
    """One row per question with its kind and its number of different answers."""
    kind = F.when(F.max(F.length("answer_text")) > FREE_TEXT, "free_text").when(F.every(F.col("answer_text").rlike(NUMBER)), "likert").otherwise("choice")
    return answers.groupBy("question_key", "survey_key", "question_code").agg(F.lit(None).cast("string").alias("question_text"), kind.alias("question_type"), F.count_distinct("answer_text").alias("distinct_answers"), F.lit(False).alias("is_kpi"))
