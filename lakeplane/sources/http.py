"""HTTP APIs: JSON, CSV, and CSV in ZIP archives, read by tasks, one request each."""

from __future__ import annotations

import io
import json
import re
import zipfile
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeplane.naming import sanitised
from lakeplane.operators.shape import ingest_filter
from lakeplane.sources.registry import Source, connection, connector, dig, options

TIMEOUT_S, ZIP_TIMEOUT_S = 120, 600


def requests_of(source: Source) -> list[dict[str, object]]:
    """The requests of an object: one, or one per entry of ``pages``, whose values fill the URL too."""
    conn, opts = connection(source), options(source)
    base = {"method": str(opts.get("method") or "GET").upper(), "headers": {**(conn.get("headers") or {}), **(opts.get("headers") or {})}, "query": opts.get("query"), "body": opts.get("body")}
    url = str(opts.get("url") or str(conn.get("base_url") or "") + str(opts.get("path") or ""))
    return [base | {"url": url.format(**{**(opts.get("params") or {}), **page})} for page in opts.get("pages") or [{}]]


def send(request: dict[str, object]) -> object:
    import requests

    answer = requests.request(request["method"], request["url"], headers=request["headers"], params=request["query"], json=request["body"], timeout=TIMEOUT_S)
    answer.raise_for_status()
    return answer


def choose_member(names: list[str], member: str | None, exclude: str | None) -> str:
    """The CSV that matches ``member``, else the first whose name doesn't hold ``exclude``."""
    for name in names:
        if name.lower().endswith(".csv") and (re.search(member, name) if member else not exclude or exclude not in name):
            return name
    raise ValueError(f"the archive has no matching CSV: {names}")


def _rows(batches: Iterator[pd.DataFrame], how: dict[str, object]) -> Iterator[pd.DataFrame]:
    """A JSON text per record, in bounded batches."""
    kind = how.get("type", "json")
    for pdf in batches:
        for text in pdf["request"]:
            answer = send(json.loads(text))
            if kind == "json":
                data = dig(answer.json(), how.get("record_path"))
                records = [data] if isinstance(data, dict) else data or []
                for i in range(0, len(records), 5_000):
                    yield pd.DataFrame({"record": [json.dumps(r) for r in records[i : i + 5_000]]})
                continue
            stream: object = io.BytesIO(answer.content)
            if kind == "zip_csv":
                import requests

                link = dig(answer.json(), how.get("url_field", "object"))
                archive = zipfile.ZipFile(io.BytesIO(requests.get(str(link), timeout=ZIP_TIMEOUT_S).content))
                stream = archive.open(choose_member(archive.namelist(), how.get("member"), how.get("exclude", "_Meta")))
            for part in pd.read_csv(stream, dtype=str, chunksize=20_000):
                part = part.astype(object).where(part.notna(), None)
                yield pd.DataFrame({"record": [json.dumps(r, ensure_ascii=False) for r in part.to_dict("records")]})


def flatten_record(record: dict[str, object], prefix: str = "") -> dict[str, str | None]:
    """A nested record as dotted names and texts; lists are JSON text."""
    out: dict[str, str | None] = {}
    for k, v in record.items():
        if isinstance(v, dict) and v:
            out |= flatten_record(v, f"{prefix}{k}.")
        else:
            out[f"{prefix}{k}"] = v if v is None or isinstance(v, str) else json.dumps(v)
    return out


def to_columns(records: DataFrame) -> DataFrame:
    """One text column per dotted name that occurs, in order of name; the names are found in one distributed pass."""

    def flat(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            yield pd.DataFrame({"fields": [flatten_record(json.loads(r)) for r in pdf["record"]]})

    maps = records.mapInPandas(flat, "fields map<string,string>").persist()
    names = [r[0] for r in maps.select(F.explode(F.map_keys("fields"))).distinct().orderBy("col").collect()]
    if not names:
        return records.sparkSession.createDataFrame([], "_empty string")
    return maps.select(*[F.try_element_at("fields", F.lit(n)).alias(n) for n in names])


@connector("http", "rest_api", "statcan_wds")
def http(spark: SparkSession, source: Source) -> DataFrame:
    """Rows of an API as text columns; filters use the original names, then names are sanitised."""
    opts = options(source)
    how = opts.get("response") or {"type": "json"}
    asked = spark.createDataFrame([(json.dumps(r),) for r in requests_of(source)], "request string")
    records = asked.repartition(asked.count()).mapInPandas(lambda b: _rows(b, how), "record string")
    df = ingest_filter(to_columns(records), opts.get("filters"))
    return df.toDF(*sanitised(df.columns))
