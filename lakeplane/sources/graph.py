"""A directory's REST API with paged collections, and collections below each parent."""

from __future__ import annotations

import json
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession

from lakeplane.naming import sanitised
from lakeplane.sources.http import TIMEOUT_S, to_columns
from lakeplane.sources.registry import Source, connection, connector, options

# Addresses of the service.
BASE, LOGIN = "https://graph.microsoft.com", "https://login.microsoftonline.com"


def token(conn: dict[str, object]) -> str:
    import requests

    if conn.get("token"):
        return str(conn["token"])
    tenant = conn.get("tenant_id") or conn.get("tenant")
    form = {"grant_type": "client_credentials", "client_id": conn.get("client_id"), "client_secret": conn.get("client_secret"), "scope": f"{conn.get('base_url', BASE)}/.default"}
    answer = requests.post(f"{conn.get('login_url', LOGIN)}/{tenant}/oauth2/v2.0/token", data=form, timeout=30)
    answer.raise_for_status()
    return answer.json()["access_token"]


def query_string(opts: dict[str, object]) -> str:
    """``$select``, ``$filter``, ``$expand`` and ``$top`` of the options."""
    joined = lambda v: ",".join(map(str, v)) if isinstance(v, list) else str(v)
    return "&".join(f"${k}={joined(opts[k])}" for k in ("select", "filter", "expand", "top") if opts.get(k))


def pages(url: str, headers: dict[str, str]) -> Iterator[list[dict[str, object]]]:
    """The rows of each page, following the links to the end."""
    import requests

    while url:
        answer = requests.get(url, headers=headers, timeout=TIMEOUT_S)
        answer.raise_for_status()
        body = answer.json()
        yield body["value"] if "value" in body else [body] if "id" in body else []
        url = body.get("@odata.nextLink")


def _fetch(batches: Iterator[pd.DataFrame], headers: dict[str, str]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        for url, tags in zip(pdf["url"], pdf["tags"]):
            for rows in pages(url, headers):
                yield pd.DataFrame({"record": [json.dumps(json.loads(tags) | r) for r in rows]})


@connector("entra", "msgraph", "graph")
def graph(spark: SparkSession, source: Source) -> DataFrame:
    """A collection; with ``subresource`` that of each parent, by tasks in parallel, tagged with the parent's fields."""
    conn, opts = connection(source), options(source)
    base = f"{conn.get('base_url', BASE)}/{opts.get('api', 'v1.0')}"
    headers = {"Authorization": f"Bearer {token(conn)}", "ConsistencyLevel": "eventual"}
    entity = str(opts.get("entity") or source.get("source_table"))
    query = query_string(opts)
    suffix = f"?{query}" if query else ""
    asked = [(f"{base}/{entity}{suffix}", "{}")]
    if sub := opts.get("subresource"):
        fields = opts.get("parent_fields", ["id"])
        single = re.sub("s$", "", entity.split("/")[-1])
        wanted = ",".join(dict.fromkeys(["id", *fields]))
        parents = (p for page in pages(f"{base}/{entity}?$select={wanted}&$top=999", headers) for p in page)
        asked = [(f"{base}/{entity}/{p['id']}/{sub}{suffix}", json.dumps({f"{single}_{f}": p.get(f) for f in fields})) for p in parents]
    if not asked:
        return spark.createDataFrame([], "id string")
    requests_df = spark.createDataFrame(asked, "url string, tags string").repartition(min(len(asked), 64))
    df = to_columns(requests_df.mapInPandas(lambda b: _fetch(b, headers), "record string"))
    return df.toDF(*sanitised(df.columns)) if df.columns != ["_empty"] else spark.createDataFrame([], "id string")
