"""Intake of dropped files: in batches by scanning a folder, or as a stream; the same file is loaded once either way.

``<schema>/.../<name>.csv`` (the first folder below the new files; ``dbo`` without one) lands as table ``<schema>.<name>``; ``<name>__key=a,b.csv`` is a full snapshot keyed by a and b,
other files are keyless and mirror the latest drop. A ledger of content hashes makes a repeated drop do nothing.
"""

from __future__ import annotations

import json
import os
import re
import shutil
from collections.abc import Iterator
from dataclasses import dataclass
from pathlib import Path
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from lakeplane.naming import ident, utc_now
from lakeplane.plans import workers
from lakeplane.plans.workers import Context
from lakeplane.sources.files import sheet_names

# Folders of the drop area, and kinds of files that are taken.
NEW, ARCHIVE = "newfile", "archive"
KINDS = ("csv", "txt", "xlsx")


@dataclass(frozen=True)
class Drop:
    """What a path says about a file: its place below the new files, schema, table, kind and keys."""

    relative: str
    schema: str
    stem: str
    kind: str
    keys: tuple[str, ...]

    @classmethod
    def of(cls, path: str) -> Drop:
        clean = unquote(path).replace("\\", "/")
        relative = clean[clean.index(f"{NEW}/") :] if f"{NEW}/" in clean else f"{NEW}/{clean.lstrip('/')}"
        parts = relative.split("/")
        stem, _, kind = parts[-1].rpartition(".")
        if kind.lower() not in KINDS or not stem:
            raise ValueError(f"{parts[-1]!r} is no file that can be taken in: {KINDS}")
        name, _, keys = stem.partition("__key=")
        schema = ident(parts[1]) if len(parts) > 2 else "dbo"
        return cls(relative, schema, ident(name), kind.lower(), tuple(k.strip() for k in keys.split(",") if k.strip()))


def content_hashes(spark: SparkSession, pattern: str) -> DataFrame:
    """path, content_hash of files, hashed by the tasks that read them."""
    return spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(pattern).select("path", F.sha2("content", 256).alias("content_hash"))


def objects(drop: Drop, local: str) -> Iterator[dict[str, object]]:
    """The source objects of a file: itself, or one per sheet of a workbook with several."""
    sheets = [None]
    if drop.kind == "xlsx":
        with open(local, "rb") as f:
            sheets = sheet_names(f.read())
    for sheet in sheets:
        table = drop.stem if sheet is None or len(sheets) == 1 else f"{drop.stem}_{ident(sheet)}"
        opts = {"path": local, "format": drop.kind, "landed": {"schema": drop.schema, "table": table}} | ({"sheet": sheet} if sheet is not None else {})
        yield {"object_id": f"drop_{drop.schema}_{table}", "source_name": drop.schema, "source_type": "file", "connector": "file", "source_schema": None, "source_table": table, "load_type": "full", "key_columns_json": json.dumps(list(drop.keys) or ["_row_hash"]), "source_options_json": json.dumps(opts), "is_active": True, "processing_state": "ACTIVE", "watermark_column": None}


def register(ctx: Context, drop: Drop, found: list[dict[str, object]]) -> None:
    """Enter the file's source and objects into the configuration, if they aren't there."""
    sources = ctx.config.tables["datasource"]
    source = next((s for s in sources if s["source_name"] == drop.schema), None)
    if source is None:
        source = {"source_id": max((s["source_id"] for s in sources), default=0) + 1, "source_name": drop.schema, "source_type": "file", "database_name": None, "load_group": 0, "ingestion_mode": "event", "is_active": True, "connector": "file", "connection_json": None, "secret_name": None}
        sources.append(source)
    known = {o["object_id"]: o for o in ctx.config.tables["source_object"]}
    for o in found:
        row = {k: o.get(k) for k in ("object_id", "source_schema", "source_table", "load_type", "key_columns_json", "watermark_column", "is_active", "processing_state", "source_options_json")}
        row |= {"source_id": source["source_id"], "target_name": None, "watermark_type": None, "suffix": None}
        if o["object_id"] in known:
            known[o["object_id"]].update(row)
        else:
            ctx.config.tables["source_object"].append(row)
    ctx.config.keep(ctx.store, "datasource", "source_object")


def seen_before(ctx: Context, key: str, content_hash: str) -> bool:
    ledger = ctx.audit.read("dropbox_ledger")
    return not ledger.where((F.col("file_key") == key) & (F.col("content_hash") == content_hash) & (F.col("status") == "LOADED")).isEmpty()


def archive(root: str, relative: str) -> str:
    """Move a file to the archive of its day; a name that is taken gets the time."""
    now = utc_now()
    source = Path(root, relative)
    target = Path(root, ARCHIVE, f"{now:%Y/%m/%d}", *Path(relative).parts[1:])
    if target.exists():
        target = target.with_name(f"{target.stem}_{now:%H%M%S%f}{target.suffix}")
    target.parent.mkdir(parents=True, exist_ok=True)
    shutil.move(source, target)
    return str(target)


def take(ctx: Context, root: str, path: str, content_hash: str, run_id: str, keep: bool = False) -> bool:
    """Load one file through bronze and silver; False if its content was loaded before. ``keep`` leaves it in place."""
    drop = Drop.of(path)
    if seen_before(ctx, drop.relative, content_hash):
        done = False
    else:
        local = os.path.join(root, drop.relative)
        found = list(objects(drop, local))
        register(ctx, drop, found)
        for o in found:
            workers.bronze(ctx, o, run_id)
            workers.silver(ctx, o, run_id)
        ctx.audit.append("dropbox_ledger", [{"file_key": drop.relative, "content_hash": content_hash, "schema_name": drop.schema, "object_count": len(found), "status": "LOADED", "processed_at": utc_now()}])
        done = True
    if not keep:
        archive(root, drop.relative)
    return done


def scan(ctx: Context, root: str, run_id: str) -> dict[str, str]:
    """Take in every file that lies in the new folder; a file that fails is logged and doesn't stop the others."""
    out: dict[str, str] = {}
    folder = Path(root, NEW)
    if not any(p.is_file() for p in folder.rglob("*")):
        return out
    for row in content_hashes(ctx.spark, f"file://{folder}").orderBy("path").toLocalIterator():
        path = row["path"]
        try:
            out[path] = "LOADED" if take(ctx, root, path, row["content_hash"], run_id) else "SEEN"
        except Exception as e:
            ctx.audit.log_failure("intake", run_id, 0, path, e)
            out[path] = "FAILED"
    return out


def stream(ctx: Context, root: str, checkpoint: str, run_id: str) -> StreamingQuery:
    """The same as a stream over what is there now; started again, it takes only new files."""
    files = ctx.spark.readStream.format("binaryFile").schema("path string, modificationTime timestamp, length long, content binary").option("recursiveFileLookup", "true").load(f"file://{Path(root, NEW)}").select("path", F.sha2("content", 256).alias("content_hash"))

    def batch(df: DataFrame, batch_id: int) -> None:
        for row in df.orderBy("path").toLocalIterator():
            try:
                take(ctx, root, row["path"], row["content_hash"], f"{run_id}_{batch_id}", keep=True)
            except Exception as e:
                ctx.audit.log_failure("intake", run_id, 0, row["path"], e)

    return files.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def append_stream(spark: SparkSession, source: DataFrame, ctx: Context, layer: str, table: str, schema: str, checkpoint: str) -> StreamingQuery:
    """Append a stream's batches to a table, each exactly once: a commit carries its batch's number as a tag."""

    def batch(df: DataFrame, batch_id: int) -> None:
        ctx.store.write(df, layer, table, schema, "append", tag=f"{re.sub('[^A-Za-z0-9]+', '_', checkpoint)}:{batch_id}")

    return source.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
