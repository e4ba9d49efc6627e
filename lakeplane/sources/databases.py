"""Databases: the JDBC reader for all dialects, and a data source for DB-API drivers."""

from __future__ import annotations

import importlib
import json
import time
from collections.abc import Callable, Iterator
from datetime import date, datetime
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.types import BinaryType, BooleanType, ByteType, DataType, DateType, DecimalType, DoubleType, FloatType, IntegerType, LongType, ShortType, StructType, TimestampNTZType, TimestampType

from lakeplane.operators.shape import newer_than
from lakeplane.sources.registry import Source, connection, connector, options

# Driver class, port and URL of each dialect.
DIALECTS = {
    "sqlserver": ("com.microsoft.sqlserver.jdbc.SQLServerDriver", 1433, "jdbc:sqlserver://{host}:{port};databaseName={database};encrypt=true;trustServerCertificate=true"),
    "postgresql": ("org.postgresql.Driver", 5432, "jdbc:postgresql://{host}:{port}/{database}"),
    "mysql": ("com.mysql.cj.jdbc.Driver", 3306, "jdbc:mysql://{host}:{port}/{database}"),
    "oracle": ("oracle.jdbc.OracleDriver", 1521, "jdbc:oracle:thin:@//{host}:{port}/{database}"),
    "db2": ("com.ibm.db2.jcc.DB2Driver", 50000, "jdbc:db2://{host}:{port}/{database}"),
}
#: Types that don't land.
SKIPPED_TYPES = {"xml", "geography", "geometry", "hierarchyid", "varbinary", "image", "sql_variant"}
TRIES, WAIT_S = 4, 15


def jdbc_options(conn: dict[str, object], dialect: str) -> dict[str, str]:
    """Reader options; the URL is ``url``, else a connection string that is one, else the dialect's."""
    driver, port, template = DIALECTS.get(str(conn.get("dialect") or dialect), (None, None, None))
    driver = conn.get("driver") or driver
    driver = DIALECTS[driver][0] if driver in DIALECTS else driver
    text = str(conn.get("connection_string") or "")
    url = conn.get("url") or (text if text.startswith("jdbc:") else None)
    if not url:
        if template is None:
            raise ValueError(f"dialect {dialect!r} needs a url")
        url = template.format(host=conn.get("host") or conn.get("server"), port=conn.get("port") or port, database=conn.get("database") or conn.get("service") or "")
    out = {"url": str(url), "fetchsize": str(conn.get("fetchsize", 10_000))}
    for key, value in (("driver", driver), ("user", conn.get("user") or conn.get("username")), ("password", conn.get("password"))):
        if value:
            out[key] = str(value)
    return out


def table_name(source: Source) -> str:
    return ".".join(str(p) for p in (source.get("source_schema"), source.get("source_table")) if p)


def partition_options(opts: dict[str, object]) -> dict[str, str]:
    """Parallel reads where the object names a column and its bounds."""
    names = ("partitionColumn", "lowerBound", "upperBound", "numPartitions")
    return {n: str(opts[n]) for n in names if n in opts} if all(n in opts for n in names) else {}


def retrying(load, tries: int = TRIES, wait: float = WAIT_S):
    """Call ``load`` again, later each time, while the error speaks of connections or timeouts."""
    for k in range(1, tries + 1):
        try:
            return load()
        except Exception as e:
            if k == tries or not any(w in str(e).lower() for w in ("connect", "timeout", "timed out")):
                raise
            time.sleep(wait * k)


def read_jdbc(spark: SparkSession, source: Source, query: str | None = None) -> DataFrame:
    conn, opts = connection(source), options(source)
    dialect = str(source.get("connector") or source.get("source_type") or "sqlserver").lower()
    query = query or opts.get("query")
    what = {"query": str(query)} if query else {"dbtable": table_name(source)} | partition_options(opts)
    df = retrying(lambda: spark.read.format("jdbc").options(**jdbc_options(conn, dialect), **what).load())
    if dialect == "sqlserver" and not query:
        schema, table = source.get("source_schema") or "dbo", source.get("source_table")
        kinds = read_jdbc(spark, source, f"SELECT COLUMN_NAME, DATA_TYPE FROM INFORMATION_SCHEMA.COLUMNS WHERE TABLE_SCHEMA = '{schema}' AND TABLE_NAME = '{table}'").collect()
        dropped = {r[0] for r in kinds if str(r[1]).lower() in SKIPPED_TYPES}
        df = df.select(*[f"`{c}`" for c in df.columns if c not in dropped])
    return df


@connector("sqlserver", "postgresql", "mysql", "jdbc")
def jdbc(spark: SparkSession, source: Source) -> DataFrame:
    return read_jdbc(spark, source)


def watermarked(df: DataFrame, source: Source, last: str | None) -> DataFrame:
    """Rows beyond the watermark of an incremental object, whatever its connector; JDBC pushes the filter down."""
    column = source.get("watermark_column")
    if str(source.get("load_type") or "").lower() != "incremental" or not column:
        return df
    return newer_than(df, str(column), last, options(source).get("watermark_overlap"))


# --- DB-API drivers


class _Ranges(InputPartition):
    def __init__(self, query: str):
        super().__init__(query)
        self.query = query


def _converter(kind: DataType) -> Callable[[object], object]:
    """From what drivers give to what a column of the type takes; values that don't fit are an error."""
    if isinstance(kind, (ByteType, ShortType, IntegerType, LongType)):
        return int
    if isinstance(kind, (FloatType, DoubleType)):
        return float
    if isinstance(kind, DecimalType):
        return lambda v: Decimal(str(v))
    if isinstance(kind, BooleanType):
        return lambda v: v.strip().lower() in ("1", "t", "true", "y", "yes") if isinstance(v, str) else bool(v)
    if isinstance(kind, (TimestampType, TimestampNTZType)):
        return lambda v: datetime.fromisoformat(v) if isinstance(v, str) else v
    if isinstance(kind, DateType):
        return lambda v: date.fromisoformat(v) if isinstance(v, str) else v.date() if isinstance(v, datetime) else v
    return bytes if isinstance(kind, BinaryType) else str


class _Reader(DataSourceReader):
    def __init__(self, opts: dict[str, str], schema: StructType):
        self.opts, self.convert = opts, [_converter(f.dataType) for f in schema.fields]

    def partitions(self) -> list[InputPartition]:
        return [_Ranges(q) for q in json.loads(self.opts.get("queries", "null")) or [self.opts["query"]]]

    def read(self, partition: InputPartition) -> Iterator[tuple]:
        with_cursor = _cursor(self.opts)
        for cursor in with_cursor:
            cursor.execute(partition.query)
            while rows := cursor.fetchmany(5_000):
                yield from (tuple(None if v is None else to(v) for to, v in zip(self.convert, r)) for r in rows)


def _cursor(opts: dict[str, str]):
    """The cursor of a connection that is closed after use."""
    try:
        driver = importlib.import_module(opts["module"])
    except ImportError as e:
        raise RuntimeError(f"the driver {opts['module']!r} is not installed on this machine; install it with the cluster's environment") from e
    cn = driver.connect(*json.loads(opts.get("args", "[]")), **json.loads(opts.get("kwargs", "{}")))
    try:
        yield cn.cursor()
    finally:
        cn.close()


class DbApiSource(DataSource):
    """``format("dbapi")``: module, args, kwargs and query, or queries, of which each is read by a task of its own.

    Without a schema all columns are text, so that an empty result has the same schema as a full one; with one (``.schema(...)``)
    values keep the types that it names.
    """

    @classmethod
    def name(cls) -> str:
        return "dbapi"

    def schema(self) -> str:
        for cursor in _cursor(self.options):
            cursor.execute(f"SELECT * FROM ({self.options.get('query') or json.loads(self.options['queries'])[0]}) q WHERE 1 = 0")
            return ", ".join(f"`{d[0]}` string" for d in cursor.description)
        raise AssertionError

    def reader(self, schema: StructType) -> DataSourceReader:
        return _Reader(dict(self.options), schema)


def read_dbapi(spark: SparkSession, module: str, query: str, *args: object, schema: str | None = None, **kwargs: object) -> DataFrame:
    spark.dataSource.register(DbApiSource)
    reader = spark.read.format("dbapi").schema(schema) if schema else spark.read.format("dbapi")
    return reader.options(module=module, query=query, args=json.dumps(args), kwargs=json.dumps(kwargs)).load()


def default_query(source: Source) -> str:
    return str(options(source).get("query") or f"SELECT * FROM {table_name(source)}")


@connector("oracle")
def oracle(spark: SparkSession, source: Source) -> DataFrame:
    """The thin driver, or JDBC with ``mode`` jdbc."""
    conn = connection(source)
    if conn.get("mode") == "jdbc":
        return read_jdbc(spark, source)
    dsn = conn.get("dsn") or f"{conn.get('host')}:{conn.get('port', 1521)}/{conn.get('service') or conn.get('database')}"
    return read_dbapi(spark, "oracledb", default_query(source), schema=options(source).get("schema"), user=conn.get("user"), password=conn.get("password"), dsn=dsn)


@connector("db2")
def db2(spark: SparkSession, source: Source) -> DataFrame:
    conn = connection(source)
    if conn.get("mode") == "jdbc":
        return read_jdbc(spark, source)
    text = conn.get("connection_string") or "DATABASE={database};HOSTNAME={host};PORT={port};PROTOCOL=TCPIP;UID={user};PWD={password};".format_map({"port": 50000} | conn)
    return read_dbapi(spark, "ibm_db_dbi", default_query(source), text, "", "", schema=options(source).get("schema"))


@connector("odbc")
def odbc(spark: SparkSession, source: Source) -> DataFrame:
    conn = connection(source)
    text = str(conn.get("connection_string") or "").format(user=conn.get("user", ""), password=conn.get("password", ""))
    return read_dbapi(spark, str(conn.get("module", "pyodbc")), default_query(source), text, schema=options(source).get("schema"))
