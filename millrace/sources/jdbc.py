"""Connection settings of the SQL Server target for Spark's JDBC source and sink."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from millrace.functions.names import field
from millrace.operators.keys import key_rejects
from millrace.operators.load import flat_table, jdbc_merge_sql, merge_source_rows, load

# Defaults of the target.
SERVER, PORT, DATABASE = "localhost", 1433, "etl_target"
CONNECTION_TIMEOUT, COMMAND_TIMEOUT = 30, 60


def sqlserver_options(
    *,
    server: str = SERVER,
    port: int = PORT,
    database: str = DATABASE,
    username: str | None = None,
    password: str | None = None,
    trust_server_certificate: bool = True,
    connection_timeout: int = CONNECTION_TIMEOUT,
    command_timeout: int = COMMAND_TIMEOUT,
) -> dict[str, str]:
    """JDBC options of one database."""
    trust = "true" if trust_server_certificate else "false"
    options = {
        "url": f"jdbc:sqlserver://{server}:{port};databaseName={database};"
        f"trustServerCertificate={trust};loginTimeout={connection_timeout}",
        "driver": "com.microsoft.sqlserver.jdbc.SQLServerDriver",
        "queryTimeout": str(command_timeout),
    }
    if username and password:
        options |= {"user": username, "password": password}
    return options


def query_table(spark: SparkSession, sql: str, **options) -> DataFrame:
    """The rows of a SELECT that the database runs."""
    return spark.read.format("jdbc").options(**options).option("query", sql).load()


def upsert_jdbc(
    df: DataFrame,
    table: str,
    key: str,
    execute: Callable[[str], None],
    *,
    order_by=(),
    staging: str | None = None,
    rejects: Callable[[DataFrame], None] | None = None,
    **options,
) -> str:
    """Upsert through a staging table and one MERGE on the server; returns the MERGE text.

    Executors fill the staging table in parallel, replacing what a failed try left there, so
    a repeated batch gives the same table. ``execute`` runs one statement on the database.

    A key that is the table's primary key takes no NULL, and the server would refuse the whole
    MERGE for one: with ``rejects``, a function that writes a frame, rows without a key go there
    (``key_rejects``) and not to the server. Without it they are merged, and inserted.
    """
    staging = staging or f"{table}_staging"
    if rejects is not None:
        flat = flat_table(df)
        rejects(key_rejects(flat.where(field(key).isNull()), key))
        df = flat.where(field(key).isNotNull())
    rows = flat_table(merge_source_rows(df, key, order_by))
    load(rows, staging, mode="truncate", fmt="jdbc", **options)
    sql = jdbc_merge_sql(table, staging, key, rows.columns)
    execute(sql)
    return sql
