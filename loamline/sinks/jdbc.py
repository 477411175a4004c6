"""Replace tables of a SQL database through Spark's JDBC writer."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from typing import Any
from urllib.parse import unquote, urlsplit

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType, StructType, TimestampType

# Type names that Spark's parser and databases share, and rows per insert batch.
# Text and floating-point numbers have no such name; for them Spark's dialect of the database
# chooses, in PostgreSQL TEXT and double precision.
DATABASE_TYPES = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "boolean": "BOOLEAN",
    "timestamp": "TIMESTAMP",
    "timestamp_ntz": "TIMESTAMP",
    "date": "DATE",
}
BATCH_ROWS = 5000


def connection(url: str) -> dict[str, str]:
    """JDBC options from a database URL such as ``postgresql://user:secret@host:5432/name``.

    A JDBC URL is taken as it is. The URL belongs in the environment, not in code.
    """
    if url.startswith("jdbc:"):
        return {"url": url}
    parts = urlsplit(url)
    scheme = parts.scheme.split("+")[0]
    port = f":{parts.port}" if parts.port else ""
    options = {"url": f"jdbc:{scheme}://{parts.hostname}{port}{parts.path}"}
    if parts.username:
        options["user"] = unquote(parts.username)
    if parts.password:
        options["password"] = unquote(parts.password)
    return options


def column_types(schema: StructType, types: Mapping[str, str] = DATABASE_TYPES) -> str:
    """Types for the created table, where they are named alike; the dialect gives the others."""
    known = [f for f in schema if f.dataType.simpleString() in types]
    return ", ".join(f"`{f.name}` {types[f.dataType.simpleString()]}" for f in known)


def for_database(df: DataFrame) -> DataFrame:
    """Timestamps without a zone and NULL in place of NaN."""
    changed = {}
    for f in df.schema:
        if isinstance(f.dataType, TimestampType):
            changed[f.name] = F.col(f.name).cast("timestamp_ntz")
        elif isinstance(f.dataType, (DoubleType, FloatType)):
            changed[f.name] = F.when(~F.isnan(f.name), F.col(f.name))
    return df.withColumns(changed) if changed else df


def stage_name(table: str) -> str:
    """Where the rows are put before they become the table; in the same schema."""
    return f"{table}__stage"


def swap_statements(table: str) -> list[str]:
    """What makes the filled stage the table."""
    return [
        f"DROP TABLE IF EXISTS {table}",
        f"ALTER TABLE {stage_name(table)} RENAME TO {table.rsplit('.', 1)[-1]}",
    ]


def in_transaction(connection: Any, statements: Iterable[str]) -> None:
    """Run statements on a JDBC connection, all or none, and close it."""
    try:
        connection.setAutoCommit(False)
        try:
            for text in statements:
                statement = connection.createStatement()
                try:
                    statement.execute(text)
                finally:
                    statement.close()
        except BaseException:
            connection.rollback()
            raise
        connection.commit()
    finally:
        connection.close()


def opened(spark: SparkSession, options: Mapping[str, str]) -> Any:
    """A JDBC connection of the driver, by the options that Spark's writer takes."""
    properties = spark._jvm.java.util.Properties()
    for name, value in options.items():
        if name != "url":
            properties.setProperty(name, value)
    return spark._jvm.java.sql.DriverManager.getConnection(options["url"], properties)


def load_table(
    df: DataFrame,
    table: str,
    options: Mapping[str, str],
    connections: int = 8,
    types: Mapping[str, str] = DATABASE_TYPES,
) -> None:
    """Replace ``table``. Every task inserts its own rows in batches into a stage beside it;
    ``connections`` bounds how many write at once. Only when all rows are there does the stage become the
    table, in one transaction, so a failed load leaves the old rows, and readers never see half of the
    new ones (in databases whose DROP and ALTER belong to a transaction, as in PostgreSQL)."""
    out = for_database(df)
    (
        out.write.format("jdbc")
        .options(**options)
        .option("dbtable", stage_name(table))
        .option("batchsize", BATCH_ROWS)
        .option("numPartitions", connections)
        .option("createTableColumnTypes", column_types(out.schema, types))
        .mode("overwrite")
        .save()
    )
    in_transaction(opened(df.sparkSession, options), swap_statements(table))


def load_tables(tables: Mapping[str, DataFrame], options: Mapping[str, str], **kwargs) -> None:
    for name, df in tables.items():
        load_table(df, name, options, **kwargs)
