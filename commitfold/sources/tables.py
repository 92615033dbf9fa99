"""The tables on Parquet.

Layout stands in for secondary indexes: files carry Bloom filters on the lookup
columns, and a copy can be range-distributed and sorted by the column it is meant to
be searched by. Statistics and Bloom filters then let an equality or range lookup
skip almost all of the table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from .. import schemas as S

# Columns looked up by equality.
BLOOM = {
    "post": ("uri", "author", "rootUri"),
    "engagement": ("uri", "subjectUri", "author"),
    "sub_state": (),
}


# The catalog forgets that a column of a file table is not null; its comment says so.
REQUIRED = "required"


def create(spark: SparkSession, database: str, location: str | None = None) -> None:
    """Creates the database and its empty tables where missing."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    for name, schema in S.TABLES.items():
        columns = ", ".join(
            f"{f.name} {f.dataType.simpleString()}{'' if f.nullable else f" NOT NULL COMMENT '{REQUIRED}'"}" for f in schema.fields
        )
        at = f" LOCATION '{location.rstrip('/')}/{name}'" if location else ""
        spark.sql(f"CREATE TABLE IF NOT EXISTS {database}.{name} ({columns}) USING parquet{at}")


def list_tables(spark: SparkSession, database: str) -> list[str]:
    return sorted(t.name for t in spark.catalog.listTables(database))


def catalog(spark: SparkSession, database: str) -> DataFrame:
    """The tables of a database as the catalog lists them, with their columns: table_name,
    column_name, position, type, required."""
    rows = []
    for name in list_tables(spark, database):
        for i, c in enumerate(spark.catalog.listColumns(f"{database}.{name}")):
            rows.append((name, c.name, i, c.dataType, c.description == REQUIRED))
    return spark.createDataFrame(rows, "table_name string, column_name string, position int, type string, required boolean")


def insert(df: DataFrame, database: str, name: str) -> None:
    """Appends rows to a catalog table. A null in a column that must not hold any fails the
    write, which the file format would not do by itself."""

    def checked(field):
        value = F.col(field.name).cast(field.dataType)
        if field.nullable:
            return value.alias(field.name)
        message = F.lit(f"null in {name}.{field.name}")
        return F.when(value.isNull(), F.raise_error(message).cast(field.dataType)).otherwise(value).alias(field.name)

    df.select(*[checked(f) for f in S.TABLES[name].fields]).write.insertInto(f"{database}.{name}")


def inventory(tables: dict[str, DataFrame]) -> DataFrame:
    """Table names with their row counts."""
    counts = [
        df.agg(F.lit(name).alias("table_name"), F.count(F.lit(1)).alias("n")).select("table_name", "n")
        for name, df in tables.items()
    ]
    out = counts[0]
    for one in counts[1:]:
        out = out.unionByName(one)
    return out.orderBy("table_name")


def write(df: DataFrame, name: str, path: str, search_by: str | None = None, files: int | None = None) -> None:
    """Writes a table, or a copy of it laid out for lookups by `search_by`.

    A folded table is written as it comes, spread by the hash of its uri. A copy is
    range-distributed by (column, uri): the ranges are balanced by rows, so a value
    holding a large share of them gets several files.
    """
    if search_by is not None:
        by = [search_by, S.TABLES[name].fields[0].name]
        df = df.repartitionByRange(files, *by) if files else df.repartitionByRange(*by)
        df = df.sortWithinPartitions(*by)
    writer = df.write.mode("errorifexists")
    for column in BLOOM[name]:
        writer = writer.option(f"parquet.bloom.filter.enabled#{column}", "true")
    writer.parquet(path)


def save_bucketed(df: DataFrame, database: str, name: str, buckets: int) -> None:
    """Saves a catalog table bucketed by uri: joins on uri then need no shuffle."""
    key = S.TABLES[name].fields[0].name
    df.write.mode("overwrite").bucketBy(buckets, key).sortBy(key).format("parquet").saveAsTable(f"{database}.{name}")


def read(spark: SparkSession, name: str, path: str) -> DataFrame:
    return spark.read.schema(S.TABLES[name]).parquet(path)
