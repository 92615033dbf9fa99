"""What the operators share: reading tables, cutting lineage, fixed text rules."""

from __future__ import annotations

import os
from collections.abc import Callable, Iterable, Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..session import work_folder

# Fixed values of the contracts: bytes that end a word, the same as a character class.
SPACES = b" \t\n\x0b\x0c\r"
SPACE_CLASS = r"[\x20\x09-\x0D]"

# Python workers are kept between tasks. These settings of the C library make them give
# freed large arrays back to the system instead of holding them while others work.
_GIVE_BACK = {"MALLOC_MMAP_THRESHOLD_": "4194304", "MALLOC_TRIM_THRESHOLD_": "8388608", "ARROW_DEFAULT_MEMORY_POOL": "system"}


def importable(spark: SparkSession) -> None:
    """Lets Python workers import this package from where the driver has it, as with
    `spark.executorEnv.PYTHONPATH`; on a cluster without that path ship it with --py-files.
    Workers started after this also return freed memory (`_GIVE_BACK`), where nothing else is set."""
    root = str(Path(__file__).resolve().parents[2])
    known = spark.sparkContext.environment.get("PYTHONPATH", "").split(os.pathsep)
    if root not in known:
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join(filter(None, [root, *known]))
    for name, value in _GIVE_BACK.items():
        spark.sparkContext.environment.setdefault(name, value)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    importable(spark)
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def written(df: DataFrame, name: str) -> DataFrame:
    """The rows, written once under the shared folder and read back: a lost executor
    costs a re-read of files, and nothing above is computed twice."""
    path = work_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def map_arrow(
    df: DataFrame, make: Callable[[pa.RecordBatch], pa.RecordBatch | Iterable[pa.RecordBatch]], schema: str
) -> DataFrame:
    """`make` over the Arrow batches of every task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = make(batch)
            if isinstance(made, pa.RecordBatch):
                yield made
            else:
                yield from made

    return df.mapInArrow(run, schema)


def texts(batch: pa.RecordBatch, name: str = "text") -> list[str]:
    """A text column as Python strings, null as the empty text."""
    return [t or "" for t in batch.column(batch.schema.get_field_index(name)).to_pylist()]


def sheltered(df: DataFrame, *needed: str) -> tuple[DataFrame, Callable[..., DataFrame]]:
    """`df` with all columns but the needed ones under names that no operator uses, and
    what gives a result its columns and their names back, with named ones that were added."""
    names = df.columns
    inner = [c if c in needed else f"_{i}_{c}" for i, c in enumerate(names)]
    return df.toDF(*inner), lambda out, *added: out.select(*[F.col(f"`{c}`") for c in inner], *added).toDF(*names, *added)


def worked_out(df: DataFrame, made: dict[str, Column]) -> DataFrame:
    """`df` with columns that are worked out once per row. The explode of one element
    keeps the optimizer from copying their expressions to every use further up."""
    one = F.struct(*[value.alias(name) for name, value in made.items()])
    exploded = df.select("*", F.explode(F.array(one)).alias("_made"))
    return exploded.select(*df.columns, *[F.col(f"_made.{name}").alias(name) for name in made])


def hex_unit(value: Column) -> Column:
    """The first 32 bits of a hexadecimal digest as a whole number."""
    return F.conv(F.substring(value, 1, 8), 16, 10).cast("bigint")


def replaced(df: DataFrame, name: str, make: Callable[[pa.RecordBatch], list]) -> DataFrame:
    """`df` with a text column replaced inside the tasks. Where a text has changed and
    there is an `n_chars`, that is counted anew; everything else passes unchanged."""
    columns = df.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, max(batch.num_rows, 1), 1024):
                part = batch.slice(at, 1024)
                old, new = part.column(name).to_pylist(), make(part)
                part = part.set_column(columns.index(name), name, pa.array(new, pa.string()))
                if "n_chars" in columns:
                    kept = part.column("n_chars")
                    counts = [n if a == b else len(b) for a, b, n in zip(old, new, kept.to_pylist(), strict=True)]
                    part = part.set_column(columns.index("n_chars"), "n_chars", pa.array(counts, kept.type))
                yield part

    return df.mapInArrow(run, df.schema)
