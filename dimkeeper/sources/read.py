"""Reading an entity's snapshot from a table, from files or over JDBC."""

from __future__ import annotations

import warnings
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


@dataclass(frozen=True)
class JdbcSource:
    """A database table, or a parenthesised query with an alias.

    One JDBC connection reads one partition, so a large table needs a split: either equal ranges
    of a numeric or date ``column`` between ``lower`` and ``upper``, or, where ranges would be
    uneven, one WHERE predicate per partition. Rows outside the bounds of a ``column`` are still
    read. Rows that no predicate holds for are not: the caller vouches that the predicates cover the
    table, NULLs included (one predicate must hold ``IS NULL``), and do not overlap.
    """

    url: str
    table: str
    properties: Mapping[str, str] = field(default_factory=dict)
    column: str | None = None
    lower: int | None = None
    upper: int | None = None
    partitions: int = 1
    predicates: Sequence[str] | None = None

    def __post_init__(self) -> None:
        if self.predicates is not None:
            if self.column is not None:
                raise ValueError("split by a column or by predicates, not by both")
            if not any("is null" in " ".join(p.lower().split()) for p in self.predicates):
                raise ValueError("no predicate has IS NULL: rows with a NULL there would not be read")

    def connection(self) -> dict[str, str]:
        """Properties with a fetch size; without one some drivers hold a whole partition in memory."""
        return {"fetchsize": "10000", **self.properties}

    def options(self) -> dict[str, str]:
        out = {**self.connection(), "url": self.url, "dbtable": self.table}
        if self.column is not None:
            if self.lower is None or self.upper is None or self.partitions < 2:
                raise ValueError("a partition column needs lower, upper and at least two partitions")
            out.update(
                partitionColumn=self.column,
                lowerBound=str(self.lower),
                upperBound=str(self.upper),
                numPartitions=str(self.partitions),
            )
        return out


def read_source(
    spark: SparkSession,
    source: str | JdbcSource,
    columns: Sequence[str] | None = None,
    schema: T.StructType | str | None = None,
) -> DataFrame:
    """A catalog table name, a path to parquet files, or a ``JdbcSource``.

    A text with a slash is a path. With ``columns`` only these are read. A ``schema`` saves the
    inference pass over file footers.
    """
    if isinstance(source, JdbcSource):
        if source.predicates is not None:
            df = spark.read.jdbc(
                source.url, source.table, predicates=list(source.predicates), properties=source.connection()
            )
        else:
            if source.column is None:
                warnings.warn(f"{source.table} is read over one connection, by one task", stacklevel=2)
            df = spark.read.format("jdbc").options(**source.options()).load()
    elif "/" in source:
        reader = spark.read if schema is None else spark.read.schema(schema)
        df = reader.parquet(source)
    else:
        df = spark.table(source)
    return df if columns is None else df.select(*columns)


def write_jdbc(
    df: DataFrame,
    url: str,
    table: str,
    properties: Mapping[str, str],
    max_connections: int,
    mode: str = "overwrite",
) -> None:
    """Publish a frame to a database table.

    Overwriting truncates the table, keeping its declared types and grants. No more than
    ``max_connections`` tasks write at once; as Spark merges partitions for that without a shuffle,
    what computes them runs in as many tasks. The number is the caller's choice.
    """
    df.write.format("jdbc").mode(mode).options(**jdbc_write_options(url, table, properties, max_connections)).save()


def jdbc_write_options(url: str, table: str, properties: Mapping[str, str], max_connections: int) -> dict[str, str]:
    return {
        "batchsize": "10000",
        **properties,
        "url": url,
        "dbtable": table,
        "truncate": "true",
        "numPartitions": str(max_connections),
    }
