"""Creating and replacing catalog tables.

A file table cannot be overwritten by a query that reads it, so the next state is first written
to a staging table. Once that is complete it is marked, by table properties, as the next state of
its target, and only a marked table is ever put in place or dropped: a name alone means nothing.
``finish_replace`` can repeat the second half as often as needed, and jobs call it before they read
the target. Names are new each time, so what a killed driver left half-written is in nobody's way.

An unpartitioned file table takes over the staged folder (``SET LOCATION``): rows are written once,
and readers see the old state or the new one. Partitions are replaced by one dynamic overwrite, so
their values never pass through text.
"""

from __future__ import annotations

import datetime as dt
import re
import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dimkeeper.functions import date_literal, text_literal


# Properties of a staging table; REPLACES is set last and alone makes it one.
REPLACES, FOLDER, FORMER = "dimkeeper.replaces", "dimkeeper.folder", "dimkeeper.former"

FILE_FORMATS = ("parquet", "orc", "json", "csv", "avro", "text")


def _quoted(name: str) -> str:
    return ".".join(f"`{part}`" for part in name.split("."))


def ensure_database(spark: SparkSession, name: str, location: str | None = None) -> None:
    where = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {_quoted(name)}{where}")


def ensure_table(
    spark: SparkSession,
    table: str,
    schema: T.StructType,
    partition_by: Sequence[str] = (),
    bucket_by: Sequence[str] = (),
    buckets: int = 0,
    using: str = "parquet",
) -> None:
    """Create the table if it is absent.

    Bucketed by its key (into at least as many buckets as there are shuffle partitions) a dimension
    is not shuffled when it is compared with a snapshot. Spark makes no use of sorted buckets, so
    they are not sorted.
    """
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    ddl = f"CREATE TABLE IF NOT EXISTS {_quoted(table)} ({columns}) USING {using}"
    if partition_by:
        ddl += f" PARTITIONED BY ({', '.join(f'`{c}`' for c in partition_by)})"
    if bucket_by:
        names = ", ".join(f"`{c}`" for c in bucket_by)
        ddl += f" CLUSTERED BY ({names}) INTO {buckets} BUCKETS"
    spark.sql(ddl)


def drop_table(spark: SparkSession, table: str) -> None:
    spark.sql(f"DROP TABLE IF EXISTS {_quoted(table)}")


def _same_columns(a: T.StructType, b: T.StructType) -> bool:
    return {f.name.lower(): f.dataType for f in a.fields} == {f.name.lower(): f.dataType for f in b.fields}


def save_table(spark: SparkSession, df: DataFrame, table: str, new_columns: bool = False) -> None:
    """Overwrite a table, by name, in its own layout; created if absent.

    The rows are complete before anything of the old state goes, so a write that fails changes
    nothing. Other columns than the table has are an error, or with ``new_columns`` make it a new
    table of the same name, without the old one's layout.
    """
    if not spark.catalog.tableExists(table):
        staging = new_staging_name(table)
        df.write.saveAsTable(staging)
        spark.sql(f"ALTER TABLE {_quoted(staging)} RENAME TO {_quoted(table)}")
    elif _same_columns(spark.table(table).schema, df.schema):
        staged_replace(spark, df, table)
    elif new_columns:
        staging, former = new_staging_name(table), new_staging_name(table)
        df.write.saveAsTable(staging)
        spark.sql(f"ALTER TABLE {_quoted(table)} RENAME TO {_quoted(former)}")
        spark.sql(f"ALTER TABLE {_quoted(staging)} RENAME TO {_quoted(table)}")
        drop_table(spark, former)
    else:
        raise ValueError(f"{table} has other columns than the rows to be written; see new_columns")


def new_staging_name(table: str) -> str:
    return f"{table}__staging_{uuid.uuid4().hex[:12]}"


def _properties(spark: SparkSession, table: str) -> dict[str, str]:
    return {r["key"]: r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES {_quoted(table)}").collect()}


def mark_staged(spark: SparkSession, staging: str, table: str, **more: str) -> None:
    """Says that a staging table is complete and is the next state of ``table``."""
    properties = {**{f"dimkeeper.{k}": v for k, v in more.items() if v}, REPLACES: table}
    pairs = ", ".join(f"{text_literal(k)} = {text_literal(v)}" for k, v in properties.items())
    spark.sql(f"ALTER TABLE {_quoted(staging)} SET TBLPROPERTIES ({pairs})")


def staged_property(spark: SparkSession, staging: str, name: str) -> str:
    return _properties(spark, staging)[f"dimkeeper.{name}"]


def find_staging(spark: SparkSession, table: str) -> str | None:
    """The complete staging table that waits to be put in place of ``table``, if there is one."""
    database, _, name = table.rpartition(".")
    scope = f" IN {_quoted(database)}" if database else ""
    pattern = re.compile(re.escape(name.lower()) + "__staging_[0-9a-f]{12}")
    names = [r["tableName"] for r in spark.sql(f"SHOW TABLES{scope}").where("NOT isTemporary").collect()]
    named = [f"{database}.{n}".lstrip(".") for n in names if pattern.fullmatch(n.lower())]
    found = [n for n in named if _properties(spark, n).get(REPLACES) == table]
    if len(found) > 1:
        raise RuntimeError(f"several runs left a staged state of {table}; drop all but one")
    return found[0] if found else None


def _details(spark: SparkSession, table: str) -> dict[str, str]:
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {_quoted(table)}").select("col_name", "data_type").collect()
    return dict(rows[len(spark.table(table).columns) :])


def _partition_columns(spark: SparkSession, table: str) -> list[str]:
    return [c.name for c in spark.catalog.listColumns(table) if c.isPartition]


def content_folder(spark: SparkSession, table: str) -> str | None:
    """The folder that ``staged_replace`` has given the table's content, which names this content; None if there is none."""
    folder = _details(spark, table).get("Location", "").rstrip("/")
    return folder if re.search("__v_[0-9a-f]{12}$", folder) else None


def table_property(spark: SparkSession, table: str, name: str) -> str | None:
    return _properties(spark, table).get(f"dimkeeper.{name}")


def set_table_property(spark: SparkSession, table: str, name: str, value: str) -> None:
    spark.sql(f"ALTER TABLE {_quoted(table)} SET TBLPROPERTIES ({text_literal(f'dimkeeper.{name}')} = {text_literal(value)})")


def _remove_folder(spark: SparkSession, folder: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def bucket_spec(spark: SparkSession, table: str) -> tuple[int, list[str]] | None:
    """Number of buckets and bucket columns, from the table's description."""
    detail = spark.sql(f"DESCRIBE TABLE EXTENDED {_quoted(table)}")
    found = dict(detail.where("col_name IN ('Num Buckets', 'Bucket Columns')").select("col_name", "data_type").collect())
    if "Num Buckets" not in found:
        return None
    names = found["Bucket Columns"].strip("[]").split(", ")
    return int(found["Num Buckets"]), [n.strip("`") for n in names]


def staged_replace(
    spark: SparkSession,
    df: DataFrame,
    table: str,
    partition_col: str | None = None,
    always: Sequence[object] = (),
    clustered: bool = False,
    only_if: Callable[[DataFrame], bool] | None = None,
) -> bool:
    """Replace the table's content by ``df``, which may read the table.

    With ``partition_col`` only the partitions that ``df`` has rows for are replaced, and those
    named in ``always`` (typed values) even if ``df`` has none for them. Columns go by name.

    The staging table has the buckets of the table. Rows are brought together by bucket first, or
    every task would write a file into every bucket; ``clustered=True`` says that they are together
    already, as after a join on the bucket columns, and saves that shuffle. ``only_if`` looks at the
    staged rows; where it says no, the table's files stay as they are. Says whether they were replaced.
    """
    columns = spark.table(table).columns
    buckets = bucket_spec(spark, table)
    if buckets and not clustered:
        df = df.repartition(buckets[0], *buckets[1])
    details, partitions = _details(spark, table), _partition_columns(spark, table)
    staging, folder, former = new_staging_name(table), None, None
    writer = df.select(*columns).write.mode("error")
    if partitions:
        writer = writer.partitionBy(*partitions)
    elif details.get("Provider", "").lower() in FILE_FORMATS and details.get("Location"):
        former = details["Location"]
        folder = f"{re.sub('__v_[0-9a-f]{12}$', '', former.rstrip('/'))}__v_{uuid.uuid4().hex[:12]}"
        writer = writer.format(details["Provider"]).option("path", folder)
    if buckets:
        writer = writer.bucketBy(buckets[0], *buckets[1])
    writer.saveAsTable(staging)
    if only_if is not None and not only_if(spark.table(staging)):
        drop_table(spark, staging)
        if folder:
            _remove_folder(spark, folder)
        return False
    emptied = "\n".join(map(_literal, always))
    mark_staged(spark, staging, table, folder=folder, former=former, partition=partition_col, always=emptied)
    finish_replace(spark, table)
    return True


def finish_replace(spark: SparkSession, table: str) -> bool:
    """Second half of ``staged_replace``; says whether there was a staged state to put in place."""
    staging = find_staging(spark, table)
    if staging is None:
        return False
    properties = _properties(spark, staging)
    if folder := properties.get(FOLDER):
        spark.sql(f"ALTER TABLE {_quoted(table)} SET LOCATION {text_literal(folder)}")
        spark.catalog.refreshTable(table)
        if properties.get(FORMER) and properties[FORMER] != folder:
            _remove_folder(spark, properties[FORMER])
    elif partition_col := properties.get("dimkeeper.partition"):
        always = [x for x in properties.get("dimkeeper.always", "").split("\n") if x]
        _overwrite_partitions(spark, spark.table(staging), table, partition_col, always)
    else:
        overwrite_from(spark, spark.table(staging), table)
    drop_table(spark, staging)  # of a taken-over folder only the name goes
    return True


def _literal(value: object) -> str:
    if isinstance(value, dt.date) and not isinstance(value, dt.datetime):
        return date_literal(value)
    return text_literal(value) if isinstance(value, str) else str(value)


def overwrite_partitions(
    spark: SparkSession, df: DataFrame, table: str, partition_col: str, always: Sequence[object] = ()
) -> None:
    """Replace the partitions that stored rows ``df`` have, and those named in ``always``, which may end up empty."""
    _overwrite_partitions(spark, df, table, partition_col, [_literal(v) for v in always])


def _overwrite_partitions(
    spark: SparkSession, df: DataFrame, table: str, partition_col: str, always: Sequence[str]
) -> None:
    rows = df.select(*spark.table(table).columns)
    if always:
        wanted = spark.range(1).selectExpr(f"explode(array({', '.join(always)})) AS value")
        have = rows.select(F.col(partition_col).alias("value")).distinct()
        for (value,) in wanted.distinct().join(have, "value", "left_anti").collect():
            spark.sql(f"ALTER TABLE {_quoted(table)} DROP IF EXISTS PARTITION (`{partition_col}` = {_literal(value)})")
    buckets = bucket_spec(spark, table)
    if buckets:
        rows = rows.repartition(buckets[0], *buckets[1])
    _insert(spark, rows, table, "dynamic")


def overwrite_from(spark: SparkSession, df: DataFrame, table: str) -> None:
    """INSERT OVERWRITE the whole table, by name, in any session's partition-overwrite mode."""
    _insert(spark, df.select(*spark.table(table).columns), table, "static")


def _insert(spark: SparkSession, df: DataFrame, table: str, mode: str) -> None:
    """INSERT OVERWRITE; Spark takes the mode from the session, where it is set for the time being."""
    name = "spark.sql.sources.partitionOverwriteMode"
    before = spark.conf.get(name)
    spark.conf.set(name, mode)
    try:
        df.write.insertInto(table, overwrite=True)
    finally:
        spark.conf.set(name, before)


def append_missing(spark: SparkSession, df: DataFrame, table: str, keys: Sequence[str], where: str = "true") -> None:
    """Append the rows whose key the table lacks, so that a repeated append adds nothing.

    ``where`` limits the part of the table that can hold such keys, best to one partition.
    """
    stored = spark.table(table).where(F.expr(where)).select(*keys)
    columns = spark.table(table).columns
    df.join(stored, list(keys), "left_anti").select(*columns).write.insertInto(table)


def merge_into(spark: SparkSession, changes: DataFrame, table: str, keys: Sequence[str]) -> None:
    """Row-level MERGE of whole rows, for catalogs that offer it; others refuse with an error."""
    on = None
    for k in keys:
        part = F.col(f"{table}.{k}") == F.col(f"changes.{k}")
        on = part if on is None else on & part
    changes.alias("changes").mergeInto(table, on).whenMatched().updateAll().whenNotMatched().insertAll().merge()
