"""The layered load: staging, processing, curated, data mart.

Each layer is a table, and each step reads the table of the layer before it. The customer column
lists here are the fixed schemas of the layers; the steps themselves work for any entity.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from dimkeeper.functions import email_org, parse_run_date
from dimkeeper.operators.clean import REJECTS, accepted_rows, normalise_checked, rejected_rows, union_parts
from dimkeeper.operators.merge import ACTIVE, merge_upsert, soft_delete_changes
from dimkeeper.plans.dimension_jobs import run_scd1, run_scd2, run_scd3, run_scd4
from dimkeeper.plans.ledger import Ledger, content_version
from dimkeeper.sources.parts import ensure_parted_table, merge_touched_parts, stored_rows
from dimkeeper.sources.scratch import materialised
from dimkeeper.sources.tables import (
    content_folder,
    drop_table,
    ensure_database,
    ensure_table,
    finish_replace,
    merge_into,
    save_table,
    set_table_property,
    staged_replace,
    table_property,
)

Step = Callable[[DataFrame], DataFrame]


@dataclass(frozen=True)
class Mart:
    """A mart table: what ``build`` makes of the curated rows and of ``inputs``, by name.

    An input is a frame, whose version follows from its rows, or a text that names its version. A
    run with a ledger builds the mart anew when the curated table or one of them has changed.
    """

    build: Step
    inputs: Mapping[str, DataFrame | str] = field(default_factory=dict)


def customer_columns() -> dict[str, Column]:
    """Fixed schema: processing-layer customer columns, from the staging columns."""
    return {
        "customer_id": F.col("customer_id"),
        "customer_name": F.col("full_name"),
        "customer_birth": F.col("date_of_birth"),
        "customer_hometown": F.col("hometown"),
        "customer_phone_num": F.col("phone_number"),
        "customer_email": F.col("email"),
        "customer_source": email_org("email"),
        "customer_gender": F.col("gender"),
    }


@dataclass(frozen=True)
class Layers:
    """Names of the four layer databases, and where to keep them (default: the warehouse)."""

    stg: str = "stg"
    prc: str = "prc"
    cur: str = "cur"
    dmt: str = "dmt"
    location: str | None = None

    def create(self, spark: SparkSession) -> None:
        for name in (self.stg, self.prc, self.cur, self.dmt):
            ensure_database(spark, name, f"{self.location}/{name}" if self.location else None)


def stamp_source(source: DataFrame, run_date: dt.date) -> DataFrame:
    """Staging rows: the source as it is, plus the run date."""
    return source.withColumn("etl_date", F.lit(run_date))


def conform(df: DataFrame, columns: Mapping[str, Column], run_date: dt.date) -> DataFrame:
    """Processing rows: renamed and derived columns, the activity flag and the run date."""
    return df.select(
        *[col.alias(name) for name, col in columns.items()],
        F.lit(ACTIVE).alias("is_active"),
        F.lit(run_date).alias("etl_date"),
    )


def active_rows(curated: DataFrame) -> DataFrame:
    """Mart dimension: the curated rows that are still active."""
    return curated.where(F.col("is_active") == ACTIVE)


def load_staging(spark: SparkSession, source: DataFrame, table: str, run_date: dt.date) -> None:
    save_table(spark, stamp_source(source, run_date), table, new_columns=True)


def load_processing(
    spark: SparkSession,
    staging_table: str,
    table: str,
    columns: Mapping[str, Column],
    run_date: dt.date,
    cleaning: Sequence[Step] = (),
) -> None:
    """Clean the staging rows (each step takes a frame and returns one), then conform them."""
    rows = reduce(lambda df, step: step(df), cleaning, spark.table(staging_table))
    save_table(spark, conform(rows, columns, run_date), table, new_columns=True)


def load_checked(
    spark: SparkSession,
    rows: DataFrame,
    table: str,
    reject_table: str,
    types: Mapping[str, str | tuple[str, str]],
    run_date: dt.date,
) -> dict[str, int]:
    """Text rows converted into ``table``; those that do not convert go to ``reject_table`` as they came.

    The rows are converted once, into a staged table that both are taken from, and counted on the way
    (an ``Observation``): returns how many came, were accepted and were rejected, and how often each
    column was the reason (``rejected by column``). A reject row says which columns, with text and reason.
    """
    counted = Observation()
    failed = F.size(REJECTS) > 0
    by_column = [
        F.count_if(F.array_contains(F.col(f"{REJECTS}.column"), c)).alias(f"rejected by {c}") for c in types if types[c] != "string"
    ]
    counts = [F.count(F.lit(1)).alias("rows"), F.count_if(~failed).alias("accepted"), F.count_if(failed).alias("rejected"), *by_column]
    with materialised(normalise_checked(rows, types).observe(counted, *counts)) as checked:
        save_table(spark, stamp_source(rejected_rows(checked), run_date), reject_table, new_columns=True)
        save_table(spark, accepted_rows(checked), table, new_columns=True)
    return counted.get


def load_curated(
    spark: SparkSession,
    processed: DataFrame,
    table: str,
    keys: Sequence[str],
    run_date: dt.date,
    publish: Callable[[DataFrame], None] | None = None,
    buckets: int = 0,
    row_level: bool = False,
    parts: int = 0,
) -> int:
    """Soft-delete merge into the curated table; returns the number of rows it had to write.

    The changes are evaluated once, into a table. Without changes nothing else is written. The
    merge itself then meets a small change set, not the whole source; with ``parts`` the table is
    divided by key and only the parts that the changes touch are read and rewritten; with
    ``row_level``, for catalogs that offer it, a MERGE writes the changed rows only. ``buckets`` (at least
    the number of shuffle partitions) keeps the stored side from being shuffled when it is compared. ``publish``
    gets the merged table, for example to copy it to a serving database; a change table left behind
    by a run that broke off makes the next run publish even if it finds nothing new.
    """
    changes = f"{table}__changes"
    if parts:
        if buckets or row_level:
            raise ValueError("a table in parts has neither buckets nor row-level operations")
        ensure_parted_table(spark, table, processed.schema, keys, parts)
    else:
        ensure_table(spark, table, processed.schema, bucket_by=list(keys) if buckets else [], buckets=buckets)
    finish_replace(spark, table)
    unfinished = spark.catalog.tableExists(changes)
    save_table(spark, soft_delete_changes(stored_rows(spark, table), processed, keys, run_date), changes, new_columns=True)
    n = spark.table(changes).count()
    if n and parts:
        merge_touched_parts(spark, spark.table(changes), table, keys)
    elif n and row_level:
        merge_into(spark, spark.table(changes), table, keys)
    elif n:
        merged = merge_upsert(spark.table(table), spark.table(changes), keys, check_keys=False)
        staged_replace(spark, merged, table)
    if publish is not None and (n or unfinished):
        publish(stored_rows(spark, table))
    drop_table(spark, changes)
    return n


def load_dimension(
    spark: SparkSession,
    processed: DataFrame,
    table: str,
    keys: Sequence[str],
    run_date: dt.date,
    kind: str = "soft_delete",
    previous: Mapping[str, str] | None = None,
    history: str | None = None,
    buckets: int = 0,
    row_level: bool = False,
    publish: Callable[[DataFrame], None] | None = None,
    parts: int = 0,
) -> int | None:
    """Load the curated table as ``soft_delete`` or as ``scd1`` to ``scd4``.

    The slowly changing kinds date the rows themselves, so the processed activity flag and date stay
    out. Returns the rows written where that is known, 0 where nothing changed; None otherwise. ``publish``
    gets the table when it has changed.
    """
    if kind == "soft_delete":
        return load_curated(spark, processed, table, keys, run_date, publish, buckets, row_level, parts)
    snapshot = processed.drop("is_active", "etl_date")
    changed = True  # types 1 and 3 stamp every row with the run date
    if kind == "scd1":
        run_scd1(spark, snapshot, table, keys, run_date)
    elif kind == "scd2":
        changed = run_scd2(spark, snapshot, table, keys, run_date, buckets=buckets)
    elif kind == "scd3":
        run_scd3(spark, snapshot, table, keys, previous or {}, run_date)
    elif kind == "scd4":
        changed = run_scd4(spark, snapshot, table, history or f"{table}_his", keys, run_date)
    else:
        raise ValueError(f"unknown kind of dimension: {kind!r}")
    if publish is not None and changed:
        publish(spark.table(table))
    return None if changed else 0


def load_mart(spark: SparkSession, curated_table: str, table: str, build: Step = active_rows) -> None:
    """The mart table anew: by default the active rows, or whatever ``build`` makes of the curated table."""
    save_table(spark, build(stored_rows(spark, curated_table)), table, new_columns=True)


def run_layers(
    spark: SparkSession,
    source: DataFrame | Mapping[str, DataFrame],
    run_date: dt.date | int | None = None,
    layers: Layers = Layers(),
    keys: Sequence[str] = ("customer_id",),
    columns: Mapping[str, Column] | Mapping[str, Mapping[str, Column]] | None = None,
    entity: str = "customer",
    cleaning: Sequence[Step] = (),
    kind: str = "soft_delete",
    previous: Mapping[str, str] | None = None,
    marts: Mapping[str, Step | Mart] | None = None,
    publish: Callable[[DataFrame], None] | None = None,
    buckets: int = 0,
    row_level: bool = False,
    parts: int = 0,
    ledger: Ledger | None = None,
    versions: Mapping[str, str] | None = None,
) -> DataFrame:
    """One run of all four layers, in order; returns the dimension's mart table.

    ``source`` may be several parts by name; each has its own staging and processing table, with its
    ``columns`` by the same name, and their union is loaded. ``cleaning`` steps run on the staging
    rows, ``kind`` says how the curated table keeps its rows, ``marts`` adds mart tables built from
    it, and ``publish`` gets it when it has changed.

    Without a ``ledger`` every step runs; only the dimension's own mart stays as it is where it was built from the
    very content that the curated table still has. With one, a step runs unless it was done on
    the same inputs: a run that broke off goes on at the step that failed, a day without changes leaves
    the marts as they are, and one on which only a mart's other inputs changed (see ``Mart``) builds that
    mart. A mart given as a plain step may read anything and is built every time. ``versions`` names the
    sources' versions where they are known; otherwise they follow from the rows, by one more pass.
    """
    day = parse_run_date(run_date)
    layers.create(spark)
    sources = dict(source) if isinstance(source, Mapping) else {entity: source}

    def step(name: str, inputs: Mapping[str, object], action: Callable[[], object]) -> str:
        if ledger is None:
            action()
            return ""
        return ledger.step(name, day, inputs, action)

    def version(given: DataFrame | str) -> str:
        return given if isinstance(given, str) else content_version(given)

    prepared, processed = {}, []
    for name, frame in sources.items():
        wanted = customer_columns() if columns is None else columns[name] if isinstance(source, Mapping) else columns
        stg, prc = f"{layers.stg}.{name}", f"{layers.prc}.{name}"
        known = {"day": day, "source": version((versions or {}).get(name, frame))} if ledger else {}
        staged = step(f"stg.{name}", known, lambda: load_staging(spark, frame, stg, day))  # noqa: B023
        prepared[name] = step(f"prc.{name}", {"day": day, "stg": staged}, lambda: load_processing(spark, stg, prc, wanted, day, cleaning))  # noqa: B023
        processed.append(prc)

    cur = f"{layers.cur}.{entity}"

    def curate() -> bool:
        rows = union_parts([spark.table(prc) for prc in processed])
        return load_dimension(spark, rows, cur, keys, day, kind, previous, None, buckets, row_level, publish, parts) != 0

    curated = step(f"cur.{entity}", {"day": day, "kind": kind, **prepared}, curate)
    own = Mart(active_rows if kind == "soft_delete" else (lambda df: df))
    for name, mart in {f"{entity}_dim": own, **(marts or {})}.items():
        known = {"cur": curated}
        if ledger and isinstance(mart, Mart):
            known |= {f"input {n}": version(given) for n, given in mart.inputs.items()}
        elif ledger:
            known["any"] = uuid.uuid4().hex
        table = f"{layers.dmt}.{name}"
        content = content_folder(spark, cur) if mart is own and ledger is None else None
        if content and spark.catalog.tableExists(table) and table_property(spark, table, "built_from") == content:
            continue
        build = mart.build if isinstance(mart, Mart) else mart
        step(f"dmt.{name}", known, lambda: load_mart(spark, cur, table, build))  # noqa: B023
        if content:
            set_table_property(spark, table, "built_from", content)
    return spark.table(f"{layers.dmt}.{entity}_dim")
