"""What has been run on what, so that a broken or repeated run does again only what it has to.

Each step of a run is recorded when it begins and when it is done, with the versions of its inputs
and a label of its code. A step is left out only if its last record is that it was done on the very
same inputs by the same code. What a step makes has a version of its own, which later steps take as
an input; it stays the same when the step says that it changed nothing.
"""

from __future__ import annotations

import datetime as dt
import json
import uuid
from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dimkeeper.functions.hashes import hash_sums
from dimkeeper.sources.tables import ensure_table

RUNNING, DONE = "running", "done"
_TEXTS = ("state", "inputs", "code", "version")
SCHEMA = T.StructType(
    [
        T.StructField("seq", T.LongType()),
        T.StructField("step", T.StringType()),
        T.StructField("run_date", T.DateType()),
        *[T.StructField(name, T.StringType()) for name in _TEXTS],
        T.StructField("recorded_at", T.TimestampType()),
    ]
)


def content_version(df: DataFrame) -> str:
    """A version that follows from the rows alone, whatever their order; one pass, three numbers to the driver."""
    row = df.select(*[F.expr(x) for x in hash_sums(df)]).first()
    return ":".join(str(x) for x in row)


class Ledger:
    """The records of one pipeline; ``code`` names the version of its code."""

    def __init__(self, spark: SparkSession, table: str, code: str = "") -> None:
        self.spark, self.table, self.code = spark, table, code
        self.ran: list[str] = []
        self.skipped: list[str] = []
        ensure_table(spark, table, SCHEMA)
        record = F.struct("seq", "state", "inputs", "code", "version")
        latest = spark.table(table).groupBy("step").agg(F.max_by(record, "seq").alias("last")).collect()
        self._last = {r["step"]: r["last"].asDict() for r in latest}  # one row for each step
        self._seq = max((r["seq"] for r in self._last.values()), default=0)

    def _write(self, step: str, run_date: dt.date, state: str, inputs: str, version: str | None) -> None:
        self._seq += 1
        row = (self._seq, step, run_date, state, inputs, self.code, version, dt.datetime.now(dt.timezone.utc))
        self.spark.createDataFrame([row], SCHEMA).coalesce(1).write.insertInto(self.table)
        self._last[step] = {"seq": self._seq, "state": state, "inputs": inputs, "code": self.code, "version": version}

    def version(self, step: str) -> str | None:
        """Of what the step has made last; None if it has made nothing or broke off."""
        last = self._last.get(step)
        return last["version"] if last and last["state"] == DONE else None

    def step(self, name: str, run_date: dt.date, inputs: Mapping[str, object], action: Callable[[], object]) -> str:
        """Run ``action`` unless it is up to date; returns the version of what it makes.

        An action that returns False has changed nothing. One that raises leaves the step open, so that
        the next run does it again, whatever its inputs then are.
        """
        wanted = json.dumps(inputs, sort_keys=True, default=str)
        last = self._last.get(name)
        done = last is not None and last["state"] == DONE
        if done and last["inputs"] == wanted and last["code"] == self.code:
            self.skipped.append(name)
            return last["version"]
        self._write(name, run_date, RUNNING, wanted, None)
        changed = action()
        version = last["version"] if changed is False and done else uuid.uuid4().hex
        self._write(name, run_date, DONE, wanted, version)
        self.ran.append(name)
        return version
