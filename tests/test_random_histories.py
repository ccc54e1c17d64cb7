"""Random histories of many keys over six days, against a plain per-key model.

Each key may be absent or present on a day, with two attributes that are NULL or one of two values,
so that all sequences of insert, change, NULL change, delete and return occur.
"""

from __future__ import annotations

import datetime as dt
import random

import pytest

from dimkeeper.functions import OPEN_END
from dimkeeper.operators.diff import snapshot_diff
from dimkeeper.operators.merge import apply_changes, merge_soft_delete
from dimkeeper.operators.scd import open_versions, scd1, scd2, scd3, scd4
from dimkeeper.sources.scratch import materialise

SCHEMA = "k int, a string, b string"
KEYS = ["k"]
DAYS = [dt.date(2025, 1, 1) + dt.timedelta(days=i) for i in range(6)]


@pytest.fixture(scope="module")
def histories():
    rng = random.Random(11)
    values = [None, "x", "y"]

    def day():
        return None if rng.random() < 0.3 else (rng.choice(values), rng.choice(values))

    return {k: [day() for _ in DAYS] for k in range(600)}


@pytest.fixture(scope="module")
def snapshots(spark, histories):
    out = []
    for i in range(len(DAYS)):
        data = [(k, *h[i]) for k, h in histories.items() if h[i] is not None]
        out.append(materialise(spark.createDataFrame(data, SCHEMA)))
    return out


def run(spark, step, technical, snapshots):
    state = spark.createDataFrame([], f"{SCHEMA}, {technical}")
    for day, snapshot in zip(DAYS, snapshots):
        state = materialise(step(state, snapshot, day))
    return state


def as_set(df, *cols):
    got = [tuple(r) for r in df.select(*cols).collect()]
    assert len(got) == len(set(got))
    return set(got)


def present(history):
    return [(day, v) for day, v in zip(DAYS, history) if v is not None]


def test_scd1(spark, histories, snapshots):
    state = run(spark, lambda t, s, d: scd1(t, s, KEYS, d), "etl_date date", snapshots)
    model = {(k, *present(h)[-1][1], DAYS[-1]) for k, h in histories.items() if present(h)}
    assert as_set(state, "k", "a", "b", "etl_date") == model


def test_scd2(spark, histories, snapshots):
    state = run(spark, lambda t, s, d: scd2(t, s, KEYS, d), "start_date date, end_date date, etl_date date", snapshots)
    model = set()
    for k, history in histories.items():
        begun = None
        for day, value in [*zip(DAYS, history), (OPEN_END, "end")]:
            if begun and value != begun[1]:
                written = begun[0] if day == OPEN_END else day
                model.add((k, *begun[1], begun[0], day, written))
                begun = None
            if value is not None and begun is None and day != OPEN_END:
                begun = (day, value)
    assert as_set(state, "k", "a", "b", "start_date", "end_date", "etl_date") == model
    assert as_set(open_versions(state), "k", "a", "b") == as_set(snapshots[-1], "k", "a", "b")
    # As of each day the dimension shows that day's snapshot.
    for day, snapshot in zip(DAYS, snapshots):
        then = state.where(f"start_date <= DATE'{day}' AND DATE'{day}' < end_date")
        assert as_set(then, "k", "a", "b") == as_set(snapshot, "k", "a", "b")


def test_scd3(spark, histories, snapshots):
    previous = {"a": "pre_a", "b": "pre_b"}
    state = run(
        spark, lambda t, s, d: scd3(t, s, KEYS, d, previous), "pre_a string, pre_b string, etl_date date", snapshots
    )

    def before(seq):
        changes = [old for old, new in zip(seq, seq[1:]) if old != new]
        return changes[-1] if changes else None

    model = set()
    for k, history in histories.items():
        seen = [v for _, v in present(history)]
        if seen:
            model.add((k, *seen[-1], before([v[0] for v in seen]), before([v[1] for v in seen]), DAYS[-1]))
    assert as_set(state, "k", "a", "b", "pre_a", "pre_b", "etl_date") == model


def test_scd4(spark, histories, snapshots):
    archived = []

    def step(target, source, day):
        current, archive = scd4(target, source, KEYS, day)
        archived.append(archive)
        return current

    current = run(spark, step, "etl_date date", snapshots)
    now, past = set(), set()
    for k, history in histories.items():
        held = None
        for day, value in present(history):
            if held and held[1] != value:
                past.add((k, *held[1], held[0], day))
            if held is None or held[1] != value:
                held = (day, value)
        if held:
            now.add((k, *held[1], held[0]))
    assert as_set(current, "k", "a", "b", "etl_date") == now
    got = set()
    for archive in archived:
        got |= as_set(archive, "k", "a", "b", "start_date", "end_date")
    assert got == past


def test_merge_soft_delete(spark, histories, snapshots):
    state = run(
        spark, lambda t, s, d: merge_soft_delete(t, s, KEYS, d), "is_active string, etl_date date", snapshots
    )
    model = set()
    for k, history in histories.items():
        row = None
        for day, value in zip(DAYS, history):
            if value is not None and (row is None or row[:2] != (value, "1")):
                row = (value, "1", day)
            elif value is None and row is not None and row[1] == "1":
                row = (row[0], "0", day)
        if row:
            model.add((k, *row[0], row[1], row[2]))
    assert as_set(state, "k", "a", "b", "is_active", "etl_date") == model


def test_feeds_lead_from_the_first_to_the_last_snapshot(spark, snapshots):
    state = snapshots[0]
    for old, new in zip(snapshots, snapshots[1:]):
        state = materialise(apply_changes(state, snapshot_diff(old, new, KEYS), KEYS))
        assert as_set(state, "k", "a", "b") == as_set(new, "k", "a", "b")
