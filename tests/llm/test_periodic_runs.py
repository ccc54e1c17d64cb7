"""Periodic runs against a plain version that compares every word at every lag."""

from __future__ import annotations

import hashlib
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from dimkeeper.llm import periodic_runs as pr
from dimkeeper.llm import queries

SCHEMA = "doc_id long, text string"


def plain_runs(words, shortest=12):
    found = {}
    for q in range(1, len(words) // 2 + 1):
        i = 0
        while i < len(words) - q:
            j = i
            while j < len(words) - q and words[j] == words[j + q]:
                j += 1
            if j > i and j - i + q >= max(shortest, 2 * q):
                found.setdefault((i, j - i + q), q)
            i = max(j, i + 1)
    return sorted((s, n, q) for (s, n), q in found.items())


def collapsed(words, runs):
    gone = {k for s, n, q in runs for k in range(s + q, s + n)}
    return b" ".join(w for k, w in enumerate(words) if k not in gone).decode()


def some_words(rng):
    words = [rng.choice("é ab ß x yy zzz".split())[: rng.randrange(1, 4)] + str(rng.randrange(rng.choice([1, 2, 40]))) for _ in range(rng.randrange(0, 130))]
    for _ in range(rng.randrange(3)):
        if len(words) > 5:
            a, p = rng.randrange(len(words)), rng.randrange(1, len(words) // 2 + 1)
            for i in range(a, min(len(words), a + rng.randrange(80))):
                words[i] = words[a + (i - a) % p]
    return words


def corpus():
    rng = random.Random(11)
    docs = [(i, rng.choice([" ", "\n", " \t "]).join(some_words(rng))) for i in range(200)]
    docs += [(1000, None), (1001, ""), (1002, " \n"), (1003, "one"), (1004, "la " * 500), (1005, "a b " * 11 + "a"), (1006, "a b c " * 3), (1006, "a b c d " * 3), (None, "x " * 12)]
    return docs + [(1007, " ".join(["w" * 3000, "v" * 3000] * 200))]  # longer than a chunk


@pytest.mark.parametrize("rounds", [6, 0])  # 0: every segment is split from its ends
def test_runs_and_what_is_kept(spark, rounds, monkeypatch):
    monkeypatch.setattr(pr, "_ROUNDS", rounds)
    docs = corpus()
    rows = spark.createDataFrame(docs, SCHEMA).select("*", *(F.lit("own").alias(c) for c in ("n_words", "runs", "kept", "start"))).repartition(4)
    found = [(r["doc_id"], r["n_words"], [tuple(x) for x in r["runs"]], r["kept"]) for r in pr.find_runs(rows).collect()]
    expected = []
    for i, text in docs:
        words = (text or "").encode().split()
        runs = plain_runs(words) if len(words) < 450 else [(0, len(words), len(set(words)))]
        expected.append((i, len(words), runs, collapsed(words, runs)))
    order = lambda rows: sorted(rows, key=str)
    assert order(found) == order(expected)


def test_empty_table_and_other_shortest(spark):
    assert pr.find_runs(spark.createDataFrame([], SCHEMA)).collect() == []
    words = "a b a b c c c d".split()
    row = pr.find_runs(spark.createDataFrame([(1, " ".join(words))], SCHEMA), shortest=3).first()
    assert [tuple(x) for x in row["runs"]] == plain_runs(words, 3)
    with pytest.raises(ValueError):
        pr.find_runs(spark.createDataFrame([], SCHEMA), shortest=1)


def test_lag_scan_of_few_words_is_exact_and_splitting_ends(spark):
    rng = np.random.default_rng(5)
    for n in (24, 257, 1500):
        names = rng.integers(0, 2, n)
        assert [tuple(x) for x in pr.lag_scan(names, 12).tolist()] == plain_runs(names.tolist())
    peel = np.empty(40_000, np.int64)  # one word after the other comes to stand alone
    peel[0::2], peel[1::2] = np.arange(20_000) + 1, np.arange(20_000)
    before, after = pr.neighbours(peel, np.zeros(len(peel), np.int64))
    assert pr.stable_segments(np.array([0, len(peel)]), before, after, 12) == []


def test_the_query_folds_one_text_in_ten(spark, tmp_path):
    docs = [(i, t) for i, t in corpus() if i is not None and i != 1006]
    spark.createDataFrame(docs, SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    found = {r["doc_id"]: r for r in queries.q_op11_periodic_runs(spark, str(tmp_path)).collect()}
    folded = 0
    for i, text in docs:
        words = (text or "").encode().split()
        h, n = zlib.crc32(str(i).encode()), len(words)
        g = h // 10
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words, folded = [words[k if k < a else a + (k - a) % p] for k in range(n)], folded + 1
        runs = plain_runs(words) if n < 450 else [(0, n, len(set(words)))]
        best = max(runs, key=lambda r: (r[1], -r[0], -r[2]), default=(None, None, None))
        row = found[i]
        assert (row["n_runs"], row["start"], row["length"], row["period"]) == (len(runs), *best)
        assert row["exponent_milli"] == (1000 * best[1] // best[2] if runs else None)
        assert row["collapsed_sha256"] == hashlib.sha256(collapsed(words, runs).encode()).hexdigest()
    assert folded > 10 and len(found) == len(docs)
