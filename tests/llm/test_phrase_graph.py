"""Collocations against counts of every stretch of words."""

from __future__ import annotations

import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from dimkeeper.llm import phrase_graph as pg

SCHEMA = "doc_id long, lang string, text string"


def counts(docs):
    """By language: all stretches of 1 to 4 words within pieces, and the number of words."""
    found, n = {}, Counter()
    for _, lang, text in docs:
        for piece in re.split(rb"[.,;:!?\x0A-\x0D]", (text or "").encode().lower()):
            words = re.findall(rb"[^\x20\x09]+", piece)
            lang = lang or "und" if lang is None else lang
            n[lang] += len(words)
            of = found.setdefault(lang, Counter())
            for k in range(1, 5):
                of.update(tuple(words[i : i + k]) for i in range(len(words) - k + 1))
    return found, n


def plain(docs, least, top, covered=80):
    out = []
    found, n = counts(docs)
    for lang, f in found.items():
        candidates = {p: c for p, c in f.items() if len(p) > 1 and c >= least}
        ranked = []
        for p, a in candidates.items():
            inside = lambda q: any(q[i : i + len(p)] == p for i in range(len(q) - len(p) + 1))  # noqa: B023, E731
            if any(len(q) > len(p) and 100 * c >= covered * a and inside(q) for q, c in candidates.items()):
                continue
            score, _, left, right = min((2000000 * a // (f[p[:k]] + f[p[k:]]), k, f[p[:k]], f[p[k:]]) for k in range(1, len(p)))
            ranked.append((-score, -a, b" ".join(p), left, right))
        for rank, (score, a, p, left, right) in enumerate(sorted(ranked)[:top], 1):
            out.append((lang, rank, p.decode(), -a, left, right, n[lang], -score))
    return sorted(out)


def corpus(seed=5, n=300):
    rng = random.Random(seed)
    words = ["the", "of", "é", "Ä", "a-b", "x'y", "\x0bq", "I", "i"] + [f"w{k}" for k in range(12)]
    lines = [" ".join(rng.choice(words) for _ in range(rng.randrange(3, 14))) for _ in range(6)]
    docs = []
    for i in range(n):
        pieces = [rng.choice(lines) if rng.random() < 0.4 else " ".join(rng.choice(words) for _ in range(rng.randrange(0, 9))) for _ in range(rng.randrange(0, 9))]
        docs.append((i, rng.choice(["en", "en", "en", "de", None, "und", ""]), rng.choice([". ", "\n", "; ", " ,"]).join(pieces)))
    docs += [(1, "en", None), (1, "en", ""), (None, "en", lines[0]), (7, "en", lines[1]), (7, "en", lines[1]), (8, "fr", "one"), (9, "xx", "a\ta  a " * 100), (10, "yy", " . ,;\t")]
    return docs


def rows_of(frame, **options):
    return sorted(tuple(r)[:8] for r in pg.mine_phrases(frame, **options).collect())


@pytest.mark.parametrize(("least", "top", "covered"), [(5, 2000, 80), (30, 7, 80), (2, 40, 50)])
def test_phrases(spark, monkeypatch, least, top, covered):
    monkeypatch.setattr(pg, "FLUSH", 500)  # seen by the driver's own tasks only; the results do not depend on it
    docs = corpus()
    frame = spark.createDataFrame(docs, SCHEMA).select("*", *(F.lit("own").alias(c) for c in ("phrase", "f", "n", "bucket", "words"))).repartition(6)
    assert rows_of(frame, least=least, top=top, covered=covered) == plain(docs, least, top, covered)


def test_all_shorter_counts_follow_from_the_flow(spark):
    docs = corpus(9)
    found = pg.phrase_counts(spark.createDataFrame(docs, SCHEMA).repartition(5), 1, "text", "lang").collect()
    expected, n = counts(docs)
    plain = {(lang, b" ".join(p).decode(), len(p)): c for lang, of in expected.items() for p, c in of.items()}
    plain |= {(lang, "", 0): c for lang, c in n.items() if c}
    assert {(r["lang"], r["phrase"], r["words"]): r["f"] for r in found} == plain


def test_empty_table_and_long_text(spark):
    assert rows_of(spark.createDataFrame([], SCHEMA)) == []
    long = [(1, "en", "alpha beta gamma delta. " * 120_000)]  # over a chunk, and over a flush
    found = rows_of(spark.createDataFrame(long, SCHEMA))
    assert found == [("en", 1, "alpha beta gamma delta", 120_000, 120_000, 120_000, 480_000, 1_000_000)]


def test_unary_paths(spark):
    fixed, other = "all rights are reserved by the owner of this text", "all rights are gone"
    docs = [(i, "en", f"{fixed}. {other}") for i in range(40)] + [(50 + i, "en", "rights are reserved by the king") for i in range(40)]
    paths = {r["phrase"]: r["path"] for r in pg.mine_phrases(spark.createDataFrame(docs, SCHEMA)).collect()}
    assert paths["the owner of this"] == "reserved by the owner of this text"  # "reserved by the" leads to the king too
    assert all(p in path for p, path in paths.items())
    alone = [(i, "en", fixed) for i in range(40)]
    found = pg.mine_phrases(spark.createDataFrame(alone, SCHEMA)).collect()
    assert len(found) == 7 and {r["path"] for r in found} == {fixed}
