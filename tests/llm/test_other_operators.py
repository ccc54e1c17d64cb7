"""Quality, mixing, pages, embeddings, conversations, and the pipeline."""

from __future__ import annotations

import random
import re
from collections import Counter
from html.parser import HTMLParser

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from dimkeeper.llm import html_text, mixing, neighbour_graph, preference, queries, quality
from dimkeeper.llm.components import components
from tests.llm import brute

SF = "/root/testdata/sf0.001"


def test_components(spark):
    rng = random.Random(1)
    links = [(k, k + 1) for k in range(0, 60)] + [(rng.randrange(100, 200), rng.randrange(100, 200)) for _ in range(60)] + [(300, 300)]
    rows = components(spark.createDataFrame(links, "a long, b long")).collect()
    nodes = {x for pair in links if pair[0] != pair[1] for x in pair}
    assert {r["node"]: r["component"] for r in rows} == brute.components(nodes, links[:-1])
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


# --- quality -----------------------------------------------------------------------------------------------


def test_resample_prefers_target_text_and_takes_a_share(spark):
    rng = random.Random(4)
    good, bad = [f"good{k}" for k in range(50)], [f"bad{k}!!" for k in range(50)]
    docs = [(i, " ".join(rng.choices(bad if i % 5 == 0 else good, k=40))) for i in range(500)]
    labels = [(i, int(i % 5 != 0), 0) for i in range(0, 500, 3)] + [(1, None, None), (None, 1, 0)]
    rows = quality.resample(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")).collect()
    # The cut comes from some 27 rows held out; a share of 0.025 of them, at worst about their least, lies below it.
    assert 360 <= sum(r["selected"] for r in rows) <= 400
    assert not any(r["selected"] for r in rows if r["doc_id"] % 5 == 0)
    half = quality.resample(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, quality int, toxic int"), keep=0.5)
    assert 250 <= half.where("selected").count() <= 260


def test_resample_edges(spark):
    docs = spark.createDataFrame([(1, "a b"), (1, "a b"), (2, None), (3, ""), (None, "a")], "doc_id long, text string").withColumn("weight", F.lit("own"))
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    rows = quality.resample(docs, none).collect()
    assert sorted((r["doc_id"] or 0, r["selected"]) for r in rows) == [(0, True), (1, True), (1, True), (2, False), (3, False)]
    assert quality.resample(docs.where("false"), none).count() == 0


@pytest.mark.parametrize("few", [5, 10_000])
def test_kth_largest(spark, monkeypatch, few):
    monkeypatch.setattr(quality, "FEW", few)
    keys = [1.5, 1.5, -3.0, 7.25, 0.0, None] + [float(k % 40) for k in range(300)]
    frame = spark.createDataFrame([(k,) for k in keys], "key double")
    ordered = sorted((k for k in keys if k is not None), reverse=True)
    for k in (1, 2, 9, 150, 304):
        assert quality.kth_largest(frame, k) == ordered[k - 1]
    assert quality.kth_largest(frame, 305) == float("-inf")


def test_resample_on_held_out_labels(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    odd = labels.where("doc_id % 2 = 1").selectExpr("doc_id", "CASE WHEN quality = 0 THEN 0 WHEN toxic = 0 THEN 1 END AS q").where("q IS NOT NULL")
    found = quality.resample(docs, labels.where("doc_id % 2 = 0")).join(odd, "doc_id").groupBy("q", "selected").count().collect()
    n = {(r["q"], r["selected"]): r["count"] for r in found}
    assert n[1, True] >= 0.9 * sum(v for (q, _), v in n.items() if q == 1)  # some 160 good rows to learn from
    assert n[0, False] >= 0.7 * sum(v for (q, _), v in n.items() if q == 0)


def test_resample_rejects_poor_and_toxic_rows_that_it_has_not_seen(spark):
    """Of the labels one half trains the model, the other judges it."""
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    odd = labels.where("doc_id % 2 = 1").selectExpr("doc_id", "quality AS q", "toxic AS t")
    found = quality.resample(docs, labels.where("doc_id % 2 = 0")).join(odd, "doc_id")
    n = {(r["q"], r["t"], r["selected"]): r["count"] for r in found.groupBy("q", "t", "selected").count().collect()}
    share = lambda keep, of: sum(v for k, v in n.items() if of(k) and k[2] == keep) / sum(v for k, v in n.items() if of(k))
    assert share(False, lambda k: k[0] == 0) >= 0.9
    assert share(False, lambda k: k[1] == 1) >= 0.88  # one toxic row in eight has no word that good text lacks
    assert share(False, lambda k: k[0] == 1 and k[1] == 0) <= 0.035


# --- mixing ------------------------------------------------------------------------------------------------


def raked(cells, targets, total, rounds=12):
    weight = {c: float(n) for c, n in cells.items() if n > 0}
    for _ in range(rounds):
        for k, target in enumerate(targets):
            there = {c[k] for c in weight}
            whole = sum(v for t, v in target.items() if t in there)
            have = {}
            for c, w in weight.items():
                have[c[k]] = have.get(c[k], 0.0) + w
            weight = {c: w * total * target.get(c[k], 0.0) / whole / have[c[k]] if have[c[k]] else 0.0 for c, w in weight.items()}
    return weight


def test_mixing_equals_plain_fitting_and_meets_its_targets(spark):
    rng = random.Random(2)
    docs = [(i, " ".join(["w"] * rng.randrange(1, 60)), rng.choice(["a", "b", None]), rng.choice(["en", "de"]), rng.choice(["x", "y"])) for i in range(3000)]
    frame = spark.createDataFrame(docs, "doc_id long, text string, source string, lang string, kind string").withColumn("factor", F.lit("own"))
    targets = {"source": {"a": 3.0, "b": 1.0, "gone": 5.0}, "lang": {"en": 0.2, "de": 0.8}}
    rows = mixing.mix_sources(frame, targets, power=0.5, topic="kind").collect()
    cells, topics = {}, {}
    for _, text, source, lang, kind in docs:
        n = len(text.split())
        cells[source, lang, kind] = cells.get((source, lang, kind), 0) + n
        topics[kind] = topics.get(kind, 0) + n
    total = sum(cells.values())
    want = raked(cells, [targets["source"], targets["lang"], {k: v**0.5 for k, v in topics.items()}], total)
    for r in rows:
        cell = (r["source"], r["lang"], r["topic"])
        assert r["factor"] == pytest.approx(want[cell] / cells[cell], rel=1e-6, abs=1e-12)
        assert abs(r["copies"] - r["factor"]) < 1
    drawn = sum(r["copies"] * r["n_tokens"] for r in rows if r["source"] == "a")
    assert drawn == pytest.approx(0.75 * total, rel=0.05)
    assert not any(r["copies"] for r in rows if r["source"] is None)


def test_mixing_says_when_targets_cannot_be_met(spark):
    docs = [(i, "w w", "ab"[i % 2], "xy"[i % 2]) for i in range(40)]  # source and language always go together
    frame = spark.createDataFrame(docs, "doc_id long, text string, source string, lang string")
    against = {"source": {"a": 0.5, "b": 0.5}, "lang": {"x": 0.9, "y": 0.1}}
    with pytest.warns(UserWarning, match="cannot be met together"):
        mixing.mix_sources(frame, against).count()
    with pytest.raises(ValueError, match="source by"):
        mixing.mix_sources(frame, against, strict=True)
    slow = [(i, "w " * (1 + (i * 37) % 50), "abc"[i % 3], "xyz"[(i // 3) % 3] if i % 11 else "x") for i in range(400)]
    frame = spark.createDataFrame(slow, "doc_id long, text string, source string, lang string")
    wanted = {"source": {"a": 0.8, "b": 0.15, "c": 0.05}, "lang": {"x": 0.05, "y": 0.05, "z": 0.9}}
    rows = mixing.mix_sources(frame, wanted, tolerance=1e-6, strict=True).collect()
    total = sum(r["n_tokens"] for r in rows)
    for margin, targets in wanted.items():
        for value, share in targets.items():
            assert sum(r["factor"] * r["n_tokens"] for r in rows if r[margin] == value) == pytest.approx(share * total, rel=1e-5)


def test_mixing_edges(spark):
    schema = "doc_id long, text string, source string, lang string"
    rows = [(1, None, None, None), (1, None, None, None), (2, "", "a", "en"), (None, "a b", "a", "en")]
    assert mixing.mix_sources(spark.createDataFrame(rows, schema)).count() == 4
    assert mixing.mix_sources(spark.createDataFrame([], schema)).count() == 0
    words = ["a b", " a\tb\n", "", None, "  ", "ä b c"]
    frame = spark.createDataFrame([(w,) for w in words], "t string")
    assert [r[0] for r in frame.select(mixing.n_tokens(F.col("t"))).collect()] == [len((w or "").encode().split()) for w in words]


# --- pages -------------------------------------------------------------------------------------------------


@pytest.mark.parametrize(
    ("page", "text"),
    [
        ("<p>One <b>two</b><p>Three<ul><li>a<li>b<ol start=3><li>x<li>y</ol><li>c</ul>", "One two\n\nThree\n\n- a\n- b\n  3. x\n  4. y\n- c"),
        ("<table><tr><td>1<td>long cell<tr><th>22<td>z</table>", "1  | long cell\n22 | z"),
        ("<table><tr><td>a<table><tr><td>in<td>ner</table><td>b</table>c", "a        | b\nin | ner\n\nc"),
        ("<table><tr><td><p>one<p>two<ul><li>a<li>b</ul><td>z</table>", "one | z\ntwo\n- a\n- b"),
        ("<table><tr><td>x<td><pre>1\n  2</pre><tr><td>yy<td>3</table>", "x  | 1\n   |   2\nyy | 3"),
        ("<table><tr><td rowspan=2>a<td>b<tr><td>c<tr><td>d</table>", "a | b\n  | c\nd"),
        ("<table><tr><td colspan=2>wide title<td>x<tr><td>1<td>2<td>3</table>", "wide title | x\n1 | 2      | 3"),
        ("<table><tr><td colspan=100>a<td>b<tr><td rowspan=0>c<td>d<tr><td>e</table>", "a     | b\nc | d\n  | e"),
        (f"<table><tr><td>{'x' * 45}<td>z<tr><td>k<td>y</table>", f"{'x' * 45} | z\n{'k'.ljust(45)} | y"),
        (f"<table><tr><td>nav<td>{'word ' * 40}<tr><td>k<td>y</table>", "nav\n" + ("word " * 40).strip() + "\nk\ny"),
        ("<svg><title>t</title><text>dr<tspan>awn</tspan></text><desc>d</desc>no</svg>x<math><mi>a</mi><mo>+</mo></math>", "drawn\nxa+"),
        ("a <select><optgroup><option>b<option selected>c</optgroup></select> d<select multiple><option>e<option>f</select>", "a c d e\nf"),
        ("<object>shown</object><object data=x>not</object><details><summary>s</summary>not</details><details open><summary>t</summary>u</details>", "shown\ns\nt\nu"),
        ("<div style='visibility: hidden'>not<b style='x:y;visibility:visible'>yes<i style=visibility:hidden>not</i></b></div><dialog>not</dialog><dialog open>d</dialog>", "yes\nd"),
        ("<input value=v><input type=checkbox value=not><input type=submit value=go><meter>not</meter>", "v go"),
        ("<div>a</div><div style='display: none'>b</div><i hidden>c</i><script>'</p>'</script><!-- d -->e", "a\ne"),
        ("<pre>a\n  b\n\nc</pre>d", "a\n  b\n\nc\n\nd"),
        ("a &lt; b < c &amp; d<br>e<br><br>f", "a < b < c & d\ne\n\nf"),
        ("<head><title>T</title><style>x</style></head>body</b></div><p>", "body"),
        ("<blockquote>q<p>r</blockquote><hr>x", "  q\n\n  r\n\n---\nx"),
        ("<ul><li><p>a<p>b</ul>", "- a\n\n  b"),
        ("", ""),
        ("<a href='x", "<a href='x"),
    ],
)
def test_pages(page, text):
    assert html_text.render(html_text.parse(page))[1] == text


class Seen(HTMLParser):
    """A plain reading of well-formed pages: all words outside of what is hidden, in order."""

    def __init__(self):
        super().__init__()
        self.words, self.hidden = [], []

    def handle_starttag(self, tag, attrs):
        if self.hidden or tag in ("script", "style", "noscript", "template") or "hidden" in dict(attrs) or "none" in (dict(attrs).get("style") or ""):
            self.hidden.append(tag)

    def handle_endtag(self, tag):
        if self.hidden:
            self.hidden.pop()

    def handle_data(self, data):
        if not self.hidden:
            self.words += data.split()


def random_page(rng, depth=0):
    if depth > 4 or rng.random() < 0.25:
        return " ".join(rng.choice(["w&amp;", "é", "x y", "&lt;b&gt;", "12", "long" * 5]) + str(rng.randrange(99)) for _ in range(rng.randrange(1, 6)))
    inner = lambda: random_page(rng, depth + 1)
    kind = rng.choice(["div", "p", "span", "ul", "table", "hide", "script", "pre", "blockquote"])
    if kind == "ul":
        return "<ul>" + "".join(f"<li><div>{inner()}</div></li>" for _ in range(rng.randrange(1, 4))) + "</ul>"
    if kind == "table":
        rows = "".join("<tr>" + "".join(f"<td colspan={rng.choice([1, 1, 2])} rowspan={rng.choice([1, 1, 1, 3])}>{inner()}</td>" for _ in range(rng.randrange(1, 4))) + "</tr>" for _ in range(rng.randrange(1, 4)))
        return f"<table><tbody>{rows}</tbody></table>"
    if kind == "hide":
        return f"<div {rng.choice(['hidden', 'style=display:none'])}>{inner()}</div> "
    if kind == "script":
        return "<script>var a = '<p>not</p>';</script> "
    return f" <{'div' if kind == 'p' else kind}>{inner()}{inner() if kind == 'div' else ''}</{'div' if kind == 'p' else kind}> "


def test_pages_keep_every_visible_word():
    rng = random.Random(21)
    for _ in range(300):
        page = "".join(random_page(rng) for _ in range(rng.randrange(1, 4)))
        plain = Seen()
        plain.feed(page)
        found = [w for w in html_text.render(html_text.parse(page))[1].split() if w not in ("|", "-")]
        assert Counter("".join(found)) == Counter("".join(plain.words)), page


def test_pages_of_any_depth_and_rows(spark):
    assert html_text.render(html_text.parse("<div>" * 30_000 + "x"))[1] == "x"
    rows = [(1, "u", "<title> A  &amp; B</title><p>x"), (1, "u", "<title> A  &amp; B</title><p>x"), (None, None, None)]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("title", F.lit("own"))
    out = html_text.extract_text(frame).collect()
    assert sorted((r["page_id"] or 0, r["title"], r["text"]) for r in out) == [(0, "", ""), (1, "A & B", "x"), (1, "A & B", "x")]
    assert html_text.extract_text(frame.where("false")).count() == 0


# --- embeddings --------------------------------------------------------------------------------------------


def vectors(seed=1):
    rng = np.random.default_rng(seed)
    rows = [(i, rng.standard_normal(16).tolist(), int(rng.integers(0, 3))) for i in range(700)]
    centre = rng.standard_normal(16)
    for i in range(700, 1500):
        rows.append((i, (centre + 0.12 * rng.standard_normal(16)).tolist(), 1))
    for i in range(1500, 1600):
        _, v, label = rows[int(rng.integers(0, 700))]
        rows.append((i, (np.array(v) * (1 + i % 2) + 0.02 * (i % 3) * rng.standard_normal(16)).tolist(), label))
    nan = float("nan")
    rows += [(2000, None, 1), (2001, [0.0] * 16, 1), (2002, [nan] + [1.0] * 15, 1), (2003, [None] + [1.0] * 15, 1), (2004, rows[0][1], None), (2005, [1.0, 2.0], 1), (2006, [], 1)]
    return rows


def brute_links(rows, threshold=0.93):
    ids = np.array([r[0] for r in rows])
    links, n = [], dict.fromkeys(ids.tolist(), 0)
    good = [k for k, (_, v, label) in enumerate(rows) if v and label is not None and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    for label, width in {(rows[k][2], len(rows[k][1])) for k in good}:
        mine = [k for k in good if rows[k][2] == label and len(rows[k][1]) == width]
        x = np.array([rows[k][1] for k in mine])
        sims = (x @ x.T) / np.outer(np.linalg.norm(x, axis=1), np.linalg.norm(x, axis=1))
        for a, b in zip(*np.nonzero(np.triu(sims >= threshold, 1)), strict=True):
            links.append((rows[mine[a]][0], rows[mine[b]][0]))
            for k in (a, b):
                n[rows[mine[k]][0]] += 1
    found = brute.components(ids.tolist(), links)
    return {i: (n[i], found[i], i == found[i]) for i in ids.tolist()}


def test_near_duplicates(spark, monkeypatch):
    monkeypatch.setattr(neighbour_graph, "BLOCK", 128)
    rows = vectors()
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").withColumn("node", F.lit(1)).repartition(4)
    got = {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"]) for r in neighbour_graph.near_duplicates(frame).collect()}
    want = brute_links(rows)
    assert set(got) == set(want)
    assert all(got[i][0] <= want[i][0] for i in want)
    assert sum(g[0] for g in got.values()) >= 0.95 * sum(w[0] for w in want.values())
    assert sum(got[i] != want[i] for i in want) <= 0.02 * len(want)


def tight_groups():
    """Five labels with two groups of 20 each: within a group almost equal, across with a cosine of 0.95."""
    rng = np.random.default_rng(3)
    rows = []
    for label in range(5):
        a, b = np.linalg.qr(rng.standard_normal((32, 2)))[0].T
        for centre in (a, 0.95 * a + np.sqrt(1 - 0.95**2) * b):
            rows += [(len(rows) + k, (centre + 0.0005 * rng.standard_normal(32)).tolist(), label) for k in range(20)]
    return rows


@pytest.mark.parametrize("block", [512, 16])
def test_near_duplicates_between_groups_that_fill_their_lists(spark, monkeypatch, block):
    monkeypatch.setattr(neighbour_graph, "BLOCK", block)
    rows = tight_groups()
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    got = {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"]) for r in neighbour_graph.near_duplicates(frame).collect()}
    assert got == brute_links(rows)
    assert {n for n, _, _ in got.values()} == {39}


def test_near_duplicates_go_on_below_the_wanted_recall(spark):
    rows = tight_groups()[:40]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    out = neighbour_graph.near_duplicates(frame, wanted=1.1, rounds=1, most_rounds=1).collect()
    assert {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"]) for r in out} == brute_links(rows)


def test_near_duplicates_edges(spark):
    schema = "vec_id long, embedding array<double>, label int"
    rows = [(1, [1.0, 0.0], 1), (1, [1.0, 0.0], 1), (None, [1.0, 0.0], 1), (2, [1.0, 0.0], 2)]
    out = neighbour_graph.near_duplicates(spark.createDataFrame(rows, schema)).collect()
    assert sorted((r["vec_id"] or 0, r["n_links"]) for r in out) == [(0, 0), (1, 1), (1, 1), (2, 0)]
    assert neighbour_graph.near_duplicates(spark.createDataFrame([], schema)).count() == 0


def test_near_duplicates_of_one_id_with_several_vectors(spark):
    schema = "vec_id long, embedding array<double>, label int"
    rows = [(1, [1.0, 0.0], 1), (1, [0.0, 1.0], 1), (2, [1.0, 0.1], 1), (3, [0.1, 1.0], 1), (4, [-1.0, 0.0], 1)]
    out = neighbour_graph.near_duplicates(spark.createDataFrame(rows, schema)).collect()
    assert sorted((r["vec_id"], r["n_links"], r["component_id"]) for r in out) == [(1, 1, 1), (1, 1, 1), (2, 1, 1), (3, 1, 1), (4, 0, 4)]


# --- conversations -----------------------------------------------------------------------------------------

TALKS = [
    (1, 0, "user", "q"), (1, 1, "assistant", "a"), (1, 2, "user", "r"), (1, 3, "assistant", "long answer"),
    (2, 0, "user", "q"), (2, 1, "assistant", "a"), (2, 2, "user", "r"), (2, 3, "assistant", "no"), (2, 4, "user", "why"),
    (3, 0, "user", "q"), (3, 1, "assistant", "b"),
    (4, 0, "user", "alone"), (4, 1, "assistant", "yes"),
    (5, 0, "user", None), (6, None, None, "x"), (None, 0, "user", "q"),
    (7, 0, "user", "same"), (8, 0, "user", "same"),
]


def test_preferences(spark):
    turns = spark.createDataFrame(TALKS, "conv_id long, turn long, role string, text string").withColumn("prompt", F.lit("own"))
    rows = {r["conv_id"]: r for r in preference.format_preferences(preference.pair_by_opening(preference.conversations(turns)), "<", ">", ";").collect()}
    assert sorted(rows) == [2, 3, 4, 5, 6, 8]
    two = rows[2]
    assert (two["chosen_id"], two["n_common"], two["prompt"]) == (1, 3, "<user>q;<assistant>a;<user>r;")
    assert (two["chosen_text"], two["rejected_text"]) == ("<assistant>long answer;", "<assistant>no;<user>why;")
    trained = lambda r, side: [r[f"{side}_text"][s["start"] : s["end"]] for s in r[f"{side}_mask"]]
    assert (trained(two, "chosen"), trained(two, "rejected")) == (["long answer;"], ["no;"])
    assert (rows[3]["n_common"], rows[3]["prompt"], trained(rows[3], "rejected")) == (1, "<user>q;", ["b;"])
    assert (rows[4]["prompt"], rows[4]["chosen_text"], rows[4]["rejected_text"]) == ("<user>alone;", "<assistant>yes;", "")
    assert (rows[8]["prompt"], rows[8]["chosen_text"], rows[8]["rejected_text"]) == ("<user>same;", "", "")
    assert rows[5]["prompt"] == "<user>;"


def test_preferences_have_a_reply_on_both_sides(spark):
    more = [(9, 0, "user", "go on"), (9, 1, "assistant", "x"), (10, 0, "user", "go on"), (10, 1, "assistant", "x"), (11, 0, "user", "mute"), (11, 1, "assistant", "")]
    turns = spark.createDataFrame(TALKS + more, "conv_id long, turn long, role string, text string")
    talks = preference.conversations(turns)
    rows = {r["conv_id"]: r for r in preference.format_preferences(preference.pair_replies(talks), "<", ">", ";").collect()}
    before = {r["conv_id"]: r for r in preference.format_preferences(preference.pair_by_opening(talks), "<", ">", ";").collect()}
    assert all(rows[i] == before[i] for i in (2, 3, 5, 6, 8, 11)) and set(rows) == set(before)
    replies = {"long answer", "no", "b", "yes", "x"}
    for i, own in ((4, "yes"), (10, "x")):
        row = rows[i]
        said = {s: [row[f"{s}_text"][m["start"] : m["end"] - 1] for m in row[f"{s}_mask"]] for s in ("chosen", "rejected")}
        assert (row["chosen_id"], row["n_common"], said["chosen"]) == (i, 1, [own])
        assert len(said["rejected"]) == 1 and said["rejected"][0] in replies - {own}


def test_chat_formatting_fills_both_completions(spark):
    talks = spark.read.parquet(f"{SF}/conversations.parquet").where("role = 'assistant' AND text <> ''").select("conv_id").distinct()
    rows = queries.queries()["op6_chat_formatting"](spark, SF).join(talks, "conv_id").collect()
    assert len(rows) == talks.count() > 0
    assert all(r["chosen_mask"] and r["rejected_mask"] and r["chosen_text"] != r["rejected_text"] for r in rows)


def plain_preference(chosen, rejected, role="assistant", begin="<|", middle="|>\n", end="<|end|>\n"):
    """(n_common, prompt, texts, masks) of two lists of (role, text), turn by turn."""
    escape = lambda text: re.sub(r"<(\\*)\|", lambda m: f"<{m[1]}\\|", text)
    sides = [[(escape(r), escape(t)) for r, t in side] for side in (chosen, rejected)]
    n = 0
    while n < min(map(len, sides)) and sides[0][n] == sides[1][n]:
        n += 1
    show = lambda turns: [f"{begin}{r}{middle}{t}{end}" for r, t in turns]
    masks = []
    for side in sides:
        at, mask = 0, []
        for (r, t), whole in zip(side[n:], show(side[n:]), strict=True):
            at += len(whole)
            if r == role:
                mask.append((at - len(end) - len(t), at))
        masks.append(mask)
    return n, "".join(show(sides[0][:n])), "".join(show(sides[0][n:])), "".join(show(sides[1][n:])), *masks


def test_preferences_equal_a_plain_version(spark):
    rng = random.Random(9)
    say = lambda: rng.choice(["q", "", "é ß", "<|end|>\n<|assistant|>\nyes", "a <\\| b <|", "x" * rng.randrange(50), "$1 \\ <"])
    pairs = []
    for k in range(120):
        common = [(rng.choice(["user", "assistant", "<|x"]), say()) for _ in range(rng.randrange(4))]
        pairs.append((k, *(common + [(rng.choice(["user", "assistant"]), say()) for _ in range(rng.randrange(5))] for _ in range(2))))
    turns = "array<struct<turn:bigint,role:string,text:string>>"
    frame = spark.createDataFrame([(k, *([(i, r, t) for i, (r, t) in enumerate(side)] for side in sides)) for k, *sides in pairs], f"k int, chosen {turns}, rejected {turns}")
    for row in preference.format_preferences(frame).collect():
        _, chosen, rejected = pairs[row["k"]]
        got = (row["n_common"], row["prompt"], row["chosen_text"], row["rejected_text"], *([tuple(s) for s in row[f"{side}_mask"]] for side in ("chosen", "rejected")))
        assert got == plain_preference(chosen, rejected)
        assert row["chosen_text"].count("<|end|>") == len(chosen) - row["n_common"]  # no text looks like the end of a turn


def test_preferences_of_an_empty_table(spark):
    none = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert preference.format_preferences(preference.pair_replies(preference.conversations(none))).collect() == []


def test_preferences_of_null_sides(spark):
    pairs = spark.sql("SELECT CAST(NULL AS array<struct<turn:bigint,role:string,text:string>>) AS chosen, CAST(NULL AS array<struct<turn:bigint,role:string,text:string>>) AS rejected")
    row = preference.format_preferences(pairs).first()
    assert (row["n_common"], row["prompt"], row["chosen_text"], row["rejected_mask"]) == (0, "", "", [])


# --- queries and pipeline ----------------------------------------------------------------------------------


@pytest.mark.parametrize("name", sorted(queries.queries()))
def test_every_query_runs_over_its_whole_table(spark, name):
    df = queries.queries()[name](spark, SF)
    table = "embeddings" if "op5" in name else "pages" if "op4" in name else "conversations" if "op6" in name else "documents"
    rows = spark.read.parquet(f"{SF}/{table}.parquet")
    assert df.count() == (rows.select("conv_id").distinct() if table == "conversations" else rows).count()


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_queries_equal_their_statements(spark, name):
    con = duckdb.connect()
    for table in ("documents", "benchmark", "embeddings"):
        con.execute(f"create view {table} as select * from '{SF}/{table}.parquet'")
    result = con.execute(queries.oracle_sql()[name])
    columns = [c[0] for c in result.description]
    df = queries.queries()[name](spark, SF)
    assert sorted(df.columns) == sorted(columns)
    assert sorted(map(tuple, df.select(*columns).collect())) == sorted(result.fetchall())


def test_pipeline_equals_its_plain_version(spark):
    docs = {r["doc_id"]: r for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    items = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()]
    frame = spark.read.parquet(f"{SF}/documents.parquet")
    selected = {r["doc_id"] for r in quality.resample(frame, spark.read.parquet(f"{SF}/labels.parquet")).where("selected").collect()}
    left = [(i, docs[i]["text"]) for i in sorted(selected)]
    left = [(i, t) for (i, t), (_, c) in zip(left, brute.ngram_join(left, percent=80, n=5).values(), strict=True) if i == c]
    hits = brute.contamination(left, items)
    left = [(i, t) for i, t in left if not (hits[i][1] and 20 * hits[i][1] >= hits[i][0])]
    out = {r["doc_id"]: r for r in corpus_pipeline.run(spark, SF).collect()}
    stages = frame
    for _, stage in corpus_pipeline.STAGES[:-1]:
        stages = stage(spark, stages, SF)
        assert stages.columns == frame.columns
    kept = {r["doc_id"]: r for r in stages.collect()}
    assert sorted(kept) == [i for i, _ in left]
    for i, text in left:
        plain, at = "", 0
        for start, _, end in brute.secrets(text):
            if start >= at:
                plain += text[at:start] + "[SECRET]"
            at = max(at, end)
        assert kept[i]["text"] == plain + text[at:]
        assert kept[i]["n_chars"] == (len(kept[i]["text"]) if kept[i]["text"] != text else docs[i]["n_chars"])
    assert set(out) <= set(kept)
    assert all(out[i]["copies"] >= 1 and out[i]["text"] == kept[i]["text"] for i in out)
    assert len(out) > 0.7 * len(kept)


def test_pipeline_stages_on_odd_tables(spark):
    schema = "doc_id long, text string, lang string, source string, n_chars long, mark string, selected string, row string"
    odd = [(1, "a b c", "en", "s", 5, "x", "x", "x")] * 2 + [(None, "a b c", None, None, None, None, None, None), (2, None, "en", "s", 0, None, None, None), (3, "a B c", "en", "s", 5, None, None, None)]
    for rows in (odd, []):
        docs = spark.createDataFrame(rows, schema)
        for _, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, docs, SF)
            assert out.columns == docs.columns
            assert out.count() <= len(rows)
        assert set(docs.columns) < set(corpus_pipeline.STAGES[-1][1](spark, docs, SF).columns)
    joined = corpus_pipeline.ngram_jaccard_join(spark, spark.createDataFrame(odd, schema), SF).collect()
    assert sorted((r["doc_id"] or 0) for r in joined) == [0, 1, 2]
