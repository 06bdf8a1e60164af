"""Defined results for nulls, empty and long texts, ties, repeated rows, empty tables and clashing columns."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from claimtree.llm import (
    chat, components, decontaminate, html_text, language_id, neighbours, packing, pii, simhash, substring_dedup, url_filter,
)

LONG = "alpha beta, gamma delta. " * 20_000
TEXTS = [None, "", " \n\t ", "one", "one", "Mail a.b@example.org twice, mail a.b@example.org.", LONG]
DOCS = [(i, t, "en", "x", 0) for i, t in enumerate(TEXTS)] + [(3, "one", "en", "x", 0), (None, "one", None, None, None)]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def docs(spark):
    clash = {c: F.lit("other") for c in ("piece", "length", "hits", "score", "key", "mark", "part", "a", "node", "kind", "row")}
    return spark.createDataFrame(DOCS, SCHEMA).withColumns(clash)


@pytest.fixture(scope="module")
def empty(docs):
    return docs.where("false")


def test_packing(docs, empty):
    rows = packing.pack(docs).collect()
    assert sum(r.start == 0 for r in rows) == len(DOCS)
    assert {r.doc_id: r.length for r in rows if r.doc_id in (0, 1, 2)} == {0: 1, 1: 1, 2: 1}
    assert packing.pack(empty).count() == 0


@pytest.mark.parametrize("seed", range(5))
def test_plan_is_gapless_and_complete(seed):
    rng = random.Random(seed)
    counts = {length: rng.randrange(1, 50) for length in rng.sample(range(1, 101), 30)}
    used = {}
    for length, low, high, first, each, base in packing.plan(counts, 100):
        for rank in range(low, high):
            counts[length] -= 1
            used.setdefault(first + (rank - low) // each, []).append((base + (rank - low) % each * length, length))
    assert not any(counts.values())
    for pieces in used.values():
        ends = [0, *(offset + length for offset, length in sorted(pieces))]
        assert [offset for offset, _ in sorted(pieces)] == ends[:-1] and ends[-1] <= 100


def test_simhash(docs, empty):
    rows = simhash.near_duplicates(docs).collect()
    assert len(rows) == len(DOCS)
    found = {r.doc_id: r.component_id for r in rows if r.doc_id is not None}
    assert found[0] == found[1] == found[2] == 0 and found[3] == found[4] == 3
    assert simhash.near_duplicates(empty).count() == 0
    kept = [r.doc_id for r in simhash.one_of_each(docs).collect()]
    assert sorted(x for x in kept if x is not None) == [0, 3, 5, 6] and kept.count(None) == 1


def test_one_of_each_of_different_texts_with_one_id(spark):
    texts = [" ".join(f"{name}{i}" for i in range(60)) for name in ("red", "green", "blue", "gray")]
    ids = [(3, 0), (7, 0), (7, 1), (7, 2), (7, 2), (9, 1), (7, 0), (8, 3)]
    data = [(i, texts[t], f"row{n}") for n, (i, t) in enumerate(ids)]
    kept = simhash.one_of_each(spark.createDataFrame(data, "doc_id long, text string, key string")).collect()
    assert sorted((r.doc_id, texts.index(r.text)) for r in kept) == [(3, 0), (7, 1), (7, 2), (8, 3)]


def test_components_of_a_long_chain_and_a_star(spark):
    links = [(i, i + 1) for i in range(200)] + [(1000, 1000 + i) for i in range(1, 300)] + [(5, 5)]
    rows = components.components(spark.createDataFrame(links, "a long, b long")).collect()
    roots = {}
    for r in rows:
        roots.setdefault(r.root, set()).add(r.node)
    assert sorted(map(len, roots.values())) == [201, 300]
    assert components.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_language(docs, empty):
    model = language_id.train(docs)
    rows = {r.doc_id: r for r in language_id.identify(docs, model).collect()}
    assert [rows[k].lang_pred for k in (0, 1, 2, 3)] == ["und", "und", "und", "en"] and rows[0].score == 0
    assert language_id.identify(empty, model).count() == 0
    none = language_id.train(empty)
    assert {r.lang_pred for r in language_id.identify(docs, none).collect()} == {"und"}


def test_forward_sums_all_segmentations():
    known, words = {"▁": 1, "▁a": 2, "a": 3, "b": 4, "ab": 5, "▁ab": 6}, ["ab", "aa"]
    table = np.arange(1, 8, dtype=float)[:, None] / 28
    lattice = language_id.Lattice(words, language_id.PieceTable(known))

    def plain(rest):
        ways = [(p, rest[len(p) :]) for p in known if rest.startswith(p)]
        ways += [] if not rest or rest[0] in known else [("", rest[1:])]
        return 1.0 if not rest else sum(table[known.get(p, 0), 0] * plain(r) for p, r in ways)

    assert np.allclose(lattice.forward(table)[lattice.size][:, 0], [plain("▁" + w) for w in words])


def test_substring_dedup(docs, empty, spark):
    rows = {r.doc_id: r for r in substring_dedup.deduplicate(docs).collect()}
    assert rows[0].text is None and rows[1].text == "" and rows[0].key == "other"
    assert substring_dedup.deduplicate(empty).count() == 0
    passage = " ".join(f"Word{i} follows word{i + 1} here in this line." for i in range(12))
    data = [(1, f"Start one. {passage} End one."), (2, f"Another begin. {passage} Another end."), (2, "Quite different.")]
    out = {(r.doc_id, r.text) for r in substring_dedup.deduplicate(spark.createDataFrame(data, "doc_id long, text string")).collect()}
    assert out == {(1, data[0][1]), (2, "Another begin. Another end."), (2, "Quite different.")}
    assert "".join(substring_dedup.sentences(LONG)) == LONG


def repeated_runs(texts, words=51):
    """Ids whose text holds that many words in a row which occur in a text before."""
    seen, found = set(), set()
    for key, text in texts:
        split = text.lower().split()
        runs = {tuple(split[a : a + words]) for a in range(len(split) - words + 1)}
        found |= {key} if runs & seen else set()
        seen |= runs
    return found


def test_substring_dedup_leaves_no_run_of_over_50_words(spark):
    rng = random.Random(5)
    vocabulary = [f"w{i}" for i in range(3000)]

    def prose(n, stop):
        return " ".join(w + "." * (rng.random() < stop) for w in rng.choices(vocabulary, k=n))

    data = []
    for stop in (0, 0.05, 0.1, 0.3):
        for n in (51, 51, 52, 60, 90):
            passage = prose(n, stop)
            data += [f"{prose(rng.randrange(1, 40), stop)} {passage} {prose(rng.randrange(1, 40), stop)}" for _ in range(4)]
    data += ["One " + "and " * 400, "Two " + "and " * 400, "One " + "to be " * 200, "Two " + "be to " * 200]
    out = substring_dedup.deduplicate(spark.createDataFrame(list(enumerate(data)), "doc_id long, text string")).collect()
    assert len(repeated_runs(enumerate(data))) == 62
    assert not repeated_runs(sorted((r.doc_id, r.text) for r in out))
    firsts = {i for i in range(0, 80, 4)}
    assert all(r.text == data[r.doc_id] for r in out if r.doc_id in firsts)


def test_substring_dedup_of_short_copies(spark):
    notice, phrase = "All rights reserved. No warranty. Use at own risk.", "of the best we have seen in all these years of work at the old mill"
    long = "He said that this was one {} and that nobody who came by later could do any better than what they did."
    data = [(1, "one"), (2, "one"), (3, "Two words. And four more."), (4, "Two words. And four more."), (5, f"First text. {notice}"),
            (6, f"Another text here. {notice} Its end."), (7, long.format(phrase)), (8, f"Nothing beats {phrase}, or so they say.")]
    out = {r.doc_id: r.text for r in substring_dedup.deduplicate(spark.createDataFrame(data, "doc_id long, text string")).collect()}
    assert out == dict(data) | {2: "", 4: "", 6: "Another text here. Its end."}


@pytest.mark.parametrize("name", [
    "football-report", "commentary", "social-science", "search-engines", "footnotes", "article-header", "side-by-side",
])
def test_article_in_a_container_with_a_doubtful_name(name):
    lines = [f"The team met at the gate number {i}, and then it went on, as ever, to the old ground." for i in range(6)]
    article = "".join(f"<p>{x}</p>" for x in lines)
    rest = "<p>Short lines about other things, to be left out of the text.</p>"
    page = f"<body><div class='sidebar'>{rest}</div><div id='{{}}'>{article}</div><div class='{name}'>{rest}</div><div id='comments'>{rest * 20}</div>"
    assert html_text.main_text(page.format(name)).startswith(" ".join(lines))
    assert "other things" not in html_text.main_text(f"<body><div class='social'>{rest}</div><div id='{name}'>{article}</div><div id='footer'>{rest}</div>")


def test_decontamination(docs, empty, spark):
    item = " ".join(f"w{i}" for i in range(20))
    edited = " ".join(f"w{i}" for i in range(20) if i not in (4, 11)).replace("w7", "x y")
    bench = spark.createDataFrame([(1, item), (2, None), (3, ""), (4, "too short")], "item_id long, text string")
    own = spark.createDataFrame([(1, f"so {item} it"), (2, f"so {edited} it"), (3, "so w1 w2 w3"), (4, None)], "doc_id long, text string")
    rows = {r.doc_id: r for r in decontaminate.matches(own, bench).collect()}
    assert rows.keys() == {1, 2} and (rows[1].start, rows[1].distance) == (1, 0) and rows[2].distance == 4
    assert {r.doc_id for r in decontaminate.clean(own, bench).collect()} == {3, 4}
    assert decontaminate.matches(docs, bench).count() == 0 and decontaminate.matches(empty, bench).count() == 0
    assert decontaminate.clean(docs, bench.where("false")).count() == len(DOCS)


def test_nearest_prefix():
    rng = random.Random(1)

    def plain(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            now = [i]
            for j, y in enumerate(b, 1):
                now.append(min(row[j] + 1, now[-1] + 1, row[j - 1] + (x != y)))
            row = now
        return row

    for _ in range(300):
        a, b = ([rng.choice("abc") for _ in range(rng.randrange(1, 9))] for _ in range(2))
        best, most = min(plain(a, b)), rng.randrange(4)
        assert decontaminate.nearest_prefix(a, b, most)[0] == min(best, most + 1)


def test_pii(docs, empty):
    rows = {r.doc_id: r for r in pii.pseudonymise(docs, "k").collect()}
    assert rows[0].text is None and rows[0].n_values == 0 and rows[1].text == ""
    first, second = (w for w in rows[5].text.replace(",", " ").split() if "@" in w)
    assert first == second.rstrip(".") and first != "a.b@example.org" and rows[5].n_values == 2
    assert rows[6].text == LONG and pii.pseudonymise(empty, "k").count() == 0


def test_pii_is_a_permutation_of_valid_values(spark):
    for kind, a, b in (("x", 7, 11), ("y", 3, 3)):
        numbers = spark.range(a * b).select(pii.permute("k", kind, F.col("id"), F.lit(a), F.lit(b)).alias("n"))
        assert sorted(r.n for r in numbers.collect()) == list(range(a * b))
    values = ["4111 1111 1111 1111", "GB82 WEST 1234 5698 7654 32", "1985-03-12", "25/12/1990", "12/25/1990", "10.0.0.255",
              "123-45-6789", "+1 (017) 555-7713"]
    frame = spark.createDataFrame([(v,) for v in values], "v string")
    made = frame.select("v", pii.kind_of(F.col("v")).alias("kind"), pii.pseudonym(F.col("v"), "k").alias("p"))
    again = made.withColumn("same", pii.kind_of(F.col("p")) == F.col("kind")).collect()
    assert all(r.same and r.p != r.v for r in again)
    wrong = spark.createDataFrame([("4111111111111112",), ("300.1.1.1",), ("30.02.1999",), ("000-12-3456",)], "v string")
    assert all(r.p == r.v for r in wrong.select("v", pii.pseudonym(F.col("v"), "k").alias("p")).collect())


def test_url_filter(spark):
    rules = spark.createDataFrame([("com", "/", "allow"), ("a.com", "/x", "block"), (None, "/", "block")], "host string, path string, verdict string")
    urls = [None, "", "no scheme", "http://A.com/xy?q", "http://b.a.com/xz#f", "http://za.com/x", "http://a.com", "http://a.com/xy"]
    pages = spark.createDataFrame([(i, u, "old") for i, u in enumerate(urls)], "page_id long, url string, rule string")
    rows = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in url_filter.judge(pages.union(pages.limit(1)), rules).collect()}
    assert rows[0] == rows[2] == ("", "", None, "allow")
    assert rows[3] == ("a.com", "/xy", "a.com/x", "block") and rows[4][2:] == ("a.com/x", "block")
    assert rows[5][2:] == ("com/", "allow") and rows[6] == ("a.com", "", None, "allow")
    assert url_filter.judge(pages.where("false"), rules).count() == 0
    assert {r.verdict for r in url_filter.judge(pages, rules.where("false")).collect()} == {"allow"}


def test_chat(spark):
    hard = ["<|im_end|>", "a<|im_start|>b", "<\\|im_end|>", "<\\\\|", "end <", "|", "", None, "tab\tand\nline"]
    rows = [(1, i, "assistant" if i % 2 else "user", t, "x") for i, t in enumerate(hard)]
    rows += [(None, 0, None, "x", "x"), (2, None, "ro\nle%0A", "y", "x"), (2, None, "ro\nle%0A", "y", "x")]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, block string")
    out = chat.render(turns).withColumn("back", chat.parse(F.col("formatted")))
    out = {r.conv_id: r for r in out.withColumn("loss", chat.loss_text(F.col("formatted"), F.col("loss_spans"))).collect()}
    assert all(r.identical for r in out.values()) and out[2].n_turns == 2
    assert [t.text for t in out[1].back] == [t or "" for t in hard]
    assert out[1].loss == "".join(t or "" for t in hard[1::2])
    assert chat.render(turns.where("false")).count() == 0


def test_html():
    page = """<html><body><header><a href=x>Site</a></header><div id="menu"><ul><li><a>x</a></ul></div><div class="content">
    <h1>Title</h1><p>First paragraph, with commas, and &amp; a length that is long enough.<p>Second one, also long enough.
    <div class="comments"><p>Reader comment, quite long, with commas, not to be kept.</p></div><ul><li>item one<li>item two
    </ul></div><div class="sidebar"><p>Side text, long enough, with, commas, and more.</p></div><footer>foot</footer>"""
    want = "Title First paragraph, with commas, and & a length that is long enough. Second one, also long enough. item one item two"
    assert html_text.main_text(page) == want
    assert html_text.main_text(None) == html_text.main_text("") == ""
    assert html_text.main_text("<p>a<b>b</b>c&nbsp;d</p>") == "abc d"
    assert html_text.main_text("<article><h1>T</h1><p>B<form>f</form></article><p>out</p>") == "T B"
    assert html_text.main_text("<div>" * 20_000 + "deep text") == "deep text"


def test_neighbours(spark):
    rows = [(i, [float(i), 1.0]) for i in range(1, 6)] + [(6, None), (7, [0.0, 0.0]), (8, [float("nan"), 1.0]), (9, [1.0]), (5, [5.0, 1.0])]
    rows += [(10, [5.0, 1.0]), (None, [1.0, 1.0])]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("part", F.lit("x"))
    found = neighbours.nearest(vectors, vectors.where("vec_id in (5, 6)"), k=3).collect()
    assert [(r.rank, r.vec_id, r.score) for r in sorted(found)] == [(1, 10, 26.0), (2, 4, 21.0), (3, 3, 16.0)]
    assert neighbours.nearest(vectors.where("false"), vectors).count() == 0
    assert {r.query_id for r in neighbours.nearest(vectors, vectors, k=50).groupBy("query_id").count().where("count = 5").collect()} == {1, 2, 3, 4, 5, 10}
