"""Short items, scripts without blanks, benchmarks in several blocks, and near copies against a plain search."""

import random

import pytest

from claimtree.llm import decontaminate
from claimtree.llm.decontaminate import words_of

ITEMS = [
    (1, "alpha"), (2, "beta gamma"), (3, "one two three four five six seven"), (4, "東京は日本の首都です"), (5, "ภาษาไทย"), (6, "Ünïcode wörds hére"), (7, "!!!"),
    (8, None), (9, ""), (10, "the quick brown fox jumps over the lazy dog again and again"), (11, "我们在北京大学学习汉语和历史已经三年了很高兴"),
]
DOCS = [
    (1, "x alpha y"), (2, "alphabet beta  gamma, delta"), (3, "zero one two three four five six seven eight"), (4, "昨日、東京は日本の首都です。"), (5, "พูดภาษาไทยได้"),
    (6, "some ÜNÏCODE WÖRDS HÉRE now"), (7, "!!!"), (8, None), (9, ""), (10, "The quick brown fox leaps over the lazy dog again, and again!"), (11, "beta. Gamma? beta"),
    (12, "one two three four five six"), (13, "clean words only"), (14, "alpha alpha beta gamma"), (15, "今年我们在北京大学学习中文和历史已经三年了很高兴。"),
]


def found(spark, items=ITEMS):
    docs = spark.createDataFrame(DOCS, "doc_id int, text string")
    bench = spark.createDataFrame(items, "item_id int, text string")
    return {(r.doc_id, r.item_id): (r.start, r.n_words, r.distance) for r in decontaminate.matches(docs, bench).collect()}


def test_short_items_and_scripts_without_blanks(spark):
    hits = found(spark)
    exact = {
        (d, i): (at, len(words_of(item)), 0)
        for d, text in DOCS for i, item in ITEMS if words_of(item)
        for at in [next((k for k in range(len(words_of(text))) if words_of(text)[k : k + len(words_of(item))] == words_of(item)), None)] if at is not None
    }
    assert {k: v for k, v in hits.items() if v[2] == 0} == exact and (4, 4) in exact and (5, 5) in exact and (14, 2) in exact
    assert {k: v[2] for k, v in hits.items() if v[2]} == {(10, 10): 1, (15, 11): 2}


def test_blocks_one_after_another(spark, monkeypatch):
    whole = found(spark)
    monkeypatch.setattr(decontaminate, "BLOCK_CHARS", 40)
    bench = spark.createDataFrame(ITEMS, "item_id int, text string")
    assert len(decontaminate.item_blocks(bench, "item_id", "text")) > 2
    assert found(spark) == whole
    docs = spark.createDataFrame([(*r, "h") for r in DOCS], "doc_id int, text string, hits string")
    kept = decontaminate.clean(docs, bench)
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} == {d for d, _ in DOCS} - {d for d, _ in whole}


@pytest.mark.parametrize("share", [0.05, 0.1, 0.2])
def test_recall_of_edited_copies(spark, share):
    """Every planted copy with that share of its words changed, left out or put in; the plain search finds all."""
    rng = random.Random(3)
    vocabulary = [f"w{k}" for k in range(800)]
    items = [(k, " ".join(rng.choices(vocabulary, k=rng.randint(15, 60)))) for k in range(60)]
    docs = []
    for k, text in items:
        for copy in range(4):
            words = text.split()
            for _ in range(int(len(words) * share)):
                at, kind = rng.randrange(len(words)), rng.randrange(3)
                words[at : at + (kind != 1)] = [] if kind == 2 else [rng.choice(vocabulary)]
            docs.append((4 * k + copy, " ".join([*rng.choices(vocabulary, k=30), *words, *rng.choices(vocabulary, k=30)])))
    rows = decontaminate.matches(spark.createDataFrame(docs, "doc_id int, text string"), spark.createDataFrame(items, "item_id int, text string"))
    hits = {(r.doc_id, r.item_id): r.distance for r in rows.collect()}
    for (d, i), distance in hits.items():
        words, item = words_of(docs[d][1]), words_of(items[i][1])
        assert distance == min(decontaminate.nearest_prefix(item, words[a : a + 2 * len(item)], len(item))[0] for a in range(len(words))) or distance <= 0.2 * len(item)
    assert sum((d, d // 4) in hits for d, _ in docs) >= 0.97 * len(docs)
