"""Language identification: sums over all segmentations, fitted probabilities, and predictions, each recomputed plainly."""

import math
import random
import re
import zlib
from collections import Counter, defaultdict
from functools import cache

import numpy as np
import public_tokenizers
import pytest
import sentencepiece

from claimtree.llm import language_id
from claimtree.llm.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"


def plain_sum(word, table, known, longest):
    """Log of the sum over all segmentations of the word by one language's table; a letter that is no piece has number 0."""
    text, sums = "▁" + word, [0.0] + [-math.inf] * (len(word) + 1)
    for b in range(1, len(text) + 1):
        ways = []
        for a in range(max(0, b - longest), b):
            if text[a:b] in known or b == a + 1:
                ways.append(sums[a] + math.log(table[known.get(text[a:b], 0)]))
        top = max(ways)
        sums[b] = top + math.log(sum(math.exp(w - top) for w in ways))
    return sums[-1]


@cache
def plain_vocabulary():
    model = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(language_id.VOCABULARY))
    pieces = [model.id_to_piece(k) for k in range(model.get_piece_size())]
    return {p for p in pieces if re.fullmatch(r"▁?[^\W\d_]*", p) and p and p == p.lower()}


def test_whole_vocabulary():
    known = language_id.vocabulary()
    assert known.keys() == plain_vocabulary() | {"▁"} and max(map(len, known)) == 16
    assert sorted(known.values()) == list(range(1, len(known) + 1))


@pytest.mark.parametrize("size", [1, 7, 16, 40, 400])
def test_sums_of_words_of_any_length(size):
    rng, known = random.Random(size), language_id.vocabulary()
    table = np.random.default_rng(1).random((len(known) + 1, 3)) ** 8 * 1e-9 + 1e-14
    long = sorted((p.removeprefix("▁") for p in known if len(p) > 10), key=len)
    words = ["".join(rng.choices(long + list("aeiouxyzßé東"), k=size))[:size] for _ in range(6)] + ["q" * size]
    found = language_id.Lattice(words, language_id.piece_table()).log_forward(table)[-1]
    wanted = [[plain_sum(w, table[:, k], known, 16) for k in range(3)] for w in words]
    assert np.allclose(found, wanted, rtol=1e-9, atol=0)


def plain_expected(word, table, known):
    """Expected uses of each piece over all segmentations of a short word, by listing them."""
    text, total, uses = "▁" + word, 0.0, Counter()

    def go(at, pieces, weight):
        nonlocal total
        if at == len(text):
            total += weight
            for p in pieces:
                uses[p] += weight
            return
        for b in range(at + 1, len(text) + 1):
            if text[at:b] in known or b == at + 1:
                number = known.get(text[at:b], 0)
                go(b, [*pieces, number], weight * table[number])

    go(0, [], 1.0)
    return {p: n / total for p, n in uses.items()}


def test_expected_uses():
    known = language_id.vocabulary()
    table = np.random.default_rng(2).random((len(known) + 1, 2)) * 1e-3
    words = ["function", "someth", "информа", "zzqxj", "straße"[:5]]
    for word in words:
        into = np.zeros_like(table)
        language_id.Lattice([word], language_id.piece_table()).expected(table, np.array([[3.0, 0.0]]), into)
        wanted = plain_expected(word, table[:, 0], known)
        assert not into[:, 1].any() and np.allclose([into[p, 0] / 3 for p in wanted], list(wanted.values()))
        assert np.isclose(into[:, 0].sum() / 3, sum(wanted.values()))


def test_predictions_are_the_models(spark):
    """Every prediction at sf0.001 from the trained table, summed word by word in plain Python."""
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    model = language_id.train(docs.where(~language_id.held_out(docs["doc_id"])))
    rows = {r.doc_id: r for r in QUERIES["op7_language_id"][0](spark, FOLDER).collect()}
    known, memo = language_id.vocabulary(), {}
    labelled = Counter(r.lang for r in docs.collect() if zlib.crc32(str(r.doc_id).encode()) % 4 != 2 and r.lang and r.text is not None)
    assert model.languages == sorted(labelled)
    for r in docs.limit(60).collect():
        words = Counter(re.findall(r"[^\W\d_]+", r.text.lower()))
        totals = defaultdict(float)
        for k, lang in enumerate(model.languages):
            totals[lang] = math.log(labelled[lang] / sum(labelled.values()))
            for word, n in words.items():
                if (word, k) not in memo:
                    memo[word, k] = plain_sum(word, model.table[:, k], known, 16)
                totals[lang] += n * memo[word, k]
        best = min(totals, key=lambda x: (-totals[x], x))
        assert (rows[r.doc_id].lang_pred, best)[0] == best or abs(totals[rows[r.doc_id].lang_pred] - totals[best]) < 1e-6
        score = 1 / sum(math.exp(t - totals[best]) for t in totals.values())
        assert abs(rows[r.doc_id].score - score) < 1e-6


def test_ties_and_long_runs_of_letters(spark):
    rows = [("gleich gleich", "b"), ("gleich gleich", "a"), (None, "a"), ("x", None)]
    model = language_id.train(spark.createDataFrame(rows, "text string, lang string"))
    found = model.predict(["gleich", "東" * 5000, "", None, "12 !"])
    assert found[0] == ("a", 0.5) and found[1][0] == "a" and found[1][1] == pytest.approx(0.5) and found[2:] == [("und", 0.0)] * 3
