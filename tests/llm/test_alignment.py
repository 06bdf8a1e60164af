"""Cross-tokenizer alignment against a plain version that compares every token with every other."""

import hashlib
import random
from collections import Counter
from functools import cache

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
from hypothesis import given, settings, strategies as st
from pyspark.sql import types as T
from tokenizers import Tokenizer

from claimtree.llm import alignment
from claimtree.llm.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"
COLUMNS = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
ODD = [
    None, "", " ", "  two  blanks ", "a", "<|endoftext|> and <s>x</s> <0x41>", "naïve café 東京タワー", "🙂🙂 👩‍👩‍👧",
    "a▁b", "tab\tnew\r\nline", "\x00", "﻿bom", "é", "x" * 3000, "the the the", "the the the", "1234567890" * 30,
]


@cache
def models():
    a_model = Tokenizer.from_file(public_tokenizers.path(alignment.BYTE_VOCABULARY))
    a_model.encode_special_tokens = True
    return a_model, sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(alignment.PIECE_VOCABULARY))


def plain_tokens(texts):
    a_model, b_model = models()
    signs = {chr(b) if 33 <= b < 127 or 161 <= b < 173 or b >= 174 else None: b for b in range(256)}
    hidden = [b for b in range(256) if not (33 <= b < 127 or 161 <= b < 173 or b >= 174)]
    signs |= {chr(256 + k): b for k, b in enumerate(hidden)}

    def of_b(k):
        piece = b_model.id_to_piece(k)
        return bytes.fromhex(piece[3:5]) if b_model.is_byte(k) else piece.replace("▁", " ").encode()

    def placed(ids, entry):
        at, out = 0, []
        for k in ids:
            out.append((k, at, at + len(entry(k))))
            at = out[-1][2]
        return out, b"".join(map(entry, ids))

    for text in texts:
        if not text:
            yield [], []
            continue
        a, a_bytes = placed(a_model.encode(" " + text, add_special_tokens=False).ids, lambda k: bytes(signs[c] for c in a_model.id_to_token(k)))
        b, b_bytes = placed(b_model.encode(text), of_b)
        yield (a, b) if a_bytes == b_bytes == (" " + text).encode() else ([], [])


def plain_alignment(texts):
    rows, links = [], []
    for a, b in plain_tokens(texts):
        own, j0 = [], 0
        for ka, sa, ea in a:
            while j0 < len(b) and b[j0][2] <= sa:
                j0 += 1
            j = j0
            while j < len(b) and b[j][1] < ea:
                assert b[j][2] > sa
                own.append((ka, b[j][0]))
                j += 1
        cuts = sorted({e for *_, e in a} & {e for *_, e in b})
        groups = []
        for low, high in zip([0, *cuts], cuts, strict=False):
            inside = [",".join(str(k) for k, s, e in side if low <= s and e <= high) for side in (a, b)]
            groups.append("|".join(inside))
        digest = hashlib.sha256(";".join(groups).encode()).hexdigest() if a else ""
        rows.append([len(a), len(b), len(cuts), len(own), digest])
        links.append(own)
    counts = Counter(pair for own in links for pair in own)
    highest = Counter()
    for (_, b), n in counts.items():
        highest[b] = max(highest[b], n)
    out = []
    for row, own in zip(rows, links, strict=True):
        best = sum(counts[p] == highest[p[1]] for p in own)
        out.append((*row[:4], best, sum(counts[p] for p in own), row[4]))
    return out, counts, highest


def test_query(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").collect()
    rows = {r.doc_id: tuple(r[c] for c in COLUMNS) for r in QUERIES["op13_alignment"][0](spark, FOLDER).collect()}
    want, _, _ = plain_alignment([r.text for r in docs])
    assert rows == {r.doc_id: w for r, w in zip(docs, want, strict=True)}


@pytest.mark.parametrize("block_links", [1, 40, 1 << 20])
def test_odd_texts(spark, block_links):
    """NULL and empty texts, control strings, bytes without a piece, repeated rows, NULL ids, clashing names."""
    schema = T.StructType.fromDDL("doc_id long, text string, block long, n_a string, pairs string, key int")
    keys = [None if k == 4 else (1 << 60) + k for k in range(len(ODD))]
    docs = spark.createDataFrame([(k, t, 1, "x", "y", 2) for k, t in zip(keys, ODD, strict=True)], schema)
    found, pairs = alignment.align_documents(docs.unionByName(docs), block_links=block_links)
    want, counts, highest = plain_alignment(ODD + ODD)
    by_key = {k: w for k, w in zip(keys, want, strict=False)}
    rows = found.collect()
    assert len(rows) == 2 * len(ODD) and Counter(r.doc_id for r in rows) == Counter(keys + keys)
    assert all(tuple(r[c] for c in COLUMNS) == by_key[r.doc_id] for r in rows)
    got = {(r.a, r.b): (r["count"], r.best) for r in pairs.collect()}
    assert got == {p: (n, n == highest[p[1]]) for p, n in counts.items()}


def test_empty_table(spark):
    found, pairs = alignment.align_documents(spark.createDataFrame([], "doc_id long, text string"))
    assert found.columns == ["doc_id", *COLUMNS] and found.collect() == [] and pairs.collect() == []


def test_blocks_cross_spark_as_bytes(spark):
    """Spark gathers no list of a block's documents or pairs, and what it carries for a document's pair is small."""
    words = [f"{a}{b}{c}" for a in ("", "ver", "Un") for b in ("sta", "lo", "ki") for c in ("gen", "ments", "ra", "t")]
    chosen = random.Random(1)
    texts = [" ".join(chosen.choices(words, k=chosen.randrange(300))) for _ in range(400)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    rows = alignment.blocks(docs, "doc_id", "text", None, None, 1 << 15).collect()
    entries = sum(alignment.unpacked(r.cells).num_rows for r in rows)
    assert len(rows) > 1 and sum(len(r.cells) for r in rows) < 2 * entries
    found, _ = alignment.align_documents(docs, block_links=1 << 15)
    plan = found._jdf.queryExecution().toString()
    assert "collect_list" not in plan and "SortMergeJoin" not in plan and "arrays_zip" not in plan
    want, _, _ = plain_alignment(texts)
    assert {r.doc_id: tuple(r[c] for c in COLUMNS) for r in found.collect()} == dict(enumerate(want))


def test_missing_counts():
    block = alignment.Block()
    block.add([1, 2], *alignment.align(["hello world", None], *alignment.sides(None, None)))
    row = block.row(0, pa.int64()).to_pylist()[0]
    ones = [np.ones(row["n_pairs"], np.int64)], [np.ones(row["n_pairs"], bool)]
    whole = alignment.summed([row["n_pairs"], row["docs"], row["cells"]], *ones).to_pylist()
    assert [(r["doc_id"], r["n_best"], r["count_sum"]) for r in whole] == [(k, r["n_links"], r["n_links"]) for k, r in zip([1, 2], whole, strict=True)]
    with pytest.raises(ValueError, match="came back"):
        alignment.summed([row["n_pairs"], row["docs"], row["cells"]], [ones[0][0][:-1]], ones[1])


def test_groups_end_together():
    side_a, side_b = alignment.sides(None, None)
    found, links = alignment.align(["hello world", None], side_a, side_b)
    assert found["n_groups"].tolist() == [2, 0] and len(links) == found["n_links"].sum()
    assert b"".join(side_a.bytes[k] for k in side_a.ids("hello world")) == b" hello world"


def test_ids_of_every_sign():
    """The ranks give what the vocabulary file gives in its own library, sign by sign."""
    side_a, a_model = alignment.sides(None, None)[0], models()[0]
    texts = [f"a{chr(c)}b {chr(c)}{chr(c)} 1{chr(c)}\n{chr(c)} ." for c in range(0, 0x110000, 5) if not 0xD800 <= c < 0xE000]
    wanted = a_model.encode_batch_fast([f" {t}" for t in texts], add_special_tokens=False)
    assert [t for t, w in zip(texts, wanted, strict=True) if side_a.ids(t).tolist() != w.ids] == []


@settings(max_examples=400, deadline=None)
@given(st.lists(st.one_of(st.sampled_from([" ", "  ", "\n", "\t", "\x1c", "\x85", "\u00a0", "\u2003", "\u200b", "'s", "a", "Ab1", "é", "é", "東", "🙂", "²", "_", "٣"]), st.characters(exclude_categories=["Cs"]))).map("".join))
def test_ids_of_any_text(text):
    side_a, side_b = alignment.sides(None, None)
    a, b = alignment.token_ids([text], side_a, side_b)
    want_a, want_b = ([k for k, *_ in side] for side in next(plain_tokens([text])))
    assert a[0].tolist() == want_a and b[0].tolist() == want_b
    assert a[0].dtype == b[0].dtype == np.int64
