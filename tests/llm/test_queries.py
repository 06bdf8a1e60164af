"""Registered queries of the package: against SQL where there is some, against plain versions where not."""

import hashlib
import re
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
import xxhash
from tokenizers import Tokenizer

import corpus_pipeline
from claimtree.llm import decontaminate, packing, pii, substring_dedup
from claimtree.llm.queries import QUERIES
from tests.compare import compare, duck

FOLDER = "/root/testdata/sf0.001"
NATIVE = {"op1_url_filter", "op3_pii", "op8_chat"}


@pytest.fixture(scope="module")
def documents(spark):
    return {r.doc_id: r.text for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()}


@pytest.mark.parametrize("name", [n for n, (_, sql) in QUERIES.items() if sql])
def test_sql(spark, name):
    run, sql = QUERIES[name]
    result = run(spark, FOLDER)
    assert name not in NATIVE or "Python" not in result._jdf.queryExecution().toString()
    assert compare(result, duck(FOLDER), sql) == []


def test_every_operator_has_a_query():
    assert sorted(int(re.match(r"op(\d+)_", name)[1]) for name in QUERIES) == list(range(1, 14))


def plain_ids(text):
    encoder = Tokenizer.from_file(public_tokenizers.path(packing.VOCABULARY))
    return encoder.encode(text or "", add_special_tokens=False).ids + [packing.END_ID]


def check_pieces(rows, texts, crc):
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r.doc_id].append((r.piece, r.start, r.length, crc(r)))
        by_sequence[r.sequence_id].append((r.offset, r.length))
    for key, text in texts.items():
        ids = plain_ids(text)
        cuts = [ids[a : a + packing.CAPACITY] for a in range(0, len(ids), packing.CAPACITY)]
        want = [(k, k * packing.CAPACITY, len(c), zlib.crc32(np.array(c, "<u4").tobytes())) for k, c in enumerate(cuts)]
        assert sorted(by_doc.pop(key)) == want
    assert not by_doc
    for pieces in by_sequence.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= packing.CAPACITY
    return len(by_sequence)


def test_packing(spark, documents):
    rows = QUERIES["op2_packing"][0](spark, FOLDER).collect()
    sequences = check_pieces(rows, documents, lambda r: r.ids_crc32)
    assert sequences <= 1 + -(-sum(r.length for r in rows) // packing.CAPACITY)


def plain_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return 0
    hashes = [xxhash.xxh64_intdigest(" ".join(words[i : i + 3]), 42) for i in range(max(1, len(words) - 2))]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(texts):
    prints = {d: plain_fingerprint(t) for d, t in texts.items()}
    root = {d: d for d in prints}
    for _ in prints:
        before = dict(root)
        for a in prints:
            near = [root[b] for b in prints if (prints[a] ^ prints[b]).bit_count() <= 2]
            root[a] = min(near)
        if root == before:
            break
    return {d: (f"{prints[d]:016x}", root[d]) for d in prints}


def test_simhash(spark, documents):
    rows = QUERIES["op6_simhash"][0](spark, FOLDER).collect()
    assert {r.doc_id: (r.fingerprint, r.component_id) for r in rows} == plain_components(documents)


def test_language(spark):
    rows = QUERIES["op7_language_id"][0](spark, FOLDER).collect()
    langs = {r.doc_id: r.lang for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()}
    assert len(rows) == len(langs)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)
    held = [r for r in rows if r.held_out and langs[r.doc_id]]
    assert sum(r.lang_pred == langs[r.doc_id] for r in held) >= 0.95 * len(held)
    assert all(0 <= r.score <= 1 for r in rows)


def plain_dedup(texts):
    seen, out = set(), {}
    for key in sorted(texts):
        normal = [" ".join(s.lower().split()) for s in substring_dedup.sentences(texts[key])]
        starts = []
        for i in range(max(1, len(normal) - 2) if any(normal) else 0):
            run = tuple(normal[i : i + 3])
            if run in seen:
                starts.append(i)
            seen.add(run)
        out[key] = substring_dedup.without(texts[key], starts) if starts else (texts[key], 0)
    return out


def test_substring_dedup(spark, documents):
    rows = QUERIES["op5_substring_dedup"][0](spark, FOLDER).collect()
    assert {r.doc_id: (r.text, r.removed_sentences) for r in rows} == plain_dedup(documents)


def plain_leaks(spark, texts):
    items = {r.item_id: decontaminate.words_of(r.text) for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()}
    joined = {d: f" {' '.join(decontaminate.words_of(t))} " for d, t in texts.items()}
    return {(d, i) for d, t in joined.items() for i, w in items.items() if f" {' '.join(w)} " in t}


def test_decontamination_finds_exact_copies(spark, documents):
    rows = QUERIES["op10_decontamination"][0](spark, FOLDER).collect()
    assert {(r.doc_id, r.item_id) for r in rows if r.distance == 0} == plain_leaks(spark, documents)
    assert all(r.similarity >= 0.8 for r in rows)


def test_neighbours_recall(spark):
    rows = QUERIES["op9_neighbours"][0](spark, FOLDER).collect()
    data = {r.vec_id: np.array(r.embedding, float) for r in spark.read.parquet(f"{FOLDER}/embeddings.parquet").collect()}
    found = defaultdict(dict)
    for r in rows:
        found[r.query_id][r.vec_id] = r.score
    hits = total = 0
    for q in (q for q in data if q % 20 == 0):
        scores = {v: float((x * data[q]).sum()) for v, x in data.items() if v != q}
        best = sorted(scores, key=lambda v: (-scores[v], v))[:20]
        hits, total = hits + len(found[q].keys() & set(best)), total + 20
        assert len(found[q]) == 20 and all(abs(s - scores[v]) < 1e-12 for v, s in found[q].items())
    assert hits >= 0.9 * total


def test_pipeline(spark, documents):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    stages = dict(corpus_pipeline.STAGES)
    kept = stages["language_id"](spark, docs, FOLDER)
    assert kept.columns == docs.columns and kept.count() == docs.count()
    roots = {d for d, (_, root) in plain_components(documents).items() if d == root}
    single = stages["simhash_near_dedup"](spark, docs, FOLDER)
    assert single.columns == docs.columns and {r.doc_id for r in single.collect()} == roots
    clean = stages["decontamination"](spark, docs, FOLDER)
    assert {r.doc_id for r in clean.collect()} == documents.keys() - {d for d, _ in plain_leaks(spark, documents)}
    hidden = {r.doc_id: r for r in stages["pii"](spark, docs, FOLDER).collect()}
    for key, text in documents.items():
        for mail in re.findall(pii.EMAIL, text):
            assert mail not in hidden[key].text
        assert hidden[key].n_chars == len(hidden[key].text) == len(text) or re.search(r"\d+\.\d+\.\d+\.\d+", text)
    rows = corpus_pipeline.run(spark, FOLDER).collect()
    want = {d for d in roots if d not in {d for d, _ in plain_leaks(spark, documents)}}
    assert {r.doc_id for r in rows} == want
    check_pieces(rows, {d: hidden[d].text for d in want}, lambda r: zlib.crc32(r.ids))


def test_chat_digest(spark):
    row = QUERIES["op8_chat"][0](spark, FOLDER).where("conv_id = -1").first()
    text = "<|im_end|><|im_start|>assistant ok"
    assert row.turns_sha256 == hashlib.sha256(f"user\n{text}\nassistant\n{text}\n".encode()).hexdigest()
    assert (row.loss_chars, row.loss_sha256) == (len(text), hashlib.sha256(text.encode()).hexdigest())
