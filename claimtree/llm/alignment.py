"""Cross-tokenizer alignment: which tokens of two tokenizers cover the same bytes of a text.

Both token sequences of a text cover its bytes from end to end. ``pandas.merge_asof``, keyed by document, finds
for the start of every token the other side's token that covers it; a pair of tokens overlaps exactly if one
covers the start of the other, so the union of both directions is every overlap. Places where tokens of both
sides end cut the sequences into groups.

How often two ids are linked is counted over the corpus. Documents are taken in blocks of a bounded number of
links: a block's different id pairs are counted before they are shuffled, and the corpus-wide counts come back
to the block in the order of its pairs, so that no row of the shuffle is a token or a link.

What a block has of its documents, with the pairs of each, is packed where it is made and unpacked where the counts
come back. Between the two Spark carries it as bytes, in rows that it can sort and spill, and gathers no list; the
one hash table is that of the different pairs of a partition, whose counts are looked up.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator
from functools import lru_cache
from itertools import pairwise

import numpy as np
import pandas as pd
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from claimtree.llm.common import give_back_memory, small_batches, stored

BYTE_VOCABULARY, PIECE_VOCABULARY = "byte_bpe_50k.json", "piece_bpe_32k.model"
# Bytes of text that are tokenized and aligned together; a longer text is taken by itself.
TOGETHER_BYTES = 1 << 20
# Links after which a block of documents is closed.
BLOCK_LINKS = 1 << 20
# The piece vocabulary's sign for a blank, and the marks of the description of groups.
BLANK = "▁"
IN_GROUP, OF_SIDES, OF_GROUPS = ",", "|", ";"

COUNTS = ["n_a", "n_b", "n_groups", "n_links"]
SUMS = ["n_best", "count_sum"]
BLOCK_ROW = pa.schema({
    "block": pa.int64(), "pairs": pa.list_(pa.int64()), "pair_times": pa.list_(pa.int64()),
    "n_pairs": pa.int32(), "docs": pa.binary(), "cells": pa.binary(),
})


def byte_level_signs() -> dict[str, int]:
    """The public byte-level mapping: printable Latin-1 signs stand for themselves, other bytes from U+0100 on."""
    shown = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(0x100 + k): b for k, b in enumerate(hidden)}


class Side:
    """One tokenizer: the bytes of each of its ids, and their lengths and texts as lookup tables."""

    def __init__(self, entries: dict[int, bytes]):
        size = max(entries, default=-1) + 1
        self.bytes = [entries.get(k, b"") for k in range(size)]
        self.lengths = np.array([len(x) for x in self.bytes], np.int64)
        marks = (IN_GROUP, OF_SIDES, OF_GROUPS)
        self.shown = [f"{k}{mark}" for k in range(size) for mark in marks]

    def ids(self, text: str) -> np.ndarray | None:
        """Ids of a text with a blank before it; None if they do not give back its bytes."""
        raise NotImplementedError


class ByteSide(Side):
    """A byte-level vocabulary, run by its ranks: its merges must be numbered in the order in which they apply."""

    def __init__(self, path: str):
        with open(path, "rb") as f:
            model = json.load(f)
        signs, vocabulary = byte_level_signs(), model["model"]["vocab"]
        merged = [vocabulary["".join(m.split(" ") if isinstance(m, str) else m)] for m in model["model"]["merges"]]
        if merged != sorted(merged) or model["normalizer"] is not None:
            raise ValueError("a vocabulary without a normalizer, its ids in the order of its merges, is needed")
        ranks = {bytes(map(signs.__getitem__, token)): k for token, k in vocabulary.items() if all(c in signs for c in token)}
        self.encoder = tiktoken.Encoding(path, pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        super().__init__({k: token for token, k in ranks.items()})

    def ids(self, text: str) -> np.ndarray | None:
        text = f" {text}"
        found = self.encoder.encode_to_numpy(text, disallowed_special=()).astype(np.int64)
        return found if self.lengths[found].sum() == len(text.encode()) else None


class PieceSide(Side):
    def __init__(self, path: str):
        self.encoder = sentencepiece.SentencePieceProcessor(model_file=path)
        entries = {}
        for k in range(self.encoder.get_piece_size()):
            piece = self.encoder.id_to_piece(k)
            entries[k] = bytes([int(piece[3:5], 16)]) if self.encoder.is_byte(k) else piece.replace(BLANK, " ").encode()
        super().__init__(entries)

    def ids(self, text: str) -> np.ndarray | None:
        found = self.encoder.encode(text)
        return np.array(found, np.int64) if b"".join(map(self.bytes.__getitem__, found)) == f" {text}".encode() else None


@lru_cache(maxsize=2)
def sides(a_path: str | None, b_path: str | None) -> tuple[ByteSide, PieceSide]:
    return (
        ByteSide(a_path or public_tokenizers.path(BYTE_VOCABULARY)),
        PieceSide(b_path or public_tokenizers.path(PIECE_VOCABULARY)),
    )


def tokens(side: Side, ids: list[np.ndarray]) -> pd.DataFrame:
    """One row per token of the texts, laid end to end: document, id, first byte and the byte behind the last."""
    flat = np.concatenate([np.empty(0, np.int64), *ids])
    ends = np.cumsum(side.lengths[flat])
    doc = np.repeat(np.arange(len(ids)), [len(one) for one in ids])
    frame = pd.DataFrame({"doc": doc, "id": flat, "start": ends - side.lengths[flat], "end": ends})
    frame["row"] = np.arange(len(frame))
    return frame


def token_ids(texts: list[str | None], side_a: Side, side_b: Side) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """Ids of both sides for each text; none where the text is empty or a side does not give back its bytes."""
    none, out_a, out_b = np.empty(0, np.int64), [], []
    for text in texts:
        a, b = (side_a.ids(text), side_b.ids(text)) if text else (none, none)
        covered = a is not None and b is not None
        out_a.append(a if covered else none)
        out_b.append(b if covered else none)
    return out_a, out_b


def overlaps(a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
    """(doc, row of a, row of b) of all tokens that share a byte."""
    keys = ["doc", "start", "row"]
    of_a = pd.merge_asof(a[keys], b[keys], on="start", by="doc", suffixes=("_a", "_b"))
    of_b = pd.merge_asof(b[keys], a[[*keys, "start"]].set_axis([*keys, "first"], axis=1), on="start", by="doc", suffixes=("_b", "_a"))
    # Tokens that start together were found from the side of a.
    of_b = of_b[of_b["first"] < of_b["start"]]
    columns = ["doc", "row_a", "row_b"]
    return pd.concat([of_a[columns], of_b[columns]], ignore_index=True)


def grouped(a: pd.DataFrame, b: pd.DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Number of the group of each token: groups end where tokens of both sides end."""
    common = np.intersect1d(a["end"].to_numpy(), b["end"].to_numpy(), assume_unique=True)
    return np.searchsorted(common, a["end"].to_numpy()), np.searchsorted(common, b["end"].to_numpy())


def described(a: pd.DataFrame, b: pd.DataFrame, group_a: np.ndarray, group_b: np.ndarray, side_a: Side) -> np.ndarray:
    """``a1,a2|`` and ``b1;`` of all groups of the frames, token by token, as places in both sides' ``shown``."""
    n_groups = int(group_a[-1]) + 1 if len(group_a) else 0
    of_a, of_b = np.bincount(group_a, minlength=n_groups), np.bincount(group_b, minlength=n_groups)
    before_b, after_a = np.cumsum(of_b) - of_b, np.cumsum(of_a)
    last_a = np.append(group_a[1:] != group_a[:-1], True)
    last_b = np.append(group_b[1:] != group_b[:-1], True)
    codes = np.empty(len(a) + len(b), np.int64)
    codes[np.arange(len(a)) + before_b[group_a]] = a["id"].to_numpy() * 3 + last_a
    codes[np.arange(len(b)) + after_a[group_b]] = b["id"].to_numpy() * 3 + 2 * last_b + len(side_a.shown)
    return codes


def align(texts: list[str | None], side_a: Side, side_b: Side) -> tuple[pd.DataFrame, pd.DataFrame]:
    """Counts and digest of each text, and its links as (doc, id of a, id of b)."""
    ids_a, ids_b = token_ids(texts, side_a, side_b)
    a, b = tokens(side_a, ids_a), tokens(side_b, ids_b)
    group_a, group_b = grouped(a, b)
    links = overlaps(a, b)
    found = pd.DataFrame({"n_a": [len(x) for x in ids_a], "n_b": [len(x) for x in ids_b]}, dtype="int64")
    first = np.unique(group_a, return_index=True)[1]  # first token of each group
    found["n_groups"] = np.bincount(a["doc"].to_numpy()[first], minlength=len(texts))
    found["n_links"] = np.bincount(links["doc"], minlength=len(texts))
    codes, at, digests, shown = described(a, b, group_a, group_b, side_a), 0, [], side_a.shown + side_b.shown
    for size in (found["n_a"] + found["n_b"]).tolist():
        text = "".join(map(shown.__getitem__, codes[at : at + size].tolist()))[:-1]
        digests.append(hashlib.sha256(text.encode()).hexdigest() if size else "")
        at += size
    found["groups_sha256"] = digests
    pairs = pd.DataFrame({
        "doc": links["doc"], "a": a["id"].to_numpy()[links["row_a"]], "b": b["id"].to_numpy()[links["row_b"]],
    })
    return found, pairs


class Block:
    """Documents gathered until they hold enough links: their counts, and their links by number of the id pair."""

    def __init__(self):
        self.keys, self.found, self.codes, self.links = [], [], [], 0

    def add(self, keys: list, found: pd.DataFrame, pairs: pd.DataFrame) -> None:
        # Links of one document that join the same ids become one entry with their number.
        place, distinct = pd.factorize((pairs["a"].to_numpy() << 32) | pairs["b"].to_numpy())
        cells, times = np.unique(pairs["doc"].to_numpy() * max(1, len(distinct)) + place, return_counts=True)
        doc, place = np.divmod(cells, max(1, len(distinct)))
        self.codes.append((doc + len(self.keys), distinct[place], times))
        self.found.append(found)
        self.keys.extend(keys)
        self.links += len(pairs)

    def row(self, number: int, key_type: pa.DataType) -> pa.RecordBatch:
        found = pd.concat(self.found, ignore_index=True)
        doc, code, times = (np.concatenate(x) for x in zip(*self.codes, strict=True))
        place, distinct = pd.factorize(code)
        pair_times = np.bincount(place, weights=times, minlength=len(distinct)).astype(np.int64)
        cells = doc * max(1, len(distinct)) + place
        order = np.argsort(cells)
        cells, times = cells[order], times[order]
        docs = {"doc_id": pa.array(self.keys, key_type), **{name: found[name] for name in [*COUNTS, "groups_sha256"]}}
        steps = np.diff(cells, prepend=0)
        values = {
            "block": number, "pairs": distinct, "pair_times": pair_times, "n_pairs": len(distinct),
            "docs": packed(pa.record_batch(docs)), "cells": packed(pa.record_batch({"step": narrow(steps), "times": narrow(times)})),
        }
        return pa.RecordBatch.from_arrays([pa.array([values[f.name]], f.type) for f in BLOCK_ROW], schema=BLOCK_ROW)


def narrow(values: np.ndarray) -> np.ndarray:
    """Numbers from 0 on in the smallest type that holds them."""
    return values.astype(np.min_scalar_type(int(values.max(initial=0))))


def packed(batch: pa.RecordBatch) -> bytes:
    out = pa.BufferOutputStream()
    with pa.ipc.new_stream(out, batch.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as stream:
        stream.write_batch(batch)
    return out.getvalue().to_pybytes()


def unpacked(data: bytes) -> pa.RecordBatch:
    return pa.ipc.open_stream(data).read_next_batch()


def blocks(docs: DataFrame, doc_id: str, text: str, a_path: str | None, b_path: str | None, block_links: int) -> DataFrame:
    """One row per block of documents; ``pairs`` are its different id pairs, ``pair_times`` their links in it.

    ``docs`` has the documents' own columns. ``cells`` has the pairs of each document and their links in it: a cell
    is the document's place in the block times ``n_pairs``, plus the pair's place, less the cell before it.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        side_a, side_b = sides(a_path, b_path)
        number, block, kind = TaskContext.get().partitionId() << 32, Block(), None
        for batch in batches:
            keys, texts, at = batch.column("doc_id"), batch.column("text").to_pylist(), 0
            kind, keys = keys.type, keys.to_pylist()
            sizes = pc.binary_length(batch.column("text")).fill_null(0).to_pylist()
            while at < len(texts):
                to, size = at, 0
                while to < len(texts) and size < TOGETHER_BYTES:
                    size, to = size + sizes[to], to + 1
                block.add(keys[at:to], *align(texts[at:to], side_a, side_b))
                at = to
                if block.links >= block_links:
                    yield block.row(number, kind)
                    number, block = number + 1, Block()
        if block.keys:
            yield block.row(number, kind)
        give_back_memory()

    schema = "block long, pairs array<long>, pair_times array<long>, n_pairs int, docs binary, cells binary"
    return docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")).mapInArrow(run, schema)


def pair_counts(block_rows: DataFrame) -> DataFrame:
    """(a, b, count, best): corpus-wide links of each id pair, and whether no other has more with its id of b."""
    pairs = block_rows.select(F.explode(F.arrays_zip("pairs", "pair_times")).alias("p")).select("p.*")
    counts = pairs.groupBy("pairs").agg(F.sum("pair_times").alias("count"))
    a, b = F.shiftright("pairs", 32), F.col("pairs").bitwiseAND(F.lit(0xFFFFFFFF))
    counts = stored(counts.select("pairs", a.alias("a"), b.alias("b"), "count"), "pair-counts")
    # One row per id of the piece vocabulary: its size is that of a tokenizer, not of the corpus.
    highest = counts.groupBy(F.col("b").alias("_b")).agg(F.max("count").alias("_highest"))
    return counts.join(F.broadcast(highest), F.col("b") == F.col("_b")).select("pairs", "a", "b", "count", (F.col("count") == F.col("_highest")).alias("best"))


def scored(block_rows: DataFrame, counts: DataFrame, kind: str) -> DataFrame:
    """One row per document: its own counts, ``n_best`` and ``count_sum`` from the corpus-wide counts."""
    sought = block_rows.select("block", F.posexplode("pairs").alias("place", "pair"))
    # A pair has one row of counts, so a task's part of them is no larger than what it looks up: it needs no sort.
    met = sought.join(counts.select(F.col("pairs").alias("pair"), "count", "best").hint("shuffle_hash"), "pair").drop("pair")
    whole = block_rows.select("block", "n_pairs", "docs", "cells")
    # A block's own row has no place and so comes before those of its pairs.
    rows = met.unionByName(whole, allowMissingColumns=True).repartition("block").sortWithinPartitions("block", "place")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        head, count, best = None, [], []
        for batch in batches:
            heads = np.flatnonzero(batch.column("place").is_null().to_numpy(zero_copy_only=False)).tolist()
            for k, (at, to) in enumerate(pairwise([0, *heads, batch.num_rows])):
                if k:  # what stands before the first head belongs to the block of the last batch
                    if head:
                        yield summed(head, count, best)
                    head, count, best = [batch.column(c)[at].as_py() for c in ("n_pairs", "docs", "cells")], [], []
                    at += 1
                part = batch.slice(at, to - at)
                count.append(np.array(part.column("count"), np.int64))
                best.append(np.array(part.column("best"), bool))
        if head:
            yield summed(head, count, best)
        give_back_memory()

    own = ", ".join(f"{name} long" for name in [*COUNTS, *SUMS])
    return rows.select("block", "place", "count", "best", "n_pairs", "docs", "cells").mapInArrow(
        run, f"doc_id {kind}, {own}, groups_sha256 string"
    )


def summed(head: list, count: list[np.ndarray], best: list[np.ndarray]) -> pa.RecordBatch:
    """The documents of one block, given the corpus-wide counts of its pairs in their order."""
    n_pairs, docs, cells = head[0], unpacked(head[1]), unpacked(head[2])
    count, best = np.concatenate(count), np.concatenate(best)
    if len(count) != n_pairs:
        raise ValueError(f"{len(count)} counts came back to a block of {n_pairs} pairs")
    doc, place = np.divmod(np.cumsum(cells.column("step").to_numpy(), dtype=np.int64), max(1, n_pairs))
    times, sums = cells.column("times").to_numpy().astype(np.int64), np.zeros((2, docs.num_rows), np.int64)
    np.add.at(sums[0], doc, times * best[place])
    np.add.at(sums[1], doc, times * count[place])
    values = [docs.column(name) for name in ["doc_id", *COUNTS]] + [*map(pa.array, sums), docs.column("groups_sha256")]
    return pa.RecordBatch.from_arrays(values, ["doc_id", *COUNTS, *SUMS, "groups_sha256"])


def align_documents(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", a_path: str | None = None, b_path: str | None = None,
    block_links: int = BLOCK_LINKS,
) -> tuple[DataFrame, DataFrame]:
    """Alignment of every row of ``docs``, and the corpus-wide counts of linked id pairs.

    Documents: ``doc_id``, ``n_a``, ``n_b`` (tokens of the byte-level and of the piece tokenizer), ``n_groups``,
    ``n_links`` (overlapping pairs of tokens), ``n_best`` (links whose id pair has the highest count of its piece
    id, ties included), ``count_sum`` (of the links' counts), ``groups_sha256``. Pairs: ``a``, ``b``, ``count``,
    ``best``.

    A text that is NULL or empty, or whose tokens do not give back its bytes on both sides, has no tokens: zeros
    and an empty digest. Every row is a document, repeated rows and NULL ids too; other columns are not used. An
    empty table gives empty tables.
    """
    small_batches(docs.sparkSession)
    rows = stored(blocks(docs, doc_id, text, a_path, b_path, block_links), "alignment")
    counts = stored(pair_counts(rows), "pairs")
    return scored(rows, counts, dict(docs.dtypes)[doc_id]), counts.drop("pairs")
