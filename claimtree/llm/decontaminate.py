"""Benchmark decontamination by CGK embedding, bit-sampling LSH and exact edit distance.

An item and every window of its size in a document are embedded by random walks (Chakraborty, Goldenberg,
Koucky): step j copies the word under the pointer and moves the pointer on or not by a random bit of the word
and j, so words that are edited in or out are walked past and edit distance becomes Hamming distance. Each
repetition samples a few steps of a walk of its own; a window whose samples equal an item's is verified by
exact edit distance. Only windows that hold enough of the items' pairs of neighbouring words to be near any
item are walked; that bound follows from the number of edits, so it loses no match.

Items of fewer words than edits can be told from chance in are looked up as they are, word by word.

Documents are read row by row and nothing is shuffled. Items go to the tasks in blocks of bounded size; a
benchmark of any size is done block after block, what was found being written before the next block is read.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from claimtree.llm.common import free_name, give_back_memory, small_batches, stored

SIMILARITY = 0.8
# Items with fewer words are found only as they are: an edited one is hardly more than a common phrase.
LEAST_WORDS = 8
REPETITIONS, SAMPLES = 24, 3
# A walk over n words has this many times n steps, in which it passes them all on average; later steps would
# sample the same filling in every window.
WALK = 2
# Characters of items that one block, and so the driver and a task's lookup, holds; whatever their script.
BLOCK_CHARS = 12_000_000
# Windows that are walked at once.
CHUNK = 1 << 15
# Texts whose windows are walked together.
TEXTS = 500
# Scripts written without blanks (Thai to Tibetan, Burmese, Khmer, kana and Han): each of their signs is a word.
UNSPACED = "\u0e00-\u0fff\u1000-\u109f\u1780-\u17ff\u3040-\u30ff\u3400-\u4dbf\u4e00-\u9fff\uf900-\ufaff\U00020000-\U0003ffff"
WORD = re.compile(rf"[{UNSPACED}]|[^\W{UNSPACED}]+")
MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)

HIT = "item_id {kind}, start int, n_words int, distance int, similarity double"


def words_of(text: str | None) -> list[str]:
    return WORD.findall((text or "").lower())


def allowed(n: int, similarity: float) -> int:
    """Edits that leave an item of n words at this similarity."""
    return int(n * (1 - similarity) + 1e-9)


def nearest_prefix(item: list, run: list, most: int) -> tuple[int, int]:
    """Least Levenshtein distance of ``item`` to a beginning of ``run``, and that beginning's size.

    Of equally near beginnings the one closest to the item's size. Distances over ``most`` count as
    ``most + 1``, so only a band of the table is filled.
    """
    n, far = len(item), most + 1
    row = list(range(min(len(run), most) + 1)) + [far] * (len(run) - min(len(run), most))
    for i, x in enumerate(item, 1):
        now = [far] * len(row)
        if i <= most:
            now[0] = i
        for j in range(max(1, i - most), min(len(run), i + most) + 1):
            now[j] = min(row[j - 1] + (x != run[j - 1]), row[j] + 1, now[j - 1] + 1, far)
        row = now
    return min((d, abs(j - n), j) for j, d in enumerate(row))[::2]


def among(values: np.ndarray, known: np.ndarray) -> np.ndarray:
    """Which of the values occur in the sorted array."""
    return known[np.minimum(np.searchsorted(known, values), len(known) - 1)] == values


class Index:
    """Items by their sampled walks."""

    def __init__(self, items: list[tuple], similarity: float, repetitions: int, samples: int, seed: int = 7):
        # Short items by their first word.
        self.short: dict[str, list[tuple]] = {}
        for key, words in items:
            if 0 < len(words) < LEAST_WORDS:
                self.short.setdefault(words[0], []).append((key, words))
        self.items = [(key, words) for key, words in items if len(words) >= LEAST_WORDS]
        self.sets = [frozenset(words) for _, words in self.items]
        self.numbers: dict[str, int] = {}
        for _, words in self.items:
            for w in words:
                self.numbers.setdefault(w, len(self.numbers) + 1)
        self.hashes = np.array([0, *(xxhash.xxh64_intdigest(w) for w in self.numbers)], np.uint64)
        coded = [np.array([self.numbers[w] for w in words]) for _, words in self.items]
        self.pairs = np.unique(np.concatenate([self._pairs(c) for c in coded] or [np.zeros(0, np.int64)]))
        self.by_size: dict[int, list[int]] = {}
        for k, (_, words) in enumerate(self.items):
            self.by_size.setdefault(len(words), []).append(k)
        self.pairs_of = {n: np.unique(np.concatenate([self._pairs(coded[k]) for k in ks])) for n, ks in self.by_size.items()}
        self.most = {n: allowed(n, similarity) for n in self.by_size}
        # An edit breaks at most two of the item's n - 1 pairs of neighbouring words.
        self.need = {n: max(1, n - 1 - 2 * most) for n, most in self.most.items()}
        rng = np.random.default_rng(seed)
        self.salts = {n: rng.integers(1, 2**63, (repetitions, WALK * n), dtype=np.uint64) for n in self.by_size}
        self.sampled = {
            n: np.stack([np.isin(np.arange(WALK * n), rng.choice(WALK * n, samples, replace=False)) for _ in range(repetitions)])
            for n in self.by_size
        }
        self.buckets: dict[int, list[dict[int, list[int]]]] = {}
        for n, members in self.by_size.items():
            found = self.signatures(self.hashes[np.stack([coded[k] for k in members])])
            self.buckets[n] = [{} for _ in found]
            for table, row in zip(self.buckets[n], found, strict=True):
                for k, signature in zip(members, row.tolist(), strict=True):
                    table.setdefault(signature, []).append(k)
        self.keys = {n: [np.array(sorted(t), np.uint64) for t in tables] for n, tables in self.buckets.items()}

    def _pairs(self, coded: np.ndarray) -> np.ndarray:
        return coded[:-1] * (len(self.numbers) + 1) + coded[1:]

    def signatures(self, windows: np.ndarray) -> np.ndarray:
        """(repetition, window): a hash of the sampled steps of the walk over each row of word hashes."""
        count, n = windows.shape
        padded = np.concatenate([windows, np.zeros((count, 1), np.uint64)], axis=1).ravel()
        salts, sampled = self.salts[n], self.sampled[n]
        at = np.repeat((np.arange(count) * (n + 1))[None], len(salts), axis=0)
        last = at[0] + n
        signature = np.zeros(at.shape, np.uint64)
        for j in range(int(np.flatnonzero(sampled.any(axis=0))[-1]) + 1):
            word = padded[at]
            if (rows := np.flatnonzero(sampled[:, j])).size:
                mixed = (signature[rows] ^ word[rows]) * MULTIPLIER + np.uint64(j)
                signature[rows] = mixed ^ (mixed >> np.uint64(29))
            step = ((word ^ salts[:, j, None]) * MULTIPLIER) >> np.uint64(63)
            np.minimum(at + step.astype(np.int64), last, out=at)
        return signature

    def search(self, texts: list[str | None]) -> list[list[tuple]]:
        """For each text the best place of every item in it: (item, start, n_words, distance, similarity)."""
        found: list[list[tuple]] = [self._exact(text) for text in texts]
        if not self.items:
            return found
        spans = {n: n + most for n, most in self.most.items()}
        width, widest = min(spans.values()), max(spans.values())
        # A span with enough pairs has, in one of its cuts of the least width, at least this many.
        least = min(-(-self.need[n] // -(-spans[n] // width)) for n in spans)
        get = self.numbers.get
        words: dict[int, list[str]] = {}
        windows: dict[int, list[tuple[int, np.ndarray, np.ndarray]]] = {n: [] for n in self.by_size}
        for t, text in enumerate(texts):
            own = words_of(text)
            coded = np.array([get(w, 0) for w in own], np.int64)
            both = np.flatnonzero((coded[:-1] > 0) & (coded[1:] > 0))
            if both.size < least:
                continue
            both = both[among(self._pairs(coded)[both], self.pairs)]
            if both.size < least or (both[least - 1 :] - both[: both.size - least + 1]).min() >= width:
                continue
            words[t] = own
            codes = self._pairs(coded)[both]
            for n, most in self.most.items():
                near = both[among(codes, self.pairs_of[n])]
                if near.size < self.need[n]:
                    continue
                known = np.zeros(len(own) + 2 * widest, np.int64)
                known[near + 1] = 1
                known = np.cumsum(known)
                # Pairs inside the n + most words from a start on.
                inside = known[n + most - 1 : n + most - 1 + len(own)] - known[: len(own)]
                starts = np.flatnonzero(inside >= self.need[n])
                if starts.size:
                    padded = np.concatenate([self.hashes[coded], np.zeros(n, np.uint64)])
                    windows[n].append((t, starts, padded))
        candidates: dict[int, set[tuple[int, int]]] = {}
        for n, parts in windows.items():
            self._meet(n, parts, candidates)
        for t, places in candidates.items():
            found[t] += self._verified(words[t], places)
        return found

    def _exact(self, text: str | None) -> list[tuple]:
        """The first place of each short item that the text holds word by word."""
        if not self.short:
            return []
        best: dict[int, tuple] = {}
        words = words_of(text)
        for at, word in enumerate(words):
            for item in self.short.get(word, ()):
                if id(item) not in best and words[at : at + len(item[1])] == item[1]:
                    best[id(item)] = (item[0], at, len(item[1]), 0, 1.0)
        return list(best.values())

    def _meet(self, n: int, parts: list, candidates: dict[int, set[tuple[int, int]]]) -> None:
        """Adds the places of each text whose samples equal those of an item, CHUNK windows at a time."""
        cuts = [(t, starts[a : a + CHUNK], padded) for t, starts, padded in parts for a in range(0, len(starts), CHUNK)]
        while cuts:
            block, size = [], 0
            while cuts and (not block or size + len(cuts[-1][1]) <= CHUNK):
                block.append(cuts.pop())
                size += len(block[-1][1])
            view = np.concatenate([np.lib.stride_tricks.sliding_window_view(p, n)[starts] for _, starts, p in block])
            place = [(t, start) for t, starts, _ in block for start in starts.tolist()]
            for table, keys, row in zip(self.buckets[n], self.keys[n], self.signatures(view), strict=True):
                for w in np.flatnonzero(among(row, keys)).tolist():
                    t, start = place[w]
                    candidates.setdefault(t, set()).update((k, start) for k in table[int(row[w])])

    def _verified(self, words: list[str], places: set[tuple[int, int]]) -> list[tuple]:
        best: dict[int, tuple[int, int, int]] = {}
        exact = [(k, s) for k, s in places if words[s : s + len(self.items[k][1])] == self.items[k][1]]
        for k, start in sorted(exact, reverse=True):
            best[k] = (0, start, len(self.items[k][1]))
        for k, start in sorted(places):
            item = self.items[k][1]
            most = self.most[len(item)]
            run = words[start : start + len(item) + most]
            limit = min(most, best[k][0] - 1 if k in best else most)
            if limit < 0 or sum(map(self.sets[k].__contains__, run)) < len(item) - limit:
                continue
            if (Counter(item) & Counter(run)).total() < len(item) - limit:
                continue
            distance, size = nearest_prefix(item, run, limit)
            if distance <= limit:
                best[k] = (distance, start, size)
        return [
            (self.items[k][0], start, size, distance, 1 - distance / len(self.items[k][1]))
            for k, (distance, start, size) in sorted(best.items())
        ]


def item_blocks(benchmark: DataFrame, item_id: str, text: str) -> list[DataFrame]:
    """The items in blocks of about ``BLOCK_CHARS`` characters, by a hash of the item."""
    items = benchmark.select(F.col(item_id).alias("item_id"), F.col(text).alias("text")).where(F.col(text).isNotNull())
    size = items.agg(F.sum(F.length("text") + 1)).first()[0] or 0
    blocks = -(-size // BLOCK_CHARS)
    number = F.pmod(F.xxhash64("item_id", "text"), F.lit(max(1, blocks)))
    return [items.where(number == k).distinct() for k in range(blocks)]


def with_hits(
    docs: DataFrame, benchmark: DataFrame, text: str = "text", item_id: str = "item_id", item_text: str = "text",
    similarity: float = SIMILARITY, repetitions: int = REPETITIONS, samples: int = SAMPLES, hits: str = "hits",
) -> DataFrame:
    """All rows with ``hits``: array of (item_id, start, n_words, distance, similarity), empty if clean.

    A hit is a run of the document's words (lower case, runs of letters and digits) whose edit distance to
    the item is at most ``1 - similarity`` of the item's words; per item the nearest run found, of equal
    ones the first found. Exact copies are always found; others with the recall that ``repetitions`` give.
    Items with fewer than ``LEAST_WORDS`` words are found as they are only; a sign of a script without blanks is
    a word. Items without a word, or a NULL text, match nothing. A NULL or empty document is clean. Rows are judged one by one, so repeated rows get equal hits; other columns pass through, one
    named like ``hits`` is replaced. An empty benchmark leaves everything clean.
    """
    small_batches(docs.sparkSession)
    kind = dict(benchmark.dtypes)[item_id]
    schema = f"array<struct<{HIT.format(kind=kind).replace(' ', ':').replace(',:', ',')}>>"
    blocks = item_blocks(benchmark, item_id, item_text)
    column, before = F.array().cast(schema), free_name(docs, "__before")
    for k, block in enumerate(blocks):
        # About ``BLOCK_CHARS`` characters; the driver lets go of them before it reads the next block.
        items = [(r.item_id, words_of(r.text)) for r in sorted(block.collect(), key=lambda r: (str(r.item_id), r.text))]
        own = _search_column(F.col(text), Index(items, similarity, repetitions, samples), schema)
        column = own if k == 0 else F.concat(F.col(before), own)
        if k < len(blocks) - 1:
            docs = stored(docs.withColumn(before, column), "hits")
    return docs.withColumn(hits, column).drop(before)


def _search_column(text: Column, index: Index, schema: str) -> Column:
    @F.pandas_udf(schema)
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            parts = (texts.iloc[a : a + TEXTS].tolist() for a in range(0, len(texts), TEXTS))
            yield pd.Series(list(chain.from_iterable(map(index.search, parts))))
        give_back_memory()

    return run(text)


def matches(docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", **options) -> DataFrame:
    """One row per document row and item found in it."""
    found = with_hits(docs, benchmark, **options).select(F.col(doc_id).alias("doc_id"), F.explode("hits").alias("h"))
    return found.select("doc_id", "h.*")


def clean(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` that hold no item."""
    hits = free_name(docs, "__hits")
    return with_hits(docs, benchmark, hits=hits, **options).where(F.size(hits) == 0).drop(hits)
