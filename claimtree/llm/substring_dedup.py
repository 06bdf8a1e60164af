"""Repeated passages: sliding spans of sentences, a global join, removal of all but the first.

Every run of ``SPAN`` consecutive sentences is hashed. Hashes that occur more than once are found by a
count with partial sums, so a passage of any frequency is one row a task before the shuffle, and joined
back to their places. A sentence is removed if a repeated span other than its first occurrence covers it.
"""

from __future__ import annotations

import re
import zlib

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from claimtree.llm.common import small_batches, stored

SPAN = 3
# Covered stretches with fewer words stay, as short phrases repeat without being copied, unless they hold ``SPAN``
# whole sentences or are the whole text.
LEAST_WORDS = 20
# A sentence is cut behind the word with the smallest hash, the last one of equals, of every WINDOW of its words.
# A window decides by its own words only, so a copy has the same units wherever it stands, save for at most WINDOW
# words at a cut-off end. No unit has more words, so more than 4 * WINDOW words in a row hold three whole units.
WINDOW = 12
SENTENCE = re.compile(r"[^\n]*?(?:[.!?]+(?=\s)\s*|\n\s*|\Z)")
WORD_AND_SPACE = re.compile(r"\s*\S+\s*|\s+")
# A NULL id comes after all others.
LAST = 2**63 - 1


class WordHashes(dict):
    """Hash of a word whatever its case and white space, kept for short words, of which there are few."""

    def __missing__(self, word: str) -> int:
        value = zlib.crc32(word.strip().lower().encode("utf-8", "surrogatepass"))
        if len(word) <= 24:
            if len(self) >= 50_000:
                self.clear()
            self[word] = value
        return value


HASHES = WordHashes()


def sentences(text: str) -> list[str]:
    """Consecutive pieces that together are the text; each keeps the white space behind it."""
    found = [s for s in SENTENCE.findall(text) if s]
    parts = [WORD_AND_SPACE.findall(s) for s in found]
    counts = np.array([len(p) for p in parts], int)
    if not (counts >= WINDOW).any():
        return found
    words = [w for p in parts for w in p]
    n, last = len(words), np.cumsum(counts) - 1
    stops = np.zeros(n, bool)
    stops[last] = True
    # Hash and place from the end in one number; the smallest of a window, by windows of 2, 4, 8 and 12 words.
    low = (np.array([HASHES[w] for w in words], "<u8") << 32) | np.arange(n - 1, -1, -1, dtype="<u8")
    for step in (1, 2, 4, WINDOW - 8):
        low = np.minimum(low[:-step], low[step:])
    # A window that begins fewer than WINDOW words before the end of its sentence leaves it.
    low = low[(np.repeat(last, counts) - np.arange(n) >= WINDOW - 1)[: len(low)]]
    stops[n - 1 - (low & 0xFFFFFFFF).astype(int)] = True
    ends = np.cumsum([len(w) for w in words])[stops].tolist()
    return [text[a:b] for a, b in zip([0, *ends], ends)]


def span_hashes(text: str | None, span: int = SPAN) -> np.ndarray:
    """Hash of each run of ``span`` sentences; of a shorter text that has words, the hash of the whole."""
    normal = [" ".join(s.lower().split()) for s in sentences(text or "")]
    if not any(normal):
        return np.zeros(0, "<i8")
    data = [s.encode("utf-8", "surrogatepass") for s in normal]
    runs = range(max(1, len(data) - span + 1))
    return np.array([xxhash.xxh64_intdigest(b"\n".join(data[a : a + span])) for a in runs], "<u8").view("<i8")


def without(text: str, starts: list[int], span: int = SPAN, least_words: int = LEAST_WORDS) -> tuple[str, int]:
    """The text without the sentences that the spans cover, and how many were removed."""
    units = sentences(text)
    covered = np.zeros(len(units) + 1, bool)
    for a in starts:
        covered[a : min(a + span, len(units))] = True
    # How many sentences end at or before each edge between units, and whether one ends there.
    ends = np.cumsum([len(s) for s in SENTENCE.findall(text) if s])
    places = np.cumsum([0, *map(len, units)])
    before = np.searchsorted(ends, places, "right")
    cut_off = ~np.isin(places, [0, *ends])
    kept, removed, begin = [], 0, 0
    edges = np.flatnonzero(np.diff(np.concatenate(([False], covered)))).tolist()
    for first, stop in zip(edges[::2], edges[1::2], strict=True):
        kept.extend(units[begin:first])
        whole = stop - first == len(units) or before[stop] - before[first] - cut_off[first] >= span
        if not whole and sum(len(u.split()) for u in units[first:stop]) < least_words:
            kept.extend(units[first:stop])
        else:
            removed += stop - first
        begin = stop
    kept.extend(units[begin:])
    return "".join(kept).strip() if removed else text, removed


def repeated_places(docs: DataFrame, span: int = SPAN) -> DataFrame:
    """(key, mark, position) of every span that is not the first of its hash, from (key, mark, text).

    Spans are ordered by key, mark and position.
    """

    @F.pandas_udf("array<long>")
    def run(texts: pd.Series) -> pd.Series:
        return pd.Series([span_hashes(t, span) for t in texts])

    spans = docs.select("key", "mark", F.posexplode(run("text")).alias("position", "hash"))
    # Mark and position in one number: one row of three longs per span.
    spans = spans.select("hash", "key", (F.shiftleft("mark", 32) + F.col("position")).alias("place"))
    spans = stored(spans, "spans")
    often = spans.groupBy(F.col("hash").alias("_hash")).agg(F.count("*").alias("_n"), F.min("key").alias("first_key"))
    # Stored, so that the join meets two plain shuffles, of which a hot hash's can be split.
    often = stored(often.where("_n > 1").drop("_n"), "often")
    repeats = stored(spans.join(often, F.col("hash") == F.col("_hash")).drop("_hash"), "repeats")
    # Inside the first document the first place counts.
    own = repeats.where("key = first_key")
    first = own.groupBy(F.col("hash").alias("_hash")).agg(F.min("place").alias("first_place"))
    own = own.join(stored(first, "first-places"), F.col("hash") == F.col("_hash")).where("place > first_place")
    rest = repeats.where("key <> first_key").select("key", "place").union(own.select("key", "place"))
    return rest.select("key", F.shiftright("place", 32).alias("mark"), F.col("place").bitwiseAND(2**32 - 1).cast("int").alias("position"))


def deduplicate(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", span: int = SPAN,
    least_words: int = LEAST_WORDS, removed: str = "removed_sentences",
) -> DataFrame:
    """All rows with repeated passages taken out of ``text``, and the number of sentences as ``removed``.

    The first occurrence, by ``doc_id`` (an integer; NULL comes last) and place, stays whole; in all others the
    sentences it covers go: stretches of at least ``least_words`` words or ``span`` whole sentences, and whole
    texts. A copy of a whole document becomes empty, however short. ``removed`` counts the units of ``sentences``. A text with fewer sentences than ``span`` is one span. A NULL text stays NULL. Rows with the same
    id and text are one document and are returned alike; rows with the same id and another text are different
    ones. Other columns pass through; one named like ``removed`` is replaced.
    """
    small_batches(docs.sparkSession)
    kept = [c for c in docs.columns if c != removed]
    own = F.struct(*[F.col(c).alias(c) for c in kept])
    key = F.coalesce(F.col(doc_id).cast("long"), F.lit(LAST))
    mark = F.xxhash64(F.col(text)).bitwiseAND(2**31 - 1)
    # Repeated rows give repeated places, which are never after themselves and so remove nothing.
    keyed = docs.select(key.alias("key"), mark.alias("mark"), own.alias("row"))
    places = repeated_places(keyed.select("key", "mark", F.col("row")[text].alias("text")), span)
    # As many numbers as the document has sentences.
    places = places.groupBy("key", "mark").agg(F.collect_set("position").alias("__starts"))

    @F.pandas_udf("text string, removed int")
    def cut(texts: pd.Series, starts: pd.Series) -> pd.DataFrame:
        rows = [(t, 0) if s is None or t is None else without(t, s, span, least_words) for t, s in zip(texts, starts, strict=True)]
        return pd.DataFrame(rows, columns=["text", "removed"])

    joined = keyed.join(places, ["key", "mark"], "left").withColumn("__cut", cut(F.col("row")[text], F.col("__starts")))
    values = [F.col("__cut.text").alias(text) if c == text else F.col("row")[c].alias(c) for c in kept]
    return joined.select(*values, F.col("__cut.removed").alias(removed))
