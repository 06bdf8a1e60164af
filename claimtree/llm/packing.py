"""Best-fit packing planned over the histogram of lengths.

The plan needs only how many pieces there are of each length, at most ``capacity`` numbers, so its size
and the driver's work do not depend on the number of documents. It places lengths from long to short,
each into the fullest open sequences that still have room, and keeps equal sequences as ranges of numbers.
Pieces then take the planned slots by joining on their rank within their length.
"""

from __future__ import annotations

import bisect
import os
from array import array
from collections import defaultdict
from collections.abc import Iterator
from functools import lru_cache
from unicodedata import is_normalized

import numpy as np
import pandas as pd
import public_tokenizers
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window, functions as F
from tokenizers import Tokenizer

from claimtree.llm.common import give_back_memory, small_batches, stored

# Tasks already run beside each other.
os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

CAPACITY = 4096
# Fixed value: the id that ends every document.
END_ID = 1
VOCABULARY = "word_bpe_49k.json"
# Words whose ids a task remembers; beyond it the memory starts anew.
REMEMBERED = 300_000
# Ids that a task gathers before it passes them on.
SENT_BYTES = 1 << 22
# Signs that form a token run of their own after a word; an apostrophe may not.
SIGNS = '!"#$%&()*+,-./:;<=>?@[\\]^_`{|}~'
# Letters from here on are left to the tokenizer, whose tables of letters may be older.
SURE = "\u0530"


def is_plain(word: str) -> bool:
    """Letters that normalising leaves as they are: composed, and in lower case."""
    if word.isascii():
        return word.isalpha() and word.islower()
    return max(word) < SURE and word.isalpha() and word == word.lower() and is_normalized("NFC", word)


def _byte_signs() -> dict[int, int]:
    """The public byte-level mapping: printable Latin-1 signs stand for themselves, other bytes from 256 on."""
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    return {b: 256 + k for k, b in enumerate(b for b in range(256) if b not in shown)}


BYTE_SIGNS = _byte_signs()
PIECES = "piece int, start long, length long, ids binary"
PLAN = "length long, rank_from long, rank_to long, first_sequence long, per_sequence long, base long"


class WordIds(dict):
    """Ids of a text as little-endian unsigned 32-bit numbers; a dictionary of the parts seen so far.

    The vocabulary's splitting never crosses white space, so the ids of a text are those of its parts
    between blanks. A part of nothing but letters is one word to the splitting, so its merges are asked for
    directly; such a word with signs behind it is split between them anyway; all others are encoded in full.
    """

    def __init__(self, path: str):
        super().__init__()
        self.encoder = Tokenizer.from_file(path)
        self.merges = self.encoder.model

    def __missing__(self, part: str) -> bytes:
        if is_plain(part):
            word = part if part.isascii() else part.encode().decode("latin-1").translate(BYTE_SIGNS)
            found = [t.id for t in self.merges.tokenize(word)]
        elif (word := part.rstrip(SIGNS)) != part and is_plain(word):
            self[part] = ids = self[word] + self[part[len(word) :]]
            return ids
        else:
            found = self.encoder.encode(part, add_special_tokens=False).ids
        self[part] = ids = array("I", found).tobytes()
        return ids

    def encode(self, text: str) -> bytes:
        if "<|" not in text:  # lower-casing A-Z changes no id, but could spell a special token
            text = text.lower() if text.isascii() else text.encode().lower().decode()
        if len(self) > REMEMBERED:
            self.clear()
        return b"".join(map(self.__getitem__, text.replace("\n", " ").split(" ")))


@lru_cache(maxsize=2)
def word_ids(path: str) -> WordIds:
    return WordIds(path)


def cut_pieces(docs: DataFrame, doc_id: str, text: str, path: str | None, capacity: int) -> DataFrame:
    """Pieces with the task that made them and their rank within their length in that task."""
    kind = dict(docs.dtypes)[doc_id]
    schema = f"doc_id {kind}, {PIECES}, part int, part_rank long"

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encoder = word_ids(path or public_tokenizers.path(VOCABULARY))
        columns = ["doc_id", "piece", "start", "length", "ids", "part", "part_rank"]
        part, seen = TaskContext.get().partitionId(), defaultdict(int)
        end, size = np.asarray([END_ID], "<u4").tobytes(), 4 * capacity
        rows, held = [], 0
        for batch in batches:
            for key, body in zip(batch["doc_id"], batch["text"], strict=True):
                data = encoder.encode(body or "") + end
                for piece, at in enumerate(range(0, len(data), size)):
                    ids = data[at : at + size]
                    length = len(ids) // 4
                    rows.append((key, piece, at // 4, length, ids, part, seen[length]))
                    seen[length] += 1
                if (held := held + len(data)) >= SENT_BYTES:
                    yield pd.DataFrame(rows, columns=columns)
                    rows, held = [], 0
        yield pd.DataFrame(rows, columns=columns)
        encoder.clear()
        give_back_memory()

    return docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")).mapInPandas(run, schema)


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, int, int, int, int, int]]:
    """Best fit, longest first, over counts: rows of ``PLAN``.

    The pieces ``rank_from <= rank < rank_to`` of a length go to sequences from ``first_sequence`` on,
    ``per_sequence`` into each, the first at offset ``base``. The fullest sequence with room takes as many
    equal pieces as it can hold, since it is then fuller still: this is best fit piece by piece.
    """
    if any(not 0 < length <= capacity for length in counts):
        raise ValueError("every length must be from 1 to the capacity")
    rows, opened, sequences = [], [], 0
    ranges: dict[int, list[tuple[int, int]]] = defaultdict(list)  # room left -> ranges of sequences

    def leave(room: int, first: int, count: int) -> None:
        if room and count:
            if not ranges[room]:
                bisect.insort(opened, room)
            ranges[room].append((first, count))

    for length in sorted(counts, reverse=True):
        rank, left = 0, counts[length]

        def place(room: int, first: int, count: int) -> int:
            """Fills up to ``count`` equal sequences from ``first`` on; returns how many it touched."""
            nonlocal rank, left
            each, base = room // length, capacity - room
            full = min(count, left // each)
            if full:
                rows.append((length, rank, rank + full * each, first, each, base))
                rank, left = rank + full * each, left - full * each
                leave(room - each * length, first, full)
            if left and full < count:
                rows.append((length, rank, rank + left, first + full, left, base))
                leave(room - left * length, first + full, 1)
                rank, left, full = rank + left, 0, full + 1
            return full

        while left:
            at = bisect.bisect_left(opened, length)
            if at == len(opened):
                each = capacity // length
                sequences += (new := -(-left // each))
                place(capacity, sequences - new, new)
                continue
            room = opened[at]
            first, count = ranges[room].pop()
            if not ranges[room]:
                opened.pop(at)
            used = place(room, first, count)
            leave(room, first + used, count - used)
    return rows


def place(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Adds ``sequence_id`` and ``offset`` to rows with ``length``, ``part`` and ``part_rank``.

    Ranks within a length are the rank in the task plus the rows of the tasks before it, so no length, be
    it a third of all rows, is ever sorted or held by one task.
    """
    spark = pieces.sparkSession
    counts = pieces.groupBy("length", "part").agg(F.count("*").alias("rows"))
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.withColumn("before", F.coalesce(F.sum("rows").over(before), F.lit(0)))
    counts = stored(counts, "lengths")
    # At most one row per length, so at most ``capacity`` rows.
    histogram = {r.length: r.rows for r in counts.groupBy("length").agg(F.sum("rows").alias("rows")).collect()}
    slots = spark.createDataFrame(plan(histogram, capacity), PLAN).withColumnRenamed("length", "_length")
    ahead = counts.select(F.col("length").alias("_l"), F.col("part").alias("_p"), "before")
    # As many rows as tasks times lengths: that grows, so it is not broadcast whatever its files' size.
    # Each task holds those of its share of tasks and lengths, and the ids are not sorted.
    ahead = ahead.hint("shuffle_hash")
    ranked = pieces.join(ahead, (F.col("length") == F.col("_l")) & (F.col("part") == F.col("_p")))
    ranked = ranked.withColumn("_rank", F.col("part_rank") + F.col("before"))
    # The plan's rows depend on the lengths that occur, not on how many documents have them.
    met = ranked.join(F.broadcast(slots), (F.col("length") == F.col("_length")) & F.expr("_rank >= rank_from AND _rank < rank_to"))
    inside = F.col("_rank") - F.col("rank_from")
    return met.withColumns({
        "sequence_id": F.col("first_sequence") + F.floor(inside / F.col("per_sequence")).cast("long"),
        "offset": F.col("base") + F.pmod(inside, F.col("per_sequence")) * F.col("length"),
    }).drop("_l", "_p", "before", "_rank", *slots.columns, "part", "part_rank")


def token_pieces(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", path: str | None = None, capacity: int = CAPACITY
) -> DataFrame:
    """Token ids of all documents in pieces of at most ``capacity``, written once.

    ``doc_id``, ``piece`` (from 0), ``start`` (ids of the document before it), ``length``, ``ids``
    (little-endian unsigned 32-bit), and ``part`` and ``part_rank`` for ``place``. A NULL text is an empty
    one: its only id is the end id. Every row of ``docs`` is a document, repeated rows and NULL ids too.
    Other columns are not used; an empty table gives no piece.
    """
    small_batches(docs.sparkSession)
    return stored(cut_pieces(docs, doc_id, text, path, capacity), "pieces")


def pack(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", path: str | None = None, capacity: int = CAPACITY) -> DataFrame:
    """Pieces with their ids and places: ``token_pieces`` with ``sequence_id`` and ``offset``."""
    return place(token_pieces(docs, doc_id, text, path, capacity), capacity)


def checksum(ids: Column) -> Column:
    return F.crc32(ids)
