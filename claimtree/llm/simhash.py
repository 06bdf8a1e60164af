"""SimHash near-duplicates: fingerprints, ball hashing, components.

Every distinct fingerprint emits all variants within half the radius. Two fingerprints are within the
radius exactly if they share a variant, so an equi-join on variants finds every link. A variant has at
most as many fingerprints as its ball has points (65 for radius 1), so no group can grow with the data.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from claimtree.llm.common import free_name, give_back_memory, small_batches, stored
from claimtree.llm.components import components

SHINGLE_WORDS, MAX_DISTANCE = 3, 2
SEED = 42
# Shingles whose bits are counted at once.
CHUNK = 1 << 16


def fingerprint(text: str | None, words: int = SHINGLE_WORDS) -> int:
    """Unsigned 64-bit fingerprint: a bit is set if it is set in over half of the shingles' hashes."""
    parts = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not parts:
        return 0
    ends = np.cumsum([len(p) + 1 for p in parts]) - 1
    joined = memoryview(b" ".join(parts))
    n = max(1, len(parts) - words + 1)
    starts = np.concatenate(([0], ends[: n - 1] + 1)).tolist()
    stops = ends[min(words, len(parts)) - 1 :].tolist()
    digest = xxhash.xxh64_intdigest
    counts = np.zeros(64, np.int64)
    for at in range(0, n, CHUNK):
        cut = zip(starts[at : at + CHUNK], stops[at : at + CHUNK], strict=True)
        hashes = np.array([digest(joined[a:b], SEED) for a, b in cut], "<u8")
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(counts * 2 > n, bitorder="little").view("<u8")[0])


def fingerprints(text: Column, words: int = SHINGLE_WORDS) -> Column:
    """The fingerprint as a signed long; A-Z are lower-cased, words are runs without ASCII white space."""

    @F.pandas_udf("long")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series(np.array([fingerprint(t, words) for t in texts], "<u8").view("<i8"))
        give_back_memory()

    return run(text)


def masks(bits: int) -> list[int]:
    """All signed 64-bit masks with at most this many bits set."""
    found = [sum(1 << k for k in chosen) for n in range(bits + 1) for chosen in combinations(range(64), n)]
    return [m - (1 << 64) if m >> 63 else m for m in found]


def fingerprint_links(prints: DataFrame, column: str, max_distance: int = MAX_DISTANCE) -> DataFrame:
    """Links (a, b), a < b, that connect all distinct fingerprints at ``max_distance`` bits or fewer.

    The distance must be even: then all fingerprints of a variant are within it of each other, and a star
    from the smallest connects them; no pair is lost from the components.
    """
    if max_distance < 0 or max_distance % 2:
        raise ValueError("max_distance must be even")
    ball = F.array(*[F.lit(m).cast("bigint") for m in masks(max_distance // 2)])
    distinct = prints.select(F.col(column).alias("a")).distinct()
    # A task's fingerprints become 65 times as many rows, so small shuffles may not be merged before.
    distinct = distinct.repartition(int(prints.sparkSession.conf.get("spark.sql.shuffle.partitions")), F.hash("a"))
    variants = distinct.select("a", F.explode(F.transform(ball, lambda m: F.col("a").bitwiseXOR(m))).alias("variant"))
    # At most one fingerprint per point of the ball meets in a variant.
    met = variants.groupBy("variant").agg(F.collect_set("a").alias("all")).where(F.size("all") > 1)
    star = met.select(F.array_min("all").alias("a"), F.explode("all").alias("b")).where("a < b").distinct()
    return star.where(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= max_distance)


def near_duplicates(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
    words: int = SHINGLE_WORDS, max_distance: int = MAX_DISTANCE,
) -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, ``fingerprint`` (signed long), ``component_id``.

    Documents are linked if their fingerprints differ in at most ``max_distance`` bits; ``component_id`` is
    the smallest id that links reach, the document's own included. A NULL or empty text, or one without a
    word, has fingerprint zero and is linked like any other. Repeated rows are all returned. A NULL id is
    returned, but is nobody's component unless all ids of the component are NULL. Other columns are not used.
    """
    return _labelled(docs, doc_id, text, words, max_distance).select("doc_id", "fingerprint", "component_id")


def _labelled(
    docs: DataFrame, doc_id: str, text: str, words: int = SHINGLE_WORDS, max_distance: int = MAX_DISTANCE, **more: Column,
) -> DataFrame:
    """The rows of ``near_duplicates`` with the ``root`` fingerprint of their component and the columns ``more``."""
    small_batches(docs.sparkSession)
    more = [c.alias(name) for name, c in more.items()]
    prints = docs.select(F.col(doc_id).alias("doc_id"), fingerprints(F.col(text), words).alias("fingerprint"), *more)
    prints = stored(prints, "fingerprints")
    links = fingerprint_links(prints, "fingerprint", max_distance)
    groups = components(links)  # node, root: fingerprints that have a link
    first = prints.groupBy("fingerprint").agg(F.min("doc_id").alias("first"))
    nodes = first.join(groups, F.col("fingerprint") == F.col("node"), "left")
    nodes = nodes.select("fingerprint", "first", F.coalesce("root", "fingerprint").alias("root"))
    nodes = stored(nodes, "fingerprint-roots")
    smallest = nodes.groupBy("root").agg(F.min("first").alias("component_id"))
    labelled = nodes.join(smallest, "root").select(F.col("fingerprint").alias("fp"), "root", "component_id")
    return prints.join(labelled, F.col("fingerprint") == F.col("fp")).drop("fp")


def hex_digits(fingerprint: Column) -> Column:
    return F.lpad(F.lower(F.hex(fingerprint)), 16, "0")


def one_of_each(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """One row of each component of ``docs``, with its smallest id; repeated rows of it become one.

    Of several texts with that id in one component the one with the smallest fingerprint stays. Rows with a NULL
    id stay, as they cannot be told apart.
    """
    mark = F.xxhash64(F.col(text))
    found = _labelled(docs.select(doc_id, text), doc_id, text, mark=mark, **options)
    found = found.where(F.col("doc_id") == F.col("component_id"))
    keep = found.groupBy("root").agg(F.min(F.struct("doc_id", "fingerprint", "mark")).alias("k"))
    own, kept_id, kept_mark = (free_name(docs, stem) for stem in ("__mark", "__keep", "__kept_mark"))
    keep = keep.select(F.col("k.doc_id").alias(kept_id), F.col("k.mark").alias(kept_mark))
    marked = docs.withColumn(own, mark)
    same = (F.col(doc_id) == F.col(kept_id)) & (F.col(own) == F.col(kept_mark))
    kept = marked.join(keep, same, "left_semi").dropDuplicates([doc_id, own]).drop(own)
    return kept.unionByName(docs.where(F.col(doc_id).isNull()))
