"""Source divergence audit: how far the word use of each source is from that of its language and of other sources.

Two passes over the texts. The first counts documents per term; the terms kept of each language, sorted, become
minimal acyclic transducers, which give every term its lexicographic ordinal. The second streams the terms of
the texts through the transducers and counts ordinals per source. Ordinals then stand for terms in all joins and
break ties; only the terms that a report names are spelled again, by the transducers read backwards.

The vocabulary grows with the corpus, so no process holds all of it. It is cut into transducers of a bounded
number of terms, built by the tasks that hold the sorted terms and written to the shared folder. A counting task
sorts the terms of a stretch of text, so that each transducer is opened once a stretch, and keeps a few open.
All arithmetic is on integers.
"""

from __future__ import annotations

import bisect
from collections import Counter, OrderedDict
from collections.abc import Iterable, Iterator, Mapping
from functools import lru_cache
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.dataset
from pyspark.sql import Column, DataFrame, Window, functions as F

from claimtree.llm.common import give_back_memory, shared_files, small_batches, stored
from claimtree.session import scratch_path

# A term is a run of ASCII letters and signs beyond ASCII; A-Z are lower-cased, nothing else. In UTF-8 all
# bytes of a sign beyond ASCII are 0x80 or more, so bytes tell where terms end.
LETTERS = bytes(b if b >= 0x80 or chr(b).isalpha() else 0x20 for b in range(256)).lower()
MIN_DOCUMENTS, SMOOTH, SCALE, TOP = 30, 5, 10**9, 50
# Terms of one transducer, and transducers that a task keeps open.
SHARD_TERMS, OPEN_SHARDS = 1 << 16, 8
# Different terms, and bytes of text, after which a task passes its counts on.
COUNTED, READ = 300_000, 1 << 26
# Cells (term, source) that one group of the pair part holds, and pairs of sources that it returns.
CELLS, PAIRS = 1 << 16, 1 << 18


def terms_of(text: bytes) -> list[bytes]:
    """The terms of a text in UTF-8; they stay bytes until they are looked up."""
    return text.translate(LETTERS).split()


def texts_of(batch: pa.RecordBatch) -> list[bytes]:
    return batch.column("text").cast(pa.binary()).to_pylist()


class Transducer:
    """A minimal acyclic automaton whose paths are the terms; a path's edges add up to the term's ordinal.

    ``edges[state]`` maps a sign to (next state, terms passed by). States with equal rests are one state.
    """

    def __init__(self, edges: list[dict[str, tuple[int, int]]], final: list[bool]):
        self.edges, self.final = edges, final  # the last state is the root

    @classmethod
    def build(cls, terms: Iterable[str]) -> Transducer:
        """From different terms in ascending order."""
        edges, final, sizes, known = [], [], [], {}

        def close(ends: bool, out: list[tuple[str, int]]) -> int:
            """The one state with these ways on; its size is the number of terms behind it."""
            shape = (ends, *out)
            if shape not in known:
                size, hops = int(ends), {}
                for sign, target in out:
                    hops[sign] = (target, size)
                    size += sizes[target]
                known[shape] = len(edges)
                edges.append(hops)
                final.append(ends)
                sizes.append(size)
            return known[shape]

        last, path = "", [(False, [])]  # states along the last term, still open
        for term in chain(terms, [""]):
            shared = 0
            for x, y in zip(last, term, strict=False):
                if x != y:
                    break
                shared += 1
            while len(path) > shared + 1:
                state = close(*path.pop())
                path[-1][1].append((last[len(path) - 1], state))
            path.extend((False, []) for _ in term[shared:])
            if term:
                path[-1] = (True, path[-1][1])
            last = term
        close(*path[0])
        return cls(edges, final)

    def ordinal(self, term: str) -> int:
        """Place of the term among all terms, or -1."""
        state, passed = len(self.edges) - 1, 0
        for sign in term:
            hop = self.edges[state].get(sign)
            if hop is None:
                return -1
            state, more = hop
            passed += more
        return passed if self.final[state] else -1

    def spell(self, ordinal: int) -> str:
        state, signs = len(self.edges) - 1, []
        while not (self.final[state] and ordinal == 0):
            sign, (state, passed) = max((e for e in self.edges[state].items() if e[1][1] <= ordinal), key=lambda e: e[1][1])
            ordinal -= passed
            signs.append(sign)
        return "".join(signs)

    def packed(self) -> dict[str, bytes]:
        flat = [(ord(sign), *hop) for hops in self.edges for sign, hop in hops.items()]
        sign, target, passed = np.array(flat, "<u4").reshape(-1, 3).T
        columns = {"degree": [len(hops) for hops in self.edges], "sign": sign, "target": target, "passed": passed}
        return {"final": np.array(self.final, "u1").tobytes()} | {k: np.array(x, "<u4").tobytes() for k, x in columns.items()}

    @classmethod
    def unpacked(cls, row: dict) -> Transducer:
        degree, sign, target, passed = (np.frombuffer(row[k], "<u4").tolist() for k in ("degree", "sign", "target", "passed"))
        hops = zip(map(chr, sign), zip(target, passed, strict=True), strict=True)
        edges = [dict(next(hops) for _ in range(n)) for n in degree]
        return cls(edges, np.frombuffer(row["final"], "u1").astype(bool).tolist())


SHARD = "lang string, first string, terms long, final binary, degree binary, sign binary, target binary, passed binary"


def document_counts(docs: DataFrame) -> DataFrame:
    """(lang, term, docs): documents of each language that hold the term; counted in the task first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counted, read = {}, 0
        for batch in batches:
            for lang, text in zip(batch.column("lang").to_pylist(), texts_of(batch), strict=True):
                counted.setdefault(lang, Counter()).update(set(terms_of(text)))
                read += len(text)
                if read > READ or sum(map(len, counted.values())) > COUNTED:
                    yield from _counts({(lang,): c for lang, c in counted.items()}, ["lang"], "term", pa.string(), "docs")
                    counted, read = {}, 0
        yield from _counts({(lang,): c for lang, c in counted.items()}, ["lang"], "term", pa.string(), "docs")
        give_back_memory()

    counted = docs.select("lang", "text").mapInArrow(run, "lang string, term string, docs long")
    return counted.groupBy("lang", "term").agg(F.sum("docs").alias("docs"))


def _counts(counted: dict[tuple, dict], keys: list[str], item: str, kind: pa.DataType, count: str) -> Iterator[pa.RecordBatch]:
    for key, counter in counted.items():
        if counter:
            fixed = [pa.repeat(pa.scalar(k, pa.string()), len(counter)) for k in key]
            columns = [*fixed, pa.array(counter.keys(), kind), pa.array(counter.values(), pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, [*keys, item, count])


class Vocabulary:
    """The stored transducers of all languages; tasks read them from the shared folder when they need them.

    ``index`` has one row per transducer: ``lang``, ``first`` (its first term), ``base`` (ordinals before it),
    ``terms`` and the ``file`` that holds it.
    """

    def __init__(self, index: DataFrame, index_path: str):
        self.index, self.index_path = index, index_path

    @classmethod
    def of_terms(cls, kept: DataFrame, shard_terms: int = SHARD_TERMS) -> Vocabulary:
        """From stored rows (lang, term), each once; the sort is the only shuffle."""
        spark = kept.sparkSession

        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            held: list[str] = []
            lang = None

            def shard() -> pd.DataFrame:
                return pd.DataFrame([{"lang": lang, "first": held[0], "terms": len(held), **Transducer.build(held).packed()}])

            for batch in batches:
                for own, term in zip(batch["lang"], batch["term"], strict=True):
                    if held and (own != lang or len(held) >= shard_terms):
                        yield shard()
                        held = []
                    lang = own
                    held.append(term)
            if held:
                yield shard()
            give_back_memory()

        in_order = kept.select("lang", "term").repartitionByRange("lang", "term").sortWithinPartitions("lang", "term")
        path = scratch_path(spark, "transducers")
        in_order.mapInPandas(run, SHARD).write.option("maxRecordsPerFile", 1).parquet(path)
        rows = spark.read.schema(SHARD).parquet(path).select("lang", "first", "terms", F.col("_metadata.file_path").alias("file"))
        # As many rows as transducers: one for tens of thousands of terms.
        before = Window.partitionBy("lang").orderBy("first").rowsBetween(Window.unboundedPreceding, -1)
        rows = rows.withColumn("base", F.coalesce(F.sum("terms").over(before), F.lit(0)))
        index_path = scratch_path(spark, "transducer-index")
        rows.write.parquet(index_path)
        return cls(spark.read.schema(rows.schema).parquet(index_path), index_path)

    def __getstate__(self):
        return self.index_path

    def __setstate__(self, path: str):
        self.index, self.index_path = None, path

    def reader(self) -> Reader:
        return reader(self.index_path)


class Reader:
    """A task's view of the vocabulary, with the transducers used last kept open."""

    def __init__(self, index_path: str):
        store, path = shared_files(index_path)
        self.shards: dict[str, list[tuple[str, int, str]]] = {}
        index = pyarrow.dataset.dataset(path, filesystem=store, format="parquet").to_table()
        for row in index.to_pylist():
            self.shards.setdefault(row["lang"], []).append((row["first"], row["base"], row["file"]))
        for rows in self.shards.values():
            rows.sort()
        self.open: OrderedDict[str, Transducer] = OrderedDict()

    def transducer(self, file: str) -> Transducer:
        if file not in self.open:
            store, path = shared_files(file)
            self.open[file] = Transducer.unpacked(pyarrow.dataset.dataset(path, filesystem=store, format="parquet").to_table().to_pylist()[0])
            if len(self.open) > OPEN_SHARDS:
                self.open.popitem(last=False)
        self.open.move_to_end(file)
        return self.open[file]

    def ordinals(self, lang: str, terms: Iterable[bytes], known: Mapping[bytes, int]) -> dict[bytes, int]:
        """The terms' ordinals, -1 for those that are not kept; ``known`` are some looked up before, of this language."""
        found = {term: known.get(term) for term in terms}
        shards = self.shards.get(lang, [])
        firsts = [first for first, *_ in shards]
        for term in sorted(term for term, own in found.items() if own is None):
            text, own = term.decode(), -1
            at = bisect.bisect_right(firsts, text) - 1
            if at >= 0:
                own = self.transducer(shards[at][2]).ordinal(text)
            found[term] = own + shards[at][1] if own >= 0 else -1
        return found

    def spell(self, lang: str, ordinal: int) -> str:
        shards = self.shards[lang]
        _, base, file = shards[bisect.bisect_right([base for _, base, _ in shards], ordinal) - 1]
        return self.transducer(file).spell(ordinal - base)


@lru_cache(maxsize=1)
def reader(index_path: str) -> Reader:
    return Reader(index_path)


def ordinal_counts(docs: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """(lang, source, ordinal, n): occurrences of each kept term, where there are any."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        view = vocabulary.reader()
        counted: dict[tuple[str, str], Counter] = {}
        looked_up: dict[str, dict[bytes, int]] = {}  # by the last passing on: as many terms as that held
        read = 0

        def flush() -> Iterator[pa.RecordBatch]:
            before = dict(looked_up)
            looked_up.clear()
            for lang in sorted({lang for lang, _ in counted}):
                own = {key: c for key, c in counted.items() if key[0] == lang}
                ordinals = looked_up[lang] = view.ordinals(lang, set().union(*own.values()), before.pop(lang, {}))
                kept = {key: {at: n for t, n in c.items() if (at := ordinals[t]) >= 0} for key, c in own.items()}
                yield from _counts(kept, ["lang", "source"], "ordinal", pa.int64(), "n")

        for batch in batches:
            columns = [batch.column("lang").to_pylist(), batch.column("source").to_pylist(), texts_of(batch)]
            for lang, source, text in zip(*columns, strict=True):
                counted.setdefault((lang, source), Counter()).update(terms_of(text))
                read += len(text)
                if read > READ or sum(map(len, counted.values())) > COUNTED:
                    yield from flush()
                    counted, read = {}, 0
        yield from flush()
        give_back_memory()

    counted = docs.select("lang", "source", "text").mapInArrow(run, "lang string, source string, ordinal long, n long")
    return counted.groupBy("lang", "source", "ordinal").agg(F.sum("n").alias("n"))


def share(n: Column, total: Column, terms: Column, smooth: int = SMOOTH, scale: int = SCALE) -> Column:
    """``1 + floor(scale * (n + smooth) / (total + smooth * terms))``, exact; ``terms`` is at least 1."""
    over = (n + smooth).cast("decimal(20,0)") * F.lit(scale).cast("decimal(12,0)")
    under = F.greatest(total + smooth * terms, F.lit(1)).cast("decimal(20,0)")
    return F.call_function("div", over, under) + 1


def term_part(counts: DataFrame, groups: DataFrame, vocabulary: Vocabulary, top: int, smooth: int, scale: int) -> DataFrame:
    """Of every group the ``top`` terms that it uses more than its language does."""
    totals = groups.groupBy("lang").agg(F.sum("total").alias("lang_total"))
    wide = groups.join(totals.withColumnRenamed("lang", "_l"), F.col("lang") == F.col("_l")).drop("_l")
    wide = wide.select(F.col("lang").alias("_l"), F.col("source").alias("_s"), "terms", "total", "lang_total")
    every = counts.withColumn("all", F.sum("n").over(Window.partitionBy("lang", "ordinal")))
    met = every.join(wide, (F.col("lang") == F.col("_l")) & (F.col("source") == F.col("_s")))
    p = share(F.col("n"), F.col("total"), F.col("terms"), smooth, scale)
    q = share(F.col("all"), F.col("lang_total"), F.col("terms"), smooth, scale)
    over = met.select("lang", "source", "ordinal", (p - q).alias("value")).where("value > 0")
    # Ordinals are in the order of the terms; each task sends on at most ``top`` rows of a group.
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "ordinal")
    best = over.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)

    def spelled(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        view = vocabulary.reader()
        for batch in batches:
            batch["item"] = [view.spell(lang, at) for lang, at in zip(batch["lang"], batch["ordinal"], strict=True)]
            yield batch.drop(columns="ordinal")

    named = best.mapInPandas(spelled, "lang string, source string, value long, rank int, item string")
    return named.select("lang", "source", F.lit("term").alias("part"), "item", "value", "rank")


def pair_part(counts: DataFrame, groups: DataFrame, smooth: int, scale: int, cells: int = CELLS, pairs: int = PAIRS) -> DataFrame:
    """Of every two sources of a language the sum over its kept terms of the difference of their shares.

    The terms of a language are cut into runs of ordinals, its sources into stripes, so that a group holds a
    bounded number of cells and returns a bounded number of partial sums. Every kept term occurs in some source,
    so the rows of a run name all of its terms.
    """
    sizes = groups.groupBy("lang").agg(F.count("*").alias("sources")).where("sources > 1")
    sizes = sizes.withColumns({
        "run": F.greatest(F.lit(1), F.floor(F.lit(cells) / F.col("sources"))).cast("bigint"),
        "stripe_size": F.greatest(F.lit(1), F.floor(F.lit(pairs) / F.col("sources"))).cast("bigint"),
    }).withColumnRenamed("lang", "_l")
    known = groups.join(sizes, F.col("lang") == F.col("_l")).drop("_l")
    known = known.withColumn("p0", share(F.lit(0), F.col("total"), F.col("terms"), smooth, scale))
    stripes = F.explode(F.sequence(F.lit(0), F.floor((F.col("sources") - 1) / F.col("stripe_size")).cast("bigint")))
    numbered = known.withColumn("at", F.row_number().over(Window.partitionBy("lang").orderBy("source")) - 1)
    numbered = numbered.withColumn("own", F.floor(F.col("at") / F.col("stripe_size")).cast("bigint"))
    runs = F.explode(F.sequence(F.lit(0), F.floor(F.greatest(F.col("terms") - 1, F.lit(0)) / F.col("run")).cast("bigint")))
    right = numbered.select("*", runs.alias("part")).select("*", stripes.alias("stripe"))
    right = right.select("lang", "part", "stripe", "source", "p0", (F.col("own") == F.col("stripe")).alias("reported"))
    facts = known.select(F.col("lang").alias("_l"), F.col("source").alias("_s"), "terms", "total", "sources", "run", "stripe_size")
    left = counts.join(facts, (F.col("lang") == F.col("_l")) & (F.col("source") == F.col("_s")))
    left = left.select("*", F.floor(F.col("ordinal") / F.col("run")).cast("bigint").alias("part"), stripes.alias("stripe"))
    p = share(F.col("n"), F.col("total"), F.col("terms"), smooth, scale)
    left = left.select("lang", "part", "stripe", "source", "ordinal", p.alias("p"))

    def differences(rows: pd.DataFrame, sources: pd.DataFrame) -> pd.DataFrame:
        sources = sources.sort_values("source", ignore_index=True)
        place = {source: k for k, source in enumerate(sources["source"])}
        term, ordinals = pd.factorize(rows["ordinal"])
        table = np.repeat(sources["p0"].to_numpy()[:, None], len(ordinals), axis=1)  # (source, term)
        table[rows["source"].map(place).to_numpy(np.int64), term] = rows["p"]
        names, out = sources["source"].to_numpy(), []
        for k in np.flatnonzero(sources["reported"]):
            sums = np.abs(table - table[k]).sum(axis=1)
            out.append(pd.DataFrame({"source": names[k], "item": np.delete(names, k), "value": np.delete(sums, k)}))
        return pd.concat(out).assign(lang=sources["lang"].iat[0]) if out else pd.DataFrame(columns=["lang", "source", "item", "value"])

    keys = ["lang", "part", "stripe"]
    partial = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInPandas(differences, "lang string, source string, item string, value long")
    whole = partial.groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    return whole.select("lang", "source", F.lit("pair").alias("part"), "item", "value", F.row_number().over(order).alias("rank"))


def audit(
    docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source", min_documents: int = MIN_DOCUMENTS,
    smooth: int = SMOOTH, scale: int = SCALE, top: int = TOP, shard_terms: int = SHARD_TERMS,
    cells: int = CELLS, pairs: int = PAIRS,
) -> DataFrame:
    """Rows ``lang``, ``source``, ``part``, ``item``, ``value``, ``rank`` of two reports on every (lang, source).

    Each language keeps the terms that at least ``min_documents`` of its rows hold. A group's share of a kept term
    is ``1 + floor(scale * (count + smooth) / (N + smooth * V))``, N being its counts of all V kept terms. Part
    ``pair``: every other source of the language with the sum of the differences of shares over all kept terms, 0
    if there is none. Part ``term``: the ``top`` terms that the group holds and has a greater share of than its
    language, with the difference. Ranks count from 1 in each group and part, by value descending, then item.

    NULL texts, languages and sources are the empty text. Repeated rows are repeated documents; other columns are
    not used. A source alone in its language has no pair; an empty table gives no row.
    """
    small_batches(docs.sparkSession)
    named = {"lang": lang, "source": source, "text": text}
    docs = docs.select(*[F.coalesce(F.col(column), F.lit("")).alias(name) for name, column in named.items()])
    kept = document_counts(docs).where(F.col("docs") >= min_documents)
    vocabulary = Vocabulary.of_terms(stored(kept.select("lang", "term"), "kept-terms"), shard_terms)
    counts = stored(ordinal_counts(docs, vocabulary), "ordinal-counts")
    groups = docs.select("lang", "source").distinct()
    totals = counts.groupBy(F.col("lang").alias("_l"), F.col("source").alias("_s")).agg(F.sum("n").alias("total"))
    groups = groups.join(totals, (F.col("lang") == F.col("_l")) & (F.col("source") == F.col("_s")), "left")
    sizes = vocabulary.index.groupBy(F.col("lang").alias("_v")).agg(F.sum("terms").alias("terms"))
    groups = groups.join(sizes, F.col("lang") == F.col("_v"), "left")
    groups = stored(groups.select("lang", "source", F.coalesce("terms", F.lit(0)).alias("terms"), F.coalesce("total", F.lit(0)).alias("total")), "groups")
    return pair_part(counts, groups, smooth, scale, cells, pairs).unionByName(term_part(counts, groups, vocabulary, top, smooth, scale))
