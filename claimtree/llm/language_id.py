"""Language identification by unigram pieces, summed over all segmentations.

Each language has a probability for every piece of a fixed public vocabulary. The probability of a word
is the sum over all its segmentations of the product of their pieces, by a forward pass over the word's
places; the piece probabilities are fitted by expectation maximisation with the matching backward pass.
Words are runs of letters in lower case, of any length, so a text's score is a sum over its words. Sums are
kept as logarithms at every place, so that no product leaves the range of a double.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterable, Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pandas as pd
import public_tokenizers
import sentencepiece
from pyspark.sql import Column, DataFrame, functions as F

from claimtree.llm.common import free_name, give_back_memory, small_batches, stored

VOCABULARY = "piece_bpe_32k.model"
UNDETERMINED = "und"
START = "▁"
WORD = re.compile(r"[^\W\d_]+")
ITERATIONS = 3
# Letters after which a span is only followed where some longer piece begins with them.
PREFIX = 5
# Words of one length that are scored together hold at most so many letters in all.
LETTERS = 1 << 16
# Pseudo count of every piece in every language.
SMOOTH = 0.02
# Words, and letters of words, that a task remembers before it starts anew.
REMEMBERED, REMEMBERED_LETTERS = 250_000, 1 << 24
# Different words that a task counts, and characters that it reads, before it passes them on.
COUNTED, READ = 120_000, 1 << 26
# Texts whose new words are scored together.
TEXTS = 2_000
# Words of a pass over the corpus that a task takes together.
TOGETHER = 50_000


def words_of(text: str | None) -> list[str]:
    return WORD.findall((text or "").lower())


@lru_cache(maxsize=2)
def vocabulary(path: str | None = None) -> dict[str, int]:
    """Number of each piece that can occur in a word; 0 is any letter that is not in the vocabulary."""
    model = sentencepiece.SentencePieceProcessor(model_file=path or public_tokenizers.path(VOCABULARY))
    pieces = map(model.id_to_piece, range(model.get_piece_size()))
    usable = (p for p in pieces if WORD.fullmatch(p.removeprefix(START) or "-") and p == p.lower())
    return {piece: number for number, piece in enumerate([START, *usable], 1)}


class PieceTable:
    """Numbers of pieces by a rolling hash of their letters, for whole columns of words at once."""

    SLOTS = 1 << 20

    def __init__(self, known: dict[str, int]):
        by_length: dict[int, list[str]] = {}
        for piece in known:
            by_length.setdefault(len(piece), []).append(piece)
        self.numbers = np.array([known[p] for same in by_length.values() for p in same])
        rng = np.random.default_rng(3)
        while True:  # until no slot has more than two pieces and no two pieces have one hash
            self.factor = np.uint64(int(rng.integers(1 << 62, 1 << 63)) | 1)
            hashes = []
            for same in by_length.values():
                total = np.zeros(len(same), np.uint64)
                for column in letters(same).T:
                    total = self.step(total, column)
                hashes.append(total)
            self.hashes = np.concatenate(hashes)
            slots, counts = np.unique(self._slot(self.hashes), return_counts=True)
            if counts.max() <= 2 and len(np.unique(self.hashes)) == len(self.hashes):
                break
        self.longest = max(by_length)
        self.begins = np.zeros(self.SLOTS, bool)
        for size, same in by_length.items():
            if size > PREFIX:
                total = np.zeros(len(same), np.uint64)
                for column in letters([p[:PREFIX] for p in same]).T:
                    total = self.step(total, column)
                self.begins[self._slot(total)] = True
        self.slots = np.zeros((self.SLOTS, 2), np.int32)
        order = np.argsort(self._slot(self.hashes), kind="stable")
        first = np.cumsum(counts) - counts
        self.slots[slots] = order[first][:, None]
        self.slots[slots, 1] = order[first + counts - 1]

    def step(self, total: np.ndarray, column: np.ndarray) -> np.ndarray:
        return (total + column + np.uint64(1)) * self.factor

    def _slot(self, hashes: np.ndarray) -> np.ndarray:
        return (hashes >> np.uint64(44)).astype(np.int64)

    def goes_on(self, hashes: np.ndarray) -> np.ndarray:
        """Which hashes of PREFIX letters may begin a longer piece; all that do, and few others."""
        return self.begins[self._slot(hashes)]

    def find(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places of the hashes that are those of pieces, and the pieces' numbers."""
        both = self.slots[self._slot(hashes)]
        hit = self.hashes[both] == hashes[:, None]
        at = np.flatnonzero(hit.any(axis=1))
        return at, self.numbers[np.where(hit[at, 0], both[at, 0], both[at, 1])]


def letters(words: list[str]) -> np.ndarray:
    """(word, place): code points of words of one length."""
    return np.array(words).view(np.uint32).reshape(len(words), -1).astype(np.uint64)


@lru_cache(maxsize=2)
def piece_table(path: str | None = None) -> PieceTable:
    return PieceTable(vocabulary(path))


class Lattice:
    """All segmentations of words of one length at once: by end and start, the words that have a piece there."""

    def __init__(self, words: list[str], table: PieceTable):
        codes = letters([START + w for w in words])
        self.rows, self.size = codes.shape
        self.by_end: list[list[tuple[int, np.ndarray, np.ndarray]]] = [[] for _ in range(self.size + 1)]
        for a in range(self.size):
            rows, total = np.arange(self.rows), np.zeros(self.rows, np.uint64)
            for b in range(a + 1, min(a + table.longest, self.size) + 1):
                total = table.step(total, codes[rows, b - 1])
                at, ids = table.find(total)
                if b == a + 1:  # every single letter can be passed
                    single = np.zeros(self.rows, np.int64)
                    single[at] = ids
                    self.by_end[b].append((a, rows, single))
                elif len(at):
                    self.by_end[b].append((a, rows[at], ids))
                if b == a + PREFIX:
                    alive = table.goes_on(total)
                    rows, total = rows[alive], total[alive]
                    if not len(rows):
                        break

    def log_forward(self, table: np.ndarray) -> np.ndarray:
        """(place, word, language): logarithm of the summed probability of the letters before the place."""
        alpha = np.zeros((self.size + 1, self.rows, table.shape[1]))
        for b in range(1, self.size + 1):
            total = np.zeros(alpha.shape[1:])
            for a, at, ids in self.by_end[b]:
                total[at] += table[ids] if a == b - 1 else table[ids] * np.exp(alpha[a, at] - alpha[b - 1, at])
            alpha[b] = alpha[b - 1] + np.log(total)
        return alpha

    def forward(self, table: np.ndarray) -> np.ndarray:
        return np.exp(self.log_forward(table))

    def expected(self, table: np.ndarray, counts: np.ndarray, into: np.ndarray) -> None:
        """Adds the expected uses of each piece, in words seen ``counts`` (word, language) times."""
        alpha = self.log_forward(table)
        beta = np.zeros_like(alpha)
        columns, flat = np.arange(table.shape[1]), into.reshape(-1)
        by_start: list[list[tuple[int, np.ndarray, np.ndarray]]] = [[] for _ in range(self.size)]
        for b, pieces in enumerate(self.by_end):
            for a, at, ids in pieces:
                by_start[a].append((b, at, ids))
        for a in range(self.size - 1, -1, -1):
            total = np.zeros(alpha.shape[1:])
            for b, at, ids in by_start[a]:
                total[at] += table[ids] if b == a + 1 else table[ids] * np.exp(beta[b, at] - beta[a + 1, at])
                uses = counts[at] * table[ids] * np.exp(alpha[a, at] + beta[b, at] - alpha[self.size, at])
                np.add.at(flat, (ids[:, None] * len(columns) + columns).ravel(), uses.ravel())
            beta[a] = beta[a + 1] + np.log(total)


def lattices(words: Iterable[str], table: PieceTable) -> Iterator[tuple[list[str], Lattice]]:
    by_length: dict[int, list[str]] = {}
    for w in words:
        by_length.setdefault(len(w), []).append(w)
    for same in by_length.values():
        together = max(1, min(4096, LETTERS // len(same[0])))
        for at in range(0, len(same), together):
            block = same[at : at + together]
            yield block, Lattice(block, table)


class Model:
    """Languages, their log priors and piece probabilities (piece, language)."""

    def __init__(self, languages: list[str], prior: np.ndarray, table: np.ndarray, path: str | None = None):
        self.languages, self.prior, self.table, self.path = languages, prior, table, path
        self._forget()

    def __getstate__(self):
        return {k: v for k, v in self.__dict__.items() if k not in ("rows", "scores", "letters")}

    def __setstate__(self, state):
        self.__dict__.update(state)
        self._forget()

    def _forget(self) -> None:
        self.rows: dict[str, int] = {}
        self.letters = 0
        self.scores = np.zeros((0, len(self.languages)))

    def learn(self, words: list[str]) -> None:
        """Remembers the log probabilities of these words."""
        self.letters += sum(map(len, words))
        parts, blocks = [self.scores], lattices(words, piece_table(self.path))
        for block, lattice in blocks:
            self.rows.update(zip(block, range(len(self.rows), len(self.rows) + len(block)), strict=True))
            parts.append(lattice.log_forward(self.table)[lattice.size])
        self.scores = np.concatenate(parts)

    def predict(self, texts: list[str | None]) -> list[tuple[str, float]]:
        words = [words_of(t) for t in texts]
        if not self.languages:
            return [(UNDETERMINED, 0.0)] * len(texts)
        if len(self.rows) > REMEMBERED or self.letters > REMEMBERED_LETTERS:
            self._forget()
        new = set(chain.from_iterable(words)).difference(self.rows)
        if new:
            self.learn(list(new))
        return [self._best(w) for w in words]

    def _best(self, words: list[str]) -> tuple[str, float]:
        if not words:
            return UNDETERMINED, 0.0
        rows = np.fromiter(map(self.rows.__getitem__, words), np.int64, len(words))
        total = self.prior + self.scores[rows].sum(axis=0)
        odds = np.exp(total - total.max())
        best = int(total.argmax())
        return self.languages[best], float(odds[best] / odds.sum())


def gathered(batches: Iterator[pd.DataFrame], rows: int) -> Iterator[pd.DataFrame]:
    """The same rows in frames of at least so many, except for the last."""
    held: list[pd.DataFrame] = []
    for batch in batches:
        held.append(batch)
        if sum(map(len, held)) >= rows:
            yield pd.concat(held)
            held = []
    if held:
        yield pd.concat(held)


def word_counts(docs: DataFrame, text: str, lang: str) -> DataFrame:
    """(language, word, count) over all rows; counted in the task first, so frequent words shuffle once a task."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counted: dict[str, Counter] = {}
        read = 0

        def flush() -> pd.DataFrame:
            rows = [(lang, word, n) for lang, words in counted.items() for word, n in words.items()]
            counted.clear()
            return pd.DataFrame(rows, columns=["lang", "word", "n"])

        for batch in batches:
            for key, body in zip(batch["lang"], batch["text"], strict=True):
                counted.setdefault(key, Counter()).update(words_of(body))
                read += len(body)
                if read > READ or sum(map(len, counted.values())) > COUNTED:
                    yield flush()
                    read = 0
        yield flush()
        give_back_memory()

    pairs = docs.select(F.col(lang).alias("lang"), F.col(text).alias("text"))
    counted = pairs.mapInPandas(run, "lang string, word string, n long")
    return counted.groupBy("lang", "word").agg(F.sum("n").alias("n"))


def _round(counts: DataFrame, languages: list[str], table: np.ndarray, path: str | None) -> np.ndarray:
    """Expected piece counts of one pass over all words; each task sends at most a table of its own."""
    column = {lang: k for k, lang in enumerate(languages)}

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known, into = piece_table(path), np.zeros_like(table)
        for batch in gathered(batches, TOGETHER):
            seen = {w: k for k, w in enumerate(dict.fromkeys(batch["word"]))}
            matrix = np.zeros((len(seen), len(languages)))
            np.add.at(matrix, (batch["word"].map(seen), batch["lang"].map(column)), batch["n"])
            for block, lattice in lattices(seen, known):
                lattice.expected(table, matrix[[seen[w] for w in block]], into)
        at, lang = np.nonzero(into)
        yield pd.DataFrame({"piece": at, "lang": lang, "uses": into[at, lang]})
        give_back_memory()

    uses = counts.mapInPandas(run, "piece long, lang long, uses double")
    # At most one row per piece of the vocabulary and language.
    rows = uses.groupBy("piece", "lang").agg(F.sum("uses").alias("uses")).toPandas()
    total = np.zeros_like(table)
    total[rows["piece"], rows["lang"]] = rows["uses"]
    return total


def _probabilities(uses: np.ndarray) -> np.ndarray:
    return (uses + SMOOTH) / (uses + SMOOTH).sum(axis=0)


def train(
    docs: DataFrame, text: str = "text", lang: str = "lang", path: str | None = None, iterations: int = ITERATIONS
) -> Model:
    """A model of all rows with a text and a language.

    Word counts of the whole corpus are stored once; each iteration reads them. The driver receives piece
    counts only: the size of the vocabulary times the number of languages. Rows with a NULL language or
    text are left out; with none left, the model has no language and predicts ``und`` everywhere.
    """
    small_batches(docs.sparkSession)
    labelled = docs.where(F.col(text).isNotNull() & F.col(lang).isNotNull())
    # One row per language.
    shares = {r[0]: r[1] for r in labelled.groupBy(lang).count().collect()}
    languages = sorted(shares)
    counts = stored(word_counts(labelled, text, lang), "words")
    size = len(vocabulary(path)) + 1
    first = np.full(size, 1e-6)
    for piece, number in vocabulary(path).items():
        first[number] = 0.05 ** len(piece)
    table = np.repeat((first / first.sum())[:, None], max(1, len(languages)), axis=1)
    for _ in range(iterations if languages else 0):
        table = _probabilities(_round(counts, languages, table, path))
    prior = np.log(np.array([shares[x] for x in languages], float) / max(1, sum(shares.values())))
    return Model(languages, prior, table, path)


def predictions(text: Column, model: Model) -> Column:
    """Struct (lang, score): the most probable language and its posterior probability.

    ``und`` and 0 if the text is NULL, empty or without a letter. Texts of any length are scored whole. Of
    equally probable languages the first by name is taken.
    """

    @F.pandas_udf("lang string, score double")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            parts = (texts.iloc[a : a + TEXTS].tolist() for a in range(0, len(texts), TEXTS))
            yield pd.DataFrame(list(chain.from_iterable(map(model.predict, parts))), columns=["lang", "score"])
        model._forget()
        give_back_memory()

    return run(text)


def identify(docs: DataFrame, model: Model, text: str = "text", lang: str = "lang_pred", score: str = "score") -> DataFrame:
    """All rows with ``lang_pred`` and ``score``; columns of these names are replaced, others pass through.

    Every row is predicted by itself from its text alone; repeated rows get the same result.
    """
    small_batches(docs.sparkSession)
    kept = [c for c in docs.columns if c not in (lang, score)]
    name = free_name(docs, "__p")
    found = docs.select(*kept, predictions(F.col(text), model).alias(name))
    return found.select(*kept, F.col(f"{name}.lang").alias(lang), F.col(f"{name}.score").alias(score))


def held_out(doc_id: Column) -> Column:
    """Documents that are never learned from: CRC-32 of the id as text, modulo 4, is 2. A NULL id is text ''."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % 4 == 2
