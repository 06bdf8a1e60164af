"""Source divergence audit: transducers against sorted lists, reports against a plain version in Python integers."""

import random
import re
from collections import Counter, defaultdict

import pytest
from hypothesis import given, settings, strategies as st

from claimtree.llm import source_audit
from claimtree.llm.source_audit import Transducer

SCHEMA = "text string, lang string, source string, ordinal int, part string, term string"


def plain_audit(rows, least, top=50):
    """rows: (text, lang, source)."""
    split = [(re.findall(r"[a-z\u0080-\U0010ffff]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or "")), l or "", s or "") for t, l, s in rows]
    held, uses = defaultdict(Counter), defaultdict(Counter)
    for terms, lang, source in split:
        held[lang].update(set(terms))
        uses[lang, source].update(terms)
    out = []
    for lang in held:
        kept = {t for t, n in held[lang].items() if n >= least}
        own = {s: {t: c[t] for t in kept} for (l, s), c in uses.items() if l == lang}
        every = {t: sum(c[t] for c in own.values()) for t in kept}
        shares = lambda c: {t: 1 + 10**9 * (n + 5) // (sum(c.values()) + 5 * len(kept)) for t, n in c.items()}
        q = shares(every)
        for s, c in own.items():
            p = shares(c)
            pairs = [(x, sum(abs(p[t] - shares(d)[t]) for t in kept)) for x, d in own.items() if x != s]
            terms = [(t, p[t] - q[t]) for t in kept if c[t] and p[t] > q[t]]
            for part, items, limit in (("pair", pairs, None), ("term", terms, top)):
                ranked = sorted(items, key=lambda i: (-i[1], i[0].encode()))[:limit]
                out += [(lang, s, part, item, value, k) for k, (item, value) in enumerate(ranked, 1)]
    return Counter(out)


def rows_of(df):
    assert df.columns == ["lang", "source", "part", "item", "value", "rank"]
    assert dict(df.dtypes)["value"] == "bigint" and dict(df.dtypes)["rank"] == "int"
    return Counter(tuple(r) for r in df.collect())


@settings(max_examples=200, deadline=None)
@given(st.sets(st.text(alphabet="abéß東🙂", min_size=1, max_size=6)))
def test_transducer(terms):
    terms = sorted(terms)
    found = Transducer.unpacked(Transducer.build(terms).packed())
    assert [found.ordinal(t) for t in terms] == list(range(len(terms)))
    assert [found.spell(k) for k in range(len(terms))] == terms
    assert all(found.ordinal(t + x) == -1 for t in terms for x in ("a", "東") if t + x not in terms)
    assert found.ordinal("") == -1
    # Minimal: as many states as there are different sets of rests.
    prefixes = {t[:k] for t in terms for k in range(len(t) + 1)} | {""}
    rests = {frozenset(t[len(p) :] for t in terms if t.startswith(p)) for p in prefixes}
    assert len(found.edges) == len(rests)


@pytest.mark.parametrize(("shard_terms", "cells", "pairs"), [(1 << 16, 1 << 16, 1 << 18), (3, 8, 4)])
def test_reports(spark, shard_terms, cells, pairs):
    """Ties, empty and NULL texts, languages and sources, repeated rows, groups without terms, clashing columns."""
    rng = random.Random(7)
    words = ["a", "b", "Ab", "aB", "Émile", "émile", "東京", "ßtraße", "x\u0080y", "zz", "don't", "e-mail", "🙂", "ab2cd"]
    rows = [(" ".join(rng.choices(words, k=rng.randint(0, 30))), rng.choice(["en", "fr", None, ""]), f"s{rng.randint(0, 6)}") for _ in range(120)]
    rows += [(None, "en", None), ("", "en", ""), ("123 @[`{", "xx", "s1"), ("one", "xx", "s2"), ("b a", "yy", "s1"), ("w" * 50_000, "en", "s1")]
    rows += rows[:20]
    docs = spark.createDataFrame([(*r, 1, "p", "t") for r in rows], SCHEMA)
    found = source_audit.audit(docs, min_documents=4, shard_terms=shard_terms, cells=cells, pairs=pairs)
    assert rows_of(found) == plain_audit(rows, 4)


def test_terms_are_looked_up_once(spark, monkeypatch):
    """What the last look-up found is not walked again, kept or not; order and language stay right."""
    docs = spark.createDataFrame([("en", t) for t in ("a", "b", "é", "東京")] + [("fr", "b")], "lang string, term string")
    reader = source_audit.Vocabulary.of_terms(docs, 2).reader()
    walked = []
    monkeypatch.setattr(Transducer, "ordinal", lambda self, term, plain=Transducer.ordinal: walked.append(term) or plain(self, term))
    first = reader.ordinals("en", [t.encode() for t in ("é", "zz", "a", "0")], {})
    assert {t.decode(): k for t, k in first.items()} == {"a": 0, "é": 2, "zz": -1, "0": -1}
    walked.clear()
    second = reader.ordinals("en", [t.encode() for t in ("東京", "zz", "a")], first)
    assert {t.decode(): k for t, k in second.items()} == {"a": 0, "東京": 3, "zz": -1} and walked == ["東京"]
    assert reader.ordinals("fr", [b"b", b"a"], {}) == {b"b": 0, b"a": -1}
    assert reader.ordinals("xx", [b"b"], {}) == {b"b": -1}


@pytest.mark.parametrize("text", ["", "Don't é东-É x\u0080y\u00a0z\u2003w \u0085 \u0130 A1b[c`d{e\x7ff\x00g", "ÀB 🙂ß_Ω"])
def test_terms(text):
    plain = re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text))
    assert [t.decode() for t in source_audit.terms_of(text.encode())] == plain


def test_top_and_least(spark):
    rows = [(f"w{chr(97 + k)} common", "en", f"s{k % 2}") for k in range(20)] * 2
    docs = spark.createDataFrame([(*r, 1, "p", "t") for r in rows], SCHEMA)
    assert rows_of(source_audit.audit(docs, min_documents=2, top=3)) == plain_audit(rows, 2, 3)
    assert rows_of(source_audit.audit(docs, min_documents=41)) == Counter({("en", "s0", "pair", "s1", 0, 1): 1, ("en", "s1", "pair", "s0", 0, 1): 1})


def test_empty_table(spark):
    assert rows_of(source_audit.audit(spark.createDataFrame([], SCHEMA))) == Counter()


def test_share_is_exact(spark):
    n, total, terms = 10**14 + 12345, 3 * 10**14 + 7, 10**8
    row = spark.range(1).select(source_audit.share(*[source_audit.F.lit(x) for x in (n, total, terms)]).alias("p")).first()
    assert row.p == 1 + 10**9 * (n + 5) // (total + 5 * terms)
