"""Every stage of the pipeline on NULLs, empty and long texts, ties, repeated rows, empty tables and clashing columns."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

import corpus_pipeline

PROSE = {
    "en": "the cat sat on the mat and then it went to the house by the river", "de": "der hund lief durch den wald und dann nach hause an den fluss",
    "fr": "le chien court dans la forêt puis rentre à la maison près de la rivière",
}
MAIL = "write to jane.doe@example.org about the cat that sat on the mat in the house"
ITEM = "which river runs through the town where the old stone bridge was built in the year of the flood"
ROWS = (
    [(k, f"{text} {k}", lang, "s", 1) for k, (lang, text) in enumerate(list(PROSE.items()) * 6)]
    + [(100, MAIL, None, "s", 1), (101, None, "en", "s", 1), (102, "", "en", "s", 1), (103, "12 !", None, "s", 1), (104, ITEM, "en", None, None)]
    + [(105, f"{PROSE['en']}. " * 3000, "en", "s", 1), (106, MAIL + " again and again", "en", "s", 1), (106, MAIL + " again and again", "en", "s", 1)]
    + [(None, f"{PROSE['de']} null", "de", "s", 1)]
)
STAGES = dict(corpus_pipeline.STAGES)


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("tables"))
    spark.createDataFrame([(1, ITEM), (2, None), (3, "")], "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return path


@pytest.fixture(scope="module")
def docs(spark):
    rows = spark.createDataFrame(ROWS, "doc_id long, text string, lang string, source string, n_chars long")
    clash = ("key", "hits", "__p", "__lang", "__hits", "__before", "__mark", "__keep", "__found", "__fresh", "__values", "mark", "score", "part", "piece", "length", "block", "a", "b", "root", "fingerprint")
    return rows.withColumns({c: F.lit("x") for c in clash})


def kept(df):
    return Counter((r.doc_id, r.text) for r in df.collect())


def test_language(spark, docs, folder):
    found = STAGES["language_id"](spark, docs, folder)
    assert found.columns == docs.columns
    rows = found.collect()
    gone = {101, 102, 103}
    assert Counter((r.doc_id, r.text) for r in rows) == Counter((r[0], r[1]) for r in ROWS if r[0] not in gone)
    assert {r.lang for r in rows if r.doc_id == 100} == {"en"} and all(r.key == "x" for r in rows)


def test_near_duplicates(spark, docs, folder):
    found = STAGES["simhash_near_dedup"](spark, docs, folder)
    assert found.columns == docs.columns
    ids = Counter(r.doc_id for r in found.collect())
    assert ids[101] == 1 and ids[102] == 0 and ids[106] <= 1 and ids[None] == 1 and max(ids.values()) == 1


def test_decontamination(spark, docs, folder):
    found = STAGES["decontamination"](spark, docs, folder)
    assert found.columns == docs.columns
    assert kept(found) == Counter((r[0], r[1]) for r in ROWS if r[0] != 104)


def test_pii(spark, docs, folder):
    found = STAGES["pii"](spark, docs, folder)
    assert found.columns == docs.columns
    rows = {r.doc_id: r for r in found.collect()}
    assert rows[101].text is None and rows[101].n_chars is None and rows[102].text == "" and rows[102].n_chars == 0
    assert "jane.doe" not in rows[100].text and rows[106].text.startswith(rows[100].text)
    assert all(r.text == t for k, t, *_ in ROWS if k not in (100, 106) for r in [rows[k]])


def test_packing(spark, docs, folder):
    rows = STAGES["packing"](spark, docs, folder).collect()
    assert Counter(r.doc_id for r in rows if r.start == 0) == Counter(r[0] for r in ROWS)
    assert {r.length for r in rows if r.doc_id in (101, 102)} == {1}


@pytest.mark.parametrize("name", STAGES)
def test_empty_tables(spark, docs, folder, name):
    assert STAGES[name](spark, docs.where("false"), folder).count() == 0


def test_whole_run(spark, folder, docs):
    docs.write.mode("overwrite").parquet(f"{folder}/documents.parquet")
    rows = corpus_pipeline.run(spark, folder).collect()
    ids = {r.doc_id for r in rows}
    assert ids.isdisjoint({101, 102, 103, 104}) and {0, 100, None} <= ids
