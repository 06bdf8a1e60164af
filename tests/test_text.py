"""Display-text functions at their edges."""

import pytest
from pyspark.sql import functions as F, types as T

from claimtree.functions import text as tx


def one(spark, column):
    return spark.range(1).select(column).first()[0]


@pytest.mark.parametrize(
    "given, expected",
    [
        ("(FILLED) mc-donald 3M o'NEIL  x", "(Filled) Mc-donald 3M O'neil  X"),
        ("", ""),
        ("123 --", "123 --"),
        ("\tab\nCD eF", "\tAb\ncd Ef"),
        ("ÉTION über", "ÉTion üBer"),
    ],
)
def test_title_case(spark, given, expected):
    assert one(spark, tx.title_case(F.lit(given))) == expected


@pytest.mark.parametrize(
    "given, expected",
    [
        (12.7, "12"), (1000.0, "1000"), (1000.5, "1.000 K"), (999999.9, "999.999 K"), (1234567.0, "1.234 M"),
        (5e9, "5.000 B"), (5.5e12, "5.500 T"), (1e15, None), (-5.5, "-6"), (None, None),
    ],
)
def test_abbreviate(spark, given, expected):
    assert one(spark, tx.abbreviate_number(F.lit(given).cast("double"))) == expected


def test_templates(spark):
    fields = {"a": F.lit("A"), "b": F.lit("B"), "gap": F.lit("-")}
    render = lambda *args: one(spark, tx.render_template(*args, fields))
    assert render("-", "a") is None
    assert render(None, "a") is None
    assert render("fixed ###0", "-") == "fixed ###0"
    assert render("###0 of ###1", "a| b") == "A of B"
    assert render("###0 ###0", "a") == "A ###0"
    assert render("x ###0 ###1", "gap|gap") == ""
    assert render("x ###0 ###1", "gap|a") == "x - A"
    assert render("x ###0", "absent") == "x null"


def test_trims(spark):
    assert one(spark, tx.trim_tail(F.lit("a" * 20), 20)) == "a" * 20
    assert one(spark, tx.trim_tail(F.lit("a" * 21), 20)) == "a" * 17 + "..."
    assert one(spark, tx.trim_subtitle(F.lit("b" * 27))) == "b" * 27
    assert one(spark, tx.trim_subtitle(F.lit("b" * 28))) == "b" * 24 + "..."
    assert one(spark, tx.trim_subtitle(F.lit(None).cast("string"))) == ""
    assert one(spark, tx.trim_subtitle(F.lit("Null"))) == ""
    words = "word " * 14
    assert one(spark, tx.trim_title(F.lit(words))) == words
    assert one(spark, tx.trim_title(F.lit(words + "x"))) == "word " * 13 + "word ..."
    assert one(spark, tx.trim_title(F.lit("c" * 71))) == " ..."


def test_masks(spark):
    assert one(spark, tx.format_metric(F.lit("5"), "$%s of %s", "Pay")) == "Pay : $5 of %s"
    assert one(spark, tx.apply_mask(F.lit("5"), "none")) == "none"


@pytest.mark.parametrize("given, whole, real", [("12abc", 12, 12.0), ("-3.5e2x", -3, -350.0), ("x", None, None), (" 7", 7, 7.0), ("", None, None), (".5", None, 0.5)])
def test_typed_cast(spark, given, whole, real):
    assert one(spark, tx.typed_cast(F.lit(given), "Integer")) == whole
    assert one(spark, tx.typed_cast(F.lit(given), "Float")) == real
    assert one(spark, tx.typed_cast(F.lit(given), "String")) == given


def test_typed_cast_of_numbers(spark):
    assert one(spark, tx.typed_cast(F.lit(1.5e8), "Integer", T.DoubleType())) == 150000000


def test_display(spark):
    assert one(spark, tx.display(F.lit(12.0), T.DoubleType())) == "12"
    assert one(spark, tx.display(F.lit(12.5), T.DoubleType())) == "12.5"
    assert one(spark, tx.display(F.lit(None).cast("string"))) == "null"


def test_search_predicate(spark):
    match = lambda name, term: one(spark, tx.search_predicate(F.lit(name), term))
    assert match("Mercy West", " MERC ") is True
    assert match("Mercy West", "me") is False
    assert match("Mercy (Filled)", "mercy") is False


def test_split_list(spark):
    assert one(spark, tx.split_list(F.lit(" a | b|c "))) == ["a", "b", "c"]
