"""Display-text expressions. All run inside the JVM; none is a Python UDF."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, functions as F, types as T

# Magnitude suffixes of shortened numbers.
MAGNITUDE_SUFFIXES = ["", " K", " M", " B", " T"]


def title_case(text: Column) -> Column:
    """Upper-case the first ASCII letter of every space-separated word, lower-case what follows it.

    Unlike ``initcap`` whatever precedes that letter (brackets, digits, accents) is kept as it is.
    """

    def one_word(word: Column) -> Column:
        first = F.substring(word, 1, 1)
        plain = first.between("a", "z") | first.between("A", "Z")
        # Only words that do not start with a letter need the search for their first letter.
        lead = F.length(F.regexp_extract(word, "^[^A-Za-z]*", 0))
        return F.when(plain, F.concat(F.upper(first), F.lower(F.substr(word, F.lit(2))))).otherwise(
            F.concat(
                F.substring(word, F.lit(1), lead),
                F.upper(F.substring(word, lead + 1, F.lit(1))),
                F.lower(F.substr(word, lead + 2)),
            )
        )

    return F.array_join(F.transform(F.split(text, " "), one_word), " ")


def split_list(text: Column) -> Column:
    """Trimmed items of a ``|``-separated list."""
    return F.transform(F.split(text, r"\|"), lambda item: F.trim(item))


def replace_first(text: Column, mark: str, value: Column) -> Column:
    at = F.instr(text, mark)
    return F.when(
        at > 0,
        F.concat(
            F.substring(text, F.lit(1), at - 1), value, F.substring(text, at + len(mark), F.length(text))
        ),
    ).otherwise(text)


def display(value: Column, dtype: T.DataType | None = None) -> Column:
    """Text of a value as shown to a reader: whole doubles without ``.0``, missing as ``null``."""
    text = value.cast("string")
    if isinstance(dtype, (T.DoubleType, T.FloatType)):
        whole = (value == F.floor(value)) & (F.abs(value) < 1e15)
        text = F.when(whole, value.cast("bigint").cast("string")).otherwise(text)
    return F.coalesce(text, F.lit("null"))


def is_blank_setting(value: str | None) -> bool:
    return value is None or value == "-" or value.lower() == "null"


def render_template(template: str | None, parameters: str | None, fields: dict[str, Column]) -> Column:
    """Fill ``###0``, ``###1``, ... from the ``|``-separated field names in ``parameters``.

    ``fields`` maps a field name to its display text. Each mark is replaced once, in order. A blank
    template gives NULL, blank parameters give the template itself, and a row whose fields are all
    ``-`` gives an empty string.
    """
    if is_blank_setting(template):
        return F.lit(None).cast("string")
    if is_blank_setting(parameters):
        return F.lit(template)
    values = [fields.get(name.strip(), F.lit("null")) for name in parameters.split("|")]
    text = F.lit(template)
    for index, value in enumerate(values):
        text = replace_first(text, f"###{index}", value)
    any_value = reduce(lambda a, b: a | b, [value != "-" for value in values])
    return F.when(any_value, text).otherwise("")


def abbreviate_number(value: Column, digits: int = 3) -> Column:
    """``1234567`` to ``1.234 M``: digits are cut, not rounded. From 1e15 on the result is NULL."""
    whole = F.floor(value).cast("bigint")
    text = whole.cast("string")
    size = F.length(text)
    lead = F.pmod(size - 1, F.lit(3)) + 1
    suffix = F.get(F.array(*map(F.lit, MAGNITUDE_SUFFIXES)), ((size - 1) / 3).cast("int"))
    short = F.concat(F.substring(text, F.lit(1), lead), F.lit("."), F.substring(text, lead + 1, F.lit(digits)), suffix)
    return F.when(value > 1000, short).otherwise(text)


def trim_title(text: Column, width: int = 70) -> Column:
    """Longer text is cut to ``width``, back to its last space, and closed with `` ...``."""
    head = F.substring(text, 1, width)
    kept = F.when(F.instr(head, " ") > 0, F.regexp_replace(head, " [^ ]*$", "")).otherwise("")
    return F.when(F.length(text) <= width, text).otherwise(F.concat(kept, F.lit(" ...")))


def trim_tail(text: Column, width: int) -> Column:
    """Longer text keeps ``width - 3`` characters plus ``...``."""
    return F.when(F.length(text) > width, F.concat(F.substring(text, 1, width - 3), F.lit("..."))).otherwise(text)


def trim_subtitle(text: Column, width: int = 27) -> Column:
    shown = F.when(F.lower(text) == "null", "").otherwise(F.coalesce(text, F.lit("")))
    return trim_tail(shown, width)


def apply_mask(text: Column, mask: str) -> Column:
    """Put ``text`` in place of the first ``%s`` of a mask."""
    return replace_first(F.lit(mask), "%s", text)


def format_metric(text: Column, mask: str, label: str) -> Column:
    return F.concat(F.lit(f"{label} : "), apply_mask(text, mask))


def typed_cast(value: Column, declared: str, source: T.DataType | None = None) -> Column:
    """Cast to a declared ``String`` / ``Integer`` / ``Float``, reading the numeric prefix of text.

    Text without a numeric prefix gives NULL. ``source`` is the column's own type when known.
    """
    numeric = isinstance(source, T.NumericType)
    if declared == "Integer":
        return value.cast("bigint") if numeric else F.regexp_extract(value, r"^\s*([+-]?\d+)", 1).try_cast("bigint")
    if declared == "Float":
        prefix = r"^\s*([+-]?(?:\d+\.?\d*|\.\d+)(?:[eE][+-]?\d+)?)"
        return value.cast("double") if numeric else F.regexp_extract(value, prefix, 1).try_cast("double")
    return value.cast("string")


def search_predicate(name: Column, term: str) -> Column:
    """Case-insensitive substring match; terms under 3 characters match nothing, dummies never match."""
    wanted = (term or "").strip().lower()
    if len(wanted) < 3:
        return F.lit(False)
    return F.lower(name).contains(wanted) & ~name.contains("(Filled)")


def is_filled(relation: Column) -> Column:
    return F.lower(relation).contains("filled")
