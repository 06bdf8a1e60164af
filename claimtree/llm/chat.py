"""Chat formatting with a grammar round trip.

A conversation is rendered as ``<|im_start|>role``, a newline, the text and ``<|im_end|>`` with a
newline, turn after turn. A deterministic parser reads the rendering back, and its turns are compared
with the source. Content that does not come back identical is escaped and rendered again: first the
text, then the role too. Escaping puts one more backslash into every ``<|`` or ``<\\|``, so no marker
can remain inside content, and the parser always takes one away. All of it is built-in functions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

# The template's marks.
START, END = "<|im_start|>", "<|im_end|>"
START_PATTERN = r"<\|im_start\|>"


def escape(text: Column) -> Column:
    return F.regexp_replace(text, r"<(\\*)\|", r"<\\$1|")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"<\\(\\*)\|", r"<$1|")


def escape_role(role: Column) -> Column:
    """A role has no newline in the grammar: percent signs and newlines are written as codes."""
    return F.replace(F.replace(escape(role), F.lit("%"), F.lit("%25")), F.lit("\n"), F.lit("%0A"))


def unescape_role(role: Column) -> Column:
    return unescape(F.replace(F.replace(role, F.lit("%0A"), F.lit("\n")), F.lit("%25"), F.lit("%")))


def block(role: Column, text: Column) -> Column:
    return F.concat(F.lit(START), role, F.lit("\n"), text, F.lit(END + "\n"))


def parse(formatted: Column) -> Column:
    """Turns read back: array of (role, text). A start mark opens a turn, the next end mark closes its text."""
    pieces = F.split(formatted, START_PATTERN, -1)
    pieces = F.slice(pieces, 2, F.size(pieces))

    def turn(piece: Column) -> Column:
        at = F.instr(piece, "\n")
        role = F.substring(piece, F.lit(1), at - 1)
        text = F.substring_index(F.substring(piece, at + 1, F.length(piece)), END, 1)
        return F.struct(unescape_role(role).alias("role"), unescape(text).alias("text"))

    return F.transform(pieces, turn)


def render(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", loss_role: str = "assistant") -> DataFrame:
    """One row per conversation: ``conv_id``, ``n_turns``, ``formatted``, ``loss_spans``, ``identical``.

    ``loss_spans`` are the texts of ``loss_role`` inside ``formatted``: code points ``[start, end)`` and
    bytes ``[byte_start, byte_end)``. ``identical`` says that the parsed turns equal the source.

    A NULL role or text is an empty one, and a NULL conversation id is a conversation of its own. Turns
    go by number, NULL first; turns with the same number by role, then text, and repeated rows are
    repeated turns. Other columns are not used. An empty table gives no row.
    """
    rows = turns.select(
        F.col(conv).alias("conv_id"), F.col(turn).alias("turn"),
        F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"),
    )
    source = F.array(F.struct("role", "text"))
    forms = [
        (F.col("role"), F.col("text")),
        (F.col("role"), escape(F.col("text"))),
        (escape_role(F.col("role")), escape(F.col("text"))),
    ]
    rows = rows.withColumns({f"_block{k}": block(*form) for k, form in enumerate(forms)})
    level = F.when(parse(F.col("_block0")) == source, 0).when(parse(F.col("_block1")) == source, 1).otherwise(2)
    rows = rows.withColumn("_level", level)
    pick = lambda values: F.when(F.col("_level") == 0, values[0]).when(F.col("_level") == 1, values[1]).otherwise(values[2])
    rows = rows.withColumns({
        "block": pick([F.col(f"_block{k}") for k in range(3)]),
        "_role": pick([f[0] for f in forms]),
        "_text": pick([f[1] for f in forms]),
    }).drop("_block0", "_block1", "_block2")
    head = F.length(F.lit(START)) + 1
    rows = rows.withColumns({
        "_chars": F.length("block").cast("bigint"), "_bytes": F.octet_length("block").cast("bigint"),
        "_head": F.length("_role") + head, "_byte_head": F.octet_length("_role") + head,
        "_body": F.length("_text"), "_byte_body": F.octet_length("_text"),
    })
    # Running sums give every block its place; the window's order also numbers the turns.
    order = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "role", "text")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumns({
        "n": F.row_number().over(order),
        "at": F.coalesce(F.sum("_chars").over(before), F.lit(0)),
        "byte_at": F.coalesce(F.sum("_bytes").over(before), F.lit(0)),
    })
    span = F.when(F.col("role") == loss_role, F.struct(
        (F.col("at") + F.col("_head")).alias("start"), (F.col("at") + F.col("_head") + F.col("_body")).alias("end"),
        (F.col("byte_at") + F.col("_byte_head")).alias("byte_start"),
        (F.col("byte_at") + F.col("_byte_head") + F.col("_byte_body")).alias("byte_end"),
    ))
    item = F.struct("n", "block", "role", "text", span.alias("span"))
    whole = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list(item)).alias("items"))
    whole = whole.withColumn("formatted", F.array_join(F.transform("items", lambda x: x.block), ""))
    source = F.transform("items", lambda x: F.struct(x.role.alias("role"), x.text.alias("text")))
    return whole.select(
        "conv_id", F.size("items").cast("bigint").alias("n_turns"), "formatted",
        F.filter(F.transform("items", lambda x: x.span), lambda s: s.isNotNull()).alias("loss_spans"),
        (parse(F.col("formatted")) == source).alias("identical"),
    )


def loss_text(formatted: Column, spans: Column) -> Column:
    """All text under the mask, unescaped, in order; cut by bytes, so each span costs its own length."""

    def cut(data: Column, s: Column) -> Column:
        piece = F.substring(data, (s.byte_start + 1).cast("int"), (s.byte_end - s.byte_start).cast("int"))
        return unescape(F.decode(piece, "UTF-8"))

    # The variable of a lambda is a value: the text is encoded once, not again for every span.
    encoded = F.array(F.encode(formatted, "UTF-8"))
    return F.element_at(F.transform(encoded, lambda data: F.array_join(F.transform(spans, lambda s: cut(data, s)), "")), 1)
