"""Chat formatting: the round trip is exact for any content, and time grows with the turns, not with their square."""

import time

from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from claimtree.llm import chat
from claimtree.llm.queries import QUERIES

PARTS = ["<|im_start|>", "<|im_end|>", "<|", "|>", "<\\|", "\\", "\n", "assistant", "user", "%0A", "%", "", "é東🙂", "im_start", "<"]


def spent(spark, turns):
    rows = spark.range(turns).select(
        F.lit(1).alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") % 2 == 0, "user").otherwise("assistant").alias("role"),
        F.concat(F.lit("text <|im_end|> of turn "), F.col("id")).alias("text"),
    )
    start = time.perf_counter()
    row = chat.render(rows).select("n_turns", "identical", F.length(chat.loss_text(F.col("formatted"), F.col("loss_spans"))).alias("n")).first()
    assert row.n_turns == turns and row.identical and row.n == sum(len(f"text <|im_end|> of turn {k}") for k in range(1, turns, 2))
    return time.perf_counter() - start


def test_time_grows_with_the_turns(spark):
    spent(spark, 100)
    least, most = min(spent(spark, 2000) for _ in range(2)), min(spent(spark, 8000) for _ in range(2))
    assert most < 4 * least + 2


def test_every_round_trip_is_identical(spark):
    rows = QUERIES["op8_chat"][0](spark, "/root/testdata/sf0.001")
    assert rows.where(~F.col("identical")).count() == 0 and rows.count() > 0


@settings(max_examples=15, deadline=None)
@given(st.lists(st.tuples(*[st.lists(st.sampled_from(PARTS), max_size=6).map("".join)] * 2), min_size=1, max_size=30))
def test_any_content_comes_back(spark, turns):
    data = [(k, 0, role, text) for k, (role, text) in enumerate(turns)]
    rows = chat.render(spark.createDataFrame(data, "conv_id int, turn int, role string, text string"))
    back = {r.conv_id: r for r in rows.select("conv_id", "identical", chat.parse(F.col("formatted")).alias("t")).collect()}
    assert all(back[k].identical and [tuple(t) for t in back[k].t] == [(role, text)] for k, _, role, text in data)
