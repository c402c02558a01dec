"""Repetition operator on odd words; its cost on runs of marks."""

import time

from lekhani.llm import repetition


def test_runs_of_marks_take_linear_time(spark):
    texts = ["a" + "!" * 1_000_000 + "b", "!" * 500_000 + " ?? a!! (b) -c-", None, ""]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    repetition.score_repetition(df.where("doc_id > 1")).collect()
    began = time.time()
    rows = {r.doc_id: r for r in repetition.score_repetition(df).collect()}
    assert time.time() - began < 15
    assert [rows[i].n_words for i in range(4)] == [1, 3, 0, 0]


def test_words_at_marks(spark):
    df = spark.createDataFrame([("«Yes!» — it's well-known, isn't it?! ***",)], "t string")
    words = df.select(repetition.words_of(df.t).alias("w")).first().w
    assert words == ["yes", "it's", "well-known", "isn't", "it"]


def test_every_rule_of_the_table(spark):
    texts = ["one two three four five six " * 20, "- a\n- b\n- c...", "Plain words of the day and the night."]
    df = spark.createDataFrame([(i, t, 1) for i, t in enumerate(texts)], "doc_id long, text string, n_words int")
    rows = {r.doc_id: r.asDict() for r in repetition.score_repetition(df).collect()}
    assert rows[0]["repeats_itself"] and not rows[2]["repeats_itself"]
    assert rows[0]["repeated_words"] == 114 and rows[1]["bullet_lines"] and rows[1]["too_short"]
