"""Kinds of text: lists set in one line, run-on words, repeated prose."""

from lekhani.llm import quality

PROSE = "The committee met in the town hall on Monday, and it was a long evening for all of them."


def test_combined_rules(spark):
    rows = {
        "run-in list": "pension; transport; hearing; ordinance housing bridge; district bridge; reservoir; minister",
        "run-on": "harbourvaccinescreenambulanceMINISTERelectionTRANSPORTcommitteeFOSSILspeaker",
        "prose": PROSE,
        "chinese": "委员会星期一在市政厅开会，大家都觉得那是一个漫长的夜晚，会议一直开到深夜才结束，然后每个人都回家去了。",
        "boilerplate": "\n".join([PROSE] * 4 + ["It rained in the evening and the streets of the town were wet."]),
        "null": None,
        "empty": "",
    }
    df = spark.createDataFrame([(k, t, "clash", None, None) for k, t in rows.items()], "doc_id string, uncleaned_text string, kind string, uncleaned_words_count int, symbol_ratio float")
    assert {tuple(r) for r in quality.text_kinds(df).collect()} == {("run-in list", "list"), ("run-on", "junk")}
    got = {r.doc_id: r for r in quality.text_statistics(df, text_col="uncleaned_text").collect()}
    assert got["boilerplate"].boilerplate_share > 0.8 and got["boilerplate"].repeated_line_share == 0.6
    assert got["prose"].prose_share == 1 and got["prose"].boilerplate_share == 0
    assert got["null"].words_count == got["empty"].words_count and got["null"].prose_share == 0
    assert quality.text_kinds(df.limit(0)).count() == 0
