import json
import random
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from lekhani import config
from lekhani.operators import clean, dedup, flags, lines, stats
from lekhani.plans import cli, stages
from lekhani.sources import readers, sinks


def test_chunk_cleaning_edges(spark):
    df = spark.createDataFrame([("1", "Good one.\nbad", None), ("2", "nothing", "u"), ("3", None, "u"), ("4", "", "u"), ("5", "!!!!.", "u")], "doc_id string, text string, url string")
    c = replace(config.Config(), remove_code=False)
    cleaned, heavy = clean.clean_documents(df, ["url"], c)
    rows = {r.doc_id: r for r in cleaned.collect()}
    assert rows["1"].text == "Good one.\n" and rows["1"].url == "None"
    assert rows["2"].text is None and set(rows) == {"1", "2"}
    assert [r.doc_id for r in heavy.collect()] == ["5"]


def test_repeated_chunks_all_copies_go(spark):
    df = spark.createDataFrame([("1", "u", "a\nb"), ("2", "u", "a\nc"), ("3", "v", "a")], "doc_id string, url string, text string")
    got = {r.doc_id: r.text for r in clean.drop_repeated_chunks(df).collect()}
    assert got == {"1": "b", "2": "c", "3": "a"}


def test_flags_at_thresholds_and_zero(spark):
    df = spark.createDataFrame([("a", 4, 5.0, 0, 0, 0, 0), ("b", 5, 6.0, 1, 20, 1, 20)], "doc_id string, lines_count long, mean_line_length double, nsfw_words_count long, words_count long, non_li_char_count long, char_count long")
    rows = {r.doc_id: r for r in flags.add_flags(df).collect()}
    assert rows["a"].has_less_lines and rows["a"].is_short_lines_heavy and not rows["a"].is_non_li_heavy
    assert not rows["b"].has_less_lines and rows["b"].is_non_li_heavy and not rows["b"].is_nsfw_heavy


def test_empty_tables(spark):
    none = spark.createDataFrame([], "doc_id string, url string, source string, language string, text string")
    assert stages.curate(none, {"english": "eng"}).count() == 0
    assert dedup.near_duplicates(none).count() == 0


def test_near_duplicates_classes(spark):
    base = " ".join(f"word{i}" for i in range(200))
    rows = [(1, base), (2, base), (3, base.replace("word7 ", "other ")), (4, "something else entirely " * 3), (5, None), (6, "")]
    got = {r.doc_id: r.class_id for r in dedup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {1: 1, 2: 1, 3: 1, 4: 4, 5: 5, 6: 6}


def _brute_force(rows):
    grams = lambda w: {tuple(w[i : i + 5]) for i in range(len(w) - 4)}
    sets, cls = {k: grams(t.split()) for k, t in rows}, {k: k for k, _ in rows}
    for a in sets:
        for b in sets:
            if a < b and cls[a] != cls[b] and len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b]):
                low, high = sorted((cls[a], cls[b]))
                cls = {k: low if v == high else v for k, v in cls.items()}
    return cls


def test_near_duplicates_in_a_crowded_bucket(spark, monkeypatch):
    # two templates of 200 unlike variants (at about 0.6) each, which stand in id order between the template and its near copy
    rng, rows = random.Random(5), []
    for t in (0, 1):
        for k in [0, *range(1, 201), 201]:
            words = [f"t{t}x{i}" for i in range(204)]
            for i in {0: [], 201: [20, 60, 100, 140]}.get(k, range(rng.randrange(5, 10), 204, 20)):
                words[i + (rng.randrange(10) if 0 < k < 201 else 0)] = f"changed{t}x{k}"
            rows.append((1000 * t + k, " ".join(words)))
    monkeypatch.setattr(dedup, "CELL", 7, raising=False)
    want = _brute_force(rows)
    assert sorted(k for k, v in want.items() if v != k) == [201, 1201]
    got = {r.doc_id: r.class_id for r in dedup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == want


def test_crowded_pairs_are_all_met(spark, monkeypatch):
    monkeypatch.setattr(dedup, "CELL", 4)
    label = lambda h: 0 if h < 20 else h // 3
    prefix = spark.createDataFrame([(g, h, 10, 10, label(h)) for g in (1, 2) for h in range(40)], "g long, h long, n int, rest int, label long")
    got = [tuple(sorted((r.a, r.b))) for r in dedup._crowded_pairs(prefix.where("g = 1")).collect()]
    assert sorted(got) == [(a, b) for a in range(40) for b in range(a + 1, 40) if label(a) != label(b)]
    assert {tuple(sorted((r.a, r.b))) for r in dedup._crowded_pairs(prefix).collect()} == set(got)


def test_near_duplicates_at_the_bound(spark):
    # one text is the beginning of the other: 80 of 100 shingles are the same, and 79 of 100
    text = lambda t, n: " ".join(f"{t}{i}" for i in range(n + 4))
    rows = [(10, text("a", 100)), (110, text("a", 80)), (20, text("b", 100)), (120, text("b", 79))]
    got = {r.doc_id: r.class_id for r in dedup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {10: 10, 110: 10, 20: 20, 120: 120}


def test_components_do_not_stop_early(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(0, 300) if i != 150], "a long, b long")
    got = {r.node: r.root for r in dedup.components(links).collect()}
    assert got == {i: 0 if i <= 150 else 151 for i in range(301)}


def test_json_to_documents(spark, tmp_path):
    (tmp_path / "a.json").write_text(json.dumps({"doc_id": "d", "url": "https://x.example/1", "source": "s", "timestamp": "01/01/23 10:00", "html": "<html><title>T</title><p>Hello there.</p></html>"}))
    (tmp_path / "b.json").write_text(json.dumps({"doc_id": "e", "url": "u", "source": "s", "text": "plain"}))
    raw = stages.json_to_parquet(spark, str(tmp_path / "*.json"), "english")
    assert {r.doc_id: r.text for r in raw.collect()}["e"] == "plain"
    out = stages.extract_text(raw).collect()
    assert [(r.doc_id, r.successful_extraction, r.text) for r in out] == [("d", True, "Hello there.")]
    with pytest.raises(NotImplementedError):
        stages.json_to_parquet(spark, "x", "english", "asr")


def test_command_line_stages(spark, tmp_path):
    rows = [("1", "u", "s", "english", "One two three. Four five six. Seven eight nine ten. More words follow here. End of it.\nbad chunk")]
    p = lambda x: str(tmp_path / x)
    sinks.write_parquet(spark.createDataFrame(rows, "doc_id string, url string, source string, language string, text string"), p("in"))
    sinks.write_parquet(spark.createDataFrame([("english", "eng")], "language string, iso639_3 string"), p("names"))
    cli.run(spark, ["DocCleanStage", "--doc_df_parquets_path", p("in"), "--cleaned_doc_output_path", p("clean")])
    cli.run(spark, ["LIDStage", "--lid_df_parquets_path", p("clean"), "--language_table", p("names"), "--doc_lid_output_path", p("lid")])
    cli.run(spark, ["AnalysisStage", "--analysis_df_parquets_path", p("lid"), "--line_stats_output_path", p("lines"), "--doc_stats_output_path", p("stats"), "--analysis_output_path", p("docs")])
    cli.run(spark, ["FlaggingAndFilteringStage", "--doc_stats_parquets_path", p("stats"), "--filtered_doc_stats_output_path", p("kept")])
    assert spark.read.parquet(p("stats")).count() == 1
    cli.run(spark, ["DocumentRemovalStage", "--analysis_out_path", p("docs"), "--doc_stats_path", p("stats"), "--filtered_docs_path", p("final")])
    assert spark.read.parquet(p("final")).collect()[0].text.startswith("One two three.")
    assert "doc_lang" in spark.read.parquet(p("docs")).columns


def test_config_variants(tmp_path):
    assert config.for_language("gujarati").word_ngram_cum_thresholds == {"5": 0.3}
    assert not config.for_scans("hindi").remove_code and config.for_scans("hindi").word_ngram_cum_thresholds == {"5": 0.4}
    (tmp_path / "c.json").write_text('{"min_line_count": 9, "other": 1}')
    assert config.load(str(tmp_path / "c.json")).min_line_count == 9
    assert config.as_bool("Yes") and not config.as_bool("0") and config.as_list("a,b") == ["a", "b"]
    with pytest.raises(ValueError):
        config.as_bool("maybe")


def test_lines_round_trip_and_stats(spark):
    df = spark.createDataFrame([(1, "a b. c!\n\nd"), (2, None)], "doc_id long, text string")
    rows = lines.doc_to_sentences(df)
    assert {r.doc_id: r.text for r in lines.lines_to_doc(rows).collect()} == {1: "a b. c!\n\nd"}
    s = stats.doc_stats(stats.line_stats(rows, lang_col=None)).collect()[0]
    assert (s.lines_count, s.char_count) == (3, 10)
    assert stats.repeated_line_dist(rows).collect()[0].repeated_line_dist == {"a b.": 1, " c!\n\n": 1, "d": 1}


def test_stream_cleans_like_batch(spark, tmp_path):
    from lekhani.streaming import clean as stream

    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.json").write_text(json.dumps({"doc_id": "1", "url": "u", "text": "Good one.\nbad"}))
    src = stream.read_json_stream(spark, str(tmp_path / "in"), ["doc_id", "url", "text"])
    q = stream.write_stream(stream.clean_stream(src, ["url"], replace(config.Config(), remove_code=False)), str(tmp_path / "out"), str(tmp_path / "cp"))
    q.awaitTermination(60)
    assert [r.text for r in spark.read.parquet(str(tmp_path / "out")).collect()] == ["Good one.\n"]


def test_manifest_and_histogram(spark, tmp_path):
    sinks.write_parquet(spark.range(5).toDF("n"), str(tmp_path / "a"))
    (tmp_path / "list.txt").write_text(str(tmp_path / "a") + "\n\n")
    df = readers.read_manifest(spark, str(tmp_path / "list.txt"))
    assert df.count() == 5 and sinks.partition_histogram(df).agg(F.sum("rows")).collect()[0][0] == 5
