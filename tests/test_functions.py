import random
import re

import pytest
from pyspark.sql import functions as F

from lekhani.functions import code as C
from lekhani.functions import html as H
from lekhani.functions import keywords as K
from lekhani.functions import language as L
from lekhani.functions import ngrams as N
from lekhani.functions import text as T


def value(spark, build, *texts):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    return [r.v for r in df.select("i", build(F.col("t")).alias("v")).orderBy("i").collect()]


def test_counts(spark):
    texts = ("", " ", "a  b", "a\tb", "क्या 😀", None)
    assert value(spark, T.word_count, *texts) == [1, 2, 3, 1, 2, None]
    assert value(spark, T.char_count, *texts) == [0, 1, 4, 3, 6, None]
    assert value(spark, T.byte_count, *texts) == [len(t.encode()) if t is not None else None for t in texts]


def test_numbers_and_marks(spark):
    assert value(spark, T.is_number, "", "12", "१२३", "1a") == [False, True, True, False]
    assert value(spark, T.is_number_or_marks, "", "12", "ab12", "ab1", "...") == [False, True, True, False, True]
    assert value(spark, T.symbol_ratio, "", "a!", "é", "a b\n") == [None, 0.5, 1.0, 0.0]


def test_endings(spark):
    assert value(spark, T.ends_properly, "", "a...", "a####", "a:", "a. ", "क।।", "س؟") == [False, False, False, True, False, True, True]
    assert value(spark, lambda t: T.cut_after_terminal(t, 1), "a b. c", "a. b", "none", "x y...", "a b.") == ["a b.", None, None, None, "a b."]


def test_sentences_against_reference_semantics(spark):
    rng = random.Random(1)
    texts = ["", "a", "a.", "a.\n\nb", "...", "a|b", "क।ख", "س؟"] + ["".join(rng.choice("ab .!?।\n|é") for _ in range(rng.randrange(40))) for _ in range(200)]

    def expect(t):
        parts = re.split(r"([.?!।|॥؟۔](?:\n+)?)", t)
        return [a + b for a, b in zip(parts[::2], parts[1::2])] + [parts[-1]]

    assert value(spark, T.split_sentences, *texts) == [expect(t) for t in texts]


def test_code_removal(spark):
    both = lambda t: C.remove_code(t, C.code_spans(t))
    assert value(spark, C.code_spans, "no code. here", "a <b>x</b> c", None) == [None, [[2, 10]], None]
    assert value(spark, both, "pre .c{a} mid <b>x</b> post", "plain") == ["pre .c{a} mid  mid <b>x</b> post", "plain"]
    merged = lambda t: C.remove_code(t, C.code_spans(t), merged=True)
    assert value(spark, merged, "pre .c{a} mid <b>x</b> post") == ["pre  mid  post"]


def test_ngram_scores_against_brute_force(spark):
    from collections import Counter
    from math import sqrt

    rng = random.Random(2)
    texts = ["", "abc", "aaaaaaaaaa", "x" * 40] + ["".join(rng.choice("abc ") for _ in range(rng.randrange(60))) for _ in range(60)]

    def char(t):
        c = Counter(t[i : i + 10] for i in range(len(t) - 9))
        return round(sum(sorted(c.values())[::-1][: int(sqrt(len(c)))]) / sum(c.values()), 9) if c else None

    got = [None if v is None else round(v, 9) for v in value(spark, lambda t: N.char_repetition(t, 10), *texts)]
    assert got == [char(t) for t in texts]
    assert value(spark, N.tokenize, "a,b 1.5 x", "3 , 4") == [["a", ",", "b", "1.5", "x"], ["3,4"]]
    assert value(spark, lambda t: N.word_repetition(t, 2), "a b a b", "a b c") == [pytest.approx(2 / 3), None]


def test_keywords(spark):
    terms = ["bad", "bad word", "x-y", ""]
    assert value(spark, lambda t: K.hits(t, terms), "Bad word, bad. xbad bad_ x-y", "", None) == [["bad word", "bad", "x-y"], [], None]
    assert value(spark, lambda t: K.total(K.distribution(t, terms)), "bad bad", "none") == [2, 0]
    assert value(spark, lambda t: K.hits(t, []), "bad") == [[]]
    assert [tuple(x) for x in value(spark, lambda t: K.hit_positions(t, ["ab"]), "xab ab 😀 AB")[0]] == [("ab", 4, 6), ("ab", 9, 11)]


def test_votes_and_html(spark):
    df = spark.createDataFrame([("a", "a", "a"), ("a", "b", "b"), ("a", "b", "c"), (None, "b", "b")], "x string, y string, z string")
    assert [r.v for r in df.select(L.hard_vote(F.col("x"), F.col("y"), F.col("z")).alias("v")).collect()] == ["a", "b", "a", "b"]
    assert value(spark, H.is_html, "<p>", "a < b > c", None) == [True, False, False]
    got = H.extract("<html><head><title>T</title><meta name=author content=A></head><body><nav>menu</nav><p>Text one.</p><p><a>link</a></p></body>", "https://x.example/a")
    assert got["text"] == "Text one." and got["title"] == "T" and got["author"] == "A" and got["hostname"] == "x.example"
    assert H.extract("plain") is None


def test_extraction_keeps_the_article_and_sets_comments_apart():
    page = """<html><head><title>The &amp; title</title><meta property="article:section" content="News"><link rel="license" href="https://l.example/by"></head><body>
    <div class="top-menu"><p>Home and more</p></div><main><h1>Head</h1><p>First <b>bold</b> text.</p><div class="share">Share it</div><time datetime="2020-01-02">x</time><p>Second one.</p></main>
    <div id="comments"><p>A reader said so.</p></div><p>Stray text</p><footer>Foot</footer></body>"""
    got = H.extract(page, "https://x.example/a")
    assert got["text"] == "Head\nFirst bold text.\nx\nSecond one." and got["comments"] == "A reader said so."
    assert (got["categories"], got["license"], got["date"], got["title"]) == ("News", "https://l.example/by", "2020-01-02", "The & title")
    assert H.extract(page.replace("First", "FIRST"), None)["fingerprint"] == got["fingerprint"]
    assert H.extract("<p>no end<p>more")["text"] == "no end\nmore"


def test_three_detectors_differ_and_vote(spark):
    texts = ["यह घर में है और वह नहीं है।", "हे घर आहे आणि ते नाही.", "yeh ghar mein hai aur nahin tha", "The cat of the house is in it.", "চৰকাৰ আৰু নদী", "এই নদী এবং মাঠ", "12 !", "", "sarkaar bhaarat kheton dhoop"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate([*texts, None])], "i int, text string")
    codes = {"hindi": "hin", "marathi": "mar", "english": "eng", "bengali": "ben", "assamese": None}
    rows = {r.i: r for r in L.identify(df, L.default_detectors(), codes, ["i"]).collect()}
    assert [rows[i].doc_lang for i in range(6)] == ["hindi", "marathi", "hindi", "english", "assamese", "bengali"]
    assert rows[6].doc_lang == rows[7].doc_lang == "other" and rows[9].doc_lang is None and rows[9].lang_per_model is None
    assert rows[2].script_lang == "english" and rows[2].routed_script == "Latn" and rows[2].lang_per_model["words_lang"] == "hindi"
    assert rows[8].routed_lang == "hindi"  # by letter pairs: no known word
    assert rows[4].doc_lang_iso is None and rows[6].doc_lang_iso == "other"
    assert L.identify_one(spark, texts[0], codes)["doc_lang"] == "hindi"


def test_a_plugged_in_detector_votes(spark):
    class Always(L.Detector):
        name = "always"

        def load(self):
            self.loaded = True

        def predict(self, texts):
            return [("marathi", 1.0)] * len(texts)

    df = spark.createDataFrame([("यह घर है",), (None,)], "text string")
    got = L.identify(df, [L.ScriptDetector(), Always(), L.WordDetector()], {"hindi": "hin", "marathi": "mar"}, ["text"]).collect()
    assert {(r.always_lang, r.doc_lang) for r in got} == {("marathi", "hindi"), (None, None)}


def test_normalisation_rules(spark):
    from lekhani.functions import normalize as U

    df = spark.createDataFrame([("कफ़ी| ‌अ:", "hindi"), ("“ﬁ”­…", "english"), ("কো", "bengali"), (None, "tamil"), ("a|b", None)], "t string, l string")
    got = [r.v for r in df.select(U.normalize(F.col("t"), F.col("l")).alias("v")).collect()]
    assert got == ["कफ़ी। अः", "“fi”­...", "কো", None, "a|b"]


def test_sentence_plug_in(spark):
    texts = ["Dr. Rao came. He left! \"Yes.\" It was 3.5 m. A. B. Shah spoke", "यह है। वह है।", "", None]
    assert value(spark, T.split_at_terminal, *texts)[:2] == [["Dr. Rao came.", "He left!", '"Yes."', "It was 3.5 m.", "A. B. Shah spoke"], ["यह है।", "वह है।"]]
    own = lambda t, lang: t.split(",")
    assert value(spark, lambda t: T.split_by(own, t, F.lit("x")), "a,b", None) == [["a", "b"], None]
