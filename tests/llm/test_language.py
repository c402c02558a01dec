"""Language operator: held-out accuracy, wrong labels, odd inputs."""

import random

import numpy as np
import pytest

from lekhani.llm import language

WORDS = {
    "english": "the cat sat on mat and dog ran she was in house with him it is a fine day for that".split(),
    "hindi": "यह घर में है और वह नहीं है लोग साथ काम करते हैं पानी बिजली के लिए योजना".split(),
    "marathi": "हे घर आहे आणि ते नाही लोक सोबत काम करतात पाणी वीज साठी योजना मध्ये होते".split(),
    "latin hindi": "yeh ghar mein hai aur woh nahin log saath kaam karte paani bijli ke liye yojana".split(),
}
LID = "doc_id string, language string, text string, lang_per_model map<string,string>"


def _line(rng, kind):
    return " ".join(rng.choices(WORDS[kind], k=9)) + ("." if "english" in kind or "latin" in kind else "।")


@pytest.fixture(scope="module")
def names(spark):
    return spark.createDataFrame([("english", "en", "eng"), ("hindi", "hi", "hin"), ("marathi", "mr", "mar")], "language string, iso639_1 string, iso639_3 string")


@pytest.fixture(scope="module")
def corpus(spark):
    """Of ten labels one or two are wrong, and Hindi in Latin letters is often called Marathi."""
    rng, rows = random.Random(7), []
    for i in range(400):
        kind = ["english", "english", "hindi", "marathi", "latin hindi"][i % 5]
        right = "hindi" if kind == "latin hindi" else kind
        wrong = rng.choice(["english", "hindi", "marathi"])
        said = right if rng.random() < 0.85 else wrong
        model = ("marathi" if rng.random() < 0.3 else right) if kind == "latin hindi" else right if rng.random() < 0.9 else wrong
        rows.append((f"d{i}", said, "\n".join(_line(rng, kind) for _ in range(4)), {"a": model, "b": model, "c": said}))
    return spark.createDataFrame(rows, LID), {f"d{i}": ["english", "english", "hindi", "marathi", "hindi"][i % 5] for i in range(400)}


@pytest.fixture(scope="module")
def model(spark, corpus, names):
    return language.train(corpus[0], names)


def test_held_out_lines(model):
    rng = random.Random(8)
    for kind in WORDS:
        lines = [_line(rng, kind) for _ in range(60)]
        lang, _ = model.classify(language.read_parts(lines))
        right = "hindi" if kind == "latin hindi" else kind
        assert np.mean([x >= 0 and model.languages[x] == right for x in lang]) > 0.95, kind


def test_half_the_sample_says_the_same(spark, corpus, names, model):
    """Two models from different halves of the rows agree on nearly all lines."""
    rng = random.Random(9)
    parts = language.read_parts([_line(rng, k) for k in WORDS for _ in range(100)])
    said = []
    for digit in ("02468", "13579"):
        half = language.train(corpus[0].where(f"instr('{digit}', right(floor(substr(doc_id, 2) / 5), 1)) > 0"), names)
        said.append([half.languages[max(x, -2 - x)] for x in half.classify(parts)[0]])
    assert np.mean([a == b for a, b in zip(*said, strict=True)]) > 0.97


def test_foreign_lines(spark, model, names):
    text = "the cat sat on the mat and the dog ran.\n\nयह घर में है और वह नहीं है। the dog ran in the house.\n12 !\nyeh ghar mein hai aur woh nahin hai"
    rows = [("a", "en", text), ("b", " HINDI ", text), ("b", " HINDI ", text), ("c", None, "the cat"), ("d", "other", "the cat"), ("e", "en", None), ("f", "en", ""), ("g", None, "12 !"), (None, "hi", "the cat sat on the mat")]
    df = spark.createDataFrame(rows, "doc_id string, language string, text string").withColumns({"lang": language.F.lit(1), "line_no": language.F.lit(2)})
    named = df.withColumn("named", language.named_language(df.language, names))
    got = {tuple(r) for r in language.foreign_lines(language.line_languages(named, model, ["doc_id", "named"])).collect()}
    assert got == {("a", 2, "hindi"), ("a", 4, "hindi"), ("b", 0, "english"), ("b", 2, "english"), ("c", 0, "english"), ("d", 0, "english"), (None, 0, "english")}


def test_parts_do_not_depend_on_slices(monkeypatch, model):
    texts = ["One line here.\nNamaste. Two lines.", "", "हिन्दी का वाक्य।", "Another text, then.\n\nLast", "12"]
    whole = language._classified(texts, model)
    monkeypatch.setattr(language, "PART", 20)
    sliced = language._classified(texts, model)
    for f in ("text", "line", "script", "letters", "begin", "end"):
        assert (getattr(whole[0], f) == getattr(sliced[0], f)).all(), f
    assert (whole[1] == sliced[1]).all()


def test_very_long_texts(model):
    """A text of one unbroken run is cut, and keeps every letter."""
    p, lang, _, _ = language._classified(["a" * 400_000, "the cat sat on the mat. " * 20_000], model)
    assert p.letters[p.text == 0].sum() == 400_000 and (p.line == 0).all()
    assert (np.diff(p.begin[p.text == 1]) > 0).all()
    assert {model.languages[x] for x in lang[p.text == 1]} == {"english"}


def test_nothing_to_learn_from(spark, names):
    for rows in ([], [("a", "en", "12", None), ("b", None, "words", None)]):
        df = spark.createDataFrame(rows, LID)
        none = language.train(df, names)
        assert none.languages == []
        got = language.line_languages(df.withColumn("named", df.language), none, ["doc_id", "named"])
        assert {r.lang for r in got.collect()} <= {"unknown"} and language.foreign_lines(got).count() == 0
    only = language.train(spark.createDataFrame([("a", "en", "the cat sat on the mat", None)], LID).drop("lang_per_model"), names)
    assert only.languages == ["english"]


def test_empty_table(spark, model):
    none = spark.createDataFrame([], "doc_id string, named string, text string")
    assert language.line_languages(none, model, ["doc_id", "named"]).count() == 0
    assert language.document_languages(language.language_parts(none, model, ["doc_id"])).count() == 0
