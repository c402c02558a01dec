"""Page groups of crowded books; candidates against brute force."""

import random

from pyspark.sql import functions as F

from lekhani.llm import ocr


def _neighbours_seen(pages, groups):
    """Whether every own page has the HALO pages before and after it in its group."""
    order = sorted(pages, key=lambda p: (p[1], p[2], p[0]))
    place = {p[0]: i for i, p in enumerate(order)}
    members: dict = {}
    for r in groups:
        members.setdefault((r._book, r._group), {})[r._doc] = members.get((r._book, r._group), {}).get(r._doc, False) or r._own
    owners: dict = {}
    for docs in members.values():
        here = {place[d] for d in docs}
        for d, own in docs.items():
            if own:
                owners[d] = owners.get(d, 0) + 1
                i = place[d]
                near = [j for j in range(max(0, i - ocr.HALO), min(len(order), i + ocr.HALO + 1)) if abs(order[j][1] - order[i][1]) <= ocr.HALO]
                assert here >= set(near), (d, order[i])
    assert owners == {p[0]: 1 for p in pages}


def test_crowded_books_keep_their_neighbours(spark):
    rng = random.Random(3)
    places = [1] * 900 + [2] * 3 + [5] * 400 + list(range(60, 140))
    rows = [(f"d{i}", "hot", p, f"text {i}", "name") for i, p in enumerate(places)]
    base = spark.createDataFrame(rows, "_doc string, _book string, _place long, _text string, _name string")
    for most in (100, 300, 10_000):
        groups = ocr.page_groups(base, most).collect()
        at = {r._doc: r._at for r in groups}
        pages = [(d, p, at[d]) for d, _, p, _, _ in rows]
        rng.shuffle(pages)
        _neighbours_seen(pages, groups)
        sizes: dict = {}
        for r in groups:
            sizes[r._group] = sizes.get(r._group, 0) + 1
        assert most == 10_000 or max(sizes.values()) <= most / 2 * 1.5 + 4 * ocr.EDGE_PAGES + 24 * ocr.EDGE_PAGES


def test_pages_without_book_or_place_are_read_alone(spark):
    base = spark.createDataFrame([("a", None, 1, "x", None), ("b", "k", None, "y", None), ("c", "k", 3, "z", None)], "_doc string, _book string, _place long, _text string, _name string")
    rows = {(r._doc, r._own) for r in ocr.page_groups(base, 10).collect() if r._own}
    assert rows == {("a", True), ("b", True), ("c", True)}


def test_candidates_equal_brute_force(spark):
    """Every known word within the edits is found, of any length."""
    rng = random.Random(5)
    letters = "abcdeपानी"
    known = {"".join(rng.choice(letters) for _ in range(rng.randrange(2, 14))): 1000 for _ in range(150)}
    words = dict(known)
    for w in list(known):
        for _ in range(3):
            bad = list(w)
            for _ in range(rng.choice((1, 1, 2))):
                k = rng.randrange(len(bad)) if bad else 0
                bad[k : k + 1] = rng.choice((["z"], [], [bad[k], "y"] if bad else ["y"]))
            words.setdefault("".join(bad) or "z", 1)
    vocabulary = spark.createDataFrame(list(words.items()), "word string, n long")
    got = {(r.word, r.right) for r in ocr.correction_candidates(vocabulary, vocabulary).collect()}

    def distance(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            last, row[0] = row[0], i
            for j, y in enumerate(b, 1):
                last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
        return row[-1]

    want = {(w, r) for w, n in words.items() if n == 1 for r in known if w != r and distance(w, r) <= (1 if len(w) <= 4 else 2)}
    assert got == want and len(want) > 300


def test_vocabulary_of_no_words(spark):
    none = spark.createDataFrame([], "word string, n long")
    assert ocr.correction_candidates(none, none).count() == 0
    assert ocr.corrections(none.select("word", F.col("n"))).count() == 0


def test_misreadings_are_found_however_often_they_were_seen(spark):
    """The same words and shares, a hundred times the corpus: the same corrections."""
    rng = random.Random(9)
    parts = ["ba", "de", "mi", "no", "ru", "wen", "hal", "sid", "tor", "gam"]
    real = {"".join(rng.choice(parts) for _ in range(rng.randrange(2, 5))): rng.randrange(2000, 20_000) for _ in range(400)}
    counts, truth = dict(real), {}
    for w, n in real.items():
        for a, b in (("m", "rn"), ("d", "cl"), ("n", "ri"), ("w", "vv"), ("e", "c"), ("o", "0")):
            bad = w.replace(a, b, 1)
            if len(w) >= 5 and bad not in counts:
                counts[bad], truth[bad] = max(1, n // 300), w
    for times in (1, 100):
        vocabulary = spark.createDataFrame([(w, n * times) for w, n in counts.items()], "word string, n long")
        got = {r.word: r.right for r in ocr.corrections(vocabulary).collect()}
        found = sum(got.get(w) == r for w, r in truth.items())
        assert found >= 0.97 * len(truth) and not got.keys() & real.keys(), (times, found, len(truth), len(got))
