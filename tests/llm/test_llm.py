import random

import numpy as np
import pytest

from lekhani.llm import encode, mixing, ocr, pagebody, quality, queries, repetition, sitelines, splitting, toxicity

tiktoken = pytest.importorskip("tiktoken")


@pytest.fixture(scope="module")
def reference():
    import base64

    with open("/opt/tokenizers/byte_bpe_50k.tiktoken", "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    pattern = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
    return tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


ALPHABET = "ab \n'st.é中😀क्1\xa0"


def test_encoding_equals_public_library(reference):
    rng, bpe = random.Random(3), encode.encoder()
    for _ in range(2000):
        s = "".join(rng.choice(ALPHABET) for _ in range(rng.randrange(30)))
        assert bpe.encode(s) == reference.encode_ordinary(s)
    assert bpe.encode("") == bpe.encode(None) == []
    assert len(bpe.encode("ab" * 200_000)) > 0


def test_appends_and_edits_stay_exact(reference):
    rng, bpe = random.Random(4), encode.encoder()
    e, now = encode.EditableEncoding(bpe), ""
    for _ in range(400):
        if rng.random() < 0.5 or len(now) < 5:
            s = "".join(rng.choice(ALPHABET) for _ in range(rng.randrange(1, 6)))
            e.append(s)
            now += s
        else:
            i = rng.randrange(len(now))
            j, s = min(len(now), i + rng.randrange(4)), "".join(rng.choice(ALPHABET) for _ in range(rng.randrange(3)))
            e.replace(i, j, s)
            now = now[:i] + s + now[j:]
        assert (e.text, e.ids) == (now, reference.encode_ordinary(now))


def test_pieces_invariants(spark):
    bpe = encode.encoder()
    texts = ["word " * 300, "x" * 2000, "para one.\n\nPara two is here. And more.\n" * 40, "क" * 300, "short", "", None]
    df = spark.createDataFrame([(i, t, "clash") for i, t in enumerate(texts)], "doc_id long, text string, piece_no string")
    sizes = [("a", 64, 0), ("b", 100, 10)]
    rows = splitting.split_long_texts(df, sizes).collect()
    for i, t in enumerate(texts):
        ids = bpe.encode(t)
        for name, most, overlap in sizes:
            mine = sorted((r for r in rows if r.doc_id == i and r.size_name == name), key=lambda r: r.piece_no)
            assert bool(mine) == (len(ids) > most)
            for k, r in enumerate(mine):
                assert r.token_end - r.token_start <= most and r.text == t[r.char_start : r.char_end] and r.n_pieces == len(mine)
                assert r.token_start == (0 if k == 0 else mine[k - 1].token_end - overlap)
            assert not mine or mine[-1].token_end == len(ids)
    with pytest.raises(ValueError):
        splitting.split_long_texts(df, [("bad", 10, 9)])


def test_mixture_shares_and_repeats(spark):
    sizes = spark.createDataFrame([(i, "big", 10) for i in range(1000)] + [(2000 + i, "small", 10) for i in range(10)], "doc_id long, source string, n_tokens long")
    targets = spark.createDataFrame([("big", 0.5, 1), ("small", 0.3, 3), ("none", 0.2, 2), (None, 0.1, 1)], "source string, target_share double, max_repeats int")
    plan = mixing.plan_mixture(sizes, targets)
    mixed = mixing.mix(sizes, plan, bucket_tokens=500)
    shares = {r.source: r for r in mixing.reached_shares(mixed, plan).collect()}
    assert shares["small"].mixed_tokens == 300 and shares["small"].most_repeats == 3
    assert shares["big"].mixed_tokens == 500 and shares["none"].mixed_tokens == 0
    assert abs(shares["big"].reached_share - 0.625) < 1e-9
    counts = {}
    for r in mixed.collect():
        counts[r.doc_id] = counts.get(r.doc_id, 0) + 1
        assert 0 < r.take_tokens <= r.n_tokens
    assert max(counts.values()) == 3


def test_repetition_against_brute_force(spark):
    rng = random.Random(5)
    texts = ["", None, "a b c d e " * 3, "One, two three four five. one two three FOUR five!"] + [" ".join(rng.choice("abc") for _ in range(rng.randrange(40))) for _ in range(60)]
    df = spark.createDataFrame([(i, t, 1) for i, t in enumerate(texts)], "doc_id long, text string, n_words int")
    got = {r.doc_id: (r.repeated_words, r.n_words) for r in repetition.score_repetition(df).collect()}
    for i, t in enumerate(texts):
        words = [w for w in (x.strip(".,!") for x in (t or "").lower().split()) if w]
        seen, covered = set(), set()
        for k in range(len(words) - 4):
            g = tuple(words[k : k + 5])
            if g in seen:
                covered |= set(range(k, k + 5))
            seen.add(g)
        assert got[i] == (len(covered), len(words))
    with pytest.raises(ValueError):
        repetition.score_repetition(df, (repetition.Rule("x", "unknown", "<", 1),))


def test_site_lines_against_brute_force(spark):
    rng = random.Random(6)
    rows = []
    for i in range(120):
        host = rng.choice(["a.example", "WWW.a.example:80", "m.b.example", "c.example"])
        lines = [f"Own text number {rng.random()} of page {i} with words", f"© {2000 + i % 9} The Company. All rights reserved"][:: rng.choice((1, -1))]
        rows.append((f"d{i}", f"https://{host}/p/{i}", "\n".join([*lines, rng.choice(["Share", "share!", "  SHARE 12", "other"])])))
    rows += [rows[0], ("n", None, "x"), ("e", "https://a.example/e", ""), ("z", "https://a.example/z", None)]
    df = spark.createDataFrame(rows, "doc_id string, url string, text string")
    got = {(r.doc_id, r.line_no) for r in sitelines.repeated_site_lines(df).collect()}

    def key(line):
        return "".join(c for c in line.lower() if not c.isdigit() and not c.isspace()).strip("©.!")

    docs, count, where = {}, {}, set()
    for i, u, t in rows:
        if not u:
            continue
        site = u.split("/")[2].lower().split(":")[0].removeprefix("www.").removeprefix("m.")
        docs.setdefault(site, set()).add(i)
        for n, line in enumerate((t or "").split("\n")):
            if k := key(line):
                count.setdefault((site, k), set()).add(i)
                where.add((i, n, site, k))
    want = {(i, n) for i, n, s, k in where if len(count[s, k]) >= 5 and len(count[s, k]) >= 0.15 * len(docs[s])}
    assert got == want
    cleaned = {r.doc_id: r for r in sitelines.strip_site_lines(df, sitelines.repeated_site_lines(df)).collect()}
    assert cleaned["z"].text is None and "reserved" not in cleaned["d5"].text


def test_page_body():
    page = """<html><head><title>The long title of a page - Site</title><script>x="<p>no</p>"</script></head><body><nav><a>Home</a></nav>
    <div><h1>The long title of a page</h1><div>By A Writer, 1/2/2024</div><p>This is the <b>first</b> paragraph of the article &amp; it is in the body of the page.</p>
    <ul><li>an item</li><li><a>linked item</a></li></ul><p><strong>Don't miss:</strong> <a>another story that is linked from here</a></p><div><a>Share</a> <a>Tweet</a></div></div>
    <div><p>All of the trademarks belong to the owners of the site and to nobody else at all.</p></div>"""
    got = pagebody.article_blocks(page)
    assert got == ["The long title of a page", "This is the first paragraph of the article & it is in the body of the page.", "an item", "linked item"]
    assert pagebody.article_blocks("plain") == pagebody.article_blocks(None) == pagebody.article_blocks("<p>no heading here") == []


def test_text_kinds(spark):
    prose = "The committee met in the town hall on Monday. It was a long evening for all of them."
    rows = [("prose", prose), ("list", "• one\n• two\n• three"), ("table", "a;12;3.5\nb;13;2.5"), ("junk", "%*|=}@%*<&[[~]\n^$#*__%|]{<@_^"), ("none", None), ("empty", "")]
    df = spark.createDataFrame([(k, t, None, None) for k, t in rows] + [("stale", prose, 3, None), ("right", prose, 19 - 1, 0.0239)], "doc_id string, uncleaned_text string, uncleaned_words_count int, symbol_ratio float")
    got = {(r.doc_id, r.kind) for r in quality.text_kinds(df).collect()}
    assert got >= {("list", "list"), ("table", "table"), ("junk", "junk"), ("stale", "stale")}
    assert {d for d, _ in got} == {"list", "table", "junk", "stale"}
    assert quality.text_statistics(df, text_col="uncleaned_text").count() == 8


def test_disguised_terms_and_quotes():
    t = toxicity.Terms([("grubwit", "abusive"), ("wuzzle-eater", "abusive"), ("चपलोट", "abusive")])
    for s in ("grubwit", "GRUBWITS", "gr*bwit", "g r u b w i t", "grübwît", "gru​bwit", "grubwiiiit", "grubw17", "g.r.u.b.w.i.t", "wuzzl3-3473r", "च*पलोट"):
        assert "zztermabusive" in t.mark(f"you {s} there"), s
    assert "zzquotedabusive" in t.mark("the word “grubwit” is listed")
    assert "zz" not in t.mark("Grubwitton Road and grub wit")


def test_noisy_or_learns_and_locates(spark):
    rng = random.Random(8)
    calm = ["the market opened in the morning", "she went home after lunch", "the bridge was repaired last winter", "people said the news was good"]
    bad = "you worthless fool nobody likes you"
    docs, ratings = [], []
    for i in range(200):
        s = [rng.choice(calm) for _ in range(4)]
        if i % 5 == 0:
            s.insert(rng.randrange(4), bad)
        docs.append((i, ". ".join(s), "s"))
        ratings.append((i, "abusive" if i % 5 == 0 else "None "))
    docs += [(1000, None, "s"), (1001, "", None)]
    d = spark.createDataFrame(docs, "doc_id long, text string, source string")
    model = toxicity.train(d, spark.createDataFrame(ratings, "doc_id long, category string"), spark.createDataFrame([("grubwit", "abusive")], "term string, category string"))
    rows = {r.doc_id: r for r in toxicity.score_documents(d, model, ["doc_id", "source"]).collect()}
    right = sum((rows[i].abusive >= 0.5) == (i % 5 == 0) for i in range(200))
    assert right >= 195 and rows[1000].abusive == 0 and rows[1001].abusive == 0


def test_page_numbers_and_furniture():
    assert [ocr.page_number(x) for x in ("12", "[१२]", "— xiv —", "Page 203 of 223", "lO2", "the")] == [[12], [12], [14], [203], [102], []]
    weights = np.array([-6.0, 4.0, 2.0, 4.0, -2.0, -0.5])
    title = ["The Great Book", "The Grcat Book", "THE GREAT BOOK", "The Great Bok"]
    pages = [ocr.Page(f"p{i}", i + 10, ["First Chapter" if i == 0 else title[i % 4], "", f"{'abcdef'[i] * 7} went {'uvwxyz'[i] * 9} home, cut at the hy-", str(i + 10)], True, "") for i in range(6)]
    pages += [ocr.Page("p6", 16, ["The Great Book", "", "phen of the line, it ends here.", "1950"], True, "")]
    rows = ocr.read_book(pages, weights)
    marked = {(r[0], r[1]) for r in rows if r[2] == "furniture"}
    assert ("p0", 0) not in marked and {(f"p{i}", 0) for i in range(1, 7)} <= marked
    assert {(f"p{i}", 3) for i in range(6)} <= marked and ("p6", 3) not in marked
    assert [(r[4], r[5]) for r in rows if r[0] == "p5" and r[4]] == [("hy", "phen")]


def test_ranker_trees():
    rng = np.random.default_rng(1)
    x = rng.random((800, 3))
    y = ((x[:, 0] > 0.5) & (x[:, 1] > 0.3)).astype(float)
    assert ((ocr.Trees.fit(x, y).predict(x) > 0.5) == y).mean() > 0.97


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_query_runs(name, spark, data):
    assert queries.QUERIES[name](spark, data).count() >= 0


def test_empty_tables(spark):
    docs = spark.createDataFrame([], "doc_id long, text string, url string, source string")
    assert encode.encode_corpus(docs).count() == 0
    assert splitting.split_long_texts(docs, [("a", 64, 0)]).count() == 0
    assert repetition.score_repetition(docs).count() == 0
    assert sitelines.repeated_site_lines(docs).count() == 0
    assert pagebody.main_content(docs, html_col="text").count() == 0
    scans = spark.createDataFrame([], "doc_id string, url string, source string, language string, page_no string, identifier string, pdf_name string, text string")
    assert ocr.noise_items(scans).count() == 0
