"""Pieces keep their invariants for any size an overlap of just under half allows."""

import random

import numpy as np
import pyarrow as pa
import pytest

from lekhani.llm import encode, splitting

WORDS = ["a", "word", "longish-word", "supercalifragilisticexpialidocious", "नमस्ते", "योजनाओं", "😀", "𓀀𓀁𓀂", "x" * 90, "क" * 40, "1234567890" * 5, "!?", "é"]


def _text(rng):
    out = []
    for _ in range(rng.randrange(0, 160)):
        out.append(rng.choice(WORDS))
        out.append(rng.choice([" ", " ", " ", ". ", "\n", "\n\n", "", "  \r\n"]))
    return "".join(out)


def check(bpe, texts, most, overlap):
    batch = splitting._pieces(bpe, texts, pa.array(range(len(texts))), ["s"], np.array([most]), np.array([overlap]))
    rows = batch.to_pylist() if batch else []
    for i, t in enumerate(texts):
        ids = bpe.encode(t)
        mine = [r for r in rows if r["_id"] == i]
        assert bool(mine) == (len(ids) > most)
        ends = np.cumsum([len(bpe.bytes_of[x]) for x in ids])
        for k, r in enumerate(mine):
            assert r["piece_no"] == k and r["n_pieces"] == len(mine)
            assert 0 <= r["token_start"] < r["token_end"] <= len(ids) and r["token_end"] - r["token_start"] <= most
            assert r["token_start"] == (0 if k == 0 else mine[k - 1]["token_end"] - overlap)
            assert r["token_start"] >= (0 if k == 0 else mine[k - 1]["token_start"])
            assert r["text"] == t[r["char_start"] : r["char_end"]]
            # the text is that of the tokens, with the whole character a shared part begins inside
            begin = int(ends[r["token_start"] - 1]) if r["token_start"] else 0
            before = t.encode()[:begin].decode("utf-8", "ignore")
            assert r["char_start"] == len(before) and len(t[: r["char_end"]].encode()) == ends[r["token_end"] - 1]
        assert not mine or mine[-1]["token_end"] == len(ids)
    return len(rows)


@pytest.mark.parametrize("seed", range(4))
def test_any_size_and_overlap(seed):
    rng, bpe = random.Random(seed), encode.encoder()
    made = 0
    for _ in range(150):
        most = rng.choice([8, 9, 10, 16, 33, 64, 100, 256])
        overlap = rng.choice([0, 1, (most - 1) // 2, rng.randrange(0, (most - 1) // 2 + 1)])
        made += check(bpe, [_text(rng) for _ in range(3)], most, overlap)
    assert made > 1000


def test_natural_boundaries_come_first():
    bpe = encode.encoder()
    text = "\n\n".join("One sentence here. Another one there." for _ in range(40))
    batch = splitting._pieces(bpe, [text], pa.array([0]), ["s"], np.array([40]), np.array([0]))
    assert all(x.startswith("One") for x in batch.column("text").to_pylist())
    assert "".join(batch.column("text").to_pylist()) == text
    # a word is opened only where no word ends
    text = "tiny " + "x" * 3000
    parts = splitting._pieces(bpe, [text], pa.array([0]), ["s"], np.array([16]), np.array([0])).column("text").to_pylist()
    assert "".join(parts) == text


def test_refused_sizes(spark):
    df = spark.createDataFrame([(1, "a")], "doc_id long, text string")
    for size in (("s", 7, 0), ("s", 10, 5), ("s", 10, -1), ("s", None, 0), ("s", 10, None)):
        with pytest.raises(ValueError):
            splitting.split_long_texts(df, [size])
