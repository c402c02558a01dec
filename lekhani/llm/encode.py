"""Byte-level BPE encoding of a corpus by prefix dynamic programming.

For a byte string ``b`` every prefix ``b[:i]`` has exactly one BPE encoding,
hence exactly one *last token*. The table of last tokens is filled left to
right: a token ``t`` ending at ``i`` is the last token of ``b[:i]`` iff the
last token of ``b[:i-len(t)]`` may stand directly before ``t``. Two tokens may
be neighbours iff replaying their merges never lets a merge cross the border.
Appending bytes only extends the table; an edit invalidates it only from the
edit on, and text after the next coinciding word border keeps its tokens.

Fill cost is linear in the bytes (tokens ending at a place are bounded by the
vocabulary), also for texts of millions of characters without a break.
"""

from __future__ import annotations

import json
import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

DEFAULT_TOKENIZER = os.environ.get("LEKHANI_TOKENIZER", "/opt/tokenizers/byte_bpe_50k.json")

# Fixed value: the word pattern published with the 50k byte-level vocabulary.
WORD_PATTERN = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def _byte_alphabet() -> dict[str, int]:
    """The printable stand-in character of each byte in vocabulary files."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(hidden)}


class PrefixBpe:
    """Encoder holding the vocabulary, merge pairs and memo tables."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            model = json.load(f)["model"]
        alphabet = _byte_alphabet()
        raw = lambda s: bytes(alphabet[c] for c in s)
        vocab = model["vocab"]
        self.id_of: dict[bytes, int] = {}
        self.parts: dict[int, tuple[int, int]] = {}
        self.rank: dict[int, int] = {}
        self.joined: dict[tuple[int, int], int] = {}
        for c in alphabet:
            t = vocab[c]
            self.id_of[raw(c)] = t
            self.rank[t] = -1
        for k, merge in enumerate(model["merges"]):
            a, b = merge.split(" ") if isinstance(merge, str) else merge
            t, left, right = vocab[a + b], vocab[a], vocab[b]
            if t not in self.rank:
                self.id_of[raw(a + b)] = t
                self.parts[t] = (left, right)
                self.rank[t] = k
            self.joined[left, right] = t
        self.bytes_of = {t: b for b, t in self.id_of.items()}
        self.tails = {b[i:] for b in self.id_of for i in range(len(b))}
        self.words = regex.compile(WORD_PATTERN)
        self._neighbours: dict[tuple[int, int], bool] = {}
        self.packed = _PackedWords(self)

    def may_follow(self, a: int, b: int) -> bool:
        """Whether BPE keeps the border between adjacent tokens a and b."""
        key = (a, b)
        known = self._neighbours.get(key)
        if known is None:
            known = self._neighbours[key] = self._replay(a, b)
        return known

    def _replay(self, a: int, b: int) -> bool:
        # Undo the later of the two tokens' last merges again and again. While
        # a pair (x, y) faces the border, a merge of it would have to rank
        # below what was undone on either side to have happened first; on the
        # right side an equal rank also wins, as merging goes left to right.
        rank, parts = self.rank, self.parts
        below = (1 << 60, 0)
        x, y = a, b
        while True:
            crossing = self.joined.get((x, y))
            if crossing is not None and (rank[crossing], 0) < below:
                return False
            if x not in parts and y not in parts:
                return True
            if x in parts and (rank[x] > rank[y] or y not in parts):
                below, x = (rank[x], 0), parts[x][1]
            else:
                below, y = (rank[y], 1), parts[y][0]

    def extend(self, b: bytes, last: list[int]) -> list[int]:
        """Fill ``last`` (last token per prefix; entry 0 unused) up to ``b``."""
        id_of, tails = self.id_of, self.tails
        for i in range(len(last), len(b) + 1):
            found, j = -1, i - 1
            while j >= 0 and (piece := b[j:i]) in tails:
                t = id_of.get(piece)
                if t is not None and (j == 0 or self.may_follow(last[j], t)):
                    found = t
                    break
                j -= 1
            last.append(found)
        return last

    def encode_word(self, b: bytes) -> list[int]:
        """Token ids of one word's bytes, read back from the filled table."""
        whole = self.id_of.get(b)
        if whole is not None:
            return [whole]
        last, out, i = self.extend(b, [-1]), [], len(b)
        while i:
            t = last[i]
            out.append(t)
            i -= len(self.bytes_of[t])
        return out[::-1]

    def encode(self, text: str | None) -> list[int]:
        """Token ids of a text; the empty list for null and empty."""
        if not text:
            return []
        return np.frombuffer(b"".join(map(self.packed.__getitem__, self.words.findall(text))), np.int32).tolist()


class _PackedWords(dict):
    """Word -> its ids as packed int32; bounded, refilled when it overflows."""

    LIMIT = 400_000

    def __init__(self, bpe: PrefixBpe):
        super().__init__()
        self.bpe = bpe

    def __missing__(self, word: str) -> bytes:
        ids = np.asarray(self.bpe.encode_word(word.encode("utf-8")), np.int32).tobytes()
        if len(word) <= 64:
            if len(self) >= self.LIMIT:
                self.clear()
            self[word] = ids
        return ids


class EditableEncoding:
    """A text with its tokens, kept exact under appends and edits.

    Word borders come from a left-to-right scan without look-behind, so only
    the last word can change on an append, and after an edit the scan may stop
    at the first border that coincides with an old one in the unchanged tail. Up
    to three words before an edit are read again: a run of white space looks
    ahead over its own last character.
    """

    def __init__(self, bpe: PrefixBpe, text: str = ""):
        self.bpe, self.text = bpe, ""
        self.starts: list[int] = []
        self.words: list[list[int]] = []
        self._tail: tuple[bytes, list[int]] = (b"", [-1])
        self.rescanned = 0
        if text:
            self.append(text)

    @property
    def ids(self) -> list[int]:
        return [t for w in self.words for t in w]

    def append(self, more: str) -> None:
        begin = self.starts[-1] if self.starts else 0
        if self.starts:
            self.starts.pop()
            self.words.pop()
        self.text += more
        for m in self.bpe.words.finditer(self.text, begin):
            self.starts.append(m.start())
            self.words.append(self._word(m.group().encode("utf-8")))
            self.rescanned += 1

    def _word(self, b: bytes) -> list[int]:
        # the open last word keeps its table, so that growing it is an exact append
        old, last = self._tail
        last = self.bpe.extend(b, last[:] if b.startswith(old) and old else [-1])
        self._tail = (b, last)
        out, i = [], len(b)
        while i:
            out.append(last[i])
            i -= len(self.bpe.bytes_of[last[i]])
        return out[::-1]

    def replace(self, start: int, end: int, new: str) -> None:
        """Replace text[start:end]; only words near the edit are re-encoded."""
        shift = len(new) - (end - start)
        first = max(0, int(np.searchsorted(self.starts, start, "right")) - 3)
        begin = self.starts[first] if self.starts else 0
        old = {s + shift: k for k, s in enumerate(self.starts) if s >= end}
        self.text = self.text[:start] + new + self.text[end:]
        starts, words, keep = self.starts[:first], self.words[:first], len(self.starts)
        for m in self.bpe.words.finditer(self.text, begin):
            if m.start() >= start + len(new) and m.start() in old:
                keep = old[m.start()]
                break
            starts.append(m.start())
            words.append(self._word(m.group().encode("utf-8")))
            self.rescanned += 1
        self.starts = starts + [s + shift for s in self.starts[keep:]]
        self.words = words + self.words[keep:]
        self._tail = (b"", [-1])


_LOADED: dict[str, PrefixBpe] = {}


def encoder(path: str = DEFAULT_TOKENIZER) -> PrefixBpe:
    """One encoder per Python worker."""
    if path not in _LOADED:
        _LOADED[path] = PrefixBpe(path)
    return _LOADED[path]


def encode_corpus(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", tokenizer: str = DEFAULT_TOKENIZER) -> DataFrame:
    """(id, ids ARRAY<INT>) for every row; null and empty texts get [].

    Row-local: no shuffle. Arrow batches in and out; a word met before costs
    one dictionary look-up. Duplicate rows, null ids and other columns of any
    name are no problem: only the two columns are read, each row is kept.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = encoder(tokenizer)
        find, packed = bpe.words.findall, bpe.packed
        for batch in batches:
            rows = [b"".join(map(packed.__getitem__, find(t))) if t else b"" for t in batch.column(1).to_pylist()]
            ends = np.zeros(len(rows) + 1, np.int64)
            np.cumsum([len(r) // 4 for r in rows], out=ends[1:])
            # bounded output batches: at most about 16 million ids each
            a = 0
            while a < len(rows):
                b = max(a + 1, int(np.searchsorted(ends, ends[a] + (1 << 24), "right")) - 1)
                ids = np.frombuffer(b"".join(rows[a:b]), np.int32)
                lists = pa.ListArray.from_arrays(pa.array((ends[a : b + 1] - ends[a]).astype(np.int32)), pa.array(ids))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), lists], names=["_id", "ids"])
                a = b

    kind = df.schema[id_col].dataType.simpleString()
    return (
        df.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))
        .mapInArrow(run, f"_id {kind}, ids array<int>")
        .select(F.col("_id").alias(id_col), "ids")
    )


def count_tokens(df: DataFrame, keep: list[str], text_col: str = "text", tokenizer: str = DEFAULT_TOKENIZER, name: str = "n_tokens") -> DataFrame:
    """The ``keep`` columns and the token count of each row's text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = encoder(tokenizer)
        find, packed = bpe.words.findall, bpe.packed
        for batch in batches:
            n = [sum(map(len, map(packed.__getitem__, find(t)))) // 4 if t else 0 for t in batch.column(batch.num_columns - 1).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(n, pa.int64())], names=[*keep, name])

    fields = ", ".join(f"`{c}` {df.schema[c].dataType.simpleString()}" for c in keep)
    return df.select(*[F.col(c) for c in keep], F.col(text_col).alias("_text")).mapInArrow(run, f"{fields}, `{name}` bigint")
