"""Cutting oversized texts into token-bounded pieces by recursive bisection.

A span longer than the limit is cut at the strongest boundary near its middle
(paragraph > line > sentence > word > any character), and its halves again
until every span fits: the first of a text the limit, the others the limit
minus the overlap. Then each piece but the first is extended to the left by the
overlap, which the first span is never shorter than. All spans of an Arrow
batch are bisected together, level by level, with sorted boundary arrays.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lekhani.llm.encode import DEFAULT_TOKENIZER, PrefixBpe, encoder

PARAGRAPH, LINE, SENTENCE, WORD, CHARACTER = 4, 3, 2, 1, 0
#: Words of more tokens than this may be cut between characters; of fewer, if a
#: size leaves pieces less room.
LONG_WORD = 12
#: Characters handled at once, which bounds a worker's memory.
PART = 500_000
SENTENCE_ENDS = frozenset(".!?…।॥۔؟。")
CLOSERS = frozenset("\"'”’)]»")


class _WordShape(dict):
    """Word -> one byte of what matters for boundaries.

    1: white space only, 2: holds a line end, 4: holds two, 8: ends a
    sentence, 16: begins with white space, 32: closes a quotation or bracket.
    """

    LIMIT = 400_000

    def __missing__(self, w: str) -> int:
        blank, ends = w.isspace(), w.count("\n") + (w.count("\r") if "\n" not in w else 0)
        core = w.rstrip("".join(CLOSERS))
        shape = blank | (ends > 0) << 1 | (ends > 1) << 2 | (bool(core) and core[-1] in SENTENCE_ENDS) << 3 | w[0].isspace() << 4 | (not blank and not core.strip()) << 5
        if len(w) <= 64:
            if len(self) >= self.LIMIT:
                self.clear()
            self[w] = shape
        return shape


_SHAPES = _WordShape()


@dataclass
class Boundaries:
    """Possible cuts of many texts laid end to end.

    Token offset, character offset and strength of every boundary, and the
    index of each text's begin among them (one more entry for the last end).
    Of words with boundaries inside: first token, first character, tokens.
    """

    tok: np.ndarray
    char: np.ndarray
    strength: np.ndarray
    begin: np.ndarray
    opened: tuple[np.ndarray, list[tuple[int, str, bytes]]]


def boundaries(bpe: PrefixBpe, texts: list[str], long_word: int = LONG_WORD) -> Boundaries:
    """Boundaries between the words of texts, and inside words of more than ``long_word`` tokens."""
    found = [bpe.words.findall(t) for t in texts]
    begin = np.concatenate([[0], np.cumsum([len(w) for w in found])])
    words = [w for ws in found for w in ws]
    packed = list(map(bpe.packed.__getitem__, words))
    n = np.fromiter(map(len, packed), np.int64, len(words)) // 4
    size = np.fromiter(map(len, words), np.int64, len(words))
    shape = np.fromiter(map(_SHAPES.__getitem__, words), np.uint8, len(words))
    before, here = shape[:-1], shape[1:]
    prior = np.concatenate([before[:1] * 0, before[:-1]])
    has = lambda x, bit: (x & bit).astype(bool)
    # white space between words may be split over several matches; what counts is the run
    broke, blank = has(before, 2), has(before, 1)
    twice = has(before, 4) | broke & has(prior, 1) & has(prior, 2)
    ended = has(before, 8) | has(before, 32) & has(prior, 8)
    gap, solid = has(here, 16), ~has(here, 1)
    s = np.zeros(len(before), np.int8)
    s[(gap | blank) & solid] = WORD
    s[gap & ended & solid] = SENTENCE
    s[broke & solid] = LINE
    s[twice & solid] = PARAGRAPH
    strength = np.zeros(len(words) + 1, np.int8)
    strength[1:-1] = s
    strength[begin] = CHARACTER
    tok, char = np.concatenate([[0], np.cumsum(n)]), np.concatenate([[0], np.cumsum(size)])
    found_long = np.flatnonzero(n > long_word)
    opened = (tok[found_long], [(c, words[k], packed[k]) for k, c in zip(found_long.tolist(), char[found_long].tolist())])
    if len(found_long):
        tok, char, strength, begin = _inside_words(bpe, opened, tok, char, strength, begin)
    return Boundaries(tok, char, strength, begin, opened)


def _inside_words(bpe, opened, tok, char, strength, begin):
    """Adds the token borders inside opened words that fall between characters."""
    extra_t, extra_c = [], []
    for t, (c, word, packed) in zip(opened[0].tolist(), opened[1]):
        starts, ends = _token_ends(bpe, word, packed)
        ok = starts[ends]
        extra_t.append(t + 1 + np.flatnonzero(ok))
        extra_c.append(c + np.cumsum(starts)[ends[ok]] - 1)
    more_t, more_c = np.concatenate(extra_t), np.concatenate(extra_c)
    at = np.searchsorted(tok, more_t)
    return np.insert(tok, at, more_t), np.insert(char, at, more_c), np.insert(strength, at, CHARACTER), begin + np.searchsorted(more_t, tok[begin])


def _token_ends(bpe: PrefixBpe, word: str, packed: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Which bytes of a word begin a character; byte offsets of its tokens' ends but the last."""
    ids = np.frombuffer(packed, np.int32).tolist()
    ends = np.cumsum([len(bpe.bytes_of[t]) for t in ids])[:-1]
    return np.frombuffer(word.encode("utf-8"), np.uint8) & 0xC0 != 0x80, ends


def bisect(tok: np.ndarray, strength: np.ndarray, begin: np.ndarray, end: np.ndarray, limit: np.ndarray, overlap: np.ndarray, group: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Cuts whole texts [begin, end) (indices into ``tok``) into spans.

    The first span of a text gets at most ``limit`` tokens and at least
    ``overlap``, the others at most ``limit - overlap``. ``group`` is carried
    along. Returns begin, end, group of all final spans. A cut has to lie in the
    middle half of its span unless no word ends there.
    """
    ladders = [(np.flatnonzero(strength >= s), half) for s, half in ((PARAGRAPH, True), (LINE, True), (SENTENCE, True), (WORD, True), (WORD, False), (CHARACTER, False))]
    first = np.ones(len(begin), bool)
    done = []
    while len(begin):
        size = tok[end] - tok[begin]
        fits = size <= np.where(first, limit, limit - overlap)
        if fits.any():
            done.append((begin[fits], end[fits], group[fits]))
            begin, end, limit, overlap, group, first, size = (x[~fits] for x in (begin, end, limit, overlap, group, first, size))
            if not len(begin):
                break
        middle = tok[begin] + size / 2
        least = tok[begin] + np.where(first, overlap, 0)
        cut = np.full(len(begin), -1)
        for ladder, half in ladders:
            open_ = np.flatnonzero(cut < 0)
            if not len(open_) or not len(ladder):
                continue
            m, reach = middle[open_], size[open_] / 4 if half else np.inf
            right = np.searchsorted(tok[ladder], m, "left")
            best, gap = np.full(len(open_), -1), np.full(len(open_), np.inf)
            for near in (ladder[np.maximum(right - 1, 0)], ladder[np.minimum(right, len(ladder) - 1)]):
                away = np.abs(tok[near] - m)
                ok = (near > begin[open_]) & (near < end[open_]) & (tok[near] >= least[open_]) & (away <= reach) & (away < gap)
                best, gap = np.where(ok, near, best), np.where(ok, away, gap)
            cut[open_] = best
        if (cut < 0).any():
            raise ValueError("a piece's limit leaves no room for one character")
        begin, end, first = np.concatenate([begin, cut]), np.concatenate([cut, end]), np.concatenate([first, np.zeros(len(cut), bool)])
        limit, overlap, group = (np.concatenate([x, x]) for x in (limit, overlap, group))
    if not done:
        return begin, end, group
    return tuple(np.concatenate(x) for x in zip(*done))


def _character_at(bpe: PrefixBpe, text: str, found: Boundaries, at: np.ndarray) -> np.ndarray:
    """Character that holds the first byte of token ``at`` (any token)."""
    tok, char, (opened, words) = found.tok, found.char, found.opened
    k = np.searchsorted(tok, at, "right") - 1
    out = char[k]
    known: dict[object, np.ndarray] = {}
    inner = np.flatnonzero(tok[k] != at)
    holder = np.searchsorted(opened, at[inner], "right") - 1
    # the part may begin inside a word, between two boundaries
    for j, a, b, t0, t, h in zip(inner.tolist(), char[k[inner]].tolist(), char[k[inner] + 1].tolist(), tok[k[inner]].tolist(), at[inner].tolist(), holder.tolist()):
        start, word, packed = words[h] if h >= 0 else (0, "", b"")
        if h >= 0 and t < opened[h] + len(packed) // 4:  # its tokens are those of the whole word
            key, t0 = h, opened[h]
        else:
            key = word = text[a:b]
            start, packed = a, bpe.packed[word]
        places = known.get(key)
        if places is None:
            starts, ends = _token_ends(bpe, word, packed)
            places = known[key] = np.cumsum(starts)[ends] - 1
        out[j] = start + places[t - t0 - 1]
    return out


def split_long_texts(df: DataFrame, sizes: list[tuple[str, int, int]], id_col: str = "doc_id", text_col: str = "text", tokenizer: str = DEFAULT_TOKENIZER) -> DataFrame:
    """One row per piece of every text longer than a size's limit.

    ``sizes``: (name, max tokens, overlap tokens). Columns: size_name, id,
    piece_no (from 0), n_pieces, token_start, token_end, char_start, char_end,
    text. ``[token_start, token_end)`` are places in the text's own token list,
    at most the maximum apart; consecutive pieces share exactly the overlap.
    A shared part may begin inside a character: the piece's text then begins
    with that whole character. Without overlaps the pieces join to the text.

    Null, empty and short texts have no piece. Every row counts for itself,
    repeated rows too. Sizes with null limits or limits below 8, or an overlap
    not below half the limit, raise ValueError. Row-local, no shuffle; the list of sizes is a
    configuration and small by nature.
    """
    for name, most, overlap in sizes:
        if not most or most < 8 or overlap is None or overlap < 0 or 2 * overlap >= most:
            raise ValueError(f"size {name}: limit {most}, overlap {overlap}")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = encoder(tokenizer)
        names = [s[0] for s in sizes]
        most, overlap = np.array([s[1] for s in sizes]), np.array([s[2] for s in sizes])
        for batch in batches:
            texts = [t or "" for t in batch.column(1).to_pylist()]
            a = 0
            while a < len(texts):  # parts of bounded size
                b, chars = a, 0
                while b < len(texts) and (b == a or chars + len(texts[b]) <= PART):
                    chars += len(texts[b])
                    b += 1
                out = _pieces(bpe, texts[a:b], batch.column(0).slice(a, b - a), names, most, overlap)
                if out is not None:
                    yield out
                a = b

    kind = df.schema[id_col].dataType.simpleString()
    return (
        df.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))
        .mapInArrow(run, f"size_name string, _id {kind}, piece_no int, n_pieces int, token_start int, token_end int, char_start int, char_end int, text string")
        .withColumnRenamed("_id", id_col)
    )


def _pieces(bpe: PrefixBpe, texts: list[str], ids: pa.Array, names: list[str], most: np.ndarray, overlap: np.ndarray) -> pa.RecordBatch | None:
    """All pieces of some texts in all sizes, ordered by text, size and place."""
    found = boundaries(bpe, texts, int((most - overlap).min(initial=LONG_WORD)))
    tok, char, begin = found.tok, found.char, found.begin
    length = tok[begin[1:]] - tok[begin[:-1]]
    doc, size = np.nonzero(length[:, None] > most[None, :])
    if not len(doc):
        return None
    b, e, g = bisect(tok, found.strength, begin[doc], begin[doc + 1], most[size], overlap[size], np.arange(len(doc)))
    order = np.lexsort((b, g))
    b, e, g = b[order], e[order], g[order]
    counts = np.bincount(g)
    first = np.concatenate([[0], np.cumsum(counts)[:-1]])
    no = np.arange(len(g)) - np.repeat(first, counts)
    d, s = doc[g], size[g]
    start = np.where(no == 0, tok[b], tok[b] - overlap[s])
    text = "".join(texts)
    c0, c1 = char[b].copy(), char[e]
    back = start != tok[b]
    c0[back] = _character_at(bpe, text, found, start[back])
    cut = [text[x:y] for x, y in zip(c0.tolist(), c1.tolist())]
    t0, base = tok[begin[d]], char[begin[d]]
    int32 = lambda x: pa.array(x.astype(np.int32))
    columns = [pa.DictionaryArray.from_arrays(int32(s), pa.array(names, pa.string())).dictionary_decode(), ids.take(pa.array(d))]
    columns += [int32(x) for x in (no, np.repeat(counts, counts), start - t0, tok[e] - t0, c0 - base, c1 - base)]
    return pa.RecordBatch.from_arrays([*columns, pa.array(cut, pa.string())], names=["size_name", "_id", "piece_no", "n_pieces", "token_start", "token_end", "char_start", "char_end", "text"])
