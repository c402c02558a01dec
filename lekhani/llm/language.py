"""Languages of documents and of their parts by nearest centroids.

A part is a run of one script inside a sentence. Its characters' n-grams
(orders 1-3, hashed) make a TF-IDF vector of length one; it has the language of
the nearest centroid of its script by cosine, if it is no further from it than
nearly all training parts are. Every language has several centroids, found by
clustering the training parts script by script. A document's training label may
not hold for all its parts: a part may fall into a cluster that mostly bears
another label, and then counts there.
"""

from __future__ import annotations

import pickle
import unicodedata
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

BUCKETS = 1 << 14
#: The two bounds on what the model is fitted on: documents per label, and parts
#: per script and label. Both are chosen by hash.
TRAIN_DOCS = 600
TRAIN_PARTS = 6000
#: Training parts have at least this many letters.
TRAIN_LETTERS = 8
#: Centroids of a language in a script.
CLUSTERS = 4
#: Share of a language's training parts that rejection may lose.
REJECT_SHARE = 0.005
#: Characters handled at once, which bounds a worker's memory.
PART = 150_000
#: Confidence below which a part follows the rest of its text.
UNSURE = 0.12
UNKNOWN = "unknown"

# Code point blocks of the scripts (1 is Latin, 2 any other letter).
BLOCKS = {3: (0x900, 0x97F), 4: (0x980, 0x9FF), 5: (0xA00, 0xA7F), 6: (0xA80, 0xAFF), 7: (0xB00, 0xB7F), 8: (0xB80, 0xBFF), 9: (0xC00, 0xC7F), 10: (0xC80, 0xCFF), 11: (0xD00, 0xD7F), 12: (0x600, 0x6FF), 13: (0x400, 0x52F), 14: (0x4E00, 0x9FFF)}
SENTENCE_ENDS = ".!?।॥۔؟…;"


class _Tables:
    """Script, lower case and sentence ends per code point."""

    def __init__(self):
        self.script = np.zeros(0x110000, np.uint8)
        self.low = np.full(0x110000, 32, np.uint32)
        for c in range(0x30000):
            kind = unicodedata.category(ch := chr(c))[0]
            if kind in "LM":
                self.low[c] = ord(ch.lower()[0])
            if kind == "L":
                self.script[c] = 1 if unicodedata.name(ch, "").startswith("LATIN") else 2
        for k, (a, b) in BLOCKS.items():
            self.script[a : b + 1][self.script[a : b + 1] > 0] = k
        for a, b in ((0x750, 0x77F), (0x8A0, 0x8FF), (0xFB50, 0xFDFF), (0xFE70, 0xFEFF)):
            self.script[a : b + 1][self.script[a : b + 1] > 0] = 12
        self.ends = np.zeros(0x110000, bool)
        self.ends[[ord(c) for c in SENTENCE_ENDS]] = True


_TABLES: list[_Tables] = []


def _tables() -> _Tables:
    if not _TABLES:
        _TABLES.append(_Tables())
    return _TABLES[0]


@dataclass
class Parts:
    """Parts of many texts: text, line, script, letters, first and last letter's place in the text."""

    text: np.ndarray
    line: np.ndarray
    script: np.ndarray
    letters: np.ndarray
    begin: np.ndarray
    end: np.ndarray
    #: sparse term counts, ordered by part
    row: np.ndarray
    term: np.ndarray
    count: np.ndarray


def read_parts(texts: list[str]) -> Parts:
    """Cuts texts into parts and counts their n-grams, all at once."""
    t = _tables()
    code = np.frombuffer("\n".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)
    lines_per_text = np.fromiter((x.count("\n") + 1 for x in texts), np.int64, len(texts))
    chars_per_text = np.fromiter((len(x) + 1 for x in texts), np.int64, len(texts))
    script, low = t.script[code], t.low[code]
    letter = np.flatnonzero(script)
    if not len(letter):
        none = np.zeros(0, np.int64)
        return Parts(*[none] * 9)
    # a part ends with its line, its sentence or its script
    breaks = np.cumsum((code == 10) | t.ends[code], dtype=np.int32)[letter]
    spoken = script[letter]
    first = np.concatenate([[True], (spoken[1:] != spoken[:-1]) | (breaks[1:] != breaks[:-1])])
    part_of_letter = np.cumsum(first, dtype=np.int32) - 1
    n = int(part_of_letter[-1]) + 1
    opens = np.flatnonzero(first)
    closes = np.append(opens[1:], len(letter)) - 1
    first_line, first_char = np.concatenate([[0], np.cumsum(lines_per_text)]), np.concatenate([[0], np.cumsum(chars_per_text)])
    at = letter[opens]
    text = np.searchsorted(first_char, at, "right") - 1
    line = np.searchsorted(np.flatnonzero(code == 10), at)
    # the stream of letters, marks and single blanks; each belongs to the part of the letter before it
    owner = np.full(len(code), -1, np.int32)
    owner[letter] = part_of_letter
    owner = np.maximum.accumulate(owner)
    blank = low == 32
    keep = ~blank
    keep[1:] |= ~blank[:-1]
    keep &= owner >= 0
    c, p = low[keep], owner[keep]
    wide = np.uint64 if n * BUCKETS >= 1 << 32 else np.uint32
    base = p.astype(wide) * wide(BUCKETS)
    keys = []
    for order in (1, 2, 3):
        if len(c) < order:
            continue
        m = len(c) - order + 1
        h = np.full(m, order, np.uint32)
        for k in range(order):
            h ^= c[k : m + k]
            h *= np.uint32(0x9E3779B1)
            h ^= h >> np.uint32(15)
        key = base[:m] + (h & np.uint32(BUCKETS - 1))
        keys.append(key[p[:m] == p[order - 1 :]] if order > 1 else key)
    key = np.sort(np.concatenate(keys))
    new = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
    key, count = key[new], np.diff(np.append(new, len(key)))
    return Parts(text, line - first_line[text], spoken[opens], closes - opens + 1, at - first_char[text], letter[closes] + 1 - first_char[text], (key // wide(BUCKETS)).astype(np.int64), (key % wide(BUCKETS)).astype(np.int32), count.astype(np.int32))


def slices(texts: list[str]) -> Iterator[tuple[list[str], np.ndarray, np.ndarray, np.ndarray]]:
    """Pieces of about ``PART`` characters in all, with the text, first line and
    first character of each. Longer texts are cut after a line, a sentence or a
    word, and inside one of more than ``PART`` characters."""
    pieces: list[str] = []
    where: list[tuple[int, int, int]] = []
    size = 0
    for i, text in enumerate(texts):
        at = line = 0
        while True:
            end = len(text)
            if end - at > PART:
                end = at + PART
                cut = max(text.rfind("\n", at, end), *(text.rfind(x, at + PART // 2, end) for x in SENTENCE_ENDS))
                cut = cut if cut > at else text.rfind(" ", at, end)
                end = cut + 1 if cut > at else end
            if pieces and size + end - at > PART:
                yield pieces, *np.array(where).T
                pieces, where, size = [], [], 0
            pieces.append(text[at:end])
            where.append((i, line, at))
            size += end - at
            if end == len(text):
                break
            line += pieces[-1].count("\n")
            at = end
    if pieces:
        yield pieces, *np.array(where).T


@dataclass
class Voice:
    """Centroids of one script: buckets x centroids, their languages and least cosines."""

    idf: np.ndarray
    centroids: np.ndarray
    owner: np.ndarray
    floor: np.ndarray

    def cosines(self, row: np.ndarray, term: np.ndarray, count: np.ndarray, n: int) -> np.ndarray:
        """Parts x centroids, of ``n`` parts none of which is without terms."""
        w = (1 + np.log(count.astype(np.float32))) * self.idf[term]
        norm = np.sqrt(np.bincount(row, w * w, n))
        starts = np.searchsorted(row, np.arange(n))
        dots = np.add.reduceat(self.centroids[term] * w[:, None], starts, axis=0)
        return dots / np.maximum(norm, 1e-9)[:, None]


@dataclass
class Model:
    languages: list[str]
    voices: dict[int, Voice]

    def classify(self, parts: Parts) -> tuple[np.ndarray, np.ndarray]:
        """Language per part (-1: of a script never learned, -2 - k: nearest to
        k but rejected) and a confidence in [0, 1]."""
        lang, confidence = np.full(len(parts.text), -1, np.int64), np.zeros(len(parts.text))
        for script in np.unique(parts.script).tolist():
            voice = self.voices.get(script)
            if voice is None:
                continue
            mine = np.flatnonzero(parts.script == script)
            place = np.full(len(parts.text), -1, np.int64)
            place[mine] = np.arange(len(mine))
            row = place[parts.row]
            on = row >= 0
            s = voice.cosines(row[on], parts.term[on], parts.count[on], len(mine))
            best = s.argmax(axis=1)
            top = s[np.arange(len(s)), best]
            owner = voice.owner[best]
            rival = np.where(voice.owner[None, :] == owner[:, None], 0.0, s).max(axis=1)
            confidence[mine] = np.clip((top - np.maximum(rival, 0)) / np.maximum(top, 1e-9), 0, 1)
            lang[mine] = np.where(top < voice.floor[best], -2 - owner, owner)
        return lang, confidence


def _clusters(row: np.ndarray, term: np.ndarray, w: np.ndarray, letters: np.ndarray, clusters: int) -> np.ndarray:
    """Centroids (k x buckets) of parts by spherical k-means, which begins at the
    mean of all and then at the longer part furthest from those before."""
    n = len(letters)
    starts = np.append(np.searchsorted(row, np.arange(n)), len(row))
    similarity = lambda c: np.bincount(row, w * c[term], n)
    centers = [_unit(np.bincount(term, w, BUCKETS))]
    nearest = similarity(centers[0])
    long = letters >= np.median(letters)
    for _ in range(min(clusters, n // 12) - 1):
        i = int(np.where(long, nearest, 9).argmin())
        v = np.zeros(BUCKETS)
        v[term[starts[i] : starts[i + 1]]] = w[starts[i] : starts[i + 1]]
        centers.append(v)
        nearest = np.maximum(nearest, similarity(v))
    for _ in range(6 if len(centers) > 1 else 0):
        label = np.stack([similarity(c) for c in centers]).argmax(axis=0)
        for j in range(len(centers)):
            if (label == j).any():
                centers[j] = _unit(np.bincount(term, w * (label[row] == j), BUCKETS))
    return np.stack([c for j, c in enumerate(centers) if len(centers) == 1 or (label == j).any()])


def _unit(v: np.ndarray) -> np.ndarray:
    return v / max(np.linalg.norm(v), 1e-9)


def fit_script(row: np.ndarray, term: np.ndarray, count: np.ndarray, given: np.ndarray, letters: np.ndarray, weight: np.ndarray, clusters: int = CLUSTERS) -> Voice:
    """Centroids of the languages of one script, from its parts.

    ``weight`` of a part is how many documents of the corpus it stands for. A
    label is a language of the script if it has most of the weight of the parts
    nearest to its mean; wrong labels only share the place of a right one. A
    part counts for its label where it is nearer to its mean than to others';
    means and choice are made in turns.
    """
    n = len(given)
    df = np.bincount(term, minlength=BUCKETS)
    idf = np.log((1 + n) / (1 + df)).astype(np.float32) + 1
    w = (1 + np.log(count.astype(np.float32))) * idf[term]
    w /= np.maximum(np.sqrt(np.bincount(row, w * w, n)), 1e-9).astype(np.float32)[row]
    right = np.ones(n, bool)

    def nearest(labels: np.ndarray) -> np.ndarray:
        means = [_unit(np.bincount(term, w * (right & (given == x))[row], BUCKETS)) for x in labels]
        return labels[np.stack([np.bincount(row, w * c[term], n) for c in means]).argmax(axis=0)]

    total = np.bincount(given, weight)
    spoken = np.flatnonzero(np.bincount(given) >= min(12, np.bincount(given).max()))
    while len(spoken) > 1:
        near = nearest(spoken)
        share = np.array([np.bincount(given[near == x], weight[near == x], len(total))[x] / max(weight[near == x].sum(), 1e-9) for x in spoken])
        holds = (share > 0.5) | (total[spoken] == total[spoken].max())
        if holds.all():
            break
        spoken = spoken[holds]
    for _ in range(4 if len(spoken) > 1 else 0):
        right = nearest(spoken) == given
    centers, owner = [], []
    for x in spoken.tolist():
        mine = right & (given == x)
        if not mine.any():
            continue
        place = np.cumsum(mine) - 1
        on = mine[row]
        c = _clusters(place[row[on]], term[on], w[on], letters[mine], clusters)
        centers.append(c)
        owner += [x] * len(c)
    voice = Voice(idf, np.ascontiguousarray(np.concatenate(centers).T.astype(np.float32)), np.array(owner), np.zeros(len(owner), np.float32))
    ends = np.searchsorted(row, np.arange(n + 1))
    best, cosine = np.zeros(n, int), np.zeros(n)
    for a in range(0, n, 1000):
        b = min(a + 1000, n)
        some = slice(ends[a], ends[b])
        s = voice.cosines(row[some] - a, term[some], count[some], b - a)
        best[a:b], cosine[a:b] = s.argmax(axis=1), s.max(axis=1)
    for j in range(len(owner)):
        mine = cosine[best == j]
        voice.floor[j] = np.quantile(mine, REJECT_SHARE) * 0.8 if len(mine) else 0
    return voice


def named_language(value: Column, names: DataFrame) -> Column:
    """The language that a label names by name or code, in any case and with spaces; else null.

    ``names`` is the table of languages, a few hundred rows at most.
    """
    pairs = {}
    rows = names.select("language", "iso639_1", "iso639_3").limit(1001).collect()
    if len(rows) > 1000:
        raise ValueError("too many languages")
    for r in rows:
        for x in (r.language, r.iso639_1, r.iso639_3):
            if x and r.language:
                pairs.setdefault(x.strip().lower(), r.language)
    if not pairs:
        return F.lit(None).cast("string")
    table = F.create_map(*[F.lit(x) for kv in sorted(pairs.items()) for x in kv])
    return F.try_element_at(table, F.lower(F.regexp_replace(value, r"(?U)\A\s+|\s+\z", "")))


def agreed_label(df: DataFrame, names: DataFrame, label_cols: tuple[str, ...]) -> tuple[Column, Column]:
    """The language most of a document's labels name, and whether they are one
    voice: three labels at least (or all columns, if there are fewer), none of
    them another language. ``label_cols`` are strings or maps to strings.
    """
    votes, most = F.array(), 0
    for c in label_cols:
        if c not in df.columns:
            continue
        if isinstance(df.schema[c].dataType, T.MapType):
            given = F.transform(F.coalesce(F.map_values(c), F.array().cast("array<string>")), lambda v: named_language(v, names))
            most += 2
        else:
            given = F.array(named_language(F.col(c), names))
            most += 1
        votes = F.concat(votes.cast("array<string>"), given)
    bound = F.transform(F.array(F.sort_array(F.array_compact(votes))), lambda v: F.struct(v.alias("all"), F.transform(F.array_distinct(v), lambda x: F.struct((-F.size(F.filter(v, lambda y: y == x))).alias("less"), x.alias("name"))).alias("by")))[0]
    top = F.array_min(bound["by"])
    return top["name"], (F.size(bound["by"]) == 1) & (F.size(bound["all"]) >= min(3, most))


def training_documents(df: DataFrame, names: DataFrame, text_col: str, label_cols: tuple[str, ...], per_label: int) -> DataFrame:
    """(label, weight, h, text): at most ``per_label`` documents of each label, chosen by
    hash of their text among those whose labels are one voice; a language that
    has no such document learns from those whose labels mostly name it."""
    label, sure = agreed_label(df, names, label_cols)
    labelled = df.where(F.col(text_col).isNotNull() & (F.col(text_col) != "")).select(label.alias("label"), sure.alias("sure"), F.col(text_col).alias("text")).where("label is not null")
    labelled = labelled.withColumn("h", F.xxhash64("text"))
    # labels are names of the table of languages, a few hundred at most
    counts = {r.label: (r.sure, r.n) for r in labelled.groupBy("label").agg(F.count_if("sure").alias("sure"), F.count("*").alias("n")).collect()}
    span = 1_000_003
    if not counts:
        return labelled.select("label", F.lit(1.0).alias("weight"), "h", "text")
    rules = F.create_map(*[F.lit(x) for k, (sure, n) in sorted(counts.items()) for x in (k, min(span, int(span * 1.3 * per_label / (sure or n)) + 1))])
    split = [k for k, (sure, _) in counts.items() if not sure]
    some = labelled.where((F.col("sure") | F.col("label").isin(split)) & (F.pmod("h", F.lit(span)) < rules[F.col("label")]))
    order = Window.partitionBy("label").orderBy("h")  # about 1.3 times per_label rows each
    some = some.dropDuplicates(["label", "h"]).withColumn("_k", F.row_number().over(order)).where(F.col("_k") <= per_label)
    known = F.create_map(*[F.lit(x) for k, (sure, n) in sorted(counts.items()) for x in (k, float(sure or n))])
    return some.select("label", (known[F.col("label")] / F.count("*").over(Window.partitionBy("label"))).alias("weight"), "h", "text")


def train(df: DataFrame, names: DataFrame, text_col: str = "text", label_cols: tuple[str, ...] = ("language", "lang_per_model"), per_label: int = TRAIN_DOCS, clusters: int = CLUSTERS) -> Model:
    """Fits the centroids, each script's in one task of bounded size (at most
    ``TRAIN_PARTS`` parts per label); only the centroids reach the driver.

    The sample is bounded in documents and parts: ``per_label`` documents of
    each label, see ``training_documents``. Where no text has a label and
    letters the model knows no language, and all parts are ``unknown`` to it.
    """
    docs = training_documents(df, names, text_col, label_cols, per_label)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            labels, weights, hashes, texts = batch.columns
            main: dict[int, np.ndarray] = {}
            for once in (True, False):  # first the letters of each script in a text, then the parts in its main one
                for pieces, text, _, at in slices(texts.to_pylist()):
                    p = read_parts(pieces)
                    of = text[p.text]
                    if once:
                        for i in np.unique(of).tolist():
                            main[i] = main.get(i, 0) + np.bincount(p.script[of == i], p.letters[of == i], 16)
                        continue
                    ends = np.searchsorted(p.row, np.arange(len(p.text) + 1))
                    some = np.flatnonzero((p.letters >= TRAIN_LETTERS) & (np.array([main[i].argmax() for i in of.tolist()]) == p.script))
                    rows = pa.array(of[some])
                    mixed = ((hashes.take(rows).to_numpy() ^ (p.begin[some] + at[p.text[some]])) * 2654435761) % (1 << 32)
                    terms = [p.term[ends[i] : ends[i + 1]].astype("<i4").tobytes() for i in some]
                    counts = [p.count[ends[i] : ends[i + 1]].astype("<i4").tobytes() for i in some]
                    columns = [labels.take(rows), weights.take(rows), pa.array(p.script[some].astype(np.int32)), pa.array(p.letters[some].astype(np.int64)), pa.array(mixed.astype(np.int64)), pa.array(terms, pa.binary()), pa.array(counts, pa.binary())]
                    yield pa.RecordBatch.from_arrays(columns, names=["label", "weight", "script", "letters", "h", "terms", "counts"])

    parts = docs.mapInArrow(cut, "label string, weight double, script int, letters long, h long, terms binary, counts binary")
    order = Window.partitionBy("script", "label").orderBy("h", "letters", "terms")
    parts = parts.withColumn("_k", F.row_number().over(order)).where(F.col("_k") <= TRAIN_PARTS).drop("_k")

    def learn(group):
        group = group.sort_values(["h", "letters", "label"], kind="stable")
        languages, given = np.unique(group["label"], return_inverse=True)
        terms = [np.frombuffer(x, "<i4") for x in group["terms"]]
        row = np.repeat(np.arange(len(terms)), [len(x) for x in terms])
        voice = fit_script(row, np.concatenate(terms), np.concatenate([np.frombuffer(x, "<i4") for x in group["counts"]]), given, group["letters"].to_numpy(), group["weight"].to_numpy(), clusters)
        whole = pickle.dumps((group["script"].iloc[0], languages[voice.owner].tolist(), voice))
        return group.iloc[:1][["script"]].assign(voice=[whole])

    found = [pickle.loads(r.voice) for r in parts.groupBy("script").applyInPandas(learn, "script int, voice binary").collect()]
    languages = sorted({x for _, owner, _ in found for x in owner})
    for _, owner, voice in found:
        voice.owner = np.array([languages.index(x) for x in owner])
    return Model(languages, {int(script): voice for script, _, voice in found})


def _classified(texts: list[str], model: Model) -> tuple[Parts, np.ndarray, np.ndarray, np.ndarray]:
    """Parts of the texts (without their terms), languages, confidences and, for each part, its line's number among all lines."""
    found, said = [], []
    for pieces, text, line, at in slices(texts):
        p = read_parts(pieces)
        said.append(model.classify(p))
        none = p.row[:0]
        found.append(Parts(text[p.text], p.line + line[p.text], p.script, p.letters, p.begin + at[p.text], p.end + at[p.text], none, none, none))
    p = Parts(*(np.concatenate([getattr(x, f) for x in found]) for f in Parts.__dataclass_fields__))
    lang, confidence = (np.concatenate(x) for x in zip(*said, strict=True))
    _, line = np.unique((p.text.astype(np.int64) << 32) | p.line, return_inverse=True)
    _inherit(lang, confidence, p, line)
    return p, lang, confidence, line


def _from_texts(df: DataFrame, model: Model, keep: list[str], text_col: str, columns: str, make: Callable) -> DataFrame:
    """Rows of ``make(parts, lang, confidence, line)``: the text of each row, then the arrays of ``columns``."""
    shared = df.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        names = pa.array([*model.languages, UNKNOWN])
        for batch in batches:
            texts = batch.column(batch.num_columns - 1).to_pylist()
            if not texts:
                continue
            p, lang, confidence, line = _classified(texts, model)
            text, spoken, *more = make(p, np.where(lang < 0, len(model.languages), lang), confidence, line)
            rows = pa.array(text)
            yield pa.RecordBatch.from_arrays([*[c.take(rows) for c in batch.columns[:-1]], names.take(pa.array(spoken)), *map(pa.array, more)], names=[*keep, *(x.split()[0] for x in columns.split(", "))])

    fields = ", ".join(f"`{c}` {df.schema[c].dataType.simpleString()}" for c in keep)
    source = df.select(*[F.col(c) for c in keep], F.col(text_col).alias("_text")).where("_text is not null and _text != ''")
    return source.mapInArrow(run, f"{fields}, {columns}")


def language_parts(df: DataFrame, model: Model, keep: list[str], text_col: str = "text") -> DataFrame:
    """One row per part: the ``keep`` columns, lang (``unknown`` if rejected),
    line_no, begin, end, letters, line_letters and confidence.

    A rejected part of fewer than 20 letters takes the language of the line's,
    else of the text's, other parts in its script, else of the nearest centroid. Null and
    empty texts, and texts without letters, have no parts. Row-local, no shuffle.
    """

    def make(p, lang, confidence, line):
        int32 = lambda x: x.astype(np.int32)
        return p.text, lang, int32(p.line), int32(p.begin), int32(p.end), int32(p.letters), int32(np.bincount(line, p.letters)[line]), confidence.astype(np.float64)

    return _from_texts(df, model, keep, text_col, "lang string, line_no int, begin int, end int, letters int, line_letters int, confidence double", make)


def line_languages(df: DataFrame, model: Model, keep: list[str], text_col: str = "text") -> DataFrame:
    """One row per line and language: the ``keep`` columns, lang (``unknown`` if
    rejected), line_no, its letters and line_letters. Row-local, no shuffle."""

    def make(p, lang, confidence, line):
        span = int(lang.max(initial=0)) + 1
        key, first, back = np.unique(line.astype(np.int64) * span + lang, return_index=True, return_inverse=True)
        letters = np.bincount(back, p.letters, len(key))
        total = np.bincount(line, p.letters)[line[first]]
        return p.text[first], lang[first], p.line[first].astype(np.int32), letters.astype(np.int32), total.astype(np.int32)

    return _from_texts(df, model, keep, text_col, "lang string, line_no int, letters int, line_letters int", make)


def _inherit(lang: np.ndarray, confidence: np.ndarray, p: Parts, line: np.ndarray) -> None:
    """Unsure parts follow sure ones of their script: undecided ones (little
    nearer to one language than to another) those of their text, rejected short
    ones those of their line, else of their text. Short ones with none to follow
    stay with the nearest: too few n-grams make a cosine small by itself."""
    if not len(lang):
        return
    span = int(lang.max(initial=0)) + 1

    def follow(who: np.ndarray, group: np.ndarray, sure: np.ndarray) -> None:
        if not len(who):
            return
        key = group.astype(np.int64) * 256 + p.script
        wanted = np.unique(key[who])
        voters = np.flatnonzero(sure & np.isin(key, wanted))
        if not len(voters):
            return
        vote, back = np.unique(key[voters] * span + lang[voters], return_inverse=True)
        weight = np.bincount(back, p.letters[voters], len(vote))
        order = np.lexsort((vote % span, -weight, vote // span))  # most letters first, then the first language
        groups, first = np.unique(vote[order] // span, return_index=True)
        best = vote[order][first] % span
        at = np.minimum(np.searchsorted(groups, key[who]), len(groups) - 1)
        told = groups[at] == key[who]
        lang[who[told]] = best[at[told]]

    sure = (lang >= 0) & (confidence >= UNSURE)
    follow(np.flatnonzero((lang >= 0) & ~sure), p.text, sure)
    short = p.letters < 20
    follow(np.flatnonzero((lang < 0) & short), line, lang >= 0)
    follow(np.flatnonzero((lang < 0) & short), p.text, lang >= 0)
    alone = (lang < -1) & short
    lang[alone] = -2 - lang[alone]


def foreign_lines(lines: DataFrame, named: str = "named", id_col: str = "doc_id") -> DataFrame:
    """(id, line_no, lang) for languages with a third of a line's letters other
    than the named one, from ``line_languages``; each once."""
    return lines.where((F.col("lang") != UNKNOWN) & (F.col("letters") * 3 >= F.col("line_letters")) & ~F.col("lang").eqNullSafe(F.col(named))).select(id_col, "line_no", "lang").distinct()


def document_languages(parts: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """(id, lang, share, confidence, languages): the language with most letters,
    its share, the letter-weighted mean confidence, and all languages found."""
    by = parts.groupBy(id_col, "lang").agg(F.sum("letters").alias("n"), F.sum(F.col("letters") * F.col("confidence")).alias("c"))
    out = by.groupBy(id_col).agg(F.max_by(F.struct("lang", "n", "c"), F.struct("n", "lang")).alias("top"), F.sum("n").alias("total"), F.sort_array(F.collect_set("lang")).alias("languages"))
    return out.select(id_col, F.col("top.lang").alias("lang"), (F.col("top.n") / F.col("total")).alias("share"), (F.col("top.c") / F.col("top.n")).alias("confidence"), "languages")
