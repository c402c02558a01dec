"""Lines repeated across one site's documents.

Texts are cut by content: a rolling hash over the last characters of the
normalised stream (letters in lower case; digits, spacing and marks at a line's
ends are not part of it) decides where a chunk ends, so equal passages are cut
alike wherever they stand. A line's ends are cuts too: the lines to find may be
shorter than any chunk, and between changing neighbours no chunk of theirs
would ever be seen twice. Distinct documents per (site, chunk) are counted. A
line of one repeated chunk is repeated; where all of several are, the row of
them is counted too.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lekhani.session import cut_lineage

WINDOW = 8
#: A chunk ends on average after so many characters (a power of two).
MEAN_CHUNK = 64
MIN_DOCS, MIN_SHARE = 5, 0.15
_BASE = 0x9E3779B97F4A7C15 | 1
_MIX = np.uint64(0xBF58476D1CE4E5B9)
#: Characters hashed at once, which bounds a worker's memory.
SLICE = 1 << 20


def site_of(url: Column) -> Column:
    """Host of a url in lower case, without port and leading www. or m.; null if there is none."""
    host = F.regexp_extract(F.lower(F.trim(url)), r"^(?:[a-z][a-z0-9+.\-]*:)?//(?:[^/?#@]*@)?([^/?#:]+)", 1)
    return F.nullif(F.regexp_replace(host, r"^(www|m)\.|\.$", ""), F.lit(""))


class _Alphabet:
    """Per code point: its lower case or 0 if it is dropped; whether it is a mark."""

    def __init__(self):
        self.lower = np.zeros(0x110000, np.uint32)
        self.mark = np.zeros(0x110000, bool)
        for c in range(0x110000):
            kind = unicodedata.category(ch := chr(c))
            if kind in ("Nd", "Cc", "Cf", "Cs", "Co", "Cn") or kind[0] == "Z":
                continue
            self.lower[c] = ord(ch.lower()[0])
            self.mark[c] = kind[0] in "PS"


class LineHasher:
    """Hashes of lines and of content-defined chunks for many texts at once."""

    def __init__(self):
        self.alphabet = _Alphabet()
        self._powers(SLICE + 65536)

    def _powers(self, n: int) -> None:
        def table(base: int) -> np.ndarray:
            steps = np.full(n + 1, base, np.uint64)
            steps[0] = 1
            return np.multiply.accumulate(steps)

        self.power, self.back = table(_BASE), table(pow(_BASE, -1, 1 << 64))

    def __call__(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Text index and number of every line with letters; chunk counts per line, chunks."""
        joined = "\n".join(texts)
        code = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
        per_text = np.fromiter((t.count("\n") + 1 for t in texts), np.int64, len(texts))
        line = np.cumsum(code == 10)
        low = self.alphabet.lower[code]
        kept = low > 0
        c, line = low[kept], line[kept] - (code[kept] == 10)
        body = np.flatnonzero(~self.alphabet.mark[c])
        if not len(body):
            none = np.zeros(0, np.int64)
            return none, none, none, none
        at = line[body]
        opens = np.concatenate([[True], at[1:] != at[:-1]])
        first, last = body[opens], body[np.concatenate([opens[1:], [True]])] + 1
        which = at[opens]
        if len(c) >= len(self.power):
            self._powers(len(c))
        with np.errstate(over="ignore"):
            x = c.astype(np.uint64) * _MIX
            x ^= x >> np.uint64(31)
            total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(x * self.power[: len(c)], dtype=np.uint64)])
            span = lambda a, b: self._finish((total[b] - total[a]) * self.back[a])
            ends = np.arange(WINDOW, len(c) + 1)
            cut = ends[span(ends - WINDOW, ends) % np.uint64(MEAN_CHUNK) == 0]
            owner = np.searchsorted(first, cut - WINDOW, "right") - 1
            inside = (owner >= 0) & (cut < last[np.maximum(owner, 0)])
            # chunks lie between neighbouring cuts, the line's ends among them
            bounds = np.concatenate([first, cut[inside], last])
            holder = np.concatenate([np.arange(len(which)), owner[inside], np.arange(len(which))])
            order = np.lexsort((bounds, holder))
            bounds, holder = bounds[order], holder[order]
            pair = np.flatnonzero(holder[1:] == holder[:-1])
            chunk = span(bounds[pair], bounds[pair + 1])
        count = np.bincount(holder[pair], minlength=len(which))
        begin = np.concatenate([[0], np.cumsum(per_text)])
        text = np.searchsorted(begin, which, "right") - 1
        return text, which - begin[text], count, chunk.view(np.int64)

    @staticmethod
    def _finish(h: np.ndarray) -> np.ndarray:
        h = h ^ (h >> np.uint64(32))
        h = h * _MIX
        return h ^ (h >> np.uint64(29))


_HASHER: list[LineHasher] = []


def _hasher() -> LineHasher:
    if not _HASHER:
        _HASHER.append(LineHasher())
    return _HASHER[0]


def hashed_documents(df: DataFrame, id_col: str = "doc_id", url_col: str = "url", text_col: str = "text") -> DataFrame:
    """(site, doc, lines) per row with lines that have more than digits, spacing
    and marks; of each its number and its chunks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = _hasher()
        offsets = lambda n: pa.array(np.concatenate([[0], np.cumsum(n)]).astype(np.int32))
        for batch in batches:
            texts = batch.column(2).to_pylist()
            a = 0
            while a < len(texts):
                b, size = a, 0
                while b < len(texts) and (b == a or size + len(texts[b]) < SLICE):
                    size += len(texts[b])
                    b += 1
                text, no, count, chunk = hasher(texts[a:b])
                per_text = np.bincount(text, minlength=b - a)
                full = np.flatnonzero(per_text)
                chunks = pa.ListArray.from_arrays(offsets(count), pa.array(chunk, pa.int64()))
                lines = pa.StructArray.from_arrays([pa.array(no.astype(np.int32)), chunks], names=["no", "chunks"])
                rows = pa.array(full + a)
                yield pa.RecordBatch.from_arrays([batch.column(0).take(rows), batch.column(1).take(rows), pa.ListArray.from_arrays(offsets(per_text[full]), lines)], names=["site", "doc", "lines"])
                a = b

    kind = df.schema[id_col].dataType.simpleString()
    return (
        df.select(F.xxhash64(site_of(F.col(url_col))).alias("site"), F.col(id_col).alias("doc"), F.col(text_col).alias("_text"), site_of(F.col(url_col)).alias("_host"))
        .where("_host is not null and doc is not null and _text is not null and _text != ''")
        .select("site", "doc", "_text")
        .mapInArrow(run, f"site bigint, doc {kind}, lines array<struct<no:int,chunks:array<bigint>>>")
    )


def site_sizes(df: DataFrame, id_col: str = "doc_id", url_col: str = "url") -> DataFrame:
    """Distinct documents per site, texts or not (site, site_docs)."""
    keyed = df.select(site_of(F.col(url_col)).alias("_host"), F.col(id_col).alias("doc")).where("_host is not null and doc is not null")
    return keyed.select(F.xxhash64("_host").alias("site"), F.xxhash64("doc").alias("d")).distinct().groupBy("site").agg(F.count("*").alias("site_docs"))


def repeated_site_lines(df: DataFrame, id_col: str = "doc_id", url_col: str = "url", text_col: str = "text", min_docs: int = MIN_DOCS, min_share: float = MIN_SHARE) -> DataFrame:
    """(id, line_no) of every line standing on at least ``min_docs`` documents
    and ``min_share`` of its site's documents, each once.

    Lines that differ only in letter case, digits, spacing or marks at either
    end are the same line. Rows without id, url or text have no lines; repeated
    rows of a document count once. Plan: documents are distinct per (site,
    chunk, document) before they are counted, so a hot site or line never
    gathers in one task. A site's repeated chunks make one short array, since a
    share of its documents has each of them; it meets the documents in a join on
    the site that splits where a site is hot. Texts are read twice.
    """
    docs = hashed_documents(df, id_col, url_col, text_col)
    sizes = site_sizes(df, id_col, url_col)

    def repeated(rows: DataFrame, what: str) -> DataFrame:
        counts = rows.distinct().groupBy("site", what).agg(F.count("*").alias("docs")).where(F.col("docs") >= min_docs)
        often = counts.join(sizes, "site").where(F.col("docs") >= F.lit(min_share) * F.col("site_docs"))
        return often.groupBy("site").agg(F.collect_list(what).alias(f"{what}s"))

    each = docs.select("site", F.xxhash64("doc").alias("d"), F.explode(F.array_distinct(F.flatten("lines.chunks"))).alias("chunk"))
    chunks = repeated(each, "chunk")
    known = F.filter("lines", lambda x: F.forall(x["chunks"], lambda c: F.array_contains("chunks", c)))
    # of a line of several chunks the row of them is settled next
    row = lambda x: F.when(F.size(x["chunks"]) > 1, F.xxhash64(x["chunks"]))
    lines = F.transform(known, lambda x: F.struct(x["no"].alias("no"), row(x).alias("row")))
    suspects = docs.join(chunks, "site").select("site", "doc", lines.alias("lines")).where(F.size("lines") > 0)
    suspects = cut_lineage(suspects)
    rows = suspects.select("site", F.xxhash64("doc").alias("d"), F.explode(F.array_compact(F.array_distinct("lines.row"))).alias("row"))
    settled = suspects.join(repeated(rows, "row"), "site", "left")
    kept = F.filter("lines", lambda x: x["row"].isNull() | F.coalesce(F.array_contains("rows", x["row"]), F.lit(False)))
    found = settled.select("doc", F.transform(kept, lambda x: x["no"]).alias("nos")).where(F.size("nos") > 0)
    # repeated rows of a document mostly bring the same lines
    once = found.groupBy("doc").agg(F.array_distinct(F.flatten(F.collect_set("nos"))).alias("nos"))
    return once.select(F.col("doc").alias(id_col), F.explode("nos").alias("line_no"))


def strip_site_lines(df: DataFrame, found: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, text without its found lines, lines_removed) per row; null texts stay null."""
    cuts = found.groupBy(F.col(id_col).alias("_cut_id")).agg(F.collect_set("line_no").alias("_cut"))
    joined = df.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text")).join(cuts, F.col("_id") == F.col("_cut_id"), "left")
    kept = F.filter(F.transform(F.split("_text", "\n"), lambda x, i: F.when(~F.array_contains("_cut", i), x)), lambda x: x.isNotNull())
    text = F.when(F.col("_cut").isNull(), F.col("_text")).otherwise(F.array_join(kept, "\n"))
    return joined.select(F.col("_id").alias(id_col), text.alias("text"), F.coalesce(F.size("_cut"), F.lit(0)).alias("lines_removed"))
