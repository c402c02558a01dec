"""Queries over the test tables and the DuckDB statements that check them."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lekhani.config import Config, for_language
from lekhani.functions import code as C
from lekhani.functions import html as H
from lekhani.functions import keywords as K
from lekhani.functions import language as L
from lekhani.functions import ngrams as N
from lekhani.functions import normalize as U
from lekhani.functions import text as T
from lekhani.operators import clean, dedup, flags, lines, stats
from lekhani.plans import stages
from lekhani.session import use_checkpoint_dir
from lekhani.sources import readers, sinks

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    """Registers a query under its function's name, with its SQL if there is any."""

    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


def table(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def documents(spark, d) -> DataFrame:
    return table(spark, d, "documents")


# SQL building blocks -------------------------------------------------------

_VALID = "".join(rf"\x{{{a:X}}}-\x{{{b:X}}}" for a, b in T.VALID_RANGES)
_LETTERS = "".join(rf"\x{{{a:X}}}-\x{{{b:X}}}" for a, b in T.LETTER_RANGES)


def _symbols(x: str) -> str:
    return rf"len(regexp_extract_all({x}, '[^{_VALID} \n]'))"


def _foreign(x: str) -> str:
    return rf"len(regexp_extract_all({x}, '[^\p{{Latin}}\p{{Devanagari}}\p{{Bengali}}\p{{Gujarati}}\p{{Gurmukhi}}\p{{Kannada}}\p{{Malayalam}}\p{{Oriya}}\p{{Tamil}}\p{{Telugu}}\p{{Meetei_Mayek}}\p{{Arabic}}\p{{Dogra}}\p{{Ol_Chiki}}\p{{P}}\s\x{{0b}}\x1c-\x1f\x{{85}}\p{{Z}}]'))"


_TERM = r"""[.!?।:,;)"''؟۔]"""


def _proper(x: str) -> str:
    return rf"(regexp_matches({x}, '{_TERM}$') AND NOT ends_with({x}, '...') AND NOT ends_with({x}, '####'))"


_DELIM = "[.?!।|॥؟۔]"

_CHUNKS = "chunks AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS chunk, generate_subscripts(string_split(text, chr(10)), 1) - 1 AS pos FROM documents WHERE text IS NOT NULL)"
_SENTENCES = f"""cut AS (SELECT doc_id, text, regexp_extract_all(text, '(?s)[^.?!।|॥؟۔]*{_DELIM}\\n*') AS l FROM documents WHERE text IS NOT NULL),
parts AS (SELECT doc_id, list_append(l, substring(text, length(array_to_string(l, '')) + 1)) AS l FROM cut),
sentences AS (SELECT doc_id, unnest(l) AS line, generate_subscripts(l, 1) - 1 AS pos FROM parts)"""
_LINE_STATS = f"""{_SENTENCES},
line_stats AS (SELECT doc_id, pos, line, len(string_split(line, ' ')) AS words_count, length(line) AS char_count, strlen(line) AS bytes, {_foreign('line')} AS non_li_char_count FROM sentences)"""
_DOC_STATS = f"""{_LINE_STATS},
doc_stats AS (SELECT doc_id, sum(bytes)::BIGINT AS bytes, sum(words_count)::BIGINT AS words_count, sum(char_count)::BIGINT AS char_count, count(*) AS lines_count, avg(words_count) AS mean_line_length, min(words_count)::BIGINT AS min_line_length, max(words_count)::BIGINT AS max_line_length, sum(non_li_char_count)::BIGINT AS non_li_char_count FROM line_stats GROUP BY doc_id)"""
_FLAGS = f"""{_DOC_STATS},
flagged AS (SELECT *, lines_count <= 4 AS has_less_lines, mean_line_length <= 5 AS is_short_lines_heavy, coalesce(non_li_char_count / nullif(char_count, 0) >= 0.05, false) AS is_non_li_heavy FROM doc_stats)"""


def _in(words) -> str:
    return "(" + ", ".join("'" + w.replace("'", "''") + "'" for w in words) + ")"


def _big(df: DataFrame, *columns: str) -> DataFrame:
    """Counts as BIGINT, as SQL has them."""
    return df.withColumns({c: F.col(c).cast("bigint") for c in columns})


def _line_stats(spark, d) -> DataFrame:
    return stats.line_stats(lines.doc_to_sentences(documents(spark, d).select("doc_id", "text")), lang_col=None)


# Scalar functions ----------------------------------------------------------


@query("SELECT doc_id, len(string_split(text, ' '))::BIGINT AS words, length(text)::BIGINT AS chars, strlen(text)::BIGINT AS bytes FROM documents")
def text_counts(spark, d):
    t = F.col("text")
    return _big(documents(spark, d).select("doc_id", T.word_count(t).alias("words"), T.char_count(t).alias("chars"), T.byte_count(t).alias("bytes")), "words", "chars", "bytes")


@query(rf"WITH {_CHUNKS} SELECT doc_id, pos, regexp_full_match(chunk, '\p{{Nd}}+') AS is_number FROM chunks")
def is_number(spark, d):
    return _big(lines.doc_to_chunks(documents(spark, d).select("doc_id", "text")).select("doc_id", "pos", T.is_number(F.col("text")).alias("is_number")), "pos")


@query(f"SELECT doc_id, {_symbols('text')}::BIGINT AS symbols, round({_symbols('text')} / nullif(length(text), 0), 6) AS symbol_ratio FROM documents")
def symbol_ratio(spark, d):
    t = F.col("text")
    return _big(documents(spark, d).select("doc_id", T.symbol_count(t).alias("symbols"), F.round(T.symbol_ratio(t), 6).alias("symbol_ratio")), "symbols")


@query(rf"WITH {_CHUNKS} SELECT doc_id, pos, regexp_full_match(chunk, '\p{{N}}+') OR coalesce(len(regexp_extract_all(chunk, '[^{_LETTERS} \n]')) / nullif(length(chunk), 0) >= 0.4, false) AS marks_only FROM chunks")
def number_or_marks(spark, d):
    return _big(lines.doc_to_chunks(documents(spark, d).select("doc_id", "text")).select("doc_id", "pos", T.is_number_or_marks(F.col("text")).alias("marks_only")), "pos")


@query(f"WITH {_CHUNKS} SELECT doc_id, pos, {_proper('chunk')} AS proper FROM chunks")
def terminal_valid(spark, d):
    return _big(lines.doc_to_chunks(documents(spark, d).select("doc_id", "text")).select("doc_id", "pos", T.ends_properly(F.col("text")).alias("proper")), "pos")


@query(f"WITH t AS (SELECT doc_id, string_split(text, chr(10)) AS l FROM documents WHERE text IS NOT NULL), k AS (SELECT doc_id, l, list_filter(l, lambda x: {_proper('x')}) AS kept FROM t) SELECT doc_id, array_to_string(kept, chr(10)) AS text, (len(l) - len(kept))::BIGINT AS dropped FROM k")
def terminal_punc_filter(spark, d):
    out = documents(spark, d).where("text is not null").select("doc_id", T.keep_properly_ended(F.col("text")).alias("r"))
    return _big(out.select("doc_id", "r.text", "r.dropped"), "dropped")


@query(f"""WITH {_CHUNKS}, h AS (SELECT doc_id, pos, chunk, regexp_extract(chunk, '(?s)^(.*{_TERM})', 1) AS head FROM chunks)
SELECT doc_id, pos, CASE WHEN {_proper('chunk')} THEN chunk WHEN NOT (ends_with(chunk, '...') OR ends_with(chunk, '####')) AND len(string_split(head, ' ')) > 2 THEN head END AS kept FROM h""")
def non_terminal_span(spark, d):
    return _big(lines.doc_to_chunks(documents(spark, d).select("doc_id", "text")).select("doc_id", "pos", T.cut_after_terminal(F.col("text"), 2).alias("kept")), "pos")


@query(f"WITH {_SENTENCES} SELECT doc_id, pos, line AS text FROM sentences")
def sentence_split(spark, d):
    return _big(lines.doc_to_sentences(documents(spark, d).select("doc_id", "text")).select("doc_id", "pos", "text"), "pos")


@query("""SELECT doc_id, round(coalesce(len(regexp_extract_all(text, '[a-zA-Z0-9]')) / nullif(length(text) - len(regexp_extract_all(text, '[@_!#$%^&*()<>?/|}{~:]')) - len(regexp_extract_all(text, '[\\s\\x{0b}\\x1c-\\x1f\\x{85}\\p{Z}]')) - len(regexp_extract_all(text, '\\n')), 0), 0), 6) AS roman_share FROM lid WHERE text IS NOT NULL""".replace("\\\\", "\\"))
def roman_share(spark, d):
    return table(spark, d, "lid").where("text is not null").select("doc_id", F.round(T.roman_share(F.col("text")), 6).alias("roman_share"))


_ROMAN = """coalesce(len(regexp_extract_all(text, '[a-zA-Z0-9]')) / nullif(length(text) - len(regexp_extract_all(text, '[@_!#$%^&*()<>?/|}{~:]')) - len(regexp_extract_all(text, '[\\s\\x{0b}\\x1c-\\x1f\\x{85}\\p{Z}]')) - len(regexp_extract_all(text, '\\n')), 0), 0)""".replace("\\\\", "\\")


@query(f"SELECT doc_id, CASE WHEN {_ROMAN} > 0.5 THEN 'roman' ELSE 'native' END AS route FROM lid WHERE text IS NOT NULL")
def script_route(spark, d):
    return table(spark, d, "lid").where("text is not null").select("doc_id", F.when(L.is_roman(F.col("text")), "roman").otherwise("native").alias("route"))


@query(f"SELECT doc_id, {_foreign('text')}::BIGINT AS foreign_chars FROM lid WHERE text IS NOT NULL")
def non_li_chars(spark, d):
    return _big(table(spark, d, "lid").where("text is not null").select("doc_id", T.foreign_char_count(F.col("text")).alias("foreign_chars")), "foreign_chars")


@query("SELECT doc_id, CASE WHEN language = 'urdu' AND iso639_3 = 'urd' THEN 'ur' ELSE iso639_3 END AS code FROM lid LEFT JOIN lang_names USING (language)")
def tokenizer_code(spark, d):
    lid, names = table(spark, d, "lid").select("doc_id", "language"), table(spark, d, "lang_names").select("language", "iso639_3")
    return lid.join(names, "language", "left").select("doc_id", T.tokenizer_language_code(F.col("language"), F.col("iso639_3")).alias("code"))


# Lines and statistics ------------------------------------------------------


@query(f"WITH {_LINE_STATS} SELECT doc_id, pos, words_count::BIGINT AS words_count, char_count::BIGINT AS char_count, bytes::BIGINT AS bytes, non_li_char_count::BIGINT AS non_li_char_count FROM line_stats")
def line_stats(spark, d):
    return _big(_line_stats(spark, d).select("doc_id", "pos", "words_count", "char_count", "bytes", "non_li_char_count"), "pos", "words_count", "char_count", "bytes", "non_li_char_count")


@query(f"WITH {_DOC_STATS} SELECT doc_id, bytes, words_count, char_count, lines_count, round(mean_line_length, 6) AS mean_line_length, min_line_length, max_line_length, non_li_char_count FROM doc_stats")
def doc_stats(spark, d):
    out = stats.doc_stats(_line_stats(spark, d)).drop("nsfw_words_count").withColumn("mean_line_length", F.round("mean_line_length", 6))
    return _big(out, "min_line_length", "max_line_length", "non_li_char_count")


@query(f"WITH {_DOC_STATS} SELECT doc_id, bytes, words_count, char_count FROM doc_stats")
def doc_stats_base(spark, d):
    return stats.doc_stats(_line_stats(spark, d), base_only=True)


@query(f"""WITH {_LINE_STATS}, freq AS (SELECT doc_id, words_count, count(*) AS n FROM line_stats GROUP BY ALL), modes AS (SELECT doc_id, words_count AS mode, row_number() OVER (PARTITION BY doc_id ORDER BY n DESC, words_count) AS k FROM freq)
SELECT doc_id, round(avg(words_count), 6) AS mean, round(median(words_count), 6) AS median, any_value(mode)::BIGINT AS mode, min(words_count)::BIGINT AS min, max(words_count)::BIGINT AS max FROM line_stats JOIN modes USING (doc_id) WHERE k = 1 GROUP BY doc_id""")
def line_length_stats(spark, d):
    out = stats.length_stats(_line_stats(spark, d))
    return _big(out.withColumns({c: F.round(c, 6) for c in ("mean", "median")}), "mode", "min", "max")


@query(f"WITH {_SENTENCES} SELECT doc_id, line AS text, count(*) AS count FROM sentences GROUP BY ALL")
def repeated_line_counts(spark, d):
    return stats.repeated_lines(lines.doc_to_sentences(documents(spark, d).select("doc_id", "text")))


@query(f"WITH {_SENTENCES}, fixed AS (SELECT doc_id, pos, CASE WHEN starts_with(line, '  ') THEN substring(line, 2) ELSE line END AS line FROM sentences) SELECT doc_id, string_agg(line, '' ORDER BY pos) AS text FROM fixed GROUP BY doc_id")
def lines_to_doc(spark, d):
    return lines.lines_to_doc(lines.doc_to_sentences(documents(spark, d).select("doc_id", "text")))


@query(f"WITH {_SENTENCES} SELECT doc_id, line AS text, count(*) AS count FROM sentences GROUP BY ALL")
def repeated_line_map(spark, d):
    rows = lines.doc_to_sentences(documents(spark, d).select("doc_id", "text"))
    return _big(stats.repeated_line_dist(rows).select("doc_id", F.explode("repeated_line_dist").alias("text", "count")), "count")


_BUNDLE = f"""{_LINE_STATS}, symbols AS (SELECT doc_id, sum(len(regexp_extract_all(line, '[^{_VALID} \n]|\\p{{Nd}}')))::BIGINT AS symbol_numbers_count FROM sentences GROUP BY doc_id),
freq AS (SELECT doc_id, words_count, count(*) AS n FROM line_stats GROUP BY ALL), modes AS (SELECT doc_id, words_count AS mode, row_number() OVER (PARTITION BY doc_id ORDER BY n DESC, words_count) AS k FROM freq),
repeats AS (SELECT doc_id, count(*) FILTER (WHERE n > 1) AS repeated_lines, max(n) AS most_repeats FROM (SELECT doc_id, line, count(*) AS n FROM line_stats GROUP BY ALL) GROUP BY doc_id)""".replace("\\\\", "\\")


@query(f"""WITH {_BUNDLE} SELECT doc_id, count(*) AS num_of_lines, sum(bytes)::BIGINT AS bytes, sum(words_count)::BIGINT AS words_count, sum(char_count)::BIGINT AS char_count, sum(non_li_char_count)::BIGINT AS non_li_count, any_value(symbol_numbers_count) AS symbol_numbers_count, round(avg(words_count), 6) AS mean, round(median(words_count), 6) AS median, any_value(mode)::BIGINT AS mode, min(words_count)::BIGINT AS min, max(words_count)::BIGINT AS max, any_value(repeated_lines) AS repeated_lines, any_value(most_repeats) AS most_repeats
FROM line_stats JOIN symbols USING (doc_id) JOIN modes USING (doc_id) JOIN repeats USING (doc_id) WHERE k = 1 GROUP BY doc_id""")
def document_bundle(spark, d):
    rows = lines.doc_to_sentences(documents(spark, d).select("doc_id", "source", "url", "text"))
    out = stats.document_bundle(stats.line_stats(rows, lang_col=None, symbols=True))
    counts, length = F.map_values("repeated_line_dist"), F.col("line_length_stats")
    out = out.select("doc_id", "num_of_lines", *[F.col("stats")[c].alias(c) for c in ("bytes", "words_count", "char_count", "non_li_count", "symbol_numbers_count")], F.round(length["mean"], 6).alias("mean"), F.round(length["median"], 6).alias("median"), *[length[c].alias(c) for c in ("mode", "min", "max")], F.size(F.filter(counts, lambda n: n > 1)).alias("repeated_lines"), F.array_max(counts).alias("most_repeats"))
    return _big(out, "num_of_lines", "mode", "min", "max", "repeated_lines", "most_repeats")


# Repetition ----------------------------------------------------------------

_CHAR_GRAMS = """g AS (SELECT doc_id, substring(text, i, 10) AS g FROM (SELECT doc_id, text, unnest(generate_series(1, length(text) - 9)) AS i FROM documents WHERE length(text) >= 10)),
c AS (SELECT doc_id, g, count(*) AS n FROM g GROUP BY ALL),
r AS (SELECT doc_id, n, row_number() OVER (PARTITION BY doc_id ORDER BY n DESC) AS k, floor(sqrt(count(*) OVER (PARTITION BY doc_id))) AS top FROM c),
char_scores AS (SELECT doc_id, sum(n) FILTER (WHERE k <= top) / sum(n) AS score FROM r GROUP BY doc_id)"""
_WORD_GRAMS = r"""p AS (SELECT doc_id, trim(regexp_replace(regexp_replace(replace(text, chr(9), ' '), '([!-/:-@\[-`{-~।॥꫰-꫱꯫-꯯᱾-᱿])', ' \1 ', 'g'), ' +', ' ', 'g'), ' ') AS s FROM documents WHERE text IS NOT NULL),
w AS (SELECT doc_id, string_split(regexp_replace(regexp_replace(s, '([0-9]) ([,.:/]) ([0-9])', '\1\2\3', 'g'), '([0-9]) ([,.:/]) ([0-9])', '\1\2\3', 'g'), ' ') AS w FROM p),
wg AS (SELECT doc_id, array_to_string(w[i:i + 4], chr(1)) AS g FROM (SELECT doc_id, w, unnest(generate_series(1, len(w) - 4)) AS i FROM w WHERE len(w) >= 5)),
wc AS (SELECT doc_id, g, count(*) AS n FROM wg GROUP BY ALL),
word_scores AS (SELECT doc_id, nullif(coalesce(sum(n) FILTER (WHERE n >= 2), 0) / sum(n), 0) AS score FROM wc GROUP BY doc_id)"""


@query(f"WITH {_CHAR_GRAMS} SELECT doc_id, round(score, 6) AS score FROM documents LEFT JOIN char_scores USING (doc_id)")
def char_ngram_repetition(spark, d):
    return documents(spark, d).select("doc_id", F.round(N.char_repetition(F.col("text"), 10), 6).alias("score"))


@query(f"WITH {_WORD_GRAMS} SELECT doc_id, round(score, 6) AS score FROM documents LEFT JOIN word_scores USING (doc_id)")
def word_ngram_repetition(spark, d):
    return documents(spark, d).select("doc_id", F.round(N.word_repetition(F.col("text"), 5), 6).alias("score"))


@query(f"WITH {_CHAR_GRAMS}, {_WORD_GRAMS} SELECT doc_id, coalesce(char_scores.score >= 0.2, false) AS has_char_repetition, coalesce(word_scores.score >= 0.4, false) AS has_word_repetition FROM documents LEFT JOIN char_scores USING (doc_id) LEFT JOIN word_scores USING (doc_id)")
def has_repetition(spark, d):
    c, t = Config(), F.col("text")
    char = N.exceeds({n: N.char_repetition(t, int(n)) for n in c.char_ngram_cum_thresholds}, c.char_ngram_cum_thresholds)
    word = N.exceeds({n: N.word_repetition(t, int(n)) for n in c.word_ngram_cum_thresholds}, c.word_ngram_cum_thresholds)
    return documents(spark, d).select("doc_id", char.alias("has_char_repetition"), word.alias("has_word_repetition"))


# Flags and filters ---------------------------------------------------------

_NO_SCORES = replace(Config(), calculate_repetition_scores=False, char_repetition_filter=False, word_repetition_filter=False)


def _flagged(spark, d) -> DataFrame:
    return flags.add_flags(stats.doc_stats(_line_stats(spark, d)), _NO_SCORES)


@query(f"WITH {_FLAGS} SELECT doc_id, has_less_lines, is_short_lines_heavy, is_non_li_heavy FROM flagged")
def doc_flags(spark, d):
    return _flagged(spark, d).select("doc_id", "has_less_lines", "is_short_lines_heavy", "is_non_li_heavy")


@query(f"""WITH {_FLAGS}, symbols AS (SELECT doc_id, sum(len(regexp_extract_all(line, '[^{_VALID} \n]|\\p{{Nd}}')))::BIGINT AS s FROM sentences GROUP BY doc_id)
SELECT doc_id, has_less_lines, is_short_lines_heavy, false AS is_nsfw_heavy, is_non_li_heavy, coalesce(s / nullif(char_count, 0) >= 0.1, false) AS is_symbol_number_heavy FROM flagged JOIN symbols USING (doc_id)""".replace("\\\\", "\\"))
def flag_document(spark, d):
    rows = lines.doc_to_sentences(documents(spark, d).select("doc_id", "text"))
    counted = stats.doc_stats(stats.line_stats(rows, lang_col=None, symbols=True))
    return flags.flag_document(counted, 0.1, _NO_SCORES).select("doc_id", "has_less_lines", "is_short_lines_heavy", "is_nsfw_heavy", "is_non_li_heavy", "is_symbol_number_heavy")


@query(f"WITH {_FLAGS} SELECT doc_id, lines_count FROM flagged WHERE NOT has_less_lines AND NOT is_short_lines_heavy AND NOT is_non_li_heavy")
def filtered_stats(spark, d):
    return flags.keep_unflagged(_flagged(spark, d), _NO_SCORES).select("doc_id", "lines_count")


@query(f"WITH {_FLAGS} SELECT doc_id, text, words_count FROM documents JOIN flagged USING (doc_id) WHERE NOT has_less_lines AND NOT is_short_lines_heavy AND NOT is_non_li_heavy")
def document_removal(spark, d):
    kept = flags.keep_unflagged(_flagged(spark, d), _NO_SCORES)
    return flags.remove_documents(documents(spark, d).select("doc_id", "text"), kept).select("doc_id", "text", "words_count")


@query(f"WITH {_FLAGS} SELECT doc_id FROM documents WHERE doc_id IN (SELECT doc_id FROM flagged WHERE NOT has_less_lines AND NOT is_short_lines_heavy AND NOT is_non_li_heavy)")
def surviving_documents(spark, d):
    kept = flags.keep_unflagged(_flagged(spark, d), _NO_SCORES)
    return flags.surviving_documents(documents(spark, d).select("doc_id"), kept)


# Keywords ------------------------------------------------------------------

# In the SQL every character that belongs to no word is doubled, in the text and
# in the terms, so that neighbouring hits do not share a border.
_HITS = r"""terms AS (SELECT language, string_agg(regexp_replace(regexp_replace(lower(term), '([^0-9A-Za-z_])', '\1\1', 'g'), '([.*+?^$()|\[\]{}-])', '\\\1', 'g'), '|' ORDER BY length(term) DESC, lower(term)) AS p FROM flag_terms GROUP BY language),
kw AS (SELECT d.doc_id, CASE WHEN p IS NULL THEN 0 ELSE len(regexp_extract_all(regexp_replace(lower(text), '([^0-9A-Za-z_])', '\1\1', 'g'), '(?s)(^|[^0-9A-Za-z_])(' || p || ')([^0-9A-Za-z_]|$)')) END AS hits FROM documents d LEFT JOIN terms t ON d.lang = t.language WHERE d.text IS NOT NULL)"""


_SPLIT_TERMS = r"""t_patterns AS (SELECT language, '(?s)(^|[^0-9A-Za-z_])(' || p || ')([^0-9A-Za-z_]|$)' AS p FROM terms),
t_names AS (SELECT DISTINCT language, lower(term) AS term, regexp_replace(lower(term), '([^0-9A-Za-z_])', '\1\1', 'g') AS twice FROM flag_terms),
"""


def _term_hits(source: str) -> str:
    """CTE ``found``: a row per hit (doc_id, term, nth and the doubled pieces) in ``source`` (doc_id, lang, pos, line)."""
    return rf"""{_HITS.split("kw AS")[0]}{_SPLIT_TERMS}doubled AS (SELECT doc_id, lang, pos, p, regexp_replace(lower(line), '([^0-9A-Za-z_])', '\1\1', 'g') AS x FROM {source} JOIN t_patterns ON lang = language),
pieces AS (SELECT doc_id, lang, pos, regexp_extract_all(x, p, 0) AS m, regexp_extract_all(x, p, 1) AS border, regexp_extract_all(x, p, 2) AS h, regexp_split_to_array(x, p) AS gap FROM doubled),
numbered AS (SELECT *, unnest(h) AS twice, generate_subscripts(h, 1) AS k FROM pieces),
found AS (SELECT numbered.*, term FROM numbered JOIN t_names ON lang = language AND numbered.twice = t_names.twice)"""


def _lists(spark, d) -> dict[str, list[str]]:
    return K.lists_from_table(table(spark, d, "flag_terms"))


@query(f"WITH texts AS (SELECT doc_id, lang, 0 AS pos, text AS line FROM documents WHERE text IS NOT NULL), {_term_hits('texts')} SELECT doc_id, term, count(*) AS count FROM found GROUP BY ALL")
def keyword_counts(spark, d):
    docs = documents(spark, d).where("text is not null")
    dist = K.by_language(F.col("text"), F.col("lang"), _lists(spark, d), K.distribution)
    return _big(docs.select("doc_id", F.explode(dist).alias("term", "count")), "count")


@query(f"WITH {_HITS} SELECT doc_id, hits::BIGINT AS hits FROM kw")
def keyword_totals(spark, d):
    docs = documents(spark, d).where("text is not null")
    dist = K.by_language(F.col("text"), F.col("lang"), _lists(spark, d), K.distribution)
    return docs.select("doc_id", K.total(dist).cast("bigint").alias("hits"))


# lengths in the doubled text: a character of no word counts half
_HALF = "(length({x}) - length(regexp_replace({x}, '[0-9A-Za-z_]', '', 'g')) / 2)"


@query(f"""WITH texts AS (SELECT doc_id, lang, 0 AS pos, text AS line FROM documents WHERE text IS NOT NULL), {_term_hits('texts')},
placed AS (SELECT doc_id, term, twice, list_sum(list_transform(gap[1:k], lambda y: {_HALF.format(x='y')})) + coalesce(list_sum(list_transform(m[1:k - 1], lambda y: {_HALF.format(x='y')})), 0) + {_HALF.format(x='border[k]')} AS start FROM found)
SELECT doc_id, term, start::BIGINT AS start, (start + {_HALF.format(x='twice')})::BIGINT AS "end" FROM placed""")
def keyword_positions(spark, d):
    docs = documents(spark, d).where("text is not null")
    found = K.by_language(F.col("text"), F.col("lang"), _lists(spark, d), K.hit_positions)
    return _big(docs.select("doc_id", F.explode(found).alias("hit")).select("doc_id", "hit.*"), "start", "end")


@query(r"""SELECT doc_id, len(list_filter(string_split(regexp_replace(lower(text), '[^0-9A-Za-z_]', ' ', 'g'), ' '), lambda x: x IN ('the', 'of', 'and', 'in', 'is')))::BIGINT AS stop_words FROM documents WHERE text IS NOT NULL""")
def stopword_totals(spark, d):
    dist = K.distribution(F.col("text"), ["the", "of", "and", "in", "is"])
    return documents(spark, d).where("text is not null").select("doc_id", K.total(dist).cast("bigint").alias("stop_words"))


_SENTENCE_HITS = f"{_SENTENCES}, spoken AS (SELECT sentences.doc_id, lang, pos, line FROM sentences JOIN documents USING (doc_id)), {_term_hits('spoken')}"


@query(f"WITH {_SENTENCE_HITS} SELECT doc_id, term, count(*) AS count FROM found GROUP BY ALL")
def merged_keywords(spark, d):
    rows = lines.doc_to_sentences(documents(spark, d).select("doc_id", "lang", "text"))
    counted = stats.line_stats(rows, _lists(spark, d), lang_col="lang")
    return _big(stats.merge_distributions(counted).select("doc_id", F.explode("nsfw_word_dist").alias("term", "count")), "count")


@query(f"""WITH {_FLAGS}, spoken AS (SELECT sentences.doc_id, lang, pos, line FROM sentences JOIN documents USING (doc_id)), {_term_hits('spoken')},
hits AS (SELECT doc_id, count(*) AS n FROM found GROUP BY doc_id)
SELECT doc_id, n AS nsfw_words_count, words_count FROM flagged JOIN hits USING (doc_id) WHERE NOT has_less_lines AND NOT is_short_lines_heavy AND n / words_count >= 0.01""")
def nsfw_side_output(spark, d):
    rows = lines.doc_to_sentences(documents(spark, d).select("doc_id", "lang", "text"))
    counted = stats.doc_stats(stats.line_stats(rows, _lists(spark, d), lang_col="lang"))
    config = replace(_NO_SCORES, nsfw_threshold=0.01)
    return flags.nsfw_side_output(flags.add_flags(counted, config), config).select("doc_id", "nsfw_words_count", "words_count")


# Cleaning ------------------------------------------------------------------

_PLAIN = replace(Config(), remove_code=False)
_CLEANED = f"""once AS (SELECT DISTINCT doc_id, text FROM extracted WHERE text IS NOT NULL AND text != '' AND doc_id IS NOT NULL),
m AS (SELECT *, {_symbols('text')} AS invalid, {_symbols('text')} / length(text) AS ratio, list_filter(string_split(text, chr(10)), lambda x: {_proper('x')}) AS kept FROM once)"""


@query(f"WITH {_CLEANED} SELECT doc_id, CASE WHEN len(kept) > 0 THEN array_to_string(kept, chr(10)) || chr(10) END AS text, length(text)::BIGINT AS chars, invalid::BIGINT AS invalid FROM m WHERE ratio < 0.2")
def chunk_clean(spark, d):
    once = table(spark, d, "extracted").where("doc_id is not null").select("doc_id", "text").distinct()
    cleaned, _ = clean.clean_documents(once, [], _PLAIN)
    return cleaned.select("doc_id", "text", F.col("uncleaned_chars_count").cast("bigint").alias("chars"), F.col("invalid_char_count").cast("bigint").alias("invalid"))


@query(f"""WITH m AS (SELECT DISTINCT doc_id, uncleaned_text AS text, {_symbols('uncleaned_text')} / nullif(length(uncleaned_text), 0) AS ratio FROM cleaned) SELECT doc_id, text, round(ratio, 5) AS ratio FROM m WHERE ratio >= 0.2""")
def symbol_heavy_side(spark, d):
    rows = table(spark, d, "cleaned").select("doc_id", F.col("uncleaned_text").alias("text")).distinct()
    measured = clean.measured(rows, [], _PLAIN)
    return measured.where(F.col("symbol_ratio") >= 0.2).select("doc_id", F.col("_original").alias("text"), F.round("symbol_ratio", 5).alias("ratio"))


@query("""WITH c AS (SELECT url, unnest(string_split(text, chr(10))) AS chunk FROM (SELECT DISTINCT doc_id, url, text FROM cleaned WHERE text IS NOT NULL)) SELECT url, chunk FROM c GROUP BY url, chunk HAVING count(*) = 1""")
def repeated_chunk_filter(spark, d):
    once = table(spark, d, "cleaned").where("text is not null").select("doc_id", "url", "text").distinct()
    return clean.unique_chunks(once.drop("doc_id")).select("url", F.col("text").alias("chunk"))


def _code_sql(source: str) -> str:
    """CTEs ``spans`` (row, p, k, opens, n) and ``bare`` (row, bare: the text
    without code) of ``source`` (row, text). Places are sums of the lengths of
    the matches and of what stands between them."""
    re2 = lambda p: p.replace("(?d)", "")
    parts = " UNION ALL ".join(f"SELECT row, text, {k} AS p, regexp_extract_all(text, '{re2(p)}') AS m, regexp_split_to_array(text, '{re2(p)}') AS gap FROM {source}{' WHERE contains(text, chr(123))' if k else ''}" for k, p in enumerate((C.TAG_PAIR, C.SCRIPT_FUNCTION, C.STYLE_RULE)))
    return f"""matched AS ({parts}),
each AS (SELECT row, text, p, m, gap, unnest(generate_series(1, len(m))) AS k FROM matched),
spans AS (SELECT row, text, p, k, (list_sum(list_transform(gap[1:k], lambda x: length(x))) + coalesce(list_sum(list_transform(m[1:k - 1], lambda x: length(x))), 0))::BIGINT AS opens, length(m[k]) AS n FROM each),
ordered AS (SELECT row, text, p, k, opens, opens + n AS stop, lag(opens + n, 1, 0) OVER (PARTITION BY row ORDER BY p, k) AS ahead FROM spans),
between AS (SELECT row, string_agg(CASE WHEN opens > ahead THEN substring(text, ahead + 1, opens - ahead) ELSE '' END, '' ORDER BY p, k) || any_value(text)[arg_max(stop, p * 1000000 + k) + 1:] AS kept FROM ordered GROUP BY row),
bare AS (SELECT s.row, coalesce(kept, text) AS bare FROM {source} s LEFT JOIN between USING (row))"""


_PAGES = "pages AS (SELECT row_number() OVER () AS row, * FROM (SELECT DISTINCT doc_id, html AS text FROM raw_crawl WHERE html IS NOT NULL))"


@query(f"""WITH pages AS (SELECT row_number() OVER () AS row, * FROM (SELECT DISTINCT doc_id, url, source, coalesce(html, text) AS text FROM raw_crawl) WHERE text IS NOT NULL), {_code_sql('pages')},
r AS (SELECT doc_id, coalesce(url, 'None') AS url, coalesce(source, 'None') AS source, bare AS t, {_symbols('bare')} AS invalid, list_filter(string_split(bare, chr(10)), lambda x: {_proper('x')}) AS kept FROM pages JOIN bare USING (row) WHERE bare != '')
SELECT doc_id, CASE WHEN len(kept) > 0 THEN array_to_string(kept, chr(10)) || chr(10) END AS text, url, source, length(t)::BIGINT AS uncleaned_chars_count, len(string_split(t, ' '))::BIGINT AS uncleaned_words_count, strlen(t)::BIGINT AS uncleaned_bytes, round(invalid / length(t), 5) AS symbol_ratio, invalid::BIGINT AS invalid_char_count, t AS uncleaned_text FROM r WHERE invalid / length(t) < 0.2""")
def clean_with_code(spark, d):
    rows = table(spark, d, "raw_crawl").select("doc_id", "url", "source", F.coalesce("html", "text").alias("text")).distinct()
    out = clean.clean_documents(rows, ["url", "source"])[0].drop("code_spans").withColumn("symbol_ratio", F.round(F.col("symbol_ratio").cast("double"), 5))
    return _big(out, "uncleaned_chars_count", "uncleaned_words_count", "uncleaned_bytes", "invalid_char_count")


@query(f'WITH {_PAGES}, {_code_sql("pages")} SELECT doc_id, opens AS "begin", opens + n AS "end" FROM spans JOIN pages USING (row)')
def code_spans(spark, d):
    rows = table(spark, d, "raw_crawl").select("doc_id", "html").distinct().where("html is not null")
    return _big(rows.select("doc_id", F.explode(C.code_spans(F.col("html"))).alias("span")).select("doc_id", F.col("span")[0].alias("begin"), F.col("span")[1].alias("end")), "begin", "end")


@query(f"WITH {_PAGES}, {_code_sql('pages')} SELECT doc_id, bare AS text FROM pages JOIN bare USING (row)")
def remove_code(spark, d):
    rows = table(spark, d, "raw_crawl").select("doc_id", "html").distinct().where("html is not null")
    return rows.select("doc_id", C.remove_code(F.col("html"), C.code_spans(F.col("html"))).alias("text"))


@query("SELECT DISTINCT doc_id, coalesce(regexp_matches(html, '<[A-Za-z!/][^>]*>'), false) AS is_html FROM raw_crawl")
def html_detect(spark, d):
    return table(spark, d, "raw_crawl").select("doc_id", H.is_html(F.col("html")).alias("is_html")).distinct()


@query()
def extract_text(spark, d):
    raw = table(spark, d, "raw_crawl").select("doc_id", "url", "source", "timestamp", F.lit(None).cast("string").alias("language"), F.coalesce("html", "text").alias("text"))
    return stages.extract_text(raw)


def _rules_sql(text: str, language: str) -> str:
    """The normalisation rules. SQL has no NFKC; the texts here are in that form but for these rules."""
    whens = []
    for script in sorted(set(U.RULES_OF.values())):
        x = text
        for pattern, new in U.steps(script):
            quoted = [y.replace(chr(39), chr(39) * 2) for y in (pattern, new.replace("$1", chr(92) + "1"))]
            x = f"regexp_replace({x}, '{quoted[0]}', '{quoted[1]}', 'g')"
        whens.append(f"WHEN {language} IN {_in([k for k, v in U.RULES_OF.items() if v == script])} THEN {x}")
    return f"CASE {' '.join(whens)} ELSE {text} END"


@query(f"SELECT doc_id, {_rules_sql('text', 'language')} AS text FROM lid")
def nfkc(spark, d):
    return table(spark, d, "lid").select("doc_id", U.normalize(F.col("text"), F.col("language")).alias("text"))


# Languages -----------------------------------------------------------------


@query("SELECT doc_id, CASE WHEN cld3_lang = nllb_lang AND (indiclid_lang <> cld3_lang OR indiclid_lang IS NULL) THEN cld3_lang ELSE indiclid_lang END AS lang FROM lid")
def hard_vote(spark, d):
    vote = L.hard_vote(F.col("indiclid_lang"), F.col("cld3_lang"), F.col("nllb_lang"))
    return table(spark, d, "lid").select("doc_id", vote.alias("lang"))


@query("SELECT doc_id, iso639_3 AS code FROM lid LEFT JOIN lang_names ON doc_lang = lang_names.language")
def iso_mapping(spark, d):
    codes = readers.language_codes(table(spark, d, "lang_names"))
    return table(spark, d, "lid").select("doc_id", L.iso_code(F.col("doc_lang"), codes).alias("code"))


def _first_most(counts: list[tuple[str, str]]) -> tuple[str, str, str]:
    """SQL of the first label with the most, of the most and of the sum."""
    most = "greatest(" + ", ".join(n for _, n in counts) + ")"
    whens = " ".join(f"WHEN {n} = {most} THEN '{x}'" for x, n in counts)
    return f"CASE WHEN {most} = 0 THEN 'other' {whens} END", most, "(" + " + ".join(n for _, n in counts) + ")"


def _detector_sql(source: str) -> str:
    """CTE ``said``: what the three built-in detectors say of ``source`` (doc_id, t)."""
    share = "coalesce(len(regexp_extract_all(t, '[a-zA-Z0-9]')) / nullif(length(t) - len(regexp_extract_all(t, '[@_!#$%^&*()<>?/|}{~:]')) - len(regexp_extract_all(t, '[\\s\\x{0b}\\x1c-\\x1f\\x{85}\\p{Z}]')) - len(regexp_extract_all(t, '\\n')), 0), 0)".replace("\\\\", "\\")
    scripts = ", ".join(f"len(regexp_extract_all(t, '{L.block_class(r)}')) AS s_{c}" for c, _, r in L.SCRIPT_BLOCKS)
    hits = lambda words: f"len(list_filter(w, lambda x: x IN {_in(words)}))"
    words = ", ".join(f"{hits(w + (L.ROMAN_WORDS if lang == 'hindi' else ()))} AS w_{lang}" for lang, w in L.FUNCTION_WORDS.items())
    pairs = lambda p: f"len(regexp_extract_all(lower(t), '{'|'.join(p)}'))"
    script, n, total = _first_most([(c, f"s_{c}") for c, _, _ in L.SCRIPT_BLOCKS])
    spoken, m, _ = _first_most([(lang, f"w_{lang}") for lang in L.FUNCTION_WORDS])
    alone = " ".join(f"WHEN script = '{c}' THEN '{lang}'" for c, lang, _ in L.SCRIPT_BLOCKS)
    return f"""d_words AS (SELECT *, list_filter(regexp_split_to_array(lower(t), '{L.BETWEEN}'), lambda x: x != '') AS w FROM {source}),
d_counts AS (SELECT *, {share} AS roman, {scripts}, {words}, {hits(L.ROMAN_WORDS)} AS h, {hits(L.FUNCTION_WORDS['english'])} AS e, {hits(L.FUNCTION_WORDS['marathi'])} > {hits(L.FUNCTION_WORDS['hindi'])} AS marathi, {pairs(L.ROMAN_PAIRS)} AS hp, {pairs(L.ENGLISH_PAIRS)} AS ep FROM d_words),
d_script AS (SELECT *, {script} AS script, coalesce({n} / nullif({total}, 0), 0)::FLOAT AS script_share FROM d_counts),
said AS (SELECT doc_id,
CASE WHEN roman > {L.ROMAN_SHARE} THEN CASE WHEN coalesce(greatest(h, e) / nullif(h + e, 0), 0) > {L.ROMAN_SCORE} THEN CASE WHEN h > e THEN 'hindi' ELSE 'english' END WHEN hp > ep THEN 'hindi' ELSE 'english' END
WHEN script = 'Deva' AND marathi THEN 'marathi' WHEN script = 'Beng' AND regexp_matches(t, '[{L.ASSAMESE_LETTERS}]') THEN 'assamese' {alone} ELSE 'other' END AS routed_lang,
CASE WHEN roman > {L.ROMAN_SHARE} THEN coalesce(CASE WHEN coalesce(greatest(h, e) / nullif(h + e, 0), 0) > {L.ROMAN_SCORE} THEN greatest(h, e) / nullif(h + e, 0) ELSE greatest(hp, ep) / nullif(hp + ep, 0) END, 0)::FLOAT ELSE script_share END AS routed_probability,
CASE WHEN roman > {L.ROMAN_SHARE} THEN 'Latn' ELSE script END AS routed_script,
{spoken} AS words_lang, coalesce({m} / nullif(len(w), 0), 0)::FLOAT AS words_probability,
CASE {alone} ELSE 'other' END AS script_lang, script_share AS script_probability FROM d_script),
voted AS (SELECT *, CASE WHEN words_lang = script_lang AND routed_lang <> words_lang THEN words_lang ELSE routed_lang END AS vote FROM said),
named AS (SELECT *, CASE WHEN vote IN (SELECT language FROM lang_names) THEN vote ELSE 'other' END AS doc_lang FROM voted),
identified AS (SELECT named.*, CASE WHEN doc_lang = 'other' THEN 'other' ELSE iso639_3 END AS doc_lang_iso FROM named LEFT JOIN lang_names ON doc_lang = lang_names.language)"""


@query(f"""WITH texts AS (SELECT doc_id, replace(text, chr(10), ' ') AS t FROM lid WHERE text IS NOT NULL), {_detector_sql('texts')}
SELECT doc_id, doc_lang, doc_lang_iso, routed_lang, routed_script, words_lang, script_lang, round(routed_probability::DOUBLE, 4) AS routed_probability, round(words_probability::DOUBLE, 4) AS words_probability, round(script_probability::DOUBLE, 4) AS script_probability FROM identified""")
def identify_language(spark, d):
    codes = readers.language_codes(table(spark, d, "lang_names"))
    found = stages.identify_language(table(spark, d, "lid").drop("doc_lang", "doc_lang_iso"), stages.default_detectors(), codes)
    names = ("routed", "words", "script")
    return found.select("doc_id", "doc_lang", "doc_lang_iso", "routed_lang", "routed_script", "words_lang", "script_lang", *[F.round(F.col(f"{n}_probability").cast("double"), 4).alias(f"{n}_probability") for n in names])


# Deduplication, sinks, whole pipeline --------------------------------------


@query("""SELECT doc_id, timestamp, md5(text) AS text_md5 FROM (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY strptime(timestamp, '%d/%m/%y %H:%M') DESC NULLS LAST, md5(text)) AS k FROM (SELECT DISTINCT doc_id, timestamp, text FROM extracted)) WHERE k = 1""")
def exact_dedup(spark, d):
    rows = table(spark, d, "extracted").select("doc_id", "timestamp", F.md5("text").alias("text_md5")).distinct()
    return dedup.one_per_key(rows, "doc_id", [F.try_to_timestamp("timestamp", F.lit("dd/MM/yy HH:mm")).desc_nulls_last(), F.col("text_md5").asc_nulls_last()])


@query("SELECT * FROM (SELECT DISTINCT doc_id, timestamp FROM extracted) WHERE timestamp IS NOT NULL")
def null_drop(spark, d):
    return table(spark, d, "extracted").select("doc_id", "timestamp").distinct().dropna(subset=["timestamp"])


_CLASSES = """WITH RECURSIVE w AS (SELECT doc_id, list_filter(regexp_split_to_array(lower(text), '[\\s\\x{0b}]+'), lambda x: x != '') AS w FROM documents WHERE text IS NOT NULL AND doc_id IS NOT NULL),
signed AS (SELECT doc_id, w, md5(array_to_string(w, ' ')) AS h FROM w WHERE len(w) > 0),
sets AS (SELECT h, CASE WHEN len(any_value(w)) < 5 THEN [array_to_string(any_value(w), ' ')] ELSE list_distinct(list_transform(generate_series(1, len(any_value(w)) - 4), lambda i: array_to_string(any_value(w)[i:i + 4], ' '))) END AS g FROM signed GROUP BY h),
grams AS (SELECT h, len(g) AS n, unnest(g) AS g FROM sets),
links AS (SELECT a.h AS x, b.h AS y FROM grams a JOIN grams b ON a.g = b.g AND a.h != b.h GROUP BY a.h, b.h, a.n, b.n HAVING count(*) * 9 >= (a.n + b.n) * 4),
reach AS (SELECT h AS x, h AS y FROM sets UNION SELECT reach.x, links.y FROM reach JOIN links ON reach.y = links.x),
roots AS (SELECT x AS h, min(y) AS root FROM reach GROUP BY x),
members AS (SELECT doc_id, root FROM signed JOIN roots USING (h)),
least AS (SELECT root, min(doc_id) AS class_id FROM members GROUP BY root),
classes AS (SELECT d.doc_id, coalesce(min(class_id), d.doc_id) AS class_id FROM documents d LEFT JOIN (SELECT * FROM members JOIN least USING (root)) m USING (doc_id) WHERE d.doc_id IS NOT NULL GROUP BY d.doc_id)""".replace("\\\\", "\\")


@query(f"{_CLASSES} SELECT doc_id, class_id FROM classes")
def near_duplicates(spark, d):
    return dedup.near_duplicates(documents(spark, d))


@query(f"{_CLASSES} SELECT doc_id, md5(text) AS text_md5 FROM documents JOIN classes USING (doc_id) WHERE class_id = doc_id")
def near_duplicate_survivors(spark, d):
    return dedup.drop_near_duplicates(documents(spark, d)).select("doc_id", F.md5("text").alias("text_md5"))


def _scratch(spark) -> str:
    """A fresh folder beside the checkpoints, which all executors share."""
    use_checkpoint_dir(spark)
    return f"{spark.sparkContext._jsc.sc().getCheckpointDir().get()}/{uuid.uuid4().hex}"


@query("SELECT doc_lang, count(*) AS n FROM lid WHERE doc_lang IS NOT NULL GROUP BY doc_lang")
def partitioned_write(spark, d):
    root = _scratch(spark)
    sinks.write_by_language(table(spark, d, "lid").where("doc_lang is not null").select("doc_id", "doc_lang"), root)
    # an empty table leaves no file to take the schema from
    return spark.read.schema("doc_id string, doc_lang string").parquet(root).groupBy("doc_lang").agg(F.count("*").alias("n"))


@query("SELECT doc_lang AS folder, count(*) AS n FROM lid WHERE doc_lang IS NOT NULL GROUP BY doc_lang")
def renamed_folders(spark, d):
    root = _scratch(spark)
    sinks.write_by_language(table(spark, d, "lid").where("doc_lang is not null").select("doc_id", "doc_lang"), root)
    sinks.plain_partition_names(root, spark, "doc_lang_partition")
    folder = F.regexp_extract(F.input_file_name(), r"/([^/]+)/[^/]+$", 1)
    return spark.read.schema("doc_id string, doc_lang string").option("recursiveFileLookup", True).parquet(root).groupBy(folder.alias("folder")).agg(F.count("*").alias("n"))


@query("SELECT doc_id, url, source, 'english' AS language, coalesce(html, text) AS text, timestamp FROM raw_crawl")
def crawl_json(spark, d):
    root = _scratch(spark)
    table(spark, d, "raw_crawl").select("doc_id", "url", "source", "timestamp", "html", "text").write.json(root)
    return readers.read_crawl_json(spark, root, "english", multiline=False)


@query("SELECT doc_id, url, source, 'hindi' AS language, page_no, identifier, pdf_name, text FROM raw_ocr")
def scan_json(spark, d):
    root = _scratch(spark)
    table(spark, d, "raw_ocr").write.json(root)
    return readers.read_scan_json(spark, root, "hindi", multiline=False)


@query("SELECT DISTINCT doc_id, url, body AS text, 'english' AS language FROM extracted")
def stage_json(spark, d):
    root = _scratch(spark)
    table(spark, d, "extracted").select("doc_id", "url", "body").write.json(root)
    return readers.read_stage_json(spark, root, ["doc_id", "url", "body"], "english", multiline=False)


@query("SELECT source, count(*) AS n FROM documents GROUP BY source")
def manifest_scan(spark, d):
    root = _scratch(spark)
    docs = documents(spark, d).select("doc_id", "source")
    sinks.write_parquet(docs.where("doc_id % 2 = 0 or doc_id is null"), f"{root}/even")
    sinks.write_parquet(docs.where("doc_id % 2 != 0"), f"{root}/odd")
    spark.createDataFrame([(f"{root}/even",), ("",), (f"{root}/odd",)], "path string").coalesce(1).write.text(f"{root}/list")
    return readers.read_manifest(spark, f"{root}/list").groupBy("source").agg(F.count("*").alias("n"))


@query("SELECT count(*)::BIGINT AS rows FROM documents")
def partition_rows(spark, d):
    return sinks.partition_histogram(documents(spark, d)).agg(F.sum("rows").alias("rows"))


_CURATED = f"""WITH pages AS (SELECT row_number() OVER () AS row, * FROM (SELECT DISTINCT doc_id, text FROM extracted WHERE text IS NOT NULL)), {_code_sql('pages')},
bared AS (SELECT doc_id, bare AS t, list_filter(string_split(bare, chr(10)), lambda x: {_proper('x')}) AS kept FROM pages JOIN bare USING (row) WHERE bare != '' AND {_symbols('bare')} / length(bare) < 0.2),
cleaned_docs AS (SELECT doc_id, array_to_string(kept, chr(10)) || chr(10) AS text FROM bared WHERE len(kept) > 0),
texts AS (SELECT doc_id, replace(text, chr(10), ' ') AS t FROM cleaned_docs), {_detector_sql('texts')},
{_SENTENCES.replace('FROM documents', 'FROM cleaned_docs')},
spoken AS (SELECT sentences.doc_id, doc_lang, pos, {_rules_sql('line', 'doc_lang')} AS line FROM sentences JOIN identified USING (doc_id)),
lines AS (SELECT *, len(string_split(line, ' ')) AS words FROM spoken WHERE NOT regexp_full_match(line, '\\p{{Nd}}+')),
rebuilt AS (SELECT doc_id, any_value(doc_lang) AS doc_lang, string_agg(CASE WHEN starts_with(line, '  ') THEN substring(line, 2) ELSE line END, '' ORDER BY pos) AS text, count(*) AS lines_count, sum(words)::BIGINT AS words_count, sum(length(line))::BIGINT AS char_count, sum(strlen(line))::BIGINT AS bytes, avg(words) AS mean_line_length, sum({_foreign('line')})::BIGINT AS non_li_char_count FROM lines GROUP BY doc_id),
{_CHAR_GRAMS.replace('FROM documents', 'FROM rebuilt')}, {_WORD_GRAMS.replace('FROM documents', 'FROM rebuilt')}
SELECT doc_id, doc_lang, md5(text) AS text_md5, lines_count, words_count, char_count, bytes, round(mean_line_length, 6) AS mean_line_length, non_li_char_count FROM rebuilt LEFT JOIN char_scores c USING (doc_id) LEFT JOIN word_scores w USING (doc_id)
WHERE lines_count > 4 AND mean_line_length > 5 AND NOT coalesce(non_li_char_count / nullif(char_count, 0) >= 0.05, false) AND NOT coalesce(c.score::FLOAT::DOUBLE >= 0.2, false) AND NOT coalesce(w.score::FLOAT::DOUBLE >= 0.4, false)""".replace("\\\\", "\\")


@query(_CURATED)
def curated_documents(spark, d):
    codes = readers.language_codes(table(spark, d, "lang_names"))
    rows = table(spark, d, "extracted").select("doc_id", "url", "source", "language", "text")
    out = stages.curate(rows, codes, _lists(spark, d), for_language("english"))
    return out.select("doc_id", "doc_lang", F.md5("text").alias("text_md5"), "lines_count", "words_count", "char_count", "bytes", F.round("mean_line_length", 6).alias("mean_line_length"), "non_li_char_count")
