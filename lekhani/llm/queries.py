"""Queries over the test tables and the statements that check them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lekhani.llm import encode, language, mixing, ocr, pagebody, quality, repetition, sitelines, splitting, toxicity
from lekhani.llm.oracles import ORACLES

__all__ = ["ORACLES", "QUERIES"]

#: Rows of split_sizes and mix_targets are configuration; more than this is refused.
MAX_SETTINGS = 1000


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def p1_found(spark, d):
    scored = repetition.score_repetition(_table(spark, d, "documents"))
    return scored.where("repeats_itself").select("doc_id").distinct()


def p1_repetition(spark, d):
    scored = repetition.score_repetition(_table(spark, d, "documents"))
    return scored.select("doc_id", *[F.col(c).cast("bigint").alias(c) for c in ("n_words", "repeated_words")], F.round("repeated_share", 6).alias("repeated_share"), *[r.name for r in repetition.DEFAULT_RULES])


def p2_found(spark, d):
    return ocr.noise_items(_table(spark, d, "raw_ocr"))


def p2_pages(spark, d):
    return ocr.repaired_pages(_table(spark, d, "raw_ocr"))


def p3_found(spark, d):
    return sitelines.repeated_site_lines(_table(spark, d, "extracted"))


def p3_clean(spark, d):
    docs = _table(spark, d, "extracted")
    return sitelines.strip_site_lines(docs, sitelines.repeated_site_lines(docs)).withColumn("lines_removed", F.col("lines_removed").cast("bigint"))


def p8_ids(spark, d):
    return encode.encode_corpus(_table(spark, d, "documents"))


def _sizes(spark, d) -> list[tuple[str, int, int]]:
    rows = _table(spark, d, "split_sizes").where("size_name is not null and max_tokens is not null").limit(MAX_SETTINGS + 1).collect()
    if len(rows) > MAX_SETTINGS:
        raise ValueError("too many split sizes")
    return [(r.size_name, r.max_tokens, r.overlap_tokens or 0) for r in rows]


def p10_pieces(spark, d):
    return splitting.split_long_texts(_table(spark, d, "documents"), _sizes(spark, d))


def _mixture(spark, d):
    docs, targets = _table(spark, d, "documents"), _table(spark, d, "mix_targets")
    if targets.limit(MAX_SETTINGS + 1).count() > MAX_SETTINGS:  # it is broadcast
        raise ValueError("too many mixture targets")
    sizes = mixing.document_sizes(docs, targets)
    plan = mixing.plan_mixture(sizes, targets)
    return mixing.mix(sizes, plan), plan


def p9_mixture(spark, d):
    return _mixture(spark, d)[0]


def p9_shares(spark, d):
    return mixing.reached_shares(*_mixture(spark, d))


def _lid(spark, d):
    lid, names = _table(spark, d, "lid"), _table(spark, d, "lang_names")
    named = lid.select("doc_id", language.named_language(F.col("language"), names).alias("named"), "text")
    return named, language.train(lid, names)


def p7_found(spark, d):
    named, model = _lid(spark, d)
    return language.foreign_lines(language.line_languages(named, model, ["doc_id", "named"]))


def p7_documents(spark, d):
    named, model = _lid(spark, d)
    once = named.select("doc_id", "text").distinct()
    return language.document_languages(language.language_parts(once, model, ["doc_id"]))


def p4_found(spark, d):
    return pagebody.main_content(_table(spark, d, "raw_crawl")).select("doc_id", "block_md5").distinct()


def p4_text(spark, d):
    blocks = pagebody.main_content(_table(spark, d, "raw_crawl")).select("doc_id", "block_no", "text").distinct()
    lines = F.transform(F.sort_array(F.collect_list(F.struct("block_no", "text"))), lambda x: x["text"])
    return blocks.groupBy("doc_id").agg(F.array_join(lines, "\n").alias("text"))


def p6_found(spark, d):
    return quality.text_kinds(_table(spark, d, "cleaned"))


def p6_statistics(spark, d):
    return quality.text_statistics(_table(spark, d, "cleaned"))


def p6_repetition(spark, d):
    """The statistics of ``p6_statistics`` but the kinds of lines, which SQL can check."""
    out = quality.text_statistics(_table(spark, d, "cleaned"))
    shares = ["mean_word_length", "common_word_share", "ended_line_share", "repeated_line_share", "repeated_paragraph_share", "top_2_gram_share", "top_3_gram_share", "top_4_gram_share"]
    return out.select("doc_id", *[F.col(c).cast("bigint").alias(c) for c in ("words_count", "chars_count")], F.round(F.col("symbol_ratio").cast("double"), 5).alias("symbol_ratio"), *[F.round(c, 6).alias(c) for c in shares])


def _scored(spark, d):
    docs = _table(spark, d, "documents")
    model = toxicity.train(docs, _table(spark, d, "toxic_labels"), _table(spark, d, "flag_terms"))
    return toxicity.score_documents(docs, model, ["doc_id", "source"])


def p5_found(spark, d):
    return toxicity.offending(_scored(spark, d))


def p5_scores(spark, d):
    return _scored(spark, d)


def p5_rates(spark, d):
    return toxicity.rates(_scored(spark, d))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (p1_found, p1_repetition, p2_found, p2_pages, p3_found, p3_clean, p4_found, p4_text, p5_found, p5_scores, p5_rates, p6_found, p6_statistics, p6_repetition, p7_found, p7_documents, p8_ids, p9_mixture, p9_shares, p10_pieces)
}
