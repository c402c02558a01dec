"""Mixing sources to target token shares.

Every document of a wanted source gets a uniform hash key. Keys range-split
each source into buckets of about equal tokens; bucket totals are summed in
key order (a small table), and inside a bucket a running sum gives each
document its place in the source's token stream. A source's budget is cut
exactly on that stream: whole epochs first, then the documents before the cut,
the one on the cut with part of its tokens.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lekhani.llm.encode import DEFAULT_TOKENIZER, count_tokens
from lekhani.session import cut_lineage

#: Tokens that one range bucket of a source holds on average.
BUCKET_TOKENS = 2_000_000
#: Targets are a configuration table and are broadcast.
MAX_TARGETS = 10_000


def _unit(key: Column) -> Column:
    """Hash key in [0, 1)."""
    return F.shiftrightunsigned(key, 11) / F.lit(float(1 << 53))


def plan_mixture(sizes: DataFrame, targets: DataFrame, total_tokens: int | None = None) -> DataFrame:
    """One row per target source: available, budget, reached share and so on.

    ``sizes`` has source and n_tokens per document. Without ``total_tokens``
    the mixture is as large as it can be with every source that has documents
    at its exact share; with it, a source short of documents (times its
    repeats) gives all it has, and the others keep their budgets. Targets that
    are null, not positive or without tokens get budget 0 and count as absent;
    a source listed twice has its largest share. Shares are of all tokens of
    the mixture: an absent source's share falls to the others in proportion.
    """
    want = (
        targets.select("source", F.col("target_share").cast("double").alias("target_share"), F.greatest(F.coalesce(F.col("max_repeats"), F.lit(1)), F.lit(0)).cast("long").alias("max_repeats"))
        .where("source is not null and target_share > 0")
        .groupBy("source")
        .agg(F.max_by(F.struct("target_share", "max_repeats"), F.struct("target_share", "max_repeats")).alias("w"))
        .select("source", "w.*")
    )
    have = sizes.where("n_tokens > 0").groupBy("source").agg(F.count("*").alias("n_docs"), F.sum("n_tokens").alias("tokens"))
    plan = want.join(have, "source", "left").na.fill(0, ["n_docs", "tokens"])
    plan = plan.withColumn("capacity", F.col("tokens") * F.col("max_repeats"))
    present = F.col("capacity") > 0
    one = W.partitionBy(F.lit(1)).rowsBetween(W.unboundedPreceding, W.unboundedFollowing)  # over the targets, a configuration table
    plan = plan.withColumn("share", F.when(present, F.col("target_share") / F.sum(F.when(present, F.col("target_share"))).over(one)).otherwise(0.0))
    room = F.min(F.when(present, F.col("capacity") / F.col("share"))).over(one)
    total = F.lit(total_tokens).cast("double") if total_tokens is not None else room
    plan = plan.withColumn("total", total).withColumn("budget", F.when(present, F.least(F.floor(F.col("share") * F.col("total")), F.col("capacity"))).otherwise(0).cast("long"))
    return plan.withColumn("epochs", F.when(present, F.floor(F.col("budget") / F.col("tokens"))).otherwise(0).cast("long")).withColumn("rest", F.when(present, F.col("budget") - F.col("epochs") * F.col("tokens")).otherwise(0).cast("long"))


def document_sizes(df: DataFrame, targets: DataFrame, tokenizer: str = DEFAULT_TOKENIZER) -> DataFrame:
    """Token counts of the documents of the wanted sources (doc_id, source, n_tokens).

    Exact: every such document is encoded. The result, three numbers a
    document, is kept in the checkpoint folder since three steps read it.
    """
    wanted = targets.where("source is not null and target_share > 0").select("source").distinct()
    docs = df.select("doc_id", "source", "text").join(wanted, "source", "left_semi")
    return cut_lineage(count_tokens(docs, ["doc_id", "source"], tokenizer=tokenizer))


def mix(sizes: DataFrame, plan: DataFrame, seed: int = 17, bucket_tokens: int = BUCKET_TOKENS) -> DataFrame:
    """Rows of the mixture: doc_id, source, epoch (from 1), n_tokens, take_tokens.

    ``take_tokens`` is below ``n_tokens`` only for the document on a source's
    cut. Documents without tokens are left out. Ties of the hash key go by
    doc_id; repeated rows of a document count as separate documents. More than
    MAX_TARGETS sources with a budget raise ValueError.
    """
    # xxhash64 of equal rows is equal; what else tells them apart is their place in the ordering, so ties are harmless
    keyed = sizes.where("n_tokens > 0").withColumn("key", F.xxhash64(F.lit(seed), "source", "doc_id"))
    wanted = plan.where("budget > 0").select("source", "tokens", "epochs", "rest")
    if wanted.limit(MAX_TARGETS + 1).count() > MAX_TARGETS:
        raise ValueError("too many mixture targets")
    keyed = keyed.join(F.broadcast(wanted), "source")
    buckets = F.greatest(F.lit(1), F.ceil(F.col("tokens") / bucket_tokens))
    keyed = keyed.withColumn("bucket", F.floor(_unit(F.col("key")) * buckets).cast("long")).withColumn("key", F.shiftrightunsigned("key", 11))
    sums = keyed.groupBy("source", "bucket").agg(F.sum("n_tokens").alias("bucket_sum"))
    before = W.partitionBy("source").orderBy("bucket").rowsBetween(W.unboundedPreceding, -1)
    sums = sums.withColumn("offset", F.coalesce(F.sum("bucket_sum").over(before), F.lit(0))).drop("bucket_sum")
    inside = W.partitionBy("source", "bucket").orderBy("key", "doc_id").rowsBetween(W.unboundedPreceding, -1)
    placed = (
        keyed.withColumn("ahead", F.coalesce(F.sum("n_tokens").over(inside), F.lit(0)))
        .join(sums, ["source", "bucket"])
        .withColumn("partial", F.greatest(F.lit(0), F.least(F.col("n_tokens"), F.col("rest") - F.col("ahead") - F.col("offset"))))
    )
    copies = F.col("epochs") + F.when(F.col("partial") > 0, 1).otherwise(0)
    return (
        placed.where(copies > 0)
        .withColumn("epoch", F.explode(F.sequence(F.lit(1).cast("long"), copies)))
        .select("doc_id", "source", F.col("epoch").cast("int").alias("epoch"), "n_tokens", F.when(F.col("epoch") <= F.col("epochs"), F.col("n_tokens")).otherwise(F.col("partial")).alias("take_tokens"))
    )


def reached_shares(mixture: DataFrame, plan: DataFrame) -> DataFrame:
    """Per target source: wanted and reached share, tokens, documents, epochs."""
    got = mixture.groupBy("source").agg(F.sum("take_tokens").alias("mixed_tokens"), F.count("*").alias("mixed_rows"), F.max("epoch").alias("most_repeats"))
    one = W.partitionBy(F.lit(1)).rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    out = plan.select("source", "target_share", "share", "max_repeats", "n_docs", "tokens", "budget").join(got, "source", "left").na.fill(0, ["mixed_tokens", "mixed_rows", "most_repeats"])
    return out.withColumn("reached_share", F.coalesce(F.try_divide("mixed_tokens", F.sum("mixed_tokens").over(one)), F.lit(0.0))).withColumnRenamed("share", "attainable_share")
