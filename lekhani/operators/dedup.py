"""Exact and near-duplicate removal."""

from __future__ import annotations

from fractions import Fraction

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lekhani.session import cut_lineage

# Columns kept for deduplication.
PREDEDUP = ["doc_id", "url", "source", "language", "doc_lang", "doc_lang_iso", "text", "bytes", "words_count", "char_count", "lines_count", "mean_line_length", "min_line_length", "max_line_length", "nsfw_words_count", "non_li_char_count"]
SHINGLE, SIMILARITY = 5, 0.8
#: The similarity as a fraction, so that the bound is exact.
NUM, DEN = Fraction(str(SIMILARITY)).as_integer_ratio()
#: Documents on either side that are compared in one cell of a crowded shingle.
CELL = 256


def one_per_key(df: DataFrame, key: str, order: list | None = None) -> DataFrame:
    """The first row of every key in a given order; ties end in a hash of the whole
    row, so the survivor does not depend on partitioning. Every task keeps one row
    a key before the shuffle, so a key with very many rows does no harm."""
    whole = F.xxhash64(*[F.to_json(F.struct(c)) if "map<" in t else F.col(c) for c, t in df.dtypes])
    rank = F.row_number().over(W.partitionBy(key).orderBy(*(order or []), whole))
    return df.withColumn("_rank", rank).where("_rank = 1").drop("_rank")


def prededup(df: DataFrame) -> DataFrame:
    """The 16 columns that deduplication needs."""
    return df.select(*PREDEDUP)


def _words(text_col: str) -> Column:
    return F.filter(F.split(F.lower(text_col), r"\s+"), lambda w: w != "")


def _shared_shingles(texts: DataFrame, text_col: str) -> DataFrame:
    """(h, n, s) of the texts that can have a like one: n different shingles, of
    which s are those that other texts have too, rarest first."""
    grams = F.when(F.size("_w") >= SHINGLE, F.transform(F.sequence(F.lit(1), F.size("_w") - (SHINGLE - 1)), lambda i: F.xxhash64(F.slice("_w", i, SHINGLE)))).otherwise(F.array(F.xxhash64("_w")))
    rows = texts.select("h", _words(text_col).alias("_w")).select("h", F.array_distinct(grams).alias("_g")).select("h", F.size("_g").alias("n"), F.explode("_g").alias("g"))
    shared = rows.withColumn("df", F.count("*").over(W.partitionBy("g"))).where("df > 1")
    found = shared.groupBy("h").agg(F.first("n").alias("n"), F.sort_array(F.collect_list(F.struct("df", "g"))).alias("s"))
    return found.where(F.size("s") * DEN >= F.col("n") * NUM).select("h", "n", F.col("s.g").alias("s"))


def _near_enough(n: Column, m: Column, overlap: Column) -> Column:
    """overlap / union >= SIMILARITY for sets of n and m."""
    return overlap * (NUM + DEN) >= (n + m) * NUM


def _verified(pairs: DataFrame, docs: DataFrame) -> DataFrame:
    """The different pairs (a, b) whose shingles are alike enough."""
    a, b = (docs.select(F.col("h").alias(x), F.col("n").alias(f"n_{x}"), F.col("s").alias(f"s_{x}")) for x in "ab")
    both = pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct().join(a, "a").join(b, "b")
    return both.where(_near_enough(F.col("n_a"), F.col("n_b"), F.size(F.array_intersect("s_a", "s_b")))).select("a", "b")


def _crowded_pairs(prefix: DataFrame) -> DataFrame:
    """All pairs (a, b) of different labels that share a prefix shingle and may be alike.

    A shingle's documents outside its largest label meet all the others, in
    cells of about CELL by CELL documents, so that no task expands a hot shingle.
    """
    parts = lambda n: F.ceil(n / CELL).cast("int")
    by = prefix.groupBy("g", "label").agg(F.count("*").alias("c")).groupBy("g").agg(F.sum("c").alias("all"), F.max("c").alias("most"), F.max_by("label", F.struct("c", "label")).alias("big"))
    by = by.where("all > most").select("g", "big", parts(F.col("all") - F.col("most")).alias("few"), parts(F.col("all")).alias("many"))
    rows = prefix.join(by, "g")
    own = lambda n: F.pmod(F.xxhash64("h"), n).cast("int")
    upto = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    left = rows.where("label != big").select("g", own(F.col("few")).alias("x"), upto("many").alias("y"), F.col("h").alias("a"), F.col("n").alias("n_a"), F.col("rest").alias("rest_a"), F.col("label").alias("label_a"))
    right = rows.select("g", upto("few").alias("x"), own(F.col("many")).alias("y"), F.col("h").alias("b"), F.col("n").alias("n_b"), F.col("rest").alias("rest_b"), F.col("label").alias("label_b"), (F.col("label") == F.col("big")).alias("in_big"))
    return left.join(right, ["g", "x", "y"]).where("label_a != label_b and (in_big or a < b)").where(_near_enough(F.col("n_a"), F.col("n_b"), F.least("rest_a", "rest_b"))).select("a", "b")


def components(links: DataFrame) -> DataFrame:
    """(node, root): the least node that links (a, b) connect to each linked node.

    Hooking to the least neighbour until nothing changes; labels only fall, so
    this ends. Lineage is cut in the checkpoint folder.
    """
    both = cut_lineage(links.union(links.select("b", "a")).distinct())
    labels = both.select(F.col("a").alias("node"), F.col("a").alias("root")).distinct()
    changed = True
    while changed:
        least = both.join(labels.withColumnRenamed("node", "b"), "b").groupBy("a").agg(F.min("root").alias("near"))
        fresh = labels.join(least, labels["node"] == least["a"]).select("node", F.least("root", "near").alias("root"))
        # pointer jump: the root's own root
        jump = fresh.select(F.col("node").alias("root"), F.col("root").alias("top"))
        fresh = cut_lineage(fresh.join(jump, "root").select("node", F.col("top").alias("root")))
        changed = fresh.join(labels.withColumnRenamed("root", "old"), "node").where("root != old").limit(1).count()
        labels = fresh
    return labels


def drop_near_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of one document of each near-duplicate class, the one with the least id."""
    classes = near_duplicates(df, id_col, text_col).where(F.col("class_id") == F.col(id_col)).select(id_col)
    return df.join(classes, id_col, "left_semi")


def near_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, class_id): near-duplicate classes of documents; a document of its own is its own class.

    Two texts are linked if the Jaccard similarity of their sets of five-word
    shingles is 0.8 or more. The links are exact: texts of n shingles can only
    be that alike if they share one of the first n - ceil(0.8 n) + 1, whatever
    the common order; with the rarest first, what a template puts into many
    texts comes last. Copies are merged before. Neighbours by size in a
    shingle's list are compared first; then all pairs in it that these links
    do not connect yet. Classes are the connected components of the links.
    Null and blank texts are classes of their own.
    """
    ids = df.select(F.col(id_col).alias("id"), F.col(text_col).alias(text_col)).where("id is not null")
    signed = ids.where(F.col(text_col).isNotNull()).select("id", text_col, _words(text_col).alias("_w")).where(F.size("_w") > 0).select("id", text_col, F.xxhash64("_w").alias("h"))
    docs = cut_lineage(_shared_shingles(signed.select("h", text_col).dropDuplicates(["h"]), text_col))
    # rest: the shared shingles from this one on, a bound on what a pair can share whose first it is
    size, need = F.size("s"), F.expr(f"cast((n * {NUM} + {DEN - 1}) div {DEN} as int)")
    prefix = docs.select("h", "n", size.alias("_m"), F.posexplode(F.slice("s", F.lit(1), size - need + 1)).alias("_at", "g")).select("g", "h", "n", (F.col("_m") - F.col("_at")).alias("rest"))
    by_size = W.partitionBy("g").orderBy("n", "h")
    near = prefix.select(F.col("h").alias("a"), F.lag("h").over(by_size).alias("b"), "n", F.lag("n").over(by_size).alias("n_b"), F.least("rest", F.lag("rest").over(by_size)).alias("most"))
    first = cut_lineage(_verified(near.where(F.col("b").isNotNull() & _near_enough(F.col("n"), F.col("n_b"), F.col("most"))), docs))
    known = components(first).select(F.col("node").alias("h"), "root")
    labelled = prefix.join(known, "h", "left").select("g", "h", "n", "rest", F.coalesce("root", "h").alias("label"))
    second = cut_lineage(_verified(_crowded_pairs(labelled), docs))
    roots = components(first.union(second)).select(F.col("node").alias("h"), "root")
    members = signed.select("id", "h").distinct().join(roots, "h", "left").select("id", F.coalesce("root", "h").alias("root"))
    found = members.join(members.groupBy("root").agg(F.min("id").alias("class_id")), "root")
    return ids.select("id").distinct().join(found.groupBy("id").agg(F.min("class_id").alias("class_id")), "id", "left").select(F.col("id").alias(id_col), F.coalesce("class_id", "id").alias("class_id"))
