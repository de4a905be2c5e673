"""Known-equal values found in the data: fingerprints, then one typing error.

Values of a text column that differ only in case, marks, spacing, or the order
and repetition of words have one *fingerprint*: the sorted set of their words.
Fingerprints that are one edit apart (a letter more, less, or another one) are
linked, and linked ones belong together; a cluster's canonical value is the one
with the most rows.

Two texts one edit apart become equal when the right letter is left out of each.
So each fingerprint is joined on all texts that it gives with one letter left
out, and with itself; a join key holds at most the texts that one more letter
can make of it, however many values there are. Candidate pairs are verified by
their edit distance. Only distinct values are looked at, with their counts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillroll.session import ensure_checkpoint_dir

#: Fingerprints with fewer letters stand for themselves: most short texts are one edit apart.
#: Longer ones than the second number are no names; equal fingerprints are still one value.
NEAR_FROM, NEAR_TO = 5, 80


def fingerprint(c: str | Column) -> Column:
    """The distinct words of a text in order, in lower case; NULL if it has none."""
    col = F.col(c) if isinstance(c, str) else c
    words = F.split(F.regexp_replace(F.lower(col), r"[^\p{L}\p{N}]+", " "), " ")
    text = F.array_join(F.array_sort(F.array_distinct(F.array_remove(words, ""))), " ")
    return F.when(text != "", text)


def one_edit_apart(prints: DataFrame, col: str = "print") -> DataFrame:
    """(a, b), a < b: the pairs of distinct texts of ``col`` with edit distance 1."""
    length = F.length(col)
    without = F.transform(F.sequence(F.lit(1), length), lambda i: F.concat(F.substring(col, F.lit(1), i - 1), F.substring(col, i + 1, length)))
    keys = F.array_distinct(F.concat(F.array(F.col(col)), without))
    each = prints.where(length.between(NEAR_FROM, NEAR_TO)).select(F.col(col).alias("text"), F.explode(keys).alias("key"))
    shared = each.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("key")
    some = each.join(shared, "key", "left_semi")
    pairs = some.select("key", F.col("text").alias("a")).join(some.select("key", F.col("text").alias("b")), "key").where("a < b")
    return pairs.select("a", "b").distinct().where(F.levenshtein("a", "b") == 1)


def connected(edges: DataFrame) -> DataFrame:
    """(text, top) of every end of the edges (a, b): the smallest text that it is connected with.

    Each round takes the smallest label around a text and then that label's own,
    so chains shorten to half in a round. Rounds are checkpointed; only whether
    a label has changed reaches the driver.
    """
    ensure_checkpoint_dir(edges.sparkSession)
    both = edges.select("a", "b").unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).checkpoint()
    labels = both.groupBy(F.col("a").alias("text")).agg(F.least(F.min("b"), F.first("a")).alias("top"))
    while True:
        labels = labels.checkpoint()
        around = both.join(labels, both["b"] == labels["text"]).groupBy(F.col("a").alias("near_of")).agg(F.min("top").alias("near"))
        nearer = labels.join(around, labels["text"] == around["near_of"]).select("text", F.col("top").alias("before"), F.least("top", "near").alias("top"))
        up = labels.select(F.col("text").alias("of"), F.col("top").alias("above"))
        stepped = nearer.join(up, nearer["top"] == up["of"]).select("text", "before", F.least("top", "above").alias("top")).checkpoint()
        labels = stepped.select("text", "top")
        if not stepped.where("top <> before").take(1):
            return labels


def value_clusters(df: DataFrame, col: str, rows: str = "rows") -> DataFrame:
    """(``col``, canonical, ``rows``): every value of a text column, the value
    that stands for its cluster, and its number of rows.

    The canonical value has the most rows, then is the smallest. NULL and values
    without a word stand for themselves.
    """
    values = df.groupBy(col).agg(F.count(F.lit(1)).alias(rows)).withColumn("_print", fingerprint(col)).checkpoint()
    prints = values.where("_print is not null").select(F.col("_print").alias("print")).distinct()
    tops = connected(one_edit_apart(prints))
    placed = values.join(tops, values["_print"] == tops["text"], "left").withColumn("_cluster", F.coalesce("top", "_print"))
    # The most rows first, then the smallest value.
    best = placed.where("_cluster is not null").groupBy(F.col("_cluster").alias("_c")).agg(F.max(rows).alias("_most"))
    most = (F.col("_cluster") == F.col("_c")) & (F.col(rows) == F.col("_most"))
    chosen = placed.join(best, most).groupBy("_c").agg(F.min(col).alias("canonical"))
    joined = placed.join(chosen, placed["_cluster"] == chosen["_c"], "left")
    return joined.select(col, F.coalesce("canonical", col).alias("canonical"), rows)


def canonical_values(df: DataFrame, col: str, out_col: str | None = None) -> DataFrame:
    """``df`` with the canonical value of ``col`` in its place (or in ``out_col``)."""
    found = value_clusters(df, col).select(F.col(col).alias("_value"), F.col("canonical").alias("_canonical"))
    joined = df.join(found, df[col] == found["_value"], "left")
    return joined.withColumn(out_col or col, F.col("_canonical")).drop("_value", "_canonical")
