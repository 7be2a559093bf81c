"""Bounded samples of labelled documents, the one thing here that is fitted on the driver."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rosterweave.plans.staging import Stage

#: Texts longer than this are scored like any other, but not sampled to learn from.
SAMPLED_CHARS = 1 << 20


def remainder(doc_id: str | Column, divisor: int) -> Column:
    """crc32 of the id as text, modulo ``divisor``; null for a null id."""
    return F.crc32(F.col(doc_id).cast("string")) % divisor


def labelled_sample(
    docs: DataFrame, labels: DataFrame, learn: Column, most: dict[int, int], stage: Stage
) -> DataFrame:
    """``text, label, weight`` of up to ``most[label]`` rows per label, stored.

    ``weight`` is how many learnable labels a row stands for: the number of its label in the whole
    table over the number taken, so weighted shares are those of the table however large it is.

    ``labels`` has ``doc_id, label``; rows count where ``learn`` is true. Rows are taken by a hash
    of the id, so they are spread over the table and the same in every run. A document with two
    labels is taken for its larger one.
    """
    ids = labels.where(learn & F.col("doc_id").isNotNull()).groupBy("doc_id")
    ids = ids.agg(F.max("label").alias("label"))
    count = dict(ids.where(F.col("label").isin(*most)).groupBy("label").count().collect())
    parts = [
        ids.where(F.col("label") == label).orderBy(F.xxhash64("doc_id"), "doc_id").limit(n)
        .withColumn("weight", F.lit(max(count.get(label, 0) / n, 1.0)))
        for label, n in most.items()
    ]
    taken = parts[0]
    for part in parts[1:]:
        taken = taken.union(part)
    # At most sum(most) rows of three numbers.
    chosen = docs.select("doc_id", "text").join(F.broadcast(taken), "doc_id")
    short = chosen.where(F.length(F.coalesce("text", F.lit(""))) <= SAMPLED_CHARS)
    # Of a repeated id the text with the least hash, so that every run learns from the same.
    first = F.min(F.struct(F.xxhash64("text").alias("h"), "text", "label", "weight")).alias("first")
    one = short.groupBy("doc_id").agg(first).select("doc_id", "first.text", "first.label", "first.weight")
    return stage(one, "sample")
