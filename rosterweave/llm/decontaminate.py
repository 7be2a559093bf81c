"""Benchmark passages in training documents, found in a positional inverted index.

The index holds where each term of the test items stands in each document: ``term, row, pos``, and
a posting of the empty term behind the last word, which gives the length of the document. A window
of test words is looked up from its rarest term: every posting of that term proposes one place,
and the postings of the other terms, moved back by their offsets, must be at that place too.

All of it is DataFrame operations. The index is stored in the shared folder and read by every
later step, so texts are split once.
"""

from __future__ import annotations

import string
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rosterweave.llm.common import numbered, text_mark
from rosterweave.plans.staging import Stage

WINDOW = 10
#: Code points that are no part of a word, once A-Z are lower-cased.
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: Tables of up to so many rows (of a term or a number each) are broadcast; larger ones shuffle.
BROADCAST_ROWS = 500_000


def words(text: str | Column) -> Column:
    """Words of the whole text with A-Z lower-cased; null has none."""
    lowered = F.translate(
        F.coalesce(text, F.lit("")), string.ascii_uppercase, string.ascii_lowercase
    )
    return F.array_remove(F.split(lowered, SEPARATORS), "")


def _small(df: DataFrame) -> DataFrame:
    """``df`` with a broadcast hint if its counted rows allow it; it should be a stored table."""
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


@dataclass(frozen=True)
class Index:
    """``postings (term, row, pos)`` of the wanted terms; ``documents (row, doc_id, mark, n_words)``."""

    postings: DataFrame
    documents: DataFrame


def build_index(docs: DataFrame, terms: DataFrame, stage: Stage) -> Index:
    """Index of the whole texts of ``docs (doc_id, text)`` for ``terms (term)``, all distinct."""
    wanted = _small(stage(terms.union(terms.sparkSession.sql("select '' as term")), "terms"))
    spots = F.posexplode(F.array_append(words("text"), "")).alias("pos", "term")
    placed = numbered(docs, "doc_id", "text").select("row", "doc_id", text_mark(), spots)
    placed = placed.join(wanted, "term")
    of_length = F.col("term") == ""
    stored = stage(
        placed.select(
            "term", "row", "pos", *[F.when(of_length, F.col(c)).alias(c) for c in ("doc_id", "mark")]
        ),
        "postings",
    )
    return Index(
        stored.where(~of_length).select("term", "row", "pos"),
        stored.where(of_length).select("row", "doc_id", "mark", F.col("pos").alias("n_words")),
    )


def item_windows(items: DataFrame, width: int = WINDOW) -> DataFrame:
    """``item_id, window, terms``: all runs of ``width`` words; shorter items are one window."""
    split = items.select("item_id", words("text").alias("w")).where(F.size("w") > 0)
    starts = F.sequence(F.lit(1), F.greatest(F.size("w") - width + 1, F.lit(1)))
    cut = split.select("item_id", "w", F.explode(starts).alias("i"))
    terms = F.slice("w", F.col("i"), F.least(F.size("w"), F.lit(width)))
    return cut.select("item_id", F.array_join(terms, " ").alias("window"), terms.alias("terms"))


def phrase_matches(
    index: Index, windows: DataFrame, stage: Stage, slack: int = 0
) -> DataFrame:
    """``window, row, start, length``: each place where a window occurs.

    ``windows (window, terms)`` are distinct. With ``slack`` 0 its terms stand one behind the
    other (phrases). Otherwise each may be up to ``slack`` words off its place relative to the
    rarest term, and ``start`` is where the rarest term would have the window begin (proximity).
    """
    counts = index.postings.groupBy("term").agg(F.count("*").alias("n"))
    spelled = windows.select(
        "window", F.size("terms").alias("length"), F.posexplode("terms").alias("offset", "term")
    )
    # The inner join drops terms the documents lack, and with them the windows they are part of.
    ranked = spelled.join(counts, "term").withColumns(
        {
            "known": F.count("*").over(Window.partitionBy("window")),
            "rank": F.row_number().over(Window.partitionBy("window").orderBy("n", "offset")),
        }
    )
    ranked = stage(ranked.where("known = length").drop("known", "n"), "ranked_terms")
    rarest = _small(ranked.where("rank = 1").select("term", "window", "length", "offset"))
    proposed = (
        index.postings.join(rarest, "term")
        .withColumn("start", F.col("pos") - F.col("offset"))
        .where("start >= 0")
        .select("window", "length", "row", "start")
    )
    proposed = stage(proposed, "proposed_places")
    near = index.postings.join(_small(proposed.select("row").distinct()), "row", "left_semi")
    near = near.withColumnsRenamed({"term": "t", "row": "r", "pos": "p"})
    others = ranked.where("rank > 1").select("window", "offset", "term")
    asked = proposed.join(others, "window").withColumn("at", F.col("start") + F.col("offset"))
    on = (F.col("t") == F.col("term")) & (F.col("r") == F.col("row"))
    if slack:
        on = on & F.col("p").between(F.col("at") - slack, F.col("at") + slack)
    else:
        on = on & (F.col("p") == F.col("at"))
    found = asked.join(near, on, "left_semi")
    place = ["window", "length", "row", "start"]
    kept = found.groupBy(*place).agg(F.count("*").alias("n")).where("n = length - 1").drop("n")
    return kept.union(proposed.where("length = 1").select(*place)).select(
        "window", "row", "start", "length"
    )


def contamination(
    docs: DataFrame, items: DataFrame, stage: Stage, width: int = WINDOW
) -> DataFrame:
    """``doc_id, mark, n_words, n_hit, items, contaminated`` per row of ``docs (doc_id, text, ...)``.

    ``n_hit`` counts the words inside any occurrence of a window of ``items (item_id, text)``;
    ``items`` are the ids, as strings in order, of those with windows that occur. Null texts and
    texts without words have no words and no hits; items without words have no window. Equal ids
    of items are one item; an item with a null id marks words but is not listed. Repeated rows
    and null doc_ids keep a row each. Other columns are not looked at.
    """
    windows = stage(item_windows(items, width), "windows")
    terms = windows.select(F.explode("terms").alias("term")).distinct()
    index = build_index(docs, terms, stage)
    one_each = windows.select("window", "terms").dropDuplicates(["window"])
    matches = stage(phrase_matches(index, one_each, stage), "matches")
    spots = F.explode(F.sequence("start", F.col("start") + F.col("length") - 1)).alias("pos")
    hits = matches.select("row", "start", "length").distinct().select("row", spots)
    hits = hits.distinct().groupBy("row").agg(F.count("*").alias("n_hit"))
    names = matches.select("window", "row").distinct().join(
        windows.select("window", "item_id").distinct(), "window"
    )
    listed = F.sort_array(F.collect_set(F.col("item_id").cast("string"))).alias("items")
    names = names.groupBy("row").agg(listed)
    none = F.array().cast("array<string>")
    return (
        index.documents.join(hits, "row", "left")
        .join(names, "row", "left")
        .select(
            "doc_id",
            "mark",
            F.col("n_words").cast("long").alias("n_words"),
            F.coalesce("n_hit", F.lit(0).cast("long")).alias("n_hit"),
            F.coalesce("items", none).alias("items"),
            F.col("n_hit").isNotNull().alias("contaminated"),
        )
    )
