"""Benchmark decontamination with a positional inverted index of the training documents.

The index is two tables: ``postings`` (term, row, pos), one row per occurrence of a word, and
``texts`` (row, id, norm, n_words), the words of each document joined by single blanks, with
the number that its postings use. A phrase is looked up from its rarest words: the posting
lists of its ``ANCHORS`` rarest positions, each shifted back by the offset in the phrase, are
intersected; what is left is compared word by word. Only built-in functions are used.

Postings can be limited to a vocabulary, that of all test items: no other word is ever asked
for. The vocabulary is broadcast only where Spark finds it below its size threshold; else
the same join shuffles.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.window import Window

from leafmill.llm.tables import Workspace, fresh, text_key

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
BREAKS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
# Posting lists that are intersected before words are compared.
ANCHORS = 2


def words_of(text: Column) -> Column:
    """Words of a text: runs of digits, letters and characters beyond ASCII, A-Z lower-cased."""
    lower = F.translate(F.coalesce(text, F.lit("")), UPPER, UPPER.lower())
    return F.array_remove(F.split(lower, BREAKS), "")


@dataclass
class Index:
    texts: DataFrame
    postings: DataFrame
    work: Workspace


def build_index(
    docs: DataFrame,
    work: Workspace,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    vocabulary: DataFrame | None = None,
) -> Index:
    """Write the index of ``docs``; ``vocabulary`` (term) limits the postings to its terms."""
    words = words_of(F.col(text_col))
    texts = work.put(
        docs.select(
            F.monotonically_increasing_id().alias("row"),
            F.col(id_col).alias("id"),
            F.array_join(words, " ").alias("norm"),
        ).withColumn(
            "n_words",
            F.when(F.col("norm") == "", 0)
            .otherwise(1 + F.length("norm") - F.length(F.translate("norm", " ", "")))
            .cast("bigint"),
        ),
        "texts",
    )
    postings = texts.where("n_words > 0").select(
        "row", F.posexplode(F.split("norm", " ")).alias("pos", "term")
    )
    if vocabulary is not None:
        postings = postings.join(vocabulary, "term", "left_semi")
    return Index(texts, work.put(postings.select("term", "row", "pos"), "postings"), work)


def item_windows(items: DataFrame, width: int, *, id_col: str, text_col: str) -> DataFrame:
    """``item, phrase`` (words) of every run of ``width`` words; a shorter item is one run."""
    words = items.select(F.col(id_col).alias("item"), words_of(F.col(text_col)).alias("words"))
    last = F.greatest(F.size("words") - width, F.lit(0))
    return (
        words.where(F.size("words") > 0)
        .select("item", "words", F.explode(F.sequence(F.lit(0), last)).alias("first"))
        .select("item", F.slice("words", F.col("first") + 1, F.lit(width)).alias("phrase"))
        .distinct()
    )


def _phrases(windows: DataFrame, work: Workspace) -> DataFrame:
    """Distinct phrases, numbered by the table that is written."""
    phrases = windows.select("phrase").distinct()
    return work.put(
        phrases.select(
            F.monotonically_increasing_id().alias("number"),
            "phrase",
            F.size("phrase").alias("length"),
        ),
        "phrases",
    )


def _anchors(phrases: DataFrame, index: Index, count: int) -> DataFrame:
    """The ``count`` rarest positions of each phrase of which every word occurs in the index."""
    often = index.work.put(
        index.postings.groupBy("term").agg(F.count(F.lit(1)).alias("often")), "frequencies"
    )
    places = phrases.select("number", "length", F.posexplode("phrase").alias("offset", "term"))
    ranked = (
        places.join(often, "term")
        .withColumn(
            "rank",
            F.row_number().over(Window.partitionBy("number").orderBy("often", "offset")),
        )
        .withColumn("known", F.count(F.lit(1)).over(Window.partitionBy("number")))
    )
    return index.work.put(
        ranked.where(F.col("known") == F.col("length"))
        .where(F.col("rank") <= count)
        .select("term", "number", "length", "offset", F.least("length", F.lit(count)).alias("needed")),
        "anchors",
    )


def phrase_matches(phrases: DataFrame, index: Index) -> DataFrame:
    """Every occurrence of every phrase: ``row, start, number, length``.

    ``phrases`` are ``number, phrase, length``. The lists of the rarest positions are
    intersected by counting, for each place where the phrase would start, how many of them
    name it.
    """
    anchors = _anchors(phrases, index, ANCHORS)
    begun = (
        index.postings.join(anchors, "term")
        .withColumn("start", F.col("pos") - F.col("offset"))
        .where("start >= 0")
        .groupBy("row", "start", "number")
        .agg(F.count(F.lit(1)).alias("met"), F.max("needed").alias("needed"), F.max("length").alias("length"))
        .where("met = needed")
    )
    # One row per document, so that its words are split once; the list is its own matches.
    per_row = begun.groupBy("row").agg(
        F.collect_list(F.struct("start", "number", "length")).alias("places")
    )
    split = per_row.join(index.texts.select("row", "norm"), "row").select(
        "row", F.split("norm", " ").alias("words"), "places"
    )
    found = split.select("row", "words", F.inline("places")).select(
        "row",
        "start",
        "number",
        "length",
        F.slice("words", F.col("start") + 1, F.col("length")).alias("phrase"),
    )
    return found.join(phrases.select("number", "phrase"), ["number", "phrase"]).select(
        "row", "start", "number", "length"
    )


def proximity_matches(phrases: DataFrame, index: Index, slop: int) -> DataFrame:
    """Where all words of a phrase stand close together in any order: ``row, pos, number``.

    ``pos`` is an occurrence of the phrase's rarest word with every other word of it at most
    ``slop`` words away.
    """
    rarest = _anchors(phrases, index, 1).select("term", "number")
    near = index.postings.join(rarest, "term").groupBy("row").agg(
        F.collect_list(F.struct("pos", "number")).alias("places")
    )
    around = (
        near.join(index.texts.select("row", "norm"), "row")
        .select("row", F.split("norm", " ").alias("words"), "places")
        .select("row", "words", F.inline("places"))
        .select(
            "row",
            "pos",
            "number",
            F.slice(
                "words",
                F.greatest(F.col("pos") - slop, F.lit(0)) + 1,
                F.least(F.col("pos"), F.lit(slop)) + slop + 1,
            ).alias("around"),
        )
    )
    return (
        around.join(phrases.select("number", "phrase"), "number")
        .where(F.size(F.array_except("phrase", "around")) == 0)
        .select("row", "pos", "number")
    )


def contamination(
    docs: DataFrame,
    items: DataFrame,
    *,
    width: int = 10,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_id_col: str = "item_id",
    item_text_col: str = "text",
) -> DataFrame:
    """One row per document: its id, ``n_words, n_hit, items, contaminated``.

    ``n_hit`` counts the words inside any occurrence of any window of ``width`` words of an
    item (a shorter item is one window). ``items`` are the ids of the items with such windows
    as strings, sorted; an item without id hits words but is not named. Null texts have no
    words. Empty inputs give no hits.
    """
    work = Workspace(docs.sparkSession, "decontaminate")
    windows = work.put(
        item_windows(items, width, id_col=item_id_col, text_col=item_text_col), "windows"
    )
    phrases = _phrases(windows, work)
    vocabulary = work.put(
        phrases.select(F.explode("phrase").alias("term")).distinct(), "vocabulary"
    )
    index = build_index(docs, work, id_col=id_col, text_col=text_col, vocabulary=vocabulary)
    hits = work.put(phrase_matches(phrases, index), "hits")

    earlier = Window.partitionBy("row").orderBy("start", "length").rowsBetween(
        Window.unboundedPreceding, -1
    )
    end = F.col("start") + F.col("length")
    spans = hits.groupBy("row", "start").agg(F.max("length").alias("length"))
    covered = F.greatest(end - F.greatest("start", F.coalesce(F.max(end).over(earlier), "start")), F.lit(0))
    hit = (
        spans.withColumn("covered", covered)
        .groupBy("row")
        .agg(F.sum("covered").cast("bigint").alias("n_hit"))
    )
    named = (
        hits.select("row", "number").distinct()
        .join(phrases.select("number", "phrase"), "number")
        .join(windows, "phrase")
        .select("row", F.col("item").cast("string").alias("item"))
        .groupBy("row")
        .agg(F.array_sort(F.collect_set("item")).alias("items"))
    )
    counted = index.texts.select("row", "id", "n_words")
    result = work.put(
        counted.join(hit, "row", "left")
        .join(named, "row", "left")
        .select(
            F.col("id").alias(id_col),
            "n_words",
            F.coalesce("n_hit", F.lit(0)).cast("bigint").alias("n_hit"),
            F.coalesce("items", F.array().cast("array<string>")).alias("items"),
            F.coalesce(F.col("n_hit") > 0, F.lit(False)).alias("contaminated"),
        ),
        "documents",
    )
    work.drop(index.postings, index.texts, hits)
    return result


def without_contaminated(
    docs: DataFrame,
    items: DataFrame,
    *,
    width: int = 10,
    text_col: str = "text",
    item_id_col: str = "item_id",
    item_text_col: str = "text",
) -> DataFrame:
    """The rows of ``docs`` in which no window of a test item occurs, all columns as they are."""
    keyed = docs.select(text_key(F.col(text_col)).alias("key"), F.col(text_col).alias("text"))
    found = contamination(
        keyed, items, width=width, id_col="key", item_id_col=item_id_col, item_text_col=item_text_col
    )
    own = fresh("__text_key", docs.columns)
    bad = found.where("contaminated").select(F.col("key").alias(own)).distinct()
    marked = docs.withColumn(own, text_key(F.col(text_col)))
    return marked.join(bad, own, "left_anti").select(*docs.columns)
