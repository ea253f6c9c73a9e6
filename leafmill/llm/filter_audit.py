"""How filters interact: who removes what in every order, from one table of failing ids each.

Every filter gets a table of the documents that fail it. A prefix is the set of filters that come
before a filter in some order. What the filter removes after that prefix is its table without what
any table of the prefix holds (left-anti join); what it fails although the prefix has removed it
already is the rest (left-semi join). Both joins run once for all prefixes: a failing id carries the
prefixes it is asked for, which are added after the shuffle, and the join's condition compares them
with the filter of the other side. Counts are taken before anything moves again. Texts are read
once; joins see ids alone.
"""

from __future__ import annotations

import itertools
import math

from pyspark.sql import Column, DataFrame, functions as F

from leafmill.llm.tables import Workspace, row_key, text_key
from leafmill.operators.shaping import once

FILTERS = "ABCDE"
LEAST_WORDS = 50
LEAST_DISTINCT_PERCENT = 65
MOST_CAPITALS_PERCENT = 5
SYMBOLS = "[#$%&*|]"
COUNTS = ("removed", "redundant", "good_lost", "toxic_lost")


def failures(text: Column) -> dict[str, Column]:
    """Whether a text fails filters A to D; A and B count words, C characters, D looks for one."""
    words = F.array_remove(F.split(text, "[\\t-\\r ]+", -1), "")
    return {
        "A": F.size(words) < LEAST_WORDS,
        "B": 100 * F.size(F.array_distinct(words)) < LEAST_DISTINCT_PERCENT * F.size(words),
        "C": 100 * F.regexp_count(text, F.lit("[A-Z]")).cast("bigint")
        > MOST_CAPITALS_PERCENT * F.length(text).cast("bigint"),
        "D": F.rlike(text, F.lit(SYMBOLS)),
    }


def prefixes(name: str) -> list[int]:
    """The sets of other filters that may come before one, as sums of 1, 2, 4, ... by filter."""
    own = 1 << FILTERS.index(name)
    return [s for s in range(1 << len(FILTERS)) if not s & own]


def _code(name: str, prefix: int) -> int:
    return FILTERS.index(name) << len(FILTERS) | prefix


def _orders() -> list[tuple[str, int, list[int]]]:
    """Every order and step with the codes of its filters and prefixes up to that step."""
    out = []
    for order in itertools.permutations(FILTERS):
        codes, prefix = [], 0
        for step, name in enumerate(order, 1):
            codes.append(_code(name, prefix))
            prefix |= 1 << FILTERS.index(name)
            out.append(("".join(order), step, list(codes)))
    return out


def _labels(labels: DataFrame, id_col: str) -> DataFrame:
    """One row per labelled id: whether some row calls it good, and toxic."""

    def some(column: str) -> Column:
        return F.coalesce(F.bool_or(F.col(column) == 1), F.lit(False))

    named = labels.where(F.col(id_col).isNotNull())
    return named.groupBy(F.col(id_col).alias("label_id")).agg(
        some("quality").alias("good"), some("toxic").alias("toxic")
    )


def failing_ids(
    docs: DataFrame, labels: DataFrame, work: Workspace, id_col: str, text_col: str, part_col: str
) -> tuple[DataFrame, dict[str, DataFrame]]:
    """Rows per part, and for each filter ``(key, part, good, toxic, many)`` of what fails it.

    The key names a document by id and text, as ids may repeat; rows alike in all of it are
    counted in ``many``.
    """
    text = F.coalesce(text_col, F.lit(""))
    named = docs.select(
        F.col(id_col).alias("id"),
        F.coalesce(F.col(part_col).cast("string"), F.lit("")).alias("part"),
        text.alias("text"),
    )
    found = once(
        named, key=row_key(F.col("id"), F.col("text")), same=text_key(F.col("text")), **failures(F.col("text"))
    )
    facts = work.put(found.drop("text"), "facts")
    # Of equal texts those with an id above the smallest fail; a null id is above all others.
    firsts = work.put(
        facts.groupBy(F.col("same").alias("first_same"))
        .agg(F.min("id").alias("first"), F.count(F.lit(1)).alias("rows"))
        .where("rows > 1 AND first IS NOT NULL")
        .drop("rows"),
        "firsts",
    )
    labelled = work.put(_labels(labels, id_col), "labels")
    later = F.col("first").isNotNull() & (F.col("id").isNull() | (F.col("id") > F.col("first")))
    flagged = (
        facts.join(firsts, F.col("same") == F.col("first_same"), "left")
        .select("id", "part", "key", *"ABCD", F.coalesce(later, F.lit(False)).alias("E"))
        .join(labelled, F.col("id") == F.col("label_id"), "left")
    )
    listed = F.filter(
        F.array(*[F.when(F.col(name), F.lit(name)) for name in FILTERS]), lambda x: x.isNotNull()
    )
    failing = work.put(
        flagged.select(
            "key",
            "part",
            F.coalesce("good", F.lit(False)).alias("good"),
            F.coalesce("toxic", F.lit(False)).alias("toxic"),
            F.explode(listed).alias("filter"),
        )
        .groupBy("key", "part", "good", "toxic", "filter")
        .agg(F.count(F.lit(1)).alias("many")),
        "failing",
    )
    tables = {
        name: work.put(failing.where(F.col("filter") == name).drop("filter"), f"failing-{name}")
        for name in FILTERS
    }
    parts = work.put(facts.groupBy("part").agg(F.count(F.lit(1)).alias("rows")), "parts")
    work.drop(facts, firsts, labelled, failing)
    return parts, tables


def prefix_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """``(part, code, *COUNTS)`` for every prefix and filter with failing documents."""
    asked = None
    others = None
    for name, table in tables.items():
        own = table.withColumn("filter", F.lit(name))
        asked = own if asked is None else asked.unionAll(own)
        bit = F.lit(1 << FILTERS.index(name)).alias("bit")
        ids = table.select(F.col("key").alias("other"), bit)
        others = ids if others is None else others.unionAll(ids)
    by_filter = F.create_map(
        *[x for name in FILTERS for x in (F.lit(name), F.array(*map(F.lit, prefixes(name))))]
    )
    codes = F.create_map(*[x for name in FILTERS for x in (F.lit(name), F.lit(_code(name, 0)))])
    # Every row is dealt by key first; only then it takes its sixteen prefixes.
    partitions = int(asked.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    asked = asked.repartition(partitions, "key").select(
        "key", "part", "good", "toxic", "many",
        codes[F.col("filter")].alias("code"),
        F.explode(by_filter[F.col("filter")]).alias("prefix"),
    )
    others = others.distinct()
    met = (F.col("key") == F.col("other")) & (F.col("prefix").bitwiseAND(F.col("bit")) != 0)

    def counted(rows: DataFrame, **sums: Column) -> DataFrame:
        return rows.groupBy("part", (F.col("code") + F.col("prefix")).alias("code")).agg(
            *[F.sum(sums.get(c, F.lit(0))).cast("bigint").alias(c) for c in COUNTS]
        )

    many = F.col("many")
    removed = counted(
        asked.join(others, met, "left_anti"),
        removed=many,
        good_lost=F.when(F.col("good"), many).otherwise(0),
        toxic_lost=F.when(F.col("toxic"), many).otherwise(0),
    )
    return removed.unionAll(counted(asked.join(others, met, "left_semi"), redundant=many))


def filter_audit(
    docs: DataFrame,
    labels: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    part_col: str = "source",
) -> DataFrame:
    """One row per part, order of the five filters and step: what the step's filter does.

    ``kept`` documents are left after the step, ``removed`` go here, ``redundant`` ones fail the
    filter but went earlier, ``unique_fails`` fail it alone, ``good_lost`` and ``toxic_lost`` go here
    and are labelled so, ``shapley`` is what the filter removes in all 120 orders together. Filters:
    A under 50 words; B few distinct words; C many capitals; D a symbol; E a text that a smaller id
    has. A null text is empty, a null part ''. A null id is larger than any other and has no label;
    rows alike in id and text are told apart from no smaller id and count each. An id with several
    labels has all of them. No documents give no rows. Other columns play no part.
    """
    work = Workspace(docs.sparkSession, "audit")
    parts, tables = failing_ids(docs, labels, work, id_col, text_col, part_col)
    counts = work.put(prefix_counts(tables), "counts")
    grid = F.array(*[F.lit(_code(name, s)) for name in FILTERS for s in prefixes(name)])
    zeros = parts.select("part", F.explode(grid).alias("code"), *[F.lit(0).cast("bigint").alias(c) for c in COUNTS])
    summed = zeros.unionAll(counts).groupBy("part", "code").agg(*[F.sum(c).alias(c) for c in COUNTS])
    by_part = work.put(
        summed.groupBy(F.col("part").alias("of"))
        .agg(F.map_from_entries(F.collect_list(F.struct("code", F.struct(*COUNTS)))).alias("at"))
        .join(parts, F.col("of") == F.col("part"))
        .select("part", "rows", "at"),
        "by-part",
    )
    work.drop(counts, *tables.values())
    steps = F.array(
        *[
            F.struct(F.lit(order).alias("filter_order"), F.lit(step).alias("step"), F.array(*map(F.lit, codes)).alias("codes"))
            for order, step, codes in _orders()
        ]
    )
    rows = by_part.select(
        "part", "rows", "at", _by_filter(_alone).alias("alone"), _by_filter(_in_all_orders).alias("shares"), F.inline(steps)
    )
    now = F.element_at("at", F.element_at("codes", -1))
    gone = F.aggregate("codes", F.lit(0).cast("bigint"), lambda total, code: total + F.element_at("at", code)["removed"])
    name = F.substring(F.col("filter_order"), F.col("step"), F.lit(1))
    return rows.select(
        "part",
        "filter_order",
        "step",
        (F.col("rows") - gone).alias("kept"),
        *[now[c].alias(c) for c in ("removed", "redundant")],
        F.element_at("alone", name).alias("unique_fails"),
        *[now[c].alias(c) for c in ("good_lost", "toxic_lost")],
        F.element_at("shares", name).alias("shapley"),
    )


def _removed(name: str, prefix: int) -> Column:
    return F.element_at("at", F.lit(_code(name, prefix)))["removed"]


def _alone(name: str) -> Column:
    return _removed(name, max(prefixes(name)))


def _in_all_orders(name: str) -> Column:
    """Removals over all orders: a prefix of n filters comes first in n! (4 - n)! of them."""
    total = F.lit(0).cast("bigint")
    for prefix in prefixes(name):
        n = prefix.bit_count()
        total = total + _removed(name, prefix) * (math.factorial(n) * math.factorial(len(FILTERS) - 1 - n))
    return total


def _by_filter(value) -> Column:
    return F.create_map(*[x for name in FILTERS for x in (F.lit(name), value(name))])
