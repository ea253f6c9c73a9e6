"""Stage 2: text to structured answers."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from contextlib import nullcontext
from typing import Any

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from leafmill.functions.answers import (
    json_schema_of,
    marked_json,
    object_json,
    rule_answer,
    violations_of,
)
from leafmill.functions.text import has_text
from leafmill.operators.shaping import error_text, once, plain_text, stored
from leafmill.schemas import ANSWER, PROMPT_MESSAGES, restrict_struct
from leafmill.settings import DUPLICATE_KEYS, shared_dir

EMPTY = "empty content"

Extractor = Callable[[list[dict[str, str]]], str]
BatchExtractor = Callable[[list[list[dict[str, str]]]], Sequence[str | None]]

# Column in which the typed reader puts an answer that does not fit its schema.
CORRUPT = "_corrupt_answer"


def filter_empty(df: DataFrame, content: str = "content") -> tuple[DataFrame, DataFrame]:
    """Documents with text, and those without (NULL or ''), the latter with an ``error``.

    Text of blanks only counts as text.
    """
    kept = has_text(F.col(content))
    return df.where(kept), df.where(~kept).withColumn("error", F.lit(EMPTY))


def render_prompts(
    df: DataFrame,
    messages: Sequence[Mapping[str, str]] = PROMPT_MESSAGES,
    content: str = "content",
    url: str | None = None,
) -> DataFrame:
    """Add ``messages``, the chat messages with ``{text}`` filled in the user's ones.

    The marker is replaced literally and once through, so markers inside a document
    stay. ``{url}`` stays too unless a column for it is named. A document without text
    has no messages (NULL).
    """
    rendered = []
    for message in messages:
        body = F.lit(message["content"])
        if message["role"] == "user":
            # The url goes in first, so that a marker inside a document is left alone.
            if url is not None:
                body = F.replace(body, F.lit("{url}"), F.col(url))
            body = F.replace(body, F.lit("{text}"), F.col(content))
        rendered.append(F.struct(F.lit(message["role"]).alias("role"), body.alias("content")))
    return df.withColumn("messages", F.when(has_text(F.col(content)), F.array(*rendered)))


def project_fields(
    df: DataFrame, column: str, schema: T.StructType, fields: Sequence[str] | None = None
) -> DataFrame:
    """Keep the requested fields of a struct column, in the requested order.

    Unknown fields are ignored; no fields means all of the schema's.
    """
    kept = restrict_struct(schema, fields).names
    return df.withColumn(
        column, F.struct(*[F.col(f"`{column}`.`{name}`").alias(name) for name in kept])
    )


def run_extractor(
    df: DataFrame,
    extractor: Extractor | BatchExtractor | None = None,
    *,
    setup: Callable[[], Extractor | BatchExtractor] | None = None,
    id_col: str = "document_id",
    content: str = "content",
    carry: Sequence[str] = (),
    batch_size: int = 0,
    in_flight: int = 1,
) -> DataFrame:
    """One answer per document: ``(id, *carry, response, error)``.

    Give ``extractor``, a function from a document's ``messages`` to answer text, or
    ``setup``, which builds one and is called once per partition (to open a client or
    load a model there). An answer is text or None. A call that raises, or answers with
    anything else, sets ``error`` for its document only, and a document without text is
    refused without a call. Calls run where their documents are read: for more tasks, read
    the stored documents with a smaller ``spark.sql.files.maxPartitionBytes``. Answers are
    costly: write the result before using it twice.

    With ``batch_size`` the function gets lists of up to so many documents' messages and returns
    as many answers, in order. A batch that raises, or answers with another number, is halved and
    asked again, until the documents that fail are alone and the others have their answers; a bad
    one among n costs at most 2 * log2(n) more calls. Up to ``in_flight`` calls of a task run at
    once, in threads, so the function must then be safe for that.

    With neither, the fixed rules of ``rule_answer`` run as plain expressions.
    """
    if extractor is None and setup is None:
        usable = has_text(F.col(content))
        answers = once(df, response=F.when(usable, rule_answer(F.col(content))))
        return answers.select(
            id_col, *carry, "response", F.when(~usable, F.lit(EMPTY)).alias("error")
        )
    asked = df.select(id_col, *carry, "messages")
    kept = [asked.schema[name] for name in (id_col, *carry)]
    schema = T.StructType(
        [
            *kept,
            T.StructField("response", T.StringType()),
            T.StructField("error", T.StringType()),
        ]
    )

    def checked(response: object) -> str | None:
        if response is not None:
            if not isinstance(response, str):
                raise TypeError(f"an answer is text, not {type(response).__name__}")
            plain_text(response)
        return response

    def ask_each(ask: Callable, messages: list) -> list[tuple[str | None, str | None]]:
        """``(response, error)`` of each; one bad document must not stop the others."""
        if not batch_size:
            try:
                return [(checked(ask(messages[0])), None)]
            except Exception as problem:
                return [(None, error_text(problem))]
        try:
            responses = list(ask(messages))
            if len(responses) != len(messages):
                raise ValueError(f"{len(responses)} answers to {len(messages)} documents")
        except Exception as problem:
            if len(messages) == 1:
                return [(None, error_text(problem))]
            half = len(messages) // 2
            return ask_each(ask, messages[:half]) + ask_each(ask, messages[half:])
        out = []
        for response in responses:
            try:
                out.append((checked(response), None))
            except Exception as problem:
                out.append((None, error_text(problem)))
        return out

    def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ask = setup() if setup is not None else extractor
        size = batch_size or 1
        with ThreadPoolExecutor(in_flight) if in_flight > 1 else nullcontext() as pool:
            for batch in batches:
                column = batch.column(batch.num_columns - 1)
                told = [i for i in range(batch.num_rows) if column[i].is_valid]
                parts = [told[i : i + size] for i in range(0, len(told), size)]
                # Messages are taken out of Arrow only when their call is next.
                calls = (pool.map if pool else map)(
                    lambda part, column=column: ask_each(ask, [column[i].as_py() for i in part]), parts
                )
                responses: list[str | None] = [None] * batch.num_rows
                errors: list[str | None] = [EMPTY] * batch.num_rows
                for part, answers in zip(parts, calls, strict=True):
                    for i, (responses[i], errors[i]) in zip(part, answers, strict=True):
                        pass
                # The other columns stay in Arrow, whatever their types.
                yield pa.record_batch(
                    [
                        *batch.columns[:-1],
                        pa.array(responses, pa.string()),
                        pa.array(errors, pa.string()),
                    ],
                    names=schema.names,
                )

    return asked.mapInArrow(answer, schema)


def parse_responses(
    df: DataFrame, schema: T.StructType | str | None = None, response: str = "response"
) -> DataFrame:
    """Decode JSON answers: adds ``answer`` (VARIANT) and fills ``error``.

    An answer must be one whole JSON object; anything else leaves ``answer`` NULL with
    the reason in ``error``. Of a repeated key the last value counts, in every session: the
    setting on which that depends is put in place here. With a ``schema``, ``typed`` holds the
    answer as that struct too (missing and null fields are then alike), and ``corrupt`` the text
    of an answer that is an object but has a value which does not fit the schema; such a value is
    NULL in ``typed``.
    """
    df.sparkSession.conf.set(DUPLICATE_KEYS, "true")
    text = F.col(response)
    earlier = F.col("error") if "error" in df.columns else F.lit(None).cast("string")
    marked = once(df, _marked=marked_json(text))
    parsed = once(marked, answer=object_json(text, F.col("_marked"))).withColumn(
        "error",
        F.when(earlier.isNotNull(), earlier)
        .when(text.isNull(), F.lit("no response"))
        .when(F.col("answer").isNull(), F.lit("not a JSON object")),
    ).drop("_marked")
    if schema is None:
        return parsed
    if isinstance(schema, str):
        schema = T.StructType.fromDDL(schema)
    if CORRUPT in schema.names:
        raise ValueError(f"{CORRUPT} is the name of the column for what does not fit")
    read = F.from_json(
        text,
        T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())]),
        {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT},
    )
    # What is no object has no typed form either, whatever the more lenient reader makes of it.
    decoded = once(parsed, _typed=F.when(F.col("answer").isNotNull(), read))
    typed = F.struct(*[F.col(f"_typed.`{name}`").alias(name) for name in schema.names])
    return decoded.withColumns(
        {
            "typed": F.when(F.col("answer").isNotNull(), typed),
            "corrupt": F.col(f"_typed.{CORRUPT}"),
        }
    ).drop("_typed")


def validate_records(
    df: DataFrame,
    schema: T.StructType | Mapping[str, Any] = ANSWER,
    *,
    answer: str = "answer",
    extra_allowed: bool = False,
) -> DataFrame:
    """Add ``violations``, the list of ways in which an answer breaks its schema, at any depth.

    Entries read ``missing:o.x``, ``type:l[].y``, ``extra:o.z`` and ``enum:f``; see
    ``violations_of``. A struct's non-nullable fields are required and its nullable ones may be
    null. A JSON Schema, given as a mapping, is followed as it is: unions, listed values, and for
    each object whether other properties are allowed. No row is dropped; rows without an answer
    have NULL.
    """
    if isinstance(schema, T.StructType):
        schema = json_schema_of(schema, extra_allowed=extra_allowed)
    value = F.col(answer)
    return df.withColumn("violations", F.when(value.isNotNull(), violations_of(value, schema)))


def keep_last(df: DataFrame, key: str, order: str, *, tie: Sequence[str] = ()) -> DataFrame:
    """For each key (NULL is one) the one row with the highest ``order``; a NULL order is lowest.

    Of rows with equal order the one with the highest ``tie`` columns is kept, and of those still
    equal the one whose JSON text is highest; of identical rows one.

    Key and order alone are reduced first, when this is called, to the keys that repeat; these are
    stored. Rows of those keys with a lower order are then taken out by one anti-join: whole rows
    are neither sorted nor aggregated, and Spark moves none of them where the repeated keys are
    below ``spark.sql.autoBroadcastJoinThreshold``; else the join is shuffled, with skewed keys
    split. Only rows that tie for the last place are compared as a whole, and only if there are any.
    """
    spark = df.sparkSession
    last = F.max(F.struct("_order", "_rows"))
    repeated = stored(
        df.groupBy(F.col(key).alias("_key"), F.col(order).alias("_order"))
        .agg(F.count(F.lit(1)).alias("_rows"))
        .groupBy("_key")
        .agg(last.alias("_last"), F.sum("_rows").alias("_all"))
        .where("_all > 1")
        .select("_key", F.col("_last._order").alias("_last"), (F.col("_last._rows") > 1).alias("_tied")),
        shared_dir(spark, "last"),
    )
    same_key = F.col(key).eqNullSafe(F.col("_key"))
    lower = F.col("_last").isNotNull() & (F.col(order).isNull() | (F.col(order) < F.col("_last")))
    some, some_tied = repeated.agg(F.count(F.lit(1)), F.bool_or("_tied")).first()
    if not some:
        return df
    if not some_tied:
        return df.join(repeated, same_key & lower, "left_anti")
    alone = df.join(repeated, same_key & (F.col("_tied") | lower), "left_anti")
    tied = df.join(repeated.where("_tied"), same_key & F.col(order).eqNullSafe(F.col("_last")), "left_semi")
    row = F.struct(*[F.col(f"`{name}`") for name in df.columns])
    place = F.struct(*[F.col(name) for name in tie], F.to_json(row, {"ignoreNullFields": "false"}))
    winners = tied.groupBy(F.col(key).alias("_key")).agg(F.max_by(row, place).alias("_row"))
    return alone.unionByName(winners.select("_row.*"))
