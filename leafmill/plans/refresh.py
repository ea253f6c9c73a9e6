"""The full refresh: a folder of files to one table.

Each stage writes its outcome once and the next reads it back. The two writes before
the parse hold what is costly to make again (parsed files, model answers): they cut the
lineage, so a lost executor repeats single tasks of one stage and never a model call
that is already stored.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from leafmill.operators.extract import (
    Parser,
    assign_ids,
    extract_elements,
    join_elements,
    split_failures,
    with_extraction_date,
    with_file_names,
)
from leafmill.operators.load import flatten_record, load_table, with_metadata
from leafmill.operators.metrics import extraction_metrics, structured_metrics
from leafmill.operators.shaping import stored
from leafmill.operators.structure import (
    Extractor,
    keep_last,
    parse_responses,
    render_prompts,
    run_extractor,
)
from leafmill.schemas import PROMPT_MESSAGES, TABLE_COLUMNS, TABLE_NAME
from leafmill.settings import remove_folder, shared_dir
from leafmill.sources.files import scan_documents
from leafmill.sources.sinks import write_extracted, write_structured


@dataclass(frozen=True)
class Refresh:
    """What a refresh leaves behind, all of it read from stored data."""

    documents: DataFrame
    extraction_errors: DataFrame
    answers: DataFrame
    structure_errors: DataFrame
    extraction: DataFrame
    structure: DataFrame
    load: dict[str, object]
    work: str = ""

    def forget(self) -> None:
        """Delete what the frames here are read from; the table and the datasets stay."""
        remove_folder(self.documents.sparkSession, self.work)


def extract_documents(files: DataFrame, parser: str | Parser = "lines") -> DataFrame:
    """Stage 1 on scanned files: one row per file, with its text or its ``error``."""
    texts = extract_elements(files, parser).select(
        "path", join_elements().alias("content"), "error"
    )
    return with_extraction_date(assign_ids(with_file_names(texts)))


def ask_documents(
    documents: DataFrame,
    extractor: Extractor | None = None,
    *,
    setup: Callable[[], Extractor] | None = None,
    messages: Sequence[Mapping[str, str]] = PROMPT_MESSAGES,
) -> DataFrame:
    """Stage 2 up to the raw answers: ``(filename, path, extraction_date, response, error)``."""
    return run_extractor(
        render_prompts(documents, messages),
        extractor,
        setup=setup,
        id_col="filename",
        carry=["path", "extraction_date"],
    )


def refresh(
    spark: SparkSession,
    input_path: str,
    *,
    parser: str | Parser,
    suffix: str = ".pdf",
    extractor: Extractor | None = None,
    setup: Callable[[], Extractor] | None = None,
    messages: Sequence[Mapping[str, str]] = PROMPT_MESSAGES,
    table: str = TABLE_NAME,
    mapping: Mapping[str, str] = TABLE_COLUMNS,
    work_path: str | None = None,
    table_path: str | None = None,
    extracted_path: str | None = None,
    structured_path: str | None = None,
) -> Refresh:
    """Scan, extract, structure and load everything under ``input_path``.

    ``parser`` has no default, as what the bytes of a ``.pdf`` mean is for the caller to say.
    ``work_path`` and ``table_path`` must be reachable by all executors. The JSON
    datasets of both stages are written where a path for them is given.
    """
    work = work_path or shared_dir(spark, "refresh")

    extracted = stored(
        extract_documents(scan_documents(spark, input_path, suffix), parser),
        f"{work}/extracted",
    )
    documents, extraction_errors = split_failures(extracted)
    if extracted_path:
        write_extracted(documents, extracted_path)

    asked = ask_documents(
        documents, extractor, setup=setup, messages=messages
    )
    parsed = parse_responses(stored(asked, f"{work}/answers"))
    good, structure_errors = split_failures(parsed)
    answers = stored(
        keep_last(good.drop("response", "error"), "filename", "path"), f"{work}/structured"
    )
    if structured_path:
        write_structured(answers, structured_path)

    records = with_metadata(flatten_record(answers, carry=("extraction_date",)))
    loaded = load_table(records, table, mapping, table_path)
    return Refresh(
        documents=documents,
        extraction_errors=extraction_errors,
        answers=answers,
        structure_errors=structure_errors,
        extraction=extraction_metrics(extracted),
        structure=structured_metrics(documents, answers),
        load=loaded,
        work=work,
    )
