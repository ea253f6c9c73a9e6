"""Quality rules from counts of words, lines and repeats, and from tokeniser fertility.

Fertility is how a public vocabulary takes a text: characters per token, the share of tokens
that fall back to single bytes, and the entropy of the tokens as a share of what as many
different tokens would have. Texts of a language (or of a script where the language is not
given) are held against bands around the quartiles of all its documents; far outside of a
band a text is rejected. The quartiles of a small group lean on those of its script, and these
on the whole corpus's, by how many documents each has, so every text is judged and none changes
sides because its group has one document more.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from leafmill.llm.tables import Workspace
from leafmill.llm.words import (
    AS_IS, SPACE, hash_spans, mix, slices, text_bytes, windows, word_spans, worker_cache,
)

SYMBOLS = np.zeros(256, bool)
SYMBOLS[list(b"#*$%&|<>")] = True
WINDOW_WORDS = 5
LEAST_WORDS = 10
MOST_REPEATED_PERCENT = 20
# Bytes that a worker spends on remembered words and their pieces, what a word costs besides its
# letters, and the longest that is remembered.
REMEMBERED_BYTES, WORD_BYTES, LONGEST_REMEMBERED = 64 << 20, 150, 256
# Pieces 3 to 258 of the vocabulary stand for single bytes.
FIRST_BYTE_PIECE, LAST_BYTE_PIECE = 3, 258
MEASURES = ("chars_per_token", "byte_share", "token_entropy")
# Per measure the least spread that a band assumes, so that uniform groups reject nothing.
LEAST_SPREAD = {"chars_per_token": 0.04, "byte_share": 0.02, "token_entropy": 0.03}
# How many spreads beyond the quartiles a band reaches, and how much farther for short texts:
# (1 + short / number of words). Characters per token settle with length, the others less so.
REACH = {"chars_per_token": (0.6, 800.0), "byte_share": (4.0, 80.0), "token_entropy": (4.0, 80.0)}
# The wider group's quartiles count as this many documents of a group.
LEAN = 50
# Rows of bands up to which they are sent to all executors; there is one for each language.
FEW_BANDS = 100_000
# First and last letters of scripts, by code point.
SCRIPTS = {
    "latin": [(0x41, 0x5A), (0x61, 0x7A), (0xC0, 0x24F)], "greek": [(0x370, 0x3FF)],
    "cyrillic": [(0x400, 0x4FF)], "hebrew": [(0x590, 0x5FF)], "arabic": [(0x600, 0x6FF)],
    "indic": [(0x900, 0xDFF)], "thai": [(0xE00, 0xE7F)], "kana": [(0x3040, 0x30FF)],
    "han": [(0x4E00, 0x9FFF)], "hangul": [(0xAC00, 0xD7AF)],
}
NO_SCRIPT = "none"


def _script_table() -> np.ndarray:
    """Number of the script, by code point below 0x10000; 0 for none."""
    table = np.zeros(1 << 16, np.uint8)
    for number, ranges in enumerate(SCRIPTS.values(), 1):
        for first, last in ranges:
            table[first : last + 1] = number
    return table


def scripts_of(texts: pa.Array) -> list[str]:
    """The script with the most letters in each text, of equal ones the first; or none."""
    n, names = len(texts), [NO_SCRIPT, *SCRIPTS]
    data, starts = text_bytes(texts)
    wide = np.concatenate([data, np.zeros(3, np.uint8)]).astype(np.int32)
    table = _script_table()
    votes = np.zeros((n, len(names)), np.int64)
    for lead, size in (((0x41, 0x7A), 1), ((0xC3, 0xDF), 2), ((0xE0, 0xEF), 3)):
        at = np.flatnonzero((data >= lead[0]) & (data <= lead[1]))
        point = wide[at]
        if size == 2:
            point = (point & 31) << 6 | wide[at + 1] & 63
        elif size == 3:
            point = (point & 15) << 12 | (wide[at + 1] & 63) << 6 | wide[at + 2] & 63
        doc = np.searchsorted(starts, at, "right") - 1
        script = table[point].astype(np.int64)
        votes += np.bincount(doc * len(names) + script, minlength=votes.size).reshape(votes.shape)
    votes[:, 0] = 0
    return [names[i] for i in votes.argmax(axis=1)]


def base_counts(texts: pa.Array) -> dict[str, np.ndarray]:
    """Counts of words, characters in words, symbols, repeated lines and repeated words."""
    n = len(texts)
    data, starts = text_bytes(texts)
    doc_of = np.repeat(np.arange(n), np.diff(starts))
    spans = word_spans(data, starts, AS_IS)
    n_words = np.bincount(spans.doc, minlength=n)
    # A character starts at every byte that does not continue one.
    in_word = ~SPACE[data] & ((data & 0xC0) != 0x80)
    word_chars = np.bincount(doc_of[in_word], minlength=n)
    n_symbols = np.bincount(doc_of[SYMBOLS[data]], minlength=n)

    breaks = np.flatnonzero(data == 10)
    begin = np.concatenate([starts[:-1], breaks + 1])
    order = np.argsort(begin, kind="stable")
    begin = begin[order]
    # A line ends at the next break of its text, or at the text's end.
    line_doc = np.concatenate([np.arange(n), doc_of[breaks]])[order]
    after = np.searchsorted(breaks, begin)
    next_break = np.concatenate([breaks, [len(data)]])[after]
    end = np.minimum(next_break, starts[line_doc + 1])
    has_word = np.searchsorted(spans.begin, end) > np.searchsorted(spans.begin, begin)
    begin, end, line_doc = begin[has_word], end[has_word], line_doc[has_word]
    lines = mix(hash_spans(data, begin, end, AS_IS) + line_doc.astype(np.uint64))
    _, first = np.unique(lines, return_index=True)
    n_dup_lines = np.bincount(line_doc, minlength=n) - np.bincount(line_doc[first], minlength=n)

    code, doc, at = windows(spans, WINDOW_WORDS)
    _, group, count = np.unique(
        mix(code + doc.astype(np.uint64)), return_inverse=True, return_counts=True
    )
    edge = np.zeros(len(spans.code) + WINDOW_WORDS + 1, np.int64)
    twice = at[count[group] > 1] if len(at) else at
    np.add.at(edge, twice, 1)
    np.add.at(edge, twice + WINDOW_WORDS, -1)
    repeated = np.cumsum(edge)[: len(spans.code)] > 0
    n_repeat_words = np.bincount(spans.doc[repeated], minlength=n)
    return {
        "n_words": n_words, "word_chars": word_chars, "n_symbols": n_symbols,
        "n_dup_lines": n_dup_lines, "n_repeat_words": n_repeat_words,
    }


def word_pieces(model: str):
    """A function from the bytes of a word to its pieces (little-endian, two bytes each)."""
    held = worker_cache(f"pieces {model}")
    if "look_up" in held:
        return held["look_up"]
    import sentencepiece

    processor = sentencepiece.SentencePieceProcessor(model_file=model)

    class Pieces(dict):
        size = 0

        def __missing__(self, word: bytes) -> bytes:
            ids = processor.encode(word.decode("utf-8", "replace"), num_threads=1)
            packed = np.asarray(ids, "<u2").tobytes()
            if len(word) <= LONGEST_REMEMBERED and self.size < REMEMBERED_BYTES:
                self[word] = packed
                self.size += len(word) + len(packed) + WORD_BYTES
            return packed

    held["look_up"] = Pieces().__getitem__
    return held["look_up"]


def fertility(text: bytes, look_up) -> tuple[int, int, float]:
    """Number of tokens, of byte tokens, and entropy as a share of the largest possible."""
    ids = np.frombuffer(b"".join(map(look_up, text.split())), "<u2")
    if not len(ids):
        return 0, 0, 0.0
    bytes_ = int(((ids >= FIRST_BYTE_PIECE) & (ids <= LAST_BYTE_PIECE)).sum())
    if len(ids) == 1:
        return 1, bytes_, 1.0
    ids = np.sort(ids)
    edges = np.flatnonzero(np.concatenate([[True], ids[1:] != ids[:-1], [True]]))
    share = np.diff(edges) / len(ids)
    return len(ids), bytes_, float(-(share * np.log(share)).sum() / np.log(len(ids)))


def _measured(model: str):
    counts = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    names = [*counts, "n_tokens", "n_byte_tokens", "token_entropy", "script"]
    kind = pa.struct([(c, pa.int64()) for c in names[:-2]] + [(names[-2], pa.float64()), (names[-1], pa.string())])
    ddl = ",".join(f"{c}:bigint" for c in names[:-2]) + ",token_entropy:double,script:string"

    @F.arrow_udf(f"struct<{ddl}>")
    def measure(texts: pa.Array) -> pa.Array:
        look_up = word_pieces(model)
        parts = []
        for part in slices(texts):
            found = base_counts(part)
            rows = [fertility((t.as_py() or "").encode(), look_up) for t in part]
            tokens, byte_tokens, entropy = zip(*rows, strict=True)
            arrays = [pa.array(found[c].astype(np.int64)) for c in counts]
            arrays += [pa.array(tokens, pa.int64()), pa.array(byte_tokens, pa.int64())]
            arrays += [pa.array(entropy, pa.float64()), pa.array(scripts_of(part), pa.string())]
            parts.append(pa.StructArray.from_arrays(arrays, names=names))
        return pa.concat_arrays(parts) if parts else pa.array([], kind)

    return measure


def _mixed(own: list[float], own_many: int, wider: list[float] | None) -> list[float]:
    if wider is None:
        return list(own)
    share = own_many / (own_many + LEAN)
    return [share * a + (1 - share) * b for a, b in zip(own, wider, strict=True)]


def _quartiles(rows: DataFrame, *keys: str) -> DataFrame:
    """Documents, commonest script and quartiles of all measures (in one list) by group."""
    lists = [F.percentile_approx(c, [0.25, 0.75], 10000) for c in MEASURES]
    return rows.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("many"), F.mode("script", True).alias("of"), F.concat(*lists).alias("quartiles")
    )


def bands(measured: DataFrame, work: Workspace) -> DataFrame:
    """``(band_group, quartiles)`` of every language and script; see the module's text.

    At most one row for each script and one for all come to the driver; languages do not.
    """
    passed = measured.where(~F.col("base_failed"))
    whole = _quartiles(passed).first()
    scripts = {
        row.script: _mixed(row.quartiles, row.many, whole.quartiles)
        for row in _quartiles(passed, "script").collect()
    }
    listed = measured.sparkSession.createDataFrame(
        [(f"script {k}", v, k) for k, v in scripts.items()], "band_group string, quartiles array<double>, script string"
    )
    own = F.col("many") / (F.col("many") + LEAN)
    languages = _quartiles(passed.where("by_language"), "group").join(
        F.broadcast(listed.select(F.col("script").alias("of"), F.col("quartiles").alias("wider"))), "of"
    )
    mixed = F.zip_with("quartiles", "wider", lambda a, b: own * a + (1 - own) * b)
    return work.put(
        languages.select(F.col("group").alias("band_group"), mixed.alias("quartiles")).unionAll(
            listed.select("band_group", "quartiles")
        ),
        "bands",
    )


def quality(
    docs: DataFrame,
    model: str,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str | None = "lang",
) -> DataFrame:
    """One row per document: id, base counts, ``base_failed``, the three measures, ``kept``.

    ``model`` is a sentencepiece file with byte fallback. A null text has no words and fails
    like every text of under ten. The group of a document is its language or, where that is
    null or ``lang_col`` is None, its script. Quartiles come from all documents that pass the
    base rules; without any, nothing is kept. Repeated rows are judged each, alike. An empty
    table gives no rows; other columns play no part.
    """
    work = Workspace(docs.sparkSession, "quality")
    text = F.coalesce(text_col, F.lit(""))
    language = F.lit(None).cast("string") if lang_col is None else F.col(lang_col).cast("string")
    repeated = 100 * F.col("n_repeat_words") > MOST_REPEATED_PERCENT * F.col("n_words")
    measured = work.put(
        docs.select(F.col(id_col).alias("id"), language.alias("language"), _measured(model)(text).alias("m"))
        .select("id", "language", "m.*")
        .withColumns(
            {
                "by_language": F.col("language").isNotNull(),
                "group": F.coalesce(
                    F.concat(F.lit("language "), F.col("language")), F.concat(F.lit("script "), F.col("script"))
                ),
                "base_failed": (F.col("n_words") < LEAST_WORDS) | repeated,
                "chars_per_token": F.col("word_chars") / F.greatest("n_tokens", F.lit(1)),
                "byte_share": F.col("n_byte_tokens") / F.greatest("n_tokens", F.lit(1)),
            }
        ),
        "measured",
    )
    limits = bands(measured, work)
    if limits.count() <= FEW_BANDS:
        limits = F.broadcast(limits)
    inside = F.lit(True)
    for i, c in enumerate(MEASURES):
        low, high = F.get("quartiles", F.lit(2 * i)), F.get("quartiles", F.lit(2 * i + 1))
        spreads, short = REACH[c]
        reach = spreads * F.greatest(high - low, F.lit(LEAST_SPREAD[c])) * (1 + short / F.greatest("n_words", F.lit(1)))
        inside = inside & F.col(c).between(low - reach, high + reach)
    judged = measured.join(limits, F.col("group") == F.col("band_group"), "left")
    return judged.select(
        F.col("id").alias(id_col),
        "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
        *MEASURES,
        (~F.col("base_failed") & F.coalesce(inside, F.lit(False))).alias("kept"),
    )
