"""Language of a text by a byte convolutional network, trained in numpy.

Bytes are embedded, filters of several widths run over fixed-length windows, each filter's
largest response in the window is kept (max pooling), and a softmax over the languages
follows. Training uses plain gradients with Adam on a bounded sample of labelled windows.
For whole texts the responses are looked up by byte pair: a filter of width two is one table
over pairs, one of width three or four a sum of two.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from leafmill.llm.tables import small_batches
from leafmill.llm.words import text_bytes, worker_cache

WINDOW = 256
WIDTHS = (2, 3, 4)
FILTERS = 24
EMBEDDING = 8
# Bounds of the training sample: documents of each language, and windows of each document.
SAMPLE_DOCS = 1200
SAMPLE_WINDOWS = 3
EPOCHS = 8
BATCH = 128
# Windows that are worked on together.
BLOCK = 48
UNKNOWN = "und"


@dataclass
class LanguageModel:
    """Embedding (256, d), filters per width (width, d, f), softmax weights and bias."""

    languages: list[str]
    embedding: np.ndarray
    filters: list[np.ndarray]
    weights: np.ndarray
    bias: np.ndarray

    def tables(self) -> list[list[np.ndarray]]:
        """Per width the response tables over byte pairs (the last one over pairs or bytes)."""
        made = []
        for kernel in self.filters:
            single = [(self.embedding @ part).astype(np.float32) for part in kernel]
            pairs = []
            for k in range(0, len(single), 2):
                if k + 1 < len(single):
                    # A pair is held as first byte plus 256 times the second.
                    pairs.append((single[k + 1][:, None] + single[k][None]).reshape(65536, -1))
                else:
                    pairs.append(single[k])
            made.append(pairs)
        return made


def pooled(windows: np.ndarray, tables: list[list[np.ndarray]]) -> np.ndarray:
    """The largest response of every filter in every window; windows are rows of bytes."""
    pairs = windows[:, :-1].astype(np.int32) + (windows[:, 1:].astype(np.int32) << 8)
    out = []
    for first, *rest in tables:
        if not rest:
            value = first.take(pairs, axis=0)
        elif len(rest[0]) == 256:
            value = first.take(pairs[:, :-1], axis=0)
            value += rest[0].take(windows[:, 2:], axis=0)
        else:
            value = first.take(pairs[:, :-2], axis=0)
            value += rest[0].take(pairs[:, 2:], axis=0)
        out.append(value.max(1))
    return np.concatenate(out, 1)


def _softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(1, keepdims=True))
    return e / e.sum(1, keepdims=True)


def train(windows: np.ndarray, labels: np.ndarray, languages: list[str], seed: int = 7) -> LanguageModel:
    """Fit the network to windows (rows of bytes, zero-padded) and label numbers."""
    rng = np.random.default_rng(seed)
    n_classes = len(languages)
    params = [rng.normal(0, 0.5, (256, EMBEDDING))]
    params += [rng.normal(0, 0.4, (w, EMBEDDING, FILTERS)) for w in WIDTHS]
    params += [rng.normal(0, 0.1, (len(WIDTHS) * FILTERS, n_classes)), np.zeros(n_classes)]
    first = [np.zeros_like(p) for p in params]
    second = [np.zeros_like(p) for p in params]
    step = 0
    for _ in range(EPOCHS):
        order = rng.permutation(len(windows))
        for at in range(0, len(order), BATCH):
            x, y = windows[order[at : at + BATCH]], labels[order[at : at + BATCH]]
            grads = _gradients(params, x, y)
            step += 1
            for p, g, m, v in zip(params, grads, first, second, strict=True):
                m += 0.1 * (g - m)
                v += 0.01 * (g * g - v)
                p -= 0.01 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
    return LanguageModel(languages, params[0], params[1:-2], params[-2], params[-1])


def _gradients(params: list[np.ndarray], x: np.ndarray, y: np.ndarray) -> list[np.ndarray]:
    embedding, *filters, weights, bias = params
    grads = [np.zeros_like(p) for p in params]
    n = len(x)
    peaks, features = [], []
    for kernel in filters:
        width = len(kernel)
        span = x.shape[1] - width + 1
        response = 0
        for k in range(width):
            response = response + (embedding @ kernel[k]).astype(np.float32)[x[:, k : k + span]]
        peak = response.argmax(1)
        peaks.append(peak)
        features.append(np.take_along_axis(response, peak[:, None, :], 1)[:, 0])
    pooled_ = np.concatenate(features, 1)
    error = _softmax(pooled_ @ weights + bias)
    error[np.arange(n), y] -= 1
    error /= n
    grads[-2][:] = pooled_.T @ error + 1e-4 * weights
    grads[-1][:] = error.sum(0)
    back = error @ weights.T
    for i, (kernel, peak) in enumerate(zip(filters, peaks, strict=True)):
        part = back[:, i * FILTERS : (i + 1) * FILTERS]
        for k in range(len(kernel)):
            seen = np.take_along_axis(x, peak + k, 1)
            for f in range(FILTERS):
                np.add.at(grads[0], seen[:, f], part[:, f, None] * kernel[k][None, :, f])
                grads[1 + i][k, :, f] = embedding[seen[:, f]].T @ part[:, f]
    return grads


def cut_windows(data: np.ndarray, starts: np.ndarray, length: int = WINDOW) -> tuple[np.ndarray, np.ndarray]:
    """Begin and end of consecutive windows that cover all texts; ``doc`` gives their text."""
    sizes = np.diff(starts)
    counts = -(-sizes // length)
    doc = np.repeat(np.arange(len(sizes)), counts)
    order = np.arange(len(doc)) - np.repeat(np.cumsum(counts) - counts, counts)
    return starts[doc] + order * length, doc


def fill_windows(data: np.ndarray, begin: np.ndarray, end: np.ndarray, length: int = WINDOW) -> np.ndarray:
    """The bytes of each window, zeros behind its end."""
    place = begin[:, None] + np.arange(length)
    inside = place < end[:, None]
    return np.where(inside, data[np.minimum(place, len(data) - 1)], 0).astype(np.uint8)


def learn_languages(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    sample_docs: int = SAMPLE_DOCS,
    with_none: bool = False,
) -> LanguageModel:
    """Train on a sample of at most ``sample_docs`` documents of each language.

    ``with_none`` adds a class ``und`` for what is none of them, learned from windows made of the
    sample's by ``no_language``; a model without it always answers with a language.

    Sampled are the documents with the smallest hashes of id and text, among those with a
    letter in their text and a label. Per document up to ``SAMPLE_WINDOWS`` windows, evenly
    spaced, are used, cut in their middle for every second one so that short texts are
    learned too. Rows without any label give a model without languages.
    """
    usable = docs.where(F.col(lang_col).isNotNull() & has_letter(F.col(text_col))).select(
        F.col(lang_col).alias("lang"),
        F.xxhash64(F.col(id_col), F.col(text_col)).alias("draw"),
        F.col(text_col).cast("binary").alias("raw"),
    )
    # The share of each language that holds about the sample's number of rows.
    sizes = {r["lang"]: r["count"] for r in usable.groupBy("lang").count().collect()}
    if not sizes:
        return LanguageModel([], np.zeros((256, 0)), [], np.zeros((0, 0)), np.zeros(0))
    share = F.lit(0.0)
    for lang, n in sizes.items():
        share = F.when(F.col("lang") == lang, min(1.0, sample_docs / n)).otherwise(share)
    size = F.octet_length("raw")
    spots = F.transform(
        F.sequence(F.lit(0), F.lit(SAMPLE_WINDOWS - 1)),
        lambda k: F.floor(F.greatest(size - WINDOW, F.lit(0)) * k / max(SAMPLE_WINDOWS - 1, 1)),
    )
    drawn = (
        usable.where(
            F.pmod("draw", F.lit(1 << 20)) <= F.ceil(share * F.lit(1 << 20))
        )
        .select("lang", "draw", F.posexplode(F.array_distinct(spots)).alias("k", "spot"), "raw")
        .select(
            "lang", "draw", "k",
            F.expr(f"substring(raw, cast(spot as int) + 1, {WINDOW})").alias("raw"),
        )
    )
    most = len(sizes) * sample_docs * SAMPLE_WINDOWS
    rows = drawn.orderBy("draw", "k").limit(most).collect()
    languages = sorted(sizes)
    rng = np.random.default_rng(11)
    windows = np.zeros((len(rows), WINDOW), np.uint8)
    for i, row in enumerate(rows):
        part = np.frombuffer(bytes(row["raw"]), np.uint8)
        if i % 2:
            part = part[: int(rng.integers(24, WINDOW))]
        windows[i, : len(part)] = part
    labels = np.array([languages.index(row["lang"]) for row in rows], np.int64)
    if with_none and len(rows):
        made = no_language(windows, rng)
        windows, labels = np.concatenate([windows, made]), np.append(labels, [len(languages)] * len(made))
        languages = [*languages, UNKNOWN]
    return train(windows, labels, languages)


# First code points and sizes of alphabets from which letters are drawn for no language.
ALPHABETS = [(0x61, 26), (0x41, 26), (0x30, 10), (0x430, 32), (0x3B1, 24), (0x5D0, 27), (0x627, 36), (0x905, 50),
             (0xE01, 46), (0x3041, 83), (0x4E00, 2000), (0xAC00, 2000), (0xE0, 31)]


def no_language(windows: np.ndarray, rng: np.random.Generator) -> np.ndarray:
    """About as many windows that are no language as each has: for every sixth one of those given,
    in turn, its bytes in any order, its words' letters in any order, or words of random letters of
    one alphabet (of letters and digits, for every other)."""
    out = []
    for i, row in enumerate(windows[::6]):
        text = row[: np.max(np.flatnonzero(row), initial=0) + 1].tobytes()
        if i % 3 == 0:
            made = bytes(rng.permutation(list(text)).astype(np.uint8))
        elif i % 3 == 1:
            words = text.decode("utf-8", "ignore").split(" ")
            letters = rng.permutation(list("".join(words)))
            cuts = np.cumsum([0, *map(len, words)])
            made = " ".join("".join(letters[a:b]) for a, b in zip(cuts[:-1], cuts[1:], strict=True)).encode()
        else:
            first, size = ALPHABETS[int(rng.integers(len(ALPHABETS)))]
            points = first + rng.integers(0, size, len(text))
            if i % 2:
                points = np.where(rng.random(len(text)) < 0.3, 0x30 + rng.integers(0, 10, len(text)), points)
            points[rng.random(len(text)) < rng.choice([0.02, 0.15])] = 0x20
            made = "".join(map(chr, points)).encode()[: len(text)]
        part = np.frombuffer(made[: windows.shape[1]], np.uint8)
        filled = np.zeros(windows.shape[1], np.uint8)
        filled[: len(part)] = part
        out.append(filled)
    return np.stack(out)


def has_letter(text: Column) -> Column:
    return F.coalesce(F.rlike(text, F.lit(r"\p{L}")), F.lit(False))


def _predict(model: LanguageModel):
    weights, bias = model.weights.astype(np.float32), model.bias.astype(np.float32)
    name = f"language {hash((model.embedding.tobytes(), weights.tobytes()))}"
    kind = pa.struct([("lang_pred", pa.string()), ("score", pa.float64())])

    @F.arrow_udf("struct<lang_pred:string,score:double>")
    def predict(texts: pa.Array) -> pa.Array:
        held = worker_cache(name)
        if "tables" not in held:
            held["tables"] = model.tables()
        data, starts = text_bytes(texts)
        begin, doc = cut_windows(data, starts)
        end = np.minimum(begin + WINDOW, starts[doc + 1])
        total = np.zeros((len(texts), len(model.languages)))
        for at in range(0, len(begin), BLOCK):
            part = slice(at, at + BLOCK)
            windows = fill_windows(data, begin[part], end[part])
            chance = _softmax(pooled(windows, held["tables"]) @ weights + bias)
            np.add.at(total, doc[part], chance * (end[part] - begin[part])[:, None])
        size = np.maximum(np.diff(starts), 1)
        best = total.argmax(1)
        score = np.clip(total[np.arange(len(texts)), best] / size, 0, 1)
        names = pa.array(model.languages, pa.string()).take(pa.array(best))
        return pa.StructArray.from_arrays([names, pa.array(score)], fields=list(kind))

    return predict


def identify_language(docs: DataFrame, model: LanguageModel, *, text_col: str = "text") -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score``, from the whole text alone.

    The score is the mean probability of the predicted language over all windows, by their
    length. ``und`` with score 0 where the text is null or has no letter, or the model
    knows no language. Columns with these names are replaced; repeated rows are judged alike, and
    an empty table gives no rows.
    """
    small_batches(docs.sparkSession)
    unknown = F.struct(F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score"))
    if model.languages:
        found = F.when(has_letter(F.col(text_col)), _predict(model)(F.col(text_col))).otherwise(unknown)
    else:
        found = unknown
    names = [c for c in docs.columns if c not in ("lang_pred", "score")]
    return docs.select(*names, found.alias("__found")).select(
        *names, F.col("__found.lang_pred").alias("lang_pred"), F.col("__found.score").alias("score")
    )


def known_language(
    docs: DataFrame, model: LanguageModel, *, text_col: str = "text", least_score: float = 0.5
) -> DataFrame:
    """The rows of ``docs`` whose language is recognised with at least ``least_score``.

    With a model that knows ``und`` (``learn_languages(..., with_none=True)``) texts that are most
    likely none of its languages go, and so do null texts, those without a letter, and those of
    which no language has half of the windows' probability. All columns stay as they are, whatever
    their names; repeated rows are judged alike. A model without languages keeps every text with a
    letter; an empty table gives no rows.
    """
    if not model.languages:
        return docs.where(has_letter(F.col(text_col)))
    marked = docs.select(F.struct(*docs.columns).alias("doc"), F.col(text_col).alias("text"))
    found = identify_language(marked, model)
    kept = found.where((F.col("lang_pred") != UNKNOWN) & (F.col("score") >= least_score))
    return kept.select("doc.*")
