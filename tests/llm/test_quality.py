import math
import re
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece

from leafmill.llm.quality import LEAN, MEASURES, REACH, LEAST_SPREAD, fertility, quality, scripts_of, word_pieces
from tests.llm.brute import words

MODEL = public_tokenizers.path("piece_bpe_32k.model")


def base(text):
    text = text or ""
    own = words(text)
    often = Counter(tuple(own[i : i + 5]) for i in range(len(own) - 4))
    covered = {k for i in range(len(own) - 4) if often[tuple(own[i : i + 5])] > 1 for k in range(i, i + 5)}
    seen, repeated = set(), 0
    for line in text.split("\n"):
        if words(line):
            repeated += line in seen
            seen.add(line)
    failed = len(own) < 10 or 100 * len(covered) > 20 * len(own)
    return len(own), sum(map(len, own)), len(re.findall(r"[#*$%&|<>]", text)), repeated, len(covered), failed


def test_counts_equal_brute_force(spark, hard, hard_rows):
    texts = [r[1] for r in hard_rows]
    texts += ["a b c d e f a b c d e x", "a a a a a a a a a a a", "l # <x>\nl # <x>\n l # <x>\n\n\n", "é|\n" * 4]
    docs = spark.createDataFrame([(i, t, None) for i, t in enumerate(texts)], "doc_id bigint, text string, lang string")
    for row in quality(docs, MODEL).collect():
        assert tuple(row[1:7]) == base(texts[row.doc_id])


def test_fertility_equals_the_tokenizer():
    processor = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    look_up = word_pieces(MODEL)
    for text in ("", "hello there hello", "日本 \U0001f600 x", "one"):
        ids = [i for w in words(text) for i in processor.encode(w)]
        share = [n / len(ids) for n in Counter(ids).values()]
        entropy = -sum(p * math.log(p) for p in share) / math.log(len(ids)) if len(ids) > 1 else float(len(ids))
        found = fertility(text.encode(), look_up)
        assert found[:2] == (len(ids), sum(3 <= i <= 258 for i in ids))
        assert found[2] == pytest.approx(entropy)


def test_bands_reject_what_is_far_off_and_keep_the_rest(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    strange = spark.createDataFrame(
        [(10_000_000 + i, " ".join(f"zq{j}x{i}jk%%9" for j in range(80)), "en") for i in range(3)],
        "doc_id bigint, text string, lang string",
    )
    rows = quality(docs.select("doc_id", "text", "lang").unionByName(strange), MODEL).collect()
    by_id = {r.doc_id: r for r in rows}
    assert all(not by_id[10_000_000 + i].base_failed and not by_id[10_000_000 + i].kept for i in range(3))
    good = spark.read.parquet("/root/testdata/sf0.01/labels.parquet").where("quality = 1").collect()
    lost = [r.doc_id for r in good if not by_id[r.doc_id].base_failed and not by_id[r.doc_id].kept]
    assert lost == []


def test_scripts_and_empty_input(spark, none):
    texts = ["abc д", "где a", "日本", "12", "", None, "[]_`", "ÀÉ[", "ก ข a", "\U0001f600 カナ", "α a"]
    found = ["latin", "cyrillic", "han", "none", "none", "none", "none", "latin", "thai", "kana", "latin"]
    assert scripts_of(pa.array(texts, pa.string())) == found
    assert scripts_of(pa.array(texts, pa.string()).slice(1, 2)) == found[1:3]
    assert quality(none, MODEL).collect() == []


def prose(i, words=120):
    draw = np.random.default_rng(i)
    own = ["water", "stone", "light", "the", "of", "river", "under", "morning", "paper", "window", "green", "slow"]
    return " ".join(draw.choice(own, words)) + f" ending{i}"


def junk(i, words=120):
    return " ".join(f"q{(i * 7 + j * 13) % 997}zx%{j}w" for j in range(words))


@pytest.mark.parametrize("others", [0, 1, 5, 20, 47, 48, 49, 50, 51, 120])
def test_a_small_group_is_judged_like_a_large_one(spark, others):
    rows = [(i, prose(i), "big") for i in range(300)]
    rows += [(1000 + i, prose(1000 + i), "small") for i in range(others)]
    rows += [(5000, junk(0), "small"), (5001, junk(1), None), (5002, prose(7), None)]
    kept = {r.doc_id: r.kept for r in quality(spark.createDataFrame(rows, "doc_id int, text string, lang string"), MODEL).collect()}
    assert not kept.pop(5000) and not kept.pop(5001)
    assert all(kept.values())


def test_kept_equals_brute_force_bands(spark):
    """Exact quartiles instead of approximate ones; texts near a limit are left out."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text", "lang")
    docs = docs.selectExpr("doc_id", "text", "CASE WHEN doc_id % 50 = 0 THEN 'rare' WHEN doc_id % 50 > 1 THEN lang END AS lang")
    lang = {r.doc_id: r.lang for r in docs.select("doc_id", "lang").collect()}
    rows = quality(docs, MODEL).collect()
    passed = [r for r in rows if not r.base_failed]

    def quartiles(group, many_wider, wider):
        own = [np.quantile([r[c] for r in group], q, method="inverted_cdf") for c in MEASURES for q in (0.25, 0.75)]
        share = len(group) / (len(group) + many_wider)
        return own if wider is None else [share * a + (1 - share) * b for a, b in zip(own, wider, strict=True)]

    whole = quartiles(passed, LEAN, None)
    latin = quartiles(passed, LEAN, whole)  # every text of this table is in that script
    limits = {
        name: quartiles([r for r in passed if lang[r.doc_id] == name], LEAN, latin) for name in set(lang.values()) - {None}
    }
    unsure = wrong = 0
    for r in passed:
        q, slack = limits.get(lang[r.doc_id], latin), []
        for i, c in enumerate(MEASURES):
            spread = max(q[2 * i + 1] - q[2 * i], LEAST_SPREAD[c])
            reach = REACH[c][0] * spread * (1 + REACH[c][1] / r.n_words)
            slack.append(min(r[c] - q[2 * i] + reach, q[2 * i + 1] + reach - r[c]))
        unsure += abs(min(slack)) < 1e-3
        wrong += abs(min(slack)) >= 1e-3 and r.kept != (min(slack) >= 0)
    assert wrong == 0 and unsure < 10


def test_held_out_labels(spark):
    """Many bad documents that the base rules leave are rejected, next to no good ones."""
    sf_dir = "/root/testdata/sf0.1"
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "quality")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang")
    found = quality(docs, MODEL).where("NOT base_failed").join(labels, "doc_id").groupBy("quality", "kept").count()
    many = {(r.quality, r.kept): r["count"] for r in found.collect()}
    assert many[0, False] > 0.4 * (many[0, False] + many[0, True])
    assert many.get((1, False), 0) < 0.002 * many[1, True]


def test_bands_are_sent_to_all_tasks_without_moving_documents(spark, hard):
    plan = quality(hard, MODEL)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "hashpartitioning" not in plan


def test_remembered_words_are_bounded_by_bytes(monkeypatch):
    from leafmill.llm import quality as module
    from leafmill.llm.words import worker_cache

    worker_cache("another one").clear()
    monkeypatch.setattr(module, "REMEMBERED_BYTES", 4000)
    look_up = word_pieces(MODEL)
    held = look_up.__self__
    first = [look_up(f"w{i}".encode()) for i in range(200)]
    assert 10 < len(held) < 40
    assert [look_up(f"w{i}".encode()) for i in range(200)] == first
    look_up(b"x" * 1000)
    assert max(map(len, held)) <= 256
    worker_cache("another one").clear()
