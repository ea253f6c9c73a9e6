"""Token counts under a unigram vocabulary, by a trie of pre-tokens.

A pre-token is a white-space separated word with the blank sign in front. Its tokens are the
pieces whose scores have the largest sum (of equal sums, the fewest pieces). The best sum up
to a prefix depends on the prefix alone: in a trie of all pre-tokens it is computed once per
node, and the count at a word's terminal node is stored. A batch's new words are inserted in
sorted order, which visits the trie depth first, so that only one path of it is in memory.

Vocabularies come as they are; nothing is trained. A file's unigram scores are used where it has
them; the files of merge vocabularies hold ranks instead, and then scores follow from the order
of the pieces by Zipf's law, so the counts are those of a unigram model with that vocabulary, not of
the published tokeniser. A character that no piece covers is spelled in UTF-8 bytes, each a token.

Very long pre-tokens (text without blanks) stay out of the trie: their sums are kept for as many
characters as the longest piece has, so memory does not grow with their length.
"""

from __future__ import annotations

import math
from collections import deque
from collections.abc import Iterable

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from leafmill.llm.tables import small_batches
from leafmill.llm.words import worker_cache

BLANK = "▁"
# Bytes that a worker spends on remembered words, and what a word costs besides its letters.
REMEMBERED_BYTES, WORD_BYTES = 64 << 20, 150
# Words with more characters are neither put in the trie nor remembered.
LONG_WORD = 256
# Bits by which byte tokens are shifted in the numbers packed for words.
PACK = 40
SCALE = 1_000_000


def zipf_score(rank: int) -> int:
    """Log probability, in millionths and up to a constant, of the piece at a place of the list."""
    return -round(SCALE * math.log(rank + 3))


def unigram_scores(names: list[str], given: list[float]) -> tuple[dict[str, int], int]:
    """Scores of pieces in millionths, and the score of a byte.

    ``given`` are the file's scores. A merge vocabulary has ranks there, whole numbers; then
    Zipf's law gives the scores. Otherwise a byte scores below the worst piece.
    """
    if all(score == int(score) for score in given):
        return {name: zipf_score(rank) for rank, name in enumerate(names)}, zipf_score(2 * len(names))
    scores = {name: round(SCALE * score) for name, score in zip(names, given, strict=True)}
    return scores, min(scores.values()) - 2 * SCALE


def piece_scores(model: str) -> tuple[dict[str, int], int]:
    """Scores of a sentencepiece file's pieces, and the score of a byte."""
    held = worker_cache(f"tokens {model}")
    if "scores" not in held:
        import sentencepiece

        processor = sentencepiece.SentencePieceProcessor(model_file=model)
        pieces = [
            i
            for i in range(processor.get_piece_size())
            if not (processor.is_control(i) or processor.is_unknown(i) or processor.is_byte(i))
        ]
        held["scores"], held["byte"] = unigram_scores(
            [processor.id_to_piece(i) for i in pieces], [processor.get_score(i) for i in pieces]
        )
    return held["scores"], held["byte"]


class PrefixTrie:
    """Forward scores along the current path of a trie that is filled in sorted order."""

    def __init__(self, scores: dict[str, int], byte_score: int):
        self.scores, self.byte_score = scores, byte_score
        self.longest = max(map(len, scores), default=1)
        self.word = ""
        # Per depth: best sum, its number of tokens and how many of them are bytes.
        self.path: list[tuple[int, int, int]] = [(0, 0, 0)]
        self.nodes = 0

    def insert(self, word: str) -> tuple[int, int]:
        """Tokens and byte tokens of a word; only nodes that the last word lacks are computed."""
        shared = 0
        for a, b in zip(word, self.word):
            if a != b:
                break
            shared += 1
        path, scores = self.path, self.scores
        del path[shared + 1 :]
        for end in range(shared + 1, len(word) + 1):
            width = len(word[end - 1].encode("utf-8", "surrogatepass"))
            total, tokens, spelled = path[end - 1]
            best = (total + width * self.byte_score, tokens + width, spelled + width)
            for start in range(max(0, end - self.longest), end):
                score = scores.get(word[start:end])
                if score is not None:
                    total, tokens, spelled = path[start]
                    if (total + score, -tokens - 1) > (best[0], -best[1]):
                        best = (total + score, tokens + 1, spelled)
            path.append(best)
            self.nodes += 1
        self.word = word
        return path[-1][1:]


def count_long(word: str, scores: dict[str, int], byte_score: int, longest: int) -> tuple[int, int]:
    """Tokens and byte tokens of one word, remembering the sums of its last prefixes alone."""
    last: deque[tuple[int, int, int]] = deque([(0, 0, 0)], maxlen=longest)
    for end in range(1, len(word) + 1):
        width = len(word[end - 1].encode("utf-8", "surrogatepass"))
        total, tokens, spelled = last[-1]
        best = (total + width * byte_score, tokens + width, spelled + width)
        for back in range(min(longest, end), 0, -1):
            score = scores.get(word[end - back : end])
            if score is not None:
                total, tokens, spelled = last[-back]
                if (total + score, -tokens - 1) > (best[0], -best[1]):
                    best = (total + score, tokens + 1, spelled)
        last.append(best)
    return last[-1][1:]


def count_words(words: Iterable[str], scores: dict[str, int], byte_score: int) -> dict[str, int]:
    """Tokens plus byte tokens shifted by ``PACK`` bits, of each distinct word."""
    trie = PrefixTrie(scores, byte_score)
    counts = {}
    for word in sorted(words):
        if len(word) <= LONG_WORD:
            tokens, spelled = trie.insert(BLANK + word)
        else:
            tokens, spelled = count_long(BLANK + word, scores, byte_score, trie.longest)
        counts[word] = tokens + (spelled << PACK)
    return counts


def _counter(model: str):
    kind = pa.struct([("n_pretokens", pa.int64()), ("n_tokens", pa.int64()), ("n_byte_tokens", pa.int64())])

    @F.arrow_udf("struct<n_pretokens:bigint,n_tokens:bigint,n_byte_tokens:bigint>")
    def count(texts: pa.Array) -> pa.Array:
        scores, byte_score = piece_scores(model)
        held = worker_cache(f"tokens {model}")
        known = held.setdefault("known", {})
        rows = []
        for at in range(0, len(texts), 256):
            split = [(t.as_py() or "").split() for t in texts.slice(at, 256)]
            new = {word for words in split for word in words if word not in known}
            fresh = count_words(new, scores, byte_score)
            short = {word: n for word, n in fresh.items() if len(word) <= LONG_WORD}
            size = held.get("bytes", 0) + sum(map(len, short)) + WORD_BYTES * len(short)
            if size <= REMEMBERED_BYTES:
                known.update(short)
                held["bytes"] = size
            look_up = (
                known.__getitem__
                if size <= REMEMBERED_BYTES and len(short) == len(fresh)
                else lambda word, a=fresh, b=known: a[word] if word in a else b[word]
            )
            for words in split:
                packed = sum(map(look_up, words))
                rows.append((len(words), packed & ((1 << PACK) - 1), packed >> PACK))
        columns = list(zip(*rows, strict=True)) or [(), (), ()]
        return pa.StructArray.from_arrays(
            [pa.array(c, pa.int64()) for c in columns], fields=list(kind)
        )

    return count


def token_counts(
    docs: DataFrame, model: str, *, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per document: id, ``n_pretokens, n_tokens, n_byte_tokens``, from the whole text.

    A null, empty or blank text has none. Repeated rows are counted each; an empty table gives no
    rows. A very long pre-token takes time in proportion to its length and no more memory than the
    text itself.
    """
    small_batches(docs.sparkSession)
    return docs.select(id_col, _counter(model)(F.coalesce(text_col, F.lit(""))).alias("c")).select(
        id_col, "c.*"
    )
