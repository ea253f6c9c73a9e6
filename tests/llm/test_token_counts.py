import random

import public_tokenizers

from leafmill.llm.token_counts import BLANK, PACK, PrefixTrie, count_words, piece_scores, token_counts

MODEL = public_tokenizers.path("piece_bpe_32k.model")


def best(word, scores, byte_score):
    """Tokens and byte tokens of the best split, by trying all."""
    word = BLANK + word
    table = [(0, 0, 0)]
    for end in range(1, len(word) + 1):
        width = len(word[end - 1].encode())
        options = [(table[-1][0] + width * byte_score, table[-1][1] - width, table[-1][2] + width)]
        for start in range(end):
            if word[start:end] in scores:
                total, tokens, spelled = table[start]
                options.append((total + scores[word[start:end]], tokens - 1, spelled))
        table.append(max(options, key=lambda o: o[:2]))
    return -table[-1][1], table[-1][2]


def test_trie_equals_brute_force_and_shares_prefixes():
    scores, byte_score = piece_scores(MODEL)
    rng = random.Random(8)
    words = {"".join(rng.choice("aenrstié日\U0001f600") for _ in range(rng.randrange(1, 12))) for _ in range(800)}
    words |= {"international", "internationally", "internal", "intern", "in"}
    counts = count_words(words, scores, byte_score)
    for word in words:
        assert (counts[word] & ((1 << PACK) - 1), counts[word] >> PACK) == best(word, scores, byte_score)
    trie = PrefixTrie(scores, byte_score)
    for word in sorted(words):
        trie.insert(BLANK + word)
    nodes = {(BLANK + w)[:k] for w in words for k in range(1, len(w) + 2)}
    assert trie.nodes == len(nodes)


def test_documents(hard, hard_rows, none):
    scores, byte_score = piece_scores(MODEL)
    expected = []
    for i, text, *_ in hard_rows:
        each = [best(w, scores, byte_score) for w in (text or "").split()[:2000]]
        if len((text or "").split()) <= 2000:
            expected.append((i, len(each), sum(e[0] for e in each), sum(e[1] for e in each)))
    found = [tuple(r) for r in token_counts(hard, MODEL).collect()]
    assert len(found) == len(hard_rows)
    assert sorted(map(repr, expected)) == sorted(repr(f) for f in found if f[0] not in (9, 10))
    assert token_counts(none, MODEL).collect() == []


def test_long_words_equal_the_trie_and_need_little_memory():
    import tracemalloc

    from leafmill.llm.token_counts import LONG_WORD, PrefixTrie, count_long, count_words

    scores, byte_score = piece_scores(MODEL)
    longest = max(map(len, scores))
    for word in ("\u2581" + "international" * 40, "\u2581" + "日本é" * 150, "\u2581" + "ab\U0001f600" * 100, "\u2581"):
        assert count_long(word, scores, byte_score, longest) == PrefixTrie(scores, byte_score).insert(word)
    base64 = "QmFzZTY0IGVuY29kZWQgdGV4dA" * 4_000
    tracemalloc.start()
    count_words({base64, "x" * LONG_WORD}, scores, byte_score)
    assert tracemalloc.get_traced_memory()[1] < 2 << 20
    tracemalloc.stop()


def test_scores_of_a_unigram_file_are_used():
    from leafmill.llm.token_counts import SCALE, unigram_scores, zipf_score

    ranks, byte_score = unigram_scores(["a", "b", "c"], [0.0, -1.0, -2.0])
    assert ranks == {"a": zipf_score(0), "b": zipf_score(1), "c": zipf_score(2)} and byte_score < min(ranks.values())
    found, _ = piece_scores(MODEL)  # a merge vocabulary
    assert list(found.values()) == [zipf_score(rank) for rank in range(len(found))]
    own, byte_score = unigram_scores(["a", "b", "ab"], [-2.5, -3.25, -9.0])
    assert own == {"a": -2.5 * SCALE, "b": -3.25 * SCALE, "ab": -9 * SCALE} and byte_score == -11 * SCALE
    from leafmill.llm.token_counts import count_words

    counts = count_words({"ab"}, {**own, "\u2581": 0}, byte_score)
    assert counts["ab"] == 3  # the two letters are likelier than their pair
