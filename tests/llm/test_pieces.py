"""Ids equal to the public library's, and exact round trips."""

import os

import pytest

from stmtscope.llm.pieces import MODEL, Vocabulary, decode, encode

needs_model = pytest.mark.skipif(not os.path.exists(MODEL), reason="no vocabulary file")
TEXTS = ["", " ", "a", "  a", "a  b ", "\n\n x\n", "Hello, world! 123", "é日本語🙂\x00\t", "aaaa aaa aaaaaaa", "x" * 3000, "the thing, thing. things"]


@needs_model
def test_ids_equal_the_merges():
    from sentencepiece import SentencePieceProcessor

    library = SentencePieceProcessor(model_file=MODEL)
    vocabulary = Vocabulary.load(MODEL)
    found = [list(memoryview(x).cast("i")) for x in vocabulary.encode(TEXTS)]
    assert found == library.encode(TEXTS)
    assert [vocabulary.decode(x) for x in found] == TEXTS


@needs_model
def test_round_trip(edge_docs, no_docs):
    back = decode(encode(edge_docs)).collect()
    assert sorted((repr(r.doc_id), r.text) for r in back) == sorted((repr(r.doc_id), r.text or "") for r in edge_docs.collect())
    assert all(r.n_tokens == len(r.token_ids) for r in back)
    assert decode(encode(no_docs)).collect() == []


def test_unigram_scores_give_the_best_path():
    pieces = [("<unk>", 0.0), ("▁", -2.0), ("a", -2.0), ("b", -2.0), ("▁a", -2.5), ("ab", -2.1), ("▁ab", -6.0), ("ba", -3.0)]
    pieces += [(f"<0x{b:02X}>", -9.0) for b in range(256)]
    vocabulary = Vocabulary(pieces, list(range(8, 264)), {0}, bpe=False)
    words = ["▁", "▁a", "▁ab", "▁aba", "▁abb", "▁ba"]

    def best(word):
        score = {p: s for p, s in pieces[1:8]}
        options = {0: (0.0, [])}
        for end in range(1, len(word) + 1):
            found = [(options[k][0] + score[word[k:end]], options[k][1] + [word[k:end]]) for k in range(end) if word[k:end] in score]
            options[end] = max(found, key=lambda x: x[0])
        return options[len(word)][0]

    for word, numbers in zip(words, vocabulary.walk(words)):
        assert "".join(pieces[n][0] for n in numbers) == word
        assert sum(pieces[n][1] for n in numbers) == pytest.approx(best(word))
