import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from tripengine.llm import bpe, tokens

WORDS = public_tokenizers.path(bpe.WORD_BPE)
PIECES = public_tokenizers.path(tokens.PIECE_BPE)
TEXTS = [
    "", " ", "a", "Hello  World's\n\tdon't WE'LL", "<|endoftext|>x <|startoftext|>", "12 345 ½ Ⅷ 一二",
    "ΣΑΣ ΟΔΥΣΣΕΥΣ İstanbul", "é 각 ﬁ Å", "x\x1cy\x1fz\x85w", "👨‍👩‍👧 ﻿​", "a" * 3000, "ab" * 2000,
    "▁▁ x▁y <s> </s> <unk>", " " * 50 + "x", "Ᲊ Ɤ \U00010d50 new letters",
]


def texts():
    draw = random.Random(8)
    letters = [*range(32, 0x250), *range(0x370, 0x600), *range(0x2000, 0x2100), *range(0x4e00, 0x4f00),
               *range(0x1f300, 0x1f650)]
    return TEXTS + ["".join(chr(c) for c in draw.choices(letters, k=80)) for _ in range(150)]


def test_word_bpe_is_the_librarys():
    own, library = bpe.WordBpe(WORDS), Tokenizer.from_file(WORDS)
    for text, ids in zip(texts(), own.encode_all(texts()), strict=True):
        want = library.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(ids, "<u4").tolist() == want, text
        assert own.decode(ids) == library.decode(want, skip_special_tokens=False)


def test_counts_are_the_librarys():
    model = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    vocabulary = tokens.PieceBpe(PIECES)
    counter = tokens.Counter(vocabulary, vocabulary.proven())
    assert counter.count_all(texts()) == [len(model.encode(t)) for t in texts()]


def test_proven_pieces_are_one_token_and_need_no_merge():
    vocabulary = tokens.PieceBpe(PIECES)
    proven = vocabulary.proven()
    assert len(proven) > 30_000
    assert tokens.Counter(vocabulary, []).count_all(["hello world"]) == \
        tokens.Counter(vocabulary, proven).count_all(["hello world"])


def greedy(symbols, pairs):
    """Merges one by one: the lowest rank, of equal ranks the leftmost."""
    symbols = list(symbols)
    while True:
        found = [(pairs[p][0], i) for i, p in enumerate(zip(symbols, symbols[1:], strict=False)) if p in pairs]
        if not found:
            return symbols
        i = min(found)[1]
        symbols[i:i + 2] = [pairs[symbols[i], symbols[i + 1]][1]]


def test_trees_merge_as_one_by_one():
    draw = random.Random(2)
    pairs, made = {}, 5
    for rank in range(60):
        pair = draw.randrange(made), draw.randrange(made)
        if pair not in pairs:
            pairs[pair] = rank // 2, made
            made += 1
    words = [[draw.randrange(5) for _ in range(draw.choice([1, 2, 3, 7, 16, 17, 40, 64, 65, 300]))]
             for _ in range(400)]
    want = [greedy(w, pairs) for w in words]
    assert [bpe.merge_pairs(w, pairs) for w in words] == want
    flat, left = bpe.merge_many(np.array([s for w in words for s in w], np.int64),
                                np.array([len(w) for w in words]), bpe.Pairs(pairs))
    assert flat.tolist() == [s for w in want for s in w] and left.tolist() == [len(w) for w in want]


def test_words_are_forgotten_beyond_the_bound(monkeypatch):
    monkeypatch.setattr(bpe, "REMEMBERED", 3)
    kept = bpe.Remembered(lambda words: [w.upper() for w in words], {"known": "K"})
    for block in (["a", "b"], ["c", "d", "e"], ["a", "f"], ["g", "known"], ["b", "a"]):
        look_up = kept.of(block)
        assert [look_up(w) for w in block] == ["K" if w == "known" else w.upper() for w in block]
    assert len(kept.results) < 8


@pytest.fixture
def odd(docs_of):
    return docs_of([(1, None), (2, ""), (3, "The CAT"), (3, "The CAT"), (None, "x" * 50_000)])


def test_digests_of_odd_rows(odd, docs_of):
    library = Tokenizer.from_file(WORDS)
    found = sorted(map(tuple, bpe.digests(odd, WORDS).collect()), key=str)
    want = []
    for r in odd.collect():
        ids = library.encode(r.text or "", add_special_tokens=False).ids
        decoded = library.decode(ids, skip_special_tokens=False)
        want.append((r.doc_id, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(),
                     hashlib.sha256(decoded.encode()).hexdigest()))
    assert found == sorted(want, key=str)
    assert bpe.digests(docs_of([]), WORDS).collect() == []


def test_encode_and_decode_keep_columns(session):
    table = session.createDataFrame([(7, "Two words", "z")], "ids long, text string, `odd name` string")
    coded = bpe.encode(table, WORDS)
    assert coded.columns == ["text", "odd name", "ids"]
    row = bpe.decode(coded, WORDS, "ids", "text").first()
    assert (row["odd name"], row.text) == ("z", "two</w> words</w>")


def test_counts_of_odd_rows(odd, docs_of):
    found = sorted((tuple(r) for r in tokens.count_tokens(odd, PIECES, limit=3).collect()), key=str)
    model = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    want = [(r.doc_id, len(r.text or ""), n := len(model.encode(r.text or "")), n > 3) for r in odd.collect()]
    assert found == sorted(want, key=str)
    assert tokens.count_tokens(docs_of([]), PIECES).collect() == []
