"""Token counts with a whole-token shortcut.

Ahead of the count, the vocabulary is examined once:

* Which places can no merge cross? If no piece holds a space mark after
  another character, a text falls apart before every run of space marks, and
  the parts (pre-tokens) are merged one by one with the same result. A
  vocabulary that breaks this rule is refused.
* Which pieces, given as a text of their own, end as one token? Each is merged
  to the end; those that do are proven.

A pre-token that is proven counts as one without merging. The rest is merged,
by the segment trees of ``bpe``.

Defined results: null and empty texts have no tokens. Characters outside the
vocabulary count a token for each of their bytes. Repeated rows are counted
each; an empty table gives no rows; other columns are not looked at.
"""

from __future__ import annotations

import re
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripengine.llm.bpe import Pairs, Remembered, merge_many
from tripengine.llm.common import in_batches, query, table

PIECE_BPE = "piece_bpe_32k.model"
LIMIT = 4096
#: Stands for a space; a fixed value of the file format.
MARK = "▁"
#: Symbols of characters that are no piece start here.
OUTSIDE = 1 << 24
PRE_TOKEN = re.compile(f"{MARK}*[^{MARK}]+|{MARK}+")

COUNTS = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_tokens", pa.int64())])


class PieceBpe:
    """A vocabulary of scored pieces: ids and scores by piece, and what merges into what."""

    def __init__(self, path: str):
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        usable = [i for i in range(model.get_piece_size())
                  if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i))]
        self.pieces = {model.id_to_piece(i): i for i in usable}
        if any(re.search(f"[^{MARK}]{MARK}", p) for p in self.pieces):
            raise ValueError("a piece of this vocabulary reaches over the start of a word")
        # pieces of one score share a rank, and then the leftmost pair is merged first
        scores = sorted({model.get_score(i) for i in usable}, reverse=True)
        order = {score: r for r, score in enumerate(scores)}
        # every way to put a piece together has the piece's rank
        pairs = {}
        for piece, i in self.pieces.items():
            for cut in range(1, len(piece)):
                a, b = self._symbol(piece[:cut]), self._symbol(piece[cut:])
                if a is not None and b is not None:
                    pairs[a, b] = order[model.get_score(i)], i
        self.pairs = Pairs(pairs)

    def _symbol(self, part: str) -> int | None:
        """A piece's id; a character that is no piece has a symbol of its own."""
        found = self.pieces.get(part)
        return OUTSIDE + ord(part) if found is None and len(part) == 1 else found

    def merged(self, pre_tokens: list[str]) -> list[int]:
        """Tokens of each pre-token, by merging."""
        letters = np.array([ord(c) for p in pre_tokens for c in p], np.int64)
        chars, place = np.unique(letters, return_inverse=True)
        symbols = np.array([self._symbol(chr(c)) for c in chars], np.int64)[place]
        merged, left = merge_many(symbols, np.array([len(p) for p in pre_tokens], np.int64), self.pairs)
        code = merged - OUTSIDE
        # a character outside counts the bytes of its UTF-8 form
        tokens = np.where(code < 0, 1, 1 + (code >= 0x80) + (code >= 0x800) + (code >= 0x10000))
        total = np.concatenate([[0], np.cumsum(tokens)])
        ends = np.cumsum(left)
        return (total[ends] - total[ends - left]).tolist()

    def proven(self) -> list[str]:
        """Pieces that are a pre-token and end as one token."""
        alone = [p for p in self.pieces if PRE_TOKEN.fullmatch(p)]
        return [p for p, n in zip(alone, self.merged(alone), strict=True) if n == 1]


class Counter:
    def __init__(self, bpe: PieceBpe, whole_tokens: list[str]):
        self.counts = Remembered(bpe.merged, dict.fromkeys(whole_tokens, 1))

    def count_all(self, texts: list[str]) -> list[int]:
        parts = [PRE_TOKEN.findall(MARK + t.replace(" ", MARK)) if t else [] for t in texts]
        counts = self.counts.of([p for text in parts for p in text])
        return [sum(map(counts, text)) for text in parts]


@lru_cache(maxsize=2)
def proven_pieces(path: str) -> list[str]:
    """The offline proof, once per vocabulary and session."""
    return PieceBpe(path).proven()


@lru_cache(maxsize=2)
def _vocabulary(path: str) -> PieceBpe:
    return PieceBpe(path)


def count_tokens(docs: DataFrame, path: str, limit: int = LIMIT, id_column: str = "doc_id",
                 text_column: str = "text") -> DataFrame:
    """doc_id, n_bytes, n_tokens and whether they exceed ``limit``, for each row."""
    # bounded by the vocabulary, whatever the size of the table
    shared = docs.sparkSession.sparkContext.broadcast(proven_pieces(path))

    def rows(batches):
        counter = Counter(_vocabulary(path), shared.value)

        def found():
            for b in batches:
                texts = [t or "" for t in b.column(1).to_pylist()]
                for doc_id, text, n in zip(b.column(0).to_pylist(), texts,
                                           counter.count_all(texts), strict=True):
                    yield doc_id, len(text.encode("utf-8")), n
        yield from in_batches(found(), COUNTS)

    given = docs.select(docs[f"`{id_column}`"].cast("long").alias("doc_id"),
                        docs[f"`{text_column}`"].cast("string").alias("text"))
    counted = given.mapInArrow(rows, "doc_id long, n_bytes long, n_tokens long")
    return counted.withColumn("over_limit", F.col("n_tokens") > F.lit(limit))


@query("op9_token_counts")
def op9(spark, sf_dir):
    """Tokens of every document."""
    return count_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path(PIECE_BPE))
