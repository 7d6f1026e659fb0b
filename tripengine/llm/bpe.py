"""BPE encoding and decoding with a segment tree over the ranks of adjacent pairs.

A word starts as its characters. Every place between two symbols is a leaf
that holds the pair's merge rank and its place; inner nodes hold the least of
their children, so the root is the leftmost pair of the lowest rank. A merge
changes three leaves and their ancestors, and the word is done when the root
is empty. That is n log n for a word of n characters, however long.

Vocabularies are JSON files of the ``tokenizers`` library with byte-level
symbols and word ends; their path is a parameter. Special strings in a text
are their special tokens, as the library does it.

Defined results: null and empty texts have no tokens. ``encode`` and
``decode`` keep all columns of their input, repeated rows and clashing names
(the new column then replaces the old one); empty tables stay empty.
"""

from __future__ import annotations

import hashlib
import json
import re
import unicodedata
from collections.abc import Callable
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame
from tokenizers import Regex, normalizers, pre_tokenizers

from tripengine.llm.common import in_batches, query, table, with_column

WORD_BPE = "word_bpe_49k.json"
EMPTY = (1 << 62)
#: Words of one generation that a task remembers; the longest word for shared trees.
REMEMBERED, LONGEST = 1 << 17, 64
#: Characters of remembered words of a generation.
REMEMBERED_CHARS = 1 << 24
#: Python's blanks that are none in Unicode's sense.
ODD_BLANKS = re.compile("[\x1c-\x1f]")
#: Unicode's White_Space, for a class of characters.
WHITE_SPACE = r"\x09-\x0d\x20\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
BLANK = re.compile(f"[{WHITE_SPACE}]+")


def byte_symbols() -> list[str]:
    """The character that stands for each byte: itself if visible in Latin-1, else 256 on."""
    visible = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = iter(range(256, 512))
    shown = set(visible)
    return [chr(b) if b in shown else chr(next(rest)) for b in range(256)]


def merge_pairs(symbols: list[int], pairs: dict[tuple[int, int], tuple[int, int]]) -> list[int]:
    """Symbols after all merges, lowest rank first and of equal ranks the leftmost.

    ``pairs`` gives rank and merged symbol of each pair that can be merged.
    """
    n = len(symbols)
    if n < 2:
        return symbols
    size = 1 << (n - 1).bit_length()
    tree = [EMPTY] * (2 * size)
    symbols = list(symbols)
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))

    def key(at: int) -> int:
        if at < 0 or after[at] >= n:
            return EMPTY
        found = pairs.get((symbols[at], symbols[after[at]]))
        return EMPTY if found is None else found[0] << 32 | at

    def put(at: int, value: int) -> None:
        node = at + size
        tree[node] = value
        while node > 1:
            node >>= 1
            left, right = tree[2 * node], tree[2 * node + 1]
            least = left if left < right else right
            if tree[node] == least:
                return
            tree[node] = least

    for at in range(n - 1):
        tree[size + at] = key(at)
    for node in range(size - 1, 0, -1):
        tree[node] = min(tree[2 * node], tree[2 * node + 1])
    while (least := tree[1]) < EMPTY:
        at = least & 0xFFFFFFFF
        gone = after[at]
        symbols[at] = pairs[symbols[at], symbols[gone]][1]
        symbols[gone] = -1
        after[at] = after[gone]
        if after[gone] < n:
            before[after[gone]] = at
        put(gone, EMPTY)
        put(at, key(at))
        if before[at] >= 0:
            put(before[at], key(before[at]))
    return [s for s in symbols if s >= 0]


class Pairs:
    """Which pairs merge, as a dictionary and as sorted arrays for many lookups at once."""

    def __init__(self, pairs: dict[tuple[int, int], tuple[int, int]]):
        self.of = pairs
        keys = np.array([a << 32 | b for a, b in pairs], np.int64)
        order = np.argsort(keys)
        self.keys = np.append(keys[order], np.iinfo(np.int64).max)
        self.ranks = np.append(np.array([r for r, _ in pairs.values()], np.int64)[order], 0)
        self.made = np.append(np.array([m for _, m in pairs.values()], np.int64)[order], 0)

    def look_up(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Whether each pair merges, and its place in ``ranks`` and ``made``."""
        keys = a << 32 | b
        at = np.searchsorted(self.keys, keys)
        return self.keys[at] == keys, at


def merge_many(symbols: np.ndarray, lengths: np.ndarray, pairs: Pairs) -> tuple[np.ndarray, np.ndarray]:
    """``merge_pairs`` for many words that lie one after the other in ``symbols``.

    Words of like length share numpy trees. Gives the symbols that are left,
    again one word after the other, and the words' new lengths.
    """
    starts = np.cumsum(lengths) - lengths
    left = np.ones(len(symbols), bool)
    symbols = symbols.copy()
    for i in np.flatnonzero(lengths > LONGEST).tolist():
        span = slice(starts[i], starts[i] + lengths[i])
        merged = merge_pairs(symbols[span].tolist(), pairs.of)
        symbols[starts[i]:starts[i] + len(merged)] = merged
        left[span] = np.arange(lengths[i]) < len(merged)
    size = 2
    while size <= LONGEST:
        members = np.flatnonzero((lengths > size // 2) & (lengths <= size) & (lengths > 1))
        for first in range(0, len(members), 8192):
            block = members[first:first + 8192]
            inside = np.arange(size) < lengths[block][:, None]
            places = (starts[block][:, None] + np.arange(size))[inside]
            merged = _merge_block(symbols[places], inside, lengths[block], pairs)[inside]
            symbols[places], left[places] = merged, merged >= 0
        size *= 2
    kept = np.concatenate([[0], np.cumsum(left)])
    return symbols[left], kept[starts + lengths] - kept[starts]


def _merge_block(given: np.ndarray, inside: np.ndarray, n: np.ndarray, pairs: Pairs) -> np.ndarray:
    """Words as rows of ``inside``; merged-away places become -1. All arrays are flat."""
    count, size = inside.shape
    symbols = np.full(count * size, -1, np.int64)
    symbols[inside.ravel()] = given
    row = np.arange(count) * size
    after = np.tile(np.arange(1, size + 1), count)
    before = np.tile(np.arange(-1, size - 1), count)
    tree = np.full((2 * size, count), EMPTY, np.int64)
    nodes = tree.ravel()

    def key(w: np.ndarray, at: np.ndarray) -> np.ndarray:
        """The leaf for the pair that starts at ``at`` in word ``w``."""
        right = after[row[w] + at]
        there = right < n[w]
        found, place = pairs.look_up(symbols[row[w] + at], symbols[row[w] + np.minimum(right, size - 1)])
        return np.where(found & there, pairs.ranks[place] << 32 | at, EMPTY)

    both = symbols.reshape(count, size)
    found, place = pairs.look_up(both[:, :-1], both[:, 1:])
    found &= inside[:, 1:]
    tree[size:2 * size - 1] = np.where(found, pairs.ranks[place] << 32 | np.arange(size - 1), EMPTY).T
    level = size
    while level > 1:
        level >>= 1
        tree[level:2 * level] = np.minimum(tree[2 * level:4 * level:2], tree[2 * level + 1:4 * level:2])
    w = np.flatnonzero(tree[1] < EMPTY)
    while len(w):
        at = tree[1, w] & 0xFFFFFFFF
        here = row[w] + at
        gone = after[here]
        _, place = pairs.look_up(symbols[here], symbols[row[w] + gone])
        symbols[here] = pairs.made[place]
        symbols[row[w] + gone] = -1
        right = after[row[w] + gone]
        after[here] = right
        more = right < n[w]
        before[(row[w] + right)[more]] = at[more]
        left = before[here]
        has_left = left >= 0
        wl, left = w[has_left], left[has_left]
        nodes[(size + gone) * count + w] = EMPTY
        nodes[(size + at) * count + w] = key(w, at)
        nodes[(size + left) * count + wl] = key(wl, left)
        for words, leaves in ((w, gone), (w, at), (wl, left)):
            node = leaves + size
            for _ in range(size.bit_length() - 1):
                node = node >> 1
                below = 2 * node * count + words
                nodes[node * count + words] = np.minimum(nodes[below], nodes[below + count])
        w = w[tree[1, w] < EMPTY]
    return symbols.reshape(count, size)


class Remembered:
    """Results by word, in two generations of bounded size.

    A word met again in a full table's successor is carried over; words that
    were not met meanwhile are forgotten and worked out anew.
    """

    def __init__(self, work: Callable[[list[str]], list], known: dict | None = None):
        self.work, self.known, self.results, self.old = work, known or {}, dict(known or {}), {}
        self.chars = 0

    def of(self, words: list[str]) -> Callable[[str], object]:
        """A lookup that has a result for each of ``words``."""
        if len(self.results) - len(self.known) > REMEMBERED or self.chars > REMEMBERED_CHARS:
            self.old, self.results, self.chars = self.results, dict(self.known), 0
        new = []
        for word in set(words).difference(self.results):
            self.chars += len(word)
            if (known := self.old.get(word)) is None:
                new.append(word)
            else:
                self.results[word] = known
        self.results.update(zip(new, self.work(new), strict=True))
        return self.results.__getitem__


class WordBpe:
    """A byte-level BPE vocabulary with word ends, its text rules included."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model = spec["model"]
        self.vocabulary: dict[str, int] = model["vocab"]
        self.end = model["end_of_word_suffix"] or ""
        pairs = {}
        for rank, pair in enumerate(model["merges"]):
            a, b = pair if isinstance(pair, list) else pair.split(" ")
            pairs[self.vocabulary[a], self.vocabulary[b]] = rank, self.vocabulary[a + b]
        self.pairs = Pairs(pairs)
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        names = {i: t for t, i in (self.vocabulary | self.special).items()}
        self.tokens = [names.get(i, "") for i in range(max(names) + 1)]
        self.inner = np.array([self.vocabulary[c] for c in byte_symbols()])
        self.last = np.array([self.vocabulary[c + self.end] for c in byte_symbols()])
        split = next(p for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")
        self.pieces = re.compile(spelled_out(split["pattern"]["Regex"]))
        # letters that Python's tables do not know yet are left to the library
        self.lower = normalizers.Lowercase()
        self.newer = re.compile("[" + "".join(
            c for c in every_character() if not c.isascii() and unicodedata.category(c) == "Cn"
            and self.lower.normalize_str(c) != c) + "\\U0010ffff]")
        self.specials = re.compile("|".join(f"({re.escape(t)})" for t in self.special) or "(?!)")
        self.ids = Remembered(self._words)

    def _words(self, words: list[str]) -> list[bytes]:
        """For each text without blanks its ids, as little-endian 32-bit integers."""
        pieces = [[p.encode("utf-8") for p in self.pieces.findall(word)] for word in words]
        flat = [p for word in pieces for p in word]
        data = np.frombuffer(b"".join(flat), np.uint8)
        lengths = np.array([len(p) for p in flat], np.int64)
        symbols = self.inner[data]
        ends = np.cumsum(lengths) - 1
        symbols[ends] = self.last[data[ends]]
        merged, left = merge_many(symbols, lengths, self.pairs)
        ids = merged.astype("<u4").tobytes()
        edges = 4 * np.concatenate([[0], np.cumsum(left)])
        words_at = np.cumsum([0, *map(len, pieces)])
        at = edges[words_at].tolist()
        return [ids[a:b] for a, b in zip(at, at[1:], strict=False)]

    def _parts(self, text: str) -> list[str | int]:
        """Words in the library's normal form; special tokens as their ids."""
        parts = []
        for part in self.specials.split(text) if "<" in text else [text]:
            if part in self.special:
                parts.append(self.special[part])
            elif part:
                part = unicodedata.normalize("NFC", part)
                # one character at a time, so that a final sigma is like any other
                if not part.isascii() and self.newer.search(part):
                    part = self.lower.normalize_str(part)
                part = part.replace("Σ", "σ").lower()
                parts += part.split() if not ODD_BLANKS.search(part) else BLANK.sub(" ", part).split(" ")
        return parts

    def encode_all(self, texts: list[str]) -> list[bytes]:
        """Ids of whole texts, as little-endian 32-bit integers."""
        parts = [self._parts(t) for t in texts]
        ids = self.ids.of([p for text in parts for p in text if isinstance(p, str)])
        return [b"".join([ids(p) if isinstance(p, str) else np.array([p], "<u4").tobytes()
                          for p in text]) for text in parts]

    def decode(self, ids: bytes) -> str:
        """Tokens with a space between them: these vocabularies name no decoder."""
        return " ".join(map(self.tokens.__getitem__, np.frombuffer(ids, "<u4").tolist()))


def every_character() -> str:
    return "".join(chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000)


def spelled_out(pattern: str) -> str:
    """A pattern with letters, numbers and blanks as ranges, for Python's ``re``.

    The ranges are those of the library's own Unicode tables, which are of
    another version than Python's.
    """
    every = every_character()
    for name in (r"\p{L}", r"\p{N}", r"\s"):
        runs = pre_tokenizers.Split(Regex(f"{name}+"), "removed", invert=True).pre_tokenize_str(every)
        ranges = "".join(f"\\U{ord(r[0]):08x}-\\U{ord(r[-1]):08x}" for r, _ in runs)
        pattern = pattern.replace(f"[{name}]", f"[{ranges}]").replace(name, ranges)
    return pattern


@lru_cache(maxsize=2)
def loaded(path: str) -> WordBpe:
    """One vocabulary per Python worker, read where it is used."""
    return WordBpe(path)


def encode(docs: DataFrame, path: str, text_column: str = "text", ids_column: str = "ids") -> DataFrame:
    """All columns, and the ids of the whole text as ``array<int>``."""
    def work():
        bpe = loaded(path)
        return lambda texts: [np.frombuffer(ids, "<u4").astype(np.int32)
                              for ids in bpe.encode_all([t or "" for t in texts])]

    return with_column(docs, text_column, ids_column, "array<int>", pa.list_(pa.int32()), work)


def decode(frame: DataFrame, path: str, ids_column: str = "ids", text_column: str = "decoded") -> DataFrame:
    """All columns, and the text of the ids."""
    def work():
        bpe = loaded(path)
        return lambda rows: [bpe.decode(np.array(ids or [], "<u4").tobytes()) for ids in rows]

    return with_column(frame, ids_column, text_column, "string", pa.string(), work)


DIGESTS = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids_sha256", pa.string()),
                     ("decoded_sha256", pa.string())])


def digests(docs: DataFrame, path: str, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Each row's number of tokens, and SHA-256 of its ids and of the text decoded from them."""
    def rows(batches):
        bpe = loaded(path)

        def found():
            for b in batches:
                doc_ids, texts = (c.to_pylist() for c in b.columns)
                encoded = bpe.encode_all([t or "" for t in texts])
                for doc_id, ids in zip(doc_ids, encoded, strict=True):
                    yield (doc_id, len(ids) // 4, hashlib.sha256(ids).hexdigest(),
                           hashlib.sha256(bpe.decode(ids).encode("utf-8")).hexdigest())
        yield from in_batches(found(), DIGESTS)

    given = docs.select(docs[f"`{id_column}`"].cast("long").alias("doc_id"),
                        docs[f"`{text_column}`"].cast("string").alias("text"))
    return given.mapInArrow(rows, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")


def round_trip(docs: DataFrame, path: str, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """doc_id, ids, n_tokens and the decoded text's SHA-256, encoded and decoded in one worker."""
    schema = pa.schema([("doc_id", pa.int64()), ("ids", pa.list_(pa.int32())), ("n_tokens", pa.int64()),
                        ("decoded_sha256", pa.string())])

    def rows(batches):
        bpe = loaded(path)
        for b in batches:
            encoded = bpe.encode_all([t or "" for t in b.column(1).to_pylist()])
            made = [hashlib.sha256(bpe.decode(ids).encode("utf-8")).hexdigest() for ids in encoded]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array([np.frombuffer(i, "<u4").astype(np.int32) for i in encoded],
                                       pa.list_(pa.int32())),
                 pa.array([len(i) // 4 for i in encoded], pa.int64()), pa.array(made, pa.string())],
                schema=schema)

    given = docs.select(docs[f"`{id_column}`"].cast("long").alias("doc_id"),
                        docs[f"`{text_column}`"].cast("string").alias("text"))
    return given.mapInArrow(rows, "doc_id long, ids array<int>, n_tokens long, decoded_sha256 string")


@query("op4_bpe_round_trip")
def op4(spark, sf_dir):
    """Every document encoded and decoded."""
    return digests(table(spark, sf_dir, "documents"), public_tokenizers.path(WORD_BPE))
