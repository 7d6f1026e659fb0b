"""Personal data: certain spans by pattern, further ones by boosted trees.

* Base spans (email, ip, card, phone) follow fixed patterns and checks. They
  always stay.
* Generators with high recall propose overlapping candidates: loose numbers,
  written-out mail addresses, long tokens, assigned values, account numbers.
* Gradient-boosted trees score each candidate by its format and by what stands
  around it. Candidates that cover a base span or pass their kind's own check
  are positive, all others negative. Candidates of all texts are counted by kind
  and label, and a bounded sample (``SAMPLE_CANDIDATES``) is drawn from each of
  these groups by a hash, small groups whole, so that no kind is lost to the
  others or to the number of texts. The trees are fitted on half of it.
* Scores are calibrated on the candidates of all texts that the trees have not
  seen, counted by kind, label and score in steps of 1 / ``STEPS``, each group
  scaled up by what the trees were given of it. Per generator the least score
  from which ``PRECISION`` of them is positive is the threshold; a generator
  that never gets there adds nothing.
* Of the candidates over the threshold the best are taken first, where no span
  overlaps another or a base span.

Defined results: null and empty texts have no spans. Fewer than 20
candidates in the sample, or one label only, add none. Rows are scanned each, so
repeated ids stay separate; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripengine.llm.common import in_batches, materialise, query, table, with_column

KINDS = ("email", "ip", "card", "phone")
#: What the generators propose, in the order in which spans are listed after the base kinds.
MORE = ("number", "mail", "token", "value", "account")
SAMPLE_CANDIDATES, PRECISION, STEPS = 40_000, 0.95, 256
TREES, DEPTH, RATE, BINS = 40, 3, 0.2, 32
#: Candidates scored together.
SCORED = 1 << 14

# Base patterns. A run of digits or local characters is entered at its start only and
# never given back: a later start in the same run would meet the same end.
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

# Generators.
NUMBER = re.compile(r"(?<![0-9])[+(]?[0-9](?:[\x20().\-/]{0,2}[0-9]){6,}+")
AT = re.compile(r"(?i)\x20?(?:\[at\]|\(at\)|\x20at\x20)\x20?")
DOTTED = re.compile(r"(?i)[a-z0-9-]{1,63}(?:\x20?(?:\.|\[dot\]|\(dot\)|\x20dot\x20)\x20?[a-z0-9-]{2,63})+")
NAME_BEFORE = re.compile(r"[A-Za-z0-9._%+-]{1,64}$")
TOKEN = re.compile(r"(?<![A-Za-z0-9_\-])[A-Za-z0-9_\-]{24,}+")
VALUE = re.compile(r"[:=]\x20?[\"']?([^\s\"'<>]{8,})")
ACCOUNT = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}(?![A-Za-z0-9])")
# Fixed word lists: what often stands before each sort of data.
CUES = (("tel", "phone", "call", "fax", "mobile"), ("mail", "contact", "write"),
        ("ip", "host", "server", "addr"), ("card", "visa", "credit", "pay"),
        ("token", "key", "secret", "passw", "pwd"), ("iban", "account", "ssn", "social"))

Span = tuple[str, int, int]
SCORE_ARROW = pa.schema([(n, pa.int64()) for n in ("kind", "step", "y", "n")])
CANDIDATE_ARROW = pa.schema([("kind", pa.int64()), ("y", pa.int64()), ("draw", pa.int64()), ("unseen", pa.bool_()),
                             ("x", pa.list_(pa.float64()))])


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        n = int(c) * (1 + i % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost matches: from the start of the local part's run to the longest domain."""
    end, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in LOCAL:
            start -= 1
        domain = DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            yield start, domain.end()
            end = domain.end()
        at = text.find("@", max(at + 1, end))


def base_spans(text: str) -> list[Span]:
    """Spans that need no model, by kind as listed, then by start."""
    spans = [("email", *s) for s in emails(text)] if "@" in text else []
    for m in IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p) <= 255 for p in m[0].split(".")):
            spans.append(("ip", *m.span()))
    for m in CARD.finditer(text):
        digits = _digits(m[0])
        if 13 <= len(digits) <= 19 and luhn(digits):
            spans.append(("card", *m.span()))
    if "+" in text:
        spans += [("phone", *m.span()) for m in PHONE.finditer(text) if 9 <= len(_digits(m[0])) <= 15]
    return spans


def candidates(text: str) -> list[Span]:
    """Proposals of all generators; they may overlap."""
    found = [("number", *m.span()) for m in NUMBER.finditer(text)]
    if "at" in text or "AT" in text or "At" in text:
        for m in AT.finditer(text):
            name = NAME_BEFORE.search(text, max(0, m.start() - 64), m.start())
            host = DOTTED.match(text, m.end())
            if name and host:
                found.append(("mail", name.start(), host.end()))
    found += [("token", *m.span()) for m in TOKEN.finditer(text)]
    if ":" in text or "=" in text:
        found += [("value", *m.span(1)) for m in VALUE.finditer(text)]
    return found + [("account", *m.span()) for m in ACCOUNT.finditer(text)]


def passes(kind: str, span: str, before: str) -> bool:
    """The check of a candidate's own kind, used for labels only."""
    if kind == "account":
        plain = span.replace(" ", "")
        return int("".join(str(int(c, 36)) for c in plain[4:] + plain[:4])) % 97 == 1
    if kind == "number":
        return re.fullmatch(r"[0-9]{3}-[0-9]{2}-[0-9]{4}", span) is not None
    if kind == "mail":
        return re.search(r"(?i)[(\[]at[)\]]", span) is not None
    digits = sum(c.isdigit() for c in span)
    mixed = len(span) >= 16 and digits >= 4 and digits < len(span) and span.isascii()
    return mixed and any(c in before.lower() for c in CUES[4])


def features(kind: str, text: str, start: int, end: int) -> list[float]:
    """Format of the span, and what stands around it."""
    span, before = text[start:end], text[max(0, start - 24):start]
    n, digits = end - start, sum("0" <= c <= "9" for c in span)
    letters, upper = sum(c.isalpha() for c in span), sum(c.isupper() for c in span)
    last, follows = before[-1:] or "\n", text[end:end + 1] or "\n"
    low = before.lower()
    all_digits = _digits(span)
    return [
        *(float(kind == k) for k in MORE), n, digits, digits / n, letters / n, upper / n,
        len(set(span)) / n, span.count("."), span.count("-"), span.count(" "), span.count("("),
        span.count("/"), float(span[0] == "+"), float("@" in span),
        float(13 <= digits <= 19 and luhn(all_digits)), float(all_digits[:1] in ("4", "5")),
        float(all(c in "0123456789abcdefABCDEF" for c in span)), float(last.isspace()),
        float(last in "\"'"), float(last in ":="), float(last.isalnum()), float(follows.isspace()),
        float(follows in "\"'"), float(follows in ".,;:!?"), float(follows.isalnum()),
        *(float(any(w in low for w in cue)) for cue in CUES),
    ]


WIDTH = len(features("token", "a", 0, 1))


class BoostedTrees:
    """Gradient boosting with logistic loss over binned features; trees of fixed depth."""

    def __init__(self, x: np.ndarray, y: np.ndarray, trees: int = TREES, depth: int = DEPTH):
        ranks = np.linspace(0, 1, BINS + 1)[1:-1]
        self.cuts = [np.unique(np.quantile(column, ranks)) for column in x.T]
        binned = self._binned(x)
        rate = np.clip(y.mean(), 1e-6, 1 - 1e-6)
        self.base, self.depth = float(np.log(rate / (1 - rate))), depth
        self.splits: list[tuple[np.ndarray, np.ndarray]] = []
        self.leaves: list[np.ndarray] = []
        score = np.full(len(y), self.base)
        for _ in range(trees):
            p = 1 / (1 + np.exp(-score))
            score += self._grow(binned, y - p, p * (1 - p))

    def _binned(self, x: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(c, column, side="left")
                         for c, column in zip(self.cuts, x.T, strict=True)], axis=1)

    def _grow(self, binned: np.ndarray, grad: np.ndarray, hess: np.ndarray) -> np.ndarray:
        count, wide = binned.shape
        node = np.zeros(count, np.int64)
        feature = np.zeros(2**self.depth - 1, np.int64)
        cut = np.full(2**self.depth - 1, BINS)  # everything to the left: no split
        for level in range(self.depth):
            first, width = 2**level - 1, 2**level
            cell = ((node * wide)[:, None] + np.arange(wide)) * BINS + binned
            shape = (width, wide, BINS)
            g = np.bincount(cell.ravel(), np.repeat(grad, wide), width * wide * BINS).reshape(shape).cumsum(2)
            h = np.bincount(cell.ravel(), np.repeat(hess, wide), width * wide * BINS).reshape(shape).cumsum(2)
            all_g, all_h = g[:, :, -1:], h[:, :, -1:]
            gain = g**2 / (h + 1) + (all_g - g)**2 / (all_h - h + 1) - all_g**2 / (all_h + 1)
            gain[(h < 1) | (all_h - h < 1)] = 0
            best = gain.reshape(width, -1).argmax(1)
            worth = gain.reshape(width, -1).max(1) > 1e-6
            feature[first:first + width] = np.where(worth, best // BINS, 0)
            cut[first:first + width] = np.where(worth, best % BINS, BINS)
            at = first + node
            node = 2 * node + (binned[np.arange(count), feature[at]] > cut[at])
        g, h = (np.bincount(node, v, 2**self.depth) for v in (grad, hess))
        leaf = RATE * g / (h + 1)
        self.splits.append((feature, cut))
        self.leaves.append(leaf)
        return leaf[node]

    def score(self, x: np.ndarray) -> np.ndarray:
        binned, rows = self._binned(x), np.arange(len(x))
        total = np.full(len(x), self.base)
        for (feature, cut), leaf in zip(self.splits, self.leaves, strict=True):
            node = np.zeros(len(x), np.int64)
            for level in range(self.depth):
                at = 2**level - 1 + node
                node = 2 * node + (binned[rows, feature[at]] > cut[at])
            total += leaf[node]
        return total


class Detector:
    """Trees with a threshold per generator; without either only base spans are found."""

    def __init__(self, trees: BoostedTrees | None = None):
        self.trees, self.least = trees, np.full(len(MORE), np.inf)

    def calibrate(self, kind: np.ndarray, step: np.ndarray, y: np.ndarray, n: np.ndarray) -> Detector:
        """Thresholds from counts ``n`` by kind, score step and label."""
        for k in range(len(MORE)):
            steps, at = np.unique(-step[kind == k], return_inverse=True)
            every = np.bincount(at, n[kind == k], len(steps)).cumsum()
            good = np.bincount(at, (n * y)[kind == k], len(steps)).cumsum()
            precise = np.flatnonzero((good >= PRECISION * every) & (good > 0))
            if len(precise):
                self.least[k] = -steps[precise[-1]] / STEPS
        return self

    def spans(self, texts: list[str]) -> list[tuple[list[Span], list[Span]]]:
        """Base spans and added spans of each text."""
        base = [base_spans(t) for t in texts]
        proposed = [(i, *c) for i, t in enumerate(texts) for c in candidates(t)] if self.trees else []
        added: list[list[Span]] = [[] for _ in texts]
        if proposed:
            score = np.concatenate([self.trees.score(np.array(
                [features(k, texts[i], a, b) for i, k, a, b in proposed[at:at + SCORED]]))
                for at in range(0, len(proposed), SCORED)])
            chosen = np.flatnonzero(score >= self.least[[MORE.index(c[1]) for c in proposed]])
            taken: dict[int, bytearray] = {}  # a mark for each character that a span covers
            for j in chosen[np.lexsort((chosen, -score[chosen]))].tolist():
                i, kind, a, b = proposed[j]
                if i not in taken:
                    taken[i] = bytearray(len(texts[i]))
                    for _, c, d in base[i]:
                        taken[i][c:d] = b"\1" * (d - c)
                if taken[i].find(1, a, b) < 0:
                    taken[i][a:b] = b"\1" * (b - a)
                    added[i].append((kind, a, b))
        return list(zip(base, added, strict=True))


def _given(docs: DataFrame, id_column: str, text_column: str) -> DataFrame:
    return docs.select(F.col(f"`{id_column}`").cast("long").alias("doc_id"),
                       F.col(f"`{text_column}`").cast("string").alias("text"))


class Covering:
    """Which stretches of a text are mostly covered by one of its base spans."""

    def __init__(self, base: list[Span]):
        # spans of one kind do not overlap, so those that touch a stretch follow one another
        own = [[(a, b) for k, a, b in base if k == kind] for kind in KINDS]
        self.spans = [(spans, [a for a, _ in spans]) for spans in own if spans]

    def of(self, a: int, e: int) -> bool:
        for spans, starts in self.spans:
            at = max(bisect_right(starts, a) - 1, 0)
            while at < len(spans) and spans[at][0] < e:
                both = min(e, spans[at][1]) - max(a, spans[at][0])
                if both > 0 and both >= 0.8 * (e - a):
                    return True
                at += 1
        return False


def _labelled(batch: pa.RecordBatch) -> Iterator[tuple[str, int, int, str, int, int]]:
    """Candidates with their text, label and a hash of 64 bits."""
    for doc_id, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
        covering = Covering(base_spans(text))
        for kind, a, e in candidates(text):
            good = covering.of(a, e) or passes(kind, text[a:e], text[max(0, a - 24):a])
            own = f"{doc_id}:{kind}:{a}:{text[a:e]}".encode("utf-8", "surrogatepass")
            yield kind, a, e, text, int(good), int.from_bytes(hashlib.blake2b(own, digest_size=8).digest(), "big")


def _shares(counts: dict[tuple[int, int], int], most: int) -> dict[tuple[int, int], float]:
    """The share of each group in a sample of ``most``: even numbers, small groups whole."""
    shares, left = {}, most
    for i, (group, n) in enumerate(sorted(counts.items(), key=lambda c: (c[1], c[0]))):
        taken = min(n, left / (len(counts) - i))
        shares[group] = taken / n
        left -= taken
    return shares


def labelled_candidates(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """kind (its place in ``MORE``), y, draw, unseen and features x of all candidates; a written table."""
    def found(batches):
        def rows():
            for b in batches:
                for kind, a, e, text, y, draw in _labelled(b):
                    yield MORE.index(kind), y, draw >> 1, bool(draw & 1), features(kind, text, a, e)
        yield from in_batches(rows(), CANDIDATE_ARROW)

    rows = _given(docs, id_column, text_column).where("text IS NOT NULL")
    return materialise(rows.mapInArrow(found, "kind long, y long, draw long, unseen boolean, x array<double>"),
                       "candidates")


def fit(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text",
        sample_candidates: int = SAMPLE_CANDIDATES) -> Detector:
    """The detector: trees from a bounded sample per kind and label, thresholds from all rows.

    Texts are read once, for the table of candidates that everything else reads.
    """
    every = labelled_candidates(docs, id_column, text_column)
    counts = {(r.kind, r.y): r["count"] for r in every.groupBy("kind", "y").count().collect()}
    shares = _shares(counts, sample_candidates)
    share = F.lit(0.0)
    for (kind, y), own in shares.items():
        share = F.when((F.col("kind") == kind) & (F.col("y") == y), own).otherwise(share)
    every = every.withColumn("drawn", F.shiftright("draw", 11) < share * F.lit(float(1 << 52)))
    kept = every.where("drawn").select("draw", "unseen", F.col("y").cast("double").alias("y"), "x") \
        .toArrow()  # bounded by the shares; put in order here, as a sort by range would run the pass twice
    x = np.array(kept.column("x").to_pylist(), float).reshape(-1, WIDTH)
    y, half = kept.column("y").to_numpy(), ~kept.column("unseen").to_numpy().astype(bool)
    order = np.lexsort((*x.T, y, half, kept.column("draw").to_numpy()))
    x, y, half = x[order], y[order], half[order]
    if len(y) < 20 or len(np.unique(y[half])) < 2:
        return Detector()
    trees = BoostedTrees(x[half], y[half])
    shared = docs.sparkSession.sparkContext.broadcast(trees)

    def scored(batches):
        held: Counter = Counter()
        for b in batches:
            if len(b):
                x = b.column("x").flatten().to_numpy().reshape(-1, WIDTH)
                steps = np.floor(shared.value.score(x) * STEPS).astype(np.int64)
                held.update(zip(b.column("kind").to_pylist(), steps.tolist(), b.column("y").to_pylist(), strict=True))
        yield from in_batches(((*key, n) for key, n in held.items()), SCORE_ARROW)

    found = every.where("unseen OR NOT drawn").select("kind", "y", "x") \
        .mapInArrow(scored, "kind long, step long, y long, n long") \
        .groupBy("kind", "step", "y").agg(F.sum("n").alias("n")).toArrow()  # a row per score step at most
    kind, step, label, n = (found.column(c).to_numpy() for c in ("kind", "step", "y", "n"))
    scale = [1 / (1 - shares[k, v] / 2) for k, v in zip(kind.tolist(), label.tolist(), strict=True)]
    return Detector(trees).calibrate(kind, step, label, n * np.array(scale, float))


def _listed(spans: list[Span], kinds: tuple[str, ...]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in sorted(spans, key=lambda s: (kinds.index(s[0]), s[1])))


RESULT = "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string"
RESULT_ARROW = pa.schema([("doc_id", pa.int64()), *((f"n_{k}", pa.int64()) for k in KINDS),
                          ("base_sha256", pa.string()), ("spans", pa.string())])


def find(docs: DataFrame, detector: Detector, id_column: str = "doc_id",
         text_column: str = "text") -> DataFrame:
    """doc_id, base spans by kind, their digest, and all spans of every row."""
    shared = docs.sparkSession.sparkContext.broadcast(detector)

    def rows(batches):
        def found():
            for b in batches:
                texts = [t or "" for t in b.column(1).to_pylist()]
                for doc_id, (base, added) in zip(b.column(0).to_pylist(), shared.value.spans(texts), strict=True):
                    listed = _listed(base, KINDS)
                    yield (doc_id, *(sum(s[0] == k for s in base) for k in KINDS),
                           hashlib.sha256(listed.encode()).hexdigest(), _listed(base + added, KINDS + MORE))
        yield from in_batches(found(), RESULT_ARROW)

    return _given(docs, id_column, text_column).mapInArrow(rows, RESULT)


def redact(docs: DataFrame, detector: Detector, text_column: str = "text") -> DataFrame:
    """The documents with each span replaced by its kind in brackets; all columns stay."""
    shared = docs.sparkSession.sparkContext.broadcast(detector)

    def hidden(text: str, spans: list[Span]) -> str:
        parts, at = [], 0
        for kind, a, b in sorted(spans, key=lambda s: (s[1], -s[2])):
            if b > at:  # base spans of different kinds may overlap
                parts += [text[at:max(at, a)], f"[{kind}]" if a >= at else ""]
                at = b
        return "".join([*parts, text[at:]])

    def work():
        return lambda texts: [t if t is None else hidden(t, [*base, *added]) for t, (base, added) in zip(
            texts, shared.value.spans([t or "" for t in texts]), strict=True)]

    return with_column(docs, text_column, text_column, "string", pa.string(), work)


@query("op10_pii_spans")
def op10(spark, sf_dir):
    """Personal data in every document."""
    docs = table(spark, sf_dir, "documents")
    return find(docs, fit(docs))
