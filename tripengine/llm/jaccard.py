"""Near-duplicates by an exact Jaccard join over word n-grams, with PartEnum signatures.

Two sets link when their intersection is at least ``percent`` of their union.
For sets in neighbouring bands of size that bounds the number of features in
which they differ by some k. The domain of features is dealt out into more
than k parts, so two linked sets agree in at least one part, and share the
signature made of that part's features.

* Bands: a band's sizes reach up to the largest partner of its least size, so
  partners lie in the same band or the next. A set has signatures for its own
  band and, if it can have partners there, for the next one.
* Parts: k + 1 and some more, so that linked sets agree in several. A part
  without features says nothing and is left out if fewer parts of the set are
  empty than parts must agree; otherwise its signature stands, so nothing is lost.
* Second level: with ``SPARE`` > 0 each part is dealt out again, and every
  subset of ``PIECES`` - ``SPARE`` pieces is a signature; fewer parts then do.

From signatures to links:

1. Equal sets are one class from the start (``sets``).
2. Signatures meet in one shuffle. Signatures frequent within a task are
   taken out of it: one member stands for them, the others are attached to it
   and dealt out by member. So no task receives a group whole.
3. Star: each member of a group is paired with one of them, picked by a hash
   that differs from group to group. Pairs must pass the size bound and a
   parity sketch, which never rejects a link. What is left is compared exactly,
   on sets worked out anew from whole texts.
4. More stars: while a large group is left in several components, its members
   are paired with a few more of them, from components drawn anew each round,
   until a round finds few links. A round has rows by the members, not by their
   pairs, and the components that it joins need no further comparison.
5. Rest: in groups that the links found so far leave in several components,
   members of different components are compared, in blocks of bounded size,
   first by sketch, then exactly. Of a large group only the members whose
   sketches leave a partner get their whole sets, are compared in their block
   and give the links that join its components, so that pairs never become
   rows. So every pair that shares a signature is either compared, or known to
   be connected, or ruled out by a bound.

Features are 64-bit hashes of n-grams, and classes 64-bit hashes of sets.

Defined results: texts without words and null texts have the empty set, are
linked with nothing and are a component of their own. A text with fewer words
than ``width`` has one feature, its whole sequence of words. Rows that repeat
an id are one node of the graph for each different set. Rows with a null id
take part and come after all others. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache, reduce
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripengine.llm.common import in_batches, materialise, query, ready, table, words
from tripengine.llm.components import components

#: Second-level pieces of a part, and how many of them may differ.
PIECES, SPARE = 1, 0
#: Signatures a task looks at together, how many equal ones count as frequent there,
#: and members of a block that are compared with each other.
LOOK, FREQUENT, BLOCK = 1 << 18, 24, 1024
#: Features that the sets of a block have together at most.
BLOCK_FEATURES = 1 << 22
#: Members from which on a group is large, and how many of them each other one meets in a round.
LARGE, PIVOTS = 32, 8
#: Links of a round for each of its members, up to which no further round is made.
FEW_LINKS = 0.1
WORDS_KEPT = 1 << 16

U64 = np.uint64
SET_ARROW = pa.schema([("doc_id", pa.int64()), ("row_id", pa.int64()), ("sid", pa.int64()), ("n", pa.int64()),
                       ("sketch", pa.binary())])
SIGNATURE = "sig long, spread int, sid long, other long"
SIGNATURE_ARROW = pa.schema([("sig", pa.int64()), ("spread", pa.int32()), ("sid", pa.int64()), ("other", pa.int64())])
MARK = "sig long, x int, y int, sid long, root long, own int"
MARK_ARROW = pa.schema([("sig", pa.int64()), ("x", pa.int32()), ("y", pa.int32()), ("sid", pa.int64()),
                        ("root", pa.int64()), ("own", pa.int32())])
PAIR_ARROW = pa.schema([("a", pa.int64()), ("b", pa.int64())])


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads all bits."""
    x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


class Features:
    """Sets of n-gram hashes; hashes of words are remembered up to a bound."""

    def __init__(self, width: int):
        self.width, self.known = width, {}

    def of(self, text: str) -> np.ndarray:
        """Sorted distinct features."""
        own = words(text)
        if not own:
            return np.empty(0, U64)
        known = self.known
        if len(known) > WORDS_KEPT:
            known.clear()
        hashes = []
        for w in own:
            h = known.get(w)
            if h is None:
                h = xxhash.xxh64_intdigest(w)
                if len(w) <= 64:
                    known[w] = h
            hashes.append(h)
        h = np.array(hashes, U64)
        n = min(self.width, len(h))
        gram = np.full(len(h) - n + 1, n, U64)
        for i in range(n):
            gram = mixed(gram + h[i:len(h) - n + 1 + i])
        return np.unique(gram)


def set_id(features: np.ndarray) -> int:
    return np.frombuffer(xxhash.xxh3_64_digest(features.tobytes()), np.int64)[0].item()


class Scheme:
    """Bands, parts and bounds for one similarity."""

    def __init__(self, percent: int):
        self.percent = percent

    def most_different(self, total: int) -> int:
        """In how many features linked sets of ``total`` features together differ at most."""
        return total * (100 - self.percent) // (100 + self.percent)

    def band(self, n: int) -> tuple[int, int, int]:
        """Number, least and largest size of the band that holds size ``n``."""
        bands = _bands(self.percent, n.bit_length())
        at = int(np.searchsorted(bands, n, side="right")) - 1
        return at, int(bands[at]), int(bands[at + 1]) - 1

    def instances(self, n: int) -> list[tuple[int, int]]:
        """Number and largest size of each band in which the set needs signatures."""
        at, _, top = self.band(n)
        found = [(at, top)]
        if 100 * n // self.percent > top:
            found.append((at + 1, self.band(top + 1)[2]))
        return found

    def signatures(self, features: np.ndarray) -> np.ndarray:
        place = features & U64(0xFFFFFFFF)
        order = np.argsort(place)
        place, value = place[order], mixed(features[order])
        return np.concatenate([self._in_band(place, value, *x) for x in self.instances(len(features))])

    def _in_band(self, place: np.ndarray, value: np.ndarray, band: int, top: int) -> np.ndarray:
        k = self.most_different(2 * top)
        groups = -(-(k + 1) // (SPARE + 1))
        more = 0 if k == 0 else 2 + groups // 12
        parts = (groups + more) * PIECES
        part = ((place * U64(parts)) >> U64(32)).astype(np.int64)
        filled, first = np.unique(part, return_index=True)
        sums = np.zeros(parts, U64)
        sums[filled] = np.add.reduceat(value, first)
        sizes = np.bincount(part, minlength=parts)
        seed = U64(band << 32)
        if PIECES > 1:
            chosen = list(combinations(range(PIECES), PIECES - SPARE))
            grid = sums.reshape(-1, PIECES)
            held = sizes.reshape(-1, PIECES)
            sums = np.stack([mixed(grid[:, c] + np.arange(1, len(c) + 1, dtype=U64)).sum(axis=1)
                             for c in map(list, chosen)], 1).ravel()
            sizes = np.stack([held[:, c].sum(axis=1) for c in map(list, chosen)], 1).ravel()
        number = np.arange(len(sums), dtype=U64)
        found = mixed(mixed(sums + number) ^ mixed(number + seed))
        empty = sizes == 0
        # linked sets agree in more parts than are empty, so one that is not empty is among them
        if PIECES == 1 and empty.sum() < parts - k:
            found = found[~empty]
        return found.view(np.int64)

    def sketch(self, features: np.ndarray) -> bytes:
        """Parity of the features that fall on each bit; grows with what may differ."""
        size = sketch_bits(self.most_different(2 * len(features)))
        bits = np.bincount((features >> U64(32)).astype(np.int64) & (size - 1), minlength=size) & 1
        return np.packbits(bits.astype(np.uint8)).tobytes()

    def may_link(self, n: np.ndarray, m: np.ndarray, different: np.ndarray) -> np.ndarray:
        """No linked pair fails: sketches differ in no more bits than sets in features."""
        low, high = np.minimum(n, m), np.maximum(n, m)
        return (100 * low >= self.percent * high) & (different * (100 + self.percent)
                                                     <= (n + m) * (100 - self.percent))

    def link(self, a: np.ndarray, b: np.ndarray) -> bool:
        common = len(np.intersect1d(a, b, assume_unique=True))
        return 100 * common >= self.percent * (len(a) + len(b) - common)


@lru_cache(maxsize=8)
def _bands(percent: int, bits: int) -> np.ndarray:
    """The least size of each band, one beyond any size of so many bits."""
    starts, least = [0], 1
    while least < 4 << bits:
        starts.append(least)
        least = max(least, 100 * least // percent) + 1
    return np.array([*starts, least])


def sketch_bits(k: int) -> int:
    return max(128, 1 << (4 * k).bit_length())


def folded(sketch: np.ndarray, size: int) -> np.ndarray:
    """A sketch (bytes) brought down to ``size`` bytes: parities of its folds."""
    return np.bitwise_xor.reduce(sketch.reshape(-1, size), axis=0)


def differing(one: bytes, other: bytes) -> int:
    a, b = np.frombuffer(one, np.uint8), np.frombuffer(other, np.uint8)
    size = min(len(a), len(b))
    # bits are dealt out by their last digits, so the fold takes every size-th bit
    return int(np.bitwise_count(folded(a, size) ^ folded(b, size)).sum())


def _given(docs: DataFrame, id_column: str, text_column: str) -> DataFrame:
    return docs.select(F.col(f"`{id_column}`").cast("long").alias("doc_id"),
                       F.col(f"`{text_column}`").cast("string").alias("text"))


def with_row_id(rows: DataFrame) -> DataFrame:
    """The rows with a hash of id and text, by which a set finds its text again: many rows
    may lack an id or share one, but those with one text need looking at once."""
    return rows.withColumn("row_id", F.xxhash64("doc_id", "text"))


def sets(docs: DataFrame, width: int, percent: int, id_column: str = "doc_id",
         text_column: str = "text") -> DataFrame:
    """doc_id, row_id, sid, n and sketch of every row; sid is null for the empty set. A written table."""
    def rows(batches):
        features, scheme = Features(width), Scheme(percent)

        def found():
            for b in batches:
                for doc_id, text, row_id in zip(*(c.to_pylist() for c in b.columns), strict=True):
                    own = features.of(text or "")
                    yield (doc_id, row_id, set_id(own), len(own), scheme.sketch(own)) if len(own) \
                        else (doc_id, row_id, None, 0, None)
        yield from in_batches(found(), SET_ARROW)

    given = with_row_id(_given(docs, id_column, text_column))
    return materialise(given.mapInArrow(
        rows, "doc_id long, row_id long, sid long, n long, sketch binary"), "sets")


def signature_groups(docs: DataFrame, width: int, percent: int, id_column: str = "doc_id",
                     text_column: str = "text") -> DataFrame:
    """sig, sid and other (a member to compare with) for signatures of several sets; written."""
    def taken_out(sig: np.ndarray, sid: np.ndarray) -> pa.RecordBatch:
        """Frequent signatures keep one member; the others are attached to it."""
        order = np.lexsort((mixed((sid ^ sig).view(U64)), sig))
        sig, sid = sig[order], sid[order]
        starts = np.flatnonzero(np.concatenate([[True], sig[1:] != sig[:-1]]))
        sizes = np.diff(np.append(starts, len(sig)))
        run = np.repeat(np.arange(len(starts)), sizes)
        frequent = (sizes >= FREQUENT)[run]
        lead = sid[starts][run]
        attached = frequent.copy()
        attached[starts] = False
        spread = np.where(attached, (mixed(sid.view(U64)) >> U64(40)).astype(np.int64) + 1, 0)
        return pa.RecordBatch.from_arrays(
            [pa.array(sig), pa.array(spread.astype(np.int32)), pa.array(sid),
             pa.array(lead, mask=~frequent)], schema=SIGNATURE_ARROW)

    def made(batches):
        features, scheme, seen = Features(width), Scheme(percent), set()
        sigs, sids, held = [], [], 0
        for b in batches:
            for text in b.column(1).to_pylist():
                own = features.of(text or "")
                if not len(own) or (sid := set_id(own)) in seen:
                    continue
                if len(seen) >= LOOK:
                    seen.clear()
                seen.add(sid)
                found = scheme.signatures(own)
                sigs.append(found)
                sids.append(np.full(len(found), sid))
                held += len(found)
                if held >= LOOK:
                    out = taken_out(np.concatenate(sigs), np.concatenate(sids))
                    yield from (out.slice(i, 1 << 16) for i in range(0, len(out), 1 << 16))
                    sigs, sids, held = [], [], 0
        if held:
            out = taken_out(np.concatenate(sigs), np.concatenate(sids))
            yield from (out.slice(i, 1 << 16) for i in range(0, len(out), 1 << 16))

    def grouped(batches):
        """Rows come sorted by signature; a run may go on in the next block."""
        last = None  # signature and spread of the open run, its first member, whether it is out
        for sig, spread, sid, other, has in _blocks(batches):
            new = np.concatenate([[True], (sig[1:] != sig[:-1]) | (spread[1:] != spread[:-1])])
            goes_on = last is not None and (sig[0], spread[0]) == last[:2]
            if goes_on:
                new[0] = False
            starts = np.flatnonzero(new)
            run = np.cumsum(new) - 1 + goes_on
            first = sid[starts]
            if goes_on:
                first = np.concatenate([[last[2]], first])
            sizes = np.bincount(run, minlength=len(first))
            if goes_on:
                sizes[0] += 1
            marked = np.bincount(run, has, minlength=len(first)) > 0
            out = ((sizes > 1) | marked)[run]
            lead = np.where(spread > 0, other, first[run])
            keep_sig, keep_sid, keep_other = sig[out], sid[out], lead[out]
            if goes_on and not last[3]:
                keep_sig = np.concatenate([[last[0]], keep_sig])
                keep_sid = np.concatenate([[last[2]], keep_sid])
                keep_other = np.concatenate([[last[2]], keep_other])
            if len(keep_sig):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(x, pa.int64()) for x in (keep_sig, keep_sid, keep_other)],
                    names=["sig", "sid", "other"])
            last = sig[-1], spread[-1], first[run[-1]], bool(out[-1])

    given = _given(docs, id_column, text_column).mapInArrow(made, SIGNATURE)
    met = given.repartition("sig", "spread").sortWithinPartitions(
        "sig", "spread", F.xxhash64("sig", "sid"), "sid")
    return materialise(met.mapInArrow(grouped, "sig long, sid long, other long"), "signatures")


def _blocks(batches: Iterator[pa.RecordBatch], least: int = 1 << 16):
    """Many small batches as few large blocks of numpy columns."""
    def block(held):
        t = pa.Table.from_batches(held)
        other = t.column("other")
        return (t.column("sig").to_numpy(), t.column("spread").to_numpy(), t.column("sid").to_numpy(),
                other.fill_null(0).to_numpy(), other.is_valid().to_numpy())

    held, rows = [], 0
    for b in batches:
        if len(b):
            held.append(b)
            rows += len(b)
        if rows >= least:
            yield block(held)
            held, rows = [], 0
    if held:
        yield block(held)


def passing(pairs: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) that size and sketch leave open."""
    one = classes.select(F.col("sid").alias("a"), F.col("n").alias("n_a"), F.col("sketch").alias("s_a"))
    two = classes.select(F.col("sid").alias("b"), F.col("n").alias("n_b"), F.col("sketch").alias("s_b"))
    sized = pairs.join(one, "a").join(two, "b").where(
        f"100 * least(n_a, n_b) >= {percent} * greatest(n_a, n_b)")

    def rows(batches):
        scheme = Scheme(percent)
        for b in batches:
            n, m = (b.column(x).to_numpy() for x in ("n_a", "n_b"))
            d = np.array([differing(x, y) for x, y in zip(
                b.column("s_a").to_pylist(), b.column("s_b").to_pylist(), strict=True)], np.int64)
            keep = pa.array(scheme.may_link(n, m, d) if len(d) else [], pa.bool_())
            yield pa.RecordBatch.from_arrays(
                [b.column("a").filter(keep), b.column("b").filter(keep)], schema=PAIR_ARROW)

    return sized.select("a", "b", "n_a", "n_b", "s_a", "s_b").mapInArrow(rows, "a long, b long")


def features_of(wanted: DataFrame, docs: DataFrame, classes: DataFrame, width: int,
                id_column: str, text_column: str) -> DataFrame:
    """sid and features of the wanted sets, out of whole texts; a written table."""
    one_each = wanted.join(classes, "sid").select("sid", "row_id")
    texts = with_row_id(_given(docs, id_column, text_column))

    def made(batches):
        features = Features(width)
        for b in batches:
            sids, found = b.column("sid").to_pylist(), []
            for text in b.column("text").to_pylist():
                found.append(features.of(text or ""))
            # two texts may share a hash
            keep = [i for i, own in enumerate(found) if len(own) and set_id(own) == sids[i]]
            yield pa.RecordBatch.from_arrays(
                [pa.array([sids[i] for i in keep], pa.int64()),
                 pa.array([found[i].tobytes() for i in keep], pa.binary())], names=["sid", "features"])

    held = texts.join(one_each, "row_id").select("sid", "text").mapInArrow(made, "sid long, features binary")
    return materialise(held.dropDuplicates(["sid"]), "features")


def linking(pairs: DataFrame, held: DataFrame, percent: int) -> DataFrame:
    """The pairs that link, by their whole sets; a written table."""
    one = held.select(F.col("sid").alias("a"), F.col("features").alias("f_a"))
    two = held.select(F.col("sid").alias("b"), F.col("features").alias("f_b"))

    def compared(batches):
        scheme = Scheme(percent)
        for b in batches:
            keep = pa.array([scheme.link(np.frombuffer(x, U64), np.frombuffer(y, U64)) for x, y in zip(
                b.column("f_a").to_pylist(), b.column("f_b").to_pylist(), strict=True)], pa.bool_())
            yield pa.RecordBatch.from_arrays(
                [b.column("a").filter(keep), b.column("b").filter(keep)], schema=PAIR_ARROW)

    both = pairs.join(one, "a").join(two, "b").select("a", "b", "f_a", "f_b")
    return materialise(both.mapInArrow(compared, "a long, b long"), "links")


def verified(pairs: DataFrame, docs: DataFrame, classes: DataFrame, width: int, percent: int,
             id_column: str, text_column: str) -> DataFrame:
    """The pairs that link, by their whole sets; a written table."""
    pairs = materialise(pairs, "pairs")
    wanted = pairs.select(F.col("a").alias("sid")).unionByName(pairs.select(F.col("b").alias("sid"))).distinct()
    return linking(pairs, features_of(wanted, docs, classes, width, id_column, text_column), percent)


def more_stars(groups: DataFrame, roots: DataFrame, docs: DataFrame, classes: DataFrame, width: int,
               percent: int, id_column: str, text_column: str) -> list[DataFrame]:
    """Links between components within large groups, a written table a round.

    In a round each set takes part in one of its groups, the one whose hash is
    least, so that sets with groups in common meet. ``PIVOTS`` components are
    drawn for each such group, and one member of each; all other components'
    members meet these. So a round has rows by the sets, however many groups a
    set is in. Rounds end when one finds few links. Components that it joined
    become one.
    """
    large = groups.groupBy("sig").agg(F.count("*").alias("m")).where(F.col("m") >= LARGE).select("sig")
    labelled = materialise(groups.select("sig", "sid").distinct().join(large, "sig").join(
        roots.select(F.col("node").alias("sid"), "root"), "sid", "left").select(
        "sig", "sid", F.coalesce("root", "sid").alias("root")), "members")

    def several(rows: DataFrame) -> DataFrame:
        return rows.groupBy("sig").agg(F.min("root").alias("lo"), F.max("root").alias("hi")) \
            .where("lo <> hi").select("sig")

    members = materialise(labelled.join(several(labelled), "sig"), "members")
    if members.isEmpty():
        return []
    held = features_of(members.select("sid").distinct(), docs, classes, width, id_column, text_column)
    found, turn = [], 0
    while True:
        taking = members.groupBy("sid").agg(
            F.min(F.struct(F.xxhash64("sig", F.lit(turn)).alias("h"), "sig", "root")).alias("one")).select(
            "sid", "one.sig", "one.root")
        turns = range(turn * PIVOTS, (turn + 1) * PIVOTS)
        drawn = [F.min(F.struct(F.xxhash64("root", F.lit(n)).alias("r"), F.xxhash64("sid", F.lit(n)).alias("s"),
                                "root", "sid")).alias(f"p{n}") for n in turns]
        pivots = members.join(taking.select("sig").distinct(), "sig").groupBy("sig").agg(*drawn).select(
            "sig", F.array_distinct(F.array(*[F.struct(f"p{n}.root", f"p{n}.sid") for n in turns])).alias("pivots"))
        pairs = taking.join(pivots, "sig").select("sid", F.explode(
            F.filter("pivots", lambda p: p.root != F.col("root"))).alias("pivot")).select(
            F.least("sid", "pivot.sid").alias("a"), F.greatest("sid", "pivot.sid").alias("b")).distinct()
        new = linking(passing(pairs, classes, percent), held, percent)
        links = new.count()
        if links:
            found.append(new)
        if links <= FEW_LINKS * members.select("sid").distinct().count():
            return found
        known = members.select("sid", "root").distinct()
        joined = new.join(known.withColumnsRenamed({"sid": "a", "root": "x"}), "a").join(
            known.withColumnsRenamed({"sid": "b", "root": "y"}), "b").select("x", "y")
        merged = components(joined).select(F.col("root").alias("top"), F.col("node").alias("root"))
        members = members.join(merged, "root", "left").select("sig", "sid", F.coalesce("top", "root").alias("root"))
        members = materialise(members, "members")
        members = materialise(members.join(several(members), "sig"), "members")
        turn += 1


def open_cells(groups: DataFrame, roots: DataFrame, classes: DataFrame) -> DataFrame:
    """Members, by cell, of the groups that are left in several components; ``m`` is the group's size. Written.

    Members of a large group fall into blocks, and each pair of blocks is a cell of bounded size.
    """
    labelled = materialise(groups.select("sig", "sid").join(
        roots.select(F.col("node").alias("sid"), "root"), "sid", "left").join(classes.select("sid", "n"), "sid").select(
        "sig", "sid", "n", F.coalesce("root", "sid").alias("root")), "labelled")
    open_ = labelled.groupBy("sig").agg(
        F.min("root").alias("lo"), F.max("root").alias("hi"), F.count("*").alias("m"),
        F.max("n").alias("most")).where("lo <> hi").select("sig", "m", "most")
    # sizes within a group are alike, so its largest set bounds a block's features
    blocks = F.ceil(F.greatest(F.col("m") / BLOCK, F.col("m") * F.col("most") / BLOCK_FEATURES)).cast("int")
    own = F.pmod(F.xxhash64("sid"), F.col("blocks")).cast("int")
    return materialise(labelled.join(open_, "sig").withColumn("blocks", blocks).withColumn("own", own)
                       .withColumn("facing", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
                       .select("sig", "m", "sid", "root", "own", F.least("own", "facing").alias("x"),
                               F.greatest("own", "facing").alias("y")), "cells")


def by_cell(rows: DataFrame, *columns: str) -> DataFrame:
    """The members of a cell in one task, one after another."""
    return rows.repartition("sig", "x", "y").sortWithinPartitions("sig", "x", "y").select("sig", "x", "y", *columns)


def _cells(batches: Iterator[pa.RecordBatch], *names: str) -> Iterator[tuple[tuple, list[list]]]:
    """Each cell's key and columns, out of batches sorted by cell."""
    held, key = [], None
    for batch in batches:
        keys = zip(*(batch.column(c).to_pylist() for c in ("sig", "x", "y")), strict=True)
        for new, row in zip(keys, zip(*(batch.column(c).to_pylist() for c in names), strict=True), strict=True):
            if new != key:
                if held:
                    yield key, [list(c) for c in zip(*held, strict=True)]
                key, held = new, []
            held.append(row)
    if held:
        yield key, [list(c) for c in zip(*held, strict=True)]


def open_pairs(scheme: Scheme, n: np.ndarray, root: np.ndarray, own: np.ndarray, sketches: list[bytes],
               facing: bool) -> Iterator[tuple[int, np.ndarray]]:
    """Each member's place, and the later ones of other components that size and sketch leave open.

    ``root`` may change between two members.
    """
    size = min(map(len, sketches))
    bits = np.stack([folded(np.frombuffer(s, np.uint8), size) for s in sketches])
    for i in range(len(n) - 1):
        d = np.bitwise_count(bits[i + 1:] ^ bits[i]).sum(axis=1, dtype=np.int64)
        ok = scheme.may_link(n[i], n[i + 1:], d) & (root[i + 1:] != root[i])
        if facing:  # pairs within a block belong to the block's own cell
            ok &= own[i + 1:] != own[i]
        found = np.flatnonzero(ok) + i + 1
        if len(found):
            yield i, found


def rest_pairs(cells: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """Pairs of different components that share a signature of few sets and pass size and sketch.

    A member has fewer than ``LARGE`` partners in such a group.
    """
    def rows(batches):
        scheme = Scheme(percent)
        for key, (sid, root, own, n, sketches) in _cells(batches, "sid", "root", "own", "n", "sketch"):
            sid = np.array(sid)
            pairs = [(np.minimum(sid[i], sid[found]), np.maximum(sid[i], sid[found])) for i, found in open_pairs(
                scheme, np.array(n), np.array(root), np.array(own), sketches, key[1] != key[2])]
            if pairs:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(c)) for c in zip(*pairs, strict=True)], schema=PAIR_ARROW)

    few = cells.where(F.col("m") < LARGE).join(classes.select("sid", "n", "sketch"), "sid")
    return by_cell(few, "sid", "root", "own", "n", "sketch").mapInArrow(rows, "a long, b long").distinct()


def spanning(scheme: Scheme, sid: np.ndarray, root: np.ndarray, own: np.ndarray, sets_: list[np.ndarray],
             facing: bool) -> tuple[list[int], list[int]]:
    """Links between members of a cell, one for each component that they join to another.

    All open pairs are compared by their whole sets but those that earlier links
    connect, so that there are fewer links than components.
    """
    n = np.array([len(s) for s in sets_])
    starts = np.concatenate([[0], np.cumsum(n)])
    values, number = np.unique(np.concatenate(sets_), return_inverse=True)
    numbers = [number[starts[i]:starts[i + 1]] for i in range(len(n))]
    held, root = np.zeros(len(values), np.int64), root.copy()
    a, b = [], []
    for i, found in open_pairs(scheme, n, root, own, [scheme.sketch(s) for s in sets_], facing):
        held[numbers[i]] = 1
        edges = np.concatenate([[0], np.cumsum(n[found])[:-1]])
        common = np.add.reduceat(held[np.concatenate([numbers[j] for j in found])], edges)
        held[numbers[i]] = 0
        links = found[100 * common >= scheme.percent * (n[i] + n[found] - common)]
        if len(links):
            joined, first = np.unique(root[links], return_index=True)
            a += [int(sid[i])] * len(joined)
            b += sid[links[first]].tolist()
            root[np.isin(root, joined)] = root[i]
    return a, b


def rest_links(cells: DataFrame, docs: DataFrame, classes: DataFrame, width: int, percent: int,
               id_column: str, text_column: str) -> DataFrame:
    """Links that join the components within groups of ``LARGE`` members and more; a written table.

    Tasks first mark the members that size and sketch leave a partner in their
    cell. Those get their whole sets and are compared right there. So neither
    step has more rows than members, however many pairs there are.
    """
    def marks(batches):
        scheme = Scheme(percent)
        for key, (sid, root, own, n, sketches) in _cells(batches, "sid", "root", "own", "n", "sketch"):
            marked = np.zeros(len(n), bool)
            for i, found in open_pairs(scheme, np.array(n), np.array(root), np.array(own), sketches, key[1] != key[2]):
                marked[i] = marked[found] = True
            kept = np.flatnonzero(marked)
            if len(kept):
                columns = [np.full(len(kept), k) for k in key] + [np.array(c)[kept] for c in (sid, root, own)]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, MARK_ARROW.types, strict=True)],
                                                 schema=MARK_ARROW)

    def rows(batches):
        scheme = Scheme(percent)
        for key, (sid, root, own, features) in _cells(batches, "sid", "root", "own", "features"):
            a, b = spanning(scheme, np.array(sid), np.array(root), np.array(own),
                            [np.frombuffer(f, U64) for f in features], key[1] != key[2])
            if a:
                yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], schema=PAIR_ARROW)

    many = cells.where(F.col("m") >= LARGE).join(classes.select("sid", "n", "sketch"), "sid")
    marked = materialise(by_cell(many, "sid", "root", "own", "n", "sketch").mapInArrow(marks, MARK), "marked")
    held = features_of(marked.select("sid").distinct(), docs, classes, width, id_column, text_column)
    whole = marked.join(held, "sid")
    return materialise(by_cell(whole, "sid", "root", "own", "features").mapInArrow(rows, "a long, b long")
                       .distinct(), "links")


def near_duplicates(docs: DataFrame, width: int = 5, percent: int = 80, id_column: str = "doc_id",
                    text_column: str = "text") -> DataFrame:
    """doc_id, n_shingles, sid, component_id, row_id and root of every row.

    ``component_id`` is the smallest id that links lead to, the row's own
    included. ``row_id`` is a hash of id and text, ``root`` names the component
    where ids cannot, as they may be missing or repeated.
    """
    of_rows = sets(docs, width, percent, id_column, text_column)
    classes = materialise(of_rows.where("sid IS NOT NULL").groupBy("sid").agg(
        F.min("doc_id").alias("least"), F.min("row_id").alias("row_id"), F.any_value("n").alias("n"),
        F.any_value("sketch").alias("sketch")), "classes")
    groups = signature_groups(docs, width, percent, id_column, text_column)
    star = groups.where("sid <> other").select(
        F.least("sid", "other").alias("a"), F.greatest("sid", "other").alias("b")).distinct()
    links = verified(passing(star, classes, percent), docs, classes, width, percent, id_column, text_column)
    roots = components(links)
    stars = more_stars(groups, roots, docs, classes, width, percent, id_column, text_column)
    if stars:
        links = reduce(DataFrame.unionByName, stars, links)
        roots = components(links)
    cells = open_cells(groups, roots, classes)
    more = verified(rest_pairs(cells, classes, percent), docs, classes, width, percent, id_column, text_column)
    joined = rest_links(cells, docs, classes, width, percent, id_column, text_column)
    roots = components(links.unionByName(more).unionByName(joined))
    ids = classes.join(roots.withColumnRenamed("node", "sid"), "sid", "left").select(
        "sid", "least", F.coalesce("root", "sid").alias("root"))
    labels = ids.groupBy("root").agg(F.min("least").alias("component_id"))
    by_set = materialise(ids.join(labels, "root").select("sid", "root", "component_id"), "labels")
    return of_rows.join(by_set, "sid", "left").select(
        "doc_id", F.col("n").alias("n_shingles"), "sid",
        F.when(F.col("sid").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"),
        "row_id", "root")


@query("op7_jaccard_join")
def op7(spark, sf_dir):
    """Component of every document under links of at least 0.9 over three-word shingles."""
    ready(spark)
    docs = table(spark, sf_dir, "documents")
    return near_duplicates(docs, 3, 90).drop("sid", "row_id", "root")
