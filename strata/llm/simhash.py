"""SimHash near-duplicate detection with BK-trees.

1. *Fingerprints.*  A text's three-word shingles (A-Z lowered, repeats included) are hashed with XXH64; bit ``i`` of the
   fingerprint is set if bit ``i`` is set in more than half of the hashes.  Two texts are linked if their fingerprints
   differ in at most ``RADIUS`` bits.
2. *Classes.*  Texts with the same fingerprint are one class, named by its smallest id; only classes go on.
3. *Shards.*  The 64 bits are cut into ``RADIUS + 2`` blocks.  Two fingerprints within the radius agree on two whole
   blocks at least, so every class goes into one shard for each pair of blocks, keyed by their bits, and no link
   leaves all shards.  Shards of one class hold no link and are left out before anything is sorted.
4. *BK-trees.*  A shard's fingerprints form a BK-tree: a child hangs under its parent by their Hamming distance, which is a
   whole number.  A search with distance ``d`` to a node follows the edges ``d - RADIUS .. d + RADIUS`` only.  A task builds
   the trees of many shards at once and descends level by level in numpy arrays.  A tree travels to the task that
   searches it and to no other, so nothing that grows with the data is sent to all executors.
5. *Crowds.*  A shard of more than ``SHARD`` classes is dealt anew by the same argument on the bits that its key leaves
   open (three of six sub-blocks agree), which leaves 18 to 21 open bits.  What is still too large is split into chunks,
   and every pair of chunks is a tree of its own: bounded work for a task, and no link is lost.
6. *Grouping.*  A shard gives a spanning forest of its links (never more links than classes); components come from
   union-find inside partitions and star contraction between them (``near_dup.components``), all in tables.

Defined results: NULL and empty texts, and texts of blanks, have the fingerprint zero and are linked like any other;
a text of one or two words is one shingle; a bit set in exactly half of the hashes is not set; rows with a NULL id
have a fingerprint but are linked with nothing (component NULL); repeated rows share their class; rows that share an
id but not a text each follow their own text; texts of any length are read whole, a megabyte at a time; an empty
table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.common import cut, cut_mark, drop_cuts, per_batch, raw, small_batches
from strata.llm.near_dup import components

WIDTH = 3
SEED = 42
RADIUS = 3
#: Classes in one tree.
SHARD = 16_384
#: Bytes of a text that are split into words at a time.
_PIECE = 1 << 20
#: Hashes whose bits are counted at a time.
_COUNTED = 1 << 16
#: Classes whose trees a task holds at a time, and pairs of a search that it looks at together.
_HELD, _PAIRS = 1 << 15, 1 << 21

_BLANK = re.compile(rb"[\x20\x09-\x0D]")


# -- fingerprints ---------------------------------------------------------------------------------


def _pieces(text: bytes, width: int) -> Iterator[list[bytes]]:
    """The words of a text piece by piece; each piece begins with the ``width - 1`` words before it."""
    carried: list[bytes] = []
    at = 0
    while at < len(text):
        blank = _BLANK.search(text, at + _PIECE) if at + _PIECE < len(text) else None
        to = blank.start() if blank else len(text)
        words = carried + text[at:to].lower().split()
        yield words
        carried, at = words[-(width - 1):] if width > 1 else [], to


def fingerprint(text: bytes, width: int = WIDTH) -> int:
    counts, n, last = np.zeros(64, dtype=np.int64), 0, []
    digest = xxhash.xxh64_intdigest
    for words in _pieces(text, width):
        last = words
        if len(words) < width:
            continue
        line = b" ".join(words)
        ends = np.cumsum(np.fromiter(map(len, words), dtype=np.int64, count=len(words)) + 1) - 1
        starts = np.concatenate(([0], ends[:-1] + 1))
        spans = zip(starts[:len(words) - width + 1].tolist(), ends[width - 1:].tolist())
        hashes = np.array([digest(line[a:b], SEED) for a, b in spans], dtype="<u8")
        n += len(hashes)
        for i in range(0, len(hashes), _COUNTED):
            bits = np.unpackbits(hashes[i:i + _COUNTED].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
            counts += bits.sum(axis=0, dtype=np.int64)
    if not n:  # fewer words than a shingle has
        return digest(b" ".join(last), SEED) if last else 0
    return int(np.packbits(2 * counts > n, bitorder="little").view("<u8")[0])


def _fingerprints() -> Column:
    def make():
        return lambda texts: pa.array(np.array([fingerprint(t) for t in texts], dtype=np.uint64).view(np.int64))
    return per_batch(make, "bigint")(F.col("raw"))


# -- shards ---------------------------------------------------------------------------------------


def _blocks(bits: list[int], n: int) -> list[int]:
    """Masks of ``n`` blocks of nearly equal size."""
    cuts = [round(i * len(bits) / n) for i in range(n + 1)]
    return [sum(1 << b for b in bits[a:z]) for a, z in zip(cuts, cuts[1:])]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def masks(radius: int = RADIUS) -> list[int]:
    """Bits that make up the first keys: two of ``radius + 2`` blocks."""
    return [sum(pair) for pair in combinations(_blocks(list(range(64)), radius + 2), 2)]


def finer(mask: int, radius: int = RADIUS) -> list[int]:
    """Bits that make up the keys inside one shard: ``radius`` of ``2 * radius`` sub-blocks of what is open."""
    open_ = [b for b in range(64) if not mask >> b & 1]
    return [mask + sum(some) for some in combinations(_blocks(open_, 2 * radius), radius)]


def _sized(entries: DataFrame, label: str) -> DataFrame:
    """Entries of shards that hold several classes, with the shard's size."""
    sizes = entries.groupBy("mask", "key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    return cut(entries.join(sizes, ["mask", "key"]), label)


def shards(classes: DataFrame, radius: int = RADIUS, size: int = SHARD) -> DataFrame:
    """``mask, key, i, j, fp, node``: every class in every shard that it shares with another one."""
    def dealt(df: DataFrame, by: Column) -> DataFrame:
        return df.select("node", "fp", F.explode(by).alias("mask")).withColumn("key", F.col("fp").bitwiseAND(F.col("mask")))

    whole = F.lit(0).alias("i"), F.lit(0).alias("j")
    entries = _sized(dealt(classes, F.array(*[F.lit(_signed(m)) for m in masks(radius)])), "simhash-shards")
    out = entries.where(F.col("n") <= size).select("mask", "key", *whole, "fp", "node")
    crowds = entries.where(F.col("n") > size)
    if not crowds.limit(1).count():
        return out
    by_mask = F.coalesce(*[F.when(F.col("mask") == _signed(m), F.array(*[F.lit(_signed(f)) for f in finer(m, radius)]))
                           for m in masks(radius)])
    again = _sized(dealt(crowds, by_mask), "simhash-crowds")
    out = out.unionByName(again.where(F.col("n") <= size).select("mask", "key", *whole, "fp", "node"))
    chunks = F.ceil(2 * F.col("n") / size).cast("int")
    mine = F.pmod(F.xxhash64("fp"), chunks).cast("int")
    large = (again.where(F.col("n") > size).withColumn("mine", mine)
             .withColumn("other", F.explode(F.sequence(F.lit(0), chunks - 1)))
             .select("mask", "key", F.least("mine", "other").alias("i"), F.greatest("mine", "other").alias("j"), "fp", "node"))
    return out.unionByName(large)


# -- BK-trees -------------------------------------------------------------------------------------


class Trees:
    """BK-trees of several shards: ``fp`` lies shard after shard, ``root[x]`` is the first place of x's shard.

    The first fingerprint of a shard is its root.  ``child[x, d]`` is the place of the child of x at distance d, -1 if there
    is none.  A child lies behind its parent.
    """

    def __init__(self, fp: np.ndarray, root: np.ndarray):
        self.fp, self.root = fp, root
        self.child = np.full((len(fp), 65), -1, dtype=np.int32)
        flat = self.child.reshape(-1)
        here = np.flatnonzero(root != np.arange(len(fp)))
        under = root[here]
        while len(here):
            slot = under.astype(np.int64) * 65 + np.bitwise_count(fp[here] ^ fp[under])
            empty = flat[slot] < 0
            flat[slot[empty][::-1]] = here[empty][::-1]  # the first that comes to an empty place takes it
            under = flat[slot]
            going = under != here
            here, under = here[going], under[going]

    def near(self, places: np.ndarray, radius: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Pairs (place, place before it in its shard) within the radius."""
        q, x = places, self.root[places]
        while len(q):
            d = np.bitwise_count(self.fp[q] ^ self.fp[x]).astype(np.int64)
            hit = (d <= radius) & (x < q)
            yield q[hit], x[hit]
            nq, nx = [], []
            for step in range(-radius, radius + 1):
                k = d + step
                ok = (k > 0) & (k <= 64)
                c = self.child[x[ok], k[ok]]
                on = (c >= 0) & (c < q[ok])  # what lies behind a place looks for it itself
                nq.append(q[ok][on])
                nx.append(c[on])
            q, x = np.concatenate(nq), np.concatenate(nx)


def _join(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Union of the groups of ``a[i]`` and ``b[i]``; a group's label is its smallest place."""
    while True:
        la, lb = label[a], label[b]
        apart = la != lb
        if not apart.any():
            return
        a, b = a[apart], b[apart]
        np.minimum.at(label, np.maximum(la, lb)[apart], np.minimum(la, lb)[apart])
        while not np.array_equal(up := label[label], label):
            label[:] = up


def spanning(fp: np.ndarray, root: np.ndarray, radius: int = RADIUS) -> np.ndarray:
    """For every place the smallest place that links of its shard lead to."""
    trees = Trees(fp, root)
    label = np.arange(len(fp))
    cost = np.cumsum(np.arange(len(fp)) - root + 1)
    at = 0
    while at < len(fp):
        done = cost[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(cost, done + _PAIRS, side="right")))
        for a, b in trees.near(np.arange(at, to), radius):
            if len(a):
                _join(label, a, b)
        at = to
    return label


def _links(radius: int):
    """Sorted entries (mask, key, i, j, fp, node) to links (u, v), several whole shards at a time."""

    def solve(cols: list[np.ndarray], new: np.ndarray) -> pa.RecordBatch:
        first = np.flatnonzero(new)
        root = np.repeat(first, np.diff(np.append(first, len(new))))
        label = spanning(cols[4].view(np.uint64), root.astype(np.int32), radius)
        tied = np.flatnonzero(label != np.arange(len(label)))
        return pa.RecordBatch.from_arrays([pa.array(cols[5][tied]), pa.array(cols[5][label[tied]])], names=["u", "v"])

    def starts(cols: list[np.ndarray]) -> np.ndarray:
        new = np.ones(len(cols[0]), dtype=bool)
        new[1:] = np.any([c[1:] != c[:-1] for c in cols[:4]], axis=0)
        return new

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] | None = None
        for batch in batches:
            cols = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
            held = [np.concatenate(x) for x in zip(held, cols)] if held else cols
            if len(held[0]) >= _HELD:
                new = starts(held)
                last = int(np.flatnonzero(new)[-1])  # its shard may go on in the next batch
                if last:
                    yield solve([c[:last] for c in held], new[:last])
                    held = [c[last:] for c in held]
        if held and len(held[0]):
            yield solve(held, starts(held))

    return run


def groups_of(classes: DataFrame, radius: int = RADIUS, size: int = SHARD) -> DataFrame:
    """(node, root) of the classes ``fp, node`` (fingerprints distinct) that links lead to a smaller one."""
    shard = ["mask", "key", "i", "j"]
    entries = shards(classes, radius, size).select(*shard, "fp", "node").repartition(*shard).sortWithinPartitions(*shard, "fp")
    return components(entries.mapInArrow(_links(radius), "u bigint, v bigint"), "simhash")


def near_duplicates(docs: DataFrame, radius: int = RADIUS, size: int = SHARD) -> DataFrame:
    """One row per document: ``doc_id, fingerprint, component_id``."""
    small_batches(docs.sparkSession)
    sig = cut(docs.select("doc_id", raw("text").alias("raw")).select("doc_id", _fingerprints().alias("fp")), "simhash-fingerprints")
    classes = cut(sig.where(F.col("doc_id").isNotNull()).groupBy("fp").agg(F.min("doc_id").alias("node")), "simhash-classes")
    mark = cut_mark()
    groups = groups_of(classes, radius, size)
    drop_cuts(docs.sparkSession, mark, groups)
    named = classes.join(groups, "node", "left").select("fp", F.coalesce("root", "node").alias("component"))
    return sig.join(named, "fp", "left").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        F.when(F.col("doc_id").isNotNull(), F.col("component")).alias("component_id"))
