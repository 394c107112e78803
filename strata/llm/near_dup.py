"""MinHash near-duplicate detection with SuperMinHash signatures.

A text's set is its distinct five-word shingles (A-Z lowered, words between blanks).  Two texts are
linked if ``100 * |intersection| >= percent * |union|``: 85 for the operator, 80 for the pipeline's stage.

1. *Signatures.*  SuperMinHash: element ``e`` draws a random permutation of the registers one
   position after the other; at step ``j`` register ``p[j]`` is offered ``j + r`` with ``r`` uniform
   in [0, 1).  Ranks inside a permutation are correlated, which lowers the variance against
   independent hashes, and once every register holds less than ``j + 1`` no later step can change
   it: steps stop early (one or two for usual texts).  Whole batches are processed step by step.
2. *Classes.*  Texts with the same set are one class, named by its smallest id; only classes go on.
3. *Banding.*  ``BANDS`` bands of ``ROWS`` registers.  A pair at similarity 0.85 shares no band with
   probability (1 - 0.85^5)^25 < 5e-7, one at 0.80 with (1 - 0.80^5)^25 < 5e-5.
4. *Candidates.*  Every class is compared on full sets with a centre of each of its buckets and linked
   classes are grouped.  Members around one centre that are still apart can only be linked if their
   differences to the centre overlap; a prefix filter on those differences (``leftovers``) finds all
   such pairs.  So no link inside a bucket is lost, while a crowd of copies costs a multiple of its size
   and not its square.
5. *Grouping.*  Verified links are grouped by union-find inside partitions and star contraction between
   them (every step in tables; nothing is collected).

Defined results: NULL and empty texts have no shingles and are linked with nothing; a text of one to
four words is one shingle; rows with a NULL id are compared with nothing (component NULL, kept);
repeated rows share their class; rows that share an id but not a text each follow their own text;
an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.common import bounded_broadcast, cut, cut_mark, drop_cuts, fresh, per_batch, raw, small_batches

WIDTH = 5
BANDS, ROWS = 25, 5
PERCENT = 85
#: Elements whose permutations are held at a time (one byte a register each).
_CHUNK = 100_000
#: Longs in the bitmap of a difference (a power of two).
_BITMAP = 4
#: Ids of eight bytes that may be broadcast.
_ID_ROWS = 1_000_000

_U = np.uint64
_rng = np.random.default_rng(5)
_MULT = _rng.integers(1, 2 ** 63, size=64, dtype=np.uint64) * _U(2) + _U(1)


def _mix(x: np.ndarray) -> np.ndarray:
    """Finaliser that spreads all 64 bits."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def shingles(text: bytes, width: int = WIDTH) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the word shingles."""
    words = text.lower().split()
    n = len(words)
    if not n:
        return np.zeros(0, dtype=np.uint64)
    w = np.fromiter(map(xxhash.xxh3_64_intdigest, words), dtype=np.uint64, count=n)
    k = min(n, width)
    m = n - k + 1
    h = np.full(m, _U(k), dtype=np.uint64)
    for j in range(k):
        h += w[j:j + m] * _MULT[j]
    return np.unique(_mix(h))


def superminhash(sets: list[np.ndarray], m: int) -> np.ndarray:
    """One row of ``m`` registers per set; a register holds ``step * 2^32 + 32 random bits``."""
    out = np.full((len(sets), m), np.iinfo(np.uint64).max, dtype=np.uint64)
    i = 0
    while i < len(sets):
        j, size = i, 0
        while j < len(sets) and (j == i or size + len(sets[j]) <= _CHUNK):
            size += len(sets[j])
            j += 1
        _fill(out[i:j], sets[i:j], m)
        i = j
    return out


def _fill(reg: np.ndarray, sets: list[np.ndarray], m: int) -> None:
    flat = reg.reshape(-1)
    sizes = np.array([len(s) for s in sets])
    elements = np.concatenate(sets) if len(sets) else np.zeros(0, dtype=np.uint64)
    owner = np.repeat(np.arange(len(sets)), sizes)
    perm = None
    for step in range(m):
        if not len(elements):
            return
        x = _mix(elements + _U((step + 1) * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF))
        r = x >> _U(32)
        k = step + ((x & _U(0xFFFFFFFF)) * _U(m - step) >> _U(32)).astype(np.int64)
        if step == 0:
            place = k
        else:
            rows = np.arange(len(elements))
            place = perm[rows, k].astype(np.int64)
            perm[rows, k] = perm[:, step]
        np.minimum.at(flat, owner * m + place, r | _U(step << 32))
        open_ = (reg >= _U((step + 1) << 32)).any(axis=1)
        stay = open_[owner]
        if step == 0:
            k = k[stay]
            elements, owner = elements[stay], owner[stay]
            perm = np.tile(np.arange(m, dtype=np.uint8 if m <= 256 else np.uint16), (len(elements), 1))
            perm[np.arange(len(elements)), k] = 0  # positions 0 and k swapped; position 0 is never read again
        elif not stay.all():
            elements, owner, perm = elements[stay], owner[stay], perm[stay]


def band_keys(reg: np.ndarray, bands: int = BANDS, rows: int = ROWS) -> np.ndarray:
    """One 64-bit key per band; bands never share keys by design."""
    h = np.zeros((len(reg), bands), dtype=np.uint64) + np.arange(bands, dtype=np.uint64) * _MULT[60]
    for j in range(rows):
        h = _mix(h + reg[:, j::rows][:, :bands] * _MULT[20 + j])
    return h.view(np.int64)


_SIG = pa.struct([("n_shingles", pa.int64()), ("cls", pa.binary()), ("bands", pa.list_(pa.int64()))])


def _signature(width: int, bands: int, rows: int) -> Column:
    def make():
        def run(texts: list[bytes]) -> pa.Array:
            sets = [shingles(t, width) for t in texts]
            keys = band_keys(superminhash(sets, bands * rows), bands, rows)
            full = [len(s) > 0 for s in sets]
            return pa.StructArray.from_arrays([
                pa.array([len(s) for s in sets], pa.int64()),
                pa.array([xxhash.xxh3_128_digest(s.tobytes()) if f else None for s, f in zip(sets, full)], pa.binary()),
                pa.array([k.tolist() if f else None for k, f in zip(keys, full)], pa.list_(pa.int64()))], fields=list(_SIG))
        return run
    return per_batch(make, "n_shingles bigint, cls binary, bands array<bigint>")(F.col("raw"))


def _sets(width: int) -> Column:
    def make():
        return lambda texts: pa.array([shingles(t, width).view(np.int64) for t in texts], type=pa.list_(pa.int64()))
    return per_batch(make, "array<bigint>")(F.col("raw"))


# -- grouping -------------------------------------------------------------------------------------


def _forest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Union-find over a partition's edges; the smallest node is the root."""
    parent: dict[int, int] = {}

    def find(x: int) -> int:
        root = x
        while parent.setdefault(root, root) != root:
            root = parent[root]
        while parent[x] != root:
            parent[x], x = root, parent[x]
        return root

    for batch in batches:
        for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            a, b = find(a), find(b)
            if a != b:
                parent[max(a, b)] = min(a, b)
    nodes = [x for x in parent if find(x) != x]
    for i in range(0, len(nodes), 100_000):
        part = nodes[i:i + 100_000]
        yield pa.RecordBatch.from_arrays([pa.array(part, pa.int64()), pa.array([parent[x] for x in part], pa.int64())],
                                         names=["u", "v"])


def components(edges: DataFrame, label: str = "near-dup") -> DataFrame:
    """(node, root) of every node of ``edges (u, v)``; the root is the component's smallest node.

    Union-find inside partitions first, then large-star / small-star rounds until nothing changes:
    every node then points at its root.  Each round is written out, so lineage stays short.
    """
    pairs = edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    e = cut(pairs.repartition("v").mapInArrow(_forest, "u bigint, v bigint"), f"{label}-edges")
    before = None
    while True:
        mark = cut_mark() - 1  # the table read in this round goes once the next one is written
        # large star: every larger neighbour of u goes to the smallest node around u
        both = e.union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))
        e = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        # small star: u and its smaller neighbours go to the smallest of them
        least = e.groupBy("u").agg(F.min("v").alias("m"))
        e = (e.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
             .union(least.select("u", F.col("m").alias("v"))).distinct())
        e = cut(e, f"{label}-edges")
        drop_cuts(e.sparkSession, mark, e)
        now = tuple(e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        if now == before:
            break
        before = now
    out = e.select(F.col("u").alias("node"), F.col("v").alias("root"))
    out.cut_path = e.cut_path
    return out


# -- candidates and verification ------------------------------------------------------------------


def _alike(a: str, b: str, percent: int) -> Column:
    """Set sizes that allow the similarity at all."""
    return F.least(F.col(a), F.col(b)) * 100 >= F.greatest(F.col(a), F.col(b)) * percent


def with_sets(pairs: DataFrame, docs: DataFrame, width: int, label: str, repeated: bool) -> DataFrame:
    """``pairs (u, v)`` of class names with the full sets ``a`` and ``b``, read back for these classes alone."""
    needed = cut(pairs.select(F.explode(F.array("u", "v")).alias("node")).distinct(), f"{label}-nodes")
    texts = docs.select(F.col("doc_id").alias("node"), raw("text").alias("raw")).join(
        bounded_broadcast(needed, needed.count(), _ID_ROWS), "node")
    sets = texts.select("node", _sets(width).alias("s"))
    if repeated:  # ids that several rows carry: each different text once
        sets = sets.dropDuplicates()
    sets = cut(sets, f"{label}-sets")
    return (pairs.join(sets.select(F.col("node").alias("u"), F.col("s").alias("a")), "u")
            .join(sets.select(F.col("node").alias("v"), F.col("s").alias("b")), "v"))


def _linked(percent: int) -> Column:
    both = F.size(F.array_intersect("a", "b"))
    return both * 100 >= (F.size("a") + F.size("b") - both) * percent


def star(classes: DataFrame) -> DataFrame:
    """(u, v): every class with a centre ``v`` of each of its buckets.

    The centre is the member whose buckets are largest together: in a crowd of edited copies the one nearest
    to what they are copies of.
    """
    entries = classes.select("node", F.explode("bands").alias("key"))
    # keys that one class holds alone, nearly all of them, go before anything is joined or sorted
    buckets = cut(entries.groupBy("key").agg(F.count(F.lit(1)).alias("size")).where("size > 1"), "near-dup-buckets")
    members = cut(entries.join(bounded_broadcast(buckets, buckets.count()), "key"), "near-dup-members")
    popular = members.groupBy("node").agg(F.sum("size").alias("pop"))
    centres = members.join(popular, "node").groupBy("key").agg(
        F.max(F.struct("pop", (-F.col("node")).alias("node"))).alias("c")).select("key", (-F.col("c.node")).alias("v"))
    return (members.join(centres, "key").where("node <> v").select(F.col("node").alias("u"), "v").distinct())


def bitmap(elements: str) -> Column:
    """``64 * _BITMAP`` bits, one set for each element by its hash, as a struct of longs."""
    def word(k: int) -> Column:
        mine = F.filter(elements, lambda e: F.shiftrightunsigned(e, 6).bitwiseAND(_BITMAP - 1) == k)
        return F.aggregate(mine, F.lit(0).cast("long"), lambda acc, e: acc.bitwiseOR(
            F.call_function("shiftleft", F.lit(1).cast("long"), e.bitwiseAND(63).cast("int"))))
    return F.struct(*[word(k).alias(f"b{k}") for k in range(_BITMAP)])


def leftovers(checked: DataFrame, groups: DataFrame, percent: int) -> DataFrame:
    """Candidate pairs (u, v) among classes around one centre that grouping left apart.

    Around a centre c let ``D_i`` be the symmetric difference of i and c.  i and j are linked only if their own
    difference is at most ``t = (100 - percent) / (100 + percent) * (|i| + |j|)``, which means that ``D_i`` and
    ``D_j`` share ``a = ceil((|D_i| + |D_j| - t) / 2)`` elements, and a >= 1 if i is not linked to c.  In any order
    common to all sets they then share one of the first ``|D_i| - a + 1`` and ``|D_j| - a + 1`` elements.  Elements
    that c lacks come first: they are mostly rare, so crowds of differently edited copies hardly meet.  Those that
    do are held against ``t`` once more by bitmaps of their differences: the two bitmaps cannot differ in more bits
    than the differences do in elements.
    """
    names = groups.select(F.col("node").alias("_n"), F.col("root").alias("_r"))
    named = (checked.join(names.toDF("u", "ur"), "u", "left").join(names.toDF("v", "vr"), "v", "left")
             .withColumns({"ur": F.coalesce("ur", "u"), "vr": F.coalesce("vr", "v")}).withColumn("minor", F.col("ur") != F.col("vr")))
    named = cut(named.select("u", "v", "n", "delta", "prefix", "bits", "ur", "minor"), "near-dup-around")
    open_ = named.groupBy("v").agg(F.count_if("minor").alias("minors"), F.count(F.lit(1)).alias("all")).where("minors > 0 and `all` > 1")
    rows = (named.join(open_.select("v"), "v")
            .select(F.col("v").alias("c"), "u", "n", "delta", "ur", "minor", "bits", F.posexplode("prefix").alias("pos", "e")))
    own = ("u", "n", "delta", "ur", "pos", "minor", "bits")
    i = rows.where("minor").select("c", "e", *[F.col(x).alias(f"i_{x}") for x in own])
    j = rows.select("c", "e", *[F.col(x).alias(f"j_{x}") for x in own])
    t = F.lit((100 - percent) / (100 + percent)) * (F.col("i_n") + F.col("j_n"))
    share = F.greatest(F.lit(1), F.ceil((F.col("i_delta") + F.col("j_delta") - t) / 2 - 1e-9))
    apart = sum((F.bit_count(F.col(f"i_bits.b{k}").bitwiseXOR(F.col(f"j_bits.b{k}"))) for k in range(_BITMAP)), F.lit(0))
    both = i.join(j, ["c", "e"]).where(
        (F.col("i_ur") != F.col("j_ur")) & (~F.col("j_minor") | (F.col("i_u") < F.col("j_u"))) & _alike("i_n", "j_n", percent)
        & (F.col("i_pos") <= F.col("i_delta") - share) & (F.col("j_pos") <= F.col("j_delta") - share) & (apart <= t))
    return both.select(F.col("i_u").alias("u"), F.col("j_u").alias("v")).distinct()


def links(docs: DataFrame, width: int = WIDTH, percent: int = PERCENT, bands: int = BANDS, rows: int = ROWS
          ) -> tuple[DataFrame, DataFrame]:
    """(documents with their class name, (node, root) of the classes that are linked)."""
    small_batches(docs.sparkSession)
    sig = cut(docs.select("doc_id", F.xxhash64("text").alias("text_key"), raw("text").alias("raw"))
              .select("doc_id", "text_key", _signature(width, bands, rows).alias("s"))
              .select("doc_id", "text_key", "s.*"), "near-dup-signatures")
    known = sig.where(F.col("doc_id").isNotNull() & (F.col("n_shingles") > 0))
    repeated = bool(known.groupBy("doc_id").count().where("count > 1").limit(1).count())
    classes = cut(known.groupBy("cls").agg(F.min("doc_id").alias("node"), F.first("bands").alias("bands")), "near-dup-classes")
    mark = cut_mark()
    pairs = cut(star(classes), "near-dup-star")
    # the longest prefix that any partner can call for: a partner's set is at most 100/percent times as large
    longest = F.floor(F.col("n") * ((100 - percent) / (100 + percent) * (1 + 100 / percent))).cast("int") + 2
    differ = F.concat(F.array_except("a", "b"), F.array_except("b", "a"))
    checked = (with_sets(pairs, docs, width, "near-dup-star", repeated)
               .select("u", "v", F.size("a").alias("n"), _linked(percent).alias("linked"), differ.alias("d"))
               .select("u", "v", "n", "linked", F.size("d").alias("delta"), F.slice("d", 1, longest).alias("prefix"), bitmap("d").alias("bits")))
    checked = cut(checked, "near-dup-checked")
    groups = components(checked.where("linked").select("u", "v"))
    crossed = cut(leftovers(checked, groups, percent), "near-dup-crossed")
    if crossed.limit(1).count():
        more = cut(with_sets(crossed, docs, width, "near-dup-crossed", repeated).where(_linked(percent)).select("u", "v"), "near-dup-links")
        if more.limit(1).count():
            groups = components(groups.select(F.col("node").alias("u"), F.col("root").alias("v")).union(more))
    drop_cuts(docs.sparkSession, mark, groups)
    named = sig.join(classes.select("cls", "node"), "cls", "left").select("doc_id", "text_key", "n_shingles", "node")
    return named, groups


def near_duplicates(docs: DataFrame, **options) -> DataFrame:
    """One row per document: ``doc_id, text_key`` (hash of the text), ``n_shingles, component_id, kept``."""
    named, groups = links(docs, **options)
    alone = F.col("doc_id").isNull() | (F.col("n_shingles") == 0)
    out = named.join(groups, "node", "left").withColumn(
        "component_id", F.when(alone, F.col("doc_id")).otherwise(F.coalesce("root", "node")))
    return out.select("doc_id", "text_key", "n_shingles", "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))


def keep_first(docs: DataFrame, **options) -> DataFrame:
    """The input's rows and columns with one document of each group: the smallest id, and one of the rows
    that repeat that id and text.  Rows that share an id but not a text are not told to be copies by that alone.

    What goes is found as (id, hash of the text), so texts are only joined against narrow tables.
    """
    verdict = cut(near_duplicates(docs, **options), "near-dup-verdict")
    named = verdict.where(F.col("component_id").isNotNull() & (F.col("n_shingles") > 0))
    gone = cut(named.where(~F.col("kept")).select("doc_id", "text_key").distinct(), "near-dup-gone")
    i, k = fresh(docs, "_gone_id"), fresh(docs, "_gone_key")
    same = (F.col("doc_id") == F.col(i)) & (F.xxhash64("text") == F.col(k))
    rest = docs.join(bounded_broadcast(gone.toDF(i, k), gone.count(), _ID_ROWS), same, "left_anti")
    twice = named.where("kept").groupBy("doc_id", "text_key").count().where("count > 1").select("doc_id", "text_key")
    twice = cut(twice, "near-dup-twice")
    n = twice.count()
    if not n:
        return rest
    small = bounded_broadcast(twice.toDF(i, k), n, _ID_ROWS)
    return rest.join(small, same, "left_anti").unionByName(rest.join(small, same, "left_semi").dropDuplicates(["doc_id", "text"]))
