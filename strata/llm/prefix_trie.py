"""Prefix trie of rebuilt conversations by composable fingerprints.

A conversation ``c`` is rebuilt from the first ``h`` turns of its base ``c - c % 20`` and its own turns behind the first
``h``; ``h`` is crc32 of its decimal id modulo 4.  The nodes of the trie are the distinct beginnings of rebuilt conversations.

1. *Turns.*  A turn's reference is the SHA-256 of its role and text (four longs).  Only references, word counts and places
   move; texts are read once.
2. *Monoid fingerprints.*  The fingerprint of turns ``1..k`` is ``Q(k) = sum t_i * B^i`` modulo 2^31 - 1 in three lanes.  Two pieces
   compose: ``Q(ab) = Q(a) + B^|a| * Q(b)``.  So a conversation that spans many tasks is put together from its pieces,
   and the fingerprint of a rebuilt beginning is taken from stored products alone, without building it:
   ``Q_base(h') + B^(h' - h) * (Q_own(k) - Q_own(h))``.
3. *Order without a task per conversation.*  Turns are range-partitioned by (conversation, turn); every task takes running
   products of its range, and what lies before a range in the same conversation is carried in a frame of at most two rows a range.
4. *Nodes.*  Equal (depth, fingerprint) is one node, its counts taken with partial sums.  Every group verifies that its
   members have one turn reference and one parent, which by induction over the depth makes their beginnings equal;
   if a group fails, the whole is done again with other bases.
5. *Subtrees without climbing.*  The smallest member of a node owns it.  A conversation owns a chain of nodes down its own path, so
   the sum over a subtree is the rest of the owner's chain plus the whole chains of all others that pass through.  Each row of a
   rebuilt conversation contributes once, however deep the trie is.
6. *Ends.*  Ids of conversations that end at a node are sorted by range partitions, joined to pieces of text there, and the pieces
   hashed one after the other in order, so no node's ids are held as a whole.

Chains and conversations are cut into blocks of ``BLOCK`` depths for joins and running sums, so one conversation with a third
of all turns is spread like any others.

Defined results: a NULL role or text is empty; a NULL turn comes first; turns that share a place come in the order of their
references; repeated rows are turns of their own; rows with a NULL id belong to no conversation; a missing base has no
turns; texts of any length are hashed whole; an empty table has no conversation and gives no node; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.common import WORD, cut, cut_mark, drop_cuts, small_batches

GROUP = 20
HEADS = 4
#: Depths of a chain or conversation that share a join key.
BLOCK = 4096
P = (1 << 31) - 1
LANES = 3
#: Sets of bases to try; a group that fails verification calls for the next.
SEEDS = (7, 77, 777, 7777)
#: Ids in one piece of an end list.
_PIECE = 4096

Q = [f"q{i}" for i in range(LANES)]
REF = [f"r{i}" for i in range(4)]
NODE = ["depth", *Q]


def bases(seed: int) -> list[int]:
    return np.random.default_rng(seed).integers(1 << 20, P, size=LANES).tolist()


def _power(base: int, exponent: Column) -> Column:
    """``base ^ exponent`` modulo P by binary digits (exponents of any table)."""
    squares = F.array(*[F.lit(pow(base, 1 << b, P)).cast("long") for b in range(48)])
    digits = F.sequence(F.lit(0), F.lit(47))
    return F.aggregate(digits, F.lit(1).cast("long"), lambda acc, b: F.when(
        F.getbit(exponent.cast("long"), b) == 1, F.pmod(acc * F.get(squares, b), F.lit(P))).otherwise(acc))


def _mod(x: Column) -> Column:
    return F.pmod(x, F.lit(P).cast("long"))


def turns_of(conversations: DataFrame) -> DataFrame:
    """``conv_id, turn, digest, words`` of every turn."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    key = F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)
    return conversations.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long"), "turn", F.unhex(F.sha2(key, 256)).alias("digest"),
        F.regexp_count(text, F.lit(WORD)).cast("long").alias("words"))


# -- running products -----------------------------------------------------------------------------

_SCAN = "conv_id bigint, words bigint, pid int, k bigint, " + ", ".join(
    [f"{r} bigint" for r in REF] + [f"{q} bigint" for q in Q] + [f"b{q} bigint" for q in Q])


def _running(base: list[int]):
    """Sorted (conv_id, digest, words, pid) to place and products inside the range, before (``b``) and with each turn."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers = [np.ones(1, dtype=np.int64) for _ in base]
        last, place, carried = None, 0, [0] * len(base)
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            conv = batch.column("conv_id").to_numpy()
            ref = np.frombuffer(b"".join(batch.column("digest").to_pylist()), dtype="<i8").reshape(n, 4)
            first = np.flatnonzero(np.append(True, conv[1:] != conv[:-1]))
            start = np.repeat(first, np.diff(np.append(first, n)))
            k = np.arange(n, dtype=np.int64) - start + 1
            goes_on = (start == 0) & (conv[0] == last)  # rows of the conversation that the last batch ended in
            k += np.where(goes_on, place, 0)
            cols = []
            for lane, b in enumerate(base):
                while len(powers[lane]) <= k.max():
                    powers[lane] = np.concatenate([powers[lane], powers[lane] * pow(b, len(powers[lane]), P) % P])
                term = (ref[:, lane] % P) * powers[lane][k] % P
                total = np.cumsum(term)
                q = (total - (total - term)[start] + np.where(goes_on, carried[lane], 0)) % P
                cols.append((q, (q - term) % P))
            last, place, carried = conv[-1], int(k[-1]), [int(q[-1]) for q, _ in cols]
            yield pa.RecordBatch.from_arrays(
                [pa.array(conv), batch.column("words"), batch.column("pid"), pa.array(k), *[pa.array(ref[:, i].copy()) for i in range(4)],
                 *[pa.array(q) for q, _ in cols], *[pa.array(b) for _, b in cols]],
                names=["conv_id", "words", "pid", "k", *REF, *Q, *[f"b{q}" for q in Q]])

    return run


def products(turns: DataFrame, base: list[int], ranges: int | None = None) -> DataFrame:
    """``conv_id, words, k, r0-r3, q0-q2, bq0-bq2``: place and products of every turn in its own conversation."""
    spark = turns.sparkSession
    n = ranges or max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    order = [F.col("conv_id"), F.col("turn").asc_nulls_first(), F.col("digest")]
    ranged = (turns.repartitionByRange(n, *order).withColumn("pid", F.spark_partition_id()).sortWithinPartitions(*order)
              .select("conv_id", "digest", "words", "pid"))
    local = cut(ranged.mapInArrow(_running(base), _SCAN), "trie-products")
    # only the first and the last conversation of a range can span several: at most two rows a range
    ends = local.groupBy("pid").agg(F.min("conv_id").alias("lo"), F.max("conv_id").alias("hi"))
    spanning = (ends.select(F.explode(F.array_distinct(F.array("lo", "hi"))).alias("conv_id"))
                .groupBy("conv_id").count().where("count > 1").select("conv_id"))
    pieces = local.join(F.broadcast(spanning), "conv_id").groupBy("conv_id", "pid").agg(
        F.max("k").alias("n"), *[F.max_by(q, "k").alias(q) for q in Q])
    before = Window.partitionBy("conv_id").orderBy("pid").rowsBetween(Window.unboundedPreceding, -1)
    pieces = pieces.withColumn("off", F.coalesce(F.sum("n").over(before), F.lit(0))).withColumns(
        {f"s{q}": _power(b, F.col("off")) for q, b in zip(Q, base)})
    carried = pieces.select("conv_id", "pid", "off", *[f"s{q}" for q in Q], *[
        _mod(F.coalesce(F.sum(_mod(F.col(q) * F.col(f"s{q}"))).over(before), F.lit(0))).alias(f"c{q}") for q in Q])
    placed = local.join(F.broadcast(carried), ["conv_id", "pid"], "left")

    def whole(q: str, name: str) -> Column:
        return _mod(F.coalesce(f"c{q}", F.lit(0)) + F.coalesce(f"s{q}", F.lit(1)) * F.col(name)).alias(name)

    return placed.select("conv_id", "words", (F.col("k") + F.coalesce("off", F.lit(0))).alias("k"), *REF,
                         *[whole(q, q) for q in Q], *[whole(q, f"b{q}") for q in Q])


# -- rebuilt conversations ------------------------------------------------------------------------


def _block(depth: str) -> Column:
    return F.floor(F.col(depth) / BLOCK)


def rebuilt(turns: DataFrame, base: list[int]) -> DataFrame:
    """``conv_id, depth, q0-q2`` (the node), ``bq0-bq2`` (its parent), ``r0-r3``, ``words``, ``last``; depth 0 included."""
    own = products(turns, base)
    heads = range(1, HEADS)

    def at(k: int, col: str) -> Column:
        return F.max(F.when(F.col("k") == k, F.col(col))).alias(f"{col}_{k}")

    convs = own.groupBy("conv_id").agg(F.max("k").alias("n"), *[at(k, c) for k in heads for c in (*Q, *REF, "words")])
    convs = cut(convs.withColumns({"base": F.col("conv_id") - F.col("conv_id") % GROUP,
                                   "h": F.crc32(F.col("conv_id").cast("string").cast("binary")) % HEADS}), "trie-conversations")
    bases_ = convs.where(F.col("conv_id") == F.col("base")).select(
        F.col("conv_id").alias("base"), F.col("n").alias("base_n"), *[F.col(f"{c}_{k}").alias(f"base_{c}_{k}") for k in heads for c in (*Q, *REF, "words")])

    def pick(count: str, stem: str) -> Column:  # the product over the first turns, 0 for none
        return F.coalesce(*[F.when(F.col(count) == k, F.col(f"{stem}_{k}")) for k in heads], F.lit(0).cast("long"))

    info = convs.join(bases_, "base", "left").withColumn("taken", F.least(F.col("h"), F.coalesce("base_n", F.lit(0))))
    info = info.withColumns({"skipped": F.least("h", "n")}).withColumn("depth_end", F.col("taken") + F.col("n") - F.col("skipped"))
    # shift: B^(taken - h), and the products of the base's beginning and of the own turns left out
    shifts = {f"s{q}": F.get(F.array(*[F.lit(pow(b, d, P)).cast("long") for d in range(-HEADS + 1, HEADS)]),
                             (F.col("taken") - F.col("skipped") + HEADS - 1).cast("int")) for q, b in zip(Q, base)}
    info = info.withColumns({**shifts, **{f"h{q}": pick("taken", f"base_{q}") for q in Q},
                             **{f"o{q}": pick("skipped", q) for q in Q}})
    keys = info.select("conv_id", "h", "taken", "skipped", "depth_end", *[f"{x}{q}" for x in "sho" for q in Q],
                       F.explode(F.sequence(F.lit(0).cast("long"), _block("n"))).alias("block"))

    def moved(q: str, name: str) -> Column:
        return _mod(F.col(f"h{q}") + F.col(f"s{q}") * _mod(F.col(name) - F.col(f"o{q}"))).alias(name)

    depth = F.col("k") - F.col("skipped") + F.col("taken")
    tail = (own.withColumn("block", _block("k")).join(keys, ["conv_id", "block"]).where(F.col("k") > F.col("h"))
            .select("conv_id", depth.alias("depth"), *[moved(q, q) for q in Q], *[moved(q, f"b{q}") for q in Q], *REF, "words",
                    (depth == F.col("depth_end")).alias("last")))
    zero = F.lit(0).cast("long")
    steps = [F.struct(zero.alias("depth"), *[zero.alias(q) for q in Q], *[zero.alias(f"b{q}") for q in Q], *[zero.alias(r) for r in REF],
                      zero.alias("words"))]
    for k in heads:
        steps.append(F.struct(F.lit(k).cast("long").alias("depth"), *[F.col(f"base_{q}_{k}").alias(q) for q in Q],
                              *[(F.col(f"base_{q}_{k - 1}") if k > 1 else zero).alias(f"b{q}") for q in Q],
                              *[F.col(f"base_{r}_{k}").alias(r) for r in REF], F.col(f"base_words_{k}").alias("words")))
    head = (info.select("conv_id", "taken", "depth_end", F.explode(F.array(*steps)).alias("x")).where(F.col("x.depth") <= F.col("taken"))
            .select("conv_id", "x.*", (F.col("x.depth") == F.col("depth_end")).alias("last")))
    return head.unionByName(tail)


# -- nodes ----------------------------------------------------------------------------------------


def nodes_of(rows: DataFrame) -> DataFrame:
    """One row per node: owner, members, words, parent; ``sound`` if all members share turn reference and parent."""
    proven = [*REF, *[f"b{q}" for q in Q], "words"]
    sound = F.lit(True)
    for c in proven:
        sound = sound & (F.max(c) == F.min(c))
    return rows.groupBy(*NODE).agg(F.min("conv_id").alias("owner"), F.count(F.lit(1)).alias("n_convs"), F.max("words").alias("words"),
                                   *[F.max(f"b{q}").alias(f"b{q}") for q in Q], sound.alias("sound"))


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted (node, conv_id) to (node, first id, ids joined by commas), at most ``_PIECE`` ids each."""
    def out(key: tuple, ids: list[int]) -> list:
        return [*key, ids[0], ",".join(map(str, ids))]

    def batch_of(rows: list[list]) -> pa.RecordBatch:
        cols = list(zip(*rows))
        return pa.RecordBatch.from_arrays([*[pa.array(c, pa.int64()) for c in cols[:-1]], pa.array(cols[-1], pa.string())],
                                          names=[*NODE, "first", "ids"])

    key, ids = None, []
    for batch in batches:
        rows = []
        for *k, c in zip(*[col.to_pylist() for col in batch.columns]):
            if k != key or len(ids) == _PIECE:
                if ids:
                    rows.append(out(key, ids))
                key, ids = k, []
            ids.append(c)
        if rows:
            yield batch_of(rows)
    if ids:
        yield batch_of([out(key, ids)])


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pieces sorted by (node, first id) to (node, SHA-256 of all ids of the node)."""
    def batch_of(rows: list[list]) -> pa.RecordBatch:
        cols = list(zip(*rows))
        return pa.RecordBatch.from_arrays([*[pa.array(c, pa.int64()) for c in cols[:-1]], pa.array(cols[-1], pa.string())],
                                          names=[*NODE, "ends"])

    key, state = None, None
    for batch in batches:
        rows = []
        for *k, text in zip(*[batch.column(c).to_pylist() for c in [*NODE, "ids"]]):
            if k != key:
                if state:
                    rows.append([*key, state.hexdigest()])
                key, state = k, hashlib.sha256(text.encode())
            else:
                state.update(b"," + text.encode())
        if rows:
            yield batch_of(rows)
    if state:
        yield batch_of([[*key, state.hexdigest()]])


def ends_of(rows: DataFrame) -> DataFrame:
    """``depth, q0-q2, ends``: SHA-256 of the ids that end at a node."""
    spark, order = rows.sparkSession, [*NODE, "conv_id"]
    n = max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    kind = ", ".join(f"{c} bigint" for c in NODE)
    pieces = (rows.where("last").select(*order).repartitionByRange(n, *order).sortWithinPartitions(*order)
              .mapInArrow(_pieces, f"{kind}, first bigint, ids string"))
    return (pieces.repartition(*NODE).sortWithinPartitions(*NODE, "first").mapInArrow(_digests, f"{kind}, ends string"))


def _verified(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    for seed in SEEDS:
        mark = cut_mark()
        rows = cut(rebuilt(turns, bases(seed)), "trie-rows")
        nodes = cut(nodes_of(rows), "trie-nodes")
        if not nodes.where(~F.col("sound")).limit(1).count():
            return rows, nodes
        drop_cuts(turns.sparkSession, mark)
    raise RuntimeError(f"fingerprints of different beginnings met under each of {len(SEEDS)} sets of bases")


def trie(conversations: DataFrame) -> DataFrame:
    """One row per node: ``conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256``."""
    small_batches(conversations.sparkSession)
    rows, nodes = _verified(cut(turns_of(conversations), "trie-turns"))
    up = [(F.col("depth") - 1).alias("depth"), *[F.col(f"b{q}").alias(q) for q in Q]]
    children = nodes.where("depth > 0").select(*up).groupBy(*NODE).agg(F.count(F.lit(1)).alias("n_children"))
    nodes = cut(nodes.join(children, NODE, "left").select(
        *NODE, *[f"b{q}" for q in Q], "owner", "n_convs", F.coalesce("n_children", F.lit(0).cast("long")).alias("n_children"),
        ((F.col("n_convs") - 1) * F.col("words")).alias("saved"), _block("depth").alias("block")), "trie-children")
    # chains: what an owner's blocks hold, and what lies below each of its nodes
    blocks = nodes.groupBy("owner", "block").agg(F.min("depth").alias("top"), F.sum("saved").alias("saved"),
                                                 F.sum((F.col("n_children") == 0).cast("long")).alias("leaves"))
    later = Window.partitionBy("owner").orderBy(F.col("block").desc()).rowsBetween(Window.unboundedPreceding, -1)
    all_of = Window.partitionBy("owner")
    blocks = cut(blocks.select("owner", "block", F.coalesce(F.sum("saved").over(later), F.lit(0)).alias("below"),
                               F.min("top").over(all_of).alias("top"), F.sum("saved").over(all_of).alias("all_saved"),
                               F.sum("leaves").over(all_of).alias("all_leaves")), "trie-chains")
    down = Window.partitionBy("owner", "block").orderBy(F.col("depth").desc()).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    chained = (nodes.withColumn("here", F.sum("saved").over(down)).join(blocks, ["owner", "block"])
               .select(*NODE, *[f"b{q}" for q in Q], "owner", "n_convs", "n_children", "top",
                       (F.col("here") + F.col("below")).alias("saved"), F.col("all_leaves").alias("leaves")))
    # rows of a conversation above its own chain hand the whole chain to nodes that others own
    chains = blocks.groupBy("owner").agg(F.max("top").alias("top"), F.max("all_saved").alias("s"), F.max("all_leaves").alias("l"))
    above = chains.where("top > 0 and (s > 0 or l > 0)").select(
        F.col("owner").alias("conv_id"), "top", "s", "l", F.explode(F.sequence(F.lit(0).cast("long"), _block("top"))).alias("block"))
    passed = (rows.select("conv_id", *NODE, _block("depth").alias("block")).join(above, ["conv_id", "block"])
              .where(F.col("depth") < F.col("top")).groupBy(*NODE).agg(F.sum("s").alias("s"), F.sum("l").alias("l")))
    owners = nodes.select(*NODE, F.col("owner").alias("above"))
    heads = chained.where((F.col("depth") == F.col("top")) & (F.col("depth") > 0)).select(*up, F.col("owner").alias("of"))
    parents = heads.join(owners, NODE).select(F.col("of").alias("owner"), (F.col("depth") + 1).alias("depth"), "above")
    out = chained.join(passed, NODE, "left").join(ends_of(rows), NODE, "left").join(parents, ["owner", "depth"], "left")
    return out.select(
        F.col("owner").alias("conv_id"), "depth", F.when(F.col("depth") > 0, F.coalesce("above", "owner")).alias("parent_conv_id"),
        "n_convs", "n_children", (F.col("leaves") + F.coalesce("l", F.lit(0))).alias("n_leaves"),
        (F.col("saved") + F.coalesce("s", F.lit(0))).alias("saved_tokens"),
        F.coalesce("ends", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256"))


def oracle(conversations: str = "conversations") -> str:
    """DuckDB restatement: rebuilt conversations as lists, nodes by their whole beginnings, subtrees by all ancestors."""
    return f"""
WITH t AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS k
  FROM {conversations} WHERE conv_id IS NOT NULL),
h AS ( -- crc32 of the decimal id, bit by bit
  SELECT conv_id, conv_id - conv_id % {GROUP} AS base,
         xor(list_reduce([ord(x)::BIGINT for x in string_split(conv_id::VARCHAR, '')],
                         lambda crc, byte: list_reduce(range(8), lambda x, i: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END, xor(crc, byte)),
                         4294967295), 4294967295) % {HEADS} AS h
  FROM (SELECT DISTINCT conv_id FROM t)),
r AS (
  SELECT h.conv_id, 0 AS part, t.k, t.role, t.text FROM h JOIN t ON t.conv_id = h.base AND t.k <= h.h
  UNION ALL
  SELECT h.conv_id, 1, t.k, t.role, t.text FROM h JOIN t ON t.conv_id = h.conv_id AND t.k > h.h),
d AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY part, k) AS depth, sha256(len(role) || ':' || role || text) AS turn FROM r),
p AS (
  SELECT conv_id, depth, text, string_agg(turn, '') OVER (PARTITION BY conv_id ORDER BY depth) AS path FROM d
  UNION ALL
  SELECT conv_id, 0, '', '' FROM h),
l AS (SELECT conv_id, max(depth) AS depth FROM p GROUP BY conv_id),
e AS (SELECT path, sha256(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id)) AS ends FROM p JOIN l USING (conv_id, depth) GROUP BY path),
n AS (SELECT depth, path, min(conv_id) AS conv_id, count(*) AS n_convs, (count(*) - 1) * len(regexp_extract_all(any_value(text), '[^\\x20\\x09-\\x0D]+')) AS saved
      FROM p GROUP BY depth, path),
k AS (SELECT path[1:len(path) - 64] AS path, count(*) AS n_children FROM n WHERE depth > 0 GROUP BY 1),
s AS ( -- every node to every node above it, along its smallest member
  SELECT p.path, sum(n.saved) AS saved_tokens, sum(CASE WHEN k.n_children IS NULL THEN 1 ELSE 0 END) AS n_leaves
  FROM n LEFT JOIN k ON n.path = k.path JOIN p ON p.conv_id = n.conv_id AND p.depth <= n.depth GROUP BY p.path)
SELECT n.conv_id, n.depth::BIGINT AS depth, u.conv_id AS parent_conv_id, n.n_convs, coalesce(k.n_children, 0) AS n_children, s.n_leaves::BIGINT AS n_leaves,
       s.saved_tokens::BIGINT AS saved_tokens, coalesce(e.ends, '{hashlib.sha256(b"").hexdigest()}') AS ends_sha256
FROM n JOIN s ON n.path = s.path LEFT JOIN k ON n.path = k.path LEFT JOIN e ON n.path = e.path
LEFT JOIN n u ON n.depth > 0 AND u.path = n.path[1:len(n.path) - 64]
"""
