"""Interpolated Kneser-Ney character language models.

Counting runs in Spark over whole texts (Python sums inside each task, one shuffle of distinct
n-grams), and so does the fit: continuation counts, context totals, discounts and probabilities of
every n-gram are aggregations and joins keyed by n-gram (``fit_tables``).  No n-gram is dropped.

A fitted model is used in one of two ways, with equal results: up to ``LOCAL_ENTRIES`` entries its
tables are collected and travel to the tasks; a larger one stays a table, and the n-grams that are
to be scored are joined with it (``resolve``).
"""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import cut

START, END = "\x02", "\x03"
LETTERS = re.compile(r"[^\W\d_]+")

#: Entries (probabilities and back-off weights of all orders and models) that may travel to the tasks: some
#: 100 MB as dictionaries there.
LOCAL_ENTRIES = 500_000
#: Cells (n-grams x models) of the arrays that may travel to the tasks: 64 MB.
LOCAL_CELLS = 16_000_000

#: Cells (characters x models) that are looked up at a time: some 20 MB.
_CELLS = 1_000_000

#: A task's running word counts are spelled out into n-grams when they hold this many distinct words.
_FLUSH = 400_000


def words_of(text: bytes) -> list[str]:
    return LETTERS.findall(text.decode("utf-8", "replace").lower())


def grams_of(word: str, order: int) -> list[str]:
    s = START * (order - 1) + word + END
    return [s[i:i + order] for i in range(len(word) + 1)]


def _expand(words: dict[str, Counter], order: int) -> Iterator[pa.RecordBatch]:
    """n-grams of counted words."""
    for model, counts in words.items():
        sums: dict[str, int] = defaultdict(int)
        for w, n in counts.items():
            s = START * (order - 1) + w + END
            for i in range(len(w) + 1):
                sums[s[i:i + order]] += n
        yield pa.RecordBatch.from_arrays([pa.array([model] * len(sums), pa.string()), pa.array(list(sums), pa.string()),
                                          pa.array(list(sums.values()), pa.int64())], names=["model", "gram", "n"])


def count_grams(texts: DataFrame, order: int) -> DataFrame:
    """(model, gram, n): n-grams of ``order`` characters inside words, from columns ``model`` and ``raw``."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words: dict[str, Counter] = defaultdict(Counter)
        for batch in batches:
            for model, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                words[model].update(words_of(text))
            if sum(map(len, words.values())) > _FLUSH:
                yield from _expand(words, order)
                words.clear()
        yield from _expand(words, order)

    partial = texts.select("model", "raw").mapInArrow(count, "model string, gram string, n bigint")
    return cut(partial.groupBy("model", "gram").agg(F.sum("n").alias("n")), "char-grams")


@dataclass
class Fitted:
    """Models of every n-gram as tables, by order: ``probs`` (model, gram, value) and ``backs`` (model, gram, value)."""

    order: int
    names: list[str]
    floor: float
    probs: dict[int, DataFrame]
    backs: dict[int, DataFrame]
    n_entries: int
    n_grams: dict[str, int]  # of the highest order, by model

    def fits(self, entries: int = LOCAL_ENTRIES) -> bool:
        """Whether the tables may be collected."""
        return self.n_entries <= entries and self.n_entries * len(self.names) <= LOCAL_CELLS


def fit_tables(counts: DataFrame, order: int) -> Fitted:
    """Interpolated Kneser-Ney over all counted n-grams ``(model, gram, n)``; only one row a model and order is collected."""
    levels = {order: counts}
    for k in range(order - 1, 0, -1):
        # continuation counts: in how many different left contexts a shorter n-gram stands
        levels[k] = cut(levels[k + 1].groupBy("model", F.substring("gram", 2, k).alias("gram")).agg(F.count("*").alias("n")), f"char-level-{k}")
    stats = {k: {r[0]: r[1:] for r in levels[k].groupBy("model").agg(
        F.count_if(F.col("n") == 1), F.count_if(F.col("n") == 2), F.count("*")).collect()} for k in levels}
    names = sorted(stats[order])
    # every character but the opening mark ends some n-gram
    alphabet = levels[1].select("gram").distinct().count() + (1 if names and order > 1 else 0)
    floor = float(-np.log(alphabet + 1))
    probs: dict[int, DataFrame] = {}
    backs: dict[int, DataFrame] = {}
    total = 0
    for k in range(1, order + 1):
        discounts = counts.sparkSession.createDataFrame(
            [(m, n1 / (n1 + 2 * n2) if n1 and n2 else 0.5) for m, (n1, n2, _) in stats[k].items()], "model string, discount double")
        heads = cut(levels[k].groupBy("model", F.substring("gram", 1, k - 1).alias("head"))
                    .agg(F.sum("n").alias("total"), F.count("*").alias("kinds"))
                    .join(F.broadcast(discounts), "model")  # one row a model
                    .withColumn("value", F.log(F.col("discount") * F.col("kinds") / F.col("total"))), f"char-heads-{k}")
        rows = levels[k].withColumn("head", F.substring("gram", 1, k - 1)).join(heads, ["model", "head"])
        if k == 1:
            rows = rows.withColumn("lower", F.lit(floor))
        else:
            shorter = probs[k - 1].select("model", F.col("gram").alias("tail"), F.col("value").alias("lower"))
            rows = rows.withColumn("tail", F.substring("gram", 2, k - 1)).join(shorter, ["model", "tail"])
        seen = F.greatest(F.col("n") - F.col("discount"), F.lit(0.0)) / F.col("total")
        probs[k] = cut(rows.select("model", "gram", F.log(seen + F.exp(F.col("value") + F.col("lower"))).alias("value")), f"char-probs-{k}")
        backs[k] = heads.select("model", F.col("head").alias("gram"), "value")
        total += sum(c for _, _, c in stats[k].values()) + heads.count()
    return Fitted(order, names, floor, probs, backs, total, {m: v[2] for m, v in stats[order].items()})


def resolve(grams: DataFrame, fitted: Fitted) -> DataFrame:
    """(gram, v): the log probability of each distinct n-gram of the highest order under every model, back-off included."""
    out = grams.withColumn("v", F.array_repeat(F.lit(fitted.floor), len(fitted.names)))
    names = F.array(*[F.lit(n) for n in fitted.names])
    for k in range(1, fitted.order + 1):
        tail = F.substring("gram", fitted.order - k + 1, k)
        for col, table, key in (("b", fitted.backs[k], F.substring(tail, 1, k - 1)), ("p", fitted.probs[k], tail)):
            side = table.groupBy(F.col("gram").alias("key")).agg(F.map_from_entries(F.collect_list(F.struct("model", "value"))).alias(col))
            out = out.withColumn("key", key).join(side, "key", "left")
        out = out.select("gram", F.transform(names, lambda n, i: F.coalesce(
            F.element_at("p", n), F.get("v", i) + F.coalesce(F.element_at("b", n), F.lit(0.0)))).alias("v"))
    return out


class KneserNey:
    """One model: probabilities of seen n-grams and back-off weights of seen contexts, for orders 1..order."""

    def __init__(self, grams: list[tuple[str, int]], order: int, alphabet: int):
        self.order = order
        self.floor = -np.log(alphabet + 1)
        self.prob: list[dict[str, float]] = [{} for _ in range(order + 1)]
        self.back: list[dict[str, float]] = [{} for _ in range(order + 1)]
        levels: list[dict[str, int]] = [{} for _ in range(order + 1)]
        levels[order] = dict(grams)
        for k in range(order - 1, 0, -1):
            # continuation counts: in how many different left contexts a shorter n-gram stands
            low: Counter = Counter()
            for g in levels[k + 1]:
                low[g[1:]] += 1
            levels[k] = low
        for k in range(1, order + 1):
            counts = levels[k]
            n1 = sum(1 for c in counts.values() if c == 1)
            n2 = sum(1 for c in counts.values() if c == 2)
            discount = n1 / (n1 + 2 * n2) if n1 and n2 else 0.5
            total: Counter = Counter()
            kinds: Counter = Counter()
            for g, c in counts.items():
                total[g[:-1]] += c
                kinds[g[:-1]] += 1
            self.back[k] = {h: float(np.log(discount * kinds[h] / total[h])) for h in total}
            p = self.prob[k]
            for g, c in counts.items():
                lower = self.logp(g[1:]) if k > 1 else self.floor
                h = g[:-1]
                p[g] = float(np.log(max(c - discount, 0.0) / total[h] + np.exp(self.back[k][h] + lower)))

    @staticmethod
    def collected(fitted: Fitted) -> dict[str, "KneserNey"]:
        """The models of tables that fit (``Fitted.fits``), by name."""
        out = {}
        for name in fitted.names:
            m = out[name] = KneserNey([], fitted.order, 0)
            m.floor = fitted.floor
        for k in range(1, fitted.order + 1):
            for side, tables in (("prob", fitted.probs), ("back", fitted.backs)):
                t = tables[k].toArrow()
                for name, gram, value in zip(*(t.column(c).to_pylist() for c in ("model", "gram", "value"))):
                    getattr(out[name], side)[k][gram] = value
        return out

    def logp(self, gram: str) -> float:
        """log P(last character | the ones before), by recursion over shorter contexts."""
        k = len(gram)
        if k == 0:
            return self.floor
        v = self.prob[k].get(gram)
        if v is not None:
            return v
        return self.back[k].get(gram[:-1], 0.0) + (self.logp(gram[1:]) if k > 1 else self.floor)

    def word(self, word: str) -> float:
        return sum(self.logp(g) for g in grams_of(word, self.order))


_rng = np.random.default_rng(7)
_MULT = _rng.integers(1, 2 ** 63, size=(16, 16), dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def _hash_at(cps: np.ndarray, at: np.ndarray, k: int) -> np.ndarray:
    """Hash of the ``k`` characters that end at each position."""
    h = np.zeros(len(at), dtype=np.uint64)
    for j in range(k):
        h += cps[at - j] * _MULT[k, j]
    return h


def _codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32).astype(np.uint64)


@dataclass
class Tables:
    """Several models side by side: for each order a sorted hash array and a row of log values per model."""

    order: int
    names: list[str]
    floor: np.ndarray
    keys: list[np.ndarray]
    values: list[np.ndarray]
    ctx_keys: list[np.ndarray]
    ctx_values: list[np.ndarray]

    @staticmethod
    def build(models: dict[str, KneserNey]) -> "Tables":
        names = list(models)
        order = next(iter(models.values())).order if models else 0
        keys, values, ckeys, cvalues = [np.zeros(0, np.uint64)], [np.zeros((0, 0))], [np.zeros(0, np.uint64)], [np.zeros((0, 0))]
        for k in range(1, order + 1):
            grams = sorted(set().union(*[m.prob[k] for m in models.values()]))
            h = _hash_at(_codes("".join(grams)), np.arange(len(grams)) * k + k - 1, k)
            v = np.array([[m.logp(g) for m in models.values()] for g in grams], dtype=np.float32).reshape(len(grams), len(names))
            o = np.argsort(h)
            keys.append(h[o])
            values.append(v[o])
            ctx = sorted(set().union(*[m.back[k] for m in models.values()]))
            if k > 1:
                h = _hash_at(_codes("".join(ctx)), np.arange(len(ctx)) * (k - 1) + k - 2, k - 1)
            else:
                h = np.zeros(len(ctx), np.uint64)
            v = np.array([[m.back[k].get(c, 0.0) for m in models.values()] for c in ctx], dtype=np.float32).reshape(len(ctx), len(names))
            o = np.argsort(h)
            ckeys.append(h[o])
            cvalues.append(v[o])
        return Tables(order, names, np.array([m.floor for m in models.values()], dtype=np.float32), keys, values, ckeys, cvalues)

    def _lookup(self, cps: np.ndarray, at: np.ndarray, k: int) -> np.ndarray:
        if k == 0:
            return np.broadcast_to(self.floor, (len(at), len(self.names))).copy()
        out = np.empty((len(at), len(self.names)), dtype=np.float32)
        h = _hash_at(cps, at, k)
        i = np.searchsorted(self.keys[k], h).clip(max=max(len(self.keys[k]) - 1, 0))
        hit = self.keys[k][i] == h if len(self.keys[k]) else np.zeros(len(at), dtype=bool)
        out[hit] = self.values[k][i[hit]]
        miss = np.nonzero(~hit)[0]
        if len(miss):
            v = self._lookup(cps, at[miss], k - 1)
            if len(self.ctx_keys[k]):
                hc = _hash_at(cps, at[miss] - 1, k - 1) if k > 1 else np.zeros(len(miss), np.uint64)
                j = np.searchsorted(self.ctx_keys[k], hc).clip(max=len(self.ctx_keys[k]) - 1)
                known = self.ctx_keys[k][j] == hc
                v[known] += self.ctx_values[k][j[known]]
            out[miss] = v
        return out

    def words(self, words: list[str]) -> np.ndarray:
        """log P of each word (with its end) under each model: one row per word, looked up in pieces of bounded size."""
        if not words:
            return np.zeros((0, len(self.names)))
        upto = np.cumsum([len(w) + 1 for w in words]) * len(self.names)
        cuts = np.unique(np.searchsorted(upto, np.arange(_CELLS, upto[-1], _CELLS)))
        edges = [0, *(int(c) for c in cuts if c), len(words)]
        return np.concatenate([self._words(words[a:b]) for a, b in zip(edges, edges[1:])])

    def _words(self, words: list[str]) -> np.ndarray:
        pad = START * (self.order - 1)
        cps = _codes("".join([pad + w + END for w in words]))
        length = np.array([len(w) for w in words]) + 1
        ends = np.cumsum(length)
        starts = ends - length
        # position in the padded string of the i-th predicted character of all words
        at = np.arange(ends[-1]) + np.repeat(np.arange(1, len(words) + 1) * (self.order - 1), length)
        return np.add.reduceat(self._lookup(cps, at, self.order).astype(np.float64), starts, axis=0)
