"""Language identification by interpolated Kneser-Ney character models.

One model per language of the training rows, from character n-grams inside words (letters only,
lower case, with word boundaries).  The models live side by side in sorted hash arrays; a text's
score under a language is its cross-entropy per character, and the lowest one wins.

Rejection is calibrated: the cross-entropy of every training text under its own language is
measured, and a text whose cross-entropy lies further above its winner's mean than
``REJECT`` standard deviations at its length is flagged ``rejected``.

Every n-gram of the training texts is in the models.  Up to ``charlm.LOCAL_ENTRIES`` entries they
travel to the tasks; larger ones stay tables, and the n-grams of the texts are joined with them:
the same numbers by a slower way, with nothing gathered but the names of the languages.  The
medians of the calibration come from histograms over all training texts, exact to ``1 / GRID``.

Defined results: NULL text or text without a letter gives ``und`` with score 0; rows with a NULL
language or text are not learned from; equal cross-entropies go to the first language in code
point order; repeated rows score alike; without training rows every text is ``und``; an empty
table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from strata.llm import charlm
from strata.llm.common import crc_mod, cut, per_batch, raw, small_batches

ORDER = 4
GRID = 10_000  # cells of a unit in the calibration's histograms
REJECT = 8.0
_LONG = 2_000  # characters beyond which more length adds no certainty


@dataclass
class Model:
    fitted: charlm.Fitted
    tables: charlm.Tables | None  # None: too large to travel
    mean: dict[str, float]
    spread: dict[str, float]

    @property
    def names(self) -> list[str]:
        return self.fitted.names


def scored_words(text: bytes) -> list[str]:
    return [w for w in charlm.words_of(text) if w[0].isalpha() or any(map(str.isalpha, w))]


def entropies(tables: charlm.Tables, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(characters with word ends, cross-entropy per character under each language) of each text."""
    ids: dict[str, int] = {}
    seq: list[int] = []
    sizes = []
    for t in texts:
        found = scored_words(t)
        seq += [ids.setdefault(w, len(ids)) for w in found]
        sizes.append(len(found))
    n = len(texts)
    chars, total = np.zeros(n, dtype=np.int64), np.zeros((n, len(tables.names)))
    if seq and tables.names:
        vocabulary = list(ids)
        length = np.array([len(w) + 1 for w in vocabulary])
        logp = tables.words(vocabulary)
        at = np.array(seq)
        sizes = np.array(sizes)
        full = np.nonzero(sizes)[0]
        starts = (np.cumsum(sizes) - sizes)[full]
        chars[full] = np.add.reduceat(length[at], starts)
        for j in range(total.shape[1]):
            total[full, j] = np.add.reduceat(logp[at, j], starts)
    return chars, -total / np.maximum(chars, 1)[:, None]


def _gram_counts(order: int):
    """Column function: the distinct n-grams of a text with their counts."""
    kind = pa.list_(pa.struct([("gram", pa.string()), ("n", pa.int64())]))

    def make():
        def run(texts):
            out = []
            for t in texts:
                sums: Counter = Counter()
                for w, n in Counter(scored_words(t)).items():
                    for g in charlm.grams_of(w, order):
                        sums[g] += n
                out.append([{"gram": g, "n": n} for g, n in sums.items()])
            return pa.array(out, type=kind)
        return run
    return per_batch(make, "array<struct<gram:string,n:bigint>>")


def measured(rows: DataFrame, keep: list[str], fitted: charlm.Fitted, tables: charlm.Tables | None) -> DataFrame:
    """``keep`` columns of each row, ``chars`` and the cross-entropies ``h`` of its ``raw`` text by language."""
    if tables is not None or not fitted.names:
        def make():
            def run(texts):
                if tables is None:
                    chars, h = [0] * len(texts), [[]] * len(texts)
                else:
                    chars, h = entropies(tables, texts)
                return pa.array([{"chars": int(c), "h": [float(v) for v in x]} for c, x in zip(chars, h)],
                                type=pa.struct([("chars", pa.int64()), ("h", pa.list_(pa.float64()))]))
            return run
        return rows.select(*keep, per_batch(make, "chars bigint, h array<double>")(F.col("raw")).alias("_m")).select(*keep, "_m.*")
    # the row numbers are settled once written
    base = cut(rows.select(*keep, F.monotonically_increasing_id().alias("_row"), _gram_counts(fitted.order)(F.col("raw")).alias("_grams")),
               "lang-grams")
    each = base.select("_row", F.inline("_grams"))
    values = cut(charlm.resolve(each.select("gram").distinct(), fitted), "lang-values")
    sums = [F.sum(F.col("n") * F.get("v", F.lit(j))) for j in range(len(fitted.names))]
    total = each.join(values, "gram").groupBy("_row").agg(F.sum("n").alias("chars"), F.array(*sums).alias("logp"))
    return (base.select(*keep, "_row").join(total, "_row", "left")
            .select(*keep, F.coalesce("chars", F.lit(0).cast("bigint")).alias("chars"),
                    F.coalesce(F.transform("logp", lambda x: -x / F.col("chars")),
                               F.array_repeat(F.lit(0.0), len(fitted.names))).alias("h")))


def fit(docs: DataFrame, train: Column, order: int = ORDER, local_entries: int = charlm.LOCAL_ENTRIES) -> Model:
    """Learn from ``text`` and ``lang`` of the rows that meet ``train``."""
    small_batches(docs.sparkSession)
    rows = docs.where(train & F.col("lang").isNotNull() & F.col("text").isNotNull()).select(
        F.col("lang").alias("model"), F.col("doc_id").alias("id"), raw("text").alias("raw"))
    fitted = charlm.fit_tables(charlm.count_grams(rows, order), order)
    tables = charlm.Tables.build(charlm.KneserNey.collected(fitted)) if fitted.names and fitted.fits(local_entries) else None
    mean, spread = calibrate(fitted, tables, rows)
    return Model(fitted, tables, mean, spread)


def _medians(rows: DataFrame, value: Column) -> dict[str, float]:
    """Median of ``value`` by ``model`` over all rows, from counts of cells of width ``1 / GRID``."""
    cells = rows.groupBy("model", F.round(value * GRID).cast("bigint").alias("cell")).agg(F.count(F.lit(1)).alias("n"))
    whole = Window.partitionBy("model")  # the cells of a language, not its texts: their number does not grow with them
    at = cells.select("model", "cell", F.sum("n").over(whole.orderBy("cell")).alias("upto"), F.sum("n").over(whole).alias("all"))
    lower, upper = F.expr("(all + 1) div 2"), F.expr("all div 2 + 1")
    return {m: (lo + up) / 2 / GRID for m, lo, up in at.groupBy("model").agg(
        F.min(F.when(F.col("upto") >= lower, F.col("cell"))), F.min(F.when(F.col("upto") >= upper, F.col("cell")))).collect()}


def calibrate(fitted: charlm.Fitted, tables: charlm.Tables | None, rows: DataFrame) -> tuple[dict, dict]:
    """Median cross-entropy of each language's training texts, and their spread about it."""
    if not fitted.names:
        return {}, {}
    place = F.create_map(*[x for i, n in enumerate(fitted.names) for x in (F.lit(n), F.lit(i))])
    # rows without a letter go once written: a filter on what the texts are measured by would be pushed below the
    # measuring, which then ran twice, in two Python workers a task
    own = cut(measured(rows, ["model"], fitted, tables).select(
        "model", F.least("chars", F.lit(_LONG)).alias("n"), F.get("h", place[F.col("model")]).alias("h")), "lang-calibration").where("n > 0")
    mean = _medians(own, F.col("h"))
    if not mean:
        return {}, {}
    centre = F.create_map(*[x for m, v in mean.items() for x in (F.lit(m), F.lit(v))])[F.col("model")]
    spread = _medians(own, F.abs(F.col("h") - centre) * F.sqrt("n"))
    return mean, {m: v * 1.4826 + 1e-6 for m, v in spread.items()}


def decide(names: list[str], mean: dict[str, float], spread: dict[str, float], chars: np.ndarray, h: np.ndarray) -> list[tuple]:
    """(language, score, cross-entropy, rejected) of each text from its cross-entropies."""
    if not names:
        return [("und", 0.0, None, True)] * len(chars)
    best = h.argmin(axis=1)
    top = h[np.arange(len(h)), best]
    # softmax of the length-normalised cross-entropies, sharper for longer texts
    z = -(h - top[:, None]) * np.sqrt(np.minimum(chars, _LONG))[:, None]
    score = 1 / np.exp(z.clip(-700, 0)).sum(axis=1)
    out = []
    for i in range(len(h)):
        if not chars[i]:
            out.append(("und", 0.0, None, True))
            continue
        lang = names[best[i]]
        far = (top[i] - mean.get(lang, 0.0)) * np.sqrt(min(chars[i], _LONG)) > REJECT * spread.get(lang, np.inf)
        out.append((lang, round(float(score[i]), 9), round(float(top[i]), 9), bool(far)))
    return out


_TYPE = pa.struct([("lang_pred", pa.string()), ("score", pa.float64()), ("cross_entropy", pa.float64()), ("rejected", pa.bool_())])


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """One row per document: ``doc_id, lang_pred, score, cross_entropy, rejected``."""
    small_batches(docs.sparkSession)
    names, mean, spread, tables = model.names, model.mean, model.spread, model.tables

    def struct(rows: list[tuple]) -> pa.StructArray:
        cols = list(zip(*rows)) or [()] * 4
        return pa.StructArray.from_arrays([pa.array(c, type=f.type) for c, f in zip(cols, _TYPE)], fields=list(_TYPE))

    ddl = "lang_pred string, score double, cross_entropy double, rejected boolean"
    rows = docs.select("doc_id", raw("text").alias("raw"))
    if tables is not None or not names:
        def make():
            def run(texts):
                chars, h = entropies(tables, texts) if names else (texts, None)
                return struct(decide(names, mean, spread, chars, h))
            return run
        return rows.select("doc_id", per_batch(make, ddl)(F.col("raw")).alias("p")).select("doc_id", "p.*")

    @arrow_udf(ddl)
    def choose(chars: pa.Array, h: pa.Array) -> pa.Array:
        n = len(chars)
        return struct(decide(names, mean, spread, chars.to_numpy(zero_copy_only=False), np.array(h.to_pylist(), dtype=float).reshape(n, len(names))))

    return measured(rows, ["doc_id"], model.fitted, None).select("doc_id", choose("chars", "h").alias("p")).select("doc_id", "p.*")


def training_rows() -> Column:
    """The fixed split: rows whose crc32 of the id is not 1 modulo 3."""
    return crc_mod("doc_id", 3) != 1
