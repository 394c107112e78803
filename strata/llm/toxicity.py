"""Toxicity with noisy-channel deobfuscation.

1. *Restore.*  Suspicious tokens (letters mixed with digits or symbols, single letters spaced out,
   letters repeated three times or more) are read as the output of a noisy channel: every
   character may stand for a few letters, separators may be nothing, a run may be one or two
   letters.  Viterbi decoding of that lattice under a character language model of the whole corpus
   gives the likeliest word; the rest of the text is taken as it is.
2. *Score.*  Words of the restored text and their stems (prefixes) carry log odds learned from
   labelled documents; a logistic model over how many and how strong such words are gives the score.

What is learned from the corpus covers all texts and grows with them: the language model holds
every n-gram.  Up to ``charlm.LOCAL_ENTRIES`` entries it travels to the tasks; a larger one stays a
table, and each text is joined with the n-grams that its own lattices ask for (``restore_joined``):
the same words by a slower way.  Labels are learned from a bounded sample of at most ``LABEL_ROWS``
rows: one half for the log odds of at most ``LEXICON`` stems, the other for the logistic model.

Defined results: NULL and empty texts have no words and score as such; repeated rows score alike;
label rows with a NULL id or label are not used; without rows of both labels every score is 0; an
empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import os
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from strata.llm import charlm
from strata.llm.common import crc_mod, cut, per_batch, raw, small_batches
from strata.llm.quality_rank import labelled_sample, newton

ORDER = 4
LABEL_ROWS = 20_000
LEXICON = 4_000
STEMS = (4, 5, 6, 7)
_LONGEST_FIRST = tuple(sorted(STEMS, reverse=True))

#: Letters that a character may stand for, with the channel's cost in nats.
CHANNEL = {
    "0": [("o", 1.0)], "1": [("i", 1.0), ("l", 1.4)], "2": [("z", 2.0)], "3": [("e", 1.0)], "4": [("a", 1.0)],
    "5": [("s", 1.0)], "6": [("g", 1.6), ("b", 2.0)], "7": [("t", 1.0)], "8": [("b", 1.2)], "9": [("g", 1.4)],
    "@": [("a", 0.8)], "$": [("s", 0.8)], "!": [("i", 1.0), ("l", 1.6), ("", 2.5)], "|": [("l", 1.2), ("i", 1.2)],
    "+": [("t", 1.0)], "(": [("c", 1.4)], "<": [("c", 1.6)], "€": [("e", 1.0)], "£": [("l", 1.4)], "¥": [("y", 1.4)],
    "*": [("", 2.0), ("a", 2.5), ("e", 2.5), ("i", 2.5), ("o", 2.5), ("u", 2.5)],
    "#": [("", 2.0), ("h", 2.0)], ".": [("", 0.6)], "-": [("", 0.6)], "_": [("", 0.6)], "'": [("", 0.6)], " ": [("", 0.2)],
}
KEEP = 9.0         # a digit or symbol that is itself
LONGEST = 32       # longer tokens (repeats collapsed) are several words if joiners part them, else keys
REPEATED = 0.8     # cost of reading a run of three or more as one or two letters

_LEET = "0123456789@$!|+(<€£¥*#"
# possessive: a token is read once, whatever follows it
_SUSPECT = re.compile(
    rf"(?<!\S)[\"'\[{{]?((?=[{re.escape(_LEET)}'_.-]*+[^\W\d_])(?:[^\W\d_]|[{re.escape(_LEET)}'_.-])++)(?=[\"'\]}})?,;:%&]*+(?!\S))")
_SPACED = re.compile(r"(?<![^\W_])[^\W_@](?:[ ._*-]{1,2}[^\W_]){2,}(?![^\W_])")
_RUN = re.compile(r"([^\W\d_])\1{2,}")
_MIXED = re.compile(rf"[^\W\d_][{re.escape(_LEET)}_.-]+[^\W\d_]|(?<!\S)[0-9@$!|+][^\W\d_]|[^\W\d_](?:[0-9]{{1,2}}|[@$])(?!\S)")
_MARK = re.compile(f"(?:{_MIXED.pattern})|(?:{_RUN.pattern})")
_REPEAT = re.compile(r"(.)\1{2,}", re.DOTALL)
_JOINER = re.compile(r"[._-]")
_BLANK = re.compile(r"\s")
_TAIL = re.compile(r"[!?.,;:*#%&$|<>+(-]+$")
_KIND = np.array([1 if c == 128 or chr(c).isalpha() else 2 if chr(c) in _LEET else 3 if chr(c) in "._-" else 4 for c in range(129)],
                 dtype=np.uint8)  # 128: any other character
_FAR_LEET = [ord(c) for c in _LEET if ord(c) >= 128]
#: Cells between attempts to settle the beginning that all readings share.
_SETTLE = 64
#: Longer tokens are not remembered.
_REMEMBER = 128


class Decoder:
    """Viterbi over (last order - 1 characters); several words may be read from one spaced run."""

    def __init__(self, model: charlm.KneserNey):
        self.model = model
        self.width = model.order - 1
        self.cache: dict[tuple[str, bool], str] = {}

    def lattice(self, token: str) -> list[list[tuple[str, float]]]:
        cells, i = [], 0
        while i < len(token):
            c, j = token[i], i + 1
            while j < len(token) and token[j] == c:
                j += 1
            if c.isalpha():
                if j - i >= 3:
                    cells.append([(c, REPEATED), (c + c, REPEATED)])
                else:
                    cells += [[(c, 0.0)]] * (j - i)
            else:
                options = CHANNEL.get(c, [("", 2.0)])
                cells += [options + ([(c, KEEP)] if c.isdigit() else [])] * (1 if j - i >= 3 else j - i)
            i = j
        return cells

    def decode(self, token: str, breaks: bool = False) -> str:
        if len(token) > _REMEMBER:
            return self._decode(token, breaks)
        key = (token, breaks)
        if key not in self.cache:
            if len(self.cache) > 50_000:
                self.cache.clear()
            self.cache[key] = self._decode(token, breaks)
        return self.cache[key]

    def _decode(self, token: str, breaks: bool) -> str:
        start, logp = charlm.START * self.width, self.model.logp
        states: dict[str, tuple[float, str]] = {start: (0.0, "")}
        settled: list[str] = []
        for at, options in enumerate(self.lattice(token), 1):
            new: dict[str, tuple[float, str]] = {}

            def offer(state, cost, out):
                if state not in new or (cost, out) < new[state]:
                    new[state] = (cost, out)

            for state, (cost, out) in states.items():
                for piece, price in options:
                    s, c, o = state, cost + price, out
                    for ch in piece:
                        c -= logp(s + ch)
                        s, o = (s + ch)[1:], o + ch
                    offer(s, c, o)
                    if breaks and piece and s != start:
                        offer(start, c - logp(s + charlm.END), o + " ")
            states = new
            if at % _SETTLE == 0:  # what all readings begin with is final: the cost stays linear in the length
                shared = os.path.commonprefix([o for _, o in states.values()])
                settled.append(shared)
                states = {s: (c, o[len(shared):]) for s, (c, o) in states.items()}
        best = min(((c - (logp(s + charlm.END) if s != start else 0.0), o) for s, (c, o) in states.items()))
        return "".join([*settled, best[1]]).strip()


def restore(raw_text: bytes, decoder: Decoder) -> tuple[str, int]:
    """(text in lower case with suspicious tokens decoded, how many were changed)."""
    suspects = suspicious(raw_text)
    text = raw_text.decode("utf-8", "replace").lower()
    changed = 0
    if not suspects:
        return text, 0

    def spaced(m: re.Match) -> str:
        nonlocal changed
        found = re.sub(r"[ ._*-]+", "", m.group())
        if len(set(found)) < 2 or found.isdigit():
            return m.group()
        changed += 1
        return decoder.decode(found, True)

    def token(m: re.Match) -> str:
        nonlocal changed
        whole = m.group(1)
        core = _TAIL.sub("", whole)
        if not core or "@" in core and "." in core.split("@", 1)[1]:
            return m.group()
        if not _MIXED.search(core) and not _RUN.search(core):
            return m.group()
        long = len(core) > LONGEST and len(_REPEAT.sub(r"\1\1", core)) > LONGEST
        if long and not _JOINER.search(core):
            return m.group()
        out = decoder.decode(core, long)
        if out == core:
            return m.group()
        changed += 1
        return m.group().replace(whole, out)

    if suspects & 1:
        text = _SPACED.sub(spaced, text)
    if suspects & 2 or changed:  # a decoded run may keep a digit
        parts, done = [], 0
        for m in _MARK.finditer(text):
            if m.start() < done:
                continue
            at = m.start()
            while at > done and not text[at - 1].isspace():
                at -= 1
            blank = _BLANK.search(text, m.end() - 1)
            end = blank.start() if blank else len(text)
            parts += [text[done:at], _SUSPECT.sub(token, text[at:end])]
            done = end
        text = "".join([*parts, text[done:]])
    return text, changed


class Asked:
    """A model known only for some n-grams: it notes the others that it is asked for."""

    def __init__(self, order: int, known: dict[str, float]):
        self.order, self.known, self.missing = order, known, set()

    def logp(self, gram: str) -> float:
        v = self.known.get(gram)
        if v is None:
            self.missing.add(gram)
            return 0.0
        return v


_KNOWN = "array<struct<gram:string,p:double>>"


def _pieces(known: pa.Array) -> list[dict[str, float]]:
    return [{x["gram"]: x["p"] for x in v or ()} for v in known.to_pylist()]


def restore_joined(rows: DataFrame, lm: charlm.Fitted) -> DataFrame:
    """``rows`` with the column ``raw`` restored and ``n_restored``, by a model that stays a table.

    A lattice asks for the same n-grams whatever they cost, so they can be listed first, looked up
    by a join, and handed to the text they belong to.  What is read after the spaced runs depends
    on how those were read: hence two rounds.
    """
    order = lm.order

    @arrow_udf("array<string>")
    def asked(raws: pa.Array, known: pa.Array) -> pa.Array:
        out = []
        for text, have in zip(raws.to_pylist(), _pieces(known)):
            model = Asked(order, have)
            restore(text, Decoder(model))
            out.append(sorted(model.missing))
        return pa.array(out, pa.list_(pa.string()))

    @arrow_udf("raw binary, n_restored int")
    def final(raws: pa.Array, known: pa.Array) -> pa.Array:
        found = [restore(text, Decoder(Asked(order, have))) for text, have in zip(raws.to_pylist(), _pieces(known))]
        return pa.StructArray.from_arrays([pa.array([t.encode("utf-8", "replace") for t, _ in found], pa.binary()),
                                           pa.array([n for _, n in found], pa.int32())], names=["raw", "n_restored"])

    others = [c for c in rows.columns if c != "raw"]
    # the row numbers are settled once written
    base = cut(rows.withColumn("_row", F.monotonically_increasing_id()), "toxicity-texts")
    known = base.sparkSession.createDataFrame([], f"_row bigint, _known {_KNOWN}")
    for _ in range(2):
        have = base.join(known, "_row", "left")
        needs = cut(have.select("_row", F.explode(asked("raw", "_known")).alias("gram")), "toxicity-asked")
        values = charlm.resolve(needs.select("gram").distinct(), lm).select("gram", F.get("v", F.lit(0)).alias("p"))
        more = needs.join(values, "gram").unionByName(known.select("_row", F.inline("_known")))
        # what one text asks for, no more
        known = cut(more.groupBy("_row").agg(F.collect_list(F.struct("gram", "p")).alias("_known")), "toxicity-known")
    return (base.join(known, "_row", "left").select(*others, final("raw", "_known").alias("_f"))
            .select(*others, "_f.raw", "_f.n_restored"))


def suspicious(raw_text: bytes) -> int:
    """Which passes a text needs (1: spaced letters, 2: mixed tokens or runs), from its characters alone.

    May call for a pass in vain, but never misses one: what is no ASCII may be a letter or not.
    """
    if raw_text.isascii():
        code = np.frombuffer(raw_text.lower(), dtype=np.uint8)
        kind = _KIND[code]  # 1 letter, 2 leet, 3 joiner, 4 anything else
    else:
        code = np.frombuffer(raw_text.decode("utf-8", "replace").lower().encode("utf-32-le"), dtype=np.uint32)
        kind = _KIND[np.minimum(code, 128)]
        kind[np.isin(code, _FAR_LEET)] = 2
    if len(code) < 2:
        return 0
    letter, leet = kind == 1, kind == 2
    out = 0
    if (bool(((code[2:] == code[1:-1]) & (code[1:-1] == code[:-2]) & letter[2:]).any())
            or bool((leet[1:] & letter[:-1]).any()) or bool((leet[:-1] & letter[1:]).any())):
        out = 2
    else:  # letters on both sides of a run of joiners and leet
        outer = np.nonzero((kind == 1) | (kind == 4))[0]
        apart = outer[1:] - outer[:-1] > 1
        if bool((apart & letter[outer[1:]] & letter[outer[:-1]]).any()):
            out = 2
    far = code >= 128
    digit = (code >= 48) & (code <= 57)
    alnum = letter | digit
    # characters that may stand alone, and the one or two separators between three of them
    edge = np.concatenate([[True], ~alnum | far, [True]])
    at = np.nonzero((alnum | far) & edge[:-2] & edge[2:])[0]
    if len(at) >= 3:
        gap = at[1:] - at[:-1]
        near = (gap == 2) | (gap == 3)
        if bool((near[1:] & near[:-1]).any()):
            out |= 1
    return out


def stems(word: str) -> list[str]:
    """The word itself (closed by a blank) and its prefixes."""
    return [word + " "] + [word[:k] for k in STEMS if len(word) > k]


@dataclass
class Model:
    lm: charlm.KneserNey | charlm.Fitted  # Fitted: too large to travel, texts are restored by ``restore_joined``
    lexicon: dict[str, float]
    weights: np.ndarray | None  # over FEATURES; None: nothing learned

    @property
    def travels(self) -> bool:
        return isinstance(self.lm, charlm.KneserNey)

    def shipped(self) -> "Model":
        """What tasks get."""
        return self if self.travels else Model(None, self.lexicon, self.weights)


FEATURES = ["bias", "strong", "some", "strong_density", "some_density", "two_some", "distinct_strong"]


class Scorer:
    def __init__(self, model: Model):
        self.model = model
        self.decoder = Decoder(model.lm) if model.lm else None  # None: texts come restored
        self.known: dict[str, float] = {}
        self.plain: set[str] = set()

    def weight(self, word: str) -> float:
        """Log odds of a word: those of its longest known stem."""
        w = self.known.get(word)
        if w is None:
            get = self.model.lexicon.get
            w = get(word + " ")
            for k in _LONGEST_FIRST:
                if w is None and len(word) > k:
                    w = get(word[:k])
            w = w or 0.0
            known = self.known if w > 1.0 else self.plain
            if len(known) > 300_000:
                known.clear()
            known.add(word) if known is self.plain else known.update({word: w})
        return w

    def features(self, text: bytes) -> tuple[list[float], int]:
        restored, changed = restore(text, self.decoder) if self.decoder else (text.decode("utf-8", "replace"), 0)
        words = charlm.LETTERS.findall(restored)
        plain = self.plain
        hits = [(w, v) for w in words if w not in plain and (v := self.weight(w)) > 1.0]
        strong = [w for w, v in hits if v > 3.0]
        n = max(len(words), 1)
        return [1.0, float(np.log1p(len(strong))), float(np.log1p(len(hits))), min(1.0, 20 * len(strong) / n),
                min(1.0, 20 * len(hits) / n), float(len(hits) >= 2), float(np.log1p(len(set(strong))))], changed


def restored_stems(sample: DataFrame, lm: charlm.KneserNey | None) -> DataFrame:
    """(stem, toxic documents, other documents) over labelled rows ``raw, _y``; distinct stems per document.

    Without a model the texts come restored.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decoder, sums = Decoder(lm) if lm else None, (Counter(), Counter())
        for batch in batches:
            for y, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                words = set(charlm.LETTERS.findall(restore(text, decoder)[0] if decoder else text.decode("utf-8", "replace")))
                sums[1 if y == 1 else 0].update({s for w in words for s in stems(w)})
        keys = list(sums[0].keys() | sums[1].keys())
        yield pa.RecordBatch.from_arrays(
            [pa.array(keys, pa.string()), pa.array([sums[1][k] for k in keys], pa.int64()),
             pa.array([sums[0][k] for k in keys], pa.int64())], names=["stem", "toxic", "other"])

    part = sample.select("_y", "raw").mapInArrow(count, "stem string, toxic bigint, other bigint")
    return part.groupBy("stem").agg(F.sum("toxic").alias("toxic"), F.sum("other").alias("other"))


def learn_lm(docs: DataFrame, order: int = ORDER, local_entries: int = charlm.LOCAL_ENTRIES) -> charlm.KneserNey | charlm.Fitted:
    """Character model of all texts: in memory if its tables fit, else the tables."""
    rows = docs.select(F.lit("all").alias("model"), raw("text").alias("raw"))
    fitted = charlm.fit_tables(charlm.count_grams(rows, order), order)
    if not fitted.names:
        return charlm.KneserNey([], order, 0)
    return charlm.KneserNey.collected(fitted)["all"] if fitted.fits(local_entries) else fitted


def fit(docs: DataFrame, labels: DataFrame, train: Column | None = None, limit: int = LABEL_ROWS,
        local_entries: int = charlm.LOCAL_ENTRIES) -> Model:
    """Learn the language model from all texts and the rest from labelled rows that meet ``train`` (over ``_id``)."""
    spark = docs.sparkSession
    small_batches(spark)
    lm = learn_lm(docs, local_entries=local_entries)
    train = (crc_mod("_id", 5) != 0) if train is None else train
    sample = cut(labelled_sample(docs, labels, "toxic", train, limit).select(
        "_id", "_y", raw("_text").alias("raw"), (F.pmod(F.xxhash64(F.col("_id"), F.lit(3)), F.lit(2)) == 0).alias("_lex")), "toxicity-sample")
    sizes = {(r[0], r[1]): r[2] for r in sample.groupBy("_lex", (F.col("_y") == 1)).count().collect()}
    if not all(sizes.get((half, y)) for half in (True, False) for y in (True, False)):
        return Model(lm, {}, None)
    travels = isinstance(lm, charlm.KneserNey)
    if not travels:
        sample = cut(restore_joined(sample, lm), "toxicity-sample-restored")
    nt, no = sizes[True, True], sizes[True, False]
    odds = F.log((F.col("toxic") + 0.5) / (nt + 1.0)) - F.log((F.col("other") + 0.5) / (no + 1.0))
    least = max(2, round(0.004 * nt))
    chosen = (restored_stems(sample.where("_lex"), lm if travels else None).where(F.col("toxic") >= least)
              .select("stem", odds.alias("w"), "toxic").where(F.col("w") > 1.0)
              .orderBy(F.desc(F.col("w") * F.sqrt("toxic")), "stem").limit(LEXICON).collect())
    model = Model(lm, {r[0]: float(r[1]) for r in chosen}, None)
    shared = spark.sparkContext.broadcast(model.shipped())

    def make():
        s = Scorer(shared.value)
        return lambda texts: pa.array([s.features(t)[0] for t in texts], type=pa.list_(pa.float64()))

    rows = sample.where(~F.col("_lex")).select("_id", "_y", per_batch(make, "array<double>")(F.col("raw")).alias("x")).collect()
    rows.sort(key=lambda r: (r[0], r[1], r[2]))
    x, y = np.array([r[2] for r in rows]), np.array([float(r[1] == 1) for r in rows])
    model.weights = newton(x, y, 0.0, ridge=0.3)
    return model


_TYPE = pa.struct([("score", pa.float64()), ("n_restored", pa.int32())])


def score(docs: DataFrame, model: Model) -> DataFrame:
    """One row per document: ``doc_id, score, predicted, n_restored``."""
    spark = docs.sparkSession
    small_batches(spark)
    shared = spark.sparkContext.broadcast(model.shipped())

    def make():
        scorer = Scorer(shared.value)

        def run(texts):
            w = scorer.model.weights
            found = [scorer.features(t) for t in texts]
            x = np.array([f for f, _ in found]).reshape(len(found), len(FEATURES))
            p = 1 / (1 + np.exp(-(x @ w).clip(-40, 40))) if w is not None else np.zeros(len(found))
            return pa.StructArray.from_arrays([pa.array(np.round(p, 9), pa.float64()),
                                               pa.array([c for _, c in found], pa.int32())], fields=list(_TYPE))
        return run

    udf = per_batch(make, "score double, n_restored int")
    rows = docs.select("doc_id", raw("text").alias("raw"))
    if model.travels:
        scored = rows.select("doc_id", udf("raw").alias("t")).select("doc_id", "t.score", "t.n_restored")
    else:
        scored = restore_joined(rows, model.lm).select("doc_id", udf("raw").alias("t"), "n_restored").select("doc_id", "t.score", "n_restored")
    return (scored
            .withColumn("predicted", (F.col("score") >= 0.5).cast("int")))
