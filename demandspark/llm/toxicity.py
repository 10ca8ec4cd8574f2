"""Toxicity by maximum-scoring segments over token log-odds.

Fit, on a bounded sample of labelled rows (about SAMPLE, by hash of the id):
how many distinct texts of either label have a unit, smoothed by a Dirichlet
prior of PRIOR pseudo-units spread like all units. Units are whole words and
words' beginnings, as stems take many endings. The lexicon has all units that
toxic texts have significantly more often (signed root of the likelihood
ratio at least SIGNIFICANT) and at a least log-odds, as common words that toxic
texts merely favour would add up over long texts. Which of STRONG the least is,
one part in FOLD of the sample's texts tells: the log loss there of models
fitted on the other parts. Held-out rows have no say. A word scores the log ratio
of the probabilities of its longest unit in the lexicon, any other word that of
the rest. The scores' exponents then have a mean of 1 on clean text: the decay
rate of the extreme-value law is 1, and a segment of score S is expected at
most n exp(-S) times in n clean words.

Scoring: one linear scan finds all maximal segments of the whole text (each
maximal in that no longer one scores more and no part of it is negative at an
end). Those expected less than EXPECTED times are toxic passages. A text's
evidence is the sum of S - log n over its passages, or that of the best
segment where no passage is sure enough. A logistic curve fitted on the
sample's evidence gives the score.

Defined cases: null and empty texts have no tokens and evidence 0; null ids and
repeated rows are kept, each row scored by its text alone; a label row with a
null id or label isn't used, and an id labelled twice counts as toxic if one
label is; without toxic or clean rows in the sample every score is the share
of toxic rows (0 without rows); an empty table gives an empty result. Other
columns aren't read, so their names cannot clash.
"""

from __future__ import annotations

import functools
import math
import re
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from demandspark.llm.bpe_count import Remembered
from demandspark.llm.common import forgets, map_rows, stash
from demandspark.llm.pretokens import chunks

SAMPLE = 20_000
PRIOR = 500.0
STEMS = (6, 5, 4, 3)
SIGNIFICANT = 5.0
STRONG = (0.0, 1.0, 2.0, 3.0, 4.0, 5.0)  # least log-odds to choose from
FOLD = 5  # one of so many parts of the sample tells which
EXPECTED = 0.01
TOKEN = re.compile(r"[^\W\d_]+")


class Model(NamedTuple):
    scores: tuple[tuple[str, float], ...]  # of the lexicon's units
    other: float  # of words without one
    slope: float
    level: float


class Scorer(Remembered):
    """word -> score of its longest unit in the lexicon, 0 without one."""

    def __init__(self, scores: tuple[tuple[str, float], ...]):
        super().__init__(200_000)
        self.scores = dict(scores)

    def find(self, word: str) -> float:
        for unit in units(word):
            if unit in self.scores:
                return self.scores[unit]
        return 0.0


@functools.lru_cache(maxsize=8)
def scorer(scores: tuple[tuple[str, float], ...]) -> Scorer:
    return Scorer(scores)


forgets.append(scorer.cache_clear)


def units(word: str) -> list[str]:
    """The word with its end marked, then its beginnings, longest first."""
    return [word + "$", *(word[:k] for k in STEMS if len(word) >= k)]


def held_out(id_col: str) -> Column:
    return F.crc32(F.col(id_col).cast("string")) % 5 == 0


def segments(hits: list[tuple[int, float]], n: int, other: float) -> list[tuple[int, int, float]]:
    """All maximal scoring segments (first token, end, score); ``hits`` are the lexicon tokens in order.

    Runs of other tokens are one negative item each, so the scan is linear in the hits.
    """
    found: list[tuple[int, int, float, float]] = []  # first, end, sum before, sum after
    total, last = 0.0, 0
    for at, score in hits:
        total += other * (at - last)
        last = at + 1
        before, total = total, total + score
        if score <= 0:
            continue
        piece = (at, at + 1, before, total)
        while True:
            # the latest earlier piece that starts lower
            k = len(found) - 1
            while k >= 0 and found[k][2] >= piece[2]:
                k -= 1
            if k < 0 or found[k][3] >= piece[3]:
                break
            piece = (found[k][0], piece[1], found[k][2], piece[3])
            del found[k:]
        found.append(piece)
    return [(a, b, high - low) for a, b, low, high in found]


def evidence(text: str, model: Model) -> tuple[float, list[tuple[int, int, float]]]:
    """The text's evidence, and its toxic passages as (first token, end, score)."""
    hits, n, score_of = [], 0, scorer(model.scores).__getitem__
    for part in chunks(text):
        tokens = TOKEN.findall(part.lower())
        hits += [(n + i, score) for i, score in enumerate(map(score_of, tokens)) if score]
        n += len(tokens)
    if not hits:
        return -math.log(max(n, 1)), []
    found = segments(hits, n, model.other)
    margin = math.log(max(n, 1))
    sure = [s for s in found if s[2] - margin >= -math.log(EXPECTED)]
    if sure:
        return sum(s[2] - margin for s in sure), sure
    return max((s[2] for s in found), default=0.0) - margin, []


def logistic(x: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and level by Newton steps with a small ridge."""
    centre, scale = float(x.mean()), float(x.std()) or 1.0
    z = np.column_stack([(x - centre) / scale, np.ones(len(x))])
    w, ridge = np.zeros(2), np.array([1e-2, 0.0])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        step = np.linalg.solve((z * (p * (1 - p))[:, None]).T @ z + np.diag(ridge + 1e-9), z.T @ (p - y) + ridge * w)
        w -= np.clip(step, -5, 5)
    return float(w[0] / scale), float(w[1] - w[0] * centre / scale)


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic") -> Model:
    usable = labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("y")).where(F.col("id").isNotNull() & F.col("y").isNotNull() & ~held_out("id"))
    usable = usable.groupBy("id").agg(F.max("y").alias("y"))
    share = SAMPLE / max(usable.count(), 1)
    sample = usable.where(F.pmod(F.xxhash64("id"), F.lit(1_000_000)) < int(min(share, 1.0) * 1_000_000))
    # about SAMPLE rows of 12 bytes
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).join(F.broadcast(sample), "id")
    rows = rows.select(F.coalesce("text", F.lit("")).alias("text"), "y").groupBy("text").agg(F.max("y").alias("y"))
    rows = stash(rows.withColumn("apart", F.pmod(F.xxhash64("text"), F.lit(FOLD)) == 0), "toxic-sample")

    def present(batch: pa.RecordBatch) -> pa.RecordBatch:
        tokens, ys, parts = [], [], []
        for text, y, apart in zip(*(batch.column(k).to_pylist() for k in range(3)), strict=True):
            own = {unit for word in {t for part in chunks(text) for t in TOKEN.findall(part.lower())} for unit in units(word)}
            tokens += own
            ys += [y] * len(own)
            parts += [apart] * len(own)
        return pa.RecordBatch.from_arrays([pa.array(tokens, pa.string()), pa.array(ys, pa.int32()), pa.array(parts, pa.bool_())], names=["token", "y", "apart"])

    def summed(y: Column) -> Column:
        return F.coalesce(F.sum(y), F.lit(0)).cast("double")

    t, c, inner = F.col("y"), 1 - F.col("y"), ~F.col("apart")
    counts = map_rows(rows, "token string, y int, apart boolean", present).groupBy("token").agg(
        summed(t).alias("t"), summed(c).alias("c"), summed(F.when(inner, t)).alias("t_inner"), summed(F.when(inner, c)).alias("c_inner"))
    counts = stash(counts, "toxic-counts")
    n, positive = rows.agg(F.count("*"), F.sum("y")).first()
    found, masses = significant(counts.select("token", "t", "c"))
    if not found or not positive or positive == n:
        rate = min(max((positive or 0) / max(n, 1), 1e-9), 1 - 1e-9)
        return Model((), 0.0, 0.0, math.log(rate / (1 - rate)))
    some, some_masses = significant(counts.select("token", F.col("t_inner").alias("t"), F.col("c_inner").alias("c")))
    strong = STRONG[0]
    if some:  # units from the other parts, judged by how well they tell the part apart
        trials = [lexicon(some, some_masses, least) for least in STRONG]
        pairs = weighed(rows, trials)
        losses = [log_loss(pairs[~pairs["apart"]], pairs[pairs["apart"]], f"x{k}") for k in range(len(trials))]
        strong = STRONG[int(np.argmin(losses))]
    model = lexicon(found, masses, strong)
    pairs = weighed(rows, [model])
    slope, level = logistic(pairs["x0"].to_numpy(), pairs["y"].to_numpy())
    return model._replace(slope=slope, level=level)


def significant(counts: DataFrame) -> tuple[list, tuple[float, float]]:
    """The units (token, t, c, score) that toxic texts have significantly more often, and both sides' totals.

    As many as the bounded sample's texts give.
    """
    toxic, clean = counts.agg(F.sum("t"), F.sum("c")).first()
    if not toxic or not clean:
        return [], (0.0, 0.0)
    prior = PRIOR * (F.col("t") + F.col("c")) / (toxic + clean)
    ratio = F.log((F.col("t") + prior) / (toxic + PRIOR)) - F.log((F.col("c") + prior) / (clean + PRIOR))
    both, rate = F.col("t") + F.col("c"), toxic / (toxic + clean)
    surplus = 2 * (F.col("t") * F.log(F.col("t") / (both * rate)) + F.when(F.col("c") > 0, F.col("c") * F.log(F.col("c") / (both * (1 - rate)))).otherwise(0.0))
    best = counts.where(F.col("t") > both * rate).withColumn("score", ratio).where((F.sqrt(surplus) >= SIGNIFICANT) & (F.col("score") > 0))
    return best.orderBy("token").collect(), (toxic, clean)


def lexicon(found: list, masses: tuple[float, float], least: float) -> Model:
    """A model without a curve: the units of at least this log-odds, and the score of words without one."""
    toxic, clean = masses
    kept = [r for r in found if r["score"] >= least]
    # a word counts in the mass by its longest unit, so only whole words do
    words = [r for r in kept if r["token"].endswith("$")]
    mass_t, mass_c = (min(sum((r[k] + PRIOR * (r["t"] + r["c"]) / (toxic + clean)) / (side + PRIOR) for r in words), 0.999) for k, side in (("t", toxic), ("c", clean)))
    return Model(tuple((r["token"], r["score"]) for r in kept), min(math.log((1 - mass_t) / (1 - mass_c)), -1e-6), 0.0, 0.0)


def weighed(rows: DataFrame, models: list[Model]):
    """The sample's labels, parts and evidence x0, x1, ... under each model, in a fixed order (the bounded sample)."""

    def one(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = batch.column(0).to_pylist()
        xs = [pa.array([evidence(text, m)[0] for text in found], pa.float64()) for m in models]
        return pa.RecordBatch.from_arrays([batch.column(1), batch.column(2), *xs], names=["y", "apart", *(f"x{k}" for k in range(len(models)))])

    schema = "y int, apart boolean, " + ", ".join(f"x{k} double" for k in range(len(models)))
    pairs = map_rows(rows.select("text", "y", "apart"), schema, one).toPandas()
    return pairs.sort_values([*(f"x{k}" for k in range(len(models))), "y"], kind="stable").reset_index(drop=True)


def log_loss(known, apart, x: str) -> float:
    """Of the rows set apart, under the curve fitted on the others."""
    if not len(apart) or known["y"].nunique() < 2:
        return 0.0
    slope, level = logistic(known[x].to_numpy(), known["y"].to_numpy())
    z = np.clip((slope * apart[x] + level) * (2 * apart["y"] - 1), -700, 700)
    return float(np.logaddexp(0, -z).mean())


def score_texts(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col, held_out, score, predicted, passages`` of every row; passages are token ranges with their scores."""
    kind = dict(docs.dtypes)[id_col]

    def one(batch: pa.RecordBatch) -> pa.RecordBatch:
        scores, passages = [], []
        for text in batch.column(1).to_pylist():
            x, found = evidence(text or "", model)
            scores.append(1 / (1 + math.exp(-max(-700.0, min(700.0, model.slope * x + model.level)))))
            passages.append([{"first": a, "end": b, "score": s} for a, b, s in found])
        kinds = pa.list_(pa.struct([("first", pa.int64()), ("end", pa.int64()), ("score", pa.float64())]))
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores, pa.float64()), pa.array(passages, kinds)], names=["id", "score", "passages"])

    out = map_rows(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")), f"id {kind}, score double, passages array<struct<first: long, end: long, score: double>>", one)
    return out.select(F.col("id").alias(id_col), F.coalesce(held_out("id"), F.lit(False)).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"), "passages")


def toxicity(docs: DataFrame, labels: DataFrame, **columns: str) -> DataFrame:
    return score_texts(docs, fit(docs, labels, **columns), **{k: v for k, v in columns.items() if k != "label_col"})
