"""Toxic passages: maximum-scoring segments over token log-odds, with extreme-value significance."""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import astuple, dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import code_points, pieces, slices, table, word_hashes, words_of

BUCKETS = 1 << 20  # tokens are counted by hash, so the model has a fixed size
TRAIN_ROWS = 50_000  # labelled rows that the weights are fitted on at most, chosen by hash of doc_id
PRIOR = 0.05  # weight of the Dirichlet prior against the labelled tokens; its mean is the whole corpus
FLOOR = 0.5  # pseudo-count that every token has besides, shared by class size
Z = 2.0  # standard errors that a log-odds must exceed; only the excess counts
DRIFT = 0.25  # what every token costs, so that a segment ends where toxic tokens end
E_VALUE = 0.01  # expected clean passages of that score in a text of that length
STRONG = 8.0  # decimal orders of a p-value from which a text counts as equally sure
HELD_OUT = 2  # crc32(doc_id) mod 4 of the rows that nothing is learned from
CALIBRATE = 3  # and of those that only calibrate

TOKEN_END = np.ones(256, bool)
TOKEN_END[0x80:] = False
for _c in b"0123456789abcdefghijklmnopqrstuvwxyz":
    TOKEN_END[_c] = False

RESULT = "score double, p_value double, passages array<struct<start:int,end:int,score:double,e_value:double>>"


@dataclass
class Model:
    weights: np.ndarray
    decay: float = 1.0  # lambda of the extreme-value law
    scale: float = 1.0  # its K
    intercept: float = -3.0
    slope: float = 1.0


def fold(doc_id: Column) -> Column:
    return F.crc32(doc_id.cast("string").cast("binary")) % 4


def tokens(column: pa.Array):
    w = words_of(column, TOKEN_END)
    return w, (word_hashes(w) % np.uint64(BUCKETS)).astype(np.int64)


def segments(score: np.ndarray) -> list[tuple[int, int, float]]:
    """All maximal scoring segments (begin, end, score) in linear time, after Ruzzo and Tompa (1999).

    Only runs of positive scores can begin or end a segment, so the scan steps over those.
    """
    up = score > 0
    if not up.any():
        return []
    edge = np.flatnonzero(np.diff(np.concatenate(([False], up, [False])).astype(np.int8)))
    total = np.concatenate(([0.0], np.cumsum(score)))
    found: list[tuple[float, float, int, int, int]] = []  # left sum, right sum, begin, end, last one with a smaller left sum
    for a, b in zip(edge[::2].tolist(), edge[1::2].tolist()):
        left, right = total[a], total[b]
        while True:
            j = len(found) - 1
            while j >= 0 and found[j][0] >= left:
                j = found[j][4]
            if j < 0 or found[j][1] >= right:
                found.append((left, right, a, b, j))
                break
            left, a = found[j][0], found[j][2]
            del found[j:]
    return [(a, b, float(right - left)) for left, right, a, b, _ in found]


def log_odds(background: np.ndarray, toxic: np.ndarray, clean: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Weight of each bucket, and its probability in clean text.

    Log-odds with an informative Dirichlet prior (Monroe et al. 2008): the corpus's own frequencies plus a
    floor, shared by class size so that a token the labels do not know has odds of one. What exceeds Z
    standard errors counts.
    """
    n1, n0 = float(toxic.sum()), float(clean.sum())
    n = max(1.0, n1 + n0)
    share = background / max(1.0, background.sum())
    prior = PRIOR * n * share + FLOOR
    a1, a0 = toxic + prior * n1 / n, clean + prior * n0 / n
    if not n1 or not n0:
        return np.zeros(len(background)), share
    p1, p0 = a1 / a1.sum(), a0 / a0.sum()
    odds = np.log(p1) - np.log(p0)
    error = np.sqrt(1 / a1 + 1 / a0)
    return np.sign(odds) * np.maximum(0.0, np.abs(odds) - Z * error), p0


def decay_of(weights: np.ndarray, p0: np.ndarray) -> float:
    """Positive root of sum p0 exp(x * weight) = 1; the chance of a clean segment falls as exp(-x * score)."""
    value, at = np.unique(np.round(weights, 6), return_inverse=True)
    p = np.bincount(at.ravel(), weights=p0)
    if not (value > 0).any() or p.sum() <= 0 or (p * value).sum() >= 0:
        return 1.0
    low, high = 0.0, 1.0
    with np.errstate(over="ignore"):
        while (p * np.exp(high * value)).sum() < p.sum() and high < 64:
            high *= 2
        for _ in range(60):
            mid = (low + high) / 2
            low, high = (mid, high) if (p * np.exp(mid * value)).sum() < p.sum() else (low, mid)
    return max(low, 1e-3)


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0) -> tuple[float, float]:
    """Intercept and slope (not below zero) by Newton steps."""
    b = np.array([math.log((y.sum() + 0.5) / (len(y) - y.sum() + 0.5)), 0.0])
    design = np.stack([np.ones(len(x)), x], 1)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(design @ b, -30, 30)))
        slope = design.T @ (y - p) - np.array([0.0, ridge * b[1]])
        curve = (design * (p * (1 - p))[:, None]).T @ design + np.diag([1e-6, ridge])
        step = np.linalg.solve(curve, slope)
        b += np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-8:
            break
    return float(b[0]), max(0.0, float(b[1]))


def evidence(model: Model, n: int, best: float) -> float:
    """P of a clean text of n tokens having a segment of that score."""
    return -math.expm1(-model.scale * max(1, n) * math.exp(-min(700.0, model.decay * best)))


def strength(p: float) -> float:
    return min(STRONG, -math.log10(max(p, 1e-30)))


def _count(known: dict[int, int]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((3, BUCKETS), np.int64)
        for batch in slices(batches, "text"):
            w, bucket = tokens(batch.column("text"))
            if not len(bucket):
                continue
            once = np.unique(w.row * BUCKETS + bucket)  # a text counts a token once
            row, bucket = once // BUCKETS, once % BUCKETS
            label = np.array([known.get(d, -1) for d in batch.column("doc_id").to_pylist()])[row]
            total[0] += np.bincount(bucket, minlength=BUCKETS)
            for k in (0, 1):
                if (label == k).any():
                    total[1 + k] += np.bincount(bucket[label == k], minlength=BUCKETS)
        at = np.flatnonzero(total[0])
        for part in np.array_split(at, max(1, len(at) // 50_000)):
            yield pa.record_batch([pa.array(x) for x in (part, *(t[part] for t in total))], names=["bucket", "background", "clean", "toxic"])

    return run


def labelled(docs: DataFrame, labels: DataFrame, most: int = TRAIN_ROWS) -> DataFrame:
    """(doc_id, toxic, fold): at most `most` labelled rows outside the held-out fold, one of each text."""
    known = labels.where("toxic is not null and doc_id is not null").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    known = known.withColumn("fold", fold(F.col("doc_id"))).where(F.col("fold") != HELD_OUT)
    chosen = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(most).withColumnRenamed("doc_id", "known_id")
    seen = docs.select("doc_id", F.xxhash64(F.coalesce("text", F.lit(""))).alias("of")).join(chosen, F.col("doc_id") == F.col("known_id"))
    return seen.groupBy("of").agg(F.min(F.struct("doc_id", "toxic", "fold")).alias("x")).select("x.*")


def fit(docs: DataFrame, labels: DataFrame, most: int = TRAIN_ROWS) -> Model:
    """Model from all texts' token counts and a bounded number of labelled rows.

    `docs` (doc_id, text), `labels` (doc_id, toxic). Folds 0 and 1 of the chosen rows give the weights; fold
    3 gives the extreme-value scale (clean rows) and the calibration, so neither sees its own texts.
    """
    spark = docs.sparkSession
    docs = docs.select("doc_id", "text")
    rows = [(r["doc_id"], int(r["toxic"] > 0), r["fold"]) for r in labelled(docs, labels, most).collect()]  # at most `most`
    learn = {d: y for d, y, f in rows if f != CALIBRATE}
    held = {d: y for d, y, f in rows if f == CALIBRATE}
    counts = docs.mapInArrow(_count(learn), "bucket long, background long, clean long, toxic long")
    summed = counts.groupBy("bucket").agg(*[F.sum(c).alias(c) for c in ("background", "clean", "toxic")]).toArrow()  # BUCKETS rows at most
    total = np.zeros((3, BUCKETS))
    for i, c in enumerate(("background", "clean", "toxic")):
        total[i, summed.column("bucket").to_numpy()] = summed.column(c).to_numpy()
    odds, p0 = log_odds(total[0], total[2], total[1])
    model = Model((odds - DRIFT).astype(np.float32))
    model.decay = decay_of(model.weights.astype(float), p0)
    if not held:
        return model
    sent = spark.sparkContext.broadcast((model.weights, held))

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights, known = sent.value
        for batch in slices(batches, "text"):
            batch = batch.filter(pa.array([d in known for d in batch.column("doc_id").to_pylist()], pa.bool_()))
            if batch.num_rows:
                found = [(n, max((s for _, _, s in parts), default=0.0)) for n, parts, _ in _scan(batch.column("text"), weights)]
                yield pa.record_batch([batch.column("doc_id"), pa.array([n for n, _ in found], pa.int64()), pa.array([s for _, s in found], pa.float64())], names=["doc_id", "n", "best"])

    seen = docs.mapInArrow(measure, "doc_id long, n long, best double").groupBy("doc_id").agg(F.max(F.struct("best", "n")).alias("x")).collect()
    y = np.array([held[r["doc_id"]] for r in seen], float)
    n = np.array([max(1, r["x"]["n"]) for r in seen], float)
    best = np.array([r["x"]["best"] for r in seen], float)
    if (y == 0).any():
        model.scale = float((y == 0).sum() / (n * np.exp(-model.decay * best))[y == 0].sum())
        if (y == 1).any():
            x = np.array([strength(evidence(model, int(a), b)) for a, b in zip(n, best)])
            order = np.lexsort((best, n, x, y))  # the same sums whatever the order of the rows
            model.intercept, model.slope = logistic(x[order], y[order])
    return model


def _scan(column: pa.Array, weights: np.ndarray) -> Iterator[tuple[int, list[tuple[int, int, float]], object]]:
    """Number of tokens and segments of each text; the segments are in tokens of the third item."""
    w, bucket = tokens(column)
    score = weights[bucket].astype(float)
    any_up = np.concatenate(([0], np.cumsum(score > 0)))
    for a, b in zip(w.first[:-1].tolist(), w.first[1:].tolist()):
        yield b - a, ([(a + x, a + y, s) for x, y, s in segments(score[a:b])] if any_up[b] > any_up[a] else []), w


def score(text: Column, model: Model, spark: SparkSession) -> Column:
    """Struct of score, p_value and all significant passages (code points, end exclusive) of a text."""
    sent = spark.sparkContext.broadcast(astuple(model))  # plain values: a broadcast does not carry code

    @F.arrow_udf(f"struct<{RESULT.replace(' ', ':', 1).replace(', p_value ', ',p_value:').replace(', passages ', ',passages:')}>")
    def of(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        m = Model(*sent.value)
        for texts in batches:
            out = []
            for piece in pieces(texts):
                at = 0
                sizes = pa.compute.binary_length(piece.fill_null("")).to_pylist()
                for (n, parts, w), size in zip(_scan(piece, m.weights), sizes):
                    best = max((s for _, _, s in parts), default=0.0)
                    p = evidence(m, n, best)
                    passages = []
                    for a, b, s in parts:
                        e = m.scale * max(1, n) * math.exp(-min(700.0, m.decay * s))
                        if e <= E_VALUE:
                            span = code_points(w.data[at : w.end[b - 1]], np.array([w.start[a], w.end[b - 1]]) - at, 0)
                            passages.append({"start": int(span[0]), "end": int(span[1]), "score": s, "e_value": e})
                    x = min(30.0, max(-30.0, m.intercept + m.slope * strength(p)))
                    out.append({"score": 1 / (1 + math.exp(-x)), "p_value": p, "passages": passages})
                    at += size
            yield pa.array(out, pa.struct([("score", pa.float64()), ("p_value", pa.float64()), ("passages", pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("score", pa.float64()), ("e_value", pa.float64())])))]))

    return of(text)


def toxic_texts(docs: DataFrame, labels: DataFrame, text: str = "text", doc_id: str = "doc_id", most: int = TRAIN_ROWS) -> DataFrame:
    """One row per document: item (the whole row), held_out, toxicity (score, p_value, passages).

    Tokens are runs of ASCII letters and digits and of all other characters, A-Z lower-cased. Every text
    is scanned whole; its best segment gives the extreme-value p-value, and a logistic curve over its
    logarithm the score. A null text is an empty one: it has no passage and the lowest score. Repeated
    rows get equal results; a null doc_id is in no fold, so it is not held out. Without labels of both
    kinds all weights are equal, nothing is significant and all texts of one length score the same.
    """
    model = fit(docs.select(docs[doc_id].alias("doc_id"), docs[text].alias("text")), labels, most)
    item = F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias("item")
    held = F.coalesce(fold(docs[doc_id]) == HELD_OUT, F.lit(False)).alias("held_out")
    return docs.select(item, held, score(docs[text], model, docs.sparkSession).alias("toxicity"))


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = toxic_texts(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "labels"))
    s = F.col("toxicity.score")
    return found.select("item.doc_id", "held_out", s.alias("score"), F.when(s >= 0.3, 1).otherwise(0).alias("predicted"), F.size("toxicity.passages").alias("n_passages"))
