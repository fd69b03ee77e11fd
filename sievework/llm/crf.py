"""Document quality from a linear-chain conditional random field over lines.

Each line is described by its own format and by its two neighbours'; the chain labels
every line good or bad. Labels are given per document, so a document's label stands for
all its lines in the fit; forward-backward marginals, weighted by line length, add up to
the document's quality, which a logistic curve fitted on the same documents turns into a
probability. Only text enters the score, never labels, language, source or ids.

The fit takes at most `sample` labelled documents that are not held out, in order of a
hash of their id, as long as they have `lines` lines together at most (an id with more
than a tenth of that plays no part in the fit). Lines are described on the executors; what
comes to the driver is their features, 56 bytes a line. Scoring covers every document and
every line, whatever its length.

Null text is empty: one empty line. Without labels of both kinds the score is the share
of good labels (a half without any). Of two labels of one id the lower counts; each of
repeated rows counts in the fit. Repeated rows get the same score, and a
score equal to the threshold is predicted 1. Columns other than those kept play no part,
whatever their names; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import kernels
from .common import slices, store

#: Labelled documents in a fit at most.
SAMPLE = 4000
#: Lines of a fit's documents in all at most.
LINES = 200_000
#: Gradient steps, step size and weight decay of the fit.
STEPS, RATE, DECAY = 150, 0.15, 1e-3


def _class(characters: bytes) -> np.ndarray:
    out = np.zeros(256, bool)
    out[list(characters)] = True
    return out


_LOWER, _UPPER, _DIGIT = (_class(bytes(range(a, b + 1))) for a, b in ((97, 122), (65, 90), (48, 57)))
_SYMBOL, _SHOUT = _class(b"#*$%&|<>^~={}[]\\@_"), _class(b"!?")
_OTHER = _class(b".,;:'\"()-/+`")
_HIGH = np.arange(256) >= 128
OWN = 14


def line_features(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(features, lengths, first): of every line, and where each text's lines begin."""
    data, offsets = kernels.flat(column)
    breaks = np.flatnonzero(data == 10)
    starts = np.sort(np.concatenate([offsets[:-1], breaks + 1]))
    ends = np.sort(np.concatenate([breaks, offsets[1:]]))
    of = np.searchsorted(offsets, breaks, side="right") - 1
    first = np.append(0, np.cumsum(1 + np.bincount(of, minlength=len(offsets) - 1)))

    def count(table: np.ndarray) -> np.ndarray:
        sums = np.append(0, np.cumsum(table[data]))
        return sums[ends] - sums[starts]

    n = ends - starts
    size = np.maximum(n, 1)
    lower, upper, high = count(_LOWER), count(_UPPER), count(_HIGH)
    letters = lower + upper + high
    w_starts, w_ends, w_first = kernels.words(data, offsets)
    hashes = kernels.range_hashes(data, w_starts, w_ends)
    again = np.zeros(len(hashes) + 1, np.int64)
    if len(hashes):
        again[2:] = np.cumsum(hashes[1:] == hashes[:-1])
    lo, hi = np.searchsorted(w_starts, starts), np.searchsorted(w_starts, ends)
    words = hi - lo
    head = np.where(n > 0, data[np.minimum(starts, max(len(data) - 1, 0))] if len(data) else 0, 0)
    tail = np.where(n > 0, data[np.maximum(ends - 1, 0)] if len(data) else 0, 0)
    x = np.stack(
        [
            np.log1p(n) / 4,
            letters / size,
            2 * upper / np.maximum(letters, 1),
            4 * count(_DIGIT) / size,
            4 * count(_SYMBOL) / size,
            4 * count(_SHOUT) / size,
            4 * count(_OTHER) / size,
            np.log1p(words) / 3,
            letters / np.maximum(words, 1) / 8,
            2 * np.maximum(again[hi] - again[lo], 0) / np.maximum(words, 1),
            high / size,
            (tail == 46).astype(float),
            _LOWER[head].astype(float),
            (n == 0).astype(float),
        ],
        axis=1,
    ).astype(np.float64)
    return x, n, first


def with_neighbours(x: np.ndarray, first: np.ndarray) -> np.ndarray:
    """A bias, a line's own features and those of the lines before and after (zeros at the ends)."""
    before, after = np.zeros_like(x), np.zeros_like(x)
    before[1:], after[:-1] = x[:-1], x[1:]
    before[first[:-1]] = 0
    after[first[1:] - 1] = 0
    return np.concatenate([np.ones((len(x), 1)), x, before, after], axis=1)


class Chain:
    """Two-state chain: state 1 is good. Weights of features for state 1, and transition scores."""

    def __init__(self, weights: np.ndarray, turns: np.ndarray, scale: tuple[float, float], prior: float):
        self.weights, self.turns, self.scale, self.prior = weights, turns, scale, prior

    @staticmethod
    def passes(score: np.ndarray, turns: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(marginals, pair marginals summed, log-partitions) of all texts, a step of all chains at a time."""
        n = np.diff(first)
        order = np.argsort(-n, kind="stable")
        begin, n = first[:-1][order], n[order]
        emit = np.zeros((len(score), 2))
        emit[:, 1] = score
        alpha, beta = np.empty_like(emit), np.zeros_like(emit)
        live = np.searchsorted(-n, -np.arange(1, (n[0] if len(n) else 0) + 1), side="right")
        alpha[begin] = emit[begin]
        for t in range(1, len(live)):
            at = begin[: live[t]] + t
            a = alpha[at - 1][:, :, None] + turns
            alpha[at] = emit[at] + np.logaddexp(a[:, 0], a[:, 1])
        pairs = np.zeros((2, 2))
        z = np.empty(len(n))
        last = begin + n - 1
        z[:] = np.logaddexp(alpha[last, 0], alpha[last, 1])
        for t in range(len(live) - 1, 0, -1):
            at = begin[: live[t]] + t
            ahead = turns + (emit[at] + beta[at])[:, None, :]
            beta[at - 1] = np.logaddexp(ahead[:, :, 0], ahead[:, :, 1])
            pairs += np.exp(alpha[at - 1][:, :, None] + ahead - z[: live[t], None, None]).sum(axis=0)
        whole = np.empty(len(score))
        of = np.repeat(np.arange(len(n)), np.diff(first))
        back = np.empty(len(n))
        back[order] = z
        whole = np.exp(alpha[:, 1] + beta[:, 1] - back[of])
        return whole, pairs, back

    def quality(self, column: pa.Array) -> np.ndarray:
        """Length-weighted share of good lines of each text."""
        return self.quality_of_lines(*line_features(column))

    def quality_of_lines(self, x: np.ndarray, lengths: np.ndarray, first: np.ndarray) -> np.ndarray:
        good, _, _ = self.passes(with_neighbours(x, first) @ self.weights, self.turns, first)
        weight = lengths + 1.0
        return kernels.totals(good * weight, first) / kernels.totals(weight, first)

    def score(self, column: pa.Array) -> np.ndarray:
        if not len(column):
            return np.zeros(0)
        if self.weights is None:
            return np.full(len(column), self.prior)
        return self.probability(self.quality(column))

    def probability(self, quality: np.ndarray) -> np.ndarray:
        a, b = self.scale
        return np.clip(1 / (1 + np.exp(-(a * _logit(quality) + b))), 0.0, 1.0)


def _logit(p: np.ndarray) -> np.ndarray:
    p = np.clip(p, 1e-4, 1 - 1e-4)
    return np.log(p / (1 - p))


def fit_chain(texts: pa.Array, good: np.ndarray, steps: int = STEPS) -> Chain:
    """fit_lines over the lines of texts."""
    return fit_lines(*line_features(texts), good, steps)


def fit_lines(x: np.ndarray, lengths: np.ndarray, first: np.ndarray, good: np.ndarray, steps: int = STEPS) -> Chain:
    """Maximum conditional likelihood with Adam; good holds 0 or 1 for each text, whose lines begin at first."""
    prior = float(good.mean()) if len(good) else 0.5
    if len(np.unique(good)) < 2:
        return Chain(None, None, (1.0, 0.0), prior)
    full = with_neighbours(x, first)
    n = np.diff(first)
    y = np.repeat(good.astype(float), n)
    # a document counts once, however many lines it has; both labels weigh the same
    per = 1.0 / n / np.where(good == 1, 2 * (good == 1).sum(), 2 * (good == 0).sum())
    each = np.repeat(per, n)
    w, turns = np.zeros(full.shape[1]), np.zeros((2, 2))
    m1, m2, t1, t2 = np.zeros_like(w), np.zeros_like(w), np.zeros((2, 2)), np.zeros((2, 2))
    stay = np.zeros((2, 2))
    np.add.at(stay, (good.astype(int), good.astype(int)), (n - 1) * per)
    total = float(((n - 1) * per).sum())
    for k in range(1, steps + 1):
        p, pairs, _ = Chain.passes(full @ w, turns, first)
        grad = full.T @ ((p - y) * each) + DECAY * w
        # expected pairs come unweighted: brought to the weight of the observed ones
        turn = pairs / max(pairs.sum(), 1e-9) * total - stay + DECAY * turns
        m1, m2 = 0.9 * m1 + 0.1 * grad, 0.999 * m2 + 0.001 * grad**2
        t1, t2 = 0.9 * t1 + 0.1 * turn, 0.999 * t2 + 0.001 * turn**2
        c1, c2 = 1 - 0.9**k, 1 - 0.999**k
        w = w - RATE * (m1 / c1) / (np.sqrt(m2 / c2) + 1e-8)
        turns = np.clip(turns - RATE / 3 * (t1 / c1) / (np.sqrt(t2 / c2) + 1e-8), -1.5, 1.5)
    chain = Chain(w, turns, (1.0, 0.0), prior)
    q, a, b = _logit(chain.quality_of_lines(x, lengths, first)), 1.0, 0.0
    for _ in range(40):  # logistic curve by Newton steps, lightly held back
        p = 1 / (1 + np.exp(-(a * q + b)))
        v = p * (1 - p) + 1e-6
        g = np.array([((p - good) * q).sum() + 0.1 * (a - 1), (p - good).sum() + 0.1 * b])
        h = np.array([[(v * q * q).sum() + 0.1, (v * q).sum()], [(v * q).sum(), v.sum() + 0.1]])
        step = np.linalg.solve(h, g)
        a, b = max(0.05, a - step[0]), b - step[1]
    chain.scale = float(a), float(b)
    return chain


def held_out() -> F.Column:
    """Rows that never take part in a fit: crc32 of the id as text is divisible by five."""
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) % 5 == 0


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, lines: int = LINES) -> Chain:
    """The chain of docs (doc_id, text) with labels (doc_id, quality), on a bounded sample of rows not held out."""
    known = labels.where(F.col("doc_id").isNotNull() & F.col("quality").isin(0, 1) & ~held_out()).groupBy("doc_id").agg(F.min("quality").alias("quality"))
    chosen = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    text = F.coalesce("text", F.lit(""))
    own = F.sum(F.length(text) - F.length(F.replace(text, F.lit("\n"))) + 1).alias("own")
    counts = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").groupBy("doc_id", "quality").agg(own)  # `sample` rows at most
    upto = F.sum("own").over(Window.orderBy(F.xxhash64("doc_id"), "doc_id").rowsBetween(Window.unboundedPreceding, 0))
    few = store(counts.where(F.col("own") <= lines // 10).withColumn("upto", upto).where(F.col("upto") <= lines), "sample")
    rows = docs.select("doc_id", "text").join(F.broadcast(few.select("doc_id", F.col("quality").cast("int").alias("quality"))), "doc_id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            x, length, first = line_features(batch.column(1))
            parts = [[v[a:b].tobytes() for a, b in zip(first[:-1], first[1:], strict=True)] for v in (x.astype("<f4"), length.astype("<i8"))]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(np.diff(first)), *[pa.array(v, pa.binary()) for v in parts]], names=["doc_id", "quality", "n", "x", "length"])

    got = rows.select("doc_id", "text", "quality").mapInArrow(run, "doc_id long, quality int, n long, x binary, length binary").toArrow()
    got = got.sort_by([(c, "ascending") for c in ("doc_id", "n", "x")])  # the fit adds up in this order wherever rows come from
    first = np.append(0, np.cumsum(got.column("n").to_numpy())).astype(np.int64)
    x = np.frombuffer(b"".join(got.column("x").to_pylist()), "<f4").reshape(-1, OWN).astype(np.float64)
    length = np.frombuffer(b"".join(got.column("length").to_pylist()), "<i8")
    return fit_lines(x, length, first, got.column("quality").to_numpy().astype(np.int64))


def score(docs: DataFrame, chain: Chain, threshold: float = 0.3, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """keep columns of docs, with score and predicted."""
    source = docs.select("text", *keep)
    shared = docs.sparkSession.sparkContext.broadcast(chain)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            s = shared.value.score(batch.column(0))
            yield pa.RecordBatch.from_arrays([*batch.columns[1:], pa.array(s), pa.array((s >= threshold).astype(np.int32))], names=[*keep, "score", "predicted"])

    schema = ", ".join([*[f"`{f.name}` {f.dataType.simpleString()}" for f in source.select(*keep).schema], "score double, predicted int"])
    return source.mapInArrow(run, schema)
