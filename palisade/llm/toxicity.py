"""Toxicity classifier: logistic regression on character n-grams scaled by naive Bayes log-count ratios.

Texts are lower-cased (A-Z) and cut into byte n-grams of 3 to 6 bytes, hashed
into 2**20 features that are present or absent. On a bounded sample of labelled
texts the features' log-count ratios are taken, the features that tell the
classes apart most are kept, and a logistic regression is fitted on the kept
ratios. The sample's texts stay where they are: tasks count features, ranges of
features are summed, tasks turn texts into lists of kept features once, and each
step of the fit adds up the tasks' gradients, as long as the kept features.
Scoring is one pass without a shuffle; only the kept weights (some hundred KB,
whatever the corpus) are sent to the executors.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from palisade.llm import _plan
from palisade.llm._exchange import dump, load
from palisade.llm._text import LOWER, blocks
from palisade.llm._tokens import forget

BITS = 20
ORDERS = (3, 4, 5, 6)
#: Labelled rows of each class that a fit uses at most, lowest hash of doc_id first.
MAX_POSITIVE, MAX_NEGATIVE = 3_000, 6_000
#: Features kept, and the labelled texts that one has to occur in.
MAX_FEATURES, MIN_TEXTS = 20_000, 4
#: How many standard errors the classes' shares of a feature have to be apart.
MIN_SIGNAL = 2.0
#: Tasks that the sample is dealt over, and ranges of features that are summed.
PARTS, RANGES = 12, 16
#: Flags (document, feature) held at once while scoring, five bytes each.
FLAGS = 1 << 22
_M = np.uint32(0x9E3779B1)


@dataclass
class Model:
    """score = sigmoid(bias + sum of weights of the features present)."""

    features: np.ndarray  # int32, ascending
    weights: np.ndarray  # float32
    bias: float

    def places(self) -> np.ndarray:
        """Place of each feature among the kept ones, -1 for none."""
        out = np.full(1 << BITS, -1, np.int32)
        out[self.features] = np.arange(len(self.features))
        return out


def _grams(data: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """(order, feature of the n-gram starting at each byte)."""
    code = (LOWER[data].astype(np.uint32) + np.uint32(1)) * np.uint32(0x85EBCA6B)
    acc = code
    for n in range(2, max(ORDERS) + 1):
        if len(code) < n:
            return
        acc = acc[:-1] * _M + code[n - 1 :]
        if n in ORDERS:
            h = acc ^ (acc >> np.uint32(15)) ^ np.uint32(n * 0x27D4EB2F)
            yield n, ((h * np.uint32(0x2C1B3C6D)) >> np.uint32(32 - BITS)).astype(np.int32)


class Present:
    """The distinct features of single texts."""

    def __init__(self):
        self.seen = np.zeros(1 << BITS, bool)

    def of(self, data: np.ndarray) -> np.ndarray:
        for _, feature in _grams(data):
            self.seen[feature] = True
        out = np.flatnonzero(self.seen)
        self.seen[out] = False
        return out


def block_scores(data: np.ndarray, off: np.ndarray, place: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Sum of the weights of the features in each document of a block; place: of each feature among the weights, -1 for none."""
    n, out = len(off) - 1, np.zeros(len(off) - 1, np.float64)
    if not len(weights):
        return out
    step = max(1, FLAGS // len(weights))
    for at in range(0, n, step):
        cut = off[at : at + step + 1] - off[at]
        flags = np.zeros((len(cut) - 1, len(weights)), bool)
        for size, feature in _grams(data[off[at] : off[at] + cut[-1]]):
            col = place[feature]
            where = np.flatnonzero(col >= 0)
            doc = np.searchsorted(cut, where, "right") - 1
            inside = where + size <= cut[doc + 1]
            flags[doc[inside], col[where[inside]]] = True
        out[at : at + len(cut) - 1] = flags @ weights
    return out


def signal_of(pos: np.ndarray, neg: np.ndarray, n_pos: int, n_neg: int) -> tuple[np.ndarray, np.ndarray]:
    """(log-count ratio, how far apart the classes' shares are in standard errors) of features, from the texts of each class that have them."""
    p, q = (pos + 1) / (n_pos + 2), (neg + 1) / (n_neg + 2)
    share = (pos + neg + 1) / (n_pos + n_neg + 2)
    signal = np.abs(p - q) / np.sqrt(share * (1 - share) * (1 / n_pos + 1 / n_neg) + 1e-12)
    return np.log(p / q), np.where(pos + neg < MIN_TEXTS, 0, signal)


def minimise(loss: Callable[[np.ndarray], tuple[float, np.ndarray]], x: np.ndarray, steps: int = 60, memory: int = 10, tolerance: float = 1e-5) -> np.ndarray:
    """Minimum of a smooth convex function (value and gradient) by limited-memory quasi-Newton steps."""
    value, grad = loss(x)
    scale, kept = 1.0 / max(1.0, float(np.linalg.norm(grad))), []
    for _ in range(steps):
        step, alphas = -grad, []
        for s, y, r in reversed(kept):
            alphas.append(r * (s @ step))
            step = step - alphas[-1] * y
        if kept:
            s, y, _ = kept[-1]
            step = step * ((s @ y) / (y @ y))
        else:
            step = step * scale
        for (s, y, r), alpha in zip(kept, reversed(alphas), strict=True):
            step = step + s * (alpha - r * (y @ step))
        slope, size = grad @ step, 1.0
        while True:
            new_value, new_grad = loss(x + size * step)
            if new_value <= value + 1e-4 * size * slope or size < 1e-6:
                break
            size /= 4
        s, y = size * step, new_grad - grad
        if s @ y > 1e-12:
            kept = [*kept[1 - memory :], (s, y, 1 / (s @ y))]
        done = value - new_value <= tolerance * 1e-3 * max(1.0, abs(value)) and np.abs(new_grad).max() <= tolerance * max(1.0, abs(value)) or size < 1e-6
        x, value, grad = x + s, new_value, new_grad
        if done:
            break
    return x


def _loss(matrix: DataFrame, width: int, l2: float = 1.0) -> Callable[[np.ndarray], tuple[float, np.ndarray]]:
    """The L2-regularised logistic loss over a stored table of parts of the sample, of weights followed by a bias."""

    def loss(x: np.ndarray) -> tuple[float, np.ndarray]:
        w, b = x[:-1], x[-1]

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for raw in batch.column("part").to_pylist():
                    m = load(raw)
                    doc, col, y = np.repeat(np.arange(len(m["sizes"])), m["sizes"]), m["cols"], m["toxic"].astype(float)
                    z = np.bincount(doc, w[col], len(y)) + b
                    miss = 1 / (1 + np.exp(-np.clip(z, -35, 35))) - y
                    out = np.append(np.bincount(col, miss[doc], width), [miss.sum(), (np.logaddexp(0, z) - y * z).sum()])
                    yield pa.RecordBatch.from_pydict({"sums": pa.array([out.tobytes()], pa.binary())})

        total = sum(np.frombuffer(r.sums) for r in matrix.mapInArrow(run, "sums binary").collect())  # PARTS rows
        return float(total[-1] + 0.5 * l2 * (w @ w)), total[:-1] + l2 * np.append(w, 0)

    return loss


def fit(texts: DataFrame, prior: float, max_features: int = MAX_FEATURES, min_signal: float = MIN_SIGNAL) -> Model:
    """Fits on text, toxic (boolean) of a stored table; prior: the share of ones that scores are to reflect."""
    sizes = {r.toxic: r.n for r in texts.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    n_pos, n_neg = sizes.get(True, 0), sizes.get(False, 0)
    nothing = np.zeros(0, np.int32), np.zeros(0, np.float32)
    if not n_pos or not n_neg:
        return Model(*nothing, 20.0 if n_pos else -20.0)
    prior = min(max(prior, 1e-4), 1 - 1e-4)
    width = (1 << BITS) // RANGES

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        counts, present = np.zeros((2, 1 << BITS), np.uint32), Present()
        for batch in batches:
            toxic = batch.column("toxic").to_pylist()
            for rows, data, off in blocks(batch):
                for i, y in enumerate(toxic[rows]):
                    counts[int(y), present.of(data[off[i] : off[i + 1]])] += 1
        parts = [dump(counts=counts[:, k * width : (k + 1) * width]) for k in range(RANGES)]
        yield pa.RecordBatch.from_pydict({"range": pa.array(range(RANGES), pa.int32()), "part": pa.array(parts, pa.binary())})

    def choose(key: tuple, table: pa.Table) -> pa.Table:
        neg, pos = sum(load(p)["counts"].astype(float) for p in table.column("part").to_pylist())
        ratio, signal = signal_of(pos, neg, n_pos, n_neg)
        at = np.flatnonzero(signal > min_signal)
        return pa.table({"feature": pa.array(at + key[0].as_py() * width, pa.int32()), "ratio": ratio[at], "signal": signal[at]})

    counted = texts.select("text", "toxic").mapInArrow(count, "range int, part binary")
    chosen = counted.groupBy("range").applyInArrow(choose, "feature int, ratio double, signal double")
    best = sorted((r.feature, r.ratio) for r in chosen.orderBy(F.desc("signal"), "feature").limit(max_features).collect())
    if not best:
        return Model(*nothing, float(np.log(prior / (1 - prior))))
    kept, ratio = np.array([f for f, _ in best], np.int32), np.array([r for _, r in best])

    def rows_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place, present, n, cols, toxic = np.full(1 << BITS, -1, np.int32), Present(), [], [], []
        place[kept] = np.arange(len(kept))
        for batch in batches:
            toxic += batch.column("toxic").to_pylist()
            for _, data, off in blocks(batch):
                for a, b in zip(off[:-1].tolist(), off[1:].tolist(), strict=True):
                    col = place[present.of(data[a:b])]
                    cols.append(col[col >= 0])
                    n.append(len(cols[-1]))
        if toxic:
            yield pa.RecordBatch.from_pydict({"part": pa.array([dump(sizes=np.array(n), cols=np.concatenate(cols), toxic=np.array(toxic, bool))], pa.binary())})

    matrix = _plan.stored(texts.select("text", "toxic").mapInArrow(rows_of, "part binary"), "toxicity-matrix")
    of_ratios = _loss(matrix, len(kept))

    def loss(x: np.ndarray) -> tuple[float, np.ndarray]:
        """In weights of the ratios, which are what is regularised."""
        value, grad = of_ratios(np.append(x[:-1] * ratio, x[-1]))
        plain = x[:-1] * ratio
        value += 0.5 * (x[:-1] @ x[:-1] - plain @ plain)
        return value, np.append((grad[:-1] - plain) * ratio + x[:-1], grad[-1])

    x = minimise(loss, np.append(np.zeros(len(kept)), np.log(n_pos / n_neg)))
    return Model(kept, (x[:-1] * ratio).astype(np.float32), float(x[-1] + np.log(prior / (1 - prior)) - np.log(n_pos / n_neg)))


def train(docs: DataFrame, labels: DataFrame, max_positive: int = MAX_POSITIVE, max_negative: int = MAX_NEGATIVE) -> Model:
    """Fits on doc_id, text of docs with doc_id, toxic (0/1) of labels; the caller leaves out what may not be learned from.

    At most max_positive and max_negative labelled documents are used. Null labels and ids are ignored, a document with
    several labels counts as toxic if one says so, of several rows with one doc_id the least text is taken (null reads
    as empty). The prior is that of all labels given. Without both classes every score is 0 (or 1, if all labels are 1);
    so it is without any document.
    """
    known = labels.where("doc_id is not null and toxic is not null").groupBy("doc_id").agg((F.max("toxic") > 0).alias("toxic"))
    share = known.agg(F.avg(F.col("toxic").cast("double"))).first()[0]
    order = (F.xxhash64("doc_id"), F.col("doc_id"))
    sample = known.where("toxic").orderBy(*order).limit(max_positive).union(known.where("not toxic").orderBy(*order).limit(max_negative))
    # the sample has max_positive + max_negative short rows at most
    texts = docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id").groupBy("doc_id", "toxic").agg(F.min(F.coalesce("text", F.lit(""))).alias("text"))
    return fit(_plan.stored(texts.repartition(PARTS, "doc_id"), "toxicity-sample"), share or 0.0)


def score(docs: DataFrame, model: Model, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """`keep` columns of docs and score (0 to 1) of each whole text; null and empty texts get the score of no feature."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*keep).schema] + ["score double"])
    columns = [*keep] + ["text"] * ("text" not in keep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        m = shared.value
        place = m.places()
        for batch in batches:
            for rows, data, off in blocks(batch):
                some = batch.slice(rows.start, rows.stop - rows.start)
                z = block_scores(data, off, place, m.weights) + m.bias
                yield pa.RecordBatch.from_arrays([*(some.column(k) for k in keep), pa.array(1 / (1 + np.exp(-np.clip(z, -35, 35))))], names=[*keep, "score"])

    return docs.select(*columns).mapInArrow(run, schema)
