"""Quality classifier by positive-unlabelled learning with the non-negative risk estimator."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mosaica.llm.common import slices, table, text_or_empty

SAMPLE = 8_000  # rows of each kind, trusted positives and unlabelled, that the classifier is fitted on
HIDDEN = 32
EPOCHS, ROUGH_EPOCHS = 60, 30
FOLDS = 3
RATE = 3e-3
THRESHOLD = 0.7
_SPACES = np.isin(np.arange(256), [9, 10, 11, 12, 13, 32])


def features(text: bytes) -> np.ndarray:
    """Rates of bytes, words and lines in the whole text; all zero for an empty one."""
    out = np.zeros(128 + 24, np.float32)
    n = len(text)
    if not n:
        return out
    counts = np.bincount(np.frombuffer(text, np.uint8), minlength=256)
    out[:128] = np.log1p(counts[:128] * (1000.0 / n))
    words, lines = text.split(), text.split(b"\n")
    n_words = max(1, len(words))
    upper, lower, digit = counts[65:91].sum(), counts[97:123].sum(), counts[48:58].sum()
    white, wide = counts[_SPACES].sum(), counts[128:].sum()
    length = np.fromiter(map(len, words), np.int64, len(words)) if words else np.zeros(1)
    most = max(Counter(lines).values())
    out[128:] = (
        np.log1p(n), np.log1p(n_words), n / n_words, upper / n, lower / n, digit / n, white / n, wide / n,
        (n - upper - lower - digit - white - wide) / n, upper / max(1, upper + lower),
        len(set(words)) / n_words, np.log1p(len(lines)), len(set(lines)) / len(lines), most / len(lines), n_words / len(lines),
        length.mean(), length.std(), (length <= 3).mean(), (length <= 1).mean(), (length >= 12).mean(), np.log1p(length.max()),
        (counts[46] + counts[33] + counts[63]) / n_words, counts[44] / n_words, counts[10] / n_words,
    )
    return out


class PositiveUnlabelled:
    """One hidden layer, sigmoid loss, fitted to the non-negative unbiased risk of positives and unlabelled rows."""

    def __init__(self, positive: np.ndarray, unlabelled: np.ndarray, prior: float, seed: int = 7, epochs: int = EPOCHS):
        self.epochs = epochs
        both = np.concatenate((positive, unlabelled))
        self.mean, self.scale = both.mean(0), both.std(0) + 1e-3
        self.prior = prior
        self._fit(self._normal(positive), self._normal(unlabelled), np.random.default_rng(seed))

    def _normal(self, x: np.ndarray) -> np.ndarray:
        return np.clip((x - self.mean) / self.scale, -6, 6).astype(np.float32)

    def _fit(self, p: np.ndarray, u: np.ndarray, rng: np.random.Generator) -> None:
        d = p.shape[1]
        self.w = [rng.normal(0, d**-0.5, (d, HIDDEN)), np.zeros(HIDDEN), rng.normal(0, HIDDEN**-0.5, HIDDEN), np.zeros(1)]
        m, v, step = [np.zeros_like(x) for x in self.w], [np.zeros_like(x) for x in self.w], 0
        for _ in range(self.epochs):
            rng.shuffle(p)
            rng.shuffle(u)
            batches = max(1, min(len(p), len(u)) // 256)
            for x, y in zip(np.array_split(p, batches), np.array_split(u, batches)):
                grad = self._gradient(x, y)
                step += 1
                for i, g in enumerate(grad):
                    g = g + 1e-4 * self.w[i]
                    m[i] = 0.9 * m[i] + 0.1 * g
                    v[i] = 0.999 * v[i] + 0.001 * g * g
                    self.w[i] = self.w[i] - RATE * (m[i] / (1 - 0.9**step)) / (np.sqrt(v[i] / (1 - 0.999**step)) + 1e-8)

    def _forward(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        h = np.maximum(0, x @ self.w[0] + self.w[1])
        return h, h @ self.w[2] + self.w[3][0]

    def _gradient(self, p: np.ndarray, u: np.ndarray) -> list[np.ndarray]:
        """Of prior * R+(P as positive) + max(0, R-(U) - prior * R-(P)); where the second term is negative, it is
        pushed back up instead."""
        (hp, zp), (hu, zu) = self._forward(p), self._forward(u)
        sp, su = 1 / (1 + np.exp(-np.clip(zp, -30, 30))), 1 / (1 + np.exp(-np.clip(zu, -30, 30)))
        negative = su.mean() - self.prior * sp.mean()
        slope_p, slope_u = sp * (1 - sp) / len(p), su * (1 - su) / len(u)
        if negative >= 0:
            dp, du = -2 * self.prior * slope_p, slope_u
        else:
            dp, du = self.prior * slope_p, -slope_u
        out = [np.zeros_like(w) for w in self.w]
        for x, h, d in ((p, hp, dp), (u, hu, du)):
            dh = (d[:, None] * self.w[2]) * (h > 0)
            out[0] += x.T @ dh
            out[1] += dh.sum(0)
            out[2] += h.T @ d
            out[3] += d.sum()
        return out

    def margin(self, x: np.ndarray) -> np.ndarray:
        return np.clip(self._forward(self._normal(x))[1], -30, 30)

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-self.margin(x)))


class CalibratedFolds:
    """Classifiers fitted on all folds but one each; their mean margin, mapped to a probability.

    Every row gets the margin of the classifier that was not fitted on it. On those the class prior is estimated, fold by fold and averaged, and
    the map from margin to probability fitted, so neither trusts what a classifier says of its own rows."""

    def __init__(self, positive: np.ndarray, unlabelled: np.ndarray, folds: int = FOLDS):
        fold_p, fold_u = np.arange(len(positive)) % folds, np.arange(len(unlabelled)) % folds

        def fitted(prior: float, epochs: int) -> list[PositiveUnlabelled]:
            return [PositiveUnlabelled(positive[fold_p != k], unlabelled[fold_u != k], prior, 7 + k, epochs) for k in range(folds)]

        rough = fitted(0.5, ROUGH_EPOCHS)
        self.prior = float(np.mean([estimate_prior(m.score(positive[fold_p == k]), m.score(unlabelled[fold_u == k])) for k, m in enumerate(rough)]))
        self.models = fitted(self.prior, EPOCHS)
        margins = [np.concatenate([m.margin(x[fold == k]) for k, m in enumerate(self.models)]) for x, fold in ((positive, fold_p), (unlabelled, fold_u))]
        self.slope, self.shift = calibrate(*margins, self.prior)

    def score(self, x: np.ndarray) -> np.ndarray:
        margin = np.mean([m.margin(x) for m in self.models], axis=0)
        return 1 / (1 + np.exp(-np.clip(self.slope * margin + self.shift, -30, 30)))


def calibrate(positive: np.ndarray, unlabelled: np.ndarray, prior: float) -> tuple[float, float]:
    """(a, b) of the probability 1 / (1 + exp(-(a m + b))) for a margin m: the least unbiased log loss, -prior E_p[a m + b] + E_u[log(1 + exp(a m + b))], which is convex. At its
    minimum the mean probability of unlabelled rows is the prior. A little weight holds the slope near one where the margins do not settle it."""
    a, b, hold = 1.0, 0.0, 1e-3
    for _ in range(100):
        s = 1 / (1 + np.exp(-np.clip(a * unlabelled + b, -30, 30)))
        w = s * (1 - s)
        gradient = np.array([(s * unlabelled).mean() - prior * positive.mean() + hold * (a - 1), s.mean() - prior])
        cross = (w * unlabelled).mean()
        step = np.linalg.solve([[(w * unlabelled**2).mean() + hold, cross], [cross, w.mean() + 1e-6]], gradient)
        step *= min(1.0, 2 / max(np.abs(step).max(), 1e-12))
        a, b = a - step[0], b - step[1]
        if np.abs(step).max() < 1e-9:
            break
    return float(a), float(b)


def held_out(id_col: str) -> Column:
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % 4 == 2


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in slices(batches, "t"):
        x = [features(t) for t in b.column(1).to_pylist()]
        yield pa.RecordBatch.from_arrays([b.column(0), pa.array(x, pa.list_(pa.float32()))], ["role", "x"])


def estimate_prior(positive: np.ndarray, unlabelled: np.ndarray, delta: float = 0.1) -> float:
    """Class prior from scores of trusted positives and unlabelled rows that the scorer was not fitted on: the least ratio of their shares above a
    threshold, each widened by its confidence bound. At the threshold where only positives are left, the ratio is the prior."""
    t = np.unique(positive)
    above = lambda s: 1 - np.searchsorted(np.sort(s), t, "left") / len(s)
    width = lambda n: np.sqrt(np.log(4 / delta) / (2 * n))
    p, u = above(positive), above(unlabelled)
    ratio = (u + width(len(unlabelled)) + width(len(positive))) / np.maximum(p, 1e-9)
    at = int(np.argmin(ratio))
    return float(np.clip(u[at] / p[at], 0.02, 0.98))


def fit_quality(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", sample: int = SAMPLE) -> CalibratedFolds | PositiveUnlabelled | None:
    """Fit on at most `sample` trusted positives (label 1, without the held-out rows) and at most `sample` documents whose label is not
    read, each of smallest id hash; the latter stand for the web text as it comes. Of rows that share an id the one of smallest text stands for it. None without positives.

    The class prior is estimated and the score calibrated to it on rows that the classifiers in question were not fitted on (CalibratedFolds); with fewer than
    two rows of either kind a fold there is one classifier, with a prior of one half. Labels other than 1 are never used.
    """
    known = labels.where(~held_out(id_col)).where("quality = 1").select(F.col(id_col).alias("id")).distinct()
    ids = docs.select(F.col(id_col).alias("id")).where("id is not null").distinct()
    positive = known.orderBy(F.xxhash64("id", F.lit(1)), "id").limit(sample).select("id", F.lit(1).alias("role"))
    unlabelled = ids.orderBy(F.xxhash64("id", F.lit(2)), "id").limit(sample).select("id", F.lit(0).alias("role"))
    chosen = F.broadcast(positive.unionByName(unlabelled).groupBy("id").agg(F.collect_list("role").alias("roles")))  # at most 2 * sample rows
    text = docs.select(F.col(id_col).alias("id"), text_or_empty(text_col).cast("binary").alias("t"))
    one = text.join(chosen, "id").groupBy("id").agg(F.min(F.struct("t", "roles")).alias("row"))  # a repeated id counts once
    got = one.select(F.explode("row.roles").alias("role"), F.col("row.t").alias("t")).mapInArrow(_features, "role int, x array<float>").toPandas()
    x, role = np.array(got["x"].tolist(), np.float64), got["role"].to_numpy()
    if not (role == 1).any():
        return None
    order = np.lexsort(x.T)  # the fit does not depend on the order of partitions
    p, u = x[order][role[order] == 1], x[order][role[order] == 0]
    if min(len(p), len(u)) < 2 * FOLDS:
        return PositiveUnlabelled(p, u, 0.5)
    return CalibratedFolds(p, u)


def _score(texts: list[bytes], model: CalibratedFolds | PositiveUnlabelled | None) -> np.ndarray:
    """Without a model nothing is known against a text, and it just passes."""
    return model.score(np.array([features(t) for t in texts])) if texts and model else np.full(len(texts), THRESHOLD)


def _scores(batches: Iterator[pa.RecordBatch], model, kind: pa.DataType) -> Iterator[pa.RecordBatch]:
    for b in slices(batches, "t"):
        s = _score(b.column(1).to_pylist(), model.value)
        yield pa.RecordBatch.from_arrays([b.column(0), pa.array(s, pa.float64())], schema=pa.schema([("id", kind), ("score", pa.float64())]))


def score_quality(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id_col, held_out, score, predicted), one row per input row.

    Scores use the text alone. Null and empty texts get the score of the empty text; equal texts get equal scores; without
    positives every score is THRESHOLD. Rows with a null id are scored and not held out. An empty table gives an empty result.
    """
    from pyspark.sql.pandas.types import to_arrow_type

    kind = docs.schema[id_col].dataType
    arrow = to_arrow_type(kind)
    model = docs.sparkSession.sparkContext.broadcast(fit_quality(docs, labels, id_col, text_col))
    scored = docs.select(F.col(id_col).alias("id"), text_or_empty(text_col).cast("binary").alias("t")).mapInArrow(lambda it: _scores(it, model, arrow), f"id {kind.simpleString()}, score double")
    return scored.select(F.col("id").alias(id_col), F.coalesce(held_out("id"), F.lit(False)).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def keep_quality(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """The documents (all columns) whose predicted quality is 1; the text is scored where it lies, nothing is joined. Without positives
    all stay; null and empty texts share one score; repeated rows and null ids are judged like others."""
    model = docs.sparkSession.sparkContext.broadcast(fit_quality(docs, labels, id_col))

    def kept(batches):
        for b in slices(batches, "text"):
            s = _score([(t or "").encode("utf-8") for t in b.column("text").to_pylist()], model.value)
            yield b.filter(pa.array(s >= THRESHOLD, pa.bool_()))

    return docs.mapInArrow(kept, docs.schema)


def op6_quality_classifier(spark, sf_dir: str) -> DataFrame:
    return score_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


QUERIES = {"op6_quality_classifier": op6_quality_classifier}
ORACLE: dict[str, str] = {}
