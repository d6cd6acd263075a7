"""Operator 1, quality classifier by co-training.

Two views of a document are scored by separate logistic classifiers: its text
(trigrams of character classes, shares of repeated words) and its metadata
(language, source, length). In a round each view labels all unlabelled documents
that it is confident about, and the other view learns from them: Spark sums
their gradients and curvatures, and the driver takes the Newton steps. At the
end each view is calibrated on held-out labels, and the calibrated log-odds are
added (less the prior, which both hold).

Only the labelled rows are a bounded sample (about ``labelled_rows``, by the
hashes of their ids); their feature vectors, never their texts, come to the
driver. Every unlabelled document takes part in every round, whatever their
number. Features are computed once and stored; scoring is a narrow map over all
documents.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from parcelmart.llm.common import freed, fresh, small_batches, stored, text_bytes

#: Hashed trigrams of the text, and its further features.
TRIGRAMS, TEXT_DIM = 512, 514
#: Labelled rows that the classifiers are fitted on, about.
LABELLED_ROWS = 4000
#: Share of all documents from which on a metadata value has a place of its own; the others of its column share one.
MIN_SHARE = 0.002
#: Rounds, and passes over the unlabelled documents (Newton steps) in each.
ROUNDS, STEPS = 3, 2
#: How sure a view must be of a label that it passes on: its chance of error, by its calibration,
#: is at most ``1 - CONFIDENCE`` of that of giving every document this label.
CONFIDENCE = 0.95
#: All pseudo-labels of a class together weigh so much of the labelled rows of that class, in the last round.
PSEUDO_WEIGHT = 0.15
#: Numbers in a piece of a task's sums: pieces are added up by their place, so that no row or Arrow batch is large.
PIECE = 512
HELD_OUT = 0.25
#: A document is accepted from this chance of being good on: only clear cases go.
THRESHOLD = 0.3

#: Classes of the bytes: lower-case, capital, digit, beyond ASCII; any other byte is its own.
CLASSES = np.arange(256, dtype=np.uint32)
for _of, _bytes in ((1, b"abcdefghijklmnopqrstuvwxyz"), (2, b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"), (3, b"0123456789"), (4, bytes(range(128, 256)))):
    CLASSES[list(_bytes)] = _of


def text_features(text: bytes) -> np.ndarray:
    """Roots of the trigrams' frequencies, the share of words that repeat the word
    before, and the share of words seen earlier in the text; zeros for an empty text."""
    out = np.zeros(TEXT_DIM, np.float32)
    if text:
        data = CLASSES[np.frombuffer(b" " + text + b" ", np.uint8)]
        code = data[:-2] * np.uint32(0x10001) + data[1:-1] * np.uint32(0x101) + data[2:]
        hashed = (code * np.uint32(0x9E3779B1)) >> np.uint32(33 - TRIGRAMS.bit_length())
        out[:TRIGRAMS] = np.sqrt(np.bincount(hashed, minlength=TRIGRAMS) / len(hashed))
        words = text.split()
        if words:
            out[TRIGRAMS] = sum(map(eq, words, words[1:])) / len(words)
            out[TRIGRAMS + 1] = 1 - len(set(words)) / len(words)
    return out


def metadata_values(docs: DataFrame) -> list[Column]:
    """Language, source and length class as texts; a null is a value of its own, and a missing column holds nulls."""
    named = lambda c: F.col(c) if c in docs.columns else F.lit(None)
    n_chars = named("n_chars").cast("double")
    length = F.when(n_chars > 0, F.floor(2 * F.log2(n_chars))).otherwise(-1)
    return [F.coalesce(c.cast("string"), F.lit("\0")) for c in (named("lang"), named("source"), length)]


def metadata_places(docs: DataFrame, min_share: float = MIN_SHARE) -> list[dict[str, int]]:
    """A place for every value that at least ``min_share`` of all documents have, by column.

    At most ``1 / min_share`` values of a column reach that share. Place 0, 1
    and 2 are for all other values of the three columns.
    """
    columns = metadata_values(docs)
    pairs = docs.select(F.posexplode(F.array(*columns)).alias("of", "value")).groupBy("of", "value").agg(F.count(F.lit(1)).alias("n"))
    pairs = stored(pairs, "metadata-values")
    total = pairs.where("of = 0").agg(F.sum("n")).first()[0] or 0
    places: list[dict[str, int]] = [{} for _ in columns]
    at = len(columns)
    for r in pairs.where(F.col("n") >= total * min_share).orderBy("of", "value").collect():
        places[r["of"]][r["value"]] = at
        at += 1
    return places


def placed(columns: list[pa.Array], places: list[dict[str, int]]) -> np.ndarray:
    """A row of places, one a column, for each document."""
    out = np.empty((len(columns[0]), len(places)), np.int32)
    for k, (column, known) in enumerate(zip(columns, places)):
        coded = column.dictionary_encode()
        of = np.array([known.get(v, k) for v in coded.dictionary.to_pylist()], np.int32)
        out[:, k] = of[coded.indices.to_numpy(zero_copy_only=False)] if len(of) else 0
    return out


def metadata_features(keys: np.ndarray, size: int) -> np.ndarray:
    out = np.zeros((len(keys), size), np.float32)
    for column in keys.T:
        out[np.arange(len(keys)), column] = 1
    return out


@dataclass
class View:
    """A logistic classifier and its calibration: log-odds ``slope * margin + offset``."""

    weights: np.ndarray
    bias: float
    slope: float = 1.0
    offset: float = 0.0

    def margin(self, x: np.ndarray) -> np.ndarray:
        return x @ self.weights + self.bias

    def log_odds(self, margin):
        return self.slope * margin + self.offset


@dataclass
class Model:
    text: View
    meta: View
    prior: float  # log-odds of a good document in the labelled sample
    places: list[dict[str, int]]  # of the metadata values


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(np.clip(z, -60, 60) / 2))


def _design(x: np.ndarray) -> np.ndarray:
    return np.concatenate((x, np.ones((len(x), 1), x.dtype)), axis=1)


def _sums(x: np.ndarray, y, p: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Gradient and curvature of the log loss, summed over the rows."""
    return x.T @ (p - y), (x * (p * (1 - p))[:, None]).T @ x


def newton_step(theta: np.ndarray, x: np.ndarray, y: np.ndarray, more: tuple = (0.0, 0.0, 0.0), penalty: float = 1e-5) -> np.ndarray:
    """One step to the least mean log loss with a ridge penalty; ``more``: gradient, curvature and weight of other rows."""
    slope, curve = _sums(x, y, _sigmoid(x @ theta))
    weight = len(y) + more[2]
    slope, curve = (slope + more[0]) / weight + penalty * theta, (curve + more[1]) / weight
    curve[np.diag_indices_from(curve)] += penalty + 1e-9
    return theta - np.linalg.solve(curve, slope)


def fit_logistic(x: np.ndarray, y: np.ndarray, steps: int = 15) -> np.ndarray:
    """Weights and, last, the bias for rows of ``_design``, by Newton steps from zero."""
    theta = np.zeros(x.shape[1])
    for _ in range(steps):
        before, theta = theta, newton_step(theta, x, y)
        if np.abs(theta - before).max() < 1e-4:
            break
    return theta


def _view(theta: np.ndarray) -> View:
    return View(theta[:-1], float(theta[-1]))


def calibrate(view: View, x: np.ndarray, y: np.ndarray) -> View:
    """Slope and offset that make the margins log-odds, by Newton steps on held-out rows, with Platt's targets."""
    m = view.margin(x)
    good, bad = (y == 1).sum(), (y == 0).sum()
    target = np.where(y == 1, (good + 1) / (good + 2), 1 / (bad + 2))
    design = np.stack([m, np.ones(len(m))], axis=1)
    theta = np.array([1.0, 0.0])
    for _ in range(50):
        p = _sigmoid(design @ theta)
        slope = design.T @ (p - target) + 1e-3 * (theta - [1.0, 0.0])
        curve = (design * (p * (1 - p))[:, None]).T @ design + 1e-3 * np.eye(2)
        step = np.linalg.solve(curve, slope)
        theta = theta - step / max(1.0, np.abs(step).max())
        if np.abs(step).max() < 1e-9:
            break
    return View(view.weights, view.bias, float(max(theta[0], 0.0)), float(theta[1]))


def pseudo_sums(text: np.ndarray, meta: np.ndarray, labellers: list[np.ndarray], now: list[np.ndarray], limits: tuple[float, float]) -> np.ndarray:
    """What some unlabelled rows add, as one vector: for each view and value (0, 1), the number of rows whose
    chance by the other view's labeller is below or above the limits, their gradient and their curvature at the
    view's present weights."""
    out, both = [], (text, meta)
    for k, x in enumerate(both):
        sure, p = _sigmoid(both[1 - k] @ labellers[1 - k]), _sigmoid(x @ now[k])
        for value, rows in ((0, sure <= limits[0]), (1, sure >= limits[1])):
            slope, curve = _sums(x[rows], value, p[rows])
            out += [[rows.sum()], slope, curve.ravel()]
    return np.concatenate(out)


def _split_sums(total: np.ndarray, sizes: list[int]) -> list[list[tuple]]:
    """``(rows, gradient, curvature)`` by view and value."""
    at, out = 0, []
    for size in sizes:
        of = []
        for _ in range(2):
            end = at + 1 + size
            of.append((total[at], total[at + 1 : end], total[end : end + size * size].reshape(size, size)))
            at = end + size * size
        out.append(of)
    return out


def co_train(
    text: np.ndarray, meta: np.ndarray, y: np.ndarray, places: list, pool: Callable[[list, list, tuple], np.ndarray | None],
    rounds: int = ROUNDS, steps: int = STEPS,
) -> Model:
    """Both views from labelled rows and ``pool(labellers, now, limits)``, the ``pseudo_sums`` of all unlabelled rows.

    Every fourth labelled row is held out for calibration; a view is calibrated before it gives labels.
    """
    held = np.arange(len(y)) % round(1 / HELD_OUT) == 0
    if len(set(y[held])) < 2 or len(set(y[~held])) < 2:
        held = np.zeros(len(y), bool)  # too few labels to keep some aside
    views = [_design(text.astype(np.float64)), _design(meta.astype(np.float64))]
    fitted = [fit_logistic(x[~held], y[~held]) for x in views]
    known = [(y[~held] == value).sum() for value in (0, 1)]
    final = held if held.any() else ~held
    calibrated = lambda k: calibrate(_view(fitted[k]), views[k][final][:, :-1], y[final])
    doubt, share = 1 - CONFIDENCE, y.mean()
    for r in range(rounds):
        labellers = [np.append(v.slope * v.weights, v.log_odds(v.bias)) for v in (calibrated(0), calibrated(1))]
        for _ in range(steps):
            total = pool(labellers, fitted, (doubt * share, 1 - doubt * (1 - share)))
            if total is None:
                break
            for k, of in enumerate(_split_sums(total, [x.shape[1] for x in views])):
                # Many pseudo-labels share the weight that their class may have; none weighs more than a label.
                shares = [min(1.0, PSEUDO_WEIGHT * (r + 1) / rounds * known[v] / n) if n else 0.0 for v, (n, _, _) in enumerate(of)]
                more = tuple(sum(w * part[i] for w, part in zip(shares, of)) for i in (1, 2, 0))
                fitted[k] = newton_step(fitted[k], views[k][~held], y[~held], more)
    text_view, meta_view = calibrated(0), calibrated(1)
    good = (y.sum() + 1) / (len(y) + 2)
    return Model(text_view, meta_view, float(np.log(good / (1 - good))), places)


def _text_vector():
    @arrow_udf("binary")
    def vector(texts: pa.Array) -> pa.Array:
        return pa.array([text_features(t.as_py()).astype(np.float16).tobytes() for t in texts], pa.binary())

    # Marked so that Spark does not move a join below it, to the texts.
    return vector.asNondeterministic()


def _place_keys(places: list[dict[str, int]]):
    @arrow_udf("binary")
    def keys(lang: pa.Array, source: pa.Array, length: pa.Array) -> pa.Array:
        return pa.array([row.tobytes() for row in placed([lang, source, length], places)], pa.binary())

    return keys


def _matrices(x: list[bytes], keys: list[bytes], size: int) -> tuple[np.ndarray, np.ndarray]:
    text = np.frombuffer(b"".join(x), np.float16).reshape(-1, TEXT_DIM).astype(np.float32)
    return text, metadata_features(np.frombuffer(b"".join(keys), np.int32).reshape(len(keys), -1), size)


def _summed(pool: DataFrame, size: int) -> Callable[[list, list, tuple], np.ndarray | None]:
    """``pseudo_sums`` of all rows of ``pool``: a vector a task, in pieces that are added up by their place in it."""

    def sums(labellers: list, now: list, limits: tuple) -> np.ndarray | None:
        def of_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = 0.0
            some = False
            for batch in batches:
                if batch.num_rows:
                    text, meta = _matrices(batch.column(0).to_pylist(), batch.column(1).to_pylist(), size)
                    weights = [[w.astype(np.float32) for w in ws] for ws in (labellers, now)]
                    total, some = total + pseudo_sums(_design(text), _design(meta), *weights, limits).astype(np.float64), True
            if some:
                yield written({at: total[at : at + PIECE] for at in range(0, len(total), PIECE)})

        def added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            totals: dict[int, np.ndarray] = {}
            for batch in batches:
                for at, row in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                    piece = np.frombuffer(row, np.float64)
                    totals[at] = totals[at] + piece if at in totals else piece.copy()
            yield written(totals)

        def written(pieces: dict) -> pa.RecordBatch:
            return pa.RecordBatch.from_pydict({"at": pa.array(list(pieces), pa.int32()), "sums": pa.array([p.tobytes() for p in pieces.values()], pa.binary())})

        rows = pool.select("x", "keys").mapInArrow(of_rows, "at int, sums binary")
        rows = rows.repartition("at").mapInArrow(added, "at int, sums binary").collect()
        return np.concatenate([np.frombuffer(r.sums, np.float64) for r in sorted(rows, key=lambda r: r["at"])]) if rows else None

    return sums


def train(docs: DataFrame, labels: DataFrame, labelled_rows: int = LABELLED_ROWS, rounds: int = ROUNDS, steps: int = STEPS) -> Model | None:
    """A model for the 0/1 label ``quality``; None if the labels of ``docs`` do not hold both values.

    Repeated labels of a document count as their rounded mean; null ids and
    labels are not used, nor any other column of the labels. A document without
    an id is unlabelled. Of more than ``labelled_rows`` labelled documents, as
    many as that in the mean are fitted on, those with hashes under a cut.
    """
    small_batches(docs.sparkSession)
    known = labels.where("doc_id IS NOT NULL AND quality IS NOT NULL").groupBy("doc_id").agg(
        F.when(F.avg("quality") >= 0.5, 1).otherwise(0).alias("y")
    )
    places = metadata_places(docs)
    size = len(places) + sum(map(len, places))
    features = stored(docs.select("doc_id", _text_vector()(text_bytes()).alias("x"), _place_keys(places)(*metadata_values(docs)).alias("keys")), "features")
    marked = stored(known.join(features.select("doc_id"), "doc_id", "left_semi"), "labelled")
    total = marked.count()
    cut = int(2**31 * min(1.0, labelled_rows / total)) if total else 0
    chosen = marked.where(F.pmod(F.xxhash64("doc_id"), F.lit(2**31)) < cut).withColumnRenamed("doc_id", "chosen")  # rows: about the bound
    rows = features.join(F.broadcast(chosen), F.col("doc_id") == F.col("chosen")).groupBy("doc_id").agg(
        F.first("y").alias("y"), F.min(F.struct("x", "keys")).alias("d")
    )
    got = rows.select("doc_id", "y", "d.x", "d.keys").toPandas().sort_values("doc_id", ignore_index=True)
    y = got.y.to_numpy(int)
    if len(set(y)) < 2:
        return None
    text, meta = _matrices(list(map(bytes, got.x)), list(map(bytes, got["keys"])), size)
    free = features.where("doc_id IS NOT NULL").join(marked, "doc_id", "left_anti").union(features.where("doc_id IS NULL"))
    pool = stored(free.select("x", "keys"), "pool")
    freed(features, marked)
    model = co_train(text, meta, y, places, _summed(pool, size), rounds, steps)
    freed(pool)
    return model


def score(docs: DataFrame, model: Model | None, threshold: float = THRESHOLD) -> DataFrame:
    """All rows and columns of ``docs`` plus ``text_score``, ``meta_score``, ``quality_score`` (probabilities) and ``accepted``.

    Edge cases: a null or empty text has no trigrams and is judged by the rest;
    null metadata are values of their own. Without a model (no labels of both
    kinds) the scores are null and everything is accepted. No rows give no rows.
    Extra columns pass through; ones with the new columns' names are replaced.
    """
    small_batches(docs.sparkSession)
    docs = docs.drop("text_score", "meta_score", "quality_score", "accepted")
    if model is None:
        none = F.lit(None).cast("double")
        return docs.select(*docs.columns, none.alias("text_score"), none.alias("meta_score"), none.alias("quality_score"), F.lit(True).alias("accepted"))
    weights = docs.sparkSession.sparkContext.broadcast(model)

    @arrow_udf("double")
    def text_odds(texts: pa.Array) -> pa.Array:
        view = weights.value.text
        return pa.array([float(view.log_odds(view.margin(text_features(t.as_py())))) for t in texts], pa.float64())

    @arrow_udf("double")
    def meta_odds(lang: pa.Array, source: pa.Array, length: pa.Array) -> pa.Array:
        view, places = weights.value.meta, weights.value.places
        margin = view.weights[placed([lang, source, length], places)].sum(axis=1) + view.bias
        return pa.array(view.log_odds(margin).astype(float), pa.float64())

    a, b = fresh("text_odds", docs), fresh("meta_odds", docs)
    odds = docs.select(*docs.columns, text_odds(text_bytes()).alias(a), meta_odds(*metadata_values(docs)).alias(b))
    chance = lambda z: 1 / (1 + F.exp(-z))
    both = chance(F.col(a) + F.col(b) - model.prior)
    return odds.select(
        *docs.columns, chance(F.col(a)).alias("text_score"), chance(F.col(b)).alias("meta_score"), both.alias("quality_score"),
        (both >= threshold).alias("accepted"),
    )
