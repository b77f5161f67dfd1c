"""Quality scores by co-training a text view and a metadata view.

The text view sees shares of character kinds and repetition of words; the metadata
view sees source, language and stated length.  Both start from labelled rows.  In
every round each view scores all unlabelled documents and hands those it is surest
of, as pseudo-labels, to the other view.  At the end both views are calibrated on
labelled rows kept aside and combined there, and all documents are scored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lethe.llm.words import byte_column, word_hashes
from lethe.operators.sizing import durable, keyed_join, measured

SOURCES, LANGUAGES = 256, 32
FIT_ROWS = 1_000  # rows whose features the driver holds at once
#: rows of a view to their features; None if they are these
Spread = Callable[[np.ndarray], np.ndarray] | None
_KINDS = ("upper", "lower", "digit", "space", "line", "loud", "symbol", "bar", "stop", "other", "high")
TEXT_FEATURES = (*_KINDS, "log_words", "distinct", "again", "word_length", "empty")
_KIND = np.full(256, _KINDS.index("other"), dtype=np.uint8)
for _name, _bytes in (("upper", range(65, 91)), ("lower", range(97, 123)), ("digit", range(48, 58)),
                      ("space", (32, 9, 11, 12, 13)), ("line", (10,)), ("loud", b"!?"),
                      ("symbol", b"#$%&*+<=>@\\^_`{}~"), ("bar", b"|/"), ("stop", b".,;:"),
                      ("high", range(128, 256))):
    _KIND[list(_bytes)] = _KINDS.index(_name)


@dataclass(frozen=True)
class QualityParameters:
    labelled: int = 20_000  # labelled rows used to fit and calibrate, at most
    rounds: int = 3
    exchanged: int = 300  # pseudo-labels per view, class and round
    confidence: float = 0.95  # calibrated, from which a view may hand on a label
    held_out: float = 0.25  # share of the labelled rows that calibrates
    ridge: float = 1.0
    keep_from: float = 0.5  # score from which a document is kept


@dataclass(frozen=True)
class Linear:
    """A logistic model: weights per feature after scaling, and its calibration."""

    weights: np.ndarray
    bias: float
    slope: float = 1.0
    shift: float = 0.0

    def logit(self, x: np.ndarray) -> np.ndarray:
        return (x @ self.weights + self.bias) * self.slope + self.shift


def fit_logistic(x: np.ndarray, y: np.ndarray, ridge: float, spread: Spread = None) -> Linear:
    """Ridge-penalised logistic regression by Newton steps; classes weigh the same.

    ``spread`` turns rows of ``x`` into their features, a block at a time, so the driver
    never holds the wide rows of a whole sample.
    """
    spread = spread or (lambda rows: rows)
    share = np.clip(y.mean(), 1e-6, 1 - 1e-6)
    importance = np.where(y > 0.5, 0.5 / share, 0.5 / (1 - share))
    w = np.zeros(spread(x[:1]).shape[1] + 1)
    penalty = np.full(len(w), ridge)
    penalty[-1] = 1e-6
    for _ in range(30):
        gradient = -penalty * w
        curve = np.zeros((len(w), len(w)))
        for at in range(0, len(x), FIT_ROWS):
            some = slice(at, at + FIT_ROWS)
            features = spread(x[some])
            x1 = np.column_stack([features, np.ones(len(features))])
            p = 1 / (1 + np.exp(-np.clip(x1 @ w, -30, 30)))
            gradient += x1.T @ (importance[some] * (y[some] - p))
            curve += (x1 * (importance[some] * np.maximum(p * (1 - p), 1e-6))[:, None]).T @ x1
        step = np.linalg.solve(curve + np.diag(penalty), gradient)
        w += step * min(1.0, 5.0 / max(1e-12, np.abs(step).max()))
        if np.abs(step).max() < 1e-6:
            break
    return Linear(w[:-1], float(w[-1]))


def logits_of(model: Linear, x: np.ndarray, spread: Spread = None) -> np.ndarray:
    """The model's logits, a block of rows at a time."""
    spread = spread or (lambda rows: rows)
    parts = [model.logit(spread(x[at : at + FIT_ROWS])) for at in range(0, len(x), FIT_ROWS)]
    return np.concatenate(parts) if parts else np.zeros(0)


def calibrated(model: Linear, x: np.ndarray, y: np.ndarray, spread: Spread = None) -> Linear:
    """The model with its logit mapped to the shares seen on rows it was not fitted on."""
    z = logits_of(model, x, spread)[:, None]
    x1 = np.column_stack([z, np.ones(len(z))])
    w = np.array([1.0, 0.0])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x1 @ w, -30, 30)))
        curve = (x1 * np.maximum(p * (1 - p), 1e-6)[:, None]).T @ x1 + np.diag([1e-2, 1e-2])
        step = np.linalg.solve(curve, x1.T @ (y - p) - 1e-2 * w)
        w += step * min(1.0, 2.0 / max(1e-12, np.abs(step).max()))
    return Linear(model.weights, model.bias, float(w[0]), float(w[1]))


def _text_features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = batch.num_rows
        if not rows:
            continue
        text = batch.column(0)
        raw, offsets = byte_column(text)
        out = np.zeros((rows, len(TEXT_FEATURES)))
        words = np.zeros(rows)
        for row, end, hashes, bounds in word_hashes(text):
            for i in range(end - row):
                own = hashes[bounds[i] : bounds[i + 1]]
                words[row + i] = n = len(own)
                if n:
                    out[row + i, 12] = len(np.unique(own)) / n
                    out[row + i, 13] = (own[1:] == own[:-1]).sum() / n
            begin, stop = int(offsets[row]), int(offsets[end])
            kinds = _KIND[raw[begin:stop]]
            filled = np.flatnonzero(np.diff(offsets[row : end + 1]))
            if len(filled):
                starts = (offsets[row:end] - begin)[filled]
                for k in range(len(_KINDS)):
                    out[row + filled, k] = np.add.reduceat(kinds == k, starts, dtype=np.int64)
        size = np.diff(offsets)
        out[:, : len(_KINDS)] /= np.maximum(size, 1)[:, None]
        out[:, 11] = np.log1p(words)
        out[:, 14] = size / np.maximum(words, 1) / 10
        out[:, 14] = np.minimum(out[:, 14], 10)
        out[:, 15] = words == 0
        flat = pa.array(out.ravel())
        at = pa.array(np.arange(0, out.size + 1, out.shape[1], dtype=np.int32))
        columns = [batch.column(k) for k in range(1, batch.num_columns)]
        yield pa.RecordBatch.from_arrays(
            [*columns, pa.ListArray.from_arrays(at, flat)],
            ["doc_id", "source", "language", "size", "text_view"],
        )


def _features(docs: DataFrame, id_col: str, text_col: str, source_col: str, lang_col: str,
              size_col: str) -> DataFrame:
    def bucket(name, n):
        if name not in docs.columns:
            return F.lit(0)
        hashed = F.pmod(F.xxhash64(F.col(name).cast("string")), F.lit(n - 1)) + 1
        return F.when(F.col(name).isNull(), 0).otherwise(hashed).cast("int")

    stated = F.col(size_col).cast("double") if size_col in docs.columns else F.lit(None).cast("double")
    narrow = docs.select(
        F.col(text_col).cast("string").alias("text"),
        F.col(id_col).cast("long").alias("doc_id"),
        bucket(source_col, SOURCES).alias("source"),
        bucket(lang_col, LANGUAGES).alias("language"),
        F.log1p(F.greatest(F.coalesce(F.when(~F.isnan(stated), stated), F.lit(0.0)), F.lit(0.0))).alias("size"),
    )
    return narrow.mapInArrow(
        _text_features,
        "doc_id long, source int, language int, size double, text_view array<double>",
    )


def _meta_view(rows: np.ndarray) -> np.ndarray:
    """Features of the metadata of some rows (source, language, size)."""
    n, size = len(rows), rows[:, 2]
    x = np.zeros((n, SOURCES + LANGUAGES + 2))
    x[np.arange(n), rows[:, 0].astype(int)] = 1
    x[np.arange(n), SOURCES + rows[:, 1].astype(int)] = 1
    x[:, -2], x[:, -1] = size / 10, (size / 10) ** 2
    return x


_SPREAD: dict[str, Spread] = {"text": None, "meta": _meta_view}


def _rows(frame: DataFrame) -> dict[str, np.ndarray]:
    """A bounded number of feature rows as arrays."""
    table = frame.select("source", "language", "size", "text_view", "y").toArrow()
    flat = table["text_view"].combine_chunks().flatten().to_numpy(zero_copy_only=False)
    meta = [table[c].to_numpy().astype(float) for c in ("source", "language", "size")]
    return {
        "text": flat.astype(float).reshape(-1, len(TEXT_FEATURES)),
        "meta": np.column_stack(meta),
        "y": table["y"].to_numpy().astype(float),
    }


def _text_logit(m: Linear, mean: np.ndarray, scale: np.ndarray) -> Column:
    weights = m.weights / scale
    bias = m.bias - float((m.weights * mean / scale).sum())
    terms = (F.get("text_view", F.lit(k)) * float(w) for k, w in enumerate(weights))
    return (reduce(lambda a, b: a + b, terms) + bias) * m.slope + m.shift


def _meta_logit(m: Linear) -> Column:
    sources = F.array(*(F.lit(float(w)) for w in m.weights[:SOURCES]))
    languages = F.array(*(F.lit(float(w)) for w in m.weights[SOURCES:-2]))
    x = F.col("size") / 10
    linear = (
        F.get(sources, F.col("source"))
        + F.get(languages, F.col("language"))
        + x * float(m.weights[-2])
        + x * x * float(m.weights[-1])
        + m.bias
    )
    return linear * m.slope + m.shift


def _probability(logit: Column) -> Column:
    return 1 / (1 + F.exp(-logit))


def quality_scores(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id",
                   text_col: str = "text", source_col: str = "source", lang_col: str = "lang",
                   size_col: str = "n_chars", label_col: str = "quality",
                   parameters: QualityParameters = QualityParameters()) -> DataFrame:
    """(doc_id, text_score, meta_score, score, kept) of every row of ``docs``.

    Scores are calibrated probabilities of good quality.  A label is a document's mean
    label, rounded; rows of ``labels`` without id or label count for nothing.  The models
    see a bounded sample of labelled rows, those smallest by a hash of their id; every
    unlabelled document is scored in every round.  Null or empty texts and missing
    metadata have features of their own.  Without labels of both classes there is nothing
    to learn: scores are null and everything is kept.  Repeated rows and rows without
    id are scored each for itself.  Other columns are not read.
    """
    p = parameters
    known = labels.where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull())
    known = known.groupBy(F.col(id_col).cast("long").alias("_value")).agg(
        F.round(F.avg(F.col(label_col).cast("double"))).alias("y")
    )
    own = _features(docs, id_col, text_col, source_col, lang_col, size_col)
    scored = durable(keyed_join(own, F.col("doc_id"), measured(known), "left"))
    draw = F.xxhash64(F.col("doc_id"), F.lit(7))
    sample = scored.where("y is not null").orderBy(draw, "doc_id", "size").limit(p.labelled)
    chosen = sample.withColumn("aside", F.pmod(F.xxhash64("doc_id", F.lit(11)), F.lit(1000)) < 1000 * p.held_out)
    chosen = durable(chosen)
    fit, aside = _rows(chosen.where("not aside")), _rows(chosen.where("aside"))
    if min(len(set(fit["y"])), len(set(aside["y"]))) < 2:
        nothing = F.lit(None).cast("double")
        return scored.select(
            "doc_id",
            *(nothing.alias(c) for c in ("text_score", "meta_score", "score")),
            F.lit(True).alias("kept"),
        )
    mean, scale = fit["text"].mean(axis=0), fit["text"].std(axis=0) + 1e-3
    standard = lambda x: np.clip((x - mean) / scale, -1e6, 1e6)
    views = {
        "text": (standard(fit["text"]), fit["y"]),
        "meta": (fit["meta"], fit["y"]),
    }
    asides = {"text": standard(aside["text"]), "meta": aside["meta"]}
    for step in range(p.rounds + 1):
        models = {
            k: calibrated(fit_logistic(x, y, p.ridge, _SPREAD[k]), asides[k], aside["y"], _SPREAD[k])
            for k, (x, y) in views.items()
        }
        logits = {"text": _text_logit(models["text"], mean, scale), "meta": _meta_logit(models["meta"])}
        if step < p.rounds:
            for giver, taker in (("text", "meta"), ("meta", "text")):
                rows = _confident(scored, logits[giver], p)
                if len(rows["y"]):
                    x = standard(rows["text"]) if taker == "text" else rows["meta"]
                    old, y = views[taker]
                    views[taker] = np.vstack([old, x]), np.concatenate([y, rows["y"]])
    both = np.column_stack([logits_of(models[k], asides[k], _SPREAD[k]) for k in ("text", "meta")])
    final = calibrated(fit_logistic(both, aside["y"], p.ridge), both, aside["y"])
    a, b = (float(w) for w in final.weights)
    logit = (logits["text"] * a + logits["meta"] * b + final.bias) * final.slope + final.shift
    return scored.select(
        "doc_id",
        _probability(logits["text"]).alias("text_score"),
        _probability(logits["meta"]).alias("meta_score"),
        _probability(logit).alias("score"),
    ).withColumn("kept", F.col("score") >= p.keep_from)


def _confident(scored: DataFrame, logit: Column, p: QualityParameters) -> dict[str, np.ndarray]:
    """The unlabelled documents a view is surest of, with the label it gives them."""
    open_rows = scored.where("y is null").withColumn("p", _probability(logit))
    good = open_rows.where(F.col("p") >= p.confidence).orderBy(F.desc("p"), "doc_id").limit(p.exchanged)
    bad = open_rows.where(F.col("p") <= 1 - p.confidence).orderBy("p", "doc_id").limit(p.exchanged)
    both = good.withColumn("y", F.lit(1.0)).unionByName(bad.withColumn("y", F.lit(0.0)))
    return _rows(both)
