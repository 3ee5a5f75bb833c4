"""Which documents are junk or toxic, by what they say and by where they come from.

Evidence: a logistic regression over hashed words of a text and bins of its shape, fitted on labelled documents. Of
the words, only the ``TOP`` whose log odds between the classes are furthest from zero count, and at least ``Z`` standard
errors away, so that rare words say nothing.

Place: hierarchical empirical Bayes. The probabilities of *all* documents are summed by host and by path. The rate of
a host is shrunk toward the global rate, that of a path toward its host, as strongly as the measured spread between
hosts, and between paths of a host, asks for. A document's odds are its evidence times the odds of its path without
the document itself.

The labelled sample is bounded by ``SAMPLE`` rows, those whose ids hash lowest; counts, sums and rates cover all
documents. The fitted model is bounded by ``BUCKETS`` and is all that reaches the driver.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .store import free_name, require, written
from .text import NOT_ALNUM, Words, buffers, distinct_by_row, slices

SAMPLE = 20_000
BUCKETS = 1 << 18
CLASSES = ("low", "toxic")
Z = 3.0
TOP = 1_000
TOP_CONCENTRATION = 1e6
_UPPER = np.zeros(256, bool)
_UPPER[65:91] = True
_LETTER = np.zeros(256, bool)
_LETTER[[*range(65, 91), *range(97, 123), *range(128, 256)]] = True
_DIGIT = np.zeros(256, bool)
_DIGIT[48:58] = True
_MARK = np.zeros(256, bool)
_MARK[[*range(33, 48), *range(58, 65), *range(91, 97), *range(123, 127)]] = True
_STOP = np.zeros(256, bool)
_STOP[[ord(c) for c in ".,;:'\"()-?"]] = True
SHARES = np.array([0, 1e-3, 3e-3, 0.01, 0.02, 0.04, 0.08, 0.15, 0.3, 0.5, 0.7, 0.9])
SIZES = np.array([0, 1, 2, 4, 8, 16, 32, 64, 128, 256, 1024, 4096])
N_SHAPES, N_BINS = 9, 13
FEATURES = BUCKETS + N_SHAPES * N_BINS


def _sums(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    total = np.zeros(len(flags) + 1, np.int64)
    np.cumsum(flags, out=total[1:])
    return total[offsets[1:]] - total[offsets[:-1]]


def features(offsets: np.ndarray, data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct feature numbers of each row, and where each row begins."""
    n = len(offsets) - 1
    plain = Words(offsets, data, NOT_ALNUM)
    words = Words(offsets, data)
    hashes, row_of = words.hashes, words.row_of
    count = np.maximum(np.diff(words.rows), 1)
    letters = np.maximum(_sums(_LETTER[data], offsets), 1)
    size = np.maximum(np.diff(offsets), 1)
    marks = _MARK[data]
    again = np.zeros(len(hashes), bool)
    again[1:] = (hashes[1:] == hashes[:-1]) & (row_of[1:] == row_of[:-1])
    _, distinct = distinct_by_row(hashes, row_of, n)
    shapes = [
        (_sums(_UPPER[data], offsets) / letters, SHARES),
        (_sums(marks, offsets) / size, SHARES),
        (_sums(marks & ~_STOP[data], offsets) / size, SHARES),
        (_sums(_DIGIT[data], offsets) / size, SHARES),
        (_sums(again, words.rows) / count, SHARES),
        (1 - np.diff(distinct) / count, SHARES),
        (_sums(marks[words.ends - 1], words.rows) / count, SHARES),
        (np.diff(offsets) / count, SIZES),
        (np.diff(words.rows), SIZES),
    ]
    ids = [np.searchsorted(edges, value, "right") + k * N_BINS + BUCKETS for k, (value, edges) in enumerate(shapes)]
    values = np.concatenate([(plain.hashes % np.uint64(BUCKETS)).astype(np.int64), *ids])
    rows = np.concatenate([plain.row_of, *[np.arange(n)] * len(ids)])
    return distinct_by_row(values, rows, n)


@dataclass
class Model:
    """For each class the weights of the features, what is added to their sum, and the class's share of the sample."""

    weights: np.ndarray
    shift: tuple[float, ...] = (0.0, 0.0)
    base: tuple[float, ...] = (0.5, 0.5)

    def log_odds(self, column: pa.Array) -> np.ndarray:
        offsets, data = buffers(column)
        out = np.zeros((len(CLASSES), len(column)))
        for a, b in slices(offsets):
            values, first = features(offsets[a: b + 1] - offsets[a], data[offsets[a]: offsets[b]])
            for c in range(len(CLASSES)):
                out[c, a:b] = np.add.reduceat(np.append(self.weights[c][values], 0.0), first[:-1])
        return out + np.array(self.shift)[:, None]

    def evidence(self, text: Column) -> Column:
        def run(column: pa.Array) -> pa.Array:
            return pa.StructArray.from_arrays([pa.array(x) for x in self.log_odds(column)], names=list(CLASSES))

        # Called nondeterministic so that a filter on the result does not work it out again in a second Python worker.
        return F.arrow_udf(run, "struct<low: double, toxic: double>").asNondeterministic()(text)


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents of each class that have each feature, and as feature -1 all documents, one row a feature and task."""
    total = np.zeros((3, FEATURES + 1), np.int64)
    for batch in batches:
        offsets, data = buffers(batch.column(0))
        kind = np.asarray(batch.column(1))
        for a, b in slices(offsets):
            values, first = features(offsets[a: b + 1] - offsets[a], data[offsets[a]: offsets[b]])
            kinds = np.repeat(kind[a:b], np.diff(first))
            for k in range(3):
                total[k, :FEATURES] += np.bincount(values[kinds == k], minlength=FEATURES)
                total[k, FEATURES] += int((kind[a:b] == k).sum())
    some = np.flatnonzero(total.sum(0))
    yield pa.RecordBatch.from_arrays([pa.array(np.where(some == FEATURES, -1, some)), *[pa.array(t[some]) for t in total]],
                                     names=["feature", "n0", "n1", "n2"])


def _chosen(text: Column, place: np.ndarray) -> Column:
    """The new numbers of the features of each text that have one, as little-endian 32-bit integers."""
    def run(column: pa.Array) -> pa.Array:
        offsets, data = buffers(column)
        out = []
        for a, b in slices(offsets):
            values, first = features(offsets[a: b + 1] - offsets[a], data[offsets[a]: offsets[b]])
            new = place[values]
            out += [new[i:j][new[i:j] >= 0].astype("<i4").tobytes() for i, j in zip(first, first[1:])]
        return pa.array(out, pa.binary())

    return F.arrow_udf(run, "binary")(text)


def _logistic(rows: np.ndarray, columns: np.ndarray, y: np.ndarray, width: int, pull: float = 0.1) -> tuple[np.ndarray, float]:
    """Weights and shift of a logistic regression on 0/1 features given as sorted row and column numbers."""
    n = len(y)
    w, shift = np.zeros(width), float(np.log((y.sum() + 0.5) / (n - y.sum() + 0.5)))
    m, v, t = np.zeros(width + 1), np.zeros(width + 1), 0
    for t in range(1, 201):
        f = np.bincount(rows, w[columns], n) + shift
        error = 1 / (1 + np.exp(-np.clip(f, -50, 50))) - y
        g = np.append((np.bincount(columns, error[rows], width) + pull * w) / n, error.mean())
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
        step = (0.15 if t < 120 else 0.03) * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.99**t)) + 1e-9)
        w, shift = w - step[:-1], shift - step[-1]
    return w, shift


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text: str = "text", sample: int = SAMPLE) -> Model:
    """Fit on the labelled documents whose ids hash lowest. Labels: ``quality`` and ``toxic``, 0 or 1.

    Labels without id or with a null label are left out; of contradicting labels the worse one counts. Without any
    labelled document the model knows nothing and keeps everything.
    """
    require(labels, id_col, "quality", "toxic")
    known = (labels.select(F.col(id_col).alias("_id"), "quality", "toxic").dropna().groupBy("_id")
             .agg(F.min("quality").alias("quality"), F.max("toxic").alias("toxic"))
             .orderBy(F.xxhash64("_id"), "_id").limit(sample))
    kind = F.when(F.col("toxic") == 1, 2).when(F.col("quality") == 0, 1).otherwise(0)
    # The sample is bounded by its parameter, so that it may be sent to all tasks.
    picked = written(known.select("_id", kind.cast("long").alias("kind")))
    found = docs.select(F.col(id_col).alias("_id"), F.col(text).alias("text")).join(F.broadcast(picked), "_id")
    counts = found.select("text", "kind").mapInArrow(
        _counted, "feature long, n0 long, n1 long, n2 long").groupBy("feature").agg(*[F.sum(f"n{k}").alias(f"n{k}") for k in range(3)])
    table = counts.toPandas()
    whole = table[table.feature < 0]
    if whole.empty or not (whole.n0.iloc[0] and len(table) > 1):
        return Model(np.zeros((2, FEATURES)), shift=(-20.0, -20.0))
    table = table[table.feature >= 0]
    n0, at = float(whole.n0.iloc[0]), table.feature.to_numpy()
    chosen: list[np.ndarray] = []
    for c in range(2):
        n1 = float(whole[f"n{c + 1}"].iloc[0])
        x1, x0 = table[f"n{c + 1}"].to_numpy(float), table.n0.to_numpy(float)
        odds = np.log((x1 + 0.5) / (n1 + 1)) - np.log((x0 + 0.5) / (n0 + 1))
        z = np.abs(odds) / np.sqrt(1 / (x1 + 0.5) + 1 / (x0 + 0.5))
        best = np.argsort(-z, kind="stable")[:TOP]
        chosen.append(at[best][z[best] > Z])
    place = np.full(FEATURES, -1)
    used = np.unique(np.concatenate([*chosen, np.arange(BUCKETS, FEATURES)]))
    place[used] = np.arange(len(used))
    # Of each sampled document only the chosen features come back: sample times features bounds them.
    rows = found.select("kind", _chosen(F.col("text"), place).alias("f")).toPandas()
    kind = rows.kind.to_numpy()
    lists = [np.frombuffer(f, np.int32) for f in rows.f]
    at_row = np.repeat(np.arange(len(lists)), [len(f) for f in lists])
    columns = np.concatenate(lists) if lists else np.zeros(0, np.int32)
    weights, shift, base = np.zeros((2, FEATURES)), [], []
    for c in range(2):
        own = (kind == 0) | (kind == c + 1)
        number = np.cumsum(own) - 1
        here = own[at_row]
        w, s = _logistic(number[at_row[here]], columns[here], (kind[own] == c + 1).astype(float), len(used))
        weights[c, used] = w
        shift.append(s)
        base.append(min(max(float((kind[own] == c + 1).mean()), 1e-3), 1 - 1e-3))
    return Model(weights, tuple(shift), tuple(base))


def _probability(log_odds: Column) -> Column:
    return 1 / (1 + F.exp(-log_odds))


def _concentration(mean: float, spread: float, groups: int, n: int) -> float:
    """How many documents the prior of a group is worth: few where groups differ by more than chance."""
    noise = mean * (1 - mean)
    beyond = spread - noise * groups / max(n, 1)
    return float(min(max(noise / beyond - 1, 1.0), TOP_CONCENTRATION)) if beyond > 0 and noise > 0 else TOP_CONCENTRATION


def place_rates(scored: DataFrame, host: str, path: str, evidence: str) -> tuple[DataFrame, dict[str, float]]:
    """Shrunk rates of every path, and the strengths of the priors.

    Returns ``host, path, n``, and of each class the sum, the rate of the host and the sums needed to leave one
    document out. Null hosts and paths are groups of their own.
    """
    paths = written(scored.groupBy(F.col(host).alias("host"), F.col(path).alias("path")).agg(
        F.count("*").alias("n"), *[F.sum(_probability(F.col(evidence)[c])).alias(f"sum_{c}") for c in CLASSES]))
    hosts = paths.groupBy("host").agg(F.sum("n").alias("host_n"), *[F.sum(f"sum_{c}").alias(f"host_sum_{c}") for c in CLASSES])
    total = hosts.agg(F.count("*").alias("hosts"), F.sum("host_n").alias("n"),
                      *[F.sum(f"host_sum_{c}").alias(f"sum_{c}") for c in CLASSES]).first()
    n = total["n"] or 0
    prior = {f"mean_{c}": min(max((total[f"sum_{c}"] or 0.0) / max(n, 1), 1e-4), 1 - 1e-4) for c in CLASSES}
    both = paths.join(hosts, paths["host"].eqNullSafe(hosts["host"])).drop(hosts["host"])
    spread = both.agg(F.count("*").alias("paths"), *[x for c in CLASSES for x in (
        F.sum(F.col("n") / F.col("host_n") * F.col("host_n") * F.pow(F.col(f"host_sum_{c}") / F.col("host_n") - prior[f"mean_{c}"], 2)).alias(f"host_{c}"),
        F.sum(F.col("n") * F.pow(F.col(f"sum_{c}") / F.col("n") - F.col(f"host_sum_{c}") / F.col("host_n"), 2)).alias(f"path_{c}"))]).first()
    for c in CLASSES:
        prior[f"host_{c}"] = _concentration(prior[f"mean_{c}"], (spread[f"host_{c}"] or 0.0) / max(n, 1), total["hosts"], n)
        prior[f"path_{c}"] = _concentration(prior[f"mean_{c}"], (spread[f"path_{c}"] or 0.0) / max(n, 1), spread["paths"], n)
    return both, prior


def classify(docs: DataFrame, model: Model, host: str, path: str, text: str = "text", out: str = "verdict") -> DataFrame:
    """All rows and columns of a table, and a struct with the evidence, the rates of the place, and the decision.

    ``p_low`` and ``p_toxic`` are posterior probabilities, ``keep`` holds where both are below one half. A null or
    empty text has the evidence of its shape alone. Repeated rows count as often as they occur; rows without id are
    nothing special. A column named ``out`` is replaced.
    """
    require(docs, host, path, text)
    evidence = free_name(docs, "_evidence")
    ours = {c: free_name(docs, f"_{c}") for c in ("host", "path")}
    scored = docs.withColumn(evidence, model.evidence(F.col(f"`{text}`")))
    rates, prior = place_rates(scored, host, path, evidence)
    numbers = {c: free_name(docs, f"_place_{c}") for c in rates.columns if c not in ours}
    rates = rates.select(*[F.col(c).alias(name) for c, name in {**ours, **numbers}.items()])
    joined = scored.join(rates, F.col(f"`{host}`").eqNullSafe(F.col(ours["host"])) & F.col(f"`{path}`").eqNullSafe(F.col(ours["path"])), "left")
    place = {c: F.col(name) for c, name in numbers.items()}
    fields = []
    for k, c in enumerate(CLASSES):
        log_odds = F.col(evidence)[c]
        own = _probability(log_odds)
        host_rate = ((prior[f"host_{c}"] * prior[f"mean_{c}"] + place[f"host_sum_{c}"] - own)
                     / (prior[f"host_{c}"] + place["host_n"] - 1))
        path_rate = ((prior[f"path_{c}"] * host_rate + place[f"sum_{c}"] - own) / (prior[f"path_{c}"] + place["n"] - 1))
        rate = F.greatest(F.least(path_rate, F.lit(1 - 1e-4)), F.lit(1e-4))
        fields += [log_odds.alias(f"evidence_{c}"), host_rate.alias(f"host_{c}"), path_rate.alias(f"path_{c}"),
                   _probability(log_odds + F.log(rate / (1 - rate)) - F.lit(float(np.log(model.base[k] / (1 - model.base[k]))))).alias(f"p_{c}")]
    verdict = joined.withColumn(out, F.struct(*fields))
    keep = (F.col(out)["p_low"] < 0.5) & (F.col(out)["p_toxic"] < 0.5)
    return verdict.withColumn(out, F.col(out).withField("keep", keep)).drop(evidence, *ours.values(), *numbers.values())
