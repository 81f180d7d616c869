"""Quality classifier by Bradley-Terry pairwise ranking.

Every text gets a vector of bounded statistics of its whole word sequence.
Every text labelled good is preferred to every one labelled bad; a Bradley-Terry
model scores a text by a weighted sum of hinge functions of its statistics,
fitted by the logistic loss on the difference of the two texts' features, over
all pairs of all labelled rows: a row's share of the gradient follows from its
score and the other class's counts of scores, so a step is two passes over the
rows' statistics.  The decision threshold is a quantile of the scores of all
labelled rows: the share of bad texts among them.  The published score is a logistic function of the
ranking score that equals ``CUT`` at that quantile, so ``score >= CUT`` keeps
what ranks above it.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskweave.llm import textops
from riskweave.llm.common import Scratch, held_out

CUT = 0.3
BIN = 0.1            # scores are counted in bins of this width; the slope changes by 0.025 a bin at most
FINE = 1e-6          # width of the bin that the threshold ends
_TASK_ROWS = 5000    # rows of statistics in a partition
_KNOTS = 8
_WINDOW = 50

STATISTICS = ("log_words", "mean_length", "upper", "symbols", "digits", "marks", "bars", "distinct", "repeat_next",
              "repeat_trigrams", "longest_word", "stop_share", "window_upper", "window_symbols", "window_marks",
              "window_bars", "window_repeat", "word_ends", "accents", "long_lines")

_CLASS = np.zeros((256, 5), np.float32)  # upper case, symbols, digits, exclamation and question marks, bars
_CLASS[0x41:0x5B, 0] = 1
_CLASS[list(b"#*$%&<>{}[]=~^_\\/@+"), 1] = 1
_CLASS[0x30:0x3A, 2] = 1
_CLASS[list(b"!?"), 3] = 1
_CLASS[list(b"|"), 4] = 1


def _share(total: np.ndarray, n: np.ndarray) -> np.ndarray:
    return total / np.maximum(n, 1)


def _sums(values: np.ndarray, edges: np.ndarray) -> np.ndarray:
    """Sum of ``values`` between consecutive edges (empty spans give 0)."""
    total = np.concatenate([np.zeros((1, *values.shape[1:])), np.cumsum(values, axis=0, dtype=np.float64)])
    return total[edges[1:]] - total[edges[:-1]]


def _distinct(h: np.ndarray, row: np.ndarray, rows: int) -> np.ndarray:
    """Number of different hashes in each row."""
    order = np.lexsort((h, row))
    hs, rs = h[order], row[order]
    new = np.ones(len(h), bool)
    new[1:] = (hs[1:] != hs[:-1]) | (rs[1:] != rs[:-1])
    return np.bincount(rs[new], minlength=rows)


def statistics(data: np.ndarray, off: np.ndarray) -> np.ndarray:
    """(rows, len(STATISTICS)) of a chunk of texts."""
    w = textops.words(data, off)
    rows, n = w.rows, w.count
    size = (w.end - w.start).astype(np.float64)
    first = w.first
    chars = _sums(size, first)
    per_byte = np.concatenate([np.zeros((1, 5)), np.cumsum(_CLASS[data], axis=0, dtype=np.float64)])
    kinds = per_byte[off[1:]] - per_byte[off[:-1]]
    h = textops.word_hashes(w)
    row = w.row
    again = np.zeros(len(h))
    again[1:] = (h[1:] == h[:-1]) & (row[1:] == row[:-1])
    tri, at = textops.kmer_hashes(w, h, 3)
    tri_n = np.bincount(row[at], minlength=rows)
    tri_distinct = _distinct(tri, row[at], rows)
    last = data[w.end - 1]
    ends = np.isin(last, np.frombuffer(b".,;:", np.uint8)).astype(np.float64)
    short = (size <= 4).astype(np.float64)
    high = np.concatenate([[0], np.cumsum(data >= 0xC3, dtype=np.float64)])
    lines = np.concatenate([[0], np.cumsum(data == 0x0A, dtype=np.float64)])

    # worst window of _WINDOW words: windows tile each row, the last may be short
    tiles = -(-n // _WINDOW)
    tile_first = np.repeat(first[:-1] - _WINDOW * (np.cumsum(tiles) - tiles), tiles) + _WINDOW * np.arange(tiles.sum())
    tile_row = np.repeat(np.arange(rows), tiles)
    tile_last = np.minimum(tile_first + _WINDOW, first[1:][tile_row])
    worst = np.zeros((rows, 5))
    if len(tile_first):
        byte0, byte1 = w.start[tile_first], w.end[tile_last - 1]
        rates = (per_byte[byte1] - per_byte[byte0])[:, [0, 1, 3, 4]] / np.maximum(byte1 - byte0, 20)[:, None]
        repeats = np.concatenate([[0], np.cumsum(again)])
        rates = np.column_stack([rates, (repeats[tile_last] - repeats[tile_first]) / _WINDOW])
        has = np.flatnonzero(tiles)
        worst[has] = np.maximum.reduceat(rates, (np.cumsum(tiles) - tiles)[has], axis=0)

    longest = np.zeros(rows)
    has = np.flatnonzero(n)
    if len(has):
        longest[has] = np.maximum.reduceat(size, first[:-1][has])
    return np.column_stack([
        np.log1p(n), _share(chars, n), _share(kinds[:, 0], chars), _share(kinds[:, 1], chars),
        _share(kinds[:, 2], chars), _share(kinds[:, 3], n), _share(kinds[:, 4], n),
        _share(_distinct(h, row, rows), n), _share(_sums(again, first), n), 1 - _share(tri_distinct, tri_n) * (tri_n > 0) - (tri_n == 0),
        np.log1p(longest), _share(_sums(short, first), n), worst[:, 0], worst[:, 1], worst[:, 2], worst[:, 3], worst[:, 4],
        _share(_sums(ends, first), n), _share(high[off[1:]] - high[off[:-1]], chars),
        _share(lines[off[1:]] - lines[off[:-1]], n)]).astype(np.float64)


def text_statistics(texts: pa.Array) -> np.ndarray:
    out = np.zeros((len(texts), len(STATISTICS)))
    for lo, hi, data, off in textops.chunks(texts):
        out[lo:hi] = statistics(data, off)
    return out


@dataclass
class RankingModel:
    """Hinge positions (statistics x knots), spread, weights and calibration."""

    knots: np.ndarray
    spread: np.ndarray
    weights: np.ndarray
    cut: float
    scale: float

    def basis(self, x: np.ndarray) -> np.ndarray:
        hinge = np.maximum(0.0, x[:, :, None] - self.knots[None]) / self.spread[None, :, None]
        return np.minimum(hinge, 4.0).reshape(len(x), -1)

    def rank(self, x: np.ndarray) -> np.ndarray:
        return self.basis(x) @ self.weights

    def score(self, x: np.ndarray) -> np.ndarray:
        z = (self.rank(x) - self.cut) * self.scale + np.log(CUT / (1 - CUT))
        return 1.0 / (1.0 + np.exp(-np.clip(z, -40, 40)))


def _rows(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """(label, statistics) of a batch of (label, x)."""
    return batch.column(0).to_numpy(), batch.column(1).flatten().to_numpy().reshape(batch.num_rows, len(STATISTICS))


def counted(stats: DataFrame, model: RankingModel, width: float, within: tuple[float, float] | None = None) -> np.ndarray:
    """(label, bin, rows) in order of bins: how many rows of ``stats(label, x)`` rank in
    each bin of ``width``, of those ranked from the first of ``within`` to below the second."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            label, x = _rows(batch)
            rank = model.rank(x)
            has = (rank >= within[0]) & (rank < within[1]) if within else np.ones(len(rank), bool)
            key, n = np.unique(np.column_stack([label, np.floor(rank / width)])[has].astype(np.int64), axis=0, return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(key[:, 0]), pa.array(key[:, 1]), pa.array(n)], ["label", "bin", "n"])
    got = stats.mapInArrow(run, "label long, bin long, n long").groupBy("label", "bin").agg(F.sum("n").alias("n")).collect()
    return np.array(sorted(((r["label"], r["bin"], r["n"]) for r in got), key=lambda r: r[1]), np.int64).reshape(-1, 3)


def gradient(stats: DataFrame, model: RankingModel) -> np.ndarray:
    """Of the logistic loss, averaged over all pairs of a good and a bad row."""
    bins = counted(stats, model, BIN)
    of = [bins[bins[:, 0] == c] for c in (0, 1)]
    total = [c[:, 2].sum() for c in of]

    def lost(rank: np.ndarray, good: bool) -> np.ndarray:
        """Mean loss slope of rows against the other class's bins."""
        other = of[0 if good else 1]
        at = (np.arange(rank.min() // BIN, rank.max() // BIN + 2) + 0.5) * BIN if len(rank) else np.zeros(1)
        z = (at[:, None] - (other[:, 1] + 0.5) * BIN) * (1 if good else -1)
        slope = (1.0 / (1.0 + np.exp(np.clip(z, -40, 40)))) @ other[:, 2] / other[:, 2].sum()
        return np.interp(rank, at, slope)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = np.zeros(model.weights.size)
        for batch in batches:
            label, x = _rows(batch)
            basis = model.basis(x)
            rank = basis @ model.weights
            for good in (False, True):
                own = label == int(good)
                out += (lost(rank[own], good) @ basis[own]) * (-1 if good else 1) / total[int(good)]
        yield pa.RecordBatch.from_arrays([pa.array([out.tolist()], pa.list_(pa.float64()))], ["g"])
    return np.sum([r["g"] for r in stats.mapInArrow(run, "g array<double>").collect()], axis=0)


def fit(stats: DataFrame, *, steps: int = 50, rate: float = 0.15, decay: float = 1e-4) -> RankingModel:
    """Bradley-Terry fit over all pairs of ``stats(label, x)``.  With one class only
    the model keeps everything (all good) or nothing."""
    each = [F.col("x")[i] for i in range(len(STATISTICS))]
    probs = np.linspace(0, 1, _KNOTS // 2 + 1)[:-1].tolist()
    of = {r["label"]: r for r in stats.groupBy("label").agg(
        F.count("*").alias("n"), F.array(*map(F.avg, each)).alias("mean"), F.array(*map(F.var_pop, each)).alias("var"),
        F.array(*(F.percentile_approx(c, probs, 10000) for c in each)).alias("knots")).collect()}
    model = RankingModel(np.zeros((len(STATISTICS), _KNOTS)), np.ones(len(STATISTICS)), np.zeros(len(STATISTICS) * _KNOTS), 0.0, 1.0)
    if len(of) < 2:
        model.cut = 1.0 if 0 in of else -1.0
        return model
    mean, var = (np.array([of[c][n] for c in (0, 1)]) for n in ("mean", "var"))  # both classes weigh the same
    model.knots = np.sort(np.concatenate([np.array(of[c]["knots"]) for c in (0, 1)], axis=1), axis=1)
    model.spread = np.sqrt(var.mean(axis=0) + mean.var(axis=0)) + 1e-3
    m, v = np.zeros(model.weights.size), np.zeros(model.weights.size)
    for t in range(1, steps + 1):
        grad = gradient(stats, model) + decay * model.weights
        m = 0.9 * m + 0.1 * grad
        v = 0.99 * v + 0.01 * grad * grad
        model.weights = model.weights - rate * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.99 ** t)) + 1e-8)
    bins = counted(stats, model, BIN)
    bad = of[0]["n"]  # as many rows are to rank below the threshold as are labelled bad
    at = int(np.searchsorted(np.cumsum(bins[:, 2]), bad))
    edge = bins[at, 1] * BIN
    fine = counted(stats, model, FINE, (edge - BIN, edge + 2 * BIN))
    below = bins[bins[:, 1] < bins[at, 1] - 1, 2].sum()
    model.cut = float((fine[min(int(np.searchsorted(below + np.cumsum(fine[:, 2]), bad)), len(fine) - 1), 1] + 1) * FINE)
    weight = bins[:, 2] / np.where(bins[:, 0] == 1, of[1]["n"], of[0]["n"]) / 2
    middle = weight @ bins[:, 1]
    model.scale = float(2.0 / (np.sqrt(weight @ (bins[:, 1] - middle) ** 2) * BIN + 1e-6))
    return model


def train(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
          label_col: str = "quality", modulus: int = 5, remainder: int = 0) -> RankingModel:
    """Fit on all labelled texts whose id is not held out."""
    known = (labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("label"))
             .where(~held_out("id", modulus, remainder)).where("label in (0, 1)")
             .groupBy("id").agg(F.max("label").alias("label")))
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).where(~held_out("id", modulus, remainder))
    measured = texts.select("id", statistics_column("text").alias("x")).join(known, "id").distinct()
    kept = Scratch(docs.sparkSession)
    parts = known.count() // _TASK_ROWS + 1
    stats = kept.write(measured.select("label", "x").repartition(parts), "quality-statistics")
    model = fit(stats)
    kept.drop("quality-statistics")
    return model


def statistics_column(text: str) -> Column:
    @F.arrow_udf("array<double>")
    def measured(texts: pa.Array) -> pa.Array:
        x = text_statistics(texts)
        return pa.FixedSizeListArray.from_arrays(pa.array(x.ravel()), x.shape[1]).cast(pa.list_(pa.float64()))
    return measured(F.col(text))


def score_column(model: RankingModel, text: str = "text") -> Column:
    @F.arrow_udf("double")
    def quality(texts: pa.Array) -> pa.Array:
        return pa.array(model.score(text_statistics(texts)))
    return quality(F.col(text))


def score(docs: DataFrame, model: RankingModel, *, id_col: str = "doc_id", text_col: str = "text",
          modulus: int = 5, remainder: int = 0) -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted.

    Null and empty texts are scored as texts without words.  Without labels the
    model keeps everything; with one class only it follows that class.  Repeated
    rows are scored as often as they come; other columns are ignored.
    """
    out = docs.select(F.col(id_col).alias("doc_id"), score_column(model, text_col).alias("score"))
    return out.select("doc_id", held_out("doc_id", modulus, remainder).alias("held_out"), "score",
                      (F.col("score") >= CUT).cast("int").alias("predicted"))
