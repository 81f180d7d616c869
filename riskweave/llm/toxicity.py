"""Toxicity scoring by a bidirectional gated recurrent network in numpy.

Inputs of a word: a learned vector of its hashed lower-case form, and the sum
of learned vectors of its hashed character 4-grams (with word boundaries).  A
window of ``WINDOW`` words runs through a forward and a backward GRU; attention
over its hidden states pools them into one vector with a logistic output.  All
overlapping windows of the whole text are scored, ``STRIDE`` words apart, and a
text's score is its largest window's.

Training (numpy, driver) takes a sample of labelled texts of every length,
bounded by its rows and its characters; a toxic text teaches with the window that
currently scores highest, a clean one with its highest and a random one.  A final
offset is set on labelled texts of every length, where the maximum runs over many
windows.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskweave.llm import textops
from riskweave.llm.common import hash_order, held_out, thinned

WINDOW = 64
STRIDE = 32              # a span of up to WINDOW - STRIDE + 1 words lies whole in some window
WORD_BUCKETS = 1 << 12
CHAR_BUCKETS = 1 << 14
WORD_DIM = 6
CHAR_DIM = 8
HIDDEN = 8
SAMPLE_ROWS = 2500       # training rows per class at most
SAMPLE_CHARS = 6_000_000  # characters of training texts per class; the text that reaches it is the last
CALIBRATION_ROWS = 300   # rows per class for the offset at most
CALIBRATION_CHARS = 2_000_000
PIECE_CHARS = 125_000    # a longer text teaches with a piece from a hash-chosen place
_BLOCK = 1024            # windows run together


# --- Word inputs ---------------------------------------------------------------

@dataclass
class Vocabulary:
    """Distinct words of a chunk: ``word`` bucket and 4-gram buckets (``gram``,
    spans ``first``) of each; ``index`` of every word position into them."""

    word: np.ndarray
    gram: np.ndarray
    first: np.ndarray
    index: np.ndarray


def vocabulary(w: textops.Words) -> Vocabulary:
    h = textops.word_hashes(w, lower=True)
    _, at, index = np.unique(h, return_index=True, return_inverse=True)
    data = textops.LOWER[w.data].astype(np.uint64)
    start, size = w.start[at], (w.end - w.start)[at]
    first = np.concatenate([[0], np.cumsum(size)])
    word = np.repeat(np.arange(len(at)), size)
    inner = np.arange(first[-1]) - first[word]
    pos, left = start[word] + inner, size[word] - inner
    code = np.zeros(len(pos), np.uint64)
    padded = np.concatenate([data, np.zeros(3, np.uint64)])
    for shift, there in ((-1, inner > 0), (0, None), (1, left > 1), (2, left > 2)):
        byte = padded[pos + shift]
        code = (code << np.uint64(8)) | (byte if there is None else np.where(there, byte, np.uint64(0)))
    return Vocabulary((h[at] % np.uint64(WORD_BUCKETS)).astype(np.int64),
                      (textops.mix(code + np.uint64(1)) % np.uint64(CHAR_BUCKETS)).astype(np.int64), first, index)


def windows(w: textops.Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first word, length, row) of all windows; the last of a row reaches its
    end, a row without words has none."""
    n = w.count
    many = np.where(n > 0, 1 + np.maximum(0, -(-(n - WINDOW) // STRIDE)), 0)
    row = np.repeat(np.arange(w.rows), many)
    first = w.first[:-1][row] + STRIDE * (np.arange(many.sum()) - (np.cumsum(many) - many)[row])
    return first, np.minimum(WINDOW, w.first[1:][row] - first), row


# --- The network -----------------------------------------------------------------

def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1.0 + np.tanh(0.5 * x))


def fresh(seed: int) -> dict[str, np.ndarray]:
    rng = np.random.default_rng(seed)
    d, g = WORD_DIM + CHAR_DIM, 3 * HIDDEN
    draw = lambda *shape, s: (rng.standard_normal(shape) * s).astype(np.float32)
    p = {"word": draw(WORD_BUCKETS, WORD_DIM, s=0.1), "char": draw(CHAR_BUCKETS, CHAR_DIM, s=0.2)}
    for side in "fb":
        p |= {f"in_{side}": draw(d, g, s=0.4), f"rec_{side}": draw(HIDDEN, g, s=0.3), f"bias_{side}": draw(g, s=0.0)}
    return p | {"attend": draw(2 * HIDDEN, s=0.3), "out": draw(2 * HIDDEN, s=0.3), "offset": draw(1, s=0.0)}


def embed(p: dict, v: Vocabulary) -> np.ndarray:
    """Input vector of every distinct word."""
    chars = np.add.reduceat(p["char"][v.gram], v.first[:-1], axis=0) if len(v.word) else np.zeros((0, CHAR_DIM), np.float32)
    return np.concatenate([p["word"][v.word], chars], axis=1)


def _run(gates: np.ndarray, rec: np.ndarray, live: np.ndarray, back: bool, keep: list | None) -> np.ndarray:
    """Hidden states (time, batch, HIDDEN) of one direction; ``gates`` holds the
    input parts (time, batch, 3 HIDDEN).  A dead step keeps the state."""
    steps, batch, _ = gates.shape
    states = np.empty((steps, batch, HIDDEN), np.float32)
    h = np.zeros((batch, HIDDEN), np.float32)
    two = 2 * HIDDEN
    for t in range(steps - 1, -1, -1) if back else range(steps):
        ru = _sigmoid(gates[t, :, :two] + h @ rec[:, :two])
        r, u = ru[:, :HIDDEN], ru[:, HIDDEN:]
        c = np.tanh(gates[t, :, two:] + (r * h) @ rec[:, two:])
        new = np.where(live[t], h + u * (c - h), h)
        if keep is not None:
            keep.append((t, h, r, u, c))
        h = new
        states[t] = h
    return states


def forward(p: dict, x: np.ndarray, index: np.ndarray, live: np.ndarray, keep: dict | None = None) -> np.ndarray:
    """Logits of windows; ``x`` word vectors, ``index`` and ``live`` (time, batch)."""
    sides = []
    for side in "fb":
        gates = (x @ p[f"in_{side}"] + p[f"bias_{side}"])[index]
        trace = [] if keep is not None else None
        sides.append(_run(gates, p[f"rec_{side}"], live[:, :, None], side == "b", trace))
        if keep is not None:
            keep[side] = trace
    states = np.concatenate(sides, axis=2)
    weight = np.where(live, states @ p["attend"], np.float32(-1e9))
    weight = np.exp(weight - weight.max(axis=0))
    weight /= weight.sum(axis=0)
    pooled = np.einsum("tb,tbh->bh", weight, states)
    if keep is not None:
        keep |= {"states": states, "weight": weight, "pooled": pooled}
    return pooled @ p["out"] + p["offset"][0]


def backward(p: dict, x: np.ndarray, v: Vocabulary, index: np.ndarray, live: np.ndarray, keep: dict,
             error: np.ndarray) -> dict[str, np.ndarray]:
    """Gradients of all parameters for the logits' ``error``."""
    g = {"out": keep["pooled"].T @ error, "offset": np.array([error.sum()], np.float32)}
    d_pool = error[:, None] * p["out"]
    d_weight = np.einsum("bh,tbh->tb", d_pool, keep["states"])
    d_energy = keep["weight"] * (d_weight - (keep["weight"] * d_weight).sum(axis=0))
    g["attend"] = np.einsum("tb,tbh->h", d_energy, keep["states"])
    d_states = keep["weight"][:, :, None] * d_pool + d_energy[:, :, None] * p["attend"]
    dx = np.zeros_like(x)
    two = 2 * HIDDEN
    for k, side in enumerate("fb"):
        rec = p[f"rec_{side}"]
        d_rec = np.zeros_like(rec)
        d_gates = np.zeros((*index.shape, 3 * HIDDEN), np.float32)
        dh = np.zeros((index.shape[1], HIDDEN), np.float32)
        for t, h, r, u, c in reversed(keep[side]):
            dh = dh + d_states[t, :, k * HIDDEN:(k + 1) * HIDDEN]
            d_new = np.where(live[t][:, None], dh, 0)
            du, dc = d_new * (c - h) * u * (1 - u), d_new * u * (1 - c * c)
            d_rh = dc @ rec[:, two:].T
            dr = d_rh * h * r * (1 - r)
            d_ru = np.concatenate([dr, du], axis=1)
            d_rec[:, :two] += h.T @ d_ru
            d_rec[:, two:] += (r * h).T @ dc
            d_gates[t] = np.concatenate([d_ru, dc], axis=1)
            dh = dh - d_new * u + d_rh * r + d_ru @ rec[:, :two].T
        flat = d_gates.reshape(-1, 3 * HIDDEN)
        at = index.ravel()
        by_word = np.column_stack([np.bincount(at, flat[:, j], minlength=len(x)) for j in range(3 * HIDDEN)]).astype(np.float32)
        g[f"rec_{side}"], g[f"bias_{side}"], g[f"in_{side}"] = d_rec, flat.sum(axis=0), x.T @ by_word
        dx += by_word @ p[f"in_{side}"].T
    g["word"] = np.zeros_like(p["word"])
    np.add.at(g["word"], v.word, dx[:, :WORD_DIM])
    g["char"] = np.zeros_like(p["char"])
    np.add.at(g["char"], v.gram, np.repeat(dx[:, WORD_DIM:], np.diff(v.first), axis=0))
    return g


def _steps(first: np.ndarray, length: np.ndarray, index: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Word index and liveness (time, batch) of windows."""
    t = np.arange(int(length.max()))[:, None]
    live = t < length
    return index[np.where(live, first + t, first)], live


def _states(table: np.ndarray, rec: np.ndarray, at: np.ndarray, live: np.ndarray, back: bool,
            states: np.ndarray) -> None:
    """As :func:`_run` without a trace, into ``states``.  ``table`` holds each
    distinct word's gate inputs; the logistic gates' are halved beforehand, so
    that one tanh serves all three gates."""
    steps, batch = at.shape
    two = 2 * HIDDEN
    rec_ru, rec_c = rec[:, :two] * np.float32(0.5), rec[:, two:]
    h = np.zeros((batch, HIDDEN), np.float32)
    whole = live.all(axis=1)
    for t in range(steps - 1, -1, -1) if back else range(steps):
        gate = table[at[t]]
        ru = h @ rec_ru
        ru += gate[:, :two]
        np.tanh(ru, out=ru)
        ru += 1
        ru *= np.float32(0.5)
        c = (ru[:, :HIDDEN] * h) @ rec_c
        c += gate[:, two:]
        np.tanh(c, out=c)
        c -= h
        c *= ru[:, HIDDEN:]
        if not whole[t]:
            c *= live[t][:, None]
        h = np.add(h, c, out=states[t])


def window_logits(p: dict, v: Vocabulary, first: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Logits of windows, in blocks of similar length."""
    x = embed(p, v)
    half = np.repeat(np.array([0.5, 1.0], np.float32), [2 * HIDDEN, HIDDEN])
    tables = [(x @ p[f"in_{s}"] + p[f"bias_{s}"]) * half for s in "fb"]
    out = np.empty(len(first), np.float32)
    order = np.argsort(length, kind="stable")
    for a in range(0, len(first), _BLOCK):
        pick = order[a:a + _BLOCK]
        at, live = _steps(first[pick], length[pick], v.index)
        energy = np.zeros(at.shape, np.float32)
        worth = np.full(at.shape, p["offset"][0], np.float32)
        states = np.empty((*at.shape, HIDDEN), np.float32)
        for k, side in enumerate("fb"):
            own = slice(k * HIDDEN, (k + 1) * HIDDEN)
            _states(tables[k], p[f"rec_{side}"], at, live, side == "b", states)
            both = states.reshape(-1, HIDDEN) @ np.stack([p["attend"][own], p["out"][own]], axis=1)
            energy += both[:, 0].reshape(at.shape)
            worth += both[:, 1].reshape(at.shape)
        energy[~live] = -np.inf
        weight = np.exp(energy - energy.max(axis=0))
        out[pick] = (weight * worth).sum(axis=0) / weight.sum(axis=0)
    return out


def text_logits(p: dict, texts: pa.Array) -> np.ndarray:
    """Largest window logit of each text; -inf without words."""
    out = np.full(len(texts), -np.inf)
    for lo, hi, data, off in textops.chunks(texts):
        w = textops.words(data, off)
        first, length, row = windows(w)
        if len(first):
            np.maximum.at(out, lo + row, window_logits(p, vocabulary(w), first, length))
    return out


# --- Training ----------------------------------------------------------------------

def fit(texts: list[str], toxic: np.ndarray, *, epochs: int = 10, steps: int = 800, batch: int = 64,
        rate: float = 0.01, seed: int = 1) -> dict[str, np.ndarray]:
    """Train for ``epochs`` passes, and as many more as ``steps`` updates take."""
    p, rng = fresh(seed), np.random.default_rng(seed)
    if not len(texts) or toxic.all() or not toxic.any():
        return p | {"offset": np.array([-6.0 if not toxic.any() else 6.0], np.float32), "out": p["out"] * 0}
    raw = [t.encode() for t in texts]
    off = np.concatenate([[0], np.cumsum([len(b) for b in raw])])
    w = textops.words(np.frombuffer(b"".join(raw), np.uint8), off)
    v = vocabulary(w)
    first, length, row = windows(w)
    single = np.bincount(row, minlength=len(texts))[row] == 1
    m = {k: np.zeros_like(a) for k, a in p.items()}
    s = {k: np.zeros_like(a) for k, a in p.items()}
    step = epoch = 0
    while epoch < epochs or step < steps:
        if epoch == 0:  # texts of one window: no choice to make yet
            use = np.flatnonzero(single)
            if len(use) < batch or toxic[row[use]].all() or not toxic[row[use]].any():
                use = rng.permutation(len(first))[:batch * steps // 3]
        else:
            logit = window_logits(p, v, first, length)
            order = np.lexsort((logit, row))
            top = order[np.flatnonzero(np.append(row[order][1:] != row[order][:-1], True))]
            clean = np.flatnonzero(~toxic[row])
            use = np.unique(np.concatenate([top, rng.choice(clean, min(len(clean), len(top)))]))
        for _ in range(3 if epoch == 0 else 1):
            rng.shuffle(use)
            for a in range(0, len(use), batch):
                pick = use[a:a + batch]
                at, live = _steps(first[pick], length[pick], v.index)
                seen, at = np.unique(at, return_inverse=True)
                at = at.reshape(live.shape)
                size = np.diff(v.first)[seen]
                span = np.concatenate([[0], np.cumsum(size)])
                gram = v.gram[np.repeat(v.first[:-1][seen] - span[:-1], size) + np.arange(span[-1])]
                part = Vocabulary(v.word[seen], gram, span, at)
                x = embed(p, part)
                # words seen whole teach less than their letters: drop word vectors at random
                drop = rng.random(len(x)) < 0.4
                x[drop, :WORD_DIM] = 0
                keep: dict = {}
                z = forward(p, x, at, live, keep)
                error = ((_sigmoid(z) - toxic[row[pick]]) / len(pick)).astype(np.float32)
                g = backward(p, x, part, at, live, keep, error)
                step += 1
                norm = np.sqrt(sum(float((a * a).sum()) for a in g.values()))
                for k in p:
                    d = g[k] * np.float32(min(1.0, 1.0 / (norm + 1e-9)))
                    m[k] += 0.1 * (d - m[k])
                    s[k] += 0.001 * (d * d - s[k])
                    p[k] -= (rate * (m[k] / (1 - 0.9 ** step)) / (np.sqrt(s[k] / (1 - 0.999 ** step)) + 1e-8)).astype(np.float32)
        epoch += 1
    return p


def calibrated(p: dict, texts: list[str], toxic: np.ndarray, toxic_share: float) -> dict:
    """Shift the offset so that logit 0 splits the texts with the fewest errors,
    classes weighted by their share."""
    z = text_logits(p, pa.array(texts, pa.string()))
    ok = np.isfinite(z)
    z, y = z[ok], toxic[ok]
    if not y.any() or y.all():
        return p
    order = np.argsort(z)
    weight = np.where(y, max(toxic_share, 0.05) / y.sum(), (1 - toxic_share) / (~y).sum())[order]
    signed = np.where(y[order], weight, -weight)
    errors = np.concatenate([[0], np.cumsum(signed)])  # toxic below the cut, less clean below it
    best = np.flatnonzero(errors <= errors.min() + 1e-12)
    zs = z[order]
    k = int(best[len(best) // 2])
    cut = (zs[k - 1] + zs[k]) / 2 if 0 < k < len(zs) else (zs[0] - 1 if k == 0 else zs[-1] + 1)
    return p | {"offset": p["offset"] - np.float32(cut)}


def train(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
          label_col: str = "toxic", modulus: int = 5, remainder: int = 0, rows: int = SAMPLE_ROWS,
          chars: int = SAMPLE_CHARS, piece: int = PIECE_CHARS, seed: int = 1) -> dict[str, np.ndarray]:
    """Fit on labelled rows whose id is not held out: per class, texts of every
    length in hash order, at most ``rows`` and until ``chars`` characters are
    reached, and others up to ``CALIBRATION_ROWS`` and ``CALIBRATION_CHARS`` for the
    offset.  A text over ``piece`` characters teaches with that many from a
    hash-chosen place; an id that comes with several texts teaches with one."""
    known = (labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("label"))
             .where(~held_out("id", modulus, remainder)).where("label in (0, 1)")
             .groupBy("id").agg(F.max("label").alias("label")))
    shares = {r["label"]: r["n"] for r in known.groupBy("label").agg(F.count("*").alias("n")).collect()}
    lengths = docs.select(F.col(id_col).alias("id"), F.length(text_col).alias("size")).where("size > 0")
    picked = None
    for label in (0, 1):  # ids are chosen without their texts
        own = (lengths.join(known.where(F.col("label") == label), "id")
               .where(thinned("id", seed, 4 * rows, shares.get(label, 0))).groupBy("id").agg(F.max("size").alias("size")))
        for kind, shift, most, budget in (("fit", 0, rows, chars), ("offset", 1, CALIBRATION_ROWS, CALIBRATION_CHARS)):
            part = own.select("id", F.lit(kind).alias("kind"), F.lit(label).alias("label"), hash_order("id", seed + shift).alias("h"),
                              F.least("size", F.lit(piece)).alias("size"), F.lit(budget).alias("budget"))
            part = part.orderBy("h", "id").limit(most)
            picked = part if picked is None else picked.unionByName(part)
    before = F.sum("size").over(Window.partitionBy("kind", "label").orderBy("h", "id")
                                .rowsBetween(Window.unboundedPreceding, -1))
    picked = picked.withColumn("before", F.coalesce(before, F.lit(0))).where("before < budget").select("id", "kind", "label")
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).join(F.broadcast(picked), "id")
    room = F.greatest(F.length("text") - piece, F.lit(0)) + 1
    start = (F.pmod(hash_order("id", seed + 2), room) + 1).cast("int")
    sample = (texts.where(F.length("text") > 0).withColumn("text", F.substring("text", start, F.lit(piece)))
              .groupBy("kind", "label", "id").agg(F.max("text").alias("text")).select("kind", "label", "text"))
    found = sorted(tuple(r) for r in sample.collect())
    side = lambda kind: ([t for k, _, t in found if k == kind], np.array([y == 1 for k, y, _ in found if k == kind], bool))
    p = fit(*side("fit"), seed=seed)
    return calibrated(p, *side("offset"), shares.get(1, 0) / max(1, sum(shares.values())))


def score_column(model: dict[str, np.ndarray], text: str = "text") -> Column:
    @F.arrow_udf("double")
    def toxicity(texts: pa.Array) -> pa.Array:
        z = text_logits(model, texts)
        return pa.array(np.where(np.isfinite(z), _sigmoid(np.clip(z, -30, 30)), 0.0))
    return toxicity(F.col(text))


def score(docs: DataFrame, model: dict[str, np.ndarray], *, id_col: str = "doc_id", text_col: str = "text",
          modulus: int = 5, remainder: int = 0) -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted.

    Null, empty and wordless texts score 0.  With labels of one class only the
    score is constant on that class's side.  Repeated rows are scored as often
    as they come; other columns are ignored; an empty table gives an empty
    result.
    """
    out = docs.select(F.col(id_col).alias("doc_id"), score_column(model, text_col).alias("score"))
    return out.select("doc_id", held_out("doc_id", modulus, remainder).alias("held_out"), "score",
                      (F.col("score") >= 0.5).cast("int").alias("predicted"))
