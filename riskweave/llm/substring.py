"""Substring dedup: repeated passages found by collinear chaining.

1. *Seeds*: in every window of ``WINDOW`` consecutive ``K``-word runs the run
   with the smallest hash is a seed, so an exact passage of ``K + WINDOW`` words
   shares a seed in all its copies.
2. *Links*: a seed that occurs in two documents or more is joined to its first
   occurrence (smallest document, then position), and if it occurs ``FEW`` times
   at most to every one in an earlier document.  Of a more frequent seed the runs
   that it forms with the next 1, 3, 7, .. frequent seeds of its document are
   joined in the same way: the longer a run, the rarer it is.  What stays
   unlinked: copies whose every seed is frequent and that, between two edits, share
   no run which occurs ``FEW`` times at most or first in one of them.  Links grow
   with the text however often a passage repeats.  Sampled runs of ``LONG`` words
   are seeds too: a passage of lines that each come earlier elsewhere is found
   whole, since the runs across the lines' borders come first in the document that
   holds the passage.
3. *Chains*: the links of a document to one earlier document are chained in
   order on both sides; a tree over the earlier document's positions gives the
   best predecessor within ``MAX_GAP`` words on both sides under a linear gap cost.
4. *Alignment*: a chain's two stretches, as one byte per word, are compared
   along its diagonals, with the best break point where the diagonal changes;
   segments in which at least ``IDENTITY`` of the words agree are passages.
   Single links near each other (the repeats of a line) come as one row.  What
   cannot reach beyond the words that a document's segments cover so far, nor be
   longer than the longest of them there, is passed over.

The chains of a document are aligned together.  Its segments that touch,
whatever document they point to, form one passage, reported from ``MIN_WORDS``
words on.  Words are lower-cased.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from collections import deque
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskweave.llm import textops
from riskweave.llm.common import Scratch, temp_name, written

K = 5
WINDOW = 8
LONG = 25             # words of a long run
FEW = 8               # occurrences up to which all pairs of a seed are linked
MIN_WORDS = 50
MIN_SEGMENT = 20      # words of one aligned segment
IDENTITY = 0.8
EDGE_PRICE = 1.25     # agreements that a disagreement costs where a segment ends
GAP_COST = 0.05       # per word skipped on either side
MAX_GAP = 100         # words between neighbours of a chain
JOIN_GAP = 3          # words between segments of one passage
_MARGIN = 100         # words looked at beyond a chain's ends
_DROP = 40            # score lost before a segment is closed
_NONE = (-1e18, -1)


# --- Seeds -------------------------------------------------------------------------

def sampled(v: np.ndarray, row: np.ndarray, window: int) -> np.ndarray:
    """Positions in ``v`` (hashes of consecutive runs, ``row`` the text of each)
    of the smallest hash of every window of ``window`` runs; of a text with
    fewer runs its smallest."""
    if not len(v):
        return np.zeros(0, np.int64)
    best, span = np.arange(len(v)), 1
    while span < window:  # smallest of ``span`` runs from each start, doubled
        step = min(span, window - span)
        other = best[step:]
        head = best[:len(other)]
        best = np.where(v[other] < v[head], other, head)
        span += step
    whole = best[row[:len(best)] == row[window - 1:window - 1 + len(best)]] if len(best) else best
    first = np.flatnonzero(np.append(True, row[1:] != row[:-1]))
    size = np.diff(np.append(first, len(row)))
    few = size < window  # rows with fewer runs than a window: their smallest
    least = np.minimum.reduceat(v, first)
    small = np.flatnonzero((v == np.repeat(least, size)) & np.repeat(few, size))
    return np.unique(np.concatenate([whole, small]))


def seed_positions(w: textops.Words, h: np.ndarray, k: int = K, window: int = WINDOW) -> tuple[np.ndarray, np.ndarray]:
    """(word index, hash) of the seeds of all rows."""
    v, at = textops.kmer_hashes(w, h, k)
    pick = sampled(v, w.row[at], window)
    return at[pick], v[pick]


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, textops.Words, np.ndarray]]:
    """(ids, words, word hashes) of chunks of (doc_id, text) batches."""
    for batch in batches:
        ids = batch.column(0).to_numpy(zero_copy_only=False)
        for lo, hi, data, off in textops.chunks(batch.column(1)):
            w = textops.words(data, off)
            yield ids[lo:hi], w, textops.word_hashes(w, lower=True)


def seeds(docs: DataFrame) -> DataFrame:
    """(doc_id, h, p) of ``docs(doc_id, text)``: seeds and sampled long runs.

    Of every ``LONG - 1`` runs of ``LONG`` words in a row the one of smallest hash
    is taken.  As many runs lie across each border between two lines, so each
    border in an exact passage has a sampled run across it."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, w, h in _texts(batches):
            for k, window in ((K, WINDOW), (LONG, LONG - 1)):
                at, v = seed_positions(w, h, k, window)
                row = w.row[at]
                yield pa.RecordBatch.from_arrays([pa.array(ids[row], pa.int64()), pa.array(v.view(np.int64)), pa.array(
                    (at - w.first[row]).astype(np.int32))], ["doc_id", "h", "p"])
    return docs.mapInArrow(run, "doc_id long, h long, p int")


def signatures(docs: DataFrame) -> DataFrame:
    """(doc_id, sig): one byte per word."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, w, h in _texts(batches):
            raw = (h >> np.uint64(56)).astype(np.uint8)
            sig = pa.Array.from_buffers(pa.binary(), len(ids), [None, pa.py_buffer(w.first.astype(np.int32).tobytes()),
                                                              pa.py_buffer(raw.tobytes())])
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), sig], ["doc_id", "sig"])
    return docs.mapInArrow(run, "doc_id long, sig binary")


def _places(batch: pa.RecordBatch, most: int = 1 << 16) -> Iterator[np.ndarray]:
    """Integer rows of a (doc_id, h, p, ..) batch, one for each place, in parts of about
    ``most`` rows: those in the list ``more`` follow the one in ``p``."""
    x = integers(batch.select([c for c in batch.schema.names if c != "more"]))
    further = batch.column("more").flatten().to_numpy(zero_copy_only=False) if "more" in batch.schema.names else ()
    if not len(further):
        yield x
        return
    size = 1 + pc.list_value_length(batch.column("more")).to_numpy(zero_copy_only=False).astype(np.int64)
    end = np.cumsum(size)
    edges = np.concatenate([[0], np.flatnonzero(np.diff(end // most)) + 1, [len(x)]])
    for lo, hi in zip(edges[:-1].tolist(), edges[1:].tolist()):
        part = np.repeat(x[lo:hi], size[lo:hi], axis=0)
        before = int(end[lo] - size[lo])
        later = np.ones(len(part), bool)
        later[end[lo:hi] - size[lo:hi] - before] = False
        part[later, 2] = further[before - lo:int(end[hi - 1]) - hi]
        yield part


_Rows = Callable[[np.ndarray, np.ndarray, np.ndarray, bool], pa.RecordBatch]


def _paired(found: DataFrame, rows: _Rows, kind: str) -> DataFrame:
    """What ``rows(x, ref, q, frequent)`` makes of ``found(doc_id, h, p, ..)``: ``x`` has
    rows of hashes that two documents share or more.  Each occurrence of one that occurs
    over ``FEW`` times comes with the first (smallest document, then position), one of
    another hash once with each occurrence in an earlier document.  A row is one occurrence,
    or all those of a document where ``more`` lists the places after ``p``.

    A task reads its hashes in order and keeps of one no more than ``FEW`` rows or
    the rows of one document."""
    width = len([c for c in found.columns if c != "more"])

    def of_seeds(x: np.ndarray) -> Iterator[pa.RecordBatch]:
        first = np.flatnonzero(np.append(True, np.diff(x[:, 1]) != 0))
        size = np.diff(np.append(first, len(x)))
        several = x[first, 0] < x[first + size - 1, 0]
        of = np.repeat(np.where(several & (size > FEW), first, -1), size)
        at = np.flatnonzero(of >= 0)
        yield rows(x[at], x[of[at], 0], x[of[at], 2], True)
        of = np.repeat(np.where(several & (size <= FEW), first, len(x)), size)
        for step in range(1, FEW):
            at = np.flatnonzero(np.arange(len(x)) - step >= of)
            at = at[x[at - step, 0] < x[at, 0]]
            yield rows(x[at], x[at - step, 0], x[at - step, 2], False)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest, under_way = np.zeros((0, width), np.int64), None
        for part in (part for batch in batches for part in _places(batch)):
            x = np.concatenate([rest, part])
            rest = x[:0]
            if under_way is not None:  # a frequent seed goes on
                n = int(np.searchsorted(x[:, 1], under_way[1], side="right"))
                yield rows(x[:n], np.full(n, under_way[0]), np.full(n, under_way[2]), True)
                x = x[n:]
            if not len(x):
                continue
            under_way, tail = None, int(np.searchsorted(x[:, 1], x[-1, 1]))
            if tail:
                yield from of_seeds(x[:tail])
            rest = x[tail:]
            if len(rest) > FEW and rest[0, 0] < rest[-1, 0]:
                yield from of_seeds(rest)
                rest, under_way = rest[:0], rest[0]
        if len(rest):
            yield from of_seeds(rest)

    return found.repartition("h").sortWithinPartitions("h", "doc_id", "p").mapInArrow(run, kind)


def shared(found: DataFrame) -> DataFrame:
    """(doc_id, h, p, ref, q, frequent) from ``found(doc_id, h, p)``: seeds that two
    documents share or more, each with the places that it is linked to."""
    def rows(x: np.ndarray, ref: np.ndarray, q: np.ndarray, frequent: bool) -> pa.RecordBatch:
        cols = [x[:, 0], x[:, 1], x[:, 2].astype(np.int32), ref, q.astype(np.int32), np.full(len(x), frequent)]
        return pa.RecordBatch.from_arrays([pa.array(c) for c in cols], ["doc_id", "h", "p", "ref", "q", "frequent"])

    return _paired(found.select("doc_id", "h", "p"), rows, "doc_id long, h long, p int, ref long, q int, frequent boolean")


def first_links(found: DataFrame) -> DataFrame:
    """(doc_id, ref, p, q): links to earlier documents in the rows of ``shared``."""
    return found.where("doc_id <> ref").select("doc_id", "ref", "p", "q")


def integers(batch: pa.RecordBatch) -> np.ndarray:
    return np.column_stack([c.to_numpy(zero_copy_only=False).astype(np.int64) for c in batch.columns])


def whole_documents(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[np.ndarray]:
    """Rows of integer batches sorted by their first ``keys`` columns, cut where
    those change: the last group of a batch may go on in the next."""
    rest: np.ndarray | None = None
    for batch in batches:
        x = integers(batch)
        if rest is not None:
            x = np.concatenate([rest, x])
        if not len(x):
            continue
        tail = int(np.flatnonzero((x[:, :keys] != x[-1, :keys]).any(axis=1)).max(initial=-1)) + 1
        if tail:
            yield x[:tail]
        rest = x[tail:]
    if rest is not None and len(rest):
        yield rest


def _once(x: np.ndarray, v: np.ndarray) -> pa.RecordBatch:
    """(doc_id, h, p, ref0, q0, more) of runs ``v`` that start at the rows of ``x``, in
    order: a run that a document repeats is one row, its places after the first in ``more``."""
    key = v + x[:, 0].astype(np.uint64) * textops.BASE
    same = np.sort(key)
    again = np.isin(key, same[1:][same[1:] == same[:-1]])
    at = np.flatnonzero(again)
    at = at[np.lexsort((v[at], x[at, 0]))]  # keeps the order of places
    new = np.append(True, (np.diff(x[at, 0]) != 0) | (np.diff(v[at]) != 0))[:len(at)]
    size = np.diff(np.append(np.flatnonzero(new), len(at))) - 1
    size = np.append(np.zeros(int((~again).sum()), np.int64), size)
    pick = np.append(np.flatnonzero(~again), at[new])
    more = pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(size)).astype(np.int32)), pa.array(x[at[~new], 2].astype(np.int32)))
    cols = [x[pick, 0], v[pick].view(np.int64), x[pick, 2].astype(np.int32), x[pick, 3], x[pick, 4].astype(np.int32)]
    return pa.RecordBatch.from_arrays([*map(pa.array, cols), more], ["doc_id", "h", "p", "ref0", "q0", "more"])


def document_runs(found: DataFrame) -> DataFrame:
    """(doc_id, h, p, ref0, q0, more): runs of 2, 4, 8, .. seeds of ``found(doc_id, h, p,
    ref, q)`` in a row, with the first place of their first seed.  A run is one row of a
    document, ``more`` its places there after ``p``, mostly none: a line that comes
    again and again makes few runs, each in many places.

    Seeds too far apart for a chain are in no run together."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for x in whole_documents(batches, 1):
            far = (np.diff(x[:, 0]) != 0) | (np.diff(x[:, 2]) > MAX_GAP + K)
            row = np.append(0, np.cumsum(far))
            v, n = x[:, 1].copy().view(np.uint64), 1
            while 2 * n <= len(x):
                v, n = textops.mix(v[:-n] * textops.BASE + v[n:]), 2 * n
                at = np.flatnonzero(row[:len(v)] == row[n - 1:])
                if not len(at):
                    break
                yield _once(x[at], v[at])

    ordered = found.select("doc_id", "h", "p", "ref", "q").repartition("doc_id").sortWithinPartitions("doc_id", "p", "h")
    return ordered.mapInArrow(run, "doc_id long, h long, p int, ref0 long, q0 int, more array<int>")


def runs(found: DataFrame) -> DataFrame:
    """(doc_id, h, p, ref0, q0): the rows of ``document_runs`` place by place."""
    return document_runs(found).select("doc_id", "h", F.explode(F.concat(F.array("p"), "more")).alias("p"), "ref0", "q0")


def run_links(found: DataFrame) -> DataFrame:
    """(doc_id, ref, p, q): links to earlier documents by the rows of ``document_runs``, but
    for those to the first place of a run's first seed, which that seed has itself.  Nearly
    all runs of near copies are such, so none of them leaves the pass."""
    def rows(x: np.ndarray, ref: np.ndarray, q: np.ndarray, frequent: bool) -> pa.RecordBatch:
        new = (x[:, 0] != ref) & ((ref != x[:, 3]) | (q != x[:, 4]))
        cols = [x[new, 0], ref[new], x[new, 2].astype(np.int32), q[new].astype(np.int32)]
        return pa.RecordBatch.from_arrays([pa.array(c) for c in cols], ["doc_id", "ref", "p", "q"])

    return _paired(found.select("doc_id", "h", "p", "ref0", "q0", "more"), rows, "doc_id long, ref long, p int, q int")


def links(found: DataFrame) -> DataFrame:
    """(doc_id, ref, p, q) of ``found``, the rows of ``shared``, and of the runs of its
    frequent seeds (see above what stays)."""
    return first_links(found).unionByName(run_links(document_runs(found.where("frequent"))))


# --- Chains ------------------------------------------------------------------------

class _RankTree:
    """Largest (value, index) over a span of ranks, of anchors put and not yet
    taken out; anchors of one rank leave in the order they came."""

    def __init__(self, size: int):
        self.size = 1 << max(0, size - 1).bit_length()
        self.tree: list[tuple[float, int]] = [_NONE] * (2 * self.size)
        self.live: list[deque] = [deque() for _ in range(size)]  # per rank, values falling

    def _set(self, rank: int, entry: tuple[float, int]) -> None:
        n = rank + self.size
        self.tree[n] = entry
        while n > 1:
            n >>= 1
            self.tree[n] = max(self.tree[2 * n], self.tree[2 * n + 1])

    def put(self, rank: int, value: float, index: int) -> None:
        own = self.live[rank]
        while own and own[-1][0] <= value:
            own.pop()
        own.append((value, index))
        if len(own) == 1:
            self._set(rank, own[0])

    def take(self, rank: int, index: int) -> None:
        own = self.live[rank]
        if own and own[0][1] == index:
            own.popleft()
            self._set(rank, own[0] if own else _NONE)

    def best(self, lo: int, hi: int) -> tuple[float, int]:
        """Over ranks ``lo`` to ``hi - 1``."""
        out, lo, hi = _NONE, lo + self.size, hi + self.size
        while lo < hi:
            if lo & 1:
                out, lo = max(out, self.tree[lo]), lo + 1
            if hi & 1:
                hi -= 1
                out = max(out, self.tree[hi])
            lo, hi = lo >> 1, hi >> 1
        return out


def chains(a: np.ndarray, b: np.ndarray, k: int = K, cost: float = GAP_COST, max_gap: int = MAX_GAP) -> list[np.ndarray]:
    """Index lists of chains of one anchor or more; ``a`` ascending.  A chain
    rises strictly on both sides by ``max_gap + k`` words at most, adds ``k`` per
    anchor and pays ``cost`` per word between neighbours; chains are taken best
    first and share no anchor."""
    if not len(a):
        return []
    if len(np.unique(b - a)) == 1:  # one diagonal: the chain is the order itself
        return np.split(np.arange(len(a)), np.flatnonzero(np.diff(a) > max_gap) + 1)
    values = np.unique(b)
    rank, low = np.searchsorted(values, b), np.searchsorted(values, b - (max_gap + k))
    tree = _RankTree(len(values))
    score, back = [0.0] * len(a), [-1] * len(a)
    al, bl, rl, ll = a.tolist(), b.tolist(), rank.tolist(), low.tolist()
    put = old = 0  # anchors old..put-1 are in the tree: before this one in ``a`` and near enough
    for i in range(len(al)):
        while al[put] < al[i]:  # anchors at one position never follow each other
            tree.put(rl[put], score[put] + cost * (al[put] + bl[put]), put)
            put += 1
        while al[old] < al[i] - (max_gap + k):
            tree.take(rl[old], old)
            old += 1
        value, j = tree.best(ll[i], rl[i])
        gain = value - cost * (al[i] + bl[i])
        if j >= 0 and gain > 0:
            score[i], back[i] = k + gain, j
        else:
            score[i] = float(k)
    used, out = [False] * len(al), []
    for i in sorted(range(len(al)), key=lambda n: -score[n]):
        chain = []
        while i >= 0 and not used[i]:
            used[i] = True
            chain.append(i)
            i = back[i]
        if chain:
            out.append(np.array(chain[::-1]))
    return out


def thinned(x: np.ndarray, step: int = LONG) -> np.ndarray:
    """Anchors (doc_id, ref, a, b), sorted, each once and without those inside an
    unbroken diagonal run, of which every ``step``-th stays: the alignment reads
    all words between two anchors of a diagonal."""
    x = x[np.append(True, (np.diff(x, axis=0) != 0).any(axis=1))]
    on = (np.diff(x, axis=0) == (0, 0, 1, 1)).all(axis=1)
    inner = np.append(False, on) & np.append(on, False) & (x[:, 2] % step != 0)
    return x[~inner]


def bundles(a: np.ndarray, b: np.ndarray, margin: int = _MARGIN) -> list[np.ndarray]:
    """Index lists of single anchors of one document pair (``a`` ascending) whose
    surroundings overlap on both sides: repeats of a line all point to one place."""
    cell = b // (2 * margin)
    out = []
    for c in np.unique(cell):
        own = np.flatnonzero(cell == c)
        out += np.split(own, np.flatnonzero(np.diff(a[own]) > 2 * margin) + 1)
    return out


_CHAIN = "doc_id long, ref long, a array<int>, b array<int>, lone boolean"


def chained(found: DataFrame) -> DataFrame:
    """(doc_id, ref, a, b, lone): anchor positions of the chains of ``links``;
    single anchors near each other come as one row (``lone``)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def grouped(x: np.ndarray) -> pa.RecordBatch:
            x = thinned(x)
            new = np.append(True, (np.diff(x[:, :2], axis=0) != 0).any(axis=1))
            first = np.flatnonzero(new)
            size = np.diff(np.append(first, len(x)))
            turn = np.append(False, (np.diff(x[:, 3] - x[:, 2]) != 0) | (np.diff(x[:, 2]) > MAX_GAP)) & ~new
            plain = np.add.reduceat(turn, first, dtype=np.int64) == 0  # pairs of one chain on one diagonal
            picks, sizes, lone = [np.flatnonzero(np.repeat(plain, size))], size[plain].tolist(), (size[plain] == 1).tolist()
            for at, n in zip(first[~plain].tolist(), size[~plain].tolist()):
                part = x[at:at + n]
                all_of = chains(part[:, 2], part[:, 3])
                single = np.sort([c[0] for c in all_of if len(c) == 1]).astype(np.int64)
                near = [single[c] for c in bundles(part[single, 2], part[single, 3])]
                several = [c for c in all_of if len(c) > 1]
                picks += [at + c for c in several + near]
                sizes += map(len, several + near)
                lone += [False] * len(several) + [True] * len(near)
            pick, edges = np.concatenate(picks), np.append(0, np.cumsum(sizes)).astype(np.int32)
            sides = [pa.ListArray.from_arrays(pa.array(edges), pa.array(x[pick, n].astype(np.int32))) for n in (2, 3)]
            heads = x[pick[edges[:-1]]]
            return pa.RecordBatch.from_arrays([pa.array(heads[:, 0]), pa.array(heads[:, 1]), *sides, pa.array(lone, pa.bool_())],
                                              ["doc_id", "ref", "a", "b", "lone"])

        yield from map(grouped, whole_documents(batches, 2))

    ordered = found.repartition("doc_id", "ref").sortWithinPartitions("doc_id", "ref", "p", "q")
    return ordered.mapInArrow(run, _CHAIN)


# --- Alignment -----------------------------------------------------------------------

def agreement(x: np.ndarray, y: np.ndarray, a: np.ndarray, b: np.ndarray, k: int = K) -> np.ndarray:
    """For every word of ``x`` whether it agrees with its partner in ``y``, along
    the diagonals of the anchors (``a`` in ``x``, ``b`` in ``y``)."""
    same = np.zeros(len(x), bool)

    def along(lo: int, hi: int, shift: int) -> np.ndarray:
        out = np.zeros(max(0, hi - lo), bool)
        s, e = max(lo, -shift, 0), min(hi, len(y) - shift, len(x))
        if s < e:
            out[s - lo:e - lo] = x[s:e] == y[s + shift:e + shift]
        return out

    shift = b - a
    turn = np.flatnonzero(np.diff(shift)) + 1
    edges = np.concatenate([[0], turn, [len(a)]])
    for n in range(len(edges) - 1):  # anchors of one diagonal
        lo, hi = int(a[edges[n]]), int(a[edges[n + 1] - 1]) + k
        same[lo:hi] = along(lo, hi, int(shift[edges[n]]))
        if n:  # between two diagonals: the break point with the most agreement
            start, d0, d1 = int(a[edges[n] - 1]) + k, int(shift[edges[n] - 1]), int(shift[edges[n]])
            if start < lo:
                left, right = along(start, lo, d0), along(start, lo, d1)
                worth = np.append(0, np.cumsum(left)) + np.append(np.cumsum(right[::-1])[::-1], 0)
                cut = int(np.argmax(worth))
                same[start:lo] = np.concatenate([left[:cut], right[cut:]])
    first, last = int(a[0]), int(a[-1]) + k
    same[:first] = along(0, first, int(shift[0]))
    same[last:] = along(last, len(x), int(shift[-1]))
    return same


def segments(same: np.ndarray, identity: float = IDENTITY, least: int = MIN_SEGMENT, price: float = EDGE_PRICE,
             drop: float = _DROP) -> list[tuple[int, int, int]]:
    """(start, end, agreeing words) of stretches in which at least ``identity``
    of the words agree.  Where they end is decided by a score in which a
    disagreement costs ``price`` agreements; a stretch that agrees less as a
    whole gives the longest parts of it that agree enough."""
    edge = np.flatnonzero(np.diff(np.concatenate([[0], same.astype(np.int8), [0]])))
    out: list[tuple[int, int, int]] = []
    score = top = 0.0
    start = end = 0
    last = None

    def close() -> None:
        if end - start >= least:
            out.extend(_agreeing(same, start, end, identity, least))

    for lo, hi in zip(edge[::2].tolist(), edge[1::2].tolist()):
        if last is not None:
            score -= price * (lo - last)
            if score <= 0 or top - score >= drop:
                close()
                last = None
        if last is None:
            start, end, score, top = lo, lo, 0.0, 0.0
        score += hi - lo
        last = hi
        if score >= top:
            top, end = score, hi
    if last is not None:
        close()
    return out


def _agreeing(same: np.ndarray, start: int, end: int, identity: float, least: int) -> list[tuple[int, int, int]]:
    """Longest parts of a stretch in which ``identity`` of the words agree,
    longest first on either side of one already taken."""
    agree = int(np.count_nonzero(same[start:end]))
    if agree - identity * (end - start) >= -1e-6:
        return [(start, end, agree)]
    total = np.append(0, np.cumsum(same[start:end] - identity))
    out, rest = [], [(0, end - start)]
    while rest:
        lo, hi = rest.pop()
        if hi - lo < least:
            continue
        t = total[lo:hi + 1]
        after = np.maximum.accumulate(t[::-1])[::-1]  # highest total from here on: falls
        reach = np.searchsorted(-after, -(np.minimum.accumulate(t) - 1e-6), side="right") - 1
        size = np.where(t <= np.minimum.accumulate(t), reach - np.arange(len(t)), 0)
        i = int(np.argmax(size))
        if size[i] < least:
            continue
        inside = np.flatnonzero(same[start + lo + i:start + lo + i + int(size[i])]) + lo + i
        s, e = int(inside[0]), int(inside[-1]) + 1
        if e - s >= least:
            out.append((start + s, start + e, len(inside)))
        rest += [(lo, lo + i), (lo + i + int(size[i]), hi)]
    return sorted(out)


_PASSAGES = "array<struct<start_word:int,n_words:int,ref_doc_id:bigint,ref_start:int,identity:double>>"


def chain_segments(x: np.ndarray, y: np.ndarray, a: np.ndarray, b: np.ndarray) -> list[tuple[int, int, int, int]]:
    """(start, end, partner of the start, agreeing words) along one chain."""
    same = agreement(x, y, a, b)
    if same.sum() < IDENTITY * MIN_SEGMENT:
        return []
    found = []
    for s, e, n in segments(same):
        near = int(np.argmin(np.abs(a - s)))
        found.append((s, e, s + int(b[near] - a[near]), n))
    return found


def cover(found: list[tuple[int, int, int, int]]) -> list[tuple[int, int, int, int]]:
    """The fewest of the segments that cover the same words, and the longest one:
    repeats of a line give many that differ by a shift."""
    out: list[tuple[int, int, int, int]] = []
    reach, best = -1, None
    for g in sorted(found):
        if best is not None and g[0] > reach:
            out.append(best)
            reach, best = best[1], None
        if g[0] > reach:  # a gap: the next stretch starts here
            reach = g[0]
        if g[1] > reach and (best is None or g[1] > best[1]):
            best = g
    if best is not None:
        out.append(best)
    longest = max(found, key=lambda g: (g[1] - g[0], -g[2]), default=None)
    return out if longest is None or longest in out else [*out, longest]


def promising(x: np.ndarray, y: np.ndarray, at: np.ndarray, to: np.ndarray, x_span: np.ndarray, y_span: np.ndarray) -> np.ndarray:
    """For single anchors (``at`` in ``x``, ``to`` in ``y``, each inside its own
    ``span`` of start and end), whether the words around may hold a segment.

    A segment of 40 words or more that agrees enough has a half that does, so some
    part of under ``2 * MIN_SEGMENT`` words does; it has no more disagreements than
    the longest such part may have, and neither has any window inside it."""
    least = MIN_SEGMENT - int((1 - IDENTITY) * (2 * MIN_SEGMENT - 1) + 1e-6)
    out = np.zeros(len(at), bool)
    for part, same in _around(x, y, at, to, x_span, y_span):
        total = np.cumsum(np.pad(same, ((0, 0), (1, 0))), axis=1, dtype=np.int16)
        out[part] = (total[:, MIN_SEGMENT:] - total[:, :-MIN_SEGMENT]).max(axis=1) >= least
    return out


def _around(x: np.ndarray, y: np.ndarray, at: np.ndarray, to: np.ndarray, x_span: np.ndarray,
            y_span: np.ndarray) -> Iterator[tuple[slice, np.ndarray]]:
    """Blocks of anchors, and which words around each agree along its diagonal."""
    steps = np.arange(-_MARGIN, K + _MARGIN)
    low = np.maximum(x_span[:, 0] - at, y_span[:, 0] - to)
    high = np.minimum(x_span[:, 1] - at, y_span[:, 1] - to)
    for lo in range(0, len(at), 4096):
        part = slice(lo, lo + 4096)
        same = x.take(at[part, None] + steps, mode="clip") == y.take(to[part, None] + steps, mode="clip")
        yield part, same & (steps >= low[part, None]) & (steps < high[part, None])


def reaches(x: np.ndarray, y: np.ndarray, at: np.ndarray, to: np.ndarray, x_span: np.ndarray, y_span: np.ndarray) -> np.ndarray:
    """(first word, last word + 1), from each single anchor, between which all the
    ``segments`` around it lie; equal where there is none.

    A segment's words have a score over zero from its start and none of them lies
    above all that follow, whatever else closes segments."""
    out = np.zeros((len(at), 2), np.int64)
    for part, same in _around(x, y, at, to, x_span, y_span):
        total = np.cumsum(np.pad(np.where(same, 1, -EDGE_PRICE), ((0, 0), (1, 0))), axis=1)
        low = np.minimum.accumulate(total, axis=1)[:, :-1]
        high = np.maximum.accumulate(total[:, ::-1], axis=1)[:, -2::-1]
        may = np.cumsum(np.pad((total[:, 1:] > low) & (high >= total[:, :-1]), ((0, 0), (1, 0))), axis=1, dtype=np.int16)
        full = may[:, MIN_SEGMENT:] - may[:, :-MIN_SEGMENT] == MIN_SEGMENT
        some = full.any(axis=1)
        out[part, 0] = np.where(some, full.argmax(axis=1) - _MARGIN, 0)
        out[part, 1] = np.where(some, full.shape[1] - 1 - full[:, ::-1].argmax(axis=1) + MIN_SEGMENT - _MARGIN, 0)
    return out


_Stretch = tuple[int, int, tuple[int, int]]


def spread(own: list[_Stretch], s: int, e: int, ref: int) -> None:
    """Add a segment to the disjoint stretches that a document's segments cover,
    each with (words, -ref) of its longest segment."""
    i = j = bisect_left(own, s, key=lambda g: g[1])
    best = (e - s, -ref)
    while j < len(own) and own[j][0] <= e:
        s, e, best = min(s, own[j][0]), max(e, own[j][1]), max(best, own[j][2])
        j += 1
    own[i:j] = [(s, e, best)]


def settled(own: list[_Stretch], lo: int, hi: int, ref: int) -> bool:
    """No segment from ``lo`` to ``hi`` would add a word or name a passage."""
    i = bisect_right(own, lo, key=lambda g: g[0]) - 1
    return i >= 0 and hi <= own[i][1] and (hi - lo, -ref) < own[i][2]


def _bytes(c: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes of all values, borders) of a binary column."""
    edges = np.frombuffer(c.buffers()[1], np.int32)[c.offset:c.offset + len(c) + 1].astype(np.int64)
    return np.frombuffer(c.buffers()[2] or b"", np.uint8), edges


def document_segments(found: pa.Array, texts: pa.Array) -> list[list[dict]]:
    """Per document the segments of all its chains (ref, a, b, lone, y), ``texts``
    its signatures: one, or more where rows repeat an id."""
    rows = found.flatten()
    ref, lone = (rows.field(n).to_numpy(zero_copy_only=False) for n in ("ref", "lone"))
    of_chain = np.repeat(np.arange(len(found)), pc.list_value_length(found).to_numpy(zero_copy_only=False).astype(np.int64))
    sides = []
    for name in ("a", "b"):
        c = rows.field(name)
        size = pc.list_value_length(c).to_numpy(zero_copy_only=False).astype(np.int64)
        sides.append((c.flatten().to_numpy(zero_copy_only=False).astype(np.int64), np.append(0, np.cumsum(size))))
    (a, cut), (b, _) = sides
    chain = np.repeat(np.arange(len(rows)), np.diff(cut))
    low = np.minimum.reduceat(b, cut[:-1]) if len(b) else b
    b = b - np.maximum(0, low - _MARGIN)[chain]  # within the chain's own stretch
    y, y_cut = _bytes(rows.field("y"))
    x, x_cut = _bytes(texts.flatten())
    copies = pc.list_value_length(texts).to_numpy(zero_copy_only=False).astype(np.int64)
    first = np.append(0, np.cumsum(copies))
    out: list[list[dict]] = [[] for _ in range(len(found))]
    for n in range(int(copies.max(initial=0))):
        has = (copies > n)[of_chain]
        text = np.minimum(first[:-1] + n, len(x_cut) - 2)[of_chain]  # signature of each chain
        x_span, y_span = np.column_stack([x_cut[text], x_cut[text + 1]]), np.column_stack([y_cut[:-1], y_cut[1:]])
        look = np.zeros(len(a), bool)
        single = np.flatnonzero((lone & has)[chain])
        of = chain[single]
        look[single] = promising(x, y, x_span[of, 0] + a[single], y_span[of, 0] + b[single], x_span[of], y_span[of])
        # what cannot reach beyond the words covered so far is passed over, so the longest come first
        low_a, high_a = np.minimum.reduceat(a, cut[:-1]) if len(a) else a, np.maximum.reduceat(a, cut[:-1]) if len(a) else a
        start, end = np.maximum(0, low_a - _MARGIN), np.minimum(x_span[:, 1] - x_span[:, 0], high_a + K + _MARGIN)
        covered: list[list[_Stretch]] = [[] for _ in range(len(found))]
        todo = np.flatnonzero(has & ~lone)
        for c in todo[np.lexsort((ref[todo], low_a[todo] - high_a[todo]))].tolist():
            d, lo, hi, r = of_chain[c], int(start[c]), int(end[c]), int(ref[c])
            if settled(covered[d], lo, hi, r):
                continue
            own, b0 = slice(cut[c], cut[c + 1]), max(0, int(low[c]) - _MARGIN)
            for s, e, q, agree in chain_segments(x[x_span[c, 0] + lo:x_span[c, 0] + hi], y[y_span[c, 0]:y_span[c, 1]], a[own] - lo, b[own]):
                out[d].append({"ref": r, "s": s + lo, "e": e + lo, "q": max(0, q + b0), "same": agree})
                spread(covered[d], s + lo, e + lo, r)
        single = np.flatnonzero(look)
        of = chain[single]
        near = reaches(x, y, x_span[of, 0] + a[single], y_span[of, 0] + b[single], x_span[of], y_span[of])
        lone_found: dict[int, list[tuple[int, int, int, int]]] = {}
        for k in np.lexsort((a[single], ref[of], near[:, 0] - near[:, 1])).tolist():
            c, i, shift = int(of[k]), int(a[single[k]]), int(b[single[k]] - a[single[k]])
            d, lo, hi, r = of_chain[c], i + int(near[k, 0]), i + int(near[k, 1]), int(ref[c])
            if lo == hi or settled(covered[d], lo, hi, r):
                continue
            x0, y0, b0 = x_span[c, 0] + lo, y_span[c, 0] + lo + shift, max(0, int(low[c]) - _MARGIN)
            for s, e, agree in segments(x[x0:x0 + hi - lo] == y[y0:y0 + hi - lo]):
                lone_found.setdefault(c, []).append((s + lo, e + lo, max(0, s + lo + shift + b0), agree))
                spread(covered[d], s + lo, e + lo, r)
        for c, own_found in lone_found.items():
            out[of_chain[c]] += [{"ref": int(ref[c]), "s": s, "e": e, "q": q, "same": agree} for s, e, q, agree in cover(own_found)]
    return out


def aligned(found: DataFrame, sigs: DataFrame) -> DataFrame:
    """(doc_id, passages): a document's chains are aligned together, so one row
    per document comes out however many others it shares words with."""
    lo = lambda c: F.greatest(F.array_min(c) - _MARGIN, F.lit(0))
    hi = lambda c: F.array_max(c) + K + _MARGIN
    cut = lambda c: F.col("sig").substr(lo(c) + 1, hi(c) - lo(c))
    both = found.join(sigs.withColumnRenamed("doc_id", "ref"), "ref").select(
        "doc_id", F.struct("ref", "a", "b", "lone", cut("b").alias("y")).alias("c"))
    own = sigs.groupBy("doc_id").agg(F.collect_list("sig").alias("x"))
    both = both.groupBy("doc_id").agg(F.collect_list("c").alias("c")).join(own, "doc_id")

    @F.arrow_udf(_PASSAGES)
    def passages(chain: pa.Array, texts: pa.Array) -> pa.Array:
        kind = pa.list_(pa.struct([("start_word", pa.int32()), ("n_words", pa.int32()), ("ref_doc_id", pa.int64()),
                                   ("ref_start", pa.int32()), ("identity", pa.float64())]))
        return pa.array([m for lo in range(0, len(chain), 512) for m in map(
            joined, document_segments(chain.slice(lo, 512), texts.slice(lo, 512)))], kind)
    return both.select("doc_id", passages("c", "x").alias("passages")).where(F.size("passages") > 0)


def joined(found: list[dict], least: int = MIN_WORDS, gap: int = JOIN_GAP) -> list[dict]:
    """Passages from one document's segments: touching ones are one passage,
    named after its longest segment."""
    out: list[dict] = []
    group: list[dict] = []

    def close() -> None:
        if group and max(g["e"] for g in group) - group[0]["s"] >= least:
            best = max(group, key=lambda g: (g["e"] - g["s"], -g["ref"], -g["q"], g["same"]))
            out.append({"start_word": group[0]["s"], "n_words": max(g["e"] for g in group) - group[0]["s"],
                        "ref_doc_id": best["ref"], "ref_start": best["q"], "identity": best["same"] / (best["e"] - best["s"])})

    reach = 0
    for g in sorted(found, key=lambda g: (g["s"], -g["e"], g["ref"], g["q"])):
        if group and g["s"] > reach + gap:
            close()
            group = []
        reach = max(reach, g["e"]) if group else g["e"]
        group.append(g)
    close()
    return out


def passages_by_document(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, passages) of every document that repeats an earlier one."""
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).where(
        "doc_id is not null and text is not null")
    kept = Scratch(docs.sparkSession)
    several = kept.write(shared(seeds(texts)), "substring-shared")
    chain = kept.write(chained(links(several)), "substring-chains")
    kept.drop("substring-shared")
    out = kept.write(aligned(chain, kept.write(signatures(texts), "substring-signatures")), "substring-passages")
    kept.drop("substring-chains", "substring-signatures")
    return out


def repeated_passages(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per passage that repeats an earlier document's: doc_id,
    start_word, n_words, ref_doc_id, ref_start, identity.

    The earliest document (smallest id) of a passage is never listed for it.
    Null and empty texts, texts under ``MIN_WORDS`` words and rows without an id
    have no passages; rows that repeat an id count as one document; other columns
    are ignored; an empty table gives an empty result.
    """
    found = passages_by_document(docs, id_col, text_col)
    return found.select("doc_id", F.explode("passages").alias("m")).select(
        "doc_id", "m.start_word", "m.n_words", "m.ref_doc_id", "m.ref_start", "m.identity")


def cut_words(text: str, spans: list[tuple[int, int]]) -> str:
    """``text`` without the words of ``spans`` (start, count) and the blanks that
    follow them."""
    data = np.frombuffer(text.encode(), np.uint8)
    w = textops.words(data, np.array([0, len(data)]))
    keep = np.ones(len(data), bool)
    for start, count in spans:
        if start < len(w.start):
            stop = start + count
            keep[w.start[start]:w.start[stop] if stop < len(w.start) else len(data)] = False
    return data[keep].tobytes().decode()


def remove_repeats(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with every repeated passage cut from its text, except in the
    earliest document; a row whose text is used up goes.  ``n_chars``, where
    there is such a column, follows the new text; other columns stay."""
    found = passages_by_document(docs, id_col, text_col)
    key, spans = temp_name("id"), temp_name("spans")
    found = found.select(F.col("doc_id").alias(key), F.col("passages").alias(spans))
    # ids alone: far smaller than the texts, so rows without a passage seldom move
    ids = written(found.select(key), "substring-cut-ids")
    same_id = F.col(f"`{id_col}`").cast("long") == F.col(key)

    @F.arrow_udf("string")
    def without(texts: pa.Array, lists: pa.Array) -> pa.Array:
        return pa.array([t if t is None else cut_words(t, [(m["start_word"], m["n_words"]) for m in x])
                         for t, x in zip(texts.to_pylist(), lists.to_pylist())], pa.string())

    own = [F.col(f"`{c}`") for c in docs.columns]
    whole = docs.join(ids, same_id, "left_anti").select(*own)
    cut = docs.join(ids, same_id, "left_semi").join(found, same_id)
    cut = cut.withColumn(text_col, without(F.col(f"`{text_col}`"), F.col(spans)))
    cut = cut.where(F.col(f"`{text_col}`").isNull() | F.col(f"`{text_col}`").rlike(r"[^\x20\x09-\x0D]"))
    if "n_chars" in docs.columns:
        cut = cut.withColumn("n_chars", F.length(f"`{text_col}`").cast(docs.schema["n_chars"].dataType))
    return whole.unionByName(cut.select(*own))
