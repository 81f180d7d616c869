"""Benchmark decontamination by the CGK random-walk embedding.

Texts and items are sequences of lower-cased words.  A CGK walk reads a
sequence: at step ``j`` it outputs the word under its head and moves on by one
or stays, as a random bit of (walk, j, word) says, so that two sequences a few
edits apart soon read in step again and few outputs differ: edit distance
becomes Hamming distance.  A table samples the outputs of ``SAMPLES`` steps.
Items fall into length classes; a window starts (forward walks) or ends
(backward walks) at every word of a text and is as long as the items of the
class.  A window that agrees with an item in some table is a candidate, and its
exact word edit distance to the item decides.  The number of tables follows from
the target recall at the largest allowed distance.

Items are a stated query set: they are taken in blocks of bounded size, and each
block is held by every task while the documents pass by once, without a shuffle.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskweave.llm import textops

MAX_EDIT_SHARE = 0.2     # edits allowed, as a share of the item's words
MIN_ITEM_WORDS = 5       # shorter items are matched word for word
SAMPLES = 3
RECALL = 0.95
#: Share of CGK outputs taken to agree at the largest allowed distance.
AGREEMENT = 0.6
WALKS = 4                # every second one reads backward
CLASS_RATIO = 1.6
BLOCK_WORDS = 200_000    # item words per block
_CHUNK_BYTES = 1 << 19   # heads of a chunk stay in the processor's cache


def tables_per_walk(recall: float = RECALL, agreement: float = AGREEMENT, samples: int = SAMPLES, walks: int = WALKS) -> int:
    """Tables needed so that one collides with probability ``recall``."""
    return max(1, math.ceil(math.log(1 - recall) / math.log(1 - agreement ** samples) / walks))


def _bits(sym: np.ndarray, walk: int, block: int) -> np.ndarray:
    """64 random bits of each symbol, for steps 64*block .. 64*block+63."""
    return textops.mix(sym ^ np.uint64(0x9E37_0001 * (walk + 1) + 0x1_0000_0001 * (block + 1) << 16))


@dataclass
class Plan:
    """Sampled steps: ``steps[class][walk]`` is a list of sorted step tuples."""

    sizes: list[int]
    steps: list[list[list[tuple[int, ...]]]]

    @property
    def longest(self) -> int:
        return 1 + max(s[-1] for walks in self.steps for tabs in walks for s in tabs)


def plan(lengths: list[int], *, samples: int, walks: int, tables: int, ratio: float, seed: int = 10) -> Plan:
    """Length classes that hold items, and the sampled steps of their tables."""
    rng = np.random.default_rng(seed)
    bounds, sizes = [], []
    for n in sorted(set(lengths)):
        if not bounds or n >= bounds[-1] * ratio:
            bounds.append(n)
            sizes.append(n)
    out = []
    for size in sizes:
        span = max(samples, int(1.7 * size))  # the head reaches about 0.85 of the window
        out.append([[tuple(sorted(rng.choice(span, min(samples, span), replace=False).tolist())) for _ in range(tables)]
                    for _ in range(walks)])
    return Plan(sizes, out)


def item_keys(sym: np.ndarray, p: Plan, walk: int, c: int) -> list[tuple[np.uint64, np.uint64] | None]:
    """(first sampled output, key) of one item in each table of its class; None
    where the head leaves the item before the last sampled step."""
    outputs, i = [], 0
    for j in range(p.longest):
        if i >= len(sym):
            break
        outputs.append(sym[i])
        i += int(_bits(sym[i:i + 1], walk, j // 64)[0] >> np.uint64(j % 64)) & 1
    out = []
    for steps in p.steps[c][walk]:
        if steps[-1] >= len(outputs):
            out.append(None)
            continue
        key = np.array([outputs[steps[0]]])
        for s in steps[1:]:
            key = textops.mix(key + outputs[s])
        out.append((outputs[steps[0]], key[0]))
    return out


def scan(sym: np.ndarray, n: int, p: Plan, walk: int, table: dict) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(class, table, keys, starts) of the windows at the first ``n`` words whose
    first sampled output is some item's; the others cannot agree with any item.
    ``sym`` is padded for heads that run past the last word."""
    i = np.arange(n)
    low = (sym & np.uint64(_LOW)).astype(np.intp)
    due: dict[int, list[tuple[int, int]]] = {}
    left: dict[tuple[int, int], int] = {}
    for c, walks in enumerate(p.steps):
        for t, steps in enumerate(walks[walk]):
            if (walk, c, t) in table:
                left[c, t] = len(steps)
                for s in steps:
                    due.setdefault(s, []).append((c, t))
    alive: dict[tuple[int, int], tuple[np.ndarray, np.ndarray]] = {}
    moved = np.empty(n, np.uint8)
    for j in range(max(due, default=-1) + 1):
        if j % 64 == 0:
            bytes_ = _bits(sym, walk, j // 64).astype("<u8").view(np.uint8).reshape(-1, 8)
        if j % 8 == 0:
            byte = np.ascontiguousarray(bytes_[:, j % 64 // 8])
        if j in due:
            here = None
            for ct in due[j]:
                if ct not in alive:
                    if here is None:
                        here = np.take(low, i, mode="clip")
                    at = np.flatnonzero(np.take(table[(walk, *ct)].first, here, mode="clip"))
                    alive[ct] = at, sym[i[at]]
                else:
                    at, acc = alive[ct]
                    alive[ct] = at, textops.mix(acc + sym[i[at]])
                left[ct] -= 1
                if not left[ct]:
                    at, acc = alive.pop(ct)
                    yield *ct, acc, at
        np.take((byte >> np.uint8(j % 8)) & np.uint8(1), i, out=moved, mode="clip")
        i += moved


_LOW = (1 << 16) - 1


@dataclass
class Table:
    """``first``/``seen``: marks of the low bits of first outputs and keys of the
    items; ``keys`` sorted, ``owner`` the item of each."""

    first: np.ndarray
    seen: np.ndarray
    keys: np.ndarray
    owner: np.ndarray


@dataclass
class Items:
    """A block of items and its tables."""

    ids: list
    words: list[np.ndarray]
    plan: Plan
    cls: np.ndarray
    table: dict = field(default_factory=dict)  # (walk, class, table) -> Table
    short: dict = field(default_factory=dict)  # words -> (sorted run hashes, item of each)


def tokens(text: str | None) -> np.ndarray:
    data = np.frombuffer((text or "").encode(), np.uint8)
    return textops.word_hashes(textops.words(data, np.array([0, len(data)])), lower=True)


def build(ids: list, texts: list[str], *, samples: int = SAMPLES, walks: int = WALKS, recall: float = RECALL,
          ratio: float = CLASS_RATIO, min_words: int = MIN_ITEM_WORDS) -> Items | None:
    every = [(i, w) for i, w in zip(ids, map(tokens, texts)) if len(w)]
    found = [(i, w) for i, w in every if len(w) >= min_words]
    brief = [(i, w) for i, w in every if len(w) < min_words]
    if not every:
        return None
    lengths = [len(w) for _, w in found]
    p = plan(lengths, samples=samples, walks=walks, tables=tables_per_walk(recall, samples=samples, walks=walks), ratio=ratio)
    cls = np.searchsorted(p.sizes, lengths, side="right") - 1
    out = Items([i for i, _ in found + brief], [w for _, w in found + brief], p, cls)
    for size in sorted({len(w) for _, w in brief}):
        own = np.array([n for n in range(len(found), len(out.words)) if len(out.words[n]) == size])
        key = np.concatenate([run_keys(out.words[n], size) for n in own])
        order = np.argsort(key, kind="stable")
        out.short[size] = key[order], own[order]
    for walk in range(walks if found else 0):
        entries: dict[tuple[int, int], list[tuple[int, int, int]]] = {}
        for n, (_, w) in enumerate(found):
            for t, got in enumerate(item_keys(w[::-1] if walk % 2 else w, p, walk, cls[n])):
                if got:
                    entries.setdefault((cls[n], t), []).append((int(got[1]), n, int(got[0])))
        for (c, t), found_keys in entries.items():
            found_keys.sort()
            key = np.array([k for k, _, _ in found_keys], np.uint64)
            first, seen = np.zeros(_LOW + 1, bool), np.zeros(_LOW + 1, bool)
            first[[f & _LOW for _, _, f in found_keys]] = True
            seen[(key & np.uint64(_LOW)).astype(np.intp)] = True
            out.table[walk, c, t] = Table(first, seen, key, np.array([n for _, n, _ in found_keys]))
    return out


def run_keys(sym: np.ndarray, size: int) -> np.ndarray:
    """A hash of every run of ``size`` words."""
    n = max(0, len(sym) - size + 1)
    key = np.zeros(n, np.uint64)
    for j in range(size):
        key = textops.mix(key + sym[j:j + n])
    return key


def short_matches(items: Items, sym: np.ndarray, first: np.ndarray) -> dict[tuple[int, int], tuple[int, int, int]]:
    """(row, item) -> (0, start, end) of the first exact match of short items."""
    out: dict[tuple[int, int], tuple[int, int, int]] = {}
    row = np.repeat(np.arange(len(first) - 1), np.diff(first))
    for size, (keys, owner) in items.short.items():
        key = run_keys(sym, size)
        lo, hi = np.searchsorted(keys, key, "left"), np.searchsorted(keys, key, "right")
        at = np.flatnonzero((hi > lo) & (row[:len(key)] == row[size - 1:size - 1 + len(key)]))
        pairs, seen = np.unique(np.column_stack([row[at], lo[at]]), axis=0, return_index=True)
        for (r, a), k in zip(pairs.tolist(), at[seen].tolist()):  # once for each row and run, however often it comes
            for item in owner[a:hi[k]].tolist():
                start = k - int(first[r])
                out[r, item] = 0, start, start + size
    return out


def edit_distance(item: np.ndarray, text: np.ndarray) -> tuple[int, int, int]:
    """(edits, start, end) of the best match of ``item`` inside ``text``; the
    text's words before and after the match are free."""
    n = len(text)
    at = np.arange(n + 1)
    cost, start = np.zeros(n + 1, np.int64), at.copy()
    big = n + len(item) + 2
    for k, w in enumerate(item, 1):
        up, diag = cost + 1, np.append(k, cost[:-1] + (text != w))
        new_start = np.where(diag <= up, np.append(0, start[:-1]), start)
        new = np.minimum(up, diag)
        packed = (new - at) * big + new_start  # running best over insertions of text words
        best = np.minimum.accumulate(packed)
        cost, start = best // big + at, best % big
    end = int(np.argmin(cost))
    return int(cost[end]), int(start[end]), end


def matches(items: Items, sym: np.ndarray, first: np.ndarray, share: float) -> dict[tuple[int, int], tuple[int, int, int]]:
    """(row, item) -> (edits, start, end) of the best verified match, words
    counted within the row.  ``first``: each row's first word in ``sym``."""
    n = len(sym)
    pad = np.zeros(items.plan.longest + 2 if items.plan.steps else 0, np.uint64)
    candidates: set[tuple[int, int]] = set()  # (item, approximate start)
    for walk in range(len(items.plan.steps[0]) if items.plan.steps else 0):
        back = walk % 2 == 1
        for c, t, key, at in scan(np.concatenate([sym[::-1] if back else sym, pad]), n, items.plan, walk, items.table):
            own = items.table[walk, c, t]
            hit = own.seen[(key & np.uint64(_LOW)).astype(np.intp)]
            key, at = key[hit], at[hit]
            lo, hi = np.searchsorted(own.keys, key, "left"), np.searchsorted(own.keys, key, "right")
            for a, x, y in zip(at[hi > lo].tolist(), lo[hi > lo].tolist(), hi[hi > lo].tolist()):
                for item in own.owner[x:y].tolist():
                    candidates.add((item, n - a - len(items.words[item]) if back else a))
    best = short_matches(items, sym, first)
    done: set[tuple[int, int, int]] = set()
    for item, a in sorted(candidates):
        w = items.words[item]
        most = int(share * len(w))
        row = int(np.searchsorted(first, min(max(a, 0), n - 1), side="right")) - 1
        for r in {row, int(np.searchsorted(first, min(max(a + len(w) - 1, 0), n - 1), side="right")) - 1}:
            lo, hi = max(int(first[r]), a - most), min(int(first[r + 1]), a + len(w) + most)
            if hi - lo < len(w) - most or (r, item, lo) in done:
                continue
            done.add((r, item, lo))
            inner = a - lo
            if a >= lo and a + len(w) <= hi and np.array_equal(sym[a:a + len(w)], w):
                found = (0, inner, inner + len(w))
            else:
                if best.get((r, item), (most + 1,))[0] == 0:
                    continue
                if len(w) - np.isin(w, sym[lo:hi]).sum() > most:  # each word that is not there costs an edit
                    continue
                found = edit_distance(w, sym[lo:hi])
            found = (found[0], found[1] + lo - int(first[r]), found[2] + lo - int(first[r]))
            if found[0] <= most and found < best.get((r, item), (most + 1, 0, 0)):
                best[r, item] = found
    return best


def match_column(items: Items, text: Column, item_type: str = "bigint", share: float = MAX_EDIT_SHARE) -> Column:
    """Per text, the array of matched items: (item_id, start_word, n_words, edits)."""
    shared = items

    @F.arrow_udf(f"array<struct<item_id:{item_type},start_word:int,n_words:int,edits:int>>")
    def leaks(texts: pa.Array) -> pa.Array:
        out: list[list[dict]] = [[] for _ in range(len(texts))]
        for lo, hi, data, off in textops.chunks(texts, _CHUNK_BYTES):
            w = textops.words(data, off)
            if len(w.start) == 0:
                continue
            for (r, n), (edits, a, b) in sorted(matches(shared, textops.word_hashes(w, lower=True), w.first, share).items()):
                out[lo + r].append({"item_id": shared.ids[n], "start_word": a, "n_words": b - a, "edits": edits})
        return pa.array(out, pa.list_(pa.struct([("item_id", pa.string() if item_type == "string" else pa.int64()),
                                                 ("start_word", pa.int32()), ("n_words", pa.int32()), ("edits", pa.int32())])))
    return leaks(text)


def item_blocks(benchmark: DataFrame, item_col: str, text_col: str, block_words: int = BLOCK_WORDS, **options) -> Iterator[Items]:
    """The items in blocks of about ``block_words`` words, one block at a time."""
    ids, texts, size = [], [], 0
    rows = benchmark.select(F.col(item_col).alias("i"), F.col(text_col).alias("t")).where("i is not null and t is not null")
    for r in rows.toLocalIterator():
        ids.append(r["i"])
        texts.append(r["t"])
        size += 1 + len(r["t"]) // 5
        if size >= block_words:
            block = build(ids, texts, **options)
            ids, texts, size = [], [], 0
            if block:
                yield block
    block = build(ids, texts, **options) if ids else None
    if block:
        yield block


def contamination(docs: DataFrame, benchmark: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
                  item_col: str = "item_id", item_text_col: str = "text", share: float = MAX_EDIT_SHARE, **options) -> DataFrame:
    """One row per (document, matched item): doc_id, item_id, start_word,
    n_words, edits (the match with the fewest edits, the earliest on a tie).

    Null and empty texts match nothing; items with fewer than ``MIN_ITEM_WORDS``
    words match word for word only; items without words match nothing; repeated document rows are returned as
    often as they come and repeated items once per row of the benchmark; other
    columns are ignored; empty tables give an empty result.
    """
    kind = benchmark.schema[item_col].dataType.simpleString()
    kind = "string" if kind == "string" else "bigint"
    out = None
    for block in item_blocks(benchmark, item_col, item_text_col, **options):
        part = docs.select(F.col(id_col).alias("doc_id"), F.explode(match_column(block, F.col(text_col), kind, share)).alias("m"))
        out = part if out is None else out.unionByName(part)
    if out is None:
        out = docs.select(F.col(id_col).alias("doc_id"), F.explode(F.array().cast(
            f"array<struct<item_id:{kind},start_word:int,n_words:int,edits:int>>")).alias("m"))
    return out.select("doc_id", "m.item_id", "m.start_word", "m.n_words", "m.edits")


def clean(docs: DataFrame, benchmark: DataFrame, *, text_col: str = "text", item_col: str = "item_id",
          item_text_col: str = "text", share: float = MAX_EDIT_SHARE, **options) -> DataFrame:
    """The rows of ``docs`` whose text matches no item, with their own columns."""
    for block in item_blocks(benchmark, item_col, item_text_col, **options):
        kind = "string" if isinstance(block.ids[0], str) else "bigint"
        docs = docs.where(F.size(match_column(block, F.col(text_col), kind, share)) == 0)
    return docs
