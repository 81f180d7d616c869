"""Document fingerprints from improbable features.

A feature is a window of ``FEATURE`` bytes.  Its rarity is that of its entropy:
the entropies of all windows of all documents are counted, and a window whose
entropy level is rarer is preferred (levels under ``WEAK`` come last whatever
their count: runs of one byte are rare and say nothing).  A feature is selected
when it is the most improbable one, the leftmost of equals, in at least ``WINS``
of the ``AREA`` neighbourhoods of ``AREA`` windows that hold it.  The selected
features of a text, repeats left out, go in text order into a chain of Bloom
filters of ``FILTER_BITS`` bits, ``PER_FILTER`` features each.

Two fingerprints are compared filter by filter: the bits that two filters
share, less what filters of so many bits share by chance, over the most they
could share.  Each filter of the shorter chain takes its best match; the mean
is weighted by set bits.  Equal texts have equal fingerprints.
"""

from __future__ import annotations

import base64
import functools
import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskweave.llm import textops
from riskweave.llm.common import importable, thinned

FEATURE, AREA, WINS = 32, 32, 8
LEVELS, WEAK = 1024, 1.5
FILTER_BITS, HASHES, PER_FILTER = 2048, 5, 160
#: Shared bits up to so many standard deviations above chance count as chance.
NOISE = 2.0
#: Rows in a range of ids, ranges at most, and sampled ids for each border.
RANGE_ROWS, MAX_RANGES, SAMPLED = 512, 65536, 8
CHUNK_BYTES = 1 << 18

_SHIFT = 14
_BYTES = FILTER_BITS // 8
_BITS = int(math.log2(FILTER_BITS))


def _entropy_terms() -> np.ndarray:
    """c * log2(c) in whole numbers; a window of one repeated byte has LEVELS << _SHIFT."""
    c = np.arange(FEATURE + 1)
    terms = c * np.log2(np.maximum(c, 1))
    return np.rint(terms * ((LEVELS << _SHIFT) / terms[-1])).astype(np.int64)


_TERMS = _entropy_terms()
_STEP = np.diff(_TERMS)


def levels(data: np.ndarray) -> np.ndarray:
    """Entropy level (0 to LEVELS) of the window that starts at each byte."""
    n = len(data)
    if n < FEATURE:
        return np.zeros(0, np.int64)
    before, after = np.zeros(n, np.uint8), np.zeros(n, np.uint8)
    for lag in range(1, FEATURE):
        same = (data[lag:] == data[:-lag]).view(np.uint8)
        before[lag:] += same
        after[:-lag] += same
    total = np.empty(n - FEATURE + 1, np.int64)
    total[0] = _TERMS[np.bincount(data[:FEATURE])].sum()
    # a byte that leaves had 1 + after in its window, one that enters finds before
    np.subtract(_STEP[before[FEATURE:]], _STEP[after[:n - FEATURE]], out=total[1:])
    np.cumsum(total, out=total)
    return ((LEVELS << _SHIFT) - total) >> _SHIFT


def inside(off: np.ndarray) -> np.ndarray:
    """True where a window that starts there lies in one row."""
    n = int(off[-1])
    room = np.repeat(off[1:], np.diff(off)) - np.arange(n)
    return (room >= FEATURE)[:max(0, n - FEATURE + 1)]


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    count = np.zeros(LEVELS + 1, np.int64)
    for b in batches:
        for _, _, data, off in textops.chunks(b.column(0), CHUNK_BYTES):
            count += np.bincount(levels(data)[inside(off)], minlength=LEVELS + 1)
    at = np.flatnonzero(count)
    yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(count[at])], ["level", "n"])


def rarity(texts: DataFrame) -> np.ndarray:
    """Rank of every entropy level, 0 the most improbable, from all windows of
    the one column of ``texts``; levels that do not occur come first of all."""
    importable(texts.sparkSession)
    count = np.zeros(LEVELS + 1, np.int64)
    for r in texts.mapInArrow(_counted, "level int, n long").groupBy("level").agg(F.sum("n").alias("n")).collect():
        count[r["level"]] = r["n"]
    weak = np.arange(LEVELS + 1) < WEAK * LEVELS / math.log2(FEATURE)
    rank = np.empty(LEVELS + 1, np.int64)
    rank[np.lexsort((np.arange(LEVELS + 1), count, weak))] = np.arange(LEVELS + 1)
    return rank


def selected(data: np.ndarray, off: np.ndarray, rank: np.ndarray) -> np.ndarray:
    """Start bytes of the selected features of all rows.

    Neighbourhoods are cut at the ends of a row; as AREA is no more than FEATURE,
    none holds windows of two rows."""
    ok = inside(off)
    if not ok.any():
        return np.zeros(0, np.int64)
    n = len(ok)
    worst = np.iinfo(np.int64).max
    key = np.full(n + 2 * (AREA - 1), worst, np.int64)
    key[AREA - 1:AREA - 1 + n] = np.where(ok, (rank[levels(data)] << 40) + np.arange(n), worst)
    wide = 1
    while wide < AREA:
        step = min(wide, AREA - wide)
        key = np.minimum(key[:-step], key[step:])
        wide += step
    won = key[key < worst] & ((1 << 40) - 1)
    return np.flatnonzero(np.bincount(won, minlength=n) >= WINS)


def _hashed(parts: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each row of FEATURE bytes."""
    words = np.ascontiguousarray(parts).view("<u8")
    h = np.full(len(words), FEATURE, np.uint64)
    for k in range(words.shape[1]):
        h = textops.mix(h * np.uint64(0x9E3779B97F4A7C15) + words[:, k])
    return h


def features(data: np.ndarray, off: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, hash) of the features of every row in text order, repeats left out.
    A text shorter than a window is one feature, an empty text has none."""
    at = selected(data, off, rank)
    row = np.searchsorted(off, at, side="right") - 1
    h = _hashed(np.lib.stride_tricks.sliding_window_view(data, FEATURE)[at]) if len(at) else np.zeros(0, np.uint64)
    size = np.diff(off)
    short = np.flatnonzero((size > 0) & (size < FEATURE))
    if len(short):
        padded = np.zeros((len(short), FEATURE), np.uint8)
        for k, r in enumerate(short):
            padded[k, :size[r]] = data[off[r]:off[r + 1]]
        row = np.concatenate([row, short])
        h = np.concatenate([h, textops.mix(_hashed(padded) + size[short].astype(np.uint64))])
        by = np.argsort(row, kind="stable")
        row, h = row[by], h[by]
    by = np.lexsort((h, row))
    first = np.ones(len(by), bool)
    first[1:] = (row[by][1:] != row[by][:-1]) | (h[by][1:] != h[by][:-1])
    keep = np.sort(by[first])
    return row[keep], h[keep]


def filters(data: np.ndarray, off: np.ndarray, rank: np.ndarray) -> list[np.ndarray]:
    """The chain of filters of every row, one filter a row of bytes."""
    row, h = features(data, off, rank)
    count = np.bincount(row, minlength=len(off) - 1)
    number = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
    chain = -(-count // PER_FILTER)
    first = np.concatenate([[0], np.cumsum(chain)])
    base = (first[row] + number // PER_FILTER) * FILTER_BITS
    bits = np.zeros(int(first[-1]) * FILTER_BITS, bool)
    for k in range(HASHES):
        bits[base + ((h >> np.uint64(k * _BITS)) & np.uint64(FILTER_BITS - 1)).astype(np.int64)] = True
    packed = np.packbits(bits).reshape(-1, _BYTES)
    return [packed[a:b] for a, b in zip(first[:-1], first[1:], strict=True)]


def fingerprints_of(texts: list[str], rank: np.ndarray) -> list[np.ndarray]:
    out: list[np.ndarray] = []
    for _, _, data, off in textops.chunks(pa.array(texts, pa.large_string()), CHUNK_BYTES):
        out += filters(data, off, rank)
    return out


def written_as(chain: np.ndarray) -> str:
    return base64.b64encode(chain.tobytes()).decode()


def read_back(fingerprint: str) -> np.ndarray:
    return np.frombuffer(base64.b64decode(fingerprint), np.uint8).reshape(-1, _BYTES)


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """0 to 1; two empty fingerprints are alike, an empty one is like no other."""
    if not len(a) or not len(b):
        return float(len(a) == len(b))
    if len(a) != len(b):
        return _covered(a, b) if len(a) < len(b) else _covered(b, a)
    return (_covered(a, b) + _covered(b, a)) / 2


def _covered(a: np.ndarray, b: np.ndarray) -> float:
    set_a = np.bitwise_count(a).sum(axis=1, dtype=np.int64).astype(float)
    set_b = np.bitwise_count(b).sum(axis=1, dtype=np.int64).astype(float)
    best = np.empty(len(a))
    wide_b = np.ascontiguousarray(b).view(np.uint64)
    for k, one in enumerate(np.ascontiguousarray(a).view(np.uint64)):
        shared = np.bitwise_count(one & wide_b).sum(axis=1, dtype=np.int64)
        chance = set_a[k] * set_b / FILTER_BITS
        chance += NOISE * np.sqrt(chance * (FILTER_BITS - set_a[k]) * (FILTER_BITS - set_b) / (FILTER_BITS * (FILTER_BITS - 1.0)))
        most = np.minimum(set_a[k], set_b)
        over = np.maximum(0.0, shared - chance) / np.maximum(1e-9, most - chance)
        best[k] = np.where(shared == most, 1.0, np.minimum(over, 1.0)).max()
    return float((best * set_a).sum() / set_a.sum())


# --- documents --------------------------------------------------------------------

def _printed(batches: Iterator[pa.RecordBatch], rank: np.ndarray) -> Iterator[pa.RecordBatch]:
    for b in batches:
        found = []
        for _, _, data, off in textops.chunks(b.column("text"), CHUNK_BYTES):
            found += [written_as(c) for c in filters(data, off, rank)]
        yield pa.RecordBatch.from_arrays([b.column("id"), pa.array(found, pa.string())], ["id", "fingerprint"])


def fingerprints(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id, fingerprint.  A null text is empty; an empty
    text has an empty fingerprint; other columns are ignored."""
    rank = rarity(docs.select(text_col))
    given = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    schema = T.StructType([given.schema["id"], T.StructField("fingerprint", T.StringType())])
    return given.mapInArrow(functools.partial(_printed, rank=rank), schema).withColumnRenamed("id", id_col)


def edited(text: str, following: str) -> str:
    """``text`` with its last floor(n / 2) code points replaced by the first as
    many of ``following``."""
    half = len(text) // 2
    return text[:len(text) - half] + following[:half]


RESULT = ("n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
          "near_edited double, near_next double")


def _compared(batches: Iterator[pa.RecordBatch], rank: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Sorted rows of whole ranges: each row against the one after it in its
    range; the copied first row of the next range ends a range."""
    last: tuple | None = None  # range, id, text, fingerprint of the row before
    for b in batches:
        texts = b.column("text")
        for lo, hi, data, off in textops.chunks(texts, CHUNK_BYTES):
            own = filters(data, off, rank)
            part = b.slice(lo, hi - lo)
            rows = list(zip(part.column("range").to_pylist(), part.column("id").to_pylist(),
                            part.column("text").to_pylist(), own, strict=True))
            pairs = []
            for row in rows:
                if last is not None and last[0] == row[0]:
                    pairs.append((last, row))
                last = row
            changed = [edited(a[2], b[2]) for a, b in pairs]
            prints = fingerprints_of(changed, rank)
            yield pa.RecordBatch.from_arrays([
                pa.array([a[1] for a, _ in pairs], b.schema.field("id").type), pa.array([len(a[2]) for a, _ in pairs], pa.int64()),
                pa.array([hashlib.sha256(t.encode()).hexdigest() for t in changed], pa.string()),
                pa.array([written_as(a[3]) for a, _ in pairs], pa.string()), pa.array([written_as(p) for p in prints], pa.string()),
                pa.array([likeness(a[3], p) for (a, _), p in zip(pairs, prints, strict=True)], pa.float64()),
                pa.array([likeness(a[3], n[3]) for a, n in pairs], pa.float64())],
                ["id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"])


def borders(ids: DataFrame, range_rows: int, max_ranges: int) -> np.ndarray:
    """Sorted ids that cut the table into ranges of about ``range_rows`` rows;
    a hash-chosen sample of bounded size places them, which changes the balance
    of the ranges only."""
    n = ids.count()
    ranges = min(max_ranges, -(-n // range_rows))
    if ranges < 2:
        return np.zeros(0, np.int64)
    drawn = np.array(sorted({r["id"] for r in ids.where(thinned("id", 11, SAMPLED * ranges // 2, n)).collect()}), np.int64)
    return drawn[np.linspace(0, len(drawn) - 1, min(len(drawn), ranges)).astype(np.int64)][1:] if len(drawn) > 1 else drawn[:0]


def edited_fingerprints(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
                        range_rows: int = RANGE_ROWS, max_ranges: int = MAX_RANGES) -> DataFrame:
    """One row per document: id, n_chars, edited_sha256, fingerprint,
    edited_fingerprint, near_edited (likeness to the edited text's fingerprint),
    near_next (to the next document's).

    The next document is the one of the next id, after the last the first.  A
    null text is empty; an empty text has an empty fingerprint and its edit is
    empty.  Rows without an id come first; rows that repeat an id follow one
    another in the order of a hash of their text, so equal rows get equal
    results except the last of them.  A table of one document has itself for
    the next one, an empty table gives an empty result, other columns are
    ignored.  Texts are taken whole, whatever their length.

    Texts are shuffled once, by ranges of ids and sorted in them; the first row
    of each range is copied to the range before.  A row waits only for the row
    after it, so memory follows the longest two texts.
    """
    importable(docs.sparkSession)
    rank = rarity(docs.select(text_col))
    text = F.coalesce(F.col(text_col), F.lit(""))
    given = docs.select(F.col(id_col).cast("long").alias("id"), text.alias("text"))
    cuts = borders(given.where("id is not null").select("id"), range_rows, max_ranges)

    @F.pandas_udf("int")
    def ranged(ids: pd.Series) -> pd.Series:
        at = np.searchsorted(cuts, ids.fillna(0).to_numpy(np.int64) if ids.hasnans else ids.to_numpy(), side="right")
        return pd.Series(np.where(ids.isna(), 0, at).astype(np.int32))

    order = F.xxhash64("text")
    rows = given.select(ranged("id").alias("range"), F.lit(0).alias("copied"), "id", "text")
    first = given.orderBy(F.asc_nulls_first("id"), order, "text").limit(1).select(
        F.lit(len(cuts)).alias("range"), F.lit(1).alias("copied"), "id", "text")
    starts = given.where(F.col("id").isin([int(c) for c in cuts])) if len(cuts) else given.where("false")
    starts = starts.groupBy("id").agg(F.min_by("text", F.struct(order, "text")).alias("text"))
    starts = starts.select((ranged("id") - 1).alias("range"), F.lit(1).alias("copied"), "id", "text")
    dealt = (rows.unionByName(starts).unionByName(first).repartition("range")
             .sortWithinPartitions("range", "copied", F.asc_nulls_first("id"), order, "text").select("range", "id", "text"))
    schema = T.StructType([T.StructField("id", T.LongType()), *T.StructType.fromDDL(RESULT)])
    return dealt.mapInArrow(functools.partial(_compared, rank=rank), schema).withColumnRenamed("id", id_col)
