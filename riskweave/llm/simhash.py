"""SimHash near-duplicate detection with covering locality-sensitive hashing.

Fingerprint: A-Z lower-cased, words are runs outside ``[\\x20\\x09-\\x0D]``,
shingles of ``shingle`` words joined by one space (repeats included); a text
with fewer words has its whole word sequence as its only shingle and a text
without words (null and empty texts too) has fingerprint 0.  Each shingle is
hashed by XXH64 (seed 42) and a fingerprint bit is 1 if set in more than half
of the hashes.

Pairs within ``radius`` bits: every bit position gets one of the nonzero
vectors of GF(2)^(radius+1); table ``m`` keeps the bits whose vector has odd
inner product with ``m``.  Any ``radius`` differing positions have a common
orthogonal ``m``, so each pair within the radius agrees on all kept bits of
some table: no pair is missed.  Only distinct fingerprints enter the tables.
A bucket of up to ``dense`` fingerprints is joined with itself on the bucket
key; in a larger one a fingerprint is sent once per pair of dropped bits, to
the group that agrees everywhere else, which has four members at most
(``radius`` 2; linear in the bucket and just as exact).
"""

from __future__ import annotations

import itertools

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskweave.llm import textops
from riskweave.llm.common import written
from riskweave.llm.components import connected_components

SHINGLE_WORDS = 3
RADIUS = 2
DENSE_BUCKET = 4096
_SEED = 42


def _fingerprints(texts: pa.Array, shingle: int) -> np.ndarray:
    out = np.zeros(len(texts), np.uint64)
    for lo, hi, data, off in textops.chunks(texts):
        w = textops.words(data, off)
        if len(w.start) == 0:
            continue
        # one space between words: keep word bytes and the first space after a word
        inside = ~textops._SPACE[data]
        keep = inside.copy()
        keep[1:] |= inside[:-1]
        at = np.cumsum(keep)
        flat = np.where(inside, textops.LOWER[data], np.uint8(0x20))[keep].tobytes()
        start, end = at[w.start] - 1, at[w.end - 1]
        count = w.count
        rows = np.flatnonzero(count)
        n = np.maximum(count[rows] - shingle + 1, 1)
        seg = np.concatenate([[0], np.cumsum(n)])
        first = np.repeat(w.first[rows] - seg[:-1], n) + np.arange(seg[-1])
        last = np.minimum(first + shingle, np.repeat(w.first[rows] + count[rows], n)) - 1
        digest = xxhash.xxh64_intdigest
        h = np.fromiter((digest(flat[a:b], _SEED) for a, b in zip(start[first].tolist(), end[last].tolist())),
                        np.uint64, len(first))
        for a in range(0, len(rows), 256):  # bounded bit matrix
            b = min(len(rows), a + 256)
            out[lo + rows[a:b]] = _majority(h[seg[a]:seg[b]], seg[a:b + 1] - seg[a])
    return out


def _majority(h: np.ndarray, seg: np.ndarray, block: int = 1 << 16) -> np.ndarray:
    """64-bit majority of each segment of ``h``."""
    ones = np.zeros((len(seg) - 1, 64), np.int64)
    for a in range(0, len(h), block):
        b = min(len(h), a + block)
        bits = np.unpackbits(h[a:b].astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        s0 = int(np.searchsorted(seg, a, side="right")) - 1
        s1 = int(np.searchsorted(seg, b, side="left"))
        ones[s0:s1] += np.add.reduceat(bits, np.maximum(seg[s0:s1] - a, 0), axis=0, dtype=np.int64)
    bits = (2 * ones > np.diff(seg)[:, None]).astype(np.uint8)
    return np.packbits(bits, axis=1, bitorder="little").view("<u8").ravel().astype(np.uint64)


def fingerprint_column(text: str = "text", shingle: int = SHINGLE_WORDS):
    """64-bit fingerprint of a text column, as a signed long."""
    @F.arrow_udf("long")
    def fingerprint(texts: pa.Array) -> pa.Array:
        return pa.array(_fingerprints(texts, shingle).view(np.int64))
    return fingerprint(F.col(text))


def digits(fp):
    """A fingerprint as 16 hex digits."""
    return F.lpad(F.lower(F.hex(fp)), 16, "0")


def covering_masks(radius: int = RADIUS, bits: int = 64) -> list[int]:
    """Bit masks (as signed 64-bit) such that any ``radius`` positions are all
    cleared in at least one of them."""
    vectors = 2 ** (radius + 1) - 1
    masks = []
    for m in range(1, vectors + 1):
        mask = sum(1 << p for p in range(bits) if bin((p % vectors + 1) & m).count("1") % 2)
        masks.append(mask - (1 << 64) if mask >> 63 else mask)
    return masks


def _signed(x: int) -> int:
    x &= (1 << 64) - 1
    return x - (1 << 64) if x >> 63 else x


def fingerprint_links(nodes: DataFrame, radius: int = RADIUS, dense: int = DENSE_BUCKET) -> DataFrame:
    """Links (u, v), u < v, between distinct fingerprints ``nodes(fp)`` that are
    within ``radius`` bits and enough to connect all that are."""
    masks = covering_masks(radius)
    keyed = nodes.select("fp", F.explode(F.array(*[
        F.struct(F.lit(t).alias("tab"), F.col("fp").bitwiseAND(F.lit(m)).alias("key"))
        for t, m in enumerate(masks)])).alias("b")).select("fp", "b.tab", "b.key")
    sizes = keyed.groupBy("tab", "key").agg(F.count("*").alias("n")).where("n > 1")
    bucketed = written(keyed.join(written(sizes, "simhash-buckets"), ["tab", "key"]), "simhash-keyed")

    small = bucketed.where(F.col("n") <= dense)
    a = small.select("tab", "key", F.col("fp").alias("u"))
    b = small.select("tab", "key", F.col("fp").alias("v"))
    near = a.join(b, ["tab", "key"]).where(
        (F.col("u") < F.col("v")) & (F.bit_count(F.col("u").bitwiseXOR(F.col("v"))) <= radius)).select("u", "v")

    large = bucketed.where(F.col("n") > dense)
    if radius < 1 or large.isEmpty():
        return near
    drops = F.array(*[F.array(*[F.lit(_signed(~sum(1 << p for p in c))) for c in itertools.combinations(
        [p for p in range(64) if not m >> p & 1], radius)]) for m in masks])
    groups = (large.select("fp", F.explode(F.element_at(drops, F.col("tab") + 1)).alias("drop"))
              .groupBy("drop", F.col("fp").bitwiseAND(F.col("drop")).alias("rest"))
              .agg(F.collect_set("fp").alias("fps")).where(F.size("fps") > 1))
    star = (groups.select(F.array_min("fps").alias("u"), F.explode("fps").alias("v")).where("u <> v"))
    return near.unionByName(star)


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *,
                    shingle: int = SHINGLE_WORDS, radius: int = RADIUS,
                    dense: int = DENSE_BUCKET, labels_too: bool = False) -> DataFrame:
    """One row per document: doc_id, fingerprint (16 hex digits), component_id,
    and with ``labels_too`` label, which no two components share.

    ``component_id`` is the smallest id reachable over links of at most
    ``radius`` differing bits.  Null and empty texts have fingerprint 0 and link
    like any other.  Rows without an id get a component but cannot name one (a
    component of such rows alone has a null ``component_id``); repeated rows are
    returned as often as they come; other columns are ignored; an empty table
    gives an empty result.
    """
    fps = written(docs.select(F.col(id_col).cast("long").alias("doc_id"),
                              fingerprint_column(text_col, shingle).alias("fp")), "simhash-fingerprints")
    nodes = written(fps.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "simhash-nodes")
    labels = connected_components(fingerprint_links(nodes, radius, dense), "simhash")
    named = nodes.join(labels.withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", "first_id", F.coalesce("label", "fp").alias("label"))
    named = written(named, "simhash-named")
    smallest = written(named.groupBy("label").agg(F.min("first_id").alias("component_id")), "simhash-smallest")
    extra = ["label"] if labels_too else []
    classes = written(named.join(smallest, "label").select("fp", "component_id", *extra), "simhash-classes")
    return fps.join(classes, "fp").select("doc_id", digits("fp").alias("fingerprint"), "component_id", *extra)
