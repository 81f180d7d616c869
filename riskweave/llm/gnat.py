"""Top rows within inner-product windows by a multiway hyperplane tree.

Inner products become distances by one more component: with ``M**2`` no smaller
than any squared norm, a row is ``(x, sqrt(M**2 - |x|**2))``, a query ``(q, 0)``,
and ``d**2 = |q|**2 + M**2 - 2 * (q . x)``.  A window of scores is then an
annulus around the query.

*Tree.*  Every inner node holds up to ``FANOUT`` split points, chosen far apart
from a bounded sample; a row belongs to the nearest one.  For every split point
and every sibling subtree the smallest and largest distance from the point to
the subtree's rows is stored, taken over all rows of the table.  A subtree goes
when, for some split point, the annulus cannot meet its range.

*Search.*  Leaves are cut into blocks of bounded size (a leaf of a hot vector
has many).  Queries meet, first, one block of their own leaf, which bounds what
can still matter, and then every other block whose leaf is left.  Blocks are
compared exactly in integers, so the result is exact whatever the tree does.
A block of rows meets a bounded block of queries; rows are copied once for
each block of queries, never gathered by one key.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskweave.llm import vectors
from riskweave.llm.common import hash_order, importable, thinned, written

DIMS, FACTOR = 64, 256
FANOUT = 8
#: Rows a leaf should hold; the tree stops at ``MAX_LEAVES`` leaves all the same.
LEAF_ROWS, MAX_LEAVES = 4096, 4096
#: Rows the split points are chosen from.
SAMPLE_ROWS = 16384
#: Rows and queries compared by one task at once.
BLOCK_ROWS, BLOCK_QUERIES = 16384, 4096
#: Distances are rounded; ranges are widened by this share.
SLACK = 1e-9
LOW, HIGH = -(1 << 62), 1 << 62


# --- tree -------------------------------------------------------------------------

@dataclass
class Node:
    """Split points with their extra component; ``child[i]`` is a node or, if
    negative, ``~leaf``.  ``low``/``high``[i, j]: distances from point i to the
    rows below point j (filled from all rows)."""

    points: np.ndarray
    child: list[int]
    low: np.ndarray = field(default=None)
    high: np.ndarray = field(default=None)


@dataclass
class Tree:
    nodes: list[Node]
    leaves: int
    top: float  # M**2

    def lifted(self, x: np.ndarray) -> np.ndarray:
        x = x.astype(np.float64)
        return np.hstack([x, np.sqrt(np.maximum(0.0, self.top - (x * x).sum(axis=1)))[:, None]])


def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    square = (a * a).sum(axis=1)[:, None] + (b * b).sum(axis=1)[None, :] - 2.0 * (a @ b.T)
    return np.sqrt(np.maximum(0.0, square))


def spread(x: np.ndarray, fanout: int) -> np.ndarray:
    """Positions of up to ``fanout`` points, each the farthest from those before
    it (starting far from the mean); no two are equal."""
    far = distances(x, x.mean(axis=0, keepdims=True))[:, 0]
    at = [int(far.argmax())]
    near = distances(x, x[at])[:, 0]
    while len(at) < fanout and near.max() > 0:
        at.append(int(near.argmax()))
        near = np.minimum(near, distances(x, x[at[-1:]])[:, 0])
    return np.array(at)


def build(sample: np.ndarray, top: float, rows: int, *, fanout: int = FANOUT, leaf_rows: int = LEAF_ROWS,
          max_leaves: int = MAX_LEAVES) -> Tree:
    """A tree over ``rows`` rows, split where the sample says that a leaf would
    hold more than ``leaf_rows`` of them, largest leaf first."""
    tree = Tree([], 1, top)
    share = rows / max(1, len(sample))
    lifted = tree.lifted(sample)
    todo = [(np.arange(len(sample)), None, 0)]  # members, parent node, place in it
    tree.leaves = 0
    done: list[tuple[int | None, int]] = []
    while todo:
        todo.sort(key=lambda t: len(t[0]))
        members, parent, place = todo.pop()
        x = lifted[members]
        points = spread(x, fanout) if len(members) * share > leaf_rows and len(todo) + len(done) + fanout <= max_leaves else []
        if len(points) < 2:
            done.append((parent, place))
            continue
        node = Node(x[points], [0] * len(points))
        tree.nodes.append(node)
        if parent is not None:
            tree.nodes[parent].child[place] = len(tree.nodes) - 1
        nearest = distances(x, node.points).argmin(axis=1)
        todo += [(members[nearest == j], len(tree.nodes) - 1, j) for j in range(len(points))]
    for leaf, (parent, place) in enumerate(done):
        if parent is not None:
            tree.nodes[parent].child[place] = ~leaf
    tree.leaves = len(done)
    for node in tree.nodes:
        n = len(node.child)
        node.low, node.high = np.full((n, n), np.inf), np.full((n, n), -np.inf)
    return tree


def descend(tree: Tree, x: np.ndarray, ranges: bool = False) -> np.ndarray:
    """Leaf of each row; with ``ranges`` the nodes' ranges are widened to the rows."""
    leaf = np.zeros(len(x), np.int32)
    if not tree.nodes:
        return leaf
    lifted = tree.lifted(x)
    todo = [(0, np.arange(len(x)))]
    while todo:
        at, members = todo.pop()
        node = tree.nodes[at]
        far = distances(lifted[members], node.points)
        nearest = far.argmin(axis=1)
        for j, child in enumerate(node.child):
            below = nearest == j
            if not below.any():
                continue
            if ranges:
                node.low[:, j] = np.minimum(node.low[:, j], far[below].min(axis=0))
                node.high[:, j] = np.maximum(node.high[:, j], far[below].max(axis=0))
            if child < 0:
                leaf[members[below]] = ~child
            else:
                todo.append((child, members[below]))
    return leaf


def bounds(tree: Tree, q: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Smallest and largest score that a row of each leaf can have with each
    query (query x leaf), from the ranges on the way to the leaf."""
    q = q.astype(np.float64)
    square = (q * q).sum(axis=1) + tree.top
    low, high = np.full((len(q), tree.leaves), -np.inf), np.full((len(q), tree.leaves), np.inf)
    if not tree.nodes:
        return low, high
    lifted = np.hstack([q, np.zeros((len(q), 1))])
    todo = [(0, np.zeros(len(q)), np.full(len(q), np.inf))]
    while todo:
        at, near, far = todo.pop()
        node = tree.nodes[at]
        d = distances(lifted, node.points)
        pad = SLACK * (d.max(initial=0.0) + np.sqrt(tree.top) + 1.0)
        for j, child in enumerate(node.child):
            if not np.isfinite(node.low[0, j]):  # no row at all below this point
                below_near, below_far = np.full(len(q), np.inf), np.full(len(q), -np.inf)
            else:
                below_near = np.maximum(near, np.maximum(d - node.high[:, j], node.low[:, j] - d).max(axis=1) - pad)
                below_far = np.minimum(far, (d + node.high[:, j]).min(axis=1) + pad)
            if child >= 0:
                todo.append((child, below_near, below_far))
                continue
            with np.errstate(invalid="ignore"):
                high[:, ~child] = (square - np.maximum(0.0, below_near) ** 2) / 2 + 1e-3
                low[:, ~child] = np.where(below_far < 0, np.inf, (square - below_far ** 2) / 2 - 1e-3)
    return low, high


# --- index ------------------------------------------------------------------------

@dataclass
class Index:
    """``rows(id, label, x, leaf, slot)`` as a written table, its tree with the
    ranges of all rows, and the number of blocks of each leaf."""

    rows: DataFrame
    tree: Tree
    blocks: np.ndarray

    @property
    def offset(self) -> np.ndarray:
        return np.concatenate([[0], np.cumsum(self.blocks)])


def _placed(batches: Iterator[pa.RecordBatch], tree: Tree, dims: int) -> Iterator[pa.RecordBatch]:
    seen = 0
    for b in batches:
        leaf = descend(tree, vectors.matrix(b.column("x"), dims))
        yield pa.RecordBatch.from_arrays([*b.columns, pa.array(leaf, pa.int32()), pa.array(np.arange(seen, seen + len(leaf)))],
                                         [*b.schema.names, "leaf", "slot"])
        seen += len(leaf)


def _ranged(batches: Iterator[pa.RecordBatch], tree: Tree, dims: int) -> Iterator[pa.RecordBatch]:
    """Ranges over the rows of one task: (node, point, sibling, low, high)."""
    for b in batches:
        descend(tree, vectors.matrix(b.column("x"), dims), ranges=True)
    found = [(n, i, j, float(node.low[i, j]), float(node.high[i, j])) for n, node in enumerate(tree.nodes)
             for i in range(len(node.child)) for j in range(len(node.child)) if np.isfinite(node.low[i, j])]
    if found:
        cols = list(zip(*found, strict=True))
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int32()) for c in cols[:3]] + [pa.array(c, pa.float64()) for c in cols[3:]],
                                         ["node", "point", "below", "low", "high"])


def index(rows: DataFrame, *, dims: int = DIMS, fanout: int = FANOUT, leaf_rows: int = LEAF_ROWS,
          max_leaves: int = MAX_LEAVES, sample_rows: int = SAMPLE_ROWS, block_rows: int = BLOCK_ROWS) -> Index:
    """Index ``rows(id, label, x)``: split points from a hash-chosen sample of
    ``sample_rows``, ranges, leaves and blocks from every row."""
    spark = rows.sparkSession
    importable(spark)
    rows = written(rows, "gnat-vectors")
    n, top = rows.agg(F.count("*"), F.max(F.aggregate("x", F.lit(0).cast("long"), lambda s, x: s + x.cast("long") * x))).first()
    drawn = rows.where(thinned("id", 12, sample_rows, n)).orderBy(hash_order("id", 12), "id").limit(sample_rows).select("x")
    sample = np.array([r["x"] for r in drawn.collect()], np.int64).reshape(-1, dims)
    tree = build(sample, float(top or 0), n, fanout=fanout, leaf_rows=leaf_rows, max_leaves=max_leaves)
    schema = T.StructType([*rows.schema.fields, *T.StructType.fromDDL("leaf int, slot long")])
    rows = written(rows.mapInArrow(functools.partial(_placed, tree=tree, dims=dims), schema), "gnat-rows")
    ranges = rows.select("x").mapInArrow(functools.partial(_ranged, tree=tree, dims=dims),
                                         "node int, point int, below int, low double, high double")
    for r in ranges.groupBy("node", "point", "below").agg(F.min("low").alias("low"), F.max("high").alias("high")).collect():
        node = tree.nodes[r["node"]]
        node.low[r["point"], r["below"]], node.high[r["point"], r["below"]] = r["low"], r["high"]
    blocks = np.zeros(tree.leaves, np.int64)
    for r in rows.groupBy("leaf").count().collect():
        blocks[r["leaf"]] = -(-r["count"] // block_rows)
    return Index(rows, tree, blocks)


# --- search -----------------------------------------------------------------------

def _routed(batches: Iterator[pa.RecordBatch], tree: Tree, blocks: np.ndarray, offset: np.ndarray, dims: int,
            home: bool) -> Iterator[pa.RecordBatch]:
    """Copies of each query, one for each block it has to meet: at ``home`` one
    block of its own leaf, else all other blocks of the leaves that are left."""
    for b in batches:
        x = vectors.matrix(b.column("x"), dims)
        key = b.column("key").to_numpy(zero_copy_only=False)
        own = descend(tree, x)
        first = offset[own] + key % np.maximum(1, blocks[own])
        if home:
            who, where = np.flatnonzero(blocks[own] > 0), first[blocks[own] > 0]
        else:
            low, high = bounds(tree, x)
            least = np.array([min(v) if len(v) else HIGH for v in b.column("least").to_pylist()], np.float64)
            most = np.array([max(v) if len(v) else LOW for v in b.column("most").to_pylist()], np.float64)
            left = (high >= least[:, None]) & (low <= most[:, None]) & (blocks > 0)[None, :]
            who, leaf = np.nonzero(left)
            count = blocks[leaf]
            who, where = np.repeat(who, count), np.repeat(offset[leaf] - np.cumsum(count) + count, count) + np.arange(count.sum())
            other = where != first[who]
            who, where = who[other], where[other]
        if not len(who):
            continue
        step = max(1, (1 << 22) // (dims * 8))
        for lo in range(0, len(who), step):
            picked = b.take(pa.array(who[lo:lo + step]))
            yield pa.RecordBatch.from_arrays([*picked.columns, pa.array(where[lo:lo + step], pa.int64())],
                                             [*picked.schema.names, "block"])


def best(queries: dict[str, np.ndarray | list], ids: np.ndarray, labels: np.ndarray, x: np.ndarray, same: bool,
         count: int) -> list[tuple[int, int, int, int]]:
    """(query position, window, id, score) of the first ``count`` rows of every
    window: same or different label, another id, best scores and smaller ids first."""
    order = np.argsort(ids, kind="stable")
    ids, labels, x = ids[order], labels[order], x[order]
    found = []
    step = max(1, (1 << 22) // max(1, len(ids)))
    for lo in range(0, len(queries["id"]), step):
        part = slice(lo, lo + step)
        score = vectors.products(queries["x"][part], x)
        fits = (labels[None, :] == queries["label"][part][:, None]) == same
        fits &= ids[None, :] != queries["id"][part][:, None]
        windows = list(zip(queries["least"][part], queries["most"][part], strict=True))
        fits &= score >= np.array([min(a, default=HIGH) for a, _ in windows])[:, None]
        fits &= score <= np.array([max(b, default=LOW) for _, b in windows])[:, None]
        who, row = np.nonzero(fits)
        value = score[who, row]
        by = np.lexsort((row, -value, who))
        who, row, value = who[by], row[by], value[by]
        edge = np.searchsorted(who, np.arange(len(windows) + 1))
        for q, (least, most) in enumerate(windows):
            down = -value[edge[q]:edge[q + 1]]
            for w, (a, b) in enumerate(zip(least, most, strict=True)):
                i = int(np.searchsorted(down, -b, side="left"))
                for k in range(i, min(i + count, len(down))):
                    if -down[k] < a:
                        break
                    found.append((lo + q, w, int(ids[row[edge[q] + k]]), int(-down[k])))
    return found


FOUND = "key long, win int, id long, score long"


def _compare(queries: pa.Table, rows: pa.Table, dims: int, same: bool, count: int) -> pa.Table:
    out: list[tuple] = []
    if queries.num_rows and rows.num_rows:
        flat = lambda t, c: t.column(c).combine_chunks()
        number = lambda t, c: flat(t, c).to_numpy(zero_copy_only=False)
        asked = {"x": vectors.matrix(flat(queries, "x"), dims), "id": number(queries, "id"), "label": number(queries, "label"),
                 "least": queries.column("least").to_pylist(), "most": queries.column("most").to_pylist()}
        key = number(queries, "key")
        out = [(int(key[q]), w, i, s) for q, w, i, s in best(
            asked, number(rows, "id"), number(rows, "label"), vectors.matrix(flat(rows, "x"), dims), same, count)]
    cols = list(zip(*out, strict=True)) if out else [[]] * 4
    return pa.table([pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.int32(), pa.int64(), pa.int64()), strict=True)],
                    names=["key", "win", "id", "score"])


def _round(ix: Index, queries: DataFrame, number: int, dims: int, same: bool, count: int, home: bool) -> DataFrame:
    """Found rows of one round; a task compares one block of rows with one of
    ``number`` parts of the queries."""
    routed = queries.mapInArrow(
        functools.partial(_routed, tree=ix.tree, blocks=ix.blocks, offset=ix.offset, dims=dims, home=home),
        T.StructType([*queries.schema.fields, T.StructField("block", T.LongType())]))
    routed = written(routed.withColumn("part", F.pmod(F.col("key"), F.lit(number))), "gnat-routed")
    met = written(routed.select("block", "part").distinct(), "gnat-met")
    literal = lambda values: F.array(*[F.lit(int(v)) for v in values])
    block = literal(ix.offset[:-1])[F.col("leaf")] + F.pmod(F.xxhash64("slot"), literal(ix.blocks)[F.col("leaf")])
    dealt = ix.rows.select("id", "label", "x", block.alias("block")).join(met, "block")
    return routed.groupBy("block", "part").cogroup(dealt.groupBy("block", "part")).applyInArrow(
        functools.partial(_compare, dims=dims, same=same, count=count), FOUND)


def search(ix: Index, queries: DataFrame, *, same: bool, count: int, dims: int = DIMS,
           block_queries: int = BLOCK_QUERIES) -> DataFrame:
    """(key, win, rank, id, score): the first ``count`` rows in every window.

    ``queries(key, id, label, x, least, most)``: ``key`` is unique and not
    negative, ``least`` and ``most`` are arrays of the windows' inclusive ends.
    With ``same`` rows of the query's own label are found, else rows of the
    others; never rows of its id.
    """
    number = max(1, -(-queries.count() // block_queries))
    near = written(_round(ix, queries, number, dims, same, count, True), "gnat-near")
    # the last of a full window's rows bounds what the other blocks can add
    full = (near.groupBy("key", "win").agg(F.count("*").alias("n"), F.min("score").alias("last"))
            .where(F.col("n") >= count).groupBy("key")
            .agg(F.map_from_entries(F.collect_list(F.struct("win", "last"))).alias("last")))
    tight = queries.join(full, "key", "left").withColumn("least", F.transform(
        "least", lambda v, i: F.greatest(v, F.coalesce(F.try_element_at("last", i), v)))).drop("last")
    rest = _round(ix, written(tight, "gnat-tight"), number, dims, same, count, False)
    order = Window.partitionBy("key", "win").orderBy(F.desc("score"), F.asc("id"))
    return (near.unionByName(rest).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= count)
            .select("key", "win", "rank", "id", "score"))


# --- hard negatives ---------------------------------------------------------------

LABELS, SHIFT_EVERY, ANCHOR_EVERY = 10, 7, 100
POSITIVES, NEGATIVES = 5, 5


def labelled(rows: DataFrame, id_col: str, vector_col: str, label_col: str, dims: int, factor: int) -> DataFrame:
    """(id, label, x) of the rows that take part: every ``SHIFT_EVERY``-th id has
    the next label, components are ``floor(factor * x)``."""
    who, label = F.col(id_col).cast("long"), F.col(label_col).cast("long")
    kept = rows.where(who.isNotNull() & label.isNotNull() & vectors.whole(vector_col, dims))
    scaled = lambda x: F.floor(factor * x.cast("double"))
    exact = lambda x: F.when(F.abs(factor * x.cast("double")) > vectors.MAX_COMPONENT, F.raise_error(
        F.lit("a scaled component is too large to be exact"))).otherwise(scaled(x).cast("int"))
    return kept.select(who.alias("id"), F.when(who % SHIFT_EVERY == 0, (label + 1) % LABELS).otherwise(label).cast("int").alias("label"),
                       F.transform(vector_col, exact).alias("x"))


def hard_negatives(rows: DataFrame, *, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
                   dims: int = DIMS, factor: int = FACTOR, positives: int = POSITIVES, negatives: int = NEGATIVES,
                   anchor_every: int = ANCHOR_EVERY, **tree) -> DataFrame:
    """One row per anchor, positive and negative: anchor_id, positive_id, rank,
    negative_id, positive_score, negative_score.

    Rows without an id, label or vector, of another length than ``dims`` or with
    a null or non-finite component take no part.  Equal scores go to the smaller
    id.  Rows that repeat an id are rows of their own among the found ones, but
    none is another row to an anchor of that id, and equal anchor rows count
    once.  An anchor without a positive, and a positive without a negative in
    its window, gives no row.  Other columns are ignored; an empty table gives
    an empty result.  Components beyond ``vectors.MAX_COMPONENT`` after scaling
    are an error, as their products would not be exact.
    """
    ix = index(labelled(rows, id_col, vector_col, label_col, dims, factor), dims=dims, **tree)
    anchors = ix.rows.where(F.col("id") % anchor_every == 0).select("id", "label", "x").distinct()
    anchors = written(anchors.withColumn("key", F.monotonically_increasing_id()), "gnat-anchors")
    ends = lambda v: F.array(F.lit(v).cast("long"))
    good = written(search(ix, anchors.select("key", "id", "label", "x", ends(LOW).alias("least"), ends(HIGH).alias("most")),
                          same=True, count=positives, dims=dims), "gnat-positives")
    # 80 * positive <= 100 * negative: negative at least the ceiling of 4/5 of positive
    per = good.groupBy("key").agg(F.sort_array(F.collect_list(F.struct("rank", "id", "score"))).alias("p"))
    asked = written(anchors.join(per, "key").select(
        "key", "id", "label", "x", "p", F.expr("transform(p, q -> (4 * q.score + 4) div 5)").alias("least"),
        F.transform("p", lambda p: p["score"]).alias("most")), "gnat-asked")
    bad = search(ix, asked.drop("p"), same=False, count=negatives, dims=dims)
    return bad.join(asked.select("key", F.col("id").alias("anchor_id"), "p"), "key").select(
        "anchor_id", F.col("p")[F.col("win")]["id"].alias("positive_id"), "rank", F.col("id").alias("negative_id"),
        F.col("p")[F.col("win")]["score"].alias("positive_score"), F.col("score").alias("negative_score"))


HARD_NEGATIVES_SQL = f"""WITH parts AS (SELECT vec_id, label, generate_subscripts(embedding, 1) AS p, unnest(embedding)::DOUBLE AS raw
  FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND len(embedding) = {DIMS}),
ok AS (SELECT vec_id, CASE WHEN vec_id % {SHIFT_EVERY} = 0 THEN (any_value(label) + 1) % {LABELS} ELSE any_value(label) END AS label
  FROM parts GROUP BY vec_id HAVING count(raw) = {DIMS} AND bool_and(isfinite(raw))),
v AS (SELECT vec_id, p, floor({FACTOR} * raw)::BIGINT AS x FROM parts SEMI JOIN ok USING (vec_id)),
s AS (SELECT a.vec_id AS anchor, b.vec_id AS other, sum(a.x * b.x)::BIGINT AS score
  FROM v a JOIN v b ON a.p = b.p AND a.vec_id % {ANCHOR_EVERY} = 0 AND a.vec_id <> b.vec_id GROUP BY a.vec_id, b.vec_id),
m AS (SELECT anchor, other, score, oa.label = ob.label AS same FROM s
  JOIN ok oa ON oa.vec_id = anchor JOIN ok ob ON ob.vec_id = other),
pos AS (SELECT anchor, other, score FROM m WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor ORDER BY score DESC, other) <= {POSITIVES})
SELECT pos.anchor AS anchor_id, pos.other AS positive_id,
  row_number() OVER (PARTITION BY pos.anchor, pos.other ORDER BY m.score DESC, m.other)::INTEGER AS rank,
  m.other AS negative_id, pos.score AS positive_score, m.score AS negative_score
FROM pos JOIN m ON m.anchor = pos.anchor AND NOT m.same AND 80 * pos.score <= 100 * m.score AND m.score <= pos.score
QUALIFY rank <= {NEGATIVES}"""
