"""Hard negatives by cover trees over norm-augmented candidates.

With one more component every candidate gets the norm of the longest one, so that
all lie on a sphere and a row's inner product with an anchor follows from their
angle.  Candidates are dealt out to regions around a few centres and each block of
a region is made a cover tree: balls that cover their members, level by level with
smaller radii.  A ball's angle to an anchor and its radius bound the inner products
of its members from both sides.  Anchors go to blocks whose bounds meet what is
asked; there the balls are entered best first, those outside the windows of all
anchors left out, and the members of the last balls compared exactly.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.functions import ArrowUDFType

from courtline.llm.common import written

# Regions: so many at least and at most, and so many rows of a region in one block at most, on average.
LEAST_REGIONS = 32
MOST_REGIONS = 1024
BLOCK_ROWS = 16_384
# Rows for each region in the bounded sample that the regions' centres are chosen from.
SAMPLE_ROWS = 8
# Anchors that meet a block in one task, on average at most.
CHUNK_ANCHORS = 8_192
# A ball of at most so many rows has none below it; any other has so many balls below it at most.
LEAF_ROWS = 128
FANOUT = 32
# Angles and cosines are taken to be wrong by so much at most.
SLACK = 1e-6

POSITIVES = 5
NEGATIVES = 3
SMALLEST, LARGEST = -(2**63), 2**63 - 1


def quantized(rows: DataFrame, anchor: Column, id_column: str, vector_column: str, label_column: str) -> DataFrame:
    """``id``, ``label``, ``anchor``, ``vec`` (whole numbers as doubles) and ``key``, a hash, of the distinct rows that take part."""
    def component(x: Column) -> Column:
        y = 256 * x.cast("double")
        # From 2**52 on a double is whole already, and might not fit a long.
        return F.when(F.abs(y) < 2.0**52, F.floor(y).cast("double")).otherwise(y)

    made = rows.select(F.col(id_column).cast("long").alias("id"), F.col(label_column).cast("long").alias("label"),
                       F.coalesce(anchor, F.lit(False)).alias("anchor"), F.transform(vector_column, component).alias("vec"))
    finite = F.forall("vec", lambda y: F.coalesce(F.abs(y) < float("inf"), F.lit(False)))
    return made.filter(F.col("id").isNotNull() & F.col("label").isNotNull() & F.col("vec").isNotNull() & finite).distinct(
        ).withColumn("key", F.xxhash64("id", "label", "vec"))


def matrix(column: pa.ChunkedArray | pa.Array, width: int) -> np.ndarray:
    """A list column as a matrix; shorter vectors are followed by zeros."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
        if isinstance(column, pa.ChunkedArray):
            column = pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], column.type)
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    sizes = np.diff(column.offsets.to_numpy())
    out = np.zeros((len(column), width))
    out[np.repeat(np.arange(len(column)), sizes), np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = flat
    return out


def shuffle_partitions(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


class Sphere(NamedTuple):
    """Radius of the sphere that candidates are lifted to, and the vectors' length."""

    radius: float
    width: int

    def lifted(self, x: np.ndarray) -> np.ndarray:
        """Candidates as unit vectors with one more component."""
        unit = x / self.radius
        return np.concatenate([unit, np.sqrt(np.maximum(0, 1 - (unit * unit).sum(axis=1)))[:, None]], axis=1)

    def bounds(self, centre: np.ndarray, angle: np.ndarray, q: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Least and most inner product of each anchor (columns) with any member of each ball (rows)."""
        norm = np.sqrt((q * q).sum(axis=1))
        way = q / np.where(norm > 0, norm, 1)[:, None]
        between = np.arccos(np.clip(centre[:, :-1] @ way.T, -1, 1))
        reach = angle[:, None] + 1e-3 * SLACK**0.5
        scale = norm * self.radius
        low = scale * (np.cos(np.minimum(np.pi, between + reach)) - SLACK)
        return low, scale * (np.cos(np.maximum(0, between - reach)) + SLACK)


def angles(u: np.ndarray, centre: np.ndarray) -> np.ndarray:
    """Angle of each unit vector to one other, exact for small ones too."""
    return 2 * np.arcsin(np.clip(np.sqrt(((u - centre) ** 2).sum(axis=1)) / 2, 0, 1))


class Ball(NamedTuple):
    """Rows ``first`` to ``end`` of a block, all within ``angle`` of row ``first``; balls below it end before ``after``."""

    first: int
    end: int
    angle: float
    after: int


def net(u: np.ndarray, most: int, enough: float = 0.0) -> tuple[list[int], np.ndarray]:
    """Up to ``most`` centres, each as far as can be from those before it, and every vector's nearest one.

    All vectors then lie within a radius of their centre that no two centres are
    closer than.  No more centres are taken once that radius is ``enough``.
    """
    chosen = [0]
    nearest, which = angles(u, u[0]), np.zeros(len(u), np.int64)
    while len(chosen) < most and nearest.max() > max(enough, SLACK):
        at = int(nearest.argmax())
        away = angles(u, u[at])
        which[away < nearest] = len(chosen)
        nearest = np.minimum(nearest, away)
        chosen.append(at)
    return chosen, which


def cover_tree(u: np.ndarray) -> tuple[np.ndarray, list[Ball]]:
    """An order of the unit vectors, and the balls over that order, each before those below it.

    A level's centres are a net: the covering radius of the balls below is at most
    their centres' least distance, and half of the ball's own unless that would
    take more than ``FANOUT`` of them.
    """
    order: list[np.ndarray] = []
    balls: list[Ball] = []
    placed = 0

    def build(members: np.ndarray) -> None:
        """``members[0]`` is the centre."""
        nonlocal placed
        at, first = len(balls), placed
        widest = float(angles(u[members], u[members[0]]).max())
        balls.append(Ball(first, first + len(members), widest, 0))
        if len(members) <= LEAF_ROWS or widest < 2 * SLACK:
            order.append(members)
            placed += len(members)
        else:
            chosen, which = net(u[members], FANOUT, widest / 2)
            for k, centre in enumerate(chosen):
                inside = which == k
                inside[centre] = False
                build(np.concatenate((members[[centre]], members[inside])))
        balls[at] = balls[at]._replace(after=len(balls))

    if len(u):
        build(np.arange(len(u)))
    return np.concatenate([np.zeros(0, np.int64), *order]), balls


def exact_products(x: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Whole inner products as longs; beyond a long's ends they are its ends."""
    size = np.abs(x).max(initial=0) * np.abs(q).max(initial=0) * x.shape[1]
    if size < 2.0**53:
        return (x @ q.T).astype(np.int64)
    whole = np.vectorize(int, otypes=[object])
    return np.clip(whole(x) @ whole(q).T, SMALLEST, LARGEST).astype(np.int64)


class Block(NamedTuple):
    """The rows of one block in the order of its cover tree."""

    ids: np.ndarray
    labels: np.ndarray
    keys: np.ndarray
    x: np.ndarray
    balls: list[Ball]


class Wanted(NamedTuple):
    """Windows of anchors: rows with ``low <= score <= high`` and ``score >= least``."""

    anchor: np.ndarray
    low: np.ndarray
    high: np.ndarray
    least: np.ndarray


def search(block: Block, sphere: Sphere, q: np.ndarray, labels: np.ndarray, keys: np.ndarray, wanted: Wanted, same: bool,
           most: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The first ``most`` rows of every window: windows, rows and scores.

    Balls are entered in the order of the best score that any window can still
    find there.  A window leaves out balls that lie outside it, or below the last
    of the rows it has already.
    """
    floor = np.maximum(wanted.low, wanted.least)
    found = (np.zeros(0, np.int64),) * 3
    u = sphere.lifted(block.x[[b.first for b in block.balls]])
    angle = np.array([b.angle for b in block.balls])
    heap: list[tuple[float, int, np.ndarray, np.ndarray]] = [
        (-np.inf, 0, np.arange(len(wanted.anchor)), np.full(len(wanted.anchor), np.inf))]
    while heap:
        _, at, who, best = heapq.heappop(heap)
        who = who[best >= floor[who]]
        if not len(who):
            continue
        ball = block.balls[at]
        if ball.after > at + 1:
            below, child = [], at + 1
            while child < ball.after:
                below.append(child)
                child = block.balls[child].after
            low, high = sphere.bounds(u[below], angle[below], q)
            for k, child in enumerate(below):
                lowest, highest = low[k][wanted.anchor[who]], high[k][wanted.anchor[who]]
                some = (highest >= floor[who]) & (lowest <= wanted.high[who])
                if some.any():
                    most_of = np.minimum(highest[some], wanted.high[who[some]])
                    heapq.heappush(heap, (-float(most_of.max()), child, who[some], highest[some]))
            continue
        some, which = np.unique(wanted.anchor[who], return_inverse=True)
        for first in range(ball.first, ball.end, LEAF_ROWS):
            rows = np.arange(first, min(first + LEAF_ROWS, ball.end))
            score = exact_products(block.x[rows], q[some])
            fits = ((block.labels[rows][:, None] == labels[some]) == same) & (block.keys[rows][:, None] != keys[some])
            score = score[:, which]
            row, window = np.nonzero(fits[:, which] & (score >= floor[who]) & (score <= wanted.high[who]))
            found = _merged(found, (who[window], rows[row], score[row, window]), block, floor, most)
    return found


def _merged(found: tuple[np.ndarray, ...], new: tuple[np.ndarray, ...], block: Block, floor: np.ndarray, most: int) -> tuple[np.ndarray, ...]:
    """The first ``most`` of both for every window (windows, rows, scores); raises ``floor`` to the last of a full window."""
    if not len(new[0]):
        return found
    touched = np.zeros(len(floor), bool)
    touched[new[0]] = True
    again = touched[found[0]]
    w, r, s = (np.concatenate((old[again], more)) for old, more in zip(found, new, strict=True))
    order = np.lexsort((block.keys[r], block.ids[r], ~s, w))
    w, r, s = w[order], r[order], s[order]
    rank = np.arange(len(w)) - np.searchsorted(w, w)
    last = rank == most - 1
    floor[w[last]] = np.maximum(floor[w[last]], s[last])
    return tuple(np.concatenate((old[~again], c[rank < most])) for old, c in zip(found, (w, r, s), strict=True))


def first_copies(x: np.ndarray, labels: np.ndarray, ids: np.ndarray, keys: np.ndarray, most: int) -> np.ndarray:
    """Places of the first ``most`` rows of every vector and label: no others of them can be among the first of a window."""
    _, same = np.unique(np.ascontiguousarray(x).view(np.dtype((np.void, x.itemsize * x.shape[1]))).reshape(-1)
                        if x.shape[1] else np.zeros(len(x)), return_inverse=True)
    order = np.lexsort((keys, ids, labels, same))
    starts = np.concatenate(([True], (np.diff(same[order]) != 0) | (np.diff(labels[order]) != 0)))
    first = np.flatnonzero(starts)[np.cumsum(starts) - 1]
    return np.sort(order[np.arange(len(order)) - first < most])


class Index(NamedTuple):
    """The dealt-out candidates: ``blocks`` has the rows with their trees; the regions' centres, radii and blocks."""

    rows: DataFrame
    blocks: DataFrame
    sphere: Sphere
    centre: np.ndarray
    angle: np.ndarray
    first_block: np.ndarray


_BALLS = "array<struct<first:int,end:int,angle:double,after:int>>"


def index(rows: DataFrame, copies: int) -> Index:
    """Deals ``rows`` (see ``quantized``) out to regions and builds the cover trees of their blocks.

    A block holds the first ``copies`` rows of every vector and label: one more
    than any search asks for.
    """
    rows = written(rows, "vectors")
    norm2 = F.aggregate("vec", F.lit(0.0), lambda a, x: a + x * x)
    size = rows.agg(F.count(F.lit(1)).alias("n"), F.max(norm2).alias("norm2"), F.max(F.size("vec")).alias("width")).first()
    sphere = Sphere(float(np.sqrt(size.norm2 or 0)) * (1 + 1e-9) or 1.0, size.width or 0)
    regions = min(MOST_REGIONS, max(LEAST_REGIONS, -(-size.n // BLOCK_ROWS)))
    sample = rows.select("key", "vec").orderBy(F.xxhash64("key"), "key").limit(SAMPLE_ROWS * regions).collect()
    lifted = sphere.lifted(matrix(pa.array([r.vec for r in sample], pa.list_(pa.float64())), sphere.width))
    centre = lifted[net(lifted, regions)[0]] if sample else np.zeros((0, sphere.width + 1))

    def nearest(arrays: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for array in arrays:
            u = sphere.lifted(matrix(array, sphere.width))
            region = (u @ centre.T).argmax(axis=1) if len(u) else np.zeros(0, np.int64)
            yield pa.StructArray.from_arrays([pa.array(region, pa.int64()), pa.array(angles(u, centre[region]))], ["region", "angle"])

    udf = F.arrow_udf(nearest, "region long, angle double", ArrowUDFType.SCALAR_ITER)
    dealt = written(rows.withColumn("home", udf("vec")).select(*rows.columns, "home.*"), "regions")
    n, angle = np.zeros(len(centre), np.int64), np.zeros(len(centre))
    for r in dealt.groupBy("region").agg(F.count(F.lit(1)).alias("n"), F.max("angle").alias("angle")).collect():
        n[r.region], angle[r.region] = r.n, r.angle
    parts = -(-n // BLOCK_ROWS)
    first_block = np.concatenate(([0], np.cumsum(parts)))

    def tree(key: tuple, table: pa.Table) -> pa.Table:
        x = matrix(table.column("vec"), sphere.width)
        some = first_copies(x, *(table.column(c).to_numpy() for c in ("label", "id", "key")), copies)
        order, balls = cover_tree(sphere.lifted(x[some]))
        out = table.take(pa.array(some[order]))
        packed = pa.array([[b._asdict() for b in balls]] + [None] * (len(order) - 1), pa.list_(pa.struct(
            [("first", pa.int32()), ("end", pa.int32()), ("angle", pa.float64()), ("after", pa.int32())])))
        return out.append_column("place", pa.array(np.arange(len(order)))).append_column("balls", packed)

    region = F.col("region").cast("int") + 1
    if len(centre):
        block = F.element_at(F.lit([int(b) for b in first_block[:-1]]), region) + F.pmod(
            F.xxhash64("key", F.lit("block")), F.element_at(F.lit([int(max(1, p)) for p in parts]), region))
    else:
        block = F.lit(0)
    keyed = dealt.withColumn("block", block.cast("long")).select("block", "id", "label", "key", "vec")
    blocks = keyed.repartition(min(shuffle_partitions(rows), max(1, int(first_block[-1]))), "block").groupBy("block").applyInArrow(
        tree, f"block long, id long, label long, key long, vec array<double>, place long, balls {_BALLS}")
    return Index(dealt, written(blocks, "cover-trees"), sphere, centre, angle, first_block)


_WINDOW = "array<struct<slot:int,low:bigint,high:bigint,least:bigint>>"


def nearest_rows(found: Index, anchors: DataFrame, n_anchors: int, same: bool, most: int, home: bool | None) -> DataFrame:
    """Per anchor and window the first ``most`` rows of each block: ``anchor``, ``slot``, ``id``, ``key``, ``score``.

    ``anchors`` has ``id``, ``label``, ``key``, ``vec``, ``region`` and ``windows``.
    ``home`` restricts the search to the anchor's own region, or to all others.
    """
    sphere, centre, angle, first_block = found.sphere, found.centre, found.angle, found.first_block

    def reached(batches: Iterator[tuple[pa.Array, ...]]) -> Iterator[pa.Array]:
        for vec, region, windows in batches:
            q = matrix(vec, sphere.width)
            low, high = sphere.bounds(centre, angle, q)
            out = []
            for i, (own, some) in enumerate(zip(region.to_pylist(), windows.to_pylist(), strict=True)):
                may = np.zeros(len(centre), bool)
                for w in some:
                    may |= (high[:, i] >= max(w["low"], w["least"])) & (low[:, i] <= w["high"])
                if home is not None:
                    may &= (np.arange(len(centre)) == own) == home
                out.append(np.concatenate([np.zeros(0, np.int64), *(
                    np.arange(first_block[r], first_block[r + 1]) for r in np.flatnonzero(may))]))
            yield pa.array(out, pa.list_(pa.int64()))

    chunks = max(1, -(-n_anchors // CHUNK_ANCHORS))
    udf = F.arrow_udf(reached, "array<bigint>", ArrowUDFType.SCALAR_ITER)
    sent = anchors.withColumn("block", F.explode(udf("vec", "region", "windows"))).select(
        "block", F.pmod("key", F.lit(chunks)).alias("chunk"), "label", "key", "vec", "windows")
    cells = sent.select("block", F.col("chunk").alias("met_by")).distinct()
    trees = found.blocks.join(cells, "block").select("block", "met_by", "id", "label", "key", "vec", "place", "balls")

    def meet(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
        left = left.sort_by("place")
        if not left.num_rows or not right.num_rows:
            columns = [np.zeros(0, np.int64)] * 5
        else:
            number = lambda t, c: t.column(c).to_numpy()
            block = Block(number(left, "id"), number(left, "label"), number(left, "key"), matrix(left.column("vec"), sphere.width),
                          [Ball(**b) for b in left.column("balls")[0].as_py()])
            windows = [(i, w) for i, some in enumerate(right.column("windows").to_pylist()) for w in some]
            wanted = Wanted(np.array([i for i, _ in windows], np.int64), *(
                np.array([w[name] for _, w in windows], np.int64) for name in ("low", "high", "least")))
            w, r, s = search(block, sphere, matrix(right.column("vec"), sphere.width), number(right, "label"), number(right, "key"),
                             wanted, same, most)
            slot = np.array([x["slot"] for _, x in windows], np.int64)
            columns = [number(right, "key")[wanted.anchor[w]], slot[w], block.ids[r], block.keys[r], s]
        return pa.table([pa.array(c, pa.int64()) for c in columns], names=["anchor", "slot", "id", "key", "score"])

    # Dealt out by hand: adaptive execution would merge cells by their bytes, which say little of the work in them.
    n = min(shuffle_partitions(found.rows), max(1, int(first_block[-1]) * chunks))
    trees, sent = trees.repartition(n, "block", "met_by"), sent.repartition(n, "block", "chunk")
    return trees.groupBy("block", "met_by").cogroup(sent.groupBy("block", "chunk")).applyInArrow(
        meet, "anchor long, slot long, id long, key long, score long")


def first_rows(rows: DataFrame, most: int) -> DataFrame:
    """The first ``most`` rows of each anchor and slot, with their ``rank`` from 1."""
    order = Window.partitionBy("anchor", "slot").orderBy(F.desc("score"), "id", "key")
    return rows.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= most)


def mine(rows: DataFrame, anchor: Column, positives: int = POSITIVES, negatives: int = NEGATIVES, id_column: str = "vec_id",
         vector_column: str = "embedding", label_column: str = "label") -> DataFrame:
    """``anchor_id``, ``positive_id``, ``rank``, ``negative_id``, ``positive_score`` and ``negative_score``.

    A vector's components x become floor(256 x), a shorter vector is followed by
    zeros, and scores are whole inner products with the anchor, higher first, ties
    by id, then by a hash of the row; beyond a long's ends they are its ends.  The
    positives of an anchor (rows where ``anchor`` holds) are its first other rows of
    the same label; for each of them the negatives are the first rows of another
    label that score from half of the positive's score to 95 hundredths of it.
    Rows without id, label or vector, or with a null or non-finite component, take
    no part; a row repeated as a whole counts once, rows that share only an id are
    different rows.  An empty table gives no rows, other columns are left out.

    Regions, blocks and chunks of anchors have bounded sizes, as rows are dealt out
    by hash within a region; the number of anchors and the bounded sample that
    regions are chosen from are all that depends on the driver.
    """
    taking_part = quantized(rows, anchor, id_column, vector_column, label_column)
    found = index(taking_part, max(positives, negatives) + 1)
    anchors = written(found.rows.filter("anchor").select("id", "label", "key", "vec", "region"), "anchors")
    n = anchors.count()

    def window(slot: Column, low: Column, high: Column, least: Column) -> Column:
        return F.struct(slot.cast("int").alias("slot"), low.cast("long").alias("low"), high.cast("long").alias("high"),
                        least.cast("long").alias("least"))

    end = F.lit(LARGEST), F.lit(SMALLEST)
    everything = anchors.withColumn("windows", F.array(window(F.lit(0), end[1], end[0], end[1])))
    near = written(first_rows(nearest_rows(found, everything, n, True, positives, True), positives), "home-positives")
    least = near.filter(F.col("rank") == positives).select(F.col("anchor").alias("key"), F.col("score").alias("least"))
    others = anchors.join(least, "key", "left").withColumn("windows", F.array(window(
        F.lit(0), end[1], end[0], F.coalesce("least", end[1])))).select(*anchors.columns, "windows")
    far = nearest_rows(found, others, n, True, positives, False)
    best = written(first_rows(near.drop("rank").unionByName(far), positives), "positives")

    # Half of the score from above, and 95 hundredths from below, without leaving a long.
    p = F.col("score")
    low = F.shiftright(p, 1) + F.pmod(p, F.lit(2))
    high = F.expr("score div 20") * 19 + F.floor((p % 20) * 19 / 20)
    asked = best.filter(p >= 0).groupBy(F.col("anchor").alias("key")).agg(
        F.collect_list(window(F.col("rank"), low, high, end[1])).alias("windows"))
    hard = nearest_rows(found, anchors.join(asked, "key"), n, False, negatives, None)
    chosen = first_rows(hard, negatives)
    positive = best.select("anchor", F.col("rank").cast("long").alias("slot"), F.col("id").alias("positive_id"),
                           F.col("score").alias("positive_score"))
    return chosen.join(positive, ["anchor", "slot"]).join(
        anchors.select(F.col("key").alias("anchor"), F.col("id").alias("anchor_id")), "anchor").select(
        "anchor_id", "positive_id", "rank", F.col("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))
