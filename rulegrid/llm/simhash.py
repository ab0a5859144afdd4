"""Near-duplicate classes by SimHash fingerprints, searched in vantage-point trees.

A fingerprint is the majority bit by bit of the XXH64 values of a text's shingles; two texts link when their fingerprints
differ in at most ``RADIUS`` bits.  Equal fingerprints are one point, so a group of copies is one row from there on.

* Shards: a tree of vantage points, fitted on a bounded sample of the points, cuts the space into shards: at every vertex a
  point goes left if it is within the vertex's distance of its vantage point, else right.  That leaf is its home.
* Boundary: by the triangle inequality a link crosses a vertex only if its right end is within ``RADIUS`` of the boundary.
  Such a point also visits the left side, and from there on every side that its ball of ``RADIUS`` touches, so it meets
  every left point that it can link with.
* In a shard, one task builds a vantage-point tree over the homes and runs homes and visitors through it in batches.
  Visitors are a stream: a task holds the homes of one shard and one batch.  Found links go out as a spanning forest.

Search is exact: sample and tree only decide where pairs are compared.  Distances of unrelated 64-bit fingerprints crowd
around 32, so a vertex halves the points but sends some 0.39 of the visitors both ways: comparisons grow like N ** 1.5.

Odd input: a null text, or one without words, has fingerprint zero and links like any other; equal rows are returned each; a null ``doc_id`` is
never the smallest, so a class of such rows only has a null ``component_id``; very long texts are hashed in blocks of
shingles; further columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rulegrid.llm.shared import connected_components, stored

SHINGLE = 3
SEED = 42
RADIUS = 2
SHARD = 16_384  # points that are at home in a shard, on average
SAMPLE_PER_SHARD = 16
MAX_SHARDS = 1 << 14  # so that the sample stays under 2 MB; beyond it shards grow
LEAF = 256
BLOCK = 1 << 16  # shingles hashed at a time

_BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little").astype(np.int64)
_LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))


def fingerprint(text: str | None, k: int = SHINGLE) -> int:
    """The fingerprint of a text, as an unsigned number."""
    import xxhash

    words = (text or "").encode("utf-8", "surrogatepass").translate(_LOWER).split()  # ASCII white space
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    width = min(k, len(words))
    starts, ends = starts[: len(words) - width + 1], ends[width - 1 :]
    hash_of, total = xxhash.xxh64_intdigest, np.zeros(64, np.int64)
    for at in range(0, len(starts), BLOCK):
        spans = zip(starts[at : at + BLOCK].tolist(), ends[at : at + BLOCK].tolist())
        block = np.fromiter((hash_of(joined[s:e], SEED) for s, e in spans), np.uint64)
        columns = block.view(np.uint8).reshape(-1, 8)
        total += np.concatenate([np.bincount(columns[:, j], minlength=256) @ _BITS for j in range(8)])
    majority = np.packbits(2 * total > len(starts), bitorder="little")
    return int.from_bytes(majority.tobytes(), "little")


def _fingerprints(k: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = np.fromiter((fingerprint(t.as_py(), k) for t in batch["text"]), np.uint64, batch.num_rows)
            yield pa.RecordBatch.from_arrays([batch["doc_id"], pa.array(prints.view(np.int64))], names=["doc_id", "print"])

    return run


def fingerprints(docs: DataFrame, k: int = SHINGLE) -> DataFrame:
    """``(doc_id, print)`` of ``docs (doc_id, text)``; ``print`` holds the fingerprint's 64 bits."""
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return own.mapInArrow(_fingerprints(k), "doc_id long, print long")


class VantageTree:
    """A vantage-point tree over 64-bit points; a vertex without children is a leaf and holds ``points[low:high]``."""

    def __init__(self, points: np.ndarray, leaf: int):
        self.points = points.copy()
        self.vertices: list[tuple] = []  # (vantage point, distance, left, right) or (None, leaf number, low, high)
        self.leaves = 0
        self._build(0, len(points), max(1, leaf))

    def _build(self, low: int, high: int, leaf: int) -> int:
        at = len(self.vertices)
        self.vertices.append(())
        part = self.points[low:high]
        if len(part) > leaf:
            vantage = part[0]
            far = np.bitwise_count(part ^ vantage)
            limit = int(np.median(far))
            left = far <= limit
            if left.all():  # more than half at the largest distance: they are the right side
                limit = int(far.max()) - 1
                left = far <= limit
            if 0 < left.sum() < len(part):
                self.points[low:high] = np.concatenate([part[left], part[~left]])
                middle = low + int(left.sum())
                children = self._build(low, middle, leaf), self._build(middle, high, leaf)
                self.vertices[at] = (vantage, limit, *children)
                return at
        self.vertices[at] = (None, self.leaves, low, high)
        self.leaves += 1
        return at

    def homes_and_visits(self, points: np.ndarray, radius: int = RADIUS) -> Iterator[tuple[int, bool, np.ndarray]]:
        """``(leaf number, visit, indices of points)``: every point's home, and the leaves it must be compared in."""
        todo = [(0, np.arange(len(points)), np.arange(0))]
        while todo:
            at, homes, visits = todo.pop()
            vantage, limit, left, right = self.vertices[at]
            if vantage is None:
                yield from ((limit, kind, rows) for kind, rows in ((False, homes), (True, visits)) if len(rows))
                continue
            home, visit = (np.bitwise_count(points[rows] ^ vantage).astype(np.int16) for rows in (homes, visits))
            crossing = homes[(home > limit) & (home - radius <= limit)]
            todo.append((left, homes[home <= limit], np.concatenate([visits[visit - radius <= limit], crossing])))
            todo.append((right, homes[home > limit], visits[visit + radius > limit]))

    def within(self, points: np.ndarray, radius: int = RADIUS) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Pairs ``(index of points, index of self.points)`` at most ``radius`` bits apart, in parts."""
        todo = [(0, np.arange(len(points)))]
        while todo:
            at, rows = todo.pop()
            if not len(rows):
                continue
            vantage, limit, left, right = self.vertices[at]
            if vantage is None:
                own = self.points[left:right]
                for i in range(0, len(rows), 8192):
                    some = rows[i : i + 8192]
                    hit, place = np.nonzero(np.bitwise_count(points[some][:, None] ^ own[None, :]) <= radius)
                    if len(hit):
                        yield some[hit], left + place
                continue
            far = np.bitwise_count(points[rows] ^ vantage).astype(np.int16)
            todo.append((left, rows[far - radius <= limit]))
            todo.append((right, rows[far + radius > limit]))


class _Forest:
    """Union of numbered nodes; tells whether a link joins two trees."""

    def __init__(self, n: int):
        self.parent = list(range(n))

    def find(self, x: int) -> int:
        parent = self.parent
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    def join(self, a: int, b: int) -> bool:
        a, b = self.find(a), self.find(b)
        if a != b:
            self.parent[max(a, b)] = min(a, b)
        return a != b


def _route(tree) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            points = batch["print"].to_numpy().view(np.uint64)
            for shard, visit, rows in tree.value.homes_and_visits(points):
                columns = [pa.array(np.full(len(rows), shard, np.int32)), pa.array(np.full(len(rows), visit)), pa.array(points[rows].view(np.int64))]
                yield pa.RecordBatch.from_arrays(columns, names=["shard", "visit", "print"])

    return run


class _Shard:
    """The homes of one shard, their tree and the forest of the links found so far."""

    def __init__(self):
        self.parts: list[np.ndarray] = []
        self.tree: VantageTree | None = None

    def ready(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Builds the tree once all homes are there and yields the links among them."""
        if self.tree is not None:
            return
        self.tree = VantageTree(np.concatenate(self.parts) if self.parts else np.zeros(0, np.uint64), LEAF)
        self.forest = _Forest(len(self.tree.points))
        points = self.tree.points
        for i in range(0, len(points), BLOCK):
            for a, b in self.tree.within(points[i : i + BLOCK]):
                a = a + i
                pairs = [(x, y) for x, y in zip(a[a < b].tolist(), b[a < b].tolist()) if self.forest.join(x, y)]
                if pairs:
                    new = np.array(pairs)
                    yield points[new[:, 0]], points[new[:, 1]]

    def visitors(self, points: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Links of visitors: each one's first, and those that join homes not yet joined."""
        first: dict[int, int] = {}
        for a, b in self.tree.within(points):
            pairs = []
            for x, y in zip(a.tolist(), b.tolist()):
                if x not in first:
                    first[x] = y
                    pairs.append((x, y))
                elif self.forest.join(first[x], y):
                    pairs.append((x, y))
            if pairs:
                new = np.array(pairs)
                yield points[new[:, 0]], self.tree.points[new[:, 1]]


def _links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links of rows sorted by shard, homes before visitors."""

    def batch_of(parts) -> Iterator[pa.RecordBatch]:
        for a, b in parts:
            yield pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], names=["a", "b"])

    now, shard = None, _Shard()
    for batch in batches:
        shards, visits, points = batch["shard"].to_numpy(), batch["visit"].to_numpy(zero_copy_only=False), batch["print"].to_numpy().view(np.uint64)
        keys = shards.astype(np.int64) * 2 + visits
        cuts = [0, *(np.flatnonzero(np.diff(keys)) + 1).tolist(), len(keys)]
        for low, high in zip(cuts, cuts[1:]):
            if low == high:
                continue
            if shards[low] != now:
                yield from batch_of(shard.ready())
                now, shard = shards[low], _Shard()
            if visits[low]:
                yield from batch_of(shard.ready())
                yield from batch_of(shard.visitors(points[low:high]))
            else:
                shard.parts.append(points[low:high].copy())
    yield from batch_of(shard.ready())


def print_links(points: DataFrame, shard: int = SHARD) -> DataFrame:
    """``(a, b)``: links between the distinct fingerprints ``points (print)`` that join the same classes as all links do."""
    n = points.count()
    shards = min(MAX_SHARDS, 1 << max(0, (n // shard)).bit_length())
    # A bounded sample in an order that every run repeats; a shard's tree does not depend on it.
    order = F.xxhash64("print", F.lit(7))
    sample = [r[0] for r in points.orderBy(order, "print").limit(shards * SAMPLE_PER_SHARD).select("print").collect()]
    tree = VantageTree(np.array(sample, np.int64).view(np.uint64), SAMPLE_PER_SHARD)
    routed = points.mapInArrow(_route(points.sparkSession.sparkContext.broadcast(tree)), "shard int, visit boolean, print long")
    return routed.repartition(shards, "shard").sortWithinPartitions("shard", "visit").mapInArrow(_links, "a long, b long")


def simhash_classes(docs: DataFrame, k: int = SHINGLE, shard: int = SHARD) -> DataFrame:
    """``(doc_id, print, component_id)``: fingerprint and smallest linked ``doc_id`` of every row of ``docs``."""
    prints = stored(fingerprints(docs, k), "simhash-prints")
    points = stored(prints.groupBy("print").agg(F.min("doc_id").alias("first")), "simhash-points")
    linked = connected_components(print_links(points.select("print"), shard))
    members = stored(points.join(linked.withColumnRenamed("node", "print"), "print"), "simhash-members")
    smallest = stored(members.groupBy("component").agg(F.min("first").alias("component_id")), "simhash-smallest")
    joined = members.join(smallest, "component").select("print", "component_id")
    classes = stored(points.join(joined, "print", "left").select("print", F.coalesce("component_id", "first").alias("component_id")), "simhash-classes")
    return prints.join(classes, "print").select("doc_id", "print", "component_id")
