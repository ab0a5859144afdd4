"""Benchmark decontamination: SimHash fingerprints of item-sized windows, found by multi-index Hamming search.

Windows.  Every word position of every document starts one window per size class in use; an item's class is the largest
of ``SIZES`` that is not longer than the item.  A window's 64-bit fingerprint is the bitwise majority of its words'
hashes, taken from running sums, so a position costs the same whatever the window's length.
An item has the fingerprints of its first, middle and last window of its class.

Search.  A 64-bit fingerprint is four blocks of 16 bits.  If two differ in at most ``RADIUS`` = 11 bits, some block differs in at
most 2.  Per class and block, a table of all 65,536 block values lists the item fingerprints within 2 bits, so looking up the
four blocks of a window finds every item fingerprint within the radius; the distance is then checked.

Anchors.  An edit in each of an item's windows can push all of them beyond the radius though the passage keeps enough shingles, so an
item of at least five words is looked for by its rarest shingles as well: as many as weigh more than 1 - ``threshold`` of all its
shingles together.  A passage that is enough like the item lacks less than that, so it holds one of them.  A row that holds
one is compared with the item over every stretch of the item's length and twice ``SLACK`` words.  So no passage is lost
before verification; shingles that many items share are no anchors of items that have others.

Verification.  The item's 5-word shingles are compared with those of the document around the window (the item's length and
``SLACK`` words on either side): the weight of the shared shingles over the weight of all the item's shingles, each
shingle weighing 1 / (number of items of the whole benchmark with it), must be at least ``threshold``.

The benchmark is the small side by nature: it is read whole to the driver, in at most ``MAX_ITEMS`` items at a time (a larger one is
searched in blocks of that many), and sent to every task; documents are read once per block of items and never shuffled.

Results for odd input: null or empty texts and items match nothing; an item of fewer than five words is one shingle and matches
where all its words stand; equal items are all reported; equal rows of documents are reported once with ``n_rows``; empty tables give
an empty result; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rulegrid.llm.shared import ship
from rulegrid.llm.words import Words, shingles, words_of

SIZES = (1, 2, 3, 4, 6, 8, 12, 16, 24, 32, 48, 64, 96, 128)
RADIUS = 11
BLOCKS, BLOCK_BITS, NEAR = 4, 16, 2
SHINGLE, THRESHOLD, SLACK = 5, 0.8, 4
MAX_ITEMS = 2000

_FLIPS = np.array([0, *(sum(1 << b for b in c) for k in (1, 2) for c in combinations(range(BLOCK_BITS), k))], np.uint16)


def running_bits(hashes: np.ndarray) -> np.ndarray:
    """Running counts of all 64 bits, as eight 64-bit numbers of eight byte-wide counters each, with a row of zeros first.

    Counters overflow into their neighbours, but differences over windows of up to 255 words are exact again.
    """
    bits = np.unpackbits(hashes.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1).view(np.uint64)
    out = np.zeros((len(hashes) + 1, 8), np.uint64)
    np.cumsum(bits, axis=0, out=out[1:])
    return out


def fingerprints(running: np.ndarray, size: int) -> np.ndarray:
    """Majority fingerprints of all windows of ``size`` words."""
    count = (running[size:] - running[:-size]).view(np.uint8)
    return np.packbits(count > size // 2, axis=1).view("<u8").ravel()


class Index:
    """Fingerprints of one size class: for each block, the fingerprints within ``NEAR`` bits of each block value."""

    def __init__(self, size: int):
        self.size = size
        self.longest = 0  # words of the longest item
        self.prints: list[int] = []
        self.owners: list[tuple[int, int]] = []  # item, offset of the window in it

    def add(self, item: int, words: np.ndarray) -> None:
        last = len(words) - self.size
        self.longest = max(self.longest, len(words))
        all_prints = fingerprints(running_bits(words), self.size)
        for offset in sorted({0, last // 2, last}):
            self.prints.append(int(all_prints[offset]))
            self.owners.append((item, offset))

    def close(self) -> Index:
        self.values = np.array(self.prints, np.uint64)
        self.tables = []
        for b in range(BLOCKS):
            own = ((self.values >> np.uint64(b * BLOCK_BITS)) & np.uint64(0xFFFF)).astype(np.uint16)
            near = (own[:, None] ^ _FLIPS[None]).ravel()
            which = np.repeat(np.arange(len(own)), len(_FLIPS))
            order = np.argsort(near, kind="stable")
            starts = np.searchsorted(near[order], np.arange(65537))
            self.tables.append((starts.astype(np.int32), which[order].astype(np.int32)))
        return self

    def search(self, found: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Pairs (position in ``found``, fingerprint number) within the radius."""
        at, which = [], []
        for b, (starts, near) in enumerate(self.tables):
            own = ((found >> np.uint64(b * BLOCK_BITS)) & np.uint64(0xFFFF)).astype(np.int64)
            first, n = starts[own], starts[own + 1] - starts[own]
            some = np.flatnonzero(n)
            n = n[some]
            pairs = np.repeat(some, n)
            inside = np.arange(len(pairs)) - np.repeat(np.cumsum(n) - n, n)
            item = near[np.repeat(first[some], n) + inside]
            close = np.bitwise_count(found[pairs] ^ self.values[item]) <= RADIUS
            at.append(pairs[close])
            which.append(item[close])
        return np.concatenate(at), np.concatenate(which)


def shingle_sets(items: list[tuple[int, np.ndarray]]) -> dict[int, list[int]]:
    return {item: np.unique(shingles(words, SHINGLE)).tolist() for item, words in items if len(words)}


def holders_of(items: list[tuple[int, np.ndarray]]) -> dict[int, int]:
    """For each shingle the number of items with it."""
    holders: dict[int, int] = {}
    for tokens in shingle_sets(items).values():
        for t in tokens:
            holders[t] = holders.get(t, 0) + 1
    return holders


class Anchors:
    """All shingles of a block's items, and for each the items that are looked for by it."""

    def __init__(self, known: dict[int, tuple[int, dict[int, float]]], threshold: float):
        self.tokens = np.array(sorted({t for _, weights in known.values() for t in weights}), np.uint64)
        self.own = {}  # per item, places of its shingles in ``tokens`` and their weights
        at, owners = [np.zeros(0, np.int64)], []
        for item, (length, weights) in known.items():
            if length < SHINGLE:
                continue  # its one window is the whole item
            place = np.searchsorted(self.tokens, np.array(list(weights), np.uint64))
            weight = np.array(list(weights.values()))
            self.own[item] = place, weight
            rarest = np.argsort(-weight, kind="stable")
            lack = (1 - threshold) * weight.sum() * (1 + 1e-9) + 1e-12
            chosen = rarest[: int(np.searchsorted(np.cumsum(weight[rarest]), lack, side="right")) + 1]
            at.append(place[chosen])
            owners += [item] * len(chosen)
        places = np.concatenate(at)
        order = np.argsort(places, kind="stable")
        self.owners = np.array(owners, np.int64)[order]
        self.starts = np.searchsorted(places[order], np.arange(len(self.tokens) + 1))

    def candidates(self, places: np.ndarray) -> list[int]:
        """Items with an anchor among the shingles at ``places``."""
        own = [self.owners[self.starts[p] : self.starts[p + 1]] for p in places.tolist()]
        return np.unique(np.concatenate(own)).tolist() if own else []


def build(items: list[tuple[int, np.ndarray]], holders: dict[int, int], threshold: float = THRESHOLD) -> tuple[list[Index], dict[int, tuple[int, dict[int, float]]], Anchors]:
    """Indexes by size class, per item its length and shingle weights, and the anchors.

    ``holders``: of the whole benchmark, so that a shingle weighs the same in every block of items."""
    indexes: dict[int, Index] = {}
    sets = shingle_sets(items)
    known = {}
    for item, words in items:
        if len(words):
            size = max(s for s in SIZES if s <= len(words))
            indexes.setdefault(size, Index(size)).add(item, words)
            known[item] = (len(words), {t: 1 / holders[t] for t in sets[item]})
    return [x.close() for _, x in sorted(indexes.items())], known, Anchors(known, threshold)


def best_stretch(places: np.ndarray, at: np.ndarray, own: np.ndarray, weight: np.ndarray, words: int) -> tuple[float, int]:
    """The largest share of an item's shingles in ``words`` words of a row, and where they begin.

    ``places`` and ``at``: the row's shingles that the benchmark has and their positions; ``own``: those of the item, in order."""
    if not len(own):
        return 0.0, 0
    which = np.minimum(np.searchsorted(own, places), len(own) - 1)
    chosen = own[which] == places
    which, at = which[chosen], at[chosen]
    total = math.fsum(weight)
    if not len(at) or at[-1] + SHINGLE - at[0] <= words:
        return math.fsum(weight[np.unique(which)]) / total, int(at[0]) if len(at) else 0
    best, have, inside, last = (0.0, 0), np.zeros(len(own), np.int64), 0.0, 0
    for first in range(len(at)):
        while last < len(at) and at[last] + SHINGLE - at[first] <= words:
            if not have[which[last]]:
                inside += weight[which[last]]
            have[which[last]] += 1
            last += 1
        if inside / total > best[0] - 1e-9:
            exact = math.fsum(weight[have > 0]) / total
            if exact > best[0]:
                best = exact, int(at[first])
        have[which[first]] -= 1
        if not have[which[first]]:
            inside -= weight[which[first]]
    return best


def _row_windows(part: Words, indexes: list[Index], known: dict, anchors: Anchors, threshold: float) -> Iterator[tuple[int, int, float, int]]:
    """``(row, item, similarity, start)`` of verified matches in a group of rows."""
    running = running_bits(part.hashes)
    of_row = part.row_of_word()
    best: dict[tuple[int, int], tuple[float, int]] = {}
    # Verification ends early where a candidate's surroundings hold no shingle of any item: its similarity is 0.
    marks = np.zeros(len(part.hashes) + 1, np.int64)
    tokens = anchors.tokens
    if len(part.hashes) >= SHINGLE and len(tokens):
        every = shingles(part.hashes, SHINGLE)
        at = np.minimum(np.searchsorted(tokens, every), len(tokens) - 1)
        marks[1 : len(every) + 1] = tokens[at] == every
        hits = np.flatnonzero(marks[1:])
        hits = hits[of_row[hits] == of_row[hits + SHINGLE - 1]]
        for hit in np.split(hits, np.flatnonzero(np.diff(of_row[hits])) + 1):
            row = int(of_row[hit[0]]) if len(hit) else 0
            for item in anchors.candidates(np.unique(at[hit])):
                own, weight = anchors.own[item]
                similarity, start = best_stretch(at[hit], hit, own, weight, known[item][0] + 2 * SLACK)
                if similarity >= threshold:
                    best[(row, item)] = (similarity, start - int(part.bounds[row]))
    np.cumsum(marks, out=marks)
    tried: set[tuple[int, int, int]] = set()
    for index in indexes:
        if len(part.hashes) < index.size:
            continue
        at, which = index.search(fingerprints(running, index.size))
        inside = of_row[at] == of_row[at + index.size - 1]
        if index.size >= SHINGLE:
            reach = index.longest + SLACK
            inside &= marks[np.minimum(at + reach, len(marks) - 1)] > marks[np.maximum(at - reach, 0)]
        for p, w in zip(at[inside].tolist(), which[inside].tolist()):
            item, offset = index.owners[w]
            length, weights = known[item]
            row = int(of_row[p])
            low, high = int(part.bounds[row]), int(part.bounds[row + 1])
            start = max(low, p - offset)
            if (row, item, start) in tried:
                continue
            tried.add((row, item, start))
            span = part.hashes[start : start + length] if length < SHINGLE else part.hashes[max(low, start - SLACK) : min(high, start + length + SLACK)]
            have = set(shingles(span, SHINGLE).tolist())
            similarity = math.fsum(x for t, x in weights.items() if t in have) / math.fsum(weights.values())
            old = best.get((row, item))
            if old is None or (similarity, -start) > (old[0], -old[1]):
                best[(row, item)] = (similarity, start - low)
    for (row, item), (similarity, start) in best.items():
        yield part.first + row, item, similarity, start


def _best(text: pa.Array, indexes, threshold: float) -> dict[tuple[int, int], tuple[float, int]]:
    """``(row, item): (similarity, start)`` of the matches in a column of texts."""
    classes, known, anchors, _ = indexes.value
    best: dict[tuple[int, int], tuple[float, int]] = {}  # pieces of one row overlap
    for part in words_of(text) if classes else ():
        for piece in _pieces(part, max((x.longest for x in classes), default=0)):
            for row, item, similarity, start in _row_windows(piece, classes, known, anchors, threshold):
                if similarity >= max(threshold, best.get((row, item), (0.0, 0))[0]):
                    best[row, item] = (similarity, start)
    return best


def _search(indexes, threshold: float) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = indexes.value[3]
        for batch in batches:
            rows = [(*key, *value) for key, value in _best(batch["text"], indexes, threshold).items()]
            ids = batch["doc_id"].take(pa.array([x[0] for x in rows], pa.int64())).cast(pa.int64())
            columns = [pa.array([names[x[1]] for x in rows], pa.int64()), pa.array([x[2] for x in rows], pa.float64()), pa.array([x[3] for x in rows], pa.int64())]
            yield pa.RecordBatch.from_arrays([ids, *columns], names=["doc_id", "item_id", "similarity", "start_word"])

    return run


def _without(indexes, threshold: float) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            clean = np.ones(batch.num_rows, bool)
            clean[[row for row, _ in _best(batch["text"].cast(pa.string()), indexes, threshold)]] = False
            yield batch.filter(pa.array(clean))

    return run


def _pieces(part: Words, longest: int, most: int = 200_000) -> Iterator[Words]:
    """A very long row in overlapping runs of words, so that the running counts stay small."""
    if len(part.bounds) > 2 or len(part.hashes) <= most:
        yield part
        return
    overlap = 2 * (longest + SLACK)
    for start in range(0, len(part.hashes), most):
        own = part.hashes[start : start + most + overlap]
        yield Words(part.first, np.array([0, len(own)]), own)


def find_leaks(docs: DataFrame, benchmark: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``(doc_id, item_id, similarity, n_rows)``: every document with a passage like a benchmark item, per item with the best
    similarity.  ``docs (doc_id, text)``, ``benchmark (item_id, text)``."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    found = None
    for index in _indexes(docs, benchmark, threshold):
        part = docs.mapInArrow(_search(index, threshold), "doc_id long, item_id long, similarity double, start_word long")
        found = part if found is None else found.union(part)
    return found.groupBy("doc_id", "item_id").agg(F.max("similarity").alias("similarity"), F.count(F.lit(1)).alias("n_rows"))


def _indexes(docs: DataFrame, benchmark: DataFrame, threshold: float) -> Iterator:
    """The index of each block of items, sent to the tasks.  Items go by number, so a null or repeated ``item_id`` is as good as any."""
    spark = ship(docs.sparkSession)
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text")).distinct().orderBy("item_id", "text").toArrow()
    pairs = list(enumerate(hashes for part in words_of(items["text"]) for _, hashes in part.rows()))
    names = dict(enumerate(items["item_id"].to_pylist()))
    holders = holders_of(pairs)
    for first in range(0, max(1, len(pairs)), MAX_ITEMS):
        yield spark.sparkContext.broadcast((*build(pairs[first : first + MAX_ITEMS], holders, threshold), names))


def without_leaks(docs: DataFrame, benchmark: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` without a passage like a benchmark item: what ``find_leaks`` finds, decided row by row where the row is
    read, so no row is shuffled or joined.  All columns and repeated rows stay."""
    clean = docs
    for index in _indexes(docs, benchmark, threshold):
        clean = clean.mapInArrow(_without(index, threshold), docs.schema)
    return clean
