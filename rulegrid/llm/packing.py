"""Sequence packing by non-negative least squares over length combinations.

A document is its token ids, then ``END``.  It is cut into pieces of ``WINDOW`` ids, which fill a sequence
each, and one rest.  The rests are packed by the histogram of their lengths in steps of ``STEP`` ids:

1. enumerate the shallow combinations (1 to 3 lengths) that fill a window exactly;
2. solve, by non-negative least squares, how often to use each so that the histogram is met, and round down;
3. pack what is left greedily on the histogram: the longest rest with the longest rests that still fit.
   Where none fits, a rest is cut at a step so that it fills the window.

All of that works on the histogram (at most ``WINDOW / STEP`` numbers), whatever the number of documents: the
result is a list of patterns with repeat counts, and the rest of rank r within its length takes the r-th place
that the patterns have for that length.  Ranks come from salted windows, so neither a length that a third of all
documents share nor a group of copies is gathered in one task.

Padding: a sequence wastes less than ``STEP`` ids per piece, plus one sequence at the end that may stay short.

Results for odd input: ``<|endoftext|>`` in a text is its added token; a null or empty text is one piece holding only ``END``; equal rows are packed each; an empty
table gives no pieces; a very long text gives its pieces one by one.
"""

from __future__ import annotations

import math
import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rulegrid.llm.shared import stored, with_row_id

WINDOW = 2048
STEP = 16
DEPTH = 3
END = 1
SALT_ROWS = 50_000
GROUP_BYTES = 8_000_000  # of text whose chunks are told apart at a time
PIECES = 2_000  # written at a time
ADDED, ADDED_ID = "<|endoftext|>", 50256  # the one added token of byte_bpe_50k.json, special and matched as it stands

_SPACES = [chr(c).encode() for c in range(0x3001) if chr(c).isspace()]  # the tokeniser's white space (and \x1c-\x1f) in UTF-8, 1 to 3 bytes
_SPACE_CODES = {n: np.array([int.from_bytes(x) for x in _SPACES if len(x) == n]) for n in (1, 2, 3)}
_IS_SPACE = np.isin(np.arange(256), _SPACE_CODES[1])


def _code(data: np.ndarray, at: np.ndarray, n: int) -> np.ndarray:
    """The ``n`` bytes from each place on as a number.  Beyond a character's own bytes it is no white space's, as UTF-8 tells first bytes from others."""
    return sum(data[(at + i) % len(data)].astype(np.int32) << 8 * (n - 1 - i) for i in range(n))


def _starts_with_space(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Whether the character at each place is white space."""
    found = _IS_SPACE[data[at]]
    wide = np.flatnonzero(data[at] >= 0x80)
    for n in (2, 3):
        found[wide] |= np.isin(_code(data, at[wide], n), _SPACE_CODES[n])
    return found


def _ends_with_space(data: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Whether the character before each place is white space."""
    found = _IS_SPACE[data[end - 1]]
    wide = np.flatnonzero(data[end - 1] >= 0x80)
    for n in (2, 3):
        found[wide] |= np.isin(_code(data, end[wide] - n, n), _SPACE_CODES[n])
    return found


def _flat(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all values of a large string or binary array without nulls, and the places where they start and end."""
    _, offsets, data = texts.buffers()
    offsets = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1] if len(texts) else np.zeros(1, np.int64)
    size = int(offsets[-1] - offsets[0])
    return np.frombuffer(data, np.uint8, size, int(offsets[0])) if size else np.zeros(0, np.uint8), offsets - offsets[0]


def _array(kind: pa.DataType, offsets: np.ndarray, data: np.ndarray) -> pa.Array:
    return pa.Array.from_buffers(kind, len(offsets) - 1, [None, pa.py_buffer(offsets), pa.py_buffer(data)])


class Ids:
    """Token ids of whole columns of texts: cut into chunks at white space, and each different chunk of a group tokenised once.

    No pre-token runs on into white space, so one always starts at a space or line end that follows another
    character: the ids of a text are those of its chunks, joined.  For the same reason the different chunks are
    tokenised as one text, in which a line end goes before those that do not start with white space themselves.
    """

    def __init__(self, vocabulary: str):
        import base64

        import public_tokenizers
        import tiktoken

        with open(vocabulary, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.encoding = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.sizes = np.zeros(max(ranks.values()) + 1, np.int64)
        self.sizes[list(ranks.values())] = list(map(len, ranks))

    def of(self, text: str) -> np.ndarray:
        return self.column(pa.array([text]), added=False)[0]

    def with_added(self, text: str) -> np.ndarray:
        """Ids as the tokeniser gives them at its defaults: the added token is found first, and ``of`` the texts between."""
        return self.column(pa.array([text]))[0]

    def column(self, texts: pa.Array, added: bool = True, end: tuple[int, ...] = ()) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts, each followed by ``end``, and the places where the texts' ids start and end."""
        data, offsets = _flat(texts.fill_null("").cast(pa.large_string()))
        at = np.flatnonzero((data == 0x20) | (data == 0x0A))
        is_cut = np.zeros(len(data) + 1, bool)
        is_cut[at[~_ends_with_space(data, at)]] = True
        is_cut[offsets] = True
        if added:
            found = np.array([m.start() for m in re.finditer(re.escape(ADDED.encode()), data)], np.int64)
            after = offsets[np.searchsorted(offsets, found, "right")]  # the end of the text that it starts in
            found = found[found + len(ADDED) <= after]
            is_cut[found] = is_cut[found + len(ADDED)] = True
        cuts = np.flatnonzero(is_cut)  # an empty text has none of its own
        chunks = _array(pa.large_string(), cuts, data).dictionary_encode()
        ids = pa.concat_arrays([self._each(chunks.dictionary, added), pa.array([np.array(end, np.uint16).tobytes()], pa.large_binary())])
        last = np.searchsorted(cuts, offsets[1:])
        flat, places = _flat(ids.take(pa.array(np.insert(chunks.indices.to_numpy(), last, len(ids) - 1))))
        return flat.view(np.uint16), places[np.append(0, last + np.arange(1, len(last) + 1))] // 2

    def _each(self, chunks: pa.Array, added: bool) -> pa.Array:
        """The ids of each chunk, as bytes.  Few chunks go to the tokeniser alone: the added token, and those that white space ends or, other than a space or line end, starts."""
        data, offsets = _flat(chunks)
        first, end = offsets[:-1], offsets[1:]
        own_space = np.isin(data[first], (0x20, 0x0A))
        alone = _ends_with_space(data, end) | ~own_space & _starts_with_space(data, first)
        if added:
            alone |= pc.equal(chunks, pa.scalar(ADDED, pa.large_string())).to_numpy(zero_copy_only=False)
        own = np.flatnonzero(~alone)
        joined = pc.binary_join_element_wise(pa.array(np.where(own_space[own], "", "\n"), pa.large_string()), chunks.take(pa.array(own)), pa.scalar("", pa.large_string()))
        text, places = _flat(joined)
        ids = np.array(self.encoding.encode_ordinary(text.tobytes().decode()), np.uint16)
        sizes = np.append(0, np.cumsum(self.sizes[ids]))  # of the text up to each id
        ends = np.searchsorted(sizes, places)
        if not np.array_equal(sizes[ends], places):
            raise ValueError("a token runs on into white space")
        marks = ~own_space[own]
        ids = np.delete(ids, ends[:-1][marks])  # the line ends put in, a token each
        ends -= np.append(0, np.cumsum(marks))
        several = [self._alone(c, added) for c in chunks.filter(pa.array(alone)).to_pylist()]
        out = pa.concat_arrays([_array(pa.large_binary(), 2 * ends, ids), pa.array(several, pa.large_binary())])
        return out.take(pa.array(np.argsort(np.append(own, np.flatnonzero(alone)))))

    def _alone(self, chunk: str, added: bool) -> bytes:
        return np.array([ADDED_ID] if added and chunk == ADDED else self.encoding.encode_ordinary(chunk), np.uint16).tobytes()


_IDS: dict[str, Ids] = {}


def ids_of(vocabulary: str) -> Ids:
    if vocabulary not in _IDS:
        _IDS[vocabulary] = Ids(vocabulary)
    return _IDS[vocabulary]


_PIECES = "doc_id long, start long, length int, doc_tokens long, ids binary"


def _groups(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """The rows in groups of some ``GROUP_BYTES`` of text; a longer text is one alone."""
    sizes = np.append(0, np.cumsum(pc.fill_null(pc.binary_length(batch["text"]), 0).to_numpy().astype(np.int64)))
    first = 0
    while first < len(batch):
        last = max(first + 1, int(np.searchsorted(sizes, sizes[first] + GROUP_BYTES, "right")) - 1)
        yield batch.slice(first, last - first)
        first = last


def _tokenise(vocabulary: str) -> Callable:
    """Pieces of at most ``WINDOW`` ids, as little-endian 16-bit numbers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows in _groups(batch):
                ids, places = ids_of(vocabulary).column(rows["text"], end=(END,))
                sizes = np.diff(places)
                n = -(-sizes // WINDOW)
                row = np.repeat(np.arange(len(rows)), n)
                start = WINDOW * (np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n))
                length = np.minimum(sizes[row] - start, WINDOW)
                cut = np.append(places[row] + start, len(ids))  # the pieces follow one another
                for i in range(0, len(row), PIECES):
                    j = min(i + PIECES, len(row))
                    offsets = (2 * (cut[i : j + 1] - cut[i])).astype(np.int32)
                    columns = (rows["doc_id"].take(pa.array(row[i:j])), start[i:j], length[i:j].astype(np.int32), sizes[row[i:j]], _array(pa.binary(), offsets, ids[cut[i] : cut[j]]))
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["doc_id", "start", "length", "doc_tokens", "ids"])

    return run


def nonnegative_least_squares(a: np.ndarray, b: np.ndarray, rounds: int = 3000) -> np.ndarray:
    """``x >= 0`` that minimises ``|a x - b|``, by accelerated projected gradients."""
    step = 1.0 / max(np.linalg.norm(a, 2) ** 2, 1e-12)
    x = y = np.zeros(a.shape[1])
    t = 1.0
    for _ in range(rounds):
        new = np.maximum(0.0, y - step * (a.T @ (a @ y - b)))
        t, before = (1 + math.sqrt(1 + 4 * t * t)) / 2, t
        y = new + (before - 1) / t * (new - x)
        if np.abs(new - x).max(initial=0) < 1e-9 * max(1.0, np.abs(new).max(initial=0)):
            return new
        x = new
    return x


def combinations(steps: int, present: list[int], depth: int = DEPTH) -> list[tuple[int, ...]]:
    """All non-increasing tuples of up to ``depth`` present lengths with the sum ``steps``."""
    here, out = set(present), []

    def grow(left: int, most: int, so_far: tuple[int, ...]) -> None:
        if left == 0:
            out.append(so_far)
            return
        if len(so_far) == depth:
            return
        if len(so_far) == depth - 1:
            if left <= most and left in here:
                out.append((*so_far, left))
            return
        for n in present:
            if n <= most and n <= left:
                grow(left - n, n, (*so_far, n))

    grow(steps, steps, ())
    return out


def plan_patterns(histogram: dict[int, int], steps: int = WINDOW // STEP) -> list[tuple[tuple[tuple[int, int, int], ...], int]]:
    """Patterns ``((length, cut, from), ...)`` with repeat counts that use up the histogram.

    ``(length, cut, from)``: a rest of ``length`` steps is placed from its step ``from`` on, for ``cut`` steps (its
    last piece up to its end).  A rest that is cut appears with its first part in one pattern and with the other
    part in a later one; both refer to the same rank of the same original length.
    """
    left = {n: c for n, c in sorted(histogram.items()) if c > 0}
    patterns: list[tuple[tuple[tuple[int, int, int], ...], int]] = []
    present = sorted(left)
    found = combinations(steps, present) if present else []
    if found:
        place = {n: i for i, n in enumerate(present)}
        a = np.zeros((len(present), len(found)))
        for j, combination in enumerate(found):
            for n in combination:
                a[place[n], j] += 1
        b = np.array([left[n] for n in present], float)
        x = np.floor(nonnegative_least_squares(a, b) + 1e-6).astype(int)
        for j in np.argsort(-x):
            combination = found[j]
            need = {n: combination.count(n) for n in combination}
            times = min(int(x[j]), *(left[n] // k for n, k in need.items()))
            if times > 0:
                patterns.append((tuple((n, n, 0) for n in combination), times))
                for n, k in need.items():
                    left[n] -= k * times
    # Greedy: keys are (steps left, original length, step it starts from), so that cut rests stay distinct.
    rest = {(n, n, 0): c for n, c in left.items() if c}
    while rest:
        first = max(rest)
        free, members, used = steps - first[0], [first], {first: 1}
        while free:
            fits = [k for k in rest if k[0] <= free and rest[k] > used.get(k, 0)]
            if not fits:
                break
            best = max(fits)
            members.append(best)
            used[best] = used.get(best, 0) + 1
            free -= best[0]
        cut = None
        if free:  # cut a longer rest so that the window is full
            longer = [k for k in rest if k[0] > free and rest[k] > used.get(k, 0)]
            if longer:
                cut = max(longer, key=lambda k: (rest[k] - used.get(k, 0), k))
                used[cut] = used.get(cut, 0) + 1
        times = min(rest[k] // n for k, n in used.items())
        places = [(k[1], k[0], k[2]) for k in members]
        if cut:
            places.append((cut[1], free, cut[2]))
        patterns.append((tuple(places), times))
        for k, n in used.items():
            rest[k] -= n * times
        if cut:
            piece = (cut[0] - free, cut[1], cut[2] + free)
            rest[piece] = rest.get(piece, 0) + times
        rest = {k: c for k, c in rest.items() if c}
    return patterns


def _slots(patterns: list) -> list[tuple[int, int, int, int, int, int, int]]:
    """Ranges of ranks: ``(length, from, cut, first_rank, times, first_sequence, order)``.

    Ranks ``first_rank + i`` of the rests of ``length`` (in steps) place their part ``[from, from + cut)`` in
    sequence ``first_sequence + i`` as its ``order``-th piece.  Parts of one rest keep its rank because a cut part
    is used first in, first out: the k-th rest cut at ``from`` is the k-th to continue there.
    """
    used: dict[tuple[int, int], int] = {}
    waiting: dict[tuple[int, int], list[tuple[int, int]]] = {}
    out, sequence = [], 0
    for places, times in patterns:
        for order, (length, cut, start) in enumerate(places):
            if start == 0:
                ranks = [(used.get((length, 0), 0), times)]
                used[(length, 0)] = ranks[0][0] + times
            else:
                ranks, need, queue = [], times, waiting[(length, start)]
                while need:
                    first, n = queue[0]
                    take = min(n, need)
                    ranks.append((first, take))
                    need -= take
                    if take == n:
                        queue.pop(0)
                    else:
                        queue[0] = (first + take, n - take)
            at = sequence
            for first, n in ranks:
                out.append((length, start, cut, first, n, at, order))
                at += n
                if start + cut < length:
                    waiting.setdefault((length, start + cut), []).append((first, n))
        sequence += times
    return out


def pack(docs: DataFrame, vocabulary: str, window: int = WINDOW) -> DataFrame:
    """``(doc_id, start, length, doc_tokens, sequence_id, offset, ids)``: the pieces of ``docs (doc_id, text)``.

    ``ids``: the piece's ids as little-endian 32-bit numbers.
    """
    spark = docs.sparkSession
    named = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    pieces = stored(with_row_id(named.mapInArrow(_tokenise(vocabulary), _PIECES), "piece"), "packing-pieces")
    rests = pieces.where(F.col("length") < window)
    steps = F.ceil(F.col("length") / STEP).cast("int")
    histogram = {r["n"]: r["c"] for r in rests.groupBy(steps.alias("n")).agg(F.count(F.lit(1)).alias("c")).collect()}
    slots = _slots(plan_patterns(histogram, window // STEP))
    salts = max(1, sum(histogram.values()) // SALT_ROWS)
    salted = stored(
        rests.select("piece", "doc_id", "length", steps.alias("n"), F.pmod(F.xxhash64("piece"), F.lit(salts)).alias("salt"))
        .withColumn("i", F.row_number().over(Window.partitionBy("n", "salt").orderBy("doc_id", "piece")) - 1),
        "packing-ranks",
    )
    before = Window.partitionBy("n").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)
    firsts = salted.groupBy("n", "salt").agg(F.count(F.lit(1)).alias("c")).withColumn("first", F.coalesce(F.sum("c").over(before), F.lit(0)))
    ranked = salted.join(firsts.select("n", "salt", "first"), ["n", "salt"]).select("piece", "length", "n", (F.col("first") + F.col("i")).alias("rank"))
    # The slots are as many as patterns have places (bounded by the lengths, not by the documents), so they go to every task.
    plan = ranked.mapInArrow(_place(spark.sparkContext.broadcast(slots)), "piece long, skip int, take int, seq long, ord int")
    plan = stored(plan, "packing-plan")
    order = Window.partitionBy("seq").orderBy("ord")
    placed = plan.withColumn("offset", F.coalesce(F.sum("take").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    sequences = max((at + n for _, _, _, _, n, at, _ in slots), default=0)
    # Both sides grow with the documents: one way to join them at every size.
    parts = rests.join(placed.hint("merge"), "piece").select(
        "doc_id", (F.col("start") + F.col("skip")).alias("start"), F.col("take").cast("long").alias("length"), "doc_tokens",
        F.col("seq").alias("sequence_id"), F.col("offset").cast("long").alias("offset"),
        F.expr("substring(ids, 2 * skip + 1, 2 * take)").alias("ids"),
    )
    full = pieces.where(F.col("length") == window).select(
        "doc_id", "start", F.col("length").cast("long"), "doc_tokens", (F.col("piece") + F.lit(sequences)).alias("sequence_id"), F.lit(0).cast("long").alias("offset"), "ids"
    )
    return full.union(parts).mapInArrow(_widen, "doc_id long, start long, length long, doc_tokens long, sequence_id long, offset long, ids binary")


def _place(slots) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        by_length: dict[int, np.ndarray] = {}
        for length, start, cut, first, n, at, order in slots.value:
            by_length.setdefault(length, []).append((first, n, start, cut, at, order))
        by_length = {k: np.array(v, np.int64) for k, v in by_length.items()}
        for batch in batches:
            piece, length, n, rank = (batch[c].to_numpy() for c in ("piece", "length", "n", "rank"))
            out: list[list[np.ndarray]] = [[] for _ in range(5)]
            for steps in np.unique(n):
                own = np.flatnonzero(n == steps)
                for first, count, start, cut, at, order in by_length[int(steps)]:
                    rows = own[(rank[own] >= first) & (rank[own] < first + count)]
                    if len(rows):
                        skip = np.full(len(rows), start * STEP)
                        take = np.full(len(rows), cut * STEP) if start + cut < steps else length[rows] - start * STEP
                        for column, value in zip(out, (piece[rows], skip, take, at + rank[rows] - first, np.full(len(rows), order))):
                            column.append(value)
            kinds = (pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int32())
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c) if c else [], k) for c, k in zip(out, kinds)], names=["piece", "skip", "take", "seq", "ord"])

    return run


def _widen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids, places = _flat(batch["ids"].cast(pa.large_binary()))
        wide = _array(pa.binary(), (2 * places).astype(np.int32), ids.view("<u2").astype("<u4"))
        yield batch.set_column(batch.schema.get_field_index("ids"), "ids", wide)
