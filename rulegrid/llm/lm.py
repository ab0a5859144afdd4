"""A language model by deleted interpolation over words, and its scores of texts.

Tokens are the words of a text, then one end; two ends stand before it.  Orders 0 to 3 are 1 / (V + 1), and the maximum-likelihood
estimates c(w) / N, c(v w) / c(v) and c(u v w) / c(u v) from the counts of every word, pair and triple of all training texts, so what is
gathered grows with the corpus.  They are mixed by weights per bucket: the power of two of the triple's context frequency, or, where that
context was never seen, whether the pair's context was.  The weights come from expectation-maximisation on a tenth of the training texts,
against the counts without these texts.  An order whose context was never seen has no weight, so the mixture adds up to 1.

How the counts reach the texts:

* texts are cut into blocks of ``BLOCK_TOKENS`` tokens, written once (a longer text is spread over blocks, two tokens repeated in front);
* a block sends its distinct n-grams with their counts, cut by ranges of the n-gram's hash; one task adds up one range.  An n-gram comes
  from a block once, however frequent it is, so no key is hot, and ranges of a hash hold equal shares;
* the totals go back to their block in the order in which it sent the n-grams, without them; the counts at each of its tokens are written,
  with the events of its deleted texts;
* both ways are gone in ``2 ** TURN_BITS`` turns, by hash range and by block, each of which drops its shuffle files before the next: disk
  holds blocks, totals, counts and one turn's shuffle.

N-grams are known by their order and a hash of ``SPARE - 2`` more bits than it takes to number them all, so one in 2 ** 26 or fewer, at every
size, shares its number with another.  ``RANGE`` n-grams are added up in one task.

Results for odd input: a null or empty text is one end token; equal rows are scored each; a null doc_id is in the training part;
without any training text every count is 0 and every token has probability 1; without texts in the deleted tenth the weights are equal;
an empty table gives no rows; very long texts are read in parts and held as 8 bytes a word while they are cut; other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rulegrid.llm.shared import delete_tables, dropping_shuffles, ship, stored, tables_written
from rulegrid.llm.words import mix, words_of

END = np.uint64(0x5EED0E4D)
BLOCK_TOKENS = 1 << 20
RANGE = 1 << 22
SPARE = 28
TURN_BITS = 2
CONTEXTS = 48  # buckets of contexts seen, by the power of two of their frequency
PAIR_ONLY, UNSEEN = CONTEXTS, CONTEXTS + 1
BUCKETS, STEPS = CONTEXTS + 2, 128
HELD_OUT, DELETED = 0, 1


def part_of(doc_id: int | None) -> int:
    """crc32 of the id as text, modulo 10; texts of part 0 are held out, part 1 of the rest is deleted for the weights."""
    return -1 if doc_id is None else zlib.crc32(str(doc_id).encode()) % 10


def squeeze(values: np.ndarray) -> bytes:
    """64-bit numbers as compressed bytes, those of equal place in their numbers together."""
    raw = np.ascontiguousarray(values.view(np.uint8).reshape(-1, 8).T).tobytes()
    return len(raw).to_bytes(8, "little") + pa.compress(raw, "zstd", asbytes=True)


def unsqueeze(data: bytes, kind: type = np.int64) -> np.ndarray:
    size = int.from_bytes(data[:8], "little")
    raw = pa.decompress(data[8:], size, "zstd", asbytes=True)
    return np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(8, -1).T).view(kind).ravel()


# Blocks: fragments of texts, each after two tokens of history.

_BLOCK = "block long, train long, deleted long, train_ends long, deleted_ends long, words binary, tokens binary, bounds binary, rids binary, parts binary, doc_ids array<long>"
_BLOCK_NAMES = [c.split()[0] for c in _BLOCK.split(", ")]


class _Block:
    def __init__(self, number: int):
        self.number, self.size = number, 0
        self.tokens: list[np.ndarray] = []
        self.sizes: list[np.ndarray] = []
        self.rids: list[np.ndarray] = []
        self.parts: list[np.ndarray] = []
        self.ids: list[pa.Array] = []

    def add(self, tokens: np.ndarray, sizes: np.ndarray, rids: np.ndarray, parts: np.ndarray, ids: pa.Array) -> None:
        for held, new in ((self.tokens, tokens), (self.sizes, sizes), (self.rids, rids), (self.parts, parts), (self.ids, ids)):
            held.append(new)
        self.size += len(tokens)

    def row(self) -> pa.RecordBatch:
        tokens, parts = np.concatenate(self.tokens), np.concatenate(self.parts)
        bounds = np.concatenate([[0], np.cumsum(np.concatenate(self.sizes))])
        _, real = _places(bounds)
        of = np.repeat(parts, np.diff(bounds))
        chosen = [real & (of != HELD_OUT), real & (of == DELETED)]
        words, index = np.unique(tokens, return_inverse=True)
        numbers = [self.number, *(int(c.sum()) for c in chosen), *(int((tokens[c] == END).sum()) for c in chosen)]
        arrays = [squeeze(x) for x in (words, index.astype(np.int64), bounds, np.concatenate(self.rids), parts)]
        ids = pa.concat_arrays(self.ids)
        columns = [*[pa.array([x], pa.int64()) for x in numbers], *[pa.array([x], pa.binary()) for x in arrays], pa.ListArray.from_arrays([0, len(ids)], ids)]
        return pa.RecordBatch.from_arrays(columns, names=_BLOCK_NAMES)


def _places(bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The places after the first of each fragment, and those of its own tokens (after the two of history)."""
    later = np.ones(int(bounds[-1]), bool)
    later[bounds[:-1]] = False
    real = later.copy()
    real[bounds[:-1] + 1] = False
    return later, real


def _blocks(size: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rid = number = TaskContext.get().partitionId() << 33
        block = _Block(number)
        for batch in batches:
            ids = batch["doc_id"].cast(pa.int64())
            parts = np.array([part_of(x) for x in ids.to_pylist()], np.int64)
            for group in words_of(batch["text"]):
                n = len(group.bounds) - 1
                tokens = np.full(len(group.hashes) + 3 * n, END)
                tokens[np.arange(len(group.hashes)) + 3 * group.row_of_word() + 2] = group.hashes
                part, own = parts[group.first : group.first + n], ids.slice(group.first, n)
                if n > 1 or len(tokens) <= size:
                    fragments = [(tokens, np.diff(group.bounds) + 3)]
                else:
                    cuts = [tokens[at - 2 : at + size] for at in range(2, len(tokens), size)]
                    fragments = [(x, np.array([len(x)])) for x in cuts]
                for piece, sizes in fragments:
                    block.add(piece, sizes, np.arange(rid, rid + n), part, own)
                    if block.size >= size:
                        yield block.row()
                        number += 1
                        block = _Block(number)
                rid += n
        if block.size:
            yield block.row()

    return run


# Counts.


def _ngrams(tokens: np.ndarray, bounds: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Words and pairs that end after the first place of a fragment, and triples that end at its own tokens, as numbers of ``width`` bits."""
    later, real = _places(bounds)
    pair = tokens.copy()
    pair[1:] = mix(tokens[:-1] * np.uint64(0x9E3779B185EBCA87) + tokens[1:])
    triple = tokens.copy()
    triple[1:] = mix(pair[:-1] * np.uint64(0xC2B2AE3D27D4EB4F) + tokens[1:])
    return tuple((mix(x[at]) >> np.uint64(64 - width) & ~np.uint64(3)) | np.uint64(order) for order, x, at in ((1, tokens, later), (2, pair, later), (3, triple, real)))


def _open(row: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Tokens, fragment bounds and parts of a block."""
    tokens = unsqueeze(row["words"], np.uint64)[unsqueeze(row["tokens"])]
    return tokens, unsqueeze(row["bounds"]), unsqueeze(row["parts"])


def _runs(order: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``values`` in the order given, which sorts them, and where each new one starts."""
    values = values[order]
    return values, np.flatnonzero(np.append(True, values[1:] != values[:-1]))


def _send(bits: int, width: int, turn: int = 0, turn_bits: int = 0) -> Callable:
    """``(part, block, grams, n, deleted)``: a block's distinct n-grams of one range of hashes, and their counts in its training texts.

    Of 2 ** bits ranges, those whose first ``turn_bits`` bits are ``turn``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(len(batch)):
                one = {c: batch[c][row].as_py() for c in ("block", "words", "tokens", "bounds", "parts")}
                tokens, bounds, parts = _open(one)
                grams = np.concatenate(_ngrams(tokens, bounds, width))
                later, real = _places(bounds)
                of = np.where(real, np.repeat(parts, np.diff(bounds)), HELD_OUT)
                of = np.concatenate([of[later], of[later], of[real]])
                if turn_bits:
                    own = grams >> np.uint64(width - turn_bits) == turn
                    grams, of = grams[own], of[own]
                if not len(grams):
                    continue
                order = np.argsort(grams)
                grams, first = _runs(order, grams)
                grams, of = grams[first], of[order]
                counts = [np.add.reduceat(chosen.astype(np.int64), first) for chosen in (of != HELD_OUT, of == DELETED)]
                ranges = (grams >> np.uint64(width - bits)).astype(np.int64)
                first = np.flatnonzero(np.append(True, ranges[1:] != ranges[:-1]))
                cuts = [slice(a, b) for a, b in zip(first, [*first[1:], len(grams)])]
                sent = [[squeeze(np.diff(grams[c], prepend=np.uint64(0))) for c in cuts], *[[squeeze(x[c]) for c in cuts] for x in counts]]
                columns = [pa.array(ranges[first].astype(np.int32)), pa.array([one["block"]] * len(cuts), pa.int64()), *[pa.array(x, pa.binary()) for x in sent]]
                yield pa.RecordBatch.from_arrays(columns, names=["part", "block", "grams", "n", "deleted"])

    return run


_TOTALS = "part int, block long, known long, n binary, deleted binary"


def _add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One range of hashes: the totals of every block's n-grams in the order sent; a row without a block holds the number of known words."""
    rows = [x for batch in batches for x in batch.to_pylist()]
    if not rows:
        return
    sent = [np.cumsum(unsqueeze(x["grams"], np.uint64), dtype=np.uint64) for x in rows]
    grams, inverse = np.unique(np.concatenate(sent), return_inverse=True)
    totals = []
    for name in ("n", "deleted"):
        # Sums of whole numbers in doubles are exact below 2 ** 53.
        totals.append(np.bincount(inverse, np.concatenate([unsqueeze(x.pop(name)) for x in rows]), len(grams)).astype(np.int64))
    known = int((((grams & np.uint64(3)) == 1) & (totals[0] > 0)).sum())
    names = [c.split()[0] for c in _TOTALS.split(", ")]
    kinds = [pa.int32(), pa.int64(), pa.int64(), pa.binary(), pa.binary()]
    yield pa.RecordBatch.from_arrays([pa.array([x], k) for x, k in zip((rows[0]["part"], None, known, None, None), kinds)], names=names)
    at = 0
    for row, own in zip(rows, sent):
        back = inverse[at : at + len(own)]
        at += len(own)
        values = (row["part"], row["block"], None, *(squeeze(x[back]) for x in totals))
        yield pa.RecordBatch.from_arrays([pa.array([x], k) for x, k in zip(values, kinds)], names=names)


_COUNTED = "block long, n binary, bounds binary, fresh binary, rids binary, parts binary, doc_ids array<long>, event array<long>, events array<long>"


def _give_back(width: int, lessened: tuple[int, int, int], block: pa.Table, totals: pa.Table) -> pa.Table:
    """A block's counts at every place of its fragments: words, pairs and triples that end there (0 where there is none); and the
    events of its deleted texts, against the counts without them."""
    row = block.to_pylist()[0]
    tokens, bounds, parts = _open(row)
    words, pairs, triples = _ngrams(tokens, bounds, width)
    grams = np.concatenate([words, pairs, triples])
    order = np.argsort(grams)
    sizes = np.diff(_runs(order, grams)[1], append=len(grams))
    later, real = _places(bounds)
    by_part = totals.sort_by("part")

    def spread(name: str) -> np.ndarray:
        total = np.empty(len(grams), np.int64)
        total[order] = np.repeat(np.concatenate([unsqueeze(x) for x in by_part[name].to_pylist()]), sizes)
        out = np.zeros((3, len(tokens)), np.int64)
        out[0, later], out[1, later], out[2, real] = np.split(total, [len(words), len(words) + len(pairs)])
        return out

    fresh = ((tokens[bounds[:-1]] == END) & (tokens[bounds[:-1] + 1] == END)).astype(np.int64)
    n, event, events = spread("n"), [], []
    if (parts == DELETED).any():
        bucket, p = estimates(n - spread("deleted"), bounds, fresh, *lessened)
        event, events = np.unique(event_of(bucket, p)[np.repeat(parts == DELETED, np.diff(bounds) - 2)], return_counts=True)
    out = [row["block"], squeeze(n.ravel()), row["bounds"], squeeze(fresh), row["rids"], row["parts"], row["doc_ids"], event, events]
    kinds = [pa.int64(), *[pa.binary()] * 5, *[pa.list_(pa.int64())] * 3]
    return pa.Table.from_arrays([pa.array([x], k) for x, k in zip(out, kinds)], names=[c.split()[0] for c in _COUNTED.split(", ")])


# The model.


def estimates(counts: np.ndarray, bounds: np.ndarray, fresh: np.ndarray, tokens: int, texts: int, known: int) -> tuple[np.ndarray, np.ndarray]:
    """Bucket of every own token of the fragments, and its probability by orders 0 to 3."""
    _, real = _places(bounds)
    before = np.zeros_like(counts[:2])
    before[:, 1:] = counts[:2, :-1]
    before[1, bounds[:-1][fresh > 0] + 2] = texts  # two ends, the history of a text's first token
    own, pair, triple = counts[:, real], before[0, real], before[1, real]
    ratios = [x / np.maximum(y, 1) for x, y in ((own[0], np.int64(tokens)), (own[1], pair), (own[2], triple))]
    bucket = np.minimum(np.log2(np.maximum(triple, 1)).astype(np.int64), CONTEXTS - 1)
    bucket = np.where(triple > 0, bucket, np.where(pair > 0, PAIR_ONLY, UNSEEN))
    return bucket, np.stack([np.full(own.shape[1], 1 / (known + 1)), *ratios])


def _fragments(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        for i in range(len(batch)):
            row = {c: batch[c][i].as_py() for c in batch.schema.names}
            yield {**row, **{c: unsqueeze(row[c]) for c in ("bounds", "fresh", "rids", "parts")}}


def event_of(bucket: np.ndarray, p: np.ndarray) -> np.ndarray:
    """Bucket and the estimates of orders 1 to 3 in half steps of a power of two (0: impossible), as one number."""
    step = np.where(p > 0, np.minimum(np.floor(-2 * np.log2(np.maximum(p, 1e-30))) + 1, STEPS - 1), 0).astype(np.int64)
    return ((bucket * STEPS + step[1]) * STEPS + step[2]) * STEPS + step[3]


def mixture(event: np.ndarray, n: np.ndarray, known: int, rounds: int = 40) -> np.ndarray:
    """Weights of the orders per bucket, by expectation-maximisation; a bucket without events takes the weights over all."""

    def learn(p: np.ndarray, n: np.ndarray) -> np.ndarray:
        weights = np.full(4, 0.25)
        for _ in range(rounds):
            joint = weights[:, None] * p
            total = (joint / np.maximum(joint.sum(0), 1e-300) * n).sum(1)
            weights = np.maximum(total / max(total.sum(), 1e-300), 1e-6)
            weights /= weights.sum()
        return weights

    steps = np.stack([(event // STEPS**k) % STEPS for k in (2, 1, 0)])
    p = np.concatenate([np.full((1, len(event)), 1 / (known + 1)), np.where(steps > 0, 2.0 ** (-(steps - 0.5) / 2), 0)])
    bucket = event // STEPS**3
    out = np.tile(learn(p, n) if len(event) else np.full(4, 0.25), (BUCKETS, 1))
    for b in np.unique(bucket):
        out[b] = learn(p[:, bucket == b], n[bucket == b])
    out[PAIR_ONLY, 3] = 0
    out[UNSEEN, 2:] = 0
    if not known:
        out[:, 1:] = 0
    return out / out.sum(1, keepdims=True)


_SCORED = "rid long, doc_id long, part long, n_tokens long, n_known long, base_log double, score double"


def _score(weights: np.ndarray, tokens: int, texts: int, known: int) -> Callable:
    """One row per fragment."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in _fragments(batches):
            bounds, counts = block["bounds"], unsqueeze(block["n"]).reshape(3, -1)
            bucket, p = estimates(counts, bounds, block["fresh"], tokens, texts, known)
            own = counts[0, _places(bounds)[1]]
            starts = bounds[:-1] - 2 * np.arange(len(bounds) - 1)
            sums = [np.add.reduceat(x, starts) for x in ((own > 0).astype(np.int64), np.log10(own + 0.1), np.log10((weights[bucket].T * p).sum(0)))]
            columns = [block["rids"], pa.array(block["doc_ids"], pa.int64()), block["parts"], np.diff(bounds) - 2, *sums]
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in columns], names=[c.split()[0] for c in _SCORED.split(", ")])

    return run


def score_texts(docs: DataFrame) -> DataFrame:
    """``(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score)`` per row of ``docs (doc_id, text)``."""
    spark = ship(docs.sparkSession)
    done = tables_written()
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    blocks = stored(docs.mapInArrow(_blocks(BLOCK_TOKENS), _BLOCK), "lm-blocks")
    total = [F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("train", "deleted", "train_ends", "deleted_ends")]
    size = blocks.agg(*total).first()
    # Upper bound of the n-grams: three a token, held-out ones being a tenth more.
    grams = max(1, 3.4 * size["train"])
    bits, width = max(0, int(np.ceil(np.log2(grams / RANGE)))), min(64, int(np.ceil(np.log2(grams))) + SPARE)
    turn_bits = min(TURN_BITS, bits)
    lessened = int(size["train"] - size["deleted"]), int(size["train_ends"] - size["deleted_ends"])
    with dropping_shuffles(spark):
        totals = []
        for turn in range(2**turn_bits):
            sent = blocks.mapInArrow(_send(bits, width, turn, turn_bits), "part int, block long, grams binary, n binary, deleted binary")
            dealt = sent.repartitionById(2 ** (bits - turn_bits), F.col("part") % 2 ** (bits - turn_bits))
            totals.append(stored(dealt.mapInArrow(_add_up, _TOTALS), "lm-totals"))
        totals = reduce(DataFrame.unionAll, totals)
        known = int(totals.where("block is null").agg(F.coalesce(F.sum("known"), F.lit(0))).first()[0])
        counted, read = [], tables_written()
        for turn in range(2**turn_bits):
            own = F.pmod(F.xxhash64("block"), F.lit(2**turn_bits)) == turn
            back = totals.where("block is not null").where(own).groupBy("block")
            given = blocks.where(own).groupBy("block").cogroup(back).applyInArrow(lambda block, sums: _give_back(width, (*lessened, known), block, sums), _COUNTED)
            counted.append(stored(given, "lm-counted"))
    counted = reduce(DataFrame.unionAll, counted)
    delete_tables(spark, done, read)  # blocks and totals

    events = counted.select(F.explode(F.arrays_zip("event", "events")).alias("e")).groupBy("e.event").agg(F.sum("e.events").alias("n")).toArrow()
    weights = mixture(events["event"].to_numpy().astype(np.int64), events["n"].to_numpy().astype(float), known)

    scored = counted.mapInArrow(_score(weights, int(size["train"]), int(size["train_ends"]), known), _SCORED)
    per_row = scored.groupBy("rid").agg(F.max("doc_id").alias("doc_id"), F.max("part").alias("part"), *[F.sum(c).alias(c) for c in ("n_tokens", "n_known", "base_log", "score")])
    scale = float(np.log10(size["train"] + 0.1 * (known + 1)))
    return per_row.select(
        "doc_id", (F.col("part") == HELD_OUT).alias("held_out"), "n_tokens", "n_known", F.lit(int(size["train"])).cast("long").alias("train_tokens"),
        (F.col("base_log") - F.col("n_tokens") * F.lit(scale)).alias("base_score"), "score",
    )
