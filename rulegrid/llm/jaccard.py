"""Exact set-similarity self-join on word shingles with token-combination prefixes, and its link classes.

Two texts link when the Jaccard similarity of their shingle sets is at least ``threshold`` percent.

Signatures.  A set ``x`` of n tokens (hashed shingles) can lack at most ``D = n - ceil(t * n)`` of its
tokens in a partner.  Tokens have one global order and one global class each:

1. *rare* tokens of the counted quarter (hash below ``COUNTED``), by document frequency, then hash;
2. the other rare tokens, by hash;
3. *frequent* tokens (found in at least ``FREQUENT`` of the documents of some block), by hash, split by
   hash into ``CLASSES`` classes.

A prefix of ``x`` is extended along the order until its *slack* exceeds ``D``: every rare token gives 1,
a class of frequent tokens gives (its tokens in the prefix - 1).  Missing partners use up slack, so by the
pigeonhole principle two linked sets share a rare token of both prefixes, or two frequent tokens of one
class in both prefixes.  Rare tokens are therefore indexed singly, frequent ones as 2-token combinations.
(A set too small to reach that slack has at most ``CLASSES`` tokens; then D = 0 and only an equal set links.)
A rare token of one document only cannot be shared and is counted as slack without being indexed, so most
documents index nothing.  Which tokens count as frequent changes cost, never the result.

Equal sets are one class from the start.  In a large corpus sets that are nothing alike share signatures, and through
them nearly all sets are connected.  So two holders of a signature are joined only if they may link: their sizes must
allow it, and so must their *sketches*.  A sketch has one bit per value of the lower bits of a token's hash, set if an
odd number of the set's tokens have that value; two sketches differ in at most as many bits as the sets in tokens, so no
pair that links is lost.  Of the signatures that the same sets hold, one is looked at.  Blocks are the components of
what is joined; the sets of a block are compared exactly in tasks of at most ``TILE_TOKENS`` tokens (a set counts as 200 more):
a larger block is cut into tiles, every pair of which meets in one task.  No pair of rows is ever emitted: a task
returns one row per set with the smallest set it reaches there and its number of links.

Results for odd input: null or empty text, or text of separators only, has an empty set and links with
nothing; equal rows each stay; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rulegrid.llm.shared import connected_components, dropping_shuffles, stored
from rulegrid.llm.words import mix, shingles, words_of

COUNTED = np.uint64(1 << 62)  # a quarter of all tokens
FREQUENT = 0.01
CLASSES = 4
BLOCK_DOCUMENTS = 2000
MAX_FREQUENT = 100_000  # size bound of the broadcast list of frequent tokens: 800 KB
TILE_TOKENS = 1_000_000
TILE_HOLDERS = 4096  # sets of one signature that one task joins, or twice as many of two tiles
SKETCH_WORDS = 128  # 64-bit words of a sketch at most; there is a bit per token up to that
PAIR_WORDS = 1 << 21  # words of sketches compared at a time
FILTER_WORDS = 1 << 17  # 64-bit words of the broadcast bit filter: 1 MB
SEEN = 200_000  # digests that a task remembers to skip repeated texts


def token_sets(column: pa.Array, k: int) -> Iterator[tuple[int, np.ndarray]]:
    """``(row, sorted distinct shingle hashes)`` of every row of a text column."""
    for part in words_of(column):
        for row, words in part.rows():
            yield row, np.unique(shingles(words, k))


def digest(tokens: np.ndarray) -> int:
    """64-bit identity of a token set (0 for the empty one)."""
    if not len(tokens):
        return 0
    with np.errstate(over="ignore"):
        total = np.bitwise_xor.reduce(mix(tokens)) + np.sum(tokens * np.uint64(0xD6E8FEB86659FD93), dtype=np.uint64)
    return int(mix(np.array([total], dtype=np.uint64)).view(np.int64)[0])


def sketch(tokens: np.ndarray) -> bytes:
    """Parity of the number of tokens per value of their lower bits: a power of two of 64-bit words, more for larger sets."""
    words = min(SKETCH_WORDS, 1 << max(0, (len(tokens) - 1).bit_length() - 6))
    found = np.bincount((tokens & np.uint64(words * 64 - 1)).astype(np.int64), minlength=words * 64)
    return np.packbits((found & 1).astype(np.uint8), bitorder="little").tobytes()


def missing(n: int, threshold: int) -> int:
    """How many of n tokens a partner may lack."""
    return n - -(-threshold * n // 100)


def _describe(k: int) -> Callable:
    """Rows ``(doc_id, n, s, sketch)`` per document and ``(token, hits)`` per frequent token of a block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: list[np.ndarray] = []
        seen: set[int] = set()
        for batch in batches:
            n, s, sketches = [], [], []
            hot: list[tuple[int, int]] = []
            for _, tokens in token_sets(batch["text"], k):
                n.append(len(tokens))
                s.append(digest(tokens))
                sketches.append(sketch(tokens))
                if len(tokens) and s[-1] not in seen:
                    seen.add(s[-1])
                    kept.append(tokens)
                    if len(kept) >= BLOCK_DOCUMENTS:
                        hot += _frequent(kept)
                        kept, seen = [], set()
            yield _described(batch["doc_id"], n, s, sketches)
            yield _hot_rows(hot)
        yield _hot_rows(_frequent(kept))

    return run


_DESCRIBED = pa.schema([("doc_id", pa.int64()), ("n", pa.int64()), ("s", pa.int64()), ("sketch", pa.binary()), ("token", pa.int64()), ("hits", pa.int64())])


def _described(doc_id: pa.Array, n: list[int], s: list[int], sketches: list[bytes]) -> pa.RecordBatch:
    none = pa.nulls(len(n), pa.int64())
    columns = [doc_id.cast(pa.int64()), pa.array(n, pa.int64()), pa.array(s, pa.int64()), pa.array(sketches, pa.binary()), none, none]
    return pa.RecordBatch.from_arrays(columns, schema=_DESCRIBED)


def _hot_rows(hot: list[tuple[int, int]]) -> pa.RecordBatch:
    none = pa.nulls(len(hot), pa.int64())
    columns = [none, none, none, pa.nulls(len(hot), pa.binary()), pa.array([x[0] for x in hot], pa.int64()), pa.array([x[1] for x in hot], pa.int64())]
    return pa.RecordBatch.from_arrays(columns, schema=_DESCRIBED)


def _frequent(sets: list[np.ndarray]) -> list[tuple[int, int]]:
    if not sets:
        return []
    tokens, hits = np.unique(np.concatenate(sets), return_counts=True)
    often = hits >= max(4, FREQUENT * len(sets))
    return list(zip(tokens[often].view(np.int64).tolist(), hits[often].tolist()))


def _signatures(k: int, threshold: int, frequent) -> Callable:
    """Rows ``(key, s, spare)``: counted tokens, with the slack to spare of their set, and fixed signatures (spare -1)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        common = frequent.value
        seen: set[int] = set()
        for batch in batches:
            keys, owners, spares = [], [], []
            for _, tokens in token_sets(batch["text"], k):
                s = digest(tokens)
                if not len(tokens) or s in seen:
                    continue
                if len(seen) < SEEN:
                    seen.add(s)
                at = np.searchsorted(common, tokens)
                hot = (at < len(common)) & (common[np.minimum(at, len(common) - 1)] == tokens) if len(common) else np.zeros(len(tokens), bool)
                rare = tokens[~hot]
                counted = rare[rare < COUNTED]
                need = missing(len(tokens), threshold) + 1
                fixed = [np.zeros(0, np.uint64)]
                if len(counted) < need:
                    other = rare[rare >= COUNTED][: need - len(counted)]
                    fixed.append(other)
                    lack = need - len(counted) - len(other)
                    if lack > 0:
                        fixed.append(_combinations(tokens[hot], lack))
                singles = np.concatenate(fixed)
                keys += [counted, singles]
                owners.append(np.full(len(counted) + len(singles), s, np.int64))
                spares.append(np.full(len(counted), max(0, len(counted) - need), np.int32))
                spares.append(np.full(len(singles), -1, np.int32))
            if keys:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(keys).view(np.int64)), pa.array(np.concatenate(owners)), pa.array(np.concatenate(spares))],
                    names=["key", "s", "spare"],
                )

    return run


def _combinations(tokens: np.ndarray, lack: int) -> np.ndarray:
    """2-token combinations within classes of the shortest prefix of ``tokens`` whose slack is ``lack``."""
    of = (tokens % np.uint64(CLASSES)).astype(np.int64)
    first = np.zeros(len(tokens), bool)
    first[np.unique(of, return_index=True)[1]] = True
    slack = np.cumsum(~first)
    end = int(np.searchsorted(slack, lack)) + 1
    out = []
    for c in range(CLASSES):
        own = tokens[:end][of[:end] == c]
        i, j = np.triu_indices(len(own), 1)
        out.append(mix(own[i] * np.uint64(0xA24BAED4963EE407) ^ own[j]))
    return np.concatenate(out)


def _alike(threshold: int) -> Callable:
    """Rows ``(a, b)`` that join the sets which may link, of rows ``(key, i, j, s, part, n, sketch)`` sorted by key, i and j."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest = None
        for batch in batches:
            rows = pa.Table.from_batches([batch] if rest is None else [*rest.to_batches(), batch]).combine_chunks()
            starts = _run_starts(rows)
            if len(starts) > 1:
                yield _joined(rows.slice(0, starts[-1]), threshold)
            rest = rows.slice(starts[-1]) if len(starts) else None
        if rest is not None:
            yield _joined(rest, threshold)

    return run


def _run_starts(rows: pa.Table) -> np.ndarray:
    """The first row of each run of equal (key, i, j)."""
    if not len(rows):
        return np.zeros(0, np.int64)
    other = [np.diff(rows[c].to_numpy()) != 0 for c in ("key", "i", "j")]
    return np.concatenate([[0], np.flatnonzero(np.logical_or.reduce(other)) + 1])


def _joined(rows: pa.Table, threshold: int) -> pa.RecordBatch:
    """Each set of a run that may link with another one of its run, beside the first of those that are joined with it."""
    run = np.repeat(np.arange(len(starts := _run_starts(rows))), np.diff(starts, append=len(rows)))
    order = np.lexsort((rows["n"].to_numpy(), run))
    run = run[order]
    s, n, part = (rows[c].to_numpy()[order] for c in ("s", "n", "part"))
    across = (rows["i"].to_numpy() != rows["j"].to_numpy())[order]
    raw = rows["sketch"].to_pylist()
    sketches = _folded([raw[i] for i in order])
    words = np.array([len(raw[i]) // 8 for i in order], np.int64)
    # The larger sets that a row can link with follow it in its run.
    place = run << 40 | n
    counts = np.searchsorted(place, run << 40 | np.minimum(100 * n // threshold, (1 << 40) - 1), side="right") - np.arange(len(s)) - 1
    first = np.arange(len(s))  # smallest row joined with a row
    for i, j in _pairs(counts, words):
        apart = (first[i] != first[j]) & ~(across[i] & (part[i] == part[j]))
        i, j = i[apart], j[apart]
        near = np.zeros(len(i), bool)
        for w in np.unique(words[i]):  # sketches are compared at the smaller set's size
            of = np.flatnonzero(words[i] == w)
            at, bits = sketches[w]
            differ = np.bitwise_count(bits[at[i[of]]] ^ bits[at[j[of]]]).sum(axis=1, dtype=np.int64)
            near[of] = (100 + threshold) * differ <= (100 - threshold) * (n[i[of]] + n[j[of]])
        i, j = i[near], j[near]
        while len(i):
            np.minimum.at(first, np.maximum(first[i], first[j]), np.minimum(first[i], first[j]))
            while (first[first] != first).any():
                first = first[first]
            apart = first[i] != first[j]
            i, j = i[apart], j[apart]
    joined = np.flatnonzero(first != np.arange(len(s)))
    return pa.RecordBatch.from_arrays([pa.array(s[joined], pa.int64()), pa.array(s[first[joined]], pa.int64())], names=["a", "b"])


def _folded(raw: list[bytes]) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """By number of words: where a row's sketch is in the table of sketches of that size, and that table.  Larger sketches fold into it."""
    words = np.array([len(x) // 8 for x in raw], np.int64)
    out: dict[int, tuple[np.ndarray, np.ndarray]] = {}
    w, bits, rows = int(words.max(initial=1)), np.zeros((0, 0), np.uint64), np.zeros(0, np.int64)
    while w:
        own = np.flatnonzero(words == w)
        fresh = np.frombuffer(b"".join([raw[i] for i in own]), np.uint64).reshape(-1, w)
        bits = np.concatenate([bits[:, :w] ^ bits[:, w:], fresh]) if len(rows) else fresh
        rows = np.concatenate([rows, own])
        at = np.zeros(len(raw), np.int64)
        at[rows] = np.arange(len(rows))
        out[w] = at, bits
        w //= 2
    return out


def _pairs(counts: np.ndarray, words: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Every row with each of the ``counts`` rows after it, some ``PAIR_WORDS`` words of sketches at a time."""
    cost = np.cumsum(counts * words)
    at = 0
    while at < len(counts):
        end = max(at + 1, int(np.searchsorted(cost, (cost[at - 1] if at else 0) + PAIR_WORDS, side="right")))
        many = counts[at:end]
        i = np.repeat(np.arange(at, end), many)
        if len(i):
            yield i, i + 1 + np.arange(len(i)) - np.repeat(np.cumsum(many) - many, many)
        at = end


def _sets_in_filter(k: int, bits) -> Callable:
    """Rows ``(s, tokens)`` of the sets whose digest passes the bit filter."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = bits.value
        seen: set[int] = set()
        for batch in batches:
            out_s, out_t = [], []
            for _, tokens in token_sets(batch["text"], k):
                s = digest(tokens)
                at = s & (FILTER_WORDS * 64 - 1)
                if len(tokens) and s not in seen and int(words[at >> 6]) >> (at & 63) & 1:
                    if len(seen) < SEEN:
                        seen.add(s)
                    out_s.append(s)
                    out_t.append(tokens.tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(out_s, pa.int64()), pa.array(out_t, pa.binary())], names=["s", "tokens"])

    return run


def _bit_filter(keys: DataFrame) -> np.ndarray:
    """Bits of the digests of ``keys.s``: a fixed 1 MB however many there are (more pass by chance then)."""
    mask = FILTER_WORDS * 64 - 1
    rows = (
        keys.selectExpr(f"shiftright(s & {mask}L, 6) as w", "shiftleft(1L, cast(s & 63L as int)) as b")
        .groupBy("w").agg(F.bit_or("b").alias("b")).toArrow()
    )
    bits = np.zeros(FILTER_WORDS, np.uint64)
    bits[rows["w"].to_numpy()] = rows["b"].to_numpy().astype(np.int64).view(np.uint64)
    return bits


def _compare(threshold: int) -> Callable:
    """Exact comparison of the sets of one task: ``(s, partner, links)`` for every set with a link."""

    def run(table: pa.Table) -> pa.Table:
        block = table["block"].to_numpy()
        order = np.lexsort((table["s"].to_numpy(), table["part"].to_numpy(), block))
        s, part, copies = (table[c].to_numpy()[order] for c in ("s", "part", "copies"))
        block, pair = block[order], table["pair"].to_numpy()[order]
        raw = table["tokens"].combine_chunks()
        out: list[tuple[int, int, int]] = []
        for rows in np.split(np.arange(len(s)), np.flatnonzero(np.diff(block)) + 1):
            sets = [np.frombuffer(raw[int(order[i])].as_py(), np.uint64) for i in rows]
            out += _links(s[rows], part[rows], copies[rows], sets, threshold, bool(pair[rows[0]]))
        return pa.table({"s": pa.array([x[0] for x in out], pa.int64()), "partner": pa.array([x[1] for x in out], pa.int64()), "links": pa.array([x[2] for x in out], pa.int64())})

    return run


def _links(s, part, copies, sets, threshold: int, pair: bool) -> list[tuple[int, int, int]]:
    """pair: of two tiles, only pairs across them are this task's (each tile also has a task of its own)."""
    if len(sets) < 2:
        return []
    sizes = np.array([len(x) for x in sets])
    token, hits = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)[1:]
    bounds = np.concatenate([[0], np.cumsum(sizes)])
    shared = hits[token] > 1  # a token of one set only adds nothing to an intersection
    numbers = np.cumsum(hits > 1) - 1
    width = int((hits > 1).sum())
    if not width:
        return []
    owner = np.repeat(np.arange(len(sets)), sizes)
    dense = None
    if len(sets) * width <= 20_000_000:
        dense = np.zeros((len(sets), width), np.float32)
        dense[owner[shared], numbers[token[shared]]] = 1
    marks = np.zeros(len(hits), bool)
    linked = np.zeros((len(sets), len(sets)), bool)
    step = max(1, 1_000_000 // len(sets))
    for first in range(0, len(sets), step):
        last = min(len(sets), first + step)
        if dense is not None:
            common = np.rint(dense[first:last] @ dense.T).astype(np.int64)
        else:
            common = np.empty((last - first, len(sets)), np.int64)
            for i in range(first, last):
                marks[token[bounds[i] : bounds[i + 1]]] = True
                common[i - first] = np.add.reduceat(marks[token], bounds[:-1])
                marks[:] = False
        linked[first:last] = 100 * common >= threshold * (sizes[first:last, None] + sizes[None, :] - common)
    if pair:
        linked &= part[:, None] != part[None, :]
    np.fill_diagonal(linked, False)
    links, partner = linked @ copies, s.copy()
    open_ = np.ones(len(s), bool)
    for i in np.argsort(s):  # components within the task, each named by its smallest member
        reached = np.array([i]) if open_[i] else np.zeros(0, np.int64)
        open_[i] = False
        while len(reached):
            partner[reached] = s[i]
            reached = np.flatnonzero(linked[reached].any(axis=0) & open_)
            open_[reached] = False
    return [(int(a), int(b), int(c)) for a, b, c in zip(s, partner, links) if c]


def similar_text_classes(docs: DataFrame, k: int = 3, threshold: int = 90) -> DataFrame:
    """``(doc_id, n_shingles, component_id, n_links)`` per row of ``docs (doc_id, text)``.

    ``component_id`` is the smallest ``doc_id`` reachable by links, the own one included; ``n_links`` counts
    the other rows that link with the row directly, copies included.  See the module's docstring for odd input.
    """
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    with dropping_shuffles(spark):
        rows, per_set = _set_classes(docs, k, threshold)
    return rows.where("n > 0").join(per_set, "s").select("doc_id", F.col("n").alias("n_shingles"), "component_id", "n_links").union(
        rows.where("n = 0").select("doc_id", "n", "doc_id", F.lit(0).cast("long"))
    )


def _set_classes(docs: DataFrame, k: int, threshold: int) -> tuple[DataFrame, DataFrame]:
    """``(doc_id, n, s)`` per row, s naming its set, and ``(s, component_id, n_links)`` per set."""
    spark = docs.sparkSession
    described = stored(docs.mapInArrow(_describe(k), "doc_id long, n long, s long, sketch binary, token long, hits long"), "jaccard-sets")
    top = described.where("token is not null").groupBy("token").agg(F.sum("hits").alias("hits")).orderBy(F.desc("hits")).limit(MAX_FREQUENT).toArrow()
    frequent = np.sort(top["token"].to_numpy().astype(np.int64).view(np.uint64))
    rows = described.where("token is null").select("doc_id", "n", "s")
    classes = rows.where("n > 0").groupBy("s").agg(F.min("doc_id").alias("first_id"), F.count(F.lit(1)).alias("copies"))

    keys = docs.mapInArrow(_signatures(k, threshold, spark.sparkContext.broadcast(frequent)), "key long, s long, spare int")
    by_key = Window.partitionBy("key")
    shared = keys.repartition("key").dropDuplicates(["key", "s"]).withColumn("df", F.count(F.lit(1)).over(by_key)).where("df > 1")
    by_set = Window.partitionBy("s", "counted")
    counted = (F.col("spare") >= 0).alias("counted")
    chosen = (
        stored(shared, "jaccard-keys").select("key", "s", "spare", "df", counted)
        .withColumn("place", F.row_number().over(by_set.orderBy("df", "key")))
        .withColumn("own", F.count(F.lit(1)).over(by_set))
        .where("not counted or place <= own - spare").select("key", "s")
    )
    index = stored(chosen, "jaccard-index")
    # Of the signatures with the same holders, of which near copies have very many, one is enough.
    holders_of = F.count(F.lit(1)).alias("held"), F.min("s").alias("low"), F.max("s").alias("high"), F.bit_xor(F.xxhash64("s")).alias("mixed")
    held = index.groupBy("key").agg(*holders_of).where("held > 1").groupBy("held", "low", "high", "mixed").agg(F.min("key").alias("key"))
    holders = (
        index.join(held.select("key", "held"), "key").withColumn("tiles", F.ceil(F.col("held") / TILE_HOLDERS).cast("int"))
        .withColumn("part", F.pmod(F.xxhash64("s"), F.col("tiles")).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)))
        .select("key", F.least("part", "other").alias("i"), F.greatest("part", "other").alias("j"), "s", "part")
    )
    sketches = described.where("n > 0").select("s", "n", "sketch").dropDuplicates(["s"])
    alike = holders.join(sketches, "s").select("key", "i", "j", "s", "part", "n", "sketch").repartition("key", "i", "j").sortWithinPartitions("key", "i", "j")
    blocks = stored(connected_components(alike.mapInArrow(_alike(threshold), "a long, b long")), "jaccard-blocks")

    bits = spark.sparkContext.broadcast(_bit_filter(blocks.select(F.col("node").alias("s"))))
    sets = docs.mapInArrow(_sets_in_filter(k, bits), "s long, tokens binary")
    members = stored(
        sets.join(blocks.withColumnRenamed("node", "s"), "s").dropDuplicates(["s"]).join(classes.select("s", "copies"), "s")
        .select("s", "tokens", "copies", F.col("component").alias("block")),
        "jaccard-members",
    )
    sizes = members.groupBy("block").agg(F.sum(F.expr("length(tokens) div 8 + 200")).alias("size"))
    total, largest = sizes.agg(F.sum("size"), F.max("size")).first()
    tasks = max(1, int((total or 0) // TILE_TOKENS) + 1)
    tiled = members.join(sizes, "block").withColumn("tiles", F.ceil(F.col("size") * 2 / TILE_TOKENS).cast("int"))
    whole = tiled.where(f"size <= {TILE_TOKENS}").select(
        "s", "tokens", "copies", "block", F.lit(0).alias("part"), F.lit(False).alias("pair"),
        F.struct(F.pmod(F.hash("block"), F.lit(tasks)).cast("long").alias("g"), F.lit(-1).alias("i"), F.lit(-1).alias("j")).alias("task"),
    )
    split = (
        tiled.where(f"size > {TILE_TOKENS}").withColumn("part", F.pmod(F.xxhash64("s"), F.col("tiles")).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)))
        .select(
            "s", "tokens", "copies", "block", "part", (F.col("part") != F.col("other")).alias("pair"),
            F.struct(F.col("block").alias("g"), F.least("part", "other").alias("i"), F.greatest("part", "other").alias("j")).alias("task"),
        )
    )
    found = stored(whole.union(split).groupBy("task").applyInArrow(_compare(threshold), "s long, partner long, links long"), "jaccard-links")
    joined = connected_components(found.select(F.col("s").alias("a"), F.col("partner").alias("b")))
    reached = (
        classes.join(joined.withColumnRenamed("node", "s"), "s", "left")
        .join(found.groupBy("s").agg(F.sum("links").alias("links")), "s", "left")
        .select("s", "first_id", "copies", F.coalesce("component", "s").alias("component"), F.coalesce("links", F.lit(0)).alias("links"))
    )
    reached = stored(reached, "jaccard-classes")
    ids = reached.groupBy("component").agg(F.min("first_id").alias("component_id"))
    return rows, reached.join(ids, "component").select("s", "component_id", (F.col("links") + F.col("copies") - 1).alias("n_links"))
