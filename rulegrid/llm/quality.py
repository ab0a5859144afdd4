"""Quality of texts by a byte-level convolutional network, trained and applied in numpy.

A document's UTF-8 bytes are covered by chunks of ``CHUNK`` bytes whose filter windows reach into the next chunk.  Each byte
is a learned vector and one plane that marks words equal to the word before.  Learned filters of ``WIDTH`` bytes every
``STRIDE`` bytes are max-pooled within each chunk; the maximum and the mean over all chunks of the document feed one logistic unit.

Training uses a bounded sample of labelled rows: of either label the ``SAMPLE`` rows of the smallest hash of doc_id, whole texts of at most
``SAMPLE_TEXT`` bytes each, taken in that order as long as they fit in ``SAMPLE_BYTES``.  Equal rows count once, and every byte of a
sampled row is read.  Scoring reads every byte of every text.

Results for odd input: a null or empty text is one chunk of zero bytes and gets the score of that; equal rows get equal
scores; without labelled rows of both labels every score is the share of label 1 (0.5 without labels); a very long text is
read in slices and scored as if whole (repeated words are followed across slices); an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rulegrid.llm.shared import ship, stored
from rulegrid.llm.words import groups, text_bytes, word_spans

CHUNK, WIDTH, STRIDE = 512, 12, 4
REACH = WIDTH - STRIDE
FILTERS, VECTOR = 16, 4
SAMPLE, SAMPLE_TEXT, SAMPLE_BYTES = 700, 1 << 18, 1 << 24
EPOCHS, BATCH, RATE = 8, 50, 0.01
KEEP = 0.3
SLICE = 1 << 20

_SEPARATORS = np.ones(256, bool)
_SEPARATORS[[0, 9, 10, 11, 12, 13, 32]] = False

Model = dict[str, np.ndarray]


def padded(texts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All texts in one zero-padded buffer, the plane of repeated words, and each text's number of chunks.

    A text stands after ``REACH`` zero bytes, so the windows of the chunk before it see nothing of it."""
    chunks = np.array([-(-(len(t) + REACH) // CHUNK) for t in texts], np.int64)
    at = np.concatenate([[0], np.cumsum(chunks)]) * CHUNK
    data = np.zeros(at[-1] + REACH, np.uint8)
    for start, text in zip(at, texts):
        data[start + REACH : start + REACH + len(text)] = text
    starts, ends, hashes = word_spans(data, at[:-1], _SEPARATORS)
    owner = np.searchsorted(at, starts, side="right")
    again = np.zeros(len(starts), bool)
    again[1:] = (hashes[1:] == hashes[:-1]) & (owner[1:] == owner[:-1])
    plane = np.zeros(len(data) + 1, np.int32)
    np.add.at(plane, starts[again], 1)
    np.add.at(plane, ends[again], -1)
    return data, np.cumsum(plane[:-1]).astype(np.float32), chunks


def _windows(model: Model, data: np.ndarray, plane: np.ndarray) -> np.ndarray:
    """Filter windows ``(chunks, windows per chunk, WIDTH * channels)`` of a padded buffer."""
    channels = VECTOR + 1
    x = np.empty((len(data), channels), np.float32)
    x[:, :VECTOR] = model["vectors"][data]
    x[:, VECTOR] = plane
    n = (len(data) - REACH) // STRIDE
    return np.lib.stride_tricks.as_strided(x, (n, WIDTH * channels), (STRIDE * channels * 4, 4))


def pooled(model: Model, data: np.ndarray, plane: np.ndarray) -> np.ndarray:
    """Filter maxima of every chunk of a padded buffer."""
    out = _windows(model, data, plane) @ model["filters"]
    return np.maximum(out.reshape(-1, CHUNK // STRIDE, FILTERS).max(axis=1) + model["shift"], 0)


def _combined(model: Model, most: np.ndarray, mean: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-(np.concatenate([most, mean], axis=1) @ model["weights"] + model["bias"][0])))


def scores(model: Model, texts: list[np.ndarray]) -> np.ndarray:
    data, plane, chunks = padded(texts)
    each = pooled(model, data, plane)
    first = np.concatenate([[0], np.cumsum(chunks)[:-1]])
    return _combined(model, np.maximum.reduceat(each, first), np.add.reduceat(each, first) / chunks[:, None])


def repeats(text: np.ndarray) -> np.ndarray:
    """1 for every byte of a word that equals the word before it, else 0; read in parts that end at separators.

    A word of ``SLICE`` or more bytes is a part of its own, compared byte by byte.
    """
    plane = np.zeros(len(text), np.uint8)
    last: np.uint64 | None = None
    long_word: tuple[int, int] | None = None
    at = 0
    while at < len(text):
        gaps = np.flatnonzero(~_SEPARATORS[text[at : at + SLICE]])
        if not len(gaps) and len(text) - at >= SLICE:
            end = at + SLICE
            while end < len(text) and not len(gaps := np.flatnonzero(~_SEPARATORS[text[end : end + SLICE]])):
                end += SLICE
            end = min(len(text), end + int(gaps[0])) if len(gaps) else len(text)
            if long_word and long_word[1] - long_word[0] == end - at and _same_word(text, long_word[0], at, end - at):
                plane[at:end] = 1
            last, long_word, at = None, (at, end), end
            continue
        end = len(text) if at + SLICE >= len(text) else at + int(gaps[-1]) + 1
        starts, ends, hashes = word_spans(text[at:end], np.zeros(1, np.int64), _SEPARATORS)
        if len(hashes):
            again = np.concatenate([[last is not None and last == hashes[0]], hashes[1:] == hashes[:-1]])
            for s, e in zip(starts[again].tolist(), ends[again].tolist()):
                plane[at + s : at + e] = 1
            last, long_word = hashes[-1], None
        at = end
    return plane


def _same_word(text: np.ndarray, a: int, b: int, size: int) -> bool:
    parts = ((k, min(size, k + SLICE)) for k in range(0, size, SLICE))
    return all(text[a + k : a + m].tobytes().lower() == text[b + k : b + m].tobytes().lower() for k, m in parts)


def long_score(model: Model, text: np.ndarray) -> float:
    """The score of one very long text, read in slices: that of ``scores``."""
    most, total, n = np.zeros(FILTERS), np.zeros(FILTERS), 0
    again = repeats(text)
    whole = -(-(len(text) + REACH) // CHUNK) * CHUNK
    for start in range(0, whole, SLICE):
        size = min(SLICE, whole - start) + REACH
        data, plane = np.zeros(size, np.uint8), np.zeros(size, np.float32)
        first, last = max(0, start - REACH), min(len(text), start - REACH + size)
        inside = slice(first + REACH - start, last + REACH - start)
        data[inside], plane[inside] = text[first:last], again[first:last]
        each = pooled(model, data, plane)
        most, total, n = np.maximum(most, each.max(axis=0)), total + each.sum(axis=0, dtype=np.float64), n + len(each)
    return float(_combined(model, most[None], total[None] / n)[0])


def train(texts: list[np.ndarray], labels: np.ndarray, seed: int = 7) -> Model:
    """Fit by Adam; a maximum passes its gradient to its one window only, so a step backwards costs little."""
    rng = np.random.default_rng(seed)
    model: Model = {
        "vectors": rng.normal(0, 0.5, (256, VECTOR)).astype(np.float32),
        "filters": rng.normal(0, (WIDTH * (VECTOR + 1)) ** -0.5, (WIDTH * (VECTOR + 1), FILTERS)).astype(np.float32),
        "shift": np.zeros(FILTERS, np.float32),
        "weights": rng.normal(0, 0.1, 2 * FILTERS).astype(np.float32),
        "bias": np.zeros(1, np.float32),
    }
    moments = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in model.items()}
    steps = 0
    for _ in range(EPOCHS):
        order = rng.permutation(len(texts))
        for begin in range(0, len(order), BATCH):
            picked = order[begin : begin + BATCH]
            data, plane, chunks = padded([texts[i] for i in picked])
            steps += 1
            for k, g in _gradients(model, data, plane, chunks, labels[picked]).items():
                m, v = moments[k]
                m += 0.1 * (g - m)
                v += 0.01 * (g * g - v)
                model[k] -= RATE * (m / (1 - 0.9**steps)) / (np.sqrt(v / (1 - 0.99**steps)) + 1e-7)
    return model


def _tops(model: Model, windows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Place and value of every filter's maximum in every chunk, by ``SLICE`` bytes at a time."""
    best, raw = [], []
    for at in range(0, len(windows), SLICE // STRIDE):
        out = (windows[at : at + SLICE // STRIDE] @ model["filters"]).reshape(-1, CHUNK // STRIDE, FILTERS)
        best.append(out.argmax(axis=1))
        raw.append(np.take_along_axis(out, best[-1][:, None], 1)[:, 0] + model["shift"])
    return np.concatenate(best), np.concatenate(raw)


def _gradients(model: Model, data: np.ndarray, plane: np.ndarray, chunks: np.ndarray, y: np.ndarray) -> Model:
    windows = _windows(model, data, plane)
    best, raw = _tops(model, windows)
    each = np.maximum(raw, 0)
    first = np.concatenate([[0], np.cumsum(chunks)[:-1]])
    owner = np.repeat(np.arange(len(chunks)), chunks)
    most, mean = np.maximum.reduceat(each, first), np.add.reduceat(each, first) / chunks[:, None]
    error = (_combined(model, most, mean) - y) / len(y)
    features = np.concatenate([most, mean], axis=1)
    up = error[:, None] * model["weights"][None]
    g = up[owner, FILTERS:] / chunks[owner, None]
    top = each == most[owner]
    share = np.add.reduceat(top, first)[owner]
    g = (g + np.where(top, up[owner, :FILTERS] / share, 0)) * (raw > 0)
    rows = (np.arange(len(each))[:, None] * (CHUNK // STRIDE) + best).ravel()
    used = windows[rows].reshape(len(each), FILTERS, -1)
    to_filters = np.einsum("cfw,cf->wf", used, g)
    back = np.einsum("cf,wf->cfw", g, model["filters"]).reshape(-1, WIDTH, VECTOR + 1)[:, :, :VECTOR]
    at = rows[:, None] * STRIDE + np.arange(WIDTH)
    to_vectors = np.zeros_like(model["vectors"])
    np.add.at(to_vectors, data[at].ravel(), back.reshape(-1, VECTOR))
    return {
        "vectors": to_vectors, "filters": to_filters.astype(np.float32), "shift": g.sum(axis=0).astype(np.float32),
        "weights": (features.T @ error).astype(np.float32), "bias": np.array([error.sum()], np.float32),
    }


def bucket(doc_id: Column, of: int) -> Column:
    return F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(of))


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", held_out: int = 5) -> Model | float:
    """The model, learned from rows whose crc32(doc_id as text) mod ``held_out`` is not 0; a constant where it can't be learned."""
    ship(docs.sparkSession)
    known = labels.select("doc_id", F.col(label).cast("int").alias("label")).where("label in (0, 1) and doc_id is not null").where(bucket(F.col("doc_id"), held_out) != 0).distinct()
    order = [F.xxhash64("doc_id"), "doc_id"]
    picked = known.where("label = 0").orderBy(*order).limit(SAMPLE).union(known.where("label = 1").orderBy(*order).limit(SAMPLE))
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).where(F.octet_length("text") <= SAMPLE_TEXT).join(F.broadcast(picked), "doc_id")
    name = ["doc_id", "label", "digest"]
    rows = stored(texts.withColumn("digest", F.xxhash64("text")).dropDuplicates(name), "quality-sample")
    sizes = rows.select(*name, F.octet_length("text").cast("long").alias("size"))
    first = [sizes.where(F.col("label") == k).orderBy(*order, "digest").limit(SAMPLE) for k in (0, 1)]
    so_far = F.sum("size").over(Window.partitionBy("label").orderBy(*order, "digest").rowsBetween(Window.unboundedPreceding, 0))
    chosen = first[0].union(first[1]).withColumn("so_far", so_far).where(F.col("so_far") <= SAMPLE_BYTES).select(*name)
    rows = rows.join(F.broadcast(chosen), name).select(F.col("text").cast("binary").alias("text"), "label").toArrow()
    y = np.array(rows["label"].to_pylist(), np.float32)
    if not (y == 0).any() or not (y == 1).any():
        return float(y.mean()) if len(y) else 0.5
    texts = [np.frombuffer(t, np.uint8) for t in rows["text"].to_pylist()]
    order = sorted(range(len(texts)), key=lambda i: (texts[i].tobytes(), y[i]))  # rows arrive in any order
    return train([texts[i] for i in order], y[order])


def _score(model: Model | float, column: str) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            offsets, data = text_bytes(batch["text"])
            out = np.empty(len(offsets) - 1)
            for first, last in groups(offsets, SLICE // 8):  # their windows take 80 times as much
                texts = [data[offsets[i] : offsets[i + 1]] for i in range(first, last)]
                if isinstance(model, float):
                    out[first:last] = model
                elif last - first == 1 and len(texts[0]) > SLICE:
                    out[first] = long_score(model, texts[0])
                else:
                    out[first:last] = scores(model, texts)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out)], names=[*batch.schema.names, column])

    return run


def score_quality(docs: DataFrame, model: Model | float, column: str = "_score") -> DataFrame:
    """``docs`` with ``column``, the probability of label 1; a name that ``docs`` has already is an error (``shared.free_name`` gives one)."""
    ship(docs.sparkSession)
    if column.lower() in (c.lower() for c in docs.columns):
        raise ValueError(f"column {column} is there already")
    schema = docs.select("*", F.lit(0.0).alias(column)).schema
    return docs.mapInArrow(_score(model, column), schema)
