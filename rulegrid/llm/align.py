"""Alignment of two tokenisers over the same bytes.

Tokens of A (byte-level BPE) and B (pieces with byte fallback) both cover a space and the text.  Byte offsets where a token of each ends
are cuts; between two cuts lies a group.  Tokens of A and B whose byte ranges overlap are linked; within a group every
stretch between two neighbouring token ends is one link, so links come from the sorted ends alone.

* ``Fragment`` is the alignment of a part of a text: an open prefix up to its first cut, closed groups, an open suffix
  after its last.  ``joined`` composes neighbours: the left suffix and the right prefix meet, and cuts between them close.
  Composition is associative, so fragments can be joined in any bracketing.
* Texts are cut into words at single spaces between other characters, where both tokenisers cut for sure; a worker
  remembers the alignment of words up to a bound, and a text adds up its words.
* A text over ``RANGE`` bytes is cut into byte ranges, whose parts of A and of B end at the next safe place of each tokeniser,
  mostly not the same.  The ranges are spread over Spark's tasks, aligned there, and their fragments joined in a tree of ``FAN``
  per step, so neither tokenising nor joining such a text falls to one task.
* The corpus counts: per batch of texts and id pair one row names the texts that hold the pair and how often.  Pairs are counted over those
  rows, each A id's highest count is found, and counts go back batch by batch, so a pair of all texts is a row a batch.

Odd input: a null or empty text, and one whose joined token bytes differ from space and text (a character that a tokeniser rewrites,
such as U+2581), has zeros; equal rows count each; any ``doc_id``, null too, may repeat; further columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import itertools
import pickle
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rulegrid.llm.shared import stored

RANGE = 1 << 16
FAN = 8
BATCH_CHARS = 2 << 20
BATCH_TEXTS = 1 << 16
REMEMBERED = 250_000  # words
PAIR = 1 << 16  # an id pair is a * PAIR + b

# Neither white space of any definition nor the pieces' own mark of a space.
_SOLID = r"[^\s\x1c-\x1f▁]"
_WORD_CUT = re.compile(f"(?<={_SOLID}) (?={_SOLID})")
_PIECE_CUT = re.compile(rf"(?<={_SOLID}) (?=[\s\S])")
_ODD = re.compile("^ | $| [\\s\\x1c-\\x1f▁]|[\\s\\x1c-\\x1f▁] ")

_NONE = np.zeros(0, np.int64)


@dataclass
class Tokens:
    """Tokens of A and of B in order, with the byte offset where each ends."""

    a: np.ndarray = field(default_factory=lambda: _NONE)
    a_ends: np.ndarray = field(default_factory=lambda: _NONE)
    b: np.ndarray = field(default_factory=lambda: _NONE)
    b_ends: np.ndarray = field(default_factory=lambda: _NONE)

    def __add__(self, other: Tokens) -> Tokens:
        return Tokens(*(np.concatenate([getattr(self, c), getattr(other, c)]) for c in ("a", "a_ends", "b", "b_ends")))

    def cuts(self) -> np.ndarray:
        return np.intersect1d(self.a_ends, self.b_ends, assume_unique=True)

    def until(self, low: int, high: int) -> Tokens:
        """The tokens that end after ``low`` and not after ``high``."""
        i, j = np.searchsorted(self.a_ends, [low, high], side="right")
        k, m = np.searchsorted(self.b_ends, [low, high], side="right")
        return Tokens(self.a[i:j], self.a_ends[i:j], self.b[k:m], self.b_ends[k:m])

    def links(self) -> tuple[np.ndarray, np.ndarray]:
        """``(id pairs, ends)`` of the links of whole groups."""
        ends = np.union1d(self.a_ends, self.b_ends)
        return self.a[np.searchsorted(self.a_ends, ends)] * PAIR + self.b[np.searchsorted(self.b_ends, ends)], ends

    def groups(self, cuts: np.ndarray, names: list[str] | None = None) -> list[str]:
        """Each group that ends at one of ``cuts``, as ``a1,a2|b1``; ``names`` may hold the ids as text."""
        name = names.__getitem__ if names else str
        a, b = list(map(name, self.a.tolist())), list(map(name, self.b.tolist()))
        i, k = np.searchsorted(self.a_ends, cuts, side="right").tolist(), np.searchsorted(self.b_ends, cuts, side="right").tolist()
        return [f"{','.join(a[i0:i1])}|{','.join(b[k0:k1])}" for i0, i1, k0, k1 in zip([0, *i], i, [0, *k], k)]


def _summed(pairs: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    own, place = np.unique(pairs, return_inverse=True)
    return own, np.bincount(place, counts, len(own)).astype(np.int64)


@dataclass
class Fragment:
    """The alignment of a part of a text; without a cut everything is ``prefix``."""

    ok: bool = True
    n_a: int = 0
    n_b: int = 0
    cut: bool = False
    n_groups: int = 0
    groups: list[str] = field(default_factory=list)  # closed groups, as texts of one or more
    pairs: np.ndarray = field(default_factory=lambda: _NONE)  # of closed groups, with counts
    counts: np.ndarray = field(default_factory=lambda: _NONE)
    prefix: Tokens = field(default_factory=Tokens)
    suffix: Tokens = field(default_factory=Tokens)

    @classmethod
    def of(cls, tokens: Tokens, ok: bool = True) -> Fragment:
        cuts = tokens.cuts()
        own = cls(ok, len(tokens.a), len(tokens.b))
        if not len(cuts):
            own.prefix = tokens
            return own
        own.cut, first, last = True, cuts[0], cuts[-1]
        own.prefix, own.suffix = tokens.until(-1, first), tokens.until(last, np.iinfo(np.int64).max)
        own._close(tokens.until(first, last), cuts[1:])
        return own

    @classmethod
    def start(cls) -> Fragment:
        """What stands before a text: nothing, and a cut."""
        return cls(cut=True)

    def _close(self, tokens: Tokens, cuts: np.ndarray) -> None:
        if len(cuts):
            pairs, _ = tokens.links()
            self.groups = [*self.groups, ";".join(tokens.groups(cuts))]
            self.n_groups += len(cuts)
            self.pairs, self.counts = _summed(np.concatenate([self.pairs, pairs]), np.concatenate([self.counts, np.ones(len(pairs), np.int64)]))

    def joined(self, right: Fragment) -> Fragment:
        middle = (self.suffix if self.cut else self.prefix) + right.prefix
        cuts = middle.cuts()
        out = Fragment(self.ok and right.ok, self.n_a + right.n_a, self.n_b + right.n_b, self.cut or right.cut or len(cuts) > 0)
        if not out.cut:
            out.prefix = middle
            return out
        out.n_groups, out.groups, out.pairs, out.counts = self.n_groups, self.groups, self.pairs, self.counts
        if self.cut:
            out.prefix, closed = self.prefix, cuts
        else:
            out.prefix, closed = middle.until(-1, cuts[0]), cuts[1:]
        low = -1 if self.cut else cuts[0]
        high = cuts[-1] if len(cuts) else -1
        out._close(middle.until(low, high), closed)
        out.suffix = right.suffix if right.cut else middle.until(high, np.iinfo(np.int64).max)
        out.n_groups += right.n_groups
        out.groups = [*out.groups, *right.groups]
        out.pairs, out.counts = _summed(np.concatenate([out.pairs, right.pairs]), np.concatenate([out.counts, right.counts]))
        return out


def _flat(ids: list[list[int]]) -> np.ndarray:
    return np.fromiter(itertools.chain.from_iterable(ids), np.int64)


def _byte_alphabet() -> dict[str, int]:
    """The printable characters that stand for bytes in a byte-level vocabulary."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    other = [b for b in range(256) if b not in set(plain)]
    return {**{chr(b): b for b in plain}, **{chr(256 + i): b for i, b in enumerate(other)}}


class Pair:
    """The two tokenisers, their tokens' bytes, and the words a worker remembers."""

    def __init__(self, a_file: str, b_file: str):
        import public_tokenizers
        import sentencepiece
        import tiktoken
        from tokenizers import Tokenizer

        # The ids of a byte-level vocabulary are the ranks of its merges, and its special tokens' strings are plain text here, so
        # a plain rank encoder gives the same ids at a third of the time for single words.
        vocabulary = Tokenizer.from_file(a_file)
        special = set(vocabulary.get_added_tokens_decoder())
        alphabet = _byte_alphabet()
        ranks = {bytes(alphabet[c] for c in t): i for t, i in vocabulary.get_vocab().items() if i not in special}
        self.a_bytes = [b""] * (max(ranks.values()) + 1)
        for token, i in ranks.items():
            self.a_bytes[i] = token
        self.a = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.b = sentencepiece.SentencePieceProcessor(model_file=b_file)
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        if any(re.search("[^▁]▁", p) for p in pieces):
            raise ValueError("a piece of the second tokeniser crosses a space: texts cannot be cut there")
        self.b_bytes = [bytes([int(p[1:-1], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)]
        self.a_sizes = np.array([len(x) for x in self.a_bytes], np.int64)
        self.b_sizes = np.array([len(x) for x in self.b_bytes], np.int64)
        self.names = list(map(str, range(max(len(self.a_bytes), len(self.b_bytes)))))
        self.forget()

    def forget(self) -> None:
        self.codes: dict[str, int] = {}
        self.groups: list[str] = []
        self.numbers = np.zeros((0, 5), np.int64)  # per word: fits, tokens of A and B, groups, links
        self.first_pair, self.pairs = np.zeros(1, np.int64), _NONE  # links of word i: pairs[first_pair[i]:first_pair[i + 1]]

    def _fits(self, words: list[str], a: list[list[int]], b: list[list[int]]) -> np.ndarray:
        """Whether both tokenisers' bytes are those of space and word; all words at once, one by one only if any differs."""
        data = [b" " + w.encode() for w in words]
        sizes, whole = np.fromiter(map(len, data), np.int64, len(data)), b"".join(data)
        same = True
        for ids, of, of_sizes in ((a, self.a_bytes, self.a_sizes), (b, self.b_bytes, self.b_sizes)):
            ends = np.cumsum(of_sizes[_flat(ids)])
            last = np.cumsum(np.fromiter(map(len, ids), np.int64, len(ids)))
            totals = np.where(last > 0, ends[np.maximum(last, 1) - 1] if len(ends) else 0, 0)
            same = same and np.array_equal(totals, np.cumsum(sizes)) and b"".join(map(of.__getitem__, itertools.chain.from_iterable(ids))) == whole
        if same:
            return np.ones(len(words), bool)
        joined = [all(b"".join(map(of.__getitem__, x)) == d for of, x in ((self.a_bytes, i), (self.b_bytes, j))) for i, j, d in zip(a, b, data)]
        return np.array(joined, bool)

    def learn(self, words: list[str]) -> None:
        a = [self.a.encode_ordinary(" " + w) for w in words]
        b = self.b.encode(words, num_threads=1)
        fits = self._fits(words, a, b)
        if not fits.all():
            a = [x if f else [] for x, f in zip(a, fits)]
            b = [x if f else [] for x, f in zip(b, fits)]
        n_a, n_b = (np.fromiter(map(len, ids), np.int64, len(ids)) for ids in (a, b))
        flat_a, flat_b = _flat(a), _flat(b)
        tokens = Tokens(flat_a, np.cumsum(self.a_sizes[flat_a]), flat_b, np.cumsum(self.b_sizes[flat_b]))
        ends = np.concatenate([[0], tokens.a_ends])[np.cumsum(n_a)]
        cuts = tokens.cuts()
        pairs, link_ends = tokens.links()
        n_groups = np.diff(np.searchsorted(cuts, ends, side="right"), prepend=0)
        n_links = np.diff(np.searchsorted(link_ends, ends, side="right"), prepend=0)
        numbers = np.stack([fits, n_a, n_b, n_groups, n_links], axis=1).astype(np.int64)
        groups, at = tokens.groups(cuts, self.names), 0
        self.codes.update(zip(words, range(len(self.groups), len(self.groups) + len(words))))
        for n in n_groups.tolist():
            self.groups.append(groups[at] if n == 1 else ";".join(groups[at : at + n]))
            at += n
        self.numbers = np.concatenate([self.numbers, numbers])
        self.first_pair = np.concatenate([self.first_pair, self.first_pair[-1] + np.cumsum(n_links)])
        self.pairs = np.concatenate([self.pairs, pairs])

    def part(self, text: str, a_from: int, a_to: int, b_from: int, b_to: int, start: int) -> Fragment:
        """The fragment of a byte range: A's part and B's part of ``text``, which starts at byte ``start`` of the whole (0: its very start)."""
        whole = text if start else " " + text
        shift = 0 if start else 1
        a_text = whole[a_from + (shift if a_from else 0) : a_to + shift]
        b_text = whole[b_from + (shift if b_from else 0) : b_to + shift]
        a = np.array(self.a.encode_ordinary(a_text), np.int64)
        b = np.array(self.b.encode(b_text[1:]) if b_text else [], np.int64)  # B adds the space it starts with
        ok = b"".join([self.a_bytes[i] for i in a]) == a_text.encode() and b"".join([self.b_bytes[i] for i in b]) == b_text.encode()
        a_start = start + len(whole[: a_from + (shift if a_from else 0)].encode())
        b_start = start + len(whole[: b_from + (shift if b_from else 0)].encode())
        return Fragment.of(Tokens(a, a_start + np.cumsum(self.a_sizes[a]), b, b_start + np.cumsum(self.b_sizes[b])), ok)


_PAIRS: dict[tuple[str, str], Pair] = {}


def _pair(files: tuple[str, str]) -> Pair:
    if files not in _PAIRS:
        _PAIRS[files] = Pair(*files)
    return _PAIRS[files]


def words_of(text: str) -> list[str]:
    return _WORD_CUT.split(text) if _ODD.search(text) or "▁" in text else text.split(" ")


def ranges_of(text: str, size: int) -> list[tuple[str, int, int, int, int, int]]:
    """``(text, a_from, a_to, b_from, b_to, start)`` of each byte range of about ``size``: what ``Pair.part`` takes."""
    data = np.frombuffer(text.encode(), np.uint8)
    lows = np.arange(0, len(data), size)
    places = np.cumsum(np.add.reduceat((data & 0xC0) != 0x80, lows, dtype=np.int64))[:-1].tolist()  # characters before each next range
    cuts = [(0, 0)]
    for at in places:
        a, b = _WORD_CUT.search(text, max(at, cuts[-1][0] + 1)), _PIECE_CUT.search(text, max(at, cuts[-1][1] + 1))
        cuts.append((a.start() if a else len(text), b.start() if b else len(text)))
    cuts.append((len(text), len(text)))
    out, before, start = [], 0, 0
    for (a0, b0), (a1, b1) in zip(cuts, cuts[1:]):
        if (a0, b0) == (a1, b1):
            continue
        low, high = min(a0, b0), max(a1, b1)
        start += len(text[before:low].encode())
        before = low
        out.append((text[low:high], a0 - low, a1 - low, b0 - low, b1 - low, start + 1 if low else 0))
    return out


_NAMES = ["kind", "batch", "doc", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups", "a", "b", "holders", "docs", "links", "part", "data"]
_KINDS = [pa.int32(), pa.int64(), pa.int32(), *[pa.int64()] * 5, pa.string(), *[pa.int32()] * 3, pa.binary(), pa.binary(), pa.int32(), pa.binary()]
_SCHEMA = (
    "kind int, batch long, doc int, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups string, "
    "a int, b int, holders int, docs binary, links binary, part int, data binary"
)
_TEXT, _POSTING, _RANGE = 0, 1, 2


def _rows(n: int, **columns) -> pa.RecordBatch:
    arrays = [columns[c] if isinstance(columns.get(c), pa.Array) else pa.array(columns[c], k) if c in columns else pa.nulls(n, k) for c, k in zip(_NAMES, _KINDS)]
    return pa.RecordBatch.from_arrays(arrays, names=_NAMES)


def _binary(values: np.ndarray, cuts: np.ndarray) -> pa.Array:
    """``values[cuts[i]:cuts[i + 1]]`` as binary values."""
    offsets = (cuts * values.itemsize).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(cuts) - 1, [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(values.tobytes())])


def _postings(batch: int, docs: np.ndarray, pairs: np.ndarray, counts: np.ndarray) -> Iterator[pa.RecordBatch]:
    """One row per id pair of a batch: the texts that hold it, and how often each does."""
    keys, counts = _summed(pairs * BATCH_TEXTS + docs, counts)
    pairs, docs = np.divmod(keys, BATCH_TEXTS)
    firsts = np.flatnonzero(np.diff(pairs, prepend=-1))
    cuts = np.append(firsts, len(pairs))
    own = pairs[firsts]
    n = len(own)
    if n:
        yield _rows(
            n, kind=np.full(n, _POSTING, np.int32), batch=np.full(n, batch), a=(own // PAIR).astype(np.int32), b=(own % PAIR).astype(np.int32),
            holders=np.diff(cuts).astype(np.int32), docs=_binary(docs.astype("<u2"), cuts), links=_binary(counts.astype("<u4"), cuts),
        )


def _sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest() if text else ""


def _text_rows(batch: int, ids: list, numbers: np.ndarray, groups: list[str], digest: bool) -> pa.RecordBatch:
    n = len(ids)
    return _rows(
        n, kind=np.full(n, _TEXT, np.int32), batch=np.full(n, batch), doc=np.arange(n, dtype=np.int32), doc_id=ids,
        n_a=numbers[:, 1], n_b=numbers[:, 2], n_groups=numbers[:, 3], n_links=numbers[:, 4], groups=list(map(_sha, groups)) if digest else groups,
    )


def _aligned(pair: Pair, batch: int, ids: list, texts: list[str], digest: bool) -> Iterator[pa.RecordBatch]:
    if len(pair.codes) > REMEMBERED:
        pair.forget()
    words, sizes = [], []
    for text in texts:
        own = words_of(text) if text else []
        words += own
        sizes.append(len(own))
    new = set(words).difference(pair.codes)
    if new:
        pair.learn(sorted(new))
    codes = np.fromiter(map(pair.codes.__getitem__, words), np.int64, len(words))
    bounds = np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)])
    sums = np.concatenate([np.zeros((1, 5), np.int64), np.cumsum(pair.numbers[codes], axis=0)])
    numbers = sums[bounds[1:]] - sums[bounds[:-1]]
    fits = numbers[:, 0] == sizes
    numbers[~fits] = 0
    text_of = pair.groups.__getitem__
    groups = [";".join(map(text_of, codes[i:j].tolist())) if ok else "" for i, j, ok in zip(bounds, bounds[1:], fits.tolist())]
    yield _text_rows(batch, ids, numbers, groups, digest)
    doc = np.repeat(np.arange(len(texts)), sizes)
    used = fits[doc]
    held, counts = np.unique(doc[used] << 32 | codes[used], return_counts=True)
    doc, codes = held >> 32, held & 0xFFFFFFFF
    first, n = pair.first_pair[codes], pair.numbers[codes, 4]
    place = np.repeat(first - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(n.sum()) if len(n) else _NONE
    yield from _postings(batch, np.repeat(doc, n), pair.pairs[place], np.repeat(counts, n))


def _first_pass(files: tuple[str, str], size: int, digest: bool) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair = _pair(files)
        batch = TaskContext.get().partitionId() << 32
        ids: list = []
        texts: list[str] = []
        chars = 0
        for rows in batches:
            for doc_id, value in zip(rows["doc_id"].to_pylist(), rows["text"]):
                text = value.as_py() or ""
                if len(text) * 4 > size and len(text.encode()) > size:
                    batch += 1
                    for i, own in enumerate(ranges_of(text, size)):
                        yield _rows(1, kind=[_RANGE], batch=[batch], doc_id=[doc_id], part=[i], data=[pickle.dumps(own)])
                    continue
                ids.append(doc_id)
                texts.append(text)
                chars += len(text)
                if chars > BATCH_CHARS or len(texts) == BATCH_TEXTS - 1:
                    batch += 1
                    yield from _aligned(pair, batch, ids, texts, digest)
                    ids, texts, chars = [], [], 0
        if texts:
            yield from _aligned(pair, batch + 1, ids, texts, digest)

    return run


_PARTS = "batch long, part int, doc_id long, data binary"


def _fragments(files: tuple[str, str]) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            for i in range(rows.num_rows):
                own = rows.slice(i, 1)
                done = pickle.dumps(_pair(files).part(*pickle.loads(own["data"][0].as_py())))
                yield own.set_column(own.schema.get_field_index("data"), "data", pa.array([done], pa.binary()))

    return run


def _compose(rows: pa.Table) -> pa.Table:
    """The parts of one vertex of the tree, at most ``FAN``, as one."""
    rows = rows.sort_by("part")
    whole, *rest = (pickle.loads(x) for x in rows["data"].to_pylist())
    for right in rest:
        whole = whole.joined(right)
    names = ["batch", "part", "doc_id", "data"]
    values = [rows["batch"][0].as_py(), rows["part"][0].as_py() // FAN, rows["doc_id"][0].as_py(), pickle.dumps(whole)]
    return pa.table([pa.array([v], k) for v, k in zip(values, (pa.int64(), pa.int32(), pa.int64(), pa.binary()))], names=names)


def _roots(digest: bool) -> Callable:
    """Texts and postings of whole texts that came as ranges; their batches count below zero, where no other does."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            for key, doc_id, data in zip(*(rows[c].to_pylist() for c in ("batch", "doc_id", "data"))):
                whole = Fragment.start().joined(pickle.loads(data))
                ok = whole.ok and not len(whole.suffix.a) and not len(whole.suffix.b)
                pairs, counts = (whole.pairs, whole.counts) if ok else (_NONE, _NONE)
                numbers = np.array([[1, whole.n_a, whole.n_b, whole.n_groups, counts.sum()]]) * ok
                yield _text_rows(-key, [doc_id], numbers, [";".join(whole.groups) if ok else ""], digest)
                yield from _postings(-key, np.zeros(len(pairs), np.int64), pairs, counts)

    return run


def _batch_sums(texts: pa.Table, counts: pa.Table) -> pa.Table:
    """``(batch, doc, n_best, count_sum)`` of the postings of one batch, with the counts of their pairs."""
    postings, counts = texts.sort_by([("a", "ascending"), ("b", "ascending")]), counts.sort_by([("own_a", "ascending"), ("own_b", "ascending")])
    holders = postings["holders"].to_numpy().astype(np.int64)
    docs = np.frombuffer(b"".join(postings["docs"].to_pylist()), "<u2")
    links = np.frombuffer(b"".join(postings["links"].to_pylist()), "<u4").astype(np.int64)
    n, best = (np.repeat(counts[c].to_numpy().astype(np.int64), holders) for c in ("n", "best"))
    size = int(docs.max(initial=0)) + 1
    sums = [np.zeros(size, np.int64), np.zeros(size, np.int64)]
    np.add.at(sums[0], docs, links * best)
    np.add.at(sums[1], docs, links * n)
    batch = postings["batch"][0].as_py()
    return pa.table([pa.array(np.full(size, batch)), pa.array(np.arange(size, dtype=np.int32)), *map(pa.array, sums)], names=["batch", "doc", "n_best", "count_sum"])


def align(docs: DataFrame, a_file: str, b_file: str, digest: bool = False, size: int = RANGE) -> DataFrame:
    """``(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups)`` of every row of ``docs (doc_id, text)``.

    ``groups`` lists the groups as ``a1,a2|b1;a3|b2,b3``, or is their SHA-256 with ``digest``, so that the lists need not be written.
    """
    files = (a_file, b_file)
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    first = stored(own.mapInArrow(_first_pass(files, size, digest), _SCHEMA), "align-first")
    ranges = first.where(F.col("kind") == _RANGE).select("batch", "part", "doc_id", "data")
    parts = stored(ranges.repartition("batch", "part").mapInArrow(_fragments(files), _PARTS), "align-parts")
    last = parts.agg(F.max("part")).first()[0]
    while last:
        parts = stored(parts.groupBy("batch", F.floor(F.col("part") / FAN)).applyInArrow(_compose, _PARTS), "align-parts")
        last //= FAN
    whole = stored(parts.mapInArrow(_roots(digest), _SCHEMA), "align-long")
    every = first.unionByName(whole)
    texts = every.where(F.col("kind") == _TEXT).select("batch", "doc", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups")
    postings = every.where(F.col("kind") == _POSTING).select("batch", "a", "b", "holders", "docs", "links")
    counts = stored(postings.groupBy("a", "b").agg(F.sum("holders").alias("n")), "align-counts")
    highest = counts.groupBy("a").agg(F.max("n").alias("highest"))
    judged = counts.join(highest, "a").select("a", "b", "n", (F.col("n") == F.col("highest")).cast("int").alias("best"))
    asked = postings.select(F.col("batch").alias("own_batch"), F.col("a").alias("own_a"), F.col("b").alias("own_b"))
    found = asked.join(judged, (F.col("own_a") == F.col("a")) & (F.col("own_b") == F.col("b"))).select("own_batch", "own_a", "own_b", "n", "best")
    sums = postings.groupBy("batch").cogroup(found.groupBy("own_batch")).applyInArrow(_batch_sums, "batch long, doc int, n_best long, count_sum long")
    zero = F.lit(0).cast("long")
    return texts.join(sums, ["batch", "doc"], "left").select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", F.coalesce("n_best", zero).alias("n_best"), F.coalesce("count_sum", zero).alias("count_sum"), "groups"
    )
