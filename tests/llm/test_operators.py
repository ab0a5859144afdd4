"""Every operator against a plain Python version on odd tables; larger checks on the driver's small tables."""

import collections
import hashlib
import math
import pathlib
import random
import re
import time
import zlib

import numpy as np
import pyarrow as pa
import pytest
from llm_brute import base_spans, low, nothing, odd, shingle_sets, space_words  # noqa: F401
from pyspark.sql import functions as F

from conftest import SMALL_DIR
from rulegrid.llm import chat, decontaminate, jaccard, licenses, lm, neighbours, packing, quality, queries, secrets, warc
from rulegrid.llm import words as W
from rulegrid.llm.shared import connected_components


def test_word_hashes_do_not_depend_on_grouping(monkeypatch):
    texts = ["Hello World hello", "", None, "héé Hello", "hello world " * 30]
    whole = [h.tolist() for g in W.words_of(pa.array(texts)) for _, h in g.rows()]
    monkeypatch.setattr(W, "GROUP_BYTES", 16)
    assert whole == [h.tolist() for g in W.words_of(pa.array(texts)) for _, h in g.rows()]
    assert whole[0][0] == whole[0][2] == whole[3][1] and len(whole[4]) == 60


def test_components(spark):
    edges = [(i, i + 1) for i in range(0, 40)] + [(100, i) for i in range(101, 160)] + [(7, 7)]
    got = dict(connected_components(spark.createDataFrame(edges, "a long, b long")).collect())
    assert got == {**{i: 0 for i in range(41)}, **{i: 100 for i in range(100, 160)}}
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


# 1 packing


def test_packing_covers_every_id_once(odd):
    from tokenizers import Tokenizer
    import public_tokenizers

    tokens = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    tokens.encode_special_tokens = True
    rows = packing.pack(odd, queries.vocabulary()).collect()
    texts = collections.Counter((r.doc_id, r.text or "") for r in odd.select("doc_id", "text").collect())
    pieces = collections.defaultdict(list)
    for r in rows:
        pieces[r.doc_id].append(r)
    for (doc_id, text), n in texts.items():
        ids = np.array([*tokens.encode(text, add_special_tokens=False).ids, 1], "<u4")
        own = sorted(pieces[doc_id], key=lambda r: r.start)
        assert sum(r.length for r in own) == n * len(ids) and all(r.doc_tokens == len(ids) for r in own)
        assert all(ids[r.start : r.start + r.length].tobytes() == bytes(r.ids) for r in own)
    sequences = collections.defaultdict(list)
    for r in rows:
        sequences[r.sequence_id].append((r.offset, r.length))
    for places in sequences.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= packing.WINDOW


def test_packing_plan_uses_the_histogram_up_with_little_padding():
    rng = random.Random(3)
    for histogram in ({94: 10_000}, {n: rng.randrange(50) for n in range(1, 129)}, {128: 3}, {}, {1: 1}):
        left = collections.Counter()
        filled = total = 0
        for places, times in packing.plan_patterns(histogram):
            assert sum(cut for _, cut, _ in places) <= 128
            filled += times * sum(cut for _, cut, _ in places)
            total += times * 128
            for length, cut, _ in places:
                left[length] += cut * times
        assert left == collections.Counter({n: n * c for n, c in histogram.items() if c})
        assert total - filled <= 128 + 0.02 * total


def test_text_chunks_give_the_tokenisers_ids():
    import public_tokenizers
    from tokenizers import Tokenizer

    tokens = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    tokens.encode_special_tokens = True
    own = packing.ids_of(queries.vocabulary())
    rng = random.Random(5)
    for _ in range(500):
        text = "".join(rng.choice(["a", "don't", " ", "  ", "\n", "é", "1", "!", " ", "\x1c", "<|endoftext|>", " the"]) for _ in range(12))
        assert own.of(text).tolist() == tokens.encode(text, add_special_tokens=False).ids, repr(text)


def test_packing_gives_the_added_token_as_the_tokeniser_does(spark):
    import public_tokenizers
    from tokenizers import Tokenizer

    tokens = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    own = packing.ids_of(queries.vocabulary())
    rng = random.Random(7)
    texts = ["<|endoftext|>", "a<|endoftext|>", " <|endoftext|> b", "<|endoftext|><|endoftext|>", "<|endoftext|", "<|ENDOFTEXT|>", "x " * 3000 + "<|endoftext|> y"]
    texts += ["".join(rng.choice(["a", "don't", " ", "  ", "\n", "é", "1", "!", "<|endoftext|>", "<|", " the"]) for _ in range(12)) for _ in range(500)]
    expected = {i: tokens.encode(t, add_special_tokens=False).ids for i, t in enumerate(texts)}
    assert all(own.with_added(t).tolist() == expected[i] for i, t in enumerate(texts))
    for r in packing.pack(spark.createDataFrame(list(enumerate(texts[:7])), "doc_id long, text string"), queries.vocabulary()).collect():
        ids = [*expected[r.doc_id], 1]
        assert r.doc_tokens == len(ids) and np.frombuffer(bytes(r.ids), "<u4").tolist() == ids[r.start : r.start + r.length]


# 2 decontamination


def test_leaks_on_random_texts(spark, odd, nothing):
    rng = random.Random(2)
    vocabulary = [f"v{i}" for i in range(400)]
    items = {i: [rng.choice(vocabulary) for _ in range(rng.choice([5, 9, 25, 40, 70, 300]))] for i in range(20)}
    items[20] = ["only", "three", "words"]
    docs = {}
    for d in range(120):
        text = [rng.choice(vocabulary) for _ in range(rng.randrange(0, 400))]
        if d % 3 == 0:
            item = list(items[d % 21])
            if d % 2 and len(item) > 30:
                item[len(item) // 2] = "changed"
            text[len(text) // 2 : len(text) // 2] = item
        docs[d] = " ".join(text)
    benchmark = spark.createDataFrame([(i, " ".join(t).upper(), "x") for i, t in items.items()] + [(98, None, "x"), (99, "", "x")], "item_id long, text string, doc_id string")
    got = {(r.doc_id, r.item_id) for r in decontaminate.find_leaks(spark.createDataFrame(list(docs.items()), "doc_id long, text string"), benchmark).collect()}
    expected = set()
    sets = {i: shingle_sets(" ".join(t), 5) for i, t in items.items()}
    for d, text in docs.items():
        have = shingle_sets(text, 5)
        expected |= {(d, i) for i, s in sets.items() if len(s & have) >= 0.8 * len(s) and len(items[i]) >= 5}
        expected |= {(d, 20)} if "only three words" in text else set()
    assert got == expected and len(expected) >= 30
    assert decontaminate.find_leaks(odd, benchmark).count() == 0
    assert decontaminate.find_leaks(nothing, benchmark).count() == 0 and decontaminate.find_leaks(odd, benchmark.where("false")).count() == 0
    itself = decontaminate.find_leaks(odd, odd.where("doc_id in (2, 7)").select(F.col("doc_id").alias("item_id"), "text"))
    assert {(r.doc_id, r.item_id, r.n_rows) for r in itself.collect()} >= {(1, 2, 1), (2, 2, 2), (7, 7, 1), (8, 7, 1)}


def test_leaks_are_found_at_every_item_length(spark):
    """Passages edited until an edit more would leave less than 0.8 of the item's 5-word shingles."""
    rng = random.Random(8)
    items, docs, expected = [], [], set()
    for n in range(15, 66):
        for _ in range(6):
            i = len(items)
            words = [f"i{i}w{j}" for j in range(n)]
            items.append((i, " ".join(words)))
            shown, own = list(words), shingle_sets(items[-1][1], 5)
            for _ in range(200):
                edited = list(shown)
                edited[rng.randrange(n)] = f"e{rng.random()}"
                if len(own & shingle_sets(" ".join(edited), 5)) >= 0.8 * len(own):
                    shown = edited
            filler = [f"d{i}x{j}" for j in range(80)]
            docs.append((i, " ".join([*filler[:40], *shown, *filler[40:]])))
            expected.add((i, i))
    leaks = decontaminate.find_leaks(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"))
    assert {(r.doc_id, r.item_id) for r in leaks.collect()} == expected


def test_best_stretch_matches_all_stretches():
    rng = np.random.default_rng(6)
    for _ in range(200):
        own = np.arange(6)
        weight = 1 / rng.integers(1, 4, 6)
        at = np.sort(rng.choice(60, rng.integers(1, 25), replace=False))
        places = rng.integers(0, 9, len(at))
        got = decontaminate.best_stretch(places, at, own, weight, 18)[0]
        every = [{p for p, a in zip(places.tolist(), at.tolist()) if p < 6 and s <= a and a + 5 <= s + 18} for s in range(60)]
        assert abs(got - max(sum(weight[list(x)]) for x in every) / weight.sum()) < 1e-12


def test_leaks_do_not_depend_on_blocks_of_items(spark, monkeypatch):
    rng = random.Random(12)
    shared = [f"b{i}" for i in range(12)]
    items = [(i, " ".join([*shared, *(f"u{i}x{j}" for j in range(16))])) for i in range(6)]
    docs = [(d, " ".join([*(f"n{rng.random()}" for _ in range(30)), *shared[: d % 13], *items[d % 6][1].split()[12 - d // 6 :], "end"])) for d in range(72)]
    tables = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    whole = sorted((r.doc_id, r.item_id, round(r.similarity, 9)) for r in decontaminate.find_leaks(*tables).collect())
    monkeypatch.setattr(decontaminate, "MAX_ITEMS", 2)
    assert whole and whole == sorted((r.doc_id, r.item_id, round(r.similarity, 9)) for r in decontaminate.find_leaks(*tables).collect())


def test_hamming_search_is_complete():
    rng = np.random.default_rng(1)
    index = decontaminate.Index(8)
    index.values = rng.integers(0, 2**63, 50, dtype=np.uint64)
    index.prints, index.owners = index.values.tolist(), [(i, 0) for i in range(50)]
    index.close()
    noise = np.bitwise_or.reduce([np.uint64(1) << rng.integers(0, 64, 4000, dtype=np.uint64) for _ in range(11)])
    found = index.values[rng.integers(0, 50, 4000)] ^ noise
    distance = np.bitwise_count(found[:, None] ^ index.values[None])
    at, which = index.search(found)
    assert set(zip(at.tolist(), which.tolist())) == set(zip(*[x.tolist() for x in np.nonzero(distance <= decontaminate.RADIUS)]))


# 3 Jaccard join


def brute_classes(rows, k, threshold):
    sets = [shingle_sets(t, k) for _, t in rows]
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    links = [0] * len(rows)
    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= threshold * len(sets[i] | sets[j]):
                links[i] += 1
                links[j] += 1
                parent[root(i)] = root(j)
    least = {}
    for i, (doc_id, _) in enumerate(rows):
        if doc_id is not None:
            least[root(i)] = min(doc_id, least.get(root(i), doc_id))
    return sorted(((d, len(sets[i]), least.get(root(i)), links[i]) for i, (d, _) in enumerate(rows)), key=repr)


def near_copies(seed):
    """Families of edited copies with shared passages, short texts and a family of a third of all rows."""
    rng = random.Random(seed)
    words = [f"t{i}" for i in range(60)]
    passage = [rng.choice(words) for _ in range(30)]
    out = []
    for family in range(12):
        base = [rng.choice(words) for _ in range(rng.choice([2, 3, 8, 9, 10, 11, 40, 120]))] + (passage if family % 2 else [])
        for _ in range(60 if family == 3 else 8):
            text = list(base)
            for _ in range(rng.randrange(0, 4)):
                text[rng.randrange(len(text))] = rng.choice([*words, "new" + str(rng.random())])
            out.append((len(out), " ".join(text)))
    return out


@pytest.mark.parametrize("frequent", [0.01, 2.0])
def test_classes_match_all_pairs(spark, monkeypatch, frequent):
    monkeypatch.setattr(jaccard, "FREQUENT", frequent)
    rows = near_copies(4)
    got = jaccard.similar_text_classes(spark.createDataFrame(rows, "doc_id long, text string").repartition(5)).collect()
    assert sorted(map(tuple, got), key=repr) == brute_classes(rows, 3, 90)


def test_classes_with_tiles(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "TILE_TOKENS", 3000)
    rows = near_copies(9)
    got = jaccard.similar_text_classes(spark.createDataFrame(rows, "doc_id long, text string").repartition(3), threshold=80).collect()
    assert sorted(map(tuple, got), key=repr) == brute_classes(rows, 3, 80)


def test_classes_on_odd_rows(odd, nothing):
    rows = [(r.doc_id, r.text) for r in odd.select("doc_id", "text").collect()]
    assert sorted(map(tuple, jaccard.similar_text_classes(odd).collect()), key=repr) == brute_classes(rows, 3, 90)
    assert jaccard.similar_text_classes(nothing).count() == 0


def kept_tables(monkeypatch):
    """The tables that the operator stores, by name."""
    found, stored = {}, jaccard.stored
    monkeypatch.setattr(jaccard, "stored", lambda df, name: found.setdefault(name, stored(df, name)))
    return found


def sliding(n, parts=4):
    """Texts of which each shares three of its four passages with the next one: all share rare shingles in a chain, none link; and two near copies."""
    rng = random.Random(8)
    passages = [" ".join(f"w{rng.random()}" for _ in range(12)) for _ in range(n + parts)]
    texts = [" ".join(passages[i : i + parts]) for i in range(n)]
    return list(enumerate([*texts, texts[5] + " end", texts[n // 2] + " end"]))


def test_sets_that_cannot_link_share_no_block(spark, monkeypatch):
    tables = kept_tables(monkeypatch)
    rows = sliding(120)
    got = jaccard.similar_text_classes(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()
    assert sorted(map(tuple, got), key=repr) == brute_classes(rows, 3, 90)
    assert sorted(r["count"] for r in tables["jaccard-members"].groupBy("block").count().collect()) == [2, 2]


def test_signatures_with_the_same_holders_are_compared_once(spark, monkeypatch):
    edges, components = [], connected_components
    monkeypatch.setattr(jaccard, "connected_components", lambda df: edges.append(df.count()) or components(df))
    rng = random.Random(2)
    texts = [" ".join(f"w{rng.random()}" for _ in range(2000)) for _ in range(3)]
    rows = list(enumerate([x for t in texts for x in (t, t + " more", t + " still more")]))
    got = jaccard.similar_text_classes(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()
    assert sorted(map(tuple, got), key=repr) == brute_classes(rows, 3, 90)
    assert edges[0] < 60  # they share some 200 signatures each


@pytest.mark.parametrize("threshold", [80, 90])
def test_classes_with_tiles_of_holders(spark, monkeypatch, threshold):
    monkeypatch.setattr(jaccard, "TILE_HOLDERS", 4)
    rows = near_copies(9)
    got = jaccard.similar_text_classes(spark.createDataFrame(rows, "doc_id long, text string").repartition(3), threshold=threshold).collect()
    assert sorted(map(tuple, got), key=repr) == brute_classes(rows, 3, threshold)


@pytest.mark.parametrize("pair_words", [1, 1 << 21])
@pytest.mark.parametrize("threshold", [80, 90])
def test_sketches_lose_no_link(monkeypatch, threshold, pair_words):
    monkeypatch.setattr(jaccard, "PAIR_WORDS", pair_words)
    rng = np.random.default_rng(5)
    sets = []
    for size in [1, 2, 11, 30, 63, 64, 65, 130, 900, 3000, 20_000]:  # the last is over SKETCH_WORDS
        base = rng.integers(0, 2**63, size=size, dtype=np.uint64)
        sets += [np.unique(np.concatenate([base[rng.random(size) > lost], rng.integers(0, 2**63, size=1, dtype=np.uint64)])) for lost in (0, 0.02, 0.06, 0.12, 0.4)]
    assert {len(jaccard.sketch(x)) // 8 for x in sets} >= {1, 2, 4, 16, 64, 128}
    part = np.arange(len(sets)) % 2
    places = [(key, i, j, s) for key in (3, 9) for i, j in ((0, 0), (0, 1), (1, 1)) for s in range(len(sets)) if part[s] in (i, j) and s % 3 != key % 2]
    columns = {"key": [x[0] for x in places], "i": [x[1] for x in places], "j": [x[2] for x in places], "s": [x[3] for x in places]}
    columns |= {"part": [int(part[x[3]]) for x in places], "n": [len(sets[x[3]]) for x in places], "sketch": [jaccard.sketch(sets[x[3]]) for x in places]}
    out = [(a, b) for r in jaccard._alike(threshold)(iter(pa.table(columns).to_batches(max_chunksize=7))) for a, b in zip(r["a"].to_pylist(), r["b"].to_pylist())]
    names = list(range(len(sets)))
    for _ in names:
        for a, b in out:
            names[a] = names[b] = min(names[a], names[b])
    same = lambda a, b: any(a % 3 != k % 2 and b % 3 != k % 2 for k in (3, 9))  # noqa: E731  of one run
    linked = [(a, b) for a in range(len(sets)) for b in range(a) if same(a, b) and 100 * (c := len(np.intersect1d(sets[a], sets[b]))) >= threshold * (len(sets[a]) + len(sets[b]) - c)]
    assert len(linked) > 5 and all(names[a] == names[b] for a, b in linked)
    assert len(set(names)) > len(sets) // 2  # and unlike ones stay apart


# 4 secrets


def test_secret_spans_match_plain_regular_expressions(spark):
    rng = random.Random(8)
    bits = ["token", "SECRET", "=", ": ", '"', "abcdefgh", "api_key", "AKIA", "ABCDEFGH1234", "0123456789abcdef" * 2, "é", "😀", "\n", " ", "-", "a1"]
    texts = ["".join(rng.choice(bits) for _ in range(14)) for _ in range(400)] + ["", None]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, text string")
    spans = secrets.span_text(F.filter(secrets.find_spans(F.col("text")), lambda s: s["kind"] != "key"))
    for r in df.select("i", spans.alias("s")).collect():
        assert r.s == base_spans(texts[r.i] or ""), texts[r.i]


def test_ownership_separates_copies_from_one_owner(spark, odd, nothing):
    rows = [(i, f"password={'shared99example' if i < 6 else 'owned77value' + str(i)}", f"r{i}", f"o{i % 4}") for i in range(8)]
    docs = spark.createDataFrame([*rows, (9, None, None, None)], "doc_id long, text string, repo string, owner string")
    got = {r.doc_id: (r.n_example, r.n_live, r.most_owners) for r in secrets.scan(docs, "repo", "owner", ["doc_id"]).collect()}
    assert got == {**{i: (1, 0, 4) for i in range(6)}, 6: (0, 1, 1), 7: (0, 1, 1), 9: (0, 0, 0)}
    assert secrets.scan(odd, "source", "lang", ["doc_id"]).count() == odd.count()
    assert secrets.scan(nothing, "source", "lang", ["doc_id"]).count() == 0


def test_redaction(spark):
    text, spans = "é password=abcdefgh1 x", secrets.find_spans(F.col("text"))
    df = spark.createDataFrame([(text,), ("clean",)], "text string")
    cut = F.transform(spans, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end")))
    assert [r[0] for r in df.select(secrets.redacted(F.col("text"), cut)).collect()] == ["é [SECRET] x", "clean"]


# 5 licences


def test_license_places_and_blocks(spark, odd, nothing):
    filler = " ".join(f"word{i}" for i in range(300))
    grant = licenses.TEMPLATES["mit-grant"]
    texts = [f"{filler} MIT\n-License {filler}", f"{filler} {grant} {filler}", "the apache license. General Public License", "smit license", "", None, filler]
    got = [tuple(r) for r in licenses.find_licenses(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).orderBy("doc_id").collect()]
    assert got[0][1:7] == (602, 1, 300, 300, "mit", "mit") and got[0][7] == 1.0
    assert got[1][2:7] == (0, None, None, "", "mit-grant") and got[1][7] == 1.0 and got[1][8] >= 1
    assert got[2][2:6] == (2, 1, 3, "apache,gpl")
    assert all(r[2] == 0 and r[6] == "" and r[7] == 0.0 for r in got[3:])
    assert licenses.find_licenses(odd).count() == odd.count() and licenses.find_licenses(nothing).count() == 0


def test_license_blocks_match_all_windows(spark):
    rng = random.Random(6)
    template = {"t": "one two three four five six seven eight nine ten"}
    words = template["t"].split() + ["x", "y", "z"]
    texts = [" ".join(rng.choice(words) for _ in range(rng.randrange(0, 150))) for _ in range(60)]
    got = {r.doc_id: r.n_blocks for r in licenses.find_licenses(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), template).collect()}
    for i, text in enumerate(texts):
        w = text.split()
        blocks = [w[s : s + 30] for s in range(0, max(1, len(w)), 10)]
        assert got[i] == sum(len(set(b) & set(template["t"].split())) >= 8 for b in blocks), text


def test_license_templates_of_any_length_are_found_whole(spark):
    long = " ".join(f"clause{i}" for i in range(400))
    templates = {**licenses.TEMPLATES, "long": long}
    filler = " ".join(f"word{i}" for i in range(331))
    names = sorted(templates)
    rows = [(i, f"{filler} {templates[n]} {filler}") for i, n in enumerate(names)]
    rows += [(100, "This code is released under the Apache License"), (101, "The license covers it; patches released late fall under no warranty.")]
    got = {r.doc_id: r for r in licenses.find_licenses(spark.createDataFrame(rows, "doc_id long, text string"), templates, names=licenses.NAMES).collect()}
    for i, name in enumerate(names):
        assert name in got[i].labels.split(",") and got[i].score == 1.0, name
    assert got[100].labels == "apache" and got[101].labels == ""


def test_license_filters_lose_nothing_and_spare_work(spark):
    rng = random.Random(8)
    words = [f"t{i}" for i in range(20)]
    vocabulary, (template,) = licenses.template_sets({"t": " ".join(words)}, 0.8, {}, {})
    texts = [" ".join(rng.choice(words + [f"x{i}" for i in range(rng.choice([2, 30, 200]))]) for _ in range(rng.randrange(1, 400))) for _ in range(80)]
    total, blocks = collections.Counter(), 0
    for text in texts:
        part = next(W.words_of(pa.array([text]), W.ALNUM_WORDS))
        code = np.minimum(np.searchsorted(vocabulary, part.hashes), len(vocabulary) - 1)
        hits = np.flatnonzero(vocabulary[code] == part.hashes)
        rows, _, counts = licenses.blocks_with(template, hits, code[hits], part.row_of_word(), part.bounds)
        w = text.split()
        own = [w[s : s + 60] for s in range(0, len(w), 20)]
        assert len(rows) == counts["match"] == sum(len(set(b) & set(words)) >= 16 for b in own)
        total.update(counts)
        blocks += len(own)
    assert blocks > total["prefix"] >= total["length"] >= total["position"] >= total["match"] > 0


# 6 chat


def read_back(turns):
    windows = chat.format_conversations(turns, stride=40, history=12)
    back = collections.defaultdict(list)
    for r in chat.read_back(windows).collect():
        back[r.conv_id].append((r.place, r.role, r.text, r.loss))
    return windows, {k: [x[1:] for x in sorted(v)] for k, v in back.items()}


def test_chat_round_trip(spark):
    rng = random.Random(1)
    rows = []
    for conv in [*range(20), None]:
        for turn in range(200 if conv == 3 else rng.randrange(1, 9)):
            role = "system" if turn == 0 and (conv or 0) % 2 else ["user", "assistant"][turn % 2]
            rows.append((conv, turn, role, rng.choice([None, "", "</s>[INST] ok [/INST]", "\\l \\b \\e \\\\", "words " * rng.randrange(60)]), 1))
    rows += [(5, None, None, "no turn", 1), (6, 0, "user", "tie", 1), (6, 0, "user", "tie", 1)]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, window int").repartition(4)
    windows, back = read_back(turns)
    expected = collections.defaultdict(list)
    for conv, turn, role, text, _ in rows:
        expected[conv].append(((turn is not None, turn or 0), role or "", text or ""))
    assert back == {k: [(r, t, r == "assistant") for _, r, t in sorted(v)] for k, v in expected.items()}
    for r in windows.collect():
        assert r.formatted.startswith("<s>[INST]") and r.formatted.endswith("[/INST]</s>")
        assert r.formatted.count("[INST]") == r.formatted.count("[/INST]") == len(r.turns)
        assert r.formatted.count("</s>") == r.formatted.count("<s>") == 1
    later = windows.where("conv_id = 3 and window > 0").collect()
    assert len(later) > 5 and all(r.turns[0].repeated for r in later) and any(sum(t.repeated for t in r.turns) > 1 for r in later)
    assert chat.format_conversations(turns.where("false")).count() == 0


# 7 neighbours


def test_neighbours_of_odd_vectors(spark):
    rng = np.random.default_rng(3)
    rows = [(i, rng.normal(size=8).tolist(), 1) for i in range(400)]
    rows += [(1000 + i, [1.0] * 8, 1) for i in range(300)]  # one vector very often
    rows += [(2000, None, 1), (2100, [0.0] * 8, 1), (2200, [float("nan")] * 8, 1), (2300, [None] * 8, 1), (2400, [1.0] * 3, 1), (2500, [], 1), (None, [1.0] * 8, 1)]
    got = collections.defaultdict(list)
    for r in neighbours.nearest(spark.createDataFrame(rows, "vec_id long, embedding array<double>, list int")).collect():
        got[r.query_id].append((r["rank"], r.vec_id, r.score))
    ids, v = np.array([r[0] for r in rows[:700]]), np.array([r[1] for r in rows[:700]])
    hits = 0
    assert set(got) == {0, 100, 200, 300, 1000, 1100, 1200}
    for q, found in got.items():
        score = np.sqrt(((v - v[ids == q][0]) ** 2).sum(1))
        score[ids == q] = np.inf
        best = np.lexsort((ids, score))[:10]
        assert [r for r, _, _ in sorted(found)] == list(range(1, 11))
        assert all(abs(s - score[ids == n][0]) < 1e-12 for _, n, s in found)
        hits += len({n for _, n, _ in found} & set(ids[best].tolist()))
    assert hits >= 0.9 * 70
    few = spark.createDataFrame(rows[:3], "vec_id long, embedding array<double>, list int")
    assert sorted(r.vec_id for r in neighbours.nearest(few).collect()) == [1, 2]
    assert neighbours.nearest(few.where("false")).count() == 0


@pytest.mark.parametrize("spread", [0.0, 1e-3])
def test_neighbours_count_a_repeated_vec_id_once(spark, spread):
    """Near vec_ids with 20 equal or different vectors, and a query with two vectors."""
    rng = np.random.default_rng(5)
    rows = [(i, rng.normal(size=8)) for i in range(1, 46)]
    query = rng.normal(size=8)
    rows += [(0, query), (0, query + 0.1), (0, query)]
    rows += [(n, query + 0.01 * (n - 70) + spread * rng.normal(size=8)) for n in (71, 72) for _ in range(20)]
    table = spark.createDataFrame([(i, v.tolist()) for i, v in rows], "vec_id long, embedding array<double>").repartition(3)
    score = {}
    for i, v in rows[:45] + rows[48:]:
        score[i] = min([score.get(i, np.inf), *(np.sqrt(((v - q) ** 2).sum()) for n, q in rows if n == 0)])
    got = sorted((r["rank"], r.vec_id, r.score) for r in neighbours.nearest(table).collect())
    expected = sorted(score, key=lambda i: (score[i], i))[:10]
    assert [r for r, _, _ in got] == list(range(1, 11)) and [i for _, i, _ in got] == expected
    assert all(abs(s - score[i]) < 1e-12 for _, i, s in got)


# 8 WARC


def test_records_are_linked_and_digested(spark):
    html = '<html lang="en"><head><title>T &amp; U</title><script>x<y</script></head><body><!-- no --><p>A&lt;b<br>c</p></body></html>'
    pages = spark.createDataFrame([(1, "http://a", html, 5), (2, None, None, 5), (3, "u", "<p>open <scr", 5)], "page_id long, url string, html string, block int")
    rows = {(r.page_id, r.record_type): r for r in warc.derivatives(pages).collect()}
    meta, text = rows[1, "metadata"], rows[1, "conversion"]
    assert text.block == "T & U\nA<b\nc" and meta.refers_to == text.refers_to != text.record_id != meta.record_id
    assert text.block_digest == "sha1:" + hashlib.sha1(text.block.encode()).hexdigest() and text.content_length == len(text.block.encode())
    assert meta.payload_digest == "sha1:" + hashlib.sha1(html.encode()).hexdigest() and "title: T &amp; U" in meta.block
    assert f"WARC-Refers-To: <{text.refers_to}>" in text.headers
    assert rows[2, "conversion"].block == "" and rows[3, "conversion"].block == "open <scr"
    assert warc.derivatives(pages.where("false")).count() == 0


# 9 language model


class PlainModel:
    """Counts of words, pairs, triples and of what stands before them, over the texts chosen."""

    def __init__(self, texts, chosen):
        self.grams, self.before = collections.Counter(), collections.Counter()
        for text, take in zip(texts, chosen):
            for i in range(len(text) if take else 0):
                for history in self.histories(text, i):
                    self.grams[*history, text[i]] += 1
                    self.before[history] += 1

    @staticmethod
    def histories(text, i):
        last = text[i - 1] if i else None
        return (), (last,), (text[i - 2] if i > 1 else None, last)

    def estimates(self, text, i, known):
        """The bucket of a token, and its probability by the four orders."""
        seen = [self.before[h] for h in self.histories(text, i)]
        bucket = min(int(math.log2(seen[2])), lm.CONTEXTS - 1) if seen[2] else lm.PAIR_ONLY if seen[1] else lm.UNSEEN
        return bucket, [1 / (known + 1), *(self.grams[*h, text[i]] / n if n else 0.0 for h, n in zip(self.histories(text, i), seen))]


def plain_scores(rows):
    texts = [[*space_words(r.text), None] for r in rows]
    parts = [lm.part_of(r.doc_id) for r in rows]
    train = PlainModel(texts, [p != 0 for p in parts])
    rest = PlainModel(texts, [p not in (0, 1) for p in parts])
    known = sum(len(g) == 1 for g in train.grams)
    events = collections.Counter()
    for text, part in zip(texts, parts):
        for i in range(len(text) if part == 1 else 0):
            bucket, p = rest.estimates(text, i, known)
            events[int(lm.event_of(np.array([bucket]), np.array(p)[:, None])[0])] += 1
    weights = lm.mixture(np.array(list(events), np.int64), np.array(list(events.values()), float), known)
    total = train.before[()]
    scale = math.log10(total + 0.1 * (known + 1))
    out = []
    for r, text in zip(rows, texts):
        score = 0.0
        for i in range(len(text)):
            bucket, p = train.estimates(text, i, known)
            score += math.log10(weights[bucket] @ p)
        count = [train.grams[w,] for w in text]
        out.append((repr(r.doc_id), len(text), sum(c > 0 for c in count), total, round(sum(math.log10(c + 0.1) - scale for c in count), 3), round(score, 3)))
    return sorted(out)


def lm_rows(table):
    return sorted((repr(r.doc_id), r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 3), round(r.score, 3)) for r in lm.score_texts(table).collect())


def same_scores(got, expected):
    return len(got) == len(expected) and all(g[:4] == e[:4] and np.allclose(g[4:], e[4:], rtol=1e-7, atol=0.01) for g, e in zip(got, expected))


@pytest.mark.parametrize("block, span", [(1 << 20, 1 << 22), (20_000, 50_000)])
def test_language_model_equals_plain_version(spark, odd, nothing, monkeypatch, block, span):
    docs = spark.read.parquet(f"{SMALL_DIR}/documents.parquet")
    monkeypatch.setattr(lm, "BLOCK_TOKENS", block)  # the small ones cut long texts and use many ranges
    monkeypatch.setattr(lm, "RANGE", span)
    table = docs.select("doc_id", "text").union(odd.select("doc_id", "text"))
    assert same_scores(lm_rows(table), plain_scores(table.collect()))
    held = [r for r in lm.score_texts(docs).collect() if r.held_out]
    assert held and sum(r.score for r in held) > sum(r.base_score for r in held)
    assert lm.score_texts(nothing).count() == 0


def test_language_model_without_some_part(spark):
    def numbers(*parts):
        return [i for i in range(400) if lm.part_of(i) in parts][:12]

    for ids in (numbers(0), numbers(2, 3), numbers(0, 1), numbers(1)):
        rows = [(i, None if i % 5 == 0 else "a b a c a b"[: i % 12]) for i in ids]
        table = spark.createDataFrame(rows, "doc_id long, text string")
        assert same_scores(lm_rows(table), plain_scores(table.collect()))


def test_language_model_keeps_the_shuffle_files_of_one_turn(spark, monkeypatch):
    dirs = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()

    def shuffle_files():
        return {f for d in dirs for f in pathlib.Path(d).glob("*/shuffle_*.data")}

    write, written = lm.stored, []

    def stored(df, name):
        before = shuffle_files()
        out = write(df, name)
        written.append(name)
        until = time.monotonic() + 10  # executors delete on their own
        while shuffle_files() - before and time.monotonic() < until:
            time.sleep(0.1)
        assert not shuffle_files() - before, name
        return out

    monkeypatch.setattr(lm, "stored", stored)
    monkeypatch.setattr(lm, "BLOCK_TOKENS", 20_000)
    monkeypatch.setattr(lm, "RANGE", 50_000)
    docs = spark.read.parquet(f"{SMALL_DIR}/documents.parquet")
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    setting = spark.conf.get(key)
    assert lm.score_texts(docs).count() == docs.count()
    assert written == ["lm-blocks", *["lm-totals"] * 4, *["lm-counted"] * 4] and spark.conf.get(key) == setting


def test_language_model_sends_every_ngram_in_one_turn(spark, odd):
    docs = spark.read.parquet(f"{SMALL_DIR}/documents.parquet").select("doc_id", "text").union(odd.select("doc_id", "text"))
    blocks = docs.mapInArrow(lm._blocks(20_000), lm._BLOCK).localCheckpoint()

    def sent(*how):
        rows = blocks.mapInArrow(lm._send(4, 50, *how), "part int, block long, grams binary, n binary, deleted binary").collect()
        return [(r.part, r.block, *(lm.unsqueeze(x).tolist() for x in (r.grams, r.n, r.deleted))) for r in rows]

    def size(rows):
        return sum(len(r[2]) for r in rows)

    whole, turns = sent(), [sent(turn, 2) for turn in range(4)]
    assert sorted(whole) == sorted(sum(turns, [])) and all(0 < size(t) < 0.3 * size(whole) for t in turns)


def test_language_model_adds_up_to_one(spark):
    """Over all known words, the end and one unknown word, whatever the history."""
    words = ["a", "b", "c", "d"]
    rng = random.Random(3)
    rows = [(i, " ".join(rng.choices(words, k=rng.randrange(0, 9)))) for i in range(300)]
    texts = [([*t.split(), None], lm.part_of(i)) for i, t in rows]
    model = PlainModel([t for t, _ in texts], [p != 0 for _, p in texts])
    weights = lm.mixture(np.zeros(0, np.int64), np.zeros(0), 5)
    for text in (["a", "b"], ["zz", "a"], ["a", "zz"], ["zz", "yy"], []):
        total = 0.0
        for word in [*words, None, "unknown"]:
            bucket, p = model.estimates([*text, word], len(text), 5)
            total += weights[bucket] @ p
        assert abs(total - 1) < 1e-9


def test_mixture_finds_the_better_order():
    s = lm.STEPS
    event = np.array([((3 * s + 20) * s + 2) * s + 0], np.int64)  # bucket 3, order 2 likely, order 3 impossible
    weights = lm.mixture(event, np.array([100.0]), 50)
    assert weights[3].argmax() == 2 and np.allclose(weights.sum(1), 1)
    assert weights[lm.PAIR_ONLY, 3] == 0 and not weights[lm.UNSEEN, 2:].any()


# 10 quality


def test_quality_network_separates_labels_and_reads_whole_texts(spark, odd, nothing):
    folder = SMALL_DIR.replace("0.001", "0.01")
    scored = queries.op10_quality_network(spark, folder).join(spark.read.parquet(f"{folder}/labels.parquet"), "doc_id").toPandas()
    held = scored[scored.held_out]
    assert (held.predicted == held.quality).mean() >= 0.9
    assert (held[held.quality == 1].predicted == 1).mean() >= 0.95
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    model = quality.fit(docs, spark.read.parquet(f"{folder}/labels.parquet"))
    text = np.frombuffer((("good words and more " * 9 + "\n") * 800).encode(), np.uint8)
    assert abs(quality.scores(model, [text])[0] - quality.scores(model, [text, text[:50]])[0]) < 1e-6
    out = quality.score_quality(odd, model).collect()
    assert len(out) == odd.count() and all(0 <= r._score <= 1 for r in out)
    assert quality.score_quality(nothing, model).count() == 0
    assert quality.fit(nothing, spark.createDataFrame([], "doc_id long, quality int")) == 0.5


def plain_network(model, text):
    """One text by loops: every window of every chunk, the plane of repeated words, maximum and mean, logistic unit."""
    seps = {0, 9, 10, 11, 12, 13, 32}
    spans, at = [], 0
    while at < len(text):
        end = at
        while end < len(text) and text[end] not in seps:
            end += 1
        if end > at:
            spans.append((at, end))
        at = end + 1
    plane = [0.0] * len(text)
    for (a, b), (c, d) in zip(spans, spans[1:]):
        if bytes(text[a:b]).lower() == bytes(text[c:d]).lower():
            plane[c:d] = [1.0] * (d - c)
    chunks = -(-(len(text) + quality.REACH) // quality.CHUNK)
    data = [*[0] * quality.REACH, *text, *[0] * (chunks * quality.CHUNK - len(text))]
    plane = [*[0.0] * quality.REACH, *plane, *[0.0] * (chunks * quality.CHUNK - len(text))]
    tops = []
    for c in range(chunks):
        best = np.full(quality.FILTERS, -np.inf)
        for w in range(c * quality.CHUNK, (c + 1) * quality.CHUNK, quality.STRIDE):
            window = np.concatenate([[*model["vectors"][data[i]], plane[i]] for i in range(w, w + quality.WIDTH)])
            best = np.maximum(best, window @ model["filters"])
        tops.append(np.maximum(best + model["shift"], 0))
    features = np.concatenate([np.max(tops, axis=0), np.mean(tops, axis=0)])
    return 1 / (1 + np.exp(-(features @ model["weights"] + model["bias"][0])))


def test_quality_scores_equal_plain_loops_whole_and_in_slices(monkeypatch):
    rng = random.Random(5)
    samples = ["", "a", "Same same SAME other\tother", "no repeats here " * 70, "tick tick " * 200, "x" * 1500 + " " + "x" * 1500 + " y", "  \n " * 300,
               " ".join(rng.choice(["bad", "bad", "Bad", "w" * 600, "héé", "tail"]) for _ in range(120))]
    texts = [np.frombuffer(t.encode(), np.uint8) for t in samples]
    model = quality.train(texts, np.array([i % 2 for i in range(len(texts))], np.float32))
    plain = [plain_network(model, t) for t in texts]
    assert np.allclose(quality.scores(model, texts), plain, atol=1e-5)
    planes = [quality.repeats(t).tolist() for t in texts]
    for size in (512, 1024, 2048):  # words as long as a slice or longer, repeats across its border
        monkeypatch.setattr(quality, "SLICE", size)
        assert [quality.repeats(t).tolist() for t in texts] == planes
        assert np.allclose([quality.long_score(model, t) for t in texts], plain, atol=1e-5)


def test_quality_sample_counts_equal_rows_once_and_keeps_user_columns(spark):
    good, bad = "calm and clear sentence number ", "spam spam buy buy now now "
    rows = [(i, (good if i % 2 else bad) + str(i), "mine") for i in range(200)]
    hot = next(i for i in range(200, 300) if zlib.crc32(str(i).encode()) % 5)
    docs = spark.createDataFrame(rows + [(hot, bad + "hot", "mine")] * 5000 + [(hot + 1000, None, None)], "doc_id long, text string, _score string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(200)] + [(hot, 0)] * 300, "doc_id long, quality int")
    model = quality.fit(docs, labels)
    assert isinstance(model, dict)
    again = quality.fit(docs.repartition(7), labels.union(labels))
    assert all(np.array_equal(model[k], again[k]) for k in model)
    out = quality.score_quality(docs.where("doc_id < 200"), model, "score").collect()
    assert all(r._score == "mine" and (r.score >= 0.5) == bool(r.doc_id % 2) for r in out) and len(out) == 200
    with pytest.raises(ValueError):
        quality.score_quality(docs, model)


def test_quality_sample_is_bounded_in_bytes(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(quality, "train", lambda texts, y: seen.append([len(t) for t in texts]) or {})
    monkeypatch.setattr(quality, "SAMPLE_TEXT", 1000)
    monkeypatch.setattr(quality, "SAMPLE_BYTES", 4000)
    docs = spark.createDataFrame([(i, "w" * (900 if i % 3 else 1001)) for i in range(120)], "doc_id long, text string")
    quality.fit(docs, spark.createDataFrame([(i, i % 2) for i in range(120)], "doc_id long, quality int"))
    assert seen == [[900] * 8]


# the pipeline


def test_pipeline_stage_by_stage(spark, odd, nothing):
    import corpus_pipeline

    docs = spark.read.parquet(f"{SMALL_DIR}/documents.parquet")
    benchmark = [r.text for r in spark.read.parquet(f"{SMALL_DIR}/benchmark.parquet").collect()]
    stages = dict(corpus_pipeline.STAGES)
    kept = stages["near_duplicates"](spark, docs, SMALL_DIR)
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    expected = {d for d, _, c, _ in brute_classes(rows, corpus_pipeline.SHINGLE, corpus_pipeline.NEAR) if d == c}
    assert {r.doc_id for r in kept.collect()} == expected and kept.columns == docs.columns
    clean = stages["decontamination"](spark, kept, SMALL_DIR)
    items = [shingle_sets(t, 5) for t in benchmark]
    leaking = {d for d, t in rows if any(len(s & shingle_sets(t, 5)) >= 0.8 * len(s) for s in items)}
    assert {r.doc_id for r in clean.collect()} == expected - leaking
    masked = stages["secrets"](spark, clean, SMALL_DIR)
    assert masked.columns == docs.columns and {r.doc_id for r in masked.collect()} == expected - leaking
    changed = [r for r in masked.collect() if r.text != dict(rows)[r.doc_id]]
    assert all("[SECRET]" in r.text and r.n_chars == len(r.text) for r in changed)
    out = corpus_pipeline.run(spark, SMALL_DIR)
    assert {r.doc_id for r in out.collect()} <= expected - leaking
    for table in (odd, nothing):
        now = table
        for _, stage in corpus_pipeline.STAGES[:-1]:
            now = stage(spark, now, SMALL_DIR)
            assert now.columns == table.columns
        assert corpus_pipeline.STAGES[-1][1](spark, now, SMALL_DIR).count() >= now.count()


def test_pipeline_drops_near_copies_of_five_word_shingles(spark):
    import corpus_pipeline

    docs = spark.read.parquet(f"{SMALL_DIR}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    expected = {d for d, _, c, _ in brute_classes(rows, 5, 80) if d == c}
    kept = corpus_pipeline.one_of_each_group(spark, docs, SMALL_DIR)
    assert {r.doc_id for r in kept.collect()} == expected < {d for d, _, c, _ in brute_classes(rows, 3, 90) if d == c}


def test_pipeline_decides_by_doc_id_and_text(spark):
    import corpus_pipeline

    def text(name, n=40):
        return " ".join(f"{name}{i}" for i in range(n))

    leak = spark.read.parquet(f"{SMALL_DIR}/benchmark.parquet").first().text
    secret = "password = Zq8fK2mVx7Lp4Tn9"
    rows = [
        (1, text("a")), (2, text("a")), (2, text("b")),  # one text of doc_id 2 is a copy, the other is clean
        (3, text("c")), (3, text("d")), (3, None),  # three texts of one doc_id
        (4, text("e")), (4, text("e")), (5, text("f") + " more"), (5, text("f")),
        (None, text("a") + " end"), (None, text("g")), (None, text("g")), (None, text("h") + " " + leak), (None, text("i") + " " + secret),
        (6, text("j") + " " + leak), (6, text("k")), (7, text("l") + " " + secret), (7, text("m")),
    ]
    now = spark.createDataFrame([(i, t, "en", "src") for i, t in rows], "doc_id long, text string, lang string, source string").repartition(3)
    for name in ("near_duplicates", "decontamination", "secrets"):
        now = dict(corpus_pipeline.STAGES)[name](spark, now, SMALL_DIR)
    expected = [rows[i] for i in (0, 2, 3, 4, 5, 6, 9, 11, 16, 18)] + [(None, text("i") + " [SECRET]"), (7, text("l") + " [SECRET]")]
    assert sorted(((r.doc_id, r.text) for r in now.collect()), key=repr) == sorted(expected, key=repr)


def test_registered_queries(spark):
    import __spark_entry__ as entry
    from check_oracle import compare, duck_connection

    names = entry.queries()
    assert [n for n in range(1, 11) if not any(q.startswith(f"op{n}_") for q in names)] == [] and "pipeline" in names
    connection = duck_connection(SMALL_DIR)
    for name in entry.LLM_ORACLE_SQL:
        ok, message = compare(spark, connection, SMALL_DIR, name)
        assert ok, message
    turns = queries.op6_chat_windows(spark, SMALL_DIR).where("conv_id = -7").first()
    text = "</s>[INST] ok [/INST]"
    assert turns.loss_chars == len(text) and turns.loss_sha256 == hashlib.sha256(text.encode()).hexdigest()
    assert zlib.crc32(b"1") and re and low("A") == "a"


def test_pipeline_stages_keep_columns_named_like_their_own(spark):
    import corpus_pipeline

    docs = spark.read.parquet(f"{SMALL_DIR}/documents.parquet")
    clashing = {c: F.concat(F.lit(c), F.col("doc_id").cast("string")) for c in ("_key", "_goes", "_live", "_repository", "_score", "_row", "_spans", "goes", "n", "links")}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        plain = {r.doc_id: r.text for r in stage(spark, docs, SMALL_DIR).collect()}
        out = stage(spark, docs.withColumns(clashing), SMALL_DIR).collect()
        assert {r.doc_id: r.text for r in out} == plain, name
        assert all(r[c] == f"{c}{r.doc_id}" for r in out for c in clashing), name


def test_pipeline_stages_get_texts_in_small_arrow_batches(spark, monkeypatch):
    import corpus_pipeline
    from rulegrid.llm import shared

    def kept_if_small(*_):
        def run(batches):
            for batch in batches:
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array([float(batch.nbytes < 4 << 20)] * batch.num_rows)], names=[*batch.schema.names, "_score"])

        return run

    monkeypatch.setattr(quality, "fit", lambda docs, labels: 0.5)
    monkeypatch.setattr(quality, "_score", kept_if_small)
    monkeypatch.setattr(corpus_pipeline, "table", lambda *_: spark.createDataFrame([], "doc_id long, quality int"))
    docs = spark.range(0, 3000, 1, 1).selectExpr("id as doc_id", "repeat('word ', 800) as text")  # 12 MB in one task
    before = spark.conf.getAll.get(shared.BATCH)
    try:
        assert corpus_pipeline.good_quality(spark, docs, "").count() == 3000
        spark.conf.set(shared.BATCH, "32m")  # a bound of the caller's own stays
        shared.small_batches(spark)
        assert spark.conf.get(shared.BATCH) == "32m"
        assert corpus_pipeline.good_quality(spark, docs, "").count() == 0
    finally:
        spark.conf.unset(shared.BATCH)
        if before:
            spark.conf.set(shared.BATCH, before)
