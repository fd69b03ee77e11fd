from __future__ import annotations

import hashlib
import itertools
import random
import zlib
from collections import Counter

import numpy as np
import public_tokenizers as P
import pytest
from tokenizers import Tokenizer

from sievework.llm import bpe, packing

from . import brute

WORDS, BYTES = P.path("word_bpe_49k.json"), P.path("byte_bpe_50k.json")
TEXTS = [
    None, "", " \n\t", "Hello World's it'll don'T", "ΑΣ Σ ς ΟΔΟΣ", "a<|endoftext|>B <|startoftext|>", "x\x1cy \x1f z", "é É é", "１２ ½ ² ⅷ 12", "İstanbul ǅ ﬁ", "中文字 テスト",
    "a b\u0085c\xa0d​z", "́ͅ x", "a" * 500 + " " + "*" * 700, "😀👍🏽 x", "\x00a\x7f", "<| <|endoftext", "﻿ab", "'S 's''s", "ẞİ", "_a_b __ a1b2", "word " * 5000, "x" * 30000,
]


@pytest.fixture(scope="module")
def library():
    made = {}
    for path in (WORDS, BYTES):
        made[path] = Tokenizer.from_file(path)
        made[path].no_truncation()
        made[path].no_padding()
    return made


def docs(spark, texts=TEXTS):
    return spark.createDataFrame([(i, t, "clash") for i, t in enumerate(texts)], "doc_id long, text string, n_tokens string")


def test_ids_and_decoding_are_the_librarys(spark, library):
    lib = library[WORDS]
    got = {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in bpe.digests(docs(spark), WORDS).collect()}
    for i, text in enumerate(TEXTS):
        ids = lib.encode(text or "", add_special_tokens=False).ids
        shown = lib.decode(ids, skip_special_tokens=False)
        assert got[i] == (len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(shown.encode()).hexdigest()), text


def test_long_texts_and_repeated_rows(spark, library):
    """A text of megabytes, one of them a single word, and rows that come twice."""
    rng, lib = random.Random(2), library[WORDS]
    long = " ".join("".join(rng.choices("aeiounrstlé", k=rng.randint(1, 12))) for _ in range(400_000))
    texts = [long, "ab" * 200_000, long, "twice", "twice", None, None]
    got = sorted((r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in bpe.digests(docs(spark, texts), WORDS).collect())
    assert len(long) > 2_500_000 and [x[0] for x in got] == list(range(len(texts)))
    for i, n, ids_sha, text_sha in got:
        ids = lib.encode(texts[i] or "", add_special_tokens=False).ids
        assert (n, ids_sha) == (len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest())
        assert text_sha == hashlib.sha256(lib.decode(ids, skip_special_tokens=False).encode()).hexdigest()


def test_encode_then_decode_keeps_rows(spark, library):
    out = bpe.decode(bpe.encode(docs(spark), WORDS), WORDS).collect()
    assert len(out) == len(TEXTS)
    assert all(r.decoded == library[WORDS].decode(library[WORDS].encode(r.text or "", add_special_tokens=False).ids, skip_special_tokens=False) for r in out)
    assert bpe.digests(docs(spark, []), WORDS).collect() == []


def test_heap_and_scan_merge_alike():
    rng, model = random.Random(4), bpe.load(WORDS)
    for _ in range(300):
        word = "".join(rng.choice("aeinrst") for _ in range(rng.randint(1, 60)))
        ids = [model.inner[ord(c)] for c in word]
        assert bpe.merge_short(list(ids), model.rank_of, model.made) == bpe.merge_long(list(ids), model.rank_of, model.made)


def test_search_is_optimal_on_small_inputs():
    rng = random.Random(1)
    for _ in range(300):
        capacity = rng.choice([10, 20, 37, 60])
        items = [rng.randint(1, capacity) for _ in range(rng.randint(0, 11))]
        found = packing.bin_completion(dict(Counter(items)), capacity)
        used = Counter()
        for pattern, n in found:
            assert sum(pattern) <= capacity
            for s in pattern:
                used[s] += n
        assert used == Counter(items)
        fewest = brute.fewest_bins(items, capacity)
        assert sum(n for _, n in found) == fewest >= packing.lower_bound(dict(Counter(items)), capacity)


@pytest.mark.parametrize(("bins", "least", "parts", "slack"), [(6, 300, 3, 0), (10, 300, 3, 0), (20, 100, 5, 5), (30, 300, 3, 30)])
def test_search_beats_best_fit_at_full_capacity(bins, least, parts, slack):
    for seed in range(10):
        rng, items = random.Random(seed), []
        for _ in range(bins):  # sequences that can be filled but for a few tokens
            cuts = [0, *sorted(rng.sample(range(1, 2048 - least * parts), parts - 1)), 2048 - least * parts]
            own = [least + b - a for a, b in itertools.pairwise(cuts)]
            items += [own[0] - rng.randint(0, slack), *own[1:]]
        counts = dict(Counter(items))
        plain = sum(n for _, n in packing.best_fit(counts, 2048))
        found, bound, spent = packing.search(counts, 2048)
        used = Counter()
        for pattern, n in found:
            assert sum(pattern) <= 2048
            for s in pattern:
                used[s] += n
        assert used == Counter(items)
        assert sum(n for _, n in found) == bound == bins < plain and spent > 0


def test_ids_are_the_librarys_on_odd_texts(library):
    rng, model = random.Random(7), packing.load(BYTES)
    some = ["<|endoftext|>", "'s", "'LL", " ", "  ", "\n", "\r\n", "\t", "a", "B", "é", "日本", "😀", "\u00a0", "\u0085", "1", "234", "½", "_", "-", "...", "\x00", "ﬁ", "İ", "e\u0301", "word"]
    for _ in range(3000):
        text = "".join(rng.choice(some) for _ in range(rng.randint(1, 25)))
        assert model.ids(text).tolist() == library[BYTES].encode(text, add_special_tokens=False).ids, text
    long = " ".join(rng.choice(some) for _ in range(200_000))
    assert model.ids(long).tolist() == library[BYTES].encode(long, add_special_tokens=False).ids


@pytest.mark.parametrize("capacity", [2048, 64])
def test_pieces_are_packed_without_gaps(spark, library, capacity):
    texts = [*TEXTS, "same text here", "same text here"]
    rows = packing.pack_documents(docs(spark, texts), BYTES, capacity).collect()
    sequences, by_doc = {}, {}
    for r in rows:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
        by_doc.setdefault(r.doc_id, []).append(r)
    for places in sequences.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= capacity
    for i, text in enumerate(texts):
        ids = np.array([*library[BYTES].encode(text or "", add_special_tokens=False).ids, 0], "<u4")
        parts = sorted(by_doc[i], key=lambda r: r.piece)
        assert [p.piece for p in parts] == list(range(len(parts)))
        assert all(p.length == capacity for p in parts[1:])
        at = 0
        for p in parts:
            assert p.start == at and p.ids_crc32 == zlib.crc32(ids[at : at + p.length].tobytes())
            at += p.length
        assert at == len(ids)
    assert len(sequences) == packing.lower_bound(dict(Counter(r.length for r in rows)), capacity)


def test_packing_nothing(spark):
    assert packing.pack_documents(docs(spark, []), BYTES).collect() == []
    with pytest.raises(ValueError, match="capacity"):
        packing.pack(spark.createDataFrame([(1, 0, 70)], "doc_id long, piece int, length long"), 64)


def test_fillings_are_those_that_none_dominates():
    rng = random.Random(12)
    for _ in range(60):
        counts = dict(Counter(rng.randint(1, 12) for _ in range(rng.randint(1, 9))))
        room, first = rng.randint(1, 20), ()
        if rng.random() < 0.5:
            first = (rng.choice(list(counts)),)
        left = Counter(counts) - Counter(first)
        every = {tuple(sorted(c, reverse=True)) for k in range(len(list(left.elements())) + 1) for c in itertools.combinations(list(left.elements()), k) if sum(c) <= room}

        def dominated(c):
            waste, rest = room - sum(c), Counter(left) - Counter(c)
            return any(s <= waste for s in rest) or any(t < s <= t + waste for t in c for s in rest)

        got = list(packing.fillings(sorted(counts), counts, room, room, packing.Nodes(10**6), first))
        assert sorted(c for c, _ in got) == sorted(c for c in every if not dominated(c)) and len(got) == len(set(got))
        assert all(w == room - sum(c) for c, w in got)
        few = room // 3
        assert [c for c, w in packing.fillings(sorted(counts), counts, room, few, packing.Nodes(10**6), first)] == [c for c, w in got if w <= few]


def test_many_small_pieces_and_spent_nodes():
    counts = {1: 3000, 2: 900, 3: 5, 1500: 7, 1999: 3}
    patterns, bound, _ = packing.search(counts, 2048)
    assert sum(n for _, n in patterns) == bound
    filled = list(packing.completions(sorted(counts), counts, 2048, 2048, packing.Nodes(5000), ()))
    assert filled and all(sum(f) <= 2048 for f in filled)
    nodes = packing.Nodes(3)
    assert len(list(packing.fillings([5, 7], {5: 4, 7: 4}, 30, 30, nodes))) <= 3 and nodes.spent == 3
