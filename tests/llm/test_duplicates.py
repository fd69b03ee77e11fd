from __future__ import annotations

import random
import time

import numpy as np
import pytest

from sievework.llm import common, components, lattice, setjoin, suffix_dedup

from . import brute


def test_suffix_arrays_are_sorted():
    rng = random.Random(5)
    for _ in range(300):
        some = [bytes(rng.choice(b"ab") for _ in range(rng.randint(0, 60))) for _ in range(rng.randint(0, 8))]
        some += [s + b"zz" for s in some[:4]] + [b"q" * 50 + s for s in some[:3]] + some[:2]
        order, lcp = suffix_dedup.suffix_array(some)
        assert [some[i] for i in order] == sorted(some) and sorted(order) == list(range(len(some)))
        for k in range(1, len(order)):
            a, b = some[order[k - 1]], some[order[k]]
            assert a[: lcp[k]] == b[: lcp[k]] and (lcp[k] in (len(a), len(b)) or a[lcp[k]] != b[lcp[k]])


def passages():
    rng = random.Random(5)
    some = ["".join(rng.choice("abcdé ") for _ in range(rng.choice([30, 45, 60, 90]))) for _ in range(12)]
    rows = [(1, None), (2, ""), (3, "a" * 100), (4, "ab" * 40), (5, "b" * 39), (6, "x" * 300), (7, "xy " * 100), (8, "y" * 40), (9, "y" * 40)]
    for i in range(150):
        text = ""
        for _ in range(rng.randint(0, 4)):
            part, a = rng.choice(some), rng.randint(0, 10)
            text += "".join(rng.choice("abcdefgh") for _ in range(rng.randint(0, 40))) + part[a : len(part) - rng.randint(0, 10)]
        rows.append((10 + i, text))
    return rows


@pytest.mark.parametrize(("length", "gram"), [(40, 20), (40, 36), (16, 8)])
def test_repeats(spark, length, gram):
    rows = passages()
    got = suffix_dedup.digests(spark.createDataFrame(rows, "doc_id long, text string"), length, gram).collect()
    assert {r.doc_id: tuple(r)[1:] for r in got} == brute.repeats(rows, length)


def test_repeats_in_batches_of_other_sizes(spark):
    # the hashes of the halves differ in bits that batches of over a megabyte left out
    string = "cemzsqulcscfxxvt"
    rows = [(1, string), (2, string + "".join(random.Random(3).choices("abcdefghijklmnopqrstuvwxyz", k=1_400_000)))]
    got = suffix_dedup.digests(spark.createDataFrame(rows, "doc_id long, text string"), 16, 8).collect()
    assert {r.doc_id: tuple(r)[1:] for r in got} == brute.repeats(rows, 16)
    assert {r.doc_id: r.n_removed for r in got} == {1: 16, 2: 16}


@pytest.mark.parametrize("crowd", [0, 2, 5])
def test_repeats_with_split_anchors(spark, crowd):
    rows = passages()
    docs = spark.createDataFrame(rows, "key long, text string").fillna("")
    gone = {}
    for r in suffix_dedup.removed_ranges(docs, 40, 20, crowd, 5).collect():
        pairs = np.frombuffer(r.spans, "<u4").reshape(-1, 2)
        gone[r.key] = (int((pairs[:, 1] - pairs[:, 0]).sum()), len(pairs))
    assert gone == {i: w[1:3] for i, w in brute.repeats(rows, 40).items() if w[1]}


def thue_morse(a: str, b: str, steps: int = 10) -> str:
    bits = [0]
    for _ in range(steps):
        bits += [1 - x for x in bits]
    return "".join((a, b)[x] for x in bits)


def test_texts_that_cancel_out_in_sums_of_powers_are_told_apart(spark):
    one, two = thue_morse("a", "b"), thue_morse("b", "a")
    frame = spark.createDataFrame([(1, one), (2, two), (3, one)], "doc_id long, text string")
    assert {r.doc_id: r.component_id for r in setjoin.near_duplicates(frame).collect()} == {1: 1, 2: 2, 3: 1}
    rows = [(1, one), (2, two), (3, one + two)]
    got = suffix_dedup.digests(spark.createDataFrame(rows, "doc_id long, text string"), 600, 300).collect()
    assert {r.doc_id: tuple(r)[1:] for r in got} == brute.repeats(rows, 600)
    words = " ".join(thue_morse("a", "b")), " ".join(thue_morse("b", "a"))
    rows = [(k, w) for k, w in enumerate([*words, words[0] + " " + words[1]])]
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in setjoin.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == brute.near_duplicates(rows)


def test_many_contexts_of_one_anchor():
    rng = random.Random(8)
    core, length = bytes(rng.choice(b"abc") for _ in range(30)), 40
    bodies, left = [], []
    for _ in range(60):
        a = rng.randint(0, 10)
        bodies.append(bytes(rng.choice(b"xy") for _ in range(a)) + core + bytes(rng.choice(b"xy") for _ in range(10)))
        left.append(a)
    distinct = list(dict.fromkeys(zip(bodies, left, strict=True)))
    bodies, left = [b for b, _ in distinct], [a for _, a in distinct]
    low = [max(0, length - (len(b) - a)) for b, a in distinct]
    counts = [1] * len(bodies)
    strings = [[b[a - o : a - o + length] if low_ <= o <= a else None for o in range(11)] for b, a, low_ in zip(bodies, left, low, strict=True)]
    wanted = [{o for o in range(11) if s[o] is not None and sum(t[o] == s[o] for t in strings) > 1} for s in strings]
    got = suffix_dedup.recurring(bodies, left, low, counts, length)
    assert [{o for a, b in r for o in range(a, b + 1)} for r in got] == wanted
    few = suffix_dedup.recurring(bodies[:20], left[:20], low[:20], counts[:20], length)
    wanted = [{o for o in range(11) if s[o] is not None and sum(t[o] == s[o] for t in strings[:20]) > 1} for s in strings[:20]]
    assert [{o for a, b in r for o in range(a, b + 1)} for r in few] == wanted


def test_removal_keeps_rows_and_clashing_columns(spark):
    rng = random.Random(2)
    shared = "".join(rng.choice("abcdefgh ") for _ in range(500))
    rows = [(1, "a" + shared, "k", 9), (2, "ü" + shared + "ü", "k", 9), (3, None, "k", None), (None, "x", "k", 1), (4, "", None, 0), (5, "same" * 200, "k", 1), (5, "same" * 200, "k", 1)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, key string, n_chars long").withColumnRenamed("key", "spans")
    out = suffix_dedup.remove_repeats(frame)
    assert out.columns == frame.columns
    got = sorted((str(r.doc_id), r.text, r.n_chars) for r in out.collect())
    assert got == sorted([("1", "a", 1), ("2", "üü", 2), ("3", None, None), ("None", "x", 1), ("4", "", 0), ("5", "", 0), ("5", "", 0)], key=lambda x: (x[0], str(x[1])))
    assert suffix_dedup.remove_repeats(frame.limit(0)).collect() == []


def copies():
    rng = random.Random(3)
    base = [" ".join(rng.choice("abcdefghijklmnop") + str(rng.randint(0, 9)) for _ in range(60)) for _ in range(6)]
    rows = []
    for i in range(260):
        words = rng.choice(base).split()
        for _ in range(rng.choice([0, 0, 1, 2, 3, 4, 9])):
            words[rng.randrange(len(words))] = f"z{rng.randint(0, 99)}"
        rows.append((i, " ".join(words[: rng.choice([60, 60, 55, 50, 40])])))
    odd = [None, "", "A b", "a  B", " \n", "a b c d", "a b c d e", "a b c d e a b c d e", "x " * 40, "X " * 50, "ä b", "Ä b", "one", "w " * 30000]
    return rows + [(1000 + i, t) for i, t in enumerate(odd)]


@pytest.mark.parametrize("block", [setjoin.BLOCK, 500])
@pytest.mark.parametrize(("group", "hot"), [(setjoin.GROUP, setjoin.HOT), (3, setjoin.HOT), (3, 8), (setjoin.GROUP, 8)])
def test_near_duplicates(spark, block, group, hot, monkeypatch):
    monkeypatch.setattr(setjoin, "GROUP", group)
    monkeypatch.setattr(setjoin, "HOT", hot)
    rows = copies()
    frame = spark.createDataFrame([(i, t, 1) for i, t in rows], "doc_id long, text string, component_id int")
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in setjoin.near_duplicates(frame, block=block).collect()}
    assert got == brute.near_duplicates(rows)


def test_what_similar_sets_share_at_least():
    for percent in (50, 75, 90):
        for n in range(1, 300):
            other = np.arange(-(-percent * n // 100), 100 * n // percent + 1)
            least = setjoin.least_needed(np.array([n]), percent)[0]
            assert least <= setjoin.needed(np.full(len(other), n), other, percent).min(), (percent, n)


def test_sets_that_share_a_signature_are_told_apart(spark, monkeypatch):
    plain = setjoin.signatures

    def poor(keys, first, shared=None):
        node, mark = plain(keys, first)
        node = node % 7
        if shared is not None and len(shared):
            both = np.isin(node, shared)
            node[both] = (mark[both] >> 1) & ((1 << 62) - 1)
        return node, mark

    rows = copies()[:60]
    wanted = brute.near_duplicates(rows)
    monkeypatch.setattr(setjoin, "signatures", poor)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in setjoin.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == wanted


def test_near_duplicates_without_ids_or_rows(spark):
    text = "a b c d e f g"
    frame = spark.createDataFrame([(None, text), (7, text), (7, text), (None, "other words are here now"), (None, None)], "doc_id long, text string")
    got = sorted(((str(r.doc_id), r.n_shingles, r.component_id) for r in setjoin.near_duplicates(frame).collect()), key=str)
    assert got == sorted([("None", 3, 7), ("7", 3, 7), ("7", 3, 7), ("None", 1, None), ("None", 0, None)], key=str)
    assert setjoin.near_duplicates(frame.limit(0)).collect() == []


def test_trie_finds_what_pairs_find():
    rng = np.random.default_rng(6)
    for _ in range(60):
        base = rng.integers(0, 1 << 40, 30, dtype=np.uint64)
        sets = []
        for _ in range(14):
            keep = base[rng.random(30) < rng.choice([0.95, 0.8, 0.5])]
            sets.append(np.unique(np.concatenate([keep, rng.integers(0, 1 << 40, rng.integers(0, 6), dtype=np.uint64)])))
        sets = [s for s in {s.tobytes(): s for s in sets}.values() if len(s)]
        classes = brute.Classes(range(len(sets)))
        for i in range(len(sets)):
            for j in range(i):
                n = len(np.intersect1d(sets[i], sets[j]))
                if 100 * n >= 75 * (len(sets[i]) + len(sets[j]) - n):
                    classes.link(i, j)
        assert setjoin.classes(sets, 75) == [classes.find(i) for i in range(len(sets))]


@pytest.mark.parametrize("words", [1, setjoin.WORDS])
def test_lists_find_what_the_trie_finds(monkeypatch, words):
    monkeypatch.setattr(setjoin, "WORDS", words)
    rng = np.random.default_rng(7)
    for _ in range(80):
        base = rng.integers(0, 1 << 40, rng.integers(3, 150), dtype=np.uint64)
        sets = []
        for _ in range(40):
            keep = base[rng.random(len(base)) < rng.choice([1, 0.95, 0.85, 0.5])]
            sets.append(np.unique(np.concatenate([keep, rng.integers(0, 1 << 40, rng.integers(0, 1 + len(base) // 5), dtype=np.uint64)])))
        sets = [s for s in {s.tobytes(): s for s in sets}.values() if len(s)]
        for known in (None, rng.integers(0, 3 * len(sets), len(sets)).tolist()):
            both = []
            for few in (0, 1000):
                monkeypatch.setattr(setjoin, "FEW", few)
                both.append(setjoin.classes(sets, 75, known))
            assert both[0] == both[1]


def test_near_copies_of_one_text_are_not_all_compared_a_pair_at_a_time():
    """A walk through a trie of 2000 sets that begin apart took 80 seconds: one step for every pair of them."""
    rng = np.random.default_rng(8)
    base = rng.integers(1 << 50, 1 << 55, 400, dtype=np.uint64)
    sets = [np.unique(np.concatenate([base[rng.random(400) > gone], rng.integers(0, 1 << 50, int(400 * gone), dtype=np.uint64)])) for gone in rng.choice([0.01, 0.05, 0.1, 0.3, 0.4], 2000)]
    began = time.process_time()
    found = setjoin.classes(sets, 75)
    assert time.process_time() - began < 10
    some = rng.integers(0, 2000, 300).tolist()
    for i, j in zip(some[::2], some[1::2], strict=True):
        n = len(np.intersect1d(sets[i], sets[j]))
        assert found[i] == found[j] or 100 * n < 75 * (len(sets[i]) + len(sets[j]) - n)


@pytest.mark.parametrize("local", [components.LOCAL, 0])
def test_components(spark, local):
    rng = random.Random(1)
    edges = [(rng.randint(0, 900) * 7, rng.randint(0, 900) * 7) for _ in range(500)] + [(100000 + i, 100001 + i) for i in range(60)] + [(5, 200000 + i) for i in range(1200)] + [(9, 9)]
    classes = brute.Classes({x for e in edges if e[0] != e[1] for x in e})
    for a, b in edges:
        if a != b:
            classes.link(a, b)
    got = components.connected_components(spark.createDataFrame(edges, "a long, b long"), local).collect()
    assert {r.node: r.component for r in got} == {x: classes.find(x) for x in classes.parent} and len(got) == len(classes.parent)


def test_lattice_points():
    near = lattice.minimal_vectors()
    assert near.shape == (240, 8) and np.allclose((near**2).sum(axis=1), 2)
    x = np.random.default_rng(2).standard_normal((500, 8)) * 2
    own = lattice.nearest_e8(x)
    assert np.allclose(own * 2, np.rint(own * 2)) and np.allclose(own.sum(axis=1) % 2, 0)
    better = ((x[:, None] - own[:, None] - near) ** 2).sum(axis=2).min(axis=1)
    assert (((x - own) ** 2).sum(axis=1) <= better + 1e-9).all()


def test_recall_at_the_threshold():
    hasher, rng = lattice.Hasher(64, lattice.TABLES, lattice.PROBES, lattice.SCALE), np.random.default_rng(1)
    x, o = rng.standard_normal((2, 2000, 64))
    x /= np.linalg.norm(x, axis=1)[:, None]
    o -= (o * x).sum(axis=1)[:, None] * x
    o /= np.linalg.norm(o, axis=1)[:, None]
    a, b = hasher.cells(x), hasher.cells(0.93 * x + np.sqrt(1 - 0.93**2) * o)
    assert (a[:, :, :, None] == b[:, :, None, :]).any(axis=(1, 2, 3)).mean() > 0.95


@pytest.mark.parametrize("block", [lattice.BLOCK, 20])
def test_near_vectors(spark, block):
    rng = np.random.default_rng(1)
    base, rows = rng.standard_normal((30, 16)), []
    for i in range(500):
        e = base[rng.integers(30)] + rng.standard_normal(16) * rng.choice([0, 0.02, 0.3])
        rows.append((i, [float(v) for v in e.astype(np.float32)], int(rng.integers(2))))
    rows += [(700, None, 1), (701, [0.0] * 16, 1), (702, [1.0] * 16, None), (703, [1.0] * 16, None), (704, [float("nan")] * 16, 0), (705, [1.0, None] * 8, 0), (706, [1.0] * 4, 0), (707, [1.0] * 4, 0), (708, [], 0), (709, [2.0] * 4, 0), (710, [float("inf")] + [1.0] * 15, 0)]
    frame = spark.createDataFrame([(*r, 5) for r in rows], "vec_id long, embedding array<float>, label int, n_links int")
    got = lattice.near_vectors(frame, block=block).collect()
    wanted = brute.near_vectors(rows)
    assert {r.vec_id: r.kept for r in got} == {r.vec_id: r.vec_id == r.component_id for r in got}
    found, there = sum(r.n_links for r in got), sum(n for n, _ in wanted.values())
    assert len(got) == len(rows) and 0.9 * there <= found <= there
    assert {r.vec_id: (r.n_links, r.component_id) for r in got if r.vec_id >= 700} == {i: w for i, w in wanted.items() if i >= 700}
    assert lattice.near_vectors(frame.limit(0)).collect() == []


def test_very_long_vectors(spark):
    rng = np.random.default_rng(4)
    base = rng.standard_normal((4, 20_000))
    rows = [(i, [float(v) for v in (base[i % 4] + 0.05 * rng.standard_normal(20_000)).astype(np.float32)], 0) for i in range(16)]
    got = lattice.near_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")).collect()
    assert {r.vec_id: (r.n_links, r.component_id) for r in got} == brute.near_vectors(rows)


def test_a_text_that_a_third_of_all_rows_share_has_near_copies(spark, monkeypatch):
    """Tables too large to broadcast, and a hot set and text in them."""
    monkeypatch.setattr(setjoin, "KEYS", 0)
    monkeypatch.setattr(common, "HOT_ROWS", 20)
    rows = copies()
    hot = rows[7][1]
    rows += [(5000 + i, hot) for i in range(120)] + [(9000 + i, hot.replace(" ", "  ")) for i in range(20)]
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(8)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in setjoin.near_duplicates(frame).collect()}
    assert got == brute.near_duplicates(rows)


@pytest.mark.parametrize("crowd", [suffix_dedup.CROWD, 0])
def test_boilerplate_that_a_third_of_all_rows_share(spark, monkeypatch, crowd):
    monkeypatch.setattr(common, "HOT_ROWS", 2)
    rng = random.Random(6)
    boiler = "".join(rng.choice("abcdefgh ") for _ in range(120))
    rows = [(i, "".join(rng.choice("abcdefgh ") for _ in range(rng.randint(0, 60))) + (boiler if i % 3 == 0 else "") + "".join(rng.choice("ab") for _ in range(rng.randint(0, 30)))) for i in range(240)]
    docs = spark.createDataFrame(rows, "key long, text string").repartition(12)
    gone = {}
    for r in suffix_dedup.removed_ranges(docs, 40, 20, crowd, 5).collect():
        pairs = np.frombuffer(r.spans, "<u4").reshape(-1, 2)
        gone[r.key] = (int((pairs[:, 1] - pairs[:, 0]).sum()), len(pairs))
    assert gone == {i: w[1:3] for i, w in brute.repeats(rows, 40).items() if w[1]}
