import tracemalloc
from collections import defaultdict

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest
from corpus import EDGES, WORDS, by_id, docs, edited, prose

from eventlake.llm import grouping, near_dedup


def shingles(text, words):
    w = (text or "").encode().lower().split()
    return frozenset(tuple(w[i : i + words]) for i in range(len(w) - words + 1)) if len(w) >= words else frozenset([tuple(w)] if w else [])


def brute(rows, words, percent):
    sets = [shingles(t, words) for _, t in rows]
    up = list(range(len(rows)))

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j]):
                up[root(i)] = root(j)
    parts = defaultdict(list)
    for i in range(len(rows)):
        parts[root(i)].append(rows[i][0])
    least = {r: min((x for x in ids if x is not None), default=None) for r, ids in parts.items()}
    return sorted(((rows[i][0], len(sets[i]), least[root(i)] if sets[i] else rows[i][0], rows[i][0] == (least[root(i)] if sets[i] else rows[i][0])) for i in range(len(rows))), key=repr)


NAMES = ("doc_id", "n_shingles", "component_id", "kept")


@pytest.mark.parametrize(("words", "percent"), [(3, 85), (5, 80)])
def test_as_all_pairs(spark, words, percent):
    rows = [(100 + i, prose(i, 60 + i)) for i in range(12)]
    rows += [(200 + 10 * i + k, edited(prose(i, 60 + i), 40 - 6 * k, k)) for i in range(6) for k in range(5)]
    rows += [(300 + i, prose(i, 60 + i).upper().replace(" ", "\n")) for i in range(4)]
    rows += EDGES
    assert by_id(near_dedup.near_dedup(docs(spark, rows), words, percent), *NAMES) == brute(rows, words, percent)


def test_one_large_family(spark, monkeypatch):
    """Most members are no copies of the hub, but of each other: the blocks have to find their links."""
    monkeypatch.setattr(near_dedup, "BLOCK", 8)
    base = prose(1, 200)
    rows = [(i, edited(base, 23 + i % 17, i)) for i in range(90)]
    rows += [(1000 + i, edited(edited(base, 25, i), 190, i + 1)) for i in range(30)]
    assert by_id(near_dedup.near_dedup(docs(spark, rows), 3, 85), *NAMES) == brute(rows, 3, 85)


def test_broadcast_and_shuffle_agree(spark, monkeypatch):
    rows = [(i, edited(prose(i % 5, 80), 60, i)) for i in range(20)]
    one = by_id(near_dedup.near_dedup(docs(spark, rows), 3, 85), *NAMES)
    monkeypatch.setattr(near_dedup, "BROADCAST_IDS", 0)
    assert by_id(near_dedup.near_dedup(docs(spark, rows), 3, 85), *NAMES) == one


def test_empty(spark):
    assert near_dedup.near_dedup(docs(spark, [])).count() == 0
    assert near_dedup.keep_one(docs(spark, [])).count() == 0
    assert near_dedup.near_dedup(docs(spark, [(1, None), (2, "")])).where("kept").count() == 2


def test_rows_that_stay(spark):
    rows = [(1, prose(1, 80)), (2, edited(prose(1, 80), 79)), (3, prose(3, 80)), (4, None), (3, prose(9, 80)), (5, prose(9, 80))]
    df = docs(spark, rows)
    out = near_dedup.keep_one(df)
    assert out.columns == df.columns
    assert by_id(out, "doc_id", "text") == sorted([rows[0], rows[2], rows[3], rows[4]], key=repr)


def test_superminhash_draws_as_element_by_element():
    """The batch, rank after rank, gives the registers that Fisher-Yates on one element after another gives."""
    rng = np.random.default_rng(1)
    size, sets = 12, [np.unique(rng.integers(0, 2**63, n, dtype=np.uint64)) for n in (1, 3, 40, 0)]
    bounds = np.cumsum([0, *map(len, sets)])
    got = near_dedup.super_minhash(np.concatenate(sets), bounds, size)
    with np.errstate(over="ignore"):
        for i, elements in enumerate(sets):
            want = np.full(size, 2**64 - 1, np.uint64)
            for e in elements:
                p = list(range(size))
                for j in range(size):
                    x = int(near_dedup.mix(np.array([e + np.uint64(j + 1) * np.uint64(0x9E3779B97F4A7C15)]))[0])
                    k = j + (x & 0xFFFFFF) % (size - j)
                    p[j], p[k] = p[k], p[j]
                    want[p[j]] = min(int(want[p[j]]), (j << 40) | (x >> 24))
            assert got[i].tolist() == want.tolist()


def test_signatures_estimate_similarity():
    rng = np.random.default_rng(2)
    pool = rng.integers(0, 2**63, 600, dtype=np.uint64)
    a, b = np.unique(pool[:400]), np.unique(pool[200:])
    s = near_dedup.super_minhash(np.concatenate([a, b]), np.array([0, len(a), len(a) + len(b)]), 2000)
    assert abs((s[0] == s[1]).mean() - 1 / 3) < 0.04


def test_bands_keep_what_they_promise():
    for percent in (80, 85, 95):
        assert (1 - (percent / 100) ** near_dedup.ROWS) ** near_dedup.bands_for(percent) <= near_dedup.MISS


def test_components(spark):
    links = [(i, i + 1) for i in range(1, 60)] + [(100, 7), (200, 201), (201, 200), (300, 300), (None, 4)] + [(500, 500 + i) for i in range(40)]
    got = {r.node: r.root for r in grouping.components(spark.createDataFrame(links, "a long, b long").repartition(5)).collect()}
    want = {i: 1 for i in range(2, 61)} | {100: 1, 201: 200} | {500 + i: 500 for i in range(1, 40)}
    assert got == want
    assert grouping.components(spark.createDataFrame([], "a long, b long")).count() == 0


@pytest.mark.parametrize("at_once", [10, 200_000])
def test_components_of_few_links_take_no_rounds(spark, monkeypatch, at_once):
    """A chain dealt over partitions: its links fit one union-find, or rounds of large and small stars end it; the result is the same."""
    made, put = [], grouping.written
    monkeypatch.setattr(grouping, "LINKS_AT_ONCE", at_once)
    monkeypatch.setattr(grouping, "written", lambda df, name: made.append(name) or put(df, name))
    links = [(i, i + 1) for i in range(1, 200)] + [(400 + i, 400) for i in range(1, 90)]
    got = sorted(map(tuple, grouping.components(spark.createDataFrame(links, "a long, b long").repartition(7)).collect()))
    assert got == [(i, 1) for i in range(2, 201)] + [(400 + i, 400) for i in range(1, 90)]
    assert (len(made) > 2) == (at_once == 10)


def test_parts_of_a_text_give_what_the_whole_gives(monkeypatch):
    texts = [prose(i, 200 * i) for i in range(6)] + ["", " \n", "one", "x" * 5000, "a\tb\x0bc\r\nd " * 300]
    whole = near_dedup.shingles(texts, 3)
    signatures = near_dedup.super_minhash(*whole, 76)
    for at_once in (1, 64, 1000):
        monkeypatch.setattr(near_dedup, "TEXT_AT_ONCE", at_once)
        monkeypatch.setattr(near_dedup, "SHINGLES_AT_ONCE", at_once)
        parts = near_dedup.shingles(texts, 3)
        assert all((a == b).all() for a, b in zip(parts, whole, strict=True))
        assert (near_dedup.super_minhash(*parts, 76) == signatures).all()


def traced(work):
    tracemalloc.start()
    try:
        out = work()
        return out, tracemalloc.get_traced_memory()[1] / 1e6
    finally:
        tracemalloc.stop()


def test_memory_of_one_very_long_text():
    """A text of over 20 MB takes some copies of itself and its hashes, and nothing for each word beyond that."""
    text = " ".join(f"{WORDS[i % 17]}{i}" for i in range(1_750_000))
    assert len(text) > 20e6
    batch = pa.RecordBatch.from_arrays([pa.array([1]), pa.array([text])], names=["doc_id", "text"])
    found, peak = traced(lambda: list(near_dedup._signed(3, near_dedup.bands_for(85), near_dedup.ROWS)(iter([batch]))))
    assert found[0].column(1).to_pylist() == [1_749_998]
    assert peak < 260


def test_memory_of_a_family_of_thousands():
    """Near copies of one long text meet in blocks of bounded size, whose memory is that of their sets; all links between labels are found."""
    rng = np.random.default_rng(3)
    base = np.sort(rng.integers(-(2**63), 2**63, 1500, dtype=np.int64))
    sets = [np.sort(np.concatenate([base[i % 50 :], rng.integers(-(2**63), 2**63, 20, dtype=np.int64)])) for i in range(2 * near_dedup.BLOCK)]
    rows = pd.DataFrame({"set_id": [i.to_bytes(16, "big") for i in range(len(sets))], "shingles": sets, "label": [i.to_bytes(16, "big") for i in range(len(sets))], "side": [i % 2 for i in range(len(sets))], "kind": 0})
    found, peak = traced(lambda: near_dedup._block_links(85)(rows))
    assert len(found) == len(sets) - 1  # a tree over all members
    assert peak < 100


def test_a_family_of_thousands(spark):
    """Three thousand edits of one text: one component, and the smallest id stays."""
    base = prose(1, 120)
    rows = [(i, edited(base, 60 + i % 40, i)) for i in range(3000)] + [(5000 + i, prose(50 + i, 120)) for i in range(20)]
    got = near_dedup.near_dedup(docs(spark, rows, clash=False), 3, 80).collect()
    assert {r.doc_id for r in got if r.kept} >= {0, *range(5000, 5020)}
    first = {r.component_id for r in got if r.doc_id < 3000}
    linked = {r.doc_id for r in got if r.doc_id < 3000 and r.component_id == 0}
    sets = {i: shingles(t, 3) for i, t in rows[:3000]}
    for i in sorted(first)[1:]:  # a text of its own component is linked with none: here with a sample of the large one, and with all of the hub's
        assert all(100 * len(sets[i] & sets[j]) < 80 * len(sets[i] | sets[j]) for j in sorted(linked)[:300])
