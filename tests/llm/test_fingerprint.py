import hashlib
import re
from collections import Counter
from itertools import accumulate

import pytest
from corpus import EDGES, docs, prose
from pyspark.sql import functions as F

from eventlake.llm import fingerprint


def brute(rows):
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""), reverse=True)
    out = []
    for k, (i, t) in enumerate(order):
        t, nxt = t or "", order[(k + 1) % len(order)][1] or ""
        h = len(t) // 2
        out.append((i, len(t), hashlib.sha256((t[: len(t) - h] + nxt[:h]).encode()).hexdigest()))
    return sorted(out, key=repr)


def test_edited_texts(spark, monkeypatch):
    monkeypatch.setattr(fingerprint, "DOCS_IN_RANGE", 9)
    rows = [(i * 3 % 101, prose(i, 10 + i)) for i in range(101)] + [(200, "tail"), (200, "head"), (-5, "x"), (2**60, "y")]
    for given in (rows, rows + EDGES, EDGES, rows[:1], [(None, "a"), (None, "b")]):
        got = fingerprint.compare_edited(docs(spark, given)).collect()
        assert sorted(((r.doc_id, r.n_chars, r.edited_sha256) for r in got), key=repr) == brute(given)


def test_empty(spark):
    assert fingerprint.compare_edited(docs(spark, [])).count() == 0


def test_equal_texts_have_equal_fingerprints_and_others_not(spark):
    texts = [None, "", "a", "a\nb", "a\n\nb", "ab", "a b", "a.b", prose(1, 400), prose(1, 400) + " ", prose(2, 400).replace(" ", "\n")]
    rows = [(i, t) for i, t in enumerate(texts * 2)]
    got = {r.doc_id: r for r in fingerprint.compare_edited(docs(spark, rows)).collect()}
    marks = [got[i].fingerprint for i in range(len(texts))]
    assert marks == [got[i + len(texts)].fingerprint for i in range(len(texts))]
    assert len(set(marks)) == len(texts) - 1  # null is empty


LEAF, LENGTHS = re.compile(r"[^.!?]{1,8}[.!?]{0,7}|[.!?]{1,7}", re.S), (1, 1, 2, 4)


def brute_leaves(line):
    out, at = [], 0
    for n in LENGTHS:
        if line[at : at + n]:
            out.append(line[at : at + n])
        at += n
    return out + LEAF.findall(line, at)


def brute_tree(text):
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    lines = text.split("\n")
    digests, groups = [sha(x) for x in lines], [[]]
    for d in digests:
        groups[-1].append(d)
        if int(d[:4], 16) % fingerprint.SECTION == 0:
            groups.append([])
    return lines, digests, [(sha("/".join(g)), len(g)) for g in groups if g]


def brute_root(text):
    return hashlib.sha256("/".join(d for d, _ in brute_tree(text)[2]).encode()).hexdigest()


def brute_likeness(a, b):
    if a == b:
        return 1.0
    x, y = brute_tree(a)[0], brute_tree(b)[0]
    total = sum(map(len, x)) + sum(map(len, y))
    if not total:
        return 0.0
    head = 0
    while head < min(len(x), len(y)) and x[head] == y[head]:
        head += 1
    tail = 0
    while tail < min(len(x), len(y)) - head and x[-1 - tail] == y[-1 - tail]:
        tail += 1
    same = sum(map(len, x[:head])) + sum(map(len, x[len(x) - tail :]))
    own, other = (Counter(p for line in z[head : len(z) - tail] for p in brute_leaves(line)) for z in (x, y))
    return min(2 * (same + sum(len(p) * n for p, n in (own & other).items())) / total, 1 - 1 / (total + 1))


def held_against(spark, rows):
    """Likenesses and roots as brute force has them; the rows."""
    got = fingerprint.compare_edited(docs(spark, rows)).collect()
    texts = dict(rows)
    order = sorted(texts, reverse=True)
    for r in got:
        own, nxt = texts[r.doc_id], texts[order[(order.index(r.doc_id) + 1) % len(order)]]
        half = len(own) // 2
        edited = own[: len(own) - half] + nxt[:half]
        assert r.near_edited == pytest.approx(brute_likeness(own, edited)), own
        assert r.near_next == pytest.approx(brute_likeness(own, nxt)), own
        assert (r.fingerprint.split(":")[0], r.edited_fingerprint.split(":")[0]) == (brute_root(own), brute_root(edited))
        assert (r.edit_first is None) == (own == edited)
    return {r.doc_id: r for r in got}


def test_likeness_at_every_length(spark):
    """Texts of 0 to 600 characters: an edited half leaves about half, another text next to nothing."""
    got = held_against(spark, [(n, prose(n, 200)[:n]) for n in range(601)])
    for n, r in got.items():
        if n > 1:
            assert 0.2 < r.near_edited < 0.8
        if n > 40:
            assert abs(r.near_edited - 0.5) < 0.2
            assert r.near_next < 0.25


def test_likeness_of_lines_and_shared_parts(spark):
    lines = [f"line {i}, {prose(i, 6)}" for i in range(60)]
    shared = prose(7, 200)
    texts = [
        "\n".join(lines), "\n".join(lines[:30] + ["one more"] + lines[30:]), "\n".join(lines[:20] + lines[25:]), "\n".join(lines[::-1]), "\n" * 5, "\n" * 4, "", "a\n" * 300, "\r\n\u2028x.\x85y!\n?", "é😀" * 40, "." * 40,
        shared[:250], shared[:300], shared[:300] + " " + prose(9, 30), "same words " * 300, "words same " * 300,
    ]
    got = held_against(spark, list(enumerate(texts)))
    assert got[12].near_next > 0.9  # the first 250 of 300 characters
    assert got[1].near_next > 0.95  # one line more
    assert got[3].near_next > 0.9  # lines in another order


def test_one_more_line_changes_one_section(spark):
    lines = [f"line {i}" for i in range(400)]
    r = spark.createDataFrame([("\n".join(lines), "\n".join([*lines[:100], "new", *lines[100:]]))], "a string, b string").select(*[fingerprint.sections(fingerprint.paragraphs(F.col(c))).alias(c) for c in "ab"]).first()
    assert len({s.digest for s in r.b} - {s.digest for s in r.a}) <= 2 < len(r.a)


def test_edits_are_located(spark):
    lines = [f"line {i}" for i in range(300)]
    other = lines.copy()
    other[3], other[200] = "changed", "too"
    pairs = [(lines, other), (lines, lines[:-2]), (lines, [*lines, "x"]), (["a"], ["a"]), ([""], ["b"]), (lines, ["x", *lines]), (["a", "a"], ["a", "a", "a"])]
    df = spark.createDataFrame([("\n".join(a), "\n".join(b), i) for i, (a, b) in enumerate(pairs)], "l string, r string, i int")
    got = df.select("i", fingerprint.edit(fingerprint.node(F.col("l")), fingerprint.node(F.col("r"))).alias("e")).orderBy("i").collect()
    assert [(r.e.head, r.e.tail) for r in got] == [(3, 99), (298, 0), (300, 0), (1, 0), (0, 0), (0, 300), (2, 0)]


def test_tree_is_of_its_children(spark):
    text = "\n".join(f"line {i}" for i in range(40))
    r = fingerprint.tree(docs(spark, [(1, text)])).first()
    _, digests, groups = brute_tree(text)
    assert (r.paragraphs, [s.digest for s in r.sections], r.root) == (digests, [d for d, _ in groups], brute_root(text))
    assert [s.start for s in r.sections] == list(accumulate([0] + [n for _, n in groups][:-1]))


def test_a_fingerprint_is_bounded(spark):
    rows = [(1, prose(1, 30_000)), (2, "\n".join(prose(i, 5) for i in range(4000))), (3, "x" * 300_000)]
    for r in fingerprint.tree(docs(spark, rows)).collect():
        assert len(r.fingerprint) <= 64 + 17 * fingerprint.SKETCH


def test_other_ids_are_refused(spark):
    with pytest.raises(TypeError):
        fingerprint.compare_edited(spark.createDataFrame([("a", "b")], "doc_id string, text string"))


def test_no_python_in_the_plan(spark):
    plan = fingerprint.compare_edited(docs(spark, [(1, "a")]))._jdf.queryExecution().toString()
    assert not re.search("EvalPython|MapIn|FlatMapGroups|PythonUDF|pythonUDF", plan)
