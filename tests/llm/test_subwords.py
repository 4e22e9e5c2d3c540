import hashlib
import math

import numpy as np
import public_tokenizers
import pytest
import zstandard
from corpus import EDGES, docs, prose

from eventlake.llm import common, subwords

PATH = public_tokenizers.path("piece_bpe_32k.model")
TEXTS = ["a  b\nc", " lead", "trail ", "  ", "\t x ▁ y", "é ﬁ ½ 😀 日本語テキスト", "Hello, world! (foo) ab.cd", "\x00\x7f", " \n \n", "the the   the", "representatives addEventListener ................"]


def best(known, text):
    """The best score over the whole text's lattice."""
    table, s = {p: x for p, _, x in known.pieces}, f" {text}"
    f = [0.0] + [-math.inf] * len(s)
    for j in range(1, len(s) + 1):
        for i in range(max(0, j - known.longest), j):
            x = s[i:j]
            if x in table:
                f[j] = max(f[j], f[i] + table[x])
            elif j == i + 1:
                f[j] = max(f[j], f[i] + len(x.encode()) * known.byte_score)
    return f[-1]


@pytest.mark.parametrize("frequent", [3, 131_072])
def test_round_trip_and_best_path(spark, monkeypatch, frequent):
    monkeypatch.setattr(subwords, "FREQUENT", frequent)
    known = subwords.vocabulary(PATH)
    scores, in_bytes = {i: s for _, i, s in known.pieces}, set(known.bytes)
    rows = [(100 + i, t) for i, t in enumerate(TEXTS)] + [(300 + i, prose(i, 20)) for i in range(10)] + EDGES
    texts = {i: t or "" for i, t in rows if i is not None}
    got = subwords.round_trip(docs(spark, rows), PATH).collect()
    assert len(got) == len(rows)
    for r in got:
        if r.doc_id is None:
            continue
        text = texts[r.doc_id]
        assert r.n_pieces == len(r.ids)
        assert r.decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()
        if text:
            assert sum(known.byte_score if i in in_bytes else scores[i] for i in r.ids) == pytest.approx(best(known, text))


def test_decode(spark):
    df = subwords.encode(docs(spark, [(1, "Hello  world\n")]), PATH)
    assert df.select(subwords.decode(df["ids"], PATH)).first()[0] == "Hello  world\n"


def test_empty(spark):
    assert subwords.round_trip(docs(spark, []), PATH).count() == 0
    assert [r.ids for r in subwords.encode(docs(spark, [(1, None), (2, "")]), PATH).collect()] == [[], []]


def test_units_never_cut_a_piece():
    known = subwords.vocabulary(PATH)
    for piece, _, _ in known.pieces:
        assert known.units(piece) == [piece]
    assert "".join(known.units("  a,b" * 200)) == "  a,b" * 200
    assert known.units("e" * 1000) == ["e" * 1000]
    assert known.longest == max(len(p) for p, _, _ in known.pieces)


def test_streamed_path_is_the_folds(spark):
    """The same ids, ties too, whichever way a unit is solved."""
    known = subwords.vocabulary(PATH)
    units = sorted({f" {w}" for t in TEXTS + [prose(i, 15) for i in range(6)] for w in t.split()} | {" " + "e" * 40, " ...............", " 日本x語😀", " aaaaabbbbbaaaaa" * 3, " Überraschungs", "\x00"})
    counted = spark.createDataFrame([(u, 1) for u in units], "unit string, n long")
    got = {r.unit: r.ids for r in subwords.encode_units(counted, known, PATH).collect()}
    assert got == {u: known.best(u) for u in units}


def test_units_of_any_length(spark, monkeypatch):
    """Where the lattice of rows ends and the stream begins changes nothing."""
    texts = ["unbelievablyinternationalisation" * 12, "e" * 300 + " " + "ab" * 200, "日本語" * 150, "x" * 257 + "y"]
    rows = list(enumerate(texts))
    both = []
    for unit in (16, 100_000):
        monkeypatch.setattr(subwords, "UNIT", unit)
        both.append({r.doc_id: r.ids for r in subwords.encode(docs(spark, rows), PATH).collect()})
    assert both[0] == both[1]


def test_numbers_pack_by_bytes():
    """Word numbers of a slice come back as they were, and take a tenth less than their plain bytes would."""
    numbers = np.minimum(np.random.default_rng(5).zipf(1.3, 200_000), 60_000).astype("<i4")
    for some in (numbers, numbers[:0], np.array([-7, 0, 2**31 - 1, -(2**31)], "<i4")):
        assert subwords._unpacked(subwords._packed(some), "<i4").tolist() == some.tolist()
    assert len(subwords._packed(numbers)) < 0.9 * len(zstandard.ZstdCompressor(level=1).compress(numbers.tobytes()))


def test_one_pass_over_the_documents(spark):
    """Nothing is counted, sent or written between the documents and their ids."""
    with common.tables_made() as made:
        df = subwords.round_trip(docs(spark, [(1, "Hello world")]), PATH)
    assert not made
    assert "Exchange" not in df._jdf.queryExecution().executedPlan().toString()


def test_prefixes_are_the_pieces():
    """The join finds each prefix of a piece, the piece at its end, and nothing else."""
    known = subwords.vocabulary(PATH)
    table, names = known.prefixes, {int(known.prefixes.char[x]): chr(x) for x in np.flatnonzero(known.prefixes.char)}
    found, rows, chars = {}, [("", 0)], np.arange(len(table.left))
    while rows:
        text, number = rows.pop()
        found[text] = number
        more = table.base[number] + chars
        rows += [(text + names[c], int(more[c])) for c in np.flatnonzero(table.parent[more] == number).tolist()]
    assert set(found) == {p[:i] for p, _, _ in known.pieces for i in range(len(p) + 1)}
    assert {(p, int(table.piece[n]), float(table.score[n])) for p, n in found.items() if table.piece[n] >= 0} == set(known.pieces)


@pytest.mark.parametrize("chars, unit, frequent", [(1, 256, 400_000), (7, 3, 5), (1 << 18, 4, 400_000), (1 << 18, 256, 0)])
def test_lots_and_kept_words_change_nothing(spark, monkeypatch, chars, unit, frequent):
    known = subwords.vocabulary(PATH)
    for name, value in (("CHARS_AT_ONCE", chars), ("UNIT", unit), ("FREQUENT", frequent), ("TEXT_AT_ONCE", 40), ("DOCS_AT_ONCE", 2)):
        monkeypatch.setattr(subwords, name, value)
    texts = TEXTS + [prose(i, 8) for i in range(4)] + ["日本語 x," * 3, "e" * 40, "", "😀" * 9, *TEXTS]
    got = {r.doc_id: r.ids for r in subwords.encode(docs(spark, list(enumerate(texts))), PATH).collect()}
    assert got == {i: [x for w in subwords.words(t) for u in known.units(f" {w}") for x in known.best(u)] for i, t in enumerate(texts)}
