import math
import zlib
from collections import Counter

import numpy as np
import pytest
import public_tokenizers
from corpus import EDGES, docs, prose

from eventlake.llm import lm_score as lm

PATH = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def pieces():
    return lm.Pieces(PATH)


def paths(pieces, word):
    """Every segmentation of a short word: its pieces."""
    symbols = (lm.SPACE, *word)
    table = {int(h): i for i, h in enumerate(pieces.hashes)}

    def walk(at):
        if at == len(symbols):
            yield []
        for end in range(at + 1, min(len(symbols), at + pieces.longest) + 1):
            piece = table.get(pieces.hash(symbols[at:end]))
            if piece is not None:
                for rest in walk(end):
                    yield [piece, *rest]

    return list(walk(0))


WORDS = [b"the", b"window", b"", b"x", "élève".encode(), b"\xff\x00"]


def test_sums_over_all_segmentations(pieces):
    got = lm.word_log_probabilities(pieces, WORDS)
    for word, value in zip(WORDS, got, strict=True):
        assert value == pytest.approx(math.log(sum(math.exp(sum(pieces.logp[p])) for p in map(np.array, paths(pieces, word)))))


def test_expected_counts(pieces, monkeypatch):
    """As every segmentation tells, in one stretch or in many."""
    word = "windowселения".encode()
    want, total = np.zeros(len(pieces.logp)), 0.0
    for p in paths(pieces, word):
        weight = math.exp(sum(pieces.logp[p]))
        total += weight
        for x in p:
            want[x] += weight
    for symbols in (lm.SYMBOLS_AT_ONCE, 1):
        monkeypatch.setattr(lm, "SYMBOLS_AT_ONCE", symbols)
        expected = np.zeros(len(pieces.logp))
        pieces.solve(np.array([[lm.SPACE, *word]] * 3, np.uint16), expected)
        assert np.allclose(expected, 3 * want / total)


def learned(pieces, counts, texts):
    """The re-estimated pieces, by every segmentation of every training word."""
    for _ in range(lm.ROUNDS if texts else 0):
        expected = np.zeros(len(pieces.logp))
        for word in counts:
            weights = [(p, math.exp(sum(pieces.logp[p]))) for p in paths(pieces, word)]
            for p, w in weights:
                for x in p:
                    expected[x] += w / sum(v for _, v in weights)
        expected[-1] = expected.sum() * texts / max(1, sum(counts.values()))
        pieces = pieces.updated(expected)
    return pieces


def test_probabilities_add_up(pieces):
    assert np.exp(pieces.logp).sum() == pytest.approx(1)
    assert np.exp(pieces.updated(np.ones(len(pieces.logp))).logp).sum() == pytest.approx(1)


def test_no_piece_of_the_vocabulary_is_left_out(pieces):
    """Each piece that a word can have is in the lattice, the longest ones in bytes too."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=PATH)
    table = set(pieces.hashes.tolist())
    long = 0
    for i in range(model.get_piece_size()):
        name = model.id_to_piece(i)
        if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or "▁" in name[1:]):
            symbols = (lm.SPACE, *name[1:].encode()) if name.startswith("▁") else tuple(name.encode())
            assert pieces.hash(symbols) in table
            long += len(symbols) > 16
            words = np.array([[lm.SPACE, *b"x", *symbols] if symbols[0] != lm.SPACE else symbols], np.uint16)
            if len(symbols) > 16:
                assert any(len(p) for _, _, p in pieces.edges(words)[len(symbols) - 1 : len(symbols)])
    assert long == 20


def test_vocabulary_keeps_its_order(pieces):
    """A better score has the larger weight."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=PATH)
    at = {int(h): i for i, h in enumerate(pieces.hashes)}
    weight = lambda i: pieces.logp[at[pieces.hash(tuple(model.id_to_piece(i).encode()))]]
    some = [i for i in range(300, 31_000, 997) if not model.id_to_piece(i).startswith("▁")]
    assert [weight(i) for i in some] == sorted((weight(i) for i in some), reverse=True)


def test_recursion_in_stretches(pieces, monkeypatch):
    words = [b"windowsill", b"x" * 700, "населениянаселения".encode(), b"a", b""]
    whole = lm.word_log_probabilities(pieces, words)
    for symbols in (1, 7, 64):
        monkeypatch.setattr(lm, "SYMBOLS_AT_ONCE", symbols)
        assert lm.word_log_probabilities(pieces, words) == pytest.approx(whole)


def test_one_long_word_takes_bounded_memory(pieces):
    import tracemalloc

    word = bytes(97 + i % 26 for i in range(40_000))
    tracemalloc.start()
    lm.word_log_probabilities(pieces, [word])
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 40e6  # all steps at once would be some 15 MB for the lattice alone, and grow with the word


def marginal(pieces, text, table, at=None):
    """Sum over every segmentation of a whole text: words in pieces or, where `table` has them, whole; an end. (starts, end) share a boundary."""
    starts = sum(math.exp(x) for x, first in zip(pieces.logp, pieces.first, strict=False) if first)
    end = math.exp(pieces.logp[-1])
    counts, texts = table
    n, types = sum(counts.values()) + texts, max(1, len(counts) + (texts > 0))
    total = [1.0]
    for word in lm.split(text):
        spelled = sum(math.exp(sum(pieces.logp[i] for i in p)) for p in paths(pieces, word))
        if at == "lattice":
            total = [t * spelled for t in total]
        else:
            share = spelled * (starts + end) / starts  # of all words
            total = [t * (counts[word] + types * starts / (starts + end) * share) / (n + types) for t in total]
    stop = end / (starts + end)
    return math.log10(total[0] * (stop if at == "lattice" else (texts + types * stop) / (n + types)))


@pytest.mark.parametrize("frequent", [2, 65_536])
def test_scores_as_brute_force(spark, pieces, monkeypatch, frequent):
    """Both scores of whole short texts are sums over all their segmentations."""
    monkeypatch.setattr(lm, "FREQUENT", frequent)
    texts = ["the river", "The  window cloud", "", None, "river", "élan the", "silver x", "cloud window river the", "stone"] * 3
    rows = list(enumerate(texts))
    counts, known = Counter(), 0
    for i, t in rows:
        if not held_out(i):
            counts.update(lm.split(t))
            known += 1
    better = learned(pieces, counts, known)
    for r in lm.score(docs(spark, rows), PATH).collect():
        assert r.lattice_score == pytest.approx(marginal(pieces, texts[r.doc_id], (counts, known), "lattice"), abs=1e-6)
        assert r.score == pytest.approx(marginal(better, texts[r.doc_id], (counts, known)), abs=1e-6)


def test_ids_of_another_type(spark):
    got = lm.score(spark.createDataFrame([("a", "one two"), ("b", None)], "doc_id string, text string"), PATH)
    assert dict(got.dtypes)["doc_id"] == "string"
    assert sorted((r.doc_id, r.n_tokens) for r in got.collect()) == [("a", 3), ("b", 1)]


def held_out(i):
    return zlib.crc32(("" if i is None else str(i)).encode()) % 5 == 1


def base(rows):
    counts, texts = Counter(), 0
    for i, t in rows:
        if not held_out(i):
            counts.update(lm.split(t))
            texts += 1
    n, v = sum(counts.values()) + texts, len(counts) + (texts > 0)
    out = []
    for i, t in rows:
        words = lm.split(t)
        each = [counts[w] for w in words] + [texts]
        out.append((i, held_out(i), len(each), sum(c > 0 for c in each), n, round(sum(math.log10((c + 0.5) / (n + 0.5 * (v + 1))) for c in each), 6)))
    return sorted(out, key=repr)


@pytest.mark.parametrize("frequent", [5, 65_536])
def test_base_score(spark, monkeypatch, frequent):
    monkeypatch.setattr(lm, "FREQUENT", frequent)
    rows = [(i, prose(i, 30)) for i in range(60)] + EDGES
    got = lm.score(docs(spark, rows), PATH).collect()
    assert sorted(((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in got), key=repr) == base(rows)
    assert all(r.lattice_score < 0 and r.score <= 0 and math.isfinite(r.score) for r in got)


def test_frequent_words_change_no_score(spark, monkeypatch):
    rows = [(i, prose(i, 30)) for i in range(30)]
    both = []
    for frequent in (3, 1000):
        monkeypatch.setattr(lm, "FREQUENT", frequent)
        both.append({r.doc_id: (round(r.score, 6), round(r.lattice_score, 6)) for r in lm.score(docs(spark, rows), PATH).collect()})
    assert both[0] == both[1]


def test_likely_texts_score_higher(spark):
    unseen = [i for i in range(900, 1000) if held_out(i)][:5]
    rows = [(i, prose(i, 60)) for i in range(200)] + [(i, "zqxv kjwq vvzx qqkz " * 10) for i in unseen]
    got = [(r.score / r.n_tokens, r.doc_id) for r in lm.score(docs(spark, rows), PATH).where("held_out").collect()]
    assert max(s for s, i in got if i >= 900) < min(s for s, i in got if i < 900)


def test_nothing_to_learn_from(spark):
    assert lm.score(docs(spark, []), PATH).count() == 0
    ids = [i for i in range(40) if held_out(i)][:3]
    got = lm.score(docs(spark, [(i, "a word") for i in ids]), PATH).collect()
    assert {(r.n_tokens, r.n_known, r.train_tokens) for r in got} == {(3, 0, 0)}
