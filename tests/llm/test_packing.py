import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from corpus import EDGES, docs, prose
from tokenizers import Tokenizer

from eventlake.llm import packing

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(PATH)


ODD = ["İx. Éà, ÀB. <|ENDOFTEXT|>. <|ENDOFTEXT|>y. a1. a., b. . , ., X'S. don't we'll, ΑΣ. ÅNGSTRÖM. İ. ﬁ. ǅ. ª. 5,", "a\tb  c d\x85e <|endoftext|> f<|startoftext|>g", "\x00 a\x00b", "é ́ x \r\n y\x1fz", "", " ", "..", "A.b. C,,"]


def test_word_ids_are_the_tokenizers(tokenizer):
    words = packing.WordIds(PATH)
    texts = [*ODD, None, *(t for _, t in EDGES), *(prose(i, 50) for i in range(20))]
    for _ in range(2):
        ids, bounds = words.ids(pa.array(["skipped", *texts], pa.string()).slice(1))
        for i, t in enumerate(texts):
            assert ids[bounds[i] : bounds[i + 1]].tolist() == tokenizer.encode(t or "", add_special_tokens=False).ids


def test_letters_are_learned_without_marks(tokenizer):
    """Words of letters go to the tokenizer side by side; each gets the ids that it has alone, whatever its letters become."""

    class Seen:
        def __init__(self):
            self.texts = []

        def encode_batch_fast(self, texts, **how):
            self.texts += texts
            return tokenizer.encode_batch_fast(texts, **how)

    words, seen = packing.WordIds(PATH), Seen()
    words.tokenizer = seen
    words.learn(["once", "upon", "äöü", "ñandú", "слово", "漢字"])
    assert seen.texts == ["once upon äöü ñandú слово 漢字"]
    letters = [c for c in map(chr, range(0x20000)) if c.isalpha()]
    some = [*letters[::3], *(f"a{c}b" for c in letters[1::3]), *(f"{c}s" for c in letters[2::3]), "\u0958\u0959", "e\u0301", "x\x00y", "don't", "a1", "", "<|endoftext|>"]
    words.learn(some)
    for word, alone in zip(some, tokenizer.encode_batch_fast(some, add_special_tokens=False), strict=True):
        assert np.frombuffer(words.known[word], "<u4").tolist() == alone.ids, word


def check(rows, found, tokenizer, capacity):
    whole = defaultdict(list)
    for r in found:
        whole[r.doc_id].append(r)
    expected = Counter()
    for i, t in rows:
        ids = [*tokenizer.encode(t or "", add_special_tokens=False).ids, 1]
        for p, at in enumerate(range(0, len(ids), capacity)):
            cut = ids[at : at + capacity]
            expected[i, p, at, len(cut), zlib.crc32(np.array(cut, "<u4").tobytes())] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in found) == expected
    places = defaultdict(list)
    for r in found:
        places[r.sequence_id].append((r.offset, r.length))
    for p in places.values():
        at = 0
        for offset, length in sorted(p):
            assert offset == at
            at += length
        assert at <= capacity
    return len(places), sum(r.length for r in found)


@pytest.mark.parametrize("capacity", [4096, 64])
def test_pieces_and_places(spark, tokenizer, capacity, monkeypatch):
    monkeypatch.setattr(packing, "RANKED_AT_ONCE", 5)
    rows = [(i, prose(i, 1 + i * 7 % 90)) for i in range(300)] + [(900 + i, "same") for i in range(60)] + EDGES
    sequences, total = check(rows, packing.pack(docs(spark, rows), PATH, capacity).collect(), tokenizer, capacity)
    assert sequences <= 1.02 * -(-total // capacity) + 1


def test_empty(spark):
    assert packing.pack(docs(spark, []), PATH).count() == 0


@pytest.mark.parametrize("seed", range(6))
def test_plan_uses_each_piece_once(seed):
    rng = np.random.default_rng(seed)
    h = dict(Counter(np.clip(rng.lognormal(rng.uniform(3, 7), 1, 3000), 1, 4096).astype(int).tolist()))
    runs, sequences = packing.plan(h)
    used, full = defaultdict(list), Counter()
    for length, first, count, sequence, _ in runs.tolist():
        used[length].append((first, count))
        for s in range(sequence, sequence + count):
            full[s] += length
    for length, c in h.items():
        at = 0
        for first, count in sorted(used[length]):
            assert first == at
            at += count
        assert at == c
    assert max(full.values()) <= 4096
    assert len(full) == sequences
    best_fit = packing._plan(h, 4096, 0.0)[1]
    assert sequences <= best_fit * 1.01 + 1


def test_nnls():
    rng = np.random.default_rng(0)
    for _ in range(20):
        a, b = rng.random((12, 30)), rng.random(12)
        x = packing.nnls(a, b)
        slope = a.T @ (a @ x - b)
        assert x.min() >= 0
        assert slope.min() > -1e-6
        assert abs(slope @ x) < 1e-6


def test_patterns():
    found = packing.patterns(8, 3)
    assert sorted(found) == sorted({tuple(sorted(p, reverse=True)) for p in [(8,), *[(a, 8 - a) for a in range(1, 8)], *[(a, b, 8 - a - b) for a in range(1, 7) for b in range(1, 8 - a)]]})
