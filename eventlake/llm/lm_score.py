"""LM scoring: the marginal probability of a text over all its segmentations into subwords.

The pieces and their weights come from an existing tokenizer's vocabulary. Where its scores are those of a unigram model, they are
log probabilities; where they are mere merge ranks, a piece's probability falls with its rank as 1 / (rank + 2.7). Words are lattices of all
pieces that spell them; a log-space forward recursion sums over all paths. Bytes are pieces too, so no word is impossible. A text is its
words' lattices in a row, and an end: `lattice_score` is its marginal under the vocabulary's weights as they are given.

What is learned from the corpus is in `score`. Expected piece counts over all distinct training words (forward-backward) re-estimate the
vocabulary's weights ROUNDS times. Each training word is one more edge of its own lattice, over its whole length, that has the word's share of the
training tokens. What that share leaves to words not seen is Witten and Bell's estimate, and falls to the lattice of pieces; `score` is the
marginal over all these segmentations.

Words repeat, so the corpus becomes a table of distinct words with their training counts; lattices are solved once a
word. Going back to the documents, the most frequent words, FREQUENT at most, travel as a broadcast, and the rest
are joined on the word.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import fold, most_frequent, remove, small_batches, written

#: Rounds of re-estimation; what each piece is given beside its expected count.
ROUNDS, SMOOTHING = 2, 0.01
#: Words that go to every executor.
FREQUENT = 65_536
#: Distinct words that a worker counts before it passes them on; symbols of words in one batch of lattices.
COUNTED_AT_ONCE, SYMBOLS_AT_ONCE = 400_000, 1 << 16
#: Added to each count of the base score; the end's weight beside the pieces', of which vocabularies have no score.
BASE_ADDED, END = 0.5, 1e-3
#: A word's first symbol, after the 256 bytes.
SPACE = 256

U = np.uint64
_STEP = U(0x9E3779B97F4A7C15)
_BITS = 20


class Pieces:
    """The pieces as hashes with their log probabilities; the last probability is the end's."""

    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        found: dict[tuple[int, ...], float] = {}
        for i in range(model.get_piece_size()):
            name = model.id_to_piece(i)
            if model.is_byte(i):
                found.setdefault((int(name[3:5], 16),), -math.inf)
            elif not (model.is_control(i) or model.is_unknown(i) or model.is_unused(i) or "▁" in name[1:]):  # no word has a space inside
                found[(SPACE, *name[1:].encode()) if name.startswith("▁") else tuple(name.encode())] = model.get_score(i)
        known = [v for v in found.values() if v > -math.inf]
        ranks = all(v == int(v) for v in known)  # merge ranks are whole numbers
        least = min(known, default=0.0) - 1.0
        for b in range(257):
            found.setdefault((b,), -math.inf)
        symbols = sorted(found, key=lambda s: (-found[s], s))
        hashes = np.array([self.hash(s) for s in symbols], U)
        order = np.argsort(hashes)
        self.longest = max(map(len, symbols))
        self.hashes = hashes[order]
        self.first = np.array([symbols[i][0] == SPACE for i in order])
        self.seen = np.zeros(1 << _BITS, bool)
        self.seen[(self.hashes >> U(64 - _BITS)).astype(np.int64)] = True
        weights = 1 / (order + 3.7) if ranks else np.exp([max(found[symbols[i]], least) for i in order])
        self.logp = np.log(np.append(weights, END * weights.sum()) / (weights.sum() * (1 + END)))

    @staticmethod
    def hash(symbols: tuple[int, ...]) -> int:
        h = 0
        for x in symbols:
            h = (h * int(_STEP) + x + 1) * 0xD6E8FEB86659FD93 % (1 << 64)
        return h

    def updated(self, expected: np.ndarray) -> Pieces:
        """The same pieces with probabilities from expected counts (the end's last)."""
        new = object.__new__(Pieces)
        new.hashes, new.seen, new.first, new.longest = self.hashes, self.seen, self.first, self.longest
        given = expected + SMOOTHING
        new.logp = np.log(given / given.sum())
        return new

    def boundary(self) -> tuple[float, float]:
        """(log of what makes a word's lattice a share of all words, probability of the end) where a word or the end must follow."""
        starts, end = float(np.exp(self.logp[:-1][self.first]).sum()), float(np.exp(self.logp[-1]))
        return math.log((starts + end) / starts), end / (starts + end)

    def edges(self, words: np.ndarray) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """For each length, (row, start, piece) of all pieces in equally long words (rows of symbols)."""
        out, words = [], words.astype(U)
        h = np.zeros(words.shape, U)
        with np.errstate(over="ignore"):
            for n in range(1, min(self.longest, words.shape[1]) + 1):
                h = (h[:, : words.shape[1] - n + 1] * _STEP + words[:, n - 1 :] + U(1)) * U(0xD6E8FEB86659FD93)
                row, start = np.nonzero(self.seen[(h >> U(64 - _BITS)).astype(np.int64)])
                hit = h[row, start]
                piece = np.minimum(np.searchsorted(self.hashes, hit), len(self.hashes) - 1)
                same = self.hashes[piece] == hit
                out.append((row[same], start[same], piece[same]))
        return out

    def solve(self, words: np.ndarray, expected: np.ndarray | None = None) -> np.ndarray:
        """Log of each word's summed probability; with `expected`, adds the expected piece counts to it.

        Both recursions go over a stretch of positions at a time, so the lattice of a long word is never there as a whole.
        """
        n, size = words.shape
        past = min(self.longest, size)
        width = max(past, SYMBOLS_AT_ONCE // n)
        forward = np.full((past, n), -np.inf)  # of the positions before the stretch; with `expected`, of all
        forward[-1] = 0
        kept = [forward[-1:]]
        for at in range(0, size, width):
            before, stop = min(past - 1, at), min(size, at + width)
            edges = self.edges(words[:, at - before : stop])
            steps = np.full((len(edges), stop - at + before, n), -np.inf)
            for k, (row, start, piece) in enumerate(edges):
                steps[k, start, row] = self.logp[piece]
            here = np.concatenate([forward, np.full((stop - at, n), -np.inf)])  # here[past - 1 + i]: position at + i
            for j in range(1, stop - at + 1):
                paths = np.stack([here[past - 1 + j - k] + steps[k - 1, before + j - k] for k in range(1, min(len(edges), before + j) + 1)])
                top = paths.max(axis=0)
                here[past - 1 + j] = top + np.log(np.exp(paths - top).sum(axis=0))
            forward = here[-past:]
            if expected is not None:
                kept.append(here[past:])
        if expected is not None:
            self._expect(words, np.concatenate(kept), width, expected)
        return forward[-1]

    def _expect(self, words: np.ndarray, forward: np.ndarray, width: int, expected: np.ndarray) -> None:
        """The backward recursion, in stretches from the end; adds expected counts."""
        n, size = words.shape
        after = np.zeros((1, n))  # of the positions from the end of the stretch on
        for at in range((size - 1) // width * width, -1, -width):
            stop = min(size, at + width)
            edges = [tuple(x[start < stop - at] for x in (row, start, piece)) for row, start, piece in self.edges(words[:, at : stop + min(self.longest - 1, size - stop)])]
            steps = np.full((len(edges), stop - at, n), -np.inf)
            for k, (row, start, piece) in enumerate(edges):
                steps[k, start, row] = self.logp[piece]
            here = np.concatenate([np.full((stop - at, n), -np.inf), after])  # here[i]: position at + i
            for i in range(stop - at - 1, -1, -1):
                paths = np.stack([here[i + k + 1] + steps[k, i] for k in range(min(len(edges), len(here) - 1 - i))])
                top = paths.max(axis=0)
                here[i] = top + np.log(np.exp(paths - top).sum(axis=0))
            for k, (row, start, piece) in enumerate(edges):
                if len(piece):
                    share = np.exp(forward[at + start, row] + self.logp[piece] + here[start + k + 1, row] - forward[size, row])
                    expected += np.bincount(piece, share, len(expected))
            after = here[: self.longest]


@lru_cache(maxsize=4)
def _vocabulary(path: str) -> Pieces:
    return Pieces(path)


def _lattices(words: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(positions, symbols) of words of equal length, SYMBOLS_AT_ONCE symbols at once; the first symbol is SPACE."""
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    order = np.argsort(sizes, kind="stable")
    at = 0
    while at < len(order):
        size = int(sizes[order[at]])
        last = int(np.searchsorted(sizes[order], size, side="right"))
        lot = order[at : min(last, at + max(1, SYMBOLS_AT_ONCE // (size + 1)))]
        out = np.full((len(lot), size + 1), SPACE, np.uint16)
        if size:
            out[:, 1:] = np.frombuffer(b"".join([words[i] for i in lot]), np.uint8).reshape(len(lot), size)
        yield lot, out
        at += len(lot)


def word_log_probabilities(pieces: Pieces, words: list[bytes]) -> np.ndarray:
    out = np.empty(len(words))
    for lot, symbols in _lattices(words):
        out[lot] = pieces.solve(symbols)
    return out


def split(text: str | None) -> list[bytes]:
    """Words outside ASCII white space, A-Z lower-cased."""
    return (text or "").encode("utf-8", "surrogatepass").lower().split()


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(train, text) -> (word, count in training texts), words of other texts with 0."""
    counts: Counter = Counter()

    def out():
        return pa.RecordBatch.from_arrays([pa.array(list(counts), pa.binary()).cast(pa.string()), pa.array(list(counts.values()), pa.int64())], names=["word", "c"])

    for batch in batches:
        for train, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            words = split(text.as_py())
            if train:
                counts.update(words)
            else:
                for word in set(words):
                    if word not in counts:
                        counts[word] = 0
            if len(counts) > COUNTED_AT_ONCE:
                yield out()
                counts.clear()
    if counts:
        yield out()


def _expected(pieces: Pieces):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(pieces.logp))
        for batch in batches:
            for _, symbols in _lattices(batch.column(0).cast(pa.binary()).to_pylist()):
                pieces.solve(symbols, total)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], names=["piece", "n"])

    return run


def _solved(given: Pieces, learned: Pieces):
    """(word, c) -> logp, log10 of its lattice under the vocabulary's weights, and share, log10 of its share of all words under the learned ones."""
    shift = learned.boundary()[0]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words = batch.column(0).cast(pa.binary()).to_pylist()
            logp, share = word_log_probabilities(given, words), word_log_probabilities(learned, words) + shift
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(logp / math.log(10)), pa.array(share / math.log(10))], names=["word", "c", "logp", "share"])

    return run


_SUMS = "n_tokens long, n_known long, base double, lattice double, score double, word string, n long"


def _gathered(frequent, end: tuple[int, float, float, float]):
    """(row, doc_id, held_out, text) -> a row with the sums over the end and frequent words, and a row for each other word."""
    names = ["row", "doc_id", "held_out", *(x.split()[0] for x in _SUMS.split(", "))]
    kinds = (pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.float64())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        look = frequent.value.get
        for batch in batches:
            heads: list[list] = [[] for _ in kinds]
            of, rare, times = [], [], []
            for row, text in zip(batch.column(0).to_pylist(), batch.column(3), strict=True):
                words = split(text.as_py())
                known, base, lattice, score = end
                for word, n in Counter(words).items():
                    hit = look(word)
                    if hit is None:
                        of.append(row)
                        rare.append(word)
                        times.append(n)
                    else:
                        known += n * hit[0]
                        base += n * hit[1]
                        lattice += n * hit[2]
                        score += n * hit[3]
                for column, value in zip(heads, (len(words) + 1, known, base, lattice, score), strict=True):
                    column.append(value)
            none = lambda kind, n: pa.nulls(n, kind)
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], *[pa.array(x, k) for x, k in zip(heads, kinds, strict=True)], none(pa.string(), batch.num_rows), none(pa.int64(), batch.num_rows)], names=names)
            for i in range(0, len(of), 1 << 18):
                lot = slice(i, i + (1 << 18))
                size = len(of[lot])
                yield pa.RecordBatch.from_arrays([pa.array(of[lot], pa.int64()), *[none(k, size) for k in (batch.column(1).type, pa.bool_(), *kinds)], pa.array(rare[lot], pa.binary()).cast(pa.string()), pa.array(times[lot], pa.int64())], names=names)

    return run


def score(docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text", held_out: int = 1) -> DataFrame:
    """One row for each input row: the id, held_out, n_tokens, n_known, train_tokens, base_score, score, lattice_score.

    lattice_score is what the vocabulary's pieces alone give, score has the training words as edges too. Both are log10 of a marginal
    over all segmentations, with the end.

    Null text counts as empty: one end and no words. Words of held-out texts alone have no count and are scored all the same.
    Repeated rows count as often as they occur, and give repeated rows. Without training texts all words are unknown and
    the lattice alone gives their shares. An empty table gives no rows; other columns are ignored. Ids may be of any type.
    """
    small_batches(docs.sparkSession)
    source = docs.select(F.col(id_col).alias("doc_id"), (fold(id_col) == held_out).alias("held_out"), F.col(text_col).alias("text"))
    kind = source.schema["doc_id"].dataType.simpleString()
    words = written(source.select(~F.col("held_out"), "text").mapInArrow(_counted, "word string, c long").groupBy("word").agg(F.sum("c").alias("c")), "words")
    texts = source.select(F.count_if(~F.col("held_out"))).first()[0]
    tokens, distinct = words.select(F.coalesce(F.sum("c"), F.lit(0)), F.count_if(F.col("c") > 0)).first()
    tokens, distinct = tokens + texts, distinct + (texts > 0)

    given = pieces = _vocabulary(vocabulary)
    for _ in range(ROUNDS if texts else 0):
        expected = np.zeros(len(pieces.logp))
        for r in words.where("c > 0").mapInArrow(_expected(pieces), "piece long, n double").groupBy("piece").agg(F.sum("n").alias("n")).collect():  # as many as pieces
            expected[r["piece"]] = r["n"]
        expected[-1] = expected.sum() * texts / max(1, tokens - texts)  # an end for as many words as in the texts
        pieces = pieces.updated(expected)
    solved = written(words.mapInArrow(_solved(given, pieces), "word string, c long, logp double, share double"), "solved")
    remove(words)

    whole = tokens + BASE_ADDED * (distinct + 1)
    base = lambda c: math.log10((c + BASE_ADDED) / whole)
    novel, stop = float(max(1, distinct)), pieces.boundary()[1]  # tokens' worth of words not seen; the end's share of that
    left = math.log10(novel * (1 - stop))
    top = most_frequent(solved, "c", FREQUENT).collect()
    own = lambda c, share: math.log10((c + 10 ** (left + share)) if c else 1) + (0 if c else left + share) - math.log10(tokens + novel)
    frequent = docs.sparkSession.sparkContext.broadcast({r["word"].encode(): (int(r["c"] > 0), base(r["c"]), r["logp"], own(r["c"], r["share"])) for r in top})
    end = (int(texts > 0), base(texts), math.log10(given.boundary()[1]), math.log10((texts + novel * stop) / (tokens + novel)))
    parts = written(source.select(F.monotonically_increasing_id().alias("row"), "doc_id", "held_out", "text").mapInArrow(_gathered(frequent, end), f"row long, doc_id {kind}, held_out boolean, {_SUMS}"), "parts")

    c, n, logp, share = F.col("c"), F.col("n"), F.col("logp"), F.col("share")
    whole_word = F.when(c > 0, F.log10(c + F.pow(F.lit(10.0), share + left))).otherwise(share + left) - math.log10(tokens + novel)
    rare = parts.where("word is not null").select("row", "word", "n").join(solved, "word")
    sums = rare.groupBy("row").agg(F.sum(F.when(c > 0, n).otherwise(0)).alias("_known"), F.sum(n * F.log10((c + BASE_ADDED) / whole)).alias("_base"), F.sum(n * logp).alias("_lattice"), F.sum(n * whole_word).alias("_score"))
    found = parts.where("word is null").drop("word", "n").join(sums, "row", "left")
    plus = lambda a, b: F.col(a) + F.coalesce(b, F.lit(0))
    return found.select(
        F.col("doc_id").alias(id_col),
        "held_out",
        "n_tokens",
        plus("n_known", "_known").alias("n_known"),
        F.lit(tokens).cast("long").alias("train_tokens"),
        plus("base", "_base").alias("base_score"),
        plus("score", "_score").alias("score"),
        plus("lattice", "_lattice").alias("lattice_score"),
    )
