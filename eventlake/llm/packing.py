"""Best-fit packing of tokenised documents into fixed-length sequences.

Pattern packing by non-negative least squares: the histogram of piece lengths (as many bins as a sequence has
tokens, whatever the corpus size) is all that the driver sees. Patterns of a few documents that fill a sequence
are enumerated over rounded-up lengths, their repeat counts are fitted to the histogram by non-negative least squares
and rounded, and what is left is packed best-fit, longest first, into the gaps and then into new sequences.
The plan is a short table of runs (length, first rank, count, first sequence, offset); each piece finds
its run by its rank among the pieces of its length, in the executors.
"""

from __future__ import annotations

import os
import zlib
from bisect import bisect_left, bisect_right, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import forget, per_process, small_batches, trim, written

CAPACITY = 4096
#: Lengths are rounded up to this many steps for the patterns, and a pattern has so many documents at most.
STEPS, FEW = 64, 3
#: Pieces of one length that one task ranks: so many, or all divided by SHARES if that is more.
RANKED_AT_ONCE, SHARES = 500, 200_000
#: Words whose ids a worker keeps; beyond that it forgets the older half.
CACHED_WORDS = 400_000
#: Bytes of text that a worker splits into words together.
TEXT_AT_ONCE = 3 << 20
#: Words that one call of the tokenizer joins.
WORDS_AT_ONCE = 256
END_ID = 1

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


class WordIds:
    """Chunk of a text between spaces -> its ids as little-endian bytes. No token spans white space, so chunks are independent."""

    #: A token of its own among spaces: it separates the words of one call.
    MARK = "\x00"

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # a task has one core
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.known: dict[str, bytes] = {}
        mark = self.tokenizer.encode(self.MARK, add_special_tokens=False).ids
        self.mark = mark[0] if len(mark) == 1 else None
        suffix, names = getattr(self.tokenizer.model, "end_of_word_suffix", None), self.tokenizer.get_vocab()
        self.ends = np.zeros(max(names.values(), default=0) + 1, bool) if suffix else None
        if suffix:
            self.ends[[i for name, i in names.items() if name.endswith(suffix)]] = True

    def learn(self, words: list[str]) -> None:
        encode = lambda texts: [np.array(x.ids, "<u4") for x in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        if self.ends is not None:  # letters alone end in one such token at least, so as many as there are words need no mark between
            letters = [w for w in words if w.isalpha()]
            lots = [letters[i : i + WORDS_AT_ONCE] for i in range(0, len(letters), WORDS_AT_ONCE)]
            for lot, ids in zip(lots, encode([" ".join(x) for x in lots]), strict=True):
                cuts = (4 * np.flatnonzero(self.ends[ids]) + 4).tolist()
                if len(cuts) == len(lot) and cuts[-1] == 4 * len(ids):
                    data = ids.tobytes()
                    self.known.update(zip(lot, [data[a:b] for a, b in zip([0, *cuts[:-1]], cuts, strict=True)], strict=True))
            words = [w for w in words if w not in self.known]
        plain = [w for w in words if self.MARK not in w] if self.mark is not None else []
        lots = [plain[i : i + WORDS_AT_ONCE] for i in range(0, len(plain), WORDS_AT_ONCE)]
        for lot, ids in zip(lots, encode([f" {self.MARK} ".join(x) for x in lots]), strict=True):
            cuts = np.flatnonzero(ids == self.mark).tolist()
            if len(cuts) == len(lot) - 1:
                data = ids.tobytes()
                for word, a, b in zip(lot, [0, *(x + 1 for x in cuts)], [*cuts, len(ids)], strict=True):
                    self.known[word] = data[4 * a : 4 * b]
        rest = [w for w in words if w not in self.known]
        for word, ids in zip(rest, encode(rest), strict=True):
            self.known[word] = ids.tobytes()

    def _parts(self, words: pa.Array) -> tuple[pa.Array, pa.Array]:
        """(base, mark) of distinct words, whose ids in a row are the word's: A-Z lower-cased, a full stop or comma after a letter apart."""
        special = pc.or_(pc.match_substring(words, "<|"), pc.match_substring(words, "\u0130"))  # special tokens; a letter whose lower case ends in a mark
        low = pc.if_else(special, words, pc.ascii_lower(words))
        marked = pc.and_not(pc.match_substring_regex(low, r"\pL[.,]$"), special)
        return pc.if_else(marked, pc.utf8_slice_codeunits(low, 0, -1), low), pc.if_else(marked, pc.utf8_slice_codeunits(low, -1), "")

    def ids(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids, bounds): the ids of text i are ids[bounds[i]:bounds[i + 1]]. Each distinct word is looked up once."""
        split = pc.split_pattern(pc.replace_substring(pc.fill_null(texts, ""), "\n", " "), " ")
        coded = split.flatten().dictionary_encode()
        parts = pa.chunked_array(self._parts(coded.dictionary)).combine_chunks().dictionary_encode()
        words, known = parts.dictionary.to_pylist(), self.known
        found = list(map(known.get, words))
        if missing := [w for w, x in zip(words, found, strict=True) if x is None]:
            self.learn(missing)
            found = [known[w] if x is None else x for w, x in zip(words, found, strict=True)]
        if len(known) > CACHED_WORDS:
            for word in list(known)[: len(known) // 2]:
                del known[word]
        sizes = np.fromiter(map(len, found), np.int32, len(found)) // 4
        table, at, part = np.frombuffer(b"".join(found), "<u4"), coded.indices.to_numpy(), parts.indices.to_numpy()
        lists = split.offsets.to_numpy() - split.offsets[0].as_py()
        del words, found, split, coded, parts
        at = part.reshape(2, -1)[:, at].T.reshape(-1)  # base and mark of each word, in turn
        starts, each = (np.cumsum(sizes, dtype=np.int32) - sizes)[at], sizes[at]
        ends = np.zeros(len(at) + 1, np.int32)  # a slice has far fewer ids than 2 ** 31
        np.cumsum(each, out=ends[1:])
        starts -= ends[:-1]
        place = np.repeat(starts, each)
        place += np.arange(len(place), dtype=np.int32)
        return table[place], ends[2 * lists]


def _slices(batch: pa.RecordBatch, column: int) -> Iterator[pa.RecordBatch]:
    """Slices of about TEXT_AT_ONCE bytes of a text column."""
    sizes = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
    at = 0
    while at < batch.num_rows:
        end = max(at + 1, int(np.searchsorted(sizes, (sizes[at - 1] if at else 0) + TEXT_AT_ONCE, side="right")))
        yield batch.slice(at, end - at)
        at = end


def _tokenised(path: str, capacity: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, end = per_process(("words", path), lambda: WordIds(path)), np.array([END_ID], "<u4").tobytes()
        for batch in batches:
            trim()
            for some in _slices(batch, 1):
                out: list[list] = [[], [], [], [], []]
                ids, bounds = words.ids(some.column(1))
                data = ids.tobytes()
                for doc_id, a, b in zip(some.column(0).to_pylist(), (4 * bounds[:-1]).tolist(), (4 * bounds[1:]).tolist(), strict=True):
                    own = data[a:b] + end
                    for piece, at in enumerate(range(0, len(own), 4 * capacity)):
                        cut = own[at : at + 4 * capacity]
                        for column, value in zip(out, (doc_id, piece, at // 4, len(cut) // 4, zlib.crc32(cut)), strict=True):
                            column.append(value)
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(out, (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()), strict=True)], names=["doc_id", "piece", "start", "length", "ids_crc32"])
                del ids, data, out
        trim()

    return run


def pieces(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Documents as ids with the end id, cut where longer than a sequence. Null text: the end id alone."""
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(_tokenised(tokenizer, capacity), PIECES)


def nnls(a: np.ndarray, b: np.ndarray, rounds: int = 600) -> np.ndarray:
    """min |ax - b| over x >= 0, by active sets."""
    n = a.shape[1]
    x, free = np.zeros(n), np.zeros(n, bool)
    gram, right = a.T @ a, a.T @ b
    for _ in range(rounds):
        slope = np.where(free, -np.inf, right - gram @ x)
        k = int(slope.argmax())
        if slope[k] <= 1e-9 * max(1.0, float(np.abs(right).max())):
            break
        free[k] = True
        while free.any():
            at = np.flatnonzero(free)
            best = np.linalg.lstsq(gram[np.ix_(at, at)], right[at], rcond=None)[0]
            if best.min() > 0:
                x[:] = 0
                x[at] = best
                break
            low = best <= 0
            ratio = float((x[at][low] / np.maximum(x[at][low] - best[low], 1e-300)).min())
            x[at] += ratio * (best - x[at])
            gone = at[low & (x[at] <= 1e-9)]
            if not len(gone):
                gone = at[[int(best.argmin())]]
            x[gone] = 0
            free[gone] = False
    return x


def patterns(steps: int = STEPS, few: int = FEW) -> list[tuple[int, ...]]:
    """Non-increasing tuples of 1 to `few` lengths whose sum is `steps`."""

    def parts(left: int, most: int, n: int) -> Iterator[tuple[int, ...]]:
        if not left:
            yield ()
        elif n:
            for first in range(min(left, most), 0, -1):
                if first * n < left:
                    break
                for rest in parts(left - first, first, n - 1):
                    yield (first, *rest)

    return list(parts(steps, steps, few))


def plan(histogram: dict[int, int], capacity: int = CAPACITY) -> tuple[np.ndarray, int]:
    """Runs (length, first rank, count, first sequence, offset), and the number of sequences. Lengths are 1 to capacity.

    Rounded repeat counts can leave too few short pieces for the gaps; so plans that use all of
    each count or a share of it are made, and the one with the fewest sequences is taken.
    """
    return min((_plan(histogram, capacity, share) for share in (1.0, 0.9, 0.7, 0.4, 0.1)), key=lambda x: x[1])


def _plan(histogram: dict[int, int], capacity: int, share: float) -> tuple[np.ndarray, int]:
    left = {n: c for n, c in histogram.items() if c > 0}
    ranked = dict.fromkeys(left, 0)
    runs: list[tuple[int, int, int, int, int]] = []
    gaps: dict[int, list[tuple[int, int]]] = {}
    order: list[int] = []
    sequences = 0

    def place(length: int, count: int, sequence: int, offset: int) -> None:
        runs.append((length, ranked[length], count, sequence, offset))
        ranked[length] += count
        left[length] -= count

    def gap(size: int, sequence: int, count: int) -> None:
        if size and count:
            if size not in gaps:
                gaps[size] = []
                insort(order, size)
            gaps[size].append((sequence, count))

    if left.get(capacity):
        count = left[capacity]
        place(capacity, count, 0, 0)
        sequences = count

    steps = min(STEPS, capacity)
    step = lambda n: -(-n * steps // capacity)
    of_step: dict[int, list[int]] = {}
    for n in sorted(left, reverse=True):
        if left[n]:
            of_step.setdefault(step(n), []).append(n)
    if of_step:
        known = patterns(steps)
        a = np.zeros((steps, len(known)))
        for j, p in enumerate(known):
            for part in p:
                a[part - 1, j] += 1
        b = np.array([sum(left[n] for n in of_step.get(u, [])) for u in range(1, steps + 1)], float)
        fitted = np.rint(share * nnls(a, b)).astype(int)
        lengths = sorted(n for n in left if left[n])
        for j in np.argsort(-fitted, kind="stable"):
            parts, more = known[j], int(fitted[j])
            if len(parts) < 2:
                continue
            while more > 0:
                chosen: list[int] = []
                for i, u in enumerate(parts):
                    if i == len(parts) - 1:  # the last one fits best, whatever its step
                        room = capacity - sum(chosen)
                        k = bisect_right(lengths, room) - 1
                        while k >= 0 and left[lengths[k]] <= chosen.count(lengths[k]):
                            if not left[lengths[k]]:
                                lengths.pop(k)
                            k -= 1
                        if k >= 0:
                            chosen.append(lengths[k])
                        break
                    n = next((n for n in of_step.get(u, []) if left[n] > chosen.count(n)), None)
                    if n is None:
                        break
                    chosen.append(n)
                if len(chosen) < len(parts):
                    break
                count = min([more, *(left[n] // chosen.count(n) for n in chosen)])
                offset = 0
                for n in chosen:
                    place(n, count, sequences, offset)
                    offset += n
                gap(capacity - offset, sequences, count)
                sequences += count
                more -= count

    for n in sorted(left, reverse=True):
        while left[n]:
            k = bisect_left(order, n)
            if k < len(order):
                size = order[k]
                sequence, there = gaps[size].pop()
                if not gaps[size]:
                    del gaps[size]
                    order.pop(k)
                count = min(there, left[n])
                place(n, count, sequence, capacity - size)
                gap(size, sequence + count, there - count)
                gap(size - n, sequence, count)
            else:
                each = capacity // n
                count, copies = (left[n] // each, each) if left[n] >= each else (1, left[n])
                for i in range(copies):
                    place(n, count, sequences, i * n)
                gap(capacity - copies * n, sequences, count)
                sequences += count
    return np.array(runs, np.int64).reshape(-1, 5), sequences


def _placed(runs: np.ndarray):
    runs = runs[np.lexsort((runs[:, 1], runs[:, 0]))]
    keys = (runs[:, 0] << 44) + runs[:, 1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        for batch in batches:
            length, rank = (batch.column(i).to_numpy(zero_copy_only=False) for i in (3, 5))
            at = np.searchsorted(keys, (length << 44) + rank, side="right") - 1
            sequence = runs[at, 3] + rank - runs[at, 1]
            yield pa.RecordBatch.from_arrays([*batch.columns[:5], pa.array(sequence), pa.array(runs[at, 4])], names=["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"])

    return run


def pack(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    Null and empty texts are one end id. Repeated rows are packed as often as they occur; null ids stay null.
    Every piece is placed once, offsets in a sequence run without gaps from 0, and no sequence exceeds the capacity.
    An empty table gives no rows; other columns are ignored. Ids are whole numbers, or text of whole numbers: they come out as such.
    """
    small_batches(docs.sparkSession)
    cut = written(pieces(docs, tokenizer, capacity, id_col, text_col), "pieces")
    histogram = {r["length"]: r["count"] for r in cut.groupBy("length").count().collect()}  # capacity rows at most
    runs, _ = plan(histogram, capacity)
    at_once = max(RANKED_AT_ONCE, sum(histogram.values()) // SHARES)
    salts = [max(1, -(-histogram.get(n, 0) // at_once)) for n in range(capacity + 1)]
    salt = F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.element_at(F.array(*map(F.lit, salts)), F.col("length").cast("int") + 1)) if max(salts) > 1 else F.lit(0)
    cut = cut.withColumn("_salt", salt.cast("int"))
    if max(salts) > 1:
        counts = sorted((r["length"], r["_salt"], r["count"]) for r in cut.groupBy("length", "_salt").count().collect())  # capacity + SHARES rows at most
        base, last = [], (None, 0)
        for n, s, c in counts:
            before = last[1] if last[0] == n else 0
            base.append((n, s, before))
            last = (n, before + c)
        first = docs.sparkSession.createDataFrame(base or [(0, 0, 0)], "length long, _salt int, _first long")
        cut = cut.join(F.broadcast(first), ["length", "_salt"])
    else:
        cut = cut.withColumn("_first", F.lit(0).cast("long"))
    order = Window.partitionBy("length", "_salt").orderBy("doc_id", "piece", "ids_crc32")
    ranked = cut.select("doc_id", "piece", "start", "length", "ids_crc32", (F.col("_first") + F.row_number().over(order) - 1).cast("long").alias("_rank"))
    return ranked.mapInArrow(_placed(runs), f"{PIECES}, sequence_id long, offset long")
