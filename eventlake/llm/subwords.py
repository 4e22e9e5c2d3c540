"""SentencePiece encoding and decoding over a piece table, as a relational lattice.

Texts become words, runs of spaces with what follows, and words become units: cut further wherever no piece has the two neighbouring
characters, so that the best segmentation of a text is that of its units in a row. The lattice of a slice's distinct words is a table:
a row (unit, start) for each character is equi-joined, a character further each time, to the table of the pieces' prefixes; prefixes
that are pieces leave the edges (unit, start, end, piece); edges are ordered by end and start, and a fold over them keeps the
best path of every unit (Viterbi). All of it is done on columns, for all units of a lot at once, where the texts are: as the piece
table is small and words are many, nothing has to be counted, sent or sorted between machines. A unit of over UNIT characters (there
are few: unspaced writing, long codes) would be a fold of as many steps for itself; the same recursion, with the same ties, streams
over it instead, so no text is cut where a piece might reach over.

A worker keeps the words that it has met, FREQUENT at most; past that, those of its last slice.

A piece's log probability follows the rank that its score gives it (as 1 / (rank + 2.7)), where scores are mere merge ranks; scores
of a unigram model are taken as they are. Characters without a piece become their UTF-8 bytes' pieces, so decoding is exact.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import per_process, small_batches, trim

#: Characters of the longest unit whose lattice is rows of a table.
UNIT = 256
#: Words whose ids a worker keeps from slice to slice.
FREQUENT = 400_000
#: Bytes of text in a slice; characters whose lattice is one table; documents in a batch of results.
TEXT_AT_ONCE, CHARS_AT_ONCE, DOCS_AT_ONCE = 4 << 20, 1 << 18, 256

_CHUNK = re.compile(r" +[^ ]*")


def _codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")


class Prefixes:
    """The pieces' prefixes as a table to be joined to, a character at a time.

    char has a small number for each code point, 0 for those of no piece. A prefix has a number, the empty one 0; with one more character c
    it is the prefix of number base + c, if that one's parent it is, else none at all. Of a prefix that is a piece, piece has the
    id (else -1) and score the score.
    """

    def __init__(self, pieces: list[tuple[str, int, float]]):
        self.char = np.zeros(0x110000, np.uint16)
        found = sorted({c for p, _, _ in pieces for c in p})
        if len(found) > 0xFFFE:
            raise ValueError(f"{len(found)} characters in the pieces")
        for n, c in enumerate(found, 1):
            self.char[ord(c)] = n
        width = len(found) + 1
        pairs: set[tuple[int, int]] = set()
        below: dict[str, dict[int, str]] = {"": {}}
        for text, _, _ in pieces:
            codes = self.char[_codes(text)].tolist()
            pairs.update(zip(codes, codes[1:], strict=False))
            for i, c in enumerate(codes, 1):
                below.setdefault(text[: i - 1], {})[c] = text[:i]
        self.left, self.right = np.zeros(width, np.uint16), np.zeros(width, np.uint16)  # numbers among those that have a neighbour
        for side, chars in ((self.left, {a for a, _ in pairs}), (self.right, {b for _, b in pairs})):
            side[sorted(chars)] = np.arange(1, len(chars) + 1)
        self.pairs = np.zeros((int(self.left.max()) + 1, int(self.right.max()) + 1), bool)
        for a, b in pairs:
            self.pairs[self.left[a], self.right[b]] = True
        self._number(below, width)
        self.piece, self.score = np.full(len(self.parent), -1, np.int32), np.zeros(len(self.parent))
        for text, i, score in pieces:
            self.piece[self.at[text]], self.score[self.at[text]] = i, score
        del self.at

    def cuts(self, codes: np.ndarray) -> np.ndarray:
        """For each character but the first whether no piece has it after the one before."""
        chars = self.char[codes]
        return ~self.pairs[self.left[chars[:-1]], self.right[chars[1:]]]

    def _number(self, below: dict[str, dict[int, str]], width: int) -> None:
        """Prefixes with many children first: each takes the first place where all of its children's numbers are free."""
        base, at = {}, {"": 0}
        taken = np.zeros(4 * width + 2 * sum(map(len, below.values())), bool)
        taken[:width] = True  # so that no base is negative
        low, tries = width, 0
        for text, children in sorted(below.items(), key=lambda x: -len(x[1])):
            chars = np.array(sorted(children))
            spot = low
            while True:
                if spot + width > len(taken):
                    taken = np.concatenate([taken, np.zeros(len(taken), bool)])
                spot += int(np.argmin(taken[spot:]))
                if len(chars) == 1 or not taken[spot - chars[0] + chars].any():
                    break
                spot, tries = spot + 1, tries + 1
            if len(chars) == 1:
                low = spot
            elif tries > 20:  # crowded up to here
                low, tries = spot, 0
            base[text] = spot - int(chars[0])
            taken[base[text] + chars] = True
            at.update((child, base[text] + c) for c, child in children.items())
        size = max(at.values()) + width + 1
        self.base, self.parent, self.at = np.zeros(size, np.int32), np.full(size, -1, np.int32), at
        for text, children in below.items():
            self.base[at[text]] = base[text]
            for child in children.values():
                self.parent[at[child]] = at[text]


class Vocabulary:
    """Pieces as (text with plain spaces, id, score); byte ids; the character pairs that pieces have."""

    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        size = model.get_piece_size()
        self.bytes = [0] * 256
        self.text: list[bytes] = [b""] * size
        normal = []
        for i in range(size):
            name = model.id_to_piece(i)
            if model.is_byte(i):
                self.bytes[int(name[3:5], 16)] = i
                self.text[i] = bytes([int(name[3:5], 16)])
            elif not (model.is_control(i) or model.is_unknown(i) or model.is_unused(i)):
                plain = name.replace("▁", " ")
                self.text[i] = plain.encode()
                normal.append((plain, i, model.get_score(i)))
        ranks = all(s == int(s) for _, _, s in normal)  # merge ranks are whole numbers
        order = {i: r for r, (_, i, _) in enumerate(sorted(normal, key=lambda p: (-p[2], p[1])), 1)}
        total = sum(1 / (r + 2.7) for r in order.values())
        self.pieces = [(p, i, -math.log((order[i] + 2.7) * total) if ranks else s) for p, i, s in normal]
        self.byte_score = min((s for _, _, s in self.pieces), default=0.0) - 1.0
        self.longest = max((len(p) for p, _, _ in normal), default=1)
        self.prefixes = Prefixes(self.pieces)

    def units(self, chunk: str) -> list[str]:
        """A chunk (spaces, then none) cut where no piece reaches over."""
        starts = [0, *(np.flatnonzero(self.prefixes.cuts(_codes(chunk))) + 1).tolist(), len(chunk)]
        return [chunk[x:y] for x, y in zip(starts, starts[1:], strict=False)]

    def best(self, unit: str) -> list[int]:
        """ids of the best path of one unit; of equal ones the one that the fold over sorted edges keeps."""
        known, score, ends = self._by_piece(), [0.0], [(0, [])]
        for end in range(1, len(unit) + 1):
            top, way = -math.inf, (end - 1, [])
            for start in range(max(0, end - self.longest), end):
                found = known.get(unit[start:end])
                if found is None and start == end - 1:
                    data = unit[start].encode("utf-8", "surrogatepass")
                    found = len(data) * self.byte_score, [self.bytes[x] for x in data]
                if found is not None and score[start] + found[0] > top:
                    top, way = score[start] + found[0], (start, found[1])
            score.append(top)
            ends.append(way)
        out, at = [], len(unit)
        while at:
            at, ids = ends[at]
            out.append(ids)
        return [i for ids in reversed(out) for i in ids]

    def _by_piece(self) -> dict[str, tuple[float, list[int]]]:
        if not hasattr(self, "_table"):
            self._table = {p: (s, [i]) for p, i, s in self.pieces}
        return self._table

    def decode(self, ids: Iterator[int]) -> str:
        return b"".join([self.text[i] for i in ids]).decode("utf-8", "replace")[1:]


@lru_cache(maxsize=4)
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


def words(text: str) -> list[str]:
    """What stands between single spaces; of several spaces all but one go to the word after them. None in an empty text."""
    if not text:
        return []
    return [c[1:] for c in _CHUNK.findall(f" {text}")] if "  " in f" {text}" else text.split(" ")


def _slices(batch: pa.RecordBatch) -> Iterator[tuple[pa.Array, pa.Array, pa.ListArray]]:
    """(ids, distinct words, numbers of the words as lists) of slices of a batch (id, text).

    Texts with other than single spaces are split apart from the rest.
    """
    trim()
    sizes = np.cumsum(pc.fill_null(pc.binary_length(batch.column(1)), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
    at = 0
    while at < batch.num_rows:
        end = max(at + 1, int(np.searchsorted(sizes, (sizes[at - 1] if at else 0) + TEXT_AT_ONCE, side="right")))
        some = batch.slice(at, end - at)
        at = end
        texts = pc.fill_null(some.column(1).cast(pa.string()), "")
        odd = pc.or_(pc.or_(pc.equal(texts, ""), pc.starts_with(texts, " ")), pc.match_substring(texts, "  "))
        for kind, mask in enumerate((pc.invert(odd), odd)):
            own = texts.filter(mask)
            if len(own):
                lists = pa.array([words(t) for t in own.to_pylist()], pa.list_(pa.string())) if kind else pc.split_pattern(own, " ")
                coded = lists.flatten().dictionary_encode()
                bounds = lists.offsets.to_numpy() - lists.offsets[0].as_py()
                yield some.column(0).filter(mask), coded.dictionary, pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), coded.indices)


def _edges(codes: np.ndarray, begins: np.ndarray, ends: np.ndarray, known: Vocabulary) -> tuple[np.ndarray, ...]:
    """Edges (start, length, id or -1 for bytes, score) of units that lie end to end in codes, longest first; begins and ends: each unit's."""
    table, chars = known.prefixes, known.prefixes.char[codes]
    limit = np.repeat(ends, ends - begins)  # of each character's unit
    start, prefix, found = np.arange(len(codes), dtype=np.int32), np.zeros(len(codes), np.int32), []
    for length in range(1, known.longest + 1):
        more = table.base[prefix] + chars[start + (length - 1)]
        kept = table.parent[more] == prefix
        start, prefix = (start, more) if kept.all() else (start[kept], more[kept])
        ids = table.piece[prefix]
        whole = ids >= 0
        at = start[whole]
        found.append((at, np.full(len(at), length, np.int32), ids[whole], table.score[prefix[whole]]))
        if length == 1:
            bare = np.ones(len(codes), bool)
            bare[at] = False
            other = np.flatnonzero(bare).astype(np.int32)
            size = 1 + (codes[other] > 0x7F).astype(np.int32) + (codes[other] > 0x7FF) + (codes[other] > 0xFFFF)
            found.append((other, np.ones(len(other), np.int32), np.full(len(other), -1, np.int32), size * known.byte_score))
        kept = start + length < limit[start]
        start, prefix = start[kept], prefix[kept]
        if not len(start):
            break
    return tuple(np.concatenate(x) for x in zip(*reversed(found), strict=True))


def _paths(codes: np.ndarray, begins: np.ndarray, known: Vocabulary) -> tuple[np.ndarray, np.ndarray]:
    """ids of the best paths of units of one character or more, that lie end to end in codes, and how many each has.

    Place i + k of the fold is the one before character i, of unit k: a unit has a place more than it has characters.
    """
    ends = np.append(begins[1:], len(codes)).astype(np.int32)
    unit = np.repeat(np.arange(len(begins), dtype=np.int32), ends - begins)
    start, length, ids, scores = _edges(codes, begins, ends, known)
    until = start - begins[unit[start]] + length
    order = np.argsort(until.astype(np.uint16) if until.max() < 1 << 16 else until, kind="stable")  # of equal ends, the first start is first
    start, length, ids, scores, until = start[order], length[order], ids[order], scores[order], until[order]
    source = start + unit[start]
    target = source + length
    best, last = np.full(len(codes) + len(begins), -np.inf), np.empty(len(codes) + len(begins), np.int32)
    first = begins + np.arange(len(begins), dtype=np.int32)
    best[first] = 0.0
    steps = [0, *(np.flatnonzero((np.diff(until) != 0) | (np.diff(length) != 0)) + 1).tolist(), len(start)]
    for a, b in zip(steps, steps[1:], strict=False):  # edges of one end and length: one a unit
        to, score = target[a:b], best[source[a:b]] + scores[a:b]
        better = np.flatnonzero(score > best[to])
        best[to[better]], last[to[better]] = score[better], better + a
    on_path, at, stop = np.zeros(len(best), bool), ends + np.arange(len(begins), dtype=np.int32), first
    while len(at):
        on_path[at] = True
        at = source[last[at]]
        more = at > stop
        at, stop = at[more], stop[more]
    edges = last[on_path]
    ids, of = ids[edges], unit[start[edges]]
    in_bytes = ids < 0
    if in_bytes.any():
        bare = codes[start[edges[in_bytes]]]
        size = np.ones(len(ids), np.int32)
        size[in_bytes] += (bare > 0x7F).astype(np.int32) + (bare > 0x7FF) + (bare > 0xFFFF)
        data = bare.astype("<u4").tobytes().decode("utf-32-le", "surrogatepass").encode("utf-8", "surrogatepass")
        ids, of, in_bytes = np.repeat(ids, size), np.repeat(of, size), np.repeat(in_bytes, size)
        ids[in_bytes] = np.array(known.bytes, np.int32)[np.frombuffer(data, np.uint8)]
    return ids, np.bincount(of, minlength=len(begins)).astype(np.int32)


def _solved(texts: pa.Array, known: Vocabulary, cut: bool) -> pa.ListArray:
    """ids of texts of one character or more; cut: into units, else each is one. However long a text is, a lot of units is bounded."""
    if not len(texts):
        return pa.array([], pa.list_(pa.int32()))
    offsets = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset :]
    codes = _codes(bytes(memoryview(texts.buffers()[2])[offsets[0] : offsets[len(texts)]]).decode())
    sizes = pc.utf8_length(texts).to_numpy().astype(np.int64)
    heads = np.cumsum(sizes) - sizes
    new = np.zeros(len(codes), bool)
    if cut:
        new[1:] = known.prefixes.cuts(codes)
    new[heads] = True
    bounds, values, counts, a = np.append(np.flatnonzero(new), len(codes)), [], [], 0
    while a < len(bounds) - 1:
        b = max(a + 1, int(np.searchsorted(bounds, bounds[a] + CHARS_AT_ONCE, side="right")) - 1)
        own, begins = codes[bounds[a] : bounds[b]], (bounds[a:b] - bounds[a]).astype(np.int32)
        long = np.diff(bounds[a : b + 1]) > UNIT
        ids, each = _mixed(own, begins, long, known) if long.any() else _paths(own, begins, known)
        values.append(ids)
        counts.append(each)
        a = b
    each = np.add.reduceat(np.concatenate(counts).astype(np.int64), np.searchsorted(bounds, heads))
    return pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(each)), pa.int32()), pa.array(np.concatenate(values), pa.int32()))


def _lists(sizes: np.ndarray, values: np.ndarray, chosen: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of lists laid end to end in values: those chosen, end to end, and their sizes."""
    starts, each = (np.cumsum(sizes) - sizes)[chosen], sizes[chosen]
    ends = np.cumsum(each)
    return values[np.repeat(starts - ends + each, each) + np.arange(ends[-1] if len(ends) else 0)], each


def _mixed(codes: np.ndarray, begins: np.ndarray, long: np.ndarray, known: Vocabulary) -> tuple[np.ndarray, np.ndarray]:
    """As _paths(), where some units are long."""
    ends = np.append(begins[1:], len(codes))
    short = ~np.repeat(long, ends - begins)
    sizes = (ends - begins)[~long]
    ids, each = _paths(codes[short], (np.cumsum(sizes) - sizes).astype(np.int32), known) if len(sizes) else (np.zeros(0, np.int32), np.zeros(0, np.int32))
    streamed = [np.array(known.best(codes[x:y].tobytes().decode("utf-32-le", "surrogatepass")), np.int32) for x, y in zip(begins[long], ends[long], strict=True)]
    lists, counts = np.concatenate([ids, *streamed]), np.concatenate([each, [len(x) for x in streamed]]).astype(np.int64)
    place = np.empty(len(begins), np.int64)
    place[~long], place[long] = np.arange(len(each)), len(each) + np.arange(len(streamed))
    return _lists(counts, lists, place)


def encode_units(counted: DataFrame, known: Vocabulary, path: str) -> DataFrame:
    """(unit, n), units of one character or more -> (unit, n, ids)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = _known(path).known
        for batch in batches:
            units = batch.column(0).cast(pa.string())
            yield pa.RecordBatch.from_arrays([units, batch.column(1), _solved(units, own, cut=False)], names=["unit", "n", "ids"])

    return counted.select("unit", "n").mapInArrow(run, "unit string, n long, ids array<int>")


class _Known:
    """Words -> ids, kept from slice to slice."""

    def __init__(self, known: Vocabulary):
        self.known, self.words, self.ids = known, pa.array([], pa.string()), pa.array([], pa.list_(pa.int32()))
        self.pieces = pa.array(known.text, pa.binary())

    def of(self, distinct: pa.Array) -> pa.ListArray:
        at = pc.index_in(distinct, self.words)
        new = distinct.filter(at.is_null())
        solved = _solved(pc.binary_join_element_wise(" ", new, ""), self.known, cut=True)
        words, ids = pa.concat_arrays([self.words, new]), pa.concat_arrays([self.ids, solved])
        place = at.fill_null(-1).to_numpy().copy()
        place[place < 0] = len(self.words) + np.arange(len(new))
        found = ids.take(pa.array(place))
        self.words, self.ids = (words, ids) if len(words) <= FREQUENT else (distinct, found) if len(distinct) <= FREQUENT else (words[:0], ids[:0])
        return found

    def digests(self, ids: np.ndarray, bounds: np.ndarray) -> list[str]:
        """SHA-256 of what each list of ids decodes to; bounds: where lists begin and end."""
        texts = self.pieces.take(pa.array(ids))
        at = np.frombuffer(texts.buffers()[1], np.int32)[bounds].tolist()
        data = memoryview(texts.buffers()[2] or b"")
        out = []
        for x, y in zip(at, at[1:], strict=False):
            text = bytes(data[x:y]).decode("utf-8", "replace")
            out.append(hashlib.sha256(text[1:].encode()).hexdigest())
        return out


def _known(path: str) -> _Known:
    """One for each worker."""
    return per_process(("subwords", path, UNIT, FREQUENT, CHARS_AT_ONCE), lambda: _Known(Vocabulary(path)))


def _packed(values: np.ndarray) -> bytes:
    """Numbers of four bytes: all first bytes, then all second ones, and so on, since the high ones are much alike."""
    return zstandard.ZstdCompressor(level=1).compress(values.view(np.uint8).reshape(-1, 4).T.tobytes())


def _unpacked(data: bytes, kind: str) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8).reshape(4, -1).T).reshape(-1).view(kind)


def _encoded(path: str, digest: bool):
    """Documents (id, text) -> (doc_id, ids), and the digest of the decoded ids if asked."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = _known(path)
        for batch in batches:
            for docs, distinct, numbers in _slices(batch):
                found = known.of(distinct)
                for i in range(0, len(docs), DOCS_AT_ONCE):
                    some = numbers.slice(i, DOCS_AT_ONCE)
                    lists = found.take(some.flatten())
                    at = some.offsets.to_numpy()
                    bounds = (lists.offsets.to_numpy() - lists.offsets[0].as_py())[at - at[0]]
                    ids = lists.flatten()
                    columns = [docs.slice(i, DOCS_AT_ONCE), pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), ids)]
                    if digest:
                        columns.append(pa.array(known.digests(ids.to_numpy(), bounds), pa.string()))
                    yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "ids", "decoded_sha256"][: len(columns)])

    return run


def encode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", digest: bool = False) -> DataFrame:
    """One row for each input row: the id, ids (array of piece ids, none for a null or empty text).

    With digest, also decoded_sha256, of what the ids decode to. Repeated rows give repeated rows; an empty table none; other columns are ignored. decode() gives the text back.
    """
    small_batches(docs.sparkSession)
    source = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    kind = source.schema["doc_id"].dataType.simpleString()
    return source.mapInArrow(_encoded(path, digest), f"doc_id {kind}, ids array<int>" + ", decoded_sha256 string" * digest).withColumnRenamed("doc_id", id_col)


def decode(ids: Column, path: str) -> Column:
    """The text of an array of piece ids."""

    @F.pandas_udf("string")
    def text(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        known = _known(path).known
        for part in parts:
            yield part.map(known.decode)

    return text(ids)


def round_trip(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """encode()'s rows with n_pieces, and the SHA-256 of what decode() makes of them, decoded_sha256."""

    found = encode(docs, path, id_col, text_col, digest=True)
    return found.select(id_col, F.size("ids").cast("long").alias("n_pieces"), "ids", "decoded_sha256")
