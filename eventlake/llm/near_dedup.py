"""MinHash near-dedup: SuperMinHash signatures, banding, verification on full shingle sets, union-find grouping.

1. Each document becomes a set of distinct word shingles (64-bit hashes), a 128-bit digest of the whole set, and band
   keys of a SuperMinHash signature. SuperMinHash draws, for each element, a random permutation of the
   registers along with a uniform value for each rank; ranks are done one after another for all elements of a batch, and a
   document stops as soon as every register has a value, since later ranks can't lower one.
2. Documents with equal sets are one class. Only classes go on, so copies never meet in a bucket.
3. Classes that share a band key are a bucket. Each member is verified against the bucket's hub, a member picked by a hash
   (one row a member, never all pairs). Links found so are grouped into components.
4. A bucket whose other members still lie in several components goes on. Jaccard distance is a metric, so two
   members can be linked only if their distances from the hub, known from step 3, differ by the threshold's distance at
   most: members are cut into windows of that distance. From windows that hold several components, members go that have so
   many shingles which no other such member has that they can't be similar enough to any. The rest meet
   another hub, HUBS times at most. What is still torn then is finished exactly: its members are dealt
   into blocks, and those of different components are compared block against block, each on its full set.
5. Components of all links give each document's smallest reachable id.

With `bands` bands of `ROWS` rows, a pair at the threshold shares no band with a probability of MISS at most;
that is the only way to lose a link.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from xxhash import xxh3_64_intdigest

from .common import Scratch, forget, remove, small_batches, trim, written
from .grouping import components

ROWS, MISS = 4, 1e-6
#: Bytes of text that a worker turns into signatures at once; of a longer text, so many are split into words and so many shingles hashed at once.
TEXT_AT_ONCE, SHINGLES_AT_ONCE = 1 << 21, 1 << 17
#: Members in a block of the exact comparison.
BLOCK = 256
#: Further hubs that the members of a torn bucket meet before blocks do.
HUBS = 1
#: Ids up to which the documents to verify are picked by a broadcast join; beyond that by a shuffled one.
BROADCAST_IDS = 1_000_000

U = np.uint64
_SPACE = re.compile(rb"[ \t-\r]")
_VALUE_BITS = U(24)
_FULL = U(0xFFFFFFFFFFFFFFFF)


def bands_for(percent: int, rows: int = ROWS) -> int:
    """Bands for which a pair at the threshold is missed with a probability of MISS at most."""
    return math.ceil(math.log(MISS) / math.log(1 - (percent / 100) ** rows))


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection on 64 bits that spreads every input bit (the finalizer of SplitMix64)."""
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


def word_hashes(text: bytes) -> np.ndarray:
    """Hashes of a text's words, in order; no more than TEXT_AT_ONCE bytes, and a word, are split at once."""
    parts, at = [], 0
    while at < len(text):
        end = at + TEXT_AT_ONCE
        if end < len(text):
            space = _SPACE.search(text, end)
            end = space.start() if space else len(text)
        found = text[at:end].split()
        parts.append(np.fromiter(map(xxh3_64_intdigest, found), U, len(found)))
        at = end
    return np.concatenate(parts) if parts else np.empty(0, U)


def shingles(texts: list[str], words: int) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, bounds): the sorted distinct shingles of text i are hashes[bounds[i]:bounds[i + 1]].

    Words are runs outside ASCII white space of the text with A-Z lower-cased; fewer words than `words` are one shingle.
    """
    found = [word_hashes(x.encode("utf-8", "surrogatepass").lower()) for x in texts]
    counts = np.array([len(x) for x in found], np.int64)
    h = np.concatenate(found) if found else np.empty(0, U)
    del found
    ends = np.cumsum(counts)
    with np.errstate(over="ignore"):
        joined = mix(h + U(0x9E3779B97F4A7C15))
        for i in range(1, words):
            joined[:-i] = mix(joined[:-i] * U(0x9E3779B97F4A7C15) + h[i:]) if len(h) > i else joined[:-i]
        sets = []
        for n, end in zip(counts.tolist(), ends.tolist(), strict=True):
            if n >= words:
                sets.append(np.unique(joined[end - n : end - words + 1]))
            elif n:
                one = U(n)
                for x in h[end - n : end]:
                    one = mix(np.array([one * U(0xD6E8FEB86659FD93) + x]))[0]
                sets.append(np.array([one], U))
            else:
                sets.append(np.empty(0, U))
    return (np.concatenate(sets) if sets else np.empty(0, U)), np.concatenate([[0], np.cumsum([len(x) for x in sets], dtype=np.int64)]).astype(np.int64)


def super_minhash(hashes: np.ndarray, bounds: np.ndarray, size: int) -> np.ndarray:
    """Signatures (documents x size); the value of rank j is j + a uniform fraction, as an integer of 40 bits a rank.

    A register is a minimum over elements, so lots of SHINGLES_AT_ONCE elements may go one after another. Empty sets keep the
    largest value in all registers.
    """
    registers = np.full((len(bounds) - 1, size), _FULL, U)
    doc = np.repeat(np.arange(len(bounds) - 1, dtype=np.int32), np.diff(bounds))
    for at in range(0, len(hashes), SHINGLES_AT_ONCE):
        _lower(registers, doc[at : at + SHINGLES_AT_ONCE], hashes[at : at + SHINGLES_AT_ONCE], size)
    return registers


def _lower(registers: np.ndarray, doc: np.ndarray, element: np.ndarray, size: int) -> None:
    """Lowers the registers of documents by elements, rank by rank; a document whose registers all have a value of a lower rank is done."""
    swap = None
    with np.errstate(over="ignore"):
        for j in range(size):
            if not len(element):
                break
            x = mix(element + U(j + 1) * U(0x9E3779B97F4A7C15))
            k = j + ((x & U(0xFFFFFF)) % U(size - j)).astype(np.int64)
            value = (x >> _VALUE_BITS) | U(j << 40)
            if j:
                row = np.arange(len(element))
                target = swap[row, k].astype(np.int64)
                swap[row, k] = swap[:, j]
            else:
                target = k
            np.minimum.at(registers.reshape(-1), doc.astype(np.int64) * size + target, value)
            left = (registers >= U((j + 1) << 40)).any(axis=1)[doc]
            if not j:
                element, doc, k = element[left], doc[left], k[left]
                swap = np.tile(np.arange(size, dtype=np.uint16 if size > 255 else np.uint8), (len(element), 1))
                swap[np.arange(len(element)), k] = 0
            elif not left.all():
                element, doc, swap = element[left], doc[left], swap[left]


def band_keys(signatures: np.ndarray, rows: int) -> np.ndarray:
    """(documents x bands) keys; the band's number is part of a key."""
    n, size = signatures.shape
    parts = signatures.reshape(n, size // rows, rows)
    with np.errstate(over="ignore"):
        key = np.broadcast_to(np.arange(1, size // rows + 1, dtype=U) * U(0xD6E8FEB86659FD93), (n, size // rows)).copy()
        for i in range(rows):
            key = mix(key * U(0x9E3779B97F4A7C15) + parts[:, :, i])
    return key.view(np.int64)


def _lots(batch: pa.RecordBatch) -> Iterator[tuple[pa.RecordBatch, list[str]]]:
    """Slices of a batch whose last column has about TEXT_AT_ONCE bytes of text."""
    sizes = np.cumsum([len(x) if x else 0 for x in batch.column(batch.num_columns - 1).to_pylist()]) if batch.num_rows else np.empty(0)
    at = 0
    while at < batch.num_rows:
        past = sizes[at - 1] if at else 0
        end = max(at + 1, int(np.searchsorted(sizes, past + TEXT_AT_ONCE, side="right")))
        some = batch.slice(at, end - at)
        yield some, [x or "" for x in some.column(some.num_columns - 1).to_pylist()]
        at = end


def _lists(values: np.ndarray, bounds: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(values.view(np.int64)))


def _digest(hashes: np.ndarray) -> bytes:
    return hashlib.blake2b(hashes.tobytes(), digest_size=16).digest()


def _signed(words: int, bands: int, rows: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        for batch in batches:
            trim()
            for some, texts in _lots(batch):
                hashes, bounds = shingles(texts, words)
                keys = band_keys(super_minhash(hashes, bounds, bands * rows), rows)
                spans = list(zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True))
                yield pa.RecordBatch.from_arrays(
                    [some.column(0), pa.array(np.diff(bounds)), pa.array([_digest(hashes[a:b]) for a, b in spans], pa.binary()), _lists(keys.reshape(-1), np.arange(len(texts) + 1) * bands)],
                    names=["doc_id", "n", "set_id", "keys"],
                )
        trim()

    return run


def _full_sets(words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        for batch in batches:
            for some, texts in _lots(batch):
                hashes, bounds = shingles(texts, words)
                ids = [_digest(hashes[a:b]) for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays([pa.array(ids, pa.binary()), _lists(hashes, bounds)], names=["set_id", "shingles"])

    return run


def _block_links(percent: int):
    def run(block: pd.DataFrame) -> pd.DataFrame:
        """Links between members of different labels; a pair whose labels have met in this block is skipped."""
        block = block.loc[block["shingles"].map(len).sort_values(kind="stable").index]
        sets, ids, labels, sides = list(block["shingles"]), list(block["set_id"]), list(block["label"]), list(block["side"])
        sizes = np.array([len(x) for x in sets])
        starts = np.cumsum(sizes) - sizes
        known, at = np.unique(np.concatenate(sets), return_inverse=True)
        has = np.zeros(len(known), bool)
        across = block["kind"].iat[0] == 0
        up: dict = {}

        def root(x):
            while up.get(x, x) != x:
                x = up[x]
            return x

        found = []
        for i in range(1, len(sets)):
            first = int(np.searchsorted(100 * sizes[:i], percent * sizes[i]))
            if first == i:
                continue
            mine = at[starts[i] : starts[i] + sizes[i]]
            has[mine] = True
            common = np.add.reduceat(has[at[starts[first] : starts[i]]].astype(np.int64), starts[first:i] - starts[first])
            has[mine] = False
            for j in np.flatnonzero(100 * common >= percent * (sizes[i] + sizes[first:i] - common)) + first:
                if labels[i] != labels[j] and not (across and sides[i] == sides[j]) and root(labels[i]) != root(labels[j]):
                    found.append((ids[i], ids[j]))
                    up[root(labels[i])] = root(labels[j])
        return pd.DataFrame(found, columns=["a", "b"])

    return run


def _measured(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b) with the sizes of their full sets' intersection and union."""
    left = pairs.join(sets.select(F.col("set_id").alias("a"), F.col("shingles").alias("_x")), "a")
    both = left.join(sets.select(F.col("set_id").alias("b"), F.col("shingles").alias("_y")), "b")
    found = both.select("a", "b", F.size(F.array_intersect("_x", "_y")).alias("common"), (F.size("_x") + F.size("_y")).alias("_sum"))
    return found.select("a", "b", "common", (F.col("_sum") - F.col("common")).alias("either"))


def _torn(windows: DataFrame, labels: DataFrame, put: Scratch) -> DataFrame:
    """(key, set_id, label) of the windows (key, set_id) that labels (node, root) still part; the same members in several bands: once."""
    part = windows.join(labels, F.col("set_id") == F.col("node"), "left").select("key", "set_id", F.coalesce("root", "set_id").alias("label"))
    torn = part.groupBy("key").agg(F.min("label").alias("_lo"), F.max("label").alias("_hi"), F.sum(F.xxhash64("set_id").cast("decimal(20,0)")).alias("_seal"), F.count("*").alias("_n")).where(F.col("_lo") < F.col("_hi"))
    once = torn.groupBy("_seal", "_n").agg(F.min("key").alias("key")).select("key")
    return put(part.join(put(once, "once"), "key"), "torn")


def _windows(members: DataFrame, measured: DataFrame, percent: int) -> DataFrame:
    """(key, set_id): members (key, set_id, hub) but the hub, twice each, in windows of the threshold's distance from the hub."""
    part = members.join(measured, (F.col("set_id") == F.col("a")) & (F.col("hub") == F.col("b")))
    wide = 100 - percent  # a window's width, as hundredths of the distance (either - common) / either
    window = F.floor((F.col("either") - F.col("common")) * 100 / (F.col("either") * wide)) if wide else F.lit(0)
    return part.select("key", "set_id", F.explode(F.array(window, window - 1)).alias("_window")).select(F.xxhash64("key", "_window").alias("key"), "set_id")


def _linkable(windows: DataFrame, torn: DataFrame, sets: DataFrame, percent: int, put: Scratch) -> DataFrame:
    """The windows' rows whose sets can be similar enough to another in the torn ones: x shares at most its shingles that others have."""
    there = sets.join(put(torn.select("set_id").distinct(), "there"), "set_id")
    shared = there.select("set_id", F.explode("shingles").alias("_x")).groupBy("_x").agg(F.count("*").alias("_n"), F.min("set_id").alias("set_id"))
    alone = shared.where("_n = 1").groupBy("set_id").agg(F.count("*").alias("_alone"))
    sizes = there.select("set_id", F.size("shingles").alias("_size")).join(alone, "set_id", "left")
    able = put(sizes.where(100 * (F.col("_size") - F.coalesce("_alone", F.lit(0))) >= percent * F.col("_size")).select("set_id"), "able")
    return put(windows.join(able, "set_id", "left_semi"), "windows")


def _hub_pairs(torn: DataFrame, turn: int, put: Scratch) -> DataFrame:
    """(a, b): each member with one of its window's, where their labels differ."""
    member = F.struct(F.xxhash64("set_id", "key", F.lit(turn)).alias("_rank"), "set_id", "label")
    hubs = put(torn.groupBy("key").agg(F.min(member).alias("_hub")).select("key", F.col("_hub.set_id").alias("b"), F.col("_hub.label").alias("_label")), "hubs")
    return torn.join(hubs, "key").where(F.col("label") != F.col("_label")).select(F.col("set_id").alias("a"), "b").distinct()


def _block_pairs(part: DataFrame, sets: DataFrame, percent: int, put: Scratch) -> DataFrame:
    """Links between members (key, set_id, label) of one key with different labels."""
    sizes = part.groupBy("key", "label").agg(F.count("*").alias("_c"))
    whole = put(sizes.groupBy("key").agg(F.max(F.struct("_c", "label")).alias("_most"), F.sum("_c").alias("_all")).select("key", F.col("_most.label").alias("_main"), F.ceil(F.col("_most._c") / BLOCK).alias("_bm"), F.ceil((F.col("_all") - F.col("_most._c")) / BLOCK).alias("_bo")), "buckets")
    dealt = part.join(whole, "key").withColumn("side", (F.col("label") != F.col("_main")).cast("int"))
    dealt = dealt.withColumn("_i", F.pmod(F.xxhash64("set_id"), F.when(F.col("side") == 0, F.col("_bm")).otherwise(F.col("_bo"))))
    upto = lambda n: F.sequence(F.lit(0).cast("long"), n - 1)
    block = lambda kind, i, j: F.struct(F.lit(kind).alias("kind"), i.cast("long").alias("i"), j.cast("long").alias("j"))
    i = F.col("_i")
    main = F.transform(upto(F.col("_bo")), lambda j: block(0, i, j))
    other = F.concat(F.transform(upto(F.col("_bm")), lambda j: block(0, j, i)), F.transform(upto(F.col("_bo")), lambda j: block(1, F.least(i, j), F.greatest(i, j))))
    dealt = dealt.withColumn("_block", F.explode(F.when(F.col("side") == 0, main).otherwise(other))).select("key", "set_id", "label", "side", "_block.kind", "_block.i", "_block.j")
    return dealt.join(sets, "set_id").groupBy("key", "kind", "i", "j").applyInPandas(_block_links(percent), "a binary, b binary")


def near_dedup(docs: DataFrame, words: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each input row: the id, n_shingles, component_id, kept.

    Documents are linked where 100 * |intersection| >= percent * |union| of their sets of distinct `words`-word shingles; a
    component holds what links reach, and its smallest id stays. Null, empty and blank texts have no shingles, are linked with
    nothing and stay. Rows that repeat an id say the same, as they are one document. A null id is smaller than
    none: it is a component's id only where no other is there. An empty table gives no rows; other columns are ignored.
    """
    small_batches(docs.sparkSession)
    bands = bands_for(percent)
    source = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    kind = source.schema["doc_id"].dataType.simpleString()
    signed = written(source.mapInArrow(_signed(words, bands, ROWS), f"doc_id {kind}, n long, set_id binary, keys array<long>"), "signed")
    classes = written(signed.where("n > 0").groupBy("set_id").agg(F.min("doc_id").alias("first_id"), F.min("n").alias("n"), F.min("keys").alias("keys")), "classes")

    put = Scratch()
    members = classes.select("set_id", F.explode("keys").alias("key"))
    member = F.struct(F.xxhash64("set_id", "key").alias("_rank"), "set_id")
    hubs = members.groupBy("key").agg(F.min(member).alias("_hub"), F.max(member).alias("_last")).where(F.col("_hub") < F.col("_last"))
    members = put(members.join(put(hubs.select("key", F.col("_hub.set_id").alias("hub")), "hubs"), "key"), "members")

    pairs = put(members.where(F.col("set_id") != F.col("hub")).select(F.col("set_id").alias("a"), F.col("hub").alias("b")).distinct(), "pairs")
    wanted = put(members.select("set_id").distinct().join(classes.select("set_id", "first_id"), "set_id").select("first_id").distinct(), "wanted")
    few = wanted.count() <= BROADCAST_IDS
    chosen = source.join(F.broadcast(wanted) if few else wanted, F.col("doc_id").eqNullSafe(F.col("first_id")), "left_semi")
    sets = put(chosen.select("text").mapInArrow(_full_sets(words), "set_id binary, shingles array<long>").dropDuplicates(["set_id"]), "sets")

    similar = lambda found: found.where(100 * F.col("common") >= percent * F.col("either")).select("a", "b")
    measured = put(_measured(pairs, sets), "measured")
    links = similar(measured)
    labels = components(links)
    windows = put(_windows(members, measured, percent), "windows")
    torn = _torn(windows, labels, put)
    if not torn.isEmpty():
        windows = _linkable(windows, torn, sets, percent, put)
    for turn in range(HUBS + 1):
        torn = _torn(windows, labels, put)
        if torn.isEmpty():
            break
        more = put(similar(_measured(_hub_pairs(torn, turn, put), sets)) if turn < HUBS else _block_pairs(torn, sets, percent, put), "more")
        if not more.isEmpty():
            links, old = links.union(more), labels
            labels = components(links)
            remove(old)

    named = classes.select("set_id", "first_id").join(labels, F.col("set_id") == F.col("node"), "left").select("set_id", "first_id", F.coalesce("root", "set_id").alias("label"))
    smallest = written(named.groupBy("label").agg(F.min("first_id").alias("component_id")), "smallest")
    named = written(named.join(smallest, "label").select("set_id", "component_id"), "named")
    put.clear()
    for df in (classes, labels, smallest):
        remove(df)
    whole = signed.select("doc_id", "n", F.when(F.col("n") > 0, F.col("set_id")).alias("set_id")).join(named, "set_id", "left")
    component = F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
    return whole.select(F.col("doc_id").alias(id_col), F.col("n").alias("n_shingles"), component.alias("component_id"), F.col("doc_id").eqNullSafe(component).alias("kept"))


def keep_one(docs: DataFrame, words: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of docs that stay, all their columns: of each component the smallest id's, and rows without shingles.

    Rows with one id and different texts are told apart, by a hash of the text; rows that repeat both stay or go together.
    """
    mark = F.struct(F.col(id_col).alias("id"), F.xxhash64(F.col(text_col)).alias("text"))
    found = near_dedup(docs.select(mark.alias("id"), F.col(text_col).alias("text")), words, percent, "id", "text")
    gone = written(found.where(~F.col("kept")).select(F.col("id").alias("_gone")).distinct(), "gone")
    few = gone.count() <= BROADCAST_IDS
    return docs.join(F.broadcast(gone) if few else gone, mark.eqNullSafe(F.col("_gone")), "left_anti")
