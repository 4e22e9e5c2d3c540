"""Document fingerprints: a Merkle tree over paragraphs and sections, with column expressions alone.

Paragraphs are lines. A section ends with a paragraph whose digest says so, one in SECTION on average, so a line that is put
in or taken out changes its own section alone. A paragraph's digest is the SHA-256 of its text, a section's that of its paragraphs'
digests, and the root that of the sections'. Equal roots mean equal texts. Where roots differ, the sections are compared from
either end, then the paragraphs of the branch that differs, which locates the edit. Inside the paragraphs that differ, the
leaves are compared: pieces of PIECE characters, cut anew after each sentence, smaller ones at a paragraph's start.

A fingerprint is the root and a sketch of the leaves, so its length is bounded however long the text is.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

#: Paragraphs in a section, on average; characters of a leaf; the smallest leaves that a fingerprint holds.
SECTION, PIECE, SKETCH = 8, 8, 64
#: Ranges of ids within which a document meets its neighbour: one for so many documents, and so many at most.
DOCS_IN_RANGE, RANGES = 256, 10_000

#: A paragraph's first leaves have so many characters, so short texts have several leaves too.
STARTS = (1, 1, 2, 4)
_LEAVES = rf"[^.!?]{{1,{PIECE}}}[.!?]{{0,7}}|[.!?]{{1,7}}"
#: The low bits of a leaf's hash are its length, its weight.
_LENGTH = 15


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """use(value), with the value made once: as a lambda's argument it is no expression that could be repeated."""
    return F.get(F.transform(F.array(value), use), 0)


def paragraphs(text: Column) -> Column:
    """Digest of each line, in order."""
    return F.transform(F.split(text, "\n"), lambda p: F.sha2(p, 256))


def sections(digests: Column) -> Column:
    """(digest, start: its first paragraph, from 0) of each section, in order."""
    ends = F.filter(F.transform(digests, lambda d, i: F.when((F.conv(F.substring(d, 1, 4), 16, 10).cast("int") % SECTION == 0) | (i == F.size(digests) - 1), i)), lambda i: i.isNotNull())

    def cut(ends: Column) -> Column:
        first = lambda k: F.coalesce(F.get(ends, k - 1) + 1, F.lit(0))
        return F.transform(ends, lambda e, k: F.struct(F.sha2(F.array_join(F.slice(digests, first(k) + 1, e - first(k) + 1), "/"), 256).alias("digest"), first(k).alias("start")))

    return _let(ends, cut)


def root(found: Column) -> Column:
    """Digest of the sections' digests."""
    return F.sha2(F.array_join(F.transform(found, lambda s: s["digest"]), "/"), 256)


def leaves(text: Column) -> Column:
    """For each line, the hashes of its leaves; none for an empty line."""
    marked = lambda x: F.xxhash64(x).bitwiseAND(F.lit(~_LENGTH)).bitwiseOR(F.length(x).cast("long"))
    first = lambda p: F.filter(F.array(*[F.substring(p, 1 + sum(STARTS[:i]), n) for i, n in enumerate(STARTS)]), lambda x: x != "")
    rest = lambda p: F.regexp_extract_all(F.substr(p, F.lit(1 + sum(STARTS))), F.lit(_LEAVES), F.lit(0))
    return F.transform(F.split(text, "\n"), lambda p: F.transform(F.concat(first(p), rest(p)), marked))


def _sum(values: Column) -> Column:
    return F.aggregate(values, F.lit(0).cast("long"), lambda total, x: total + x)


def _shared(a: Column, b: Column) -> Column:
    """Characters of the leaves that two arrays have in common, each as often as in both: equal ones lie side by side when sorted."""
    both = F.sort_array(F.concat(F.transform(a, lambda x: F.shiftleft(x, 1)), F.transform(b, lambda x: F.shiftleft(x, 1).bitwiseOR(F.lit(1)))))

    def summed(x: Column) -> Column:
        end = lambda k: F.coalesce(F.get(x["starts"], k), F.size(x["all"]))

        def pair(s: Column, k: Column) -> Column:
            own = F.get(x["all"], s)
            mate = F.get(x["all"], end(k + 1)) == own.bitwiseOR(F.lit(1))
            return F.when((own % 2 == 0) & mate, F.least(end(k + 1) - s, end(k + 2) - end(k + 1)) * F.shiftright(own, 1).bitwiseAND(F.lit(_LENGTH))).otherwise(0).cast("long")

        return _sum(F.transform(x["starts"], pair))

    first = lambda c: F.filter(F.transform(c, lambda x, i: F.when((i == 0) | (x != F.get(c, i - 1)), i)), lambda i: i.isNotNull())
    return _let(both, lambda c: _let(F.struct(c.alias("all"), first(c).alias("starts")), summed))


def node(text: Column) -> Column:
    """A text's tree: root, sections, paragraphs, lengths (of paragraphs), leaves (of each paragraph)."""
    lengths = F.transform(F.split(text, "\n"), F.length)
    return _let(
        paragraphs(text),
        lambda p: _let(sections(p), lambda s: F.struct(root(s).alias("root"), s.alias("sections"), p.alias("paragraphs"), lengths.alias("lengths"), leaves(text).alias("leaves"))),
    )


def _same(a: Column, b: Column) -> Column:
    """How many items two arrays have in common at their starts."""
    differs = F.array_position(F.zip_with(a, b, lambda x, y: x.eqNullSafe(y)), False)
    return F.when(differs == 0, F.least(F.size(a), F.size(b))).otherwise(differs.cast("int") - 1)


def edit(a: Column, b: Column) -> Column:
    """struct<head, tail>: paragraphs at the start and at the end that two trees share, never more than the shorter one has.

    Sections that are equal from either end are passed over by their digests; paragraphs are compared in the next branch alone.
    """
    digests = lambda t: F.transform(t["sections"], lambda s: s["digest"])
    count = lambda t: F.size(t["paragraphs"])
    starts = lambda t, k: F.coalesce(F.get(t["sections"], k)["start"], count(t))

    def ahead(k: Column) -> Column:
        branch = lambda t: F.slice(t["paragraphs"], starts(t, k) + 1, starts(t, k + 1) - starts(t, k))
        return F.least(starts(a, k), starts(b, k)) + _same(branch(a), branch(b))

    def behind(k: Column) -> Column:
        stop = lambda t: starts(t, F.size(t["sections"]) - k)
        begin = lambda t: F.coalesce(F.get(t["sections"], F.size(t["sections"]) - k - 1)["start"], F.lit(0))
        branch = lambda t: F.reverse(F.slice(t["paragraphs"], begin(t) + 1, stop(t) - begin(t)))
        return count(a) - stop(a) + _same(branch(a), branch(b))

    head = _let(_same(digests(a), digests(b)), ahead)
    tail = _let(_same(F.reverse(digests(a)), F.reverse(digests(b))), behind)
    return _let(head, lambda h: F.struct(h.alias("head"), F.least(tail, count(a) - h, count(b) - h).alias("tail")))


def likeness(a: Column, b: Column, at: Column) -> Column:
    """Share of two trees' characters that equal branches and equal leaves of the others hold, 0 to 1; `at` is edit(a, b).

    1 for equal texts alone: what holds the same leaves in another order has a little less. Two empty texts are alike.
    """
    own = lambda t: F.flatten(F.slice(t["leaves"], at["head"] + 1, F.size(t["leaves"]) - at["head"] - at["tail"]))
    common = _sum(F.slice(a["lengths"], F.lit(1), at["head"])) + _sum(F.slice(a["lengths"], F.size(a["lengths"]) - at["tail"] + 1, at["tail"]))
    total = _sum(a["lengths"]) + _sum(b["lengths"])
    part = lambda n: F.when(n == 0, 0.0).otherwise(F.least(2.0 * (common + _shared(own(a), own(b))) / n, 1 - 1 / (n + 1.0)))
    return F.when(a["root"] == b["root"], 1.0).otherwise(_let(total, part))


def fingerprint(tree_: Column) -> Column:
    """The root, a colon, and the SKETCH smallest distinct leaves as hexadecimal numbers, joined by dots."""
    least = F.slice(F.sort_array(F.array_distinct(F.flatten(tree_["leaves"]))), 1, SKETCH)
    return F.concat_ws(":", tree_["root"], F.array_join(F.transform(least, F.hex), "."))


def tree(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each input row: the id, n_chars, fingerprint, root, sections, paragraphs. Null text counts as empty."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    found = docs.select(F.col(id_col).alias("doc_id"), F.length(text).cast("long").alias("n_chars"), _let(node(text), lambda t: F.struct(fingerprint(t).alias("mark"), t.alias("tree"))).alias("_t"))
    return found.select(F.col("doc_id").alias(id_col), "n_chars", F.col("_t.mark").alias("fingerprint"), "_t.tree.root", "_t.tree.sections", "_t.tree.paragraphs")


def _range_of(column: Column, bounds: list[int]) -> Column:
    """How many bounds are smaller than the id; two looks of about the square root of their number."""
    if not bounds:
        return F.lit(0)
    width = max(1, round(len(bounds) ** 0.5))
    lots = [bounds[i : i + width] for i in range(0, len(bounds), width)]
    count = lambda values: F.size(F.filter(values, lambda x: x < column))
    heads = F.array(*[F.lit(x[-1]) for x in lots])
    lot = count(heads)
    inner = F.coalesce(F.get(F.array(*[F.array(*[F.lit(y) for y in x]) for x in lots]), lot), F.array().cast("array<bigint>"))
    return F.when(column.isNull(), 0).otherwise(lot * width + count(inner))


def with_next(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text, next): next is the text of the next smaller id; the smallest one's is the largest id's.

    Ids are cut into ranges of about equal counts, and each range also gets the first row of the next one, so no task sorts
    more than a range. Rows that repeat an id follow each other by text; null ids come last.
    """
    if not isinstance(docs.schema[id_col].dataType, IntegralType):
        raise TypeError(f"{id_col} holds no whole numbers")
    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    n = rows.select(F.count("*")).first()[0]
    ranges = max(1, min(RANGES, n // DOCS_IN_RANGE))
    bounds = []
    if ranges > 1:
        found = rows.select(F.percentile_approx("doc_id", [i / ranges for i in range(1, ranges)], max(10_000, 5 * ranges))).first()[0]
        bounds = sorted(set(found or []))
    rows = rows.withColumn("_range", _range_of(F.col("doc_id"), bounds))
    heads = sorted((r["_range"], r["_head"]) for r in rows.groupBy("_range").agg(F.max("doc_id").alias("_head")).collect())[::-1]  # RANGES rows at most
    if not heads:
        return rows.select("doc_id", "text", F.col("text").alias("next"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    guests = docs.sparkSession.createDataFrame([(heads[(i + 1) % len(heads)][1], r) for i, (r, _) in enumerate(heads)], f"_head {kind}, _to int")
    extra = rows.join(F.broadcast(guests), F.col("doc_id").eqNullSafe(F.col("_head"))).select("doc_id", "text", F.col("_to").alias("_range"), F.lit(1).alias("_extra"))
    order = Window.partitionBy("_range").orderBy("_extra", F.col("doc_id").desc_nulls_last(), F.col("text").desc())
    whole = rows.select("doc_id", "text", F.col("_range").cast("int").alias("_range"), F.lit(0).alias("_extra")).union(extra)
    return whole.withColumn("next", F.lead("text").over(order)).where("_extra = 0").select("doc_id", "text", "next")


def compare_edited(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each input row: the id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next, edit_first, edit_last.

    The edited text has the last floor(n_chars / 2) code points replaced by the first as many (or all) of the next document,
    by descending id. Null text counts as empty; equal texts, repeated rows among them, have equal fingerprints.
    edit_first and edit_last are the first and last paragraph (from 0) that the edit touches, as the trees tell; null where it changes
    nothing, and edit_last one less than edit_first where it only adds. A lone row is its own next document. An empty table gives no
    rows; other columns are ignored. Ids are whole numbers; a table with others is refused.
    """
    pairs = with_next(docs, id_col, text_col)
    half = F.floor(F.length("text") / 2).cast("int")
    both = pairs.select("doc_id", "text", "next", F.concat(F.expr("left(text, length(text) - cast(floor(length(text) / 2) as int))"), F.substring(F.col("next"), F.lit(1), half)).alias("edited"))

    def compared(own: Column, edited: Column, next_: Column, at: Column) -> Column:
        changed = own["root"] != edited["root"]
        return F.struct(
            fingerprint(own).alias("fingerprint"),
            fingerprint(edited).alias("edited_fingerprint"),
            likeness(own, edited, at).alias("near_edited"),
            _let(edit(own, next_), lambda x: likeness(own, next_, x)).alias("near_next"),
            F.when(changed, at["head"]).alias("edit_first"),
            F.when(changed, F.size(own["paragraphs"]) - at["tail"] - 1).alias("edit_last"),
        )

    trees = F.struct(*[node(F.col(c)).alias(c) for c in ("text", "edited", "next")])
    found = _let(trees, lambda t: _let(edit(t["text"], t["edited"]), lambda at: compared(t["text"], t["edited"], t["next"], at)))
    rows = both.select("doc_id", F.length("text").cast("long").alias("n_chars"), F.sha2("edited", 256).alias("edited_sha256"), found.alias("_f"))
    return rows.select(F.col("doc_id").alias(id_col), "n_chars", "edited_sha256", "_f.*")
