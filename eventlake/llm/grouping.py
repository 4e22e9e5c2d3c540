"""Connected components of a link table that no machine needs to hold.

Each partition first contracts its own links by union-find, which leaves stars. If what is left is no more than one
union-find holds, one more ends it. Else alternating large-star and small-star steps hook every node to the smallest
node near it until nothing changes. Minima are aggregated before the shuffle and joined from written tables, so a hub
with a third of all links is split by adaptive execution.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import remove, written

#: Links that one union-find holds at once.
LINKS_AT_ONCE = 200_000


def _find(parent: dict, x):
    root = x
    while (up := parent.get(root, root)) != root:
        root = up
    while (up := parent.get(x, x)) != root:
        parent[x] = root
        x = up
    return root


def _contract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links (u, v) -> (node, root) of this partition's forest, with u > v."""
    parent: dict = {}
    kind = None

    def stars():
        pairs = [(x, _find(parent, x)) for x in parent]
        pairs = [(x, r) for x, r in pairs if x != r]
        return pa.RecordBatch.from_arrays([pa.array([p[i] for p in pairs], kind) for i in (0, 1)], names=["u", "v"])

    for batch in batches:
        kind = batch.schema.field(0).type
        for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            a, b = _find(parent, a), _find(parent, b)
            if a != b:
                parent[max(a, b)] = min(a, b)
        if len(parent) > LINKS_AT_ONCE:
            yield stars()
            parent.clear()
    if parent:
        yield stars()


def components(links: DataFrame) -> DataFrame:
    """links (a, b) of one orderable type -> written table (node, root): root is the smallest node that can be reached.

    Nodes that have no link, and roots themselves, have no row. Links may repeat, point either way or at themselves.
    Links with a null end are ignored. No links give an empty table.
    """
    kind = links.schema["a"].dataType.simpleString()
    contracted = lambda df: df.mapInArrow(_contract, f"u {kind}, v {kind}")
    now = written(contracted(links.where(F.col("a") != F.col("b")).select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))).distinct(), "links")
    seal = lambda df: tuple(df.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first())
    before = seal(now)
    if 0 < before[0] <= LINKS_AT_ONCE:
        old, now = now, written(contracted(now.coalesce(1)), "links")
        remove(old)
        before = (0,)
    while before[0]:
        both = now.union(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = written(both.groupBy("u").agg(F.least("u", F.min("v")).alias("m")), "least")
        large = written(both.where(F.col("v") > F.col("u")).join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct(), "large")
        small = written(large.groupBy("u").agg(F.min("v").alias("m")), "small")
        hooked = large.join(small, "u").where(F.col("v") != F.col("m")).select(F.col("v").alias("u"), F.col("m").alias("v"))
        new = written(hooked.union(small.select("u", F.col("m").alias("v"))).distinct(), "links")
        after = seal(new)
        for old in (now, least, large, small):
            remove(old)
        now = new
        if after == before:
            break
        before = after
    return now.select(F.col("u").alias("node"), F.col("v").alias("root"))
