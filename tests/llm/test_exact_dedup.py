import os
import hashlib
from collections import defaultdict

from corpus import EDGES, by_id, docs, prose

from eventlake.llm import exact_dedup


def brute(rows):
    groups = defaultdict(list)
    for i, t in rows:
        groups[t or ""].append(i)
    keep = {t: max((i for i in ids if i is not None), default=None) for t, ids in groups.items()}
    return sorted(((i, keep[t or ""], len(groups[t or ""]), i == keep[t or ""], hashlib.sha256((t or "").encode()).hexdigest()) for i, t in rows), key=repr)


NAMES = ("doc_id", "keep_id", "group_size", "kept", "text_sha256")


def test_groups(spark):
    rows = [(i, prose(i % 7, 5) if i % 3 else "hot") for i in range(200)] + EDGES
    for parts in (1, 13):
        assert by_id(exact_dedup.exact_dedup(docs(spark, rows).repartition(parts), salts=3), *NAMES) == brute(rows)


def test_empty(spark):
    assert exact_dedup.exact_dedup(docs(spark, [])).count() == 0
    assert exact_dedup.keep_one(docs(spark, [])).count() == 0


def test_rows_that_stay(spark):
    rows = [(i, prose(i % 7, 5)) for i in range(40)] + EDGES
    df = docs(spark, rows)
    out = exact_dedup.keep_one(df)
    assert out.columns == df.columns
    assert out.dtypes == df.dtypes
    got = out.collect()
    assert len(got) == len({t or "" for _, t in rows})
    assert {(r.doc_id, r.text or "") for r in got} == {(max((i for i, u in rows if (u or "") == t and i is not None), default=None), t) for t in {t or "" for _, t in rows}}


def test_batches_are_bounded_and_smaller_bounds_stay(spark):
    from eventlake.llm import common

    own, key = spark.newSession(), "spark.sql.execution.arrow.maxBytesPerBatch"
    common.small_batches(own)
    assert own.conf.get(key) == str(common.BATCH_BYTES)
    own.conf.set(key, "1000")
    common.small_batches(own)
    assert own.conf.get(key) == "1000"


def test_tables_of_a_stage_can_be_cleared(spark):
    from eventlake.llm import common

    with common.tables_made() as made:
        one = common.written(spark.range(3), "one")
        common.written(one.selectExpr("id + 1 AS id"), "two")
    common.written(spark.range(1), "three")
    assert [df.count() for df in made] == [3, 3]
    common.remove(made[0])
    assert not os.path.exists(made[0].inputFiles()[0].removeprefix("file:"))
    common.remove(made[0])  # again: nothing
