"""The stages against brute force, each on its own input."""

import os

import public_tokenizers
import pytest
from corpus import EDGES, docs, edited, prose
from test_near_dedup import brute as near_brute
from test_packing import check
from tokenizers import Tokenizer

import corpus_pipeline as pipeline
from eventlake.llm import registry


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """A corpus of toxic documents, copies, near copies and others, and labels for some."""
    at = str(tmp_path_factory.mktemp("corpus"))
    rows, labels = [], []
    for i in range(120):
        toxic = i % 6 == 0
        rows.append((i, prose(i, 60) + (" you moron, worthless idiot and pathetic scum " if toxic else "")))
        if i % 2 == 0:
            labels.append((i, 1, int(toxic)))
    rows += [(1000 + i, prose(i, 60)) for i in range(1, 30, 2) if i % 6]
    rows += [(2000 + i, edited(prose(i, 60), 59, i)) for i in range(1, 30, 4) if i % 6]
    rows += [r for r in EDGES if r[0] != 7]
    docs(spark, rows, clash=False).write.parquet(f"{at}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{at}/labels.parquet")
    return at


def pairs(df):
    return sorted(((r.doc_id, r.text) for r in df.collect()), key=repr)


def test_stages(spark, folder):
    now = spark.read.parquet(f"{folder}/documents.parquet")
    names = [n for n, _ in pipeline.STAGES]
    assert names == ["toxicity", "exact_dedup", "near_dedup", "packing"]
    before, columns = pairs(now), now.columns
    for name, stage in pipeline.STAGES[:-1]:
        now = pipeline.written(stage(spark, now, folder), name)
        assert now.columns == columns
        after = pairs(now)
        if name == "toxicity":
            assert after == [r for r in before if "moron" not in (r[1] or "")]
        elif name == "exact_dedup":
            texts = {t or "" for _, t in before}
            assert sorted(((i, t or "") for i, t in after), key=repr) == sorted(((max((i for i, u in before if (u or "") == t and i is not None), default=None), t) for t in texts), key=repr)
        else:
            kept = [b for b in near_brute(before, 5, 80) if b[3]]
            assert sorted((str(i) for i, _ in after)) == sorted(str(b[0]) for b in kept)
        before = after
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    found = pipeline.STAGES[-1][1](spark, now, folder).collect()
    check(before, found, tokenizer, 4096)
    whole = pipeline.run(spark, folder).collect()
    assert sorted((r.doc_id or -1, r.piece, r.length, r.ids_crc32) for r in whole) == sorted((r.doc_id or -1, r.piece, r.length, r.ids_crc32) for r in found)


def test_each_operator_has_one_query():
    assert sorted(int(n[2:].split("_")[0]) for n in registry.queries()) == list(range(1, 11))
    assert set(registry.oracle_sql()) <= set(registry.queries())


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.001"), reason="no test data")
@pytest.mark.parametrize("name", registry.queries())
def test_queries_run_over_their_tables(spark, name):
    sf = "/root/testdata/sf0.001"
    table = "pages" if name.startswith(("op6", "op8")) else "documents"
    n = registry.queries()[name](spark, sf).count()
    rows = spark.read.parquet(f"{sf}/{table}.parquet").count()
    assert n >= rows if name.startswith("op7") else n == rows
