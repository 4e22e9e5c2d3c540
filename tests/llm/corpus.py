"""Small corpora with the cases that every operator has to take."""

import random

from pyspark.sql import functions as F

#: Names that operators use for columns of their own.
CLASHES = "keep_id group_size kept text_sha256 set_id n key row word c label score rank piece length start hub a b u v _id _text _salt _row doc component_id".split()

WORDS = "the of and river stone cloud market window letter garden paper winter silver morning engine travel number".split()


def prose(seed, n):
    rng = random.Random(seed)
    return " ".join(rng.choice(WORDS) + (rng.choice(".,") if rng.random() < 0.15 else "") + str(rng.randint(0, 50)) for _ in range(n))


def edited(text, every, seed=0):
    words = text.split(" ")
    for i in range(seed % every, len(words), every):
        words[i] = f"x{i}{seed}"
    return " ".join(words)


def docs(spark, rows, clash=True):
    """rows: (doc_id, text). With columns of clashing names."""
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"lang": F.lit("en"), "source": F.lit(None).cast("string"), "n_chars": F.length("text").cast("long")})
    return df.withColumns({c: F.lit("clash") for c in CLASHES}) if clash else df


EDGES = [(1, None), (2, ""), (3, " \n\t "), (4, "one"), (5, "one"), (5, "one"), (None, "one"), (None, None), (6, "é ﬁ 😀 \x00 日本"), (7, "word " * 30_000), (8, "x" * 50_000)]


def by_id(df, *names):
    """All rows as sorted tuples, so that repeated rows count."""
    return sorted((tuple(r[n] for n in names) for r in df.collect()), key=repr)
