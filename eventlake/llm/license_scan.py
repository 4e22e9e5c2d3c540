"""License scans: ordered signature rules behind a keyword prefilter, with column expressions alone.

A text without any gate word is passed over by plain substring search. In the others, each rule whose keyword occurs is run,
and every match becomes a span. Spans inside one of at least their own priority are dropped; what stays gives the labels.
The base phrases are rules of the lowest priority whose spans also say at which word they start.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .license_rules import PHRASE, SCORES, WORD, Rule, gates, rules

_SPAN = "array<struct<start:int,end:int,word:int,rule:int,label:string,priority:int>>"


def _table(known: list[Rule]) -> Column:
    return F.array(*[F.struct(F.lit(i).alias("rule"), F.lit(r.keyword).alias("keyword"), F.lit(r.pattern).alias("pattern"), F.lit(r.label).alias("label"), F.lit(r.priority).alias("priority")) for i, r in enumerate(known)])


def _words(text: Column) -> Column:
    return F.regexp_count(text, F.lit(f"{WORD}+"))


#: Items that one inner fold takes; appending to an array copies it, so one long fold would take quadratic time.
LOT = 256


def _fold(items: Column, state: dict[str, Column], step) -> Column:
    """step(acc, item) -> {state..., "out": spans to add}, over all items; what the steps add, in order."""
    names = [*state, "out"]
    none = F.array().cast(_SPAN)

    def inner(acc: Column, item: Column) -> Column:
        new = step(acc, item)
        return F.struct(*[(F.concat(acc["out"], new["out"]) if n == "out" else new[n]).alias(n) for n in names])

    def whole(known: Column) -> Column:
        def outer(lots: Column, i: Column) -> Column:
            last = F.element_at(lots, -1)
            return F.concat(lots, F.array(F.aggregate(F.slice(known, i * LOT + 1, LOT), F.struct(*[last[n].alias(n) for n in state], none.alias("out")), inner)))

        begin = F.array(F.struct(*[v.alias(n) for n, v in state.items()], none.alias("out")))
        count = F.ceil(F.size(known) / LOT).cast("int")
        lots = F.when(count > 0, F.sequence(F.lit(0), count - 1)).otherwise(F.array().cast("array<int>"))
        return F.flatten(F.transform(F.aggregate(lots, begin, outer), lambda x: x["out"]))

    return F.get(F.transform(F.array(items), whole), 0)  # as a lambda's argument, items are made once


def _spans(text: Column, rule: Column) -> Column:
    """Matches of one rule: what stands between them, and they themselves, add up to their places."""
    found, between = F.regexp_extract_all(text, rule["pattern"], F.lit(0)), F.split(text, rule["pattern"], -1)
    parts = F.zip_with(between, found, lambda gap, hit: F.struct(F.length(gap).alias("skip"), _words(gap).alias("words"), F.length(hit).alias("long"), _words(hit).alias("own")))

    def step(acc: Column, part: Column) -> dict[str, Column]:
        start, word = acc["at"] + part["skip"], acc["word"] + part["words"]
        end = start + part["long"]
        span = F.struct(start.alias("start"), end.alias("end"), word.alias("word"), rule["rule"].alias("rule"), rule["label"].alias("label"), rule["priority"].alias("priority"))
        return {"at": end, "word": word + part["own"], "out": F.array(span)}

    return _fold(F.filter(parts, lambda p: p["long"].isNotNull()), {"at": F.lit(0), "word": F.lit(0)}, step)


def _kept(spans: Column, levels: int) -> Column:
    """Drops spans inside one of at least their priority. In order of start, and the longer first, only what went before can hold a span."""
    order = F.array_sort(F.transform(spans, lambda s: F.struct(s["start"].alias("a"), (-s["end"]).alias("b"), (-s["priority"]).alias("c"), s["rule"].alias("d"), s.alias("s"))))

    def step(acc: Column, x: Column) -> dict[str, Column]:
        s = x["s"]
        ends = F.transform(acc["ends"], lambda e, i: F.when(i <= s["priority"], F.greatest(e, s["end"])).otherwise(e))
        return {"ends": ends, "out": F.when(F.get(acc["ends"], s["priority"]) >= s["end"], F.array().cast(_SPAN)).otherwise(F.array(s))}

    return _fold(order, {"ends": F.array_repeat(F.lit(-1), levels + 1)}, step)


def scan(docs: DataFrame, known: list[Rule] | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each input row: the id, n_words, base (spans of the base phrases), detections (all spans that stay).

    start and end count characters, word counts words from 0. Null text counts as empty and has none. A rule's own
    matches never overlap each other. Repeated rows give repeated rows; an empty table none; other columns are ignored.
    """
    known = rules() if known is None else known
    levels = max((r.priority for r in known), default=PHRASE)
    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    gated = rows.withColumn("_low", F.lower("text"))
    gate = F.lit(False)
    for word in gates(known):
        gate = gate | F.col("_low").contains(word)
    chosen = F.filter(_table(known), lambda r: F.contains(F.col("_low"), r["keyword"]))
    spans = F.when(gate, F.flatten(F.transform(chosen, lambda r: _spans(F.col("text"), r)))).otherwise(F.array().cast(_SPAN))
    found = gated.select("doc_id", _words(F.col("text")).cast("long").alias("n_words"), spans.alias("_spans"))
    base = F.filter("_spans", lambda s: s["priority"] == PHRASE)
    return found.select(F.col("doc_id").alias(id_col), "n_words", base.alias("base"), F.when(F.size("_spans") > 0, _kept(F.col("_spans"), levels)).otherwise(F.col("_spans")).alias("detections"))


def digest(scanned: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """scan()'s rows as counts, places and labels: first_word and last_word are null without a base phrase."""
    names = lambda spans: F.transform(spans, lambda s: s["label"])
    joined = lambda labels: F.array_join(F.array_sort(F.array_distinct(labels)), ",")
    most, worth = F.array_max(F.transform("detections", lambda s: s["priority"])), F.lit(0.0)
    for priority, score in SCORES.items():
        worth = F.when(most == priority, score).otherwise(worth)
    starts = F.transform("base", lambda s: s["word"])
    return scanned.select(
        id_col,
        "n_words",
        F.size("base").cast("long").alias("n_base"),
        F.array_min(starts).cast("long").alias("first_word"),
        F.array_max(starts).cast("long").alias("last_word"),
        joined(names("base")).alias("base_labels"),
        joined(F.concat(names("base"), names("detections"))).alias("labels"),
        worth.cast("double").alias("score"),
        F.size("detections").cast("long").alias("n_detections"),
    )
