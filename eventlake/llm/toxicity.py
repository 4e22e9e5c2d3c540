"""Toxicity: a learned lexicon in a trie, Levenshtein automata run along it, and scores of context windows.

The lexicon holds words and stems (word beginnings) that are far more frequent in toxic than in clean training texts, beside a
short list of common insults. A stem matches every word that begins with it. Whole words of the lexicon are also matched with
misspellings: a text's word runs through the product of the Levenshtein automata of all lexicon words, which is the trie walked
with an edit budget; its states are made deterministic as they are met and kept. Matches in quotations (of any
length within a paragraph) or after reporting verbs count for less. Around each match, the weights of the matches in a window of words are summed; these sums, and
others over the text, go into a logistic regression that turns them into a probability.

Training takes a bounded sample: SAMPLE labelled rows of either class at most, picked by a hash of their ids, and SAMPLE_BYTES of whole texts
in that order; a text that would go over is left out. Scoring reads every row.
"""

from __future__ import annotations

import math
import re
import zlib
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import fold, per_process, small_batches, trim

#: Labelled rows of each class that training takes at most, and bytes of their texts.
SAMPLE, SAMPLE_BYTES = 2000, 16 << 20
#: Common insults, known without training.
SEEDS = (
    "idiot", "moron", "imbecile", "stupid", "dumb", "dumbass", "fool", "loser", "scum", "trash", "garbage", "pathetic", "worthless", "disgusting",
    "clown", "jerk", "bastard", "bitch", "asshole", "retard", "pig", "filth", "vermin", "parasite", "scumbag", "dickhead", "cretin", "halfwit",
    "fuck", "fucking", "shit", "bullshit", "whore", "slut", "wanker", "twat", "prick",
)
SEED_WEIGHT = 3.0
#: Lengths of stems; rows (at least, and as a share of the toxic ones) and lift that an entry needs. There is no cap on entries: the sample bounds them.
STEM, SUPPORT, SHARE, LIFT = (4, 10), 3, 0.015, 15.0
#: Words of at least so many letters may have so many edits; entries below the weight have no misspellings.
EDITS, FUZZY_WEIGHT = ((5, 1), (9, 2)), 2.5
#: Words on either side of a match that are its context, words before it in which a reporting verb tells a quotation.
WINDOW, REPORTED = 8, 4
REPORTING = frozenset("said says say called calls quote quoted quotes wrote writes dit disait écrit sagte schrieb dijo escribió".split())
#: Nouns that name a word when they stand right before it.
NAMING = frozenset("word words term phrase slur insult mot wort palabra".split())
QUOTED = 0.5
#: Words that a worker remembers the verdict of.
CACHED_WORDS = 300_000

_WORD = re.compile(r"[^\W\d_]+")
_QUOTES = "\"“”«»„‘’'"
#: Marks, and ends of paragraphs, in which no quotation stays open.
_MARKS = re.compile(r"""["“”«»„‘’']|\n[^\S\n]*\n""")
#: Mark -> the marks that it closes a quotation of; those that are an apostrophe between letters, and those that never open one.
_CLOSES = {'"': '"', "”": "“„”", "“": "„", "»": "«", "«": "»", "’": "‘", "'": "'", "„": "", "‘": ""}
_SINGLE, _ONLY_CLOSE = "‘’'", "’"


def quotations(text: str) -> tuple[list[int], list[int]]:
    """Starts and ends of the quotations of a text, of any number of words: in order and apart, those inside others left out."""
    spans: list[tuple[int, int]] = []
    opened: dict[str, int] = {}
    for m in _MARKS.finditer(text):
        mark, at = m[0], m.start()
        if mark[0] == "\n":
            opened.clear()
            continue
        before, after = text[at - 1 : at], text[at + 1 : at + 2]
        mate = next((x for x in _CLOSES[mark] if x in opened), None)
        if mate and not (mark in _SINGLE and (before.isspace() or after.isalnum())):
            spans.append((opened.pop(mate), at))
        elif mark not in _ONLY_CLOSE and not (mark in _SINGLE and (before.isalnum() or not after or after.isspace())):
            opened[mark] = at
    starts, ends = [], []
    for a, b in sorted(spans):
        if ends and a < ends[-1]:
            ends[-1] = max(ends[-1], b)
        else:
            starts.append(a)
            ends.append(b)
    return starts, ends


@dataclass
class Model:
    """weights: entry (a stem, or a whole word ended by $) -> weight. mean, scale, coefficients and bias: of the regression."""

    weights: dict[str, float]
    coefficients: np.ndarray = field(default_factory=lambda: np.array([0.4, 0.8, 0.4, 0.8, 0.4]))
    mean: np.ndarray = field(default_factory=lambda: np.zeros(5))
    scale: np.ndarray = field(default_factory=lambda: np.ones(5))
    bias: float = -3.0

    @property
    def key(self) -> int:
        return zlib.crc32(repr((sorted(self.weights.items()), self.coefficients.tolist(), self.bias)).encode())


class Misspelt:
    """The product of the Levenshtein automata of the lexicon's words with its trie, made deterministic step by step.

    A state is the set of (trie node, edits so far); its successors are computed once.
    """

    def __init__(self, words: dict[str, float]):
        self.children: list[dict[str, int]] = [{}]
        self.worth: list[float] = [0.0]
        self.budget: list[int] = [0]
        for word, weight in words.items():
            edits = max((e for n, e in EDITS if len(word) >= n), default=0)
            at = 0
            self.budget[0] = max(self.budget[0], edits)
            for ch in word:
                nxt = self.children[at].get(ch)
                if nxt is None:
                    nxt = len(self.children)
                    self.children[at][ch] = nxt
                    self.children.append({})
                    self.worth.append(0.0)
                    self.budget.append(0)
                at = nxt
                self.budget[at] = max(self.budget[at], edits)
            self.worth[at] = max(self.worth[at], weight)
        self.own = {self._end(w): w for w in words}
        self.states: dict[tuple, int] = {}
        self.sets: list[tuple] = []
        self.steps: list[dict[str, int]] = []
        self.ends: list[float] = []
        self.dead = self._state({})
        self.start = self._state(self._closed({0: 0}))

    def _end(self, word: str) -> int:
        at = 0
        for ch in word:
            at = self.children[at][ch]
        return at

    def _closed(self, found: dict[int, int]) -> dict[int, int]:
        """Adds what letters of the lexicon word that the text leaves out lead to."""
        todo = list(found.items())
        while todo:
            node, edits = todo.pop()
            for nxt in self.children[node].values():
                if edits + 1 <= self.budget[nxt] and found.get(nxt, 99) > edits + 1:
                    found[nxt] = edits + 1
                    todo.append((nxt, edits + 1))
        return found

    def _state(self, found: dict[int, int]) -> int:
        key = tuple(sorted(found.items()))
        if key not in self.states:
            self.states[key] = len(self.sets)
            self.sets.append(key)
            self.steps.append({})
            self.ends.append(max((self.worth[n] for n, e in key if self.worth[n] and e <= max((x for size, x in EDITS if len(self.own[n]) >= size), default=0)), default=0.0))
        return self.states[key]

    def _step(self, state: int, ch: str) -> int:
        found: dict[int, int] = {}

        def reach(node: int, edits: int) -> None:
            if edits <= self.budget[node] and found.get(node, 99) > edits:
                found[node] = edits

        for node, edits in self.sets[state]:
            reach(node, edits + 1)  # a letter too many
            for letter, nxt in self.children[node].items():
                reach(nxt, edits + (letter != ch))
        self.steps[state][ch] = out = self._state(self._closed(found))
        return out

    def weight(self, word: str) -> float:
        """The largest weight of a lexicon word within its edit budget of this one, or 0."""
        state = self.start
        for ch in word:
            state = self.steps[state].get(ch, -1) if ch in self.steps[state] else self._step(state, ch)
            if state == self.dead:
                return 0.0
        return self.ends[state]


class Matcher:
    """Words -> (weight, whether misspelt), remembered."""

    def __init__(self, model: Model):
        self.weights = model.weights
        self.misspelt = Misspelt({e[:-1]: w for e, w in model.weights.items() if e.endswith("$") and w >= FUZZY_WEIGHT and len(e) > EDITS[0][0]})
        self.known: dict[str, tuple[float, bool] | None] = {}

    def look(self, word: str) -> tuple[float, bool] | None:
        weights = self.weights
        best = weights.get(word + "$", 0.0)
        for n in range(STEM[0], min(len(word), STEM[1]) + 1):
            best = max(best, weights.get(word[:n], 0.0))
        if best:
            return best, False
        fuzzy = self.misspelt.weight(word)
        return (fuzzy, True) if fuzzy else None

    def features(self, text: str) -> tuple[list[float], int]:
        """(log of the summed weights, distinct matched words, largest window, share of words, misspelt weights), matches."""
        words = _WORD.findall(text.lower())
        known = self.known
        new = set(words).difference(known)
        if len(known) + len(new) > CACHED_WORDS:
            known.clear()
            new = set(words)
        for word in new:
            known[word] = self.look(word)
        if not any(map(known.get, set(words))):
            return [0.0] * 5, 0
        spots = []
        low = text.lower()
        starts, ends = quotations(low)
        for i, m in enumerate(_WORD.finditer(low)):
            hit = known[m[0]]
            if hit:
                before, after = low[m.start() - 1 : m.start()], low[m.end() : m.end() + 1]
                near = bool(before and after) and before in _QUOTES and after in _QUOTES
                k = bisect_right(starts, m.start()) - 1
                near = near or (k >= 0 and m.start() < ends[k])
                told = not REPORTING.isdisjoint(words[max(0, i - REPORTED) : i]) or (i > 0 and words[i - 1] in NAMING)
                spots.append((i, hit[0] * (QUOTED if near or told else 1.0), hit[1], m[0]))
        exact, fuzzy = sum(w for _, w, f, _ in spots if not f), sum(w for _, w, f, _ in spots if f)
        widest, first, total = 0.0, 0, 0.0
        for last, (i, w, f, _) in enumerate(spots):
            total += w * (0.5 if f else 1.0)
            while i - spots[first][0] > 2 * WINDOW:
                total -= spots[first][1] * (0.5 if spots[first][2] else 1.0)
                first += 1
            widest = max(widest, total)
        distinct = len({x for _, _, f, x in spots if not f})
        return [math.log1p(exact), math.log1p(distinct), math.log1p(widest), 10 * exact / (10 + len(words)), math.log1p(fuzzy)], len(spots)


def _score(model: Model, rows: np.ndarray) -> np.ndarray:
    z = ((rows - model.mean) / model.scale) @ model.coefficients + model.bias
    return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def _entries(text: str) -> set[str]:
    out = set()
    for word in set(_WORD.findall(text.lower())):
        if len(word) >= 3:
            out.add(word + "$")
            out.update(word[:n] for n in range(STEM[0], min(len(word), STEM[1]) + 1))
    return out


def lexicon(toxic: list[str], clean: list[str]) -> dict[str, float]:
    """Entries with their weights: logs of how much more frequent they are in toxic texts."""
    weights = {f"{w}$": SEED_WEIGHT for w in SEEDS}
    if not toxic or not clean:
        return weights
    many: Counter = Counter()
    for text in toxic:
        many.update(_entries(text))
    need = max(SUPPORT, SHARE * len(toxic))
    many = Counter({e: n for e, n in many.items() if n >= need})
    few: Counter = Counter()
    for text in clean:
        few.update(x for x in _entries(text) if x in many)
    lift = {e: (n / len(toxic)) / ((few[e] + 0.5) / len(clean)) for e, n in many.items()}
    good = sorted((e for e in many if lift[e] >= LIFT), key=lambda e: (-many[e] * math.log(lift[e]), e))
    return weights | {e: min(6.0, math.log(lift[e])) for e in good}


def _regression(x: np.ndarray, y: np.ndarray, prior: float) -> tuple[np.ndarray, np.ndarray, np.ndarray, float]:
    """Newton steps with a small ridge; prior is what the sample's balance adds to the log odds, and is taken off again."""
    mean, scale = x.mean(axis=0), np.maximum(x.std(axis=0), 1e-3)
    z = np.hstack([(x - mean) / scale, np.ones((len(x), 1))])
    w = np.zeros(z.shape[1])
    ridge = np.diag([1.0] * x.shape[1] + [1e-6])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        step = np.linalg.solve((z * (p * (1 - p))[:, None]).T @ z + ridge, z.T @ (y - p) - ridge @ w)
        w += step
        if np.abs(step).max() < 1e-6:
            break
    return mean, scale, w[:-1], float(w[-1] - prior)


def fit(toxic: list[str], clean: list[str], prior: float = 0.0) -> Model:
    """A model of whole texts. Features of either half come from the other half's lexicon, so chance entries earn no trust."""
    toxic, clean = sorted(set(toxic)), sorted(set(clean))
    model = Model(lexicon(toxic, clean))
    half = lambda texts, k: [t for t in texts if zlib.crc32(t.encode("utf-8", "replace")) % 2 == k]
    rows, labels = [], []
    for k in (0, 1):
        other = Matcher(Model(lexicon(half(toxic, 1 - k), half(clean, 1 - k))))
        for label, texts in ((1, half(toxic, k)), (0, half(clean, k))):
            rows += [other.features(t)[0] for t in texts]
            labels += [label] * len(texts)
    if 4 <= sum(labels) <= len(labels) - 4:
        model.mean, model.scale, model.coefficients, model.bias = _regression(np.array(rows), np.array(labels, float), prior)
    return model


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", held_out: int = 0) -> Model:
    """Learns from labelled rows whose fold is not `held_out`. Null labels and ids are left out; of several labels of an id the largest counts."""
    told = labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull() & (fold(id_col) != held_out)).select(F.col(id_col).alias("_id"), F.col(label_col).alias("_label"))
    small_batches(docs.sparkSession)
    known = told.groupBy("_id").agg(F.max("_label").alias("_label"))
    sizes = {r["_label"]: r["count"] for r in known.groupBy((F.col("_label") > 0).cast("int").alias("_label")).count().collect()}
    parts = [known.where((F.col("_label") > 0) == F.lit(bool(x))).orderBy(F.xxhash64("_id"), "_id").limit(SAMPLE) for x in (1, 0)]
    chosen = parts[0].union(parts[1])  # 2 x SAMPLE ids at most
    texts = docs.select(F.col(id_col).alias("_doc"), F.col(text_col).alias("text")).where("text is not null")
    chosen = docs.sparkSession.createDataFrame(chosen.collect(), chosen.schema)  # 2 x SAMPLE ids: picked once
    here = texts.join(F.broadcast(chosen), F.col("_doc") == F.col("_id"))
    sizes_of = here.groupBy("_id", "_label").agg(F.sum(F.octet_length("text")).alias("_bytes")).orderBy(F.xxhash64("_id"), "_id").collect()
    left, taken = {0: SAMPLE_BYTES // 2, 1: SAMPLE_BYTES // 2}, []
    for r in sizes_of:
        kind = int(r["_label"] > 0)
        if r["_bytes"] <= left[kind]:
            left[kind] -= r["_bytes"]
            taken.append((r["_id"], r["_label"]))
    fits = docs.sparkSession.createDataFrame(taken, chosen.schema)
    rows = texts.join(F.broadcast(fits), F.col("_doc") == F.col("_id")).select("text", "_label").collect()  # SAMPLE_BYTES
    toxic, clean = [r["text"] for r in rows if r["_label"] > 0], [r["text"] for r in rows if not r["_label"] > 0]
    prior = math.log(max(1, len(toxic)) / max(1, len(clean))) - math.log(max(1, sizes.get(1, 0)) / max(1, sizes.get(0, 0)))
    return fit(toxic, clean, prior)


def scores(model: Model, text: Column) -> Column:
    """struct<score double, n_hits int> of a whole text; null counts as empty."""
    key = ("toxicity", model.key)

    @F.pandas_udf("score double, n_hits int")
    def score(parts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        matcher = per_process(key, lambda: Matcher(model))
        for part in parts:
            trim()
            found = [matcher.features(t or "") for t in part]
            rows = np.array([f for f, _ in found]).reshape(-1, 5)
            yield pd.DataFrame({"score": _score(model, rows), "n_hits": np.array([n for _, n in found], np.int32)})
        trim()

    return score(text)


def judge(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each input row: the id, held_out, score, predicted, n_hits.

    Null and empty texts get the score of a text without matches. Without labels of both classes, common insults alone
    decide. Repeated rows give repeated rows; an empty table none; other columns are ignored.
    """
    model = train(docs, labels, id_col, text_col)
    rows = docs.select(F.col(id_col).alias("doc_id"), scores(model, F.col(text_col)).alias("_s"))
    return rows.select(F.col("doc_id").alias(id_col), (fold("doc_id") == 0).alias("held_out"), F.col("_s.score").alias("score"), (F.col("_s.score") >= 0.5).cast("int").alias("predicted"), F.col("_s.n_hits").alias("n_hits"))


def reject(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.5) -> DataFrame:
    """The rows of docs, all their columns, whose score is under the threshold."""
    model = train(docs, labels, id_col, text_col)
    return docs.where(scores(model, F.col(text_col))["score"] < threshold)
