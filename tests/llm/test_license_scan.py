import itertools
import re

from corpus import EDGES, docs, prose

from eventlake.llm import license_scan
from eventlake.llm.license_rules import BODIES, BODY, FAMILIES, GATES, GRANT, PHRASES, Rule, rules

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def brute(text):
    words = WORD.findall((text or "").translate(LOWER))
    hits = []
    for label, phrase in PHRASES:
        p = phrase.split()
        hits += [(i, label) for i in range(len(words) - len(p) + 1) if words[i : i + len(p)] == p]
    return len(words), len(hits), min((i for i, _ in hits), default=None), max((i for i, _ in hits), default=None), ",".join(sorted({x for _, x in hits}))


TEXTS = [
    "MIT-License mit_license\nMIT  LICENSE. xmit license mit licenses", "CC BY cc-by-nc 4.0 CC\x00BY ccby", "gnu general public license general public license", "émit license MİT LICENSE mit licenſe",
    "Licensed under the Apache License, Version 2.0", "apache\n\n\tlicense license apache license", "mit license " * 700, "İİ mit license ΣΣ", "the GNU General Public License; MIT License; Apache License; CC BY",
]


def test_base_as_brute_force(spark):
    rows = [(100 + i, t) for i, t in enumerate(TEXTS)] + [(50 + i, prose(i, 30)) for i in range(5)] + EDGES
    got = license_scan.digest(license_scan.scan(docs(spark, rows))).collect()
    assert sorted(((r.doc_id, r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) for r in got), key=repr) == sorted(((i, *brute(t)) for i, t in rows), key=repr)
    for r in got:
        assert 0 <= r.score <= 1
        assert set(filter(None, r.base_labels.split(","))) <= set(filter(None, r.labels.split(",")))


def test_empty(spark):
    assert license_scan.digest(license_scan.scan(docs(spark, []))).count() == 0


LABELLED = [
    ("SPDX-License-Identifier: GPL-2.0-only", "gpl", 1.0),
    ("see http://www.apache.org/licenses/LICENSE-2.0", "apache", 1.0),
    ("Released under the terms of the Mozilla Public License, version 2.0.", "mpl", 0.95),
    ("GNU Lesser General Public License", "lgpl", 0.8),
    ("GNU Affero General Public Licence v3", "agpl", 0.8),
    ("This is released into the public domain", "public-domain", 0.8),
    ("Licensed under CC BY-NC 4.0.", "cc-by,cc-by-nc", 0.95),
    ("my licence to drive", "", 0.0),
    ("nothing here", "", 0.0),
]


def test_labels(spark):
    got = {r.doc_id: (r.labels, r.score) for r in license_scan.digest(license_scan.scan(docs(spark, [(i, text) for i, (text, _, _) in enumerate(LABELLED)]))).collect()}
    for i, (text, labels, score) in enumerate(LABELLED):
        assert got[i] == (labels, score), text


def test_contained_detections_go(spark):
    r = license_scan.scan(docs(spark, [(1, "Licensed under the GNU General Public License, version 3. MIT License")])).first()
    assert [(d.label, d.priority) for d in r.detections] == [("gpl", GRANT), ("mit", 2)]
    text = "Licensed under the GNU General Public License, version 3. MIT License"
    assert [text[d.start : d.end] for d in r.detections] == [text[:56], "MIT License"]
    assert [d.word for d in r.base] == [3, 9]


def test_kept_as_pairwise_containment(spark):
    """The fold keeps what comparing each span with all others keeps."""
    text = " ".join(["licensed under the BSD license", "GNU Lesser General Public License v2", "SPDX-License-Identifier: MIT", "MIT License or Apache License 2.0"] * 90)
    r = license_scan.scan(docs(spark, [(1, text)])).first()
    every = []
    for i, rule in enumerate(rules()):
        if rule.keyword in text.lower():
            every += [(m.start(), m.end(), rule.priority, i) for m in re.finditer(rule.pattern, text)]
    def holds(e, d):
        if e == d or not (e[0] <= d[0] and e[1] >= d[1] and e[2] >= d[2]):
            return False
        return e[:2] != d[:2] or (e[2], -e[3]) > (d[2], -d[3])
    want = sorted(d for d in every if not any(holds(e, d) for e in every if abs(e[0] - d[0]) < 200))
    assert sorted((d.start, d.end, d.priority, d.rule) for d in r.detections) == want


def test_rules():
    known = rules()
    assert len(known) > 200
    for r in known:
        re.compile(r.pattern)
        assert r.keyword == r.keyword.lower()


def test_gates_let_every_detection_through(spark):
    rows = [(i, t) for i, t in enumerate(TEXTS)]
    free = license_scan.digest(license_scan.scan(docs(spark, rows))).collect()
    for r in free:
        if r.n_base:
            assert any(g in TEXTS[r.doc_id].lower() for g in GATES)


def shortest(parsed, more=0):
    """Texts that a parsed regex matches: one for each way through its alternatives, optional parts left out, or taken once with `more`."""
    out = [""]
    for kind, value in parsed:
        kind = str(kind)
        if kind == "LITERAL":
            ways = [chr(value)]
        elif kind == "BRANCH":
            ways = [x for part in value[1] for x in shortest(part, more)]
        elif kind == "SUBPATTERN":
            ways = shortest(value[3], more)
        elif kind in ("MAX_REPEAT", "MIN_REPEAT", "POSSESSIVE_REPEAT"):
            ways = ["".join(x) for n in {value[0], min(value[1], value[0] + more)} for x in itertools.product(shortest(value[2], more), repeat=n)]
        elif kind == "IN":
            name, first = value[0]
            ways = ["x" if str(name) == "NEGATE" else "7" if str(name) == "CATEGORY" else chr(first[0] if str(name) == "RANGE" else first)]
        else:
            assert kind in ("ASSERT", "ASSERT_NOT", "AT"), kind
            ways = [""]
        out = [a + b for a in out for b in ways]
    return out


def test_each_way_through_each_rule_holds_its_keyword_and_a_gate():
    for rule in rules():
        for text in itertools.chain.from_iterable(shortest(re._parser.parse(rule.pattern), more) for more in ((0,) if rule.priority in (GRANT, BODY) else (0, 1))):
            assert re.fullmatch(rule.pattern, text), (rule, text)
            assert rule.keyword in text.lower(), (rule, text)
            assert any(g in text.lower() for g in GATES), (rule, text)


def test_each_address_and_name_of_the_table_is_in_a_rule():
    """Cutting a line into rules loses nothing of it."""
    known = rules()
    for line in FAMILIES:
        label, _, _, names, addresses = (x.strip() for x in line.split(" | "))
        for text in shortest(re._parser.parse(names)):
            assert sum(bool(re.fullmatch(r.pattern, text)) for r in known if r.label == label and r.priority == 2), text
        for text in shortest(re._parser.parse(addresses)):
            assert any(re.fullmatch(r.pattern, f"https://{text}") for r in known if r.label == label), text


ALONE = [
    ("Released under BSD 3-Clause terms.", "bsd-3-clause"), ("bsd zero-clause", "0bsd"), ("https://www.mozilla.org/MPL/2.0/", "mpl"), ("http://eclipse.org/legal/epl-v10", "epl"), ("https://scripts.sil.org/OFL", "ofl"),
    ("https://mariadb.com/bsl11", "busl"), ("https://perlfoundation.org/artistic", "artistic"), ("Creative Commons Attribution-NoDerivs", "cc-by-nd"), ("do what the fuck you want to public license", "wtfpl"),
]
ADDRESSES = [("https://mit-license.org", "mit"), ("https://opensource.org/licenses/zlib", "zlib"), ("https://opensource.org/licenses/artistic", "artistic")]


def labels_of(spark, texts):
    got = {r.doc_id: r.labels.split(",") for r in license_scan.digest(license_scan.scan(docs(spark, list(enumerate(texts))))).collect()}
    return [got[i] for i in range(len(texts))]


def without_prefilter(text):
    """Labels that every rule run over the whole text gives, after pairwise containment."""
    every = [(m.start(), m.end(), r.priority, -i, r.label) for i, r in enumerate(rules()) for m in re.finditer(r.pattern, text)]
    inside = lambda d, e: d is not e and e[0] <= d[0] and d[1] <= e[1] and e[2] >= d[2] and (e[:2] != d[:2] or (e[2], e[3]) > (d[2], d[3]))
    kept = {d[4] for d in every if not any(inside(d, e) for e in every)}
    return ",".join(sorted(kept | {d[4] for d in every if d[2] == 1}))


def test_scan_equals_one_without_a_prefilter(spark):
    """A text for each way through each rule, alone: gates and keywords change nothing."""
    texts = sorted({t for rule in rules() for t in shortest(re._parser.parse(rule.pattern))} | {t for t, _ in ALONE + ADDRESSES})
    assert len(texts) > 300
    rows = list(enumerate(texts))
    got = {r.doc_id: r.labels for r in license_scan.digest(license_scan.scan(docs(spark, rows, clash=False))).collect()}
    for i, text in rows:
        assert got[i] == without_prefilter(text) != "", text


def wrapped(passage, mark):
    """A passage as files have it: in lines of five words behind comment marks, with a capital and a full stop."""
    words = passage.split()
    return f"{mark} " + f"\n{mark} ".join(" ".join(words[i : i + 5]) for i in range(0, len(words), 5)).capitalize() + "."


def test_bodies(spark):
    lines = [[x.strip() for x in line.split(" | ")] for line in BODIES for _ in range(4)]
    texts = [wrapped(passage, ("", " *", "#", "//")[i % 4]) for i, (_, _, passage) in enumerate(lines)]
    for (label, _, _), text, got in zip(lines, texts, labels_of(spark, texts), strict=True):
        assert label in got, text


def test_body_of_a_file(spark):
    text = """Copyright (c) 2020 Somebody

Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:
1. Redistributions of source code must retain the above copyright notice.
3. Neither the name of the holder nor the names of its contributors may be used
   to endorse or promote products derived from this software without specific
   prior written permission."""
    r = license_scan.digest(license_scan.scan(docs(spark, [(1, text), (2, "Permission is granted, and redistribution is hereby promised.")])))
    assert {x.doc_id: (x.labels, x.score) for x in r.collect()} == {1: ("bsd,bsd-3-clause", 0.98), 2: ("", 0.0)}


def test_notices_without_other_words(spark):
    for (text, label), got in zip(ALONE, labels_of(spark, [t for t, _ in ALONE]), strict=True):
        assert label in got, text


def test_each_address_alone(spark):
    assert labels_of(spark, [t for t, _ in ADDRESSES]) == [[label] for _, label in ADDRESSES]


def test_other_rules_have_their_own_gates(spark):
    assert license_scan.scan(docs(spark, [(1, "a foo b")]), [Rule("foo", "foo", "x", 2)]).first().detections[0].label == "x"


def test_no_python_in_the_plan(spark):
    plan = license_scan.digest(license_scan.scan(docs(spark, [(1, "a")])))._jdf.queryExecution().toString()
    assert not re.search("EvalPython|MapIn|FlatMapGroups|PythonUDF|pythonUDF", plan)
