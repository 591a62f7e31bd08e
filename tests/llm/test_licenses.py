"""The rules against a plain Python matcher."""

import random
import re
import string

from curate.llm import licenses
from curate.llm.license_rules import GATES, LICENSES, PHRASES, SENTENCES, rules

LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)
TABLE = [(r, re.compile(f"^(?:{r.pattern})(?= )")) for r in rules()]


def by_hand(doc, text):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))
    found = []
    for i in range(len(words)):
        here = " ".join(words[i : i + licenses.REACH]) + " "
        for rule, pattern in TABLE:
            # No keyword here: the filter may lose nothing.
            hit = pattern.match(here) if words[i] == rule.first else None
            if hit:
                found.append((i, -(i + len(hit[0].split())), rule.priority, rule.order, rule.label, rule.confidence, rule.phrase))
    found.sort()
    lead = [m for k, m in enumerate(found) if not k or found[k - 1][:2] != m[:2]]
    left = [m for k, m in enumerate(lead) if not any(e[1] <= m[1] and e[2] <= m[2] for e in lead[:k])]
    base = [m for m in found if m[6]]
    labels = {m[4] for m in base}
    return (
        doc, len(words), len(base), min((m[0] for m in base), default=None), max((m[0] for m in base), default=None),
        ",".join(sorted(labels)), ",".join(sorted(labels | {m[4] for m in left})), max((m[5] for m in left), default=0.0),
    )


def sample():
    rng = random.Random(3)
    parts = [
        "Licensed under the MIT License.", "SPDX-License-Identifier: Apache-2.0", "released under GPL v3", "gnu general public license, version 2",
        "CC BY-NC 4.0", "MIT", "all rights reserved", "the", "of", "ünder", "cc", "by", "license", "Apache", "GNU GENERAL PUBLIC", "mit-license mit license",
        "www.apache.org/licenses/LICENSE-2.0", "This is free and unencumbered software", "creative commons", "2-clause BSD", "public domain",
        "distributed under the terms of the GNU Lesser General Public License version 2.1", "licensed under GPLv3", "GNU GPLv3", "LGPL v3", "GPLv2",
        "Redistributions of source code must retain the above copyright notice", "this file is in the public domain", "dual licensed under MIT and GPL",
        "You should have received a copy of the GNU Lesser General Public License", "https://opensource.org/licenses/ISC", "see LICENSE for details",
        "Mozilla Public License v2.0", "SPDX-License-Identifier: 0BSD", "license: ODbL-1.0",
    ]
    texts = [" ".join(rng.choices(parts, k=rng.randint(0, 30))) for _ in range(80)]
    texts += [None, "", "...", "x " * 20000 + "mit license", "mit license " * 300, "Apache License" * 2, "cc\nby\tcc by"]
    return list(enumerate(texts)) + [(None, "apache license"), (5, texts[5])]


def test_against_brute_force(spark):
    rows = sample()
    docs = spark.createDataFrame([(*r, "clash", 1) for r in rows], "doc_id long, text string, labels string, n_words int")
    out = licenses.report(licenses.scan(docs))
    got = sorted((tuple(r) for r in out.collect()), key=str)
    assert got == sorted((by_hand(*r) for r in rows), key=str)
    assert sum(r[2] > 0 for r in got) > 20
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Exchange" not in plan


def texts_of(pattern):
    """All texts a rule's pattern stands for; it has alternatives, options and letters only."""

    def spelled(parts):
        out = [""]
        for kind, value in parts:
            kind = str(kind)
            if kind == "LITERAL":
                more = [chr(value)]
            elif kind == "IN":
                more = [chr(v) for _, v in value]
            elif kind == "SUBPATTERN":
                more = spelled(value[3])
            elif kind == "BRANCH":
                more = [t for branch in value[1] for t in spelled(branch)]
            else:
                assert kind == "MAX_REPEAT" and value[:2] == (0, 1), kind
                more = ["", *spelled(value[2])]
            out = [o + m for o in out for m in more]
        return out

    return spelled(re._parser.parse(pattern))


def test_every_rule_fires_and_no_filter_is_in_its_way():
    for rule in rules():
        texts = texts_of(rule.pattern)
        assert all(rule.keyword in t for t in texts), rule
        assert all(any(g in f" {t} " for g in GATES) for t in texts), rule
        assert any(t.split()[0] == rule.first for t in texts), rule
        assert max(len(t.split()) for t in texts) <= licenses.REACH, rule


def test_every_text_of_a_name_starts_some_rule():
    firsts = {}
    for rule in rules():
        firsts.setdefault(rule.label, set()).add(rule.first)
    for label, _, name, _, _ in LICENSES:
        for text in texts_of(name):
            assert text.split()[0] in firsts[label], (label, text)


def test_common_notations(spark):
    told = {
        "Licensed under the GPL v3": "gpl-3.0", "licensed under GPLv3": "gpl-3.0", "GNU GPLv3": "gpl-3.0", "GPLv2 or later": "gpl-2.0",
        "licensed under the LGPL v3": "lgpl-3.0", "Mozilla Public License v2.0": "mpl-2.0", "Eclipse Public License v1.0": "epl-1.0",
        "GNU General Public License v2": "gpl-2.0", "SPDX-License-Identifier: ODbL-1.0": "odbl-1.0", "SPDX-License-Identifier: 0BSD": "0bsd",
        "SPDX-License-Identifier: BSL-1.0": "bsl-1.0", "SPDX-License-Identifier: OFL-1.1": "ofl-1.1", "LGPLv2.1": "lgpl-2.1", "AGPLv3": "agpl-3.0",
    }
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(told)], "doc_id long, text string")
    got = {r["doc_id"]: r["labels"].split(",") for r in licenses.report(licenses.scan(docs)).collect()}
    for i, (text, label) in enumerate(told.items()):
        assert label in got[i], text


def test_headers_of_real_files(spark):
    told = {
        "Licensed to the Apache Software Foundation (ASF) under one or more contributor license agreements.": "apache-2.0",
        "This program is free software: you can redistribute it and/or modify\n * it under the terms of the GNU General Public License": "gpl",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software": "mit-license",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.": "mpl-2.0",
        "Classifier: License :: OSI Approved :: MIT License": "mit-license",
        "Neither the name of the copyright holder nor the names of its contributors": "bsd-3-clause",
        "This is free and unencumbered software released into the public domain.": "unlicense",
        "Altered source versions must be plainly marked as such": "zlib",
    }
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(told)], "doc_id long, text string")
    got = {r["doc_id"]: r["labels"].split(",") for r in licenses.report(licenses.scan(docs)).collect()}
    assert [i for i, label in enumerate(told.values()) if label not in got[i]] == []


def test_rules():
    table = rules()
    assert len(table) > 500 and len({(s[1], s[2]) for s in SENTENCES}) == len(SENTENCES) > 200 and len({r.label for r in table}) > len(LICENSES)
    assert all(re.compile(r.pattern) and r.first and r.keyword for r in table)
    assert len(PHRASES) == sum(r.phrase for r in table)


def test_empty_table(spark):
    assert licenses.report(licenses.scan(spark.createDataFrame([], "doc_id long, text string"))).collect() == []
