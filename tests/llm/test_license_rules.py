"""Every string of a pattern passes the rule's keyword; license texts are found by their own words."""

import itertools
import re._parser as sre

import pytest

from sparkloom.llm import licenses


def strings(pattern, limit=400):
    """Strings of each branch and of each optional part of a pattern."""

    def of(parsed):
        out = [""]
        for op, arg in parsed:
            name = str(op)
            if name == "LITERAL":
                some = [chr(arg)]
            elif name == "IN":
                some = [chr(a) for o, a in arg if str(o) == "LITERAL"] or ["x"]
            elif name == "BRANCH":
                some = [s for branch in arg[1] for s in of(branch)]
            elif name == "SUBPATTERN":
                some = of(arg[3])
            elif name == "MAX_REPEAT":
                least, most, body = arg
                some = [s * n for n in sorted({least, min(most, max(least, 1))}) for s in of(body)]
            else:
                raise ValueError(name)
            out = [a + b for a, b in itertools.islice(itertools.product(out, dict.fromkeys(some)), limit * 20)]
        return out

    return of(sre.parse(pattern))


@pytest.mark.parametrize("rule", [*licenses.BASE, *licenses.RULES], ids=lambda r: f"{r.label}-{r.priority}")
def test_keyword_in_every_string(rule):
    assert [s for s in strings(rule.pattern) if rule.keyword not in f" {s} "] == []


def test_every_string_has_a_stem():
    """... so that the first gate drops no match; and there are hundreds of patterns, each once."""
    rules = [*licenses.BASE, *licenses.RULES]
    assert [s for r in rules for s in strings(r.pattern) if not any(x in f" {s} " for x in licenses.STEMS)] == []
    assert len({r.pattern for r in licenses.RULES}) == len(licenses.RULES) > 250


def test_labels_of_text(spark):
    texts = {
        "Creative Commons Attribution-ShareAlike 4.0": {"cc-by-sa"},
        "Creative Commons Attribution-Non-Commercial 3.0": {"cc-by-nc"},
        "MIT X11 License": {"mit"},
        "ASL 2.0": {"apache-2"},
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the Software)": {"mit"},
        "Redistribution and use in source and binary forms, with or without modification, are permitted": {"bsd"},
        "Neither the name of the University of Here nor the names of its contributors may be used to endorse or promote products": {"bsd-3"},
        "You may not use this file except in compliance with the License.": {"apache-2"},
        "SPDX-License-Identifier: GPL-2.0-or-later": {"gpl-2-or-later"},
        "This file is not licensed under the GPL.": {"not-gpl"},
        "GPL 2 with Classpath Exception": {"classpath-exception"},
        "the software is provided \"as is\", without warranty of any kind, express or implied": {"as-is"},
        "Licht mit Schatten": set(),
    }
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
    got = {r.text: {x.label for x in r.license_scan.found} for r in licenses.scan(df).collect()}
    assert got == texts
