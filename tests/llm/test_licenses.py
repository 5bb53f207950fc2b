"""License rules: spellings that a review found lost."""

import re
from re import _parser

from keyflow.llm import license_rules, licenses


def found(spark, texts):
    rows = list(enumerate(texts))
    got = licenses.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    return [r["labels"] for r in sorted(got, key=lambda r: r["doc_id"])]


SPELLINGS = [
    ("cc-by-sa-any", "Attribution-ShareAlike"), ("cc-by-sa-any", "Attribution Share Alike"), ("cc-by-sa-any", "Attribution-Share-Alike"),
    ("cc-by-nc-any", "Attribution-NonCommercial"), ("cc-by-nc-any", "Attribution-Non-Commercial"),
    ("cc-by-nd-any", "Attribution-NoDerivs"), ("cc-by-nd-any", "Attribution-No-Derivs"),
    ("cc-by-nd-any", "Attribution-NoDerivatives"), ("cc-by-nd-any", "Attribution No Derivatives"),
]


def test_one_word_spellings_are_found(spark):
    texts = [f"shared as Creative Commons {name} here" for _, name in SPELLINGS]
    texts += ["the PHP License, version 3.01", "the PHP License, version 3.0.1"]
    assert found(spark, texts) == [label for label, _ in SPELLINGS] + ["php-3.01"] * 2


def test_no_optional_space_in_a_rule():
    """Words are parted by two spaces, so an optional one still demands the other."""
    assert not [r for r in license_rules.rules() if " ?" in r[4]]


def alternatives(parsed):
    """Every string that a parsed rule matches; one letter stands for an unbounded run, both ends for a range."""
    out = [""]
    for op, arg in parsed:
        name = str(op)
        if name == "LITERAL":
            more = [chr(arg)]
        elif name == "SUBPATTERN":
            more = alternatives(arg[3])
        elif name == "BRANCH":
            more = [s for x in arg[1] for s in alternatives(x)]
        elif name == "IN":
            more = [chr(c) for o, a in arg for c in ([a] if str(o) == "LITERAL" else a)]
        elif name == "MAX_REPEAT":
            low, high, x = arg
            more = alternatives(x) if low else ["", *alternatives(x)]
            assert high == 1 or low == 1
        else:
            raise AssertionError(name)
        out = [a + b for a in out for b in more]
    return out


def test_gates_cover_every_alternative_of_every_rule():
    lost = []
    for _, label, _, word, pattern in license_rules.rules():
        for s in alternatives(_parser.parse(pattern)):
            words = s.split()
            text = " ".join(words)
            raw = any(g in text for g in license_rules.RAW_GATES) or re.search(license_rules.CC_GATE, text)
            if not raw or word not in words:
                lost.append((label, text))
    assert not lost, lost[:20]


def test_ncsa_without_another_gate_word(spark):
    texts = ["Released under the University of Illinois/NCSA.", "covered by University of Illinois NCSA terms"]
    assert found(spark, texts) == ["ncsa", "ncsa"]


#: a sentence and the labels it must give, written apart from the rules
SENTENCES = [
    ("Licensed under the Apache License v2.0.", "apache,apache-2.0"),
    ("Apache License, Version 2.0", "apache,apache-2.0"),
    ("GNU General Public License v3", "gpl,gpl-3.0"),
    ("GNU Lesser General Public License v2.1", "gpl,lgpl-2.1"),
    ("GNU Affero General Public License version 3 or later", "agpl-3.0-or-later,gpl"),
    ("this tool is GPLv3", "gpl-3.0"),
    ("this tool is LGPLv2.1 or later", "lgpl-2.1-or-later"),
    ("Apache-2.0 OR MIT", "apache-2.0,mit"),
    ("you can redistribute it under the terms of the GNU General Public License as published by the Free Software Foundation, "
     "either version 3 of the License, or (at your option) any later version.", "gpl,gpl-3.0-or-later"),
    ("Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation "
     'files (the "Software"), to deal in the Software without restriction', "mit"),
    ("Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following "
     "conditions are met:", "bsd-any"),
    ("Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products "
     "derived from this software", "bsd-3-clause"),
    ("Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted", "isc"),
    ("Attribution 4.0 International", "cc-by-4.0"),
    ("Creative Commons Attribution-NonCommercial-ShareAlike 3.0 Unported License", "cc-by-nc-sa-3.0"),
    ("Creative Commons Attribution-ShareAlike 4.0", "cc-by-sa-4.0"),
    ("SPDX-License-Identifier: GPL-3.0-or-later", "gpl-3.0-or-later"),
    ("an attribution of the painting, provided by the museum", ""),
    ("the general public", ""), ("apache helicopters", ""), ("submit or omit", ""),
]


def test_sentences_give_their_labels(spark):
    assert found(spark, [t for t, _ in SENTENCES]) == [label for _, label in SENTENCES]
