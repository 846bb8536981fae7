from __future__ import annotations

import random
import re
import textwrap

import pytest

from claimlake.llm.licenses import COMMENT, RULES, SENTENCE_END, SENTENCES, license_matches, license_report

CASES = {
    1: ("# Released under the MIT License.\ncode", "MIT", 1),
    2: ("Licensed under the  Apache License,\tVersion 2.0.  You may not use this file except in compliance with the License. You may obtain a copy of the License at", "Apache-2.0", 1),
    3: ("Licensed under the Apache License, Version 2.0.\nbetween\nYou may not use this file except in compliance with the License.", "Apache-2.0", 1),
    4: ("// Licensed under CC BY-NC 4.0.\r\n// released under the mit license!", "CC-BY-NC-4.0,MIT", 2),
    5: ("Licensed under CC BY 4.0\nLicensed under CC BY 4.0", "CC-BY-4.0", 2),
    6: ("All rights reserved. Redistribution and use in source and binary forms, with or without modification, are permitted", "BSD", 1),
    7: ("All rights reserved.", "", 0),
    8: (None, "", 0), 9: ("", "", 0), 10: ("x " * 100_000 + "\nThis work is licensed under the GNU General Public License, version 3.", "GPL-3.0", 1),
    12: ("%" * 300_000 + "x" + "#" * 300_000 + "y\n*** Released under the MIT License ***", "MIT", 1),
    11: ("Not released under the MIT License.", "", 0),
}


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(k, t, "x", 1) for k, (t, _, _) in CASES.items()] + [(1, CASES[1][0], "x", 1), (None, CASES[5][0], "x", 1), (1, "nothing", "x", 1)]
    return spark.createDataFrame(rows, "doc_id long, text string, license string, place int")


def test_report(docs):
    want = [(k, *v[1:]) for k, v in CASES.items()] + [(1, "MIT", 1), (None, "CC-BY-4.0", 2), (1, "", 0)]
    assert sorted(map(tuple, license_report(docs).collect()), key=repr) == sorted(want, key=repr)
    assert license_report(docs.limit(0)).collect() == []


def test_matches_name_their_place_and_longest_rule(docs):
    found = {(r.id, r.license, r.place, r.sentences) for r in license_matches(docs).collect()}
    assert {(2, "Apache-2.0", 0, 3), (3, "Apache-2.0", 0, 1), (4, "CC-BY-NC-4.0", 0, 1), (4, "MIT", 1, 1), (6, "BSD", 0, 2), (10, "GPL-3.0", 1, 1)} <= found


MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software."""
BSD = """Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this
   list of conditions and the following disclaimer."""
GPL = """This program is free software{} you can redistribute it and/or modify
it under the terms of the GNU General Public License as published by
the Free Software Foundation{} either version {} of the License, or
(at your option) any later version."""
APACHE = """Licensed under the Apache License, Version 2.0 (the "License");
you may not use this file except in compliance with the License.
You may obtain a copy of the License at

    http://www.apache.org/licenses/LICENSE-2.0

Unless required by applicable law or agreed to in writing, software
distributed under the License is distributed on an "AS IS" BASIS,
WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied."""
BSD_BINARY = """

2. Redistributions in binary form must reproduce the above copyright notice,
   this list of conditions and the following disclaimer in the documentation
   and/or other materials provided with the distribution."""
BSD_NAMES = """

3. Neither the name of the copyright holder nor the names of its
   contributors may be used to endorse or promote products derived from
   this software without specific prior written permission."""
BSD_AS_IS = """

THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS"
AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE
IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE
DISCLAIMED."""
LGPL = """This library is free software; you can redistribute it and/or
modify it under the terms of the GNU Lesser General Public
License as published by the Free Software Foundation; either
version 2.1 of the License, or (at your option) any later version."""
ISC = """Permission to use, copy, modify, and/or distribute this software for any
purpose with or without fee is hereby granted, provided that the above
copyright notice and this permission notice appear in all copies."""
MPL = """This Source Code Form is subject to the terms of the Mozilla Public
License, v. 2.0. If a copy of the MPL was not distributed with this
file, You can obtain one at https://mozilla.org/MPL/2.0/."""
NOTICES = {
    "MIT": MIT, "BSD": BSD, "GPL-3.0-or-later": GPL.format(":", ",", 3), "GPL-2.0-or-later": GPL.format(";", ";", 2), "Apache-2.0": APACHE,
    "BSD-2-Clause": BSD + BSD_BINARY + BSD_AS_IS, "BSD-3-Clause": BSD + BSD_BINARY + BSD_NAMES + BSD_AS_IS, "BSD ": BSD + BSD_BINARY,
    "BSD  ": BSD + BSD_BINARY + BSD_NAMES.replace("the copyright holder", "Foo Inc") + BSD_AS_IS,
    "LGPL-2.1-or-later": LGPL, "ISC": ISC, "0BSD": ISC.split(", provided")[0] + ".", "MPL-2.0": MPL,
    "AGPL-3.0-or-later": GPL.format(":", ",", 3).replace("GNU General", "GNU Affero General"),
    "GPL-2.0-only": GPL.format(";", ";", 2).replace("either version", "version").replace(", or\n(at your option) any later version", ""),
    "Unlicense": "This is free and unencumbered software released into the public domain.",
    "Apache-2.0 OR MIT": "SPDX-License-Identifier: Apache-2.0 OR MIT", "MIT ": "SPDX-License-Identifier: MIT", "MIT  ": "This project is licensed under the MIT License.",
}
#: As it is, paragraphs in a line each, all in one line, other wraps, in comments.
FORMS = (
    lambda t: t,
    lambda t: "\n\n".join(" ".join(p.split()) for p in t.split("\n\n")),
    lambda t: " ".join(t.split()),
    lambda t: "\r\n".join(t.split()),
    lambda t: "Copyright (c) 2020 A\n" + "\n".join(textwrap.wrap(t, 40)) + "\nand on",
    lambda t: "\n".join(f"# {line}".rstrip() for line in t.split("\n")),
    lambda t: "\n".join(f"// {line}".rstrip() for line in t.split("\n")),
    lambda t: "/*\n" + "\n".join(f" * {line}" for line in t.split("\n")) + "\n */",
    lambda t: "\n".join(f"# {line:<90} #" for line in t.split("\n")),
    lambda t: '"""' + t + '"""',
)


def test_whole_notices_wrapped_and_unwrapped(spark):
    cases = [(f"{name}{k}", form(text), name.strip()) for name, text in NOTICES.items() for k, form in enumerate(FORMS)]
    found = license_report(spark.createDataFrame([c[:2] for c in cases], "doc_id string, text string"))
    assert {r.doc_id: (r.licenses, r.n_matches) for r in found.collect()} == {name: (want, 1) for name, _, want in cases}


def test_parts_of_sentences_are_no_match(spark):
    texts = ["Not released under\nthe MIT License.", "Released under.\nthe MIT License", "Released under\nthe other\nMIT License", "Licensed under\nthe"]
    found = license_report(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"))
    assert {(r.licenses, r.n_matches) for r in found.collect()} == {("", 0)}


def test_against_brute_force_of_sentences_and_rules(spark):
    """Texts of known sentences, parts of them, other words and line ends, by trying every sentence at every piece."""
    pick = random.Random(11)
    sentences = sorted(SENTENCES, key=lambda s: (-len(s), s))
    marks = "".join(chr(c) for c in range(128) if not chr(c).isalnum())

    def text():
        parts = [pick.choice(sentences) if pick.random() < 0.8 else pick.choice(sentences)[:40] for _ in range(pick.randrange(1, 9))]
        wrapped = [p if pick.random() < 0.5 else "\n".join(textwrap.wrap(p, pick.choice([30, 60]), break_long_words=False, break_on_hyphens=False)) for p in parts]
        return "".join(p + pick.choice([". ", ".\n", "\n", ".\n\n", ".\n# ", ". Other words. "]) for p in wrapped)

    def matches(text):
        lines = [" ".join(re.sub(COMMENT.replace("++", "+").replace(r"\z", r"\Z"), "", p.lower()).split()) for p in re.split(SENTENCE_END, text)]
        known = [None] * len(lines)  # (identifier, first piece) at every piece of a known sentence
        for sentence in sentences:
            for i, line in enumerate(lines):
                for j in range(i, len(lines) if line else i):
                    if any(known[i : j + 1]) or len(" ".join(lines[i + 1 : j])) > len(sentence):
                        break
                    if lines[j] and " ".join(x for x in lines[i : j + 1] if x).strip(marks) == sentence:
                        known[i : j + 1] = [(SENTENCES[sentence], i)] * (j + 1 - i)
                        break
        row = [k for n, k in enumerate(known) if (k or lines[n]) and (not k or k[1] == n)]  # lines without text do not part
        found = []
        for name, ids in RULES:
            at = 0
            while at + len(ids) <= len(row):
                if [k and k[0] for k in row[at : at + len(ids)]] == list(ids):
                    found.append((name, row[at][1], len(ids)))
                    row[at : at + len(ids)] = [None]
                at += 1
        return found

    texts = [text() for _ in range(400)]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    want = sorted((i, *m) for i, t in enumerate(texts) for m in matches(t))
    assert len({m[1] for m in want}) > 25
    assert sorted((r.id, r.license, r.place, r.sentences) for r in license_matches(frame).collect()) == want
