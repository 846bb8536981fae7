"""License scan: sentences are recognised first, then sequences of recognised sentences.

A text is cut into pieces at line ends and after ``.``, ``!`` or ``?`` before white space. A known licence sentence
is found in one piece, or in pieces that follow each other, as of wrapped lines: comment signs (the marks of ``SIGNS``
around a line) go, and pieces are joined by a blank; lines without text, with or without comment signs, do not part
them. A sentence has to fill its pieces. It is normalised (outer marks go, ASCII lower case, runs of white space become
one blank) and has to equal the known one; longer ones are tried first. What is known becomes an identifier, the rest a
gap. The identifiers of a document, in order, are then matched against licence rules: sequences of identifiers, tried
in the given order (longer ones first by convention); a rule matches where its identifiers follow each other
directly, without a gap, and a sentence counts for the first rule that takes it.

Everything is built of Spark expressions. Sentence table and rules are parameters held by the program, thus small. Only
texts that hold the longest word of a known sentence are cut, and only pieces that are part of a known sentence
go on. One document's pieces come together in one row, never longer than its text and its places. No rows are lost or capped.

Defined results: null and empty texts, and texts without known sentences, get no row in the matches and an
empty list in the report. Rows are judged one by one (by id and a hash of the text; equal rows count once in
the matches, each in the report). Other columns are not read. A match's place is the number of its first piece.
Sentences with a changeable name in them (``Foo is free software: ...``, a third BSD condition with a company's name) and
words hyphenated at a line end are not known; a BSD licence of which only the start is known is reported as ``BSD``.
Notices of the GNU licences give their version, with ``-only`` or ``-or-later``; one without a version gives ``GPL``. A line that names
an SPDX identifier gives that identifier, or the choice it names (``Apache-2.0 OR MIT``).
"""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from itertools import groupby

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimlake.llm.common import ascii_lower

_MIT = (
    'permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "software"), '
    "to deal in the software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, "
    "and/or sell copies of the software, and to permit persons to whom the software is furnished to do so, subject to the following conditions"
)
_APACHE = 'under the apache license, version 2.0 (the "license"); you may not use this file except in compliance with the license'
_COPY = "you may obtain a copy of the license at"
_GPL = "this program is free software{} you can redistribute it and/or modify it under the terms of the gnu general public license"
_GNU = (
    "this {} is free software{} you can redistribute it and/or modify it under the terms of the gnu {}general public license"
    " as published by the free software foundation{} "
)
_LATER = "either version {} of the license, or (at your option) any later version"
_ONLY = "version {} of the license"
_BSD = "redistribution and use in source and binary forms, with or without modification, are permitted"
_BSD_CLAUSE = _BSD + " provided that the following conditions are met"
_BSD_FIRST = "redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer"
_BSD_BINARY = (
    "redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer"
    " in the documentation and/or other materials provided with the distribution"
)
_BSD_NAMES = (
    "neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products"
    " derived from this software without specific prior written permission"
)
_BSD_AS_IS = (
    'this software is provided by the copyright holders and contributors "as is" and any express or implied warranties, including, but not limited to,'
    " the implied warranties of merchantability and fitness for a particular purpose are disclaimed"
)
_ISC = "permission to use, copy, modify, and{} distribute this software for any purpose with or without fee is hereby granted"
_ISC_NOTICE = ", provided that the above copyright notice and this permission notice appear in all copies"

# Licence identifiers that a line "SPDX-License-Identifier: ..." may name.
SPDX = (
    "0BSD", "AGPL-3.0-only", "AGPL-3.0-or-later", "Apache-2.0", "BSD-2-Clause", "BSD-3-Clause", "BSL-1.0", "CC0-1.0", "CC-BY-4.0", "CC-BY-SA-4.0", "EPL-2.0",
    "GPL-2.0", "GPL-2.0-only", "GPL-2.0-or-later", "GPL-3.0", "GPL-3.0-only", "GPL-3.0-or-later", "ISC", "LGPL-2.1-only", "LGPL-2.1-or-later",
    "LGPL-3.0-only", "LGPL-3.0-or-later", "MIT", "MPL-2.0", "Unlicense", "Zlib", "Apache-2.0 OR MIT", "MIT OR Apache-2.0",
)
# Family, word in the notice, and versions of the GNU licences.
GNU = (("GPL", "", ("2", "3")), ("LGPL", "lesser ", ("2.1", "3")), ("AGPL", "affero ", ("3",)))
SUBJECTS = ("this project", "this software", "this library", "this program", "this code", "this work", "this file", "the code", "the source code")


def _gnu_notices() -> dict[str, str]:
    """Notices of the GNU licences with their versions: of programs, libraries and software, under either punctuation."""
    found = {}
    for family, word, versions in GNU:
        for version in versions:
            name = f"{family.lower()}-{float(version):.1f}"
            for subject, first, second in (("program", ":", ","), ("program", ";", ";"), ("library", ";", ";"), ("library", ":", ","), ("software", ":", ",")):
                start = _GNU.format(subject, first, word, second)
                found[start + _LATER.format(version)] = f"{name}-or-later"
                found[start + _ONLY.format(version)] = f"{name}-only"
    return found


# Sentences of public licences, normalised, and their identifiers. Where a sentence goes on after a colon
# in the same line, so does one of its forms here. Short forms are notices of their own.
SENTENCES = {
    "released under the mit license": "mit-name",
    "licensed under the mit license": "mit-name",
    _MIT: "mit-grant",
    _MIT + ": the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software": "mit-grant",
    _MIT + ": the above copyright notice and this permission notice (including the next paragraph) shall be included in all copies or substantial portions of the software": "mit-grant",
    "permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files": "mit-grant",
    "licensed under the apache license, version 2.0": "apache2-name",
    "licensed " + _APACHE: "apache2-notice",
    "the asf licenses this file to you " + _APACHE: "apache2-notice",
    "you may not use this file except in compliance with the license": "apache2-compliance",
    _COPY: "apache2-copy",
    _COPY + " http://www.apache.org/licenses/license-2.0": "apache2-copy",
    _COPY + " https://www.apache.org/licenses/license-2.0": "apache2-copy",
    "this work is licensed under the gnu general public license, version 3": "gpl3-name",
    **{_GPL.format(sign): "gpl-redistribute" for sign in ":;"},
    **_gnu_notices(),
    "licensed under cc by 4.0": "ccby4-name",
    "licensed under cc by-nc 4.0": "ccbync4-name",
    "licensed under cc by-sa 4.0": "ccbysa4-name",
    _BSD: "bsd-redistribute",
    _BSD_CLAUSE: "bsd-redistribute",
    **{f"{_BSD_CLAUSE}: {sign}": "bsd-redistribute" for sign in ("1", "(1", "a", "(a")},
    **{f"{_BSD_CLAUSE}: {sign}{_BSD_FIRST}": "bsd-redistribute-source" for sign in ("", "* ", "- ", "1) ", "(1) ", "a) ", "(a) ")},
    _BSD_FIRST: "bsd-source",
    **{sign + _BSD_BINARY: "bsd-binary" for sign in ("", "2. ", "2) ", "b. ", "b) ")},
    **{sign + _BSD_NAMES: "bsd-names" for sign in ("", "3. ", "3) ", "c. ", "c) ")},
    _BSD_AS_IS: "bsd-as-is",
    **{_ISC.format(word) + _ISC_NOTICE: "isc-grant" for word in ("", "/or")},
    **{_ISC.format(word): "0bsd-grant" for word in ("", "/or")},
    "this source code form is subject to the terms of the mozilla public license, v. 2.0": "mpl2-notice",
    **{f"if a copy of the mpl was not distributed with this file, you can obtain one at {http}://mozilla.org/mpl/2.0": "mpl2-copy" for http in ("http", "https")},
    "this is free and unencumbered software released into the public domain": "unlicense-name",
    **{f"{who} is licensed under the mit license": "mit-name" for who in SUBJECTS},
    **{f"{who} is licensed under the apache license, version 2.0": "apache2-name" for who in SUBJECTS},
    **{f"spdx-license-identifier: {name.lower()}": f"spdx-{name.lower().replace(' ', '-')}" for name in SPDX},
    "all rights reserved": "rights-reserved",
}
# The ways in which the start of a BSD licence is cut: its first condition in a sentence of its own, or not.
_BSD_STARTS = (("bsd-redistribute", "bsd-source"), ("bsd-redistribute-source",))
#: Rules in the order in which they are tried. Two BSD conditions count as all only if the disclaimer follows them directly.
RULES = (
    ("Apache-2.0", ("apache2-name", "apache2-compliance", "apache2-copy")),
    ("Apache-2.0", ("apache2-name", "apache2-compliance")),
    ("Apache-2.0", ("apache2-notice", "apache2-copy")),
    ("MIT", ("mit-name", "mit-grant")),
    *(("BSD-3-Clause", (*held, *start, "bsd-binary", "bsd-names")) for held in (("rights-reserved",), ()) for start in _BSD_STARTS),
    *(("BSD-2-Clause", (*held, *start, "bsd-binary", "bsd-as-is")) for held in (("rights-reserved",), ()) for start in _BSD_STARTS),
    ("BSD", ("rights-reserved", "bsd-redistribute")),
    ("BSD", ("rights-reserved", "bsd-redistribute-source")),
    ("MPL-2.0", ("mpl2-notice", "mpl2-copy")),
    ("Apache-2.0", ("apache2-name",)),
    ("Apache-2.0", ("apache2-notice",)),
    ("MIT", ("mit-name",)),
    ("MIT", ("mit-grant",)),
    ("GPL-3.0", ("gpl3-name",)),
    ("GPL", ("gpl-redistribute",)),
    *((f"{family}-{float(version):.1f}-{end}", (f"{family.lower()}-{float(version):.1f}-{end}",)) for family, _, versions in GNU for version in versions for end in ("only", "or-later")),
    ("CC-BY-4.0", ("ccby4-name",)),
    ("CC-BY-NC-4.0", ("ccbync4-name",)),
    ("CC-BY-SA-4.0", ("ccbysa4-name",)),
    ("BSD", ("bsd-redistribute",)),
    ("BSD", ("bsd-redistribute-source",)),
    ("ISC", ("isc-grant",)),
    ("0BSD", ("0bsd-grant",)),
    ("MPL-2.0", ("mpl2-notice",)),
    ("Unlicense", ("unlicense-name",)),
    *((name, (f"spdx-{name.lower().replace(' ', '-')}",)) for name in SPDX),
)
SENTENCE_END = r"(?<=[.!?])[\x09-\x0D\x20]+|[\x0A\x0D]+"
MARKS = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]"
#: Marks at either end; a long run of marks within is looked at once, not from each of its characters.
OUTER = rf"^{MARKS}++|(?<!{MARKS}){MARKS}++\z"
#: Comment signs at the start and at the end of a line.
SIGNS, SIGNS_AFTER = r"[\x09-\x0D\x20!#%*/;<>|-]", r"[\x09-\x0D\x20#%*/>|-]"
COMMENT = rf"^{SIGNS}++|(?<!{SIGNS_AFTER}){SIGNS_AFTER}++\z"
#: Where words of a sentence part: a blank, or line ends in the text of a document's pieces.
GAP = r"(?: |\n\d+:)++"
MARKS_IN_LINE = MARKS.replace(r"\x00-", r"\x00-\x09\x0B-")


def normalised(sentence: Column) -> Column:
    """Lower-case, without comment signs and marks around it, single blanks within."""
    return F.regexp_replace(F.regexp_replace(ascii_lower(sentence), OUTER, ""), r"[\x09-\x0D\x20]+", " ")


def longest_words(sentences: Mapping[str, str]) -> str:
    """A pattern that every text with one of the sentences matches, however its lines are wrapped."""
    words = {max(re.split(MARKS, s), key=lambda w: (len(w), w)) for s in sentences}
    return "(?i)" + "|".join(rf"\Q{w}\E" for w in sorted(words))


def pieces(docs: DataFrame, sentences: Mapping[str, str] = SENTENCES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id, text_hash, place, line`` of every piece that may be part of a known sentence; ``line`` is without comment signs."""
    asked = docs.where(F.col(text_col).rlike(longest_words(sentences)))
    cut = asked.select(
        F.col(id_col).alias("id"), F.xxhash64(text_col).alias("text_hash"), F.posexplode(F.split(F.col(text_col), SENTENCE_END, -1)).alias("place", "sentence")
    )
    part = cut.where(F.contains(F.lit("\n".join(sentences)), normalised(F.col("sentence"))))
    line = F.regexp_replace(F.regexp_replace(ascii_lower(F.col("sentence")), COMMENT, ""), r"[\x09-\x0D\x20]+", " ")
    return part.select("id", "text_hash", "place", line.alias("line"))


def known_sentences(docs: DataFrame, sentences: Mapping[str, str] = SENTENCES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id, text_hash, rest``: the identifiers of a document as one text, "<place>:<id> ", and signs "|" for gaps."""
    found = pieces(docs, sentences, id_col, text_col).distinct()
    runs = found.groupBy("id", "text_hash").agg(F.sort_array(F.collect_list(F.struct("place", "line"))).alias("found"))
    # The pieces as lines "<place>:<line>", and a gap sign where places are not neighbours.
    text = F.array_join(
        F.transform("found", lambda x, i: F.concat(
            F.when((i > 0) & (x["place"] != F.element_at("found", F.greatest(i, F.lit(1)))["place"] + 1), F.lit("|\n")).otherwise(F.lit("")),
            x["place"].cast("string"), F.lit(":"), x["line"])), "\n")
    frame = runs.select("id", "text_hash", text.alias("rest"))
    for sentence in sorted(sentences, key=lambda s: (-len(s), s)):
        words = GAP.join(rf"\Q{w}\E" for w in sentence.split(" "))
        name = sentences[sentence].replace("\\", "\\\\").replace("$", "\\$")
        frame = frame.select("id", "text_hash", F.regexp_replace("rest", rf"(?<![^\n])(\d++):{MARKS_IN_LINE}*+{words}{MARKS_IN_LINE}*+(?![^\n])", f"$1={name}").alias("rest"))
    spoken = F.filter(F.split("rest", "\n", -1), lambda x: ~x.rlike(r"^\d+:\z"))  # lines without text do not part sentences
    lines = F.transform(spoken, lambda x: F.when(x.rlike(r"^\d+="), F.regexp_replace(x, r"^(\d+)=", "$1:")).otherwise(F.lit("|")))
    return frame.select("id", "text_hash", F.array_join(lines, " ").alias("rest"))


def license_matches(docs: DataFrame, sentences: Mapping[str, str] = SENTENCES, rules: Sequence = RULES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id, text_hash, license, place, sentences``: a row per match, ``place`` being its first sentence's number."""
    frame = known_sentences(docs, sentences, id_col, text_col).select("id", "text_hash", "rest", F.array().cast("array<struct<license:string,place:int,sentences:int>>").alias("matches"))
    for alone, group in groupby(rules, key=lambda rule: len(rule[1]) == 1):
        if alone:  # rules of one identifier each do not touch one another, so they are tried together
            names: dict[str, str] = {}
            for name, ids in group:
                names.setdefault(ids[0], name)
            pattern = rf"(?<![^ ])(\d+):({'|'.join(rf'\Q{i}\E' for i in names)})(?![^ ])"
            place, which = (F.regexp_extract_all("rest", F.lit(pattern), F.lit(k)) for k in (1, 2))
            known = F.create_map(*[F.lit(x) for pair in names.items() for x in pair])
            matches = _matches(place, F.transform(which, lambda i: F.element_at(known, i)), 1)  # noqa: B023
            frame = frame.select("id", "text_hash", F.regexp_replace("rest", pattern, "|").alias("rest"), F.concat("matches", matches).alias("matches"))
            continue
        for name, ids in group:
            pattern = " ".join(rf"(\d+):\Q{i}\E" if k == 0 else rf"\d+:\Q{i}\E" for k, i in enumerate(ids))
            pattern = rf"(?<![^ ]){pattern}(?![^ ])"
            places = F.regexp_extract_all("rest", F.lit(pattern), F.lit(1))
            matches = _matches(places, F.transform(places, lambda _: F.lit(name)), len(ids))  # noqa: B023
            frame = frame.select("id", "text_hash", F.regexp_replace("rest", pattern, "|").alias("rest"), F.concat("matches", matches).alias("matches"))
    # An inner explode's filter on sizes would be pushed down and evaluate the whole chain once per rule.
    return frame.select("id", "text_hash", F.explode_outer("matches").alias("m")).where("m is not null").select("id", "text_hash", "m.*")


def _matches(places: Column, licenses: Column, sentences: int) -> Column:
    return F.zip_with(places, licenses, lambda place, name: F.struct(name.alias("license"), place.cast("int").alias("place"), F.lit(sentences).alias("sentences")))


def license_report(docs: DataFrame, sentences: Mapping[str, str] = SENTENCES, rules: Sequence = RULES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: ``licenses`` (distinct names, sorted, joined by commas) and ``n_matches``."""
    matches = license_matches(docs, sentences, rules, id_col, text_col)
    per_doc = matches.groupBy(F.col("id").alias("mid"), F.col("text_hash").alias("mhash")).agg(
        F.array_join(F.sort_array(F.collect_set("license")), ",").alias("licenses"), F.count(F.lit(1)).alias("n_matches")
    )
    rows = docs.select(F.col(id_col).alias("id"), F.xxhash64(text_col).alias("text_hash"))
    return rows.join(per_doc, F.col("id").eqNullSafe(F.col("mid")) & (F.col("text_hash") == F.col("mhash")), "left").select(
        F.col("id").alias(id_col), F.coalesce("licenses", F.lit("")).alias("licenses"), F.coalesce("n_matches", F.lit(0)).cast("long").alias("n_matches")
    )
