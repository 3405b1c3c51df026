"""Licence recognition by sentence rules.

A known sentence is found where its normalised words stand between two cuts of a text: line ends, and closing marks
that a blank follows. Wrapped lines, semicolons and colons may also lie inside a sentence; full stops, exclamation and
question marks before a blank, and blank lines, always end one. A text is then a sequence of sentence identifiers, and licences are ordered rules over such sequences: a rule
matches where its identifiers follow one another with no other known sentence between. The first rule
of the list wins at a place; later matches elsewhere are kept too.

The search is one regular expression inside one projection. The known sentences are a parameter whose
number is bounded by the rule book, not by the data, and texts never move. NULL and empty texts
match nothing; repeated rows are judged alike; an empty table stays empty.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# fixed values: sentence identifier and its normalised text (public licence wordings)
SENTENCES = {
    "apache-2-ref": "licensed under the apache license version 2 0",
    "apache-2-not-use": "you may not use this file except in compliance with the license",
    "apache-2-copy": "you may obtain a copy of the license at",
    "bsd-redistribution": "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met",
    "bsd-source": "redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer",
    "bsd-endorse": "neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission",
    "cc-by-4-ref": "licensed under cc by 4 0",
    "cc-by-sa-4-ref": "licensed under cc by sa 4 0",
    "cc-by-nc-4-ref": "licensed under cc by nc 4 0",
    "gpl-2-ref": "this work is licensed under the gnu general public license version 2",
    "gpl-3-ref": "this work is licensed under the gnu general public license version 3",
    "gpl-free": "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 3 of the license or at your option any later version",
    "gpl-hope": "this program is distributed in the hope that it will be useful but without any warranty without even the implied warranty of merchantability or fitness for a particular purpose",
    "mit-ref": "released under the mit license",
    "mit-ref-2": "licensed under the mit license",
    "mit-grant": "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so subject to the following conditions",
    "mit-notice": "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software",
    "reserved": "all rights reserved",
}
# fixed values: rule (a licence identifier) and its sentence sequence, in order of precedence
RULES = (
    ("MIT", ("mit-grant", "mit-notice")),
    ("MIT", ("mit-ref",)),
    ("MIT", ("mit-ref-2",)),
    ("Apache-2.0", ("apache-2-ref", "apache-2-not-use", "apache-2-copy")),
    ("Apache-2.0", ("apache-2-ref",)),
    ("BSD-3-Clause", ("bsd-redistribution", "bsd-source", "bsd-endorse")),
    ("BSD-2-Clause", ("bsd-redistribution", "bsd-source")),
    ("GPL-3.0-or-later", ("gpl-free", "gpl-hope")),
    ("GPL-3.0-only", ("gpl-3-ref",)),
    ("GPL-2.0-only", ("gpl-2-ref",)),
    ("CC-BY-NC-4.0", ("cc-by-nc-4-ref",)),
    ("CC-BY-SA-4.0", ("cc-by-sa-4-ref",)),
    ("CC-BY-4.0", ("cc-by-4-ref",)),
    ("Proprietary", ("reserved",)),
)
# fixed values: further public wordings of a sentence
WORDINGS = (
    ("apache-2-ref", 'Licensed under the Apache License, Version 2.0 (the "License")'),
    ("apache-2-ref", 'The ASF licenses this file to you under the Apache License, Version 2.0 (the "License")'),
    ("apache-2-copy", "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0"),
    ("apache-2-copy", "You may obtain a copy of the License at https://www.apache.org/licenses/LICENSE-2.0"),
    ("cc-by-4-ref", "This work is licensed under CC BY 4.0"),
    ("cc-by-4-ref", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
    ("cc-by-sa-4-ref", "This work is licensed under CC BY-SA 4.0"),
    ("cc-by-sa-4-ref", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License"),
    ("cc-by-nc-4-ref", "This work is licensed under CC BY-NC 4.0"),
    ("cc-by-nc-4-ref", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License"),
)
# cuts no sentence runs across, and cuts that may end a sentence or lie inside one
HARD_CUT = r"[.!?][\x20\x09-\x0D]+|\n[\x20\x09-\x0D]*\n"
SOFT_CUT = r"[;:][\x20\x09-\x0D]+|\n"
HARD, SOFT = "\x02", "\x01"
OTHER = r"[^a-z0-9]+"


def plain(wording: str) -> str:
    """A wording as lower-case ASCII letters and digits, everything else one space."""
    return re.sub(OTHER, " ", wording.lower()).strip()


def marked(text: Column) -> Column:
    """Lower-case ASCII letters and digits, a mark per cut, everything else one space."""
    free = F.translate(F.lower(F.coalesce(text, F.lit(""))), SOFT + HARD, "  ")
    cut = F.regexp_replace(F.regexp_replace(free, HARD_CUT, HARD), SOFT_CUT, SOFT)
    return F.regexp_replace(cut, r"[^a-z0-9\x01\x02]+", " ")


def sentence_ids(text: Column, known: dict[str, str]) -> Column:
    """Identifiers of the known normalised sentences of a text, in order."""
    # the longest first: a sentence may go on behind a cut at which another one ends
    bodies = "|".join(s.replace(" ", r"[\x20\x01]+") for s in sorted(known, key=len, reverse=True))
    pattern = rf"(?:^|[\x01\x02])\x20?(?:{bodies})(?=\x20?(?:[\x01\x02]|\z))"
    found = F.regexp_extract_all(marked(text), F.lit(pattern), 0)
    names = F.create_map(*[F.lit(x) for s, i in known.items() for x in (s, i)])
    return F.transform(found, lambda s: F.element_at(names, F.trim(F.regexp_replace(s, r"[\x20\x01\x02]+", " "))))


def licences(
    docs: DataFrame,
    text: str = "text",
    sentences: dict[str, str] | None = None,
    rules: tuple = RULES,
    wordings: tuple = WORDINGS,
) -> DataFrame:
    """``sentences`` are normalised, ``wordings`` further ones as they are written. Packs each row into ``_row`` and adds ``sentence_ids`` and ``licences`` (distinct, in rule order)
    as arrays. A matched sequence is consumed, so a shorter rule for its first sentence does not fire again."""
    sentences = SENTENCES if sentences is None else sentences
    known = {s: i for i, s in sentences.items()} | {plain(w): i for i, w in wordings if i in sentences}
    own = [F.col(f"`{c}`") for c in docs.columns]
    step = docs.select(F.struct(*own).alias("_row"), F.col(f"`{text}`").alias("_text"))
    step = step.withColumn("sentence_ids", sentence_ids(F.col("_text"), known)).drop("_text")
    # identifiers between bars: a rule matches as text, and its match is replaced by a rule mark
    line = F.concat(F.lit("|"), F.array_join("sentence_ids", "||"), F.lit("|"))
    for k, (_, parts) in enumerate(rules):
        line = F.replace(line, F.lit("".join(f"|{p}|" for p in parts)), F.lit(f"<{k}>"))
    step = step.withColumn("_line", F.when(F.size("sentence_ids") > 0, line).otherwise(F.lit("")))
    found = [F.when(F.contains("_line", F.lit(f"<{k}>")), F.lit(name)) for k, (name, _) in enumerate(rules)]
    step = step.withColumn("licences", F.array_distinct(F.array_compact(F.array(*found))))
    return step.drop("_line")
