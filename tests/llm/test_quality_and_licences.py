"""Line-first cleaning and licence sentences against plain Python."""

from __future__ import annotations

import re
import textwrap

from meterlake.llm import licences, quality_rules

GOOD = "The river runs past the mill, and the mill turns slowly. Nobody hurries there; the day is long.\n"
CAPS = " ".join(["SHOUT!!"] * 1 + [f"LOUD{i}!!" for i in range(20)])
NAV = "Home | About | News | Contact | Help"


def repeated_words(text: str, width: int = 8) -> int:
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    spots: dict = {}
    for i in range(len(words) - width + 1):
        spots.setdefault(tuple(words[i : i + width]), []).append(i)
    covered = {p for own in spots.values() if len(own) > 1 for i in own for p in range(i, i + width)}
    return len(covered)


TEXTS = [
    GOOD * 2,
    GOOD + NAV + "\n" + GOOD.replace("mill", "barn"),
    CAPS,
    None,
    "",
    " \n\t ",
    "one two three four five six seven eight nine " * 40,
    ("a b c d e f g h i j. " + "k l m n o p q r s t u v. " + "a b c d e f g h i j. ") + "w. x, y. z. " * 5,
    "w x \x1c y\x0bz " * 9,
    " ".join(f"w{i % 977}" for i in range(30000)) + ".",
]


def test_base_counts_match_plain_python(docs_of):
    rows = [(i, t, "s") for i, t in enumerate(TEXTS)] + [(0, TEXTS[0], "s"), (None, TEXTS[1], None)]
    got = quality_rules.clean_lines(docs_of(rows)).select("_row.*", *quality_rules.COUNTS, "base_failed", "kept").collect()
    assert len(got) == len(rows)
    for r in got:
        text = r["text"] or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
        assert r["n_words"] == len(words)
        assert r["word_chars"] == sum(map(len, words))
        assert r["n_symbols"] == sum(c in "#*$%&|<>" for c in text)
        assert r["n_dup_lines"] == len(lines) - len(set(lines))
        assert r["n_repeat_words"] == repeated_words(text)
        failed = len(words) < 20 or 100 * repeated_words(text) > 30 * len(words)
        assert r["base_failed"] == failed
        assert not (failed and r["kept"])


def test_lines_are_removed_and_heavy_losses_rejected(docs_of):
    unlike = "Rain fell on the hills before dawn, and the shepherd closed the gate behind the last of the sheep.\n" * 1
    rows = [(1, GOOD + unlike + NAV, "s"), (2, GOOD + unlike, "s"), (3, unlike + CAPS, "s")]
    got = {r["doc_id"]: r for r in quality_rules.clean_lines(docs_of(rows)).select("_row.doc_id", "cleaned", "kept", "n_bad_lines").collect()}
    assert got[1]["kept"] and NAV not in got[1]["cleaned"] and got[1]["n_bad_lines"] == 1
    assert got[2]["kept"] and got[2]["cleaned"] == GOOD + unlike
    assert not got[3]["kept"]


def test_filtering_on_the_verdict_keeps_the_plan_small(docs_of):
    assert quality_rules.clean_lines(docs_of([(1, GOOD * 2, "s")])).filter("kept").count() in (0, 1)


def test_empty_tables(docs_of):
    assert quality_rules.clean_lines(docs_of([])).count() == 0
    assert licences.licences(docs_of([])).count() == 0


def test_ordered_rules_consume_their_sentences(docs_of):
    mit = "Permission is hereby granted, free of charge, to any person obtaining a copy"
    rows = [
        (1, "Some words.\nLicensed under the Apache License, Version 2.0. More words.", "s"),
        (2, "Licensed under the Apache License, Version 2.0.\nYou may not use this file except in compliance with the License.\nYou may obtain a copy of the License at", "s"),
        (3, "Released under the MIT license! All rights reserved.", "s"),
        (4, mit, "s"),
        (5, None, "s"),
        (6, "", None),
    ]
    got = {r["doc_id"]: (r["sentence_ids"], r["licences"]) for r in licences.licences(docs_of(rows)).select("_row.doc_id", "sentence_ids", "licences").collect()}
    assert got[1] == (["apache-2-ref"], ["Apache-2.0"])
    assert got[2][1] == ["Apache-2.0"] and len(got[2][0]) == 3
    assert got[3] == (["mit-ref", "reserved"], ["MIT", "Proprietary"])
    assert got[4] == ([], []) and got[5] == ([], []) and got[6] == ([], [])


# public wordings by licence
PUBLIC = {
    "Apache-2.0": """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at

    http://www.apache.org/licenses/LICENSE-2.0""",
    "MIT": """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.""",
    "BSD-2-Clause": """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.""",
    "GPL-3.0-or-later": """This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.

This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the GNU General Public License for more details.""",
    "GPL-3.0-only": "This work is licensed under the GNU General Public License version 3.",
    "GPL-2.0-only": "This work is licensed under the GNU General Public License, version 2.",
    "CC-BY-NC-4.0": "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    "CC-BY-SA-4.0": "This work is licensed under CC BY-SA 4.0.",
    "CC-BY-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "Proprietary": "All rights reserved.",
}
PUBLIC["BSD-3-Clause"] = PUBLIC["BSD-2-Clause"] + """

3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission."""


def wrapped(text: str, width: int, prefix: str) -> str:
    return "\n".join(prefix + line for part in text.split("\n") for line in (textwrap.wrap(part, width) or [""]))


def test_wrapped_public_wordings_are_found(docs_of):
    shapes = [(width, prefix) for width in (24, 72, 9999) for prefix in ("", "# ", " * ")]
    rows = [(k, wrapped(text, *shape), name) for k, (shape, (name, text)) in enumerate((s, p) for s in shapes for p in PUBLIC.items())]
    rows += [(1000 + i, r[1].replace("\n", "\r\n"), r[2]) for i, r in enumerate(rows)]
    got = licences.licences(docs_of(rows)).select("_row.source", "licences").collect()
    assert [r for r in got if r["licences"] != [r["source"]]] == []


def test_a_cut_ends_a_sentence_or_lies_in_it(docs_of):
    rows = [
        (1, "Title\nAll rights reserved\nby nobody", "s"),
        (2, "Released under\nthe MIT License; all rights\nreserved", "s"),
        (3, "Released under the\n\nMIT license", "s"),
        (4, "Released under. The MIT license", "s"),
        (5, "It was released under the MIT license", "s"),
        (6, "Released\x01under\x02the MIT license\nall rights reserved", "s"),
    ]
    got = {r["doc_id"]: r["sentence_ids"] for r in licences.licences(docs_of(rows)).select("_row.doc_id", "sentence_ids").collect()}
    assert got == {1: ["reserved"], 2: ["mit-ref", "reserved"], 3: [], 4: [], 5: [], 6: ["mit-ref", "reserved"]}
