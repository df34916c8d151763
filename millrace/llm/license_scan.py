"""Licence recognition by sentence rules, with DataFrame operations only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Sentences of public licence texts and notices, as their authors write them.
TEXTS = {
    "mit-grant": 'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions',
    "mit-notice": "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software",
    "mit-warranty": 'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT',
    "isc-grant": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies",
    "isc-grant-and": "Permission to use, copy, modify, and distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies",
    "isc-warranty": 'THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS',
    "bsd-grant": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
    "bsd-source": "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer",
    "bsd-binary": "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution",
    "bsd-names": "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission",
    "bsd-warranty": 'THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED',
    "apache-grant": 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License',
    "apache-unless": 'Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied',
    "apache-title": "Apache License Version 2.0, January 2004 http://www.apache.org/licenses/",
    "gpl2-grant": "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version",
    "gpl2-only": "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License version 2 as published by the Free Software Foundation",
    "gpl2-title": "GNU GENERAL PUBLIC LICENSE Version 2, June 1991",
    "gpl3-grant": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version",
    "gpl3-title": "GNU GENERAL PUBLIC LICENSE Version 3, 29 June 2007",
    "lgpl21-grant": "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version",
    "lgpl21-title": "GNU LESSER GENERAL PUBLIC LICENSE Version 2.1, February 1999",
    "lgpl3-grant": "This library is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version",
    "lgpl3-program": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version",
    "lgpl3-title": "GNU LESSER GENERAL PUBLIC LICENSE Version 3, 29 June 2007",
    "agpl3-grant": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version",
    "agpl3-title": "GNU AFFERO GENERAL PUBLIC LICENSE Version 3, 19 November 2007",
    "mpl2-grant": "This Source Code Form is subject to the terms of the Mozilla Public License, v",
    "mpl2-copy": "If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/",
    "mpl2-copy-https": "If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/",
    "mpl2-title": "Mozilla Public License Version 2.0",
    "epl2-grant": "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 which is available at https://www.eclipse.org/legal/epl-2.0/",
    "epl2-grant-http": "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 which is available at http://www.eclipse.org/legal/epl-2.0",
    "epl2-title": "Eclipse Public License - v 2.0",
    "cc0-grant": "To the extent possible under law, the author(s) have dedicated all copyright and related and neighboring rights to this software to the public domain worldwide",
    "cc0-title": "CC0 1.0 Universal",
    "unlicense-grant": "This is free and unencumbered software released into the public domain",
    "cc-by": "This work is licensed under a Creative Commons Attribution 4.0 International License",
    "cc-by-sa": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License",
    "cc-by-nc": "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License",
    "cc-by-nc-sa": "This work is licensed under a Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International License",
    "cc-by-nd": "This work is licensed under a Creative Commons Attribution-NoDerivatives 4.0 International License",
    "reserved": "All rights reserved",
}
#: A licence's names in short statements, and its SPDX identifiers.
NAMES = {
    "apache-2.0": (("Apache License, Version 2.0", "Apache License 2.0", "Apache 2.0 License"), ("Apache-2.0",)),
    "mit": (("MIT License", "MIT license terms"), ("MIT",)),
    "isc": (("ISC License",), ("ISC",)),
    "bsd-3-clause": (("BSD 3-Clause License", "3-clause BSD License"), ("BSD-3-Clause",)),
    "bsd-2-clause": (("BSD 2-Clause License", "2-clause BSD License"), ("BSD-2-Clause",)),
    "gpl-2.0": (("GNU General Public License version 2", "GNU General Public License v2.0", "GPLv2"), ("GPL-2.0", "GPL-2.0-only", "GPL-2.0-or-later", "GPL-2.0+")),
    "gpl-3.0": (("GNU General Public License version 3", "GNU General Public License v3.0", "GPLv3"), ("GPL-3.0", "GPL-3.0-only", "GPL-3.0-or-later", "GPL-3.0+")),
    "lgpl-2.1": (("GNU Lesser General Public License version 2.1", "LGPLv2.1"), ("LGPL-2.1", "LGPL-2.1-only", "LGPL-2.1-or-later", "LGPL-2.1+")),
    "lgpl-3.0": (("GNU Lesser General Public License version 3", "LGPLv3"), ("LGPL-3.0", "LGPL-3.0-only", "LGPL-3.0-or-later")),
    "agpl-3.0": (("GNU Affero General Public License version 3", "AGPLv3"), ("AGPL-3.0", "AGPL-3.0-only", "AGPL-3.0-or-later")),
    "mpl-2.0": (("Mozilla Public License 2.0", "Mozilla Public License, version 2.0"), ("MPL-2.0",)),
    "epl-2.0": (("Eclipse Public License 2.0", "Eclipse Public License v2.0"), ("EPL-2.0",)),
    "cc0-1.0": (("CC0 1.0", "CC0 1.0 Universal"), ("CC0-1.0",)),
    "unlicense": (("Unlicense",), ("Unlicense",)),
    "cc-by-4.0": (("CC BY 4.0",), ("CC-BY-4.0",)),
    "cc-by-sa-4.0": (("CC BY-SA 4.0",), ("CC-BY-SA-4.0",)),
    "cc-by-nc-4.0": (("CC BY-NC 4.0",), ("CC-BY-NC-4.0",)),
    "cc-by-nc-sa-4.0": (("CC BY-NC-SA 4.0",), ("CC-BY-NC-SA-4.0",)),
    "cc-by-nd-4.0": (("CC BY-ND 4.0",), ("CC-BY-ND-4.0",)),
}
#: How a short statement names a licence.
STATEMENTS = (
    "Licensed under the {}", "Licensed under {}", "Released under the {}", "Released under {}", "Distributed under the {}", "This work is licensed under the {}",
    "This project is licensed under the {}", "This software is licensed under the {}", "This program is licensed under the {}", "SPDX-License-Identifier: {}",
)
#: Rules over texts. Each group is a family of licences whose texts share sentences; in
#: order, the first rule of a family that fits names it. A rule's sentences must occur in this order,
#: other known sentences between them allowed.
FAMILIES = (
    (("apache-2.0", ("apache-grant", "apache-unless")), ("apache-2.0", ("apache-grant",)), ("apache-2.0", ("apache-title",))),
    (("mit", ("mit-grant", "mit-notice", "mit-warranty")), ("mit", ("mit-grant", "mit-warranty"))),
    (("isc", ("isc-grant", "isc-warranty")), ("isc", ("isc-grant-and", "isc-warranty"))),
    (("bsd-3-clause", ("bsd-grant", "bsd-source", "bsd-binary", "bsd-names")), ("bsd-2-clause", ("bsd-grant", "bsd-source", "bsd-binary", "bsd-warranty"))),
    (("gpl-3.0", ("gpl3-grant",)), ("gpl-3.0", ("gpl3-title",))),
    (("gpl-2.0", ("gpl2-grant",)), ("gpl-2.0", ("gpl2-only",)), ("gpl-2.0", ("gpl2-title",))),
    (("lgpl-3.0", ("lgpl3-grant",)), ("lgpl-3.0", ("lgpl3-program",)), ("lgpl-3.0", ("lgpl3-title",))),
    (("lgpl-2.1", ("lgpl21-grant",)), ("lgpl-2.1", ("lgpl21-title",))),
    (("agpl-3.0", ("agpl3-grant",)), ("agpl-3.0", ("agpl3-title",))),
    (("mpl-2.0", ("mpl2-grant", "mpl2-copy")), ("mpl-2.0", ("mpl2-grant", "mpl2-copy-https")), ("mpl-2.0", ("mpl2-title",))),
    (("epl-2.0", ("epl2-grant",)), ("epl-2.0", ("epl2-grant-http",)), ("epl-2.0", ("epl2-title",))),
    (("cc0-1.0", ("cc0-grant",)), ("cc0-1.0", ("cc0-title",))),
    (("unlicense", ("unlicense-grant",)),),
    (("cc-by-nc-sa-4.0", ("cc-by-nc-sa",)), ("cc-by-nc-4.0", ("cc-by-nc",)), ("cc-by-sa-4.0", ("cc-by-sa",)), ("cc-by-nd-4.0", ("cc-by-nd",)), ("cc-by-4.0", ("cc-by",))),
)
#: Each known sentence holds one of these; what lacks them is not looked up.
ANCHORS = r"(?i)licen[sc]|rights|permission|software|redistribut|mozilla|mpl|eclipse|cc0|gpl|released|distributed"
#: Between sentences: a full stop, question or exclamation mark before white space, and what ends a
#: paragraph or opens a numbered item. BY_LINE takes each line end too; else a line end is a space.
BY_PARAGRAPH = r"[.!?]+[ \t\r\n]+|:[ \t\r]*\n|\n[ \t\r#*;%/-]*\n|\n[ \t]*(?:[0-9]{1,2}|[a-z])[.)][ \t]+"
BY_LINE = r"\n|[.!?]+[ \t\r]+"


def plain(sentence: str) -> str:
    """normalise() of a constant."""
    kept = "".join(c if c in "abcdefghijklmnopqrstuvwxyz0123456789" else " " for c in sentence.lower())
    return " ".join(kept.split())


def sentence_table() -> dict[str, int]:
    """Identifier of each normalised known sentence: texts first, then short statements by rule."""
    out: dict[str, int] = {}
    stated = [form.format(n) for names, spdx in NAMES.values() for form in STATEMENTS for n in (spdx if form.startswith("SPDX") else names)]
    for sentence in (*TEXTS.values(), *stated):
        out.setdefault(plain(sentence), len(out) + 1)
    return out


def rule_table() -> tuple[tuple[tuple[str, tuple[int, ...]], ...], ...]:
    """Families of ordered (licence, identifiers): FAMILIES, each licence's short statements, and last
    that all rights are reserved."""
    known = sentence_table()
    texts = [tuple((name, tuple(known[plain(TEXTS[k])] for k in keys)) for name, keys in family) for family in FAMILIES]
    stated = []
    for name, (names, spdx) in NAMES.items():
        forms = [form.format(n) for form in STATEMENTS for n in (spdx if form.startswith("SPDX") else names)]
        stated.append(tuple((name, (known[plain(f)],)) for f in forms))
    return (*texts, *stated, (("proprietary", (known[plain(TEXTS["reserved"])],)),))


SENTENCES = sentence_table()
RULES = rule_table()


def normalise(sentence: Column) -> Column:
    """Lower case, every run of anything but a-z and 0-9 one space, trimmed."""
    return F.trim(F.regexp_replace(F.lower(sentence), r"[^a-z0-9]+", " "))


def sentence_ids(text: Column, split: str, sentences: dict[str, int]) -> Column:
    """Identifiers of the known sentences of a text, in order."""
    known = F.create_map(*[F.lit(x) for kv in sentences.items() for x in kv])
    parts = F.transform(F.filter(F.split(text, split), lambda s: s.rlike(ANCHORS)), lambda s: F.try_element_at(known, normalise(s)))
    return F.when(text.rlike(ANCHORS), F.filter(parts, lambda x: x.isNotNull())).otherwise(F.array().cast("array<int>"))


def _fits(seq: Column, family) -> Column:
    """The first licence of a family whose rule fits a sequence written as ,1,2,"""
    found = F.lit(None).cast("string")
    for name in dict.fromkeys(n for n, _ in reversed(family)):
        found = F.when(seq.rlike("|".join(_pattern(ids) for n, ids in family if n == name)), F.lit(name)).otherwise(found)
    return found


def _pattern(ids: tuple[int, ...]) -> str:
    return "," + "(?:[0-9]+,)*".join(f"{i}," for i in ids)


def scan_licenses(docs: DataFrame, sentences: dict[str, int] | None = None, rules=None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The licences that each row's text states.

    A text is split into sentences, each normalised and mapped to its identifier; what is left is a
    sequence of known identifiers. It is read in two ways, since notices stand on a line of their own
    or are wrapped (also behind comment signs): each line end parts sentences, or only ends of
    paragraphs and list items do. Ordered rules are tried on both sequences; of a family of licences
    whose texts share sentences the first that fits counts. All of it happens in the row, without
    shuffle, join or Python.

    Null and empty texts, and texts without a known sentence, give empty sequences and licences and a
    null licence. Very long texts are read whole. Repeated rows each get their result. An empty table
    gives no rows. Other input columns are ignored.

    Returns id_col, sentence_ids and wrapped_ids string (both sequences, joined by commas),
    n_sentences int (of the first), license string (the first licence in rule order), licenses string
    (all, in rule order, joined by commas).
    """
    sentences, rules = sentences or SENTENCES, rules or RULES
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    both = {"sentence_ids": BY_LINE, "wrapped_ids": BY_PARAGRAPH}
    rows = docs.select(F.col(id_col).alias("_id"), *[F.concat_ws(",", sentence_ids(text, split, sentences).cast("array<string>")).alias(n) for n, split in both.items()])
    seq = F.concat(F.lit(","), F.col("sentence_ids"), F.lit(",|,"), F.col("wrapped_ids"), F.lit(","))
    found = F.filter(F.array_distinct(F.array(*[_fits(F.col("_seq"), family) for family in rules])), lambda x: x.isNotNull())
    rows = rows.withColumn("_seq", seq).withColumn("_found", F.when(F.length("_seq") > 5, found).otherwise(F.array().cast("array<string>")))
    n = F.when(F.col("sentence_ids") == "", 0).otherwise(F.size(F.split("sentence_ids", ",")))
    return rows.select(
        F.col("_id").alias(id_col), "sentence_ids", "wrapped_ids", n.cast("int").alias("n_sentences"),
        F.try_element_at("_found", F.lit(1)).alias("license"), F.array_join("_found", ",").alias("licenses"),
    )


def oracle() -> str:
    """The same by DuckDB, written on its own."""
    quote = lambda s: "'" + s.replace("'", "''") + "'"
    known = ", ".join(f"({quote(k)}, {v})" for k, v in SENTENCES.items())
    cases = []
    for family in RULES:
        when = " ".join(f"WHEN regexp_matches(a, '{_pattern(ids)}') OR regexp_matches(b, '{_pattern(ids)}') THEN {quote(n)}" for n, ids in family)
        cases.append(f"CASE {when} END")
    parts = lambda split: f"""SELECT doc_id, generate_subscripts(p, 1) AS pos, unnest(p) AS s FROM (SELECT doc_id, regexp_split_to_array(coalesce(text, ''), '{split}') AS p FROM documents)"""
    ids = lambda part: f"""SELECT doc_id, string_agg(id, ',' ORDER BY pos) AS ids, count(*) AS n FROM ({part}) x JOIN known ON known.s = trim(regexp_replace(lower(x.s), '[^a-z0-9]+', ' ', 'g')) GROUP BY doc_id"""
    return f"""
WITH known(s, id) AS (VALUES {known}),
l AS ({ids(parts(BY_LINE))}),
w AS ({ids(parts(BY_PARAGRAPH))}),
d AS (SELECT d.doc_id, coalesce(l.ids, '') AS x, coalesce(w.ids, '') AS y, coalesce(l.n, 0) AS n FROM documents d LEFT JOIN l USING (doc_id) LEFT JOIN w USING (doc_id)),
s AS (SELECT *, ',' || x || ',' AS a, ',' || y || ',' AS b FROM d),
f AS (SELECT *, list_filter([{", ".join(cases)}], lambda c: c IS NOT NULL) AS found FROM s WHERE x <> '' OR y <> ''),
o AS (SELECT *, list_filter(found, lambda c, i: list_position(found, c) = i) AS names FROM f)
SELECT s.doc_id, s.x AS sentence_ids, s.y AS wrapped_ids, CAST(s.n AS INTEGER) AS n_sentences, names[1] AS license, coalesce(array_to_string(names, ','), '') AS licenses FROM s LEFT JOIN o USING (doc_id)"""
