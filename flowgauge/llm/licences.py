"""Licence scans: known licence sentences give identifiers, and ordered rules read their sequence.

A text is cut into sentences, each is reduced to lower-case ASCII words, and a sentence that is known
gives its identifier. A text is read twice, with sentences that end at line ends and with sentences
that run over line ends; what either reading knows counts, in the order of the text. The place of a
sentence is the number of letters and digits before it, which both readings agree on. Rules are runs of
identifiers, tried in their order at each place of the sequence: the longer licence stands before the
shorter that it contains. "All rights reserved" names a text proprietary only if no licence is found in it.

Short notices, and licence names after ``SPDX-License-Identifier:``, are made by rule from the lists of
licences. Sentences are cut only in texts that hold one of ``SIGNS``; every known sentence holds one of
them, or stands after one that does. Null and empty texts have no sentence. Repeated rows each give a row.
Everything stays in DataFrame functions, one row for each document, without a shuffle.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, functions as F

# Sentences of public licences and notices, by identifier.
SENTENCES = {
    "mit-name": "MIT License",
    "mit-name-the": "The MIT License",
    "mit-notice": "Released under the MIT License.",
    "mit-licensed": "Licensed under the MIT License.",
    "mit-grant": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
                 "associated documentation files (the \"Software\"), to deal in the Software without restriction, "
                 "including without limitation the rights to use, copy, modify, merge, publish, distribute, "
                 "sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is "
                 "furnished to do so, subject to the following conditions",
    "mit-include": "The above copyright notice and this permission notice shall be included in all copies or "
                   "substantial portions of the Software.",
    "mit-as-is": "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT "
                 "NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND "
                 "NONINFRINGEMENT.",
    "isc-grant": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without "
                 "fee is hereby granted, provided that the above copyright notice and this permission notice appear "
                 "in all copies.",
    "apache2-notice": "Licensed under the Apache License, Version 2.0.",
    "apache2-header": "Licensed under the Apache License, Version 2.0 (the \"License\")",
    "apache2-comply": "you may not use this file except in compliance with the License.",
    "apache2-obtain": "You may obtain a copy of the License at",
    "apache2-as-is": "Unless required by applicable law or agreed to in writing, software distributed under the "
                     "License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, "
                     "either express or implied.",
    "gpl3-notice": "This work is licensed under the GNU General Public License, version 3.",
    "gpl2-notice": "This work is licensed under the GNU General Public License, version 2.",
    "lgpl3-notice": "This work is licensed under the GNU Lesser General Public License, version 3.",
    "agpl3-notice": "This work is licensed under the GNU Affero General Public License, version 3.",
    "gpl3-free": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
                 "General Public License as published by the Free Software Foundation, either version 3 of the "
                 "License, or (at your option) any later version.",
    "gpl-hope": "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY",
    "gpl-merchant": "without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.",
    "bsd-redistribution": "Redistribution and use in source and binary forms, with or without modification, are "
                          "permitted provided that the following conditions are met",
    "bsd-source": "Redistributions of source code must retain the above copyright notice, this list of conditions and "
                  "the following disclaimer.",
    "bsd-binary": "Redistributions in binary form must reproduce the above copyright notice, this list of conditions "
                  "and the following disclaimer in the documentation and/or other materials provided with the "
                  "distribution.",
    "bsd-endorse": "Neither the name of the copyright holder nor the names of its contributors may be used to endorse "
                   "or promote products derived from this software without specific prior written permission.",
    "mpl2-notice": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    "cc-by4-notice": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "cc-by-sa4-notice": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International "
                        "License.",
    "cc0-notice": "This work is licensed under the Creative Commons Zero License.",
    "unlicense-free": "This is free and unencumbered software released into the public domain.",
    "epl2-notice": "This program and the accompanying materials are made available under the terms of the Eclipse Public "
                   "License 2.0",
    "boost-notice": "Distributed under the Boost Software License, Version 1.0.",
    "zlib-as-is": "This software is provided 'as-is', without any express or implied warranty.",
    "zlib-grant": "Permission is granted to anyone to use this software for any purpose, including commercial applications, "
                  "and to alter it and redistribute it freely, subject to the following restrictions",
    "bsd-university": "Neither the name of the University nor the names of its contributors may be used to endorse or "
                      "promote products derived from this software without specific prior written permission.",
    "spdx": "SPDX-License-Identifier",
    "reserved": "All rights reserved.",
}

# The GNU licences by name, with their versions and short names.
GNU = [("General Public License", "GPL", ("2", "3")), ("Lesser General Public License", "LGPL", ("2.1", "3")),
       ("Affero General Public License", "AGPL", ("3",))]
# The Creative Commons licences by the words of their names.
COMMONS = {"BY": "Attribution", "BY-SA": "Attribution-ShareAlike", "BY-NC": "Attribution-NonCommercial",
           "BY-ND": "Attribution-NoDerivatives", "BY-NC-SA": "Attribution-NonCommercial-ShareAlike",
           "BY-NC-ND": "Attribution-NonCommercial-NoDerivatives"}
COMMONS_VERSIONS = ("2.0", "2.5", "3.0", "4.0")
COMMONS_KINDS = {"2.0": "Generic", "2.5": "Generic", "3.0": "Unported", "4.0": "International"}
# Other licences by their identifiers.
NAMED = ["MIT", "ISC", "Apache-2.0", "BSD-2-Clause", "BSD-3-Clause", "MPL-2.0", "EPL-2.0", "BSL-1.0", "Zlib", "CC0-1.0", "Unlicense"]

# Runs of identifiers and the licences they stand for, longer before shorter.
RULES = [
    ("mit-name mit-grant mit-include mit-as-is", "MIT"),
    ("mit-grant mit-include mit-as-is", "MIT"),
    ("mit-grant mit-include", "MIT"),
    ("mit-notice", "MIT"),
    ("mit-licensed", "MIT"),
    ("isc-grant", "ISC"),
    ("apache2-header apache2-comply apache2-obtain apache2-as-is", "Apache-2.0"),
    ("apache2-header apache2-comply", "Apache-2.0"),
    ("apache2-notice", "Apache-2.0"),
    ("apache2-header", "Apache-2.0"),
    ("gpl3-free gpl-hope gpl-merchant", "GPL-3.0-or-later"),
    ("gpl3-free", "GPL-3.0-or-later"),
    ("gpl3-notice", "GPL-3.0"),
    ("gpl2-notice", "GPL-2.0"),
    ("lgpl3-notice", "LGPL-3.0"),
    ("agpl3-notice", "AGPL-3.0"),
    ("bsd-redistribution bsd-source bsd-binary bsd-endorse", "BSD-3-Clause"),
    ("bsd-redistribution bsd-source bsd-binary", "BSD-2-Clause"),
    ("mpl2-notice", "MPL-2.0"),
    ("cc-by4-notice", "CC-BY-4.0"),
    ("cc-by-sa4-notice", "CC-BY-SA-4.0"),
    ("cc0-notice", "CC0-1.0"),
    ("unlicense-free", "Unlicense"),
    ("epl2-notice", "EPL-2.0"),
    ("boost-notice", "BSL-1.0"),
    ("zlib-as-is zlib-grant", "Zlib"),
    ("reserved", "Proprietary"),
]


#: One of these is in every known sentence, or before it.
SIGNS = ["licen", "permi", "copyright", "warrant", "redistribut", "conditions", "reserved", "contributors", "public", "released"]
#: Where a sentence ends: at line ends too, or at blank lines only.
AT_LINES, OVER_LINES = r"[.!?;:]+[ \t\r\n]+|[\r\n]+", r"[.!?;:]+[ \t\r\n]+|\n[ \t\r]*\n"
_NOT_WORDS = "[^A-Za-z0-9]+"


def _add(name: str, sentence: str, licence: str) -> None:
    """A sentence that names a licence by itself."""
    if key(sentence) not in {key(x) for x in SENTENCES.values()}:
        SENTENCES[name] = sentence
        RULES.append((name, licence))


def plain(sentence: str) -> str:
    """A sentence as it is looked up."""
    return re.sub(_NOT_WORDS, " ", sentence).strip(" ").lower()


def key(sentence: str) -> str:
    """What a sentence is known by: a stop that white space follows may cut it inside, so the longest part."""
    return max((plain(x) for x in re.split(AT_LINES, sentence)), key=len)


def _made() -> None:
    """Sentences and rules that follow from the lists of licences."""
    spdx = list(NAMED)
    for title, short, versions in GNU:
        for version in versions:
            dotted = version if "." in version else version + ".0"
            terms = (f"you can redistribute it and/or modify it under the terms of the GNU {title} as published by the Free "
                     f"Software Foundation")
            later = f"either version {version} of the License, or (at your option) any later version."
            _add(f"{short.lower()}{version}-free", f"{terms}, {later}", f"{short}-{dotted}-or-later")
            # With a stop before the version these are two sentences.
            SENTENCES[f"{short.lower()}-terms"] = terms
            SENTENCES[f"gnu-either-{version}"] = later
            RULES.append((f"{short.lower()}-terms gnu-either-{version}", f"{short}-{dotted}-or-later"))
            _add(f"{short.lower()}{version}-work", f"This work is licensed under the GNU {title}, version {version}.", f"{short}-{dotted}")
            _add(f"{short.lower()}{version}-short", f"Licensed under the GNU {title} v{dotted}.", f"{short}-{dotted}")
            spdx += [f"{short}-{dotted}-only", f"{short}-{dotted}-or-later"]
    for letters, words in COMMONS.items():
        for version in COMMONS_VERSIONS:
            name = f"CC-{letters}-{version}"
            _add(f"{name}-work", f"This work is licensed under a Creative Commons {words} {version} {COMMONS_KINDS[version]} License.", name)
            for verb in ("Licensed", "Released"):
                _add(f"{name}-{verb.lower()}", f"{verb} under CC {letters} {version}.", name)
            spdx.append(name)
    for licence in spdx:
        SENTENCES[f"spdx:{licence}"] = licence
        RULES.append((f"spdx spdx:{licence}", licence))


_made()

KNOWN = {key(text): name for name, text in SENTENCES.items()}
LICENCE = dict(RULES)
# Longer runs first; rules of one length stay in their order.
ORDERED = sorted(RULES, key=lambda rule: -len(rule[0].split()))
RULE_PATTERN = "|".join(f"(?:^| )(?:{re.escape(ids)})(?= |$)" for ids, _ in ORDERED)


def identifiers(text: Column, ends: str) -> Column:
    """Place and identifier of a text's known sentences."""
    known = F.create_map(*[F.lit(x) for pair in KNOWN.items() for x in pair])
    words = F.transform(F.split(text, ends), lambda s: F.lower(F.btrim(F.regexp_replace(s, _NOT_WORDS, " "))))
    start = F.struct(F.lit(0).alias("place"), F.array().cast("array<struct<place:int,id:string>>").alias("found"))

    def step(state: Column, sentence: Column) -> Column:
        name = F.try_element_at(known, sentence)
        after = state["place"] + F.length(F.replace(sentence, F.lit(" "), F.lit("")))
        found = F.struct(state["place"].alias("place"), name.alias("id"))
        return F.struct(after.alias("place"), F.when(
            name.isNotNull(), F.array_append(state["found"], found)).otherwise(state["found"]).alias("found"))
    return F.aggregate(words, start, step)["found"]


def licences(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """id, n_sentences (known ones), sentence_ids (in their order), licences (of the rules that match, each
    once, in the order of the text) and licence (the first; null if none) of each document."""
    text = F.coalesce(F.col(text_column), F.lit(""))
    lower = F.lower(text)
    sign = F.lit(False)
    for word in SIGNS:
        sign = sign | F.contains(lower, F.lit(word))
    rows = docs.select(F.col(id_column).alias("id"), F.when(sign, text).alias("text"))
    both = F.array_union(identifiers(F.col("text"), AT_LINES), identifiers(F.col("text"), OVER_LINES))
    none = F.array().cast("array<string>")
    read = rows.select("id", F.coalesce(F.transform(F.array_sort(both), lambda x: x["id"]), none).alias("ids"))
    names = F.create_map(*[F.lit(x) for pair in RULES for x in pair])
    matches = F.regexp_extract_all(F.array_join("ids", " "), F.lit(RULE_PATTERN), F.lit(0))
    found = read.select("id", "ids", F.array_distinct(F.transform(
        matches, lambda m: F.try_element_at(names, F.btrim(m)))).alias("found"))
    others = F.array_remove("found", "Proprietary")
    found = found.withColumn("found", F.when(F.size(others) > 0, others).otherwise(F.col("found")))
    return found.select(
        F.col("id").alias(id_column), F.size("ids").cast("long").alias("n_sentences"),
        F.array_join("ids", " ").alias("sentence_ids"), F.array_join("found", " ").alias("licences"),
        F.get("found", F.lit(0)).alias("licence"))


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _in_order(source: str) -> str:
    """SQL: place and identifier of the known sentences of each text by one way of cutting."""
    return f"""SELECT doc_id, place, id FROM (
      SELECT doc_id, s, coalesce(sum(length(replace(s, ' ', ''))) OVER (
        PARTITION BY doc_id ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS place FROM (
        SELECT doc_id, generate_subscripts(parts, 1) AS pos,
               lower(trim(regexp_replace(unnest(parts), '{_NOT_WORDS}', ' ', 'g'), ' ')) AS s
        FROM (SELECT doc_id, regexp_split_to_array(text, {_quoted(source)}) AS parts FROM documents
              WHERE regexp_matches(lower(text), {_quoted("|".join(SIGNS))}))) cut) placed
    JOIN known USING (s)"""


ORACLE = f"""
WITH known(s, id) AS (VALUES {', '.join(f'({_quoted(s)}, {_quoted(i)})' for s, i in KNOWN.items())}),
rules(ids, licence) AS (VALUES {', '.join(f'({_quoted(s)}, {_quoted(i)})' for s, i in RULES)}),
sentences AS ({_in_order(AT_LINES)} UNION {_in_order(OVER_LINES)}),
best AS (SELECT doc_id, string_agg(id, ' ' ORDER BY place, id) AS ids, count(*) AS n FROM sentences GROUP BY doc_id),
matched AS (
  SELECT doc_id, generate_subscripts(m, 1) AS pos, trim(unnest(m), ' ') AS ids FROM (
    SELECT doc_id, regexp_extract_all(ids, {_quoted("|".join(f"(?:^| )(?:{re.escape(ids)})" + chr(92) + "b" for ids, _ in ORDERED))}) AS m FROM best)),
found AS (SELECT doc_id, licence, min(pos) AS pos FROM matched JOIN rules USING (ids) GROUP BY doc_id, licence),
shown AS (SELECT * FROM found f WHERE licence <> 'Proprietary' OR NOT EXISTS (
  SELECT 1 FROM found o WHERE o.doc_id = f.doc_id AND o.licence <> 'Proprietary')),
named AS (SELECT doc_id, string_agg(licence, ' ' ORDER BY pos) AS licences, arg_min(licence, pos) AS licence FROM shown GROUP BY doc_id)
SELECT d.doc_id, coalesce(b.n, 0) AS n_sentences, coalesce(b.ids, '') AS sentence_ids, coalesce(n.licences, '') AS licences, n.licence
FROM documents d LEFT JOIN best b USING (doc_id) LEFT JOIN named n USING (doc_id)
"""
