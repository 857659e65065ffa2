from flowgauge.llm import licences as lic
from tests.llm.conftest import make

MIT = """MIT License

Copyright (c) 2020 Somebody

Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR
IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY,
FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL
"""


def test_every_sentence_has_a_sign():
    alone = lambda ids: any(sign in lic.plain(lic.SENTENCES[i]) for i in ids.split() for sign in lic.SIGNS)
    assert all(alone(ids) for ids, _ in lic.RULES)
    assert len(lic.KNOWN) == len(lic.SENTENCES)
    assert {i for ids, _ in lic.RULES for i in ids.split()} <= set(lic.SENTENCES)


def found(spark, *texts):
    rows = lic.licences(make(spark, list(enumerate(texts)))).orderBy("doc_id").collect()
    return [(r.licences, r.licence, r.n_sentences) for r in rows]


def test_rules(spark):
    bsd = " ".join(lic.SENTENCES[k] + (":" if k == "bsd-redistribution" else "") for k in (
        "bsd-redistribution", "bsd-source", "bsd-binary"))
    assert found(
        spark, MIT, "Words.\nReleased under the MIT License.", "junk***\nLicensed under the Apache License, Version 2.0.",
        bsd, bsd + " " + lic.SENTENCES["bsd-endorse"], "You may obtain a copy of the License at", "",
        "Released under the MIT License.\nAll rights reserved.\nReleased under the MIT License.",
    ) == [("MIT", "MIT", 4), ("MIT", "MIT", 1), ("Apache-2.0", "Apache-2.0", 1), ("BSD-2-Clause", "BSD-2-Clause", 3),
          ("BSD-3-Clause", "BSD-3-Clause", 4), ("", None, 1), ("", None, 0), ("MIT", "MIT", 3)]


def test_made_rules(spark):
    gpl2 = ("This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public "
            "License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any "
            "later version.")
    texts = ["Licensed under CC BY-NC 4.0.", "Released under CC BY-SA 3.0.\nWords.", "// SPDX-License-Identifier: Apache-2.0\nint x;",
             "# SPDX-License-Identifier: GPL-2.0-or-later\n", "MIT\nApache-2.0\nand a licence",
             "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
             "This work is licensed under the GNU Lesser General Public License, version 2.1.", gpl2,
             "Copyright (c) 2020. All rights reserved.\n" + " ".join(lic.SENTENCES[k] + (":" if k == "bsd-redistribution" else "")
                                                                    for k in ("bsd-redistribution", "bsd-source", "bsd-binary")),
             "Copyright 2020. All rights reserved."]
    assert [x[1] for x in found(spark, *texts)] == [
        "CC-BY-NC-4.0", "CC-BY-SA-3.0", "Apache-2.0", "GPL-2.0-or-later", None, "CC-BY-NC-4.0", "LGPL-2.1", "GPL-2.0-or-later",
        "BSD-2-Clause", "Proprietary"]


def test_both_readings_count_in_the_order_of_the_text(spark):
    # The first sentence ends at a line end without a stop, the second runs over a line end.
    text = "MIT License\nWords here.\nThis work is licensed under the GNU General Public\nLicense, version 3. Released under the MIT License."
    rows = lic.licences(make(spark, [(1, text)])).collect()
    assert [(r.sentence_ids, r.licences) for r in rows] == [("mit-name gpl3-notice mit-notice", "GPL-3.0 MIT")]


def test_no_sentence_of_the_table_that_speaks_of_a_licence_is_unknown(spark, sf):
    import re

    from flowgauge.llm.tables import table

    docs = {r.doc_id: r.text or "" for r in table(spark, sf, "documents").collect()}
    want = {}
    for i, text in docs.items():
        for line in text.split("\n"):
            for m in re.finditer(r"(?:[Ll]icensed|[Rr]eleased) under (?:the )?([A-Z][^.\n]*(?:\.[0-9][^.\n]*)?)\.", line):
                want.setdefault(i, []).append(m[1])
    got = {r.doc_id: r.licences for r in lic.licences(table(spark, sf, "documents")).collect()}
    assert want and all(got[i] for i in want)
    words = {"MIT": "MIT", "Apache": "Apache", "GNU": "GPL", "CC": "CC"}
    assert all(any(words[name.split()[0]] in got[i] for name in names) for i, names in want.items())


def test_messy_rows(messy, no_rows):
    assert {r.licences for r in lic.licences(messy).collect()} == {""}
    assert lic.licences(messy).count() == messy.count()
    assert lic.licences(no_rows).count() == 0
