from cataloom.llm import licences
from cataloom.llm.queries import op9_licences


def scan(make, rows):
    return {r["doc_id"]: (r["n_sentences"], r["sentence_ids"], r["licences"]) for r in licences.scan_licences(make(rows)).collect()}


def brute_ids(text):
    import re

    out = []
    for s in re.split(r"[\n\r]+|[.!?;]+(?=\s|$)", text or ""):
        key = " ".join("".join(c if c.isalnum() else " " for c in s.lower()).split())
        if key in licences.SENTENCES:
            out.append(licences.SENTENCES[key])
    return out


def test_query_table_against_brute_force(spark, documents):
    sf = "/root/testdata/sf0.01"
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    rows = op9_licences(spark, sf).collect()
    assert len(rows) == len(texts) and any(r["licences"] for r in rows)
    for r in rows:
        ids = brute_ids(texts[r["doc_id"]])
        assert r["sentence_ids"] == ",".join(ids) and r["n_sentences"] == len(ids)
        assert bool(ids) == bool(r["licences"])


def test_rules_follow_the_order(make):
    a, b = "Licensed under the Apache License, Version 2.0.", "You may not use this file except in compliance with the License."
    mit = "Released under the MIT License."
    got = scan(make, [(1, f"x. {a}\n{b} y"), (2, f"{b} {a}"), (3, f"{a} {mit} {b}"), (4, f"{a} {mit} {mit} {b}"), (5, f"  {mit.upper()}"), (6, "MIT License"), (7, f"{a} {a} {b}"), (8, f"// {mit}\r\n")])
    assert got[1][2] == "Apache-2.0 (full header)" and got[2][2] == "Apache-2.0"
    assert got[3][2] == "Apache-2.0 (full header),MIT" and got[4][2] == "Apache-2.0,MIT"
    assert got[5] == (1, "mit-notice", "MIT") and got[6] == (0, "", "") and got[8][2] == "MIT"
    assert got[7][0] == 3 and "Apache-2.0 (full header)" in got[7][2]


def test_edge_cases(make, edge):
    assert licences.scan_licences(make(edge)).count() == len(edge)
    assert {r["n_sentences"] for r in licences.scan_licences(make(edge)).collect()} == {0}
    assert licences.scan_licences(make([])).collect() == []


APACHE = """Licensed under the Apache License, Version 2.0 (the "License");
you may not use this file except in compliance with the License.
You may obtain a copy of the License at

    http://www.apache.org/licenses/LICENSE-2.0

Unless required by applicable law or agreed to in writing, software
distributed under the License is distributed on an "AS IS" BASIS,
WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.
See the License for the specific language governing permissions and
limitations under the License."""

MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR
IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY,
FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE
AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER
LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM,
OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE
SOFTWARE."""

BSD = """Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions
are met:
1. Redistributions of source code must retain the above copyright
   notice, this list of conditions and the following disclaimer.
2. Redistributions in binary form must reproduce the above copyright
   notice, this list of conditions and the following disclaimer in the
   documentation and/or other materials provided with the distribution.
3. Neither the name of the University nor the names of its contributors
   may be used to endorse or promote products derived from this software
   without specific prior written permission.

THIS SOFTWARE IS PROVIDED BY THE REGENTS AND CONTRIBUTORS ``AS IS'' AND
ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE
IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE
ARE DISCLAIMED."""

GPL = """This program is free software; you can redistribute it and/or modify
it under the terms of the GNU General Public License as published by
the Free Software Foundation; either version 2 of the License, or
(at your option) any later version."""

MPL = """This Source Code Form is subject to the terms of the Mozilla Public
License, v. 2.0. If a copy of the MPL was not distributed with this
file, You can obtain one at http://mozilla.org/MPL/2.0/."""

ZLIB = """This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software.

Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions:

1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software. If you use this software in a product, an acknowledgment in the product documentation would be appreciated but is not required."""


def test_published_texts_wrapped_unwrapped_and_commented(make):
    import textwrap

    published = [(APACHE, "Apache-2.0 (full header)"), (MIT, "MIT (full text)"), (BSD, "BSD-3-Clause (full text)"), (BSD[: BSD.index("3. ")], "BSD-2-Clause (full text)"), (GPL, "GPL-2.0-or-later"), (GPL.replace("software;", "software:").replace("Foundation;", "Foundation,").replace("version 2", "version 3").replace("General", "Affero General"), "AGPL-3.0-or-later"), (MPL, "MPL-2.0"), (ZLIB, "Zlib (full text)")]
    forms = [
        lambda t: t,
        lambda t: "\r\n\r\n".join(" ".join(p.split()) for p in t.split("\n\n")),
        lambda t: "\n\n".join(textwrap.fill(" ".join(p.split()), 31) for p in t.split("\n\n")),
        lambda t: "/*\n" + "".join(f" * {x}\n" for x in ["Copyright 2020 A. Author", "", *t.split("\n")]) + " */\nint x;",
        lambda t: "".join(f"# {x}\n" for x in t.split("\n")) + "import os",
        lambda t: "".join(f"dnl {x}\n" for x in t.split("\n")),
    ]
    rows = [(i * 10 + j, form(text)) for i, (text, _) in enumerate(published) for j, form in enumerate(forms)]
    got = scan(make, rows)
    for i, (_, name) in enumerate(published):
        for j in range(len(forms)):
            assert got[i * 10 + j][2] == name, (i, j, got[i * 10 + j])


def test_short_notices_and_what_is_none(make):
    got = scan(make, [
        (1, "// SPDX-License-Identifier: BSD-3-Clause\nint x;"), (2, "This project is licensed under\nthe terms of the MIT license."), (3, "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
        (4, "Permission is hereby granted, free of charge, to any person who reads."), (5, "Released under the\n\nMIT License."), (6, "It is not released under the MIT License here."), (7, "a" + "." * 200_000 + "b"),
    ])
    assert [got[i][2] for i in range(1, 8)] == ["BSD-3-Clause", "MIT", "CC-BY-SA-4.0", "", "", "", ""]


def test_notices_as_readmes_write_them(make):
    notices = [
        ("This project is licensed under the MIT License - see the LICENSE.md file for details", "MIT"),
        ("licensed under the MIT license, see LICENSE for details.", "MIT"),
        ("License: MIT", "MIT"),
        ("Licensed under either of * Apache License, Version 2.0 * MIT license", "Apache-2.0,MIT"),
        ("Released under Apache 2.0 and MIT.", "Apache-2.0,MIT"),
        ("SPDX-License-Identifier: (Apache-2.0 OR MIT)", "Apache-2.0,MIT"),
        ("<p>SPDX-License-Identifier: BSD-3-Clause</p>", "BSD-3-Clause"),
        ("// SPDX-License-Identifier: GPL-2.0+ WITH Classpath-exception-2.0 AND (ISC)", "GPL-2.0-or-later,ISC"),
        ("<p>This software is released under the MIT License.</p>", "MIT"),
        ("GNU GENERAL PUBLIC LICENSE\n\n   Version 2, June 1991\n", "GPL-2.0 (full text)"),
        ("The MIT License (MIT)\n\nCopyright (c) 2020", "MIT"),
        ("IN NO EVENT SHALL " + "THE VERY LONG NAME OF A HOLDER " * 5 + BSD, "BSD-3-Clause (full text)"),
    ]
    got = scan(make, [(i, text) for i, (text, _) in enumerate(notices)])
    for i, (text, want) in enumerate(notices):
        assert got[i][2] == want, (text, got[i])


def test_of_rules_from_one_identifier_the_longest_holds():
    index = licences.rule_index([("A", ["x", "y"]), ("B", ["x", "z", "w"]), ("C", ["w"]), ("D", ["y"])])
    assert licences.rule_matches(["x", "y", "z", "w"], index) == [("B", 0), ("D", 1)]
    assert licences.rule_matches(["x", "y", "w"], index) == [("A", 0), ("C", 2)]
    assert licences.rule_matches(["x", "q", "q", "y"], index) == [("D", 3)]
    assert licences.rule_matches(["x", "y", "x", "y"], index) == [("A", 0), ("A", 2)]
