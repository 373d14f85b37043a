import pytest

from gavelline.llm import licences as lic

APACHE = (
    "Licensed under the Apache License, Version 2.0 (the \"License\");\nyou may not use this file except in compliance with "
    "the License.\n# You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0.\n"
    "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "
    "\"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied."
)


@pytest.mark.parametrize("text, want", [
    ("Licensed under CC BY-NC 4.0.\nThe text.", [("CC-BY-NC-4.0", "cc-by-nc")]),
    ("Prose first. This work is licensed under the GNU General Public License, version 3.\nMore", [("GPL-3", "gpl-named")]),
    ("Released under the MIT Licence.", [("MIT", "mit-named")]),
    ("licensed under the apache license, version 2.0.", [("Apache-2.0", "apache-named")]),
    (APACHE, [("Apache-2.0", "apache-full")]),
    ("Copyright (c) 2020 Jane Doe\nAll rights reserved.", [("Proprietary", "reserved")]),
    ("Copyright 2019 The Authors", [(None, "sentence without rule")]),
    ("Released under the MIT License. Licensed under CC BY 4.0.", [("MIT", "mit-named"), ("CC-BY-4.0", "cc-by")]),
    ("We were licensed under strict terms and the license expired.", []),
    ("The MIT License was written at a university.", []),
    ("", []),
])
def test_rules(text, want):
    found = lic.licences(text)
    assert [f[:2] for f in found] == want
    for _, _, a, b, _ in found:
        assert text[a:b].strip()


def test_fuller_rules_come_first():
    for k, (_, _, sequence) in enumerate(lic.RULES):
        for _, _, earlier in lic.RULES[:k]:
            parts = [sequence[i : i + len(earlier)] for i in range(len(sequence))]
            assert earlier not in parts or len(sequence) <= len(earlier)


def test_every_sentence_can_be_found():
    parts = {"{version}": "2.0", "{holder}": "some one", "{year}": "2001"}
    for name, kinds in lic.SENTENCES.items():
        for sentence in kinds:
            for part, value in parts.items():
                sentence = sentence.replace(part, value)
            assert lic._SIGNS.search(sentence), sentence
            assert lic.known(sentence + ".")[0] == name, sentence
    assert {s for _, _, sequence in lic.RULES for s in sequence if s} <= set(lic.SENTENCES)


GRANTS = {
    "ISC": 'Permission to use, copy, modify, and/or distribute this software for any\npurpose with or without fee is hereby granted, provided that the above\ncopyright notice and this permission notice appear in all copies.\n\nTHE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES\nWITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF\nMERCHANTABILITY AND FITNESS.',
    "Zlib": "This software is provided 'as-is', without any express or implied\nwarranty. In no event will the authors be held liable for any damages\narising from the use of this software.\n\nPermission is granted to anyone to use this software for any purpose,\nincluding commercial applications, and to alter it and redistribute it\nfreely, subject to the following restrictions:",
    "LGPL-2.1-or-later": " * This library is free software; you can redistribute it and/or\n * modify it under the terms of the GNU Lesser General Public\n * License as published by the Free Software Foundation; either\n * version 2.1 of the License, or (at your option) any later version.",
    "AGPL-3-or-later": "# This program is free software: you can redistribute it and/or modify\n# it under the terms of the GNU Affero General Public License as published by\n# the Free Software Foundation, either version 3 of the License, or\n# (at your option) any later version.",
    "GPL-2-only": "// This program is free software; you can redistribute it and/or modify\n// it under the terms of the GNU General Public License version 2 as\n// published by the Free Software Foundation.",
    "Unlicense": "This is free and unencumbered software released into the public domain.",
    "BSL-1.0": "Permission is hereby granted, free of charge, to any person or organization\nobtaining a copy of the software and accompanying documentation covered by\nthis license (the \"Software\") to use, reproduce, display, distribute,\nexecute, and transmit the Software, and to prepare derivative works of the\nSoftware, and to permit third-parties to whom the Software is furnished to\ndo so, all subject to the following:",
    "EPL-2.0": "This program and the accompanying materials are made available under the\nterms of the Eclipse Public License v2.0 which accompanies this distribution.",
    "CC-BY-NC-SA-4.0": "This work is licensed under a Creative Commons\nAttribution-NonCommercial-ShareAlike 4.0 International License.",
    "CC-BY-SA": "This work is licensed under CC BY-SA.",
    "Apache-2.0 OR MIT": "// SPDX-License-Identifier: Apache-2.0 OR MIT\n\nfn main() {}",
    "GPL-2.0+": "/* SPDX-License-Identifier: GPL-2.0+ */\nint x;",
    "PostgreSQL": "Released under the PostgreSQL License.",
    "OFL-1.1": "This Font Software is licensed under the SIL Open Font License, Version 1.1.".replace("This Font Software is l", "L"),
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public\nLicense, v. 2.0. If a copy of the MPL was not distributed with this\nfile, You can obtain one at https://mozilla.org/MPL/2.0/.",
}


@pytest.mark.parametrize("name", GRANTS)
def test_grants_as_they_are_wrapped(name):
    assert [f[0] for f in lic.licences("Some words first.\n\n" + GRANTS[name] + "\n\nAnd more.")] == [name]


def test_many_licences_by_name():
    from gavelline.llm.licence_table import NAMES

    assert len(NAMES) >= 40
    for name, kinds in NAMES.items():
        for kind in kinds:
            text = f"It rained.\nThis project is licensed under the {kind.replace('{version}', '7.1').title()}.\nIt rained again."
            found = [f[0] for f in lic.licences(text)]
            assert found in ([name.replace("{version}", "7.1")], ["BSD"]), (text, found)


def test_reserved_rights_in_prose_are_no_licence():
    assert [f[0] for f in lic.licences("He said so.\nAll rights reserved.\nThey left.")] == [None]


def test_awkward_rows(awkward, nothing, spark):
    assert lic.scan(awkward).count() == 0 and lic.scan(nothing).count() == 0
    long_text = "word word. " * 50_000 + "\nLicensed under CC BY-NC 4.0."
    rows = spark.createDataFrame([(None, long_text, "x"), (1, None, "y"), (1, "Released under the MIT License.", "z")] * 2,
                                 "doc_id long, text string, licence string")
    found = lic.scan(rows).collect()
    assert sorted((r.licence, r.doc_id) for r in found) == [("CC-BY-NC-4.0", None)] * 2 + [("MIT", 1)] * 2
    assert all(r.in_order == 0 for r in found)
    assert {r.begin for r in found if r.doc_id is None} == {len("word word. " * 50_000) + 1}


MIT = """MIT License

Copyright (c) 2020 Jane Doe

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
FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE
AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER
LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM,
OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE
SOFTWARE."""

BSD_2 = """Copyright (c) 2019, Jane Doe
All rights reserved.

Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this
   list of conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice,
   this list of conditions and the following disclaimer in the documentation
   and/or other materials provided with the distribution.
"""

BSD_3 = BSD_2 + """
3. Neither the name of the copyright holder nor the names of its
   contributors may be used to endorse or promote products derived from
   this software without specific prior written permission.

THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS"
AND ANY EXPRESS OR IMPLIED WARRANTIES ARE DISCLAIMED."""

APACHE_HEADER = """   Copyright 2021 The Authors

   Licensed under the Apache License, Version 2.0 (the "License");
   you may not use this file except in compliance with the License.
   You may obtain a copy of the License at

       https://www.apache.org/licenses/LICENSE-2.0

   Unless required by applicable law or agreed to in writing, software
   distributed under the License is distributed on an "AS IS" BASIS,
   WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.
   See the License for the specific language governing permissions and
   limitations under the License."""

GPL_3 = """    This program is free software: you can redistribute it and/or modify
    it under the terms of the GNU General Public License as published by
    the Free Software Foundation, either version 3 of the License, or
    (at your option) any later version.

    This program is distributed in the hope that it will be useful."""

GPL_2 = """This program is free software; you can redistribute it and/or
modify it under the terms of the GNU General Public License
as published by the Free Software Foundation; either version 2
of the License, or (at your option) any later version."""

GPL_2_ONLY = """This program is free software; you can redistribute it and/or modify
it under the terms of the GNU General Public License as published by
the Free Software Foundation; version 2 of the License.

This program is distributed in the hope that it will be useful."""


@pytest.mark.parametrize("sign", ["", "# ", "// ", " * ", "-- ", "dnl ", "> "])
@pytest.mark.parametrize("text, want", [
    (MIT, ("MIT", "mit-full")),
    (BSD_2, ("BSD-2-Clause", "bsd-2-reserved")),
    (BSD_3, ("BSD-3-Clause", "bsd-3-reserved")),
    (BSD_3.replace("All rights reserved.\n", ""), ("BSD-3-Clause", "bsd-3")),
    (BSD_3.replace("1.", "(a)").replace("2.", "(b)").replace("3.", "(c)"), ("BSD-3-Clause", "bsd-3-reserved")),
    (APACHE_HEADER, ("Apache-2.0", "apache-full")),
    (GPL_3, ("GPL-3-or-later", "gpl-later")),
    (GPL_2, ("GPL-2-or-later", "gpl-later")),
    (GPL_2_ONLY, ("GPL-2-only", "gpl-only")),
])
def test_verbatim_wrapped_texts(text, want, sign):
    text = "\n".join((sign + line).rstrip() for line in text.split("\n"))
    found = lic.licences(text)
    assert [f[:2] for f in found if f[0] and f[1] != "mit-named"] == [want]


def test_long_parts_of_sentences():
    holder = " ".join(f"Company{k} Inc." for k in range(100))
    text = BSD_3.replace("the copyright holder nor", f"{holder} nor")
    assert [f[:2] for f in lic.licences(text) if f[0]] == [("BSD-3-Clause", "bsd-3-reserved")]
    assert [f[1] for f in lic.licences("Copyright 2020 " + "Name " * 200 + "\nAll rights reserved.")] == ["reserved"]


def test_paragraphs_and_unknown_sentences_part():
    assert lic.licences("This program is free software;\n\nyou can redistribute it.") == []
    assert [f[1] for f in lic.licences("Copyright 2020\nAll rights\nreserved.")] == ["reserved"]
    parted = BSD_2.replace("1. Red", "Some other words.\n\n1. Red")
    assert "BSD-2-Clause" not in [f[0] for f in lic.licences(parted)]


def test_scan_of_wrapped_texts(spark):
    rows = spark.createDataFrame(list(enumerate([MIT, BSD_2, BSD_3, APACHE_HEADER, GPL_3])), "doc_id long, text string")
    found = {(r.doc_id, r.rule) for r in lic.scan(rows).collect()}
    assert {(0, "mit-full"), (1, "bsd-2-reserved"), (2, "bsd-3-reserved"), (3, "apache-full"), (4, "gpl-later")} <= found
