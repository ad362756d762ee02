"""Licences by standard headers, whole texts and SPDX tags as files carry them."""

import textwrap
import time

import pytest

from siftline.llm import licenses
from siftline.llm.license_templates import TEXTS

PROSE = "The harbour was quiet and the boats lay still until the morning wind came up from the south and filled the grey sails.\n"
CODE = "import os\n\ndef main(path):\n    return os.listdir(path)\n"
GPL = """This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.

This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details.

You should have received a copy of the GNU General Public License along with this program. If not, see <https://www.gnu.org/licenses/>."""
APACHE = """Copyright 2021 The Harbour Authors

Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at

    http://www.apache.org/licenses/LICENSE-2.0

Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License."""
MPL = "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."
MIT = """MIT License

Copyright (c) 2019 Somebody

Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED."""


def wrapped(text, first="", mark="", last="", width=70):
    lines = [x for p in text.split("\n\n") for x in [*textwrap.wrap(p, width), ""]][:-1]
    return first + "".join(f"{mark}{x}".rstrip() + "\n" for x in lines) + last


def bsd(clauses):
    names = "3. Neither the name of Harbour Ltd nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.\n\n" if clauses == 3 else ""
    return f"Copyright (c) 2001, Harbour Ltd\nAll rights reserved.\n\nRedistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:\n\n1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.\n\n2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.\n\n{names}THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES ARE DISCLAIMED."


CASES = [
    ("GPL-3.0", wrapped(GPL, mark="# ") + CODE),
    ("GPL-3.0", wrapped(GPL, "/*\n", " * ", " */\n") + CODE),
    ("GPL-3.0", wrapped(GPL, "/* ", "   ", "*/\n", 50) + CODE),
    ("GPL-2.0", wrapped(GPL.replace("version 3", "version 2"), mark="// ") + CODE),
    ("LGPL-3.0", wrapped(GPL.replace("GNU General", "GNU Lesser General"), mark="-- ") + CODE),
    ("LGPL-2.1", wrapped(GPL.replace("GNU General", "GNU Lesser General").replace("version 3", "version 2.1"), mark="# ") + CODE),
    ("AGPL-3.0", wrapped(GPL.replace("GNU General", "GNU Affero General"), '"""\n', "", '"""\n') + CODE),
    ("Apache-2.0", wrapped(APACHE, mark="// ") + CODE),
    ("Apache-2.0", wrapped(APACHE, "<!--\n", "  ", "-->\n").replace("\n", "\r\n") + CODE),
    ("MPL-2.0", wrapped(MPL, mark="# ", width=40) + CODE),
    ("MIT", MIT),
    ("MIT", wrapped(MIT, mark="; ") + CODE),
    ("BSD-2-Clause", wrapped(bsd(2), "/*\n", " * ", " */\n") + CODE),
    ("BSD-3-Clause", wrapped(bsd(3))),
    *[(p.stem, p.read_text("utf-8")) for p in sorted(TEXTS.glob("*.txt"))],
    ("AGPL-3.0", (TEXTS / "GPL-3.0.txt").read_text("utf-8").replace("GENERAL PUBLIC", "AFFERO GENERAL PUBLIC").replace("GNU General Public", "GNU Affero General Public")),
    ("Apache-2.0", "# SPDX-License-Identifier: Apache-2.0\n" + CODE),
    ("MIT", "// SPDX-License-Identifier: MIT\n" + CODE),
    ("GPL-3.0", "/* SPDX-License-Identifier: GPL-3.0-or-later */\n" + CODE),
    ("GPL-2.0 WITH Classpath-exception-2.0", "<!-- SPDX-License-Identifier: GPL-2.0-only WITH Classpath-exception-2.0 -->\n" + CODE),
    ("(MIT OR Apache-2.0)", "# SPDX-License-Identifier: (MIT OR Apache-2.0)\n" + CODE),
    ("Zlib", "# SPDX-License-Identifier: Zlib\n" + CODE),
    ("CC-BY-SA-4.0", PROSE + "This text is licensed under a\nCreative Commons Attribution-ShareAlike 4.0 International License.\n" + PROSE),
    ("GPL-3.0", "                    GNU GENERAL PUBLIC LICENSE\n                       Version 3, 29 June 2007\n"),
    ("MIT", PROSE * 3 + "Copyright 2020 Harbour Ltd. Licensed under the MIT License.\n" + PROSE * 3),
    # other licences than those of the templates
    (None, "Licensed under the Eclipse Public License, Version 2.0.\n" + CODE),
    (None, "Licensed under the Apache License, Version 1.1.\n" + CODE),
    (None, "# SPDX-License-Identifier: NOASSERTION\n" + CODE),
    (None, PROSE + "Fishing without a license is not allowed under the harbour rules, version 2.\n"),
    (None, "Copyright 2020 Harbour Ltd. All rights reserved.\n" + CODE),
]


@pytest.fixture(scope="module")
def found(spark):
    files = spark.createDataFrame([(i, f"d{i}/x", t) for i, (_, t) in enumerate(CASES)], "doc_id long, path string, text string")
    return {r["doc_id"]: r["own_license"] for r in licenses.scan(files, "doc_id", files.path).collect()}


@pytest.mark.parametrize("i", range(len(CASES)))
def test_licence_of(found, i):
    want, text = CASES[i]
    assert found[i] == want, text[:300]


def test_long_tags_and_lines(spark):
    """Neither a long expression nor a long line may exhaust the matcher."""
    tag = "MIT" + " OR MIT" * 5_000
    texts = [f"# SPDX-License-Identifier: {tag}\n", "license " * 100_000, "(" * 50_000 + " license", "a.b-" * 100_000 + " copyright 2020"]
    files = spark.createDataFrame([(i, f"d{i}/x", t) for i, t in enumerate(texts)], "doc_id long, path string, text string")
    got = {r["doc_id"]: r["own_license"] for r in licenses.scan(files, "doc_id", files.path).collect()}
    assert got == {0: tag, 1: None, 2: None, 3: None}


def test_many_notices_cost_in_proportion(spark):
    """A text of many different notices: ten times as many may not take a hundred times as long."""
    seconds = []
    for n in (500, 500, 5_000):
        text = "\n\n".join(f"Copyright holder number {i} grants no license for part {i}." for i in range(n))
        files = spark.createDataFrame([(1, "d/x", text)], "doc_id long, path string, text string")
        start = time.perf_counter()
        licenses.scan(files, "doc_id", files.path).collect()
        seconds.append(time.perf_counter() - start)
    assert seconds[2] < 25 * seconds[1]
