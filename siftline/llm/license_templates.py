"""Templates of licences: whole texts, standard headers and one-line notices. Fixed values.

Texts of a few thousand words lie in ``license_texts`` as their stewards publish them.
The legal codes of Creative Commons are known by their titles and notices only. The
text of AGPL-3.0 is made from that of GPL-3.0, from which it differs in name and section 13.
"""

from __future__ import annotations

import re
from pathlib import Path

TEXTS = Path(__file__).with_name("license_texts")

AS_IS = """THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""
MIT = f"""Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.

{AS_IS}"""
BSD_USE = "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:"
BSD_KEEP = """1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution."""
BSD_ADS = "3. All advertising materials mentioning features or use of this software must display the following acknowledgement: This product includes software developed by the organization."
BSD_NAMES = "3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission."
BSD_AS_IS = """THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""
ISC_AS_IS = """THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."""
ISC_GRANT = "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"
ISC_KEEP = ", provided that the above copyright notice and this permission notice appear in all copies."
UNLICENSE = """This is free and unencumbered software released into the public domain.

Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means.

In jurisdictions that recognize copyright laws, the author or authors of this software dedicate any and all copyright interest in the software to the public domain. We make this dedication for the benefit of the public at large and to the detriment of our heirs and successors. We intend this dedication to be an overt act of relinquishment in perpetuity of all present and future rights to this software under copyright law.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.

For more information, please refer to <https://unlicense.org>"""
ZLIB = """This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software.

Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions:

1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software. If you use this software in a product, an acknowledgment in the product documentation would be appreciated but is not required.

2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software.

3. This notice may not be removed or altered from any source distribution."""
APACHE_1 = 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License.'
APACHE_HEADER = f"""{APACHE_1} You may obtain a copy of the License at

http://www.apache.org/licenses/LICENSE-2.0

Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License."""
APACHE_ASF = f"""Licensed to the Apache Software Foundation (ASF) under one or more contributor license agreements. See the NOTICE file distributed with this work for additional information regarding copyright ownership. The ASF licenses this file to You under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. {APACHE_HEADER.split('License. ', 1)[1]}"""
MPL_1 = "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."
MPL_HEADER = f"{MPL_1} If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."
REMOTE = """13. Remote Network Interaction; Use with the GNU General Public License.

Notwithstanding any other provision of this License, if you modify the Program, your modified version must prominently offer all users interacting with it remotely through a computer network (if your version supports such interaction) an opportunity to receive the Corresponding Source of your version by providing access to the Corresponding Source from a network server at no charge, through some standard or customary means of facilitating copying of software. This Corresponding Source shall include the Corresponding Source for any work covered by version 3 of the GNU General Public License that is incorporated pursuant to the following paragraph.
"""


def gnu_headers(name: str, version: str) -> list[str]:
    """The header as of version 3, as of version 2, with 'any later version' and without, and its first paragraphs."""
    out = []
    for which in (f"either version {version} of the License, or (at your option) any later version", f"version {version} of the License"):
        for subject in ("This program is free software: you", "This library is free software; you"):
            grant = f"{subject} can redistribute it and/or modify it under the terms of the GNU {name} as published by the Free Software Foundation, {which}."
            what = subject.split()[1]
            rest = f"This {what} is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU {name} for more details.\n\nYou should have received a copy of the GNU {name} along with this {what}."
            out += [
                grant,
                f"{grant}\n\n{rest} If not, see <https://www.gnu.org/licenses/>.",
                f"{grant}\n\n{rest[:-1]}; if not, write to the Free Software Foundation, Inc., 51 Franklin Street, Fifth Floor, Boston, MA 02110-1301 USA.",
            ]
    return out


def whole_texts() -> list[tuple[str, str]]:
    out = [(p.stem, p.read_text("utf-8")) for p in sorted(TEXTS.glob("*.txt"))]
    gpl = dict(out)["GPL-3.0"]
    head, tail = gpl.split("13. Use with the GNU Affero General Public License.", 1)
    agpl = head + REMOTE + tail
    out.append(("AGPL-3.0", re.sub("(?i)gnu general public license", "GNU Affero General Public License", agpl)))
    bsd = (BSD_USE, BSD_KEEP)
    return out + [
        ("BSD-2-Clause", "\n\n".join((*bsd, BSD_AS_IS))),
        ("BSD-3-Clause", "\n\n".join((*bsd, BSD_NAMES, BSD_AS_IS))),
        ("BSD-4-Clause", "\n\n".join((*bsd, BSD_ADS, BSD_NAMES, BSD_AS_IS))),
        ("MIT", MIT),
        ("ISC", f"{ISC_GRANT}{ISC_KEEP}\n\n{ISC_AS_IS}"),
        ("0BSD", f"{ISC_GRANT}.\n\n{ISC_AS_IS}"),
        ("Unlicense", UNLICENSE),
        ("Zlib", ZLIB),
    ]


HEADERS = [
    *[("Apache-2.0", x) for x in (APACHE_1, APACHE_HEADER, APACHE_HEADER.split("\n\n")[0], APACHE_ASF, APACHE_ASF.split("\n\n")[0])],
    ("MPL-2.0", MPL_1),
    ("MPL-2.0", MPL_HEADER),
    *[("GPL-2.0", x) for x in gnu_headers("General Public License", "2")],
    *[("GPL-3.0", x) for x in gnu_headers("General Public License", "3")],
    *[("LGPL-2.0", x) for x in gnu_headers("Library General Public License", "2")],
    *[("LGPL-2.1", x) for x in gnu_headers("Lesser General Public License", "2.1")],
    *[("LGPL-3.0", x) for x in gnu_headers("Lesser General Public License", "3")],
    *[("AGPL-3.0", x) for x in gnu_headers("Affero General Public License", "3")],
    ("MIT", MIT.split("\n\n")[0]),
    ("ISC", f"{ISC_GRANT}{ISC_KEEP}"),
    ("ISC", "Permission to use, copy, modify, and distribute this software for any purpose is hereby granted. ISC License."),
    ("BSD-2-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted. BSD 2-Clause License."),
    ("BSD-3-Clause", BSD_NAMES),
    ("BSD-3-Clause", "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products. BSD 3-Clause License."),
    ("BSD-3-Clause", "Use of this source code is governed by a BSD 3-Clause license that can be found in the LICENSE file."),
    ("MIT", "Use of this source code is governed by an MIT-style license that can be found in the LICENSE file."),
    ("CC0-1.0", "Dedicated to the public domain under the CC0 1.0 Universal license."),
    ("CC0-1.0", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work under CC0 1.0 Universal."),
    ("Unlicense", "This is free and unencumbered software released into the public domain. Unlicense."),
]

CC = {"": "Attribution", "-NC": "Attribution-NonCommercial", "-SA": "Attribution-ShareAlike", "-ND": "Attribution-NoDerivatives", "-NC-SA": "Attribution-NonCommercial-ShareAlike", "-NC-ND": "Attribution-NonCommercial-NoDerivatives"}
NAMES = {
    "Apache-2.0": ["Apache License, Version 2.0", "Apache 2.0 License", "Apache License Version 2.0, January 2004 http://www.apache.org/licenses/"],
    "BSD-2-Clause": ["BSD 2-Clause License"],
    "BSD-3-Clause": ["BSD 3-Clause License"],
    "GPL-2.0": ["GNU General Public License, version 2", "GNU General Public License v2.0", "GNU General Public License, version 2, June 1991", "GPLv2 license"],
    "GPL-3.0": ["GNU General Public License, version 3", "GNU General Public License v3.0", "GNU General Public License, version 3, 29 June 2007", "GPLv3 license"],
    "LGPL-2.0": ["GNU Library General Public License, version 2"],
    "LGPL-2.1": ["GNU Lesser General Public License, version 2.1", "LGPLv2.1 license"],
    "LGPL-3.0": ["GNU Lesser General Public License, version 3", "GNU Lesser General Public License, version 3, 29 June 2007", "LGPLv3 license"],
    "AGPL-3.0": ["GNU Affero General Public License, version 3", "GNU Affero General Public License, version 3, 19 November 2007", "AGPLv3 license"],
    "ISC": ["ISC License"],
    "MIT": ["MIT License", "MIT License (MIT)"],
    "MPL-2.0": ["Mozilla Public License, version 2.0", "Mozilla Public License 2.0"],
    "Unlicense": ["Unlicense license"],
    "Zlib": ["zlib License"],
    **{f"CC-BY{x}-4.0": [f"CC BY{x} 4.0", f"Creative Commons {name} 4.0 International License", f"Creative Commons {name} 4.0 International Public License"] for x, name in CC.items()},
}
FRAMES = ("{}", "The {}", "License: {}", "Licensed under {}.", "Licensed under the {}.", "Released under the {}.", "Distributed under the {}.", "This work is licensed under the {}.", "This work is licensed under a {}.", "This project is licensed under the {} - see the LICENSE file for details.")

TEMPLATES = tuple(dict.fromkeys([*whole_texts(), *HEADERS, *((x, f.format(n)) for x, names in NAMES.items() for n in names for f in FRAMES)]))

_GPL = r"general public licen[sc]e\b.*\b(version |v)"
# What the words of a part, joined by spaces, must hold for a licence: names and versions are few
# among the words of a notice, so that one of another licence is like it.
MUST = {
    "Apache-2.0": r"\bapache\b.*\b2\b",
    "BSD-2-Clause": r"redistribution and use|\bbsd 2\b",
    "BSD-3-Clause": r"endorse or promote|\bbsd 3\b",
    "BSD-4-Clause": r"advertising materials",
    "CC0-1.0": r"\bcc0\b",
    **{f"CC-BY{x}-4.0": r"\b(by|attribution)" + "".join({"NC": " (nc|noncommercial)", "SA": " (sa|sharealike)", "ND": " (nd|noderivatives)"}[k] for k in x.split("-")[1:]) + r" 4\b" for x in CC},
    "GPL-1.0": _GPL + r"1\b",
    "GPL-2.0": _GPL + r"2\b|\bgplv2\b",
    "GPL-3.0": _GPL + r"3\b|\bgplv3\b",
    "LGPL-2.0": r"\blibrary " + _GPL + r"2\b",
    "LGPL-2.1": r"\blesser " + _GPL + r"2 1\b|\blgplv2 1\b",
    "LGPL-3.0": r"\blesser " + _GPL + r"3\b|\blgplv3\b",
    "AGPL-3.0": r"\baffero " + _GPL + r"3\b|\bagplv3\b",
    "ISC": r"permission to use copy modify and|\bisc\b",
    "0BSD": r"permission to use copy modify and",
    "MIT": r"permission is hereby granted free of charge|\bmit\b",
    "MPL-2.0": r"\bmozilla public licen[sc]e\b.*\b2\b",
    "Unlicense": r"free and unencumbered|\bunlicense\b",
    "Zlib": r"\bzlib\b|origin of this software must not be misrepresented",
}
