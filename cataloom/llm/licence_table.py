"""Known licence sentences and the rules over them, as in the published texts."""

from __future__ import annotations

import re
from itertools import product


def _key(sentence: str) -> str:
    return " ".join(re.findall(r"[^\W_]+|\*", sentence.lower()))


#: Identifier -> whole sentences of published notices and texts; * is a name.
_PUBLISHED: dict[str, list[str]] = {
    # Apache-2.0: notice of the appendix, title of the text
    "apache-2.0-notice": ['Licensed under the Apache License, Version 2.0 (the "License")'],
    "apache-2.0-compliance": ["you may not use this file except in compliance with the License", "you may not use * except in compliance with the License"],
    "apache-2.0-copy": ["You may obtain a copy of the License at", "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0", "You may obtain a copy of the License at https://www.apache.org/licenses/LICENSE-2.0"],
    "apache-2.0-warranty": ['Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied'],
    "apache-2.0-language": ["See the License for the specific language governing permissions and limitations under the License"],
    "apache-2.0-title": [f"Apache License Version 2.0, January 2004{url}" for url in ("", " http://www.apache.org/licenses/", " https://www.apache.org/licenses/")],
    "apache-2.0-terms": ["TERMS AND CONDITIONS FOR USE, REPRODUCTION, AND DISTRIBUTION"],
    # MIT and MIT-0
    "mit-title": ["The MIT License (MIT)", "The MIT License"],
    "mit-grant": [
        'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions',
    ],
    "mit-0-grant": [
        'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so',
    ],
    "mit-conditions": [
        "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software",
        "The above copyright notice and this permission notice (including the next paragraph) shall be included in all copies or substantial portions of the Software",
    ],
    "as-is": [
        'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT',
    ],
    "mit-liability": [
        "IN NO EVENT SHALL * BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE",
    ],
    # BSD
    "bsd-grant": ["Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"],
    "bsd-source": [
        "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer",
        "Redistributions of source code must retain the above copyright notice, this list of conditions, and the following disclaimer",
    ],
    "bsd-binary": ["Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution"],
    "bsd-names": [
        "Neither the name of * nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission",
        "Neither the name * nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission",
        "Neither the name of * nor the names of * may be used to endorse or promote products derived from this software without specific prior written permission",
        "The name of * may not be used to endorse or promote products derived from this software without specific prior written permission",
    ],
    "bsd-advertising": ["All advertising materials mentioning features or use of this software must display the following acknowledgement"],
    "bsd-as-is": [
        'THIS SOFTWARE IS PROVIDED BY * "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED',
    ],
    "bsd-liability": [
        "IN NO EVENT SHALL * BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE",
    ],
    # ISC and 0BSD
    "isc-grant": [
        f"Permission to use, copy, modify, and{o} distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies" for o in ("/or", "")
    ],
    "0bsd-grant": ["Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"],
    "isc-as-is": [
        f'THE SOFTWARE IS PROVIDED "AS IS" AND {who} DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS' for who in ("THE AUTHOR", "*")
    ],
    # zlib
    "zlib-as-is": ["This software is provided 'as-is', without any express or implied warranty"],
    "zlib-grant": ["Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions"],
    "zlib-origin": ["The origin of this software must not be misrepresented; you must not claim that you wrote the original software"],
    "zlib-altered": ["Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software"],
    "zlib-notice": ["This notice may not be removed or altered from any source distribution"],
    # Unlicense
    "unlicense-release": ["This is free and unencumbered software released into the public domain"],
    "unlicense-free": ["Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means"],
    # Boost
    "bsl-1.0-notice": [f"Distributed under the Boost Software License, Version 1.0{end}" for end in ("", " (See accompanying file LICENSE_1_0.txt or copy at http://www.boost.org/LICENSE_1_0.txt)", " (See accompanying file LICENSE_1_0.txt or copy at https://www.boost.org/LICENSE_1_0.txt)")],
    "bsl-1.0-title": ["Boost Software License - Version 1.0 - August 17th, 2003"],
    # MPL
    "mpl-2.0-notice": ["This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"],
    "mpl-2.0-copy": [f"If a copy of the MPL was not distributed with this file, You can obtain one at {url}mozilla.org/MPL/2.0/" for url in ("http://", "https://")],
    "mpl-2.0-title": ["Mozilla Public License Version 2.0", "Mozilla Public License, version 2.0"],
    # GNU: titles of the texts
    "gpl-2.0-title": ["GNU GENERAL PUBLIC LICENSE Version 2, June 1991"],
    "gpl-3.0-title": ["GNU GENERAL PUBLIC LICENSE Version 3, 29 June 2007"],
    "lgpl-2.1-title": ["GNU LESSER GENERAL PUBLIC LICENSE Version 2.1, February 1999"],
    "lgpl-3.0-title": ["GNU LESSER GENERAL PUBLIC LICENSE Version 3, 29 June 2007"],
    "agpl-3.0-title": ["GNU AFFERO GENERAL PUBLIC LICENSE Version 3, 19 November 2007"],
    "gnu-hope": [f"{what} is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE" for what in ("This program", "This library", "This software", "This file")],
    # Creative Commons and others
    "cc0-1.0-title": ["CC0 1.0 Universal", "Creative Commons Legal Code CC0 1.0 Universal"],
    "cc0-1.0-notice": [
        "To the extent possible under law, the author(s) have dedicated all copyright and related and neighboring rights to this software to the public domain worldwide",
    ],
    "wtfpl-title": ["DO WHAT THE FUCK YOU WANT TO PUBLIC LICENSE", "DO WHAT THE FUCK YOU WANT TO PUBLIC LICENSE Version 2, December 2004"],
    "epl-2.0-title": ["Eclipse Public License - v 2.0"],
    "epl-2.0-notice": [
        "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 which is available at http://www.eclipse.org/legal/epl-2.0",
        "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 which is available at https://www.eclipse.org/legal/epl-2.0",
        "This program and the accompanying materials are made available under the terms of the Eclipse Public License v2.0 which accompanies this distribution",
    ],
    "artistic-title": ['The "Artistic License"'],
    "reserved": ["All rights reserved"],
}

#: GNU notices: "... redistribute it and/or modify it under the terms of" these.
_GNU = [("gpl-2.0", "GNU General Public License", "2"), ("gpl-3.0", "GNU General Public License", "3"), ("lgpl-2.0", "GNU Library General Public License", "2"), ("lgpl-2.1", "GNU Lesser General Public License", "2.1"), ("lgpl-3.0", "GNU Lesser General Public License", "3"), ("agpl-3.0", "GNU Affero General Public License", "3")]
for _id, _name, _v in _GNU:
    _terms = "you can redistribute it and/or modify it under the terms of the"
    _by = "published by the Free Software Foundation"
    _PUBLISHED[f"{_id}-or-later-notice"] = [f"{_terms} {_name} as {_by}, either version {_v} of the License, or (at your option) any later version", f"{_terms} {_name} as {_by}; either version {_v}, or (at your option) any later version"]
    _PUBLISHED[f"{_id}-only-notice"] = [f"{_terms} {_name} as {_by}; version {_v} of the License", f"{_terms} {_name} version {_v} as {_by}", f"{_terms} {_name}, version {_v}, as {_by}", f"{_terms} {_name} as {_by}, version {_v}"]

#: Licences as a short notice names them.
_CC = {"by": "Attribution", "by-sa": "Attribution-ShareAlike", "by-nc": "Attribution-NonCommercial", "by-nd": "Attribution-NoDerivatives", "by-nc-sa": "Attribution-NonCommercial-ShareAlike", "by-nc-nd": "Attribution-NonCommercial-NoDerivatives"}
_NAMES: dict[str, list[str]] = {
    "apache-2.0-notice": ["the Apache License, Version 2.0", "the Apache License 2.0", "Apache License 2.0", "the Apache 2.0 License", "Apache 2.0", "Apache-2.0", "the Apache Software License 2.0"],
    "mit-notice": ["the MIT License", "the MIT licence", "MIT License", "MIT", "an MIT license"],
    "bsd-2-clause-notice": ["the BSD 2-Clause License", "BSD-2-Clause", "the 2-clause BSD license", "the Simplified BSD License"],
    "bsd-3-clause-notice": ["the BSD 3-Clause License", "BSD-3-Clause", "the 3-clause BSD license", "the New BSD License", "the Modified BSD License"],
    "isc-notice": ["the ISC License", "ISC"],
    "zlib-short-notice": ["the zlib License", "zlib"],
    "unlicense-notice": ["the Unlicense"],
    "bsl-1.0-notice": ["the Boost Software License, Version 1.0", "the Boost Software License 1.0", "BSL-1.0"],
    "mpl-2.0-notice": ["the Mozilla Public License, Version 2.0", "the Mozilla Public License 2.0", "the Mozilla Public License, v. 2.0", "MPL-2.0", "MPL 2.0"],
    "epl-2.0-notice": ["the Eclipse Public License 2.0", "the Eclipse Public License, Version 2.0", "EPL-2.0"],
    "cc0-1.0-notice": ["CC0 1.0", "CC0", "CC0-1.0", "the Creative Commons CC0 1.0 Universal license", "CC0 1.0 Universal"],
    "gpl-2.0-notice": ["the GNU General Public License, version 2", "the GNU General Public License v2.0", "the GNU GPL v2", "the GNU GPL, version 2", "the GPLv2", "GPLv2", "GPL-2.0"],
    "gpl-3.0-notice": ["the GNU General Public License, version 3", "the GNU General Public License v3.0", "the GNU GPL v3", "the GNU GPL, version 3", "the GPLv3", "GPLv3", "GPL-3.0"],
    "gpl-2.0-or-later-notice": ["the GNU General Public License, version 2 or later", "the GNU GPL v2 or later", "GPL-2.0-or-later", "GPLv2 or later"],
    "gpl-3.0-or-later-notice": ["the GNU General Public License, version 3 or later", "the GNU GPL v3 or later", "GPL-3.0-or-later", "GPLv3 or later"],
    "lgpl-2.1-notice": ["the GNU Lesser General Public License, version 2.1", "the LGPLv2.1", "LGPL-2.1", "LGPLv2.1"],
    "lgpl-3.0-notice": ["the GNU Lesser General Public License, version 3", "the LGPLv3", "LGPL-3.0", "LGPLv3"],
    "agpl-3.0-notice": ["the GNU Affero General Public License, version 3", "the AGPLv3", "AGPL-3.0", "AGPLv3"],
}
for _k, _long in _CC.items():
    for _v in ("4.0", "3.0"):
        _kind = {"4.0": "International", "3.0": "Unported"}[_v]
        _names = [f"CC {_k} {_v}", f"the CC {_k} {_v} license", f"a CC {_k} {_v} license"]
        _names += [f"{a} Creative Commons {_long} {_v} {rest}" for a in ("a", "the") for rest in (f"{_kind} License", f"{_kind} Public License", "License")]
        _NAMES[f"cc-{_k}-{_v}-notice"] = _names + [f"Creative Commons {_long} {_v} {_kind}", f"Creative Commons {_long} {_v}"]

_WHAT = ["", "this work is", "this project is", "this software is", "this program is", "this library is", "this package is", "this code is", "this file is", "the code is", "the software is", "it is", "this document is", "this article is"]
_VERBS = ["licensed", "released", "distributed", "available", "made available", "published", "licenced"]
_UNDER = ["under", "under the terms of"]

#: SPDX identifiers after "SPDX-License-Identifier:" and the sentence they stand for.
_SPDX = {
    "Apache-2.0": "apache-2.0-notice", "MIT": "mit-notice", "MIT-0": "mit-0-notice", "BSD-2-Clause": "bsd-2-clause-notice", "BSD-3-Clause": "bsd-3-clause-notice", "ISC": "isc-notice", "0BSD": "0bsd-notice",
    "Zlib": "zlib-short-notice", "Unlicense": "unlicense-notice", "BSL-1.0": "bsl-1.0-notice", "MPL-2.0": "mpl-2.0-notice", "EPL-2.0": "epl-2.0-notice", "CC0-1.0": "cc0-1.0-notice",
}
for _id in ("gpl-2.0", "gpl-3.0", "lgpl-2.1", "lgpl-3.0", "agpl-3.0"):
    _SPDX |= {_id: f"{_id}-notice", f"{_id}-only": f"{_id}-only-notice", f"{_id}-or-later": f"{_id}-or-later-notice"}
_SPDX |= {f"CC-{_k}-{_v}": f"cc-{_k}-{_v}-notice" for _k in _CC for _v in ("4.0", "3.0")}

#: Known licence sentences (normalised) and their identifiers.  Fixed values.
SENTENCES: dict[str, str] = {_key(s): sid for sid, found in _PUBLISHED.items() for s in found}
for _sid, _names in _NAMES.items():
    for _what, _verb, _under, _name in product(_WHAT, _VERBS, _UNDER, _names):
        SENTENCES.setdefault(_key(f"{_what} {_verb} {_under} {_name}"), _sid)
for _name, _sid in _SPDX.items():
    SENTENCES.setdefault(_key(f"SPDX-License-Identifier: {_name}"), _sid)

#: "License: MIT" and the like, and two licences named together.
for _sid, _names in _NAMES.items():
    for _head, _name in product(("license", "licence", "licensed"), _names):
        SENTENCES.setdefault(_key(f"{_head}: {_name}"), _sid)
_APACHE = sorted({n.removeprefix("the ") for n in _NAMES["apache-2.0-notice"]} | set(_NAMES["apache-2.0-notice"]))
_MIT = ["the MIT License", "MIT License", "MIT"]
for _one, _two in ((_APACHE, _MIT), (_MIT, _APACHE)):
    for _what, _verb, _a, _b in product(["", "this project is", "this software is"], ["licensed", "released", "distributed"], _one, _two):
        for _both in (f"under {_a} and {_b}", f"under {_a} or {_b}", f"under either {_a} or {_b}", f"under either of {_a} {_b}", f"under either of {_a} or {_b}", f"under both {_a} and {_b}"):
            SENTENCES.setdefault(_key(f"{_what} {_verb} {_both}"), "apache-2.0-and-mit-notice")
#: Titles whose version stands in a paragraph of its own.
SENTENCES |= {_key(s): i for i, s in [("gnu-gpl-title", "GNU GENERAL PUBLIC LICENSE"), ("gnu-lgpl-title", "GNU LESSER GENERAL PUBLIC LICENSE"), ("gnu-agpl-title", "GNU AFFERO GENERAL PUBLIC LICENSE")]}
SENTENCES |= {_key(s): i for i, s in [("version-2-1991", "Version 2, June 1991"), ("version-2.1-1999", "Version 2.1, February 1999"), ("version-3-2007-06", "Version 3, 29 June 2007"), ("version-3-2007-11", "Version 3, 19 November 2007")]}

#: Ordered rules: sentence identifiers that have to follow each other.
RULES: list[tuple[str, list[str]]] = [
    ("Apache-2.0", ["apache-2.0-notice"]),
    ("Apache-2.0 (full header)", ["apache-2.0-notice", "apache-2.0-compliance"]),
    ("Apache-2.0 (full text)", ["apache-2.0-title", "apache-2.0-terms"]),
    ("Apache-2.0", ["apache-2.0-and-mit-notice"]),
    ("MIT", ["apache-2.0-and-mit-notice"]),
    ("GPL-2.0 (full text)", ["gnu-gpl-title", "version-2-1991"]),
    ("GPL-3.0 (full text)", ["gnu-gpl-title", "version-3-2007-06"]),
    ("LGPL-2.1 (full text)", ["gnu-lgpl-title", "version-2.1-1999"]),
    ("LGPL-3.0 (full text)", ["gnu-lgpl-title", "version-3-2007-06"]),
    ("AGPL-3.0 (full text)", ["gnu-agpl-title", "version-3-2007-11"]),
    ("MIT", ["mit-notice"]),
    ("MIT", ["mit-title"]),
    ("MIT (full text)", ["mit-title", "mit-grant", "as-is"]),
    ("MIT (full text)", ["mit-grant", "as-is"]),
    ("MIT-0", ["mit-0-notice"]),
    ("MIT-0 (full text)", ["mit-0-grant", "as-is"]),
    ("BSD-2-Clause", ["bsd-2-clause-notice"]),
    ("BSD-3-Clause", ["bsd-3-clause-notice"]),
    ("BSD-2-Clause (full text)", ["bsd-source", "bsd-binary"]),
    ("BSD-3-Clause (full text)", ["bsd-source", "bsd-binary", "bsd-names"]),
    ("BSD-4-Clause (full text)", ["bsd-source", "bsd-binary", "bsd-advertising"]),
    ("BSD-4-Clause (full text)", ["bsd-source", "bsd-binary", "bsd-advertising", "bsd-names"]),
    ("ISC", ["isc-notice"]),
    ("ISC (full text)", ["isc-grant", "isc-as-is"]),
    ("0BSD", ["0bsd-notice"]),
    ("0BSD (full text)", ["0bsd-grant", "isc-as-is"]),
    ("Zlib", ["zlib-short-notice"]),
    ("Zlib (full text)", ["zlib-grant", "zlib-origin"]),
    ("Unlicense", ["unlicense-notice"]),
    ("Unlicense (full text)", ["unlicense-release", "unlicense-free"]),
    ("BSL-1.0", ["bsl-1.0-notice"]),
    ("BSL-1.0 (full text)", ["bsl-1.0-title"]),
    ("MPL-2.0", ["mpl-2.0-notice"]),
    ("MPL-2.0 (full text)", ["mpl-2.0-title"]),
    ("EPL-2.0", ["epl-2.0-notice"]),
    ("EPL-2.0 (full text)", ["epl-2.0-title"]),
    ("WTFPL", ["wtfpl-title"]),
    ("Artistic-1.0 (full text)", ["artistic-title"]),
    ("CC0-1.0", ["cc0-1.0-notice"]),
    ("CC0-1.0 (full text)", ["cc0-1.0-title"]),
    ("proprietary", ["reserved"]),
]
for _id, _, _ in _GNU:
    RULES += [(f"{_id.upper()}{kind}", [f"{_id}{kind}-notice"]) for kind in ("", "-only", "-or-later")]
    RULES.append((f"{_id.upper()} (full text)", [f"{_id}-title"]))
RULES += [(f"CC-{_k.upper()}-{_v}", [f"cc-{_k}-{_v}-notice"]) for _k in _CC for _v in ("4.0", "3.0")]
