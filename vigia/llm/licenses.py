"""Licence scan by Dice coefficients of word bigrams.

Every line, every sentence, every paragraph, the whole of a text and all runs of sentences across line breaks are compared with licence templates: one-line notices made
from licence names, and the standard wordings of short licences and file headers.  A Dice coefficient of ``t`` bounds the
ratio of the two sizes to between ``t / (2 - t)`` and its inverse, so that only templates of about a part's own size are
looked at.  It also means that a part has at least ``t / (2 - t)`` of a template's bigrams, and so one at least of any other few
of them: texts and lines with none of these few, chosen among the rarer ones, need no comparison.

A notice without the name, as "This work is licensed under the", is nearly all of many notices: the words that tell the licence must
be in the part as well.
"""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from functools import lru_cache
from math import ceil

from pyspark.sql import DataFrame

from vigia.llm.common import annotate

#: Dice coefficient from which a part counts as the licence.
LEAST = 0.8

#: Licences by identifier, with the names they go by.
NAMES = {
    "MIT": ("MIT License", "MIT license terms", "MIT"),
    "Apache-2.0": ("Apache License, Version 2.0", "Apache License 2.0", "Apache 2.0 License"),
    "BSD-2-Clause": ("BSD 2-Clause License", "simplified BSD License"),
    "BSD-3-Clause": ("BSD 3-Clause License", "new BSD License", "BSD-style license"),
    "ISC": ("ISC License",),
    "Zlib": ("zlib License",),
    "BSL-1.0": ("Boost Software License, Version 1.0",),
    "Unlicense": ("Unlicense",),
    "MPL-2.0": ("Mozilla Public License, version 2.0", "Mozilla Public License 2.0"),
    "EPL-2.0": ("Eclipse Public License, version 2.0", "Eclipse Public License v2.0"),
    "GPL-2.0": ("GNU General Public License, version 2", "GNU GPL v2", "GPLv2"),
    "GPL-3.0": ("GNU General Public License, version 3", "GNU GPL v3", "GPLv3"),
    "LGPL-2.1": ("GNU Lesser General Public License, version 2.1",),
    "LGPL-3.0": ("GNU Lesser General Public License, version 3",),
    "AGPL-3.0": ("GNU Affero General Public License, version 3",),
    "CC0-1.0": ("CC0 1.0 Universal", "Creative Commons Zero 1.0"),
    "CC-BY-4.0": ("CC BY 4.0", "Creative Commons Attribution 4.0 International License"),
    "CC-BY-SA-4.0": ("CC BY-SA 4.0", "Creative Commons Attribution-ShareAlike 4.0 International License"),
    "CC-BY-ND-4.0": ("CC BY-ND 4.0", "Creative Commons Attribution-NoDerivatives 4.0 International License"),
    "CC-BY-NC-4.0": ("CC BY-NC 4.0", "Creative Commons Attribution-NonCommercial 4.0 International License"),
    "CC-BY-NC-SA-4.0": ("CC BY-NC-SA 4.0", "Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International License"),
    "CC-BY-NC-ND-4.0": ("CC BY-NC-ND 4.0", "Creative Commons Attribution-NonCommercial-NoDerivatives 4.0 International License"),
}
#: How notices begin; each is put before each name, with and without an article.
PHRASES = ("Licensed under", "Released under", "Distributed under", "Available under", "Published under", "This work is licensed under",
           "This file is licensed under", "This software is licensed under", "This project is licensed under", "This program is licensed under",
           "This content is licensed under", "Dual licensed under", "Subject to the terms of", "Distributed under the terms of")
#: The parts of standard wordings; a disclaimer is the same words under several licences, so none is a template of its own.
_MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files
    (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify,
    merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is
    furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included
    in all copies or substantial portions of the Software."""
_MIT_DISCLAIMER = """THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF
    MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE
    LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN
    CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""
_ISC = """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided
    that the above copyright notice and this permission notice appear in all copies."""
_ISC_DISCLAIMER = """THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED
    WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR
    CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT,
    NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."""
_BSD = """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following
    conditions are met: Redistributions of source code must retain the above copyright notice, this list of conditions and the
    following disclaimer. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the
    following disclaimer in the documentation and/or other materials provided with the distribution."""
_BSD_THIRD = """Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from
    this software without specific prior written permission."""
_BSD_DISCLAIMER = """THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT
    NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL
    THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES
    (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS
    INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE
    OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""
_ZLIB_DISCLAIMER = """This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any
    damages arising from the use of this software."""
_ZLIB = """Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and
    redistribute it freely, subject to the following restrictions: The origin of this software must not be misrepresented; you must
    not claim that you wrote the original software. If you use this software in a product, an acknowledgment in the product
    documentation would be appreciated but is not required. Altered source versions must be plainly marked as such, and must not be
    misrepresented as being the original software. This notice may not be removed or altered from any source distribution."""
_BSL = """Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and accompanying
    documentation covered by this license (the "Software") to use, reproduce, display, distribute, execute, and transmit the Software,
    and to prepare derivative works of the Software, and to permit third-parties to whom the Software is furnished to do so, all
    subject to the following: The copyright notices in the Software and this entire statement, including the above license grant, this
    restriction and the following disclaimer, must be included in all copies of the Software, in whole or in part, and all derivative
    works of the Software, unless such copies or derivative works are solely in the form of machine-executable object code generated
    by a source language processor."""
_BSL_DISCLAIMER = """THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF
    MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE, TITLE AND NON-INFRINGEMENT. IN NO EVENT SHALL THE COPYRIGHT HOLDERS OR ANYONE
    DISTRIBUTING THE SOFTWARE BE LIABLE FOR ANY DAMAGES OR OTHER LIABILITY, WHETHER IN CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT
    OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""
_UNLICENSE = """This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile,
    sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-
    commercial, and by any means. In jurisdictions that recognize copyright laws, the author or authors of this software dedicate any
    and all copyright interest in the software to the public domain. We make this dedication for the benefit of the public at large
    and to the detriment of our heirs and successors. We intend this dedication to be an overt act of relinquishment in perpetuity of
    all present and future rights to this software under copyright law."""
_UNLICENSE_DISCLAIMER = """THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF
    MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS BE LIABLE FOR ANY CLAIM,
    DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE
    SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""
#: Standard wordings, with and without the disclaimer.
WORDINGS = {
    "All-Rights-Reserved": ("All rights reserved.", "Copyright. All rights reserved."),
    "MIT": (_MIT, f"{_MIT} {_MIT_DISCLAIMER}"),
    "ISC": (_ISC, f"{_ISC} {_ISC_DISCLAIMER}"),
    "BSD-2-Clause": (_BSD, f"{_BSD} {_BSD_DISCLAIMER}"),
    "BSD-3-Clause": (f"{_BSD} {_BSD_THIRD}", f"{_BSD} {_BSD_THIRD} {_BSD_DISCLAIMER}"),
    "Zlib": (_ZLIB, f"{_ZLIB_DISCLAIMER} {_ZLIB}"),
    "BSL-1.0": (_BSL, f"{_BSL} {_BSL_DISCLAIMER}"),
    "Apache-2.0": ("""Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the
        License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or
        agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS
        OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the
        License.""",),
    "GPL-3.0": ("""This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as
        published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.""",),
    "GPL-2.0": ("""This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as
        published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version.""",),
    "LGPL-3.0": ("""This library is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License
        as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.""",),
    "LGPL-2.1": ("""This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License
        as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version.""",),
    "AGPL-3.0": ("""This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License
        as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.""",),
    "MPL-2.0": ("""This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed
        with this file, You can obtain one at http://mozilla.org/MPL/2.0/.""",),
    "Unlicense": ("This is free and unencumbered software released into the public domain.", _UNLICENSE, f"{_UNLICENSE} {_UNLICENSE_DISCLAIMER}"),
}

_WORD = re.compile(r"\w+")
_SENTENCE = re.compile(r"(?<=[.!?])\s+")
_UNIT = re.compile(r"(?<=[.!?])\s+|\n")
_PARAGRAPH = re.compile(r"\n\s*\n")
_YEAR = re.compile(r"(?:19|20)\d\d")
#: Words too common in any text to tell a licence.
_VAGUE = frozenset("the license licence version public international terms style software".split())
_COMMON = frozenset("a an and any are at be by can for from in is it may not of on or that the this to under with you".split())

Grams = frozenset[tuple[str, str]]


def normalised(text: str) -> list[str]:
    """Words in lower case; punctuation, markup signs and the numbers of years are left out."""
    words = _WORD.findall(text.lower())
    return [w for w in words if not (len(w) == 4 and _YEAR.fullmatch(w))] if _YEAR.search(text) else words


def bigrams(words: list[str]) -> Grams:
    return frozenset(zip(words, words[1:]))


def dice(a: Grams, b: Grams) -> float:
    return 2 * len(a & b) / (len(a) + len(b)) if a or b else 0.0


class Templates:
    """Templates in order of size."""

    def __init__(self, least: float = LEAST):
        texts = {(name, "", t) for name, wordings in WORDINGS.items() for t in wordings}
        texts |= {(name, called, f"{phrase} {the}{called}") for name, names in NAMES.items() for called in names for phrase in PHRASES
                  for the in ("", "the ")}
        texts |= {(name, name, f"SPDX-License-Identifier: {name}") for name in NAMES}
        found = {(name, frozenset(normalised(called)) - _VAGUE, bigrams(normalised(text))) for name, called, text in texts}
        self.least = least
        #: Size, licence, words that must be there, bigrams.
        self.templates = sorted(((len(grams), name, needed, grams) for name, needed, grams in found if grams),
                                key=lambda t: (t[0], t[1], sorted(t[2]), sorted(t[3])))
        self.sizes = [t[0] for t in self.templates]
        self.anchors = frozenset(gram for size, _, _, grams in self.templates for gram in sorted(
            grams, key=lambda g: (len(_COMMON & {*g}), g))[:size - ceil(size * least / (2 - least) - 1e-9) + 1])
        self.known = frozenset().union(*(t[3] for t in self.templates))
        self.largest = self.sizes[-1] * (2 - least) / least

    def best(self, grams: Grams) -> tuple[float, str, Grams] | None:
        """The closest template within the bounds: coefficient, licence, bigrams; of ties the first by name."""
        size = len(grams)
        first = bisect_left(self.sizes, size * self.least / (2 - self.least) - 1e-9)
        last = bisect_right(self.sizes, size * (2 - self.least) / self.least + 1e-9)
        found, words = None, {w for gram in grams for w in gram}
        for _, name, needed, template in self.templates[first:last]:
            score = dice(grams, template)
            if score >= self.least and needed <= words and (found is None or (-score, name) < (-found[0], found[1])):
                found = score, name, template
        return found

    def scan(self, text: str | None) -> list[tuple[str, float, str]]:
        """(licence, Dice coefficient, part) for each licence of a text: its closest part, the first of ties."""
        found: dict[str, tuple[float, str]] = {}

        def look(part: str, grams: Grams) -> Grams:
            hit = self.best(grams)
            if hit and hit[0] > found.get(hit[1], (0.0, ""))[0]:
                found[hit[1]] = hit[0], part
            return hit[2] if hit else frozenset()

        words = normalised(text or "")
        if self.anchors.isdisjoint(zip(words, words[1:])):
            return []
        for line in text.split("\n"):
            grams = bigrams(normalised(line))
            if self.anchors.isdisjoint(grams):
                continue
            # Of a line that is a licence as a whole, only sentences that are not of its wording may be another one.
            wording = look(line, grams) if len(grams) <= self.largest else frozenset()
            sentences = _SENTENCE.split(line)
            if len(sentences) > 1:
                for sentence in sentences:
                    own = bigrams(normalised(sentence))
                    if 2 * len(own & wording) < len(own):
                        look(sentence, own)
        if "\n" in text:
            paragraphs = _PARAGRAPH.split(text)
            for part in [*(p for p in paragraphs if "\n" in p), *([text] if len(paragraphs) > 1 else [])]:
                grams = bigrams(normalised(part))
                if len(grams) <= self.largest:
                    look(part, grams)
        for name, (score, part) in self.windows(text).items():
            if score > found.get(name, (0.0, ""))[0]:
                found[name] = score, part
        return [(name, score, part.strip()) for name, (score, part) in sorted(found.items())]

    def windows(self, text: str) -> dict[str, tuple[float, str]]:
        """Licences of runs of two or more sentences or lines, whatever line breaks and paragraphs are between them.

        A window has no more bigrams than the bounds allow, and no more than twice as many words.  An end without a bigram of any template
        only lowers its coefficients, so that windows begin and end where there is one.  A licence found inside a window of another one is a
        part of that one's wording.
        """
        units, at = [], 0
        for stop in [*_UNIT.finditer(text), None]:
            words = normalised(text[at:stop.start() if stop else len(text)])
            if words:
                units.append((at, stop.start() if stop else len(text), words))
            at = stop.end() if stop else at
        # Each unit's bigrams, with the one that leads into it.
        own = [bigrams(words) for *_, words in units]
        lead = [None, *((a[2][-1], b[2][0]) for a, b in zip(units, units[1:]))]
        inside = [not self.known.isdisjoint(grams) for grams in own]
        found: dict[str, tuple[float, int, int]] = {}
        for i in range(len(units) - 1):
            # Of a run of equal lines the last one begins.
            if not (inside[i] or lead[i + 1] in self.known) or units[i][2] == units[i + 1][2]:
                continue
            grams, count = set(own[i]), len(units[i][2])
            for j in range(i + 1, len(units)):
                before = len(grams)
                grams |= own[j]
                grams.add(lead[j])
                count += len(units[j][2])
                if len(grams) > self.largest or count > 2 * self.largest:
                    break
                if len(grams) == before or not (inside[j] or lead[j] in self.known) or self.anchors.isdisjoint(grams):
                    continue
                hit = self.best(frozenset(grams))
                if hit and hit[0] > found.get(hit[1], (0.0, 0, 0))[0]:
                    found[hit[1]] = hit[0], units[i][0], units[j][1]
        return {name: (score, text[a:b]) for name, (score, a, b) in found.items()
                if not any(other != name and c <= a and b <= d and d - c > b - a for other, (_, c, d) in found.items())}


@lru_cache(maxsize=4)
def templates(least: float) -> Templates:
    return Templates(least)


def scan_licenses(df: DataFrame, *, text: str = "text", least: float = LEAST, licenses: str = "licenses", scores: str = "license_scores",
                  parts: str = "license_parts") -> DataFrame:
    """``df`` with three array columns: the licences that the whole column ``text`` holds, the Dice coefficient of the part closest to
    each, and that part.

    NULL and empty texts have none.  Very long texts are searched to the end, in windows that the largest template bounds; of parts equally close
    to a licence the first counts.  Repeated rows get the same; an empty table gives no rows.  Columns named like a new one are
    replaced, all others kept.
    """
    def make():
        tool = templates(least)

        def work(texts):
            found = [tool.scan(t) for t in texts]
            return {name: [[f[k] for f in fs] for fs in found] for k, name in enumerate((licenses, scores, parts))}

        return work

    return annotate(df, text, make, {licenses: "array<string>", scores: "array<double>", parts: "array<string>"})
