"""License scans: Dice coefficient over word bigrams against license templates."""

from __future__ import annotations

import math
import re
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: The public wording of licenses and of their usual notices.
TEMPLATES = {
    "MIT": """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated
documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use,
copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the
Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice
shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF
ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE
AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY,
WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR
OTHER DEALINGS IN THE SOFTWARE.""",
    "BSD-2-Clause": """Redistribution and use in source and binary forms, with or without modification, are permitted provided that
the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of
conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of
conditions and the following disclaimer in the documentation and/or other materials provided with the distribution. THIS SOFTWARE IS
PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO,
THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER
OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT
LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND
ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT
OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.""",
    "0BSD": """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted. THE
SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF
MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY
DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS
ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.""",
    "Zlib": """This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for
any damages arising from the use of this software. Permission is granted to anyone to use this software for any purpose, including
commercial applications, and to alter it and redistribute it freely, subject to the following restrictions: 1. The origin of this
software must not be misrepresented; you must not claim that you wrote the original software. If you use this software in a product, an
acknowledgment in the product documentation would be appreciated but is not required. 2. Altered source versions must be plainly marked as
such, and must not be misrepresented as being the original software. 3. This notice may not be removed or altered from any source
distribution.""",
    "Unlicense": """This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use,
compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or
non-commercial, and by any means. In jurisdictions that recognize copyright laws, the author or authors of this software dedicate any and
all copyright interest in the software to the public domain. We make this dedication for the benefit of the public at large and to the
detriment of our heirs and successors. We intend this dedication to be an overt act of relinquishment in perpetuity of all present and
future rights to this software under copyright law. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED,
INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL
THE AUTHORS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT
OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.""",
    "WTFPL": """Everyone is permitted to copy and distribute verbatim or modified copies of this license document, and changing it is allowed
as long as the name is changed.""",
    "Apache-2.0-header": """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in
compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required
by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT
WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions
and limitations under the License.""",
    "ISC": """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby
granted, provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED "AS
IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND
FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES
WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION,
ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.""",
    "BSD-3-Clause": """Redistribution and use in source and binary forms, with or without modification, are permitted provided that
the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of
conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of
conditions and the following disclaimer in the documentation and/or other materials provided with the distribution. 3. Neither the
name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this
software without specific prior written permission. THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND
ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A
PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT,
INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR
SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN
CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF
ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.""",
    "MPL-2.0-header": """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL
was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.""",
}

# Names and versions of licenses that are known by a notice, and the usual wording of notices.
_GNU = {"GPL": "GNU General Public License", "LGPL": "GNU Lesser General Public License", "AGPL": "GNU Affero General Public License"}
_GNU_VERSIONS = {"GPL": ("2.0", "3.0"), "LGPL": ("2.1", "3.0"), "AGPL": ("3.0",)}
_GNU_HEADER = """This program is free software: you can redistribute it and/or modify it under the terms of the {name} as published by the Free
Software Foundation, either version {version} of the License, or (at your option) any later version. This program is distributed in the hope
that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR
PURPOSE. See the {name} for more details. You should have received a copy of the {name} along with this program. If not, see
https://www.gnu.org/licenses/."""
_CC = {"BY": "Attribution", "BY-SA": "Attribution-ShareAlike", "BY-ND": "Attribution-NoDerivatives", "BY-NC": "Attribution-NonCommercial",
       "BY-NC-SA": "Attribution-NonCommercial-ShareAlike", "BY-NC-ND": "Attribution-NonCommercial-NoDerivatives"}
_CC_VERSIONS = ("2.0", "2.5", "3.0", "4.0")
_NAMED = {"MIT": "MIT License", "Apache-2.0": "Apache License, Version 2.0", "BSD-2-Clause": "BSD 2-Clause License", "BSD-3-Clause": "BSD 3-Clause License",
          "ISC": "ISC License", "MPL-2.0": "Mozilla Public License, version 2.0", "EPL-2.0": "Eclipse Public License, version 2.0",
          "CC0-1.0": "CC0 1.0 Universal Public Domain Dedication", "Artistic-2.0": "Artistic License 2.0", "BSL-1.0": "Boost Software License, version 1.0",
          "Unlicense": "The Unlicense", "Zlib": "zlib License"}


def _notices() -> dict[str, str]:
    """Notices, drawn from names and versions: ``<license>-notice``, ``-notice-2`` and so on."""
    lines: dict[str, list[str]] = {}
    for short, name in _GNU.items():
        for version in _GNU_VERSIONS[short]:
            number = version.removesuffix(".0")
            lines[f"{short}-{version}"] = [f"licensed under the {name}, version {number}", f"{name}, version {number}", f"{name} v{number}"]
            lines[f"{short}-{version}-header"] = [_GNU_HEADER.format(name=name, version=number)]
    for short, name in _CC.items():
        for version in _CC_VERSIONS:
            kind = "International" if version == "4.0" else "Unported" if version == "3.0" else "Generic"
            lines[f"CC-{short}-{version}"] = [
                f"licensed under CC {short} {version}", f"licensed under a Creative Commons {name} {version} {kind} License",
                f"Creative Commons {name} {version} {kind}"]
    for short, name in _NAMED.items():
        lines.setdefault(short, []).extend([f"licensed under the {name.removeprefix('The ')}", f"released under the {name.removeprefix('The ')}"])
    found = {}
    for short, wordings in lines.items():
        if short.endswith("-header"):
            found[short] = wordings[0]
            continue
        for i, wording in enumerate([*wordings, f"SPDX-License-Identifier: {short}"]):
            found[f"{short}-notice" + (f"-{i + 1}" if i else "")] = wording
    return found


TEMPLATES |= _notices()

_WORD = re.compile(r"[^\W_]+")
_FORM = re.compile(r"-(?:header|notice(?:-\d+)?)$")


def license_of(template: str) -> str:
    """The license a template stands for: its name without the form."""
    return _FORM.sub("", template)


def normalised(text: str | None) -> list[str]:
    """Words in lower case, without punctuation and markup."""
    return _WORD.findall((text or "").lower())


class TemplateIndex:
    """Templates as multisets of word bigrams, with the window sizes at which each can reach ``least``.

    Dice of n and m bigrams is at most 2·min(n, m) / (n + m), so a window of n bigrams can match a template of m only for
    m·least / (2 − least) <= n <= m·(2 − least) / least. Short notices differ in a word or two: where a template has bigrams that no
    template of another license has, a window must hold one of them.
    """

    def __init__(self, templates: dict[str, str], least: float) -> None:
        self.least = least
        self.bigrams, self.bounds, self.by_bigram = {}, {}, {}
        for name, text in templates.items():
            words = normalised(text)
            grams = Counter(zip(words, words[1:]))
            m = sum(grams.values())
            if m:
                self.bigrams[name] = grams
                self.bounds[name] = (m, math.ceil(m * least / (2 - least) - 1e-9), math.floor(m * (2 - least) / least + 1e-9))
                for gram in grams:
                    self.by_bigram.setdefault(gram, []).append(name)
        self.words = {w for gram in self.by_bigram for w in gram}
        shared = {gram for gram, names in self.by_bigram.items() if len({license_of(n) for n in names}) > 1}
        self.own = {name: set(grams) - shared for name, grams in self.bigrams.items()}

    def matches(self, text: str | None) -> list[tuple[str, float, int, int]]:
        """(template, dice, first word, words) of the windows that stand, best first.

        Of overlapping windows of one license the longest stands. Of windows of several licenses that take the same place, which is where they
        share more than half of the longer one, the most similar stands; at a tie the longer, the earlier, the first by name."""
        of_license: dict[str, list[tuple[str, float, int, int]]] = {}
        for x in sorted(self.windows(text), key=lambda x: (-x[3], -x[1], x[2], x[0])):
            mine = of_license.setdefault(license_of(x[0]), [])
            if all(x[2] + x[3] <= y[2] or y[2] + y[3] <= x[2] for y in mine):
                mine.append(x)
        stands: list[tuple[str, float, int, int]] = []
        for x in sorted((x for mine in of_license.values() for x in mine), key=lambda x: (-x[1], -x[3], x[2], x[0])):
            if all(2 * (min(x[2] + x[3], y[2] + y[3]) - max(x[2], y[2])) <= max(x[3], y[3]) for y in stands):
                stands.append(x)
        return sorted(stands, key=lambda x: (-x[1], x[2], x[0]))

    def windows(self, text: str | None) -> list[tuple[str, float, int, int]]:
        """(template, dice, first word, words) of each template's best windows, none overlapping another of its template."""
        words = normalised(text)
        known = [i for i, w in enumerate(words) if w in self.words]
        hits: dict[str, list[int]] = {}
        for i, j in zip(known, known[1:]):
            if j == i + 1:
                for name in self.by_bigram.get((words[i], words[j]), ()):
                    hits.setdefault(name, []).append(i)
        found = []
        for name, at in hits.items():
            m, low, high = self.bounds[name]
            if min(len(words) - 1, len(at)) < low * self.least:
                continue
            found += self._best(name, words, at, m, low, high)
        return found

    def _best(self, name, words, at, m, low, high):
        need, grams, own, windows = max(1, math.ceil(self.least * low / 2)), self.bigrams[name], self.own[name], []
        for k, start in enumerate(at):
            stop = bisect_right(at, start + high - 1)
            if stop - k < need:
                continue
            used, common, known = Counter(), 0, not own
            for i in at[k:stop]:
                gram = (words[i], words[i + 1])
                used[gram] += 1
                common += used[gram] <= grams[gram]
                known = known or gram in own
                n = i - start + 1
                if known and n >= low and 2 * common >= self.least * (m + n):
                    windows.append((-2 * common / (m + n), start, n))
        taken, last = [], []
        for minus, start, n in sorted(windows):
            if all(start + n < a or a + b < start for a, b in last):
                last.append((start, n))
                taken.append((name, -minus, start, n + 1))
        return taken


def scan_licenses(docs: DataFrame, templates: dict[str, str] | None = None, least: float = 0.8) -> DataFrame:
    """``doc_id, license, dice, first_word, n_words``: windows of the texts that match a template.

    Whole texts are scanned; a window starts and ends with a bigram of the template, has a size within the
    template's bounds and a Dice coefficient of ``least`` or more. Of overlapping windows of a template the best stays (at a tie the
    earlier, then the shorter), and of templates that match one place the best (see ``TemplateIndex.matches``). Null and empty texts match nothing; a null doc_id is kept; repeated rows report
    each; an empty table gives no rows. Needs no shuffle; the templates are the only thing sent to tasks.
    """
    index = TemplateIndex(TEMPLATES if templates is None else templates, least)

    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = [(d, *m) for d, t in zip(batch["doc_id"], batch["text"]) for m in index.matches(t)]
            yield pd.DataFrame(rows, columns=["doc_id", "license", "dice", "first_word", "n_words"])

    return docs.select(F.col("doc_id").cast("string"), "text").mapInPandas(
        scan, "doc_id string, license string, dice double, first_word long, n_words long").withColumn(
        "doc_id", F.col("doc_id").cast("long"))
