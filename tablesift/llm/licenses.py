"""License scans by conditional compression (operator 8).

Windows of words are compared with every template; a window is twice as long as
the template and starts every half of one, whatever the lines are, so a notice isn't
cut.  A template's windows lie around its own rarest words, as many as can't all be
missing where ``LEAST_SHARE`` of its words are there, so no window that could be a
notice is left out; one whose words can't reach that share in any order is passed over.

The others are the candidate blocks.  Each is compressed with zstandard, alone and
with every template as raw dictionary, and the templates are ranked by how much smaller
they make it.  The ``WINNERS`` that make it smallest, by ``LEAST_REDUCTION`` at least, are
winners, and so are templates that come as near to the last of them as ``NEAR``; no other
template is looked for in the block.  Winners are confirmed by their exact
wording: words of template and block are aligned, with no more than ``MOST_BETWEEN``
foreign words at a place, and the share of the template's words that stand there in order
must reach ``LEAST_SHARE``; what is missing or different is reported.  Words that say
which license it is, names and versions, must all stand there, and none that makes it another
one, such as "lesser".  Where notices overlap, the one that is nearer in wording counts, then the one
that ranked higher.

Each text is worked off on its own in Arrow batches; nothing is shuffled, and
a task holds the templates and one text.

Defined results: null and empty texts have no rows; a text of any
length is read whole; equal rows give equal rows; of templates that gain the
same the first by name wins; an empty table gives no rows.  Other columns are
not read.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from difflib import SequenceMatcher
from functools import lru_cache

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession

from tablesift.llm.common import slices, table

#: Share of a template's words that must stand in the window, in order.
LEAST_SHARE = 0.8
#: Foreign words that may stand between two words of a notice.
MOST_BETWEEN = 3
LEVEL = 3
#: Templates that are confirmed in a block, the least by which they make it smaller, and what counts as equal.
WINNERS = 3
LEAST_REDUCTION = 0.1
NEAR = 0.05

# License texts and notices, by name.
TEMPLATES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0-notice": 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.',
    "BSD-2-Clause-text": 'Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution. THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.',
    "BSD-3-Clause": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",
    "BSL-1.0-text": 'Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and accompanying documentation covered by this license (the "Software") to use, reproduce, display, distribute, execute, and transmit the Software, and to prepare derivative works of the Software, and to permit third-parties to whom the Software is furnished to do so, all subject to the following: The copyright notices in the Software and this entire statement, including the above license grant, this restriction and the following disclaimer, must be included in all copies of the Software, in whole or in part, and all derivative works of the Software, unless such copies or derivative works are solely in the form of machine-executable object code generated by a source language processor. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE, TITLE AND NON-INFRINGEMENT. IN NO EVENT SHALL THE COPYRIGHT HOLDERS OR ANYONE DISTRIBUTING THE SOFTWARE BE LIABLE FOR ANY DAMAGES OR OTHER LIABILITY, WHETHER IN CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.',
    "CC-BY-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "CC-BY-SA-4.0": "Licensed under CC BY-SA 4.0.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-3.0-notice": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "ISC": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
    "ISC-text": 'Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.',
    "MIT": "Released under the MIT License.",
    "MIT-notice": 'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:',
    "MIT-text": 'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.',
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.",
    "Unlicense-text": 'This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means. In jurisdictions that recognize copyright laws, the author or authors of this software dedicate any and all copyright interest in the software to the public domain. We make this dedication for the benefit of the public at large and to the detriment of our heirs and successors. We intend this dedication to be an overt act of relinquishment in perpetuity of all present and future rights to this software under copyright law.',
    "Zlib-text": "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software. Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions: 1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software. If you use this software in a product, an acknowledgment in the product documentation would be appreciated but is not required. 2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software. 3. This notice may not be removed or altered from any source distribution.",
}

# Words that most English texts have.
_COMMON = frozenset("a all an and any are as at be by for from in is it not of on or other that the this to under use used was with without work you".split())
# Words that name a license, besides those with a digit, and words that make another one of it.
_NAMES = frozenset("apache mit bsd isc gnu general mozilla boost creative commons attribution by-nc by-sa".split())
_OTHERS = frozenset("affero lesser library noncommercial non-commercial noderivatives noderivs sharealike share-alike".split())
_WORD = re.compile(r"\w+(?:[.'-]\w+)*")

_ROWS = pa.schema([("doc_id", pa.int64()), ("license", pa.string()), ("start", pa.int64()), ("stop", pa.int64()), ("reduction", pa.float64()), ("share", pa.float64()), ("missing", pa.string())])


def words(text: str) -> list[str]:
    return _WORD.findall(text.lower())


def cues(template: list[str]) -> set[str]:
    """The rarest words of a template, longest first: more occurrences than may be missing."""
    found: set[str] = set()
    counts, missing = Counter(template), len(template) - math.ceil(LEAST_SHARE * len(template))
    for word in sorted(counts, key=lambda w: (w in _COMMON, -len(w), w)):
        if missing < 0:
            break
        found.add(word)
        missing -= counts[word]
    return found


def deciding(template: list[str]) -> set[str]:
    """Words of a template without which it is no notice of that license: names, and numbers of versions."""
    return {w for w in template if w in _NAMES or (any(c.isdigit() for c in w) and not w.startswith("http"))}


def is_the_one(template: Template, missing: str, own: list[str]) -> bool:
    """Whether all deciding words are among those of a notice, ``own``, and none that makes another license of it."""
    held = template.bag - Counter(missing.split())
    numbers = {w.removesuffix(".0") for w in own}
    return all(held[w] or (w[0].isdigit() and w.removesuffix(".0") in numbers) for w in template.deciding) and not (_OTHERS & set(own)) - set(template.bag)


@dataclass(frozen=True)
class Template:
    name: str
    words: list[str]
    bag: Counter
    deciding: set[str]
    cues: set[str]
    compressor: zstandard.ZstdCompressor


@lru_cache(2)
def _prepared(templates: tuple[tuple[str, str], ...]) -> tuple[list[Template], set[str]]:
    """Templates with a compressor that has them as raw dictionary, and the cues of all."""
    out = []
    for name, text in sorted(templates):
        raw = zstandard.ZstdCompressionDict(text.lower().encode(), dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        own = words(text)
        out.append(Template(name, own, Counter(own), deciding(own), cues(own), zstandard.ZstdCompressor(level=LEVEL, dict_data=raw, write_content_size=False, write_checksum=False)))
    return out, set().union(*(t.cues for t in out))


def candidate_windows(at: list[int], n: int, length: int) -> Iterator[tuple[int, int]]:
    """First and last word, exclusive, of overlapping windows for a template of ``length`` words, on both sides of each cue."""
    wide, step, upto = 2 * length, max(1, length // 2), -1
    for cue in at:
        for start in range(max(0, cue - wide) // step * step, min(n, cue + 1), step):
            if start > upto:
                yield start, min(n, start + wide)
                upto = start


def confirmed(template: list[str], own: list[str]) -> tuple[float, int, int, str]:
    """Share of the template's words that the window has in order, its first and last word there, and the words that differ.

    Words farther apart than ``MOST_BETWEEN`` are not of one notice; the part with the most words counts.
    """
    parts: list[list] = []
    for m in SequenceMatcher(None, template, own, autojunk=False).get_matching_blocks():
        if m.size:
            if parts and m.b - (parts[-1][-1].b + parts[-1][-1].size) <= MOST_BETWEEN:
                parts[-1].append(m)
            else:
                parts.append([m])
    best = max(parts, key=lambda part: sum(m.size for m in part), default=None)
    if best is None:
        return 0.0, 0, 0, " ".join(template)
    held = {i for m in best for i in range(m.a, m.a + m.size)}
    return len(held) / len(template), best[0].b, best[-1].b + best[-1].size - 1, " ".join(w for i, w in enumerate(template) if i not in held)


def winners(reductions: list[float], most: int = WINNERS, least: float = LEAST_REDUCTION) -> set[int]:
    """The templates that make a block smallest."""
    ranked = sorted(reductions, reverse=True)
    floor = max(least, ranked[min(most, len(ranked)) - 1] - NEAR) if ranked else least
    return {k for k, r in enumerate(reductions) if r >= floor}


def licenses_in(text: str, templates: dict[str, str] = TEMPLATES, most: int = WINNERS, least: float = LEAST_REDUCTION) -> list[tuple[str, int, int, float, float, str]]:
    """License, start, end, reduction, share and missing words of each notice in a text."""
    prepared, all_cues = _prepared(tuple(templates.items()))
    if all_cues.isdisjoint(words(text)):
        return []
    spans = [m.span() for m in _WORD.finditer(text)]
    own = [text[a:b].lower() for a, b in spans]
    at: dict[str, list[int]] = {}
    for i, word in enumerate(own):
        if word in all_cues:
            at.setdefault(word, []).append(i)
    plain = zstandard.ZstdCompressor(level=LEVEL, write_content_size=False, write_checksum=False)
    blocks: dict[tuple[int, int], list[int]] = {}  # windows, and the templates that they are for
    for k, template in enumerate(prepared):
        near = sorted(i for cue in template.cues for i in at.get(cue, ()))
        for first, after in candidate_windows(near, len(own), len(template.words)):
            # The share can't be larger than that of the words in any order.
            if sum((template.bag & Counter(w for w in own[first:after] if w in template.bag)).values()) >= LEAST_SHARE * len(template.words):
                blocks.setdefault((first, after), []).append(k)
    ranked: list[tuple[float, int, int, int]] = []  # reduction, template, window
    for (first, after), wanted in blocks.items():
        raw = text[spans[first][0] : spans[after - 1][1]].lower().encode(errors="replace")
        alone = len(plain.compress(raw))
        reductions = [1 - len(t.compressor.compress(raw)) / alone for t in prepared]
        best = winners(reductions, most, least)
        ranked += [(reductions[k], k, first, after) for k in wanted if k in best]
    found: list[tuple[str, int, int, float, float, str]] = []
    for _, k, first, after in sorted(ranked, key=lambda r: (-r[0], r[1:])):
        template = prepared[k]
        share, a, b, missing = confirmed(template.words, own[first:after])
        if share >= LEAST_SHARE and is_the_one(template, missing, own[first + a : min(first + b + 2, after)]):  # with a word behind, which may be the version
            start, stop = spans[first + a][0], spans[first + b][1]
            raw = text[start:stop].lower().encode(errors="replace")
            found.append((template.name, start, stop, 1 - len(template.compressor.compress(raw)) / len(plain.compress(raw)), share, missing))
    # Windows overlap: of one template's notices at a place the nearest counts.
    kept: list[tuple[str, int, int, float, float, str]] = []
    for f in sorted(found, key=lambda f: (f[0], -f[4], f[2] - f[1], f[1])):
        if not any(g[0] == f[0] and g[1] < f[2] and f[1] < g[2] for g in kept):
            kept.append(f)
    return sorted((f for f in kept if not any(_better(g, f) for g in kept)), key=lambda f: (f[1], f[2], f[0]))


def _better(g: tuple, f: tuple) -> bool:
    """Notice g stands where f does, and its wording is nearer or as near and longer; at the same place and share, what gains more and then the first by name."""
    if g[0] == f[0] or g[1] > f[1] or g[2] < f[2]:
        return False
    return g[4] > f[4] or (g[4] == f[4] and g[1:3] != f[1:3]) or (g[4] == f[4] and g[1:3] == f[1:3] and (-g[3], g[0]) < (-f[3], f[0]))


def scan(df: DataFrame, text: str = "text", templates: dict[str, str] = TEMPLATES) -> DataFrame:
    """One row per notice: doc_id, license, start, stop, reduction, share, missing."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, text):
                rows = [(doc, *found) for doc, t in zip(batch.column("doc_id").to_pylist(), batch.column(text).to_pylist()) if t for found in licenses_in(t, templates)]
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), _ROWS)], schema=_ROWS)

    return df.select("doc_id", text).mapInArrow(run, "doc_id long, license string, start long, stop long, reduction double, share double, missing string")


def op8_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """License notices in all documents."""
    return scan(table(spark, sf_dir, "documents").select("doc_id", "text"))
