"""Licence scan: parts of a text against licence templates by Dice coefficient over word bigrams.

Texts are lower-cased words of letters and digits, so comment marks, quotes and line ends do not count. A part is a line,
a paragraph (between empty lines), the whole text, or any window of as many bigrams as the template has, wherever it
begins: a licence above code, under a title or inside a sentence is found however it is laid out. A template is compared
with a part only if their sizes allow the wanted coefficient, and if they share bigrams. Templates are a short list that
goes to every task; texts stay where they are.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from statledger.llm.textarrays import LETTER_OR_DIGIT, slices, words

LEAST_DICE = 0.85

# Short statements, and published notices and texts of common licences. The full texts of the GNU, Mozilla and
# Apache licences end with the notice to be put into files, which is the template that finds them.
TEMPLATES: tuple[tuple[str, str], ...] = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    (
        "Apache-2.0",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance "
        "with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless "
        "required by applicable law or agreed to in writing, software distributed under the License is distributed on an "
        "\"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the "
        "specific language governing permissions and limitations under the License.",
    ),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    (
        "MIT",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation "
        "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and "
        "to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above "
        "copyright notice and this permission notice shall be included in all copies or substantial portions of the "
        "Software. THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT "
        "LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT "
        "SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION "
        "OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER "
        "DEALINGS IN THE SOFTWARE.",
    ),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    (
        "GPL-3.0",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public "
        "License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any "
        "later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without "
        "even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public "
        "License for more details.",
    ),
    (
        "GPL-2.0",
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public "
        "License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any "
        "later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without "
        "even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public "
        "License for more details.",
    ),
    (
        "LGPL-2.1",
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General "
        "Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your "
        "option) any later version. This library is distributed in the hope that it will be useful, but WITHOUT ANY "
        "WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU "
        "Lesser General Public License for more details.",
    ),
    (
        "AGPL-3.0",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General "
        "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) "
        "any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; "
        "without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU Affero "
        "General Public License for more details.",
    ),
    (
        "MPL-2.0",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not "
        "distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.",
    ),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    (
        "ISC",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
        "granted, provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE "
        "IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED "
        "WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, "
        "INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER "
        "IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR "
        "PERFORMANCE OF THIS SOFTWARE.",
    ),
    (
        "BSD-2-Clause",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
        "following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list "
        "of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright "
        "notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided "
        "with the distribution. THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY "
        "EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND "
        "FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE "
        "FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED "
        "TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER "
        "CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR "
        "OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.",
    ),
    (
        "BSD-3-Clause",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
        "following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list "
        "of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright "
        "notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided "
        "with the distribution. 3. Neither the name of the copyright holder nor the names of its contributors may be used "
        "to endorse or promote products derived from this software without specific prior written permission. THIS "
        "SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, "
        "INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE "
        "DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, "
        "INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF "
        "SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY "
        "THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING "
        "IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.",
    ),
    (
        "Zlib",
        "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held "
        "liable for any damages arising from the use of this software. Permission is granted to anyone to use this "
        "software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject "
        "to the following restrictions: 1. The origin of this software must not be misrepresented; you must not claim that "
        "you wrote the original software. If you use this software in a product, an acknowledgment in the product "
        "documentation would be appreciated but is not required. 2. Altered source versions must be plainly marked as "
        "such, and must not be misrepresented as being the original software. 3. This notice may not be removed or altered "
        "from any source distribution.",
    ),
    (
        "Unlicense",
        "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, "
        "use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any "
        "purpose, commercial or non-commercial, and by any means.",
    ),
    *((name, f"SPDX-License-Identifier: {name}") for name in (
        "Apache-2.0", "MIT", "GPL-3.0", "GPL-2.0", "LGPL-2.1", "LGPL-3.0", "AGPL-3.0", "MPL-2.0", "ISC", "BSD-2-Clause",
        "BSD-3-Clause", "Zlib", "Unlicense", "CC0-1.0", "CC-BY-4.0", "CC-BY-SA-4.0", "CC-BY-NC-4.0",
    )),
    ("proprietary", "All rights reserved."),
)


@dataclass
class Templates:
    """Bigrams of all templates: for each distinct one, the templates that have it and how often."""

    names: list[str]
    size: np.ndarray  # bigrams of each template
    known: np.ndarray  # distinct bigrams, sorted
    first: np.ndarray
    template: np.ndarray
    times: np.ndarray


def bigrams(templates: Sequence[tuple[str, str]]) -> Templates:
    own = words(pa.array([text for _, text in templates], pa.string()), LETTER_OR_DIGIT)
    at, value = own.windows(2)
    pairs, times = np.unique(np.stack([value, own.text[at].astype(np.uint64)]), axis=1, return_counts=True)
    known, first = np.unique(pairs[0], return_index=True)
    return Templates(
        [name for name, _ in templates],
        np.bincount(own.text[at], minlength=len(templates)),
        known,
        np.append(first, len(times)),
        pairs[1].astype(np.int64),
        times,
    )


def entries(gram: np.ndarray, templates: Templates) -> tuple[np.ndarray, np.ndarray]:
    """For known bigrams by number, a row for each template that has them: the bigram's place here, the entry there."""
    each = np.diff(templates.first)[gram]
    row = np.repeat(np.arange(len(gram)), each)
    return row, templates.first[gram][row] + np.arange(len(row)) - np.repeat(np.cumsum(each) - each, each)


def windows(text: np.ndarray, near: np.ndarray, gram: np.ndarray, templates: Templates, least: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Text, template and coefficient of the best window of each template's size, where it reaches ``least``.

    ``text`` is the text of each bigram, ``near`` the places of known ones and ``gram`` their numbers. A bigram that a
    template has n times counts in the windows that begin after its n-th last occurrence; each occurrence therefore adds
    one to a stretch of beginnings, and all windows are told by one running sum over the ends of these stretches.
    A text shorter than the template is one window.
    """
    length = np.bincount(text)
    begin = np.cumsum(length) - length
    row, entry = entries(gram, templates)
    place = (near - begin[text[near]])[row]
    of_text, template, gram, times = text[near][row], templates.template[entry], gram[row], templates.times[entry]
    kinds = len(templates.names)
    pair = of_text * kinds + template
    n, size = length[of_text], templates.size[template]
    # Fewer shared bigrams than this in the whole text leave every window below the wanted coefficient.
    _, back, have = np.unique(pair, return_inverse=True, return_counts=True)
    possible = 2 * have[back] >= least * (np.minimum(n, size) + size) - 1e-9
    pair, gram, place, times, n, size = (x[possible] for x in (pair, gram, place, times, n, size))
    if not len(pair):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
    order = np.lexsort((place, gram, pair))
    pair, gram, place, times, n, size = (x[order] for x in (pair, gram, place, times, n, size))
    earlier = np.arange(len(pair)) - times
    same = (earlier >= 0) & (pair[earlier] == pair) & (gram[earlier] == gram)
    low = np.maximum(np.where(same, place[earlier] + 1, 0), np.maximum(place - size + 1, 0))
    high = np.minimum(place, np.maximum(n - size, 0))
    real = low <= high
    ends = np.concatenate([low[real], high[real] + 1])
    step = np.repeat([1, -1], int(real.sum()))
    pair = np.tile(pair[real], 2)
    order = np.lexsort((step, ends, pair))
    first = np.flatnonzero(np.append(True, np.diff(pair[order]) != 0))
    common = np.maximum.reduceat(np.cumsum(step[order]), first)
    of_text, template = pair[order][first] // kinds, pair[order][first] % kinds
    dice = 2 * common / (np.minimum(length[of_text], templates.size[template]) + templates.size[template])
    good = dice >= least
    return of_text[good], template[good], dice[good]


def compare(column: pa.Array, templates: Templates, least: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Text, template and Dice coefficient of all parts that reach ``least``; of windows, the best of each template."""
    own = words(column, LETTER_OR_DIGIT)
    none = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
    at, value = own.windows(2)
    if not len(at) or not len(templates.known):
        return none
    maybe = np.zeros(1 << 20, dtype=bool)
    maybe[templates.known >> np.uint64(44)] = True
    near = np.flatnonzero(maybe[value >> np.uint64(44)])
    place = np.minimum(np.searchsorted(templates.known, value[near]), len(templates.known) - 1)
    good = templates.known[place] == value[near]
    near, place = near[good], place[good]
    if not len(near):
        return none
    found = [windows(own.text[at], near, place, templates, least)]
    newline = own.data == 10
    lines = np.cumsum(newline)
    paragraphs = np.cumsum(newline & np.append(False, newline[:-1]))
    for breaks in (lines, paragraphs, np.zeros_like(lines)):
        # Segments in order; a bigram counts if both words are in one.
        segment = own.text * (int(breaks[-1]) + 1) + breaks[own.start]
        _, segment = np.unique(segment, return_inverse=True)
        inside = segment[at] == segment[at + 1]
        size = np.bincount(segment[at[inside]], minlength=segment[-1] + 1)
        kept = inside[near]
        hit, gram = segment[at[near]][kept], place[kept]
        key, times = np.unique(hit * len(templates.known) + gram, return_counts=True)
        hit, gram = key // len(templates.known), key % len(templates.known)
        row, entry = entries(gram, templates)
        template = templates.template[entry]
        # Sizes within which the wanted coefficient can be reached.
        a, b = size[hit[row]], templates.size[template]
        possible = 2 * np.minimum(a, b) >= least * (a + b)
        row, entry, template = row[possible], entry[possible], template[possible]
        common = np.minimum(times[row], templates.times[entry])
        pair, back = np.unique(hit[row] * len(templates.names) + template, return_inverse=True)
        common = np.bincount(back, common, minlength=len(pair))
        hit, template = pair // len(templates.names), pair % len(templates.names)
        dice = 2 * common / (size[hit] + templates.size[template])
        good = dice >= least
        first = np.searchsorted(segment, hit[good])
        found.append((own.text[first], template[good], dice[good]))
    return tuple(np.concatenate(x) for x in zip(*found, strict=True))


def scan(docs: DataFrame, templates: Sequence[tuple[str, str]] = TEMPLATES, least: float = LEAST_DICE) -> DataFrame:
    """doc_id, licenses (array of license, dice: the best of each, by name) of every row of ``docs``.

    A text without licences, a null and an empty one have an empty array. Rows are judged one by one, whole texts of any
    length; other columns are ignored, and an empty table gives no rows. Variants of one licence (GPL-2.0 and GPL-3.0, BSD
    with two and three clauses) may both reach ``least``; the coefficients tell which it is.
    """
    source = docs.select("doc_id", "text")
    found = T.ArrayType(T.StructType([T.StructField("license", T.StringType()), T.StructField("dice", T.DoubleType())]))
    schema = T.StructType([source.schema["doc_id"], T.StructField("licenses", found)])
    shared = bigrams(templates)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        arrow = to_arrow_schema(schema)
        for batch in slices(batches):
            best: list[dict[str, float]] = [{} for _ in range(batch.num_rows)]
            for text, template, dice in zip(*(x.tolist() for x in compare(batch.column("text"), shared, least)), strict=True):
                name = shared.names[template]
                best[text][name] = max(dice, best[text].get(name, 0.0))
            rows = [[{"license": k, "dice": v} for k, v in sorted(b.items())] for b in best]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(rows, arrow.field("licenses").type)], schema=arrow)

    return source.mapInArrow(run, schema)
