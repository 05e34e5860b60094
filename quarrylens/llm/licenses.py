"""License scans: MinHash bands over overlapping text windows retrieve templates, exact shingle containment verifies them.

Shingles are five words. Templates fall into classes by their number of shingles: class k holds those of 2**(k-1)+1 to 2**k.
For each class a text is cut into windows of three blocks of 2**(k-1) shingles that begin at each block, so that any stretch of
2**k shingles lies whole in a window (class 0: every single shingle; class 1: three shingles at every place). Bands are single
MinHash components, so a window and a template of similarity J meet with probability 1 - (1 - J)**bands. A class has as many
bands as its least similar pair needs to meet with probability `meets`: that of a window which holds just `containment` of the
class's shortest template. A window's minima are those of its blocks, and blocks of a class are pairs of blocks of the class
before, so a text is hashed once. Every window of every text goes through the bands' index; for a template met there, the share
of its distinct shingles that the window holds is computed exactly and must be at least `containment`.

Templates of fewer than five words are one shingle of as many words: windows of one such shingle at every word, where a single
band meets for certain and containment is 1.

Cases: null and empty texts hold nothing; a notice of rights reserved is reported beside a license too; a template that occurs
several times is reported once, at its best and then first window; repeated rows are judged alike; texts may be of any length;
other columns are ignored.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import SHINGLE, Words, mix64, row_chunks, small_batches, utf8_parts

# Public license notices as their texts ask for them to be given, and short forms in common use.
TEMPLATES = {
    "MIT": [
        "Released under the MIT License.",
        "Licensed under the MIT License.",
        "This project is licensed under the MIT License",
        "MIT License",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:",
    ],
    "Apache-2.0": [
        "Licensed under the Apache License, Version 2.0.",
        "Apache License, Version 2.0",
        "Apache License 2.0",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.",
    ],
    "GPL-3.0": [
        "This work is licensed under the GNU General Public License, version 3.",
        "GPL-3.0",
        "GPLv3",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    ],
    "GPL-2.0": ["GPL-2.0", "GPLv2", "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version."],
    "BSD-3-Clause": [
        "BSD-3-Clause",
        "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.",
    ],
    "BSD": ["BSD License", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:"],
    "ISC": ["ISC License", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."],
    "MPL-2.0": ["MPL-2.0", "Mozilla Public License 2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."],
    "CC-BY-4.0": ["CC BY 4.0", "Licensed under CC BY 4.0.", "This work is licensed under a Creative Commons Attribution 4.0 International License."],
    "CC-BY-SA-4.0": ["CC BY-SA 4.0", "Licensed under CC BY-SA 4.0.", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."],
    "CC-BY-NC-4.0": ["CC BY-NC 4.0", "Licensed under CC BY-NC 4.0.", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."],
    "Unlicense": ["This is free and unencumbered software released into the public domain."],
    "Proprietary": ["All rights reserved.", "All rights reserved. No part of this publication may be reproduced, distributed, or transmitted in any form or by any means without the prior written permission of the publisher."],
}


# Full texts of short public licenses.
_AS_IS = 'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.'
_BSD_HEAD = "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution."
_BSD_NAMES = "3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission."
_BSD_AS_IS = 'THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.'
TEMPLATES["MIT"].append(f"{TEMPLATES['MIT'][4]} The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software. {_AS_IS}")
TEMPLATES["BSD-3-Clause"].append(f"{_BSD_HEAD} {_BSD_NAMES} {_BSD_AS_IS}")
TEMPLATES["BSD-2-Clause"] = ["BSD-2-Clause", f"{_BSD_HEAD} {_BSD_AS_IS}"]
TEMPLATES["ISC"].append(
    f'{TEMPLATES["ISC"][1]} THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.'
)
TEMPLATES["Zlib"] = [
    "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software. Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions: 1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software. If you use this software in a product, an acknowledgment in the product documentation would be appreciated but is not required. 2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software. 3. This notice may not be removed or altered from any source distribution."
]
TEMPLATES["BSL-1.0"] = [
    "Boost Software License - Version 1.0",
    'Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and accompanying documentation covered by this license (the "Software") to use, reproduce, display, distribute, execute, and transmit the Software, and to prepare derivative works of the Software, and to permit third-parties to whom the Software is furnished to do so, all subject to the following: The copyright notices in the Software and this entire statement, including the above license grant, this restriction and the following disclaimer, must be included in all copies of the Software, in whole or in part, and all derivative works of the Software, unless such copies or derivative works are solely in the form of machine-executable object code generated by a source language processor.',
]
TEMPLATES["Unlicense"].append(
    f'{TEMPLATES["Unlicense"][0]} Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means. In jurisdictions that recognize copyright laws, the author or authors of this software dedicate any and all copyright interest in the software to the public domain. We make this dedication for the benefit of the public at large and to the detriment of our heirs and successors. We intend this dedication to be an overt act of relinquishment in perpetuity of all present and future rights to this software under copyright law.'
)


@dataclass(frozen=True)
class LicenseParams:
    meets: float = 0.9999  # least probability that a window which holds a template meets it in a band
    containment: float = 0.8


def _class_of(shingles: int) -> int:
    return max(0, shingles - 1).bit_length()


def shape(k: int) -> tuple[int, int]:
    """Shingles of a class's windows and of the blocks at which they begin."""
    block = 1 << max(k - 1, 0)
    return (1 if k == 0 else 3 * block), block


def bands_of(k: int, p: LicenseParams) -> int:
    """Bands by which the least similar window and template of a class meet with probability `meets`."""
    size, _ = shape(k)
    least = 1.0
    for m in ({1} if k == 0 else {(1 << (k - 1)) + 1, 1 << k}):
        held = math.ceil(p.containment * m - 1e-9)
        least = min(least, held / (size + m - held))
    return 1 if least >= 1 else math.ceil(math.log(1 - p.meets) / math.log(1 - least))


class TemplateIndex:
    """The bands' index: for each class and band the templates' minima in order, beside the templates' shingles."""

    def __init__(self, templates: dict[str, list[str]], p: LicenseParams = LicenseParams()):
        self.p = p
        self.names, self.sets, sizes = [], [], []
        for name, texts in templates.items():
            for text in texts:
                words = Words(*_bytes([text]))
                if len(words.hash):
                    sizes.append(min(SHINGLE, len(words.hash)))
                    self.names.append(name)
                    self.sets.append(np.unique(words.shingles(sizes[-1])[1]))
        #: (words of a shingle, class) -> bands, each as sorted minima and the templates beside them
        self.index: dict[tuple[int, int], list[tuple[np.ndarray, np.ndarray]]] = {}
        members: dict[tuple[int, int], list[int]] = {}
        for t, (codes, words_) in enumerate(zip(self.sets, sizes, strict=True)):
            members.setdefault((words_, _class_of(len(codes)) if words_ == SHINGLE else 0), []).append(t)
        for key, ts in members.items():
            minima = np.array([_hashed(self.sets[t], bands_of(key[1], p)).min(axis=0) for t in ts])
            self.index[key] = [((column := minima[:, b])[order := np.argsort(column, kind="stable")], np.array(ts)[order]) for b in range(minima.shape[1])]
        # Low bits of the minima that occur, by which most windows are ruled out at once.
        self.seen = {}
        for key, bands in self.index.items():
            seen = np.zeros((len(bands), 1 << 16), bool)
            for b, (minima, _) in enumerate(bands):
                seen[b, minima & np.uint32(0xFFFF)] = True
            self.seen[key] = seen

    def _met(self, key: tuple[int, int], minima: np.ndarray) -> set[tuple[int, int]]:
        """Pairs of a window and a template that share a band. minima: a row for each window."""
        bands, seen, met = self.index[key], self.seen[key], set()
        for b, (stored, templates) in enumerate(bands):
            maybe = np.flatnonzero(seen[b, minima[:, b] & np.uint32(0xFFFF)])
            lo, hi = np.searchsorted(stored, minima[maybe, b], "left"), np.searchsorted(stored, minima[maybe, b], "right")
            for i in np.flatnonzero(hi > lo):
                met.update((int(maybe[i]), int(t)) for t in templates[lo[i] : hi[i]])
        return met

    def scan(self, data: np.ndarray, off: np.ndarray) -> list[dict[int, tuple[float, int]]]:
        """For each text the templates found: their containment and the number of the window's first word."""
        found: list[dict[int, tuple[float, int]]] = [{} for _ in range(len(off) - 1)]
        words = Words(data, off)
        for width in sorted({w for w, _ in self.index}):
            row, code, at = words.shingles(width)
            if width < SHINGLE:  # a text of fewer words has no shingle of this many
                whole = words.count[row] >= width
                row, code, at = row[whole], code[whole], at[whole]
            if not len(code):
                continue
            classes = sorted(k for w, k in self.index if w == width)
            first = np.searchsorted(row, np.arange(words.rows))
            n = np.searchsorted(row, np.arange(words.rows), "right") - first
            word = np.concatenate(([0], np.cumsum(words.count)))
            # Minima of blocks of 2**level shingles; a text's blocks are numbered from its start.
            blocks, begin, many = _hashed(code, max(bands_of(k, self.p) for k in classes)), first, n
            for level in range(max(max(classes), 1)):
                for k in (k for k in classes if max(k - 1, 0) == level):
                    size, stride = shape(k)
                    bands = len(self.index[width, k])
                    minima = blocks[:, :bands]
                    if k:
                        for step in (1, 2):
                            minima = np.minimum(minima, blocks[_shifted(begin, many, step), :bands])
                    owner = np.repeat(np.arange(words.rows), many)
                    for w, t in sorted(self._met((width, k), minima)):
                        r = int(owner[w])
                        lo = int(first[r] + (w - begin[r]) * stride)
                        held = np.unique(code[lo : min(lo + size, int(first[r] + n[r]))])
                        share = len(np.intersect1d(held, self.sets[t], assume_unique=True)) / len(self.sets[t])
                        if share >= self.p.containment and share > found[r].get(t, (0, 0))[0]:
                            found[r][t] = (share, int(at[lo] - word[r]))
                # Pairs of blocks; an odd last one stays alone.
                half = -(-many // 2)
                start = np.concatenate(([0], np.cumsum(half)))[:-1]
                even = np.repeat(begin, half) + 2 * (np.arange(half.sum()) - np.repeat(start, half))
                last = np.repeat(begin + many, half) - 1
                blocks, begin, many = np.minimum(blocks[even], blocks[np.minimum(even + 1, last)]), start, half
        return found


_FACTORS = mix64(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)


def _hashed(codes: np.ndarray, bands: int) -> np.ndarray:
    """A row of `bands` 32-bit hashes for each code."""
    return ((codes[:, None] * _FACTORS[None, :bands]) >> np.uint64(32)).astype(np.uint32)


def _shifted(begin: np.ndarray, many: np.ndarray, step: int) -> np.ndarray:
    """For each block the one `step` later in its text, at most the last."""
    place = np.arange(int(many.sum()))
    return np.minimum(place + step, np.repeat(begin + many, many) - 1)


_CHUNK = 500_000  # bytes: each shingle has a hash for each band


def _bytes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    return utf8_parts(pa.array(texts, pa.string()))


def scan_licenses(docs: DataFrame, templates: dict[str, list[str]] | None = None, params: LicenseParams = LicenseParams()) -> DataFrame:
    """(doc_id, n_licenses, licenses, containment, first_word), a row for each row of docs.

    licenses: the names in order, comma-joined; containment and first_word are those of the best template.
    """
    small_batches(docs.sparkSession)
    index = docs.sparkSession.sparkContext.broadcast(TemplateIndex(templates or TEMPLATES, params))  # the templates' shingles

    def run(batches):
        t = index.value
        for batch in batches:
            data, off = utf8_parts(batch.column(1))
            rows = [f for lo, hi in row_chunks(off, _CHUNK) for f in t.scan(data[off[lo] : off[hi]], off[lo : hi + 1] - off[lo])]
            names = [sorted({t.names[k] for k in f}) for f in rows]
            best = [max(((share, -at) for share, at in f.values()), default=(None, None)) for f in rows]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([len(n) for n in names], pa.int64()), pa.array([",".join(n) for n in names]), pa.array([b[0] for b in best], pa.float64()), pa.array([None if b[1] is None else -b[1] for b in best], pa.int64())], names=["doc_id", "n_licenses", "licenses", "containment", "first_word"])

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return texts.mapInArrow(run, "doc_id long, n_licenses long, licenses string, containment double, first_word long")
