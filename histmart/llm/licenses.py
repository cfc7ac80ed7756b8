"""License scans by conditional compression.

Candidate blocks are the words around each word of the license vocabulary, as
many on both sides as the longest confirmed notice can have; blocks that meet
are one, whatever their lines.  A block is looked at in windows of twice that
many words, each answering for the notices that begin in its first half (the
last one for all).

A window is compressed alone and with every template as zstandard raw
dictionary, all on the same parameters.  Templates are ranked by the share of
bytes that they save.  In that order the exact wording is asked for: words of
template and window are aligned in every way with few enough missing and
added words, and the first template that is there takes the stretch with the
fewest of them (then the leftmost).  What stands before and behind that
stretch is compressed and ranked anew, until no template is there.  So of
templates that could take the same words the one that compresses them best
does, and none is lost: every template is tried on all that is left.

Runs of over 64 characters without a space are cut to 64 before compression;
no template has any.  Null and empty texts have no blocks; all words of a
text are read; a null or repeated id is a row like any other.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: License texts and notices (fixed values).
TEMPLATES = {
    "MIT": "Released under the MIT License.",
    "MIT-text": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0-header": "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-3.0-header": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "GPL-2.0": "This work is licensed under the GNU General Public License, version 2.",
    "BSD-3-Clause": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",
    "CC-BY-4.0": "Licensed under CC BY 4.0.",
    "CC-BY-SA-4.0": "Licensed under CC BY-SA 4.0.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "CC0-1.0": "Released under CC0 1.0 Universal, to the public domain.",
    "all-rights-reserved": "All rights reserved.",
    "LGPL-2.1-header": "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version.",
    "LGPL-3.0-header": "This library is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "AGPL-3.0-header": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "GPL-2.0-header": "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version.",
    "MPL-2.0-header": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.",
    "ISC": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
    "0BSD": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted.",
    "BSD-2-Clause-text": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.",
    "Unlicense": "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means.",
    "Zlib": "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software. Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely",
    "BSL-1.0": "Distributed under the Boost Software License, Version 1.0. (See accompanying file LICENSE_1_0.txt or copy at https://www.boost.org/LICENSE_1_0.txt)",
    "EPL-2.0-header": "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 which is available at https://www.eclipse.org/legal/epl-2.0/",
    "EUPL-1.2": "Licensed under the EUPL, Version 1.2 only.",
    "OFL-1.1": "This Font Software is licensed under the SIL Open Font License, Version 1.1.",
    "Artistic-2.0": "Licensed under the Artistic License 2.0.",
    "WTFPL": "This work is free. You can redistribute it and/or modify it under the terms of the Do What The Fuck You Want To Public License, Version 2",
    "CC-BY-ND-4.0": "Licensed under CC BY-ND 4.0.",
    "CC-BY-NC-SA-4.0": "Licensed under CC BY-NC-SA 4.0.",
    "CC-BY-NC-ND-4.0": "Licensed under CC BY-NC-ND 4.0.",
    "CC-BY-4.0-long": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "CC-BY-SA-4.0-long": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
}
#: A word is a candidate if one of these begins in it (fixed values).
VOCABULARY = r"licen[cs]e|licen[cs]ed|copyright|rights|permission|permitted|redistribut|warrant|public domain|creative commons|\bCC[ -]?(?:BY|0)|sublicen|free of charge|substantial portions"
#: every word of the vocabulary holds one of these: a quick look that spares
#: most texts the pattern
_HINTS = ("licen", "copyright", "rights", "permi", "redistribut", "warrant", "public domain", "creative commons", "cc by", "cc-by", "cc0", "cc 0", "cc-0",
          "free of charge", "substantial portions")
_VOCABULARY = re.compile(VOCABULARY, re.IGNORECASE)
_WORD = re.compile(r"\w+(?:[.\-]+\w+)*", re.UNICODE)
#: Share of a template's words that must be there.
COVER = 0.9
_RUN = re.compile(r"(\S{64})\S+")
#: more words than any stretch adds
_NONE = 1 << 20

SCHEMA = ("doc_id long, n_blocks long, licenses array<struct<license: string, start: long, end: long, reduction: double, "
          "cover: double, n_missing: long, n_added: long, exact: boolean>>")
_TYPE = pa.list_(pa.struct([("license", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("reduction", pa.float64()), ("cover", pa.float64()),
                            ("n_missing", pa.int64()), ("n_added", pa.int64()), ("exact", pa.bool_())]))


def blocks(text: str, around: int) -> list[list[tuple[int, int]]]:
    """The words (as code points) of every block: ``around`` words on both
    sides of each word of the vocabulary, those that meet joined."""
    low = text.lower()
    if not any(h in low for h in _HINTS):
        return []
    at = [m.start() for m in _VOCABULARY.finditer(text)]
    if not at:
        return []
    spans = [m.span() for m in _WORD.finditer(text)]
    starts, runs = [a for a, _ in spans], []
    for x in at:
        i = bisect_right(starts, x) - 1
        lo, hi = max(0, i - around), min(len(spans), i + around + 1)
        if runs and lo <= runs[-1][1]:
            runs[-1][1] = hi
        else:
            runs.append([lo, hi])
    return [spans[lo:hi] for lo, hi in runs]


class Scanner:
    """Compressors and words of the templates; one for each task."""

    def __init__(self, templates: dict[str, str]):
        self.words = {k: [w.lower() for w in _WORD.findall(t)] for k, t in templates.items()}
        self.words = {k: w for k, w in self.words.items() if w}
        self.counts = {k: Counter(w) for k, w in self.words.items()}
        self.numbers = {k: {w for w in c if any(map(str.isdigit, w))} for k, c in self.counts.items()}  # versions must be there
        #: how many words may be missing
        self.most = {k: max(q for q in range(len(w)) if (len(w) - q) / len(w) >= COVER) for k, w in self.words.items()}
        #: a notice has at most as many added words as its template has words
        self.around = 2 * max(map(len, self.words.values()), default=0)
        self.known = {w for c in self.counts.values() for w in c}
        # the same parameters for all
        params = zstandard.ZstdCompressionParameters.from_level(3, source_size=1 << 14, dict_size=max((len(t.encode()) for t in templates.values()), default=0))
        self.plain = zstandard.ZstdCompressor(compression_params=params)
        self.packs = {k: zstandard.ZstdCompressor(compression_params=params, dict_data=zstandard.ZstdCompressionDict(
            templates[k].encode(), dict_type=zstandard.DICT_TYPE_RAWCONTENT)) for k in self.words}

    def reductions(self, window: str) -> dict[str, float]:
        """For every template the share of the compressed bytes that it saves."""
        raw = _RUN.sub(r"\1", window).encode("utf-8", "surrogatepass")
        alone = len(self.plain.compress(raw))
        return {k: 1 - len(pack.compress(raw)) / alone for k, pack in self.packs.items()}

    def _can_hold(self, counts: Counter, template: str) -> bool:
        """Whether so many of the template's words, and all its numbers, are there in any order."""
        if not all(counts[w] for w in self.numbers[template]):
            return False
        return sum(min(n, counts[w]) for w, n in self.counts[template].items()) >= len(self.words[template]) - self.most[template]

    def _regions(self, have: list[str], counts: Counter, template: str) -> Iterator[tuple[int, int]]:
        """Where notices can be: around the rarest of the template's words,
        one more than may be missing, so every notice holds one of them."""
        reach = 2 * len(self.words[template])
        rare = lambda words, n: set(sorted(words, key=lambda w: (counts[w], w))[:n])
        anchors = rare(self.numbers[template], 1) or rare(self.counts[template], self.most[template] + 1)
        out: list[list[int]] = []
        for j, w in enumerate(have):
            if w in anchors:
                if out and j - reach < out[-1][1]:
                    out[-1][1] = j + reach
                else:
                    out.append([max(0, j - reach), j + reach])
        for lo, hi in out:
            if self._can_hold(Counter(have[lo:hi]), template):
                yield lo, min(hi, len(have))

    def wordings(self, have: list[str], template: str) -> list[tuple[int, int, int, int]]:
        """(words missing, words added, first word, word after the last) of
        all stretches that hold the template's words in order with COVER of
        them, its numbers, and at most as many added words as it has words.

        For every number of missing words and every prefix of the template,
        the fewest added words of a stretch that ends at the current word.
        """
        want, most = self.words[template], self.most[template]
        n, must = len(want), np.array([_NONE if w in self.numbers[template] else 0 for w in want], np.int32)
        same = {w: np.array([0 if w == x else _NONE for x in want], np.int32) for w in set(want)}
        fresh = np.full((most + 1, n + 1), _NONE, np.int32)  # nothing found yet
        for q in range(most + 1):
            if not must[:q].any():
                fresh[q, q] = 0
        added, out = fresh, []
        for j, w in enumerate(have):
            now = np.minimum(added + 1, fresh)
            if w in same:
                np.minimum(now[:, 1:], added[:, :-1] + same[w], out=now[:, 1:])
                for q in range(1, most + 1):
                    np.minimum(now[q, 1:], now[q - 1, :-1] + must, out=now[q, 1:])
                out += [(q, x, j + 1 - (n - q) - x, j + 1) for q, x in enumerate(now[:, n].tolist()) if x <= n]
            added = np.minimum(now, _NONE)
        return out

    def take(self, text: str, spans: list[tuple[int, int]], have: list[str], lo: int, hi: int, limit: int) -> list[dict]:
        """Notices that begin before ``limit``, in order, among the words
        [lo, hi) of a block, by the ranking of the templates."""
        if lo >= min(hi, limit):
            return []
        saved = self.reductions(text[spans[lo][0]:spans[hi - 1][1]])
        counts = Counter(w for w in have[lo:hi] if w in self.known)
        for k in sorted(saved, key=lambda x: (-saved[x], x)):
            if not self._can_hold(counts, k):
                continue
            found = [(q, x, lo + a + i, lo + a + j) for a, e in self._regions(have[lo:hi], counts, k) for q, x, i, j in self.wordings(have[lo + a:lo + e], k)]
            found = [f for f in found if f[2] < limit]
            if not found:
                continue
            missing, added, i, j = min(found, key=lambda f: (f[0] + f[1], f[2], f[3]))
            n = len(self.words[k])
            one = {"license": k, "start": spans[i][0], "end": spans[j - 1][1], "reduction": saved[k], "cover": (n - missing) / n,
                   "n_missing": missing, "n_added": added, "exact": missing == 0 and added == 0}
            return [*self.take(text, spans, have, lo, i, limit), one, *self.take(text, spans, have, j, hi, limit)]
        return []

    def scan(self, text: str) -> tuple[int, list[dict]]:
        found, where = [], blocks(text, self.around)
        for spans in where:
            have = [text[x:y].lower() for x, y in spans]
            size, at, free = len(have), 0, 0
            while at < size:
                last = at + 2 * self.around >= size
                end = size if last else at + 2 * self.around
                got = self.take(text, spans, have, max(at, free), end, end if last else at + self.around)
                found += got
                if got:  # words that a notice has taken aren't looked at again
                    free = bisect_right([a for a, _ in spans], got[-1]["end"] - 1)
                at = size if last else at + self.around
        return len(where), found


def _scanner(templates: dict[str, str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        s = Scanner(templates)
        for b in batches:
            got = [s.scan(t.as_py() or "") for t in b.column(1)]
            yield pa.RecordBatch.from_arrays([b.column(0).cast(pa.int64()), pa.array([g[0] for g in got], pa.int64()), pa.array([g[1] for g in got], _TYPE)],
                                             names=["doc_id", "n_blocks", "licenses"])
    return run


def scan_licenses(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text", templates: dict[str, str] | None = None) -> DataFrame:
    """One row per document: id, n_blocks, licenses (confirmed ones, in order)."""
    docs = documents.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return docs.mapInArrow(_scanner(templates or TEMPLATES), SCHEMA).withColumnRenamed("doc_id", id_col)
