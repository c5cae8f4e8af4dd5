"""License scans by conditional compression.

Candidate blocks are the words around license vocabulary. A block is
compressed alone and once with each license's wordings as a raw zstandard
dictionary; the bytes that a dictionary saves rank the licenses, and the
ranked ones are confirmed by their exact wording: a name that the block
spells out whole, or a notice of which it differs in few words.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from difflib import SequenceMatcher

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from histoframe.llm.batches import steps

# Names by which licenses are referred to.
NAMES = {
    "MIT": ("MIT License", "MIT Licence", "Expat License"),
    "Apache-2.0": ("Apache License Version 2.0", "Apache License 2.0", "Apache Software License 2.0", "Apache 2.0 License", "Apache-2.0"),
    "GPL-2.0": ("GNU General Public License version 2", "GNU General Public License v2", "GNU GPL version 2", "GPL-2.0", "GPLv2", "GNU GPL v2"),
    "GPL-3.0": ("GNU General Public License version 3", "GNU General Public License v3", "GNU GPL version 3", "GPL-3.0", "GPLv3", "GNU GPL v3"),
    "LGPL-2.1": ("GNU Lesser General Public License version 2.1", "GNU Lesser General Public License v2.1", "LGPL-2.1", "LGPLv2.1"),
    "LGPL-3.0": ("GNU Lesser General Public License version 3", "GNU Lesser General Public License v3", "LGPL-3.0", "LGPLv3"),
    "AGPL-3.0": ("GNU Affero General Public License version 3", "GNU Affero General Public License v3", "AGPL-3.0", "AGPLv3"),
    "BSD-2-Clause": ("BSD 2-Clause License", "2-Clause BSD License", "Simplified BSD License", "BSD-2-Clause"),
    "BSD-3-Clause": ("BSD 3-Clause License", "3-Clause BSD License", "New BSD License", "Modified BSD License", "BSD-3-Clause"),
    "MPL-2.0": ("Mozilla Public License Version 2.0", "Mozilla Public License 2.0", "Mozilla Public License v2.0", "MPL-2.0", "MPL 2.0"),
    "ISC": ("ISC License", "ISC Licence"),
    "EPL-2.0": ("Eclipse Public License 2.0", "Eclipse Public License v2.0", "Eclipse Public License version 2.0", "EPL-2.0"),
    "CC0-1.0": ("CC0 1.0", "CC0", "Creative Commons Zero", "Creative Commons CC0"),
    "CC-BY-4.0": ("CC BY 4.0", "Creative Commons Attribution 4.0"),
    "CC-BY-SA-4.0": ("CC BY-SA 4.0", "Creative Commons Attribution-ShareAlike 4.0"),
    "CC-BY-NC-4.0": ("CC BY-NC 4.0", "Creative Commons Attribution-NonCommercial 4.0"),
    "CC-BY-ND-4.0": ("CC BY-ND 4.0", "Creative Commons Attribution-NoDerivatives 4.0"),
    "CC-BY-NC-SA-4.0": ("CC BY-NC-SA 4.0", "Creative Commons Attribution-NonCommercial-ShareAlike 4.0"),
    "CC-BY-NC-ND-4.0": ("CC BY-NC-ND 4.0", "Creative Commons Attribution-NonCommercial-NoDerivatives 4.0"),
    "Unlicense": ("The Unlicense", "Unlicense"),
    "LicenseRef-all-rights-reserved": ("All rights reserved",),
}

# The frames that such names stand in.
FRAMES = (
    "Licensed under the {}", "Licensed under {}", "Released under the {}", "Distributed under the terms of the {}",
    "This work is licensed under the {}", "This work is licensed under a {} International License", "Available under the {}", "SPDX-License-Identifier: {}",
)

# Notices of licenses that are quoted rather than named.
NOTICES = {
    "MIT": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
    "ISC": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
    "BSD-2-Clause": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.",
    "GPL-2.0": "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version.",
    "GPL-3.0": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "AGPL-3.0": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "Unlicense": "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means.",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.",
}

_WORD = re.compile(r"[^\W_]+")
_HINT = re.compile(r"(?:un)?licen[cs](?:e|ed|es|ing)|copyright|copyleft|[al]?gplv?\d*|reserved|spdx|warranty|cc0|creativecommons|redistribut\w*|sublicense|unencumbered|commons|mpl|epl", re.I)
#: What a text must hold to be looked at; every hint holds one of these.
PREFILTER = r"(?i)licen[cs]|copyright|copyleft|gpl|reserved|spdx|warranty|cc0|commons|redistribut|unencumbered|\bmpl|\bepl"

#: Words before and after a hint that belong to its block.
BEFORE, AFTER = 16, 48
#: Bytes that a dictionary saves at least, and the share of a notice's words that a block has to have in order.
LEAST_SAVED, NOTICE_SHARE = 2, 0.9
#: Distinct blocks that a task remembers the licenses of.
_MEMO = 20_000


def _tokens(text: str) -> list[str]:
    return [w.lower() for w in _WORD.findall(text)]


@dataclass(frozen=True)
class Finding:
    """A license in a block: first and last token (exclusive), bytes saved, words that differ from the wording."""

    license: str
    first: int
    last: int
    saved: int
    missing: int
    extra: int


class LicenseMatcher:
    """Ranks licenses by the compression they give and confirms them by wording."""

    def __init__(self, names=None, notices=None) -> None:
        self._names = {k: sorted({tuple(_tokens(n)) for n in v}, key=len, reverse=True) for k, v in (NAMES if names is None else names).items()}
        self._notices = {k: _tokens(v) for k, v in (NOTICES if notices is None else notices).items()}
        self._plain = zstandard.ZstdCompressor(level=19, write_content_size=False)
        self._with = {}
        for name in self._names:
            wordings = [f.format(" ".join(n)).lower() for n in self._names[name] for f in FRAMES] + [" ".join(self._notices.get(name, []))]
            text = " ".join(" ".join(_tokens(w)) for w in wordings)
            kind = zstandard.ZstdCompressionDict(text.encode(), dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            self._with[name] = zstandard.ZstdCompressor(level=19, dict_data=kind, write_content_size=False, write_dict_id=False)
        self._known: dict[tuple[str, ...], list[Finding]] = {}

    def ranked(self, block: list[str]) -> list[tuple[int, str]]:
        """Bytes each license saves on the block, most first."""
        data = " ".join(block).encode()
        alone = len(self._plain.compress(data))
        saved = [(alone - len(c.compress(data)), name) for name, c in self._with.items()]
        return sorted(((s, n) for s, n in saved if s >= LEAST_SAVED), key=lambda x: (-x[0], x[1]))

    def _confirmed(self, name: str, block: list[str], saved: int) -> list[Finding]:
        found = []
        for words in self._names[name]:
            for i in range(len(block) - len(words) + 1):
                if tuple(block[i : i + len(words)]) == words:
                    found.append(Finding(name, i, i + len(words), saved, 0, 0))
        notice = self._notices.get(name)
        if notice:
            same = [m for m in SequenceMatcher(None, block, notice, autojunk=False).get_matching_blocks() if m.size]
            agree = sum(m.size for m in same)
            if agree >= NOTICE_SHARE * len(notice):
                first, last = same[0].a, same[-1].a + same[-1].size
                found.append(Finding(name, first, last, saved, len(notice) - agree, last - first - agree))
        return found

    def find(self, block: list[str]) -> list[Finding]:
        """Confirmed licenses of a block; of overlapping ones the longest wording, then the most saved."""
        key = tuple(block)
        if key not in self._known:
            if len(self._known) > _MEMO:
                self._known.clear()
            every = [f for saved, name in self.ranked(block) for f in self._confirmed(name, block, saved)]
            kept: list[Finding] = []
            for f in sorted(every, key=lambda f: (f.first - f.last, f.missing + f.extra, -f.saved, f.license)):
                if all(f.last <= k.first or f.first >= k.last for k in kept):
                    kept.append(f)
            self._known[key] = sorted(kept, key=lambda f: f.first)
        return self._known[key]


def blocks(text: str) -> list[list[re.Match]]:
    """Words around license vocabulary, as runs of word matches; overlapping runs are one."""
    words = list(_WORD.finditer(text))
    spans: list[list[int]] = []
    for i, w in enumerate(words):
        if _HINT.fullmatch(w[0]):
            first, last = max(0, i - BEFORE), min(len(words), i + AFTER)
            if spans and first <= spans[-1][1]:
                spans[-1][1] = last
            else:
                spans.append([first, last])
    return [words[a:b] for a, b in spans]


def scan_licenses(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, license, start, end, saved, n_missing, n_extra): a row per license wording found in a whole text.

    Positions count code points, ends are exclusive. Null and empty texts
    have none; repeated rows and null ids give their rows each; further
    columns are left out; an empty table gives an empty result.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = LicenseMatcher()
        for batch in steps(batches, "text"):
            out = []
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                for block in blocks(text):
                    for f in matcher.find([w[0].lower() for w in block]):
                        out.append((doc, f.license, block[f.first].start(), block[f.last - 1].end(), f.saved, f.missing, f.extra))
            columns = list(zip(*out, strict=True)) or [()] * 7
            kinds = (pa.int64(), pa.string(), *[pa.int64()] * 5)
            names = ["doc_id", "license", "start", "end", "saved", "n_missing", "n_extra"]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names=names)

    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return texts.filter(F.col("text").rlike(PREFILTER)).mapInArrow(run, "doc_id long, license string, start long, end long, saved long, n_missing long, n_extra long")
