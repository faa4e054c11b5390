"""License notices in documents, by conditional compression.

A candidate block is a line that holds a cue word, with ``CONTEXT`` lines before and after it; blocks that overlap are one.
So a wrapped notice and the body of a license are read whole, also where lines of theirs hold no cue. Windows of a block's
words are compressed with zstandard alone, and with each template's wording as a raw dictionary. Templates are ranked by how
much smaller that makes a window; one that saves nothing in any is out. The others are confirmed in that order by exact wording: the
words of a notice must stand in the block, in order and together, but for ``MAX_DIFFERENCES`` of them in a hundred, and
for one of ``SHORT`` words or more; the words that name the license admit no difference. A heading is a line of its own.
Every place of a block that a license's wording holds counts once; wordings of one license that overlap are one notice.

Null and empty texts have no blocks. Every row gives one row, repeated ones too; whole texts are scanned.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from claimlens.llm.common import table

CUES = ("licens", "licenc", "copyright", "permission", "redistribut", "warrant", "public domain", "spdx", "all rights reserved", "creative commons", "cc by", "cc-by", "cc0", "unencumbered", "source code is governed", "provided as is", "provided 'as-is'")
#: In a hundred words of a notice, how many may be missing, added or replaced.
MAX_DIFFERENCES = 10
#: Words of a notice in which one may differ.
SHORT = 5
#: Lines around a cue that are read with it.
CONTEXT = 8
LEVEL = 19
#: Words compressed at a time: in longer runs what surrounds a notice outweighs it.
WINDOW = 24
#: Stands before a block when it is compressed, alone and with a template: the repetition in it opens the part of a frame that
#: holds matches, which a block of two words would not be worth by itself. No wording has any of it.
LEAD = "zq xj zq xj zq xj zq xj zq xj "
WORD = re.compile(r"[^\W_]+(?:\.[0-9]+)*")

#: Public license wording. License: (the words that name it, its notices, its headings, parts of its text).
#: In a naming phrase ``#`` stands for a version number; parts of a text name no license and need none.
TEMPLATES: dict[str, tuple[tuple[str, ...], tuple[str, ...], tuple[str, ...], tuple[str, ...]]] = {
    "Apache": (("apache license", "apache #"), (
        "Licensed under the Apache License, Version 2.0",
        "Licensed under Apache License 2.0",
        "This work is made available under the Apache License, Version 2.0",
        "you may not use this file except in compliance with the License",
        "SPDX-License-Identifier: Apache-2.0",
    ), ("Apache License", "Apache License Version 2.0", "Apache License 2.0"), (
        "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "
        "\"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.",
    )),
    "MIT": (("mit license", "mit"), (
        "Released under the MIT License",
        "Licensed under the MIT License",
        "Licensed under the terms of the MIT License",
        "This work is available under the terms of the MIT License",
        "SPDX-License-Identifier: MIT",
    ), ("MIT License", "The MIT License", "The MIT License (MIT)"), (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation "
        "files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, "
        "modify, merge, publish, distribute, sublicense, and/or sell copies of the Software",
    )),
    "BSD": (("bsd",), (
        "Released under the BSD License",
        "Licensed under the BSD 3-Clause License",
        "Licensed under the BSD 2-Clause License",
        "Use of this source code is governed by a BSD-style license",
        "SPDX-License-Identifier: BSD-3-Clause",
        "SPDX-License-Identifier: BSD",
    ), ("BSD License", "BSD 3-Clause License", "BSD 2-Clause License", "The BSD License"), (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following "
        "conditions are met",
    )),
    "ISC": (("isc license", "isc"), (
        "Licensed under the ISC License",
        "Released under the ISC License",
        "SPDX-License-Identifier: ISC",
    ), ("ISC License", "The ISC License"), (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided "
        "that the above copyright notice and this permission notice appear in all copies",
    )),
    "Zlib": (("zlib license", "zlib"), ("Licensed under the zlib License", "SPDX-License-Identifier: Zlib"), ("zlib License", "The zlib License"), (
        "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any "
        "damages arising from the use of this software.",
    )),
    "Boost": (("boost software license", "bsl"), (
        "Distributed under the Boost Software License, Version 1.0",
        "SPDX-License-Identifier: BSL-1.0",
    ), ("Boost Software License", "Boost Software License Version 1.0"), ()),
    "GPL": (("gnu general public license", "gnu gpl", "identifier gpl"), (
        "This work is licensed under the GNU General Public License, version 3",
        "Released under the GNU General Public License",
        "Licensed under the GNU GPL version 3",
        "under the terms of the GNU General Public License as published by the Free Software Foundation",
        "SPDX-License-Identifier: GPL-3.0-or-later",
        "SPDX-License-Identifier: GPL-2.0-only",
        "SPDX-License-Identifier: GPL-2.0",
    ), ("GNU General Public License", "GNU General Public License Version 3"), ()),
    "LGPL": (("gnu lesser general public license", "lgpl"), (
        "This work is licensed under the GNU Lesser General Public License, version 3",
        "under the terms of the GNU Lesser General Public License as published by the Free Software Foundation",
        "SPDX-License-Identifier: LGPL-2.1-or-later",
        "SPDX-License-Identifier: LGPL-3.0-only",
    ), ("GNU Lesser General Public License", "GNU Lesser General Public License Version 3"), ()),
    "AGPL": (("gnu affero general public license", "agpl"), (
        "This work is licensed under the GNU Affero General Public License, version 3",
        "under the terms of the GNU Affero General Public License as published by the Free Software Foundation",
        "SPDX-License-Identifier: AGPL-3.0-or-later",
        "SPDX-License-Identifier: AGPL-3.0-only",
    ), ("GNU Affero General Public License", "GNU Affero General Public License Version 3"), ()),
    "MPL": (("mozilla public license", "mpl"), (
        "Licensed under the Mozilla Public License, version 2.0",
        "subject to the terms of the Mozilla Public License",
        "SPDX-License-Identifier: MPL-2.0",
    ), ("Mozilla Public License", "Mozilla Public License Version 2.0"), ()),
    "EPL": (("eclipse public license", "epl"), (
        "made available under the terms of the Eclipse Public License 2.0",
        "SPDX-License-Identifier: EPL-2.0",
    ), ("Eclipse Public License", "Eclipse Public License 2.0"), ()),
    "CC-BY": (("cc by #", "creative commons attribution #"), (
        "Licensed under CC BY 4.0",
        "This work is licensed under a Creative Commons Attribution 4.0 International License",
        "SPDX-License-Identifier: CC-BY-4.0",
    ), (), ()),
    "CC-BY-SA": (("cc by sa", "creative commons attribution sharealike"), (
        "Licensed under CC BY-SA 4.0",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License",
        "SPDX-License-Identifier: CC-BY-SA-4.0",
    ), (), ()),
    "CC-BY-NC": (("cc by nc #", "creative commons attribution noncommercial #"), (
        "Licensed under CC BY-NC 4.0",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License",
        "SPDX-License-Identifier: CC-BY-NC-4.0",
    ), (), ()),
    "CC-BY-ND": (("cc by nd", "creative commons attribution noderivatives"), (
        "Licensed under CC BY-ND 4.0",
        "This work is licensed under a Creative Commons Attribution-NoDerivatives 4.0 International License",
    ), (), ()),
    "CC-BY-NC-SA": (("cc by nc sa", "creative commons attribution noncommercial sharealike"), (
        "Licensed under CC BY-NC-SA 4.0",
        "This work is licensed under a Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International License",
    ), (), ()),
    "CC0": (("cc0",), ("Released under CC0 1.0", "Licensed under CC0 1.0 Universal", "SPDX-License-Identifier: CC0-1.0"), (), ()),
    "Unlicense": (("public domain", "unlicense"), (
        "released into the public domain", "dedicated to the public domain", "SPDX-License-Identifier: Unlicense",
    ), (), ("This is free and unencumbered software released into the public domain",)),
}


def words_of(text: str) -> list[str]:
    """Words in lower case; a version number is ``#``."""
    return ["#" if re.fullmatch(r"[0-9]+(\.[0-9]+)*", w) else w for w in WORD.findall(text.lower())]


@lru_cache(maxsize=1)
def wordings() -> dict[str, list[tuple[list[str], int, bool]]]:
    """Of each license the words of its wordings, how many of these may differ, and whether it has to be named."""
    out = {}
    for name, (_, notices, _, texts) in TEMPLATES.items():
        out[name] = []
        for wording, named in [*((x, True) for x in notices), *((x, False) for x in texts)]:
            words = words_of(wording)
            out[name].append((words, max(len(words) * MAX_DIFFERENCES // 100, int(len(words) >= SHORT)), named))
    return out


@lru_cache(maxsize=1)
def headings() -> dict[tuple[str, ...], str]:
    return {tuple(words_of(h)): name for name, (_, _, found, _) in TEMPLATES.items() for h in found}


def candidate_blocks(text: str) -> list[str]:
    """Lines with a cue and those around them."""
    lowered = text.lower()
    if not any(c in lowered for c in CUES):
        return []
    lines = text.split("\n")
    spans: list[list[int]] = []
    for k, line in enumerate(lines):
        low = line.lower()
        if any(c in low for c in CUES):
            if spans and k - CONTEXT <= spans[-1][1]:
                spans[-1][1] = k + CONTEXT + 1
            else:
                spans.append([max(0, k - CONTEXT), k + CONTEXT + 1])
    return ["\n".join(lines[a:b]) for a, b in spans]


@lru_cache(maxsize=1)
def compressors() -> dict[str | None, zstandard.ZstdCompressor]:
    def with_dictionary(wording: str) -> zstandard.ZstdCompressor:
        return zstandard.ZstdCompressor(level=LEVEL, dict_data=zstandard.ZstdCompressionDict(wording.encode(), dict_type=zstandard.DICT_TYPE_RAWCONTENT))

    whole = {name: " ".join(" ".join(words_of(x)) for part in parts[1:] for x in part) for name, parts in TEMPLATES.items()}
    return {None: zstandard.ZstdCompressor(level=LEVEL)} | {name: with_dictionary(wording) for name, wording in whole.items()}


def windows(block: str) -> list[bytes]:
    """Runs of ``WINDOW`` of the block's words, a third further each, that hold a cue: any notice stands in one, mostly whole."""
    words = words_of(block)
    runs = [" ".join(words[k : k + WINDOW]) for k in range(0, max(1, len(words) - WINDOW + WINDOW // 3), WINDOW // 3)]
    return [(LEAD + r).encode() for r in runs if any(c in r for c in CUES)]


def ranked(block: str) -> list[tuple[str, float]]:
    """Templates that make some window compress to less, by the greatest share of its size that they save, greatest first."""
    tools, saved = compressors(), dict.fromkeys(TEMPLATES, 0.0)
    for raw in windows(block):
        alone = len(tools[None].compress(raw))
        for name in TEMPLATES:
            saved[name] = max(saved[name], 1 - len(tools[name].compress(raw)) / alone)
    return sorted((x for x in saved.items() if x[1] > 0), key=lambda x: (-x[1], x[0]))


def differences(notice: list[str], block: list[str]) -> list[tuple[int, int, int]]:
    """For each end of a run of the block's words: fewest word edits between the notice and such a run, and its start and end."""
    row = [(0, j) for j in range(len(block) + 1)]
    for i, word in enumerate(notice, 1):
        above, row = row, [(i, 0)]
        for j, other in enumerate(block, 1):
            row.append(min((above[j - 1][0] + (word != other), above[j - 1][1]), (above[j][0] + 1, above[j][1]), (row[-1][0] + 1, row[-1][1])))
    return [(n, start, end) for end, (n, start) in enumerate(row)]


def confirmed(name: str, block: str) -> list[tuple[int, int, int]]:
    """The license's notices in the block, as (word differences, first word, end), best first and none on top of another."""
    naming, have = TEMPLATES[name][0], words_of(block)
    held, hits = {*have}, []
    for want, allowed, named in wordings()[name]:
        if len({*want} - held) > allowed:
            continue
        for n, start, end in differences(want, have):
            if n <= allowed and (not named or any(f" {x} " in f" {' '.join(have[start:end])} " for x in naming)):
                hits.append((n, start, end))
    at = 0
    for line in block.split("\n"):
        words = words_of(line)
        if headings().get(tuple(words)) == name:
            hits.append((0, at, at + len(words)))
        at += len(words)
    out: list[tuple[int, int, int]] = []
    for hit in sorted(hits, key=lambda h: (h[0], h[1] - h[2], h[1])):
        if all(hit[2] <= start or end <= hit[1] for _, start, end in out):
            out.append(hit)
    return out


def notices_in(text: str) -> list[dict]:
    """Confirmed notices: license, block, the template's rank and saved share there, and word differences."""
    out = []
    for block in candidate_blocks(text):
        for rank, (name, saved) in enumerate(ranked(block), 1):
            out += [{"license": name, "block": block, "rank": rank, "saved": saved, "differences": n} for n, *_ in confirmed(name, block)]
    return out


NOTICES = "array<struct<license: string, block: string, rank: int, saved: double, differences: int>>"
ARROW_NOTICES = pa.list_(pa.struct([("license", pa.string()), ("block", pa.string()), ("rank", pa.int32()), ("saved", pa.float64()), ("differences", pa.int32())]))


def scan(docs: DataFrame, text: str = "text", into: str = "notices") -> DataFrame:
    """docs with the confirmed license notices of each text."""

    @F.arrow_udf(NOTICES)
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            yield pa.array([notices_in(x.as_py() or "") for x in batch], ARROW_NOTICES)

    return docs.withColumn(into, run.asNondeterministic()(docs[text].cast("string")))


def op2_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: its licenses, comma-joined, the number of notices, and the most word differences of one."""
    found = scan(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select(
        "doc_id",
        F.array_join(F.array_sort(F.array_distinct("notices.license")), ",").alias("licenses"),
        F.size("notices").cast("long").alias("n_notices"),
        F.array_max("notices.differences").alias("most_differences"),
    )


OP2_SQL = """
SELECT doc_id, coalesce(list_aggregate(list_sort(list_distinct(l)), 'string_agg', ','), '') AS licenses, CAST(len(l) AS BIGINT) AS n_notices,
  CAST(CASE WHEN len(l) > 0 THEN 0 END AS INTEGER) AS most_differences
FROM (SELECT doc_id, list_filter(list_concat(
  list_transform(regexp_extract_all(t, 'licensed under the apache license, version [0-9]'), lambda x: 'Apache'),
  list_transform(regexp_extract_all(t, 'released under the mit license'), lambda x: 'MIT'),
  list_transform(regexp_extract_all(t, 'this work is licensed under the gnu general public license, version [0-9]'), lambda x: 'GPL'),
  list_transform(regexp_extract_all(t, 'licensed under cc by-nc [0-9]'), lambda x: 'CC-BY-NC')), lambda x: x IS NOT NULL) AS l
FROM (SELECT doc_id, lower(coalesce(text, '')) AS t FROM documents))
"""
