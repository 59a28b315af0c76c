"""Operator 4: license texts by conditional compression.

A block of lines with a license word is compressed with each template as a raw
zstandard dictionary. Templates are ranked by the bytes this saves against no
dictionary. In this order each is confirmed by wording, wherever it stands in the
block: almost all words of the template in their order, close together, and none
of its names or numbers missing; the missing words and those put in their place
are counted. A word put in that names another license or narrows this one
("Lesser", "NC"), a denial before it and an exception behind it refuse the match.
Words of a confirmed notice are not used again, so where two templates fit the
same words, the one that saves more wins. Its saved bytes are those of its own
words, as a short notice saves nothing in a long line; a template that saves
nothing there either is dropped.

Null and empty texts have no block. Blocks are whole lines, in order; a block
goes on around each license word for NEAR lines and for as many words as the
longest match can have, so that no line wrap cuts a notice. A finding has the
lines of its own words. Rows are independent: repeated rows and
null or repeated ids give their own findings. Extra columns are left alone. An
empty table gives no rows. Ties in saved bytes go to the template listed first.
"""

from __future__ import annotations

import functools
import re
from bisect import bisect_left, bisect_right
from collections import Counter
from collections.abc import Iterator
from itertools import accumulate
from difflib import SequenceMatcher

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cardlake.llm.common import documents, importable, text_of

# Notices as their licenses word them.
TEMPLATES = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0'),
    ("MIT", "Released under the MIT License."),
    ("MIT", 'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software'),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("0BSD", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted."),
    ("BSD", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("BSD-2-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission."),
    ("Zlib", "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software. Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions"),
    ("Unlicense", "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("AGPL-3.0", "This work is licensed under the GNU Affero General Public License, version 3."),
    ("LGPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("LGPL-2.1", "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version."),
    ("AGPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("GPL-2.0", "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-ND-4.0", "Licensed under CC BY-ND 4.0."),
    ("CC-BY-NC-SA-4.0", "Licensed under CC BY-NC-SA 4.0."),
    ("CC-BY-NC-ND-4.0", "Licensed under CC BY-NC-ND 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("CC-BY-ND-4.0", "This work is licensed under a Creative Commons Attribution-NoDerivatives 4.0 International License."),
    ("CC-BY-NC-SA-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International License."),
    ("CC-BY-NC-ND-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial-NoDerivatives 4.0 International License."),
)
#: Words that, put into a notice, make it another license or narrow it.
OTHER = frozenset("lesser library affero nc nd sa noncommercial noderivatives noderivs sharealike gnu mozilla apache mit bsd isc not no never except exception only".split())
#: Up to three words before a notice, in its sentence, that deny it; the word behind it that takes part of it back.
DENIAL = frozenset("not never no nor neither cannot without t".split())
TAKEN_BACK = frozenset("provided except unless".split())
HINT = r"(?i)licen[cs]|copyright|hereby granted|redistribut|permission|free software|creative commons|public domain"
#: Lines before and after one with a license word that belong to its block at least.
NEAR = 3
#: Template words that may be missing, and how much longer than the template its match may be.
MISSING, SPREAD = 0.1, 1.3
_WORD = re.compile(r"[A-Za-z0-9]+(?:\.[A-Za-z0-9]+)*")
_SENTENCE = re.compile(r"[.!?;:](?:\s|\Z)")
_FOUND = "doc_id long, first_line int, last_line int, license string, saved_bytes int, n_missing int, n_added int"
_ARROW = pa.schema([("doc_id", pa.int64()), ("first_line", pa.int32()), ("last_line", pa.int32()), ("license", pa.string()),
                    ("saved_bytes", pa.int32()), ("n_missing", pa.int32()), ("n_added", pa.int32())])


@functools.cache
def compressors() -> list[zstandard.ZstdCompressor]:
    """One without a dictionary, then one for each template."""
    raw = [zstandard.ZstdCompressionDict(t.encode(), dict_type=zstandard.DICT_TYPE_RAWCONTENT) for _, t in TEMPLATES]
    return [zstandard.ZstdCompressor(level=19), *[zstandard.ZstdCompressor(level=19, dict_data=d) for d in raw]]


def reach() -> int:
    """Words of the longest match of any template."""
    return max(_wanted(t)[1] for _, t in TEMPLATES)


def blocks(text: str) -> Iterator[tuple[int, int, str]]:
    """First line, last line (exclusive) and text of each block."""
    lines = text.split("\n")
    marked = [i for i, x in enumerate(lines) if re.search(HINT, x)]
    if not marked:
        return
    before = [0, *accumulate(len(_WORD.findall(x)) for x in lines)]
    around = []
    for i in marked:
        start = max(min(bisect_right(before, before[i] - reach()) - 1, i - NEAR), 0)
        end = min(max(bisect_left(before, before[i + 1] + reach()), i + 1 + NEAR), len(lines))
        if around and start <= around[-1][1]:
            around[-1][1] = end
        else:
            around.append([start, end])
    for start, end in around:
        yield start, end, "\n".join(lines[start:end])


def saved(text: str, only: int | None = None) -> list[int]:
    """Bytes that each template saves, or one of them."""
    data = text.encode()
    plain, *with_dict = compressors()
    sizes = [len(c.compress(data)) for c in (with_dict if only is None else [with_dict[only]])]
    return [len(plain.compress(data)) - n for n in sizes]


def ranked(block: str) -> list[tuple[int, int]]:
    """Saved bytes and template, the best first."""
    return sorted(((n, i) for i, n in enumerate(saved(block))), key=lambda x: (-x[0], x[1]))


@functools.cache
def _wanted(template: str) -> tuple[list[str], int, Counter, Counter]:
    """Words, the most words of a match, and how often it has each word and each name or number."""
    words = _WORD.findall(template)
    names = Counter(w.lower() for w in words if w[0].isdigit() or w[0].isupper())
    return words, int(SPREAD * len(words) + 1), Counter(w.lower() for w in words), names


def _starts(template: str, have: list[str]) -> Iterator[int]:
    """Places from which as many words as a match can have hold enough of the template's, in any order."""
    want, most, count, names = _wanted(template)
    places = [i for i, w in enumerate(have) if w in count]
    seen, held, named, right = Counter(), 0, 0, 0
    for i in places:
        while right < len(places) and places[right] < i + most:
            w = have[places[right]]
            seen[w] += 1
            held += seen[w] <= count[w]
            named += seen[w] <= names[w]
            right += 1
        if len(want) - held <= MISSING * len(want) and named == names.total():
            yield i
        w = have[i]
        held -= seen[w] <= count[w]
        named -= seen[w] <= names[w]
        seen[w] -= 1


def _match(template: str, have: list[str], at: int) -> tuple[int, int, int, int] | None:
    want, most, _, _ = _wanted(template)
    match = SequenceMatcher(None, [w.lower() for w in want], have[at : at + most], autojunk=False)
    same = [m for m in match.get_matching_blocks() if m.size]
    held = {m.a + k for m in same for k in range(m.size)}
    missing = [w for i, w in enumerate(want) if i not in held]
    if not same or len(missing) > MISSING * len(want) or any(w[0].isdigit() or w[0].isupper() for w in missing):
        return None
    first, last = same[0].b, same[-1].b + same[-1].size
    kept = {m.b + k for m in same for k in range(m.size)}
    if any(have[at + i] in OTHER for i in range(first, last) if i not in kept):
        return None
    return len(missing), last - first - len(held), at + first, at + last


def matches(template: str, have: list[str]) -> list[tuple[int, int, int, int]]:
    """Words missing, words put in between, first and last word (exclusive) of each place with this wording.

    Of places that overlap, the one with the fewest missing and put in stays.
    """
    out = []
    for at in _starts(template, have):
        if out and at < out[-1][3]:
            if out[-1][:2] != (0, 0) and (m := _match(template, have, at)) and m[:2] < out[-1][:2]:
                out[-1] = m
        elif m := _match(template, have, at):
            out.append(m)
    return out


def difference(template: str, block: str) -> tuple[int, int] | None:
    """Words missing and words put in between, or None if it is another wording."""
    found = matches(template, [w.lower() for w in _WORD.findall(block)])
    return min(found)[:2] if found else None


def _denied(block: str, words: list[re.Match], first: int, last: int) -> bool:
    """Whether the words around a match, in its sentence, deny it or take part of it back."""
    for i in range(first - 1, max(first - 4, -1), -1):
        if _SENTENCE.search(block, words[i].end(), words[i + 1].start() + 1):
            break
        if words[i][0].lower() in DENIAL:
            return True
    if last == len(words) or words[last][0].lower() not in TAKEN_BACK:
        return False
    return not _SENTENCE.search(block, words[last - 1].end(), words[last].start() + 1)


def notices(block: str) -> Iterator[tuple[int, int, str, int, int, int]]:
    """First line, last line (exclusive), license, saved bytes, words missing and put in of each notice confirmed."""
    words = list(_WORD.finditer(block))
    have = [w[0].lower() for w in words]
    for _, i in ranked(block):
        license_name, template = TEMPLATES[i]
        again = True
        while again:
            again = False
            for missing, added, first, last in matches(template, have):
                start, end = words[first].start(), words[last - 1].end()
                n_saved = saved(block[start:end], i)[0]
                if n_saved <= 0:
                    continue
                again = True
                # Words of a denied notice are no other notice either.
                have[first:last] = [""] * (last - first)
                if not _denied(block, words, first, last):
                    yield block.count("\n", 0, start), block.count("\n", 0, end) + 1, license_name, n_saved, missing, added


def scan(df: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Confirmed notices: doc_id, first_line, last_line (exclusive), license, saved_bytes, n_missing, n_added."""
    importable(df.sparkSession)

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for name, value in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                for start, _, block in blocks(value):
                    for first, last, license_name, n_saved, missing, added in notices(block):
                        out.append({"doc_id": name, "first_line": start + first, "last_line": start + last, "license": license_name,
                                    "saved_bytes": n_saved, "n_missing": missing, "n_added": added})
            yield pa.RecordBatch.from_pylist(out, schema=_ARROW)

    texts = df.select(F.col(doc_id).cast("long").alias("doc_id"), text_of(text).alias("text"))
    return texts.where(F.col("text").rlike(HINT)).mapInArrow(find, _FOUND)


def op4_license_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(documents(spark, sf_dir))
