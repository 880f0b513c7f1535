"""Licenses of files: similarity to templates, then inheritance along directories.

A header is any line of a text, any paragraph (lines without a blank line between
them) or the whole text, of any length.  It is compared with license templates by the cosine of sparse TF-IDF vectors
of words; the weights of words come from the templates, and words that no template
has weigh as much as the rarest of them.  Templates that are nearly as similar are told
apart by the version that the header states and by words like "lesser".  A text takes the license of its most
similar header.  A file whose name is that of a license file, or that has nothing but
the license text (with ``opening``, also one that opens with it), is a license file of its
directory.  A file without a license of its
own inherits the one of its nearest ancestor directory that has a license file.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Mapping
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DoubleType, StringType, StructField, StructType

from titleprep.llm.common import add_columns, texts
from titleprep.scale import lookup, reread, store

# Notices, standard headers, titles and short whole texts of licenses.
TEMPLATES: Mapping[str, tuple[str, ...]] = {
    "Apache-2.0": (
        "Licensed under the Apache License, Version 2.0.",
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file '
        "except in compliance with the License.",
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file '
        "except in compliance with the License. You may obtain a copy of the License at "
        "http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in "
        'writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT '
        "WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the "
        "specific language governing permissions and limitations under the License.",
        "Apache License Version 2.0, January 2004 http://www.apache.org/licenses/",
    ),
    "MIT": (
        "Released under the MIT License.",
        "The MIT License (MIT)",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software "
        "and associated documentation files, to deal in the Software without restriction.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software "
        'and associated documentation files (the "Software"), to deal in the Software without '
        "restriction, including without limitation the rights to use, copy, modify, merge, publish, "
        "distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the "
        "Software is furnished to do so, subject to the following conditions:",
        "MIT License Permission is hereby granted, free of charge, to any person obtaining a copy of "
        'this software and associated documentation files (the "Software"), to deal in the Software '
        "without restriction, including without limitation the rights to use, copy, modify, merge, "
        "publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to "
        "whom the Software is furnished to do so, subject to the following conditions: The above "
        "copyright notice and this permission notice shall be included in all copies or substantial "
        'portions of the Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, '
        "EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS "
        "FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT "
        "HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, "
        "TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER "
        "DEALINGS IN THE SOFTWARE.",
    ),
    "GPL-3.0": (
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of "
        "the GNU General Public License as published by the Free Software Foundation, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of "
        "the GNU General Public License as published by the Free Software Foundation, either version 3 "
        "of the License, or (at your option) any later version.",
        "GNU GENERAL PUBLIC LICENSE Version 3, 29 June 2007",
    ),
    "GPL-2.0": (
        "This work is licensed under the GNU General Public License, version 2.",
        "This program is free software; you can redistribute it and/or modify it under the terms of "
        "the GNU General Public License as published by the Free Software Foundation; either version 2 "
        "of the License, or (at your option) any later version.",
        "GNU GENERAL PUBLIC LICENSE Version 2, June 1991",
    ),
    "LGPL-3.0": (
        "This work is licensed under the GNU Lesser General Public License, version 3.",
        "This library is free software: you can redistribute it and/or modify it under the terms of "
        "the GNU Lesser General Public License as published by the Free Software Foundation, either "
        "version 3 of the License, or (at your option) any later version.",
        "GNU LESSER GENERAL PUBLIC LICENSE Version 3, 29 June 2007",
    ),
    "LGPL-2.1": (
        "This work is licensed under the GNU Lesser General Public License, version 2.1.",
        "This library is free software; you can redistribute it and/or modify it under the terms of "
        "the GNU Lesser General Public License as published by the Free Software Foundation; either "
        "version 2.1 of the License, or (at your option) any later version.",
        "GNU LESSER GENERAL PUBLIC LICENSE Version 2.1, February 1999",
    ),
    "BSD-3-Clause": (
        "Released under the BSD 3-Clause License.",
        "Redistribution and use in source and binary forms, with or without modification, are "
        "permitted provided that the following conditions are met.",
        "Neither the name of the copyright holder nor the names of its contributors may be used to "
        "endorse or promote products derived from this software without specific prior written permission.",
        "Redistribution and use in source and binary forms, with or without modification, are "
        "permitted provided that the following conditions are met: 1. Redistributions of source code "
        "must retain the above copyright notice, this list of conditions and the following disclaimer. "
        "2. Redistributions in binary form must reproduce the above copyright notice, this list of "
        "conditions and the following disclaimer in the documentation and/or other materials provided "
        "with the distribution. 3. Neither the name of the copyright holder nor the names of its "
        "contributors may be used to endorse or promote products derived from this software without "
        "specific prior written permission.",
    ),
    "BSD-2-Clause": (
        "Released under the BSD 2-Clause License.",
        "Redistribution and use in source and binary forms, with or without modification, are "
        "permitted provided that the following conditions are met: 1. Redistributions of source code "
        "must retain the above copyright notice, this list of conditions and the following disclaimer. "
        "2. Redistributions in binary form must reproduce the above copyright notice, this list of "
        "conditions and the following disclaimer in the documentation and/or other materials provided "
        "with the distribution.",
    ),
    "MPL-2.0": (
        "This file is subject to the terms of the Mozilla Public License, version 2.0.",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy "
        "of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.",
        "Mozilla Public License Version 2.0",
    ),
    "CC-BY-4.0": ("Licensed under CC BY 4.0.",),
    "CC-BY-SA-4.0": ("Licensed under CC BY-SA 4.0.",),
    "CC-BY-NC-4.0": ("Licensed under CC BY-NC 4.0.",),
}
# words that tell licenses with nearly the same text apart
DECIDING = (b"lesser", b"affero", b"nc", b"nd", b"sa")
_CLOSE = 0.1  # templates this near to the most similar one are told apart by those words
LICENSE_FILE = r"(?i)^(un)?licen[cs]e([._-].*)?$|^copying([._-].*)?$"
_WORDS = re.compile(rb"[a-z0-9]+(?:\.[0-9]+)*")
_NUMBER = re.compile(rb"[0-9]+(?:\.[0-9]+)*")
_BLANK = re.compile(rb"\n[\x20\x09\x0b-\x0d]*\n")


def _words(data: bytes) -> list[bytes]:
    return _WORDS.findall(data)


def _versions(words: list[bytes]) -> set[bytes]:
    """The numbers that follow the word version."""
    return {b for a, b in zip(words, words[1:]) if a in (b"version", b"v") and _NUMBER.fullmatch(b)}


@dataclass(frozen=True)
class _Vectors:
    """The templates as unit vectors, by word."""

    names: list[str]
    versions: list[set[bytes]]
    deciding: list[set[bytes]]
    least: float
    weight: dict[bytes, float]
    unseen: float
    by_word: dict[bytes, list[tuple[int, float]]]

    @classmethod
    def of(cls, templates: Mapping[str, tuple[str, ...]], least: float) -> _Vectors:
        rows = [(name, _words(t.lower().encode())) for name, own in sorted(templates.items()) for t in own]
        found = Counter(word for _, words in rows for word in set(words))
        weight = {word: math.log(1 + len(rows) / n) for word, n in found.items()}
        by_word: dict[bytes, list[tuple[int, float]]] = {}
        for number, (_, words) in enumerate(rows):
            counts = Counter(words)
            norm = math.sqrt(sum((n * weight[w]) ** 2 for w, n in counts.items()))
            for word, n in counts.items():
                by_word.setdefault(word, []).append((number, n * weight[word] / norm))
        return cls(
            [name for name, _ in rows],
            [_versions(words) for _, words in rows],
            [{w for w in words if w in DECIDING} for _, words in rows],
            least,
            weight,
            math.log(1 + len(rows)),
            by_word,
        )

    def best(self, counts: Counter[bytes], stated: set[bytes]) -> tuple[float, str | None]:
        """The cosine and license of the template that fits best.

        A template of another version than all of the ``stated`` ones does not fit.
        Among close ones deciding words that only one side has count first, then the
        cosine, then the name.
        """
        if not any(word in self.by_word for word in counts):
            return 0.0, None
        norm = math.sqrt(sum((n * self.weight.get(w, self.unseen)) ** 2 for w, n in counts.items()))
        scores = [0.0] * len(self.names)
        for word in counts.keys() & self.by_word.keys():
            part = counts[word] * self.weight[word] / norm
            for number, value in self.by_word[word]:
                scores[number] += part * value
        fitting = [
            (round(s, 9), i)
            for i, (s, own) in enumerate(zip(scores, self.versions))
            if not (stated and own) or own & stated
        ]
        if not fitting:
            return 0.0, None
        top = max(s for s, _ in fitting)
        if top < self.least:
            return top, None
        close = [(s, i) for s, i in fitting if s >= max(top - _CLOSE, self.least)]
        told = {word for word in DECIDING if word in counts}
        _, score, number = max((-len(told ^ self.deciding[i]), s, -i) for s, i in close)
        return score, self.names[-number]


def _own_license(data: bytes, vectors: _Vectors) -> tuple[str | None, float, bool, bool]:
    """License and similarity of the best header; whether it opens the text and is all of it.

    Every line, every paragraph and the text as a whole are compared, however long.
    """
    best, opens, size, total = (0.0, None), False, 0, 0
    text, named = Counter(), set()

    def look(counts: Counter[bytes], stated: set[bytes], first: bool) -> None:
        nonlocal best, opens, size
        found = vectors.best(counts, stated)
        if found[0] > best[0]:
            best, opens, size = found, first, counts.total()

    paragraphs = _BLANK.split(data.lower())
    for paragraph in paragraphs:
        lines = [words for line in paragraph.split(b"\n") if (words := _words(line))]
        for number, words in enumerate(lines):
            look(Counter(words), _versions(words), total == 0 and number == 0)
        words = [w for line in lines for w in line]
        counts, stated = Counter(words), _versions(words)
        if len(lines) > 1:
            look(counts, stated, total == 0)
        if len(paragraphs) > 1:
            text.update(counts)
            named |= stated
        total += len(words)
    if text:
        look(text, named, True)
    if best[1] is None:
        return None, best[0], False, False
    return best[1], best[0], opens, size == total


@dataclass(frozen=True)
class LicenseScan:
    """Adds ``license``, ``similarity``, ``license_from`` to files with a ``path``.

    The other columns stay, but for the text, which is left out.
    ``license_from`` is "own", "inherited" or null; an inherited license has the
    similarity of the license file.  Where a directory has several license files the
    most similar counts, then the first by path.  Null text has no license; a null path
    has no directory and inherits nothing.  Rows that share a path are files of their
    own.  Columns with these names are replaced; an empty table gives an empty table.
    """

    least: float = 0.8
    opening: bool = False
    templates: Mapping[str, tuple[str, ...]] = field(default_factory=lambda: TEMPLATES)
    path_col: str = "path"
    text_col: str = "text"

    def own(self, files: DataFrame) -> DataFrame:
        """Adds ``_own``, ``_similarity``, ``_opens`` and ``_only`` (where the license stands)."""

        def run(batch):
            vectors = _Vectors.of(self.templates, self.least)
            found = [_own_license(t, vectors) for t in texts(batch, self.text_col)]
            names, scores, opens, only = zip(*found) if found else ((), (), (), ())
            return {
                "_own": pa.array(names, pa.string()),
                "_similarity": pa.array(scores, pa.float64()),
                "_opens": pa.array(opens, pa.bool_()),
                "_only": pa.array(only, pa.bool_()),
            }

        new = [
            StructField("_own", StringType()),
            StructField("_similarity", DoubleType()),
            StructField("_opens", BooleanType()),
            StructField("_only", BooleanType()),
        ]
        return add_columns(files, run, StructType(new))

    def __call__(self, files: DataFrame) -> DataFrame:
        path = F.col(f"`{self.path_col}`")
        results = ("license", "similarity", "license_from")
        left_out = (*results, self.text_col.lower())
        columns = [f"`{c}`" for c in files.columns if c.lower() not in left_out]
        # the texts are read once; what follows needs paths and findings only
        text = F.col(f"`{self.text_col}`").alias(self.text_col)
        parted = files.select(F.struct(*columns).alias("_file"), path.alias("_path"), text)
        scanned = reread(
            self.own(parted)
            .drop(self.text_col)
            .withColumn("_dir", F.regexp_replace("_path", "/?[^/]*$", ""))
        )
        named = F.substring_index("_path", "/", -1).rlike(LICENSE_FILE)
        governs = F.col("_only") | named | (F.lit(self.opening) & F.col("_opens"))
        order = F.struct((-F.col("_similarity")).alias("_rank"), F.col("_path"), F.col("_own").alias("_name"))
        of_dir = store(
            scanned.where(F.col("_own").isNotNull() & F.col("_dir").isNotNull() & governs)
            .groupBy("_dir")
            .agg(F.min(order).alias("_found"))
            .select(
                F.col("_dir").alias("_ancestor"),
                F.col("_found._name").alias("_inherited"),
                (-F.col("_found._rank")).alias("_inherited_similarity"),
            )
        )
        # each directory once, joined with every directory above it; the deepest with a license wins
        parts = F.split("_dir", "/")
        depths = F.sequence(F.lit(1), F.size(parts))
        above = F.transform(
            depths,
            lambda n: F.struct(n.alias("_depth"), F.array_join(F.slice(parts, 1, n), "/").alias("_ancestor")),
        )
        dirs = (
            scanned.where("_own is null and _dir is not null")
            .select("_dir")
            .distinct()
            .select("_dir", F.inline(above))
        )
        nearest = store(
            lookup(dirs, [of_dir], ["_ancestor"])
            .where("_inherited is not null")
            .groupBy("_dir")
            .agg(F.max_by(F.struct("_inherited", "_inherited_similarity"), "_depth").alias("_found"))
            .select("_dir", "_found.*")
        )
        own = F.col("_own").isNotNull()
        return lookup(scanned, [nearest], ["_dir"], copies=True).select(
            "_file.*",
            F.coalesce("_own", "_inherited").alias("license"),
            F.when(own, F.col("_similarity")).otherwise(F.col("_inherited_similarity")).alias("similarity"),
            F.when(own, "own").when(F.col("_inherited").isNotNull(), "inherited").alias("license_from"),
        )
