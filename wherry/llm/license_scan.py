"""License statements found by conditional compression and confirmed by exact wording differences.

Every line of every text that holds a license word (case-insensitive, by one automaton) is a candidate, together with the
candidate lines next to it and the lines around that a full license text explains: a block. The words of a block around each license word (and
around the words that identify a license) are compressed alone and with each template as a zstandard raw dictionary, in windows of three times
the template's length, so what else stands in the line does not count. A template that takes off enough, of what it takes off its own text or of the window, is near there.
Near templates are aligned word by word; the statement is the run of words with the most in common and the least between. It is confirmed if
the identifying words (name, version and terms) stand in it, with enough of the template's words in order (or, in a block shorter
than a template that is no full text, enough of the block's words), and if the template takes off enough of the statement's compressed size.
The statement that its template explains best in bytes goes first (what the template takes off, less what it leaves, less what it could have taken off more;
of equal ones the nearer in words), its words are taken out, and the rest of the block is judged again: a block gives a row for each statement. The differences are returned.

Blocks are found per document, in whole texts, with no shuffle. Templates are a parameter (name -> text, required words).

Defined cases: a null or empty text has no block; repeated rows are scanned each; several blocks of a document are several rows,
numbered in order, and the statements of a block share its number; sizes are those of the statement; a very long text is scanned whole, its
alignments staying near license words; empty tables give empty results; extra columns are ignored. A block no template explains is kept with license null and the
sizes of the whole block with the template that takes off most.
"""

from __future__ import annotations

import heapq
import re
from bisect import bisect_right
from collections.abc import Iterator
from dataclasses import dataclass
from difflib import SequenceMatcher

import ahocorasick
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wherry.llm.common import filled, slices

#: Words that a license statement has.
ANCHORS = ("license", "licence", "licensed", "licenced", "licensing", "copyright", "copyleft", "spdx", "warranty", "all rights reserved", "public domain", "creative commons", "cc by", "cc-by", "cc0", "permission is hereby granted", "redistribution and use")

#: Name -> (wording, words of it that a statement must hold).
TEMPLATES: dict[str, tuple[str, str]] = {
    "MIT": ("Released under the MIT License.", "mit"),
    "MIT-text": ('Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:', "permission granted"),
    "Apache-2.0": ("Licensed under the Apache License, Version 2.0.", "apache 2.0"),
    "Apache-2.0-header": ('Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0', "apache 2.0"),
    "BSD-2-Clause": ("Released under the BSD 2-Clause License.", "bsd 2-clause"),
    "BSD-3-Clause": ("Released under the BSD 3-Clause License.", "bsd 3-clause"),
    "BSD-text": ("Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:", "redistribution permitted"),
    "GPL-2.0": ("This work is licensed under the GNU General Public License, version 2.", "general public 2"),
    "GPL-3.0": ("This work is licensed under the GNU General Public License, version 3.", "general public 3"),
    "GPL-header": ("This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.", "general public 3"),
    "LGPL-3.0": ("This work is licensed under the GNU Lesser General Public License, version 3.", "lesser 3"),
    "AGPL-3.0": ("This work is licensed under the GNU Affero General Public License, version 3.", "affero 3"),
    "MPL-2.0": ("This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.", "mozilla 2.0"),
    "CC-BY-4.0": ("Licensed under CC BY 4.0.", "by 4.0"),
    "CC-BY-SA-4.0": ("Licensed under CC BY-SA 4.0.", "by-sa 4.0"),
    "CC-BY-NC-4.0": ("Licensed under CC BY-NC 4.0.", "by-nc 4.0"),
    "CC-BY-ND-4.0": ("Licensed under CC BY-ND 4.0.", "by-nd 4.0"),
    "CC-BY-NC-SA-4.0": ("Licensed under CC BY-NC-SA 4.0.", "by-nc-sa 4.0"),
    "CC0-1.0": ("Dedicated to the public domain under CC0 1.0.", "cc0"),
    "Unlicense": ("This is free and unencumbered software released into the public domain.", "unencumbered public domain"),
    "All-Rights-Reserved": ("Copyright. All rights reserved.", "rights reserved"),
}
LEAST_REDUCTION = 0.2
LEAST_COVER = 0.6
#: What a near template takes off a window, as a share of what it takes off its own text. Windows are of three times so many words, or more.
LEAST_NEAR = 0.2
REACH = 16
#: A template of so many words is a full text: its lines are joined to a block, and it is covered as a whole or not at all.
FULL_WORDS = 18
WORD = re.compile(r"[0-9A-Za-z]+(?:[.\-'][0-9A-Za-z]+)*")


def wording(text: str) -> list[str]:
    return [w.lower() for w in WORD.findall(text)]


@dataclass(frozen=True)
class Found:
    block: int
    line: int
    text: str
    license: str | None
    size_plain: int
    size_given: int
    reduction: float
    cover: float
    missing: str
    added: str


class Scanner:
    """Compressors for the templates; made once per Python worker."""

    def __init__(self, templates: dict[str, tuple[str, str]]):
        self.words = {n: wording(t) for n, (t, _) in templates.items()}
        self.required = {n: set(wording(r)) for n, (_, r) in templates.items()}
        self.full = [n for n, w in self.words.items() if len(w) >= FULL_WORDS]
        self.longest = 2 * max((len(t) for t, _ in templates.values()), default=0)
        self.plain = zstandard.ZstdCompressor(level=19, write_content_size=False)
        raw = {n: zstandard.ZstdCompressionDict(t.lower().encode(), dict_type=zstandard.DICT_TYPE_RAWCONTENT) for n, (t, _) in templates.items()}
        self.given = {n: zstandard.ZstdCompressor(level=19, dict_data=d, write_content_size=False) for n, d in raw.items()}
        said = {n: " ".join(w).encode() for n, w in self.words.items()}
        raw = {n: zstandard.ZstdCompressionDict(x, dict_type=zstandard.DICT_TYPE_RAWCONTENT) for n, x in said.items() if x}
        self.given_words = {n: zstandard.ZstdCompressor(level=19, dict_data=d, write_content_size=False) for n, d in raw.items()}
        self.most = {n: int.__sub__(*self._sizes(n, " ".join(t.lower().split()).encode())) for n, (t, _) in templates.items()}
        self.most_words = {n: len(self.plain.compress(x)) - len(self.given_words[n].compress(x)) for n, x in said.items() if x}
        self.longest_word = max((len(w) for words in self.words.values() for w in words), default=0)
        self.reach: dict[int, list[str]] = {}
        for n in self.given_words:
            self.reach.setdefault(max(REACH, 1 << (len(self.words[n]) - 1).bit_length()), []).append(n)
        self.anchors = ahocorasick.Automaton()
        for a in ANCHORS:
            self.anchors.add_word(a, a)
        self.anchors.make_automaton()
        self.seen: dict[str, tuple] = {}

    def _has_anchor(self, line: str) -> bool:
        return next(self.anchors.iter(line), None) is not None

    def blocks(self, text: str) -> list[tuple[int, str]]:
        """(number of the first line, text) of each run of candidate lines."""
        low = text.lower()
        if not self._has_anchor(low):
            return []
        lines = text.split("\n")
        inside = {k for k, line in enumerate(lines) if self._has_anchor(line.lower())}
        for k in sorted(inside):
            for step in (-1, 1):
                at = k + step
                while 0 <= at < len(lines) and at not in inside and self._explained(lines[at]):
                    inside.add(at)
                    at += step
        found: list[tuple[int, list[str]]] = []
        last = -2
        for k in sorted(inside):
            if k == last + 1:
                found[-1][1].append(lines[k])
            else:
                found.append((k, [lines[k]]))
            last = k
        return [(k, "\n".join(lines)) for k, lines in found]

    def _explained(self, line: str) -> bool:
        """Whether a line stands, for the most part and in order, in a full text."""
        if len(line) > self.longest:
            return False
        words = wording(line)
        for n in self.full:
            known = set(self.words[n])
            if words and sum(w in known for w in words) >= LEAST_COVER * len(words):
                added = self._confirm(n, words)[2].split()
                if len(words) - len(added) >= LEAST_COVER * len(words):
                    return True
        return False

    def _confirm(self, name: str, words: list[str]) -> tuple[float, str, str]:
        """(share of wording in common, words of the template that are missing, words that were added)."""
        template = self.words[name]
        matches = SequenceMatcher(None, template, words, autojunk=False).get_opcodes()
        same = sum(b - a for op, a, b, _, _ in matches if op == "equal")
        missing = [w for op, a, b, _, _ in matches if op != "equal" for w in template[a:b]]
        added = [w for op, _, _, a, b in matches if op != "equal" for w in words[a:b]]
        return same / max(1, min(len(template), len(words))), " ".join(missing), " ".join(added)

    def _near(self, words: list[str], sites: set[int], own: dict[str, list[int]]) -> dict[str, list[tuple[int, int]]]:
        """The windows of words where each template is near by conditional compression: around all sites, and around its own."""
        found: dict[str, list[tuple[int, int]]] = {}
        short = [w if len(w) <= self.longest_word else "_" for w in words]  # a longer word is in no template
        for reach, names in self.reach.items():
            tiles = {k // reach: names for k in sites}
            for n in names:
                for tile in {k // reach for k in own.get(n, ())}:
                    if n not in tiles.get(tile, ()):
                        tiles[tile] = [*tiles.get(tile, ()), n]
            for tile in sorted(tiles):
                low, high = max(0, (tile - 1) * reach), min(len(words), (tile + 2) * reach)
                data = " ".join(short[low:high]).encode()
                plain = len(self.plain.compress(data))
                for n in tiles[tile]:
                    saved = plain - len(self.given_words[n].compress(data))
                    if saved >= min(LEAST_NEAR * self.most_words[n], LEAST_REDUCTION * plain):
                        found.setdefault(n, []).append((low, high))
        return found

    def _align(self, name: str, words: list[str], at: int, low: int, high: int, read) -> tuple | None:
        """The statement of a template around words[at], inside words[low:high]: (-score in bytes, -score in words, -cover, name, start, stop, at, missing, added, plain size, size given the template)."""
        template = self.words[name]
        low, high = max(low, at - len(template)), min(high, at + len(template) + 1)
        runs = [m for m in SequenceMatcher(None, template, words[low:high], autojunk=False).get_matching_blocks() if m.size]
        best, score, start = (0, 0, 0), 0, 0  # the run of matches with most words in common, less those between
        for k, m in enumerate(runs):
            between = m.b - runs[k - 1].b - runs[k - 1].size if k else 0
            if score <= between:
                score, start = 0, m.b
            else:
                score -= between
            score += m.size
            if score > best[0]:
                best = score, low + start, low + m.b + m.size
        _, start, stop = best
        if not self.required[name] <= set(words[start:stop]):
            return None
        _, missing, added = self._confirm(name, words[start:stop])
        same = len(template) - len(missing.split())
        cover = same / max(1, len(template) if name in self.full else min(len(template), len(words)))
        if cover < LEAST_COVER:
            return None
        plain, given = self._sizes(name, read(start, stop))
        explained = plain - 2 * given - max(0, self.most[name] - plain + given)
        return -explained, -(same - len(missing.split()) - len(added.split())), -cover, name, start, stop, at, missing, added, plain, given

    def _sizes(self, name: str, data: bytes) -> tuple[int, int]:
        return len(self.plain.compress(data)), len(self.given[name].compress(data))

    def judge(self, block: str) -> list[tuple]:
        """(license or None, plain size, size given the template, reduction, cover, missing, added) of each statement, in order."""
        if block in self.seen:
            return self.seen[block]
        low = block.lower()
        places = [m.span() for m in WORD.finditer(low)]
        words = [low[a:b] for a, b in places]
        where: dict[str, list[int]] = {}
        for k, w in enumerate(words):
            where.setdefault(w, []).append(k)
        read = lambda start, stop: " ".join(low[places[start][0] : places[stop - 1][1]].split()).encode()
        ends = [b for _, b in places]
        sites = {k for end, a in self.anchors.iter(low) if (k := bisect_right(ends, end - len(a) + 1)) < len(places)}
        own = {n: min((where[w] for w in sorted(required)), key=len) for n, required in self.required.items() if required and required <= where.keys()}
        queue = []
        for n, windows in self._near(words, sites, own).items():
            for at in own.get(n, ()):
                if any(a <= at < b for a, b in windows) and (found := self._align(n, words, at, 0, len(words), read)):
                    queue.append(found)
        heapq.heapify(queue)
        taken: list[tuple[int, int]] = []
        results = []
        while queue:
            _, _, cover, n, start, stop, at, missing, added, plain, given = heapq.heappop(queue)
            if any(a < stop and start < b for a, b in taken):  # what is left of it is judged again
                if not any(a <= at < b for a, b in taken):
                    free = max((b for _, b in taken if b <= at), default=0), min((a for a, _ in taken if a > at), default=len(words))
                    if found := self._align(n, words, at, *free, read):
                        heapq.heappush(queue, found)
                continue
            if 1 - given / plain >= LEAST_REDUCTION:
                taken.append((start, stop))
                results.append((start, (n, plain, given, round(1 - given / plain, 6), round(-cover, 6), missing, added)))
        result = [r for _, r in sorted(results)]
        if not result:
            data = " ".join(low.split()).encode()
            sizes = {n: self._sizes(n, data) for n in self.given}
            n = min(sizes, key=lambda n: (sizes[n][1], n))
            cover, missing, added = self._confirm(n, words)
            result = [(None, *sizes[n], round(1 - sizes[n][1] / sizes[n][0], 6), round(cover, 6), missing, added)]
        if len(self.seen) > 20_000:
            self.seen = {}
        if len(block) < 2_000:
            self.seen[block] = result
        return result

    def scan(self, text: str) -> list[Found]:
        return [Found(k, line, block, *found) for k, (line, block) in enumerate(self.blocks(text)) for found in self.judge(block)]


_SCANNERS: dict[int, Scanner] = {}


def scanner(templates: dict[str, tuple[str, str]]) -> Scanner:
    key = hash(tuple(sorted(templates.items())))
    if key not in _SCANNERS:
        _SCANNERS[key] = Scanner(templates)
    return _SCANNERS[key]


def scan_documents(docs: DataFrame, templates: dict[str, tuple[str, str]] | None = None) -> DataFrame:
    """One row per license statement of a candidate block: doc_id, block, line, block_text, license (null if none is confirmed), sizes, reduction, cover, missing, added."""
    templates = templates or TEMPLATES
    kinds = {"doc_id": pa.int64(), "block": pa.int32(), "line": pa.int32(), "block_text": pa.string(), "license": pa.string(), "size_plain": pa.int32(), "size_given": pa.int32(), "reduction": pa.float64(), "cover": pa.float64(), "missing": pa.string(), "added": pa.string()}

    def scanned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scan = scanner(templates).scan
        for batch in slices(batches, "text"):
            rows = [(doc_id, f.block, f.line, f.text, f.license, f.size_plain, f.size_given, f.reduction, f.cover, f.missing, f.added) for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()) for f in scan(text)]
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(kinds.values())], names=list(kinds))

    schema = "doc_id bigint, block int, line int, block_text string, license string, size_plain int, size_given int, reduction double, cover double, missing string, added string"
    return docs.select(F.col("doc_id").cast("bigint"), filled().alias("text")).mapInArrow(scanned, schema)
