"""License scan by conditional compression.

Blocks are paragraphs (cut at blank lines) that mention a license. A block is looked at as its words, so line breaks and comment
signs do not matter. Windows of a template's length are compressed with zstandard, once plainly and once with the template as raw
dictionary: the bytes saved, against the template's own compressed size, rank it. A template that saves enough of a window is
compared with it word by word and confirmed if nothing differs; every such place is a row. Around the mentions that are left,
windows as long as the longest template are compressed with every template, the best ones are compared word by word, and the
differences of the nearest one are reported.
"""

from __future__ import annotations

import bisect
import difflib
import re

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, functions as F

# Wording of common notices. "{}" stands for names and years that differ from text to text.
TEMPLATES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0-notice": (
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance '
        "with the License. You may obtain a copy of the License at"
    ),
    "MIT": "Released under the MIT License.",
    "MIT-text": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        'documentation files (the "Software"), to deal in the Software without restriction, including without limitation '
        "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software"
    ),
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-2.0": "This work is licensed under the GNU General Public License, version 2.",
    "LGPL-3.0": "This work is licensed under the GNU Lesser General Public License, version 3.",
    "AGPL-3.0": "This work is licensed under the GNU Affero General Public License, version 3.",
    "BSD-3-Clause": "Released under the BSD 3-Clause License.",
    "BSD-text": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
        "the following conditions are met"
    ),
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    "CC-BY-4.0": "Licensed under CC BY 4.0.",
    "CC-BY-SA-4.0": "Licensed under CC BY-SA 4.0.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "CC-BY-ND-4.0": "Licensed under CC BY-ND 4.0.",
    "CC0-1.0": "Released under CC0 1.0 Universal.",
    "CC-BY-4.0-text": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "Unlicense": "This is free and unencumbered software released into the public domain.",
    "Proprietary": "Copyright {}. All rights reserved.",
    "Proprietary-sign": "© {}. All rights reserved.",
}
MENTION = r"(?i)licen[sc]|copyright|©|creative[\W_]+commons|public[\W_]+domain|permission[\W_]+is[\W_]+hereby|redistribution[\W_]+and[\W_]+use|all[\W_]+rights[\W_]+reserved|\bcc0\b"
GAP_WORDS = 200  # words that "{}" may stand for
BEST = 4  # templates compared word by word; ties with the last one are compared too
MIN_REDUCTION = 0.2
_WORD = re.compile(r"[^\W_]+|©")
_MENTION = re.compile(MENTION)
_COMMENT = re.compile(r"(?im)^[ \t]*(dnl|rem)\b")  # comment signs that look like words
_PARAGRAPH = re.compile(r"(?:[^\n]|\n(?!\s*\n))+")

RESULT = (
    "block int, start long, license string, reduction double, missing int, extra int, differences string, confirmed boolean"
)


def blocks(text: str) -> list[tuple[int, str]]:
    """(start, block) of every candidate block of a text."""
    return [(part.start(), part.group()) for part in _PARAGRAPH.finditer(text) if _MENTION.search(part.group())]


class Scanner:
    """Compressors with one template each as dictionary."""

    def __init__(self, templates: dict[str, str]):
        self.words = {name: _words(text.replace("©", " ")) for name, text in templates.items()}
        # The sign may be left out.
        self.parts = []
        for name, text in templates.items():
            for parts in (_parts(_words(text)), _parts(self.words[name])):
                if parts and (name, parts) not in self.parts:
                    self.parts.append((name, parts))
        self.reach = max((len(words) for words in self.words.values()), default=1)
        self.plain = zstandard.ZstdCompressor(level=3, write_content_size=False)
        self.with_template, self.size = {}, {}
        for name, words in self.words.items():
            data = " ".join(words).encode()
            self.size[name] = len(self.plain.compress(data))
            self.with_template[name] = zstandard.ZstdCompressor(
                level=3,
                write_content_size=False,
                dict_data=zstandard.ZstdCompressionDict(data, dict_type=zstandard.DICT_TYPE_RAWCONTENT),
            )
        self.known: dict[tuple, tuple] = {}

    def saved(self, name: str, data: bytes, size: int) -> float:
        """Bytes that the template saves, as a share of its own compressed size."""
        return (size - len(self.with_template[name].compress(data))) / self.size[name]

    def rank(self, own: list[str]) -> list[tuple[float, str]]:
        """Templates by what they save of these words, the largest first."""
        data = " ".join(own).encode("utf-8", "surrogatepass")
        size = len(self.plain.compress(data))
        return sorted(((self.saved(name, data, size), name) for name in self.words), key=lambda x: (-x[0], x[1]))

    def reduction(self, name: str, own: list[str]) -> float:
        """What the template saves of these words."""
        data = " ".join(own).encode("utf-8", "surrogatepass")
        return self.saved(name, data, len(self.plain.compress(data)))

    def notices(self, own: list[str]) -> list[tuple[int, int, str]]:
        """(first word, end, template) of every place where a template stands whole, without those inside a longer one.

        Windows of a template's length begin wherever its first word stands. Those of which it saves enough are compared.
        """
        at: dict[str, list[int]] = {}
        for i, word in enumerate(own):
            at.setdefault(word, []).append(i)
        ranked = []
        for name, parts in self.parts:
            begin = 0
            for starts in _aligned(parts, at):
                end = starts[-1] + len(parts[-1])
                if starts[0] < begin or end > len(own):
                    continue
                window = [own[c : c + len(part)] for c, part in zip(starts, parts)]
                said = _joined(window)
                reduction = self.remembered(f"window {name}", said, lambda said=said, name=name: self.reduction(name, said))
                if reduction >= MIN_REDUCTION and window == parts:
                    ranked.append((starts[0], end, reduction, name))
                    begin = end
        out, high = [], 0
        for a, b, _, name in sorted(ranked, key=lambda x: (x[0], -x[1], -x[2], x[3])):
            if b > high:
                out.append((a, b, name))
                high = b
        return out

    def nearest(self, own: list[str]) -> tuple | None:
        """(first word, end, template, reduction, missing, extra, differences) of the best template, or None without one."""
        ranked = self.rank(own)
        floor = ranked[min(BEST, len(ranked)) - 1][0] if ranked else 0
        best = None
        for reduction, name in ranked:
            if reduction < max(floor, MIN_REDUCTION):
                break
            low, high, missing, extra, differences = _differences(self.words[name], own)
            if low == high:
                continue
            key = ((missing + extra) / len(self.words[name]), -len(self.words[name]), -reduction, name)
            if best is None or key < best[0]:
                best = key, (low, high, name, reduction, missing, extra, differences)
        return best and best[1]

    def remembered(self, kind: str, own: list[str], make):
        key = (kind, *own)
        if key not in self.known:
            if len(self.known) > 50_000:
                self.known.clear()
            self.known[key] = make()
        return self.known[key]

    def judge(self, block: str) -> list[tuple]:
        """(start, license, reduction, missing, extra, differences, confirmed) of every notice of a block, by place."""
        signs = {m.span(1) for m in _COMMENT.finditer(block)}
        spots = [m for m in _WORD.finditer(block) if m.span() not in signs]
        own = [m.group().lower() for m in spots]
        line, starts, at = " " + " ".join(own) + " ", [], 0
        for word in own:
            starts.append(at)
            at += len(word) + 1
        whole = self.notices(own)
        out = []
        for a, b, name in whole:
            said = own[a:b]
            reduction = self.remembered(name, said, lambda said=said, name=name: self.reduction(name, said))
            out.append((a, (name, reduction, 0, 0, "", True)))
        # Mentions outside of the notices: their surroundings, up to the notices before and after.
        taken, seen, turn = 0, 0, 0
        for mention in _MENTION.finditer(line):
            i = bisect.bisect_left(starts, mention.start()) - 1
            while turn < len(whole) and whole[turn][1] <= i:
                taken = max(taken, whole[turn][1])
                turn += 1
            if i < max(taken, seen) or turn < len(whole) and whole[turn][0] <= i:
                continue
            first, end = max(taken, i - self.reach), whole[turn][0] if turn < len(whole) else len(own)
            window = own[first : min(i + 2 * self.reach, end)]
            found = self.remembered("", window, lambda window=window: self.nearest(window))
            if found:
                a, b, *answer = found
                out.append((first + a, (*answer, False)))
                taken = first + b
                seen = i + 1
            else:
                out.append((i, (None, 0.0, 0, 0, "", False)))
                seen = i + self.reach
        return [(spots[a].start(), *answer) for a, answer in sorted(out, key=lambda x: x[0])]


def _words(text: str) -> list[str]:
    return _WORD.findall(text.replace("{}", " Δ ").lower())


def _parts(template: list[str]) -> list[list[str]]:
    """The wording between the marks of parts that differ."""
    parts = [[]]
    for word in template:
        if word == "δ":
            parts.append([])
        else:
            parts[-1].append(word)
    return [part for part in parts if part]


def _joined(parts: list[list[str]]) -> list[str]:
    """The words of the parts with the mark between them."""
    out = list(parts[0])
    for part in parts[1:]:
        out += ["δ", *part]
    return out


def _aligned(parts: list[list[str]], at: dict[str, list[int]], before: int | None = None):
    """Where windows of the parts may begin: at their first words, one after the other. For each end the narrowest are first."""
    *head, last = parts
    spots = at.get(last[0], [])
    if before is not None:
        low = bisect.bisect_left(spots, before - len(last) - GAP_WORDS)
        spots = spots[low : bisect.bisect_right(spots, before - len(last))][::-1]
    for spot in spots:
        if head:
            for starts in _aligned(head, at, spot):
                yield [*starts, spot]
        else:
            yield [spot]


def _differences(template: list[str], own: list[str]) -> tuple[int, int, int, int, str]:
    """Span of the template in ``own``, words of the template that are missing, words within the span that are not in it, and
    what they are. Only the surroundings of the longest common part are looked at."""
    gap = "δ"  # lower case of the mark of a part that differs
    common = difflib.SequenceMatcher(None, template, own, autojunk=False).find_longest_match()
    skipped = max(0, common.b - common.a - len(template))
    own = own[skipped : common.b - common.a + 2 * len(template)]
    found = difflib.SequenceMatcher(None, template, own, autojunk=False)
    spans = [b for b in found.get_matching_blocks() if b.size]
    if not spans:
        return 0, 0, len(template), 0, "-" + " ".join(template)
    low, high = spans[0].b, spans[-1].b + spans[-1].size
    missing, extra, said = 0, 0, []
    for kind, a, b, c, d in found.get_opcodes():
        c, d = max(c, low), min(d, high)
        lost, more = [w for w in template[a:b] if w != gap], [w for w in own[c:d] if w != "©"] if c < d else []
        if kind == "equal" or gap in template[a:b] and not lost:
            continue
        missing += len(lost)
        extra += len(more)
        if lost:
            said.append("-" + " ".join(lost))
        if more:
            said.append("+" + " ".join(more))
    return low + skipped, high + skipped, missing, extra, "; ".join(said)


def scan_licenses(docs: DataFrame, templates: dict[str, str] | None = None) -> DataFrame:
    """One row per notice in ``docs`` (doc_id, text): doc_id and the columns of ``RESULT``.

    ``block`` counts the paragraphs with a mention, ``start`` is where the notice begins in the text, in code points.
    ``confirmed`` means that all words of the template stand there in order with nothing else in between; a block
    has a row for every such place. A mention outside of them has a row for the nearest template, with its differences, or, if no template
    saves ``MIN_REDUCTION`` of its own compressed size, one with a null license; mentions close to each other share it.
    Null and empty texts and texts without a mention have no rows. Repeated rows are scanned each on its own, other
    columns are ignored. Whole texts are read.
    """
    known = TEMPLATES if templates is None else templates

    def scan(batches):
        scanner = Scanner(known)
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch.column("doc_id"), batch.column("text").to_pylist()):
                for i, (start, block) in enumerate(blocks(text)):
                    for at, name, reduction, missing, extra, differences, confirmed in scanner.judge(block):
                        rows.append((doc_id.as_py(), i, start + at, name, float(reduction), missing, extra, differences, confirmed))
            kinds = [batch.schema.field("doc_id").type, pa.int32(), pa.int64(), pa.string(), pa.float64(), pa.int32(), pa.int32(), pa.string(), pa.bool_()]
            names = ["doc_id", *[c.split()[0] for c in RESULT.split(", ")]]
            columns = zip(*rows) if rows else [[]] * len(names)
            yield pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(columns, kinds)], names)

    kind = docs.schema["doc_id"].dataType.simpleString()
    mention = docs.select("doc_id", "text").where(F.col("text").rlike(MENTION))
    return mention.mapInArrow(scan, f"doc_id {kind}, {RESULT}")
