"""Licence scans by conditional compression: how much a licence's wording helps to compress a block of text."""

from __future__ import annotations

import re
from bisect import bisect_right
from collections.abc import Callable, Iterable, Iterator, Mapping
from functools import lru_cache

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Wordings to look for. Fixed values.
TEMPLATES: dict[str, str] = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "BSD-3-Clause": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",
    "CC-BY-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "CC-BY-SA-4.0": "Licensed under CC BY-SA 4.0.",
    "CC0-1.0": "To the extent possible under law, the author has waived all copyright and related rights to this work.",
    "GPL-2.0": "This work is licensed under the GNU General Public License, version 2.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "LGPL-3.0": "This work is licensed under the GNU Lesser General Public License, version 3.",
    "MIT": "Released under the MIT License.",
    "MIT-long": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    "Unlicense": "This is free and unencumbered software released into the public domain.",
}
#: A block lies around one of these stems; each template has one.
STEM = re.compile(r"licen[sc]|permi|copyright|public\W+domain", re.IGNORECASE)
#: The share of a template's words that may differ.
DIFFER = 0.15
#: Words on both sides of a run that its size reduction is measured with, within its lines.
AROUND = 160
LEVEL = 3
WORD, BREAK, WRAP = re.compile(r"\w+(?:[.\-]\w+)*"), re.compile(r"\r\n|\r|\n"), re.compile(r"[^\S\r\n]*[\r\n]\W*")


def words(text: str) -> list[str]:
    return WORD.findall(text.lower())


def costs(template: list[str], block: list[str]) -> list[tuple[int, int]]:
    """For each end in the block: fewest words to change, drop or insert so that the template becomes a run of the
    block's words that ends there; and the start of the run. One row of costs at a time."""
    row = [(0, j) for j in range(len(block) + 1)]
    for i, t in enumerate(template, 1):
        new = [(i, row[0][1])]
        for j, b in enumerate(block, 1):
            new.append(min((row[j - 1][0] + (t != b), row[j - 1][1]), (row[j][0] + 1, row[j][1]), (new[-1][0] + 1, new[-1][1])))
        row = new
    return row


def difference(template: list[str], block: list[str]) -> tuple[int, int, int]:
    """The least of the costs over all runs of the block; and the run."""
    row = costs(template, block)
    cost, end = min((c, j) for j, (c, _) in enumerate(row))
    return cost, row[end][1], end


class Scanner:
    """Compressors that know one template each, and a plain one."""

    def __init__(self, templates: Mapping[str, str]):
        self.names = sorted(templates)
        self.words = [words(templates[n]) for n in self.names]
        raw = lambda t: zstandard.ZstdCompressionDict(t.encode(), dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        plain = dict(level=LEVEL, write_content_size=False, write_dict_id=False)
        self.plain = zstandard.ZstdCompressor(**plain)
        self.known = [zstandard.ZstdCompressor(dict_data=raw(templates[n]), **plain) for n in self.names]
        self.most = [int(DIFFER * len(w)) for w in self.words]
        self.around = max((len(w) + m for w, m in zip(self.words, self.most)), default=0)
        self.kept = lru_cache(50_000)(self._reduction)

    def _reduction(self, text: str, i: int) -> float:
        data = text.encode()
        return 1 - len(self.known[i].compress(data)) / len(self.plain.compress(data))

    def reduction(self, text: str, i: int) -> float:
        return self.kept(text, i) if len(text) <= 4096 else self._reduction(text, i)

    def found(self, block: list[str], shown: Callable[[int, int], str]) -> list[tuple[int, int, int, float]]:
        """(start, template, differing words, size reduction) of runs of the block that don't overlap, those with the
        fewest differing words first, then those with the greatest reduction of what is shown for the run. Every
        template is tried; what lies between the runs is searched again until nothing is left."""
        out, todo = [], [(0, len(block))]
        while todo:
            low, high = todo.pop()
            part = block[low:high]
            have, close = set(part), []
            for i, t in enumerate(self.words):
                if not t or sum(w in have for w in t) < len(t) - self.most[i]:
                    continue
                for end, (cost, start) in enumerate(costs(t, part)):
                    if cost <= self.most[i] and start < end:
                        gain = self.reduction(shown(low + start, low + end), i)
                        if gain > 0:
                            close.append((cost, -gain, start, end, i))
            taken, cuts = bytearray(len(part)), []
            for cost, gain, start, end, i in sorted(close):
                if not any(taken[start:end]):
                    taken[start:end] = b"\1" * (end - start)
                    cuts.append((start, end))
                    out.append((low + start, i, cost, -gain))
            if cuts:
                edges = [0, *(x for cut in sorted(cuts) for x in cut), len(part)]
                todo += [(low + a, low + b) for a, b in zip(edges[::2], edges[1::2]) if a < b]
        return sorted(out)

    def scan(self, text: str) -> list[tuple[int, str, float, int, bool]]:
        if not STEM.search(text):
            return []
        spans = [m.span() for m in WORD.finditer(text)]
        stream, breaks = [text[a:b].lower() for a, b in spans], [m.span() for m in BREAK.finditer(text)]
        starts = [0, *(b for _, b in breaks)]
        stops = [*(a for a, _ in breaks), len(text)]
        line = lambda i: bisect_right(starts, spans[i][0]) - 1

        def shown(a: int, b: int) -> str:
            """The lines of a run, of long ones the words around it; a break and what stands before the next word are a blank."""
            left, right = starts[line(a)], stops[line(b - 1)]
            return WRAP.sub(" ", text[max(left, spans[max(0, a - AROUND)][0]) : min(right, spans[min(len(spans), b + AROUND) - 1][1] + 1)])

        out = []
        for low, high in self.blocks(text, spans):
            for start, i, cost, gain in self.found(stream[low:high], lambda a, b: shown(low + a, low + b)):
                out.append((line(low + start), self.names[i], gain, cost, cost == 0))
        return out

    def blocks(self, text: str, spans: list[tuple[int, int]]) -> Iterator[tuple[int, int]]:
        """Runs of words, across lines, that hold a template's length on both sides of each stem, joined where they touch."""
        begins, low, high = [a for a, _ in spans], 0, 0
        for m in STEM.finditer(text):
            at = max(0, bisect_right(begins, m.start()) - 1)
            a, b = max(0, at - self.around), min(len(spans), at + self.around + 1)
            if low < high and a >= high:
                yield low, high
                low = a
            elif low == high:
                low = a
            high = b
        if low < high:
            yield low, high


def scan_licences(docs: DataFrame, templates: Mapping[str, str] = TEMPLATES, text: str = "text", key: str = "doc_id") -> DataFrame:
    """doc_id, line (from 0), licence, reduction, differing_words, exact: a row for each run of a text's words that carries a
    template's wording.

    Blocks are the words around each licence stem, across line breaks; `line` is that of a run's first word. Every template is compared with a block by the exact
    number of words in which its wording differs from the nearest runs, at most 15 % of the template; it must reduce
    the size of the run's lines as a raw Zstandard dictionary. Of runs that overlap, the one with the fewest differing
    words counts, then the one that is reduced most. One pass without a shuffle. Null and empty texts have no blocks; null keys come back as
    null; repeated rows are found as often; an empty table gives no rows; other columns are ignored.
    """
    held = dict(templates)

    def batches(it: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(held)
        for batch in it:
            rows = [(k.as_py(), *hit) for k, t in zip(batch.column(0), batch.column(1)) for hit in scanner.scan(t.as_py() or "")]
            cols = list(zip(*rows)) or [()] * 6
            kinds = (pa.int64(), pa.int32(), pa.string(), pa.float64(), pa.int32(), pa.bool_())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds)], names=["doc_id", "line", "licence", "reduction", "differing_words", "exact"])

    return docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text")).mapInArrow(
        batches, "doc_id long, line int, licence string, reduction double, differing_words int, exact boolean"
    )
