"""License scans by patience alignment.

A text is aligned with a license template like a patience diff: equal words
at both ends are matched; words that occur once in both are anchors; the
longest increasing run of anchors is kept; the gaps between are aligned the
same way.  Coverage is the share of template words matched within a span of
text not much longer than the template.

Alignment runs in windows around occurrences of a template's telling words
(those that are not everyday words), so a text of any length is scanned
whole in memory proportional to its words.
"""

from __future__ import annotations

from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabflow.llm.columns import make_room
from tabflow.llm.text import alnum_words

# Notices of common licenses and how their texts begin, and everyday words.
TEMPLATES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0-header": "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance "
                         "with the License. You may obtain a copy of the License at",
    "BSD": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
           "following conditions are met:",
    "CC-BY-4.0": "Licensed under CC BY 4.0.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "CC-BY-SA-4.0": "Licensed under CC BY-SA 4.0.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-3.0-header": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
                      "Public License as published by the Free Software Foundation, either version 3 of the License",
    "MIT": "Released under the MIT License.",
    "MIT-text": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
                "documentation files (the \"Software\"), to deal in the Software without restriction",
    "reserved": "All rights reserved.",
}
#: Phrases of a template that a match must hold word for word, with nothing between.
TELLING = {
    "Apache-2.0": ["apache license version 2 0"], "Apache-2.0-header": ["apache license version 2 0"],
    "MIT": ["mit license"], "reserved": ["all rights reserved"],
}
for _terms in ("BY", "BY-SA", "BY-ND", "BY-NC", "BY-NC-SA", "BY-NC-ND"):
    for _v in ("2.0", "3.0", "4.0"):
        TEMPLATES[f"CC-{_terms}-{_v}"] = f"Licensed under CC {_terms} {_v}."
        TELLING[f"CC-{_terms}-{_v}"] = [f"cc {_terms} {_v}".lower().replace("-", " ").replace(".", " ")]
for _name, _kind, _v in (("GPL-2.0", "", "2"), ("GPL-3.0", "", "3"), ("LGPL-2.1", "Lesser ", "2.1"), ("LGPL-3.0", "Lesser ", "3"),
                         ("AGPL-3.0", "Affero ", "3")):
    _full, _version = f"GNU {_kind}General Public License", "version " + _v.replace(".", " ")
    TEMPLATES[_name] = f"This work is licensed under the {_full}, version {_v}."
    TEMPLATES[f"{_name}-header"] = (f"This program is free software: you can redistribute it and/or modify it under the terms of the {_full} "
                                    f"as published by the Free Software Foundation, either version {_v} of the License")
    TELLING |= {_name: [f"{_full.lower()} {_version}"], f"{_name}-header": [_full.lower(), f"{_version} of the license"]}
EVERYDAY = frozenset(b"a all and any are as at by can either following for free in is it may not of or this that the to under use "
                     b"with without you work 0 1 2 3 4".split())

Pairs = list[tuple[int, int]]


def patience_align(a: list, b: list) -> Pairs:
    """Positions of matched words, increasing in both lists."""
    pairs: Pairs = []
    work = [(0, len(a), 0, len(b))]
    while work:
        i, j, k, n = work.pop()
        while i < j and k < n and a[i] == b[k]:
            pairs.append((i, k))
            i, k = i + 1, k + 1
        while i < j and k < n and a[j - 1] == b[n - 1]:
            j, n = j - 1, n - 1
            pairs.append((j, n))
        if i == j or k == n:
            continue
        left, right = Counter(a[i:j]), Counter(b[k:n])
        at = {w: q for q, w in enumerate(b[k:n], k) if right[w] == 1}
        anchors = _increasing([(p, at[w]) for p, w in enumerate(a[i:j], i) if left[w] == 1 and w in at])
        pairs += anchors
        for (p, q), (r, s) in zip([(i - 1, k - 1), *anchors], [*anchors, (j, n)]) if anchors else ():
            work.append((p + 1, r, q + 1, s))
    return sorted(pairs)


def _increasing(pairs: Pairs) -> Pairs:
    """Longest run of ``pairs`` (sorted by the first) whose second positions increase, by patience sorting."""
    tops: list[int] = []
    piles: list[int] = []
    back = [-1] * len(pairs)
    for x, (_, q) in enumerate(pairs):
        p = bisect_left(tops, q)
        if p == len(tops):
            tops.append(q)
            piles.append(x)
        else:
            tops[p], piles[p] = q, x
        back[x] = piles[p - 1] if p else -1
    out, x = [], piles[-1] if piles else -1
    while x != -1:
        out.append(pairs[x])
        x = back[x]
    return out[::-1]


class LicenseScanner:
    """Finds templates in texts.  ``coverage``: least share of a template;
    ``stretch``: longest span in template lengths."""

    def __init__(self, templates: dict[str, str], coverage: float = 0.8, stretch: float = 1.5,
                 telling: dict[str, list[str]] | None = None):
        self.telling = {name: [p.encode().split() for p in ps] for name, ps in (telling or {}).items()}
        self.coverage, self.stretch = coverage, stretch
        self.templates = {name: alnum_words(t.encode()) for name, t in sorted(templates.items())}
        self.seeds: dict[bytes, list[tuple[str, int]]] = {}
        for name, ws in self.templates.items():
            for at, w in enumerate(ws):
                if w not in EVERYDAY:
                    self.seeds.setdefault(w, []).append((name, at))

    def _told(self, name: str, words: list[bytes], pairs: Pairs) -> bool:
        """True if the matched words hold every telling phrase with nothing inserted."""
        at = [p for p, _ in pairs]
        return all(any(words[a:a + len(t)] == t and at[i:i + len(t)] == list(range(a, a + len(t))) for i, a in enumerate(at))
                   for t in self.telling.get(name, ()))

    def _best(self, words: list[bytes], low: int, name: str) -> tuple[int, int, float] | None:
        """Densest matched span of a window that begins at word ``low``: first, last, coverage."""
        template = self.templates[name]
        pairs, most, best = patience_align(words, template), int(self.stretch * len(template)), None
        a = 0
        for b in range(len(pairs)):
            while pairs[b][0] - pairs[a][0] + 1 > most:
                a += 1
            share = (b - a + 1) / len(template)
            if share >= self.coverage and (best is None or share > best[2]) and self._told(name, words, pairs[a:b + 1]):
                best = (low + pairs[a][0], low + pairs[b][0], share)
        return best

    def scan(self, text: bytes | None) -> tuple[int, list[tuple[str, int, int, float]]]:
        """Number of words; (license, first word, last word, coverage), best first, without overlaps."""
        words = alnum_words(text)
        found: dict[tuple[str, int, int], float] = {}
        if not self.seeds.keys().isdisjoint(words):
            tried = set()
            for p, w in enumerate(words):
                for name, at in self.seeds.get(w, ()):
                    template = self.templates[name]
                    slack = max(1, int(len(template) * (self.stretch - 1)))
                    low, high = max(0, p - at - slack), min(len(words), p - at + len(template) + slack)
                    if (name, low, high) not in tried:
                        tried.add((name, low, high))
                        if best := (self._best(words[low:high], low, name)  # then without slack: no notice beside it is in the way
                                    or self._best(words[max(0, p - at):p - at + len(template)], max(0, p - at), name)):
                            found[name, best[0], best[1]] = best[2]
                if len(tried) > 4096:
                    tried = {x for x in tried if x[2] > p}
        # longer matches win over shorter ones inside them, then better ones, then by name
        order = sorted(((-round(s * len(self.templates[n])), -s, n, a, b) for (n, a, b), s in found.items()))
        return len(words), self._apart(order)

    @staticmethod
    def _apart(order: list[tuple]) -> list[tuple[str, int, int, float]]:
        """Greedy choice of spans that do not overlap; spans are kept sorted by position."""
        starts: list[int] = []
        ends: list[int] = []
        out = []
        for _, share, name, a, b in order:
            i = bisect_left(starts, a)
            if (i == 0 or ends[i - 1] < a) and (i == len(starts) or b < starts[i]):
                starts.insert(i, a)
                ends.insert(i, b)
                out.append((name, a, b, -share))
        return sorted(out, key=lambda x: x[1])


FOUND = T.StructType([T.StructField("n_words", T.LongType()), T.StructField("licenses", T.ArrayType(T.StructType([
    T.StructField("license", T.StringType()), T.StructField("first", T.IntegerType()), T.StructField("last", T.IntegerType()),
    T.StructField("coverage", T.DoubleType())])))])


def scan_licenses(docs: DataFrame, templates: dict[str, str] | None = None, coverage: float = 0.8, stretch: float = 1.5) -> DataFrame:
    """``docs`` with a struct ``found``: ``n_words`` and ``licenses``, the
    template spans in text order.

    Null and empty texts have no words and no licenses.  Every row is
    scanned whole; repeated rows give equal results.  Of overlapping spans
    the one with more matched words stays, then the better covered, then the
    first by name.  Templates are a parameter of fixed size and go to every
    task.  Other columns are unchanged; one named ``found`` becomes ``input_found``.
    """
    docs = make_room(docs, "found")
    scanner = LicenseScanner(templates or TEMPLATES, coverage, stretch, None if templates else TELLING)

    @F.pandas_udf(FOUND)
    def scan(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            yield pd.DataFrame([scanner.scan(t) for t in texts], columns=FOUND.names)

    return docs.withColumn("found", scan(F.col("text").cast("binary")))
