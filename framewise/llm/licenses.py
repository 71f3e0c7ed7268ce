"""License scans: MinHash bands over overlapping windows, then exact containment.

Templates are grouped by length; for each length a text is covered by windows
of two strides, so that any passage of a template's length lies whole in one.
A window whose MinHash agrees with a template's in any band is a candidate, and
the share of the template's shingles found in it decides.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from framewise.llm.common import SpanHasher, shingle_hashes

# Public notices, as their publishers word them.
NOTICES = {
    "Apache-2.0": [
        "Licensed under the Apache License, Version 2.0.",
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in '
        "compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
    ],
    "BSD": [
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
        "that the following conditions are met:",
    ],
    "CC-BY-NC-4.0": ["Licensed under CC BY-NC 4.0."],
    "CC-BY-4.0": ["This work is licensed under a Creative Commons Attribution 4.0 International License."],
    "GPL-3.0": [
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your "
        "option) any later version.",
    ],
    "MIT": [
        "Released under the MIT License.",
        'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated '
        'documentation files (the "Software"), to deal in the Software without restriction',
    ],
}

#: Hash functions, one a band: one agreeing minimum retrieves a window.  A
#: window holding the least admitted share (0.75) of a template has Jaccard
#: similarity above 0.17 with it, and is missed with probability below 1e-5;
#: a template of one shingle has 1/8 of its window, and is missed with 2e-4.
BANDS = 64
LEAST_STRIDE = 4
#: Shingles hashed at once: bounds memory on very long texts.
SLICE = 1 << 16

_TABLE = bytes(c if 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A or c >= 0x80 else 0x20 for c in range(256))


def words_of(text: str | None) -> list[bytes]:
    return text.encode().lower().translate(_TABLE).split() if text else []


@dataclass(frozen=True)
class Template:
    license: str
    shingles: np.ndarray   # sorted distinct
    signature: np.ndarray


class Matcher:
    def __init__(self, notices: dict[str, list[str]], k: int = 5, num: int = 75, den: int = 100, seed: int = 3) -> None:
        rng = np.random.default_rng(seed)
        self.a = (rng.integers(0, 1 << 32, BANDS, dtype=np.uint64) | np.uint64(1)).astype(np.uint32)[:, None]
        self.b = rng.integers(0, 1 << 32, BANDS, dtype=np.uint64).astype(np.uint32)[:, None]
        self.k, self.num, self.den = k, num, den
        self.hasher = SpanHasher()
        self.by_stride: dict[int, list[Template]] = {}
        for name, texts in sorted(notices.items()):
            for text in texts:
                s = np.unique(shingle_hashes(self.hasher, words_of(text), k))
                if len(s):
                    stride = max(LEAST_STRIDE, 1 << (len(s) - 1).bit_length())
                    self.by_stride.setdefault(stride, []).append(Template(name, s, self._minima(s, len(s))[:, 0]))

    def _minima(self, shingles: np.ndarray, stride: int) -> np.ndarray:
        """Bands x strides: least hash of each stride of consecutive shingles."""
        h = (shingles >> np.uint64(32)).astype(np.uint32)
        return np.minimum.reduceat(h * self.a + self.b, np.arange(0, len(h), stride), axis=1)

    def find(self, text: str | None) -> list[tuple[str, int, int, float]]:
        """(license, first word, end word, containment) of each passage: adjacent windows are merged."""
        shingles = shingle_hashes(self.hasher, words_of(text), self.k)
        found: list[tuple[str, int, int, float]] = []
        for stride, templates in self.by_stride.items():
            if not len(shingles):
                break
            # Windows of a slice start in it; each slice reaches one stride further.
            for at in range(0, len(shingles), SLICE):
                part = shingles[at:at + SLICE + stride]
                low = self._minima(part, stride)
                windows = np.minimum(low[:, :-1], low[:, 1:]) if low.shape[1] > 1 else low
                for t in templates:
                    for w in np.flatnonzero((windows == t.signature[:, None]).any(0)).tolist():
                        a, b = w * stride, min((w + 2) * stride, len(part))
                        inside = np.isin(part[a:b], t.shingles)
                        share = len(np.unique(part[a:b][inside]))
                        if self.den * share >= self.num * len(t.shingles):
                            hit = np.flatnonzero(inside)
                            found.append((t.license, at + a + int(hit[0]), at + a + int(hit[-1]) + self.k,
                                          share / len(t.shingles)))
        merged: list[tuple[str, int, int, float]] = []
        for name, a, b, share in sorted(found):
            if merged and merged[-1][0] == name and a < merged[-1][2]:
                last = merged.pop()
                merged.append((name, last[1], max(b, last[2]), max(share, last[3])))
            else:
                merged.append((name, a, b, share))
        return merged


def scan(docs: DataFrame, notices: dict[str, list[str]] = NOTICES, **kw) -> DataFrame:
    """One row per document: doc_id, licenses, n_matches, containment, spans.

    ``licenses`` is the comma-joined sorted names, ``n_matches`` the number of
    matched passages, ``containment`` the best share of a template's shingles
    (0 without a match), ``spans`` the passages as ``name:first word:end word``
    by place.  Words are ASCII-lowered runs of digits, letters and non-ASCII
    characters; notices and texts of fewer words than a shingle are one
    shingle.  Null and empty texts match nothing; repeated rows keep their
    rows.  No shuffle: the templates travel in the task.
    """
    held = docs.sparkSession.sparkContext.broadcast(notices)
    ready: list[Matcher] = []

    @F.pandas_udf("struct<licenses:string, n_matches:bigint, containment:double, spans:string>")
    def look(texts: pd.Series) -> pd.DataFrame:
        if not ready:
            ready.append(Matcher(held.value, **kw))
        out = []
        for t in texts:
            found = ready[0].find(t)
            out.append((",".join(sorted({f[0] for f in found})), len(found), max((f[3] for f in found), default=0.0),
                        ",".join(f"{n}:{a}:{b}" for n, a, b, _ in sorted(found, key=lambda f: (f[1], f[0])))))
        return pd.DataFrame(out, columns=["licenses", "n_matches", "containment", "spans"])

    return docs.select("doc_id", look.asNondeterministic()(F.col("text")).alias("_f")).select("doc_id", "_f.*")
