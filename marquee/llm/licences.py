"""Licence scans: a trained paragraph classifier confirmed by templates.

A paragraph (line) is turned into its word n-grams of one to three words that
hold at least one licence term. A softmax regression over these sparse features
gives the probability of each licence family and of "unknown". It is fitted on
the driver to variants of the families' usual notices (words around them, words
left out, other versions of the wording) against paragraphs that use the same
words for other things. Temperature and the least probability of all families
together at which one is named come from paragraphs judged by weights that never saw their wording,
so that unknown is a calibrated class of its own.

A predicted family is confirmed if one of its templates covers the paragraph's
licence wording: enough of the template's n-grams must stand in the paragraph.
What isn't confirmed is unknown. A family of Creative Commons or GNU licences
must moreover have its own mark: exactly its conditions (BY, NC, ND, SA), or
plain, lesser or affero before "general public". So wording with a condition
more or less is never taken for a more permissive licence. Nothing is named
where the paragraph denies it ("not licensed under"). Wording that a named family's templates hold
is set aside and the rest is judged again, until nothing more is named: a
paragraph of two licences names both.

Notices are usually wrapped. So besides every line, the words around every line
break are judged, ``AROUND`` on either side across as many lines as that takes
(templates have up to 16), without comment markers. An empty line, or one of
markers only, ends a paragraph. A family that one of these lines already names
is the same notice.

A paragraph without any licence term has no features at all and is not a
licence paragraph; that is the model's own definition, not a pre-filter that
could lose cases.

Edge cases: NULL or empty text has no paragraphs; repeated paragraphs count
each time; rows are judged row by row; a document of several families names
them all, in alphabetical order; an empty table gives no rows; extra columns
are ignored.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marquee.llm.common import ship_package

UNKNOWN = "unknown"
#: fixed values: usual short notices of each family
TEMPLATES: dict[str, tuple[str, ...]] = {
    "agpl": (
        "licensed under the gnu affero general public license version 3",
        "this program is free software under the terms of the gnu affero general public license",
        "spdx-license-identifier agpl-3.0",
    ),
    "all-rights-reserved": (
        "all rights reserved",
        "copyright all rights reserved no part may be reproduced without permission",
        "unauthorized copying of this file is strictly prohibited proprietary and confidential",
    ),
    "apache-2.0": (
        "licensed under the apache license version 2.0",
        "released under the apache 2.0 license",
        "apache license 2.0",
        "you may obtain a copy of the apache license at apache.org licenses license-2.0",
        "spdx-license-identifier apache-2.0",
    ),
    "artistic": (
        "released under the artistic license 2.0",
        "you may redistribute it under the same terms as perl itself",
        "spdx-license-identifier artistic-2.0",
    ),
    "boost": (
        "distributed under the boost software license version 1.0",
        "boost software license 1.0",
        "spdx-license-identifier bsl-1.0",
    ),
    "bsd": (
        "licensed under the bsd 3-clause license",
        "released under the bsd 2-clause license",
        "released under the bsd license",
        "redistribution and use in source and binary forms with or without modification are permitted",
        "governed by a bsd-style license that can be found in the license file",
        "spdx-license-identifier bsd-3-clause",
    ),
    "cc-by": (
        "licensed under cc by 4.0",
        "cc by 4.0",
        "licensed under a creative commons attribution 4.0 international license",
        "this work is licensed under cc-by 4.0",
    ),
    "cc-by-nc": (
        "licensed under cc by-nc 4.0",
        "cc by-nc 4.0",
        "licensed under a creative commons attribution-noncommercial 4.0 international license",
        "this work is licensed under cc-by-nc 4.0",
    ),
    "cc-by-nc-nd": (
        "licensed under cc by-nc-nd 4.0",
        "cc by-nc-nd 4.0",
        "licensed under a creative commons attribution-noncommercial-noderivatives 4.0 international license",
        "this work is licensed under cc-by-nc-nd 4.0",
    ),
    "cc-by-nc-sa": (
        "licensed under cc by-nc-sa 4.0",
        "cc by-nc-sa 4.0",
        "licensed under a creative commons attribution-noncommercial-sharealike 4.0 international license",
        "this work is licensed under cc-by-nc-sa 4.0",
    ),
    "cc-by-nd": (
        "licensed under cc by-nd 4.0",
        "cc by-nd 4.0",
        "licensed under a creative commons attribution-noderivatives 4.0 international license",
        "this work is licensed under cc-by-nd 4.0",
    ),
    "cc-by-sa": (
        "licensed under cc by-sa 4.0",
        "cc by-sa 4.0",
        "licensed under a creative commons attribution-sharealike 4.0 international license",
        "this work is licensed under cc-by-sa 4.0",
    ),
    "cddl": (
        "subject to the terms of the common development and distribution license",
        "licensed under the cddl 1.0",
        "spdx-license-identifier cddl-1.0",
    ),
    "epl": (
        "made available under the terms of the eclipse public license v2.0",
        "licensed under the eclipse public license 2.0",
        "spdx-license-identifier epl-2.0",
    ),
    "eupl": (
        "licensed under the european union public license eupl v1.2",
        "spdx-license-identifier eupl-1.2",
    ),
    "gfdl": (
        "permission is granted to copy distribute and/or modify this document under the terms of the gnu free documentation license",
        "licensed under the gfdl 1.3",
    ),
    "gpl": (
        "this work is licensed under the gnu general public license version 3",
        "this program is free software you can redistribute it under the terms of the gnu general public license",
        "released under the gpl v3 license",
        "licensed under the gnu gpl version 2 or later",
        "spdx-license-identifier gpl-3.0",
    ),
    "isc": (
        "licensed under the isc license",
        "permission to use copy modify and/or distribute this software for any purpose with or without fee is hereby granted",
        "spdx-license-identifier isc",
    ),
    "lgpl": (
        "licensed under the gnu lesser general public license version 3",
        "released under the lgpl v2.1 license",
        "spdx-license-identifier lgpl-2.1",
    ),
    "mit": (
        "released under the mit license",
        "licensed under the mit license",
        "permission is hereby granted free of charge to any person obtaining a copy of this software",
        "spdx-license-identifier mit",
    ),
    "mpl": (
        "subject to the terms of the mozilla public license version 2.0",
        "licensed under the mozilla public license mpl 2.0",
        "subject to the terms of the mozilla public license v 2.0",
        "spdx-license-identifier mpl-2.0",
    ),
    "ms-pl": (
        "licensed under the microsoft public license ms-pl",
        "spdx-license-identifier ms-pl",
    ),
    "odbl": (
        "made available under the open database license",
        "licensed under the odbl 1.0",
    ),
    "ofl": (
        "this font software is licensed under the sil open font license version 1.1",
        "spdx-license-identifier ofl-1.1",
    ),
    "postgresql": (
        "released under the postgresql license",
        "spdx-license-identifier postgresql",
    ),
    "psf": (
        "licensed under the python software foundation license version 2",
        "spdx-license-identifier psf-2.0",
    ),
    "public-domain": (
        "released into the public domain",
        "dedicated to the public domain under cc0 1.0 universal",
        "this is free and unencumbered software released into the public domain unlicense",
        "licensed under cc0 1.0",
        "cc0 1.0 universal",
        "to the extent possible under law the author has waived all copyright and related or neighboring rights to this work",
        "spdx-license-identifier cc0-1.0",
        "spdx-license-identifier unlicense",
    ),
    "wtfpl": (
        "released under the do what the fuck you want to public license",
        "licensed under the wtfpl",
    ),
    "zlib": (
        "released under the zlib license",
        "in no event will the authors be held liable for any damages arising from the use of this software",
        "spdx-license-identifier zlib",
    ),
}
#: paragraphs that use the terms for something else
_OTHERS = (
    "the driver showed a license to the officer", "his fishing license was renewed in spring",
    "the license plate of the car was missing", "a license fee is due for every television set",
    "the board reserved two rooms for the visitors", "all rights and duties of the members are listed below",
    "civil rights were reserved to a few for a long time", "the source of the river lies in the hills",
    "she studied at mit and later at stanford", "the institute called mit opened a new building",
    "the apache helicopter landed at noon", "the apache people lived in the south west",
    "a gnu is a large antelope of the plains", "the general public was not admitted",
    "the public domain of the park ends at the fence", "permission to land was granted by the tower",
    "the creative team met the commons committee", "a copy of the letter was sent to the office",
    "the software was sold without any license at all", "mozilla released a new browser version",
    "copyright law was changed last year", "the redistribution of land took many years",
    "confidential talks went on under the table", "the licence to practise medicine was revoked",
    "please read the license before you install the program", "the terms of the contract are free to both parties",
    "the python slept in the warm sand", "a boost for the local economy was promised", "the eclipse was visible from the coast",
    "her artistic work is shown in the public library", "the database was open on every screen", "the font of the old church is made of stone",
    "the european union agreed on a common public budget", "the foundation gave money for the development of the school",
    "the authors were held liable for the damages of the flood", "the perl and the python programs were slow",
    "microsoft released the documentation of the program", "the distribution of the software took a week",
    "attribution of the painting is open", "he waived all rights to the house", "the library was zlib or another one",
)
#: words of the templates that say nothing by themselves
_PLAIN = frozenset(
    "a all and any are at be by can charge copy file for forms free general in into is it may modification no obtain obtaining of"
    " or other part person program released later strictly subject terms the this to under use version with without work you"
    " your source binary 1.0 2 2.0 2.1 3 4.0 hereby person international v2.1 v3 universal license-2.0"
    " redistribute same made available common development distribution public union european document any purpose fee open"
    " database foundation what do want extent possible law has author related no event will held from authors arising and/or"
    " modify distribute granted 1.1 1.2 1.3 v1.2 v2.0 font".split()
)
_WORD = re.compile(r"[a-z0-9][a-z0-9.+\-]*[a-z0-9]|[a-z0-9]")
TERMS = frozenset(w for texts in TEMPLATES.values() for t in texts for w in _WORD.findall(t)) - _PLAIN | {"licence", "licenced"}
_ANY_TERM = re.compile(r"(?<![a-z0-9])(?:" + "|".join(sorted(map(re.escape, TERMS), key=len, reverse=True)) + r")(?![a-z0-9])")
FAMILIES = sorted(TEMPLATES)
COVERED = 0.6
#: families less probable than this are not held against their templates
LEAST_SHARE = 0.1
#: words on either side of a line break
AROUND = 24
#: n-grams in fewer training paragraphs are no features
LEAST_SEEN = 4
#: training paragraphs made of each wording, and parts that wordings are judged in
VARIANTS, FOLDS = 20, 3
_SPDX = "spdx-license-identifier"
SEED = 5


def features(paragraph: str) -> set[str]:
    """Word n-grams with a licence term; British spelling counts as American."""
    return _features(_WORD.findall(paragraph.lower()))


def _features(words: list[str]) -> set[str]:
    words = [w.replace("licence", "license") for w in words]
    for i, w in enumerate(words):  # each identifier of "A OR B" has the tag
        if w == _SPDX:
            for j in range(i + 2, len(words) - 1, 2):
                if words[j] not in ("or", "and"):
                    break
                words[j] = _SPDX
            break
    is_term = [w in TERMS for w in words]
    found = {
        " ".join(words[i : i + n])
        for n in (1, 2, 3)
        for i in range(len(words) - n + 1)
        if any(is_term[i : i + n])
    }
    return found | set(marks(words)) if found else found


#: fixed values: the conditions of Creative Commons licences as they are written
_CONDITIONS = {
    "nc": "nc", "noncommercial": "nc", "commercial": "nc", "nd": "nd", "noderivatives": "nd", "noderivs": "nd", "derivatives": "nd",
    "derivs": "nd", "sa": "sa", "sharealike": "sa", "alike": "sa", "non": "", "no": "", "share": "", "by": "", "cc": "", "and": "",
}
_GNU = re.compile(r"(a|l)?gpl(?![a-z]{2})")
_DENIED, _EXCEPT = frozenset("licensed relicensed under".split()), frozenset("except unless only".split())
_NOT = "+not"


def marks(words: list[str]) -> Iterator[str]:
    """Marks of what a few words more or less turn into another licence: the
    conditions of a Creative Commons licence and the kind of a GNU licence, as
    "+" and the family's name; and that something is denied."""
    parts = [p for w in words for p in w.split("-")]
    i = 0
    while i < len(parts):
        begins = parts[i] == "attribution" or (parts[i] == "by" and i and parts[i - 1] == "cc")
        i += 1
        if begins:
            held = set()
            while i < len(parts) and parts[i] in _CONDITIONS:
                held.add(_CONDITIONS[parts[i]])
                i += 1
            yield "+" + "-".join(["cc-by", *(c for c in ("nc", "nd", "sa") if c in held)])
    for i, w in enumerate(words):
        if kind := _GNU.match(w):
            yield f"+{kind[1] or ''}gpl"
        elif w == "general" and i and words[i + 1 : i + 2] == ["public"]:
            yield {"lesser": "+lgpl", "library": "+lgpl", "affero": "+agpl"}.get(words[i - 1], "+gpl")
        elif w in ("not", "never", "longer", "neither"):
            near = words[i + 1 : i + 5]
            if not _DENIED.isdisjoint(near) and _EXCEPT.isdisjoint(near):
                yield _NOT


_TEMPLATE_FEATURES = {f: [features(t) for t in TEMPLATES[f]] for f in FAMILIES}


_FAMILY_FEATURES = {f: frozenset().union(*_TEMPLATE_FEATURES[f]) for f in FAMILIES}


#: families that only their own mark tells from each other
_MARKED = frozenset(f for f in FAMILIES if f.startswith("cc-by") or f.endswith("gpl"))


def covered(paragraph: set[str], family: str, named: frozenset[str] = frozenset()) -> float:
    """Largest part of a template's n-grams, those ``named`` aside, that the
    paragraph holds."""
    left = [t - named for t in _TEMPLATE_FEATURES[family]]
    return max((len(t & paragraph) / len(t) for t in left if t), default=0.0)


#: comment markers in front of a line's text that would be words
_MARKER = re.compile(r"[^a-z0-9]*(?:dnl|rem)(?=\s|$)")


def line_breaks(lines: list[str]) -> Iterator[tuple[int, int, list[str]]]:
    """The words around each break between two lines of a paragraph, and the
    first and last line that they come from."""
    words = [_WORD.findall(_MARKER.sub("", line)) for line in lines]
    for i in range(len(lines) - 1):
        if not words[i] or not words[i + 1]:
            continue
        first, before = i, words[i]
        while len(before) < AROUND and first and words[first - 1]:
            first -= 1
            before = words[first] + before
        last, after = i + 1, words[i + 1]
        while len(after) < AROUND and last + 1 < len(lines) and words[last + 1]:
            last += 1
            after = after + words[last]
        yield first, last, before[-AROUND:] + after[:AROUND]


class Classifier:
    """Softmax regression over the n-grams of its training paragraphs."""

    def __init__(self) -> None:
        rng = np.random.RandomState(SEED)
        filler = [f"{a}{b}" for a in "ba co du fe gi ho ju ka".split() for b in "ln rt st m nd".split()]

        def vary(text: str) -> str:
            words = text.split()
            if len(words) > 4:
                words = [w for w in words if w in TERMS or rng.rand() > 0.12]
            pick = lambda: rng.choice(filler, rng.randint(0, 9)).tolist()
            return " ".join(pick() + words + pick())

        classes = [*FAMILIES, UNKNOWN]
        rows = [(vary(t), c) for c, f in enumerate(FAMILIES) for t in TEMPLATES[f] for _ in range(VARIANTS)]
        rows += [(vary(t), len(FAMILIES)) for t in _OTHERS for _ in range(VARIANTS)]
        sets = [features(t) for t, _ in rows]
        seen = Counter(f for s in sets for f in s)
        self.index = {f: i for i, f in enumerate(sorted(f for f, n in seen.items() if n >= LEAST_SEEN))}
        x = np.zeros((len(rows), len(self.index) + 1), np.float32)
        x[:, -1] = 1
        for r, s in enumerate(sets):
            x[r, [self.index[f] for f in s if f in self.index]] = 1
        y = np.eye(len(classes), dtype=np.float32)[[c for _, c in rows]]
        # every wording is judged once by weights that never saw it
        wording = np.arange(len(rows)) // VARIANTS % FOLDS
        unseen = np.empty((len(rows), len(classes)), np.float32)
        for fold in range(FOLDS):
            unseen[wording == fold] = x[wording == fold] @ _fit(x[wording != fold], y[wording != fold])
        losses = {t: -np.log((_softmax(unseen / t) * y).sum(1) + 1e-9).mean() for t in np.geomspace(0.3, 5, 40)}
        self.temperature = min(losses, key=losses.get)
        # the least probability of any family that keeps 95 of 100 unseen unknowns unknown; the templates judge the rest
        self.unseen = _softmax(unseen / self.temperature), y
        wrong = 1 - self.unseen[0][y[:, -1] == 1, -1]
        self.least = float(np.clip(np.quantile(wrong, 0.95), 0.5, 0.9))
        self.weights = _fit(x, y)

    def classify(self, found: set[str], named: frozenset[str] = frozenset()) -> tuple[str, float]:
        """Family and probability of a paragraph's n-grams, template confirmed;
        n-grams ``named`` are those of families found before."""
        found = found - named
        known = [self.index[f] for f in found if f in self.index]
        z = self.weights[known].sum(0) + self.weights[-1]
        p = _softmax(z[None] / self.temperature)[0]
        if 1 - p[-1] >= self.least and _NOT not in found:
            for best in np.argsort(-p[:-1], kind="stable"):
                if p[best] < LEAST_SHARE:
                    break
                family = FAMILIES[best]
                told = family not in _MARKED or "+" + family in found
                if told and covered(found, family, named) >= COVERED:
                    return family, float(p[best])
        return UNKNOWN, float(p[-1])

    def families(self, found: set[str]) -> dict[str, float]:
        """Every family of a paragraph's n-grams, with its probability."""
        all_, named = {}, frozenset()
        while found - named:
            family, p = self.classify(found, named)
            if family == UNKNOWN:
                break
            all_[family] = p
            named |= _FAMILY_FEATURES[family]
        return all_


def _fit(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Weights after Adam on all rows at once."""
    w = np.zeros((x.shape[1], y.shape[1]), np.float32)
    m, v = np.zeros_like(w), np.zeros_like(w)
    for step in range(1, 201):
        g = x.T @ (_softmax(x @ w) - y) / len(x) + 1e-4 * w
        m += 0.1 * (g - m)
        v += 0.001 * (g * g - v)
        w -= 0.05 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    return w


def _softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(1, keepdims=True))
    return e / e.sum(1, keepdims=True)


_SCHEMA = "doc_id long, n_term_paragraphs long, n_licences long, families string, probability double"


def scan(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: lines with a licence term, lines and wrapped
    notices of a confirmed family, the families, and the largest probability
    among them."""
    spark = docs.sparkSession
    ship_package(spark)
    shared = spark.sparkContext.broadcast(Classifier())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, judged = shared.value, {}

        def families(words: list[str]) -> dict[str, float] | None:
            """None if there is no licence term."""
            name = frozenset(_features(words))
            if not name:
                return None
            if name not in judged:
                if len(judged) > 50_000:
                    judged.clear()
                judged[name] = model.families(name)
            return judged[name]

        for batch in batches:
            rows = []
            for value in batch.column(1):
                low = value.as_py().lower()
                n = n_hits = 0
                hits: dict[str, float] = {}
                if _ANY_TERM.search(low):
                    lines = low.split("\n")
                    terms = [bool(_ANY_TERM.search(line)) for line in lines]
                    ends: dict[str, int] = {}
                    of_line: list[dict[str, float]] = [{}] * len(lines)
                    for i, line in enumerate(lines):
                        found = families(_WORD.findall(line)) if terms[i] else None
                        if found is not None:
                            n += 1
                            of_line[i] = found
                            n_hits += bool(found)
                            for f, p in found.items():
                                hits[f] = max(p, hits.get(f, 0.0))
                    for first, last, words in line_breaks(lines):
                        if not any(terms[first : last + 1]):
                            continue
                        found = families(words) or {}
                        # of families that no line of these and no break before has named
                        new = [f for f in found if ends.get(f, -1) < first and not any(f in x for x in of_line[first : last + 1])]
                        n_hits += bool(new)
                        for f in found:
                            ends[f] = last
                        for f in new:
                            hits[f] = max(found[f], hits.get(f, 0.0))
                rows.append((n, n_hits, ",".join(sorted(hits)), max(hits.values(), default=0.0)))
            columns = list(zip(*rows)) if rows else [[]] * 4
            types = [pa.int64(), pa.int64(), pa.string(), pa.float64()]
            names = [c.split()[0] for c in _SCHEMA.split(", ")]
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c, t) for c, t in zip(columns, types))], names=names)

    rows = docs.select(F.col(key).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    return rows.mapInArrow(run, _SCHEMA)
