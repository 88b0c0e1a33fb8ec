"""License scan with a trained paragraph classifier.

A paragraph is the text between blank lines, however its lines are wrapped. Its features are one- and two-word n-grams in
lower case, those that several training paragraphs share, scaled by its length;
a softmax regression over the licence families and "none" judges them, for long
paragraphs in overlapping windows of ``WINDOWS`` words. It is trained on variants
of the families' statements and on a bounded sample of the starts of the corpus'
own lines as "none" (about ``NONE_SAMPLE``, at most twice as many).

The unknown class is calibrated on a third of the training data that the
regression does not see: its scores are divided by the temperature that makes
them most likely, and the least threshold is taken above which no paragraph of
"none" is found, ``MIN_THRESHOLD`` at least. Every family that is above it in a
window, against "none" alone (other families may be there too), is confirmed if
``CONFIRMED`` of the three-word n-grams of one of its statements stand close to
the window, within twice the statement's length and a window; words without a
letter or digit, as marks of comments, do not count. The place, with as many
words on either side as the statement has left, must have just the version and
the qualifiers of the statement ("lesser", "affero", "non-commercial", ...), or
a neighbour of the licence would pass for it, and must not follow a negation in
its sentence. Of places that overlap the fullest is kept, so a paragraph can
have any number of licences.

Null, empty and wordless texts have no licence. Any length of text is judged
whole, every row by itself; other columns are ignored.
"""

from __future__ import annotations

import random
import re
from bisect import bisect_left
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docketflow.llm.common import WORD, hashes, runs_of, slices, window_hashes, words

MIN_SHARED = 8
NONE_SAMPLE = 2_000
NONE_CHARS = 1_000
VARIANTS = 60
EPOCHS = 200
MIN_THRESHOLD = 0.6
CONFIRMED = 0.6
WINDOW = 24
# A short statement is lost in a wide window of other text.
WINDOWS = (WINDOW, 10)
# Windows whose n-grams are weighed at once.
STEP = 2_048
SEED = 7
NONE = "none"

# The usual statements of each family.
STATEMENTS: dict[str, tuple[str, ...]] = {
    "AGPL-3.0": (
        "This work is licensed under the GNU Affero General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of"
        " the GNU Affero General Public License as published by the Free Software Foundation, either"
        " version 3 of the License, or (at your option) any later version.",
    ),
    "Apache-1.1": (
        "Licensed under the Apache License, Version 1.1.",
        "Licensed under the Apache Software License, Version 1.1.",
    ),
    "Apache-2.0": (
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file"
        " except in compliance with the License.",
    ),
    "Artistic-2.0": (
        "Licensed under the Artistic License 2.0.",
        "This program is distributed under the terms of the Artistic License, version 2.0.",
    ),
    "BSD": (
        "Released under the BSD License.",
        "Use of this source code is governed by a BSD-style license.",
        "Redistribution and use in source and binary forms, with or without modification, are"
        " permitted provided that the following conditions are met.",
    ),
    "BSL-1.0": (
        "Distributed under the Boost Software License, Version 1.0.",
    ),
    **{
        f"CC-{code}-{version}": (
            f"Licensed under CC {code} {version}.",
            f"This work is licensed under a Creative Commons {name} {version} {scope} License.",
        )
        for version, scope in (("4.0", "International"), ("3.0", "Unported"))
        for code, name in (
            ("BY", "Attribution"),
            ("BY-NC", "Attribution-NonCommercial"),
            ("BY-NC-ND", "Attribution-NonCommercial-NoDerivatives"),
            ("BY-NC-SA", "Attribution-NonCommercial-ShareAlike"),
            ("BY-ND", "Attribution-NoDerivatives"),
            ("BY-SA", "Attribution-ShareAlike"),
        )
    },
    "CC0-1.0": (
        "Dedicated to the public domain under CC0 1.0.",
        "To the extent possible under law, the author has waived all copyright and related rights"
        " to this work.",
    ),
    "EPL-2.0": (
        "Licensed under the Eclipse Public License 2.0.",
        "This program and the accompanying materials are made available under the terms of the"
        " Eclipse Public License v. 2.0.",
    ),
    "EUPL-1.2": (
        "Licensed under the EUPL, Version 1.2.",
        "Licensed under the European Union Public Licence, version 1.2.",
    ),
    **{
        f"GPL-{n}.0": (
            f"This work is licensed under the GNU General Public License, version {n}.",
            "This program is free software: you can redistribute it and/or modify it under the terms"
            " of the GNU General Public License as published by the Free Software Foundation, either"
            f" version {n} of the License, or (at your option) any later version.",
        )
        for n in (2, 3)
    },
    "ISC": (
        "Released under the ISC License.",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or"
        " without fee is hereby granted, provided that the above copyright notice and this"
        " permission notice appear in all copies.",
    ),
    **{
        f"LGPL-{version}": (
            f"This library is licensed under the GNU Lesser General Public License, version {version}.",
            "This library is free software; you can redistribute it and/or modify it under the terms"
            " of the GNU Lesser General Public License as published by the Free Software Foundation,"
            f" either version {version} of the License, or (at your option) any later version.",
        )
        for version in ("2.1", "3")
    },
    "MIT": (
        "Released under the MIT License.",
        "Licensed under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this"
        " software and associated documentation files, to deal in the Software without restriction.",
    ),
    "MPL-1.1": (
        "Licensed under the Mozilla Public License 1.1.",
        "The contents of this file are subject to the Mozilla Public License Version 1.1.",
    ),
    "MPL-2.0": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
        "Licensed under the Mozilla Public License 2.0.",
    ),
    "OFL-1.1": (
        "This Font Software is licensed under the SIL Open Font License, Version 1.1.",
    ),
    "Unlicense": (
        "Released under the Unlicense.",
        "This is free and unencumbered software released into the public domain.",
    ),
    "Zlib": (
        "Released under the zlib License.",
        "Permission is granted to anyone to use this software for any purpose, including commercial"
        " applications, and to alter it and redistribute it freely.",
    ),
}
# Words that tell a licence from its neighbours, and what says the same.
QUALIFIERS = {
    "affero": "affero", "lesser": "lesser", "nc": "nc", "noncommercial": "nc", "commercial": "nc",
    "nd": "nd", "noderivatives": "nd", "noderivs": "nd", "derivatives": "nd", "derivs": "nd",
    "sa": "sa", "sharealike": "sa", "alike": "sa",
}
# Words that deny what follows them in the sentence.
NEGATIONS = frozenset((
    "not", "never", "neither", "nor", "isn't", "wasn't", "aren't", "weren't", "cannot", "can't",
    "without", "non",
))
# So many words before a place can deny it.
DENIED = 5
# Paragraphs that speak of licences without granting one.
NOT_GRANTED = (
    "A driving license is required to drive a car in this country.",
    "The license fee was raised by the public broadcaster this year.",
    "He held a license to sell wine and spirits in the city.",
    "All rights reserved. No part of this work may be reproduced without permission.",
    "The software may only be used under the terms of a signed agreement.",
    "The general public was invited to the opening of the free library.",
    "Version 2.0 of the program was released under great secrecy.",
)


@dataclass(frozen=True)
class Model:
    families: tuple[str, ...]  # "none" is the last
    ngrams: np.ndarray  # hashes in ascending order
    weights: np.ndarray  # n-grams x families
    bias: np.ndarray
    temperature: float
    threshold: float


def _normal(values: pa.Array) -> pa.Array:
    """Words without the punctuation around them, a hyphen inside kept."""
    return pc.utf8_trim(values, ".,;:!?()[]{}\"'*_`|<>")


def ngrams(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Hash of each one- and two-word n-gram, its paragraph, its place in words, words of each."""
    dictionary, codes, bounds = words(pc.ascii_lower(pc.fill_null(texts, "")))
    hashed = hashes(_normal(dictionary))[codes]
    sizes = np.diff(bounds)
    owner = np.repeat(np.arange(len(sizes)), sizes)
    place = np.arange(len(codes)) - bounds[:-1][owner]
    inside = owner[:-1] == owner[1:]
    second = window_hashes(hashed, 2)[inside]
    return (
        np.concatenate([hashed, second]),
        np.concatenate([owner, owner[:-1][inside]]),
        np.concatenate([place, place[:-1][inside]]),
        sizes,
    )


def known(found: np.ndarray, vocabulary: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which n-grams the vocabulary has, and their numbers in it."""
    at = np.minimum(np.searchsorted(vocabulary, found), len(vocabulary) - 1)
    there = np.flatnonzero(vocabulary[at] == found)
    return there, at[there]


def rows_of(texts: Sequence[str], vocabulary: np.ndarray) -> np.ndarray:
    """A few paragraphs as rows, scaled by the length that all their n-grams have."""
    found, owner, _, sizes = ngrams(pa.array(texts, pa.string()))
    there, number = known(found, vocabulary)
    x = np.zeros((len(texts), len(vocabulary)), np.float32)
    np.add.at(x, (owner[there], number), 1)
    return x / np.sqrt(np.maximum(2 * sizes - 1, 1))[:, None].astype(np.float32)


def variants(statement: str, fillers: Sequence[str], n: int, rng: random.Random) -> list[str]:
    """The statement with words dropped or replaced at the ends, and words of the corpus around."""
    own = statement.split()
    made = [statement]
    while len(made) < n:
        changed = [w for w in own if rng.random() > 0.04]
        before = rng.choices(fillers, k=rng.choice((0, 0, 0, 2, 5)))
        after = rng.choices(fillers, k=rng.choice((0, 0, 0, 2, 5)))
        text = " ".join([*before, *changed, *after])
        made.append(text.upper() if rng.random() < 0.05 else text)
    return made


def softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def train(none: Sequence[str], seed: int = SEED) -> tuple[Model, float]:
    """A model, and its accuracy on the third it was not fitted to."""
    rng = random.Random(seed)
    families = (*STATEMENTS, NONE)
    fillers = [w for text in none for w in text.split()[:20]] or ["text"]
    texts, labels = [], []
    for k, family in enumerate(families[:-1]):
        for statement in STATEMENTS[family]:
            made = variants(statement, fillers, VARIANTS, rng)
            texts += made
            labels += [k] * len(made)
    others = [" ".join(text.split()[:WINDOW]) for text in none]
    others += [x for text in NOT_GRANTED for x in variants(text, fillers, 10, rng)]
    texts += others
    labels += [len(families) - 1] * len(others)
    found, owner, *_ = ngrams(pa.array(texts, pa.string()))
    # N-grams that several paragraphs share; names and other rare words say nothing.
    pairs = np.unique(np.stack([found, owner.astype(np.uint64)]), axis=1)
    vocabulary, shared = np.unique(pairs[0], return_counts=True)
    vocabulary = vocabulary[shared >= MIN_SHARED]
    order = list(range(len(texts)))
    rng.shuffle(order)
    x = rows_of([texts[k] for k in order], vocabulary)
    y = np.eye(len(families), dtype=np.float32)[[labels[k] for k in order]]
    cut = len(order) * 2 // 3
    fitted, target = x[:cut], y[:cut]
    w = np.zeros((len(vocabulary), len(families)), np.float32)
    b = np.zeros(len(families), np.float32)
    # Families weigh the same, or "none" would win by its number.
    share = (1 / np.maximum(target.sum(axis=0), 1))[target.argmax(axis=1)][:, None]
    share /= share.mean()
    for epoch in range(EPOCHS):
        error = (softmax(fitted @ w + b) - target) * share / len(target)
        rate = 40.0 if epoch < EPOCHS // 2 else 15.0
        w -= rate * (fitted.T @ error + 1e-6 * w)
        b -= rate * 0.05 * error.sum(axis=0)
    logits, truth = x[cut:] @ w + b, y[cut:].argmax(axis=1)
    at = np.arange(len(truth))
    temperature = min(
        np.geomspace(0.2, 5, 25),
        key=lambda t: -np.log(softmax(logits / t)[at, truth] + 1e-12).mean(),
    )
    p = softmax(logits / temperature)
    none_class = len(families) - 1
    # Of "none", the best licence family at most; a little above it is surely one.
    highest = p[truth == none_class, :none_class].max(initial=0.0)
    threshold = float(np.clip(highest + 0.01, MIN_THRESHOLD, 0.95))
    accuracy = float((p.argmax(axis=1) == truth).mean())
    return Model(families, vocabulary, w, b, float(temperature), threshold), accuracy


def none_sample(docs: DataFrame, text: str, n: int = NONE_SAMPLE) -> list[str]:
    """About ``n`` distinct starts of lines that do not speak of licences, the same on every run.

    A start has the words of a window, which is what the scan judges, and at most
    ``NONE_CHARS`` characters, so one endless line costs the driver no more than another.
    """
    lines = docs.select(F.explode(F.split(text, "\n")).alias("line")).filter(F.col("line").rlike(WORD))
    total = docs.agg(F.sum(F.size(F.split(text, "\n")))).first()[0] or 1
    # Equal lines have equal hashes, so a share of the hashes is a share of the distinct lines.
    least = min(2**63 - 1, 2**63 * 2 * n // total)
    drawn = F.xxhash64("line").bitwiseAND(F.lit(2**63 - 1)) <= F.lit(least)
    start = F.substring(F.ltrim("line"), 1, NONE_CHARS)
    start = F.regexp_extract(start, rf"(?:{WORD}[\x20\x09-\x0D]*){{1,{WINDOW}}}", 0).alias("line")
    rows = lines.filter(drawn & ~F.col("line").rlike("(?i)licen[cs]")).select(start).distinct().collect()
    return sorted(r["line"] for r in rows)[: 2 * n]


_BLANK = r"\n(?:[ \t\x0b\x0c\r]*\n)+"
_AROUND = ".,;:!?()[]{}\"'*_`|<>"


_ENDS = re.compile(r"[.;!?][\"')\]}*_`|<>]*$")
_VERSION = re.compile(r"v?(\d{1,2}(?:\.\d+)*)\+?")


def _read(text: str) -> tuple[list[str], np.ndarray, np.ndarray, list[bool]]:
    """Normal words with a letter or digit, the line and the place of each, and if a sentence ends."""
    words_, line_of, place_of, ends = [], [], [], []
    place = 0
    for k, line in enumerate(text.encode().split(b"\n")):
        for word in line.split():
            raw = word.decode()
            own = raw.lower().strip(_AROUND)
            if any(map(str.isalnum, own)):
                words_.append(own)
                line_of.append(k)
                place_of.append(place)
                ends.append(bool(_ENDS.search(raw)))
            place += 1
    return words_, np.array(line_of, int), np.array(place_of, int), ends


def marked(own: Sequence[str]) -> tuple[list[int], list[str]]:
    """Where versions and qualifiers stand among normal words, and which; ``2.0`` is version 2."""
    parts = [(k, x) for k, word in enumerate(own) for x in re.split(r"[-/,(]", word)]
    where, which = [], []
    for (k, part), (_, after) in zip(parts, [*parts[1:], (0, "")]):
        mark = QUALIFIERS.get(part)
        if part == "library" and after == "general":  # the former name of "lesser"
            mark = "library"
        elif (version := _VERSION.fullmatch(part)) and after != "clause":
            mark = re.sub(r"(\.0)+$", "", version[1])
        if mark:
            where.append(k)
            which.append(mark)
    return where, which


def denied(own: Sequence[str], ends: Sequence[bool], first: int) -> bool:
    """Whether a negation stands shortly before a word, in its sentence."""
    for k in range(first - 1, max(-1, first - 1 - DENIED), -1):
        if ends[k]:
            return False
        if own[k] in NEGATIONS:
            return True
    return False


def _trigrams(own: Sequence[str]) -> list[tuple[str, ...]]:
    return list(zip(own, own[1:], own[2:]))


@dataclass(frozen=True)
class _Statement:
    at: dict[tuple[str, ...], int]  # each three-word n-gram, where it first stands
    length: int
    marks: frozenset[str]


def _statement(text: str) -> _Statement:
    own = _read(text)[0]
    marks = frozenset(marked(own)[1])
    at: dict[tuple[str, ...], int] = {}
    for k, trigram in enumerate(_trigrams(own)):
        at.setdefault(trigram, k)
    return _Statement(at, len(own), marks)


_OWN = {family: [_statement(x) for x in statements] for family, statements in STATEMENTS.items()}


def places(
    family: str, own: Sequence[str], ends: Sequence[bool], trigrams: Sequence[tuple[str, ...]],
    marks: tuple[list[int], list[str]],
) -> list[tuple[float, int, int]]:
    """``(fit, first, last)``: words that hold enough of one of the family's statements.

    The fit is the share of the statement, less by what stands between its parts.
    """
    found = []
    where, which = marks
    for statement in _OWN[family]:
        n = len(statement.at)
        reach = 2 * (n + 2) + WINDOW
        at = [k for k, x in enumerate(trigrams) if x in statement.at]
        for start in range(len(at)):
            seen: set[tuple[str, ...]] = set()
            best = None
            before = max(0, at[start] - statement.at[trigrams[at[start]]])
            # On to the last trigram that is new; a repeat after enough is the next statement.
            for k in range(start, len(at)):
                if at[k] - at[start] > reach:
                    break
                trigram = trigrams[at[k]]
                if trigram in seen:
                    if len(seen) >= CONFIRMED * n:
                        break
                    continue
                seen.add(trigram)
                if len(seen) >= CONFIRMED * n:
                    left = statement.length - 3 - statement.at[trigram]
                    inside = slice(bisect_left(where, before), bisect_left(where, at[k] + 3 + left))
                    if set(which[inside]) == statement.marks:
                        best = (len(seen) / max(n, at[k] - at[start] + 1), at[start], at[k] + 2)
            if best and not denied(own, ends, at[start]):
                found.append(best)
    return found


def _licences(
    paragraph: str, windows: Sequence[tuple[int, int, str, float]]
) -> list[tuple[int, int, int, int, str, float]]:
    """``(first word, last word, first line, last line, family, probability)`` of windows ``(place, width, family, chance)``."""
    own, line_of, place_of, ends = _read(paragraph)
    trigrams, marks = _trigrams(own), marked(own)
    asked: dict[str, dict[tuple[int, int], float]] = {}
    for start, width, family, chance in windows:
        asked.setdefault(family, {})[width, start] = chance
    candidates = []
    for family in sorted(asked):
        for fit, first, last in places(family, own, ends, trigrams, marks):
            low, high = int(place_of[first]), int(place_of[last])
            chances = [
                asked[family][width, start]
                for width in WINDOWS
                for start in range(max(0, low - width + 1 + -(low - width + 1) % (width // 2)), high + 1, width // 2)
                if (width, start) in asked[family]
            ]
            if chances:
                candidates.append((fit, last - first, max(chances), first, last, family))
    kept: list[list] = []  # in order of their places, which share a word at most
    for candidate in sorted(candidates, key=lambda x: (*(-y for y in x[:3]), *x[3:])):
        fit, _, chance, first, last, family = candidate
        at = bisect_left(kept, first, key=lambda x: x[0])
        met = [x for x in kept[max(0, at - 1) : at] if x[1] > first]
        while at < len(kept) and kept[at][0] < last:
            met.append(kept[at])
            at += 1
        if not met:
            kept.insert(at, [first, last, chance, family])
        elif fit >= CONFIRMED and len(met) == 1 and met[0][3] == family:
            met[0][:2] = min(first, met[0][0]), max(last, met[0][1])  # a longer form of it
    return [
        (
            int(place_of[first]), int(place_of[last]), int(line_of[first]), int(line_of[last]),
            family, chance,
        )
        for first, last, chance, family in kept
    ]


def _without(paragraph: str, spans: Sequence[tuple[int, int]]) -> str:
    """The paragraph with a word that says nothing for each word of the spans."""
    taken = {place for first, last in spans for place in range(first, last + 1)}
    place, lines = 0, []
    for line in paragraph.encode().split(b"\n"):
        own = line.split()
        lines.append(b" ".join(b"x0x" if place + k in taken else x for k, x in enumerate(own)))
        place += len(own)
    return b"\n".join(lines).decode()


def _windows(
    known_ngrams: tuple[np.ndarray, ...], sizes: np.ndarray, model: Model, width: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Paragraph, place and probabilities of each window that has a known n-gram."""
    number, owner, place = known_ngrams
    # Windows overlap by half, so every statement of half a window lies in one of them.
    half = width // 2
    spans = np.maximum(1, -(-(sizes - half) // half))
    base = np.cumsum(spans) - spans
    own = np.minimum(place // half, spans[owner] - 1)
    windows = np.concatenate([base[owner] + own, base[owner] + own - 1])
    inside = np.concatenate([np.ones(len(own), bool), (own > 0) & (place < (own + 1) * half)])
    windows, number = windows[inside], np.concatenate([number, number])[inside]
    if not len(windows):
        return windows, windows, np.zeros((0, len(model.families)))
    order = np.argsort(windows, kind="stable")
    windows, number = windows[order], number[order]
    first, _ = runs_of(windows)
    asked = windows[first]
    # A row of weights for each n-gram, so only some runs of windows at once.
    logits = np.empty((len(asked), len(model.families)))
    for low in range(0, len(asked), STEP):
        part = first[low : low + STEP]
        end = first[low + STEP] if low + STEP < len(first) else len(number)
        rows = model.weights[number[part[0] : end]]
        logits[low : low + STEP] = np.add.reduceat(rows, part - part[0], axis=0, dtype=np.float64)
    paragraph = np.searchsorted(base, asked, side="right") - 1
    start = (asked - base[paragraph]) * half
    length = np.clip(sizes[paragraph] - start, 1, width)
    logits = logits / np.sqrt(2 * length - 1)[:, None] + model.bias
    return paragraph, start, softmax(logits / model.temperature)


def judge(paragraphs: pa.Array, model: Model) -> list[tuple[int, int, int, str, float]]:
    """``(paragraph, first line in it, last line, family, probability)`` of every licence.

    What is left of a paragraph beside its licences is judged again until nothing
    is found, for a clear licence can outweigh its neighbour.
    """
    found: dict[int, list[tuple[int, int, int, int, str, float]]] = {}
    numbers, texts = range(len(paragraphs)), paragraphs
    while more := _judged(texts, model):
        for k, own in more.items():
            found.setdefault(numbers[k], []).extend(own)
        left = [_without(texts[k].as_py(), [x[:2] for x in own]) for k, own in more.items()]
        numbers, texts = [numbers[k] for k in more], pa.array(left, pa.string())
    return [(k, *licence[2:]) for k in sorted(found) for licence in sorted(found[k])]


def _judged(
    paragraphs: pa.Array, model: Model
) -> dict[int, list[tuple[int, int, int, int, str, float]]]:
    """The licences that one pass finds in each paragraph that has any."""
    found, owner, place, sizes = ngrams(paragraphs)
    if not len(found):
        return {}
    there, number = known(found, model.ngrams)
    none = len(model.families) - 1
    above: dict[int, list[tuple[int, int, str, float]]] = {}
    for width in WINDOWS:
        paragraph, start, p = _windows((number, owner[there], place[there]), sizes, model, width)
        # Against "none" alone: families that meet in a window take chance from each other.
        alone = p[:, :none] / (p[:, :none] + p[:, none:])
        for window, family in zip(*np.nonzero(alone >= model.threshold)):
            above.setdefault(int(paragraph[window]), []).append(
                (int(start[window]), width, model.families[family], float(p[window, family]))
            )
    licences = {k: _licences(paragraphs[k].as_py(), own) for k, own in above.items()}
    return {k: own for k, own in licences.items() if own}


def _scan(batches: Iterator[pa.RecordBatch], model: Model) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, "text"):
        texts = pc.fill_null(batch.column("text"), "")
        blocks = pc.split_pattern_regex(texts, _BLANK)
        document = pc.list_parent_indices(blocks).to_numpy(zero_copy_only=False)
        start = np.searchsorted(document, np.arange(batch.num_rows))
        found: list[list[dict]] = [[] for _ in range(batch.num_rows)]
        line_at: dict[int, list[int]] = {}
        for block, first, last, family, chance in judge(blocks.flatten(), model):
            at = int(document[block])
            if at not in line_at:
                text = texts[at].as_py()
                ends = [x.end() for x in re.finditer(_BLANK, text)]
                breaks = [text.count("\n", a, b) for a, b in zip([0, *ends], ends)]
                line_at[at] = [0, *np.cumsum(breaks, dtype=int).tolist()]
            line = line_at[at][int(block - start[at])]
            found[at].append(
                {
                    "paragraph": line + first, "last": line + last,
                    "family": family, "probability": chance,
                }
            )
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(found, _FOUND)], ["doc_id", "licenses"]
        )


_FOUND = pa.list_(
    pa.struct(
        [
            ("paragraph", pa.int32()), ("last", pa.int32()),
            ("family", pa.string()), ("probability", pa.float64()),
        ]
    )
)


def scan(
    docs: DataFrame, model: Model | None = None, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """``(doc_id, licenses)``: the licences of each document.

    ``licenses`` is an array of ``(paragraph, last, family, probability)``, the
    first and the last line of each, counted from 0. Without a model one is trained on the documents' own sample.
    """
    if model is None:
        model, _ = train(none_sample(docs, text))
    narrow = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    kind = narrow.schema["doc_id"].dataType.simpleString()
    return narrow.mapInArrow(
        partial(_scan, model=model),
        f"doc_id {kind},"
        " licenses array<struct<paragraph:int,last:int,family:string,probability:double>>",
    )
