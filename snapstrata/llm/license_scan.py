"""License scans: a trained paragraph classifier, confirmed against templates.

A paragraph is a run of lines that hold words; one of more than ``window`` words is read in windows that
overlap by half and run over line breaks, so that a notice inside it, wrapped or not, is seen whole.  A finding
has the line of its first word; n_paragraphs counts lines with words.  Windows are classified
by a multinomial logistic regression over sparse word n-grams (one to three words) into
license families, ``unknown`` (speaks of a license, of no known family) and none.  It is
trained here: families on their notices and names in common wordings, unknown on made-up names and on other
licenses, none on everyday uses of the words and on windows of background paragraphs (a documented, bounded sample of the
scanned table; the window's place in its paragraph is drawn by a hash).  The temperatures (of none against licenses, and among licenses) are
fitted on what models trained without it say of it: a quarter of the families, which must then be unknown, and a
quarter of the wordings, four times in turn.

Every family is reported, several in a window if so, that a template confirms where the words of its
run make the family (or its kin, from which the template tells it) likelier than others; a notice must also win against unknown, which
a name that is there word for word rules out.  A name (with its version, or the parts of a Creative Commons name) must
be there word for word and must not go on as another license's name does; a notice must hold its telling
phrases and most of its word pairs, in a run of at most twice its length.  A name without a version is a family of its own.
What the classifier still takes for a license without the words of such runs is reported as ``unknown``.

Null and empty texts have no findings.  Repeated rows each have their own.  The scan itself
reads every line whole.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from snapstrata.llm.shared import Shipped
from snapstrata.llm.texts import as_large_strings, letters_and_digits, pieces, split_words

NONE, UNKNOWN = "none", "unknown"
WINDOW = 80
#: bounds of the training sample: texts that background lines are taken from, and lines
SAMPLE_TEXTS = 2000
SAMPLE_LINES = 3000
#: lines without words part paragraphs
PARAGRAPH_END = r"\n[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]*\n"
MIN_PROBABILITY = 0.6
MIN_CONTAINED = 0.6
#: words without a known n-gram that part two unknown notices
GAP = 8
#: an n-gram in more than this share of background lines says nothing about licenses
COMMON = 0.05
#: more than any word number, so that n-grams have keys of their own
BASE = 1 << 20

# ---- fixed values: license families, their notices and names, and the wordings they come in ----
#: family, notice, and the phrases that must be in it word for word
NOTICES = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0; you may not use this file except in compliance with the License. You may obtain a copy of the License.", ("apache license version 2 0",)),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files, to deal in the Software without restriction.", ("permission is hereby granted free of charge",)),
    ("MIT", "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.", ("copies or substantial portions of the software",)),
    ("BSD", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met.", ("redistribution and use in source and binary forms",)),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.", ("mozilla public license v 2",)),
    ("CC0", "To the extent possible under law, the author has waived all copyright and related rights to this work under CC0 1.0.", ("cc0",)),
    ("Unlicense", "This is free and unencumbered software released into the public domain.", ("free and unencumbered software",)),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.", ("with or without fee",)),
    ("all-rights-reserved", "No part of this publication may be reproduced or transmitted in any form without written permission.", ("no part of this publication may be reproduced",)),
)
#: families by their versions: name, full name, short name, versions
VERSIONED = (
    ("GPL", "GNU General Public License", "GPL", ("2.0", "3.0")),
    ("LGPL", "GNU Lesser General Public License", "LGPL", ("2.1", "3.0")),
    ("AGPL", "GNU Affero General Public License", "AGPL", ("3.0",)),
    ("MPL", "Mozilla Public License", "MPL", ("1.1", "2.0")),
    ("EPL", "Eclipse Public License", "EPL", ("1.0", "2.0")),
    ("Apache", "Apache License", "Apache", ("1.1", "2.0")),
)
GNU_NOTICE = "This program is free software: you can redistribute it and/or modify it under the terms of the {} as published by the Free Software Foundation, either version {} of the License, or any later version."
#: other families by their names
NAMED = (
    ("MIT", ("MIT License", "License: MIT", "License-Identifier: MIT")),
    ("ISC", ("ISC License", "License: ISC", "License-Identifier: ISC")),
    ("BSD-2-Clause", ("BSD 2-Clause", "2-Clause BSD", "Simplified BSD", "FreeBSD License")),
    ("BSD-3-Clause", ("BSD 3-Clause", "3-Clause BSD", "New BSD", "Modified BSD")),
    ("BSD", ("BSD License",)),
    ("BSL-1.0", ("Boost Software License", "BSL 1.0")),
    ("CC0", ("CC0", "CC Zero", "Creative Commons Zero")),
    ("Unlicense", ("Unlicense",)),
    ("all-rights-reserved", ("All rights reserved",)),
)
#: what Creative Commons names are made of: parts, short and long
COMMONS = (("BY",), ("BY", "SA"), ("BY", "NC"), ("BY", "ND"), ("BY", "NC", "SA"), ("BY", "NC", "ND"))
COMMONS_WORDS = {"BY": "Attribution", "SA": "ShareAlike", "NC": "NonCommercial", "ND": "NoDerivatives"}
#: families that share most of their words
KINDRED = (("GPL", "LGPL", "AGPL"), ("CC", "CC0"))
#: words after a name that make it another license's
FURTHER_PARTS = ("sa", "nc", "nd", "sharealike", "noncommercial", "noderivatives", "noderivs", "share", "non", "no")
VERSION_WORDS = ("version", "versions", "v", "v1", "v2", "v3", "v4", "1", "2", "3", "4", "5")
#: wordings that names come in; an empty one is the bare name
WORDINGS = (
    "Licensed under the {}.", "Released under the {}.", "This work is licensed under the {}.", "Distributed under the terms of the {}.",
    "SPDX-License-Identifier: {}", "License: {}", "Copyright 2020 by the author. {}.", "Covered by the {}.",
    "The code is available under the {} license.", "Published under {} international license.", "This file is subject to the {}.", "{}",
)
#: words that lead to a name and words that follow it, which belong to the finding
LEADS = (
    "licensed", "released", "distributed", "published", "covered", "available", "subject", "dual", "provided", "under", "by", "to", "the", "a", "terms",
    "of", "this", "work", "file", "code", "software", "program", "project", "library", "package", "sources", "text", "data", "made", "into", "public", "domain", "is", "are", "spdx", "license", "licence", "identifier", "conditions", "and",
)
TAILS = ("license", "licence", "version", "v", "or", "any", "later", "only", "international", "unported", "generic", "0", "1", "2", "3", "4", "5")
#: wordings of licenses of no known family, for made-up names
SENTENCES = (
    "Licensed under the {} License.",
    "Released under the {} License, version 2.",
    "This work is licensed under the {} terms.",
    "Distributed under the {} Public License.",
    "Use of this text is subject to the {} license agreement.",
    "SPDX-License-Identifier: {}",
    "Covered by the {} License.",
    "License: {}",
)
OTHER_LICENSES = (
    "zlib", "Artistic", "Python Software Foundation", "Open Software", "Microsoft Public", "SIL Open Font", "Academic Free", "European Union Public",
    "Common Development and Distribution", "Beerware", "Server Side Public", "Business Source", "Elastic", "PostgreSQL", "OpenSSL", "Ruby", "Perl",
)
#: everyday uses of the same words
EVERYDAY = (
    "She renewed her driving license last week.", "The bar lost its liquor license under the new rules of the council.",
    "He is a licensed nurse and works at the public hospital.", "The car had no license plate.", "That is poetic license.",
    "A fishing license is required by law in this state.", "The minister spoke of the redistribution of wealth.", "Permission to land was granted by the tower.",
    "The software is available in two versions.", "The work is subject to change without notice.", "The general public is invited to this free event.",
    "The new version of the program was released to the public.", "Copies of the report were distributed to all members.",
    "The rights of all citizens are protected by law.", "The street vendor needs a license from the city under the terms of the act.",
    "Students at MIT built a robot.", "The Apache people lived in the south.", "The mozilla was a name for a lizard.", "An attribution error is a common mistake.",
    "The license fee of the broadcaster was raised.", "A license agreement between the two teams was signed under the old contract.",
    "All seats are reserved.", "The commons voted on the creative industries.", "The council may grant a license to any person of good character.",
)
EVERYDAY_KINDS = ("fishing", "pilot", "dog", "trade", "export", "gun", "radio", "taxi", "medical", "mining")
EVERYDAY_ENDS = (
    "license was renewed in the spring", "license costs more this year", "license plate is missing", "license fee rose again", "license expired last month",
    "license is required by law", "license was refused by the county", "license after the trial", "license with the facts", "license for this work",
)
# ---- end of fixed values ----


@dataclass(frozen=True)
class Template:
    """A name, to be found word for word, or a notice, by word pairs and telling phrases."""

    family: str
    text: str
    tells: tuple[str, ...]
    exact: bool
    not_next: tuple[str, ...] = ()


def _named() -> Iterator[Template]:
    for family, names in NAMED:
        for name in names:
            yield Template(family, name, (), True, ("0", "style") if name.endswith(": MIT") else ())
    for parts in COMMONS:
        long = "Creative Commons " + " ".join(COMMONS_WORDS[p] for p in parts)
        for name in ("CC " + "-".join(parts), long):
            yield Template("-".join(("CC", *parts)), name, (), True, FURTHER_PARTS)
    for family, long, short, versions in VERSIONED:
        # the short name may stand behind the long one
        names = [long, f"{long} {short}", *([f"GNU {short}"] if long.startswith("GNU") else []), *([short] if short != long.split()[0] else [])]
        for name in names:
            yield Template(family, name, (), True, (*VERSION_WORDS, short.lower()))
        for version in versions:
            forms = [version, *([version[:-2]] if version.endswith(".0") else [])]
            for name in dict.fromkeys([*names, short]):
                for form in forms:
                    for between in (" version ", " v. ", " v", " "):
                        yield Template(f"{family}-{version}", f"{name}{between}{form}", (), True)
            for form in forms:
                yield Template(f"{family}-{version}", f"{short}v{form}", (), True)


def _templates() -> Iterator[Template]:
    for family, text, tells in NOTICES:
        yield Template(family, text, tells, False)
    for family, long, _, versions in VERSIONED[:3]:
        for version in versions:
            form = version.removesuffix(".0")
            tells = (long.lower(), f"version {form.replace('.', ' ')} of the license")
            yield Template(f"{family}-{version}", GNU_NOTICE.format(long, form), tells, False)
    for name in _named():
        yield name
        if "License" in name.text:
            yield replace(name, text=name.text.replace("License", "Licence"))


CATALOGUE = tuple(dict.fromkeys(_templates()))


def worded(catalogue: Iterable[Template]) -> list[tuple[str, str]]:
    """Families and sentences: the notices, and each family's first name in the first wording."""
    first = {t.family: t for t in reversed(list(catalogue)) if t.exact}
    wording = {f: "{}." if f == "all-rights-reserved" else WORDINGS[0] for f in first}
    return [*((t.family, t.text) for t in catalogue if not t.exact), *((f, wording[f].format(t.text)) for f, t in sorted(first.items()))]


TEMPLATES = tuple(worded(CATALOGUE))


@dataclass(frozen=True)
class Numbered:
    """A template's words, distinct word pairs and telling phrases as word numbers."""

    family: str
    exact: bool
    words: np.ndarray
    pairs: np.ndarray
    tells: tuple[np.ndarray, ...]
    not_next: np.ndarray


@dataclass(frozen=True)
class LicenseModel:
    classes: list[str]
    vocabulary: list[str]
    #: sorted keys of n-grams, word numbers from the last word up, and weights by class
    keys: np.ndarray
    weights: np.ndarray
    bias: np.ndarray
    #: of none against licenses, and among licenses
    temperatures: tuple[float, float]
    window: int
    #: templates with their words as numbers
    templates: list[Numbered]
    #: numbers of words that lead to a name, and that follow it
    leads: np.ndarray
    tails: np.ndarray


def tokens(texts: list[str]) -> list[list[str]]:
    words, ends = split_words(pa.array(texts, pa.large_string()), letters_and_digits())
    spoken = words.to_pylist()
    return [spoken[x:y] for x, y in zip(ends[:-1].tolist(), ends[1:].tolist())]


def ngram_keys(ids: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Keys of all n-grams of known words (above 0) inside each unit, and the place of each one's last word."""
    first = np.repeat(ends[:-1], np.diff(ends))
    at = np.arange(len(ids))
    base = np.int64(BASE)
    one = np.flatnonzero(ids > 0)
    two = one[(at[one] - 1 >= first[one])]
    two = two[ids[two - 1] > 0]
    three = two[(at[two] - 2 >= first[two])]
    three = three[ids[three - 2] > 0]
    keys = [ids[one], ids[two - 1] * base + ids[two], (ids[three - 2] * base + ids[three - 1]) * base + ids[three]]
    return np.concatenate(keys), np.concatenate([one, two, three])


def _numbers(units: list[list[str]], number: dict[str, int]) -> tuple[np.ndarray, np.ndarray]:
    ids = np.array([number.get(w, 0) for unit in units for w in unit], dtype=np.int64)
    return ids, np.cumsum([0, *map(len, units)])


def _features(units: list[list[str]], number: dict[str, int], keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, feature) of every known n-gram."""
    ids, ends = _numbers(units, number)
    found, last = ngram_keys(ids, ends)
    place = np.minimum(np.searchsorted(keys, found), len(keys) - 1)
    hit = keys[place] == found
    return np.searchsorted(ends, last[hit], side="right") - 1, place[hit]


def fit_logistic(rows: np.ndarray, features: np.ndarray, labels: np.ndarray, n_features: int, n_classes: int, rounds: int = 200, ridge: float = 1e-3) -> tuple[np.ndarray, np.ndarray]:
    """Weights and bias of a multinomial logistic regression on sparse counts, by full gradients (Adam)."""
    n = len(labels)
    weights, bias = np.zeros((n_features, n_classes)), np.zeros(n_classes)
    target = np.eye(n_classes)[labels]
    by_feature = np.argsort(features, kind="stable")
    heads = np.flatnonzero(np.concatenate([[True], np.diff(features[by_feature]) > 0]))
    present = features[by_feature][heads]
    by_row = np.argsort(rows, kind="stable")
    row_heads = np.flatnonzero(np.concatenate([[True], np.diff(rows[by_row]) > 0]))
    filled = rows[by_row][row_heads]
    momentum = [np.zeros_like(weights), np.zeros_like(weights), np.zeros_like(bias), np.zeros_like(bias)]
    for step in range(1, rounds + 1):
        logits = np.tile(bias, (n, 1))
        logits[filled] += np.add.reduceat(weights[features[by_row]], row_heads)
        logits -= logits.max(axis=1, keepdims=True)
        p = np.exp(logits)
        gap = (p / p.sum(axis=1, keepdims=True) - target) / n
        slope = ridge * weights / n
        slope[present] += np.add.reduceat(gap[rows[by_feature]], heads)
        for k, (value, gradient) in enumerate(((weights, slope), (bias, gap.sum(axis=0)))):
            first, second = momentum[2 * k], momentum[2 * k + 1]
            first += 0.1 * (gradient - first)
            second += 0.001 * (gradient * gradient - second)
            value -= 0.2 * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)
    return weights, bias


def _probabilities(logits: np.ndarray, temperatures: tuple[float, float]) -> np.ndarray:
    """Class probabilities: none or a license by the first temperature, which license by the second."""
    rest = logits[:, 1:]
    top = rest.max(axis=1)
    total = top + np.log(np.exp(rest - top[:, None]).sum(axis=1))
    license = 1 / (1 + np.exp(np.clip((logits[:, 0] - total) / temperatures[0], -500, 500)))
    which = np.exp((rest - top[:, None]) / temperatures[1])
    return np.column_stack([1 - license, which * (license / which.sum(axis=1))[:, None]])


def _calibrated(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[float, float]:
    """The temperatures with the least loss on what was left out."""
    grid = np.geomspace(0.25, 8, 41)

    def loss(temperatures: tuple[float, float], first: bool) -> float:
        out = 0.0
        for logits, labels in parts:
            p = _probabilities(logits, temperatures)
            known = labels > 0
            right = np.where(known, 1 - p[:, 0], p[:, 0]) if first else p[known, labels[known]] / np.maximum(1e-12, 1 - p[known, 0])
            out -= np.log(np.maximum(1e-12, right)).sum()
        return out

    return float(min(grid, key=lambda t: loss((t, 1.0), True))), float(min(grid, key=lambda t: loss((1.0, t), False)))


def pairs_of(words: list[str]) -> set[tuple[str, str]]:
    return set(zip(words[:-1], words[1:])) or ({(words[0], "")} if words else set())


def background_windows(texts: DataFrame, text: str, window: int, sample_texts: int, sample_lines: int, rng) -> list[list[str]]:
    """The words of one window of each of at most sample_lines distinct paragraphs, anywhere in them."""
    known = texts.where(F.col(text).isNotNull() & (F.col(text) != ""))
    scale = 1 << 30
    share = min(scale, -(-scale * sample_texts // max(1, known.count())))
    sampled = known.where(F.pmod(F.xxhash64(text), F.lit(scale)) < share)
    paragraphs = sampled.select(F.explode(F.split(F.col(text), PARAGRAPH_END)).alias("line")).where("trim(line) <> ''")
    # a stretch of twice a window's usual length, its place drawn by the paragraph's hash
    size = 32 * window
    start = F.pmod(F.xxhash64("line", F.lit(1)), F.greatest(F.lit(1), F.length("line") - size + 1)).cast("int")
    stretch = paragraphs.select(F.substr("line", start + 1, F.lit(size)).alias("line"), (start > 0).alias("inside")).distinct()
    rows = stretch.orderBy(F.xxhash64("line"), "line", "inside").limit(sample_lines).collect()
    out = []
    for row, words in zip(rows, tokens([r.line for r in rows])):
        words = words[int(row.inside) :]
        at = int(rng.integers(0, max(0, len(words) - window) + 1))
        out.append(words[at : at + window])
    return [words for words in out if words]


@dataclass
class Examples:
    """Training examples: words, label, and what they were made from."""

    words: list[list[str]]
    labels: list[int]
    wording: list[int]

    def add(self, words: list[str], label: int, wording: int) -> None:
        self.words.append(words)
        self.labels.append(label)
        self.wording.append(wording)


#: parts that families and wordings are left out in, in turn, to calibrate
PARTS = 4


def kindred(families: list[str]) -> list[int]:
    """A number for each family, the same for those that share their name's beginning or most of their words."""
    stems = [f.split("-")[0] for f in families]
    names = [next((k[0] for k in KINDRED if stem in k), stem) for stem in stems]
    order = list(dict.fromkeys(names))
    return [order.index(name) for name in names]


def learn(
    texts: DataFrame, text: str = "text", templates=CATALOGUE, sentences=SENTENCES, window: int = WINDOW,
    sample_texts: int = SAMPLE_TEXTS, sample_lines: int = SAMPLE_LINES, seed: int = 11,
) -> LicenseModel:
    """Train on the templates and a bounded sample of background windows of texts."""
    rng = np.random.default_rng(seed)
    notice_words = tokens([t.text for t in templates])
    notices = [pairs_of(w) for t, w in zip(templates, notice_words) if len(w) > 1]
    background = []
    for words in background_windows(texts, text, window, sample_texts, sample_lines, rng):
        own = pairs_of(words)
        if all(len(own & notice) < 0.5 * len(notice) for notice in notices):
            background.append(words)
    if not background:
        background = [["text"]]
    families = sorted({t.family for t in templates})
    classes = [NONE, UNKNOWN, *families]

    def among(words: list[str]) -> list[str]:
        """A notice with background words around it, as windows see it."""
        room = max(0, window - len(words))
        before, after = rng.integers(0, 1 + room // 2, 2) * rng.integers(0, 2, 2)
        fill = background[int(rng.integers(len(background)))]
        return [*fill[: int(before)], *words, *background[int(rng.integers(len(background)))][: int(after)]]

    made = Examples(list(background), [0] * len(background), [k % PARTS for k in range(len(background))])
    by_family = {f: [t for t in templates if t.family == f] for f in families}
    for family, own in by_family.items():
        names = [t.text for t in own if t.exact]
        # short names have few n-grams and are shown more often
        share = np.array([len(x.split()) ** -2.0 for x in names])
        share /= share.sum() or 1.0
        for k, wording in enumerate(WORDINGS * 4 if names else ()):
            name = names[int(rng.choice(len(names), p=share))]
            made.add(among(tokens([wording.format(name)])[0]), classes.index(family), k % len(WORDINGS))
    for family, sentence in worded(templates):
        for k in range(12):
            made.add(among(tokens([sentence])[0]), classes.index(family), k)
    for k, sentence in enumerate(sentences):
        for n in range(24):
            fill = background[int(rng.integers(len(background)))]
            name = " ".join(fill[: int(rng.integers(1, 3))]) if n % 2 else OTHER_LICENSES[int(rng.integers(len(OTHER_LICENSES)))]
            made.add(among(tokens([sentence.format(name)])[0]), 1, k)
    everyday = [*EVERYDAY, *(f"a {kind} {end}" for kind in EVERYDAY_KINDS for end in EVERYDAY_ENDS)]
    for k, sentence in enumerate(everyday):
        for _ in range(8):
            made.add(among(tokens([sentence])[0]), 0, k)

    # n-grams of license texts, less those that are common in the background
    in_wordings = [w.format(t.text) for t in templates if t.exact for w in WORDINGS]
    license_words = [*notice_words, *tokens(in_wordings), *tokens([s.format(" | ") for s in sentences])]
    number: dict[str, int] = {}
    spoken = tokens(everyday)
    for words in [*license_words, *spoken, [*LEADS, *TAILS, *(w for t in templates for w in t.not_next)]]:
        for word in words:
            number.setdefault(word, len(number) + 1)
    keys = np.unique(ngram_keys(*_numbers([*license_words, *spoken], number))[0])
    rows, features = _features(background, number, keys)
    often = np.bincount(features[np.unique(rows * len(keys) + features, return_index=True)[1]], minlength=len(keys))
    keys = keys[often <= COMMON * len(background)]
    rows, features = _features(made.words, number, keys)
    labels, wording = np.array(made.labels), np.array(made.wording)
    weights, bias = fit_logistic(rows, features, labels, len(keys), len(classes))
    temperatures = _calibrated(
        [_left_out(part, rows, features, labels, wording, np.array([-1, -1, *kindred(families)]), len(keys)) for part in range(PARTS)]
    )

    def numbers(words: Iterable[str]) -> np.ndarray:
        return np.array([number[w] for w in words], dtype=np.int64)

    numbered = [
        Numbered(
            t.family, t.exact, ids, np.unique(ids[:-1] * BASE + ids[1:]) if len(ids) > 1 else ids,
            tuple(numbers(x.split()) for x in t.tells), numbers(t.not_next),
        )
        for t, ids in zip(templates, map(numbers, notice_words))
    ]
    return LicenseModel(classes, list(number), keys, weights, bias, temperatures, window, numbered, numbers(LEADS), numbers(TAILS))


def _left_out(part: int, rows, features, labels, wording, kin: np.ndarray, n_features: int) -> tuple[np.ndarray, np.ndarray]:
    """Logits of one part's families and wordings by a model that has not seen them, and their true labels."""
    n_classes = len(kin)
    foreign = (labels >= 2) & (kin[labels] % PARTS == part)
    held = foreign | (wording % PARTS == part)
    again = np.cumsum(~held) - 1
    fitted = ~held[rows]
    weights, bias = fit_logistic(again[rows[fitted]], features[fitted], labels[~held], n_features, n_classes, rounds=60)
    logits = np.tile(bias, (len(labels), 1))
    np.add.at(logits, rows, weights[features])
    # families that the model has never seen are no answers of it
    seen = np.isin(np.arange(n_classes), labels[~held])
    return np.where(seen, logits, -1e9)[held], np.where(foreign, 1, labels)[held]


class Evidence:
    """Known n-grams of some texts, ordered by their last word, and the words that findings are made of."""

    def __init__(self, ids: np.ndarray, place: np.ndarray, begins: np.ndarray, last: np.ndarray):
        self.ids, self.place, self.begins, self.last = ids, place, begins, last
        self.used, self.covered = np.zeros(len(ids), dtype=bool), np.zeros(len(ids), dtype=bool)

    def ending(self, x: int, y: int) -> np.ndarray:
        return np.arange(*np.searchsorted(self.last, [x, y]))

    def inside(self, x: int, y: int) -> np.ndarray:
        """Feature numbers of the n-grams that lie in there."""
        grams = self.ending(x, y)
        return self.place[grams[self.begins[grams] >= x]]

    def uncovered(self, x: int, y: int) -> np.ndarray:
        """N-grams that end there and have no word in a finding."""
        grams = self.ending(x, y)
        low = max(0, x - 2)
        upto = np.concatenate([[0], np.cumsum(self.covered[low:y])])
        return grams[upto[self.last[grams] + 1 - low] == upto[self.begins[grams] - low]]


class Scanner:
    def __init__(self, model: LicenseModel, min_probability: float, min_contained: float):
        self.model, self.min_probability, self.min_contained = model, min_probability, min_contained
        self.values = pa.array(model.vocabulary, pa.large_string())
        #: kin of each class but none: unknown is 0
        self.kin = np.array([0, *(1 + k for k in kindred(model.classes[2:]))])
        self.of_family = dict(zip(model.classes[2:], self.kin[1:].tolist()))
        self.leads, self.tails = set(model.leads.tolist()), set(model.tails.tolist())

    def windows(self, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Paragraph, first and last word of every window."""
        size, step = self.model.window, self.model.window // 2
        n = np.diff(ends)
        count = np.where(n > 0, 1 + np.maximum(0, -(-(n - size) // step)), 0)
        paragraph = np.repeat(np.arange(len(n)), count)
        k = np.arange(len(paragraph)) - np.repeat(np.cumsum(count) - count, count)
        first = ends[paragraph] + k * step
        return paragraph, first, np.minimum(first + size, ends[paragraph + 1])

    @staticmethod
    def paragraphs(owner: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Offsets of the words of runs of lines that hold words, each inside one text."""
        full = np.diff(ends) > 0
        new = full.copy()
        new[1:] &= ~full[:-1] | (owner[1:] != owner[:-1])
        return np.append(ends[:-1][new], ends[-1])

    def scan(self, texts: pa.Array) -> tuple[np.ndarray, list[tuple]]:
        """Number of lines with words of each text, and findings: (row, line, word, n_words, family, probability, contained)."""
        model = self.model
        lists = pc.split_pattern(as_large_strings(texts), "\n")
        of_text = lists.offsets.to_numpy().astype(np.int64)
        words, ends = split_words(lists.flatten(), letters_and_digits())
        owner = np.repeat(np.arange(len(texts)), np.diff(of_text))
        n_lines = np.bincount(owner, weights=np.diff(ends) > 0, minlength=len(texts)).astype(np.int64)
        encoded = words.dictionary_encode()
        number = pc.fill_null(pc.index_in(encoded.dictionary, value_set=self.values), -1).to_numpy(zero_copy_only=False)
        ids = number.astype(np.int64)[encoded.indices.to_numpy(zero_copy_only=False)] + 1 if len(words) else np.zeros(0, dtype=np.int64)
        bounds = self.paragraphs(owner, ends)
        found, last = ngram_keys(ids, bounds)
        place = np.minimum(np.searchsorted(model.keys, found), len(model.keys) - 1)
        hit = model.keys[place] == found
        sizes = 1 + (found[hit] >= 1 << 20).astype(np.int64) + (found[hit] >= 1 << 40)
        place, last = place[hit], last[hit]
        order = np.argsort(last, kind="stable")
        place, last, sizes = place[order], last[order], sizes[order]
        paragraph, first, stop = self.windows(bounds)
        # n-grams that end in a window; one that begins before it has little weight in a half-overlapping window
        lo, hi = np.searchsorted(last, first), np.searchsorted(last, stop)
        filled = np.flatnonzero(hi > lo)
        if not len(filled):
            return n_lines, []
        n = (hi - lo)[filled]
        take = np.repeat(lo[filled] - (np.cumsum(n) - n), n) + np.arange(n.sum())
        flagged = []
        for part in np.array_split(np.arange(len(filled)), max(1, int(n.sum()) // 200_000 + 1)):
            if not len(part):
                continue
            begin = int((np.cumsum(n) - n)[part[0]])
            counts = n[part]
            rows = take[begin : begin + int(counts.sum())]
            logits = model.bias + np.add.reduceat(model.weights[place[rows]], np.cumsum(counts) - counts)
            p = _probabilities(logits, model.temperatures)
            flagged.extend(filled[part[np.flatnonzero(p[:, 0] < 0.5)]].tolist())
        out = []
        begins = last - sizes + 1
        evidence = Evidence(ids, place, begins, last)
        for window in flagged:
            x, y = int(first[window]), int(stop[window])
            # notices at a window's edge are looked at whole
            low, high = max(int(bounds[paragraph[window]]), x - model.window // 2), min(int(bounds[paragraph[window] + 1]), y + model.window // 2)
            out += self.confirmed(evidence, low, high)
        for window in flagged:
            out += self.unknown(evidence, int(first[window]), int(stop[window]))
        return n_lines, [self.located(found, ends, owner, of_text) for found in sorted(out)]

    @staticmethod
    def located(found: tuple, ends: np.ndarray, owner: np.ndarray, of_text: np.ndarray) -> tuple:
        begin, end, *rest = found
        line = int(np.searchsorted(ends, begin, side="right")) - 1
        row = int(owner[line])
        return row, line - int(of_text[row]), begin - int(ends[line]), end - begin, *rest

    def judged(self, places: np.ndarray) -> np.ndarray:
        """Class probabilities by these n-grams alone."""
        return _probabilities((self.model.bias + self.model.weights[places].sum(axis=0))[None], self.model.temperatures)[0]

    def confirmed(self, evidence: Evidence, low: int, high: int) -> list[tuple]:
        """(begin, end, family, probability, contained) of every notice there, each judged by its own words.

        The template with most words there goes first; what a finding is made of counts for no other one.
        """
        model, out = self.model, []
        ids = evidence.ids[low:high]
        pairs = ids[:-1] * BASE + ids[1:]
        there = np.unique(ids)
        likely = [t for t in model.templates if np.isin(t.words if t.exact else np.concatenate(t.tells), there).all()]
        while True:
            used = evidence.used[low:high]
            spans = []
            for template in likely:
                if template.exact:
                    spans += self.named(template, ids, used)
                    continue
                at = np.flatnonzero(~(used[:-1] | used[1:]) & np.isin(pairs, template.pairs))
                if len(np.unique(pairs[at])) >= self.min_contained * len(template.pairs):
                    spans += self.spans(template, ids, at.tolist(), pairs[at].tolist())
            for _, size, begin, family, share, words, named in sorted(spans):
                first, last = self.stretched(evidence, low, high, low + begin, low + begin + size)
                p = self.judged(evidence.inside(first, last))
                own, rival = self.against(p, family, named)
                if p[0] < 0.5 and own >= (0.5 if named else self.min_probability) * (own + rival):
                    evidence.used[low + np.array(words)] = True
                    evidence.covered[first:last] = True
                    out.append((first, last, family, own, share))
                    break
            else:
                return out

    def against(self, p: np.ndarray, family: str, named: bool) -> tuple[float, float]:
        """Probabilities of the likeliest of a family's kin and of the likeliest other one; a name rules unknown out."""
        kin = self.kin == self.of_family[family]
        return float(p[1:][kin].max()), float(p[1:][~kin & ((self.kin > 0) | (not named))].max(initial=0.0))

    def stretched(self, evidence: Evidence, low: int, high: int, begin: int, end: int) -> tuple[int, int]:
        """The run with the words that lead to it and follow it, as far as no other finding has them."""
        while begin > low and not evidence.covered[begin - 1] and evidence.ids[begin - 1] in self.leads:
            begin -= 1
        while end < high and not evidence.covered[end] and evidence.ids[end] in self.tails:
            end += 1
        return begin, end

    @staticmethod
    def places(phrase: np.ndarray, ids: np.ndarray) -> np.ndarray:
        """Where the phrase begins."""
        at = np.flatnonzero(ids[: max(0, len(ids) - len(phrase) + 1)] == phrase[0])
        return at[(ids[at[:, None] + np.arange(len(phrase))] == phrase).all(axis=1)]

    def named(self, template: Numbered, ids: np.ndarray, used: np.ndarray) -> list[tuple]:
        """Every place of a name, unless it goes on as another license's."""
        out, size = [], len(template.words)
        for begin in self.places(template.words, ids).tolist():
            end = begin + size
            if not used[begin:end].any() and not (end < len(ids) and ids[end] in template.not_next):
                out.append((-float(size), size, begin, template.family, 1.0, list(range(begin, end)), True))
        return out

    def spans(self, template: Numbered, ids: np.ndarray, at: list[int], pairs: list[int]) -> list[tuple]:
        """From each place on, the shortest run of at most twice the template's length that holds most of its pairs and all its telling phrases."""
        out = []
        for k, begin in enumerate(at):
            seen, end = {pairs[k]}, k
            for j in range(k + 1, len(at)):
                if at[j] + 2 - begin > 2 * (len(template.pairs) + 1):
                    break
                if pairs[j] not in seen:
                    seen.add(pairs[j])
                    end = j
            share = len(seen) / len(template.pairs)
            stop = at[end] + 2
            if share >= self.min_contained and all(len(self.places(tell, ids[begin:stop])) for tell in template.tells):
                words = sorted({w for x in at[k : end + 1] for w in (x, x + 1)})
                out.append((-share * (len(seen) + 1), stop - begin, begin, template.family, share, words, False))
        return out

    def unknown(self, evidence: Evidence, x: int, y: int) -> list[tuple]:
        """What speaks of a license in the window beside the notices that are known."""
        model, out = self.model, []
        while True:
            grams = evidence.uncovered(x, y)
            places = evidence.place[grams]
            p = self.judged(places)
            if not len(grams) or p[0] >= 0.5:
                return out
            # the words around the n-gram that says it most clearly
            strongest = int(np.argmax(model.weights[places, 1:].max(axis=1) - model.weights[places, 0]))
            held = np.unique(np.concatenate([evidence.begins[grams], evidence.last[grams]]))
            runs = np.split(held, np.flatnonzero(np.diff(held) > GAP) + 1)
            run = next(r for r in runs if r[0] <= evidence.last[grams[strongest]] <= r[-1])
            begin, end = int(run[0]), int(run[-1]) + 1
            evidence.covered[begin:end] = True
            family = model.classes[2 + int(np.argmax(p[2:]))]
            pairs = evidence.ids[begin : end - 1] * BASE + evidence.ids[begin + 1 : end]
            contained = max(float(np.isin(t.pairs, pairs).mean()) for t in model.templates if t.family == family)
            out.append((begin, end, UNKNOWN, float(1 - p[0]), contained))


FINDING = T.StructType(
    [
        T.StructField("line", T.LongType()),
        T.StructField("word", T.LongType()),
        T.StructField("n_words", T.LongType()),
        T.StructField("family", T.StringType()),
        T.StructField("probability", T.DoubleType()),
        T.StructField("contained", T.DoubleType()),
    ]
)


def scan_licenses(
    docs: DataFrame, model: LicenseModel, text: str = "text", keep: list[str] | None = None,
    min_probability: float = MIN_PROBABILITY, min_contained: float = MIN_CONTAINED,
) -> DataFrame:
    """The columns in keep (all by default), n_paragraphs and findings.  Columns of these names are replaced."""
    added = T.StructType([T.StructField("n_paragraphs", T.LongType()), T.StructField("findings", T.ArrayType(FINDING))])
    kept = [c for c in (docs.columns if keep is None else keep) if c not in added.names]
    read = docs.select(*dict.fromkeys([*kept, text]))
    schema = T.StructType([*(read.schema[c] for c in kept), *added])
    shipped = Shipped(docs.sparkSession, model)
    kind = pa.list_(pa.struct([("line", pa.int64()), ("word", pa.int64()), ("n_words", pa.int64()), ("family", pa.string()), ("probability", pa.float64()), ("contained", pa.float64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(shipped.value, min_probability, min_contained)
        for piece in pieces(batches, text):
            n_lines, found = scanner.scan(piece.column(text))
            findings: list[list[dict]] = [[] for _ in range(piece.num_rows)]
            for row, *rest in found:
                findings[row].append(dict(zip(FINDING.names, rest)))
            new = [pa.array(n_lines, pa.int64()), pa.array(findings, kind)]
            yield pa.RecordBatch.from_arrays([*(piece.column(c) for c in kept), *new], names=schema.names)

    return read.mapInArrow(run, schema)
