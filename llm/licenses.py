"""License notices by the Dice coefficient over word bigrams, with size bounds that prune templates.

Units of a text are its lines, its blocks between empty lines, and the whole. A unit and a template
match when 2 * common / (own + template) bigrams is at least the threshold, so a unit of another size
than threshold / (2 - threshold) times the template's, up or down, is never compared with it.
"""

from __future__ import annotations

import re
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from llm.shared import lower_ascii

THRESHOLD = 0.8

# Short standard notices of public licenses.
TEMPLATES = {
    "Apache-2.0": (
        "Licensed under the Apache License, Version 2.0.",
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the '
        "License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
    ),
    "BSD-3-Clause": (
        "Released under the 3-Clause BSD License.",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following "
        "conditions are met:",
    ),
    "CC-BY-4.0": (
        "Licensed under CC BY 4.0.",
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    ),
    "CC-BY-NC-4.0": (
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    ),
    "CC-BY-SA-4.0": (
        "Licensed under CC BY-SA 4.0.",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    ),
    "GPL-2.0": ("This work is licensed under the GNU General Public License, version 2.",),
    "GPL-3.0": (
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as "
        "published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    ),
    "LGPL-3.0": ("This work is licensed under the GNU Lesser General Public License, version 3.",),
    "MIT": (
        "Released under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation "
        'files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, '
        "modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software "
        "is furnished to do so, subject to the following conditions:",
    ),
    "MPL-2.0": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed "
        "with this file, You can obtain one at http://mozilla.org/MPL/2.0/.",
    ),
}


def _plain(text: str) -> list[str]:
    return re.findall(r"[a-z0-9]+", text.lower())


def _bigrams(words: list[str]) -> list[str]:
    return sorted({f"{a} {b}" for a, b in zip(words, words[1:])})


def prepared(templates: Mapping[str, tuple[str, ...]] = TEMPLATES) -> list[tuple[str, list[str]]]:
    """(license, bigrams) of every template, by name; a template of fewer than two words is an error."""
    out = [(name, _bigrams(_plain(text))) for name in sorted(templates) for text in templates[name]]
    if any(not bigrams for _, bigrams in out):
        raise ValueError("a template needs two words")
    return out


def signal_words(prepared_templates: list[tuple[str, list[str]]], threshold: float = THRESHOLD) -> list[str]:
    """Words one of which occurs in every unit that can match.

    A match shares at least threshold / (2 - threshold) of a template's bigrams; the chosen words touch
    so many bigrams of each template that fewer than that remain without one.
    """
    need = threshold / (2 - threshold)
    open_templates = [set(bigrams) for _, bigrams in prepared_templates]
    sizes = [len(b) for b in open_templates]
    chosen: list[str] = []
    while True:
        left = [b for b, n in zip(open_templates, sizes) if len(b) >= need * n - 1e-9]
        if not left:
            return chosen
        gain: dict[str, float] = {}
        for bigrams in left:
            for bigram in bigrams:
                for word in set(bigram.split()):
                    gain[word] = gain.get(word, 0.0) + 1 / len(bigrams)
        best = max(gain, key=lambda w: (gain[w] * len(w) ** 2, w))
        chosen.append(best)
        open_templates = [{b for b in bigrams if best not in b.split()} for bigrams in open_templates]


def _let(value: Column, body) -> Column:
    """body applied to a value that is computed once."""
    return F.transform(F.array(value), body)[0]


def _best(unit: Column, templates: list[tuple[str, list[str]]], threshold: float) -> Column:
    """(dice, license) of the best template of a unit; null below the threshold. Ties go to the later name."""
    low = min(len(b) for _, b in templates) * threshold / (2 - threshold)
    high = max(len(b) for _, b in templates) * (2 - threshold) / threshold

    def compare(bigrams: Column) -> Column:
        size = F.size(bigrams)
        scores = []
        for name, own in templates:
            n = len(own)
            fits = size.between(int(n * threshold / (2 - threshold)), int(n * (2 - threshold) / threshold) + 1)
            common = F.size(F.array_intersect(bigrams, F.lit(own)))
            dice = F.when(fits, 2.0 * common / (size + n))
            scores.append(F.when(dice >= threshold, F.struct(dice.alias("dice"), F.lit(name).alias("license"))))
        return F.array_max(F.array(*scores))

    def paired(words: Column) -> Column:
        n = F.size(words)
        pairs = F.zip_with(F.slice(words, 1, n - 1), F.slice(words, 2, n - 1), lambda a, b: F.concat(a, F.lit(" "), b))
        return F.when(n > low, _let(F.array_distinct(pairs), lambda b: F.when(F.size(b) <= int(high) + 1, compare(b))))

    plain = F.trim(F.regexp_replace(lower_ascii(unit), "[^a-z0-9]+", " "))
    return _let(F.split(plain, " "), paired)


def scanned(
    docs: DataFrame, text: str = "text", templates: Mapping[str, tuple[str, ...]] = TEMPLATES, threshold: float = THRESHOLD
) -> DataFrame:
    """docs with license (of the best match, else null), dice (else null) and n_notices (distinct units that match).

    Rows are scanned one by one, without a shuffle. Most texts hold no signal word and are passed over
    by one regular expression; that loses no match. A null or empty text matches nothing. Ties between
    licenses go to the later name. The columns license, dice and n_notices are replaced.
    """
    known = prepared(templates)
    own = F.col(f"`{text}`")
    signal = r"(?i)(?<![a-z0-9])(?:" + "|".join(signal_words(known, threshold)) + r")(?![a-z0-9])"
    units = F.array_distinct(
        F.concat(F.split(own, r"\r?\n", -1), F.split(own, r"\r?\n[\x20\t]*\r?\n", -1), F.array(own))
    )
    found = F.transform(F.filter(units, lambda u: u.rlike(signal)), lambda u: _best(u, known, threshold))
    found = F.when(own.rlike(signal), F.filter(found, lambda b: b.isNotNull()))
    out = docs.withColumn("_found", found)
    best = F.array_max("_found")
    columns = {"license": best["license"], "dice": best["dice"], "n_notices": F.coalesce(F.size("_found"), F.lit(0)).cast("long")}
    return out.withColumns(columns).withColumn("n_notices", F.greatest("n_notices", F.lit(0))).drop("_found")
