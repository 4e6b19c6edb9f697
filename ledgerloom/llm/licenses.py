"""License scan: MinHash bands over overlapping word windows, then exact containment.

Templates of similar length share a window size of one and a half times their
words, moved by less than half of it, so a copy of a template always lies whole
inside some window. Every window gets one MinHash value per band; the number of
bands follows from the least similarity a window with a match can have, so that a
match shares a band with its template with probability 1 - ``MISS`` or more.
Windows that share a band are verified by the share of the template's word
shingles they hold. All steps are DataFrame expressions.
"""

from __future__ import annotations

import math
import re
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import named, text_of

SHINGLE = 5
CONTAINMENT = 0.8
MISS = 0.001

# Public license notices, in the words their owners ask for.
TEMPLATES = {
    "Apache-2.0 line": "Licensed under the Apache License, Version 2.0",
    "Apache-2.0 header": "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at",
    "MIT line": "Released under the MIT License",
    "MIT permission": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software",
    "GPL-3.0 line": "This work is licensed under the GNU General Public License, version 3",
    "GPL notice": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation",
    "CC-BY-NC-4.0 line": "Licensed under CC BY-NC 4.0",
    "CC-BY-4.0 line": "This work is licensed under a Creative Commons Attribution 4.0 International License",
    "BSD redistribution": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
    "MPL-2.0 notice": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0",
}


def words_in(text: str) -> list[str]:
    return [word for word in re.split(r"[\W_]+", text.lower()) if word]


@dataclass(frozen=True)
class WindowClass:
    """Window size and step in words, and the number of bands, for templates of ``least`` to ``most`` words."""

    least: int
    most: int

    @property
    def size(self) -> int:
        return math.ceil(1.5 * self.most)

    @property
    def step(self) -> int:
        return self.size - self.most + 1

    @property
    def bands(self) -> int:
        """Bands of one value each, from the least Jaccard similarity of a window that holds a match."""
        chance = []
        for words in range(self.least, self.most + 1):
            shingles = words - SHINGLE + 1
            shared = math.ceil(CONTAINMENT * shingles)
            chance.append(shared / (self.size - SHINGLE + 1 + shingles - shared))
        return 1 if min(chance) >= 1 else math.ceil(math.log(MISS) / math.log(1 - min(chance)))


def window_classes(templates: dict[str, str]) -> dict[str, WindowClass]:
    """Templates in classes whose longest has at most 1.4 times the words of the shortest."""
    lengths = sorted({max(SHINGLE, len(words_in(text))) for text in templates.values()})
    ranges: list[list[int]] = []
    for length in lengths:
        if ranges and length <= 1.4 * ranges[-1][0]:
            ranges[-1][1] = length
        else:
            ranges.append([length, length])
    of = {length: WindowClass(*r) for r in ranges for length in range(r[0], r[1] + 1)}
    return {name: of[max(SHINGLE, len(words_in(text)))] for name, text in templates.items()}


def needed_words(text: str) -> list[str]:
    """Words of a template of which any match must hold at least one: their shingles are more than a match may lack."""
    words = words_in(text)
    shingles = [words[i : i + SHINGLE] for i in range(max(1, len(words) - SHINGLE + 1))]
    spare = len(shingles) - math.ceil(CONTAINMENT * len(shingles))
    chosen: list[str] = []
    for word in sorted(set(words), key=lambda w: (-len(w), w)):
        if sum(any(w in chosen for w in shingle) for shingle in shingles) > spare:
            break
        chosen.append(word)
    return chosen


def _words(text: Column) -> Column:
    return F.filter(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), lambda word: word != "")


def _shingles(words: Column) -> Column:
    """Distinct shingles of an array of at least one word; fewer words than a shingle are one shingle."""
    count = F.greatest(F.size(words) - SHINGLE + 1, F.lit(1))
    return F.array_distinct(
        F.transform(F.sequence(F.lit(1), count), lambda at: F.array_join(F.slice(words, at, SHINGLE), " "))
    )


def _minhashes(shingles: Column, bands: int) -> Column:
    def least(band: int) -> Column:
        return F.array_min(F.transform(shingles, lambda shingle: F.xxhash64(shingle, F.lit(band))))

    return F.array(*[least(band) for band in range(bands)])


def _by_class(classes: list[WindowClass], value: Callable[[WindowClass], Column]) -> Column:
    """One expression per window class, of which a row evaluates its own."""
    return F.coalesce(*[F.when(F.col("class") == number, value(at)) for number, at in enumerate(classes)])


def _starts(at: WindowClass, number: int) -> Column:
    """Class, first word and size of the windows over ``words``; the last one reaches the end."""
    last = F.greatest(F.size("words") - at.size + at.step - 1, F.lit(0))
    return F.transform(
        F.sequence(F.lit(0), last, F.lit(at.step)),
        lambda first: F.struct(F.lit(number).alias("class"), first.alias("first_word"), F.lit(at.size).alias("size")),
    )


def _bands(rows: DataFrame, shingles: str, keep: Sequence[str], classes: list[WindowClass]) -> DataFrame:
    """One row per band of every row, with its MinHash value."""
    hashes = _by_class(classes, lambda at: _minhashes(F.col(shingles), at.bands))
    return rows.select("class", *keep, shingles, F.posexplode(hashes).alias("band", "value"))


def license_matches(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", templates: dict[str, str] | None = None
) -> DataFrame:
    """Windows that match a template.

    Returns ``id``, ``license``, ``first_word``, ``n_words`` and ``containment``
    (share of the template's shingles, at least 0.8) of every window that matches
    a template; a long copy may match two neighbouring windows. Words are runs of
    letters and digits, lower-cased.

    Documents without any of the words a match must hold are left out first; that
    loses no match. Null or empty text and text without words matches nothing.
    Rows stay in their task until the result, so repeated rows and hot sources
    make no difference; null ids come back as they are. An empty table gives no
    rows. Other columns are ignored. The templates are a parameter of bounded
    size, and the only data broadcast.
    """
    templates = TEMPLATES if templates is None else templates
    classes = window_classes(templates)
    needed = sorted({word for text in templates.values() for word in needed_words(text)})
    narrow = docs.select(*named(id=id_column), text_of(f"`{text_column}`").alias("text"))
    order = sorted(set(classes.values()), key=lambda at: at.most)
    # as many rows as templates times bands
    known = docs.sparkSession.createDataFrame(
        [(order.index(classes[name]), name, text) for name, text in templates.items()],
        "class int, license string, text string",
    ).withColumn("theirs", _shingles(_words(F.col("text"))))
    known = _bands(known, "theirs", ["license"], order)
    possible = (
        narrow.filter(F.lower("text").rlike("|".join(map(re.escape, needed))))
        .select("id", _words(F.col("text")).alias("words"))
        .filter(F.size("words") > 0)
    )
    starts = F.concat(*[_starts(at, number) for number, at in enumerate(order)])
    windows = (
        possible.select("id", "words", F.explode(starts).alias("window"))
        .select(
            "id", "window.class", "window.first_word",
            F.slice("words", F.col("window.first_word") + 1, F.col("window.size")).alias("held"),
        )
        .select("id", "class", "first_word", F.size("held").alias("n_words"), _shingles(F.col("held")).alias("mine"))
    )
    bands = _bands(windows, "mine", ["id", "first_word", "n_words"], order)
    shared = bands.join(F.broadcast(known), ["class", "band", "value"])
    containment = F.size(F.array_intersect("mine", "theirs")) / F.size("theirs")
    hits = shared.withColumn("containment", containment).filter(F.col("containment") >= CONTAINMENT)
    return hits.select("id", "license", "first_word", "n_words", "containment").distinct()


def licenses(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", templates: dict[str, str] | None = None
) -> DataFrame:
    """``id``, ``license`` and best ``containment`` of every document that holds a template; see ``license_matches``.

    Rows that share an id are one document here.
    """
    matches = license_matches(docs, id_column, text_column, templates)
    return matches.groupBy("id", "license").agg(F.max("containment").alias("containment"))
