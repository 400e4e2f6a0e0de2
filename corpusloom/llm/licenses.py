"""License scans with MinHash bands over overlapping windows, DataFrame functions only.

Texts and templates are cut into words and two-word shingles. A text's windows of ``WINDOW``
words begin at every ``STRIDE``-th word; a template's at every word. Each window has one
MinHash value for each of ``BANDS`` bands, and a template is retrieved where a text's window
and one of its own agree in a band. Then the template's shingles are looked for around that
place, exactly: it is found if the share of them there, its containment, is at least the
threshold.

Bands of one row, so a window of similarity s is missed with probability (1 - s)**BANDS. A
template that occurs whole in ``WINDOW + STRIDE - 1`` words or more holds a window of the
text whole, for which s is 1: it is never missed. With one word in five changed, every
window has s of 1/5 or more, most 1/2: two windows of 1/2 are both missed with probability
(1/2)**(2 * BANDS), 1 in 4096 for six bands. Shorter templates hold no window for certain:
they are looked for wherever one of their shingles is, in a stretch of their own length.

Everything happens inside the row: no shuffle, and only rows with a retrieved window pay
for verification. Templates are a stated list; their windows are literals, in blocks.

Defined results: a null or wordless text has no license; a template of fewer words than a
shingle is no template; a template that occurs often is listed once, with its best place;
repeated rows repeat their result; other columns are kept whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.arrow import free_name

SHINGLE = 2
WINDOW = 4
STRIDE = 2
BANDS = 6
THRESHOLD = 0.8
BLOCK = 64  # templates per pass over the windows

# The opening words of common license notices, as published with them. They do
# not tell licenses apart that differ later only, and do not meet a text without its opening.
OPENINGS = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0",
    "Apache-2.0 header": "you may not use this file except in compliance with the License",
    "BSD": "Redistribution and use in source and binary forms, with or without modification, are permitted",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3",
    "GPL notice": "under the terms of the GNU General Public License as published by the Free Software Foundation",
    "ISC": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted",
    "MIT": "Released under the MIT License",
    "MIT notice": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software",
    "MPL-2.0": "subject to the terms of the Mozilla Public License, v. 2.0",
}
TEMPLATES = OPENINGS | {"All rights reserved": "All rights reserved"}

_NOT_WORD = "".join(chr(c) for c in range(128) if not chr(c).isalnum())
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_MASKS = [((j + 1) * 0x9E3779B97F4A7C15) % 2**63 for j in range(BANDS)]


def words(text: Column) -> Column:
    """Runs of ASCII letters and digits and of characters beyond ASCII, A-Z lower-cased."""
    plain = F.translate(F.coalesce(text, F.lit("")), _UPPER + _NOT_WORD, _UPPER.lower() + " " * len(_NOT_WORD))
    return F.array_remove(F.split(plain, " "), "")


def shingles(found: Column) -> Column:
    """A hash of each two words in a row."""
    following = F.slice(found, 2, F.greatest(F.size(found), F.lit(1)))
    pairs = F.zip_with(found, following, lambda a, b: F.when(b.isNotNull(), F.xxhash64(a, b)))
    return F.slice(pairs, 1, F.greatest(F.size(found) - 1, F.lit(0)))


def _value(hashes: Column, at: Column, band: int) -> Column:
    """The MinHash value of a band for the window whose first shingle is at ``at`` (from 0)."""
    inside = [F.get(hashes, at + i).bitwiseXOR(F.lit(_MASKS[band])) for i in range(WINDOW - SHINGLE + 1)]
    return F.least(*inside)


def _windows(hashes: Column, band: int) -> Column:
    """Band values of a template's windows."""
    last = F.greatest(F.size(hashes) - (WINDOW - SHINGLE + 1), F.lit(0))
    return F.transform(F.sequence(F.lit(0), last), lambda at: _value(hashes, at, band))


def _template_rows(spark, templates: dict[str, str]) -> list[tuple[str, list[int], list[list[int]]]]:
    """Name, shingles and band values of every template; hashed where texts are, in Spark."""
    table = spark.createDataFrame(list(templates.items()), "name string, text string")
    rows = table.select("name", shingles(words(F.col("text"))).alias("s")).filter("size(s) > 0")
    bands = [_windows(F.col("s"), j).alias(f"b{j}") for j in range(BANDS)]
    return [(r["name"], r["s"], [r[f"b{j}"] for j in range(BANDS)]) for r in rows.select("name", "s", *bands).orderBy("name").collect()]


def _agrees(hashes: Column, bands: list[list[int]]):
    """Whether the window at a place agrees with one of the values in any band."""

    def test(at: Column) -> Column:
        return _any([_value(hashes, at, j).isin(sorted(set(values))) for j, values in enumerate(bands)])

    return test


def _share_of(hashes: Column, own: list[int]):
    """The share of a template's shingles found around a place."""
    wanted = F.array(*[F.lit(v) for v in sorted(set(own))])

    def share(at: Column) -> Column:
        around = F.slice(hashes, F.greatest(at + 2 - len(own), F.lit(1)), F.lit(2 * len(own) + WINDOW))
        return F.size(F.array_intersect(around, wanted)) / F.lit(float(len(set(own))))

    return share


def _is_short(own: list[int]) -> bool:
    return len(own) + SHINGLE - 1 < WINDOW + STRIDE - 1


def _best_stretch(hashes: Column, own: list[int]) -> Column:
    """The largest share of a template's shingles in a stretch of its length; the best begins with one of them."""
    values = sorted(set(own))
    every = F.sequence(F.lit(0), F.greatest(F.size(hashes) - 1, F.lit(0)))
    places = F.filter(every, lambda at: F.get(hashes, at).isin(values))
    wanted = F.array(*[F.lit(v) for v in values])
    held = lambda at: F.size(F.array_intersect(F.slice(hashes, at + 1, F.lit(len(own))), wanted))
    return F.array_max(F.transform(places, lambda at: held(at) / F.lit(float(len(values)))))


def with_licenses(
    docs: DataFrame,
    text: str = "text",
    templates: dict[str, str] | None = None,
    threshold: float = THRESHOLD,
    name: str = "licenses",
) -> DataFrame:
    """``docs`` and an array of ``(name, containment)``, by name."""
    wanted = _template_rows(docs.sparkSession, templates or TEMPLATES)
    s, hits = free_name(docs, "__shingles"), free_name(docs, "__hits")
    out = docs.withColumn(s, shingles(words(F.col(text))))
    hashes = F.col(s)
    first = F.sequence(F.lit(0), F.greatest(F.size(s) - 1, F.lit(0)), F.lit(STRIDE))
    best = {title: _best_stretch(hashes, own) for title, own, _ in wanted if _is_short(own)}
    long = [x for x in wanted if not _is_short(x[1])]
    for block in range(0, len(long), BLOCK):
        some = long[block : block + BLOCK]
        every = [[v for _, _, bands in some for v in bands[j]] for j in range(BANDS)]
        place = f"{hits}{block}"
        out = out.withColumn(place, F.filter(first, _agrees(hashes, every)))
        for title, own, bands in some:
            shares = F.transform(F.filter(F.col(place), _agrees(hashes, bands)), _share_of(hashes, own))
            best[title] = F.when(F.size(place) > 0, F.array_max(shares))
    found = [
        F.struct(F.lit(title).alias("name"), F.coalesce(best[title], F.lit(0.0)).alias("containment")) for title, _, _ in wanted
    ]
    both = F.array(*found) if found else F.array().cast("array<struct<name:string,containment:double>>")
    answer = F.filter(both, lambda x: x["containment"] >= threshold)
    return out.select(*docs.columns, answer.alias(free_name(docs, name)))


def _any(conditions: list[Column]) -> Column:
    out = conditions[0]
    for condition in conditions[1:]:
        out = out | condition
    return out
