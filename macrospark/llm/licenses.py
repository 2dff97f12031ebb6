"""License scan: which known license notices a text holds. Built-in expressions only.

Texts are lower-cased words; shingles are `SHINGLE` words. A template of at most L words (L from
`LENGTHS`, the least that fits) is looked for in windows of 2 L words that begin every L words,
so each occurrence lies whole in a window. A window's MinHash has one permutation per band, and
it retrieves the templates that share a band value. Bands are as many as make a miss at most
`MISS` likely for a window that holds just `CONTAINMENT` of the shortest template of its length
class. A retrieved template counts if exact shingle containment, the share of its shingles found
in the window, is `CONTAINMENT` or more.

A window can only share a band value if it holds the shingle that is that template's minimum;
texts and windows without any of these shingles are passed over before anything is permuted,
which changes no result. All is done in the row: no shuffle, no join.

Defined cases: null and empty texts, and texts of fewer words than a shingle, hold no license; a
license found in several windows counts once, with its best containment; repeated rows are each
scanned; all columns pass through, and a result column whose name is taken gets `_` appended.
"""

from __future__ import annotations

import math
from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from macrospark.llm.common import free_name, text_of

SHINGLE = 3
CONTAINMENT = 0.8
MISS = 1e-4
LENGTHS = (8, 16, 32, 64, 128, 256)

# Notices of well-known licenses, in natural order.
TEMPLATES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0-header": (
        "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in "
        "compliance with the License. You may obtain a copy of the License at"
    ),
    "BSD": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted "
        "provided that the following conditions are met"
    ),
    "CC-BY-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-3.0-notice": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
        "General Public License as published by the Free Software Foundation, either version 3 of the License, "
        "or (at your option) any later version."
    ),
    "ISC": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee "
        "is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."
    ),
    "MIT": "Released under the MIT License.",
    "MIT-grant": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
        "associated documentation files (the Software), to deal in the Software without restriction, including "
        "without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell "
        "copies of the Software, and to permit persons to whom the Software is furnished to do so"
    ),
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
}


def words_of(text: Column) -> Column:
    """Lower-cased runs of digits, letters a-z and characters beyond ASCII."""
    spaced = F.regexp_replace(F.lower(text), r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+", " ")
    return F.filter(F.split(spaced, " "), lambda w: w != "")


def shingles_of(words: Column, size: int = SHINGLE) -> Column:
    """Hashes of all shingles in order; empty if there are too few words."""
    hashed = F.transform(
        F.sequence(F.lit(1), F.greatest(F.size(words) - (size - 1), F.lit(1))),
        lambda i: F.xxhash64(*[F.element_at(words, i + j) for j in range(size)]),
    )
    return F.when(F.size(words) >= size, hashed).otherwise(F.array().cast("array<bigint>"))


def _permuted(shingle: Column, band: Column) -> Column:
    return F.xxhash64(shingle, band)


def _min_hashes(shingles: Column, bands: int) -> Column:
    """One value per band: the band's number and the least permuted shingle, hashed together."""
    return F.transform(
        F.sequence(F.lit(1), F.lit(bands)),
        lambda k: F.xxhash64(k, F.array_min(F.transform(shingles, lambda s: _permuted(s, k)))),
    )


def bands_for(length: int, shortest: int, size: int, containment: float, miss: float) -> int:
    """Bands that miss a window holding `containment` of a template of `shortest` words at most `miss` of the time."""
    template, window = shortest - size + 1, 2 * length - size + 1
    shared = math.ceil(containment * template)
    similarity = shared / (window + template - shared)
    return math.ceil(math.log(miss) / math.log(1 - similarity))


class Library:
    """Templates with their shingles, MinHash values and the shingles that are their minima."""

    def __init__(self, spark: SparkSession, templates: Mapping[str, str], size: int, containment: float, miss: float):
        frame = spark.createDataFrame(sorted(templates.items()), "name string, text string")
        frame = frame.withColumn("w", words_of(F.col("text"))).withColumn("s", F.array_distinct(shingles_of(F.col("w"), size)))
        self.by_length: dict[int, list[dict]] = {}
        for row in frame.select("name", F.size("w").alias("n"), "s").collect():  # as many rows as templates
            if row["n"] < size or row["n"] > LENGTHS[-1]:
                raise ValueError(f"template {row['name']} must have {size} to {LENGTHS[-1]} words")
            length = next(x for x in LENGTHS if row["n"] <= x)
            self.by_length.setdefault(length, []).append({"name": row["name"], "n": row["n"], "s": row["s"]})
        self.bands = {k: bands_for(k, min(t["n"] for t in ts), size, containment, miss) for k, ts in self.by_length.items()}
        for length, found in self.by_length.items():
            rows = spark.createDataFrame([(t["name"], t["s"]) for t in found], "name string, s array<bigint>")
            bands = F.sequence(F.lit(1), F.lit(self.bands[length]))
            least = F.transform(
                bands, lambda k: F.array_min(F.transform("s", lambda s: F.struct(_permuted(s, k).alias("p"), s.alias("s"))))["s"]
            )
            values = rows.select("name", _min_hashes(F.col("s"), self.bands[length]).alias("v"), F.array_distinct(least).alias("m"))
            by_name = {r["name"]: r for r in values.collect()}
            for t in found:
                t["values"], t["minima"] = by_name[t["name"]]["v"], by_name[t["name"]]["m"]

    def minima(self, length: int | None = None) -> list[int]:
        lengths = self.by_length if length is None else [length]
        return sorted({m for k in lengths for t in self.by_length[k] for m in t["minima"]})


def _longs(values: list[int]) -> Column:
    return F.array(*[F.lit(v) for v in values]).cast("array<bigint>")


def _found(library: Library, shingles: Column, size: int, containment: float) -> Column:
    """(name, containment) of the templates that some window holds."""
    out = []
    for length, templates in sorted(library.by_length.items()):
        starts = F.sequence(F.lit(1), F.size(shingles), F.lit(length))
        windows = F.transform(starts, lambda p: F.slice(shingles, p, F.lit(2 * length - size + 1)))
        likely = F.filter(windows, lambda w: F.arrays_overlap(w, _longs(library.minima(length))))
        hashed = F.transform(likely, lambda w: F.struct(w.alias("w"), _min_hashes(w, library.bands[length]).alias("v")))
        for t in templates:
            share = F.array_max(
                F.transform(
                    F.filter(F.col(f"_windows_{length}"), lambda x: F.arrays_overlap(x["v"], _longs(t["values"]))),
                    lambda x: F.size(F.array_intersect(x["w"], _longs(t["s"]))) / F.lit(float(len(t["s"]))),
                )
            )
            out.append((length, hashed, F.struct(F.lit(t["name"]).alias("name"), share.alias("containment"))))
    return out


def scan(
    docs: DataFrame,
    templates: Mapping[str, str] = TEMPLATES,
    text: str = "text",
    result: str = "licenses",
    size: int = SHINGLE,
    containment: float = CONTAINMENT,
    miss: float = MISS,
) -> DataFrame:
    """Add an array of (name, containment), sorted by name: the licenses that a text holds."""
    result = free_name(docs, result)
    library = Library(docs.sparkSession, templates, size, containment, miss)
    # Working columns sit in a struct, so that no column of the documents can clash with them.
    row = free_name(docs, "_row")
    work = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias(row), words_of(text_of(text)).alias("_words"))
    work = work.select(row, shingles_of(F.col("_words"), size).alias("_all"))
    hit = F.arrays_overlap("_all", _longs(library.minima()))
    work = work.select(row, F.when(hit, F.col("_all")).alias("_shingles"))
    parts = _found(library, F.col("_shingles"), size, containment)
    windows = {length: hashed for length, hashed, _ in parts}
    work = work.select(row, *[F.when(F.col("_shingles").isNotNull(), w).alias(f"_windows_{k}") for k, w in windows.items()])
    none = F.array().cast("array<struct<name:string,containment:double>>")
    held = F.filter(F.array(*[p for _, _, p in parts]), lambda p: p["containment"] >= containment)
    any_window = reduce(lambda a, b: a | b, [F.size(f"_windows_{k}") > 0 for k in windows])
    return work.select(f"{row}.*", F.when(any_window, F.array_sort(held)).otherwise(none).alias(result))


def digest_columns(docs: DataFrame) -> DataFrame:
    """Per document: doc_id, the licenses found, how many, and the least containment among them."""
    found = scan(docs.select("doc_id", "text"))
    return found.select(
        "doc_id",
        F.array_join(F.transform("licenses", lambda x: x["name"]), ",").alias("licenses"),
        F.size("licenses").cast("long").alias("n_licenses"),
        F.array_min(F.transform("licenses", lambda x: x["containment"])).alias("least_containment"),
    )


def oracle_sql() -> str:
    """The same by brute force: every window against every template, without MinHash."""
    values = ", ".join(f"('{name}', '{text}')" for name, text in TEMPLATES.items())
    lengths = ", ".join(map(str, LENGTHS))
    words = r"regexp_extract_all(lower({}), '(?:[0-9a-z]|[^\x00-\x7F])+')"
    return f"""
with templates(name, text) as (values {values}),
template_words as (select name, {words.format('text')} as w from templates),
sized as (
  select name, w, (select min(l) from (select unnest([{lengths}]) as l) where l >= len(w)) as length from template_words),
template_shingles as (
  select distinct name, length, array_to_string(list_slice(w, i, i + {SHINGLE - 1}), ' ') as s
  from (select name, length, w, unnest(range(1, len(w) - {SHINGLE - 2})) as i from sized)),
template_sizes as (select name, count(*) as n from template_shingles group by name),
doc_words as (select doc_id, {words.format("coalesce(text, '')")} as w from documents),
doc_shingles as (
  select doc_id, i, array_to_string(list_slice(w, i + 1, i + {SHINGLE}), ' ') as s
  from (select doc_id, w, unnest(range(0, len(w) - {SHINGLE - 1})) as i from doc_words)),
found as (
  select doc_id, name, length, i, doc_shingles.s from doc_shingles join template_shingles using (s)),
placed as (
  select doc_id, name, s, i // length as window_number from found
  union all
  select doc_id, name, s, i // length - 1 from found
  where i >= length and i - (i // length - 1) * length < 2 * length - {SHINGLE - 1}),
shares as (
  select doc_id, name, window_number, count(distinct s) / n as share
  from placed join template_sizes using (name) group by doc_id, name, window_number, n),
best as (
  select doc_id, name, max(share) as containment from shares where share >= {CONTAINMENT} group by doc_id, name),
listed as (
  select doc_id, string_agg(name, ',' order by name) as licenses, count(*) as n_licenses,
    min(containment) as least_containment
  from best group by doc_id)
select doc_id, coalesce(licenses, '') as licenses, coalesce(n_licenses, 0) as n_licenses, least_containment
from documents left join listed using (doc_id)
"""
