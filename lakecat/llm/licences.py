"""Licence scans: TF-IDF cosine to licence texts, headers and notices, then inheritance along directories.

Terms weigh by how few documents of the corpus hold them. A line's vector has each of its terms once and is compared
with one-line notices. Whole texts and standard headers are compared with windows of as many terms, whatever the line ends, by
counts of terms. Terms outside the templates weigh as if one document held them. SPDX tags name a licence as they stand. A
file's licence is that of its best line, window or tag. A file without one has the licence of
the nearest directory above it that holds a licence file. Column expressions and joins only.
"""

from __future__ import annotations

import json
import math
from collections import Counter
from importlib import resources

from pyspark.sql import Column, DataFrame, functions as F

from lakecat.llm.common import small, text_or_empty
from lakecat.session import written

#: Names of licences and the notices that texts carry.
NOTICES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "BSD-3-Clause": "Redistribution and use in source and binary forms, with or without modification, are permitted.",
    "CC-BY-4.0": "Licensed under CC BY 4.0.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "CC-BY-SA-4.0": "Licensed under CC BY-SA 4.0.",
    "CC0-1.0": "Dedicated to the public domain under CC0 1.0 Universal.",
    "GPL-2.0": "This work is licensed under the GNU General Public License, version 2.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "ISC": "Permission to use, copy, modify, and distribute this software for any purpose is hereby granted.",
    "LGPL-3.0": "This work is licensed under the GNU Lesser General Public License, version 3.",
    "MIT": "Released under the MIT License.",
    "MPL-2.0": "Licensed under the Mozilla Public License, version 2.0.",
}
GNU_HEADER = """This {0} is free software: you can redistribute it and/or modify it under the terms of the GNU {1} General Public
License as published by the Free Software Foundation, either version {2} of the License, or (at your option) any later version.
This {0} is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of
MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU {1} General Public License for more details."""
CC_HEADER = """This work is licensed under the Creative Commons {0} 4.0 International License. To view a copy of this license, visit
http://creativecommons.org/licenses/{1}/4.0/ or send a letter to Creative Commons, PO Box 1866, Mountain View, CA 94042, USA."""
#: Standard headers of files. The whole texts are in the folder licence_texts.
HEADERS = {
    "Apache-2.0": """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance
        with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by
        applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT
        WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing
        permissions and limitations under the License.""",
    "CC-BY-4.0": CC_HEADER.format("Attribution", "by"),
    "CC-BY-NC-4.0": CC_HEADER.format("Attribution-NonCommercial", "by-nc"),
    "CC-BY-SA-4.0": CC_HEADER.format("Attribution-ShareAlike", "by-sa"),
    "GPL-2.0": GNU_HEADER.format("program", "", "2"),
    "GPL-3.0": GNU_HEADER.format("program", "", "3"),
    "LGPL-2.1": GNU_HEADER.format("library", "Lesser", "2.1"),
    "LGPL-3.0": GNU_HEADER.format("library", "Lesser", "3"),
    "MPL-2.0": """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not
        distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.""",
}
#: A window begins at every so manieth part of its template's terms.
STEPS = 32
SPDX_ID = r"\(*[A-Za-z0-9]+(?:[.+-]+[A-Za-z0-9]+)*\+?\)*"
SPDX_TAG = rf"SPDX-License-Identifier:[ \t]*({SPDX_ID}(?:[ \t]+(?:AND|OR|WITH)[ \t]+{SPDX_ID})*)"
TERM = r"([a-z0-9]+(?:[.+-][a-z0-9]+)*)"
#: The cosine from which on a line is a notice, and names of files that license their directory.
LEAST_COSINE = 0.8
LICENCE_FILE = r"(?i)^(licen[sc]e|copying|unlicense)([._-].*)?$"


def literal_table(spark, rows: list[tuple], schema: str) -> DataFrame:
    """A small table as a literal: the executors run no Python for it."""
    kinds = dict(part.split() for part in schema.split(", "))
    fields = ", ".join(f"{name}: {kind}" for name, kind in kinds.items())
    found = F.from_json(F.lit(json.dumps([dict(zip(kinds, row)) for row in rows])), f"array<struct<{fields}>>")
    return spark.range(0, 1, 1, 1).select(F.inline(found))


def all_terms(text: Column) -> Column:
    """The terms of a text, lower-cased, in order."""
    return F.regexp_extract_all(F.lower(text), F.lit(TERM))


def terms(text: Column) -> Column:
    """The distinct terms of a text, lower-cased."""
    return F.array_distinct(all_terms(text))


def notice_terms(spark) -> dict[str, list[str]]:
    rows = literal_table(spark, list(NOTICES.items()), "name string, notice string")
    return {r["name"]: r["terms"] for r in rows.select("name", terms(F.col("notice")).alias("terms")).collect()}


def templates(spark) -> list[tuple[str, list[str]]]:
    """Names of licences and the terms, in order, of their whole texts and headers."""
    whole = [(f.name.removesuffix(".txt"), f.read_text()) for f in resources.files(__package__).joinpath("licence_texts").iterdir()]
    rows = literal_table(spark, sorted(whole) + list(HEADERS.items()), "name string, text string")
    return [(r["name"], r["terms"]) for r in rows.select("name", all_terms(F.col("text")).alias("terms")).collect()]


def weights(docs: DataFrame, text: str, vocabulary: list[str]) -> tuple[dict[str, float], float]:
    """The weight of each term of the notices, by document counts over the whole corpus, and of any other term."""
    held = F.array_intersect(terms(F.col(text)), F.array(*map(F.lit, vocabulary)))
    counts = {r["term"]: r["n"] for r in docs.select(F.explode(held).alias("term")).groupBy("term").agg(
        F.count("*").alias("n")).collect()}  # one row per term of the notices
    total = docs.count()

    def weight(n: int) -> float:
        return math.log((1 + total) / (1 + n)) + 1

    return {term: weight(counts.get(term, 0)) for term in vocabulary}, weight(1)


def telling_terms(unit: dict[str, float], least: float) -> list[str]:
    """The heaviest terms of a notice of which a line must hold one to come to the least cosine.

    By the Cauchy-Schwarz inequality a line's cosine is at most the root of the notice's squared weights that it shares.
    """
    out, rest = [], 1.0
    for term, value in sorted(unit.items(), key=lambda x: (-x[1], x[0])):
        if rest < least * least - 1e-9:
            break
        out.append(term)
        rest -= value * value
    return out


def mass(count: Column, weight: Column) -> Column:
    """What a term adds to a vector: its weight, more for each further time by the logarithm."""
    return (1 + F.log(count)) * weight


def best_windows(
    docs: DataFrame, key: list[str], text: str, least: float, made: list[tuple[str, list[str]]], weight: dict[str, float], other: float,
) -> DataFrame:
    """Windows that come to the least cosine with a whole text or header: the key columns, name, score.

    To come to it, a window must hold a telling term of the template and as many of its terms as the heaviest need to
    come to it, and so must the text. Only such texts are cut into windows, and only such windows are taken apart.
    """
    spark = docs.sparkSession
    rows, shares, telling = [], [], set()
    for number, (name, found) in enumerate(made):
        masses = {term: (1 + math.log(n)) * weight[term] for term, n in Counter(found).items()}
        norm = math.sqrt(sum(x * x for x in masses.values()))
        unit = {term: x / norm for term, x in masses.items()}
        shares += [(number, term, share) for term, share in unit.items()]
        telling |= set(telling_terms(unit, least))
        held, needed = 0.0, 0
        for share in sorted(unit.values(), reverse=True):
            if held >= least * least - 1e-9:
                break
            held, needed = held + share * share, needed + 1
        step = max(1, len(found) // STEPS)
        rows.append((number, name, sorted(unit), needed, len(found) + step, step))
    numbered = docs.select(*key, text_or_empty(text).alias("text"))
    sequences = numbered.select(*key, F.xxhash64("text").alias("doc"), all_terms(F.col("text")).alias("terms"))
    sequences = sequences.filter(F.arrays_overlap("terms", F.array(*map(F.lit, sorted(telling)))))
    table = literal_table(
        spark, rows, "template int, name string, of array<string>, needed int, width int, step int")
    pairs = sequences.withColumn("distinct", F.array_distinct("terms")).join(F.broadcast(table)).filter(
        F.size(F.array_intersect("distinct", "of")) >= F.col("needed"))
    starts = F.sequence(F.lit(1), F.greatest(F.lit(1), F.size("terms") - F.col("width") + F.col("step")), F.col("step"))
    def window(start: Column) -> Column:
        return F.slice("terms", start, F.col("width"))

    kept = F.filter(starts, lambda start: F.size(F.array_intersect(window(start), "of")) >= F.col("needed"))
    near = pairs.withColumn("starts", kept).filter(F.size("starts") > 0).select(
        *key, "doc", "template", "name", F.explode(F.transform("starts", lambda start: F.struct(
            start.alias("start"), window(start).alias("window")))).alias("w")).select(
        *key, "doc", "template", "name", "w.*").dropDuplicates([*key, "doc", "template", "start"])
    at = [*key, "doc", "template", "name", "start"]
    counted = near.select(*at, F.explode("window").alias("term")).groupBy(*at, "term").agg(F.count("*").alias("n"))
    weight_of = literal_table(spark, list(weight.items()), "term string, weight double")
    share_of = literal_table(spark, shares, "template int, term string, share double")
    weighed = counted.join(F.broadcast(weight_of), "term", "left").join(F.broadcast(share_of), ["template", "term"], "left")
    value = mass(F.col("n"), F.coalesce("weight", F.lit(other)))
    return weighed.groupBy(*at).agg(
        F.sum(value * F.coalesce("share", F.lit(0.0))).alias("dot"), F.sqrt(F.sum(value * value)).alias("norm")).select(
        *key, "name", F.round(F.col("dot") / F.col("norm"), 9).alias("score")).filter(F.col("score") >= least)


def tagged(docs: DataFrame, key: list[str], text: str) -> DataFrame:
    """Licences that SPDX tags name, with score 1: an id without -only, -or-later or +, or an expression of such ids."""
    held = docs.filter(F.col(text).contains("SPDX-License-Identifier:"))
    tags = held.select(*key, F.explode(F.regexp_extract_all(F.col(text), F.lit(SPDX_TAG))).alias("tag"))
    return tags.select(*key, F.regexp_replace("tag", r"(-only|-or-later|\+)(?![A-Za-z0-9.-])", "").alias("name"), F.lit(1.0).alias("score"))


def best_notices(docs: DataFrame, key: list[str], text: str = "text", least: float = LEAST_COSINE) -> DataFrame:
    """The best licence of each row that has one: the key columns, licence, score.

    All lines of whole texts count, and all windows. Only lines that hold a telling term are taken apart. Of
    equal scores the first name counts; rows with equal keys are one. Null and empty texts have none.
    """
    spark = docs.sparkSession
    notices, made = notice_terms(spark), templates(spark)
    vocabulary = sorted({term for found in notices.values() for term in found})
    weight, other = weights(docs, text, sorted({*vocabulary, *(term for _, found in made for term in found)}))
    windows = best_windows(docs, key, text, least, made, weight, other)
    units = {}
    for name, found in notices.items():
        norm = math.sqrt(sum(weight[term] ** 2 for term in found))
        units[name] = {term: weight[term] / norm for term in found}
    telling = sorted({term for unit in units.values() for term in telling_terms(unit, least)})
    lines = docs.select(*key, F.explode(F.split(text_or_empty(text), "\n")).alias("line"))
    found = lines.withColumn("terms", terms(F.col("line"))).filter(
        F.arrays_overlap("terms", F.array(*map(F.lit, telling))))
    table = literal_table(
        spark, [(term, weight[term], {name: unit[term] for name, unit in units.items() if term in unit}) for term in vocabulary],
        "term string, weight double, shares map<string,double>")
    numbered = found.select(*key, F.xxhash64("line").alias("line"), "terms").dropDuplicates([*key, "line"])
    weighed = numbered.select(*key, "line", F.explode("terms").alias("term")).join(F.broadcast(table), "term", "left")
    value = F.coalesce(F.col("weight"), F.lit(other))
    norms = weighed.groupBy(*key, "line").agg(F.sqrt(F.sum(value * value)).alias("norm"))
    dots = weighed.select(*key, "line", "weight", F.explode("shares").alias("name", "share")).groupBy(*key, "line", "name").agg(
        F.sum(F.col("weight") * F.col("share")).alias("dot"))
    same = [dots[c].eqNullSafe(norms[c]) for c in [*key, "line"]]
    joined = dots.join(norms, same)
    scored = joined.select(
        *[dots[c] for c in key], F.col("name"), F.round(F.col("dot") / F.col("norm"), 9).alias("score"))
    every = scored.filter(F.col("score") >= least).unionByName(windows).unionByName(tagged(docs, key, text))
    return every.groupBy(*key).agg(
        F.min(F.struct((-F.col("score")).alias("s"), "name")).alias("b")).select(
        *key, F.col("b.name").alias("licence"), (-F.col("b.s")).alias("score"))


def directory(path: Column) -> Column:
    """The directory of a path, '' at the top."""
    return F.regexp_replace(path, r"/?[^/]*$", "")


def inherited(directories: DataFrame, licensed: DataFrame) -> DataFrame:
    """For each directory the nearest licensed one at or above it: directory, licence, score, origin.

    `directories` has distinct directories, `licensed` has directory, licence, score, origin. Every directory is
    joined to all its ancestors by path, and the longest that matches wins.
    """
    parts = F.split("directory", "/")
    above = directories.select("directory", F.explode(F.sequence(F.lit(0), F.size(parts))).alias("depth")).withColumn(
        "ancestor", F.array_join(F.slice(parts, F.lit(1), F.col("depth")), "/"))
    held = licensed.withColumnRenamed("directory", "ancestor")
    return above.join(held, "ancestor").groupBy("directory").agg(
        F.max_by(F.struct("licence", "score", "origin"), "depth").alias("b")).select("directory", "b.*")


def scan(files: DataFrame, path: str = "path", text: str = "text", least: float = LEAST_COSINE) -> DataFrame:
    """Every file's licence: path, licence, score, origin (the path that it comes from), by ('own', 'inherited', null).

    Of several licence files in a directory the best score counts, then the smaller path. Files without a path can
    only have a licence of their own. Rows with equal paths are one file with all their lines; each is returned.
    Paths are joined, not texts; directories resolve once each, so a hot directory is one row until its files are met.
    """
    rows = files.select(F.col(path).alias("path"), F.col(text).alias("text"))
    own = written(best_notices(rows, ["path"], least=least), "licences-own")
    licence_files = own.filter(F.regexp_extract("path", r"[^/]*$", 0).rlike(LICENCE_FILE))
    licensed = licence_files.groupBy(directory(F.col("path")).alias("directory")).agg(
        F.min(F.struct((-F.col("score")).alias("s"), "path", "licence")).alias("b")).select(
        "directory", F.col("b.licence").alias("licence"), (-F.col("b.s")).alias("score"), F.col("b.path").alias("origin"))
    paths = rows.select("path", directory(F.col("path")).alias("directory"))
    above = written(inherited(
        paths.filter("directory IS NOT NULL").select("directory").distinct(), licensed), "licences-inherited")
    own_named = small(own.select(
        F.col("path").alias("own_path"), F.col("licence").alias("own_licence"), F.col("score").alias("own_score")))
    joined = paths.join(own_named, F.col("path").eqNullSafe(F.col("own_path")), "left").join(small(above), "directory", "left")
    mine = F.col("own_licence").isNotNull()
    return joined.select(
        "path", F.coalesce("own_licence", "licence").alias("licence"),
        F.when(mine, F.col("own_score")).otherwise(F.col("score")).alias("score"),
        F.when(mine, F.col("path")).otherwise(F.col("origin")).alias("origin"),
        F.when(mine, F.lit("own")).when(F.col("licence").isNotNull(), F.lit("inherited")).alias("by"))
