"""Licence notices in texts, by the Dice coefficient over word bigrams (DataFrame functions only).

A text is looked at by line, by paragraph and as a whole. Each such unit is normalised (lower case,
everything but letters and digits is a blank) and compared to the templates by
``2 * common / (bigrams of the unit + bigrams of the template)``, where repeated bigrams count as
often as they occur. A pair can only reach the threshold t if the two sizes differ by a factor of
at most (2 - t) / t, so units outside every template's bounds are never cut into bigrams, and a
bigram only meets templates within the bounds of its unit.

A notice that shares its line or paragraph with other words, or ends inside another line, is found
by word windows (kind ``window``, place: its first word from 0) that cross lines and sentences. Such
a window holds at least t / (2 - t) of the template's bigrams, so only texts with that many are
looked at, and windows begin and end at bigrams of the template within the size bounds. Of windows
that share words the best is given, and none that shares words with a unit that is a notice.

Defined results: a null text, an empty one or one of a single word has no notice; of templates
with equal scores the first by name is given; rows that repeat an id are scored each on their
own text; other columns are not read.
"""

from __future__ import annotations

import math
import operator
import re
from collections import Counter
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from tillwork.session import stored, written

#: Notices as their licences word them (fixed values; public texts).
TEMPLATES = {
    "AGPL-3.0": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0 (header)": "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
    "BSD": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",
    "CC-BY-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "CC-BY-4.0 (short)": "Licensed under CC BY 4.0.",
    "CC-BY-NC-4.0": "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    "CC-BY-NC-4.0 (short)": "Licensed under CC BY-NC 4.0.",
    "CC-BY-SA-4.0": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    "CC-BY-SA-4.0 (short)": "Licensed under CC BY-SA 4.0.",
    "GPL-2.0": "This work is licensed under the GNU General Public License, version 2.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-3.0 (header)": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "ISC": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
    "MIT": "Released under the MIT License.",
    "MIT (permission)": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.",
    "Unlicense": "This is free and unencumbered software released into the public domain.",
}


def _words(text: Column) -> Column:
    return F.filter(F.split(text, "[ \n]+"), lambda w: w != "")


def _parts(text: Column) -> Column:
    return F.split(text, r"\n *\n[ \n]*", -1)


def _units(texts: DataFrame) -> DataFrame:
    """Columns id, row, kind, place, words: the units of more than one word."""
    parts = _parts(F.col("text"))

    def numbered(kind: str, units: Column) -> Column:
        return F.transform(units, lambda u, i: F.struct(F.lit(kind).alias("kind"), i.alias("place"), u.alias("unit")))

    units = F.concat(
        numbered("line", F.split("text", "\n", -1)),
        F.filter(numbered("paragraph", parts), lambda u: u["unit"].contains("\n")),
        F.when(F.size(parts) > 1, numbered("text", F.array(F.col("text")))).otherwise(F.expr("array()")))
    return (texts.select("id", "row", F.inline(units))
            .select("id", "row", "kind", "place", _words(F.col("unit")).alias("words"))
            .where(F.size("words") > 1))


def _bigrams(words: Column) -> Column:
    return F.transform(F.arrays_zip(F.slice(words, F.lit(1), F.size(words) - 1).alias("a"),
                                    F.slice(words, F.lit(2), F.size(words) - 1).alias("b")),
                       lambda p: F.concat_ws(" ", p["a"], p["b"]))


def _anchors(notices: list[str], threshold: float) -> list[str]:
    """Words of which every window that is a notice holds one: they stand in more of the template's
    bigrams than a notice can lack. Long words come first, as they are rarer."""
    out = set()
    for notice in notices:
        words = re.sub(r"[\W_]+", " ", notice.lower()).split()
        left, most = list(zip(words, words[1:])), len(words) - 1
        lacking = most - math.ceil(most * threshold / (2 - threshold) - 1e-9)
        for word in sorted(set(words), key=lambda w: (-len(w), w)):
            if most - len(left) > lacking:
                break
            left = [g for g in left if word not in g]
            out.add(word)
    return sorted(out)


def _enough(words: Column, notices: list[str], threshold: float) -> Column:
    """Whether the words can hold a window that is a notice.

    Such a window has t / (2 - t) of some template's bigrams, and of those no more begin with the words
    a text shares with the template than with as many of the template's commonest words.
    """
    split = [re.sub(r"[\W_]+", " ", notice.lower()).split() for notice in notices]
    # Words that no template has go first, so that each template meets a short array.
    own = F.array_intersect(words, F.array(*map(F.lit, sorted({w for s in split for w in s}))))

    def shared(some: Column) -> Column:
        bounds = []
        for w in split:
            need, at = math.ceil((len(w) - 1) * threshold / (2 - threshold) - 1e-9), 0
            for _, count in Counter(w[:-1]).most_common():
                need, at = need - count, at + (need > 0)
            bounds.append(F.size(F.array_intersect(some, F.array(*map(F.lit, sorted(set(w)))))) >= at)
        return reduce(operator.or_, bounds)

    return F.transform(F.array(own), shared)[0]


def _windows(texts: DataFrame, known: DataFrame, threshold: float) -> DataFrame:
    """Columns id, row, start, end (words), n, licence, dice: windows that are notices, of each text apart from each other."""
    ratio = (2 - threshold) / threshold
    grams = texts.select("id", "row", F.posexplode(_bigrams(_words(F.col("text")))).alias("pos", "bigram"))
    met = grams.join(F.broadcast(known), "bigram")
    enough = (met.groupBy("row", "licence", "t_size", "bigram", "t_count").agg(F.count(F.lit(1)).alias("c"))
              .groupBy("row", "licence", "t_size").agg(F.sum(F.least("c", "t_count")).alias("common"))
              .where(F.col("common") * ratio >= F.col("t_size") - 1e-9).select("row", "licence"))
    runs = (met.join(enough, ["row", "licence"], "left_semi").groupBy("id", "row", "licence", "t_size")
            .agg(F.sort_array(F.collect_list(F.struct("pos", "bigram", "t_count"))).alias("run")))

    def best_end(run: Column, first: Column, at: Column, size: Column) -> Column:
        """(dice, end, common, seen bigrams) of the best window that begins at a place of the run."""
        zero = F.struct(F.lit(0.0).alias("dice"), F.lit(-1).alias("end"), F.lit(0).alias("common"),
                        F.array().cast("array<string>").alias("seen"))

        def step(acc: Column, x: Column) -> Column:
            new = F.size(F.filter(acc["seen"], lambda b: b == x["bigram"])) < x["t_count"]
            common = acc["common"] + new.cast("int")
            dice = 2 * common / (x["pos"] - first["pos"] + 1 + size)
            better = dice > acc["dice"]
            return F.struct(F.when(better, dice).otherwise(acc["dice"]).alias("dice"),
                            F.when(better, x["pos"]).otherwise(acc["end"]).alias("end"), common.alias("common"),
                            F.concat(acc["seen"], F.array(x["bigram"])).alias("seen"))

        reach = F.floor(ratio * size).cast("int")
        near = F.filter(F.slice(run, at + 1, reach), lambda x: x["pos"] < first["pos"] + reach)
        return F.aggregate(near, zero, step)

    ends = F.transform("run", lambda first, at: F.struct(first["pos"].alias("start"), best_end(F.col("run"), first, at, F.col("t_size")).alias("best")))
    found = (runs.select("id", "row", "licence", F.explode(ends).alias("w")).where(F.col("w.best.dice") >= threshold)
             .select("id", "row", "licence", F.col("w.start").alias("start"), F.col("w.best.end").alias("end"), F.col("w.best.dice").alias("dice"))
             .groupBy("id", "row", "licence", "end").agg(F.max(F.struct("dice", "start")).alias("best"))
             .select("id", "row", "licence", "best.start", "end", "best.dice"))

    # From left to right: a window that shares words with the last one takes its place if it is better.
    kind = "array<struct<start:int,end:int,dice:double,licence:string>>"

    def placed(acc: Column, w: Column) -> Column:
        last = F.element_at(acc, -1)
        better = (w["dice"] > last["dice"]) | ((w["dice"] == last["dice"]) & (w["licence"] < last["licence"]))
        return (F.when((F.size(acc) == 0) | (w["start"] > F.get(acc, F.size(acc) - 1)["end"] + 1), F.concat(acc, F.array(w)))
                .when(better, F.concat(F.slice(acc, F.lit(1), F.size(acc) - 1), F.array(w))).otherwise(acc))

    rows = found.groupBy("id", "row").agg(F.sort_array(F.collect_list(F.struct("start", "end", "dice", "licence"))).alias("all"))
    return (rows.select("id", "row", F.inline(F.aggregate(F.col("all").cast(kind), F.array().cast(kind), placed)))
            .select("id", "row", "start", (F.col("end") + 1).alias("end"), (F.col("end") - F.col("start") + 1).alias("n"), "licence", "dice"))


def licence_notices(docs: DataFrame, templates: dict[str, str] | None = None, threshold: float = 0.8,
                    id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """A row per unit that is a notice: id, kind, place (from 0), n_bigrams, licence, dice."""
    spark = docs.sparkSession
    texts = spark.createDataFrame(sorted((templates or TEMPLATES).items()), "licence string, notice string")
    split = texts.select("licence", F.filter(F.split(F.regexp_replace(F.lower("notice"), r"[^\p{L}\p{N}]+", " "), " "),
                                             lambda w: w != "").alias("words"))
    known = (split
             .select("licence", (F.size("words") - 1).alias("t_size"), F.explode(_bigrams(F.col("words"))).alias("bigram"))
             .groupBy("licence", "t_size", "bigram").agg(F.count(F.lit(1)).alias("t_count")))
    low, high = split.select(F.min(F.size("words")), F.max(F.size("words"))).first()
    texts = docs.select(
        F.col(id_column).alias("id"), F.monotonically_increasing_id().alias("row"),
        F.regexp_replace(F.lower(F.col(text_column).cast("string")), r"[^\p{L}\p{N}\n]+", " ").alias("text"))
    found = _notices(texts, known, low, high, threshold).select("id", "kind", "place", "n", "licence", "dice")

    def windows() -> DataFrame:
        notices = [*(templates or TEMPLATES).values()]
        anchors, words = F.array(*map(F.lit, _anchors(notices, threshold))), _words(F.col("text"))
        some = written(texts.where(F.arrays_overlap(words, anchors)).where(_enough(words, notices, threshold)), "licence-texts")
        free = written(_windows(some, known, threshold), "licence-found")
        # What a unit shows already is not given again: units of the texts that have windows.
        some = written(some.join(free.select("row").distinct(), "row", "left_semi"), "licence-near")
        units = written(_notices(some, known, low, high, threshold).select("row", "kind", "place"), "licence-units")
        word = F.posexplode(F.flatten(F.transform("units", lambda u, i: F.transform(_words(u), lambda w: i)))).alias("at", "place")
        split = {"line": F.split("text", "\n", -1), "paragraph": _parts(F.col("text")), "text": F.array(F.col("text"))}
        spans = None
        for kind, parts in split.items():
            span = (some.select("row", parts.alias("units")).select("row", word).groupBy("row", "place")
                    .agg(F.min("at").alias("first"), F.max("at").alias("last"))
                    .join(units.where(F.col("kind") == kind), ["row", "place"], "left_semi").select("row", "first", "last"))
            spans = span if spans is None else spans.unionByName(span)
        spans = spans.withColumnRenamed("row", "of")
        free = free.join(
            spans, (F.col("row") == F.col("of")) & (F.col("start") <= F.col("last")) & (F.col("end") >= F.col("first")), "left_anti")
        return free.select("id", F.lit("window").alias("kind"), F.col("start").alias("place"), "n", "licence", "dice")

    return (found.unionByName(stored(spark, "licence-windows", windows))
            .select(F.col("id").alias(id_column), "kind", "place", F.col("n").alias("n_bigrams"), "licence", F.round("dice", 6).alias("dice")))


def _notices(texts: DataFrame, known: DataFrame, low: int, high: int, threshold: float) -> DataFrame:
    """Columns id, row, kind, place, n, licence, dice: the units that are notices."""
    ratio = (2 - threshold) / threshold
    sized = _units(texts).withColumn("n", F.size("words") - 1)
    near = sized.where(F.col("n").between((low - 1) / ratio - 1, high * ratio + 1))
    grams = near.select("id", "row", "kind", "place", "n", F.explode(_bigrams(F.col("words"))).alias("bigram"))
    # The templates are a given list, not data; only bigrams that a template has are shuffled.
    shared = (grams.join(F.broadcast(known), "bigram")
              .where((F.col("n") <= ratio * F.col("t_size")) & (F.col("t_size") <= ratio * F.col("n")))
              .groupBy("id", "row", "kind", "place", "n", "licence", "t_size", "bigram", "t_count")
              .agg(F.count(F.lit(1)).alias("u_count"))
              .groupBy("id", "row", "kind", "place", "n", "licence", "t_size")
              .agg(F.sum(F.least("u_count", "t_count")).alias("common")))
    scored = shared.withColumn("dice", 2 * F.col("common") / (F.col("n") + F.col("t_size"))).where(F.col("dice") >= threshold)
    best = scored.groupBy("id", "row", "kind", "place", "n").agg(
        F.min(F.struct((-F.col("dice")).alias("worse"), "licence")).alias("best"))
    return best.select("id", "row", "kind", "place", "n", "best.licence", (-F.col("best.worse")).alias("dice"))
