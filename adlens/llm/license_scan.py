"""Licence notices in texts: Dice coefficient over word bigrams against templates.

Every line and every paragraph (lines between blank lines) of a text is a passage. A passage is normalised
(A-Z lower-cased, everything but letters and digits is a space) and compared to each template whose number
of different bigrams allows the least coefficient d at all: between d / (2 - d) and (2 - d) / d times the
passage's. A passage that reaches d shares more than d / (2 - d) of a template's bigrams, so it must hold one
of a few words that occur in the others; texts without any of these words are not even split. Passages meet
templates by an equal join on their size. Only DataFrame functions are used; what is shuffled are matches,
and id and digest of the texts that hold one of the words.

Defined cases: a null text is empty; a passage of fewer than two words has no bigrams and never matches;
equal coefficients are won by the name that sorts first; repeated rows each get a row.
"""

from __future__ import annotations

import json
import math
import re
from collections import Counter

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

LEAST_DICE = 0.8
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: The usual notices by which works state their licence.
TEMPLATES = [
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at"),
    ("BSD", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("BSD", "Released under the BSD License."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at"),
    ("proprietary", "All rights reserved. No part of this publication may be reproduced, distributed, or transmitted in any form or by any means without the prior written permission of the publisher."),
]

#: Words too frequent in any text to tell where a notice may be; used only if nothing else is left.
WIDESPREAD = set(
    "a all and any are as at be by can conditions copy following for free if in is it may modification no not of on or part"
    " person provided source subject that the this to under use version was with without work you 0 1 2 3 4".split()
)


def bigrams_of(text: str) -> list[str]:
    words = re.sub(r"[^a-z0-9]+", " ", text.lower()).split()
    return sorted({f"{a} {b}" for a, b in zip(words, words[1:], strict=False)})


def needed_words(templates: list[tuple[str, str]], least: float) -> list[str]:
    """Words of which every passage that reaches `least` with some template holds at least one."""
    chosen: set[str] = set()
    for _, text in templates:
        own = bigrams_of(text)
        shared = math.ceil(least / (2 - least) * len(own) - 1e-9)  # a match shares so many at least
        left = [b for b in own if not chosen & set(b.split())]
        while len(left) >= shared:
            words = Counter(w for b in left for w in set(b.split()))
            word = max(words, key=lambda w: (w not in WIDESPREAD, words[w], len(w), w))
            chosen.add(word)
            left = [b for b in left if word not in b.split()]
    return sorted(chosen)


def _by_size(spark: SparkSession, templates: list[tuple[str, str]], least: float) -> DataFrame:
    """`_size`, `_template`, `license`, `_own` (bigrams): every size that a passage like the template can have."""
    known = []
    for number, (name, text) in enumerate(templates):
        own = bigrams_of(text)
        lo = math.ceil(len(own) * least / (2 - least) - 1e-9)
        hi = math.floor(len(own) * (2 - least) / least + 1e-9)
        known.append({"number": number, "name": name, "lo": lo, "hi": hi, "own": own})
    schema = "array<struct<number:int,name:string,lo:int,hi:int,own:array<string>>>"
    rows = spark.range(1).select(F.inline(F.from_json(F.lit(json.dumps(known)), schema)))
    return rows.select(
        F.explode(F.sequence("lo", "hi")).alias("_size"),
        F.col("number").alias("_template"),
        F.col("name").alias("license"),
        F.col("own").alias("_own"),
    )


def scan(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    templates: list[tuple[str, str]] = TEMPLATES,
    least: float = LEAST_DICE,
) -> DataFrame:
    """`id`, `n_passages`, `licenses` (names, sorted), `best_license`, `best_dice`, `matches` for every row of `docs`.

    `matches` holds a structure (`passage`, `license`, `dice`) for each passage and template that match.
    """
    # whole words, A-Z in either case; the look behind comes first, so that words are tried only where one begins
    words = "|".join(needed_words(templates, least))
    pattern = rf"(?i)(?<![\p{{L}}\p{{N}}])(?:{words})(?![\p{{L}}\p{{N}}])"

    def may_match(text: Column) -> Column:
        return F.rlike(text, F.lit(pattern))

    packed = docs.select(F.col(f"`{id_col}`").alias("id"), F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("_text"))
    hinted = packed.filter(may_match(F.col("_text"))).withColumn("_digest", F.sha2(F.encode("_text", "UTF-8"), 256))
    paragraphs = F.filter(F.split("_text", "\n\n"), lambda p: F.contains(p, F.lit("\n")))
    passages = (
        hinted.select("id", "_digest", F.posexplode(F.concat(F.split("_text", "\n"), paragraphs)).alias("_at", "passage"))
        .filter(may_match(F.col("passage")))
        .withColumn("_plain", F.regexp_replace(F.translate("passage", UPPER, LOWER), r"[^\p{L}\p{N}]+", " "))
        .withColumn("_words", F.filter(F.split("_plain", " "), lambda w: w != ""))
        .withColumn("_pairs", F.greatest(F.size("_words") - 1, F.lit(0)))
        .withColumn(
            "_bigrams",
            F.array_distinct(
                F.zip_with(
                    F.slice("_words", F.lit(1), F.col("_pairs")),
                    F.slice("_words", F.lit(2), F.col("_pairs")),
                    lambda a, b: F.concat_ws(" ", a, b),
                )
            ),
        )
        .withColumn("_size", F.size("_bigrams"))
    )
    # Size bound: the given templates, a row for each passage size that they allow.
    found = (
        passages.join(F.broadcast(_by_size(docs.sparkSession, templates, least)), "_size")
        .withColumn("_shared", F.size(F.array_intersect("_bigrams", "_own")))
        .withColumn("dice", 2.0 * F.col("_shared") / (F.col("_size") + F.size("_own")))
        .filter(F.col("dice") >= least - 1e-9)
        .groupBy("id", "_digest")
        .agg(F.array_sort(F.collect_set(F.struct("_at", "_template", "passage", "license", "dice"))).alias("_found"))
        .withColumnsRenamed({"id": "_id", "_digest": "_own_digest"})
    )
    nothing = F.array().cast("array<struct<_at:int,_template:int,passage:string,license:string,dice:double>>")
    same = hinted["id"].eqNullSafe(F.col("_id")) & (hinted["_digest"] == F.col("_own_digest"))
    some = hinted.drop("_text").join(found, same, "left").select("id", F.coalesce("_found", nothing).alias("_found"))
    none = packed.filter(~may_match(F.col("_text"))).select("id", nothing.alias("_found"))
    rows = none.unionByName(some)
    order = F.array_sort(F.transform("_found", lambda m: F.struct((-m["dice"]).alias("less"), m["license"].alias("license"))))
    return rows.withColumn("_best", F.get(order, F.lit(0))).select(
        "id",
        F.size(F.array_distinct(F.transform("_found", lambda m: m["_at"]))).cast("long").alias("n_passages"),
        F.array_sort(F.array_distinct(F.transform("_found", lambda m: m["license"]))).alias("licenses"),
        F.col("_best.license").alias("best_license"),
        (-F.col("_best.less")).alias("best_dice"),
        F.transform("_found", lambda m: F.struct(m["passage"], m["license"], m["dice"])).cast(
            "array<struct<passage:string,license:string,dice:double>>"
        ).alias("matches"),
    )
