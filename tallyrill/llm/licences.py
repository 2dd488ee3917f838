"""Licence recognition by sentences and ordered rules.

Texts are split into sentences, which are normalised and looked up among known licence sentences. The
identifiers that a document has, in order, are then matched against rules, each an ordered sequence of
identifiers for one licence.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyrill.llm.base import texts

GAP = 3  # unknown sentences allowed between two of a rule

# fixed values: sentences of public licence texts and notices, by identifier
SENTENCES = {
    "mit-grant": 'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:',
    "mit-notice": "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
    "mit-warranty": 'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT.',
    "mit-liability": "IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.",
    "isc-grant": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
    "bsd-grant": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",
    "bsd-source": "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.",
    "bsd-binary": "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.",
    "bsd-names": "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.",
    "apache-grant": 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License.',
    "apache-copy": "You may obtain a copy of the License at",
    "apache-basis": 'Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.',
    "apache-short": "Licensed under the Apache License, Version 2.0.",
    "mit-short": "Released under the MIT License.",
    "mit-short-2": "Licensed under the MIT License.",
    "gpl-share": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "gpl2-share": "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version.",
    "gpl-hope": "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.",
    "gpl3-short": "This work is licensed under the GNU General Public License, version 3.",
    "mpl2-grant": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    "unlicense-grant": "This is free and unencumbered software released into the public domain.",
    "boost-grant": "Distributed under the Boost Software License, Version 1.0.",
}
# fixed values: rules as (licence, identifiers in order)
RULES = [
    ("MIT", ("mit-grant", "mit-notice", "mit-warranty", "mit-liability")),
    ("MIT", ("mit-grant", "mit-notice")),
    ("MIT", ("mit-short",)),
    ("MIT", ("mit-short-2",)),
    ("ISC", ("isc-grant",)),
    ("BSD-3-Clause", ("bsd-grant", "bsd-source", "bsd-binary", "bsd-names")),
    ("BSD-2-Clause", ("bsd-grant", "bsd-source", "bsd-binary")),
    ("Apache-2.0", ("apache-grant", "apache-copy", "apache-basis")),
    ("Apache-2.0", ("apache-grant",)),
    ("Apache-2.0", ("apache-short",)),
    ("GPL-3.0-or-later", ("gpl-share", "gpl-hope")),
    ("GPL-3.0-or-later", ("gpl-share",)),
    ("GPL-2.0-or-later", ("gpl2-share", "gpl-hope")),
    ("GPL-2.0-or-later", ("gpl2-share",)),
    ("GPL-3.0-only", ("gpl3-short",)),
    ("MPL-2.0", ("mpl2-grant",)),
    ("Unlicense", ("unlicense-grant",)),
    ("BSL-1.0", ("boost-grant",)),
]


def _creative_commons() -> tuple[dict[str, str], list[tuple[str, tuple[str, ...]]]]:
    """Short notices of all variants and versions, by rule."""
    sentences, rules = {}, []
    for kind in ("BY", "BY-SA", "BY-NC", "BY-ND", "BY-NC-SA", "BY-NC-ND"):
        for version in ("2.0", "2.5", "3.0", "4.0"):
            for i, opening in enumerate(("Licensed under", "This work is licensed under")):
                name = f"cc-{kind.lower()}-{version}-{i}"
                sentences[name] = f"{opening} CC {kind} {version}."
                rules.append((f"CC-{kind}-{version}", (name,)))
    return sentences, rules


_CC = _creative_commons()
SENTENCES |= _CC[0]
RULES += _CC[1]


def normal(sentence: str) -> str:
    """Lower case, runs of anything but letters and digits as one space."""
    return re.sub("[^a-z0-9]+", " ", sentence.lower()).strip()


def normalised(sentence: str) -> Column:
    """As ``normal`` does."""
    return F.trim(F.regexp_replace(F.lower(sentence), "[^a-z0-9]+", " "))


def sentences(docs: DataFrame) -> DataFrame:
    """Sentences end at a full stop, question or exclamation mark before white space, at a colon before a capital, or at a line end.

    A line that goes on in the same case in the next one, or ends in a word that ends no sentence, is wrapped;
    comment signs between go.
    """
    signs = "[ \\t]*\\n[ \\t#*/;-]*"
    wraps = "|".join(
        [
            f'(?<=[a-z,;")(]){signs}(?!http)(?=[a-z("])',
            f'(?<=[A-Z,]){signs}(?=[A-Z]{{2}}|")',
            f"(?<= (?:the|of|a|to|and|or|in|for|by|with|this|is)){signs}(?=[A-Z])",
        ]
    )
    ends = "(?<=[.!?])[\\s\"']+|(?<=:)\\s+(?=[A-Z])|\\n+"
    return docs.select("*", F.posexplode(F.split(F.regexp_replace("text", wraps, " "), ends)).alias("sentence_no", "sentence")).drop("text")


def matches(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", known: dict[str, str] | None = None, rules: list[tuple[str, tuple[str, ...]]] | None = None) -> DataFrame:
    """One row per licence found: ``doc_id``, ``licence``, ``first_sentence``, ``last_sentence`` (from 0), ``sentences`` (identifiers).

    From the left, the longest rule that fits at a known sentence wins and its sentences are used up; up to
    ``GAP`` unknown ones may lie between. Null and empty texts have no rows; rows that repeat an id and a
    text give equal rows, once each.
    """
    spark: SparkSession = docs.sparkSession
    known, rules = known or SENTENCES, rules or RULES
    own = texts(docs, id_col, text_col).withColumn("text_key", F.xxhash64("text"))
    table = spark.createDataFrame([(name, normal(s)) for name, s in known.items()], "name string, plain string")
    split = sentences(own).withColumn("plain", normalised("sentence"))
    # as long as the table of known sentences, which is a parameter
    hits = split.join(F.broadcast(table), "plain")
    longest = max(len(ids) for _, ids in rules)
    # a document's known sentences in order
    per_doc = hits.groupBy("doc_id", "text_key").agg(F.array_sort(F.collect_set(F.struct("sentence_no", "name"))).alias("hits"))
    by_ids = F.create_map(*[x for licence, ids in rules for x in (F.lit("|".join(ids)), F.lit(licence))])
    walk = F.expr(
        f"""aggregate(sequence(0, size(hits) - 1), named_struct('free', 0, 'found', cast(array() as array<array<struct<sentence_no:int,name:string>>>)),
        (x, i) -> get(transform(array(get(filter(transform(sequence({longest}, 1, -1), m -> slice(hits, i + 1, m)), c -> i >= x.free
            AND map_contains_key(rules, array_join(transform(c, h -> h.name), '|'))
            AND size(filter(c, (h, k) -> k > 0 AND h.sentence_no - get(c, k - 1).sentence_no > {GAP + 1})) = 0), 0)), best ->
          IF(best IS NULL, x, named_struct('free', i + size(best), 'found', concat(x.found, array(best))))), 0)).found"""
    )
    each = per_doc.withColumn("rules", by_ids).select("doc_id", "text_key", "rules", F.explode(walk).alias("m"))
    names = F.transform("m", lambda h: h["name"])
    return each.select("doc_id", F.element_at("rules", F.array_join(names, "|")).alias("licence"), F.expr("get(m, 0).sentence_no").alias("first_sentence"), F.expr("element_at(m, -1).sentence_no").alias("last_sentence"), F.array_join(names, ",").alias("sentences"))
