"""Licence scans by sentences and ordered rules. DataFrame and SQL functions only.

Texts are split into sentences, which are normalised (lower case, letters, digits and dots inside numbers, single blanks) and
mapped to identifiers of known licence sentences. A known sentence starts and ends where a line or a sentence does; inside it
lines may be wrapped anywhere (with blank lines and comment signs), the longest known sentence at a place counts.
The sequence of identifiers in a document is matched against
ordered rules: a rule is a sequence of identifiers that have to follow each other, unknown sentences between them
aside; the first rule that matches at a place wins there, longer rules come first.

Both tables are parameters: (identifier, sentence) and (licence, identifiers in order).

Defined results: null and empty texts hold no licence: empty lists. Repeated sentences count each time. Rows are kept one
to one. Rules that can never match (an identifier without a sentence) are allowed.
"""
from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Known licence sentences and the identifiers of their meanings.
SENTENCES = (
    ("apache2-name", "Licensed under the Apache License, Version 2.0."),
    ("apache2-name", "Licensed under the Apache License, Version 2.0 (the \"License\");"),
    ("apache2-may-not", "You may not use this file except in compliance with the License."),
    ("apache2-copy", "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0"),
    ("apache2-copy", "You may obtain a copy of the License at https://www.apache.org/licenses/LICENSE-2.0"),
    ("apache2-copy", "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable "
                     "law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT "
                     "WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied."),
    ("apache2-copy", "You may obtain a copy of the License at https://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable "
                     "law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT "
                     "WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied."),
    ("apache2-short", "Apache License Version 2.0"),
    ("apache2-short", "Apache License Version 2.0, January 2004"),
    ("mit-name", "Released under the MIT License."),
    ("mit-name", "This project is licensed under the MIT License."),
    ("mit-name", "Licensed under the MIT License."),
    ("mit-grant", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
                  "documentation files (the \"Software\"), to deal in the Software without restriction"),
    ("mit-grant", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
                  "documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation "
                  "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to "
                  "permit persons to whom the Software is furnished to do so, subject to the following conditions:"),
    ("as-is", "The software is provided \"as is\", without warranty of any kind, express or implied"),
    ("as-is", "The software is provided \"as is\", without warranty of any kind, express or implied, including but not limited to the "
              "warranties of merchantability, fitness for a particular purpose and noninfringement."),
    ("gpl3-name", "This work is licensed under the GNU General Public License, version 3."),
    ("gpl3-name", "Licensed under the GNU General Public License version 3."),
    ("gpl-free", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public "
                 "License as published by the Free Software Foundation"),
    ("gpl-v3-or-later", "either version 3 of the License, or (at your option) any later version."),
    ("gpl3-later-notice", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
                          "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your "
                          "option) any later version."),
    ("gpl3-only-notice", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
                         "Public License as published by the Free Software Foundation, version 3."),
    ("gpl2-later-notice", "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General "
                          "Public License as published by the Free Software Foundation; either version 2 of the License, or (at your "
                          "option) any later version."),
    ("cc-by-nc-4-name", "Licensed under CC BY-NC 4.0."),
    ("cc-by-4-name", "Licensed under CC BY 4.0."),
    ("cc-by-sa-4-name", "Licensed under CC BY-SA 4.0."),
    ("bsd-redistribution", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
                           "following conditions are met"),
    ("bsd-no-endorse", "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote "
                       "products derived from this software without specific prior written permission"),
    ("bsd-no-endorse", "Neither the name of the University nor the names of its contributors may be used to endorse or promote "
                       "products derived from this software without specific prior written permission"),
    ("all-rights", "All rights reserved."),
)
# Ordered rules, each a sequence of sentence identifiers.
RULES = (
    ("Apache-2.0", ("apache2-name", "apache2-may-not", "apache2-copy")),
    ("MIT", ("mit-name", "mit-grant", "as-is")),
    ("MIT", ("mit-grant", "as-is")),
    ("GPL-3.0-or-later", ("gpl-free", "gpl-v3-or-later")),
    ("BSD-3-Clause", ("bsd-redistribution", "bsd-no-endorse")),
    ("Apache-2.0", ("apache2-name",)),
    ("Apache-2.0", ("apache2-short",)),
    ("MIT", ("mit-name",)),
    ("MIT", ("mit-grant",)),
    ("GPL-3.0-only", ("gpl3-name",)),
    ("GPL-3.0-or-later", ("gpl3-later-notice",)),
    ("GPL-3.0-only", ("gpl3-only-notice",)),
    ("GPL-2.0-or-later", ("gpl2-later-notice",)),
    ("CC-BY-NC-4.0", ("cc-by-nc-4-name",)),
    ("CC-BY-SA-4.0", ("cc-by-sa-4-name",)),
    ("CC-BY-4.0", ("cc-by-4-name",)),
    ("BSD-2-Clause", ("bsd-redistribution",)),
)

# a line end, with the word that makes the next line a comment in some languages (signs go with all other signs)
LINE_END = r"[\n\r]+(?:[ \t]*(?:rem|dnl)[ \t])?"
# else a sentence ends at a full stop, question or exclamation mark, colon or semicolon before white space
SENTENCE_END = r"(?<=[.!?;:])[ \t]+"


def marked(text: Column) -> Column:
    """The normalised text with ``\\n`` for the end of a line and ``|`` for that of a sentence inside a line.

    Lower case; dots inside numbers stay, all else but letters and digits becomes one blank.
    """
    c = F.concat(F.lit("\n"), F.regexp_replace(F.lower(text), r"\|", " "))
    c = F.regexp_replace(F.regexp_replace(c, SENTENCE_END, " | "), LINE_END, " \n ")
    c = F.regexp_replace(c, r"(?<![0-9])\.|\.(?![0-9])|[^\p{L}\p{N}.\n|]+", " ")
    c = F.regexp_replace(F.regexp_replace(c, r"[ |]*\n[ |\n]*", "\n"), r" *\|[ |]*", "|")
    return F.regexp_replace(F.regexp_replace(c, " +", " "), r"^[ |\n]+|[ |\n]+$", "")


def _pattern(sentences: list[str]) -> str:
    """Whole marked sentences, the longest first: a blank may be a line end; an end of a sentence inside one also a blank."""
    any_end = {" ": r"[ \n]", "|": r"[ \n|]", "\n": r"[ \n|]"}
    each = ("".join(any_end.get(c) or _quoted(c) for c in s) for s in sorted(sentences, key=lambda s: (-len(s), s)))
    return r"(?<=[\n|])(?:" + "|".join(each) + r")(?=[\n|])"


def scan(docs: DataFrame, known=SENTENCES, rules=RULES) -> DataFrame:
    """All columns of ``docs`` but text, plus ``sentence_ids`` (identifiers in the order of the text) and ``licenses``
    (licence of every rule match in order).

    ``known`` and ``rules`` are small tables of the caller (their size does not depend on the documents); they
    become a map and one pattern inside the pass that reads the documents, so nothing is shuffled.
    """
    spark = docs.sparkSession
    listed = spark.createDataFrame([(i, s) for i, s in known], "id string, s string") \
        .select("id", marked(F.col("s")).alias("s")).filter("s <> ''").collect() if known else []
    found = F.expr("cast(array() as array<string>)")
    if listed:
        plain = {re.sub(r"[\n|]", " ", r["s"]): r["id"] for r in listed}
        lookup = F.create_map(*[F.lit(x) for r in plain.items() for x in r])
        # most texts hold no known sentence: only those with a distinctive word of one are searched
        words = {max(s.split(), key=len) for s in plain}
        text = F.coalesce("text", F.lit(""))
        may = F.lower(text).rlike("|".join(sorted(map(_quoted, words))))
        whole = F.concat(F.lit("\n"), marked(text), F.lit("\n"))
        hits = F.regexp_extract_all(whole, F.lit(_pattern([r["s"] for r in listed])), F.lit(0))
        found = F.when(may, F.transform(hits, lambda m: F.element_at(lookup, F.regexp_replace(m, r"[\n|]", " ")))).otherwise(found)
    ids = "_ids"
    while ids in docs.columns:                      # a name that no column of the caller has
        ids = "_" + ids
    out = docs.withColumn(ids, found)
    # the sequence as text, one identifier between bars; the alternatives stand in the order of the rules
    ordered = sorted(rules, key=lambda r: -len(r[1]))
    chain = F.array_join(F.transform(ids, lambda i: F.concat(F.lit("|"), i, F.lit("|"))), "")
    licenses = F.expr("cast(array() as array<string>)")
    if ordered:
        pattern = "|".join("(?:" + "".join(_quoted(f"|{i}|") for i in ids) + ")" for _, ids in ordered)
        names = F.create_map(*[F.lit(x) for seq, name in {"".join(f"|{i}|" for i in ids): name for name, ids in reversed(ordered)}.items()
                               for x in (seq, name)])
        licenses = F.transform(F.regexp_extract_all(chain, F.lit(pattern), F.lit(0)), lambda m: F.element_at(names, m))
    keep = [c for c in docs.columns if c not in ("text", "sentence_ids", "licenses")]
    return out.select(*keep, F.col(ids).alias("sentence_ids"), licenses.alias("licenses"))


def _quoted(text: str) -> str:
    return re.sub(r"([^\w ])", r"\\\1", text)
