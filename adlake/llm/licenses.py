"""Licence scan by sentence rules, in DataFrame functions.

Texts are cut into sentences, wrapped lines joined again, the normalised sentences looked up among the known
sentences of licences, and the sequence of identifiers found in a document matched
against rules, each an ordered list of identifiers.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Sentences as they stand in licence texts and notices, by identifier.
SENTENCES = {
    "mit-notice": "Released under the MIT License",
    "mit-notice-2": "Licensed under the MIT License",
    "mit-grant": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:",
    "mit-condition": "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software",
    "apache-notice": "Licensed under the Apache License, Version 2.0",
    "apache-header": "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License",
    "apache-copy": "You may obtain a copy of the License at",
    "gpl3-notice": "This work is licensed under the GNU General Public License, version 3",
    "gpl-free": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version",
    "gpl-warranty": "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE",
    "ccbync4-notice": "Licensed under CC BY-NC 4.0",
    "ccby4-notice": "Licensed under CC BY 4.0",
    "ccbysa4-notice": "Licensed under CC BY-SA 4.0",
    "cc0-notice": "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work",
    "bsd-grant": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",
    "bsd-source": "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer",
    "bsd-binary": "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution",
    "bsd-endorse": "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission",
    "as-is": "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT",
    "reserved": "All rights reserved",
}

# Rules in order of precedence: licence, class, and the sentences it needs
# in this order (others may stand between them).
RULES = (
    ("MIT", "permissive", ("mit-grant", "mit-condition", "as-is")),
    ("MIT", "permissive", ("mit-grant", "mit-condition")),
    ("MIT", "permissive", ("mit-notice",)),
    ("MIT", "permissive", ("mit-notice-2",)),
    ("Apache-2.0", "permissive", ("apache-header", "apache-copy")),
    ("Apache-2.0", "permissive", ("apache-header",)),
    ("Apache-2.0", "permissive", ("apache-notice",)),
    ("GPL-3.0-or-later", "copyleft", ("gpl-free", "gpl-warranty")),
    ("GPL-3.0-or-later", "copyleft", ("gpl-free",)),
    ("GPL-3.0-only", "copyleft", ("gpl3-notice",)),
    ("BSD-3-Clause", "permissive", ("bsd-grant", "bsd-source", "bsd-binary", "bsd-endorse")),
    ("BSD-2-Clause", "permissive", ("bsd-grant", "bsd-source", "bsd-binary")),
    ("CC-BY-NC-4.0", "restricted", ("ccbync4-notice",)),
    ("CC-BY-4.0", "permissive", ("ccby4-notice",)),
    ("CC-BY-SA-4.0", "copyleft", ("ccbysa4-notice",)),
    ("CC0-1.0", "permissive", ("cc0-notice",)),
    ("proprietary", "restricted", ("reserved",)),
)

# A sentence ends at a line break, or at a stop that blank space follows.
BREAK = r"\n|(?<=[.!?:])[\x20\t]+"


def normalized(sentence: Column) -> Column:
    """Lower-cased words and numbers (with inner points) with single blanks between."""
    plain = F.regexp_replace(F.lower(sentence), r"[^a-z0-9.]+|\.(?![0-9])", " ")
    return F.trim(F.regexp_replace(plain, " +", " "))


def known_sentences(spark: SparkSession) -> DataFrame:
    rows = spark.createDataFrame(sorted(SENTENCES.items()), "sentence_id string, sentence string")
    return rows.select("sentence_id", normalized(F.col("sentence")).alias("sentence"))


def pieces(text: Column) -> Column:
    """The normalised text, a line for each piece; a sentence may go on in the next line.

    Pieces are cut by ``BREAK``. After a full stop and at a blank line (one of comment marks
    only, too) an empty line follows, over which no sentence goes on.
    """
    lowered = F.lower(F.coalesce(text, F.lit("")))
    unmarked = F.regexp_replace(lowered, r"(?md)^[\x20\t]*[^a-z0-9\s]+[\x20\t]+", "")
    stops = F.regexp_replace(unmarked, r"(?<=[.!?])(?:[\x20\t\r]*\n|[\x20\t]+)", "\n\n")
    colons = F.regexp_replace(stops, r"(?<=:)[\x20\t]+(?![\x20\t\r\n])", "\n")
    plain = F.regexp_replace(colons, r"[^a-z0-9.\n]+|\.(?![0-9])", " ")
    lines = F.concat(F.lit("\n"), F.regexp_replace(plain, " +", " "), F.lit("\n"))
    return F.regexp_replace(lines, " ?\n ?", "\n")


def _plain(sentence: str) -> str:
    return " ".join(re.sub(r"[^a-z0-9.]+|\.(?![0-9])", " ", sentence.lower()).split())


def sentence_pattern() -> str:
    """Any known sentence from one break to another, the longer of two first."""
    known = sorted({_plain(v) for v in SENTENCES.values()}, key=lambda v: (-len(v), v))
    return r"(?<=\n)(?:" + "|".join("[ \n]".join(map(re.escape, v.split())) for v in known) + r")(?=\n)"


def _holds(ids: Column, rule: Sequence[str]) -> Column:
    """Whether the sentences of a rule stand among ``ids`` in its order: one pass over them."""
    wanted = F.array(*[F.lit(i) for i in rule])
    met = F.aggregate(ids, F.lit(0), lambda n, i: F.when(i == F.get(wanted, n), n + 1).otherwise(n))
    return (F.size(ids) >= len(rule)) & (met == len(rule))


def scan_licenses(docs: DataFrame) -> DataFrame:
    """One row (doc_id, n_sentences, sentence_ids, licenses, license_class) per row of ``docs``.

    ``n_sentences`` counts known sentences, ``sentence_ids`` lists them in order of the
    text, ``licenses`` the licences of all rules that match, sorted and joined with
    commas (no rule: empty), and ``license_class`` is the class of the first such rule,
    in order of precedence, or ``none``. A rule matches if its sentences stand in the
    text in its order. A sentence may be wrapped over lines, with comment marks before each,
    but not over a blank line. It counts only as a whole; a licence line glued to other
    words of its line is another sentence. Null and empty texts have no sentences.
    Repeated rows give equal results; other columns are left out.
    """
    wanted = {k: v for k, v in SENTENCES.items()}
    # The table of sentences is part of the code, so the map has a fixed size.
    known = F.create_map(*[x for k, v in sorted(wanted.items()) for x in (normalized(F.lit(v)), F.lit(k))])
    found = F.regexp_extract_all(pieces(F.col("text")), F.lit(sentence_pattern()), F.lit(0))
    ids = F.filter(
        F.transform(found, lambda s: F.try_element_at(known, F.translate(s, "\n", " "))), lambda i: i.isNotNull()
    )
    listed = docs.select("doc_id", ids.alias("_ids"))
    hits = [_holds(F.col("_ids"), rule) for _, _, rule in RULES]
    names = F.array_sort(
        F.array_distinct(
            F.filter(
                F.array(*[F.when(h, F.lit(name)) for h, (name, _, _) in zip(hits, RULES)]),
                lambda n: n.isNotNull(),
            )
        )
    )
    of_class = reduce(
        lambda rest, hit: F.when(hit[0], F.lit(hit[1])).otherwise(rest),
        list(zip(hits, [c for _, c, _ in RULES]))[::-1],
        F.lit("none"),
    )
    return listed.select(
        "doc_id",
        F.size("_ids").cast("long").alias("n_sentences"),
        F.array_join("_ids", ",").alias("sentence_ids"),
        F.array_join(names, ",").alias("licenses"),
        of_class.alias("license_class"),
    )
