"""Licence scans by sentence rules.

A text is cut into sentences, each is normalised (lower case, letters and
digits only) and mapped to the identifier of a known licence sentence.  The
sequence of identifiers, with unknown sentences marking gaps, is then matched
against ordered rules: a longer rule comes before the rules it contains.

Sentences may be wrapped over lines, stand behind comment marks or be items of a
numbered list: they end at blank lines, list items and punctuation.  One-line
notices, between lines that end without punctuation, are known by a second cut
at line ends; sentences that longer rules are made of are not looked up there.

Defined cases: a null or empty text has no sentences and no licences; a
sentence repeated counts each time; rows are independent, so ties, repeated
rows and other columns do not matter; an empty table gives an empty result.
Everything is a Column expression over whole texts; nothing is shuffled.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Sentences of public licence texts and the usual notices.
SENTENCES: dict[str, str] = {
    "mit-notice": "Released under the MIT License.",
    "mit-notice-2": "Licensed under the MIT License.",
    "mit-notice-3": "This project is licensed under the MIT License.",
    "mit-grant": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:",
    "mit-keep": "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
    "apache-notice": "Licensed under the Apache License, Version 2.0.",
    "apache-notice-2": "Licensed under the Apache License, Version 2.0 (the \"License\");",
    "apache-obey": "you may not use this file except in compliance with the License.",
    "apache-copy": "You may obtain a copy of the License at",
    "gpl3-notice": "This work is licensed under the GNU General Public License, version 3.",
    "gpl-free": "This program is free software:",
    "gpl-free-2": "This program is free software;",
    "gpl3-or-later": "you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "gpl2-or-later": "you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version.",
    "gpl-hope": "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY;",
    "bsd-grant": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",
    "bsd-source": "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.",
    "bsd-endorse": "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.",
    "bsd-binary": "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.",
    "agpl3-or-later": "you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "lgpl-free": "This library is free software;",
    "lgpl21-or-later": "you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version.",
    "lgpl3-or-later": "you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "gpl2-only": "you can redistribute it and/or modify it under the terms of the GNU General Public License version 2 as published by the Free Software Foundation.",
    "gpl2-only-2": "you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; version 2 of the License.",
    "unlicense": "This is free and unencumbered software released into the public domain.",
    "cc0-given": "To the extent possible under law, the author(s) have dedicated all copyright and related and neighboring rights to this software to the public domain worldwide.",
    "cc0-notice": "Licensed under CC0 1.0.",
    "cc-by-nc-notice": "Licensed under CC BY-NC 4.0.",
    "cc-by-notice": "Licensed under CC BY 4.0.",
    "cc-by-sa-notice": "Licensed under CC BY-SA 4.0.",
    "mpl2-notice": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    "isc-grant": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
}

# Licences by sequences of sentences, in order of precedence.
RULES: tuple[tuple[str, str, str], ...] = (
    # rule, licence, sentences in order
    ("mit-text", "MIT", "mit-grant mit-keep"),
    ("mit-grant-only", "MIT", "mit-grant"),
    ("mit-line", "MIT", "mit-notice"),
    ("mit-line-2", "MIT", "mit-notice-2"),
    ("mit-line-3", "MIT", "mit-notice-3"),
    ("apache-header", "Apache-2.0", "apache-notice-2 apache-obey apache-copy"),
    ("apache-line", "Apache-2.0", "apache-notice"),
    ("gpl3-header", "GPL-3.0-or-later", "gpl-free gpl3-or-later gpl-hope"),
    ("gpl3-grant", "GPL-3.0-or-later", "gpl-free gpl3-or-later"),
    ("gpl3-line", "GPL-3.0-only", "gpl3-notice"),
    ("gpl2-header", "GPL-2.0-or-later", "gpl-free-2 gpl2-or-later gpl-hope"),
    ("gpl2-grant", "GPL-2.0-or-later", "gpl-free-2 gpl2-or-later"),
    ("gpl2-only-grant", "GPL-2.0-only", "gpl-free-2 gpl2-only"),
    ("gpl2-only-grant-2", "GPL-2.0-only", "gpl-free-2 gpl2-only-2"),
    ("agpl3-grant", "AGPL-3.0-or-later", "gpl-free agpl3-or-later"),
    ("lgpl21-grant", "LGPL-2.1-or-later", "lgpl-free lgpl21-or-later"),
    ("lgpl3-grant", "LGPL-3.0-or-later", "gpl-free lgpl3-or-later"),
    ("unlicense-text", "Unlicense", "unlicense"),
    ("cc0-text", "CC0-1.0", "cc0-given"),
    ("cc0-line", "CC0-1.0", "cc0-notice"),
    ("bsd3-text", "BSD-3-Clause", "bsd-grant bsd-source bsd-binary bsd-endorse"),
    ("bsd-text", "BSD-2-Clause", "bsd-grant bsd-source bsd-binary"),
    ("cc-by-nc-line", "CC-BY-NC-4.0", "cc-by-nc-notice"),
    ("cc-by-line", "CC-BY-4.0", "cc-by-notice"),
    ("cc-by-sa-line", "CC-BY-SA-4.0", "cc-by-sa-notice"),
    ("mpl2-line", "MPL-2.0", "mpl2-notice"),
    ("isc-text", "ISC", "isc-grant"),
)


@dataclass(frozen=True)
class LicenceRules:
    """sentences: text by identifier; rules: (name, licence, identifiers in order)."""

    sentences: dict[str, str]
    rules: Sequence[tuple[str, str, str]]


DEFAULT = LicenceRules(SENTENCES, RULES)

#: A sentence ends at . ! ? before white space, at a colon, a semicolon or a blank line.
BREAK = r"[.!?]+(?:[ \t\n\r\f]|$)|\n\n+|[:;]"
#: In the cut for notices it ends at every line end.
LINE_BREAK = r"[.!?]+(?:[ \t\r\n\f]|$)|[\n\r:;]"
#: What lines are freed of, in this order: carriage returns, comment marks with the
#: white space around them, and list numbers, which begin a sentence.
UNWRAP = ((r"\r\n?", "\n"), (r"\n[ \t]*(?:[*#/%]+|--+)?[ \t]*", "\n"),
          (r"\n(?:[0-9]{1,2}[.)]|\([0-9a-z]\)|[0-9a-z]\)|[-•])[ \t]+", "\n\n"))
#: The bare number of an item inside a line is no sentence.
NUMBER = "^[0-9]{0,2}$"


def normal(sentence: str) -> str:
    return re.sub(r"[^a-z0-9]+", " ", sentence.lower()).strip()


def sentence_ids(rules: LicenceRules) -> dict[str, int]:
    """Numbers of the normalised sentences, parts of a known sentence included.

    A licence sentence that the cutter would break is known by its parts."""
    ids: dict[str, int] = {}
    for text in rules.sentences.values():
        for part in re.split(BREAK, text):
            if normal(part):
                ids.setdefault(normal(part), len(ids) + 1)
    return ids


def rule_sequences(rules: LicenceRules) -> list[tuple[str, str, list[int]]]:
    ids = sentence_ids(rules)
    return [(name, licence, [ids[normal(part)] for key in keys.split()
                             for part in re.split(BREAK, rules.sentences[key]) if normal(part)])
            for name, licence, keys in rules.rules]


def notice_ids(rules: LicenceRules) -> dict[str, int]:
    """The sentences that are a whole rule and part of no longer one."""
    ids, longer, alone = sentence_ids(rules), set(), set()
    for _, _, sequence in rule_sequences(rules):
        (alone if len(sequence) == 1 else longer).update(sequence)
    return {words: i for words, i in ids.items() if i in alone - longer}


def _sequence(text: Column, breaks: str, ids: dict[str, int]) -> Column:
    known = F.create_map(*[F.lit(x) for pair in ids.items() for x in pair])
    cleaned = F.transform(F.split(text, breaks),
                          lambda s: F.trim(F.regexp_replace(F.lower(s), "[^a-z0-9]+", " ")))
    found = F.transform(F.filter(cleaned, lambda s: ~F.rlike(s, F.lit(NUMBER))),
                        lambda s: F.coalesce(F.element_at(known, s), F.lit(0)))
    line = F.concat(F.lit(","), F.array_join(found, ",,"), F.lit(","))
    return F.regexp_replace(line, "(?:,0,)+", ",0,")


def known_sequence(text: Column, rules: LicenceRules = DEFAULT) -> Column:
    """Identifiers of the text's sentences in order, as text: `,3,,4,,0,,7,`, where
    0 stands for a run of sentences that are not known.  Behind a bar, those of the
    notices in its lines."""
    ids = sentence_ids(rules)
    joined = F.concat(F.lit("\n"), text)
    for pattern, by in UNWRAP:
        joined = F.regexp_replace(joined, pattern, by)
    # A known sentence holds one of these words; others need no look-up.
    tell = "|".join(sorted({min(w.split(), key=lambda x: (-len(x), x)) for w in ids}))
    return F.when(F.rlike(F.lower(text), F.lit(tell)), F.concat(
        _sequence(joined, BREAK, ids), F.lit("|"), _sequence(text, LINE_BREAK, notice_ids(rules)),
    )).otherwise(F.lit(",0,|,0,"))


def scanned(docs: DataFrame, rules: LicenceRules = DEFAULT, id_column: str = "doc_id",
            text_column: str = "text") -> DataFrame:
    """doc_id, sequence, rules (names matched, in rule order) and licences
    (distinct, in rule order) of every document."""
    named = docs.select(F.col(id_column).alias("doc_id"),
                        known_sequence(F.coalesce(F.col(text_column), F.lit("")), rules)
                        .alias("sequence"))
    # A rule counts if it still matches after the rules before it have taken their sentences.
    rest, hits = F.col("sequence"), []
    stages = named
    for k, (name, licence, ids) in enumerate(rule_sequences(rules)):
        pattern = "".join(f",{i}," for i in ids)
        hits.append((f"_hit{k}", name, licence))
        stages = stages.withColumn(f"_hit{k}", F.contains(rest if k == 0 else F.col("_rest"),
                                                          F.lit(pattern)))
        stages = stages.withColumn("_rest", F.replace(rest if k == 0 else F.col("_rest"),
                                                      F.lit(pattern), F.lit(",0,")))
    names = F.array_compact(F.array(*[F.when(F.col(h), n) for h, n, _ in hits]))
    found = F.array_distinct(F.array_compact(F.array(*[F.when(F.col(h), x) for h, _, x in hits])))
    return stages.select("doc_id", "sequence", names.alias("rules"), found.alias("licences"))


def report(docs: DataFrame) -> DataFrame:
    """Licences and rules as text, and how many sentences are known (by the cut
    that knows more)."""
    known = F.greatest(*[F.regexp_count(F.split("sequence", "[|]")[i], F.lit("[1-9][0-9]*"))
                         for i in (0, 1)])
    return scanned(docs).select(
        "doc_id", F.array_join("licences", "|").alias("licences"),
        F.array_join("rules", "|").alias("rules"), known.cast("long").alias("known_sentences"))


def sql(rules: LicenceRules = DEFAULT) -> str:
    """The report in SQL."""
    def quoted(text: str) -> str:
        return "'" + text.replace("'", "''") + "'"

    def cut(name: str, text: str, breaks: str, ids: dict[str, int]) -> str:
        known = ", ".join(f"({quoted(w)}, {i})" for w, i in ids.items())
        return f"""
k{name}(words, id) AS (VALUES {known}),
s{name} AS (SELECT rid, string_split_regex({text}, '{breaks}') AS parts FROM d),
p{name} AS (SELECT rid, unnest(parts) AS part, generate_subscripts(parts, 1) AS place FROM s{name}),
c{name} AS (SELECT rid, place, trim(regexp_replace(lower(part), '[^a-z0-9]+', ' ', 'g')) AS words FROM p{name}),
i{name} AS (SELECT rid, place, coalesce(id, 0) AS id FROM c{name} LEFT JOIN k{name} USING (words)
            WHERE NOT regexp_matches(words, '{NUMBER}')),
r{name}s AS (SELECT *, lag(id) OVER (PARTITION BY rid ORDER BY place) AS prior FROM i{name}),
q{name} AS (SELECT rid, string_agg(',' || id || ',', '' ORDER BY place) AS line{name},
             count(*) FILTER (id > 0) AS n{name}
      FROM r{name}s WHERE NOT (id = 0 AND prior IS NOT DISTINCT FROM 0) GROUP BY rid),"""

    joined = "chr(10) || text"
    for pattern, by in UNWRAP:
        joined = f"regexp_replace({joined}, {quoted(pattern)}, repeat(chr(10), {len(by)}), 'g')"
    steps, names, found = [], [], {}
    for k, (name, licence, ids) in enumerate(rule_sequences(rules)):
        pattern = quoted("".join(f",{i}," for i in ids))
        steps.append(f"contains(r{k}, {pattern}) AS h{k}, replace(r{k}, {pattern}, ',0,') AS r{k + 1}")
        names.append(f"CASE WHEN h{k} THEN {quoted(name)} END")
        found.setdefault(licence, []).append((k, f"h{k}"))
    order = [f"CASE WHEN {' OR '.join(h for _, h in hits)} THEN {quoted(x)} END"
             for x, hits in sorted(found.items(), key=lambda item: item[1][0])]
    return f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS text FROM documents),
{cut("a", joined, BREAK, sentence_ids(rules))}
{cut("b", "text", LINE_BREAK, notice_ids(rules))}
h AS (SELECT doc_id, greatest(coalesce(na, 0), coalesce(nb, 0)) AS known_sentences,
             coalesce(linea, ',0,') || '|' || coalesce(lineb, ',0,') AS r0, {", ".join(steps)}
      FROM d LEFT JOIN qa USING (rid) LEFT JOIN qb USING (rid))
SELECT doc_id, concat_ws('|', {", ".join(order)}) AS licences,
       concat_ws('|', {", ".join(names)}) AS rules, known_sentences
FROM h
"""
