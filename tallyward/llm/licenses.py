"""Licence detection by sentences: known sentences get identifiers, ordered rules match sequences of identifiers.

A text is normalised (lower case, runs of anything but letters a-z and digits become one space) with marks where sentences
and lines end. Sentences end at sentence marks and blank lines; a line end, with comment signs behind it, is white space
inside a sentence, so that wrapped licences are found. A known sentence starts and ends at a mark of either kind, so that a
one-line notice needs no full stop; where it has punctuation inside, it may be divided there, and is known by all its parts
in order. It may have places for names and words that can be missing. What is left of a document is its sequence of identifiers, with a break where
more than ``max_gap`` other sentences lie between two. Rules are tried in order, longer and stricter first; a rule
that matches takes its identifiers out of the sequence, so a part of a longer licence is not reported again.

Everything happens within a row: one pass over the texts, no shuffle. Only texts with one of a few words that all known
sentences share are normalised at all.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Sentences of licences and of their usual notices, with our identifiers. ``{8}`` is a name of one to eight
# words, words in brackets may be missing.
SENTENCES = {
    "apache_ref": "Licensed under the Apache License, Version 2.0",
    "apache_ref_you": 'Licensed under the Apache License, Version 2.0 (the "License")',
    "apache_comply": "you may not use this file except in compliance with the License",
    "apache_obtain": "You may obtain a copy of the License at",
    "apache_as_is": 'Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied',
    "apache_see": "See the License for the specific language governing permissions and limitations under the License",
    "mit_ref": "Released under the MIT License",
    "mit_ref_licensed": "Licensed under the MIT License",
    "mit_grant": 'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:',
    "mit_notice": "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software",
    "mit_warranty": 'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT',
    "gpl3_ref": "This work is licensed under the GNU General Public License, version 3",
    "gpl2_ref": "This work is licensed under the GNU General Public License, version 2",
    "gpl_free": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version",
    "gpl2_free": "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version",
    "agpl_free": "This [{3}] program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version",
    "lgpl3_free": "This {3} is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version",
    "lgpl21_free": "This {3} is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version",
    "lgpl2_free": "This {3} is free software; you can redistribute it and/or modify it under the terms of the GNU Library General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version",
    "agpl_see": "See the GNU Affero General Public License for more details",
    "lgpl_see": "See the GNU Lesser General Public License for more details",
    "lgpl2_see": "See the GNU Library General Public License for more details",
    "lgpl_hope": "This library is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE",
    "agpl_ref": "This work is licensed under the GNU Affero General Public License, version 3",
    "gpl_hope": "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE",
    "gpl_see": "See the GNU General Public License for more details",
    "lgpl_ref": "This work is licensed under the GNU Lesser General Public License, version 3",
    "bsd_redistribute": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",
    "bsd_source": "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer",
    "bsd_binary": "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution",
    "bsd_endorse": "Neither the name of {12} nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission",
    "bsd_author": "The name of the author may not be used to endorse or promote products derived from this software without specific prior written permission",
    "bsd_advertise": "All advertising materials mentioning features or use of this software must display the following acknowledgement: This product includes software developed by {12}",
    "bsd_ref": "Released under the BSD License",
    "mpl_ref": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0",
    "cc_by_ref": "Licensed under CC BY 4.0",
    "cc_by_sa_ref": "Licensed under CC BY-SA 4.0",
    "cc_by_nc_ref": "Licensed under CC BY-NC 4.0",
    "cc_by_nd_ref": "Licensed under CC BY-ND 4.0",
    "cc_by_nc_sa_ref": "Licensed under CC BY-NC-SA 4.0",
    "isc_grant": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies",
    "unlicense_free": "This is free and unencumbered software released into the public domain",
    "dual_mit_apache": "[This {3} is] Dual licensed under the MIT [License] or [the] Apache [License] [Version] 2.0",
    "dual_apache_mit": "[This {3} is] Dual licensed under [the] Apache [License] [Version] 2.0 or [the] MIT [License]",
    "either_apache_mit": "Licensed under either of Apache License, Version 2.0 or MIT license at your option",
    "copyright_all": "Copyright {12}. All rights reserved",
    "all_rights": "Copyright, all rights reserved",
}

#: Identifiers of licences as they stand in SPDX lines; a line may join several by OR, AND or WITH.
SPDX = (
    "Apache-2.0 MIT GPL-3.0 GPL-3.0-only GPL-3.0-or-later GPL-2.0 GPL-2.0-only GPL-2.0-or-later LGPL-3.0 LGPL-3.0-only "
    "LGPL-3.0-or-later LGPL-2.1 LGPL-2.1-only LGPL-2.1-or-later LGPL-2.0-or-later AGPL-3.0 AGPL-3.0-only AGPL-3.0-or-later "
    "BSD-2-Clause BSD-3-Clause BSD-4-Clause ISC MPL-2.0 Unlicense 0BSD Zlib BSL-1.0 EPL-2.0 CC0-1.0 CC-BY-4.0 CC-BY-SA-4.0 "
    "CC-BY-NC-4.0 CC-BY-ND-4.0 CC-BY-NC-SA-4.0"
).split()

#: (licence, identifiers in order), tried in this order; several licences of one rule are joined by commas.
RULES = (
    ("AGPL-3.0-or-later", ("agpl_free", "gpl_hope", "agpl_see")),
    ("AGPL-3.0-or-later", ("agpl_free",)),
    ("LGPL-3.0-or-later", ("lgpl3_free", "lgpl_hope", "lgpl_see")),
    ("LGPL-3.0-or-later", ("lgpl3_free",)),
    ("LGPL-2.1-or-later", ("lgpl21_free", "lgpl_hope", "lgpl_see")),
    ("LGPL-2.1-or-later", ("lgpl21_free",)),
    ("LGPL-2.0-or-later", ("lgpl2_free", "lgpl_hope", "lgpl2_see")),
    ("LGPL-2.0-or-later", ("lgpl2_free",)),
    ("AGPL-3.0", ("agpl_ref",)),
    ("Apache-2.0,MIT", ("dual_mit_apache",)),
    ("Apache-2.0,MIT", ("dual_apache_mit",)),
    ("Apache-2.0,MIT", ("either_apache_mit",)),
    ("Apache-2.0", ("apache_ref_you", "apache_comply", "apache_obtain", "apache_as_is", "apache_see")),
    ("Apache-2.0", ("apache_ref_you", "apache_comply", "apache_obtain")),
    ("Apache-2.0", ("apache_ref_you",)),
    ("Apache-2.0", ("apache_ref",)),
    ("MIT", ("mit_grant", "mit_notice", "mit_warranty")),
    ("MIT", ("mit_grant", "mit_notice")),
    ("MIT", ("mit_ref",)),
    ("MIT", ("mit_ref_licensed",)),
    ("GPL-3.0-or-later", ("gpl_free", "gpl_hope", "gpl_see")),
    ("GPL-3.0-or-later", ("gpl_free",)),
    ("GPL-2.0-or-later", ("gpl2_free", "gpl_hope", "gpl_see")),
    ("GPL-2.0-or-later", ("gpl2_free",)),
    ("GPL-3.0", ("gpl3_ref",)),
    ("GPL-2.0", ("gpl2_ref",)),
    ("LGPL-3.0", ("lgpl_ref",)),
    ("BSD-4-Clause", ("bsd_redistribute", "bsd_source", "bsd_binary", "bsd_advertise", "bsd_endorse")),
    ("BSD-3-Clause", ("bsd_redistribute", "bsd_source", "bsd_binary", "bsd_endorse")),
    ("BSD-3-Clause", ("bsd_redistribute", "bsd_source", "bsd_binary", "bsd_author")),
    ("BSD-2-Clause", ("bsd_redistribute", "bsd_source", "bsd_binary")),
    ("BSD", ("bsd_ref",)),
    ("MPL-2.0", ("mpl_ref",)),
    ("CC-BY-4.0", ("cc_by_ref",)),
    ("CC-BY-SA-4.0", ("cc_by_sa_ref",)),
    ("CC-BY-NC-4.0", ("cc_by_nc_ref",)),
    ("CC-BY-ND-4.0", ("cc_by_nd_ref",)),
    ("CC-BY-NC-SA-4.0", ("cc_by_nc_sa_ref",)),
    ("ISC", ("isc_grant",)),
    ("Unlicense", ("unlicense_free",)),
    ("Proprietary", ("all_rights",)),
    *((name, (f"spdx:{name.lower()}",)) for name in SPDX),
)
#: Reported only where nothing else is: a notice that licences have as well.
LAST_RULE = ("Proprietary", ("copyright_all",))

#: Every known sentence has one of these (checked below), so a text without them needs no look-up.
SIGNS = "licen|permission|permitted|redistribut|warrant|copyright|advertising|public domain"
#: The same in a text, where a line may end between two words.
TEXT_SIGNS = SIGNS.replace("public domain", "domain")
#: Comment signs, rules and list numbers at the start of a line.
LINE_START = r"\n[^\S\n]*([#*/;%!<>|=-]+[^\S\n]*)?([(]?([0-9]{1,2}|[a-z])[.)][^\S\n]+)?"
#: Sentences end at a full stop or the like before white space, and at blank lines.
BREAKS = r"[.!?;]+\s+|\n\s*\n\s*"


def normalised(sentence: str) -> str:
    return re.sub("[^a-z0-9]+", " ", sentence.lower()).strip()


def _pattern(sentence: str, line: str) -> str:
    """A regular expression for a marked text, each word with a space before it; ``line`` is what a line end there looks like.

    After punctuation marks of sentences may stand as well.
    """
    out, divided = "", False
    for token in re.findall(r"\[|\]|\{\d+\}|[A-Za-z0-9]+|[.:;!?]", sentence):
        gap = f" (?:H {'|S ' if line else ''})*" if divided else f" {line}"
        if token == "[":
            out += "(?:"
        elif token == "]":
            out += ")?"
        elif token in ".:;!?":
            divided = not re.search(r"\d$", out) or token != "."  # 2.0 is no end of a sentence
            continue
        elif token[0] == "{":
            out += f"(?:{gap}[a-z0-9]+){{1,{token[1:-1]}}}"
            divided = False
        else:
            out += gap + token.lower()
            divided = False
    return out


def _spdx_pattern(line: str) -> str:
    """A line of identifiers; longer ones first, since some begin like others."""
    names = "|".join(normalised(x).replace(" ", f" {line}") for x in sorted(SPDX, key=len, reverse=True))
    return f" {line}spdx {line}license {line}identifier {line}(?:{names})(?: {line}(?:or|and|with) {line}(?:{names}))*"


assert {i for _, ids in [*RULES, LAST_RULE] for i in ids if not i.startswith("spdx:")} <= set(SENTENCES)
assert all(re.search(SIGNS, normalised(s)) for s in SENTENCES.values())

#: Sentences without places for names, as their words -> identifier; the others as patterns of their words.
KNOWN = {normalised(s): name for name, s in SENTENCES.items() if not re.search(r"[\[{]", s)}
OPEN = {name: _pattern(s, "").replace("(?:H )*", "") for name, s in SENTENCES.items() if re.search(r"[\[{]", s)}
assert len(KNOWN) + len(OPEN) == len(SENTENCES)

_LINE = "(?:S )?"
#: A known sentence between marks (H: a sentence ends, S: a line ends), longer ones first; or the end of a sentence.
_PIECES = "(?<=[HS])(?:{})(?= [HS])|H".format(
    "|".join([_pattern(s, _LINE) for s in sorted(SENTENCES.values(), key=len, reverse=True)] + [_spdx_pattern(_LINE)])
)


def _names(piece: Column) -> Column:
    """The identifiers of a known sentence: one, or those of an SPDX line."""
    words = F.trim(F.regexp_replace(piece, "[HS] ", ""))
    known = F.create_map(*[F.lit(x) for pair in KNOWN.items() for x in pair])
    spdx = F.create_map(*[F.lit(x) for name in SPDX for x in (normalised(name), f"spdx:{name.lower()}")])
    ids = "|".join(normalised(x) for x in sorted(SPDX, key=len, reverse=True))
    listed = F.regexp_extract_all(words, F.lit(f"(?<= )(?:{ids})(?= (?:or|and|with) |$)"), F.lit(0))
    name = F.when(words.startswith("spdx license identifier "), F.array_join(F.transform(listed, lambda x: F.element_at(spdx, x)), " "))
    for identifier, pattern in OPEN.items():
        name = name.when(F.concat(F.lit(" "), words).rlike(f"^{pattern}$"), identifier)
    return F.coalesce(F.try_element_at(known, words), name)


def _sequence(text: Column, max_gap: int) -> Column:
    """The identifiers of a text's known sentences in order, as `` a b / c ``; a slash is a break."""
    lines = F.regexp_replace(F.concat(F.lit("\n"), F.lower(text)), LINE_START, "\n")
    # The text is in lower case, so capitals are free for marks.
    marked = F.regexp_replace(F.regexp_replace(lines, BREAKS, " H "), r"\n", " S ")
    clean = F.regexp_replace(F.concat(F.lit("H "), marked, F.lit(" H")), "[^a-z0-9HS]+", " ")
    pieces = F.regexp_extract_all(clean, F.lit(_PIECES), F.lit(0))
    start = F.struct(F.lit(-1).alias("ends"), F.lit(" ").alias("out"))  # sentences ended since the last known one

    def step(got: Column, piece: Column) -> Column:
        out = F.concat(got["out"], F.when(got["ends"] - 1 > max_gap, "/ ").otherwise(""), _names(piece), F.lit(" "))
        ends = F.when(got["ends"] < 0, got["ends"]).otherwise(got["ends"] + 1)
        end = piece == "H"
        return F.struct(F.when(end, ends).otherwise(0).alias("ends"), F.when(end, got["out"]).otherwise(out).alias("out"))

    return F.aggregate(pieces, start, step, lambda got: got["out"])


def licenses(docs: DataFrame, max_gap: int = 3, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per document: doc_id, sequence (of identifiers), licenses (of matched rules, different ones, sorted), n_matches.

    Defined results: a NULL or empty text, and one without known sentences, has an empty sequence and no licences; known sentences
    that no rule explains stay in ``sequence`` only; rows with the same id are looked at one by one; an empty table gives no
    rows; other columns are ignored.
    """
    df = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("_text"))
    found = F.when(F.lower("_text").rlike(TEXT_SIGNS), _sequence(F.col("_text"), max_gap)).otherwise(F.lit(" "))
    df = df.withColumn("sequence", found).withColumn("_left", F.col("sequence"))
    names, counts = [], []
    for i, (license_name, identifiers) in enumerate([*RULES, LAST_RULE]):
        pattern = f" {' '.join(map(re.escape, identifiers))}(?= )"
        df = df.withColumn(f"_n{i}", F.when(F.col("_left") == " ", 0).otherwise(F.regexp_count("_left", F.lit(pattern))))
        df = df.withColumn("_left", F.when(F.col("_left") == " ", F.col("_left")).otherwise(F.regexp_replace("_left", pattern, " /")))
        counts.append(F.col(f"_n{i}"))
        names.append(F.when(F.col(f"_n{i}") > 0, F.split(F.lit(license_name), ",")))
    # The last rule counts where the others found nothing.
    others = sum(counts[:-1], F.lit(0))
    counts[-1] = F.when(others == 0, counts[-1]).otherwise(0)
    names[-1] = F.when(others == 0, names[-1])
    known = F.col("sequence") != " "
    return df.select(
        "doc_id",
        F.trim("sequence").alias("sequence"),
        F.when(known, F.array_sort(F.array_distinct(F.flatten(F.array_compact(F.array(*names))))))
        .otherwise(F.array().cast("array<string>"))
        .alias("licenses"),
        F.when(known, sum(counts, F.lit(0))).otherwise(F.lit(0)).cast("long").alias("n_matches"),
    )


def oracle_sql(max_gap: int = 3, lines: int = 40) -> str:
    """``licenses`` over ``documents`` in DuckDB, licences comma-joined; for known sentences over at most ``lines`` lines.

    Here a known sentence is a run of neighbouring pieces between marks whose words are matched as a whole.
    """
    known = ", ".join(f"('{name}', '{_pattern(s, '')}')" for name, s in SENTENCES.items())
    spdx = ", ".join(f"('{normalised(x)}', 'spdx:{x.lower()}')" for x in SPDX)
    ids = "|".join(normalised(x) for x in sorted(SPDX, key=len, reverse=True))
    steps, before = [], "seq"
    rules = [*RULES, LAST_RULE]
    for i, (_, identifiers) in enumerate(rules):
        # Each identifier has a space of its own on either side.
        pattern = f" {'  '.join(map(re.escape, identifiers))} "
        steps.append(
            f"s{i} AS (SELECT * REPLACE (regexp_replace(rest, '{pattern}', ' / ', 'g') AS rest), "
            f"len(regexp_extract_all(rest, '{pattern}')) AS n{i} FROM {before})"
        )
        before = f"s{i}"
    last = len(rules) - 1
    others = " + ".join(f"n{i}" for i in range(last))
    picked = [f"CASE WHEN n{i} > 0 THEN '{name}' END" for i, (name, _) in enumerate(RULES)]
    picked = ", ".join([*picked, f"CASE WHEN n{last} > 0 AND {others} = 0 THEN '{LAST_RULE[0]}' END"])
    return rf"""WITH known(name, pattern) AS (VALUES {known}), spdx(words, name) AS (VALUES {spdx}),
    lined AS (SELECT doc_id, regexp_replace(chr(10) || lower(text), '
[^\S
]*[#*/;%!<>|=-]+', chr(10), 'g') AS t FROM documents
        WHERE regexp_matches(lower(text), '{TEXT_SIGNS}')),
    marked AS (SELECT doc_id, regexp_replace('H ' || regexp_replace(regexp_replace(t, '[.!?;]+\s+|
\s*
\s*', ' H ', 'g'), '
', ' S ', 'g')
        || ' H', '[^a-z0-9HS]+', ' ', 'g') AS t FROM lined),
    pieces AS (SELECT doc_id, string_split(regexp_replace(t, ' ([HS])', '~\1', 'g'), '~') AS f FROM marked),
    starts AS (SELECT doc_id, f, i, j FROM pieces, unnest(range(1, len(f) + 1)) AS a(i), unnest(range(i, least(i + {lines}, len(f) + 1))) AS b(j)),
    runs AS (SELECT doc_id, i, j, array_to_string(list_transform(range(i, j + 1), lambda x :
        (CASE WHEN x > i AND f[x][1] = 'H' THEN ' H' ELSE '' END) || f[x][2:]), '') AS words FROM starts),
    met AS (SELECT doc_id, i, j, name FROM runs JOIN known ON regexp_full_match(words, pattern) WHERE len(words) < 800
        UNION ALL SELECT doc_id, i, j, (SELECT string_agg(s.name, ' ' ORDER BY place) FROM
                (SELECT unnest(regexp_extract_all(words[25:], ' ({ids})( or| and| with|$)', 1)) AS w,
                    generate_subscripts(regexp_extract_all(words[25:], ' ({ids})( or| and| with|$)', 1), 1) AS place) l
                JOIN spdx s ON s.words = l.w)
            FROM runs WHERE regexp_full_match(words, ' spdx license identifier ({ids})( (or|and|with) ({ids}))*')),
    kept AS (SELECT * FROM met m WHERE NOT EXISTS (SELECT 1 FROM met o WHERE o.doc_id = m.doc_id AND o.i <= m.i AND o.j >= m.j
        AND o.j - o.i > m.j - m.i)),
    named AS (SELECT doc_id, i, name, i AS place, lag(j) OVER (PARTITION BY doc_id ORDER BY i) AS last FROM kept),
    gaps AS (SELECT n.doc_id, n.i, n.name, CASE WHEN last IS NULL THEN 0
        ELSE len(list_filter(range(last + 1, n.i + 1), lambda x : f[x][1] = 'H')) END AS ends FROM named n JOIN pieces USING (doc_id)),
    joined AS (SELECT doc_id, string_agg(CASE WHEN ends - 1 > {max_gap} THEN '/ ' || name ELSE name END, ' ' ORDER BY i) AS sequence
        FROM gaps GROUP BY 1),
    seq AS (SELECT doc_id, coalesce(sequence, '') AS sequence, ' ' || replace(coalesce(sequence, ''), ' ', '  ') || ' ' AS rest
        FROM documents LEFT JOIN joined USING (doc_id)),
    {", ".join(steps)}
    SELECT doc_id, sequence, array_to_string(list_sort(list_distinct(string_split(array_to_string(list_filter([{picked}],
        lambda x : x IS NOT NULL), ','), ','))), ',') AS licenses, ({others} + CASE WHEN {others} = 0 THEN n{last} ELSE 0 END)::bigint AS n_matches
    FROM {before}"""
