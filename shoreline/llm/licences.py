"""Licence scans by sentence rules, with DataFrame functions only.

A text becomes sentences, sentences become identifiers of known licence sentences, and the ordered
licence rules are matched against the sequence of identifiers; the first rule of a kind that
matches names the licence. All of it happens inside one row, so there is no shuffle.

Sentences are found twice: within single lines, since notices often stand on a line of their own
without a full stop before them, and across line breaks but not blank lines, since long licences
are wrapped. Both sequences are matched.

A sentence is normalised by lower-casing, by writing addresses away, by turning all runs of other
characters into one blank, by putting fixed words for the names of holders within a notice, and by
writing away a copyright notice (years and holder) that runs on into a known beginning. Notices with
colons or semicolons are known by the parts that these cut them into. Texts without any of the anchor words that
every known sentence contains are not split at all, which skips nothing.

NULL and empty texts have no sentences and no licence. Repeated rows and NULL ids are scanned row
by row. Other columns are ignored.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Identifiers of licence sentences and their normalised wording.
SENTENCES = {
    "mit_name": "released under the mit license",
    "mit_licensed": "licensed under the mit license",
    "mit_title": "the mit license mit",
    "mit_title_short": "mit license",
    "mit_grant": "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so subject to the following conditions",
    "mit_keep": "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software",
    "as_is": "the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability fitness for a particular purpose and noninfringement",
    "isc_grant": "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies",
    "apache2_name": "licensed under the apache license version 2 0",
    "apache2_the": "licensed under the apache license version 2 0 the license",
    "apache2_released": "released under the apache license version 2 0",
    "apache2_comply": "you may not use this file except in compliance with the license",
    "apache2_obtain": "you may obtain a copy of the license at",
    "apache2_basis": "unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis without warranties or conditions of any kind either express or implied",
    "gpl2_name": "this work is licensed under the gnu general public license version 2",
    "gpl3_name": "this work is licensed under the gnu general public license version 3",
    "gpl2_licensed": "licensed under the gnu general public license version 2",
    "gpl3_licensed": "licensed under the gnu general public license version 3",
    "gpl_free": "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 2 of the license or at your option any later version",
    "gpl3_free": "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 3 of the license or at your option any later version",
    "gpl_terms": "you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation",
    "gpl2_later": "either version 2 of the license or at your option any later version",
    "gpl3_later": "either version 3 of the license or at your option any later version",
    "gpl2_terms_later": "you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 2 of the license or at your option any later version",
    "gpl3_terms_later": "you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 3 of the license or at your option any later version",
    "lgpl_licensed": "licensed under the gnu lesser general public license version 3",
    "agpl_licensed": "licensed under the gnu affero general public license version 3",
    "gpl_hope": "this program is distributed in the hope that it will be useful but without any warranty without even the implied warranty of merchantability or fitness for a particular purpose",
    "gpl_useful": "this program is distributed in the hope that it will be useful but without any warranty",
    "gpl_implied": "without even the implied warranty of merchantability or fitness for a particular purpose",
    "mpl2_form": "this source code form is subject to the terms of the mozilla public license v",
    "mpl2_licensed": "licensed under the mozilla public license version 2 0",
    "bsd_redistribute": "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met",
    "bsd_source": "redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer",
    "bsd_binary": "redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation and or other materials provided with the distribution",
    "bsd_endorse": "neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission",
    "bsd_endorse_nor": "nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission",
    "bsd3_licensed": "licensed under the bsd 3 clause license",
    "bsd2_licensed": "licensed under the bsd 2 clause license",
    "cc_by_nc_name": "licensed under cc by nc 4 0",
    "cc_by_nc_sa_name": "licensed under cc by nc sa 4 0",
    "cc_by_nc_nd_name": "licensed under cc by nc nd 4 0",
    "cc_by_sa_name": "licensed under cc by sa 4 0",
    "cc_by_nd_name": "licensed under cc by nd 4 0",
    "cc_by_name": "licensed under cc by 4 0",
    "cc_by_work": "this work is licensed under a creative commons attribution 4 0 international license",
    "cc_by_sa_work": "this work is licensed under a creative commons attribution sharealike 4 0 international license",
    "cc_by_nc_work": "this work is licensed under a creative commons attribution noncommercial 4 0 international license",
    "cc0_waive": "to the extent possible under law the author has waived all copyright and related or neighboring rights to this work",
    "unlicense": "this is free and unencumbered software released into the public domain",
    "reserved": "all rights reserved",
}
# Ordered rules, as licence, kind, and the sentences that must follow each other with
# any others between them. The first match in this order is the text's main licence.
RULES = (
    ("AGPL-3.0", "copyleft", ("agpl_licensed",)),
    ("LGPL-3.0", "copyleft", ("lgpl_licensed",)),
    ("GPL-3.0", "copyleft", ("gpl3_name",)),
    ("GPL-3.0", "copyleft", ("gpl3_licensed",)),
    ("GPL-3.0-or-later", "copyleft", ("gpl3_free", "gpl_hope")),
    ("GPL-3.0-or-later", "copyleft", ("gpl3_free",)),
    ("GPL-3.0-or-later", "copyleft", ("gpl3_terms_later", "gpl_useful", "gpl_implied")),
    ("GPL-3.0-or-later", "copyleft", ("gpl3_terms_later",)),
    ("GPL-3.0-or-later", "copyleft", ("gpl_terms", "gpl3_later", "gpl_useful", "gpl_implied")),
    ("GPL-3.0-or-later", "copyleft", ("gpl_terms", "gpl3_later")),
    ("GPL-2.0", "copyleft", ("gpl2_name",)),
    ("GPL-2.0", "copyleft", ("gpl2_licensed",)),
    ("GPL-2.0-or-later", "copyleft", ("gpl_free", "gpl_hope")),
    ("GPL-2.0-or-later", "copyleft", ("gpl_free",)),
    ("GPL-2.0-or-later", "copyleft", ("gpl2_terms_later", "gpl_useful", "gpl_implied")),
    ("GPL-2.0-or-later", "copyleft", ("gpl2_terms_later",)),
    ("GPL-2.0-or-later", "copyleft", ("gpl_terms", "gpl2_later", "gpl_useful", "gpl_implied")),
    ("GPL-2.0-or-later", "copyleft", ("gpl_terms", "gpl2_later")),
    ("MPL-2.0", "copyleft", ("mpl2_form",)),
    ("MPL-2.0", "copyleft", ("mpl2_licensed",)),
    ("CC-BY-NC-SA-4.0", "noncommercial", ("cc_by_nc_sa_name",)),
    ("CC-BY-NC-ND-4.0", "noncommercial", ("cc_by_nc_nd_name",)),
    ("CC-BY-NC-4.0", "noncommercial", ("cc_by_nc_name",)),
    ("CC-BY-NC-4.0", "noncommercial", ("cc_by_nc_work",)),
    ("CC-BY-SA-4.0", "copyleft", ("cc_by_sa_name",)),
    ("CC-BY-SA-4.0", "copyleft", ("cc_by_sa_work",)),
    ("CC-BY-ND-4.0", "restricted", ("cc_by_nd_name",)),
    ("CC-BY-4.0", "permissive", ("cc_by_name",)),
    ("CC-BY-4.0", "permissive", ("cc_by_work",)),
    ("Apache-2.0", "permissive", ("apache2_the", "apache2_comply", "apache2_obtain", "apache2_basis")),
    ("Apache-2.0", "permissive", ("apache2_the",)),
    ("Apache-2.0", "permissive", ("apache2_name",)),
    ("Apache-2.0", "permissive", ("apache2_released",)),
    ("BSD-3-Clause", "permissive", ("bsd_redistribute", "bsd_source", "bsd_binary", "bsd_endorse")),
    ("BSD-3-Clause", "permissive", ("bsd_redistribute", "bsd_source", "bsd_binary", "bsd_endorse_nor")),
    ("BSD-3-Clause", "permissive", ("bsd3_licensed",)),
    ("BSD-2-Clause", "permissive", ("bsd_redistribute", "bsd_source", "bsd_binary")),
    ("BSD-2-Clause", "permissive", ("bsd2_licensed",)),
    ("MIT", "permissive", ("mit_grant", "mit_keep")),
    ("MIT", "permissive", ("mit_name",)),
    ("MIT", "permissive", ("mit_licensed",)),
    ("MIT", "permissive", ("mit_title",)),
    ("MIT", "permissive", ("mit_title_short",)),
    ("ISC", "permissive", ("isc_grant",)),
    ("CC0-1.0", "public domain", ("cc0_waive",)),
    ("Unlicense", "public domain", ("unlicense",)),
    ("Proprietary", "restricted", ("reserved",)),
)
# Every known sentence contains one of these.
ANCHORS = ("licen", "permission", "copyright", "redistribut", "warrant", "free software", "public domain", "rights reserved", "you may")

NORMAL_STEPS = (
    (r"<[^<>\n]{1,200}>|https?://[^ \n]{1,200}", " "),
    (r"licence", "license"),
    (r"[^a-z0-9]+", " "),
    (r"^ ?neither the name of (.* )?nor the names of (its |the |their )?contributors ", "neither the name of the copyright holder nor the names of its contributors "),
    (r"^ ?nor the names of (its |the |their )?contributors ", "nor the names of its contributors "),
    (r"^.* ha(s|ve) waived all copyright and related or neighboring rights to .*$", SENTENCES["cc0_waive"]),
    *(
        (rf"^ ?((copyright|c) (.* )?)?[0-9]{{4}} (.* )?{start}", start)
        for start in ("permission is hereby granted", "permission to use copy", "redistribution and use in", "licensed under the", "released under the", "all rights reserved")
    ),
)
LINE_ENDS = r"[\n\r]+"
PARAGRAPH_ENDS = r"[\n\r][ \t]*[\n\r][ \t\n\r]*"
SENTENCE_ENDS = r"[.;:!?]+(?=[ \n\r\t])|[;:!?]+"


def normal(sentence: Column) -> Column:
    for pattern, put in NORMAL_STEPS:
        sentence = F.regexp_replace(sentence, pattern, put)
    return F.trim(sentence)


def identifiers(lowered: Column) -> Column:
    """The known sentences of a lower-cased text in order, as ``array<string>``."""
    by_wording = F.create_map(*(F.lit(x) for name, wording in SENTENCES.items() for x in (wording, name)))
    named = F.transform(F.split(lowered, SENTENCE_ENDS), lambda s: F.try_element_at(by_wording, normal(s)))
    return F.filter(named, lambda name: name.isNotNull())


def rule_pattern(names: tuple[str, ...]) -> str:
    return "(^|,)" + ",(.*,)?".join(names) + "(,|$)"


def scan(docs: DataFrame) -> DataFrame:
    """``doc_id, sentences, licenses, license, kind`` of every row with text or without.

    ``sentences`` are the identifiers found, those within lines before those across lines;
    ``licenses`` all licences with a matching rule, sorted; ``license`` and ``kind`` those of the
    first rule that matches.
    """
    lowered = F.lower(F.coalesce(F.col("text").cast("string"), F.lit("")))
    anchored = reduce(or_, (F.col("lowered").contains(anchor) for anchor in ANCHORS))
    in_lines = identifiers(F.regexp_replace("lowered", LINE_ENDS, " ; "))
    paragraphs = F.regexp_replace("lowered", PARAGRAPH_ENDS, " ; ")
    across = identifiers(F.regexp_replace(paragraphs, LINE_ENDS, " "))
    nothing = F.array().cast("array<string>")
    found = docs.select(F.col("doc_id").cast("long").alias("doc_id"), lowered.alias("lowered")).select(
        "doc_id",
        F.when(anchored, in_lines).otherwise(nothing).alias("in_lines"),
        F.when(anchored, across).otherwise(nothing).alias("across"),
    )
    some = (F.size("in_lines") > 0) | (F.size("across") > 0)
    lists = [F.concat_ws(",", c) for c in ("in_lines", "across")]
    # a line feed keeps a rule from matching over the end of the first sequence
    sequence = F.concat(lists[0], F.lit("\n"), lists[1])

    def matches(names: tuple[str, ...]) -> Column:
        return F.col("sequence").rlike("(?m)" + rule_pattern(names))

    found = found.withColumn("sequence", F.when(some, sequence))
    hits = F.array(*(F.when(matches(names), F.lit(licence)) for licence, _, names in RULES))
    first = F.coalesce(
        *(
            F.when(matches(names), F.struct(F.lit(licence).alias("license"), F.lit(kind).alias("kind")))
            for licence, kind, names in RULES
        )
    )
    return found.select(
        "doc_id",
        F.concat_ws(",", F.concat("in_lines", "across")).alias("sentences"),
        F.when(some, F.concat_ws(",", F.array_sort(F.array_distinct(F.array_compact(hits))))).otherwise("").alias("licenses"),
        F.when(some, first).alias("first"),
    ).select("doc_id", "sentences", "licenses", F.col("first.license").alias("license"), F.col("first.kind").alias("kind"))


def sql(table: str = "documents") -> str:
    """The same scan as DuckDB SQL."""

    def text(value: str) -> str:
        return "'" + value.replace("'", "''") + "'"

    def named(lowered: str) -> str:
        sentence = "s"
        for pattern, put in NORMAL_STEPS:
            sentence = f"regexp_replace({sentence}, {text(pattern.replace(chr(10), chr(92) + 'n'))}, {text(put)}, 'g')"
        # DuckDB's patterns have no look-ahead: a stop before white space is marked first
        marked = f"regexp_replace(regexp_replace({lowered}, '[.;:!?]+([ \\n\\r\\t])', chr(1) || '\\1', 'g'), '[;:!?]+', chr(1), 'g')"
        return f"[x FOR x IN [known[trim({sentence})] FOR s IN string_split({marked}, chr(1))] IF x IS NOT NULL]"

    wordings = ", ".join(f"{text(w)}: {text(n)}" for n, w in SENTENCES.items())
    hits = ", ".join(
        f"CASE WHEN regexp_matches(sequence, {text('(?m)' + rule_pattern(names))}) THEN {text(licence)} END"
        for licence, _, names in RULES
    )
    kinds = ", ".join(
        f"CASE WHEN regexp_matches(sequence, {text('(?m)' + rule_pattern(names))}) THEN {text(kind)} END"
        for _, kind, names in RULES
    )
    anchors = text("|".join(ANCHORS))
    return f"""
WITH t AS (
  SELECT doc_id, lower(coalesce(text, '')) AS lowered, MAP {{{wordings}}} AS known FROM {table}
), f AS (
  SELECT doc_id,
    CASE WHEN regexp_matches(lowered, {anchors}) THEN {named("regexp_replace(lowered, '[\\n\\r]+', ' ; ', 'g')")} ELSE [] END AS in_lines,
    CASE WHEN regexp_matches(lowered, {anchors}) THEN {named("regexp_replace(regexp_replace(lowered, '[\\n\\r][ \\t]*[\\n\\r][ \\t\\n\\r]*', ' ; ', 'g'), '[\\n\\r]+', ' ', 'g')")} ELSE [] END AS across
  FROM t
), q AS (
  SELECT doc_id, list_concat(in_lines, across) AS sentences,
    array_to_string(in_lines, ',') || chr(10) || array_to_string(across, ',') AS sequence FROM f
), h AS (SELECT doc_id, sentences, [{hits}] AS hits, [{kinds}] AS kinds FROM q)
SELECT doc_id, array_to_string(sentences, ',') AS sentences,
  array_to_string(list_sort(list_distinct([x FOR x IN hits IF x IS NOT NULL])), ',') AS licenses,
  ([x FOR x IN hits IF x IS NOT NULL])[1] AS license, ([x FOR x IN kinds IF x IS NOT NULL])[1] AS kind
FROM h"""
