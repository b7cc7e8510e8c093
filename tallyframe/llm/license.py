"""License scans by sentence rules: sentences become identifiers of known licence sentences, and sequences of
identifiers become licences. Column expressions only; the same tables also make the SQL for DuckDB."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import free_name

#: A sentence with one of these in it is taken for part of a licence.
KEYWORDS = "licen[cs]|copyright|warrant|redistribut|spdx|merchantab|public domain|all rights reserved|permission is hereby|liable for"

#: Sentences of published licences in normal form (lower-case words, digits, dots and plus signs), as
#: patterns that are searched in a sentence; the first that matches names it.
SENTENCES = (
    ("SpdxApache2", r"spdx license identifier apache 2\.0"),
    ("SpdxMit", r"spdx license identifier mit"),
    ("SpdxBsd3", r"spdx license identifier bsd 3 clause"),
    ("SpdxBsd2", r"spdx license identifier bsd 2 clause"),
    ("SpdxGpl3", r"spdx license identifier gpl 3\.0"),
    ("SpdxGpl2", r"spdx license identifier gpl 2\.0"),
    ("SpdxMpl2", r"spdx license identifier mpl 2\.0"),
    ("ApacheVersion", r"licensed under the apache license version 2\.0"),
    ("ApacheComply", r"you may not use this file except in compliance with the license"),
    ("ApacheCopy", r"you may obtain a copy of the license at"),
    ("ApacheAsIs", r"unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis"),
    ("ApacheSee", r"see the license for the specific language governing permissions and limitations under the license"),
    ("MitName", r"(released|licensed|distributed|available) under the (terms of the )?mit license"),
    ("MitPermission", r"permission is hereby granted free of charge to any person obtaining a copy of this software"),
    ("MitNotice", r"the above copyright notice and this permission notice shall be included in all copies"),
    ("MitAsIs", r"the software is provided as is without warranty of any kind"),
    ("MitLiable", r"in no event shall the authors or copyright holders be liable for any claim"),
    ("IscPermission", r"permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted"),
    ("IscAsIs", r"the software is provided as is and the author disclaims all warranties"),
    ("BsdPermission", r"redistribution and use in source and binary forms with or without modification are permitted"),
    ("BsdSource", r"redistributions of source code must retain the above copyright notice"),
    ("BsdBinary", r"redistributions in binary form must reproduce the above copyright notice"),
    ("BsdEndorse", r"neither the name of .* may be used to endorse or promote products derived from this software"),
    ("BsdAsIs", r"this software is provided by the copyright holders and contributors as is and any express or implied warranties"),
    ("BsdLiable", r"in no event shall the copyright (holder|owner)s? or contributors be liable for any"),
    ("LgplName", r"licensed under the (terms of the )?gnu (lesser|library) general public license"),
    ("Gpl3Name", r"licensed under the (terms of the )?gnu general public license (version|v) ?3"),
    ("Gpl2Name", r"licensed under the (terms of the )?gnu general public license (version|v) ?2"),
    ("GplName", r"licensed under the (terms of the )?gnu general public license"),
    ("GplFree3", r"redistribute it and or modify it under the terms of the gnu general public license .*version 3"),
    ("GplFree2", r"redistribute it and or modify it under the terms of the gnu general public license .*version 2"),
    ("GplHope", r"distributed in the hope that it will be useful but without any warranty"),
    ("GplSee", r"see the gnu general public license for more details"),
    ("GplReceived", r"you should have received a copy of the gnu general public license"),
    ("MplName", r"subject to the terms of the mozilla public license v(\.|ersion)? ?2\.0"),
    ("MplCopy", r"if a copy of the mpl was not distributed with this file you can obtain one at"),
    ("CcByNc", r"licensed under (a )?(cc by nc|creative commons attribution noncommercial) ?4\.0"),
    ("CcBySa", r"licensed under (a )?(cc by sa|creative commons attribution sharealike) ?4\.0"),
    ("CcBy", r"licensed under (a )?(cc by|creative commons attribution) ?4\.0"),
    ("Cc0", r"(cc0 1\.0 universal|dedicated to the public domain)"),
    ("Unlicense", r"this is free and unencumbered software released into the public domain"),
    ("AllRights", r"all rights reserved"),
    ("CopyrightLine", r"^copyright (c )?[0-9]{4}"),
)

#: Licences and the sentences that make them, next to each other among the licence sentences of a text. Rules are
#: tried in this order, and a sentence serves one rule only.
RULES = (
    ("Apache-2.0", ("ApacheVersion", "ApacheComply", "ApacheCopy", "ApacheAsIs", "ApacheSee")),
    ("Apache-2.0", ("ApacheVersion", "ApacheComply", "ApacheCopy")),
    ("Apache-2.0", ("ApacheVersion",)),
    ("Apache-2.0", ("SpdxApache2",)),
    ("MIT", ("MitPermission", "MitNotice", "MitAsIs", "MitLiable")),
    ("MIT", ("MitPermission", "MitNotice", "MitAsIs")),
    ("MIT", ("MitPermission", "MitNotice")),
    ("MIT", ("MitName",)),
    ("MIT", ("SpdxMit",)),
    ("ISC", ("IscPermission", "IscAsIs")),
    ("BSD-3-Clause", ("BsdPermission", "BsdSource", "BsdBinary", "BsdEndorse", "BsdAsIs", "BsdLiable")),
    ("BSD-3-Clause", ("BsdPermission", "BsdSource", "BsdBinary", "BsdEndorse", "BsdAsIs")),
    ("BSD-3-Clause", ("BsdPermission", "BsdSource", "BsdBinary", "BsdEndorse")),
    ("BSD-2-Clause", ("BsdPermission", "BsdSource", "BsdBinary", "BsdAsIs", "BsdLiable")),
    ("BSD-2-Clause", ("BsdPermission", "BsdSource", "BsdBinary", "BsdAsIs")),
    ("BSD-3-Clause", ("SpdxBsd3",)),
    ("BSD-2-Clause", ("SpdxBsd2",)),
    ("GPL-3.0-or-later", ("GplFree3", "GplHope", "GplSee", "GplReceived")),
    ("GPL-3.0-or-later", ("GplFree3", "GplHope")),
    ("GPL-2.0-or-later", ("GplFree2", "GplHope", "GplSee", "GplReceived")),
    ("GPL-2.0-or-later", ("GplFree2", "GplHope")),
    ("LGPL", ("LgplName",)),
    ("GPL-3.0", ("Gpl3Name",)),
    ("GPL-3.0", ("SpdxGpl3",)),
    ("GPL-2.0", ("Gpl2Name",)),
    ("GPL-2.0", ("SpdxGpl2",)),
    ("GPL", ("GplName",)),
    ("MPL-2.0", ("MplName", "MplCopy")),
    ("MPL-2.0", ("MplName",)),
    ("MPL-2.0", ("SpdxMpl2",)),
    ("CC-BY-NC-4.0", ("CcByNc",)),
    ("CC-BY-SA-4.0", ("CcBySa",)),
    ("CC-BY-4.0", ("CcBy",)),
    ("CC0-1.0", ("Cc0",)),
    ("Unlicense", ("Unlicense",)),
    ("LicenseRef-Proprietary", ("CopyrightLine", "AllRights")),
    ("LicenseRef-Proprietary", ("AllRights",)),
)
UNKNOWN = "Unknown"

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Line ends and the white space after . ! ? ; part sentences.
_PART = r"([.!?;])[ \t\r\n]+"
_OTHER = r"[^a-z0-9.+]+"
_EDGE = r"^[ .]+|[ .]+$"
#: Sentences of wrapped paragraphs count with this one too; it has none of the other keywords.
_KEYWORDS = KEYWORDS + "|copy of the mpl"
#: The same with any marks and line ends between words.
_ANYWHERE = _KEYWORDS.replace(" ", "[^a-z0-9.+]+")
#: Lines without letters or digits, comment marks among them, part paragraphs.
_PARAGRAPH = r"\n(?:[^a-z0-9\n]*\n)+"
#: Within paragraphs: a line end with the marks that begin the next line, and the ends of sentences, the point in
#: "v. 2.0" not among them; a colon ends one at the end of a line.
_WRAP, _END = r"\r?\n[^a-z0-9\n]*", r"((?<!\bv)[.!?;]|:(?=[ \t]*\r?\n))[^a-z0-9.+]*[ \t\r\n][^a-z0-9.+]*"


def _named(sentence: Column) -> Column:
    out = None
    for name, pattern in SENTENCES:
        hit = sentence.rlike(pattern)
        out = F.when(hit, name) if out is None else out.when(hit, name)
    return out.otherwise(UNKNOWN)


def scan(df: DataFrame, text: str = "text", into: str = "licenses") -> DataFrame:
    """All columns of ``df`` and the struct ``into``: sentences, licenses, n_unmatched.

    ``sentences`` are the identifiers of the licence sentences of the whole text in order, ``Unknown`` where
    none is known. Each paragraph is read line by line and with its lines, without comment marks, as one; the second
    reading counts where it has more known sentences, as in wrapped notices. ``licenses`` are the licences whose rules they meet, in order of their names, each once;
    ``n_unmatched`` the number of sentences that met no rule. Null and empty texts have none. Rows are scanned
    one by one. A column of that name is replaced.
    """
    words = F.translate(F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")), _UPPER, _LOWER)
    none = F.array().cast("array<string>")
    normal = lambda s: F.regexp_replace(F.regexp_replace(s, _OTHER, " "), _EDGE, "")
    named = lambda parts, keywords: F.transform(F.filter(F.transform(parts, normal), lambda s: s.rlike(keywords)), _named)
    known = lambda names: F.size(F.filter(names, lambda n: n != UNKNOWN))

    def readings(paragraph: Column) -> Column:
        lines = F.split(F.regexp_replace(paragraph, _PART, "$1\n"), "\n")
        whole = F.split(F.regexp_replace(F.regexp_replace(paragraph, _END, "$1\u0001"), _WRAP, " "), "\u0001")
        return F.struct(named(lines, KEYWORDS).alias("lines"), named(whole, _KEYWORDS).alias("whole"))

    both = F.transform(F.split(words, _PARAGRAPH), readings)
    names = F.flatten(F.transform(both, lambda r: F.when(known(r["whole"]) > known(r["lines"]), r["whole"]).otherwise(r["lines"])))
    # Texts without a keyword, nearly all, are not taken apart.
    sentences, left = free_name(df, "_sentences"), free_name(df, "_left")
    found = df.withColumn(sentences, F.when(words.rlike(_ANYWHERE), names).otherwise(none))
    # Each identifier in angle brackets; a rule's identifiers become its licence in braces, which no rule meets.
    rest = F.array_join(F.transform(sentences, lambda n: F.concat(F.lit("<"), n, F.lit(">"))), "")
    for licence, ids in RULES:
        rest = F.replace(rest, F.lit("".join(f"<{i}>" for i in ids)), F.lit("{" + licence + "}"))
    found = found.withColumn(left, F.when(F.size(sentences) > 0, rest).otherwise(""))
    licences = F.array_sort(F.array_distinct(F.regexp_extract_all(left, F.lit(r"\{([^}]*)\}"), F.lit(1))))
    unmatched = F.size(F.regexp_extract_all(left, F.lit("<[^>]*>"), F.lit(0))).cast("bigint")
    result = F.struct(F.col(sentences).alias("sentences"), licences.alias("licenses"), unmatched.alias("n_unmatched"))
    return found.withColumn(into, result).drop(sentences, left)


def sql() -> str:
    """DuckDB SQL for (doc_id, sentences, licenses, n_licenses, n_unmatched) of ``documents``, lists joined by commas."""
    quoted = lambda s: "'" + s.replace("'", "''") + "'"
    named = "CASE " + " ".join(f"WHEN regexp_matches(s, {quoted(p)}) THEN {quoted(n)}" for n, p in SENTENCES) + f" ELSE {quoted(UNKNOWN)} END"
    rest = "list_aggregate(list_transform(ids, lambda n: '<' || n || '>'), 'string_agg', '')"
    for licence, ids in RULES:
        rest = f"replace({rest}, {quoted(''.join(f'<{i}>' for i in ids))}, {quoted('{' + licence + '}')})"
    return f"""
WITH d AS (SELECT doc_id, translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}') AS words FROM documents),
parts AS (SELECT doc_id, CASE WHEN regexp_matches(words, {quoted(KEYWORDS)}) THEN string_split(regexp_replace(words, {quoted(_PART)}, E'\\\\1\\n', 'g'), E'\\n') ELSE [] END AS parts FROM d),
normal AS (SELECT doc_id, list_filter(list_transform(parts, lambda s: regexp_replace(regexp_replace(s, {quoted(_OTHER)}, ' ', 'g'), {quoted(_EDGE)}, '', 'g')), lambda s: regexp_matches(s, {quoted(KEYWORDS)})) AS parts FROM parts),
named AS (SELECT doc_id, list_transform(parts, lambda s: {named}) AS ids FROM normal),
met AS (SELECT doc_id, ids, CASE WHEN len(ids) > 0 THEN {rest} ELSE '' END AS rest FROM named),
lists AS (SELECT doc_id, ids, list_sort(list_distinct(regexp_extract_all(rest, '\\{{([^}}]*)\\}}', 1))) AS licenses, len(regexp_extract_all(rest, '<[^>]*>')) AS n FROM met)
SELECT doc_id, array_to_string(ids, ',') AS sentences, array_to_string(licenses, ',') AS licenses, CAST(len(licenses) AS BIGINT) AS n_licenses, CAST(n AS BIGINT) AS n_unmatched
FROM lists"""
