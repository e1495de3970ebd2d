"""License scan by sentence rules.

A text is reduced to lower-case words, so that line breaks, comment markers and
other punctuation are blanks; only a stop before white space or the end parts
two sentences.  Known licence sentences have identifiers and are looked for as
runs of words within a sentence, the longest first; a document becomes the
sequence of the identifiers found, in order.  Rules are tried in their order: one that finds its
identifiers next to each other in what is left of the sequence names its licence
and uses them up, as often as they occur.  Specific rules come before those that
are part of them.

Null and empty texts, and texts without a known sentence, have no licence and an
empty sequence.  The SQL form knows `SENTENCES` and `RULES` alone, as whole
sentences on one line.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lectern.llm.scratch import need

#: Known sentences, as words: identifier -> wordings.
SENTENCES: Mapping[str, tuple[str, ...]] = {
    "ApacheRef": ("licensed under the apache license version 2 0",
                  "licensed under the apache license version 2 0 the license"),
    "ApacheUse": ("you may not use this file except in compliance with the license",),
    "ApacheCopy": ("you may obtain a copy of the license at http www apache org licenses license 2 0",),
    "ApacheAsIs": ("unless required by applicable law or agreed to in writing software distributed under the license "
                   "is distributed on an as is basis without warranties or conditions of any kind either express or implied",),
    "MITRef": ("released under the mit license", "licensed under the mit license", "this project is licensed under the mit license"),
    "MITGrant": ("permission is hereby granted free of charge to any person obtaining a copy of this software and associated "
                 "documentation files the software to deal in the software without restriction including without limitation "
                 "the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to "
                 "permit persons to whom the software is furnished to do so subject to the following conditions",),
    "MITNotice": ("the above copyright notice and this permission notice shall be included in all copies or substantial "
                  "portions of the software",),
    "GPL3Ref": ("this work is licensed under the gnu general public license version 3",
                "licensed under the gnu general public license version 3"),
    "GPL2Ref": ("licensed under the gnu general public license version 2",),
    "GPLFree": ("this program is free software you can redistribute it and or modify it under the terms of the gnu general "
                "public license as published by the free software foundation either version 3 of the license or at your option "
                "any later version",),
    "BSDGrant": ("redistribution and use in source and binary forms with or without modification are permitted provided that "
                 "the following conditions are met",),
    "BSDEndorse": ("neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote "
                   "products derived from this software without specific prior written permission",),
    "CCBYNCRef": ("licensed under cc by nc 4 0", "this work is licensed under cc by nc 4 0"),
    "CCBYRef": ("licensed under cc by 4 0", "this work is licensed under cc by 4 0"),
    "AllRights": ("all rights reserved",),
}
#: Rules in the order in which they are tried.
RULES: Sequence[tuple[str, tuple[str, ...]]] = (
    ("Apache-2.0", ("ApacheRef", "ApacheUse", "ApacheCopy", "ApacheAsIs")),
    ("Apache-2.0", ("ApacheRef", "ApacheUse")),
    ("Apache-2.0", ("ApacheRef",)),
    ("MIT", ("MITGrant", "MITNotice")),
    ("MIT", ("MITGrant",)),
    ("MIT", ("MITRef",)),
    ("BSD-3-Clause", ("BSDGrant", "BSDEndorse")),
    ("BSD-2-Clause", ("BSDGrant",)),
    ("GPL-3.0-or-later", ("GPLFree",)),
    ("GPL-3.0", ("GPL3Ref",)),
    ("GPL-2.0", ("GPL2Ref",)),
    ("CC-BY-NC-4.0", ("CCBYNCRef",)),
    ("CC-BY-4.0", ("CCBYRef",)),
    ("All-Rights-Reserved", ("AllRights",)),
)
#: Further wordings and sentences, as they are in licence texts and file headers.
MORE_SENTENCES: Mapping[str, tuple[str, ...]] = {
    "ApacheRef": ("under the apache license version 2 0", "under the apache license 2 0", "spdx license identifier apache 2 0"),
    "ApacheCopy": ("you may obtain a copy of the license at https www apache org licenses license 2 0",),
    "MITRef": ("under the mit license", "spdx license identifier mit"),
    "BSDEndorse": ("nor the names of its contributors may be used to endorse or promote products derived from this software "
                   "without specific prior written permission",),
    "GPL3Ref": ("under the gnu general public license version 3", "spdx license identifier gpl 3 0 only"),
    "GPL2Ref": ("under the gnu general public license version 2", "spdx license identifier gpl 2 0 only"),
    "GPLFree": ("spdx license identifier gpl 3 0 or later",),
    "GPL2Free": ("this program is free software you can redistribute it and or modify it under the terms of the gnu general "
                 "public license as published by the free software foundation either version 2 of the license or at your option "
                 "any later version", "spdx license identifier gpl 2 0 or later"),
    "LGPLFree": ("it under the terms of the gnu lesser general public license as published by the free software foundation either "
                 "version 2 1 of the license or at your option any later version", "spdx license identifier lgpl 2 1 or later"),
    "AGPLFree": ("it under the terms of the gnu affero general public license as published by the free software foundation either "
                 "version 3 of the license or at your option any later version", "spdx license identifier agpl 3 0 or later"),
    "MPLRef": ("this source code form is subject to the terms of the mozilla public license v 2 0", "spdx license identifier mpl 2 0"),
    "ISCGrant": ("permission to use copy modify and or distribute this software for any purpose with or without fee is hereby "
                 "granted provided that the above copyright notice and this permission notice appear in all copies",
                 "spdx license identifier isc"),
    "Unlicense": ("this is free and unencumbered software released into the public domain",),
}
#: Their rules, tried after the others.
MORE_RULES: Sequence[tuple[str, tuple[str, ...]]] = (
    ("GPL-2.0-or-later", ("GPL2Free",)),
    ("LGPL-2.1-or-later", ("LGPLFree",)),
    ("AGPL-3.0-or-later", ("AGPLFree",)),
    ("MPL-2.0", ("MPLRef",)),
    ("ISC", ("ISCGrant",)),
    ("Unlicense", ("Unlicense",)),
)
#: A stop before white space or the end.
_ENDS = r"[.!?]+(?=\s|$)"
_END = "\x01"
_NO_WORD = r"[^a-z0-9\x01]+"


def _pattern(ids: Sequence[str]) -> str:
    return "".join(f"<{i}>" for i in ids)


def known_sentences(text: Column) -> Column:
    """The identifiers of the known sentences in a text, in order; null for a null text."""
    names = {words: name for table in (SENTENCES, MORE_SENTENCES) for name, wordings in table.items() for words in wordings}
    longest = sorted(names, key=lambda words: (-len(words), words))
    words = F.regexp_replace(F.regexp_replace(F.lower(text), _ENDS, f" {_END} "), _NO_WORD, " ")
    runs = F.regexp_extract_all(words, F.lit(rf"(?<![^ ])({'|'.join(longest)})(?![^ ])"), F.lit(1))
    table = F.create_map(*[F.lit(x) for pair in names.items() for x in pair])
    return F.transform(runs, lambda run: table[run])


def license_scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """row_id, sequence (identifiers in order), licenses (in rule order) for every row."""
    need(docs, [id_col, text_col])
    # What an explode gives is computed once, however often it is used.
    found = docs.select(
        F.col(id_col).cast("long").alias("row_id"),
        F.explode(F.array(F.coalesce(known_sentences(F.col(text_col).cast("string")), F.array().cast("array<string>")))).alias("sequence"))
    rules = F.array(*[F.struct(F.lit(name).alias("name"), F.lit(_pattern(ids)).alias("pattern")) for name, ids in (*RULES, *MORE_RULES)])
    start = F.struct(F.array_join(F.transform("sequence", lambda s: F.concat(F.lit("<"), s, F.lit(">"))), "").alias("rest"),
                     F.array().cast("array<string>").alias("names"))
    matched = F.aggregate(
        rules, start,
        lambda acc, rule: F.when(
            F.contains(acc["rest"], rule["pattern"]),
            F.struct(F.replace(acc["rest"], rule["pattern"], F.lit("|")).alias("rest"),
                     F.array_append(acc["names"], rule["name"]).alias("names"))).otherwise(acc),
        lambda acc: F.array_distinct(acc["names"]))
    return found.select("row_id", "sequence", matched.alias("licenses"))


def license_scan_sql(table: str = "documents") -> str:
    """The same as strings in DuckDB SQL."""
    known = ",\n".join(f"('{words}', '{name}')" for name, wordings in SENTENCES.items() for words in wordings)
    steps = reduce(
        lambda sql, rule: (f"select row, replace(rest, '{_pattern(rule[1])}', '|') as rest, case when contains(rest, '{_pattern(rule[1])}') "
                           f"and not list_contains(names, '{rule[0]}') then list_append(names, '{rule[0]}') else names end as names from ({sql})"),
        RULES, "select row, string_agg('<' || sentence || '>', '' order by pos) as rest, cast([] as varchar[]) as names from f group by row")
    return f"""
with k(words, sentence) as (values {known}),
d as (select *, row_number() over () as row from {table}),
x as (select row, unnest(s) as raw, generate_subscripts(s, 1) as pos
      from (select row, string_split_regex(lower(text), '[.!?]+(?:[ \\t\\r]+|$)|\\n|[.!?]+\\n') as s from d where text is not null)),
f as (select row, pos, sentence from (select row, pos, trim(regexp_replace(raw, '[^a-z0-9]+', ' ', 'g')) as words from x) join k using (words)),
m as ({steps}),
q as (select row, string_agg(sentence, ',' order by pos) as sequence from f group by row)
select doc_id, coalesce(sequence, '') as sequence, coalesce(array_to_string(names, ','), '') as licenses
from d left join m using (row) left join q using (row)"""


