"""Licence scans by sentence rules, with built-in SQL functions only.

A text is cut into fragments at sentence ends, line ends, ':' and ';'. Each is
normalised, and a fragment, or a run of fragments that no sentence end or blank
line parts, is mapped to the identifier of a known licence sentence; a list
number before it is dropped. The sequence of identifiers is matched against
licence rules in their order. Unknown fragments stay in the sequence as ``-``,
so a rule matches only sentences that follow one another. The SQL knows
sentences of one fragment only, and no list numbers.

Null and empty texts give no sentences and no licence. Rows are kept one for
one, repeated ids and rows included; other columns of the input are ignored.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Normalised licence sentences by identifier.
SENTENCES = {
    "all-rights-reserved": "all rights reserved",
    "mit-short": "released under the mit license",
    "mit-short-2": "licensed under the mit license",
    "mit-title": "the mit license",
    "mit-grant": "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so subject to the following conditions",
    "mit-notice": "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software",
    "mit-disclaimer": "the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability fitness for a particular purpose and noninfringement",
    "isc-grant": "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies",
    "isc-disclaimer": "the software is provided as is and the author disclaims all warranties with regard to this software including all implied warranties of merchantability and fitness",
    "apache-2-short": "licensed under the apache license version 2.0",
    "apache-2-grant": "licensed under the apache license version 2.0 the license",
    "apache-2-use": "you may not use this file except in compliance with the license",
    "apache-2-copy": "you may obtain a copy of the license at",
    "apache-2-basis": "unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis without warranties or conditions of any kind either express or implied",
    "gpl-3-short": "this work is licensed under the gnu general public license version 3",
    "gpl-grant": "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 3 of the license or at your option any later version",
    "gpl-2-grant": "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 2 of the license or at your option any later version",
    "lgpl-2-grant": "this library is free software you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation either version 2.1 of the license or at your option any later version",
    "lgpl-warranty": "this library is distributed in the hope that it will be useful but without any warranty without even the implied warranty of merchantability or fitness for a particular purpose",
    "agpl-grant": "this program is free software you can redistribute it and or modify it under the terms of the gnu affero general public license as published by the free software foundation either version 3 of the license or at your option any later version",
    "gpl-warranty": "this program is distributed in the hope that it will be useful but without any warranty without even the implied warranty of merchantability or fitness for a particular purpose",
    "bsd-forms": "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met",
    "bsd-source": "redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer",
    "bsd-binary": "redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation and or other materials provided with the distribution",
    "bsd-names": "neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission",
    "bsd-disclaimer": "this software is provided by the copyright holders and contributors as is and any express or implied warranties including but not limited to the implied warranties of merchantability and fitness for a particular purpose are disclaimed",
    "mpl-2-form": "this source code form is subject to the terms of the mozilla public license v",
    "epl-2-terms": "this program and the accompanying materials are made available under the terms of the eclipse public license 2.0 which is available at https www.eclipse.org legal epl 2.0",
    "unlicense-domain": "this is free and unencumbered software released into the public domain",
    "cc-by-4-short": "licensed under cc by 4.0",
    "cc-by-sa-4-short": "licensed under cc by sa 4.0",
    "cc-by-nc-4-short": "licensed under cc by nc 4.0",
    "cc0-short": "this work is dedicated to the public domain under cc0 1.0 universal",
    "spdx-mit": "spdx license identifier mit",
    "spdx-apache-2": "spdx license identifier apache 2.0",
    "spdx-gpl-3": "spdx license identifier gpl 3.0 only",
    "spdx-gpl-3-later": "spdx license identifier gpl 3.0 or later",
    "spdx-gpl-2": "spdx license identifier gpl 2.0 only",
    "spdx-lgpl-2-later": "spdx license identifier lgpl 2.1 or later",
    "spdx-agpl-3-later": "spdx license identifier agpl 3.0 or later",
    "spdx-bsd-2": "spdx license identifier bsd 2 clause",
    "spdx-bsd-3": "spdx license identifier bsd 3 clause",
    "spdx-isc": "spdx license identifier isc",
    "spdx-mpl-2": "spdx license identifier mpl 2.0",
    "spdx-epl-2": "spdx license identifier epl 2.0",
    "spdx-unlicense": "spdx license identifier unlicense",
}
# Licence rules in the order in which they are tried, each a run of sentence identifiers.
RULES = [
    ("BSD-3-Clause", "bsd-forms bsd-source bsd-binary bsd-names"),
    ("BSD-2-Clause", "bsd-forms bsd-source bsd-binary bsd-disclaimer"),
    ("BSD-2-Clause", "bsd-forms bsd-source bsd-binary"),
    ("MIT", "mit-grant mit-notice mit-disclaimer"),
    ("MIT", "mit-grant mit-notice"),
    ("ISC", "isc-grant isc-disclaimer"),
    ("ISC", "isc-grant"),
    ("AGPL-3.0-or-later", "agpl-grant"),
    ("LGPL-2.1-or-later", "lgpl-2-grant lgpl-warranty"),
    ("LGPL-2.1-or-later", "lgpl-2-grant"),
    ("GPL-2.0-or-later", "gpl-2-grant gpl-warranty"),
    ("GPL-2.0-or-later", "gpl-2-grant"),
    ("GPL-3.0-or-later", "gpl-grant gpl-warranty"),
    ("GPL-3.0-or-later", "gpl-grant"),
    ("Apache-2.0", "apache-2-grant apache-2-use"),
    ("Apache-2.0", "apache-2-short"),
    ("MPL-2.0", "mpl-2-form"),
    ("EPL-2.0", "epl-2-terms"),
    ("Unlicense", "unlicense-domain"),
    ("GPL-3.0-only", "gpl-3-short"),
    ("CC-BY-NC-4.0", "cc-by-nc-4-short"),
    ("CC-BY-SA-4.0", "cc-by-sa-4-short"),
    ("CC-BY-4.0", "cc-by-4-short"),
    ("CC0-1.0", "cc0-short"),
    ("MIT", "mit-short"),
    ("MIT", "mit-short-2"),
    ("MIT", "mit-title"),
    ("MIT", "spdx-mit"),
    ("Apache-2.0", "spdx-apache-2"),
    ("GPL-3.0-only", "spdx-gpl-3"),
    ("GPL-3.0-or-later", "spdx-gpl-3-later"),
    ("GPL-2.0-only", "spdx-gpl-2"),
    ("LGPL-2.1-or-later", "spdx-lgpl-2-later"),
    ("AGPL-3.0-or-later", "spdx-agpl-3-later"),
    ("BSD-2-Clause", "spdx-bsd-2"),
    ("BSD-3-Clause", "spdx-bsd-3"),
    ("ISC", "spdx-isc"),
    ("MPL-2.0", "spdx-mpl-2"),
    ("EPL-2.0", "spdx-epl-2"),
    ("Unlicense", "spdx-unlicense"),
    ("LicenseRef-all-rights-reserved", "all-rights-reserved"),
]
# Every known sentence holds one of these within a word, which normalisation never changes, so a text without any of them has no known sentence.
CUES = "licens|permission|copyright|reserved|warrant|redistribution|domain"
SPLIT = r"[.!?;:]+[\x09-\x0D\x20]+|[\r\n]+"
JUNK = r"[^a-z0-9.]+"


# Where no sentence goes on, marked by a fragment "|": sentence ends, and lines without letters and digits.
END = r"(?<![.!?;:])[;:]*+[.!?][.!?;:]*+[\x09-\x0D\x20]+"
BLANK = r"(?>\r\n|\r|\n)[^a-z0-9.!?;:\r\n]*[\r\n]"
# In fragments joined by "_": a known sentence, in one fragment if it can be, with its list number; else one fragment.
NUMBER = r"[0-9]{1,2}(?: |_(?:\|_)?)"
KNOWN = "|".join(between.join(map(re.escape, words.split())) for between in (" ", "[ _]") for words in SENTENCES.values())
TOKEN = rf"(?:{NUMBER})?(?:{KNOWN})(?![^_])|[^_]+"


def _sentences(text: Column) -> Column:
    body = F.translate(F.lower(text), "|", ",")
    for mark in (END, BLANK):
        body = F.regexp_replace(body, mark, "\n|\n")
    cleaned = F.transform(F.split(body, SPLIT, -1), lambda s: F.btrim(F.regexp_replace(s, JUNK.replace("a-z", "|a-z"), " "), F.lit(" .")))
    tokens = F.regexp_extract_all(F.array_join(F.filter(cleaned, lambda s: s != ""), "_"), F.lit(TOKEN), F.lit(0))
    return F.transform(F.filter(tokens, lambda s: s != "|"), lambda s: F.regexp_replace(F.translate(s, "_", " "), r"^[0-9]{1,2} (?:\| )?", ""))


def _label(sentence: Column) -> Column:
    known = F.create_map(*(F.lit(x) for name, words in SENTENCES.items() for x in (words, name)))
    return F.coalesce(F.try_element_at(known, sentence), F.lit("-"))


def scan_licenses(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_known (licence sentences), sentence_ids, rules (all that match, in rule order), license (the first)."""
    body = F.col("text")
    empty = F.array().cast("array<string>")
    rows = df.select(F.col(key).cast("bigint").alias("doc_id"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    rows = rows.select("doc_id", F.when(F.lower(body).rlike(CUES), F.transform(_sentences(body), _label)).otherwise(empty).alias("ids"))
    # the sequence is built once; each rule then is a substring test on it
    rows = rows.select("doc_id", F.filter("ids", lambda x: x != "-").alias("known"), F.concat(F.lit(" "), F.array_join("ids", " "), F.lit(" ")).alias("seq"))
    hits = F.filter(F.array(*(F.when(F.contains(F.col("seq"), F.lit(f" {run} ")), F.lit(name)) for name, run in RULES)), lambda x: x.isNotNull())
    rows = rows.select("doc_id", F.size("known").cast("bigint").alias("n_known"), F.array_join("known", " ").alias("sentence_ids"), F.array_distinct(hits).alias("hits"))
    return rows.select("doc_id", "n_known", "sentence_ids", F.array_join("hits", " ").alias("rules"), F.coalesce(F.try_element_at("hits", F.lit(1)), F.lit("")).alias("license"))


def oracle() -> str:
    """The same result in DuckDB SQL."""
    label = "CASE s " + " ".join(f"WHEN '{words}' THEN '{name}'" for name, words in SENTENCES.items()) + " ELSE '-' END"
    tests = ", ".join(f"CASE WHEN contains(seq, ' {run} ') THEN '{name}' END" for name, run in RULES)
    split = SPLIT.replace("\\x09-\\x0D\\x20", r"\t\n\v\f\r ")
    distinct = "list_filter(hits, lambda x, i: list_position(hits, x) = i)"
    return f"""
WITH cut AS (
  SELECT doc_id, list_filter(list_transform(regexp_split_to_array(lower(coalesce(text, '')), '{split}'),
         lambda s: trim(regexp_replace(s, '{JUNK}', ' ', 'g'), ' .')), lambda s: s <> '') AS parts FROM documents),
named AS (SELECT doc_id, list_transform(parts, lambda s: {label}) AS ids FROM cut),
seqs AS (SELECT doc_id, list_filter(ids, lambda x: x <> '-') AS known, ' ' || array_to_string(ids, ' ') || ' ' AS seq FROM named),
tried AS (SELECT doc_id, known, list_filter([{tests}], lambda x: x IS NOT NULL) AS hits FROM seqs),
ruled AS (SELECT doc_id, known, {distinct} AS hits FROM tried)
SELECT CAST(doc_id AS BIGINT) AS doc_id, CAST(len(known) AS BIGINT) AS n_known, coalesce(array_to_string(known, ' '), '') AS sentence_ids,
       coalesce(array_to_string(hits, ' '), '') AS rules, coalesce(hits[1], '') AS license FROM ruled"""
