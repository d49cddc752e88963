"""Licence recognition by sentences and ordered rules.

A text is normalised to lower-case ASCII words with marks at line ends and at stops (. ! ? : followed
by white space).  A known sentence is found where its words follow one another from one mark to
another without a stop between; line ends between its words, and comment leaders behind them, count
as spaces, so wrapped and commented notices are known as well as short lines without a stop.  Of
sentences that begin at one mark the longest is taken.  Found sentences become identifiers.  The document's
sequence of identifiers is then matched against the licence rules in order: a rule whose
identifiers stand in the sequence one after the other names its licence and takes them away, so a
longer rule goes before the shorter ones it holds.  Identifiers no rule took are reported too.
Everything is one expression per row: no join, no shuffle.

Defined cases: null or empty text -> no sentence known, no licence; null doc_id and repeated rows
are kept as they are; unknown sentences between known ones do not matter; an empty table gives no
rows; other columns are ignored.  A reservation of all rights names "Proprietary" only where no other licence
was found, as most notices of free licences hold one too.  An ``SPDX-License-Identifier:`` tag counts as a
sentence of its own, its colon is no stop.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from layerforge.llm.common import texts_of

# Known sentences of public licence texts and notices (fixed values): identifier, sentence.
SENTENCES = [
    ("AllRights", "All rights reserved."),
    ("ApacheVersion", "Licensed under the Apache License, Version 2.0."),
    ("ApacheGrant", 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License.'),
    ("ApacheCopy", "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0"),
    ("ApacheAsIs", 'Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.'),
    ("ApacheSee", "See the License for the specific language governing permissions and limitations under the License."),
    ("MITShort", "Released under the MIT License."),
    ("MITLicensed", "Licensed under the MIT License."),
    ("MITGrant", 'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:'),
    ("MITNotice", "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software."),
    ("MITWarranty", 'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT.'),
    ("BSDCondition", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:"),
    ("BSDSource", "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer."),
    ("BSDBinary", "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution."),
    ("BSDNames", "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission."),
    ("BSDAsIs", 'THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED.'),
    ("ISCGrant", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("ISCWarranty", 'THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS.'),
    ("ZlibAsIs", "This software is provided 'as-is', without any express or implied warranty."),
    ("ZlibGrant", "Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions:"),
    ("BoostGrant", "Distributed under the Boost Software License, Version 1.0."),
    ("EPLTerms", "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 which is available at https://www.eclipse.org/legal/epl-2.0/"),
    ("GPL2Free", "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version."),
    ("LGPL21Free", "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version."),
    ("LGPL3Free", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("LGPLHope", "This library is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE."),
    ("LGPLSee", "See the GNU Lesser General Public License for more details."),
    ("AGPLFree", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("AGPLSee", "See the GNU Affero General Public License for more details."),
    ("GPL3Short", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL2Short", "This work is licensed under the GNU General Public License, version 2."),
    ("GPLFree", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("GPLHope", "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE."),
    ("GPLSee", "See the GNU General Public License for more details."),
    ("LGPLShort", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("CCBY", "Licensed under CC BY 4.0."),
    ("CCBYSA", "Licensed under CC BY-SA 4.0."),
    ("CCBYNC", "Licensed under CC BY-NC 4.0."),
    ("CCBYLong", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC0", "Dedicated to the public domain under CC0 1.0."),
    ("MPLCopy", "If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."),
    ("MPL", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("UnlicenseFree", "This is free and unencumbered software released into the public domain."),
]

# Ordered licence rules (fixed values): licence, identifiers one after the other.
RULES = [
    ("Apache-2.0", ["ApacheGrant", "ApacheCopy", "ApacheAsIs", "ApacheSee"]),
    ("Apache-2.0", ["ApacheGrant", "ApacheCopy"]),
    ("Apache-2.0", ["ApacheGrant"]),
    ("Apache-2.0", ["ApacheVersion"]),
    ("MIT", ["MITGrant", "MITNotice", "MITWarranty"]),
    ("MIT", ["MITGrant", "MITNotice"]),
    ("MIT", ["MITShort"]),
    ("MIT", ["MITLicensed"]),
    ("BSD-3-Clause", ["BSDCondition", "BSDSource", "BSDBinary", "BSDNames", "BSDAsIs"]),
    ("BSD-3-Clause", ["BSDCondition", "BSDSource", "BSDBinary", "BSDNames"]),
    ("BSD-2-Clause", ["BSDCondition", "BSDSource", "BSDBinary", "BSDAsIs"]),
    ("BSD-2-Clause", ["BSDCondition", "BSDSource", "BSDBinary"]),
    ("GPL-3.0-or-later", ["GPLFree", "GPLHope", "GPLSee"]),
    ("GPL-3.0-or-later", ["GPLFree"]),
    ("AGPL-3.0-or-later", ["AGPLFree", "GPLHope", "AGPLSee"]),
    ("AGPL-3.0-or-later", ["AGPLFree"]),
    ("GPL-2.0-or-later", ["GPL2Free", "GPLHope", "GPLSee"]),
    ("GPL-2.0-or-later", ["GPL2Free"]),
    ("LGPL-3.0-or-later", ["LGPL3Free", "LGPLHope", "LGPLSee"]),
    ("LGPL-3.0-or-later", ["LGPL3Free"]),
    ("LGPL-2.1-or-later", ["LGPL21Free", "LGPLHope", "LGPLSee"]),
    ("LGPL-2.1-or-later", ["LGPL21Free"]),
    ("ISC", ["ISCGrant", "ISCWarranty"]),
    ("ISC", ["ISCGrant"]),
    ("Zlib", ["ZlibAsIs", "ZlibGrant"]),
    ("Zlib", ["ZlibGrant"]),
    ("BSL-1.0", ["BoostGrant"]),
    ("EPL-2.0", ["EPLTerms"]),
    ("GPL-3.0", ["GPL3Short"]),
    ("GPL-2.0", ["GPL2Short"]),
    ("LGPL-3.0", ["LGPLShort"]),
    ("CC-BY-4.0", ["CCBY"]),
    ("CC-BY-SA-4.0", ["CCBYSA"]),
    ("CC-BY-NC-4.0", ["CCBYNC"]),
    ("CC-BY-4.0", ["CCBYLong"]),
    ("CC0-1.0", ["CC0"]),
    ("MPL-2.0", ["MPL", "MPLCopy"]),
    ("MPL-2.0", ["MPL"]),
    ("Unlicense", ["UnlicenseFree"]),
    ("Proprietary", ["AllRights"]),
]

# Licences that only hold where no other was found.
ALONE = {"Proprietary"}

# Licences known by their tag (fixed values, public identifiers); each is a sentence and a rule of its own.
TAG = "SPDX-License-Identifier:"
TAGS = ["Apache-2.0", "MIT", "BSD-2-Clause", "BSD-3-Clause", "ISC", "Zlib", "BSL-1.0", "EPL-2.0", "MPL-2.0", "Unlicense", "CC0-1.0",
        "CC-BY-4.0", "CC-BY-SA-4.0", "CC-BY-NC-4.0", "GPL-2.0-only", "GPL-2.0-or-later", "GPL-3.0-only", "GPL-3.0-or-later",
        "LGPL-2.1-only", "LGPL-2.1-or-later", "LGPL-3.0-only", "LGPL-3.0-or-later", "AGPL-3.0-only", "AGPL-3.0-or-later"]
SENTENCES += [("Tag" + re.sub("[^A-Za-z0-9]", "", t), f"{TAG} {t}") for t in TAGS]
RULES += [(t, ["Tag" + re.sub("[^A-Za-z0-9]", "", t)]) for t in TAGS]
RULES.sort(key=lambda rule: rule[0] in ALONE)

STOP = "\x01"  # mark of a stop in a normalised text
LEADERS = ["dnl", "rem"]  # words that begin a comment line; marks such as # or * are no words anyway


def normalise(sentence: str) -> str:
    """The driver's form of the row expression below, for the table of known sentences."""
    return re.sub("[^A-Za-z0-9]+", " ", sentence).strip().lower()


def _known_parts(sentences: list[tuple[str, str]]) -> dict[str, str]:
    """Normalised sentence -> identifier.  A stop inside (as after "v.") keeps the longest part."""
    out = {}
    for name, sentence in sentences:
        part = max(re.split("[.!?:]+[ \\t\\r]+|\\n", sentence.replace(TAG, TAG[:-1])), key=len)
        out[normalise(part)] = name
    return out


def _steps(known: dict[str, str]) -> list[tuple[str, str, str]]:
    """(pattern, replacement, flags) that bring a text between two line ends into its normal form."""
    return [(f"{TAG[:-1]}:", f"{TAG[:-1]} ", "i"), ("[.!?:][ \\t\\r\\n]+", STOP, ""), (f"[^A-Za-z0-9\\n{STOP}]+", " ", "")]


def _either(known: dict[str, str]) -> str:
    return "|".join(w.replace(" ", "[ \\n]+") for w in sorted(known, key=lambda w: (-len(w), w)))


def sentence_ids(text: Column, sentences: list[tuple[str, str]] = SENTENCES) -> Column:
    """Identifiers of the known sentences of a text, in their order."""
    known = _known_parts(sentences)
    table = F.create_map(*[F.lit(x) for kv in known.items() for x in kv])
    words = F.concat(F.lit("\n"), F.replace(text, F.lit(STOP), F.lit(" ")), F.lit("\n"))
    for pattern, by, flags in _steps(known):
        words = F.regexp_replace(words, f"(?{flags}){pattern}" if flags else pattern, by)
    words = F.regexp_replace(F.lower(words), f"([\\n{STOP}]) ?(?:{'|'.join(LEADERS)})(?![a-z0-9])", "$1")
    found = F.regexp_extract_all(words, F.lit(f"[\\n{STOP}] ?({_either(known)})(?= ?[\\n{STOP}])"), 1)
    return F.transform(found, lambda w: F.element_at(table, F.regexp_replace(w, "[ \\n]+", " ")))


def matched_rules(ids: Column, rules: list[tuple[str, list[str]]] = RULES) -> Column:
    """struct(rest, found): what the ordered rules leave of a sequence, and the licences they name."""
    table = F.array(*[F.struct(F.lit(name).alias("licence"), F.lit(_written(seq)).alias("seq")) for name, seq in rules])
    start = F.struct(F.array_join(F.transform(ids, lambda i: F.concat(F.lit("<"), i, F.lit(">"))), "").alias("rest"),
                     F.array().cast("array<string>").alias("found"))

    def step(acc: Column, rule: Column) -> Column:
        # What is taken leaves a mark, so its neighbours do not become one sequence.
        left = F.replace(acc["rest"], rule["seq"], F.lit(";"))
        named = F.when(rule["licence"].isin(*ALONE) & (F.size(acc["found"]) > 0), acc["found"]).otherwise(
            F.array_append(acc["found"], rule["licence"]))
        return F.when(F.contains(acc["rest"], rule["seq"]), F.struct(left.alias("rest"), named.alias("found"))).otherwise(acc)

    return F.aggregate(table, start, step)


def _written(seq: list[str]) -> str:
    return "".join(f"<{i}>" for i in seq)


def scan_licences(docs: DataFrame, sentences: list[tuple[str, str]] = SENTENCES,
                  rules: list[tuple[str, list[str]]] = RULES) -> DataFrame:
    """doc_id, n_known, sentence_ids, licences, unmatched (comma-joined) of every row."""
    ids = texts_of(docs).select("doc_id", sentence_ids(F.col("text"), sentences).alias("ids"))
    none = F.struct(F.lit("").alias("rest"), F.array().cast("array<string>").alias("found"))
    done = ids.withColumn("m", F.when(F.size("ids") > 0, matched_rules(F.col("ids"), rules)).otherwise(none))
    return done.select(
        "doc_id", F.size("ids").cast("long").alias("n_known"), F.array_join("ids", ",").alias("sentence_ids"),
        F.array_join(F.array_distinct("m.found"), ",").alias("licences"),
        F.array_join(F.regexp_extract_all("m.rest", F.lit("<([A-Za-z0-9]+)>"), 1), ",").alias("unmatched"))


def oracle_sql(sentences: list[tuple[str, str]] = SENTENCES, rules: list[tuple[str, list[str]]] = RULES) -> str:
    """DuckDB SQL of ``scan_licences``: one step of the rules after the other.

    Its patterns cannot look ahead, so every mark stands twice: one ends a sentence, one begins the next.
    """
    known = _known_parts(sentences)
    table = ", ".join(f"'{k}': '{v}'" for k, v in known.items())
    words = "chr(10) || replace(coalesce(text, ''), chr(1), ' ') || chr(10)"
    for pattern, by, flags in _steps(known):
        words = f"regexp_replace({words}, '{pattern}', '{by}', 'g{flags}')"
    words = f"regexp_replace(lower({words}), '([\\n{STOP}]) ?(?:{'|'.join(LEADERS)})([^a-z0-9])', '\\1\\2', 'g')"
    sql = f"""WITH w AS (SELECT doc_id, regexp_replace({words}, '([\\n{STOP}])', '\\1\\1', 'g') AS words FROM documents),
i AS (SELECT doc_id, list_transform(regexp_extract_all(words, '[\\n{STOP}] ?({_either(known)}) ?[\\n{STOP}]', 1),
  lambda s: (MAP {{{table}}})[regexp_replace(s, '[ \\n]+', ' ', 'g')]) AS ids FROM w),
r0 AS (SELECT doc_id, ids, list_aggregate(list_transform(ids, lambda x: '<' || x || '>'), 'string_agg', '') AS rest, CAST([] AS VARCHAR[]) AS found FROM i)"""
    for k, (name, seq) in enumerate(rules):
        alone = " AND len(found) = 0" if name in ALONE else ""
        sql += f""",
r{k + 1} AS (SELECT doc_id, ids, replace(rest, '{_written(seq)}', ';') AS rest,
  CASE WHEN contains(rest, '{_written(seq)}'){alone} THEN list_append(found, '{name}') ELSE found END AS found FROM r{k})"""
    return sql + f"""
SELECT doc_id, CAST(len(ids) AS BIGINT) AS n_known, array_to_string(ids, ',') AS sentence_ids,
  coalesce(array_to_string(list_filter(found, lambda x, k: list_position(found, x) = k), ','), '') AS licences,
  array_to_string(regexp_extract_all(coalesce(rest, ''), '<([A-Za-z0-9]+)>', 1), ',') AS unmatched
FROM r{len(rules)}"""
