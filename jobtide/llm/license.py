"""Licence recognition by sentences and rules.

Known sentences are looked for in the text, whatever signs and line breaks stand between
their words, and become identifiers. The sequence of identifiers is matched against ordered rules, longer ones first; what a rule
has matched is taken out, so that a licence is not found again inside another.

All of it is DataFrame work within a row: nothing is shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Sentences of licence texts and notices.
SENTENCES = {
    "ApacheLic": "Licensed under the Apache License, Version 2.0",
    "ApacheLicThe": 'Licensed under the Apache License, Version 2.0 (the "License")',
    "ApacheUse": "you may not use this file except in compliance with the License",
    "ApacheCopy": "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
    "ApacheDist": 'Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied',
    "ApacheSee": "See the License for the specific language governing permissions and limitations under the License",
    "MitRef": "Released under the MIT License",
    "MitLic": "Licensed under the MIT License",
    "MitTitle": "The MIT License (MIT)",
    "MitGrant": 'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:',
    "MitNotice": "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software",
    "AsIsMit": 'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT',
    "BsdGrant": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",
    "BsdSource": "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer",
    "BsdBinary": "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution",
    "BsdEndorse": "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission",
    "BsdLic": "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file",
    "IscGrant": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies",
    "Gpl3Work": "This work is licensed under the GNU General Public License, version 3",
    "Gpl3Lic": "Licensed under the GNU General Public License, version 3",
    "Gpl2Lic": "Licensed under the GNU General Public License, version 2",
    "GplFree": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version",
    "GplFree2": "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version",
    "GplHope": "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE",
    "GplSee": "See the GNU General Public License for more details",
    "Mpl2": "This Source Code Form is subject to the terms of the Mozilla Public License, v",
    "MplCopy": "If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/",
    "CcByNc4": "Licensed under CC BY-NC 4.0",
    "CcBy4": "Licensed under CC BY 4.0",
    "CcBySa4": "Licensed under CC BY-SA 4.0",
    "Cc0": "This work is dedicated to the public domain under CC0 1.0",
    "SpdxApache": "SPDX-License-Identifier: Apache-2.0",
    "SpdxMit": "SPDX-License-Identifier: MIT",
    "SpdxGpl3": "SPDX-License-Identifier: GPL-3.0-only",
    "SpdxBsd3": "SPDX-License-Identifier: BSD-3-Clause",
    "Rights": "All rights reserved",
}

#: Sequences of sentences, the first that matches wins; each names a licence.
RULES = (
    ("Apache-2.0", ("ApacheLicThe", "ApacheUse", "ApacheCopy", "ApacheDist", "ApacheSee")),
    ("MIT", ("MitTitle", "MitGrant", "MitNotice", "AsIsMit")),
    ("MIT", ("MitGrant", "MitNotice", "AsIsMit")),
    ("BSD-3-Clause", ("BsdGrant", "BsdSource", "BsdBinary", "BsdEndorse")),
    ("BSD-2-Clause", ("BsdGrant", "BsdSource", "BsdBinary")),
    ("GPL-3.0-or-later", ("GplFree", "GplHope", "GplSee")),
    ("GPL-2.0-or-later", ("GplFree2", "GplHope", "GplSee")),
    ("MPL-2.0", ("Mpl2", "MplCopy")),
    ("Apache-2.0", ("ApacheLicThe",)),
    ("Apache-2.0", ("ApacheLic",)),
    ("Apache-2.0", ("SpdxApache",)),
    ("MIT", ("MitRef",)),
    ("MIT", ("MitLic",)),
    ("MIT", ("MitTitle",)),
    ("MIT", ("SpdxMit",)),
    ("BSD", ("BsdLic",)),
    ("BSD-3-Clause", ("SpdxBsd3",)),
    ("ISC", ("IscGrant",)),
    ("GPL-3.0-or-later", ("GplFree",)),
    ("GPL-2.0-or-later", ("GplFree2",)),
    ("GPL-3.0-only", ("Gpl3Work",)),
    ("GPL-3.0-only", ("Gpl3Lic",)),
    ("GPL-3.0-only", ("SpdxGpl3",)),
    ("GPL-2.0-only", ("Gpl2Lic",)),
    ("MPL-2.0", ("Mpl2",)),
    ("CC-BY-NC-4.0", ("CcByNc4",)),
    ("CC-BY-SA-4.0", ("CcBySa4",)),
    ("CC-BY-4.0", ("CcBy4",)),
    ("CC0-1.0", ("Cc0",)),
)

#: What divides a text into lines and sentences, where no sentence goes on over a line's end.
ENDS = r"\n|[.!?]+[\x20\x09-\x0D]+"
#: What divides the words of a normalised sentence.
SIGNS = r"[^A-Za-z0-9]+"


def normalised(sentence: str) -> str:
    """A sentence as it is compared: ASCII letters in lower case and digits, single spaces between."""
    import re

    return re.sub(SIGNS, " ", sentence).strip().lower()


def known(sentences: dict[str, str]) -> dict[str, str]:
    """Normalised sentence to identifier. A long sentence with a stop inside counts by its parts."""
    import re

    out = {}
    for name, text in sentences.items():
        parts = [p for p in re.split(ENDS, text) if normalised(p)]
        if len(parts) > 1:
            raise ValueError(f"{name} is more than one sentence")
        out[normalised(parts[0])] = name
    return out


def pattern(sentences: dict[str, str]) -> str:
    """A regular expression of any known sentence in a text, with the signs before it.

    A sentence starts and ends with the text, a line, a stop, a semicolon or a colon; inside
    there may be line breaks and comment signs, but no stop that white space follows. The
    longest is taken. Signs are passed over once, so time is linear in a run of them.
    """
    sign, space = "[^A-Za-z0-9]", r"[\x20\x09-\x0D]"
    end = rf"(?={sign}*?(?:\n|[.!?;:]{space}))"
    gap = rf"(?!{sign}*?[.!?]{space}){sign}++"
    known_ones = "|".join(s.replace(" ", gap) for s in sorted(known(sentences), key=lambda s: (-len(s), s)))
    return rf"(?i)(?:\A|(?<=[A-Za-z0-9]){end}){sign}*+(?:{known_ones})(?![A-Za-z0-9])(?:{end}|(?={sign}*+\z))"


def plain_sentences(text: Column, sentences: dict[str, str] = SENTENCES) -> Column:
    """The known sentences of a text, normalised, in order."""
    found = F.regexp_extract_all(text, F.lit(pattern(sentences)), F.lit(0))
    return F.transform(found, lambda s: F.lower(F.trim(F.regexp_replace(s, SIGNS, " "))))


def recognise(
    docs: DataFrame, sentences: dict[str, str] = SENTENCES, rules: tuple[tuple[str, tuple[str, ...]], ...] = RULES, text: str = "text"
) -> DataFrame:
    """``docs`` with sentence_ids, licences (in order of rules, each rule once) and unmatched, the known sentences no rule took.

    Null, empty and blank texts have none. Long sentences need their whole text, wrapped or
    not: a part is not recognised. Columns of one of the new names are replaced.
    """
    kept = [c for c in docs.columns if c.lower() not in ("sentence_ids", "licences", "unmatched")]
    named = known(sentences)
    ids = F.create_map(*[x for s, i in named.items() for x in (F.lit(s), F.lit(i))])
    table = F.array(*[F.struct(F.lit(name).alias("name"), F.lit("," + ",,".join(seq) + ",").alias("seq")) for name, seq in rules])
    start = F.struct(
        F.concat(F.lit(","), F.array_join("ids", ",,"), F.lit(",")).alias("left"), F.array().cast("array<string>").alias("found")
    )

    def apply(acc, rule):
        hit = F.contains(acc["left"], rule["seq"])
        return F.struct(
            F.when(hit, F.replace(acc["left"], rule["seq"], F.lit(""))).otherwise(acc["left"]).alias("left"),
            F.when(hit, F.concat(acc["found"], F.array(rule["name"]))).otherwise(acc["found"]).alias("found"),
        )

    # the row travels as one struct, so no name of its can clash
    none = F.array().cast("array<string>")
    # step by step, as a lambda computes again what it refers to, unless that is a column
    plain = plain_sentences(F.coalesce(F.col(text), F.lit("")), sentences)
    out = docs.select(F.struct(*kept).alias("row"), plain.alias("plain"))
    out = out.select("row", F.transform("plain", lambda s: ids[s]).alias("ids"))
    out = out.select("row", "ids", F.when(F.size("ids") > 0, F.aggregate(table, start, apply)).alias("m"))
    left = F.filter(F.split("m.left", ","), lambda s: s != "")
    return out.select(
        "row.*",
        F.col("ids").alias("sentence_ids"),
        F.array_distinct(F.coalesce("m.found", none)).alias("licences"),
        F.coalesce(left, none).alias("unmatched"),
    )
