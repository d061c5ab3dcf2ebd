import re

from helpers import ODD, frame, rows

from jobtide.llm import license


def brute(text):
    table = license.known(license.SENTENCES)
    ids = [table[s] for p in re.split(license.ENDS, text or "") if (s := license.normalised(p)) in table]
    left, found = list(ids), []
    for name, seq in license.RULES:
        hit, i = False, 0
        while i + len(seq) <= len(left):
            if tuple(left[i : i + len(seq)]) == seq:
                del left[i : i + len(seq)]
                hit = True
            else:
                i += 1
        if hit and name not in found:
            found.append(name)
    return ids, found, left


S = license.SENTENCES
TEXTS = [
    "Some code. Released under the MIT License.",
    "# Licensed under the Apache License, Version 2.0 (the \"License\");\n# you may not use this file except in compliance with the License.",
    S["MitTitle"] + "\n" + S["MitGrant"] + "\n" + S["MitNotice"] + ".\n" + S["AsIsMit"] + ". IN NO EVENT",
    f"{S['BsdGrant']}\n1. {S['BsdSource']}.\n2. {S['BsdBinary']}.\n",
    " * ".join(["", *[S[i] + ".\n" for i in ("BsdGrant", "BsdSource", "BsdBinary", "BsdEndorse")]]),
    f"{S['GplHope']}. {S['GplSee']}. Licensed under CC BY-NC 4.0. Licensed under CC BY-NC 4.0.",
    "This work is licensed under the GNU General Public License, version 3. " * 3 + "Released under the MIT License",
    "not licensed under anything; released under the mit licence",
    "word " * 100_000 + "\nReleased under the MIT License.",
]


def test_equal_to_plain_python(spark):
    docs = [*ODD, *enumerate(TEXTS, 10)]
    got = license.recognise(frame(spark, docs)).select("text", "sentence_ids", "licences", "unmatched")
    for text, *found in rows(got):
        assert tuple(found) == brute(text), text
    by = {r[0]: r[1] for r in rows(license.recognise(frame(spark, docs)).select("doc_id", "licences"))}
    assert by[10] == ["MIT"] and by[11] == ["Apache-2.0"] and by[12] == ["MIT"] and by[14] == ["BSD-3-Clause"] and by[17] == []


def test_longer_rules_come_first():
    seqs = [s for _, s in license.RULES]
    for i, a in enumerate(seqs):
        for b in seqs[:i]:
            assert not any(a[k : k + len(b)] == b for k in range(len(a) - len(b) + 1)), (a, b)


def test_clashing_columns_and_empty_table(spark):
    docs = frame(spark, [(1, TEXTS[0], "x", "y")], "doc_id long, text string, licences string, _m string")
    got = license.recognise(docs)
    assert set(got.columns) >= {"doc_id", "text", "sentence_ids", "licences", "unmatched"} and got.first()["licences"] == ["MIT"]
    assert rows(license.recognise(docs.limit(0))) == []
    plan = got._jdf.queryExecution().toString()
    assert "Exchange" not in plan and "Python" not in plan


MIT = """MIT License

Copyright (c) 2020 Some One

Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR
IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY,
FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE
AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM.
"""
BSD = """Copyright (c) 2020, Some One
All rights reserved.

Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this
   list of conditions and the following disclaimer.
2. Redistributions in binary form must reproduce the above copyright notice,
   this list of conditions and the following disclaimer in the documentation
   and/or other materials provided with the distribution.
"""
ENDORSE = """3. Neither the name of the copyright holder nor the names of its
   contributors may be used to endorse or promote products derived from
   this software without specific prior written permission.
"""
APACHE = """Licensed under the Apache License, Version 2.0 (the "License");
you may not use this file except in compliance with the License.
You may obtain a copy of the License at

    http://www.apache.org/licenses/LICENSE-2.0

Unless required by applicable law or agreed to in writing, software
distributed under the License is distributed on an "AS IS" BASIS,
WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.
See the License for the specific language governing permissions and
limitations under the License.
"""
ISC = """Permission to use, copy, modify, and/or distribute this software for any
purpose with or without fee is hereby granted, provided that the above
copyright notice and this permission notice appear in all copies.
"""


def test_wrapped_texts(spark):
    kinds = {MIT: "MIT", BSD: "BSD-2-Clause", BSD + ENDORSE: "BSD-3-Clause", APACHE: "Apache-2.0", ISC: "ISC"}
    forms = (
        lambda t: t,
        lambda t: t.replace("\n", "\r\n"),
        lambda t: re.sub(r"(?<=\S)\n *(?=\S)", " ", t),
        lambda t: "/*\n" + "".join(f" * {x}".rstrip() + "\n" for x in t.splitlines()) + " */\nint x;",
        lambda t: "".join(f"# {x}\n" for x in t.splitlines()) + "x = 1",
        lambda t: "".join(f"// {x}\n" for x in t.splitlines()),
    )
    docs = [(i, f(t), n) for t, n in kinds.items() for i, f in enumerate(forms)]
    got = license.recognise(frame(spark, docs)).select("doc_id", "lang", "licences", "unmatched")
    for i, name, found, left in rows(got):
        assert found == [name] and left in ([], ["Rights"]), (i, name)


def test_parts_of_wrapped_sentences_are_not_recognised(spark):
    docs = [(1, MIT[:500]), (2, "It is not Released under\nthe MIT License."), (3, "Released under. The MIT License"), (4, "Released under the\nMIT Licenses"), (5, "\n* " * 100_000 + "Released under the MIT" + "\n =" * 100_000 + "x")]
    assert [r[0] for r in rows(license.recognise(frame(spark, docs)).select("licences"))] == [[]] * 5
