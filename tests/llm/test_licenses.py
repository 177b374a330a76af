import re
import textwrap

from strata.llm import licenses, queries

SF = "/root/testdata/sf0.01"
KNOWN = {t: name for name, texts in licenses.SENTENCES.items() for t in texts}


def brute(text):
    """Identifiers and licences, sentence by sentence and rule by rule."""
    ids = []
    for s in re.split(r"\n|(?<=[.!?;:])[ \t\n\x0b\f\r]+", text or ""):
        s = re.sub("[^a-z0-9]+", " ", s.lower()).strip()
        if s in KNOWN:
            ids.append(KNOWN[s])
    left, names = list(ids), []
    for name, wanted in licenses.RULES:
        i = 0
        hit = False
        while i < len(left):
            at, ok = [i], left[i] == wanted[0]
            for w in wanted[1:]:
                # the farthest that the gap allows, as a greedy pattern finds it
                near = [j for j in range(at[-1] + 1, min(len(left), at[-1] + 2 + licenses.GAP)) if left[j] == w] if ok else []
                ok = bool(near)
                if ok:
                    at.append(near[-1])
            if ok:
                hit = True
                del left[i:at[-1] + 1]
            else:
                i += 1
        if hit and name not in names:
            names.append(name)
    return ids, names


def test_query_equals_brute_force(spark):
    rows = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    got = {r.doc_id: r for r in queries.QUERIES["op9_license_scan"](spark, SF).collect()}
    assert len(got) == len(rows)
    for r in rows:
        ids, names = brute(r.text)
        assert (got[r.doc_id].n_sentences, got[r.doc_id].sentence_ids, got[r.doc_id].licences) == (
            len(ids), ",".join(ids), ",".join(names))
    assert len({r.licences for r in got.values()}) >= 4


def test_rules_are_ordered_and_spend_sentences(spark):
    apache = ["Licensed under the Apache License, Version 2.0 (the \"License\");",
              "you may not use this file except in compliance with the License.", "You may obtain a copy of the License at:"]
    gpl = "This work is licensed under the GNU General Public License, version 3."
    texts = [None, "", "no licence here", "\n".join(apache), " ".join(apache), "\n".join([apache[0], gpl, apache[1], "x", apache[2]]),
             "\n".join(apache[::-1]), "\n".join([apache[0], gpl, gpl, gpl, apache[1], apache[2]]),
             "\n".join([gpl, "Released under the MIT License.", gpl]), "word. " * 30000 + "\nReleased under the MIT license!",
             "Unreleased under the MIT License.", "ALL RIGHTS RESERVED"]
    docs = spark.createDataFrame([(i, t, "ids", 1) for i, t in enumerate(texts)], "doc_id long, text string, lines string, ids int")
    got = {r.doc_id: (r.sentence_ids, r.licences) for r in licenses.scan(docs).collect()}
    assert got == {i: brute(t) for i, t in enumerate(texts)}
    assert got[3][1] == got[4][1] == ["Apache-2.0"] and got[5][1] == ["Apache-2.0"]
    assert licenses.scan(docs.limit(0)).collect() == []


def test_native_plan(spark):
    docs = spark.createDataFrame([(1, "x")], "doc_id long, text string")
    plan = licenses.scan(docs)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Exchange" not in plan


GPL = ["This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License "
       "as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
       "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty "
       "of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the GNU General Public License for more details.",
       "You should have received a copy of the GNU General Public License along with this program.  If not, see "
       "<https://www.gnu.org/licenses/>."]
MIT = ["MIT License", "Copyright (c) 2024 Some One",
       'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation '
       'files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, '
       'modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the '
       'Software is furnished to do so, subject to the following conditions:',
       "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
       'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE '
       'WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR '
       'COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM.']
BSD = ["Copyright (c) 2024, Some One",
       "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following "
       "conditions are met:",
       "1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.",
       "2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following "
       "disclaimer in the documentation and/or other materials provided with the distribution."]
APACHE = ["Copyright 2024 Some One",
          'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the '
          'License. You may obtain a copy of the License at', "    http://www.apache.org/licenses/LICENSE-2.0",
          "Unless required by applicable law or agreed to in writing, software is distributed on an \"AS IS\" BASIS."]
CC0 = ["To the extent possible under law, the author(s) have dedicated all copyright and related and neighboring rights to this "
       "software to the public domain worldwide. This software is distributed without any warranty."]
HEADERS = [
    (GPL, "GPL-FREE,GPL-HOPE,GPL-COPY", ["GPL-3.0"]), (MIT, "MIT-GRANT,MIT-KEEP,AS-IS", ["MIT"]),
    (BSD, "BSD-USE,BSD-SOURCE,BSD-BINARY", ["BSD-2-Clause"]),
    (APACHE, "APACHE-NOTICE,APACHE-COMPLY,APACHE-COPY", ["Apache-2.0"]), (CC0, "CC0", ["CC0-1.0"]),
    (["This project is licensed under the MIT License - see the [LICENSE](LICENSE) file for details."], "MIT-NOTICE", ["MIT"]),
]


def found(spark, texts):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    return [(",".join(r.sentence_ids), r.licences) for r in sorted(licenses.scan(docs).collect())]


def test_whole_headers_as_written(spark):
    texts, wanted = [], []
    for paragraphs, ids, names in HEADERS:
        for width in (24, 40, 60, 80, 10000):
            for sign, end in (("", "\n"), ("# ", "\n"), (" * ", "\r\n"), ("    ", "  \n")):
                lines = [sign.rstrip() if not i and n else sign + x for n, p in enumerate(paragraphs)
                         for i, x in enumerate([""] * (n > 0) + textwrap.wrap(p, width, break_long_words=False))]
                texts.append("def f(): pass" + end * 2 + end.join(lines) + end * 2 + "import os")
                wanted.append((ids, names))
    assert found(spark, texts) == wanted


def test_where_known_sentences_start_and_end(spark):
    assert found(spark, [
        "all rights\n\nreserved", "All rights. Reserved", "# All rights\n#\n# reserved", "no: all rights reserved", "All rights\nreserved",
        "ALL RIGHTS  RESERVED;", "not all rights\nreserved", "all rights\nreserved here", "all\nrights\nreserved\nall rights reserved",
        "a\n" * 50000 + "\n" * 50000 + "released under\nthe MIT license", "; " * 50000 + "all rights reserved",
    ]) == [("", [])] * 3 + [("ALL-RIGHTS", ["proprietary"])] * 3 + [("", [])] * 2 + [
        ("ALL-RIGHTS,ALL-RIGHTS", ["proprietary"]), ("MIT-NOTICE", ["MIT"]), ("ALL-RIGHTS", ["proprietary"])]


def test_every_known_sentence_is_found(spark):
    known = [(t, name) for table in (licenses.SENTENCES, licenses.FULL) for name, texts in table.items() for t in texts]
    assert [ids for ids, _ in found(spark, [t for t, _ in known])] == [name for _, name in known]


OTHERS = [
    (BSD + ["3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote "
            "products derived from this software without specific prior written permission.",
            'THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, '
            "INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE "
            "DISCLAIMED."], "BSD-USE,BSD-SOURCE,BSD-BINARY,BSD-NAME,BSD-AS-IS", ["BSD-3-Clause"]),
    (["This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not "
      "distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."], "MPL2-NOTICE,MPL2-COPY", ["MPL-2.0"]),
    (["This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public "
      "License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later "
      "version."], "LGPL21-FREE", ["LGPL-2.1"]),
    ([GPL[0].replace("version 3", "version 2").replace("software:", "software;")], "GPL2-FREE", ["GPL-2.0"]),
    ([GPL[0].replace("GNU General", "GNU Affero General")], "AGPL3-FREE", ["AGPL-3.0"]),
    (["Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, "
      "provided that the above copyright notice and this permission notice appear in all copies.",
      'THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL '
      "IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS."], "ISC-GRANT,ISC-AS-IS", ["ISC"]),
    (["SPDX-License-Identifier: GPL-2.0-or-later"], "TAG-GPL-2.0", ["GPL-2.0"]),
    (["This software is released under the BSD 3-Clause License."], "NAMED-BSD-3-Clause", ["BSD-3-Clause"]),
    (["This is free and unencumbered software released into the public domain."], "UNLICENSE", ["Unlicense"]),
    (["the software is provided as is, without warranty of any kind, express or implied"], "AS-IS", []),
]


def wrapped():
    """Every licence text wrapped at several widths behind several signs."""
    for paragraphs, ids, names in HEADERS + OTHERS:
        for width, sign in ((30, "# "), (60, " * "), (79, "// "), (10000, "")):
            lines = [sign.rstrip() if not i and n else sign + x for n, p in enumerate(paragraphs)
                     for i, x in enumerate([""] * (n > 0) + textwrap.wrap(p, width, break_long_words=False))]
            yield "\n".join(["import os", "", *lines, "", "x = 1"]), ids, names


def test_whole_licences_and_notices(spark):
    texts, ids, names = zip(*wrapped())
    assert found(spark, texts) == list(zip(ids, names))


def test_sql_knows_wrapped_sentences(spark):
    import duckdb

    texts = [t for t, _, _ in wrapped()] + [None, "", "all\nrights\nreserved\nall rights reserved", "a. All rights reserved!"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    con = duckdb.connect()
    con.register("documents", docs.toArrow())
    want = sorted((k, ids, names) for k, _, ids, names in con.execute(licenses.oracle()).fetchall())
    assert want == [(i, ids, ",".join(names)) for i, (ids, names) in enumerate(found(spark, texts))]


def test_no_two_sentences_are_one():
    """A text has one identifier, and enough words to be looked up."""
    texts = [t for table in (licenses.SENTENCES, licenses.FULL) for x in table.values() for t in x]
    assert len(texts) == len(set(texts)) == len(licenses.known())
    assert all(len(t.split(" ")) >= licenses.LEAD and re.fullmatch("[a-z0-9 ]+", t) for t in texts)
    used = {i for _, ids in licenses.RULES for i in ids}
    assert used <= set(licenses.known().values())
