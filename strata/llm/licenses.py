"""License scans by sentence rules.

A text is normalised to words with marks between them, and the sentences in it
that a table knows become licence-sentence identifiers. A known sentence may be
wrapped over lines, and may hold ``;`` and ``:``; it starts and ends at a line's end
or after one of ``. ! ? ; :``, and no blank line and no ``. ! ?`` before white space
stands inside it. Where several known sentences start together the longest counts,
and the text of one is spent. Comment signs before wrapped lines are punctuation.

Sentences are looked up: at each mark the next ``LEAD`` words say how many words
the known sentences have that begin with them, and the hash of so many words is
the key of the identifier. The work grows with the marks of a text, not with the
number of known sentences in it or in the table.

A licence rule is an ordered list of identifiers; it matches where they follow
each other in the text, with at most ``GAP`` other known sentences and any
unknown ones between. Rules are tried in order, and the sentences of a match are
spent.

Everything is a DataFrame operation on one row at a time: no shuffle, no text
leaves its task. The table is a fixed rule set of some hundred sentences, a
literal in the plan.

Defined results: null and empty texts have no sentences and no licence.
Repeated rows each get a row; an empty table gives an empty result; other columns
are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

GAP = 2
LEAD = 3  # words by which a known sentence is looked up; all have as many at least

# Known licence sentences, normalised (lower case, letters, digits
# and single spaces), by identifier.
SENTENCES = {
    "APACHE-NOTICE": ["licensed under the apache license version 2 0",
                      "licensed under the apache license version 2 0 the license"],
    "APACHE-COMPLY": ["you may not use this file except in compliance with the license"],
    "APACHE-COPY": ["you may obtain a copy of the license at"],
    "GPL3-NOTICE": ["this work is licensed under the gnu general public license version 3",
                    "licensed under the gnu general public license version 3"],
    "GPL-FREE": ["this program is free software you can redistribute it and or modify it under the terms of the gnu "
                 "general public license as published by the free software foundation either version 3 of the license "
                 "or at your option any later version"],
    "GPL-HOPE": ["this program is distributed in the hope that it will be useful but without any warranty without even "
                 "the implied warranty of merchantability or fitness for a particular purpose"],
    "GPL-COPY": ["you should have received a copy of the gnu general public license along with this program"],
    "MIT-NOTICE": ["released under the mit license", "licensed under the mit license"],
    "MIT-GRANT": ["permission is hereby granted free of charge to any person obtaining a copy of this software and "
                  "associated documentation files the software to deal in the software without restriction"],
    "MIT-KEEP": ["the above copyright notice and this permission notice shall be included in all copies or substantial "
                 "portions of the software"],
    "AS-IS": ["the software is provided as is without warranty of any kind express or implied"],
    "BSD-USE": ["redistribution and use in source and binary forms with or without modification are permitted provided "
                "that the following conditions are met"],
    "BSD-SOURCE": ["redistributions of source code must retain the above copyright notice this list of conditions and "
                   "the following disclaimer"],
    "BSD-BINARY": ["redistributions in binary form must reproduce the above copyright notice this list of conditions "
                   "and the following disclaimer in the documentation and or other materials provided with the distribution"],
    "CC-BY": ["licensed under cc by 4 0"],
    "CC-BY-SA": ["licensed under cc by sa 4 0"],
    "CC-BY-NC": ["licensed under cc by nc 4 0"],
    "CC0": ["to the extent possible under law the author has waived all copyright and related rights"],
    "ALL-RIGHTS": ["all rights reserved"],
    "APACHE-BASIS": ["unless required by applicable law or agreed to in writing software distributed under the license is "
                     "distributed on an as is basis without warranties or conditions of any kind either express or implied"],
    "MIT-LIABLE": ["in no event shall the authors or copyright holders be liable for any claim damages or other liability "
                   "whether in an action of contract tort or otherwise arising from out of or in connection with the "
                   "software or the use or other dealings in the software"],
    "BSD-NAME": [f"neither the name of {who} may be used to endorse or promote products derived from this software without "
                 "specific prior written permission"
                 for who in ("the copyright holder nor the names of its contributors", "the copyright holders nor the names of "
                             "its contributors", "the author nor the names of its contributors",
                             "the university nor the names of its contributors")],
    "BSD-AS-IS": ["this software is provided by the copyright holders and contributors as is and any express or implied "
                  "warranties including but not limited to the implied warranties of merchantability and fitness for a "
                  "particular purpose are disclaimed"],
    "ISC-GRANT": [f"permission to use copy modify and {x}distribute this software for any purpose with or without fee is hereby "
                  "granted provided that the above copyright notice and this permission notice appear in all copies"
                  for x in ("", "or ")],
    "0BSD-GRANT": [f"permission to use copy modify and {x}distribute this software for any purpose with or without fee is "
                   "hereby granted" for x in ("", "or ")],
    "ISC-AS-IS": ["the software is provided as is and the author disclaims all warranties with regard to this software "
                  "including all implied warranties of merchantability and fitness"],
    "GPL2-FREE": ["this program is free software you can redistribute it and or modify it under the terms of the gnu general "
                  "public license as published by the free software foundation either version 2 of the license or at your "
                  "option any later version"],
    "GPL2-ONLY": [f"this program is free software you can redistribute it and or modify it under the terms of {x} as published "
                  "by the free software foundation" for x in ("the gnu general public license version 2",
                                                              "version 2 of the gnu general public license")],
    "LGPL21-FREE": [f"this {what} is free software you can redistribute it and or modify it under the terms of the gnu lesser "
                    "general public license as published by the free software foundation either version 2 1 of the license "
                    "or at your option any later version" for what in ("library", "program")],
    "LGPL3-FREE": [f"this {what} is free software you can redistribute it and or modify it under the terms of the gnu lesser "
                   "general public license as published by the free software foundation either version 3 of the license or "
                   "at your option any later version" for what in ("library", "program")],
    "AGPL3-FREE": ["this program is free software you can redistribute it and or modify it under the terms of the gnu affero "
                   "general public license as published by the free software foundation either version 3 of the license or at "
                   "your option any later version"],
    "LGPL-HOPE": ["this library is distributed in the hope that it will be useful but without any warranty without even the "
                  "implied warranty of merchantability or fitness for a particular purpose"],
    "MPL2-NOTICE": ["this source code form is subject to the terms of the mozilla public license v"],
    "MPL2-COPY": [f"if a copy of the mpl was not distributed with this file you can obtain one at {x} mozilla org mpl 2 0"
                  for x in ("http", "https", "http www", "https www")],
    "MPL11-NOTICE": ["the contents of this file are subject to the mozilla public license version 1 1 the license you may not "
                     "use this file except in compliance with the license"],
    "UNLICENSE": ["this is free and unencumbered software released into the public domain"],
    "ZLIB-GRANT": ["permission is granted to anyone to use this software for any purpose including commercial applications and "
                   "to alter it and redistribute it freely subject to the following restrictions"],
    "ZLIB-AS-IS": ["this software is provided as is without any express or implied warranty"],
    "WTFPL": ["everyone is permitted to copy and distribute verbatim or modified copies of this license document and changing "
              "it is allowed as long as the name is changed"],
    "EPL1": ["this program and the accompanying materials are made available under the terms of the eclipse public license v1 0 "
             "which accompanies this distribution"],
    "EPL2": ["this program and the accompanying materials are made available under the terms of the eclipse public license 2 0 "
             f"which is available at {x} www eclipse org legal epl 2 0" for x in ("http", "https")],
}

# Licences by their identifier and the names that notices call them by.
NAMES = {
    "Apache-2.0": ["apache license 2 0", "apache 2 0 license"], "BSD-2-Clause": ["bsd 2 clause license", "simplified bsd license"],
    "BSD-3-Clause": ["bsd 3 clause license", "new bsd license", "modified bsd license"], "ISC": ["isc license"],
    "MPL-2.0": ["mozilla public license 2 0", "mozilla public license version 2 0"], "Zlib": ["zlib license"],
    "GPL-2.0": ["gnu general public license version 2", "gnu gpl v2", "gplv2"], "GPL-3.0": ["gnu gpl v3", "gplv3"],
    "LGPL-2.1": ["gnu lesser general public license version 2 1", "lgplv2 1"],
    "LGPL-3.0": ["gnu lesser general public license version 3", "lgplv3"],
    "AGPL-3.0": ["gnu affero general public license version 3", "agplv3"], "BSL-1.0": ["boost software license version 1 0"],
    "EPL-1.0": ["eclipse public license 1 0"], "EPL-2.0": ["eclipse public license 2 0"], "Unlicense": ["unlicense"],
    "MIT": [], "CC0-1.0": [], "CC-BY-4.0": [], "CC-BY-SA-4.0": [], "CC-BY-NC-4.0": [], "0BSD": [], "WTFPL": [],
}
for _id, _names in NAMES.items():
    SENTENCES[f"NAMED-{_id}"] = [f"{x}{how} under the {name}" for name in _names for how in ("licensed", "released", "distributed")
                                 for x in ("", "this project is ", "this software is ", "this work is ", "this program is ")]
    # the tag of a file's header; the GNU licences' tags say which versions may be chosen
    _tags = [f"{_id}{x}" for x in ("", "-only", "-or-later")] if "GPL" in _id else [_id]
    SENTENCES[f"TAG-{_id}"] = ["spdx license identifier " + t.lower().replace("-", " ").replace(".", " ") for t in _tags]

# The licences' own sentences where they are longer than those above, and other usual notices.
FULL = {
    "APACHE-NOTICE": ["the asf licenses this file to you under the apache license version 2 0 the license"],
    "APACHE-COPY": [f"you may obtain a copy of the license at {x} www apache org licenses license 2 0" for x in ("http", "https")],
    "GPL-HOPE": ["this program is distributed in the hope that it will be useful but without any warranty without even "
                 "the implied warranty of merchantability or fitness for a particular purpose see the gnu general public "
                 "license for more details"],
    "MIT-NOTICE": [f"this {what} is {how} under the mit license{more}" for what in ("project", "software", "work", "code", "package")
                   for how in ("licensed", "released", "distributed")
                   for more in ("", " see the license file for details", " see the license md license md file for details",
                                " see the license license file for details")],
    "MIT-GRANT": ["permission is hereby granted free of charge to any person obtaining a copy of this software and "
                  "associated documentation files the software to deal in the software without restriction including "
                  "without limitation the rights to use copy modify merge publish distribute sublicense and or sell "
                  "copies of the software and to permit persons to whom the software is furnished to do so subject to "
                  "the following conditions"],
    "AS-IS": ["the software is provided as is without warranty of any kind express or implied including but not limited "
              "to the warranties of merchantability fitness for a particular purpose and noninfringement"],
    "CC-BY": ["this work is licensed under a creative commons attribution 4 0 international license"],
    "CC-BY-SA": ["this work is licensed under a creative commons attribution sharealike 4 0 international license"],
    "CC-BY-NC": ["this work is licensed under a creative commons attribution noncommercial 4 0 international license"],
    "CC0": [f"to the extent possible under law {who} waived all copyright and related or neighboring rights to this {what}"
            for who in ("the author has", "the author s have", "the authors have", "the person who associated cc0 with this work has")
            for what in ("work", "software")] +
           [f"to the extent possible under law {who} dedicated all copyright and related and neighboring rights to this "
            f"{what} to the public domain worldwide" for who in ("the author has", "the author s have", "the authors have")
            for what in ("work", "software")],
}

# Licence rules, most telling first: each is an ordered list of identifiers.
RULES = (
    ("Apache-2.0", ("APACHE-NOTICE", "APACHE-COMPLY", "APACHE-COPY")),
    ("GPL-3.0", ("GPL-FREE", "GPL-HOPE", "GPL-COPY")),
    ("MIT", ("MIT-GRANT", "MIT-KEEP", "AS-IS")),
    ("MIT", ("MIT-GRANT", "MIT-KEEP")),
    ("BSD-3-Clause", ("BSD-USE", "BSD-SOURCE", "BSD-BINARY", "BSD-NAME")),
    ("BSD-2-Clause", ("BSD-USE", "BSD-SOURCE", "BSD-BINARY")),
    ("GPL-2.0", ("GPL2-FREE",)),
    ("GPL-2.0", ("GPL2-ONLY",)),
    ("LGPL-2.1", ("LGPL21-FREE",)),
    ("LGPL-3.0", ("LGPL3-FREE",)),
    ("AGPL-3.0", ("AGPL3-FREE",)),
    ("MPL-2.0", ("MPL2-NOTICE", "MPL2-COPY")),
    ("MPL-2.0", ("MPL2-NOTICE",)),
    ("MPL-1.1", ("MPL11-NOTICE",)),
    ("ISC", ("ISC-GRANT",)),
    ("0BSD", ("0BSD-GRANT",)),
    ("Zlib", ("ZLIB-AS-IS", "ZLIB-GRANT")),
    ("Unlicense", ("UNLICENSE",)),
    ("WTFPL", ("WTFPL",)),
    ("EPL-1.0", ("EPL1",)),
    ("EPL-2.0", ("EPL2",)),
    ("Apache-2.0", ("APACHE-NOTICE",)),
    ("GPL-3.0", ("GPL-FREE",)),
    ("GPL-3.0", ("GPL3-NOTICE",)),
    ("MIT", ("MIT-NOTICE",)),
    ("CC-BY-NC-4.0", ("CC-BY-NC",)),
    ("CC-BY-SA-4.0", ("CC-BY-SA",)),
    ("CC-BY-4.0", ("CC-BY",)),
    ("CC0-1.0", ("CC0",)),
    *((name, (f"TAG-{name}",)) for name in NAMES),
    *((name, (f"NAMED-{name}",)) for name, called in NAMES.items() if called),
    ("proprietary", ("ALL-RIGHTS",)),
)

# A text without one of these has no known sentence; most texts stop here.
HINT = ("(?i)licens|permission|redistribut|warranty|copyright|rights[^a-z0-9]+reserved|under[^a-z0-9]+the|permitted|"
        "endorse|liable|free[^a-z0-9]+software|unencumbered|mpl")
BLANKS = r"[ \t\x0B\f\r]+"
WHITE = r"[ \t\n\x0B\f\r]+"
# Steps from lower-cased text to words and marks, each a pattern and what replaces it: "." stands where no known
# sentence goes on (a blank line, after . ! ?), "|" where one may start, end or go on (a line's end, after ; :).
STEPS = ((BLANKS + "\n", "\n"), (r"[.!?]" + WHITE, "\n\n"), (r"[;:]" + BLANKS, "\n"), (r"[^a-z0-9\n]+", " "),
         (r" ?\n ?\n[ \n]*", " . "), (r" ?\n ?", " | "))
# Then one mark between two words, at the second one's front.
MARKS = ((r"(?:[|.] )*[.] (?:[|.] )*", ". "), (r"(?:[|] )+", "| "))


def known() -> dict[str, str]:
    """Identifier of every known sentence."""
    return {t: name for table in (SENTENCES, FULL) for name, texts in table.items() for t in texts}


def marked(text: Column) -> Column:
    """Words in order, as an array; a mark before a word is its first character,
    and the last element is a mark alone."""
    words = F.lower(text)
    for pattern, by in STEPS:
        words = F.regexp_replace(words, pattern, by)
    words = F.concat(F.lit(". "), F.trim(words), F.lit(" . "))
    for pattern, by in MARKS:
        words = F.regexp_replace(words, pattern, by)
    return F.split(F.rtrim(F.regexp_replace(words, r"([|.]) ", "$1")), " ")


def identifiers(words: Column) -> Column:
    """Identifiers of the known sentences of marked words, in order."""
    names = known()
    lengths: dict[str, set[int]] = {}
    for t in names:
        lengths.setdefault(" ".join(t.split(" ")[:LEAD]), set()).add(t.count(" ") + 1)
    begins = F.create_map(*[x for lead, n in lengths.items()
                            for x in (F.lit(lead), F.array(*map(F.lit, sorted(n, reverse=True))))])
    table = F.create_map(*[x for t, name in names.items() for x in (F.xxhash64(F.lit(t)), F.lit(name))])

    def text(i, n):  # null where a sentence can't go on
        joined = F.array_join(F.slice(words, i + 1, n), " ")
        return F.when(F.instr(F.substring(joined, 2, 1 << 30), ".") == 0, F.translate(joined, "|.", ""))

    def longest(i):
        sizes = F.coalesce(F.try_element_at(begins, text(i, F.lit(LEAD))), F.array().cast("array<int>"))
        found = F.transform(sizes, lambda n: F.struct(i.alias("i"), n.alias("n"), F.when(
            F.get(words, i + n).rlike("^[|.]"), F.try_element_at(table, F.xxhash64(text(i, n)))).alias("id")))
        return F.get(F.filter(found, lambda x: x["id"].isNotNull()), F.lit(0))

    places = F.filter(F.sequence(F.lit(0), F.size(words) - 1), lambda i: F.get(words, i).rlike("^[|.][a-z0-9]"))
    hits = F.filter(F.transform(places, longest), lambda x: x.isNotNull())
    none = F.struct(F.lit(0).alias("end"), F.array().cast("array<string>").alias("ids"))
    return F.aggregate(hits, none, lambda left, x: F.when(
        x["i"] >= left["end"], F.struct((x["i"] + x["n"]).alias("end"), F.concat(left["ids"], F.array(x["id"])).alias("ids"))
    ).otherwise(left))["ids"]


def _pattern(ids: tuple[str, ...]) -> str:
    """Identifiers between spaces, with up to GAP others from one to the next."""
    return " " + f" (?: [^ ]+ ){{0,{GAP}}} ".join(ids) + " "


def licences(found: Column) -> tuple[Column, Column]:
    """(licences, rules matched) of an identifier array: every rule in turn is
    matched against what the rules before it left."""
    # " A  B ": each identifier between spaces of its own, so matches never overlap
    left = F.concat(F.lit(" "), F.array_join(found, "  "), F.lit(" "))
    names = []
    for i, (name, ids) in enumerate(RULES):
        pattern = _pattern(ids)
        names.append(F.when(left.rlike(pattern), F.struct(F.lit(i).alias("rule"), F.lit(name).alias("name"))))
        left = F.regexp_replace(left, pattern, "")
    hits = F.filter(F.array(*names), lambda x: x.isNotNull())
    return F.array_distinct(F.transform(hits, lambda x: x["name"])), F.transform(hits, lambda x: x["rule"])


def scan(docs: DataFrame) -> DataFrame:
    """(doc_id, sentence_ids, licences, rules) of every whole text."""
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select("doc_id", F.when(text.rlike(HINT), marked(text)).alias("words"))
    rows = rows.select("doc_id", F.coalesce(identifiers(F.col("words")), F.array().cast("array<string>")).alias("ids"))
    names, rules = licences(F.col("ids"))
    none = F.array()
    some = F.size("ids") > 0
    return rows.select("doc_id", F.col("ids").alias("sentence_ids"),
                       F.when(some, names).otherwise(none.cast("array<string>")).alias("licences"),
                       F.when(some, rules).otherwise(none.cast("array<int>")).alias("rules"))


def oracle() -> str:
    """DuckDB SQL of the scan: the look-up is a join by a sentence's first words
    and its whole text, and a step spends each sentence and matches each rule."""
    table = ", ".join(f"('{' '.join(t.split(' ')[:LEAD])}', {t.count(' ') + 1}, '{t}', '{name}')" for t, name in known().items())
    words = "lower(text)"
    for pattern, by in STEPS:
        words = f"regexp_replace({words}, '{pattern}', '{by}', 'g')"
    words = f"'. ' || trim({words}) || ' . '"
    for pattern, by in MARKS:
        words = f"regexp_replace({words}, '{pattern}', '{by}', 'g')"
    steps, left = [], "l"
    for i, (_, ids) in enumerate(RULES):
        p = _pattern(ids)
        steps.append(f"t{i + 1} AS (SELECT *, regexp_matches({left}, '{p}') AS h{i}, "
                     f"regexp_replace({left}, '{p}', '', 'g') AS l{i + 1} FROM t{i})")
        left = f"l{i + 1}"
    hits = ", ".join(f"CASE WHEN h{i} THEN '{name}' END" for i, (name, _) in enumerate(RULES))
    return rf"""
WITH RECURSIVE d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents),
w AS (
  SELECT r, string_split(rtrim(regexp_replace({words}, '([|.]) ', '\1', 'g')), ' ') AS w
  FROM d WHERE regexp_matches(text, '{HINT}')),
b AS (
  SELECT r, w, i, array_to_string(w[i:i + {LEAD - 1}], ' ') AS lead
  FROM (SELECT r, w, unnest(range(1, len(w) + 1)) AS i FROM w) WHERE regexp_matches(w[i], '^[|.][a-z0-9]')),
m AS (
  SELECT r, i, max(n) AS n, arg_max(id, n) AS id
  FROM b JOIN (VALUES {table}) AS k(begins, n, t, id)
    ON begins = translate(lead, '|.', '') AND NOT contains(substr(lead, 2), '.')
  WHERE array_to_string(w[i:i + n - 1], ' ')[2:] NOT LIKE '%.%' AND translate(array_to_string(w[i:i + n - 1], ' '), '|.', '') = t
    AND regexp_matches(w[i + n], '^[|.]')
  GROUP BY r, i),
j AS (SELECT *, row_number() OVER (PARTITION BY r ORDER BY i) AS j FROM m),
g AS (
  SELECT r, j, i + n AS e, [id] AS ids FROM j WHERE j = 1
  UNION ALL
  SELECT g.r, j.j, CASE WHEN j.i >= g.e THEN j.i + j.n ELSE g.e END, CASE WHEN j.i >= g.e THEN list_append(g.ids, j.id) ELSE g.ids END
  FROM g JOIN j ON j.r = g.r AND j.j = g.j + 1),
k AS (SELECT r, arg_max(ids, j) AS ids FROM g GROUP BY r),
t0 AS (
  SELECT doc_id, coalesce(ids, []) AS ids, ' ' || coalesce(array_to_string(ids, '  '), '') || ' ' AS l
  FROM d LEFT JOIN k USING (r)),
{", ".join(steps)},
n AS (SELECT *, list_filter([{hits}], lambda x: x IS NOT NULL) AS names FROM t{len(RULES)})
SELECT doc_id, len(ids) AS n_sentences, array_to_string(ids, ',') AS sentence_ids,
       array_to_string(list_filter(names, lambda x, i: list_position(names, x) = i), ',') AS licences
FROM n
"""
