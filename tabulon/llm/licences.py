"""Licence scans by sentence rules, in DataFrame expressions only.

A text is cut into normalised sentences: lower case, every run of other characters than letters and digits a single space.
It is cut in two ways, since licence notices are both single lines among others and paragraphs wrapped over lines: at
sentence ends and line ends, and at sentence ends and empty lines alone. Each sentence that is in the table becomes its identifier; the
others are left out, but a third BSD clause in unknown words keeps its place, so that what stands around it is not taken for
the licence without that clause; the holder named in it does not matter. A licence is recognised where the identifiers of one of its rules follow each other in that order.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Sentences of public licence texts and notices.
SENTENCES = {
    "mit.notice": "Released under the MIT License",
    "mit.notice2": "Licensed under the MIT License",
    "mit.notice3": "This project is licensed under the terms of the MIT license",
    "mit.grant": 'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions',
    "mit.keep": "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software",
    "mit.asis": 'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT',
    "mit.liability": "IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE",
    "isc.grant": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies",
    "isc.asis": 'THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS',
    "bsd.grant": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
    "bsd.source": "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer",
    "bsd.binary": "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution",
    "bsd.names": "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission",
    "bsd.asis": 'THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED',
    "bsd.notice": "Licensed under the BSD License",
    "apache.notice": "Licensed under the Apache License, Version 2.0",
    "apache.grant": 'Licensed under the Apache License, Version 2.0 (the "License")',
    "apache.use": "you may not use this file except in compliance with the License",
    "apache.copy": "You may obtain a copy of the License at",
    "apache.asis": 'Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied',
    "apache.limits": "See the License for the specific language governing permissions and limitations under the License",
    "gpl3.notice": "This work is licensed under the GNU General Public License, version 3",
    "gpl2.notice": "This work is licensed under the GNU General Public License, version 2",
    "gpl.free": "This program is free software",
    "gpl2.later": "you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version",
    "gpl3.later": "you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version",
    "gpl.hope": "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY",
    "gpl.even": "without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE",
    "gpl.see": "See the GNU General Public License for more details",
    "lgpl.notice": "This library is licensed under the GNU Lesser General Public License, version 3",
    "agpl.notice": "This work is licensed under the GNU Affero General Public License, version 3",
    "gnu3.either": "either version 3 of the License, or (at your option) any later version",
    "lgpl.free": "This library is free software",
    "lgpl.hope": "This library is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY",
    "lgpl2.terms": "you can redistribute it and/or modify it under the terms of the GNU Library General Public License as published by the Free Software Foundation",
    "lgpl2.see": "See the GNU Library General Public License for more details",
    "lgpl.terms": "you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation",
    "lgpl21.either": "either version 2.1 of the License, or (at your option) any later version",
    "lgpl21.later": "you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation, either version 2.1 of the License, or (at your option) any later version",
    "lgpl3.later": "you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version",
    "lgpl.see": "See the GNU Lesser General Public License for more details",
    "agpl.terms": "you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation",
    "agpl3.later": "you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version",
    "agpl.see": "See the GNU Affero General Public License for more details",
    "mpl.grant": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0",
    "mpl.copy": "If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/",
    "ccbync.notice": "Licensed under CC BY-NC 4.0",
    "ccby.notice": "Licensed under CC BY 4.0",
    "ccbysa.notice": "Licensed under CC BY-SA 4.0",
    "ccby.work": "This work is licensed under a Creative Commons Attribution 4.0 International License",
    "ccbysa.work": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License",
    "ccbync.work": "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License",
    "cc0.notice": "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work",
    "unlicense.free": "This is free and unencumbered software released into the public domain",
    "rights.reserved": "All rights reserved",
}
# The order in which a licence's sentences stand.
RULES = [
    ("MIT", ["mit.notice"]), ("MIT", ["mit.notice2"]), ("MIT", ["mit.notice3"]),
    ("MIT", ["mit.grant", "mit.keep", "mit.asis", "mit.liability"]),
    ("ISC", ["isc.grant", "isc.asis"]),
    ("BSD", ["bsd.notice"]),
    ("BSD-2-Clause", ["bsd.grant", "bsd.source", "bsd.binary", "bsd.asis"]),
    ("BSD-3-Clause", ["bsd.grant", "bsd.source", "bsd.binary", "bsd.names", "bsd.asis"]),
    ("Apache-2.0", ["apache.notice"]),
    ("Apache-2.0", ["apache.grant", "apache.use", "apache.copy", "apache.asis", "apache.limits"]),
    ("GPL-3.0", ["gpl3.notice"]), ("GPL-2.0", ["gpl2.notice"]),
    ("GPL-2.0-or-later", ["gpl.free", "gpl2.later", "gpl.hope", "gpl.even", "gpl.see"]),
    ("GPL-3.0-or-later", ["gpl.free", "gpl3.later", "gpl.hope", "gpl.even", "gpl.see"]),
    ("GPL-3.0-or-later", ["gpl.free", "gpl2.later.1", "gnu3.either", "gpl.hope", "gpl.even", "gpl.see"]),
    ("AGPL-3.0-or-later", ["gpl.free", "agpl3.later", "gpl.hope", "gpl.even", "agpl.see"]),
    ("AGPL-3.0-or-later", ["gpl.free", "agpl.terms", "gnu3.either", "gpl.hope", "gpl.even", "agpl.see"]),
    *[(licence, [f"{k}.free", *terms, f"{k}.hope", "gpl.even", see]) for k in ("gpl", "lgpl") for licence, terms, see in [
        ("LGPL-2.0-or-later", ["lgpl2.terms", "gpl2.later.2"], "lgpl2.see"),
        ("LGPL-2.1-or-later", ["lgpl.terms", "lgpl21.either"], "lgpl.see"), ("LGPL-2.1-or-later", ["lgpl21.later"], "lgpl.see"),
        ("LGPL-3.0-or-later", ["lgpl.terms", "gnu3.either"], "lgpl.see"), ("LGPL-3.0-or-later", ["lgpl3.later"], "lgpl.see")]],
    ("LGPL-3.0", ["lgpl.notice"]), ("AGPL-3.0", ["agpl.notice"]),
    ("MPL-2.0", ["mpl.grant", "mpl.copy"]),
    ("CC-BY-NC-4.0", ["ccbync.notice"]), ("CC-BY-NC-4.0", ["ccbync.work"]),
    ("CC-BY-4.0", ["ccby.notice"]), ("CC-BY-4.0", ["ccby.work"]),
    ("CC-BY-SA-4.0", ["ccbysa.notice"]), ("CC-BY-SA-4.0", ["ccbysa.work"]),
    ("CC0-1.0", ["cc0.notice"]), ("Unlicense", ["unlicense.free"]),
]

_BLANK = r"[ \t\n\x0B\f\r]"
_END = rf"[.!?;:]+({_BLANK}|$)"
#: The head of the third BSD clause with the name of a holder in it; with the general words it stays as it is.
_GAP = r"[^\p{L}\p{N}]+"
_HOLDER = _GAP.join(["neither", "the", "names?", "of", f"(?!the{_GAP}copyright{_GAP}holder{_GAP}nor{_GAP}the{_GAP}names{_GAP}of{_GAP}its{_GAP}contributors)"
                     f"[\\s\\S]{{1,300}}?{_GAP}nor", "the", "names?", "of", "(?:[a-z]+" + _GAP + "){0,3}contributors"])
_NAMES = "neither the name of the copyright holder nor the names of its contributors"
#: Stands in a sequence for a third clause in other words: no rule goes over it.
_FOREIGN = "<bsd.other>"
_OTHER = r"[^\p{L}\p{N}\n\x01]+"


def normalised(sentence: str) -> list[str]:
    """Sentences of the table go through the cuts of the texts; one that holds a sentence end is several."""
    marked = re.sub(_END, "\x01\\1", sentence.lower())
    spaced = re.sub(r"[^a-z0-9\x01]+", " ", marked)
    return [x.strip() for x in spaced.split("\x01") if x.strip()]


def _table() -> dict[str, str]:
    """Normalised sentence -> identifier. Of an entry with sentence ends inside, the parts are numbered."""
    out = {}
    for name, sentence in SENTENCES.items():
        parts = normalised(sentence)
        for i, part in enumerate(parts):
            out[part] = name if len(parts) == 1 else f"{name}.{i + 1}"
    return out


def _rule(ids: list[str]) -> str:
    """The rule as it stands in a sequence of identifiers."""
    parts = [[f"{i}.{k + 1}" for k in range(n)] if (n := len(normalised(SENTENCES.get(i, i)))) > 1 and i in SENTENCES else [i] for i in ids]
    return "".join(f"<{x}>" for p in parts for x in p)


TABLE = _table()
RULE_STRINGS = [(licence, _rule(ids)) for licence, ids in RULES]


def _sequence(sentences: Column) -> Column:
    """'<id><id>...' of the known sentences in order, with _FOREIGN for the parts of unknown third clauses."""
    ids = F.create_map(*[F.lit(x) for pair in TABLE.items() for x in pair])
    foreign = lambda s: s.startswith("neither the name") | s.contains("to endorse or promote products")
    known = F.filter(sentences, lambda s: s.isin(*TABLE) | foreign(s))
    return F.array_join(F.transform(known, lambda s: F.when(s.isin(*TABLE), F.concat(F.lit("<"), ids[s], F.lit(">"))).otherwise(_FOREIGN)), "")


def scan(docs: DataFrame) -> DataFrame:
    """doc_id, sentence_ids, licences for every row of `docs`.

    sentence_ids has the identifiers of the known sentences in their order, as cut at sentence and line ends; licences the
    recognised licences of either cut, without repeats, in alphabetical order. Both are empty strings where there are none
    and for null and empty texts. Repeated rows give repeated rows; other columns are not looked at.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    named = F.regexp_replace(F.lower(text), _HOLDER, _NAMES)
    marked = F.regexp_replace(named, _END, "\x01$1")
    rows = docs.select("doc_id", F.regexp_replace(marked, _OTHER, " ").alias("_t"))
    lines = F.split("_t", r" ?[\n\x01][ \n\x01]*")
    paragraphs = F.regexp_replace("_t", r"\n ?\n[ \n]*", "\x01")
    whole = F.split(F.regexp_replace(paragraphs, r"[ \n]+", " "), r" ?\x01[ \x01]*")
    rows = rows.select("doc_id", _sequence(F.transform(lines, lambda x: F.trim(x))).alias("_lines"), _sequence(F.transform(whole, lambda x: F.trim(x))).alias("_whole"))
    rules = F.array(*[F.struct(F.lit(a).alias("licence"), F.lit(b).alias("rule")) for a, b in RULE_STRINGS])
    found = F.filter(rules, lambda r: F.contains("_lines", r["rule"]) | F.contains("_whole", r["rule"]))
    names = F.array_sort(F.array_distinct(F.transform(found, lambda r: r["licence"])))
    either = (F.length("_lines") > 0) | (F.length("_whole") > 0)
    return rows.select("doc_id", F.replace("_lines", F.lit(_FOREIGN), F.lit("")).alias("sentence_ids"), F.when(either, F.array_join(names, ",")).otherwise("").alias("licences"))


def _q(x: str) -> str:
    return "'" + x.replace("'", "''") + "'"


_MAP = "MAP {" + ", ".join(f"{_q(k)}: {_q('<' + v + '>')}" for k, v in TABLE.items()) + "}"
_KNOWN = "(" + ", ".join(map(_q, TABLE)) + ")"


def _sql_sequence(split: str) -> str:
    return f"array_to_string(list_transform(list_filter(list_transform({split}, lambda x: trim(x, ' ')), lambda x: x IN {_KNOWN}), lambda x: ids[x]), '')"


ORACLE_SQL = f"""
WITH t AS (
  SELECT doc_id, {_MAP} AS ids, regexp_replace(regexp_replace(lower(coalesce(text, '')), '[.!?;:]+([ \\t\\n\\x0B\\f\\r]|$)', chr(1) || '\\1', 'g'),
    '[^\\p{{L}}\\p{{N}}\\n\\x01]+', ' ', 'g') AS t FROM documents),
s AS (
  SELECT doc_id, {_sql_sequence("string_split_regex(t, ' ?[\\n\\x01][ \\n\\x01]*')")} AS seq,
    {_sql_sequence("string_split_regex(regexp_replace(regexp_replace(t, '\\n ?\\n[ \\n]*', chr(1), 'g'), '[ \\n]+', ' ', 'g'), ' ?\\x01[ \\x01]*')")} AS whole FROM t),
r AS (SELECT unnest([{', '.join(_q(a) for a, _ in RULE_STRINGS)}]) AS licence, unnest([{', '.join(_q(b) for _, b in RULE_STRINGS)}]) AS rule),
m AS (SELECT DISTINCT doc_id, seq, whole, licence FROM s JOIN r ON contains(s.seq, r.rule) OR contains(s.whole, r.rule)),
g AS (SELECT doc_id, string_agg(licence, ',' ORDER BY licence) AS licences FROM m GROUP BY doc_id)
SELECT s.doc_id, s.seq AS sentence_ids, coalesce(g.licences, '') AS licences FROM s LEFT JOIN g ON g.doc_id = s.doc_id
"""
