"""License scans by sentence rules; DataFrame functions only.

Sentences end at punctuation and line breaks, but a known sentence may run on
over single line breaks (with comment marks), colons and semicolons, as wrapped
licence texts do; titles stand on one line.  A text is normalised whole, and
known licence sentences become identifiers.  The sequence of a document's identifiers is then matched
against licence rules: a rule is an ordered list of identifiers, between which
other known sentences may stand.  All of it happens inside a row: no shuffle, no skew.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Sentences of public licence texts and notices, normalised (lower case, marks as one space).
SENTENCES = {
    "mit_ref": "released under the mit license",
    "mit_ref2": "licensed under the mit license",
    "mit_title": "the mit license mit",
    "mit_title2": "mit license",
    "mit_grant": "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so subject to the following conditions",
    "mit_notice": "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software",
    "as_is": "the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability fitness for a particular purpose and noninfringement",
    "mit_liability": "in no event shall the authors or copyright holders be liable for any claim damages or other liability whether in an action of contract tort or otherwise arising from out of or in connection with the software or the use or other dealings in the software",
    "apache_ref": "licensed under the apache license version 2 0",
    "apache_ref2": "licensed under the apache license version 2 0 the license",
    "apache_use": "you may not use this file except in compliance with the license",
    "apache_copy": "you may obtain a copy of the license at http www apache org licenses license 2 0",
    "apache_basis": "unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis without warranties or conditions of any kind either express or implied",
    "apache_see": "see the license for the specific language governing permissions and limitations under the license",
    "bsd_grant": "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met",
    "bsd_source": "redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer",
    "bsd_binary": "redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation and or other materials provided with the distribution",
    "bsd_endorse": "neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission",
    "gpl_ref3": "this work is licensed under the gnu general public license version 3 0",
    "gpl_ref2": "this work is licensed under the gnu general public license version 2 0",
    "gpl_free3": "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 3 of the license or at your option any later version",
    "gpl_free2": "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 2 of the license or at your option any later version",
    "gpl_hope": "this program is distributed in the hope that it will be useful but without any warranty without even the implied warranty of merchantability or fitness for a particular purpose",
    "cc_by": "licensed under cc by 4 0",
    "cc_by_sa": "licensed under cc by sa 4 0",
    "cc_by_nc": "licensed under cc by nc 4 0",
    "cc_by_nc_nd": "licensed under cc by nc nd 4 0",
    "cc0": "licensed under cc0 1 0",
    "isc_grant": "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies",
    "isc_grant2": "permission to use copy modify and distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies",
    "isc_ref": "licensed under the isc license",
    "isc_ref2": "released under the isc license",
    "mpl_ref": "this work is licensed under the mozilla public license version 2 0",
    "mpl_form": "this source code form is subject to the terms of the mozilla public license version 2 0",
    "mpl_form2": "this source code form is subject to the terms of the mozilla public license v 2 0",
    "lgpl_free21": "this library is free software you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation either version 2 1 of the license or at your option any later version",
    "lgpl_free3": "this library is free software you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation either version 3 of the license or at your option any later version",
    "agpl_free3": "this program is free software you can redistribute it and or modify it under the terms of the gnu affero general public license as published by the free software foundation either version 3 of the license or at your option any later version",
}
# Identifier and wording of the GNU licences, version, licence; a reference may leave out a last "0" and may go on with "or later".
GNU = [
    ("gpl_ref3", "general", "3", "GPL-3.0"),
    ("gpl_ref2", "general", "2", "GPL-2.0"),
    ("lgpl_ref3", "lesser general", "3", "LGPL-3.0"),
    ("lgpl_ref21", "lesser general", "2 1", "LGPL-2.1"),
    ("agpl_ref3", "affero general", "3", "AGPL-3.0"),
]
LATER = {"": "", "_later": " or later", "_any": " or any later version", "_option": " or at your option any later version"}
REFERENCES = {}  # identifier: licence
for _name, _words, _version, _licence in GNU:
    for _zero in ("", " 0") if " " not in _version else ("",):
        for _tail, _later in LATER.items():
            # gpl_ref3 and gpl_ref2 are the forms with "0"
            _id = _name + ("" if _zero or " " in _version else "_short") + _tail
            SENTENCES[_id] = f"this work is licensed under the gnu {_words} public license version {_version}{_zero}{_later}"
            REFERENCES[_id] = _licence
# Rule name, licence, ordered sentence identifiers.
RULES = [
    ("mit-text", "MIT", ["mit_grant", "mit_notice", "as_is"]),
    ("mit-reference", "MIT", ["mit_ref"]),
    ("mit-reference-2", "MIT", ["mit_ref2"]),
    ("mit-title", "MIT", ["mit_title"]),
    ("mit-title-2", "MIT", ["mit_title2"]),
    ("apache-notice", "Apache-2.0", ["apache_ref2", "apache_use", "apache_basis", "apache_see"]),
    ("apache-reference", "Apache-2.0", ["apache_ref"]),
    ("bsd-3-text", "BSD-3-Clause", ["bsd_grant", "bsd_source", "bsd_binary", "bsd_endorse"]),
    ("bsd-2-text", "BSD-2-Clause", ["bsd_grant", "bsd_source", "bsd_binary"]),
    ("gpl-3-notice", "GPL-3.0", ["gpl_free3", "gpl_hope"]),
    ("gpl-2-notice", "GPL-2.0", ["gpl_free2", "gpl_hope"]),
    ("gpl-3-reference", "GPL-3.0", ["gpl_ref3"]),
    ("gpl-2-reference", "GPL-2.0", ["gpl_ref2"]),
    ("cc-by-reference", "CC-BY-4.0", ["cc_by"]),
    ("cc-by-sa-reference", "CC-BY-SA-4.0", ["cc_by_sa"]),
    ("cc-by-nc-reference", "CC-BY-NC-4.0", ["cc_by_nc"]),
    ("cc-by-nc-nd-reference", "CC-BY-NC-ND-4.0", ["cc_by_nc_nd"]),
    ("cc0-reference", "CC0-1.0", ["cc0"]),
    ("isc-text", "ISC", ["isc_grant"]),
    ("isc-text-2", "ISC", ["isc_grant2"]),
    ("isc-reference", "ISC", ["isc_ref"]),
    ("isc-reference-2", "ISC", ["isc_ref2"]),
    ("mpl-reference", "MPL-2.0", ["mpl_ref"]),
    ("mpl-form", "MPL-2.0", ["mpl_form"]),
    ("mpl-form-2", "MPL-2.0", ["mpl_form2"]),
    ("lgpl-2.1-notice", "LGPL-2.1", ["lgpl_free21"]),
    ("lgpl-3-notice", "LGPL-3.0", ["lgpl_free3"]),
    ("agpl-3-notice", "AGPL-3.0", ["agpl_free3"]),
    *((name.replace("_", "-"), licence, [name]) for name, licence in REFERENCES.items() if name not in ("gpl_ref3", "gpl_ref2")),
]
TITLES = {"mit_title", "mit_title2"}  # words as short as these could meet over a line break by chance
# steps that turn lower-case text into words with one mark between them: a space,
# SOFT where a sentence may end or run on, HARD where it ends
SOFT, HARD = "\n", "\x01"
STEPS = [
    (r"\r\n?|[\x00-\x02]", "\n"),
    (r"\bv\.\s++(?=[0-9])", "v "),  # "v. 2.0" is no end
    (r"(?<![.!?:;])[:;]++(?:\s++|$)", "\x02"),
    (r"(?<![.!?:;])[.!?:;]++(?:\s++|$)", HARD),
    (r"\n[^a-z0-9\n]*+\n[^a-z0-9]*+(?!http)", HARD),  # a blank line, but for one before an address
    (r"[^a-z0-9\n\x01\x02]++", " "),
    (r"(?: ?+[\n\x02])++ ?+", SOFT),
    (r"[ \n]?(?:\x01[ \n]?+)++", HARD),
]
# every known sentence holds one of these, so a text with none has no known sentence
HINT = r"(?i)licen[sc]e|copyright|redistribut|warrant"
assert all(re.search(HINT, s) for s in SENTENCES.values())  # noqa: S101


def marked(text: Column) -> Column:
    """A-Z lower-cased words of a text with one mark between them and HARD at both ends."""
    out = F.lower(text)
    for pattern, mark in STEPS[:-1]:
        out = F.regexp_replace(out, pattern, mark)
    return F.regexp_replace(F.concat(F.lit(HARD), out, F.lit(HARD)), *STEPS[-1])


def sentence_ids(text: Column, sentences: dict[str, str] = SENTENCES) -> Column:
    """Identifiers of the known sentences of a text, in order; of several that begin at one place the longest. Null text has none."""
    known = F.create_map(*(F.lit(x) for name, s in sentences.items() for x in (s, name)))
    longest = sorted(sentences, key=lambda name: -len(sentences[name]))
    forms = "|".join(sentences[name].replace(" ", " " if name in TITLES else f"[ {SOFT}]") for name in longest)
    found = F.regexp_extract_all(marked(text), F.lit(f"(?<=[{SOFT}{HARD}])(?:{forms})(?=[{SOFT}{HARD}])"), F.lit(0))
    none = F.array().cast("array<string>")
    return F.when(text.rlike(HINT), F.transform(found, lambda s: F.try_element_at(known, F.translate(s, SOFT, " ")))).otherwise(none)


def _in_order(ids: Column, parts: list[str]) -> Column:
    """Whether ``parts`` stand in ``ids`` in their order: one pass that counts how many of them are met."""
    if len(parts) == 1:
        return F.array_contains(ids, parts[0])
    wanted = F.array(*map(F.lit, parts))
    # an index behind the last part gives null, which equals nothing
    met = F.aggregate(ids, F.lit(0), lambda n, x: n + F.coalesce(F.get(wanted, n) == x, F.lit(False)).cast("int"))
    return met == len(parts)


def matched_rules(ids: Column, rules: list[tuple[str, str, list[str]]] = RULES) -> Column:
    """Structs (rule, licence) of the rules whose identifiers stand in ``ids`` in their order."""
    hits = [F.when(_in_order(ids, parts), F.struct(F.lit(name).alias("rule"), F.lit(licence).alias("licence"))) for name, licence, parts in rules]
    return F.array_compact(F.array(*hits))


def scan(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: ``id, sentences`` (identifiers in order), ``rules`` and ``licences`` (each once, sorted).

    Null and empty texts have none.  Repeated rows and null ids are rows of
    their own; extra columns are ignored.
    """
    rows = df.select(F.col(id_col).alias("id"), sentence_ids(F.col(text_col).cast("string")).alias("sentences"))
    hits = rows.withColumn("hits", F.when(F.size("sentences") > 0, matched_rules(F.col("sentences"))))
    names = lambda c: F.coalesce(F.array_sort(F.array_distinct(F.col(f"hits.{c}"))), F.array().cast("array<string>"))
    return hits.select("id", "sentences", names("rule").alias("rules"), names("licence").alias("licences"))
