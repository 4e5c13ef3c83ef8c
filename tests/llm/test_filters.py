"""Quality classifier, URL filter and licence scan."""

from __future__ import annotations

import random

import pytest

from tests.llm.helpers import DOCS, frame, messy
from tools.compare import canon, duck
from wardline.llm import licenses, quality, url_rules
from wardline.llm.queries import ORACLE_SQL, QUERIES

SF, SF_2 = "/root/testdata/sf0.001", "/root/testdata/sf0.01"


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_matches_sql(spark, name):
    res = duck(SF).execute(ORACLE_SQL[name])
    df = QUERIES[name](spark, SF)
    assert canon(df.columns, [tuple(r) for r in df.collect()]) == canon([d[0] for d in res.description], res.fetchall())


# ---------------------------------------------------------------- quality


def test_quality_held_out_accuracy(spark):
    import zlib

    got = {r.doc_id: r for r in QUERIES["op1_quality_classifier"](spark, SF_2).collect()}
    assert len(got) == spark.read.parquet(f"{SF_2}/documents.parquet").count()
    labels = [r for r in spark.read.parquet(f"{SF_2}/labels.parquet").collect() if r.quality is not None]
    held = [r for r in labels if zlib.crc32(str(r.doc_id).encode()) % 3 == 1]
    assert all(got[r.doc_id].held_out for r in held) and sum(x.held_out for x in got.values()) >= len(held)
    right = sum(got[r.doc_id].predicted == r.quality for r in held) / len(held)
    clean = [r for r in held if r.quality == 1]
    assert right >= 0.95
    assert sum(got[r.doc_id].predicted for r in clean) / len(clean) >= 0.97  # clean documents stay


def test_quality_never_learns_held_out_labels(spark):
    """Turning the held-out labels round changes no score."""
    from pyspark.sql import functions as F

    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    turned = labels.withColumn("quality", F.when(quality.held_out(F.col("doc_id")), 1 - F.col("quality")).otherwise(F.col("quality")))
    a, b = ({r.doc_id: r.score for r in quality.classify(docs, x).collect()} for x in (labels, turned))
    assert a == b


def test_quality_edges(spark):
    df = frame(spark, messy())
    labels = spark.createDataFrame(
        [(1, 1), (1, 0), (2, 1), (4, 1), (8, 0), (12, 0), (None, 1), (9, None), (10, 7), (777, 1)], "doc_id long, quality int")
    out = quality.classify(df, labels)
    rows = out.collect()
    assert len(rows) == len(messy()) and all(0.0 <= r.score <= 1.0 for r in rows)
    assert out.columns == [c for c in df.columns if c != "score"] + ["score"]  # an old score is replaced
    none = quality.classify(df, labels.limit(0)).select("score").distinct().collect()
    assert [r.score for r in none] == [0.5]  # nothing learnt
    assert quality.classify(spark.createDataFrame([], DOCS), labels).collect() == []


def test_term_counts_of_long_texts_add_up(monkeypatch):
    import numpy as np

    text = " ".join(f"Word{i}!" for i in range(4000)).encode()
    whole = quality.term_counts(text)
    monkeypatch.setattr(quality, "CHUNK", 1000)
    assert np.allclose(whole, quality.term_counts(text))


# ---------------------------------------------------------------- urls


def url_answer(url, rules, default="allow"):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    cut = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
    host, tail = "".join(c.lower() if c.isascii() else c for c in rest[:cut]), rest[cut:]
    path = tail[: min([tail.find(c) for c in "?#" if c in tail], default=len(tail))]
    fits = [(len(h + p), len(h), h + p, v) for h, p, v in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fits, default=None)
    return host, path, best[2] if best else None, best[3] if best else default


def test_urls_random(spark):
    rnd = random.Random(5)
    hosts = ["com", "a.com", "b.a.com", "xa.com", "net", "c.net", "", "com.a", "A.CoM", "ü.com"]
    paths = ["", "/", "/x", "/x/", "/x/y", "/xy", "/x/y/z?q=/x", "#/x", "?/x/", "/é"]
    rules = [(h, p, rnd.choice(["allow", "block"])) for h in ("com", "a.com", "b.a.com", "net") for p in ("", "/", "/x", "/x/", "/x/y") if rnd.random() < 0.7]
    urls = [f"{rnd.choice(['http', 'https', 'x'])}://{rnd.choice(hosts)}{rnd.choice(paths)}" for _ in range(400)]
    urls += [None, "", "no scheme.com/x", "http://", "://a.com/x", "http://u://a.com/x", "http://a.com:80/x", "http://a.com/" + "x" * 100_000]
    urls += ["http://a.com/x/y"] * 50  # a url that many pages have
    rows = [(i if i % 50 else None, u) for i, u in enumerate(urls)]
    from pyspark.sql import functions as F

    pages = spark.createDataFrame(rows, "page_id long, url string").withColumns({c: F.lit("z") for c in ("host", "path", "rule", "id", "row", "key")})
    given = spark.createDataFrame([*rules, (None, "/", "block"), ("com", None, "block")], "host string, path string, verdict string")
    got = sorted((tuple(r) for r in url_rules.apply_rules(pages.repartition(6), given).collect()), key=str)
    assert got == sorted(((i, *url_answer(u, rules)) for i, u in rows), key=str)


def test_urls_rules_that_reach_over_partitions(spark):
    """One rule covers all urls of many partitions; a nested one starts in the middle."""
    was = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    spark.conf.set("spark.sql.shuffle.partitions", "12")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        rules = [("com", "/", "block"), ("com", "/05", "allow"), ("com", "/0512", "block")]
        rows = [(i, f"http://s.com/{i:04d}") for i in range(1000)]
        pages = spark.createDataFrame(rows, "page_id long, url string")
        given = spark.createDataFrame(rules, "host string, path string, verdict string")
        got = sorted(tuple(r) for r in url_rules.apply_rules(pages, given).collect())
    finally:
        for k, v in was.items():
            spark.conf.set(k, v)
    assert got == sorted((i, *url_answer(u, rules)) for i, u in rows)


def test_urls_of_a_megabyte(spark):
    """Every partition may begin with a url that is far longer than any rule."""
    rules = [("com", "/", "block"), ("com", "/x", "allow"), ("com", "/x" + "y" * 2000, "block")]
    rows = [(i, f"http://s.com/{'x' if i % 2 else ''}{'y' * 1_000_000}{i}") for i in range(12)]
    pages = spark.createDataFrame(rows, "page_id long, url string").repartition(4)
    given = spark.createDataFrame(rules, "host string, path string, verdict string")
    got = sorted((r.id, r.host, r.path, r.rule, r.verdict) for r in url_rules.apply_rules(pages, given).collect())
    assert got == sorted((i, *url_answer(u, rules)) for i, u in rows)


def test_urls_empty(spark):
    pages = spark.createDataFrame([(1, "http://a.com/x")], "page_id long, url string")
    rules = spark.createDataFrame([("com", "/", "block")], "host string, path string, verdict string")
    assert [tuple(r) for r in url_rules.apply_rules(pages, rules.limit(0)).collect()] == [(1, "a.com", "/x", None, "allow")]
    assert url_rules.apply_rules(pages.limit(0), rules).collect() == []


# ---------------------------------------------------------------- licences


def test_licences(spark):
    mit = "\n".join(licenses.SENTENCES[n].capitalize() + "." for n in ("mit_grant", "mit_notice", "as_is"))
    bsd = [licenses.SENTENCES[n] for n in ("bsd_grant", "bsd_source", "bsd_binary", "bsd_endorse")]
    rows = [
        (1, "Some prose. Released under the MIT License. More prose.", None),
        (2, "Copyright 2020 someone\n\n" + mit.replace("software", "Software"), None),
        (3, "\n".join([bsd[0], "1. " + bsd[1], bsd[2], "and more", bsd[3] + "."]), None),
        (4, "; ".join([bsd[1], bsd[0], bsd[2]]), None),  # the right sentences in the wrong order
        (5, "Licensed under the Apache License, Version 2.0.\nThis work is licensed under the GNU General Public License, version 3.0.", None),
        (6, "unlicensed under the mit license", None),
        (7, "x " * 50_000 + ". Licensed under CC BY-NC 4.0. Licensed under CC BY-NC 4.0.", None),
        (8, None, None), (9, "", None), (None, "Released under the MIT License.", None), (1, "Some prose. Released under the MIT License. More prose.", None),
    ]
    got = [(r.id, list(r.sentences), list(r.rules), list(r.licences)) for r in licenses.scan(frame(spark, rows)).collect()]
    found = {i: (s, r, x) for i, s, r, x in got}
    assert len(got) == len(rows)
    assert found[1] == (["mit_ref"], ["mit-reference"], ["MIT"]) == found[None]
    assert found[2] == (["mit_grant", "mit_notice", "as_is"], ["mit-text"], ["MIT"])
    assert found[3][2] == ["BSD-3-Clause"] or found[3][2] == ["BSD-2-Clause", "BSD-3-Clause"]
    assert found[4][1] == []
    assert found[5] == (["apache_ref", "gpl_ref3"], ["apache-reference", "gpl-3-reference"], ["Apache-2.0", "GPL-3.0"])
    assert found[7] == (["cc_by_nc", "cc_by_nc"], ["cc-by-nc-reference"], ["CC-BY-NC-4.0"])
    assert found[6] == found[8] == found[9] == ([], [], [])
    assert licenses.scan(spark.createDataFrame([], DOCS)).collect() == []


def test_licences_of_notices_repeated_thousands_of_times(spark):
    """Third-party notices: the sentences of a rule again and again, its last one nowhere or at the end."""
    names = ["bsd_grant", "bsd_source", "bsd_binary"]
    once = "\n".join(licenses.SENTENCES[n] + "." for n in names) + "\n"
    last = licenses.SENTENCES["bsd_endorse"] + "."
    got = {r.id: r for r in licenses.scan(frame(spark, [(1, once * 10_000, None), (2, once * 10_000 + last, None)])).collect()}
    assert list(got[1].sentences) == names * 10_000 and list(got[1].licences) == ["BSD-2-Clause"]
    assert "BSD-3-Clause" in got[2].licences
    backwards = "\n".join(licenses.SENTENCES[n] + "." for n in names[::-1]) + "\n"
    assert list(licenses.scan(frame(spark, [(1, backwards, None)])).first().rules) == []


LINES = {  # the tables' own licence lines
    "Released under the MIT License.": "MIT",
    "Licensed under the Apache License, Version 2.0.": "Apache-2.0",
    "Licensed under CC BY-NC 4.0.": "CC-BY-NC-4.0",
    "This work is licensed under the GNU General Public License, version 3.": "GPL-3.0",
}


def test_licences_of_the_tables_lines(spark):
    """Every document's licences by its lines, stated without the scan's sentences."""
    from pyspark.sql import functions as F

    texts = spark.read.parquet(f"{SF_2}/documents.parquet").select("doc_id", "text").collect()
    want = {r.doc_id: ",".join(sorted({LINES[x.strip()] for x in (r.text or "").splitlines() if x.strip() in LINES})) for r in texts}
    assert set(want.values()) >= set(LINES.values())
    got = QUERIES["op8_license_scan"](spark, SF_2).where(F.col("licences") != "").collect()
    assert {r.doc_id: r.licences for r in got} == {i: x for i, x in want.items() if x}


def test_licences_gnu_forms(spark):
    forms = {
        "This work is licensed under the GNU General Public License, version 3.": "GPL-3.0",
        "This work is licensed under the GNU General Public License, version 3.0.": "GPL-3.0",
        "This work is licensed under the GNU General Public License, version 2.": "GPL-2.0",
        "This work is licensed under the GNU General Public License, version 2 or later.": "GPL-2.0",
        "This work is licensed under the GNU General Public License, version 3.0, or (at your option) any later version.": "GPL-3.0",
        "This work is licensed under the GNU Lesser General Public License, version 2.1 or later.": "LGPL-2.1",
        "This work is licensed under the GNU Affero General Public License, version 3.": "AGPL-3.0",
        "This work is licensed under the Mozilla Public License, version 2.0.": "MPL-2.0",
        "Licensed under the ISC License.": "ISC",
    }
    got = licenses.scan(frame(spark, [(i, t, None) for i, t in enumerate(forms)])).collect()
    assert [list(r.licences) for r in sorted(got)] == [[x] for x in forms.values()]


# public texts as they are usually wrapped
WRAPPED = {
    "MIT": """MIT License

Copyright (c) 2020 someone

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
AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER
LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM,
OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE
SOFTWARE.
""",
    "Apache-2.0": """Copyright 2020 someone

Licensed under the Apache License, Version 2.0 (the "License");
you may not use this file except in compliance with the License.
You may obtain a copy of the License at

    http://www.apache.org/licenses/LICENSE-2.0

Unless required by applicable law or agreed to in writing, software
distributed under the License is distributed on an "AS IS" BASIS,
WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.
See the License for the specific language governing permissions and
limitations under the License.
""",
    "BSD-3-Clause": """Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this
   list of conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice,
   this list of conditions and the following disclaimer in the documentation
   and/or other materials provided with the distribution.

3. Neither the name of the copyright holder nor the names of its
   contributors may be used to endorse or promote products derived from
   this software without specific prior written permission.
""",
    "GPL-3.0": """This program is free software: you can redistribute it and/or modify
it under the terms of the GNU General Public License as published by
the Free Software Foundation, either version 3 of the License, or
(at your option) any later version.

This program is distributed in the hope that it will be useful,
but WITHOUT ANY WARRANTY; without even the implied warranty of
MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the
GNU General Public License for more details.
""",
    "GPL-2.0": """This program is free software; you can redistribute it and/or modify
it under the terms of the GNU General Public License as published by
the Free Software Foundation; either version 2 of the License, or
(at your option) any later version.

This program is distributed in the hope that it will be useful,
but WITHOUT ANY WARRANTY; without even the implied warranty of
MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.
""",
    "MPL-2.0": """This Source Code Form is subject to the terms of the Mozilla Public
License, v. 2.0. If a copy of the MPL was not distributed with this
file, You can obtain one at https://mozilla.org/MPL/2.0/.
""",
}
PARTS = {
    "MIT": ["mit_title2", "mit_grant", "mit_notice", "as_is", "mit_liability"],
    "Apache-2.0": ["apache_ref2", "apache_use", "apache_copy", "apache_basis", "apache_see"],
    "BSD-3-Clause": ["bsd_grant", "bsd_source", "bsd_binary", "bsd_endorse"],
    "GPL-3.0": ["gpl_free3", "gpl_hope"],
    "GPL-2.0": ["gpl_free2", "gpl_hope"],
    "MPL-2.0": ["mpl_form2"],
}


@pytest.mark.parametrize("mark", ["", "# ", " * ", "// ", ";; "])
def test_licences_wrapped(spark, mark):
    """Wrapped texts, bare and as comments, with either line end; the next licence right behind."""
    texts = {x: "".join(mark + line + "\n" for line in text.splitlines()) for x, text in WRAPPED.items()}
    rows = [(i, t, None) for i, t in enumerate(texts.values())]
    rows += [(100 + i, t.replace("\n", "\r\n"), None) for i, t, _ in rows]
    rows += [(200, "Vendor: MIT\nLicense: other\n", None), (201, "released under\n\nthe MIT License", None), (202, "x\n" * 50_000 + "!" * 50_000 + texts["MIT"], None)]
    got = {r.id: (list(r.sentences), list(r.licences)) for r in licenses.scan(frame(spark, rows)).collect()}
    for i, (licence, parts) in enumerate(PARTS.items()):
        want = ["BSD-2-Clause", licence] if licence == "BSD-3-Clause" else [licence]
        assert got[i] == got[100 + i] == (parts, want)
    assert got[200] == got[201] == ([], [])
    assert got[202] == (PARTS["MIT"], ["MIT"])
