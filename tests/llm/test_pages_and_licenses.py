"""HTML extraction and licence scan."""

import duckdb
import pytest

from ledgerlake.llm import html_extract as H
from ledgerlake.llm import license_scan as C
from ledgerlake.llm import queries as Qs
from ledgerlake.llm.license_texts import TEXTS

CASES = [
    (None, ""), ("", ""), ("plain < 3 &amp;", "plain < 3 &"), ("<p>a<!-- x", "a"), ("<p>a</p><a href=\"", "a"), ("<p>x &am", "x &am"),
    ("<nav>m</nav><article><h1>T &amp; t</h1><p>One\n two <b>bold<br><p>Next&nbsp;x</article><footer>f</footer>", "T & t\nOne two bold\nNext x"),
    ("<body><header>Site</header><main><header><h1>Head</h1></header><div>deep <i>er</i>ror<ul><li>1<li>2</ul></div></main><aside>s</aside>", "Head\ndeep error\n1\n2"),
    ("<article><p title='a>b'>ok</p><script>if(a<b){'</p>'}</script><style>p{}</style><form><p>f</p></form><div class='cookie-notice'>c</div><div id=\"comments\"><p>nice</p></div><p>end</article>", "ok\nend"),
    ("<article><table><tr><td>a<td>b<tr><td>c</table><blockquote>q</blockquote><p hidden>h</p></article>", "a b\nc\nq"),
    ("<div><div role='main'><p>m</p></div><div class=sidebar>no</div></div>", "m"), ("<p>no root</p>tail", "no root\ntail"),
]


@pytest.mark.parametrize("page, want", CASES)
def test_main_text(page, want):
    assert H.main_text(page) == want


@pytest.mark.parametrize("page, want", [
    ("<body><div class='layout with-sidebar'><article><p>a</p></article></div></body>", "a"), ("<div id='page' class='nav-open'><p>a</p></div>", "a"),
    ("<div class='sidebar'><article><p>only one</p></article></div><p>x", "only one"), ("<div class='nav'><p>a long text of the page</p></div><p>end", "a long text of the page\nend"),
    ("<article><section class='related-work'>r</section><p class='notice'>n</p><div class='form-of-government'>g</div><p>own text</p><div class='cookieNotice'>c</div><div class='post-comments x'>k</div></article>", "r\nn\ng\nown text"),
    ("<article><p>The story itself</p></article><div id='comments'><article><p>so</p></article></div>", "The story itself"),
])
def test_names_drop_no_main_text(page, want):
    assert H.main_text(page) == want


def test_site_templates_go_and_article_passages_stay(spark):
    shared = "<p>A passage that every article of this host holds.</p>"
    rows = [(i, f"https://Host.example/{i}", f"<div class=top>All about us</div><div>Story {i} begins.</div><div><p>Middle {i}.</p>{shared}</div><div>Call us now</div>") for i in range(12)]
    rows += [(100 + i, f"http://art.example/{i}", f"<div>Brand</div><article>{shared}<p>Own {i}</p><div>Rate this page</div></article>") for i in range(8)]
    rows += [(200, "http://single.example/", "<div>Only page</div>"), (201, None, "<div>All about us</div>"), (202, "no host", "<div>All about us</div>"), (203, "http://host.example/x", None), (200, "http://single.example/", "<div>Only page</div>")]
    df = spark.createDataFrame([(*r, "clash", 1) for r in rows], "page_id long, url string, html string, text string, host int").repartition(5)
    got = H.extract_main_text(df)
    assert got.columns == ["page_id", "url", "text", "n_chars"] and got.count() == len(rows)
    text = {r.page_id: r.text for r in got.collect()}
    assert text[3] == "Story 3 begins.\nMiddle 3."
    assert text[104] == "A passage that every article of this host holds.\nOwn 4"
    assert text[200] == "Only page" and text[201] == text[202] == "All about us" and text[203] == ""
    assert all(r.n_chars == len(r.text) for r in got.collect())
    assert H.extract_main_text(df.limit(0)).count() == 0


def test_licences_and_inheritance(spark):
    files = [("a/LICENSE", "Released under the MIT License"), ("a/b/x.py", "code code\nmore of it"), ("a/b/y.py", "# Licensed under the Apache License, Version 2.0.\n" + "code " * 30),
             ("c/z.py", "nothing"), ("a/b/c/COPYING", "This work is licensed under the GNU General Public License, version 3"), ("a/b/c/d/e.py", "deep"), ("top.py", "x"), (None, "Licensed under CC BY-NC 4.0."),
             ("a/b/x2.py", None), ("a/b/x3.py", ""), ("a/b/x.py", "code code\nmore of it"), ("c/w.py", "the work is under a version of the public " * 5)]
    df = spark.createDataFrame([(i, p, t, "k", 0.0) for i, (p, t) in enumerate(files)], "doc_id long, path string, text string, license string, score double").repartition(3)
    got = {r.doc_id: r for r in C.scan(df, C.template_table(spark)).collect()}
    assert len(got) == len(files)
    own = {i: r.license for i, r in got.items() if r.license}
    assert own == {0: "MIT", 2: "Apache-2.0", 4: "GPL-3.0", 7: "CC-BY-NC-4.0"}
    assert got[0].is_file and got[4].is_file and not got[2].is_file
    assert {i: (r.inherited_license, r.inherited_from) for i, r in got.items() if r.inherited_license} == {
        1: ("MIT", "a"), 8: ("MIT", "a"), 9: ("MIT", "a"), 10: ("MIT", "a"), 5: ("GPL-3.0", "a/b/c")}
    assert C.scan(df.limit(0), C.template_table(spark)).count() == 0
    assert {r.license for r in C.scan(df, C.template_table(spark).limit(0)).collect()} == {None}


def test_a_file_that_is_mostly_notice_governs(spark):
    df = spark.createDataFrame([(1, "d/NOTE", "Released under the MIT License\nquixotic zephyr wanders"), (2, "d/e.py", "code")], "doc_id long, path string, text string")
    got = {r.doc_id: r for r in C.scan(df, C.template_table(spark)).collect()}
    assert got[1].is_file and (got[2].inherited_license, got[2].inherited_from) == ("MIT", "d")


def test_wrapped_headers_and_full_licence_texts(spark):
    header = ("# This program is free software: you can redistribute it and/or modify\n# it under the terms of the GNU General Public License as published by\n"
              "# the Free Software Foundation, either version 3 of the License, or\n# (at your option) any later version.\n")
    full = dict(TEXTS)
    files = [("a/x.py", header + "import os\n" * 300), ("b/LICENSE", "Copyright (c) 2020 A. Person\n\n" + full["MIT"]), ("b/c/y.py", "code"), ("d/z.py", "# Released under the MIT License. " + "many more words follow on this line " * 20),
             ("e/COPYING", full["GPL-2.0"]), ("e/f.py", "code"), ("g/COPYING", full["LGPL-3.0"]), ("h/LICENSE", full["BSD-2-Clause"]), ("i/big.py", "/*\n" + full["MIT"] + "*/\n" + "some code here " * 900)]
    df = spark.createDataFrame([(i, p, t) for i, (p, t) in enumerate(files)], "doc_id long, path string, text string").repartition(3)
    got = {r.doc_id: r for r in C.scan(df, C.template_table(spark)).collect()}
    assert {i: r.license for i, r in got.items() if r.license} == {0: "GPL-3.0", 1: "MIT", 3: "MIT", 4: "GPL-2.0", 6: "LGPL-3.0", 7: "BSD-2-Clause", 8: "MIT"}
    assert {i for i, r in got.items() if r.is_file} == {1, 4, 6, 7}
    assert (got[2].inherited_license, got[2].inherited_from) == ("MIT", "b") and (got[5].inherited_license, got[5].inherited_from) == ("GPL-2.0", "e")


@pytest.mark.parametrize("name", sorted(Qs.oracle_sql()))
def test_queries_match_their_sql(spark, name):
    from tools.oracle_check import compare_one
    con = duckdb.connect()
    for t in ("documents", "embeddings", "pages", "benchmark", "labels"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('/root/testdata/sf0.001/{t}.parquet')")
    assert compare_one(spark, con, Qs.queries(), Qs.oracle_sql(), name, "/root/testdata/sf0.001")[0] == "OK"
