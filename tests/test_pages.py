"""Spans, metadata and links of rows that are null, empty or odd."""

from pyspark.sql import functions as F
from sentryloom.functions import hooks as H
from sentryloom.operators import content as C


def test_entity_spans_of_odd_texts(spark):
    df = spark.createDataFrame([(1, None), (2, ""), (3, "é 10.0.0.1 10.0.0.1"), (4, "no match")], "id int, text string")
    got = C.entity_spans(df, "text", ("ipv4",)).select("id", "value", "char_start", "char_end", "context").collect()
    assert sorted(map(tuple, got)) == [(3, "10.0.0.1", 2, 10, "é 10.0.0.1 10.0.0.1"), (3, "10.0.0.1", 11, 19, "é 10.0.0.1 10.0.0.1")]


def test_page_metadata_of_odd_pages(spark):
    df = spark.createDataFrame([(1, None), (2, ""), (3, "<h2>A <i>b</i></h2>"), (4, "<title> T </title><h1>x</h1><meta name=author content=me><meta name='keywords'>")], "id int, html string")
    got = {r["id"]: r for r in C.page_metadata(df).collect()}
    assert got[1]["title"] is None and got[2]["title"] is None and got[2]["headings"] == []
    assert got[3]["title"] == "A b" and got[3]["headings"] == [(2, "A b")]
    assert (got[4]["title"], got[4]["author"], got[4]["keywords"]) == ("T", "me", None)


def test_page_links_are_made_absolute(spark):
    page = "<a name=n>none</a><a href=''>empty</a><a href=b>one</a><a href='?q=1'>two</a><a href='//H.org/c'>three</a><a href='/d'> fo<b>ur</b></a>"
    df = spark.createDataFrame([(1, "http://h.org/a/x?y#z", page), (2, "http://h.org", "<a href=b>b</a>"), (3, None, "<a href=b>b</a>"), (4, "http://h.org", None)], "id int, url string, html string")
    got = C.page_links(df).select("id", "position", "link_url", "link_text", "is_external").orderBy("id", "position").collect()
    assert [tuple(r) for r in got] == [
        (1, 2, "http://h.org/a/b", "one", False), (1, 3, "http://h.org/a/x?q=1", "two", False), (1, 4, "http://H.org/c", "three", False), (1, 5, "http://h.org/d", "fo ur", False),
        (2, 0, "http://h.org/b", "b", False), (3, 0, None, "b", None),
    ]


def test_spans_are_the_rows_of_entities_on_any_text(spark):
    texts = ["é192.168.1.1", "x CVE-2024-1234é", "😀 10.0.0.1é a@b.example.com. ümail@x.org", "é.a@b.com %a@b.com", "D41D8CD98F00B204E9800998ECF8427E " * 3, None, "", "http://é.example.com/x?y cve-2024-00001", "a" * 5000 + " 1.2.3.4"]
    df = spark.createDataFrame(list(enumerate(texts)), "id int, text string")
    plain = sorted(map(tuple, C.extract_entities(df, "text").select("id", "kind", "value", "confidence").collect()))
    spans = C.entity_spans(df, "text", around=3).collect()
    assert sorted((r.id, r.kind, r.value, r.confidence) for r in spans) == plain and len(plain) > 12
    for r in spans:
        t = texts[r.id]
        assert t[r.char_start : r.char_end].lower() == r.value.lower() and r.context == t[max(0, r.char_start - 3) : r.char_end + 3]
    assert {(0, "192.168.1.1"), (1, "CVE-2024-1234")} <= {(i, v) for i, _, v, _ in plain}


def test_article_attempts_and_what_is_no_paragraph(spark):
    words = "word " * 60
    pages = [(1, "<pre>code one</pre><p>real text</p><param name=x>"), (2, f"<article><p>short</p></article><main><p>{words}</p><p>{words}</p><p>{words}</p></main>"), (3, f"<article><p>{words}</p><p>{words}</p><p>{words}</p></article><p>{words}</p>"), (4, "<script>var x</script><div>only  divs</div>"), (5, None), (6, "<p>open")]
    got = {r.id: r for r in C.article_text(spark.createDataFrame(pages, "id int, html string"), "id").collect()}
    assert (got[1].text, got[1].paragraphs, got[1].method) == ("real text", 1, "page")
    assert (got[2].method, got[3].method, got[3].confidence) == ("main", "article", 0.7)
    assert (got[4].text, got[4].method, got[4].confidence) == ("only divs", "all", 0.1)
    assert (got[5].text, got[5].confidence) == ("", 0.1) and got[6].text == "open"


def test_menus_are_no_sections_and_large_keys_stay(spark):
    big = (1 << 60) + 1
    page = "<nav><ul><li>Home</li></ul><h2>Menu</h2></nav><h1>Title</h1><p>Body</p><nav><p>x</p></nav><li>item"
    out = C.parse_pages(spark.createDataFrame([(big, page), (None, "<p>n</p>"), (big + 2, None)], "page_id long, html string").coalesce(1)).collect()
    assert [(r.page_id, r.position, r.kind, r.content) for r in out] == [(big, 0, "headline", "Title"), (big, 1, "paragraph", "Body"), (big, 2, "list", "item"), (None, 0, "paragraph", "n")]


def test_hooks_leave_columns_as_they_are(spark):
    big = (1 << 60) + 1
    df = spark.createDataFrame([(big, None), (None, big + 2), (big + 4, 1)], "id long, other long").coalesce(1)
    rows = {(big, None), (None, big + 2), (big + 4, 1)}
    out = H.map_messages(df, lambda m: str(m["id"] + 1), "string").collect()
    assert {(r.id, r.other) for r in out} == rows and {r.result for r in out} == {str(big + 1), str(big + 5), None} and sum(not r.ok for r in out) == 1
    assert {(r.id, r.other, r.n) for r in H.map_batches(df, lambda b: b["id"] + 1, "n", "long").collect()} == {(i, o, None if i is None else i + 1) for i, o in rows}
    got = H.fallback_calls(df, ("one", lambda b: "v" + b["other"].dropna().astype(str)), ("two", lambda b: b["id"].astype(str))).collect()
    assert {(r.id, r.other, r.answer, r.answered_by) for r in got} == {(big, None, str(big), "two"), (None, big + 2, f"v{big + 2}", "one"), (big + 4, 1, "v1", "one")}
    assert H.map_messages(df.withColumn("t", F.current_timestamp()), lambda m: str(m["t"].year)).filter("ok").count() == 3
    assert H.map_messages(df, lambda m: m["other"], "string").filter("ok AND result IS NULL").count() == 1
