import hashlib

import pytest
from brute import page_text, rows_of, warc_records

from kandela.llm import warc

PAGE = ("<!DOCTYPE html><html><head><title>T &amp; U</title><style>p{}</style><script>var t=\"</p>\";</script></head><body>"
        "<!-- gone --><p>One<br>two &lt;b&gt;</p><div>a<b>b</b> c</div>\n</body></html>")


def pages(spark, rows):
    return spark.createDataFrame([r + ("x", "y") for r in rows], "page_id long, url string, html string, record string, raw string").repartition(3)


def test_plain_text():
    assert warc.plain_text(PAGE) == "T & U\nOne\ntwo <b>\nab c"
    assert warc.plain_text("") == "" and warc.plain_text("<script>x") == "" and warc.plain_text("a < b & c") == "a < b & c"
    assert warc.plain_text("&amp;amp;") == "&amp;"
    assert len(warc.plain_text("<p>word</p>" * 100_000)) == 5 * 100_000 - 1


@pytest.mark.parametrize("between", [
    '<svg-icon name="x"></svg-icon>', "<template-card></template-card>", "<style-guide/>", "<script-x>", '<svg class="i"/>', "<svg/>",
    '<svg title="a>b"/>', "<svg>", "<noscript>", "<template>", '<svg class="i>', "<!-->", "<!--->", "<!-- x --!>", "<!-- <svg> -->",
    "<svg><text>no</text></svg >", "<script>no</script x>", "<SVG>no</svg>", '<svg title="/>">no</svg>', "<style>no</styles></style>"])
def test_nothing_after_a_dropped_element_is_lost(between):
    assert warc.plain_text(f"<p>one</p>{between}<p>two</p>") == "one\ntwo"


def test_unended_scripts_styles_and_comments_run_to_the_end():
    for page in ("one<script>two", "one<style>two</style-guide>", "one<!-- two ->", "one<script", "one<svg a='b"):
        assert warc.plain_text(page) == "one"


def test_unended_elements_take_one_pass():
    n = 40_000
    for part in ("<svg>", "<template><noscript>", '<svg a=">" ', "<svg a='", "<svg/>", "<svg", "<!-->"):
        assert warc.plain_text("one " + part * n + "> <p>two</p>").startswith("one")


def test_records_round_trip_and_refer_to_their_response(spark):
    rows = [(1, "http://a.example/x", PAGE), (2, "http://a.example/\r\nX-Evil: 1", "é"), (3, None, None), (None, "http://b.example/", ""), (1, "http://a.example/x", PAGE)]
    found = warc.derived_records(pages(spark, rows)).collect()
    assert len(found) == 3 * len(rows)
    ids = {r["record_id"] for r in found if r["warc_type"] == "response"}
    assert len(ids) == 4  # the repeated page gives the same records
    for r in found:
        headers, block = warc.parse(bytes(r["record"]))
        fields = dict(headers)
        assert fields["WARC-Type"] == r["warc_type"] and fields["WARC-Record-ID"] == r["record_id"] and len(headers) == len(fields)
        assert fields["WARC-Block-Digest"] == r["block_digest"] == warc.digest(block) and len(block) == r["content_length"]
        assert fields.get("WARC-Refers-To") == r["refers_to"] and fields.get("WARC-Target-URI") == r["target_uri"]
        if r["warc_type"] == "response":
            assert r["refers_to"] is None and warc.digest(block.split(b"\r\n\r\n", 1)[1]) == r["payload_digest"]
        else:
            assert r["refers_to"] in ids
    by = {(r["page_id"], r["warc_type"]): warc.parse(bytes(r["record"]))[1] for r in found}
    assert by[1, "conversion"].decode() == warc.plain_text(PAGE) and by[3, "conversion"] == b""
    described = dict(x.split(": ", 1) for x in by[1, "metadata"].decode().strip().split("\r\n"))
    assert described["source-payload-digest"] == warc.digest(PAGE.encode()) and described["source-header-content-type"].startswith("text/html")
    assert described["conversion-record"] in {r["record_id"] for r in found if r["warc_type"] == "conversion"}


def test_dates_and_chosen_types(spark):
    frame = pages(spark, [(1, "u", "x")]).withColumnRenamed("record", "seen")
    (only,) = warc.derived_records(frame, date_column="seen", types=("metadata",)).collect()
    assert dict(warc.parse(bytes(only["record"]))[0])["WARC-Date"] == "x"


def test_query_digest_columns(spark):
    from kandela.llm.queries import QUERIES

    folder = "/root/testdata/sf0.001"
    rows = QUERIES["op9_warc"](spark, folder).collect()
    html = {r["page_id"]: (r["url"], r["html"]) for r in spark.read.parquet(f"{folder}/pages.parquet").collect()}
    assert len(rows) == 3 * len(html)
    for r in rows:
        made = {m[0]: m for m in warc.derive(html[r["page_id"]][0], html[r["page_id"]][1].encode())}[r["warc_type"]]
        assert r["record_sha256"] == hashlib.sha256(warc.render(made[3], made[4])).hexdigest()
        assert r["text"] == (made[4].decode() if r["warc_type"] == "conversion" else None)


def test_query_equals_records_written_out_field_by_field(spark):
    """Every page of the table against a record writer and an HTML reader that share no code with the operator."""
    from kandela.llm.queries import QUERIES

    folder = "/root/testdata/sf0.001"
    want = {(p["page_id"], kind): made for p in spark.read.parquet(f"{folder}/pages.parquet").collect()
            for kind, made in warc_records(p["url"], p["html"]).items()}
    got = QUERIES["op9_warc"](spark, folder).collect()
    assert {(r["page_id"], r["warc_type"]) for r in got} == set(want) and len(got) == len(want) > 100
    for r in got:
        own, refers, record = want[r["page_id"], r["warc_type"]]
        assert (r["record_id"], r["refers_to"]) == (own, refers)
        assert r["record_sha256"] == hashlib.sha256(record).hexdigest()
        assert r["text"] == (record.split(b"\r\n\r\n", 1)[1][:-4].decode() if r["warc_type"] == "conversion" else None)


@pytest.mark.parametrize("page", [
    PAGE, "<p>a &amp; b &eacute;&#33;</p><ul><li>x<li>y</ul>", "<p>one</p><svg><text>no</text></svg><p>two</p>", "<h1>T</h1>a<br/>b<i>c</i>",
    "<a href='/'>z</a>", "<noscript>no</noscript><template><p>no</p></template>yes", "", "plain"])
def test_text_equals_the_standard_reader(page):
    assert warc.plain_text(page) == page_text(page)


def test_empty_table(spark):
    assert rows_of(warc.derived_records(pages(spark, [])), "page_id") == []
