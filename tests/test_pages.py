import time
from html.parser import HTMLParser

import pytest
from pyspark.sql import functions as F

from advertlode.functions.html import (DEFAULT_DETAIL, DetailSelectors, ListSelectors, _read_detail, _rules, _Scanner,
                                        detail_page, list_items)
from advertlode.operators.details import code_rows, detail_fields, exploded_rows, listing_records, split_values
from advertlode.operators.discovery import list_summaries, page_items
from advertlode.plans import inputs
from advertlode.schemas import EXPLODED, LISTING

from .conftest import SF

ADVERT = """
<!DOCTYPE html><html><body><main>
  <time class="deadline">2031-03-09T12:00:00Z</time>
  <div class="job-codes box">Kode 0412 : Havnefogd <span>kode 0977 - Losaspirant</span></div>
  <p class="salary">Avlønning fra kr 412 300 - 498 750 brutto</p>
  <section class="employer-name">Kystetaten &Oslash;st</section>
  <h1 class="job-title">Havnefogd ved Skagerrak</h1>
  <span class="employment-extent">halv stilling</span> <span class="employment-type">Vikariat</span>
  <ul class="job-locations"><li>Risør/Arendal</ul>
  <time class="updated">2031-02-11T08:30:00Z</time><time class="published">2031-02-10T08:00:00Z</time>
</main></body></html>"""


def details(spark, *pages):
    rows = [(str(i), f"https://example.com/{i}", p) for i, p in enumerate(pages)]
    return detail_fields(spark.createDataFrame(rows, "listing_id string, source_url string, html string"))


def coded(spark, page):
    rows = exploded_rows(code_rows(details(spark, page)), scraped_at="2024-01-01T00:00:00Z")
    return [(r.job_code, r.job_title, r.salary_min, r.salary_max, r.salary_text, r.is_shared_salary)
            for r in rows.collect()]


def test_all_fields(spark):
    row = listing_records(details(spark, ADVERT), scraped_at="now").first().asDict()
    assert row == {"listing_id": "0", "source_url": "https://example.com/0", "title": "Havnefogd ved Skagerrak",
                   "job_title": None, "employer_raw": "Kystetaten Øst", "employer_normalized": "kystetaten ost",
                   "locations": ["Risør", "Arendal"], "employment_type": "Vikariat", "extent": "halv stilling",
                   "salary_text": "Avlønning fra kr 412 300 - 498 750 brutto", "published_at": "2031-02-10T08:00:00Z",
                   "updated_at": "2031-02-11T08:30:00Z", "apply_deadline": "2031-03-09T12:00:00Z", "scraped_at": "now"}
    assert list(row) == LISTING.names


def test_shared_salary(spark):
    text = "Avlønning fra kr 412 300 - 498 750 brutto"
    assert coded(spark, ADVERT) == [("0412", "Havnefogd", 412300, 498750, text, True),
                                    ("0977", "Losaspirant", 412300, 498750, text, True)]


def test_shared_text_without_amount_still_counts_as_shared(spark):
    page = '<b class="salary">Avlønning etter avtale</b><div class="job-codes">kode 3071 : Tolk</div>'
    assert coded(spark, page) == [("3071", "Tolk", None, None, "Avlønning etter avtale", True)]


def test_single_amount(spark):
    page = '<div class="job-codes">stillingskode 2255: Fyrvokter</div><i class="salary">NOK 387.900</i>'
    assert coded(spark, page) == [("2255", "Fyrvokter", 387900, 387900, "NOK 387.900", True)]


def test_salary_in_the_block(spark):
    block = "Kode 6120: Skipsfører, kr 701 000 - 733 500"
    page = f'<body><section class="job-codes">{block}</section></body>'
    assert coded(spark, page) == [("6120", "Skipsfører, kr 701 000 - 733 500", 701000, 733500, block, False)]


def test_salary_per_code(spark):
    page = """<div class="salary">kr 650.000</div><div class="job-codes">
        kode 1111 – A, kr 500 000 – 600 000 kode 2222 – B, kr 700 000 kode 3333 - C</div>"""
    rows = exploded_rows(code_rows(details(spark, page), per_code=True)).collect()
    assert [(r.job_code, r.salary_min, r.salary_max, r.is_shared_salary) for r in rows] == [
        ("1111", 500000, 600000, False), ("2222", 700000, 700000, False), ("3333", 650000, 650000, True)]


def test_blocks_and_fallback(spark):
    two = '<div class="job-codes">kode 1111 - A</div><div class="job-codes">x</div><div class="job-codes">kode 1111</div>'
    assert [r[:2] for r in coded(spark, two)] == [("1111", "A"), ("1111", None)]
    page = "<head><title>kode 9999 - t</title></head><script>kode 8888 - s</script><p>Kode 1234<b> – </b>Arkivar<!-- x --> nå"
    assert coded(spark, page) == [("1234", "Arkivar nå", None, None, "Kode 1234 – Arkivar nå", False)]
    assert coded(spark, "<p>ingen kode her 1234") == []
    # A block element that is there but blank keeps the page from being read as a whole.
    assert coded(spark, '<div class="job-codes"></div><p>kode 1234 - A') == []


def test_rows_of_missing_pages(spark):
    assert coded(spark, None) == [] and coded(spark, "") == []
    assert details(spark, None).first().title is None


def test_values(column):
    cases = {"Oslo, Bergen/Tromsø": ["Oslo", "Bergen", "Tromsø"], " , / ": None, "": None, None: None, "A": ["A"]}
    assert column(split_values, list(cases)) == list(cases.values())


def read(column, html, **selectors):
    return column(lambda t: detail_page(t, DetailSelectors(**selectors)), [html])[0]


def test_markup(column):
    cases = [
        ("<p><b>x<br><p>y</p>", {"title": "p"}, "x"),                      # the next p ends the first
        ("<ul><li>a<ul><li>b</ul><li>c</ul>", {"title": "li"}, "a b"),      # an inner list stays inside
        ("<div class='a b'>x<span>y</div>z", {"title": "div.b.a"}, "x y"),
        ("<DIV CLASS=a>x &amp; y &lt;</DIV>", {"title": ".a"}, "x & y <"),
        ("<p>1 < 2 <i>&nbsp;</i></p>", {"title": "p"}, "1 < 2"),
        ('<p title="a>b">x</p>', {"title": "p"}, "x"),
        ("<p class=a></p><p class=a>x</p>", {"title": "p.a"}, None),        # only the first element counts
        ("<p><!-- <p> -->x<script>'</p>'</script>y<style>p{}</style></p>", {"title": "p"}, "x y"),
        ("<td>a<td>b", {"title": "td"}, "a"),
        ("<p>x</q></p>", {"title": "p"}, "x"),
        ("<h2>x</h2><p>open <", {"title": "p"}, "open <"),
        ("<b><div class=a>x</b> y</div>z", {"title": ".a"}, "x y"),          # an inline end tag closes no block
        ("<p><table><tr><td class=a>x</p>y</td></table>", {"title": ".a"}, "x y"),  # nor does one reach out of a cell
        ("<div class=a><i>x</div>y</i>", {"title": "i"}, "x"),
        ("<div class=a>x<textarea><p>y</p></textarea></div>", {"title": ".a"}, "x <p>y</p>"),
        ("<textarea><h1>no</h1></textarea><h1>x</h1>", {"title": "h1"}, "x"),
    ]
    for html, selectors, text in cases:
        assert read(column, html, **selectors).title == text, html


def test_unsupported_selectors():
    with pytest.raises(ValueError):
        detail_page(None, DetailSelectors(title="div > p"))


class Plain(HTMLParser):
    """Text of h1 and of all links, by the standard library's parser."""

    def __init__(self):
        super().__init__()
        self.inside, self.h1, self.links = None, [], []

    def handle_starttag(self, tag, attrs):
        if tag == "h1":
            self.inside = tag
        if tag == "a":
            self.links.append(dict(attrs).get("href"))

    def handle_endtag(self, tag):
        if tag == "h1":
            self.inside = None

    def handle_data(self, data):
        if self.inside:
            self.h1.append(data)


def test_whole_pages_against_the_standard_library(spark):
    pages = spark.read.parquet(f"{SF}/pages.parquet").select("html").withColumns({
        "d": detail_page(F.col("html"), DetailSelectors(title="h1")),
        "l": list_items(F.col("html"), ListSelectors(item="html", link="a")),
        "i": list_items(F.col("html"), ListSelectors(item="li", link="a"))})
    for row in pages.collect():
        plain = Plain()
        plain.feed(row.html)
        assert row.d.title == (" ".join("".join(plain.h1).split("\n")).strip() or None)
        assert [i.href for i in row.i] == plain.links and row.l[0].href == plain.links[0]


LIST = """<li class="result-item" data-ref="R-7"><time class="updated">2031-02-02T00:00:00Z</time>
<a class="result-link" href="/utlysning/kai">Kai</a><time class="published">2031-02-01T00:00:00Z</time></li>
<li class="result-item"><a class="plain" href="/om">om</a><a class="result-link" href="/utlysning/molo#s">Molo</a></li>
<li class="result-item" data-ref=""><a class="result-link" href="">tom</a></li>
<div class="result-item"><a class="result-link" href=" ">blank</a><div class="result-item">
<a class="result-link" href="/utlysning/brygge">indre</a></div></div>"""


def summaries(spark, selectors):
    pages = spark.createDataFrame([(2, LIST), (1, ""), (3, None)], "page_no int, html string")
    rows = list_summaries(page_items(pages, base_url="https://test.local/search?x=1", selectors=selectors))
    return rows.orderBy("seq").collect()


def test_list_page(spark):
    rows = summaries(spark, ListSelectors(published_at="time.published", updated_at="time.updated",
                                          id_candidates=".result-item"))
    assert [(r.source_url, r.published_at, r.updated_at) for r in rows] == [
        ("https://test.local/utlysning/kai", "2031-02-01T00:00:00Z", "2031-02-02T00:00:00Z"),
        ("https://test.local/utlysning/molo#s", None, None), ("https://test.local/search?x=1", None, None),
        ("https://test.local/utlysning/brygge", None, None)]
    assert (rows[0].listing_id, rows[0].provenance) == ("R-7", "candidate")
    assert [r.provenance for r in rows[1:]] == ["sha1_url"] * 3
    assert [tuple(r.seq) for r in rows] == [(2, 0), (2, 1), (2, 2), (2, 3)]


def test_own_extractor(spark):
    def by_regex(html):
        return F.transform(F.regexp_extract_all(html, F.lit('href="([^"]+)"'), F.lit(1)), lambda h: F.struct(
            h.alias("href"), F.lit("d").alias("published_at"), F.lit(None).cast("string").alias("updated_at"),
            F.array(F.concat(F.lit("id"), h)).alias("id_candidates")))

    pages = spark.createDataFrame([(1, LIST)], "page_no int, html string")
    rows = list_summaries(page_items(pages, base_url="https://h", extractor=by_regex)).orderBy("seq").collect()
    assert len(rows) == 5 and rows[0].listing_id == "id/utlysning/kai" and rows[0].source_url == "https://h/utlysning/kai"


def test_default_list_selectors_read_no_dates(spark):
    assert {(r.published_at, r.updated_at, r.provenance) for r in summaries(spark, ListSelectors())} == {
        (None, None, "sha1_url")}


def test_page_is_read_once(spark):
    """A filter on a field must not make Spark parse the page a second time."""
    rows = code_rows(detail_fields(inputs.advert_pages(spark, SF))).where("employer_normalized = 'pst'")
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert plan.count("read_pages(") == 1


def test_filters_reach_the_page_scan(spark, tmp_path):
    pages = inputs.advert_pages(spark, SF).selectExpr("*", "int(substring(listing_id, 2) % 3) AS day")
    pages.write.partitionBy("day").parquet(str(tmp_path / "pages"))
    stored = spark.read.parquet(str(tmp_path / "pages"))
    plan = detail_fields(stored).where("day = 1 AND listing_id = 'A7' AND title IS NOT NULL")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(day" in plan and "EqualTo(listing_id,A7)" in plan and plan.count("read_pages(") == 1


@pytest.mark.parametrize("page", ["<b>" * 150_000 + "</i>" * 150_000, "<b>" * 100_000 + "<h1>" * 100_000,
                                  "<i><div>" * 50_000 + "</i>" * 50_000, "<p><b>" * 100_000, "<!-- " * 200_000,
                                  "<a href='" * 100_000, "<textarea>" * 100_000])
def test_odd_markup_takes_linear_time(page):
    start = time.perf_counter()
    _read_detail(page, _Scanner(_rules(DEFAULT_DETAIL)))
    assert time.perf_counter() - start < 6  # a megabyte; quadratic reading takes minutes


def test_exploded_schema(spark):
    rows = exploded_rows(code_rows(detail_fields(inputs.advert_pages(spark, SF))))
    assert [(f.name, f.dataType) for f in rows.schema] == [(f.name, f.dataType) for f in EXPLODED]


def test_items_as_a_table_function(spark, tmp_path):
    from advertlode.functions.html import register_page_items

    rows = [(1, "a", "<li><a href=/x>1</a><time>t1</time></li><li>no link</li><li data-id=7><a href='/y&amp;z'>2</a></li>", "p"), (2, "a", None, "p"),
            (3, "b", "<li><a href=/q>3</a></li>", "p"), (4, "a", "", "p")]
    spark.createDataFrame(rows, "page_no int, site string, html string, unused string").write.parquet(str(tmp_path / "p"))
    spark.read.parquet(str(tmp_path / "p")).createOrReplaceTempView("some_pages")
    register_page_items(spark)
    found = spark.sql("""SELECT * FROM page_items(TABLE(SELECT site, html, page_no FROM some_pages WHERE site = 'a'), item => 'li', link => 'a',
                         published_at => 'time', id_candidates => 'li')""")
    assert found.columns == ["site", "page_no", "item_no", "href", "published_at", "updated_at", "id_candidates"]
    assert sorted(tuple(r) for r in found.collect()) == [("a", 1, 0, "/x", "t1", None, []), ("a", 1, 1, "/y&z", None, None, ["7"])]
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(site,a)" in plan and "unused" not in plan  # pushed to the scan
    with pytest.raises(Exception, match="column html"):
        spark.sql("SELECT * FROM page_items(TABLE(SELECT site FROM some_pages), item => 'li', link => 'a')").collect()
