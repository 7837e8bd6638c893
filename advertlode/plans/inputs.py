"""Advert pages, list pages, URLs, texts and state updates made from the given tables.

The tables hold no job adverts, so pages are rendered from their columns, row by row and without grouping: the work
grows with the tables, and the oracle can state the expected rows from the columns alone.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.html import ListSelectors
from ..functions.orgs import DEFAULT_ORGS

SITE = "https://jobs.example.com"
SEARCH_PAGE = SITE + "/stillinger/sok?side=1"
RUN_TS = "2024-02-01T00:00:00Z"
RUN_SPLIT = "2024-01-16"
_ISO = "yyyy-MM-dd'T'HH:mm:ss'Z'"

LIST_SELECTORS = ListSelectors(published_at="time.published", updated_at="time.updated", id_candidates=".result-item")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stream_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table as a stream of its files. The pattern lets a single file stand where a folder usually does."""
    return spark.readStream.schema(table(spark, sf_dir, name).schema).parquet(f"{sf_dir}/{name}.parque[t]")


def iso(ts: Column) -> Column:
    return F.date_format(ts, _ISO)


# Spellings of employers, by customer.
EMPLOYER = """
    CASE c_custkey % 8
        WHEN 0 THEN 'Forsvaret'
        WHEN 1 THEN 'PST'
        WHEN 2 THEN concat('Politiets sikkerhetstjeneste, ', c_mktsegment)
        WHEN 3 THEN 'Nasjonal sikkerhetsmyndighet'
        WHEN 4 THEN c_name
        WHEN 5 THEN concat('  Førsvar-etaten!! ', c_mktsegment)
        WHEN 6 THEN 'Politiets Sikkerhetstjenst'
    END"""

# The parts of an advert page, by order. Sets of rows by o_orderkey % 6: shared range, "etter avtale", range in the
# block, no salary, shared single amount, both. By o_orderkey div 6 % 4: number of code blocks.
ADVERT_COLUMNS = {
    "k": "o_orderkey",
    "source_url": f"concat('{SITE}/stilling/', o_orderkey)",
    "title": "concat('Rådgiver &amp; analytiker ', o_orderpriority)",
    "employer": EMPLOYER,
    "places": "CASE o_orderkey % 4 WHEN 0 THEN 'Oslo, Bergen' WHEN 1 THEN 'Oslo / Tromsø,Bodø' WHEN 2 THEN ' , / ' END",
    "kind": "CASE WHEN o_orderkey % 2 = 0 THEN 'Fast' ELSE 'Midlertidig' END",
    "share": "concat(o_orderkey % 100 + 1, '%')",
    "published": "o_orderdate",
    "updated": "CASE WHEN o_orderkey % 3 <> 0 THEN o_orderdate + make_dt_interval(int(o_orderkey % 30)) END",
    "deadline": "o_orderdate + INTERVAL '30' DAY",
    "base": "bigint(floor(o_totalprice))",
    "lo": "400000 + bigint(floor(o_totalprice)) % 300000",
    "pay": "int(o_orderkey % 6)",
    "n_blocks": "int(o_orderkey div 6 % 4)",
}


def _grouped(amount: Column, mark: str) -> Column:
    return F.replace(F.format_number(amount, 0), F.lit(","), F.lit(mark))


def _element(tag: str, css: str, text: Column) -> Column:
    """The element, or nothing when the text is NULL."""
    return F.coalesce(F.concat(F.lit(f'<{tag} class="{css}">'), text, F.lit(f"</{tag}>\n")), F.lit(""))


def advert_html() -> Column:
    lo, hi = F.col("lo"), F.col("lo") + 50_000
    span = F.concat(_grouped(lo, " "), F.lit(" – "), _grouped(hi, " "))
    salary = F.when(F.col("pay").isin(0, 5), F.concat(F.lit("Lønn: kr "), span, F.lit(" per år"))) \
        .when(F.col("pay") == 1, F.lit("Lønn etter avtale")) \
        .when(F.col("pay") == 4, F.concat(F.lit("Lønn: kr "), _grouped(lo, ".")))
    own = F.when(F.col("pay").isin(2, 5), F.concat(F.lit(": kr "), _grouped(lo - 1000, " "), F.lit(" - NOK "),
                                                   _grouped(hi + 1000, " "))).otherwise(F.lit(""))
    titles = F.array(*[F.lit(t) for t in ("Rådgiver", "Konsulent", "Overingeniør", "Forsker")])

    def block(i: Column) -> Column:
        code = F.lit(1000) + (F.col("base") + i * 17) % 9000
        other = F.lit(1000) + (F.col("base") + i * 17 + 4500) % 9000
        second = F.when((F.col("k") + i) % 2 == 0, F.concat(F.lit("<p>kode "), other, F.lit(": Spesialrådgiver")))
        return F.concat(
            F.lit('<div class="box job-codes"><p>Stillingskode '), code, F.lit(" – "),
            F.get(titles, ((F.col("k") + i) % 4).cast("int")), F.when(second.isNull(), own).otherwise(F.lit("")),
            F.coalesce(F.concat(second, own), F.lit("")), F.lit("</div>\n"))

    blocks = F.when(F.col("n_blocks") > 0, F.array_join(
        F.transform(F.sequence(F.lit(0), F.col("n_blocks") - 1), block), "")).otherwise(F.lit(""))
    closing = F.when(F.col("k") % 48 < 24, F.concat(F.lit("<p>Kode "), F.lit(1000) + F.col("base") % 9000,
                                                     F.lit(" – Arkivar"))).otherwise(F.lit("<p>Ingen kode"))
    return F.concat(
        F.lit("<!DOCTYPE html><html><head><title>kode 1111 - hode</title></head><body>\n"),
        _element("h1", "job-title", F.col("title")), _element("div", "employer-name", F.col("employer")),
        _element("div", "job-locations", F.col("places")), _element("span", "employment-type", F.col("kind")),
        _element("span", "employment-extent", F.col("share")), F.lit("<br><!-- tid -->"),
        _element("time", "published", iso(F.col("published"))), _element("time", "updated", iso(F.col("updated"))),
        _element("time", "deadline", iso(F.col("deadline"))), _element("div", "salary wide", salary),
        F.lit('<script>var t = "<p>kode 2222 - skript";</script>'), blocks, closing, F.lit("\n</body></html>"))


def _spread(rows: DataFrame) -> DataFrame:
    """The rows dealt over as many tasks as a shuffle has: rendering and reading a page costs far more than to move the few columns
    it is made from, and a table of one file or row group would be read, and its pages with it, by one task."""
    return rows.repartition(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def adverts(orders: DataFrame, customers: DataFrame) -> DataFrame:
    """One detail page per order: `listing_id, source_url, html`. `orders` may be a stream."""
    joined = orders.join(customers, F.col("o_custkey") == F.col("c_custkey"))
    parts = _spread(joined.select(*[F.expr(e).alias(name) for name, e in ADVERT_COLUMNS.items()]))
    return parts.select(F.concat(F.lit("A"), F.col("k")).alias("listing_id"), "source_url", advert_html().alias("html"))


def advert_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return adverts(table(spark, sf_dir, "orders"), table(spark, sf_dir, "customer"))


def served_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Detail pages under the URLs of some items of `list_pages`: `url, html`."""
    k = F.substring("listing_id", 2, 20).cast("bigint")
    url = F.when(k % 2 == 0, F.concat(F.lit(SITE + "/annonse/"), k * 3 + 1_000_002, F.lit("/vis"))).otherwise(
        F.concat(F.lit(SITE + "/stillinger/sok?visning="), k * 3 + 1, F.lit("#topp")))
    return advert_pages(spark, sf_dir).select(url.alias("url"), "html")


def list_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One list page per order with three items: `page_no, html`."""
    n = F.col("o_orderkey") * 3

    def item(i: Column) -> Column:
        number = n + i
        digest = F.md5(number.cast("string").cast("binary"))
        uuid = F.upper(F.concat_ws("-", *[F.substring(digest, a, b) for a, b in
                                          ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]))
        href = F.concat(F.element_at(F.array(
            F.concat(F.lit("/stilling/"), number % 1000, F.lit("/?utm_source=liste&amp;b=2&amp;a="), number),
            F.concat(F.lit(SITE + "/detail?jobId=J"), number),
            F.concat(F.lit("../annonse/"), number + 1_000_000, F.lit("/vis")),
            F.concat(F.lit("/d/"), uuid),
            F.concat(F.lit("?visning="), number, F.lit("#topp")),
            F.lit("")), (number % 6 + 1).cast("int")))
        data = F.when(number % 6 == 4, F.concat(F.lit(' data-id=" ID-'), number, F.lit(' "'))).otherwise(F.lit(""))
        seen = F.col("o_orderdate") + F.make_dt_interval(i)
        updated = F.when(number % 4 != 0, iso(seen + F.make_dt_interval((number % 5).cast("int"))))
        return F.concat(F.lit('<div class="result-item"'), data, F.lit('><a class="result-link" href="'), href,
                        F.lit('">Se stilling</a>'), _element("time", "published", iso(seen)),
                        _element("time", "updated", updated), F.lit("</div>"))

    items = F.array_join(F.transform(F.sequence(F.lit(0), F.lit(2)), item), "")
    html = F.concat(F.lit("<html><body>"), items, F.lit("</body></html>"))
    orders = _spread(table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate"))
    return orders.select(F.col("o_orderkey").alias("page_no"), F.lit(SEARCH_PAGE).alias("url"), html.alias("html"))


def url_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """`url` of all pages, and ten kinds of URL by order."""
    kinds = F.expr("""
        CASE o_orderkey % 10
            WHEN 0 THEN concat('HTTPS://Jobs.Example.com/stilling/', o_orderkey % 90000, '///?b=2&a=', o_orderkey, '#x')
            WHEN 1 THEN concat('https://jobs.example.com/detail?jobId=J', o_orderkey, '&id=&utm_term=q')
            WHEN 2 THEN concat('https://jobs.example.com/', o_orderkey + 1000000, '/vis;v=1?gclid=1')
            WHEN 3 THEN concat('https://jobs.example.com/liste?p=', o_orderkey + 1000000)
            WHEN 4 THEN concat('https://jobs.example.com/u/4F8C1B2A-3d4e-5f60-a1b2-', o_orderkey + 100000000000, '?id=7')
            WHEN 5 THEN concat('https://jobs.example.com/?q=r%C3%A5d+giver%zz&tom=&q=a*b~c&n=', o_orderkey)
            WHEN 6 THEN concat('https://jobs.example.com/s?id=a', o_orderkey, '&id=b', o_orderkey, '&uuid=z')
            WHEN 7 THEN concat('//jobs.example.com/x/', o_orderkey, '?fbclid=1&UTM_source=2')
            WHEN 8 THEN concat('https://jobs.example.com/a;b/c;d?&&=v&k', o_orderkey)
            ELSE concat(' https://jobs.example.com/', o_orderkey, '?listing_id=%20', o_orderkey, '%20')
        END""")
    return table(spark, sf_dir, "pages").select("url").unionByName(
        table(spark, sf_dir, "orders").select(kinds.alias("url")))


def salary_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """`text` with amounts from order lines in thirteen wordings."""
    amounts = table(spark, sf_dir, "lineitem").selectExpr(
        "l_orderkey % 13 AS kind", "300000 + bigint(floor(l_extendedprice * 7)) AS lo")
    a, b = _grouped(F.col("lo"), " "), _grouped(F.col("lo") + 75_000, " ")
    dotted, narrow = _grouped(F.col("lo"), "."), _grouped(F.col("lo"), "\u202F")
    plain = F.col("lo").cast("string")
    wordings = [
        F.concat(F.lit("Lønn: kr "), a, F.lit(" – "), b, F.lit(" per år")), F.concat(F.lit("Lønn: KR."), dotted),
        F.concat(F.lit("Lønn ETTER avtale, kr "), a), F.concat(F.lit("NOK "), a), F.lit("Lønn 12345"),
        F.concat(b, F.lit("-"), a), F.concat(F.lit("kr. "), a, F.lit("- "), b), F.concat(F.lit("500 - "), a),
        F.concat(F.lit("kr. "), a, F.lit(" til kr. "), b), F.concat(F.lit("kode 1111 – Konsulent "), a),
        F.concat(F.lit("tlf "), plain), F.concat(narrow, F.lit(" kroner")), F.lit("ingen lønn oppgitt")]
    return amounts.select("kind", "lo", F.element_at(F.array(*wordings), F.col("kind").cast("int") + 1).alias("text"))


def framework_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """`text` that names an agreement, or none, or an amount beside it, in seven wordings by order line."""
    return table(spark, sf_dir, "lineitem").select(F.expr("""
        CASE l_orderkey % 7
            WHEN 0 THEN concat('Lønn etter Havneoverenskomsten for losene (HO', l_linenumber, ') som los kode ', l_partkey % 9000)
            WHEN 1 THEN concat('Lønnes etter regulativet, trinn ', l_linenumber)
            WHEN 2 THEN concat('etter Hoved-tariffavtalen for skip nr ', l_suppkey)
            WHEN 3 THEN 'Lønn etter avtale'
            WHEN 4 THEN concat('etter overenskomst: kr ', 300000 + l_partkey)
            WHEN 5 THEN concat('ETTER Kaiverksoverenskomst (K', l_linenumber, ')')
            ELSE concat('Dagen etter kom ', l_linenumber) END""").alias("text"))


def code_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """`text` with codes from order lines in nine wordings."""
    codes = table(spark, sf_dir, "lineitem").selectExpr(
        "l_orderkey % 9 AS kind", "1000 + l_partkey % 9000 AS a", "1000 + l_suppkey % 9000 AS b", "l_linenumber AS n")
    text = F.expr("""
        CASE kind
            WHEN 0 THEN concat('Stillingskode ', a, ' – Førstekonsulent\nKode ', b, ' – Senioringeniør')
            WHEN 1 THEN concat('Kode ', a, ', kode ', b, ' – Rådgiver')
            WHEN 2 THEN concat('kode ', a, ' og STILLINGSKODE', b)
            WHEN 3 THEN concat('barkode ', a, ' i rom ', b)
            WHEN 4 THEN concat('Stillingskode 00', n, ': Vikar; kode 00', n, ' - Fast')
            WHEN 5 THEN concat('kode ', a, ' -   kode ', b, '–Forsker ')
            WHEN 6 THEN concat('kode ', a, '000 – for lang, nr ', b)
            WHEN 7 THEN concat('Rom ', a, ', tlf ', b, '55', n)
            ELSE concat('kode ', a, ' – Konsulent – Lønn: kr 500 000 – 600 000')
        END""")
    return codes.select("kind", "a", "b", "n", text.alias("text"))


def org_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """`tag, phrase, place`: the default organisations, prefixes as phrases, and one for every other customer of one kind."""
    fixed = [(org.tag, phrase, place) for place, org in enumerate(DEFAULT_ORGS) for phrase in org.fuzzy_phrases]
    own = table(spark, sf_dir, "customer").where("c_custkey % 16 = 4").selectExpr(
        "concat('kunde ', c_custkey) AS tag", "lower(replace(c_name, '#', ' ')) AS phrase", "int(10 + c_custkey) AS place")
    return spark.createDataFrame(fixed, "tag string, phrase string, place int").unionByName(own)


def json_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """`o_orderkey, text`: rows as JSON in eight forms, some broken."""
    return table(spark, sf_dir, "orders").select("o_orderkey", F.expr("""
        CASE o_orderkey % 8
            WHEN 0 THEN concat('{"job_code": ', o_orderkey, ', "salary_min": 600000.0, "is_shared_salary": true, "x": {"y": [1]}, "listing_id": "A', o_orderkey, '"}')
            WHEN 1 THEN concat('{"listing_id": ', o_orderkey, ', "salary_min": "700000", "salary_max": 7.5e5, "is_shared_salary": "false"}')
            WHEN 2 THEN concat('{"listing_id": "B', o_orderkey, '", "salary_min": 1.5, "salary_max": null}')
            WHEN 3 THEN concat('{"listing_id": "C', o_orderkey)
            WHEN 4 THEN concat('[', o_orderkey, ', 2]')
            WHEN 5 THEN concat('{"listing_id": ["D', o_orderkey, '"], "salary_min": "etter avtale", "job_title": {"a": 1}}')
            WHEN 7 THEN concat('  {"salary_min": 9007199254740993, "job_title": "R\\\\u00e5d \\\\"', o_orderkey, '\\\\"", "is_shared_salary": 7}')
        END""").alias("text"))


def employers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """`c_custkey, employer, title`."""
    return table(spark, sf_dir, "customer").selectExpr(
        "c_custkey", f"{EMPLOYER} AS employer",
        "CASE c_custkey % 3 WHEN 0 THEN 'Seniorrådgiver i Forsvarssektoren' WHEN 1 THEN 'Cyberforsvar-analytiker' END "
        "AS title")


def updates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """State updates from events: some with a blank or no `updated_at`, few with a fingerprint."""
    return updates_of(table(spark, sf_dir, "events"))


def updates_of(events: DataFrame) -> DataFrame:
    listing = F.concat(F.lit("L"), F.col("user_id") * 10 + F.get_json_object("props", "$.k").cast("int") % 10)
    return events.select(
        listing.alias("listing_id"), iso(F.col("ts")).alias("last_seen_at"),
        F.when(F.col("event_type") == "signup", "").when(F.col("event_type") != "view", iso(F.date_trunc("day", "ts")))
        .alias("updated_at"),
        F.when(F.col("event_type") == "purchase", F.sha1(F.col("event_id").cast("string").cast("binary")))
        .alias("detail_fingerprint"),
        F.col("event_id").alias("seq"), (F.col("ts") < F.lit(RUN_SPLIT).cast("timestamp_ntz")).alias("first_run"),
        F.concat(F.lit(SITE + "/stilling/"), listing, F.lit("?e="), F.col("event_id")).alias("source_url"))


def runs(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """The updates before and after the split."""
    both = updates(spark, sf_dir)
    return both.where("first_run"), both.where("NOT first_run")
