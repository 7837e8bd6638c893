"""The registered queries: each takes (spark, sf_dir) and returns a DataFrame over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.codes import code_titles, job_codes
from ..functions.html import DetailSelectors, ListSelectors, register_page_items
from ..functions.orgs import DEFAULT_ORGS, contains_any, has_prefix, normalize_org, token_set_scores, tokens
from ..functions.salary import grouped_int, salary_framework, salary_range
from ..functions.text import fold_accents
from ..functions.urls import canonical_url, listing_key, resolve_link, site_id
from ..operators import quality
from ..operators.align import align_exploded, ingest, stamp_load
from ..operators.details import code_rows, detail_fields, distinct_rows, explode_listings, exploded_rows, listing_records
from ..operators.discovery import list_summaries, non_empty_pages, page_items, search_frontier
from ..operators.org_index import match_org_table, phrases_in
from ..operators.orgs import match_orgs
from ..operators.state import (candidate_sources, candidates, decide, fingerprint, incremental_efficiency,
                               latest_updates, lookup_fingerprints, seen, unseen, update_fingerprints, upsert, upsert_summaries)
from ..schemas import EXPLODED, STATE
from ..session import work_dir
from ..sources import sinks
from ..sources.pages import read_pages
from ..sources.state_table import commit_state, commit_updates, read_state
from ..streaming.state_stream import changes_writer, incremental_writer, state_changes, streaming_distinct, streaming_rows, streaming_state
from . import inputs
from .inputs import RUN_TS, table
from .run import RunConfig, run, stage

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(build: Query) -> Query:
    """Register under the function's name, less the underscore that keeps it apart from an operator's."""
    QUERIES[build.__name__.rstrip("_")] = build
    return build


# Adverts: pages to rows

def _details(spark: SparkSession, sf_dir: str) -> DataFrame:
    return detail_fields(inputs.advert_pages(spark, sf_dir))


@query
def advert_rows(spark, sf_dir):
    """Which job codes at what salary does each advert offer?"""
    return exploded_rows(code_rows(_details(spark, sf_dir)), scraped_at=RUN_TS)


@query
def advert_rows_per_code(spark, sf_dir):
    """The same, with the salary of each code's own part of the text."""
    return exploded_rows(code_rows(_details(spark, sf_dir), per_code=True), scraped_at=RUN_TS)


@query
def advert_rows_extended(spark, sf_dir):
    """The rows with the organisation that matched, why and how well."""
    matched = match_orgs(_details(spark, sf_dir), "employer_raw", "title", fuzzy_threshold=0.8, explain=True)
    return exploded_rows(code_rows(matched), scraped_at=RUN_TS, extended=True)


def _flat_listings(listings: DataFrame) -> DataFrame:
    return listings.withColumn("locations", F.array_join("locations", "|"))


@query
def advert_listings(spark, sf_dir):
    return _flat_listings(listing_records(_details(spark, sf_dir), scraped_at=RUN_TS))


@query
def advert_blocks(spark, sf_dir):
    return _details(spark, sf_dir).select("listing_id", F.posexplode("blocks").alias("block_no", "block"))


@query
def advert_locations(spark, sf_dir):
    return _details(spark, sf_dir).select("listing_id", F.posexplode("locations").alias("place_no", "place"))


@query
def page_fields(spark, sf_dir):
    selectors = DetailSelectors(title="title", job_title="h1", employer=".ad", extent="nav", salary_text="h2")
    fields = detail_fields(table(spark, sf_dir, "pages").select("page_id", "html"), selectors)
    return fields.select("page_id", "title", "job_title", "employer_raw", "salary_text")


@query
def page_links(spark, sf_dir):
    items = page_items(table(spark, sf_dir, "pages"), order="page_id", base_url=F.col("url"),
                       selectors=ListSelectors(item="li", link="a"))
    return list_summaries(items).select(F.col("seq.page_order").alias("page_id"), F.col("seq.item_no").alias("item_no"),
                                        "source_url", "listing_id", "provenance")


@query
def page_items_function(spark, sf_dir):
    """The same items by the table function in SQL."""
    register_page_items(spark)
    table(spark, sf_dir, "pages").createOrReplaceTempView("given_pages")
    return spark.sql("""SELECT page_id, item_no, href FROM page_items(
        TABLE(SELECT page_id, html FROM given_pages), item => 'li', link => 'a')""")


@query
def page_scan(spark, sf_dir):
    pages = non_empty_pages(read_pages(spark, f"{sf_dir}/pages.parquet"))
    return pages.select("page_no", "url", F.length("html").cast("bigint").alias("n_chars"))


# Discovery

def _summaries(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = page_items(inputs.list_pages(spark, sf_dir), base_url=inputs.SEARCH_PAGE,
                       selectors=inputs.LIST_SELECTORS)
    return list_summaries(items)


@query
def list_items(spark, sf_dir):
    return _summaries(spark, sf_dir).drop("seq")


@query
def search_frontier_(spark, sf_dir):
    searches = table(spark, sf_dir, "customer").selectExpr(
        "c_custkey", "CASE WHEN c_custkey % 3 = 0 THEN 'kommune' ELSE 'state' END AS sector",
        "c_custkey % 2 = 0 AS open_only", "CASE WHEN c_custkey % 5 <> 0 THEN concat(c_name, ' æ*~') ELSE '' END AS query",
        "int(c_custkey % 4) - 1 AS start_page", "CASE WHEN c_custkey % 7 <> 0 THEN int(c_nationkey % 4) END AS max_pages",
        "CASE WHEN c_custkey % 3 = 1 THEN map('sort', lower(c_mktsegment), 'page', '99') END AS extra")
    return search_frontier(searches).select("c_custkey", "page_no", "url")


@query
def url_canonical(spark, sf_dir):
    return inputs.url_variants(spark, sf_dir).select("url", canonical_url(F.col("url")).alias("canonical"))


@query
def url_site_id(spark, sf_dir):
    return inputs.url_variants(spark, sf_dir).select("url", site_id(F.col("url")).alias("site_id"))


@query
def listing_keys(spark, sf_dir):
    urls = inputs.url_variants(spark, sf_dir).withColumn("key", listing_key(F.col("url")))
    return urls.select("url", "key.listing_id", "key.provenance")


@query
def link_resolution(spark, sf_dir):
    links = table(spark, sf_dir, "orders").selectExpr(
        "o_orderkey", "CASE o_orderkey % 2 WHEN 0 THEN 'https://a.example/x/y?q=1#f' ELSE 'http://b.example' END AS base",
        """CASE o_orderkey % 9
               WHEN 0 THEN concat('https://c.example/', o_orderkey) WHEN 1 THEN concat('//c.example/', o_orderkey)
               WHEN 2 THEN concat('/p/', o_orderkey) WHEN 3 THEN concat('?r=', o_orderkey) WHEN 4 THEN 'z.html#s'
               WHEN 5 THEN concat('../../', o_orderkey, '/./u/../v') WHEN 6 THEN '' WHEN 7 THEN '#t'
               ELSE 'mailto:a@b.example' END AS href""")
    return links.select("o_orderkey", resolve_link(F.col("base"), F.col("href")).alias("link"))


# Texts

@query
def salary_ranges(spark, sf_dir):
    return inputs.salary_texts(spark, sf_dir).withColumn("s", salary_range(F.col("text"))).select("text", "s.*")


@query
def salary_ranges_extended(spark, sf_dir):
    wide = salary_range(F.col("text"), mode="extended")
    return inputs.salary_texts(spark, sf_dir).withColumn("s", wide).select("text", "s.*")


@query
def salary_frameworks(spark, sf_dir):
    return inputs.framework_texts(spark, sf_dir).select("text", salary_framework(F.col("text")).alias("framework"))


@query
def grouped_amounts(spark, sf_dir):
    amounts = table(spark, sf_dir, "lineitem").select(
        F.replace(F.format_number(F.col("l_extendedprice") * 1000, 0), F.lit(","),
                  F.element_at(F.array(*[F.lit(m) for m in (" ", ".", ",", "\u00A0", "\u202F", "\u2009")]),
                               F.col("l_linenumber") % 6 + 1)).alias("text"))
    return amounts.select("text", grouped_int(F.col("text")).alias("amount"))


@query
def code_sets(spark, sf_dir):
    return inputs.code_texts(spark, sf_dir).select("text", F.array_join(job_codes(F.col("text")), ",").alias("codes"))


@query
def code_sets_documents(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", F.explode(job_codes(F.col("text"))).alias("code"))


@query
def code_titles_(spark, sf_dir):
    pairs = inputs.code_texts(spark, sf_dir).select("text", F.posexplode(code_titles(F.col("text"))).alias("pos", "p"))
    return pairs.select("text", "pos", "p.job_code", "p.job_title")


# Organisations

@query
def accent_folding(spark, sf_dir):
    folded = fold_accents(F.col("text")).cast("binary")
    return table(spark, sf_dir, "documents").select("doc_id", F.md5(folded).alias("md5"))


@query
def org_normal(spark, sf_dir):
    texts = inputs.employers(spark, sf_dir).select(F.concat(F.lit("c"), "c_custkey").alias("id"),
                                                   F.col("employer").alias("text"))
    docs = table(spark, sf_dir, "documents").select(F.concat(F.lit("d"), "doc_id").alias("id"), "text")
    return texts.unionByName(docs).select("id", normalize_org(F.col("text")).alias("normal"))


@query
def org_tokens(spark, sf_dir):
    words = table(spark, sf_dir, "documents").select(F.explode(tokens(normalize_org(F.col("text")))).alias("token"))
    return words.groupBy("token").agg(F.count(F.lit(1)).alias("n"))


@query
def org_phrases(spark, sf_dir):
    named = inputs.employers(spark, sf_dir).withColumn("name", normalize_org(F.col("employer")))
    name = F.col("name")
    return named.select("c_custkey", contains_any(name, ("pst", "politiets sikkerhetstjeneste")).alias("has_pst"),
                        contains_any(name, ("nsm", "nasjonal sikkerhetsmyndighet")).alias("has_nsm"),
                        has_prefix(name, "forsvar").alias("has_prefix"))


@query
def org_rules(spark, sf_dir):
    return match_orgs(inputs.employers(spark, sf_dir), "employer", "title",
                      sector_applied=F.col("c_custkey") % 2 == 0)


@query
def org_fuzzy_jaccard(spark, sf_dir):
    return match_orgs(inputs.employers(spark, sf_dir), "employer", "title", sector_applied=True, fuzzy_threshold=0.3,
                      method="jaccard")


@query
def org_fuzzy_indel(spark, sf_dir):
    return match_orgs(inputs.employers(spark, sf_dir), "employer", "title", sector_applied=True, fuzzy_threshold=0.5)


@query
def org_scores(spark, sf_dir):
    """The scores themselves, of every employer and every phrase."""
    named = inputs.employers(spark, sf_dir).select("c_custkey", normalize_org(F.col("employer")).alias("name"))
    phrases = [p for org in DEFAULT_ORGS for p in org.fuzzy_phrases]
    scored = named.withColumn("scores", token_set_scores(F.col("name"), phrases))
    return scored.select("c_custkey", F.posexplode(F.transform("scores", lambda s: F.round(s, 6))).alias("phrase_no", "score"))


@query
def org_explained(spark, sf_dir):
    """The keyword that won and its confidence, for every rule."""
    return match_orgs(inputs.employers(spark, sf_dir), "employer", "title", sector_applied=True, fuzzy_threshold=0.5, explain=True).select(
        "c_custkey", "provenance", "matched_org_keyword", F.round("match_confidence", 6).alias("match_confidence"))


@query
def org_table(spark, sf_dir):
    """Employers against organisations given as a table."""
    return match_org_table(inputs.employers(spark, sf_dir).select("c_custkey", "employer"), "employer", inputs.org_table(spark, sf_dir),
                           fuzzy_threshold=0.95).withColumn("match_confidence", F.round("match_confidence", 6))


@query
def org_phrase_pairs(spark, sf_dir):
    """Which words of which length occur in which text of the tables, by looking their rarest grams up."""
    names = table(spark, sf_dir, "part").select(F.lower("p_name").alias("name"))
    words = table(spark, sf_dir, "part").selectExpr("lower(substring(p_name, 1 + int(p_partkey % 5), 1 + int(p_partkey % 6))) AS phrase")
    return phrases_in(names, words)


@query
def org_in_scope(spark, sf_dir):
    details = _details(spark, sf_dir).select("listing_id", "title", "employer_raw")
    return match_orgs(details, "employer_raw", "title", fuzzy_threshold=0.8).where("org_tag IS NOT NULL")


# State

def _empty_state(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], STATE)


def _first_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    return upsert(_empty_state(spark), inputs.runs(spark, sf_dir)[0])


@query
def state_upsert(spark, sf_dir):
    return upsert(_first_state(spark, sf_dir), inputs.runs(spark, sf_dir)[1])


@query
def state_from_summaries(spark, sf_dir):
    return upsert_summaries(_first_state(spark, sf_dir), inputs.runs(spark, sf_dir)[1], seen_at=RUN_TS)


@query
def state_commit(spark, sf_dir):
    root = work_dir(spark, "state")
    for part in inputs.runs(spark, sf_dir):
        commit_state(upsert(read_state(spark, root), part), root)
    return read_state(spark, root)


@query
def state_buckets(spark, sf_dir):
    """The state after commits of updates alone: every run and then ten small batches of the last one again."""
    root = work_dir(spark, "state")
    later = inputs.runs(spark, sf_dir)[1]
    for part in (*inputs.runs(spark, sf_dir), *[later.where(F.col("listing_id").endswith(f"{n}7")) for n in range(10)]):
        commit_updates(latest_updates(part), root, buckets=32)
    return read_state(spark, root)


@query
def fingerprints(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", fingerprint(F.col("html")).alias("detail_fingerprint"))


@query
def fingerprint_lookup(spark, sf_dir):
    later = inputs.runs(spark, sf_dir)[1].select("listing_id", "seq")
    return lookup_fingerprints(later, _first_state(spark, sf_dir))


@query
def fingerprint_update(spark, sf_dir):
    return update_fingerprints(_first_state(spark, sf_dir), inputs.runs(spark, sf_dir)[1])


def _decided(spark: SparkSession, sf_dir: str, **options) -> DataFrame:
    later = inputs.runs(spark, sf_dir)[1].select("listing_id", "source_url", "updated_at", "seq")
    return decide(later, _first_state(spark, sf_dir), **options)


@query
def candidates_(spark, sf_dir):
    return candidates(_decided(spark, sf_dir)).select("listing_id", "reason", "seq")


@query
def candidates_full(spark, sf_dir):
    every = inputs.updates(spark, sf_dir).select("listing_id", "source_url", "updated_at", "seq")
    return candidates(decide(every, _first_state(spark, sf_dir), full=True)).select("listing_id", "reason", "seq")


@query
def candidates_changed(spark, sf_dir):
    at_hand = inputs.runs(spark, sf_dir)[1].where("detail_fingerprint IS NOT NULL")
    return candidates(_decided(spark, sf_dir, fingerprints=at_hand)).select("listing_id", "reason", "seq")


@query
def candidate_sources_(spark, sf_dir):
    decided = _decided(spark, sf_dir)
    chosen = candidates(decided).select("listing_id", "reason", "seq")
    return candidate_sources(chosen, decided)


@query
def listings_unseen(spark, sf_dir):
    return unseen(_decided(spark, sf_dir, full=True), _first_state(spark, sf_dir)).select("listing_id", "seq")


@query
def listings_seen(spark, sf_dir):
    return seen(_decided(spark, sf_dir, full=True), _first_state(spark, sf_dir)).select("listing_id", "seq")


# Alignment and sinks

@query
def explode_arrays(spark, sf_dir):
    listings = table(spark, sf_dir, "orders").selectExpr(
        "concat('A', o_orderkey) AS listing_id", "'forsvaret' AS employer_normalized", "o_orderstatus AS published_at",
        "string(NULL) AS updated_at", "string(NULL) AS apply_deadline", "o_orderpriority AS source_url",
        """transform(filter(array(1, 2, 3), i -> i <= o_orderkey % 4), i -> named_struct('job_code',
           string(o_orderkey % 9000 + i), 'job_title', string(NULL), 'salary_min', o_orderkey * i, 'salary_max',
           o_orderkey * 2 * i, 'salary_text', 'x', 'is_shared_salary', IF(i = 2, true, NULL))) AS codes""")
    return explode_listings(listings, scraped_at=RUN_TS)


def _unlike_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    one = table(spark, sf_dir, "orders").selectExpr(
        "int(o_orderkey % 9000) AS job_code", "concat('A', o_orderkey) AS listing_id", "o_totalprice AS salary_min",
        "CASE o_orderkey % 4 WHEN 0 THEN '600000' WHEN 1 THEN '600000.0' WHEN 2 THEN 'etter avtale' ELSE '7e5' END "
        "AS salary_max", "o_orderkey % 2 = 0 AS is_shared_salary", "'x' AS unknown")
    two = table(spark, sf_dir, "lineitem").selectExpr(
        "concat('B', l_orderkey) AS listing_id", "l_shipdate AS scraped_at", "l_quantity AS salary_min",
        "l_partkey AS salary_max", "'true' AS is_shared_salary")
    stamped = two.withColumn("scraped_at", inputs.iso(F.col("scraped_at")))
    return align_exploded(one).unionByName(align_exploded(stamped))


@query
def schema_align(spark, sf_dir):
    return _unlike_rows(spark, sf_dir)


@query
def row_ingestion(spark, sf_dir):
    """JSON rows of any shape to the fixed schema, with what did not fit."""
    rows = ingest(inputs.json_rows(spark, sf_dir), "text")
    return rows.select("o_orderkey", "listing_id", "job_code", "job_title", "salary_min", "salary_max", "is_shared_salary", "problem",
                       F.array_join("unfit", ",").alias("unfit"))


@query
def load_stamp(spark, sf_dir):
    return stamp_load(_unlike_rows(spark, sf_dir), RUN_TS).select("listing_id", "scraped_at")


@query
def sink_exploded_parquet(spark, sf_dir):
    rows = advert_rows(spark, sf_dir).drop("scraped_at")
    return spark.read.parquet(sinks.write_exploded_parquet(rows, work_dir(spark, "out"), RUN_TS))


@query
def sink_exploded_csv(spark, sf_dir):
    rows = advert_rows(spark, sf_dir).drop("scraped_at")
    return sinks.read_exploded_csv(spark, sinks.write_exploded_csv(rows, work_dir(spark, "out"), RUN_TS))


@query
def sink_listings_parquet(spark, sf_dir):
    listings = listing_records(_details(spark, sf_dir), scraped_at=RUN_TS)
    return _flat_listings(spark.read.parquet(sinks.write_listings_parquet(listings, work_dir(spark, "out"), RUN_TS)))


@query
def sink_listings_csv(spark, sf_dir):
    listings = listing_records(_details(spark, sf_dir), scraped_at=RUN_TS)
    path = sinks.write_listings_csv(listings, work_dir(spark, "out"), RUN_TS)
    return _flat_listings(sinks.read_listings_csv(spark, path))


@query
def sink_runs(spark, sf_dir):
    """Two runs in one output of each format, the second repeated: it replaces only its own earlier rows."""
    out = work_dir(spark, "out")
    rows = _unlike_rows(spark, sf_dir)
    for stamp in ("2024-01-01T00:00:00Z", RUN_TS, RUN_TS):
        path = sinks.write_exploded_parquet(rows, out, stamp, mode="replace_runs")
        lines = sinks.write_exploded_csv(rows, out, stamp, mode="replace_runs")
    with_run = EXPLODED.simpleString()[7:-1] + ",run:string"
    as_csv = sinks.read_exploded_csv(spark, lines, schema=", ".join(with_run.replace(":", " ").split(",")))
    written = spark.read.schema(", ".join(with_run.replace(":", " ").split(","))).parquet(path)
    return written.withColumn("format", F.lit("parquet")).unionByName(as_csv.withColumn("format", F.lit("csv"))).groupBy(
        "format", "run", "is_shared_salary").agg(F.count(F.lit(1)).alias("n"))


# Quality and whole runs

@query
def quality_(spark, sf_dir):
    return quality.exploded_metrics(advert_rows(spark, sf_dir))


@query
def quality_duplicates(spark, sf_dir):
    return quality.duplicate_rate(_unlike_rows(spark, sf_dir))


@query
def latest_rows(spark, sf_dir):
    return distinct_rows(_unlike_rows(spark, sf_dir))


@query
def reason_counts(spark, sf_dir):
    return quality.reason_counts(candidates(_decided(spark, sf_dir)))


@query
def efficiency(spark, sf_dir):
    first, second = inputs.runs(spark, sf_dir)
    read = first.where("detail_fingerprint IS NOT NULL").select("listing_id")
    return incremental_efficiency(_empty_state(spark), first, second, seen_at_run1="2024-01-16T00:00:00Z",
                                  seen_at_run2=RUN_TS, fingerprinted=read)


@query
def run_summary(spark, sf_dir):
    """Two whole runs over the same pages: the second only tries the pages that were missing."""
    root, pages = work_dir(spark, "state"), work_dir(spark, "pages")
    listed = stage(inputs.list_pages(spark, sf_dir), pages, "list")
    served = stage(inputs.served_pages(spark, sf_dir), pages, "detail")
    found = []
    for n, stamp in enumerate(("2024-01-16T00:00:00Z", RUN_TS), 1):
        config = RunConfig(run_ts=stamp, state_root=root, out_dir=work_dir(spark, "out"), base_url=inputs.SEARCH_PAGE,
                           list_selectors=inputs.LIST_SELECTORS)
        result = run(spark, listed, served, config)
        found.append(result.summary.withColumn("run", F.lit(n)))
    return found[0].unionByName(found[1])


@query
def run_repeated_pages(spark, sf_dir):
    """One run for each way to match, over pages of which older, different copies are there too."""
    pages = work_dir(spark, "pages")
    listed = stage(inputs.list_pages(spark, sf_dir), pages, "list")
    served = stage(inputs.served_pages(spark, sf_dir), pages, "detail")
    old = served.select("url", F.lit('<div class="job-codes">kode 7777 - Gammel</div><p>').alias("html"))
    every = stage(served.withColumn("fetched", F.lit(2)).unionByName(old.withColumn("fetched", F.lit(1))), pages, "every")
    found = []
    for match in ("exact", "canonical"):
        config = RunConfig(run_ts="2024-01-16T00:00:00Z", state_root=work_dir(spark, "state"), base_url=inputs.SEARCH_PAGE,
                           list_selectors=inputs.LIST_SELECTORS, match=match, newest_by="fetched")
        found.append(run(spark, listed, every, config).summary.withColumn("match", F.lit(match)))
    return found[0].unionByName(found[1])


# Streams

@query
def stream_state(spark, sf_dir):
    path = work_dir(spark, "stream")
    writer = changes_writer(inputs.updates_of(inputs.stream_table(spark, sf_dir, "events")), f"{path}/state")
    writer.option("checkpointLocation", f"{path}/checkpoint").trigger(availableNow=True).start().awaitTermination()
    return read_state(spark, f"{path}/state")


@query
def stream_aggregate(spark, sf_dir):
    events = inputs.stream_table(spark, sf_dir, "events")
    path = work_dir(spark, "stream")
    writer = streaming_state(inputs.updates_of(events)).writeStream.outputMode("complete").foreachBatch(
        lambda batch, _: batch.write.mode("overwrite").parquet(f"{path}/state"))
    writer.option("checkpointLocation", f"{path}/checkpoint").trigger(availableNow=True).start().awaitTermination()
    return spark.read.schema(STATE).parquet(f"{path}/state")


@query
def stream_decisions(spark, sf_dir):
    """Candidates of the later run from a stateful stream that starts from the state after the first."""
    first, later = inputs.runs(spark, sf_dir)
    path = work_dir(spark, "stream")
    later.write.parquet(f"{path}/landing")
    feed = state_changes(spark.readStream.schema(later.schema).parquet(f"{path}/landing"), initial=upsert(_empty_state(spark), first), decisions=True)
    writer = feed.writeStream.outputMode("update").foreachBatch(
        lambda batch, n: batch.where("kind = 'candidate'").write.mode("overwrite").parquet(f"{path}/decided/batch_id={n}"))
    writer.option("checkpointLocation", f"{path}/checkpoint").trigger(availableNow=True).start().awaitTermination()
    return spark.read.parquet(f"{path}/decided").select("listing_id", "reason", "seq")


@query
def stream_rows(spark, sf_dir):
    orders = inputs.stream_table(spark, sf_dir, "orders")
    pages = inputs.adverts(orders, table(spark, sf_dir, "customer")).withColumn("scraped_at", F.lit(RUN_TS))
    path = work_dir(spark, "stream")
    (streaming_rows(pages).writeStream.format("parquet").option("path", f"{path}/rows")
     .option("checkpointLocation", f"{path}/checkpoint").trigger(availableNow=True).start().awaitTermination())
    return spark.read.parquet(f"{path}/rows")


@query
def stream_distinct(spark, sf_dir):
    """Rows of a stream without those whose key came before."""
    events = inputs.stream_table(spark, sf_dir, "events").select(
        F.concat(F.lit("L"), F.col("user_id")).alias("listing_id"), F.col("event_type").alias("job_code"), inputs.iso(F.col("ts")).alias("scraped_at"))
    path = work_dir(spark, "stream")
    writer = streaming_distinct(events, delay="60 days").select("listing_id", "job_code").writeStream.format("parquet").option("path", f"{path}/rows")
    writer.option("checkpointLocation", f"{path}/checkpoint").trigger(availableNow=True).start().awaitTermination()
    return spark.read.parquet(f"{path}/rows")


def _landed_stream(spark: SparkSession, sf_dir: str) -> str:
    """Three drops of events, each followed by a trigger of the incremental stream."""
    path = work_dir(spark, "stream")
    events = table(spark, sf_dir, "events")
    drop = F.when(F.col("ts") < F.lit("2024-01-11").cast("timestamp_ntz"), 0).when(
        F.col("ts") < F.lit("2024-01-21").cast("timestamp_ntz"), 1).otherwise(2)
    for n in range(3):
        events.where(drop == n).write.parquet(f"{path}/landing/drop={n}")
        landed = spark.readStream.schema(events.schema).parquet(f"{path}/landing/drop=*")
        writer = incremental_writer(inputs.updates_of(landed), f"{path}/state", f"{path}/decided")
        writer.option("checkpointLocation", f"{path}/checkpoint").trigger(availableNow=True).start().awaitTermination()
    return path


@query
def stream_candidates(spark, sf_dir):
    decided = spark.read.parquet(f"{_landed_stream(spark, sf_dir)}/decided")
    return decided.select("listing_id", "reason", "seq")


@query
def stream_versions(spark, sf_dir):
    return read_state(spark, f"{_landed_stream(spark, sf_dir)}/state")


@query
def stream_after_run(spark, sf_dir):
    """State from a batch commit and then from two streams, each with batches of its own from 0 on."""
    path = work_dir(spark, "stream")
    first, later = inputs.runs(spark, sf_dir)
    commit_state(upsert(_empty_state(spark), first), f"{path}/state")
    second_half = (F.col("last_seen_at") >= "2024-01-23").cast("int")
    for n in range(2):
        later.where(second_half == n).write.parquet(f"{path}/landing-{n}")
        landed = spark.readStream.schema(later.schema).parquet(f"{path}/landing-{n}")
        writer = incremental_writer(landed, f"{path}/state", f"{path}/decided")
        writer.option("checkpointLocation", f"{path}/checkpoint-{n}").trigger(availableNow=True).start().awaitTermination()
    return read_state(spark, f"{path}/state")
