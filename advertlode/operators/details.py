"""From detail pages to listing rows and one row per listing and job code."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.codes import code_titles
from ..functions.html import DEFAULT_DETAIL, DetailSelectors, detail_page
from ..functions.orgs import normalize_org
from ..functions.salary import salary_framework, salary_range
from ..functions.text import blank_to_null, strip
from ..schemas import EXPLODED, EXTENDED, LISTING, SCHEMA_VERSION

def split_values(text: Column) -> Column:
    """Values separated by comma or slash, trimmed, blanks dropped; NULL when none is left."""
    values = F.filter(F.transform(F.split(text, "[,/]", -1), strip), lambda v: v != "")
    return F.when(F.size(values) > 0, values)


def detail_fields(pages: DataFrame, selectors: DetailSelectors = DEFAULT_DETAIL, *, html: str = "html") -> DataFrame:
    """Replace the html of each page by its fields and its job-code `blocks`, in one pass over the markup.

    The page is read inside a generator, so that filters on the columns that pass through reach the scan.
    """
    others = [c for c in pages.columns if c != html]
    read = pages.select(*others, F.explode(F.array(detail_page(F.col(html), selectors))).alias("_page"))
    return read.select(
        *others, "_page.title", "_page.job_title", F.col("_page.employer").alias("employer_raw"),
        blank_to_null(normalize_org(F.col("_page.employer"), folded=F.col("_page.employer_folded"))).alias(
            "employer_normalized"),
        split_values(F.col("_page.locations")).alias("locations"),
        "_page.employment_type", "_page.extent", "_page.salary_text", "_page.published_at", "_page.updated_at",
        "_page.apply_deadline", "_page.blocks")


def code_rows(details: DataFrame, *, mode: str = "standard", per_code: bool = False) -> DataFrame:
    """One row per page, block and job code: the columns of `details` but for `blocks`, and the struct `code`.

    The salary of a block goes to each of its codes. A block without one takes the page's salary text, if there is
    any, and marks its rows as shared, even when that text holds no amount either. Blocks without a code give no row.
    With `per_code` each code has its own part of the block, which is its title, in place of the block.
    """
    columns = [c for c in details.columns if c != "blocks"]
    blocks = (details.withColumn("_common", salary_range(F.col("salary_text"), mode=mode))
              .withColumn("_block", F.explode("blocks")))
    if per_code:
        coded = (blocks.select(*columns, "_common", F.explode(code_titles(F.col("_block"))).alias("_pair"))
                 .withColumn("_text", F.col("_pair.job_title"))
                 .withColumn("_own", salary_range(F.col("_text"), mode=mode)))
    else:
        coded = (blocks.withColumn("_own", salary_range(F.col("_block"), mode=mode)).withColumn("_text", F.col("_block"))
                 .select(*columns, "_common", "_own", "_text", F.explode(code_titles(F.col("_block"))).alias("_pair")))
    shared = (F.col("_own.salary_min").isNull() & F.col("_own.salary_max").isNull()
              & F.coalesce(F.col("salary_text") != "", F.lit(False)))
    code = F.struct(
        "_pair.job_code", "_pair.job_title",
        *[F.when(shared, F.col(f"_common.{name}")).otherwise(F.col(f"_own.{name}")).alias(name)
          for name in ("salary_min", "salary_max")],
        strip(F.when(shared, F.col("salary_text")).otherwise(F.col("_text"))).alias("salary_text"),
        shared.alias("is_shared_salary"))
    return coded.select(*columns, code.alias("code"))


def listing_records(details: DataFrame, *, scraped_at: Column | str) -> DataFrame:
    """Listing rows in the fixed schema."""
    stamped = details.withColumn("scraped_at", F.lit(scraped_at) if isinstance(scraped_at, str) else scraped_at)
    return stamped.select(LISTING.names)


def exploded_rows(coded: DataFrame, *, scraped_at: Column | str | None = None, extended: bool = False) -> DataFrame:
    """Rows with a `code` struct in the fixed exploded schema. With `extended` also the columns of `EXTENDED`: its version, the
    salary framework that a row without amounts names, and the keyword and confidence of the organisation, which are NULL unless
    `coded` has them (`match_orgs` with `explain`)."""
    stamp = scraped_at if isinstance(scraped_at, Column) else F.lit(scraped_at).cast("string")
    given = {name: F.col(f"code.{name}")
             for name in ("job_code", "job_title", "salary_min", "salary_max", "salary_text")}
    given["is_shared_salary"] = F.coalesce(F.col("code.is_shared_salary"), F.lit(False))
    given["scraped_at"] = stamp
    if extended:
        given["schema_version"] = F.lit(SCHEMA_VERSION)
        given["salary_framework"] = F.when(F.col("code.salary_min").isNull(), salary_framework(F.col("code.salary_text")))
        given |= {f.name: F.lit(None).cast(f.dataType) for f in EXTENDED if f.name.startswith("match") and f.name not in coded.columns}
    return coded.select(*[given.get(name, F.col(name)).alias(name) for name in (EXTENDED if extended else EXPLODED).names])


def explode_listings(listings: DataFrame, codes: str = "codes", *,
                     scraped_at: Column | str | None = None) -> DataFrame:
    """Listings with an array of code rows to one row each; a listing without codes gives none."""
    return exploded_rows(listings.withColumn("code", F.explode(codes)), scraped_at=scraped_at)


def distinct_rows(exploded: DataFrame) -> DataFrame:
    """One row per (listing_id, job_code), the latest scraped; equal stamps go by the other columns."""
    names = EXTENDED.names if set(EXTENDED.names) <= set(exploded.columns) else EXPLODED.names
    rest = [c for c in names if c not in ("listing_id", "job_code", "scraped_at")]
    latest = F.max(F.struct("scraped_at", *rest)).alias("row")
    return exploded.groupBy("listing_id", "job_code").agg(latest).select("listing_id", "job_code", "row.*") \
        .select(names)
