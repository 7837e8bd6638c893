"""Fixed schemas. Instants are ISO-8601 UTC text and compare byte by byte, so they stay strings."""

from __future__ import annotations

from pyspark.sql.types import (ArrayType, BooleanType, DoubleType, IntegerType, LongType, MapType, StringType, StructField,
                               StructType)


def _struct(*fields) -> StructType:
    return StructType([StructField(name, dtype, name not in required) for name, dtype, required in
                       ((f[0], f[1], (f[0],) if len(f) > 2 else ()) for f in fields)])


_S, _L, _B, _TEXTS = StringType(), LongType(), BooleanType(), ArrayType(StringType())

PAGE = _struct(("page_no", IntegerType()), ("url", _S), ("html", _S))

SEARCH = _struct(("sector", _S), ("open_only", _B), ("query", _S), ("start_page", IntegerType()),
                 ("max_pages", IntegerType()), ("extra", MapType(_S, _S)))

SUMMARY = _struct(("listing_id", _S, "required"), ("source_url", _S, "required"), ("published_at", _S),
                  ("updated_at", _S), ("provenance", _S))

STATE = _struct(("listing_id", _S), ("last_seen_at", _S), ("updated_at", _S), ("detail_fingerprint", _S))

LISTING = _struct(("listing_id", _S, "required"), ("source_url", _S, "required"), ("title", _S), ("job_title", _S),
                  ("employer_raw", _S), ("employer_normalized", _S), ("locations", _TEXTS), ("employment_type", _S),
                  ("extent", _S), ("salary_text", _S), ("published_at", _S), ("updated_at", _S),
                  ("apply_deadline", _S), ("scraped_at", _S))

CODE_ROW = _struct(("job_code", _S), ("job_title", _S), ("salary_min", _L), ("salary_max", _L), ("salary_text", _S),
                   ("is_shared_salary", _B))

EXPLODED = _struct(("listing_id", _S), ("job_code", _S), ("job_title", _S), ("employer_normalized", _S),
                   ("salary_min", _L), ("salary_max", _L), ("salary_text", _S), ("is_shared_salary", _B),
                   ("published_at", _S), ("updated_at", _S), ("apply_deadline", _S), ("source_url", _S),
                   ("scraped_at", _S))

#: The version of `EXTENDED`.
SCHEMA_VERSION = "1.0"
EXTENDED = StructType([*EXPLODED, StructField("schema_version", _S), StructField("matched_org_keyword", _S),
                       StructField("match_confidence", DoubleType()), StructField("salary_framework", _S)])
