"""Time the headline queries on `$BENCH_SF_DIR` with `local[$BENCH_CPUS]`; prints one JSON line.

Each query is planned and run to the end of its last column (the `noop` sink), so building eager steps counts as well.
One small query warms the session up first. The tables lie in one file each, of one or two row groups, which is one or two tasks;
before the clock starts they are written to scratch as FILES files each, as a table of any size would lie.
"""

from __future__ import annotations

import json
import os
import re
import sys
import tempfile
import time

from advertlode.plans.queries import QUERIES
from advertlode.session import builder

HEADLINE = ("advert_rows", "advert_listings", "page_fields", "page_links", "list_items", "search_frontier",
            "url_canonical", "listing_keys", "salary_ranges", "code_sets", "code_titles", "org_normal", "org_rules",
            "org_fuzzy_indel", "state_upsert", "candidates", "candidate_sources", "fingerprint_update", "schema_align",
            "sink_exploded_parquet", "quality", "efficiency", "run_summary", "stream_state")


TABLES = "nation customer part orders lineitem events documents pages".split()
FILES = 32


def main(names: list[str]) -> None:
    given = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS") or str(os.cpu_count())
    spark = builder("bench", **{"spark.sql.shuffle.partitions": cpus, "spark.ui.enabled": "false",
                                "spark.driver.memory": "16g", "spark.sql.files.openCostInBytes": "1m"}).master(f"local[{cpus}]").getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")

    sf_dir = tempfile.mkdtemp(prefix="bench-")
    for name in TABLES:
        spark.read.parquet(f"{given}/{name}.parquet").repartition(FILES).write.parquet(f"{sf_dir}/{name}.parquet")

    def seconds(name: str) -> float:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return round(time.perf_counter() - start, 3)

    seconds("page_fields")
    times = {name: seconds(name) for name in names or HEADLINE}
    spark.stop()
    sf = re.search(r"sf([0-9.]+)", given)
    print(json.dumps({"metric": "total wall time of headline queries", "value": round(sum(times.values()), 3),
                      "unit": "sec", "queries": times, "sf": float(sf[1]) if sf else None}))


if __name__ == "__main__":
    main(sys.argv[1:])
