"""Time the headline queries; prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) names the data, BENCH_CPUS the local cores.
"""

from __future__ import annotations

import json
import os
import sys
import time

from tradeloom.session import build_session
from verification.catalog import QUERIES

HEADLINE = (
    "latest_submission",
    "sellout_curated",
    "company_kpi",
    "product_kpi",
    "market_kpi",
    "gold_quality_checks",
    "event_type",
    "country_lookup",
    "customer_channel_enrich",
    "surrogate_keys",
    "dim_product_master",
    "product_classify",
    "ref_exchange_rates",
    "fx_cross",
    "fx_convert",
    "geo_price_fallback",
    "temporal_price_fallback",
    "valorize",
    "period_split",
    "sellout_valorized",
    "harmonized",
    "legacy_import",
    "merge_metric_files",
    "matrix_to_long",
    "block_segments",
    "span_expand",
    "insert_only_merge",
    "resubmission_stream",
)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        spark__sql__shuffle__partitions=cpus,
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
        spark__driver__memory="16g",
    )
    spark.sparkContext.setLogLevel("ERROR")
    QUERIES["market_kpi"].run(spark, folder).write.format("noop").mode("overwrite").save()  # warm up
    timings = {}
    for name in sys.argv[1:] or HEADLINE:
        start = time.perf_counter()
        QUERIES[name].run(spark, folder).write.format("noop").mode("overwrite").save()
        timings[name] = round(time.perf_counter() - start, 3)
    total = round(sum(timings.values()), 3)
    scale = os.path.basename(folder.rstrip("/")).removeprefix("sf")
    print(
        json.dumps(
            {"metric": "total_seconds", "value": total, "unit": "sec", "queries": timings, "sf": scale}
        )
    )


if __name__ == "__main__":
    main()
