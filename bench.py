"""Time the headline queries and print one JSON line.

Each query is run once to warm up and then twice more, while its whole result is
written to Spark's ``noop`` sink; the faster time counts.  ``rates`` gives input rows
per second.
"""

from __future__ import annotations

import json
import os
import time

from changeloom.queries import QUERIES
from changeloom.session import build_session

# Headline queries and the table whose rows they work through.
HEADLINE = {
    "table_snapshot": "orders",
    "detail_for_recent_headers": "lineitem",
    "decode_json_wrapped": "events",
    "render_summary": "events",
    "materialize": "events",
    "net_changes": "events",
    "compact_log": "events",
    "retain": "events",
    "publish": "events",
    "incremental_snapshot": "lineitem",
    "incremental_state": "lineitem",
    "message_summary": "events",
    "exact_percentile": "events",
    "sample_series": "events",
    "counter_rates": "events",
    "offset_gaps": "events",
    "order_audit": "events",
    "format_sizes": "events",
    "stream_materialize": "events",
}


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "4")
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        spark__sql__shuffle__partitions=cpus,
        spark__ui__enabled="false",
        spark__driver__memory="8g",
        spark__ui__showConsoleProgress="false",
    )
    spark.sparkContext.setLogLevel("ERROR")
    sizes = {t: spark.read.parquet(f"{sf_dir}/{t}.parquet").count() for t in set(HEADLINE.values())}
    times, rates = {}, {}
    for name, table in HEADLINE.items():
        def run():
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()

        def timed():
            begun = time.perf_counter()
            run()
            return time.perf_counter() - begun

        run()
        times[name] = round(min(timed(), timed()), 3)
        rates[name] = round(sizes[table] / times[name])
    print(
        json.dumps(
            {
                "metric": "headline_total",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "rates": rates,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
