"""Times the headline queries on one data directory; prints one JSON line.

``BENCH_SF_DIR`` names the directory and ``BENCH_CPUS`` the number of cores. A
query is timed until all of its rows exist. The ties are derived and the graph
is projected first, with times of their own, as the questions are asked of a
graph that is already there; each further query runs once, in this order. Before
that, every query runs on the smallest data next to it, to warm up the JVM.
"""

from __future__ import annotations

import json
import os
import sys
import time

from tieweave.plans import catalog, ingest_catalog, registry  # noqa: F401
from tieweave.plans.workspace import Workspace
from tieweave.session import local_session

HEADLINE = (
    "conoce_a", "project_graph", "top_ties", "degree", "density", "isolated_users",
    "conoce_a_incremental", "event_recommendation", "event_recommendation_all",
    "strangers_same_circle", "new_companions_by_order", "new_companions_by_date", "debutants",
    "large_groups", "same_table_type", "same_vip_table", "promo_reach", "indirect_reach",
    "shortest_path", "pagerank", "influencers", "communities", "community_summary",
    "vip_subgroups", "multi_community_users", "ticket_purchase_edges", "attendance_edges",
    "reservation_edges", "social_ties", "norm_csv_asistio_a", "reduce_cdc_to_current",
    "envelope_ingest", "upsert_nodes", "stream_job",
)


def main() -> None:
    directory = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", "8")
    chosen = sys.argv[1:] or HEADLINE
    spark = local_session(cores, int(cores))
    work = Workspace(spark, directory)
    work.table("orders").count()
    smallest = os.path.join(os.path.dirname(directory.rstrip("/")), "sf0.001")
    if os.path.isdir(smallest):
        warm = Workspace(spark, smallest)
        for name in chosen:
            registry.JOBS[name](warm).write.format("noop").mode("overwrite").save()
    seconds = {}
    for name in chosen:
        start = time.perf_counter()
        registry.JOBS[name](work).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
        print(f"{name}: {seconds[name]}", file=sys.stderr, flush=True)
    print(json.dumps({
        "metric": "total_query_time",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(directory.rstrip("/")).removeprefix("sf"),
        "cores": int(cores),
        "shuffle_partitions": int(cores),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
