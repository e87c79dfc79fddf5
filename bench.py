"""Times the headline queries: one JSON line with seconds per query.

BENCH_SF_DIR names the table folder, BENCH_CPUS the local cores, BENCH_QUERIES (optional,
comma-separated) a selection.
"""

from __future__ import annotations

import json
import os
import time

from triagelake.plans import catalog
from triagelake.session import local_session

HEADLINE = (
    "session_features", "session_sequences", "markov_surprise", "decide_by_argmax", "check_matrix", "robust_scale",
    "quantile_summary", "pct_rank", "average_precision", "paired_bootstrap", "adjusted_rand", "blast_radius",
    "pagerank", "valid_edges", "use_weights", "safe_holdout", "uniform_negatives", "degree_matched_negatives",
    "sanitize_evidence", "selection_audit", "control_summary", "verify_assets", "session_log_scan", "flow_scan",
    "tfidf", "nmf_topics", "silhouette", "kmeans_scores", "iforest_rarity", "posture_predict",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(",")
    spark = local_session(cpus, "triagelake-bench")
    catalog.QUERIES["state_funnel"](spark, sf_dir).collect()  # start the engine outside the clock
    seconds = {}
    for name in names:
        start = time.perf_counter()
        catalog.QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    print(json.dumps({
        "metric": "headline queries, total wall time", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "sf": sf_dir.rstrip("/").rsplit("sf", 1)[-1],
    }))
    spark.stop()


if __name__ == "__main__":
    main()
