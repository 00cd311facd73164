"""Time the headline queries and print one JSON line."""

from __future__ import annotations

import json
import os
import statistics
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from tallyloom.session import local_session  # noqa: E402
from tallyloom.workloads import QUERIES  # noqa: E402

HEADLINE = ["cell_qc_metrics", "sample_qc_stats", "barcode_ranks", "gene_mean_var", "std_variance_linear", "hvg_rank", "pseudobulk_sum", "log_cpm_raw",
            "majority_label", "knn_exact", "gsea_es"]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = local_session(cpus, cpus)
    QUERIES["splice_sum"](spark, sf_dir).write.format("noop").mode("overwrite").save()  # warm-up
    times = {}
    for name in HEADLINE:
        got = []
        for _ in range(runs):
            t = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            got.append(time.perf_counter() - t)
        times[name] = round(statistics.median(got), 3)
    print(json.dumps({"metric": "total wall time of headline queries (median of runs)", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": Path(sf_dir).name.removeprefix("sf")}))


if __name__ == "__main__":
    main()
