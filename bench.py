"""Time the headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; print one JSON line.

Each query is run to completion into Spark's ``noop`` sink (every row is
computed, nothing is collected), once to warm up and once for the time.  The
value is the sum of the warm times; ``cold`` has the first runs.
"""

from __future__ import annotations

import json
import os
import sys
import time

HERE = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, HERE)
os.environ["PYTHONPATH"] = os.pathsep.join(filter(None, [HERE, os.environ.get("PYTHONPATH")]))  # for the workers

from corpusloom.plans import all_queries  # noqa: E402
from corpusloom.session import build_session  # noqa: E402

HEADLINE = [
    "tok_bytes",
    "pack_blocks",
    "split_exact",
    "tok_words",
    "vocab_merge",
    "render_llama2_pieces",
    "mask_llama2_long",
    "mask_two_long",
    "sft_labels",
    "collate_pad",
    "history_trim",
    "modality_batches",
    "collate_mm",
    "eval_loss",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE
    spark = build_session(cpus, shuffle_partitions=int(cpus) if cpus.isdigit() else 8, app="corpusloom-bench")
    qs = all_queries()
    # warm the JVM and the parquet footers once, outside the timings
    spark.read.parquet(f"{sf_dir}/documents.parquet").limit(1).collect()
    cold, times = {}, {}
    for name in names:
        for took in (cold, times):
            t0 = time.time()
            qs[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            took[name] = round(time.time() - t0, 3)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "headline_total", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": sf, "cold": cold, "cpus": cpus, "machine_cpus": os.cpu_count(),
                      "memory_gb": round(os.sysconf("SC_PAGE_SIZE") * os.sysconf("SC_PHYS_PAGES") / 1e9)}))
    spark.stop()


if __name__ == "__main__":
    main()
