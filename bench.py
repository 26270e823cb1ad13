"""Bench: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Each query runs its whole plan into Spark's ``noop`` sink (no collect to
the driver) after one warm-up on the smoke data; prints ONE JSON line.
Nothing is cached between queries, so every time is that of a cold query.
With ``BENCH_HEAVY=1`` the keys with the largest results are timed as well,
under ``heavy``; they are not part of the headline total.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "flagship_labelled_tokens_per_case",
    "token_offsets",
    "label_overlap90",
    "label_boundary",
    "char_micro_f1",
    "decode_runs_exact",
    "decode_token_runs",
    "vocab_topk",
    "cv_scores_rollup",
    "roc_auc",
    "smooth_valid",
]

HEAVY = ["cv_oof_scores", "concat_feature_token_vec", "char_pred_3class", "batch_score_tokens"]


def main():
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    from spanframe.session import build_session
    from spanframe.plans.registry import load_all

    spark = build_session(master=f"local[{cpus}]", shuffle_partitions=max(8, 2 * int(cpus)))
    reg = load_all()
    # warm-up on the smoke data: starts the Python workers and JIT-compiles the
    # hot paths once, so the timings below measure the queries, not start-up
    reg["flagship_labelled_tokens_per_case"].build(spark, "/root/testdata/sf0.001") \
        .write.format("noop").mode("overwrite").save()

    def timed(keys):
        out = {}
        for key in keys:
            t0 = time.time()
            reg[key].build(spark, sf_dir).write.format("noop").mode("overwrite").save()
            out[key] = round(time.time() - t0, 3)
            spark.catalog.clearCache()
        return out

    times = timed(HEADLINE)
    heavy = {"heavy": timed(HEAVY)} if os.environ.get("BENCH_HEAVY") else {}
    sf = sf_dir.rstrip("/").rsplit("sf", 1)[-1]
    print(json.dumps({"metric": "headline_total", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": sf} | heavy))


if __name__ == "__main__":
    main()
