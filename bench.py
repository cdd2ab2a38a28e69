"""Time the headline queries and print one JSON line.

    BENCH_SF_DIR   folder of tables (default /root/testdata/sf0.1)
    BENCH_CPUS     local cores (default 8)
    BENCH_QUERIES  comma-separated names, or "all" (default: the headline list)

A query's time covers everything from calling it to having produced all of its
rows, which are discarded instead of collected. One small query runs first, so
that no time includes the start of the JVM.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from larkspur.plans import REGISTRY  # noqa: E402
from larkspur.session import build_session  # noqa: E402

HEADLINE = [
    "agg_join_group", "agg_group_count_2", "agg_crosstab", "agg_count_distinct", "agg_mean_std",
    "join_lookup", "join_mixed_type_key", "flt_conjunction", "prj_feature_subset",
    "prj_missing_to_zero", "sort_multi", "topk", "win_running_count", "win_dense_index",
    "src_delimited_header", "split_random_3", "split_nth_per_user", "split_kfold_position",
    "feat_one_hot", "feat_standardize", "fit_tree_binary", "fit_tree_multi", "fit_tree_regressor",
    "fit_random_forest", "fit_gbt", "fit_naive_bayes", "fit_logistic_sgd", "fit_svm_sgd",
    "pipeline_fit_transform", "score_batch", "eval_auc_score", "eval_auc_hard", "tune_cv",
    "tune_grid_holdout", "rec_fit_als", "rec_items_for_users",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    asked = os.environ.get("BENCH_QUERIES", "")
    names = list(REGISTRY) if asked == "all" else asked.split(",") if asked else HEADLINE

    spark = build_session(
        app="larkspur-bench",
        master=f"local[{cpus}]",
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
        spark__sql__shuffle__partitions=cpus,
        spark__driver__memory="16g",
    )
    spark.sparkContext.setLogLevel("ERROR")
    REGISTRY["agg_group_count_1"].run(spark, folder).collect()

    seconds: dict[str, float] = {}
    for name in names:
        began = time.perf_counter()
        REGISTRY[name].run(spark, folder).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - began, 3)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total_query_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(folder).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
