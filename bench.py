"""Times headline queries and prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) names the tables, BENCH_CPUS (default 8) the
cores, BENCH_QUERIES (optional, comma-separated, or "all") the queries.
"""

from __future__ import annotations

import json
import os
import sys
import time

from pyspark.sql import SparkSession

from tomewise.queries import QUERIES

HEADLINE = (
    "flagship", "category_filter", "median_impute", "quality_filter", "iqr_filter", "title_stats",
    "desc_stats", "readability", "lexicon_sentiment", "text_quality", "select_by_name",
    "popularity_features", "decile_bucket", "standard_scale", "label_encode", "tfidf_terms",
    "tfidf_weights", "text_svd", "quantile_normal", "select_k_best", "yeo_johnson_roundtrip",
    "knn_topk", "knn_rating_stats", "knn_multiscale", "semantic_block", "fold_assignment",
    "regression_metrics", "train_linear", "train_random_forest", "train_gbt", "score_batch",
    "good_runs", "promote_version", "compare_versions",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    wanted = os.environ.get("BENCH_QUERIES", "")
    names = list(QUERIES) if wanted == "all" else [n for n in wanted.split(",") if n] or HEADLINE
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    # starts the JVM and the Python workers once, so that the first query does not pay for it
    spark.range(int(cpus)).mapInPandas(lambda it: it, "id long").count()
    # and one whole query, so that the first one measured finds compiled code
    QUERIES["flagship"](spark, sf_dir).write.format("noop").mode("overwrite").save()

    times: dict[str, float] = {}
    for name in names:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - start, 3)
        print(name, times[name], file=sys.stderr, flush=True)
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(sf_dir.rstrip("/")),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
