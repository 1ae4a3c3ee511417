"""Time the headline queries; prints one JSON line.

BENCH_SF_DIR names the data folder, BENCH_CPUS the number of local cores.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from larkspur.plans.catalog import QUERIES  # noqa: E402
from larkspur.session import build_session, drop_scratch  # noqa: E402

HEADLINE = [
    "area_price_top",
    "group_mean",
    "top_n",
    "join_inner",
    "join_substring_exists",
    "box_stats",
    "letter_values",
    "kernel_density",
    "term_frequency",
    "segment_sentences",
    "argmax_category",
    "select_pos_tokens",
    "word_sentiment",
    "tag_entities",
    "tfidf_l2",
    "chi2_select",
    "naive_bayes",
    "lda_online_topics",
    "lda_em_topics",
    "rating_regression",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 4))
    names = sys.argv[1:] or HEADLINE
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        spark__sql__shuffle__partitions=cpus,
        spark__driver__memory="12g",
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
    )
    spark.sparkContext.setLogLevel("ERROR")
    spark.read.parquet(f"{sf_dir}/orders.parquet").count()  # start the executors
    seconds = {}
    for name in names:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
        print(f"{name} {seconds[name]}", file=sys.stderr, flush=True)
        drop_scratch(spark)
    total = round(sum(seconds.values()), 3)
    line = {"metric": "total_seconds", "value": total, "unit": "sec", "queries": seconds}
    scale = Path(sf_dir).name.removeprefix("sf")
    print(json.dumps({**line, "sf": float(scale) if scale.replace(".", "", 1).isdigit() else scale}))
    spark.stop()


if __name__ == "__main__":
    main()
