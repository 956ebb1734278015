"""Time the headline queries at ``$BENCH_SF_DIR`` on ``local[$BENCH_CPUS]``; one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

from catalog.queries import QUERIES
from kindred.session import build_session

HEADLINE = [
    "facet_filter", "facet_gate", "multi_hot", "label_encode", "clean_categories", "time_to_minutes",
    "unique_words", "word_overlap_topk", "word_ngrams", "char_ngrams", "tfidf_vocab", "tfidf_norms",
    "tfidf_topk", "vector_topk", "vector_topk_filtered", "blend_topk", "blend_fallback", "result_lookup",
    "encode_concat", "zero_shot", "ingredient_flags", "feature_build", "search_e2e",
    "search_shared_filter", "hit_report", "method_report",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 8))
    names = sys.argv[1:] or HEADLINE
    spark = build_session(
        "bench", f"local[{cpus}]",
        **{"spark.sql.shuffle.partitions": cpus, "spark.driver.memory": "16g", "spark.ui.showConsoleProgress": "false"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    # The first Python task of a session starts the workers; that is not the query's time.
    QUERIES["ingredient_labels"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    seconds = {}
    for name in names:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    spark.stop()
    scale = os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")
    print(json.dumps({
        "metric": "headline_total", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "sf": float(scale) if scale.replace(".", "").isdigit() else scale,
    }))


if __name__ == "__main__":
    main()
