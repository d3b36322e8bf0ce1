"""Time the headline queries and print one JSON line.

BENCH_SF_DIR names the folder of tables, BENCH_CPUS the number of cores.
"""

from __future__ import annotations

import json
import os
import tempfile
import time

from pyspark.sql import SparkSession

from workloads.queries import QUERIES

HEADLINE = [
    "enrich_segments",
    "extractive_summary",
    "extract_entities",
    "topic_segments",
    "topic_segments_dense",
    "topic_summary",
    "merge_nlp",
    "entity_pairs",
    "co_occurrences",
    "co_occurrence_job",
    "append_segments",
    "append_entities",
    "global_segment_ids",
    "term_counts",
    "top_entities",
    "topic_timeline",
    "graph_triples",
    "process_batch",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.driver.memory", "12g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="loquent-"))
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    # Counting the segments also starts the executors and opens the files.
    segments = QUERIES["word_count"](spark, folder).count()
    names = os.environ.get("BENCH_QUERIES", "")
    seconds = {}
    for name in names.split() or HEADLINE:
        begin = time.time()
        # The noop sink works out every column of every row and keeps none.
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.time() - begin, 3)
    result = {
        "metric": "total time of the headline queries",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
        "segments": segments,
    }
    if seconds.get("enrich_segments"):
        rate = segments / seconds["enrich_segments"]
        result["enriched_segments_per_sec"] = round(rate, 1)
    print(json.dumps(result))


if __name__ == "__main__":
    main()
