"""Time the headline queries and print one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from textloom import catalog  # noqa: E402
from textloom.session import local_session  # noqa: E402

# the tokenizer is learnt first and timed on its own; these queries are given it
WITH_MODEL = ("bpe_encode", "bpe_round_trip", "corpus_to_shards", "chat_encoding")
HEADLINE = (
    "bpe_merges", "word_tokens", "quality_filter", "minhash_signature", "dedup_first_kept", "clean_unique_by_source", "incremental_dedup",
    "byte_budget_prefix", "pack_sequences", "shard_assignment", "piece_counts", "bpe_encode", "bpe_round_trip",
    "corpus_to_shards", "chat_encoding", "padded_batches", "preference_pairs", "epoch_batches",
    "sequence_log_probs", "sampling_candidates",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = int(os.environ.get("BENCH_CPUS", "8"))
    spark = local_session(cores, shuffle_partitions=cores)
    # the driver's tables are single files, which one task would read
    spark.conf.set("textloom.spreadTasks", str(2 * cores))
    # start the JVM's and Python's workers outside the measurements
    catalog.language_filter(spark, sf_dir).count()
    catalog.minhash_signature(spark, "/root/testdata/sf0.001").write.format("noop").mode("overwrite").save()
    queries = catalog.all_queries()
    times = {}
    for name in HEADLINE:
        started = time.time()
        options = {"model": model} if name in WITH_MODEL else {}
        if name == "bpe_merges":
            model = options["model"] = catalog.tokenizer(spark, sf_dir)
        queries[name](spark, sf_dir, **options).write.format("noop").mode("overwrite").save()
        times[name] = round(time.time() - started, 3)
    docs = catalog.read(spark, sf_dir, "documents").count()
    total = round(sum(times.values()), 3)
    print(
        json.dumps(
            {
                "metric": "headline_total",
                "value": total,
                "unit": "sec",
                "queries": times,
                "sf": Path(sf_dir).name.removeprefix("sf"),
                "docs_per_sec": {q: round(docs / times[q], 1) for q in ("minhash_signature", "dedup_first_kept", "bpe_encode")},
            }
        )
    )


if __name__ == "__main__":
    main()
