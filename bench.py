"""Headline-query benchmark.

Runs the main operators on ``$BENCH_SF_DIR`` (default /root/testdata/sf0.1)
with ``local[$BENCH_CPUS]`` and prints one JSON line.  Each query is executed
in full through the no-op sink (no driver collect).  One untimed warm-up query
absorbs JVM start-up.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F  # noqa: E402

from tokenmill.operators import bpe as B  # noqa: E402
from tokenmill.operators import clean as C  # noqa: E402
from tokenmill.operators import codec as X  # noqa: E402
from tokenmill.operators import dedupe as D  # noqa: E402
from tokenmill.operators import pretokenize as P  # noqa: E402
from tokenmill.plans import queries as Q  # noqa: E402
from tokenmill.session import local_session  # noqa: E402
from tokenmill.sources.tables import read_documents  # noqa: E402


def run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cpus, shuffle_partitions=int(cpus) if cpus.isdigit() else 8, app="tokenmill-bench")
    sf = sf_dir.rstrip("/").rsplit("sf", 1)[-1]

    run(read_documents(spark, sf_dir).select(F.length("text")))  # warm-up, untimed

    def docs():
        return C.clean_documents(read_documents(spark, sf_dir))

    trained = []

    def train():
        trained.append(B.bpe_train(P.pretoken_counts(docs()), 256 + 150 + 1))
        return trained[-1]

    plans = {
        "flagship_dedupe_pretoken_counts": lambda: run(Q.q_flagship(spark, sf_dir)),
        "dedupe_exact": lambda: run(D.dedupe_exact(docs())),
        "pretoken_counts": lambda: run(P.pretoken_counts(docs())),
        "pair_stats_top": lambda: run(P.top_pair(P.pair_stats(P.pretoken_bytes(P.pretoken_counts(docs()))), 3)),
        "bpe_train_150_merges": train,
        "encode_documents": lambda: run(X.encode_documents(docs(), Q.fixed_model())),
        "encode_trained_150_merges": lambda: run(X.encode_documents(docs(), trained[-1] if trained else train())),
        "encode_decode_roundtrip": lambda: run(X.decode_tokens(X.encode_documents(docs(), Q.fixed_model()), Q.fixed_model())),
        "window_examples": lambda: run(Q._examples(spark, sf_dir)[0]),
        "top_p_filter": lambda: run(Q.q_top_p_filter(spark, sf_dir)),
        "chunk_stats": lambda: run(Q.q_corpus_chunks(spark, sf_dir)),
    }
    only = [k for k in os.environ.get("BENCH_ONLY", "").split(",") if k]
    times = {}
    for name, fn in plans.items():
        if only and name not in only:
            continue
        t0 = time.perf_counter()
        fn()
        times[name] = round(time.perf_counter() - t0, 3)
    print(json.dumps({
        "metric": "total_headline_seconds",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": float(sf) if sf.replace(".", "", 1).isdigit() else sf,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
