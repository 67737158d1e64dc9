from collections import Counter

from llm_cases import SF_SMALL, edge_docs  # noqa: F401
from test_decontamination import brute as contaminated
from test_ngram_join import brute as components
from test_sharding import check_shards

import __spark_entry__ as E
import corpus_pipeline as P
from tokenmill.llm.mixing import mix_sources
from tokenmill.llm.toxicity import score_toxicity
from tokenmill.session import materialize


def rows(df):
    return Counter((r.doc_id, r.text, r.source) for r in df.collect())


def test_stages_on_their_own_input(spark):
    """Each stage against its operator's decisions or a brute-force version, on what its predecessor kept."""
    read = (lambda name: spark.read.parquet(f"{SF_SMALL}/{name}.parquet"))
    docs = read("documents")
    columns = docs.columns
    stages = dict(P.STAGES)
    assert list(stages) == ["toxicity", "ngram_jaccard", "benchmark_decontamination", "source_mixing", "sharding"]

    clean = materialize(stages["toxicity"](spark, docs, SF_SMALL))
    rejected = {r.doc_id for r in score_toxicity(docs, read("labels")).filter("predicted = 1").collect()}
    assert rejected and rows(clean) == Counter({k: v for k, v in rows(docs).items() if k[0] not in rejected})

    unique = materialize(stages["ngram_jaccard"](spark, clean, SF_SMALL))
    keep = {d for d, _, c in components([(r.doc_id, r.text) for r in clean.collect()]) if d == c}
    assert rows(unique) == Counter({k: v for k, v in rows(clean).items() if k[0] in keep})

    kept = materialize(stages["benchmark_decontamination"](spark, unique, SF_SMALL))
    bench = [(r.item_id, r.text) for r in read("benchmark").collect()]
    bad = {d for d, *_, c in contaminated([(r.doc_id, r.text) for r in unique.collect()], bench) if c}
    assert bad and rows(kept) == Counter({k: v for k, v in rows(unique).items() if k[0] not in bad})

    mixed = materialize(stages["source_mixing"](spark, kept, SF_SMALL))
    copies = {r.doc_id: r.copies for r in mix_sources(kept).collect()}
    assert rows(mixed) == Counter({k: copies[k[0]] for k in rows(kept) if copies[k[0]]})
    for df in (clean, unique, kept, mixed):
        assert df.columns == columns

    shards = stages["sharding"](spark, mixed, SF_SMALL)
    check_shards(shards.collect(), 24, max(r.size for r in shards.collect()))
    assert rows(shards) == rows(mixed)

    whole = E.queries()["pipeline"](spark, SF_SMALL)
    assert rows(whole) == rows(shards)


def test_stages_accept_empty_tables(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").filter("doc_id < 0")
    for _, stage in P.STAGES:
        docs = materialize(stage(spark, docs, SF_SMALL))
        assert docs.count() == 0
