"""SQL-registered functions agree with the DataFrame functions."""

from pyspark.sql import functions as F

from tokenmill.functions.sql import register_sql_functions
from tokenmill.functions.text import fingerprint, normalize_ws, pretokens, strip_ws
from tokenmill.operators import bpe as B
from tokenmill.operators import codec as X
from tokenmill.sources.tables import read_documents
from conftest import SF_SMALL


def test_sql_functions_match_dataframe_api(spark):
    model = B.BpeModel(merges=[(32, 116), (104, 101), (256, 257)], vocab_size=260, eot_id=259)
    names = register_sql_functions(spark, model)
    assert "tm_bpe_encode" in names
    docs = read_documents(spark, SF_SMALL)
    docs.createOrReplaceTempView("tm_docs")
    got = spark.sql(
        "SELECT doc_id, tm_strip(text) s, tm_normalize(text) n, tm_fingerprint(text) f, tm_pretokens(text) p, "
        "tm_bpe_encode(text) e, tm_bpe_decode(tm_bpe_encode(text)) d FROM tm_docs"
    )
    want = X.encode_documents(docs, model).select(
        "doc_id", strip_ws("text").alias("s"), normalize_ws("text").alias("n"), fingerprint("text").alias("f"),
        pretokens(F.col("text")).alias("p"), F.col("ids").alias("e"), F.col("text").alias("d"),
    )
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
