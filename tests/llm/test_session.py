"""The training-text operators leave the session of their user alone."""

from lakesteps.llm import bpe, mixing, order_minhash, secret_scan, token_counts


def test_no_operator_changes_the_session(spark):
    before = {r[0]: r[1] for r in spark.sql("SET").collect()}
    docs = spark.createDataFrame([(1, "some words here", "en", "s", 15), (2, None, None, None, None)],
                                 "doc_id long, text string, lang string, source string, n_chars long")
    for run in (bpe.encoded_digests, order_minhash.near_duplicates, mixing.mix_documents,
                secret_scan.find_secrets, token_counts.count_tokens):
        assert run(docs).count() == 2
    assert {r[0]: r[1] for r in spark.sql("SET").collect()} == before
