import pytest

from tilth.llm.queries import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"
COLUMNS = {
    "op1_ngram_trie": {"doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"},
    "op2_suffix_dedup": {"doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"},
    "op4_source_mix": {"doc_id", "size", "source_size", "target", "taken"},
    "op6_line_rules": {"doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"},
    "op7_packing": {"doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"},
    "op8_cap_filters": {"vec_id", "n_links", "component_id", "kept"},
    "op9_language_id": {"doc_id", "held_out", "lang_pred", "score"},
    "op10_simhash": {"doc_id", "fingerprint", "component_id"},
    "op11_bisector_clusters": {"vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"},
    "op12_merkle_manifest": {"doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"},
    "op13_licence_notices": {"doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"},
}


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_covers_its_table(spark, name):
    got = QUERIES[name](spark, SF)
    assert COLUMNS.get(name, set()) <= set(got.columns)
    key, table = ("vec_id", "embeddings") if name.startswith(("op8", "op11")) else ("doc_id", "documents")
    ids = spark.read.parquet(f"{SF}/{table}.parquet").select(key)
    assert got.select(key).distinct().count() == ids.count()


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_sql(spark, name):
    from oracle_check import compare, oracle_connection

    assert compare(spark, oracle_connection(SF), name, QUERIES[name], ORACLES[name], SF) == ""
