"""The registered queries: contract columns, whole tables, and SQL where there is some."""

import pytest
from compare import connect, duck_rows, spark_rows

import __spark_entry__ as contract
from adlake.llm.oracles import ORACLES
from adlake.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
COLUMNS = {
    "op1_multi_index": "vec_id n_links component_id kept",
    "op2_rendezvous_sharding": "doc_id size text_crc32 law shard slot grown_shard",
    "op3_pattern_packing": "doc_id piece start length ids_crc32 sequence_id offset",
    "op4_pii": "doc_id n_email n_ip n_card n_phone base_sha256 spans",
    "op5_chat_formatting": "conv_id n_turns turns_sha256 loss_chars loss_sha256 formatted_chars",
    "op6_exact_dedup": "doc_id keep_id group_size kept text_sha256",
    "op7_minhash": "doc_id class_id kept",
    "op8_quality": "doc_id accepted",
    "op9_byte_bpe": "doc_id n_tokens ids_sha256 decoded_sha256",
    "op10_language_id": "doc_id held_out lang_pred score",
    "op11_member_lloyd": "vec_id code error label_error codebooks_sha256",
    "op12_pair_maxscore": "item_id rank doc_id score",
    "op13_direct_codes": "doc_id start n_tokens ids_crc32",
    "page_quality": "page_id host_rate path_rate quality accepted",
}
#: Table whose ids the result holds, where that is not all documents.
TABLES = {"vec_id": "embeddings", "conv_id": "conversations", "page_id": "pages", "item_id": "benchmark"}


def test_all_are_registered():
    assert set(QUERIES) == set(COLUMNS)
    assert set(QUERIES) | {"pipeline"} <= set(contract.queries())
    assert set(ORACLES) <= set(contract.oracle_sql())


@pytest.mark.parametrize("name", QUERIES)
def test_query(spark, name):
    result = QUERIES[name](spark, SF)
    assert set(COLUMNS[name].split()) <= set(result.columns)
    plan = result._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan
    if name in ("op2_rendezvous_sharding", "op5_chat_formatting", "op6_exact_dedup"):
        assert "Python" not in plan and "Arrow" not in plan
    rows = result.collect()
    key = result.columns[0]
    table = TABLES.get(key, "documents")
    want = {r[0] for r in spark.read.parquet(f"{SF}/{table}.parquet").select(key).collect()}
    assert {r[key] for r in rows} == want | ({-1} if key == "conv_id" else set())
    if name in ORACLES:
        assert spark_rows(result) == duck_rows(connect(SF), ORACLES[name])
