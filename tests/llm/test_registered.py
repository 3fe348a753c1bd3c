"""Every operator has one query, the SQL that exists agrees with it, and results have their fixed columns."""

import pytest

from oracle_check import compare, duck
from tillstar.llm import registry

from samples import SF_SMALL

COLUMNS = {
    "op1": {"doc_id": "bigint", "held_out": "boolean", "score": "double", "predicted": "int"},
    "op2": {"doc_id": "bigint", "held_out": "boolean", "score": "double", "predicted": "int"},
    "op3": {"doc_id": "bigint", "n_words": "bigint", "word_chars": "bigint", "n_symbols": "bigint", "n_dup_lines": "bigint",
            "n_repeat_words": "bigint", "base_failed": "boolean", "kept": "boolean"},
    "op4": {"doc_id": "bigint", "n_tokens": "bigint", "ids_sha256": "string", "decoded_sha256": "string"},
    "op5": {"doc_id": "bigint", "held_out": "boolean", "lang_pred": "string", "score": "double"},
    "op6": {"doc_id": "bigint", "start": "bigint", "n_tokens": "bigint", "ids_crc32": "bigint"},
    "op8": {"doc_id": "bigint", "n_chars": "bigint", "edited_sha256": "string", "fingerprint": "string", "edited_fingerprint": "string",
            "near_edited": "double", "near_next": "double"},
    "op10": {"doc_id": "bigint", "n_shingles": "bigint", "component_id": "bigint"},
    "op11": {"doc_id": "bigint", "n_a": "bigint", "n_b": "bigint", "n_groups": "bigint", "n_links": "bigint", "n_best": "bigint",
             "count_sum": "bigint", "groups_sha256": "string"},
    "op13": {"page_id": "bigint", "payload_bytes": "bigint", "payload_digest": "string", "record_type": "string", "refers_to": "bigint"},
}


def test_one_query_for_each_operator():
    names = [n.split("_")[0] for n in registry.queries()]
    assert names == [f"op{k}" for k in range(1, 14)] + ["pipeline"]


@pytest.mark.parametrize("name", [n for n in registry.queries() if n.split("_")[0] in COLUMNS])
def test_columns(spark, name):
    found = dict(registry.queries()[name](spark, SF_SMALL).dtypes)
    assert COLUMNS[name.split("_")[0]].items() <= found.items()


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_sql(spark, name):
    r = compare(spark, duck(SF_SMALL), name, SF_SMALL, registry.queries()[name], registry.oracle_sql()[name])
    assert r["ok"] and (r["spark_rows"] == 200 or name.startswith(("op12", "op13"))), r
