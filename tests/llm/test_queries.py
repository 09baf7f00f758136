"""Every operator's registered query: its SQL at sf0.001, or its columns and rows."""

import pytest
from oracle_check import compare, duck

import __spark_entry__ as E

SF = "/root/testdata/sf0.001"
COLUMNS = {
    "op1_language_id": ["doc_id", "held_out", "lang_pred", "score"],
    "op3_multi_index": ["query_id", "rank", "vec_id", "score"],
    "op5_simhash_dedup": ["doc_id", "fingerprint", "component_id"],
    "op7_token_counts": ["doc_id", "n_tokens"],
    "op8_substring_dedup": ["doc_id", "other_doc_id"],
    "op9_secret_scan": ["doc_id", "n_assign", "n_access", "n_hex"],
    "op10_sentencepiece": ["doc_id", "ids"],
}
PER_DOCUMENT = [n for n in COLUMNS if n not in ("op3_multi_index", "op8_substring_dedup")]


def test_all_are_registered():
    from newsrisk.llm.queries import ORACLE, QUERIES

    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14)) and "pipeline" in E.queries()
    assert set(QUERIES) == set(COLUMNS) | set(ORACLE)


@pytest.mark.parametrize("name", ["op2_warc_archive", "op4_decontaminate", "op6_line_dedup", "op11_fair_mixing", "op12_vector_codes", "op13_hard_negatives"])
def test_against_sql(spark, name):
    assert compare(spark, duck(SF), name, E.queries()[name], E.oracle_sql()[name], SF)


@pytest.mark.parametrize("name", sorted(COLUMNS))
def test_columns_and_rows(spark, name):
    df = E.queries()[name](spark, SF)
    assert df.columns[: len(COLUMNS[name])] == COLUMNS[name]
    if name in PER_DOCUMENT:
        ids = sorted(r.doc_id for r in df.select("doc_id").collect())
        assert ids == sorted(r.doc_id for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id").collect())
