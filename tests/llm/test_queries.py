"""The registered queries and the pipeline on the smallest tables."""

import corpus_pipeline
import pytest
from retention.llm import queries

COLUMNS = {
    "op1_byte_bpe": ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
    "op2_lm_scores": ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"],
    "op3_quality": ["doc_id", "held_out", "score", "predicted"],
    "op4_personal_data": ["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans"],
    "op5_licenses": ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"],
    "op6_exact_dedup": ["doc_id", "keep_id", "group_size", "kept", "text_sha256"],
    "op7_simhash": ["doc_id", "fingerprint", "component_id"],
    "op8_decontamination": ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"],
    "op9_line_dedup": ["doc_id", "n_lines", "n_removed", "text"],
    "op10_token_counts": ["doc_id", "n_bytes", "n_tokens", "over_limit"],
    "op11_secret_scan": ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"],
    "op13_alignment": ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"],
}


@pytest.mark.parametrize("name", sorted(COLUMNS))
def test_one_row_per_document(spark, sf_dir, name):
    got = queries.queries()[name](spark, sf_dir)
    assert got.columns[: len(COLUMNS[name])] == COLUMNS[name]
    ids = [r["doc_id"] for r in got.select("doc_id").collect()]
    want = [r["doc_id"] for r in queries.table(spark, sf_dir, "documents").select("doc_id").collect()]
    assert sorted(ids) == sorted(want)


def test_pipeline_stage_by_stage(spark, sf_dir):
    docs = queries.table(spark, sf_dir, "documents")
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = {r["doc_id"]: r for r in docs.collect()}
        after = stage(spark, docs, sf_dir)
        assert after.columns == columns
        docs = corpus_pipeline.written(after, name)
        rows = docs.collect()
        assert len({r["doc_id"] for r in rows}) == len(rows) and {r["doc_id"] for r in rows} <= set(before)
        if name != "line_dedup":
            assert all(r == before[r["doc_id"]] for r in rows)
        else:
            assert len(rows) == len(before)
    last = corpus_pipeline.STAGES[-1][1](spark, docs, sf_dir).collect()
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    assert {r["doc_id"]: bytes(r["decoded"]).decode() for r in last} == {i: t or "" for i, t in texts.items()}
    whole = corpus_pipeline.run(spark, sf_dir).collect()
    assert sorted(r["doc_id"] for r in whole) == sorted(texts)
