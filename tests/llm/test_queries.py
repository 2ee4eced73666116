"""Registered queries against their SQL, and all of them for the columns that their contracts name."""

import pytest

from histora.llm.oracles import ORACLES
from histora.llm.queries import QUERIES
from tests.compare import difference, duck

CONTRACTS = {
    "op1_best_fit_packing": "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint, sequence_id bigint, offset bigint",
    "op3_minhash_neardup": "doc_id bigint, n_shingles bigint, component_id bigint, kept boolean",
    "op4_factorisation_quality": "doc_id bigint, held_out boolean, score double, predicted int",
    "op5_hnsw_neighbours": "query_id bigint, rank int, vec_id bigint, score double",
    "op7_kneser_ney_toxicity": "doc_id bigint, held_out boolean, score double, predicted int",
    "op9_minimax_sharding": "doc_id bigint, size bigint, text_crc32 bigint, law string, shard int, slot bigint, grown_shard int",
    "op10_maxent_scoring": "doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double",
    "op11_cross_tokenizer_alignment": "doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, n_best bigint, "
    "count_sum bigint, groups_sha256 string",
    "op12_lanczos_whitening": "vec_id bigint, component int, n bigint, deviation bigint, whitened double, explained double, identity_error double",
    "op13_html_text_density": "page_id bigint, url string, text string, n_chars bigint",
}


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_gives_the_rows_of_its_sql(spark, folder, name):
    assert difference(duck(folder), QUERIES[name](spark, folder), ORACLES[name]) is None


@pytest.mark.parametrize("name", sorted(CONTRACTS))
def test_columns(spark, folder, name):
    found = QUERIES[name](spark, folder)
    assert ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in found.schema) == CONTRACTS[name]


def test_one_query_for_each_operator():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))
