"""A query's tags name operators that it really runs."""

import sys
import threading

import pytest
from paths import SF_SMALL

from logweave.plans import load_all

REGISTRY = load_all()

#: Functions that make up an operator; reaching one of them is running it.
FUNCTIONS = {
    "S1": ["read_lines"], "S2": ["read_libsvm"], "S3": ["read_documents"], "S5": ["write_partitioned"], "S6": ["load_model"], "S7": ["load_table"], "P1": ["parse_labeled"], "P2": ["parse_dense"], "P3": ["parse_edges"], "P4": ["parse_category_text"],
    "P5": ["split_fields"], "P6": ["parse_observations_tsv"], "P7": ["parse_log_observations"], "P8": ["json_fields"], "P9": ["parse_log"],
    "P10": ["key_by_group"], "P11": ["parse_metrics"], "P12": ["label_by_threshold"], "P13": ["clamp_non_negative"],
    "P14": ["basket_from_fields"], "P15": ["validate_basket"], "P16": ["claim_columns"], "P17": ["split_tokens"], "P18": ["tokenize"],
    "P19": ["with_positions"], "P20": ["densify"], "F1": ["drop_unparsed"], "F2": ["drop_unparsed"], "F3": ["drop_unparsed"],
    "F4": ["filter_contains_any"], "F5": ["parse_metrics"], "F6": ["term_scores"], "F7": ["accuracy"], "J1": ["encode_ordinal"],
    "J2": ["with_user_name"], "J4": ["idf_apply"], "J5": ["subtract_rows"], "A1": ["usage_by_user"], "A2": ["mse"],
    "A3": ["accuracy", "error_rate"], "A4": ["kfold_aggregate"], "A5": ["extremes"], "A6": ["count_series"], "A8": ["category_dictionary"],
    "W1": ["with_row_id"], "T1": ["datetime_index", "align", "align_series"], "T2": ["align", "align_series"], "T3": ["fill"], "T4": ["return_rates"], "T5": ["durbin_watson"],
    "T6": ["extremes"], "O1": ["rank_rules"], "O2": ["usage_by_user"], "O3": ["top_k"], "D1": ["term_scores"], "D2": ["distinct_points"],
    "X1": ["split_index"], "X2": ["sample"], "X3": ["fold_column"], "V1": ["hashed_term_freq", "hashing_tf"], "V2": ["term_freq"],
    "V3": ["idf_fit"], "V4": ["idf_fit"], "V5": ["hash_slot"], "V6": ["encode_ordinal"], "V7": ["encode_one_hot"], "V8": ["combine_features"], "V9": ["text_pipeline"],
    "B1": ["frequent_itemsets", "association_rules"], "B2": ["association_rules"], "B3": ["rules_from_itemsets"], "B4": ["frequent_sequences"],
    "B5": ["mine_tenant_logs"], "B6": ["mine_cluster"], "C1": ["kmeans", "range_start"], "C2": ["assign", "assign_nearest"], "C3": ["kmeans_cost"],
    "C4": ["gaussian_mixture"], "C5": ["lda_topics"], "C6": ["graph_clusters"], "C7": ["cluster_logs"], "C8": ["cluster_and_mine"],
    "C9": ["cluster_text_logs"], "L1": ["linear_fit", "linear_sgd"], "L2": ["linear_svm"], "L3": ["logistic"],
    "L4": ["naive_bayes", "nb_fit_terms"], "L5": ["gbt"], "L6": ["newton_boost"], "L7": ["newton_boost"], "L8": ["margin_metrics"],
    "L9": ["decision_tree"], "L10": ["metric_classifier"], "L11": ["classify_metrics"], "L12": ["classify_clicks"], "L13": ["classify_text"],
    "E1": ["mse"], "E2": ["accuracy"], "E3": ["au_roc"], "E4": ["multiclass_precision", "confusion"], "E5": ["q_gbt"], "E6": ["margin_error_rate"],
}
#: Their query is too slow to run twice; the oracle test runs it.
SLOW = {"classify_metrics", "classify_clicks", "lda"}


@pytest.mark.parametrize("name", sorted(set(REGISTRY) - SLOW))
def test_tags_are_reached(spark, name):
    reached = set()

    def watch(frame, event, _):
        if event == "call" and "logweave" in frame.f_code.co_filename:
            reached.add(frame.f_code.co_name)
    threading.setprofile(watch)
    sys.setprofile(watch)
    try:
        REGISTRY[name].fn(spark, SF_SMALL)
    finally:
        sys.setprofile(None)
        threading.setprofile(None)
    missing = [op for op in REGISTRY[name].ops if not reached & set(FUNCTIONS[op])]
    assert not missing, (missing, sorted(reached))
