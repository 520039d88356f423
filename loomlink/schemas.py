"""Table layouts and fixed column orders."""

from __future__ import annotations

from pyspark.sql import types as T

_text = T.StringType()
RAW = T.StructType([T.StructField(c, _text) for c in ("entity_id", "business_name", "business_address", "country")])
TRUTH_LISTS = T.StructType([T.StructField(c, _text) for c in ("source1_entity_id", "matched_entity_ids")])
SCORED_PAIRS = T.StructType([T.StructField(c, _text) for c in ("source1_entity_id", "candidate_entity_id", "score")])
NORMALIZED = ["entity_id", "name_norm", "legal_suffix", "address_norm", "country"]
REF, CAND = "source1_entity_id", "candidate_entity_id"
PAIR = [REF, CAND]
#: The feature contract, in order.
SIMILARITIES = [
    "name_jaro_winkler", "name_token_sort", "name_tfidf_cosine", "name_idf_overlap",
    "address_jaro_winkler", "address_token_sort", "address_tfidf_cosine", "address_idf_overlap",
]
MISSING = ["source1_name_missing", "source1_address_missing", "candidate_name_missing", "candidate_address_missing"]
FEATURES = SIMILARITIES + MISSING
RETRIEVAL = ["blocking_score", "candidate_rank", "blocking_top1_top2_gap"]
SCORED_FEATURES = FEATURES + RETRIEVAL
FEATURE_VERSION = "scored-baseline-v2"
