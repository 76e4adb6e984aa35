"""Registered queries of the training-data operators and their DuckDB SQL.

An operator without SQL here cannot be expressed in it (a tokenizer, a learnt model, a
sketch, DOM trees, archives) and is tested against brute force in ``tests/llm``.
"""

from __future__ import annotations

from riskmart.llm.bpe import op6_bpe_round_trip
from riskmart.llm.embedding_dedup import OP1_SQL, op1_embedding_near_dedup
from riskmart.llm.hnsw import op12_nearest_neighbours
from riskmart.llm.html_extract import op3_html_extraction
from riskmart.llm.jaccard_join import op4_ngram_jaccard_join
from riskmart.llm.mixing import OP5_SQL, op5_mix_sources
from riskmart.llm.order_minhash import op7_fingerprints
from riskmart.llm.quality import op8_quality_classifier
from riskmart.llm.secrets_scan import op9_secret_scan
from riskmart.llm.token_counts import op2_token_counts
from riskmart.llm.vector_codes import OP13_SQL, op13_vector_codes
from riskmart.llm.warc import OP10_SQL, op10_warc_round_trip
from riskmart.llm.whitening import op11_embedding_whitening

QUERIES = {
    "op1_embedding_near_dedup": op1_embedding_near_dedup,
    "op2_token_counts": op2_token_counts,
    "op3_html_extraction": op3_html_extraction,
    "op4_ngram_jaccard_join": op4_ngram_jaccard_join,
    "op5_mix_sources": op5_mix_sources,
    "op6_bpe_round_trip": op6_bpe_round_trip,
    "op7_fingerprints": op7_fingerprints,
    "op8_quality_classifier": op8_quality_classifier,
    "op9_secret_scan": op9_secret_scan,
    "op10_warc_round_trip": op10_warc_round_trip,
    "op11_embedding_whitening": op11_embedding_whitening,
    "op12_nearest_neighbours": op12_nearest_neighbours,
    "op13_vector_codes": op13_vector_codes,
}

ORACLE_SQL: dict[str, str] = {
    "op1_embedding_near_dedup": OP1_SQL,
    "op5_mix_sources": OP5_SQL,
    "op10_warc_round_trip": OP10_SQL,
    "op13_vector_codes": OP13_SQL,
}
