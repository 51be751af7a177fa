"""Registered queries of the training-data operators and their SQL twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from claimflow.llm import (ann, exact, lines, lm, minhash, mixing, negatives, packing, phrases, prefs, quality, urls,
                           warc)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_mix_sources": mixing.op1_mix_sources,
    "op2_warc_revisits": warc.op2_warc_revisits,
    "op3_backoff_scores": lm.op3_backoff_scores,
    "op4_exact_dedup": exact.op4_exact_dedup,
    "op5_quality": quality.op5_quality,
    "op6_preference_pairs": prefs.op6_preference_pairs,
    "op7_near_lines": lines.op7_near_lines,
    "op8_nearest_vectors": ann.op8_nearest_vectors,
    "op9_pack_sequences": packing.op9_pack_sequences,
    "op10_near_duplicates": minhash.op10_near_duplicates,
    "op11_url_filter": urls.op11_url_filter,
    "op12_collocations": phrases.op12_collocations,
    "op13_hard_negatives": negatives.op13_hard_negatives,
}

# The others rest on random rounding, trained weights, signatures, an edit join or
# token ids, which SQL cannot express or not at this size; tests hold them against
# brute force.
ORACLE_SQL: dict[str, str] = {
    "op2_warc_revisits": warc.OP2_SQL,
    "op3_backoff_scores": lm.OP3_SQL,
    "op4_exact_dedup": exact.OP4_SQL,
    "op6_preference_pairs": prefs.OP6_SQL,
    "op11_url_filter": urls.OP11_SQL,
    "op12_collocations": phrases.OP12_SQL,
    "op13_hard_negatives": negatives.OP13_SQL,
}
