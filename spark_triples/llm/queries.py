"""The queries of this subpackage and their SQL, for the driver's contract."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame

from spark_triples.llm.decontamination import op9_spaced_seeds
from spark_triples.llm.fingerprints import OP13_SQL, op13_winnowing
from spark_triples.llm.html_text import op4_wrapper_text
from spark_triples.llm.lexical_search import OP12_SQL, op12_ball_tree_search
from spark_triples.llm.near_dedup import op3_signature_join
from spark_triples.llm.packing import op2_curve_packing
from spark_triples.llm.pii import op1_contextual_pii
from spark_triples.llm.quality import op5_host_rules
from spark_triples.llm.resampling import OP11_SQL, op11_importance_resampling
from spark_triples.llm.secrets import op7_zstd_novelty
from spark_triples.llm.tool_calls import OP6_SQL, op6_tool_calls
from spark_triples.llm.toxicity import op8_ftrl_toxicity
from spark_triples.llm.url_filter import OP10_SQL, op10_temporal_lists

QUERIES: dict[str, Callable[..., DataFrame]] = {
    "op1_contextual_pii": op1_contextual_pii,
    "op2_curve_packing": op2_curve_packing,
    "op3_signature_join": op3_signature_join,
    "op4_wrapper_text": op4_wrapper_text,
    "op5_host_rules": op5_host_rules,
    "op6_tool_calls": op6_tool_calls,
    "op7_zstd_novelty": op7_zstd_novelty,
    "op8_ftrl_toxicity": op8_ftrl_toxicity,
    "op9_spaced_seeds": op9_spaced_seeds,
    "op10_temporal_lists": op10_temporal_lists,
    "op11_importance_resampling": op11_importance_resampling,
    "op12_ball_tree_search": op12_ball_tree_search,
    "op13_winnowing": op13_winnowing,
}

ORACLES: dict[str, str] = {
    "op6_tool_calls": OP6_SQL,
    "op10_temporal_lists": OP10_SQL,
    "op11_importance_resampling": OP11_SQL,
    "op12_ball_tree_search": OP12_SQL,
    "op13_winnowing": OP13_SQL,
}
