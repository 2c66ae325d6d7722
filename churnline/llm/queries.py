"""Registered corpus queries and, where SQL can say the same, their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from churnline.llm.context_tree import op2_context_tree
from churnline.llm.decontamination import op10_decontamination
from churnline.llm.licenses import op5_licenses
from churnline.llm.lines import OP13_SQL, op13_line_dedup
from churnline.llm.merkle import op12_merkle, op12_sql
from churnline.llm.packing import op8_packing
from churnline.llm.phrases import OP11_SQL, op11_phrases
from churnline.llm.quality import op9_quality
from churnline.llm.sharding import op1_sharding
from churnline.llm.simhash import op7_simhash
from churnline.llm.tokens import op4_token_counts
from churnline.llm.toxicity import op3_toxicity
from churnline.llm.url_filters import op6_url_filters


def registered() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_sharding": op1_sharding,
        "op2_context_tree": op2_context_tree,
        "op3_toxicity": op3_toxicity,
        "op4_token_counts": op4_token_counts,
        "op5_licenses": op5_licenses,
        "op6_url_filters": op6_url_filters,
        "op7_simhash": op7_simhash,
        "op8_packing": op8_packing,
        "op9_quality": op9_quality,
        "op10_decontamination": op10_decontamination,
        "op11_phrases": op11_phrases,
        "op12_merkle": op12_merkle,
        "op13_line_dedup": op13_line_dedup,
    }


def oracle_sql() -> dict[str, str]:
    return {"op11_phrases": OP11_SQL, "op12_merkle": op12_sql(), "op13_line_dedup": OP13_SQL}
