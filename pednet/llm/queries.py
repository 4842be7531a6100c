"""The operators' queries for __spark_entry__.py: each applies its operator, with production parameters, to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from pednet.llm.collocations import op11_collocations
from pednet.llm.jaccard import op9_jaccard_join
from pednet.llm.language import op5_language
from pednet.llm.lines import op1_line_dedup
from pednet.llm.mixing import op3_mix
from pednet.llm.packing import op6_pack
from pednet.llm.pii import op7_personal_data
from pednet.llm.quality import op8_quality
from pednet.llm.repair import op2_repair_ids
from pednet.llm.substrings import op10_substring_dedup
from pednet.llm.toxicity import op12_toxicity
from pednet.llm.vafile import OP4_SQL, op4_topk
from pednet.llm.whitening import op13_whitening


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_line_dedup": op1_line_dedup,
        "op2_repair_ids": op2_repair_ids,
        "op3_mix": op3_mix,
        "op4_topk": op4_topk,
        "op5_language": op5_language,
        "op6_pack": op6_pack,
        "op7_personal_data": op7_personal_data,
        "op8_quality": op8_quality,
        "op9_jaccard_join": op9_jaccard_join,
        "op10_substring_dedup": op10_substring_dedup,
        "op11_collocations": op11_collocations,
        "op12_toxicity": op12_toxicity,
        "op13_whitening": op13_whitening,
    }


def oracle_sql() -> dict[str, str]:
    return {"op4_topk": OP4_SQL}
