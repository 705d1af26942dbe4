"""Queries of the corpus operators and, where SQL can express them, their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from loanlake.llm import decontaminate, merkle, quality_rules, ranked_search, warc
from loanlake.llm.decontaminate import op6_decontaminate
from loanlake.llm.language import op13_language
from loanlake.llm.line_dedup import op1_line_dedup
from loanlake.llm.merkle import op12_merkle
from loanlake.llm.packing import op8_packing
from loanlake.llm.quality_rules import op10_quality_rules
from loanlake.llm.ranked_search import op11_ranked_search
from loanlake.llm.sharding import op2_sharding
from loanlake.llm.simhash import op5_simhash
from loanlake.llm.token_counts import op7_token_counts
from loanlake.llm.toxicity import op4_toxicity
from loanlake.llm.url_filters import op3_url_filters
from loanlake.llm.warc import op9_warc

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_line_dedup": op1_line_dedup,
    "op2_sharding": op2_sharding,
    "op3_url_filters": op3_url_filters,
    "op4_toxicity": op4_toxicity,
    "op5_simhash": op5_simhash,
    "op6_decontaminate": op6_decontaminate,
    "op7_token_counts": op7_token_counts,
    "op8_packing": op8_packing,
    "op9_warc": op9_warc,
    "op10_quality_rules": op10_quality_rules,
    "op11_ranked_search": op11_ranked_search,
    "op12_merkle": op12_merkle,
    "op13_language": op13_language,
}

ORACLES: dict[str, str] = {
    "op6_decontaminate": decontaminate.ORACLE,
    "op9_warc": warc.ORACLE,
    "op10_quality_rules": quality_rules.ORACLE,
    "op11_ranked_search": ranked_search.ORACLE,
    "op12_merkle": merkle.oracle(),
}
