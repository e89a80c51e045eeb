"""The registered queries of the package and their SQL counterparts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from larder.llm.chat import OP7_SQL, op7_chat
from larder.llm.decontaminate import op9_decontaminate
from larder.llm.exact_dedup import OP1_SQL, op1_exact_dedup
from larder.llm.jaccard import op4_ngram_jaccard
from larder.llm.packing import op6_packing
from larder.llm.pages import op3_html_text
from larder.llm.search import OP11_SQL, op11_search
from larder.llm.secrets import op8_secrets
from larder.llm.shards import op5_sharding
from larder.llm.spans import op10_spans
from larder.llm.token_files import op13_token_files
from larder.llm.toxicity import op2_toxicity
from larder.llm.vector_codes import OP12_SQL, op12_vector_codes


def llm_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_exact_dedup": op1_exact_dedup,
        "op2_toxicity": op2_toxicity,
        "op3_html_text": op3_html_text,
        "op4_ngram_jaccard": op4_ngram_jaccard,
        "op5_sharding": op5_sharding,
        "op6_packing": op6_packing,
        "op7_chat": op7_chat,
        "op8_secrets": op8_secrets,
        "op9_decontaminate": op9_decontaminate,
        "op10_spans": op10_spans,
        "op11_search": op11_search,
        "op12_vector_codes": op12_vector_codes,
        "op13_token_files": op13_token_files,
    }


def llm_oracle_sql() -> dict[str, str]:
    return {"op1_exact_dedup": OP1_SQL, "op7_chat": OP7_SQL, "op11_search": OP11_SQL, "op12_vector_codes": OP12_SQL}
