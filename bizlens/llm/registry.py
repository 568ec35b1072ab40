"""The queries of this subpackage, and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from bizlens.llm.bpe import op9_byte_bpe
from bizlens.llm.chat import OP3_SQL, op3_perspectives
from bizlens.llm.collocations import OP13_SQL, op13_collocations
from bizlens.llm.ctph import op7_fingerprints
from bizlens.llm.itq import op8_embedding_duplicates
from bizlens.llm.jaccard import op2_jaccard
from bizlens.llm.langid import op10_language
from bizlens.llm.packing import op1_packing
from bizlens.llm.pii import op5_pseudonyms
from bizlens.llm.ppm import op6_ppm_scores
from bizlens.llm.repair import op11_repair
from bizlens.llm.repeats import op12_repeats
from bizlens.llm.secret_scan import op4_secrets

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_packing": op1_packing,
    "op2_jaccard": op2_jaccard,
    "op3_perspectives": op3_perspectives,
    "op4_secrets": op4_secrets,
    "op5_pseudonyms": op5_pseudonyms,
    "op6_ppm_scores": op6_ppm_scores,
    "op7_fingerprints": op7_fingerprints,
    "op8_embedding_duplicates": op8_embedding_duplicates,
    "op9_byte_bpe": op9_byte_bpe,
    "op10_language": op10_language,
    "op11_repair": op11_repair,
    "op12_repeats": op12_repeats,
    "op13_collocations": op13_collocations,
}

ORACLES: dict[str, str] = {"op3_perspectives": OP3_SQL, "op13_collocations": OP13_SQL}
