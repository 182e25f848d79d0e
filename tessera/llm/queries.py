"""Registered queries of the training-data operators, and their DuckDB SQL where SQL can express them."""

from __future__ import annotations

from tessera.llm.chat import op1_chat_fingerprints
from tessera.llm.chat import oracle_sql as chat_sql
from tessera.llm.debruijn import op3_debruijn
from tessera.llm.divergence import op13_divergence_audit
from tessera.llm.divergence import oracle_sql as divergence_sql
from tessera.llm.feistel import op10_feistel_shards
from tessera.llm.heapmeans import op11_heap_bounds
from tessera.llm.heapmeans import oracle_sql as heapmeans_sql
from tessera.llm.langbits import op12_language_bits
from tessera.llm.linedrop import op7_cuckoo_lines
from tessera.llm.mcd import op4_mcd_outliers
from tessera.llm.oddsketch import op5_odd_sketch
from tessera.llm.oracles import op2_sql, op3_sql, op5_sql, op7_sql, op10_sql
from tessera.llm.raking import op8_raking
from tessera.llm.raking import oracle_sql as raking_sql
from tessera.llm.template import op6_page_templates
from tessera.llm.urltree import op9_path_templates
from tessera.llm.urltree import oracle_sql as urltree_sql
from tessera.llm.wumanber import op2_wu_manber

QUERIES = {
    "op1_chat_fingerprints": op1_chat_fingerprints,
    "op2_wu_manber": op2_wu_manber,
    "op3_debruijn": op3_debruijn,
    "op4_mcd_outliers": op4_mcd_outliers,
    "op5_odd_sketch": op5_odd_sketch,
    "op6_page_templates": op6_page_templates,
    "op7_cuckoo_lines": op7_cuckoo_lines,
    "op8_raking": op8_raking,
    "op9_path_templates": op9_path_templates,
    "op10_feistel_shards": op10_feistel_shards,
    "op11_heap_bounds": op11_heap_bounds,
    "op12_language_bits": op12_language_bits,
    "op13_divergence_audit": op13_divergence_audit,
}

ORACLE: dict[str, str] = {
    "op1_chat_fingerprints": chat_sql(),
    "op2_wu_manber": op2_sql(),
    "op3_debruijn": op3_sql(),
    "op5_odd_sketch": op5_sql(),
    "op7_cuckoo_lines": op7_sql(),
    "op8_raking": raking_sql(),
    "op9_path_templates": urltree_sql(),
    "op10_feistel_shards": op10_sql(),
    "op11_heap_bounds": heapmeans_sql(),
    "op13_divergence_audit": divergence_sql(),
}
