"""Queries of the training-data operators, and SQL twins where SQL has them."""

from __future__ import annotations

from . import conversation_repair, html_blocks, language_id, licenses, minmax_dedup, packing, positional_index, quality_rules, quotes, sharding, spelling_variants, vector_packing, warc

QUERIES = {f.__name__: f for f in (
    warc.op1_warc,
    quality_rules.op2_quality_rules,
    quotes.op3_quotation_linking,
    positional_index.op4_decontamination,
    html_blocks.op5_html_extraction,
    sharding.op6_sharding,
    language_id.op7_language_id,
    licenses.op8_license_scan,
    packing.op9_best_fit_packing,
    minmax_dedup.op10_minmax_dedup,
    conversation_repair.op11_conversation_repair,
    vector_packing.op12_vector_packing,
    spelling_variants.op13_spelling_variants,
)}
ORACLE = {
    "op1_warc": warc.SQL,
    "op3_quotation_linking": quotes.SQL,
    "op4_decontamination": positional_index.SQL,
    "op10_minmax_dedup": minmax_dedup.SQL,
    "op11_conversation_repair": conversation_repair.SQL,
    "op13_spelling_variants": spelling_variants.SQL,
}
