"""Queries of this subpackage and their SQL."""

from __future__ import annotations

from . import chaining, chat_format, decontaminate, exact_dedup, licenses, mixing, ngram_join, quality, suffix_dedup, url_filter

QUERIES = {
    "op8_chaining": chaining.op8_chaining,
    "op2_suffix_dedup": suffix_dedup.op2_suffix_dedup,
    "op6_licenses": licenses.op6_licenses,
    "op1_decontaminate": decontaminate.op1_decontaminate,
    "op3_ngram_join": ngram_join.op3_ngram_join,
    "op7_mix": mixing.op7_mix,
    "op10_quality": quality.op10_quality,
    "op4_chat_format": chat_format.op4_chat_format,
    "op5_url_filter": url_filter.op5_url_filter,
    "op9_exact_dedup": exact_dedup.op9_exact_dedup,
    "license_base": licenses.license_base,
}

ORACLES = {
    "op3_ngram_join": ngram_join.OP3_SQL,
    "op4_chat_format": chat_format.OP4_SQL,
    "op5_url_filter": url_filter.OP5_SQL,
    "op9_exact_dedup": exact_dedup.OP9_SQL,
    "license_base": licenses.LICENSE_BASE_SQL,
}
