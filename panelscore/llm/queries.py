"""The queries of this package by name, and the SQL of those that SQL can express."""
from __future__ import annotations

from . import alignment, centroids, cgk, cws, lbl, mixing, ordinal, simhash, subwords, token_counts, url_filter, warc, whitening

QUERIES = {
    "op1_toxicity": ordinal.query,
    "op2_warc": warc.query,
    "op3_decontamination": cgk.query,
    "op4_lm_scoring": lbl.query,
    "op5_language_id": centroids.query,
    "op6_fingerprints": cws.query,
    "op7_url_filters": url_filter.query,
    "op8_quality": subwords.query,
    "op9_simhash": simhash.query,
    "op10_mixing": mixing.query,
    "op11_whitening": whitening.query,
    "op12_alignment": alignment.query,
    "op13_token_counts": token_counts.query,
}
ORACLE = {
    "op2_warc": warc.ORACLE,
    "op7_url_filters": url_filter.ORACLE,
}
