"""The queries of this package, by name, and their SQL."""

from __future__ import annotations

from . import decontaminate, fingerprint, licenses, linededup, mixing, neardup, records, secrets, toxicity, urlfilter

QUERIES = {
    "op1_benchmark_decontamination": decontaminate.op1,
    "op2_toxicity": toxicity.op2,
    "op3_line_dedup": linededup.op3,
    "op4_url_filters": urlfilter.op4,
    "op5_document_fingerprints": fingerprint.op5,
    "op6_secret_scans": secrets.op6,
    "op7_license_scans": licenses.op7,
    "op8_token_id_binary_output": records.op8,
    "op9_mixing_sources": mixing.op9,
    "op10_ngram_jaccard_join": neardup.op10,
}
ORACLE_SQL = {
    "op1_benchmark_decontamination": decontaminate.OP1_SQL,
    "op3_line_dedup": linededup.OP3_SQL,
    "op10_ngram_jaccard_join": neardup.OP10_SQL,
}
