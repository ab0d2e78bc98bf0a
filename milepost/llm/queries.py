"""Registered queries of the training-data operators and their DuckDB statements."""

from __future__ import annotations

from milepost.llm import (
    bpe_codec, decontaminate, langid, lexical_search, minhash, pii, secret_scan, simhash, substring_fm, suffix_dedup,
    token_count, warc, whitening)

QUERIES = {
    "op1_decontaminate": decontaminate.query,
    "op2_substring_fm": substring_fm.query,
    "op3_simhash": simhash.query,
    "op4_bpe_codec": bpe_codec.query,
    "op5_language_id": langid.query,
    "op6_secret_scan": secret_scan.query,
    "op7_pii_surrogates": pii.query,
    "op8_token_count": token_count.query,
    "op9_suffix_dedup": suffix_dedup.query,
    "op10_minhash": minhash.query,
    "op11_warc": warc.query,
    "op12_whitening": whitening.query,
    "op13_lexical_search": lexical_search.query,
}

SQL = {"op1_decontaminate": decontaminate.SQL, "op11_warc": warc.SQL, "op13_lexical_search": lexical_search.SQL}
