"""Queries of the corpus operators and the SQL that gives the same rows, where SQL can."""

from __future__ import annotations

from bookweave.llm import collocations, decontaminate, exact, jaccard, language, lexical, line_dedup, packing, secrets, sharding, surrogates, transport, warc


def queries():
    return {
        "op1_warc": warc.op1_warc,
        "op2_sharding": sharding.op2_sharding,
        "op3_ngram_jaccard_join": jaccard.op3_ngram_jaccard_join,
        "op4_pii_surrogates": surrogates.op4_pii_surrogates,
        "op5_line_dedup": line_dedup.op5_line_dedup,
        "op6_media_columns": transport.op6_media_columns,
        "op7_benchmark_decontamination": decontaminate.op7_benchmark_decontamination,
        "op8_language_id": language.op8_language_id,
        "op9_best_fit_packing": packing.op9_best_fit_packing,
        "op10_secret_scans": secrets.op10_secret_scans,
        "op11_phrase_collocations": collocations.op11_phrase_collocations,
        "op12_exact_dedup": exact.op12_exact_dedup,
        "op13_lexical_search": lexical.op13_lexical_search,
    }


def oracle_sql():
    return {**warc.ORACLE, **jaccard.ORACLE, **line_dedup.ORACLE, **decontaminate.ORACLE, **secrets.ORACLE, **collocations.ORACLE, **exact.ORACLE, **lexical.ORACLE}
