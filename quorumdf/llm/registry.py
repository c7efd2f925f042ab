"""The queries of the corpus operators and their SQL, by name."""

from __future__ import annotations

from . import bpe, exact_dedup, language_id, licenses, lm_scoring, mixing, ngram_join, pii, prefix_trie, quality_cnn, secrets, syncmers, whitening


def queries() -> dict:
    return {
        "op1_ngram_join": ngram_join.op1_ngram_join,
        "op2_bpe": bpe.op2_bpe,
        "op3_licenses": licenses.op3_licenses,
        "op4_pii": pii.op4_pii,
        "op5_mixing": mixing.op5_mixing,
        "op6_exact_dedup": exact_dedup.op6_exact_dedup,
        "op7_fingerprints": syncmers.op7_fingerprints,
        "op8_quality": quality_cnn.op8_quality,
        "op9_lm_scoring": lm_scoring.op9_lm_scoring,
        "op10_language_id": language_id.op10_language_id,
        "op11_secrets": secrets.op11_secrets,
        "op12_whitening": whitening.op12_whitening,
        "op13_prefix_trie": prefix_trie.op13_prefix_trie,
    }


def oracle_sql() -> dict[str, str]:
    return {"op5_mixing": mixing.OP5_SQL, "op6_exact_dedup": exact_dedup.OP6_SQL, "op11_secrets": secrets.OP11_SQL, "op13_prefix_trie": prefix_trie.OP13_SQL}
