"""The queries of this folder with their SQL where SQL can express them."""

from __future__ import annotations

from . import bpe, decontaminate, jaccard_join, jaccard_sql, license_scan, line_dedup, lm_scoring, merkle, merkle_sql, mixing, prefix_trie, prefix_trie_sql, quality_rules, secret_scan, token_files, warc
from .common import ship


def _shipped(query):
    def run(spark, sf_dir):
        ship(spark)
        return query(spark, sf_dir)

    return run


_ALL = {
    "op12_mixing": mixing.op12_mixing,
    "op13_merkle": merkle.op13_merkle,
    "op11_prefix_trie": prefix_trie.op11_prefix_trie,
    "op3_license_scan": license_scan.op3_license_scan,
    "op8_lm_scoring": lm_scoring.op8_lm_scoring,
    "op5_decontamination": decontaminate.op5_decontamination,
    "op10_line_dedup": line_dedup.op10_line_dedup,
    "op2_jaccard_join": jaccard_join.op2_jaccard_join,
    "op9_token_files": token_files.op9_token_files,
    "op4_byte_bpe": bpe.op4_byte_bpe,
    "op7_warc": warc.op7_warc,
    "op1_secret_scan": secret_scan.op1_secret_scan,
    "op6_quality_rules": quality_rules.op6_quality_rules,
}

QUERIES = {name: _shipped(query) for name, query in _ALL.items()}

ORACLES = {
    "op13_merkle": merkle_sql.ORACLE_SQL,
    "op11_prefix_trie": prefix_trie_sql.ORACLE_SQL,
    "op2_jaccard_join": jaccard_sql.ORACLE_SQL,
    "op7_warc": warc.ORACLE_SQL,
    "op6_quality_rules": quality_rules.ORACLE_SQL,
}
