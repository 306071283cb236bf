"""The registered queries of this package and their SQL."""

from __future__ import annotations

from tidemark.llm import (
    clustering,
    decontaminate,
    fim,
    jaccard_join,
    license_scan,
    line_dedup,
    minhash,
    mixing,
    quality_lm,
    quality_rules,
    repeats,
    secret_scan,
    url_filter,
)

QUERIES = {
    "op1_jaccard_join": jaccard_join.op1_jaccard_join,
    "op2_secret_scan": secret_scan.op2_secret_scan,
    "op3_license_scan": license_scan.op3_license_scan,
    "op4_mix_sources": mixing.op4_mix_sources,
    "op5_line_dedup": line_dedup.op5_line_dedup,
    "op6_quality_rules": quality_rules.op6_quality_rules,
    "op7_quality_classifier": quality_lm.op7_quality_classifier,
    "op8_url_filter": url_filter.op8_url_filter,
    "op9_decontaminate": decontaminate.op9_decontaminate,
    "op10_repeated_strings": repeats.op10_repeated_strings,
    "op11_fill_in_middle": fim.op11_fill_in_middle,
    "op12_centroid_clustering": clustering.op12_centroid_clustering,
    "op13_minhash_dedup": minhash.op13_minhash_dedup,
}
SQL = {
    "op4_mix_sources": mixing.SQL,
    "op6_quality_rules": quality_rules.SQL,
    "op8_url_filter": url_filter.SQL,
    "op9_decontaminate": decontaminate.SQL,
    "op11_fill_in_middle": fim.SQL,
    "op12_centroid_clustering": clustering.SQL,
}
