"""The corpus operators as queries over the driver's tables, and their SQL."""

from __future__ import annotations

from footfall.llm.ann import op2_nearest_neighbours
from footfall.llm.attribution import op8_token_counts
from footfall.llm.audit import audit_sql, op11_filter_audit
from footfall.llm.decontamination import leaks_sql, op4_decontamination
from footfall.llm.langid import op10_language_id
from footfall.llm.licenses import op1_license_scan, scan_sql
from footfall.llm.mixing import mix_sql, op7_poisson_mix
from footfall.llm.ngrams import components_sql, op9_ngram_jaccard
from footfall.llm.quality import op5_quality
from footfall.llm.repeats import op13_substring_dedup, repeats_sql
from footfall.llm.secrets import op6_secret_scan
from footfall.llm.store import op3_token_files
from footfall.llm.trie import op12_prefix_trie, trie_sql

QUERIES = {
    "op1_license_scan": op1_license_scan,
    "op2_nearest_neighbours": op2_nearest_neighbours,
    "op3_token_files": op3_token_files,
    "op4_decontamination": op4_decontamination,
    "op5_quality": op5_quality,
    "op6_secret_scan": op6_secret_scan,
    "op7_poisson_mix": op7_poisson_mix,
    "op8_token_counts": op8_token_counts,
    "op9_ngram_jaccard": op9_ngram_jaccard,
    "op10_language_id": op10_language_id,
    "op11_filter_audit": op11_filter_audit,
    "op12_prefix_trie": op12_prefix_trie,
    "op13_substring_dedup": op13_substring_dedup,
}

ORACLES = {
    "op1_license_scan": scan_sql(),
    "op4_decontamination": leaks_sql(),
    "op7_poisson_mix": mix_sql(),
    "op9_ngram_jaccard": components_sql(),
    "op11_filter_audit": audit_sql(),
    "op12_prefix_trie": trie_sql(),
    "op13_substring_dedup": repeats_sql(),
}
