"""Registered queries of the subpackage and their DuckDB equivalents."""

from __future__ import annotations

from . import licenses, prefix_trie, warc
from .alignment import op12_token_alignment
from .decontam import op7_decontamination
from .embeddings import op1_embedding_near_dedup
from .html_text import op3_html_text
from .langid import op9_language_id
from .minhash import op6_minhash_near_dedup
from .mixing import op2_mixing
from .quality import op10_quality
from .sharding import op5_sharding
from .tokens import op8_token_counts

QUERIES = {
    "op1_embedding_near_dedup": op1_embedding_near_dedup,
    "op2_mixing": op2_mixing,
    "op3_html_text": op3_html_text,
    "op4_license_scan": licenses.op4_license_scan,
    "op5_sharding": op5_sharding,
    "op6_minhash_near_dedup": op6_minhash_near_dedup,
    "op7_decontamination": op7_decontamination,
    "op8_token_counts": op8_token_counts,
    "op9_language_id": op9_language_id,
    "op10_quality": op10_quality,
    "op11_warc_index": warc.op11_warc_index,
    "op12_token_alignment": op12_token_alignment,
    "op13_prefix_trie": prefix_trie.op13_prefix_trie,
}

ORACLE: dict[str, str] = {
    "op4_license_scan": licenses.oracle_sql(),
    "op11_warc_index": warc.oracle_sql(),
    "op13_prefix_trie": prefix_trie.oracle_sql(),
}
