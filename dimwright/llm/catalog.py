"""The queries of this subpackage, and their SQL where SQL can express them."""

from __future__ import annotations

from dimwright.llm import contamination, divergence, embeddings, line_dedup, mixing
from dimwright.llm.alignment import op13_token_alignment
from dimwright.llm.contamination import op4_decontamination
from dimwright.llm.divergence import op11_source_divergence
from dimwright.llm.embeddings import op1_embedding_links
from dimwright.llm.html_text import op7_html_main_text
from dimwright.llm.langid import op10_language_id
from dimwright.llm.licenses import op3_license_scan
from dimwright.llm.line_dedup import op12_line_dedup
from dimwright.llm.minhash import op9_near_duplicates
from dimwright.llm.mixing import op8_source_mix
from dimwright.llm.pii import op2_personal_data
from dimwright.llm.secret_scan import op5_secret_scan
from dimwright.llm.tokens import op6_token_counts

QUERIES = {
    "op1_embedding_links": op1_embedding_links,
    "op2_personal_data": op2_personal_data,
    "op3_license_scan": op3_license_scan,
    "op4_decontamination": op4_decontamination,
    "op5_secret_scan": op5_secret_scan,
    "op6_token_counts": op6_token_counts,
    "op7_html_main_text": op7_html_main_text,
    "op8_source_mix": op8_source_mix,
    "op9_near_duplicates": op9_near_duplicates,
    "op10_language_id": op10_language_id,
    "op11_source_divergence": op11_source_divergence,
    "op12_line_dedup": op12_line_dedup,
    "op13_token_alignment": op13_token_alignment,
}

#: the others are tested against brute force in tests/llm
ORACLES: dict[str, str] = {
    "op1_embedding_links": embeddings.ORACLE,
    "op4_decontamination": contamination.ORACLE,
    "op8_source_mix": mixing.ORACLE,
    "op11_source_divergence": divergence.ORACLE,
    "op12_line_dedup": line_dedup.ORACLE,
}
