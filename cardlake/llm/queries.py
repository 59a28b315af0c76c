"""The registered queries of the numbered operators, with DuckDB texts where SQL can express them."""

from __future__ import annotations

from cardlake.llm import decontaminate, quality, sharding
from cardlake.llm.alignment import op12_alignment
from cardlake.llm.bpe_codec import op5_bpe_codec
from cardlake.llm.conversation_trie import op13_conversation_trie
from cardlake.llm.decontaminate import op8_decontaminate
from cardlake.llm.licenses import op4_license_scans
from cardlake.llm.line_dedup import op2_line_dedup
from cardlake.llm.minhash import op11_minhash
from cardlake.llm.pii import op7_pii
from cardlake.llm.quality import op6_quality_rules
from cardlake.llm.sharding import op3_sharding
from cardlake.llm.simhash import op10_simhash
from cardlake.llm.token_counts import op1_token_counts
from cardlake.llm.token_files import op9_token_files

QUERIES = {
    "op1_token_counts": op1_token_counts,
    "op2_line_dedup": op2_line_dedup,
    "op3_sharding": op3_sharding,
    "op4_license_scans": op4_license_scans,
    "op5_bpe_codec": op5_bpe_codec,
    "op6_quality_rules": op6_quality_rules,
    "op7_pii": op7_pii,
    "op8_decontaminate": op8_decontaminate,
    "op9_token_files": op9_token_files,
    "op10_simhash": op10_simhash,
    "op11_minhash": op11_minhash,
    "op12_alignment": op12_alignment,
    "op13_conversation_trie": op13_conversation_trie,
}

ORACLE: dict[str, str] = {
    "op3_sharding": sharding.oracle(),
    "op6_quality_rules": quality.ORACLE,
    "op8_decontaminate": decontaminate.ORACLE,
}
