"""The queries of this folder by name, and their SQL equivalents."""

from __future__ import annotations

from badgeflow.llm import oracles
from badgeflow.llm.conversations import op12_conversation_trie
from badgeflow.llm.decontaminate import op7_decontaminate
from badgeflow.llm.fingerprint import op1_order_minhash
from badgeflow.llm.html_extract import op5_html_text
from badgeflow.llm.licences import op11_licences
from badgeflow.llm.line_dedup import op10_line_dedup
from badgeflow.llm.mixing import op3_mix
from badgeflow.llm.ngram_join import op9_ngram_join
from badgeflow.llm.packing import op8_pack
from badgeflow.llm.quality import op4_quality
from badgeflow.llm.sharding import op2_jump_shards
from badgeflow.llm.spelling import op13_spelling_variants
from badgeflow.llm.warc import op6_warc

QUERIES = {
    "op1_order_minhash": op1_order_minhash,
    "op2_jump_shards": op2_jump_shards,
    "op3_mix": op3_mix,
    "op4_quality": op4_quality,
    "op5_html_text": op5_html_text,
    "op6_warc": op6_warc,
    "op7_decontaminate": op7_decontaminate,
    "op8_pack": op8_pack,
    "op9_ngram_join": op9_ngram_join,
    "op10_line_dedup": op10_line_dedup,
    "op11_licences": op11_licences,
    "op12_conversation_trie": op12_conversation_trie,
    "op13_spelling_variants": op13_spelling_variants,
}

# The others cannot be held against SQL: tests/llm has brute-force versions, exact round
# trips and held-out accuracy.
ORACLES: dict[str, str] = dict(oracles.ORACLES)
