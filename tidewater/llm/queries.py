"""The registered queries of this subpackage; ``ORACLE`` is the SQL of those that SQL can express."""

from __future__ import annotations

from tidewater.llm.byte_bpe import op13_bpe_transducer
from tidewater.llm.filter_audit import op11_filter_audit
from tidewater.llm.licenses import op5_license_join
from tidewater.llm.ngram_join import op9_vertical_jaccard
from tidewater.llm.oracle import ORACLE
from tidewater.llm.packing import op8_pattern_packing
from tidewater.llm.pfor import op1_pfor_tokens
from tidewater.llm.repeats import op2_merged_repeats
from tidewater.llm.repetition import op7_repetition_rules
from tidewater.llm.sharding import op3_feistel_shards
from tidewater.llm.snapshots import op10_snapshot_chats
from tidewater.llm.spelling import op12_spelling_groups
from tidewater.llm.templates import op6_template_leaks
from tidewater.llm.warc import op4_splittable_warc

__all__ = ["ORACLE", "QUERIES"]

QUERIES = {
    "op1_pfor_tokens": op1_pfor_tokens,
    "op2_merged_repeats": op2_merged_repeats,
    "op3_feistel_shards": op3_feistel_shards,
    "op4_splittable_warc": op4_splittable_warc,
    "op5_license_join": op5_license_join,
    "op6_template_leaks": op6_template_leaks,
    "op7_repetition_rules": op7_repetition_rules,
    "op8_pattern_packing": op8_pattern_packing,
    "op9_vertical_jaccard": op9_vertical_jaccard,
    "op10_snapshot_chats": op10_snapshot_chats,
    "op11_filter_audit": op11_filter_audit,
    "op12_spelling_groups": op12_spelling_groups,
    "op13_bpe_transducer": op13_bpe_transducer,
}
