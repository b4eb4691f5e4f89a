"""Queries of the training-data operators and their DuckDB statements."""

from __future__ import annotations

from .fingerprints import op8_fingerprints
from .hard_negatives import OP11_SQL, op11_hard_negatives
from .html_extraction import op4_html_extraction
from .jaccard_join import op10_jaccard_join
from .line_dedup import OP6_SQL, op6_line_dedup
from .mixing import OP12_SQL, op12_source_mixing
from .packing import op2_packing
from .piece_encoding import op5_piece_encoding
from .prefix_trie import OP13_SQL, op13_prefix_trie
from .quality import op3_quality_rules
from .secrets import op7_secret_scan
from .suffix_dedup import op1_suffix_dedup
from .toxicity import op9_toxicity

QUERIES = {f.__name__: f for f in (
    op1_suffix_dedup, op2_packing, op3_quality_rules, op4_html_extraction, op5_piece_encoding,
    op6_line_dedup, op7_secret_scan, op8_fingerprints, op9_toxicity, op10_jaccard_join,
    op11_hard_negatives, op12_source_mixing, op13_prefix_trie)}

ORACLES = {"op6_line_dedup": OP6_SQL, "op11_hard_negatives": OP11_SQL, "op12_source_mixing": OP12_SQL,
           "op13_prefix_trie": OP13_SQL}
