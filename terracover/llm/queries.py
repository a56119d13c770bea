"""The registered queries of the training-data operators."""

from __future__ import annotations

from . import sql
from .align import op13_align
from .bpe import op8_bpe
from .chat import op6_chat
from .decontaminate import op1_decontaminate
from .divergence import op11_divergence
from .neardup import op3_minhash
from .overlap import op12_overlap
from .phrases import op10_phrases
from .pii import op7_pii
from .quality import op5_quality
from .sharding import op4_sharding
from .suffixes import op9_suffixes
from .tokens import op2_token_ids

QUERIES = {
    "op1_decontaminate": op1_decontaminate,
    "op2_token_ids": op2_token_ids,
    "op3_minhash": op3_minhash,
    "op4_sharding": op4_sharding,
    "op5_quality": op5_quality,
    "op6_chat": op6_chat,
    "op7_pii": op7_pii,
    "op8_bpe": op8_bpe,
    "op9_suffixes": op9_suffixes,
    "op10_phrases": op10_phrases,
    "op11_divergence": op11_divergence,
    "op12_overlap": op12_overlap,
    "op13_align": op13_align,
}
ORACLE_SQL = {
    "op3_minhash": sql.NEAR_DUPLICATES,
    "op6_chat": sql.CHAT,
    "op9_suffixes": sql.SUFFIXES,
    "op10_phrases": sql.PHRASES,
    "op11_divergence": sql.DIVERGENCE,
    "op12_overlap": sql.OVERLAP,
}
