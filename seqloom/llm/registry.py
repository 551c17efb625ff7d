"""Queries of the training-data operators, and SQL for those that SQL can express."""

from __future__ import annotations

from . import host_rules, set_join
from .chat_repair import op4_chat_repair
from .decontamination import op2_decontaminate
from .host_rules import op6_host_rules
from .licenses import op10_license_scan
from .packing import op9_pack
from .pii import op5_pii_spans
from .quality_model import op8_quality_scores
from .secret_scan import op1_secret_scan
from .set_join import op3_jaccard_join
from .token_counts import op7_token_counts

QUERIES = {
    "op1_secret_scan": op1_secret_scan,
    "op2_decontaminate": op2_decontaminate,
    "op3_jaccard_join": op3_jaccard_join,
    "op4_chat_repair": op4_chat_repair,
    "op5_pii_spans": op5_pii_spans,
    "op6_host_rules": op6_host_rules,
    "op7_token_counts": op7_token_counts,
    "op8_quality_scores": op8_quality_scores,
    "op9_pack": op9_pack,
    "op10_license_scan": op10_license_scan,
}
ORACLE: dict[str, str] = {"op3_jaccard_join": set_join.ORACLE_SQL, "op6_host_rules": host_rules.ORACLE_SQL}
