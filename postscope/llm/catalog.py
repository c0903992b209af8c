"""Registered queries of the training-data operators and their SQL, where SQL can state them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from .bpe import op8_bpe
from .chat import OP6_SQL, op6_chat
from .crf import op7_quality
from .ctw import op9_ctw
from .decontaminate import OP5_SQL, op5_decontaminate
from .periodic_runs import op11_periodic_runs
from .pii import op10_pii
from .secret_scan import OP3_SQL, op3_secrets
from .sharding import op2_sharding
from .simhash import op1_simhash
from .suffix_dedup import op12_suffix_dedup
from .weighted_sampling import op4_fingerprints
from .whitening import op13_whitening

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_simhash": op1_simhash,
    "op2_sharding": op2_sharding,
    "op3_secrets": op3_secrets,
    "op4_fingerprints": op4_fingerprints,
    "op5_decontaminate": op5_decontaminate,
    "op6_chat": op6_chat,
    "op7_quality": op7_quality,
    "op8_bpe": op8_bpe,
    "op9_ctw": op9_ctw,
    "op10_pii": op10_pii,
    "op11_periodic_runs": op11_periodic_runs,
    "op12_suffix_dedup": op12_suffix_dedup,
    "op13_whitening": op13_whitening,
}

ORACLE: dict[str, str] = {
    "op3_secrets": OP3_SQL,
    "op5_decontaminate": OP5_SQL,
    "op6_chat": OP6_SQL,
}
