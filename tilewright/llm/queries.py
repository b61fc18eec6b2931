"""The queries of this subpackage, and the SQL that gives the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from .op01_mix import OP1_SQL, op1_mix_sources
from .op02_shards import op2_training_shards
from .op03_toxicity import op3_toxicity
from .op04_pack import op4_best_fit_packing
from .op05_secrets import OP5_SQL, op5_secret_scan
from .op06_suffix_dedup import OP6_SQL, op6_suffix_dedup
from .op07_permutation_index import op7_permutation_index
from .op08_fingerprint import op8_order_minhash
from .op09_minhash import OP9_SQL, op9_minhash_near_dedup
from .op10_preferences import OP10_SQL, op10_preference_pairs

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in (op1_mix_sources, op2_training_shards, op3_toxicity, op4_best_fit_packing, op5_secret_scan, op6_suffix_dedup, op7_permutation_index, op8_order_minhash, op9_minhash_near_dedup, op10_preference_pairs)}

ORACLE_SQL: dict[str, str] = {"op1_mix_sources": OP1_SQL, "op5_secret_scan": OP5_SQL, "op6_suffix_dedup": OP6_SQL, "op9_minhash_near_dedup": OP9_SQL, "op10_preference_pairs": OP10_SQL}
