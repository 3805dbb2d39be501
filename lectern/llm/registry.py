"""The queries of this subpackage and the SQL they must equal."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from lectern.llm import balltree, mixing, suffixtrees, warc
from lectern.llm.balltree import op13_ball_tree_centroids
from lectern.llm.compression import op7_compression_quality
from lectern.llm.decontaminate import op6_window_decontamination
from lectern.llm.katz import op8_katz_backoff
from lectern.llm.mixing import op1_budget_tree
from lectern.llm.pii import op3_pii_weak_labels
from lectern.llm.quality_rules import op5_weak_rules
from lectern.llm.secrets import op9_secret_owners
from lectern.llm.sharding import op10_feistel_shards
from lectern.llm.simhash import op4_simhash_vptree
from lectern.llm.suffixtrees import op11_prefix_suffix_trees
from lectern.llm.turns import op12_turn_repair
from lectern.llm.warc import op2_arc_to_warc

QUERIES = (op1_budget_tree, op2_arc_to_warc, op3_pii_weak_labels, op4_simhash_vptree, op5_weak_rules, op6_window_decontamination, op7_compression_quality, op8_katz_backoff, op9_secret_owners, op10_feistel_shards, op11_prefix_suffix_trees, op12_turn_repair, op13_ball_tree_centroids)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in QUERIES}


def oracle_sql() -> dict[str, str]:
    return mixing.ORACLES | warc.ORACLES | suffixtrees.ORACLES | balltree.ORACLES
