"""The registered queries of this package and the DuckDB SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from stratum.llm.chat_repair import op9_chat_repair
from stratum.llm.column_bwt import OP12_SQL, op12_column_bwt
from stratum.llm.exact_topk import OP5_SQL, op5_exact_topk
from stratum.llm.hard_negatives import OP13_SQL, op13_hard_negatives
from stratum.llm.line_dedup import OP6_SQL, op6_line_dedup
from stratum.llm.near_dedup import op10_minhash_near_dedup
from stratum.llm.nn_descent import op2_nn_descent
from stratum.llm.packing import op1_best_fit_packing
from stratum.llm.piece_coding import op7_piece_coding
from stratum.llm.quality_classifier import op3_quality_classifier
from stratum.llm.token_files import op8_token_files
from stratum.llm.walsh_clusters import OP11_SQL, op11_walsh_clusters
from stratum.llm.warc import OP4_SQL, op4_warc

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_best_fit_packing": op1_best_fit_packing,
    "op2_nn_descent": op2_nn_descent,
    "op3_quality_classifier": op3_quality_classifier,
    "op4_warc": op4_warc,
    "op5_exact_topk": op5_exact_topk,
    "op6_line_dedup": op6_line_dedup,
    "op7_piece_coding": op7_piece_coding,
    "op8_token_files": op8_token_files,
    "op9_chat_repair": op9_chat_repair,
    "op10_minhash_near_dedup": op10_minhash_near_dedup,
    "op11_walsh_clusters": op11_walsh_clusters,
    "op12_column_bwt": op12_column_bwt,
    "op13_hard_negatives": op13_hard_negatives,
}

ORACLE: dict[str, str] = {
    "op4_warc": OP4_SQL,
    "op5_exact_topk": OP5_SQL,
    "op6_line_dedup": OP6_SQL,
    "op11_walsh_clusters": OP11_SQL,
    "op12_column_bwt": OP12_SQL,
    "op13_hard_negatives": OP13_SQL,
}
