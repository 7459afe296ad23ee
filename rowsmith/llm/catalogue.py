"""Queries of the training-data operators, and the DuckDB SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from .byte_cnn import op9_byte_cnn
from .chat_format import SQL_OP7, op7_chat_format
from .fill_in_middle import SQL_OP13, op13_fill_in_middle
from .host_rules import SQL_OP8, op8_host_rules
from .minhash import op2_minhash
from .packing import op10_packing
from .periodic_runs import op11_periodic_runs
from .pii import op5_pii
from .repeated_bytes import op12_repeated_bytes
from .sentencepiece_lattice import op3_sentencepiece
from .token_counts import op1_token_counts
from .token_files import op6_token_files
from .vptree import SQL_OP4, op4_vptree

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_token_counts": op1_token_counts,
    "op2_minhash": op2_minhash,
    "op3_sentencepiece": op3_sentencepiece,
    "op4_vptree": op4_vptree,
    "op5_pii": op5_pii,
    "op6_token_files": op6_token_files,
    "op7_chat_format": op7_chat_format,
    "op8_host_rules": op8_host_rules,
    "op9_byte_cnn": op9_byte_cnn,
    "op10_packing": op10_packing,
    "op11_periodic_runs": op11_periodic_runs,
    "op12_repeated_bytes": op12_repeated_bytes,
    "op13_fill_in_middle": op13_fill_in_middle,
}

SQL: dict[str, str] = {
    "op4_vptree": SQL_OP4,
    "op7_chat_format": SQL_OP7,
    "op8_host_rules": SQL_OP8,
    "op11_periodic_runs": op11_periodic_runs,
    "op12_repeated_bytes": op12_repeated_bytes,
    "op13_fill_in_middle": SQL_OP13,
}
