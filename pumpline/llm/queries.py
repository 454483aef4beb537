"""Registered queries of the operators (name -> callable) and the DuckDB SQL of those SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from pumpline.llm import (op1_pii, op2_langid, op3_nndescent, op4_main_text, op5_simhash, op6_urls, op7_secrets, op8_mix,
                          op9_decontaminate, op10_lattice, op11_whiten,
                          op12_merkle, op13_substring)
from pumpline.llm.common import table


def _over(name: str, fn: Callable[[SparkSession, DataFrame], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf_dir: fn(spark, table(spark, sf_dir, name))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_pii_bilstm": _over("documents", op1_pii.digest),
    "op2_language_id": _over("documents", op2_langid.digest),
    "op3_nn_descent": _over("embeddings", op3_nndescent.digest),
    "op4_main_text": _over("pages", op4_main_text.digest),
    "op5_simhash_golay": _over("documents", op5_simhash.digest),
    "op6_url_trust": _over("pages", op6_urls.digest),
    "op7_secret_ownership": _over("documents", op7_secrets.digest),
    "op8_mix_sources": _over("documents", op8_mix.digest),
    "op9_decontaminate": lambda spark, sf_dir: op9_decontaminate.digest(
        spark, table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")),
    "op10_lattice_lm": _over("documents", op10_lattice.digest),
    "op11_whiten_charpoly": _over("embeddings", op11_whiten.digest),
    "op12_merkle_manifest": _over("documents", op12_merkle.digest),
    "op13_substring_recompress": _over("documents", op13_substring.digest),
}

ORACLES: dict[str, str] = {"op6_url_trust": op6_urls.oracle(), "op8_mix_sources": op8_mix.ORACLE,
                            "op12_merkle_manifest": op12_merkle.oracle(), "op13_substring_recompress": op13_substring.ORACLE}
