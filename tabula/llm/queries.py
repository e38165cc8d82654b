"""The registered queries of the training-data operators and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tabula.llm import alignment, decontaminate, importance, jaccard, langid, merkle, packing, pii, secrets, simhash, topk, toxicity, warc
from tabula.llm.common import tables

Query = Callable[[SparkSession, str], DataFrame]


def _on(op: Callable[..., DataFrame], *names: str) -> Query:
    return lambda spark, sf_dir: op(*tables(spark, sf_dir, *names))


def _pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline
    return corpus_pipeline.run(spark, sf_dir)


QUERIES: dict[str, Query] = {
    "op1_importance_resampling": _on(importance.op1, "documents", "labels"),
    "op2_toxicity_ordinal": _on(toxicity.op2, "documents", "labels"),
    "op3_decontamination": _on(decontaminate.op3, "documents", "benchmark"),
    "op4_language_id": _on(langid.op4, "documents"),
    "op5_simhash_near_dedup": _on(simhash.op5, "documents"),
    "op6_warc_dictionary": _on(warc.op6, "pages"),
    "op7_pii_skip_chain": _on(pii.op7, "documents"),
    "op8_packing_bin_slack": _on(packing.op8, "documents"),
    "op9_topk_search": _on(topk.op9, "embeddings"),
    "op10_secret_scan": _on(secrets.op10, "documents"),
    "op11_jaccard_divideskip": _on(jaccard.op11, "documents"),
    "op12_merkle_manifest": _on(merkle.op12, "documents"),
    "op13_token_alignment": _on(alignment.op13, "documents"),
    "pipeline": _pipeline,
}

#: The other queries' methods (hashed models, tokenizers, message passing) are beyond SQL;
#: tests/llm compares them with brute force, round trips or held-out labels.
ORACLE_SQL: dict[str, str] = {
    "op3_decontamination": decontaminate.OP3_SQL,
    "op6_warc_dictionary": warc.OP6_SQL,
    "op9_topk_search": topk.OP9_SQL,
    "op11_jaccard_divideskip": jaccard.OP11_SQL,
    "op12_merkle_manifest": merkle.OP12_SQL,
}
