"""Queries and SQL of the text operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..runtime import spread, table
from . import encodings, lookalikes, mixing, names, ocr, packing, tokens, truncation


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return names.same_name_pairs(table(spark, sf_dir, "name_forms"))


def p1_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return names.resolve(table(spark, sf_dir, "name_forms"))


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return truncation.truncated(spread(table(spark, sf_dir, "records")), "ingest_pos", "abstract", "source_file").select("ingest_pos").distinct()


def p5_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return truncation.truncation_rates(spread(table(spark, sf_dir, "records")), "ingest_pos", "abstract", "source_file")


def p6_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lookalikes.affected_values(spread(table(spark, sf_dir, "records")), "ingest_pos", ["abstract", "authors_raw"])


def p6_forms(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lookalikes.unify(spread(table(spark, sf_dir, "records")), "ingest_pos", ["abstract", "authors_raw"])


def p7_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    fixed = ocr.repair_fields(spread(table(spark, sf_dir, "records")), "ingest_pos", ["abstract", "title"])
    return fixed.select("ingest_pos", "field_name").distinct()


def p7_repaired(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ocr.repair_fields(spread(table(spark, sf_dir, "records")), "ingest_pos", ["abstract", "title"])


def _packed(spark: SparkSession, sf_dir: str) -> DataFrame:
    sizes = tokens.with_tokens(spread(table(spark, sf_dir, "documents")), ["doc_id"])
    kinds = table(spark, sf_dir, "containers").filter("container is not null").orderBy("capacity_tokens", "container").collect()  # a handful of container kinds
    return packing.pack(sizes, [(r["container"], r["capacity_tokens"]) for r in kinds])


def p8_assignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _packed(spark, sf_dir)


def p8_fills(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.fills(_packed(spark, sf_dir), table(spark, sf_dir, "containers"))


def p8_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.summary(_packed(spark, sf_dir), table(spark, sf_dir, "containers"))


def p9_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(spread(table(spark, sf_dir, "documents")), table(spark, sf_dir, "source_weights"))


def p9_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    weights = table(spark, sf_dir, "source_weights")
    return mixing.shares(mixing.mix(spread(table(spark, sf_dir, "documents")), weights), weights)


def p10_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encodings.garbled(spread(table(spark, sf_dir, "documents"))).select("doc_id").distinct()


def p10_restored(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encodings.repair(spread(table(spark, sf_dir, "documents")))


QUERIES = {f.__name__: f for f in (p1_found, p1_classes, p5_found, p5_rates, p6_found, p6_forms, p7_found, p7_repaired, p8_assignment, p8_fills, p8_summary, p9_mix, p9_shares, p10_found, p10_restored)}
SQL: dict[str, str] = {}
