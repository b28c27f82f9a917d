"""The corpus operators as registered queries, each over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from vacancylake.llm import (
    bpe,
    cover_tree,
    decontaminate,
    html_text,
    kneser_ney,
    lexical,
    licenses,
    ngram_join,
    quality_rules,
    spelling,
    token_files,
    toxicity,
    url_trust,
)
from vacancylake.llm.shared import prepare

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def register(sql: str | None = None):
    def add(query: Callable[[SparkSession, str], DataFrame]):
        QUERIES[query.__name__] = query
        if sql is not None:
            SQL[query.__name__] = sql
        return query

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    prepare(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@register()
def op1_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@register(url_trust.judge_sql())
def op2_url_trust(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = url_trust.judge(table(spark, sf_dir, "pages"))
    return judged.select("page_id", "host", "path", "rule", "verdict")


@register()
def op3_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents"))


@register(cover_tree.LINKS_SQL)
def op4_cover_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cover_tree.threshold_links(table(spark, sf_dir, "embeddings"))


@register()
def op5_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip(table(spark, sf_dir, "documents"))


@register()
def op6_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(table(spark, sf_dir, "pages"))


@register()
def op7_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.digests(spark, token_files.write(table(spark, sf_dir, "documents")))


@register()
def op8_kneser_ney(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kneser_ney.perplexity(table(spark, sf_dir, "documents"))


@register(ngram_join.JOIN_SQL)
def op9_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.join(table(spark, sf_dir, "documents"))


@register()
def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@register(lexical.RANK_SQL)
def op11_lexical_rank(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.rank(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@register()
def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.group_variants(table(spark, sf_dir, "documents"))


@register(quality_rules.RULES_SQL)
def op13_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.rate_documents(table(spark, sf_dir, "documents"))
