"""Each operator over its whole table, with the parameters of production."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path
from . import exact_dedup, html_main, language_id, merkle, mixing, near_dedup, oracle, oracle_text, packing, quality_model, quality_rules, rows, simhash, spelling, token_store, url_filter

#: The rules of the URL query.
URL_RULES = [url_filter.Rule("block", "net/"), url_filter.Rule("allow", "example.net/en/"),
             url_filter.Rule("block", "example.com/de/"), url_filter.Rule("allow", "org/fr/")]


def tokenizer() -> str:
    """The vocabulary file of the token queries; every executor has the package that holds it."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_groups(rows.read(spark, sf_dir, "documents"))


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(rows.read(spark, sf_dir, "documents"), tokenizer())


def op3_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge(rows.read(spark, sf_dir, "pages"), URL_RULES)


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality_rules.judge(rows.read(spark, sf_dir, "documents"))
    return judged.withColumns({c: F.round(c, 6) for c in ("char_distance", "word_distance")})


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = rows.read(spark, sf_dir, "documents")
    held_out = F.coalesce(rows.fold("doc_id", 4) == 2, F.lit(False))
    network = language_id.learn(docs.filter(~held_out))
    return language_id.identify(docs, network).select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


def op6_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_groups(rows.read(spark, sf_dir, "documents"))


def op7_html_main(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_main.extract(rows.read(spark, sf_dir, "pages"))


def op8_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "tokens")
    token_store.write(rows.read(spark, sf_dir, "documents"), path, tokenizer())
    return token_store.digests(spark, path)


def op9_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(rows.read(spark, sf_dir, "documents"))
    shown = F.array_join(F.transform("by_shard", lambda s: F.concat_ws(":", s["shard"].cast("string"), s["words"].cast("string"))), " ")
    return mixed.withColumn("by_shard", shown)


def op10_quality_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = rows.read(spark, sf_dir, "labels").filter(rows.fold("doc_id", 5) != 0).select("doc_id", F.col("quality").alias("label"))
    scored = quality_model.score(rows.read(spark, sf_dir, "documents"), labels)
    return scored.select("doc_id", F.coalesce(rows.fold("doc_id", 5) == 0, F.lit(False)).alias("held_out"), "score", "predicted")


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = spelling.misspelt(spelling.runs(rows.read(spark, sf_dir, "documents")))
    return spelling.variants(spelling.vocabulary(found))


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    tampered = F.when(rows.fold("doc_id", 3) == 0, rows.ascii_lower("text")).otherwise(F.col("text"))
    manifest = merkle.build(rows.read(spark, sf_dir, "documents"), replacements={"tampered": {"text": tampered}})
    return merkle.folded(manifest, "tampered")


def op13_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.fingerprinted(rows.read(spark, sf_dir, "documents"))


QUERIES = {q.__name__: q for q in (op1_exact_dedup, op2_packing, op3_url_filter, op4_quality_rules, op5_language_id, op6_near_dedup, op7_html_main, op8_token_store, op9_source_mix, op10_quality_model, op11_spelling_variants, op12_merkle_manifest, op13_fingerprints)}
ORACLE_SQL = oracle.ORACLE_SQL | {"op11_spelling_variants": oracle_text.OP11, "op12_merkle_manifest": oracle_text.OP12, "op13_fingerprints": oracle_text.OP13}
