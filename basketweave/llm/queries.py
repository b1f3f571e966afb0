"""The registered queries of this package and their SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from basketweave.llm import (
    align,
    decontaminate,
    language,
    minhash,
    mixing,
    neighbours,
    phrases,
    pii,
    quality,
    sql,
    tokens,
    toxicity,
    urls,
    warc,
)
from basketweave.llm.common import table, workspace

Query = Callable[[SparkSession, str], DataFrame]

TOKENIZER, END_ID = "word_bpe_49k.json", 1
ENTROPY, REPEATS = 0.95, 4.0


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which documents hold which benchmark items, within the edit budget."""
    return decontaminate.find_matches(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    )


def op2_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The group of near copies of every document."""
    return minhash.near_duplicates(table(spark, sf_dir, "documents"), workspace(spark))


def op3_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data per document, with the mean score of its spans."""
    found = pii.find_pii(table(spark, sf_dir, "documents").select("doc_id", "text"))
    base = F.filter("pii", lambda s: s["kind"].isin(pii.BASE))
    return found.select(
        "doc_id",
        *[pii.count_of(F.col("pii"), k).alias(f"n_{k}") for k in pii.BASE],
        F.sha2(pii.span_text(base), 256).alias("base_sha256"),
        pii.span_text(F.col("pii")).alias("spans"),
        F.array_join(
            F.transform("pii", lambda s: F.round(s["score"], 2).cast("string")), ","
        ).alias("scores"),
    )


def op4_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest vectors of every vector whose id is divisible by 20."""
    vectors = table(spark, sf_dir, "embeddings")
    return neighbours.search(vectors, F.col("vec_id") % 20 == 0, workspace(spark), k=20)


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The toxicity of every document, by a model of the labels that are not held out."""
    docs = table(spark, sf_dir, "documents")
    scored = toxicity.score(docs, toxicity.fit(docs, table(spark, sf_dir, "labels"), workspace(spark)))
    return scored.select(
        "doc_id",
        toxicity.held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= toxicity.THRESHOLD).cast("int").alias("predicted"),
        "passages",
    )


def op6_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents encoded, written as binary files and read back."""
    files = tokens.write_token_files(
        table(spark, sf_dir, "documents"),
        workspace(spark),
        public_tokenizers.path(TOKENIZER),
        END_ID,
        words=True,
    )
    return tokens.read_token_files(files)


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The order in which a mixture of as many tokens as there are reads the documents."""
    mixed = mixing.mix(
        table(spark, sf_dir, "documents").select("doc_id", "source", "text"),
        workspace(spark),
        target_entropy=ENTROPY,
        max_repeats=REPEATS,
    )
    return mixed.select("doc_id", "source", "mix_tokens", "mix_epoch", "mix_position")


RULES = (
    urls.Rule("allow", "com", "/"),
    urls.Rule("block", "example.com", "/en/"),
    urls.Rule("allow", "www.example.com", "/en/"),
    urls.Rule("block", "net", "/es/"),
    urls.Rule("block", "net", "/fr/"),
)


def op8_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The verdict on every page."""
    return urls.judge(table(spark, sf_dir, "pages"), workspace(spark), RULES)


def op9_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every document, by a model of those that are not held out."""
    docs = table(spark, sf_dir, "documents")
    found = language.identify(docs, language.fit(docs))
    return found.select(
        "doc_id", language.held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score", "languages"
    )


# The audit drill damages the copies of records whose page_id has a CRC divisible by this.
DRILL = 97


def op10_warc_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages as WARC records in two replicas, one damaged in a drill, and audited.

    Per record its stored size and hash, and whether the replicas agree on it.
    """
    ws = workspace(spark)
    first, second = f"{ws.path}/replica-1", f"{ws.path}/replica-2"
    ledger = warc.write_archive(table(spark, sf_dir, "pages"), ws, first)
    warc.copy_archive(ledger, ws, first, second, drill=DRILL)
    trees = [warc.build_tree(warc.hash_records(ledger, f), ws) for f in (first, second)]
    bad = warc.audit(*trees, ws).select("file", F.col("node").alias("seq"), F.lit(False).alias("intact"))
    return ledger.join(bad, ["file", "seq"], "left").select(
        "page_id",
        (F.col("end") - F.col("start")).alias("record_bytes"),
        "sha256",
        F.coalesce("intact", F.lit(True)).alias("intact"),
    )


TOP_PHRASES = 2000


def op11_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The phrases of two and three words that cohere most, per language."""
    return phrases.top_phrases(table(spark, sf_dir, "documents"), workspace(spark), TOP_PHRASES)


FIRST, SECOND = "byte_bpe_50k.json", "piece_bpe_32k.model"


def op12_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How the tokens of two tokenizers cover every document, and how usual its links are."""
    paths = [public_tokenizers.path(name) for name in (FIRST, SECOND)]
    groups = F.when(F.col("groups") == "", "").otherwise(F.sha2("groups", 256))
    aligned = align.align(table(spark, sf_dir, "documents"), *paths)
    rated = align.rate_links(
        aligned.withColumn("groups", groups), align.vocabulary(paths[1]), workspace(spark)
    )
    return rated.withColumnRenamed("groups", "groups_sha256")


def op13_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The quality of every document, by a model of the labels that are not held out."""
    docs = table(spark, sf_dir, "documents")
    scored = quality.score(docs, quality.fit(docs, table(spark, sf_dir, "labels"), workspace(spark)))
    return scored.select(
        "doc_id",
        quality.held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= quality.THRESHOLD).cast("int").alias("predicted"),
        "margin",
    )


QUERIES: dict[str, Query] = {
    "op1_decontamination": op1_decontamination,
    "op2_near_duplicates": op2_near_duplicates,
    "op3_pii": op3_pii,
    "op4_neighbours": op4_neighbours,
    "op5_toxicity": op5_toxicity,
    "op6_token_files": op6_token_files,
    "op7_mixing": op7_mixing,
    "op8_url_filters": op8_url_filters,
    "op9_language": op9_language,
    "op10_warc_audit": op10_warc_audit,
    "op11_phrases": op11_phrases,
    "op12_token_alignment": op12_token_alignment,
    "op13_quality": op13_quality,
}

SQL: dict[str, str] = {
    "op2_near_duplicates": sql.near_duplicates(),
    "op7_mixing": sql.mixing_order(ENTROPY, REPEATS),
    "op8_url_filters": sql.url_verdicts(RULES),
    "op11_phrases": sql.phrases(TOP_PHRASES),
}
