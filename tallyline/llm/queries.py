"""The operators of this package as queries over the given tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from public_tokenizers import path as tokenizer

from tallyline.llm import (
    chat,
    decontamination,
    mixing,
    oracle,
    packing,
    quality,
    rules,
    simhash,
    spelling,
    substring,
    tokens,
    toxicity,
    url_filters,
    vector_codes,
)
from tallyline.llm.common import documents, labels, remainder

Query = Callable[[SparkSession, str], DataFrame]

_QUERIES: dict[str, Query] = {}


def _query(function: Query) -> Query:
    _QUERIES[function.__name__] = function
    return function


def queries() -> dict[str, Query]:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return oracle.oracle_sql()


# Tokens of a sequence.
CONTEXT = 4096

# Lists for the pages: dated entries derived from their own hosts and paths. ``n`` is a number from
# a digest of the value, which spreads days and lists over the entries.
_ENTRIES = """
with named as (
    select
        regexp_extract(lower(url), '^[a-z]+://([^/?#:]+)', 1) as host,
        regexp_extract(url, '^[a-z]+://[^/?#]+/([^/?#]+)', 1) as top
    from pages
), valued as (
    select distinct 'domain' as kind, regexp_replace(host, '^(www|m|blog)[.]', '') as value from named
    union all
    select distinct 'host', host from named
    union all
    select distinct 'prefix', concat(host, '/', top) from named where top <> ''
), numbered as (
    select kind, value, cast(conv(substr(md5(value), 1, 7), 16, 10) as bigint) as n
    from valued where value <> ''
), listed as (
    select
        case when kind = 'host' then 'allow' when n % 3 = 0 then 'malware' else 'spam' end as list,
        kind, value, n, date_add(date'2024-01-01', cast(n % 300 as int)) as day
    from numbered
    where n % case kind when 'domain' then 5 when 'host' then 11 else 7 end = 0
)
select list, kind, value, 'add' as action, day from listed
union all
select list, kind, value, 'remove', date_add(day, 60) from listed where n % 2 = 0
union all
select list, kind, value, 'add', date_add(day, 90) from listed where n % 4 = 0
"""


@_query
def op1_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page by the list entries active when it was fetched, an hour and a day given by its id."""
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url")
    entries = spark.sql(_ENTRIES.replace("from pages", "from {pages}"), pages=pages)
    fetched = "timestampadd(hour, cast(page_id % 8784 as int), timestamp'2024-01-01')"
    captures = pages.withColumn("fetched_at", F.expr(fetched))
    return url_filters.judged(captures, entries).select(
        "page_id",
        F.to_date("fetched_at").cast("string").alias("fetched_on"),
        F.array_join("lists", ",").alias("lists"),
        "n_entries",
        "kept",
    )


@_query
def op2_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The place of every piece of every document, with a digest of its ids."""
    docs = documents(spark, sf_dir).select("doc_id", "text")
    pieces = packing.tokenised(docs, tokenizer("word_bpe_49k.json"), CONTEXT)
    digests = pieces.select(
        "doc_id", "piece", "start", "length", F.crc32("ids").cast("long").alias("ids_crc32")
    )
    return packing.pack(digests, CONTEXT)


@_query
def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes and tokens of every document."""
    docs = documents(spark, sf_dir).select("doc_id", "text")
    return tokens.with_counts(docs, tokenizer("piece_bpe_32k.model"), CONTEXT)


@_query
def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The toxicity of every document, learned from the labels outside the held-out fold."""
    docs = documents(spark, sf_dir).select("doc_id", "text")
    fold = remainder("doc_id", 4)
    scorer = toxicity.fit(docs, labels(spark, sf_dir).filter(fold != 2))
    return toxicity.scored(docs, scorer).select(
        "doc_id", (fold == 2).alias("held_out"), "score", "predicted", "evidence"
    )


@_query
def op5_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fingerprint of every document and the component it is linked to."""
    return simhash.near_duplicates(documents(spark, sf_dir)).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


@_query
def op6_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The quality of every document, learned from the labels outside the held-out fold."""
    rows = quality.described_once(documents(spark, sf_dir).select("doc_id", "text"))
    fold = remainder("doc_id", 5)
    model = quality.fit(rows, labels(spark, sf_dir).filter(fold != 0))
    return quality.scored(rows, model).select(
        "doc_id", (fold == 0).alias("held_out"), "score", "predicted"
    )


@_query
def op7_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The passages of documents that hold a test item."""
    docs = documents(spark, sf_dir).select("doc_id", "text")
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    found = decontamination.with_matches(docs, items)
    return found.select("doc_id", F.explode("matches").alias("m")).select("doc_id", "m.*")


@_query
def op8_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of every document without the windows that earlier ones hold."""
    docs = documents(spark, sf_dir).select("doc_id", "text")
    return substring.without_repeats(docs, digest=True)


@_query
def op9_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation preferred to itself with the ending of the next one."""
    turns = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    chosen = turns.select(F.col("conv_id").alias("pair_id"), "turn", "role", "text")
    changed = F.expr("turn >= 1 + pair_id % 4")
    following = chosen.withColumn("pair_id", F.col("pair_id") - 1)
    known = chosen.select("pair_id").distinct()
    rejected = chosen.filter(~changed).unionByName(
        following.filter(changed).join(known, "pair_id", "left_semi")
    )
    return chat.preferences(chosen, rejected)


@_query
def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ledger of every document and the verdicts of the base rules and the current policy."""
    base = rules.bits(*rules.BASE)
    return rules.ledger(documents(spark, sf_dir).select("doc_id", "text")).select(
        "doc_id",
        *rules.MEASURES,
        (F.col("failures").bitwiseAND(F.lit(base)) != 0).alias("base_failed"),
        rules.passes().alias("kept"),
        "failures",
    )


@_query
def op11_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many words of every document the mix of all sources takes."""
    docs = documents(spark, sf_dir).select("doc_id", "text", "source")
    return mixing.mixed(docs).select("doc_id", "size", "source_size", "target", "taken")


@_query
def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The code of every vector and what it loses."""
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    codes, _ = vector_codes.compressed(vectors.select("vec_id", "embedding", "label"))
    return codes.select("vec_id", "code", "error", "label_error", "codebooks_sha256")


@_query
def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every word of the documents with the word it is a variant of."""
    return spelling.variants(documents(spark, sf_dir).select("doc_id", "text"))
