"""Registered queries of the corpus operators and the DuckDB SQL of those that SQL can express."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from threadlens.llm import conversation_repair, exact_dedup, lexical_search, mixing, quality_model, packing, pii, quality_rules, simhash, suffix_dedup, token_counts, token_store, url_filter
from threadlens.session import scratch_path

MAX_TOKENS = 1024


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = simhash.near_groups(table(spark, sf_dir, "documents"))
    return groups.select("doc_id", simhash.as_hex(F.col("fp")).alias("fingerprint"), F.col("component").alias("component_id"))


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    counts = token_counts.token_counts(docs, public_tokenizers.path("byte_bpe_50k.json"))
    return counts.withColumn("over_limit", F.col("n_tokens") > MAX_TOKENS)


def op3_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = suffix_dedup.remove_repeats(table(spark, sf_dir, "documents"))
    return cut.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(table(spark, sf_dir, "documents"))
    names = {"_m_size": "size", "_p_size": "source_size", "_p_target": "target", "_m_taken": "taken"}
    return mixed.select("doc_id", *[F.col(a).alias(b) for a, b in names.items()])


def op5_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = pii.detect(docs, pii.fit(docs))
    counts = [F.size(F.filter("_base", pii.is_kind(n))).cast("bigint").alias(f"n_{kind}") for n, kind in enumerate(pii.KINDS)]
    return found.select("doc_id", *counts, F.sha2(pii.listed(F.col("_base")), 256).alias("base_sha256"), pii.listed(F.col("_all")).alias("spans"))


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), end_id=2)


URL_RULES = [
    url_filter.Rule("allow", "org/"),
    url_filter.Rule("block", "example.org/es/"),
    url_filter.Rule("block", "example.org/en/1"),
    url_filter.Rule("allow", "com/fr/"),
    url_filter.Rule("block", "com/de/"),
]


def op8_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    model = url_filter.fit(url_filter.labelled_by_words(pages))
    judged = url_filter.judge(pages, URL_RULES, model)
    return judged.select("page_id", *[F.col(f"_u_{c}").alias(c) for c in ("host", "path", "rule", "verdict")])


def op9_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "id-store")
    docs = table(spark, sf_dir, "documents")
    token_store.write_store(docs, path, public_tokenizers.path("byte_bpe_50k.json"), end_id=0)
    stored = token_store.read_store(spark, path)
    return stored.select(F.col("id").alias("doc_id"), "start", "n_tokens", "ids_crc32")


def op7_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.duplicate_groups(table(spark, sf_dir, "documents"))


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    rules = quality_rules.learn_rules(docs, table(spark, sf_dir, "labels"))
    columns = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "rule"]
    return quality_rules.judge(quality_rules.text_statistics(docs), rules).select(*columns)


def op11_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical_search.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op12_quality_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return quality_model.score(docs, quality_model.fit(docs, table(spark, sf_dir, "labels")))


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_repair.repair(table(spark, sf_dir, "conversations"))


QUERIES = {
    "op1_simhash": op1_simhash,
    "op2_token_counts": op2_token_counts,
    "op3_suffix_dedup": op3_suffix_dedup,
    "op4_mixing": op4_mixing,
    "op5_pii": op5_pii,
    "op6_packing": op6_packing,
    "op7_exact_dedup": op7_exact_dedup,
    "op8_url_filter": op8_url_filter,
    "op9_token_store": op9_token_store,
    "op10_quality_rules": op10_quality_rules,
    "op11_lexical_search": op11_lexical_search,
    "op12_quality_model": op12_quality_model,
    "op13_conversation_repair": op13_conversation_repair,
}

ORACLES = {
    "op7_exact_dedup": """
        with t as (select doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as norm from documents)
        select doc_id, max(doc_id) over (partition by norm) as keep_id, count(*) over (partition by norm) as group_size,
               doc_id = max(doc_id) over (partition by norm) as kept, sha256(norm) as text_sha256
        from t
    """,
}

_TERMS = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"

ORACLES["op11_lexical_search"] = f"""
    with d as (select row_number() over () as rid, doc_id, {_TERMS} as t from documents),
    g as (select count(*) filter (where len(t) > 0) as big_n, sum(len(t)) as big_l from d),
    p as (select rid, doc_id, term, count(*) as tf from (select rid, doc_id, unnest(t) as term from d) group by all),
    f as (select term, count(*) as df from p group by term),
    m as (select rid, 75 + (25 * len(t) * big_n) // big_l as m from d, g where len(t) > 0),
    w as (select term, cast(floor(1000 * ln((2 * big_n + 2)::double / (2 * df + 1))) as bigint) as w from f, g),
    q as (select item_id, unnest({_TERMS}) as term from benchmark),
    s as (select q.item_id, p.rid, p.doc_id, sum(w.w * ((1000000000 * p.tf) // (1000 * p.tf + 12 * m.m))) as score
          from q join w using (term) join p using (term) join m using (rid) group by q.item_id, p.rid, p.doc_id)
    select item_id, cast(rank as integer) as rank, doc_id, cast(score as bigint) as score from (
        select *, row_number() over (partition by item_id order by score desc, doc_id) as rank from s where score > 0)
    where rank <= 20
"""
