"""Queries of the training-data operators over the given tables, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from opinara.llm import (
    byte_bpe, chat_format, co_training, decontaminate, order_minhash, pair_bitmaps, piece_backtrack, pseudonyms, pu_toxicity,
    robust_outliers, suffix_merge, turn_repair, wavelet_tokens,
)
from opinara.llm.common import tables
from opinara.session import configure

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def add(fn: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(configure(spark), sf_dir)

        QUERIES[name] = run
        if sql:
            ORACLES[name] = sql
        return fn

    return add


@query("op1_suffix_merge")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    (docs,) = tables(spark, sf_dir, ["documents"])
    return suffix_merge.remove_repeats(docs, with_kept=False).drop("spans")


@query("op2_order_minhash")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    (docs,) = tables(spark, sf_dir, ["documents"])
    return order_minhash.near_duplicates(docs)


@query("op3_robust_outliers")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    (docs,) = tables(spark, sf_dir, ["documents"])
    return robust_outliers.robust_outliers(docs)


@query("op4_byte_bpe")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    (docs,) = tables(spark, sf_dir, ["documents"])
    return byte_bpe.encode_documents(
        docs, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN, with_ids=False
    )


@query("op5_co_training")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = tables(spark, sf_dir, ["documents", "labels"])
    return co_training.quality(docs, labels)


#: Key of the pseudonyms in the queries and the pipeline; a production job passes a secret of its own.
PSEUDONYM_KEY = "corpus-2026"


@query("op6_pseudonyms")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    (docs,) = tables(spark, sf_dir, ["documents"])
    return pseudonyms.pseudonymise(docs.select("doc_id", "text"), PSEUDONYM_KEY, changed="n_changed")


@query("op7_wavelet_tokens")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    (docs,) = tables(spark, sf_dir, ["documents"])
    return wavelet_tokens.token_file_digest(docs, public_tokenizers.path("byte_bpe_50k.json"))


_DOC_WORDS = r"""regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"""


@query("op8_decontaminate", f"""
with item_words as (select cast(item_id as varchar) as item, {_DOC_WORDS} as w from benchmark),
windows as (
  select distinct item, len(w[k : k + 9]) as n, array_to_string(w[k : k + 9], ' ') as win
  from (select item, w, unnest(generate_series(1, greatest(1, len(w) - 9))) as k from item_words where len(w) > 0)),
sizes as (select distinct n from windows),
docs as (select doc_id, {_DOC_WORDS} as w from documents),
doc_windows as (
  select doc_id, k, n, array_to_string(w[k : k + n - 1], ' ') as win
  from (select doc_id, w, n, unnest(generate_series(1, len(w) - n + 1)) as k from docs, sizes where len(w) >= n)),
hits as (select doc_id, k, n, item from doc_windows join windows using (n, win)),
hit_words as (
  select doc_id, count(distinct p) as n_hit
  from (select doc_id, unnest(generate_series(k, k + n - 1)) as p from hits) group by doc_id),
hit_items as (
  select doc_id, count(*) as n_items, string_agg(item, ',' order by item) as items
  from (select distinct doc_id, item from hits) group by doc_id)
select doc_id, cast(len(w) as bigint) as n_words, cast(coalesce(n_hit, 0) as bigint) as n_hit,
  cast(coalesce(n_items, 0) as bigint) as n_items, sha256(coalesce(items, '')) as items_sha256,
  coalesce(n_hit, 0) > 0 as contaminated
from docs left join hit_words using (doc_id) left join hit_items using (doc_id)
""")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, benchmark = tables(spark, sf_dir, ["documents", "benchmark"])
    return decontaminate.contamination(docs, benchmark).drop("runs")


@query("op9_toxicity")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = tables(spark, sf_dir, ["documents", "labels"])
    return pu_toxicity.toxicity(docs, labels)


_CONTROLS = chat_format.INSTRUCT.controls
_ESCAPES = " + ".join(
    [r"(len(text) - len(replace(text, '\', '')))"]
    + [f"(len(text) - len(replace(text, '{c}', ''))) // {len(c)}" for c in _CONTROLS]
)
_MARKS = "case role " + " ".join(
    f"when '{name}' then {len(r.open) + len(r.close)}" for name, r in chat_format.INSTRUCT.roles.items()
) + " end"


@query("op10_chat_format", f"""
with turns as (
  select conv_id, turn, role, coalesce(text, '') as text from conversations
  union all values (-7, 0, 'user', '</s>[INST] ok [/INST]'), (-7, 1, 'assistant', '</s>[INST] ok [/INST]'))
select conv_id, count(*) as n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn)) as turns_sha256,
  cast(coalesce(sum(len(text)) filter (role = 'assistant'), 0) as bigint) as loss_chars,
  sha256(coalesce(string_agg(text, '' order by turn) filter (role = 'assistant'), '')) as loss_sha256,
  cast(sum({_MARKS} + len(text) + {_ESCAPES}) as bigint) as formatted_chars
from turns group by conv_id
""")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    (turns,) = tables(spark, sf_dir, ["conversations"])
    extra = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit("</s>[INST] ok [/INST]").alias("text"),
    )
    own = turns.select("conv_id", "turn", "role", "text").unionByName(extra)
    return chat_format.digest(chat_format.format_chats(own)).drop("valid")


@query("op11_piece_backtrack")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    (docs,) = tables(spark, sf_dir, ["documents"])
    return piece_backtrack.encode_documents(docs, public_tokenizers.path("piece_bpe_32k.model"), with_ids=False)


@query("op12_pair_bitmaps")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    (docs,) = tables(spark, sf_dir, ["documents"])
    return pair_bitmaps.align_documents(
        docs, public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
    )


@query("op13_turn_repair")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    (turns,) = tables(spark, sf_dir, ["conversations"])
    return turn_repair.repair_digest(turns, turn_repair.damage(turns))


def queries() -> dict[str, Query]:
    return dict(QUERIES)


def oracles() -> dict[str, str]:
    return dict(ORACLES)
