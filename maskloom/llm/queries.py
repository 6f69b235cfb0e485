"""The queries of this subpackage, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from maskloom.llm.bpe import bpe_round_trip
from maskloom.llm.common import table
from maskloom.llm.leaks import find_leaks
from maskloom.llm.lines import line_dedup
from maskloom.llm.lm import cross_entropy_difference
from maskloom.llm.negatives import mine_negatives
from maskloom.llm.near import near_groups
from maskloom.llm.secrets import BASE, find_secrets
from maskloom.llm.repeats import remove_repeats
from maskloom.llm.token_files import token_file_round_trip
from maskloom.llm.tokens import attribute_tokens
from maskloom.llm.warc import archive_round_trip
from maskloom.llm.rules import STATS, quality_rules
from maskloom.llm.whiten import whiten

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(function):
        QUERIES[name] = function
        if sql:
            SQL[name] = sql
        return function

    return register


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


LINES_SQL = r"""
with lines as (
  select doc_id, i, line, lower_ascii as key from (
    select doc_id, unnest(range(1, len(parts) + 1)) as i, unnest(parts) as line,
      translate(regexp_replace(unnest(parts), '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g'),
                'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as lower_ascii
    from (select doc_id, string_split(coalesce(text, ''), chr(10)) as parts from documents))),
keys as (
  select key, min(doc_id) as least from lines where length(key) >= 10
  group by key having count(distinct doc_id) >= 2),
kept as (
  select l.doc_id, count(*) as n_lines,
    count(*) filter (where k.key is not null and l.doc_id <> k.least) as n_dropped,
    coalesce(string_agg(l.line, chr(10) order by l.i)
      filter (where k.key is null or l.doc_id = k.least), '') as kept
  from lines l left join keys k on l.key = k.key group by l.doc_id)
"""


@query("op6_line_dedup", LINES_SQL + """
select doc_id, n_lines, n_dropped, sha256(kept) as kept_sha256 from kept
""")
def op6(spark: SparkSession, folder: str) -> DataFrame:
    return line_dedup(table(spark, folder, "documents"), outputs=("n_lines", "n_dropped", "kept_sha256"))


@query("op7_bpe_round_trip")
def op7(spark: SparkSession, folder: str) -> DataFrame:
    return bpe_round_trip(
        table(spark, folder, "documents"), tokenizer=tokenizer_path(),
        outputs=("n_tokens", "ids_sha256", "decoded_sha256"))


@query("op9_quality_rules")
def op9(spark: SparkSession, folder: str) -> DataFrame:
    good = table(spark, folder, "labels").where("quality = 1")
    return quality_rules(table(spark, folder, "documents"), reference=good).select(
        "doc_id", *STATS, "base_failed", "kept", "loss")


@query("op10_near_groups")
def op10(spark: SparkSession, folder: str) -> DataFrame:
    return near_groups(table(spark, folder, "documents")).drop("th")


@query("op8_find_leaks")
def op8(spark: SparkSession, folder: str) -> DataFrame:
    return find_leaks(table(spark, folder, "documents"), table(spark, folder, "benchmark")).drop("th")


@query("op4_find_secrets")
def op4(spark: SparkSession, folder: str) -> DataFrame:
    joined = "array_join(transform({}, s -> concat_ws(':', s.kind, s.start, s.end)), ',')"
    base = "filter(spans, s -> s.kind IN ('assign', 'access', 'hex'))"
    count = "cast(size(filter(spans, s -> s.kind = '{0}')) AS long) AS n_{0}"
    return find_secrets(table(spark, folder, "documents")).selectExpr(
        "doc_id", *[count.format(k) for k in BASE], f"sha2({joined.format(base)}, 256) AS base_sha256",
        f"{joined.format('spans')} AS spans")


@query("op5_remove_repeats")
def op5(spark: SparkSession, folder: str) -> DataFrame:
    return remove_repeats(table(spark, folder, "documents"),
                          outputs=("n_bytes", "n_removed", "n_spans", "kept_sha256"))


@query("op3_archive_round_trip", """
with p as (select page_id, coalesce(html, '') as html from pages),
d as (select page_id, octet_length(encode(html)) as n, sha256(html) as digest from p),
f as (select digest, min(page_id) as first from d where n >= 100 group by digest)
select d.page_id, d.n as payload_bytes, d.digest as payload_digest,
  case when f.first is not null and d.page_id <> f.first then 'revisit' else 'response' end as record_type,
  case when d.page_id <> f.first then f.first end as refers_to
from d left join f on d.digest = f.digest and d.n >= 100
""")
def op3(spark: SparkSession, folder: str) -> DataFrame:
    return archive_round_trip(table(spark, folder, "pages")).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@query("op1_attribute_tokens")
def op1(spark: SparkSession, folder: str) -> DataFrame:
    return attribute_tokens(table(spark, folder, "documents"), tokenizer=tokenizer_path())


@query("op2_cross_entropy_difference")
def op2(spark: SparkSession, folder: str) -> DataFrame:
    return cross_entropy_difference(
        table(spark, folder, "documents"), table(spark, folder, "labels").where("quality = 1"),
        tokenizer=tokenizer_path())


@query("op13_token_files")
def op13(spark: SparkSession, folder: str) -> DataFrame:
    import public_tokenizers

    return token_file_round_trip(table(spark, folder, "documents"), public_tokenizers.path("word_bpe_49k.json"))


@query("op11_whiten")
def op11(spark: SparkSession, folder: str) -> DataFrame:
    return whiten(table(spark, folder, "embeddings"), components=32)


NEGATIVES_SQL = """
with r as (
  select vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label,
    list_transform(embedding, x -> floor(256 * x::double)) as v
  from embeddings where vec_id is not null and label is not null and len(embedding) > 0
    and len(list_filter(embedding, x -> x is null or not isfinite(x))) = 0),
s as (
  select a.vec_id as a, a.label = b.label as same, b.vec_id as b,
    list_inner_product(a.v, b.v)::bigint as score
  from r a join r b on a.vec_id <> b.vec_id where a.vec_id % 50 = 0),
p as (select a, b, score from s where same qualify row_number() over (partition by a order by score desc, b) <= 5)
select p.a as anchor_id, p.b as positive_id,
  row_number() over (partition by p.a, p.b order by s.score desc, s.b)::int as rank,
  s.b as negative_id, p.score as positive_score, s.score as negative_score
from p join s on p.a = s.a and not s.same and 50 * p.score <= 100 * s.score and 100 * s.score <= 95 * p.score
qualify rank <= 3
"""


@query("op12_mine_negatives", NEGATIVES_SQL)
def op12(spark: SparkSession, folder: str) -> DataFrame:
    label = F.expr("if(vec_id % 7 = 0, (label + 1) % 10, label)")
    return mine_negatives(
        table(spark, folder, "embeddings").withColumn("label", label), anchor=F.col("vec_id") % 50 == 0)
