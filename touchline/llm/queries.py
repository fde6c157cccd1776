"""The queries of the operators in this subpackage, and the SQL of those that SQL can express."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

import corpus_pipeline
from touchline.llm import (
    language, mixing, near_texts, near_vectors, pieces, quality, rules, shallot, topk, toxicity, urls, warc, whitening,
)
from touchline.llm.batches import reachable
from touchline.session import pin, scratch

def _table(spark: SparkSession, d: str, name: str) -> DataFrame:
    reachable(spark)
    return spark.read.parquet(f"{d}/{name}.parquet")


def _remainder(n: int) -> Column:
    return F.crc32(F.col("doc_id").cast("string")) % n


def _op1(spark, d):
    docs = _table(spark, d, "documents")
    net = language.train(docs, learn=_remainder(4) != 2)
    return language.with_language(docs.select("doc_id", "text"), net).select(
        "doc_id", F.coalesce(_remainder(4) == 2, F.lit(False)).alias("held_out"), "lang_pred", "score"
    )


def _op2(spark, d):
    return mixing.mix(_table(spark, d, "documents").select("doc_id", "source"))


def _op4(spark, d):
    return near_vectors.near_duplicates(_table(spark, d, "embeddings"), with_recall=True)


RULES = [
    ("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"), ("net", "/fr/", "block"),
]
HOSTS = [
    "ads-track.example.com", "adult-x.example.com", "casino-win.example.net", "cheap-pills.example.net",
    "free-bets.example.net", "spam-farm.example.org",
]


def _op3(spark, d):
    rules = _values(spark, RULES, "host, path, verdict")
    hosts = _values(spark, [(h,) for h in HOSTS], "host")
    pages = _table(spark, d, "pages").select("page_id", "url")
    return urls.judge(pages, rules, hosts).select("page_id", "host", "path", "rule", "verdict")


def _values(spark: SparkSession, rows: list[tuple], names: str) -> DataFrame:
    listed = ", ".join("(" + ", ".join(f"'{x}'" for x in row) + ")" for row in rows)
    return spark.sql(f"SELECT * FROM VALUES {listed} AS listed({names})")


def _fits(host: str, path: str = "") -> str:
    return f"((host = '{host}' OR ends_with(host, '.{host}')) AND starts_with(path, '{path}'))"


_LONGEST_FIRST = sorted(RULES, key=lambda r: -len(r[0] + r[1]))
_OP3 = f"""
    WITH parts AS (
        SELECT page_id,
               coalesce(translate(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
               coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path
        FROM pages)
    SELECT page_id, host, path,
           CASE {' '.join(f"WHEN {_fits(h, p)} THEN '{h}{p}'" for h, p, _ in _LONGEST_FIRST)} END AS rule,
           CASE {' '.join(f"WHEN {_fits(h, p)} THEN '{v}'" for h, p, v in _LONGEST_FIRST)}
                WHEN {' OR '.join(map(_fits, HOSTS))} THEN 'block' ELSE 'allow' END AS verdict
    FROM parts
"""


def _op5(spark, d):
    docs = _table(spark, d, "documents").select("doc_id", "text")
    machine = quality.train(docs, _table(spark, d, "labels"), learn=_remainder(5) != 0)
    return quality.with_quality(docs, machine).select(
        "doc_id",
        F.coalesce(_remainder(5) == 0, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= 0.3).cast("int").alias("predicted"),
    )


def _op6(spark, d):
    docs = _table(spark, d, "documents").select("doc_id", "text")
    machine = toxicity.train(docs, _table(spark, d, "labels"), learn=_remainder(5) != 0)
    return toxicity.with_toxicity(docs, machine).select(
        "doc_id",
        F.coalesce(_remainder(5) == 0, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


def _op7(spark, d):
    folder = scratch(spark, "warc")
    warc.write(_table(spark, d, "pages").select("page_id", "url", "html"), folder)
    return warc.resolve(warc.read(spark, folder)).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


_OP7 = """
    WITH p AS (
        SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes,
               sha256(coalesce(html, '')) AS payload_digest
        FROM pages),
    f AS (SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first FROM p)
    SELECT page_id, payload_bytes, payload_digest,
           CASE WHEN payload_bytes >= 100 AND page_id > first THEN 'revisit' ELSE 'response' END AS record_type,
           CASE WHEN payload_bytes >= 100 AND page_id > first THEN first END AS refers_to
    FROM f
"""


def _op8(spark, d):
    return topk.top_k(_table(spark, d, "embeddings").select("vec_id", "embedding"), F.col("vec_id") % 100 == 0)


_OP8 = """
    WITH v AS (
        SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * CAST(x AS DOUBLE))) AS e
        FROM embeddings
        WHERE len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
    s AS (
        SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.e, c.e) AS BIGINT) AS score
        FROM v AS q JOIN v AS c ON q.vec_id % 100 = 0 AND q.vec_id <> c.vec_id AND len(q.e) = len(c.e)),
    r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
    SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM r WHERE rank <= 10
"""


def _op9(spark, d):
    return near_texts.near_duplicates(_table(spark, d, "documents"))


MODEL = "/opt/tokenizers/piece_bpe_32k.model"


def _op10(spark, d, model=MODEL):
    docs = _table(spark, d, "documents").select("doc_id", "text")
    return pieces.with_ids(docs, pieces.load(model)).select("doc_id", "n_ids", "ids", "round_trip")


def _op11(spark, d):
    return shallot.described(shallot.cluster(_table(spark, d, "embeddings").select("vec_id", "embedding")))


def _op12(spark, d):
    by = rules.rules()
    voted = pin(rules.votes(rules.described(_table(spark, d, "documents").select("doc_id", "text")), by).drop("text"))
    return rules.with_verdict(voted, rules.fit(voted, len(by))).select("doc_id", *rules.COUNTS, "base_failed", "kept", "quality")


def _op13(spark, d):
    return whitening.whiten(_table(spark, d, "embeddings").select("vec_id", "embedding"))


def queries() -> dict:
    return {
        "pipeline": corpus_pipeline.run,
        "op1_language_network": _op1,
        "op2_pfair_mix": _op2,
        "op3_url_cascade": _op3,
        "op4_graph_near_vectors": _op4,
        "op5_quality_machine": _op5,
        "op6_toxicity_machine": _op6,
        "op7_warc_revisits": _op7,
        "op8_no_random_access": _op8,
        "op9_forest_near_texts": _op9,
        "op10_piece_ids": _op10,
        "op11_shallot_clusters": _op11,
        "op12_rule_votes": _op12,
        "op13_filtered_whitening": _op13,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op3_url_cascade": _OP3,
        "op7_warc_revisits": _OP7,
        "op8_no_random_access": _OP8,
    }
