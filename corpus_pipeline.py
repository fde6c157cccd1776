"""A training corpus from raw documents: language, quality, near-duplicates, mixture, ids.

Each stage is ``(name, function)``; a function takes ``(spark, docs, sf_dir)`` and returns a DataFrame,
which ``run`` writes as Parquet and reads again as the next one's ``docs``. All but the last return the
columns of ``docs`` as they are, whatever their names. The ids leave in the order of the mixture.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F

from touchline.llm import language, mixing, near_texts, pieces, quality
from touchline.llm.batches import reachable
from touchline.session import pin

LEAST_LANGUAGE = 0.4
LEAST_QUALITY = 0.3
LEAST_COMMON = 80
MODEL = "/opt/tokenizers/piece_bpe_32k.model"


def _aside(docs: DataFrame) -> tuple[DataFrame, dict[str, str]]:
    """``docs`` under names that no operator uses, and the new name of each column."""
    names = {c: f"given_{i}" for i, c in enumerate(docs.columns)}
    return docs.toDF(*names.values()), names


def _back(found: DataFrame, names: dict[str, str]) -> DataFrame:
    return found.select(*names.values()).toDF(*names)


def of_known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is known: those without a letter go, and those of a low score.

    Labels are the documents' own ``lang``, of a bounded sample.
    """
    plain, names = _aside(docs)
    net = language.train(docs.select("doc_id", "text", "lang"))
    found = language.with_language(plain, net, names["text"])
    kept = (F.col("lang_pred") != language.UNKNOWN) & (F.col("score") >= LEAST_LANGUAGE)
    # Where there is no label at all there is nothing to learn, and nothing to reject but texts without letters.
    return _back(found.where(kept if net else F.col(names["text"]).rlike(r"\p{L}")), names)


def of_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality machine does not reject. It learns from a bounded sample of ``labels``."""
    plain, names = _aside(docs)
    machine = quality.train(docs.select("doc_id", "text"), spark.read.parquet(f"{sf_dir}/labels.parquet"))
    found = quality.with_quality(plain, machine, names["text"])
    return _back(found.where(F.col("score") >= LEAST_QUALITY), names)


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates the document with the smallest id; links are at ``LEAST_COMMON`` percent.

    Of a group's rows that share that id one stays. A text without words is no duplicate of any, but rows that
    repeat both id and text are one document.
    """
    plain, names = _aside(docs)
    id_, text = names["doc_id"], names["text"]
    near = pin(near_texts.firsts(plain, LEAST_COMMON, id_, text))
    # Ids that need a look, with what to do; all others stay.
    odd = near.groupBy("doc_id").agg(F.max("first").alias("first"), F.count("*").alias("times"))
    odd = pin(odd.where("NOT first OR times > 1"))
    known = F.broadcast(odd) if odd.count() <= near_texts.BROADCAST_ROWS else odd
    judged = plain.join(known, plain[id_].eqNullSafe(known["doc_id"]), "left").where("first IS NULL OR first")
    once = judged.where("times IS NULL OR times = 1").select(*plain.columns)
    if odd.where("times > 1").limit(1).count() == 0:
        return _back(once, names)
    # Rows of a repeated id are told apart by their texts.
    again = near_texts.with_identity(judged.where("times > 1").select(*plain.columns), text, "cid")
    kept = near.where("first AND cid IS NOT NULL").select("doc_id", F.col("cid").alias("own")).distinct()
    worded = again.join(kept, (F.col("cid") == F.col("own")) & F.col(id_).eqNullSafe(F.col("doc_id")), "left_semi")
    worded = worded.dropDuplicates([id_, "cid"]).select(*plain.columns)
    blank = again.where("cid IS NULL").select(*plain.columns).dropDuplicates([id_, text])
    return _back(once.unionByName(worded).unionByName(blank), names)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents in the order of the mixture of sources: from partition to partition and within each by tick."""
    plain, names = _aside(docs)
    found = mixing.mix(plain, source=names["source"], id_=names["doc_id"])
    return _back(found.orderBy("tick", names["doc_id"]), names)


def _as_written(docs: DataFrame) -> DataFrame:
    """Rows read from Parquet in the order in which they were written; a reader takes large files first.

    Files are numbered by the partition that wrote them. Rows not read from files come in an order of their own
    and keep it; the joins of the mixture hide the files that its documents came from.
    """
    places = [F.col("_metadata.file_name"), F.col("_metadata.row_index")]
    try:
        docs.select(*places)
    except AnalysisException:
        return docs
    return docs.orderBy(*places)


def as_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """SentencePiece ids of each document: ``doc_id``, ``source``, ``lang``, ``n_ids``, ``ids``, ``round_trip``, ``position``.

    They come in the order in which the mixture wrote the documents, from partition to partition. ``position`` rises
    with it, with gaps where a partition ends.
    """
    place = F.monotonically_increasing_id().alias("position")
    picked = _as_written(docs).select("doc_id", "source", "lang", "text", place)
    return pieces.with_ids(picked, pieces.load(MODEL)).drop("text")


STAGES = [
    ("language", of_known_language),
    ("quality", of_quality),
    ("near duplicates", one_of_each_group),
    ("mixture", mixed),
    ("piece ids", as_ids),
]

# Trained models and links across texts are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    reachable(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES:
        docs = pin(stage(spark, docs, sf_dir))
    return docs.orderBy("position").drop("position")
