"""The training-data pipeline: one stage after the other, each written and read again.

Every stage reads all its predecessor kept and returns the columns of `documents`; the last one
gives the ids of SentencePiece and the text they decode to. SQL cannot express the first and the
last stage, so there is no SQL for the whole.

Rows are told apart by their place, the file and the row in it, so ids may be null or repeat.
Only places go through joins; texts stay in the task that reads them. Further columns of the
input are carried in one struct, so no name of theirs can clash, and come out as they were.

Defined results, for each stage: an empty table gives an empty one. A null text counts as empty;
language ID drops it, as it drops every text without a letter. Null ids are ids like any other;
where the stage picks a row by its id, a null one is picked last. Of rows equal in all columns
one stays where texts must differ, and the first in place decides between equal ids. A very long
text is one row like any other and is never cut.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tiffin.llm import exact, languages, mixing, pieces, routing, simhash
from tiffin.llm.common import documents, small_batches, stored

SHINGLE = 5  # words
STORE_WORDS = 100_000  # executors still hold what earlier stages left in memory


def _placed(docs: DataFrame) -> DataFrame:
    """(row, place): the columns of each row as one struct, and where the row lies.

    Rows that do not come straight from Parquet files are written first.
    """
    row = F.struct(*[F.col(_quoted(c)) for c in docs.columns]).alias("row")
    place = F.struct(
        F.xxhash64("_metadata.file_path").alias("file"),
        F.col("_metadata.row_index").alias("line"),
    ).alias("place")
    try:
        return docs.select(row, place)
    except AnalysisException:
        return stored(docs, "pipeline-rows").select(row, place)


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _field(name: str):
    return F.col("row").getField(name)


def _columns(rows: DataFrame, docs: DataFrame, **changed) -> DataFrame:
    """The columns of `docs` out of the struct, some of them replaced."""
    return rows.select(
        *[changed.get(c, _field(c)).alias(c) for c in docs.columns]
    )


def identified(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Puts the predicted language into `lang`; drops documents without one: no text, no letters.

    Without any labelled row nothing can be told, and nothing is rejected.
    """
    small_batches(spark)
    model = languages.train(docs, ~languages.held_out(F.col("doc_id")))
    if model is None:
        return docs
    row = F.struct(*[F.col(_quoted(c)) for c in docs.columns]).alias("row")
    found = languages.identify(docs.select(row, "text"), model, id_col="row")
    rows = found.withColumnRenamed("id", "row").where(F.col("lang_pred") != languages.UNKNOWN)
    return _columns(rows, docs, lang=F.col("lang_pred"))


def distinct(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents with equal texts, A-Z and a-z being the same, the one with the largest id
    stays."""
    small_batches(spark)
    rows = _placed(docs)
    name = F.struct(_field("doc_id").alias("doc_id"), "place").alias("name")
    found = exact.exact_duplicates(rows.select(name, _field("text").alias("text")), id_col="name")
    gone = stored(found.where("NOT kept").select("id.place"), "pipeline-copies")
    return _columns(routing.without(rows, "place", gone), docs)


def apart(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies the document with the smallest id stays, null being largest.

    Near copies share five-word shingles to 0.8 or more, as 256 bits of SimHash tell it.
    """
    small_batches(spark)
    rows = _placed(docs)
    id_ = _field("doc_id")
    name = F.struct(id_.isNull().alias("unnamed"), id_.alias("doc_id"), "place").alias("name")
    groups = simhash.near_duplicates(
        rows.select(name, _field("text").alias("text")), SHINGLE, simhash.SIMILAR, id_col="name"
    )
    others = groups.where(F.col("id.place") != F.col("component_id.place"))
    gone = stored(others.select("id.place"), "pipeline-near-copies")
    return _columns(routing.without(rows, "place", gone), docs)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix of its source takes it."""
    return mixing.mix(docs)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, ids, decoded) of every copy in the mix."""
    small_batches(spark)
    import public_tokenizers

    rows = pieces.encode(
        docs, public_tokenizers.path("piece_bpe_32k.model"), decoded=True, store_words=STORE_WORDS
    )
    return rows.select(F.col("id").alias("doc_id"), "ids", "decoded")


STAGES = [
    ("language_id", identified),
    ("exact_dedup", distinct),
    ("simhash_dedup", apart),
    ("mix_sources", mixed),
    ("sentencepiece", encoded),
]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`; between two of them the rows are written to Parquet."""
    docs = documents(spark, sf_dir)
    for place, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if place + 1 < len(STAGES):
            docs = stored(docs, f"stage-{name}")
    return docs
