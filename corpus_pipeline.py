"""A training corpus from documents: toxic ones, near copies and benchmark passages go, personal data is masked, the rest packed.

Each stage takes (spark, docs, sf_dir) and returns a table; all but the last return the columns of ``docs``. ``run`` stages
every result in the shared folder, since stages read their input more than once.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rankloom.llm import decontamination, near_copies, packing, personal, toxicity
from rankloom.llm.common import table
from rankloom.storage import stage

REST = "other columns"


def set_aside(docs: DataFrame) -> DataFrame:
    """doc_id, text, and the other columns in one, so that no result column can meet one of them."""
    rest = [F.col(f"`{c}`") for c in docs.columns if c not in ("doc_id", "text")]
    return docs.select("doc_id", "text", F.struct(*rest, F.lit(None).cast("int").alias(REST)).alias(REST))


def restored(rows: DataFrame, docs: DataFrame) -> DataFrame:
    """The columns of ``docs`` again, in their order."""
    return rows.select(*[F.col(c) if c in ("doc_id", "text") else F.col(f"`{REST}`.`{c}`").alias(c) for c in docs.columns])


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below the threshold; the field is fitted on the labelled ones among ``docs``."""
    field = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    scored = toxicity.score_toxicity(set_aside(docs), field)
    return restored(scored.filter(F.col("score") < toxicity.THRESHOLD), docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each class: the document that names it. A class without any id keeps its distinct texts."""
    key = F.xxhash64(F.coalesce(F.col("text").cast("string"), F.lit("")))
    kept = near_copies.near_copies(docs).filter(F.col("doc_id").eqNullSafe(F.col("class_id"))).select(
        F.col("doc_id").alias("kept_id"), F.col("text_key").alias("kept_key")).distinct()
    rows = set_aside(docs).withColumn("text_key", key)
    rows = rows.join(kept, rows["doc_id"].eqNullSafe(kept["kept_id"]) & (rows["text_key"] == kept["kept_key"]), "left_semi")
    return restored(rows.dropDuplicates(["doc_id", "text_key"]), docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which less than a twentieth of the words stand in benchmark passages, unchanged."""
    found = decontamination.judged(decontamination.find_passages(set_aside(docs), table(spark, sf_dir, "benchmark")))
    return restored(found.filter(~F.col("contaminated")), docs)


def mask_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data replaced by its kind; n_chars follows the text."""
    found = personal.label(set_aside(docs), personal.fit(docs)).withColumn("masked", personal.redacted("text", "spans"))
    changed = F.size("spans") > 0
    columns = {c: F.col(f"`{REST}`.`{c}`") for c in docs.columns if c not in ("doc_id", "text")}
    if "n_chars" in columns:
        count = F.length("masked").cast(docs.schema["n_chars"].dataType)
        columns["n_chars"] = F.when(changed, count).otherwise(columns["n_chars"])
    columns |= {"doc_id": F.col("doc_id"), "text": F.col("masked")}
    return found.select(*[columns[c].alias(c) for c in docs.columns])


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of token sequences of all documents."""
    return packing.pack(docs, packing.public_vocabulary())


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", drop_toxic),
    ("near copies", drop_near_copies),
    ("decontamination", drop_contaminated),
    ("personal data", mask_personal_data),
    ("packing", pack),
]
#: The toxicity field, the span classifier and the tokenizer have no SQL form; tests compare the stages with plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "documents")
    for name, step in STAGES[:-1]:
        rows = stage(step(spark, rows, sf_dir), f"corpus-{name.replace(' ', '-')}")
    return STAGES[-1][1](spark, rows, sf_dir)
