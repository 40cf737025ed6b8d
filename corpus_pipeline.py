"""A training corpus from raw documents, in five stages.

Each stage takes (spark, docs, sf_dir), works on all that its predecessor kept, and returns a
DataFrame; all but the last return the columns of ``documents``. ``run`` writes the result of each
stage as Parquet in the shared folder and reads it again for the next. Extra columns of any name
go along through all stages but the last; empty tables give empty results.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from talkgrain.llm.common import text_key
from talkgrain.llm.decontaminate import contaminated
from talkgrain.llm.packing import pack
from talkgrain.llm.quality import keep_good
from talkgrain.llm.queries import SCHEMAS
from talkgrain.llm.secrets import content_address, find_secrets, redacted
from talkgrain.llm.simhash import one_of_each_group
from talkgrain.sources.shared import shared_folder


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep.

    A null, empty or blank text has no word and goes, and so does one of fewer than 20 words; a
    very long text is read whole. Equal rows share their verdict, so all of them stay or go.
    """
    return keep_good(docs)


def one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: the one with the smallest id.

    Near copies are linked by fingerprints of three-word shingles that differ in 3 bits or fewer.
    Texts without words are one group. A null id is larger than any other; of rows of one id the
    one whose text has the smallest hash stays, and of equal rows one.
    """
    return one_of_each_group(docs, shingle=3, most_bits=3)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark.

    A text without words (null, empty, blank) has none and stays. Rows of one id are judged by
    their own text, and equal rows alike.
    """
    benchmark = spark.read.schema(SCHEMAS["benchmark"]).parquet(f"{sf_dir}/benchmark.parquet")
    found = contaminated(docs, benchmark).where("n_hit > 0")
    bad = found.select(F.col("doc_id").alias("id"), F.col("_key").alias("key")).distinct()
    rows = docs.select(
        F.struct("*").alias("row"),
        F.col("doc_id").alias("doc"),
        text_key(F.col("text")).alias("text_key"),
    )
    same = F.col("doc").eqNullSafe(F.col("id")) & (F.col("text_key") == F.col("key"))
    return rows.join(bad, same, "anti").select("row.*")


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with every secret in their text replaced, and their length counted anew.

    Every row stays. One without a secret is as it was, nulls included; equal texts are scanned
    once and changed alike.
    """
    ledger = shared_folder(spark, "secret-ledger")
    found = find_secrets(docs, ledger).where(F.size("spans") > 0).select("blob", "spans").distinct()
    rows = docs.select(F.struct("*").alias("row"), content_address(F.col("text")).alias("address"))
    joined = rows.join(found, F.col("address") == F.col("blob"), "left")
    changed = F.when(F.col("spans").isNotNull(), redacted(F.col("row.text"), F.col("spans")))
    done = joined.select("row", changed.alias("changed"))
    new = {
        "text": F.coalesce("changed", F.col("row.text")),
        "n_chars": F.coalesce(F.length("changed").cast("long"), F.col("row.n_chars")),
    }
    return done.select(*(new.get(c, F.col("row")[c]).alias(c) for c in docs.columns))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The place of each document in sequences of fixed length.

    A null text is the end of a document alone. Rows that are repeated are placed each.
    """
    return pack(docs)


STAGES = [
    ("quality rules", quality),
    ("SimHash near-dedup", one_of_near_copies),
    ("benchmark decontamination", decontaminated),
    ("secret scans", without_secrets),
    ("best-fit packing", packed),
]

# Weak supervision, fingerprints and best fit are not expressed in SQL; the stages are tested
# against plain versions in tests/llm.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.schema(SCHEMAS["documents"]).parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        folder = shared_folder(spark, name.replace(" ", "-"))
        stage(spark, docs, sf_dir).write.parquet(folder)
        docs = spark.read.parquet(folder)
    return docs
