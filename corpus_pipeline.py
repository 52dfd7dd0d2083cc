"""The corpus pipeline: five stages over ``documents``, each written as Parquet and read by the next.

1. quality         documents that the rules or the classifier reject go
2. near_duplicates one row of each group of near duplicates stays: the one of least id
3. substrings      passages of 50 words that a document of smaller id has too go from the text
4. mixture         documents are repeated or left out so that sources meet their target weights
5. packing         what remains is packed into windows of 4096 tokens; the last stage returns pieces

A stage takes (spark, docs, sf_dir) and works on all that its predecessor kept. All but the last return
the columns of ``documents``; where a text changes, ``n_chars`` is its new length. A document all of
whose words are removed stays with an empty text. Rows without an id count as those of the largest id.
Null and empty texts have no words: the first stage rejects them. Rows that are equal in all columns are equal to every
stage: which of them goes or stays does not matter. Without labels the first stage applies its base rules alone. Further
columns, whatever their names, are not read. An empty table passes every stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.llm.common import materialise
from tidewater.llm.fm_dedup import remove_repeated_passages
from tidewater.llm.jaccard import one_per_component
from tidewater.llm.mixing import mix
from tidewater.llm.packing import pack
from tidewater.llm.quality import judge_quality

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    judged = judge_quality(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"), carry=("text", "lang", "source", "n_chars"))
    return judged.filter("kept").select(*COLUMNS)


def near_duplicate_groups(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of a group the row of least id stays, one without an id only where no row has one; of several with that id the one of least text."""
    return one_per_component(docs, carry=("lang", "source", "n_chars")).select(*COLUMNS)


def substrings(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A text that loses words is its other words, joined by single spaces; other texts stay as they are."""
    done = remove_repeated_passages(docs, carry=("text", "lang", "source", "n_chars"))
    cut = F.col("n_removed") > 0
    return done.select("doc_id", F.when(cut, F.col("kept")).otherwise(F.col("text")).alias("text"), "lang", "source",
                       F.when(cut, F.length("kept").cast("long")).otherwise(F.col("n_chars")).alias("n_chars"))


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix takes it. Rows that are equal in all columns share their copies."""
    row = F.concat(F.hex(F.xxhash64("doc_id", "lang", "source", "n_chars")), F.coalesce(F.md5(F.col("text").cast("binary")), F.lit("")))
    keyed = docs.select(*COLUMNS, row.alias("row"))
    taken = mix(keyed, id_col="row").groupBy(F.col("doc_id").alias("row")).agg(F.sum("copies").cast("int").alias("copies"),
                                                                               F.count(F.lit(1)).alias("rows"))
    taken = materialise(taken.filter("copies > 0"), "pipeline-copies")
    single = keyed.join(taken.filter("rows = 1"), "row")
    several = keyed.join(taken.filter("rows > 1"), "row").dropDuplicates(["row"])
    return single.unionByName(several).withColumn("copy", F.explode(F.array_repeat(F.lit(1), F.col("copies")))).select(*COLUMNS)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [("quality", quality), ("near_duplicates", near_duplicate_groups), ("substrings", substrings), ("mixture", mixture),
          ("packing", packing)]

#: SQL cannot express the classifier, the tokenizer or the service order: see tests/llm/test_pipeline.py.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over ``documents``; the pieces of the last one."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
