"""Corpus pipeline: toxicity, near-duplicates, benchmark decontamination, personal data, packing.

Each stage takes (spark, docs, sf_dir), works on all rows its predecessor kept and
returns a DataFrame that ``run`` writes as Parquet and reads again for the next stage.
All but the last return the columns of documents.

Defined results, the same in every stage: a null text counts as an empty one; the empty
text is neither toxic, a near-duplicate, contaminated nor personal, so such documents are
kept (and packed as documents without tokens); rows with a null or repeated id are judged
each for itself; an empty table gives an empty table; extra columns, whatever their names,
stay as they are until packing drops them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.llm import toxicity
from ledgerlake.llm.common import staged, table
from ledgerlake.llm.decontaminate import drop_contaminated
from ledgerlake.llm.minhash import keep_one_of_each
from ledgerlake.llm.packing import pack
from ledgerlake.llm.pii import sanitise
from ledgerlake.llm.queries import may_learn_toxicity


# Rows of whole documents that go to a Python worker at once.  Spark's default of 10,000 fills up to 64 MB a task on
# either side of the pipe; a few hundred cost nothing and leave that memory to the executor.
ARROW_ROWS = 500


def _small_batches(spark: SparkSession) -> None:
    """The pipeline's own session option; it holds when the returned plans run."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ARROW_ROWS))


def toxic_go(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents below the toxicity threshold of their language."""
    _small_batches(spark)
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"), allowed=may_learn_toxicity)
    return toxicity.drop_toxic(docs, model)


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group (five-word shingles, similarity 0.8 or more)."""
    _small_batches(spark)
    return keep_one_of_each(docs, words=5)


def contaminated_go(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any ten-word window of a benchmark item."""
    _small_batches(spark)
    return drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def personal_data_masked(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, identifiers and revealing terms replaced; ``n_chars`` counts the new text."""
    _small_batches(spark)
    out = sanitise(docs)
    names = out.columns
    if "n_chars" not in names:
        return out
    flat = out.toDF(*[f"_c{i}" for i in range(len(names))])          # by position: extra columns may differ by case only
    kind = out.schema.fields[names.index("n_chars")].dataType
    counted = {names.index("n_chars"): F.length(f"_c{names.index('text')}").cast(kind)}
    return flat.select(*[counted.get(i, F.col(f"_c{i}")).alias(name) for i, name in enumerate(names)])


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents in length buckets and token-budget batches."""
    return pack(docs)


STAGES = [("toxicity", toxic_go), ("near_duplicates", one_of_each), ("decontamination", contaminated_go),
          ("personal_data", personal_data_masked), ("packing", packed)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs


# Training and the co-occurrence statistics cannot be said in SQL; tests compare the stages with brute force.
ORACLE_SQL = None

QUERIES = {"pipeline": run}
ORACLE = {} if ORACLE_SQL is None else {"pipeline": ORACLE_SQL}
