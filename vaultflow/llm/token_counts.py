"""Token counts: an exact histogram of encoded lengths answers totals, quantiles and truncated
totals for every context limit.

Defined results: a null text is empty and has length 0; an empty table gives an empty histogram;
repeated rows count as often as they stand; null ids count; other columns are never read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from vaultflow.llm._common import id_type, map_batches, materialise, read_table, schema_of, texts_of
from vaultflow.llm.tokens import encoder

#: Lengths in one block of the suffix sums; a text has under 2**31 bytes, so there are at most 2**19 blocks.
BLOCK = 4096


def encoded_lengths(docs: DataFrame, tokenizer_path: str | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_tokens of every whole text."""

    def run(batches):
        own = encoder(tokenizer_path)
        for b in batches:
            yield {"doc_id": b.column(0), "n_tokens": [own.count(x) for x in b.column(1).to_pylist()]}
        own.forget()

    return map_batches(texts_of(docs, id_col, text_col), run, schema_of(f"doc_id {id_type(docs, id_col)}, n_tokens bigint"))


def length_histogram(lengths: DataFrame) -> DataFrame:
    """length, n_docs: one row for each length there is."""
    return lengths.groupBy(F.col("n_tokens").alias("length")).agg(F.count(F.lit(1)).alias("n_docs"))


def suffix_sums(histogram: DataFrame) -> DataFrame:
    """For each length L of the histogram, as a context limit:

    n_docs, n_tokens: of length L; docs_within, tokens_within: of length <= L;
    docs_longer, tokens_longer: of length > L; truncated_tokens: the sum of min(length, L).

    The sums run within blocks of BLOCK lengths, and over the blocks' totals.
    """
    h = histogram.select("length", "n_docs", (F.col("length") * F.col("n_docs")).alias("n_tokens"), F.floor(F.col("length") / BLOCK).alias("block"))
    sums = ("n_docs", "n_tokens")
    over = Window.orderBy(F.col("block").desc()).rowsBetween(Window.unboundedPreceding, -1)
    blocks = h.groupBy("block").agg(*(F.sum(c).alias(f"all_{c}") for c in sums))
    blocks = blocks.select("block", *(F.coalesce(F.sum(f"all_{c}").over(over), F.lit(0)).alias(f"beyond_{c}") for c in sums), *(F.sum(f"all_{c}").over(Window.partitionBy(F.lit(1))).alias(f"total_{c}") for c in sums))
    inside = Window.partitionBy("block").orderBy(F.col("length").desc()).rowsBetween(Window.unboundedPreceding, -1)
    h = h.select("*", *(F.coalesce(F.sum(c).over(inside), F.lit(0)).alias(f"after_{c}") for c in sums)).join(blocks, "block")
    longer = {c: F.col(f"after_{c}") + F.col(f"beyond_{c}") for c in sums}
    return h.select(
        "length", "n_docs", "n_tokens",
        (F.col("total_n_docs") - longer["n_docs"]).alias("docs_within"), (F.col("total_n_tokens") - longer["n_tokens"]).alias("tokens_within"),
        longer["n_docs"].alias("docs_longer"), longer["n_tokens"].alias("tokens_longer"),
        (F.col("total_n_tokens") - longer["n_tokens"] + F.col("length") * longer["n_docs"]).alias("truncated_tokens"),
    )


def at_limits(sums: DataFrame, limits: list[int]) -> DataFrame:
    """limit, n_docs, n_tokens, truncated_tokens, docs_longer for any limits, from suffix sums alone."""
    spark = sums.sparkSession
    asked = spark.createDataFrame([(int(x),) for x in limits], "`limit` bigint")
    total = sums.agg(F.coalesce(F.sum("n_docs"), F.lit(0)).alias("n_docs"), F.coalesce(F.sum("n_tokens"), F.lit(0)).alias("n_tokens"))
    below = (
        F.broadcast(asked).join(sums, F.col("length") <= F.col("limit"), "left")
        .groupBy("limit").agg(F.coalesce(F.sum(sums["n_docs"]), F.lit(0)).alias("docs_within"), F.coalesce(F.sum(sums["n_tokens"]), F.lit(0)).alias("tokens_within"))
    )
    longer = F.col("n_docs") - F.col("docs_within")
    return below.join(F.broadcast(total)).select("limit", "n_docs", "n_tokens", (F.col("tokens_within") + F.col("limit") * longer).alias("truncated_tokens"), longer.alias("docs_longer"))


def quantile(sums: DataFrame, q: float) -> int | None:
    """The least length that at least the share q of all documents doesn't exceed; None for no documents."""
    return sums.filter(F.col("docs_within") >= F.ceil(F.lit(float(q)) * (F.col("docs_within") + F.col("docs_longer")))).agg(F.min("length")).first()[0]


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    histogram = length_histogram(encoded_lengths(read_table(spark, sf_dir, "documents")))
    return suffix_sums(materialise(histogram, "histogram"))  # it is read twice
