"""Text, chat and preference inputs, with ordered fallback."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textloom.functions import text as tx
from textloom.operators.sampling import first_rows

Reader = Callable[[SparkSession], DataFrame]

SMOKE_SENTENCES = (
    "A corpus pipeline reads many documents, drops the damaged and repeated ones, and hands clean text "
    "to the tokenizer in a stable order.",
    "Every shard holds the same number of packed sequences, so a training job can seek to any position "
    "without reading the others first.",
    "Near copies waste training time; comparing short signatures instead of whole documents finds them "
    "at a small part of the cost.",
    "Small fixed inputs like these four sentences only show that all stages fit together from the first "
    "to the last, nothing more.",
)

CHAT_FALLBACK = {
    "instruction": "Why does the moon change its shape?",
    "output": "It does not: we see the part that the sun lights up, and that part changes as the moon goes round us.",
}
PAIR_FALLBACK = {
    "prompt": "Why does the moon change its shape?",
    "chosen": "We see a different part of its sunlit half as it goes round the earth.",
    "rejected": "Clouds cover it a little more every night.",
}


def table(path: str, fmt: str = "parquet", **options: str) -> Reader:
    """A reader for a Parquet, JSON or text input."""
    return lambda spark: spark.read.format(fmt).options(**options).load(path)


def text_rows(
    df: DataFrame, text_field: str = "text", language: str = "en", min_score: float = 0.9
) -> DataFrame:
    """All columns with ``text`` set from ``text_field``, in the wanted language and not blank."""
    if df.schema.names == ["value"]:
        df = df.withColumnRenamed("value", text_field)
    kept = tx.language_filter(df, language, min_score)
    return kept.withColumn("text", tx.text_value(df.schema, text_field)).filter(tx.is_not_blank(F.col("text")))


def first_available(
    spark: SparkSession, readers: Sequence[Reader], prepare: Callable[[DataFrame], DataFrame] = lambda df: df
) -> DataFrame | None:
    """The first input that opens and has a row left after ``prepare``; None when none has."""
    for reader in readers:
        try:
            df = prepare(reader(spark))
            if not df.isEmpty():
                return df
        except AnalysisException:
            continue
    return None


def smoke_corpus(spark: SparkSession, rows: int) -> DataFrame:
    """(doc_id, text): the built-in sentences over and over."""
    sentences = F.array(*[F.lit(s) for s in SMOKE_SENTENCES])
    at = (F.col("id") % len(SMOKE_SENTENCES)).cast("int")
    return spark.range(rows).select(F.col("id").alias("doc_id"), F.get(sentences, at).alias("text"))


def text_source(
    spark: SparkSession,
    readers: Sequence[Reader],
    text_field: str = "text",
    language: str = "en",
    min_score: float = 0.9,
    smoke_rows: int = 2000,
) -> DataFrame:
    """Filtered text from the first usable reader, or the smoke corpus."""
    found = first_available(spark, readers, lambda df: text_rows(df, text_field, language, min_score))
    return smoke_corpus(spark, smoke_rows) if found is None else found


def chat_source(
    spark: SparkSession, readers: Sequence[Reader], order: str, max_samples: int | None = None
) -> DataFrame:
    """Chat examples from the first reader that opens, cut to the first rows."""
    found = first_available(spark, readers)
    return spark.createDataFrame([CHAT_FALLBACK]) if found is None else first_rows(found, order, max_samples)


def preference_source(
    spark: SparkSession, readers: Sequence[Reader], order: str, max_samples: int | None = None
) -> DataFrame:
    """Preference pairs from the first reader that opens, cut to the first rows."""
    found = first_available(spark, readers)
    return spark.createDataFrame([PAIR_FALLBACK]) if found is None else first_rows(found, order, max_samples)


def conversation_messages(turns: DataFrame) -> DataFrame:
    """(conv_id, messages) from one row per turn; a group holds the turns of one conversation."""
    turn = F.struct("turn", "role", F.col("text").alias("content"))
    return (
        turns.groupBy("conv_id")
        .agg(F.sort_array(F.collect_list(turn)).alias("turns"))
        .select(
            "conv_id",
            F.transform("turns", lambda t: F.struct(t["role"].alias("role"), t["content"].alias("content"))).alias(
                "messages"
            ),
        )
    )
