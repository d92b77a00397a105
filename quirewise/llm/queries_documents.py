"""Queries over documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quirewise.llm.abuse import fit, scored, source_rates, training
from quirewise.llm.leakage import leaked
from quirewise.llm.sqlforms import look_sql
from quirewise.llm.mixing import mixture, mixture_report, token_counts
from quirewise.storage import table


def p7_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents and the test items they leak."""
    return leaked(table(spark, sf_dir, "documents"), table(spark, sf_dir, "eval_items")).select("doc_id", "item_id").distinct()


def p7_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of each leaked test item: the documents, and the longest passage in words."""
    found = leaked(table(spark, sf_dir, "documents"), table(spark, sf_dir, "eval_items"))
    return found.groupBy("item_id").agg(F.countDistinct("doc_id").alias("documents"), F.max(F.col("last_word") - F.col("first_word") + 1).cast("bigint").alias("longest"))


def p8_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shares of the mixture of all documents by the target weights, in tokens of a public tokenizer."""
    return mixture_report(token_counts(table(spark, sf_dir, "documents")), table(spark, sf_dir, "mix_targets"))


def p8_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The mixture itself: how often each document is used."""
    return mixture(token_counts(table(spark, sf_dir, "documents")), table(spark, sf_dir, "mix_targets"))


def p9_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its score, its worst sentence and the offending ones."""
    documents = table(spark, sf_dir, "documents")
    return scored(documents, fit(*training(table(spark, sf_dir, "toxicity_labels"), documents)))


def p9_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with an abusive, hateful or sexual sentence."""
    return p9_scores(spark, sf_dir).where("abusive").select("doc_id").distinct()


def p9_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The share of such documents by source."""
    return source_rates(table(spark, sf_dir, "documents"), p9_scores(spark, sf_dir))


QUERIES = {"p7_found": p7_found, "p7_items": p7_items, "p8_shares": p8_shares, "p8_mixture": p8_mixture, "p9_found": p9_found, "p9_scores": p9_scores, "p9_rates": p9_rates}
# A break at a line's end may be read joined or split; passages are looked for in texts read either way.
_BROKEN = r"([\p{L}\p{N}_])(?:[-‐‑–­¬][ \t]*\n\s*)([\p{L}\p{N}_])"


def _grams(table_name: str, key: str) -> str:
    ways = " UNION ALL ".join(
        f"SELECT {key}, lower(replace({look_sql(f"regexp_replace(text, '{_BROKEN}', '{by}', 'g')")}, 'ß', 'ss')) AS look FROM {table_name} WHERE {key} IS NOT NULL AND text IS NOT NULL"
        for by in (r"\1\2", r"\1 \2")
    )
    return f"""SELECT DISTINCT {key}, array_to_string(words[i : i + 11], ' ') AS gram FROM (SELECT {key}, words, unnest(range(1, len(words) - 10)) AS i
      FROM (SELECT {key}, regexp_extract_all(look, '[\\p{{L}}\\p{{N}}]+') AS words FROM ({ways})) WHERE len(words) >= 12)"""


SQL = {"p7_found": f"SELECT DISTINCT doc_id, item_id FROM ({_grams('documents', 'doc_id')}) d JOIN ({_grams('eval_items', 'item_id')}) i USING (gram)"}
