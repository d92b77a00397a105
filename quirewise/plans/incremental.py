"""Queries over the processing state: what the next run has to take in."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quirewise.operators.incremental import normal_state, pending_keys
from quirewise.storage import table


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Chunks whose present state no committed run has taken in."""
    content = {c: F.col(c) for c in ("first_page", "last_page", "equation_count", "figure_count", "error")}
    content |= {c: normal_state(c) for c in ("detection_state", "equation_state")}
    return pending_keys(table(spark, sf_dir, "chunks"), table(spark, sf_dir, "selection_inventories"), ["book", "chunk_number"], content)


QUERIES = {"p2_found": p2_found}

SQL = {
    "p2_found": r"""
    WITH rows AS (
      SELECT sequence, min(arrived_at) AS arrived_at, min(book) AS book, min(chunk_number) AS chunk_number,
        min({'a': first_page, 'b': last_page, 'c': equation_count, 'd': figure_count, 'e': error,
          'f': lower(regexp_replace(detection_state, '^\s+|\s+$', '', 'g')),
          'g': lower(regexp_replace(equation_state, '^\s+|\s+$', '', 'g'))}) AS content
      FROM chunks WHERE sequence IS NOT NULL AND book IS NOT NULL AND chunk_number IS NOT NULL GROUP BY sequence),
    taken AS (
      SELECT r.*, EXISTS (SELECT 1 FROM selection_inventories i WHERE lower(regexp_replace(i.outcome, '^\s+|\s+$', '', 'g')) = 'committed'
        AND r.sequence BETWEEN i.first_sequence AND i.last_sequence AND r.arrived_at <= i.started_at) AS taken
      FROM rows r),
    latest AS (
      SELECT book, chunk_number, max(sequence) AS now_at, max(sequence) FILTER (WHERE taken) AS then_at FROM taken GROUP BY 1, 2)
    SELECT l.book, l.chunk_number FROM latest l
    LEFT JOIN taken n ON n.sequence = l.now_at LEFT JOIN taken t ON t.sequence = l.then_at
    WHERE l.then_at IS NULL OR n.content IS DISTINCT FROM t.content""",
}
