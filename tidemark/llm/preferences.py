"""Preference formatting of chosen and rejected conversations.

Turns of both conversations are laid side by side by position; the first position where
they differ ends the longest common prefix. Turns before it are rendered once as the
prompt, later ones as the chosen and the rejected completion, and of these only what the
assistant says is trained on. Rows are segments, so no task gathers a conversation.

Null roles are ``user`` and null texts empty. Rows of one turn number stand one after
another by role and text. Pairs whose conversations agree are all prompt. Rows without a
pair or turn number belong to no conversation and are left out. Ids and turn numbers need
not be dense. A text of any length is one segment; repeated rows are turns of their own;
other columns, whatever their names, do not matter, and an empty table gives no row.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.llm.common import stored
from tidemark.operators.sequence import numbered

#: How a turn is written; what the assistant says runs from the end of the head on.
HEAD = ("<|im_start|>", "\n")
TAIL = "<|im_end|>\n"
TRAINED = "assistant"


def turns(table: DataFrame, key: str = "conv_id") -> DataFrame:
    """``pair_id``, ``turn``, ``nth`` row of the turn, ``role`` and ``text``."""
    rows = table.select(
        F.col(key).cast("bigint").alias("pair_id"), F.col("turn").cast("bigint").alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit("user")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")).filter(
        F.col("pair_id").isNotNull() & F.col("turn").isNotNull())
    order = Window.partitionBy("pair_id", "turn").orderBy("role", "text")
    return rows.withColumn("nth", F.row_number().over(order).cast("bigint"))


def format_preferences(chosen: DataFrame, rejected: DataFrame) -> DataFrame:
    """Segments (pair_id, part, turn, nth, role, segment, mask_from, mask_to) of tables of
    ``turns``. ``part`` is prompt, chosen or rejected; the code points of ``segment`` from
    ``mask_from`` up to ``mask_to`` are trained on, none where these are null.
    """
    # Turns are compared by 128 bits of hash, so that texts move only to be labelled.
    narrow = [side.select(
        "pair_id", "turn", "nth", F.lit(i).alias("side"),
        F.struct(F.xxhash64("role", "text"), F.xxhash64(F.lit(1), "text", "role")).alias("said"))
        for i, side in enumerate((chosen, rejected))]
    laid = narrow[0].unionByName(narrow[1]).groupBy("pair_id", "turn", "nth").agg(
        *[F.max(F.when(F.col("side") == i, F.col("said"))).alias(f"said{i}") for i in (0, 1)])
    ends = laid.filter(~F.col("said0").eqNullSafe(F.col("said1"))).groupBy("pair_id").agg(
        F.min(F.struct("turn", "nth")).alias("end"))
    before = F.col("end").isNull() | (F.struct("turn", "nth") < F.col("end"))
    columns = ["pair_id", "part", "turn", "nth", "role", "text"]
    rows = chosen.join(ends, "pair_id", "left").withColumn(
        "part", F.when(before, "prompt").otherwise("chosen")).select(columns).unionByName(
        rejected.join(ends, "pair_id").filter(~before).withColumn(
            "part", F.lit("rejected")).select(columns))
    head = F.concat(F.lit(HEAD[0]), F.col("role"), F.lit(HEAD[1]))
    trained = (F.col("part") != "prompt") & (F.col("role") == TRAINED)
    segment = F.concat(head, F.col("text"), F.lit(TAIL))
    return rows.select(
        "pair_id", "part", "turn", "nth", "role", segment.alias("segment"),
        F.when(trained, F.char_length(head)).cast("bigint").alias("mask_from"),
        F.when(trained, F.char_length(segment)).cast("bigint").alias("mask_to"))


def _answer_ends(rows: DataFrame) -> DataFrame:
    """Where each conversation with an answer parts from its rejected side: ``pair_id``,
    ``cut_turn``, ``cut_nth`` and ``source``, ``source_turn``, ``source_nth``, where the turns
    come from that the rejected side goes on with.

    Conversations with an answer are numbered by id. Even ones part at their first answer,
    odd ones at their last; each goes on as the next one does from its own such answer, the
    last as the first.
    """
    place = F.struct("turn", "nth")
    answers = rows.filter(F.col("role") == TRAINED).groupBy("pair_id").agg(
        F.min(place).alias("first"), F.max(place).alias("last"))
    ranked = stored(numbered(answers, [F.col("pair_id")], "rank", (), None, "total"), "answers")

    def place_of(even, name: str):
        return F.when(even, F.col(f"first.{name}")).otherwise(F.col(f"last.{name}"))
    even = F.col("rank") % 2 == 0
    ends = ranked.select(
        "pair_id", ((F.col("rank") + 1) % F.col("total")).alias("after"), even.alias("even"),
        place_of(even, "turn").alias("cut_turn"), place_of(even, "nth").alias("cut_nth"))
    following = ranked.select(F.col("rank").alias("after"), F.col("pair_id").alias("source"),
                              "first", "last")
    return ends.join(following, "after").select(
        "pair_id", "cut_turn", "cut_nth", "source", place_of(F.col("even"), "turn").alias("source_turn"),
        place_of(F.col("even"), "nth").alias("source_nth"))


def answers_exchanged(table: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Preference pairs from plain conversations, all turns of which are chosen.

    The rejected side is the conversation up to its first or last answer, then the next
    conversation from such an answer on, with its turn numbers moved to follow. One
    without an answer is its own rejected side, so all of it is prompt; so is a
    conversation that has no other to go on with.
    """
    rows = stored(turns(table), "turns")
    ends = stored(_answer_ends(rows), "ends")
    columns = ["pair_id", "turn", "nth", "role", "text"]
    own = ends.select(F.col("pair_id").alias("its"), "cut_turn", "cut_nth")
    before = rows.join(own, rows["pair_id"] == own["its"], "left").filter(
        F.col("its").isNull()
        | (F.struct("turn", "nth") < F.struct(F.col("cut_turn"), F.col("cut_nth"))))
    source = ends.select(F.col("pair_id").alias("target"), "cut_turn", "cut_nth",
                         F.col("source").alias("from"), "source_turn", "source_nth")
    moved = rows.join(source, rows["pair_id"] == source["from"]).filter(
        F.struct("turn", "nth") >= F.struct(F.col("source_turn"), F.col("source_nth")))
    after = moved.select(
        F.col("target").alias("pair_id"),
        (F.col("turn") - F.col("source_turn") + F.col("cut_turn")).alias("turn"),
        F.when(F.col("turn") == F.col("source_turn"),
               F.col("nth") - F.col("source_nth") + F.col("cut_nth"))
        .otherwise(F.col("nth")).alias("nth"), "role", "text")
    return rows.select(columns), before.select(columns).unionByName(after)


ORACLE = """
WITH rows AS (
  SELECT conv_id AS pair_id, turn, coalesce(role, 'user') AS role, coalesce(text, '') AS text,
         row_number() OVER (PARTITION BY conv_id, turn
                            ORDER BY coalesce(role, 'user'), coalesce(text, '')) AS nth
  FROM conversations WHERE conv_id IS NOT NULL AND turn IS NOT NULL),
answers AS (
  SELECT pair_id, row_number() OVER (ORDER BY pair_id) - 1 AS rank, count(*) OVER () AS total,
         min({'turn': turn, 'nth': nth}) AS first, max({'turn': turn, 'nth': nth}) AS last
  FROM rows WHERE role = 'assistant' GROUP BY pair_id),
ends AS (
  SELECT a.pair_id, b.pair_id AS source, CASE WHEN a.rank % 2 = 0 THEN a.first ELSE a.last END AS cut,
         CASE WHEN a.rank % 2 = 0 THEN b.first ELSE b.last END AS start
  FROM answers a JOIN answers b ON b.rank = (a.rank + 1) % a.total),
rejected AS (
  SELECT r.pair_id, r.turn, r.nth, r.role, r.text FROM rows r LEFT JOIN ends e ON e.pair_id = r.pair_id
  WHERE e.pair_id IS NULL OR (r.turn, r.nth) < (e.cut.turn, e.cut.nth)
  UNION ALL
  SELECT e.pair_id, r.turn - e.start.turn + e.cut.turn,
         CASE WHEN r.turn = e.start.turn THEN r.nth - e.start.nth + e.cut.nth ELSE r.nth END,
         r.role, r.text
  FROM ends e JOIN rows r ON r.pair_id = e.source WHERE (r.turn, r.nth) >= (e.start.turn, e.start.nth)),
parting AS (
  SELECT pair_id, min({'turn': turn, 'nth': nth}) AS at
  FROM (SELECT coalesce(c.pair_id, j.pair_id) AS pair_id, coalesce(c.turn, j.turn) AS turn,
               coalesce(c.nth, j.nth) AS nth
        FROM rows c FULL JOIN rejected j ON c.pair_id = j.pair_id AND c.turn = j.turn AND c.nth = j.nth
        WHERE c.text IS DISTINCT FROM j.text OR c.role IS DISTINCT FROM j.role) AS apart
  GROUP BY pair_id),
said AS (
  SELECT r.pair_id, CASE WHEN p.at IS NULL OR (r.turn, r.nth) < (p.at.turn, p.at.nth)
                         THEN 'prompt' ELSE 'chosen' END AS part, r.turn, r.nth, r.role, r.text
  FROM rows r LEFT JOIN parting p ON p.pair_id = r.pair_id
  UNION ALL
  SELECT j.pair_id, 'rejected', j.turn, j.nth, j.role, j.text
  FROM rejected j JOIN parting p ON p.pair_id = j.pair_id
  WHERE (j.turn, j.nth) >= (p.at.turn, p.at.nth))
SELECT pair_id, part, turn, nth, role,
       '<|im_start|>' || role || chr(10) || text || '<|im_end|>' || chr(10) AS segment,
       CASE WHEN part <> 'prompt' AND role = 'assistant' THEN 13 + length(role) END AS mask_from,
       CASE WHEN part <> 'prompt' AND role = 'assistant'
            THEN 13 + length(role) + length(text) + 11 END AS mask_to
FROM said
"""
