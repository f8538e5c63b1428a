"""Chat formatting with prefix-target expansion.

Every assistant turn becomes a training example of its own: all turns before it
are context, and only its text is under the loss mask. The formatted turns of a
conversation follow each other in one stream, and an example is a prefix of that
stream: it ends with its assistant turn. ``format_turns`` gives each turn once, with
its place in the stream, and ``expand`` makes a row of each assistant turn: its own
piece, and its context as a range of the stream. ``render`` writes the contexts out.
By ranges the output grows with the conversations; written out it grows with the
square of a conversation's length, which no partitioning undoes.

Template of a turn: ``<|turn|>role<|says|>text<|end|>``. Control strings inside
roles and texts (the template's own and those of common chat templates) get a
backslash after their first character, one more if they have some already, so
that taking one away gives the text back exactly.
"""

from __future__ import annotations

import hashlib
import re
from typing import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from textflow.llm.catalog import query
from textflow.llm.common import col, written
from textflow.plans.catalog import table

TURN, SAYS, END = "<|turn|>", "<|says|>", "<|end|>"
TRAINED_ROLE = "assistant"
# What follows the first character (< or [) of a control string.
_REST = r"\|(?:turn|says|end|im_start|im_end|endoftext)\|>|/?s>|/?INST\]|</?SYS>>"
_CONTROL = r"([<\[])(\\*)(" + _REST + ")"
_ESCAPED = re.compile(r"([<\[])\\(\\*)(" + _REST + ")")


def escape(text: Column) -> Column:
    return F.regexp_replace(text, _CONTROL, r"$1\\$2$3")


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1\2\3", text)


def format_turns(conversations: DataFrame) -> DataFrame:
    """``(conv_id, pos, piece, start, stop, loss_start, loss_stop)``: a row for each
    turn, in code points of its conversation's stream, ends exclusive. The loss
    range is null but for assistant turns, each of which is an example: the stream
    up to ``stop``, trained from ``loss_start`` to ``loss_stop``.

    Turns follow each other by ``turn`` (null first), ties by role, then text;
    repeated rows are turns of their own. A null role or text is empty; rows with
    a null ``conv_id`` are one conversation. Other columns are ignored; an empty
    table gives an empty one."""
    role = F.coalesce(col(conversations, "role").cast("string"), F.lit(""))
    text = F.coalesce(col(conversations, "text").cast("string"), F.lit(""))
    rows = conversations.select(col(conversations, "conv_id").alias("conv_id"), col(conversations, "turn").alias("turn"),
                                role.alias("role"), text.alias("text"))
    head = F.concat(F.lit(TURN), escape(F.col("role")), F.lit(SAYS))
    rows = rows.select("conv_id", "turn", "role", "text", F.char_length(head).cast("long").alias("before"),
                       F.concat(head, escape(F.col("text")), F.lit(END)).alias("piece"))
    turns = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    upto = turns.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = rows.select("conv_id", "role", "piece", "before", F.row_number().over(turns).alias("pos"),
                         F.sum(F.char_length("piece").cast("long")).over(upto).alias("stop"))
    start = F.col("stop") - F.char_length("piece")
    trained = F.col("role") == TRAINED_ROLE
    return placed.select("conv_id", "pos", "piece", start.alias("start"), "stop",
                         F.when(trained, start + F.col("before")).alias("loss_start"),
                         F.when(trained, F.col("stop") - len(END)).alias("loss_stop"))


def expand(turns: DataFrame) -> DataFrame:
    """``(conv_id, example, context_start, context_stop, piece, loss_start, loss_stop, stop)``:
    a training example for each assistant turn of ``format_turns``. The context is the
    range of its conversation's stream before the turn's own ``piece``; of that, the
    characters from ``loss_start`` to ``loss_stop`` (of the stream) are trained on. The
    example is ``stop`` characters long. A conversation without such a turn has none."""
    return turns.where("loss_start IS NOT NULL").select(
        "conv_id", F.col("pos").alias("example"), F.lit(0).cast("long").alias("context_start"), F.col("start").alias("context_stop"),
        "piece", "loss_start", "loss_stop", "stop")


def render(turns: DataFrame) -> DataFrame:
    """``(conv_id, example, text, loss_start, loss_stop)``: the examples of
    ``format_turns`` written out, context included."""
    upto = Window.partitionBy("conv_id").orderBy("pos").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    whole = turns.select("conv_id", "pos", "loss_start", "loss_stop", F.collect_list("piece").over(upto).alias("pieces"))
    return whole.where("loss_start IS NOT NULL").select(
        "conv_id", F.col("pos").alias("example"), F.array_join("pieces", "").alias("text"), "loss_start", "loss_stop")


def parse_piece(piece: str) -> tuple[str, str]:
    """Role and text of a formatted turn."""
    if not (piece.startswith(TURN) and piece.endswith(END)):
        raise ValueError("not a formatted turn")
    role, says, text = piece[len(TURN):len(piece) - len(END)].partition(SAYS)
    if not says or any(mark in part for mark in (TURN, SAYS, END) for part in (role, text)):
        raise ValueError("not one formatted turn")
    return unescape(role), unescape(text)


_READ = ("conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, "
         "formatted_chars long, n_examples long, stream_chars long")


def _read_back(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Digests of each conversation from its formatted turns, and from its examples what
    is under their loss masks. They come in order, a turn's example after the turn; one
    is in hand at a time."""
    names = [part.split()[0] for part in _READ.split(",")]
    now, state = None, None

    def result():
        n, turns, chars, loss, total, examples, stop = state
        return now, n, turns.hexdigest(), chars, loss.hexdigest(), total, examples, stop

    for batch in batches:
        out = []
        for conv, trained, piece, start, stop, lo, hi in zip(*(batch[c] for c in ("conv_id", "trained", "piece", "start", "stop", "loss_start", "loss_stop"))):
            conv = None if pd.isna(conv) else int(conv)
            if state is None or conv != now:
                if state is not None:
                    out.append(result())
                now, state = conv, [0, hashlib.sha256(), 0, hashlib.sha256(), 0, 0, 0]
            if trained:
                reply = unescape(piece[int(lo) - int(start):int(hi) - int(start)])
                state[2] += len(reply)
                state[3].update(reply.encode("utf-8", "surrogatepass"))
                state[4] += int(stop)
                state[5] += 1
            else:
                role, text = parse_piece(piece)
                state[0] += 1
                state[1].update(f"{role}\n{text}\n".encode("utf-8", "surrogatepass"))
                state[6] = int(stop)
        if out:
            yield pd.DataFrame(out, columns=names)
    if state is not None:
        yield pd.DataFrame([result()], columns=names)


def read_back(turns: DataFrame, examples: DataFrame) -> DataFrame:
    """One row a conversation: its turns, parsed from the formatted ones, and from its
    examples what is under their loss masks and their lengths, contexts included, added
    up (``formatted_chars``). A digest runs over a whole conversation, so a task reads it
    in order."""
    both = turns.select("conv_id", "pos", F.lit(False).alias("trained"), "piece", "start", "stop", "loss_start", "loss_stop").union(
        examples.select("conv_id", "example", F.lit(True), "piece", "context_stop", "stop", "loss_start", "loss_stop"))
    dealt = both.repartition("conv_id").sortWithinPartitions("conv_id", "pos", "trained")
    return dealt.mapInPandas(_read_back, _READ)


_SQL_REST = _REST.replace("(?:", "(")


def _sql_escape(column: str) -> str:
    return f"regexp_replace({column}, '{_CONTROL}', '\\1\\\\\\2\\3', 'g')"


OP8_SQL = f"""
WITH rows AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'),
sized AS (
  SELECT *, length('{TURN}' || {_sql_escape('role')} || '{SAYS}' || {_sql_escape('text')} || '{END}') AS n FROM rows),
placed AS (
  SELECT *, sum(n) OVER (PARTITION BY conv_id ORDER BY turn, role, text ROWS UNBOUNDED PRECEDING) AS stop FROM sized)
SELECT CAST(conv_id AS BIGINT) AS conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (WHERE role = '{TRAINED_ROLE}'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (WHERE role = '{TRAINED_ROLE}'), '')) AS loss_sha256,
       CAST(coalesce(sum(stop) FILTER (WHERE role = '{TRAINED_ROLE}'), 0) AS BIGINT) AS formatted_chars,
       count(*) FILTER (WHERE role = '{TRAINED_ROLE}') AS n_examples, CAST(sum(n) AS BIGINT) AS stream_chars
FROM placed GROUP BY conv_id
"""


@query("op8_chat_format", OP8_SQL)
def op8_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = "</s>[INST] ok [/INST]"
    own = spark.createDataFrame([(-1, 0, "user", said), (-1, 1, "assistant", said)],
                                "conv_id long, turn long, role string, text string")
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").union(own)
    turns = written(format_turns(rows), "formatted-turns")
    return read_back(turns, expand(turns))
