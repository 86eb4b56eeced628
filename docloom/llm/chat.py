"""Conversations as training text, with a grammar that reads back exactly.

A conversation is its turns in order; a turn is

    ### role: text </turn>

and a line feed. The grammar is deterministic: an unescaped ``</turn>`` and line
feed end a turn, ``### `` and the role (percent-encoded, so free of the grammar's
signs) up to the first ``: `` open it, and one space parts the text from its end, so
that no sign of the text touches the end mark. ``###`` (where a run of signs starts) and
``</turn>`` are control strings; a backslash in front makes one plain text, and reading takes it away.

Round trip: a turn is first rendered as it is and parsed again. Where the parser
returns another text (the text holds a control string, or a backslash before one)
each control string gets a backslash, as often as it takes for the parser to return
the source: one round always does, as every control string then has one backslash
more than it had, and the parser removes just that one. A last turn that still
differed would stop the job.

The loss mask is a row of (skip, take) code point counts, one pair a turn: ``take`` is
the escaped text of an assistant turn, 0 for other roles. Everything is built-in
functions; each step is linear in the conversation. Turns are rendered before the
shuffle, and what a conversation needs together, its formatted text, is one row of
the result; a conversation is gathered in the memory of one task as that row.

Edge cases: a NULL role or text is empty; a NULL turn sorts first; equal turns sort
by role, then text, and all stay; NULL conv_id is one conversation of that id; an
empty table gives no rows; columns beyond the four are not carried.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

END = " </turn>\n"
CONTROL = "((?<!#)###|</turn>)"
ESCAPED = r"\\(###|</turn>)"
TURN_END = r"(?<!\\)</turn>\n"
OPEN_INSIDE = r"(?<![\\#])###"
ROUNDS = 2
LOSS_ROLE = "assistant"


def escape(text: Column) -> Column:
    """One backslash more before every control string."""
    return F.regexp_replace(text, CONTROL, r"\\$1")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, ESCAPED, "$1")


def head(role: Column) -> Column:
    return F.concat(F.lit("### "), F.url_encode(role), F.lit(": "))


def parse(formatted: Column) -> Column:
    """Turns (role, text) of a formatted conversation."""
    pieces = F.split(formatted, TURN_END, -1)
    return F.transform(F.slice(pieces, 1, F.size(pieces) - 1), turn_of)


def body_of(piece: Column) -> Column:
    """What stands between a turn's opening and its end, as written."""
    return F.substr(piece, F.locate(": ", piece) + 2, F.length(piece) - F.locate(": ", piece) - 2)


def turn_of(piece: Column) -> Column:
    role = F.url_decode(F.substr(piece, F.lit(5), F.locate(": ", piece) - 5))
    # an unescaped opening inside a text would start another turn there
    return F.struct(role.alias("role"), unescape(F.element_at(F.split(body_of(piece), OPEN_INSIDE, 2), 1)).alias("text"))


def render(turns: DataFrame) -> DataFrame:
    """Rows (conv_id, turn, role, text) with ``written``, the escaped text that reads back as ``text``."""
    source = F.col("text")
    same = lambda written: F.coalesce(unescape(F.element_at(F.split(F.element_at(F.split(F.concat(written, F.lit(END)), TURN_END, 2), 1), OPEN_INSIDE, 2), 1)) == F.concat(source, F.lit(" ")), F.lit(False))
    attempt, choice = source, None
    for _ in range(ROUNDS):
        choice = F.when(same(attempt), attempt) if choice is None else choice.when(same(attempt), attempt)
        attempt = escape(attempt)
    rows = turns.select("conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    wrong = F.raise_error(F.concat(F.lit("turn doesn't read back in conversation "), F.coalesce(F.col("conv_id").cast("string"), F.lit("NULL"))))
    return rows.withColumn("written", choice.otherwise(wrong.cast("string")))


def format_conversations(turns: DataFrame) -> DataFrame:
    """One row per conversation: ``conv_id``, ``formatted`` and ``loss_mask`` (skip, take in code points, a pair a turn)."""
    opening = head(F.col("role"))
    loss = F.col("role") == LOSS_ROLE
    written = F.concat(opening, "written", F.lit(END))
    skip = F.when(loss, F.length(opening)).otherwise(F.length(written))
    take = F.when(loss, F.length("written")).otherwise(F.lit(0))
    row = F.struct("turn", "role", "text", written.alias("written"), skip.alias("skip"), take.alias("take"))
    gathered = render(turns).select("conv_id", row.alias("row")).groupBy("conv_id").agg(F.array_sort(F.collect_list("row")).alias("rows"))
    return gathered.select(
        "conv_id",
        F.array_join(F.transform("rows", lambda r: r["written"]), "").alias("formatted"),
        F.transform("rows", lambda r: F.struct(r["skip"].alias("skip"), r["take"].alias("take"))).alias("loss_mask"),
        F.transform("rows", lambda r: F.struct(r["role"].alias("role"), r["text"].alias("text"))).alias("source"),
    )


def read_back(formatted: DataFrame) -> DataFrame:
    """Add ``turns`` (role, text) and ``loss_texts``, both read from ``formatted`` and the mask alone."""
    pieces = F.split("formatted", TURN_END, -1)
    masked = F.zip_with(F.slice(pieces, 1, F.size("loss_mask")), "loss_mask", lambda piece, m: F.when(m["take"] > 0, unescape(F.substr(piece, m["skip"] + 1, m["take"]))))
    return formatted.withColumns({"turns": parse(F.col("formatted")), "loss_texts": F.filter(masked, lambda t: t.isNotNull())})


def digests(turns: DataFrame) -> DataFrame:
    """What the formatted text says, in numbers and sums; a conversation that doesn't read back as its source stops the job."""
    read = read_back(format_conversations(turns))
    wrong = F.raise_error(F.lit("a conversation doesn't read back")).cast("bigint")
    told = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    under = F.array_join("loss_texts", "")
    return read.select(
        "conv_id",
        F.when(F.col("turns") == F.col("source"), F.size("turns").cast("long")).otherwise(wrong).alias("n_turns"),
        F.sha2(told, 256).alias("turns_sha256"),
        F.length(under).cast("long").alias("loss_chars"),
        F.sha2(under, 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )
