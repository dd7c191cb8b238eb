r"""Chat formatting by prefix-target expansion.

A conversation is formatted turn by turn as ``<|turn|>role<|text|>text<|end|>``.
Inside roles and texts every backslash is doubled and a backslash is put after
the first character of each control string, so no control string survives in
them and one left-to-right pass takes the backslashes away again.

Each assistant turn is expanded into an example of its own: a row with its
text, which is all earlier turns (the prefix), its header, its reply and the end
mark, and with the loss span (target_start, target_end), in code points into
that text. Only the reply is trainable. A conversation that does not end with
an assistant turn has one more row, its whole text without a loss, so no turn
is missing from the output.

The format only appends, so the text of an example is a prefix of the formatted
conversation. That string and the spans, a running sum over the turns, come out
of the one shuffle by conv_id; the rows are cut out of it one at a time, where
it lies. The texts of one conversation add up to the square of its
length, which is what full prefixes are, but no row holds more than one of
them. Replies and turns are read back out of the examples.

Rows are ordered by turn (null last), then role and text, so ties and repeated
rows have a fixed order. Null text: empty. Null role: empty role. A null
conv_id is a conversation of its own; one without an assistant turn has no
example. A conversation is one string in one row, which bounds it at 2 GB.
Only DataFrame functions run.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

TURN, TEXT, END = "<|turn|>", "<|text|>", "<|end|>"
MASK = ("position", "context_end", "target_start", "target_end")
PIECE = 4096
SPANS = "array<struct<position:int,context_end:bigint,target_start:bigint,target_end:bigint>>"
# fixed values: control strings that must not survive inside a text
CONTROL = (TURN, TEXT, END, "<|im_start|>", "<|im_end|>", "<|endoftext|>", "</s>", "<s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>")


def escape(text: Column) -> Column:
    out = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    for c in CONTROL:
        out = F.replace(out, F.lit(c), F.lit(c[0] + "\\" + c[1:]))
    return out


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def format_turns(conversations: DataFrame) -> DataFrame:
    """One row per turn: conv_id, position (from 0), role, segment (the
    formatted turn), context_end, target_start, target_end."""
    role = F.coalesce(F.col("role"), F.lit(""))
    rows = conversations.select("conv_id", "turn", role.alias("role"), F.coalesce(F.col("text"), F.lit("")).alias("text"))
    head = F.concat(F.lit(TURN), escape(F.col("role")), F.lit(TEXT))
    rows = rows.withColumn("head", F.length(head)).withColumn("segment", F.concat(head, escape(F.col("text")), F.lit(END)))
    w = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_last(), "role", "text")
    start = F.coalesce(F.sum(F.length("segment").cast("long")).over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    rows = rows.withColumn("position", F.row_number().over(w) - 1).withColumn("context_end", start)
    return rows.select("conv_id", "position", "role", "segment", "context_end", (F.col("context_end") + F.col("head")).alias("target_start"),
                       (F.col("context_end") + F.length("segment") - len(END)).alias("target_end"))


def conversations_of(turns: DataFrame) -> DataFrame:
    """conv_id, ``formatted`` (the whole conversation as one string) and
    ``mask``, an array of (position, context_end, target_start, target_end) of
    its assistant turns: the spans of ``formatted`` that are trained on."""
    t = F.sort_array(F.collect_list(F.struct("position", "segment", "role", "context_end", "target_start", "target_end")))
    mask = F.transform(F.filter("t", lambda x: x["role"] == "assistant"), lambda x: F.struct(*[x[c].alias(c) for c in MASK]))
    return turns.groupBy("conv_id").agg(t.alias("t")).select(
        "conv_id", F.array_join(F.transform("t", lambda x: x["segment"]), "").alias("formatted"), mask.alias("mask"))


def expand(whole: DataFrame) -> DataFrame:
    """One row per example of ``conversations_of``'s rows: conv_id, position,
    context_end, target_start, target_end, ``text`` (prefix, header, reply, end
    mark) and ``last``. Where the last turn is not an assistant's, the last row
    is the whole text, with an empty span at its end."""
    n = F.length("formatted").cast("long")
    end = F.coalesce(F.try_element_at("spans", F.lit(-1))["target_end"] + len(END), F.lit(0).cast("long"))
    left = F.array(F.struct(F.lit(None).cast("int").alias("position"), *[n.alias(c) for c in MASK[1:]]))
    spans = F.concat("spans", F.when(end < n, left).otherwise(F.slice(left, 1, 0)))
    d = whole.withColumn("spans", F.col("mask").cast(SPANS)).select("conv_id", "formatted", spans.alias("spans"))
    rows = d.select("conv_id", "formatted", F.size("spans").alias("n"), F.posexplode("spans").alias("k", "m"))
    # a span with a reply is followed by an end mark, the empty one by nothing
    stop = F.col("m.target_end") + F.when(F.col("m.position").isNull(), 0).otherwise(len(END))
    return rows.select("conv_id", *[F.col("m")[c].alias(c) for c in MASK], F.substring("formatted", F.lit(1), stop.cast("int")).alias("text"),
                       (F.col("k") == F.col("n") - 1).alias("last"))


def target() -> Column:
    """The text under the loss span of an example, as it stands there."""
    return F.substring("text", (F.col("target_start") + 1).cast("int"), (F.col("target_end") - F.col("target_start")).cast("int"))


def examples(turns: DataFrame) -> DataFrame:
    """One row per assistant turn: its spans, ``prefix`` (all before the reply) and ``target``, its escaped reply."""
    d = expand(conversations_of(turns)).where(F.col("position").isNotNull())
    return d.select("conv_id", *MASK, F.substring("text", F.lit(1), F.col("target_start").cast("int")).alias("prefix"), target().alias("target"))


def materialise(turns: DataFrame) -> DataFrame:
    """The examples as full texts (prefix, header, reply, end mark) with the loss span."""
    d = expand(conversations_of(turns)).where(F.col("position").isNotNull())
    return d.select("conv_id", "position", "text", "target_start", "target_end")


def masked(formatted: Column, mask: Column) -> Column:
    """The texts under the mask of a whole conversation, as they stand in the
    string: what the examples' targets are, without their prefixes. The string is cut into
    pieces of ``PIECE`` characters once, and a span is cut out of the pieces it
    lies in, so the work grows with the conversation, not with its square."""
    pieces = F.regexp_extract_all(formatted, F.lit(f"(?s).{{1,{PIECE}}}"), 0)

    def span(cut: Column, m: Column) -> Column:
        first = F.floor(m["target_start"] / PIECE).cast("int")
        n = F.floor(m["target_end"] / PIECE).cast("int") - first + 1
        return F.substring(F.array_join(F.slice(cut, first + 1, n), ""), (m["target_start"] % PIECE + 1).cast("int"), (m["target_end"] - m["target_start"]).cast("int"))
    # an array of one holds the pieces, so that they are cut once
    return F.get(F.transform(F.array(pieces), lambda cut: F.transform(mask, lambda m: span(cut, m))), F.lit(0))


def parse(formatted: Column) -> Column:
    """The (role, text) turns read from a formatted conversation."""
    pieces = F.filter(F.split(formatted, r"<\|turn\|>", -1), lambda p, i: i > 0)

    def turn(p):
        cut = F.split(p, r"<\|text\|>", 2)
        said = F.get(cut, 1)
        return F.struct(unescape(F.get(cut, 0)).alias("role"), unescape(F.substring(said, F.lit(1), F.length(said) - len(END))).alias("text"))
    return F.transform(pieces, turn)


def op10(conversations: DataFrame) -> DataFrame:
    both = "</s>[INST] ok [/INST]"
    extra = conversations.sparkSession.sql(
        f"select cast(-7 as bigint) as conv_id, i as turn, if(i = 0, 'user', 'assistant') as role, '{both}' as text from range(2) as t(i)")
    rows = conversations.select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), "role", "text").unionByName(extra)
    d = expand(conversations_of(format_turns(rows))).withColumn("reply", unescape(target()))
    d = d.withColumn("turns", F.when(F.col("last"), parse(F.col("text"))))
    said = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    d = d.select("conv_id", "last", "target_start", "reply", F.size("turns").cast("long").alias("n_turns"), F.sha2(said, 256).alias("turns_sha256"),
                 F.length("text").cast("long").alias("formatted_chars"))
    # the rows still lie by conv_id: no further shuffle
    of_last = [F.max(F.when(F.col("last"), F.col(c))).alias(c) for c in ("n_turns", "turns_sha256", "formatted_chars")]
    replies = F.sort_array(F.collect_list(F.struct("target_start", "reply")))
    loss = F.array_join(F.transform(replies, lambda x: x["reply"]), "")
    d = d.groupBy("conv_id").agg(*of_last, loss.alias("loss"))
    return d.select("conv_id", "n_turns", "turns_sha256", F.length("loss").cast("long").alias("loss_chars"), F.sha2("loss", 256).alias("loss_sha256"), "formatted_chars")
