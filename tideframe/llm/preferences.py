"""Preference formatting: a chosen and a rejected conversation share their longest common prefix of turns as the prompt.

Only DataFrame functions. The prompt is rendered once; each side's remaining turns are rendered as its completion, with
a mask of the character spans that are trained on: what the assistant says, with its end mark. Where a turn begins in the
rendered conversation is summed up in a window over its turns, before they are gathered, so that all work is in
proportion to the turns.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

#: A turn is rendered as OPEN role CLOSE text END.
OPEN, CLOSE, END = "<|", "|>\n", "<|end|>\n"


def _turns(df: DataFrame, *keys: str) -> DataFrame:
    """keys, and `turn`: a struct of conv, at (where the turn begins in its rendered conversation), role and text.

    df has the keys, conv, turn, role and text; conv decides the conversation. Turns are in the order of turn (those
    without a number first), equal ones by role and text; a null role or text counts as empty.
    """
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    rows = df.select(*keys, "conv", "turn", role.alias("role"), text.alias("text"))
    order = Window.partitionBy(*keys, "conv").orderBy("turn", "role", "text").rowsBetween(Window.unboundedPreceding, -1)
    size = F.length("role") + F.length("text") + len(OPEN) + len(CLOSE) + len(END)
    at = F.coalesce(F.sum(size).over(order), F.lit(0)).cast("long")
    return rows.select(*keys, F.struct("conv", at.alias("at"), "role", "text").alias("turn"))


def conversations(df: DataFrame) -> DataFrame:
    """conv_id, turns: an array of at, role and text (see _turns) in the order of the turns. A null conv_id is no conversation."""
    own = df.filter("conv_id IS NOT NULL").select(F.col("conv_id").alias("conv"), "conv_id", "turn", "role", "text")
    return _turns(own, "conv_id").groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("turn.at", "turn.role", "turn.text"))).alias("turns"))


def common_prefix(a: Column, b: Column) -> Column:
    """How many leading turns of two conversations are equal in role and text."""
    shorter = F.least(F.size(a), F.size(b))
    same = F.zip_with(F.slice(a, F.lit(1), shorter), F.slice(b, F.lit(1), shorter), lambda x, y: (x["role"] == y["role"]) & (x["text"] == y["text"]))
    differ = F.array_position(same, False)
    return F.when(differ == 0, shorter).otherwise(differ.cast("int") - 1)


def render(turns: Column) -> Column:
    return F.array_join(F.transform(turns, lambda t: F.concat(F.lit(OPEN), t["role"], F.lit(CLOSE), t["text"], F.lit(END))), "")


def trained_spans(turns: Column) -> Column:
    """Spans start:end, by comma, of the rendered turns that a loss counts: text and end mark of assistant turns."""
    first = F.get(turns, F.lit(0))["at"]

    def span(t: Column) -> Column:
        start = t["at"] - first + F.length(t["role"]) + len(OPEN) + len(CLOSE)
        return F.concat_ws(":", start.cast("string"), (start + F.length(t["text"]) + len(END)).cast("string"))

    return F.array_join(F.transform(F.filter(turns, lambda t: t["role"] == "assistant"), span), ",")


def paired(turns: DataFrame, pairs: DataFrame) -> DataFrame:
    """The formatted pairs: pair_id, chosen_id, rejected_id, n_prompt_turns, prompt, and for both sides the completion and
    its trained spans. pairs: pair_id, chosen_id, rejected_id; a pair of which a conversation is missing or null is left
    out, and a repeated pair is repeated.

    If one conversation is the beginning of the other, all of it is the prompt and its completion is empty. Turns are
    ordered as _turns says, repeated ones stay; other columns are not read; a conversation of any length is one row.
    """
    own = conversations(turns)
    both = pairs.join(own.select(F.col("conv_id").alias("chosen_id"), F.col("turns").alias("c")), "chosen_id").join(own.select(F.col("conv_id").alias("rejected_id"), F.col("turns").alias("r")), "rejected_id")
    return _formatted(both)


def swapped_replies(turns: DataFrame) -> DataFrame:
    """A formatted pair for each conversation: it is chosen as it is, and rejected with another one's last reply.

    The other conversation is 2k + 1 for 2k and 2k for 2k + 1; the text of its last assistant turn takes the place of
    the own one's. If it is missing or has no assistant turn, the rejected reply is empty and rejected_id is null. A
    conversation without an assistant turn, or with the same reply, has nothing to prefer: all of it is the prompt.
    pair_id and chosen_id are the conversation's id, rejected_id that of the other one.

    Null ids are no conversations; null roles and texts count as empty, turns without a number come first, equal ones are
    ordered by role and text, and repeated ones stay. An empty df gives no rows; other columns are not read. Both
    conversations of a couple are gathered at once, so that each turn crosses the network a single time; a conversation
    of any length is one row.
    """
    conv = F.col("conv_id").cast("long")
    rows = turns.filter(conv.isNotNull()).select((conv - F.pmod(conv, F.lit(2))).alias("pair"), conv.alias("conv"), "turn", "role", "text")
    own = _turns(rows.repartition("pair"), "pair").groupBy("pair").agg(F.sort_array(F.collect_list("turn")).alias("t"))

    def side(which: Column) -> Column:
        return F.transform(F.filter("t", lambda x: x["conv"] == which), lambda x: F.struct(x["at"].alias("at"), x["role"].alias("role"), x["text"].alias("text")))

    one, two = F.col("pair"), F.col("pair") + 1
    sides = own.select("pair", side(one).alias("one"), side(two).alias("two"))
    each = F.array(F.struct(one.alias("id"), two.alias("other"), F.col("one").alias("c"), F.col("two").alias("o")), F.struct(two.alias("id"), one.alias("other"), F.col("two").alias("c"), F.col("one").alias("o")))
    rows = sides.select(F.explode(each).alias("x")).select("x.*").filter(F.size("c") > 0)
    rows = rows.withColumn("last", F.array_max(F.transform("c", lambda x, i: F.when(x["role"] == "assistant", i))))
    replies = F.filter("o", lambda x: x["role"] == "assistant")
    rows = rows.withColumn("reply", F.get(replies, F.size(replies) - 1)["text"])
    said = F.coalesce("reply", F.lit(""))

    def turn(x: Column, i: Column) -> Column:
        moved = x["at"] + F.length(said) - F.length(F.get("c", F.col("last"))["text"])
        return F.struct(F.when(i > F.col("last"), moved).otherwise(x["at"]).alias("at"), x["role"].alias("role"), F.when(i == F.col("last"), said).otherwise(x["text"]).alias("text"))

    other = F.when(F.col("last").isNotNull() & F.col("reply").isNotNull(), F.col("other"))
    return _formatted(rows.select(F.col("id").alias("pair_id"), F.col("id").alias("chosen_id"), other.alias("rejected_id"), "c", F.transform("c", turn).alias("r")))


def _formatted(both: DataFrame) -> DataFrame:
    both = both.withColumn("n", common_prefix(F.col("c"), F.col("r")))

    def rest(side: str) -> Column:
        return F.slice(side, F.col("n") + 1, F.greatest(F.size(side), F.lit(1)))

    return both.select(
        "pair_id", "chosen_id", "rejected_id", F.col("n").cast("long").alias("n_prompt_turns"),
        render(F.slice("c", F.lit(1), F.col("n"))).alias("prompt"),
        render(rest("c")).alias("chosen"), trained_spans(rest("c")).alias("chosen_spans"),
        render(rest("r")).alias("rejected"), trained_spans(rest("r")).alias("rejected_spans"),
    )


ORACLE = """
WITH t AS (SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
                  row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS pos
           FROM conversations WHERE conv_id IS NOT NULL),
     s AS (SELECT conv_id, count(*) AS turns, max(CASE WHEN role = 'assistant' THEN pos END) AS last FROM t GROUP BY conv_id),
     l AS (SELECT s.*, t.text AS said FROM s LEFT JOIN t ON t.conv_id = s.conv_id AND t.pos = s.last),
     p AS (SELECT l.*, CASE WHEN l.last IS NOT NULL THEN o.conv_id END AS other, coalesce(o.said, '') AS reply,
                  CASE WHEN l.last IS NULL OR l.said = coalesce(o.said, '') THEN l.turns ELSE l.last - 1 END AS n
           FROM l LEFT JOIN l o ON o.conv_id = CASE WHEN l.conv_id % 2 = 0 THEN l.conv_id + 1 ELSE l.conv_id - 1 END AND o.last IS NOT NULL),
     r AS (SELECT p.conv_id, p.other, p.n, side, t.pos, t.role, length(t.role) + 5 AS head,
                  '<|' || t.role || '|>' || chr(10) || CASE WHEN side = 'r' AND t.pos = p.last THEN p.reply ELSE t.text END || '<|end|>' || chr(10) AS s
           FROM p JOIN t USING (conv_id) CROSS JOIN (VALUES ('c'), ('r')) x(side)),
     f AS (SELECT *, coalesce(sum(CASE WHEN pos > n THEN length(s) END) OVER (PARTITION BY conv_id, side ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS offs FROM r)
SELECT conv_id AS pair_id, conv_id AS chosen_id, other AS rejected_id, CAST(n AS BIGINT) AS n_prompt_turns,
       coalesce(string_agg(CASE WHEN side = 'c' AND pos <= n THEN s END, '' ORDER BY pos), '') AS prompt,
       coalesce(string_agg(CASE WHEN side = 'c' AND pos > n THEN s END, '' ORDER BY pos), '') AS chosen,
       coalesce(string_agg(CASE WHEN side = 'c' AND pos > n AND role = 'assistant' THEN CAST(CAST(offs + head AS BIGINT) AS VARCHAR) || ':' || CAST(CAST(offs + length(s) AS BIGINT) AS VARCHAR) END, ',' ORDER BY pos), '') AS chosen_spans,
       coalesce(string_agg(CASE WHEN side = 'r' AND pos > n THEN s END, '' ORDER BY pos), '') AS rejected,
       coalesce(string_agg(CASE WHEN side = 'r' AND pos > n AND role = 'assistant' THEN CAST(CAST(offs + head AS BIGINT) AS VARCHAR) || ':' || CAST(CAST(offs + length(s) AS BIGINT) AS VARCHAR) END, ',' ORDER BY pos), '') AS rejected_spans
FROM f GROUP BY conv_id, other, n
"""
