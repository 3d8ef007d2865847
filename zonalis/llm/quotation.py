"""Chat formatting by quotation linking.

Messages may quote earlier ones: a line's quote level is the number of ``>`` marks it starts with (spaces between them
allowed). Consecutive lines of one level above 0 are a quoted passage, said at that level. Passages and messages are
normalised (A-Z lowered, every run of white space one space, quoted lines left out of the message's own text) and hashed
by paragraph: a passage is linked to the earlier message of its conversation that holds one of its paragraphs, the latest
one when several do. A message answers the message that its level-1 passages link to; without such a link it answers the
message before it. The result lists messages in reply order (parents before children, siblings by turn), without quotes.

Passages are met per (conversation, hash, passage), in one order of what is quoted and what is said, so a phrase that very
many messages quote and say costs its rows and not their pairs. Everything ordered within a conversation (the message
before, numbers, reply order) is cut into slices, so a conversation of any length is spread over tasks.

Null texts are empty messages. Null roles stay null. Repeated (conversation, turn) rows are told apart by role and text,
exact repeats are one message. Messages without a conversation or a turn are left out: they have no place. Only the named
columns are read, and other columns may have any names. A very long message is one row, parsed where it stands.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from zonalis.plans.materialize import materialize
from zonalis.plans.slices import Slices

SPACES = r"[\x20\x09-\x0D]+"
MARKS = r"^[\x20\x09]*(?:>[\x20\x09]*)+"
MIN_CHARS = 1


def normalised(text: Column) -> Column:
    lowered = F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.trim(F.regexp_replace(lowered, SPACES, " "))


def parse(messages: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(conv, turn, part, role, text, own, lines): own is the text without quoted lines; lines are structs (at, level, body)."""
    rows = messages.filter(F.col(conv).isNotNull() & F.col(turn).isNotNull()).select(
        F.col(conv).alias("conv"), F.col(turn).cast("long").alias("turn"), F.col(role).alias("role"), F.coalesce(F.col(text), F.lit("")).alias("text")
    ).distinct()
    within = Window.partitionBy("conv", "turn").orderBy(F.col("role").asc_nulls_first(), "text")
    numbered = rows.withColumn("part", F.row_number().over(within).cast("int"))
    marks = F.expr(rf"transform(split(text, '\n', -1), x -> regexp_extract(x, r'{MARKS}', 0))")
    lines = F.transform(
        F.arrays_zip(F.split("text", "\n", -1).alias("body"), F.col("marks").alias("mark")),
        lambda x, i: F.struct(
            i.alias("at"), (F.length(x["mark"]) - F.length(F.replace(x["mark"], F.lit(">"), F.lit("")))).alias("level"),
            F.substr(x["body"], F.length(x["mark"]) + 1).alias("body"),
        ),
    )
    parsed = numbered.withColumn("marks", marks).withColumn("lines", lines).drop("marks")
    own = F.array_join(F.transform(F.filter("lines", lambda x: x["level"] == 0), lambda x: x["body"]), "\n")
    return parsed.withColumn("own", F.btrim(own, F.lit("\n")))


def passages(parsed: DataFrame) -> DataFrame:
    """(conv, turn, part, level, first, body): runs of quoted lines of one level."""
    lines = parsed.filter(F.exists("lines", lambda x: x["level"] > 0)).select("conv", "turn", "part", F.explode("lines").alias("l"))
    lines = lines.select("conv", "turn", "part", "l.at", "l.level", "l.body")
    message = Window.partitionBy("conv", "turn", "part").orderBy("at")
    runs = lines.withColumn("new", F.when(F.col("level") == F.lag("level").over(message), 0).otherwise(1)).withColumn("run", F.sum("new").over(message))
    body = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("at", "body"))), lambda x: x["body"]), "\n")
    return runs.filter("level > 0").groupBy("conv", "turn", "part", "level", "run").agg(F.min("at").alias("first"), body.alias("body")).drop("run")


def _paragraphs(rows: DataFrame, body: str) -> DataFrame:
    """One row per non-empty normalised paragraph (line) with its hash; the whole text counts as one too."""
    pieces = F.array_distinct(F.filter(F.concat(F.transform(F.split(body, "\n", -1), normalised), F.array(normalised(F.col(body)))), lambda x: F.length(x) >= MIN_CHARS))
    return rows.withColumn("passage", F.explode(pieces)).withColumn("h", F.xxhash64("passage"))


def link(parsed: DataFrame) -> DataFrame:
    """(conv, turn, part, level, first, to_turn, to_part): each passage with the latest earlier message that says it."""
    quoted = _paragraphs(passages(parsed), "body").select("conv", "turn", "part", "level", "first", "h", "passage")
    key = ["conv", "h", "passage"]
    said = _paragraphs(parsed.select("conv", "turn", "part", "own"), "own").select("conv", "turn", "part", "h", "passage")
    said = said.join(quoted.select(*key).distinct(), key, "left_semi")
    # One order per passage: at equal turns quotes come first, so what was said last before a quote is from an earlier turn.
    both = quoted.withColumn("order", F.col("turn") * 2).unionByName(said.withColumn("order", F.col("turn") * 2 + 1), allowMissingColumns=True)
    both = both.withColumn("to", F.when(F.col("order") % 2 != 0, F.struct(F.col("turn").alias("to_turn"), F.col("part").alias("to_part"))))
    filled = Slices(both, key, ["order", "part"]).fill(["to"]).filter((F.col("order") % 2 == 0) & F.col("to").isNotNull())
    return filled.groupBy("conv", "turn", "part", "level", "first").agg(F.max("to").alias("to")).select(
        "conv", "turn", "part", "level", "first", "to.to_turn", "to.to_part"
    )


def conversations(messages: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """One row per message: (conv_id, turn, part, role, text, n_quotes, n_linked, parent_turn, parent_part, depth, position).

    ``text`` is the message without quotes, ``depth`` the number of messages it answers in turn, ``position`` (1-based) its
    place in reply order. Parents always come from earlier turns, so depths and paths end; they are found by pointer
    doubling, a logarithmic number of joins.
    """
    parsed = materialize(parse(messages, conv, turn, role, text))
    links = materialize(link(parsed))
    counts = passages(parsed).groupBy("conv", "turn", "part").agg(F.count(F.lit(1)).alias("n_quotes"))
    linked = links.groupBy("conv", "turn", "part").agg(F.count(F.lit(1)).alias("n_linked"))
    direct = links.filter("level = 1").groupBy("conv", "turn", "part").agg(F.max(F.struct("to_turn", "to_part")).alias("to"))
    key = ["conv", "turn", "part"]
    rows = parsed.select(*key, "role", F.col("own").alias("text")).join(counts, key, "left").join(linked, key, "left").join(direct, key, "left")
    here = F.struct(F.col("turn").alias("to_turn"), F.col("part").alias("to_part"))
    rows = Slices(rows, ["conv"], ["turn", "part"]).lags({"before": (here, 1)})
    rows = rows.withColumn("parent", F.coalesce("to", "before")).drop("to", "before")
    rows = materialize(rows.withColumn("node", F.struct("turn", "part")))
    # (node, up, steps): up is an ancestor `steps` above; doubled until every pointer has reached a first message.
    jumps = rows.select("conv", "node", F.struct(F.col("parent.to_turn").alias("turn"), F.col("parent.to_part").alias("part")).alias("up"), F.col("parent").isNotNull().cast("long").alias("steps"))
    jumps = jumps.withColumn("up", F.when(F.col("steps") > 0, F.col("up")))
    pointers = materialize(jumps)
    while not pointers.filter("up IS NOT NULL").isEmpty():
        above = pointers.select("conv", F.col("node").alias("up"), F.col("up").alias("further"), F.col("steps").alias("more"))
        pointers = materialize(
            pointers.join(above, ["conv", "up"], "left").select("conv", "node", F.col("further").alias("up"), (F.col("steps") + F.coalesce("more", F.lit(0))).alias("steps"))
        )
    depth = pointers.select("conv", "node", F.col("steps").alias("depth"))
    out = rows.join(depth, ["conv", "node"]).select(
        F.col("conv").alias(conv), "turn", "part", "role", "text", F.coalesce("n_quotes", F.lit(0)).cast("long").alias("n_quotes"),
        F.coalesce("n_linked", F.lit(0)).cast("long").alias("n_linked"), F.col("parent.to_turn").alias("parent_turn"),
        F.col("parent.to_part").alias("parent_part"), "depth",
    )
    return Slices(materialize(out), [conv], ["depth", "turn", "part"]).numbered("position")


#: The query over ``conversations`` in DuckDB.
CHECK_SQL = r"""
WITH RECURSIVE d AS (SELECT DISTINCT conv_id, CAST(turn AS BIGINT) AS turn, role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL AND turn IS NOT NULL),
m AS (SELECT *, CAST(row_number() OVER (PARTITION BY conv_id, turn ORDER BY role NULLS FIRST, text) AS INTEGER) AS part FROM d),
s AS (SELECT conv_id, turn, part, string_split(text, chr(10)) AS ls FROM m),
l AS (SELECT conv_id, turn, part, i, regexp_extract(ls[i], '^[ \t]*(?:>[ \t]*)+') AS mark, ls[i] AS line FROM (SELECT *, unnest(range(1, len(ls) + 1)) AS i FROM s)),
q AS (SELECT conv_id, turn, part, i, length(mark) - length(replace(mark, '>', '')) AS level, substring(line, length(mark) + 1) AS body FROM l),
o AS (SELECT conv_id, turn, part, trim(string_agg(body, chr(10) ORDER BY i), chr(10)) AS own FROM q WHERE level = 0 GROUP BY ALL),
r AS (SELECT *, sum(new) OVER (PARTITION BY conv_id, turn, part ORDER BY i) AS run
      FROM (SELECT *, CASE WHEN level = lag(level) OVER (PARTITION BY conv_id, turn, part ORDER BY i) THEN 0 ELSE 1 END AS new FROM q)),
p AS (SELECT conv_id, turn, part, level, run, string_agg(body, chr(10) ORDER BY i) AS body FROM r WHERE level > 0 GROUP BY ALL),
norm AS (SELECT conv_id, turn, part, level, run, unnest(list_distinct(list_append(string_split(body, chr(10)), body))) AS piece FROM p),
qp AS (SELECT DISTINCT conv_id, turn, part, level, run, trim(regexp_replace(translate(piece, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+', ' ', 'g')) AS piece FROM norm),
sp AS (SELECT DISTINCT conv_id, turn, part, trim(regexp_replace(translate(piece, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+', ' ', 'g')) AS piece
       FROM (SELECT conv_id, turn, part, unnest(list_append(string_split(own, chr(10)), own)) AS piece FROM o)),
k AS (SELECT qp.conv_id, qp.turn, qp.part, qp.level, qp.run, max((sp.turn, sp.part)) AS target FROM qp JOIN sp ON qp.conv_id = sp.conv_id AND qp.piece = sp.piece AND sp.turn < qp.turn AND qp.piece <> '' GROUP BY ALL),
e AS (SELECT m.conv_id, m.turn, m.part, m.role, coalesce(o.own, '') AS text,
        (SELECT count(*) FROM p WHERE p.conv_id = m.conv_id AND p.turn = m.turn AND p.part = m.part) AS n_quotes,
        (SELECT count(*) FROM k WHERE k.conv_id = m.conv_id AND k.turn = m.turn AND k.part = m.part) AS n_linked,
        coalesce((SELECT max(target) FROM k WHERE level = 1 AND k.conv_id = m.conv_id AND k.turn = m.turn AND k.part = m.part),
                 lag((m.turn, m.part)) OVER (PARTITION BY m.conv_id ORDER BY m.turn, m.part)) AS parent
      FROM m LEFT JOIN o USING (conv_id, turn, part)),
h AS (SELECT conv_id, turn, part, CAST(0 AS BIGINT) AS depth FROM e WHERE parent IS NULL
      UNION ALL SELECT e.conv_id, e.turn, e.part, h.depth + 1 FROM e JOIN h ON e.conv_id = h.conv_id AND e.parent = (h.turn, h.part))
SELECT e.conv_id, e.turn, e.part, e.role, e.text, CAST(n_quotes AS BIGINT) AS n_quotes, CAST(n_linked AS BIGINT) AS n_linked, parent[1] AS parent_turn, parent[2] AS parent_part, depth,
  row_number() OVER (PARTITION BY e.conv_id ORDER BY depth, e.turn, e.part) AS position
FROM e JOIN h USING (conv_id, turn, part)
"""
