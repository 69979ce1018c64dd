"""Chat formatting: quotation linking.

A message is cut into lines; leading ``>`` marks give each line's quote level,
and a run of lines of one level is a passage; a blank line, marked or not, does
not end a run.  Passages are normalised (marks off, lower case, runs of white
space as one space) and hashed, and so are their paragraphs and lines.  Each
quoted passage is joined to the message of its conversation where that passage
first stood one level lower, else to the first message that holds all its
paragraphs or all its lines at that level; where no message does, each of its
paragraphs is looked for by itself.  The latest such message before the quoting
one is what it replies to, and a message that quotes nothing known replies to
the turn before it.  The replies of a conversation form trees; a run of messages that
each reply to the turn before is a chain, and a quote that reaches further back
starts a new one.  Pointer doubling over the walk of all chains gives each its
place and depth.  Messages come out without quotes, sorted by conversation and
``reply_order``, a number without gaps, which is the order of walking the
trees: a message, then the replies to it by turn, each with all that follows
from it.

Originals are reduced to the first turn of each (conversation, level, hash)
before the join, so a passage that repeats does not multiply rows.  Of the
parts of a passage, the latest first turn is tried first, then the turns of its
rarest part; equal passages of a conversation are looked up once, and only
conversations that quote are.  Chains are
cut in blocks of turns and the sort is by range, so a large conversation does
not meet in one task.  DataFrame functions only.

Cases: a null or empty text has no passage and an empty reply; a null role is
kept; rows without conv_id or turn are left out, they have no place; rows
that repeat (conv_id, turn) share its links and order; a quote of an unknown
passage links nowhere, a part of a line is unknown; an empty table gives no
rows; extra columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import broadcast_if_small, checkpoint

#: Turns whose chain starts are found together.
BLOCK_TURNS = 1024
LINE_END = "\\r\\n|\\r|\\n"
MARKS = "^[ \\t]*(?:>[ \\t]?)*"


def normal(text: Column) -> Column:
    return F.trim(F.regexp_replace(F.lower(text), "\\s+", " "))


def paragraphs(body: Column) -> Column:
    """(hash, lines) of each paragraph, the lines as hashes; blank ones left out."""
    split = lambda text, at: F.filter(F.split(text, at), lambda x: normal(x) != "")
    each = split(F.regexp_replace(body, LINE_END, "\n"), "\\n\\s*\\n")
    return F.transform(each, lambda p: F.struct(F.xxhash64(normal(p)).alias("hash"), F.transform(split(p, "\\n"), lambda x: F.xxhash64(normal(x))).alias("lines")))


def passages(messages: DataFrame) -> DataFrame:
    """(conv_id, turn, role, body, passages): body is the message without
    its quoted lines, passages are (level, hash, paragraphs) of each run of lines."""
    lines = F.split(F.coalesce("text", F.lit("")), LINE_END)
    lined = messages.withColumn(
        "lines",
        F.transform(
            lines,
            lambda x: F.struct(
                F.length(F.regexp_replace(F.regexp_extract(x, MARKS, 0), "[^>]", "")).alias("level"),
                F.regexp_replace(x, MARKS, "").alias("line"),
                x.alias("raw"),
            ),
        ),
    )
    blank = lambda acc, x: (acc["level"] >= 0) & (F.trim(x["line"]) == "")
    runs = F.aggregate(
        "lines",
        F.struct(F.lit(-1).alias("level"), F.array().cast("array<struct<level:int,body:string>>").alias("runs")),
        lambda acc, x: F.struct(
            F.when(blank(acc, x), acc["level"]).otherwise(x["level"]).alias("level"),
            F.when(
                (acc["level"] == x["level"]) | blank(acc, x),
                F.concat(
                    F.slice(acc["runs"], 1, F.size(acc["runs"]) - 1),
                    F.array(F.struct(acc["level"].alias("level"), F.concat_ws("\n", F.element_at(acc["runs"], -1)["body"], x["line"]).alias("body"))),
                ),
            ).otherwise(F.concat(acc["runs"], F.array(F.struct(x["level"].alias("level"), x["line"].alias("body"))))).alias("runs"),
        ),
        lambda acc: acc["runs"],
    )
    quoted = F.exists("lines", lambda x: x["level"] > 0)
    single = F.array(F.struct(F.lit(0).alias("level"), F.coalesce("text", F.lit("")).alias("body")))
    plain = F.trim(F.array_join(F.transform(F.filter("lines", lambda x: x["level"] == 0), lambda x: x["raw"]), "\n"))

    def hashed(run):
        text = normal(run["body"])
        return F.struct(run["level"].alias("level"), F.when(text != "", F.sha2(text, 256)).alias("hash"), paragraphs(run["body"]).alias("paragraphs"))

    made = F.transform(F.when(quoted, runs).otherwise(single), hashed)
    body = F.when(quoted, plain).otherwise(F.trim(F.coalesce("text", F.lit(""))))
    return lined.select("conv_id", "turn", "role", body.alias("body"), F.filter(made, lambda p: p["hash"].isNotNull()).alias("passages"))


def shared_origins(runs: DataFrame, told: DataFrame) -> DataFrame:
    """(conv_id, level, hash, layout, kind, part, origin): the first turn that holds
    all paragraphs (kind 0) or lines (1) of a run, or paragraph ``part`` of it, whole
    (2) or by its lines (3), at ``level``."""
    unit = lambda kind, part, parts: F.struct(F.lit(kind).alias("kind"), part.cast("int").alias("part"), F.array_distinct(parts).alias("parts"))
    whole, none = F.transform("paragraphs", lambda p: p["hash"]), F.lit(-1)
    units = F.concat(
        F.array(unit(0, none, whole), unit(1, none, F.flatten(F.transform("paragraphs", lambda p: p["lines"])))),
        F.transform("paragraphs", lambda p, i: unit(2, i, F.array(p["hash"]))),
        F.transform("paragraphs", lambda p, i: unit(3, i, p["lines"])),
    )
    key, word = ["conv_id", "level", "hash", "layout", "kind", "part"], ["conv_id", "level", "h"]
    made = runs.select("conv_id", "level", "hash", "layout", F.explode(units).alias("u")).select(*key[:4], "u.kind", "u.part", F.size("u.parts").alias("n"), F.explode("u.parts").alias("h"))
    made = checkpoint(made)
    held = F.array_distinct(F.concat(F.transform("paragraphs", lambda p: p["hash"]), F.flatten(F.transform("paragraphs", lambda p: p["lines"]))))
    stood = told.select("conv_id", "turn", "level", F.explode(held).alias("h")).join(made.select(*word).distinct(), word, "left_semi")
    stood = checkpoint(stood.distinct())
    firsts = stood.groupBy(*word).agg(F.min("turn").alias("first"), F.count("*").alias("times"))
    known = checkpoint(made.join(firsts, word))
    # no turn before the latest first turn holds all parts
    least = known.groupBy(*key).agg(F.max("n").alias("n"), F.count("*").alias("found"), F.max("first").alias("turn"), F.min_by("h", "times").alias("rarest"))
    least = checkpoint(least.where("found = n").drop("found"))

    def holding(tried):
        """Of the (key, n, turn) tried, the first turn that holds all parts."""
        met = tried.join(known.select(*key, "h"), key).join(stood, [*word, "turn"])
        return met.groupBy(*key, "turn").agg(F.max("n").alias("n"), F.count("*").alias("found")).where("found = n").groupBy(*key).agg(F.min("turn").alias("origin"))

    at_once = checkpoint(holding(least.select(*key, "n", "turn")))
    rest = least.join(at_once, key, "left_anti").withColumnRenamed("turn", "after")
    turns = stood.select("conv_id", "level", F.col("h").alias("rarest"), "turn")
    later = rest.join(turns, ["conv_id", "level", "rarest"]).where("turn > after").select(*key, "n", "turn")
    return at_once.union(holding(later))


def quoted_turns(rows: DataFrame) -> DataFrame:
    """(conv_id, turn, quoted, n_quotes, n_linked) of every message that quotes."""
    quoting = checkpoint(rows.where(F.col("text").rlike("(?:^|[\\r\\n])[ \\t]*>")).select("conv_id").distinct())
    # a checkpoint, or the passages of all messages would be made below the join
    told = passages(checkpoint(rows.join(broadcast_if_small(quoting, 64), "conv_id", "left_semi")))
    told = checkpoint(told.select("conv_id", "turn", F.explode("passages").alias("p")).select("conv_id", "turn", "p.*"))
    run = ["conv_id", "level", "hash", "layout"]
    quotes = told.where("level > 0").withColumns({"level": F.col("level") - 1, "layout": F.xxhash64("paragraphs")})
    quotes = quotes.groupBy("turn", *run).agg(F.count("*").alias("times"), F.first("paragraphs").alias("paragraphs"))
    firsts = told.groupBy("conv_id", "level", "hash").agg(F.min("turn").alias("origin"))
    linked = quotes.join(firsts, ["conv_id", "level", "hash"], "left").withColumn("origin", F.when(F.col("origin") < F.col("turn"), F.col("origin")))
    linked = checkpoint(linked)
    lost = linked.where("origin is null")
    if lost.take(1):
        origins = shared_origins(lost.groupBy(*run).agg(F.first("paragraphs").alias("paragraphs")), told)
        found = lost.select("turn", *run).join(origins, run).where("origin < turn")
        found = found.groupBy("turn", *run, "part").agg(F.min_by("origin", "kind").alias("origin"))
        whole, parts = F.max(F.when(F.col("part") < 0, F.col("origin"))), F.max(F.when(F.col("part") >= 0, F.col("origin")))
        found = found.groupBy("turn", *run).agg(F.coalesce(whole, parts).alias("shared"))
        linked = linked.join(found, ["turn", *run], "left").withColumn("origin", F.coalesce("origin", "shared"))
    return linked.groupBy("conv_id", "turn").agg(F.max("origin").alias("quoted"), F.sum("times").alias("n_quotes"), F.sum(F.when(F.col("origin").isNotNull(), F.col("times"))).alias("n_linked"))


def chain_places(chains: DataFrame) -> DataFrame:
    """(conv_id, start, first, base): the place of each chain's first message
    in the walk of its conversation's trees, and its depth.

    The walk enters a chain, passes the chains that branch off it (the nearest
    origin first, then by start) and leaves it: a list of two stops per chain,
    each of which knows the stop before.  Pointer doubling sums up what lies
    before a stop, messages and steps down less steps up, in two numbers."""
    siblings = Window.partitionBy("conv_id", "up").orderBy(F.desc("reply_to"), "start")
    placed = chains.withColumn("elder", F.lag("start").over(siblings))
    last = placed.groupBy("conv_id", "up").agg(F.max_by("start", F.struct(-F.col("reply_to"), F.col("start"))).alias("youngest"))
    last = last.where("up is not null").withColumnRenamed("up", "start")
    step = F.coalesce(F.col("reply_to") - F.col("up") + 1, F.lit(0))
    enter = placed.select(
        "conv_id", "start", F.lit(False).alias("left"), F.coalesce("elder", "up").alias("before"), F.col("elder").isNotNull().alias("before_left"), F.col("n").alias("first"), step.alias("base")
    )
    leave = placed.join(last, ["conv_id", "start"], "left").select(
        "conv_id", "start", F.lit(True).alias("left"), F.coalesce("youngest", "start").alias("before"), F.col("youngest").isNotNull().alias("before_left"), F.lit(0).cast("long").alias("first"), (-step).alias("base")
    )
    stops = checkpoint(enter.unionByName(leave))
    while True:
        ahead = stops.select("conv_id", F.col("start").alias("before"), F.col("left").alias("before_left"), F.col("before").alias("next"), F.col("before_left").alias("next_left"), F.col("first").alias("more"), F.col("base").alias("deeper"))
        met = stops.join(ahead, ["conv_id", "before", "before_left"], "left")
        zero = F.lit(0).cast("long")
        stops = checkpoint(
            met.select("conv_id", "start", "left", F.col("next").alias("before"), F.coalesce("next_left", F.lit(False)).alias("before_left"), (F.col("first") + F.coalesce("more", zero)).alias("first"), (F.col("base") + F.coalesce("deeper", zero)).alias("base"))
        )
        if not stops.where("before is not null").take(1):
            break
    sizes = chains.select("conv_id", "start", "n")
    return stops.where("not left").join(sizes, ["conv_id", "start"]).select("conv_id", "start", (F.col("first") - F.col("n")).alias("first"), "base")


def link_quotes(messages: DataFrame) -> DataFrame:
    """conv_id, turn, role, text (without quotes), n_quotes, n_linked,
    reply_to, thread (first turn of the chain), depth, reply_order."""
    rows = messages.where("conv_id is not null and turn is not null")
    rows = rows.select("conv_id", F.col("turn").cast("long").alias("turn"), "role", "text")
    cut = checkpoint(passages(rows).select("conv_id", "turn", "role", "body"))
    linked = quoted_turns(rows)

    turns = cut.select("conv_id", "turn").distinct()
    before = turns.select("conv_id", (F.col("turn") + 1).alias("turn"), F.col("turn").alias("previous"))
    nodes = turns.join(linked, ["conv_id", "turn"], "left").join(before, ["conv_id", "turn"], "left")
    nodes = nodes.withColumn("reply_to", F.coalesce("quoted", "previous"))
    starts = F.col("reply_to").isNull() | (F.col("reply_to") < F.col("turn") - 1)
    nodes = checkpoint(nodes.withColumns({"start": F.when(starts, F.col("turn")), "block": F.floor(F.col("turn") / BLOCK_TURNS)}).drop("previous", "quoted"))

    # the chain of a message: the last start up to its turn, in its block or an earlier one
    upto = Window.partitionBy("conv_id", "block").orderBy("turn").rowsBetween(Window.unboundedPreceding, 0)
    earlier = Window.partitionBy("conv_id").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    carried = nodes.groupBy("conv_id", "block").agg(F.max("start").alias("last")).select("conv_id", "block", F.max("last").over(earlier).alias("carried"))
    placed = nodes.withColumn("own", F.max("start").over(upto)).join(carried, ["conv_id", "block"])
    placed = checkpoint(placed.withColumn("thread", F.coalesce("own", "carried")).drop("own", "carried", "block"))

    # a chain that branches off: after all later messages of its origin's chain, the nearest origin first
    origin = placed.select("conv_id", F.col("turn").alias("reply_to"), F.col("thread").alias("up"))
    sizes = placed.groupBy("conv_id", "thread").agg(F.count("*").alias("n")).withColumnRenamed("thread", "start")
    chains = placed.where("start is not null").select("conv_id", "start", "reply_to").join(origin, ["conv_id", "reply_to"], "left")
    places = chain_places(checkpoint(chains.join(sizes, ["conv_id", "start"]))).withColumnRenamed("start", "thread")
    placed = placed.drop("start").join(places, ["conv_id", "thread"])
    along = F.col("turn") - F.col("thread")
    placed = placed.withColumns({"reply_order": F.col("first") + along, "depth": F.col("base") + along}).drop("first", "base")
    count = lambda c: F.coalesce(c, F.lit(0)).cast("long").alias(c)
    out = cut.select("conv_id", "turn", "role", F.col("body").alias("text")).join(placed, ["conv_id", "turn"])
    out = out.select("conv_id", "turn", "role", "text", count("n_quotes"), count("n_linked"), "reply_to", "thread", "depth", "reply_order")
    return out.orderBy("conv_id", "reply_order")
