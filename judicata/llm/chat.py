"""Chat formatting by quotation linking (native).

A line's quote level is the number of ``>`` before its content.  Quoted text is
compared in two units, both normalised (A-Z lowered, runs of white space to one
space) and hashed to 128 bits: single lines, and whole runs of lines of one
level against whole own texts, so that re-wrapped quotes match too.  A quoted
unit belongs to the latest earlier message of the conversation whose own
(unquoted) text has it.  A message replies to the candidate that its lowest
quote level names, with the most quoted characters (the later turn on a tie).

Reply order sorts by (turn of the quoted message or the own turn, own turn):
replies stand behind what they quote, and a message never stands before the one
it replies to.  Quoted lines, and an attribution line straight before them, go.

No task holds a conversation: matching runs in blocks of turns with the latest
turn of every unit carried over, and positions come from range partitions.

Defined cases: a null text stays null and quotes nothing; a message of quotes
alone has an empty text; a null conversation is a conversation; messages
without a turn come first and link to nothing; repeated rows stay, each with a
place of its own.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from judicata.llm.common import SPACES, lower_ascii, materialise

QUOTE = r"^(?:[ \t]*>)+"
ATTRIBUTION = r"(?i)^.*\b(?:wrote|schrieb|écrit|escribió)[ \t]*:[ \t]*$"
#: Turns in a block of the as-of match.
BLOCK = 1024


def level(line: Column) -> Column:
    return F.char_length(F.regexp_replace(F.regexp_extract(line, QUOTE, 0), "[^>]", ""))


def normal(text: Column) -> Column:
    return F.btrim(F.regexp_replace(lower_ascii(text), r"[\x20\x09-\x0D]+", " "))


def quotation_units(msgs: DataFrame, min_chars: int) -> DataFrame:
    """(conv, k1, k2, turn, mid, lvl, chars) for own (lvl 0) and quoted units."""
    lines = (msgs.where(F.col("turn").isNotNull())
             .select("conv", "turn", "mid", F.posexplode("lines").alias("i", "line"))
             .select("conv", "turn", "mid", "i", level(F.col("line")).alias("lvl"),
                     normal(F.regexp_replace("line", QUOTE, "")).alias("unit")))
    quoting = lines.where(F.col("lvl") > 0).select("conv").distinct()
    lines = lines.join(quoting, lines["conv"].eqNullSafe(quoting["conv"]), "left_semi")
    run = F.col("i") - F.row_number().over(Window.partitionBy("mid", "lvl").orderBy("i"))
    blocks = (lines.withColumn("run", F.when(F.col("lvl") > 0, run))
              .where(F.col("unit") != "")
              .groupBy("conv", "turn", "mid", "lvl", "run")
              .agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("i", "unit"))),
                                            lambda s: s["unit"]), " ").alias("unit")))
    cols = ["conv", "turn", "mid", "lvl", "unit"]
    units = (lines.select(*cols).withColumn("kind", F.lit(0))
             .unionByName(blocks.select(*cols).withColumn("kind", F.lit(1)))
             .where(F.char_length("unit") >= min_chars))
    return units.select("conv", F.xxhash64("kind", "unit").alias("k1"), F.xxhash64("unit", "kind").alias("k2"),
                        "turn", "mid", "lvl", F.char_length("unit").alias("chars"))


def latest_originals(units: DataFrame) -> DataFrame:
    """Every quoted unit with ``orig``, the latest earlier turn that has it as own text."""
    key = ["conv", "k1", "k2"]
    wanted = units.where(F.col("lvl") > 0).select(F.col("conv").alias("c"), F.col("k1").alias("a"), F.col("k2").alias("b")).distinct()
    u = (units.join(wanted, units["conv"].eqNullSafe(wanted["c"]) & (units["k1"] == wanted["a"]) & (units["k2"] == wanted["b"]), "left_semi")
         .withColumn("block", F.floor(F.col("turn") / BLOCK)))
    u = u.withColumn("own", F.when(F.col("lvl") == 0, F.col("turn")))
    in_block = Window.partitionBy(*key, "block").orderBy("turn").rangeBetween(Window.unboundedPreceding, -1)
    before = Window.partitionBy(*key).orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    carry = (u.groupBy(*key, "block").agg(F.max("own").alias("own"))
             .withColumn("carried", F.max("own").over(before))
             .where(F.col("carried").isNotNull())
             .select(*[F.col(c).alias(f"_{c}") for c in [*key, "block"]], "carried"))
    u = u.withColumn("near", F.max("own").over(in_block)).where(F.col("lvl") > 0)
    on = [u["conv"].eqNullSafe(carry["_conv"]), u["k1"] == carry["_k1"], u["k2"] == carry["_k2"], u["block"] == carry["_block"]]
    return (u.join(carry, on, "left")
            .select("mid", "lvl", "chars", F.coalesce("near", "carried").alias("orig")).where(F.col("orig").isNotNull()))


def parents(originals: DataFrame) -> DataFrame:
    votes = originals.groupBy("mid", "lvl", "orig").agg(F.sum("chars").alias("chars"))
    best = F.max(F.struct((-F.col("lvl")).alias("l"), "chars", "orig"))
    return votes.groupBy("mid").agg(best.alias("best")).select("mid", F.col("best.orig").alias("parent_turn"))


def reply_ordered(messages: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", text_col: str = "text",
                  min_chars: int = 8) -> DataFrame:
    """The input's rows and columns, the text without quotes, plus parent_turn,
    n_quoted (quoted lines) and position (gapless from 0 in the conversation).
    Columns of the input with one of these three names give way."""
    through = [c for c in messages.columns if c not in ("parent_turn", "n_quoted", "position")]
    rest = F.struct(*[F.col(f"`{c}`") for c in through if c != text_col])
    msgs = materialise(messages.select(
        F.col(conv_col).alias("conv"), F.col(turn_col).cast("long").alias("turn"), rest.alias("rest"),
        F.col(text_col).isNull().alias("none"), F.split(F.coalesce(F.col(text_col), F.lit("")), "\n", -1).alias("lines"),
        F.monotonically_increasing_id().alias("mid")))
    linked = parents(latest_originals(materialise(quotation_units(msgs, min_chars))))
    m = msgs.join(linked, "mid", "left").withColumn(
        "quotes", F.transform("lines", lambda x: x.rlike(QUOTE)))
    keep = F.filter("lines", lambda x, i: ~x.rlike(QUOTE) & ~(
        x.rlike(ATTRIBUTION) & F.coalesce(F.get(F.col("lines"), i + 1).rlike(QUOTE), F.lit(False))))
    any_quote = F.array_contains("quotes", True)
    own = F.when(any_quote, F.btrim(F.array_join(keep, "\n"), F.lit(SPACES))).otherwise(F.array_join("lines", "\n"))
    m = m.select("conv", "turn", "mid", "rest", "parent_turn", F.when(~F.col("none"), own).alias("own_text"),
                 F.size(F.filter("quotes", lambda q: q)).cast("long").alias("n_quoted"),
                 F.coalesce("parent_turn", "turn").alias("anchor"))
    order = ["conv", "anchor", "turn", "mid"]
    m = materialise(m.repartitionByRange(*order).sortWithinPartitions(*order)
                    .withColumn("gid", F.monotonically_increasing_id()))
    m = m.withColumn("part", F.shiftright("gid", 33))
    # a row per conversation and range partition: rows of the conversation in earlier partitions
    before = Window.partitionBy("_conv").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    runs = (m.groupBy(F.col("conv").alias("_conv"), F.col("part").alias("_part"))
            .agg(F.count("*").alias("n"), F.min("gid").alias("first"))
            .withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0))))
    m = m.join(runs, m["conv"].eqNullSafe(runs["_conv"]) & (m["part"] == runs["_part"]))
    return m.select(*[F.col(f"rest.`{c}`").alias(c) if c != text_col else F.col("own_text").alias(c) for c in through],
                    "parent_turn", "n_quoted", (F.col("before") + F.col("gid") - F.col("first")).alias("position"))
