"""Sources interleaved to target weights by Pfair scheduling, in DataFrame functions only.

A source's rows are cut into blocks of equal length. With shares r_s that sum to 1, block j (from 0)
of source s is released at slot floor(j / r_s) and due at slot ceil((j + 1) / r_s); each slot goes to
the released block with the earliest deadline. Up to any slot each source then has its share of the
slots to within less than one block.

Slots are given out for one period of A slots, in which source s has a_s = r_s A of them; block j
takes slot (j div a_s) A + offset_s(j mod a_s). The schedule is one of classes: each source is one
if weights are whole numbers, and all sources of a weight are one if weights are real. n sources of a
class that has a slots get a / n each, and take the class's blocks in turns. Block j of member i is
block j n + i of its class, which lies in its own window too: the deviation stays below one block
for every source, whatever their number.

Only the type of the weights decides this, never the number or size of the sources. Whole weights are
the slots of their sources, whatever their sum. Real ones are given whole slots of MOST_SLOTS, at
least one for each class, so the share of a class is off by less than 1 / MOST_SLOTS of the mix.

The slots of a period, up to the last that is needed, are given out by window functions. At each slot
as many blocks wait as were released up to it and not served. For the blocks of the most urgent
deadlines alone, that follows from a running count and a running minimum, whatever the others do. So
one pass divides slots and blocks by the first digit of the deadline, the next one each part by the
second digit, and so on, until a part is one block and its slot.

A source that has run out leaves its slots empty, and the others keep theirs. No row is dropped or
repeated.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from smelter.llm.tables import named, with_results
from smelter.operators import stage

BLOCK_ROWS = 16
#: Rows of one source, or sources of one class, that are ranked together; more are cut into ranges.
RANGE_ROWS = 5_000
#: Classes of a schedule: no limit.
MOST_CLASSES = math.inf
#: Slots of a period, if weights are real.
MOST_SLOTS = 10_000_000
#: Offsets of a class that are kept together.
PIECE = 1_024
#: Bits of a deadline by which a pass divides slots and blocks.
DIGIT_BITS = 4


def _div(a: Column, b: Column, up: bool = False) -> Column:
    """``a / b`` as a long, rounded down or up; both are whole and not negative."""
    return F.call_function("div", a + b - 1 if up else a, b)


def _wide(number: Column) -> Column:
    """For products of two longs."""
    return number.cast("decimal(19,0)")


def _given(blocks: DataFrame, slots: DataFrame, most: int) -> DataFrame:
    """(number, turn, slot): each slot goes to the released block of the least urgency.

    ``blocks``: (number, turn, release, urgency), of different urgencies up to ``most``; ``slots``:
    (slot), numbered from 0. Slots at which no block waits are left out.
    """
    none = F.lit(None).cast("long")
    events = blocks.select(
        F.lit(0).cast("long").alias("part"), F.col("release").alias("at"), F.lit(False).alias("is_slot"), "urgency", "number", "turn", none.alias("slot")
    ).unionByName(
        slots.select(
            F.lit(0).cast("long").alias("part"), F.col("slot").alias("at"), F.lit(True).alias("is_slot"),
            none.alias("urgency"), none.alias("number"), none.alias("turn"), "slot",
        )
    )
    kept = [c for c in events.columns if c not in ("part", "at")]
    # Within a part, ``at`` numbers its slots from 0; blocks stand before the first slot that they may get.
    order = Window.partitionBy("part").orderBy("at", "is_slot")
    until, before = order.rowsBetween(Window.unboundedPreceding, 0), order.rowsBetween(Window.unboundedPreceding, -1)
    digits = range(1 << DIGIT_BITS)
    for shift in reversed(range(0, max(1, most.bit_length()), DIGIT_BITS)):
        digit = F.shiftright("urgency", shift).bitwiseAND(F.lit(len(digits) - 1))
        events = events.withColumn("digit", digit)
        # Blocks of this digit or a lower one that are released, less the slots gone by.
        events = events.withColumns(
            {f"open{k}": F.count(F.when(F.col("digit") <= k, 1)).over(until) - F.col("at") for k in digits}
        )
        events = events.withColumns(
            {f"least{k}": F.least(F.lit(1), F.min(F.when(F.col("is_slot"), F.col(f"open{k}"))).over(before)) for k in digits}
        )
        mine = F.coalesce("digit", *[F.when(F.col(f"open{k}") >= F.col(f"least{k}"), F.lit(k).cast("long")) for k in digits])
        # Slots gone by that blocks of up to each digit got.
        served = F.array(F.lit(0).cast("long"), *[F.col("at") - 1 + F.col(f"least{k}") for k in digits])
        events = events.withColumn("digit", mine).where("digit is not null").withColumn("served", served)
        events = events.select(
            (F.col("part") * len(digits) + F.col("digit")).alias("part"),
            (F.get("served", F.col("digit").cast("int") + 1) - F.get("served", F.col("digit").cast("int"))).alias("at"),
            *kept,
        )
        # Staged, as a plan of all passes takes Spark long to optimize.
        events = stage(events, "divided")
    # One block and one slot a part.
    pairs = events.groupBy("part").agg(F.max("number").alias("number"), F.max("turn").alias("turn"), F.max("slot").alias("slot"))
    return pairs.drop("part")


def _schedule(sources: DataFrame, whole: bool) -> tuple[DataFrame, DataFrame]:
    """(__class, __number, __slots, __members, __period), a row for each class, and (__at, __piece,
    __offsets): the slots of a class in a period, PIECE of them a row.

    ``sources`` has ``class``, ``weight`` and ``blocks``. Slots after the last that is needed are left out.
    """
    spark = sources.sparkSession
    classes = sources.groupBy("class").agg(
        F.sum("weight").alias("mass"), F.count("*").alias("members"), F.max("blocks").alias("blocks")
    )
    classes = stage(classes, "classes")
    if whole:
        slots = F.col("mass")
    else:
        total = classes.agg(F.sum("mass")).first()[0] or 1
        slots = F.greatest(F.lit(1), F.round(F.col("mass") * F.lit(MOST_SLOTS / total))).cast("long")
    classes = classes.withColumn("slots", slots)
    n, period = classes.agg(F.count("*"), F.coalesce(F.sum("slots"), F.lit(0))).first()
    # In their order, which decides between equal deadlines.
    numbered = classes.select("*", F.row_number().over(Window.orderBy("class")).cast("long").alias("number"))
    classes = stage(numbered.withColumn("period", F.lit(period).cast("long")), "numbered")
    length, slots = F.col("period"), F.col("slots")
    needed = F.least(slots, F.col("blocks") * F.col("members"))
    end = classes.agg(F.max(_div(_wide(needed) * _wide(length), slots, up=True))).first()[0] or 0
    # Blocks due later take no slot from those due by the end.
    due = classes.select("*", _div(F.lit(end).cast("decimal(19,0)") * _wide(slots), length).alias("n"))
    # In two steps, so that no row holds all blocks of a class.
    pieces = due.select("*", F.explode(F.sequence(F.lit(0).cast("long"), _div(F.col("n") - 1, F.lit(PIECE)))).alias("piece"))
    first = F.col("piece") * PIECE
    turns = pieces.select("*", F.explode(F.sequence(first, F.least(first + PIECE, F.col("n")) - 1)).alias("turn"))
    blocks = turns.select(
        "number",
        "turn",
        _div(_wide(F.col("turn")) * _wide(length), slots).alias("release"),
        (_div(_wide(F.col("turn") + 1) * _wide(length), slots, up=True) * (n + 1) + F.col("number")).alias("urgency"),
    )
    given = _given(blocks, spark.range(end).select(F.col("id").alias("slot")), (end + 1) * (n + 1))
    offsets = given.groupBy(F.col("number").alias("__at"), _div(F.col("turn"), F.lit(PIECE)).alias("__piece")).agg(
        F.sort_array(F.collect_list("slot")).alias("__offsets")
    )
    return classes.select(
        F.col("class").alias("__class"),
        F.col("number").alias("__number"),
        F.col("slots").alias("__slots"),
        F.col("members").alias("__members"),
        F.col("period").alias("__period"),
    ), offsets


def _ranked(rows: DataFrame, group: str, tie: Column) -> DataFrame:
    """``rows`` with ``__rank``, their number from 0 within ``group`` by ``__hash``, then ``tie``.

    ``__ranges`` says into how many ranges of the hash a group is cut; no task holds it whole.
    """
    # Equal widths of the hash's range: range r of n holds the hashes with floor(u n) = r.
    unit = F.shiftrightunsigned("__hash", 11).cast("double") / F.lit(float(1 << 53))
    ranged = rows.withColumn("__range", F.floor(unit * F.col("__ranges")).cast("long"))
    sizes = ranged.groupBy(F.col(group).alias("__s"), F.col("__range").alias("__r")).agg(F.count("*").alias("n"))
    earlier = Window.partitionBy("__s").orderBy("__r").rowsBetween(Window.unboundedPreceding, -1)
    # Staged, so that Spark knows their size when it plans the join; small ones are broadcast.
    offsets = stage(
        sizes.select("__s", "__r", F.coalesce(F.sum("n").over(earlier), F.lit(0).cast("long")).alias("__before")),
        "offsets",
    )
    within = Window.partitionBy(group, "__range").orderBy(F.col("__hash"), tie)
    numbered = ranged.withColumn("__row", F.row_number().over(within).cast("long") - 1)
    same = F.col(group).eqNullSafe(F.col("__s")) & (F.col("__range") == F.col("__r"))
    return numbered.join(offsets, same).withColumn("__rank", F.col("__before") + F.col("__row")).drop(
        "__s", "__r", "__before", "__row", "__range"
    )


def proportional_weights(docs: DataFrame, source: str = "source", scale: int | None = None,
                         power: float = 0.5) -> DataFrame:
    """Weights as the sources' row counts to ``power``: real numbers, or with ``scale`` whole ones
    of about that sum, at least 1 each.
    """
    counts = docs.groupBy(F.coalesce(named(source), F.lit("")).alias("source")).agg(
        F.pow(F.count("*"), F.lit(power)).alias("mass")
    )
    if scale is None:
        return counts.select("source", F.col("mass").alias("weight"))
    counts = stage(counts, "source-sizes")
    total = counts.agg(F.sum("mass")).first()[0]
    share = F.col("mass") / F.lit(total or 1.0)
    return counts.select("source", F.greatest(F.lit(1), F.round(scale * share)).cast("long").alias("weight"))


def mix(
    docs: DataFrame,
    weights: DataFrame,
    key: str = "doc_id",
    source: str = "source",
    block_rows: int = BLOCK_ROWS,
    range_rows: int = RANGE_ROWS,
) -> DataFrame:
    """``docs`` with their places in the mix; order by ``position`` to read it.

    ``weights``: (source, weight) with positive numbers, whole or real. Adds ``block`` (number
    within the source), ``slot``, ``release`` and ``deadline`` (in slots) and ``position``.
    Positions are unique and ascending in slots; those of the rows that a source's last block lacks,
    and of the slots that a source left empty, are skipped.

    Rows of a source follow each other in a fixed random order, by a hash of the key; a source of
    any size is ranked in ranges of that hash, so no task holds it whole.

    Defined cases: a null source is the source ''; a source without a weight is an error; weights of
    sources without rows are ignored; rows with equal keys follow each other in any order; an empty
    table gives an empty result; input columns named like a result are replaced.
    """
    own = F.coalesce(named(source), F.lit(""))
    hashed = F.xxhash64(named(key).cast("string"), own)
    whole = isinstance(weights.schema["weight"].dataType, T.IntegralType)
    kind = "long" if whole else "double"
    counts = docs.groupBy(own.alias("__source")).agg(F.count("*").alias("rows"))
    known = counts.join(weights.withColumnRenamed("source", "__w"), F.col("__source") == F.col("__w"), "left")
    sources = known.select(
        F.col("__source").alias("source"),
        F.when(F.col("weight") > 0, F.col("weight").cast(kind))
        .otherwise(F.raise_error(F.concat(F.lit("no positive weight for source "), F.col("__source"))).cast(kind))
        .alias("weight"),
        F.ceil(F.col("rows") / block_rows).cast("long").alias("blocks"),
        F.greatest(F.lit(1), F.ceil(F.col("rows") / range_rows)).cast("long").alias("ranges"),
    )
    sources = stage(sources.withColumn("class", F.col("source") if whole else F.col("weight")), "sources")
    classes, pieces = _schedule(sources, whole)
    # Staged, so that Spark knows its size when it plans the join.
    pieces = stage(pieces, "schedule")
    members = sources.withColumn("__hash", F.xxhash64("source")).join(classes, F.col("class").eqNullSafe(F.col("__class")))
    members = members.withColumn("__ranges", F.ceil(F.col("__members") / range_rows))
    members = stage(
        _ranked(members, "__number", F.col("source")).select(
            F.col("source").alias("__source"),
            "__number",
            "__slots",
            "__members",
            "__period",
            F.col("__rank").alias("__member"),
            F.col("ranges").alias("__ranges"),
        ),
        "members",
    )
    placed = docs.withColumn("__hash", hashed).join(members, own == F.col("__source"))
    ranked = _ranked(placed, "__source", named(key))
    slots, period = F.col("__slots"), F.col("__period")
    ranked = ranked.withColumn("__block", F.floor(F.col("__rank") / block_rows).cast("long"))
    ranked = ranked.withColumn("__turn", F.col("__block") * F.col("__members") + F.col("__member"))
    ranked = ranked.withColumn("__left", F.pmod("__turn", slots))
    done = ranked.join(
        pieces, (F.col("__number") == F.col("__at")) & (F.floor(F.col("__left") / PIECE) == F.col("__piece"))
    )

    def at(turn: Column, up: bool = False) -> Column:
        """The slot at which a class's block of this number begins: the floor, or the ceiling."""
        left = _wide(F.pmod(turn, slots)) * _wide(period)
        return _div(turn, slots) * period + _div(left, slots, up)

    first = F.col("__block") * F.col("__members")
    offset = F.get("__offsets", F.pmod("__left", F.lit(PIECE)).cast("int"))
    slot = _div(F.col("__turn"), slots) * period + offset
    results = {
        "block": F.col("__block"),
        "slot": slot,
        "release": at(first),
        "deadline": at(first + F.col("__members"), up=True),
        "position": slot * block_rows + F.pmod(F.col("__rank"), F.lit(block_rows)),
    }
    inner = [c for c in done.columns if c not in docs.columns]
    return with_results(done, results).drop(*inner)
