"""A road graph from survey sections: which ends are one place, and where a counter sits on its unit's sections."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from countflow.operators.windows import chain_segments

# Fixed values of the survey: an end's kind says what its code or name means.
#: The code names another section, whose end (1) or start (2) is met.
AT_END, AT_START = 1, 2
#: A border whose code names the section beyond it.
BORDER = 3
#: Kinds that are told apart by their code; the others by their name.
BY_CODE = (1, 2, 3, 4)
#: A border of towns: its name lists them in any order.
TOWNS = 6
#: Ends of this kind are never one place; ends of the others may be without a name.
OPEN, NAMELESS = 8, (5, 9)
BORDER_WORD, BETWEEN = "境", "・"


def point(key: Column | str, side: str) -> Column:
    """The name of a section's start (``s``) or end (``e``)."""
    return F.concat((F.col(key) if isinstance(key, str) else key).cast("string"), F.lit(f":{side}"))


def _value(kind: str, code: str, name: str) -> Column:
    """What tells an end's place apart among those of its kind."""
    towns = F.array_join(F.array_sort(F.array_distinct(F.split(F.replace(name, F.lit(BORDER_WORD), F.lit("")), BETWEEN))), BETWEEN)
    return F.coalesce(F.when(F.col(kind).isin(*BY_CODE), F.col(code)).when(F.col(kind) == TOWNS, towns).otherwise(F.col(name)), F.lit(""))


def same_place_edges(sections: DataFrame, key: str, group: str) -> DataFrame:
    """(a, b, rule): ends of sections that are one place, named ``key:s`` and ``key:e``. ``sections`` has ``start_kind``, ``start_code``, ``start_name`` and the same for the end;
    codes are texts like the key, in whose order a group's sections follow one another.

    - ``next``: an end and the start of the group's next section, if kind and code (or name; of town borders the set of towns) are equal.
    - ``junction``: an end of kind 1 or 2 whose code is a section: that one's end or start.
    - ``border``: an end of kind 3 whose code is a section that names this one back with exactly one of its own ends.

    One window by group and three equality joins on the key; a null kind or code meets nothing.
    """
    text = F.col(key).cast("string")
    s = sections.select(text.alias("k"), F.col(key).alias("_o"), F.col(group).alias("g"), *[F.col(f"{x}_{y}") for x in ("start", "end") for y in ("kind", "code", "name")])
    s = s.withColumn("sv", _value("start_kind", "start_code", "start_name")).withColumn("ev", _value("end_kind", "end_code", "end_name"))
    w = Window.partitionBy("g").orderBy("_o")
    after = s.withColumn("_k", F.lead("k").over(w)).withColumn("_kind", F.lead("start_kind").over(w)).withColumn("_sv", F.lead("sv").over(w))
    alike = (F.col("end_kind") == F.col("_kind")) & (F.col("ev") == F.col("_sv")) & (F.col("end_kind") != OPEN) & ((F.col("ev") != "") | F.col("end_kind").isin(*NAMELESS))
    follows = after.filter(alike).select(point("k", "e").alias("a"), point("_k", "s").alias("b"), F.lit("next").alias("rule"))

    sides = F.explode(F.array(*[F.struct(point("k", x[0]).alias("p"), F.col(f"{x}_kind").alias("kind"), F.col(f"{x}_code").alias("code")) for x in ("start", "end")]))
    ends = s.select("k", sides.alias("e")).select("k", "e.*").filter(F.col("code").isNotNull())
    named = ends.filter(F.col("kind").isin(AT_END, AT_START)).join(s.select(F.col("k").alias("code")), "code", "left_semi")
    junction = named.select(F.col("p").alias("a"), F.when(F.col("kind") == AT_END, point("code", "e")).otherwise(point("code", "s")).alias("b"), F.lit("junction").alias("rule"))

    border = ends.filter(F.col("kind") == BORDER)
    back = border.select(F.col("k").alias("code"), F.col("code").alias("k"), F.col("p").alias("_p"))
    mutual = border.join(back, ["code", "k"]).groupBy("p").agg(F.count("*").alias("n"), F.min("_p").alias("b")).filter("n = 1")
    return follows.unionByName(junction).unionByName(mutual.select(F.col("p").alias("a"), "b", F.lit("border").alias("rule"))).distinct()


def with_places(sections: DataFrame, labels: DataFrame, key: str) -> DataFrame:
    """``sections`` with ``start_place`` and ``end_place``: the component (node, label) that each end is in, or the end itself."""
    out = sections
    for x in ("start", "end"):
        of = labels.select(F.col("node").alias("_n"), F.col("label").alias(f"{x}_place"))
        out = out.withColumn("_p", point(key, x[0])).join(of, F.col("_p") == F.col("_n"), "left").withColumn(f"{x}_place", F.coalesce(f"{x}_place", "_p")).drop("_p", "_n")
    return out


def stretches(matches: DataFrame, sections: DataFrame, counter: str, section: str, town: str, unit: str = "unit", length: str = "km") -> DataFrame:
    """The sections of the stretch that each matched counter sits on, with ``from_km`` and ``to_km`` along it, ``placed_km`` (its length) and ``in_town``.

    ``matches``: counter, section (the observed one, which names the unit), town. ``sections``: section, unit, town, length, ``start_place``, ``end_place``. A counter's unit has the
    sections that name its section as their unit, or that section alone. Of these, those in the counter's town count, or all if none is (``in_town`` false). Sections in order of their keys
    that meet end to start are a stretch; the one that holds the observed section is taken, else the longest, the first among equals.
    """
    s = sections.select(F.col(section).alias("_s"), F.col(unit).alias("_unit"), F.col(town).alias("_town"), F.col(length).alias("_km"), "start_place", "end_place")
    of_units = s.filter("_unit IS NOT NULL")
    alone = s.join(of_units.select(F.col("_unit").alias("_s")).distinct(), "_s", "left_anti").withColumn("_unit", F.col("_s"))
    of_units = of_units.unionByName(alone)
    near = matches.select(counter, F.col(section).alias("_own"), town).join(of_units, F.col("_own") == F.col("_unit"))
    there = F.coalesce(F.col("_town") == F.col(town), F.lit(False))
    near = near.withColumn("_there", there).withColumn("in_town", F.max("_there").over(Window.partitionBy(counter))).filter("_there OR NOT in_town")
    chained = chain_segments(near, [counter], "_s", "start_place", "end_place", "_km")
    each = chained.groupBy(counter, "stretch").agg(F.sum("_km").alias("placed_km"), F.max(F.col("_s") == F.col("_own")).alias("_holds"))
    best = each.groupBy(counter).agg(F.max(F.struct("_holds", "placed_km", (-F.col("stretch")).alias("_n"))).alias("_b")).select(counter, (-F.col("_b._n")).alias("stretch"), F.col("_b.placed_km").alias("placed_km"))
    return chained.join(best, [counter, "stretch"]).select(counter, F.col("_own").alias(section), town, F.col("_s").alias("on_section"), "start_place", "end_place", "from_km", "to_km", "placed_km", "in_town")


def place_on_chain(stretch: DataFrame, counter: str, section: str, town: str) -> DataFrame:
    """One row for each counter of ``stretches``: the first and the last section of its stretch, ``placed_km`` and ``in_town``."""
    return stretch.groupBy(counter, section, town).agg(F.min("on_section").alias("from_section"), F.max("on_section").alias("to_section"), F.first("placed_km").alias("placed_km"), F.first("in_town").alias("in_town"))


def chain_points(stretch: DataFrame, counter: str) -> DataFrame:
    """(counter, node, offset): the places along each counter's stretch and how far they are from its middle; of a place that it meets twice the nearer point."""
    start = stretch.filter("from_km = 0").select(counter, F.col("start_place").alias("node"), F.col("from_km").alias("_at"), "placed_km")
    ends = stretch.select(counter, F.col("end_place").alias("node"), F.col("to_km").alias("_at"), "placed_km")
    return start.unionByName(ends).groupBy(counter, "node").agg(F.min(F.abs(F.col("_at") - F.col("placed_km") / 2)).alias("offset"))
