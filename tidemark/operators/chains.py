"""Canonical names by chaining overlapping value lists.

An entity shows several values (names) over time. Lists of values that overlap
inside one group describe the same thing; each chain's first value becomes the
name of all its members. The group is (``group``, ``traits``): rows with a null
trait never join.

Neither chaining step compares all lists of a group with each other. Candidates
meet through an equi-join on a shared value, each pair exactly once, and every
round is reduced to distinct states before the next.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.components import small_components
from tidemark.operators.keys import latest_per_key, left_join
from tidemark.session import cut_lineage

ROUNDS = 5


def _text(values: Column) -> Column:
    return F.to_json(values)


def value_lists(
    df: DataFrame, entity: str, group: str, value: str, date: str, traits: Sequence[str]
) -> DataFrame:
    """Distinct value lists per group, values ordered by first appearance.

    Of entities with the same list the one seen last is kept (then the one that
    appeared first). Values that appear on the same date are ordered by value.
    """
    spans = df.groupBy(entity, group, value).agg(
        *[F.min(t).alias(t) for t in traits],
        F.min(date).alias("first_seen_date"),
        F.max(date).alias("last_seen_date"),
    )
    ordered = F.array_sort(
        F.collect_list(
            F.when(F.col(value).isNotNull(), F.struct("first_seen_date", F.col(value).alias("v")))
        )
    )
    lists = spans.groupBy(entity, group).agg(
        *[F.min(t).alias(t) for t in traits],
        F.transform(ordered, lambda x: x["v"]).alias("value_list"),
        F.min("first_seen_date").alias("first_seen_date"),
        F.max("last_seen_date").alias("last_seen_date"),
    )
    return latest_per_key(
        lists,
        [group, "value_list", *traits],
        [F.col("last_seen_date").desc_nulls_first(), F.col("first_seen_date").asc_nulls_last(),
         F.col(entity).asc_nulls_last()],
    ).select(group, *traits, "value_list", "first_seen_date", "last_seen_date")


def chain_lists_sequential(
    lists: DataFrame, group: str, traits: Sequence[str], rounds: int = ROUNDS
) -> DataFrame:
    """Append lists that go on where a list ends; keep the distinct results.

    A list may be followed by another of its group when what they share is the
    beginning of the other, the other has more than one value, differs, and was
    last seen later than what has been appended so far. Up to ``rounds`` lists are
    appended, along every possible order; a state with no follower stays as is.

    What may follow depends on the base list alone (only the date moves on), and a follower
    adds just what the base does not have. So followers are found once, by an equi-join on
    the first value of the other list, and those of one base that add the same on the same
    day are one step. A walk is a digest of its base, the values added so far, a count and a
    date; lists are put together only for the walks that are left at the end.
    """
    keys = [group, *traits]
    base = lists.select(*keys, "value_list", "first_seen_date", "last_seen_date")
    # JSON names its fields, so that a null key is not mistaken for the next one.
    base = cut_lineage(base.withColumn("_base", F.md5(F.to_json(F.struct(*base.columns)))))
    steps = cut_lineage(_steps(base, keys))
    walks = _walks(base, steps, rounds)

    # Lists are built once; both the longest of a group and the rest read them.
    built = walks.join(base, "_base").withColumn("chained_list", F.array_distinct(F.concat("value_list", "_added")))
    state = cut_lineage(
        built.select(
            *keys, "value_list", "chained_list", "match_cnt", "first_seen_date",
            F.col("_seen").alias("last_seen_date"),
            F.try_element_at("chained_list", F.lit(-1)).alias("_tail"),
            F.size("chained_list").alias("_size"),
        )
    )
    longest = state.groupBy(*keys, "_tail").agg(F.max("_size").alias("max_list_size"))
    scored = (
        state.alias("s")
        .join(
            longest.alias("m"),
            [F.col(f"s.{k}").eqNullSafe(F.col(f"m.{k}")) for k in [*keys, "_tail"]],
        )
        .select("s.*", "m.max_list_size")
        .withColumn(
            "match_score",
            F.when(F.col("match_cnt") > 0, F.col("match_cnt")).when(
                F.size("value_list") == F.col("max_list_size"), 2
            ),
        )
        .filter(
            ((F.col("match_score") > 0) & (F.col("_size") > 1))
            | ((F.size("value_list") > 1) & (F.col("match_cnt") == 0))
        )
    )
    kept = latest_per_key(
        scored,
        [*keys, "chained_list"],
        [F.col("first_seen_date").asc_nulls_last(), F.col("value_list"), F.col("match_cnt"),
         F.col("last_seen_date")],
    )
    # A digest of group and list is unique after the reduction above, and needs no numbering of
    # a whole group.
    list_id = F.md5(F.concat_ws("\u0001", *[F.col(k).cast("string") for k in keys], _text(F.col("chained_list"))))
    return kept.withColumn("list_id", list_id).drop("_tail", "_size")


def _steps(base: DataFrame, keys: Sequence[str]) -> DataFrame:
    """(_base, _day, _adds) of what may be appended to each base list, and ``_last``, the latest such day.

    A pair of lists meets once: what they share begins with the other list's first value.
    """
    others = base.filter(F.size("value_list") > 1).select(
        *keys,
        F.get("value_list", F.lit(0)).alias("_meets"),
        F.col("value_list").alias("_other"),
        F.col("last_seen_date").alias("_day"),
    )
    shared = F.array_intersect("value_list", "_other")
    met = (
        base.withColumn("_meets", F.explode(F.array_distinct("value_list")))
        .join(others, [*keys, "_meets"])
        .filter(
            (F.col("_day") > F.col("last_seen_date"))
            & (F.col("value_list") != F.col("_other"))
            & (shared == F.slice("_other", F.lit(1), F.size(shared)))
        )
    )
    found = cut_lineage(met.select("_base", "_day", F.array_except("_other", "value_list").alias("_adds")).distinct())
    last = found.groupBy("_base").agg(F.max("_day").alias("_last"))
    return found.join(last, "_base")


def _walks(base: DataFrame, steps: DataFrame, rounds: int) -> DataFrame:
    """(_base, _added, match_cnt, _seen): every walk over later and later steps that ends or has used up its rounds."""
    nothing = F.array().cast(base.schema["value_list"].dataType)
    still = base.join(steps.select("_base").distinct(), "_base", "left_anti") if rounds else base
    done = [still.select("_base", nothing.alias("_added"), F.lit(0).alias("match_cnt"), F.col("last_seen_date").alias("_seen"))]
    if not rounds:
        return done[0].distinct()
    moving = steps.select("_base", F.col("_adds").alias("_added"), F.lit(1).alias("match_cnt"), F.col("_day").alias("_seen"), "_last")
    for count in range(2, rounds + 1):
        moving = cut_lineage(moving)
        done.append(moving.filter(F.col("_seen") >= F.col("_last")).drop("_last"))
        onward = moving.filter(F.col("_seen") < F.col("_last"))
        if onward.isEmpty():
            moving = onward
            break
        added = F.array_distinct(F.concat("_added", "_adds"))
        moving = (
            onward.join(steps.drop("_last"), "_base")
            .filter(F.col("_day") > F.col("_seen"))
            .select("_base", added.alias("_added"), F.lit(count).alias("match_cnt"), F.col("_day").alias("_seen"), "_last")
            .distinct()
        )
    return reduce(DataFrame.unionByName, [*done, moving.drop("_last")]).distinct()


def merge_lists_transitive(
    lists: DataFrame, group: str, traits: Sequence[str], rounds: int = ROUNDS
) -> DataFrame:
    """Merge overlapping chained lists of a group, whatever their order.

    Every list starts a walk that, ``rounds`` times, adds a list it overlaps and
    has not visited; a walk with nothing left to add stays. Only the set a walk
    has gathered matters for its next step: a list outside the set cannot have
    been visited, and after ``r`` steps a moving walk has visited ``r + 1`` lists,
    so it can still step onto a list inside its set exactly when the set contains
    more than ``r + 1`` of them. Walks with the same set are therefore one state,
    of which only the earliest starting list is remembered, and no visited list
    is carried along.

    In a connected component of at most ``rounds + 1`` lists every walk ends with all
    of them, so such components (most, as a rule) are merged at once; only lists of
    larger ones walk.

    Result: one row per gathered set with the first value of the earliest
    starting list (``first_value``).
    """
    keys = [group, *traits]
    members = F.array_sort("chained_list")
    origin = F.struct(
        F.col("first_seen_date").isNull().alias("undated"),
        "first_seen_date",
        F.col("chained_list").alias("start_list"),
    )
    start = lists.select(*keys, members.alias("members"), origin.alias("origin"))
    # Equality with a null trait is never true, so such lists only ever stay.
    complete = F.lit(True)
    for key in keys:
        complete = complete & F.col(key).isNotNull()
    alone = start.filter(~complete).groupBy(*keys, "members").agg(F.min("origin").alias("origin"))
    listed = start.filter(complete).filter(F.size("members") > 0)
    listed = cut_lineage(listed.withColumn("_list", F.md5(F.to_json(F.struct(*listed.columns)))).dropDuplicates(["_list"]))
    places = F.transform("members", lambda v: F.md5(F.to_json(F.struct(*keys, v.alias("value")))))
    small = cut_lineage(small_components(listed.withColumn("_places", places), "_list", "_places", rounds + 1))
    whole = (
        listed.join(small, "_list")
        .groupBy(*keys, "component")
        .agg(F.array_sort(F.array_distinct(F.flatten(F.collect_list("members")))).alias("members"), F.min("origin").alias("origin"))
        .select(*keys, "members", "origin")
    )
    start = listed.join(small.select("_list"), "_list", "left_anti").drop("_list")
    if start.isEmpty():
        walked = whole.limit(0)
    else:
        walked = _walk_sets(start, keys, rounds)
    return walked.unionByName(whole).unionByName(alone).select(
        *keys,
        "members",
        F.get("origin.start_list", F.lit(0)).alias("first_value"),
        F.col("origin.first_seen_date").alias("first_seen_date"),
    )


def _walk_sets(start: DataFrame, keys: Sequence[str], rounds: int) -> DataFrame:
    """(keys, members, origin) of all sets that walks over the lists of ``start`` have gathered in the end."""
    state = start.groupBy(*keys, "members").agg(F.min("origin").alias("origin"))

    # Equal sets are one candidate with a weight.
    sets = start.groupBy(*keys, F.col("members").alias("_other")).agg(F.count(F.lit(1)).alias("_weight"))
    by_value = cut_lineage(sets.withColumn("_value", F.explode("_other")))

    for step in range(rounds):
        shared = F.array_intersect("members", "_other")
        pairs = (
            state.withColumn("_value", F.explode("members"))
            .join(by_value, [*keys, "_value"])
            # Sets that share several values meet once per value; keep the first meeting.
            .filter(F.col("_value") == F.get(shared, F.lit(0)))
            .withColumn("_inside", F.size(shared) == F.size("_other"))
        )
        stay = F.struct(
            F.col("members").alias("members"),
            F.lit(None).cast(state.schema["origin"].dataType).alias("moved"),
            F.col("origin").alias("own"),
            F.when(F.col("_inside"), F.col("_weight")).otherwise(0).alias("inside"),
            F.when(F.col("_inside"), 0).otherwise(1).alias("outside"),
        )
        move = F.struct(
            F.array_sort(F.array_union("members", "_other")).alias("members"),
            F.col("origin").alias("moved"),
            F.lit(None).cast(state.schema["origin"].dataType).alias("own"),
            F.lit(0).cast("bigint").alias("inside"),
            F.lit(0).alias("outside"),
        )
        steps = F.when(F.col("_inside"), F.array(stay)).otherwise(F.array(stay, move))
        stays = (F.col("_inside_n") > step + 1) | (F.col("_outside_n") == 0)
        state = (
            pairs.select(*keys, F.explode(steps).alias("_step"))
            .groupBy(*keys, F.col("_step.members").alias("members"))
            .agg(
                F.min("_step.moved").alias("_moved"),
                F.min("_step.own").alias("_own"),
                F.sum("_step.inside").alias("_inside_n"),
                F.sum("_step.outside").alias("_outside_n"),
            )
            .withColumn("origin", F.least("_moved", F.when(stays, F.col("_own"))))
            .filter(F.col("origin").isNotNull())
            .select(*keys, "members", "origin")
        )

    return state


def canonical_value_map(
    df: DataFrame, merged: DataFrame, group: str, value: str, entity: str, traits: Sequence[str],
    name: str | None = None,
) -> DataFrame:
    """Map every (group, value, traits) to the first value of the chain holding it.

    A value in no chain maps to itself. A value in several chains gives a row per
    chain.
    """
    name = name or f"rpt_{value}"
    per_entity = df.groupBy(entity, group, value).agg(*[F.min(t).alias(t) for t in traits])
    listed = per_entity.select(group, value, *traits).distinct()
    chains = merged.select(group, *traits, F.explode("members").alias(value), "first_value")
    return left_join(listed, chains, [group, *traits, value], [group, value]).select(
        group, value, *traits, F.coalesce("first_value", value).alias(name)
    )


def apply_canonical_value(
    df: DataFrame, mapping: DataFrame, group: str, value: str, traits: Sequence[str], name: str | None = None
) -> DataFrame:
    """Overwrite ``value`` with its canonical name; null where the map has no row."""
    name = name or f"rpt_{value}"
    columns = [F.col(name).alias(value) if c == value else F.col(c) for c in df.columns]
    return left_join(df, mapping, [group, value, *traits], df.columns).select(*columns)


def canonicalise(
    df: DataFrame, entity: str, group: str, value: str, date: str, traits: Sequence[str]
) -> tuple[DataFrame, DataFrame]:
    """The whole chain: (mapping, rows with the canonical value)."""
    lists = value_lists(df, entity, group, value, date, traits)
    chained = cut_lineage(chain_lists_sequential(lists, group, traits))
    merged = merge_lists_transitive(chained, group, traits)
    mapping = canonical_value_map(df, merged, group, value, entity, traits)
    return mapping, apply_canonical_value(df, mapping, group, value, traits)
