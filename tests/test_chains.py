"""Chaining against the worked example and a brute-force reading of the rules."""

import random

import pytest
from pyspark.sql import functions as F

from tests.helpers import bag, day
from tidemark.operators import chains
from tidemark.operators.components import small_components

TRAITS = ["bed", "bath"]
SITE = {"group": "community_id", "traits": TRAITS}
SITES = "report_date date, homesite_id string, community_id string, floor_plan string, bed int, bath int"


def sites(spark, data):
    return spark.createDataFrame([(day(d), h, c, p, 3, 2) for d, h, c, p in data], SITES)


def test_worked_example(spark):
    df = sites(
        spark,
        [
            ("2024-01-02", "5", "ABC", "1"), ("2024-01-03", "5", "ABC", "2"), ("2024-01-04", "5", "ABC", "3"),
            ("2024-01-03", "6", "ABC", "2"), ("2024-01-04", "6", "ABC", "3"), ("2024-01-04", "6", "ABC", "4"),
        ],
    )
    lists = chains.value_lists(df, "homesite_id", "community_id", "floor_plan", "report_date", TRAITS)
    assert bag(lists, "value_list") == [(["1", "2", "3"],), (["2", "3", "4"],)]
    mapping, named = chains.canonicalise(df, "homesite_id", "community_id", "floor_plan", "report_date", TRAITS)
    assert {r.floor_plan for r in named.collect()} == {"1"}
    assert named.count() == 6
    assert bag(mapping, "floor_plan", "rpt_floor_plan") == [(p, "1") for p in "1234"]


def test_sequential_step_follows_later_lists(spark):
    df = sites(
        spark,
        [
            ("2024-01-01", "a", "C", "1"), ("2024-01-02", "a", "C", "2"),
            ("2024-01-02", "b", "C", "2"), ("2024-01-05", "b", "C", "3"),
            ("2024-01-06", "c", "C", "9"),
        ],
    )
    lists = chains.value_lists(df, "homesite_id", "community_id", "floor_plan", "report_date", TRAITS)
    found = chains.chain_lists_sequential(lists, **SITE)
    assert bag(found, "value_list", "chained_list", "match_cnt", "match_score") == [
        (["1", "2"], ["1", "2", "3"], 1, 1),
        (["2", "3"], ["2", "3"], 0, None),
    ]


def brute_sequential(lists, rounds=5):
    states = [(v, v, 0, f, l) for v, f, l in lists]
    for _ in range(rounds):
        following = []
        for v, r, n, f, seen in states:
            hits = []
            for w, _, last in lists:
                common = [x for x in v if x in w]
                if common and common == w[: len(common)] and v != w and len(w) > 1 and seen < last:
                    hits.append((w, last))
            if not hits:
                following.append((v, r, n, f, seen))
            for w, last in hits:
                following.append((v, r + [x for x in w if x not in r], n + 1, f, last))
        states = following
    best = {}
    for v, r, n, f, seen in states:
        if n > 0 or len(v) > 1:
            rank = (f, v, n, seen)
            if tuple(r) not in best or rank < best[tuple(r)]:
                best[tuple(r)] = rank
    return {r: (rank[1], rank[2], rank[0]) for r, rank in best.items()}


def brute_transitive(chained, rounds=5):
    """``chained``: (list, first date). Walks with visited lists, exactly as stated."""
    states = {(i, frozenset([i])): set(r) for i, (r, _) in enumerate(chained)}
    for _ in range(rounds):
        following = {}
        for (start, visited), members in states.items():
            hits = [j for j, (r, _) in enumerate(chained) if j not in visited and members & set(r)]
            if not hits:
                following[(start, visited)] = members
            for j in hits:
                following[(start, visited | {j})] = members | set(chained[j][0])
        states = following
    best = {}
    for (start, _), members in states.items():
        r, f = chained[start]
        key, rank = tuple(sorted(members)), (f, list(r))
        if key not in best or rank < best[key]:
            best[key] = rank
    return {m: (rank[1][0], rank[0]) for m, rank in best.items()}


@pytest.mark.parametrize("seed", range(4))
def test_against_brute_force(spark, seed):
    random.seed(seed)
    base = day("2024-01-01").toordinal()
    data, by_community = [], {}
    for community in range(12):
        values = [str(i) for i in range(random.choice([4, 6, 9, 14]))]
        seen = set()
        lists = by_community.setdefault(str(community), [])
        for _ in range(random.choice([3, 5, 7])):
            begin = random.randrange(len(values))
            chosen = values[begin : begin + random.choice([1, 2, 2, 3])]
            if random.random() < 0.3:
                chosen = random.sample(values, min(len(values), random.choice([2, 3])))
            if tuple(chosen) in seen:
                continue
            seen.add(tuple(chosen))
            first = base + random.randrange(6)
            last = first + random.randrange(6)
            first, last = day("2024-01-01").fromordinal(first), day("2024-01-01").fromordinal(last)
            lists.append((chosen, first, last))
            data.append((str(community), 3, 2, chosen, first, last))
    df = spark.createDataFrame(
        data, "community_id string, bed int, bath int, value_list array<string>, first_seen_date date, last_seen_date date"
    )
    chained = chains.cut_lineage(chains.chain_lists_sequential(df, **SITE))
    found = {
        (r.community_id, tuple(r.chained_list)): (r.value_list, r.match_cnt, r.first_seen_date)
        for r in chained.collect()
    }
    expected = {
        (c, r): v for c, lists in by_community.items() for r, v in brute_sequential(lists).items()
    }
    assert found == expected

    merged = chains.merge_lists_transitive(chained, **SITE)
    found = {(r.community_id, tuple(r.members)): (r.first_value, r.first_seen_date) for r in merged.collect()}
    wanted = {}
    for community in by_community:
        own = [(list(r), v[2]) for (c, r), v in expected.items() if c == community]
        wanted |= {(community, m): v for m, v in brute_transitive(own).items()}
    assert found == wanted


def test_lists_with_a_null_trait_stay_alone(spark):
    df = spark.createDataFrame(
        [("c", None, 2, ["1", "2"], day("2024-01-01"), day("2024-01-02")),
         ("c", None, 2, ["2", "3"], day("2024-01-01"), day("2024-01-05"))],
        "community_id string, bed int, bath int, value_list array<string>, first_seen_date date, last_seen_date date",
    )
    chained = chains.chain_lists_sequential(df, **SITE)
    assert bag(chained, "chained_list") == [(["1", "2"],), (["2", "3"],)]
    merged = chains.merge_lists_transitive(chains.cut_lineage(chained), **SITE)
    assert bag(merged, "members") == [(["1", "2"],), (["2", "3"],)]


def test_unmapped_rows_become_null(spark):
    df = sites(spark, [("2024-01-01", "a", "C", "1")]).unionByName(
        spark.createDataFrame([(day("2024-01-01"), "b", "D", "1", None, 2)], SITES)
    )
    _, named = chains.canonicalise(df, "homesite_id", "community_id", "floor_plan", "report_date", TRAITS)
    assert bag(named, "homesite_id", "floor_plan") == [("a", "1"), ("b", None)]


LISTS = "community_id string, bed int, bath int, value_list array<string>, first_seen_date date, last_seen_date date"


def test_two_thousand_lists_in_a_group(spark):
    """One list that 2,000 others go on from, on two days; what they add is told apart, not who adds it."""
    first, days = day("2024-01-01"), (day("2024-01-02"), day("2024-01-03"))
    data = [("c", 3, 2, [f"v{i:02d}" for i in range(40)], first, first)]
    data += [("c", 3, 2, [f"v{i:02d}", f"n{k:02d}"], first, days[k >= 25]) for i in range(40) for k in range(50)]
    df = spark.createDataFrame(data, LISTS)
    base = df.withColumn("_base", F.to_json("value_list"))
    steps = chains._steps(base, ["community_id", *TRAITS]).groupBy("_base").count()
    assert steps.agg(F.max("count")).first()[0] == 50
    found = chains.cut_lineage(chains.chain_lists_sequential(df, **SITE))
    by_count = {r.match_cnt: r["count"] for r in found.groupBy("match_cnt").count().collect()}
    # From the long list one of each day, or one of the second; from those of the first day one of the second.
    assert by_count == {0: 40 * 25, 1: 25 + 40 * 25 * 25, 2: 25 * 25}
    assert found.select("chained_list").distinct().count() == sum(by_count.values())


def test_repeated_lists_with_other_dates(spark):
    data = [("c", 3, 2, ["1", "2"], day("2024-01-01"), day(d)) for d in ("2024-01-02", "2024-01-09")]
    data += [("c", None, 2, ["1", "2"], day("2024-01-01"), day("2024-01-02")), ("c", 2, None, ["1", "2"], day("2024-01-01"), day("2024-01-02"))]
    data += [("c", 3, 2, ["2", "3"], day("2024-01-01"), day("2024-01-05"))]
    found = chains.chain_lists_sequential(spark.createDataFrame(data, LISTS), **SITE)
    assert bag(found, "bed", "bath", "chained_list", "match_cnt") == bag(
        spark.createDataFrame(
            [(None, 2, ["1", "2"], 0), (2, None, ["1", "2"], 0), (3, 2, ["1", "2"], 0), (3, 2, ["1", "2", "3"], 1), (3, 2, ["2", "3"], 0)],
            "bed int, bath int, chained_list array<string>, match_cnt int",
        )
    )
    assert chains.chain_lists_sequential(spark.createDataFrame([], LISTS), **SITE).count() == 0


def test_no_rounds_or_one(spark):
    data = [("c", 3, 2, [str(k), str(k + 1)], day("2024-01-01"), day(f"2024-01-{k + 1:02d}")) for k in range(1, 6)]
    df = spark.createDataFrame(data, LISTS)
    longest = lambda n: chains.chain_lists_sequential(df, **SITE, rounds=n).agg(F.max("match_cnt")).first()[0]
    assert [longest(0), longest(1), longest(2)] == [0, 1, 1]  # lists go on from the base, not from what was added


def plain_sets(lists, rounds=5):
    """{set: earliest list} by walks over sets: a walk may step onto an unvisited list inside its set, or add one outside."""
    states = {}
    for r in lists:
        states[frozenset(r)] = min(states.get(frozenset(r), r), r)
    weights = {s: sum(frozenset(r) == s for r in lists) for s in states}
    for step in range(rounds):
        following = {}
        for s, first in states.items():
            met = [o for o in weights if o & s]
            inside = sum(weights[o] for o in met if o <= s)
            targets = {s | o for o in met if not o <= s} | ({s} if inside > step + 1 or all(o <= s for o in met) else set())
            for t in targets:
                following[t] = min(following.get(t, first), first)
        states = following
    return states


def chained(spark, groups):
    rows = [(g, 3, 2, list(r), day("2024-01-01")) for g, lists in groups.items() for r in lists]
    return spark.createDataFrame(rows, "community_id string, bed int, bath int, chained_list array<string>, first_seen_date date")


def test_two_thousand_lists_on_one_value(spark):
    draw = random.Random(8)
    hot = set()
    while len(hot) < 2000:
        hot.add(tuple(draw.sample(["x", *draw.sample("abcdefg", 4)], 5)))
    groups = {"hot": sorted(hot), "six": [(f"{k}", f"{k + 1}") for k in range(6)], "seven": [(f"{k}", f"{k + 1}") for k in range(7)]}
    df = chains.cut_lineage(chained(spark, groups))
    found = {}
    for r in chains.merge_lists_transitive(df, **SITE).collect():
        found.setdefault(r.community_id, {})[frozenset(r.members)] = r.first_value
    assert found == {g: {s: first[0] for s, first in plain_sets(lists).items()} for g, lists in groups.items()}
    assert len(found["six"]) == 1 and len(found["seven"]) > 1


@pytest.mark.parametrize("most", [1, 2, 4, 6])
def test_small_components(spark, most):
    draw = random.Random(most)
    sets = {}
    for k in range(120):
        begin = draw.randrange(260)
        sets[f"n{k:03d}"] = [f"v{begin + j}" for j in range(draw.choice([1, 1, 2, 3]))]
    sets |= {f"p{k:02d}": [f"w{k}", f"w{k + 1}"] for k in range(40)}  # a path
    sets |= {f"q{k:02d}": [f"hub{k // 7}", f"own{k}"] for k in range(21)}  # stars of seven
    names = sorted(sets)
    of = {n: n for n in names}
    changed = True
    while changed:
        changed = False
        for a in names:
            least = min(of[b] for b in names if set(sets[a]) & set(sets[b]))
            if least < of[a]:
                of[a], changed = least, True
    size = {c: sum(of[n] == c for n in names) for c in set(of.values())}
    df = spark.createDataFrame(list(sets.items()), "node string, found array<string>")
    rows_ = {(r.node, r.component, r["size"]) for r in small_components(df, "node", "found", most).collect()}
    assert rows_ == {(n, of[n], size[of[n]]) for n in names if size[of[n]] <= most}
