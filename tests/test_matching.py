"""Name matching without an edit cap, against all pairs in plain Python."""

from __future__ import annotations

import random

from meterlake.functions.names import normalise
from meterlake.operators import matching
from meterlake.operators.clusters import components


def edits(a: str, b: str) -> int:
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def score(a: str, b: str) -> float:
    n = max(len(a), len(b))
    return ((n - edits(a, b)) * 20000 + n) // (2 * n) / 100


def test_all_pairs_from_80_percent_on_are_found(spark):
    rng = random.Random(5)
    words = ["metropolitan", "yellow", "cab", "services", "north", "taxi", "city", "rides", "ab", "x"]
    names = {" ".join(rng.sample(words, rng.randrange(1, 5))) for _ in range(25)}
    for name in sorted(names):
        for n in (1, 2, 3, 5, 7):
            letters = list(name)
            for _ in range(n):
                at = rng.randrange(len(letters) + 1)
                kind = rng.randrange(3)
                if kind == 0:
                    letters.insert(at, rng.choice("qzjk"))
                elif letters and at < len(letters):
                    letters[at : at + 1] = [] if kind == 1 else [rng.choice("qzjk")]
            names.add("".join(letters).strip() or "y")
    names |= {"東京無線タクシー", "東京無線タクシ", "ямщик такси", "ямщик таксо"}
    names = sorted(names)
    df = spark.createDataFrame([(n,) for n in names], "norm string")
    got = {(r["norm"], r["m_norm"]): r["score"] for r in matching.close_names(df, df, 80.0).collect()}
    want = {(a, b): score(a, b) for a in names for b in names if score(a, b) >= 80}
    assert got == want
    assert max(edits(a, b) for a, b in want) >= 6


def test_best_master_beyond_two_edits_and_other_scripts(spark):
    masters = spark.createDataFrame(
        [(1, "Metropolitan Yellow Cab Services North"), (2, "São Paulo Táxi"), (3, "東京無線"), (4, "???")], "id bigint, name string"
    )
    asked = spark.createDataFrame(
        [(10, "Metropoltan Yelow Cab Servics North"), (11, "Sao Paulo Taxi"), (12, "東京無線"), (13, "???"), (14, "unrelated"), (15, None), (16, "")],
        "pid bigint, asked string",
    )
    got = {r["pid"]: (r["golden_id"], r["match_confidence"]) for r in matching.match(asked, masters, "asked", "id", "name").collect()}
    assert got[10][0] == 1 and got[10][1] > 90
    assert got[11] == (2, 100.0) and got[12] == (3, 100.0) and got[13] == (4, 100.0)
    assert got[14] == got[15] == got[16] == (None, 0.0)


def test_normalising_folds_accents(spark):
    df = spark.createDataFrame([("Zoë's  Cab, Inc.",), ("été",), ("ÀÉÎÕÜ Ltd",)], "n string")
    assert [r[0] for r in df.select(normalise(df["n"])).collect()] == ["zoe s cab", "ete", "aeiou"]


def linked(names: dict[int, str]) -> dict[int, int]:
    """Smallest id reachable through names at least 80 percent close."""
    cluster = {i: i for i in names}
    changed = True
    while changed:
        changed = False
        for a in names:
            for b in names:
                low = min(cluster[a], cluster[b])
                if score(names[a], names[b]) >= 80 and {cluster[a], cluster[b]} != {low}:
                    cluster[a] = cluster[b] = low
                    changed = True
    return cluster


def test_clusters_hold_every_link(spark):
    rng = random.Random(9)
    words = ["metropolitan", "yellow", "cab", "services", "north", "taxi", "green", "ab", "x"]
    names = [" ".join(rng.sample(words, rng.randrange(1, 4))) for _ in range(12)]
    for name in list(names):
        for n in (1, 2, 4):
            letters = list(name)
            for _ in range(n):
                letters.insert(rng.randrange(len(letters) + 1), rng.choice("qzjk"))
            names.append("".join(letters).strip())
    names += [f"yellow cab {k:05d}" for k in range(40)] + ["yellow cab 00003", "abcde", "abcdx", "abcyx"]
    rows = dict(enumerate(names, 100))
    want = linked({i: " ".join(n.split()) for i, n in rows.items()})
    sizes = {c: list(want.values()).count(c) for c in want.values()}
    masters = spark.createDataFrame([*rows.items(), (1, None), (2, ""), (3, "nothing like the others at all")], "id bigint, name string")
    got = {r["record_id"]: r for r in matching.dedup_members(masters, "id", "name").collect()}
    assert {i: r["cluster_id"] for i, r in got.items()} == {i: c for i, c in want.items() if sizes[c] > 1}
    assert all(r["match_score"] == score(rows[i], rows[r["cluster_id"]]) for i, r in got.items())
    queue = matching.dedup_queue(masters, "id", "name").collect()
    assert len(queue) == sum(n - 1 for n in sizes.values())
    assert {r["confidence_level"] for r in queue} >= {"HIGH", "MEDIUM", "LOW"}


def test_queue_holds_every_close_pair(spark):
    rng = random.Random(4)
    words = ["metropolitan", "yellow", "cab", "services", "north", "taxi", "ab", "x"]
    names = [" ".join(rng.sample(words, rng.randrange(1, 4))) for _ in range(12)]
    for name in list(names):
        for n in (1, 2, 4):
            letters = list(name)
            for _ in range(n):
                letters.insert(rng.randrange(len(letters) + 1), rng.choice("qzjk"))
            names.append("".join(letters).strip())
    names += [f"yellow cab {k:05d}" for k in range(0, 60, 7)] + ["yellow cab 00007", "abcde", "abcdx", "abcyx"]
    rows = {i: " ".join(n.split()) for i, n in enumerate(names, 100)}
    first = {n: min(i for i, m in rows.items() if m == n) for n in rows.values()}
    want = {(first[n], i): 100.0 for i, n in rows.items() if i != first[n]}
    want |= {(i, j): score(a, b) for a, i in first.items() for b, j in first.items() if i < j and score(a, b) >= 80}
    masters = spark.createDataFrame([*rows.items(), (1, None), (2, ""), (3, None)], "id bigint, name string")
    got = matching.dedup_pairs(masters, "id", "name").collect()
    assert len(got) == len(want) and {(r["id_1"], r["id_2"]): r["match_score"] for r in got} == want
    # a pair that only the head of its cluster would stand for
    assert len(want) > matching.dedup_queue(masters, "id", "name").count()


def test_serial_names_take_no_pairs(spark):
    """A long series of names that all resemble each other: the work follows the names, not their pairs."""
    names = spark.range(1200).selectExpr("id + 1 AS id", "format_string('Metered cab company %06d', id) AS name")
    members = matching.dedup_members(names, "id", "name")
    assert members.count() == 1200 and members.select("cluster_id").distinct().count() == 1
    assert matching.dedup_queue(names, "id", "name").count() == 1199
    asked = spark.range(300).selectExpr("id AS pid", "format_string('Metered cabb company %06d', id * 4) AS asked")
    near = matching.within_one_edit(
        asked.selectExpr("lower(asked) AS norm"), names.selectExpr("lower(name) AS norm")
    )
    assert near.count() == 300
    got = matching.match(asked, names, "asked", "id", "name").collect()
    assert all(r["golden_id"] == 4 * r["pid"] + 1 and r["match_confidence"] > 95 for r in got)


def test_components_in_rounds_equal_those_on_the_driver(spark):
    rng = random.Random(3)
    links = [(rng.randrange(400), rng.randrange(400)) for _ in range(260)] + [(1000 + k, 1001 + k) for k in range(90)]
    links += [(5000, k) for k in range(5001, 5060)] + [(7, 7), (None, 3), (4, None), (2, 1), (1, 2)]
    df = spark.createDataFrame(links, "a bigint, b bigint")
    one = {tuple(r) for r in components(df, "a", "b").collect()}
    two = {tuple(r) for r in components(df, "a", "b", small=0).collect()}
    assert one == two and (1090, 1000) in one and (5059, 5000) in one
    assert components(df.limit(0), "a", "b").count() == 0
