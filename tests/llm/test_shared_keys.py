"""The keys of the n-gram Jaccard join that several rows share, against plain counting."""

import random
from collections import defaultdict

import pytest

from dealerlake.llm import jaccard_join

pytest.importorskip("numpy")
KINDS = "key long, rep long, size_group int"


def test_shared_keys_are_sorted_once_in_more_partitions(spark):
    plan = jaccard_join._shared(spark.createDataFrame([(1, 2, 3)], KINDS), jaccard_join.Similarity())._jdf.queryExecution().sparkPlan().toString()
    parts = jaccard_join.KEY_PARTITIONS * int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert "Join" not in plan and "hashpartitioning(key" in plan and f", {parts})" in plan


def test_shared_keys_against_plain_counting(spark):
    draw, similarity = random.Random(7), jaccard_join.Similarity()
    rows = [(draw.randrange(400), draw.randrange(60), draw.choice([0, 3, 12, 20])) for _ in range(1500)]
    members, held = defaultdict(int), defaultdict(list)
    for key, _, _ in rows:
        members[key] += 1
    for key, rep, group in rows:
        if members[key] > 1:
            held[rep, group].append((-members[key], key))
    firsts = similarity.size_groups(10**13)
    expected = []
    for (rep, group), keys in held.items():
        spared = similarity.crowded(similarity.differ(firsts[group + 1]))
        expected += [(key, rep, group) for _, key in sorted(keys)[spared:]]
    found = jaccard_join._shared(spark.createDataFrame(rows, KINDS), similarity).collect()
    assert sorted(map(tuple, found)) == sorted(expected) and 0 < len(expected) < len(rows)


def test_visitors_of_a_size_group_do_not_meet(spark):
    similarity = jaccard_join.Similarity(tile=4)
    firsts = similarity.size_groups(10**13)
    group = 12
    first = firsts[group]
    rows = [(rep, 7, group, first + rep % 3 if rep < 10 else first - 1) for rep in range(30)]  # ten of the group, twenty visitors
    rows += [(rep, 8, group, first - 1) for rep in range(30, 36)] + [(40, 9, group, first), (41, 9, group, first - 1)]
    frame = spark.createDataFrame(rows, "rep long, cluster long, size_group int, n long")
    found = {(r.cluster, r.rep): (r.tile, r.others) for r in jaccard_join._tiles(frame, similarity).collect()}
    pairs = {(c, a, b) for c, a in found for d, b in found if c == d and a < b and found[c, a][0] < found[c, b][1] and found[c, b][0] < found[c, a][1]}
    met = {(7, a, b) for a in range(10) for b in range(a + 1, 30)}
    assert pairs == met | {(9, 40, 41)} and not any(c == 8 for c, _ in found)
