"""Keys of the n-gram Jaccard join are sent packed, and those of one row stay behind."""

from __future__ import annotations

import time
from collections import Counter

import numpy as np

from dealerlake.llm import common, jaccard_join
from dealerlake.llm.shingles import shingle_sets


def _drawn(count, parts, ids):
    draw = np.random.default_rng(5)
    key = draw.integers(0, 2**64, count, dtype=np.uint64)
    key[draw.integers(0, count, count // 5)] = key[draw.integers(0, count, count // 5)]
    rep = np.sort(draw.integers(*ids, count))
    return key, rep, draw.integers(0, 120, count).astype(np.int32), parts


def _short(key, parts):
    """Part, then the bytes that are sent."""
    return ((key >> np.uint64(40)) % np.uint64(parts) << np.uint64(40)) + (key & np.uint64(2**40 - 1))


def test_repeated_keys_come_back_with_their_holders():
    for ids in ((-(2**63), 2**63 - 1), (0, 3000), (7, 8)):
        runs = [_drawn(4000, 5, ids)[:3] for _ in range(2)]
        blocks = [list(jaccard_join.packed_keys(*run, 5)) for run in runs]
        found = []
        for part in range(5):
            own = [b for run in blocks for b in run if b[0] == part]
            found += [r for columns in jaccard_join.repeated_keys(own) for r in zip(*(c.tolist() for c in columns), strict=True)]
        rows = [r for key, rep, group in runs for r in zip(_short(key, 5).tolist(), rep.tolist(), group.tolist(), strict=True)]
        times = Counter(key for key, _, _ in rows)
        expected = [r for r in rows if times[r[0]] > 1]
        assert sorted(found) == sorted(expected) and 0 < len(expected)


def test_packed_keys_are_small():
    """A row of key, document and size group took 14 to 16 bytes of a shuffle file."""
    key, rep, group, parts = _drawn(200_000, 400, (10**6, 10**6 + 2000))
    group = np.sort(group % 20)
    blocks = list(jaccard_join.packed_keys(key, rep, group, parts))
    assert sum(n for _, n, _ in blocks) == len(key) and sum(len(packed) for _, _, packed in blocks) < 8 * len(key)


def test_keys_of_one_row_are_not_among_them(spark, monkeypatch):
    draw, similarity = np.random.default_rng(9), jaccard_join.Similarity()
    rows = []
    for i in range(60):
        words = draw.integers(0, 10**6, 120)
        for copy in range(1 + (i % 3 == 0)):
            words[draw.integers(0, 120, copy)] = 1
            rows.append((1000 * copy + i, " ".join(f"w{w}" for w in words)))
    rows += [(5000, None), (5001, ""), (5002, "a b")]
    monkeypatch.setattr(jaccard_join, "PACKED", 3000)  # so that a task packs several times
    found = jaccard_join._keys(spark.createDataFrame(rows, "doc_id long, text string"), similarity).collect()
    parts = jaccard_join.KEY_PARTITIONS * int(spark.conf.get("spark.sql.shuffle.partitions"))
    keys, plain = jaccard_join.BlockKeys(similarity), []
    for doc, text in rows:
        (own,) = shingle_sets([(text or "").encode()], similarity.words)
        if len(own):
            plain += [(k, doc, g) for k, g in zip(*(x.tolist() for x in keys.of(own)), strict=True)]
    plain = [(int(k), doc, g) for k, (_, doc, g) in zip(_short(np.array([r[0] for r in plain], np.int64).view(np.uint64), parts), plain, strict=True)]
    times = Counter(k for k, _, _ in plain)
    expected = [r for r in plain if times[r[0]] > 1]
    assert sorted(map(tuple, found)) == sorted(expected) and 0 < len(expected) < len(plain)


def test_shuffles_of_a_stored_step_go_when_it_is_written(spark):
    disk = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    files = lambda: {f for f in disk.getAllFiles().mkString("\n").split("\n") if "/shuffle_" in f}
    before = files()
    written = common.stored(spark.range(10_000).repartition(7, "id"), "shuffled")
    until = time.time() + 20
    while (left := files() - before) and time.time() < until:
        time.sleep(0.2)
    assert not left and spark.conf.get(common.SHUFFLES_GO, None) in (None, "false")
    assert written.count() == 10_000


def test_rounds_of_tile_pairs_find_all_links(spark, monkeypatch):
    draw, rows = np.random.default_rng(3), []
    for i in range(6):
        base = draw.integers(0, 10**6, 80)
        for copy in range(12):
            words = base.copy()
            words[draw.integers(0, 80, copy % 3)] = draw.integers(0, 10**6)
            rows.append((100 * i + copy, " ".join(f"w{w}" for w in words)))
    frame, similarity = spark.createDataFrame(rows, "doc_id long, text string"), jaccard_join.Similarity(tile=4)
    whole = sorted(map(tuple, jaccard_join.groups(frame, similarity).collect()))
    labels = []
    real = common.stored
    monkeypatch.setattr(jaccard_join, "stored", lambda step, label: labels.append(label) or real(step, label))
    monkeypatch.setattr(jaccard_join, "ROUND", 2)
    monkeypatch.setattr(jaccard_join, "SENT", 1)
    assert sorted(map(tuple, jaccard_join.groups(frame, similarity).collect())) == whole
    assert labels.count("links") > 1 and len({c for _, _, c in whole}) < len(rows)
