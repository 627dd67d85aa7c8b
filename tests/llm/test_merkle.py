"""Manifests and proofs against trees built in plain Python."""

import hashlib
import random
import sys
import zlib
from pathlib import Path

import pytest
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))

from dealerlake.llm import merkle  # noqa: E402

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf(row, add=0):
    values = [row[0], row[3], row[2], None if row[4] is None else row[4] + add, row[1]]
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def climb(nodes):
    """Each node's siblings, and the last node."""
    ways, owners = [[] for _ in nodes], [[k] for k in range(len(nodes))]
    while len(nodes) > 1:
        for i, held in enumerate(owners):
            other = nodes[i ^ 1] if (i ^ 1) < len(nodes) else None
            for k in held:
                ways[k].append((other, (i ^ 1) < i))
        nodes = [sha("".join(nodes[i : i + 2])) for i in range(0, len(nodes), 2)]
        owners = [sum(owners[i : i + 2], []) for i in range(0, len(owners), 2)]
    return ways, nodes[0]


def brute(rows):
    langs = sorted({r[2] for r in rows}, key=lambda v: (v is not None, (v or "").encode()))
    parts, roots = [], []
    for lang in langs:
        mine = sorted((r for r in rows if r[2] == lang), key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
        ways, root = climb([leaf(r) for r in mine])
        parts.append((mine, ways, root))
        roots.append(root)
    above, top = climb(roots)
    out = []
    for (mine, ways, root), over in zip(parts, above, strict=True):
        for r, way in zip(mine, ways, strict=True):
            way = way + over
            add = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 7 == 0
            h = leaf(r, int(add))
            for other, left in way:
                h = sha(h if other is None else other + h if left else h + other)
            out.append((r[0], leaf(r), root, top, sha("".join(o for o, _ in way if o)), h, h == top))
    return sorted(out, key=repr)


def result(frame):
    names = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    return sorted((tuple(r) for r in frame.select(*names).collect()), key=repr)


def some_rows(sizes):
    rows = []
    for k, (lang, size) in enumerate(sizes.items()):
        rows += [(1000 * k + i, f"text {i} é", lang, None if i % 5 else f"s{i}", None if i % 11 == 3 else i) for i in range(size)]
    return rows


@pytest.mark.parametrize("step", [1, 2, 3, 8])
def test_same_as_plain_trees_at_any_distance_of_stored_levels(spark, step):
    rows = some_rows({"en": 37, "de": 1, None: 9, "": 2, "fr": 16, "日": 5})
    frame = spark.createDataFrame(rows, DOCS).repartition(5)
    assert result(merkle.report(frame, step)) == brute(rows)


def test_odd_rows(spark):
    rows = [(None, None, None, None, None), (None, "x", None, "", 0), (7, "", "a", "s", -1), (7, "", "a", "s", -1), (7, "y" * 70_000, "a", None, 2**62)]
    rows += [(-3, "\x00\n", "A", "é", None)] * 3
    extra = {"n": F.lit(1), "tree": F.lit("t"), "node": F.lit(2), "block": F.lit(3), "leaf": F.lit(4), "_at": F.lit(5), "siblings": F.lit(6)}
    found = merkle.report(spark.createDataFrame(rows, DOCS).withColumns(extra), 2)
    assert result(found) == brute(rows)
    assert [r.verified for r in found.filter("doc_id IS NULL").collect()] == [True, True]


def test_empty_and_single(spark):
    assert merkle.report(spark.createDataFrame([], DOCS)).collect() == []
    one = [(5, "t", "en", None, 3)]
    assert result(merkle.report(spark.createDataFrame(one, DOCS))) == brute(one)


def test_changed_rows_alone_fail(spark):
    found = merkle.report(spark.createDataFrame(some_rows({"en": 300}), DOCS)).collect()
    bad = {r.doc_id for r in found if not r.verified}
    assert bad == {i for i in range(300) if zlib.crc32(str(i).encode()) % 7 == 0 and i % 11 != 3}


def test_one_id_filling_the_table_is_split_and_whole(spark):
    rows = [(1, "same", "en", None, 4)] * 700 + [(i, "x", "en", None, 1) for i in range(2, 50)]
    assert result(merkle.report(spark.createDataFrame(rows, DOCS).repartition(8), 3)) == brute(rows)


def test_proofs_of_wanted_leaves_only(spark):
    rows = some_rows({"en": 600, "de": 3})
    frame = spark.createDataFrame(rows, DOCS).select("doc_id", "lang", merkle.leaf_digest(F.col("doc_id"), F.col("text")).alias("leaf"))
    manifest = merkle.build(frame, "lang", "doc_id", "leaf", 4)
    every = {r.doc_id: (r.siblings, r.sides) for r in merkle.proofs(manifest).collect()}
    some = {r.doc_id: (r.siblings, r.sides) for r in merkle.proofs(manifest, F.col("doc_id").isin(3, 599, 1001)).collect()}
    assert some == {k: every[k] for k in (3, 599, 1001)}
    roots = merkle.with_folded(merkle.proofs(manifest), "node").select("folded_root").distinct().collect()
    assert [r.folded_root for r in roots] == [manifest.root]


def test_only_every_few_levels_are_stored(spark):
    frame = spark.range(1000).select(F.col("id").alias("doc_id"), F.lit("en").alias("lang"), merkle.leaf_digest(F.col("id")).alias("leaf"))
    manifest = merkle.build(frame, "lang", "doc_id", "leaf", 4)
    assert [n.count() for n in manifest.forest.levels] == [1000, 63, 4, 1]


def test_proofs_are_folded_by_spark_itself_like_a_plain_loop(spark):
    draw = random.Random(6)
    rows = []
    for k in range(40):
        sides = "".join(draw.choices("LR-", k=k % 19))
        found = "".join(merkle.digest(f"{k} {i}") for i in range(len(sides.replace("-", ""))))
        rows.append((k, bytes.fromhex(merkle.digest(str(k))), found, sides))
    out = merkle.with_folded(spark.createDataFrame(rows, "k long, node binary, siblings string, sides string"), "node")
    assert {r.k: r.folded_root for r in out.collect()} == {k: merkle.folded(node.hex(), found, sides) for k, node, found, sides in rows}
    assert "Arrow" not in out._jdf.queryExecution().executedPlan().toString()
