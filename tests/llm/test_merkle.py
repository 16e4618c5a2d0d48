"""Merkle manifests against a plain tree built in Python."""

from __future__ import annotations

import hashlib
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from starwright.llm import merkle

SCHEMA = "doc_id long, source string, lang string, n_chars int, text string"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def digest(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf(row):
    return digest("".join(
        "-" if v is None else f"{len(str(v).encode())}:{v}" for v in row
    ))


def tree(nodes):
    """The root, and per node what stands left and right of it on every level."""
    paths, owners = [[] for _ in nodes], [[i] for i in range(len(nodes))]
    while len(nodes) > 1:
        above, owned = [], []
        for at in range(0, len(nodes), 8):
            run = nodes[at : at + 8]
            for k in range(len(run)):
                for i in owners[at + k]:
                    paths[i].append(("".join(run[:k]), "".join(run[k + 1 :])))
            above.append(digest("".join(run)))
            owned.append([i for group in owners[at : at + 8] for i in group])
        nodes, owners = above, owned
    return nodes[0], paths


def is_tampered(doc_id):
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % 3 == 0


def plain(rows):
    groups = {}
    for row in rows:
        groups.setdefault(row[2], []).append(row)
    names = sorted(groups, key=lambda name: (name is not None, (name or "").encode()))
    trees = []
    for name in names:
        groups[name].sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
        trees.append(tree([leaf(row) for row in groups[name]]))
    root, crown = tree([subroot for subroot, _ in trees])
    found = Counter()
    for name, (subroot, paths), top in zip(names, trees, crown):
        for row, path in zip(groups[name], paths):
            path = path + top
            node = leaf(row)
            if is_tampered(row[0]) and row[4] is not None:
                node = leaf((*row[:4], row[4].translate(str.maketrans(UPPER, LOWER))))
            for left, right in path:
                node = digest(left + node + right)
            siblings = digest("".join(left + right for left, right in path))
            found[row[0], leaf(row), subroot, root, siblings, node, node == root] += 1
    return found


def proved(df):
    tampered = F.crc32(F.col("doc_id").cast("string")) % 3 == 0
    claimed = F.when(tampered, F.translate("text", UPPER, LOWER)).otherwise(F.col("text"))
    return merkle.verify(merkle.build(df, claims={"text": claimed}).proofs()).select(
        "doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"
    )


@pytest.mark.parametrize("size", [1, 2, 8, 9, 64, 65, 513])
def test_trees_of_every_depth(spark, size):
    rows = [(i, "s", "en", 3, f"Text {i}") for i in range(size)]
    assert Counter(map(tuple, proved(spark.createDataFrame(rows, SCHEMA)).collect())) == plain(rows)


def test_odd_rows_and_a_hot_group(spark):
    rows = [
        (1, "s", "a", 3, "Abc"), (None,) * 5, (None,) * 5, (2, "", "b", 0, ""),
        (2, "", "b", 0, ""), (2, "", "b", 0, "Other"), (3, "x", "é", 1, "É"),
        (4, "x", "", 1, "9" * 300_000), (-5, None, "a", None, None),
        *((i, "s", "hot", 1, f"T{i}") for i in range(700)),
        *((None, "s", "hot", 1, "the same"),) * 30,
        *((9000 + i, "s", f"lang{i}", 1, "x") for i in range(12)),
    ]
    df = spark.createDataFrame(rows, SCHEMA)
    found = Counter(map(tuple, proved(df).collect()))
    assert found == plain(rows)
    changed = {row[0] for row in found if not row[-1]}
    assert changed == {
        r[0] for r in rows
        if is_tampered(r[0]) and r[4] is not None and r[4] != r[4].translate(
            str.maketrans(UPPER, LOWER)
        )
    }


def test_columns_that_clash_are_left_out(spark):
    df = spark.createDataFrame([(1, "s", "en", 1, "A")], SCHEMA)
    for name in ("leaf", "tree", "place", "size", "node", "path", "row", "root", "entries"):
        df = df.withColumn(name, F.lit("own"))
    assert proved(df).count() == 1


def test_an_empty_table_has_no_root(spark):
    manifest = merkle.build(spark.createDataFrame([], SCHEMA))
    assert manifest.root is None
    assert merkle.verify(manifest.proofs()).count() == 0


def test_a_lost_row_changes_the_root(spark):
    rows = [(i, "s", "en", 1, str(i)) for i in range(20)]
    whole = merkle.build(spark.createDataFrame(rows, SCHEMA)).root
    assert merkle.build(spark.createDataFrame(rows[:-1], SCHEMA)).root != whole
    assert merkle.build(spark.createDataFrame(rows[::-1], SCHEMA)).root == whole


def test_places_need_no_window_over_a_group(spark):
    """Windows run over one row per partition and group, never over rows."""
    rows = [(i, "s", "en", 1, str(i)) for i in range(100)]
    nodes = merkle.build(spark.createDataFrame(rows, SCHEMA)).groups.tiers[0]
    assert nodes.agg(F.max(F.size("entries"))).first()[0] <= merkle.BLOCK
    plan = nodes._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan
