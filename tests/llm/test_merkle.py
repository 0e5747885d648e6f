import hashlib
import random

import pytest
from pyspark.sql import functions as F

from tickloom.llm import merkle

NAMES = ["doc_id", "source", "lang", "n_chars", "text"]


def digest(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def field(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def grown(leaves):
    """The root, and every leaf's siblings as (before, after) per level."""
    level, at = list(leaves), list(range(len(leaves)))
    paths = [[] for _ in leaves]
    while len(level) > 1:
        runs = [level[i : i + merkle.FAN] for i in range(0, len(level), merkle.FAN)]
        for path, i in zip(paths, at):
            run, slot = runs[i // merkle.FAN], i % merkle.FAN
            path.append(("".join(run[:slot]), "".join(run[slot + 1 :])))
        level, at = [digest(*run) for run in runs], [i // merkle.FAN for i in at]
    return (level[0] if level else None), paths


def expected(rows):
    """(doc_id, leaf, path, subroot, root) of each row, sorted."""
    by_source = {}
    for row in rows:
        by_source.setdefault(row[1], []).append((row[0] is not None, row[0] or 0, digest(*map(field, row)), row[0]))
    order = sorted(by_source, key=lambda s: (s is not None, (s or "").encode()))
    found, roots = [], []
    for source in order:
        leaves = sorted(by_source[source], key=lambda r: r[:3])
        root, paths = grown([r[2] for r in leaves])
        roots.append(root)
        found.append([(r[3], r[2], path, root) for r, path in zip(leaves, paths)])
    top, above = grown(roots)
    return sorted(
        [(i, leaf, path + above[k], root, top) for k, part in enumerate(found) for i, leaf, path, root in part], key=str
    )


def actual(docs):
    rows = docs.withColumn("digest_of", merkle.leaf(*[F.col(c) for c in NAMES]))
    kept = merkle.manifest(rows, "source", ["doc_id"], "digest_of")
    return sorted(
        [(r.doc_id, r.digest_of, [tuple(s) for s in r.path], r.subroot, r.root) for r in kept.collect()], key=str
    ), kept


def plain(docs):
    return docs.selectExpr(*NAMES)


@pytest.fixture(scope="module")
def many(spark):
    rng = random.Random(12)
    sizes = {None: 3, "": 1, "a": 16, "b": 17, "hot": 4200, "é": 256, "z": 257, **{f"s{i}": 1 for i in range(40)}}
    rows = [
        (rng.randrange(10**9), source, rng.choice(["en", None]), rng.choice([None, 5]), f"Text {rng.random()} É")
        for source, size in sizes.items()
        for _ in range(size)
    ]
    rng.shuffle(rows)
    return rows


SCHEMA = "doc_id long, source string, lang string, n_chars long, text string"


def test_equals_a_tree_built_by_hand(spark, many):
    found, kept = actual(spark.createDataFrame(many, SCHEMA))
    assert found == expected(many)
    whole = kept.select(
        merkle.fold(F.col("digest_of"), F.col("path")).alias("up"),
        merkle.fold(F.sha2(F.lit("changed"), 256), F.col("path")).alias("wrong"),
        merkle.proof(F.col("path")).alias("proof"),
        "path",
        "root",
    ).collect()
    assert all(r.up == r.root and r.wrong != r.root for r in whole)
    assert all(r.proof == digest(*[s.before + s.after for s in r.path]) for r in whole[:200])


def test_odd_rows_and_clashing_columns(spark, odd_docs, odd_rows):
    rows = plain(odd_docs)
    found, _ = actual(rows)
    assert found == expected([tuple(r) for r in rows.collect()])
    assert actual(odd_docs.select(*NAMES, "score", "label"))[0] == found


def test_equal_rows_stand_side_by_side(spark):
    rows = [(7, "a", "en", 1, "same")] * 700 + [(1, "a", "en", 1, "other")]
    found, _ = actual(spark.createDataFrame(rows, SCHEMA))
    assert found == expected(rows)


def test_one_row_and_none(spark):
    rows = [(1, None, None, None, None)]
    found, _ = actual(spark.createDataFrame(rows, SCHEMA))
    assert found == expected(rows) and found[0][1] == found[0][3] == found[0][4]
    assert actual(spark.createDataFrame([], SCHEMA))[0] == []


def test_query(spark, sf_dir):
    from __spark_entry__ import queries

    import zlib

    docs = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select(*NAMES).collect()]
    want = {(i, leaf): (subroot, root, path) for i, leaf, path, subroot, root in expected(docs)}
    texts = {row[0]: row for row in docs}
    rows = queries()["op12_merkle_manifest"](spark, sf_dir).collect()
    assert len(rows) == len(docs)
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    wrong = 0
    for r in rows:
        subroot, root, path = want[r.doc_id, r.leaf]
        assert (r.subroot, r.root, r.proof_sha256) == (subroot, root, digest(*[a + b for a, b in path]))
        now = list(texts[r.doc_id])
        if zlib.crc32(str(r.doc_id).encode()) % 5 == 0 and now[4] is not None:
            now[4] = now[4].translate(lower)
        node = digest(*map(field, now))
        for before, after in path:
            node = digest(before, node, after)
        assert r.folded_root == node and r.verified == (node == root)
        wrong += not r.verified
    assert 0 < wrong < len(rows) / 2
