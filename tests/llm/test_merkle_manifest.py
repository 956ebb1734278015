"""The manifest against a plain tree built level by level, and what tampering does to a proof."""

import hashlib
import random
import zlib

import pytest

from kindred.llm import merkle_manifest

SCHEMA = "doc_id long, source string, lang string, n_chars long, text string"


def digest(*inputs):
    return hashlib.sha256("".join(inputs).encode()).hexdigest()


def field(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def levels(nodes):
    """All levels of a tree, the lowest first."""
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([digest(*out[-1][i : i + 3]) for i in range(0, len(out[-1]), 3)])
    return out


def way(tree, place):
    """Runs on the way up, each with the place of the node in it."""
    for level in tree[:-1]:
        first = place // 3 * 3
        yield level[first : first + 3], place - first
        place //= 3


def plain(rows):
    leaf_of = {i: digest(*map(field, row)) for i, row in enumerate(rows)}
    sources = {}
    for i, row in enumerate(rows):
        sources.setdefault(row[1], []).append(i)
    order = sorted(sources, key=lambda s: (s is not None, (s or "").encode()))
    for members in sources.values():
        members.sort(key=lambda i: (rows[i][0] is not None, rows[i][0] or 0, leaf_of[i]))
    trees = {s: levels([leaf_of[i] for i in sources[s]]) for s in order}
    top = levels([trees[s][-1][0] for s in order])
    out = []
    for i, (key, source, lang, n_chars, text) in enumerate(rows):
        runs = [*way(trees[source], sources[source].index(i)), *way(top, order.index(source))]
        siblings = [n for run, at in runs for k, n in enumerate(run) if k != at]
        if key is not None and text is not None and zlib.crc32(str(key).encode()) % 2 == 0:
            text = text.replace("\n", "")
        node = digest(*map(field, (key, source, lang, n_chars, text)))
        for run, at in runs:
            node = digest(*run[:at], node, *run[at + 1 :])
        root = top[-1][0]
        out.append((str(key), leaf_of[i], trees[source][-1][0], root, digest(*siblings), node, node == root))
    return sorted(out)


def answer(docs):
    found = merkle_manifest.checked(merkle_manifest.manifest(docs))
    assert found.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    return sorted((str(r[0]), *r[1:]) for r in found.collect())


def random_rows(seed, n, sources):
    rng = random.Random(seed)
    rows = [(i, rng.choice(sources), rng.choice(["en", None]), rng.randrange(99), rng.choice(["a\nb", "plain", "é\n", None, ""])) for i in range(n)]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("rows", [
    random_rows(1, 1, ["a"]), random_rows(2, 2, ["a", "b"]), random_rows(3, 200, ["a", "b", "é", "B", "😀", None, ""]),
    random_rows(4, 500, [*"abcdefghijklmnop", *["hot"] * 20]), random_rows(5, 60, [f"host{i}" for i in range(50)]),
], ids=["one", "two", "odd", "hot", "many"])
@pytest.mark.parametrize("height", [1, 2, 8])
def test_manifest(spark, monkeypatch, rows, height):
    monkeypatch.setattr(merkle_manifest, "HEIGHT", height)  # small blocks: several levels of appended block roots
    monkeypatch.setattr(merkle_manifest, "_block_witnesses", _with_height(height))
    assert answer(spark.createDataFrame(rows, SCHEMA).repartition(3)) == plain(rows)


def _with_height(height):
    """The step over one block, with its height set where it runs."""
    step = merkle_manifest._block_witnesses

    def run(table):
        from kindred.llm import merkle_manifest as there

        there.HEIGHT = height
        return step(table)

    return run


def test_odd_rows(spark):
    rows = [
        (None, None, None, None, None), (None, "a", "x", 1, "no id\n"), (1, "a", None, 0, ""), (1, "a", None, 0, ""), (1, "a", "y", 0, "one id\n"),
        (2, None, "z", -5, "\n\n\n"), (3, "b", "z", 2, "long\n" * 50_000), (4, "b", "", 2, "😀é\n"),
    ]
    rows += [(5, "same", "x", 1, "again\n")] * 40
    docs = spark.createDataFrame([(*r, "g", b"l", 1, 2) for r in rows], SCHEMA + ", group string, leaf binary, pos int, steps int")
    assert answer(docs) == plain(rows)
    assert answer(spark.createDataFrame([], SCHEMA)) == []


def test_changed_digests_are_found(spark):
    """A witness or a leaf with one changed bit no longer leads to the root."""
    from pyspark.sql import functions as F

    rows = random_rows(6, 40, ["a", "b"])
    found = merkle_manifest.manifest(spark.createDataFrame(rows, SCHEMA))
    honest = found.withColumn("changed", F.col("leaf"))
    assert all(r.verified for r in merkle_manifest.checked(honest).collect())
    other = F.unhex(F.sha2(F.lit("other"), 256))
    assert not any(r.verified for r in merkle_manifest.checked(found.withColumn("changed", other)).collect())
    swapped = F.transform("steps", lambda s: F.struct(s["right"].alias("left"), s["left"].alias("right")))
    assert not all(r.verified for r in merkle_manifest.checked(honest.withColumn("steps", swapped)).collect())
