"""The manifest against a plain tree in memory."""

import hashlib
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from odd_rows import documents, empty
from paperloom.llm import merkle


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def field(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def plain_leaf(row, text):
    return sha("".join(field(v) for v in (row["doc_id"], row["source"], row["lang"], row["n_chars"], text)))


def plain_tree(nodes):
    """(top, path of each node): before and after on every level."""
    levels = [nodes]
    while len(levels[-1]) > 1:
        levels.append([sha("".join(levels[-1][i : i + 8])) for i in range(0, len(levels[-1]), 8)])
    paths = []
    for place in range(len(nodes)):
        path = []
        for level in levels[:-1]:
            first = place // 8 * 8
            path.append(("".join(level[first:place]), "".join(level[place + 1 : first + 8])))
            place //= 8
        paths.append(path)
    return levels[-1][0], paths


def plain_manifest(rows, shown):
    trees = defaultdict(list)
    for row in rows:
        trees[row["lang"]].append((row["doc_id"] is not None, row["doc_id"] or 0, plain_leaf(row, row["text"]), row))
    langs = sorted(trees, key=lambda x: (x is not None, (x or "").encode()))
    tops = {}
    for lang in langs:
        trees[lang].sort(key=lambda t: t[:3])
        tops[lang] = plain_tree([t[2] for t in trees[lang]])
    root, over = plain_tree([tops[lang][0] for lang in langs])
    found = []
    for lang, above in zip(langs, over):
        for (_, _, leaf, row), path in zip(trees[lang], tops[lang][1]):
            folded = plain_leaf(row, shown(row))
            for before, after in path + above:
                folded = sha(before + folded + after)
            proof = sha("".join(b + a for b, a in path + above))
            found.append((row["doc_id"], leaf, tops[lang][0], root, proof, folded, folded == root))
    return sorted(found, key=repr)


def lowered(row):
    text = row["text"]
    if row["doc_id"] is not None and zlib.crc32(str(row["doc_id"]).encode()) % 3 == 0 and text is not None:
        return "".join(c.lower() if "A" <= c <= "Z" else c for c in text)
    return text


def manifest_rows(df):
    fields = [F.col(c) for c in ("doc_id", "source", "lang", "n_chars")]
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0
    text = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    shown = F.when(tampered, merkle.leaf(*fields, text))
    found = merkle.manifest(df, F.col("lang"), F.col("doc_id"), merkle.leaf(*fields, F.col("text")), shown, ["doc_id"])
    rows = [tuple(r) for r in merkle.prove(found).collect()]
    return found, sorted(rows, key=repr)


@pytest.mark.parametrize("n", [1, 2, 8, 9, 65, 513, 600])
def test_equals_plain_tree(spark, n):
    rows = [
        {"doc_id": i * 7, "text": f"Text {i}" if i % 5 else None, "lang": "en" if i % 4 else None, "source": "é", "n_chars": i}
        for i in range(n)
    ]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    assert manifest_rows(df)[1] == plain_manifest(rows, lowered)


def test_more_groups_than_a_run_holds(spark):
    rows = [{"doc_id": i, "text": "A", "lang": f"l{i % 70}", "source": None, "n_chars": None} for i in range(210)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    found, got = manifest_rows(df)
    assert got == plain_manifest(rows, lowered)
    assert len(found.over) == 2  # 70 subroots: two levels of hashes, one of them written


def test_only_every_third_level_is_written(spark):
    rows = [(i, "x") for i in range(5000)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    leaf = merkle.leaf(F.col("doc_id"), F.col("text"))
    found = merkle.manifest(df, F.lit("all"), F.col("doc_id"), leaf, F.lit(None).cast("string"), ["doc_id"])
    assert [level.count() for level in found.kept] == [5000, 10, 1]
    assert merkle.prove(found).filter("not verified").count() == 0


def test_odd_rows(spark):
    rows = [r.asDict() for r in documents(spark).collect()]
    assert manifest_rows(documents(spark))[1] == plain_manifest(rows, lowered)


def test_empty(spark):
    found, rows = manifest_rows(empty(spark))
    assert found.root is None and rows == []


def test_clashing_names(spark):
    df = spark.createDataFrame([(1, "a", 5, "t"), (2, "b", 6, "u")], "tree long, digest string, pos long, kept string")
    leaf = merkle.leaf(F.col("digest"))
    found = merkle.manifest(df, F.lit("g"), F.col("tree"), leaf, F.lit(None).cast("string"), ["tree", "pos"])
    proven = merkle.prove(found)
    assert proven.columns[:2] == ["tree", "pos"]
    assert sorted((r["tree"], r["pos"], r["verified"]) for r in proven.collect()) == [(1, 5, True), (2, 6, True)]
