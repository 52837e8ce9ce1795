import hashlib
import random
import re
from collections import defaultdict

from odd_rows import collect, documents, empty
from paperloom.llm import queries, templates as T


def tokens(line):
    words = re.split(r"[\x20\x09-\x0D]+", line)
    return tuple("<*>" if re.search("[0-9]", w) else w for w in words if w)


def alike(t, constants):
    return sum(t[pos] == token for pos, token in constants) >= len(constants) * T.AGREEMENT


def leaf_templates(group, n):
    """The constants of every template that the lines (doc, number, tokens) of a group follow."""
    of = {d for d, _, _ in group}
    holders, lines = defaultdict(set), defaultdict(int)
    for d, _, t in group:
        for pos in range(T.DEPTH, n):
            holders[pos, t[pos]].add(d)
            lines[pos, t[pos]] += 1
    recurring = {k for k, ds in holders.items() if len(ds) >= T.MIN_DOCS}
    constants = [k for k in recurring if len(holders[k]) > len(of) * T.MAJORITY]
    if len(constants) + T.DEPTH < n * T.CONSTANT_SHARE:
        constants = []
    if constants:
        inside = [x for x in group if alike(x[2], constants)]
        if len({d for d, _, _ in inside}) >= T.MIN_DOCS:
            return [constants, *leaf_templates([x for x in group if x not in inside], n)]
    splits = [(len(holders[k]), -k[0]) for k in recurring if lines[k] < len(group)]
    if not splits:
        return []
    at = -max(splits)[1]
    parts = defaultdict(list)
    for x in group:
        parts[x[2][at] if (at, x[2][at]) in recurring else None].append(x)
    return [found for part in parts.values() for found in leaf_templates(part, n)]


def brute(docs):
    """{(doc, number)} of the lines that go, over {doc: text}, by the definition."""
    lines = [(d, i, tokens(line)) for d, text in docs.items() for i, line in enumerate((text or "").split("\n"))]
    lines = [x for x in lines if set(x[2]) - {"<*>"}]
    holders = defaultdict(set)
    for d, _, t in lines:
        holders[t].add(d)
    dropped = {(d, i) for d, i, t in lines if len(holders[t]) >= T.MIN_DOCS}
    leaves = defaultdict(list)
    for d, i, t in lines:
        if len(holders[t]) < T.MIN_DOCS and len(t) >= T.MIN_TOKENS:
            leaves[len(t), t[: T.DEPTH]].append((d, i, t))
    for (n, _), members in leaves.items():
        if len({d for d, _, _ in members}) >= T.MIN_DOCS:
            for constants in leaf_templates(members, n):
                dropped |= {(d, i) for d, i, t in members if alike(t, constants)}
    return dropped


def made(seed=4):
    draw = random.Random(seed)
    words = "alpha beta gamma delta epsilon zeta eta theta iota kappa lam mu nu xi".split()
    docs = {}
    for d in range(60):
        lines = [" ".join(draw.choice(words) for _ in range(draw.randrange(1, 14))) for _ in range(6)]
        if d % 3 == 0:
            lines.insert(2, f"page {d} was shown at {d * 7}:00 to  all readers")
        if d % 4 == 0:
            lines.append(f"written by the editor {draw.choice(words)}{draw.choice(words)} for all our dear readers here")
        if d % 5 == 0:
            lines += ["too short", "", "all rights are reserved", "all rights are reserved"]
        docs[d] = "\n".join(lines)
    return docs


def test_dropped_lines_match_brute_force(spark):
    docs = made()
    want = brute(docs)
    assert len(want) > 40
    table = spark.createDataFrame(list(docs.items()), "doc_id long, text string")
    found = {(r["doc_id"], i) for r in T.boilerplate(table).collect() for i in r["dropped"]}
    assert found == want
    for row in T.clean(table).collect():
        d = row["row"]["doc_id"]
        lines = docs[d].split("\n")
        assert row["row"]["text"] == "\n".join(line for i, line in enumerate(lines) if (d, i) not in want)
        assert row["n_lines"] == len(lines) and row["n_dropped"] == sum(x == d for x, _ in want)


def test_a_line_many_share_goes_and_clean_lines_stay(spark):
    rows = [(i, f"own line number {chr(97 + i % 26)}{i // 26 * 'x'} of this text\nshared line of the site 12{i}") for i in range(300)]
    table = spark.createDataFrame(rows, "doc_id long, text string")
    texts = [r["text"] for r in collect(T.drop_lines(table))]
    assert not any("shared" in t for t in texts)


def dropped_of(spark, docs):
    table = spark.createDataFrame(list(docs.items()), "doc_id long, text string")
    return {(r["doc_id"], i) for r in T.boilerplate(table).collect() for i in r["dropped"]}


def word(n):
    return "".join(chr(97 + int(c)) for c in str(n))


def test_given_documents_match_brute_force(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    want = brute({r["doc_id"]: r["text"] for r in rows})
    assert any(len(tokens(r["text"].split("\n")[i])) < T.MIN_TOKENS for r in rows for d, i in want if d == r["doc_id"])
    found = queries.all_queries()["op10_line_templates"](spark, sf_dir).collect()
    for r, f in zip(sorted(rows), sorted(found)):
        kept = [line for i, line in enumerate(r["text"].split("\n")) if (r["doc_id"], i) not in want]
        assert (f["doc_id"], f["n_dropped"]) == (r["doc_id"], sum(d == r["doc_id"] for d, _ in want))
        assert f["text_sha256"] == hashlib.sha256("\n".join(kept).encode()).hexdigest()


def test_short_lines_go_and_lines_of_fields_stay(spark):
    docs = {i: f"All rights reserved.\n{i} 1{i}\n\nMenu\nown {word(i)}\nPage {i}" for i in range(5)}
    assert dropped_of(spark, docs) == brute(docs) == {(i, n) for i in docs for n in (0, 3, 5)}


def test_many_templates_of_many_leaves_match_brute_force(spark):
    draw = random.Random(9)
    ends = [" ".join(draw.choice("readers owners guests of our old new house garden letter".split()) for _ in range(7)) for _ in range(6)]
    docs = {}
    for d in range(80):
        lines = [f"written for you by {word(d)}{i} x{word(draw.randrange(40))} {draw.choice(ends)}".replace(str(i), "q") for i in range(3)]
        docs[d] = "\n".join(lines)
    want = brute(docs)
    assert len(want) > 60
    assert dropped_of(spark, docs) == want


def test_templates_that_share_a_leaf_all_go(spark):
    ends = ["readers of our weekly sports letter", "owners of the old wooden houses", "guests at any spring garden party"]
    docs = {i: f"written for you by {word(i)} with {ends[i % 3]}" for i in range(90)}
    assert dropped_of(spark, docs) == brute(docs) == {(i, 0) for i in docs}


def test_a_template_goes_however_full_its_leaf_is(spark):
    template = {i: f"written for you by {word(i)} with love from the whole team" for i in range(5)}
    alone = {i: f"written for you by {' '.join(word(i) + x * 2 for x in 'klmnopq')}" for i in range(10, 40)}
    for others in (0, 1, 7, 30):
        docs = template | dict(list(alone.items())[:others])
        assert dropped_of(spark, docs) == {(i, 0) for i in template}


def test_two_templates_of_the_same_documents_go(spark):
    lines = ["written for you by {} with love from the whole team", "written for you by {} as part of our spring letter"]
    docs = {i: "\n".join(line.format(word(i)) for line in lines) for i in range(6)}
    assert dropped_of(spark, docs) == {(i, n) for i in docs for n in (0, 1)}


def test_odd_rows(spark):
    docs = documents(spark)
    cleaned = T.drop_lines(docs)
    assert cleaned.columns == docs.columns
    assert sorted(r["row_id"] for r in cleaned.collect()) == sorted(r["row_id"] for r in docs.collect())
    before = {r["row_id"]: r["text"] for r in docs.collect()}
    assert all(r["text"] == before[r["row_id"]] for r in cleaned.collect())


def test_empty_table(spark):
    assert T.drop_lines(empty(spark)).count() == 0
