import random
import re

import pytest
from pyspark.sql import functions as F

from shoreline.llm import linededup, registry
from llm.test_linking import components


def normal(line):
    return re.sub(r"\d", "0", " ".join(re.findall(r"\w+", line.lower())))


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def brute(rows):
    """The kept text of each (doc_id, text), comparing all pairs of lines."""
    rows = sorted({(i, t) for i, t in rows if i is not None and t is not None})
    lines = [(i, n, t, normal(line)) for i, t in rows for n, line in enumerate(t.split("\n"))]
    lines = [x for x in lines if len(x[3]) >= linededup.LEAST_CHARS]
    prints = {}
    for *_, line in lines:
        found = linededup.Normal([line])
        prints[line] = int(found.nodes()[1][0])
    distinct = sorted(prints)
    number = {line: k for k, line in enumerate(distinct)}
    edges = [
        (number[a], number[b])
        for a in distinct
        for b in distinct
        if a < b and (prints[a] ^ prints[b]).bit_count() <= 3 and distance(a, b) <= 0.2 * max(len(a), len(b))
    ]
    roots = components(edges)
    first, gone = {}, {}
    for i, n, t, line in sorted(lines):
        group = roots.get(number[line], number[line])
        if first.setdefault(group, (i, n, t)) != (i, n, t):
            gone.setdefault((i, t), set()).add(n)
    return {(i, t): "\n".join(x for n, x in enumerate(t.split("\n")) if n not in gone.get((i, t), ())) for i, t in rows}


def some_lines(rng, n):
    words = [f"word{i}" for i in range(300)]
    lines = [" ".join(rng.choice(words) for _ in range(rng.choice([2, 6, 40]))) for _ in range(12)]
    out = []
    for _ in range(n):
        text = []
        for _ in range(rng.randint(0, 6)):
            line = rng.choice(lines).split(" ")
            if rng.random() < 0.5:
                line[rng.randrange(len(line))] = rng.choice(["it", "a", "9", "No"])
            if rng.random() < 0.2:
                line = [w.upper() + "," for w in line]
            text.append(" ".join(line))
        out.append("\n".join([*text, rng.choice(["", "}", "short"])]))
    return out


@pytest.mark.parametrize("seed", [1, 2])
def test_equals_brute_force(spark, documents, seed):
    rows = list(enumerate(some_lines(random.Random(seed), 50)))
    got = linededup.dedup(spark, documents(*rows))
    assert {(r.row.doc_id, r.row.text): r.text for r in got.collect()} == brute(rows)
    assert got.agg(F.sum("n_removed")).first()[0] > 40


def test_given_table_keeps_each_line_once(spark):
    from llm.conftest import SF

    got = registry.op4_line_dedup(spark, SF).collect()
    seen = [normal(line) for r in got for line in r.text.split("\n")]
    long = [line for line in seen if len(line) >= linededup.LEAST_CHARS]
    assert len(long) == len(set(long))
    lines = spark.read.parquet(f"{SF}/documents.parquet").collect()
    every = {normal(line) for r in lines for line in r.text.split("\n")}
    assert len(got) == len(lines) and len({x for x in every if len(x) >= 20} - set(long)) < 0.02 * len(every)


def test_simhash_does_not_depend_on_neighbours_or_length():
    long = " ".join(f"token{i}" for i in range(2000))
    alone = linededup.Normal([long]).nodes()[1]
    among = linededup.Normal(["some other line of words here\n" + long, long]).nodes()[1]
    assert among[1] == among[2] == alone[0]


def test_bound_and_bits_agree_with_the_table(spark):
    rng = random.Random(4)
    pairs = []
    for n in (25, 60, 400, 2500):
        a = "".join(rng.choice("abcdef ") for _ in range(n))
        for edits in (0, 1, n // 6, n // 5, n // 4):
            b = list(a)
            for _ in range(edits):
                b[rng.randrange(len(b))] = rng.choice("xyz")
            pairs.append((2 * len(pairs), 2 * len(pairs) + 1, a, "".join(b) + "q" * rng.randint(0, 2)))
    table = {(a, b): distance(a, b) for *_, a, b in pairs}
    assert all(linededup.distance(a, b) == linededup.distance(b, a) == d for (a, b), d in table.items())
    assert [linededup.distance(*p) for p in (("", ""), ("a", ""), ("ab", "ab"), ("kitten", "sitting"), ("日本", "日x本"))] == [0, 1, 0, 3, 1]
    assert all(linededup.bound(a, b, 10**9) >= d and linededup.bound(a, b, d) >= d for (a, b), d in table.items())
    got = linededup.near_pairs(spark.createDataFrame(pairs, "a bigint, b bigint, a_wording string, b_wording string"))
    wanted = {(i, j) for i, j, a, b in pairs if table[a, b] <= int(0.2 * max(len(a), len(b)) + 1e-9)}
    assert {tuple(r) for r in got.collect()} == wanted and 0 < len(wanted) < len(pairs)


def test_near_decides_like_the_distance():
    """Lines with words replaced, dropped, added and moved, on both sides of the limit."""
    rng, decided = random.Random(6), []
    words = [f"w{i}" * rng.randint(1, 3) for i in range(40)]
    for _ in range(600):
        a = [rng.choice(words) for _ in range(rng.randint(1, 25))]
        b = list(a)
        for _ in range(rng.randint(0, 6)):
            at = rng.randrange(len(b) + 1)
            b[at : at + rng.randint(0, 2)] = rng.choices(words, k=rng.randint(0, 2))
        a, b = " ".join(a), " ".join(b)
        decided.append(linededup.near(a, b))
        assert decided[-1] == (distance(a, b) <= int(0.2 * max(len(a), len(b)) + 1e-9))
    assert 100 < sum(decided) < 500


def test_awkward_rows(spark, awkward):
    got = linededup.dedup(spark, awkward).collect()
    by_id = {r.row.doc_id: r for r in got}
    assert len(got) == awkward.count() - 1  # the repeated row is one document
    assert by_id[1].text is None and by_id[2].text == "" and by_id[3].text == " \n\t\n " and by_id[1].n_lines == 0
    assert by_id[4].n_removed == 0 and (by_id[5].n_removed, by_id[5].text) == (1, "")
    cleaned = linededup.cleaned(spark, awkward)
    assert cleaned.columns == awkward.columns and sorted(r.doc_id or 0 for r in cleaned.collect()) == [0, 1, 2, 3, 4, 6, 7]
    assert linededup.dedup(spark, awkward.limit(0)).count() == 0


def test_what_is_left_is_counted(spark, documents):
    line = "a passage of words that stands in both of the texts"
    docs = documents((1, line + "\nown"), (2, "x\n" + line))
    assert [(r.doc_id, r.text, r.n_chars) for r in linededup.cleaned(spark, docs).orderBy("doc_id").collect()] == [(1, line + "\nown", len(line) + 4), (2, "x", 1)]


def test_of_rows_equal_in_id_and_text_the_same_one_stays(spark, documents):
    rows = [(1, "some words of a line that is kept", "en", f"s{i}") for i in range(6)]
    for parts in (1, 5):
        left = linededup.cleaned(spark, documents(*rows).repartition(parts)).collect()
        assert [(r.doc_id, r.source) for r in left] == [(1, "s5")]


def test_kernels_take_little_memory_at_a_time():
    """A worker lays texts of any number piece by piece; its largest arrays stay small."""
    import tracemalloc

    import numpy as np
    import pyarrow as pa

    from shoreline.llm import langid, text

    texts = [f"{i} " + "one more line of some words\n" * 70 for i in range(512)]
    batch = pa.RecordBatch.from_pydict({"doc_id": list(range(512)), "text": texts})
    model = ["a"], np.ones(langid.DIMENSIONS, np.float32), np.ones((1, langid.DIMENSIONS), np.float32), np.zeros(1, int), np.zeros(64)

    def lines():
        for start, stop in text.chunks(texts, linededup.CHARACTERS):
            linededup.Normal(texts[start:stop]).nodes()

    text._values(), [text.table(kind) for kind in ("word", "letter", "digit")]
    text._powers.cache_clear()
    for work in (lines, lambda: langid.label(batch, "text", *model)):
        tracemalloc.start()
        work()
        peak = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        assert peak < 24 << 20, peak


def test_texts_go_to_python_once(spark, documents):
    rows = [(1, "one line that is long enough to count\nand another line that is"), (2, "one line that is long enough to count")]
    left = linededup.cleaned(spark, documents(*rows))
    plan = left._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1, plan
    assert {r.doc_id for r in left.collect()} == {1}
