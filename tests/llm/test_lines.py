import hashlib
from collections import defaultdict

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tamiz.llm.lines import LineRuns, drop_repeated_lines, merged_runs

SPACE = " \t\n\x0b\x0c\r"
LONG = "a line of more than twenty characters"
ASCII = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def name(line):
    return line.strip(SPACE).translate(ASCII)


def brute(docs, min_chars=20, min_docs=3):
    holders = defaultdict(set)
    for key, text in docs:
        for line in (text or "").split("\n"):
            holders[name(line)].add(key)
    out = []
    for key, text in docs:
        lines = (text or "").split("\n")
        kept = []
        for line in lines:
            who = holders[name(line)]
            top = max((w for w in who if w is not None), default=None)
            if len(name(line)) < min_chars or len(who) < min_docs or (key is not None and key == top):
                kept.append(line)
        out.append((key, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return sorted(out, key=repr)


def found(df, **options):
    out, made = drop_repeated_lines(df, **options)
    return sorted([(r["doc_id"], r[made]["n_lines"], r[made]["n_dropped"], r[made]["kept"]) for r in out.collect()], key=repr)


def check(rows, docs, **options):
    limits = {k: v for k, v in options.items() if k in ("min_chars", "min_docs")}
    assert found(rows("doc_id long, text string", docs, 3), **options) == brute(docs, **limits)


def test_lines_of_three_documents_stay_in_the_largest(rows):
    docs = [(i, f"own {i}\n  {LONG.upper()}\t\nrest") for i in range(10)]
    check(rows, docs)
    check(rows, docs, batches=3, buckets=2)


def test_odd_rows(rows):
    docs = [
        (None, f"{LONG}\n"),
        (None, LONG),
        (1, None),
        (2, ""),
        (3, f"{LONG}\n{LONG}\n\n"),
        (4, LONG + "\r"),
        (4, f"x\n{LONG}"),  # the same document again
        (5, "é" * 20),
        (6, "é" * 20 + "\x0b"),
        (7, "\xa0" + "é" * 20),  # not white space here
        (8, "É" * 20),  # only A-Z are lower-cased
        (9, "é" * 20 + "\n" + "e" * 19),
        (10, "e" * 19),
        (11, "e" * 19),
        (-5, "z" * 300_000 + "\n" + LONG),
    ]
    check(rows, docs)
    check(rows, docs, batches=1)
    check(rows, docs, min_docs=2, min_chars=1)


def test_two_documents_are_too_few_however_often_they_repeat_a_line(rows):
    check(rows, [(1, f"{LONG}\n{LONG}"), (1, LONG), (2, f"{LONG}\n{LONG}")])


def test_empty_table(rows):
    assert found(rows("doc_id long, text string", [])) == []


def test_columns_with_clashing_names_stay(rows):
    df = rows("DOC string, lost int, hashes int, lines string, doc_id int, text string", [("d", 1, 2, "l", i, LONG) for i in range(3)])
    out, made = drop_repeated_lines(df)
    assert out.columns == [*df.columns, made]
    kept = {r["doc_id"]: (r["DOC"], r["lost"], r["hashes"], r["lines"], r[made]["kept"]) for r in out.collect()}
    assert kept == {i: ("d", 1, 2, "l", LONG if i == 2 else "") for i in range(3)}


lines = st.lists(st.sampled_from([LONG, LONG.upper(), f" {LONG} ", "", "short", "other " + LONG, "third " + LONG]), max_size=4)


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(st.sampled_from([None, *range(8)]), st.none() | lines.map("\n".join)), min_size=1, max_size=20), st.integers(1, 5))
def test_equals_brute_force(rows, docs, batches):
    check(rows, docs, batches=batches, buckets=2)


def test_hot_and_cold_lines_take_different_ways_to_the_same_result(rows, monkeypatch):
    monkeypatch.setattr("tamiz.llm.lines.HOT_LINES", 10)
    docs = [(i, "\n".join([LONG, f"group {i % 9} of documents and its line", f"a line that stands in document {i}"])) for i in range(60)]
    check(rows, docs, batches=4, buckets=3)


def entries(spark, lines, docs):
    return spark.createDataFrame([(h, -h, d) for h in lines for d in docs], "h1 long, h2 long, doc long")


def test_runs_know_each_line_once_and_count_up(spark):
    runs = LineRuns(spark, 3, 2)
    runs.add(entries(spark, [1, 2], [9]), 100)
    runs.add(entries(spark, [2, 3], [7, 8]), 100)
    runs.add(entries(spark, [2, 4], [1, 2, 3]), 100)
    assert {r["h1"]: (r["n"], r["top"]) for r in runs.repeated().collect()} == {2: (3, 9), 4: (3, 3)}
    runs.drop()


def test_a_hot_line_is_counted_in_every_batch(spark):
    runs = LineRuns(spark, 3, 2)
    runs.add(entries(spark, [1], [9, 8, 7]), 4)
    runs.add(entries(spark, [1], range(5)), 4)
    assert {r["h1"]: (r["n"], r["top"]) for r in runs.repeated().collect()} == {1: (8, 9)}
    runs.drop()


def test_levels_hold_one_run_each_and_old_tables_go(spark):
    runs = LineRuns(spark, 3, 2)
    for i in range(7):
        runs.add(entries(spark, [i], [100 - i]), 100)
    assert sorted(runs.levels) == [0, 1, 2]
    assert spark.sql(f"SHOW TABLES IN {runs.tables.database}").count() == 3
    runs.drop()


def test_neither_merges_nor_anti_joins_shuffle_a_run(spark):
    runs = LineRuns(spark, 3, 4)
    runs.add(entries(spark, [1, 2], [9]), 100)
    first = runs.levels[0]
    runs.levels.clear()
    runs.add(entries(spark, [2, 3], [8]), 100)
    merged = merged_runs(first, runs.levels[0])
    assert "Exchange" not in merged._jdf.queryExecution().executedPlan().toString()
    runs.levels[1] = first
    runs.drop()


@pytest.mark.parametrize("batches", [1, 8])
def test_query_hashes_the_kept_text(spark, rows, batches):
    out, made = drop_repeated_lines(rows("doc_id long, text string", [(i, f"{LONG}\n{i}") for i in range(4)]), batches=batches)
    got = {r[0]: r[1] for r in out.select("doc_id", F.sha2(F.col(f"{made}.kept").cast("binary"), 256)).collect()}
    assert got == {i: hashlib.sha256((f"{LONG}\n3" if i == 3 else str(i)).encode()).hexdigest() for i in range(4)}
