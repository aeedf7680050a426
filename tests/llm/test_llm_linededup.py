"""Line deduplication against dictionaries, and the runs against counting."""

from collections import defaultdict

import pytest

from tidemark.llm.linededup import LineRuns, dedup_lines, line_table
from tidemark.shared import child_names

SPACES = " \t\n\x0b\x0c\r"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def key(line):
    return line.strip(SPACES).translate(LOWER)


def brute(rows):
    holders = defaultdict(list)
    rank = [float("-inf") if k is None else k for k, _ in rows]
    for n, (_, text) in enumerate(rows):
        for k in {key(line) for line in (text or "").split("\n")}:
            holders[k].append(rank[n])
    out = []
    for n, (k, text) in enumerate(rows):
        lines = (text or "").split("\n")
        kept = [
            line
            for line in lines
            if len(key(line)) < 20
            or len(holders[key(line)]) < 3
            or max(holders[key(line)]) == rank[n]
        ]
        out.append((k, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return out


def check(docs, **options):
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    got = dedup_lines(docs, **options).select("doc.doc_id", "n_lines", "n_dropped", "kept")
    got = [tuple(r) for r in got.collect()]
    assert sorted(got, key=str) == sorted(brute(rows), key=str)
    return got


def test_given_documents(spark, sf_dir):
    got = check(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    assert any(n for _, _, n, _ in got)


def test_order_of_batches_does_not_matter(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").limit(120)
    check(docs, batches=1)
    check(docs, batches=7, fanout=2)


def test_ties_nulls_long_texts_and_repeated_rows(documents, tricky):
    line = "This line is shared by many documents."
    rows = [(n, f"{line}\n{n}\n \t{line.upper()}\r\n") for n in range(6)]
    rows += [(5, f"\x0b{line}"), (None, line), (None, line), (99, None), (98, ""), (97, "\n" * 50)]
    rows += [(-5, "É" * 20), (-6, "é" * 20), (-7, "É" * 20), (-8, "É" * 20), (96, "x" * 300_000)]
    check(tricky.unionByName(documents(rows)))


def test_empty_table(nothing):
    assert dedup_lines(nothing).count() == 0


def table_of(docs):
    return line_table(docs, "doc_id", "text", 20)


def hashes(frame):
    return {tuple(r) for r in frame.select("h1", "h2", "n_docs", "last_doc").collect()}


def test_runs_are_sorted_and_compacted(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    runs = LineRuns(spark, fanout=2)
    whole = hashes(runs.run_of(table_of(docs)))
    for number in range(5):
        runs.add(table_of(docs.where(f"doc_id % 5 = {number}")))
    for levels in runs.levels.values():
        assert [len(level) for level in levels] == [1, 0, 1]
    assert hashes(runs.merged()) == whole
    listed = {name for kind in runs.levels for level in runs.levels[kind] for name in level}
    assert {n for n in child_names(spark, runs.root) if n.startswith("run-")} == listed
    for name in listed:
        for path in spark.read.parquet(f"{runs.root}/{name}").inputFiles():
            file = [(r.h1, r.h2) for r in spark.read.parquet(path).collect()]
            assert file == sorted(file)


def test_each_batch_is_anti_joined_with_the_runs(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    runs, seen = LineRuns(spark, fanout=3), set()
    for number in range(4):
        batch = table_of(docs.where(f"doc_id % 4 = {number}"))
        own = {row[:2] for row in hashes(runs.run_of(batch))}
        assert {row[:2] for row in hashes(runs.fresh(runs.run_of(batch)))} == own - seen
        runs.add(batch)
        seen |= own
        keys = [(r.h1, r.h2) for r in runs._keys().collect()]
        assert len(keys) == len(set(keys)) and set(keys) == seen
    assert runs._names("updates")


def test_runs_go_on_in_a_later_session(spark, sf_dir, monkeypatch):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    first = LineRuns(spark, fanout=2)
    for number in range(3):
        first.add(table_of(docs.where(f"doc_id % 5 = {number}")))
    with monkeypatch.context() as patch:
        patch.setattr(LineRuns, "_list", lambda self: (_ for _ in ()).throw(RuntimeError("stopped")))
        with pytest.raises(RuntimeError):
            LineRuns(spark, first.root, fanout=2).add(table_of(docs.where("doc_id % 5 = 3")))
    again = LineRuns(spark, first.root, fanout=2)
    for number in (3, 4):
        again.add(table_of(docs.where(f"doc_id % 5 = {number}")))
    assert hashes(again.merged()) == hashes(again.run_of(table_of(docs)))
