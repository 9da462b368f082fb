"""Appends that are retried, packed trees, point files: through real files."""
import os
import time

import pytest
from conftest import rows

from quarry.sources import files, sinks, text


def test_replayed_and_lost_batches(spark, tmp_path):
    out = str(tmp_path / "r")
    df = spark.createDataFrame([("a", 1), ("b", 2)], "k string, v bigint")
    assert sinks.read_appended(spark, out, "k string, v long").collect() == []
    assert sinks.append_batch(df, out, "b1") and not sinks.append_batch(df, out, "b1")
    sinks.stage_batch(df, out, "b2")                      # the writer died before the commit
    assert rows(sinks.read_appended(spark, out, "k string, v long").select("batch", "k", "v")) == [("b1", "a", 1), ("b1", "b", 2)]
    other = spark.createDataFrame([("c", 3)], "k string, v bigint")
    assert sinks.append_batch(other, out, "b2")           # the retry replaces what was left
    assert sinks.append_batch(df.limit(0), out, "b3")     # an empty batch counts, once
    assert not sinks.append_batch(df, out, "b3")
    assert rows(sinks.read_appended(spark, out, "k string, v long").select("batch", "k", "v")) == [("b1", "a", 1), ("b1", "b", 2), ("b2", "c", 3)]
    assert rows(sinks.committed(spark, out)) == [("b1",), ("b2",), ("b3",)]
    with pytest.raises(ValueError):
        sinks.append_batch(df, out, "../x")


def test_packing_reads_only_what_changed(spark, tmp_path):
    root, packed = tmp_path / "tree", str(tmp_path / "packed")
    df = spark.createDataFrame([(f"s/{i % 3}/{i}.c", f"int x{i};\n" * i) for i in range(1, 20)] + [("n.h", None)], "path string, content string")
    assert files.write_tree(df.repartition(3), f"file://{root}") == 20
    old = time.time() - 100
    for d, _, names in os.walk(root):
        for n in names:
            os.utime(f"{d}/{n}", (old, old))
    assert files.pack_tree(spark, f"file://{root}", packed) == 19
    assert files.pack_tree(spark, f"file://{root}", packed) == 19          # nothing new
    (root / "s/0/3.c").write_text("changed")
    (root / "new.c").write_text("new\n")
    assert files.pack_tree(spark, f"file://{root}", packed) == 21
    got = {os.path.relpath(r.path.removeprefix("file:"), root): (r.content, r.length) for r in files.read_packed(spark, packed).collect()}
    want = {f"s/{i % 3}/{i}.c": f"int x{i};\n" * i for i in range(1, 20)} | {"s/0/3.c": "changed", "new.c": "new\n"}
    assert got == {k: (v, len(v)) for k, v in want.items()}
    assert not [n for _, _, names in os.walk(root) for n in names if n.endswith(".part")]


def test_packing_deals_many_small_files_to_few_tasks(spark, tmp_path, monkeypatch):
    # by default 32 small files were a task, and contents were shuffled to the joins with the packed names
    root, packed = tmp_path / "tree", str(tmp_path / "packed")
    df = spark.range(400).selectExpr("concat('s/', id, '.c') as path", "concat('int x', id, ';') as content")
    assert files.write_tree(df.coalesce(2), f"file://{root}") == 400
    seen = []
    append = files.sinks.append_batch
    monkeypatch.setattr(files.sinks, "append_batch", lambda rows, *a: (seen.append((rows.rdd.getNumPartitions(), rows._jdf.queryExecution().executedPlan().toString())), append(rows, *a))[1])
    cost = spark.conf.get("spark.sql.files.openCostInBytes")
    assert files.pack_tree(spark, f"file://{root}", packed) == 400
    assert spark.conf.get("spark.sql.files.openCostInBytes") == cost
    assert seen[0][0] <= 8
    (root / "s/3.c").write_text("later")
    os.utime(root / "s/3.c", (time.time() + 5, time.time() + 5))
    assert files.pack_tree(spark, f"file://{root}", packed) == 401
    assert "SortMergeJoin" not in seen[1][1]
    whole = files.read_packed(spark, packed)
    assert "SortMergeJoin" not in whole._jdf.queryExecution().executedPlan().toString()
    got = {os.path.basename(r.path): r.content for r in whole.collect()}
    assert got == {f"{i}.c": f"int x{i};" for i in range(400)} | {"3.c": "later"}


def test_line_numbers_follow_the_names_of_files(spark, tmp_path):
    for name, n in (("b.txt", 3), ("a.txt", 500), ("c.txt", 40)):   # Spark reads large files first
        (tmp_path / name).write_text("".join(f"{name[0]}{i}\n" for i in range(n)))
    got = {r.qid: r.line for r in text.with_line_ids(text.read_lines(spark, str(tmp_path))).collect()}
    assert [got[i] for i in range(543)] == [f"a{i}" for i in range(500)] + [f"b{i}" for i in range(3)] + [f"c{i}" for i in range(40)]


def test_point_rejects(spark, tmp_path):
    (tmp_path / "p.csv").write_text("location,latitude,longitude\nA,1,2\nB,x,2\nC,,2\nD,91,0\nE,NaN,0\nF,-90,400\nG,Infinity,1\nH\n")
    assert rows(text.point_rejects(spark, str(tmp_path / "p.csv")).select("id", "location")) == [(1, "B"), (2, "C"), (3, "D"), (4, "E"), (6, "G"), (7, "H")]
    pts = {r.location: (r.id, r.latitude, r.longitude) for r in text.read_point_csv(spark, str(tmp_path / "p.csv")).collect()}
    assert pts["A"] == (0, 1.0, 2.0) and pts["B"] == (1, None, 2.0) and pts["F"] == (5, -90.0, 400.0)
    (tmp_path / "q.csv").write_text("name,easting,northing\nA,1.5,2\nB,2,z\n")
    assert rows(text.point_rejects(spark, str(tmp_path / "q.csv"), "plane")) == [(1, "B", "2", "z")]


def test_a_session_without_a_shared_folder(tmp_path):
    import subprocess
    import sys
    code = ("from quarry.session import build_session, scratch_path; s = build_session('local[1]', 1); s.conf.get('spark.checkpoint.dir', None); "
            "a = scratch_path(s, 'x'); s.range(3).write.parquet(a); print(s.read.parquet(a).count())")
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    out = subprocess.run([sys.executable, "-c", code], cwd=root, capture_output=True, text=True, timeout=120)
    assert out.stdout.strip().endswith("3"), out.stderr[-800:]
