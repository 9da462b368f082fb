from conftest import rows

from quarry.operators import authlog, follows, sketch
from quarry.sources import text


def test_text_files_through_the_parsers(spark, tmp_path):
    g = tmp_path / "graph.txt"
    g.write_text("1: 2 3\n\n2: 1\nbroken\n")
    adj = text.parse_adjacency(text.read_lines(spark, str(g)))
    assert rows(follows.follow_counts(adj)) == [("1", 2), ("2", 1)]
    assert rows(text.adjacency_rejects(text.read_lines(spark, str(g)))) == [("broken",)]

    log = tmp_path / "SSH.log"
    log.write_text("Dec  3 01:02:03 h sshd[9]: Failed password for root from 1.2.3.4 port 1 ssh2\n"
                   "Dec  3 01:02:04 h sshd[9]: Accepted password for root from 1.2.3.4 port 1 ssh2\n")
    p = authlog.parse(text.read_lines(spark, str(log)))
    assert rows(authlog.attempts_by_account(p)) == [("root", 2)]

    ids = tmp_path / "ids.txt"
    ids.write_text("1 2 3\n3 4\nx 5\n")
    tok = text.parse_id_tokens(text.read_lines(spark, str(ids)))
    assert sorted(r.token for r in tok.collect() if r.token is not None) == [1, 2, 3, 3, 4, 5]
    assert tok.where("token is null").count() == 1          # 'x' -> NULL, job does not fail
    s = sketch.build(tok.where("token is not null"), "token", 64, 1)
    assert s.registers.count() <= 5


def test_vector_text_and_query_lines(spark, tmp_path):
    v = tmp_path / "glove.txt"
    v.write_text("the 0.1 0.2 0.3\nnull 1 0 0\n, 0 0 1\n")
    vec = text.parse_vectors(text.read_lines(spark, str(v)))
    got = {r.word: r.vec for r in vec.collect()}
    assert got == {"the": [0.1, 0.2, 0.3], "null": [1.0, 0.0, 0.0], ",": [0.0, 0.0, 1.0]}
    q = tmp_path / "queries.txt"
    q.write_text("the\nnull\nmissing\n")
    qs = text.with_line_ids(text.read_lines(spark, str(q)))
    assert rows(qs) == [(0, "the"), (1, "null"), (2, "missing")]


def test_point_csv(spark, tmp_path):
    c = tmp_path / "pubs.csv"
    c.write_text("name,easting,northing\nThe Anchor,530000,180000\n\"Bell, The\",1.5,2.5\n")
    df = text.read_point_csv(spark, str(c), kind="planar")
    assert rows(df) == [(0, "The Anchor", 530000.0, 180000.0), (1, "Bell, The", 1.5, 2.5)]
    g = tmp_path / "ufo.csv"
    g.write_text("location,latitude,longitude\nA,10.5,-20.25\n")
    assert rows(text.read_point_csv(spark, str(g))) == [(0, "A", 10.5, -20.25)]


def test_uint64_tokens_keep_their_bits(spark):
    big = spark.createDataFrame([(f"{1 << 63} {(1 << 64) - 1} 7 -5 {1 << 64} 1.5 x 99999999999999999999999",)], "line string")
    got = [(r.pos, r.token) for r in text.parse_id_tokens(big).collect()]
    assert got == [(0, -(1 << 63)), (1, -1), (2, 7), (3, -5), (4, None), (5, None), (6, None), (7, None)]
    assert [r.tok for r in text.id_token_rejects(big).collect()] == [str(1 << 64), "1.5", "x", "99999999999999999999999"]


def test_bad_lines_are_rejects_not_failures(spark):
    lines = spark.createDataFrame([("at name@domain.com 0.1 0.2",), ("a 1 2",), ("b 1 x",), ("c 1",)], "line string")
    got = {r.word: r.vec for r in text.parse_vectors(lines, 2).collect()}
    assert got == {"at name@domain.com": [0.1, 0.2], "a": [1.0, 2.0]}
    assert sorted(r.line for r in text.vector_rejects(lines, 2).collect()) == ["b 1 x", "c 1"]
    assert {r.word for r in text.parse_vectors(lines).collect()} == {"a", "c"}
    q = spark.createDataFrame([(0, "10.5 -20"), (1, "north 3"), (2, " 1  2 "), (3, "4")], "qid long, line string")
    assert rows(text.parse_lat_lon(q)) == [(0, 10.5, -20.0), (1, None, None), (2, 1.0, 2.0), (3, None, None)]
    assert {r.qid: r.vec for r in text.parse_query_vectors(q).collect()} == {0: [10.5, -20.0], 1: None, 2: [1.0, 2.0], 3: [4.0]}
    lab = spark.createDataFrame([(0, " The Bell "), (1, "")], "qid long, line string")
    assert rows(text.parse_labels(lab)) == [(0, "The Bell"), (1, None)]
    log = spark.createDataFrame([("Dec 10 01:01:01 h sshd[1]: message repeated 99999999999999999999 times: [ Failed password for bob from 1.1.1.1 port 1 ssh2]",),
                                 ("Dec 10 01:01:01 h sshd[1]: message repeated 99999999999 times: [ Failed password for bob from 1.1.1.1 port 1 ssh2]",)],
                                "line string")
    assert sorted(r.w for r in authlog.parse(log).collect()) == [1, 99999999999]


def test_csv_goes_straight_into_the_index(spark, tmp_path):
    from quarry.operators import spatial
    c = tmp_path / "pubs.csv"
    c.write_text("name,easting,northing\nA,1,1\nB,bad,2\nC,50,50\n")
    q = tmp_path / "q.csv"
    q.write_text("name,easting,northing\nx,2,2\ny,49,60\n")
    points = text.read_point_csv(spark, str(c), kind="planar")
    queries = text.read_point_csv(spark, str(q), kind="planar").withColumnRenamed("id", "qid")
    assert rows(spatial.nearest_in_plane(points, queries, carry=["name"]).select("qid", "name")) == [(0, "A"), (1, "C")]


def test_results_are_written_in_query_order(spark, tmp_path):
    from quarry.sources import sinks
    out = str(tmp_path / "out")
    sinks.write_result(spark.range(1000).selectExpr("999 - id as qid").repartition(7), out, fmt="parquet", order=["qid"])
    import glob

    import pyarrow.parquet as pq
    got = [x for f in sorted(glob.glob(out + "/part-*")) for x in pq.read_table(f)["qid"].to_pylist()]
    assert got == list(range(1000))


def test_tree_sizes_count_every_file_whole(spark, tmp_path):
    from quarry.operators import corpus
    from quarry.sources.files import read_tree
    (tmp_path / "t").mkdir()
    (tmp_path / "t" / "a.c").write_text("x" * 10)
    (tmp_path / "t" / "b.c").write_text("y\n" * 500)
    tree = read_tree(spark, str(tmp_path / "t"))
    assert rows(corpus.total_bytes(tree)) == [(2, 1010)]
    assert [r.lines for r in corpus.longest(tree, 1).collect()] == [500]


def test_line_ids_across_many_splits(spark, tmp_path):
    f = tmp_path / "many.txt"
    f.write_text("".join(f"line{i:05d}\n" for i in range(5000)))
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        df = text.read_lines(spark, str(f))
        assert df.rdd.getNumPartitions() > 5
        got = text.with_line_ids(df).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert sorted((r.qid, r.line) for r in got) == [(i, f"line{i:05d}") for i in range(5000)]


def test_worker_functions_travel_by_value(tmp_path):
    # Executors may not have the package on their path: functions used in
    # Arrow batches must unpickle in a process that cannot import quarry.
    import subprocess
    import sys

    from pyspark import cloudpickle

    import quarry  # noqa: F401  (registers pickle-by-value)
    from quarry.operators.blocked import _top_rows

    blob = tmp_path / "f.pkl"
    blob.write_bytes(cloudpickle.dumps(_top_rows))
    code = ("import pickle, sys, numpy as np; "
            "sys.path = [p for p in sys.path if 'repo' not in p]; "
            f"f = pickle.loads(open({str(blob)!r}, 'rb').read()); "
            "r, c = f(np.array([[3.0, 1.0, 2.0]]), np.array([7, 8, 9]), 2); "
            "print([int(x) for x in c])")
    out = subprocess.run([sys.executable, "-c", code], cwd=str(tmp_path), capture_output=True, text=True)
    assert out.returncode == 0, out.stderr[-500:]
    assert out.stdout.strip() == "[1, 2]"
