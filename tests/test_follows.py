from conftest import rows

from quarry.operators import follows
from quarry.sources import text


def _lines(spark, *ls):
    return spark.createDataFrame([(x,) for x in ls], "line string")


def test_parse_edges(spark):
    df = _lines(spark, "1: 2 3 3", "", "  4 :  5", "bad line", "2: ", "1: 9")
    adj = text.parse_adjacency(df)
    got = rows(adj.select("user", "follows"))
    assert got == sorted([("1", ["2", "3", "3"]), ("1", ["9"]), ("2", []), ("4", ["5"])])
    assert rows(text.adjacency_rejects(df)) == [("bad line",)]


def test_out_degree_merges_repeated_owner_lines(spark):
    adj = text.parse_adjacency(_lines(spark, "1: 2 3", "1: 4", "2: 1", "3: "))
    assert rows(follows.follow_counts(adj)) == [("1", 3), ("2", 1), ("3", 0)]
    assert sorted(r[1] for r in rows(follows.follow_counts_per_line(adj))) == [0, 1, 1, 2]
    s = follows.follow_summary(adj).collect()[0]
    assert (s.top_user, s.max_follows, s.n_zero) == ("1", 3, 1)
    assert abs(s.avg_follows - 4 / 3) < 1e-6


def test_tie_goes_to_smallest_id(spark):
    adj = text.parse_adjacency(_lines(spark, "b: x y", "a: x y", "c: x"))
    assert follows.follow_summary(adj).collect()[0].top_user == "a"
    fs = follows.follower_summary(adj).collect()[0]
    assert (fs.top_id, fs.max_followers) == ("x", 3)


def test_in_degree_populations(spark):
    # 9 is mentioned but owns no line; 3 owns a line and nobody follows it.
    adj = text.parse_adjacency(_lines(spark, "1: 2 9", "2: 1", "3: 1"))
    assert rows(follows.follower_counts(adj)) == [("1", 2), ("2", 1), ("3", 0), ("9", 1)]
    g5 = follows.follower_summary(adj).collect()[0]
    assert g5.n_zero == 1 and abs(g5.avg_followers - 1.0) < 1e-9
    g6 = follows.follower_summary_owners(adj).collect()[0]
    assert g6.n_owners == 3 and g6.n_zero == 1        # owner 3 only
    assert abs(g6.avg_followers - 4 / 3) < 1e-6


def test_empty_input_gives_one_row(spark):
    adj = text.parse_adjacency(_lines(spark, ""))
    s = follows.follow_summary(adj).collect()
    assert len(s) == 1 and s[0].top_user is None and s[0].max_follows == 0 and s[0].n_zero == 0
