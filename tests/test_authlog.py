from conftest import rows

from quarry.operators import authlog

LINES = [
    "Dec 10 06:55:48 host sshd[1]: Accepted password for alice from 10.0.0.1 port 22 ssh2",
    "Dec 10 06:55:49 host sshd[1]: Failed password for alice from 10.0.0.2 port 22 ssh2",
    "Dec  1 07:00:00 host sshd[1]: Failed password for invalid user support from 10.0.0.3 port 22 ssh2",
    "Dec  1 07:00:01 host sshd[1]: Failed password for invalid user  from 10.0.0.3 port 22 ssh2",
    "Dec  1 07:00:02 host sshd[1]: message repeated 5 times: [ Failed password for bob from 10.0.0.2 port 22 ssh2]",
    "Dec  1 07:00:03 host sshd[1]: Connection closed by 10.0.0.9 port 22",
    "Dec  2 07:00:04 host sshd[1]: Accepted password for bob from 10.0.0.4 port 22 ssh2",
]


def _parsed(spark):
    return authlog.parse(spark.createDataFrame([(x,) for x in LINES], "line string"))


def test_fields(spark):
    got = rows(_parsed(spark).select("day", "is_ok", "account", "invalid_account", "ip", "w"))
    assert got == rows(spark.createDataFrame([
        ("Dec 10", 1, "alice", None, "10.0.0.1", 1),
        ("Dec 10", 0, "alice", None, "10.0.0.2", 1),
        ("Dec  1", 0, "support", "support", "10.0.0.3", 1),   # real IP, not ''
        ("Dec  1", 0, None, "", "10.0.0.3", 1),               # NULL account, '' invalid name
        ("Dec  1", 0, "bob", None, "10.0.0.2", 5),
        ("Dec  2", 1, "bob", None, "10.0.0.4", 1),
    ], "day string, is_ok int, account string, invalid_account string, ip string, w bigint"))


def test_reports(spark):
    p = _parsed(spark)
    assert rows(authlog.attempts_by_account(p)) == [("alice", 2), ("bob", 6), ("support", 1), (None, 1)]
    assert rows(authlog.top_k(authlog.failures_by_ip(p), "ip", "failures", 1)) == [("10.0.0.2", 6)]
    best = rows(authlog.best_success_rate(p))
    assert best == [("alice", 0.5)]
    ext = authlog.day_extremes(p).collect()[0]
    assert (ext.most_day, ext.most_attempts, ext.least_day, ext.least_attempts) == ("Dec  1", 7, "Dec  2", 1)
    counts = authlog.filter_counts(spark.createDataFrame([(x,) for x in LINES], "line string")).collect()[0]
    assert (counts.n_accepted, counts.n_failed, counts.n_failed_invalid) == (2, 4, 2)


def test_top_k_ties_smaller_key_nulls_last(spark):
    df = spark.createDataFrame([(None, 3), ("b", 3), ("a", 3), ("c", 1)], "account string, n bigint")
    assert [r.account for r in authlog.top_k(df, "account", "n", 3).collect()] == ["a", "b", None]
