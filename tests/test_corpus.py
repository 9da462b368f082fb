import hashlib
import os

from conftest import rows

from quarry.operators import corpus
from quarry.sources.files import read_tree
from quarry.sources.sinks import append_result, write_result


def _tree(tmp_path):
    files = {
        "a/x.c": "// SPDX-License-Identifier: MIT\nint main() {}\nLicense here\n",
        "a/y.h": "/* SPDX-License-Identifier: GPL-2.0 */\n#define A 1\n",
        "b/z.c": " * SPDX-License-Identifier: (GPL-2.0 OR MIT)\n\n\n\n",
        "b/w.txt": "License text\n",
        "b/v.c": "no licence\n",
    }
    for rel, body in files.items():
        p = tmp_path / rel
        p.parent.mkdir(parents=True, exist_ok=True)
        p.write_text(body)
    return files


def test_tree_queries(spark, tmp_path):
    files = _tree(tmp_path)
    tree = read_tree(spark, str(tmp_path))
    assert tree.count() == 5
    src = read_tree(spark, str(tmp_path), glob="*.{c,h}")
    assert src.count() == 4
    assert rows(corpus.count_by_ext(tree)) == [("c", 3), ("h", 1)]
    tb = corpus.total_bytes(tree).collect()[0]
    assert tb.total_bytes == sum(len(v.encode()) for v in files.values())
    lon = corpus.longest(tree, 2).collect()
    assert [(os.path.basename(r.path), r.lines) for r in lon] == [("z.c", 4), ("x.c", 3)]
    sha = {os.path.basename(r.path): r.sha1 for r in corpus.longest_sha1(tree, 2).collect()}
    assert sha["z.c"] == hashlib.sha1(files["b/z.c"].encode()).hexdigest()
    assert corpus.grep_count(tree, "License").collect()[0].n_files == 4   # SPDX lines count too
    assert corpus.grep_count(tree, "License text").collect()[0].n_files == 1
    lic = {os.path.basename(r.path): r.license for r in corpus.licenses(tree).collect()}
    assert lic == {"x.c": "MIT", "z.c": "GPL-2.0"}
    top = corpus.top_license(tree).collect()[0]
    assert (top.license, top.n) == ("GPL-2.0", 1)   # tie 1-1: smaller tag


def test_sinks_round_trip(spark, tmp_path):
    df = spark.createDataFrame([("a", 1), ("b", 2)], "k string, v bigint")
    out = str(tmp_path / "res")
    write_result(df, out)
    back = spark.read.option("header", True).schema("k string, v bigint").csv(out)
    assert rows(back) == [("a", 1), ("b", 2)]
    app = str(tmp_path / "app")
    append_result(df, app)
    append_result(df, app)
    assert spark.read.schema("k string, v bigint").csv(app).count() == 4
