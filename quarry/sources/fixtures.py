"""Inputs in the reference formats, derived by Spark from the driver tables.

The original input files (follow graph, sshd log, sightings, GloVe, pubs,
source tree) are not available, so each format is produced from the driver
tables.  Every builder reads whole tables; sizes grow with the scale factor.
The DuckDB twins of these builders live in :mod:`quarry.oracle`.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.functions.hashing import md5_u32
from quarry.sources.tables import load

def _const_lines(spark: SparkSession, *values: str) -> DataFrame:
    return spark.range(len(values)).select(
        F.element_at(F.array(*[F.lit(v) for v in values]), (F.col("id") + 1).cast("int")).alias("line"))


def graph_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Follow graph text: one line per order, the ordering customer as owner
    and one followed id per line item of that order.

    Orders without line items and customers without orders own a line without
    ids; some mentioned ids own no line; every 50th customer has a second
    line; one line is blank and one malformed.

    A line is as long as its order, so nothing is ever gathered by owner: an
    owner with a third of all orders has that many short lines.
    """
    customer = load(spark, sf_dir, "customer").select("c_custkey")
    orders = load(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    m = customer.select(F.floor(F.lit(1.1e0) * F.count(F.lit(1))).cast("bigint")).scalar()
    items = load(spark, sf_dir, "lineitem").select(
        "l_orderkey", ((F.col("l_orderkey") * 31 + F.col("l_partkey") * 7) % m).alias("dst"))
    per_order = items.groupBy("l_orderkey").agg(F.array_sort(F.collect_list("dst")).alias("ids"))
    ids = F.array_join(F.transform("ids", lambda x: x.cast("string")), " ")
    with_orders = (orders.join(per_order, orders.o_orderkey == per_order.l_orderkey, "left")
                   .select(F.concat(F.col("o_custkey").cast("string"), F.lit(": "), F.coalesce(ids, F.lit(""))).alias("line")))
    owners = orders.select("o_custkey").distinct()
    without = (customer.join(owners, customer.c_custkey == owners.o_custkey, "left_anti")
               .select(F.concat(F.col("c_custkey").cast("string"), F.lit(": ")).alias("line")))
    second = customer.where(F.col("c_custkey") % 50 == 0).select(
        F.concat(F.col("c_custkey").cast("string"), F.lit(": 0")).alias("line"))
    return (with_orders.unionByName(without).unionByName(second)
            .unionByName(_const_lines(spark, "", "malformed")))


def as_id_lines(lineitem: DataFrame) -> DataFrame:
    return lineitem.select(F.concat_ws(" ", "l_orderkey", "l_partkey").alias("line"))


def id_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_id_lines(load(spark, sf_dir, "lineitem"))


def auth_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """sshd syslog lines, one per event: accepted, failed, invalid user
    (including ``support`` and an empty name), repeated failure, other."""
    ev = load(spark, sf_dir, "events")
    uid = F.col("user_id").cast("string")
    et = F.col("event_type")
    invalid_name = (F.when(F.col("user_id") % 10 == 0, F.lit("support"))
                    .when(F.col("user_id") % 10 == 1, F.lit(""))
                    .otherwise(F.concat(F.lit("x"), (F.col("user_id") % 40).cast("string"))))
    msg = (F.when(et == "purchase", F.concat(F.lit("Accepted password for u"), uid, F.lit(" from ")))
           .when(et == "signup", F.concat(F.lit("Failed password for invalid user "), invalid_name, F.lit(" from ")))
           .when(et == "error", F.concat(F.lit("Failed password for u"), uid, F.lit(" from ")))
           .when(et == "click", F.concat(F.lit("message repeated "), (F.col("event_id") % 5 + 2).cast("string"),
                                         F.lit(" times: [ Failed password for u"), uid, F.lit(" from ")))
           .otherwise(F.lit("Connection closed by ")))
    return ev.select(F.concat(
        F.date_format("ts", "MMM"), F.lit(" "), F.lpad(F.dayofmonth("ts").cast("string"), 2, " "), F.lit(" "),
        F.date_format("ts", "HH:mm:ss"), F.lit(" host1 sshd[1]: "), msg,
        F.lit("10.0."), (F.col("user_id") % 7).cast("string"), F.lit("."), (F.col("event_id") % 11).cast("string"),
        F.lit(" port "), (F.lit(1024) + F.col("event_id") % 5000).cast("string"), F.lit(" ssh2")).alias("line"))


def _coordinates(kind: str, key) -> tuple:
    """(latitude, longitude) in hundredths of a degree, uniform by md5 of the key."""
    return ((md5_u32(kind, "lat", key) % 18001) / F.lit(100.0) - 90,
            (md5_u32(kind, "lon", key) % 36000) / F.lit(100.0) - 180)


def geo_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Named points in degrees: (id, location, latitude, longitude)."""
    c = load(spark, sf_dir, "customer")
    lat, lon = _coordinates("point", F.col("c_custkey"))
    return c.select(F.col("c_custkey").alias("id"), F.col("c_name").alias("location"),
                    lat.alias("latitude"), lon.alias("longitude"))


def as_geo_queries(supplier: DataFrame) -> DataFrame:
    lat, lon = _coordinates("query", F.col("s_suppkey"))
    return supplier.select(F.col("s_suppkey").alias("qid"), lat.alias("latitude"), lon.alias("longitude"))


def geo_queries(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_geo_queries(load(spark, sf_dir, "supplier"))


def vector_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """GloVe-style text: ``w<vec_id>`` then the components times 10^6 as integers."""
    e = load(spark, sf_dir, "embeddings")
    comps = F.transform("embedding", lambda x: F.round(x.cast("double") * 1e6).cast("bigint").cast("string"))
    return e.select(F.concat(F.lit("w"), F.col("vec_id").cast("string"), F.lit(" "),
                             F.array_join(comps, " ")).alias("line"))


def embedding_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(idx, word, vec array<double>) straight from the table."""
    e = load(spark, sf_dir, "embeddings")
    return e.select(F.col("vec_id").alias("idx"), F.concat(F.lit("w"), F.col("vec_id").cast("string")).alias("word"),
                    F.transform("embedding", lambda x: x.cast("double")).alias("vec"))


def query_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Query word list: one word per labelled document, ``w<doc_id>``.

    Documents and embeddings share the id space partly, so some words are
    known and some are not; both sets grow with the data.
    """
    lab = load(spark, sf_dir, "labels")
    return lab.select(F.col("doc_id").alias("qid"), F.concat(F.lit("w"), F.col("doc_id").cast("string")).alias("word"))


def pubs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Named planar points with integer coordinates (squared distances exact)."""
    p = load(spark, sf_dir, "part")
    return p.select(F.col("p_partkey").alias("id"),
                    F.concat_ws(" ", "p_name", F.col("p_partkey").cast("string")).alias("name"),
                    ((F.col("p_partkey") * 7919) % 700000).cast("double").alias("easting"),
                    ((F.col("p_partkey") * 104729) % 1300000).cast("double").alias("northing"))


def pub_queries(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = load(spark, sf_dir, "supplier")
    return s.select(F.col("s_suppkey").alias("qid"),
                    ((F.col("s_suppkey") * 15485863 + 355) % 700000).cast("double").alias("easting"),
                    ((F.col("s_suppkey") * 32452843 + 111) % 1300000).cast("double").alias("northing"))


def label_queries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Queries with an expected label: a point beside the place whose key is
    the supplier's, labelled with that place's name; every tenth label is
    spoiled.  (qid, easting, northing, label)"""
    s = load(spark, sf_dir, "supplier").select("s_suppkey")
    p = pubs(spark, sf_dir)
    near = s.join(p, s.s_suppkey == p.id)
    return near.select(F.col("id").alias("qid"), (F.col("easting") + 0.25).alias("easting"), (F.col("northing") + 0.25).alias("northing"),
                       F.when(F.col("id") % 10 == 0, F.lit("wrong")).otherwise(F.col("name")).alias("label"))


def source_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A source tree as (path, content, length): ``.c``/``.h``/``.txt`` files, with
    SPDX lines in four comment styles (and none) prepended to the text."""
    d = load(spark, sf_dir, "documents")
    ext = (F.when(F.col("doc_id") % 3 == 0, F.lit(".c"))
           .when(F.col("doc_id") % 3 == 1, F.lit(".h")).otherwise(F.lit(".txt")))
    r = F.col("doc_id") % 5
    spdx = (F.when(r == 0, F.lit(""))
            .when(r == 1, F.lit("// SPDX-License-Identifier: MIT\n"))
            .when(r == 2, F.lit("/* SPDX-License-Identifier: GPL-2.0 */\n"))
            .when(r == 3, F.lit(" * SPDX-License-Identifier: (GPL-2.0 OR MIT)\n"))
            .otherwise(F.lit("// SPDX-License-Identifier: Apache-2.0\n")))
    return d.select(F.concat(F.lit("src/"), F.col("source"), F.lit("/"), F.col("doc_id").cast("string"), ext).alias("path"),
                    F.concat(spdx, F.col("text")).alias("content")).withColumn("length", F.octet_length("content").cast("bigint"))


def write_geo_files(spark: SparkSession, sf_dir: str, root: str) -> tuple[str, str]:
    """The points as a header CSV in the order of their ids, every 97th without a
    latitude, and the query places as text, one ``lat lon`` a line, every 50th
    no place.  Returns both paths."""
    points, queries = f"{root}/points", f"{root}/queries"
    p = geo_points(spark, sf_dir).withColumn("latitude", F.when(F.col("id") % 97 == 0, F.lit("unknown")).otherwise(F.col("latitude").cast("string")))
    p.orderBy("id").select("location", "latitude", "longitude").write.option("header", True).csv(points)
    q = geo_queries(spark, sf_dir).orderBy("qid").select(
        F.when(F.col("qid") % 50 == 0, F.lit("somewhere")).otherwise(F.concat_ws(" ", "latitude", "longitude")).alias("value"))
    q.write.text(queries)
    return points, queries


def search_phrases(spark: SparkSession, sf_dir: str, *more: str) -> DataFrame:
    """(phrase): the first 30 characters of every benchmark item, where it has 3, and those given."""
    items = load(spark, sf_dir, "benchmark").select(F.substring("text", 1, 30).alias("phrase")).where("length(phrase) >= 3")
    return items.unionByName(_const_lines(spark, *more).select(F.col("line").alias("phrase"))).distinct()
