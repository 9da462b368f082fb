"""Registered queries: key -> callable(spark, sf_dir) -> DataFrame.

Each key reads whole driver tables (through :mod:`quarry.sources.fixtures`)
and runs one operator of the inventory.  The DuckDB twin of every key is in
:mod:`quarry.oracle`.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.functions import vectors as vfn
from quarry.functions.text import newline_count
from quarry.operators import authlog, corpus, distinct, follows, heavy, lsh, neighbours, phrase_index, sketch, spatial
from quarry.sources import fixtures as fx
from quarry.sources import files, sinks, text
from quarry.session import scratch_path
from quarry.streaming import incremental

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}


def query(key: str):
    def deco(fn):
        REGISTRY[key] = fn
        return fn
    return deco


# ---------------------------------------------------------------- follow graph

def _adj(spark, sf):
    return text.parse_adjacency(fx.graph_lines(spark, sf))


@query("adjacency_parse")
def q_adjacency_parse(spark, sf):
    return _adj(spark, sf).select(
        "user", F.array_join("follows", " ").alias("follows_text"),
        F.size("follows").cast("bigint").alias("n_follows"))


@query("adjacency_rejects")
def q_adjacency_rejects(spark, sf):
    return text.adjacency_rejects(fx.graph_lines(spark, sf))


@query("follow_counts")
def q_follow_counts(spark, sf):
    return follows.follow_counts(_adj(spark, sf))


@query("follow_counts_per_line")
def q_follow_counts_per_line(spark, sf):
    return follows.follow_counts_per_line(_adj(spark, sf))


@query("follow_summary")
def q_follow_summary(spark, sf):
    return follows.follow_summary(_adj(spark, sf))


@query("follow_summary_kv")
def q_follow_summary_kv(spark, sf):
    return follows.summary_as_kv(
        follows.follow_summary(_adj(spark, sf)),
        ("most followed id", "most followed", "average followed", "count follows no-one"))


@query("follower_counts")
def q_follower_counts(spark, sf):
    return follows.follower_counts(_adj(spark, sf))


@query("follower_summary")
def q_follower_summary(spark, sf):
    return follows.follower_summary(_adj(spark, sf))


@query("follower_summary_owners")
def q_follower_summary_owners(spark, sf):
    return follows.follower_summary_owners(_adj(spark, sf))


@query("distinct_users")
def q_distinct_users(spark, sf):
    return follows.distinct_users(_adj(spark, sf))


@query("distinct_users_bitmap")
def q_distinct_users_bitmap(spark, sf):
    return distinct.count_texts(_adj(spark, sf), "user").withColumnRenamed("n", "n_users")


# ---------------------------------------------------------------- sshd log

def _auth(spark, sf):
    return authlog.parse(fx.auth_lines(spark, sf))


@query("auth_parse")
def q_auth_parse(spark, sf):
    return _auth(spark, sf)


@query("auth_filtered")
def q_auth_filtered(spark, sf):
    return authlog.filter_counts(fx.auth_lines(spark, sf))


@query("auth_union_attempts")
def q_auth_union_attempts(spark, sf):
    return authlog.union_attempts(_auth(spark, sf))


@query("auth_attempts_by_account")
def q_auth_attempts_by_account(spark, sf):
    return authlog.attempts_by_account(_auth(spark, sf))


@query("auth_success_by_account")
def q_auth_success_by_account(spark, sf):
    return authlog.successes_by_account(_auth(spark, sf))


@query("auth_failed_by_account")
def q_auth_failed_by_account(spark, sf):
    return authlog.failures_by_account(_auth(spark, sf))


@query("auth_success_rate")
def q_auth_success_rate(spark, sf):
    return authlog.success_rate(_auth(spark, sf)).withColumn("rate", F.round("rate", 6))


@query("auth_best_success_rate")
def q_auth_best_success_rate(spark, sf):
    return authlog.best_success_rate(_auth(spark, sf))


@query("auth_failed_by_ip")
def q_auth_failed_by_ip(spark, sf):
    return authlog.failures_by_ip(_auth(spark, sf))


@query("auth_failed_by_invalid")
def q_auth_failed_by_invalid(spark, sf):
    return authlog.failures_by_invalid(_auth(spark, sf))


@query("auth_attempts_by_day")
def q_auth_attempts_by_day(spark, sf):
    return authlog.attempts_by_day(_auth(spark, sf))


@query("auth_top_account")
def q_auth_top_account(spark, sf):
    return authlog.top_k(authlog.attempts_by_account(_auth(spark, sf)), "account", "attempts", 1)


@query("auth_top_success")
def q_auth_top_success(spark, sf):
    return authlog.top_k(authlog.successes_by_account(_auth(spark, sf)), "account", "successes", 1)


@query("auth_top_failed")
def q_auth_top_failed(spark, sf):
    return authlog.top_k(authlog.failures_by_account(_auth(spark, sf)), "account", "failures", 1)


@query("auth_top3_ips")
def q_auth_top3_ips(spark, sf):
    return authlog.top_k(authlog.failures_by_ip(_auth(spark, sf)), "ip", "failures", 3)


@query("auth_top10_invalid")
def q_auth_top10_invalid(spark, sf):
    return authlog.top_k(authlog.failures_by_invalid(_auth(spark, sf)), "invalid_account", "failures", 10)


@query("auth_day_extremes")
def q_auth_day_extremes(spark, sf):
    return authlog.day_extremes(_auth(spark, sf))


@query("auth_tallies")
def q_auth_tallies(spark, sf):
    return authlog.tallies(_auth(spark, sf))


@query("auth_frequent_accounts")
def q_auth_frequent_accounts(spark, sf):
    found = heavy.frequent(_auth(spark, sf), "account", "w", 0.005)
    return found.select(F.col("key").alias("account"), F.col("weight").alias("attempts"))


@query("auth_days_appended")
def q_auth_days_appended(spark, sf):
    """Day tallies appended in three batches; one is replayed, one was staged and never committed."""
    days = authlog.attempts_by_day(_auth(spark, sf)).withColumn("part", F.pmod(F.xxhash64("day"), F.lit(3)))
    out = scratch_path(spark, "appended-days")
    for part in (0, 1, 2, 1):
        sinks.append_batch(days.where(F.col("part") == part).drop("part"), out, f"part{part}")
    sinks.stage_batch(days.drop("part"), out, "lost")
    return sinks.read_appended(spark, out, "day string, attempts long").drop("batch")


# ---------------------------------------------------------------- HyperLogLog

HLL_M, HLL_SEED = 1024, 42


def _tokens(spark, sf):
    return text.parse_id_tokens(fx.id_lines(spark, sf)).where(F.col("token").isNotNull())


@query("id_tokens")
def q_id_tokens(spark, sf):
    return text.parse_id_tokens(fx.id_lines(spark, sf))


@query("tabulation_hash")
def q_tabulation_hash(spark, sf):
    return sketch.hashed_keys(_tokens(spark, sf), "token", HLL_SEED)


@query("hll_registers")
def q_hll_registers(spark, sf):
    return sketch.build(_tokens(spark, sf), "token", HLL_M, HLL_SEED).registers


@query("hll_merge")
def q_hll_merge(spark, sf):
    by_place = sketch.build_by(_tokens(spark, sf), "token", "pos", HLL_M, HLL_SEED)
    return sketch.merge_all(by_place, HLL_M, HLL_SEED).registers


@query("hll_estimate")
def q_hll_estimate(spark, sf):
    return sketch.estimate(sketch.build(_tokens(spark, sf), "token", HLL_M, HLL_SEED))


@query("approx_distinct")
def q_approx_distinct(spark, sf):
    tokens = _tokens(spark, sf)
    exact = distinct.count(distinct.bitmaps(tokens, F.col("token"))).select("n").scalar()
    rows = sketch.approx_distinct(tokens, "token").withColumn("exact", exact)
    return rows.select("sketch", "exact", F.col("exact").between(F.col("low"), F.col("high")).alias("within_bound"))


@query("distinct_tokens_by_place")
def q_distinct_tokens_by_place(spark, sf):
    """Exact distinct keys at each place of a line, and at all of them from the same bitmaps."""
    maps = distinct.bitmaps(_tokens(spark, sf), F.col("token"), "pos")
    every = distinct.count(distinct.rolled_up(maps)).select(F.lit(None).cast("int").alias("pos"), "n")
    return distinct.count(maps, "pos").unionByName(every)


# ---------------------------------------------------------------- geo 1-NN

@query("geo_points")
def q_geo_points(spark, sf):
    g = fx.geo_points(spark, sf)
    return g.select("id", "location", F.round(F.radians("latitude"), 9).alias("lat_rad"),
                    F.round(F.radians("longitude"), 9).alias("lon_rad"))


@query("geo_nearest")
def q_geo_nearest(spark, sf):
    r = spatial.nearest_on_sphere(fx.geo_points(spark, sf), fx.geo_queries(spark, sf), carry=["location"])
    return r.withColumn("dist", F.round("dist", 6))


def _geo_files(spark, sf):
    return fx.write_geo_files(spark, sf, scratch_path(spark, "geo-files"))


@query("geo_nearest_files")
def q_geo_nearest_files(spark, sf):
    """Points and places from their files; ids are line numbers."""
    points, queries = _geo_files(spark, sf)
    places = text.parse_lat_lon(text.with_line_ids(text.read_lines(spark, queries)))
    r = spatial.nearest_on_sphere(text.read_point_csv(spark, points), places, carry=["location"])
    return r.withColumn("dist", F.round("dist", 6))


@query("geo_file_rejects")
def q_geo_file_rejects(spark, sf):
    return text.point_rejects(spark, _geo_files(spark, sf)[0]).select("id", "location", "latitude")


# ------------------------------------------------------ embeddings, cosine

def _vectors(spark, sf):
    return fx.embedding_vectors(spark, sf)


def _query_vectors(spark, sf):
    return neighbours.query_vectors(fx.query_words(spark, sf), _vectors(spark, sf))


@query("vectors_parse")
def q_vectors_parse(spark, sf):
    v = text.parse_vectors(fx.vector_lines(spark, sf))
    return v.select("word", F.size("vec").alias("dim"),
                    F.aggregate("vec", F.lit(0.0), lambda s, x: s + x).cast("bigint").alias("vsum"))


@query("vectors_normalize")
def q_vectors_normalize(spark, sf):
    v = text.parse_vectors(fx.vector_lines(spark, sf))
    # The components are integers (x 10^6), so the squared norm is an exact
    # integer; a rounded norm near 10^6 would fall on decimal rounding ties.
    u = v.select("word", vfn.sq_norm(F.col("vec")).alias("sq"), vfn.normalize(F.col("vec")).alias("u"))
    return u.select("word", F.col("sq").cast("bigint").alias("sq_norm"),
                    F.round(F.element_at("u", 1), 6).alias("first_unit"),
                    F.round(vfn.norm(F.col("u")), 6).alias("unit_norm"))


@query("query_vectors")
def q_query_vectors(spark, sf):
    return _query_vectors(spark, sf).select("qid", "word", "idx", F.size("vec").alias("dim"))


@query("query_words_unknown")
def q_query_words_unknown(spark, sf):
    return neighbours.unknown_words(fx.query_words(spark, sf), _vectors(spark, sf))


@query("cosine_top3")
def q_cosine_top3(spark, sf):
    return neighbours.cosine_topk(_query_vectors(spark, sf), _vectors(spark, sf), k=3)


# ------------------------------------------------------------ Euclidean 1-NN

def _l2(spark, sf, form):
    return spatial.nearest_in_plane(fx.pubs(spark, sf), fx.pub_queries(spark, sf), carry=["name"], form=form)


def _labelled(spark, sf):
    """(found, expected) for queries that come with an expected label."""
    q = fx.label_queries(spark, sf)
    found = spatial.nearest_in_plane(fx.pubs(spark, sf), q.drop("label"), carry=["name"])
    return found, q.select("qid", "label")


@query("l2_nearest")
def q_l2_nearest(spark, sf):
    return _l2(spark, sf, "direct")


@query("l2_nearest_expanded")
def q_l2_nearest_expanded(spark, sf):
    return _l2(spark, sf, "expanded")


@query("l2_nearest_batched")
def q_l2_nearest_batched(spark, sf):
    return neighbours.l2_nearest_batched(fx.pubs(spark, sf), fx.pub_queries(spark, sf), carry=["name"])


@query("nn_label_mismatches")
def q_nn_label_mismatches(spark, sf):
    return neighbours.label_mismatches(*_labelled(spark, sf))


@query("nn_label_error_count")
def q_nn_label_error_count(spark, sf):
    return neighbours.label_error_count(*_labelled(spark, sf))


@query("embedding_l2_nearest")
def q_embedding_l2_nearest(spark, sf):
    q = _query_vectors(spark, sf).select("qid", F.col("idx").alias("self"), "vec")
    r = neighbours.l2_nearest_vectors(q, _vectors(spark, sf).select("idx", "vec"))
    return r.select("qid", "idx", F.round("dist", 6).alias("dist"))


# ------------------------------------------------------------------- LSH

LSH_PLANES, LSH_BITS, LSH_TABLES, LSH_SEED = 48, 7, 12, 1234
LSH_PROBES = 10  # buckets visited in each table


def _lsh_params(spark, vectors):
    dim = vectors.agg(F.max(F.size("vec"))).first()[0]
    planes = lsh.plane_matrix(lsh.hyperplanes(spark, LSH_PLANES, dim, LSH_SEED))
    return planes, lsh.bit_positions(LSH_TABLES, LSH_BITS, LSH_PLANES, LSH_SEED)


@query("lsh_signature")
def q_lsh_signature(spark, sf):
    v = _vectors(spark, sf)
    planes, _ = _lsh_params(spark, v)
    return lsh.signatures(v, planes)


@query("lsh_buckets")
def q_lsh_buckets(spark, sf):
    v = _vectors(spark, sf)
    planes, pos = _lsh_params(spark, v)
    return lsh.buckets(lsh.signatures(v, planes), pos)


@query("lsh_bucket_sizes")
def q_lsh_bucket_sizes(spark, sf):
    v = _vectors(spark, sf)
    planes, pos = _lsh_params(spark, v)
    return lsh.bucket_sizes(lsh.buckets(lsh.signatures(v, planes), pos))


@query("lsh_top3")
def q_lsh_top3(spark, sf):
    v = _vectors(spark, sf)
    planes, pos = _lsh_params(spark, v)
    return lsh.lsh_topk(_query_vectors(spark, sf), v, planes, pos, k=3, probes=LSH_PROBES)


@query("lsh_top3_by_vector")
def q_lsh_top3_by_vector(spark, sf):
    v = _vectors(spark, sf)
    planes, pos = _lsh_params(spark, v)
    moved = F.transform("vec", lambda x: x + F.lit(0.05))  # vectors that the index does not hold
    q = _query_vectors(spark, sf).select("qid", F.lit(None).cast("bigint").alias("self"), moved.alias("vec"))
    return lsh.query_by_vector(lsh.fit(v, planes, pos), q, k=3, probes=LSH_PROBES)


# ------------------------------------------------------------- source tree

GREP_PHRASE = "License"


@query("corpus_count_by_ext")
def q_corpus_count_by_ext(spark, sf):
    return corpus.count_by_ext(fx.source_files(spark, sf))


@query("corpus_total_bytes")
def q_corpus_total_bytes(spark, sf):
    return corpus.total_bytes(fx.source_files(spark, sf))


@query("corpus_longest")
def q_corpus_longest(spark, sf):
    return corpus.longest(fx.source_files(spark, sf), 10)


@query("corpus_longest_sha1")
def q_corpus_longest_sha1(spark, sf):
    return corpus.longest_sha1(fx.source_files(spark, sf), 10)


@query("corpus_grep_count")
def q_corpus_grep_count(spark, sf):
    return corpus.grep_count(fx.source_files(spark, sf), GREP_PHRASE)


@query("corpus_licenses")
def q_corpus_licenses(spark, sf):
    return corpus.licenses(fx.source_files(spark, sf))


@query("corpus_license_counts")
def q_corpus_license_counts(spark, sf):
    return corpus.license_counts(fx.source_files(spark, sf))


@query("corpus_top_license")
def q_corpus_top_license(spark, sf):
    return corpus.top_license(fx.source_files(spark, sf))


@query("corpus_tree_packed")
def q_corpus_tree_packed(spark, sf):
    """Files written in two lots; the tree is packed after each, and the packed table counted."""
    src = fx.source_files(spark, sf).select("path", "content", F.pmod(F.xxhash64("path"), F.lit(2)).alias("lot"))
    root = scratch_path(spark, "tree")
    for lot in (0, 1):
        files.write_tree(src.where(F.col("lot") == lot), f"{root}/files")
        files.pack_tree(spark, f"{root}/files", f"{root}/packed")
    tree = corpus.with_ext(files.read_packed(spark, f"{root}/packed"))
    return tree.groupBy("ext").agg(F.count(F.lit(1)).cast("bigint").alias("n_files"), F.sum("length").cast("bigint").alias("n_bytes"),
                                   F.sum(newline_count(F.col("content"))).cast("bigint").alias("n_lines"))


@query("corpus_phrase_counts")
def q_corpus_phrase_counts(spark, sf):
    index = phrase_index.build(fx.source_files(spark, sf))
    return phrase_index.counts(index, fx.search_phrases(spark, sf, GREP_PHRASE, "SPDX-License-Identifier: MIT", "in no file"))


# --------------------------------------------------------------- streaming

@query("stream_geo_nearest")
def q_stream_geo_nearest(spark, sf):
    r = incremental.run_nearest_stream(spark, fx.geo_points(spark, sf), sf, "supplier", fx.as_geo_queries)
    return r.select("qid", "id", "location", F.round("dist", 6).alias("dist"))


@query("stream_hll_registers")
def q_stream_hll_registers(spark, sf):
    return incremental.run_registers_stream(spark, sf, "lineitem", fx.as_id_lines, HLL_M, HLL_SEED).select("j", "rho")
