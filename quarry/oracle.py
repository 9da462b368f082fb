"""DuckDB oracle SQL, one statement per registered key.

Only the driver tables exist as views, so every fixture of
:mod:`quarry.sources.fixtures` is restated here as a CTE.  These strings are
an independent formulation used for checking, not an execution path.
"""

from __future__ import annotations

# --------------------------------------------------------------- fixtures

GRAPH = r"""
n as (select cast(floor(1.1e0*count(*)) as bigint) m from customer),
e as (select l_orderkey, string_agg(cast(dst as varchar), ' ' order by dst) ids
      from (select l_orderkey, (l_orderkey*31 + l_partkey*7) % (select m from n) dst from lineitem) group by l_orderkey),
graph_lines as (
  select concat(cast(o_custkey as varchar), ': ', coalesce(ids, '')) line
  from orders left join e on o_orderkey = l_orderkey
  union all select concat(cast(c_custkey as varchar), ': ') from customer where c_custkey not in (select o_custkey from orders)
  union all select concat(cast(c_custkey as varchar), ': 0') from customer where c_custkey % 50 = 0
  union all select '' union all select 'malformed'),
adj as (
  select regexp_extract(line, '^\s*([^:\s]+)\s*:(.*)$', 1) as "user",
         list_filter(regexp_split_to_array(trim(regexp_extract(line, '^\s*([^:\s]+)\s*:(.*)$', 2)), '\s+'),
                     lambda x: x <> '') follows
  from graph_lines where trim(line) <> '' and regexp_matches(line, '^\s*([^:\s]+)\s*:(.*)$'))
"""

FOLLOW_COUNTS = GRAPH + """,
fc as (select "user", cast(sum(len(follows)) as bigint) n_follows from adj group by "user")
"""

FOLLOWER_COUNTS = GRAPH + """,
fr as (select id, cast(sum(w) as bigint) n_followers from (
  select "user" id, 0 w from adj union all select unnest(follows) id, 1 w from adj) group by id)
"""

ORACLE: dict[str, str] = {}

# ----------------------------------------------------------- follow graph

ORACLE["adjacency_parse"] = "with " + GRAPH + """
select "user", array_to_string(follows, ' ') follows_text, cast(len(follows) as bigint) n_follows from adj"""

ORACLE["adjacency_rejects"] = "with " + GRAPH + """
select line from graph_lines where trim(line) <> '' and not regexp_matches(line, '^\\s*([^:\\s]+)\\s*:(.*)$')"""

ORACLE["follow_counts"] = "with " + FOLLOW_COUNTS + "select * from fc"

ORACLE["follow_counts_per_line"] = "with " + GRAPH + """
select "user", cast(len(follows) as bigint) n_follows from adj"""

_FOLLOW_SUMMARY = """
select (select "user" from fc order by n_follows desc, "user" limit 1) top_user,
       cast(coalesce(max(n_follows), 0) as bigint) max_follows,
       round(coalesce(avg(n_follows), 0), 6) avg_follows,
       cast(count(*) filter (where n_follows = 0) as bigint) n_zero
from fc"""

ORACLE["follow_summary"] = "with " + FOLLOW_COUNTS + _FOLLOW_SUMMARY

ORACLE["follow_summary_kv"] = "with " + FOLLOW_COUNTS + ", s as (" + _FOLLOW_SUMMARY + """)
select 'most followed id' metric, top_user value from s
union all select 'most followed', cast(max_follows as varchar) from s
union all select 'average followed', printf('%.6f', avg_follows) from s
union all select 'count follows no-one', cast(n_zero as varchar) from s"""

ORACLE["follower_counts"] = "with " + FOLLOWER_COUNTS + "select * from fr"

ORACLE["follower_summary"] = "with " + FOLLOWER_COUNTS + """
select (select id from fr order by n_followers desc, id limit 1) top_id,
       cast(coalesce(max(n_followers), 0) as bigint) max_followers,
       round(coalesce(avg(n_followers), 0), 6) avg_followers,
       cast(count(*) filter (where n_followers = 0) as bigint) n_zero
from fr"""

ORACLE["follower_summary_owners"] = "with " + GRAPH + """,
m as (select id, count(*) n_followers from (select unnest(follows) id from adj) group by id),
o as (select distinct "user" id from adj)
select (select id from m order by n_followers desc, id limit 1) top_id,
       cast(coalesce((select max(n_followers) from m), 0) as bigint) max_followers,
       round(cast(coalesce((select sum(n_followers) from m), 0) as double) / (select count(*) from o), 6) avg_followers,
       cast((select count(*) from o where id not in (select id from m)) as bigint) n_zero,
       cast((select count(*) from o) as bigint) n_owners"""

ORACLE["distinct_users"] = "with " + GRAPH + """
select cast(count(distinct "user") as bigint) n_users from adj"""

# ----------------------------------------------------------------- sshd log

AUTH = r"""
auth_lines as (
  select concat(strftime(ts, '%b'), ' ', lpad(cast(day(ts) as varchar), 2, ' '), ' ', strftime(ts, '%H:%M:%S'), ' host1 sshd[1]: ',
   case when event_type = 'purchase' then concat('Accepted password for u', cast(user_id as varchar), ' from ')
        when event_type = 'signup' then concat('Failed password for invalid user ',
             case when user_id % 10 = 0 then 'support' when user_id % 10 = 1 then '' else concat('x', cast(user_id % 40 as varchar)) end, ' from ')
        when event_type = 'error' then concat('Failed password for u', cast(user_id as varchar), ' from ')
        when event_type = 'click' then concat('message repeated ', cast(event_id % 5 + 2 as varchar), ' times: [ Failed password for u', cast(user_id as varchar), ' from ')
        else 'Connection closed by ' end,
   '10.0.', cast(user_id % 7 as varchar), '.', cast(event_id % 11 as varchar), ' port ', cast(1024 + event_id % 5000 as varchar), ' ssh2') line
  from events),
p0 as (select line, trim(regexp_extract(line, 'for (.*?) ?from ', 1)) s from auth_lines
       where contains(line, 'Accepted password for') or contains(line, 'Failed password for')),
p as (select substr(line, 1, 6) "day",
        cast(contains(line, 'Accepted password for') as integer) is_ok,
        cast(contains(line, 'Failed password for invalid user') as integer) is_invalid,
        case when contains(s, 'invalid user')
             then nullif(string_split_regex(trim(regexp_extract(s, 'invalid user(.*)$', 1)), '\s+')[1], '')
             else string_split_regex(s, '\s+')[-1] end account,
        case when contains(line, 'Failed password for invalid user')
             then trim(regexp_extract(line, 'invalid user (.*?) ?from ', 1)) end invalid_account,
        regexp_extract(line, 'from (\S+) port', 1) ip,
        cast(case when contains(line, 'Accepted password for') then 1
             when contains(line, 'message repeated') and regexp_extract(line, 'message repeated (\d+) time', 1) <> ''
             then cast(regexp_extract(line, 'message repeated (\d+) time', 1) as bigint) else 1 end as bigint) w
      from p0)
"""

ORACLE["auth_parse"] = "with " + AUTH + "select * from p"

ORACLE["auth_filtered"] = "with " + AUTH + """
select cast(count(*) filter (where contains(line, 'Accepted password for')) as bigint) n_accepted,
       cast(count(*) filter (where contains(line, 'Failed password for')) as bigint) n_failed,
       cast(count(*) filter (where contains(line, 'Failed password for invalid user')) as bigint) n_failed_invalid
from auth_lines"""

ORACLE["auth_union_attempts"] = "with " + AUTH + """
select account, w, is_ok from p where is_ok = 1 union all select account, w, is_ok from p where is_ok = 0"""

ORACLE["auth_attempts_by_account"] = "with " + AUTH + """
select account, cast(sum(w) as bigint) attempts from p group by account"""

ORACLE["auth_success_by_account"] = "with " + AUTH + """
select account, cast(sum(w) as bigint) successes from p where is_ok = 1 group by account"""

ORACLE["auth_failed_by_account"] = "with " + AUTH + """
select account, cast(sum(w) as bigint) failures from p where is_ok = 0 group by account"""

_RATE = """,
ok as (select account, cast(sum(w) as bigint) successes from p where is_ok = 1 group by account),
tot as (select account, cast(sum(w) as bigint) attempts from p group by account),
sr as (select ok.account, successes, attempts, successes / attempts rate
       from ok left join tot on ok.account is not distinct from tot.account)
"""

ORACLE["auth_success_rate"] = "with " + AUTH + _RATE + """
select account, successes, attempts, round(rate, 6) rate from sr"""

ORACLE["auth_best_success_rate"] = "with " + AUTH + _RATE + """
select account, round(rate, 6) rate from sr where rate = (select max(rate) from sr)"""

ORACLE["auth_failed_by_ip"] = "with " + AUTH + """
select ip, cast(sum(w) as bigint) failures from p where is_ok = 0 group by ip"""

ORACLE["auth_failed_by_invalid"] = "with " + AUTH + """
select invalid_account, cast(sum(w) as bigint) failures from p where is_invalid = 1 group by invalid_account"""

ORACLE["auth_attempts_by_day"] = "with " + AUTH + """
select "day", cast(sum(w) as bigint) attempts from p group by "day" """

ORACLE["auth_top_account"] = "with " + AUTH + """
select account, cast(sum(w) as bigint) attempts from p group by account
order by attempts desc, account asc nulls last limit 1"""

ORACLE["auth_top_success"] = "with " + AUTH + """
select account, cast(sum(w) as bigint) successes from p where is_ok = 1 group by account
order by successes desc, account asc nulls last limit 1"""

ORACLE["auth_top_failed"] = "with " + AUTH + """
select account, cast(sum(w) as bigint) failures from p where is_ok = 0 group by account
order by failures desc, account asc nulls last limit 1"""

ORACLE["auth_top3_ips"] = "with " + AUTH + """
select ip, cast(sum(w) as bigint) failures from p where is_ok = 0 group by ip
order by failures desc, ip asc nulls last limit 3"""

ORACLE["auth_top10_invalid"] = "with " + AUTH + """
select invalid_account, cast(sum(w) as bigint) failures from p where is_invalid = 1 group by invalid_account
order by failures desc, invalid_account asc nulls last limit 10"""

ORACLE["auth_day_extremes"] = "with " + AUTH + """,
d as (select "day", cast(sum(w) as bigint) attempts from p group by "day")
select (select "day" from d order by attempts desc, "day" limit 1) most_day,
       (select max(attempts) from d) most_attempts,
       (select "day" from d order by attempts asc, "day" limit 1) least_day,
       (select min(attempts) from d) least_attempts"""

# -------------------------------------------------------------- HyperLogLog

TOKENS = r"""
id_lines as (select concat_ws(' ', l_orderkey, l_partkey) line from lineitem),
tk0 as (select unnest(range(len(t))) pos, unnest(t) tok
        from (select list_filter(string_split_regex(trim(line), '\s+'), lambda x: x <> '') t from id_lines)),
tk as (select cast(pos as integer) pos, try_cast(tok as bigint) token from tk0),
tok as (select pos, token from tk where token is not null),
hk as (select pos, token,
        xor(xor(xor(('0x' || substr(md5(concat('42:0:', token & 65535)), 1, 8))::BIGINT,
                    ('0x' || substr(md5(concat('42:1:', (token >> 16) & 65535)), 1, 8))::BIGINT),
                    ('0x' || substr(md5(concat('42:2:', (token >> 32) & 65535)), 1, 8))::BIGINT),
                    ('0x' || substr(md5(concat('42:3:', (token >> 48) & 65535)), 1, 8))::BIGINT) h
       from tok),
upd as (select pos,
        ((token::HUGEINT * 14439580439569971107::HUGEINT) % 18446744073709551616::HUGEINT
          // 18014398509481984::HUGEINT)::BIGINT j,
        cast(case when h = 0 then 33 else 33 - length(bin(h)) end as bigint) rho
       from hk)
"""

ORACLE["id_tokens"] = "with " + TOKENS + "select pos, token from tk"

ORACLE["tabulation_hash"] = "with " + TOKENS + "select token, h from hk"

ORACLE["hll_registers"] = "with " + TOKENS + "select j, max(rho) rho from upd group by j"

ORACLE["hll_merge"] = "with " + TOKENS + """,
a as (select j, max(rho) rho from upd where pos = 0 group by j),
b as (select j, max(rho) rho from upd where pos = 1 group by j)
select j, max(rho) rho from (select * from a union all select * from b) group by j"""

ORACLE["hll_estimate"] = "with " + TOKENS + """,
r as (select j, max(rho) rho from upd group by j),
s as (select count(*) n_set, coalesce(sum(pow(2.0, -rho)), 0) zsum from r),
e as (select n_set, 1024 - n_set v, (0.7213e0 / (1 + 1.079e0 / 1024)) * 1024 * 1024 / (zsum + (1024 - n_set)) e_raw from s),
f as (select n_set, case when e_raw <= 2.5e0 * 1024 and v > 0 then 1024 * ln(1024.0e0 / v)
                         when e_raw > 4294967296.0e0 / 30 then -4294967296.0e0 * ln(1 - e_raw / 4294967296.0e0)
                         else e_raw end est from e)
select cast(1024 as bigint) m, cast(n_set as bigint) n_set, round(est, 6) estimate, cast(trunc(est) as bigint) estimate_int from f"""

ORACLE["approx_distinct"] = "with " + TOKENS + """,
n as (select cast(count(distinct token) as bigint) exact from tok)
select s sketch, exact, true within_bound from n, (select unnest(['hllpp', 'datasketch']) s)"""

# ------------------------------------------------------------------ geo 1-NN

GEO = """
gp as (select c_custkey id, c_name location,
              (('0x' || substr(md5(concat('point:lat:', c_custkey)), 1, 8))::BIGINT % 18001) / cast(100 as double) - 90 latitude,
              (('0x' || substr(md5(concat('point:lon:', c_custkey)), 1, 8))::BIGINT % 36000) / cast(100 as double) - 180 longitude
       from customer),
gq as (select s_suppkey qid,
              (('0x' || substr(md5(concat('query:lat:', s_suppkey)), 1, 8))::BIGINT % 18001) / cast(100 as double) - 90 latitude,
              (('0x' || substr(md5(concat('query:lon:', s_suppkey)), 1, 8))::BIGINT % 36000) / cast(100 as double) - 180 longitude
       from supplier)
"""

ORACLE["geo_points"] = "with " + GEO + """
select id, location, round(radians(latitude), 9) lat_rad, round(radians(longitude), 9) lon_rad from gp"""

ORACLE["geo_nearest"] = "with " + GEO + """,
pr as (select gq.qid, gp.id, gp.location,
         2 * asin(sqrt(least(1.0, pow(sin((radians(gp.latitude) - radians(gq.latitude)) / 2), 2)
           + cos(radians(gq.latitude)) * cos(radians(gp.latitude)) * pow(sin((radians(gp.longitude) - radians(gq.longitude)) / 2), 2)))) dist
       from gq cross join gp)
select qid, id, location, round(dist, 6) dist from pr
qualify row_number() over (partition by qid order by round(dist, 9), id) = 1"""

# ------------------------------------------------------- embeddings, cosine

VEC = """
vl as (select concat('w', cast(vec_id as varchar), ' ',
          array_to_string(list_transform(embedding, lambda x: cast(cast(round(cast(x as double) * 1e6) as bigint) as varchar)), ' ')) line
       from embeddings),
pv as (select split_part(line, ' ', 1) word, list_transform(string_split(line, ' ')[2:], lambda x: cast(x as double)) vec from vl),
ev as (select vec_id idx, concat('w', cast(vec_id as varchar)) word, cast(embedding as double[]) v from embeddings),
un as (select idx, word, list_transform(v, lambda x: x / sqrt(list_inner_product(v, v))) u from ev where list_inner_product(v, v) > 0),
qw as (select doc_id qid, concat('w', cast(doc_id as varchar)) word from labels),
q as (select qw.qid, un.idx self_idx, un.u from qw join un on qw.word = un.word)
"""

ORACLE["vectors_parse"] = "with " + VEC + """
select word, cast(len(vec) as integer) dim, cast(list_sum(vec) as bigint) vsum from pv"""

ORACLE["vectors_normalize"] = "with " + VEC + """,
nv as (select word, sqrt(list_inner_product(vec, vec)) n, vec from pv),
uv as (select word, n, vec, list_transform(vec, lambda x: x / n) u from nv where n > 0)
select word, cast(list_inner_product(vec, vec) as bigint) sq_norm, round(u[1], 6) first_unit,
       round(sqrt(list_inner_product(u, u)), 6) unit_norm from uv"""

ORACLE["query_vectors"] = "with " + VEC + """
select qw.qid, qw.word, ev.idx, cast(len(ev.v) as integer) dim from qw join ev on qw.word = ev.word"""

ORACLE["query_words_unknown"] = "with " + VEC + """
select qid, word from qw where word not in (select word from ev)"""

ORACLE["cosine_top3"] = "with " + VEC + """,
sc as (select q.qid, x.idx, list_inner_product(q.u, x.u) sim from q join un x on x.idx <> q.self_idx)
select qid, cast(rank as integer) rank, idx, round(sim, 6) sim from (
  select *, row_number() over (partition by qid order by round(sim, 6) desc, idx) rank from sc) where rank <= 3"""

# ------------------------------------------------------------ Euclidean 1-NN

PUBS = """
pb as (select p_partkey id, concat(p_name, ' ', p_partkey) name, cast((p_partkey * 7919) % 700000 as double) easting,
              cast((p_partkey * 104729) % 1300000 as double) northing from part),
pq as (select s_suppkey qid, cast((s_suppkey * 15485863 + 355) % 700000 as double) easting,
              cast((s_suppkey * 32452843 + 111) % 1300000 as double) northing from supplier),
nn as (select qid, id, name, sqrt(d2) dist from (
         select pq.qid, pb.id, pb.name,
                (pb.easting - pq.easting) * (pb.easting - pq.easting) + (pb.northing - pq.northing) * (pb.northing - pq.northing) d2
         from pq cross join pb)
       qualify row_number() over (partition by qid order by d2, id) = 1),
lq as (select s_suppkey qid, easting + 0.25 easting, northing + 0.25 northing,
              case when s_suppkey % 10 = 0 then 'wrong' else name end label
       from supplier join pb on s_suppkey = id),
fd as (select qid, name from (
         select lq.qid, pb.name, pb.id,
                (pb.easting - lq.easting) * (pb.easting - lq.easting) + (pb.northing - lq.northing) * (pb.northing - lq.northing) d2
         from lq cross join pb)
       qualify row_number() over (partition by qid order by d2, id) = 1)
"""

ORACLE["l2_nearest"] = "with " + PUBS + "select qid, id, name, dist from nn"
ORACLE["l2_nearest_expanded"] = ORACLE["l2_nearest"]
ORACLE["l2_nearest_batched"] = ORACLE["l2_nearest"]

ORACLE["nn_label_mismatches"] = "with " + PUBS + """
select fd.qid, fd.name found, lq.label expected from fd join lq on fd.qid = lq.qid where fd.name is distinct from lq.label"""

ORACLE["nn_label_error_count"] = "with " + PUBS + """
select cast(count(*) as bigint) n_queries, cast(count(*) filter (where fd.name is distinct from lq.label) as bigint) n_errors
from fd join lq on fd.qid = lq.qid"""

ORACLE["embedding_l2_nearest"] = "with " + VEC + """,
pr as (select qw.qid, x.idx, list_distance(e.v, x.v) d
       from qw join ev e on qw.word = e.word join ev x on x.idx <> e.idx)
select qid, idx, round(d, 6) dist from pr qualify row_number() over (partition by qid order by d, idx) = 1"""

# ---------------------------------------------------------------------- LSH

LSH = VEC + """,
hp as (select p.range plane, d.range dim,
         round(sqrt(-2 * ln((('0x' || substr(md5(concat('1234:', p.range, ':', d.range, ':a')), 1, 8))::BIGINT::DOUBLE + 1) / 4294967297e0))
           * cos(2 * pi() * (('0x' || substr(md5(concat('1234:', p.range, ':', d.range, ':b')), 1, 8))::BIGINT::DOUBLE + 1) / 4294967297e0), 9) g
       from range(48) p cross join range((select max(len(embedding)) from embeddings)) d),
pm as (select plane, list(g order by dim) gv from hp group by plane),
sg as (select ev.idx, string_agg(case when list_inner_product(ev.v, pm.gv) > 0 then '1' else '0' end, '' order by pm.plane) sig
       from ev cross join pm group by ev.idx),
pos as (select t.range tbl, j.range slot, (('0x' || substr(md5(concat('1234:h:', t.range, ':', j.range)), 1, 8))::BIGINT % 48) p
        from range(12) t cross join range(7) j),
bk as (select sg.idx, cast(pos.tbl as integer) tbl, string_agg(substr(sig, cast(pos.p as integer) + 1, 1), '' order by pos.slot) bucket
       from sg cross join pos group by sg.idx, pos.tbl)
"""

ORACLE["lsh_signature"] = "with " + LSH + "select idx, sig from sg"

ORACLE["lsh_buckets"] = "with " + LSH + "select idx, tbl, bucket from bk"

ORACLE["lsh_bucket_sizes"] = "with " + LSH + "select tbl, bucket, cast(count(*) as bigint) n from bk group by tbl, bucket"

# A query (qid, v, n its length) visits ten buckets of each table: its own and those
# over the planes it is nearest to; a plane drawn twice for a table flips once.
PROBES = """,
dp as (select qv.qid, pm.plane, list_inner_product(qv.v, pm.gv) / qv.n d from qv cross join pm),
tp as (select tbl, p, min(slot) slot from pos group by tbl, p),
mg as (select dp.qid, tp.tbl, tp.p, d, row_number() over (partition by dp.qid, tp.tbl order by abs(d), tp.slot) - 1 pl
       from tp join dp on dp.plane = tp.p),
nb as (select tbl, cast(count(*) as integer) m from tp group by tbl),
mk as (select tbl, unnest(range(1 << m)) mask from nb),
co as (select mg.qid, mg.tbl, mk.mask, sum(case when (mk.mask >> mg.pl) & 1 = 1 then d * d else 0 end) cost
       from mg join mk on mk.tbl = mg.tbl group by mg.qid, mg.tbl, mk.mask),
pr as (select qid, tbl, mask from co qualify row_number() over (partition by qid, tbl order by cost, mask) <= 10),
qb as (select pr.qid, cast(pr.tbl as integer) tbl, pr.mask,
              string_agg(case when (mg.d > 0) <> ((pr.mask >> mg.pl) & 1 = 1) then '1' else '0' end, '' order by pos.slot) bucket
       from pr join pos on pos.tbl = pr.tbl join mg on mg.qid = pr.qid and mg.tbl = pr.tbl and mg.p = pos.p
       group by pr.qid, pr.tbl, pr.mask),
cand as (select distinct qb.qid, bk.idx from qb join bk on bk.tbl = qb.tbl and bk.bucket = qb.bucket join qv on qv.qid = qb.qid
         where bk.idx is distinct from qv.self_idx),
sc as (select cand.qid, cand.idx, list_inner_product(qv.v, un.u) / qv.n sim
       from cand join qv on qv.qid = cand.qid join un on un.idx = cand.idx)
select qid, cast(rank as integer) rank, idx, round(sim, 6) sim from (
  select *, row_number() over (partition by qid order by round(sim, 6) desc, idx) rank from sc) where rank <= 3"""

ORACLE["lsh_top3"] = "with " + LSH + """,
qv as (select q.qid, q.self_idx, ev.v, sqrt(list_inner_product(ev.v, ev.v)) n from q join ev on ev.idx = q.self_idx)""" + PROBES

ORACLE["lsh_top3_by_vector"] = "with " + LSH + """,
mv as (select qw.qid, list_transform(ev.v, lambda x: x + 0.05::DOUBLE) v from qw join ev on qw.word = ev.word),
qv as (select qid, null::BIGINT self_idx, v, sqrt(list_inner_product(v, v)) n from mv)""" + PROBES

# --------------------------------------------------------------- source tree

SRC = r"""
sf as (select concat('src/', source, '/', doc_id, case when doc_id % 3 = 0 then '.c' when doc_id % 3 = 1 then '.h' else '.txt' end) path,
         concat(case when doc_id % 5 = 0 then '' when doc_id % 5 = 1 then concat('// SPDX-License-Identifier: MIT', chr(10))
                     when doc_id % 5 = 2 then concat('/* SPDX-License-Identifier: GPL-2.0 */', chr(10))
                     when doc_id % 5 = 3 then concat(' * SPDX-License-Identifier: (GPL-2.0 OR MIT)', chr(10))
                     else concat('// SPDX-License-Identifier: Apache-2.0', chr(10)) end, text) content
       from documents),
fe as (select path, content, case when contains(string_split(path, '/')[-1], '.') then string_split(string_split(path, '/')[-1], '.')[-1] else '' end ext from sf),
lc as (select path, cast(length(content) - length(replace(content, chr(10), '')) as bigint) lines, content from fe where ext in ('c', 'h')),
li as (select path, nullif(regexp_extract(content, 'SPDX-License-Identifier:\s*\(?([^\s)*]+)', 1), '') license from fe where ext = 'c')
"""

ORACLE["corpus_count_by_ext"] = "with " + SRC + """
select ext, cast(count(*) as bigint) n_files from fe where ext in ('c', 'h') group by ext"""

ORACLE["corpus_total_bytes"] = "with " + SRC + """
select cast(count(*) as bigint) n_files, cast(coalesce(sum(strlen(content)), 0) as bigint) total_bytes from sf"""

ORACLE["corpus_longest"] = "with " + SRC + """
select path, lines from lc order by lines desc, path limit 10"""

ORACLE["corpus_longest_sha1"] = "with " + SRC + """
select path, sha1(content) sha1 from (select * from lc order by lines desc, path limit 10)"""

ORACLE["corpus_grep_count"] = "with " + SRC + """
select 'License' phrase, cast(count(*) as bigint) n_files from sf where contains(content, 'License')"""

ORACLE["corpus_licenses"] = "with " + SRC + "select path, license from li where license is not null"

ORACLE["corpus_license_counts"] = "with " + SRC + """
select license, cast(count(*) as bigint) n from li where license is not null group by license"""

ORACLE["corpus_top_license"] = "with " + SRC + """
select license, cast(count(*) as bigint) n from li where license is not null group by license order by n desc, license limit 1"""

# ----------------------------------------------------------------- streaming
# A stream that has consumed all its input equals the batch job.

ORACLE["stream_geo_nearest"] = ORACLE["geo_nearest"]
ORACLE["stream_hll_registers"] = ORACLE["hll_registers"]

# ------------------------------------------- files, appends, indexes, summaries

ORACLE["distinct_users_bitmap"] = ORACLE["distinct_users"]

ORACLE["auth_tallies"] = "with " + AUTH + """,
k as (select 'account' kind, account "key", * from p union all select 'ip', ip, * from p union all select 'day', "day", * from p
      union all select 'invalid_account', invalid_account, * from p where is_invalid = 1)
select kind, "key", cast(sum(w) as bigint) attempts, cast(coalesce(sum(w) filter (where is_ok = 1), 0) as bigint) successes,
       cast(coalesce(sum(w) filter (where is_ok = 0), 0) as bigint) failures from k group by kind, "key" """

ORACLE["auth_frequent_accounts"] = "with " + AUTH + """
select account, cast(sum(w) as bigint) attempts from p where account is not null group by account
having sum(w) > 0.005 * (select sum(w) from p where account is not null)"""

ORACLE["auth_days_appended"] = ORACLE["auth_attempts_by_day"]

ORACLE["distinct_tokens_by_place"] = "with " + TOKENS + """
select pos, cast(count(distinct token) as bigint) n from tok group by pos
union all select null, cast(count(distinct token) as bigint) from tok"""

GEO_FILES = GEO + """,
fp as (select row_number() over (order by id) - 1 id, location, case when id % 97 <> 0 then latitude end latitude, longitude from gp),
fq as (select row_number() over (order by qid) - 1 qid, case when qid % 50 <> 0 then latitude end latitude, longitude from gq)
"""

ORACLE["geo_nearest_files"] = "with " + GEO_FILES + """,
pr as (select fq.qid, fp.id, fp.location,
         2 * asin(sqrt(least(1.0, pow(sin((radians(fp.latitude) - radians(fq.latitude)) / 2), 2)
           + cos(radians(fq.latitude)) * cos(radians(fp.latitude)) * pow(sin((radians(fp.longitude) - radians(fq.longitude)) / 2), 2)))) dist
       from fq cross join fp where fq.latitude is not null and fp.latitude is not null)
select qid, id, location, round(dist, 6) dist from pr
qualify row_number() over (partition by qid order by round(dist, 9), id) = 1
union all select qid, null, null, null from fq where latitude is null"""

ORACLE["geo_file_rejects"] = "with " + GEO_FILES + "select id, location, 'unknown' latitude from fp where latitude is null"

ORACLE["corpus_tree_packed"] = "with " + SRC + """
select ext, cast(count(*) as bigint) n_files, cast(sum(strlen(coalesce(content, ''))) as bigint) n_bytes,
       cast(sum(length(content) - length(replace(content, chr(10), ''))) as bigint) n_lines from fe group by ext"""

ORACLE["corpus_phrase_counts"] = "with " + SRC + """,
ph as (select distinct substr(text, 1, 30) phrase from benchmark where length(text) >= 3
       union select unnest(['License', 'SPDX-License-Identifier: MIT', 'in no file']))
select phrase, cast((select count(*) from sf where contains(content, phrase)) as bigint) n_files from ph"""
