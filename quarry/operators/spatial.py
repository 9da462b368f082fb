"""Exact nearest point for every query, on the sphere or in the plane,
through a grid pyramid and equi-joins (no query x point product).

Index (built once per point set):
  * exact copies (same coordinates) collapse to one point, the smallest id,
    which is the one a tie would pick anyway; a location holding a third of
    all rows becomes one row;
  * every point gets a cell of a fine level-0 grid: 32x finer per axis than
    a uniform grid with about two points per cell would be, and finer still,
    by measurement, until no cell has more than ``LEAF`` distinct points, so
    that a dense cluster is resolved whatever the extent around it;
  * a pyramid keeps one representative point per non-empty cell at level 0
    and at every coarser level (each 4x4 cells of the level below); each
    level is an aggregate of the previous one.

Query, stage 1 (upper bound): the 3x3 neighbourhood of the query's cell at
every level is joined with the representatives; the nearest one is a real
point, so its distance ``b`` bounds the answer.  The coarsest level covers
everything, so every query has a bound.

Query, stage 2 (exact): the points nearer than ``b`` lie in the box of radius
``b`` (on the sphere: the cap's latitude band and longitude span, with the
poles and the antimeridian handled).  The search descends the pyramid from
the top, keeping only non-empty cells that meet the box (a join with the
representatives of each level) and expanding them into their 16 children,
down to level 0, where the remaining cells are joined with the points.  Work
follows the points near the query: sparse regions are crossed at coarse
levels, dense ones are resolved at fine levels.  At the finest levels (where
the frontier multiplies) the representatives of the cells reached tighten
the query's bound (a window per
query over its few frontier cells) and cells whose lower-bound distance
exceeds it are dropped (branch and bound), so a query far from a dense
cluster only reaches the cluster's near edge.  The minimum of
``(distance, id)`` per query is taken with partial aggregation.

Every join is on cell keys; AQE broadcasts small sides at runtime and splits
skewed partitions.  Ties go to the smaller point id.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarry.functions.geo import haversine
from quarry.session import scratch_path

POINTS_PER_CELL = 2.0     # density of the uniform grid the resolution starts from
FINER_BITS = 5            # level 0 is 2^5 = 32x finer per axis than that
LEAF = 64                 # most distinct points of a level-0 cell
MAX_BITS = 28             # cells of 2^-28 of the span (7 cm on Earth): where splitting ends
STEP = 2                  # each pyramid level is 2^STEP = 4x coarser per axis
TIGHTEN_BELOW = 2         # branch-and-bound pruning at the finest levels (< this)
_EPS = 1e-9


def _top(bits: int) -> int:
    """Pyramid levels above level 0 until one cell spans ``bits`` bits."""
    return -(-bits // STEP)


@dataclass(frozen=True)
class Geometry:
    kind: str                 # "sphere" or "plane"
    bits: int                 # level 0 has 2^bits rows (latitude bands / y cells)
    ni: int                   # level-0 size along i
    nj: int                   # level-0 size along j
    wrap_j: bool              # longitude wraps
    x0: float = 0.0           # plane origin and cell size
    y0: float = 0.0
    c0: float = 1.0
    form: str = "direct"      # plane distance form

    # ---- cells of level 0 (i = latitude / y, j = longitude / x) ----
    def cells(self, a: Column, b: Column, clamp: bool = True):
        if self.kind == "sphere":
            ci = F.least(F.floor((a + 90.0) / 180.0 * self.ni), F.lit(self.ni - 1))
            cj = F.pmod(F.floor((b + 180.0) / 360.0 * self.nj), F.lit(self.nj))
            return ci.cast("int"), cj.cast("int")
        ci = F.floor((a - self.y0) / self.c0)
        cj = F.floor((b - self.x0) / self.c0)
        if clamp:
            ci = F.least(F.greatest(ci, F.lit(0)), F.lit(self.ni - 1))
            cj = F.least(F.greatest(cj, F.lit(0)), F.lit(self.nj - 1))
        return ci.cast("int"), cj.cast("int")

    # ---- distance between a query (qa, qb) and a point (pa, pb[, pn]) ----
    def dist(self, qa: Column, qb: Column, pa: Column, pb: Column, pn: Column | None = None) -> Column:
        if self.kind == "sphere":
            return haversine(F.radians(qa), F.radians(qb), F.radians(pa), F.radians(pb))
        if self.form == "expanded":
            qn = qa * qa + qb * qb
            d2 = F.greatest(pn - 2.0 * (pa * qa + pb * qb) + qn, F.lit(0.0))
        else:
            d2 = (pa - qa) * (pa - qa) + (pb - qb) * (pb - qb)
        return F.sqrt(d2)

    # ---- lower bound of the distance from (qa, qb) to any point of a cell ----
    def cell_lower_bound(self, qa: Column, qb: Column, ci: Column, cj: Column, s: int) -> Column:
        """Cell (ci, cj) at shift ``s`` covers level-0 rows [ci << s, (ci + 1) << s).
        Plane: distance to the cell rectangle.  Sphere: the larger of the
        latitude gap to the cell's band and, for a query outside its
        longitudes, the distance to the nearer of its two meridians."""
        lo_i, hi_i = F.shiftleft(ci, s).cast("double"), F.shiftleft(ci + 1, s).cast("double")
        if self.kind == "sphere":
            lat_lo = lo_i * (180.0 / self.ni) - 90.0
            lat_hi = hi_i * (180.0 / self.ni) - 90.0
            band = F.radians(F.greatest(lat_lo - qa, qa - lat_hi, F.lit(0.0)))
            west, width = F.shiftleft(cj, s).cast("double") * (360.0 / self.nj) - 180.0, (1 << s) * (360.0 / self.nj)
            ahead = F.pmod(qb - west, F.lit(360.0))          # of the western meridian
            gap = F.least(ahead - width, 360.0 - ahead)      # to the nearer one, from outside
            across = F.asin(F.cos(F.radians(qa)) * F.sin(F.radians(F.least(gap, F.lit(90.0)))))
            return F.greatest(band, F.when(gap > 0, across).otherwise(F.lit(0.0)))
        lo_j, hi_j = F.shiftleft(cj, s).cast("double"), F.shiftleft(cj + 1, s).cast("double")
        dy = F.greatest(self.y0 + lo_i * self.c0 - qa, qa - (self.y0 + hi_i * self.c0), F.lit(0.0))
        dx = F.greatest(self.x0 + lo_j * self.c0 - qb, qb - (self.x0 + hi_j * self.c0), F.lit(0.0))
        return F.sqrt(dx * dx + dy * dy)

    # ---- level-0 index box of radius d around (qa, qb) ----
    def box(self, qa: Column, qb: Column, d: Column):
        """(ilo, ihi, jlo, jhi, jfull); j may run past [0, nj) on the sphere."""
        d = d * (1 + _EPS) + _EPS
        if self.kind == "sphere":
            ddeg = F.degrees(d)
            lat_lo, lat_hi = qa - ddeg, qa + ddeg
            ilo = F.greatest(F.lit(0), F.floor((lat_lo + 90.0) / 180.0 * self.ni))
            ihi = F.least(F.lit(self.ni - 1), F.floor((lat_hi + 90.0) / 180.0 * self.ni))
            ratio = F.sin(d) / F.cos(F.radians(qa))
            dlon = F.degrees(F.asin(F.least(ratio, F.lit(1.0)))) * (1 + _EPS) + _EPS
            jlo = F.floor((qb - dlon + 180.0) / 360.0 * self.nj)
            jhi = F.floor((qb + dlon + 180.0) / 360.0 * self.nj)
            full = ((lat_hi >= 90.0) | (lat_lo <= -90.0) | (d >= math.pi / 2) | (ratio >= 1.0)
                    | (jhi - jlo + 1 >= self.nj))
            return ilo.cast("int"), ihi.cast("int"), jlo.cast("int"), jhi.cast("int"), full
        ilo = F.greatest(F.lit(0), F.floor((qa - d - self.y0) / self.c0))
        ihi = F.least(F.lit(self.ni - 1), F.floor((qa + d - self.y0) / self.c0))
        jlo = F.greatest(F.lit(0), F.floor((qb - d - self.x0) / self.c0))
        jhi = F.least(F.lit(self.nj - 1), F.floor((qb + d - self.x0) / self.c0))
        return ilo.cast("int"), ihi.cast("int"), jlo.cast("int"), jhi.cast("int"), F.lit(False)


@dataclass(frozen=True)
class GridIndex:
    geom: Geometry
    pts: DataFrame    # (_pid, _pa, _pb, _pn, *carry, ci, cj)
    reps: DataFrame   # (ci, cj, r struct<i, a, b, n>, lv): partitioned by level
    carry: tuple
    empty: bool = False


def _on_map(a: str, b: str) -> Column:
    """Both coordinates are there and are numbers."""
    ok = [F.col(c).isNotNull() & ~F.isnan(F.col(c).cast("double")) for c in (a, b)]
    return ok[0] & ok[1]


def _build(points: DataFrame, geom: Geometry, pid: str, a: str, b: str, carry, path: str, empty: bool = False) -> GridIndex:
    """Write the index under ``path`` (a folder of the shared checkpoint
    location) and return it read back from there, so queries plan against
    two small file sources and nothing has lineage back to the point source
    (a lost executor re-reads files instead of re-aggregating).

    The pyramid is one aggregate: every point is listed once per level with
    its cell at that level, and ``groupBy(lv, ci, cj)`` keeps the minimum
    representative.  Partial aggregation collapses the coarse levels inside
    each task, so the shuffle is about one row per level-0 cell.
    """
    spark = points.sparkSession
    carry = tuple(carry)
    # Exact copies collapse to the smallest id (partial aggregation first, so
    # a location holding a third of the rows is one row per task).
    first = F.min(F.struct(F.col(pid).alias("i"), *[F.col(c) for c in carry])).alias("p")
    uniq = (points.where(_on_map(a, b))
            .groupBy(F.col(a).alias("_pa"), F.col(b).alias("_pb")).agg(first))
    ci, cj = geom.cells(F.col("_pa"), F.col("_pb"))
    pts = uniq.select(F.col("p.i").alias("_pid"), "_pa", "_pb",
                      (F.col("_pa") * F.col("_pa") + F.col("_pb") * F.col("_pb")).alias("_pn"),
                      *[F.col(f"p.{c}").alias(c) for c in carry], ci.alias("ci"), cj.alias("cj"))
    pts.write.mode("overwrite").parquet(f"{path}/pts")
    pts = spark.read.schema(pts.schema).parquet(f"{path}/pts")
    rep = F.struct(F.col("_pid").alias("i"), F.col("_pa").alias("a"), F.col("_pb").alias("b"),
                   F.col("_pn").alias("n"))
    levels = F.expr("array(" + ", ".join(
        f"named_struct('lv', {lv}, 'ci', shiftright(ci, {STEP * lv}), 'cj', shiftright(cj, {STEP * lv}))"
        for lv in range(_top(geom.bits) + 1)) + ")")
    reps = (pts.select(rep.alias("r"), F.explode(levels).alias("c"))
            .groupBy(F.col("c.lv").alias("lv"), F.col("c.ci").alias("ci"), F.col("c.cj").alias("cj"))
            .agg(F.min("r").alias("r")))
    reps.write.mode("overwrite").partitionBy("lv").parquet(f"{path}/reps")
    return GridIndex(geom, pts, spark.read.schema(reps.schema).parquet(f"{path}/reps"), carry, empty)


def _fine_enough(points: DataFrame, a: str, b: str, geometry, bits: int) -> int:
    """The number of bits, from ``bits`` on, at which no level-0 cell has more
    than ``LEAF`` distinct points.

    One aggregate where points are spread evenly; a dense cluster in a wide
    extent takes a few more, over ever larger steps."""
    places = points.where(_on_map(a, b)).select(a, b).distinct()
    step = 1
    while bits < MAX_BITS:
        cells = places.select(*[c.alias(n) for n, c in zip(("ci", "cj"), geometry(bits).cells(F.col(a), F.col(b)), strict=True)])
        most = cells.groupBy("ci", "cj").count().agg(F.max("count")).first()[0] or 0
        if most <= LEAF:
            break
        bits = min(MAX_BITS, bits + max(step, math.ceil(0.5 * math.log2(most / LEAF))))
        step *= 2
    return bits


def _answer(index: GridIndex, queries: DataFrame, qid: str, pid: str, a: str, b: str, digits: int | None) -> DataFrame:
    """One row per query: a query without a place on the map, and every query
    over an empty index, has a NULL id and distance."""
    good = _query(index, queries.where(_on_map(a, b)), qid, pid, a, b, digits)
    lost = queries if index.empty else queries.where(~_on_map(a, b))
    kinds = dict(index.pts.dtypes)
    return good.unionByName(lost.select(
        F.col(qid), F.lit(None).cast(kinds["_pid"]).alias(pid), *[F.lit(None).cast(kinds[c]).alias(c) for c in index.carry],
        F.lit(None).cast("double").alias("dist")))


def _query(index: GridIndex, queries: DataFrame, qid: str, pid: str, a: str, b: str, digits: int | None):
    geom, pts, reps, carry = index.geom, index.pts, index.reps, list(index.carry)
    top = _top(geom.bits)
    qa, qb = F.col("_qa"), F.col("_qb")
    qci, qcj = geom.cells(F.col(a), F.col(b), clamp=True)
    qs = queries.select(F.col(qid).alias("_qid"), F.col(a).alias("_qa"), F.col(b).alias("_qb"),
                        qci.alias("_ci"), qcj.alias("_cj"))
    ci, cj = F.col("_ci"), F.col("_cj")

    # Stage 1: 3x3 neighbourhood at every level, one generator -> upper bound.
    # (Built as one SQL expression: a single call instead of hundreds of
    # Column-API round trips.)
    nb = []
    for lv in range(top + 1):
        sh = STEP * lv
        wrap = max(geom.nj >> sh, 1)
        for di in (-1, 0, 1):
            for dj in (-1, 0, 1):
                j = f"shiftright(_cj, {sh}) + ({dj})"
                j = f"pmod({j}, {wrap})" if geom.wrap_j else j
                nb.append(f"named_struct('lv', {lv}, 'ci', shiftright(_ci, {sh}) + ({di}), 'cj', {j})")
    nb = F.expr("array(" + ", ".join(nb) + ")")
    qn = qs.select("_qid", "_qa", "_qb", F.explode(nb).alias("n")).select(
        "_qid", "_qa", "_qb", F.col("n.lv").alias("lv"), F.col("n.ci").alias("ci"), F.col("n.cj").alias("cj"))
    bound = (qn.join(reps, ["lv", "ci", "cj"])
             .groupBy("_qid", "_qa", "_qb")
             .agg(F.min(geom.dist(qa, qb, F.col("r.a"), F.col("r.b"), F.col("r.n"))).alias("bd")))

    # Stage 2: descend the pyramid through non-empty cells meeting the box.
    ilo, ihi, jlo, jhi, full = geom.box(qa, qb, F.col("bd"))
    q2 = bound.select("_qid", "_qa", "_qb", "bd", ilo.alias("ilo"), ihi.alias("ihi"),
                      jlo.alias("jlo"), jhi.alias("jhi"), full.alias("full"))
    if geom.wrap_j:
        nj = geom.nj
        lo, hi, fl = F.col("jlo"), F.col("jhi"), F.col("full")

        def rg(x, y):
            return F.struct(x.alias("lo"), y.alias("hi"))
        ranges = (F.when(fl, F.array(rg(F.lit(0), F.lit(nj - 1))))
                  .when(lo < 0, F.array(rg(lo + nj, F.lit(nj - 1)), rg(F.lit(0), hi)))
                  .when(hi >= nj, F.array(rg(lo, F.lit(nj - 1)), rg(F.lit(0), hi - nj)))
                  .otherwise(F.array(rg(lo, hi))))
    else:
        ranges = F.array(F.struct(F.col("jlo").alias("lo"), F.col("jhi").alias("hi")))
    s = STEP * top
    box = ["_qid", "_qa", "_qb", "bd", "ilo", "ihi", "jlo", "jhi"]
    by_query = Window.partitionBy("_qid")

    def level(lv):
        return reps.where(F.col("lv") == lv).select("ci", "cj", "r")

    def tighten(front, sh):
        """Branch and bound: the representatives of the cells just reached
        are real points, so the nearest of them tightens the query's bound;
        cells whose lower-bound distance exceeds it cannot hold the answer."""
        dr = geom.dist(qa, qb, F.col("r.a"), F.col("r.b"), F.col("r.n"))
        lb = geom.cell_lower_bound(qa, qb, F.col("ci"), F.col("cj"), sh)
        return (front.withColumn("bd", F.least(F.col("bd"), F.min(dr).over(by_query)))
                .where(lb <= F.col("bd") * (1 + _EPS) + _EPS)
                .select(*box, "ci", "cj"))

    front = (q2.select("_qid", "_qa", "_qb", "bd", "ilo", "ihi", F.explode(ranges).alias("rg"))
             .select("_qid", "_qa", "_qb", "bd", "ilo", "ihi", F.col("rg.lo").alias("jlo"),
                     F.col("rg.hi").alias("jhi"),
                     F.explode(F.sequence(F.shiftright("ilo", s), F.shiftright("ihi", s))).alias("ci"))
             .select(*box, "ci", F.explode(F.sequence(F.shiftright("jlo", s), F.shiftright("jhi", s))).alias("cj"))
             .join(level(top), ["ci", "cj"]))
    f = 1 << STEP
    ch = F.explode(F.expr("array(" + ", ".join(
        f"named_struct('ci', ci * {f} + {da}, 'cj', cj * {f} + {db})"
        for da in range(f) for db in range(f)) + ")")).alias("k")
    for lv in range(top - 1, -1, -1):
        s = STEP * lv
        nxt = level(lv)
        # children meeting the box (a left-side filter Spark applies before
        # the join) that are non-empty at this level (the equi-join)
        meets = F.expr(f"shiftleft(k.ci, {s}) <= ihi and shiftleft(k.ci + 1, {s}) - 1 >= ilo and "
                       f"shiftleft(k.cj, {s}) <= jhi and shiftleft(k.cj + 1, {s}) - 1 >= jlo")
        front = front.select(*box, ch).join(
            nxt, (F.col("k.ci") == nxt.ci) & (F.col("k.cj") == nxt.cj) & meets).drop("k")
        if lv < TIGHTEN_BELOW:
            # the frontier multiplies 16x per level; prune where it is widest
            front = tighten(front, s)
        else:
            front = front.select(*box, "ci", "cj")

    pairs = front.select("_qid", "_qa", "_qb", "ci", "cj").join(pts, ["ci", "cj"])
    dist = geom.dist(qa, qb, F.col("_pa"), F.col("_pb"), F.col("_pn"))
    rank = F.round(dist, digits) if digits is not None else dist
    best = (pairs.groupBy("_qid")
            .agg(F.min(F.struct(rank.alias("d"), F.col("_pid").alias("i"), dist.alias("dist"),
                                *[F.col(c) for c in carry])).alias("s")))
    return best.select(F.col("_qid").alias(qid), F.col("s.i").alias(pid),
                       *[F.col(f"s.{c}").alias(c) for c in carry], F.col("s.dist").alias("dist"))


# ------------------------------------------------------------------ sphere

def _sphere_bits(n_points: int) -> int:
    # uniform grid: 2 * 4^p cells ~ n / POINTS_PER_CELL
    p = 0 if n_points <= 0 else int(round(0.5 * math.log2(max(n_points / POINTS_PER_CELL / 2.0, 1.0))))
    return max(1, min(MAX_BITS, p + FINER_BITS))


def sphere_index(points: DataFrame, *, pid: str = "id", lat: str = "latitude", lon: str = "longitude",
                 carry=(), level: int | None = None, path: str | None = None) -> GridIndex:
    """Grid pyramid of points given in degrees, written under ``path`` (a
    fresh folder of the shared location by default); ``level`` overrides the
    number of latitude-band bits of level 0."""
    n = points.where(_on_map(lat, lon)).count()

    def geometry(bits: int) -> Geometry:
        return Geometry("sphere", bits, 2 ** bits, 2 ** (bits + 1), True)

    geom = geometry(level if level is not None else _fine_enough(points, lat, lon, geometry, _sphere_bits(n)))
    return _build(points, geom, pid, lat, lon, carry, path or scratch_path(points.sparkSession, "sphere-index"), not n)


def sphere_nearest(index: GridIndex, queries: DataFrame, *, pid: str = "id", qid: str = "qid",
                   lat: str = "latitude", lon: str = "longitude", digits: int = 9) -> DataFrame:
    return _answer(index, queries, qid, pid, lat, lon, digits)


def nearest_on_sphere(points: DataFrame, queries: DataFrame, *, pid: str = "id", qid: str = "qid",
                      lat: str = "latitude", lon: str = "longitude", carry=(), level: int | None = None,
                      digits: int = 9) -> DataFrame:
    """Nearest point for every query; coordinates in degrees.

    Returns (qid, pid, *carry, dist) with dist the central angle in radians
    (ranked after rounding to ``digits``, ties to the smaller id).
    """
    idx = sphere_index(points, pid=pid, lat=lat, lon=lon, carry=carry, level=level)
    return sphere_nearest(idx, queries, pid=pid, qid=qid, lat=lat, lon=lon, digits=digits)


# ------------------------------------------------------------------- plane

def plane_index(points: DataFrame, *, pid: str = "id", x: str = "easting", y: str = "northing",
                carry=(), form: str = "direct") -> GridIndex:
    st = points.where(_on_map(x, y)).agg(F.count(F.lit(1)).alias("n"), F.min(x).alias("x0"), F.max(x).alias("x1"),
                    F.min(y).alias("y0"), F.max(y).alias("y1")).first()
    x0, x1, y0, y1 = (float(st[c]) if st["n"] else 0.0 for c in ("x0", "x1", "y0", "y1"))
    span = max(x1 - x0, y1 - y0, 1e-9)
    p = int(math.ceil(0.5 * math.log2(max(st["n"] / POINTS_PER_CELL, 1.0))))
    bits = max(1, min(MAX_BITS, p + FINER_BITS))

    def geometry(bits: int) -> Geometry:
        return Geometry("plane", bits, 2 ** bits, 2 ** bits, False, x0=x0, y0=y0, c0=span * (1 + 1e-12) / 2 ** bits, form=form)

    geom = geometry(_fine_enough(points, y, x, geometry, bits))
    return _build(points, geom, pid, y, x, carry, scratch_path(points.sparkSession, "plane-index"), not st["n"])


def nearest_in_plane(points: DataFrame, queries: DataFrame, *, pid: str = "id", qid: str = "qid",
                     x: str = "easting", y: str = "northing", carry=(), form: str = "direct") -> DataFrame:
    """Nearest point by Euclidean distance in two dimensions.

    ``form='direct'`` sums squared differences; ``form='expanded'`` uses
    |p|^2 - 2 p.q + |q|^2 with the point norm precomputed (double precision).
    Returns (qid, pid, *carry, dist); ties to the smaller id.
    """
    idx = plane_index(points, pid=pid, x=x, y=y, carry=carry, form=form)
    return _answer(idx, queries, qid, pid, y, x, None)
