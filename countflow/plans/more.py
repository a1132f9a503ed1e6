"""Queries of the matching, statistics, gate and calendar operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from countflow import functions as fn
from countflow.operators import calendars, components, gates, matching, roads
from countflow.operators import statistics as stt
from countflow.operators import windows as wn
from countflow.plans.core import CANDIDATES, NEAR, WEEK, candidate_kinds, candidates, near
from countflow.plans.views import KM, daily, edges, flags, holidays, hourly_users, registry, sql, stations, table
from countflow.session import checkpoint

QUERIES: dict = {}
ORACLE_SQL: dict = {}
c = F.col


def query(name: str, oracle: str | None):
    def keep(f):
        QUERIES[name] = f
        if oracle:
            ORACLE_SQL[name] = oracle
        return f

    return keep


# -- matching and graph


@query("g1_haversine", sql("registry", "SELECT counter, round(2 * 6371.0 * asin(sqrt(pow(sin(radians(lat - 35) / 2), 2) + cos(radians(35)) * cos(radians(lat)) * pow(sin(radians(lon - 139) / 2), 2))), 6) AS km FROM registry"))
def _(s, d):
    return registry(s, d).select("counter", F.round(fn.haversine_km(F.lit(35.0), F.lit(139.0), c("lat"), c("lon")), 6).alias("km"))


@query("g2_one_to_one_match", None)
def _(s, d):
    lefts, rights, pairs = candidate_kinds(s, d)
    return matching.one_to_one_match_of_kinds(pairs, lefts, rights, "counter", "station", "kind", "s_kind", "cost")


@query("g3_match_quality", sql("registry stations", f""", m AS (SELECT a.counter, abs(ln((a.size + 2000) / (b.s_size + 2000))) AS gap FROM registry a JOIN stations b ON {KM} <= 60)
SELECT count(*) AS n, round(median(gap), 9) AS median_gap, round(avg((gap <= 0.1)::INT), 9) AS within_10, round(avg((gap <= 0.2)::INT), 9) AS within_20, round(avg((gap <= 0.3)::INT), 9) AS within_30 FROM m"""))
def _(s, d):
    size = lambda df, x: df.withColumn("_v", F.log(c(x) + 2000))
    q = matching.match_quality_within_km(size(registry(s, d), "size"), size(stations(s, d), "s_size"), 60, "_v", "_v")
    return q.select("n", *[F.round(x, 9).alias(x) for x in ("median_gap", "within_10", "within_20", "within_30")])


LINKS = "SELECT DISTINCT p_partkey AS a, p_partkey * 7 % 4096 AS b FROM part"
CLOSURE = f"""WITH RECURSIVE e AS (SELECT a, b FROM ({LINKS}) UNION SELECT b, a FROM ({LINKS})), r AS (SELECT a AS node, a AS via FROM e UNION SELECT r.node, e.b FROM r JOIN e ON e.a = r.via)
SELECT node, min(via) AS label FROM r GROUP BY 1"""


@query("g4_connected_components", CLOSURE)
def _(s, d):
    p = table(s, d, "part").select(c("p_partkey").alias("a"), (c("p_partkey") * 7 % 4096).alias("b"))
    return components.connected_components(p)


#: Survey sections made from the parts: kinds of ends in turn, codes that are sections or not, borders that are named back or not, names in either order.
KINDS = (5, 6, 8, 9, 4, 1, 2, 3, 3)
_END = """CASE WHEN {k} IN (1, 2) THEN CAST(p_partkey * 7 % 2500 AS VARCHAR) WHEN {k} = 3 THEN CAST(p_partkey + 1 - 2 * (p_partkey % 2) AS VARCHAR) WHEN {k} = 4 THEN CAST(p_partkey % 2 AS VARCHAR) END AS {x}_code,
CASE WHEN {k} = 6 THEN CASE WHEN p_partkey % 2 = 0 THEN 'x・y境' ELSE 'y・x境' END WHEN {k} = 5 AND p_size % 2 = 0 THEN 'dam' ELSE '' END AS {x}_name"""
SECTIONS = f"""t AS (SELECT *, {list(KINDS)}[p_partkey * 5 % 9 + 1] AS sk, {list(KINDS)}[p_size % 9 + 1] AS ek FROM part),
x AS (SELECT CAST(p_partkey AS VARCHAR) AS k, p_partkey AS o, p_brand AS g, sk AS start_kind, ek AS end_kind, {_END.format(k="sk", x="start")}, {_END.format(k="ek", x="end")} FROM t)"""
_PLACE = "CASE WHEN {x}_kind <= 4 THEN coalesce({x}_code, '') WHEN {x}_kind = 6 THEN array_to_string(list_sort(list_distinct(string_split(replace({x}_name, '境', ''), '・'))), '・') ELSE {x}_name END"


def sections(s, d):
    k, size = c("p_partkey"), c("p_size")
    kinds = F.array(*[F.lit(x) for x in KINDS])
    t = table(s, d, "part").select(k.alias("k"), c("p_brand").alias("g"), F.get(kinds, (k * 5 % 9).cast("int")).alias("start_kind"), F.get(kinds, (size % 9).cast("int")).alias("end_kind"), size.alias("size"))
    k = c("k")
    for x in ("start", "end"):
        kind = c(f"{x}_kind")
        code = F.when(kind.isin(1, 2), k * 7 % 2500).when(kind == 3, k + 1 - 2 * (k % 2)).when(kind == 4, k % 2).cast("string")
        name = F.when(kind == 6, F.when(k % 2 == 0, "x・y境").otherwise("y・x境")).when((kind == 5) & (c("size") % 2 == 0), "dam").otherwise("")
        t = t.withColumn(f"{x}_code", code).withColumn(f"{x}_name", name)
    return t


@query("g5_same_place_edges", f"""WITH {SECTIONS}, y AS (SELECT *, {_PLACE.format(x="start")} AS sv, {_PLACE.format(x="end")} AS ev FROM x),
n AS (SELECT *, lead(k) OVER w AS nk, lead(start_kind) OVER w AS nkind, lead(sv) OVER w AS nsv FROM y WINDOW w AS (PARTITION BY g ORDER BY o)),
e AS (SELECT k, k || ':s' AS p, start_kind AS kind, start_code AS code FROM x UNION ALL SELECT k, k || ':e', end_kind, end_code FROM x)
SELECT k || ':e' AS a, nk || ':s' AS b, 'next' AS rule FROM n WHERE end_kind = nkind AND ev = nsv AND end_kind <> 8 AND (ev <> '' OR end_kind IN (5, 9))
UNION ALL SELECT p, code || CASE kind WHEN 1 THEN ':e' ELSE ':s' END, 'junction' FROM e WHERE kind IN (1, 2) AND code IN (SELECT k FROM x)
UNION ALL SELECT a.p, min(b.p), 'border' FROM e a JOIN e b ON a.kind = 3 AND b.kind = 3 AND a.code = b.k AND b.code = a.k GROUP BY a.p HAVING count(*) = 1""")
def _(s, d):
    return roads.same_place_edges(sections(s, d), "k", "g")


@query("g6_contract_edges", sql("edges", "SELECT least(a - a % 3, b - b % 3) AS a, greatest(a - a % 3, b - b % 3) AS b, min(km) AS km FROM edges WHERE a - a % 3 <> b - b % 3 GROUP BY 1, 2"))
def _(s, d):
    labels = s.range(0, 1).select(F.lit(None).cast("bigint").alias("node"), F.lit(None).cast("bigint").alias("label")).limit(0)
    e = edges(s, d)
    nodes = e.select(c("a").alias("node")).union(e.select("b")).distinct()
    return matching.contract_edges(e, labels.unionByName(nodes.withColumn("label", c("node") - c("node") % 3)))




#: Distances in hundreds of metres from every part within a limit.
WAYS = """, e AS (SELECT a, b, CAST(round(km * 10) AS INT) AS h FROM edges UNION SELECT b, a, CAST(round(km * 10) AS INT) FROM edges), r AS (SELECT p_partkey AS source, p_partkey AS node, 0 AS h FROM part UNION SELECT r.source, e.b, r.h + e.h FROM r JOIN e ON e.a = r.node WHERE r.h + e.h <= {})"""


@query("g7_bounded_shortest_paths", sql("edges", WAYS.format(10) + " SELECT source, node, CAST(min(h) AS DOUBLE) / 10 AS km FROM r GROUP BY 1, 2").replace("WITH ", "WITH RECURSIVE ", 1))
def _(s, d):
    sources = table(s, d, "part").select(c("p_partkey").alias("source"))
    return matching.many_shortest_paths(edges(s, d), sources, 1.0).withColumn("km", F.round("km", 3))


def _placed(s, d):
    return table(s, d, "part").select(c("p_partkey").alias("counter"), c("p_partkey").alias("node"), (c("p_partkey") % 3 / 10).alias("offset"))


@query("g8_pair_distance", sql("edges", WAYS.format(30) + """, s AS (SELECT source, node, min(h) AS h FROM r GROUP BY 1, 2), p AS (SELECT least(source, node) AS a, greatest(source, node) AS b, h + source % 3 + node % 3 AS h FROM s WHERE source <> node)
SELECT a, b, CAST(min(h) AS DOUBLE) / 10 AS km FROM p GROUP BY 1, 2 HAVING min(h) <= 35""").replace("WITH ", "WITH RECURSIVE ", 1))
def _(s, d):
    return matching.placed_distances(edges(s, d), _placed(s, d), 3.0, 3.5).withColumn("km", F.round("km", 3))


DIST = "SELECT a.counter AS a, b.counter AS b, {KM} AS km FROM registry a JOIN registry b ON a.counter < b.counter AND {KM} <= 30".replace("{KM}", KM)


def distances(s, d, km=30):
    from countflow.operators.joins import pairs_within_km

    return pairs_within_km(registry(s, d), "counter", km)


@query("g9_direct_pairs", sql("registry", f""", x AS ({DIST}), w AS (SELECT a, b, km FROM x UNION ALL SELECT b, a, km FROM x)
SELECT a, b, round(km, 6) AS km, NOT EXISTS (SELECT 1 FROM w p JOIN w q ON p.b = q.a WHERE p.a = x.a AND q.b = x.b AND p.km + q.km <= x.km + 0.125) AS direct FROM x"""))
def _(s, d):
    return matching.direct_pairs_within_km(registry(s, d), "counter", 30).withColumn("km", F.round("km", 6))


@query("g10_place_on_chain", """WITH s AS (SELECT p_partkey AS k, p_partkey - p_partkey % 5 AS u, p_brand AS town, p_size AS km, p_partkey // 3 AS sp, (p_partkey + 2) // 3 AS ep FROM part),
m AS (SELECT p_partkey AS counter, p_partkey - p_partkey % 5 AS own, CASE WHEN p_partkey % 3 = 0 THEN p_brand ELSE 'Brand#' || (p_size % 5 + 1) || (p_partkey % 5 + 1) END AS town FROM part),
r AS (SELECT counter, own, m.town, k, km, sp, ep, s.town = m.town AS there, bool_or(s.town = m.town) OVER (PARTITION BY counter) AS any_there FROM m JOIN s ON s.u = m.own),
c AS (SELECT *, sum(new) OVER (PARTITION BY counter ORDER BY k) AS st FROM (SELECT *, (sp IS DISTINCT FROM lag(ep) OVER (PARTITION BY counter ORDER BY k))::INT AS new FROM r WHERE there OR NOT any_there)),
g AS (SELECT counter, own, town, st, min(k) AS from_section, max(k) AS to_section, CAST(sum(km) AS BIGINT) AS placed_km, any_there AS in_town, bool_or(k = own) AS holds FROM c GROUP BY counter, own, town, st, any_there)
SELECT counter, own AS section, town, from_section, to_section, placed_km, in_town FROM g QUALIFY row_number() OVER (PARTITION BY counter ORDER BY holds DESC, placed_km DESC, st) = 1""")
def _(s, d):
    k = c("p_partkey")
    p, unit = table(s, d, "part"), k - k % 5
    sec = p.select(k.alias("section"), unit.alias("unit"), c("p_brand").alias("town"), c("p_size").alias("km"), F.floor(k / 3).alias("start_place"), F.floor((k + 2) / 3).alias("end_place"))
    other = F.concat(F.lit("Brand#"), (c("p_size") % 5 + 1).cast("string"), (k % 5 + 1).cast("string"))
    m = p.select(k.alias("counter"), unit.alias("section"), F.when(k % 3 == 0, c("p_brand")).otherwise(other).alias("town"))
    return roads.place_on_chain(roads.stretches(m, sec, "counter", "section", "town"), "counter", "section", "town")


@query("g11_impossible_pairs", sql("registry", f"SELECT a, b FROM ({DIST}) WHERE km > 20 + 0.5 + a % 7"))
def _(s, d):
    return matching.impossible_pairs(distances(s, d).withColumn("road", F.lit(20) + c("a") % 7), "km", "road").select("a", "b")


@query("g12_degree_and_coverage", sql("registry", f"SELECT (SELECT count(*) FROM ({DIST})) AS pairs, (SELECT count(*) FROM ({DIST}) WHERE km < 10) AS direct_pairs, (SELECT count(*) FROM (SELECT a FROM ({DIST}) UNION SELECT b FROM ({DIST}))) AS units_with_neighbour, (SELECT count(*) FROM registry) AS units"))
def _(s, d):
    return matching.degree_and_coverage_within_km(registry(s, d), "counter", 30, c("km") < 10)


@query("g13_attach_registry", "SELECT coalesce(n.k, o.k) AS k, coalesce(n.pos, o.pos) AS pos, greatest(n.seen, o.seen) AS last_seen FROM (SELECT c_custkey AS k, c_nationkey AS pos, c_custkey % 30 AS seen FROM customer WHERE c_custkey % 3 = 0) n FULL JOIN (SELECT c_custkey AS k, c_nationkey + 100 AS pos, c_custkey % 20 AS seen FROM customer WHERE c_custkey % 2 = 0) o ON n.k = o.k")
def _(s, d):
    k = c("c_custkey")
    t = table(s, d, "customer")
    new = t.filter(k % 3 == 0).select(k.alias("k"), c("c_nationkey").alias("pos"), (k % 30).alias("last_seen"))
    old = t.filter(k % 2 == 0).select(k.alias("k"), (c("c_nationkey") + 100).alias("pos"), (k % 20).alias("last_seen"))
    return matching.attach_registry(new, old, ["k"], ["pos"])


@query("g14_place_names", """WITH p AS (SELECT c_custkey AS k, c_custkey % 5 AS t, 'O' || lower(c_mktsegment) AS base, CASE WHEN c_custkey % 11 = 0 THEN 'none' WHEN c_custkey % 7 = 0 THEN 'several' WHEN c_custkey % 13 = 0 THEN 'label' WHEN c_custkey % 17 = 0 THEN 'reading' END AS problem FROM customer),
o AS (SELECT *, base || '-' || ['shi', 'ku', CASE WHEN k % 2 = 0 THEN 'cho' ELSE 'machi' END, 'mura', 'son'][CAST(t + 1 AS INT)] AS own FROM p),
r AS (SELECT o.k, o.own, c.k IS NOT NULL AS ward, c.own AS city, coalesce(o.problem, CASE WHEN c.k IS NOT NULL AND c.problem IS NOT NULL THEN 'city' END) AS problem FROM o LEFT JOIN o c ON o.t = 1 AND c.k = o.k - 1)
SELECT k AS code, CASE WHEN problem IS NULL THEN CASE WHEN ward THEN city || ' ' || own ELSE own END END AS label, problem FROM r""")
def _(s, d):
    """Customers as places: every fifth a city, the next one its ward, the others towns and villages; some without a label, with two, with a number in it, or with a reading of another type."""
    k, t = c("c_custkey"), table(s, d, "customer")
    number, city = k.cast("string"), (k - 1).cast("string")
    kind = lambda *x: F.get(F.array(*[F.lit(v) if isinstance(v, str) else v for v in x]), (k % 5).cast("int"))
    name = F.concat(F.when(k % 5 == 1, F.concat(F.lit("N"), city, F.lit("市"))).otherwise(F.lit("")), F.lit("N"), number, kind("市", "区", "町", "村", "村"))
    ending = F.when(k % 17 == 0, "ナシ".replace("シ", "")).otherwise(kind("シ", "ク", F.when(k % 2 == 0, "チョウ").otherwise("マチ"), "ムラ", "ソン"))
    half = F.when(k % 5 == 1, F.concat(F.lit("R"), city, F.when((k - 1) % 17 == 0, "ナ").otherwise("ｼ"))).otherwise(F.lit(""))
    places = t.select(k.alias("code"), name.alias("name"), F.concat(half, F.lit("R"), number, ending).alias("reading"))
    base = F.concat(F.lit("Ō"), F.lower("c_mktsegment"))
    one = F.concat(F.when(k % 13 == 0, F.concat(base, F.lit("9"))).otherwise(base), kind("-shi", "-ku, Somewhere", " Town", " village", "-son"))
    two = t.filter((k % 7 == 0) & (k % 11 != 0)).select(k.alias("code"), F.concat(base, F.lit("x")).alias("label"))
    labels = t.filter(k % 11 != 0).select(k.alias("code"), one.alias("label")).unionByName(two)
    return matching.place_names(places, labels, "code", "name", "reading", "label")


# -- statistics


@query("m1_pair_correlation", sql("daily", f"SELECT a, b, count(*) AS n, round(corr(x.vehicles, y.vehicles), 8) AS r FROM ({NEAR}) JOIN daily x ON x.counter = a JOIN daily y ON y.counter = b AND y.date = x.date GROUP BY 1, 2 HAVING count(*) >= 5"))
def _(s, d):
    return stt.pair_correlation(daily(s, d), near(s, d), "counter", "date", "vehicles", 5).withColumn("r", F.round("r", 8))


@query("m2_spearman", "WITH x AS (SELECT l_returnflag AS g, rank() OVER (PARTITION BY l_returnflag ORDER BY l_quantity) + (count(*) OVER (PARTITION BY l_returnflag, l_quantity) - 1) / 2 AS a, rank() OVER (PARTITION BY l_returnflag ORDER BY l_discount) + (count(*) OVER (PARTITION BY l_returnflag, l_discount) - 1) / 2 AS b FROM lineitem) SELECT g, count(*) AS n, round(corr(a, b), 8) AS rho FROM x GROUP BY 1")
def _(s, d):
    li = table(s, d, "lineitem").select(c("l_returnflag").alias("g"), "l_quantity", "l_discount")
    return stt.spearman(li, "l_quantity", "l_discount", ["g"]).withColumn("rho", F.round("rho", 8))


@query("m3_permutation", None)
def _(s, d):
    return stt.permutation(registry(s, d), "counter", 3)


@query("m4_time_split", "SELECT event_id, CAST(ts AS DATE) > (SELECT max(CAST(ts AS DATE)) FROM events) - 7 AS is_test FROM events")
def _(s, d):
    return stt.time_split(table(s, d, "events"), "ts", 7).select("event_id", "is_test")


def _features(s, d):
    x = daily(s, d).withColumn("base", c("lines") * 25).withColumn("off", F.weekday("date") >= 5)
    return stt.daily_features(x, ["counter"], "date", "vehicles", "base", "off")


@query("m5_daily_features", sql("daily", """SELECT a.counter, a.date, round(ln(nullif(a.vehicles, 0)), 9) AS y, round(ln(nullif(b.vehicles, 0)), 9) AS lag1, round(ln(nullif(e.vehicles, 0)), 9) AS lag7, round(ln(nullif(f.vehicles, 0)), 9) AS lag14, round(ln(nullif(e.vehicles, 0)) - ln(e.lines * 25), 9) AS ratio7, isodow(b.date) >= 6 AS prev_day_off, round(ln(a.lines * 25), 9) AS log_base, CAST(isodow(a.date) - 1 AS INT) AS weekday
FROM daily a LEFT JOIN daily b ON b.counter = a.counter AND b.date = a.date - 1 LEFT JOIN daily e ON e.counter = a.counter AND e.date = a.date - 7 LEFT JOIN daily f ON f.counter = a.counter AND f.date = a.date - 14"""))
def _(s, d):
    return _features(s, d).select("counter", "date", *[F.round(x, 9).alias(x) for x in ("y", "lag1", "lag7", "lag14", "ratio7")], "prev_day_off", F.round("log_base", 9).alias("log_base"), "weekday")


@query("m6_hourly_graph_features", sql("hourly_users", f""", w AS (SELECT a, b FROM ({NEAR}) UNION SELECT b, a FROM ({NEAR})), n AS (SELECT w.a AS counter, ts, avg(vehicles) AS near FROM w JOIN hourly_users h ON h.counter = w.b GROUP BY 1, 2)
SELECT h.counter, h.ts, vehicles, lag(vehicles) OVER q AS vehicles_lag1, lag(vehicles, 2) OVER q AS vehicles_lag2, lead(vehicles) OVER q AS vehicles_lead1, round(near, 9) AS near, round(lag(near) OVER q, 9) AS near_lag1 FROM hourly_users h LEFT JOIN n ON n.counter = h.counter AND n.ts = h.ts WINDOW q AS (PARTITION BY h.counter ORDER BY h.ts)"""))
def _(s, d):
    return stt.hourly_graph_features(hourly_users(s, d), near(s, d), "counter", "ts", "vehicles").withColumn("near", F.round("near", 9)).withColumn("near_lag1", F.round("near_lag1", 9))


@query("m7_fit_forecast", None)
def _(s, d):
    """The model of the days before the last 200, by counter and day of these: what it predicts of the logarithm."""
    f = stt.time_split(checkpoint(_features(s, d)), "date", 200).withColumn("prev", c("prev_day_off").cast("int"))
    model = stt.fit_forecast(f.filter("NOT is_test"), ["lag1", "lag7", "lag14", "ratio7", "weekday", "prev"], "y", trees=5, depth=3)
    return model.transform(f.filter("is_test")).select("counter", "date", F.round("prediction", 6).alias("prediction"))


@query("m9_ablation", None)
def _(s, d):
    """Mean absolute error on the last 200 days with yesterday's value, and with those of the last weeks too."""
    f = stt.time_split(checkpoint(_features(s, d)), "date", 200)
    return stt.ablation(f.filter("NOT is_test"), f.filter("is_test"), {"yesterday": ["lag1"], "weeks": ["lag1", "lag7", "lag14"]}, "y", trees=5, depth=3)


@query("m3_null_distribution", None)
def _(s, d):
    """How often the larger share of a counter differs from its partner's: for its own and for five permutations."""
    x = daily(s, d).groupBy("counter").agg((F.sum("large") / F.sum("vehicles")).alias("own"), (F.sum("large") / F.sum("vehicles")).alias("other"))
    return stt.null_distribution(x, "counter", "own", "other", 0.01, 5)


@query("m8_naive_forecasts", sql("daily", f""", x AS (SELECT a.*, b.vehicles AS last_week, a.lines * 25 AS usual, CASE WHEN isodow(a.date) >= 6 THEN 'off' ELSE 'work' END AS kind FROM daily a LEFT JOIN daily b ON a.counter = b.counter AND b.date = a.date - 7), y AS (SELECT 'last_week' AS forecast, kind, vehicles, last_week AS f FROM x UNION ALL SELECT 'usual', kind, vehicles, usual FROM x), z AS (SELECT * FROM y UNION ALL SELECT forecast, 'all', vehicles, f FROM y)
SELECT forecast, kind, round(sum(abs(vehicles - f)) / sum(vehicles), 9) AS wape, round(avg(abs(vehicles - f)), 9) AS mae, count(*) AS n FROM z WHERE f IS NOT NULL GROUP BY 1, 2"""))
def _(s, d):
    from countflow.operators.joins import shift_join

    x = shift_join(daily(s, d), ["counter"], "date", ["vehicles"], 7).withColumn("usual", c("lines") * 25).withColumn("kind", F.when(F.weekday("date") >= 5, "off").otherwise("work"))
    return stt.naive_forecasts(x, "vehicles", "vehicles_lag7", "usual", "kind").withColumn("wape", F.round("wape", 9)).withColumn("mae", F.round("mae", 9))


@query("m10_sign_agreement", sql("daily", f"SELECT round(avg((sign(y - 30) = sign(last_week - 30))::INT) FILTER (abs(y - 30) >= 10), 9) AS agreement, count(last_week) FILTER (abs(y - 30) >= 10) AS n FROM ({WEEK})"))
def _(s, d):
    from countflow.operators.joins import shift_join

    x = shift_join(daily(s, d), ["counter"], "date", ["vehicles"], 7).select((c("vehicles") - 30).alias("a"), (c("vehicles_lag7") - 30).alias("b"))
    return stt.sign_agreement(x, "a", "b", 10).withColumn("agreement", F.round("agreement", 9))


@query("m11_describe_numeric", " UNION ALL ".join(f"SELECT '{x}' AS \"column\", count({x}) AS n, CAST(min({x}) AS DOUBLE) AS min, quantile_cont({x}, 0.25) AS q1, CAST(median({x}) AS DOUBLE) AS median, quantile_cont({x}, 0.75) AS q3, CAST(max({x}) AS DOUBLE) AS max FROM lineitem" for x in ("l_quantity", "l_linenumber")))
def _(s, d):
    return stt.describe_numeric(table(s, d, "lineitem"), ["l_quantity", "l_linenumber"])


# -- gates and audits


@query("r1_check_contract", "SELECT n_nationkey, n_name FROM nation")
def _(s, d):
    from pyspark.sql import types as T

    return gates.check_contract(table(s, d, "nation").select("n_name", "n_nationkey"), {"n_nationkey": (T.LongType() if table(s, d, "nation").schema["n_nationkey"].dataType == T.LongType() else T.IntegerType(), "key"), "n_name": (T.StringType(), "name")})


@query("r2_domain_violations", "SELECT 'l_returnflag' AS \"column\", l_returnflag AS value, count(*) AS rows FROM lineitem WHERE l_returnflag NOT IN ('A', 'N') GROUP BY 2 UNION ALL SELECT 'l_linenumber', CAST(l_linenumber AS VARCHAR), count(*) FROM lineitem WHERE l_linenumber NOT IN (1, 2, 3) GROUP BY 2")
def _(s, d):
    return gates.domain_violations(table(s, d, "lineitem"), {"l_returnflag": ["A", "N"], "l_linenumber": [1, 2, 3]})


@query("r3_share_failures", "SELECT l_suppkey AS k, 'returned' AS rule, round(r / n, 9) AS share, CAST(0.3 AS DOUBLE) AS \"limit\" FROM (SELECT l_suppkey, count(*) AS n, count(*) FILTER (l_returnflag = 'R') AS r FROM lineitem GROUP BY 1) WHERE r / n > 0.3")
def _(s, d):
    g = table(s, d, "lineitem").groupBy(c("l_suppkey").alias("k")).agg(F.count("*").alias("n"), F.count_if(c("l_returnflag") == "R").alias("r"))
    return gates.share_failures(g, "k", {"returned": ("r", "n", 0.3)}).withColumn("share", F.round("share", 9))


@query("r4_presence", "SELECT c_custkey AS k, 'required' AS problem FROM (SELECT c_custkey FROM customer EXCEPT SELECT o_custkey + 5 FROM orders) UNION ALL SELECT k, 'unknown' FROM (SELECT o_custkey + 5 AS k FROM orders EXCEPT SELECT c_custkey FROM customer)")
def _(s, d):
    return gates.presence_failures(table(s, d, "orders").select((c("o_custkey") + 5).alias("k")), table(s, d, "customer").select(c("c_custkey").alias("k")), ["k"])


@query("r5_fill_share", sql("flags", "SELECT count(*) AS rows, count(f1) AS filled, round(count(f1) / count(*), 9) AS share, count(*) < 1000 OR count(f1) / count(*) >= 0.9 AS passes FROM flags WHERE line >= 5"))
def _(s, d):
    return gates.fill_share(flags(s, d), "f1", c("line") >= 5).withColumn("share", F.round("share", 9))


@query("r6_station_coverage", sql("flags", "SELECT 'small' AS element, count(*) AS rows, round(count(small) / count(*), 9) AS share, CAST(0.75 AS DOUBLE) AS \"limit\", count(small) / count(*) >= 0.75 AS passes FROM flags UNION ALL SELECT 'f1', count(*), round(count(f1) / count(*), 9), 0.95, count(f1) / count(*) >= 0.95 FROM flags"))
def _(s, d):
    return gates.station_coverage(flags(s, d), {"small": 0.75, "f1": 0.95}).withColumn("share", F.round("share", 9))


@query("r7_calendar_span", sql("holidays", "SELECT max(date) AS last, (SELECT max(CAST(l_shipdate AS DATE)) + 14 FROM lineitem) AS needed, max(date) >= (SELECT max(CAST(l_shipdate AS DATE)) + 14 FROM lineitem) AS passes FROM holidays"))
def _(s, d):
    return gates.calendar_span(holidays(s, d), table(s, d, "lineitem"), "l_shipdate")


@query("r8_code_name", "SELECT c_custkey AS k, CAST(c_custkey AS VARCHAR) AS code, c_mktsegment AS name, CASE substr(CAST(c_custkey AS VARCHAR), 1, 1) WHEN '1' THEN 'BUILDING' WHEN '2' THEN 'MACHINERY' END AS expected_name FROM customer WHERE c_mktsegment IS DISTINCT FROM expected_name")
def _(s, d):
    codes = s.createDataFrame([("1", "BUILDING"), ("2", "MACHINERY")], "prefix string, name string")
    t = table(s, d, "customer").select(c("c_custkey").alias("k"), c("c_custkey").cast("string").alias("code"), c("c_mktsegment").alias("name"))
    return gates.code_name_violations(t, codes, "code", "name", 1)


@query("r9_manifest", """WITH s AS (SELECT event_type AS region, count(*) AS rows_in, count(*) FILTER (value >= 10) AS rows_out, count(*) FILTER (value < 10) AS bad_value_rows FROM events GROUP BY 1), t AS (SELECT 'all' AS region, sum(rows_in) AS rows_in, sum(rows_out) AS rows_out, sum(bad_value_rows) AS bad_value_rows FROM s),
e AS (SELECT DISTINCT event_type || CASE WHEN user_id % 2 = 0 THEN '' ELSE '2' END AS region FROM events), l AS (UNPIVOT s ON rows_in, rows_out, bad_value_rows INTO NAME field VALUE v), lt AS (UNPIVOT (SELECT region, CAST(rows_in AS BIGINT) AS rows_in, CAST(rows_out AS BIGINT) AS rows_out, CAST(bad_value_rows AS BIGINT) AS bad_value_rows FROM t) ON rows_in, rows_out, bad_value_rows INTO NAME field VALUE v)
SELECT 'partition' AS section, region AS name, field, CAST(v AS VARCHAR) AS value FROM l UNION ALL SELECT 'total', 'all', field, CAST(v AS VARCHAR) FROM lt UNION ALL SELECT 'total', 'all', 'partitions', CAST(count(*) AS VARCHAR) FROM s
UNION ALL SELECT 'missing', region, 'missing', 'true' FROM e WHERE region NOT IN (SELECT region FROM s) UNION ALL SELECT 'failure', region, 'bad values', 'over' FROM (SELECT * FROM s UNION ALL SELECT * FROM t) WHERE bad_value_rows / rows_in > 0.19""")
def _(s, d):
    """The manifest of events by type. The files' rows are in ``r9_files``: their bytes aren't SQL's matter; shares are given as ``over``."""
    e = table(s, d, "events")
    stats = e.groupBy(c("event_type").alias("region")).agg(F.count("*").alias("rows_in"), F.count_if(c("value") >= 10).alias("rows_out"), F.count_if(c("value") < 10).alias("bad_value_rows"))
    expected = e.select(F.concat("event_type", F.when(c("user_id") % 2 == 0, "").otherwise("2")).alias("region"))
    files = gates.file_manifest(s, f"{d}/events.parquet")
    out = gates.manifest(stats, "region", ["rows_in", "rows_out", "bad_value_rows"], files, files.limit(0), expected, {"bad values": ("bad_value_rows", "rows_in", 0.19)})
    return out.filter("section NOT IN ('input', 'output')").withColumn("value", F.when(c("section") == "failure", "over").otherwise(c("value")))


@query("r9_files", None)
def _(s, d):
    return gates.file_manifest(s, [f"{d}/{t}.parquet" for t in ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")])


@query("r10_snapshot_diff", "SELECT coalesce(a.k, b.k) AS name, CASE WHEN a.k IS NULL THEN 'added' WHEN b.k IS NULL THEN 'removed' ELSE 'changed' END AS change FROM (SELECT p_partkey AS k, p_size AS h FROM part WHERE p_partkey % 3 <> 0) a FULL JOIN (SELECT p_partkey AS k, p_size + (p_partkey % 10 = 0)::INT AS h FROM part WHERE p_partkey % 4 <> 0) b ON a.k = b.k WHERE a.k IS NULL OR b.k IS NULL OR a.h <> b.h")
def _(s, d):
    k = c("p_partkey")
    t = table(s, d, "part")
    return gates.snapshot_diff(t.filter(k % 3 != 0).select(k.alias("name"), c("p_size").alias("sha256")), t.filter(k % 4 != 0).select(k.alias("name"), (c("p_size") + (k % 10 == 0).cast("int")).alias("sha256")))


@query("r11_table_diff", "SELECT count(*) FILTER (b.k IS NULL) AS only_a, count(*) FILTER (a.k IS NULL) AS only_b, CAST(0 AS BIGINT) AS repeated, count(*) FILTER (a.v <> b.v) AS differ_v FROM (SELECT p_partkey AS k, p_size AS v FROM part WHERE p_partkey % 5 <> 0) a FULL JOIN (SELECT p_partkey AS k, p_size + (p_partkey % 7 = 0)::INT AS v FROM part WHERE p_partkey % 6 <> 0) b ON a.k = b.k")
def _(s, d):
    k = c("p_partkey")
    t = table(s, d, "part")
    return gates.table_diff(t.filter(k % 5 != 0).select(k.alias("k"), c("p_size").alias("v")), t.filter(k % 6 != 0).select(k.alias("k"), (c("p_size") + (k % 7 == 0).cast("int")).alias("v")), ["k"], ["v"])


@query("r12_audit_sample", None)
def _(s, d):
    return gates.audit_sample(daily(s, d), ["counter"], c("vehicles") < 2, 20)


@query("r12_audit_partitions", """WITH z AS (SELECT c_nationkey AS part, count(*) AS size FROM customer GROUP BY 1), r AS (SELECT part, row_number() OVER (ORDER BY size, part) - 1 AS pos, count(*) OVER () AS n FROM z WHERE part % 9 <> 4),
c AS (SELECT *, least(greatest(3, 3 * n // 4) - 2, n - 2) AS choice FROM r), h AS (SELECT CAST('0x' || substr(sha256('2026-08'), 50, 15) AS BIGINT) AS h)
SELECT part FROM c, h WHERE pos < 2 OR (choice > 0 AND pos = 2 + h % greatest(choice, 1)) UNION SELECT part FROM z WHERE part % 9 = 4""")
def _(s, d):
    sizes = table(s, d, "customer").groupBy(c("c_nationkey").alias("part")).agg(F.count("*").alias("size"))
    return gates.audit_partitions(sizes, "part", "size", c("part") % 9 == 4, "2026-08")


@query("r15_backlog", "SELECT m AS k, CAST(CASE WHEN month(m) % 5 = 0 THEN 1 + year(m) % 3 ELSE 0 END AS INT) AS attempts, CASE WHEN n > 0 AND month(m) % 3 <> 0 THEN 'complete' WHEN month(m) % 4 = 0 THEN 'skipped' WHEN month(m) % 5 = 0 AND 1 + year(m) % 3 >= 3 THEN 'failed' WHEN month(m) % 5 = 0 THEN 'retry' ELSE 'todo' END AS status FROM (SELECT m, (SELECT count(*) FROM orders WHERE date_trunc('month', o_orderdate) = m) AS n FROM (SELECT unnest(generate_series(TIMESTAMP '1991-01-01', TIMESTAMP '2026-12-01', INTERVAL 1 MONTH))::DATE AS m))")
def _(s, d):
    months = s.sql("SELECT explode(sequence(DATE '1991-01-01', DATE '2026-12-01', INTERVAL 1 MONTH)) AS k")
    have = table(s, d, "orders").select(F.trunc(F.to_date("o_orderdate"), "month").alias("k")).distinct().filter(F.month("k") % 3 != 0)
    tries = months.filter(F.month("k") % 5 == 0).withColumn("attempts", 1 + F.year("k") % 3)
    return gates.backlog(months, have, months.filter(F.month("k") % 4 == 0), tries, "k")


@query("r16_min_rows", "SELECT l_suppkey AS k, count(*) AS rows, count(*) >= 600 AS passes FROM lineitem GROUP BY 1")
def _(s, d):
    return gates.min_rows(table(s, d, "lineitem").withColumnRenamed("l_suppkey", "k"), 600, ["k"])


# -- calendar

CAL = """, days AS (SELECT unnest(generate_series(date_trunc('year', min(date))::TIMESTAMP, make_date(year(max(date)), 12, 31)::TIMESTAMP, INTERVAL 1 DAY))::DATE AS date FROM holidays), h AS (SELECT days.date, name, name IS NOT NULL AS hol, name IS NOT NULL AND name <> 'holiday' AS named FROM days LEFT JOIN holidays USING (date)),
f AS (SELECT *, hol OR isodow(date) >= 6 AS off, CASE WHEN hol AND NOT named THEN CASE WHEN coalesce(lag(named) OVER w, false) AND coalesce(lead(named) OVER w, false) THEN 'citizens'' holiday' ELSE 'substitute holiday' END ELSE name END AS hn FROM h WINDOW w AS (ORDER BY date)), i AS (SELECT *, sum((NOT off)::INT) OVER (ORDER BY date) AS g FROM f),
cal AS (SELECT date, CAST(isodow(date) - 1 AS INT) AS weekday, hol AS is_holiday, hn AS holiday_name, off AS day_off, CASE WHEN off THEN CAST(count(*) OVER (PARTITION BY g, off) AS INT) ELSE 0 END AS days_off_in_run, lead(off, 1, false) OVER (ORDER BY date) AS next_day_off, CASE WHEN month(date) * 100 + day(date) BETWEEN 813 AND 816 THEN 'obon' WHEN month(date) * 100 + day(date) >= 1229 OR month(date) * 100 + day(date) <= 103 THEN 'new_year' ELSE '' END AS customary_break FROM i)"""


def calendar(s, d):
    return calendars.build_calendar(holidays(s, d))


@query("c1_build_calendar", sql("holidays", CAL + " SELECT * FROM cal"))
def _(s, d):
    return calendar(s, d)


@query("c2_day_class", sql("holidays", CAL + " SELECT date, CASE WHEN is_holiday THEN 6 ELSE weekday END AS class FROM cal"))
def _(s, d):
    return calendar(s, d).select("date", fn.day_class(c("weekday"), c("is_holiday")).alias("class"))


@query("c3_customary_break", "SELECT o_orderkey AS k, CASE WHEN month(o_orderdate) * 100 + day(o_orderdate) BETWEEN 813 AND 816 THEN 'obon' WHEN month(o_orderdate) * 100 + day(o_orderdate) >= 1229 OR month(o_orderdate) * 100 + day(o_orderdate) <= 103 THEN 'new_year' ELSE '' END AS b FROM orders")
def _(s, d):
    return table(s, d, "orders").select(c("o_orderkey").alias("k"), fn.customary_break(c("o_orderdate")).alias("b"))


@query("c4_holiday_names", sql("holidays", "SELECT date, name, upper(name) AS name_en FROM holidays"))
def _(s, d):
    h = holidays(s, d)
    return calendars.holiday_names(h, h.select("name", F.upper("name").alias("name_en")).distinct()).select("date", "name", "name_en")


@query("c5_clip_calendar", sql("holidays", CAL + " SELECT date FROM cal WHERE date BETWEEN (SELECT min(CAST(o_orderdate AS DATE)) FROM orders) AND (SELECT max(CAST(o_orderdate AS DATE)) FROM orders)"))
def _(s, d):
    return calendars.clip_calendar(calendar(s, d), table(s, d, "orders"), "o_orderdate").select("date")


@query("j2_attach_calendar", sql("holidays", CAL + " SELECT o_orderkey AS k, is_holiday, day_off, days_off_in_run FROM orders LEFT JOIN cal ON date = CAST(o_orderdate AS DATE)"))
def _(s, d):
    from countflow.operators.joins import attach_calendar

    return attach_calendar(table(s, d, "orders"), calendar(s, d), "o_orderdate").select(c("o_orderkey").alias("k"), "is_holiday", "day_off", "days_off_in_run")


@query("w5_between_named", sql("holidays", CAL + " SELECT date, holiday_name FROM cal WHERE is_holiday"))
def _(s, d):
    return calendar(s, d).filter("is_holiday").select("date", "holiday_name")


@query("w11_separated_peaks", sql("daily", """, x AS (SELECT date, sum(vehicles) AS v FROM daily GROUP BY 1), p1 AS (SELECT date, v FROM x ORDER BY v DESC, date LIMIT 1), x2 AS (SELECT x.* FROM x, p1 WHERE abs(x.date - p1.date) >= 7), p2 AS (SELECT date, v FROM x2 ORDER BY v DESC, date LIMIT 1), x3 AS (SELECT x2.* FROM x2, p2 WHERE abs(x2.date - p2.date) >= 7), p3 AS (SELECT date, v FROM x3 ORDER BY v DESC, date LIMIT 1)
SELECT 'all' AS g, date, CAST(v AS BIGINT) AS v, 1 AS rank FROM p1 UNION ALL SELECT 'all', date, CAST(v AS BIGINT), 2 FROM p2 UNION ALL SELECT 'all', date, CAST(v AS BIGINT), 3 FROM p3"""))
def _(s, d):
    x = daily(s, d).groupBy(F.lit("all").alias("g"), "date").agg(F.sum("vehicles").alias("v"))
    return wn.separated_peaks(x, ["g"], "date", "v")
