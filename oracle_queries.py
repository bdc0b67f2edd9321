"""DuckDB oracle for the registered queries: long-form SQL over the driver tables.

The Spark side works on packed arrays; this side works on one row per (series, day), so the two
formulations are independent. Doubles are rounded to 6 places on both sides.
"""

from __future__ import annotations

import datetime as dt

T = dt.date(2001, 11, 5)
Y = T - dt.timedelta(days=1)


def _d(x: dt.date) -> str:
    return f"DATE '{x.isoformat()}'"


def ctes() -> str:
    t, y = _d(T), _d(Y)
    return f"""
raw AS (
  SELECT l_suppkey AS sk, l_suppkey % 10 AS kind, CASE WHEN l_suppkey % 10 IN (6, 7) AND l_linenumber = 1 THEN 2 ELSE 1 END AS cp,
         CASE WHEN l_suppkey % 10 = 8 AND l_returnflag = 'A' THEN 'FBP'
              ELSE CASE l_returnflag WHEN 'A' THEN 'Self' WHEN 'N' THEN 'FBP' WHEN 'R' THEN '3rd' END END AS d,
         CASE WHEN l_linestatus = 'F' THEN 'Normal'
              ELSE ['Fresh1', 'Fresh2', 'Direct', 'Frozen', 'DeepFrozen'][(l_suppkey // 10) % 5 + 1] END AS o,
         CAST(l_shipdate AS DATE) AS ship, l_quantity FROM lineitem),
placed AS (
  SELECT *, CASE WHEN kind = 6 AND cp = 2 THEN 250 WHEN kind = 7 AND cp = 2 THEN 300 WHEN kind = 3 THEN 415
                 WHEN kind = 4 THEN 381 WHEN kind = 5 THEN 200 ELSE 500 END AS n_days,
         CASE WHEN kind = 4 THEN {t} - 120 ELSE {y} END AS end_date FROM raw),
daily AS (
  SELECT sk, kind, cp, d, o, n_days, end_date,
         end_date - CAST(datediff('day', ship, {y}) % n_days AS INTEGER) AS ds, CAST(sum(l_quantity) AS BIGINT) AS qty
  FROM placed GROUP BY ALL),
series AS (
  SELECT CAST(k.sk AS VARCHAR) AS sta_num, k.d AS deliver_type, k.o AS ord_type,
         CASE WHEN k.kind = 6 AND k.cp = 2 AND k.d = 'Self' THEN '自营' ELSE k.d END AS raw_d,
         CASE WHEN k.kind = 6 AND k.cp = 2 AND k.o = 'Normal' THEN '普通' ELSE k.o END AS raw_o,
         k.sk || '|' || k.d || '|' || k.o || '|' || k.cp AS sid, k.sk, k.kind, k.cp, n.n_nationkey AS nk, n.n_name,
         n.n_regionkey, coalesce(['North', 'South', 'East', 'Northwest', 'Southwest', 'Middle', 'Northeast'][n.n_nationkey % 8 + 1],
                                 r.r_name) AS r_name,
         k.end_date - CAST(k.n_days - 1 AS INTEGER) AS start_date, CAST(k.n_days AS BIGINT) AS n_days
  FROM (SELECT DISTINCT sk, kind, cp, d, o, n_days, end_date FROM daily) k
  JOIN supplier s ON s.s_suppkey = k.sk
  JOIN nation n ON n.n_nationkey = s.s_nationkey
  JOIN region r ON r.r_regionkey = n.n_regionkey),
long AS (
  SELECT s.sid, s.sta_num, s.raw_d, s.raw_o, s.deliver_type, s.ord_type, s.start_date, s.n_days, CAST(g.i AS BIGINT) AS idx,
         s.start_date + CAST(g.i AS INTEGER) AS ds,
         CASE WHEN k.qty IS NULL AND s.kind = 9 AND g.i % 97 = 13 THEN NULL ELSE coalesce(k.qty, 0) END AS qty
  FROM series s CROSS JOIN generate_series(0, s.n_days - 1) g(i)
  LEFT JOIN daily k ON k.sk = s.sk AND k.cp = s.cp AND k.d = s.deliver_type AND k.o = s.ord_type
   AND k.ds = s.start_date + CAST(g.i AS INTEGER)),
fresh AS (SELECT * FROM series WHERE datediff('day', start_date, {y}) - n_days <= 90),
dedup AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY sta_num, deliver_type, ord_type
                                 ORDER BY n_days DESC, start_date DESC) AS rn FROM fresh)
  WHERE rn = 1),
s60 AS (
  SELECT d.sid, d.sta_num, d.deliver_type, d.ord_type, CAST(coalesce(sum(l.qty), 0) AS BIGINT) AS sum60
  FROM dedup d LEFT JOIN long l
    ON l.sid = d.sid AND l.idx >= greatest(d.n_days, datediff('day', d.start_date, {y})) - 60
  GROUP BY 1, 2, 3, 4),
ratio AS (
  SELECT o.sta_num, o.deliver_type, o.ord_type, o.sum60, b.sum60 AS base60,
         CASE WHEN b.sum60 = 0 THEN 1.0 ELSE o.sum60 / b.sum60 END AS ratio
  FROM s60 o JOIN s60 b ON b.sta_num = o.sta_num AND b.deliver_type = 'Self' AND b.ord_type = 'Normal'
  WHERE NOT (o.deliver_type = 'Self' AND o.ord_type = 'Normal'))"""


def q(body: str) -> str:
    return f"WITH {ctes()}\n{body}"


KEY = "sta_num, deliver_type, ord_type"
RAW = "sta_num, raw_d AS deliver_type, raw_o AS ord_type"  # as the source spells them
ORD_CODE = "CASE d.ord_type WHEN 'Fresh2' THEN '5' WHEN 'Fresh1' THEN '4' WHEN 'Direct' THEN '3' WHEN 'Normal' THEN '2' WHEN 'Frozen' THEN '1' WHEN 'DeepFrozen' THEN '0' END"
REGION_CODE = "CASE WHEN d.nk % 8 < 7 THEN CAST(d.nk % 8 + 1 AS VARCHAR) ELSE CAST(d.n_regionkey + 1 AS VARCHAR) END"

SQL = {
    "s1_series": q(f"SELECT {RAW}, ds, qty FROM long WHERE qty <> 0"),
    "s1_series_meta": q(f"""SELECT {RAW}, r_name AS region_name, CAST(nk AS VARCHAR) AS area_id, n_name AS area_name,
        'S' || sta_num AS sta_name, CAST(n_regionkey AS VARCHAR) AS province_id, CAST(nk AS VARCHAR) AS city_id,
        CASE WHEN sk % 20 = 11 THEN '' ELSE sta_num END AS county_id, start_date, CAST(n_days AS INTEGER) AS n_days FROM series"""),
    "f1_base_class": q(f"SELECT {RAW}, start_date, CAST(n_days AS INTEGER) AS n_days FROM series "
                       "WHERE deliver_type = 'Self' AND ord_type = 'Normal'"),
    "f2_other_classes": q(f"SELECT {RAW}, start_date, CAST(n_days AS INTEGER) AS n_days FROM series "
                          "WHERE NOT (deliver_type = 'Self' AND ord_type = 'Normal')"),
    "f3_fresh": q(f"""SELECT {RAW}, start_date, CAST(n_days AS INTEGER) AS n_days,
        CAST(datediff('day', start_date, {_d(Y)}) - n_days AS INTEGER) AS missing_days FROM fresh"""),
    "a1_dedupe_longest": q(f"""SELECT d.sta_num, d.deliver_type, d.ord_type, d.start_date,
        CAST(d.n_days AS INTEGER) AS n_days, CAST(sum(l.qty) AS BIGINT) AS qty_total
        FROM dedup d JOIN long l USING (sid) GROUP BY 1, 2, 3, 4, 5"""),
    "a2_sum60": q(f"SELECT {KEY}, sum60 FROM s60"),
    "j1_class_ratio": q(f"SELECT {KEY}, sum60, base60, round(ratio, 6) AS ratio FROM ratio"),
    "p4_encode": q(f"""SELECT d.sta_num, d.deliver_type, d.ord_type, d.r_name AS region_name,
        CASE d.deliver_type WHEN 'Self' THEN '2' WHEN 'FBP' THEN '0' WHEN '3rd' THEN '1' END AS fr_type,
        {ORD_CODE} AS ord_code, {REGION_CODE} AS region_id FROM dedup d"""),
}


# ---- features -------------------------------------------------------------------------------------------------

THR = T - dt.timedelta(days=35 + 395)   # young-station threshold
PRE_END = T - dt.timedelta(days=8)      # forecast feature day


def feature_ctes(rows: str) -> str:
    """CTEs computing ``feat(sta_num, deliver_type, ord_type, pre_end, path, idx, value)`` for the feature rows
    ``rows(sta_num, deliver_type, ord_type, n_regionkey, start_date, n_days, pre_end)``."""
    return f""",
cref AS (
  SELECT city_id, std_sta, ref_sid, ref_start FROM (
    SELECT CAST(nk AS VARCHAR) AS city_id, sta_num AS std_sta, sid AS ref_sid, start_date AS ref_start,
           row_number() OVER (PARTITION BY nk ORDER BY sk) AS rn
    FROM series WHERE deliver_type = 'Self' AND ord_type = 'Normal' AND kind IN (0, 1, 2) AND nk <> 7)
  WHERE rn = 1),
fx AS (
  SELECT r.sid, r.sta_num, r.start_date, r.n_days, r.pre_end, c.std_sta, c.ref_sid, c.ref_start,
         r.start_date > {_d(THR)} AS young,
         CASE WHEN r.start_date > {_d(THR)} THEN datediff('day', c.ref_start, r.start_date) ELSE 0 END AS sh,
         datediff('day', c.ref_start, r.start_date) AS fsh
  FROM {rows} r LEFT JOIN cref c ON c.city_id = CAST(r.nk AS VARCHAR)),
wdef AS (SELECT * FROM (VALUES (0, 30, 0), (1, 365, 335), (2, 395, 365)) t(w, lo_back, hi_back)),
fw AS (
  SELECT fx.*, wdef.w,
         datediff('day', fx.start_date, fx.pre_end - wdef.lo_back) AS plo,
         datediff('day', fx.start_date, fx.pre_end - wdef.hi_back) AS phi,
         CASE WHEN fx.young THEN fx.ref_sid ELSE fx.sid END AS src
  FROM fx CROSS JOIN wdef),
fel AS (
  SELECT fw.sid, fw.sta_num, fw.pre_end, fw.w, l.idx - (fw.plo + fw.sh) AS j, l.qty
  FROM fw JOIN long l ON l.sid = fw.src AND l.idx >= fw.plo + fw.sh AND l.idx < fw.phi + fw.sh
  WHERE fw.plo >= 0 AND fw.phi >= 0 AND fw.plo + fw.sh >= 0),
fst AS (
  SELECT sid, sta_num, pre_end, w, count(*) AS k, sum(qty) AS s, sum(qty * qty) AS q,
         count(qty) AS nn
  FROM fel GROUP BY ALL),
fin AS (
  SELECT e.*, st.k, st.nn,
         (st.k * e.qty - st.s) * (st.k * e.qty - st.s) < st.k * st.q - st.s * st.s AS inl
  FROM fel e JOIN fst st USING (sid, sta_num, pre_end, w)),
fmed AS (
  SELECT sid, sta_num, pre_end, w, median(qty) FILTER (WHERE inl) AS med,
         count(*) FILTER (WHERE inl) AS ninl, max(k) AS k, max(nn) AS nn
  FROM fin GROUP BY ALL),
fok AS (
  SELECT sid, sta_num, pre_end, count(*) AS nwin, sum(k) AS total
  FROM fmed WHERE ninl > 0 AND nn = k GROUP BY ALL),
fnorm AS (
  SELECT i.sid, i.sta_num, i.pre_end,
         CASE WHEN fx.young THEN 'city' ELSE 'own' END AS path, i.w * 30 + i.j AS idx,
         CASE WHEN i.inl THEN CAST(i.qty AS DOUBLE) ELSE m.med END AS value
  FROM fin i
  JOIN fmed m USING (sid, sta_num, pre_end, w)
  JOIN fok o USING (sid, sta_num, pre_end)
  JOIN fx USING (sid, sta_num, pre_end)
  WHERE o.nwin = 3 AND o.total = 90),
fbk AS (
  SELECT fx.*,
         datediff('day', fx.start_date, fx.pre_end - 30) AS p0,
         datediff('day', fx.start_date, fx.pre_end - 365) AS p1,
         datediff('day', fx.start_date, fx.pre_end - 395) AS p2
  FROM fx LEFT JOIN fok USING (sid, sta_num, pre_end)
  WHERE coalesce(fok.nwin, 0) < 3 AND fx.std_sta IS NOT NULL),
fbe AS (
  SELECT b.sid, b.sta_num, b.pre_end, 0 AS w, l.idx - b.p0 AS j, l.qty
  FROM fbk b JOIN long l ON l.sid = b.sid AND l.idx >= b.p0 AND l.idx < b.p0 + 30
  WHERE b.p0 >= 0
  UNION ALL
  SELECT b.sid, b.sta_num, b.pre_end, 1 AS w, l.idx - (b.p1 + b.fsh) AS j, l.qty
  FROM fbk b JOIN long l ON l.sid = b.ref_sid AND l.idx >= b.p1 + b.fsh AND l.idx < b.p1 + b.fsh + 30
  WHERE b.p1 + b.fsh >= 0
  UNION ALL
  SELECT b.sid, b.sta_num, b.pre_end, 2 AS w, l.idx - (b.p2 + b.fsh) AS j, l.qty
  FROM fbk b JOIN long l ON l.sid = b.ref_sid AND l.idx >= b.p2 + b.fsh AND l.idx < b.p2 + b.fsh + 30
  WHERE b.p2 + b.fsh >= 0),
fbs AS (
  SELECT sid, sta_num, pre_end,
         count(*) FILTER (WHERE w = 0) AS n0, count(*) FILTER (WHERE w = 1) AS n1,
         count(*) FILTER (WHERE w = 2) AS n2, count(qty) AS nn, count(*) AS n,
         coalesce(sum(qty) FILTER (WHERE w = 0), 0) AS s0, coalesce(sum(qty) FILTER (WHERE w = 2), 0) AS s2
  FROM fbe GROUP BY ALL),
fbv AS (
  SELECT e.sid, e.sta_num, e.pre_end, 'fallback' AS path, e.w * 30 + e.j AS idx,
         CASE WHEN e.w = 0 THEN CAST(e.qty AS DOUBLE)
              WHEN s.s0 <> 0 AND s.s2 <> 0 THEN CAST(e.qty AS DOUBLE) / (CAST(s.s2 AS DOUBLE) / CAST(s.s0 AS DOUBLE))
              ELSE 1.0 END AS value
  FROM fbe e JOIN fbs s USING (sid, sta_num, pre_end)
  WHERE s.n0 = 30 AND s.n1 = 30 AND s.n2 = 30 AND s.nn = s.n),
feat AS (SELECT * FROM fnorm UNION ALL SELECT * FROM fbv)"""


def forecast_rows() -> str:
    return f""",
frows AS (SELECT sid, sta_num, deliver_type, ord_type, nk, start_date, n_days, {_d(PRE_END)} AS pre_end
          FROM dedup WHERE deliver_type = 'Self' AND ord_type = 'Normal')"""


def training_rows() -> str:
    lo, hi = T - dt.timedelta(days=77), T - dt.timedelta(days=16)
    return f""",
trows AS (
  SELECT s.sid, s.sta_num, s.deliver_type, s.ord_type, s.nk, s.start_date, s.n_days,
         CAST(pe.d AS DATE) AS pre_end
  FROM series s CROSS JOIN generate_series({_d(lo)}, {_d(hi)}, INTERVAL 1 DAY) pe(d)
  WHERE s.deliver_type = 'Self' AND s.ord_type = 'Normal' AND s.start_date < CAST(pe.d AS DATE) - 395)"""


def fq(rows_fn, rows_name: str, body: str) -> str:
    return f"WITH {ctes()}{rows_fn()}{feature_ctes(rows_name)}\n{body}"


W3_SQL = f"""WITH {ctes()},
wb AS (
  SELECT d.sid, d.sta_num, d.deliver_type, d.ord_type, d.n_days, w.win,
         datediff('day', d.start_date, {_d(PRE_END)} - w.lo_back) AS plo,
         datediff('day', d.start_date, {_d(PRE_END)} - w.hi_back) AS phi
  FROM dedup d CROSS JOIN (VALUES ('pre', 30, 0), ('his', 365, 335), ('his_pre', 395, 365)) w(win, lo_back, hi_back)),
el AS (
  SELECT b.sid, b.sta_num, b.deliver_type, b.ord_type, b.win, l.idx - b.plo AS idx, l.qty
  FROM wb b JOIN long l USING (sid)
  WHERE b.plo >= 0 AND b.phi >= 0 AND l.idx >= b.plo AND l.idx < b.phi),
st AS (SELECT sid, win, count(*) AS k, count(qty) AS nn, sum(qty) AS s, sum(qty * qty) AS q
       FROM el GROUP BY ALL),
ei AS (SELECT e.*, st.k, st.nn, (st.k * e.qty - st.s) * (st.k * e.qty - st.s) < st.k * st.q - st.s * st.s AS inl
       FROM el e JOIN st USING (sid, win)),
md AS (SELECT sid, win, median(qty) FILTER (WHERE inl) AS med,
              count(*) FILTER (WHERE inl) AS ninl FROM ei GROUP BY ALL)
SELECT ei.sta_num, ei.deliver_type, ei.ord_type, ei.win, CAST(ei.idx AS INTEGER) AS idx,
       round(CASE WHEN ei.inl THEN CAST(ei.qty AS DOUBLE) ELSE md.med END, 6) AS value
FROM ei JOIN md USING (sid, win) WHERE md.ninl > 0 AND ei.k = ei.nn"""

SQL.update({
    "w1_windows": q(f"""SELECT sta_num, deliver_type, ord_type,
        {_d(PRE_END)} - 30 AS pre_from, {_d(PRE_END)} AS pre_to, {_d(PRE_END)} - 365 AS his_from,
        {_d(PRE_END)} - 335 AS his_to, {_d(PRE_END)} - 395 AS his_pre_from, {_d(PRE_END)} - 365 AS his_pre_to,
        CAST(datediff('day', start_date, {_d(PRE_END)} - 30) AS INTEGER) AS pos_pre,
        CAST(datediff('day', start_date, {_d(PRE_END)} - 365) AS INTEGER) AS pos_his,
        CAST(datediff('day', start_date, {_d(PRE_END)} - 395) AS INTEGER) AS pos_his_pre,
        CAST(datediff('day', start_date, {_d(T)}) AS INTEGER) AS pos_today
        FROM dedup WHERE deliver_type = 'Self' AND ord_type = 'Normal'"""),
    "w3_clean_window": W3_SQL,
    "w4_features": fq(forecast_rows, "frows",
                      "SELECT sta_num, path, CAST(idx AS INTEGER) AS idx, round(value, 6) AS value FROM feat"),
    "w4_feature_paths": fq(forecast_rows, "frows",
                           "SELECT sta_num, path, CAST(count(*) AS BIGINT) AS n_values FROM feat GROUP BY ALL"),
})


# ---- training set ------------------------------------------------------------------------------------------------

L_FIRST, L_LAST = T - dt.timedelta(days=35), T - dt.timedelta(days=8)

TRAIN_BODY = f"""SELECT CAST(h.h AS INTEGER) AS horizon, CAST(f.pre_end + CAST(8 + h.h AS INTEGER) AS DATE) AS label_date, f.sta_num, f.path,
       l.qty AS label, round(sum(f.value), 6) AS hist_sum, round(max(f.value), 6) AS hist_max,
       round(max(f.value) FILTER (WHERE f.idx = 0), 6) AS hist_first,
       round(max(f.value) FILTER (WHERE f.idx = 89), 6) AS hist_last
FROM feat f
CROSS JOIN generate_series(0, 34) h(h)
JOIN long l ON l.sid = f.sid AND l.ds = f.pre_end + CAST(8 + h.h AS INTEGER)
WHERE f.pre_end + CAST(8 + h.h AS INTEGER) BETWEEN {_d(L_FIRST)} AND {_d(L_LAST)} AND l.qty > 0
GROUP BY 1, 2, 3, 4, 5, f.sid"""

SQL.update({
    "w7_labels": q(f"""SELECT sta_num, ds AS label_date, qty AS label FROM long
        WHERE deliver_type = 'Self' AND ord_type = 'Normal' AND ds BETWEEN {_d(L_FIRST)} AND {_d(L_LAST)} AND qty > 0"""),
    "j5_training_set": fq(training_rows, "trows", TRAIN_BODY),
    **dict.fromkeys(["j5_training_features", "j5_feature_store"], fq(training_rows, "trows",
        "SELECT sta_num, pre_end, path, CAST(idx AS INTEGER) AS idx, round(value, 6) AS value FROM feat")),
})


# ---- allocation and report (seasonal-naive base forecast) ----------------------------------------------------------

W_REST = 7 - T.weekday()


def alloc_ctes() -> str:
    return f""",
bfc AS (
  SELECT d.sta_num, CAST(h.h AS INTEGER) AS h, CAST(coalesce(l.qty, 0) AS DOUBLE) AS fc
  FROM dedup d CROSS JOIN generate_series(0, 34) h(h)
  LEFT JOIN long l ON l.sid = d.sid AND l.ds = {_d(T)} - 35 + CAST(h.h AS INTEGER)
  WHERE d.deliver_type = 'Self' AND d.ord_type = 'Normal'),
oth AS (
  SELECT o.sta_num, o.deliver_type, o.ord_type, o.sum60, b.sum60 AS base60,
         CASE WHEN b.sum60 = 0 THEN 0.0 ELSE o.sum60 / b.sum60 END AS factor
  FROM s60 o JOIN s60 b ON b.sta_num = o.sta_num AND b.deliver_type = 'Self' AND b.ord_type = 'Normal'
  WHERE NOT (o.deliver_type = 'Self' AND o.ord_type = 'Normal')),
r35 AS (
  SELECT d.sta_num, d.deliver_type, d.ord_type, CAST(coalesce(sum(l.qty), 0) AS DOUBLE) AS r35
  FROM dedup d LEFT JOIN long l ON l.sid = d.sid AND l.idx >= d.n_days - 35
  GROUP BY 1, 2, 3),
alloc AS (
  SELECT o.sta_num, o.deliver_type, o.ord_type, f.h, f.fc * o.factor AS v, r.r35,
         sum(f.fc * o.factor) OVER (PARTITION BY o.sta_num, o.deliver_type, o.ord_type) AS total
  FROM oth o JOIN bfc f ON f.sta_num = o.sta_num
  JOIN r35 r ON r.sta_num = o.sta_num AND r.deliver_type = o.deliver_type AND r.ord_type = o.ord_type),
allocf AS (
  SELECT sta_num, deliver_type, ord_type, h, CASE WHEN total > 2 * r35 THEN r35 / 35 ELSE v END AS v,
         total, r35 FROM alloc)"""


def report_ctes() -> str:
    w, y = W_REST, _d(Y)
    return f""",
rp AS (
  SELECT d.*, greatest(d.n_days, datediff('day', d.start_date, {y}) + 1) AS P,
         datediff('day', d.start_date, {y}) + 1 AS real_len
  FROM dedup d),
plong AS (
  SELECT r.sta_num, r.deliver_type, r.ord_type, CAST(g.i AS BIGINT) AS i, CASE WHEN l.idx IS NULL THEN 0 ELSE l.qty END AS qty
  FROM rp r CROSS JOIN generate_series(0, r.P - 1) g(i)
  LEFT JOIN long l ON l.sid = r.sid AND l.idx = g.i),
ranges AS (
  SELECT sta_num, deliver_type, ord_type, 'cur' AS block, 0 AS part, greatest(P - 60, 0) AS lo, P AS hi FROM rp
  UNION ALL SELECT sta_num, deliver_type, ord_type, 'ago', 0, greatest(P - 424, 0), greatest(P - 364, 0)
  FROM rp WHERE real_len > 365
  UNION ALL SELECT sta_num, deliver_type, ord_type, 'ago', 1, greatest(P - 364, 0), greatest(P - 336, 0)
  FROM rp WHERE real_len > 365
  UNION ALL SELECT sta_num, deliver_type, ord_type, 'ago', 2, greatest(P - 336, 0), greatest(P - 336 + {w}, 0)
  FROM rp WHERE real_len > 365),
arr_vals AS (
  SELECT r.sta_num, r.deliver_type, r.ord_type, r.block, r.part, p.i - r.lo AS idx, CAST(p.qty AS DOUBLE) AS value
  FROM ranges r JOIN plong p ON p.sta_num = r.sta_num AND p.deliver_type = r.deliver_type
   AND p.ord_type = r.ord_type AND p.i >= r.lo AND p.i < r.hi),
roll AS (
  SELECT r.sta_num, r.deliver_type, r.ord_type, b.block, 3 AS part, 9 - j.j AS idx,
         CAST(coalesce(sum(p.qty), 0) AS DOUBLE) AS value
  FROM rp r CROSS JOIN generate_series(1, 9) j(j) CROSS JOIN (VALUES ('cur', -10), ('ago', -276 + {w})) b(block, e)
  LEFT JOIN plong p ON p.sta_num = r.sta_num AND p.deliver_type = r.deliver_type AND p.ord_type = r.ord_type
   AND p.i >= greatest(r.P + b.e - j.j - 7, 0) AND p.i < greatest(r.P + b.e - j.j, 0)
  WHERE b.block = 'cur' OR r.real_len > 365
  GROUP BY 1, 2, 3, 4, 5, 6),
rowfc AS (
  SELECT sta_num, 'Self' AS deliver_type, 'Normal' AS ord_type, h, fc AS v FROM bfc
  UNION ALL SELECT sta_num, deliver_type, ord_type, h, v FROM allocf),
fc_vals AS (
  SELECT sta_num, deliver_type, ord_type, 'cur' AS block, 1 AS part, h AS idx, v AS value FROM rowfc WHERE h < 28
  UNION ALL
  SELECT sta_num, deliver_type, ord_type, 'cur', 2, h - 28, v FROM rowfc WHERE h >= 28 AND h < 28 + {w}),
blocks AS (SELECT * FROM arr_vals UNION ALL SELECT * FROM roll UNION ALL SELECT * FROM fc_vals)"""


def aq(body: str, report: bool = False) -> str:
    return f"WITH {ctes()}{alloc_ctes()}{report_ctes() if report else ''}\n{body}"


SQL.update({
    "r2_allocate": aq("SELECT sta_num, deliver_type, ord_type, h, round(v, 6) AS value FROM allocf"),
    "r3_cap": aq("""SELECT DISTINCT sta_num, deliver_type, ord_type, round(total, 6) AS scaled_total,
        round(r35, 6) AS recent35, total > 2 * r35 AS capped FROM alloc"""),
    "r4_report_blocks": aq("""SELECT sta_num, deliver_type, ord_type, block, CAST(part AS INTEGER) AS part,
        CAST(idx AS INTEGER) AS idx, round(value, 6) AS value FROM blocks""", report=True),
    "r6_report": q(f"""SELECT {REGION_CODE} AS region_id, d.r_name AS region_name,
        CAST(d.nk AS VARCHAR) AS area_id, d.n_name AS area_name, d.sta_num, 'S' || d.sta_num AS sta_name, {_d(Y)} AS data_date,
        {_d(Y)} + CAST(7 - (isodow({_d(Y)}) - 1) AS INTEGER) AS next_monday,
        CASE d.deliver_type WHEN 'Self' THEN '2' WHEN 'FBP' THEN '0' WHEN '3rd' THEN '1' END AS fr_type,
        {ORD_CODE} AS ord_type, '1' AS delivered_flag, d.deliver_type, d.ord_type AS ord_name,
        datediff('day', d.start_date, {_d(Y)}) + 1 > 365 AS has_year_ago
        FROM dedup d"""),
    "w8_actuals": q(f"""SELECT l.sta_num, l.raw_d AS deliver_type, l.raw_o AS ord_type,
        CAST(datediff('day', {_d(T - dt.timedelta(days=35))}, l.ds) AS INTEGER) AS h, l.qty AS actual
        FROM long l JOIN series s USING (sid)
        WHERE datediff('day', s.start_date, {_d(T - dt.timedelta(days=35))}) >= 0
          AND datediff('day', s.start_date, {_d(T - dt.timedelta(days=35))}) + 35 <= s.n_days
          AND l.ds >= {_d(T - dt.timedelta(days=35))} AND l.ds < {_d(T)}"""),
})


SQL.update({
    "s1_series_text": q(f"""SELECT s.sta_num, s.raw_d AS deliver_type, s.raw_o AS ord_type, s.r_name AS region_name,
        CAST(s.nk AS VARCHAR) AS city_id, s.start_date, CAST(s.n_days AS INTEGER) AS n_days,
        CAST(sum(l.qty) AS BIGINT) AS qty_total
        FROM series s JOIN long l USING (sid) GROUP BY s.sid, 1, 2, 3, 4, 5, 6, 7"""),
    "j3_city_ref": fq(forecast_rows, "frows", """SELECT c.city_id, c.std_sta AS std_sta_num, c.ref_start,
        CAST(s.n_days AS INTEGER) AS n_days, CAST(sum(l.qty) AS BIGINT) AS qty_total
        FROM cref c JOIN series s ON s.sid = c.ref_sid JOIN long l ON l.sid = s.sid
        GROUP BY 1, 2, 3, 4"""),
})


def _path(name: str) -> str:
    return fq(forecast_rows, "frows", f"""SELECT sta_num, path, CAST(idx AS INTEGER) AS idx, round(value, 6) AS value
        FROM feat WHERE path = '{name}'""")


SQL.update({
    "w4_features_own": _path("own"),
    "w5_features_city": _path("city"),
    "w6_features_fallback": _path("fallback"),
    "w9_rolling7": aq("""SELECT sta_num, deliver_type, ord_type, CAST(idx AS INTEGER) AS idx, round(value, 6) AS value
        FROM blocks WHERE block = 'cur' AND part = 3""", report=True),
    "w12_year_ago": aq("""SELECT sta_num, deliver_type, ord_type, CAST(part AS INTEGER) AS part,
        CAST(idx AS INTEGER) AS idx, round(value, 6) AS value FROM blocks WHERE block = 'ago'""", report=True),
    "j5_training_grid": fq(training_rows, "trows", f"""SELECT horizon, label_date, CAST(count(*) AS BIGINT) AS n_rows,
        CAST(sum(label) AS BIGINT) AS label_total FROM ({TRAIN_BODY}) t GROUP BY 1, 2"""),
})


def _text(part: int, block: str) -> str:
    """The values of a block's part joined by commas, in order; '' without values."""
    return (f"coalesce((SELECT string_agg(txt, ',' ORDER BY idx) FROM shown b WHERE b.sta_num = d.sta_num AND b.deliver_type = "
            f"d.deliver_type AND b.ord_type = d.ord_type AND b.block = '{block}' AND b.part = {part}), '')")


_CUR = " || '$' || ".join(_text(i, "cur") for i in range(4))
_AGO = " || '$' || ".join(_text(i, "ago") for i in range(4))
_LINES = f"""SELECT '#' || {REGION_CODE} || '#' || d.r_name || '#' || d.nk || '#' || d.n_name || '#' || d.sta_num || '#S' || d.sta_num || '#'
    || strftime({_d(Y)}, '%Y-%m-%d') || '#' || strftime({_d(Y)} + CAST(7 - (isodow({_d(Y)}) - 1) AS INTEGER), '%Y-%m-%d') || '#'
    || CASE d.deliver_type WHEN 'Self' THEN '2' WHEN 'FBP' THEN '0' WHEN '3rd' THEN '1' END || '#' || {ORD_CODE} || '#1#'
    || {_CUR} || '#' || CASE WHEN datediff('day', d.start_date, {_d(Y)}) + 1 > 365 THEN {_AGO} ELSE '$$$' END || '#' AS value
    FROM dedup d"""
_SHOWN = """,
shown AS (
  SELECT *, CASE WHEN value IS NULL THEN '\\N' WHEN block = 'cur' AND part IN (1, 2)
                 THEN regexp_replace(CAST(CAST(value AS DECIMAL(38, 6)) AS VARCHAR), '(\\.\\d+?)0+$', '\\1')
                 ELSE CAST(CAST(value AS BIGINT) AS VARCHAR) END AS txt FROM blocks)"""


def lines_sql(body: str) -> str:
    return f"WITH {ctes()}{alloc_ctes()}{report_ctes()}{_SHOWN}\n{body}"


SQL.update({
    "r7_report_lines": lines_sql(_LINES),
    "s3_publish": lines_sql(f"""SELECT count(*) AS n_lines, count(DISTINCT value) AS n_distinct, CAST(5 AS BIGINT) AS n_files,
        CAST(5 AS BIGINT) AS n_deflate FROM ({_LINES}) t"""),
    "a7_crossmean": q(f"""SELECT sta_num, round(avg(CASE WHEN y > 0 THEN x / y ELSE 1 END), 6) AS scale FROM (
        SELECT d.sta_num, CAST(h.qty AS DOUBLE) AS x, CAST(r.qty AS DOUBLE) AS y FROM dedup d
        JOIN long h ON h.sid = d.sid AND h.ds >= {_d(PRE_END)} - 365 AND h.ds < {_d(PRE_END)} - 335 AND h.qty IS NOT NULL
        JOIN long r ON r.sid = d.sid AND r.ds >= {_d(PRE_END)} - 30 AND r.ds < {_d(PRE_END)} AND r.qty IS NOT NULL
        WHERE d.deliver_type = 'Self' AND d.ord_type = 'Normal' AND d.start_date <= {_d(PRE_END)} - 365) t GROUP BY 1"""),
    "m5_m6_model_dates": """SELECT as_of, as_of + CAST(7 - isodow(as_of) AS INTEGER) AS train_date,
        as_of + CAST(7 - isodow(as_of) AS INTEGER) - 7 AS read_date
        FROM (SELECT DISTINCT CAST(l_shipdate AS DATE) AS as_of FROM lineitem) t""",
    "m1_feature_vector": fq(forecast_rows, "frows", """SELECT f.sta_num, CAST(count(*) + 3 AS BIGINT) AS n,
        CAST(max(s.n_regionkey) AS DOUBLE) AS province, CAST(max(s.nk) AS DOUBLE) AS city,
        CAST(max(CASE WHEN s.sk % 20 = 11 THEN 0 ELSE s.sk END) AS DOUBLE) AS county
        FROM feat f JOIN series s ON s.sid = f.sid GROUP BY 1"""),
})
