"""DuckDB SQL for each registered query, written independently of the DataFrame code."""

from __future__ import annotations

from .queries import HAZARDS, LABELS, LEVERAGES, WEIGHTS

_U1 = "u(etf, tier, points) AS (VALUES ('signup','Scout',40.0::DOUBLE),('purchase','Quant',40.0),('view','Quality',30.0),('click','Trend',10.0),('error','Blob',2.0))"
_U2 = """u0(i, etf, tier, points) AS (VALUES (0,'CSD','Scout',40.0::DOUBLE),(1,'FPX','Scout',40),(2,'QMOM','Quant',40),(3,'XMMO','Quant',40),(4,'XSMO','Quant',40),(5,'PIE','Quant',40),
(6,'FPXI','Scout',60),(7,'IMOM','Quant',60),(8,'PDP','Quant',40),(9,'DWAS','Quant',40),(10,'EEMO','Quant',60),(11,'PIZ','Quant',60),(12,'COWZ','Quality',30),(13,'CALF','Quality',30),
(14,'SPHQ','Quality',30),(15,'IVAL','Quality',30),(16,'SPMO','Trend',10),(17,'SPHB','Trend',10),(18,'RPG','Trend',10),(19,'XLG','Blob',2),(20,'QQQM','Blob',2)), u AS (SELECT etf, tier, points FROM u0)"""
_H1 = """cells AS (SELECT event_type AS etf, 'U' || user_id AS ticker, CAST(ts AS DATE) AS d, 'User ' || min(user_id) AS name, sum(value) AS v FROM events GROUP BY 1, 2, 3),
h AS (SELECT etf, ticker, d, name, v / sum(v) OVER (PARTITION BY etf, d) AS w FROM cells)"""
_H2 = """cells AS (SELECT u0.etf, 'P' || l_partkey AS ticker, CAST(date_trunc('month', l_shipdate) AS DATE) AS d, 'P' || l_partkey AS name, sum(l_extendedprice * (1 - l_discount)) AS v
FROM lineitem JOIN u0 ON u0.i = l_suppkey % 21 GROUP BY 1, 2, 3, 4), h AS (SELECT etf, ticker, d, name, v / sum(v) OVER (PARTITION BY etf, d) AS w FROM cells)"""
_SCORE = """dates AS (SELECT DISTINCT etf, d FROM h),
aof AS (SELECT s, etf, max(d) AS d FROM snap JOIN dates ON d <= s GROUP BY s, etf),
cut AS (SELECT s, max(d) - 14 AS since FROM aof GROUP BY s),
seen AS (SELECT etf, ticker, min(d) AS first_seen FROM h GROUP BY 1, 2),
ranked AS (SELECT a.s, h.*, row_number() OVER (PARTITION BY a.s, h.etf ORDER BY h.w DESC, h.ticker) AS rank, first_seen >= since AS is_new, tier, points
  FROM aof a JOIN h USING (etf, d) JOIN cut USING (s) JOIN seen USING (etf, ticker) JOIN u USING (etf)),
scored AS (SELECT *, CASE WHEN rank <= 10 THEN 1.5 WHEN rank <= 30 THEN 1.2 ELSE 1.0 END AS mult, CASE WHEN is_new AND tier IN ('Scout','Quant') THEN points * 5 ELSE 0.0 END AS bonus,
  w * 100 * points * (CASE WHEN rank <= 10 THEN 1.5 WHEN rank <= 30 THEN 1.2 ELSE 1.0 END) AS base FROM ranked),
agg AS (SELECT s, ticker, min_by(name, (etf, rank)) AS company, round(sum(base + bonus), 6) AS sc, count(DISTINCT etf) AS etf_count, sum(w) AS ws,
  string_agg(DISTINCT etf, ', ' ORDER BY etf) AS held_by, string_agg(DISTINCT tier, ' + ' ORDER BY tier) AS tiers, bool_or(is_new) AS any_new, CAST(min(rank) AS INTEGER) AS best_rank,
  CASE WHEN count(DISTINCT etf) >= 4 THEN 'HIGH_CONVICTION' WHEN bool_or(tier = 'Trend') AND NOT bool_or(tier IN ('Quality','Scout')) THEN 'SPECULATIVE_BETA' ELSE '' END AS flag
  FROM scored GROUP BY s, ticker),
board AS (SELECT s AS snapshot_date, ticker, company, CAST(trunc(sc) AS BIGINT) AS final_score, etf_count, round(ws, 6) AS total_weight, held_by, tiers, any_new, best_rank, flag,
  CAST(row_number() OVER (PARTITION BY s ORDER BY sc DESC, etf_count DESC, round(ws, 9) DESC, ticker) AS INTEGER) AS leaderboard_rank FROM agg)"""


def _with(*parts: str) -> str:
    return "WITH " + ",\n".join(parts)


_ALL = "snap AS (SELECT DISTINCT d AS s FROM h)"
_LAST = "snap AS (SELECT max(d) AS s FROM h)"
F1_LAST = _with(_U1, _H1, _LAST, _SCORE)
F1_ALL = _with(_U1, _H1, _ALL, _SCORE)
F2_LAST = _with(_U2, _H2, _LAST, _SCORE)
F2_ALL = _with(_U2, _H2, "snap AS (SELECT DISTINCT d AS s FROM h WHERE d >= (SELECT max(d) FROM h) - 3700)", _SCORE)
_CAL = "cal AS (SELECT s, row_number() OVER (ORDER BY s) AS i, count(*) OVER () AS n FROM snap), ends AS (SELECT max(s) AS today, max(CASE WHEN i = n - 1 THEN s END) AS yday FROM cal)"
_BOARD = "SELECT ticker, company, final_score, etf_count, total_weight, held_by, tiers, any_new, best_rank, flag, leaderboard_rank FROM board"
_DELTA = """span AS (SELECT etf, max(d) AS now, min(d) AS lo FROM h GROUP BY etf), per(p) AS (VALUES (1), (7), (14), (30), (60), (90)),
target AS (SELECT span.etf, p, now, coalesce((SELECT max(d) FROM dates x WHERE x.etf = span.etf AND x.d <= now - p), lo) AS prior FROM span, per),
rk AS (SELECT *, CAST(row_number() OVER (PARTITION BY etf, d ORDER BY w DESC, ticker) AS INTEGER) AS r FROM h),
delta AS (SELECT t.etf, n.ticker, t.p, n.r AS rank_now, o.r AS rank_then, o.r - n.r AS rank_delta, n.w AS weight_now, o.w AS weight_then, (n.w - o.w) / nullif(o.w, 0) AS flow
  FROM target t JOIN rk n ON n.etf = t.etf AND n.d = t.now LEFT JOIN rk o ON o.etf = t.etf AND o.d = t.prior AND o.ticker = n.ticker)"""
_STREAK = """obs AS (SELECT ticker, snapshot_date AS s, final_score AS sc, flag, row_number() OVER (PARTITION BY ticker ORDER BY snapshot_date DESC) AS back,
  lag(final_score) OVER (PARTITION BY ticker ORDER BY snapshot_date) AS prev, count(*) OVER (PARTITION BY ticker) AS n FROM board),
lastob AS (SELECT ticker, s, CASE WHEN s = (SELECT today FROM ends) THEN sc END AS now, prev AS was, n, sign(sc - prev) AS sg FROM obs WHERE back = 1),
run AS (SELECT o.ticker, coalesce(min(CASE WHEN o.prev IS NULL OR sign(o.sc - o.prev) <> l.sg THEN o.back END), 0) - 1 AS len FROM obs o JOIN lastob l USING (ticker) GROUP BY 1),
pr AS (SELECT o.ticker, count(*) AS k, avg(CASE WHEN o.sc < l.now THEN 1.0 ELSE 0.0 END) AS share FROM obs o JOIN lastob l USING (ticker) WHERE o.s < (SELECT today FROM ends) GROUP BY 1),
hcs AS (SELECT t.ticker, CAST(max(cal.n) - coalesce(max(CASE WHEN b.flag IS DISTINCT FROM 'HIGH_CONVICTION' THEN cal.i END), 0) AS INTEGER) AS hc_streak
  FROM (SELECT DISTINCT ticker FROM board) t CROSS JOIN cal LEFT JOIN board b ON b.ticker = t.ticker AND b.snapshot_date = cal.s GROUP BY 1),
streaks AS (SELECT l.ticker, now AS score_today, was AS score_yesterday, now - was AS score_delta, round((now - was)::DOUBLE / nullif(was, 0), 4) AS score_delta_pct,
  CAST(coalesce(CASE WHEN l.sg = 0 THEN 0 ELSE len * l.sg END, 0) AS INTEGER) AS score_streak, CAST(n AS INTEGER) AS days_observed, hc_streak,
  CASE WHEN k >= 3 AND now IS NOT NULL THEN round(share, 3) END AS score_percentile
  FROM lastob l JOIN run USING (ticker) JOIN hcs USING (ticker) LEFT JOIN pr USING (ticker))"""
_MOTION = """win AS (SELECT c.s, count(*) AS n_cal, min(x.s) AS lo, list(x.s ORDER BY x.s DESC)[1:10] AS recent FROM cal c JOIN cal x ON x.s BETWEEN c.s - 30 AND c.s GROUP BY c.s),
mo AS (SELECT b.snapshot_date, b.ticker, any_value(b.leaderboard_rank) AS r, any_value(n_cal) AS n_cal, max(CASE WHEN o.snapshot_date = lo THEN o.leaderboard_rank END) AS first_r,
  max(o.leaderboard_rank) AS hi, min(o.leaderboard_rank) AS best, count(*) AS n_obs, quantile_cont(o.leaderboard_rank, 0.5) AS mid,
  list(o.leaderboard_rank) FILTER (list_contains(recent, o.snapshot_date)) AS rr
  FROM board b JOIN win ON win.s = b.snapshot_date JOIN board o ON o.ticker = b.ticker AND o.snapshot_date BETWEEN b.snapshot_date - 30 AND b.snapshot_date GROUP BY 1, 2),
motion AS (SELECT snapshot_date, ticker, CASE WHEN n_cal >= 5 THEN first_r - r END AS global_rank_delta_30d, CASE WHEN n_cal >= 5 THEN hi - best END AS global_rank_peak_30d,
  CASE WHEN n_cal >= 5 THEN best END AS global_rank_best_30d, round(n_obs / n_cal, 4) AS coverage, CAST(len(list_filter(rr, lambda x: x < mid)) AS INTEGER) AS sustained,
  n_cal >= 5 AND hi - best >= 40 AND n_obs / n_cal >= 0.8 AND len(list_filter(rr, lambda x: x < mid)) >= 8 AS burst_30d FROM mo)"""
_NEAR = "near AS (SELECT min_by(s, (abs(s - ((SELECT max(s) FROM snap) - 30)), s)) AS t FROM snap)"
_META = "meta AS (SELECT 'U' || c_custkey AS ticker, c_mktsegment AS sector, n_name AS country FROM customer JOIN nation ON n_nationkey = c_nationkey)"
_ENRICH = """mm AS (SELECT ticker, round_even(coalesce(avg(rank_delta) FILTER (p = 7), 0), 2) AS r7, round_even(coalesce(avg(flow) FILTER (p = 7), 0), 4) AS f7, round_even(coalesce(avg(rank_delta) FILTER (p = 30), 0), 2) AS r30 FROM delta GROUP BY 1),
pre AS (SELECT b.ticker, b.etf_count, b.total_weight, b.flag, b.tiers, mm.r7, mm.f7, mm.r30, m.global_rank_delta_30d AS g, m.global_rank_peak_30d AS pk, coalesce(m.burst_30d, false) AS burst_30d, st.score_streak AS st, st.score_delta_pct AS dp,
  coalesce(o.etf_count, b.etf_count) AS past, b.etf_count - coalesce(o.etf_count, b.etf_count) AS dc
  FROM board b LEFT JOIN mm USING (ticker) LEFT JOIN motion m ON m.ticker = b.ticker AND m.snapshot_date = b.snapshot_date LEFT JOIN streaks st ON st.ticker = b.ticker
  LEFT JOIN board o ON o.ticker = b.ticker AND o.snapshot_date = (SELECT t FROM near) WHERE b.snapshot_date = (SELECT today FROM ends)),
en AS (SELECT pre.*, CAST(round_even(round(0.5 * greatest(-200, least(200, coalesce(g, 0))) + 0.25 * greatest(0, least(200, coalesce(pk, 0))) + coalesce(r7, 0) + 20 * coalesce(f7, 0) + 5 * dc
  + greatest(-10, least(10, coalesce(st, 0))), 6), 2) AS DOUBLE) AS vel, coalesce(meta.sector, 'Unknown') AS sector, coalesce(meta.country, 'Unknown') AS country FROM pre LEFT JOIN meta USING (ticker))"""
F1_STREAK = _with(_U1, _H1, _ALL, _SCORE, _CAL, _STREAK)
F1_MOTION = _with(_U1, _H1, _ALL, _SCORE, _CAL, _MOTION)
F1_RICH = _with(_U1, _H1, _ALL, _SCORE, _CAL, _DELTA, _STREAK, _MOTION, _NEAR, _META, _ENRICH)
_PX = "px AS (SELECT 'U' || user_id AS symbol, CAST(ts AS DATE) AS date, avg(value) AS close FROM events GROUP BY 1, 2 UNION ALL SELECT 'SPX', CAST(ts AS DATE), avg(value) FROM events GROUP BY 2)"
_HIST = """hrk AS (SELECT *, row_number() OVER (PARTITION BY etf, d ORDER BY w DESC, ticker) AS r FROM h),
hto AS (SELECT aof.s, aof.etf, aof.d AS now, coalesce(max(x.d) FILTER (x.d <= aof.d - 7), min(x.d)) AS prior FROM aof JOIN dates x ON x.etf = aof.etf GROUP BY 1, 2, 3),
hmm AS (SELECT t.s, n.ticker, round_even(coalesce(avg(o.r - n.r), 0), 2) AS r7, round_even(coalesce(avg((n.w - o.w) / nullif(o.w, 0)), 0), 4) AS f7
  FROM hto t JOIN hrk n ON n.etf = t.etf AND n.d = t.now LEFT JOIN hrk o ON o.etf = t.etf AND o.d = t.prior AND o.ticker = n.ticker GROUP BY 1, 2),
hs0 AS (SELECT snapshot_date AS s, ticker, sign(final_score - lag(final_score) OVER (PARTITION BY ticker ORDER BY snapshot_date)) AS sg, row_number() OVER (PARTITION BY ticker ORDER BY snapshot_date) AS i FROM board),
hst AS (SELECT s, ticker, coalesce(sg * row_number() OVER (PARTITION BY ticker, sg, g ORDER BY i), 0) AS st FROM (SELECT *, i - row_number() OVER (PARTITION BY ticker, sg ORDER BY i) AS g FROM hs0)),
hnear AS (SELECT c.s, min_by(x.s, (abs(x.s - (c.s - 30)), x.s)) AS t FROM snap c JOIN snap x ON x.s <= c.s GROUP BY 1),
hist AS (SELECT m.*, CAST(round_even(round(0.5 * greatest(-200, least(200, coalesce(m.global_rank_delta_30d, 0))) + 0.25 * greatest(0, least(200, coalesce(m.global_rank_peak_30d, 0))) + coalesce(r7, 0) + 20 * coalesce(f7, 0)
  + 5 * (b.etf_count - coalesce(o.etf_count, b.etf_count)) + greatest(-10, least(10, coalesce(st, 0))), 6), 2) AS DOUBLE) AS velocity_score
  FROM motion m JOIN board b ON b.ticker = m.ticker AND b.snapshot_date = m.snapshot_date JOIN hnear ON hnear.s = m.snapshot_date LEFT JOIN board o ON o.ticker = m.ticker AND o.snapshot_date = hnear.t
  LEFT JOIN hmm ON hmm.ticker = m.ticker AND hmm.s = m.snapshot_date LEFT JOIN hst ON hst.ticker = m.ticker AND hst.s = m.snapshot_date)"""
_SIG = """hce AS (SELECT snapshot_date AS date, ticker, i, lag(i) OVER (PARTITION BY ticker ORDER BY i) AS p FROM board JOIN cal ON cal.s = snapshot_date WHERE flag = 'HIGH_CONVICTION'),
bue AS (SELECT snapshot_date AS date, ticker, i, lag(i) OVER (PARTITION BY ticker ORDER BY i) AS p FROM motion JOIN cal ON cal.s = snapshot_date WHERE burst_30d),
sig AS (SELECT 'hc_entry' AS strategy, date, ticker FROM hce WHERE p IS NULL OR p < i - 1
  UNION ALL SELECT 'burst_trigger', date, ticker FROM bue WHERE p IS NULL OR p < i - 1
  UNION ALL SELECT 'top10_score', snapshot_date, ticker FROM board WHERE isodow(snapshot_date) = 1 AND leaderboard_rank <= 10
  UNION ALL (SELECT 'top10_velocity', snapshot_date, ticker FROM hist WHERE isodow(snapshot_date) = 1 QUALIFY row_number() OVER (PARTITION BY snapshot_date ORDER BY velocity_score DESC, ticker) <= 10)
  UNION ALL SELECT 'baseline', s, 'SPX' FROM snap WHERE isodow(s) = 1)"""
_TRADES = """buy AS (SELECT sig.*, px.close AS entry, sig.date + 7 AS exit_date FROM sig ASOF JOIN px ON px.symbol = sig.ticker AND sig.date <= px.date),
trades AS (SELECT b.strategy, b.date, b.ticker, round(b.entry, 6) AS entry, round(nullif(px.close, 0), 6) AS exit, b.exit_date, round(nullif(px.close, 0) / nullif(b.entry, 0) - 1, 6) AS return_pct
  FROM buy b ASOF LEFT JOIN px ON px.symbol = b.ticker AND b.exit_date <= px.date)"""
F1_TRADES = _with(_U1, _H1, _ALL, _SCORE, _CAL, _MOTION, _HIST, _PX, _SIG, _TRADES)
F1_PAST = _with(_U1, _H1, _ALL, _SCORE, _CAL, _MOTION, _HIST, "past AS (SELECT b.*, x.burst_30d, x.velocity_score FROM board b JOIN hist x ON x.ticker = b.ticker AND x.snapshot_date = b.snapshot_date)")
_RUNS = """, st8 AS (SELECT *, CASE WHEN flag = 'HIGH_CONVICTION' THEN 'HC' WHEN burst_30d THEN 'BURST' WHEN velocity_score >= 15 THEN 'VELO' WHEN flag = 'SPECULATIVE_BETA' THEN 'SPEC' ELSE 'Neutral' END AS state,
  row_number() OVER (PARTITION BY ticker ORDER BY snapshot_date) AS i FROM past WHERE snapshot_date >= (SELECT max(s) FROM snap) - 90),
isl AS (SELECT *, i - row_number() OVER (PARTITION BY ticker, state ORDER BY i) AS g FROM st8), runs AS (SELECT ticker, state, min(snapshot_date) AS first_day, max(snapshot_date) AS last_day, count(*) AS n_snapshots FROM isl GROUP BY ticker, state, g)"""
F1_WORDS = F1_RICH + """, cc AS (SELECT ticker, CAST(round_even(round(100 * coalesce(max(base + bonus) / nullif(sum(base + bonus), 0), 1), 6), 0) AS INTEGER) AS conc FROM scored WHERE s = (SELECT max(s) FROM snap) GROUP BY ticker),
q AS (SELECT s, ticker, etf FROM scored WHERE etf IN ('view', 'signup')), last AS (SELECT max(s) AS s FROM snap),
words AS (SELECT en.*, m.global_rank_best_30d AS best, conc, CAST(len(string_split(tiers, ' + ')) AS INTEGER) AS breadth, hst.hc_streak AS hc, CAST(round(CAST(dp AS DECIMAL(18,4)) * 100, 0) AS BIGINT) AS pc,
  EXISTS (SELECT 1 FROM q n WHERE n.ticker = en.ticker AND n.s = last.s AND NOT EXISTS (SELECT 1 FROM q o WHERE o.ticker = n.ticker AND o.etf = n.etf AND o.s = near.t)) AS adopted,
  EXISTS (SELECT 1 FROM q o WHERE o.ticker = en.ticker AND o.s = near.t AND NOT EXISTS (SELECT 1 FROM q n WHERE n.ticker = o.ticker AND n.etf = o.etf AND n.s = last.s)) AS defected
  FROM en CROSS JOIN near CROSS JOIN last JOIN cc USING (ticker) JOIN streaks hst ON hst.ticker = en.ticker JOIN motion m ON m.ticker = en.ticker AND m.snapshot_date = last.s)"""
_F4 = "px AS (SELECT event_type AS symbol, CAST(ts AS DATE) AS date, CAST(round(CAST(avg(value) AS DECIMAL(24,8)), 4) AS DOUBLE) AS close FROM events GROUP BY 1, 2)"
_F5 = "px AS (SELECT l_returnflag || l_linestatus AS symbol, CAST(l_shipdate AS DATE) AS date, CAST(round(CAST(avg(l_extendedprice / l_quantity) AS DECIMAL(24,8)), 4) AS DOUBLE) AS close FROM lineitem GROUP BY 1, 2)"
_RET = """r0 AS (SELECT *, (close - lag(close) OVER w) / nullif(abs(lag(close) OVER w), 0) AS ret, row_number() OVER (PARTITION BY symbol ORDER BY date DESC) AS back,
  row_number() OVER w AS i FROM px WINDOW w AS (PARTITION BY symbol ORDER BY date)),
r1 AS (SELECT *, coalesce(sign(ret), 0) AS sg FROM r0), r2 AS (SELECT *, i - row_number() OVER (PARTITION BY symbol, sg ORDER BY date) AS grp FROM r1),
r AS (SELECT symbol, date, close, ret, back, CAST(sg * row_number() OVER (PARTITION BY symbol, sg, grp ORDER BY date) AS INTEGER) AS streak FROM r2)"""
_STATS = """fin AS (SELECT symbol, max(date) AS last, max_by(close, date) AS today FROM r GROUP BY 1),
st AS (SELECT symbol, last AS last_date, round(today, 4) AS close_today, round(max(close) FILTER (back = 2), 4) AS close_yesterday,
  round((today - max(close) FILTER (back = 2)) / abs(nullif(max(close) FILTER (back = 2), 0)), 6) AS day_pct,
  round((today - max_by(close, date) FILTER (date <= last - 7)) / abs(nullif(max_by(close, date) FILTER (date <= last - 7), 0)), 6) AS week_pct,
  round((today - max_by(close, date) FILTER (date <= last - 30)) / abs(nullif(max_by(close, date) FILTER (date <= last - 30), 0)), 6) AS month_pct,
  round((today - min_by(close, date) FILTER (year(date) = year(last))) / abs(nullif(min_by(close, date) FILTER (year(date) = year(last)), 0)), 6) AS ytd_pct,
  round(min(close), 4) AS all_time_low, max_by(date, (-close, date)) AS all_time_low_date, round(max(close), 4) AS all_time_high, max_by(date, (close, date)) AS all_time_high_date,
  count(*) AS sessions_observed, max(streak) FILTER (back = 1) AS current_streak, count(*) FILTER (back <= 20 AND ret > 0) AS up_20d, count(*) FILTER (back <= 20 AND ret < 0) AS down_20d,
  round(avg(CASE WHEN close <= today THEN 1.0 ELSE 0.0 END), 4) AS all_time_percentile FROM r JOIN fin USING (symbol) GROUP BY symbol, last, today)"""
_SYN = "syn AS (SELECT i, {drift} / 100 / 252 + 0.015 * sin(0.31 * i) AS r FROM range({n}) t(i)), path AS (SELECT i, r, 100 * product(1 + {lev} * r - 0.95 / 100 / 252) OVER w AS nav, 100 * product(1 + r) OVER w AS u FROM syn WINDOW w AS (ORDER BY i ROWS UNBOUNDED PRECEDING))"
_SYN3, _SYN252 = _SYN.format(drift="10.0", n=252, lev=3), _SYN.format(drift="10.0", n=252, lev=2)


def _sig(e: str) -> str:
    """Nine significant digits."""
    return f"CAST(printf('%.8e', {e}) AS DOUBLE)"



_SIM = """d0 AS (SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY date DESC) AS back FROM px), d1 AS (SELECT symbol, date, close / lag(close) OVER (PARTITION BY symbol ORDER BY date) - 1 AS r FROM d0 WHERE back <= {n}),
d AS (SELECT symbol, date, {scale} AS r, CAST(row_number() OVER (PARTITION BY symbol ORDER BY date) AS INTEGER) AS i FROM d1 WHERE r IS NOT NULL),
lev(leverage) AS (VALUES {levs}), path AS (SELECT symbol, leverage, i, date, r, 100 * product(1 + leverage * r - 0.95 / 100 / 252) OVER w AS nav, 100 * product(1 + r) OVER w AS u FROM d, lev
  WINDOW w AS (PARTITION BY symbol, leverage ORDER BY i ROWS UNBOUNDED PRECEDING))"""
_HZ = f"hz(etf, ticker, name, w, d, scraped) AS (VALUES {HAZARDS})"
_CHANGE = """score_info AS (SELECT b.ticker, b.final_score, b.etf_count, b.snapshot_date, b.flag, s.score_today, s.score_delta, s.score_delta_pct FROM board b LEFT JOIN streaks s USING (ticker))"""

ORACLES: dict[str, str] = {
    "sanitize_holdings": _with(_HZ, r"""a AS (SELECT *, trim(ticker, E' \t\n\r') AS t FROM hz WHERE w IS NOT NULL AND d IS NOT NULL AND etf <> 'NOPE'),
        b AS (SELECT *, trim(regexp_replace(regexp_replace(t, '[-/ ]', '.', 'g'), '\.{2,}', '.', 'g'), '.') AS c FROM a WHERE t <> '' AND lower(t) NOT IN ('nan', 'usd', '$usd', 'cash&other', '-')
          AND (name IS NULL OR (NOT contains(upper(name), 'MONEY MARKET') AND upper(trim(name)) NOT IN ('CASH', 'OTHER', 'CASH & OTHER')))),
        e AS (SELECT *, CASE c WHEN 'GOOG' THEN 'GOOGL' ELSE c END AS k FROM b)
        SELECT etf AS ETF_Ticker, k AS ticker, min_by(name, ticker) FILTER (name IS NOT NULL) AS name, round(sum(w::DOUBLE), 6) AS weight, d AS Holdings_As_Of, max(scraped) AS Date_Scraped FROM e GROUP BY etf, k, d"""),
    "holdings_dedupe": _with(_U2, _H2) + r" SELECT etf AS ETF_Ticker, regexp_replace(ticker, '\d$', '') AS ticker, min(name) AS name, round(sum(w), 9) AS weight, d AS Holdings_As_Of FROM h GROUP BY 1, 2, 5",
    "parse_weights": f"WITH t(f, s, x) AS (VALUES {WEIGHTS}), n AS (SELECT f, s, coalesce(try_cast(replace(replace(x, '%', ''), ',', '') AS DOUBLE), 0) AS w FROM t) SELECT f AS ETF_Ticker, s AS ticker, round(CASE WHEN max(w) OVER (PARTITION BY f) > 1 THEN w / 100 ELSE w END, 9) AS weight FROM n",
    "parse_as_of_dates": f"""WITH t(label) AS (VALUES {LABELS}), x AS (SELECT label, regexp_extract(label, '(\\d{{1,2}}/\\d{{1,2}}/\\d{{4}})', 1) AS a, regexp_extract(replace(label, ',', ''), '([A-Z][a-z]+ \\d{{1,2}} \\d{{4}})', 1) AS b FROM t)
        SELECT label, CAST(coalesce(try_strptime(a, '%m/%d/%Y'), try_strptime(b, '%B %d %Y'), try_strptime(b, '%b %d %Y'), try_strptime(label, '%m-%d-%Y')) AS DATE) AS as_of FROM x""",
    "backup_arbitration": _with(_H1, """p AS (SELECT * FROM h),
        b AS (SELECT * REPLACE (d + CASE etf WHEN 'view' THEN -1 WHEN 'error' THEN 0 ELSE 1 END AS d) FROM h),
        c AS (SELECT e.etf, (SELECT count(*) FROM p WHERE p.etf = e.etf) AS np, (SELECT count(*) FROM b WHERE b.etf = e.etf) AS nb, (SELECT max(d) FROM p WHERE p.etf = e.etf) AS dp, (SELECT max(d) FROM b WHERE b.etf = e.etf) AS db FROM (SELECT DISTINCT etf FROM h) e),
        k AS (SELECT etf, nb > 0 AND (np = 0 OR (np < 5 AND nb > 5) OR coalesce(db > dp AND NOT (nb <= 15 AND np > 15), false)) AS ub FROM c)
        SELECT p.etf AS ETF_Ticker, ticker, d AS Holdings_As_Of, 'primary' AS origin FROM p JOIN k USING (etf) WHERE NOT ub UNION ALL SELECT b.etf, ticker, d, 'backup' FROM b JOIN k USING (etf) WHERE ub"""),
    "keep_last_upsert": "SELECT event_type, user_id, CAST(ts AS DATE) AS day, value, event_id AS load_seq FROM events QUALIFY row_number() OVER (PARTITION BY event_type, user_id, CAST(ts AS DATE) ORDER BY event_id DESC) = 1",
    "new_data_check": "WITH l AS (SELECT event_type, CAST(ts AS DATE) AS day, user_id, event_id AS load_seq FROM events) SELECT * FROM l WHERE day >= DATE '2024-01-20' AND NOT EXISTS (SELECT 1 FROM l k WHERE k.day < DATE '2024-01-25' AND k.event_type = l.event_type AND k.day = l.day)",
    "latest_snapshot": F1_LAST + " SELECT etf AS ETF_Ticker, ticker, d AS Holdings_As_Of, round(w, 9) AS weight FROM scored",
    "rank_in_fund": F1_LAST + " SELECT etf AS ETF_Ticker, ticker, CAST(rank AS INTEGER) AS rank, CAST(mult AS DOUBLE) AS rank_mult FROM scored",
    "new_entrants_flag": F1_LAST + " SELECT etf AS ETF_Ticker, ticker, is_new, bonus AS new_bonus FROM scored",
    "scored_holdings": F1_LAST + " SELECT etf AS ETF_Ticker, ticker, tier, points AS tier_points, round(w * 100, 6) AS weight_pct, round(base, 6) AS base_score, round(base + bonus, 6) AS score FROM scored",
    "leaderboard": F1_LAST + " " + _BOARD,
    "leaderboard_volume": F2_LAST + " " + _BOARD,
    "leaderboard_as_of": _with(_U1, _H1.replace("), \nh AS", "), h AS").replace("FROM events GROUP", "FROM events WHERE CAST(ts AS DATE) <= DATE '2024-01-15' GROUP"), _LAST, _SCORE) + " " + _BOARD,
    "conviction_flags": F1_LAST + " SELECT flag, count(*) AS n, max(etf_count) AS most_funds FROM board GROUP BY flag",
    "panel_scores": F1_ALL + " SELECT snapshot_date, ticker, final_score, etf_count, flag, leaderboard_rank FROM board",
    "panel_scores_volume": F2_ALL + " SELECT snapshot_date, count(*) AS tickers, CAST(sum(final_score) AS BIGINT) AS total_score, count(*) FILTER (flag = 'HIGH_CONVICTION') AS high_conviction FROM board GROUP BY 1",
    "score_panel_wide": F1_ALL + " SELECT ticker, " + ", ".join(f"max(final_score) FILTER (snapshot_date = DATE '2024-01-{d}') AS d202401{d}" for d in ("01", "15", "30")) + " FROM board GROUP BY ticker",
    "flag_panel": F1_ALL + " SELECT t.ticker, snap.s AS snapshot_date, coalesce(b.flag, '') AS flag FROM (SELECT DISTINCT ticker FROM board) t CROSS JOIN snap LEFT JOIN board b ON b.ticker = t.ticker AND b.snapshot_date = snap.s",
    "flag_history_nested": F1_ALL + " SELECT ticker, snapshot_date AS d, flag, leaderboard_rank AS rank FROM board",
    "rank_deltas_multi": _with(_U1, _H1, _LAST, _SCORE, _DELTA) + " SELECT etf AS ETF_Ticker, ticker, p AS period_days, rank_now, rank_then, rank_delta FROM delta",
    "weight_flow": _with(_U1, _H1, _LAST, _SCORE, _DELTA) + " SELECT etf AS ETF_Ticker, ticker, round(weight_now, 9) AS weight_now, round(weight_then, 9) AS weight_then, round(flow, 6) AS weight_flow FROM delta WHERE p = 7",
    "score_streaks": F1_STREAK + " SELECT ticker, score_today, score_yesterday, score_delta, score_delta_pct, score_streak, days_observed FROM streaks",
    "hc_streaks": F1_STREAK + " SELECT ticker, hc_streak FROM streaks",
    "score_percentile": F1_STREAK + " SELECT ticker, score_percentile FROM streaks",
    "state_durations": F1_ALL + """, x AS (SELECT ticker, snapshot_date, CASE flag WHEN '' THEN 'Neutral' ELSE flag END AS state, row_number() OVER (PARTITION BY ticker ORDER BY snapshot_date) AS i FROM board),
        y AS (SELECT *, i - row_number() OVER (PARTITION BY ticker, state ORDER BY i) AS g FROM x) SELECT ticker, state, min(snapshot_date) AS first_day, max(snapshot_date) AS last_day, count(*) AS n_snapshots FROM y GROUP BY ticker, state, g""",
    "changelog_hc": F1_STREAK + ", " + _CHANGE + """, t AS (SELECT * FROM score_info WHERE snapshot_date = (SELECT today FROM ends)), y AS (SELECT * FROM score_info WHERE snapshot_date = (SELECT yday FROM ends)),
        c AS (SELECT 'entered_hc' AS change, * FROM t WHERE flag = 'HIGH_CONVICTION' AND ticker NOT IN (SELECT ticker FROM y WHERE flag = 'HIGH_CONVICTION')
          UNION ALL SELECT 'exited_hc', * FROM y WHERE flag = 'HIGH_CONVICTION' AND ticker NOT IN (SELECT ticker FROM t WHERE flag = 'HIGH_CONVICTION')),
        r AS (SELECT *, CAST(row_number() OVER (PARTITION BY change ORDER BY final_score DESC, ticker) AS INTEGER) AS position FROM c) SELECT change, position, ticker, final_score, etf_count, score_delta FROM r WHERE position <= 15""",
    "changelog_movers": F1_STREAK + ", " + _CHANGE + """, t AS (SELECT * FROM score_info WHERE snapshot_date = (SELECT today FROM ends) AND score_delta_pct IS NOT NULL AND score_today >= 20),
        c AS (SELECT 'biggest_gainers' AS change, -score_delta_pct AS o, * FROM t WHERE score_delta_pct > 0 UNION ALL SELECT 'biggest_losers', score_delta_pct, * FROM t WHERE score_delta_pct < 0),
        r AS (SELECT *, CAST(row_number() OVER (PARTITION BY change ORDER BY o, ticker) AS INTEGER) AS position FROM c) SELECT change, position, ticker, final_score, etf_count, score_delta FROM r WHERE position <= 15""",
    "new_tickers_week": F1_STREAK + ", " + _CHANGE + """, c AS (SELECT *, CAST(row_number() OVER (ORDER BY final_score DESC, ticker) AS INTEGER) AS position FROM score_info WHERE snapshot_date = (SELECT today FROM ends)
          AND ticker NOT IN (SELECT ticker FROM board WHERE snapshot_date <= (SELECT today FROM ends) - 7)) SELECT 'new_entrants' AS change, position, ticker, final_score, etf_count, score_delta FROM c WHERE position <= 15""",
    "concentration": F1_LAST + " SELECT ticker, round_even(coalesce(max(base + bonus) / nullif(sum(base + bonus), 0), 1), 3) AS top_etf_share, CAST(round_even(round(100 * coalesce(max(base + bonus) / nullif(sum(base + bonus), 0), 1), 6), 0) AS INTEGER) AS concentration_score FROM scored GROUP BY ticker",
    "score_decomposition": F1_LAST + ", x AS (SELECT *, (base + bonus) / nullif(sum(base + bonus) OVER (PARTITION BY ticker), 0) AS sh FROM scored) SELECT ticker, etf AS ETF_Ticker, round(base + bonus, 6) AS score, round(sh, 4) AS share, CASE WHEN max(sh) OVER (PARTITION BY ticker) >= 0.7 THEN 'Concentrated' ELSE 'Diversified' END AS kind FROM x",
    "tier_breadth": F1_LAST + " SELECT ticker, CAST(count(DISTINCT tier) AS INTEGER) AS tier_breadth FROM scored GROUP BY ticker",
    "score_delta_periods": F1_ALL + ", per(p) AS (VALUES (1), (7), (14)), m AS (SELECT max(s) AS t FROM snap) SELECT n.ticker, CAST(p AS VARCHAR) AS period, round_even(greatest(-10, least(10, (n.final_score - o.final_score)::DOUBLE / abs(nullif(o.final_score, 0)))), 4) AS score_delta_pct FROM board n CROSS JOIN per CROSS JOIN m LEFT JOIN board o ON o.ticker = n.ticker AND o.snapshot_date = t - p WHERE n.snapshot_date = t",
    "ytd_delta": F1_ALL + ", m AS (SELECT max(s) AS t FROM snap) SELECT n.ticker, 'YTD' AS period, round_even(greatest(-10, least(10, (n.final_score - o.final_score)::DOUBLE / abs(nullif(o.final_score, 0)))), 4) AS score_delta_pct FROM board n CROSS JOIN m LEFT JOIN board o ON o.ticker = n.ticker AND o.snapshot_date = date_trunc('year', t) WHERE n.snapshot_date = t",
    "global_rank_panel_stats": F1_MOTION + " SELECT snapshot_date, ticker, global_rank_delta_30d, global_rank_peak_30d, global_rank_best_30d, coverage FROM motion",
    "burst": F1_MOTION + " SELECT snapshot_date, ticker, sustained, burst_30d FROM motion",
    "velocity": F1_RICH + " SELECT ticker, r7 AS avg_rank_delta_7d, r30 AS avg_rank_delta_30d, past AS etf_count_30d_ago, dc AS etf_count_delta_30d, vel AS velocity_score FROM en",
    "top_velocity": F1_RICH + " SELECT ticker, vel AS velocity_score, etf_count FROM en WHERE etf_count >= 2 ORDER BY vel DESC, ticker LIMIT 15",
    "divergence_regime": F1_RICH + """ SELECT ticker, CASE WHEN coalesce(dp, 0) > 0 AND coalesce(g, 0) < 0 THEN -1 WHEN coalesce(dp, 0) < 0 AND coalesce(g, 0) > 0 THEN 1 ELSE 0 END AS conviction_divergence,
        CASE WHEN vel > 15 AND st > 3 THEN 'accelerating' WHEN vel > 5 AND st > 0 THEN 'rising' WHEN vel < -15 AND st < -3 THEN 'declining' WHEN vel < -5 AND st < 0 THEN 'weakening' ELSE 'stable' END AS momentum_regime,
        CAST(len(string_split(tiers, ' + ')) AS INTEGER) AS tier_breadth FROM en""",
    "stealth_accumulation": F1_RICH + " SELECT ticker, coalesce(f7 > 0.03 AND r7 < 1 AND etf_count >= 3, false) AS stealth_accumulation FROM en",
    "quality_change": _with(_U1, _H1, _ALL, _SCORE, _NEAR) + """, q AS (SELECT s, ticker, etf FROM scored WHERE etf IN ('view', 'signup')) SELECT b.ticker,
        EXISTS (SELECT 1 FROM q n WHERE n.ticker = b.ticker AND n.s = b.snapshot_date AND NOT EXISTS (SELECT 1 FROM q o WHERE o.ticker = n.ticker AND o.etf = n.etf AND o.s = (SELECT t FROM near))) AS quality_adopted_30d,
        EXISTS (SELECT 1 FROM q o WHERE o.ticker = b.ticker AND o.s = (SELECT t FROM near) AND NOT EXISTS (SELECT 1 FROM q n WHERE n.ticker = o.ticker AND n.etf = o.etf AND n.s = b.snapshot_date)) AS quality_defected_30d
        FROM board b WHERE b.snapshot_date = (SELECT max(s) FROM snap)""",
    **{f"{d}_flow": F1_RICH + f""" SELECT {d} AS label, CAST(sum(CAST(vel AS DECIMAL(18,2))) AS DOUBLE) AS net_velocity,
        sign(sum(CAST(vel AS DECIMAL(18,2)))) * ((2 * abs(CAST(sum(CAST(vel AS DECIMAL(18,2))) * 100 AS BIGINT)) + count(*)) // (2 * count(*))) / 100 AS avg_velocity, count(*) AS names,
        CAST(round(sum(CAST(total_weight AS DECIMAL(18,6))), 4) AS DOUBLE) AS total_weight, count(*) FILTER (burst_30d) AS burst_count,
        count(*) FILTER (flag = 'HIGH_CONVICTION') AS hc_count FROM en WHERE etf_count >= 2 GROUP BY {d}""" for d in ("sector", "country")},
    **{n: base + """, sz AS (SELECT etf, count(DISTINCT ticker) AS n FROM scored GROUP BY etf), sh AS (SELECT a.etf AS ea, b.etf AS eb, count(*) AS k FROM scored a JOIN scored b USING (ticker) GROUP BY 1, 2),
        ov AS (SELECT a.etf AS etf_a, b.etf AS etf_b, a.n AS size_a, b.n AS size_b, coalesce(k, 0) AS shared, round(coalesce(k, 0) / (a.n + b.n - coalesce(k, 0)), 4) AS jaccard FROM sz a CROSS JOIN sz b LEFT JOIN sh ON ea = a.etf AND eb = b.etf)""" + out
       for n, base, out in (("fund_overlap", F1_LAST, " SELECT * FROM ov"), ("fund_overlap_volume", F2_LAST, " SELECT * FROM ov"),
                            ("top_overlap_pairs", F1_LAST, " SELECT etf_a, etf_b, shared, jaccard FROM ov WHERE etf_a < etf_b ORDER BY jaccard DESC, etf_a, etf_b LIMIT 10"))},
    "holdings_history_rank": _with(_H1) + " SELECT etf AS ETF_Ticker, ticker, d AS Holdings_As_Of, CAST(row_number() OVER (PARTITION BY etf, d ORDER BY w DESC, ticker) AS INTEGER) AS rank, round(w, 6) AS weight FROM h WHERE d >= (SELECT max(d) FROM h) - 120",
    "holdings_latest_wide": _with(_U1, _H1, _LAST, _SCORE, _DELTA) + " SELECT etf AS ETF_Ticker, ticker, max(rank_now) AS rank, max(rank_delta) FILTER (p = 7) AS rank_delta, max(rank_delta) FILTER (p = 1) AS rank_delta_1d, max(rank_delta) FILTER (p = 14) AS rank_delta_14d, max(rank_delta) FILTER (p = 30) AS rank_delta_30d FROM delta GROUP BY 1, 2",
    "score_sparkline": F1_ALL + " SELECT ticker, snapshot_date AS d, final_score AS s FROM board WHERE ticker IN (SELECT ticker FROM board WHERE leaderboard_rank <= 200 AND snapshot_date = (SELECT max(s) FROM snap))",
    "kpi_counts": F1_ALL + " SELECT snapshot_date, count(*) AS tickers, count(*) FILTER (flag = 'HIGH_CONVICTION') AS high_conviction, count(*) FILTER (flag = 'SPECULATIVE_BETA') AS speculative_beta, count(*) FILTER (flag = '') AS unflagged, count(*) FILTER (any_new) AS new_tickers FROM board WHERE snapshot_date IN (SELECT s FROM snap ORDER BY s DESC LIMIT 2) GROUP BY 1",
    **{n: F1_TRADES + f" SELECT * FROM trades WHERE strategy = '{s}'" for n, s in (("hc_entry_trades", "hc_entry"), ("burst_trades", "burst_trigger"), ("top10_score_trades", "top10_score"), ("top10_velocity_trades", "top10_velocity"), ("baseline_trades", "baseline"))},
    "trade_stats": F1_TRADES + """, c AS (SELECT *, product(1 + return_pct) OVER (PARTITION BY strategy ORDER BY date, ticker ROWS UNBOUNDED PRECEDING) AS wealth FROM trades WHERE return_pct IS NOT NULL),
        f AS (SELECT *, wealth / nullif(max(wealth) OVER (PARTITION BY strategy ORDER BY date, ticker ROWS UNBOUNDED PRECEDING), 0) - 1 AS fall FROM c),
        g AS (SELECT strategy, count(*) AS n, round(avg(CASE WHEN return_pct > 0 THEN 1.0 ELSE 0.0 END), 4) AS win_rate, round(avg(return_pct), 4) AS avg_return, round(min(fall), 4) AS max_drawdown, round(avg(return_pct) / nullif(round(stddev_pop(return_pct), 12), 0) * sqrt(12), 3) AS sharpe FROM f GROUP BY 1)
        SELECT a.strategy, coalesce(n, k) AS n_trades, win_rate, avg_return, max_drawdown, sharpe FROM (SELECT strategy, count(*) AS k FROM trades GROUP BY 1) a LEFT JOIN g USING (strategy)""",
    "cumulative_returns": F1_TRADES + " SELECT strategy, ticker, exit_date, round(product(1 + return_pct) OVER (PARTITION BY strategy ORDER BY exit_date, ticker, date ROWS UNBOUNDED PRECEDING) - 1, 4) AS total_return FROM trades WHERE return_pct IS NOT NULL",
    "return_at_date": F1_TRADES + """, c AS (SELECT strategy, ticker, exit_date, round(product(1 + return_pct) OVER (PARTITION BY strategy ORDER BY exit_date, ticker, date ROWS UNBOUNDED PRECEDING) - 1, 4) AS total_return FROM trades WHERE return_pct IS NOT NULL),
        l AS (SELECT strategy, exit_date, max_by(total_return, ticker) AS total_return FROM c GROUP BY 1, 2), g AS (SELECT DISTINCT c.strategy, s AS date FROM c, snap) SELECT g.strategy, g.date, l.total_return FROM g ASOF LEFT JOIN l ON l.strategy = g.strategy AND g.date >= l.exit_date""",
    **{n: _with(_U1, _H1, _ALL, _SCORE, _CAL, _MOTION, _HIST, _PX, "sig AS (SELECT 'scatter' AS strategy, snapshot_date AS date, ticker FROM hist)", _TRADES,
             "pts AS (SELECT t.ticker, t.date, m.velocity_score, t.return_pct AS realized_return FROM trades t JOIN hist m ON m.ticker = t.ticker AND m.snapshot_date = t.date WHERE return_pct IS NOT NULL)") + out
       for n, out in (("velocity_scatter", " SELECT * FROM pts"), ("scatter_regression", " SELECT count(*) AS n, round(coalesce(corr(velocity_score, realized_return) ** 2, 0), 4) AS r2, round(regr_slope(realized_return, velocity_score), 6) AS slope, round(regr_intercept(realized_return, velocity_score), 6) AS intercept FROM pts"))},
    "series_stats": _with(_F4, _RET, _STATS) + " SELECT * FROM st",
    "series_stats_long": _with(_F5, _RET, _STATS) + " SELECT * FROM st",
    "price_log": _with(_F5, _RET) + ", l AS (SELECT *, cume_dist() OVER (PARTITION BY symbol ORDER BY close) AS lv FROM r) SELECT symbol, date AS d, round(close, 4) AS close, round(ret, 6) AS pct, streak, round(lv, 4) AS level FROM l WHERE back <= 200",
    "price_bars": _with(_F4, _RET) + " SELECT symbol, date AS d, round(greatest(2.0, coalesce(abs(round(ret, 6)) / nullif(max(abs(round(ret, 6))) OVER (PARTITION BY symbol), 0), 0) * 22.0), 4) AS height FROM r WHERE back <= 200",
    "streak_runs": _with(_F5, _RET) + " SELECT symbol, max(streak) AS longest_up, min(streak) AS longest_down FROM r GROUP BY 1",
    "series_search": _with(_F4, _RET, _STATS, "lab(symbol, label, kind) AS (VALUES ('click', 'Clicks', 'web'), ('view', 'Page views', 'web'), ('purchase', 'Purchases', 'shop'), ('signup', 'Sign-ups', 'shop'))") + " SELECT symbol, label, kind, sessions_observed, round(up_20d / (up_20d + down_20d), 4) AS up_ratio FROM st JOIN lab USING (symbol) WHERE contains(lower(symbol), 'c') OR contains(lower(label), 'c')",
    "sim_underlyings": _with(_F5, _RET) + " SELECT symbol, date AS d, round(close, 4) AS c FROM r WHERE back <= 2520",
    "nav_simulation": _with(_F5, _SIM.format(n=252, scale="r", levs="(2.0::DOUBLE)")) + f" SELECT symbol, leverage, i, date, {_sig('nav')} AS nav, {_sig('u')} AS underlying FROM path",
    "synthetic_simulation": _with(_SYN3) + " SELECT 3.0::DOUBLE AS leverage, i, round(nav, 6) AS nav, round(u, 6) AS underlying FROM path",
    "decay_metrics": _with(_SYN252) + """, e AS (SELECT max_by(nav, i) AS nav, max_by(u, i) AS u, stddev_pop(r) AS s, count(*) AS n FROM path) SELECT 2.0::DOUBLE AS leverage, round(nav - 100, 4) AS etn_total_pct, round(u - 100, 4) AS underlying_total_pct,
        round(2 * (u - 100), 4) AS expected_lev, round(nav - 100 - 2 * (u - 100), 4) AS drag_pct, round(s * 100, 6) AS sigma_d, round(s * sqrt(252) * 100, 4) AS sigma_a, round(s * s * 252 * 100, 6) AS annual_decay, round(nav, 4) AS final_nav, n AS sessions FROM e""",
    "leverage_grid": _with(_F5, _SIM.format(n=252, scale="r", levs=", ".join(f"({x}::DOUBLE)" for x in LEVERAGES))) + """, e AS (SELECT symbol, leverage, max_by(nav, i) AS nav, max_by(u, i) AS u, stddev_pop(r) AS s, count(*) AS sessions FROM path GROUP BY 1, 2),
        x AS (SELECT symbol, leverage, round(nav - 100, 4) AS a, round(u - 100, 4) AS b, round(nav - 100 - leverage * (u - 100), 4) AS c, round(s * 100, 6) AS sd, round(0.5 * (leverage * leverage - abs(leverage)) * s * s * 252 * 100, 6) AS ad, sessions FROM e)
        SELECT symbol, leverage, """ + f"{_sig('a')} AS etn_total_pct, {_sig('b')} AS underlying_total_pct, {_sig('c')} AS drag_pct, {_sig('sd')} AS sigma_d, {_sig('ad')} AS annual_decay, sessions FROM x",
    "nested_holdings": F1_LAST + " SELECT h.ticker, h.etf AS ETF_Ticker, CAST(count(*) AS INTEGER) AS n, max(h.d) AS last_day FROM h JOIN board USING (ticker) WHERE leaderboard_rank <= 300 AND h.d >= (SELECT max(d) FROM h) - 120 GROUP BY 1, 2",
    "parse_headers": """SELECT * FROM (VALUES ('T0', 'a1', 'Alpha', 0.6::DOUBLE), ('T0', 'a2', 'Beta', 10.0), ('T0', NULL, 'None', 0.0), ('T1', 'b1', 'Gamma', 0.4), ('T1', 'b2', 'Delta', 0.6),
        ('T2', 'c1', 'Eps', 0.0), ('T2', 'c2', NULL, 0.0)) AS t(ETF_Ticker, ticker, name, weight)""",
    "vendor_payloads": _with(_H1) + " SELECT etf AS ETF_Ticker, ticker, name || ' & Co' AS name, round(w * 100 / 100, 6) AS weight, d AS Holdings_As_Of FROM h WHERE etf <> 'error' AND round(w * 100 / 100, 6) > 0",
    "load_statuses": _with(_H1) + """ SELECT f.etf AS ETF_Ticker, count(h.etf) AS rows, CASE WHEN count(h.etf) = 0 THEN 'empty' WHEN f.etf IN ('view', 'click') THEN 'written' ELSE 'skipped' END AS status
        FROM (VALUES ('signup'), ('purchase'), ('view'), ('click'), ('error'), ('none')) f(etf) LEFT JOIN h ON h.etf = f.etf AND h.d = (SELECT max(d) FROM h) GROUP BY f.etf""",
    "series_refresh": _with(_F4) + " SELECT symbol, date, close FROM px WHERE date <= DATE '2024-01-20' OR close >= (SELECT avg(close) FROM px o WHERE o.symbol = px.symbol)",
    "csv_round_trip": _with(_H1) + " SELECT etf AS ETF_Ticker, count(*) AS n_rows, count(DISTINCT ticker) AS tickers, max(d) AS last_day, round(sum(w), 6) AS weight FROM h GROUP BY 1",
    "archive_round_trip": _with(_H1) + """ SELECT layout, etf AS ETF_Ticker, d AS Holdings_As_Of, count(*) AS n_rows FROM h JOIN (VALUES ('latest', 'view', DATE '2024-01-30'), ('latest', 'click', DATE '2024-01-30'), ('latest', 'error', DATE '2024-01-28'),
        ('history', 'view', DATE '2024-01-28'), ('history', 'click', DATE '2024-01-28'), ('history', 'error', DATE '2024-01-28'), ('history', 'view', DATE '2024-01-29'), ('history', 'click', DATE '2024-01-29'),
        ('history', 'view', DATE '2024-01-30')) k(layout, f, day) ON f = etf AND day = d GROUP BY 1, 2, 3""",
    "document_round_trip": F1_ALL + " SELECT ticker, snapshot_date AS d, flag, leaderboard_rank AS rank FROM board",
    "summary_counts": F1_ALL + """, k AS (SELECT snapshot_date, count(*) FILTER (flag = 'HIGH_CONVICTION') AS hc, count(*) FILTER (flag = '') AS none, row_number() OVER (ORDER BY snapshot_date DESC) AS back FROM board GROUP BY 1)
        SELECT (SELECT count(*) FROM h) AS source_rows_raw, (SELECT count(*) FROM h) AS source_rows_after_sanitize, (SELECT max(d) FROM h) AS latest_holdings_as_of, CAST((SELECT count(DISTINCT etf) FROM h) AS INTEGER) AS funds,
        CAST((SELECT count(*) FROM snap) AS INTEGER) AS snapshots, max(hc) FILTER (back = 1) AS hc_today, max(hc) FILTER (back = 2) AS hc_yesterday, max(none) FILTER (back = 1) AS unflagged_today FROM k""",
    "score_delta_map": F1_ALL + """, m AS (SELECT max(s) AS t FROM snap), per(period, day) AS (SELECT CAST(p AS VARCHAR), t - p FROM m, (VALUES (1), (7), (14), (30), (60), (90)) q(p) UNION ALL SELECT 'YTD', CAST(date_trunc('year', t) AS DATE) FROM m)
        SELECT n.ticker, period, round_even(greatest(-10, least(10, (n.final_score - o.final_score)::DOUBLE / abs(nullif(o.final_score, 0)))), 4) AS score_delta_pct
        FROM board n CROSS JOIN per CROSS JOIN m LEFT JOIN board o ON o.ticker = n.ticker AND o.snapshot_date = day WHERE n.snapshot_date = t""",
    "series_kinds": "SELECT * FROM (VALUES ('web', 2::BIGINT), ('shop', 2)) t(kind, n)",
    "metadata_build": _with(_U2, _H2, _META) + " SELECT t.ticker, coalesce(sector, 'Unknown') AS sector, 'Unknown' AS industry, coalesce(country, 'Unknown') AS country FROM (SELECT DISTINCT ticker FROM h) t LEFT JOIN meta ON meta.ticker = 'U' || substr(t.ticker, 2)",
    "compare_top": F1_LAST + " SELECT CAST(row_number() OVER (ORDER BY final_score DESC, ticker) AS INTEGER) AS place, ticker, final_score FROM board WHERE etf_count >= 2 ORDER BY final_score DESC, ticker LIMIT 4",
    "remaining_weight": F1_LAST + " SELECT etf AS ETF_Ticker, count(*) FILTER (rank <= 10) AS slices, round(sum(w) FILTER (rank <= 10), 6) AS shown, round(greatest(0, 1 - sum(w) FILTER (rank <= 10)), 6) AS remaining FROM scored GROUP BY 1",
    "time_travel": F1_ALL + " SELECT b.ticker, b.flag AS flag_then, b.leaderboard_rank AS rank_then, (SELECT count(*) FROM scored n WHERE n.ticker = b.ticker AND n.s = (SELECT max(s) FROM snap)) AS funds_now FROM board b WHERE b.snapshot_date = DATE '2024-01-15'",
    "watchlist_changes": F1_PAST + """, e AS (SELECT t.ticker, coalesce(a.flag = 'HIGH_CONVICTION', false) AS was, coalesce(z.flag = 'HIGH_CONVICTION', false) AS is_hc, coalesce(a.burst_30d, false) AS wb, coalesce(z.burst_30d, false) AS ib
          FROM (SELECT DISTINCT ticker FROM past) t LEFT JOIN past a ON a.ticker = t.ticker AND a.snapshot_date = (SELECT max(s) FROM snap WHERE s <= DATE '2024-01-20') LEFT JOIN past z ON z.ticker = t.ticker AND z.snapshot_date = (SELECT max(s) FROM snap)),
        c AS (SELECT ticker, 'entered_hc' AS change FROM e WHERE is_hc AND NOT was UNION ALL SELECT ticker, 'exited_hc' FROM e WHERE was AND NOT is_hc UNION ALL SELECT ticker, 'new_burst' FROM e WHERE ib AND NOT wb)
        SELECT * FROM c UNION ALL SELECT ticker, 'none' FROM e WHERE ticker NOT IN (SELECT ticker FROM c)""",
    "signal_timeline": F1_PAST + _RUNS + " SELECT ticker, state, first_day, last_day, n_snapshots, last_day = (SELECT max(s) FROM snap) AS holds FROM runs",
    "signal_days": F1_PAST + _RUNS + " SELECT ticker, state, CAST(sum(n_snapshots) AS BIGINT) AS n_snapshots, count(*) AS runs FROM runs GROUP BY 1, 2",
    "explainer_lines": F1_WORDS + """ SELECT ticker, concat_ws(' · ', 'Held by ' || etf_count || CASE etf_count WHEN 1 THEN ' ETF' ELSE ' ETFs' END || ' across ' || breadth || CASE breadth WHEN 1 THEN ' tier' ELSE ' tiers' END,
        'Score ' || CASE WHEN pc >= 0 THEN '+' ELSE '-' END || abs(pc) || '%',
        CASE WHEN burst_30d THEN 'BURST ' || CASE WHEN g >= 0 THEN '+' ELSE '-' END || abs(g) || ' ranks (best #' || best || ')' WHEN vel >= 15 THEN 'VELO +' || CAST(round(CAST(vel AS DECIMAL(18,2)), 0) AS BIGINT) END,
        CASE WHEN hc > 0 THEN 'HC ' || hc || 'd' END, CASE WHEN adopted THEN 'Quality+ in 30d' END, CASE WHEN defected THEN 'Quality- in 30d' END, CASE WHEN conc > 70 THEN 'Concentrated ' || conc || '%' END,
        CASE WHEN f7 > 0.03 AND r7 < 1 AND etf_count >= 3 THEN 'Stealth accumulation' END,
        CASE WHEN coalesce(dp, 0) > 0 AND coalesce(g, 0) < 0 THEN 'Score up, rank down' WHEN coalesce(dp, 0) < 0 AND coalesce(g, 0) > 0 THEN 'Score down, rank up' END) AS sentence FROM words""",
    "filter_chips": F1_WORDS + """ SELECT 'velo' AS chip, ticker FROM words WHERE vel >= 15 UNION ALL SELECT 'burst', ticker FROM words WHERE burst_30d UNION ALL SELECT 'quality', ticker FROM words WHERE adopted
        UNION ALL SELECT 'spread', ticker FROM words WHERE conc <= 80 UNION ALL SELECT 'building', ticker FROM words WHERE conc <= 80 AND sector = 'BUILDING'""",
}
