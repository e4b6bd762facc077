"""SQL for the registered queries, written independently of the DataFrame code."""

from __future__ import annotations

WINDOWS = """
jumps AS (
  SELECT 'u' || user_id AS sig_key, ts, event_id, value,
    CASE WHEN epoch_us(ts) - epoch_us(lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id)) > 86400000000 THEN 1 ELSE 0 END AS jump
  FROM events WHERE value IS NOT NULL AND ts IS NOT NULL),
runs AS (SELECT *, sum(jump) OVER (PARTITION BY sig_key ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS grp FROM jumps),
found AS (
  SELECT sig_key, min(ts) AS start_ts, max(ts) AS end_ts, count(*) AS n, list(value ORDER BY ts, event_id) AS raw
  FROM runs GROUP BY sig_key, grp HAVING count(*) >= 5),
win AS (SELECT *, row_number() OVER (PARTITION BY sig_key ORDER BY start_ts) - 1 AS win_idx, max(n) OVER (PARTITION BY sig_key) AS most FROM found),
pad AS (SELECT *, list_concat(list_transform(raw, lambda v: v - list_avg(raw)), list_transform(range(0, most - n), lambda i: 0.0::DOUBLE)) AS x FROM win),
seg AS (SELECT *, list_avg(list_transform(range(0, 5), lambda k: list_max(x[k * (most // 5) + 1 : (k + 1) * (most // 5)]) - list_min(x[k * (most // 5) + 1 : (k + 1) * (most // 5)]))) AS mean_range FROM pad)
"""

VECTORS = """
vec AS (
  SELECT 'l' || label AS sig_key, vec_id, row_number() OVER (PARTITION BY label ORDER BY vec_id) - 1 AS win_idx,
    list_transform(embedding, lambda v: v::DOUBLE) AS x
  FROM embeddings),
reg AS (SELECT *, list_max(x) < 2.2 AS regular, list_avg(x) AS m, list_max(x) AS top, list_stddev_pop(x) AS sd FROM vec)
"""

# Centred samples one per row; pairs are joined on them lag by lag.
POINTS = VECTORS + ", pt AS (SELECT vec_id, unnest(range(0, len(x))) AS i, unnest(x) - m AS v FROM reg)"


def ncc(pairs: str, low: int, high: int, eps: str) -> str:
    """Best similarity per pair (id, a, b) over lags from low to high."""
    return f"""
lagged AS (
  SELECT p.id, pa.i - pb.i AS lag, sum(pa.v * pb.v) AS c FROM {pairs} p
  JOIN pt pa ON pa.vec_id = p.a JOIN pt pb ON pb.vec_id = p.b AND pa.i - pb.i BETWEEN {low} AND {high} GROUP BY 1, 2),
best AS (
  SELECT p.id, any_value(p.a) AS a, any_value(p.b) AS b,
    CASE WHEN any_value(ra.sd) * any_value(rb.sd) = 0 THEN 0 ELSE max(abs(l.c)) / (any_value(len(ra.x) * ra.sd * rb.sd){eps}) END AS ncc
  FROM {pairs} p JOIN lagged l USING (id) JOIN reg ra ON ra.vec_id = p.a JOIN reg rb ON rb.vec_id = p.b GROUP BY p.id)"""


EPS = " + 1e-12"
NEXT = ", nx AS (SELECT * FROM (SELECT vec_id AS id, lag(vec_id) OVER (PARTITION BY sig_key ORDER BY win_idx) AS a, vec_id AS b FROM reg) WHERE a IS NOT NULL)"
CHAIN = POINTS + NEXT + ", " + ncc("nx", -32, 31, EPS) + """,
flag AS (
  SELECT r.*, CASE WHEN lag(r.regular) OVER (PARTITION BY r.sig_key ORDER BY r.win_idx) AND b.ncc >= 0.3 THEN 0 ELSE 1 END AS start
  FROM reg r LEFT JOIN best b ON b.id = r.vec_id),
ev AS (SELECT *, sum(start) OVER (PARTITION BY sig_key ORDER BY win_idx ROWS UNBOUNDED PRECEDING) - 1 AS event_idx FROM flag WHERE regular),
ref AS (SELECT * FROM ev QUALIFY row_number() OVER (PARTITION BY sig_key, event_idx ORDER BY top DESC, win_idx) = 1)"""
MEASURE = CHAIN + ", rp AS (SELECT e.vec_id AS id, r.vec_id AS a, e.vec_id AS b FROM ev e JOIN ref r USING (sig_key, event_idx) WHERE e.win_idx <> r.win_idx), " + ncc("rp", -32, 31, EPS).replace("lagged", "lagged2").replace("best AS", "best2 AS") + """,
ms AS (
  SELECT e.*, r.win_idx AS ref_idx, coalesce(b.ncc, 0) AS ncc_vs_ref
  FROM ev e JOIN ref r USING (sig_key, event_idx) LEFT JOIN best2 b ON b.id = e.vec_id)"""
SPECTRUM = VECTORS + """,
sp AS (SELECT vec_id, unnest(range(0, len(x))) AS i, unnest(x) AS v, len(x) AS n FROM reg),
am AS (
  SELECT vec_id, f * 10.0 AS freq, sqrt(sum(v * cos(2 * pi() * f * 10 * i * 0.0002)) ** 2 + sum(v * sin(2 * pi() * f * 10 * i * 0.0002)) ** 2) * 2 / (any_value(n) - 1) AS amp
  FROM sp, range(1, 251) AS g(f) GROUP BY 1, 2),
rk AS (SELECT vec_id, freq, row_number() OVER (PARTITION BY vec_id ORDER BY amp DESC, freq) - 1 AS rank FROM am)"""
BINS = """
pts AS (SELECT 'u' || (user_id % 10) AS sig_key, ts, epoch_us(ts) / 1e6 / 21600 AS q FROM events WHERE ts IS NOT NULL),
grid AS (SELECT sig_key, k FROM (SELECT DISTINCT sig_key FROM pts), (SELECT unnest(range(floor(min(q))::BIGINT, ceil(max(q))::BIGINT)) AS k FROM pts)),
cnt AS (SELECT sig_key, floor(q)::BIGINT AS k, count(*) AS n FROM pts GROUP BY 1, 2),
bins AS (SELECT sig_key, k, coalesce(n, 0) AS n FROM grid LEFT JOIN cnt USING (sig_key, k))"""

# Isolated peaks: exact 2-means of x**4 over all cuts of the sorted values; the window's peaks are runs of values at the upper mean or above.
PEAKS = WINDOWS + """,
pk AS (SELECT sig_key, win_idx, unnest(range(0, len(x))) AS i, unnest(x) ** 4 AS s FROM pad),
so AS (
  SELECT *, row_number() OVER o AS j, count(*) OVER w AS n, lead(s) OVER o AS nxt, sum(s) OVER (PARTITION BY sig_key, win_idx ORDER BY s, i ROWS UNBOUNDED PRECEDING) AS a,
    sum(s * s) OVER (PARTITION BY sig_key, win_idx ORDER BY s, i ROWS UNBOUNDED PRECEDING) AS q, sum(s) OVER w AS sa, sum(s * s) OVER w AS sq
  FROM pk WINDOW w AS (PARTITION BY sig_key, win_idx), o AS (PARTITION BY sig_key, win_idx ORDER BY s, i)),
cu AS (SELECT sig_key, win_idx, arg_min(j, (q - a * a / j + (sq - q) - (sa - a) * (sa - a) / (n - j), j)) AS c FROM so WHERE nxt > s GROUP BY 1, 2),
mn AS (SELECT sig_key, win_idx, avg(CASE WHEN j <= c THEN s END) AS low, avg(CASE WHEN j > c THEN s END) AS high FROM so JOIN cu USING (sig_key, win_idx) GROUP BY 1, 2),
hi AS (SELECT sig_key, win_idx, i, lag(i) OVER (PARTITION BY sig_key, win_idx ORDER BY i) AS was FROM pk JOIN mn USING (sig_key, win_idx) WHERE high / greatest(low, 1e-9) >= 20 AND s >= high),
cn AS (SELECT sig_key, win_idx, count(*) FILTER (WHERE was IS NULL OR i - was > 1) AS k FROM hi GROUP BY 1, 2),
fl AS (
  SELECT seg.*, mean_range > 55 AND list_max(x) >= 0 AND abs(list_min(x)) >= 0 AS anom, coalesce(k, 0) AS found,
    list_sum(list_transform(range(1, len(x) + 1), lambda i: abs(list_sort([x[greatest(1, i - 2)], x[greatest(1, i - 1)], x[i], x[least(len(x), i + 1)], x[least(len(x), i + 2)]])[3]))) AS energy
  FROM seg LEFT JOIN cn USING (sig_key, win_idx)),
fw AS (SELECT *, CASE WHEN anom THEN found ELSE 0 END AS peak_count, CASE WHEN anom AND found > 0 THEN 'pic_' || found ELSE '' END AS peak_type, anom AND found = 0 AS regular FROM fl)
"""

# Chains over those windows; times lie days apart, so no bin reaches the cutoff and the low-pass changes nothing.
EVENTS = PEAKS + """,
rw AS (SELECT *, sig_key || '/' || win_idx AS w, list_stddev_pop(x) AS sd, lag(sig_key || '/' || win_idx) OVER (PARTITION BY sig_key ORDER BY win_idx) AS pw, lag(regular) OVER (PARTITION BY sig_key ORDER BY win_idx) AS was FROM fw),
px AS (SELECT w, unnest(range(0, len(x))) AS i, unnest(x) - list_avg(x) AS v FROM rw),
c1 AS (
  SELECT r.w, max(c) / (any_value(len(r.x) * r.sd * p.sd) + 1e-12) AS ncc FROM rw r JOIN rw p ON p.w = r.pw
  JOIN (SELECT r.w, abs(sum(a.v * b.v)) AS c FROM rw r JOIN px a ON a.w = r.pw JOIN px b ON b.w = r.w AND a.i - b.i BETWEEN -(r.most // 2) AND (r.most - 1) // 2 GROUP BY r.w, a.i - b.i) l ON l.w = r.w
  WHERE r.regular AND r.was AND r.sd * p.sd > 0 GROUP BY r.w),
sg AS (SELECT rw.*, CASE WHEN ncc >= 0.6 THEN 0 ELSE 1 END AS start FROM rw LEFT JOIN c1 USING (w) WHERE regular),
ce AS (SELECT *, sum(start) OVER (PARTITION BY sig_key ORDER BY win_idx ROWS UNBOUNDED PRECEDING) - 1 AS n_ev FROM sg),
rf AS (SELECT sig_key, n_ev, arg_min(w, (-list_max(x), win_idx)) AS rw FROM ce GROUP BY 1, 2),
c2 AS (
  SELECT e.w, max(c) / (any_value(len(e.x) * e.sd * p.sd) + 1e-12) AS ncc FROM ce e JOIN rf USING (sig_key, n_ev) JOIN ce p ON p.w = rf.rw
  JOIN (SELECT e.w, abs(sum(a.v * b.v)) AS c FROM ce e JOIN rf USING (sig_key, n_ev) JOIN px a ON a.w = rf.rw JOIN px b ON b.w = e.w AND a.i - b.i BETWEEN -(e.most // 2) AND (e.most - 1) // 2 GROUP BY e.w, a.i - b.i) l ON l.w = e.w
  WHERE e.w <> rf.rw AND e.sd * p.sd > 0 GROUP BY e.w),
mem AS (
  SELECT ce.sig_key, 0 AS pk, n_ev::BIGINT AS n_ev, ce.win_idx, ce.start_ts, ce.w = rf.rw AS is_ref, coalesce(c2.ncc, 0) AS ncc, ce.peak_count, ce.peak_type, energy, ce.x FROM ce JOIN rf USING (sig_key, n_ev) LEFT JOIN c2 ON c2.w = ce.w
  UNION ALL SELECT sig_key, 1, win_idx, win_idx, start_ts, true, 1, peak_count, peak_type, energy, x FROM rw WHERE peak_type <> ''),
evt AS (
  SELECT sig_key, pk, n_ev, min(start_ts) AS ref_timestamp, max(start_ts) AS last_ts, count(*)::INTEGER AS window_count, sum(ncc) AS sum_ncc, max(CASE WHEN is_ref THEN win_idx END) AS ref_win_idx,
    max(CASE WHEN is_ref THEN peak_count END)::INTEGER AS peak_count, max(CASE WHEN is_ref THEN peak_type END) AS peak_type, max(CASE WHEN is_ref THEN energy END) AS peak_energy, max(CASE WHEN is_ref THEN list_max(x) END) AS ref_max
  FROM mem GROUP BY 1, 2, 3),
eid AS (SELECT *, (row_number() OVER (PARTITION BY sig_key ORDER BY ref_timestamp, pk, n_ev) - 1)::INTEGER AS event_id, (epoch_us(last_ts) - epoch_us(ref_timestamp)) / 1e6 AS duration_s FROM evt)
"""

# Windows of unlike signals at all lags: dot products of the parts that overlap.
ALL_PAIRS = VECTORS + """,
ctr AS (SELECT *, list_transform(x, lambda v: v - m) AS c, len(x) AS n FROM reg),
sim AS (
  SELECT p.vec_id AS a, q.vec_id AS b, CASE WHEN p.sd * q.sd = 0 THEN 0 ELSE list_max(list_transform(range(1 - p.n, p.n), lambda k: abs(list_dot_product(
    p.c[greatest(1, 1 + k) : least(p.n, p.n + k)], q.c[greatest(1, 1 - k) : least(p.n, p.n - k)])))) / (p.n * p.sd * q.sd) END AS ncc
  FROM ctr p JOIN ctr q ON p.sig_key < q.sig_key)"""

# The same windows without what lies above 800 Hz, ten bins of sixty-four; the raw greatest value stays.
LOW = """
vec AS (
  SELECT 'l' || label AS sig_key, vec_id, row_number() OVER (PARTITION BY label ORDER BY vec_id) - 1 AS win_idx,
    list_transform(embedding, lambda v: v::DOUBLE) AS raw
  FROM embeddings),
ker AS (SELECT m - 63 AS d, (1 + 2 * sum(cos(2 * pi() * g * (m - 63) / 64))) / 64 AS c FROM range(0, 127) AS a(m), range(1, 11) AS b(g) GROUP BY m),
one AS (SELECT vec_id, unnest(range(0, 64)) AS j, unnest(raw) AS v FROM vec),
flt AS (SELECT vec_id, i, sum(v * c) AS y FROM one, range(0, 64) AS t(i) JOIN ker ON d = i - j GROUP BY 1, 2),
arr AS (SELECT vec_id, list(y ORDER BY i) AS x FROM flt GROUP BY 1),
reg AS (SELECT *, list_max(raw) < 2.2 AS regular, list_avg(x) AS m, list_max(raw) AS top, list_stddev_pop(x) AS sd FROM vec JOIN arr USING (vec_id))
"""

PEAK_CAPTURES = """
ten AS (SELECT 'u' || (user_id % 10) AS sig_key, * FROM events WHERE ts IS NOT NULL),
cap AS (SELECT DISTINCT sig_key, make_timestamp(epoch_us(ts) // 1800000000 * 1800000000) AS start_ts FROM ten WHERE event_type = 'view'),
cov AS (
  SELECT p.sig_key, p.ts, event_id, max(start_ts) AS start_ts FROM ten p
  LEFT JOIN cap c ON c.sig_key = p.sig_key AND start_ts <= p.ts AND p.ts < start_ts + INTERVAL 30 MINUTE WHERE value > 150 GROUP BY 1, 2, 3)"""

SQL = {
    "gap_windows": f"WITH {WINDOWS} SELECT sig_key, win_idx, start_ts, end_ts, n FROM win",
    "window_centre_pad": f"WITH {WINDOWS} SELECT sig_key, win_idx, len(x) AS padded, round(list_sum(list_transform(x, lambda v: abs(v))), 4) AS total FROM pad",
    "segment_range_anomaly": f"WITH {WINDOWS} SELECT sig_key, win_idx, round(mean_range, 4) AS mean_range, mean_range > 55 AS is_anomaly FROM seg",
    "peak_threshold": f"WITH {WINDOWS} SELECT sig_key, win_idx, list_max(x) >= 60 AND abs(list_min(x)) >= 60 AS has_peak FROM pad",
    "anomalous_windows": f"WITH {WINDOWS} SELECT sig_key, win_idx, start_ts, end_ts, n, round(mean_range, 4) AS mean_range FROM seg WHERE mean_range > 55 AND list_max(x) >= 0",
    "window_energy": f"""WITH {WINDOWS} SELECT sig_key, win_idx, round(list_sum(list_transform(range(1, len(x) + 1), lambda i: abs(list_sort([
        x[greatest(1, i - 2)], x[greatest(1, i - 1)], x[i], x[least(len(x), i + 1)], x[least(len(x), i + 2)]])[3]))), 3) AS energy FROM pad""",
    "dft_dominant": f"WITH {SPECTRUM} SELECT vec_id, freq AS dom_freq FROM rk WHERE rank = 0",
    "dft_top4": f"WITH {SPECTRUM} SELECT vec_id, rank::INTEGER AS rank, freq FROM rk WHERE rank < 4",
    "ncc_bounded": f"WITH {POINTS}{NEXT}, {ncc('nx', -10, 10, EPS)} SELECT id AS vec_id, round(ncc, 5) AS ncc FROM best",
    "ncc_full": f"WITH {POINTS}{NEXT}, {ncc('nx', -63, 63, '')} SELECT id AS vec_id, round(ncc, 5) AS ncc FROM best",
    "event_chain": f"WITH {CHAIN} SELECT sig_key, win_idx, event_idx::BIGINT AS event_idx FROM ev",
    "event_reference": f"WITH {CHAIN} SELECT sig_key, event_idx::BIGINT AS event_idx, win_idx AS ref_idx FROM ref",
    "event_metrics": f"WITH {MEASURE} SELECT sig_key, event_idx::BIGINT AS event_idx, win_idx, ref_idx, round(ncc_vs_ref, 5) AS ncc_vs_ref FROM ms",
    "type_pairs": f"""WITH {POINTS}, tp AS (SELECT a.vec_id * 1000000 + b.vec_id AS id, a.vec_id AS a, b.vec_id AS b, a.sig_key, a.win_idx AS i, b.win_idx AS j
        FROM reg a JOIN reg b ON a.sig_key = b.sig_key AND a.win_idx < b.win_idx), {ncc('tp', -32, 31, EPS)}
        SELECT sig_key, i, j, round(ncc, 5) AS ncc FROM tp JOIN best USING (id)""",
    "profile_rollup": f"""WITH {MEASURE} SELECT sig_key, event_idx::BIGINT AS event_idx, make_timestamp((1704067200 + min(win_idx) * 40) * 1000000) AS ref_timestamp,
        count(*) AS window_count, max(ref_idx) AS ref_win_idx, round(avg(ncc_vs_ref), 4) AS mean_ncc, ((max(win_idx) - min(win_idx)) * 40)::DOUBLE AS duration_s FROM ms GROUP BY sig_key, event_idx""",
    "type_summary": "SELECT 'u' || (user_id % 10) AS sig_key, event_type AS cid, count(*) AS count, round(avg(value), 4) AS mean_freq, min(ts) AS first_ts, arg_min(event_id, (ts, event_id)) AS first_event FROM events GROUP BY 1, 2",
    "overlap_histogram": f"WITH {BINS} SELECT sig_key, make_timestamp(k * 21600 * 1000000) AS bin, n FROM bins",
    "burst_stats": """WITH pts AS (SELECT 'u' || (user_id % 10) AS sig_key, ts, value, epoch_us(ts) / 1e6 / 21600 AS q FROM events WHERE ts IS NOT NULL),
        grid AS (SELECT sig_key, k FROM (SELECT DISTINCT sig_key FROM pts), (SELECT unnest(range(floor(min(q))::BIGINT, ceil(max(q))::BIGINT + 1)) AS k FROM pts)),
        cnt AS (SELECT sig_key, floor(q)::BIGINT AS k, count(*) AS n FROM pts GROUP BY 1, 2),
        bins AS (SELECT sig_key, k, coalesce(n, 0) AS n FROM grid LEFT JOIN cnt USING (sig_key, k)),
        s AS (SELECT *, n / sum(n) OVER (PARTITION BY sig_key) AS p, avg(n) OVER (PARTITION BY sig_key) + 2 * stddev_samp(n) OVER (PARTITION BY sig_key) AS cut FROM bins),
        f AS (SELECT sig_key, quantile_cont(value, 0.5) AS median_freq FROM pts GROUP BY 1),
        b AS (SELECT sig_key, arg_min(k, (-n, k)) AS busy, round(avg(CASE WHEN n > 0 THEN 1.0::DOUBLE ELSE 0 END), 6) AS active, round(-sum(CASE WHEN p > 0 THEN p * log2(p) END) / log2(greatest(count(*), 2)), 5) AS entropy,
          sum(CASE WHEN n > cut THEN 1 ELSE 0 END)::BIGINT AS bursts FROM s GROUP BY sig_key)
        SELECT sig_key, active, entropy, bursts, strftime(make_timestamp((busy * 21600 + 10800) * 1000000), '%H:%M') AS peak, median_freq FROM b JOIN f USING (sig_key)""",
    "gantt_bars": f"""WITH {WINDOWS}, sp AS (SELECT (max(epoch_us(end_ts)) - min(epoch_us(start_ts))) / 1e6 AS span FROM win)
        SELECT sig_key, win_idx AS event_id, start_ts, round(greatest((epoch_us(end_ts) - epoch_us(start_ts)) / 1e6, 0.003 * span, 1.0), 3) AS bar_s FROM win, sp""",
    "color_map": """WITH c AS (SELECT ['#e69f00', '#56b4e9', '#009e73', '#f0e442', '#0072b2', '#d55e00', '#cc79a7', '#000000',
          '#1f77b4', '#aec7e8', '#ff7f0e', '#ffbb78', '#2ca02c', '#98df8a', '#d62728', '#ff9896', '#9467bd', '#c5b0d5', '#8c564b', '#c49c94', '#e377c2', '#f7b6d2', '#7f7f7f', '#c7c7c7', '#bcbd22', '#dbdb8d', '#17becf', '#9edae5'] AS l),
        p AS (SELECT *, row_number() OVER (ORDER BY a, b) - 1 AS i, count(*) OVER () AS n FROM (SELECT DISTINCT 'u' || (user_id % 10) AS a, event_type AS b FROM events))
        SELECT a, b, l[1 + i % CASE WHEN n > 8 THEN 28 ELSE 8 END] AS color FROM p, c""",
    "unpivot_channels": "SELECT l_orderkey, l_linenumber, voie, signal FROM (SELECT l_orderkey, l_linenumber, unnest([1, 2, 3]) AS voie, unnest([l_quantity::DOUBLE, l_extendedprice::DOUBLE, l_discount::DOUBLE]) AS signal FROM lineitem)",
    "ingest_dedup": """WITH a AS (SELECT 'u' || user_id AS boitier, date_trunc('minute', ts) AS ts, event_id AS tie, value FROM events WHERE value IS NOT NULL AND ts IS NOT NULL),
        b AS (SELECT *, 0 AS src, value AS v FROM a WHERE tie % 3 = 0 UNION ALL SELECT *, 1, value + 1000 FROM a)
        SELECT boitier, ts, tie, round(v, 4) AS signal FROM b QUALIFY row_number() OVER (PARTITION BY boitier, ts ORDER BY src, tie) = 1""",
    "trms_metrics": """SELECT l_shipdate::DATE AS day, l_returnflag, min(x) AS low, max(x) AS high, round(avg(x), 4) AS moy, round(sqrt(avg(x * x)), 4) AS efficace, abs(max(x) - min(x)) > 50000 AS flagged
        FROM (SELECT *, l_extendedprice::DOUBLE AS x FROM lineitem) GROUP BY 1, 2""",
    "date_union": "SELECT 'u' || (user_id % 100) AS sig_key, string_agg(DISTINCT strftime(ts, '%Y-%m-%d'), ',' ORDER BY strftime(ts, '%Y-%m-%d')) AS dates FROM events WHERE ts IS NOT NULL GROUP BY 1",
    "path_metadata": "SELECT event_id, 'boitier_' || user_id AS boitier, strftime(ts, '%Y-%m-%d') AS date, CASE WHEN event_id % 2 = 0 THEN 'TRMS' ELSE 'oscillo' END AS kind FROM events WHERE ts IS NOT NULL",
    "severity": f"""WITH {WINDOWS}, a AS (SELECT sig_key, win_idx, n, round(mean_range, 4) AS mean_range FROM seg WHERE mean_range > 55),
        s AS (SELECT *, round(0.7 * percent_rank() OVER (ORDER BY mean_range) + 0.3 * percent_rank() OVER (ORDER BY n), 6) AS score FROM a),
        r AS (SELECT *, percent_rank() OVER (ORDER BY score DESC) AS q FROM s)
        SELECT sig_key, win_idx, score, CASE WHEN q < 0.1 THEN 'severe' WHEN q < 0.4 THEN 'moderate' ELSE 'minor' END AS level FROM r""",
    "peak_count_2means": f"WITH {PEAKS} SELECT sig_key, win_idx, found AS n_peaks, CASE WHEN found > 0 THEN 'pic_' || found ELSE '' END AS label FROM fl",
    "lowpass": """WITH pt AS (SELECT vec_id, unnest(range(0, 64)) AS j, unnest(embedding)::DOUBLE AS v FROM embeddings),
        k AS (SELECT m - 63 AS d, (1 + 2 * sum(cos(2 * pi() * g * (m - 63) / 64))) / 64 AS c FROM range(0, 127) AS a(m), range(1, 11) AS b(g) GROUP BY m)
        SELECT vec_id, i::INTEGER AS i, round(sum(v * c), 5) + 0.0 AS v FROM pt, range(0, 64) AS t(i) JOIN k ON k.d = i - j GROUP BY 1, 2""",
    "peak_split": f"WITH {PEAKS} SELECT sig_key, win_idx, anom AS is_anomaly, peak_count, peak_type, peak_type <> '' AND energy > 200 AS peak_forme, regular FROM fw",
    "peak_events": f"""WITH {EVENTS} SELECT sig_key, event_id, ref_win_idx, ref_timestamp, window_count, duration_s, peak_count, peak_type, peak_energy > 200 AS peak_forme, round(peak_energy, 3) AS peak_energy,
        1.0::DOUBLE AS ncc_vs_ref, 0.0::DOUBLE AS dom_freq FROM eid WHERE pk = 1""",
    "event_profile": f"""WITH {EVENTS} SELECT sig_key, event_id, pk = 1 AS is_peak, ref_win_idx, ref_timestamp, last_ts, window_count, duration_s, peak_count, peak_type, round(sum_ncc, 4) AS sum_ncc, round(ref_max, 4) AS ref_max FROM eid""",
    "type_pairs_skipped": f"WITH {EVENTS} SELECT sig_key, event_id FROM eid WHERE pk = 0",
    "trms_segments": """WITH r AS (SELECT l_returnflag AS sig_key, l_shipdate, l_discount::DOUBLE AS lo, l_extendedprice::DOUBLE AS hi, l_quantity::DOUBLE AS e,
          (row_number() OVER (PARTITION BY l_returnflag ORDER BY l_shipdate, l_orderkey, l_linenumber) - 1) // 3600 AS segment FROM lineitem WHERE l_shipdate IS NOT NULL)
        SELECT sig_key, segment, min(l_shipdate)::TIMESTAMP AS start_ts, count(*) AS n, min(lo) AS low, max(hi) AS high, max(e) AS efficace, abs(max(hi) - min(lo)) > 104000 OR max(e) > 60 AS is_peak FROM r GROUP BY 1, 2""",
    "signals_in_order": "SELECT sig_key, (row_number() OVER (ORDER BY first_at, sig_key) - 1)::INTEGER AS rank FROM (SELECT 'u' || user_id AS sig_key, min((ts, event_id)) AS first_at FROM events WHERE ts IS NOT NULL GROUP BY 1)",
    "dates_without_events": """WITH d AS (SELECT o_orderdate::DATE AS date, count(*) AS n FROM orders GROUP BY 1),
        g AS (SELECT unnest(generate_series((SELECT min(date) FROM d), (SELECT max(date) FROM d), INTERVAL 1 DAY))::DATE AS date)
        SELECT strftime(g.date, '%Y-%m-%d') AS date, coalesce(n, 0) AS n_orders FROM g LEFT JOIN d USING (date)""",
    "cooccurrence": """WITH p AS (SELECT a.event_type AS cid_a, b.event_type AS cid_b, a.user_id AS ua, b.user_id AS ub, abs(epoch_us(b.ts) - epoch_us(a.ts)) AS g FROM events a JOIN events b
          ON b.ts BETWEEN a.ts - INTERVAL 30 SECOND AND a.ts + INTERVAL 30 SECOND AND a.user_id <> b.user_id AND (a.event_type, a.event_id) < (b.event_type, b.event_id))
        SELECT cid_a, cid_b, count(*) AS n_pairs, count(DISTINCT (ua, ub)) AS n_signals, round(sum(g) / count(*) / 1e6, 4) AS mean_gap_s, min(g) / 1e6 AS least_gap_s FROM p GROUP BY 1, 2""",
    "clicks_before_sales": """SELECT s.client_id, sale_id, sold_at, count(*) AS n_clicks, max(ts) AS last_click, round(sum(value), 2) AS value
        FROM sales s JOIN clicks c ON c.client_id = s.client_id AND c.ts BETWEEN sold_at - INTERVAL 6 HOUR AND sold_at GROUP BY 1, 2, 3""",
    "peak_capture": f"WITH {PEAK_CAPTURES} SELECT sig_key, ts, event_id, start_ts FROM cov",
    "peak_extract": f"""WITH {PEAK_CAPTURES} SELECT c.sig_key, c.ts, start_ts, count(*) AS n, round(sum(e.value), 4) AS total, round(sum((epoch_us(e.ts) - epoch_us(c.ts)) / 1e6), 3) AS offsets
        FROM (SELECT DISTINCT sig_key, ts, start_ts FROM cov) c JOIN ten e ON e.sig_key = c.sig_key AND e.ts BETWEEN c.ts - INTERVAL 600 SECOND AND c.ts + INTERVAL 600 SECOND AND e.ts >= start_ts AND e.ts < start_ts + INTERVAL 30 MINUTE
        GROUP BY 1, 2, 3""",
    "shared_types": f"WITH {ALL_PAIRS} SELECT a.sig_key AS sig_key_a, a.win_idx AS cid_a, b.sig_key AS sig_key_b, b.win_idx AS cid_b, round(ncc, 5) AS ncc FROM sim JOIN reg a ON a.vec_id = sim.a JOIN reg b ON b.vec_id = sim.b WHERE ncc >= 0.3",
    "registry_match": f"""WITH {ALL_PAIRS}, two AS (SELECT a AS id, b AS type_id, ncc FROM sim UNION ALL SELECT b, a, ncc FROM sim),
        one AS (SELECT * FROM two QUALIFY row_number() OVER (PARTITION BY id ORDER BY ncc DESC, type_id) = 1)
        SELECT vec_id AS id, CASE WHEN ncc >= 0.45 THEN type_id END AS type_id, round(ncc, 5) AS ncc FROM reg LEFT JOIN one ON one.id = vec_id""",
    "gap_windows_sql": f"WITH {WINDOWS} SELECT sig_key, win_idx, start_ts, end_ts, n FROM win",
    "event_chain_sql": f"WITH {CHAIN} SELECT sig_key, win_idx, event_idx::BIGINT AS event_idx FROM ev",
    "window_shapes": f"""WITH {POINTS},
        pw AS (SELECT vec_id, f, sum(v * cos(2 * pi() * f * i / 64)) ** 2 + sum(v * sin(2 * pi() * f * i / 64)) ** 2 AS p FROM pt, range(1, 33) AS g(f) GROUP BY 1, 2),
        sh AS (SELECT *, p / sum(p) OVER (PARTITION BY vec_id) AS q FROM pw),
        en AS (SELECT vec_id, -sum(q * ln(q)) / ln(32) AS entropy, max(q) AS dominant FROM sh GROUP BY 1),
        ac AS (SELECT vec_id, max(list_dot_product(c[1 + k : 64], c[1 : 64 - k]) / list_dot_product(c, c)) AS r FROM (SELECT vec_id, list_transform(x, lambda v: v - m) AS c FROM reg), range(5, 64) AS g(k) GROUP BY 1)
        SELECT vec_id, round(entropy, 5) AS entropy, round(dominant, 5) AS dominant, round(greatest(r, 0), 5) AS autocorrelation,
          (entropy - 0.002) ** 2 + (dominant - 0.99) ** 2 + (greatest(r, 0) - 0.95) ** 2 < (entropy - 0.95) ** 2 + (dominant - 0.002) ** 2 + (greatest(r, 0) - 0.03) ** 2 AS is_sine FROM en JOIN ac USING (vec_id)""",
    "severity_by_axes": f"""WITH {WINDOWS},
        w AS (SELECT sig_key, win_idx, n, round(mean_range, 4) AS a, (epoch_us(end_ts) - epoch_us(start_ts)) / 1e6 AS b, (n % 7)::DOUBLE AS c, mean_range > 55 AS hit FROM seg),
        e AS (SELECT *, count(*) OVER (PARTITION BY sig_key, n) AS d FROM w WHERE hit),
        q AS (SELECT {", ".join(f"list_sort(list({x})) AS l{x}" for x in "abcd")}, count(*) AS m FROM e),
        s AS (SELECT sig_key, win_idx, a, d, round({" + ".join(f"{w} * (list_count(list_filter(range(1, 100), lambda k: l{x}[ceil(k * m / 100.0)::BIGINT] <= {x})) / 99)" for w, x in zip((0.4, 0.2, 0.2, 0.2), "abcd"))}, 6) AS score FROM e, q),
        z AS (SELECT list_sort(list(score)) AS l, count(*) AS m FROM s),
        u AS (SELECT sig_key, avg(a) AS mean, stddev_samp(a) AS sd FROM w WHERE NOT hit GROUP BY 1)
        SELECT sig_key, win_idx AS event_id, score, CASE WHEN score > l[ceil(0.9 * m)::BIGINT] THEN 'severe' WHEN score > l[ceil(0.6 * m)::BIGINT] THEN 'moderate' ELSE 'minor' END AS level,
          d::DOUBLE AS recurrence, round((a - mean) / nullif(sd, 0), 3) AS z FROM s CROSS JOIN z LEFT JOIN u USING (sig_key)""",
    "filtered_events": f"""WITH {MEASURE.replace(VECTORS, LOW)},
        sp AS (SELECT vec_id, unnest(range(0, len(raw))) AS i, unnest(raw) AS v FROM reg),
        am AS (SELECT vec_id, f * 10.0 AS freq, sqrt(sum(v * cos(2 * pi() * f * 10 * i * 0.0002)) ** 2 + sum(v * sin(2 * pi() * f * 10 * i * 0.0002)) ** 2) AS amp FROM sp, range(1, 251) AS g(f) GROUP BY 1, 2),
        rk AS (SELECT vec_id, freq, row_number() OVER (PARTITION BY vec_id ORDER BY amp DESC, freq) AS rank FROM am),
        fr AS (SELECT vec_id, max(CASE WHEN rank = 1 THEN freq END) AS f1, max(CASE WHEN rank = 4 THEN freq END) AS f4 FROM rk GROUP BY 1)
        SELECT sig_key, event_idx::BIGINT AS event_idx, win_idx, ref_idx, round(ncc_vs_ref, 5) AS ncc_vs_ref, f1 AS dom_freq, f4 AS fourth_freq FROM ms JOIN fr USING (vec_id)""",
    "occurrence_bins": f"""WITH {EVENTS},
        en AS (SELECT sig_key, floor(epoch_us(min(ref_timestamp)) / 604800000000)::BIGINT AS lo, ceil(epoch_us(max(last_ts)) / 604800000000)::BIGINT AS hi FROM eid GROUP BY 1),
        gr AS (SELECT sig_key, is_peak, unnest(range(lo, hi)) AS k FROM (SELECT DISTINCT sig_key, pk = 1 AS is_peak FROM eid) JOIN en USING (sig_key)),
        ct AS (SELECT sig_key, pk = 1 AS is_peak, floor(epoch_us(start_ts) / 604800000000)::BIGINT AS k, count(*) AS n FROM mem GROUP BY 1, 2, 3)
        SELECT sig_key, is_peak, make_timestamp(k * 604800000000) AS bin, coalesce(n, 0) AS n FROM gr LEFT JOIN ct USING (sig_key, is_peak, k)""",
    "timeline_bars": f"""WITH {WINDOWS}, e AS (SELECT sig_key, win_idx, epoch_us(start_ts) // 1000000 AS a, epoch_us(end_ts) // 1000000 AS b FROM win), w AS (SELECT min(a) AS lo, greatest(max(b) - min(a), 1) AS span FROM e)
        SELECT sig_key, win_idx AS event_id, make_timestamp(a * 1000000) AS start_ts, round((a - lo) * 1200.0::DOUBLE / span, 3) AS left_px, round(greatest(greatest(b - a, 0.003::DOUBLE * span) * 1200 / span, 4), 3) AS bar_px FROM e, w""",
}
