"""The SQL twin of every registered query that SQL can express.

Each twin repeats the derivation of the logical inputs from the shared tables
and then states the query in its own way.
"""

from __future__ import annotations

from ebbtide.operators.metrics import EPS, METRICS, THRESHOLDS
from ebbtide.plans.features import ACTIVITY, COUNTS, LAST, MART, PLAYS
from ebbtide.plans.profile_report import MINI
from ebbtide.registry.spark_queries import IMPUTED, SEGMENT_COLUMNS
from ebbtide.models.prepare import BEHAVIOUR, CATEGORICAL, SUBSCRIPTION
from ebbtide.sources.schemas import CATALOG
from ebbtide.sources.shared_tables import EARLIER, LATER, OUTCOME_DAYS, PLAY_EVENTS

# Inputs as common table expressions -----------------------------------------


def _ymd(expr: str) -> str:
    return f"CAST(strftime({expr}, '%Y%m%d') AS INTEGER)"


def _lab(as_of: str) -> str:
    return f"""SELECT c_custkey AS msno,
      CASE WHEN c_custkey IN (SELECT o_custkey FROM orders WHERE o_orderdate >= DATE '{as_of}'
        AND o_orderdate < DATE '{as_of}' + INTERVAL {OUTCOME_DAYS} DAY) THEN 0 ELSE 1 END AS is_churn
      FROM customer"""


def _mem(as_of: str) -> str:
    return f"""SELECT c_custkey AS msno, c_nationkey AS city, CAST(floor(c_acctbal / 100) AS INTEGER) AS bd,
      CASE c_mktsegment WHEN 'BUILDING' THEN 'male' WHEN 'MACHINERY' THEN 'female' ELSE c_mktsegment END AS gender,
      CAST(c_custkey % 5 AS INTEGER) AS registered_via, registration_init_time
      FROM customer LEFT JOIN (SELECT o_custkey, {_ymd('min(o_orderdate)')} AS registration_init_time
        FROM orders WHERE o_orderdate < DATE '{as_of}' GROUP BY o_custkey) ON c_custkey = o_custkey"""


def _txn(as_of: str) -> str:
    price = "CAST(l_extendedprice AS DECIMAL(12,2))"
    return f"""SELECT o_custkey AS msno, CAST(substr(o_orderpriority, 1, 1) AS INTEGER) AS payment_method_id,
      plan_days AS payment_plan_days, list_price AS plan_list_price, paid AS actual_amount_paid,
      CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS is_auto_renew,
      {_ymd('o_orderdate')} AS transaction_date, {_ymd('ship')} AS membership_expire_date,
      CASE WHEN o_orderstatus = 'P' THEN 1 ELSE 0 END AS is_cancel, o_orderkey AS txn_id
      FROM orders LEFT JOIN (SELECT l_orderkey, CAST(sum(l_quantity) AS INTEGER) AS plan_days,
        CAST(sum({price}) AS DOUBLE) AS list_price,
        CAST(sum({price} * (1 - CAST(l_discount AS DECIMAL(4,2)))) AS DOUBLE) AS paid,
        max(l_shipdate) AS ship FROM lineitem GROUP BY l_orderkey) ON o_orderkey = l_orderkey
      WHERE o_orderdate < DATE '{as_of}'"""


def _log() -> str:
    counters = ", ".join(f"count(*) FILTER (event_type = '{kind}') AS {name}" for name, kind in PLAY_EVENTS.items())
    return f"""SELECT user_id AS msno, {_ymd('ts')} AS date, {counters}, count(DISTINCT props) AS num_unq,
      sum(CAST(value AS DECIMAL(12,2))) AS total_secs FROM events GROUP BY ALL"""


def _sc(as_of: str) -> str:
    return f"""SELECT l.msno, is_churn AS y_true,
      coalesce(CAST(r AS DOUBLE) / (CAST(r AS DOUBLE) + CAST(180 AS DOUBLE)), CAST(0.5 AS DOUBLE)) AS y_prob
      FROM ({_lab(as_of)}) l LEFT JOIN (SELECT o_custkey, datediff('day', max(o_orderdate), DATE '{as_of}') AS r
        FROM orders WHERE o_orderdate < DATE '{as_of}' GROUP BY o_custkey) ON l.msno = o_custkey"""


def _ctes(as_of: str = LATER, **more: str) -> str:
    parts = {"lab": _lab(as_of), "mem": _mem(as_of), "txn": _txn(as_of), "log": _log(), "sc": _sc(as_of), **more}
    return "WITH " + ",\n".join(f"{name} AS ({sql})" for name, sql in parts.items()) + "\n"


def _ratio(num: str, den: str, positive: bool = False) -> str:
    good = f"{den} > 0" if positive else f"{den} <> 0"
    return f"CASE WHEN {good} THEN CAST({num} AS DOUBLE) / CAST({den} AS DOUBLE) ELSE CAST(0 AS DOUBLE) END"


def _date(expr: str) -> str:
    return f"try_strptime(CAST({expr} AS VARCHAR), '%Y%m%d')"


def _memf(as_of: str) -> str:
    return f"""SELECT msno, city, CASE WHEN bd >= 10 AND bd <= 70 THEN bd END AS age,
      CASE gender WHEN 'male' THEN 'male' WHEN 'female' THEN 'female' ELSE 'unknown' END AS gender,
      registered_via, registration_init_time,
      datediff('day', {_date('registration_init_time')}, DATE '{as_of}') AS tenure_days FROM mem"""


_DISCOUNT = "CASE WHEN actual_amount_paid < plan_list_price THEN 1 ELSE 0 END"
_RANKED = """SELECT *, row_number() OVER (PARTITION BY msno
      ORDER BY transaction_date DESC NULLS LAST, txn_id DESC) AS rn FROM txn"""


def _txnf(positive: bool = False) -> str:
    sources = ["payment_method_id", "is_auto_renew", "is_cancel", "payment_plan_days", "actual_amount_paid",
               "plan_list_price", _DISCOUNT]
    picks = ", ".join(f"max({src}) FILTER (rn = 1) AS {name}" for name, src in zip(LAST, sources))
    return f"""SELECT *, {_ratio('last_list_price', 'last_plan_days', positive)} AS last_price_per_day FROM (
      SELECT msno, {picks}, count(*) AS txn_count, CAST(sum(is_cancel) AS BIGINT) AS total_cancels,
      CAST(sum(is_auto_renew) AS BIGINT) AS total_auto_renews,
      CAST(sum({_DISCOUNT}) AS BIGINT) AS total_discounts,
      datediff('day', max({_date('transaction_date')}), max({_date('membership_expire_date')})) AS days_until_expiry
      FROM ({_RANKED}) GROUP BY msno)"""


def _actf(window: tuple[int, int] | None = None, positive: bool = False) -> str:
    where = f"WHERE date >= {window[0]} AND date <= {window[1]}" if window else ""
    sources = ["num_100", "num_unq", "num_25", "num_50", "num_75", "num_985",
               "num_25 + num_50 + num_75 + num_985 + num_100"]
    sums = ", ".join(f"CAST(coalesce(sum({src}), 0) AS BIGINT) AS {name}" for name, src in zip(PLAYS, sources))
    return f"""SELECT *, {_ratio('complete_plays', 'total_plays', positive)} AS completion_rate,
      {_ratio('unique_songs', 'partial_plays', positive)} AS engagement_depth,
      {_ratio('total_secs', 'active_days', positive)} AS avg_daily_secs,
      {_ratio('(total_secs / CAST(60 AS DOUBLE))', 'unique_songs', positive)} AS mins_per_song FROM (
      SELECT msno, count(DISTINCT date) AS active_days, CAST(sum(total_secs) AS DOUBLE) AS total_secs, {sums}
      FROM log {where} GROUP BY msno)"""


def _mart(as_of: str) -> str:
    def pick(name: str) -> str:
        if name == "has_member_data":
            return "CASE WHEN m.msno IS NULL THEN 0 ELSE 1 END AS has_member_data"
        if name == "has_transaction_data":
            return "CASE WHEN t.msno IS NULL THEN 0 ELSE 1 END AS has_transaction_data"
        if name == "has_age":
            return "CASE WHEN m.age IS NULL THEN 0 ELSE 1 END AS has_age"
        if name in COUNTS or name in ACTIVITY:
            return f"coalesce({name}, 0) AS {name}"
        return "lab.msno" if name == "msno" else name

    return f"""SELECT {', '.join(pick(n) for n in MART)} FROM lab LEFT JOIN memf m ON lab.msno = m.msno
      LEFT JOIN txnf t ON lab.msno = t.msno LEFT JOIN actf a ON lab.msno = a.msno"""


def _with_mart(as_of: str = LATER, window=None, positive: bool = False, **more: str) -> str:
    return _ctes(
        as_of, memf=_memf(as_of), txnf=_txnf(positive), actf=_actf(window, positive), mart=_mart(as_of), **more
    )


_HISTORY = f"""SELECT msno, count(*) AS txn_count, datediff('day', {_date('max(transaction_date)')},
      {_date('max(membership_expire_date)')}) AS days_until_expiry FROM txn GROUP BY msno"""
_USE = f"""SELECT msno, count(DISTINCT date) AS active_days, CAST(sum(total_secs) AS DOUBLE) AS total_secs,
      CAST(sum(num_unq) AS BIGINT) AS total_unique_songs, CAST(sum(num_25) AS BIGINT) AS total_partial_plays
      FROM log GROUP BY msno"""
_MINI = f"""SELECT lab.msno, is_churn, age, tenure_days, r.is_auto_renew AS last_auto_renew,
      r.is_cancel AS last_cancel, r.payment_plan_days AS last_plan_days, {_DISCOUNT} AS has_discount,
      h.txn_count, h.days_until_expiry, u.active_days, u.total_secs, u.total_unique_songs
      FROM lab LEFT JOIN memf USING (msno) LEFT JOIN (SELECT * FROM ({_RANKED}) WHERE rn = 1) r USING (msno)
      LEFT JOIN ({_HISTORY}) h USING (msno) LEFT JOIN ({_USE}) u USING (msno)"""


def _with_mini() -> str:
    return _ctes(LATER, memf=_memf(LATER), mini=_MINI)


def _rate(source: str, keys: str, tail: str = "") -> str:
    return f"""SELECT {keys}, count(*) AS n, round(avg(is_churn) * 100, 2) AS churn_rate
      FROM {source} GROUP BY ALL {tail}"""


_LABELLED = "lab JOIN mem USING (msno)"
_LAST = f"lab JOIN (SELECT * FROM ({_RANKED}) WHERE rn = 1) USING (msno)"


def _nulls(columns: dict[str, str]) -> str:
    return ", ".join(f"count(*) FILTER ({col} IS NULL) AS {name}" for name, col in columns.items())


def _medians(source: str, columns: list[str]) -> str:
    picks = ", ".join(f"CAST(median({c}) AS DOUBLE) AS median_{c}" for c in columns)
    return f"SELECT is_churn, {picks} FROM {source} GROUP BY is_churn"


def _corr(source: str, pairs: list[tuple[str, str]]) -> str:
    """A constant column has no correlation: NULL."""
    return " UNION ALL ".join(
        f"SELECT '{a}' AS column_a, '{b}' AS column_b, count(*) AS n, "
        f"CASE WHEN stddev_pop({a}) > 0 AND stddev_pop({b}) > 0 THEN round(corr({a}, {b}), 6) END AS r "
        f"FROM {source} WHERE {a} IS NOT NULL AND {b} IS NOT NULL"
        for a, b in pairs
    )


def _hist(source: str, column: str, bins: int, by: str | None = None, clip: float | None = None,
          density: bool = False) -> str:
    value = f"CAST({column} AS DOUBLE)"
    value = f"least({value}, CAST({clip} AS DOUBLE))" if clip is not None else value
    key = by or "0"
    d = "round(CAST(n AS DOUBLE) / total / (hi_edge - lo_edge), 9) AS density, " if density else ""
    named = f"k AS {by}, " if by else ""
    return f""", v AS (SELECT {key} AS k, {value} AS x FROM {source} WHERE {column} IS NOT NULL),
      rg AS (SELECT k, CASE WHEN min(x) = max(x) THEN min(x) - 0.5 ELSE min(x) END AS lo,
        CASE WHEN min(x) = max(x) THEN max(x) + 0.5 ELSE max(x) END AS hi, count(*) AS total FROM v GROUP BY k),
      edges AS (SELECT k, lo, hi, total, CAST(b AS INTEGER) AS bin,
        b * ((hi - lo) / CAST({bins} AS DOUBLE)) + lo AS lo_edge,
        CASE WHEN b = {bins - 1} THEN hi ELSE (b + 1) * ((hi - lo) / CAST({bins} AS DOUBLE)) + lo END AS hi_edge
        FROM rg, range({bins}) AS bb(b)),
      bars AS (SELECT e.k, bin, lo_edge, hi_edge, total, count(x) AS n FROM edges e LEFT JOIN v
        ON v.k = e.k AND x >= lo_edge AND (x < hi_edge OR bin = {bins - 1}) GROUP BY ALL)
      SELECT {named}{d}bin, round(lo_edge, 6) AS lower, round(hi_edge, 6) AS upper, n FROM bars"""


def _hash(seed: str, key: str = "msno") -> str:
    return f"CAST('0x' || substr(md5('{seed}:' || CAST({key} AS VARCHAR)), 1, 8) AS BIGINT)"


def _marked(source: str, share: float = 0.2, columns: str = "s.*") -> str:
    """Rows of a source with ``is_test``: each class cut at its rank by hash."""
    return f"""SELECT {columns}, CASE WHEN row_number() OVER (PARTITION BY s.is_churn ORDER BY {_hash('42', 's.msno')}, s.msno) <= q
        THEN 1 ELSE 0 END AS is_test FROM {source} s JOIN (
        SELECT is_churn, floor(part) + CASE WHEN row_number() OVER (ORDER BY part - floor(part) DESC, is_churn)
          <= wanted - sum(floor(part)) OVER () THEN 1 ELSE 0 END AS q FROM (
          SELECT is_churn, ceil(sum(count(*)) OVER () * {share}) AS wanted,
            ceil(sum(count(*)) OVER () * {share}) * count(*) / CAST(sum(count(*)) OVER () AS DOUBLE) AS part
          FROM {source} GROUP BY is_churn)) quota ON s.is_churn = quota.is_churn"""


# Metrics --------------------------------------------------------------------

def _grouped(score: str = "y_prob", source: str = "sc") -> str:
    return f"""SELECT {score} AS score, count(*) FILTER (y_true = 1) AS pos, count(*) FILTER (y_true = 0) AS neg
      FROM {source} GROUP BY 1"""


def _ranked_scores(score: str = "y_prob") -> str:
    return f"""SELECT *, sum(pos) OVER down AS tp, sum(neg) OVER down AS fp, sum(pos) OVER () AS all_pos,
      sum(neg) OVER () AS all_neg, row_number() OVER down AS rk,
      lead(pos) OVER down AS next_pos, lead(neg) OVER down AS next_neg
      FROM ({_grouped(score)}) WINDOW down AS (ORDER BY score DESC)"""


def _loss(source: str = "sc") -> str:
    p = f"greatest(CAST('{EPS!r}' AS DOUBLE), least(CAST('{1 - EPS!r}' AS DOUBLE), y_prob))"
    return f"SELECT avg(CASE WHEN y_true = 1 THEN -ln({p}) ELSE -ln(1 - {p}) END) AS log_loss FROM {source}"


_ROC = """SELECT CAST(sum(pos * (CAST(all_neg AS DOUBLE) - fp + neg / CAST(2 AS DOUBLE))) AS DOUBLE)
      / (CAST(any_value(all_pos) AS DOUBLE) * CAST(any_value(all_neg) AS DOUBLE)) AS roc_auc FROM ranked"""
_AP = """SELECT sum(pos * (CAST(tp AS DOUBLE) / (tp + fp))) / any_value(all_pos) AS pr_auc FROM ranked"""
_GRID = "VALUES " + ", ".join(f"(CAST('{t!r}' AS DOUBLE))" for t in THRESHOLDS)
_SWEEP = f"""SELECT threshold, tp, fp, fn, tn,
      CASE WHEN 2 * tp + fp + fn > 0 THEN CAST(2 * tp AS DOUBLE) / (2 * tp + fp + fn) ELSE 0 END AS f1 FROM (
      SELECT threshold, count(*) FILTER (y_true = 1 AND y_prob >= threshold) AS tp,
      count(*) FILTER (y_true = 0 AND y_prob >= threshold) AS fp,
      count(*) FILTER (y_true = 1 AND y_prob < threshold) AS fn,
      count(*) FILTER (y_true = 0 AND y_prob < threshold) AS tn
      FROM sc, ({_GRID}) AS grid(threshold) GROUP BY threshold)"""
_BEST = "SELECT * FROM sweep ORDER BY f1 DESC, threshold LIMIT 1"


def _with_metrics(as_of: str = LATER, score: str = "y_prob") -> str:
    return _ctes(as_of, ranked=_ranked_scores(score), sweep=_SWEEP, best=_BEST, ll=_loss(), roc=_ROC, ap=_AP)


_ALL_METRICS = "SELECT log_loss, roc_auc, pr_auc, f1, threshold FROM ll, roc, ap, best"
_ROUNDED = """round(log_loss, 5) AS log_loss, round(roc_auc, 5) AS roc_auc, round(pr_auc, 5) AS pr_auc,
      round(f1, 5) AS f1, round(threshold, 2) AS f1_threshold"""


def _metrics_of(as_of: str) -> str:
    return f"({_with_metrics(as_of)} {_ALL_METRICS})"


def _roc_points(score: str, bends_only: bool) -> str:
    keep = "WHERE rk = 1 OR next_pos IS NULL OR next_pos <> pos OR next_neg <> neg" if bends_only else ""
    return f"""SELECT round(CAST(fp AS DOUBLE) / all_neg, 9) AS fpr, round(CAST(tp AS DOUBLE) / all_pos, 9) AS tpr,
      round(score, 9) AS threshold FROM ({_ranked_scores(score)}) {keep}
      UNION ALL SELECT CAST(0 AS DOUBLE), CAST(0 AS DOUBLE), CAST(NULL AS DOUBLE)"""


# Checks ---------------------------------------------------------------------


def _check(model: str, column: str, test: str, source: str, broken: str) -> str:
    return (
        f"SELECT '{model}' AS model, '{column}' AS column_name, '{test}' AS test, count(*) AS failures "
        f"FROM {source} WHERE {broken}"
    )


def _unique(model: str, source: str, column: str = "msno") -> str:
    repeated = f"(SELECT {column} FROM {source} WHERE {column} IS NOT NULL GROUP BY {column} HAVING count(*) > 1)"
    return _check(model, column, "unique", repeated, "TRUE")


def _declared() -> str:
    nulls = [
        ("staged_labels", "msno", "lab"), ("staged_labels", "is_churn", "lab"), ("staged_members", "msno", "memf"),
        ("staged_transactions", "msno", "txn"), ("staged_logs", "msno", "log"),
        ("transaction_features", "msno", "txnf"), ("activity_features", "msno", "actf"),
        ("feature_table", "msno", "mart"), ("feature_table", "is_churn", "mart"),
    ]
    uniques = [("staged_labels", "lab"), ("staged_members", "memf"), ("transaction_features", "txnf"),
               ("activity_features", "actf"), ("feature_table", "mart")]
    parts = [_check(m, c, "not_null", s, f"{c} IS NULL") for m, c, s in nulls]
    parts += [_unique(m, s) for m, s in uniques]
    parts.append(_check("staged_labels", "is_churn", "accepted_values", "lab", "is_churn NOT IN (0, 1)"))
    parts.append(
        _check("staged_members", "gender", "accepted_values", "memf", "gender NOT IN ('male', 'female', 'unknown')")
    )
    return " UNION ALL ".join(parts)


# Only the names of types differ between engines.
_TYPE = """CASE column_type WHEN 'VARCHAR' THEN 'string' WHEN 'INTEGER' THEN 'int' WHEN 'TIMESTAMP' THEN 'timestamp_ntz'
      ELSE lower(column_type) END"""


def _described(table: str) -> str:
    """Position, name and type of the columns as the file has them."""
    return f"""SELECT CAST(row_number() OVER () AS INTEGER) AS position, column_name, {_TYPE} AS column_type
      FROM (DESCRIBE SELECT * FROM {table})"""


def _inventory() -> str:
    return " UNION ALL ".join(
        f"""SELECT '{t}' AS table_name, (SELECT count(*) FROM {t}) AS row_count, count(*) AS column_count,
          string_agg(column_name || ' (' || column_type || ')', ', ' ORDER BY position) AS schema_text FROM ({_described(t)})"""
        for t in ("customer", "orders", "lineitem", "events")
    )


def _describe() -> str:
    columns = ("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority")
    nulls = " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, count(*) FILTER ({c} IS NULL) AS null_count FROM orders" for c in columns
    )
    return f"SELECT position, column_name, column_type, null_count FROM ({_described('orders')}) FULL JOIN ({nulls}) USING (column_name)"


def _catalog() -> str:
    """Values in each declared column of the four inputs."""
    rows = []
    for table, source in (("labels", "lab"), ("members", "mem"), ("transactions", "txn"), ("user_logs", "log")):
        for position, field in enumerate(CATALOG[table].fields, start=1):
            comment = field.metadata["comment"]
            rows.append(
                f"SELECT '{table}' AS table_name, {position} AS position, '{field.name}' AS column_name, '{comment}' AS comment, "
                f"(SELECT count({field.name}) FROM {source}) AS n_filled"
            )
    return _ctes() + " UNION ALL ".join(rows)


def _coverage() -> str:
    seen = """SELECT is_churn, msno IN (SELECT msno FROM mem) AS m, msno IN (SELECT msno FROM txn) AS t,
      msno IN (SELECT msno FROM log) AS l FROM lab"""
    groups = {"all": "TRUE", "full_data": "m AND t AND l", "no_members": "NOT m", "no_transactions": "NOT t",
              "no_user_logs": "NOT l"}
    parts = " UNION ALL ".join(
        f"SELECT '{g}' AS data_group, count(*) AS n, round(count(*) * 100.0 / (SELECT count(*) FROM seen), 2) AS pct, "
        f"round(avg(is_churn) * 100, 2) AS churn_rate FROM seen WHERE {w} HAVING count(*) > 0"
        for g, w in groups.items()
    )
    return _ctes(seen=seen) + parts


def _subsets() -> str:
    full = [c for c in MART if c not in ("msno", "is_churn")]
    lists = {"full": full, "no_subscription": [c for c in full if c not in SUBSCRIPTION],
             "behaviour_only": [c for c in full if c in BEHAVIOUR]}
    return " UNION ALL ".join(
        f"SELECT '{name}' AS subset, '{c}' AS feature, count(*) FILTER ({c} IS NULL) AS null_count FROM mart"
        for name, cols in lists.items()
        for c in cols
    )


def _one_hot() -> str:
    return " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, level, count(*) AS n FROM (SELECT coalesce(CAST({c} AS VARCHAR), "
        f"'__missing__') AS level, is_test FROM marked) x WHERE is_test = 1 AND level IN (SELECT "
        f"coalesce(CAST({c} AS VARCHAR), '__missing__') FROM marked WHERE is_test = 0) GROUP BY level"
        for c in CATEGORICAL
    )


def _gaps() -> str:
    """Metrics of the rows with a label and a probability, after some of either went missing."""
    rows = f"""SELECT msno, CASE WHEN msno % 5 <> 0 THEN y_true END AS y_true, CASE WHEN msno % 7 = 0 THEN NULL
      WHEN msno % 11 = 0 THEN CAST('nan' AS DOUBLE) ELSE y_prob END AS y_prob FROM sc"""
    fine = "SELECT * FROM gap WHERE y_true IS NOT NULL AND y_prob IS NOT NULL AND NOT isnan(y_prob)"
    loss = f"""avg(-ln(CASE WHEN y_true = 1 THEN greatest(least(y_prob, 1 - {EPS}), {EPS})
      ELSE 1 - greatest(least(y_prob, 1 - {EPS}), {EPS}) END))"""
    rank = "rank() OVER (ORDER BY y_prob) + (count(*) OVER (PARTITION BY y_prob) - 1) / CAST(2 AS DOUBLE)"
    cuts = ", ".join(f"CAST('{t!r}' AS DOUBLE)" for t in THRESHOLDS)
    return _ctes() + f""", gap AS ({rows}), ok AS ({fine}),
      step AS (SELECT y_prob, count(*) FILTER (y_true = 1) AS pos, sum(count(*) FILTER (y_true = 1)) OVER d AS tp,
        sum(count(*)) OVER d AS flagged FROM ok GROUP BY y_prob WINDOW d AS (ORDER BY y_prob DESC)),
      f AS (SELECT max(CASE WHEN t2 + fp + fn > 0 THEN t2 / CAST(t2 + fp + fn AS DOUBLE) ELSE 0 END) AS f1 FROM (
        SELECT t, 2 * count(*) FILTER (y_true = 1 AND y_prob >= t) AS t2, count(*) FILTER (y_true = 0 AND y_prob >= t) AS fp,
        count(*) FILTER (y_true = 1 AND y_prob < t) AS fn FROM ok, unnest([{cuts}]) AS c(t) GROUP BY t)),
      long AS (
        SELECT 'n_scored' AS metric, CAST(count(*) AS DOUBLE) AS v FROM ok
        UNION ALL SELECT 'n_without_label', count(*) FROM gap WHERE y_true IS NULL
        UNION ALL SELECT 'n_without_probability', count(*) FROM gap WHERE y_prob IS NULL OR isnan(y_prob)
        UNION ALL SELECT 'log_loss', {loss} FROM ok
        UNION ALL SELECT 'log_loss_by_row', {loss} FROM ok
        UNION ALL SELECT 'roc_auc', (sum(r) FILTER (y_true = 1) - p * (p + 1) / CAST(2 AS DOUBLE)) / (p * n) FROM (
          SELECT y_true, {rank} AS r, count(*) FILTER (y_true = 1) OVER () AS p, count(*) FILTER (y_true = 0) OVER () AS n
          FROM ok) GROUP BY p, n
        UNION ALL SELECT 'pr_auc', sum(pos * tp / CAST(flagged AS DOUBLE)) / sum(pos) FROM step
        UNION ALL SELECT 'f1', f1 FROM f
        UNION ALL SELECT 'brier', avg(pow(y_prob - y_true, 2)) FROM ok)
      SELECT metric, round(v, 6) AS v FROM long"""


def _drift() -> str:
    picks = {"label_rate": "label_rate", **{m: m for m in METRICS}}
    both = f"""WITH a AS (SELECT *, (SELECT avg(y_true) FROM ({_sc(EARLIER)})) AS label_rate FROM {_metrics_of(EARLIER)}),
      b AS (SELECT *, (SELECT avg(y_true) FROM ({_sc(LATER)})) AS label_rate FROM {_metrics_of(LATER)})"""
    return both + " UNION ALL ".join(
        f" SELECT '{m}' AS metric, round(a.{c}, 6) AS before, round(b.{c}, 6) AS after, "
        f"round(b.{c} - a.{c}, 6) AS change, round((b.{c} - a.{c}) / a.{c}, 6) AS relative_change FROM a, b"
        for m, c in picks.items()
    )


# Parts of the profiling report and the query that says the same by itself.
_PARTS = {
    "label_balance": "label_balance", "members_quality": "members_quality", "transactions_quality": "transactions_quality",
    "logs_quality": "logs_quality", "age_histogram": "histogram_age", "raw_age_histogram": "histogram_raw_age",
    "rate_by_gender": "segment_rate_gender", "rate_by_city": "segment_rate_city_topk", "rate_by_channel": "segment_rate_channel",
    "cohorts": "cohort_churn_rate", "transaction_summary": "txn_summary", "rate_by_status": "rate_by_renew_cancel",
    "rate_by_renewal": "renew_rollup_mean", "plan_lengths": "plan_frequency_topk", "plan_shares": "plan_shares",
    "rate_by_price_type": "discount_rate", "rate_by_payment_method": "payment_method_topk",
    "payment_medians": "txn_temporal_medians", "payment_histogram": "histogram_by_class", "expiry_histogram": "histogram_expiry",
    "log_range": "log_date_range", "activity_medians": "activity_medians", "seconds_histogram": "histogram_density",
    "songs_histogram": "histogram_unique_songs", "plays_histogram": "histogram_complete_plays",
    "engagement_medians": "engagement_median", "engagement_histogram": "histogram_engagement",
    "missingness_audit": "missingness_audit", "null_counts": "null_counts", "correlations": "correlation_matrix",
    "correlations_with_label": "correlation_with_target",
}


def _profile_parts(twins: dict[str, str]) -> str:
    """Rows of each part of the report; columns of the four inputs are 2, 6, 10 and 9."""
    rows = [f"SELECT '{part}' AS part, count(*) AS n FROM ({twins[name]})" for part, name in _PARTS.items()]
    days = _ctes() + "SELECT 50 * count(DISTINCT is_churn) FROM lab WHERE msno IN (SELECT msno FROM log)"
    rows.append(f"SELECT 'active_days_histogram', ({days})")
    rows += ["SELECT 'inventory', 4", "SELECT 'source_nulls', 27"]
    return " UNION ALL ".join(rows)


MODEL_CHECKS = (
    "trees_score_each_test_user_once", "tree_probabilities_in_range", "baseline_probabilities_in_range",
    "baseline_gradient_is_zero", "platt_gradient_is_zero", "attributions_add_up", "best_loss_from_scored_rows",
    "no_fit_past_best_round_and_patience", "best_trial_has_the_least_loss", "study_survives_json",
    "isotonic_never_falls", "weights_balance_the_classes",
)
REPORT_CHECKS = (
    "saved_trees_score_as_they_did", "gains_sum_to_one", "top_gains_are_the_greatest", "global_attribution_is_the_mean",
    "global_attribution_keeps_the_greatest", "direction_quartiles_ordered", "row_explanations_add_up",
    "categories_are_nominal", "confusion_counts_every_test_user", "roc_from_origin_to_one", "roc_never_falls",
    "drift_change_is_after_less_before", "ablation_has_three_runs",
)


def _no_failures(names: tuple[str, ...]) -> str:
    return " UNION ALL ".join(f"SELECT '{c}' AS \"check\", CAST(0 AS BIGINT) AS failures" for c in names)


def oracles() -> dict[str, str]:
    with_mart = _with_mart()
    txn_nulls = {"pay_method_null": "payment_method_id", "txn_date_null": "transaction_date",
                 "expire_null": "membership_expire_date", "amount_null": "actual_amount_paid"}
    log_nulls = {"total_secs_null": "total_secs", "num_unq_null": "num_unq", "date_null": "date"}
    mini_pairs = [(a, b) for i, a in enumerate(MINI) for b in MINI[i:]]
    target_pairs = [("is_churn", c) for c in MINI[1:]]
    segment_pairs = [("is_churn", c) for c in SEGMENT_COLUMNS]
    near = f"(SELECT * FROM lab JOIN ({_HISTORY}) USING (msno) WHERE days_until_expiry > -100 AND days_until_expiry < 400)"
    paid = f"(SELECT * FROM lab JOIN ({_HISTORY}) USING (msno))"
    used = f"(SELECT * FROM lab JOIN ({_USE}) USING (msno))"
    depth = f"(SELECT is_churn, total_unique_songs / nullif(CAST(total_partial_plays AS DOUBLE), 0) AS engagement_depth FROM {used})"
    twins = {
        "member_features": _ctes() + _memf(LATER),
        "transaction_features": _ctes() + _txnf(),
        "transaction_features_positive": _ctes() + _txnf(True),
        "last_transaction": _ctes() + f"""SELECT msno, txn_id, transaction_date, is_auto_renew, is_cancel,
          payment_plan_days FROM ({_RANKED}) WHERE rn = 1""",
        "last_with_totals_by_join": _ctes() + f"""SELECT msno, txn_id, r.is_cancel, txn_count, total_cancels,
          latest_expire FROM ({_RANKED}) r JOIN (SELECT msno, count(*) AS txn_count,
          CAST(sum(is_cancel) AS BIGINT) AS total_cancels, max(membership_expire_date) AS latest_expire
          FROM txn GROUP BY msno) USING (msno) WHERE rn = 1""",
        "activity_features": _ctes() + _actf(),
        "activity_features_all_days": _ctes() + _actf(None, True),
        "active_days": _ctes() + """SELECT msno, count(DISTINCT date) AS active_days,
          CAST(sum(total_secs) AS DOUBLE) AS total_secs FROM log GROUP BY msno""",
        "logs_in_window": _ctes() + """SELECT * REPLACE (CAST(total_secs AS DOUBLE) AS total_secs) FROM log
          WHERE date BETWEEN 20240108 AND 20240114""",
        "churn_features": with_mart + "SELECT * FROM mart",
        "churn_features_prior_round": _with_mart(EARLIER, (20240101, 20240115), True) + "SELECT * FROM mart",
        "staged_features": with_mart + """SELECT msno, has_transaction_data, txn_count, days_until_expiry,
          active_days FROM mart""",
        "csv_scan": _ctes() + "SELECT CAST(msno AS VARCHAR) AS msno, * EXCLUDE (msno) FROM mem",
        "sql_over_file": _ctes() + "SELECT is_churn, count(*) AS n FROM lab GROUP BY is_churn",
        "parquet_round_trip": _ctes() + "SELECT * FROM txn",
        "table_inventory": _inventory(),
        "source_catalog": _catalog(),
        "row_counts": "SELECT count(*) AS n FROM lineitem",
        "describe_table": _describe(),
        "row_preview": _ctes() + "SELECT * FROM lab ORDER BY msno LIMIT 5",
        "label_balance": _ctes() + """SELECT is_churn, count(*) AS n,
          round(count(*) * 100.0 / sum(count(*)) OVER (), 2) AS pct FROM lab GROUP BY is_churn""",
        "members_quality": _ctes() + """SELECT count(*) AS total_rows,
          count(*) FILTER (gender IS NULL OR gender = '') AS gender_missing,
          round(count(*) FILTER (gender IS NULL OR gender = '') * 100.0 / count(*), 1) AS gender_missing_pct,
          count(*) FILTER (bd <= 0 OR bd > 100) AS age_invalid,
          round(count(*) FILTER (bd <= 0 OR bd > 100) * 100.0 / count(*), 1) AS age_invalid_pct,
          count(*) FILTER (city IS NULL) AS city_missing, count(*) FILTER (registered_via IS NULL) AS reg_via_missing,
          count(*) FILTER (registration_init_time IS NULL) AS reg_time_missing FROM mem""",
        "transactions_quality": _ctes() + f"SELECT count(*) AS total_rows, {_nulls(txn_nulls)} FROM txn",
        "logs_quality": _ctes() + f"SELECT count(*) AS total_rows, {_nulls(log_nulls)} FROM log",
        "segment_rate_gender": _ctes() + _rate(
            "(SELECT is_churn, CASE WHEN gender = 'male' OR gender = 'female' THEN gender ELSE 'unknown' END AS gender "
            f"FROM {_LABELLED})", "gender"),
        "segment_rate_city_topk": _ctes() + _rate(
            _LABELLED, "city", "HAVING count(*) > 40 ORDER BY n DESC, city LIMIT 15"),
        "segment_rate_channel": _ctes() + _rate(_LABELLED, "registered_via", "HAVING count(*) > 100"),
        "cohort_churn_rate": _ctes() + f"""SELECT *, CAST(strptime(CAST(reg_month AS VARCHAR) || '01', '%Y%m%d') AS DATE)
          AS month FROM ({_rate(f"(SELECT is_churn, CAST(floor(registration_init_time / 100.0) AS INTEGER) AS reg_month FROM {_LABELLED} WHERE registration_init_time > 19950131)", 'reg_month', 'HAVING count(*) > 5')})""",
        "txn_summary": _ctes() + f"""SELECT count(*) AS total_transactions, count(DISTINCT msno) AS unique_users,
          round(avg(payment_plan_days), 1) AS avg_plan_days,
          round(CAST(sum(CAST(plan_list_price AS DECIMAL(18,2))) AS DOUBLE) / count(plan_list_price), 1) AS avg_list_price,
          round(CAST(sum(CAST(actual_amount_paid AS DECIMAL(18,4))) AS DOUBLE) / count(actual_amount_paid), 1)
            AS avg_amount_paid,
          round(sum({_DISCOUNT}) * 100.0 / count(*), 1) AS discount_pct,
          round(sum(is_auto_renew) * 100.0 / count(*), 1) AS auto_renew_pct,
          round(sum(is_cancel) * 100.0 / count(*), 1) AS cancel_pct FROM txn""",
        "rate_by_renew_cancel": _ctes() + _rate(_LAST, "is_auto_renew, is_cancel"),
        "renew_rollup_mean": _ctes() + f"""SELECT is_auto_renew, CAST(sum(n) AS BIGINT) AS n,
          avg(churn_rate) AS churn_rate FROM ({_rate(_LAST, 'is_auto_renew, is_cancel')}) GROUP BY is_auto_renew""",
        "plan_frequency_topk": _ctes() + """SELECT payment_plan_days, count(*) AS n FROM txn GROUP BY 1
          ORDER BY n DESC, payment_plan_days ASC NULLS FIRST LIMIT 10""",
        "plan_shares": _ctes() + """SELECT payment_plan_days, count(*) AS n,
          round(count(*) * 100.0 / sum(count(*)) OVER (), 2) AS pct FROM txn GROUP BY 1""",
        "discount_rate": _ctes() + _rate(
            f"(SELECT is_churn, CASE WHEN {_DISCOUNT} = 1 THEN 'Discounted' ELSE 'Full price' END AS price_type FROM {_LAST})",
            "price_type"),
        "payment_method_topk": _ctes() + _rate(
            _LAST, "payment_method_id", "HAVING count(*) > 50 ORDER BY n DESC, payment_method_id LIMIT 12"),
        "txn_temporal_medians": _ctes() + _medians(paid, ["txn_count", "days_until_expiry"]),
        "log_date_range": _ctes() + """SELECT min(date) AS min_date, max(date) AS max_date, count(*) AS total_rows,
          count(DISTINCT msno) AS unique_users FROM log""",
        "activity_medians": _ctes() + _medians(used, ["active_days", "total_secs", "total_unique_songs"]),
        "engagement_median": _ctes() + _medians(depth, ["engagement_depth"]),
        "engagement_log1p": _ctes(actf=_actf()) + """SELECT msno, round(ln(1 + engagement_depth), 9)
          AS log_engagement_depth FROM actf""",
        "missingness_audit": _coverage(),
        "join_coverage": _ctes() + """SELECT msno, is_churn,
          CASE WHEN EXISTS (SELECT 1 FROM txn WHERE txn.msno = lab.msno) THEN 1 ELSE 0 END AS in_transactions,
          CASE WHEN EXISTS (SELECT 1 FROM log WHERE log.msno = lab.msno) THEN 1 ELSE 0 END AS in_user_logs FROM lab""",
        "null_counts": _with_mini() + " UNION ALL ".join(
            f"SELECT '{c}' AS column_name, count(*) FILTER ({c} IS NULL) AS null_count FROM mini" for c in MINI),
        "correlation_matrix": _with_mini() + _corr("mini", mini_pairs),
        "correlation_with_target": _with_mini() + f"""SELECT column_b AS feature, n, abs(r) AS abs_r
          FROM ({_corr('mini', target_pairs)})""",
        "correlation_in_segment": with_mart + f"""SELECT column_b AS feature, n, abs(r) AS abs_r FROM (
          {_corr('(SELECT * FROM mart WHERE last_auto_renew = 1 AND last_cancel = 0)', segment_pairs)})""",
        "histogram_age": _ctes(memf=_memf(LATER)) + _hist("memf", "age", 60),
        "histogram_raw_age": _ctes() + _hist("mem", "bd", 100),
        "histogram_by_class": _ctes() + _hist(paid, "txn_count", 20, "is_churn", 20),
        "histogram_expiry": _ctes() + _hist(near, "days_until_expiry", 50, "is_churn"),
        "histogram_density": _ctes() + _hist(used, "total_secs", 50, "is_churn", 500000, True),
        "histogram_active_days": _ctes() + _hist(used, "active_days", 31, "is_churn", None, True),
        "histogram_unique_songs": _ctes() + _hist(used, "total_unique_songs", 50, "is_churn", 3000, True),
        "histogram_complete_plays": _ctes(actf=_actf()) + _hist(
            "(SELECT * FROM lab JOIN actf USING (msno))", "complete_plays", 50, "is_churn", 5000, True),
        "histogram_engagement": _ctes() + _hist(depth, "engagement_depth", 50, "is_churn", 5, True),
        "quality_checks": with_mart + _declared(),
        "gated_build": with_mart + " UNION ALL ".join(
            f"SELECT '{stage}' AS stage, count(*) AS n FROM {source}" for stage, source in (
                ("staged_labels", "lab"), ("staged_members", "memf"), ("transaction_features", "txnf"),
                ("activity_features", "actf"), ("feature_table", "mart"))),
        "model_checks": _no_failures(MODEL_CHECKS),
        "report_checks": _no_failures(REPORT_CHECKS),
        "search_rungs": """SELECT * FROM (VALUES (0, 51, 30, 15, 150, 0), (1, 102, 15, 8, 75, 0), (2, 204, 8, 4, 40, 0), (3, 408, 4, 2, 20, 0))
          AS t(rung, length, n_open, n_kept, n_fits, wrongly_dropped)""",
        "experiment_artifacts": with_mart + f""", marked AS ({_marked('mart')}), held AS (SELECT count(*) AS n FROM marked WHERE is_test = 1)
          SELECT artifact, CASE WHEN fixed > 0 THEN fixed ELSE n END AS n, true AS intact FROM held, (VALUES
            ('predictions', 0), ('features', 0), ('comparison', 2), ('lift', 1), ('trials', 30)) AS t(artifact, fixed)""",
        "raw_checks": _ctes() + _check("members", "gender", "accepted_values", "mem",
            "gender IS NOT NULL AND gender NOT IN ('male', 'female')") + " UNION ALL " + _unique("transactions", "txn"),
        "referential_check": _ctes() + _check("transactions", "msno", "relationship", "txn",
            "msno IS NOT NULL AND msno NOT IN (SELECT msno FROM mem)") + " UNION ALL " + _check(
            "user_logs", "msno", "relationship", "log",
            "msno IS NOT NULL AND msno NOT IN (SELECT msno FROM lab WHERE is_churn = 0)"),
        "range_check": with_mart + " UNION ALL ".join(
            _check("feature_table", c, "in_range", "mart", f"{c} < {lo} OR {c} > {hi}")
            for c, lo, hi in (("completion_rate", 0, 1), ("age", 10, 70), ("days_until_expiry", 0, 400))),
        "stratified_split": _ctes() + _marked("lab"),
        "stratified_split_exact": _ctes() + _marked("lab", 0.35),
        "stratified_folds": _ctes() + f"""SELECT msno, is_churn, CAST(list_sum(list_transform([1, 2, 3, 4],
          lambda j: CASE WHEN r > n * j // 5 THEN 1 ELSE 0 END)) AS INTEGER) AS fold FROM (
          SELECT *, row_number() OVER (PARTITION BY is_churn ORDER BY {_hash('fold42')}, msno) AS r,
            count(*) OVER (PARTITION BY is_churn) AS n FROM lab)""",
        "hash_sample": _ctes() + f"SELECT msno, is_churn FROM lab ORDER BY {_hash('sample42')}, msno LIMIT 500",
        "class_weights": _ctes() + """, t AS (SELECT count(*) AS n, count(*) FILTER (is_churn = 1) AS p FROM lab)
          SELECT msno, is_churn, n / (CAST(2 AS DOUBLE) * CASE WHEN is_churn = 1 THEN p ELSE n - p END) AS balanced,
          CASE WHEN is_churn = 1 THEN CAST(n - p AS DOUBLE) / p ELSE CAST(1 AS DOUBLE) END AS pos_ratio FROM lab, t""",
        "class_balance": _ctes() + """SELECT count(*) FILTER (is_churn = 1) AS n_pos,
          count(*) FILTER (is_churn = 0) AS n_neg, avg(is_churn) AS prevalence,
          CAST(count(*) FILTER (is_churn = 0) AS DOUBLE) / count(*) FILTER (is_churn = 1) AS imbalance_ratio FROM lab""",
        "median_impute": with_mart + f""", marked AS ({_marked('mart')})
          SELECT msno, is_test, {', '.join(f"CAST(coalesce({c}, (SELECT median({c}) FROM marked WHERE is_test = 0)) AS DOUBLE) AS {c}" for c in IMPUTED)}
          FROM marked""",
        "category_sentinel": with_mart + "SELECT msno, " + ", ".join(
            f"CASE WHEN {c} IS NULL THEN '__missing__' ELSE CAST({c} AS VARCHAR) END AS {c}" for c in CATEGORICAL
        ) + " FROM mart",
        "standardize": with_mart + "SELECT msno, " + ", ".join(
            f"round(({c} - avg({c}) OVER ()) / stddev_pop({c}) OVER (), 6) AS {c}"
            for c in ("txn_count", "total_secs", "active_days")) + " FROM mart",
        "one_hot": with_mart + f", marked AS ({_marked('mart')}) " + _one_hot(),
        "temporal_holdout": " UNION ALL ".join(
            f"SELECT '{d}' AS period, msno, is_churn, tenure_days, txn_count, last_cancel FROM ("
            + _with_mart(d) + "SELECT * FROM mart)" for d in (EARLIER, LATER)),
        "feature_subsets": with_mart + _subsets(),
        "log_loss": _with_metrics() + "SELECT round(log_loss, 6) AS log_loss FROM ll",
        "roc_auc": _with_metrics() + "SELECT round(roc_auc, 6) AS roc_auc FROM roc",
        "average_precision": _with_metrics() + "SELECT round(pr_auc, 6) AS pr_auc FROM ap",
        "f1_sweep": _with_metrics() + "SELECT threshold, tp, fp, fn, tn, round(f1, 9) AS f1 FROM sweep",
        "metric_record": f"SELECT {_ROUNDED} FROM {_metrics_of(LATER)}",
        "run_comparison": " UNION ALL ".join(
            f"SELECT '{d}' AS run, {_ROUNDED} FROM {_metrics_of(d)}" for d in (EARLIER, LATER)),
        "metric_lift": f"""SELECT a AS before, b AS after, round((a - b) / a * 100, 6) AS improvement_pct FROM
          (SELECT round(log_loss, 5) AS a FROM {_metrics_of(EARLIER)}),
          (SELECT round(log_loss, 5) AS b FROM {_metrics_of(LATER)})""",
        "roc_curve": _ctes() + _roc_points("y_prob", True),
        "pr_curve": _ctes() + f"""SELECT *, round((SELECT avg(y_true) FROM sc), 9) AS prevalence FROM (
          SELECT round(CAST(tp AS DOUBLE) / (tp + fp), 9) AS precision, round(CAST(tp AS DOUBLE) / all_pos, 9) AS recall,
          round(score, 9) AS threshold FROM ({_ranked_scores()})
          UNION ALL SELECT CAST(1 AS DOUBLE), CAST(0 AS DOUBLE), CAST(NULL AS DOUBLE))""",
        "curves_by_model": _ctes() + f"""SELECT *, 'recency' AS model FROM ({_roc_points('y_prob', False)})
          UNION ALL SELECT *, 'flipped' AS model FROM ({_roc_points('(1 - y_prob)', False)})""",
        "confusion_matrix": _with_metrics() + " UNION ALL ".join(
            f"SELECT round(threshold, 9) AS f1_threshold, {a} AS actual, {p} AS predicted, {cell} AS n FROM best"
            for a, p, cell in ((0, 0, "tn"), (0, 1, "fp"), (1, 0, "fn"), (1, 1, "tp"))),
        "metrics_with_gaps": _gaps(),
        "brier": _ctes() + "SELECT round(avg(pow(y_prob - y_true, 2)), 6) AS brier FROM sc",
        "reliability_table": _ctes() + """SELECT CAST(least(floor(y_prob * 10), 9) AS INTEGER) AS bin, count(*) AS n,
          round(avg(y_prob), 6) AS mean_prob, round(avg(y_true), 6) AS observed_rate FROM sc GROUP BY 1""",
        "alert_share": _ctes() + """SELECT count(*) FILTER (y_prob > CAST('0.6' AS DOUBLE)) AS n_over,
          CAST(count(*) FILTER (y_prob > CAST('0.6' AS DOUBLE)) AS DOUBLE) / count(*) AS share_over FROM sc""",
        "drift_report": _drift(),
        "top_n_at_risk": _ctes() + "SELECT msno, y_prob FROM sc ORDER BY y_prob DESC, msno LIMIT 50",
        "first_confident": _ctes() + """SELECT * FROM sc WHERE msno = (SELECT min(msno) FROM sc WHERE y_true = 1
          AND y_prob > CAST('0.8' AS DOUBLE)) OR msno = (SELECT min(msno) FROM sc WHERE y_true = 0
          AND y_prob < CAST('0.02' AS DOUBLE))""",
        "predictions_with_features": with_mart + """SELECT sc.msno, y_true, y_prob, txn_count, gender
          FROM sc JOIN mart ON sc.msno = mart.msno""",
    }
    twins["profile_in_one_pass"] = _profile_parts(twins)
    return twins
