"""The same results in ANSI SQL (DuckDB) over the raw tables, for the result check."""

from __future__ import annotations

from weekloom.operators.cluster import VOLUME
from weekloom.operators.features import LAG_RATIOS, LAGS, NUMERIC, ROLLING
from weekloom.operators.profile import PROFILE
from weekloom.plans.queries import (CENTERS, CURVE_BINS, DIGITS, EM_INPUTS, EM_START, EM_STEPS, LLOYD_STEPS, NEWTON_INPUTS, SCALED, SPLIT_INPUTS,
                                    STUMP_INPUTS, SWEEP, TICKET)
from weekloom.sources.star_schema import CUT, END, EVENTS, START, USER_END, USER_START

N_DAYS = (END - START).days + 1
DATES = f"DATE '{START}' AND DATE '{END}'"


def rnd(name: str, digits: int) -> str:
    return f"round({name}, {digits}) AS {name}"


def shown(names: list[str]) -> str:
    return ", ".join(rnd(n, DIGITS[n]) if n in DIGITS else n for n in names)


CTE = {
    "ent": """
        SELECT s_suppkey AS entity_id, r_name AS segment, s_acctbal AS acctbal
        FROM supplier JOIN nation ON s_nationkey = n_nationkey
        JOIN region ON n_regionkey = r_regionkey""",
    "rec": f"""
        SELECT l_suppkey AS entity_id, CAST(l_shipdate AS DATE) AS day,
               CAST(l_extendedprice AS DECIMAL(18,2)) AS value, 1 AS n_ok,
               CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS n_failed
        FROM lineitem WHERE CAST(l_shipdate AS DATE) BETWEEN {DATES}""",
    "ev": "SELECT unnest([" + ", ".join(f"DATE '{e}'" for e in EVENTS) + "]) AS e",
    "spine": f"""
        SELECT CAST(unnest(generate_series(TIMESTAMP '{START}', TIMESTAMP '{END}', INTERVAL 1 DAY)) AS DATE) AS day""",
    "cal": """
        SELECT day, CASE WHEN isodow(day) >= 6 THEN 1 ELSE 0 END AS is_weekend,
               CASE WHEN day(day) <= 3 OR day(day) >= 28 THEN 1 ELSE 0 END AS is_payday,
               CASE WHEN EXISTS (SELECT 1 FROM ev WHERE spine.day BETWEEN e - 3 AND e + 1)
                    THEN 1 ELSE 0 END AS is_event
        FROM spine""",
    "daily": """
        SELECT entity_id, day, CAST(sum(value) AS DOUBLE) AS value,
               CAST(sum(n_ok) AS BIGINT) AS n_ok, CAST(sum(n_failed) AS BIGINT) AS n_failed
        FROM rec GROUP BY entity_id, day""",
    "panel": """
        SELECT ent.entity_id, segment, cal.day, coalesce(value, 0) AS value,
               coalesce(n_ok, 0) AS n_ok, coalesce(n_failed, 0) AS n_failed,
               is_weekend, is_payday, is_event
        FROM ent CROSS JOIN cal LEFT JOIN daily ON daily.entity_id = ent.entity_id AND daily.day = cal.day""",
    "weekly": """
        SELECT entity_id, segment, CAST(date_trunc('week', day) AS DATE) AS week_start,
               CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS wd,
               CAST(sum(n_ok) AS BIGINT) AS tx, CAST(sum(n_failed) AS BIGINT) AS failed,
               CAST(sum(is_payday) AS BIGINT) AS payday_days,
               CAST(sum(is_event) AS BIGINT) AS festival_days,
               CAST(sum(CASE WHEN is_weekend = 1 THEN CAST(value AS DECIMAL(18,2)) ELSE 0 END) AS DOUBLE) AS wd_weekend,
               CAST(sum(CASE WHEN n_ok = 0 THEN 1 ELSE 0 END) AS BIGINT) AS outage_days,
               count(*) AS n_days
        FROM panel GROUP BY entity_id, segment, CAST(date_trunc('week', day) AS DATE)
        HAVING count(*) = 7""",
    "wide": """
        SELECT *, lag(wd, 1) OVER w AS lag1_wd, lag(wd, 2) OVER w AS lag2_wd, lag(tx, 1) OVER w AS lag1_tx,
               lag(outage_days, 1) OVER w AS lag1_outage_days,
               avg(wd) OVER f AS roll4_wd, stddev_samp(wd) OVER f AS roll4_std,
               lag(wd / greatest(tx, 1), 1) OVER w AS lag1_avg_amt,
               lag(failed / greatest(tx, 1), 1) OVER w AS lag1_fail_rate,
               lag(wd_weekend / greatest(wd, 1), 1) OVER w AS lag1_weekend_share,
               sin(2 * pi() * week(week_start) / 52) AS woy_sin,
               cos(2 * pi() * week(week_start) / 52) AS woy_cos
        FROM weekly
        WINDOW w AS (PARTITION BY entity_id ORDER BY week_start),
               f AS (PARTITION BY entity_id ORDER BY week_start ROWS BETWEEN 4 PRECEDING AND 1 PRECEDING)""",
    "feat": "SELECT * FROM wide WHERE lag2_wd IS NOT NULL AND roll4_std IS NOT NULL",
    "thr": f"SELECT quantile_disc(wd, 0.5) AS t FROM feat WHERE week_start < DATE '{CUT}'",
    "lab": "SELECT feat.*, t, CASE WHEN wd > t THEN 1 ELSE 0 END AS y FROM feat, thr",
    "test": f"SELECT *, CASE WHEN lag1_wd > t THEN 1 ELSE 0 END AS p FROM lab WHERE week_start >= DATE '{CUT}'",
    "conf": """
        SELECT count(*) FILTER (y = 0 AND p = 0) AS TN, count(*) FILTER (y = 0 AND p = 1) AS FP,
               count(*) FILTER (y = 1 AND p = 0) AS FN, count(*) FILTER (y = 1 AND p = 1) AS TP
        FROM test""",
    "parts": """
        SELECT *, CAST(TN + FP + FN + TP AS DOUBLE) AS n,
               (TN + FP) / CAST(TN + FP + FN + TP AS DOUBLE) AS s0,
               (TP + FN) / CAST(TN + FP + FN + TP AS DOUBLE) AS s1,
               coalesce(TN / nullif(CAST(TN + FN AS DOUBLE), 0), 0) AS p0,
               coalesce(TP / nullif(CAST(TP + FP AS DOUBLE), 0), 0) AS p1,
               coalesce(TN / nullif(CAST(TN + FP AS DOUBLE), 0), 0) AS r0,
               coalesce(TP / nullif(CAST(TP + FN AS DOUBLE), 0), 0) AS r1
        FROM conf""",
    "raw": """
        SELECT TN, FP, FN, TP, (TN + TP) / n AS accuracy,
               s0 * p0 + s1 * p1 AS "precision", s0 * r0 + s1 * r1 AS recall,
               s0 * coalesce(2 * p0 * r0 / nullif(p0 + r0, 0), 0)
                 + s1 * coalesce(2 * p1 * r1 / nullif(p1 + r1, 0), 0) AS f1,
               p1 AS high_precision, r1 AS high_recall, 1 - r1 AS high_miss_rate
        FROM parts""",
    "meas": "SELECT TN, FP, FN, TP, "
    + ", ".join(
        f'round("{c}", 8) AS "{c}"'
        for c in ("accuracy", "precision", "recall", "f1", "high_precision", "high_recall", "high_miss_rate")
    )
    + " FROM raw",
    "cats": f"""
        SELECT segment, count(*) AS n_rows,
               CAST(row_number() OVER (ORDER BY count(*) DESC, segment) - 1 AS DOUBLE) AS loc_idx
        FROM feat WHERE week_start < DATE '{CUT}' GROUP BY segment""",
    "base": """
        SELECT entity_id, segment, avg(value) AS m, quantile_disc(value, 0.9) AS p90, avg(n_ok) AS a_ok,
               stddev_samp(value) AS sd, CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS total,
               CAST(sum(n_ok) AS DOUBLE) AS ok, CAST(sum(n_failed) AS DOUBLE) AS failed, max(value) AS top,
               avg(value) FILTER (is_weekend = 1) AS we, avg(value) FILTER (is_weekend = 0) AS wk,
               avg(value) FILTER (is_payday = 1) AS pay, avg(value) FILTER (is_payday = 0) AS nopay,
               count(*) AS n
        FROM panel GROUP BY entity_id, segment""",
    "prof": """
        SELECT entity_id, segment, total / n AS avg_daily_wd, p90 AS p90_daily_wd, a_ok AS avg_daily_tx,
               sd / nullif(total / n, 0) AS cv_wd, total / nullif(ok, 0) AS avg_txn_amount,
               we / nullif(wk, 0) AS weekend_ratio, pay / nullif(nopay, 0) AS payday_uplift,
               top / nullif(total / n, 0) AS peak_to_mean, failed / nullif(ok, 0) AS fail_rate
        FROM base""",
    "logs": "SELECT *, " + ", ".join(f"ln(1 + {c}) AS log_{c}" for c in VOLUME) + " FROM prof",
    "std": "SELECT *, "
    + ", ".join(
        f"(log_{c} - avg(log_{c}) OVER ()) / stddev_samp(log_{c}) OVER () AS log_{c}_scaled" for c in VOLUME
    )
    + " FROM logs",
    "dist": "SELECT *, "
    + ", ".join(
        " + ".join(f"(log_{c}_scaled - ({x})) ** 2" for c, x in zip(VOLUME, center)) + f" AS d{i}"
        for i, center in enumerate(CENTERS)
    )
    + " FROM std",
    "asg": """
        SELECT *, CASE WHEN d0 <= d1 AND d0 <= d2 THEN 0 WHEN d1 <= d2 THEN 1 ELSE 2 END AS prediction
        FROM dist""",
    "tiers": """
        SELECT prediction, avg(avg_daily_wd) AS mean_metric,
               CAST(row_number() OVER (ORDER BY avg(avg_daily_wd), prediction) AS INTEGER) AS tier_rank
        FROM asg GROUP BY prediction""",
    "named": """
        SELECT *, CASE tier_rank WHEN 1 THEN 'Low' WHEN 2 THEN 'Medium' WHEN 3 THEN 'High' END AS demand_tier
        FROM tiers""",
    "tiered": "SELECT asg.*, tier_rank, demand_tier FROM asg JOIN named USING (prediction)",
}

# which tables each one needs, nearest first
NEEDS = {
    "cal": ["ev", "spine"],
    "daily": ["rec"],
    "panel": ["ent", "cal", "daily"],
    "weekly": ["panel"],
    "wide": ["weekly"],
    "feat": ["wide"],
    "thr": ["feat"],
    "lab": ["thr"],
    "test": ["lab"],
    "conf": ["test"],
    "parts": ["conf"],
    "raw": ["parts"],
    "meas": ["raw"],
    "cats": ["feat"],
    "base": ["panel"],
    "prof": ["base"],
    "logs": ["prof"],
    "std": ["logs"],
    "dist": ["std"],
    "asg": ["dist"],
    "tiers": ["asg"],
    "named": ["tiers"],
    "tiered": ["named"],
}


def sql(select: str, *needs: str, **override: str) -> str:
    """``select`` behind the CTEs it needs, in dependency order."""
    order: list[str] = []

    def visit(name: str) -> None:
        for n in NEEDS.get(name, []):
            visit(n)
        if name not in order:
            order.append(name)

    for n in needs:
        visit(n)
    body = {**CTE, **override}
    kept = lambda n: "MATERIALIZED " if n in READ_OFTEN else ""
    return "WITH " + ",\n".join(f"{n} AS {kept(n)}({body[n]})" for n in order) + "\n" + select


# read once per step of an iteration
READ_OFTEN = {"two", "points", "pairs2", "vals"}


def steps_sql(first: str, step: str, n: int, last: str, *needs: str, **own: str) -> str:
    """``last`` over the state after ``n`` steps; ``step`` and ``last`` read the one-row state as ``st``."""
    states = {"st0": first} | {f"st{i + 1}": step.replace("FROM st", f"FROM st{i}") for i in range(n)}
    return sql(last.replace("FROM st", f"FROM st{n}"), *needs, *states, **own, **states)


def newton_sql(steps: int = 8) -> str:
    a, b = NEWTON_INPUTS
    scaled = lambda c: f"({c} - avg({c}) OVER ()) / stddev_samp({c}) OVER ()"
    sums = {"h00": "v", "h01": "v * a", "h02": "v * b", "h11": "v * a * a", "h12": "v * a * b", "h22": "v * b * b",
            "g0": "r", "g1": "r * a", "g2": "r * b"}
    det = lambda m: "(" + " + ".join(f"{m[0][i]} * ({m[1][(i + 1) % 3]} * {m[2][(i + 2) % 3]} - {m[1][(i + 2) % 3]} * {m[2][(i + 1) % 3]})" for i in range(3)) + ")"
    h = [["h00", "h01", "h02"], ["h01", "h11", "h12"], ["h02", "h12", "h22"]]
    swapped = lambda k: [[f"g{i}" if j == k else h[i][j] for j in range(3)] for i in range(3)]
    step = f"""
        SELECT {", ".join(f"w{k} + {det(swapped(k))} / {det(h)} AS w{k}" for k in range(3))} FROM (
          SELECT any_value(w0) AS w0, any_value(w1) AS w1, any_value(w2) AS w2, {", ".join(f"sum({v}) AS {k}" for k, v in sums.items())} FROM (
            SELECT *, p * (1 - p) AS v, y - p AS r FROM (
              SELECT *, 1 / (1 + exp(-(w0 + w1 * a + w2 * b))) AS p FROM (SELECT * FROM st), two)))"""
    last = "\nUNION ALL\n".join(f"SELECT '{t}' AS term, round(w{k}, 6) AS weight, 1 AS fit_agrees FROM st" for k, t in enumerate(["intercept", a, b]))
    two = f"SELECT y, {scaled(a)} AS a, {scaled(b)} AS b FROM lab WHERE week_start < DATE '{CUT}'"
    zero = "SELECT CAST(0 AS DOUBLE) AS w0, CAST(0 AS DOUBLE) AS w1, CAST(0 AS DOUBLE) AS w2"
    return steps_sql(zero, step, steps, last, "lab", "two", two=two)


def lloyd_sql() -> str:
    axes, ks = range(len(SCALED)), range(len(CENTERS))
    first = "SELECT " + ", ".join(f"CAST({CENTERS[k][i]} AS DOUBLE) AS c{k}_{i}" for k in ks for i in axes)
    d = lambda k: " + ".join(f"({SCALED[i]} - c{k}_{i}) ** 2" for i in axes)
    near = f"""SELECT *, least(d0, d1, d2) AS d, CASE WHEN d0 <= d1 AND d0 <= d2 THEN 0 WHEN d1 <= d2 THEN 1 ELSE 2 END AS p
               FROM (SELECT *, {", ".join(f"{d(k)} AS d{k}" for k in ks)} FROM (SELECT * FROM st), points)"""
    step = "SELECT " + ", ".join(
        f"coalesce(avg({SCALED[i]}) FILTER (p = {k}), any_value(c{k}_{i})) AS c{k}_{i}" for k in ks for i in axes) + f" FROM ({near})"
    last = "\nUNION ALL\n".join(
        f"""SELECT {k} AS cluster, count(*) FILTER (p = {k}) AS n_rows, round(coalesce(sum(d) FILTER (p = {k}), 0), 6) AS sse,
                   {", ".join(f"round(any_value(c{k}_{i}), 6) AS c{i}" for i in axes)} FROM ({near})""" for k in ks)
    return steps_sql(first, step, LLOYD_STEPS, last, "std", "points", points=f"SELECT {', '.join(SCALED)} FROM std")


def em_sql() -> str:
    weights, means, covs = EM_START
    names = ("w", "a", "b", "aa", "ab", "bb")
    start = lambda k: (weights[k], *means[k], covs[k][0][0], covs[k][0][1], covs[k][1][1])
    first = "SELECT " + ", ".join(f"CAST({v} AS DOUBLE) AS {n}{k}" for k in (0, 1) for n, v in zip(names, start(k)))
    det = lambda k: f"(aa{k} * bb{k} - ab{k} * ab{k})"
    quad = lambda k: f"(bb{k} * (x - a{k}) ** 2 - 2 * ab{k} * (x - a{k}) * (z - b{k}) + aa{k} * (z - b{k}) ** 2) / {det(k)}"
    dens = lambda k: f"w{k} * exp(-0.5 * {quad(k)}) / sqrt({det(k)})"
    shares = f"""SELECT x, z, e0 / (e0 + e1) AS r0, e1 / (e0 + e1) AS r1
                 FROM (SELECT x, z, {dens(0)} AS e0, {dens(1)} AS e1 FROM (SELECT * FROM st), points)"""
    moments = lambda k: (f"sum(r{k}) / count(*) AS w{k}, sum(r{k} * x) / sum(r{k}) AS a{k}, sum(r{k} * z) / sum(r{k}) AS b{k}, "
                         f"sum(r{k} * x * x) / sum(r{k}) - (sum(r{k} * x) / sum(r{k})) ** 2 AS aa{k}, "
                         f"sum(r{k} * x * z) / sum(r{k}) - sum(r{k} * x) / sum(r{k}) * sum(r{k} * z) / sum(r{k}) AS ab{k}, "
                         f"sum(r{k} * z * z) / sum(r{k}) - (sum(r{k} * z) / sum(r{k})) ** 2 AS bb{k}")
    step = f"SELECT {moments(0)}, {moments(1)} FROM ({shares})"
    shown_as = dict(zip(names, ("weight", "m0", "m1", "v00", "v01", "v11")))
    last = "\nUNION ALL\n".join(
        f"SELECT {k} AS component, " + ", ".join(f"round({n}{k}, 6) AS {c}" for n, c in shown_as.items()) + " FROM st" for k in (0, 1))
    return steps_sql(first, step, EM_STEPS, last, "std", "points", points=f"SELECT {EM_INPUTS[0]} AS x, {EM_INPUTS[1]} AS z FROM std")


def split_places(inputs: list[str]) -> str:
    """Every place between two distinct training values, with its fall of the Gini impurity."""
    long = "\nUNION ALL\n".join(f"SELECT '{c}' AS feature, CAST({c} AS DOUBLE) AS v, y FROM lab WHERE week_start < DATE '{CUT}'" for c in inputs)
    gini = lambda pos, n: f"2 * ({pos} / {n}) * (1 - {pos} / {n})"
    return f"""
        SELECT feature, (v + nv) / 2 AS threshold, CAST(nl AS BIGINT) AS n_left, CAST(pl AS BIGINT) AS pos_left, n, pos,
               {gini("pos", "n")} - nl / n * {gini("pl", "nl")} - (n - nl) / n * {gini("(pos - pl)", "(n - nl)")} AS gain
        FROM (SELECT feature, v, lead(v) OVER (PARTITION BY feature ORDER BY v) AS nv,
                     CAST(sum(c) OVER (PARTITION BY feature ORDER BY v) AS DOUBLE) AS nl, CAST(sum(p) OVER (PARTITION BY feature ORDER BY v) AS DOUBLE) AS pl,
                     CAST(sum(c) OVER (PARTITION BY feature) AS DOUBLE) AS n, CAST(sum(p) OVER (PARTITION BY feature) AS DOUBLE) AS pos
              FROM (SELECT feature, v, count(*) AS c, sum(y) AS p FROM ({long}) GROUP BY feature, v)) WHERE nv IS NOT NULL"""


BEST_SPLITS = "SELECT * FROM vals QUALIFY row_number() OVER (PARTITION BY feature ORDER BY round(gain, 12) DESC, threshold) = 1"


USER_PANEL = {
    "rec": f"""
        SELECT user_id AS entity_id, CAST(ts AS DATE) AS day, CAST(value AS DECIMAL(18,2)) AS value,
               1 AS n_ok, CASE WHEN event_type = 'error' THEN 1 ELSE 0 END AS n_failed
        FROM events WHERE CAST(ts AS DATE) BETWEEN DATE '{USER_START}' AND DATE '{USER_END}'""",
    "ent": "SELECT DISTINCT user_id AS entity_id, 'user' AS segment FROM events",
    "ev": "SELECT DATE '1900-01-01' AS e",
    "spine": CTE["spine"].replace(str(START), str(USER_START)).replace(str(END), str(USER_END)),
}


def measures_of(column: str) -> str:
    """One row of measures for the rule ``column > threshold`` on the test weeks."""
    rule = f"(SELECT y, CASE WHEN {column} > t THEN 1 ELSE 0 END AS p FROM test)"
    conf = CTE["conf"].replace("FROM test", f"FROM {rule}")
    parts = CTE["parts"].replace("FROM conf", f"FROM ({conf})")
    return CTE["raw"].replace("FROM parts", f"FROM ({parts})")


def auc_of(column: str) -> str:
    return f"""
        SELECT round((sum(CASE WHEN y = 1 THEN r ELSE 0 END) - sum(y) * (sum(y) + 1) / 2.0)
                     / (CAST(sum(y) AS DOUBLE) * sum(1 - y)), 8)
        FROM (SELECT y, rank() OVER (ORDER BY s) + (count(*) OVER (PARTITION BY s) - 1) / 2.0 AS r
              FROM (SELECT y, {column} AS s FROM test))"""


def rule_sql() -> str:
    rules = {"rolling mean": "round(roll4_wd, 4)", "two weeks back": "lag2_wd"}
    rows = [
        f"""SELECT '{name}' AS model, accuracy, "precision", recall, f1, ({auc_of(col)}) AS auc,
                   {i} AS pos FROM ({measures_of(col)})"""
        for i, (name, col) in enumerate(rules.items())
    ]
    return f"""
        SELECT model, round(accuracy, 8) AS accuracy, round("precision", 8) AS "precision",
               round(recall, 8) AS recall, round(f1, 8) AS f1, auc,
               round((accuracy - b_accuracy) * 100, 8) AS accuracy_lift, round((f1 - b_f1) * 100, 8) AS f1_lift,
               CASE WHEN row_number() OVER (ORDER BY auc DESC, pos) = 1 THEN 1 ELSE 0 END AS is_best
        FROM ({" UNION ALL ".join(rows)}), (SELECT accuracy AS b_accuracy, f1 AS b_f1 FROM raw)
        UNION ALL
        SELECT 'persistence', round(accuracy, 8), NULL, NULL, round(f1, 8), NULL, NULL, NULL, 0 FROM raw"""


WEEKLY_SELECT = "SELECT * FROM weekly"
FEATURES = [
    "entity_id", "segment", "week_start", "wd", "tx", "failed", "payday_days", "festival_days", "wd_weekend",
    "outage_days", "n_days", *LAGS, *ROLLING, *LAG_RATIOS, "woy_sin", "woy_cos",
]
PROFILE_SELECT = f"SELECT entity_id, segment, {shown(PROFILE)} FROM prof"
LEVEL = f"""
    SELECT entity_id, day,
           (r_regionkey * CAST(25000 AS DOUBLE) + 60000) * (1 + acctbal / 100000)
             * CASE WHEN is_weekend = 1 THEN r_regionkey * CAST(0.125 AS DOUBLE) + 0.75 ELSE 1 END
             * CASE WHEN is_payday = 1 THEN r_regionkey * CAST(0.0625 AS DOUBLE) + 1.0625 ELSE 1 END
             * CASE WHEN is_event = 1 THEN CAST(1.35 AS DOUBLE) ELSE 1 END
             * (1 + CAST(0.1 AS DOUBLE) * (day - DATE '{START}') / {N_DAYS}) AS expected
    FROM ent JOIN region ON r_name = segment CROSS JOIN cal"""
# fixed values: the numeric model inputs in vector order, written out apart from the code under test
MODEL_INPUTS = [
    "lag1_wd", "lag2_wd", "lag1_tx", "roll4_wd", "roll4_std", "lag1_avg_amt", "lag1_fail_rate", "lag1_weekend_share",
    "lag1_outage_days", "payday_days", "festival_days", "woy_sin", "woy_cos",
]
XYZ = """
    SELECT entity_id, log_avg_daily_wd_scaled AS x, log_p90_daily_wd_scaled AS y, log_avg_daily_tx_scaled AS z FROM std"""
RECORDS_IN_REGION = "daily JOIN ent USING (entity_id)"
MEANS = ", ".join(f"round(avg({c}), 4) AS {c}" for c in PROFILE)


def oracle_sql() -> dict[str, str]:
    plain = lambda n: rnd(n, DIGITS[n]) if n in DIGITS else f"CAST({n} AS DOUBLE) AS {n}"
    lags = lambda names: sql(f"SELECT entity_id, week_start, {', '.join(map(plain, names))} FROM wide", "wide")
    scaled = ", ".join(f"round({c} / nullif(s_{c}, 0), 4) AS {c}_scaled" for c in NUMERIC)
    deviations = ", ".join(f"stddev_samp({c}) AS s_{c}" for c in NUMERIC)
    y_cells = lambda cond: (
        f"count(*) FILTER (y = 0 AND NOT {cond}) AS TN, count(*) FILTER (y = 0 AND {cond}) AS FP, "
        f"count(*) FILTER (y = 1 AND NOT {cond}) AS FN, count(*) FILTER (y = 1 AND {cond}) AS TP"
    )
    own_dist = lambda j: (
        " + ".join(f"(a.log_{c}_scaled - b.log_{c}_scaled) ** 2" for c in VOLUME)
    )
    return {
        "calendar_flags": sql(
            "SELECT cal.*, count(rec.day) AS n_records FROM cal LEFT JOIN rec ON rec.day = cal.day GROUP BY ALL",
            "cal", "rec",
        ),
        "event_window_totals": sql(
            """SELECT day, CAST(sum(value) AS DOUBLE) AS value, count(*) AS n_records FROM rec
               WHERE EXISTS (SELECT 1 FROM ev WHERE rec.day BETWEEN e - 3 AND e + 1) GROUP BY day""",
            "ev", "rec",
        ),
        "trend_index": sql(
            f"""SELECT entity_id, day, value, trend, value / trend AS level FROM (
                SELECT *, 1 + CAST(0.1 AS DOUBLE) * (day - DATE '{START}') / {N_DAYS} AS trend FROM daily)""",
            "daily",
        ),
        "entity_day_panel": sql(
            "SELECT *, CASE WHEN n_ok = 0 THEN 1 ELSE 0 END AS is_outage FROM panel", "panel"
        ),
        "panel_union": sql(
            f"""SELECT 'S' || entity_id AS entity_id, segment, day, value, n_ok, n_failed FROM {RECORDS_IN_REGION}
                UNION ALL
                SELECT 'U' || user_id, NULL, CAST(ts AS DATE), CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE),
                       count(*), count(*) FILTER (event_type = 'error')
                FROM events GROUP BY user_id, CAST(ts AS DATE)""",
            "daily", "ent",
        ),
        "expected_level": sql(LEVEL, "ent", "cal"),
        "learned_levels": sql(
            """SELECT segment, CAST(count(DISTINCT entity_id) AS BIGINT) AS entities, round(base, 4) AS base,
                      round(w / base, 4) AS is_weekend_factor, round(p / base, 4) AS is_payday_factor,
                      round(e / base, 4) AS is_event_factor, round(ticket, 4) AS ticket
               FROM (SELECT segment, entity_id,
                            sum(value) FILTER (is_weekend = 0 AND is_payday = 0 AND is_event = 0) OVER s
                              / count(*) FILTER (is_weekend = 0 AND is_payday = 0 AND is_event = 0) OVER s AS base,
                            avg(value) FILTER (is_weekend = 1) OVER s AS w, avg(value) FILTER (is_payday = 1) OVER s AS p,
                            avg(value) FILTER (is_event = 1) OVER s AS e, sum(value) OVER s / sum(n_ok) OVER s AS ticket
                     FROM panel WINDOW s AS (PARTITION BY segment))
               GROUP BY ALL""",
            "panel",
        ),
        "derived_count": sql(
            f"""SELECT entity_id, day, value, greatest(1, CAST(trunc(value /
                  (CAST({TICKET} AS DOUBLE) * CASE WHEN segment = 'ASIA' THEN 1.25 ELSE 1 END)) AS BIGINT)) AS n_derived
                FROM {RECORDS_IN_REGION}""",
            "daily", "ent",
        ),
        "masked_measures": sql(
            """SELECT entity_id, day,
                      CAST(sum(CASE WHEN n_failed = 1 THEN 0 ELSE value END) AS DOUBLE) AS value,
                      CAST(sum(CASE WHEN n_failed = 1 THEN 0 ELSE n_ok END) AS BIGINT) AS n_ok,
                      CAST(sum(n_failed) AS BIGINT) AS n_failed
               FROM rec GROUP BY entity_id, day""",
            "rec",
        ),
        "weekly_rollup": sql(WEEKLY_SELECT, "weekly"),
        "weekly_from_records": sql(WEEKLY_SELECT, "weekly"),
        "weekly_lags": lags(LAGS),
        "weekly_rolling": lags(ROLLING),
        "weekly_lag_ratios": lags(LAG_RATIOS),
        "season_encoding": sql(
            """SELECT week_start, count(*) AS n_records, week(week_start) AS woy,
                      round(sin(2 * pi() * week(week_start) / 52), 8) AS woy_sin,
                      round(cos(2 * pi() * week(week_start) / 52), 8) AS woy_cos
               FROM (SELECT CAST(date_trunc('week', day) AS DATE) AS week_start FROM rec) GROUP BY week_start""",
            "rec",
        ),
        "weekly_features": sql(f"SELECT {shown(FEATURES)} FROM feat", "feat"),
        "weekly_features_recent": sql(
            f"SELECT {shown(FEATURES)} FROM feat WHERE week_start >= DATE '{CUT}'", "feat"
        ),
        "user_weekly_features": sql(f"SELECT {shown(FEATURES)} FROM feat", "feat", **USER_PANEL),
        "rule_comparison": sql(rule_sql(), "raw"),
        "train_threshold": sql(
            f"SELECT count(*) AS n_train, min(t) AS threshold FROM feat, thr WHERE week_start < DATE '{CUT}'", "thr"
        ),
        "labelled_split_stats": sql(
            f"""SELECT CASE WHEN week_start < DATE '{CUT}' THEN 'train' ELSE 'test' END AS part, count(*) AS n_rows,
                       CAST(sum(y) AS BIGINT) AS n_high, round(avg(y), 8) AS high_share FROM lab GROUP BY 1""",
            "lab",
        ),
        "persistence_confusion": sql("SELECT * FROM conf", "conf"),
        "persistence_metrics": sql("SELECT * FROM meas", "meas"),
        "score_auc": sql(
            """SELECT CAST(sum(y) AS BIGINT) AS n_pos, CAST(sum(1 - y) AS BIGINT) AS n_neg,
                      round((sum(CASE WHEN y = 1 THEN r ELSE 0 END) - sum(y) * (sum(y) + 1) / 2.0)
                            / (CAST(sum(y) AS DOUBLE) * sum(1 - y)), 8) AS auc
               FROM (SELECT y, rank() OVER (ORDER BY s) + (count(*) OVER (PARTITION BY s) - 1) / 2.0 AS r
                     FROM (SELECT y, round(roll4_wd, 4) AS s FROM test))""",
            "test",
        ),
        "threshold_sweep": sql(
            "\nUNION ALL\n".join(
                f"""SELECT round(max(t) * CAST({f} AS DOUBLE), 6) AS threshold,
                    {y_cells(f'(round(roll4_wd, 4) > t * CAST({f} AS DOUBLE))')} FROM test"""
                for f in SWEEP
            ),
            "test",
        ),
        "segment_index": sql("SELECT * FROM cats", "cats"),
        "segment_one_hot": sql(
            "SELECT entity_id, week_start, loc_idx, "
            + ", ".join(f"CASE WHEN loc_idx = {i} THEN 1 ELSE 0 END AS loc_{i}" for i in range(4))
            + " FROM feat JOIN cats USING (segment)",
            "cats",
        ),
        "unit_std_features": sql(
            f"""SELECT entity_id, week_start, {scaled} FROM feat,
                (SELECT {deviations} FROM feat WHERE week_start < DATE '{CUT}')""",
            "feat",
        ),
        "log_standardised_profile": sql(
            "SELECT entity_id, "
            + ", ".join([rnd(f"log_{c}", 6) for c in VOLUME] + [rnd(f"log_{c}_scaled", 6) for c in VOLUME])
            + " FROM std",
            "std",
        ),
        "entity_profile": sql(PROFILE_SELECT, "prof"),
        "profile_from_daily": sql(PROFILE_SELECT, "prof"),
        "entity_profile_live": sql(
            PROFILE_SELECT, "prof", base=CTE["base"].replace("FROM panel", "FROM panel WHERE n_ok > 0")
        ),
        "data_quality": sql(
            """SELECT count(*) AS n_rows, 5 AS n_columns, count(DISTINCT entity_id) AS n_entities,
                      min(day) AS first_day, max(day) AS last_day,
                      count(*) FILTER (entity_id IS NULL) + count(*) FILTER (day IS NULL)
                        + count(*) FILTER (value IS NULL) + count(*) FILTER (n_failed IS NULL) AS missing_cells,
                      count(*) - count(DISTINCT (entity_id, day)) AS duplicate_rows,
                      count(*) FILTER (n_failed = 1) AS outage_rows,
                      round(count(*) FILTER (n_failed = 1) / CAST(count(*) AS DOUBLE), 8) AS outage_share,
                      round(sum(n_failed) / CAST(sum(1 - n_failed) AS DOUBLE), 8) AS failed_rate,
                      CAST(sum(value) AS DOUBLE) AS total_value,
                      round(CAST(sum(value) AS DOUBLE) / count(*), 4) AS mean_value,
                      CAST(max(value) AS DOUBLE) AS max_value,
                      round(sum(1 - n_failed) / CAST(count(*) AS DOUBLE), 8) AS mean_count,
                      max(1 - n_failed) AS max_count
               FROM rec""",
            "rec",
        ),
        "median_value": sql("SELECT CAST(quantile_disc(value, 0.5) AS DOUBLE) AS median_value FROM rec", "rec"),
        "segment_summary": sql(
            """SELECT segment, count(DISTINCT entity_id) AS n_entities,
                      round(CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) / count(*), 4) AS avg_daily_value,
                      round(sum(n_ok) / CAST(count(*) AS DOUBLE), 4) AS avg_daily_count
               FROM panel GROUP BY segment""",
            "panel",
        ),
        "entity_count": "SELECT count(DISTINCT user_id) AS n_entities FROM events",
        "panel_preview": sql("SELECT * FROM daily ORDER BY entity_id, day LIMIT 5", "daily"),
        "kmeans_assign": sql("SELECT entity_id, prediction FROM asg", "asg"),
        "cluster_quality": sql(
            f"""SELECT round((SELECT avg(s) FROM sil), 6) AS silhouette, (SELECT count(*) FROM sil) AS n_rows,
                       round((SELECT sum(least(d0, d1, d2)) FROM asg), 6) AS wssse""",
            "asg", "pairs", "near", "sil",
            pairs=f"""
                SELECT a.entity_id, a.prediction AS own, b.prediction AS other,
                       sum({own_dist(0)}) AS total, count(*) AS n
                FROM asg a, asg b GROUP BY 1, 2, 3""",
            near="""
                SELECT entity_id, max(CASE WHEN own = other THEN n END) AS n,
                       max(CASE WHEN own = other AND n > 1 THEN total / (n - 1) END) AS a,
                       min(CASE WHEN own <> other THEN total / n END) AS b
                FROM pairs GROUP BY entity_id""",
            sil="SELECT CASE WHEN n = 1 OR b IS NULL THEN 0 ELSE (b - a) / greatest(a, b) END AS s FROM near",
        ),
        "tier_names": sql(
            "SELECT prediction, round(mean_metric, 4) AS mean_metric, tier_rank, demand_tier FROM named", "named"
        ),
        "tier_assignments": sql(f"SELECT entity_id, segment, demand_tier, {shown(PROFILE)} FROM tiered", "tiered"),
        "tier_summary": sql(
            f"SELECT demand_tier, count(*) AS n_entities, {MEANS} FROM tiered GROUP BY demand_tier", "tiered"
        ),
        "tier_mix": sql(
            """SELECT segment, count(*) FILTER (demand_tier = 'Low') AS Low,
                      count(*) FILTER (demand_tier = 'Medium') AS Medium,
                      count(*) FILTER (demand_tier = 'High') AS High FROM tiered GROUP BY segment""",
            "tiered",
        ),
        "tier_ratio": sql(
            """SELECT round(avg(avg_daily_wd) FILTER (demand_tier = 'High')
                            / avg(avg_daily_wd) FILTER (demand_tier = 'Low'), 6) AS tier_ratio FROM tiered""",
            "tiered",
        ),
        "segment_usual_tier": sql(
            """SELECT segment, demand_tier AS usual_tier, round(n / CAST(total AS DOUBLE), 8) AS tier_share FROM (
                 SELECT segment, demand_tier, count(*) AS n, sum(count(*)) OVER (PARTITION BY segment) AS total,
                        row_number() OVER (PARTITION BY segment ORDER BY count(*) DESC, tier_rank) AS r
                 FROM tiered GROUP BY segment, demand_tier, tier_rank) WHERE r = 1""",
            "tiered",
        ),
        "tier_policy": sql(
            """SELECT entity_id, demand_tier, CASE demand_tier WHEN 'Low' THEN 'weekly plus payday top-up'
                      WHEN 'Medium' THEN 'every 2-3 days' ELSE 'daily monitoring' END AS policy FROM tiered""",
            "tiered",
        ),
        "logistic_newton": newton_sql(),
        "logistic_certificate": sql(f"SELECT count(*) AS n_rows, 1 AS optimal, 1 AS informs FROM lab WHERE week_start < DATE '{CUT}'", "lab"),
        "best_splits": sql(f"SELECT feature, threshold, round(gain, 9) AS gain, n_left, pos_left FROM ({BEST_SPLITS})", "lab", "vals",
                           vals=split_places(SPLIT_INPUTS)),
        "forest_stump": sql(f"SELECT feature, threshold, round(gain, 9) AS gain FROM ({BEST_SPLITS}) ORDER BY gain DESC LIMIT 1", "lab", "vals",
                            vals=split_places(STUMP_INPUTS)),
        "boosting_rounds": sql(
            f"""SELECT i AS round, CASE WHEN i = 1 THEN round(loss, 8) END AS first_loss, 1 AS fell
                FROM (SELECT unnest([1, 2, 3, 4, 5, 6, 7, 8]) AS i), (
                  SELECT 2 * (pos_left * ln(1 + exp(-2 * fl)) + (n_left - pos_left) * ln(1 + exp(2 * fl))
                              + (pos - pos_left) * ln(1 + exp(-2 * fr)) + (n - n_left - pos + pos_left) * ln(1 + exp(2 * fr))) / n AS loss
                  FROM (SELECT *, 2.0 * pos_left / n_left - 1 AS fl, 2.0 * (pos - pos_left) / (n - n_left) - 1 AS fr
                        FROM ({BEST_SPLITS}) ORDER BY gain DESC LIMIT 1))""", "lab", "vals", vals=split_places(STUMP_INPUTS)),
        "lloyd_centers": lloyd_sql(),
        "kmeans_certificate": sql(
            "SELECT k, (SELECT count(*) FROM std) AS n_rows, 1 AS fixed, 1 AS cost_agrees FROM (SELECT unnest([2, 3, 4, 5, 6, 7]) AS k)", "std"),
        "bisecting_tree": sql(
            "SELECT count(*) AS n_all, round(sum(x * x + y * y + z * z), 4) AS sse_all, CAST(3 AS BIGINT) AS n_splits, 1 AS rows_add_up, 1 AS sse_falls FROM xyz",
            "std", "xyz", xyz=XYZ),
        "mixture_em": em_sql(),
        "distinct_sketch": "SELECT count(DISTINCT user_id) AS n_exact, 1 AS within_error FROM events",
        "quantile_sketch": sql(
            f"""SELECT q, count(*) AS n_rows, 1 AS within_error FROM feat, (SELECT unnest([CAST(0.5 AS DOUBLE), CAST(0.9 AS DOUBLE)]) AS q)
                WHERE week_start < DATE '{CUT}' GROUP BY q""", "feat"),
        "auc_curves": sql(
            """SELECT CAST(sum(pos) AS BIGINT) AS n_pos, CAST(sum(neg) AS BIGINT) AS n_neg, CAST(sum(m) AS BIGINT) AS n_scores,
                      round((SELECT sum(neg * (above + pos / 2.0)) / (sum(pos) * sum(neg)) FROM pairs2), 9) AS auc,
                      round(sum(neg * (earlier + pos / 2.0)) / (CAST(sum(pos) AS DOUBLE) * sum(neg)), 9) AS binned_auc
               FROM (SELECT *, coalesce(sum(pos) OVER (ORDER BY bin ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS earlier
                     FROM (SELECT bin, sum(pos) AS pos, sum(neg) AS neg, count(*) AS m FROM pairs2 GROUP BY bin))""",
            "test", "pairs2",
            pairs2=f"""
                SELECT *, (row_number() OVER (ORDER BY s DESC) - 1) // CAST(ceil(count(*) OVER () / {CURVE_BINS}.0) AS BIGINT) AS bin,
                       coalesce(sum(pos) OVER (ORDER BY s DESC ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS above
                FROM (SELECT lag1_wd AS s, CAST(sum(y) AS DOUBLE) AS pos, CAST(sum(1 - y) AS DOUBLE) AS neg FROM test GROUP BY lag1_wd)"""),
        "error_windows": """
            SELECT user_id, count(*) AS n_events, count(*) FILTER (event_type = 'error') AS n_errors FROM events e
            WHERE EXISTS (SELECT 1 FROM events w WHERE w.event_type = 'error' AND w.user_id = e.user_id
                          AND epoch_us(e.ts) BETWEEN epoch_us(w.ts) - 7200000000 AND epoch_us(w.ts) + (1 + w.event_id % 30) * 3600000000)
            GROUP BY user_id""",
        "encoded_split": sql(
            f"""SELECT CASE WHEN week_start < DATE '{CUT}' THEN 'train' ELSE 'test' END AS part, loc_idx, count(*) AS n_rows
                FROM feat JOIN cats USING (segment) GROUP BY 1, 2""", "cats"),
        "range_report": f"""
            SELECT count(*) AS n_rows, min(d) AS first_day, max(d) AS last_day, count(*) FILTER (d < DATE '{START}') AS n_before,
                   count(*) FILTER (d > DATE '{END}') AS n_after, count(*) FILTER (d IS NULL) AS n_undated
            FROM (SELECT CAST(l_shipdate AS DATE) AS d FROM lineitem)""",
        "weekly_span": """
            WITH r AS (SELECT CAST(l_shipdate AS DATE) AS d, CAST(l_extendedprice AS DECIMAL(18,2)) AS v FROM lineitem),
                 span AS (SELECT min(d) AS a, max(d) AS b FROM r)
            SELECT CAST(date_trunc('week', d) AS DATE) AS week_start, CAST(sum(v) AS DOUBLE) AS wd, count(*) AS n_records FROM r, span
            WHERE date_trunc('week', d) >= a AND date_trunc('week', d) + INTERVAL 6 DAY <= b GROUP BY 1""",
        "gap_quality": """
            SELECT count(*) AS n_rows, count(DISTINCT l_suppkey) AS n_entities,
                   count(*) FILTER (l_linenumber IN (3, 5)) + count(*) FILTER (l_linenumber = 2) + count(*) FILTER (l_linenumber >= 6) AS missing_cells,
                   count(*) - count(DISTINCT (l_suppkey, CAST(l_shipdate AS DATE))) AS duplicate_rows FROM lineitem""",
        "panel_quality": sql(
            """SELECT count(*) AS n_rows, count(DISTINCT entity_id) AS n_entities, count(*) FILTER (n_ok = 0) AS outage_rows,
                      round(count(*) FILTER (n_ok = 0) / CAST(count(*) AS DOUBLE), 8) AS outage_share, round(avg(is_weekend), 8) AS is_weekend_share,
                      round(avg(is_payday), 8) AS is_payday_share, round(avg(is_event), 8) AS is_event_share FROM panel""", "panel"),
        "segment_ranking": sql(
            """SELECT segment, n_entities, round(m, 4) AS avg_daily_value, round(a, 4) AS avg_daily_count,
                      CAST(row_number() OVER (ORDER BY m DESC, segment) AS INTEGER) AS rank
               FROM (SELECT segment, count(DISTINCT entity_id) AS n_entities, CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) / count(*) AS m,
                            sum(n_ok) / CAST(count(*) AS DOUBLE) AS a FROM panel GROUP BY segment)""", "panel"),
        "tier_order": sql("SELECT tier_rank, demand_tier, count(*) AS n_entities FROM tiered GROUP BY 1, 2", "tiered"),
        "segmentation_job": sql(
            """SELECT segment, count(*) AS n_entities, (SELECT count(*) FROM ent) AS n_all, CAST(3 AS BIGINT) AS n_tiers FROM ent GROUP BY segment""", "ent"),
        "classification_job": sql(
            f"""SELECT count(*) FILTER (week_start < DATE '{CUT}') AS train_rows, count(*) FILTER (week_start >= DATE '{CUT}') AS test_rows,
                       count(*) AS weekly_rows, (SELECT count(*) FROM panel) AS daily_rows, 'Logistic Regression' AS best_model,
                       count(*) FILTER (week_start >= DATE '{CUT}') AS n_scored FROM feat""", "feat", "panel"),
        "model_test_counts": sql(
            f"""SELECT model, count(*) FILTER (y = 0) AS n_low, count(*) FILTER (y = 1) AS n_high, 1 AS auc_in_range
                FROM lab, (SELECT unnest(['Logistic Regression', 'Random Forest', 'Gradient-Boosted Trees']) AS model)
                WHERE week_start >= DATE '{CUT}' GROUP BY model""",
            "lab",
        ),
        "importance_names": sql(
            f"""SELECT feature, n AS n_features, CAST(1 AS DOUBLE) AS total, CAST(n AS INTEGER) AS last_rank,
                       CAST(1 AS DOUBLE) AS last_share, least(n, 10) AS n_top
                FROM (SELECT feature, count(*) OVER () AS n FROM (
                    SELECT unnest([{", ".join(f"'{c}'" for c in MODEL_INPUTS)}]) AS feature
                    UNION ALL
                    SELECT 'loc_' || segment FROM cats WHERE loc_idx < (SELECT max(loc_idx) FROM cats)))""",
            "cats",
        ),
        "kmeans_sweep_spread": sql(
            """SELECT k, 1 AS below_spread, 1 AS silhouette_in_range, round(spread, 4) AS spread
               FROM (SELECT unnest([2, 3, 4, 5, 6, 7]) AS k), (SELECT sum(x * x + y * y + z * z) AS spread FROM xyz)""",
            "std", "xyz", xyz=XYZ,
        ),
        "cluster_compare_range": """
            SELECT unnest(['K-Means (k=3)', 'Gaussian Mixture (k=3)', 'Bisecting K-Means (k=3)']) AS algorithm,
                   0 AS out_of_range""",
        "fitted_tier_totals": sql(
            """SELECT form, count(*) AS n_entities, round(avg(avg_daily_wd), 4) AS avg_daily_wd,
                      'Low Medium High' AS tiers, 1 AS ascending
               FROM prof, (SELECT unnest(['log', 'plain']) AS form) GROUP BY form""",
            "prof",
        ),
        "pca_scores": sql(
            """SELECT entity_id, round(abs(x * u1 + y * u2 + z * u3) / sqrt(u1 * u1 + u2 * u2 + u3 * u3), 5) AS pc1,
                      round(abs(x * v1 + y * v2 + z * v3) / sqrt(v1 * v1 + v2 * v2 + v3 * v3), 5) AS pc2,
                      round(l1 / 3, 5) AS explained1, round(l2 / 3, 5) AS explained2
               FROM xyz, axes""",
            "std", "xyz", "cor", "roots", "axes",
            xyz=XYZ,
            cor="SELECT corr(x, y) AS a, corr(x, z) AS b, corr(y, z) AS c FROM xyz",
            roots="""
                SELECT a, b, c, 1 + 2 * q * cos(f) AS l1, 1 - 2 * q * (cos(f) + cos(f + 2 * pi() / 3)) AS l2
                FROM (SELECT *, acos(greatest(-1, least(1, a * b * c / (q * q * q)))) / 3 AS f
                      FROM (SELECT *, sqrt((a * a + b * b + c * c) / 3) AS q FROM cor))""",
            axes="""
                SELECT l1, l2, a * c - b * (1 - l1) AS u1, a * b - c * (1 - l1) AS u2, (1 - l1) ** 2 - a * a AS u3,
                       a * c - b * (1 - l2) AS v1, a * b - c * (1 - l2) AS v2, (1 - l2) ** 2 - a * a AS v3 FROM roots""",
        ),
        "table_roundtrip": sql(
            f"SELECT entity_id, day, segment, value, n_ok, n_failed FROM {RECORDS_IN_REGION}", "daily", "ent"
        ),
        "tier_sink_roundtrip": sql(f"SELECT entity_id, segment, demand_tier, {shown(PROFILE)} FROM tiered", "tiered"),
        "metrics_roundtrip": sql(
            """SELECT 'Persistence' AS model, accuracy, "precision", recall, f1, TN, FP, FN, TP,
                      printf('%.1f%%', accuracy * 100) AS accuracy_text, format('{:,}', TN + TP) AS n_text FROM meas""",
            "meas",
        ),
    }
