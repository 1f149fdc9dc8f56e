"""The same queries in plain SQL for DuckDB, written independently of the DataFrame code."""

from __future__ import annotations

SCOPE = "('ECONOMY', 'STANDARD')"
ALL_FOUR = "('ECONOMY', 'STANDARD', 'PROMO', 'SMALL')"
GAPS = "('PROMO', 'SMALL')"
AUDITED = "('ECONOMY', 'STANDARD', 'PROMO', 'SMALL', 'TIN')"
MODEL_FEATURES = (
    "lag_1", "lag_7", "lag_14", "lag_30",
    "rolling_mean_7", "rolling_std_7", "rolling_mean_30", "rolling_std_30",
    "month_sin", "month_cos", "day_of_week", "day_of_year", "commodity", "state",
)
PANEL_COLUMNS = (
    "state", "commodity", "price_date", "modal_price", *MODEL_FEATURES[:12], "price_vs_msp",
)
MONTHS = "Jan Feb Mar Apr May Jun Jul Aug Sep Oct Nov Dec".split()

# The raw quotes, the cleaning, the panel, its features and the split as a chain of views.
VIEWS = f"""
WITH base AS (
  SELECT l.*, n_name, n_nationkey, r_name, p_type, p_brand,
         CASE WHEN l_partkey % 97 = 0 THEN cast(10 AS double) ELSE cast(1 AS double) END
           * l_extendedprice AS px
  FROM lineitem l
  JOIN supplier ON l_suppkey = s_suppkey
  JOIN nation   ON s_nationkey = n_nationkey
  JOIN region   ON n_regionkey = r_regionkey
  JOIN part     ON l_partkey = p_partkey
  WHERE NOT (p_type = 'PROMO' AND l_shipdate >= TIMESTAMP '1997-06-01 00:00:00')
    AND NOT (p_type = 'SMALL' AND l_shipdate >= TIMESTAMP '1998-03-01 00:00:00')
),
quotes_raw AS (
  SELECT
    CASE WHEN l_linenumber = 1 THEN concat(' ', n_name)
         WHEN l_linenumber = 2 AND n_nationkey < 12
           THEN concat('NATN_', cast(n_nationkey AS varchar))
         ELSE n_name END AS state,
    r_name AS district_name,
    concat('MKT_', cast(l_suppkey AS varchar)) AS market_name,
    CASE WHEN l_partkey % 101 = 0 THEN NULL ELSE p_type END AS commodity,
    p_brand AS variety,
    l_returnflag AS grade,
    CASE WHEN l_quantity = 50 THEN '0'
         ELSE cast(floor(px * (1e0 - l_discount) * 100 + 0.5e0) / 100 AS varchar) END AS min_price,
    cast(floor(px * (0.98e0 + l_tax) * 100 + 0.5e0) / 100 AS varchar) AS max_price,
    CASE WHEN l_linenumber = 7 AND l_discount = 0.05e0 THEN 'n/a'
         ELSE cast(floor(px * 0.99e0 * 100 + 0.5e0) / 100 AS varchar) END AS modal_price,
    CASE WHEN l_linenumber = 6 AND l_tax = 0.08e0 THEN 'not-a-date'
         ELSE cast(cast(l_shipdate AS date) AS varchar) END AS price_date
  FROM base
),
quotes_dated AS (
  SELECT * REPLACE (try_cast(price_date AS date) AS price_date) FROM quotes_raw
),
quotes_valid AS (
  SELECT CASE WHEN trim(state) LIKE 'NATN%' THEN replace(trim(state), 'NATN', 'NATION')
              ELSE trim(state) END AS state,
         district_name, market_name, commodity, variety, grade, md AS modal_price, price_date
  FROM (SELECT *, try_cast(min_price AS double) AS mn, try_cast(max_price AS double) AS mx,
               try_cast(modal_price AS double) AS md FROM quotes_dated)
  WHERE mn <= mx AND md >= mn AND md <= mx AND mn > 0 AND mx > 0 AND md > 0
    AND (commodity IS NULL OR lower(commodity) <> 'medium')
),
bounds AS (
  SELECT commodity AS bounded, q1, med, q3,
         q1 - 1.5e0 * (q3 - q1) AS lower_bound, q3 + 3 * (q3 - q1) AS upper_bound
  FROM (SELECT commodity, quantile_cont(modal_price, 0.25) AS q1,
               quantile_cont(modal_price, 0.5) AS med, quantile_cont(modal_price, 0.75) AS q3
        FROM quotes_valid WHERE commodity IS NOT NULL GROUP BY commodity)
),
quotes AS (
  SELECT v.* FROM quotes_valid v JOIN bounds ON commodity = bounded
  WHERE modal_price >= lower_bound AND modal_price <= upper_bound
),
panel AS (
  SELECT state, commodity, price_date, avg(modal_price) AS modal_price
  FROM quotes
  WHERE state IS NOT NULL AND commodity IS NOT NULL AND price_date IS NOT NULL
  GROUP BY ALL
),
features AS (
  SELECT state, commodity, price_date, modal_price,
         lag(modal_price, 1) OVER reports AS lag_1,
         lag(modal_price, 7) OVER reports AS lag_7,
         lag(modal_price, 14) OVER reports AS lag_14,
         lag(modal_price, 30) OVER reports AS lag_30,
         CASE WHEN count(*) OVER prior7 >= 3 THEN avg(modal_price) OVER prior7 END
           AS rolling_mean_7,
         CASE WHEN count(*) OVER prior7 >= 3 THEN stddev_samp(modal_price) OVER prior7 END
           AS rolling_std_7,
         CASE WHEN count(*) OVER prior30 >= 3 THEN avg(modal_price) OVER prior30 END
           AS rolling_mean_30,
         CASE WHEN count(*) OVER prior30 >= 3 THEN stddev_samp(modal_price) OVER prior30 END
           AS rolling_std_30,
         sin(2 * pi() * month(price_date) / 12) AS month_sin,
         cos(2 * pi() * month(price_date) / 12) AS month_cos,
         cast(isodow(price_date) - 1 AS integer) AS day_of_week,
         cast(dayofyear(price_date) AS integer) AS day_of_year,
         CASE WHEN lower(commodity) = 'promo' THEN modal_price / 40000e0 END AS price_vs_msp
  FROM panel
  WINDOW reports AS (PARTITION BY state, commodity ORDER BY price_date),
         prior7 AS (PARTITION BY state, commodity ORDER BY price_date
                    ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING),
         prior30 AS (PARTITION BY state, commodity ORDER BY price_date
                     ROWS BETWEEN 30 PRECEDING AND 1 PRECEDING)
)
"""


def split_views(source: str, prefix: str = "", scope: str = SCOPE) -> str:
    """Views ``{prefix}cut`` and ``{prefix}split`` over the scope rows of ``source``."""
    return f""",
{prefix}cut AS (
  SELECT min(price_date) AS date_min, max(price_date) AS date_max,
         date_diff('day', min(price_date), max(price_date)) AS span_days,
         date_diff('day', DATE '1970-01-01', min(price_date)) * 86400000000
           + cast(floor(date_diff('day', min(price_date), max(price_date))
                        * 86400000000 * 0.8e0) AS bigint) AS cutoff_us
  FROM {source} WHERE commodity IN {scope}
),
{prefix}split AS (
  SELECT f.*, date_diff('day', DATE '1970-01-01', price_date) * 86400000000
              <= (SELECT cutoff_us FROM {prefix}cut) AS is_train
  FROM {source} f WHERE commodity IN {scope}
)
"""


SPLIT = VIEWS + split_views("features")
RESIDUAL = SPLIT + """,
residuals AS (
  SELECT *, modal_price - lag_1 AS residual FROM split WHERE lag_1 IS NOT NULL
)
"""
NAIVE = (
    VIEWS + ", reported AS (SELECT * FROM features WHERE lag_1 IS NOT NULL)"
    + split_views("reported") + ", naive AS (SELECT *, lag_1 AS predicted FROM split"
    " WHERE NOT is_train)"
)
AUDIT_SPLIT = VIEWS + split_views("features", scope=AUDITED)


def r(expression: str, digits: int) -> str:
    """Half-up rounding on the 8th decimal first, then on ``digits``."""
    return (
        f"floor(floor(({expression}) * 1e8 + 0.5e0) / 1e{8 - digits} + 0.5e0) / 1e{digits}"
    )


def rounded(digits: int, *columns: str) -> str:
    return ", ".join(f"{r(column, digits)} AS {column}" for column in columns)


def describe(source: str, value: str, digits: int, *by: str) -> str:
    quartiles = [f"quantile_cont({value}, {p})" for p in (0.25, 0.5, 0.75)]
    columns = {
        "mean": f"avg({value})", "std": f"stddev_samp({value})", "min": f"min({value})",
        "p25": quartiles[0], "p50": quartiles[1], "p75": quartiles[2], "max": f"max({value})",
    }
    keys = "".join(f"{key}, " for key in by)
    rounds = ", ".join(f"{r(sql, digits)} AS {name}" for name, sql in columns.items())
    group = f"GROUP BY {', '.join(by)}" if by else ""
    return f"SELECT {keys}count({value}) AS n, {rounds} FROM {source} {group}"


def errors(source: str, predicted: str, model: str) -> str:
    """Overall and per-commodity errors of one prediction column."""
    def rows(label: str, group: str) -> str:
        gap = f"abs(modal_price - {predicted})"
        return f"""
  SELECT '{model}' AS model, {label} AS group_label, count(*) AS n,
         {r(f"avg({gap})", 2)} AS mae,
         {r(f"sqrt(avg({gap} * {gap}))", 2)} AS rmse,
         {r(f"avg(CASE WHEN modal_price <> 0 THEN {gap} / modal_price END) * 100", 2)} AS mape_pct
  FROM {source} {group}"""
    return rows("'OVERALL'", "") + " UNION ALL " + rows("commodity", "GROUP BY commodity")


def improvement(base: str, model: str) -> str:
    return r(f"CASE WHEN {base} <> 0 THEN ({base} - {model}) / {base} * 100 END", 1)


def three_models(source: str) -> str:
    return f""", scored AS (
  SELECT *, (lag_1 + rolling_mean_7) / 2 AS blend FROM {source} WHERE NOT is_train
), base_rows AS ({errors("scored", "lag_1", "BASELINE")}
), mean_rows AS ({errors("scored", "rolling_mean_7", "MEAN7")}
), blend_rows AS ({errors("scored", "blend", "BLEND")}
)
"""


COMPARED = RESIDUAL + three_models("residuals") + f""", compared AS (
  SELECT b.group_label, x.n,
    {", ".join(
        f"b.{e} AS {e}_base, m.{e} AS {e}_direct, x.{e} AS {e}_resid, "
        f"{improvement(f'b.{e}', f'x.{e}')} AS {e}_resid_vs_base_pct"
        for e in ("mae", "rmse", "mape_pct"))}
  FROM base_rows b JOIN mean_rows m USING (group_label) JOIN blend_rows x USING (group_label)
)
"""

WINDOWS = SPLIT + """, windows AS (
  SELECT commodity, 'train' AS part, cast(year(price_date) AS integer) AS year,
         count(*) AS n_rows, avg(modal_price) AS mean, median(modal_price) AS median,
         stddev_samp(modal_price) AS std, count(DISTINCT month(price_date)) AS months_present
  FROM split WHERE is_train AND month(price_date) <= 6 GROUP BY commodity, year(price_date)
  UNION ALL
  SELECT commodity, 'test', NULL, count(*), avg(modal_price), median(modal_price),
         stddev_samp(modal_price), count(DISTINCT month(price_date))
  FROM split WHERE NOT is_train AND month(price_date) <= 6 GROUP BY commodity
)
"""


def _checks(source: str, checks: dict[str, str]) -> str:
    """(check_name, violations, ok) with one SQL condition for a violation per check."""
    parts = [
        f"SELECT '{name}' AS check_name, count(*) FILTER (WHERE {broken}) AS violations "
        f"FROM {source}"
        for name, broken in checks.items()
    ]
    return f"SELECT *, violations = 0 AS ok FROM ({' UNION ALL '.join(parts)})"


def _differs(stored: str, fresh: str) -> str:
    return (
        f"NOT coalesce(abs({stored} - ({fresh})) < 1e-6, "
        f"{stored} IS NULL AND ({fresh}) IS NULL)"
    )


def _recomputed(views: str = VIEWS, source: str = "features") -> str:
    """History features once more, joined by report numbers instead of taken from frames."""
    lags = ", ".join(
        f"max(p.modal_price) FILTER (WHERE d = {n}) AS fresh_lag_{n}" for n in (1, 7, 14, 30)
    )
    rolling = ", ".join(
        f"CASE WHEN count(p.modal_price) FILTER (WHERE d <= {size}) >= 3 THEN "
        f"{function}(p.modal_price) FILTER (WHERE d <= {size}) END AS fresh_rolling_{kind}_{size}"
        for size in (7, 30) for kind, function in (("mean", "avg"), ("std", "stddev_samp"))
    )
    return (
        views + ", numbered AS (SELECT *, row_number() OVER (PARTITION BY state, commodity"
        f" ORDER BY price_date) AS report FROM {source})"
        f", earlier AS (SELECT f.state, f.commodity, f.report, {lags}, {rolling}"
        " FROM (SELECT state, commodity, report, unnest(range(1, 31)) AS d FROM numbered) f"
        " LEFT JOIN numbered p ON p.state = f.state AND p.commodity = f.commodity"
        " AND p.report = f.report - d GROUP BY ALL)"
        ", compared AS (SELECT * FROM numbered JOIN earlier USING (state, commodity, report))"
    )


def _leakage(views: str = VIEWS, source: str = "features") -> str:
    return _recomputed(views, source) + (
        "SELECT *, violations = 0 AS ok FROM ("
        "SELECT 'target_in_features' AS check_name, cast(0 AS bigint) AS violations UNION ALL "
        + " UNION ALL ".join(
            f"SELECT '{name}', count(*) FILTER (WHERE {_differs(name, f'fresh_{name}')})"
            " FROM compared"
            for name in MODEL_FEATURES[:8]
        )
        + ")"
    )


def _counts(column: str, source: str, where: str = "true") -> str:
    return f"SELECT {column}, count(*) AS n FROM {source} WHERE {where} GROUP BY {column}"


_ERRORS = ("mae", "rmse", "mape_pct")
_SUFFIX = {"mae": "MAE", "rmse": "RMSE", "mape_pct": "MAPE_pct"}
_HISTORY = MODEL_FEATURES[4:8]
_DATE_KEYS = "state, commodity, price_date"

# The test rows of the direct model, and those that all models share.
TESTED = RESIDUAL + """, tested AS (SELECT * FROM split WHERE NOT is_train),
  shared AS (SELECT * FROM residuals WHERE NOT is_train)"""
# The features of both models; the residual model leaves out the prior price.
USED = f"""WITH used AS (
  SELECT 'DIRECT' AS model, unnest({list(MODEL_FEATURES)}) AS feature
  UNION ALL SELECT 'RESIDUAL', unnest({list(MODEL_FEATURES[1:])}))"""

ORACLE: dict[str, str] = {
    "coerce_dates_prices": VIEWS + """
        SELECT state, district_name, market_name, commodity, variety, grade,
               try_cast(min_price AS double) AS min_price,
               try_cast(max_price AS double) AS max_price,
               try_cast(modal_price AS double) AS modal_price, price_date
        FROM quotes_dated
        WHERE try_cast(min_price AS double) IS NOT NULL
          AND try_cast(max_price AS double) IS NOT NULL
          AND try_cast(modal_price AS double) IS NOT NULL""",
    "date_spellings": VIEWS + """
        , given_days AS (SELECT price_date AS given, try_cast(price_date AS date) AS read_as
                   FROM quotes_raw),
        ways AS (SELECT *, (read_as - DATE '1970-01-01') % 12 AS way FROM given_days)
        SELECT coalesce(CASE way
                 WHEN 0 THEN given
                 WHEN 1 THEN strftime(read_as, '%-m/%-d/%Y')
                 WHEN 2 THEN strftime(read_as, '%m-%d-%Y')
                 WHEN 3 THEN strftime(read_as, '%Y%m%d')
                 WHEN 4 THEN strftime(read_as, '%-m/%-d/%y')
                 WHEN 5 THEN strftime(read_as, '%d-%b-%Y')
                 WHEN 6 THEN strftime(read_as, '%-d %B %Y')
                 WHEN 7 THEN strftime(read_as, '%b %-d, %Y')
                 WHEN 8 THEN strftime(read_as, '%B %-d, %Y 00:00')
                 WHEN 9 THEN strftime(read_as, '%A, %-d %b %Y')
                 WHEN 10 THEN strftime(read_as, '%d-%b-%y')
                 WHEN 11 THEN strftime(read_as, '%Y %b %d') END, given) AS spelled,
               read_as, count(*) AS n
        FROM ways GROUP BY ALL""",
    "unreadable_dates": VIEWS + """
        SELECT regexp_replace(regexp_replace(price_date, '[0-9]', '9', 'g'), '[A-Za-z]', 'a', 'g')
                 AS form, count(*) AS n
        FROM quotes_raw WHERE price_date IS NOT NULL AND try_cast(price_date AS date) IS NULL
        GROUP BY form""",
    "price_rules_filter": VIEWS + """
        SELECT * FROM (
          SELECT * REPLACE (try_cast(min_price AS double) AS min_price,
                            try_cast(max_price AS double) AS max_price,
                            try_cast(modal_price AS double) AS modal_price) FROM quotes_raw)
        WHERE min_price IS NOT NULL AND max_price IS NOT NULL AND modal_price IS NOT NULL
          AND min_price <= max_price
          AND modal_price >= min_price AND modal_price <= max_price
          AND min_price > 0 AND max_price > 0 AND modal_price > 0""",
    "header_standardise": VIEWS + """
        SELECT state, district_name, market_name, commodity, variety, grade,
               modal_price AS quoted_price, price_date AS quoted_on FROM quotes_raw""",
    "drop_category_ci": VIEWS + """
        SELECT state, market_name, commodity, modal_price, price_date FROM quotes_raw
        WHERE commodity IS NULL OR lower(commodity) <> 'medium'""",
    "scope_filter": VIEWS + """
        SELECT state, market_name, commodity, modal_price, price_date FROM quotes
        WHERE commodity IN ('ECONOMY', 'STANDARD') AND lower(commodity) = 'economy'""",
    "month_window_filter": VIEWS + """
        SELECT state, market_name, commodity, modal_price, price_date FROM quotes
        WHERE month(price_date) BETWEEN 1 AND 6""",
    "canonicalise_labels": VIEWS + """
        SELECT state AS raw_state,
               CASE WHEN trim(state) LIKE 'NATN%' THEN replace(trim(state), 'NATN', 'NATION')
                    ELSE trim(state) END AS state,
               count(*) AS n
        FROM quotes_raw GROUP BY ALL""",
    "iqr_bounds": VIEWS + f"""
        SELECT bounded AS commodity, {r("q1", 4)} AS q1, {r("med", 4)} AS median,
               {r("q3", 4)} AS q3, {rounded(4, "lower_bound", "upper_bound")} FROM bounds""",
    "iqr_outlier_profile": VIEWS + f"""
        SELECT commodity, {r("max(upper_bound)", 2)} AS upper_bound,
               {r("max(med)", 2)} AS median,
               count(*) FILTER (WHERE modal_price > upper_bound) AS outlier_rows
        FROM quotes_valid JOIN bounds ON commodity = bounded GROUP BY commodity""",
    "iqr_filter": VIEWS + """
        SELECT market_name, commodity, modal_price, price_date FROM quotes""",
    "clean_pipeline": VIEWS + "SELECT * FROM quotes",
    "cleaning_steps": VIEWS + """
        , numbers AS (
          SELECT commodity, try_cast(min_price AS double) AS mn,
                 try_cast(max_price AS double) AS mx, try_cast(modal_price AS double) AS md
          FROM quotes_raw)
        SELECT 'raw' AS step, count(*) AS n FROM quotes_raw
        UNION ALL SELECT 'price rules', count(*) FROM numbers
          WHERE mn <= mx AND md >= mn AND md <= mx AND mn > 0 AND mx > 0 AND md > 0
        UNION ALL SELECT 'category drop', count(*) FROM quotes_valid
        UNION ALL SELECT 'outlier removal', count(*) FROM quotes""",
    "category_counts": VIEWS + """
        SELECT 'commodity' AS column_name, commodity AS label, count(*) AS n
        FROM quotes_raw GROUP BY commodity
        UNION ALL
        SELECT 'state', state, count(*) FROM quotes WHERE state IS NOT NULL GROUP BY state""",
    "top10_categories": VIEWS + """
        SELECT variety, count(*) AS n FROM quotes WHERE variety IS NOT NULL
        GROUP BY variety ORDER BY n DESC, variety LIMIT 10""",
    "label_cardinality": VIEWS + """, labels AS (
          SELECT 'raw_state' AS name, state AS label FROM quotes_raw
          UNION ALL
          SELECT 'state', CASE WHEN trim(state) LIKE 'NATN%'
                               THEN replace(trim(state), 'NATN', 'NATION')
                               ELSE trim(state) END FROM quotes_raw
          UNION ALL SELECT 'commodity', commodity FROM quotes_raw)
        SELECT name, count(DISTINCT label) AS n_labels,
               count(DISTINCT label) + max(CASE WHEN label IS NULL THEN 1 ELSE 0 END)
                 AS n_labels_with_missing,
               count(*) AS n_rows
        FROM labels GROUP BY name""",
    "describe_price": VIEWS + describe("quotes", "modal_price", 4),
    "describe_split": SPLIT + describe("split", "modal_price", 2, "commodity", "is_train")
        + " UNION ALL BY NAME SELECT 'OVERALL' AS commodity, * FROM ("
        + describe("split", "modal_price", 2, "is_train") + ")",
    "describe_residual": RESIDUAL + describe(
        "(SELECT * FROM residuals WHERE is_train)", "residual", 2
    ),
    "null_audit": SPLIT + " UNION ALL ".join(
        f"""SELECT '{name}' AS feature,
            '{"string" if name in ("commodity", "state")
              else "int" if name.startswith("day") else "double"}' AS type,
            count(*) FILTER (WHERE is_train AND {name} IS NULL) AS nulls_train,
            {r(f"100e0 * count(*) FILTER (WHERE is_train AND {name} IS NULL)"
               " / nullif(count(*) FILTER (WHERE is_train), 0)", 2)} AS nulls_train_pct,
            count(*) FILTER (WHERE NOT is_train AND {name} IS NULL) AS nulls_test,
            {r(f"100e0 * count(*) FILTER (WHERE NOT is_train AND {name} IS NULL)"
               " / nullif(count(*) FILTER (WHERE NOT is_train), 0)", 2)} AS nulls_test_pct
            FROM split"""
        for name in MODEL_FEATURES
    ),
    "null_totals": VIEWS + " UNION ALL ".join(
        f"SELECT '{name}' AS column_name, count(*) FILTER (WHERE {name} IS NULL) AS n_null "
        "FROM features"
        for name in PANEL_COLUMNS
    ),
    "text_in_numbers": VIEWS + " UNION ALL ".join(
        f"SELECT '{name}' AS column_name, count(*) FILTER (WHERE {name} IS NOT NULL AND "
        f"try_cast({name} AS double) IS NULL) AS n_text FROM quotes_raw"
        for name in ("min_price", "max_price", "modal_price")
    ),
}

_COVERAGE = VIEWS + """, dates AS (
  SELECT 'market_commodity' AS granularity, count(DISTINCT price_date) AS n_dates
  FROM quotes WHERE market_name IS NOT NULL AND commodity IS NOT NULL
  GROUP BY market_name, commodity
  UNION ALL
  SELECT 'state_commodity', count(DISTINCT price_date)
  FROM quotes WHERE state IS NOT NULL AND commodity IS NOT NULL GROUP BY state, commodity
), covered AS (
  SELECT granularity, cast(median(n_dates) AS double) AS median_dates,
         (SELECT cast(date_diff('day', min(price_date), max(price_date)) AS integer)
          FROM quotes) AS total_days,
         count(*) AS n_groups
  FROM dates GROUP BY granularity
), shares AS (SELECT *, median_dates / total_days * 100 AS pct FROM covered)
"""

ORACLE |= {
    "coverage_by_granularity": _COVERAGE + f"""
        SELECT granularity, median_dates, total_days, {rounded(4, "pct")}, n_groups FROM shares""",
    "coverage_verdict": _COVERAGE + f""", levels AS (
          SELECT max(pct) FILTER (WHERE granularity = 'market_commodity') AS market,
                 max(pct) FILTER (WHERE granularity = 'state_commodity') AS state FROM shares)
        SELECT granularity, {rounded(4, "pct")}, ballpark_pct,
               abs(pct - ballpark_pct) > 10 AS flagged, pct >= 30 AS viable,
               CASE WHEN market >= 30 THEN 'market_commodity'
                    WHEN state >= 30 THEN 'state_commodity' ELSE 'resample' END AS recommendation
        FROM (SELECT *, CASE granularity WHEN 'market_commodity' THEN 17e0 ELSE 40e0 END
              AS ballpark_pct FROM shares), levels""",
    "gap_date_ranges": VIEWS + " UNION ALL ".join(
        f"""SELECT commodity, count(*) AS n, min(price_date) AS first_date,
            max(price_date) AS last_date, '{tag}' AS source
            FROM {source} WHERE commodity IN {ALL_FOUR} GROUP BY commodity"""
        for tag, source in (("raw", "quotes_dated"), ("cleaned", "quotes"))
    ),
    "gap_monthly_rows": VIEWS + " UNION ALL ".join(
        f"""SELECT commodity, cast(date_trunc('month', price_date) AS date) AS month,
            count(*) AS n, '{tag}' AS source FROM {source}
            WHERE commodity IN {GAPS} AND price_date IS NOT NULL GROUP BY ALL"""
        for tag, source in (("raw", "quotes_dated"), ("cleaned", "quotes"))
    ),
    "gap_monthly_states": VIEWS + f"""
        SELECT commodity, cast(date_trunc('month', price_date) AS date) AS month,
               count(DISTINCT state) AS n_states
        FROM quotes WHERE commodity IN {GAPS} AND price_date IS NOT NULL GROUP BY ALL""",
    "gap_verdict": VIEWS + f"""
        SELECT commodity, raw_last_date, cleaned_last_date,
               CASE WHEN raw_last_date = cleaned_last_date THEN 'raw data' ELSE 'pipeline' END
                 AS gap_source
        FROM (SELECT commodity, max(price_date) AS raw_last_date FROM quotes_dated
              WHERE commodity IN {GAPS} GROUP BY commodity)
        LEFT JOIN (SELECT commodity, max(price_date) AS cleaned_last_date FROM quotes
                   WHERE commodity IN {GAPS} GROUP BY commodity) USING (commodity)""",
    "daily_panel": VIEWS + f"SELECT {_DATE_KEYS}, {rounded(4, 'modal_price')} FROM panel",
    "scalar_dates": VIEWS + f"""
        SELECT {_DATE_KEYS}, cast(year(price_date) AS integer) AS year,
               cast(month(price_date) AS integer) AS month,
               cast(date_trunc('month', price_date) AS date) AS month_start,
               strftime(price_date, '%b') AS month_label, day_of_week, day_of_year,
               cast(date_diff('day', (SELECT min(price_date) FROM features), price_date)
                    AS integer) AS days_since_first
        FROM features""",
    "scalar_numeric": VIEWS + f"""
        SELECT {_DATE_KEYS}, {r("abs(modal_price - lag_1)", 2)} AS abs_change,
               {r("sqrt(power(modal_price - lag_1, 2))", 1)} AS root_square_change,
               {r("(modal_price - lag_1) / nullif(lag_1, 0) * 100", 2)} AS change_pct,
               lag_1 IS NULL AS no_prior_report,
               abs(modal_price - lag_1) < 1e-6 AS unchanged
        FROM features""",
    "lag_features": VIEWS + f"""
        SELECT {_DATE_KEYS}, {rounded(4, *MODEL_FEATURES[:4])} FROM features""",
    "rolling_features": VIEWS + f"""
        SELECT {_DATE_KEYS}, {rounded(4, *_HISTORY)} FROM features""",
    "calendar_features": VIEWS + f"""
        SELECT {_DATE_KEYS}, {rounded(4, "month_sin", "month_cos")}, day_of_week, day_of_year
        FROM features""",
    "reference_ratio": VIEWS + f"""
        SELECT {_DATE_KEYS}, {rounded(4, "price_vs_msp")} FROM features""",
    "reference_table_ratio": VIEWS + f"""
        , ref_prices AS (
          SELECT upper(commodity) AS label, make_date(year(price_date) + 1, 1, 1) AS valid_from,
                 min(modal_price) AS reference_price
          FROM features WHERE year(price_date) % 2 = 0 GROUP BY ALL),
        rated AS (
          SELECT f.* REPLACE (f.modal_price / b.reference_price AS price_vs_msp)
          FROM features f ASOF LEFT JOIN ref_prices b
            ON upper(f.commodity) = b.label AND f.price_date >= b.valid_from)
        SELECT {_DATE_KEYS}, {rounded(4, "price_vs_msp")} FROM rated""",
    "feature_panel": VIEWS + f"""
        SELECT {_DATE_KEYS}, {rounded(4, "modal_price", *MODEL_FEATURES[:10], "price_vs_msp")},
               day_of_week, day_of_year FROM features""",
    "panel_integrity": VIEWS + _checks("features", {
        **{f"type_{name}": "false" for name in PANEL_COLUMNS},
        "date_window": "year(price_date) NOT BETWEEN 1995 AND 2001",
        "month_sin": "abs(month_sin - sin(2 * pi() * month(price_date) / 12)) >= 1e-6",
        "month_cos": "abs(month_cos - cos(2 * pi() * month(price_date) / 12)) >= 1e-6",
        "reference_ratio": "(price_vs_msp IS NOT NULL) <> (lower(commodity) = 'promo')",
        "lag_1": "lag_1 <= 0 OR lag_1 >= 1000000",
        "lag_7": "lag_7 <= 0 OR lag_7 >= 1000000",
    }),
    "spot_sample": VIEWS + f"""
        SELECT {_DATE_KEYS}, {rounded(4, "modal_price", "lag_1", "lag_7", "month_sin",
                                      "month_cos")}
        FROM features
        ORDER BY md5(concat_ws('|', '42', state, commodity, cast(price_date AS varchar)))
        LIMIT 3""",
    "time_split": SPLIT + f"SELECT {_DATE_KEYS}, is_train FROM split",
    "split_cutoff": SPLIT + """
        SELECT date_min, date_max, cast(span_days AS integer) AS span_days, cutoff_us,
               cast(DATE '1970-01-01' + cast(cutoff_us // 86400000000 AS integer) AS date)
                 AS cutoff_date
        FROM cut""",
    "split_audit": SPLIT + f""", sides AS (
          SELECT count(*) FILTER (WHERE is_train) AS n_train,
                 count(*) FILTER (WHERE NOT is_train) AS n_test,
                 min(price_date) FILTER (WHERE is_train) AS train_min,
                 max(price_date) FILTER (WHERE is_train) AS train_max,
                 min(price_date) FILTER (WHERE NOT is_train) AS test_min,
                 max(price_date) FILTER (WHERE NOT is_train) AS test_max
          FROM split),
        common AS (SELECT count(*) AS shared_dates FROM (
          SELECT price_date FROM split WHERE is_train
          INTERSECT SELECT price_date FROM split WHERE NOT is_train))
        SELECT n_train, n_test, train_min, train_max, test_min, test_max, shared_dates,
               {r("n_train / cast(n_train + n_test AS double)", 4)} AS train_ratio,
               {r("n_test / cast(n_train + n_test AS double)", 4)} AS test_ratio,
               coalesce(train_max < test_min AND shared_dates = 0, false) AS ok
        FROM sides, common""",
    "scope_audit": VIEWS + f"""
        SELECT commodity, count(*) AS n, commodity IN {SCOPE} AS expected
        FROM features GROUP BY commodity""",
    "unexpected_categories": VIEWS + f"""
        SELECT DISTINCT commodity FROM features
        EXCEPT SELECT unnest(['ECONOMY', 'STANDARD'])""",
    "leakage_audit": _leakage(),
    "leakage_audit_planted": _leakage(
        VIEWS + """, leaky AS (
          SELECT * REPLACE (
            CASE WHEN count(*) OVER last7 >= 3 THEN avg(modal_price) OVER last7 END
              AS rolling_mean_7,
            CASE WHEN count(*) OVER last7 >= 3 THEN stddev_samp(modal_price) OVER last7 END
              AS rolling_std_7,
            CASE WHEN count(*) OVER last30 >= 3 THEN avg(modal_price) OVER last30 END
              AS rolling_mean_30,
            CASE WHEN count(*) OVER last30 >= 3 THEN stddev_samp(modal_price) OVER last30 END
              AS rolling_std_30)
          FROM features
          WINDOW last7 AS (PARTITION BY state, commodity ORDER BY price_date
                           ROWS BETWEEN 6 PRECEDING AND CURRENT ROW),
                 last30 AS (PARTITION BY state, commodity ORDER BY price_date
                            ROWS BETWEEN 29 PRECEDING AND CURRENT ROW))""",
        "leaky",
    ),
    "findings": _recomputed(SPLIT, "split") + f""", shifts AS (
          SELECT max(abs((te - tr) / tr * 100)) AS shift FROM (
            SELECT avg(modal_price) FILTER (WHERE is_train) AS tr,
                   avg(modal_price) FILTER (WHERE NOT is_train) AS te
            FROM split GROUP BY commodity) WHERE tr IS NOT NULL AND te IS NOT NULL)
        SELECT 'F1 scope' AS check_id,
               count(*) FILTER (WHERE commodity NOT IN {SCOPE}) = 0 AS ok,
               concat('rows out of scope ', count(*) FILTER (WHERE commodity NOT IN {SCOPE}))
                 AS detail
        FROM split
        UNION ALL
        SELECT 'F2 split', max(price_date) FILTER (WHERE is_train)
                           < min(price_date) FILTER (WHERE NOT is_train),
               concat('cutoff ', (SELECT cast(DATE '1970-01-01'
                 + cast(cutoff_us // 86400000000 AS integer) AS date) FROM cut),
                 ' train ', count(*) FILTER (WHERE is_train),
                 ' from ', min(price_date) FILTER (WHERE is_train),
                 ' to ', max(price_date) FILTER (WHERE is_train),
                 ' test ', count(*) FILTER (WHERE NOT is_train),
                 ' from ', min(price_date) FILTER (WHERE NOT is_train),
                 ' to ', max(price_date) FILTER (WHERE NOT is_train)) FROM split
        UNION ALL
        SELECT 'F3 no leakage', n = 0,
               concat('target is no feature, history values that differ ', n)
        FROM (SELECT {" + ".join(
            f"count(*) FILTER (WHERE {_differs(name, f'fresh_{name}')})"
            for name in MODEL_FEATURES[:8]
        )} AS n FROM compared)
        UNION ALL
        SELECT 'F4 missing values', true, concat({" + ".join(
            f"count(*) FILTER (WHERE {name} IS NULL)" for name in MODEL_FEATURES
        )}, ' kept as missing') FROM split
        UNION ALL
        SELECT 'F5 encoding', true, concat('commodity ', count(DISTINCT commodity),
                                           ' state ', count(DISTINCT state)) FROM split
        UNION ALL
        SELECT 'F6 distribution', true, concat('largest mean shift in tenths of a percent ',
               cast(floor({r("shift", 1)} * 10 + 0.5e0) AS bigint)) FROM shifts""",
    "missing_groups": AUDIT_SPLIT + """
        SELECT a.commodity, count(*) FILTER (WHERE NOT is_train) AS n_test,
               max(price_date) AS last_date,
               CASE WHEN count(s.commodity) = 0 THEN 'absent'
                    WHEN count(*) FILTER (WHERE NOT is_train) = 0 THEN 'no test rows'
                    ELSE 'present' END AS status
        FROM (SELECT unnest(['ECONOMY', 'STANDARD', 'PROMO', 'SMALL', 'TIN']) AS commodity) a
        LEFT JOIN split s ON lower(a.commodity) = lower(s.commodity) GROUP BY a.commodity""",
    "shared_dates": SPLIT + """
        SELECT price_date, 'split' AS flag FROM (
          SELECT price_date FROM split WHERE is_train
          INTERSECT SELECT price_date FROM split WHERE NOT is_train)
        UNION ALL
        SELECT price_date, 'commodity' FROM (
          SELECT price_date FROM split WHERE commodity = 'ECONOMY'
          INTERSECT SELECT price_date FROM split WHERE commodity <> 'ECONOMY')""",
    "categorical_plan": SPLIT + " UNION ALL ".join(
        f"SELECT '{name}' AS name, {name} AS label, count(*) AS n FROM split GROUP BY {name}"
        for name in ("commodity", "state")
    ),
    "categorical_cardinality": SPLIT + " UNION ALL ".join(
        f"SELECT '{name}' AS name, count(DISTINCT {name}) AS cardinality FROM split"
        for name in ("commodity", "state")
    ),
    "unseen_categories": SPLIT + " UNION ALL ".join(
        f"""SELECT '{name}' AS name,
            count(DISTINCT {label}) FILTER (WHERE is_train) AS n_train_labels,
            count(*) FILTER (WHERE NOT is_train AND {label} NOT IN
              (SELECT {label} FROM split WHERE is_train)) AS n_unseen_test_rows FROM split"""
        for name, label in {
            "commodity": "commodity", "state": "state",
            "month_label": "strftime(price_date, '%Y-%m')",
        }.items()
    ),
    "split_representation": AUDIT_SPLIT + f"""
        SELECT *, {r("CASE WHEN n_train > 0 THEN n_test * 100e0 / n_train END", 1)}
                    AS test_share_pct
        FROM (SELECT commodity, count(*) FILTER (WHERE is_train) AS n_train,
                     count(*) FILTER (WHERE NOT is_train) AS n_test
              FROM split GROUP BY commodity)""",
    "mean_shift": SPLIT + f"""
        SELECT commodity, {rounded(4, "train_mean", "test_mean")},
               {r("(test_mean - train_mean) / train_mean * 100", 4)} AS shift_pct
        FROM (SELECT commodity, avg(modal_price) FILTER (WHERE is_train) AS train_mean,
                     avg(modal_price) FILTER (WHERE NOT is_train) AS test_mean
              FROM split GROUP BY commodity)
        WHERE train_mean IS NOT NULL AND test_mean IS NOT NULL""",
    "naive_forecast": NAIVE + f"""
        SELECT {_DATE_KEYS}, {rounded(4, "modal_price", "predicted")} FROM naive""",
    "naive_summary": NAIVE + """
        SELECT (SELECT count(*) FROM features WHERE lag_1 IS NULL) AS n_dropped,
               count(*) AS n, min(price_date) AS date_min, max(price_date) AS date_max,
               count(*) FILTER (WHERE is_train) AS n_train,
               count(*) FILTER (WHERE NOT is_train) AS n_test
        FROM split""",
    "naive_metrics": NAIVE + errors("naive", "predicted", "BASELINE"),
    "metrics_improvement": SPLIT + three_models("split") + f"""
        SELECT b.group_label, m.n, {", ".join(
            f"b.{e} AS {e}_base, m.{e} AS {e}_model, "
            f"{improvement(f'b.{e}', f'm.{e}')} AS {e}_imp_pct" for e in _ERRORS)}
        FROM base_rows b JOIN mean_rows m USING (group_label)""",
    "three_way_comparison": COMPARED + "SELECT * FROM compared",
    "forecast_verdict": COMPARED + """
        SELECT group_label, mae_resid_vs_base_pct, mape_pct_resid_vs_base_pct,
               coalesce(mae_resid_vs_base_pct > 0, false)
                 AND coalesce(mape_pct_resid_vs_base_pct > 0, false) AS beats
        FROM compared WHERE group_label = 'OVERALL'""",
    "run_log_commits": NAIVE + f""", scores AS ({errors("naive", "predicted", "BASELINE")}),
        runs AS (SELECT unnest(['a', 'b', 'c', 'd']) AS run_id)""" + " UNION ALL ".join(
        f"""
        SELECT run_id, concat('BASELINE_', group_label, '_{_SUFFIX[e]}') AS metric,
               {r(e, 2)} AS value FROM scores, runs""" for e in _ERRORS
    ) + """
        UNION ALL SELECT run_id, 'n_test_overall', cast(n AS double) FROM scores, runs
        WHERE group_label = 'OVERALL'""",
    "run_log_metrics": SPLIT + three_models("split") + " UNION ALL ".join(
        f"SELECT 'MEAN7_OVERALL_{_SUFFIX[e]}' AS metric, {e} AS rescored, {e} AS logged "
        "FROM mean_rows WHERE group_label = 'OVERALL'"
        for e in _ERRORS
    ),
    "residual_target": RESIDUAL + f"""
        SELECT {_DATE_KEYS}, is_train, {rounded(4, "residual")} FROM residuals""",
    "residual_reconstruct": RESIDUAL + f""", constant AS (
          SELECT commodity AS c, avg(residual) AS step FROM residuals
          WHERE is_train GROUP BY commodity)
        SELECT {_DATE_KEYS}, {rounded(4, "lag_1")}, {r("lag_1 + step", 4)} AS predicted
        FROM residuals JOIN constant ON commodity = c WHERE NOT is_train""",
    "seasonal_pivot": SPLIT + f"""
        SELECT commodity, cast(year(price_date) AS integer) AS year, {", ".join(
            f"{r(f'avg(modal_price) FILTER (WHERE month(price_date) = {i})', 1)} AS {label}"
            for i, label in enumerate(MONTHS, 1))}
        FROM split WHERE is_train GROUP BY commodity, year(price_date)""",
    "seasonal_test_months": SPLIT + f""", spine AS (
          SELECT commodity, cast(unnest(range(1, 7)) AS integer) AS month
          FROM (SELECT DISTINCT commodity FROM split)),
        means AS (SELECT commodity, month(price_date) AS month, avg(modal_price) AS mean_price
                  FROM split WHERE NOT is_train GROUP BY ALL)
        SELECT s.commodity, s.month,
               strftime(make_date(2000, s.month, 1), '%b') AS month_label,
               {rounded(4, "mean_price")}
        FROM spine s LEFT JOIN means m ON s.commodity = m.commodity AND s.month = m.month""",
    "seasonal_windows": WINDOWS + f"""
        SELECT commodity, part, year, n_rows, {rounded(1, "mean", "median", "std")},
               months_present, months_present = 6 AS is_full,
               CASE WHEN part = 'test' THEN 'window (test)'
                    ELSE concat('window ', year, ' (train)',
                                CASE WHEN months_present = 6 THEN ''
                                     ELSE concat(' partial ', months_present) END) END AS period
        FROM windows""",
    "seasonal_delta": WINDOWS + f""", latest AS (
          SELECT commodity, year AS prior_year, mean AS prior_mean FROM windows
          WHERE part = 'train' AND months_present = 6
          QUALIFY row_number() OVER (PARTITION BY commodity ORDER BY year DESC) = 1),
        tested AS (SELECT commodity, {r("mean", 1)} AS test_mean FROM windows
                   WHERE part = 'test'),
        whole AS (SELECT commodity, avg(modal_price) AS train_mean FROM split
                  WHERE is_train GROUP BY commodity)
        SELECT commodity, prior_year,
               {rounded(4, "train_mean", "prior_mean", "test_mean")},
               {r("(test_mean - prior_mean) / prior_mean * 100", 4)} AS delta_pct,
               {r("(prior_mean - train_mean) / train_mean * 100", 4)} AS prior_vs_train_pct
        FROM whole LEFT JOIN latest USING (commodity) LEFT JOIN tested USING (commodity)""",
    "price_trends": VIEWS + f"""
        SELECT price_date, commodity, {r("avg(modal_price)", 4)} AS mean_price FROM quotes
        WHERE commodity IN {ALL_FOUR} AND price_date IS NOT NULL GROUP BY ALL""",
    "monthly_seasonality": VIEWS + f"""
        SELECT cast(month(price_date) AS integer) AS month, commodity,
               {r("avg(modal_price)", 4)} AS mean_price
        FROM quotes WHERE commodity IN {ALL_FOUR} AND price_date IS NOT NULL
        GROUP BY month(price_date), commodity""",
    "split_daily": SPLIT + f"""
        SELECT is_train, price_date, {r("avg(modal_price)", 4)} AS mean_price
        FROM split GROUP BY is_train, price_date""",
    "pred_extent": NAIVE + f"""
        SELECT commodity, {r("least(min(modal_price), min(predicted))", 4)} AS low,
               {r("greatest(max(modal_price), max(predicted))", 4)} AS high
        FROM naive GROUP BY commodity""",
    # Digits of the decimal text, in thousandths and in hundredths.
    "round_ties": VIEWS + """, planted AS (
          SELECT DISTINCT (round(modal_price) + t)
                 * CASE WHEN modal_price % 2 < 1 THEN 1 ELSE -1 END AS value
          FROM quotes, (SELECT unnest([0.005e0, 0.125e0, -2.675e0, 1e0]) AS t)),
        exact AS (SELECT value, cast(cast(value AS varchar) AS decimal(38,12)) AS d FROM planted),
        cut AS (SELECT value, sign(d) AS s, floor(abs(d) * 100) AS low,
                       abs(d) * 100 - floor(abs(d) * 100) AS rest FROM exact)
        SELECT value,
               cast(s * (low + CASE WHEN rest > 0.5 OR (rest = 0.5 AND low % 2 = 1)
                                    THEN 1 ELSE 0 END) AS double) / 100 AS half_even,
               cast(s * (low + CASE WHEN rest >= 0.5 THEN 1 ELSE 0 END) AS double) / 100 AS half_up
        FROM cut""",
    "gbt_save_load": SPLIT + f"""
        SELECT {_DATE_KEYS}, {rounded(4, "modal_price")}, true AS same_prediction
        FROM split WHERE NOT is_train""",
    "gbt_resume": SPLIT + f"""
        SELECT {_DATE_KEYS}, true AS was_stopped, 1::bigint AS rounds_kept, 0e0 AS gap
        FROM split WHERE NOT is_train""",
    # Every cut between two values, missing ones tried on both sides; the first of the largest
    # gains in order of feature, side and cut.
    "gbt_stump": SPLIT + f""", train AS (
          SELECT modal_price AS y, cast(isodow(price_date) - 1 AS double) AS weekday,
                 least(floor(lag_30 / 5000), 20e0) AS lag_band
          FROM split WHERE is_train),
        long AS (
          SELECT 0 AS k, 'weekday' AS feature, weekday AS x, y FROM train
          UNION ALL SELECT 1, 'lag_band', lag_band, y FROM train),
        found AS (
          SELECT k, feature, x, count(*) AS n, sum(y) AS s, sum(y * y) AS q
          FROM long GROUP BY ALL),
        nulls AS (SELECT k, n AS n0, s AS s0 FROM found WHERE x IS NULL),
        cuts AS (
          SELECT k, feature, (x + lead(x) OVER up) / 2 AS cut,
                 sum(n) OVER up AS n, sum(s) OVER up AS s
          FROM found WHERE x IS NOT NULL WINDOW up AS (PARTITION BY k ORDER BY x)),
        sides AS (
          SELECT k, feature, cut, CASE WHEN n0 IS NOT NULL THEN true END AS missing_left,
                 n + coalesce(n0, 0) AS n, s + coalesce(s0, 0) AS s
          FROM cuts LEFT JOIN nulls USING (k) WHERE cut IS NOT NULL
          UNION ALL
          SELECT k, feature, cut, false, n, s FROM cuts JOIN nulls USING (k)
          WHERE cut IS NOT NULL),
        whole AS (SELECT count(*) AS n_all, sum(y) AS s_all FROM train),
        best AS (
          SELECT *, s * s / n + (s_all - s) * (s_all - s) / (n_all - n)
                    - s_all * s_all / n_all AS gain
          FROM sides, whole ORDER BY gain DESC, k, missing_left DESC, cut LIMIT 1)
        SELECT n::bigint AS n, {r("s / n", 4)} AS predicted, feature, cut, missing_left,
               {rounded(0, "gain")} FROM best
        UNION ALL
        SELECT (n_all - n)::bigint, {r("(s_all - s) / (n_all - n)", 4)}, feature, cut,
               missing_left, {rounded(0, "gain")} FROM best""",
    "gbt_reconstruction": RESIDUAL + f"""
        SELECT {_DATE_KEYS}, {rounded(4, "lag_1")}, true AS adds_up
        FROM residuals WHERE NOT is_train""",
    "gbt_scored_rows": RESIDUAL + " UNION ALL ".join(
        f"""SELECT {_DATE_KEYS}, '{model}' AS model, {rounded(4, "modal_price")},
                   modal_price IS NOT NULL AS scored FROM {rows} WHERE NOT is_train"""
        for model, rows in {"DIRECT": "split", "RESIDUAL": "residuals"}.items()
    ),
    "gbt_model_errors": TESTED + f""",
        own AS ({errors("tested", "lag_1", "BASELINE")}),
        common AS ({errors("shared", "lag_1", "BASELINE")})""" + " UNION ALL ".join(
        f"""
        SELECT '{name}' AS comparison, group_label, n, mae AS mae_base, rmse AS rmse_base,
               mape_pct AS mape_pct_base, mae IS NOT NULL AS agrees FROM {rows}"""
        for name, rows in {"direct": "own", "three-way": "common"}.items()
    ),
    "gbt_importance_shares": USED + """
        SELECT model, feature, 100e0 AS total_pct FROM used""",
    "run_record_names": TESTED + ", " + USED.removeprefix("WITH ") + f""",
        labels AS (SELECT 'OVERALL' AS label UNION ALL SELECT DISTINCT commodity FROM shared),
        models AS (SELECT DISTINCT model FROM used),
        kinds AS (SELECT unnest({list(_SUFFIX.values())}) AS suffix)
        SELECT model, concat_ws('_', model, label, suffix) AS metric,
               cast(NULL AS double) AS n_test FROM models, labels, kinds
        UNION ALL SELECT model, 'n_test_overall',
                         cast((SELECT count(*) FROM shared) AS double) FROM models
        UNION ALL SELECT model, concat('gain_pct ', feature), NULL FROM used""",
    "saved_row_counts": NAIVE + """
        SELECT 'saved' AS name, count(*) AS n FROM naive UNION ALL SELECT 'absent', NULL""",
    "csv_line_breaks": VIEWS + """
        SELECT state,
               CASE WHEN grade <> 'N'
                    THEN concat(market_name, chr(10), 'stall "', grade, '", ', variety, chr(10),
                                chr(10))
                    ELSE market_name END AS market_name,
               commodity, nullif(modal_price, 'n/a') AS modal_price, price_date
        FROM quotes_raw""",
    "csv_mixed_headers": VIEWS + """
        SELECT state, commodity, CASE WHEN grade IN ('N', 'R') THEN variety END AS variety, grade,
               nullif(modal_price, 'n/a') AS modal_price, price_date
        FROM quotes_raw""",
    "io_roundtrip": NAIVE + f"""
        SELECT 'raw csv' AS stage, count(*) AS n,
               cast(sum(floor({r("try_cast(modal_price AS double)", 2)} * 100 + 0.5e0))
                    AS bigint) AS cents
        FROM quotes_raw WHERE try_cast(modal_price AS double) IS NOT NULL
          AND try_cast(min_price AS double) IS NOT NULL
          AND try_cast(max_price AS double) IS NOT NULL
        UNION ALL SELECT 'cleaned csv', count(*),
               cast(sum(floor({r("modal_price", 2)} * 100 + 0.5e0)) AS bigint) FROM quotes
        UNION ALL SELECT 'baseline predictions', count(*),
               cast(sum(floor({r("predicted", 2)} * 100 + 0.5e0)) AS bigint) FROM naive
        UNION ALL SELECT 'renamed predictions', count(*),
               cast(sum(floor({r("predicted", 2)} * 100 + 0.5e0)) AS bigint) FROM naive
        UNION ALL SELECT 'feature panel', count(*),
               cast(sum(floor({r("lag_1", 2)} * 100 + 0.5e0)) AS bigint) FROM features""",
}


def oracle() -> dict[str, str]:
    return dict(ORACLE)
