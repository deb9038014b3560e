"""For each registered query the SQL that must give the same result on the same tables."""

from __future__ import annotations

import re

from tickerloom.contracts import (
    ENRICHED_COLUMNS,
    FUNDAMENTALS,
    FUNDAMENTALS_MART_COLUMNS,
    METRIC_COLUMNS,
    PRICES,
    SECURITIES,
    STAGING_COLUMNS,
)
from tickerloom.operators import quality
from tickerloom.plans.queries import (
    FRESH_AS_OF,
    FRESH_DAYS,
    LOW_PRICE,
    PRUNED_YEAR,
    ROLLING_DAYS,
)

RELATIONS = {
    "price_rows": """
        SELECT o_custkey AS symbol, CAST(l_shipdate AS DATE) AS date, l_extendedprice AS close,
               l_extendedprice * (1 + l_tax) AS high, l_extendedprice * (1 - l_discount) AS low,
               l_returnflag, l_linestatus, l_linenumber
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
    "prices": """
        SELECT symbol, date, max(close) AS close, max(high) AS high, min(low) AS low
        FROM price_rows GROUP BY symbol, date""",
    "per_order": """
        SELECT l_orderkey, sum(l_extendedprice) AS g, sum(l_extendedprice * l_discount) AS disc,
               sum(l_extendedprice * l_tax) AS tx, sum(l_quantity) AS q
        FROM lineitem GROUP BY l_orderkey""",
    "fundamentals": """
        SELECT o_orderkey AS filing_id, o_custkey AS symbol,
               CAST(o_orderdate AS DATE) AS period_ending, o_totalprice AS total_revenue,
               o_totalprice - disc AS net_income, 100 * (g - disc) / nullif(g, 0) AS gross_margin,
               100 * (g - disc - tx) / nullif(g, 0) AS operating_margin,
               (o_totalprice - disc) / nullif(100 * q, 0) AS eps,
               tx AS long_term_debt, c_acctbal AS total_equity
        FROM orders LEFT JOIN per_order ON l_orderkey = o_orderkey
        JOIN customer ON c_custkey = o_custkey""",
    "securities": """
        SELECT c_custkey AS symbol, c_name AS company_name, c_mktsegment AS sector,
               n_name AS sub_industry
        FROM customer JOIN nation ON c_nationkey = n_nationkey""",
    "yearly": """
        SELECT symbol, CAST(year(date) AS INTEGER) AS year,
               arg_min_null(close, coalesce(date, DATE '9999-12-31')) AS first_close,
               arg_max_null(close, coalesce(date, DATE '9999-12-31')) AS last_close,
               avg(high - low) AS avg_daily_range
        FROM prices GROUP BY ALL""",
    "latest": """
        SELECT * FROM fundamentals
        QUALIFY row_number() OVER (PARTITION BY symbol, year(period_ending)
                                   ORDER BY period_ending DESC, filing_id DESC) = 1""",
    "joined": """
        SELECT yearly.*, fundamentals.* EXCLUDE (symbol, filing_id)
        FROM yearly JOIN fundamentals
          ON yearly.symbol = fundamentals.symbol AND year(period_ending) = yearly.year""",
    "enriched": """
        SELECT joined.*, sector, sub_industry, company_name
        FROM joined JOIN securities ON joined.symbol = securities.symbol""",
    "staged": "SELECT * RENAME (year AS stock_year) FROM enriched",
    "metrics": """
        SELECT *, yearly_return / nullif(volatility, 0) AS risk_adj_return
        FROM (SELECT *, (last_close - first_close) / nullif(first_close, 0) AS yearly_return,
                     avg_daily_range / nullif(first_close, 0) AS volatility,
                     long_term_debt / nullif(total_equity, 0) AS debt_to_equity
              FROM staged)""",
    "sectors": """
        SELECT sector, avg(yearly_return) AS avg_yearly_return, avg(volatility) AS avg_volatility,
               avg(risk_adj_return) AS avg_risk_adj_return
        FROM metrics GROUP BY sector""",
    "ranked": """
        SELECT CAST(row_number() OVER (ORDER BY avg_risk_adj_return DESC NULLS LAST, sector)
                    AS INTEGER) AS position, * FROM sectors""",
    "mart": f"SELECT {', '.join(FUNDAMENTALS_MART_COLUMNS)} FROM metrics",
    "returns": """
        SELECT symbol, date, close,
               (close - lag(close) OVER w) / nullif(lag(close) OVER w, 0) AS daily_return
        FROM prices WINDOW w AS (PARTITION BY symbol ORDER BY date)""",
}

_DATES = {"date", "period_ending", "latest", "bar_date"}
_EXACT = {
    "symbol", "year", "stock_year", "sector", "sub_industry", "company_name", "filing_id",
    "position", "n_rows", "n_ticks", "n_returns", "n_pairs", "model", "factor",
}


def statement(sql: str, **other_relations: str) -> str:
    relations = RELATIONS | other_relations
    return "WITH " + ",\n".join(f"{n} AS ({text})" for n, text in relations.items()) + f"\n{sql}"


def rounded(column: str, name: str | None = None) -> str:
    return f"round({column} + 1e-9, 6) AS {name or column}"


# Nine tenths of the events arrive first; of the rest those are late whose day the first closed.
FED = """
    WITH marks AS (
        SELECT max(ts) FILTER (WHERE event_id % 10 <> 0) - INTERVAL 1 DAY AS first, max(ts) - INTERVAL 1 DAY AS last FROM events),
    ticks AS (
        SELECT *, CAST(ts AS DATE) AS day,
            event_id % 10 = 0 AND CAST(ts AS DATE) + INTERVAL 1 DAY <= first AS late
        FROM events, marks)"""


def _fed_bars(which: str) -> str:
    return f"""{FED},
    bars AS (
        SELECT user_id AS symbol, day AS bar_date, arg_min_null(value, ts) AS open, arg_max_null(value, ts) AS close,
               max(value) AS high, min(value) AS low, count(*) AS n_ticks
        FROM ticks WHERE {which} AND day + INTERVAL 1 DAY <= last GROUP BY ALL)
    SELECT {shown(['symbol', 'bar_date', 'open', 'close', 'high', 'low', 'n_ticks'])} FROM bars"""


def shown(columns: list[str]) -> str:
    def one(column: str) -> str:
        if column in _EXACT:
            return column
        return f"CAST({column} AS VARCHAR) AS {column}" if column in _DATES else rounded(column)

    return ", ".join(one(column) for column in columns)


def select(columns: list[str], rest: str) -> str:
    return statement(f"SELECT {shown(columns)} FROM {rest}")


def _scan(relation: str, contract) -> str:
    rest = shown([c for c in contract.columns if c != "symbol"])
    return statement(f"SELECT CAST(symbol AS VARCHAR) AS symbol, {rest} FROM {relation}")


def _test_row(relation: str, model: str, column: str, test: str, failing: str) -> str:
    return (
        f"SELECT '{model}' AS model, '{column}' AS column_name, '{test}' AS test, "
        f"count(*) FILTER (WHERE {failing}) AS failures FROM {relation}"
    )


MODEL_RELATIONS = {
    "stg_stocks_enriched": "staged",
    "int_stock_metrics": "metrics",
    "mart_sector_performance": "sectors",
    "mart_fundamentals_vs_return": "mart",
}


def _not_null_rows(model: str) -> list[str]:
    relation = MODEL_RELATIONS[model]
    return [
        _test_row(relation, model, c, "not_null", f"{c} IS NULL") for c in quality.NOT_NULL[model]
    ]


def _not_null(model: str) -> str:
    return statement(" UNION ALL ".join(_not_null_rows(model)))


_UNIQUE_ROW = _test_row(
    "(SELECT count(*) AS n FROM sectors WHERE sector IS NOT NULL GROUP BY sector) AS counted",
    "mart_sector_performance", "sector", "unique", "n > 1",
)
_SUITE_ROWS = [row for model in MODEL_RELATIONS for row in _not_null_rows(model)] + [_UNIQUE_ROW]

YEARLY_COLUMNS = ["symbol", "year", "first_close", "last_close", "avg_daily_range"]
SECTOR_COLUMNS = ["sector", "avg_yearly_return", "avg_volatility", "avg_risk_adj_return"]
JOINED_COLUMNS = YEARLY_COLUMNS + [c for c in FUNDAMENTALS.columns if c != "symbol"]
RANKED = select(["position", *SECTOR_COLUMNS], "ranked")
YEARLY = select(YEARLY_COLUMNS, "yearly")

_TOP_ORDER = (
    "yearly_return DESC NULLS LAST, company_name NULLS LAST, eps NULLS LAST, "
    "gross_margin NULLS LAST, debt_to_equity NULLS LAST"
)
_FACTORS = ("eps", "gross_margin", "debt_to_equity")


def _close_of_year(function: str, alias: str) -> str:
    return statement(
        f"""SELECT symbol, CAST(date AS VARCHAR) AS date, {rounded('close')},
               round({function}(close) OVER (
                   PARTITION BY symbol, year(date) ORDER BY date
                   ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) + 1e-9, 6) AS {alias}
        FROM prices"""
    )


def _correlation(by: str | None) -> str:
    key, group = (f"{by}, ", f" GROUP BY {by}") if by else ("", "")
    return statement(
        " UNION ALL ".join(
            f"""SELECT {key}'{f}' AS factor, CAST(regr_count(yearly_return, {f}) AS BIGINT) AS n_pairs,
               {rounded(f'corr(yearly_return, {f})', 'correlation')},
               {rounded(f'regr_slope(yearly_return, {f})', 'slope')}
            FROM metrics{group}"""
            for f in _FACTORS
        )
    )


_RANGE_FAILURES = {
    "gross_margin": "gross_margin < 0 OR gross_margin > 100 OR isnan(gross_margin)",
    "debt_to_equity": "debt_to_equity < 0 OR isnan(debt_to_equity)",
}
_LATEST_JOINED = RELATIONS["joined"].replace("JOIN fundamentals", "JOIN latest AS fundamentals")


def _two_runs(sql: str, second: str) -> str:
    """``sql`` over the relations of a run with all filings, and of one with the latest ones."""
    relations = RELATIONS | {
        f"{name}2": _renamed(text, name) for name, text in (RELATIONS | {"joined": _LATEST_JOINED}).items()
        if name in _BUILT
    }
    ctes = ",\n".join(f"{n} AS ({text})" for n, text in relations.items())
    return f"WITH {ctes}\n{sql} UNION ALL {second}"


_BUILT = ("joined", "enriched", "staged", "metrics", "sectors", "mart")


def _renamed(text: str, name: str) -> str:
    for built in _BUILT:
        text = re.sub(rf"\b(FROM|JOIN) {built}\b", rf"\1 {built}2", text)
    return text.replace("joined.", "joined2.")


def _counts(run: str, suffix: str) -> str:
    return " UNION ALL ".join(
        f"SELECT '{run}' AS run, '{model}' AS model, count(*) AS n_rows FROM {relation}{suffix}"
        for model, relation in (
            ("stocks_enriched", "enriched"),
            ("mart_sector_performance", "sectors"),
            ("mart_fundamentals_vs_return", "mart"),
        )
    )


def _passes(run: str, suffix: str) -> str:
    """Tests and passes of each model in a run, orphan problems counted where they occur."""
    rows = []
    for model, relation in MODEL_RELATIONS.items():
        failing = [f"{c} IS NULL" for c in quality.NOT_NULL[model]]
        if model == "int_stock_metrics":
            failing += list(_RANGE_FAILURES.values())
        passed = " + ".join(f"CAST(count(*) FILTER (WHERE {f}) = 0 AS INTEGER)" for f in failing)
        more = 1 if model == "mart_sector_performance" else 0  # a sector is unique by grouping
        shrunk = {"mart_sector_performance": "sectors", "mart_fundamentals_vs_return": "mart"}.get(model)
        if shrunk:  # and the row count against the run before
            fine = "1" if not suffix else (
                f"CAST((SELECT count(*) FROM {shrunk}2) >= 0.8 * (SELECT count(*) FROM {shrunk}) AS INTEGER)"
            )
            passed, more = f"{passed} + {fine}", more + 1
        unique = " + 1" if model == "mart_sector_performance" else ""
        rows.append(
            f"SELECT '{run}' AS run, '{model}' AS model, CAST({len(failing) + more} AS BIGINT) AS n_tests, "
            f"CAST({passed}{unique} AS BIGINT) AS n_passed FROM {relation}{suffix}"
        )
    fine = "1" if not suffix else (
        "CAST((SELECT count(*) FROM enriched2) >= 0.8 * (SELECT count(*) FROM enriched) AS INTEGER)"
    )
    rows.append(f"SELECT '{run}', 'stocks_enriched', CAST(1 AS BIGINT), CAST({fine} AS BIGINT)")
    rows.append(f"SELECT '{run}', 'raw_prices', CAST(1 AS BIGINT), CAST(1 AS BIGINT)")
    rows.append(
        f"""SELECT * FROM (SELECT '{run}', 'sources', CAST(
            (SELECT CAST(count(*) > 0 AS INTEGER) FROM fundamentals f
             WHERE NOT EXISTS (FROM yearly y WHERE y.symbol = f.symbol AND y.year = year(f.period_ending)))
            + (SELECT CAST(count(*) > 0 AS INTEGER) FROM yearly y WHERE NOT EXISTS (
               FROM fundamentals f WHERE f.symbol = y.symbol AND year(f.period_ending) = y.year))
            + (SELECT CAST(count(*) > 0 AS INTEGER) FROM yearly y
               WHERE NOT EXISTS (FROM securities s WHERE s.symbol = y.symbol))
            + (SELECT CAST(count(*) > 0 AS INTEGER) FROM securities s
               WHERE NOT EXISTS (FROM fundamentals f WHERE f.symbol = s.symbol)) AS BIGINT) AS n,
            CAST(0 AS BIGINT)) WHERE n > 0"""
    )
    return " UNION ALL ".join(rows)


ORACLES: dict[str, str] = {
    # sources
    "scan_prices": _scan("prices", PRICES),
    "scan_fundamentals": _scan("fundamentals", FUNDAMENTALS),
    "scan_securities": _scan("securities", SECURITIES),
    "ingest_raw": _scan("prices", PRICES),
    "ingest_overlapping": _scan("prices", PRICES),
    "ingest_rejects": statement(
        """SELECT CASE WHEN l_linenumber IN (1, 2) THEN 'row' ELSE concat_ws(',',
                     CASE WHEN l_linenumber = 3 THEN 'symbol' END,
                     CASE WHEN l_returnflag = 'R' THEN 'date' END,
                     CASE WHEN l_linestatus = 'O' THEN 'close' END) END AS bad_columns,
               count(*) AS n_rows
        FROM price_rows WHERE l_linenumber <= 3 OR l_returnflag = 'R' OR l_linestatus = 'O'
        GROUP BY 1"""
    ),
    # prices
    "daily_range": statement(
        f"SELECT symbol, CAST(date AS VARCHAR) AS date, {rounded('(high - low)', 'daily_range')} FROM prices"
    ),
    "prices_yearly": YEARLY,
    "prices_yearly_windowed": YEARLY,
    "sql_prices_yearly": YEARLY,
    "window_first_close": _close_of_year("first_value", "first_close"),
    "window_last_close": _close_of_year("last_value", "last_close"),
    "daily_returns": select(["symbol", "date", "close", "daily_return"], "returns"),
    "rolling_volatility": statement(
        f"""SELECT symbol, CAST(date AS VARCHAR) AS date, {rounded('daily_return')},
               CASE WHEN count(daily_return) OVER w = {ROLLING_DAYS}
                    THEN round(stddev_samp(daily_return) OVER w + 1e-9, 6) END AS rolling_sigma
        FROM returns
        WINDOW w AS (PARTITION BY symbol ORDER BY date
                     ROWS BETWEEN {ROLLING_DAYS - 1} PRECEDING AND CURRENT ROW)"""
    ),
    "sharpe_yearly": statement(
        f"""SELECT symbol, CAST(year(date) AS INTEGER) AS year, count(daily_return) AS n_returns,
               {rounded('avg(daily_return)', 'mean_return')},
               {rounded('stddev_samp(daily_return)', 'sigma')},
               {rounded('avg(daily_return) / nullif(stddev_samp(daily_return), 0) * sqrt(252)', 'sharpe')}
        FROM returns GROUP BY symbol, year(date)"""
    ),
    # joins, models, marts
    "join_prices_fundamentals": select(JOINED_COLUMNS, "joined"),
    "stocks_enriched": select(ENRICHED_COLUMNS, "enriched"),
    "stg_stocks_enriched": select(STAGING_COLUMNS, "staged"),
    "int_stock_metrics": select(METRIC_COLUMNS, "metrics"),
    "mart_sector_performance": select(SECTOR_COLUMNS, "sectors"),
    "mart_sector_by_counts": select(SECTOR_COLUMNS, "sectors"),
    "mart_fundamentals_vs_return": select(FUNDAMENTALS_MART_COLUMNS, "mart"),
    "fundamentals_latest_per_year": select(["filing_id", *FUNDAMENTALS.columns], "latest"),
    "mart_sector_performance_dedup": statement(
        f"SELECT {shown(SECTOR_COLUMNS)} FROM sectors",
        joined=RELATIONS["joined"].replace("JOIN fundamentals", "JOIN latest AS fundamentals"),
    ),
    "flagship_sector_ranking": RANKED,
    # reports
    "report_kpis": statement(
        """SELECT
            (SELECT sector FROM ranked ORDER BY position LIMIT 1) AS best_sector,
            (SELECT format('{:.2f} Sharpe proxy', avg_risk_adj_return) FROM ranked
             ORDER BY position LIMIT 1) AS best_sector_value,
            (SELECT sector FROM ranked ORDER BY position DESC LIMIT 1) AS worst_sector,
            (SELECT format('{:.1f}%', 100 * max(avg_yearly_return)) FROM ranked) AS best_return,
            (SELECT sector FROM ranked ORDER BY avg_yearly_return DESC NULLS LAST, position LIMIT 1)
                AS best_return_sector,
            (SELECT format('{:.2f}', min(avg_volatility)) FROM ranked) AS low_volatility,
            (SELECT sector FROM ranked ORDER BY avg_volatility NULLS LAST, position LIMIT 1)
                AS low_volatility_sector,
            (SELECT format('{:,}', count(DISTINCT company_name)) FROM mart) AS companies_tracked"""
    ),
    "report_sector_ranking": RANKED,
    "report_sector_table": statement(
        """SELECT sector AS "Sector", format('{:.1f}%', 100 * avg_yearly_return) AS "Avg Yearly Return",
               format('{:.2f}', avg_volatility) AS "Avg Volatility",
               format('{:.3f}', avg_risk_adj_return) AS "Risk-Adj Return"
        FROM sectors ORDER BY avg_risk_adj_return DESC NULLS LAST, sector"""
    ),
    "report_fundamentals": select(
        FUNDAMENTALS_MART_COLUMNS, "mart ORDER BY stock_year NULLS LAST, company_name NULLS LAST"
    ),
    "report_years": statement(
        """SELECT DISTINCT stock_year,
               CAST(stock_year = (SELECT max(stock_year) FROM mart) AS INTEGER) AS is_default
        FROM mart WHERE stock_year IS NOT NULL"""
    ),
    "report_top_performers": statement(
        f"""SELECT company_name AS "Company", format('{{:.1f}}%', 100 * yearly_return) AS "Yearly Return",
               round(eps + 1e-9, 6) AS "EPS", round(gross_margin + 1e-9, 6) AS "Gross Margin",
               round(debt_to_equity + 1e-9, 6) AS "Debt/Equity"
        FROM mart WHERE stock_year = (SELECT max(stock_year) FROM mart)
        ORDER BY {_TOP_ORDER} LIMIT 10"""
    ),
    "report_top_performers_all_years": statement(
        f"""SELECT {shown(['stock_year', 'position', *[c for c in FUNDAMENTALS_MART_COLUMNS if c != 'stock_year']])}
        FROM (SELECT *, CAST(row_number() OVER (PARTITION BY stock_year ORDER BY {_TOP_ORDER}) AS INTEGER)
                     AS position FROM mart WHERE stock_year IS NOT NULL) AS listed
        WHERE position <= 10"""
    ),
    "feed_sector_bar": select(["sector", "avg_risk_adj_return"], "sectors"),
    "feed_return_vs_volatility": select(SECTOR_COLUMNS, "sectors"),
    "feed_eps_vs_return": select(
        ["eps", "yearly_return", "gross_margin", "company_name", "stock_year"],
        "mart WHERE eps BETWEEN -50 AND 50",
    ),
    "feed_debt_vs_return": select(
        ["debt_to_equity", "yearly_return", "company_name", "stock_year"],
        "mart WHERE debt_to_equity BETWEEN 0 AND 5",
    ),
    # quality
    "dq_staging": _not_null("stg_stocks_enriched"),
    "dq_intermediate": _not_null("int_stock_metrics"),
    "dq_mart_sector": _not_null("mart_sector_performance"),
    "dq_mart_fundamentals": _not_null("mart_fundamentals_vs_return"),
    "dq_unique_sector": statement(_UNIQUE_ROW),
    "dq_suite": statement(
        f"""SELECT *, CASE WHEN failures = 0 THEN 'pass' ELSE 'fail' END AS status
        FROM ({' UNION ALL '.join(_SUITE_ROWS)}) AS results"""
    ),
    "dq_ranges": statement(
        " UNION ALL ".join(
            _test_row("metrics", "int_stock_metrics", column, "range", failing)
            for column, failing in _RANGE_FAILURES.items()
        )
    ),
    "dq_price_grain": statement(
        """SELECT symbol, CAST(date AS VARCHAR) AS date, count(*) AS n_rows FROM price_rows
        WHERE symbol IS NOT NULL AND date IS NOT NULL GROUP BY ALL HAVING count(*) > 1"""
    ),
    "dq_orphans": statement(
        """SELECT 'filing without prices' AS problem, symbol,
               CAST(year(period_ending) AS INTEGER) AS year, count(*) AS n_rows
        FROM fundamentals AS f
        WHERE NOT EXISTS (FROM yearly AS y WHERE y.symbol = f.symbol AND y.year = year(f.period_ending))
        GROUP BY ALL
        UNION ALL SELECT 'prices without filing', symbol, year, 1 FROM yearly AS y
        WHERE NOT EXISTS (FROM fundamentals AS f
                          WHERE f.symbol = y.symbol AND year(f.period_ending) = y.year)
        UNION ALL SELECT 'prices without security', symbol, year, 1 FROM yearly AS y
        WHERE NOT EXISTS (FROM securities AS s WHERE s.symbol = y.symbol)
        UNION ALL SELECT 'filing without security', symbol,
               CAST(year(period_ending) AS INTEGER), count(*) FROM fundamentals AS f
        WHERE NOT EXISTS (FROM securities AS s WHERE s.symbol = f.symbol)
        GROUP BY ALL
        UNION ALL SELECT 'security without filing', symbol, NULL, 1 FROM securities AS s
        WHERE NOT EXISTS (FROM fundamentals AS f WHERE f.symbol = s.symbol)"""
    ),
    "dq_freshness": statement(
        f"""SELECT source, CAST(latest AS VARCHAR) AS latest,
               CAST(date_diff('day', latest, DATE '{FRESH_AS_OF}') AS INTEGER) AS age_days,
               CASE WHEN date_diff('day', latest, DATE '{FRESH_AS_OF}') <= {FRESH_DAYS}
                    THEN 'pass' ELSE 'fail' END AS status
        FROM (SELECT 'prices' AS source, max(date) AS latest FROM prices
              UNION ALL SELECT 'fundamentals', max(period_ending) FROM fundamentals) AS newest"""
    ),
    "dq_rowcount_anomaly": _two_runs(
        "SELECT run, model, n_rows, CAST(NULL AS BIGINT) AS previous_rows, 'pass' AS status "
        f"FROM ({_counts('1', '')}) AS first",
        "SELECT b.run, b.model, b.n_rows, a.n_rows, "
        "CASE WHEN b.n_rows < 0.8 * a.n_rows THEN 'fail' ELSE 'pass' END "
        f"FROM ({_counts('1', '')}) AS a JOIN ({_counts('2', '2')}) AS b USING (model)",
    ),
    "dq_pass_rate": _two_runs(
        f"SELECT run, model, n_tests, n_passed, {rounded('n_passed / n_tests', 'pass_rate')} FROM ({_passes('1', '')}) AS a",
        f"SELECT run, model, n_tests, n_passed, {rounded('n_passed / n_tests', 'pass_rate')} FROM ({_passes('2', '2')}) AS b",
    ),
    # analysis
    "factor_correlation": _correlation("sector"),
    "factor_correlation_overall": _correlation(None),
    "factor_correlation_by_year": _correlation("stock_year"),
    "outlier_returns": statement(
        f"""SELECT {shown(['symbol', 'year', 'first_close', 'yearly_return', 'percent_rank'])}
        FROM (SELECT *, percent_rank() OVER (PARTITION BY year ORDER BY yearly_return) AS percent_rank
              FROM (SELECT symbol, year, first_close,
                           (last_close - first_close) / nullif(first_close, 0) AS yearly_return
                    FROM yearly) AS with_return WHERE yearly_return IS NOT NULL) AS with_rank
        WHERE first_close < {LOW_PRICE} AND yearly_return >= 2"""
    ),
    # tables and pipeline
    "roundtrip_enriched": select(STAGING_COLUMNS, "staged"),
    "pruned_year_read": select(STAGING_COLUMNS, f"staged WHERE stock_year = {PRUNED_YEAR}"),
    "incremental_refresh": select(STAGING_COLUMNS, "staged"),
    "published_risk": statement(
        f"""SELECT symbol, CAST(date AS VARCHAR) AS date, {rounded('close')}, {rounded('daily_return')},
               CASE WHEN count(daily_return) OVER w = {ROLLING_DAYS}
                    THEN round(stddev_samp(daily_return) OVER w + 1e-9, 6) END AS rolling_sigma
        FROM returns
        WINDOW w AS (PARTITION BY symbol ORDER BY date
                     ROWS BETWEEN {ROLLING_DAYS - 1} PRECEDING AND CURRENT ROW)"""
    ),
    "kept_lake": statement(
        f"""SELECT r.symbol, CAST(r.date AS VARCHAR) AS date, {rounded('p.close', 'close')}, {rounded('p.high', 'high')},
               {rounded('p.low', 'low')},
               CASE WHEN count(daily_return) OVER w = {ROLLING_DAYS}
                    THEN round(stddev_samp(daily_return) OVER w + 1e-9, 6) END AS rolling_sigma
        FROM returns AS r JOIN prices AS p ON p.symbol = r.symbol AND p.date = r.date
        WINDOW w AS (PARTITION BY r.symbol ORDER BY r.date
                     ROWS BETWEEN {ROLLING_DAYS - 1} PRECEDING AND CURRENT ROW)"""
    ),
    "colocated_enriched": select(ENRICHED_COLUMNS, "enriched"),
    "colocated_returns": select(["symbol", "date", "close", "daily_return"], "returns"),
    "compact_table": YEARLY,
    "run_pipeline": select(SECTOR_COLUMNS, "sectors"),
    "publish_marts": select(FUNDAMENTALS_MART_COLUMNS, "mart"),
    "run_metrics": statement(
        "SELECT 'stocks_enriched' AS model, count(*) AS n_rows FROM enriched "
        "UNION ALL SELECT 'mart_sector_performance', count(*) FROM sectors "
        "UNION ALL SELECT 'mart_fundamentals_vs_return', count(*) FROM mart"
    ),
    # streaming: a day is closed once the newest event is a further day past its end
    "stream_daily_bars": f"""
        WITH bars AS (
            SELECT user_id AS symbol, CAST(ts AS DATE) AS bar_date, arg_min_null(value, ts) AS open,
                   arg_max_null(value, ts) AS close, max(value) AS high, min(value) AS low,
                   count(*) AS n_ticks
            FROM events GROUP BY ALL)
        SELECT {shown(['symbol', 'bar_date', 'open', 'close', 'high', 'low', 'n_ticks'])} FROM bars
        WHERE bar_date + INTERVAL 2 DAY <= (SELECT max(ts) FROM events)""",
    "feed_bars": _fed_bars("NOT late"),
    "feed_bars_reconciled": _fed_bars("true"),
    "feed_late_ticks": f"{FED} SELECT CAST(day AS VARCHAR) AS bar_date, count(*) AS n_late FROM ticks WHERE late GROUP BY day",
}
