"""Source contracts: which columns are read, what they are called here, and their types."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Field:
    source: str  # header in the landed file
    name: str  # column name in this package
    type: str  # Spark SQL type
    required: bool = False  # a row without it is rejected


@dataclass(frozen=True)
class Contract:
    name: str
    fields: tuple[Field, ...]
    year_of: str | None = None  # date column whose year partitions the landed table
    year_column: str | None = None
    together: str | None = None  # column whose rows of a year are landed together: they are aggregated by it

    @property
    def columns(self) -> list[str]:
        return [field.name for field in self.fields]


# Header names of the three source files.
PRICES = Contract(
    "prices",
    (
        Field("symbol", "symbol", "string", required=True),
        Field("date", "date", "date", required=True),
        Field("close", "close", "double"),
        Field("high", "high", "double"),
        Field("low", "low", "double"),
    ),
    year_of="date",
    year_column="trade_year",
    together="symbol",
)

FUNDAMENTALS = Contract(
    "fundamentals",
    (
        Field("Ticker Symbol", "symbol", "string", required=True),
        Field("Period Ending", "period_ending", "date", required=True),
        Field("Total Revenue", "total_revenue", "double"),
        Field("Net Income", "net_income", "double"),
        Field("Gross Margin", "gross_margin", "double"),
        Field("Operating Margin", "operating_margin", "double"),
        Field("Earnings Per Share", "eps", "double"),
        Field("Long-Term Debt", "long_term_debt", "double"),
        Field("Total Equity", "total_equity", "double"),
    ),
    year_of="period_ending",
    year_column="fiscal_year",
)

SECURITIES = Contract(
    "securities",
    (
        Field("Ticker Symbol", "symbol", "string", required=True),
        Field("Security", "company_name", "string"),
        Field("GICS Sector", "sector", "string"),
        Field("GICS Sub Industry", "sub_industry", "string"),
    ),
)

CONTRACTS = (PRICES, FUNDAMENTALS, SECURITIES)

# Column lists of the enriched table and of the models built on it.
ENRICHED_COLUMNS = [
    "symbol", "year", "first_close", "last_close", "avg_daily_range",
    "sector", "sub_industry", "company_name", "period_ending",
    "total_revenue", "net_income", "gross_margin", "operating_margin",
    "eps", "long_term_debt", "total_equity",
]
STAGING_COLUMNS = ["stock_year" if c == "year" else c for c in ENRICHED_COLUMNS]
METRIC_COLUMNS = [
    "symbol", "stock_year", "sector", "sub_industry", "company_name",
    "period_ending", "net_income", "gross_margin", "operating_margin", "eps",
    "yearly_return", "volatility", "risk_adj_return", "debt_to_equity",
]
FUNDAMENTALS_MART_COLUMNS = [
    "company_name", "stock_year", "debt_to_equity", "eps", "gross_margin", "yearly_return",
]
