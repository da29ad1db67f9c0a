"""Views that read the driver tables in the shapes the operators expect.

Each view exists twice: as a DataFrame and as a SQL fragment for the oracles.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from posledger.functions.dates import quarter_end
from posledger.operators.ledger import diff_snapshots


_SCHEMAS: dict[str, StructType] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver table; its schema is read from the files once per process."""
    path = f"{sf_dir}/{name}.parquet"
    if path not in _SCHEMAS:
        _SCHEMAS[path] = spark.read.parquet(path).schema
    return spark.read.schema(_SCHEMAS[path]).parquet(path)


def cents(col: str):
    """Money as whole cents, summed as integers: exact in any order."""
    return F.sum(F.floor(F.col(col) * 100.0 + 0.5)) / F.lit(100.0)


def owned_lines(spark, sf_dir, line: DataFrame | None = None, brands: bool = True) -> DataFrame:
    """Line items with the supplier's nation and, on demand, the brand.

    Every build side is a base table, so its true size decides between broadcast and shuffle.
    """
    line = line if line is not None else table(spark, sf_dir, "lineitem")
    supplier, nation = table(spark, sf_dir, "supplier"), table(spark, sf_dir, "nation")
    rows = line.join(supplier.select("s_suppkey", "s_nationkey"), F.col("l_suppkey") == F.col("s_suppkey")).join(
        nation.select("n_nationkey", "n_name"), F.col("s_nationkey") == F.col("n_nationkey"))
    if not brands:
        return rows
    part = table(spark, sf_dir, "part").select("p_partkey", "p_brand")
    return rows.join(part, F.col("l_partkey") == F.col("p_partkey"))


def positions(spark, sf_dir, extra: tuple[str, ...] = (), line: DataFrame | None = None) -> DataFrame:
    """Supplier nation holds brands: shares are quantities, value is the extended price."""
    return owned_lines(spark, sf_dir, line).groupBy(
        F.col("n_name").alias("parent_ticker"), F.col("p_brand").alias("investee_ticker"),
        quarter_end("l_shipdate").alias("period_end"), *extra,
    ).agg(F.sum("l_quantity").alias("shares_held"), cents("l_extendedprice").alias("market_value_usd"))


def periods(spark, sf_dir, line: DataFrame | None = None) -> DataFrame:
    """Reporting periods of every nation (narrow scan, combined before the shuffle)."""
    return owned_lines(spark, sf_dir, line, brands=False).select(
        F.col("n_name").alias("parent_ticker"), quarter_end("l_shipdate").alias("period_end"),
    ).distinct().withColumns({
        "filing_date": F.col("period_end"), "accession_no": F.lit(None).cast("string")})


def snapshot_rows(df: DataFrame) -> DataFrame:
    return df.withColumns({
        "filing_date": F.col("period_end"), "investee_name": F.col("investee_ticker")})


def ledger(spark, sf_dir) -> DataFrame:
    """Position history of all nations."""
    line = table(spark, sf_dir, "lineitem")
    return diff_snapshots(
        snapshot_rows(positions(spark, sf_dir, line=line)), periods(spark, sf_dir, line), unique=True)


QEND = "CAST(date_trunc('quarter', {0}) + INTERVAL 3 MONTH - INTERVAL 1 DAY AS DATE)"
CENTS = "CAST(sum(CAST(floor({0} * 100.0 + 0.5) AS HUGEINT)) AS DOUBLE) / 100.0"
MSUM = "CAST(sum(CAST(floor(({0}) * 10000.0 + 0.5) AS HUGEINT)) AS DOUBLE) / 10000.0"


def qend(col: str) -> str:
    return QEND.format(col)


def sql_cents(col: str) -> str:
    return CENTS.format(col)


def msum(expr: str) -> str:
    return MSUM.format(expr)


def msum_over(expr: str, window: str) -> str:
    return f"CAST(sum(CAST(floor(({expr}) * 10000.0 + 0.5) AS HUGEINT)) OVER ({window}) AS DOUBLE) / 10000.0"


POS = f"""
pos AS (
  SELECT n_name AS parent_ticker, p_brand AS investee_ticker, {qend('l_shipdate')} AS period_end,
         sum(l_quantity) AS shares_held, {sql_cents('l_extendedprice')} AS market_value_usd
  FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey
       JOIN part ON l_partkey = p_partkey
  GROUP BY ALL
)"""

# Period-over-period difference as a full outer self join on consecutive period numbers.
HIST = POS + """,
grid AS (
  SELECT parent_ticker, period_end,
         row_number() OVER (PARTITION BY parent_ticker ORDER BY period_end) AS idx
  FROM (SELECT DISTINCT parent_ticker, period_end FROM pos)
),
placed AS (SELECT p.*, g.idx FROM pos p JOIN grid g USING (parent_ticker, period_end)),
firsts AS (
  SELECT parent_ticker, investee_ticker, min(period_end) AS first_seen_period
  FROM pos WHERE shares_held > 0 GROUP BY ALL
),
steps AS (
  SELECT coalesce(c.parent_ticker, p.parent_ticker) AS parent_ticker,
         coalesce(c.investee_ticker, p.investee_ticker) AS investee_ticker,
         coalesce(c.idx, p.idx + 1) AS idx,
         c.shares_held AS cs, p.shares_held AS ps,
         c.market_value_usd AS cv, p.market_value_usd AS pv
  FROM placed c FULL OUTER JOIN placed p
    ON c.parent_ticker = p.parent_ticker AND c.investee_ticker = p.investee_ticker
   AND c.idx = p.idx + 1
),
hist AS (
  SELECT s.parent_ticker, s.investee_ticker, g.period_end,
         CASE WHEN cs IS NULL THEN 'exit' WHEN ps IS NULL THEN 'new'
              WHEN cs > ps THEN 'buy' WHEN cs < ps THEN 'sell' ELSE 'hold' END AS action,
         CASE WHEN cs IS NULL THEN 0.0 ELSE cs END AS shares_held,
         CASE WHEN cs IS NULL THEN 0.0 ELSE cv END AS market_value_usd,
         ps AS shares_prev, pv AS value_prev,
         CASE WHEN ps IS NULL THEN cs ELSE coalesce(cs, 0.0) - ps END AS shares_delta,
         coalesce(cv, 0.0) - coalesce(pv, 0.0) AS value_delta,
         f.first_seen_period,
         CASE WHEN cs IS NULL THEN g.period_end END AS exited_period
  FROM steps s JOIN grid g ON s.parent_ticker = g.parent_ticker AND s.idx = g.idx
       JOIN firsts f ON f.parent_ticker = s.parent_ticker AND f.investee_ticker = s.investee_ticker
)"""


# -- market data from events ---------------------------------------------------------------------

def _daily(spark, sf_dir, kind: str, value: str) -> DataFrame:
    """Last value per user and day of one event type (combined before the shuffle)."""
    ev = table(spark, sf_dir, "events").where(F.col("event_type") == kind)
    return ev.groupBy(F.col("user_id").alias("ticker"), F.col("ts").cast("date").alias("date")).agg(
        F.max_by("value", F.struct("ts", "event_id")).alias(value))


def prices(spark, sf_dir) -> DataFrame:
    return _daily(spark, sf_dir, "view", "close")


def book_series(spark, sf_dir) -> DataFrame:
    return _daily(spark, sf_dir, "purchase", "bvps").withColumnRenamed("date", "filed")


def earnings_series(spark, sf_dir) -> DataFrame:
    return _daily(spark, sf_dir, "click", "v").select(
        "ticker", F.col("date").alias("filed"), (F.col("v") - F.lit(30.0)).alias("net_income"))


def deletions(spark, sf_dir) -> DataFrame:
    """First signup of a user: the day it left the index."""
    ev = table(spark, sf_dir, "events").where(F.col("event_type") == "signup")
    return ev.groupBy(F.col("user_id").alias("ticker")).agg(
        F.min(F.col("ts").cast("date")).alias("deletion_date"))


def additions(spark, sf_dir) -> DataFrame:
    ev = table(spark, sf_dir, "events").where(F.col("event_type") == "error")
    return ev.select(F.col("user_id").alias("ticker"), F.col("ts").cast("date").alias("added_date")).distinct()


def _sql_daily(name: str, kind: str, cols: str) -> str:
    return f"""{name} AS (
  SELECT user_id AS ticker, CAST(ts AS DATE) AS {'date' if name == 'prices' else 'filed'},
         {cols} FROM (SELECT *, row_number() OVER (PARTITION BY user_id, CAST(ts AS DATE)
           ORDER BY ts DESC, event_id DESC) AS rn FROM events WHERE event_type = '{kind}') WHERE rn = 1)"""


PRICES = _sql_daily("prices", "view", "value AS close")
BOOK = _sql_daily("book", "purchase", "value AS bvps")
EARN = _sql_daily("earn", "click", "value - 30.0 AS net_income")
DELETIONS = """deletions AS (
  SELECT user_id AS ticker, min(CAST(ts AS DATE)) AS deletion_date
  FROM events WHERE event_type = 'signup' GROUP BY ALL)"""
ADDITIONS = """additions AS (
  SELECT DISTINCT user_id AS ticker, CAST(ts AS DATE) AS added_date
  FROM events WHERE event_type = 'error')"""
