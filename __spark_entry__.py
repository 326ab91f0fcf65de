"""

``entry(spark)`` runs the flagship query on sf0.001. ``queries()`` maps every
implemented operator/table to a callable ``(spark, sf_dir) -> DataFrame`` that
reads the supplied tables in full; ``oracle_sql()`` gives the same result as
DuckDB SQL over the supplied tables (registered as views).

Reproducibility: ages are measured from a fixed instant (``as_of``), faults
are a pure function of each row's key, and the streaming queries run with
``availableNow`` into fresh folders under the session's checkpoint directory.
"""

from __future__ import annotations

import importlib
import os
import sys
from collections.abc import Callable

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import DataFrame, SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from tessera import oracle  # noqa: E402
from tessera.functions import buckets, columns  # noqa: E402
from tessera.operators import quality  # noqa: E402
from tessera.operators.share import with_share  # noqa: E402
from tessera.plans import colocated, gold, pipeline  # noqa: E402
from tessera.plans.bronze import bronze  # noqa: E402
from tessera.session import fresh_path  # noqa: E402
from tessera.sources import files, schemas  # noqa: E402
from tessera.sources.tables import read_table  # noqa: E402
from tessera.streaming import kyc_stream, purchase_stream  # noqa: E402

def _optional(name: str):
    """A module that may have been left out, with what it needs of the library;
    None then. Anything else that fails to import is an error."""
    try:
        return importlib.import_module(name)
    except ModuleNotFoundError as missing:
        if missing.name in ("tessera.llm", "tessera.llm.registry", "corpus_pipeline"):
            return None
        raise


# The training-data operators are an optional part: without them the queries
# below still work.
_llm = _optional("tessera.llm.registry")
_corpus = _optional("corpus_pipeline")

FLAGSHIP_DIR = "/root/testdata/sf0.001"
BATCH_AS_OF = oracle.BATCH_AS_OF
EVENTS_AS_OF = oracle.EVENTS_AS_OF

TABLES = ("holdings", "market", "transactions", "profiles", "kyc", "purchases")
FAULTED = ("holdings", "market", "transactions", "profiles", "kyc")

# gold query key -> spec name (AGG18 shares AGG11's published name, so it is
# registered as purchase_demographics).
GOLD_KEYS = {f"gold_{name}": name for name in gold.SPECS}


# The gold tables of each feed, built from its streaming silver sink. Those
# registered by name below are left out.
_NAMED = ("realtime_kyc_metrics", "purchase_analytics")
STREAM_GOLD = tuple(
    (feed, run, tuple(n for n, spec in gold.SPECS.items() if spec.inputs == (feed,) and n not in _NAMED))
    for feed, run in (("kyc", kyc_stream.run_gold), ("purchases", purchase_stream.run_gold))
)


def _as_of(table: str) -> str:
    return EVENTS_AS_OF if table in ("kyc", "purchases") else BATCH_AS_OF


def entry(spark: SparkSession) -> DataFrame:
    """Flagship: client portfolio performance (holdings x profiles)."""
    return pipeline.gold_table(spark, FLAGSHIP_DIR, "client_portfolio_performance", BATCH_AS_OF)


def _bronze_q(table: str, faults: bool) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, d: bronze(spark, d, table, faults=faults)


def _silver_q(table: str) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, d: pipeline.silver_frame(bronze(spark, d, table), table, _as_of(table))


def _gold_q(name: str) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, d: pipeline.gold_table(spark, d, name, BATCH_AS_OF)


def _position_share(spark: SparkSession, d: str) -> DataFrame:
    b = bronze(spark, d, "holdings")
    return with_share(b, "market_value", "position_size_percentage", oracle.SHARE_SCALE_QUERY).select(
        "holding_id", "market_value", "position_size_percentage"
    )


def _quarantine_q(table: str) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, d: str) -> DataFrame:
        derived = pipeline.DERIVE[table](bronze(spark, d, table), _as_of(table))
        return _rule_text(quality.quarantine(derived, quality.RULES[table]))
    return run


def _rule_text(rows: DataFrame) -> DataFrame:
    """Rule names as text, for comparison with SQL."""
    return rows.withColumn("failed_rules", F.concat_ws(",", "failed_rules"))


def _text_ingest(fmt: str) -> Callable[[SparkSession, str], DataFrame]:
    """SRC1 / SNK1 / PRJ7: KYC bronze written as text with some malformed ages
    under the shared folder, read back and typed."""
    def run(spark: SparkSession, d: str) -> DataFrame:
        rows = bronze(spark, d, "kyc", faults=False).select(*schemas.KYC.fieldNames())
        text = rows.select(*[F.col(c).cast("string").alias(c) for c in rows.columns])
        text = text.withColumn("age", F.when(F.expr("try_cast(age AS int) % 7 = 0"), F.lit("n/a")).otherwise(F.col("age")))
        path = fresh_path(spark, f"kyc-{fmt}")
        writer = text.write.option("header", "true") if fmt == "csv" else text.write
        writer.format(fmt).save(path)
        return files.read_bronze(spark, path, "kyc", fmt)
    return run


def _bucketed_nations(spark: SparkSession, d: str) -> DataFrame:
    """PRJ6 / PRJ5: substring region and first-letter bucket of every customer."""
    c = read_table(spark, d, "customer", ["c_custkey", "c_nationkey", "c_mktsegment"])
    n = read_table(spark, d, "nation", ["n_nationkey", "n_name"])
    return c.join(n, c.c_nationkey == n.n_nationkey).select(
        "c_custkey",
        buckets.regex_bucket(F.lower("n_name"), *buckets.REGION).alias("region"),
        buckets.regex_bucket(F.lower("c_mktsegment"), *buckets.TRANSACTION_TYPE).alias("transaction_type"),
    )


# Written out by hand, not from the library's tables.
BUCKETED_NATIONS_SQL = """
SELECT c_custkey,
       CASE WHEN lower(n_name) LIKE '%united%' THEN 'North America'
            WHEN lower(n_name) LIKE '%germany%' THEN 'Europe'
            WHEN lower(n_name) LIKE '%japan%' THEN 'Asia' ELSE 'Other' END AS region,
       CASE WHEN lower(c_mktsegment[1]) IN ('a', 'e', 'i', 'o', 'u') THEN 'BUY'
            WHEN lower(c_mktsegment[1]) IN ('b', 'c', 'd', 'f', 'g') THEN 'SELL'
            WHEN lower(c_mktsegment[1]) IN ('h', 'j', 'k', 'l', 'm') THEN 'DIVIDEND' ELSE 'REINVEST' END
         AS transaction_type
FROM customer JOIN nation ON c_nationkey = n_nationkey
"""


# Segment texts of customers, in the cases of letters the bucket patterns allow.
SEGMENTS = (
    "High Tech Growth Manager, Individual", "corporate finance, value, consultant@firm", "Health plan, retired, Joint",
    "energy income manager", "united growth, Joint corporate", "retail", "Consultant in tech value, individual@home",
)


def _bucketed_texts(spark: SparkSession, d: str) -> DataFrame:
    """PRJ6: every substring bucket over a text of each customer."""
    c = read_table(spark, d, "customer", ["c_custkey"])
    texts = F.array(*[F.lit(t) for t in SEGMENTS])
    c = c.withColumn("t", F.when(F.col("c_custkey") % 10 < 9, F.get(texts, (F.col("c_custkey") % 7).cast("int"))))
    named = {
        "sector": buckets.SECTOR, "region": buckets.REGION, "currency": buckets.CURRENCY,
        "investment_strategy": buckets.INVESTMENT_STRATEGY, "employment_status": buckets.EMPLOYMENT_STATUS,
        "account_type": buckets.ACCOUNT_TYPE_STREAM,
    }
    return c.select("c_custkey", *[buckets.regex_bucket("t", *b).alias(name) for name, b in named.items()])


# Written out by hand, not from the library's tables.
BUCKETED_TEXTS_SQL = """
WITH t AS (
  SELECT c_custkey, CASE WHEN c_custkey % 10 < 9 THEN CASE c_custkey % 7
    WHEN 0 THEN 'High Tech Growth Manager, Individual' WHEN 1 THEN 'corporate finance, value, consultant@firm'
    WHEN 2 THEN 'Health plan, retired, Joint' WHEN 3 THEN 'energy income manager'
    WHEN 4 THEN 'united growth, Joint corporate' WHEN 5 THEN 'retail'
    ELSE 'Consultant in tech value, individual@home' END END AS t
  FROM customer)
SELECT c_custkey,
  CASE WHEN t LIKE '%Tech%' OR t LIKE '%tech%' THEN 'Technology'
       WHEN t LIKE '%Finance%' OR t LIKE '%finance%' THEN 'Financial Services'
       WHEN t LIKE '%Health%' OR t LIKE '%health%' THEN 'Healthcare'
       WHEN t LIKE '%Energy%' OR t LIKE '%energy%' THEN 'Energy' ELSE 'Consumer Goods' END AS sector,
  CASE WHEN t LIKE '%United%' OR t LIKE '%united%' THEN 'North America'
       WHEN t LIKE '%Germany%' OR t LIKE '%germany%' THEN 'Europe'
       WHEN t LIKE '%Japan%' OR t LIKE '%japan%' THEN 'Asia' ELSE 'Other' END AS region,
  CASE WHEN t LIKE '%@%' THEN 'USD' ELSE 'EUR' END AS currency,
  CASE WHEN t LIKE '%Growth%' OR t LIKE '%growth%' THEN 'Growth' WHEN t LIKE '%Value%' OR t LIKE '%value%' THEN 'Value'
       WHEN t LIKE '%Income%' OR t LIKE '%income%' THEN 'Income' ELSE 'Balanced' END AS investment_strategy,
  CASE WHEN t LIKE '%Manager%' OR t LIKE '%manager%' THEN 'Employed'
       WHEN t LIKE '%Consultant%' OR t LIKE '%consultant%' THEN 'Self-Employed'
       WHEN t LIKE '%Retired%' OR t LIKE '%retired%' THEN 'Retired' ELSE 'Unemployed' END AS employment_status,
  CASE WHEN t LIKE '%Individual%' OR t LIKE '%individual%' THEN 'Individual'
       WHEN t LIKE '%Joint%' OR t LIKE '%joint%' THEN 'Joint'
       WHEN t LIKE '%Corporate%' OR t LIKE '%corporate%' THEN 'Corporate' ELSE 'Trust' END AS account_type
FROM t
"""


def _text_codes(spark: SparkSession, d: str) -> DataFrame:
    """PRJ3: modulo codes of order numbers kept as text, some negative, some no
    number and some beyond an int."""
    o = read_table(spark, d, "orders", ["o_orderkey"])
    key = F.col("o_orderkey")
    text = F.when(key % 11 == 0, "n/a").when(key % 13 == 0, F.concat(key.cast("string"), F.lit("0000000000"))).when(
        key % 7 == 0, F.concat(F.lit("-"), key.cast("string"))).otherwise(key.cast("string"))
    codes = {
        "account_id": (1000, 1000), "portfolio_id": (500, 500), "age": (50, 25), "risk_rating": (3, 1),
        "experience_years": (30, 1), "volume": (10**7, 10**5), "market_cap": (10**12, 10**9),
    }
    return o.withColumn("t", text).select(
        "o_orderkey", *[columns.modulo_code("t", n, k).alias(name) for name, (n, k) in codes.items()])


# Written out by hand.
TEXT_CODES_SQL = """
WITH t AS (
  SELECT o_orderkey, CASE WHEN o_orderkey % 11 = 0 OR o_orderkey % 13 = 0 THEN NULL
                          ELSE CAST(o_orderkey AS BIGINT) END AS v FROM orders)
SELECT o_orderkey, v % 1000 + 1000 AS account_id, v % 500 + 500 AS portfolio_id, v % 50 + 25 AS age,
       v % 3 + 1 AS risk_rating, v % 30 + 1 AS experience_years, v % 10000000 + 100000 AS volume,
       v % 1000000000000 + 1000000000 AS market_cap
FROM t
"""


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    q: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
    for t in TABLES:
        q[f"bronze_{t}"] = _bronze_q(t, False)
    for t in FAULTED:
        q[f"faults_{t}"] = _bronze_q(t, True)
    for t in TABLES:
        q[f"silver_{t}"] = _silver_q(t)
    q["position_share"] = _position_share
    q["quality_report"] = lambda spark, d: pipeline.quality_report(spark, d, BATCH_AS_OF)
    for t in TABLES:
        q[f"quarantine_{t}"] = _quarantine_q(t)
    for key, name in GOLD_KEYS.items():
        q[key] = _gold_q(name)
    q["stream_silver_kyc"] = lambda spark, d: kyc_stream.run_silver(spark, d)
    q["stream_gold_realtime_kyc"] = lambda spark, d: kyc_stream.run_gold(
        spark, d, "realtime_kyc_metrics"
    )
    q["stream_silver_purchases"] = lambda spark, d: purchase_stream.run_silver(spark, d)
    q["stream_gold_purchase_analytics"] = lambda spark, d: purchase_stream.run_gold(
        spark, d, "purchase_analytics"
    )
    q["stream_gold_incremental_kyc"] = lambda spark, d: spark.read.parquet(
        kyc_stream.run_incremental_gold(spark, d)
    )
    q["stream_gold_incremental_purchases"] = lambda spark, d: spark.read.parquet(
        purchase_stream.run_incremental_gold(spark, d)
    )
    for feed, run, names in STREAM_GOLD:
        for name in names:
            q[f"stream_gold_{name}"] = lambda spark, d, run=run, name=name: run(spark, d, name)
    for feed, run in (("kyc", kyc_stream.run_merged), ("purchases", purchase_stream.run_merged)):
        for spec in gold.undated(feed):
            q[f"stream_gold_merged_{spec.name}"] = lambda spark, d, run=run, name=spec.name: run(spark, d, name)
    for spec in gold.undated("kyc"):
        q[f"shared_gold_{spec.name}"] = lambda spark, d, name=spec.name: pipeline.shared_gold_table(spark, d, name)
    for spec in colocated.join_specs():
        q[f"colocated_gold_{spec.name}"] = lambda spark, d, name=spec.name: pipeline.colocated_gold_table(
            spark, d, name, fresh_path(spark, "colocated"), BATCH_AS_OF)
    q["stream_event_time_kyc"] = lambda spark, d: kyc_stream.run_event_time(spark, d)
    q["stream_quarantine_kyc"] = lambda spark, d: _rule_text(kyc_stream.run_rejected(spark, d))
    q["stream_counters_kyc"] = lambda spark, d: kyc_stream.run_counters(spark, d)
    q["text_ingest_csv"] = _text_ingest("csv")
    q["text_ingest_json"] = _text_ingest("json")
    q["bucketed_nations"] = _bucketed_nations
    q["bucketed_texts"] = _bucketed_texts
    q["text_codes"] = _text_codes
    q["stream_hourly_kyc"] = lambda spark, d: kyc_stream.run_hourly(spark, d)
    if _llm is not None:
        q.update(_llm.QUERIES)
    if _corpus is not None:
        q["pipeline"] = _corpus.run
    return q


def oracle_sql() -> dict[str, str]:
    s: dict[str, str] = {}
    for t in TABLES:
        s[f"bronze_{t}"] = oracle.bronze_sql(t, faults=False)
    for t in FAULTED:
        s[f"faults_{t}"] = oracle.bronze_sql(t, faults=True)
    for t in TABLES:
        s[f"silver_{t}"] = oracle.silver_sql(t)
    s["position_share"] = oracle.position_share_sql()
    s["quality_report"] = oracle.quality_report_sql()
    for t in TABLES:
        s[f"quarantine_{t}"] = oracle.quarantine_sql(t)
    for key, name in GOLD_KEYS.items():
        s[key] = oracle.gold_sql(name)
    s["stream_silver_kyc"] = oracle.silver_sql("kyc")
    s["stream_gold_realtime_kyc"] = oracle.gold_sql("realtime_kyc_metrics")
    s["stream_silver_purchases"] = oracle.silver_sql("purchases")
    s["stream_gold_purchase_analytics"] = oracle.gold_sql("purchase_analytics")
    s["stream_gold_incremental_kyc"] = oracle.gold_sql("realtime_kyc_metrics")
    s["stream_gold_incremental_purchases"] = oracle.gold_sql("realtime_metrics")
    for _, _, names in STREAM_GOLD:
        for name in names:
            s[f"stream_gold_{name}"] = oracle.gold_sql(name)
    for feed in ("kyc", "purchases"):
        for spec in gold.undated(feed):
            s[f"stream_gold_merged_{spec.name}"] = oracle.gold_sql(spec.name)
    for spec in gold.undated("kyc"):
        s[f"shared_gold_{spec.name}"] = oracle.gold_sql(spec.name)
    for spec in colocated.join_specs():
        s[f"colocated_gold_{spec.name}"] = oracle.gold_sql(spec.name)
    s["stream_event_time_kyc"] = oracle.hourly_sql()
    s["stream_quarantine_kyc"] = oracle.quarantine_sql("kyc")
    s["stream_counters_kyc"] = f"SELECT * FROM ({oracle.quality_report_sql()}) q WHERE table_name = 'kyc'"
    for fmt in ("csv", "json"):
        s[f"text_ingest_{fmt}"] = (
            "SELECT * REPLACE (CASE WHEN age % 7 = 0 THEN NULL ELSE age END AS age) "
            f"FROM ({oracle.bronze_sql('kyc', faults=False)}) b"
        )
    s["bucketed_nations"] = BUCKETED_NATIONS_SQL
    s["bucketed_texts"] = BUCKETED_TEXTS_SQL
    s["text_codes"] = TEXT_CODES_SQL
    s["stream_hourly_kyc"] = oracle.hourly_sql()
    if _llm is not None:
        s.update(_llm.SQL)
    return s
