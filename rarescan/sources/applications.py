"""The application table derived from orders, customer and lineitem.

One row per order in the native schema of the bank preset, plus three
deterministic scores, so every operator can be checked without a model.  The
same text runs in any SQL engine that reads the driver tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rarescan.config import BANK_APPLICATIONS, SETTINGS
from rarescan.operators.sampling import with_split
from rarescan.sources.shared import new_path

SCORES = ("score_lightgbm", "score_xgboost", "score_mlp")

APPLICATIONS_SQL = """
SELECT o.o_orderkey AS application_id,
  CAST(CASE WHEN coalesce(l.r, 0) >= 4 THEN 1 ELSE 0 END AS INT) AS fraud_bool,
  (1 + o.o_orderkey % 9) / 10e0 AS income,
  ((o.o_orderkey * 7919) % 10007) / 10007e0 AS name_email_similarity,
  CAST(coalesce(l.n, -1) AS BIGINT) AS prev_address_months_count,
  o.o_orderkey % 429 - 1 AS current_address_months_count,
  10 * (1 + o.o_custkey % 9) AS customer_age,
  ((o.o_orderkey * 31) % 7845) / 100e0 AS days_since_request,
  c.c_acctbal / 100 AS intended_balcon_amount,
  CASE o.o_orderpriority WHEN '1-URGENT' THEN 'AA' WHEN '2-HIGH' THEN 'AB' WHEN '3-MEDIUM' THEN 'AC' WHEN '4-NOT SPECIFIED' THEN 'AD' ELSE 'AE' END AS payment_type,
  1 + o.o_orderkey % 6700 AS zip_count_4w,
  o.o_totalprice / 30 AS velocity_6h,
  1300e0 + (o.o_orderkey * 13) % 8200 AS velocity_24h,
  CAST(o.o_orderkey % 5000 - 1 AS DOUBLE) AS velocity_4w,
  CASE WHEN o.o_custkey % 7 = 0 THEN o.o_custkey % 2385 ELSE o.o_custkey % 30 END AS bank_branch_count_8w,
  o.o_custkey % 40 AS date_of_birth_distinct_emails_4w,
  CASE o.o_custkey % 7 WHEN 0 THEN 'CA' WHEN 1 THEN 'CB' WHEN 2 THEN 'CC' WHEN 3 THEN 'CD' WHEN 4 THEN 'CE' WHEN 5 THEN 'CF' ELSE 'CG' END AS employment_status,
  CAST(floor(c.c_acctbal / 30) AS BIGINT) AS credit_risk_score,
  o.o_orderkey % 2 AS email_is_free,
  CASE c.c_mktsegment WHEN 'AUTOMOBILE' THEN 'BA' WHEN 'BUILDING' THEN 'BB' WHEN 'FURNITURE' THEN 'BC' WHEN 'HOUSEHOLD' THEN 'BD' ELSE 'BE' END AS housing_status,
  CAST(CASE WHEN o.o_custkey % 5 < 2 THEN 1 ELSE 0 END AS BIGINT) AS phone_home_valid,
  CAST(CASE WHEN o.o_orderkey % 9 <> 0 THEN 1 ELSE 0 END AS BIGINT) AS phone_mobile_valid,
  CASE WHEN o.o_custkey % 4 = 0 THEN -1 ELSE o.o_custkey % 33 END AS bank_months_count,
  CAST(CASE WHEN o.o_custkey % 9 < 2 THEN 1 ELSE 0 END AS BIGINT) AS has_other_cards,
  CAST(190 + 10 * (o.o_orderkey % 191) AS DOUBLE) AS proposed_credit_limit,
  CAST(CASE WHEN o.o_orderkey % 40 = 0 THEN 1 ELSE 0 END AS BIGINT) AS foreign_request,
  CASE WHEN o.o_orderkey % 142 = 0 THEN 'TELEAPP' ELSE 'INTERNET' END AS source,
  ((o.o_orderkey * 17) % 8600) / 100e0 - 1 AS session_length_in_minutes,
  CASE o.o_orderkey % 5 WHEN 0 THEN 'linux' WHEN 1 THEN 'macintosh' WHEN 2 THEN 'other' WHEN 3 THEN 'windows' ELSE 'x11' END AS device_os,
  CAST(CASE WHEN o.o_orderkey % 7 < 4 THEN 1 ELSE 0 END AS BIGINT) AS keep_alive_session,
  CAST(CASE WHEN o.o_orderkey % 30 = 0 THEN -1 WHEN o.o_orderkey % 31 = 0 THEN 2 ELSE 1 END AS BIGINT) AS device_distinct_emails_8w,
  CAST(0 AS BIGINT) AS device_fraud_count,
  CAST(month(o.o_orderdate) % 8 AS INT) AS month,
  least(0.999e0, (coalesce(l.r, 0) * 120 + (o.o_orderkey * 7919) % 400) / 1000e0) AS score_lightgbm,
  least(0.999e0, (coalesce(l.r, 0) * 100 + (o.o_custkey * 104729 + o.o_orderkey) % 500) / 1200e0) AS score_xgboost,
  least(0.999e0, (coalesce(l.r, 0) * 90 + (o.o_orderkey * 15485863) % 600) / 1300e0) AS score_mlp
FROM orders o
JOIN customer c ON c.c_custkey = o.o_custkey
LEFT JOIN (SELECT l_orderkey, CAST(count(*) AS BIGINT) AS n,
             CAST(sum(CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END) AS BIGINT) AS r
           FROM lineitem GROUP BY l_orderkey) l ON l.l_orderkey = o.o_orderkey
"""


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def applications_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The application table as a lazy query over the driver tables."""
    return spark.sql(
        APPLICATIONS_SQL.replace("FROM orders o", "FROM {orders} o")
        .replace("JOIN customer c", "JOIN {customer} c")
        .replace("FROM lineitem", "FROM {lineitem}"),
        orders=table(spark, sf_dir, "orders"),
        customer=table(spark, sf_dir, "customer"),
        lineitem=table(spark, sf_dir, "lineitem"),
    )


# Small row groups: a join leaves few files of uneven sizes, and tasks share a file by its row groups.
ROW_GROUP_BYTES = 4 << 20

_written: dict[tuple[str, str], str] = {}


def prepared_path(spark: SparkSession, sf_dir: str) -> str:
    """Write the application table once per Spark application.

    Every later stage reads this table, split by ``split`` and pruned to the
    columns it needs, instead of repeating the joins.
    """
    slot = (spark.sparkContext.applicationId, sf_dir)
    if slot not in _written:
        path = new_path(spark, "applications")
        frame = with_split(
            applications_view(spark, sf_dir),
            BANK_APPLICATIONS.key,
            SETTINGS.test_fraction,
            salt=str(SETTINGS.seed),
        )
        frame.write.option("parquet.block.size", str(ROW_GROUP_BYTES)).partitionBy("split").parquet(path)
        _written[slot] = path
    return _written[slot]


def applications(spark: SparkSession, sf_dir: str, split: str | None = None) -> DataFrame:
    """The written application table, or one split of it (partition pruning)."""
    df = spark.read.parquet(prepared_path(spark, sf_dir))
    return df if split is None else df.where(F.col("split") == split)
