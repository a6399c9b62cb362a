"""Lead rows derived from the customer table, and messages derived from those leads.

The driver's tables hold no leads. ``LEADS_SQL`` derives one lead per customer, with exact copies, typing errors
and changed mail providers, so that every rule and every missing-value text is exercised. The text runs
unchanged in Spark SQL and in the oracle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from leadlake.session import scratch_path

LEADS_SQL = """
SELECT
  CASE WHEN k % 97 = 0 THEN 'None' ELSE concat('lead_', lpad(CAST(k AS STRING), 7, '0')) END AS lead_id,
  CASE WHEN k % 2 = 0 THEN 'apollo' ELSE 'hubspot' END AS source,
  CASE WHEN k % 31 = 0 THEN NULL ELSE concat(' ', upper(substr(fn, 1, 1)), substr(fn, 2)) END AS first_name,
  CASE WHEN k % 10 = 7 THEN substr(ln, 1, 8) ELSE concat(ln, ' ') END AS last_name,
  CASE WHEN k % 53 = 0 THEN NULL
       WHEN k % 59 = 0 THEN 'None'
       WHEN k % 61 = 0 THEN concat(fn, '.at.nowhere')
       WHEN k % 10 = 5 THEN concat(fn, '@gmail.example')
       WHEN k % 10 = 7 THEN concat(substr(fn, 1, 1), ln, '@co', CAST(m AS STRING), '.example')
       WHEN k % 10 = 9 THEN concat('  ', upper(concat(fn, '.', ln)), '@CO', CAST(m AS STRING), '.example ')
       ELSE concat(fn, '.', ln, '@co', CAST(m AS STRING), '.example') END AS email,
  CASE k % 6 WHEN 0 THEN 'CTO' WHEN 1 THEN ' VP of Engineering' WHEN 2 THEN 'Director of Data'
             WHEN 3 THEN 'Data Manager' WHEN 4 THEN 'Senior Engineer' ELSE NULL END AS job_title,
  CASE k % 8 WHEN 0 THEN 'c_suite' WHEN 1 THEN 'VP' WHEN 2 THEN 'director' WHEN 3 THEN 'manager'
             WHEN 4 THEN 'senior' WHEN 5 THEN 'individual' WHEN 6 THEN 'None' ELSE NULL END AS seniority,
  CASE WHEN m % 11 = 10 THEN NULL
       WHEN k % 10 = 5 THEN concat('Company ', CAST(m AS STRING), ', Inc.')
       ELSE concat(' Company ', CAST(m AS STRING), ' Inc') END AS company_name,
  CASE WHEN m % 11 = 10 THEN NULL ELSE concat('CO', CAST(m AS STRING), '.example') END AS company_domain,
  CASE m % 7 WHEN 0 THEN 'Software' WHEN 1 THEN 'saas' WHEN 2 THEN 'fintech' WHEN 3 THEN 'healthcare'
             WHEN 4 THEN 'retail' WHEN 5 THEN 'None' ELSE NULL END AS industry,
  CASE m % 6 WHEN 0 THEN 1500 WHEN 1 THEN 500 WHEN 2 THEN 199 WHEN 3 THEN 10 WHEN 4 THEN 3 ELSE NULL END
    AS employee_count,
  CAST(50 + (k * 7919) % 50 AS DOUBLE) AS apollo_score,
  CASE k % 3 WHEN 0 THEN 'new' WHEN 1 THEN 'contacted' ELSE 'qualified' END AS lead_status,
  concat('2026-06-', lpad(CAST(1 + k % 28 AS STRING), 2, '0'), 'T', lpad(CAST(k % 24 AS STRING), 2, '0'), ':00:00')
    AS ingested_at
FROM (
  SELECT k, m, substr(t, 1, 6) AS fn, substr(t, 7, 9) AS ln FROM (
    SELECT k, b % 50 AS m, translate(md5(CAST(b AS STRING)), '0123456789', 'ghijklmnop') AS t FROM (
      SELECT k, CASE WHEN k % 10 IN (5, 7, 9) THEN k - 1 ELSE k END AS b
      FROM (SELECT CAST(c_custkey AS BIGINT) AS k FROM customer) keys
    ) people
  ) hashed
) named
"""


# Customers that one task derives leads from; a small file of keys becomes many times its size of leads.
CUSTOMERS_PER_TASK = 20_000
# Folder of the landed leads by application and source folder.
_LANDED: dict[tuple[str, str], str] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def leads_from(spark: SparkSession, customers: DataFrame) -> DataFrame:
    """Leads derived from a batch or stream of customers."""
    return spark.sql(LEADS_SQL.replace("FROM customer", "FROM {customer}"), customer=customers)


def leads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw lead table: derived from all customers and landed as Parquet once per session and folder, so that
    queries scan columns and push filters as they would on a real raw layer."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _LANDED:
        path = scratch_path(spark, "raw-leads")
        customers = table(spark, sf_dir, "customer").select("c_custkey")
        tasks = -(-customers.count() // CUSTOMERS_PER_TASK)
        derived = leads_from(spark, customers.repartition(tasks) if tasks > 1 else customers)
        derived.write.parquet(path)
        _LANDED[key] = path
    return spark.read.parquet(_LANDED[key])


def messages(raw: DataFrame, topic: str = "leads") -> DataFrame:
    """Leads as broker messages; partition and offset are derived from the row."""
    value = F.to_json(F.struct(*raw.columns), {"ignoreNullFields": "false"})
    return raw.select(
        F.col("lead_id").cast("binary").alias("key"),
        value.cast("binary").alias("value"),
        F.lit(topic).alias("topic"),
        F.pmod(F.hash("lead_id"), F.lit(4)).alias("partition"),
        F.xxhash64(value).alias("offset"),
        F.to_timestamp("ingested_at").alias("timestamp"),
    )
