"""Source queries: fixed-width index files written from the driver's tables and read back."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from factlake.plans import landed_inputs as L
from factlake.plans import oracle as O
from factlake.plans.registry import register
from factlake.sources import fixed_width as FW

CN = """SELECT c.*, n.n_regionkey FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey"""
BODY = f"""SELECT c_nationkey AS nation, c_custkey, c_acctbal, n_regionkey,
                  {L.HEADER_LINES} + row_number() OVER (PARTITION BY c_nationkey ORDER BY c_custkey) AS line_number,
                  c_mktsegment AS form_type, c_name AS company_name, CAST(c_custkey AS VARCHAR) AS cik,
                  strftime(DATE '2026-07-01' + CAST(c_custkey % 28 AS INTEGER), '%Y%m%d') AS date_filed,
                  printf('edgar/data/%d/%s.txt', c_custkey, printf('%010d-26-%06d', c_custkey, c_nationkey)) AS file_name,
                  printf('%010d-26-%06d', c_custkey, c_nationkey) AS accession_number
           FROM cn"""
FILES = f"""SELECT n.n_nationkey AS nation, n.n_regionkey,
                   (SELECT min(line_number) FROM body b WHERE b.nation = n.n_nationkey AND b.n_regionkey = 1
                      AND b.c_acctbal < 0) AS first_bad_line,
                   (SELECT count(*) FROM body b WHERE b.nation = n.n_nationkey) AS n_rows
            FROM nation n"""
VERDICT = """SELECT nation, n_regionkey, first_bad_line, n_rows,
                    CASE WHEN n_regionkey = 2 THEN 'no_separator' WHEN n_regionkey = 0 THEN 'header_mismatch'
                         WHEN first_bad_line IS NOT NULL THEN 'cik_not_numeric' ELSE 'ok' END AS reason
             FROM files"""


@register("fixed_width_scan", O.with_ctes(
    """SELECT CAST(b.nation AS BIGINT) AS nation, CAST(b.line_number AS BIGINT) AS line_number, form_type,
              company_name, cik, date_filed, file_name, accession_number
       FROM body b JOIN verdict v ON b.nation = v.nation WHERE v.reason = 'ok'""",
    cn=CN, body=BODY, files=FILES, verdict=VERDICT))
def fixed_width_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of the valid daily index files (padding stripped, fields verbatim)."""
    files = FW.read_index_files(spark, L.write_index_files(spark, sf_dir))
    return FW.parse_valid(FW.validate_files(files), keep=("nation",)).drop("file")


@register("layout_check", O.with_ctes(
    f"""SELECT CAST(nation AS BIGINT) AS nation, reason = 'ok' AS is_valid, reason,
              CASE WHEN reason = 'no_separator' THEN NULL ELSE CAST({L.HEADER_LINES} AS BIGINT) END AS separator_line,
              CAST(first_bad_line AS BIGINT) AS first_bad_line,
              CASE WHEN reason = 'ok' THEN n_rows ELSE 0 END AS row_count
       FROM verdict""",
    cn=CN, body=BODY, files=FILES, verdict=VERDICT))
def layout_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per file: verdict, separator line, first bad line; one bad row voids the file."""
    files = FW.read_index_files(spark, L.write_index_files(spark, sf_dir))
    return FW.file_report(FW.validate_files(files), keep=("nation",)).drop("file")
