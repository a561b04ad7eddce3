"""Identity expressions: padding, batch ids, paths, hashes, canonical JSON."""

import hashlib

from pyspark.sql import functions as F

from factlake.functions import keys as K


def one(spark, col):
    return spark.range(1).select(col.alias("x")).first()["x"]


def test_batch_id_reproduces_published_sample(spark):
    assert one(spark, K.batch_id(F.lit("filing_index"), F.lit("2026-07-29"))) == "filing_index-20260729-eb4807cfccc9"


def test_batch_id_is_sha_of_stream_and_date(spark):
    h = hashlib.sha256(b"company_concept|2024-02-29").hexdigest()[:12]
    assert one(spark, K.batch_id(F.lit("company_concept"), F.lit("2024-02-29"))) == f"company_concept-20240229-{h}"


def test_pad_cik_pads_and_never_truncates(spark):
    rows = spark.createDataFrame([("320193",), ("0000320193",), ("12345678901",), (" 42 ",)], "c string")
    got = [r.p for r in rows.select(K.pad_cik("c").alias("p")).collect()]
    assert got == ["0000320193", "0000320193", "12345678901", "0000000042"]


def test_pad_cik_accepts_numbers(spark):
    assert one(spark, K.pad_cik(F.lit(320193))) == "0000320193"


def test_landing_path_and_reroot(spark):
    p = one(spark, K.landing_path(F.lit("s3://raw/"), F.lit("filing_index"), F.lit("2026-07-29")))
    assert p == "s3://raw/edgar/filing_index/logical_date=2026-07-29/filing_index-20260729-eb4807cfccc9.json.gz"
    assert one(spark, K.reroot(F.lit(p), "s3://raw")) == \
        "/edgar/filing_index/logical_date=2026-07-29/filing_index-20260729-eb4807cfccc9.json.gz"


def test_daily_index_url_quarter(spark):
    assert one(spark, K.daily_index_url(F.lit("2026-07-29"))) == \
        "https://www.sec.gov/Archives/edgar/daily-index/2026/QTR3/form.20260729.idx"
    assert one(spark, K.daily_index_url(F.lit("2026-01-02"))).endswith("/2026/QTR1/form.20260102.idx")


def test_concept_and_submissions_urls(spark):
    assert one(spark, K.submissions_url(F.lit("320193"))) == "https://data.sec.gov/submissions/CIK0000320193.json"
    assert one(spark, K.concept_url(F.lit(320193), F.lit("Assets"))) == \
        "https://data.sec.gov/api/xbrl/companyconcept/CIK0000320193/us-gaap/Assets.json"


def test_hash_diff_ignores_array_order_and_keeps_nulls_distinct(spark):
    df = spark.createDataFrame(
        [("a", ["x", "y"]), ("a", ["y", "x"]), (None, ["x", "y"]), ("", ["x", "y"])], "n string, t array<string>")
    hs = [r.h for r in df.select(K.hash_diff("n", "t", arrays=("t",)).alias("h")).collect()]
    assert hs[0] == hs[1]
    assert hs[0] != hs[2]
    assert hs[0] == hashlib.sha256(b"a|x,y").hexdigest()


def test_canonical_json_sorted_tight_with_nulls(spark):
    s = K.canonical_json(K.sorted_struct(b=F.lit(1), a=F.lit("x"), c=F.lit(None).cast("string")))
    assert one(spark, s) == '{"a":"x","b":1,"c":null}'


def test_canonicalize_document_sorts_keys(spark):
    assert one(spark, K.canonicalize_document(F.lit('{"b": 1, "a": {"d": 2, "c": 3}}'))) == '{"a":{"c":3,"d":2},"b":1}'


def test_content_hash(spark):
    assert one(spark, K.content_hash(F.lit("a"))) == hashlib.sha256(b"a").hexdigest()


def test_accession_from_path(spark):
    assert one(spark, K.accession_from_path(F.lit("edgar/data/1/0001096906-26-001138.txt"))) == "0001096906-26-001138"
    assert one(spark, K.accession_from_path(F.lit("edgar/data/1/x.txt"))) is None
