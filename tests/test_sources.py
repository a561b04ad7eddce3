"""Sources: fixed-width daily index, universe files, completed-work lines, envelopes."""

import json
import os

import pytest
from pyspark.sql import functions as F

from factlake.session import to_local_path
from factlake.sources import fixed_width as FW
from factlake.sources import landing as src
from factlake.sources.universe import UniverseFormatError, read_universe

HEADER = [
    "Description:           Daily Index of EDGAR Dissemination Feed by Form Type",
    "Last Data Received:    July 29, 2026",
    "Comments:              webmaster@sec.gov",
    "Anonymous FTP:         ftp://ftp.sec.gov/edgar/",
    "",
    "",
    "",
    "Form Type   Company Name                                                  CIK",
    "          Date Filed  File Name",
    "-" * 120,
]


def row(form, company, cik, date="20260729", fname=None):
    fname = fname or f"edgar/data/{cik}/0001096906-26-{int(cik) % 1000000:06d}.txt"
    return f"{form:<17}{company:<62}{cik:<12}{date:<12}{fname}"


ROWS = [
    row("1-SA", "Hartley Opportunity Fund LLC", "2056463", fname="edgar/data/2056463/0001096906-26-001138.txt"),
    row("DEF 14A", "ACME CORP", "12345"),
    row("SCHEDULE 13G", "B" * 60, "777"),
    row("10-K", "Co-registrant One", "1001", fname="edgar/data/1001/0001104659-26-088252.txt"),
    row("10-K", "Co-registrant Two", "1002", fname="edgar/data/1002/0001104659-26-088252.txt"),
    row("SEC STAFF ACTIO", "Someone", "5"),
]


def write_files(root, files):
    for name, lines in files.items():
        os.makedirs(to_local_path(root), exist_ok=True)
        with open(os.path.join(to_local_path(root), name), "w", newline="") as fh:
            fh.write(lines)


def parse(spark, root):
    v = FW.validate_files(FW.read_index_files(spark, root))
    rep = {os.path.basename(r.file): r for r in FW.file_report(v).collect()}
    rows = FW.parse_valid(v).collect()
    return rep, rows


def test_fixed_width_good_and_adversarial_files(spark, tmp_root):
    nl = "\n"
    files = {
        "good.idx": nl.join(HEADER + ROWS) + nl + nl + "   " + nl,
        "crlf.idx": "\r\n".join(HEADER + ROWS) + "\r\n",
        "noseparator.idx": nl.join(HEADER[:-1] + ROWS),
        "badheader.idx": nl.join(["Description: x", "Form Type   Ticker   Company Name   CIK", "-" * 50,
                                  ROWS[0]]),
        "shifted.idx": nl.join(HEADER + [" " * 12 + r for r in ROWS]),
        "noaccession.idx": nl.join(HEADER + [ROWS[0], row("10-K", "X", "9", fname="edgar/data/9/x.txt")]),
        "onechar.idx": nl.join(HEADER + [" " + r for r in ROWS]),
    }
    write_files(tmp_root, files)
    rep, rows = parse(spark, tmp_root)
    assert rep["good.idx"].reason == "ok" and rep["good.idx"].row_count == len(ROWS)
    assert rep["good.idx"].separator_line == len(HEADER)
    assert rep["crlf.idx"].reason == "ok"
    assert rep["noseparator.idx"].reason == "no_separator"
    assert rep["badheader.idx"].reason == "header_mismatch"
    assert rep["shifted.idx"].reason == "cik_not_numeric"
    assert rep["shifted.idx"].first_bad_line == len(HEADER) + 1
    assert rep["noaccession.idx"].reason == "file_name_without_accession"
    assert rep["noaccession.idx"].first_bad_line == len(HEADER) + 2
    assert rep["onechar.idx"].reason == "ok"  # padding absorbs a one-character shift
    good = [r for r in rows if r.file.endswith("good.idx")]
    assert len(good) == len(ROWS)
    first = min(good, key=lambda r: r.line_number)
    assert (first.form_type, first.company_name, first.cik, first.date_filed) == \
        ("1-SA", "Hartley Opportunity Fund LLC", "2056463", "20260729")
    assert first.accession_number == "0001096906-26-001138"
    assert {r.form_type for r in good} >= {"DEF 14A", "SCHEDULE 13G", "SEC STAFF ACTIO"}
    assert max(len(r.company_name) for r in good) == 60
    assert len({r.accession_number for r in good}) == len(ROWS) - 1  # shared accession
    assert all(r.file.endswith(("good.idx", "crlf.idx", "onechar.idx")) for r in rows)


def test_universe_mixed_forms(spark, tmp_root):
    doc = [{"cik": "320193", "ticker": "A"}, {"cik": 789019}, "0000320193", 1018724, "  42 "]
    write_files(tmp_root, {"u.json": json.dumps(doc)})
    got = [r.cik for r in read_universe(spark, tmp_root).orderBy("cik").collect()]
    assert got == ["0000000042", "0000320193", "0000789019", "0001018724"]
    assert [r.cik for r in read_universe(spark, tmp_root, limit=2).collect()] == ["0000000042", "0000320193"]


def test_universe_not_a_list_is_an_error(spark, tmp_root):
    write_files(tmp_root, {"u.json": json.dumps({"cik": "1"})})
    with pytest.raises(UniverseFormatError):
        read_universe(spark, tmp_root)


def test_completed_pairs_skip_blank_and_truncated(spark, tmp_root):
    lines = [json.dumps({"cik": "320193", "concept": "Assets", "envelope": {"a": 1}}), "",
             json.dumps({"cik": "0000320193", "concept": "Revenues", "envelope": None}), "   ",
             '{"cik": "0000789019", "concept": "Ass']
    write_files(tmp_root, {"done.jsonl": "\n".join(lines)})
    got = {(r.cik, r.concept, r.envelope is not None)
           for r in src.read_completed_pairs(spark, tmp_root).collect()}
    assert got == {("0000320193", "Assets", True), ("0000320193", "Revenues", False)}


def test_last_line_of_a_pair_wins(spark, tmp_root):
    line = lambda c, e: json.dumps({"cik": c, "concept": "Assets", "envelope": e})
    write_files(tmp_root, {"a.jsonl": "\n".join([line(1, {"v": 1}), line(2, None), line(1, {"v": 2})]), "b.jsonl": line(2, {"v": 3}) + "\n" + line(3, {"v": 4}) + "\n" + line(3, None)})
    got = {r.cik: r.envelope for r in src.read_completed_pairs(spark, tmp_root).collect()}
    assert got == {"0000000001": '{"v": 2}', "0000000002": '{"v": 3}', "0000000003": None}


def test_envelope_line_validation(spark):
    from factlake import contracts as C
    good = {f: "x" for f in C.ENVELOPE_FIELDS}
    good["http_status"] = 200
    bad_status = dict(good, http_status="200")
    missing = {k: v for k, v in good.items() if k != "payload_json"}
    private = dict(good, _ingest_ts="t")
    nulled = dict(good, resource_id=None)
    lines = [json.dumps(x) for x in (good, bad_status, missing, private, nulled)] + ['{"envelope_version": "1"']
    df = spark.createDataFrame([(x,) for x in lines], "value string")
    got = [r.invalid_reason for r in src.validate_lines(df).collect()]
    assert got == [None, "http_status_not_int", "missing:payload_json", "private_key:_ingest_ts",
                   "null:resource_id", "unparseable"]


def test_strict_mode_raises_on_a_bad_file(spark, tmp_root):
    write_files(tmp_root, {"good.idx": "\n".join(HEADER + ROWS),
                           "shifted.idx": "\n".join(HEADER + [" " * 12 + r for r in ROWS])})
    v = FW.validate_files(FW.read_index_files(spark, tmp_root))
    with pytest.raises(FW.IndexFormatError, match="shifted.idx: cik_not_numeric at line 11"):
        FW.require_valid(v)
    FW.require_valid(v.where(F.col("file").endswith("good.idx")))
