import gzip
import os
import tempfile

from pyspark.sql import functions as F

from quarry.plans import logs
from quarry.sources.readers import read_log_text

LINES = [
    'h.de - - [01/Jul/1995:00:00:01 -0400] "GET /x HTTP/1.0" 200 6245',
    'h.de - - [01/Jul/1995:00:00:01 -0400] "GET /x HTTP/1.0" 200 -',
    'a.ca - - [02/Jul/1995:23:10:00 -0400] "GET /nover" 404 12',
    'b.sg - - [03/Jul/1995:12:00:00 -0400] "GET /a b c HTTP/1.0" 200 5',
    'c.com - - [04/Jul/1995:01:02:03 -0400] "GET /q"uote HTTP/1.0" 200 7',
    'bad',
    '',
    '192.168.0.1 - - [05/Jul/1995:05:06:07 -0400] "POST /p HTTP/1.0" 500 0',
    'H.DE - - [06/Jul/1995:06:00:00 -0400] "GET / HTTP/1.0" 304 0',
]


def _parsed(spark):
    df = spark.createDataFrame([(x,) for x in LINES], "value string")
    return logs.tag_country(logs.parse_access_log(df))


def test_parse_fields_and_null_size(spark):
    rows = _parsed(spark).collect()
    first, dash = rows[0], rows[1]
    assert first.host == "h.de" and first.status == 200 and first.size == 6245
    assert str(first.ts) == "1995-07-01 00:00:01" and first.tz_offset == "-0400"
    assert first.request == "GET /x HTTP/1.0"
    assert dash.size is None and not dash.malformed


def test_request_shapes_do_not_shift_status(spark):
    rows = _parsed(spark).collect()
    assert (rows[2].status, rows[2].size, rows[2].request) == (404, 12, "GET /nover")
    assert (rows[3].status, rows[3].size) == (200, 5)
    assert rows[4].request == 'GET /q"uote HTTP/1.0' and rows[4].size == 7


def test_rejects_kept_and_flagged(spark):
    rows = _parsed(spark).collect()
    assert rows[5].malformed and rows[5].host is None and rows[5].status is None
    assert rows[6].malformed
    assert sum(r.malformed for r in rows) == 2


def test_suffix_rule(spark):
    rows = _parsed(spark).collect()
    assert [r.host_cntry for r in rows] == [
        "Germany", "Germany", "Canada", "Singapore", "Other", "Other", "Other", "Other",
        "Germany"]


def test_gzip_text_source(spark):
    d = tempfile.mkdtemp(prefix="quarry-log-")
    path = os.path.join(d, "access.gz")
    with gzip.open(path, "wt") as fh:
        fh.write("\n".join(LINES[:3]) + "\n")
    df = read_log_text(spark, path, partitions=3)
    assert df.rdd.getNumPartitions() == 3
    parsed = logs.parse_access_log(df, keep_malformed=False)
    assert parsed.count() == 3


def test_requests_and_unique_hosts(spark):
    p = _parsed(spark).filter(~F.col("malformed"))
    counts = {r.host_cntry: r.n_requests for r in logs.requests_per_group(
        p, "host_cntry", logs.COUNTRIES_OF_INTEREST).collect()}
    assert counts == {"Germany": 3, "Canada": 1, "Singapore": 1}
    uniq = {r.host_cntry: r.n_unique for r in logs.unique_items_per_group(
        p, "host_cntry", "host").collect()}
    assert uniq["Germany"] == 2


def test_control_characters_and_line_ends_do_not_break_the_parse(spark):
    lines = ['h.de - - [01/Jul/1995:00:00:01 -0400] "GET /a\x01b\x02 c" 200 1',
             '\x02h.ca - - [01/Jul/1995:00:00:01 -0400] "GET /x" 200 2\r',
             '\nh.de 01 Jul 1995 00 00 01 -0400 200 7 GET /x', 'h.de 01 Jul 1995 00 00 01 -0400 200 7 GET /x',
             'h.de - - [01/Jul/1995:00:00:01 -0400] "" 200 3\n', None]
    rows = logs.parse_access_log(spark.createDataFrame([(x,) for x in lines], "value string")).collect()
    assert [r.malformed for r in rows] == [False, False, True, True, False, True]
    assert rows[0].request == "GET /a\x01b\x02 c" and rows[0].size == 1
    assert rows[1].host == "\x02h.ca" and rows[1].size == 2
    assert rows[4].request == "" and rows[4].size == 3
