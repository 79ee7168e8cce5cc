import datetime

from tallyloom.sources.access_log import STRICT_PATTERN, access_records, parse_access_log
from tallyloom.sources.quality import FAILED, log_quality, record_quality, status_counts, status_sample
from tallyloom.sources.ratings import parse_items, parse_ratings
from tallyloom.sources.records import parse_gold, parse_products

# Fixed value: the sample line.
LINE = '127.0.0.1 - - [01/Aug/1995:00:00:01 -0400] "GET /images/launch-logo.gif HTTP/1.0" 200 1839'
DASH = '10.1.2.3 - - [05/Sep/2003:10:20:30 +0100] "GET /a HTTP/1.0" 304 -'
BLANK = '10.1.2.3 - - [05/Sep/2003:10:20:30 +0100] "GET /a HTTP/1.0 " 200 5 trailing text'
NO_PROTOCOL = '10.1.2.3 - - [05/Sep/2003:10:20:30 +0100] "GET /a" 200 5'
BAD_ZONE = '10.1.2.3 - - [05/Sep/2003:10:20:30 0100] "GET /a HTTP/1.0" 200 5'
BAD_DATE = '10.1.2.3 - - [31/Feb/2003:10:20:30 +0100] "GET /a HTTP/1.0" 200 5'
BAD_MONTH = '10.1.2.3 - - [05/Abc/2003:10:20:30 +0100] "GET /a HTTP/1.0" 200 5'
BAD_SIZE = '10.1.2.3 - - [05/Sep/2003:10:20:30 +0100] "GET /a HTTP/1.0" 200 5x'


def parsed(spark, *lines, **options):
    return parse_access_log(spark.createDataFrame([(line,) for line in lines], "line string"), **options)


def test_log_line(spark):
    row = parsed(spark, LINE).first()
    assert row.parse_status == 1
    assert (row.host, row.client_identd, row.user_id) == ("127.0.0.1", "-", "-")
    assert row.date_time == datetime.datetime(1995, 8, 1, 0, 0, 1)
    assert (row.method, row.endpoint, row.protocol) == ("GET", "/images/launch-logo.gif", "HTTP/1.0")
    assert (row.response_code, row.content_size) == (200, 1839)
    assert dict(parsed(spark, LINE).dtypes)["date_time"] == "timestamp_ntz"


def test_zone_of_the_session_does_not_matter(spark):
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        gap = LINE.replace("01/Aug/1995:00:00:01", "26/Mar/2023:02:30:00")
        assert parsed(spark, gap).first().date_time == datetime.datetime(2023, 3, 26, 2, 30)
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_log_variants(spark):
    assert parsed(spark, DASH).first().content_size == 0
    assert parsed(spark, BLANK).first().parse_status == 1
    assert parsed(spark, BLANK, pattern=STRICT_PATTERN).first().parse_status == 0
    row = parsed(spark, NO_PROTOCOL).first()
    assert (row.parse_status, row.protocol) == (1, "")


def test_unusable_lines_are_counted_not_fatal(spark):
    df = parsed(spark, LINE, BAD_ZONE, BAD_DATE, BAD_MONTH, BAD_SIZE, "", "x y z")
    report = log_quality(df).first()
    assert (report.lines, report.parsed, report.failed) == (7, 1, 6)
    assert all(r.host is None and r.line is not None for r in df.filter("parse_status = 0").collect())
    assert [r.line for r in status_sample(df, FAILED, 2, "line").collect()] == ["", BAD_MONTH]
    assert {(r.parse_status, r.n) for r in status_counts(df).collect()} == {(0, 6), (1, 1)}
    records = access_records(spark.createDataFrame([(LINE,), (BAD_DATE,)], "line string"))
    assert records.count() == 1 and "line" not in records.columns


def test_products(spark):
    lines = [
        '"id","title","description","manufacturer","price"',
        '"b1","paint box 9","brushes, many","acme",9.99',
        '"b2","say ""hi""",,,',
        "not a record",
    ]
    df = parse_products(spark.createDataFrame([(line,) for line in lines], "line string"))
    rows = {r.line: r for r in df.collect()}
    assert [rows[line].parse_status for line in lines] == [0, 1, 1, -1]
    assert rows[lines[1]].id == "b1"
    assert rows[lines[2]].text == 'say ""hi""  '
    report = record_quality(df).first()
    assert (report.lines, report.parsed, report.header, report.invalid) == (4, 2, 1, 1)


def test_product_dot_crosses_carriage_returns(spark):
    df = parse_products(spark.createDataFrame([('"p","a\rb",c,d,e',)], "line string"))
    assert df.first().text == "a\rb c d"


def test_gold(spark):
    lines = ['"idAmazon","idGoogleBase"', '"b1","http://x/1"', "nothing"]
    rows = {r.line: r for r in parse_gold(spark.createDataFrame([(x,) for x in lines], "line string")).collect()}
    assert [rows[line].parse_status for line in lines] == [0, 1, -1]
    assert (rows[lines[1]].a_id, rows[lines[1]].b_id) == ("b1", "http://x/1")


def test_ratings_and_items(spark):
    lines = spark.createDataFrame([("1::77::5::900000000",), ("1::x::5::0",), ("1",)], "line string")
    rows = parse_ratings(lines).collect()
    assert (rows[0].user_id, rows[0].item_id, rows[0].rating, rows[0].parse_status) == (1, 77, 5.0, 1)
    assert [r.parse_status for r in rows] == [1, 0, 0]
    items = spark.createDataFrame([("1::Blue Harbour (1991)::Drama|Comedy",)], "line string")
    assert parse_items(items).first().title == "Blue Harbour (1991)"


def test_a_value_with_a_line_feed_is_no_line(spark):
    lines = spark.createDataFrame([("a\nb",), ('"a","b"',), ("a",)], "line string")
    assert sorted(r.parse_status for r in parse_gold(lines).collect()) == [-1, -1, 1]
    assert parsed(spark, LINE + "\nx").first().parse_status == 0


def test_ids_beyond_32_bits(spark):
    row = parse_ratings(spark.createDataFrame([(f"{2**31 + 1}::{2**40}::3.5::0",)], "line string")).first()
    assert (row.parse_status, row.user_id, row.item_id, row.rating) == (1, 2**31 + 1, 2**40, 3.5)
    assert parse_items(spark.createDataFrame([(f"{2**31 + 1}::t::g",)], "line string")).first().item_id == 2**31 + 1
