from __future__ import annotations

import re
from datetime import datetime

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from fleetquarry.functions import codes, numbers, text, times, versions


def test_index_of(column):
    assert column(text.index_of("b", "v"), "abcb", "x", None, "") == [2, 0, None, 0]
    assert column(text.index_of("b", "v", 3), "abcb") == [4]
    assert column(text.index_of("b", "v", 0), "abcb") == [2]  # a start below 1 is 1
    assert column(text.index_of("", "v"), "abc", None) == [0, None]
    assert column(text.index_of(F.col("v"), F.lit("xabc")), "abc", "", None) == [2, 0, None]


def test_cuts(column):
    assert column(text.before_first("v", ","), "a,b,c", "abc", "", None, ",a") == ["a", "abc", "", None, ""]
    assert column(text.after_first("v", ".", F.lit("None")), "a.b.c", "abc", None, "a.") == ["b.c", "None", None, ""]
    assert column(text.after_last("v", "/"), "a/b", "ab", None) == ["b", "ab", None]
    assert column(text.strip_prefix("v", ":"), "::ffff:1.2", "1.2") == ["1.2", "1.2"]
    assert column(text.strip_prefix("v"), "::ffff:1.2") == ["::ffff:1.2"]
    assert column(text.leading("v", F.locate("-", "v") - 1), "abc-d", "abc", "-x") == ["abc", None, ""]
    assert column(text.second_segment("v"), "a.b.c", "a.b", "a", "a..c", None) == ["b", "", None, "", None]
    assert column(text.split_pick("v", "|", 1), "a|b|c", "a", None) == ["b", None, None]
    assert column(text.path_leaf("v"), "http://x/y.cab", "C:\\a\\b.txt", "z") == ["y.cab", "b.txt", "z"]
    assert column(text.unc_share("v"), "\\\\*\\Data", "\\\\*", None) == ["Data", "", None]


def test_quoted_path(column):
    found = column(text.quoted_path("v"), '"C:\\a b\\s.exe" -sX', '"C:\\s.exe"', None)
    assert found == ["C:\\a b\\s.exe", None, None]


def test_digit_span(column):
    captions = ["Server 2012 R2 Standard", "Windows 7", "none", None, "7.5 (x)"]
    assert column(text.digit_span("v"), *captions) == ["2012", "7", "", None, "7.5"]


def test_composition(column):
    assert column(text.remove_all("v", [".x86_64", ".rpm"]), "a.x86_64.rpm", None) == ["a", None]
    assert column(text.dotted_host(F.lit("PC"), "v"), "CORP.Net", None) == ["PC.corp.net", "PC"]
    assert column(text.account(F.lit("D"), "v"), "u", None) == ["D\\u", None]
    assert column(text.trustee(F.col("v"), F.lit("n")), "D", None) == ["D\\n", "n"]
    assert column(text.trustee(F.lit("D"), "v"), "n", None) == ["D\\n", "NOT_RESOLVED"]
    assert column(text.cpu_text("v", F.lit(4)), "AMD x", "Xeon @ 2.40GHz", "Other CPU") == [
        "AMD (Cores:4)",
        "2.40GHz (Cores:4)",
        "ther CP (Cores:4)",  # without the sign the cut starts at the second character
    ]
    assert column(text.instance_name("v", codes.DEFAULT_INSTANCE), "SQL Server (MSSQLSERVER)", "SQL Server (A)") == [
        "Default",
        "A",
    ]
    assert column(text.short_build("v"), "10.05.1 (x)", "1(2)", "3.0.1", None) == ["10.5.1", None, "3.0.1", None]
    assert column(text.xml_escape("v"), "<a&b>") == ["&lt;a&amp;b&gt;"]
    assert column(text.is_device_id("v"), 16777216, 123, kind="bigint") == [True, False]


def test_patterns(column):
    paths = ["C:\\MSSQL10_50", "C:\\MSSQL10x50", "a%b!c", None]
    assert column(text.like_pattern("v", "%\\MSSQL10_50"), *paths) == [True, True, False, None]
    assert column(text.like_pattern("v", "%!c"), *paths) == [False, False, True, None]
    assert column(text.like_pattern("v", "%[xy]50"), *paths) == [False, True, False, None]
    assert column(text.like_pattern("v", "c:%", ignore_case=True), *paths) == [True, True, False, None]
    assert column(text.contains_pattern("v", "SSQL"), *paths) == [True, True, False, None]
    assert column(text.glob_match("v", "*-??.cab"), "x-DE.CAB", "x-deu.cab", "x-de.cab.txt") == [True, False, False]
    assert column(text.glob_any("v", ["a*", "*Z"]), "Abc", "xyz", "b") == [True, True, False]


def test_versions(column):
    given_ = ["1.2.3", "10.0.0.1", "007.0.10", "1.12345678", "1..2", "1.2.3.4.5", None, ""]
    assert column(versions.version_sort_key("v"), *given_) == [
        "0000001.0000002.0000003",
        "0000010.0000000.0000000.0000001",
        "0000007.0000000.0000010",
        "0000001.12345678",
        None,
        None,
        None,
        None,
    ]
    assert column(versions.version_strip_zeros("v"), *given_) == [
        "1.2.3", "10.0.0.1", "7.0.10", "1.12345678", None, None, None, None,
    ]
    assert column(versions.version_sort_key("v", max_parts=None), "1.2.3.4.5")[0].count(".") == 4
    files = ["http://x/Reader1900820071_MUI.msp", "readme.txt", None]
    assert column(versions.version_from_file("v"), *files) == ["19.008.20071", None, None]


def test_versions_in_sql(spark):
    versions.register_sql_functions(spark)
    got = spark.sql("SELECT version_sort_key('1.20'), version_strip_zeros('01.000'), version_sort_key('1.')")
    assert tuple(got.first()) == ("0000001.0000020", "1.0", None)


@settings(max_examples=20, deadline=None)
@given(st.lists(st.lists(st.integers(0, 9_999_999), min_size=4, max_size=4), min_size=2, max_size=20))
def test_version_key_order_is_version_order(spark, parts):
    texts = [".".join(map(str, p)) for p in parts]
    df = spark.createDataFrame([(t,) for t in texts], "v string")
    got = [r.v for r in df.orderBy(versions.version_sort_key("v"), "v").collect()]
    assert got == sorted(texts, key=lambda t: [int(x) for x in t.split(".")])
    stripped = df.select(
        versions.version_strip_zeros(versions.version_sort_key("v")).alias("a"),
        versions.version_strip_zeros("v").alias("b"),
    ).collect()
    assert all(r.a == r.b for r in stripped)


def test_numbers(column):
    assert column(numbers.ceil_text("v"), 512000, 1, 0, None, kind="bigint") == ["500GB", "1GB", "0GB", None]
    assert column(numbers.one_decimal("v"), 0.25, 1234.56, None, kind="double") == ["0.3", "1,234.6", None]
    assert column(numbers.percent_text("v", F.lit(0)), 1, kind="int") == [None]
    assert column(numbers.percent_text("v", F.lit(3)), 1, kind="int") == ["33.3%"]
    assert column(numbers.megabytes("v"), 1048576, 13107, kind="bigint") == [1.0, 0.01]
    assert column(numbers.mask_names("v", {1: "r", 2: "w", 3: "rw"}), 3, 1, 0, kind="bigint") == ["r, w, rw", "r", ""]
    assert column(numbers.mbit("v"), 131072.0, kind="double") == [1.0]


def test_disk_space(spark):
    row = spark.range(1).select(*numbers.disk_space(F.lit(100 * 1024**3), F.lit(25 * 1024**3))).first()
    assert row.asDict() == {
        "size_gb": "100.0",
        "free_space_gb": "25.0",
        "free_space": "26,843,545,600.0",
        "percent_free": "25.0%",
    }


@pytest.mark.parametrize(
    "written, want",
    [
        ("25.12.2019 10:30", datetime(2019, 12, 25, 10, 30)),
        ("19.12.25 10:30", datetime(2019, 12, 25, 10, 30)),
        ("55.01.02 03:04", datetime(1955, 1, 2, 3, 4)),
        ("12/25/2019 10:30:00", datetime(2019, 12, 25, 10, 30)),
        ("1/5/2020 3:04:05 PM", datetime(2020, 1, 5, 15, 4, 5)),
        ("12/25/2019 12:00:00 AM", datetime(2019, 12, 25)),
        ("12/25/2019 12:07 PM", datetime(2019, 12, 25, 12, 7)),
        ("25-12-2019 10:30:05", datetime(2019, 12, 25, 10, 30, 5)),
        ("25.12.2019", datetime(2019, 12, 25)),
        ("1.2.2019 1:02:03.5", datetime(2019, 2, 1, 1, 2, 3, 500000)),
        ("31.02.2019 10:00", None),
        ("13/13/2019", None),
        ("25.12.2019 25:00", None),
        ("2019-12-25 10:30", None),
        ("2019.12.25 10:30", None),
        ("25.12.2019 noon", None),
        ("bad", None),
        ("", None),
        (None, None),
    ],
)
def test_parse_mixed(column, written, want):
    assert column(times.parse_mixed("v"), written) == [want]


def test_other_times(column):
    assert column(times.parse_compact_day("v"), "20200229000000", "20210229", "x", None) == [
        datetime(2020, 2, 29), None, None, None,
    ]
    assert column(times.parse_iso_day("v"), "2020-02-29 08:00", "2020-13-01", None) == [datetime(2020, 2, 29), None, None]
    at = datetime(2020, 1, 1, 22, 15, 7)
    assert column(times.shift_hours("v"), at, kind="timestamp_ntz") == [datetime(2020, 1, 2, 1, 15, 7)]
    assert column(times.day_of("v"), at, kind="timestamp_ntz") == [datetime(2020, 1, 1)]
    assert column(times.hour_of("v"), at, kind="timestamp_ntz") == [datetime(2020, 1, 1, 22)]
    assert column(times.second_text("v"), at, kind="timestamp_ntz") == ["01.01.2020 22:15:07"]
    assert column(times.minute_text("v"), at, kind="timestamp_ntz") == ["01.01.2020 22:15"]
    day = datetime(2020, 1, 1)
    edges = [day, datetime(2020, 1, 1, 0, 0, 1), datetime(2020, 1, 1, 23, 59, 59), datetime(2020, 1, 2), None]
    # both ends are open
    assert column(times.on_day("v", day), *edges, kind="timestamp_ntz") == [False, True, True, False, None]


def test_times_do_not_depend_on_the_session_zone(spark, column):
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        # this hour does not exist there
        for written in ("10.03.2024 02:30:00", "3/10/2024 2:30:00 AM", "03/10/2024 02:30"):
            parsed = times.parse_mixed("v")
            assert column(times.second_text(parsed), written) == ["10.03.2024 02:30:00"]
            assert column(times.minute_text(times.hour_of(parsed)), written) == ["10.03.2024 02:00"]
            assert column(times.second_text(times.shift_hours(parsed)), written) == ["10.03.2024 05:30:00"]
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_enforcement_message(spark):
    df = spark.createDataFrame(
        [(1000, 0), (1000, 2), (7777, 2), (7777, 0), (None, 0), (None, 2), (5010, None)], "s int, o int"
    )
    got = [r[0] for r in df.select(codes.enforcement_message("s", "o")).collect()]
    assert got == [
        "Success",
        "Success",
        "Available for Install",
        None,  # an unlisted state of another offer has no message
        "Unknown",
        "Available for Install",
        "Failed to updating App-V Virtual Environment",
    ]
    assert len(codes.ENFORCEMENT_STATES) == 38


def test_compliance_text(spark):
    df = spark.createDataFrame(
        [(0, 0, 1), (1, 0, 1), (1, 1, 1), (1, 1, 4), (1, 1, 2), (1, 1, 5), (1, 1, 9), (None, None, None)],
        "a int, d int, s int",
    )
    plain = codes.compliance_text("a", "d", "s")
    valued = codes.compliance_text("a", "d", "s", F.lit("42"))
    assert [tuple(r) for r in df.select(plain, valued).collect()] == [
        ("Not Applicable",) * 2,
        ("Not Detected",) * 2,
        ("Compliant",) * 2,
        ("Compliant",) * 2,
        ("Non Compliant", "42"),
        ("Status 5",) * 2,
        ("Unknown",) * 2,
        ("Unknown",) * 2,
    ]


def test_names(column):
    assert column(codes.principal("v"), "Все", "BUILTIN\\Пользователи", "x", None) == [
        "Everyone", "BUILTIN\\Users", "x", None,
    ]
    messages = ["A network share object was added. ", "Объект сетевой папки изменен.", "other", None]
    assert column(codes.share_event_type("v", codes.SHARE_DIGEST_LABELS), *messages) == ["Add", "Modify", "other", None]
    assert column(codes.product_line("v"), "C:\\MSSQL10_50.A", "C:\\MSSQL10.A", "C:\\MSSQL99", "MSSQL11", None) == [
        "SQL Server 2008 R2", "SQL Server 2008", "Unknown", "Unknown", "Unknown",
    ]
    assert column(codes.member_type("v"), 5, 4, 3, None, kind="int") == ["Device", "User", "unknown", "unknown"]
    assert column(codes.architecture("v"), "X64-based PC", "X86-based PC", None) == ["x64", "x86", "x86"]
    assert column(codes.os_name("v", F.lit("10.0.1"), F.lit("1909")), "Windows Server 2012 R2 x") == [
        "Windows Server 2012 R2 (1909)"
    ]
    assert column(codes.os_name(F.lit("Windows 10 Pro"), F.lit("10.0.1"), "v"), None) == [None]
    assert column(codes.os_name(F.lit("Windows 7 Pro"), F.lit(None).cast("string"), "v"), None) == ["Windows 7"]
    assert column(codes.interface_title("v", F.lit("Interface Received Bytes Rate")), "a/0/1", "a/1/1", "b") == [
        "Management Interface (Received)", "Data Interface (Received)", "b",
    ]


def test_like_to_regex_is_anchored():
    assert re.fullmatch(text._like_to_regex("a%[0-9]_"), "axx5y")
    assert not re.search(text._like_to_regex("a[0-9]"), "xa1")
