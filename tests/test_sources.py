from __future__ import annotations

import pytest
from conftest import rows
from pyspark.sql import functions as F

from fleetquarry.session import shared_dir
from fleetquarry.sources import files, html, messages, sinks, tables
from fleetquarry.streaming import stores

FEED = """<?xml version="1.0" encoding="UTF-8"?>
<updates>
  <update status="final" type="security"><id>RH-1</id><title>one</title><issued date="2020-01-01 00:00:00"/>
    <references><reference href="http://x/CVE-1" id="CVE-1" type="cve"/><reference href="http://x/b" id="B-1"/></references>
    <pkglist><collection><package name="lib" version="1.0" release="1"><filename>lib-1.0-1.x86_64.rpm</filename></package>
      <package name="doc" version="1.10" release="2"><filename>doc-1.10-2.noarch.rpm</filename></package></collection>
      <collection><package name="aux" version="3" release="1"><filename>aux-3-1.i686.rpm</filename></package></collection></pkglist>
  </update>
  <update status="final" type="bugfix"><id>RH-2</id><title>bare &amp; empty</title><issued date="2020-02-02"/></update>
</updates>
"""


def test_update_feed(spark, tmp_path):
    (tmp_path / "feed.xml").write_text(FEED)
    updates = files.read_updateinfo(spark, str(tmp_path))
    assert rows(files.update_packages(updates), "id", "title", "date", "name", "version", "file_name") == [
        ("RH-1", "one", "2020-01-01 00:00:00", "aux", "3", "aux-3-1"),
        ("RH-1", "one", "2020-01-01 00:00:00", "doc", "1.10", "doc-1.10-2"),
        ("RH-1", "one", "2020-01-01 00:00:00", "lib", "1.0", "lib-1.0-1"),
        ("RH-2", "bare & empty", "2020-02-02", None, None, None),
    ]
    assert rows(files.update_references(updates)) == [
        ("RH-1", "B-1", "http://x/b"), ("RH-1", "CVE-1", "http://x/CVE-1"), ("RH-2", None, None),
    ]


def test_one_package_per_update_is_still_a_list(spark, tmp_path):
    one = FEED.replace("RH-2", "RH-3").split("<update ")[0] + (
        '<update status="s" type="t"><id>1</id><pkglist><collection><package name="n" version="2020" release="1">'
        "<filename>f.rpm</filename></package></collection></pkglist></update></updates>"
    )
    (tmp_path / "feed.xml").write_text(one)
    assert rows(files.update_packages(files.read_updateinfo(spark, str(tmp_path))), "name", "version", "file_name") == [
        ("n", "2020", "f")
    ]


def test_html(spark):
    page = """<TABLE><tr><th>h</th></tr>
<TR class=a><td>1
2</td></TR><track><tr></tr></table><a class="x" HREF='/one'>First <b>link</b></a><a href=/two>second</a>
<abbr href="no">no</abbr><a name="n">no</a><a href="/three">First link</a>"""
    pages = spark.createDataFrame([(1, page), (2, ""), (3, None)], "id int, html string")
    assert rows(html.html_table_rows(pages)) == [(1, 0, "<th>h</th>"), (1, 1, "<td>1\n2</td>"), (1, 2, "")]
    links = html.html_links(pages)
    assert rows(links) == [
        (1, 0, "/one", "First link"), (1, 1, "/two", "second"), (1, 2, "/three", "First link"),
    ]
    assert rows(html.first_link(links, "id", "first LINK")) == [(1, "/one")]


def test_build_rows(spark):
    inner = (
        "<TD>15.0.1</TD>\r\n<TD>x\r\n<TD>2019.150.1\r\n<TD>q</TD>\r\n<TD>KB<b>1</b></TD>\r\n"
        '<TD><A href="http://x/1" rel=n>CU1 for A</A>\r\n<TD><TIME class="d" datetime="2020-01-02">'
    )
    rows_ = spark.createDataFrame([(inner,), ("<TH>head</TH>",)], "inner_html string")
    assert rows(html.builds_from_rows(rows_)) == [
        ("15.0.1", "2019.150.1", "2019", "KB1", "http://x/1", "CU1 for ", "2020-01-02"),
        ("head", None, None, None, None, None, None),
    ]


def test_event_messages(spark, table):
    created = (
        "A network share object was added.\r\n\r\nSubject:\r\n\tSecurity ID:\t\tS-1-5-21\r\n\tAccount Name:\t\tjoe\r\n"
        "\tAccount Domain:\t\tDOM\r\n\tLogon ID:\t\t0x1\r\n\r\n\tShare Name:\t\t\\\\*\\Data\r\n\tShare Path:\t\tC:\\a: b"
    )
    modified = (
        "A network share object was modified.\r\nSecurity ID:\t\tS-1\r\nAccount Name:\t\tann\r\nAccount Domain:\t\tD\r\n"
        "Logon ID:\t\t1\r\nObject Type:\t\tDir\r\nShare Name:\t\t\\\\*\\M\r\nShare Path:\t\tp\r\nOld Remark:\t\t\r\n"
        "New Remark:\t\tr\r\nOld MaxUsers:\t\t1\r\nNew Maxusers:\t\t2\r\nOld ShareFlags:\t\t0\r\nNew ShareFlags:\t\t1\r\n"
        "Old SD:\t\tD:(A;;FA;;;WD)\r\nNew SD:\t\tbroken"
    )
    raw = table(
        "share_event_raw",
        (1, 1, "t", 5142, created),
        (1, 2, "t", 5143, modified),
        (1, 3, "t", 5144, created.replace("S-1-5-21", "S-1-5-18")),
        (1, 4, "t", 5144, created.replace("Data", "smspkgd$")),
        (1, 5, "t", 4663, created),
        (1, 6, "t", 5142, "no fields"),
    )
    names = {"sid": {"WD": "Everyone"}, "type": {"A": "Allow"}}
    parsed = messages.parse_share_events(raw, names)
    assert rows(parsed, "index", "account_name", "object_type", "share_name", "share_path", "old_remark", "new_sd", "old_sd") == [
        (1, "joe", None, "\\\\*\\Data", "C:\\a: b", None, None, None),
        (2, "ann", "Dir", "\\\\*\\M", "p", "", "broken", "Everyone: Allow (FA)"),
        (6, None, None, None, None, None, None, None),
    ]


def test_share_aces(spark, table):
    raw = table(
        "share_ace_raw",
        (1, "Data", "o", "D", "joe", 3, 0, 1), (1, "Data", "o", "D", "joe", 3, 0, 1), (1, "C$", "o", None, "x", 1, 1, 2),
        (1, "ADMIN$", "o", None, None, 1, 1, 2), (1, "Data$", "o", None, None, 4, 9, 0),
    )
    rights, types = {1: "Read", 2: "Write"}, {0: "AccessAllowed", 1: "AccessDenied"}
    ntfs = messages.share_aces(raw, "NTFSPermission", rights, types, {1: "Object", 2: "Container"})
    columns = ["shared_folder_name", "security_principal", "file_system_rights", "access_control_type"]
    assert rows(ntfs, *columns, "access_control_flags") == [
        ("Data", "D\\joe", "Read, Write", "AccessAllowed", "Object"), ("Data$", "NOT_RESOLVED", "", "9", ""),
    ]
    shared = messages.share_aces(raw, "SharedPermission", rights, types)
    assert shared.count() == 5  # shares keep repeats and administrative names
    both = shared.unionByName(ntfs, allowMissingColumns=True)
    assert both.filter("access_control_flags IS NULL").count() == 5


def test_tables_and_views(spark, table, tmp_path):
    table("folder", (1, "a"), (2, "b")).write.parquet(str(tmp_path / "folder"))
    got = tables.tables(spark, str(tmp_path), ["folder"])
    assert rows(got["folder"]) == [(1, "a"), (2, "b")]
    tables.register_views(got, "inv_")
    assert rows(tables.catalog_tables(spark, {"f": "inv_folder"})["f"]) == [(1, "a"), (2, "b")]
    # a filter reaches the files and only the columns asked for are read
    plan = got["folder"].filter("container_node_id = 1").select("name")._jdf.queryExecution().toString()
    assert "PushedFilters: [IsNotNull(container_node_id), EqualTo(container_node_id,1)]" in plan


def test_delimited_files(spark, tmp_path):
    builds = spark.createDataFrame(
        [("1", "2019.1", "2019", 'KB "1"', None, "CU, 1", "2020-01-01")], files.BUILD_SCHEMA
    )
    sinks.write_builds(builds, str(tmp_path / "b"))
    assert "".join(p.read_text() for p in (tmp_path / "b").glob("part-*")) == '1|2019.1|2019|KB "1"||CU, 1|2020-01-01\n'
    assert rows(files.read_builds(spark, str(tmp_path / "b"))) == rows(builds)
    sheet = "Date,Product,Product Family,Platform,Article,Download,Severity,Impact,Details\n01,A,,P,'4,S,,,CVE-1\n2020-02-03,\"A, B\",F,P,5,S,C,I,CVE-2\n"
    (tmp_path / "s.csv").write_text(sheet)
    assert rows(files.read_cve_sheet(spark, str(tmp_path / "s.csv")), "product", "product_family", "article", "cve") == [
        ("A", "", "4", "CVE-1"), ("A, B", "F", "5", "CVE-2"),
    ]


def test_materialise_and_versions(spark):
    df = spark.range(10).withColumn("t", F.lit("2020-01-01").cast("timestamp_ntz"))
    copy = sinks.materialise(df, "copy")
    assert rows(copy) == rows(df) and copy.dtypes == df.dtypes
    root = shared_dir(spark, "state")
    sinks.write_version(df, root, 1)
    sinks.write_version(df.limit(3), root, 2)
    assert sinks.read_version(spark, root, 1, "id bigint, t timestamp_ntz").count() == 10
    assert sinks.read_version(spark, root, 2, "id bigint, t timestamp_ntz").count() == 3


def test_append_new(spark, tmp_path):
    target, batch = spark.createDataFrame([("a",)], "k string"), spark.createDataFrame([("a",), ("b",), ("b",)], "k string")
    for _ in range(2):  # a rerun writes the same folder again
        sinks.append_new(target, batch, ["k"], str(tmp_path / "n"))
    assert rows(spark.read.parquet(str(tmp_path / "n"))) == [("b",)]


# -- streams ------------------------------------------------------------------------------------

EVENT = "resource_id bigint, index bigint, instance_id bigint, message string, at timestamp"


def _land(spark, folder, *events):
    spark.createDataFrame([(1, i, 5142, m) for i, m in events], "resource_id bigint, index bigint, instance_id bigint, message string").selectExpr(
        "*", "TIMESTAMP'2024-01-01 00:00:00' AS at"
    ).coalesce(1).write.mode("append").parquet(folder)


def test_event_store_follows_new_files_and_the_last_batch_wins(spark, tmp_path):
    landing, root, progress = (str(tmp_path / n) for n in ("in", "store", "progress"))
    schema = "resource_id bigint, index bigint, instance_id bigint, message string"

    def run():
        stream = spark.readStream.schema(EVENT).parquet(landing).drop("at")
        stores.start_event_store(stream, root, progress).awaitTermination()
        return rows(stores.read_store(spark, root, schema), "index", "message")

    _land(spark, landing, (1, "z first"), (2, "two"))
    assert run() == [(1, "z first"), (2, "two")]
    _land(spark, landing, (1, "a later"), (3, "three"))
    assert run() == [(1, "a later"), (2, "two"), (3, "three")]
    assert run() == [(1, "a later"), (2, "two"), (3, "three")]  # nothing new
    stores.compact(spark, root, schema, str(tmp_path / "compact"))
    assert rows(stores.read_store(spark, str(tmp_path / "compact"), schema), "index", "message") == [
        (1, "a later"), (2, "two"), (3, "three"),
    ]


def test_watermarked_stream_drops_repeats(spark, tmp_path):
    landing, root, progress = (str(tmp_path / n) for n in ("in", "store", "progress"))
    _land(spark, landing, (1, "a"), (1, "b"), (2, "c"))
    stream = spark.readStream.schema(EVENT).parquet(landing)
    stores.start_event_store(stream, root, progress, event_time="at").awaitTermination()
    assert spark.read.parquet(root).count() == 2


def test_insert_new_stream_and_its_replay(spark, tmp_path):
    landing, root = str(tmp_path / "in"), str(tmp_path / "store")
    schema = "index bigint, message string"

    def run(progress):
        stream = spark.readStream.schema(EVENT).parquet(landing).select("index", "message")
        stores.start_insert_new(stream, root, str(tmp_path / progress), schema, ["index"]).awaitTermination()
        return rows(spark.read.schema(schema).parquet(root + "/*"), "index")

    _land(spark, landing, (1, "a"), (1, "b"), (2, "c"))
    assert run("p") == [(1,), (2,)]
    _land(spark, landing, (2, "d"), (3, "e"))
    assert run("p") == [(1,), (2,), (3,)]


def test_streams_go_on_after_compaction_and_never_overwrite(spark, tmp_path):
    landing, later, root, fresh = (str(tmp_path / n) for n in ("in", "later", "store", "fresh"))
    schema = "resource_id bigint, index bigint, instance_id bigint, message string"

    def run(source, target, progress):
        stream = spark.readStream.schema(EVENT).parquet(source).drop("at")
        stores.start_event_store(stream, target, str(tmp_path / progress)).awaitTermination()

    _land(spark, landing, (1, "b"), (2, "two"))
    run(landing, root, "p")
    _land(spark, landing, (1, "a"), (1, "c"))
    run(landing, root, "p")
    with pytest.raises(ValueError, match="would overwrite|would "):
        run(landing, root, "another")
    stores.compact(spark, root, schema, fresh, order=["message"])
    with pytest.raises(ValueError, match="already holds"):
        stores.compact(spark, root, schema, fresh)
    _land(spark, later, (3, "three"))
    run(later, fresh, "q")
    assert rows(stores.read_store(spark, fresh, schema), "index", "message") == [(1, "c"), (2, "two"), (3, "three")]


def test_inserts_go_on_after_compaction(spark, tmp_path):
    landing, later, root, fresh = (str(tmp_path / n) for n in ("in", "later", "store", "fresh"))
    schema = "index bigint, message string"

    def run(source, target, progress):
        stream = spark.readStream.schema(EVENT).parquet(source).select("index", "message")
        stores.start_insert_new(stream, target, str(tmp_path / progress), schema, ["index"]).awaitTermination()

    _land(spark, landing, (1, "a"), (2, "b"))
    run(landing, root, "p")
    with pytest.raises(ValueError):
        run(landing, root, "another")
    stores.compact(spark, root, schema, fresh, ["index"])
    _land(spark, later, (2, "later"), (3, "c"))
    run(later, fresh, "q")
    assert rows(spark.read.schema(schema).parquet(fresh + "/*"), "index", "message") == [(1, "a"), (2, "b"), (3, "c")]


def test_compaction_purges(spark, tmp_path):
    root, fresh = str(tmp_path / "store"), str(tmp_path / "fresh")
    schema = "resource_id bigint, index bigint, instance_id bigint, time_generated string"
    old_and_new = [(1, 1, 1, "01.01.2024 00:00:00"), (1, 2, 1, "01.06.2024 00:00:00"), (1, 3, 1, "unreadable")]
    spark.createDataFrame(old_and_new, schema).write.parquet(f"{root}/batch_id=0")
    stores.compact(spark, root, schema, fresh, as_of="2024-07-05 00:00:00")
    assert rows(stores.read_store(spark, fresh, schema), "index") == [(2,), (3,)]


def test_materialised_copies_are_reused_and_discarded(spark, tmp_path):
    path = str(tmp_path / "copy")
    assert sinks.materialise(spark.range(3), "x", path).count() == 3
    assert sinks.materialise(spark.range(5), "x", path).count() == 3
    sinks.discard(spark, path)
    sinks.discard(spark, path)
    assert sinks.materialise(spark.range(5), "x", path).count() == 5
