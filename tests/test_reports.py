"""Each report on a few hand-made rows with hand-computed results."""

from __future__ import annotations

from datetime import datetime
from decimal import Decimal

import pytest
from conftest import rows

from fleetquarry.operators.snapshots import reconcile
from fleetquarry.plans import audit, collections, compliance, inventory, linux_updates, performance, servers, shares
from fleetquarry.sources.files import UPDATE_SCHEMA, normalise_cve_sheet
from fleetquarry.sources.sinks import materialise

D = datetime
T0 = D(2020, 1, 1, 22)
T3 = D(2020, 1, 2, 1)  # three hours later


def test_collection_members(table):
    got = collections.collection_members(
        table("full_collection_membership", ("C1", 1, "pc", 5, "D", "S"), ("C2", 2, "joe", 4, "D", "S"), ("C9", 3, "x", 3, "D", "S")),
        table("collection", ("C1", "All"), ("C2", "Users")),
    )
    assert rows(got, "resource_id", "member_type", "collection") == [(1, "Device", "All"), (2, "User", "Users"), (3, "unknown", None)]


def test_device_collections_are_the_filed_ones_in_order(table):
    got = collections.device_collections(
        table("full_collection_membership", ("C1", 1, "pc"), ("C2", 1, "pc"), ("C3", 1, "pc"), ("C4", 1, "pc")),
        table("collection", ("C1", "b"), ("C2", "a"), ("C3", "z"), ("C4", "y")),
        table("folder_member", ("C1", 1, 5000), ("C2", 1, 5000), ("C3", 2, 5001)),
        table("folder", (1, "F1"), (2, "F2")),
    )
    assert [tuple(r) for r in got.select("folder_name", "collection_name").collect()] == [("F1", "a"), ("F1", "b")]


def test_configuration_status_fans_out_over_items(table):
    got = compliance.configuration_status(
        table("system", (1, "PC1", None, "D", "joe"), (2, "PC2", None, "D", "ann")),
        # items 7 and 8 share their flags: one state row, named after the greater item
        table("ci_compliance", (1, 7, T0, 1, 1, 2), (1, 8, D(2019, 1, 1), 1, 1, 2), (1, 9, T0, 0, 1, 1)),
        table("ci_setting_detail", (1, 7, "off"), (1, 6, None)),
        table("ci_rule", (7, "rule7"), (6, "rule6"), (5, "rule5")),
        table("ci_localized", (8, 65535, "eight"), (8, 1033, "acht"), (9, 1033, "nine")),
    )
    columns = ["item_id", "item_name", "last_compliance", "rule_name", "state", "state_or_value"]
    assert rows(got, *columns) == [
        (8, "eight", T3, "rule6", "Non Compliant", None),
        (8, "eight", T3, "rule7", "Non Compliant", "off"),
        (9, None, T3, "rule6", "Not Applicable", "Not Applicable"),
        (9, None, T3, "rule7", "Not Applicable", "Not Applicable"),
    ]


def test_application_deployments(table):
    got = compliance.application_deployments(
        table(
            "app_deployment_result",
            (16777216, 1, 5, 1000, T0, None), (16777216, 1, 5, 1000, T0, None),
            (42, 2, 5, 9999, None, T0), (42, 1, 6, 9999, None, None), (42, 3, 6, None, None, None),
        ),
        table("application_assignment", (1, "A", "Col", "C", 0), (2, "B", "Col", "C", 2)),
        table("ci_compliance", (16777216, 5, D(2019, 1, 1)), (16777216, 5, T0), (42, 9, T0)),
        table("system", (16777216, "PC", None, "DOM")),
        table("user", (42, "joe", "D", "Joe", "IT", "DOM\\joe")),
    )
    columns = ["name", "deployed_on", "application_name", "purpose", "state_message", "last_modification", "start_time", "last_status_utc", "last_status"]
    assert rows(got, *columns) == [
        ("DOM\\PC", "Devices", "A", "Required", "Success", T3, None, T0, T3),
        ("DOM\\joe", "Users", None, None, "Unknown", None, None, None, None),
        ("DOM\\joe", "Users", "A", "Required", None, None, None, None, None),
        ("DOM\\joe", "Users", "B", "Available", "Available for Install", None, T3, None, None),
    ]


def test_cve_supersedence(spark, table):
    got = compliance.cve_supersedence(
        table("update_info", (1, "KB1"), (2, "KB2"), (3, "KB3"), (4, "KB1")),
        table(
            "cve_article",
            *[(None, p, "f", "x", "KB1", "u", "s", "i", "CVE-1") for p in ("p1", "p2")],
            (None, "p", "f", "x", "KB2", "u", "s", "i", None),
        ),
        # 2 and the unknown 9 supersede 1; 3 is related in another way; 3 is two steps up
        table("ci_relation", (2, 1, 6), (9, 1, 6), (3, 1, 5), (3, 2, 6), (4, 1, 6)),
    )
    assert rows(got, "cve", "article_id", "newer_article_id", "ci_id") == [
        ("CVE-1", "KB1", None, None), ("CVE-1", "KB1", "KB1", 1), ("CVE-1", "KB1", "KB1", 4), ("CVE-1", "KB1", "KB2", 2),
    ]


def test_installed_software(table):
    got = inventory.installed_software(
        table("system", (1, "B", None, "D", "joe", "D"), (2, "A", None, "D", "joe", "other"), (3, "C")),
        table("user", (9, "joe", "D", "Joe", "IT")),
        table("operating_system", (1, "Windows", "10.0")),
        table("combined_device", (2, T0)),
        table("installed_software", (1, "zip", "1"), (2, "zip", "1"), (1, "app", "2")),
    )
    columns = ["product_name", "netbios_name", "full_user_name", "os", "last_policy_request"]
    assert [tuple(r) for r in got.select(*columns).collect()] == [
        ("app", "B", "Joe", "Windows", None), ("zip", "A", None, None, T0), ("zip", "B", "Joe", "Windows", None),
    ]


@pytest.fixture
def devices(table):
    return {
        "system": table(
            "system",
            (1, "PC1", "CORP.NET", "CORP", "joe", "D", 13, "Linux"), (2, "PC2", None, "WG", "ann", None, 13, "Linux"), (3, "PC3", None, "WG", None, None, 5, "x"),
        ),
        "network_adapter": table(
            "network_adapter",
            (1, "10.0.0.2,fe80::1", "m2", "Intel Wi-Fi 6"), (1, "10.0.0.1", None, "e"), (1, None, "m0", "off"), (3, None, None, "Wi-Fi"),
        ),
        "processor": table("processor", (1, "Xeon @ 2.40GHz", 4), (1, "Xeon @ 2.40GHz", 4), (2, "AMD EPYC", 8)),
        "pc_bios": table("pc_bios", (1, "SN1", "V1")),
    }


def test_linux_system_info(table, devices):
    got = inventory.linux_system_info(
        devices["system"],
        table("operating_system", (1, "Red Hat", "7", "B1", None, T0, 1033, 2048, 1025, 0)),
        devices["processor"],
        devices["pc_bios"],
        table("computer_system", (1, "M", "Maker")),
        table("combined_device", (1, T0, None)),
        devices["network_adapter"],
        table("logical_disk", (1, "/var", Decimal(1025), Decimal(256)), (1, "/", Decimal(2048), Decimal(1234567)), (1, None, Decimal(1), Decimal(1))),
    )
    assert [r.netbios_name for r in got.collect()] == ["PC1", "PC2"]
    one, two = (r.asDict() for r in got.collect())
    assert one["host_name"] == "PC1.corp.net" and two["host_name"] == "PC2"
    assert (one["ip_addresses"], one["mac_addresses"]) == ("10.0.0.1\n10.0.0.2", "m2")
    assert one["volumes"] == "[/] 2GB\n[/var] 2GB" and one["free_space"] == "[/] 1,205.6GB\n[/var] 0.3GB"
    assert (one["cpu"], two["cpu"]) == ("2.40GHz (Cores:8)", "AMD (Cores:8)")
    assert one["memory"] == "Virtual: 2GB\nVisible: 2GB\nSWAP: 0GB" and two["memory"] is None
    assert one["last_policy_request"] == T3 and two["ip_addresses"] is None and two["volumes"] is None


def test_system_info(table, devices):
    got = inventory.system_info(
        devices["system"],
        table("operating_system", (1, "Microsoft Windows 10 Pro", "10.0.18363"), (2, "Microsoft Windows Server 2012 R2 Standard", "10.0.1"), (3, "Windows 7", "6.1")),
        table("servicing_state", ("10.0.18363", 0, "n"), ("10.0.18363", 1, "n"), ("10.0.1", 0, "gone")),
        table("servicing_name", ("n", 1033, "1909"), ("n", 1049, "x")),
        devices["processor"],
        table("x86_pc_memory", (1, 1048577)),
        devices["pc_bios"],
        table("system_type", (1, "X64-based PC")),
        devices["network_adapter"],
        table("disk", (1, 1, Decimal(1024)), (1, 0, Decimal(4096))),
    )
    columns = ["netbios_name", "primary_user", "has_wifi", "cpu", "memory", "disks", "os", "os_version"]
    assert rows(got, *columns) == [
        # one row per processor, as there is no distinct
        ("PC1", "D\\joe", "Yes", "2.40GHz (Cores:8)", "2GB", "4GB\n1GB", "Windows 10 (1909)", "Windows 10 Pro (1909) x64"),
        ("PC1", "D\\joe", "Yes", "2.40GHz (Cores:8)", "2GB", "4GB\n1GB", "Windows 10 (1909)", "Windows 10 Pro (1909) x64"),
        # a known build without a name hides the whole text
        ("PC2", None, "No", "AMD (Cores:8)", None, None, None, None),
        ("PC3", None, "Yes", None, None, None, "Windows 7", "Windows 7 x86"),
    ]


def test_linux_update_compliance(spark, table):
    def update(number, date, packages, cves=()):
        files = [(name, version, "1", f"{name}-{version}-1.x86_64.rpm") for name, version in packages]
        return (
            "final", "security", f"RH-{number}", f"t{number}", (date,), ([(c, f"http://{c}") for c in cves] or None,),
            ([(files,)] if files else None,),
        )

    updates = spark.createDataFrame(
        [
            update(1, "2020-01-01 08:00:00", [("ssl", "1.0")]),
            update(2, "2020-02-01 08:00:00", [("ssl", "1.1"), ("tie", "1.0")], ["CVE-1", "BUG-1"]),
            update(3, "2020-02-01 08:00:00", [("tie", "1.1")]),
            update(4, "2020-03-01", [], ["CVE-9"]),
        ],
        UPDATE_SCHEMA,
    )
    system = table("system", (1, "PC1", None, None, None, None, 13), (2, "PC2", None, None, None, None, 5))
    programs = table(
        "add_remove_programs",
        (1, "ssl-1.0-1.x86_64", "1.0", "p", "20200115000000", T0), (1, "ssl-1.1-1.x86_64", "1.1", "p", "bad", T0),
        (1, "tie-1.0-1.noarch", "1.0", "p", None, T0), (1, "own-9-1", "9", "p", None, T0), (1, "odd", "7", "p", None, T0),
        (2, "ssl-1.0-1", "1.0", "p", None, T0),
    )
    got = linux_updates.linux_update_compliance(system, programs, updates)
    columns = ["display_name", "name", "current_version", "install_date", "actual_file_name", "update_required", "cve", "cve_is_open", "current_version_rank"]
    assert rows(got, *columns) == [
        ("odd", None, "odd", None, None, None, None, None, 1),
        ("own-9-1", "own", "9-1", None, None, None, None, None, 1),
        ("ssl-1.0-1", "ssl", "1.0-1", D(2020, 1, 15), "ssl-1.1-1", "1", "CVE-1", "1", 2),
        ("ssl-1.1-1", "ssl", "1.1-1", None, "ssl-1.1-1", "0", "CVE-1", "0", 1),
        ("tie-1.0-1", "tie", "1.0-1", None, "tie-1.0-1", "0", "CVE-1", "0", 1),
        ("tie-1.0-1", "tie", "1.0-1", None, "tie-1.1-1", "1", "CVE-1", "0", 1),
    ]


def test_security_audit(table):
    def event(number, user, service, at):
        return (number, at, user, "TD", "PD", "sid", "cat", "DC", service, "two", "three", "four", "::ffff:5", "six", "::ffff:7", "eight")

    events = table(
        "audit_event", event(4740, "joe@corp", "svc", D(2020, 1, 1)), event(4768, "joe", "svc", D(2020, 1, 3)),
        event(4769, "joeann", "svc", D(2020, 1, 2)), event(4769, "bob", "svc", D(2020, 1, 2)), event(4624, "joe", "svc", D(2020, 1, 2)),
        event(4769, "joe", None, D(2020, 1, 2)),
    )
    columns = ["event_id", "target_user", "target_domain", "service_name", "client_address", "client_port", "service_sid"]
    got = audit.security_audit(events, [4740, 4768, 4769], "joe", "v")
    assert [tuple(r) for r in got.select(*columns).collect()] == [  # newest first
        (4768, "joe", "td", "svc", "::ffff:7", "eight", "two"),
        (4769, "joeann", "td", "svc", "::ffff:5", "six", "two"),
        (4740, "joe", "pd", "two", "na", "six", "na"),
    ]
    cut = audit.security_audit(events, [4768], address_delimiter=":")
    assert cut.first()["client_address"] == "7"


def test_performance_history(spark, table):
    rule = table("performance_rule", *[(i, o, c) for i, (o, c) in enumerate([
        ("Memory", "Free Memory %"), ("Memory", "PercentMemoryUsed"), ("Processor", "% Processor Time"), ("LogicalDisk", "% Free Space"),
        ("Network Adapter", "Bytes Total/sec"), ("If", "Interface Received Bytes Rate"), ("If", "Interface Transmitted Bytes Rate"), ("X", "Other"),
    ])])
    names = ["m", "m", "_Total", "C:", "nic-a", "if/1/1", "if/1/1", "x"]
    instance = table("performance_rule_instance", *[(10 + i, i, n) for i, n in enumerate(names)], (20, 4, "nic-b"), (21, 6, "if/LO/1"))
    entity = table("managed_entity", (1, 1, "WPC.corp", "Microsoft.Windows.Computer"), (2, 1, "disk", "x"), (3, 3, "fw", "Maker.Firewall.Class"))
    at, rate = D(2020, 1, 10, 22), 131072.0
    hourly = table(
        "perf_hourly",
        (at, 10, 2, 30.0, 20.0, 40.0), (at, 12, 1, 5.0, 1.0, 9.0), (at, 13, 2, 50.0, 40.0, 60.0), (at, 13, 1, 50.0, 40.0, 60.0),
        (at, 14, 1, rate, 0.0, 2 * rate), (at, 20, 1, 7.0, 7.0, 7.0), (at, 17, 1, 1.0, 1.0, 1.0), (D(2019, 1, 1), 12, 1, 1.0, 1.0, 1.0),
        (at, 15, 3, rate, rate, rate), (at, 16, 3, rate, rate, 3 * rate), (at, 21, 3, 1.0, 1.0, 1.0),
    )
    base = performance.counter_base(rule, instance, hourly, entity, "2020-01-20 00:00:00")
    assert base.count() == 9
    got = performance.performance_history(materialise(base, "counters"))
    fixed = {"date_time": D(2020, 1, 11, 1), "date_day": D(2020, 1, 11)}
    windows = [r.asDict() for r in got.filter("netbios_name = 'WPC.corp'").collect()]
    assert len(windows) == 3  # one other-counter row each: disk and two adapters
    for r in windows:
        assert {k: r[k] for k in fixed} == fixed
        assert (r["domain"], r["device"]) == ("corp", "Windows WKS")
        assert (r["memory_average"], r["memory_max"], r["memory_min"]) == (70.0, 80.0, 60.0)
        assert (r["cpu_average"], r["cpu_max"], r["cpu_min"]) == (5.0, 9.0, 1.0)
        assert r["system_disk_max"] == 60.0
        assert (r["network_average"], r["network_max"]) == (1.0, 2.0)  # the first adapter only
    others = {r["other_instance"]: (r["other_counter"], r["other_average"], r["other_max"], r["other_min"]) for r in windows}
    assert others["C:"] == ("% Used Space", 50.0, 60.0, 40.0)
    assert others["nic-a"] == ("Mbit/sec", 0.0, 0.0, 0.0)  # the minimum, three times
    firewall = rows(got.filter("netbios_name = 'fw'"), "domain", "device", "other_instance", "other_max", "network_average", "network_max", "cpu_max")
    assert firewall == [
        ("None", "Firewall", "Data Interface (Received)", 1.0, 2.0, 4.0, None),
        ("None", "Firewall", "Data Interface (Transmitted)", 1.0, 2.0, 4.0, None),
    ]
    repaired = performance.performance_history(base, fix_network=True)
    assert rows(repaired.filter("other_instance = 'nic-a'"), "other_average", "other_max", "other_min") == [(1.0, 2.0, 0.0)]


def test_duplicate_counters_do_not_multiply(spark, table):
    rule = table("performance_rule", (1, "Memory", "PercentMemoryUsed"), (2, "Processor", "% Processor Time"))
    instance = table("performance_rule_instance", (1, 1, "a"), (2, 1, "b"), (3, 2, "c"))
    entity = table("managed_entity", (1, 1, "h", "x"))
    at = D(2020, 1, 1)
    hourly = table("perf_hourly", *[(at, i, 1, 1.0, 1.0, 1.0) for i in (1, 1, 2, 3, 3)], (at, 2, 1, 2.0, 2.0, 2.0))
    got = performance.performance_history(performance.counter_base(rule, instance, hourly, entity, "2020-01-02"))
    assert rows(got, "memory_average", "cpu_average") == [(1.0, 1.0), (2.0, 1.0)]


def test_server_version_compliance(spark, table):
    binary = "C:\\P\\MSSQL13.A\\sqlservr.exe"
    got = servers.server_version_compliance(
        table("system", (1, "S1", None, "D", None, None, 5, "Windows Server"), (2, "W1", None, "D", None, None, 5, "Windows 10")),
        table("computer_system", (1,), (2,)),
        table("system_ou", (1, "corp/a"), (1, "corp/b"), (1, "zone")),
        table(
            "service",
            (1, "MSSQLSERVER", "SQL Server (MSSQLSERVER)", "Auto", "svc", f'"{binary}" -sX'),
            (1, "Agent", "SQL Server Agent (X)", "Auto", "svc", f'"{binary}" -sX'), (2, "M", "SQL Server (A)", "Auto", "svc", f'"{binary}" -sX'),
        ),
        table("operating_system", (1, "Microsoft Windows Server 2016")),
        table("software_file", (1, "C:\\P\\MSSQL13.A\\", "sqlservr.exe", "2015.0130.4001.00 ((x).1)"), (1, "C:\\", "sqlservr.exe", "1")),
        table("combined_device", (1, None, None, T0)),
        spark.createDataFrame(
            [
                ("9", "2015.9.1", "2015", "KB9", "l", "CU9", "2018-01-01"), ("10", "2015.10.1", "2015", "KB10", "l", "CU10", "2019-01-01"),
                ("11", "2015.99", "2015", "KB", "l", "CU Beta", "2020"), ("12", "2017.1", "2017", "KB", "l", None, "2020"),
            ],
            "build string, file_version string, sql_version string, kb string, link string, update_name string, release_date string",
        ),
    )
    assert got.count() == 1
    row = got.first().asDict()
    assert row["organizational_unit"] == "zone" and row["operating_system"] == "Server 2016"
    assert row["instance"] == "Default" and row["sql_version"] == "SQL Server 2016"
    assert row["short_file_version"] == "2015.130.4001.0" and row["last_software_scan"] == "02.01.2020 01:00"
    assert row["actual_build"] == "9" and row["release_date"] == D(2018, 1, 1)  # as text 9 is above 10


def test_newest_builds_by_version_number(spark):
    builds = spark.createDataFrame(
        [("a", "2015.9.1", "2015", "x"), ("b", "2015.10.1", "2015", "x"), ("c", "2015.10.1", "2015", "y")],
        "build string, file_version string, sql_version string, update_name string",
    )
    assert rows(servers.newest_builds(builds, "version"), "build") == [("b",), ("c",)]
    assert rows(servers.newest_builds(builds), "build") == [("a",)]


EVENTS = [
    (1, 1, 5142, "25.12.2019 10:30:00", "A network share object was added. ", None, "joe", "D", None, None, "\\\\*\\Data", "C:\\d"),
    (1, 2, 5144, "12/25/2019 11:00:00 PM", "Объект сетевой папки удален.", None, "joe", None, None, None, "\\\\*\\Old", "C:\\o"),
    (2, 3, 5142, "26.12.2019 00:00:00", "A network share object was added.", None, "joe", "D", None, None, "\\\\*\\Data", "C:\\d"),
    (1, 4, 5142, "26.12.2019 00:00:00", "whatever", None, "a<b", "D", None, None, "\\\\*\\Data", "C:\\d"),
]
SYSTEMS = [(1, "PC1", "CORP.NET", "DOM", None, None, 5, "Windows Server"), (2, "PC2", None, "DOM", None, None, 5, "Windows 10")]


def test_share_events_search(table):
    args = (table("folder_sharing_event", *EVENTS), table("system", *SYSTEMS), table("share", (1, "Data", "about", "C:\\d")), ["DOM"])
    kinds = ["Создание", "Удаление"]
    got = shares.share_events_search(*args, kinds)
    assert rows(got, "computer_name", "event_type", "shared_folder", "remark", "changed_by", "event_time") == [
        ("PC1.corp.net", "Создание", "Data", "about", "D\\joe", D(2019, 12, 25, 10, 30)),
        ("PC1.corp.net", "Удаление", "Old", None, None, D(2019, 12, 25, 23)),
    ]
    day = D(2019, 12, 25, 10, 30)  # the start itself is outside
    assert rows(shares.share_events_search(*args, kinds, day=day), "shared_folder") == [("Old",)]
    assert shares.share_events_search(*args, ["whatever"], day="2019-12-25 00:00:00").count() == 0
    assert shares.share_events_search(*args, kinds, computer="PC2%").count() == 0
    assert shares.share_events_search(*args, kinds, folder="ld").count() == 1


def test_share_event_digest(table):
    got = shares.share_event_digest(table("folder_sharing_event", *EVENTS), table("system", *SYSTEMS), D(2019, 12, 26, 12))
    columns = ["event_type", "shared_folder_path", "computer_name", "event_time_text"]
    assert [tuple(r) for r in got.select(*columns).collect()] == [
        ("whatever", "\\\\PC1.corp.net\\Data", "PC1.corp.net", "26.12.2019 00:00:00"),
        ("Add", None, "PC2", "26.12.2019 00:00:00"),
        ("Delete", "\\\\PC1.corp.net\\Old", "PC1.corp.net", "25.12.2019 23:00:00"),
    ]
    assert "D\\a&lt;b" in got.first()["html"]


def permission(device, folder, at, kind="NTFSPermission", who="Все", rights="R", access="AccessAllowed"):
    return (device, folder, at, kind, who, rights, access, "f", "o")


def test_share_permissions_latest(table):
    found = table(
        "share_folder_permission",
        permission(1, "Data", "25.12.2019 10:30"), permission(1, "Data", "19.12.26 10:30"), permission(1, "Data", "12/26/2019 10:30:00", who="u", access="AccessDenied"),
        permission(2, "Data", "25.12.2019 10:30"), permission(2, "No Shared Folders", "26.12.2019 10:30", "", "", "", ""), permission(3, "Data", "bad"),
    )
    share = table("share", (1, "Data", "about", "C:\\d"))
    got = shares.share_permissions_latest(found, table("system", *SYSTEMS), share, ["DOM"])
    assert rows(got, "computer_name", "device_kind", "shared_folder", "permission_type", "security_principal", "access", "remark") == [
        ("PC1.corp.net", "Сервер", "Data", "NTFS", "Everyone", "Allowed", "about"),
        ("PC1.corp.net", "Сервер", "Data", "NTFS", "u", "Denied", "about"),
        ("PC2", "Рабочая станция", "No Shared Folders", "", "", "", None),
    ]
    assert shares.share_permissions_latest(found, table("system", *SYSTEMS), share, ["DOM"], security_principal="Every%").count() == 1
    assert shares.share_permissions_latest(found, table("system", *SYSTEMS), share, ["else"]).count() == 0


def test_scan_to_state_to_digest(spark, table):
    first = [permission(1, "Data", "25.12.2019 10:30"), permission(1, "Gone", "25.12.2019 10:30"), permission(2, "Data", "25.12.2019 10:30")]
    second = [
        permission(1, "Data", "26.12.2019 10:30", access="AccessDenied"), permission(1, "New", "26.12.2019 10:30", "SharedPermission", "a&b"),
        permission(2, "No Shared Folders", "26.12.2019 10:30", "", "", "", ""),
    ]
    system = table("system", *SYSTEMS)
    day1, day2 = D(2019, 12, 25, 12), D(2019, 12, 27, 12)
    state = reconcile(table("approval"), shares.current_permissions(table("share_folder_permission", *first)), day1)
    assert rows(state, "shared_folder_name", "check_status", "old_permissions") == [("Data", "New", "None"), ("Data", "New", "None"), ("Gone", "New", "None")]
    # device 2 found nothing in its last scan, so its folder leaves the state
    state = reconcile(state, shares.current_permissions(table("share_folder_permission", *first, *second)), day2)
    assert rows(state, "resource_id", "shared_folder_name", "check_status", "new_permissions") == [
        (1, "Data", "Modified", "[Shared](UNKNOWN)[NTFS](Everyone: R DENY)"),
        (1, "New", "New", "[Shared](a&b: R)[NTFS](UNKNOWN)"),
    ]
    digest = shares.share_change_digest(state, system, D(2019, 12, 28))
    by_folder = {r.shared_folder_name: r for r in digest.collect()}
    assert by_folder["Data"].folder_path == "\\\\PC1.corp.net\\Data"
    assert by_folder["Data"].old_line == "<strong>Shared</strong><br>UNKNOWN<br><strong>NTFS</strong><br>" '<font color="red">Everyone: R</font><br>'
    assert by_folder["New"].old_line == "None" and "a&amp;b: R" in by_folder["New"].html
    assert shares.share_change_digest(state, system, D(2019, 12, 29)).count() == 0


def test_sheet_columns(spark):
    sheet = spark.createDataFrame(
        [("2020-01-02", "P", None, "x", "'4500'", "S", None, "I", "CVE-1")],
        "`Date` string, `Product` string, `Product Family` string, `Platform` string, `Article` string, "
        "`Download` string, `Severity` string, `Impact` string, `Details` string",
    )
    assert rows(normalise_cve_sheet(sheet)) == [(D(2020, 1, 2), "P", "", "x", "4500", "S", "", "I", "CVE-1")]
