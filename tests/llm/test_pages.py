"""Url verdicts and packaged archives."""

import base64
import hashlib
import io
import zipfile
import zlib

import pytest

from ledgerspark.llm import url_filter, warc_zip

PAGES = "page_id bigint, url string, html string"


def frame(spark, rows):
    return spark.createDataFrame(rows, PAGES)


@pytest.mark.parametrize(
    ("url", "host", "path", "rule", "verdict"),
    [
        ("https://Example.COM/en/x", "example.com", "/en/x", "example.com/en/", "block"),
        ("http://www.example.com/en/?q=1", "www.example.com", "/en/", "www.example.com/en/", "allow"),
        ("http://a.www.example.com/en/x#y", "a.www.example.com", "/en/x", "www.example.com/en/", "allow"),
        ("http://notexample.com/en/x", "notexample.com", "/en/x", "com/", "allow"),
        ("http://b.example.com/EN/x", "b.example.com", "/EN/x", "com/", "allow"),
        ("http://x.net/fr/1", "x.net", "/fr/1", "net/fr/", "block"),
        ("http://x.net/fr", "x.net", "/fr", None, None),
        ("http://y.com", "y.com", "", None, None),
        ("http://y.com?a://b/c", "y.com", "", None, None),
        ("no scheme", "", "", None, None),
        (None, "", "", None, None),
        ("", "", "", None, None),
    ],
)
def test_rules(spark, url, host, path, rule, verdict):
    row = url_filter.match_rules(frame(spark, [(1, url, None)])).first()
    assert (row["host"], row["path"], row["rule"], row["rule_verdict"]) == (host, path, rule, verdict)


def brute_scores(pages, damping, rounds=400):
    """The same two rankings with dictionaries; mass at a host without steps goes to the seeds."""
    links, allowed, blocked = {}, {}, {}
    for host, good, bad, targets in pages:
        allowed[host] = allowed.get(host, 0) + good
        blocked[host] = blocked.get(host, 0) + bad
        for target in set(targets):
            links[host, target] = links.get((host, target), 0) + 1
    scores = []
    for seeds, forward in ((allowed, True), (blocked, False)):
        steps, out = {}, {}
        for (a, b), n in links.items():
            source, target = (a, b) if forward else (b, a)
            steps.setdefault(source, []).append((target, n))
            out[source] = out.get(source, 0) + n
        total = sum(seeds.values()) or 1
        start = {h: n / total for h, n in seeds.items()}
        now = dict(start)
        for _ in range(rounds):
            lost = sum(x for h, x in now.items() if h not in steps)
            new = {h: (1 - damping + damping * lost) * s for h, s in start.items()}
            for source, targets in steps.items():
                for target, n in targets:
                    new[target] = new.get(target, 0) + damping * now.get(source, 0) * n / out[source]
            now = new
        scores.append(now)
    return scores


def test_trust_flows_along_links_and_distrust_against_them(spark):
    def page(k, url, *links):
        return (k, url, "<p>" + "".join(f'<a class=x HREF="{u}">t</a>' for u in links) + "</p>")

    rows = [
        page(1, "http://good.com/", "https://liked.org/a", "/own", "mailto:me@x.org"),
        page(2, "http://good.com/b", "//liked.org/b", "#top"),
        page(3, "http://bad.net/fr/", "http://liked.org/", "http://linked.org/"),
        page(4, "http://linker.org/", "http://bad.net/x"),
        page(5, "http://linker2.org/", "HTTP://linker.org/x"),
        page(6, "http://linked.org/"),
        page(7, "http://liked.org/"),
        page(8, "http://alone.org/"),
        page(9, "http://bad.net/en/"),
        page(10, None, "http://liked.org/"),
        (11, "http://nohtml.org/", None),
    ]
    found = url_filter.url_verdicts(frame(spark, rows))
    verdicts = {r["page_id"]: r["verdict"] for r in found.collect()}
    assert verdicts == {1: "allow", 2: "allow", 3: "block", 4: "block", 5: "block", 6: "allow",
                        7: "allow", 8: "allow", 9: "block", 10: "allow", 11: "allow"}
    edges = {(r["src"], r["dst"]): r["n"] for r in url_filter.host_edges(frame(spark, rows)).collect()}
    assert edges[("good.com", "liked.org")] == 2 and edges[("good.com", "good.com")] == 2
    assert not any("x.org" in pair for pair in edges)
    pages = [
        ("good.com", 1, 0, ["liked.org", "good.com"]), ("good.com", 1, 0, ["liked.org", "good.com"]),
        ("bad.net", 0, 1, ["liked.org", "linked.org"]), ("linker.org", 0, 0, ["bad.net"]),
        ("linker2.org", 0, 0, ["linker.org"]), ("linked.org", 0, 0, []), ("liked.org", 0, 0, []),
        ("alone.org", 0, 0, []), ("bad.net", 0, 0, []), ("nohtml.org", 0, 0, []),
    ]
    seeds = spark.createDataFrame(
        [(h, sum(p[1] for p in pages if p[0] == h), sum(p[2] for p in pages if p[0] == h))
         for h in {p[0] for p in pages}], "host string, allowed long, blocked long")
    trust, distrust = brute_scores(pages, 0.85)
    for row in url_filter.spread(url_filter.host_edges(frame(spark, rows)), seeds).collect():
        assert row["trust"] == pytest.approx(trust.get(row["host"], 0), abs=1e-7)
        assert row["distrust"] == pytest.approx(distrust.get(row["host"], 0), abs=1e-7)


def test_a_chain_of_hosts_is_followed_to_its_end(spark):
    """Forty hosts that link to the next one; the last links to a blocked page."""
    rows = [(k, f"http://h{k}.org/", f'<a href="http://h{k + 1}.org/">t</a>') for k in range(39)]
    rows += [(39, "http://h39.org/", '<a href="http://bad.net/fr/">t</a>'), (40, "http://bad.net/fr/", None)]
    verdicts = {r["page_id"]: r["verdict"] for r in url_filter.url_verdicts(frame(spark, rows)).collect()}
    assert set(verdicts.values()) == {"block"} and len(verdicts) == 41
    pages = [(f"h{k}.org", 0, 0, [f"h{k + 1}.org"]) for k in range(39)]
    pages += [("h39.org", 0, 0, ["bad.net"]), ("bad.net", 0, 1, [])]
    seeds = spark.createDataFrame([(p[0], p[1], p[2]) for p in pages], "host string, allowed long, blocked long")
    distrust = brute_scores(pages, 0.85)[1]
    found = {r["host"]: r for r in url_filter.spread(url_filter.host_edges(frame(spark, rows)), seeds).collect()}
    assert found["h0.org"]["distrust"] == pytest.approx(distrust["h0.org"], rel=1e-5)
    assert sum(r["distrust"] for r in found.values()) == pytest.approx(1) and found["h0.org"]["trust"] == 0


def test_no_pages(spark, tmp_path):
    assert url_filter.url_verdicts(frame(spark, [])).count() == 0
    assert warc_zip.archive_round_trip(frame(spark, []), str(tmp_path / "a")).count() == 0


def reader(data):
    return lambda offset, length: data[offset : offset + length]


def members_of(data):
    read = reader(data)
    found = {}
    for member in warc_zip.zip_directory(read, len(data)):
        begin, size = warc_zip.stored_range(read, member)
        found[member.name] = data[begin : begin + size]
    return found


def test_zip64_package_is_read_by_us_and_by_the_standard_library():
    content = [("archive/a.warc", b"x" * 1000), ("indexes/ü.jsonl", b"{}"), ("empty", b"")]
    data = b"".join(warc_zip.zip_package(content))
    assert members_of(data) == dict(content)
    with zipfile.ZipFile(io.BytesIO(data)) as package:
        assert package.testzip() is None
        assert {n: package.read(n) for n in package.namelist()} == dict(content)


def test_plain_zip_with_comment_and_many_members():
    buffer = io.BytesIO()
    with zipfile.ZipFile(buffer, "w", zipfile.ZIP_STORED) as package:
        for k in range(70_000):  # more than fit the 16-bit count
            package.writestr(f"m{k}", b"")
        package.writestr("last", b"data")
        package.comment = b"holds PK\x05\x06 itself" + b"." * 40
    members = warc_zip.zip_directory(reader(buffer.getvalue()), len(buffer.getvalue()))
    assert len(members) == 70_001
    begin, size = warc_zip.stored_range(reader(buffer.getvalue()), members[-1])
    assert buffer.getvalue()[begin : begin + size] == b"data"


def test_damage_is_an_error():
    with pytest.raises(ValueError, match="Not a ZIP"):
        warc_zip.zip_directory(reader(b"text"), 4)
    buffer = io.BytesIO()
    with zipfile.ZipFile(buffer, "w", zipfile.ZIP_DEFLATED) as package:
        package.writestr("a.warc", b"text" * 100)
    read = reader(buffer.getvalue())
    with pytest.raises(ValueError, match="compressed"):
        warc_zip.stored_range(read, warc_zip.zip_directory(read, len(buffer.getvalue()))[0])
    data = b"".join(warc_zip.zip_package([("a", b"1")]))
    end64 = data.index(warc_zip.END64)
    broken = data[:end64] + b"????" + data[end64 + 4 :]
    with pytest.raises(ValueError, match="Damaged"):
        warc_zip.zip_directory(reader(broken), len(broken))


def test_records_of_plain_and_unindexed_archives(spark, tmp_path):
    records = [
        warc_zip.warc_record(k, None, payload, hashlib.sha256(payload).hexdigest(), None, "2000-01-01T00:00:00Z")
        for k, payload in enumerate((b"", b"\r\n\r\n", "é".encode() * 1000))
    ]
    zipped = b"".join(zlib.compress(r, wbits=31) for r in records)
    members = [("archive/plain.warc", b"".join(records)), ("archive/packed.warc.gz", zipped)]
    path = tmp_path / "p.wacz"
    path.write_bytes(b"".join(warc_zip.zip_package(members)))
    packages = spark.createDataFrame([(str(path), path.stat().st_size)], "path string, n_bytes long")
    found = warc_zip.read_packages(packages).collect()
    assert sorted((r["record_id"], r["payload_bytes"]) for r in found) == sorted(
        (str(k), n) for k, n in ((0, 0), (1, 4), (2, 2000)) for _ in range(2)
    )


def plain_records(n, size=10):
    return [
        warc_zip.warc_record(k, None, p, hashlib.sha256(p).hexdigest(), None, "2000-01-01T00:00:00Z")
        for k, p in ((k, f"{k} ".encode() * size) for k in range(n))
    ]


def read_ids(spark, path, **options):
    packages = spark.createDataFrame([(str(path), path.stat().st_size)], "path string, n_bytes long")
    return sorted(int(r["record_id"]) for r in warc_zip.read_packages(packages, **options).collect())


@pytest.mark.parametrize("form", ["cdxj", "cdxj.gz", "cdx", "jsonl"])
@pytest.mark.parametrize("deflated", [False, True])
def test_indexes_of_other_writers(spark, tmp_path, form, deflated):
    """Packages made by the standard library; the index names two records of three."""
    packed = [zlib.compress(r, wbits=31) for r in plain_records(3)]
    at = [sum(map(len, packed[:k])) for k in range(3)]
    lines = {
        "cdxj": ["!meta {}"] + [
            f'org,x)/{k} 20000101000000 {{"url": "http://x.org/{k}", "offset": "{at[k]}", "length": "{len(packed[k])}",'
            ' "filename": "data.warc.gz"}' for k in (2, 0)
        ],
        "cdx": [" CDX N b a m s k r M S V g"] + [
            f"org,x)/{k} 20000101000000 http://x.org/{k} text/html 200 ABC - - {len(packed[k])} {at[k]} data.warc.gz"
            for k in (2, 0)
        ],
        "jsonl": [f'{{"member": "archive/data.warc.gz", "offset": {at[k]}, "length": {len(packed[k])}}}' for k in (2, 0, 2)],
    }
    index = "".join(line + "\n" for line in lines[form.removesuffix(".gz")]).encode()
    if form.endswith(".gz"):
        half = len(index) // 2
        index = zlib.compress(index[:half], wbits=31) + zlib.compress(index[half:], wbits=31)
    path = tmp_path / "p.wacz"
    with zipfile.ZipFile(path, "w", zipfile.ZIP_STORED) as package:
        package.writestr("archive/data.warc.gz", b"".join(packed))
        package.writestr(f"indexes/index.{form}", index, zipfile.ZIP_DEFLATED if deflated else zipfile.ZIP_STORED)
        package.writestr("indexes/index.idx", "points elsewhere")
    assert read_ids(spark, path) == [0, 2]


def test_bad_indexes_are_errors(spark):
    with pytest.raises(ValueError, match="neither JSON nor CDXJ"):
        list(warc_zip.index_entries("indexes/a.cdxj", b"key 2000 text\n"))
    with pytest.raises(ValueError, match="ends early"):
        list(warc_zip.index_entries("indexes/a.cdxj.gz", zlib.compress(b"a" * 100, wbits=31)[:-9]))
    assert list(warc_zip.index_entries("indexes/a.cdxj", b"")) == []


@pytest.mark.parametrize("chunk", [1, 7, 1 << 20])
def test_archives_without_index_in_chunks(chunk):
    records = plain_records(20)
    for data in (b"".join(records), b"".join(zlib.compress(r, wbits=31) for r in records),
                 zlib.compress(b"".join(records), wbits=31)):
        assert list(warc_zip.unindexed(reader(b"xyz" + data + b"end"), 3, len(data), chunk)) == records
        with pytest.raises(ValueError, match="Damaged"):
            list(warc_zip.unindexed(reader(data), 0, len(data) - 5, chunk))
    assert list(warc_zip.unindexed(reader(b""), 0, 0, chunk)) == []


def test_many_records_without_index_in_linear_time(spark, tmp_path):
    """Copying the rest for each of these records did not end in minutes."""
    records = plain_records(16_000, 600)
    path = tmp_path / "p.wacz"
    members = [("archive/a.warc", b"".join(records)), ("archive/b.warc.gz", b"".join(zlib.compress(r, 1, wbits=31) for r in records))]
    path.write_bytes(b"".join(warc_zip.zip_package(members)))
    assert read_ids(spark, path, with_payload=False) == sorted([*range(16_000)] * 2)


def test_records_of_other_kinds():
    info = b"WARC/1.0\r\nWARC-Type: warcinfo\r\nContent-Type: application/warc-fields\r\nContent-Length: 5\r\n\r\na: b\n\r\n\r\n"
    found = warc_zip.parse_record(info)
    assert (found["record_type"], found["payload"], found["payload_digest"]) == ("warcinfo", b"a: b\n", None)
    head = b"HTTP/1.1 200 OK\r\n\r\n"
    sha1 = base64.b32encode(hashlib.sha1(b"body").digest())
    for digest, fits in ((b"sha1:" + sha1, True), (b"sha1:" + sha1[::-1], False), (b"md5:00", True), (b"sha1:!", False)):
        block = head + b"body"
        record = (b"WARC/1.1\r\nWARC-Type: response\r\nContent-Type: application/http\r\nWARC-Payload-Digest: " + digest
                  + b"\r\nContent-Length: %d\r\n\r\n" % len(block) + block + b"\r\n\r\n")
        if fits:
            assert warc_zip.parse_record(record)["payload"] == b"body"
        else:
            with pytest.raises(ValueError, match="damaged"):
                warc_zip.parse_record(record)


def test_round_trip_with_copies_nulls_and_small_packages(spark, tmp_path):
    long, short = "long payload " * 20, "short"
    rows = [
        (5, "http://x.org/5", long), (3, "http://x.org/3 a\nb", long), (9, None, long),
        (1, "http://x.org/1", short), (2, "http://x.org/2", short), (None, "http://x.org/n", long),
        (7, "http://x.org/7", None), (8, "http://x.org/8", "é" * 50), (6, "http://x.org/6", "é" * 50),
        (3, "http://x.org/3", long),
    ]
    found = warc_zip.archive_round_trip(frame(spark, rows), str(tmp_path / "w"))
    kinds = sorted(((r["page_id"], r["record_type"], r["refers_to"], r["payload_bytes"]) for r in found.collect()), key=repr)
    assert kinds == sorted(
        [(5, "revisit", 3, 260), (3, "response", None, 260), (9, "revisit", 3, 260), (1, "response", None, 5),
         (2, "response", None, 5), (None, "revisit", 3, 260), (7, "response", None, 0),
         (8, "revisit", 6, 100), (6, "response", None, 100), (3, "response", None, 260)], key=repr)
    packages = warc_zip.write_packages(
        warc_zip.with_revisits(frame(spark, rows)), str(tmp_path / "many"), package_bytes=100
    )
    assert packages.count() > 3
    payloads = {r["record_id"]: r["payload"] for r in warc_zip.read_packages(packages, split_bytes=50).collect()}
    assert bytes(payloads["3"]) == long.encode() and payloads["5"] is None


def test_damaged_payload_is_an_error(spark, tmp_path):
    record = warc_zip.warc_record(1, None, b"data", "0" * 64, None, "2000-01-01T00:00:00Z")
    path = tmp_path / "p.wacz"
    path.write_bytes(b"".join(warc_zip.zip_package([("a.warc", record)])))
    packages = spark.createDataFrame([(str(path), 1)], "path string, n_bytes long")
    with pytest.raises(Exception, match="damaged"):
        warc_zip.read_packages(packages).collect()
