import io
import random

import pytest

from quarry.llm import queries, warc


def archive(packed, n=40, seed=5):
    r = random.Random(seed)
    records = [warc.page_record(i, f"http://x/{i}", r.randbytes(r.randrange(3000)) if i % 3 else
                                b"WARC/1.1\r\nWARC-Type: response\r\nfake \x1f\x8b\x08", "D", None) for i in range(n)]
    return [warc.member(x) if packed else x for x in records]


def read(data):
    found = warc.Salvage(io.BytesIO(data).read)
    records = list(found.records())
    spans = sorted([(at, n) for at, n, *_ in records] + [(at, n) for at, n, _ in found.gaps])
    end = 0
    for at, n in spans:             # records and gaps cover every byte once
        assert at == end
        end += n
    assert end == len(data)
    return [head["warc-record-id"].strip("<>") for _, _, head, _ in records], found.gaps


@pytest.mark.parametrize("packed", [True, False])
def test_whole_archive(packed):
    names, gaps = read(b"".join(archive(packed)))
    assert names == [f"urn:page:{i}" for i in range(40)] and not gaps
    assert read(b"") == ([], [])


@pytest.mark.parametrize("packed", [True, False])
def test_damage_costs_the_damaged_record_only(packed):
    r = random.Random(9)
    parts = archive(packed)
    for _ in range(120):
        k, kind = r.randrange(40), r.randrange(4)
        bad = bytearray(parts[k])
        if kind == 0:
            head = 0 if packed else bad.find(b"\r\n\r\n") + 4     # plain header lines have no checksum
            for _ in range(3):
                bad[r.randrange(head, len(bad))] ^= 0x55
        elif kind == 1:
            del bad[r.randrange(len(bad)):]
        elif kind == 2:
            bad = bytearray(b"junk\x1f\x8b\x08" + r.randbytes(60)) + bad
        else:
            bad = bytearray(r.randbytes(5000))
        names, gaps = read(b"".join([*parts[:k], bytes(bad), *parts[k + 1:]]))
        lost = {i for i in range(40) if f"urn:page:{i}" not in names}
        assert lost <= {k} and names == sorted(names, key=lambda n: int(n.rsplit(":", 1)[1]))
        assert gaps or not lost
        assert all(reason for _, _, reason in gaps)


def test_cut_off_and_mixed_archives():
    parts = archive(True)
    names, gaps = read(b"".join(parts)[:-5])
    assert len(names) == 39 and len(gaps) == 1
    names, gaps = read(b"".join(archive(True, 5) + archive(False, 5)))
    assert len(names) == 10 and not gaps


def test_limits():
    found = warc.Salvage(io.BytesIO(b"".join([warc.member(b"WARC/1.1\r\n" + bytes(10_000)), *archive(True, 2)])).read, 5000)
    assert len(list(found.records())) == 2 and found.gaps[0][2] == "member too large"


@pytest.mark.parametrize("packed", [True, False])
def test_version_text_in_a_header_value(packed):
    """Only a header line that starts with the version is a sign of a cut-off head."""
    urls = ["http://a/doc?f=WARC/1.0.txt", "WARC/1.1", "http://b/ WARC/1.", "x"]
    parts = [warc.page_record(i, u, b"payload", "D", None) for i, u in enumerate(urls)]
    names, gaps = read(b"".join(warc.member(p) if packed else p for p in parts))
    assert names == [f"urn:page:{i}" for i in range(4)] and not gaps


def test_cut_off_heads_do_not_swallow_the_next_record():
    parts = archive(False, 3)
    head = parts[1].find(b"\r\n\r\n")
    for cut in range(1, head + 4):
        names, gaps = read(parts[0] + parts[1][:cut] + parts[2])
        assert names == ["urn:page:0", "urn:page:2"] and len(gaps) == 1


def test_search_after_damage_holds_a_few_pieces():
    """A damaged member, 24 MB of other bytes and a valid rest: the buffer stays small."""
    class Watched(warc.Salvage):
        most_held = 0

        def fill(self, upto):
            got = super().fill(upto)
            self.most_held = max(self.most_held, len(self.data))
            return got
    parts = archive(True, 4)
    bad = bytearray(parts[1])
    bad[len(bad) // 2] ^= 0xFF
    noise = bytes(range(1, 30)) * (24 << 20 >> 5)
    source = io.BytesIO(parts[0] + bytes(bad) + noise + parts[2] + parts[3])
    found = Watched(source.read)
    assert [h["warc-record-id"] for _, _, h, _ in found.records()] == [f"<urn:page:{i}>" for i in (0, 2, 3)]
    assert found.gaps == [(len(parts[0]), len(bad) + len(noise), found.gaps[0][2])]
    assert found.most_held < 4 * warc.PIECE


def pages(spark, rows):
    return spark.createDataFrame([(*r, "x", "y") for r in rows], "page_id long, url string, html string, id string, payload string")


def test_round_trip(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(warc, "FILE_BYTES", 400)
    rows = [(5, "http://a", "<p>one</p>"), (3, "http://b", "<p>one</p>"), (9, None, "<p>one</p>"), (4, "http://c", None),
            (8, "http://d\r\nX: y", ""), (7, "u", "é日" * 50_000), (None, "n", "<p>one</p>"), (2, "v", "two"), (2, "v", "two"),
            (1, "w", "WARC/1.1\r\n\r\n\x1f"), (6, "http://a/doc?f=WARC/1.0.txt", "six")]
    folder = warc.write_pages(pages(spark, rows), f"file://{tmp_path}/out")
    got = {tuple(r) for r in warc.read_pages(spark, folder).collect()}
    want = set()
    for page_id, _, html in rows:
        data = (html or "").encode()
        same = [i for i, _, h in rows if (h or "") == (html or "") and i is not None]
        first = page_id is None or page_id == min(same)
        want.add((page_id, len(data), warc.digest(data), "response" if first else "revisit", None if first else min(same)))
    assert got == want
    found = warc.read_archives(spark, folder)
    assert found.count() == len(rows) and found.where("record_type = 'gap'").count() == 0
    assert found.select("file").distinct().count() > 1
    texts = {r["record_id"]: bytes(r["payload"]) for r in found.where("record_type = 'response'").collect()}
    assert texts["urn:page:7"] == ("é日" * 50_000).encode()
    # a damaged file: its gap is logged, other records are still read
    name = found.where("record_id = 'urn:page:7'").first()["file"]
    path = tmp_path / "out" / name
    data = bytearray(path.read_bytes())
    data[len(data) // 2] ^= 0xFF
    path.write_bytes(bytes(data))
    gaps = warc.read_archives(spark, folder).where("record_type = 'gap'").collect()
    assert len(gaps) == 1 and gaps[0]["file"] == name and gaps[0]["gap_reason"]


def test_empty_table(spark, tmp_path):
    folder = warc.write_pages(pages(spark, []), f"file://{tmp_path}/none")
    assert warc.read_pages(spark, folder).count() == 0


def test_query_matches_its_sql(spark, sf_dir):
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM read_parquet('{sf_dir}/pages.parquet')")
    want = sorted(con.execute(queries.ORACLE["op2_warc"]).fetchall())
    got = queries.QUERIES["op2_warc"](spark, sf_dir).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to").collect()
    assert sorted(map(tuple, got)) == want
