"""Archives: round trip, revisits, rolling, determinism, broken files."""

import gzip
import hashlib
import json
import random
from pathlib import Path

import pytest

from vecsearch.llm import warc
from vecsearch.llm.warc import broken_revisits, read_archive, read_manifest, write_archive

WIDE = "page_id long, url string, html string, digest string, shard string, kind string, payload string, place string"
TEXT = "a page of more than one hundred bytes, so that equal ones are stored once and revisited after that. " * 2


def pages(spark, rows):
    return spark.createDataFrame([(*r, *["x"] * 5) for r in rows], WIDE)


def expected(rows):
    first = {}
    for page, _, html in rows:
        body = (html or "").encode()
        if page is not None and len(body) >= 100:
            first[body] = min(page, first.get(body, page))
    out, seen = [], set()
    for page, _, html in rows:
        body = (html or "").encode()
        target = first.get(body) if page is not None else None
        again = target is not None and (page != target or (page, body) in seen)
        seen.add((page, body))
        out.append((page, len(body), hashlib.sha256(body).hexdigest(), "revisit" if again else "response", target if again else None))
    return sorted(out, key=str)


def found(spark, path):
    df = read_archive(spark, str(path), payloads=False)
    return sorted((tuple(r) for r in df.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to").collect()), key=str)


ODD = [(1, "http://a/1", TEXT), (2, "http://a/2", TEXT), (3, None, None), (4, "http://a/4", ""), (5, "http://a b\r\nWARC-Type: x", "short"),
       (6, "http://a/6", "short"), (7, "http://a/7", "ü\r\n\r\nWARC/1.1 " * 40), (None, "n", TEXT), (None, "n", TEXT), (9, "u", TEXT),
       (9, "u", TEXT), (9, "u", "other " + TEXT), (1, "http://a/1", TEXT), (-5, "neg", "x" * 99), (-4, "neg", "x" * 99), (-2, "y", "y" * 100),
       (-3, "y", "y" * 100), (12, "long", "lange Seite " * 300_000), (13, "again", "lange Seite " * 300_000)]


def test_round_trip_of_odd_rows(spark, tmp_path):
    write_archive(pages(spark, ODD).repartition(5), str(tmp_path / "a"))
    assert found(spark, tmp_path / "a") == expected(ODD)
    records = read_archive(spark, str(tmp_path / "a"))
    assert broken_revisits(records).count() == 0
    held = {r.page_id: bytes(r.payload).decode() for r in records.where("record_type = 'response' and page_id is not null").collect()
            if r.page_id != 9}
    assert held == {p: (h or "") for p, _, h in ODD if p in held} and held[12] == ODD[17][2] and held[7] == ODD[6][2]
    ids = [r[0] for r in records.select("record_id").collect()]
    assert len(set(ids)) == len(ODD)
    assert records.where("page_id = 5").first().target_uri == "http://a%20b%0D%0AWARC-Type:%20x"
    assert records.where("page_id = 3").first().target_uri is None


def test_hot_copies_small_files_and_same_files_again(spark, tmp_path, monkeypatch):
    rnd = random.Random(4)
    rows = [(i, f"http://s/{i}", TEXT if i % 3 == 0 else "".join(rnd.choices("abcdef ", k=rnd.randint(0, 4000)))) for i in range(1500)]
    monkeypatch.setattr(warc, "SHARD_BYTES", 200_000)
    monkeypatch.setattr(warc, "SPLIT_BYTES", 5_000)
    write_archive(pages(spark, rows).repartition(7), str(tmp_path / "a"), file_bytes=20_000)
    write_archive(pages(spark, rows[::-1]).repartition(3), str(tmp_path / "b"), file_bytes=20_000)
    assert found(spark, tmp_path / "a") == expected(rows)
    a, b = ({p.name: p.read_bytes() for p in (tmp_path / x).iterdir() if not p.name.endswith(".crc")} for x in "ab")
    assert a == b and len(a) > 20 and max(len(v) for k, v in a.items()) < 21_000
    assert len({k[:10] for k in a if k.startswith("part")}) > 5
    entries = read_manifest(str(tmp_path / "a"))
    assert {f["name"] for f in entries} == set(a) - {"manifest.jsonl"} and sum(f["records"] for f in entries) == len(rows)
    assert all(hashlib.sha256(a[f["name"]]).hexdigest() == f["sha256"] and len(a[f["name"]]) == f["bytes"] for f in entries)
    plain = gzip.decompress(a["part-00000-0000.warc.gz"])
    assert plain.startswith(b"WARC/1.1\r\nWARC-Type: warcinfo\r\n") and plain.count(b"WARC-Record-ID: <urn:page:") == entries[0]["records"]
    places = [r.page_id for r in read_archive(spark, str(tmp_path / "a")).orderBy("file", "offset").collect()]
    assert places == sorted(places)


def test_empty_table_modes_and_abort(spark, tmp_path):
    path = str(tmp_path / "a")
    write_archive(pages(spark, []), path)
    assert found(spark, path) == [] and read_manifest(path) == []
    write_archive(pages(spark, ODD[:5]), path, file_bytes=10)
    assert len(read_manifest(path)) == 5
    with pytest.raises(Exception, match="an archive in this folder"):
        write_archive(pages(spark, ODD[:2]), path)
    write_archive(pages(spark, ODD[:2]), path, mode="overwrite")
    assert found(spark, path) == expected(ODD[:2])
    assert {p.name for p in Path(path).iterdir()} == {"part-00000-0000.warc.gz", "manifest.jsonl"}
    (tmp_path / "b" / "_staging-j").mkdir(parents=True)
    (tmp_path / "b" / "_staging-j" / "3-part-00000-0000.warc.gz").write_bytes(b"half")
    assert read_manifest(str(tmp_path / "b")) == []
    warc.ArchiveWriter({"path": str(tmp_path / "b"), "file_bytes": "1", "date": warc.DATE, "job": "j"}, False).abort([None])
    assert not list((tmp_path / "b").iterdir())


@pytest.mark.parametrize("harm", ["cut", "bit", "digest"])
def test_damage_is_noticed(spark, tmp_path, harm):
    write_archive(pages(spark, ODD[:2]), str(tmp_path / "a"))
    file = tmp_path / "a" / "part-00000-0000.warc.gz"
    data = file.read_bytes()
    if harm == "cut":
        file.write_bytes(data[:-40])
    else:
        plain = gzip.decompress(data)
        at = plain.index(b"a page of") if harm == "bit" else plain.index(b"Payload-Digest: sha256:") + 30
        new = gzip.compress(plain[:at] + (b"~" if harm == "bit" else b"0" if plain[at:at + 1] != b"0" else b"1") + plain[at + 1:])
        file.write_bytes(new)
        manifest = json.loads((tmp_path / "a" / "manifest.jsonl").read_text())
        (tmp_path / "a" / "manifest.jsonl").write_text(json.dumps(manifest | {"bytes": len(new)}) + "\n")
    with pytest.raises(Exception):
        read_archive(spark, str(tmp_path / "a")).collect()
