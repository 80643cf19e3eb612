"""FASTA records in byte ranges against a parser that goes by single bytes, at every range size."""

import random

import pytest

from kinfold.sources import fasta


def sequential(data: bytes):
    """(id, def, seq, offset, n_errors, error_offset, reason) by one state machine over all bytes."""
    state, rows, own = "start", [], None

    def wrong(reason, k, c):
        own[4] += 1
        if own[4] == 1:
            own[5], own[6] = k, reason if reason == "Missing >" else f"{reason} '{chr(c)}'"

    for k, c in enumerate(data):
        letter = chr(c).isascii() and chr(c).isalpha()
        if c == 13:
            continue
        if state == "start":
            if c == 62:
                if own:
                    rows.append(own)
                own, state = [b"", b"", b"", k, 0, None, None], "id"
            else:
                own = own or [None, None, None, 0, 0, None, None]
                wrong("Missing >", 0, c)
        elif state == "id":
            if c in b" \t":
                own[1], state = own[1] + bytes([c]), "def"
            elif c == 10:
                state = "data"
            else:
                own[0] += bytes([c])
        elif state == "def":
            if c == 10:
                state = "data"
            else:
                own[1] += bytes([c])
        elif state == "data":
            if c == 10:
                state = "line"
            elif letter or c == 42:
                own[2] += bytes([c])
            else:
                wrong("Bad data character", k, c)
        elif c == 62:
            rows.append(own)
            own, state = [b"", b"", b"", k, 0, None, None], "id"
        elif letter:
            own[2], state = own[2] + bytes([c]), "data"
        elif c != 10:
            wrong("Bad id or data character", k, c)
    if own:
        rows.append(own)
    return [tuple(x.decode("utf-8", "replace") if isinstance(x, bytes) else x for x in r) for r in rows]


def in_ranges(path, size, n):
    reader = fasta.FastaReader({"path": str(path), "rangeBytes": str(size)})
    rows = [tuple(r.values()) for p in reader.partitions() for b in reader.read(p) for r in b.to_pylist()]
    return [(*r[:3], *r[4:8]) for r in rows]


SAMPLES = [
    b">a one\nACGT\nAC*T\n>b\nMK\n", b"", b"\n\n", b"no mark\nat all", b"junk>a\nAC\n>b\n", b">a\n>b\nACGT\n>c\n>d\n>e\n>f\nAC\n>g", b">a d>e f\r\nAC GT\r\n\r\n>b\tx\r\n\r\n>c\r\nAC\r\n",
    b">a\n*AC\n*AC*\n12>b\nAC\n 1 2 A>C\n>c\nA\n", b">\nAC\n> x\nAC\n", b">a\nAC\n\n\n>b\n\n>c\n\n\n", "é>ü ß\nAÉC\n>ö\nÄ>\n".encode(), b">a", b">a\n>", b"\r>a\n\r>b\n\r>c\nA",
]


@pytest.mark.parametrize("data", SAMPLES)
def test_every_split_point(tmp_path, data):
    path = tmp_path / "x.fa"
    path.write_bytes(data)
    want = sequential(data)
    for size in range(1, len(data) + 2):
        assert in_ranges(path, size, len(data)) == want, size


def test_random_bytes_at_every_range_size(tmp_path, monkeypatch):
    monkeypatch.setattr(fasta, "BACK", 3)
    r = random.Random(5)
    for i in range(150):
        data = bytes(r.choice(b">>\n\n\n\rAC* 1g") for _ in range(r.randrange(40)))
        path = tmp_path / f"{i}.fa"
        path.write_bytes(data)
        want = sequential(data)
        for size in (1, 2, 3, 5, 8, 13, 100):
            assert in_ranges(path, size, len(data)) == want, (data, size)


def test_source_reads_folders_and_reports(spark, tmp_path):
    fasta.register(spark)
    (tmp_path / "one.fa").write_bytes(b">a first\nACGT\n>b\nAC?GT\n")
    (tmp_path / "two.fa").write_bytes(b"oops\n>c x>y\nMK\n")
    (tmp_path / "_SUCCESS").write_bytes(b"")
    for size in ("7", "1000"):
        got = spark.read.format("fasta_records").option("path", str(tmp_path)).option("rangeBytes", size).load()
        rows = sorted((x["file"].rsplit("/", 1)[1], x["offset"], x["id"], x["seq"], x["n_errors"], x["reason"], x["embedded"]) for x in got.collect())
        assert rows == [("one.fa", 0, "a", "ACGT", 0, None, False), ("one.fa", 14, "b", "ACGT", 1, "Bad data character '?'", False), ("two.fa", 0, None, None, 5, "Missing >", False), ("two.fa", 5, "c", "MK", 0, None, True)]
    uri = spark.read.format("fasta_records").option("path", f"file://{tmp_path}").load()
    assert uri.count() == 4 and all(r["file"].startswith("file://") for r in uri.collect())
    with pytest.raises(Exception, match="nowhere"):
        spark.read.format("fasta_records").option("path", str(tmp_path / "nowhere")).load().collect()
