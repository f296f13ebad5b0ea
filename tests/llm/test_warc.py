import base64
import gzip
import hashlib
import json
import os
from collections import Counter, defaultdict

import pytest

from tessera.llm.queries import ORACLE, QUERIES
from tessera.llm.warc import read_warc, write_warc

SCHEMA = "page_id long, url string, html string"


def digest(t):
    return base64.b32encode(hashlib.sha1((t or "").encode()).digest()).decode()


def brute(rows, min_bytes=0):
    """(id, url, bytes, digest, type, refers) of every row."""
    order = lambda x: ((x[0] is not None, x[0] or 0), (x[1] is not None, x[1] or ""))
    groups, out = defaultdict(list), []
    for i, u, t in rows:
        groups[t or ""].append((i, u))
    for t, members in groups.items():
        members.sort(key=order, reverse=True)
        for k, (i, u) in enumerate(members):
            kept = k == 0 or len(t.encode()) < min_bytes
            out.append((i, u, len(t.encode()), digest(t), "response" if kept else "revisit", None if kept else members[0][0]))
    return Counter(out)


def read(spark, path):
    return Counter((r.source_id and int(r.source_id), r.url, r.payload_bytes, r.payload_digest, r.record_type,
                    r.refers_to and int(r.refers_to)) for r in read_warc(spark, path).collect())


def files(path):
    return {n: open(f"{path}/{n}", "rb").read() for n in sorted(os.listdir(path)) if n.startswith("part-")}


ROWS = ([(i, f"http://a/{i}", "same page") for i in range(400)] + [(i, f"http://b/{i}", f"<p>page {i}</p>" * (i % 9 + 1)) for i in range(400, 700)]
        + [(7, "http://r", "repeated")] * 300 + [(None, None, None), (None, None, ""), (None, "http://n", "x"), (900, "u", None)]
        + [(901, "a\r\nWARC-Type: forged\x00", "é\r\n\r\nWARC/1.1\r\n"), (902, "", "z" * 300_000), (903, "u", "x"), (903, "v", "x")])


@pytest.mark.parametrize("min_bytes", [0, 9])
def test_against_brute_force(spark, tmp_path, min_bytes):
    df = spark.createDataFrame(ROWS, SCHEMA).selectExpr("*", "1 as shard", "'k' as kind", "0 as id").repartition(5)
    m = write_warc(df, str(tmp_path / "a"), min_bytes=min_bytes, shard_bytes=(20_000, 20_000), file_bytes=3_000)
    want = brute([(i, u and u.replace("\r", "%0D").replace("\n", "%0A").replace("\x00", "%00"), t) for i, u, t in ROWS], min_bytes)
    assert read(spark, str(tmp_path / "a")) == want
    listed = m.collect()
    assert len({r.shard for r in listed}) > 5 and len(listed) > len({r.shard for r in listed})
    assert sum(r.records for r in listed) == len(ROWS)
    got = files(tmp_path / "a")
    assert sorted(got) == sorted(r.name for r in listed)
    for r in listed:
        assert len(got[r.name]) == r.bytes and hashlib.sha256(got[r.name]).hexdigest() == r.sha256
        assert gzip.decompress(got[r.name]).count(b"WARC-Record-ID: ") == r.records


def test_files_do_not_depend_on_the_split(spark, tmp_path):
    """Same bytes from other partitions and another order; ids ascend over the files; payloads come back."""
    df = spark.createDataFrame(ROWS, SCHEMA)
    for name, src in (("a", df.repartition(7)), ("b", df.orderBy("html").coalesce(2))):
        write_warc(src, str(tmp_path / name), shard_bytes=(20_000, 20_000), file_bytes=5_000)
    assert files(tmp_path / "a") == files(tmp_path / "b")
    rows = read_warc(spark, str(tmp_path / "a")).orderBy("file", "offset").collect()
    ids = [-1 if r.source_id is None else int(r.source_id) for r in rows]
    assert ids == sorted(ids)
    assert len({r.record_id for r in rows}) == len(rows)
    texts = {t or "" for _, _, t in ROWS}
    assert {r.payload.decode() for r in rows if r.payload is not None} == texts


def test_commit(spark, tmp_path):
    """Files of attempts that were not committed are no part of the archive; a commit may be run again."""
    from tessera.llm import warc
    path, real = str(tmp_path / "a"), warc._commit
    df = spark.createDataFrame(ROWS, SCHEMA)
    warc._commit = lambda *a: None
    try:
        write_warc(df, path, shard_bytes=(20_000, 20_000))
        with pytest.raises(Exception):
            read_warc(spark, path).count()
        write_warc(df, path, shard_bytes=(20_000, 20_000))  # a whole second attempt
    finally:
        warc._commit = real
    listed = spark.read.parquet(f"{path}/_manifest_new").collect()
    os.rename(f"{path}/{listed[0].temp}", f"{path}/{listed[0].name}")  # a commit that stopped
    warc._commit(spark, path)
    assert read(spark, path) == brute([(i, u and u.replace("\r", "%0D").replace("\n", "%0A").replace("\x00", "%00"), t) for i, u, t in ROWS])
    before = files(path)
    assert write_warc(df.limit(1), path).count() == len(listed) and files(path) == before


def test_damage_is_found(spark, tmp_path):
    path = str(tmp_path / "a")
    write_warc(spark.createDataFrame(ROWS[:3], SCHEMA), path)
    name, = files(path)
    good = gzip.decompress(open(f"{path}/{name}", "rb").read())
    open(f"{path}/{name}", "wb").write(gzip.compress(good.replace(b"same page", b"same pagf", 1)))
    with pytest.raises(Exception, match="digest|is cut"):
        read_warc(spark, path).count()


def test_empty_and_other_ids(spark, tmp_path):
    assert write_warc(spark.createDataFrame([], SCHEMA), str(tmp_path / "a")).count() == 0
    assert read_warc(spark, str(tmp_path / "a")).collect() == []
    df = spark.createDataFrame([("b", "u", "t"), ("a", "u", "t")], "`the id` string, `u.r` string, html string")
    write_warc(df, f"file://{tmp_path}/b", id_col="the id", url_col="u.r")
    got = {r.source_id: (r.record_type, r.refers_to) for r in read_warc(spark, f"file://{tmp_path}/b").collect()}
    assert got == {"b": ("response", None), "a": ("revisit", "b")}


def test_query(spark, sf001):
    import duckdb
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM '{sf001}/pages.parquet'")
    want = con.execute(ORACLE["op11_warc"]).fetchall()
    got = [tuple(r) for r in QUERIES["op11_warc"](spark, sf001).collect()]
    assert Counter(got) == Counter(want) and len(json.dumps(got)) > 100
