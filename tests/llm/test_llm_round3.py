"""Media columns, centroid clustering and periodic runs against plain versions."""

import hashlib
import random
import re
import struct
import zlib

import numpy as np
import pytest
from oracle import both

from curata.llm import ball_tree, iso_media, periodic_runs, queries

SF, LARGER = "/root/testdata/sf0.001", "/root/testdata/sf0.01"
sha = lambda data: hashlib.sha256(data).hexdigest()


# ---------------------------------------------------------------- 11


def walk(data, path):
    """The content of the first box of each kind on the path, by a plain search."""
    for kind in path:
        at = 0
        while data[at + 4 : at + 8] != kind:
            at += struct.unpack(">I", data[at : at + 4])[0]
        data = data[at + 8 : at + struct.unpack(">I", data[at : at + 4])[0]]
    return data


def u32(data):
    return [int(x) for x in np.frombuffer(data, ">u4")]


def plain_samples(media):
    """(offset, size) of every sample, one by one by the standard's own words, and the numbers of keyframes."""
    tables = walk(media, [b"moov", b"trak", b"mdia", b"minf", b"stbl"])
    per_chunk, offsets = u32(walk(tables, [b"stsc"])[8:]), u32(walk(tables, [b"stco"])[8:])
    runs, out, n = [per_chunk[k : k + 3] for k in range(0, len(per_chunk), 3)], [], 0
    size, count = u32(walk(tables, [b"stsz"])[4:12])
    for chunk, at in enumerate(offsets, 1):
        for _ in range([r for r in runs if r[0] <= chunk][-1][1]):
            out.append((at, size))
            at, n = at + size, n + 1
    assert n == count
    return out, u32(walk(tables, [b"stss"])[8:])


def test_media_query(spark):
    got = {r["doc_id"]: r for r in queries.queries()["op11_media_columns"](spark, SF).collect()}
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    assert len(got) == len(docs)
    for d in docs:
        raw = (d["text"] or "").encode()
        payload = raw + b"\0" * (-len(raw) % 64 or 64 * (not raw))
        media = iso_media.pack(raw)
        samples, keys = plain_samples(media)
        assert b"".join(media[a : a + n] for a, n in samples) == payload
        ranges = ",".join(f"{samples[k - 1][0]}+{samples[k - 1][1]}" for k in keys)
        feature = f"codec=raw ;duration={len(payload) // 64}/25;samples={len(payload) // 64};keyframes={len(keys)};ranges={sha(ranges.encode())}"
        assert tuple(got[d["doc_id"]]) == (d["doc_id"], len(raw), len(payload), sha(payload), zlib.crc32(payload[-64:]), len(media), sha(media), feature)


@pytest.mark.parametrize("size", [0, 1, 63, 64, 65, 1600, 1601, 64 * 256, 64 * 256 + 1, 64 * 512, 64 * 600, 3_000_000])
def test_media_round_trip(size):
    raw = random.Random(size).randbytes(size)
    (track,) = iso_media.probe(media := iso_media.pack(raw))
    payload = raw.ljust(max(1, -(-size // 64)) * 64, b"\0")
    assert iso_media.read(media, track["chunks"]) == payload and track["sample_bytes"] == len(payload)
    assert iso_media.read(media, track["keyframes"]) == b"".join(payload[k : k + 64] for k in range(0, len(payload), 64 * 25))


def container(rng, sizes, chunks, keys, wide=False, small=False, unknown=False):
    """A file of one audio track whose chunks lie in any order with gaps, its tables written plainly; and what is to be found."""
    box, full = iso_media._box, iso_media._full
    groups = np.split(np.arange(len(sizes)), chunks)
    order, body, where = list(range(len(groups))), b"", {}
    rng.shuffle(order)
    for g in order:
        body += rng.randbytes(rng.randrange(5))
        where[g] = 8 + len(body)
        for s in groups[g]:
            body += bytes([s % 256]) * sizes[s]
    begins = [where[g] for g in range(len(groups))]
    runs = [(g + 1, len(groups[g])) for g in range(len(groups)) if g == 0 or len(groups[g]) != len(groups[g - 1])]
    number = lambda xs, kind: np.array(xs, kind).tobytes()
    tables = [
        full(b"stsd", struct.pack(">I", 1), box(b"mp4a", bytes(28))),
        full(b"stts", struct.pack(">I", 2), struct.pack(">4I", len(sizes) - 1, 10, 1, 7)),
        full(b"stsc", struct.pack(">I", len(runs)), *(struct.pack(">3I", a, n, 1) for a, n in runs)),
        full(b"stz2", struct.pack(">II", 16, len(sizes)), number(sizes, ">u2")) if small else full(b"stsz", struct.pack(">II", 0, len(sizes)), number(sizes, ">u4")),
        full(b"co64", struct.pack(">I", len(begins)), number(begins, ">u8")) if wide else full(b"stco", struct.pack(">I", len(begins)), number(begins, ">u4")),
        *([] if keys is None else [full(b"stss", struct.pack(">I", len(keys)), number([k + 1 for k in keys], ">u4"))]),
    ]
    rng.shuffle(tables)
    length = (1 << 32) - 1 if unknown else 10 * len(sizes) - 3
    media = box(b"mdia", full(b"mdhd", struct.pack(">QQIQHH", 0, 0, 48_000, length, 0, 0), version=1) if not unknown else full(b"mdhd", struct.pack(">IIIIHH", 0, 0, 48_000, length, 0, 0)), full(b"hdlr", struct.pack(">I4s", 0, b"soun"), bytes(13)), box(b"minf", box(b"stbl", *tables)))
    track = box(b"trak", full(b"tkhd", struct.pack(">QQI", 0, 0, 7), bytes(60), version=1), media)
    empty = box(b"trak", full(b"tkhd", bytes(80)), box(b"mdia", full(b"mdhd", bytes(20)), full(b"hdlr", bytes(24)), box(b"minf", box(b"stbl", full(b"stsd", struct.pack(">I", 1), box(b"text", bytes(8))), *(full(k, bytes(4)) for k in (b"stts", b"stsc", b"stco")), full(b"stsz", bytes(8))))))
    data = struct.pack(">I4s", 8 + len(body), b"mdat") + body + box(b"moov", full(b"mvhd", bytes(96)), track, empty) + box(b"free", b"x")
    data += struct.pack(">I4sQ", 1, b"skip", 20) + b"abcd" + struct.pack(">I4s", 0, b"uuid") + b"to the end"
    return data, [(begins[g] + sum(sizes[x] for x in groups[g] if x < s), sizes[s]) for g in range(len(groups)) for s in groups[g]]


def test_other_containers():
    rng = random.Random(3)
    for trial in range(60):
        sizes = [rng.randrange(300) for _ in range(rng.randrange(1, 40))]
        cuts = sorted(rng.sample(range(1, len(sizes)), rng.randrange(len(sizes)))) if len(sizes) > 1 else []
        keys = None if trial % 3 == 0 else sorted(rng.sample(range(len(sizes)), rng.randrange(len(sizes) + 1)))
        data, samples = container(rng, sizes, cuts, keys, wide=trial % 2, small=trial % 5 == 0, unknown=trial % 4 == 0)
        track, empty = iso_media.probe(data)
        assert (track["track_id"], track["handler"], track["codec"], track["timescale"], track["duration"], track["samples"]) == (7, "soun", "mp4a", 48_000, 10 * len(sizes) - 3, len(sizes))
        expected = [samples[k] for k in (range(len(sizes)) if keys is None else keys)]
        assert iso_media.read(data, track["keyframes"]) == b"".join(data[a : a + n] for a, n in expected)
        numbers = [k for r in track["keyframes"] for k in range(r["first_sample"], r["first_sample"] + r["samples"])]
        assert numbers == (list(range(len(sizes))) if keys is None else keys)
        assert (empty["samples"], empty["keyframes"], empty["chunks"]) == (0, [], [])


def test_damaged_media(spark):
    """Whatever is cut or changed: an error or a result, never another exception, and never a range beyond the end."""
    rng = random.Random(9)
    good = iso_media.pack(rng.randbytes(5000))
    odd, _ = container(rng, [rng.randrange(50) for _ in range(20)], [4, 9], [0, 3, 7])
    values = [None, b"", b"short", good[:-1], good[:30], bytes(16), good, struct.pack(">I4s", 8, b"moov")]
    for source in (good, odd):
        for _ in range(1500):
            data = bytearray(source)
            for _ in range(rng.randrange(1, 4)):
                k = rng.randrange(5064 if source is good else 300, len(data)) if rng.random() < 0.9 else rng.randrange(len(data))
                data[k] = rng.choice([0, 1, 255, rng.randrange(256)])
            values.append(bytes(data[: rng.randrange(len(data))] if rng.random() < 0.1 else data))
    deep = b""
    for _ in range(40):
        deep = iso_media._box(b"moov", deep)
    values.append(deep)
    df = spark.createDataFrame([(k, v, "x", 1) for k, v in enumerate(values)], "id int, media binary, Tracks string, `a.b` int")
    got = {r["id"]: r for r in iso_media.probed(df).collect()}
    assert len(got) == len(values) and iso_media.probed(df).columns == ["id", "media", "a.b", "tracks", "media_error"]
    assert (got[0]["tracks"], got[0]["media_error"]) == (None, None) and got[6]["media_error"] is None and got[7]["tracks"] == []
    assert all(got[k]["media_error"] and got[k]["tracks"] is None for k in (1, 2, 3, 4, 5, len(values) - 1))
    for k, r in got.items():
        assert all(0 <= x["offset"] and x["offset"] + x["size"] <= len(values[k]) for t in r["tracks"] or [] for x in [*t["keyframes"], *t["chunks"]])


def test_media_of_odd_rows(spark):
    long = "é" * 2_000_000
    rows = [(1, None, 1), (2, "", 2), (3, "a", None), (3, "a", None), (None, long, 5)]
    df = iso_media.packed(spark.createDataFrame(rows, "doc_id bigint, data string, MEDIA int"))
    assert df.columns == ["doc_id", "data", "media"]
    done = iso_media.probed(df).select("doc_id", "media", iso_media.stored_bytes(iso_media.F.col("media"), iso_media.F.col("tracks")[0]["chunks"]).alias("back")).collect()
    padded = lambda t: t.encode().ljust(max(1, -(-len(t.encode()) // 64)) * 64, b"\0")
    assert sorted((str(r["doc_id"]), sha(r["media"]), sha(r["back"])) for r in done) == sorted((str(i), sha(iso_media.pack((t or "").encode())), sha(padded(t or ""))) for i, t, _ in rows)
    assert iso_media.probed(iso_media.packed(spark.createDataFrame([], "data string"))).count() == 0


# ---------------------------------------------------------------- 12


def plain_clusters(vectors, k=8, rounds=10, dims=64, scale=1024, seed="3"):
    """rows (vec_id, vector) with ids: Lloyd's rounds in Python's own integers."""
    import math

    kept = [(i, [math.floor(scale * x) for x in v]) for i, v in vectors if v is not None and len(v) == dims and all(x is not None and math.isfinite(x) for x in v)]
    key = lambda r: (r[0] is None, sha(f"{seed}:{r[0]}".encode()), r[1])
    centroids = [v for _, v in sorted(kept, key=key)[:k]]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c, strict=True)), n) for n, c in enumerate(centroids))

    for _ in range(rounds):
        of = [nearest(v)[1] for _, v in kept]
        centroids = [[sum(xs) // len(own) for xs in zip(*own, strict=True)] if (own := [v for (_, v), o in zip(kept, of, strict=True) if o == n]) else c for n, c in enumerate(centroids)]
    done = [(i, *nearest(v)) for i, v in kept]
    inertia = [sum(d for _, d, c in done if c == n) for n in range(k)]
    names = [sha(",".join(map(str, c)).encode()) for c in centroids]
    return [(i, c, d, inertia[c], sum(inertia), names[c]) for i, d, c in done]


def clustered(spark, vectors, **more):
    df = spark.createDataFrame(vectors, "vec_id bigint, embedding array<double>").selectExpr("*", "1 as cluster", "2 as `a.b`")
    return [tuple(r) for r in ball_tree.described(*ball_tree.clusters(df, **more)).collect()]


def test_clusters_by_sql(spark):
    ours, theirs = both(spark, LARGER, queries.queries()["op12_centroid_clustering"], queries.oracle_sql()["op12_centroid_clustering"])
    assert ours == theirs and len(ours) == 500


@pytest.mark.parametrize("seed", range(4))
def test_clusters_by_brute_force(spark, monkeypatch, seed):
    """Ties, repeated vectors and ids, missing ids, vectors that are left out, blocks and leaves of a few vectors."""
    monkeypatch.setattr(ball_tree, "BLOCK", [4096, 7, 50, 16][seed])
    rng = random.Random(seed)
    step = [1 / 1024, 0.5, 1e-4, 3.0][seed]
    vectors = [(k, [step * rng.randrange(-3, 4) for _ in range(3)]) for k in range(150)]
    vectors += [(1000 + k % 5, [0.25, -0.25, 0.5]) for k in range(60)] + [(None, [1.0, 2.0, 3.0])] * 2
    vectors += [(2000, None), (2001, []), (2002, [1.0, 2.0]), (2003, [1.0, None, 2.0]), (2004, [float("nan"), 0.0, 0.0]), (2005, [float("inf"), 0.0, 0.0]), (2006, [1.0] * 4)]
    got = clustered(spark, vectors, k=5, dims=3, rounds=4)
    assert sorted(got, key=str) == sorted(plain_clusters(vectors, k=5, dims=3, rounds=4), key=str)


def test_clusters_of_few_vectors(spark):
    assert clustered(spark, [(1, [1.0]), (2, None)], dims=64) == []
    few = [(k, [float(k), 0.0]) for k in range(3)]
    assert sorted(clustered(spark, few, dims=2)) == sorted(plain_clusters(few, dims=2))
    with pytest.raises(Exception, match="after scaling"):
        clustered(spark, [(1, [1e9, 0.0]), (2, [0.0, 0.0])], dims=2)


def test_balls_are_assigned_whole():
    """Trees give what a plain comparison gives, and of vectors in clusters compare only a few with centroids."""
    rng = np.random.default_rng(2)
    means = rng.integers(-3000, 3000, (8, 16))
    points = np.concatenate([m + rng.integers(-40, 40, (400, 16)) for m in means])
    tree, order = ball_tree.Tree.build(points)
    assert (tree.points == points[order]).all() and tree.count[0] == len(points)
    inner = np.flatnonzero(tree.first_child >= 0)
    assert (tree.sums[inner] == tree.sums[tree.first_child[inner]] + tree.sums[tree.first_child[inner] + 1]).all()
    again = ball_tree.Tree.unpacked(tree.packed())
    for centroids in (means, means + rng.integers(-30, 30, means.shape), rng.integers(-3000, 3000, (8, 16)), np.repeat(means[:1], 8, 0)):
        plain = ((tree.points[:, None] - centroids) ** 2).sum(2)
        of, far = again.labels(centroids)
        assert (of == plain.argmin(1)).all() and (far == plain.min(1)).all()
        counts, sums = tree.totals(centroids)
        assert counts.tolist() == np.bincount(of, minlength=8).tolist()
        assert (sums == np.array([tree.points[of == c].sum(0) for c in range(8)])).all()
    assert (tree.assign(means)[2] < 0).all()
    same, _ = ball_tree.Tree.build(np.tile(means[:1], (5000, 1)))
    assert len(same.start) == 1 and (same.assign(means)[2] < 0).all()


# ---------------------------------------------------------------- 13


def plain_runs(x, least_words=24):
    """Every maximal stretch of every period, the smallest period first."""
    n, found = len(x), {}
    for p in range(1, n // 3 + 1):
        same = np.flatnonzero(np.append(x[:-p] != x[p:], True))  # where a stretch ends
        start = 0
        for stop in same.tolist():
            if stop > start and stop - start + p >= max(least_words, 3 * p):
                found.setdefault((start, stop + p), p)
            start = stop + 1
    return sorted((s, e - s, p) for (s, e), p in found.items())


def test_runs_by_brute_force():
    rng = random.Random(1)
    for _ in range(1500):
        n, letters = rng.randrange(0, 150), rng.choice([1, 2, 2, 3, 5])
        x = [rng.randrange(letters) for _ in range(n)]
        for _ in range(rng.randrange(4) if n > 3 else 0):
            a, p, e = rng.randrange(n), rng.randrange(1, n // 3 + 1), rng.randrange(n)
            for i in range(a, e):
                x[i] = x[a + (i - a) % p]
        least, x = rng.choice([3, 6, 24]), np.array(x, np.int32)
        found = periodic_runs.find_runs(x, least)
        assert found == plain_runs(x, least)
        kept = periodic_runs.kept_words(n, found)
        assert kept.tolist() == [not any(s + p <= i < s + size for s, size, p in found) for i in range(n)]


@pytest.mark.parametrize("points", [1, 5, 1 << 18])
def test_runs_by_any_probe_size(monkeypatch, points):
    monkeypatch.setattr(periodic_runs, "PROBE_POINTS", points)
    monkeypatch.setattr(periodic_runs, "CHUNK", 1)
    monkeypatch.setattr(periodic_runs, "LARGEST_CHUNK", 4)
    x = np.array(([0, 1, 2, 3] * 9 + [7] * 30 + [0, 1] * 13) * 4 + [5] * 24, np.int32)
    assert periodic_runs.find_runs(x) == plain_runs(x)


def test_runs_query(spark):
    """The whole table, planted repeats included, by plain Python."""
    got = {r["doc_id"]: tuple(r) for r in queries.queries()["op13_periodic_runs"](spark, SF).collect()}
    docs, several = spark.read.parquet(f"{SF}/documents.parquet").collect(), 0
    assert len(got) == len(docs)
    for d in docs:
        words = [w for w in re.split(r"[\x20\x09-\x0D]+", d["text"] or "") if w]
        h = zlib.crc32(str(d["doc_id"]).encode())
        g, n = h // 10, len(words)
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
        names = {w: k for k, w in enumerate(sorted(set(words)))}
        found = plain_runs(np.array([names[w] for w in words], np.int32))
        best = None
        for s, size, p in found:
            if best is None or size * best[2] > best[1] * p:
                best = (s, size, p)
        several += len(found) > 0
        kept = " ".join(w for i, w in enumerate(words) if not any(s + p <= i < s + size for s, size, p in found))
        expected = (d["doc_id"], len(found), *(best or (None,) * 3), 1000 * best[1] // best[2] if best else None, sha("".join(f"{s},{size},{p}\n" for s, size, p in found).encode()), sha(kept.encode()))
        assert got[d["doc_id"]] == expected
    assert several > 10


def test_runs_of_odd_rows(spark):
    long = "a b c " * 200_000 + "end"
    rows = [(1, None, 1), (2, "", 2), (3, " \t\n", None), (3, "x " * 24, 4), (3, "x " * 24, 4), (None, "x " * 23, 5), (4, long, 6)]
    df = spark.createDataFrame([(i, t, t, k) for i, t, k in rows], "doc_id bigint, text string, Runs string, `a.b` int")
    found = periodic_runs.runs(df)
    assert found.columns == ["doc_id", "text", "a.b", "n_words", "runs", "collapsed"]
    got = [(r["doc_id"], r["n_words"], [tuple(x) for x in r["runs"]], r["collapsed"]) for r in found.collect()]
    assert got == [(1, 0, [], ""), (2, 0, [], ""), (3, 0, [], ""), (3, 24, [(0, 24, 1)], "x"), (3, 24, [(0, 24, 1)], "x"), (None, 23, [], " ".join("x" * 23)), (4, 600_001, [(0, 600_000, 3)], "a b c end")]
    assert periodic_runs.runs(spark.createDataFrame([], "text string")).count() == 0
    with pytest.raises(ValueError):
        periodic_runs.find_runs(np.zeros(50, np.int32), least_repeats=2)
