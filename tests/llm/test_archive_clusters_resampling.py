"""Web archive, centroid clustering and importance resampling against brute force."""

import gzip
import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

from demandspark.llm.clusters import Centroids, assigned, centroid_clusters, squared
from demandspark.llm.resampling import LONG, crcs, hashed_features, resampled
from demandspark.llm.warc import archived, read_archive, restored, warc_files, write_archive

from tests.llm.data import SF, both, edge_docs

# --- web archive ------------------------------------------------------------------


def brute_archive(rows, least):
    keeper = {}
    for page, _, html in rows:
        if page is not None:
            keeper[html or ""] = max(keeper.get(html or "", page), page)
    out = []
    for page, _, html in rows:
        payload = (html or "").encode()
        to = keeper.get(html or "")
        again = len(payload) >= least and to is not None and page != to
        out.append((page, len(payload), hashlib.sha1(payload).hexdigest(), "revisit" if again else "response", to if again else None))
    return sorted(out, key=str)


PAGES = "page_id long, url string, html string, address string, part int, payload long"


def odd_pages(spark):
    long = "<p>" + "ü日 text " * 300 + "</p>"
    rows = [(1, "http://a/1", long), (2, "http://a/2", long), (5, None, long), (5, "http://a/5", long), (3, "http://b/\r\nWARC-Type: metadata\r\n\t%", "short"), (4, "http://b/4", "short"),
            (None, "http://c", long), (None, None, None), (7, "", ""), (8, "http://d", None), (9, "http://e", "x" * 999), (10, "http://e", "x" * 999), (11, "http://e", "x" * 1000), (12, "http://e", "x" * 1000),
            (None, "u", "only nulls " * 200), (None, "u", "only nulls " * 200), (13, "http://f", "line\r\n\r\nWARC/1.1\r\n\r\nWARC-Type: x\r\n" * 60), (14, "h", "y" * 400_000), (15, "h", "y" * 400_000)]
    rows += [(100 + i, "http://hot/", "hot " * 400) for i in range(2500)]
    return spark.createDataFrame([(*r, "z", 3, None) for r in rows], PAGES)


def test_archive(spark):
    pages = odd_pages(spark)
    rows = [(r.page_id, r.url, r.html) for r in pages.collect()]
    for least in (1000, 0, 5):
        got = archived(pages, least=least).drop("url")
        assert got.dtypes == [("page_id", "bigint"), ("payload_bytes", "bigint"), ("payload_digest", "string"), ("record_type", "string"), ("refers_to", "bigint")]
        assert sorted(map(tuple, got.collect()), key=str) == brute_archive(rows, least)
    assert archived(pages.limit(0)).count() == 0


def test_archive_stores_payloads_once_and_writes_warc_files(spark, tmp_path):
    pages = odd_pages(spark)
    folder, out = f"{tmp_path}/archive", f"{tmp_path}/warc"
    write_archive(pages, folder)
    rows = [(r.page_id, r.url, (r.html or "").encode()) for r in pages.collect()]
    assert spark.read.parquet(f"{folder}/payloads").count() == len({p for _, _, p in rows})
    back = [(r.page_id, bytes(r.payload)) for r in read_archive(spark, folder).collect()]
    assert Counter(back) == Counter((i, p) for i, _, p in rows)
    warc_files(spark, folder, out, records=500)
    found, files = [], [f for f in Path(out).iterdir() if f.name.startswith("part-")]
    assert len(files) >= 5
    for f in files:
        data = gzip.decompress(f.read_bytes())
        while data:  # a reader that goes by lengths alone
            header, _, rest = data.partition(b"\r\n\r\n")
            fields = dict(line.split(": ", 1) for line in header.decode().split("\r\n")[1:])
            size = int(fields["Content-Length"])
            block, end, data = rest[:size], rest[size:size + 4], rest[size + 4:]
            assert header.startswith(b"WARC/1.1\r\n") and end == b"\r\n\r\n"
            http, _, payload = block.partition(b"\r\n\r\n")
            if fields["WARC-Type"] == "response":
                assert fields["WARC-Payload-Digest"] == "sha1:" + hashlib.sha1(payload).hexdigest()
            else:
                assert payload == b"" and "WARC-Refers-To" in fields
            found.append((fields["WARC-Type"], fields["WARC-Record-ID"]))
    told = [(r.record_type, f"<urn:x-page:{'null' if r.page_id is None else r.page_id}>") for r in read_archive(spark, folder).collect()]
    assert sorted(found) == sorted(told)


def test_a_changed_payload_is_noticed(spark, tmp_path):
    write_archive(odd_pages(spark).where("page_id < 20"), f"{tmp_path}/a")
    payloads = spark.read.parquet(f"{tmp_path}/a/payloads")
    payloads.withColumn("payload", F.concat("payload", F.lit("!").cast("binary"))).write.parquet(f"{tmp_path}/b/payloads")
    spark.read.parquet(f"{tmp_path}/a/headers").write.parquet(f"{tmp_path}/b/headers")
    with pytest.raises(Exception, match="differs from its address"):
        restored(spark, f"{tmp_path}/b").select("header").collect()


# --- centroid clustering --------------------------------------------------------------


def brute_clusters(rows, k, rounds, width, seed=3, scale=1024):
    kept = []
    for i, v in rows:
        if v is not None and len(v) == width and all(x is not None and math.isfinite(x) for x in v):
            kept.append((i, tuple(math.floor(scale * float(x)) for x in v)))
    order = sorted(kept, key=lambda r: (r[0] is None, hashlib.sha256(f"{seed}:{r[0]}".encode()).hexdigest(), r[1]))
    at = [r[1] for r in order[:k]]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c)), j) for j, c in enumerate(at))

    for _ in range(rounds):
        own = defaultdict(list)
        for _, v in kept:
            own[nearest(v)[1]].append(v)
        at = [tuple(sum(x) // len(own[j]) for x in zip(*own[j])) if j in own else c for j, c in enumerate(at)]
    done = [(i, *nearest(v)) for i, v in kept]
    sums = Counter()
    for _, d, j in done:
        sums[j] += d
    return sorted(((i, j, d, sums[j], sum(sums.values()), hashlib.sha256(",".join(map(str, at[j])).encode()).hexdigest()) for i, d, j in done), key=str)


def test_clusters(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")
    got = centroid_clusters(df)
    assert got.dtypes == [("vec_id", "bigint"), ("cluster", "int"), ("distance", "bigint"), ("cluster_inertia", "bigint"), ("inertia", "bigint"), ("centroid_sha256", "string")]
    assert sorted(map(tuple, got.collect()), key=str) == brute_clusters([(r.vec_id, r.embedding) for r in df.collect()], 8, 10, 64)


@pytest.mark.parametrize("k, rounds", [(1, 3), (2, 0), (5, 6), (40, 4)])
def test_clusters_of_edge_cases(spark, k, rounds):
    rng = random.Random(k)
    rows = [(rng.randint(0, 60), [rng.choice([-1.0, -0.5, 0.0, 0.25, 1.0]) for _ in range(3)]) for _ in range(120)]  # ids repeat, ties abound
    rows += [(None, [0.5, 0.5, 0.5]), (None, None), (70, None), (71, []), (72, [1.0, 2.0]), (73, [1.0, None, 2.0]), (74, [float("nan"), 0.0, 0.0]), (75, [float("-inf"), 0.0, 0.0]), (76, [1.0] * 4)]
    df = spark.createDataFrame([(i, v, i, "x", 1) for i, v in rows], "vec_id long, embedding array<float>, cluster long, v string, part int")
    got = centroid_clusters(df, k=k, rounds=rounds, width=3)
    assert sorted(map(tuple, got.collect()), key=str) == brute_clusters(rows, k, rounds, 3)
    assert centroid_clusters(df.limit(0), width=3).count() == 0
    assert centroid_clusters(df.where("vec_id in (70, 75)"), width=3).count() == 0
    huge = spark.createDataFrame([(1, [1e30, 0.0, 0.0]), (2, [0.0, 0.0, 1.0])], "vec_id long, embedding array<double>")
    assert [r.vec_id for r in centroid_clusters(huge, width=3).collect()] == [2]


def test_bounds_leave_distances_out_and_change_nothing():
    rng = np.random.default_rng(3)
    centres = rng.integers(-900, 900, (20, 16))
    x = (centres[rng.integers(0, 20, 3000)] + rng.integers(-40, 40, (3000, 16))).astype(np.int64)
    at = x[:20].copy()
    state = (np.zeros(3000, np.int32), np.ones(3000, np.int32), np.full(3000, np.inf), np.zeros(3000))
    c, seen = Centroids(at), []
    for _ in range(8):
        seen.append(assigned(x, *state, c))
        every = squared(x[:, None, :], c.at[None, :, :])
        assert (state[0] == every.argmin(1)).all()
        assert (state[2] >= np.sqrt(every.min(1))).all()
        every[np.arange(3000), state[0]] = np.iinfo(np.int64).max
        assert (state[3] <= np.sqrt(every.min(1))).all()
        new = np.array([x[state[0] == j].sum(0) // max(1, (state[0] == j).sum()) for j in range(20)])
        c = Centroids(new, c.at)
    assert seen[0] < 3000 * 20 and seen[-1] < 3000 * 2


# --- importance resampling ------------------------------------------------------------


def brute_features(text):
    words = re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return len(words), [" ".join(words[i:i + k]) for k in (1, 2, 3) for i in range(len(words) - k + 1)]


def brute_resampled(rows, target, percent=5):
    own = [(i, *brute_features(t)) for i, t in rows]
    s, t = (Counter(zlib.crc32(f.encode()) % 10000 for fs in every for f in fs) for every in ([o[2] for o in own], [brute_features(x)[1] for x in target]))
    s_all, t_all = sum(s.values()), sum(t.values())

    def gain(f):
        b = zlib.crc32(f.encode()) % 10000
        return math.floor(1000 * math.log((t[b] + 1) * (s_all + 10000) / ((s[b] + 1) * (t_all + 10000))))

    out, gains = [], {}
    for i, n, fs in own:
        weight = sum(gains.setdefault(f, gain(f)) for f in fs)
        h = int(hashlib.sha256(f"42:{i}".encode()).hexdigest()[:8], 16)
        out.append([i, len(fs), weight, None if i is None else weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None, n])
    order = sorted((o for o in out if o[5] >= 20 and o[0] is not None), key=lambda o: (-o[3], o[0], o[2], o[1]))
    for k, o in enumerate(order[:percent * len(order) // 100], 1):
        o[4] = k
    return sorted(map(tuple, out), key=str)


@pytest.mark.parametrize("percent", [5, 60, 100])
def test_resampling(spark, percent):
    docs = both(spark).withColumn("rank", F.lit("x")).withColumn("bucket", F.lit(1))
    target = spark.read.parquet(f"{SF}/benchmark.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    got = resampled(docs, target, percent)
    assert got.dtypes[:5] == [(n, "bigint") for n in ("doc_id", "n_features", "weight", "score", "rank")]
    assert sorted(map(tuple, got.collect()), key=str) == brute_resampled(rows, [r.text for r in target.collect()], percent)


def test_resampling_of_nothing(spark):
    docs, target = edge_docs(spark), spark.read.parquet(f"{SF}/benchmark.parquet")
    assert resampled(docs.limit(0), target).count() == 0
    none = resampled(docs, target.limit(0))
    assert sorted(map(tuple, none.collect()), key=str) == brute_resampled([(r.doc_id, r.text) for r in docs.collect()], [])
    few = resampled(docs.where("length(text) < 40"), target)
    assert few.where("rank is not null").count() == 0


def test_matrices_give_the_crc_of_every_length():
    rng = random.Random(1)
    data = bytes(rng.randrange(256) for _ in range(5000))
    starts = np.array([rng.randrange(0, 3000) for _ in range(600)])
    lengths = np.array([rng.choice([1, 2, 3, 7, 8, 30, LONG, LONG + 1, 1500]) for _ in range(600)])
    assert crcs(np.frombuffer(data, np.uint8), starts, lengths).tolist() == [zlib.crc32(data[s:s + n]) for s, n in zip(starts, lengths)]


def test_features_stay_inside_texts():
    found = ["One two", "", "two three  four", "é1 one", "x" * 3000 + " y"]
    counts, buckets, owners = hashed_features([t.encode() for t in found])
    assert counts.tolist() == [2, 0, 3, 2, 2]
    for k, t in enumerate(found):
        assert sorted(buckets[owners == k].tolist()) == sorted(zlib.crc32(f.encode()) % 10000 for f in brute_features(t)[1])
