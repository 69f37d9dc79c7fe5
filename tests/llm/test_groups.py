"""Components, SimHash near copies and vectors against brute force."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from lamina import session
from lamina.llm import common, pq, simhash
from lamina.llm.components import components
from tests.llm.conftest import SF


class Sets:
    def __init__(self):
        self.parent = {}

    def find(self, x):
        self.parent.setdefault(x, x)
        while self.parent[x] != x:
            x = self.parent[x]
        return x

    def join(self, a, b):
        a, b = sorted((self.find(a), self.find(b)))
        self.parent[b] = a


def slow_fingerprint(text):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    grams = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def slow_groups(rows, distance=2):
    """(id, fingerprint, least reachable id) by comparing all pairs."""
    prints = [slow_fingerprint(t) for _, t in rows]
    sets = Sets()
    for i in range(len(rows)):
        for j in range(i + 1):
            if (prints[i] ^ prints[j]).bit_count() <= distance:
                sets.join(i, j)
    least = {}
    for i, (doc, _) in enumerate(rows):
        if doc is not None:
            root = sets.find(i)
            least[root] = min(doc, least.get(root, doc))
    return sorted(((d, f"{p:016x}", least.get(sets.find(i))) for i, ((d, _), p) in enumerate(zip(rows, prints))), key=repr)


@pytest.mark.parametrize("seed", range(3))
def test_components(spark, seed):
    draw = random.Random(seed)
    edges = [(draw.randrange(300), draw.randrange(300)) for _ in range(200)] + [(i, i + 1) for i in range(1000, 1060)]
    edges += [(5000, i) for i in range(5001, 5100)] + [(7, 7)]
    sets = Sets()
    for a, b in edges:
        sets.join(a, b)
    expected = sorted((x, sets.find(x)) for x in sets.parent if any((x == a or x == b) and a != b for a, b in edges))
    found = components(spark.createDataFrame(edges, "u long, v long"))
    assert sorted(map(tuple, found.collect())) == expected


def test_no_edges(spark):
    assert components(spark.createDataFrame([], "u long, v long")).count() == 0


@pytest.mark.parametrize("distance", [0, 1, 2, 3])
def test_close_links_lose_nothing(spark, distance):
    draw = random.Random(distance)
    prints = {draw.getrandbits(64) for _ in range(150)} | {0, (1 << 64) - 1}
    for base in list(prints)[:40]:
        for _ in range(6):
            flips = draw.sample(range(64), draw.randrange(0, 5))
            prints.add(base ^ sum(1 << b for b in flips))
    dense = draw.getrandbits(64)
    prints |= {dense ^ (1 << a) ^ (1 << b) for a in range(20) for b in range(a, 20)}
    prints = sorted(prints)
    expected = Sets()
    for i, a in enumerate(prints):
        expected.find(a)
        for b in prints[:i]:
            if (a ^ b).bit_count() <= distance:
                expected.join(a, b)
    signed = [(p - (1 << 64) if p >> 63 else p,) for p in prints]
    found = Sets()
    for u, v in simhash.close_links(spark.createDataFrame(signed, "fp long"), distance).collect():
        a, b = u % (1 << 64), v % (1 << 64)
        found.join(a, b)
    assert [found.find(p) for p in prints] == [expected.find(p) for p in prints]


def test_gray_rank(spark):
    rows = spark.range(16).select((F.col("id").bitwiseXOR(F.shiftright("id", 1))).alias("gray"), "id")
    assert all(r["id"] == r["rank"] for r in rows.withColumn("rank", simhash.gray_rank(F.col("gray"))).collect())


def test_simhash_on_documents(documents):
    rows = [tuple(r) for r in documents.select("doc_id", "text").collect()]
    found = simhash.simhash_groups(documents).select("doc_id", "fingerprint", "component_id").collect()
    assert sorted(map(tuple, found), key=repr) == slow_groups(rows)


def test_simhash_on_odd_rows(odd, nothing):
    rows = [tuple(r) for r in odd.select("doc_id", "text").collect()]
    found = simhash.simhash_groups(odd).select("doc_id", "fingerprint", "component_id").collect()
    assert sorted(map(tuple, found), key=repr) == slow_groups(rows)
    assert simhash.simhash_groups(nothing).count() == 0


def test_one_row_of_each_group_stays(odd, documents, nothing):
    for docs in (documents, odd):
        rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
        groups = slow_groups(rows)
        kept = simhash.drop_near_copies(docs)
        assert kept.columns == docs.columns
        ids = [r["doc_id"] for r in kept.collect()]
        leaders = {c for _, _, c in groups if c is not None}
        assert sorted(i for i in ids if i is not None) == sorted(leaders)
        alone = {f for _, f, c in groups if c is None}
        assert ids.count(None) == len(alone)
    assert simhash.drop_near_copies(nothing).count() == 0


def slow_vectors(rows, threshold=0.95):
    """(id, links, least reachable id, kept) from all cosines."""
    usable = [
        i for i, (_, v) in enumerate(rows) if v is not None and all(x is not None and np.isfinite(x) for x in v) and any(v)
    ]
    links, sets = [0] * len(rows), Sets()
    for n, i in enumerate(usable):
        sets.find(i)
        a = np.array(rows[i][1], float)
        for j in usable[:n]:
            b = np.array(rows[j][1], float)
            if len(a) == len(b) and a @ b / (np.linalg.norm(a) * np.linalg.norm(b)) >= threshold:
                links[i] += 1
                links[j] += 1
                sets.join(i, j)
    least = {}
    for i in usable:
        if rows[i][0] is not None:
            least[sets.find(i)] = min(rows[i][0], least.get(sets.find(i), rows[i][0]))
    out = []
    for i, (name, _) in enumerate(rows):
        component = least.get(sets.find(i)) if i in usable else name
        out.append((name, links[i], component, name == component))
    return sorted(out, key=repr)


def vectors_of(df):
    return sorted(map(tuple, df.select("vec_id", "n_links", "component_id", "kept").collect()), key=repr)


def test_vectors(spark):
    draw = np.random.default_rng(5)
    rows = [(r["vec_id"], np.array(r["embedding"])) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()]
    # Copies of some of the vectors, at cosines on both sides of the threshold.
    for i in range(250):
        noise = draw.normal(size=len(rows[0][1]))
        _, v = rows[i % 120]
        scale = draw.uniform(0, 0.45) * np.linalg.norm(v) / np.linalg.norm(noise)
        rows.append((10_000 + i, v + scale * noise))
    df = spark.createDataFrame([(i, v.astype(np.float32).tolist()) for i, v in rows], "vec_id long, embedding array<float>")
    rows = [(r["vec_id"], r["embedding"]) for r in df.collect()]
    expected, found = slow_vectors(rows), vectors_of(pq.near_vectors(df))
    assert [r[0] for r in found] == [r[0] for r in expected]
    assert sum(r[1] for r in found) >= 0.9 * sum(r[1] for r in expected) > 0
    # With the margin that loses nothing, the result is that of brute force.
    assert vectors_of(pq.near_vectors(df, margin=(2 - 2 * 0.95) ** 0.5 + 1e-9)) == expected


@pytest.mark.parametrize("dimensions, rank", [(64, 2), (64, 3), (64, 4), (64, 8), (64, 64), (768, 2), (768, 4), (768, 8)])
def test_recall_by_rank(dimensions, rank):
    """Vectors that have fewer directions than columns, as embeddings do: links lost by the fitted margin."""
    draw = np.random.default_rng(rank)
    many = 3000
    rows = draw.normal(size=(many, rank)) @ draw.normal(size=(rank, dimensions))
    if rank > 4:
        # So many directions have few near vectors by chance: half are near copies of others.
        half = rows[: many // 2]
        size = np.linalg.norm(half, axis=1, keepdims=True) * draw.uniform(0, 0.33, (len(half), 1))
        other = draw.normal(size=(len(half), rank)) @ draw.normal(size=(rank, dimensions))
        rows[many // 2 :] = half + other / np.linalg.norm(other, axis=1, keepdims=True) * size
    rows /= np.linalg.norm(rows, axis=1, keepdims=True)
    model = pq.fit(rows, int(np.ceil(many**0.5)))
    margin = pq.fitted_margin(rows, model.centres, (2 - 2 * pq.THRESHOLD) ** 0.5)
    own, _, _, probed = pq._encode(rows, model, margin)
    probes = np.zeros((many, len(model.centres)), bool)
    for i, p in enumerate(probed):
        probes[i, p] = True
    links = np.triu(rows @ rows.T >= pq.THRESHOLD, 1)
    met = probes[:, own] | probes[:, own].T
    recall = (links & met).sum() / links.sum()
    print(f"dimensions {dimensions} rank {rank} links {links.sum()} recall {recall:.4f} margin {margin:.3f} probes {probes.sum(axis=1).mean():.1f}")
    assert links.sum() > 500 and recall >= 0.97


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    near = [[1.0, 0.1 * k, 0.0, 0.02 * k] for k in range(8)]
    rows = [(i, v) for i, v in enumerate(near)] + [(20 + i, [1.0, 0.0, 0.0, 0.0]) for i in range(9)]
    rows += [(40, None), (41, [0.0, 0.0, 0.0, 0.0]), (42, [nan, 1.0, 0.0, 0.0]), (43, [inf, 1.0, 0.0, 0.0]), (44, [None, 1.0, 0.0, 0.0])]
    rows += [(45, []), (46, [1.0, 0.0]), (47, [2.0, 0.0]), (48, [3e38, 0.0, 0.0, 0.0]), (49, [1e-38, 0.0, 0.0, 0.0])]
    rows += [(None, [0.0, 1.0, 0.0, 0.0]), (None, [0.0, 1.0, 0.0, 0.0]), (50, [-0.0, 0.0, 5.0, 0.0]), (51, [0.0, -0.0, 5.0, 0.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumns({c: F.lit(1) for c in ("v", "node", "u", "own", "label")})
    exact = [(i, r["embedding"]) for i, r in zip([r[0] for r in rows], df.collect())]
    expected = [r if r[2] is not None else (r[0], r[1], None, True) for r in slow_vectors(exact)]
    assert vectors_of(pq.near_vectors(df)) == sorted(expected, key=repr)
    assert pq.near_vectors(df.limit(0)).count() == 0


def test_blocks_of_a_hot_list(spark, monkeypatch):
    """Lists cut into many blocks give the same links."""
    draw = np.random.default_rng(3)
    centre = draw.normal(size=16)
    rows = [(i, (centre + 0.12 * draw.normal(size=16)).astype(np.float32).tolist()) for i in range(260)]
    monkeypatch.setattr(pq, "BLOCK", 32)
    monkeypatch.setattr(pq, "STRIP", 10)
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    exact = [(r["vec_id"], r["embedding"]) for r in df.collect()]
    assert vectors_of(pq.near_vectors(df, margin=0.4)) == slow_vectors(exact)


def test_stored_tables_are_shuffled_by_what_they_scan(spark, tmp_path, settings, monkeypatch):
    """The width follows the bytes of the scans, joined and repeated ones included; the session's is the least and is left as it was."""
    settings(spark__sql__adaptive__coalescePartitions__enabled="false", spark__sql__autoBroadcastJoinThreshold="-1")
    spark.range(20_000).withColumn("k", F.col("id") % 5000).write.parquet(f"{tmp_path}/t")
    table = spark.read.parquet(f"{tmp_path}/t")
    size = common.scanned_bytes(table)
    assert size > 0 and common.scanned_bytes(table.join(table.groupBy("k").count(), "k")) >= 2 * size
    assert common.scanned_bytes(table.mapInArrow(lambda batches: batches, table.schema)) == size

    def files(df):
        stored = common.stash(df, "width")
        assert stored.count() == df.count() and spark.conf.get("spark.sql.shuffle.partitions") == "8"
        return len(stored.inputFiles())

    counts = table.groupBy("k").count()
    assert files(counts) == 8
    monkeypatch.setattr(session, "SHUFFLE_BYTES", -(-size // 24))
    assert files(counts) in (24, 25)
    assert files(spark.createDataFrame([], "k long").groupBy("k").count()) <= 8
