"""Operators 11 to 13 against plain Python."""

import hashlib
import math
import random
import zlib

import numpy as np
from pyspark.sql import functions as F

from marquee.llm import centroids, merkle, ngram_join
from tests.llm.test_linking import groups_of

# --- n-gram Jaccard join ------------------------------------------------------


def shingle_sets(texts, words=4):
    found = []
    for text in texts:
        parts = (text or "").encode().lower().split()
        found.append({tuple(parts[i : i + words]) for i in range(max(1, len(parts) - words + 1))} if parts else set())
    return found


def check_links(docs, percent=85):
    rows = docs.collect()
    sets = shingle_sets([r["text"] for r in rows])
    pairs = []
    for a in range(len(sets)):
        for b in range(a):
            common = len(sets[a] & sets[b])
            if common and 100 * common >= percent * (len(sets[a]) + len(sets[b]) - common):
                pairs.append((a, b))
    group, least = groups_of(pairs, range(len(sets))), {}
    for n, r in enumerate(rows):
        if r["doc_id"] is not None:
            least[group[n]] = min(least.get(group[n], r["doc_id"]), r["doc_id"])
    wanted = sorted((str(r["doc_id"]), len(sets[n]), str(least.get(group[n], r["doc_id"]))) for n, r in enumerate(rows))
    found = ngram_join.linked_documents(docs, percent).collect()
    assert sorted((str(r["doc_id"]), r["n_shingles"], str(r["component_id"])) for r in found) == wanted
    return len(pairs)


def test_links_match_brute_force(documents, edges, nothing):
    assert check_links(documents) > 0
    assert check_links(edges) > 0
    assert ngram_join.linked_documents(nothing).count() == 0


def edited_family(seed, copies, most, length=160):
    """Copies of a text with edits, so that many pairs lie on either side of the threshold."""
    pick = random.Random(seed)
    base = [f"word{i}" for i in range(length)]
    rows = []
    for n in range(copies):
        words = list(base)
        for _ in range(pick.randrange(0, most)):
            words[pick.randrange(len(words))] = f"edit{n}x{pick.randrange(10**6)}"
        rows.append((n, " ".join(words[: length - pick.randrange(0, 20)])))
    return rows


def test_family_with_and_without_frequent_shingles(spark, monkeypatch):
    rows = edited_family(5, 110, 10) + [(1000 + i, t) for i, t in edited_family(6, 60, 30)]
    rows += [(2000 + n, f"own{n} words{n} " + " ".join(f"passage{i}" for i in range(40)) + f" tail{n}") for n in range(40)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    assert check_links(docs) > 100
    assert check_links(docs, 70) > 1000
    # the choice of frequent shingles changes the work only
    monkeypatch.setattr(ngram_join, "MOST_FREQUENT", 8)
    assert check_links(docs) > 100


def test_prefixes_of_similar_sets_meet():
    pick = random.Random(11)
    frequent = np.array(sorted(pick.sample(range(1, 400), 150)), np.uint64)
    for _ in range(400):
        x = set(pick.sample(range(1, 400), pick.randrange(1, 120)))
        y = set(x)
        for _ in range(pick.randrange(0, 14)):
            y ^= {pick.randrange(1, 400)}
        common = len(x & y)
        a, b = (np.array(sorted(s), np.uint64) for s in (x, y))
        if common and 100 * common >= 85 * len(x | y):
            assert set(ngram_join.prefix(a, frequent, 85)) & set(ngram_join.prefix(b, frequent, 85))
        differ = sum(bin(int(p) & (2**64 - 1)).count("1") for p in (ngram_join.parity(a) ^ ngram_join.parity(b)).tolist())
        assert differ <= len(x ^ y)


def test_frequent_shingles_are_counted_over_all_rows(spark):
    rows = [(i, f"a b c d e own{i} more{i}") for i in range(40)] + [(100 + i, f"rare{i % 3} x y z") for i in range(20)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(7)
    wanted = {}
    for _, text in rows:
        for s in ngram_join.shingles(text.encode()).tolist():
            wanted[s] = wanted.get(s, 0) + 1
    assert ngram_join.frequent_shingles(docs).tolist() == sorted(s for s, n in wanted.items() if n >= ngram_join.FREQUENT)


# --- centroid clustering ------------------------------------------------------


def lloyd(vectors, k, rounds):
    """(cluster, distance) of integer vectors by plain rounds, and the final centroids."""
    order = sorted(range(len(vectors)), key=lambda n: (hashlib.sha256(f"2:{vectors[n][0]}".encode()).hexdigest(), vectors[n][1]))
    means = [list(vectors[n][1]) for n in order[:k]]

    def assign():
        out = []
        for _, v in vectors:
            out.append(min((sum((x - c) ** 2 for x, c in zip(v, mean)), i) for i, mean in enumerate(means)))
        return out

    for _ in range(rounds):
        at = assign()
        for i in range(len(means)):
            own = [v for (_, v), (_, c) in zip(vectors, at) if c == i]
            if own:
                means[i] = [sum(xs) // len(own) for xs in zip(*own)]
    return assign(), means


def check_clusters(spark, rows, k, rounds, size):
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>, cluster string, ids int").repartition(3)
    usable = [(r[0], [math.floor(256 * float(np.float32(x))) for x in r[1]]) for r in rows if r[1] is not None and len(r[1]) == size and all(x is not None and math.isfinite(x) for x in r[1])]
    found, means = centroids.cluster(df, k, rounds, size)
    wanted, exact = lloyd([("" if i is None else i, v) for i, v in usable], k, rounds)
    assert means.tolist() == exact
    assert sorted((str(r["vec_id"]), r["cluster"], r["distance"]) for r in found.collect()) == sorted((str(i), c, d) for (i, _), (d, c) in zip(usable, wanted))


def test_clusters_match_plain_rounds(spark, monkeypatch):
    monkeypatch.setattr(centroids, "BLOCK_VECTORS", 37)
    pick = random.Random(4)
    middles = [[pick.uniform(-0.5, 0.5) for _ in range(6)] for _ in range(5)]
    rows = [(n, [m + pick.gauss(0, 0.1) for m in pick.choice(middles)], "x", 1) for n in range(300)]
    rows += [(n, [pick.choice([-0.25, 0.25]) for _ in range(6)], "x", 1) for n in range(300, 420)]  # many ties
    rows += [(7, [0.1] * 6, "x", 1), (7, [0.1] * 6, "x", 1), (None, [0.2] * 6, "x", 1)]
    rows += [(900, None, "x", 1), (901, [], "x", 1), (902, [0.1] * 5, "x", 1), (903, [0.1, None, 0.1, 0.1, 0.1, 0.1], "x", 1), (904, [0.1] * 5 + [float("nan")], "x", 1), (905, [0.1] * 5 + [float("inf")], "x", 1)]
    check_clusters(spark, rows, 8, 5, 6)
    check_clusters(spark, rows, 1, 2, 6)
    check_clusters(spark, rows[:5], 40, 3, 6)


def test_no_usable_vector(spark):
    rows = [(1, None, "x", 1), (2, [0.5], "x", 1)]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>, cluster string, ids int")
    assert centroids.clusters_with_inertia(df).count() == 0
    assert centroids.clusters_with_inertia(df.limit(0)).columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]


def test_heaps_spare_most_vectors():
    """Bounds hold after any move, and settled vectors are not compared again."""
    pick = np.random.default_rng(8)
    vecs = np.concatenate([pick.integers(-20, 20, (200, 8)) + pick.integers(-200, 200, 8) for _ in range(6)])
    means = vecs[::200].copy()
    block, loss, compared = centroids.Block(vecs, means), np.zeros(6), []
    for _ in range(6):
        moved = centroids._moved(means, [[*s, n] for s, n in zip(block.sums.tolist(), block.counts.tolist())])
        loss, means = loss + centroids._loss(means, moved), moved
        compared.append(block.move(means, loss))
        exact = centroids.squared_distances(vecs, means)
        assert (block.cluster == exact.argmin(axis=1)).all()
        assert all(heap[i] >= heap[(i - 1) // 2] for heap in block.heaps for i in range(1, len(heap)))
        sums = np.zeros_like(means)
        np.add.at(sums, block.cluster, vecs)
        assert (sums == block.sums).all()
    assert sum(compared) < len(vecs)


def test_distances_beyond_doubles_are_exact():
    vecs = np.array([[2**27 - 1, -(2**27) + 3], [5, 7]], np.int64)
    means = np.array([[-(2**27), 2**27 - 1], [1, 2]], np.int64)
    wanted = [[sum((int(x) - int(c)) ** 2 for x, c in zip(v, m)) for m in means] for v in vecs]
    assert centroids.squared_distances(vecs, means).tolist() == wanted


# --- Merkle manifest ----------------------------------------------------------


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def tree(nodes):
    """The top of a list of digests, and for each the digests beside its way up."""
    paths, at, now = [[] for _ in nodes], list(range(len(nodes))), list(nodes)
    while len(now) > 1:
        for n, i in enumerate(at):
            beside = i ^ 1
            if beside < len(now):
                paths[n].append((now[beside], beside < i))
            else:
                paths[n].append((None, False))
            at[n] = i // 2
        now = [sha("".join(now[i : i + 2])) for i in range(0, len(now), 2)]
    return now[0], paths


def leaf_of(r, more=0):
    values = [r["doc_id"], r["source"], r["lang"], None if r["n_chars"] is None else r["n_chars"] + more, r["text"]]
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def plain_manifest(rows):
    groups = {}
    for r in rows:
        groups.setdefault(r["lang"], []).append(r)
    order = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    for g in order:
        groups[g].sort(key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, leaf_of(r)))
    low = {g: tree([leaf_of(r) for r in groups[g]]) for g in order}
    root, high = tree([low[g][0] for g in order])
    out = []
    for n, g in enumerate(order):
        for r, path in zip(groups[g], low[g][1]):
            way = path + high[n]
            odd = r["doc_id"] is not None and r["n_chars"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 7 == 0
            node = leaf_of(r, 1 if odd else 0)
            for beside, is_left in way:
                node = sha((beside + node if is_left else node + beside) if beside else node)
            proof = sha("".join(b for b, _ in way if b))
            out.append((str(r["doc_id"]), leaf_of(r), low[g][0], root, proof, node, node == root))
    return sorted(out)


def check_manifest(docs):
    found = merkle.document_manifest(docs)
    assert found.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    assert sorted((str(r[0]), *r[1:]) for r in found.collect()) == plain_manifest(docs.collect())


def test_manifest_matches_plain_trees(edges, nothing, documents, monkeypatch):
    check_manifest(edges)
    assert merkle.document_manifest(nothing).count() == 0
    monkeypatch.setattr(merkle, "BLOCK_LEAVES", 4)  # several tiers
    check_manifest(documents)


def test_one_leaf_is_the_root(spark, edges):
    row = merkle.document_manifest(edges.filter("doc_id = 2")).first()
    assert row["leaf"] == row["subroot"] == row["root"] and row["proof_sha256"] == sha("")


def test_wider_trees(spark, monkeypatch):
    """Runs of three, several tiers, and proofs that lead to the root."""
    monkeypatch.setattr(merkle, "BLOCK_LEAVES", 9)
    rows = spark.range(100).select(F.col("id"), F.lit("g").alias("kind"), F.sha2(F.col("id").cast("string"), 256).alias("leaf"))
    found = merkle.manifest(rows, "kind", ["id"], "leaf", 3)
    now = [sha(str(i)) for i in range(100)]
    while len(now) > 1:
        now = [sha("".join(now[i : i + 3])) for i in range(0, len(now), 3)]
    checked = found.select("root", merkle.folded(F.col("leaf"), F.col("proof")).alias("again"), F.size("proof").alias("steps")).distinct().collect()
    assert [tuple(r) for r in checked] == [(now[0], now[0], 5)]
