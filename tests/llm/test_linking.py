import random

from marquee.llm import linking, minhash


def groups_of(pairs, nodes):
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in pairs:
        x, y = find(a), find(b)
        parent[max(x, y)] = min(x, y)
    return {n: find(n) for n in nodes}


def test_components_reach_the_smallest_node(spark):
    pick = random.Random(3)
    pairs = [(i, i + 1) for i in range(40, 70)] + [(5, k) for k in range(100, 160)] + [(pick.randrange(200, 240), pick.randrange(200, 240)) for _ in range(30)]
    pairs = [(a, b) for a, b in pairs if a != b]
    found = {r["id"]: r["root"] for r in linking.components(spark.createDataFrame(pairs, "a bigint, b bigint"), "t").collect()}
    assert found == groups_of(pairs, {n for p in pairs for n in p})
    assert linking.components(spark.createDataFrame([], "a bigint, b bigint"), "t").count() == 0


def brute_force(rows, percent=85):
    sets = {}
    for n, (_, text) in enumerate(rows):
        words = (text or "").encode().lower().split()
        sets[n] = {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()
    pairs = []
    for a in sets:
        for b in range(a):
            common = len(sets[a] & sets[b])
            if common and 100 * common >= percent * (len(sets[a]) + len(sets[b]) - common):
                pairs.append((a, b))
    return groups_of(pairs, sets), {n: len(s) for n, s in sets.items()}


def check(rows, found):
    group, size = brute_force([(r["doc_id"], r["text"]) for r in rows])
    least = {}
    for n, r in enumerate(rows):
        if r["doc_id"] is not None:
            least[group[n]] = min(least.get(group[n], r["doc_id"]), r["doc_id"])
    wanted = sorted((str(r["doc_id"]), size[n], str(least.get(group[n], r["doc_id"]))) for n, r in enumerate(rows))
    assert sorted((str(r["doc_id"]), r["n_shingles"], str(r["component_id"])) for r in found) == wanted
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in found)


def test_near_duplicates_match_brute_force(documents, edges, nothing):
    check(documents.collect(), minhash.near_duplicates(documents).collect())
    check(edges.collect(), minhash.near_duplicates(edges).collect())
    assert minhash.near_duplicates(nothing).count() == 0


def test_family_of_edited_copies(spark):
    """Copies of one text with edits; many are too far apart to be linked."""
    pick = random.Random(5)
    base = [f"word{i}" for i in range(160)]
    rows = []
    for n in range(120):
        words = list(base)
        for _ in range(pick.randrange(0, 9)):
            words[pick.randrange(len(words))] = f"edit{n}x{pick.randrange(10**6)}"
        rows.append((n, " ".join(words)))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    check(docs.collect(), minhash.near_duplicates(docs).collect())


def test_estimate_is_close(spark):
    import numpy as np

    shared, own = np.arange(1, 1800, dtype=np.uint64), np.arange(5000, 5200, dtype=np.uint64)
    sets = [minhash._mixed(np.concatenate([shared, own + np.uint64(k * 10**6)])) for k in range(2)]
    truth = len(shared) / (len(shared) + 2 * len(own))
    _, bits = minhash.signatures(np.array([minhash.minima(s) for s in sets]))
    from pyspark.sql import functions as F

    row = spark.createDataFrame([(bits[0].tolist(), bits[1].tolist())], "x array<bigint>, y array<bigint>")
    assert abs(row.select(minhash.estimated_similarity(F.col("x"), F.col("y"))).first()[0] - truth) < 0.2
