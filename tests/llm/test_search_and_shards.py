import math
import random

import pytest
from pyspark.sql import functions as F

from marquee.llm import mixing, queries, sharding, topk
from tests.support import canonical, duck


def test_top_k_matches_brute_force(spark):
    pick = random.Random(1)
    rows = [(i, [pick.uniform(-1, 1) for _ in range(12)]) for i in range(400)]
    rows += [(i, rows[i - 400][1]) for i in range(400, 460)]
    rows += [(500, None), (550, [1.0, None] + [0.0] * 10), (600, [float("nan")] + [0.0] * 11), (650, [float("inf")] * 12), (700, [0.5, 0.25]), (701, [0.5, 0.5])]
    table = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    found = sorted(tuple(r) for r in topk.top_k(table, lambda i: i % 50 == 0, 5).collect())
    whole = {i: [math.floor(256 * x) for x in v] for i, v in rows if v and all(x is not None and math.isfinite(x) for x in v)}
    wanted = []
    for q in [i for i in whole if i % 50 == 0]:
        scored = sorted((-sum(a * b for a, b in zip(whole[q], v)), i) for i, v in whole.items() if i != q and len(v) == len(whole[q]))
        wanted += [(q, n + 1, i, -s) for n, (s, i) in enumerate(scored[:5])]
    assert found == sorted(wanted)
    assert topk.top_k(table.limit(0), lambda i: i % 50 == 0).count() == 0


def test_queries_of_one_id_keep_their_own_answers(spark):
    pick = random.Random(2)
    rows = [(i, [pick.uniform(-1, 1) for _ in range(6)]) for i in range(60)] + [(50, [pick.uniform(-1, 1) for _ in range(6)])]
    table = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    whole = [(i, [math.floor(256 * x) for x in v]) for i, v in rows]
    wanted = []
    for n, (q, v) in enumerate(whole):
        if q % 50 == 0:
            scored = sorted((-sum(a * b for a, b in zip(v, w)), i) for m, (i, w) in enumerate(whole) if m != n)
            wanted += [(q, k + 1, i, -s) for k, (s, i) in enumerate(scored[:5])]
    assert len(wanted) == 15
    assert sorted(tuple(r) for r in topk.top_k(table, lambda i: i % 50 == 0, 5).collect()) == sorted(wanted)


def test_segment_bounds_hold():
    import numpy as np

    rng = np.random.default_rng(0)
    x, y = rng.integers(-300, 300, (50, 64)), rng.integers(-300, 300, (50, 64))
    last = None
    for segments in (1, 2, 4, 8, 16):
        bound = (topk.segment_statistics(x, segments) * topk.segment_statistics(y, segments)).sum(axis=1)
        assert (bound + 1e-6 >= (x * y).sum(axis=1)).all()
        assert last is None or (bound <= last + 1e-6).all()
        last = bound


@pytest.mark.parametrize("name", ["op3_segment_topk", "op9_source_mix", "op12_centroid_heaps", "op13_merkle_manifest"])
def test_queries_match_sql(spark, small, name):
    found = queries.queries()[name](spark, small)
    wanted = duck(small).execute(queries.oracle_sql()[name])
    columns = [c[0] for c in wanted.description]
    assert canonical(found.columns, [tuple(r) for r in found.collect()]) == canonical(columns, wanted.fetchall())


SCHEMAS = {
    "op1_kd_shards": "doc_id bigint, size bigint, text_crc32 bigint, shard int, slot bigint, law string, grown_shard int",
    "op2_minhash_dedup": "doc_id bigint, n_shingles bigint, component_id bigint, kept boolean",
    "op4_token_files": "doc_id bigint, n_tokens bigint, ids_crc32 bigint, start bigint",
    "op5_byte_bpe": "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string",
    "op6_feistel_pii": "doc_id bigint, found int, changed bigint, text string",
    "op8_line_dedup": "doc_id bigint, lines bigint, dropped bigint, text string",
    "op10_closed_syncmers": "doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double",
    "op11_ngram_jaccard": "doc_id bigint, n_shingles bigint, component_id bigint",
}


@pytest.mark.parametrize("name", sorted(SCHEMAS))
def test_registered_queries_give_a_row_per_document(spark, tmp_path, edges, name):
    """Through the registered name, on nulls, repeated rows and extra columns whose names the operators use."""
    odd = {c: F.lit("own") for c in ("_lines", "_dropped", "_found", "_changed", "_key", "_id", "text_key", "row", "grp", "rank")}
    edges.withColumns(odd).write.parquet(f"{tmp_path}/documents.parquet")
    found = queries.queries()[name](spark, str(tmp_path))
    assert {f.name: f.dataType.simpleString() for f in found.schema} == dict(c.split() for c in SCHEMAS[name].split(", "))
    assert sorted(str(r["doc_id"]) for r in found.collect()) == sorted(str(r["doc_id"]) for r in edges.collect())


def shards_hold(docs, shards):
    rows = sharding.shard(docs, shards).collect()
    assert len(rows) == docs.count()
    for n in {r["shard"] for r in rows}:
        assert sorted(r["slot"] for r in rows if r["shard"] == n) == list(range(sum(r["shard"] == n for r in rows)))
    assert {r["shard"] for r in rows} <= set(range(shards))
    return rows


def test_shards_are_near_equal_and_keep_groups(spark, documents, edges, nothing):
    rows = shards_hold(documents, 8)
    sizes = [sum(r["size"] for r in rows if r["shard"] == n) for n in range(8)]
    assert max(sizes) - min(sizes) <= 2 * max(r["size"] for r in rows)
    key = {r["doc_id"]: r["shard"] for r in rows}
    texts = {}
    for r in documents.collect():
        texts.setdefault(r["text"], set()).add(key[r["doc_id"]])
    assert all(len(s) == 1 for s in texts.values())
    shards_hold(edges, 4)
    assert sharding.shard(nothing, 4).count() == 0


def test_hot_group_of_copies_is_spread(spark):
    rows = [(i, "same text of a large group" if i % 2 else f"text number {i} {'x' * (i % 40)}", "en", "s") for i in range(800)]
    found = shards_hold(spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string"), 8)
    sizes = [sum(r["size"] for r in found if r["shard"] == n) for n in range(8)]
    assert max(sizes) < 1.2 * sum(sizes) / 8


def test_mix_meets_its_targets(spark, documents, edges, nothing):
    for docs in (documents, edges):
        rows = mixing.mix_words(docs).collect()
        assert len(rows) == docs.count()
        by_source = {}
        for r in rows:
            assert 0 <= r["taken"] <= 2 * r["size"] and r["target"] <= 2 * r["source_size"]
            by_source.setdefault(r["source"], []).append(r)
        for own in by_source.values():
            assert abs(sum(r["taken"] for r in own) - own[0]["target"]) <= len(own) + 1
        assert abs(sum(own[0]["target"] for own in by_source.values()) - 1.5 * sum(r["size"] for r in rows)) < 1e-3
        again = sorted(map(str, mixing.mix_words(docs.repartition(3)).collect()))
        assert again == sorted(map(str, rows))
    assert mixing.mix_words(nothing).count() == 0


def test_mixed_documents_repeat_whole_texts(documents):
    taken = {r["doc_id"]: (r["taken"], r["size"]) for r in mixing.mix_words(documents).collect()}
    mixed = mixing.mix_documents(documents)
    assert mixed.columns == documents.columns
    times = {r["doc_id"]: r["n"] for r in mixed.groupBy("doc_id").agg(F.count("*").alias("n")).collect()}
    assert times == {i: -(-t // s) for i, (t, s) in taken.items() if t}
