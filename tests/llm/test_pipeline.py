import collections
import hashlib
import re

import corpus_pipeline
import numpy as np
import public_tokenizers
import tiktoken

from marquee.llm import byte_bpe, toxicity
from tests.llm.test_linking import brute_force, groups_of


def plain_lines(text):
    """Normalised lines: lower-case words of letters and digits, by the classes that the operator states."""
    words = [[w for w in re.split(r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\xBF\u2000-\u206F\u3000-\u303F]+", line.lower()) if w] for line in text.split("\n")]
    return [" ".join(w) for w in words]


def edit_distance(a, b, most):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
        if min(row) > most:
            return most + 1
    return row[-1]


def line_groups(lines):
    """Connected groups of lines by edit similarity, over all pairs."""
    chars = sorted(set("".join(lines)))
    at = {c: i for i, c in enumerate(chars)}
    bags = np.zeros((len(lines), len(chars)), np.int32)
    for n, line in enumerate(lines):
        for c in line:
            bags[n, at[c]] += 1
    sizes = bags.sum(axis=1)
    pairs = []
    for n in range(len(lines)):
        most = np.floor(np.maximum(sizes[:n], sizes[n]) * 0.1 + 1e-9)
        near = np.flatnonzero(np.maximum(np.clip(bags[:n] - bags[n], 0, None).sum(axis=1), np.clip(bags[n] - bags[:n], 0, None).sum(axis=1)) <= most)
        pairs += [(n, m) for m in near.tolist() if edit_distance(lines[n], lines[m], int(most[m])) <= most[m]]
    return groups_of(pairs, range(len(lines)))


def check_lines(before, after):
    """What stays lies between the first of each group over all pairs and the first of each equal line."""
    order = sorted(before, key=lambda r: r["doc_id"])
    found = {r["doc_id"]: (r["text"] or "").split("\n") for r in after}
    plain = {r["doc_id"]: list(zip((r["text"] or "").split("\n"), plain_lines(r["text"] or ""))) for r in order}
    distinct = sorted({p for lines in plain.values() for _, p in lines if p})
    group = dict(zip(distinct, line_groups(distinct).values()))

    def firsts(name):
        seen, out = set(), {}
        for doc_id, lines in plain.items():
            out[doc_id] = [line for line, p in lines if not p or not (name(p) in seen or seen.add(name(p)))]
        return out

    def inside(part, whole):
        rest = iter(whole)
        return all(any(line == other for other in rest) for line in part)

    least, most = firsts(group.get), firsts(lambda p: p)
    assert set(found) == set(plain)
    for doc_id, lines in found.items():
        assert inside([x for x in least[doc_id] if x], lines) and inside([x for x in lines if x], most[doc_id]), doc_id
    count = lambda texts: sum(x != "" for lines in texts.values() for x in lines)
    assert count(most) - count(found) >= 0.9 * (count(most) - count(least))
    return count({d: [x for x, _ in lines] for d, lines in plain.items()}) - count(found)


def check_mix(before, after):
    """Words taken of each source come near the shares 5, 2, 1 of 150 %, up to twice what there is."""
    size = {r["doc_id"]: len(re.findall(r"[^\x20\x09-\x0D]+", r["text"] or "")) for r in before}
    source = {r["doc_id"]: r["source"] for r in before}
    whole = collections.Counter()
    for doc_id, n in size.items():
        whole[source[doc_id]] += n
    names = sorted(whole, key=lambda s: (s is None, s or ""))
    weight, target = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}, {}
    left, free = 1.5 * sum(whole.values()), set(names)
    while free:
        share = {s: left * weight[s] / sum(weight[t] for t in free) for s in free}
        full = {s for s in free if share[s] > 2 * whole[s]}
        target |= {s: 2 * whole[s] for s in full} or share
        left, free = left - sum(2 * whole[s] for s in full), free - full if full else set()
    taken, times = collections.Counter(), collections.Counter(r["doc_id"] for r in after)
    for doc_id, n in times.items():
        taken[source[doc_id]] += n * size[doc_id]
    assert max(times.values()) <= 2 and set(times) <= set(size)
    for s in names:
        assert abs(taken[s] - target[s]) <= max(n for d, n in size.items() if source[d] == s), s


def test_stages_take_effect(spark, small, documents):
    ranks = byte_bpe.read_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    library = tiktoken.Encoding("plain", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    docs = documents
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, small)
        assert out.columns == documents.columns, name
        before, after = {r["doc_id"]: r for r in docs.collect()}, out.collect()
        if name == "toxicity":
            model = toxicity.fit(documents, spark.read.parquet(f"{small}/labels.parquet"))
            gone = {r["doc_id"] for r in toxicity.scores(docs, model).collect() if r["predicted"]}
            assert {r["doc_id"] for r in after} == set(before) - gone and gone
            assert all(r == before[r["doc_id"]] for r in after)
        if name == "line dedup":
            assert check_lines(before.values(), after) > 0
            assert all(r["n_chars"] == len(r["text"] or "") for r in after if r["text"] != before[r["doc_id"]]["text"])
        if name == "near-dedup":
            rows = sorted(before.values(), key=lambda r: r["doc_id"])
            group, _ = brute_force([(r["doc_id"], r["text"]) for r in rows])
            least = {}
            for n, r in enumerate(rows):
                least.setdefault(group[n], r["doc_id"])
            assert sorted(r["doc_id"] for r in after) == sorted(least.values())
        if name == "mixing":
            assert all(r == before[r["doc_id"]] for r in after)
            check_mix(before.values(), after)
        docs = spark.createDataFrame(after, documents.schema)
    wanted = []
    for r in docs.collect():
        ids = library.encode_ordinary(r["text"] or "")
        wanted.append((r["doc_id"], len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256((r["text"] or "").encode()).hexdigest()))
    final = corpus_pipeline.STAGES[-1][1](spark, docs, small)
    assert sorted(tuple(r) for r in final.select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256").collect()) == sorted(wanted)


def test_stages_on_odd_rows(spark, small, edges, nothing):
    """Nulls, repeated rows, empty tables, and extra columns under the names that stages use."""
    from pyspark.sql import functions as F

    odd = {c: F.lit("own") for c in ("_id", "_key", "_text_key", "_lines", "_dropped", "own_id", "gone_key", "row")}
    for docs in (edges.withColumns(odd), nothing.withColumns(odd)):
        rows = {str(tuple(r[c] for c in odd)) for r in docs.collect()}
        for name, stage in corpus_pipeline.STAGES[1:4]:
            out = stage(spark, docs, small)
            assert out.columns == docs.columns, name
            assert {str(tuple(r[c] for c in odd)) for r in out.collect()} == rows, name
        assert corpus_pipeline.STAGES[4][1](spark, docs, small).count() == docs.count()
