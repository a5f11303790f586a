import datetime
import hashlib
import random

from pyspark.sql import functions as F

from marquee.llm import line_dedup, pii, syncmers, toxicity


def test_repeated_and_fuzzy_lines_go(spark, edges, nothing):
    pick = random.Random(2)
    long_line = " ".join(f"term{pick.randrange(10**6)}" for _ in range(300))
    rows = [
        (2, "First own line here\nA shared line, twice.\n" + long_line), (1, "a SHARED line twice\nanother one of mine"),
        (3, long_line.replace("term", "Term", 3) + " extra\nok\nok"), (None, "A shared line - twice"), (4, None), (5, ""),
    ]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    found = {r["doc_id"]: r["text"] for r in line_dedup.dedup_lines(docs).collect()}
    assert found[1] == rows[1][1] and found[2] == "First own line here\n" + long_line
    assert found[3] == "ok\nok" and found[None] == "" and found[4] is None and found[5] == ""
    kept = line_dedup.dedup_lines(edges)
    assert kept.count() == edges.count() and kept.columns[: len(edges.columns)] == edges.columns
    assert line_dedup.dedup_lines(nothing).count() == 0


def naive_simhash(words, hashes):
    bits = 0
    for b in range(64):
        if 2 * sum((h >> b) & 1 for h in hashes) > len(words):
            bits |= 1 << b
    return bits - 2**64 if bits >= 2**63 else bits


def test_simhash_matches_a_plain_count(spark):
    pick = random.Random(4)
    lines = [" ".join(f"w{pick.randrange(50)}" for _ in range(n)) for n in (2, 3, 50, 999, 30_000)]
    docs = spark.createDataFrame([(n, t) for n, t in enumerate(lines)], "doc_id bigint, text string")
    for r in line_dedup._distinct_lines(docs).collect():
        words = lines[r["first"]["doc_id"]].split()
        hashes = {w: h for w, h in spark.createDataFrame([(w,) for w in set(words)], "w string").select("w", F.xxhash64("w")).collect()}
        assert r["hash"] == naive_simhash(words, [hashes[w] % 2**64 for w in words])


def test_line_groups_match_brute_force(spark, documents):
    """Equal lines, and at most the pairs of lines whose SimHashes are near."""
    distinct = line_dedup._distinct_lines(documents).collect()
    lines = sum(r["copies"] for r in distinct)
    near = [
        (a, b) for n, a in enumerate(distinct) for b in distinct[:n]
        if bin((a["hash"] ^ b["hash"]) % 2**64).count("1") <= line_dedup.DISTANCE
    ]
    dropped = sum(len(r["drop"]) for r in line_dedup.dropped_lines(documents).collect())
    assert lines - len(distinct) <= dropped <= lines - len(distinct) + len(near)


def test_pseudonyms_are_valid_linked_and_one_to_one(spark):
    values = ["4539578763621486", "4539 5787 6362 1486", "4539578763621487", "+1 (668) 555-2281", "1-668-555-2281", "+1 (068) 555-2281", "19.158.174.88",
              "300.1.1.1", "2019-05-03", "03/05/2019", "2019-02-30", "219-09-9999", "000-12-3456", "olm.80@mail9.example.com", "+49 30 1234567"]
    docs = spark.createDataFrame([(n, f"before {v} after") for n, v in enumerate(values)], "doc_id bigint, text string")
    found = {r["doc_id"]: r["text"] for r in pii.pseudonymise(docs, "k").collect()}
    new = {v: found[n][len("before ") : -len(" after")] for n, v in enumerate(values)}
    assert all(found[n].startswith("before ") and found[n].endswith(" after") for n in found)
    for kept in ("4539578763621487", "+1 (068) 555-2281", "300.1.1.1", "2019-02-30", "000-12-3456"):
        assert new[kept] == kept
    for moved in ("4539578763621486", "+1 (668) 555-2281", "19.158.174.88", "2019-05-03", "219-09-9999", "olm.80@mail9.example.com", "+49 30 1234567"):
        assert new[moved] != moved and len(new[moved]) in (len(moved), *range(7, 16))
    card = new["4539578763621486"]
    assert new["4539 5787 6362 1486"].replace(" ", "") == card
    total = sum(d if i % 2 == 0 else d * 2 - 9 * (d > 4) for i, d in enumerate(map(int, reversed(card))))
    assert total % 10 == 0 and card[0] == "4"
    day = datetime.date.fromisoformat(new["2019-05-03"])
    assert new["03/05/2019"] == day.strftime("%d/%m/%Y")
    again = {r["doc_id"]: r["text"] for r in pii.pseudonymise(docs, "k").collect()}
    other = {r["doc_id"]: r["text"] for r in pii.pseudonymise(docs, "other").collect()}
    assert again == found and other != found


def test_dates_are_one_to_one(spark):
    """Two days never share a pseudonym, whichever way they are written, and a reading stays a reading."""
    first = datetime.date(1899, 6, 1)
    days = [first + datetime.timedelta(days=n) for n in range(0, 74_000, 3)] + [datetime.date(y, 2, 29) for y in range(1904, 2100, 4)]
    texts = sorted({d.strftime("%d/%m/") + f"{d.year:04}" for d in days} | {d.strftime("%m/%d/") + f"{d.year:04}" for d in days})
    df = spark.createDataFrame([(t,) for t in texts], "v string").repartition(4)
    found = {r["v"]: r["p"] for r in df.select("v", pii.pseudonym(F.col("v"), "k").alias("p")).collect()}
    assert len(set(found.values())) == len(found)
    late = [t for t in texts if int(t[3:5]) > 12 and 1900 <= int(t[6:]) < 2100]
    assert all(found[t] != t or t[:5] == "02/29" for t in late[:50]) and len(late) > 10_000
    for t in late:
        m, d, y = map(int, found[t].split("/"))
        assert datetime.date(y, m, d).day > 12


def test_permutations_are_one_to_one(spark):
    numbers = spark.range(0, 72).select(pii.permuted_number(F.col("id"), (9, 8), "k", "t").alias("x"))
    assert sorted(r["x"] for r in numbers.collect()) == list(range(72))
    digits = spark.range(0, 1000).select(pii.permuted_numerals(F.lpad(F.col("id").cast("string"), 3, "0"), 10, "k", "t").alias("x"))
    assert sorted(r["x"] for r in digits.collect()) == [f"{n:03}" for n in range(1000)]


def test_clean_texts_and_columns_stay(edges, nothing):
    found = pii.pseudonymise(edges, "k")
    assert found.columns[: len(edges.columns)] == edges.columns
    before = sorted((str(r["doc_id"]), str(r["text"])) for r in edges.collect() if r["doc_id"] != 12)
    assert before == sorted((str(r["doc_id"]), str(r["text"])) for r in found.collect() if r["doc_id"] != 12)
    assert pii.pseudonymise(nothing, "k").count() == 0


def test_edited_texts_and_fingerprints(spark, documents, edges, nothing):
    for docs in (documents, edges):
        rows = sorted(docs.collect(), key=lambda r: (r["doc_id"] is None, -(r["doc_id"] or 0), hashlib.md5((r["text"] or "").encode()).digest()))
        wanted = []
        for n, row in enumerate(rows):
            text, following = row["text"] or "", rows[(n + 1) % len(rows)]["text"] or ""
            cut = len(text) // 3
            edited = text[: len(text) - cut] + following[:cut]
            wanted.append((str(row["doc_id"]), len(text), hashlib.sha256(edited.encode()).hexdigest()))
        found = syncmers.edited_fingerprints(docs).collect()
        assert sorted((str(r["doc_id"]), r["n_chars"], r["edited_sha256"]) for r in found) == sorted(wanted)
        assert all(0 <= r[c] <= 1 for r in found for c in ("near_edited", "near_next"))
    assert syncmers.edited_fingerprints(nothing).count() == 0


def test_anchors_are_closed_syncmers(spark, documents):
    rows = syncmers.with_anchors(documents.withColumn("units", syncmers.unit_hashes(F.col("text"))), "text", "places", "marks").limit(20)
    rows = rows.withColumn("inner", syncmers._inner(F.col("units"))).collect()
    for r in rows:
        n, last = len(r["units"]), syncmers.K - syncmers.S
        g = r["inner"]
        wanted = [i for i in range(n - syncmers.K + 1) if min(g[i : i + last + 1]) in (g[i], g[i + last])]
        assert r["places"] == (wanted if n >= syncmers.K else [0] * bool(n)) and len(r["marks"]) == len(r["places"])


def test_toxicity_on_held_out_rows(spark, documents, edges, nothing):
    bad = ["vilespit", "grobsnark", "dreckmaul"]
    pick = random.Random(6)
    words = [f"{a}{b}" for a in ("lo", "mi", "ra", "te", "su") for b in ("na", "pe", "vi", "do", "ka")]
    rows, labels = [], []
    for n in range(400):
        text = [pick.choice(words) for _ in range(pick.randrange(20, 200))]
        toxic = n % 5 == 0
        if toxic:
            text.insert(pick.randrange(len(text)), pick.choice(bad))
        rows.append((n, " ".join(text)))
        labels.append((n, int(toxic)))
    docs = spark.createDataFrame([*rows, (None, None), (1000, "")], "doc_id bigint, text string")
    marks = spark.createDataFrame([*labels, (2000, 1), (3, None)], "doc_id bigint, toxic int")
    model = toxicity.fit(docs, marks)
    truth = dict(labels)
    scored = toxicity.scores(docs, model).collect()
    held = [r for r in scored if r["held_out"] and r["doc_id"] in truth]
    assert len(held) > 40 and all(r["predicted"] == truth[r["doc_id"]] for r in held)
    assert all(0 <= r["score"] <= 1 for r in scored) and len(scored) == 402
    assert toxicity.without_toxic(edges, model).columns == edges.columns
    assert toxicity.scores(nothing, model).count() == 0
    blank = toxicity.fit(docs, marks.limit(0))
    assert {r["score"] for r in toxicity.scores(docs, blank).collect()} == {0.5}


def test_model_scores_do_not_depend_on_batches():
    import numpy as np

    texts = ["abc def", "", "xyz " * 50, "ABC"]
    owner, feature = toxicity.text_features(texts)
    vocabulary = toxicity.Vocabulary(np.unique(feature), np.ones(len(np.unique(feature))))
    for n, text in enumerate(texts):
        assert sorted(vocabulary.features[vocabulary.present([text])[1]]) == sorted(feature[owner == n])


def test_similar_lines_match_edit_distance(spark):
    """Words in common at both ends change nothing: against a plain edit distance."""
    pick = random.Random(8)

    def distance(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            last, row[0] = row[0], i
            for j, y in enumerate(b, 1):
                last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
        return row[-1]

    rows = [("same", ["a", "b"], ["a", "b"]), ("none", [], ["a"]), ("tail", ["ab"] * 30, ["ab"] * 31), ("over", ["x", "x", "y"], ["x", "y"])]
    for n in range(150):
        a = [pick.choice(["tea", "cup", "é", "river"]) for _ in range(pick.randrange(1, 40))]
        b = list(a)
        for _ in range(pick.randrange(0, 4)):
            at = pick.randrange(len(b) + 1)
            b[at : at + pick.randrange(2)] = [pick.choice(["tea", "cap", "zz"])][: pick.randrange(2)]
        rows.append((str(n), a, b))
    near = {
        n for n, a, b in rows
        if distance(" ".join(a), " ".join(b)) <= int(max(len(" ".join(a)), len(" ".join(b))) * (1 - line_dedup.SIMILARITY) + 1e-9)
    }
    pairs = spark.createDataFrame(rows, "id string, wa array<string>, wb array<string>")
    assert {r["id"] for r in line_dedup.similar(pairs, "t").collect()} == near


def test_fuzzy_lines_of_all_lengths_go(spark):
    """Recall against plain edit similarity, for lines of 4 to 400 words with one word replaced and with letters mistyped."""
    pick = random.Random(12)

    def word():
        return "".join(pick.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(pick.randrange(4, 8)))

    def distance(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            last, row[0] = row[0], i
            for j, y in enumerate(b, 1):
                last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
        return row[-1]

    lines, truth, kinds = [], {}, {}
    for n in (4, 6, 10, 20, 30, 50, 100, 400):
        for kind in ("replaced", "mistyped", "unlike"):
            for _ in range({100: 6, 400: 1}.get(n, 15)):
                a = [word() for _ in range(n)]
                b = list(a)
                if kind == "replaced":
                    b[pick.randrange(n)] = word()
                for at in pick.sample(range(n), {"mistyped": max(1, n // 10), "unlike": n * 2 // 3}.get(kind, 0)):
                    b[at] = b[at][:-1] + "0" if kind == "mistyped" else word()
                x, y = " ".join(a), " ".join(b)
                truth[len(lines) + 1] = distance(x, y) <= int(max(len(x), len(y)) * (1 - line_dedup.SIMILARITY) + 1e-9)
                kinds[len(lines) + 1] = n, kind
                lines += [x, y]
    docs = spark.createDataFrame(list(enumerate(lines)), "doc_id bigint, text string")
    gone = {r["doc_id"] for r in line_dedup.dropped_lines(docs).collect()}
    real = {i for i, near in truth.items() if near}
    assert gone <= real
    for n in (4, 6, 10, 20, 30, 50, 100, 400):
        for kind in ("replaced", "mistyped"):
            wanted = {i for i in real if kinds[i] == (n, kind)}
            assert (wanted or n < 10) and len(wanted & gone) >= 0.95 * len(wanted)


def test_frequent_words_make_no_common_block(spark):
    """Lines that only share words which each of them repeats are not all candidates of each other."""
    pick = random.Random(15)
    lines = [" ".join(["the"] * 6 + ["of"] * 4 + [f"w{pick.randrange(10**9)}" for _ in range(20)]) for _ in range(300)]
    df = spark.createDataFrame([(n, t) for n, t in enumerate(lines)], "id bigint, plain string")
    signed = line_dedup.with_signatures(df, ["id"], "plain")
    sizes = [r["count"] for r in signed.select(F.explode("blocks").alias("b")).groupBy("b").count().collect()]
    assert max(sizes) <= 60 and sum(n * (n - 1) // 2 for n in sizes) < 300 * 299 // 20


def test_runs_of_characters_bound_the_edits(spark):
    """Lines within the edits stay pairs by letters, profiles and runs; unlike lines of the same letters do not."""
    import pyarrow as pa

    pick = random.Random(16)
    near, far = [], []
    for n in (1, 2, 3, 12, 80, 400, 3000):
        for _ in range(20):
            a = [pick.choice("abcde é東") for _ in range(n)]
            b = list(a)
            for _ in range(n // 10):
                at = pick.randrange(len(b))
                b[at : at + pick.randrange(2)] = [pick.choice("abcdexyz𠀀")][: pick.randrange(2)] or b[at : at + 1]
            near.append(("".join(a), "".join(b)))
            far.append(("".join(a), "".join(pick.sample(a, n))))
    for pairs, least, most in ((near, 1.0, 1.0), (far[80:120], 0.0, 0.2)):
        x, y = (spark.createDataFrame([(i, p[s]) for i, p in enumerate(pairs)], "id bigint, plain string") for s in (0, 1))
        x, y = ({r["id"]: r["profile"] for r in line_dedup._with_profiles(df).collect()} for df in (x, y))
        batch = pa.RecordBatch.from_pydict({
            "ta": [a for a, _ in pairs], "tb": [b for _, b in pairs],
            "fa": [bytes(x[i]) for i in range(len(pairs))], "fb": [bytes(y[i]) for i in range(len(pairs))],
        })
        edits = [6 * int(max(len(a), len(b)) * 0.1 + 1e-9) for a, b in pairs]
        runs, profiles = line_dedup._grams_apart(batch), line_dedup._profiles_apart(batch)
        assert all(p <= r for p, r in zip(profiles, runs))
        share = sum(r <= e for r, e in zip(runs, edits)) / len(pairs)
        assert least <= share <= most


def test_equal_lines_of_one_word_go(spark):
    base = "今日は天気がとても良いので友達と一緒に公園まで散歩に行きましたそして夕方に帰りました"
    rows = [(1, f"ok\n{base}\nsome-slug-x"), (2, f"OK!\n{base[:20]}々{base[21:]}\n-\nsome_slug_x"), (3, f"-\n{base}\nno"), (4, "so\nsomeslugx\nsomeslugx")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    found = {r["doc_id"]: r["text"] for r in line_dedup.dedup_lines(docs, least_words=1).collect()}
    assert found == {1: rows[0][1], 2: "-", 3: "-\nno", 4: "so\nsomeslugx"}
    assert {r["doc_id"]: r["text"] for r in line_dedup.dedup_lines(docs).collect()}[3] == "-\nno"


def test_short_texts_have_an_anchor_and_differ(spark):
    rows = [(n * 100 + i, " ".join(f"u{n}x{i}y{j}" for j in range(n))) for n in range(1, 16) for i in range(40)]
    rows += [(9000 + i, f"u0 u1 u2 u3 u4 u5 u6 v{i}") for i in range(40)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    marked = syncmers.with_anchors(docs, "text", "places", "marks").collect()
    assert all(r["marks"] and max(r["places"]) <= max(0, len(r["text"].split()) - syncmers.K) for r in marked)
    marked = [r for r in marked if len(r["marks"]) == len(r["text"].split()) - syncmers.K + 1 or r["doc_id"] < 9000]
    twins = spark.createDataFrame([(a["marks"], b["marks"]) for a, b in zip(marked, marked[1:])], "a array<int>, b array<int>")
    assert twins.filter(syncmers.likeness(F.col("a"), F.col("b")) == 1).count() == 0


def test_line_dedup_leaves_little_on_disk(spark):
    """Tables that nothing reads any more do not stay in the shared folder."""
    from pathlib import Path
    from urllib.parse import urlparse

    from marquee.session import shared_dir

    pick = random.Random(21)
    lines = [" ".join(pick.choice(["the", *[f"w{pick.randrange(10**6)}"] * 3]) for _ in range(40)) for _ in range(1500)]
    lines += [line.replace("w", "v", 1) for line in lines[:500]]
    docs = spark.createDataFrame(list(enumerate(lines)), "doc_id bigint, text string")

    def held():
        return sum(f.stat().st_size for f in Path(urlparse(shared_dir(spark)).path).rglob("part-*"))

    before = held()
    assert line_dedup.dedup_lines(docs).agg(F.sum("_dropped")).first()[0] == 500
    assert held() - before < sum(len(line) for line in lines) // 2


def test_frequent_words_make_no_candidates(spark):
    """Lines that share no more than frequent words are not compared; lines that share rare ones are, as are copies that make words frequent."""
    pick = random.Random(22)
    own = [[f"w{pick.randrange(10**9)}" for _ in range(24)] for _ in range(200)]
    lines = [" ".join(["the", "of", "and", "in", "to", "is", "was", "for", "on", "as"] + words) for words in own]
    lines += [line.replace("w", "v", 1) for line in lines[:20]]
    df = spark.createDataFrame([(n, t, len(t)) for n, t in enumerate(lines)], "id bigint, plain string, chars int")
    signed = line_dedup.with_signatures(df, ["id", "chars"], "plain", line_dedup._frequent_words(df))
    signed = signed.select("id", F.struct("mark", "chars", *line_dedup._SKETCH).alias("p")).collect()
    signed = spark.createDataFrame(signed, "id bigint, p struct<mark bigint, chars int, sketch0 bigint, sketch1 bigint, sketch2 bigint>")
    l, r = signed.alias("l"), signed.alias("r")
    met = l.join(r, (F.col("l.id") < F.col("r.id")) & line_dedup._may_link(F.col("l.p"), F.col("r.p")))
    met = {tuple(r) for r in met.select("l.id", "r.id").collect()}
    assert {(n, 200 + n) for n in range(20)} <= met and len(met) < 220 * 219 // 2 // 50
    family = [f"w{pick.randrange(10**9)}" for _ in range(30)]
    copies = [" ".join(family[:at] + [family[at] + "x"] + family[at + 1 :]) for at in range(30)]
    docs = spark.createDataFrame(list(enumerate([*copies, *lines[:100]])), "doc_id bigint, text string")
    assert {r["doc_id"] for r in line_dedup.dropped_lines(docs).collect()} == set(range(1, 30))


def test_edits_are_counted_as_by_the_plain_table():
    pick = random.Random(23)

    def distance(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            last, row[0] = row[0], i
            for j, y in enumerate(b, 1):
                last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
        return row[-1]

    for _ in range(400):
        a, b = ("".join(pick.choice("ab é𠀀") for _ in range(pick.randrange(0, 70))) for _ in range(2))
        n = distance(a, b)
        assert [line_dedup._within(a, b, m) for m in (n - 1, n, n + 1)] == [False, True, True]


def test_blocks_of_frequent_words_do_not_grow_with_the_lines(spark, monkeypatch):
    """Unlike lines over few words share few blocks each, however many they are; copies with a mistyped letter are still found."""
    pick = random.Random(24)
    words = ["".join(pick.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(pick.randrange(2, 9))) for _ in range(150)]
    weights = [1 / (n + 1) for n in range(150)]
    lines = [" ".join(pick.choices(words, weights, k=pick.randrange(24, 40))) for _ in range(4000)]
    lines += [line[:-1] + "0" for line in lines[:60]]
    met = []

    def counted(members, sharing=line_dedup.sharing):
        met.append(members.groupBy("bucket").count().agg(F.sum(F.expr("count * (count - 1) / 2"))).first()[0] or 0)
        return sharing(members)

    monkeypatch.setattr(line_dedup, "sharing", counted)
    docs = spark.createDataFrame(list(enumerate(lines)), "doc_id bigint, text string")
    gone = {r["doc_id"] for r in line_dedup.dropped_lines(docs).collect()}
    assert gone <= set(range(4000, 4060)) and len(gone) >= 57 and sum(met) < 20 * len(lines)
