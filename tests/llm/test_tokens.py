import base64
import hashlib
import zlib
from random import Random

import numpy as np
import public_tokenizers
import pytest
import regex
import tiktoken
from tokenizers import Tokenizer

from marquee.llm import byte_bpe, token_files

VOCABULARY = public_tokenizers.path("word_bpe_49k.json")
RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


@pytest.fixture(scope="module")
def reference():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(RANKS, "rb"))}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_token_files_hold_the_library_ids(spark, documents, edges, nothing, tmp_path):
    tokenizer = Tokenizer.from_file(VOCABULARY)
    for n, docs in enumerate((documents, edges)):
        token_files.write_tokens(docs, str(tmp_path / f"t{n}"), VOCABULARY)
        back = token_files.read_tokens(spark, str(tmp_path / f"t{n}"))
        found = token_files.with_starts(token_files.token_digests(back), back).orderBy("seq").collect()
        rows = sorted(docs.collect(), key=lambda r: (r["doc_id"] is not None, r["doc_id"]))
        assert [r["doc_id"] for r in found] == [r["doc_id"] for r in rows]
        start = 0
        for got, row in zip(found, rows):
            ids = tokenizer.encode(row["text"] or "", add_special_tokens=False).ids + [1]
            assert (got["start"], got["n_tokens"], got["ids_crc32"]) == (start, len(ids), zlib.crc32(np.asarray(ids, "<u4").tobytes()))
            start += len(ids)
    token_files.write_tokens(nothing, str(tmp_path / "none"), VOCABULARY)
    assert token_files.read_tokens(spark, str(tmp_path / "none")).count() == 0


@pytest.mark.parametrize("text", ["Don't stop.", "a,b ,c", "x!! y?!", "it's, he's.", "ÀÉ. İstanbul, ǅ", "'s. 't, d'", "<|endoftext|>, a", "éa. ́b", "12.5, 3rd;", " a b"])
def test_words_and_marks_part_as_the_library_does(text):
    tokenizer = Tokenizer.from_file(VOCABULARY)
    ids = np.frombuffer(token_files.encode_texts([text.encode()], VOCABULARY)[0], "<u4").tolist()
    assert ids == tokenizer.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("text", ["J\u030cH\u0331T\u0308", "Some J\u030c, W\u030aY\u030a! x", "E\u0301A\u0300 É İ\u0307 ABC", "X\nI\u0307.", "Ab \u0301c <|ENDOFTEXT|>"])
def test_decomposed_capitals_have_the_library_ids(text):
    ids = np.frombuffer(token_files.encode_texts([text.encode()], VOCABULARY)[0], "<u4").tolist()
    assert ids == Tokenizer.from_file(VOCABULARY).encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("text", ["a <|endoftext|> b", "x<|startoftext|>y", "<|endoftext|><|endoftext|>", "A <|ENDOFTEXT|>, b", "É <|endoftext|>\nJ\u030c", "<|endoftext"])
def test_literal_special_tokens_have_the_library_ids(text):
    texts = [b"plain words, before", text.encode(), b"and after."]
    found = [np.frombuffer(x, "<u4").tolist() for x in token_files.encode_texts(texts, VOCABULARY)]
    assert found == [Tokenizer.from_file(VOCABULARY).encode(t.decode(), add_special_tokens=False).ids for t in texts]


def test_rows_of_one_id_are_spread(spark, conf, tmp_path):
    conf(spark__sql__adaptive__coalescePartitions__enabled="false")
    docs = spark.createDataFrame([(7, f"text number {n}") for n in range(400)], "doc_id bigint, text string").repartition(4)
    token_files.write_tokens(docs, str(tmp_path / "hot"), VOCABULARY)
    back = token_files.read_tokens(spark, str(tmp_path / "hot"))
    assert back.select((back["seq"] / 2**33).cast("int")).distinct().count() > 1
    found = token_files.with_starts(token_files.token_digests(back), back).orderBy("start").collect()
    assert [r["start"] for r in found] == np.concatenate([[0], np.cumsum([r["n_tokens"] for r in found])[:-1]]).tolist()


def test_files_have_page_index_and_set_row_groups(spark, documents, tmp_path):
    import pyarrow.parquet as pq

    token_files.write_tokens(documents.repartition(1), str(tmp_path / "t"), VOCABULARY, row_group_bytes=256 * 1024, page_bytes=16 * 1024)
    files = [pq.ParquetFile(p) for p in (tmp_path / "t").glob("*.parquet")]
    assert max(f.metadata.num_row_groups for f in files) > 1
    group = files[0].metadata.row_group(0)
    named = {group.column(i).path_in_schema.split(".")[0]: group.column(i) for i in range(group.num_columns)}
    assert "DELTA_BINARY_PACKED" in named["doc_id"].encodings and named["doc_id"].has_column_index and named["doc_id"].has_offset_index
    assert any("DICTIONARY" in e for e in named["token_ids"].encodings)


def test_byte_bpe_matches_and_round_trips(documents, edges, nothing, reference):
    for docs, chunk in ((documents, byte_bpe.CHUNK_CHARS), (documents, 700), (edges, 64)):
        coded = byte_bpe.encode(docs, RANKS, public_tokenizers.PATTERN, chunk=chunk, overlap=chunk // 4)
        found = sorted(tuple(r)[1:] for r in byte_bpe.digests(coded, RANKS).collect())
        direct = byte_bpe.round_trip(docs, RANKS, public_tokenizers.PATTERN, chunk=chunk, overlap=chunk // 4)
        assert direct.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
        assert sorted(tuple(r)[1:] for r in direct.collect()) == found
        wanted = []
        for row in docs.collect():
            text = row["text"] or ""
            ids = np.asarray(reference.encode_ordinary(text), "<u4").tobytes()
            wanted.append((len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256(text.encode()).hexdigest()))
        assert found == sorted(wanted)
    assert byte_bpe.encode(nothing, RANKS, public_tokenizers.PATTERN).count() == 0


def test_decoding_gives_the_bytes_back(documents):
    coded = byte_bpe.encode(documents.limit(20), RANKS, public_tokenizers.PATTERN)
    back = {r["doc_id"]: bytes(r["decoded"]).decode() for r in byte_bpe.decode(coded, RANKS).collect()}
    assert back == {r["doc_id"]: r["text"] or "" for r in documents.limit(20).collect()}


def test_cuts_are_boundaries_of_the_whole_text():
    splitter = regex.compile(public_tokenizers.PATTERN)
    texts = ["it's we'll  go\n\n now " * 40, "a" * 400, " " * 300 + "b" + "\n" * 200, "x'l 're!! 12ab " * 30, "don't" * 90]
    for text in texts:
        ends = {m.end() for m in splitter.finditer(text)}
        for chunk, overlap in ((50, 20), (33, 9), (64, 64)):
            seams = []
            for n, start in enumerate(range(0, len(text), chunk)):
                head, tail = byte_bpe.chunk_seams(text[start : start + chunk + overlap], start, chunk, start + chunk >= len(text), splitter)
                seams.append((n, head, tail))
            cuts = byte_bpe.stitch(seams)
            assert set(cuts) <= ends and cuts == sorted(cuts)
            edges = [0, *cuts, len(text)]
            assert [p for a, b in zip(edges, edges[1:]) for p in splitter.findall(text[a:b])] == splitter.findall(text)


def test_word_by_word_ids_are_those_of_the_plain_call_on_random_texts():
    library, random = Tokenizer.from_file(VOCABULARY), Random(5)
    signs = "aZéÉĳİıſЖж҂ßŉΣςʹ ́̈̇'’s.,!?;:<>|≠…—%$#&_^`~@[]\\/9½ \t\n\x85　中のก가K"
    texts = ["".join(random.choices(signs, k=random.randint(0, 14))) for _ in range(5_000)]
    texts += ["a <|endoftext|> b", "x<|startoftext|>y"]
    for text, ids in zip(texts, token_files.encode_texts([t.encode() for t in texts], VOCABULARY)):
        assert np.frombuffer(ids, "<u4").tolist() == library.encode(text, add_special_tokens=False).ids, ascii(text)
