"""Token cache, token files and packing against the tokenizers library itself."""

import collections
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from mapstrata.llm import packing, token_files
from mapstrata.llm.perfect_hash import PerfectHash
from mapstrata.llm.queries import QUERIES
from mapstrata.llm.token_files import ShardReader, key_of, read_token_files, write_token_files
from mapstrata.llm.tokens import ByteLevelEncoder
from mapstrata.session import checkpoint_folder

PATH = public_tokenizers.path("byte_bpe_50k.json")
SF_DIR = "/root/testdata/sf0.01"
ODD = [
    (3, None, "a"),
    (1, "", "a"),
    (2, "one two  three \n four\n\nfive\tsix ", "b"),
    (2, "one two", "b"),
    (2, "one two", "b"),
    (None, "no id here", None),
    (7, "word " * 30_000, "a"),
    (8, "x" * 20_000, "a"),
    (9, "   lead don't, it's 3.5%! end <|endoftext|> tail", "a"),
]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


TEXTS = st.text(st.sampled_from(list("ab ' \n\t.,1  é漢\x1c\x85")) | st.characters(codec="utf-8"), max_size=60)


@settings(max_examples=300, deadline=None)
@given(TEXTS)
def test_cached_encoding_equals_library(text):
    encode, library = test_cached_encoding_equals_library.pair
    assert np.frombuffer(encode(text), encode.dtype).tolist() == library.encode(text, add_special_tokens=False).ids


test_cached_encoding_equals_library.pair = (ByteLevelEncoder(PATH), Tokenizer.from_file(PATH))


PARTS = ["a", "Wörter", "thed", "don't", "x.y", "123", "\n", "\n\n", "\n\n\n", " ", "  ", "\t", "\r\n", ".", "...", ",!", "é", "Ċb", "漢", "\x85", "<|endoftext|>"]
MANY = st.lists(st.none() | TEXTS | st.lists(st.sampled_from(PARTS), max_size=12).map("".join) | st.lists(st.sampled_from(PARTS), max_size=12).map(" ".join), max_size=20)


@settings(max_examples=300, deadline=None)
@given(MANY)
def test_texts_encoded_together_equal_library(texts):
    encode, library = test_cached_encoding_equals_library.pair
    found = [np.frombuffer(ids, encode.dtype).tolist() for ids in encode.many(pa.array(texts, pa.string()))]
    assert found == [library.encode(text or "", add_special_tokens=False).ids for text in texts]


def test_words_of_letters_are_encoded_together_and_forgotten(monkeypatch, library):
    monkeypatch.setattr("mapstrata.llm.tokens.MOST_CACHED", 500)
    monkeypatch.setattr("mapstrata.llm.tokens.AT_ONCE", 4_000)
    encode, calls = ByteLevelEncoder(PATH), []
    for name in ("spelled", "letters", "library"):
        monkeypatch.setattr(encode, name, lambda text, f=getattr(encode, name): calls.append(text) or f(text))
    letters = "abcdefghijklmnopqrstuvwxyzäö"
    texts = ["\n".join(" ".join(letters[i % 28] + letters[j] + letters[k] + "," * (j % 2) for j in range(28)) + "." for k in range(28)) for i in range(40)]
    found = [np.frombuffer(ids, encode.dtype).tolist() for ids in encode.many(pa.array(texts))]
    assert found == [library.encode(text, add_special_tokens=False).ids for text in texts]
    assert len(set(calls)) < 10  # marks only
    assert max(len(encode.spaced), len(encode.spaced.older)) <= 500 + 2 * 28 * 28  # and the words of one slice


@pytest.mark.parametrize("n", [0, 1, 2, 1000, 50_000])
def test_perfect_hash_is_minimal(n):
    keys = np.random.default_rng(n).integers(0, 1 << 63, n).astype(np.uint64)
    table = PerfectHash.build(keys)
    assert sorted(table.slots(keys).tolist()) == list(range(n))


def test_equal_keys_are_refused():
    with pytest.raises(ValueError):
        PerfectHash.build(np.array([5, 5], np.uint64))


def test_token_files_round_trip(spark, documents, library):
    folder = f"{checkpoint_folder(spark)}/files-odd"
    write_token_files(documents(ODD), folder, PATH, 2)
    rows = read_token_files(spark, folder).collect()
    expected, start = [], 0
    ordered = sorted(ODD, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or ""))
    seen = collections.Counter()
    for doc_id, text, _ in ordered:
        ids = library.encode(text or "", add_special_tokens=False).ids + [2]
        expected.append((doc_id, seen[doc_id], start, len(ids), ids))
        seen[doc_id] += 1
        start += len(ids)
    found = [(r.doc_id, r.ordinal, r.start, r.n_tokens, np.frombuffer(r.ids, "<u2").tolist()) for r in rows]
    assert sorted(found, key=lambda r: r[2]) == expected


def test_shards_are_closed_by_rows(spark, documents, library, monkeypatch):
    monkeypatch.setattr(token_files, "SHARD_ROWS", 7)
    folder = f"{checkpoint_folder(spark)}/files-short"
    rows = [(i, "a" * (i % 3), "s") for i in range(100)]
    write_token_files(documents(rows, parts=1), folder, PATH, 2)
    assert spark.read.parquet(f"{folder}/keys").groupBy("shard").count().agg({"count": "max"}).first()[0] <= 7
    found = {r.doc_id: np.frombuffer(r.ids, "<u2").tolist() for r in read_token_files(spark, folder).collect()}
    assert found == {i: library.encode(t, add_special_tokens=False).ids + [2] for i, t, _ in rows}


def test_schemes_of_object_stores():
    assert token_files.library_uri("s3a://bucket/a/b") == "s3://bucket/a/b"
    assert token_files.library_uri("file:///tmp/s3a://x") == "file:///tmp/s3a://x"


def test_keys_that_a_shard_lacks(spark, documents):
    folder = f"{checkpoint_folder(spark)}/files-keys"
    write_token_files(documents([(i, f"text {i}", "a") for i in range(50)]).coalesce(1), folder, PATH, 2)
    shard = spark.read.parquet(f"{folder}/keys").first().shard
    absent = [key_of(i, 0) for i in range(1000, 1400)]
    reader = ShardReader(folder, shard)
    assert (reader.find(np.array([k[0] for k in absent]), np.array([k[1] for k in absent], np.int32)) == -1).all()


def test_empty_token_files(spark, documents):
    folder = f"{checkpoint_folder(spark)}/files-empty"
    write_token_files(documents(ODD).where("false"), folder, PATH, 2)
    assert read_token_files(spark, folder).count() == 0


def test_query_token_files(spark, library):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect()
    start, expected = 0, {}
    for r in sorted(docs, key=lambda r: r.doc_id):
        ids = library.encode(r.text or "", add_special_tokens=False).ids + [2]
        expected[r.doc_id] = (start, len(ids), crc(ids))
        start += len(ids)
    found = {r.doc_id: (r.start, r.n_tokens, r.ids_crc32) for r in QUERIES["op5_token_files"](spark, SF_DIR).collect()}
    assert found == expected


def check_packing(pieces, texts, library, end_id):
    """``pieces``: rows with ids; ``texts``: (doc_id, text) as a multiset."""
    by_sequence, by_doc = collections.defaultdict(list), collections.defaultdict(list)
    for p in pieces:
        ids = np.frombuffer(p.ids, "<u2").tolist()
        assert len(ids) == p.length > 0
        by_sequence[p.sequence_id].append((p.offset, p.length))
        by_doc[p.doc_id, p.doc_tokens].append((p.start, ids))
    padding = total = 0
    for spans in by_sequence.values():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at
            at += length
        assert at <= packing.CAPACITY
        padding += 0 if at & (at - 1) == 0 else packing.CAPACITY - at
        total += at
    wanted = collections.defaultdict(list)
    for doc_id, text in texts:
        ids = library.encode(text or "", add_special_tokens=False).ids + [end_id]
        wanted[doc_id, len(ids)].append(ids)
    assert by_doc.keys() == wanted.keys()
    for key, docs in wanted.items():
        if len(docs) == 1:
            assert [x for _, ids in sorted(by_doc[key]) for x in ids] == docs[0]
        else:  # rows that repeat an id and a length: the same ids, taken together
            assert sorted(x for _, ids in by_doc[key] for x in ids) == sorted(x for d in docs for x in d)
    return padding, total


def test_packing_of_odd_rows(spark, documents, library):
    pieces = packing.pack(documents(ODD), PATH, 1).collect()
    check_packing(pieces, [(i, t) for i, t, _ in ODD], library, 1)
    assert packing.pack(documents(ODD).where("false"), PATH, 1).count() == 0


def test_packing_pads_little(spark, library):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    pieces = packing.pack(docs, PATH, 1).collect()
    padding, total = check_packing(pieces, [(r.doc_id, r.text) for r in docs.collect()], library, 1)
    assert padding < 0.01 * total


def test_packing_in_several_rounds(spark, library):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").limit(300).repartition(130)
    texts = [(r.doc_id, r.text) for r in docs.collect()]
    padding, total = check_packing(packing.pack(docs, PATH, 1).collect(), texts, library, 1)
    assert padding < 0.02 * total


def test_query_packing_digest(spark, library):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()}
    rows = QUERIES["op7_harmonic_packing"](spark, SF_DIR).collect()
    for r in rows[::37]:
        ids = library.encode(docs[r.doc_id], add_special_tokens=False).ids + [1]
        assert r.doc_tokens == len(ids) and r.ids_crc32 == crc(ids[r.start : r.start + r.length])
