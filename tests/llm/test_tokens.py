"""Token counts, BPE codec, token files: held against the libraries."""

import base64
import hashlib
import zlib

import numpy as np
import public_tokenizers
import pyarrow.parquet as pq
import pytest
import tiktoken
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from cumulo.llm import bpe_replay, near_dedup, queries, segments, substring_dedup, token_counts, token_files
from cumulo.llm.common import shared_path
from cumulo.llm.segments import SegmentTable, cuts
from cumulo.llm.word_arrays import word_hashes
from tests.conftest import SF_SMALL
from tests.llm import brute
from tests.llm.conftest import TRICKY

JSON, RANKS = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("byte_bpe_50k.tiktoken")
PATTERN = public_tokenizers.PATTERN
LIBRARY = Tokenizer.from_file(JSON)
TIKTOKEN = tiktoken.Encoding("own", pat_str=PATTERN, special_tokens={}, mergeable_ranks={
    base64.b64decode(a): int(b) for a, b in map(bytes.split, open(RANKS, "rb"))})
ODD = st.text(st.sampled_from(" \n\t\r\x0b\x0c\x1c\x85  aAé1'stre.!?中😀<|endoftext|>́"), max_size=60)


def library_ids(text):
    return LIBRARY.encode(text or "", add_special_tokens=False).ids


@pytest.fixture(scope="module")
def merges():
    return token_counts.MergeTable(JSON, PATTERN)


@pytest.fixture(scope="module")
def replay():
    return bpe_replay.MergeReplay(RANKS, PATTERN)


@settings(max_examples=300, deadline=None)
@given(st.lists(ODD, max_size=5))
def test_values_of_any_text(merges, replay, texts):
    counts, _ = SegmentTable(merges.segment_counts, None, limit=50).encode(texts)
    assert counts.tolist() == [len(library_ids(t)) for t in texts]
    for compute, dtype, want in ((replay.segment_ids, "<i4", TIKTOKEN.encode_ordinary),
                                 (token_files.LibraryEncoder(JSON, "<u2").segment_ids, "<u2", library_ids)):
        counts, flat = SegmentTable(compute, dtype, limit=50, room=99).encode(texts)
        assert [x.tolist() for x in np.split(flat, np.cumsum(counts)[:-1])] == [want(t) for t in texts] or not texts


def test_segments_cut_only_after_visible_characters():
    text = "é a\u00a0 b\u3000 c中 d😀 e\x1c f\n g  h\u2009 i"
    raw = np.frombuffer(text.encode(), np.uint8)
    begin = cuts(raw, np.array([0]))
    parts = [bytes(x).decode() for x in np.split(raw, begin[1:])]
    assert parts == ["é", " a\u00a0 b\u3000 c中", " d😀", " e\x1c f", "\n g", "  h\u2009 i"]


def test_segments_cut_before_marks_after_letters():
    """"word," and "word." share the word: the same tokens from fewer segments."""
    raw = np.frombuffer("So, é, x1. it's a_b|c> (yes) no\u00a0. end.".encode(), np.uint8)
    parts = [bytes(x).decode() for x in np.split(raw, cuts(raw, np.array([0]))[1:])]
    assert parts == ["So", ",", " é,", " x1.", " it's", " a_b|c>", " (yes", ")", " no\u00a0.", " end", "."]
    with pytest.raises(ValueError):
        segments.check_special(["<|endoftext|>", "<end.of>"])


def test_frequent_segments_outlive_a_full_table():
    """Beyond its limits the table forgets what it met in one part only: frequent segments are encoded once."""
    asked = []

    def compute(parts):
        asked.extend(parts)
        return [s.encode() for s in parts]
    often = "".join(f" often{i}" for i in range(100))
    texts = [often + "".join(f" once{i}x{j}" for j in range(500)) for i in range(20)]
    table = SegmentTable(compute, "u1", limit=1000)
    for t in texts:
        counts, flat = table.encode([t])
        assert flat.tobytes().decode() == t and counts.tolist() == [len(t)]
        assert table.n <= 2000
    assert sum(s.startswith(" often") for s in asked) == 100
    small = SegmentTable(compute, "u1", limit=200)  # frequent ones alone take over a third: all are forgotten
    assert small.encode(texts)[1].tobytes().decode() == "".join(texts)


def test_segments_in_one_string():
    """The library gets many segments as one string; the special string goes only where they would not part by themselves."""
    encoder = token_files.LibraryEncoder(JSON, "<u2")
    parts = ["Start", " and", ",", " so", "\non", " é", "  \t ", " x", "<|endoftext|>", " a<|endoftext|>b", "<|endo", " ftext|>", " 中", "!"]
    asked = []

    class Counting:
        def encode_batch_fast(self, texts, add_special_tokens):
            asked.extend(texts)
            return LIBRARY.encode_batch_fast(texts, add_special_tokens=add_special_tokens)
    encoder.tok = Counting()  # has no `encode`: nothing goes one by one
    ids, counts = encoder.segment_ids(parts)
    assert [x.tolist() for x in np.split(ids, np.cumsum(counts)[:-1])] == [library_ids(s) for s in parts]
    mark = "<|endoftext|>"
    assert asked == [f"Start and{mark}, so\non é  \t {mark} x{mark}{mark} a{mark}b{mark}<|endo ftext|> 中{mark}!"]


def test_runs_of_one_pair(merges, replay):
    texts = ["a" * n for n in (1, 2, 3, 4, 7, 64, 5000)] + ["ab" * 3000, "=" * 4097, " " * 300, "\n" * 99]
    assert merges.segment_counts(texts) == [len(library_ids(t)) for t in texts]
    ids, counts = replay.segment_ids(texts)
    assert [x.tolist() for x in np.split(ids, np.cumsum(counts)[:-1])] == [TIKTOKEN.encode_ordinary(t) for t in texts]


def test_one_by_one_and_lower_ranks(replay, tmp_path):
    """Made-up ranks in which a merge brings up a pair of lower rank beside another occurrence."""
    for w in (b" international", b"aaaaaaa", b"x", "über".encode()):
        assert replay.one_by_one(w) == TIKTOKEN.encode_ordinary(w.decode())
    tokens = [bytes([i]) for i in range(256)] + [b"ba", b"aba", b"abab", b"ab", b"abc", b"cab", b"bcab", b"abca", b"aa", b"aaa"]
    path = tmp_path / "made.tiktoken"
    path.write_bytes(b"".join(base64.b64encode(t) + b" %d\n" % i for i, t in enumerate(tokens)))
    odd = bpe_replay.MergeReplay(str(path), r"[a-z]+|[^a-z]+")
    library = tiktoken.Encoding("made", pat_str=r"[a-z]+|[^a-z]+", special_tokens={},
                                mergeable_ranks={t: i for i, t in enumerate(tokens)})
    rng = np.random.default_rng(8)
    texts = ["".join(rng.choice(list("abc"), rng.integers(1, 40))) for _ in range(3000)]
    ids, counts = odd.segment_ids(texts)
    assert [x.tolist() for x in np.split(ids, np.cumsum(counts)[:-1])] == [library.encode_ordinary(t) for t in texts]


def test_more_segments_than_places():
    """2.5 million different segments in one text, and limits far below the number of segments."""
    text = " ".join(map(str, range(2_500_000)))
    counts, flat = SegmentTable(lambda s: [len(x) for x in s], None).encode([text, "7 8"])
    assert counts.tolist() == [len(text), 3]
    texts = [" ".join(map(str, range(a, a + 700))) for a in range(0, 7000, 500)]
    counts, flat = SegmentTable(lambda s: [x.encode() for x in s], "u1", limit=50, room=1000).encode(texts)
    assert flat.tobytes().decode() == "".join(texts) and counts.tolist() == [len(t) for t in texts]


def _thue_morse(n):
    return "".join("ab"[bin(i).count("1") & 1] for i in range(n))


@pytest.mark.parametrize("n", [1024, 2048, 4096])
def test_words_with_alternating_structure(spark_llm, n):
    """Words that polynomial hashes modulo a power of two confuse: a Thue-Morse word and its complement."""
    a = _thue_morse(n)
    b = a.translate(str.maketrans("ab", "ba"))
    assert word_hashes(a.encode())[0] != word_hashes(b.encode())[0]
    rest = " ".join(f"w{i}" for i in range(40))
    docs = spark_llm.createDataFrame([(1, a), (2, b), (3, f"{rest[:60]} {a} {rest[60:]}"), (4, f"{rest[:60]} {b} {rest[60:]}")],
                                     "doc_id long, text string").coalesce(1)
    text = {1: a, 2: b, 3: f"{rest[:60]} {a} {rest[60:]}", 4: f"{rest[:60]} {b} {rest[60:]}"}
    got = {r.doc_id: r.n_tokens for r in token_counts.count_tokens(docs, JSON, PATTERN).collect()}
    assert got == {i: len(library_ids(t)) for i, t in text.items()}
    both = bpe_replay.decode(bpe_replay.encode(docs, RANKS, PATTERN), RANKS, PATTERN).collect()
    assert {r.doc_id: (r.ids, bytes(r.decoded).decode()) for r in both} == {i: (TIKTOKEN.encode_ordinary(t), t) for i, t in text.items()}
    assert {r.doc_id: r.component_id for r in near_dedup.near_copies(docs, k=4).where("doc_id < 3").collect()} == {1: 1, 2: 2}
    cut = {r.doc_id: r.n_removed for r in substring_dedup.remove_repeats(docs, length=20).collect()}
    assert cut == {i: removed for i, (_, removed, _) in brute.without_repeats(sorted(text.items()), 20).items()}


def test_segments_with_one_hash(monkeypatch):
    """Entries are known by their bytes: with four hash values only, every value is still right."""
    monkeypatch.setattr(segments, "span_hashes", lambda raw, a, b: (raw[a].astype(np.uint64) % np.uint64(4)))
    table = SegmentTable(lambda s: [x.encode() for x in s], "u1")
    for texts in (["aa bb", "cc bb aa"], ["bb aa dd", "aa", "", "aaaa bb"] * 3):
        counts, flat = table.encode(texts)
        assert flat.tobytes().decode() == "".join(texts) and counts.tolist() == [len(t) for t in texts]


def _by_id(rows):
    out = {}
    for r in rows:
        out.setdefault(r.doc_id, []).append(r)
    return out


def test_counts_and_codec_on_tricky_rows(tricky, empty):
    got = token_counts.count_tokens(tricky, JSON, PATTERN, limit=100).collect()
    want = sorted(((i, len((t or "").encode()), len(library_ids(t)), len(library_ids(t)) > 100) for i, t, _ in TRICKY), key=repr)
    assert sorted(map(tuple, got), key=repr) == want
    both = bpe_replay.decode(bpe_replay.encode(tricky, RANKS, PATTERN), RANKS, PATTERN).collect()
    assert sorted(((r.doc_id, r.ids, bytes(r.decoded)) for r in both), key=repr) == sorted(
        ((i, TIKTOKEN.encode_ordinary(t or ""), (t or "").encode()) for i, t, _ in TRICKY), key=repr)
    one = bpe_replay.encode_and_decode(tricky, RANKS, PATTERN).collect()
    assert sorted(map(tuple, one), key=repr) == sorted(map(tuple, both), key=repr)
    assert token_counts.count_tokens(empty, JSON, PATTERN).count() == 0
    assert bpe_replay.encode(empty, RANKS, PATTERN).count() == 0


def test_queries_match_the_libraries(spark_llm):
    docs = pq.read_table(f"{SF_SMALL}/documents.parquet").to_pandas().sort_values("doc_id")
    counts = {r.doc_id: r.n_tokens for r in queries.QUERIES["op3_token_counts"](spark_llm, SF_SMALL).collect()}
    files = {r.doc_id: r for r in queries.QUERIES["op6_token_files"](spark_llm, SF_SMALL).collect()}
    codec = {r.doc_id: r for r in queries.QUERIES["op5_bpe_codec"](spark_llm, SF_SMALL).collect()}
    assert len(files) == len(docs) == len(counts)
    at = 0
    for i, text in zip(docs.doc_id, docs.text):
        ids = library_ids(text)
        ranked = TIKTOKEN.encode_ordinary(text or "")
        assert counts[i] == len(ids) and codec[i].n_tokens == len(ranked)
        assert codec[i].ids_sha256 == hashlib.sha256(" ".join(map(str, ranked)).encode()).hexdigest()
        assert codec[i].decoded_sha256 == hashlib.sha256((text or "").encode()).hexdigest()
        closed = np.array([*ids, 2], "<u4")
        assert (files[i].start, files[i].n_tokens, files[i].ids_crc32) == (at, len(closed), zlib.crc32(closed.tobytes()))
        at += len(closed)


def test_token_files_on_tricky_rows(spark_llm, tricky, empty):
    out = shared_path(spark_llm, "test-tokens")
    shards = token_files.write(tricky, out, JSON)
    entries = token_files.scan(spark_llm, shards, "<u2")
    assert entries.count() == len(TRICKY)
    index = token_files.build_index(entries, out)
    assert index.agg(F.sum("n")).first()[0] == len({i for i, _, _ in TRICKY if i is not None})
    asked = spark_llm.createDataFrame([(i,) for i in [*range(-20, 30), None]], "key long")
    got = token_files.read(token_files.lookup(asked, index), "<u2").collect()
    have = sorted((r.key, np.frombuffer(r.ids, "<u2").tolist()) for r in got)
    assert have == sorted((i, [*library_ids(t), 2]) for i, t, _ in TRICKY if i is not None)
    starts = sorted((r.start, r.n_tokens) for r in entries.collect())
    assert all(a + n == b for (a, n), (b, _) in zip(starts, starts[1:])) and starts[0][0] == 0
    out = shared_path(spark_llm, "test-tokens")
    entries = token_files.scan(spark_llm, token_files.write(empty, out, JSON), "<u2")
    index = token_files.build_index(entries, out)
    assert token_files.lookup(asked, index).count() == 0


def test_records_side_by_side_are_read_at_once(spark_llm, monkeypatch):
    """Blocks of a few ids, repeated keys between single ones, keys that are not asked for."""
    monkeypatch.setattr(token_files, "SIDE", 7)
    rows = [(i, f"text {i} " + "and more " * (i % 5) + str(k)) for i in range(60) for k in range(1 + 2 * (i % 9 == 4))]
    docs, out = spark_llm.createDataFrame(rows, "doc_id long, text string"), shared_path(spark_llm, "test-tokens")
    entries = token_files.scan(spark_llm, token_files.write(docs, out, JSON), "<u2")
    found = token_files.lookup(docs.where("doc_id % 10 != 3"), token_files.build_index(entries, out), "doc_id").toPandas()
    starts = {(r.key, r.start): r.n_tokens for r in entries.collect()}
    got = token_files.read(spark_llm.createDataFrame(found), "<u2").collect()
    assert sorted((r.key, np.frombuffer(r.ids, "<u2").tolist()) for r in got) == sorted(
        (i, [*library_ids(t), 2]) for i, t in rows if i % 10 != 3)
    assert all(starts[r.key, r.start] == r.n_tokens == len(r.ids) // 2 for r in got)


@pytest.mark.parametrize("n", [1, 2, 5, 4096, 10_000])
def test_minimal_perfect_hash(n):
    h = np.random.default_rng(n).integers(0, 2**63, n, dtype=np.uint64)
    assert sorted(token_files.slots_of(h, token_files.build_hash(h), n).tolist()) == list(range(n))


def test_end_id_must_be_writable(tricky):
    with pytest.raises(ValueError):
        token_files.write(tricky, "/nowhere", JSON, end_id=50256)
