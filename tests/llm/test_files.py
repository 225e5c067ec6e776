"""WARC archives, token files and packing: round trips against brute force."""

import base64
import gzip
import hashlib
import zlib

import numpy as np
import pytest
from helpers import edge_docs, empty_docs, values
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

import public_tokenizers
from recspark.llm import idcoder, packing, pieces, token_files, warc
from recspark.session import scratch_path

BYTE, WORD = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("word_bpe_49k.json")
PAGES = "page_id long, url string, html string, payload string, digest string"


def pages(spark):
    big = "ü" * 40_000 + "\r\n\r\nWARC/1.1\r\n0\r\n\r\n" + "x" * 30_000
    rows = [(1, "http://a", "same"), (5, "http://b", "same"), (3, None, "same"), (7, "http://c", None), (8, "x\r\ny", ""), (9, "http://d", big),
            (2, "http://e", big), (None, "http://f", "same"), (None, "http://g", "alone"), (4, "http://h", "\r\n\r\n"), (4, "http://h", "\r\n\r\n")]
    return spark.createDataFrame([(*r, "p", "d") for r in rows], PAGES)


def expected_pages(rows, least=0):
    groups = {}
    for i, _, html, *_ in rows:
        groups.setdefault(html or "", []).append(i)
    out = []
    for i, _, html, *_ in rows:
        body = (html or "").encode()
        ids = groups[html or ""]
        keep = max([x for x in ids if x is not None], default=None) if len(ids) > 1 and len(body) >= least else i
        kind = ("response", None) if keep is None or keep == i else ("revisit", keep)
        out.append((i, len(body), base64.b32encode(hashlib.sha1(body).digest()).decode(), *kind))
    return sorted(out, key=repr)


@pytest.mark.parametrize("options", [{}, {"revisit_from": 3, "segment_bytes": 100, "chunk_bytes": 7, "records_per_file": 3}])
def test_warc_round_trip(spark, options):
    df = pages(spark).repartition(3)
    got = values(warc.archive_round_trip(df, **options), "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
    assert got == expected_pages([tuple(r) for r in df.collect()], options.get("revisit_from", 0))
    assert warc.archive_round_trip(spark.createDataFrame([], PAGES)).count() == 0


def test_warc_id_with_several_payloads(spark):
    rows = [(5, None, "a"), (3, None, "a"), (5, None, "b"), (2, None, "b"), (5, None, "c"), (9, None, "c"), (None, None, "b")]
    df = spark.createDataFrame([(*r, "p", "d") for r in rows], PAGES)
    got = values(warc.archive_round_trip(df), "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
    assert got == expected_pages(rows) and sum(r[3] == "response" for r in got) == 3


def test_warc_revisit_of_another_payload_fails(spark):
    digest = lambda body: base64.b32encode(hashlib.sha1(body).digest()).decode()
    record = lambda *args: list(warc.records_of(*args, 512, 1000))
    folder = scratch_path(spark, "warc-bad")
    import os

    os.makedirs(folder.replace("file:", ""))
    with open(folder.replace("file:", "") + "/a.warc.gz", "wb") as f:
        f.write(archive(record(1, "u", "one", digest(b"one"), 3, None, f"{warc.URN}1#0-0") + record(2, "u", None, digest(b"two"), 3, 1, f"{warc.URN}2#0-1")))
    with pytest.raises(Exception, match="does not match response 1"):
        warc.read_archives(spark, folder).collect()


def archive(records):
    return gzip.compress(b"".join(r + b"\r\n\r\n" for r in records))


def big_records(n=5000):
    body = "a" * n
    digest = base64.b32encode(hashlib.sha1(body.encode()).digest()).decode()
    return list(warc.records_of(1, "u", body, digest, n, None, f"{warc.URN}1#0-0", 512, 1000))


@pytest.mark.parametrize("damage", ["missing", "twice", "total", "digest"])
def test_warc_reader_refuses_damage(spark, damage):
    recs = big_records()
    if damage == "missing":
        del recs[2]
    elif damage == "twice":
        recs.insert(2, recs[2])
    elif damage == "total":
        recs[-1] = recs[-1].replace(b"Total-Length: ", b"Total-Length: 1")
    else:
        recs[0] = recs[0].replace(b"sha1:", b"sha1:X")
    rows = [warc.part_of(*x) for x in warc.records_in(archive(recs))]
    df = spark.createDataFrame(rows, warc.PARTS).coalesce(1).sortWithinPartitions("origin", "segment")
    with pytest.raises(Exception, match="missing or repeated|instead of|digest is"):
        df.mapInPandas(warc._reassemble, warc.PAGES).collect()


def test_dechunker_in_any_pieces():
    body = bytes(range(256)) * 5
    data = b"HTTP/1.1 200 OK\r\nTransfer-Encoding: chunked\r\n\r\n" + warc.chunked(body, 100)
    for step in (1, 3, 64, len(data)):
        d = warc.Dechunker()
        for k in range(0, len(data), step):
            d.feed(data[k:k + step])
        assert d.result() == (len(body), base64.b32encode(hashlib.sha1(body).digest()).decode())
    with pytest.raises(ValueError):
        short = warc.Dechunker()
        short.feed(data[:-3])
        short.result()


ALPHABET = st.sampled_from([" ", "  ", "\n", "\t", "\r\n", "a", "B", "é", "é", ".", ",", "...", "!", "'s", "1", "\xa0", "\x01", "\x0b", "Σ", "İ", "ﬁ", "יִ",
                            "Å", "<|endoftext|>", "中", " the", "\x1c", "\x85", "ß", "😀", "word"])


@pytest.mark.parametrize("path,style", [(BYTE, "kept"), (WORD, "dropped")])
def test_pieces_equal_the_library(path, style):
    enc = pieces.PieceEncoder(path, style)

    @settings(max_examples=300, deadline=None)
    @given(st.lists(st.lists(ALPHABET, max_size=20).map("".join), max_size=5))
    def check(texts):
        ids, counts, _ = enc.encode(texts)
        want = [e.ids for e in enc.tok.encode_batch(texts, add_special_tokens=False)]
        assert counts.tolist() == [len(w) for w in want] and ids.tolist() == [i for w in want for i in w]

    check()


def test_encoder_cache_starts_anew(monkeypatch):
    monkeypatch.setattr(pieces, "MAX_PIECES", 3)
    enc = pieces.PieceEncoder(BYTE, "kept")
    for t in ("one two three four", "five six", "one two", "two five one", "", "six. one, two\n two"):
        assert enc.encode([t])[0].tolist() == enc.tok.encode(t, add_special_tokens=False).ids


@settings(max_examples=60, deadline=None)
@given(st.lists(st.one_of(st.integers(0, 65535), st.integers(0, 3)), max_size=3000))
def test_id_coder_round_trip(ids):
    x = np.array(ids, np.int64)
    lengths = np.array([len(ids) // 2, len(ids) - len(ids) // 2])
    if len(ids):
        docs, got, back = idcoder.read_block(idcoder.write_block([5, None], lengths, x))
        assert docs == [5, None] and got.tolist() == lengths.tolist() and np.array_equal(back, x)


def test_id_coder_compresses_and_detects_damage():
    x = np.tile(np.arange(50), 4000)
    block = idcoder.write_block([1], np.array([len(x)]), x)
    assert len(block) < len(x) / 2
    for at in (0, 30, len(block) // 2, len(block) - 1):
        with pytest.raises(ValueError):
            idcoder.read_block(block[:at] + bytes([block[at] ^ 1]) + block[at + 1:])
    with pytest.raises(ValueError):
        idcoder.write_block([1], np.array([1]), np.array([65536]))


def ids_of(path, text):
    tok = Tokenizer.from_file(path)
    tok.encode_special_tokens = True
    return [*tok.encode(text or "", add_special_tokens=False).ids, 1]


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def in_order(rows):
    return sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))


def test_token_file_edge_cases(spark):
    docs = edge_docs(spark)
    want, at = [], 0
    for i, t in in_order([(r.doc_id, r.text) for r in docs.collect()]):
        ids = ids_of(WORD, t)
        want.append((i, at, len(ids), crc(ids)))
        at += len(ids)
    got = token_files.token_file_round_trip(docs, WORD, "dropped", block_ids=500, slice_bytes=50_000)
    assert values(got, "doc_id", "start", "n_tokens", "ids_crc32") == sorted(want, key=repr)
    path = scratch_path(spark, "empty-token-file")
    token_files.write_token_file(empty_docs(spark), path, WORD, "dropped")
    assert token_files.read_token_file(spark, path).count() == 0


def test_packing_edge_cases(spark):
    docs = edge_docs(spark)
    rows = packing.pack_documents(docs, BYTE, window=64, slice_bytes=50_000, run_tokens=5000).collect()
    by_doc = {}
    for r in rows:
        assert r.length > 0
        by_doc.setdefault(r.doc_id, []).append(r)
    for r in docs.where("doc_id IN (1, 3, 4, 6, 7, 8, 9, 10, 11, 12, 13)").collect():
        ids, at = ids_of(BYTE, r.text), 0
        for p in sorted(by_doc[r.doc_id], key=lambda p: p.start):
            assert (p.start, p.doc_tokens, p.ids_crc32) == (at, len(ids), crc(ids[at:at + p.length]))
            at += p.length
        assert at == len(ids)
    for s in {r.sequence_id for r in rows}:
        at = 0
        for p in sorted((r for r in rows if r.sequence_id == s), key=lambda p: p.offset):
            assert p.offset == at
            at += p.length
        assert at <= 64
    assert packing.pack_documents(empty_docs(spark), BYTE).count() == 0


def test_packing_program_is_optimal():
    rng = np.random.default_rng(0)
    pad = lambda d, w: 0 if d & (d - 1) == 0 else w - d
    for _ in range(200):
        at = np.unique(rng.integers(1, 120, rng.integers(1, 40)))
        at = np.union1d(at, np.arange(16, at[-1], 16))
        cost = rng.integers(0, 5, len(at))
        x, f = [0, *at.tolist()], [0]
        for j in range(1, len(x)):
            f.append(min(f[i] + pad(x[j] - x[i], 16) + cost[j - 1] + 1 for i in range(j) if x[j] - x[i] <= 16))
        cuts = packing.best_cuts(at, cost, 16, 1)
        assert sum(pad(int(d), 16) for d in np.diff(cuts, prepend=0)) + cost[np.searchsorted(at, cuts)].sum() + len(cuts) == f[-1]


def test_cuts_prefer_sentence_ends():
    lengths, sentence = np.array([100]), np.zeros(100, bool)
    sentence[[29, 59, 99]] = True
    assert packing.best_cuts(*packing.boundaries(lengths, sentence, 40, 4, 64), 40, 1).tolist() == [30, 60, 100]
    assert set(packing.boundaries(np.array([100]), np.zeros(100, bool), 40, 4, 64)[0].tolist()) == {40, 80, 100}
