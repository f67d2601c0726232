"""Token records: ids against the library's, an exact round trip, checksums and the index."""

import os
import random
import zlib

import numpy as np
import pytest
from edge_rows import docs, no_docs
from tokenizers import Tokenizer

from touchline.llm.crc32c import crc32c, masked_crc32c
from touchline.llm.token_records import (
    TextEncoder,
    default_tokenizer,
    frame,
    read_token_records,
    shuffled_records,
    unframe,
    write_token_records,
)
from touchline.session import scratch_path


def plain_crc32c(data):
    crc = 0xFFFFFFFF
    for byte in data:
        crc ^= byte
        for _ in range(8):
            crc = (crc >> 1) ^ (0x82F63B78 if crc & 1 else 0)
    return crc ^ 0xFFFFFFFF


def test_checksums_agree_with_a_bitwise_one():
    rng = random.Random(3)
    buffers = [b"123456789", *[rng.randbytes(n) for n in (4, 5, 255, 256, 257, 511, 512, 513, 1000, 4, 3000)]]
    assert crc32c(buffers).tolist() == [plain_crc32c(b) for b in buffers]
    assert crc32c(buffers)[0] == 0xE3069283 and len(crc32c([])) == 0
    rotated = ((0xE3069283 >> 15) | (0xE3069283 << 17)) + 0xA282EAD8
    assert masked_crc32c(buffers)[0] == rotated & 0xFFFFFFFF


def test_frames_come_back_and_damage_is_found():
    payloads = [b"12345678", os.urandom(999)]
    frames = frame(payloads)
    assert [len(f) for f in frames] == [24, 1015] and unframe(frames, "x") == payloads
    with pytest.raises(ValueError, match="checksum"):
        unframe([frames[0], frames[1][:50] + b"?" + frames[1][51:]], "x")


@pytest.mark.parametrize("file", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_ids_are_those_of_whole_texts(file):
    import public_tokenizers

    path = public_tokenizers.path(file)
    library = Tokenizer.from_file(path)
    encoder = TextEncoder(path, known_pieces=50)
    rng = random.Random(1)
    parts = [*"ab cÀé ÿ×\t\n\x0b\r\x1c\x85\xa0  ​ 　'sl0 9.!-|²Ⅷ<>中\U0001f600ßtDM", "<|endoftext|>", "<|endof", "'ll", "  "]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 30))) for _ in range(4000)]
    for text, ids in zip(texts, encoder.encode(texts)):
        assert np.frombuffer(ids, "<u4").tolist() == library.encode(text, add_special_tokens=False).ids


def folder(spark):
    path = scratch_path(spark, "records-test")
    return path if "://" in path else "file://" + path.removeprefix("file:")


def test_round_trip_with_edge_rows(spark):
    where = folder(spark)
    manifest = write_token_records(docs(spark).repartition(3), where, default_tokenizer())
    rows = read_token_records(where, manifest).orderBy("start").collect()
    library = Tokenizer.from_file(default_tokenizer())
    source = sorted(docs(spark).collect(), key=lambda r: (r.doc_id is not None, r.doc_id or 0))
    start = 0
    for row, doc in zip(rows, source, strict=True):
        ids = [*library.encode(doc.text or "", add_special_tokens=False).ids, 2]
        assert (row.doc_id, row.start, row.n_tokens) == (doc.doc_id, start, len(ids))
        assert row.ids_crc32 == zlib.crc32(np.array(ids, "<u4").tobytes())
        start += len(ids)
    shards = manifest.orderBy("shard").collect()
    assert sum(s.tokens for s in shards) == start and sum(s.records for s in shards) == len(source)
    read = [x for s in shards for x in shuffled_records(where, s["data"], s["index"], seed=5)]
    assert sorted((i or 0, len(ids)) for i, ids in read) == sorted((r.doc_id or 0, r.n_tokens) for r in rows)


def test_no_rows_write_no_shard(spark):
    where = folder(spark)
    manifest = write_token_records(no_docs(spark), where, default_tokenizer())
    assert manifest.count() == 0 and read_token_records(where, manifest).count() == 0
