"""Token ids, the range coder and the token files, against the tokenizer's own output."""

import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from ledgerline.llm import range_coder, token_files
from ledgerline.llm.token_ids import Encoder

BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")
AWKWARD = ["'s", "'t", "'re", "'ll", "'", "''", " ", "  ", "\n", "\t", "\r\n", "　", "\x1c", "\x85", "\x00", "a", "Z"]
AWKWARD += ["é", "ß", "漢", "1", "٣", "½", "!", "-", "😀", "́", " the", "don't", "<|endoftext|>", "​", "_"]


def awkward_texts(n, seed=5):
    rng = random.Random(seed)
    texts = ["".join(rng.choice(AWKWARD) for _ in range(rng.randrange(30))) for _ in range(n)]
    points = [*range(0x20, 0x3000), *range(0xAC00, 0xD7FF), *range(0x1F000, 0x1F700)]
    return texts + ["".join(chr(rng.choice(points)) for _ in range(25)) for _ in range(n // 10)]


@pytest.mark.parametrize("plain", [False, True])
@pytest.mark.parametrize("before", ["", " "])
def test_ids_are_the_tokenizers(plain, before):
    texts = [*awkward_texts(1500), "", None, "word " * 5000]
    ids, counts = Encoder(BYTE_BPE, plain)(texts, before)
    own = Tokenizer.from_file(BYTE_BPE)
    own.encode_special_tokens = plain
    at = 0
    for text, count in zip(texts, counts.tolist()):
        wanted = own.encode("" if text is None else before + text, add_special_tokens=False).ids
        assert ids[at : at + count].tolist() == wanted
        at += count


def test_other_tokenizers_get_whole_texts():
    path = public_tokenizers.path("word_bpe_49k.json")
    ids, counts = Encoder(path)(["Some Words", None, ""])
    assert ids.tolist() == Tokenizer.from_file(path).encode("Some Words", add_special_tokens=False).ids
    assert counts.tolist() == [len(ids), 0, 0]


def test_coder_gives_blocks_back():
    rng = np.random.default_rng(3)
    lengths = (0, 1, 2, 3, 17, 900, 4096)
    blocks = [rng.integers(0, most, size=n) for most in (1, 2, 300, 70_000, 2**32) for n in lengths]
    blocks += [np.zeros(4096, np.int64), np.arange(4096) * 3, np.tile(np.arange(7), 500)]
    streams = range_coder.encode(blocks)
    back = range_coder.decode(streams, [len(b) for b in blocks], [int(b.max(initial=0)) for b in blocks])
    assert all(np.array_equal(a, b) for a, b in zip(blocks, back))
    assert range_coder.encode([]) == [] and range_coder.decode([], [], []) == []
    alone = range_coder.encode(blocks[20:21])  # a block does not depend on its neighbours
    assert alone == streams[20:21]
    assert len(streams[-1]) < 200  # repeats are predicted


def test_crc_of_two_parts():
    a, b = b"first part", b"and a second one" * 77
    assert token_files.joined_crc(zlib.crc32(a), zlib.crc32(b), len(b)) == zlib.crc32(a + b)
    assert token_files.joined_crc(zlib.crc32(a), 0, 0) == zlib.crc32(a)


def test_damaged_blocks_are_refused():
    ids = np.array([5, 6, 7])
    block = token_files.pack_block(ids, range_coder.encode([ids])[0], np.zeros(1, token_files.PART), 0)
    assert token_files.unpack_block(block)[0] == 3
    for wrong in (block[:-1], block[:9] + b"\xff" + block[10:], b"", b"LTB1"):
        with pytest.raises(ValueError):
            token_files.unpack_block(wrong)


def test_files_in_order_and_read_back(spark):
    texts = [*awkward_texts(300), "", None, "long text " * 3000, "again", "again"]
    rows = [(i * 7 % 1009, t, "x") for i, t in enumerate(texts)]
    rows += [(None, "no id", "y"), (None, None, "y"), (5000, "again", "z"), (5000, "again", "z")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids string").repartition(5)
    path = token_files.written(docs, BYTE_BPE, end_id=2, block_ids=512)
    found = token_files.documents(spark, path).join(token_files.file_starts(spark, path), "file_no").collect()
    found.sort(key=lambda r: r.file_start + r.start)
    assert [r.doc_id for r in found] == sorted((r[0] for r in rows), key=lambda i: (i is not None, i))
    own = Tokenizer.from_file(BYTE_BPE)
    at, left = 0, {}
    for doc_id, text, _ in rows:
        left.setdefault(doc_id, []).append([*own.encode(text or "", add_special_tokens=False).ids, 2])
    for r in found:
        assert r.file_start + r.start == at
        at += len(r.ids)
        left[r.doc_id].remove(r.ids)
    digests = {(r.file_no, r.document): r for r in token_files.digests(spark, path).collect()}
    assert len(digests) == len(found) == len(rows)
    for r in found:
        d = digests[r.file_no, r.document]
        assert (d.doc_id, d.start, d.n_ids) == (r.doc_id, r.start, len(r.ids))
        assert d.crc32 == zlib.crc32(np.array(r.ids, dtype="<u4").tobytes())


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    path = token_files.written(docs, BYTE_BPE, end_id=2)
    assert token_files.digests(spark, path).count() == 0
    assert token_files.documents(spark, path).count() == 0


def test_query_on_the_smallest_tables(spark):
    from ledgerline.llm.queries import QUERIES

    d = "/root/testdata/sf0.001"
    found = QUERIES["op11_token_files"](spark, d).orderBy("doc_id").collect()
    docs = spark.read.parquet(f"{d}/documents.parquet").orderBy("doc_id").collect()
    own, at = Tokenizer.from_file(BYTE_BPE), 0
    assert len(found) == len(docs)
    for r, doc in zip(found, docs):
        ids = [*own.encode(doc.text or "", add_special_tokens=False).ids, 2]
        assert r.asDict() == {
            "doc_id": doc.doc_id,
            "start": at,
            "n_tokens": len(ids),
            "ids_crc32": zlib.crc32(np.array(ids, dtype="<u4").tobytes()),
        }
        at += len(ids)
