import io
import zlib

import numpy as np
import pytest
from cases import TEXTS, documents
from tokenizers import Tokenizer

from clickstrata.llm import token_files as files
from clickstrata.sources import scratch_path


@pytest.mark.parametrize("bits", [1, 3, 8, 11, 16, 17, 31, 32])
def test_bits_round_trip(bits):
    ids = np.random.default_rng(bits).integers(0, 2**bits, 1001, dtype=np.uint64)
    data = files.pack_bits(ids, bits)
    assert len(data) == -(-1001 * bits // 8)
    assert (files.unpack_bits(data, bits, 1001) == ids).all()
    plain = "".join(f"{int(k):0{bits}b}"[::-1] for k in ids)
    assert data == bytes(int(plain[k : k + 8][::-1], 2) for k in range(0, len(plain), 8))


def test_least_bits():
    assert [files.bits_for(n) for n in (1, 2, 3, 256, 257, 50_257, 65_536, 65_537)] == [1, 1, 2, 8, 9, 16, 16, 17]


@pytest.mark.parametrize(("bits", "block"), [(16, 64), (11, 64), (5, 7)])
def test_any_range_of_a_file(bits, block):
    numbers = np.random.default_rng(1)
    builder = files.TokenFileBuilder(bits, block, place=4)
    own = [numbers.integers(0, 2**bits, n, dtype=np.uint32) for n in (0, 1, 500, 63, 64, 65, 9000)]
    for k, ids in enumerate(own):
        builder.add(None if k == 1 else k - 3, ids.astype("<u4").tobytes())
    file = files.TokenFile(io.BytesIO(builder.build()))
    assert (file.bits, file.block_ids, file.place, file.number) == (bits, block, 4, 0)
    assert file.doc_ids[~file.nulls].tolist() == [-3, -1, 0, 1, 2, 3] and file.nulls.tolist() == [k == 1 for k in range(7)]
    every = np.concatenate(own)
    for low, high in [(0, 0), (0, len(every)), (1, 2), (block - 1, block + 1), (600, 5000), (len(every), len(every))]:
        assert (file.ids(low, high) == every[low:high]).all()
    assert all((file.document(k) == ids).all() for k, ids in enumerate(own))
    with pytest.raises(IndexError):
        file.ids(0, len(every) + 1)
    builder.add(9, b"")
    assert files.TokenFile(io.BytesIO(builder.build())).number == 1


def test_reads_only_the_blocks_it_needs():
    class Counted(io.BytesIO):
        taken = 0

        def read(self, n=-1):
            got = super().read(n)
            self.taken += len(got)
            return got

    builder = files.TokenFileBuilder(16, 64)
    builder.add(1, np.arange(60_000, dtype="<u4").tobytes())
    file = files.TokenFile(Counted(builder.build()))
    before = file.file.taken
    assert file.ids(30_000, 30_002).tolist() == [30_000, 30_001]
    assert file.file.taken - before <= 2 * 64 * 2


def test_rejects_other_files():
    with pytest.raises(ValueError, match="not a token file"):
        files.TokenFile(io.BytesIO(bytes(64)))


def expected(rows, end_id=files.END_ID):
    tokenizer = Tokenizer.from_file(files.vocabulary_path())
    out, start = [], 0
    for doc_id, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [end_id]
        out.append((doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


def test_round_trip_equals_brute_force(spark):
    found = files.round_trip(documents(spark)).sort("start").collect()
    assert [tuple(r) for r in found] == expected(TEXTS)


def test_many_files_ties_and_a_hot_id(spark):
    rows = [(7, f"text {k % 3}") for k in range(300)] + [(k, "one two three " * (k % 5)) for k in range(100)]
    found = files.round_trip(documents(spark, rows), file_ids=64, block_ids=16).sort("start").collect()
    assert len(found) == 400 and [r.doc_id for r in found] == sorted(r[0] for r in rows)
    assert [r.start for r in found] == np.cumsum([0, *(r.n_tokens for r in found)])[:-1].tolist()
    assert sorted((r.doc_id, r.n_tokens, r.ids_crc32) for r in found) == sorted((a, c, d) for a, _, c, d in expected(rows))


def test_file_sizes_and_ids(spark):
    rows = [(k, "some words in a row") for k in range(200)]
    path = scratch_path(spark, "sized")
    files.write_token_files(documents(spark, rows), path, file_ids=100)
    found = files.read_token_files(spark, path, with_ids=True)
    assert found.groupBy("place", "number").sum("n_tokens").agg({"sum(n_tokens)": "max"}).first()[0] <= 100 + 6
    one = found.where("doc_id = 17").first()
    assert one.ids == Tokenizer.from_file(files.vocabulary_path()).encode(rows[0][1]).ids + [files.END_ID]


def test_empty_table(spark):
    assert files.round_trip(documents(spark, [])).count() == 0


def test_end_id_must_be_in_the_vocabulary(spark):
    with pytest.raises(ValueError, match="end id"):
        files.round_trip(documents(spark), end_id=10**6)
