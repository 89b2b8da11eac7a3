import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from orelake.llm import token_ids as T
from orelake.session import scratch_dir
from tests.llm.helpers import AWKWARD, docs

PATH = public_tokenizers.path("byte_bpe_50k.json")
WHOLE = Tokenizer.from_file(PATH)
BITS = [" ", "  ", "\n", "\t", "\x1c", "\x85", "\u3000", "a", "B", "é", "’", "'s", "'", "12", "½", "<|endoftext|>", "<|", "😀", ".",
        "...", "$$$", "\u200d", "中", "\r\n", "\x0b", "\x00"]


def ids(text):
    return WHOLE.encode(text or "", add_special_tokens=False).ids + [T.END_ID]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 5000), min_size=1, max_size=300))
def test_elias_fano_round_trip(gaps):
    values = np.cumsum(gaps)
    code = T.EliasFano.of(values, int(values[-1]))
    assert code.values().tolist() == values.tolist()
    assert [code.select(i) for i in range(len(values))] == values.tolist()


def test_elias_fano_is_small():
    values = np.cumsum(np.random.default_rng(0).integers(1, 2000, 10_000))
    code = T.EliasFano.of(values, int(values[-1]))
    bits = 8 * (len(code.low) + len(code.high) + len(code.samples))
    assert bits < len(values) * (2 + np.log2(values[-1] / len(values)) + 1)


def test_pieces_give_the_ids_of_whole_texts():
    draw = random.Random(1)
    table = T.Pieces(PATH)
    for _ in range(40):
        texts = ["".join(draw.choice(BITS) for _ in range(draw.randint(0, 25))) for _ in range(30)] + [None]
        flat, n = table.encode(pa.array(texts, pa.string()))
        assert flat.tolist() == [x for t in texts for x in ids(t)]
        assert n.tolist() == [len(ids(t)) for t in texts]


def test_words_are_encoded_joined_and_marks_apart():
    draw = random.Random(2)
    ends = ["", "", "", ".", "***", "###", "é.", "'", ".'s", "'s", "|>", "<|endoftext|>", "\u0301.", "12", ")", "}"]
    words = ["".join(draw.choice("abcdeéüñ中") for _ in range(draw.randint(1, 9))) + draw.choice(ends) for _ in range(3000)]
    texts = [" ".join(words[i : i + 30]) + "\n" * (i % 60 // 30) for i in range(0, len(words), 30)] + ["a<|endoftext|> b<|endoftext|>"]
    table, asked = T.Pieces(PATH), []
    real = table.tokenizer

    class Counted:
        def encode_batch_fast(self, pieces, add_special_tokens):
            asked.extend(pieces)
            return real.encode_batch_fast(pieces, add_special_tokens=add_special_tokens)

    table.tokenizer = Counted()
    flat, _ = table.encode(pa.array(texts))
    assert flat.tolist() == [x for t in texts for x in ids(t)]
    assert len(asked) < 1500 and not any(p.endswith(("a***", "é###", "é.")) for p in asked)


@pytest.mark.parametrize("block_ids", [1, 50, 1 << 20])
def test_files_round_trip(spark, block_ids):
    df = docs(spark, AWKWARD + ["same id"], ids=[5, 3, 8, 1, 2, 9, 7, -4, None, 3])
    path = f"{scratch_dir(spark, 'test')}/ids"
    T.write_ids(df, path, PATH, block_ids)
    got = sorted((tuple(r) for r in T.read_digests(spark, path).collect()), key=lambda r: r[1])
    rows = sorted(((r["doc_id"], r["text"]) for r in df.collect()), key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))
    want, start = [], 0
    for i, text in rows:
        x = ids(text)
        want.append((i, start, len(x), zlib.crc32(np.array(x, "<u4").tobytes())))
        start += len(x)
    assert got == want
    assert T.read_document(spark, path, 7) == ids(AWKWARD[6])
    assert T.read_document(spark, path, 77) == []


def test_empty_table(spark):
    path = f"{scratch_dir(spark, 'test')}/ids"
    T.write_ids(docs(spark, ["x"]).limit(0), path, PATH)
    assert T.read_digests(spark, path).collect() == []
