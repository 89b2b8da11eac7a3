import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from sentencepiece import sentencepiece_model_pb2

from orelake.llm import sentence_pieces as sp
from tests.llm.helpers import AWKWARD, docs

MODEL = public_tokenizers.path("piece_bpe_32k.model")
LIBRARY = sentencepiece.SentencePieceProcessor(model_file=MODEL)
PIECES = sp.Model(MODEL)


def whole(text):
    ids = LIBRARY.encode(text or "", add_eos=True)
    return ids, LIBRARY.decode(ids)


def by_chunks(texts):
    chunks, codes, sizes = sp.chunked(pa.array(texts, pa.string()))
    ids = PIECES.encode(chunks)
    decoded = PIECES.decode(chunks, ids)
    out, at = [], 0
    for n in sizes.tolist():
        own = codes[at : at + n].tolist()
        out.append(([i for c in own for i in ids[c]] + [PIECES.end], "".join(decoded[c] for c in own)[1:]))
        at += n
    return out


@settings(max_examples=400, deadline=None)
@given(st.lists(st.text(st.one_of(st.sampled_from(" \n▁\x1f\ta.é<0x>/s"), st.characters(exclude_categories=("Cs",)))), max_size=6))
def test_chunks_equal_whole_texts(texts):
    assert by_chunks(texts) == [whole(t) for t in texts]


MORE = [" ", "  ", " a", "a ", "a  b", "a\nb", "\n", "\n\n a", " \n", "a \n b", "x▁y", "▁", "</s>", "<0x0A>", "a" + " " * 50 + "b", "\r\n\t\xa0"]


@pytest.mark.parametrize("slice_text", [1, 200, 8 << 20])
def test_equals_the_library(spark, slice_text):
    texts = [*AWKWARD, *MORE, None, "one"]
    ids = [*range(len(texts) - 2), None, 3]  # a null id and a repeated one
    found = sp.encoded(docs(spark, texts, ids).repartition(3), MODEL, slice_text).collect()
    want = [(i, *whole(t)) for i, t in zip(ids, texts)]
    assert sorted([(r["doc_id"], r["ids"], r["decoded"]) for r in found], key=str) == sorted(want, key=str)


def test_query_columns_over_a_test_table(spark, small):
    from orelake.llm.queries import op11_sentence_pieces

    import hashlib

    found = {r["doc_id"]: r for r in op11_sentence_pieces(spark, small).collect()}
    texts = spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text").collect()
    assert len(found) == len(texts)
    for doc_id, text in texts:
        ids, decoded = whole(text)
        r = found[doc_id]
        assert r["n_tokens"] == len(ids)
        assert r["ids_sha256"] == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(decoded.encode()).hexdigest()


def test_each_chunk_is_segmented_once():
    asked = []

    class Watched(sp.Model):
        def encode(self, chunks):
            asked.extend(chunks)
            return super().encode(chunks)

    table = sp.Table(Watched(MODEL))
    texts = pa.array(["a b a\nb", "a a c", None, "b  b"])
    ids = pa.array([1, 2, 3, 4], pa.int64())
    for _ in range(2):
        rows = [r for b in sp.encoded_slice(ids, texts, table) for r in b.to_pylist()]
        assert [(r["ids"], r["decoded"]) for r in rows] == [whole(t) for t in texts.to_pylist()]
    assert len(asked) == len(set(asked))


def test_the_table_forgets_what_is_not_asked_for_again():
    from orelake.llm.common import Recent

    held = Recent(3)
    for i in range(20):
        held.put(i, str(i))
        assert held.many([0]) == ["0"]
    assert len(held.young) <= 3 and len(held.old) <= 3 and held.many([1]) == [None] and held.many([19]) == ["19"]


def test_empty_table(spark):
    found = sp.encoded(docs(spark, ["x"]).limit(0), MODEL)
    assert found.columns == ["doc_id", "ids", "decoded"] and found.count() == 0


def test_models_with_pieces_across_markers_are_refused():
    proto = sentencepiece_model_pb2.ModelProto()
    proto.ParseFromString(LIBRARY.serialized_model_proto())
    sp.check(proto)
    proto.pieces[500].piece = "a▁b"
    with pytest.raises(ValueError):
        sp.check(proto)
