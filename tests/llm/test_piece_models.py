"""The piece coder on small hand-made models, with and without a character map, byte pieces and a prefix space, against the library."""

import itertools

import numpy as np
import pytest
import sentencepiece
from sentencepiece import sentencepiece_model_pb2 as proto

from pyspark.sql import functions as F
from sessionloom.llm import pieces

MERGES = ["▁t", "he", "▁the", "in", "ing", "th", "▁a", "an", "and", "▁and", "fi", "kg", "kk", "kkk", "▁▁", "aa", "a▁", "1/", "ab", "abab", "xy"]


def model(tmp_path, rule, dummy, collapse, fallback, inner, unigram=False):
    made = proto.ModelProto()
    made.trainer_spec.model_type = 1 if unigram else 2
    made.trainer_spec.byte_fallback = fallback
    made.normalizer_spec.add_dummy_prefix, made.normalizer_spec.remove_extra_whitespaces = dummy, collapse
    if rule:
        made.normalizer_spec.CopyFrom(proto.ModelProto.FromString(sentencepiece.SentencePieceNormalizer(rule_name=rule, add_dummy_prefix=dummy, remove_extra_whitespaces=collapse).serialized_model_proto()).normalizer_spec)
    kinds = [("<unk>", 2), ("<s>", 3), ("</s>", 3)] + [(f"<0x{i:02X}>", 6) for i in range(256 * fallback)]
    known = [m for m in MERGES if inner or "▁" not in m[1:] or set(m) == {"▁"}]
    kinds += [(p, 1) for p in dict.fromkeys([*known, *"▁abdefghiknptvxy1/."])]
    for i, (piece, kind) in enumerate(kinds):
        made.pieces.add(piece=piece, score=float(-(i // 2)) if kind == 1 else 0.0, type=kind)  # pairs of pieces share a score
    path = f"{tmp_path}/toy.model"
    with open(path, "wb") as f:
        f.write(made.SerializeToString())
    return path


PARTS = ["the", "and", " ", "  ", "ﬁ", "㎏", "Ａ", "kk", "kkkk", "é", "é", "日", "😀", "½", "　", "\t", "▁", "ab", "ababab", "xyz", "ing.", "１", "\xa0", "ｶﾞ", "​"]


@pytest.mark.parametrize("rule,dummy,collapse,fallback,inner", [(r, d, c, b, i) for r, d, c, b, i in itertools.product([None, "nmt_nfkc"], [True, False], [True, False], [True, False], [True, False])])
def test_like_the_library(tmp_path, rule, dummy, collapse, fallback, inner):
    path = model(tmp_path, rule, dummy, collapse, fallback, inner)
    own, library = pieces.PieceCoder(path), sentencepiece.SentencePieceProcessor(model_file=path)
    assert bool(own.map.units) == bool(rule) and own.by_chunk != inner
    rng = np.random.default_rng(7)
    texts = ["".join(rng.choice(PARTS, rng.integers(0, 12))) for _ in range(400)]
    ids, decoded, numbers, starts, ends, many = own.coded(texts)
    at = 0
    for text, joined, back, n in zip(texts, ids, decoded, many, strict=True):
        wanted = library.encode(text)
        assert joined == ",".join(map(str, wanted)) and numbers[at : at + n].tolist() == wanted, text
        assert back == library.decode(wanted) == own.decode(wanted), text
        s, e = starts[at : at + n], ends[at : at + n]
        size = len(text.encode())
        assert (s <= e).all() and (np.diff(s) >= 0).all() and (np.diff(e) >= 0).all() and (not n or (s[0] >= 0 and e[-1] <= size))
        if not collapse and n:  # the spans cover the source
            assert s[0] == 0 and e[-1] == size and (s[1:] <= e[:-1]).all() or rule
        at += n


def test_spans_of_mapped_characters(tmp_path):
    """A ligature and a square unit become two code points each; each piece points at the bytes it came from."""
    coder = pieces.PieceCoder(model(tmp_path, "nmt_nfkc", True, False, True, False))
    done = coder.full("the ﬁ㎏ the")
    shown = [(coder.surface[i], "the ﬁ㎏ the".encode()[s:e].decode()) for i, s, e in zip(done.ids, done.starts, done.ends, strict=True)]
    assert shown == [("▁the", "the"), ("▁", " "), ("fi", "ﬁ"), ("kg", "㎏"), ("▁the", " the")]


def test_long_chunks_and_rounds(tmp_path):
    path = model(tmp_path, None, True, False, True, False)
    own, library = pieces.PieceCoder(path), sentencepiece.SentencePieceProcessor(model_file=path)
    texts = ["kab" * n + "x" * (n % 3) for n in range(1, 60)] + ["a" * 5_000, "日" * 300]
    assert own.coded(texts)[0] == [",".join(map(str, library.encode(t))) for t in texts]


def test_other_models_are_refused(tmp_path):
    with pytest.raises(ValueError):
        pieces.PieceCoder(model(tmp_path, None, True, False, True, False, unigram=True))


def test_round_trip_by_ids(spark, tmp_path):
    path = model(tmp_path, "nmt_nfkc", True, True, True, True)
    rows = [(1, "the ﬁ  and"), (2, None), (3, ""), (3, " ")]
    done = pieces.encoded(spark.createDataFrame(rows, "doc_id long, text string"), path)
    back = {(r.doc_id, r.decoded) for r in pieces.decoded(done, path).collect()}
    assert back == {(1, "the fi and"), (2, ""), (3, "")} == {(r.doc_id, r.decoded) for r in done.select("doc_id", "decoded", F.size("ids")).collect()}


def test_every_text_comes_from_its_ids(documents):
    """Ids that are changed behind the encoder change all decoded texts, as the library decodes them."""
    import sentencepiece

    from sessionloom.llm import queries

    library = sentencepiece.SentencePieceProcessor(model_file=queries.model_file())

    class Turned(pieces.PieceCoder):
        def chunks(self, texts):
            ids, steps, many = super().chunks(texts)
            return (ids + 1) % len(self.surface), steps, many

    texts = [r.text for r in documents.select("text").collect()] + [None, "", " ", "é😀 \x00", "plain words"]
    for kind in (pieces.PieceCoder, Turned):
        joined, back, *_ = kind(queries.model_file()).coded(texts)
        ids = [[int(x) for x in row.split(",") if x] for row in joined]
        assert back == [library.decode(row) for row in ids]
        assert (back == [t or "" for t in texts]) == (kind is pieces.PieceCoder)
