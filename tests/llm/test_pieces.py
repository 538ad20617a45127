"""op11 and op13 against the tokenizer libraries, one text at a time."""
import hashlib
import random
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece

from costlake.llm import piece_encoding, token_alignment
from costlake.llm.piece_model import Encoder, fields
from costlake.llm.queries import QUERIES
from tests.conftest import SF_SMALL

MODEL = piece_encoding.read_model(public_tokenizers.path("piece_bpe_32k.model"))
BYTE_BPE = piece_encoding.read_model(public_tokenizers.path("byte_bpe_50k.json"))
ODD = ["", " ", "   ", "a", "Héllo  world ﬁ ▁ x", "éé x", "😀 hi\t\n  z  ", "日本語 テスト", "\x00\x01 a", "ﷺ x ﷺ ",
       "é é́", " 　 x", "​", "①② ", "a▁ ", "x" * 5000, "­", "<s></s><unk>", "<|endoftext|>", "<0x41>"]


def mixed_texts(n=400):
    rng = random.Random(3)
    parts = list("ab  \t\n　éﬁ①́😀日▁​Å가ｶﾞ…™\x00") + ["the ", "Hello", "<|endoftext|>", "<s>", " " * 20]
    return ODD + ["".join(rng.choice(parts) for _ in range(rng.randint(0, 30))) for _ in range(n)]


def message(number, data):
    size, n = b"", len(data)
    while True:
        size += bytes([n & 127 | (128 if n > 127 else 0)])
        n >>= 7
        if not n:
            return bytes([number << 3 | 2]) + size + data


def with_normaliser(rule, prefix, squeeze, escape):
    """The model with another normaliser: one of the library's compiled maps."""
    made = sentencepiece.SentencePieceNormalizer(rule_name=rule).serialized_model_proto()
    spec = dict(fields([v for k, v in fields(made) if k == 3][-1]))
    flags = bytes([3 << 3, prefix, 4 << 3, squeeze, 5 << 3, escape])
    return MODEL + message(3, message(2, spec.get(2, b"")) + flags)


@pytest.mark.parametrize("rule,prefix,squeeze,escape", [
    (None, 1, 0, 1), ("identity", 1, 1, 1), ("nmt_nfkc", 1, 1, 1), ("nmt_nfkc", 0, 1, 0), ("nfkc_cf", 1, 0, 1), ("nfkc", 0, 0, 0)])
def test_ids_and_spans_are_the_librarys(rule, prefix, squeeze, escape):
    model = with_normaliser(rule, prefix, squeeze, escape) if rule else MODEL
    lib = sentencepiece.SentencePieceProcessor(model_proto=model)
    texts = mixed_texts()
    got = Encoder(model)([t.encode() for t in texts])
    for t, (ids, spans) in zip(texts, got):
        assert ids.tolist() == lib.encode(t, add_bos=True, add_eos=True)
        pieces = lib.encode(t, return_type="proto").pieces
        assert spans.tolist() == [[0, 0], *[[p.begin, p.end] for p in pieces], [len(t.encode())] * 2]


def test_user_defined_symbols_stay_as_they_are():
    symbol = "ﬁ x"
    piece = message(1, message(1, symbol.encode()) + bytes([3 << 3, 4]))
    model = with_normaliser("nmt_nfkc", 1, 0, 1) + piece
    lib = sentencepiece.SentencePieceProcessor(model_proto=model)
    for t in ["a ﬁ xﬁ x ﬁ", symbol, "ﬁ  x"]:
        ids, spans = Encoder(model)([t.encode()])[0]
        assert ids.tolist() == lib.encode(t, add_bos=True, add_eos=True)
        assert spans.tolist()[1:-1] == [[p.begin, p.end] for p in lib.encode(t, return_type="proto").pieces]


def test_encode_rows(spark):
    rows = [(1, "a b", "x", "y", 5), (1, "a b", "x", "y", 5), (2, None, None, None, None), (3, "", "", "", 0),
            (None, "long " * 40_000, "x", "y", 1)]
    d = spark.createDataFrame(rows, "doc_id bigint, text string, ids string, spans string, more int")
    out = piece_encoding.encode(d, MODEL)
    assert out.columns == ["doc_id", "text", "more", "ids", "spans", "decoded"]
    lib = sentencepiece.SentencePieceProcessor(model_proto=MODEL)
    for r in out.collect():
        want = lib.encode(r["text"] or "", add_bos=True, add_eos=True)
        assert np.frombuffer(r["ids"], "<u4").tolist() == want and r["decoded"] == lib.decode(want)
        assert len(r["spans"]) == 2 * len(r["ids"])
    assert out.count() == 5 and piece_encoding.encode(d.limit(0), MODEL).count() == 0


def test_op11_is_the_library(spark):
    lib = sentencepiece.SentencePieceProcessor(model_proto=MODEL)
    docs = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()}
    got = QUERIES["op11_piece_encoding"](spark, SF_SMALL).collect()
    assert len(got) == len(docs)
    for r in got:
        ids = lib.encode(docs[r["doc_id"]], add_bos=True, add_eos=True)
        spans = np.array([[0, 0], *[[p.begin, p.end] for p in lib.encode(docs[r["doc_id"]], return_type="proto").pieces],
                          [len(docs[r["doc_id"]].encode())] * 2], "<u4")
        assert (r["n_tokens"], r["ids_sha256"], r["decoded_sha256"], r["spans_sha256"]) == (
            len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(),
            hashlib.sha256(lib.decode(ids).encode()).hexdigest(), hashlib.sha256(spans.tobytes()).hexdigest())


# --- alignment, token by token --------------------------------------------------------------

ALIGNER = token_alignment.Aligner(BYTE_BPE, MODEL)
BYTE_OF = token_alignment.byte_alphabet()
A_FILE = ALIGNER.a.own
B_MODEL = sentencepiece.SentencePieceProcessor(model_proto=MODEL)
A_NAME = {i: n for n, i in A_FILE.get_vocab().items()}


def align_one(text):
    """((n_a, n_b, n_groups, n_links, groups), Counter of linked pairs)."""
    a = A_FILE.encode(" " + text, add_special_tokens=False).ids if text else []
    b = B_MODEL.encode(text) if text else []
    as_bytes = [bytes(BYTE_OF[c] for c in A_NAME[i]) for i in a]
    bs_bytes = []
    for i in b:
        p = B_MODEL.id_to_piece(i)
        bs_bytes.append(bytes([int(p[3:5], 16)]) if B_MODEL.is_byte(i) else p.encode().replace("▁".encode(), b" "))
    whole = (" " + text).encode()
    if not text or b"".join(as_bytes) != whole or b"".join(bs_bytes) != whole:
        return (0, 0, 0, 0, ""), Counter()
    ends_a, ends_b = np.cumsum([len(x) for x in as_bytes]).tolist(), np.cumsum([len(x) for x in bs_bytes]).tolist()
    groups, pairs, i, j = [], Counter(), 0, 0
    for cut in sorted(set(ends_a) & set(ends_b)):
        ga, gb = [], []
        while i < len(a) and ends_a[i] <= cut:
            ga, i = [*ga, a[i]], i + 1
        while j < len(b) and ends_b[j] <= cut:
            gb, j = [*gb, b[j]], j + 1
        groups.append(",".join(map(str, ga)) + "|" + ",".join(map(str, gb)))
        pairs.update((x, y) for x in ga for y in gb)
    digest = hashlib.sha256(";".join(groups).encode()).hexdigest()
    return (len(a), len(b), len(groups), sum(pairs.values()), digest), pairs


def align_all(texts):
    one = {t: align_one(t or "") for t in set(texts)}
    docs = Counter()
    for t in texts:
        docs.update(one[t][1].keys())
    top = {}
    for (a, _), n in docs.items():
        top[a] = max(top.get(a, 0), n)
    return [one[t][0] + (sum(n for p, n in one[t][1].items() if docs[p] == top[p[0]]),
                         sum(n * docs[p] for p, n in one[t][1].items())) for t in texts]


def test_both_sides_take_their_fast_way():
    assert ALIGNER.a.fast is not None and ALIGNER.b.by_word
    assert ALIGNER.a._settled("plain text\n\té 日本") and not ALIGNER.a._settled("\x1c") and not ALIGNER.a._settled("a\u200b")
    assert not token_alignment.WordPieces(with_normaliser("nmt_nfkc", 1, 1, 1)).by_word


def test_words_in_and_out_of_memory(monkeypatch):
    monkeypatch.setattr(token_alignment.WordPieces, "KEPT", 3)
    words = token_alignment.WordPieces(MODEL)
    texts = mixed_texts(200) + ["long" * 100 + " x", "  ▁ ▁a ▁"]
    for t in texts:
        assert words([t, t])[1].tolist() == B_MODEL.encode(t)


@pytest.mark.parametrize("max_links,wide", [(1, 8), (7, 0), (1 << 21, 1), (1 << 21, 8)])
def test_aligner(monkeypatch, max_links, wide):
    monkeypatch.setattr(token_alignment, "MAX_LINKS", max_links)
    monkeypatch.setattr(token_alignment, "WIDE", wide)
    texts = mixed_texts(300)
    got = ALIGNER([t.encode() for t in texts])
    for k, t in enumerate(texts):
        want, pairs = align_one(t)
        assert tuple(int(got[c][k]) for c in ("n_a", "n_b", "n_groups", "n_links")) + (got["groups_sha256"][k],) == want
        assert dict(zip(got["pairs"][k].as_py(), got["times"][k].as_py())) == {a << 32 | b: n for (a, b), n in pairs.items()}
    assert [pa.array(v).to_pylist() if not isinstance(v, pa.Array) else v.to_pylist() for v in ALIGNER([b"", b""]).values()] == \
        [[0, 0], [0, 0], [0, 0], [0, 0], ["", ""], [[], []], [[], []]]


@pytest.mark.parametrize("max_broadcast", [0, 40, 10**6])
def test_align_rows(spark, max_broadcast):
    texts = [t for t in mixed_texts(60)] + ["a b"] * 9 + ["Hello world", None, None, "", "the the " * 30_000]
    d = spark.createDataFrame([(i, t, "x", i) for i, t in enumerate(texts)], "doc_id bigint, text string, n_links string, tid int")
    out = token_alignment.align(d, BYTE_BPE, MODEL, max_broadcast=max_broadcast)
    assert out.columns == ["doc_id", "text", "tid", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    got = {r["doc_id"]: (r["n_a"], r["n_b"], r["n_groups"], r["n_links"], r["groups_sha256"], r["n_best"], r["count_sum"])
           for r in out.collect()}
    assert got == dict(enumerate(align_all(texts)))
    assert token_alignment.align(d.limit(0), BYTE_BPE, MODEL).count() == 0


def test_op13_is_brute_force(spark):
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()]
    got = {r["doc_id"]: (r["n_a"], r["n_b"], r["n_groups"], r["n_links"], r["groups_sha256"], r["n_best"], r["count_sum"])
           for r in QUERIES["op13_token_alignment"](spark, SF_SMALL).collect()}
    assert got == dict(zip([i for i, _ in docs], align_all([t for _, t in docs])))
