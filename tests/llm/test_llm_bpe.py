import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from postscope.llm import bpe as S

LIBRARY = Tokenizer.from_file(S.default_path())
ODD = ["", "<|endoftext|>", "a<|endoftext|><|endoftext|> b", "aaaaaaaaaa aaaaa", " \n\n  x", "\0\0<|endoftext|>", "it's we'LL 'S don't", "   x\t\ty", "hahahahaha" * 30,
       "ababababa" * 9, "ııııİ", "你好世界 １２３", "a" * 5000, " " * 3000, "\U00010940x ՘y", "￿�", "x\x1c\x85​　 y", "<|endoftext", "é" * 777]


def encoded(texts):
    e = S.encoder(S.default_path())
    ids, counts = e.encode(texts)
    return [x.tolist() for x in np.split(ids, np.cumsum(counts)[:-1])]


def test_ids_and_texts_equal_the_library():
    want = LIBRARY.encode_batch(ODD, add_special_tokens=False)
    assert encoded(ODD) == [w.ids for w in want]
    v = S.encoder(S.default_path()).v
    for w in want:
        assert S.decode_ids(w.ids, v) == LIBRARY.decode(w.ids, skip_special_tokens=False)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(max_size=40) | st.text(alphabet="ab 'sl\n\t1é<|>你😀՘\U00010940", max_size=60), min_size=1, max_size=6))
def test_random_texts(texts):
    assert encoded(texts) == [w.ids for w in LIBRARY.encode_batch(texts, add_special_tokens=False)]


def test_any_ids_decode_like_the_library():
    rng = random.Random(4)
    v = S.encoder(S.default_path()).v
    for _ in range(300):
        ids = [rng.randrange(v.size) for _ in range(rng.randrange(30))]
        assert S.decode_ids(ids, v) == LIBRARY.decode(ids, skip_special_tokens=False)


def test_a_full_table_changes_nothing(monkeypatch):
    monkeypatch.setattr(S, "TABLE", 3)
    for t in ODD:
        assert encoded([t, "more words here"]) == [w.ids for w in LIBRARY.encode_batch([t, "more words here"], add_special_tokens=False)]


def test_rules_out_of_order_are_refused(tmp_path):
    import json
    spec = json.load(open(S.default_path(), encoding="utf-8"))
    spec["model"]["merges"] = spec["model"]["merges"][::-1]
    (tmp_path / "v.json").write_text(json.dumps(spec))
    with pytest.raises(ValueError):
        S.Vocabulary(str(tmp_path / "v.json"))


def test_frames_round_trip(spark, monkeypatch):
    data = [(k, t) for k, t in enumerate(ODD)] + [(None, "null id"), (70, None), (3, ODD[3]), (71, "long text " * 50000)]
    docs = spark.createDataFrame([(*r, "x", "y") for r in data], "doc_id bigint, text string, ids string, decoded string")
    got = S.decode(S.encode(docs)).collect()
    assert sorted(((r.doc_id, r.decoded) for r in got), key=str) == sorted(((i, t or "") for i, t in data), key=str)
    assert S.decode(S.encode(docs.limit(0))).count() == 0
    kept = S.encode(docs.select("doc_id", "text"), keep=("doc_id", "text"))
    assert kept.columns == ["doc_id", "text", "ids"] and kept.where("doc_id = 70").first().ids == []


def test_kept_columns_may_have_the_results_names(spark):
    docs = spark.createDataFrame([(1, "two words", "own", "mine")], "doc_id bigint, text string, ids string, _text string")
    out = S.encode(docs, keep=("doc_id", "ids", "_text", "text"), decoded=True)
    row = out.first()
    assert out.columns == ["doc_id", "ids", "_text", "text", "_ids", "decoded"] and (row["ids"], row["_text"], row["decoded"]) == ("own", "mine", "two words")
