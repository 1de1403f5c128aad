"""Ids of texts that hold added tokens of the tokenizer file, as ``tokenizers`` gives them."""

from __future__ import annotations

import json
import random
import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from rivulet.llm import packing, queries

END = "<|endoftext|>"


def plain_ids(path, texts):
    tool = Tokenizer.from_file(path)
    return [e.ids for e in tool.encode_batch(texts, add_special_tokens=False)]


def some_texts(parts):
    draw = random.Random(9)
    texts = ["".join(draw.choice(parts) for _ in range(draw.randrange(30))) for _ in range(1500)]
    return texts + ["", END, END * 3, f"hello{END}x", f" a  {END}  b \n {END}\n", END[:-1], f"<{END}>", END.upper()]


def test_text_encoder_against_the_tokenizer():
    texts = some_texts([END, "<|", "|>", "endoftext", " ", " ", "\n", "a", "bee", "'s", "12", ".", "é", "日本"])
    encoder = packing.TextEncoder(queries.byte_bpe())
    found = [np.frombuffer(encoder.encode(t), "<u4").tolist() for t in texts]
    assert found == plain_ids(queries.byte_bpe(), texts)
    assert found[texts.index(f"hello{END}x")] == [31373, 50256, 87]


def test_several_added_tokens(tmp_path):
    with open(queries.byte_bpe(), encoding="utf-8") as file:
        model = json.load(file)
    first = model["added_tokens"][0]
    for n, content in enumerate(("<a>", "<a><b>", "b c")):
        model["added_tokens"].append({**first, "id": 50257 + n, "content": content})
    path = tmp_path / "more.json"
    path.write_text(json.dumps(model), encoding="utf-8")
    texts = some_texts(["<a>", "<b>", "b c", "b ", "c", " ", "\n", "ab", END])
    encoder = packing.TextEncoder(str(path))
    assert [np.frombuffer(encoder.encode(t), "<u4").tolist() for t in texts] == plain_ids(str(path), texts)
    model["added_tokens"][-1]["lstrip"] = True
    path.write_text(json.dumps(model), encoding="utf-8")
    with pytest.raises(ValueError):
        packing.TextEncoder(str(path))


def test_packed_ids_of_added_tokens(spark):
    rows = [(1, f"hello{END}x"), (2, END), (3, f"one two {END} three"), (4, "plain"), (5, None)]
    placed = packing.pack(spark.createDataFrame(rows, "doc_id bigint, text string"), queries.byte_bpe()).collect()
    want = {i: [*ids, 0] for (i, _), ids in zip(rows, plain_ids(queries.byte_bpe(), [t or "" for _, t in rows]))}
    assert {r.doc_id: (r.length, r.ids_crc32) for r in placed} == {
        i: (len(ids), zlib.crc32(np.array(ids, dtype="<u4").tobytes())) for i, ids in want.items()}
