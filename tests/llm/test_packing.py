"""Token ids that packing rests on, against the tokenizer as it is in its file."""

import zlib

import numpy as np
from tokenizers import Tokenizer

from keyflow.llm import packing

PATH, RANKS = packing.tokenizer_path("byte_bpe_50k.json"), packing.tokenizer_path("byte_bpe_50k.tiktoken")
TEXTS = ["one <|endoftext|> two", "<|endoftext|>", "a<|endoftext|>b c", "end <|endoftext|>", "x  <|endoftext|>\n\n y",
         "<|endoftext|><|endoftext|> twice", "near <|endoftext| > miss", "plain words only"]


def test_special_tokens_are_encoded_as_the_file_says(spark):
    tok = Tokenizer.from_file(PATH)
    want = [tok.encode(t, add_special_tokens=False).ids for t in TEXTS]
    assert want[0] == [505, 220, 50256, 734]
    for ranks in (RANKS, None):
        assert [x.tolist() for x in packing.Encoder(PATH, ranks).ids(TEXTS)] == want
    got = packing.pack(spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string"), PATH, RANKS).collect()
    crc = [zlib.crc32(np.array([*ids, packing.END_ID], "<u4").tobytes()) for ids in want]
    assert {r["doc_id"]: (r["length"], r["ids_crc32"]) for r in got} == {
        i: (len(ids) + 1, c) for i, (ids, c) in enumerate(zip(want, crc, strict=True))}
