"""Token files against the plain library call, which matches the vocabulary's added tokens."""

import zlib

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from tidewater.llm import planes

JSON = public_tokenizers.path("byte_bpe_50k.json")
TEXTS = ["a<|endoftext|>b", "<|endoftext|>", "<|endoftext|><|endoftext|> x", "one <|endoftext|> two\n<|endoftext|>", "<|endof",
         "text|> c", "é<|endoftext|>中文 <|endoftext|", "", None, "plain words"]


def test_added_tokens_have_their_ids(spark):
    library = Tokenizer.from_file(JSON)
    docs = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id bigint, text string").coalesce(1)
    out = planes.token_files(docs, JSON).orderBy("start").collect()
    start = 0
    for (i, text), r in zip(enumerate(TEXTS), out, strict=True):
        ids = library.encode(text or "", add_special_tokens=False).ids + [planes.END_ID]
        assert (r.doc_id, r.start, r.n_tokens, r.ids_crc32) == (i, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)
