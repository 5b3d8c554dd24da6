"""Ids of texts that hold the strings of special tokens, against the library as it comes."""

import zlib

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st
from tokenizers import Tokenizer

from namepulse.llm import packing, token_files, tokens
from namepulse.llm.tokens import public_path

FILES = [("byte_bpe_50k.json", "byte_level"), ("word_bpe_49k.json", "words")]
PART = st.sampled_from(
    ["<|endoftext|>", "<|startoftext|>", "<|endoftext", "|>", "<|ENDOFTEXT|>", " ", "\n", "a", " hello", "world ", "é.", "\x01", "  "]
)


@pytest.mark.parametrize("file, cut", FILES)
def test_special_strings_get_the_librarys_ids(file, cut):
    library = Tokenizer.from_file(public_path(file))
    encode = tokens.UnitEncoder(public_path(file), cut, max_units=30, special=True)

    @given(st.lists(st.lists(PART, max_size=9).map("".join), min_size=1, max_size=5))
    @settings(max_examples=300, deadline=None)
    def check(texts):
        ids, ends = encode.encode(texts)
        want = [library.encode(t, add_special_tokens=False).ids for t in texts]
        assert [x.tolist() for x in np.split(ids, ends[:-1])] == want

    check()


TEXTS = ["hello <|endoftext|> world", "<|endoftext|>", "a<|endoftext|><|startoftext|>b", "no such string", "", None]


def docs_of(spark):
    return spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string").repartition(2)


def test_token_files_of_special_strings(spark, tmp_path):
    library = Tokenizer.from_file(public_path("byte_bpe_50k.json"))
    token_files.write(docs_of(spark), str(tmp_path / "f"), public_path("byte_bpe_50k.json"))
    found = {r["doc_id"]: r["ids"] for r in token_files.read(spark, str(tmp_path / "f")).collect()}
    assert found == {i: library.encode(t or "", add_special_tokens=False).ids + [2] for i, t in enumerate(TEXTS)}
    assert found[0] == [31373, 220, 50256, 995, 2]


def test_packing_of_special_strings(spark):
    library = Tokenizer.from_file(public_path("word_bpe_49k.json"))
    rows = packing.pack(docs_of(spark), public_path("word_bpe_49k.json")).collect()
    for r in rows:
        ids = library.encode(TEXTS[r["doc_id"]] or "", add_special_tokens=False).ids + [0]
        assert (r["length"], r["ids_crc32"]) == (len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
    assert len(rows) == len(TEXTS)
