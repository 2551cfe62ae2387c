"""Operator 5: ids of texts that hold a special token's string."""

import struct
import zlib

import public_tokenizers
from tokenizers import Tokenizer

from wikisift.llm.packing import CLOSING_ID, pack
from wikisift.llm.tokens import SPECIAL, TOKENIZER_FILE, encoder


def test_ids_are_those_of_the_file(spark):
    tokenizer = Tokenizer.from_file(public_tokenizers.path(TOKENIZER_FILE))  # default setting
    assert [x.content for x in tokenizer.get_added_tokens_decoder().values()] == [SPECIAL]
    texts = [SPECIAL, f"a {SPECIAL} b", f"{SPECIAL}{SPECIAL}\n x", "<|endoftext| >", "plain words", f"é😀{SPECIAL}" + " " * 70 + "z", "x" * 3000 + SPECIAL]
    want = [tokenizer.encode(t, add_special_tokens=False).ids for t in texts]
    assert [encoder().file_ids(t).tolist() for t in texts] == want
    assert tokenizer.token_to_id(SPECIAL) in want[1]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {}
    for r in pack(df, with_ids=True).collect():
        got.setdefault(r["doc_id"], []).append((r["start"], list(struct.unpack(f"<{r['length']}I", r["ids"]))))
        assert zlib.crc32(r["ids"]) == r["ids_crc32"] and r["doc_tokens"] == len(want[r["doc_id"]]) + 1
    assert {d: sum((x for _, x in sorted(p)), []) for d, p in got.items()} == {d: [*x, CLOSING_ID] for d, x in enumerate(want)}
