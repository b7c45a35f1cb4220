import hashlib
import json
import random

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from tripsmith.llm.bpe import Codec, digests

PATH = public_tokenizers.path("byte_bpe_50k.json")


def library_rows(pairs):
    t = Tokenizer.from_file(PATH)
    out = {}
    for i, text in pairs:
        ids = t.encode(text or "", add_special_tokens=False).ids
        back = t.decode(ids, skip_special_tokens=False)
        out[i] = (len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(back.encode()).hexdigest())
    return out


def test_random_unicode_equals_the_library():
    t, c = Tokenizer.from_file(PATH), Codec(json.load(open(PATH)))
    rng = random.Random(1)
    pool = [*map(chr, range(0, 0x250)), " ", "　", "\x85", "​", "\U0001f600", "一", "̀", "'s", "'ll", "  ", "\n\n",
            "<|endoftext|>", " the"]
    for _ in range(3000):
        s = "".join(rng.choice(pool) for _ in range(rng.randint(0, 25)))
        ids = t.encode(s, add_special_tokens=False).ids
        assert ids == np.frombuffer(c.encode(s), "<u4").tolist()
        assert t.decode(ids, skip_special_tokens=False) == c.decode(c.encode(s))


def test_rows(make_docs):
    pairs = [(1, None), (2, ""), (3, "Hello world, it's 42 degrees"), (4, "x" * 30_000), (5, "word " * 20_000),
             (6, "<|endoftext|>a<|endoftext|>"), (7, "\n\t   x "), (None, "no id")]
    got = {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in digests(make_docs(pairs), PATH).collect()}
    assert got == library_rows(pairs)
    twice = digests(make_docs([(3, "same"), (3, "same")]), PATH).collect()
    assert len(twice) == 2 and twice[0] == twice[1]
    assert digests(make_docs([]), PATH).count() == 0
