import random
import re

import numpy as np

from ledgerline.llm import common, hashing


def test_words_and_runs_follow_the_word_pattern(monkeypatch):
    rng = random.Random(3)
    alphabet = "aAbé\u00a0\u3000Ü🙂 \t\n\x0b\x0c\r\x1c-"
    texts = ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 40))) for _ in range(400)]
    texts += [None, "", " ", "a", "x" * 5000 + " " + "x" * 5001]
    plain = [re.findall(common.WORD, re.sub("[A-Z]", lambda m: m[0].lower(), t or "")) for t in texts]
    hashes, counts = hashing.word_hashes(texts)
    assert counts.tolist() == [len(p) for p in plain]
    seen = {}
    for word, value in zip([w for p in plain for w in p], hashes.tolist()):
        assert seen.setdefault(word, value) == value
    assert len(set(seen.values())) == len(seen)
    monkeypatch.setattr(hashing, "CHUNK_BYTES", 64)
    for k in (1, 3, 5):
        known = {}
        for words, runs in zip(plain, hashing.run_hashes(texts, k), strict=True):
            expected = [tuple(words[i : i + k]) for i in range(max(1, len(words) - k + 1))] if words else []
            assert len(runs) == len(expected)
            for run, value in zip(expected, runs.tolist()):
                assert known.setdefault(run, value) == value
        assert len(set(known.values())) == len(known)
    assert hashing.word_hashes([])[1].tolist() == [] and hashing.word_hashes([None])[1].tolist() == [0]


def test_crc_cache_forgets_and_agrees():
    ids = hashing.WordIds(limit=2)
    first = ids(["a", "b", "c", "a"])
    assert ids(["c", "a"]).tolist() == [first[2], first[0]] and first.dtype == np.uint32
