"""Cross-tokenizer alignment against a byte-by-byte brute force, and the runs it is counted with."""

import hashlib
import random
from collections import Counter

import numpy as np
import public_tokenizers
import sentencepiece
from tokenizers import Tokenizer

from ledgerline.llm import token_pairs as tp

A_FILE = public_tokenizers.path("byte_bpe_50k.json")
B_FILE = public_tokenizers.path("piece_bpe_32k.model")


def printable_bytes():
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    table, more = {chr(b): b for b in plain}, 256
    for b in range(256):
        if b not in plain:
            table[chr(more)] = b
            more += 1
    return table


def brute_force(rows):
    """Expected result rows, in order: every byte knows its A and its B token."""
    a_own, b_own = Tokenizer.from_file(A_FILE), sentencepiece.SentencePieceProcessor(model_file=B_FILE)
    a_own.encode_special_tokens = True
    to_byte, counts, texts = printable_bytes(), Counter(), []
    for _, text in rows:
        wanted = (" " + (text or "")).encode()
        a = a_own.encode(" " + text, add_special_tokens=False).ids if text else []
        b = b_own.encode(text) if text else []
        a_bytes = [bytes(to_byte[c] for c in a_own.id_to_token(i)) for i in a]
        b_bytes = []
        for piece in map(b_own.id_to_piece, b):
            as_byte = len(piece) == 6 and piece.startswith("<0x") and piece.endswith(">")
            b_bytes.append(bytes([int(piece[3:5], 16)]) if as_byte else piece.replace("▁", " ").encode())
        if not text or b"".join(a_bytes) != wanted or b"".join(b_bytes) != wanted:
            texts.append(None)
            continue
        at_a = [i for i, x in enumerate(a_bytes) for _ in x]
        at_b = [i for i, x in enumerate(b_bytes) for _ in x]
        links = sorted(set(zip(at_a, at_b)))
        groups, start = [], 0
        for i in range(1, len(wanted) + 1):
            if i == len(wanted) or (at_a[i] != at_a[i - 1] and at_b[i] != at_b[i - 1]):
                groups.append((sorted({*at_a[start:i]}), sorted({*at_b[start:i]})))
                start = i
        line = ";".join(
            ",".join(str(a[i]) for i in x) + "|" + ",".join(str(b[i]) for i in y) for x, y in groups
        )
        pairs = [(a[i], b[j]) for i, j in links]
        counts.update(pairs)
        texts.append((len(a), len(b), len(groups), pairs, hashlib.sha256(line.encode()).hexdigest()))
    most = {}
    for (_, b), n in counts.items():
        most[b] = max(most.get(b, 0), n)
    out = []
    for (doc_id, _), found in zip(rows, texts):
        if found is None:
            out.append((doc_id, 0, 0, 0, 0, 0, 0, ""))
            continue
        n_a, n_b, n_groups, pairs, digest = found
        best = sum(counts[p] == most[p[1]] for p in pairs)
        out.append((doc_id, n_a, n_b, n_groups, len(pairs), best, sum(counts[p] for p in pairs), digest))
    return out, counts, most


def in_order(rows):
    return sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[1:]))


def sample_rows():
    rng = random.Random(11)
    words = ["the", "of", "Tokenizer", "naïve", "straße", "漢字", "don't", "42", "x=1;", "\n", "<s>", "<|endoftext|>"]
    rows = [(i, " ".join(rng.choice(words) for _ in range(rng.randrange(1, 30)))) for i in range(120)]
    odd = [None, "", " ", "  two  spaces ", "tab\there", "▁low line", "<0x41>", "ﬁ ligature ｆｕｌｌ", "é", "\x00"]
    rows += [(1000 + i, t) for i, t in enumerate(odd)]
    return [*rows, (7, rows[7][1]), (None, "no id here"), (2000, "the of " * 4000)]


def test_alignment_against_brute_force(spark, monkeypatch):
    monkeypatch.setattr(tp, "BLOCK_CHARS", 200)
    monkeypatch.setattr(tp, "FAN", 3)
    monkeypatch.setattr(tp, "FRAME", 5)
    rows = sample_rows()
    docs = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, pairs string").repartition(4)
    found, counted = tp.align(docs, A_FILE, B_FILE)
    wanted, counts, most = brute_force(rows)
    assert in_order(tuple(r) for r in found.collect()) == in_order(wanted)
    table = tp.pair_table(counted).collect()
    assert {(r.a, r.b): r.n for r in table} == dict(counts) and len(table) == len(counts)
    assert all(r.best == (r.n == most[r.b]) for r in table)


def test_query_on_the_smallest_tables(spark):
    from ledgerline.llm.queries import QUERIES

    d = "/root/testdata/sf0.001"
    found = QUERIES["op12_token_alignment"](spark, d).collect()
    rows = [tuple(r) for r in spark.read.parquet(f"{d}/documents.parquet").select("doc_id", "text").collect()]
    assert in_order(tuple(r) for r in found) == in_order(brute_force(rows)[0])


def test_tables_without_tokens(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert tp.align(empty, A_FILE, B_FILE)[0].count() == 0
    blank = spark.createDataFrame([(1, None), (2, "")], "doc_id long, text string")
    found, counted = tp.align(blank, A_FILE, B_FILE)
    assert in_order(tuple(r) for r in found.collect()) == [(1, 0, 0, 0, 0, 0, 0, ""), (2, 0, 0, 0, 0, 0, 0, "")]
    assert tp.pair_table(counted).count() == 0


def test_runs_merge_like_one_table(monkeypatch):
    monkeypatch.setattr(tp, "FRAME", 4)
    monkeypatch.setattr(tp, "FAN", 2)
    rng, total, runs = random.Random(2), Counter(), []
    for _ in range(9):
        own = {rng.randrange(6) << tp.A_BITS | rng.randrange(9): rng.randrange(1, 10**rng.randrange(1, 12)) for _ in range(25)}
        total.update(own)
        keys = np.array(sorted(own), dtype=np.int64)
        runs.append(tp.run_of(keys, np.array([own[k] for k in keys.tolist()])))
    runs.append(b"")
    keys, counts, best = (np.concatenate(c) for c in zip(*tp.with_maxima(tp.merged(runs))))
    assert keys.tolist() == sorted(total) and counts.tolist() == [total[k] for k in sorted(total)]
    most = {b: max(n for k, n in total.items() if k >> tp.A_BITS == b) for b in range(6)}
    assert best.tolist() == [int(total[k] == most[k >> tp.A_BITS]) for k in sorted(total)]
