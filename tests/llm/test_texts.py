"""Encoders, files, decontamination and chat against brute force and the tokenizers library."""

import hashlib
import random
import re
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from docloom.llm import bpe, chat, decontaminate, queries, token_file

PATH = public_tokenizers.path(queries.VOCABULARY)
SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def odd_texts(n=1500):
    rnd = random.Random(1)
    signs = "abcdefghij'sZÉßÄİΣςıſ12٣!?&%$<|> \t\n  \x1c\x1f\x85̧́e中文日あカ각\U0001f600‍️\x00\x7f\xad﻿_²½"
    texts = ["".join(rnd.choice(signs) for _ in range(rnd.randrange(60))) for _ in range(n)]
    texts += ["".join(rnd.choice("etaoinshr") for _ in range(rnd.randrange(1, 30))) for _ in range(n)]
    return texts + ["<|endoftext|> a<|startoftext|>b <|<|endoftext|>|> x'll", "a" * 5000, "ab" * 3000, "", " \n"]


def docs_of(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string, ids string")


def test_trie_encodes_and_decodes_like_the_library(library):
    trie = bpe.TrieEncoder(bpe.read_text(PATH))
    cache = bpe.WordCache(trie.cut_other, trie.encode)
    texts = odd_texts()
    for text, words, want in zip(texts, cache.cut(texts), library.encode_batch(texts, add_special_tokens=False), strict=True):
        raw = [cache.raw[w] for w in words]
        assert np.frombuffer(b"".join(raw), "<u4").tolist() == want.ids, text
        assert " ".join(map(trie.decode, raw)) == library.decode(want.ids, skip_special_tokens=False)


def test_shared_prefixes_give_the_same_ids_alone(library):
    known = bpe.Vocabulary(bpe.read_text(PATH))
    words = ["the", "them", "then", "thenan", "thenanor", "t", "anoranoranor"]
    together = known.encode_words(words)
    assert all(known.encode_words([w])[w] == together[w] for w in words)


def test_encode_decode_rows(spark, library):
    rows = [(1, "Hello  world's", "x"), (2, None, "x"), (2, None, "y"), (None, "", None), (3, "Ünïted <|endoftext|>", "z")]
    out = bpe.encode_decode(docs_of(spark, rows), PATH, decoded=True, digests=True)
    assert out.columns == ["doc_id", "text", "n_tokens", "ids", "decoded", "ids_sha256", "decoded_sha256"]
    for row in out.collect():
        ids = library.encode(row["text"] or "", add_special_tokens=False).ids
        assert (row["ids"], row["n_tokens"]) == (ids, len(ids))
        assert row["decoded"] == library.decode(ids, skip_special_tokens=False)
        assert row["ids_sha256"] == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
    again = bpe.decode(out.select("doc_id", "ids"), PATH).collect()
    assert {r["decoded"] for r in again} == {r["decoded"] for r in out.collect()}
    assert bpe.encode_decode(docs_of(spark, []), PATH).count() == 0


def test_token_files_round_trip(spark, library, tmp_path, monkeypatch):
    monkeypatch.setattr(token_file, "FRAME_IDS", 50)
    texts = [None, "", "one two", "three " * 400, *odd_texts(60)]
    rows = [(n if n != 5 else None, t, "x") for n, t in enumerate(texts)] + [(3, "again", "x")]
    manifest = token_file.write_documents(docs_of(spark, rows), PATH, str(tmp_path), parts=3)
    read = sorted(token_file.read_documents(manifest, str(tmp_path)).collect(), key=lambda r: r["start"])
    assert [r["doc_id"] for r in read] == sorted((r[0] for r in rows), key=lambda d: (d is not None, d or 0))
    expected = defaultdict(list)
    for doc_id, text, _ in rows:
        expected[doc_id].append([*library.encode(text or "", add_special_tokens=False).ids, 1])
    before = 0
    for row in read:
        assert row["start"] == before and row["ids"] in expected[row["doc_id"]]
        assert row["ids_crc32"] == zlib.crc32(np.array(row["ids"], "<u4").tobytes())
        before += row["n_tokens"]
    some = token_file.read_documents(manifest, str(tmp_path), [7, 9]).collect()
    assert sorted(r["doc_id"] for r in some) == [7, 9]
    assert token_file.write_documents(docs_of(spark, []), PATH, str(tmp_path / "none")).count() == 0


@pytest.mark.parametrize("n", [1024, 2048, 4096])
def test_chunks_of_equal_hashes_keep_their_own_ids(library, n):
    """A Thue-Morse word and its complement have equal polynomial hashes modulo 2^64."""
    word = "a"
    while len(word) < n:
        word += word.translate(str.maketrans("ab", "ba"))
    other = word.translate(str.maketrans("ab", "ba"))
    encoder = token_file.TextEncoder(bpe.read_text(PATH))
    for texts in ([word, other, f"{other} {word} {other}"], [other], [word]):  # in one slice, and across slices
        ids, first = encoder.encode(pa.array(texts))
        for k, text in enumerate(texts):
            assert ids[first[k] : first[k + 1]].tolist() == library.encode(text, add_special_tokens=False).ids


def test_a_reader_decompresses_only_the_frames_asked_for_and_checks_them(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(token_file, "FRAME_IDS", 10)
    rows = [(n, "word " * 8, "x") for n in range(20)]
    manifest = token_file.write_documents(docs_of(spark, rows), PATH, str(tmp_path), parts=1)
    (name,) = [r["path"] for r in manifest.collect()]
    files = token_file.pafs.LocalFileSystem()
    reader = token_file.FrameReader(files, str(tmp_path / name))
    seen = []
    monkeypatch.setattr(token_file.FrameReader, "frame", lambda self, k, f=token_file.FrameReader.frame: seen.append(k) or f(self, k))
    assert len(reader.seek) > 5 and [d for d, _, _ in reader.documents(np.array([13]))] == [13]
    assert seen == [int(reader.frame_of[13])]
    data = bytearray((tmp_path / name).read_bytes())
    data[int(reader.frame_at[2]) + 8] ^= 255
    (tmp_path / name).write_bytes(data)
    with pytest.raises(Exception):
        list(token_file.FrameReader(files, str(tmp_path / name)).documents(np.arange(20)))


def brute_hits(text, items, window):
    words_of = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    words, hit, found = words_of(text), set(), set()
    for item, t in items:
        own = words_of(t)
        for k in range(max(1, len(own) - window + 1) if own else 0):
            cut = own[k : k + window]
            for i in range(len(words) - len(cut) + 1):
                if words[i : i + len(cut)] == cut:
                    hit |= set(range(i, i + len(cut)))
                    found.add(str(item) if item is not None else "")
    return len(words), len(hit), sorted(found)


@pytest.mark.parametrize("block", [1000, 2])
def test_decontamination(spark, block):
    rnd = random.Random(3)
    draw = lambda n: " ".join(rnd.choice(["a", "b", "C", "é", "dd", "7"]) for _ in range(n))
    items = [(n, draw(rnd.randrange(1, 7))) for n in range(6)] + [(7, None), (8, "..."), (None, "zz top"), (9, "ab c")]
    rows = [(n, draw(rnd.randrange(0, 40)), "x") for n in range(40)] + [(50, None, "x"), (50, "", "x"), (51, "ZZ, top! " * 3, "x"), (None, "ab.c", "x"), (51, "zz", "x"), (52, "abc", "x")]
    docs = docs_of(spark, rows)
    got = decontaminate.contamination(docs, spark.createDataFrame(items, "item_id long, text string"), window=4, block=block)
    assert sorted((r["doc_id"] or -1, r["text"] or "", r["n_words"], r["n_hit"], tuple(r["items"])) for r in got.collect()) == sorted((d or -1, t or "", *(tuple(x) if isinstance(x, list) else x for x in brute_hits(t, items, 4))) for d, t, _ in rows)
    none = decontaminate.contamination(docs, spark.createDataFrame([], "item_id long, text string"))
    assert none.agg(F.sum("n_hit")).first()[0] == 0


def test_hits_of_blocks_are_a_union():
    assert decontaminate.merged(np.array([5, 0, 3]), np.array([9, 2, 6])) == [0, 2, 3, 9]


@pytest.mark.parametrize("text", ["", "plain", chat.END, "### user: x </turn>\n", r"\### Assistant: </turn> ok", "\\" * 9 + "###", "ends with \\", "####\n</turn>\n\\</turn>", "a\\\\</turn>", "</turn", "é\U0001f600###"])
def test_chat_round_trip(spark, text):
    roles = ["user", "assistant", None, "a: b ### </turn>\n"]
    rows = [(1, n, r, text) for n, r in enumerate(roles)] + [(1, 1, "assistant", text), (None, None, "assistant", None)]
    read = chat.read_back(chat.format_conversations(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))).collect()
    turns = {r["conv_id"]: r for r in read}
    want = [("user", text), ("assistant", text), ("assistant", text), ("", text), (roles[3], text)]
    assert [tuple(t) for t in turns[1]["turns"]] == want
    assert "".join(turns[1]["loss_texts"]) == text * 2
    assert [tuple(t) for t in turns[None]["turns"]] == [("assistant", "")]


def test_chat_query_against_brute_force(spark):
    groups = defaultdict(list)
    for r in spark.read.parquet(f"{SF}/conversations.parquet").collect():
        groups[r["conv_id"]].append((r["turn"], r["role"] or "", r["text"] or ""))
    groups[-7] = [(0, "user", queries.CONFLICT), (1, "assistant", queries.CONFLICT)]
    got = {r["conv_id"]: r for r in queries.op1_chat(spark, SF).collect()}
    assert got.keys() == groups.keys()
    for conv_id, turns in groups.items():
        loss = "".join(t for _, role, t in sorted(turns) if role == "assistant")
        told = "".join(f"{role}\n{t}\n" for _, role, t in sorted(turns))
        row = got[conv_id]
        assert (row["n_turns"], row["loss_chars"]) == (len(turns), len(loss))
        assert row["turns_sha256"] == hashlib.sha256(told.encode()).hexdigest()
        assert row["loss_sha256"] == hashlib.sha256(loss.encode()).hexdigest()


def test_packed_words_are_those_of_each_text():
    from docloom.llm.arrays import WordHasher

    texts = ["ab Cd", None, "", "ab", "é7-x", "ab"]
    lowered, starts, ends, hashes, first = WordHasher().words(pa.array(texts))
    words = [lowered[a:b].tobytes().decode() for a, b in zip(starts, ends, strict=True)]
    assert words == ["ab", "cd", "ab", "é7", "x", "ab"] and first.tolist() == [0, 2, 2, 2, 3, 5, 6]
    assert hashes[0] == hashes[2] == hashes[5] and len(set(hashes.tolist())) == 4
