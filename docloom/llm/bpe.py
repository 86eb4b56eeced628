"""Byte-pair encoding and decoding by a depth-first walk over a trie of distinct words.

In a byte-pair vocabulary in which every merge makes a token of its own, a token
sequence is the encoding of its text exactly if each neighbouring pair is the
encoding of the pair's text. The encoding of a prefix is therefore known from
its last token alone: among the tokens that end there, the one that is valid
after the last token of the prefix in front of it. The distinct words of a batch
are put into a trie, laid out depth first (sorted words are that order, and the
path is a stack); each node's last token is found once and shared by all words
below it. Word ends are tokens of their own kind (suffix ``</w>``) and so are
leaves: they read the path's states and add none.

Texts are normalised and cut into words as the tokenizer does; each distinct word is
encoded once while a task remembers it. That memory is bounded by ``CACHE_WORDS``:
when full it starts anew, and the results are the same.

Edge cases: NULL and blank texts have no ids and decode to the empty text; NULL
ids are kept as they are; repeated rows are encoded alike; special tokens written
in a text become their ids, as the library does by default.
"""

from __future__ import annotations

import gc
import hashlib
import json
import re
import struct
import unicodedata
from collections.abc import Callable, Iterable

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as st

from docloom.llm.arrays import by_text

#: Distinct words one task remembers; about 50 MB at usual lengths.
CACHE_WORDS = 200_000
#: Pairs of tokens whose validity one task remembers.
KNOWN_PAIRS = 2_000_000
WORD_END = "</w>"
#: Texts of letters below this (Latin, Greek, Cyrillic) are cut into words here; on
#: others Unicode versions disagree, and the library says what is a letter.
OWN_BELOW = "\u0530"
#: Marks of a remembered word that isn't plain text: cut by the library, or a special token.
CUT, SPECIAL = "\x1c", "\x1d"

ODD = re.compile("[\x1c-\x1f]|<\\|")  # signs that mark remembered words; maybe a special token
# The public tokenizer's contractions, and white space below OWN_BELOW.
CONTRACTIONS = "'(?:[stmd]|re|ve|ll)"
WHITE = " \t\n\r\f\v\x85\xa0"


def ranges(kind: str, below: str) -> str:
    """Characters of a Unicode category, as ranges of a character class."""
    found: list[list[int]] = []
    for code in range(ord(below)):
        if regex.match(rf"\p{{{kind}}}", chr(code)):
            if found and found[-1][1] == code - 1:
                found[-1][1] = code
            else:
                found.append([code, code])
    return "".join(f"{chr(a)}-{chr(b)}" for a, b in found)


def word_pattern(below: str) -> str:
    """Letters, a contraction, one number, or signs: words of normalised text of characters below this."""
    letters, numbers = ranges("L", below), ranges("N", below)
    return f"[{letters}]+|{CONTRACTIONS}|[{numbers}]|[^{WHITE}{letters}{numbers}]+"


def byte_letters() -> list[str]:
    """The printable letter that byte-level vocabularies use for each byte."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    letters = {b: chr(b) for b in printable}
    letters |= {b: chr(0x100 + n) for n, b in enumerate(sorted(set(range(256)) - set(printable)))}
    return [letters[b] for b in range(256)]


def read_text(path: str) -> str:
    with open(path, encoding="utf-8") as f:
        return f.read()


class Vocabulary:
    """Tokens, the rank of each merge, and which token may follow which."""

    def __init__(self, source: str) -> None:
        told = json.loads(source)
        model = told["model"]
        self.ids: dict[str, int] = model["vocab"]
        merges = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]]
        self.special = {t["content"]: t["id"] for t in told["added_tokens"] if t["special"]}
        self.tokens = [""] * (max([*self.ids.values(), *self.special.values()]) + 1)
        for token, n in [*self.ids.items(), *self.special.items()]:
            self.tokens[n] = token
        ids = self.ids
        self.rank = {(ids[a], ids[b]): n for n, (a, b) in enumerate(merges)}
        self.parts = {ids[a + b]: (ids[a], ids[b], n) for n, (a, b) in enumerate(merges)}
        if len(self.parts) != len(merges):
            raise ValueError("two merges make the same token; its last-token states aren't unique")
        self.length = [len(t.removesuffix(WORD_END)) for t in self.tokens]
        self.longest = max(self.length)
        self.inner = {t: n for t, n in ids.items() if not t.endswith(WORD_END)}
        self.final = {t.removesuffix(WORD_END): n for t, n in ids.items() if t.endswith(WORD_END)}
        self.coded = [n.to_bytes(4, "little") for n in range(len(self.tokens))]
        self.known: dict[int, bool] = {}
        self.spines: tuple[dict, dict] = {}, {}

    def _spine(self, token: int, side: int) -> list[tuple[int, float]]:
        """The parts that come to stand at the token's left (0) or right (1) edge, from the symbol up, and the rank of the merge that uses each up."""
        spine = self.spines[side].get(token)
        if spine is None:
            found: list[tuple[int, float]] = [(token, float("inf"))]
            at = token
            while at in self.parts:
                *halves, rank = self.parts[at]
                at = halves[side]
                found.append((at, rank))
            spine = self.spines[side][token] = found[::-1]
        return spine

    def follows(self, left: int, right: int) -> bool:
        """Whether the text of both tokens encodes to just these two.

        It does unless a merge across the border comes before the merges that use
        up its two sides. Equal merges go from left to right: the left token's
        own comes before the border's, the border's before the right token's.
        """
        rank = self.rank
        for a, a_used in self._spine(left, 1):
            for b, b_used in self._spine(right, 0):
                merge = rank.get((a, b))
                if merge is not None and merge < a_used and merge <= b_used:
                    return False
        return True

    def encode_words(self, words: Iterable[str]) -> dict[str, bytes]:
        """Ids (little-endian 32-bit) of distinct words, written in byte letters.

        Sorted, the words are the trie's depth-first order; ``path`` has the last
        token of each prefix of the word at hand, found when first asked for.
        """
        inner, known, follows, length, coded = self.inner, self.known, self.follows, self.length, self.coded
        found: dict[str, bytes] = {}
        path: list[int | None] = []
        before = ""

        def state(word: str, end: int) -> int:
            """Last token of the prefix; also of those prefixes that its candidates rest on."""
            todo = [end]
            while todo:
                end = todo[-1]
                if path[end] is not None:
                    todo.pop()
                    continue
                for start in steps(end):
                    token = inner.get(word[start:end])
                    if token is None:
                        continue
                    if start:
                        left = path[start]
                        if left is None:
                            todo.append(start)
                            break
                        pair = left << 20 | token
                        valid = known.get(pair)
                        if valid is None:
                            valid = known[pair] = follows(left, token)
                        if not valid:
                            continue
                    path[end] = token
                    todo.pop()
                    break
                else:
                    raise ValueError(f"no encoding of {word[:end]!r}")
            return path[end]

        def steps(end: int) -> range:
            return range(max(0, end - self.longest), end)

        for word in sorted(words):
            size, shared = len(word), 0
            most = min(size, len(before)) - 1
            while shared < most and word[shared] == before[shared]:
                shared += 1
            del path[shared + 1 :]
            path.extend([None] * (size - len(path)))
            for start in steps(size):  # the leaf
                token = self.final.get(word[start:])
                if token is None:
                    continue
                if not start:
                    break
                left = path[start]
                if left is None:
                    left = state(word, start)
                pair = left << 20 | token
                valid = known.get(pair)
                if valid is None:
                    valid = known[pair] = follows(left, token)
                if valid:
                    break
            else:
                raise ValueError(f"no encoding of {word!r}")
            ids, at = [coded[token]], start
            while at:
                token = path[at]
                if token is None:
                    token = state(word, at)
                ids.append(coded[token])
                at -= length[token]
            found[word] = b"".join(ids[::-1])
            before = word
        return found


class WordCache:
    """Texts as lists of words, and each word's ids (little-endian 32-bit).

    ``cut_other(text)`` cuts the texts that can't be cut here, ``encode(words)``
    gives the ids of distinct new words.
    """

    def __init__(self, cut_other: Callable[[str], list[str]], encode: Callable[[list[str]], Iterable[bytes]]) -> None:
        self.cut_other, self.encode = cut_other, encode
        self.cut_ascii, self.cut_plain = (re.compile(word_pattern(below)).findall for below in ("\x80", OWN_BELOW))
        self.raw: dict[str, bytes] = {}

    def cut(self, texts: list[str | None]) -> list[list[str]]:
        """Words of each text; afterwards all of them are known."""
        found = [self._cut(t) if t else [] for t in texts]
        self.learn(*found)
        return found

    def learn(self, *found: list[str]) -> tuple[list[str], dict[str, bytes]]:
        """Encode what isn't known of these lists of words; the first list and all that is known."""
        if len(self.raw) > CACHE_WORDS:
            self.raw.clear()
        new = list(set().union(*found) - self.raw.keys())
        self.raw.update(zip(new, self.encode(new), strict=True))
        return (found[0] if found else []), self.raw


    def _cut(self, text: str) -> list[str]:
        if ODD.search(text):
            return self.cut_other(text)
        if text.isascii():
            return self.cut_ascii(text.lower())
        if max(text) < OWN_BELOW:
            # letter by letter: no letter's lower case depends on its neighbours
            lower = unicodedata.normalize("NFC", text).replace("\u03a3", "\u03c3").lower()
            if max(lower) < OWN_BELOW and unicodedata.is_normalized("NFC", lower):
                return self.cut_plain(lower)
        return self.cut_other(text)


class TrieEncoder:
    """Encodes words through the trie; cuts other texts with the library's own normaliser and cutter."""

    def __init__(self, source: str) -> None:
        self.source, self.vocabulary, self.library = source, Vocabulary(source), None
        self.letters = dict(enumerate(byte_letters()))
        special = sorted(self.vocabulary.special, key=len, reverse=True)
        self.special = re.compile("(" + "|".join(map(re.escape, special)) + ")") if special else None
        self.text: dict[bytes, str] = {}

    def cut_other(self, text: str) -> list[str]:
        from tokenizers import Tokenizer

        self.library = self.library or Tokenizer.from_str(self.source)
        out: list[str] = []
        for n, part in enumerate(self.special.split(text) if self.special else [text]):
            if n % 2:
                out.append(SPECIAL + part)
            elif part:
                out += [CUT + w for w, _ in self.library.pre_tokenizer.pre_tokenize_str(self.library.normalizer.normalize_str(part))]
        return out

    def _letters_of(self, word: str) -> str:
        if word[0] == CUT:
            return word[1:]
        if word.isascii():
            return word if word.isprintable() else word.translate(self.letters)
        return word.encode().decode("latin-1").translate(self.letters)

    def encode(self, words: list[str]) -> list[bytes]:
        known = self.vocabulary
        if len(known.known) > KNOWN_PAIRS:
            known.known.clear()
        written = [None if w[0] == SPECIAL else self._letters_of(w) for w in words]
        found = known.encode_words({w for w in written if w is not None})
        return [known.coded[known.special[w[1:]]] if x is None else found[x] for w, x in zip(words, written, strict=True)]

    def decode(self, ids: bytes) -> str:
        """The tokens of one word's ids, joined as the library joins those of a vocabulary without a decoder."""
        known = self.text.get(ids)
        if known is None:
            if len(self.text) > CACHE_WORDS:
                self.text.clear()
            tokens = self.vocabulary.tokens
            known = self.text[ids] = " ".join([tokens[n] for n in struct.unpack(f"<{len(ids) // 4}I", ids)])
        return known


def encode_decode(docs: DataFrame, path: str, ids: bool = True, decoded: bool = False, digests: bool = False, keep: list[str] | None = None) -> DataFrame:
    """Add ``n_tokens`` and, as asked, ``ids`` (array), ``decoded`` (text) and the digests of both.

    ``path``: a vocabulary file of the tokenizers library (BPE with word ends).
    Its text is broadcast: its size is that of a vocabulary, whatever the data.
    Rows stay in their tasks; added columns replace columns of the same name.
    """
    source = docs.sparkSession.sparkContext.broadcast(read_text(path))
    added: list[tuple[str, st.DataType]] = [("n_tokens", st.LongType())]
    added += [("ids", st.ArrayType(st.IntegerType()))] * ids + [("decoded", st.StringType())] * decoded
    added += [("ids_sha256", st.StringType()), ("decoded_sha256", st.StringType())] * digests
    keep = [c for c in (docs.columns if keep is None else keep) if c.lower() not in {n for n, _ in added}]

    def work() -> Callable[[pa.RecordBatch], list[pa.Array]]:
        gc.set_threshold(200_000, 50, 50)  # the caches hold no cycles, and passes over them cost more than the encoding
        trie = TrieEncoder(source.value)
        cache = WordCache(trie.cut_other, trie.encode)
        known, decode_word = cache.raw, trie.decode

        def add(batch: pa.RecordBatch) -> list[pa.Array]:
            texts = cache.cut(batch.column("text").to_pylist())
            of_words = [[known[w] for w in words] for words in texts]
            raw = [b"".join(x) for x in of_words]
            out = [pa.array([len(r) // 4 for r in raw], pa.int64())]
            if ids:
                ends = np.cumsum([0, *(len(r) // 4 for r in raw)], dtype=np.int64)
                out.append(pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.frombuffer(b"".join(raw), "<u4").astype(np.int32))))
            texts_again = [" ".join([decode_word(w) for w in x]) for x in of_words] if decoded or digests else []
            if decoded:
                out.append(pa.array(texts_again, pa.string()))
            if digests:
                out.append(pa.array([hashlib.sha256(r).hexdigest() for r in raw], pa.string()))
                out.append(pa.array([hashlib.sha256(t.encode()).hexdigest() for t in texts_again], pa.string()))
            return out

        return add

    return by_text(docs, work, added, keep)


def decode(df: DataFrame, path: str, ids: str = "ids") -> DataFrame:
    """Add ``decoded``: the tokens of an id array, joined as the library's decode does for a vocabulary without a decoder."""
    source = df.sparkSession.sparkContext.broadcast(read_text(path))
    keep = [c for c in df.columns if c.lower() != "decoded"]
    schema = st.StructType([*(df.schema[c] for c in keep), st.StructField("decoded", st.StringType())])

    def run(batches):
        tokens = Vocabulary(source.value).tokens
        for batch in batches:
            texts = [" ".join([tokens[n] for n in x if 0 <= n < len(tokens)]) if x is not None else "" for x in batch.column(ids).to_pylist()]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in keep), pa.array(texts, pa.string())], names=schema.names)

    return df.mapInArrow(run, schema)
