"""BPE encoding by backtracking over Aho-Corasick matches, decoding by an offset table.

A word is tiled from the left with the longest token that matches there and is
compatible with the token before it; where none is, the last token is taken
back and its next shorter match tried. Ends that proved impossible are marked,
so each is tried once and the work is linear in the word. A pair of tokens is
compatible if merging the text of both gives just these two tokens, and a
tiling of compatible pairs is the one that merging gives. The pair table is
filled as pairs appear.

The tokenizer file supplies vocabulary and merges; words, special strings and
normalisation follow it (NFC, lower case, one word end mark per word). Texts
with characters outside ``_COMMON`` get their words from the library, whose
tables of letters and digits may be of another Unicode version than ours; the
ids are made here in either case.
"""

from __future__ import annotations

import hashlib
import json
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

#: words and token pairs remembered per Python worker, and the longest word that is
WORDS_KEPT, PAIRS_KEPT, WORD_KEPT_LEN = 600_000, 400_000, 48
#: characters whose classes no Unicode version since 6 has changed
_COMMON = regex.compile("[\x00-\u024f\u2010-\u205e\u20ac]*")
#: stands for the word end mark inside this module; no byte maps to it
_END = "￿"
#: ids decoded at a time, so that memory does not grow with a text
_CHUNK = 1 << 18


def _byte_chars() -> list[str]:
    """The printable stand-in of every byte, as byte-level vocabularies write them."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    chars = {b: chr(b) for b in plain}
    rest = (b for b in range(256) if b not in chars)
    return [c for _, c in sorted({**chars, **{b: chr(256 + i) for i, b in enumerate(rest)}}.items())]


class _Words(dict):
    """Word -> its ids as little-endian 32-bit integers.

    Holds at most WORDS_KEPT words in two generations: when the newer is full,
    the older is dropped, and words in use move on from it.
    """

    def __init__(self, encode):
        super().__init__()
        self.encode = encode
        self.older: dict[str, bytes] = {}

    def __missing__(self, word: str) -> bytes:
        ids = self.older.get(word)
        if ids is None:
            ids = np.array(self.encode(word), "<u4").tobytes()
        if len(word) <= WORD_KEPT_LEN:
            if len(self) >= WORDS_KEPT // 2:
                self.older = dict(self)
                self.clear()
            self[word] = ids
        return ids


class BacktrackBpe:
    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        self.suffix = model["end_of_word_suffix"]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.special_re = regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")") if self.special else None
        self.word_re = regex.compile(spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"])
        self.to_char = _byte_chars()
        self.to_byte = {c: b for b, c in enumerate(self.to_char)}
        self.library = Tokenizer.from_file(path)
        vocab = {self._inner(t): i for t, i in model["vocab"].items() if t not in self.special}
        self.text = {i: t for t, i in vocab.items()}
        self.rank, self.joined = {}, {}
        for n, (a, b) in enumerate(model["merges"]):
            pair = vocab[self._inner(a)], vocab[self._inner(b)]
            self.rank[pair], self.joined[pair] = n, vocab[self._inner(a + b)]
        self.unit = {t: i for t, i in vocab.items() if len(t.removesuffix(_END)) == 1}
        self.automaton = ahocorasick.Automaton()
        for t, i in vocab.items():
            if t not in self.special and self.merged(t) == [i]:  # else no merging ever gives this token
                self.automaton.add_word(t, (len(t), i))
        self.automaton.make_automaton()
        self.pairs: dict[tuple[int, int], bool] = {}
        self.words = _Words(self.encode_word)
        self._offsets(model["vocab"])

    def _inner(self, token: str) -> str:
        return token.removesuffix(self.suffix) + _END if token.endswith(self.suffix) else token

    def _offsets(self, vocab: dict[str, int]) -> None:
        """Token i, and a space, are the bytes blob[offset[i]:offset[i + 1]]."""
        by_id = {i: t for t, i in {**vocab, **self.special}.items()}
        parts = [(by_id.get(i, "") + " ").encode() for i in range(max(by_id) + 1)]
        self.blob = np.frombuffer(b"".join(parts), np.uint8)
        self.offset = np.concatenate(([0], np.cumsum([len(p) for p in parts])))

    def merged(self, text: str) -> list[int]:
        """Plain merging, lowest rank first and leftmost; for the short texts of one or two tokens."""
        ids = []
        for i, c in enumerate(text):
            if c != _END:
                ids.append(self.unit[c + _END if text[i + 1:i + 2] == _END else c])
        while len(ids) > 1:
            found = min((self.rank.get(p, len(self.rank)), k) for k, p in enumerate(zip(ids, ids[1:])))
            if found[0] == len(self.rank):
                break
            k = found[1]
            ids[k:k + 2] = [self.joined[ids[k], ids[k + 1]]]
        return ids

    def compatible(self, a: int, b: int) -> bool:
        known = self.pairs.get((a, b))
        if known is None:
            if len(self.pairs) >= PAIRS_KEPT:
                self.pairs.clear()
            known = self.pairs[a, b] = self.merged(self.text[a] + self.text[b]) == [a, b]
        return known

    def encode_word(self, word: str) -> list[int]:
        text = "".join(map(self.to_char.__getitem__, word.encode("utf-8", "surrogatepass"))) + _END
        n = len(text)
        matches: list[list[tuple[int, int]]] = [[] for _ in range(n)]  # by start, shortest first
        for end, (length, token) in self.automaton.iter(text):
            matches[end + 1 - length].append((length, token))
        dead = bytearray(n + 1)
        path: list[tuple[int, int, int]] = []  # start, index into its matches, token
        at, k = 0, len(matches[0]) - 1
        while at < n:
            while k >= 0:
                length, token = matches[at][k]
                if not dead[at + length] and (not path or self.compatible(path[-1][2], token)):
                    break
                k -= 1
            if k >= 0:
                path.append((at, k, token))
                at += length
                k = len(matches[at]) - 1 if at < n else -1
            else:  # nothing fits behind the last token: take it back
                if not path:
                    raise ValueError(f"the vocabulary does not cover {word!r}")
                dead[at] = 1
                at, k, _ = path.pop()
                k -= 1
        return [t for _, _, t in path]

    def _uncommon(self, text: str) -> bytes:
        pieces = self.library.pre_tokenizer.pre_tokenize_str(self.library.normalizer.normalize_str(text))
        words = (bytes(map(self.to_byte.__getitem__, piece)).decode("utf-8") for piece, _ in pieces)
        return b"".join([self.words[w] for w in words])

    def _plain(self, text: str) -> bytes:
        if not text.isascii():
            if not _COMMON.fullmatch(text):
                return self._uncommon(text)
            text = unicodedata.normalize("NFC", text)
        words = self.words
        return b"".join([words[w] for w in self.word_re.findall(text.lower())])

    def encode(self, text: str | None) -> bytes:
        """The ids of a whole text as little-endian 32-bit integers; null and empty give none."""
        if not text:
            return b""
        if self.special_re is None or not self.special_re.search(text):
            return self._plain(text)
        return b"".join(np.array([self.special[part]], "<u4").tobytes() if part in self.special else self._plain(part)
                        for part in self.special_re.split(text))

    def decode(self, ids: bytes) -> Iterator[bytes]:
        """The text of the ids in pieces: tokens in order, one space between."""
        ids = np.frombuffer(ids, "<u4")
        for i in range(0, len(ids), _CHUNK):
            part = ids[i:i + _CHUNK]
            start = self.offset[part]
            size = self.offset[part + 1] - start
            shift = np.repeat(start - np.concatenate(([0], np.cumsum(size)[:-1])), size)
            piece = self.blob[shift + np.arange(len(shift))].tobytes()
            yield piece if i + _CHUNK < len(ids) else piece[:-1]


@lru_cache(maxsize=2)
def encoder(path: str) -> BacktrackBpe:
    """The encoder of a file, built once per Python worker."""
    return BacktrackBpe(path)


def encode_documents(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text",
                     ids: bool = True, decoded: bool = True) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_tokens, ids_sha256, decoded_sha256 and, if asked, ids and decoded.

    Whole texts are encoded, then decoded from their ids. A null or empty text
    has no tokens and decodes to the empty text. Repeated ids are separate
    rows; a null id stays null; other columns are ignored. An empty table gives
    an empty result.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = encoder(tokenizer_path)
        for b in batches:
            out = {"doc_id": b.column(0), "n_tokens": [], "ids_sha256": [], "decoded_sha256": [],
                   **({"ids": []} if ids else {}), **({"decoded": []} if decoded else {})}
            for t in b.column(1):
                code = bpe.encode(t.as_py())
                out["n_tokens"].append(len(code) // 4)
                out["ids_sha256"].append(hashlib.sha256(code).hexdigest())
                digest, pieces = hashlib.sha256(), []
                for piece in bpe.decode(code):
                    digest.update(piece)
                    if decoded:
                        pieces.append(piece)
                out["decoded_sha256"].append(digest.hexdigest())
                if ids:
                    out["ids"].append(np.frombuffer(code, "<u4").astype(np.int32))
                if decoded:
                    out["decoded"].append(b"".join(pieces).decode())
            kinds = {"n_tokens": pa.int64(), "ids": pa.list_(pa.int32())}
            yield pa.RecordBatch.from_arrays(
                [v if k == "doc_id" else pa.array(v, kinds.get(k, pa.string())) for k, v in out.items()], list(out))

    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    schema = f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, n_tokens bigint, ids_sha256 string, decoded_sha256 string"
    return rows.mapInArrow(run, schema + ", ids array<int>" * ids + ", decoded string" * decoded)
